"""Dataset audit: what is wrong with a built set, as one long table of findings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from framewright import schemas as C
from framewright.functions.geometry import MIN_AREA, stem
from framewright.operators.review import filled_lines
from framewright.session import pin

# The ten kinds of finding.
KINDS = (
    "empty_split",
    "missing_label",
    "missing_image",
    "broken_link",
    "unreadable",
    "bad_line",
    "out_of_range",
    "degenerate",
    "name_in_two_splits",
    "same_photo_in_two_splits",
)
LINE_END = r"\r?\n"
#: Rows that one task makes of one much repeated finding.
REPEATS = 100_000


def parsed_lines(labels: DataFrame, *, carry: Sequence[str] = ()) -> DataFrame:
    """Lines of label texts: number, tokens, and the class and shares that could be read.

    ``labels`` has ``source``, ``text`` and what ``carry`` names; blank lines are left out but counted.
    """
    lines = labels.select("source", *carry, F.posexplode(F.split("text", LINE_END)).alias("_pos", "line"))
    tokens = F.split(F.btrim("line", F.lit(" \t\r\f")), r"\s+")
    lines = lines.select("source", *carry, (F.col("_pos") + 1).alias("line_no"), "line", tokens.alias("_t"))
    lines = lines.filter(F.col("line").rlike(r"\S")).withColumn("tokens", F.size("_t"))
    value = lambda k: F.try_element_at("_t", F.lit(k)).try_cast("double")
    names = ("cx", "cy", "w", "h")
    return lines.select(
        "source",
        *carry,
        "line_no",
        "tokens",
        F.try_element_at("_t", F.lit(1)).try_cast("int").alias("class_id"),
        *[value(k + 2).alias(n) for k, n in enumerate(names)],
    )


def read_boxes(labels: DataFrame) -> DataFrame:
    """Boxes of label texts; lines that are not five numbers are skipped."""
    good = F.col("tokens") == 5
    for name in ("cx", "cy", "w", "h"):
        good = good & F.col(name).isNotNull()
    return parsed_lines(labels).filter(good).select("source", "line_no", "class_id", "cx", "cy", "w", "h")


def line_findings(labels: DataFrame, *, carry: Sequence[str] = ()) -> DataFrame:
    """Findings about single lines; one line may raise several."""
    lines = parsed_lines(labels, carry=carry)
    shares = [F.col(c) for c in ("cx", "cy", "w", "h")]
    readable = (F.col("tokens") == 5) & F.col("class_id").isNotNull()
    for share in shares:
        readable = readable & share.isNotNull()
    outside = F.lit(False)
    for share in shares:
        outside = outside | (share < 0.0) | (share > 1.0)
    w, h = F.col("w"), F.col("h")
    flat = (w <= 0.0) | (h <= 0.0) | (w * h < MIN_AREA)
    place = F.concat(F.col("source"), F.lit(":"), F.col("line_no").cast("string"))
    stranger = F.concat(place, F.lit(" class "), F.col("class_id").cast("string"))
    found = F.array(
        F.when(~readable, F.struct(F.lit("bad_line").alias("kind"), place.alias("item"))),
        F.when(readable & (F.col("class_id") != 0), F.struct(F.lit("bad_line").alias("kind"), stranger.alias("item"))),
        F.when(readable & outside, F.struct(F.lit("out_of_range").alias("kind"), place.alias("item"))),
        F.when(readable & flat, F.struct(F.lit("degenerate").alias("kind"), place.alias("item"))),
    )
    return lines.select(*carry, F.inline(F.array_compact(found)))


def names_in_two_splits(images: DataFrame) -> DataFrame:
    """Names present in more than one part."""
    parts = images.groupBy("name").agg(F.min("split").alias("_a"), F.max("split").alias("_b"))
    return parts.filter(F.col("_a") != F.col("_b")).select("name")


def digests(images: DataFrame) -> DataFrame:
    """Images with the digest of their content in its place.

    Pinned: the bytes are by far the largest input and are read this once.
    """
    others = [c for c in images.columns if c != "content"]
    return pin(images.select(*others, F.sha1("content").alias("digest")))


def photos_in_two_splits(keyed: DataFrame) -> DataFrame:
    """Images whose content occurs in more than one part: one row per member (input from :func:`digests`)."""
    keyed = keyed.select("split", "name", "digest")
    parts = keyed.groupBy("digest").agg(
        F.min("split").alias("_a"), F.max("split").alias("_b"), F.count("*").alias("members")
    )
    # pinned: a join with a plain table lets adaptive execution split a much-copied photo
    shared = pin(parts.filter(F.col("_a") != F.col("_b")).select("digest", "members"))
    return keyed.join(shared, "digest")


def shared_photos(keyed: DataFrame) -> DataFrame:
    """One row per photo that occurs in more than one part: ``digest, members``, and its members per part."""
    per_part = keyed.groupBy("digest", "split").agg(F.count("*").alias("n"))
    photos = per_part.groupBy("digest").agg(
        F.sum("n").alias("members"), F.map_from_entries(F.sort_array(F.collect_list(F.struct("split", "n")))).alias("parts")
    )
    return photos.filter(F.size("parts") > 1)


def unpaired(images: DataFrame, labels: DataFrame) -> DataFrame:
    """Images without label and labels without image, by part and stem."""
    left = images.select("split", stem(F.col("name")).alias("stem"), F.col("name").alias("image_name"))
    right = labels.select("split", stem(F.col("name")).alias("stem"), F.col("name").alias("label_name"))
    alone = []
    for own, other, kind, name in ((left, right, "missing_label", "image_name"), (right, left, "missing_image", "label_name")):
        # names that many rows share are never paired with each other
        lonely = own.join(other.select("split", "stem").distinct(), ["split", "stem"], "left_anti")
        alone.append(lonely.select(F.lit(kind).alias("kind"), F.concat("split", F.lit("/"), name).alias("item")))
    return alone[0].unionByName(alone[1])


def repeated(rows: DataFrame, times: str) -> DataFrame:
    """Every row as often as ``times`` says; a much repeated one comes from many tasks, ``REPEATS`` rows at a time."""
    parts = F.sequence(F.lit(0).cast("long"), F.floor((F.col(times) - 1) / REPEATS))
    dealt = rows.withColumn("_part", F.explode(parts))
    dealt = dealt.repartition(F.xxhash64(*dealt.columns))
    own = F.least(F.lit(REPEATS), F.col(times) - F.col("_part") * REPEATS).cast("int")
    return dealt.withColumn("_again", F.explode(F.array_repeat(F.lit(True), own))).drop("_again", "_part", times)


def findings(images: DataFrame, labels: DataFrame, *, splits: Sequence[str] = C.SPLITS) -> DataFrame:
    """All findings as ``kind, item``.

    ``images``: ``split, name, content`` and optionally ``readable``; a null
    content is a link that leads nowhere.  ``labels``: ``split, name, text``.
    """
    images = digests(images.filter(F.col("split").isin(*splits)))
    labels = labels.filter(F.col("split").isin(*splits))
    present = images.filter(F.col("digest").isNotNull())
    source = F.concat("split", F.lit("/"), "name")

    wanted = images.agg(*[F.count_if(F.col("split") == s).alias(s) for s in splits])
    absent = F.array_compact(F.array(*[F.when(F.col(s) == 0, F.lit(s)) for s in splits]))
    found = wanted.select(F.lit("empty_split").alias("kind"), F.explode(absent).alias("item"))

    broken = images.filter(F.col("digest").isNull())
    lonely = unpaired(images, labels)
    dead = broken.select(F.lit("broken_link").alias("kind"), source.alias("item"))
    no_label = lonely.join(dead.select("item").withColumn("kind", F.lit("missing_label")), ["kind", "item"], "left_anti")
    # equal labels and images of one name are read once and counted, their findings repeated
    label_texts = labels.groupBy("split", stem(F.col("name")).alias("_stem"), "text").agg(F.count("*").alias("_labels"))
    shown = present.groupBy("split", "name").agg(F.count("*").alias("_images")).withColumn("_stem", stem(F.col("name")))
    texts = label_texts.join(shown, ["split", "_stem"])
    texts = texts.groupBy(source.alias("source"), "text").agg(F.sum(F.col("_labels") * F.col("_images")).alias("_times"))
    lines = repeated(line_findings(texts, carry=["_times"]), "_times")
    twice = names_in_two_splits(images).select(F.lit("name_in_two_splits").alias("kind"), F.col("name").alias("item"))
    same = photos_in_two_splits(present).select(
        F.lit("same_photo_in_two_splits").alias("kind"),
        F.concat(F.col("digest"), F.lit(" "), source).alias("item"),
    )
    for part in (dead, no_label, lines, twice, same):
        found = found.unionByName(part)
    if "readable" in images.columns:
        unreadable = present.filter(~F.col("readable"))
        found = found.unionByName(unreadable.select(F.lit("unreadable").alias("kind"), source.alias("item")))
    return found


def finding_counts(found: DataFrame) -> DataFrame:
    """Findings per kind, kinds without findings included, and whether the set is clean.

    A photo in two parts is listed once per member but is one finding.
    """
    same = F.substring_index("item", " ", 1)
    counted = found.select("kind", F.when(F.col("kind") == KINDS[-1], same).otherwise(F.col("item")).alias("item"))
    photos = counted.filter(F.col("kind") == KINDS[-1]).distinct()
    counted = counted.filter(F.col("kind") != KINDS[-1]).unionByName(photos)
    counts = counted.agg(*[F.count_if(F.col("kind") == k).alias(k) for k in KINDS])
    rows = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("findings")) for k in KINDS])
    total = sum((F.col(k) for k in KINDS[1:]), F.col(KINDS[0]))
    return counts.select(F.inline(rows), (total == 0).alias("clean"))


def finding_examples(found: DataFrame, *, n: int = 5) -> DataFrame:
    """First examples of every kind; each map task keeps ``n`` per kind before the shuffle."""
    rank = F.row_number().over(W.partitionBy("kind").orderBy("item"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= n)


def box_totals(images: DataFrame, labels: DataFrame) -> DataFrame:
    """Boxes (non-blank lines) of the labels of existing images per part, images, and mean boxes per image.

    ``images``: ``split, name``, existing ones only; ``labels``: ``split, name, text``.
    """
    texts = labels.select("split", stem(F.col("name")).alias("_stem"), F.size(filled_lines(F.col("text"))).alias("_lines"))
    texts = texts.groupBy("split", "_stem").agg(F.max("_lines").alias("_lines"))
    shown = images.select("split", stem(F.col("name")).alias("_stem")).join(texts, ["split", "_stem"], "left")
    boxes = F.coalesce(F.sum("_lines"), F.lit(0))
    return shown.groupBy("split").agg(boxes.alias("boxes"), F.count("*").alias("frames"), (boxes / F.count("*")).alias("mean_boxes"))


def box_counts(labels: DataFrame) -> DataFrame:
    """The three notions of a box count per label: non-blank, five-token, valid lines."""
    lines = parsed_lines(labels)
    sides = [F.col(c) for c in ("cx", "cy", "w", "h")]
    inside = F.lit(True)
    for side in sides:
        inside = inside & F.coalesce((side >= 0.0) & (side <= 1.0), F.lit(False))
    valid = (F.col("tokens") == 5) & (F.col("class_id") == 0) & inside
    valid = valid & (F.col("w") > 0) & (F.col("h") > 0) & (F.col("w") * F.col("h") >= MIN_AREA)
    counted = lines.groupBy("source").agg(
        F.count("*").alias("filled_lines"),
        F.count_if(F.col("tokens") == 5).alias("five_token_lines"),
        F.count_if(valid).alias("valid_lines"),
    )
    return labels.select("source").join(counted, "source", "left").fillna(0)


def unknown_verdicts(verdicts: DataFrame) -> DataFrame:
    """Human verdicts outside the known words."""
    known = F.col("verdict").isin("", *C.BOX_VERDICTS)
    return verdicts.filter(~F.coalesce(known, F.lit(True))).select(
        F.lit("unknown_verdict").alias("kind"), F.col("box_id").cast("string").alias("item")
    )


def holdout_overlap(pool: DataFrame, holdout: DataFrame, key: str) -> DataFrame:
    """Hold-out rows that share a key with the split pool; the result must be empty."""
    return holdout.join(pool.select(key), key, "left_semi")
