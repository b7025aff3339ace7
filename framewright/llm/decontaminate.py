"""Benchmark decontamination as a prefix-filtered set join, in DataFrame operations only.

An item-sized window (ten consecutive words of an item, or the whole item where it is shorter) is a set of word shingles.  All of
them must occur in a document that holds the window, so one necessary token per window is enough: its rarest shingle.

1. Positions of all documents meet the benchmark's shingles by hash: the *occurrences*, at most one per position and length.
2. Shingles are ordered by how often they occur; a window with a shingle that never occurs is done.
3. The rarest shingle of each other window joins the occurrences.  Length and positional bounds drop starts outside the text.
4. The remaining candidates are verified word by word.

Documents meet by the SHA-256 of their text, so copies of a text cost one verification result and rows without a usable id
keep their own answer.  Broadcasts are left to Spark's size check; every join also runs as a shuffle.

Defined results: null and empty texts have no words and are clean; items without words are ignored; a null ``item_id`` counts as
the empty string; items that repeat an id count once; repeated documents get equal answers; an empty benchmark leaves
everything clean; an empty document table gives an empty result; other columns are ignored by :func:`contamination` and
passed through by :func:`drop_contaminated`.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.llm.common import stored

#: Everything that isn't part of a word, after A-Z are lower case.
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
#: Words of a shingle, the token of the join; shorter windows are one shingle.
SHINGLE = 5


def lowered(text: Column) -> Column:
    """A-Z in lower case, other letters as they are."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, ascii_uppercase, ascii_lowercase))


def words(text: Column) -> Column:
    return F.array_remove(F.split(lowered(F.coalesce(text, F.lit(""))), BREAKS, -1), "")


def _token(words_: Column, at: Column, size: int) -> Column:
    """Hash of ``size`` words from a position."""
    return F.xxhash64(*[F.get(words_, at + i) for i in range(size)])


def _starts(n: Column, size: Column | int) -> Column:
    """Positions at which ``size`` words fit; an empty array where none does."""
    return F.when(n >= size, F.sequence(F.lit(0), n - size)).otherwise(F.array().cast("array<int>"))


def _windows(items: DataFrame, window: int) -> DataFrame:
    """``item, window`` (words), one row per item and different window."""
    own = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words(F.col("text")).alias("w"))
    own = own.filter(F.size("w") > 0).withColumn("len", F.least(F.size("w"), F.lit(window)))
    starts = own.select("item", "w", "len", F.explode(F.sequence(F.lit(0), F.size("w") - F.col("len"))).alias("at"))
    return starts.select("item", F.slice("w", F.col("at") + 1, F.col("len")).alias("window")).distinct()


def _tokens(windows: DataFrame, sizes: list[int]) -> DataFrame:
    """Every shingle of every window: ``wid, window, offset, size, token``."""
    parts = None
    for size in sizes:
        fits = F.size("window") >= size if size == SHINGLE else F.size("window") == size
        part = windows.filter(fits).select("wid", "window", F.explode(_starts(F.size("window"), size)).alias("offset"))
        part = part.select("wid", "window", "offset", F.lit(size).alias("size"), _token(F.col("window"), F.col("offset"), size).alias("token"))
        parts = part if parts is None else parts.unionByName(part)
    return parts


def _occurrences(texts: DataFrame, tokens: DataFrame, sizes: list[int]) -> DataFrame:
    """Positions of documents that hold a shingle of the benchmark: ``text_id, pos, n, size, token``."""
    parts = None
    for size in sizes:
        own = texts.select("text_id", "w", F.size("w").alias("n"), F.explode(_starts(F.size("w"), size)).alias("pos"))
        own = own.select("text_id", "pos", "n", F.lit(size).alias("size"), _token(F.col("w"), F.col("pos"), size).alias("token"))
        part = own.join(tokens.filter(F.col("size") == size).select("token").distinct(), "token", "left_semi")
        parts = part if parts is None else parts.unionByName(part)
    return parts.distinct()


def _covered(spans: Column) -> Column:
    """Words in the union of spans ``(start, len, ...)``."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def add(held, span):
        stop = span["start"] + span["len"]
        fresh = F.greatest(F.lit(0), stop - F.greatest(held["end"], span["start"]))
        return F.struct(F.greatest(held["end"], stop).alias("end"), (held["n"] + fresh).alias("n"))

    return F.aggregate(F.array_sort(spans), start, add, lambda held: held["n"])


def contamination(docs: DataFrame, items: DataFrame, *, window: int = WINDOW) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated, text_id`` (SHA-256 of the text)."""
    all_windows = _windows(items, window).withColumn("wid", F.unhex(F.sha2(F.concat_ws(" ", "window"), 256)))
    all_windows = stored(all_windows, "decontaminate-windows")
    windows = all_windows.select("wid", "window").distinct()
    # at most SHINGLE different numbers
    sizes = [r[0] for r in windows.select(F.least(F.size("window"), F.lit(SHINGLE)).alias("k")).distinct().collect()]
    texts = docs.select(F.col("doc_id").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.withColumn("text_id", F.unhex(F.sha2("text", 256)))
    counted = texts.select("doc_id", "text_id", F.size(words(F.col("text"))).cast("long").alias("n_words"))
    nothing = [F.lit(0).cast("long").alias("n_hit"), F.lit(0).cast("long").alias("n_items"), F.sha2(F.lit(""), 256).alias("items_sha256")]
    if not sizes:
        return counted.select("doc_id", "n_words", *nothing, F.lit(False).alias("contaminated"), "text_id")

    tokens = stored(_tokens(windows, sizes), "decontaminate-tokens")
    known = stored(tokens.select("size", "token").distinct(), "decontaminate-known")
    found = stored(_occurrences(texts.select("text_id", words(F.col("text")).alias("w")), known, sizes), "decontaminate-occurrences")

    frequency = found.groupBy("size", "token").count()
    rated = tokens.join(frequency, ["size", "token"], "left")
    rarest = rated.groupBy("wid").agg(
        F.min(F.struct(F.coalesce("count", F.lit(0)).alias("count"), "token", "offset", "size")).alias("t"), F.first("window").alias("window")
    )
    prefix = rarest.filter("t.count > 0").select("wid", "window", "t.token", "t.offset", "t.size")
    start = F.col("pos") - F.col("offset")
    candidates = found.join(prefix, ["size", "token"]).filter((start >= 0) & (start + F.size("window") <= F.col("n")))
    by_text = candidates.groupBy("text_id").agg(F.collect_list(F.struct(start.alias("start"), "wid", "window")).alias("candidates"))
    by_text = stored(by_text, "decontaminate-candidates")

    def holds(c):
        return F.slice("w", c["start"] + 1, F.size(c["window"])) == c["window"]

    def span(c):
        return F.struct(c["start"].alias("start"), F.size(c["window"]).alias("len"), c["wid"].alias("wid"))

    verified = texts.select("text_id", "text").join(by_text, "text_id").select("text_id", "candidates", words(F.col("text")).alias("w"))
    verified = verified.select("text_id", F.transform(F.filter("candidates", holds), span).alias("spans")).filter(F.size("spans") > 0)
    verified = stored(verified.select("text_id", _covered(F.col("spans")).alias("n_hit"), F.array_distinct("spans.wid").alias("wids")), "decontaminate-verified")
    hits = verified.groupBy("text_id").agg(F.max("n_hit").alias("n_hit"))
    named = verified.select("text_id", F.explode("wids").alias("wid")).distinct().join(all_windows.select("wid", "item"), "wid")
    named = named.select("text_id", "item").distinct().groupBy("text_id").agg(F.sort_array(F.collect_list("item")).alias("found"))
    named = named.select("text_id", F.size("found").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "found"), 256).alias("items_sha256"))
    answers = stored(hits.join(named, "text_id"), "decontaminate-answers")
    return counted.join(answers, "text_id", "left").select(
        "doc_id", "n_words",
        F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
        "text_id",
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, *, window: int = WINDOW) -> DataFrame:
    """Documents without any word of an item's window, with all their columns."""
    bad = contamination(docs, items, window=window).filter("contaminated").select(F.col("text_id").alias("_text_id")).distinct()
    own = docs.withColumn("_text_id", F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)))
    return own.join(stored(bad, "decontaminate-bad"), "_text_id", "left_anti").drop("_text_id")
