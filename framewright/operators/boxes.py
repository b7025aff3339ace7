"""Box geometry between tables: overlaps, merged scans, numbering, detection quality."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from framewright.functions.geometry import clamped_shares, crop_name, intersection, iou, shares
from framewright.operators.greedy import beaten
from framewright.operators.ranking import ordered_rank
from framewright.session import pin

SIDES = ("cx", "cy", "w", "h")
#: Bands per unit of confidence in which precision-recall curves are built.
CONFIDENCE_BANDS = 4096
#: Boxes of a file that are compared all with all, pairs that a task holds at once, and sides beyond which sums of areas may overflow.
CROWD, PAIRS_AT_ONCE, FARTHEST = 500, 300_000, 1e100
IOU_STEPS = tuple(round(0.5 + 0.05 * k, 2) for k in range(10))


def overlap_pairs(left: DataFrame, right: DataFrame, *, iou_min: float, keep: Sequence[str] = (), by_area: bool = False) -> DataFrame:
    """Pairs of boxes of one file with IoU of at least ``iou_min``: ``left_id, right_id, file, iou``, and the left sides in ``keep``.

    ``by_area`` compares areas instead of their rounded quotient: shared * (1 + ``iou_min``) with ``iou_min`` * (both).

    Boxes that overlap so much have widths within a factor ``1/iou_min`` and
    centres closer than ``(1 - iou_min)`` of the larger width.  So every right
    box sits in one band (width class, cell), and a left box looks into the
    cells within reach in its own class and the two beside it, about five in
    all.  Only neighbours are compared, also in a very full file, and no
    qualifying pair is missed.  Both sides need ``id, file, cx, cy, w, h``.
    """
    floor = iou_min * 0.999
    ratio = 1.0 / floor

    def measured(df: DataFrame) -> DataFrame:
        solid = df.select("id", "file", *SIDES).filter((F.col("w") > 0) & (F.col("h") > 0))
        return solid.withColumn("_class", F.floor(F.log("w") / F.lit(math.log(ratio))))

    def widest(width_class: Column) -> Column:
        return F.pow(F.lit(ratio), width_class + 1)

    def cell(at: Column) -> Column:
        return F.floor(at / (F.col("_widest") * F.lit(4.0 * (1.0 - floor))))

    home = measured(right).withColumn("_widest", widest(F.col("_class"))).withColumn("_cell", cell(F.col("cx")))
    beside = F.explode(F.array(*[F.col("_class") + step for step in (-1, 0, 1)]))
    probes = measured(left).withColumn("_class", beside).withColumn("_widest", widest(F.col("_class")))
    reach = F.greatest("w", "_widest") * F.lit(1.0 - floor)
    probes = probes.withColumn("_cell", F.explode(F.sequence(cell(F.col("cx") - reach), cell(F.col("cx") + reach))))
    # one side grew about fivefold, which size estimates do not see: it must not be broadcast
    a, b = probes.alias("a").hint("merge"), home.alias("b")
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("file", "_class", "_cell")]
    mine, other = ({s: F.col(f"{side}.{s}") for s in SIDES} for side in "ab")
    measure, enough = iou(mine, other), F.col("iou") >= iou_min
    if by_area:
        enough = intersection(mine, other) * (1.0 + iou_min) >= F.lit(iou_min) * (mine["w"] * mine["h"] + other["w"] * other["h"])
    met = a.join(b, same)
    return (
        (met.filter(enough) if by_area else met)
        .select(
            F.col("a.id").alias("left_id"), F.col("b.id").alias("right_id"), F.col("a.file").alias("file"),
            measure.alias("iou"), *[F.col(f"a.{c}").alias(c) for c in keep],
        )
        .filter(F.lit(True) if by_area else enough)
    )


def _judged(rows: pa.Table, iou_min: float, carried: Sequence[str]) -> pa.RecordBatch:
    """Whole files in order of file, first scan before second, ``id`` → the boxes of the second scan that stay, and their indexes."""
    code = pc.dictionary_encode(rows["file"].combine_chunks()).indices.to_numpy()
    begins = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    group = np.repeat(np.arange(len(begins)), np.diff(np.r_[begins, len(code)]))
    extra = rows["_extra"].to_numpy()
    cx, cy, w, h = (rows[f"_{s}"].to_numpy() for s in SIDES)
    solid = (w > 0) & (h > 0)
    lost = np.zeros(len(code), bool)
    before = np.where(extra & solid, np.arange(len(code)) - begins[group], 0)  # boxes of the file that a box meets
    cuts = np.flatnonzero(np.diff(np.cumsum(before)[np.r_[begins[1:] - 1, len(code) - 1]] // PAIRS_AT_ONCE, prepend=0)) if len(code) else []
    for low, high in zip(np.r_[0, begins[cuts]], np.r_[begins[cuts], len(code)]):
        n = before[low:high]
        later = np.repeat(np.arange(low, high), n)
        earlier = begins[group[later]] + np.arange(len(later)) - np.repeat(np.cumsum(n) - n, n)
        across = np.minimum((cx + w / 2)[later], (cx + w / 2)[earlier]) - np.maximum((cx - w / 2)[later], (cx - w / 2)[earlier])
        down = np.minimum((cy + h / 2)[later], (cy + h / 2)[earlier]) - np.maximum((cy - h / 2)[later], (cy - h / 2)[earlier])
        shared = np.maximum(0.0, across) * np.maximum(0.0, down)
        met = solid[earlier] & (shared * (1.0 + iou_min) >= iou_min * ((w * h)[later] + (w * h)[earlier]))
        earlier, later = earlier[met], later[met]
        first = ~extra[earlier]
        lost[later[first]] = True
        for one, other in zip(earlier[~first].tolist(), later[~first].tolist()):
            if not lost[one]:
                lost[other] = True
    stays = extra & ~lost
    none = np.iinfo(np.int64).min
    top = np.maximum.reduceat(pc.fill_null(rows["_at"], none).to_numpy(), begins) if len(code) else begins
    upto = np.cumsum(stays)
    place = np.where(top == none, 0, top + 1)[group] + upto - 1 - (upto - stays)[begins][group]
    kept = rows.select(carried).filter(pa.array(stays)).combine_chunks()
    return pa.record_batch([*[c.combine_chunks() for c in kept.columns], pa.array(place[stays])], names=[*carried, "_index"])


def _judge_files(iou_min: float, carried: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            rows = (rows if held is None else pa.concat_tables([held, rows])).combine_chunks()
            last = pc.index(rows["file"], rows["file"][-1]).as_py()  # the last file may go on
            if last:
                yield _judged(rows.slice(0, last), iou_min, carried)
            held = rows.slice(last)
        if held is not None:
            yield _judged(held, iou_min, carried)

    return run


def _crowded(base: DataFrame, extra: DataFrame) -> DataFrame | None:
    """Files that are not judged whole: very full ones, and those with a box whose sides are no numbers; None where there are none."""
    wild = F.lit(False)
    for side in SIDES:
        wild = wild | F.coalesce(F.isnan(side) | (F.abs(side) > FARTHEST), F.lit(True))
    files = [df.filter("file IS NOT NULL").select("file", wild.alias("_wild")) for df in (base, extra)]
    sizes = files[0].unionByName(files[1]).groupBy("file").agg(F.count("*").alias("_n"), F.max("_wild").alias("_wild"))
    found = pin(sizes.filter((F.col("_n") > CROWD) | F.col("_wild")).select("file"))
    return None if found.isEmpty() else found


def _crowd_winners(base: DataFrame, extra: DataFrame, iou_min: float) -> DataFrame:
    """The boxes of ``extra`` that stay, by bands and blocks, for files of any size."""
    solid = (F.col("w") > 0) & (F.col("h") > 0)
    # exact twins share all conflicts and conflict with each other: only the first can win, and each place of the first scan counts once
    first = pin(extra.filter(solid).groupBy("file", *SIDES).agg(F.min("id").alias("id")))
    places = base.groupBy("file", *SIDES).agg(F.min("id").alias("id"))
    taken = overlap_pairs(first, places, iou_min=iou_min, by_area=True).select(F.col("left_id").alias("id")).distinct()
    fresh = pin(first.join(taken, "id", "left_anti"))
    pairs = overlap_pairs(fresh, fresh, iou_min=iou_min, by_area=True).filter(F.col("left_id") < F.col("right_id"))
    lost = beaten(pairs.select(F.col("left_id").alias("earlier"), F.col("right_id").alias("later")))
    winners = fresh.select("id").unionByName(extra.filter(~solid).select("id"))
    if lost is not None:
        winners = winners.join(lost, "id", "left_anti")
    return extra.join(winners, "id", "left_semi")


def _winners(base: DataFrame, extra: DataFrame, iou_min: float) -> tuple[DataFrame, DataFrame]:
    """Boxes of ``extra`` that stay: of files judged whole, with ``_index`` behind the largest ``index`` of the base; of all others."""
    carried, crowded = extra.columns, _crowded(base, extra)
    whole = lambda df: df.filter("file IS NOT NULL")
    others = [df.filter("file IS NULL") for df in (base, extra)]
    if crowded is not None:
        whole = lambda df: df.filter("file IS NOT NULL").join(crowded, "file", "left_anti")
        others = [own.unionByName(df.join(crowded, "file", "left_semi").select(*df.columns)) for own, df in zip(others, (base, extra))]
    sides = [F.col(s).cast("double").alias(f"_{s}") for s in SIDES]
    at = F.col("index").cast("long") if "index" in base.columns else F.lit(None).cast("long")
    known = whole(base).select("file", *sides, at.alias("_at"), F.lit(False).alias("_extra"))
    later = whole(extra).select(*carried, *sides, F.lit(None).cast("long").alias("_at"), F.lit(True).alias("_extra"))
    rows = later.unionByName(known, allowMissingColumns=True).repartition("file").sortWithinPartitions("file", "_extra", "id")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in extra.schema)
    settled = rows.mapInArrow(_judge_files(iou_min, carried), f"{kinds}, _index long")
    return settled, others[1].limit(0) if crowded is None and others[1].isEmpty() else _crowd_winners(*others, iou_min)


def merge_scans(base: DataFrame, extra: DataFrame, *, iou_min: float = 0.6) -> DataFrame:
    """Boxes of a second scan that the first one lacks.

    An extra box is refused when it overlaps a box of the first scan, or an extra box accepted before it (order: ``id``).  Both need
    ``id, file, cx, cy, w, h``; further columns of ``extra`` go through the shuffle, so leave out what isn't needed.

    A file of up to ``CROWD`` boxes is judged whole: one shuffle by file, all its pairs at once.  Fuller files are spread over bands
    (:func:`overlap_pairs`) and settled in blocks.
    """
    settled, others = _winners(base, extra, iou_min)
    return settled.drop("_index").unionByName(others.select(*extra.columns))


def merged_scan(base: DataFrame, extra: DataFrame, *, iou_min: float = 0.6) -> DataFrame:
    """The first scan with the new boxes of a second one added, numbers and indexes continued.

    ``base`` has ``number, file, index, cx, cy, w, h, confidence``; ``extra`` has ``id`` (its order) instead of number and index.
    Base rows stay as they are.  New boxes are numbered on in the order of ``id`` over all files, and in their file from the largest index
    on; a file that the first scan doesn't know begins at 0.  ``added`` tells them apart.
    """
    shown = ["file", *SIDES, "confidence"]
    settled, others = _winners(base.withColumn("id", F.col("number")), extra.select("id", *shown), iou_min)
    if not others.isEmpty():
        used = pin(base.groupBy("file").agg((F.max("index") + 1).alias("_used")))
        ranked = ordered_rank(others, ["id"], groups=["file"], rank="_in").join(used, "file", "left")
        place = (F.coalesce("_used", F.lit(0)) + F.col("_in") - 1).cast("long").alias("_index")
        settled = settled.unionByName(ranked.select("id", *shown, place))
    top = F.coalesce(base.agg(F.max("number")).scalar(), F.lit(0))
    more = ordered_rank(settled, ["id"], rank="_on").select(
        (F.col("_on") + top).alias("number"), F.col("_index").alias("index"), *shown, F.lit(True).alias("added")
    )
    return base.select("number", "index", *shown, F.lit(False).alias("added")).unionByName(more)


def number_boxes(boxes: DataFrame, order: Sequence[str], *, after: DataFrame | None = None) -> DataFrame:
    """Running ``number`` over (file, order) and ``index`` inside the file.

    ``after`` is a numbered table (``file, number, index``) to continue from.
    """
    ranked = ordered_rank(boxes, order, groups=["file"], rank="_in", overall="_rank")
    number, index = F.col("_rank"), F.col("_in") - 1
    if after is not None:
        top = F.coalesce(after.agg(F.max("number")).scalar(), F.lit(0))
        # pinned: a join of plain tables lets adaptive execution split a file with very many boxes
        used = pin(after.groupBy("file").agg((F.max("index") + 1).alias("_used")))
        ranked = ranked.join(used, "file", "left")
        number, index = number + top, index + F.coalesce("_used", F.lit(0))
    return ranked.withColumn("number", number).withColumn("index", index).drop("_rank", "_in", "_used")


def boxes_from_detections(detections: DataFrame, *, min_confidence: float = 0.25) -> DataFrame:
    """Detections in pixels → boxes in (unclamped) shares, with area share."""
    kept = detections.filter(F.col("confidence") >= min_confidence)
    parts = shares(*[F.col(c) for c in ("x1", "y1", "x2", "y2", "frame_width", "frame_height")])
    return kept.select("file", "confidence", *[v.alias(k) for k, v in parts.items()]).withColumn(
        "area_share", F.col("w") * F.col("h")
    )


def clamped_boxes(detections: DataFrame) -> DataFrame:
    """Detections in pixels → boxes in shares of the frame, clamped to it."""
    parts = clamped_shares(*[F.col(c) for c in ("x1", "y1", "x2", "y2", "frame_width", "frame_height")])
    return detections.select("file", "confidence", *[v.alias(k) for k, v in parts.items()])


def named_crops(boxes: DataFrame) -> DataFrame:
    return boxes.withColumn("crop", crop_name(F.col("file"), F.col("index"))).withColumn(
        "area_share", F.col("w") * F.col("h")
    )


def matched_detections(
    predictions: DataFrame, truths: DataFrame, *, steps: Sequence[float] = IOU_STEPS, carry: Sequence[str] = ()
) -> DataFrame:
    """Hits per IoU step: ``step, id`` and what ``carry`` names of the predictions.

    A prediction claims the truth it overlaps most; a truth honours its most
    confident claim.  Both sides need ``id, file, cx, cy, w, h``; predictions
    also ``confidence``.  Boxes in exactly the same place are compared once: a
    crowd of twins costs a row per member, not one per pair.
    """
    spots = predictions.groupBy("file", *SIDES).agg(F.min("id").alias("id"))
    places = truths.groupBy("file", *SIDES).agg(F.max("id").alias("id"))
    pairs = overlap_pairs(spots, places, iou_min=min(steps), keep=SIDES)
    best = pin(pairs.groupBy("file", *SIDES).agg(F.max(F.struct("iou", "right_id")).alias("_b")))
    carried = [c for c in carry if c != "confidence"]
    claims = predictions.select("id", "file", *SIDES, "confidence", *carried).join(best, ["file", *SIDES])
    levels = F.explode(F.array(*[F.lit(s) for s in steps]))
    claims = claims.withColumn("step", levels).filter(F.col("_b.iou") >= F.col("step"))
    winner = claims.groupBy("step", F.col("_b.right_id").alias("truth_id")).agg(F.max(F.struct("confidence", "id", *carried)).alias("_w"))
    return winner.select("step", "_w.id", *[F.col(f"_w.{c}") for c in carry])


def detection_quality(
    predictions: DataFrame, truths: DataFrame, *, part: str = "part", steps: Sequence[float] = IOU_STEPS
) -> DataFrame:
    """AP@0.5, mean AP, and precision and recall at the best F1, per part.

    Predictions of equal confidence form one point of the curve.  Running sums
    and the envelope are taken within bands of confidence, and once over the
    few bands, so no task holds a whole curve.
    """
    level = F.col("confidence").alias("level")
    hits = matched_detections(predictions, truths, steps=steps, carry=[part, "confidence"])
    hits = hits.groupBy(part, "step", level).agg(F.count("*").alias("tp"))
    shown = predictions.groupBy(part, level).agg(F.count("*").alias("n"))
    shown = shown.withColumn("step", F.explode(F.array(*[F.lit(s) for s in steps])))
    points = shown.join(hits, [part, "step", "level"], "left").fillna(0, subset=["tp"])
    total = truths.groupBy(part).agg(F.count("*").alias("truths"))
    key = [part, "step", "_band"]
    points = points.withColumn("_band", F.floor(F.col("level") * CONFIDENCE_BANDS))
    bands = W.partitionBy(part, "step").orderBy(F.desc("_band"))
    before = bands.rowsBetween(W.unboundedPreceding, -1)
    sums = points.groupBy(*key).agg(F.sum("tp").alias("_t"), F.sum("n").alias("_m"))
    above = sums.select(*key, *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}0") for c in ("_t", "_m")])
    down = W.partitionBy(*key).orderBy(F.desc("level"))
    upto = down.rowsBetween(W.unboundedPreceding, 0)
    curve = (
        points.join(total, part)
        .join(above, key)
        .withColumn("_tp", F.sum("tp").over(upto) + F.col("_t0"))
        .withColumn("_n", F.sum("n").over(upto) + F.col("_m0"))
        .withColumn("recall", F.col("_tp") / F.col("truths"))
        .withColumn("precision", F.col("_tp") / F.col("_n"))
    )
    peaks = curve.groupBy(*key).agg(F.max("precision").alias("_p"))
    after = bands.rowsBetween(1, W.unboundedFollowing)
    below = peaks.select(*key, F.coalesce(F.max("_p").over(after), F.lit(0.0)).alias("_below"))
    curve = curve.join(below, key)
    best = F.greatest("_below", F.max("precision").over(down.rowsBetween(0, W.unboundedFollowing)))
    curve = curve.withColumn("_area", F.col("tp") / F.col("truths") * best)
    f1 = 2 * F.col("_tp") / (F.col("_n") + F.col("truths"))
    per_step = curve.groupBy(part, "step").agg(
        F.sum("_area").alias("ap"), F.max(F.struct(f1.alias("f1"), "level", "precision", "recall")).alias("_peak")
    )
    first = F.col("step") == float(min(steps))
    return per_step.groupBy(part).agg(
        F.max(F.when(first, F.col("ap"))).alias("ap50"),
        F.avg("ap").alias("map"),
        F.max(F.when(first, F.col("_peak.precision"))).alias("precision"),
        F.max(F.when(first, F.col("_peak.recall"))).alias("recall"),
    )
