"""Detector jobs: from frames and detections to a clean, split, audited set."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright import schemas as C
from framewright.functions.answers import parse_judge_reply
from framewright.functions.naming import group_of, video_moment
from framewright.operators import audit, augment, boxes, pool, reports, review, scenes, splits
from framewright.operators.inference import ask_service, detect, require_service
from framewright.operators.ranking import ordered_rank, sample_first, sheet_cell
from framewright.session import kept, pin
from framewright.sources import sinks


@dataclass(frozen=True)
class Source:
    """A named pool of frames and labels; ``labels=None`` means nothing is shown on its frames.

    ``images`` has ``path, content_key`` (see :func:`pool.content_key`; keep it
    in a table, so that the bytes are read once); ``labels`` has ``stem, text``.
    """

    name: str
    images: DataFrame
    labels: DataFrame | None = None
    handmade: bool = False


def collect(source: Source) -> DataFrame:
    """Samples of one source: ``path, file, stem, text, handmade, content_key``."""
    keys = source.images.select("path", "content_key")
    if source.labels is None:
        joined = pool.last_image_per_stem(source.images).withColumn("text", F.lit(None).cast("string"))
    else:
        joined = pool.labelled_samples(source.images, source.labels)
    return joined.join(keys, "path").select(
        "path",
        F.substring_index("path", "/", -1).alias("file"),
        "stem",
        "text",
        F.lit(source.handmade).alias("handmade"),
        "content_key",
    )


def prelabel(frames: DataFrame, make_detector: Callable, column: str, *, min_confidence: float = 0.25, weak_below: float = 0.5) -> dict[str, DataFrame]:
    """Detections of every frame, clamped boxes, the frame report, and the review queue."""
    found = detect(frames, make_detector, column, min_confidence=min_confidence)
    sizes = frames.select("file", F.col("width").alias("frame_width"), F.col("height").alias("frame_height"))
    clamped = boxes.clamped_boxes(found.join(sizes, "file"))
    report = reports.frame_report(frames, clamped, weak_below=weak_below)
    return {"boxes": clamped, "report": report, "queue": reports.review_queue(report)}


def bundle(report: DataFrame, *, size: int = 600) -> DataFrame:
    """Review queue of a stored report, cut into numbered task parts."""
    return reports.bundles(reports.review_queue(report, decimals=4), size=size)


def build(human: DataFrame, confident: DataFrame, *, validation: float = 0.15, test: float = 0.15, seed: int = 0) -> DataFrame:
    """Human and confident samples, split by group and content, with the human part of the test.

    Both have ``file, text``.
    """
    both = human.select("file", "text", F.lit(True).alias("handmade")).unionByName(
        confident.select("file", "text", F.lit(False).alias("handmade"))
    )
    ready = both.withColumn("group", group_of(F.col("file"))).withColumn("filled", pool.has_boxes(F.col("text")))
    split = splits.stratified_split(ready, stratum=["group", "filled"], key="file", validation=validation, test=test, seed=seed)
    return splits.with_human_part(split, C.HUMAN_SPLIT)


def build_multi(
    sources: Sequence[Source], holdout: Source | None = None, *, validation: float = 0.15, test: float = 0.15, seed: int = 0
) -> dict[str, DataFrame]:
    """Several sources into one leak-free set, a foreign recording kept apart as hold-out.

    Duplicates go first inside each source, then across sources with earlier
    ones preferred; the rest is split by group and content, and augmented copies
    follow their originals.
    """
    keys = ["stem", "content_key"]
    own = [(s.name, pool.first_wins(collect(s), ["path"], keys)) for s in sources]
    pooled = pool.first_wins(pool.unite(own), ["priority", "path"], keys)
    ready = pooled.withColumn("group", group_of(F.col("file"))).withColumn("filled", pool.has_boxes(F.col("text")))
    split = splits.stratified_split(ready, stratum=["group", "filled"], key="path", validation=validation, test=test, seed=seed)
    split = splits.follow_originals(split)
    by_source = pool.unite(own).groupBy("source").agg(F.count("*").alias("frames"))
    if holdout is not None:
        away = collect(holdout).withColumn("source", F.lit(holdout.name)).withColumn("split", F.lit(C.HOLDOUT_SPLIT))
        split = split.unionByName(away, allowMissingColumns=True)
        by_source = by_source.unionByName(away.groupBy("source").agg(F.count("*").alias("frames")))
    return {"split": split, "counts": splits.split_counts(split), "by_source": by_source}


def handmade(
    samples: DataFrame, *, gap: float, span: float = 600.0, validation: float = 0.15, test: float = 0.15, seed: int = 0
) -> dict[str, DataFrame]:
    """Human-labelled frames split by whole scenes, stratified by group and density.

    ``samples`` has ``file, n_boxes``.  Validation and test lose augmented copies.
    """
    keyed = pin(scenes.scene_keys(samples.withColumns(video_moment(F.col("file"))), gap=gap, span=span))
    table = scenes.scene_table(keyed)
    placed = splits.stratified_split(table, stratum=["group", "density"], key="scene_key", validation=validation, test=test, seed=seed)
    frames = keyed.join(placed.select("scene_key", "group", "density", "split"), "scene_key")
    kept = splits.copies_only_in_train(frames)
    return {"scenes": placed, "split": kept, "tally": splits.tally(kept, ["group", "density"], C.SPLITS)}


def check(images: DataFrame, labels: DataFrame, *, parts: Sequence[str] = C.SPLITS) -> dict[str, DataFrame]:
    """Audit of a built set: findings, counts per kind, first examples, boxes per part."""
    found = audit.findings(images, labels, splits=parts)
    return {
        "findings": found,
        "counts": audit.finding_counts(found),
        "examples": audit.finding_examples(found),
        "boxes": audit.box_totals(images.filter(F.col("split").isin(*parts) & F.col("content").isNotNull()), labels),
    }


def preview(report: DataFrame, *, n: int = 48, seed: int = 0, columns: int = 4, rows: int = 3, only_empty: bool = False) -> DataFrame:
    """A random sample of frames laid out on sheets."""
    wanted = report.filter(F.col("boxes") == 0) if only_empty else report
    ranked = ordered_rank(sample_first(wanted.select("file"), "file", n, seed=seed), ["file"])
    cells = sheet_cell(F.col("rank"), columns=columns, rows=rows)
    return ranked.select("file", *[c.alias(k) for k, c in cells.items()])


def scan(frames: DataFrame, make_detector: Callable, column: str, *, min_confidence: float = 0.25) -> DataFrame:
    """Review stage one: numbered boxes with crop names."""
    found = detect(frames, make_detector, column, min_confidence=min_confidence)
    sizes = frames.select("file", F.col("width").alias("frame_width"), F.col("height").alias("frame_height"))
    shares = boxes.boxes_from_detections(found.join(sizes, "file"), min_confidence=min_confidence)
    ordered = shares.withColumn("_doubt", -F.col("confidence"))
    return boxes.named_crops(boxes.number_boxes(ordered, ["_doubt", "cx", "cy", "w", "h"]).drop("_doubt"))


def judge(boxes_: DataFrame, answers: DataFrame, make_client: Callable, column: str, *, probe: Callable[[], bool] | None = None, sessions: int | None = None) -> DataFrame:
    """Review stage two: ask about the boxes nobody has answered; append the result to the log."""
    if probe is not None:
        require_service(probe, "judge")
    asked = ask_service(review.pending_boxes(boxes_, answers), make_client, column, key="box_id", sessions=sessions)
    fields = parse_judge_reply(F.col("reply"), F.col("failure"))
    return asked.select("box_id", *[v.alias(k) for k, v in fields.items()], "seconds")


def sheets(settled: DataFrame, frames: DataFrame, *, columns: int = 8, rows: int = 6) -> dict[str, DataFrame]:
    """Review stage three: boxes of each category on sheets, and frames without boxes."""
    placed = review.category_order(settled)
    cells = sheet_cell(F.col("position"), columns=columns, rows=rows)
    return {
        "boxes": placed.select("category", "box_id", *[c.alias(k) for k, c in cells.items()]),
        "frames": review.frames_without_boxes(frames, settled),
    }


def apply_verdicts(frames: DataFrame, boxes_: DataFrame, answers: DataFrame, verdicts: DataFrame, *, empty_stride: int = 0) -> dict[str, DataFrame]:
    """Review stage four: fates, clean label lines, totals, and what a human must still see."""
    settled = kept(review.settle_boxes(boxes_, answers, verdicts), "settled")
    fates = kept(review.frame_fates(frames, settled, empty_stride=empty_stride), "fates")
    return {
        "settled": settled,
        "fates": fates,
        "lines": review.kept_lines(settled, fates),
        "disputed": review.disputed_lines(settled),
        "queue": review.human_queue(fates, empty_stride=empty_stride),
        "totals": review.fate_totals(fates),
        "unknown": audit.unknown_verdicts(verdicts),
    }


def import_export(fates: DataFrame, labels: DataFrame, queue: DataFrame, export: DataFrame) -> dict[str, DataFrame]:
    """Review stage five: a human export replaces labels and fates and shortens the queue."""
    return {
        "fates": review.overlay_export(fates, export),
        "labels": review.merge_labels(labels, export),
        "queue": review.still_pending(queue, export),
        "totals": review.export_totals(export),
    }


def negatives(frames: DataFrame, skip: DataFrame, *, group: str = "truck", seed: int = 0) -> DataFrame:
    """Numbered names for frames known to show nothing, and the plan of their mirrored copies."""
    numbered = pool.numbered_negatives(frames, skip)
    plan = augment.augmentation_plan(frames, seed=seed).drop("copy")
    name = F.format_string(f"{group}_%05d", F.col("number"))
    return numbered.join(plan, "file").select(
        "file", name.alias("stem"), F.concat(name, F.lit("_aug")).alias("copy_stem"), *[c for c in plan.columns if c != "file"]
    )


def evaluate(predictions: DataFrame, truths: DataFrame, *, part: str = "split") -> DataFrame:
    """Detection quality per part of the set."""
    return boxes.detection_quality(predictions, truths, part=part)


def store_review(result: dict[str, DataFrame], path: str, *, empty_stride: int = 0) -> None:
    """Write what :func:`apply_verdicts` settled: fates, queue, label lines, and the lines of disputed frames for a human.

    Lines meet the frames they are written for directly, in one join each.
    """
    sinks.write_fates(review.with_notes(result["fates"], empty_stride=empty_stride), result["queue"], path)
    lines = result["settled"].select("file", "index", "fate", review.box_line().alias("line"))
    fates, waiting = result["fates"], F.col("status").isin(C.FATE_DISPUTED, C.FATE_NO_BOXES)
    sinks.write_label_texts(lines.filter(F.col("fate") == C.KEEP), fates.filter(~waiting), f"{path}/labels")
    sinks.write_label_texts(lines.filter(F.col("fate") != C.DROP), fates.filter(F.col("status") == C.FATE_DISPUTED), f"{path}/disputed")
