"""Box review: model answers and human verdicts settle the fate of boxes and frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright import schemas as C
from framewright.functions.geometry import label_line, stem
from framewright.operators.ranking import ordered_rank


def last_answers(answers: DataFrame) -> DataFrame:
    """Last answer per box: the log is append-only and a later line wins."""
    latest = F.max(F.struct("answered_at", "category"))
    return answers.groupBy("box_id").agg(latest.alias("_a")).select("box_id", F.col("_a.category").alias("category"))


def last_verdicts(verdicts: DataFrame) -> DataFrame:
    """Last human word per box, by ``given_at``."""
    latest = F.max(F.struct("given_at", "verdict"))
    return verdicts.groupBy("box_id").agg(latest.alias("_v")).select("box_id", F.col("_v.verdict").alias("human"))


def box_fate(human: Column, category: Column, *, error_as_unanswered: bool = True) -> Column:
    """Human word first, then the model's category; an unanswered box is disputed."""
    answered = F.when(category != C.CATEGORY_ERROR, category) if error_as_unanswered else category
    model = (
        F.when(answered.isNull(), F.lit(C.DISPUTED))
        .when(answered.isin(*C.KEPT_CATEGORIES), F.lit(C.KEEP))
        .otherwise(F.lit(C.DROP))
    )
    return F.coalesce(F.nullif(human, F.lit("")), model)


def settle_boxes(
    boxes: DataFrame, answers: DataFrame, verdicts: DataFrame, *, error_as_unanswered: bool = True
) -> DataFrame:
    """Boxes with their category, human word and fate.

    All three tables meet on ``box_id``, so the three sides share one
    partitioning; Spark broadcasts a side only where its statistics allow it.
    """
    return (
        boxes.join(last_answers(answers), "box_id", "left")
        .join(last_verdicts(verdicts), "box_id", "left")
        .withColumn("fate", box_fate(F.col("human"), F.col("category"), error_as_unanswered=error_as_unanswered))
    )


def frame_fates(frames: DataFrame, settled: DataFrame, *, empty_stride: int = 0) -> DataFrame:
    """One fate per frame, with box counts before and after.

    With a stride, every ``empty_stride``-th boxless frame in name order is
    taken as a negative; without one all of them wait for a human.
    """
    per_file = settled.groupBy("file").agg(
        F.count("*").alias("boxes_before"),
        F.count_if(F.col("fate") == C.KEEP).alias("_kept"),
        F.bool_or(F.col("fate") == C.DISPUTED).alias("_disputed"),
    )
    joined = frames.select("file").join(per_file, "file", "left").fillna({"boxes_before": 0, "_kept": 0})
    before, kept = F.col("boxes_before"), F.col("_kept")
    status = (
        F.when(before == 0, F.lit(C.FATE_NO_BOXES))
        .when(F.col("_disputed"), F.lit(C.FATE_DISPUTED))
        .when(kept == 0, F.lit(C.FATE_NEGATIVE))
        .when(kept == before, F.lit(C.FATE_CLEAN))
        .otherwise(F.lit(C.FATE_FIXED))
    )
    after = F.when(F.col("_disputed"), F.lit(0)).otherwise(kept)
    fates = joined.select("file", status.alias("status"), "boxes_before", after.cast("long").alias("boxes_after"))
    if not empty_stride:
        return fates
    chosen = every_kth(fates.filter(F.col("status") == C.FATE_NO_BOXES), "file", empty_stride)
    negative = chosen.select("file", F.lit(True).alias("_negative"))
    return (
        fates.join(negative, "file", "left")
        .withColumn("status", F.when(F.col("_negative"), F.lit(C.FATE_NEGATIVE)).otherwise(F.col("status")))
        .drop("_negative")
    )


def every_kth(df: DataFrame, order: str, stride: int) -> DataFrame:
    """Every ``stride``-th row in the given order; a stride of 1 or less keeps all."""
    if stride <= 1:
        return df
    ranked = ordered_rank(df, [order], rank="_nth")
    return ranked.filter(F.pmod(F.col("_nth"), F.lit(stride)) == 0).drop("_nth")


def with_notes(fates: DataFrame, *, empty_stride: int = 0, export: str | None = None) -> DataFrame:
    """Adds why a frame got its fate."""
    status, bare = F.col("status"), F.col("boxes_before") == 0
    waiting = "nothing detected, skipped" if empty_stride else "nothing detected, a human looks"
    note = (
        F.when(status == C.FATE_DISPUTED, F.lit("disputed box, a human decides"))
        .when(status == C.FATE_NO_BOXES, F.lit(waiting))
        .when((status == C.FATE_NEGATIVE) & bare, F.lit("nothing detected, taken as a negative"))
        .otherwise(F.lit(""))
    )
    if export is not None:
        note = F.when(F.col("from_export"), F.lit(f"labels from {export}")).otherwise(note)
    return fates.withColumn("note", note)


def fate_totals(fates: DataFrame) -> DataFrame:
    """Frames and boxes per fate."""
    return fates.groupBy("status").agg(
        F.count("*").alias("frames"),
        F.sum("boxes_before").alias("boxes_before"),
        F.sum("boxes_after").alias("boxes_after"),
    )


def human_queue(fates: DataFrame, *, empty_stride: int = 0) -> DataFrame:
    """Frames a human has to look at after the verdicts were applied."""
    waiting = [C.FATE_DISPUTED] if empty_stride else [C.FATE_DISPUTED, C.FATE_NO_BOXES]
    return fates.filter(F.col("status").isin(*waiting)).select("file", "status")


def pending_boxes(boxes: DataFrame, answers: DataFrame) -> DataFrame:
    """Boxes nobody has answered yet."""
    return boxes.join(answers, "box_id", "left_anti")


def frames_without_boxes(frames: DataFrame, boxes: DataFrame) -> DataFrame:
    return frames.join(boxes, "file", "left_anti")


def answers_by_category(answers: DataFrame) -> DataFrame:
    return answers.groupBy("category").agg(F.count("*").alias("answers"))


def category_order(settled: DataFrame) -> DataFrame:
    """Boxes of each category from the least confident: rank inside the category."""
    keyed = settled.select("box_id", F.coalesce("category", F.lit("unanswered")).alias("category"), "confidence")
    return ordered_rank(keyed, ["confidence", "box_id"], groups=["category"], rank="position")


def kept_lines(settled: DataFrame, fates: DataFrame) -> DataFrame:
    """Label lines of the frames that are settled; negatives keep a row without lines.

    Long form, one row per line with its place in the file: a frame with very
    many boxes is never gathered into one value.
    """
    done = fates.filter(F.col("status").isin(C.FATE_CLEAN, C.FATE_FIXED, C.FATE_NEGATIVE)).select("file")
    lines = settled.filter(F.col("fate") == C.KEEP).select("file", "index", "box_id", box_line().alias("line"))
    return done.join(lines, "file", "left").withColumn("stem", stem(F.col("file")))


def disputed_lines(settled: DataFrame) -> DataFrame:
    """Lines of frames with a disputed box: every box that was not dropped."""
    disputed = settled.filter(F.col("fate") == C.DISPUTED).select("file").distinct()
    return (
        settled.filter(F.col("fate") != C.DROP)
        .join(disputed, "file", "left_semi")
        .select("file", "index", "box_id", box_line().alias("line"))
    )


def box_line() -> Column:
    """Label line of a row of boxes."""
    return label_line(F.col("center_x"), F.col("center_y"), F.col("width"), F.col("height"))


def filled_lines(text: Column) -> Column:
    """Non-blank lines of a label text."""
    return F.filter(F.split(text, r"\r?\n"), lambda line: F.btrim(line, F.lit(" \t\r\f")) != "")


def overlay_export(fates: DataFrame, export: DataFrame) -> DataFrame:
    """A human export (``stem``, ``text``) replaces fate and count of its frames.

    An empty text means the human saw nothing: the frame becomes a negative.
    """
    found = export.select("stem", F.size(filled_lines(F.col("text"))).cast("long").alias("_lines"))
    lines = F.col("_lines")
    status = F.when(lines.isNull(), F.col("status")).when(lines == 0, F.lit(C.FATE_NEGATIVE))
    return (
        fates.withColumn("stem", stem(F.col("file")))
        .join(found, "stem", "left")
        .select(
            "file",
            status.otherwise(F.lit(C.FATE_FROM_EXPORT)).alias("status"),
            "boxes_before",
            F.coalesce(lines, F.col("boxes_after")).alias("boxes_after"),
            lines.isNotNull().alias("from_export"),
        )
    )


def export_totals(export: DataFrame) -> DataFrame:
    """Frames, boxes and empty frames of an export."""
    lines = F.size(filled_lines(F.col("text")))
    return export.agg(
        F.count("*").alias("frames"),
        F.coalesce(F.sum(lines), F.lit(0)).cast("long").alias("boxes"),
        F.count_if(lines == 0).alias("empty"),
    )


def merge_labels(labels: DataFrame, export: DataFrame) -> DataFrame:
    """Label texts after an export: its stems replace the old ones whole."""
    old = labels.select("stem", "text").join(export, "stem", "left_anti")
    return old.unionByName(export.select("stem", "text"))


def still_pending(queue: DataFrame, export: DataFrame) -> DataFrame:
    """The human queue without the frames an export brought back."""
    return queue.withColumn("stem", stem(F.col("file"))).join(export, "stem", "left_anti").drop("stem")
