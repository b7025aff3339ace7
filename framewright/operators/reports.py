"""Frame reports: box statistics per frame, status, review order, bundles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright import schemas as C
from framewright.operators.ranking import chunk_number, ordered_rank


def frame_status(boxes: Column, min_confidence: Column, weak_below: float) -> Column:
    return (
        F.when(boxes == 0, F.lit(C.STATUS_EMPTY))
        .when(min_confidence < weak_below, F.lit(C.STATUS_WEAK))
        .otherwise(F.lit(C.STATUS_OK))
    )


def frame_report(frames: DataFrame, boxes: DataFrame, *, weak_below: float = 0.5) -> DataFrame:
    """Boxes, least and greatest confidence, and status of every frame, boxless ones included."""
    per_file = boxes.groupBy("file").agg(
        F.count("*").alias("boxes"),
        F.min("confidence").alias("min_confidence"),
        F.max("confidence").alias("max_confidence"),
    )
    return (
        frames.select("file", "width", "height")
        .join(per_file, "file", "left")
        .fillna({"boxes": 0, "min_confidence": 0.0, "max_confidence": 0.0})
        .withColumn("status", frame_status(F.col("boxes"), F.col("min_confidence"), weak_below))
    )


def zero_filled_counts(df: DataFrame, column: str, values: tuple[str, ...]) -> DataFrame:
    """Rows per listed value; values nobody has count 0."""
    tallies = df.agg(*[F.count_if(F.col(column) == v).alias(f"_{i}") for i, v in enumerate(values)])
    pairs = [F.struct(F.lit(v).alias(column), F.col(f"_{i}").alias("frames")) for i, v in enumerate(values)]
    return tallies.select(F.inline(F.array(*pairs)))


def needs_human(report: DataFrame) -> DataFrame:
    return report.filter(F.col("status") != C.STATUS_OK)


def confident(report: DataFrame) -> DataFrame:
    return report.filter(F.col("status") == C.STATUS_OK)


def review_queue(report: DataFrame, *, decimals: int | None = None) -> DataFrame:
    """Frames for a human in order: empty ones by name, then weak ones from the least confident.

    ``decimals`` reproduces the order of the stored report, whose confidences
    are rounded.
    """
    conf = F.col("min_confidence")
    conf = conf if decimals is None else F.bround(conf, decimals)
    queue = needs_human(report).select(
        "file",
        "status",
        conf.alias("min_confidence"),
        F.when(F.col("status") == C.STATUS_EMPTY, 0).otherwise(1).alias("_class"),
        F.when(F.col("status") == C.STATUS_WEAK, conf).otherwise(F.lit(0.0)).alias("_doubt"),
    )
    return ordered_rank(queue, ["_class", "_doubt", "file"], rank="position").drop("_class", "_doubt")


def bundles(queue: DataFrame, *, size: int = 600) -> DataFrame:
    """Cut a ranked queue into numbered parts."""
    return queue.withColumn("part", chunk_number(F.col("position"), size))
