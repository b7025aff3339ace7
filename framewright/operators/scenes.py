"""Scenes: runs of video frames without a long gap, and stills with their copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from framewright.functions.naming import group_of, without_copy_suffix


def number_scenes(frames: DataFrame, *, gap: float, span: float = 600.0) -> DataFrame:
    """Adds ``scene``, counted from 1 in each recording: a gap of ``gap`` seconds or more starts a new one.

    Needs ``recording``, ``seconds`` and ``file``.  A long recording is cut into
    spans of ``span`` seconds, so one task sees at most the frames of one span;
    the scene count carries over through a table of one row per span.
    """
    by = ["recording", "_span"]
    inside = W.partitionBy(*by).orderBy("seconds", "file")
    before = F.lag("seconds").over(inside)
    cut = F.coalesce(F.col("seconds") - before >= gap, F.lit(False)).cast("long")
    marked = frames.withColumn("_span", F.floor(F.col("seconds") / F.lit(span))).withColumn("_cut", cut)
    marked = marked.withColumn("_inner", F.sum("_cut").over(inside))

    spans = marked.groupBy(*by).agg(
        F.min("seconds").alias("_first"), F.max("seconds").alias("_last"), F.sum("_cut").alias("_cuts")
    )
    along = W.partitionBy("recording").orderBy("_span")
    opens = F.coalesce(F.col("_first") - F.lag("_last").over(along) >= gap, F.lit(True)).cast("long")
    spans = spans.withColumn("_opens", opens)
    base = F.sum("_opens").over(along) + F.coalesce(
        F.sum("_cuts").over(along.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
    )
    spans = spans.select(*by, base.alias("_base"))
    return (
        marked.join(spans, by)
        .withColumn("scene", F.col("_base") + F.col("_inner"))
        .drop("_span", "_cut", "_inner", "_base")
    )


def scene_keys(samples: DataFrame, *, gap: float, span: float = 600.0) -> DataFrame:
    """Adds ``scene_key`` to samples with ``file``, ``recording`` and ``seconds`` (null for stills)."""
    video = samples.filter(F.col("seconds").isNotNull())
    stills = samples.filter(F.col("seconds").isNull())
    named = number_scenes(video, gap=gap, span=span).withColumn(
        "scene_key", F.concat(F.lit("video:"), F.col("recording").cast("string"), F.lit(":"), F.col("scene"))
    )
    return named.drop("scene").unionByName(
        stills.withColumn("scene_key", F.concat(F.lit("still:"), without_copy_suffix(F.col("file"))))
    )


def density(mean_boxes: Column) -> Column:
    """How full the frames of a scene are, on average."""
    return (
        F.when(mean_boxes < 0.5, F.lit("0"))
        .when(mean_boxes < 1.5, F.lit("1"))
        .when(mean_boxes < 3.5, F.lit("2-3"))
        .otherwise(F.lit("4+"))
    )


def scene_table(keyed: DataFrame) -> DataFrame:
    """One row per scene: frames, first frame, its group, mean boxes and density (needs ``n_boxes``)."""
    scenes = keyed.groupBy("scene_key").agg(
        F.count("*").alias("frames"),
        F.min(F.struct(F.coalesce("seconds", F.lit(0.0)).alias("seconds"), "file")).alias("_lead"),
        F.avg("n_boxes").alias("mean_boxes"),
    )
    return scenes.select(
        "scene_key",
        "frames",
        F.col("_lead.file").alias("first_file"),
        group_of(F.col("_lead.file")).alias("group"),
        "mean_boxes",
        density(F.col("mean_boxes")).alias("density"),
    )
