"""Sample pools: labels meet images, sources unite, duplicates go."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.functions.geometry import stem
from framewright.operators.greedy import first_numbers
from framewright.operators.ranking import ordered_rank
from framewright.operators.review import every_kth
from framewright.session import pin


def has_boxes(text: Column) -> Column:
    """Any non-blank line; a missing label has none."""
    return F.coalesce(text.rlike(r"\S"), F.lit(False))


def last_image_per_stem(images: DataFrame) -> DataFrame:
    """Images keyed by stem; of several paths with one stem the last in path order wins."""
    return images.groupBy(stem(F.col("path")).alias("stem")).agg(F.max("path").alias("path"))


def labelled_samples(images: DataFrame, labels: DataFrame, *, negative_source: bool = False) -> DataFrame:
    """Images with their label text.

    A frame without a label is unlabelled and left out, unless its source is
    known to show nothing: then the missing label reads as an empty one.
    """
    keyed = last_image_per_stem(images)
    if negative_source:
        joined = keyed.join(labels.select("stem", "text"), "stem", "left")
        return joined.withColumn("text", F.coalesce("text", F.lit("")))
    return labels.select("stem", "text").join(keyed, "stem")


def confident_samples(names: DataFrame, images: DataFrame, labels: DataFrame) -> DataFrame:
    """Confident frames whose image and label are really there."""
    listed = images.select(F.substring_index("path", "/", -1).alias("file"))
    return (
        names.withColumn("stem", stem(F.col("file")))
        .join(listed, "file", "left_semi")
        .join(labels.select("stem"), "stem", "left_semi")
    )


def unite(pools: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Union of named pools; earlier pools have priority."""
    tagged = [
        df.withColumn("source", F.lit(name)).withColumn("priority", F.lit(place))
        for place, (name, df) in enumerate(pools)
    ]
    united = tagged[0]
    for df in tagged[1:]:
        united = united.unionByName(df, allowMissingColumns=True)
    return united


def content_key(content: Column) -> Column:
    """Size and digest of a whole content."""
    return F.concat_ws(":", F.octet_length(content), F.sha2(content.cast("binary"), 256))


def first_wins(df: DataFrame, order: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Ordered dedupe on several keys at once; a dropped row reserves nothing.

    A row stays iff no earlier *kept* row shares any key with it.  Rows are
    numbered in their order by a range shuffle and settled in blocks of it
    (:mod:`framewright.operators.greedy`): no list of rows per key or per chain,
    so neither a key shared by a third of the table nor a chain of any length
    lands in one task.  ``order`` must be unique and not null; null keys never
    meet.
    """
    placed = df.select(F.struct(*order).alias("_at"), *keys).repartitionByRange("_at").sortWithinPartitions("_at")
    placed = pin(placed.withColumn("_no", F.monotonically_increasing_id()))
    kept = placed.join(first_numbers(placed, keys), "_no", "left_semi")
    return df.join(kept.select("_at.*"), list(order), "left_semi")


def thin_negatives(labels: DataFrame, *, stride: int, prefix: str = "") -> DataFrame:
    """Every ``stride``-th empty frame in name order; frames with boxes all stay."""
    named = labels.filter(F.col("stem").startswith(prefix))
    filled = has_boxes(F.col("text"))
    return named.filter(filled).unionByName(every_kth(named.filter(~filled), "stem", stride))


def holdout(labels: DataFrame, prefix: str) -> DataFrame:
    return labels.filter(F.col("stem").startswith(prefix))


def without_skipped(df: DataFrame, skip: DataFrame) -> DataFrame:
    """Leave out the files of a skip list."""
    return df.join(skip.select("file"), "file", "left_anti")


def numbered_negatives(files: DataFrame, skip: DataFrame) -> DataFrame:
    """Numbers by place in the whole listing; skipped files leave gaps."""
    return without_skipped(ordered_rank(files.select("file"), ["file"], rank="number"), skip)
