"""Row numbers that never put a whole table, or one hot group, into one task.

``row_number`` over a group runs in a single task per group.  Both functions
here number rows in two levels instead: inside small slices first, then with
the offset of each slice, taken from a table of slice sizes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from framewright.functions.chance import shuffle_key
from framewright.session import kept

_BEFORE = (W.unboundedPreceding, -1)
_POSITION_BITS = (1 << 33) - 1


def _offsets(tally: DataFrame, groups: Sequence[str], order: str) -> DataFrame:
    window = W.partitionBy(*groups).orderBy(order).rowsBetween(*_BEFORE)
    return tally.withColumn("_offset", F.coalesce(F.sum("_n").over(window), F.lit(0)))


def shuffled_rank(
    df: DataFrame, key: str, *, groups: Sequence[str] = (), seed: int | str = 0, rank: str = "rank", digits: int = 3
) -> DataFrame:
    """Random but repeatable rank from 1 in each group, and the group size in ``<rank>_of``.

    Rows are ordered by a hash of seed and key.  The first hex digits of that
    hash cut a group into even slices, however large the group is.  Group
    columns must not be null.
    """
    marked = df.withColumn("_hash", shuffle_key(seed, key)).withColumn("_slice", F.substring("_hash", 1, digits))
    by = [*groups, "_slice"]
    tally = _offsets(marked.groupBy(*by).agg(F.count("*").alias("_n")), groups, "_slice")
    tally = tally.withColumn("_size", F.sum("_n").over(W.partitionBy(*groups))).drop("_n")
    inside = F.row_number().over(W.partitionBy(*by).orderBy("_hash", key))
    return (
        marked.withColumn("_local", inside)
        .join(tally, by)
        .withColumn(rank, F.col("_offset") + F.col("_local"))
        .withColumn(f"{rank}_of", F.col("_size"))
        .drop("_hash", "_slice", "_local", "_offset", "_size")
    )


def ordered_rank(
    df: DataFrame, order: Sequence[str | Column], *, groups: Sequence[str] = (), rank: str = "rank", overall: str | None = None
) -> DataFrame:
    """Rank from 1 by a total order, in the whole table or in each group.

    ``overall`` names a second rank, over the whole table ordered by groups and
    order, which the same range shuffle gives.

    A range shuffle sorts the table over many tasks; a group that is too large
    for one range spreads over several.  The placed rows are kept once, packed, so
    that counting them and numbering them see the same ranges.
    """
    cols = [F.col(c) if isinstance(c, str) else c for c in (*groups, *order)]
    placed = (
        df.repartitionByRange(*cols)
        .sortWithinPartitions(*cols)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_BITS)))
    )
    placed = kept(placed, "ranked")
    if overall:
        parts = placed.groupBy("_part").agg(F.count("*").alias("_n"), F.min("_place").alias("_first"))
        parts = _offsets(parts, (), "_part").select("_part", "_first", F.col("_offset").alias("_ahead"))
        placed = placed.join(F.broadcast(parts), "_part")  # one row per range
        placed = placed.withColumn(overall, F.col("_ahead") + F.col("_place") - F.col("_first") + 1).drop("_ahead", "_first")
    by = ["_part", *groups]
    tally = placed.groupBy(*by).agg(F.count("*").alias("_n"), F.min("_place").alias("_start"))
    tally = _offsets(tally, groups, "_part").drop("_n")
    if not groups:
        tally = F.broadcast(tally)  # one row per range
    return (
        placed.join(tally, by)
        .withColumn(rank, F.col("_offset") + F.col("_place") - F.col("_start") + 1)
        .drop("_part", "_place", "_start", "_offset")
    )


def chunk_number(rank: Column, size: int) -> Column:
    """Number, from 1, of the fixed-size chunk a rank falls into."""
    return F.floor((rank - 1) / F.lit(size)) + 1


def sheet_cell(rank: Column, *, columns: int, rows: int) -> dict[str, Column]:
    """Sheet, row and column of a ranked item, all from 1."""
    page = columns * rows
    place = F.pmod(rank - 1, F.lit(page))
    return {
        "sheet": chunk_number(rank, page),
        "row": F.floor(place / F.lit(columns)) + 1,
        "column": F.pmod(place, F.lit(columns)) + 1,
    }


def sample_first(df: DataFrame, key: str, n: int, *, seed: int | str = 0) -> DataFrame:
    """Repeatable random sample of ``n`` rows: a distributed top-k on the hash."""
    return df.withColumn("_hash", shuffle_key(seed, key)).orderBy("_hash", key).limit(n).drop("_hash")


def first_listed(df: DataFrame, order: str, n: int) -> DataFrame:
    """First ``n`` rows of a listing; 0 keeps them all."""
    return df.orderBy(order).limit(n) if n else df
