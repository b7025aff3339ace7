"""Shared helpers of the text operators: stored tables, Arrow columns as bytes, sizes of shuffles."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.session import scratch_path

#: The characters between words: blank, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives executors, has a known size."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 of a string column; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def as_text(column: pa.Array | pa.ChunkedArray) -> list[str]:
    """Strings of a string column; null is empty."""
    return [x or "" for x in column.to_pylist()]


def whole(batches: Iterable[pa.RecordBatch]) -> pa.Table | None:
    """All rows of one task.  For partitions that the caller has sized."""
    batches = list(batches)
    return pa.Table.from_batches(batches) if batches else None


def packed(columns: dict[str, list], schema: pa.Schema, rows: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Record batches of bounded length from whole columns."""
    whole_table = pa.table(columns, schema=schema)
    yield from whole_table.to_batches(max_chunksize=rows)


def parts_for(spark: SparkSession, rows: int, rows_per_part: int) -> int:
    """Shuffle width at which a task holds about ``rows_per_part`` rows; never below the session's width."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_per_part))


def only(df: DataFrame, *names: str) -> DataFrame:
    """These columns of a table, whatever else it has."""
    return df.select(*[F.col(f"`{n}`") for n in names])


#: A blank of another kind before a space: such texts aren't cut at their spaces.
_ODD = re.compile(r"[^\S ] ")


def spaced(text: str) -> list[str] | None:
    """The text cut before its single spaces, or None where some space isn't the start of a match.

    Byte-level pre-tokenisers put a space in one match with what follows, so a text whose blanks don't touch its spaces can be
    cut there and its pieces looked up one by one.
    """
    if "  " in text or _ODD.search(text):
        return None
    return text.split(" ")
