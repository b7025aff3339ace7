"""Sinks.  Numeric formats are part of the contract: confidences have four decimals, shares six."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from framewright.functions.decimals import fixed
from framewright.functions.geometry import stem
from framewright.session import kept

#: Lines of one frame that one task writes into a bundle.
BUNDLE_LINES = 100_000


def formatted(df: DataFrame, decimals: dict[str, int]) -> DataFrame:
    """Numbers as text with a fixed count of decimals."""
    return df.withColumns({c: fixed(F.col(c), n) for c, n in decimals.items()})


def write_csv(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    """Every text comes back from ``files.read_table`` as it was: white space at its ends, empty texts, control characters and all."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, StringType)]
    escaped = {c: F.when(F.col(c).rlike(r"^\\+N\z"), F.concat(F.lit("\\"), c)).otherwise(F.col(c)) for c in texts}
    whole = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}  # Spark's writer would trim
    df.withColumns(escaped).write.mode(mode).options(header=True, quote='"', escape='"', **whole).csv(path)


def write_report(report: DataFrame, path: str) -> None:
    write_csv(formatted(report, {"min_confidence": 4, "max_confidence": 4}), path)


def write_boxes(boxes: DataFrame, path: str) -> None:
    """Boxes table with area share and crop name."""
    wide = boxes.withColumn("area_share", F.col("width") * F.col("height"))
    wide = wide.withColumn("crop", F.concat(stem(F.col("file")), F.lit("__"), F.col("index").cast("string"), F.lit(".jpg")))
    shares = dict.fromkeys(("center_x", "center_y", "width", "height", "area_share"), 6)
    write_csv(formatted(wide, shares | {"confidence": 4}), path)


def write_label_texts(lines: DataFrame, frames: DataFrame, path: str) -> None:
    """Label lines by frame, sorted; every frame has at least one row, an empty one a null line.

    The joined rows are kept first: a range shuffle reads its input twice, once for the bounds.
    """
    rows = kept(frames.select("file").join(lines.select("file", "index", "line"), "file", "left"), "label-lines")
    rows.repartitionByRange("file", "index").sortWithinPartitions("file", "index").write.mode("overwrite").parquet(path)


def write_review_list(queue: DataFrame, path: str) -> None:
    """Text lines ``status⇥confidence⇥file`` in review order (``position`` ranks them)."""
    line = F.concat_ws("\t", "status", fixed(F.col("min_confidence"), 2), "file")
    placed = queue.select("position", line.alias("value")).repartitionByRange("position")
    placed.sortWithinPartitions("position").select("value").write.mode("overwrite").text(path)


def write_fates(fates: DataFrame, queue: DataFrame, path: str) -> None:
    """Frame fates and the list of frames a human has to see."""
    write_csv(fates, f"{path}/frames")
    write_csv(queue, f"{path}/queue")


def write_split(samples: DataFrame, path: str) -> None:
    """Manifest of a split, one folder per part.

    The whole tree is replaced, so no frame of an older build stays behind; a
    frame without label gets an empty text.  Parts differ in size, so Spark
    rebalances them into files of even size.
    """
    ready = samples.withColumn("text", F.coalesce("text", F.lit("")))
    ready.hint("rebalance", "split").write.mode("overwrite").partitionBy("split").parquet(path)


def append_answers(answers: DataFrame, path: str) -> None:
    """Add answers to the log; readers take the last answer per box."""
    answers.withColumn("answered_at", F.unix_micros(F.current_timestamp())).write.mode("append").parquet(path)


def write_bundles(queue: DataFrame, lines: DataFrame, path: str, *, class_name: str = "ad_object") -> None:
    """Task parts for people: frames and their lines, one folder per part.

    Rows are dealt by part, with no pass for the bounds of ranges, to as many tasks as the session shuffles to: files cost more time
    than bytes.  Lines of a frame beyond ``BUNDLE_LINES`` go to another task.
    """
    width = int(queue.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    frames = queue.select("part", "position", "file").join(lines.select("file", "index", "line"), "file", "left")
    named = frames.withColumn("class_name", F.lit(class_name))
    beyond = F.coalesce(F.floor(F.col("index") / BUNDLE_LINES), F.lit(0))
    named.repartition(width, "part", beyond).write.mode("overwrite").partitionBy("part").parquet(path)


def write_predictions(predictions: DataFrame, path: str, probabilities: Sequence[str]) -> None:
    write_csv(formatted(predictions, dict.fromkeys(("confidence", *probabilities), 4)), path)


def write_probe(probe: DataFrame, folder: str) -> None:
    """Labels of a probe set beside its frames: ``labels`` with ``file, brand, source``."""
    write_csv(probe.select("file", "brand", "source"), f"{folder.rstrip('/')}/labels")


def write_blinded(blinded: DataFrame, folder: str) -> str:
    """Names that go to the judges in ``folder``, and the key that leads back beside it, not in it; returns the key's path."""
    base = folder.rstrip("/")
    write_csv(blinded.select("file").sort("file"), f"{base}/files")
    write_csv(blinded.select("file", "brand", "source", "quality", "original"), f"{base}_key")
    return f"{base}_key"
