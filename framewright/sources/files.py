"""Image and label files as tables; listings never read file contents."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from framewright import schemas as C
from framewright.functions.geometry import stem
from framewright.sources import tree

# Fixed value: image suffixes in any case.
IMAGE_GLOB = "*.{[jJ][pP][gG],[jJ][pP][eE][gG],[pP][nN][gG],[wW][eE][bB][pP]}"
BLEND_WHITE = 255.0


def _folder(spark: SparkSession, folder: str) -> str:
    """Fail early on a folder that is not there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        raise FileNotFoundError(folder)
    return folder


def _plain(path: str = "path"):
    return F.regexp_replace(path, "^file:/+", "/")


def list_images(spark: SparkSession, folder: str, *, recursive: bool = False) -> DataFrame:
    """Image files of a folder: ``path, file, stem, suffix, length``; contents stay unread."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", IMAGE_GLOB)
        .option("recursiveFileLookup", str(recursive).lower())
        .load(_folder(spark, folder))
    )
    name = F.substring_index("path", "/", -1)
    return files.select(
        _plain().alias("path"),
        name.alias("file"),
        stem(F.col("path")).alias("stem"),
        F.lower(F.element_at(F.split(name, r"\."), -1)).alias("suffix"),
        "length",
    )


def image_contents(spark: SparkSession, folder: str, *, recursive: bool = True) -> DataFrame:
    """Bytes of image files, for content keys."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", IMAGE_GLOB)
    files = files.option("recursiveFileLookup", str(recursive).lower()).load(_folder(spark, folder))
    return files.select(_plain().alias("path"), "length", "content")


def read_images(spark: SparkSession, folder: str, *, recursive: bool = True) -> DataFrame:
    """Decoded images ``path, height, width, channels, data``; unreadable files have ``readable`` false."""
    reader = spark.read.format("image").option("pathGlobFilter", IMAGE_GLOB)
    images = reader.option("recursiveFileLookup", str(recursive).lower()).load(_folder(spark, folder))
    image = "image"
    return images.select(
        _plain(f"{image}.origin").alias("path"),
        F.col(f"{image}.height").alias("height"),
        F.col(f"{image}.width").alias("width"),
        F.col(f"{image}.nChannels").alias("channels"),
        (F.col(f"{image}.height") > 0).alias("readable"),
        F.col(f"{image}.data").alias("data"),
    )


def image_pixels(images: DataFrame) -> DataFrame:
    """Pixels ``img, x, y, width, height, r, g, b`` of readable images.

    Grey images become three equal channels; transparency is laid on white.
    """

    def spread(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for row in part.itertuples(index=False):
                raw = np.frombuffer(row.data, dtype=np.uint8).reshape(row.height, row.width, row.channels)
                if row.channels == 1:
                    raw = np.repeat(raw, 3, axis=2)
                elif row.channels == 4:
                    alpha = raw[:, :, 3:].astype(np.float32) / 255.0
                    raw = (raw[:, :, :3] * alpha + BLEND_WHITE * (1.0 - alpha)).astype(np.uint8)
                y, x = np.divmod(np.arange(row.height * row.width), row.width)
                flat = raw.reshape(-1, 3)
                yield pd.DataFrame(
                    {
                        "img": row.path, "x": x.astype(np.int32), "y": y.astype(np.int32),
                        "width": np.int32(row.width), "height": np.int32(row.height),
                        "r": flat[:, 2].astype(np.int32), "g": flat[:, 1].astype(np.int32), "b": flat[:, 0].astype(np.int32),
                    }
                )

    good = images.filter("readable").select("path", "height", "width", "channels", "data")
    return good.mapInPandas(spread, "img string, x int, y int, width int, height int, r int, g int, b int")


def _label_globs(spark: SparkSession, folder: str, recursive: bool) -> list[str]:
    """Patterns of all depths that hold label files."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    system = jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(conf)
    found, level = [], folder.rstrip("/")
    while system.globStatus(jvm.org.apache.hadoop.fs.Path(f"{level}/*")):
        if system.globStatus(jvm.org.apache.hadoop.fs.Path(f"{level}/*.txt")):
            found.append(f"{level}/*.txt")
        if not recursive:
            break
        level += "/*"
    return found


def read_label_files(spark: SparkSession, folder: str, *, recursive: bool = True) -> DataFrame:
    """Label files as ``path, stem, text``, sub-folders included.

    An empty file says "nothing here" and must stay a row.  The DataFrame file
    readers skip files of length zero, so the tasks list and read the tree
    (:mod:`framewright.sources.tree`).  In stores that only Spark's own readers
    know, whole text files are read by patterns of every depth.
    """
    if tree.reachable(_folder(spark, folder)):
        found = tree.read_tree(spark, folder, (".txt",), recursive=recursive)
        return found.select("path", stem(F.col("path")).alias("stem"), F.col("content").cast("string").alias("text"))
    globs = _label_globs(spark, _folder(spark, folder), recursive)
    if not globs:
        return spark.createDataFrame([], "path string, stem string, text string")
    sc, encoders = spark.sparkContext, spark._jvm.org.apache.spark.sql.Encoders
    pairs = sc._jsc.wholeTextFiles(",".join(globs), 4 * sc.defaultParallelism)
    rows = spark._jsparkSession.createDataset(pairs.rdd(), encoders.tuple(encoders.STRING(), encoders.STRING()))
    files = DataFrame(rows.toDF(), spark).toDF("path", "text")
    return files.select(_plain().alias("path"), stem(F.col("path")).alias("stem"), "text")


def read_annotation_export(spark: SparkSession, folder: str) -> DataFrame:
    """Image and label pairs of an unpacked export folder."""
    images = list_images(spark, folder, recursive=True)
    labels = read_label_files(spark, folder)
    pairs = images.select("path", "file", "stem").join(labels.select("stem", "text"), "stem")
    return pairs.withColumn("handmade", F.lit(True))


def read_class_folders(spark: SparkSession, root: str, brands: Sequence[str]) -> DataFrame:
    """Samples of a folder per class: ``id, path, brand, source``; a sub-folder is the source."""
    for brand in brands:
        _folder(spark, f"{root}/{brand}")
    images = list_images(spark, root, recursive=True)
    base = root.rstrip("/")
    inner = F.substr(F.col("path"), F.lit(len(base) + 2))
    parts = F.split(inner, "/")
    source = F.when(F.size(parts) > 2, F.array_join(F.slice(parts, 2, F.size(parts) - 2), "/")).otherwise(F.lit(""))
    return images.select(
        inner.alias("id"), "path", "file", parts[0].alias("brand"), source.alias("source")
    ).filter(F.col("brand").isin(*brands))


def read_table(spark: SparkSession, path: str, schema, *, optional: bool = False) -> DataFrame:
    """CSV with a fixed schema; quoted fields may span lines.  A missing optional table is empty.

    An unquoted empty cell is null (as is ``\\N``), a quoted one an empty text.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if optional and not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).options(header=True, multiLine=True, quote='"', escape='"', nullValue=C.NULL_CELL)
    # without it a zero character beside a quote is taken for an escape
    rows = reader.option("charToEscapeQuoteEscaping", '"').csv(_folder(spark, path))
    texts = [f.name for f in rows.schema if isinstance(f.dataType, StringType)]
    return rows.withColumns({c: F.when(F.col(c).rlike(r"^\\{2,}N\z"), F.substr(F.col(c), F.lit(2))).otherwise(F.col(c)) for c in texts})


def read_outcomes(spark: SparkSession, path: str) -> DataFrame:
    """Graded rows of a run: ``file, truth, decided``."""
    rows = read_table(spark, path, C.OUTCOMES).filter(F.coalesce("truth", F.lit("")) != "")
    return rows.select("file", "truth", F.col("brand").alias("decided"))
