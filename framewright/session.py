"""Session helpers: a local session for tests, the shared folder, and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", *, app: str = "framewright", partitions: int = 8) -> SparkSession:
    """Session for tests and single-machine runs; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Checkpoint folder of the cluster.

    The session setting wins.  Only a local master may fall back to a folder of
    its own: on a cluster a machine-local path would not survive the executor.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = sc._jsc.sc().getCheckpointDir()
    if named:
        if current.isEmpty():
            sc.setCheckpointDir(named)
        return named
    if not current.isEmpty():
        return current.get()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    return sc._jsc.sc().getCheckpointDir().get()


def pin(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint, so later steps all see the same rows."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one, for tables a job writes and reads back."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: like :func:`pin`, but packed, and later steps read only the columns they use."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
