"""Structured Streaming: resumable judging, live scenes, running counts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from framewright.functions.answers import parse_judge_reply
from framewright.operators.inference import ask_service
from framewright.operators.review import last_answers, pending_boxes


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class FirstSight(StatefulProcessor):
    """Lets the first row of every key pass; the state knows who was seen, and who was before the stream began.

    With ``keep_ms`` a key is forgotten that long after its first row.
    """

    def __init__(self, columns: list[str], keep_ms: int | None) -> None:
        self.columns, self.keep_ms = columns, keep_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "at long")

    def _remember(self, timer) -> None:
        now = timer.getCurrentProcessingTimeInMs() if self.keep_ms else 0
        self.seen.update((now,))
        if self.keep_ms:
            self.handle.registerTimer(now + self.keep_ms)

    def handleInputRows(self, key, rows, timer) -> Iterator[pd.DataFrame]:
        known = self.seen.exists()
        for part in rows:
            if not known and len(part):
                self._remember(timer)
                known = True
                yield part.head(1)[self.columns]

    def handleInitialState(self, key, state, timer) -> None:
        self._remember(timer)

    def handleExpiredTimer(self, key, timer, expired) -> Iterator[pd.DataFrame]:
        self.seen.clear()
        yield from ()

    def close(self) -> None:
        pass


def unseen(boxes: DataFrame, answered: DataFrame, *, keep_ms: int | None = None) -> DataFrame:
    """The first row of each ``box_id`` of a stream that ``answered`` lacks; both are kept in keyed state, so no batch looks at a log."""
    known = answered.select("box_id").filter("box_id IS NOT NULL").distinct().groupBy("box_id")
    return boxes.filter("box_id IS NOT NULL").groupBy("box_id").transformWithStateInPandas(
        FirstSight(boxes.columns, keep_ms), outputStructType=boxes.schema, outputMode="append",
        timeMode="ProcessingTime" if keep_ms else "None", initialState=known,
    )


def judge_stream(
    boxes: DataFrame, answers_path: str, checkpoint: str, make_client: Callable, column: str, *, schema: str, sessions: int | None = None,
    keep_ms: int | None = None,
) -> StreamingQuery:
    """Ask about boxes as they arrive; append each answer once.

    Who was asked is keyed state in RocksDB.  The log is read once, when a checkpoint begins, to fill that state; no later batch reads
    it.  With ``keep_ms`` a box is forgotten by timer; timers need a stream that stays, so then the stream goes on until it is
    stopped instead of ending with what is there.  Answers lie in a folder per checkpoint and batch, so a batch that runs again after a crash looks at its own folder only
    and asks what is missing there.
    """
    spark = boxes.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.createDataFrame([], schema).write.mode("ignore").parquet(answers_path)

    def judge(batch: DataFrame, number: int) -> None:
        run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        own = f"{answers_path.rstrip('/')}/run={run}/batch={number}"
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(own)
        todo = batch
        if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):  # this batch was begun before
            todo = pending_boxes(batch, spark.read.schema(schema).parquet(own))
        asked = ask_service(todo, make_client, column, key="box_id", sessions=sessions)
        fields = parse_judge_reply(F.col("reply"), F.col("failure"))
        rows = asked.select("box_id", *[v.alias(k) for k, v in fields.items()], "seconds", F.lit(number).cast("long").alias("answered_at"))
        rows.write.mode("append").parquet(own)

    fresh = unseen(boxes, read_answers(spark, answers_path, schema), keep_ms=keep_ms)
    writer = fresh.writeStream.foreachBatch(judge).outputMode("append").option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime="10 seconds") if keep_ms else writer.trigger(availableNow=True)).start()


def read_answers(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The answer log, whichever checkpoint and batch wrote it."""
    log = spark.read.schema(schema).option("recursiveFileLookup", True).option("ignoreMissingFiles", True)
    return log.parquet(path)


def judged(answers: DataFrame) -> DataFrame:
    """Answers of the log without repeats."""
    return last_answers(answers)


def live_scenes(frames: DataFrame, *, gap_seconds: float, lateness: str = "10 minutes") -> DataFrame:
    """Scenes of a frame stream ``recording, at``: start, end and frames.

    A session window closes when the gap is reached; its length is one
    microsecond short, so frames exactly one gap apart already part.  Sessions
    merge inside each task before the shuffle.
    """
    gap = f"{round(gap_seconds * 1_000_000) - 1} microseconds"
    scenes = (
        frames.withWatermark("at", lateness)
        .groupBy("recording", F.session_window("at", gap).alias("_w"))
        .agg(F.count("*").alias("frames"), F.min("at").alias("first_at"), F.max("at").alias("last_at"))
    )
    return scenes.select("recording", "first_at", "last_at", "frames")


def running_counts(rows: DataFrame, *columns: str) -> DataFrame:
    """Counts per value as rows arrive."""
    return rows.groupBy(*columns).agg(F.count("*").alias("rows"))


def drain(stream: DataFrame, path: str, checkpoint: str, *, mode: str = "complete") -> StreamingQuery:
    """Write the state of a stream to a table, everything available now."""

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite" if mode == "complete" else "append").parquet(path)

    writer = stream.writeStream.outputMode(mode).foreachBatch(store).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
