"""Work a model or a service does on rows, with the model supplied by the caller."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewright import schemas as C
from framewright.session import pin


@dataclass(frozen=True)
class Extractor:
    """A named, versioned source of features: ``make()`` is called once per worker.

    It returns a function from a batch of inputs to a matrix with one row per
    input and one column per name in ``dims``.
    """

    name: str
    version: str
    dims: Sequence[str]
    make: Callable[[], Callable[[np.ndarray], np.ndarray]]
    shape: Sequence[int] | None = None
    batch: int = 32


@dataclass
class Registry:
    """Extractors by name."""

    known: dict[str, Extractor] = field(default_factory=dict)

    def add(self, extractor: Extractor) -> Extractor:
        if extractor.name in self.known:
            raise ValueError(f"extractor {extractor.name} is registered already")
        self.known[extractor.name] = extractor
        return extractor

    def get(self, name: str) -> Extractor:
        if name not in self.known:
            raise KeyError(f"no extractor {name}; known: {', '.join(sorted(self.known)) or 'none'}")
        return self.known[name]


def extract(df: DataFrame, extractor: Extractor, column: str, *, key: str = "id") -> DataFrame:
    """Features of every row: ``key, values``.  A matrix of another width fails the job."""
    width, name, make = len(extractor.dims), extractor.name, extractor.make

    def checked():
        predict = make()

        def run(batch: np.ndarray) -> np.ndarray:
            matrix = np.asarray(predict(batch), dtype=np.float32)
            if matrix.shape != (len(batch), width):
                raise ValueError(f"{name}: expected {(len(batch), width)}, got {matrix.shape}")
            return matrix

        return run

    shapes = [list(extractor.shape)] if extractor.shape else None
    udf = predict_batch_udf(
        checked, return_type=T.ArrayType(T.FloatType()), batch_size=extractor.batch, input_tensor_shapes=shapes
    )
    return df.select(key, udf(column).alias("values"))


#: Rows that one task asks a service about.
CALLS_PER_TASK = 200


def detect(
    frames: DataFrame, make_detector: Callable[[], Callable[[list], list[list[Sequence[float]]]]], column: str, *,
    batch: int = 16, min_confidence: float = 0.25,
) -> DataFrame:
    """Detections ``file, x1, y1, x2, y2, confidence`` from batches of frames.

    The detector is built once per partition and gets lists of ``column``
    values; it returns, per frame, rows of four corners and a confidence.
    """
    schema = T.StructType([frames.schema["file"], *C.DETECTION.fields])

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        detector = make_detector()
        for part in parts:
            for start in range(0, len(part), batch):
                piece = part.iloc[start : start + batch]
                found = [
                    (file, *map(float, box))
                    for file, boxes in zip(piece["file"], detector(list(piece[column])), strict=True)
                    for box in boxes
                ]
                yield pd.DataFrame(found, columns=schema.names)

    return frames.select("file", column).mapInPandas(run, schema).filter(F.col("confidence") >= min_confidence)


def ask_service(
    rows: DataFrame, make_client: Callable[[], Callable[[object], str]], column: str, *, key: str, sessions: int | None = None
) -> DataFrame:
    """Ask a service about every row: ``key, reply, failure, seconds``.

    One client per partition.  Partitions hold about ``CALLS_PER_TASK`` rows, so
    a lost task asks few rows again and many can run at once; how many do is up
    to the cluster's cores.  ``sessions`` sets their number instead.  A failed
    call becomes data and never ends the job.
    """
    asked = pin(rows.select(key, column))  # counted, then asked: what gives the rows runs once
    asked = asked.repartition(sessions or max(1, -(-asked.count() // CALLS_PER_TASK)))
    text = T.StringType()
    schema = T.StructType(
        [rows.schema[key], T.StructField("reply", text), T.StructField("failure", text), T.StructField("seconds", T.DoubleType())]
    )

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make_client()
        for part in parts:
            out = []
            for name, payload in zip(part[key], part[column], strict=True):
                start = time.monotonic()
                try:
                    reply, failure = client(payload), None
                except Exception as error:  # noqa: BLE001
                    reply, failure = None, str(error) or type(error).__name__
                out.append((name, reply, failure, time.monotonic() - start))
            yield pd.DataFrame(out, columns=schema.names)

    return asked.mapInPandas(run, schema)


def require_service(probe: Callable[[], bool], name: str) -> None:
    """Ask the service for a sign of life before a long job starts."""
    try:
        alive = probe()
    except Exception as error:  # noqa: BLE001
        raise ConnectionError(f"{name} does not answer: {error}") from error
    if not alive:
        raise ConnectionError(f"{name} does not answer")
