"""Where queries register themselves."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from catalog.views import load, oracle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Data:
    """The provided tables and views of one scale factor: ``data.boxes`` is a DataFrame."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return load(self.spark, self.sf_dir, name)


def query(name: str, sql: str | None = None):
    """Register a query that takes :class:`Data`; ``sql`` is its check, with ``{view}`` names."""

    def register(build: Callable[[Data], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: build(Data(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return build

    return register
