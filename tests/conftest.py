import pytest

from framewright.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, app="tests", partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def frame(spark):
    """Small table from rows and a schema string."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


@pytest.fixture
def partitions(spark):
    """Run something under several shuffle widths and give all results."""

    def run(build):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        results = []
        for width in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", width)
            results.append(sorted(map(tuple, build().collect()), key=repr))
        spark.conf.set("spark.sql.shuffle.partitions", before)
        return results

    return run
