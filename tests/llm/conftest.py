import random

import pytest

SCHEMA = "doc_id long, text string"


def _words(rng, n, vocabulary):
    return " ".join(rng.choice(vocabulary) for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """Rows (doc_id, text): prose, copies, near copies, shared passages, odd blanks, empty and null texts, repeated rows."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefghé") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    rows = [(i, _words(rng, rng.randint(0, 120), vocabulary)) for i in range(60)]
    passage = _words(rng, 50, vocabulary)
    rows += [(100 + i, f"{_words(rng, 20, vocabulary)} {passage}\n{_words(rng, 9, vocabulary)}") for i in range(6)]
    long = _words(rng, 400, vocabulary)
    near = long.split()
    near[200] = "changed"
    rows += [(200, long), (201, long), (202, " ".join(near)), (203, long.replace(" ", "\n", 3)), (204, long.upper())]
    rows += [(300, None), (301, ""), (302, " \t\n"), (303, None), (304, "word"), (304, "word"), (None, "word"), (None, None)]
    rows += [(400, "the " * 300), (401, "a b " * 100), (402, "x" * 50_000), (403, "Ünï © 中文 👍   end")]
    return rows


@pytest.fixture
def docs(spark, corpus):
    return spark.createDataFrame(corpus, SCHEMA)


@pytest.fixture
def odd(spark, corpus):
    """The same rows with columns whose names clash with those that operators use."""
    rows = [(i, t, 1, "x", 2, "y", b"z", 3) for i, t in corpus]
    return spark.createDataFrame(rows, f"{SCHEMA}, print long, digest string, place long, kept string, text_id binary, n_words long")


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def key(row):
    return tuple((x is None, x) if not isinstance(x, (list, dict)) else repr(x) for x in row)


@pytest.fixture
def rows_of():
    """Rows of a table as sorted tuples; nulls last."""
    return lambda df: sorted(map(tuple, df.collect()), key=key)
