import random
import re
import zlib
from collections import Counter

import pytest

from framewright.llm import spelling

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_words(rows, lose, least=7):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            check = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if lose and check % lose == 0:
                at = check % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= least:
                n[run] += 1
    return n


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(n, factor=10):
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= factor * n[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in n)


@pytest.fixture
def words():
    """Words with many neighbours: repeated letters, all kinds of edits, letters beyond ASCII, one very long pair."""
    rng = random.Random(11)
    stems = ["".join(rng.choice("abé") for _ in range(rng.randint(7, 9))) for _ in range(25)] + ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa"]
    n = {}
    for stem in stems:
        n[stem] = rng.choice([2, 3, 20, 30, 200, 2000, 40000])
        for _ in range(6):
            i = rng.randrange(len(stem))
            for word in (stem[:i] + stem[i + 1 :], stem[:i] + rng.choice("abéÿ") + stem[i:], stem[:i] + rng.choice("abc") + stem[i + 1 :]):
                if len(word) >= 7:
                    n.setdefault(word, rng.choice([2, 3, 20, 25, 300, 400]))
    n |= {"x" * 30_000: 3, "x" * 30_001: 50, "x" * 20_000 + "y" + "x" * 9_999: 2}
    return n


def test_neighbours_forms_and_roots_match_brute_force(spark, words, rows_of):
    small = {w: k for w, k in words.items() if len(w) < 100}
    df = spark.createDataFrame(list(small.items()), "word string, n long")
    got = rows_of(spelling.variants(df))
    assert got == brute_variants(small)
    assert any(root not in (word, form) for word, form, root, *_ in got)  # chains of two steps and more


def test_very_long_words(spark, words):
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = {r["word"]: (r["form"], r["n_near"]) for r in spelling.variants(df).collect()}
    short, long, other = "x" * 30_000, "x" * 30_001, "x" * 20_000 + "y" + "x" * 9_999
    assert got[short] == (long, 2) and got[long] == (None, 1) and got[other] == (None, 1)


def test_groups_of_texts_match_brute_force(spark, docs, corpus, rows_of, partitions):
    rng = random.Random(12)
    base = ["Straße", "aufgeben", "bonjourno", "liberties", "ÀÿÀÿÀÿÀ", "settlement"]
    extra = [(1000 + i, ", ".join(rng.choice(base) + rng.choice(["", "", "s", "X"]) for _ in range(40))) for i in range(80)]
    rows = corpus + extra + [(None, "liberties liberties 中文liberties÷x"), (5, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute_variants({w: k for w, k in brute_words(rows, 31).items() if k >= 2})
    assert expected
    first, second = partitions(lambda: spelling.spelling_groups(df, lose=31))
    assert first == second
    assert rows_of(spelling.spelling_groups(df, lose=31)) == expected


def test_empty_and_clashing_columns(spark, docs, odd, empty, rows_of):
    assert rows_of(spelling.spelling_groups(empty)) == []
    assert rows_of(spelling.spelling_groups(odd, least=3)) == rows_of(spelling.spelling_groups(docs, least=3))
    clash = docs.withColumn("word", docs["text"]).withColumn("n", docs["doc_id"])
    assert rows_of(spelling.spelling_groups(clash, least=3)) == rows_of(spelling.spelling_groups(docs, least=3))
