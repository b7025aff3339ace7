import random

import numpy as np
import pytest

import corpus_pipeline
from framewright.llm import shingles, simhash


def brute_sets(texts):
    out = []
    for text in texts:
        w = (text or "").encode().lower().split()
        k = min(5, len(w))
        out.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set())
    return out


def brute_kept(rows):
    """Places of the rows that stay: one a component of links at similarity 0.8."""
    sets = brute_sets([t for _, t in rows])
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if group[i] != group[j] and (a == sets[j] or both >= 0.8 * (len(a) + len(sets[j]) - both)):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    best = {}
    for place, ((doc_id, _), g) in enumerate(zip(rows, group)):
        best[g] = min(best.get(g, (True, 0, 1 << 60)), (doc_id is None, doc_id or 0, place))
    return sorted(b[2] for b in best.values())


def edited(rng, words, edits):
    words = list(words)
    for at in rng.sample(range(len(words)), edits):
        words[at] = f"new{rng.random()}"
    return words


@pytest.fixture(scope="module")
def near_rows():
    """Texts of 60 to 1,000 words and copies with single words replaced, alone and in chains of copies of copies."""
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows = []
    for n, edits in ((200, 1), (200, 2), (200, 4), (100, 1), (60, 1), (1000, 16)):
        for _ in range(20):
            base = rng.choices(vocabulary, k=n)
            rows += [" ".join(base), " ".join(edited(rng, base, edits))]
    for _ in range(3):
        chain = rng.choices(vocabulary, k=150)
        for _ in range(12):
            chain = edited(rng, chain, 2)
            rows.append(" ".join(chain))
    rows += [None, "", " \n", "one two", "One  TWO", "one two three", "a b c d e", "a b c d e f"]
    rng.shuffle(rows)
    return list(enumerate(rows))


def kept_places(df):
    return sorted(r["n"] for r in df.collect())


@pytest.mark.parametrize("slice_rows", [2, 2_000])
def test_near_copies_match_brute_force(spark, near_rows, slice_rows):
    docs = spark.createDataFrame([(i, t, i) for i, t in near_rows], "doc_id long, text string, n long")
    assert kept_places(shingles.drop_near_copies(docs, slice_rows=slice_rows)) == brute_kept(near_rows)


def test_stage_links_at_a_similarity_of_four_fifths(spark, near_rows):
    docs = spark.createDataFrame([(i, t, i) for i, t in near_rows], "doc_id long, text string, n long")
    stage = dict(corpus_pipeline.STAGES)["near_dedup"]
    assert kept_places(stage(spark, docs, "")) == brute_kept(near_rows)


def test_cells_compare_texts_of_other_groups():
    rng = random.Random(6)
    base = rng.choices([f"w{i}" for i in range(900)], k=200)
    texts = [" ".join(edited(rng, base, 3)).encode() for _ in range(8)]
    sets = brute_sets([t.decode() for t in texts])
    for sides in ([0] * 8, [0, 1] * 4):
        links = shingles.cell_links(list(range(8)), list(range(8)), sides, texts, 0.7)
        near = {(i, j) for i in range(8) for j in range(8) if i < j and (sides[i] != sides[j] or not any(sides)) and len(sets[i] & sets[j]) >= 0.7 * len(sets[i] | sets[j])}
        assert {tuple(sorted(x)) for x in links} <= near

        def joined(edges):
            group = list(range(8))
            for a, b in edges:
                group = [group[b] if g == group[a] else g for g in group]
            return [group.index(g) for g in group]

        assert joined(links) == joined(near)


def test_one_row_stays_of_each_group_however_ids_repeat(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(80)) for c in "ab")
    rows = [(None, a), (None, a), (None, b + " x"), (5, b), (5, a + " y"), (3, b), (3, "other words"), (None, None), (None, "")]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, n long")
    kept = shingles.drop_near_copies(docs)
    assert kept_places(kept) == brute_kept(rows) and kept.count() == 4


def test_near_copies_pass_other_columns_through(odd, empty, corpus):
    kept = shingles.drop_near_copies(odd)
    assert kept.columns == odd.columns and kept.count() == len(brute_kept(corpus))
    assert shingles.drop_near_copies(empty).count() == 0


def test_recall_of_bands_at_the_bound():
    rng = np.random.default_rng(2)
    met = 0
    for _ in range(400):
        both, a, b = rng.integers(0, 1 << 63, 400, dtype=np.uint64), rng.integers(0, 1 << 63, 50, dtype=np.uint64), rng.integers(0, 1 << 63, 50, dtype=np.uint64)
        met += bool(np.any(shingles.band_keys(np.concatenate([both, a])) == shingles.band_keys(np.concatenate([both, b]))))
    assert met >= 399


def test_the_stage_takes_its_first_links_from_fingerprints(spark, near_rows, monkeypatch):
    docs = spark.createDataFrame([(i, t, i) for i, t in near_rows], "doc_id long, text string, n long")
    found, near_stars = [], simhash.near_stars

    def spy(texts):
        found.append(near_stars(texts))
        return found[-1]

    monkeypatch.setattr(simhash, "near_stars", spy)
    assert kept_places(dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, "")) == brute_kept(near_rows)
    assert len(found) == 1 and found[0].count() > 20


def test_proposed_links_are_proved(spark, near_rows):
    docs = spark.createDataFrame([(i, t, i) for i, t in near_rows], "doc_id long, text string, n long")
    lone = lambda texts: texts.selectExpr("(SELECT 0L) AS u", "id AS v").filter("v % 2 = 1")
    assert kept_places(shingles.drop_near_copies(docs.coalesce(1), candidates=lone)) == brute_kept(near_rows)


def test_components_are_walked_once_and_then_only_between_groups(spark, near_rows, monkeypatch):
    docs = spark.createDataFrame([(i, t, i) for i, t in near_rows], "doc_id long, text string, n long")
    edges = []

    def spy(vertices, links, own=shingles.components):
        edges.append(links.count())
        return own(vertices, links)

    monkeypatch.setattr(shingles, "components", spy)
    monkeypatch.setattr(simhash, "components", spy)
    assert kept_places(dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, "")) == brute_kept(near_rows)
    assert len(edges) == 2 and edges[1] < edges[0] / 4
