import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from framewright.llm import exact, simhash, substrings

BLANK = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in BLANK.split(text or "") if w]


# exact copies


def brute_exact(rows):
    groups = defaultdict(list)
    for place, (doc_id, text) in enumerate(rows):
        groups[BLANK.sub("", text or "")].append((-len(text or ""), doc_id is None, doc_id or 0, place))
    out = []
    for content, members in groups.items():
        first = min(members)
        keep = None if first[1] else first[2]
        digest = hashlib.sha256(content.encode()).hexdigest()
        out += [(None if m[1] else m[2], keep, len(members), m == first, digest) for m in members]
    return out


def exact_rows(df):
    return df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def test_exact_groups_match_brute_force(spark, docs, corpus, rows_of):
    expected = spark.createDataFrame(brute_exact(corpus), exact_rows(exact.exact_groups(docs)).schema)
    for salts in (1, 7):
        assert rows_of(exact_rows(exact.exact_groups(docs.coalesce(1), salts=salts))) == rows_of(expected)


def test_a_text_that_every_task_holds_once_is_salted(spark, docs):
    table = spark.createDataFrame([(1, "same text")], "doc_id long, text string").toArrow()
    salts = set()
    for task in range(40):
        placed = table.append_column("place", [[(task << 33) + task]]).combine_chunks()
        entries = [e for b in exact._local(8)(iter(placed.to_batches())) for e in b.to_pylist()]
        assert len(entries) == 1
        salts.add(entries[0]["salt"])
    assert salts == set(range(8))


def test_contents_are_compared_when_digests_collide(spark, docs, corpus, rows_of, monkeypatch):
    class Weak:
        def __init__(self, data):
            self.data = data

        def digest(self):
            return bytes([len(self.data) % 2])

    entries = [e for b in exact._local(3)(docs.select("doc_id", "text").limit(0).toArrow().to_batches()) for e in b.to_pylist()]
    assert entries == []
    table = docs.toArrow().append_column("place", [list(range(docs.count()))])
    monkeypatch.setattr(exact.hashlib, "sha256", Weak)
    local = [b for b in exact._local(3)(table.combine_chunks().to_batches(max_chunksize=20))]
    ordered = exact.pa.Table.from_batches(local).sort_by([("digest", "ascending")])
    merged = exact.pa.Table.from_batches(list(exact._merge(iter(ordered.combine_chunks().to_batches(max_chunksize=7)))))
    contents = merged["content"].to_pylist()
    assert len(contents) == len(set(contents)) == len({BLANK.sub("", t or "") for _, t in corpus})
    assert sum(merged["rows"].to_pylist()) == len(corpus)


def test_drop_copies_keeps_other_columns(odd, corpus):
    kept = exact.drop_copies(odd)
    assert kept.columns == odd.columns
    assert kept.count() == len({BLANK.sub("", t or "") for _, t in corpus})


def test_kept_rows_do_not_depend_on_how_later_scans_are_cut(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame([(i, f"text {i % 50}", i) for i in range(400)], "doc_id long, text string, n long")
    docs.repartitionByRange(4, "doc_id").sortWithinPartitions("doc_id").write.parquet(str(tmp_path / "docs"))
    plain = exact.stored
    cut = iter(range(1, 100))

    def stored(df, name):  # each time something is written, cores come and go
        found = plain(df, name)
        spark.conf.set("spark.sql.files.maxPartitionBytes", 900 * next(cut))
        spark.conf.set("spark.sql.files.openCostInBytes", 1)
        return found

    monkeypatch.setattr(exact, "stored", stored)
    try:
        read = spark.read.parquet(str(tmp_path / "docs"))
        spark.conf.set("spark.sql.files.openCostInBytes", 1 << 30)
        marks = {r["doc_id"]: r["kept"] for r in exact.exact_groups(read).collect()}
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        ids = sorted(r["n"] for r in exact.drop_copies(spark.read.parquet(str(tmp_path / "docs"))).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(i for i, k in marks.items() if k) == ids == list(range(50))


def test_exact_of_nothing(empty):
    assert exact.exact_groups(empty).count() == 0


# SimHash


def brute_print(text, k=3):
    w = [x.decode() for x in (text or "").encode().lower().split()]
    if not w:
        return 0
    k = min(k, len(w))
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + k]).encode(), 42) for i in range(len(w) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, ids, most=3):
    group = list(range(len(prints)))
    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= most and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {g: min((x for x, h in zip(ids, group) if h == g and x is not None), default=None) for g in set(group)}
    return [least[g] for g in group]


def test_near_groups_match_brute_force(docs, corpus, rows_of):
    prints = [brute_print(t) for _, t in corpus]
    groups = brute_groups(prints, [i for i, _ in corpus])
    expected = [(i, f"{p:016x}", g) for (i, _), p, g in zip(corpus, prints, groups)]
    assert rows_of(simhash.near_groups(docs)) == sorted(expected, key=lambda r: tuple((x is None, x) for x in r))


@pytest.mark.parametrize("crowded", [3, 20_000])
def test_links_join_what_brute_force_joins(spark, crowded):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    prints = {int(b) for b in base} | {0, (1 << 64) - 1}
    for b in base.tolist()[:25]:
        for n in range(12):  # up to four bits away, and some of those again
            flips = rng.choice(64, n % 5, replace=False)
            prints.add(b ^ sum(1 << int(f) for f in flips))
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = simhash.near_links(spark.createDataFrame([(p,) for p in signed], "print long"), crowded=crowded).collect()
    group = {p: p for p in signed}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for u, v in links:
        group[root(u)] = root(v)
    expected = brute_groups(prints, signed)
    found = [root(p) for p in signed]
    assert len(set(zip(found, expected))) == len(set(found)) == len(set(expected))


def test_golay_keys_meet_within_one_bit():
    rng = np.random.default_rng(1)
    words_ = rng.integers(0, 1 << 23, 500)
    keys = simhash.segment_keys(words_)
    assert len({int(k) for k in simhash.segment_keys(np.arange(1 << 12))[:, 0]}) <= 4096
    for bit in range(23):
        own = simhash.segment_keys(words_ ^ (1 << bit))[:, 0]
        assert (keys == own[:, None]).any(axis=1).all()


def test_one_document_of_each_near_group_stays(odd, corpus):
    groups = brute_groups([brute_print(t) for _, t in corpus], [i for i, _ in corpus])
    kept = simhash.drop_near_copies(odd)
    assert kept.columns == odd.columns
    assert {r.doc_id for r in kept.collect()} == set(groups)


def test_near_groups_of_nothing(empty):
    assert simhash.near_groups(empty).count() == 0


# repeated passages


def brute_repeats(rows, window=35):
    seen = defaultdict(int)
    split = [words(t) for _, t in rows]
    for w in split:
        for i in range(len(w) - window + 1):
            seen[tuple(w[i : i + window])] += 1
    out = []
    for (doc_id, _), w in zip(rows, split):
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=lambda r: tuple((x is None, x) for x in r))


@pytest.mark.parametrize("part_bytes, group_words", [(24_000_000, 400_000), (5_000, 90)])
def test_substrings_match_brute_force(docs, corpus, rows_of, monkeypatch, part_bytes, group_words):
    monkeypatch.setattr(substrings, "PART_BYTES", part_bytes)
    monkeypatch.setattr(substrings, "GROUP_WORDS", group_words)
    assert rows_of(substrings.dedup_substrings(docs.repartition(3))) == brute_repeats(corpus)


def test_substrings_with_clashing_columns_and_nothing(odd, corpus, empty, rows_of):
    assert rows_of(substrings.dedup_substrings(odd)) == brute_repeats(corpus)
    assert substrings.dedup_substrings(empty).count() == 0
    with pytest.raises(ValueError):
        substrings.repeats(empty, window=34)
