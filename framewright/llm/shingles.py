"""Near copies by word shingles: texts whose sets of 5-word shingles have a Jaccard similarity of 0.8 or more are linked.

Candidates come from ``BANDS`` bands of ``WIDTH`` minimum hashes each: two texts at similarity s share a bucket with probability
1 - (1 - s^WIDTH)^BANDS, which is 0.99994 at 0.8.  Every link is verified on the texts themselves, in two steps:

1. Each text of a bucket is compared with the bucket's first text.  That settles groups of copies at one comparison a text.
2. Where a bucket still holds several components, its texts meet in one cell and all texts of different components are compared.
   Buckets of equal members are visited once.  A crowded bucket is dealt into a grid of cells, every two slices of it in one.

Another operator may propose stars of near copies first (``candidates``).  They are verified on the texts like any other, and what
they settle isn't compared again; the bands find the rest.

Links are transitive: a group is a connected component.  The cells link groups, so what the first links settled isn't walked again.  Texts with equal sets of shingles collapse before anything joins.

Defined results: words are cut at blanks and compared in lower case (A-Z); a text of fewer words than a shingle is one shingle;
null and empty texts have equal (empty) sets; the row that stays is the one of the least ``doc_id`` (null last), then the first in
the stored order, exactly one a group however ids repeat; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.llm.common import as_bytes, stored
from framewright.operators.nearest import components

WORDS, LEAST = 5, 0.8
BANDS, WIDTH = 32, 6
#: Texts and bytes of a bucket in one slice of its grid.
SLICE_ROWS, SLICE_BYTES = 2_000, 8_000_000
#: Shingles that are hashed by all functions at once.
BLOCK = 4_096

_ODD = np.random.default_rng(11).integers(1 << 32, 1 << 63, (2, BANDS * WIDTH), dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """Different 64-bit hashes of the text's word shingles, in order."""
    own = text.lower().split()
    if not own:
        return np.zeros(0, np.uint64)
    known: dict[bytes, int] = {}
    digest = xxhash.xxh64_intdigest
    hashes = np.array([known[w] if w in known else known.setdefault(w, digest(w)) for w in own], np.uint64)
    k = min(words, len(own))
    n = len(own) - k + 1
    total = np.full(n, k, np.uint64)
    for i in range(k):
        total = _mixed(total * _STEP + hashes[i : i + n])
    return np.unique(total)


def minima(found: np.ndarray) -> np.ndarray:
    """Least value of each hash function over the shingles; the largest number for none."""
    least = np.full(BANDS * WIDTH, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), BLOCK):
        least = np.minimum(least, (found[at : at + BLOCK, None] * _ODD[0] + _ODD[1]).min(axis=0))
    return least


def band_keys(found: np.ndarray) -> np.ndarray:
    """One signed bucket key for each band."""
    least = minima(found).reshape(BANDS, WIDTH)
    key = np.arange(BANDS, dtype=np.uint64)
    for i in range(WIDTH):
        key = _mixed(key * _STEP + least[:, i])
    return key.view(np.int64)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1_000):
            part = batch.slice(at, 1_000)
            sets = [shingles(t) for t in as_bytes(part["_text"])]
            digests = pa.array([xxhash.xxh128_digest(s.tobytes()) for s in sets], pa.binary())
            keys = pa.array([band_keys(s) for s in sets], pa.list_(pa.int64()))
            yield pa.record_batch([part["_place"], digests, keys], names=["place", "digest", "keys"])


def _verified(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None
        for batch in batches:
            near = []
            for u, a, b in zip(batch["u"].to_pylist(), as_bytes(batch["u_text"]), as_bytes(batch["v_text"])):
                if u != last:  # rows come sorted by u
                    last, held = u, shingles(a)
                near.append(jaccard(held, shingles(b)) >= least)
            found = pa.table([batch["u"], batch["v"]], names=["u", "v"]).filter(pa.array(near, pa.bool_()))
            yield from found.to_batches()

    return run


def cell_links(ids: list[int], groups: list[int], sides: list[int], texts: list[bytes], least: float) -> list[tuple[int, int]]:
    """Links that join what is near in one cell and not in one group yet.  Of two slices, texts of different ones are compared."""
    sets = [shingles(t) for t in texts]
    sizes = np.array([len(s) for s in sets])
    label, side = np.unique(np.array(groups), return_inverse=True)[1], np.array(sides)
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
    stops = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(sets)), sizes)
    present = np.zeros(len(codes) + 1, bool)
    crossing = side.min() != side.max()
    out = []
    for i in range(len(sets)):
        other = label != label[i]
        other &= side != side[i] if crossing else np.arange(len(sets)) > i
        other &= np.minimum(sizes, sizes[i]) >= least * np.maximum(sizes, sizes[i])
        if (crossing and side[i]) or not other.any():
            continue
        own = codes[stops[i] - sizes[i] : stops[i]]
        present[own] = True
        both = np.bincount(owner[present[codes]], minlength=len(sets))
        present[own] = False
        for j in np.flatnonzero(other & (both >= least * (sizes + sizes[i] - both))).tolist():
            if label[j] != label[i]:
                out.append((ids[i], ids[j]))
                label[label == label[j]] = label[i]
    return out


def _cells(least: float):
    """Links between groups, from the texts of each cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held = None, []
        schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

        def links():
            groups, sides, texts = map(list, zip(*held)) if held else ([], [], [])
            found = cell_links(groups, groups, sides, texts, least) if len(held) > 1 else []
            return pa.record_batch([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], schema=schema)

        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("key", "low", "high", "group", "side")]
            for key, low, high, *row, text in zip(*columns, as_bytes(batch["text"])):
                if (key, low, high) != cell:
                    yield links()
                    cell, held = (key, low, high), []
                held.append((*row, text))
        yield links()

    return run


def verified(stars: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Those of the pairs ``u, v`` whose texts (``id, text``) are near."""
    with_texts = stars.join(texts.select(F.col("id").alias("v"), F.col("text").alias("v_text")), "v")
    with_texts = with_texts.join(texts.select(F.col("id").alias("u"), F.col("text").alias("u_text")), "u")
    return stored(with_texts.select("u", "v", "u_text", "v_text").mapInArrow(_verified(least), "u long, v long"), "shingle-direct")


def _unsettled(stars: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs without those that hang on the same text by known links."""
    owner = stored(known.groupBy("v").agg(F.min("u").alias("owner")), "shingle-owners")
    for end in ("u", "v"):
        stars = stars.join(owner.select(F.col("v").alias(end), F.col("owner").alias(f"{end}_owner")), end, "left")
    return stars.filter(F.coalesce("u_owner", "u") != F.coalesce("v_owner", "v")).select("u", "v")


def near_groups(
    texts: DataFrame, entries: DataFrame, *, least: float = LEAST, slice_rows: int = SLICE_ROWS, stars: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Groups of the texts (``id, text``) which share a bucket (``entries``: ``key, id``) or a star and are near, in two tables:
    ``id, group`` by the first links, and ``group, whole`` for those groups that the cells join.  Who isn't listed stays apart."""
    known = None if stars is None else verified(stars, texts, least)
    count = entries.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("first")).filter("n > 1")
    shared = stored(entries.join(stored(count, "shingle-buckets"), "key").select("key", "id", "first"), "shingle-entries")
    own = stored(shared.filter("id != first").select(F.col("first").alias("u"), F.col("id").alias("v")).distinct(), "shingle-stars")
    direct = verified(own, texts, least) if known is None else known.unionByName(verified(_unsettled(own, known), texts, least))
    reached = shared.select("id").unionByName(direct.select(F.explode(F.array("u", "v")).alias("id"))).distinct()
    groups = stored(components(reached, direct), "shingle-components")
    members = shared.select("key", "id").join(groups, "id")
    mark = F.bit_xor(F.xxhash64("id")), F.bit_xor(F.xxhash64("id", F.lit(1))), F.min("id"), F.count("*")
    still = members.groupBy("key").agg(
        F.min("group").alias("low"), F.max("group").alias("high"), *[m.alias(f"m{i}") for i, m in enumerate(mark)]
    ).filter("low != high")
    still = stored(still.groupBy("m0", "m1", "m2", "m3").agg(F.min("key").alias("key")).select("key"), "shingle-open")
    rows = members.join(still, "key").join(texts, "id")
    rows = stored(rows.select("key", "id", "group", "text"), "shingle-rows")
    sums = rows.groupBy("key").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    grid = F.greatest(F.ceil(F.col("n") / slice_rows), F.ceil(F.col("bytes") / SLICE_BYTES)).cast("int")
    rows = rows.join(stored(sums.select("key", grid.alias("grid")), "shingle-grids"), "key")
    own = F.pmod(F.xxhash64("id", F.lit(2)), F.col("grid")).cast("int")
    placed = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("grid") - 1)))
    placed = placed.select(
        "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "group",
        (F.col("own") > F.col("other")).cast("int").alias("side"), "text",
    )
    dealt = placed.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    rest = stored(dealt.mapInArrow(_cells(least), "u long, v long"), "shingle-rest")
    ends = rest.select(F.explode(F.array("u", "v")).alias("id")).distinct()
    return groups, stored(components(ends, rest).select(F.col("id").alias("group"), F.col("group").alias("whole")), "shingle-wholes")


def drop_near_copies(
    docs: DataFrame, *, least: float = LEAST, slice_rows: int = SLICE_ROWS, candidates: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """One row of each group of near copies, with all its columns.  ``candidates`` makes stars ``u, v`` from ``id, text``."""
    placed = stored(docs.withColumn("_place", F.monotonically_increasing_id()), "shingle-placed")  # numbered once
    texts = placed.select("_place", F.coalesce("text", F.lit("")).alias("_text"))
    rows = stored(texts.mapInArrow(_sketched, "place long, digest binary, keys array<long>"), "shingle-sketches")
    sets = stored(rows.groupBy("digest").agg(F.min("place").alias("id")), "shingle-sets")
    entries = rows.join(sets, "digest").filter("place = id").select(F.explode("keys").alias("key"), "id")
    contents = texts.select(F.col("_place").alias("id"), F.col("_text").alias("text"))
    stars = None
    if candidates is not None:
        first = stored(rows.select("place", "digest").join(sets, "digest").select("place", "id"), "shingle-firsts")
        stars = candidates(contents)
        for end in ("u", "v"):
            stars = stars.join(first.select(F.col("place").alias(end), F.col("id").alias(f"{end}_id")), end)
        stars = stored(stars.select(F.col("u_id").alias("u"), F.col("v_id").alias("v")).filter("u != v").distinct(), "shingle-candidates")
    groups, wholes = near_groups(contents, entries, least=least, slice_rows=slice_rows, stars=stars)
    of_sets = sets.join(groups, "id", "left").select("digest", F.coalesce("group", "id").alias("group")).join(wholes, "group", "left")
    of_sets = stored(of_sets.select("digest", F.coalesce("whole", "group").alias("group")), "shingle-set-groups")
    ids = placed.select(F.col("_place").alias("place"), F.col("doc_id").cast("long").alias("doc_id"))
    grouped = rows.select("place", "digest").join(of_sets, "digest").join(ids, "place")
    keep = grouped.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "place")).alias("first"))
    return placed.join(keep.select(F.col("first.place").alias("_place")), "_place", "left_semi").drop("_place")
