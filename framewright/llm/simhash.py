"""SimHash near-duplicates, found by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments of 22, 21 and 21 bits.  Two fingerprints that differ in at most three bits have,
by the pigeonhole principle, two segments with at most one differing bit each.  The perfect binary Golay code (23, 12) maps a
segment to the index of its nearest codeword.  A segment at the largest distance, three, also lies at distance four from five
other codewords, the only ones its neighbours can decode to.  So a segment has one *index* key (its own codeword) and at most
six *probe* keys, and segments with at most one differing bit always meet.  Pairs of segment keys join fingerprints, the
number of differing bits verifies.

Equal fingerprints collapse before anything joins.  A task gives back a forest over the fingerprints it holds, not its pairs.
Keys with many index entries are dealt into a grid of cells, so no task compares a crowded key alone.

Defined results: null and empty texts have fingerprint zero and link like any other; null ``doc_id`` rows keep their fingerprint
and are never the least id unless their component has no other; repeated rows are in one component; an empty table gives an
empty result; other columns are ignored by :func:`near_groups` and passed through by :func:`drop_near_copies`.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.llm.common import as_bytes, packed, parts_for, stored, whole
from framewright.operators.nearest import components

#: The generator polynomial of the (23, 12) Golay code: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011
#: Bits of the three segments, from the top.
SEGMENTS = (22, 21, 21)
PAIRS = ((0, 1), (0, 2), (1, 2))
MOST_BITS = 3
#: Index entries of a key beyond which it is dealt into a grid of cells.
CROWDED = 20_000
#: Rows of keys that one task holds.
TASK_ROWS = 2_000_000
#: Candidate comparisons held at once.
BLOCK = 2_000_000


def _remainders() -> np.ndarray:
    """Remainder by the generator for each power x^0 .. x^22."""
    out, r = [], 1
    for _ in range(23):
        out.append(r)
        r <<= 1
        if r >> 11 & 1:
            r ^= GENERATOR
    return np.array(out, np.int64)


@lru_cache(1)
def golay() -> tuple[np.ndarray, np.ndarray]:
    """Syndromes by value of each of three bytes, and by syndrome the error patterns to the codewords within reach: the
    nearest first, then the five at distance four where the nearest is at distance three (else the nearest again)."""
    single = _remainders()
    by_byte = np.zeros((3, 256), np.int64)
    for byte in range(3):
        for bit in range(min(8, 23 - 8 * byte)):
            set_ = np.arange(256) >> bit & 1 == 1
            by_byte[byte, set_] ^= single[8 * byte + bit]
    patterns = np.zeros((2048, 6), np.int64)
    filled = np.zeros(2048, np.int64)
    words, weight = {0: np.array([0], np.int64)}, 0
    for weight in range(1, 5):
        lower = words[weight - 1]
        top = np.where(lower > 0, np.floor(np.log2(np.maximum(lower, 1))).astype(np.int64) + 1, 0)
        words[weight] = np.concatenate([lower[top <= b] | 1 << b for b in range(23)])
    for weight in range(5):
        syndromes = syndrome(words[weight], by_byte)
        for s, w in zip(syndromes.tolist(), words[weight].tolist()):
            if weight < 4 or filled[s]:
                patterns[s, filled[s]] = w
                filled[s] += 1
    # a weight-4 pattern shares the syndrome of a weight-3 leader, so leaders of less weight stay alone
    for s in range(2048):
        patterns[s, filled[s]:] = patterns[s, 0]
    return by_byte, patterns


def syndrome(words: np.ndarray, by_byte: np.ndarray) -> np.ndarray:
    return by_byte[0, words & 255] ^ by_byte[1, words >> 8 & 255] ^ by_byte[2, words >> 16 & 255]


def segment_keys(words: np.ndarray) -> np.ndarray:
    """Six codeword indices for each 23-bit word; the first is that of its nearest codeword."""
    by_byte, patterns = golay()
    return (words[:, None] ^ patterns[syndrome(words, by_byte)]) >> 11


def segments(prints: np.ndarray) -> list[np.ndarray]:
    """Segments of unsigned 64-bit fingerprints."""
    out, below = [], 64
    for bits in SEGMENTS:
        below -= bits
        out.append((prints >> np.uint64(below) & np.uint64((1 << bits) - 1)).astype(np.int64))
    return out


def fingerprint(text: bytes, words_per_shingle: int = 3) -> int:
    """SimHash of the word shingles, repeats included, as an unsigned number."""
    words = text.lower().split()
    if not words:
        return 0
    joined, k = b" ".join(words), min(words_per_shingle, len(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    n = len(words) - k + 1
    total = np.zeros(64, np.int64)
    stops = ends[k - 1 :].tolist()
    for at in range(0, n, 1 << 16):
        hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts[at : min(n, at + (1 << 16))], stops[at:])], ">u8")
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > n).tobytes(), "big")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _prints(words_per_shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_signed(fingerprint(t, words_per_shingle)) for t in as_bytes(batch["text"])]
            yield pa.record_batch([batch["doc_id"], pa.array(found, pa.int64())], names=["doc_id", "print"])

    return run


def fingerprints(docs: DataFrame, *, words_per_shingle: int = 3) -> DataFrame:
    """``doc_id, print`` (the fingerprint as a signed number)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_prints(words_per_shingle), "doc_id long, print long")


def _index_key(pair: int, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return pair << 24 | first << 12 | second


def _keys(role: str):
    """``index``: the three index keys of each fingerprint; ``both``: those and the probe keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch["print"].to_numpy(zero_copy_only=False)
            for at in range(0, len(prints), 4096):
                part = prints[at : at + 4096]
                keys = [segment_keys(s) for s in segments(part.view(np.uint64))]
                for pair, (i, j) in enumerate(PAIRS):
                    own = _index_key(pair, keys[i][:, 0], keys[j][:, 0])
                    yield pa.record_batch([own, np.ones(len(part), bool), part], names=["key", "index", "print"])
                    if role == "index":
                        continue
                    for a in range(6):
                        for b in range(6):
                            new = (keys[i][:, a] != keys[i][:, 0]) | (a == 0)
                            new &= (keys[j][:, b] != keys[j][:, 0]) | (b == 0)
                            key = _index_key(pair, keys[i][new, a], keys[j][new, b])
                            yield pa.record_batch([key, np.zeros(len(key), bool), part[new]], names=["key", "index", "print"])

    return run


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (member, least member) of the components that the links make."""
    ids, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = inverse[: len(a)], inverse[len(a) :]
    label = np.arange(len(ids))
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        while not np.array_equal(jumped := new[new], new):
            new = jumped
        new = new[label]
        if np.array_equal(new, label):
            break
        label = new
    away = label != np.arange(len(ids))
    return ids[away], ids[label[away]]


def _links(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = whole(batches)
        if held is None:
            return
        key, cell, probe, prints = (held[c].to_numpy() for c in ("key", "cell", "probe", "print"))
        order = np.lexsort((probe, cell, key))
        key, cell, probe, prints = key[order], cell[order], probe[order], prints[order]
        starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (cell[1:] != cell[:-1])])
        sizes = np.diff(np.r_[starts, len(key)])
        entries = np.add.reduceat((~probe).astype(np.int64), starts)  # index entries come first in a group
        first, count = np.repeat(starts, sizes)[probe], np.repeat(entries, sizes)[probe]
        asks = prints[probe]
        used = count > 0
        first, count, asks = first[used], count[used], asks[used]
        ends_a, ends_b, pending = [], [], 0
        at, total = 0, np.cumsum(count)
        offset = 0
        while at < len(asks):
            to = max(at + 1, int(np.searchsorted(total, offset + BLOCK, "right")))
            n = count[at:to]
            for lo in range(0, int(n[0]) if to == at + 1 else 1, BLOCK if to == at + 1 else 1):
                if to == at + 1:  # one probe over a long list of entries
                    spots = first[at] + np.arange(lo, min(int(n[0]), lo + BLOCK))
                    mine = np.full(len(spots), asks[at])
                else:
                    spots = np.repeat(first[at:to] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
                    mine = np.repeat(asks[at:to], n)
                other = prints[spots]
                bits = np.bitwise_count(mine.view(np.uint64) ^ other.view(np.uint64))
                near = (bits <= most) & (mine != other)
                ends_a.append(mine[near])
                ends_b.append(other[near])
                pending += int(near.sum())
            if pending > BLOCK:
                a, b = forest(np.concatenate(ends_a), np.concatenate(ends_b))
                ends_a, ends_b, pending = [a], [b], 0
            offset = int(total[to - 1])
            at = to
        if ends_a:
            a, b = forest(np.concatenate(ends_a), np.concatenate(ends_b))
            yield from packed({"u": a, "v": b}, pa.schema([("u", pa.int64()), ("v", pa.int64())]))

    return run


def near_links(prints: DataFrame, *, most_bits: int = MOST_BITS, crowded: int = CROWDED) -> DataFrame:
    """Links ``u, v`` that join exactly the fingerprints (``print``, distinct) connected at ``most_bits`` or fewer bits."""
    if most_bits > MOST_BITS:
        raise ValueError("three segments find up to three differing bits")
    spark = prints.sparkSession
    schema = "key long, index boolean, print long"
    hot = prints.mapInArrow(_keys("index"), schema).groupBy("key").count().filter(F.col("count") > crowded)
    hot = stored(hot.select("key", F.ceil(F.col("count") / crowded).cast("long").alias("grid")), "simhash-crowded")
    keys = prints.mapInArrow(_keys("both"), schema).join(hot, "key", "left")
    spot = F.pmod(F.xxhash64("print"), F.col("grid"))
    cells = F.transform(F.sequence(F.lit(0), F.col("grid") - 1), lambda x: F.when(F.col("index"), spot * F.col("grid") + x).otherwise(x * F.col("grid") + spot))
    placed = keys.select(
        "key", (~F.col("index")).alias("probe"), "print",
        F.explode(F.when(F.col("grid").isNull(), F.array(F.lit(0).cast("long"))).otherwise(cells)).alias("cell"),
    )
    parts = parts_for(spark, prints.count() * 85, TASK_ROWS)
    return placed.repartition(parts, "key", "cell").mapInArrow(_links(most_bits), "u long, v long").distinct()


def near_groups(docs: DataFrame, *, words_per_shingle: int = 3, most_bits: int = MOST_BITS, crowded: int = CROWDED) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id`` (the least ``doc_id`` that links reach)."""
    rows = stored(fingerprints(docs, words_per_shingle=words_per_shingle), "simhash-rows")
    distinct = stored(rows.groupBy("print").agg(F.min("doc_id").alias("least")), "simhash-prints")
    groups = components(distinct.select(F.col("print").alias("id")), near_links(distinct.select("print"), most_bits=most_bits, crowded=crowded))
    joined = groups.join(distinct.withColumnRenamed("print", "id"), "id")
    least = joined.groupBy("group").agg(F.min("least").alias("component_id"))
    found = stored(joined.join(least, "group").select(F.col("id").alias("print"), "component_id"), "simhash-groups")
    return rows.join(found, "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


def near_stars(texts: DataFrame, *, words_per_shingle: int = 3, most_bits: int = MOST_BITS) -> DataFrame:
    """Each text (``id, text``) as ``v`` with another ``u``: the first text of the least fingerprint that its own is linked to,
    or of its own.  The stars of :func:`near_links` serve as they are, without walking whole components."""
    docs = texts.select(F.col("id").alias("doc_id"), "text")
    rows = stored(fingerprints(docs, words_per_shingle=words_per_shingle), "simhash-rows")
    distinct = stored(rows.groupBy("print").agg(F.min("doc_id").alias("first")), "simhash-prints")
    links = near_links(distinct.select("print"), most_bits=most_bits)
    hung = links.groupBy(F.greatest("u", "v").alias("print")).agg(F.min(F.least("u", "v")).alias("least"))
    firsts = distinct.join(hung, "print", "left").select("print", F.coalesce("least", "print").alias("least"))
    firsts = firsts.join(distinct.withColumnRenamed("print", "least"), "least").select("print", "first")
    return rows.join(stored(firsts, "simhash-stars"), "print").filter("doc_id != first").select(F.col("first").alias("u"), F.col("doc_id").alias("v"))


def drop_near_copies(docs: DataFrame, *, words_per_shingle: int = 3, most_bits: int = MOST_BITS) -> DataFrame:
    """One document of each near-duplicate group, the one of the least id, with all its columns."""
    keep = near_groups(docs, words_per_shingle=words_per_shingle, most_bits=most_bits)
    keep = keep.filter("doc_id <=> component_id").select(F.col("doc_id").alias("_id")).distinct()
    return docs.join(keep, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
