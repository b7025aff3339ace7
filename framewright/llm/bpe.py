"""Byte-level BPE encoding and decoding with a two-tier lookup.

Tier one is a minimal perfect hash over the vocabulary: a pre-token that is a vocabulary entry gets its id with one probe and one
comparison.  Tier two is for the others: bytes in a linked list, candidate merges in a heap by rank, each merge looking up
only its two neighbours.  Workers remember the answers for recent pieces, up to twice ``MEMORY`` of them.

Defined results: null counts as the empty text, which has no ids and decodes to nothing; repeated rows and null ``doc_id`` get
their own answers; an empty table gives an empty result; other columns are ignored by :func:`encode`.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.llm.common import as_text, spaced

#: Bytes of a generation of a worker's memory of pieces and of matches, of which there are two each, with what an entry takes besides its
#: text; and pairs of tokens that it knows.
MEMORY, MATCH_MEMORY, ENTRY_BYTES, PAIRS = 80_000_000, 24_000_000, 200, 400_000
_MIX, _BITS = 0x9E3779B97F4A7C15, (1 << 64) - 1


def read_ranks(path: str) -> list[tuple[bytes, int]]:
    """Tokens and ranks of a rank file (base64 token, blank, rank per line)."""
    with open(path, "rb") as lines:
        return [(base64.b64decode(token), int(rank)) for token, rank in map(bytes.split, lines)]


class PerfectHash:
    """Minimal perfect hash by displacement: as many slots as keys, each key in a slot of its own."""

    def __init__(self, entries: list[tuple[bytes, int]]) -> None:
        self.size, self.buckets = len(entries), max(1, len(entries) // 2)
        self.keys: list[bytes] = [b""] * self.size
        self.values = [-1] * self.size
        self.shift = [0] * self.buckets
        by_bucket: dict[int, list[tuple[int, bytes, int]]] = {}
        for key, value in entries:
            h = xxhash.xxh64_intdigest(key)
            by_bucket.setdefault(h % self.buckets, []).append((h, key, value))
        taken = bytearray(self.size)
        free = 0
        for bucket, members in sorted(by_bucket.items(), key=lambda x: -len(x[1])):
            if len(members) == 1:  # a lone key is sent to a free slot by name
                while taken[free]:
                    free += 1
                self.shift[bucket], slots = -free - 1, [free]
            else:
                shift = 0
                while True:
                    slots = [self._slot(h, shift) for h, _, _ in members]
                    if len(set(slots)) == len(slots) and not any(taken[s] for s in slots):
                        break
                    shift += 1
                self.shift[bucket] = shift
            for slot, (_, key, value) in zip(slots, members):
                taken[slot], self.keys[slot], self.values[slot] = 1, key, value

    def _slot(self, h: int, shift: int) -> int:
        x = (h + shift * _MIX) & _BITS
        x = (x ^ x >> 31) * _MIX & _BITS
        return (x ^ x >> 29) % self.size

    def find(self, key: bytes) -> int:
        """Value of a key, -1 for anything else."""
        h = xxhash.xxh64_intdigest(key)
        shift = self.shift[h % self.buckets]
        slot = -shift - 1 if shift < 0 else self._slot(h, shift)
        return self.values[slot] if self.keys[slot] == key else -1


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, ranks: list[tuple[bytes, int]], pattern: str, table: PerfectHash | None = None) -> None:
        self.table = table or PerfectHash(ranks)
        self.pattern = regex.compile(pattern)
        self.single = [self.table.find(bytes([b])) for b in range(256)]
        top = max(rank for _, rank in ranks) + 1
        self.token: list[bytes] = [b""] * top
        for token, rank in ranks:
            self.token[rank] = token
        self.decimal = [str(i) for i in range(top)]
        self.pairs: dict[int, int] = {}
        # two generations each: what is still used moves to the younger one
        self.matches: dict[str, bytes] = {}
        self.older_matches: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.older_pieces: dict[str, bytes] = {}
        self.match_bytes = self.piece_bytes = 0

    def _learn_pair(self, key: int) -> int:
        """Id of two neighbours as one token, -1 if there is none."""
        found = self.pairs[key] = self.table.find(self.token[key >> 32] + self.token[key & 0xFFFFFFFF])
        return found

    def merge(self, match: bytes) -> list[int]:
        """Ids of a pre-token by rank-ordered merges over linked bytes.

        A heap entry is a rank and a place in one number; it is stale if the pair that now starts at the place has another rank.
        """
        ids = list(map(self.single.__getitem__, match))
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs, learn = self.pairs, self._learn_pair
        if len(pairs) > PAIRS:  # never within a merge, which checks its entries against it
            pairs.clear()
        heap = []
        left = ids[0]
        for i in range(n - 1):
            right = ids[i + 1]
            key = left << 32 | right
            rank = pairs.get(key)
            if rank is None:
                rank = learn(key)
            if rank >= 0:
                heap.append(rank << 32 | i)
            left = right
        heapify(heap)
        while heap:
            entry = heappop(heap)
            i = entry & 0xFFFFFFFF
            j = after[i]
            if j >= n or ids[i] < 0 or pairs.get(ids[i] << 32 | ids[j]) != entry >> 32:
                continue
            rank = entry >> 32
            ids[i], ids[j] = rank, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                key = rank << 32 | ids[k]
                found = pairs.get(key)
                if found is None:
                    found = learn(key)
                if found >= 0:
                    heappush(heap, found << 32 | i)
            h = before[i]
            if h >= 0:
                key = ids[h] << 32 | rank
                found = pairs.get(key)
                if found is None:
                    found = learn(key)
                if found >= 0:
                    heappush(heap, found << 32 | h)
        return [x for x in ids if x >= 0]

    def _match(self, match: str) -> bytes:
        found = self.matches.get(match) or self.older_matches.get(match)
        if found is None:
            data = match.encode()
            whole = self.table.find(data)
            found = np.array([whole], "<u4").tobytes() if whole >= 0 else array("I", self.merge(data)).tobytes()
            self.match_bytes += len(match) + len(found) + ENTRY_BYTES
            if self.match_bytes > MATCH_MEMORY:
                self.matches, self.older_matches, self.match_bytes = {}, self.matches, 0
            self.matches[match] = found
        return found

    def _learn_piece(self, part: str) -> None:
        """Ids of a part of a text with the space before it."""
        found = self.older_pieces.get(part)
        if found is None:
            found = b"".join(map(self._match, self.pattern.findall(" " + part)))
        self.pieces[part] = found
        self.piece_bytes += len(part) + len(found) + ENTRY_BYTES

    def encode(self, text: str) -> np.ndarray:
        parts = spaced(text)
        if parts is None:
            return np.frombuffer(b"".join(map(self._match, self.pattern.findall(text))), "<u4")
        rest = parts[1:]
        if self.piece_bytes > MEMORY:
            self.pieces, self.older_pieces, self.piece_bytes = {}, self.pieces, 0
        for part in set(rest).difference(self.pieces):
            self._learn_piece(part)
        return np.frombuffer(b"".join([*map(self._match, self.pattern.findall(parts[0])), *map(self.pieces.__getitem__, rest)]), "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.token.__getitem__, ids.tolist()))


_codecs: dict[str, Codec] = {}


def _codec(shared: Broadcast, name: str) -> Codec:
    """The worker's codec of a vocabulary, made once."""
    if name not in _codecs:
        _codecs[name] = Codec(*shared.value)
    return _codecs[name]


def share(spark: SparkSession, ranks_path: str, pattern: str) -> tuple[Broadcast, str]:
    """The vocabulary and its hash for all workers: a file of fixed size that the driver reads."""
    ranks = read_ranks(ranks_path)
    name = hashlib.sha256(repr((pattern, ranks)).encode()).hexdigest()
    return spark.sparkContext.broadcast((ranks, pattern, PerfectHash(ranks))), name


def _encoder(shared: Broadcast, name: str) -> Callable:
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared, name)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [codec.encode(t) for t in as_text(part["text"])]
                decoded = [codec.decode(x) for x in ids]
                columns = [part["doc_id"], pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())), pa.array(decoded, pa.binary())]
                yield pa.record_batch(columns, schema=schema)

    return run


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``doc_id, ids`` (array of int), ``decoded`` (the bytes that the ids stand for)."""
    shared, name = share(docs.sparkSession, ranks_path, pattern)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(_encoder(shared, name), "doc_id long, ids array<int>, decoded binary")


def _digester(shared: Broadcast, name: str) -> Callable:
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared, name)
        sha = hashlib.sha256
        for batch in batches:
            counts, listed, back = [], [], []
            for text in as_text(batch["text"]):
                ids = codec.encode(text)
                counts.append(len(ids))
                listed.append(sha(",".join(map(codec.decimal.__getitem__, ids.tolist())).encode()).hexdigest())
                back.append(sha(codec.decode(ids)).hexdigest())
            yield pa.record_batch([batch["doc_id"], pa.array(counts, pa.int64()), pa.array(listed), pa.array(back)], schema=schema)

    return run


def digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Round trip of each text: ``doc_id, n_tokens, ids_sha256, decoded_sha256``, without shipping the ids."""
    shared, name = share(docs.sparkSession, ranks_path, pattern)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(_digester(shared, name), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
