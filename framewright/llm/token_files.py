"""Token ids in files of directly addressable codes.

A segment holds the ids of consecutive documents.  Each id is split into chunks of ``CHUNK_BITS`` bits, lowest first.  Level ``k``
holds the ``k``-th chunk of every id that has one, one bit per chunk tells whether the id goes on, and a rank directory counts
the bits before every block.  Token ``i`` is read from level 0 at ``i``; where its bit is set, the rank of that bit is its place
in level 1, and so on: no block is decoded.

The ids come from the ``tokenizers`` library.  It sees every different piece of a text (cut before single spaces, where the
byte-level pre-tokeniser cuts too) once per worker memory.  A file set is a Parquet table of segments in ascending
``doc_id`` order, written below the cluster's shared folder; :func:`documents` reads it back.

Defined results: null counts as the empty text, which has the end id alone; null ``doc_id`` comes first; rows with equal ids follow
the order of their texts' hash; an empty table gives empty files; other columns are ignored.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framewright.llm.common import as_text, parts_for, spaced

CHUNK_BITS = 8
#: Bits that one entry of a rank directory covers.
RANK_BLOCK = 512
#: Fixed values of the format: mark, and header of number of ids and number of levels.
MAGIC, HEADER = b"DAC1", struct.Struct("<4sQI")
#: Ids of a segment, about (a document is never split), and text bytes of a writing task.
SEGMENT_IDS, PART_BYTES = 1_000_000, 64_000_000
#: Pieces of a generation of a worker's memory.
MEMORY = 800_000
FILES = "part int, seq int, n long, doc_ids array<long>, ends array<long>, body binary"


def pack(ids: np.ndarray) -> bytes:
    """A segment's bytes."""
    rest, levels = ids.astype(np.uint64), []
    while len(rest):
        more = rest >> np.uint64(CHUNK_BITS)
        flags = more > 0
        bits = np.packbits(flags, bitorder="little")
        bits = np.pad(bits, (0, -len(bits) % (RANK_BLOCK // 8)))
        per_block = np.bitwise_count(bits).reshape(-1, RANK_BLOCK // 8).sum(axis=1, dtype=np.uint64)
        ranks = (np.cumsum(per_block) - per_block).astype("<u4")
        levels.append((np.uint64(len(rest)).tobytes(), (rest & np.uint64((1 << CHUNK_BITS) - 1)).astype(np.uint8).tobytes(), bits.tobytes(), ranks.tobytes()))
        rest = more[flags]
    return HEADER.pack(MAGIC, len(ids), len(levels)) + b"".join(x for level in levels for x in level)


class Segment:
    """Reader of a segment; ``segment[i]`` touches one chunk, one bit and one rank entry per level."""

    def __init__(self, body: bytes) -> None:
        magic, self.n, count = HEADER.unpack_from(body)
        if magic != MAGIC:
            raise ValueError("not a segment of directly addressable codes")
        at, self.levels = HEADER.size, []
        for _ in range(count):
            n = int.from_bytes(body[at : at + 8], "little")
            blocks = -(-n // RANK_BLOCK)
            at += 8
            chunks = np.frombuffer(body, np.uint8, n, at)
            bits = np.frombuffer(body, np.uint8, blocks * RANK_BLOCK // 8, at + n)
            at += n + len(bits)
            ranks = np.frombuffer(body, "<u4", blocks, at)
            at += 4 * blocks
            self.levels.append((chunks, bits, ranks))

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level, (chunks, bits, ranks) in enumerate(self.levels):
            value |= int(chunks[i]) << (CHUNK_BITS * level)
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            block = i // RANK_BLOCK
            before = bits[block * RANK_BLOCK // 8 : i >> 3]
            last = int(bits[i >> 3]) & ((1 << (i & 7)) - 1)
            i = int(ranks[block]) + int(np.bitwise_count(before).sum()) + last.bit_count()
        return value

    def all(self) -> np.ndarray:
        """Every id, level by level."""
        value = np.zeros(self.n, "<u4")
        places = np.arange(self.n)
        for level, (chunks, bits, _) in enumerate(self.levels):
            value[places] |= chunks.astype("<u4") << np.uint32(CHUNK_BITS * level)
            places = places[np.unpackbits(bits, count=len(chunks), bitorder="little").astype(bool)]
        return value


class Encoder:
    """Ids of texts by the ``tokenizers`` library, piece by piece."""

    def __init__(self, definition: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        size = self.tokenizer.get_vocab_size()
        self.opens = np.array([(self.tokenizer.id_to_token(i) or "").startswith("Ġ") for i in range(size)])
        # two generations: what is still used moves to the younger one
        self.memory: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, parts: list[str]) -> None:
        """Ids of parts after a space.  A part holds no other space, so many go through the library as one text, and the tokens
        that open with a space tell them apart."""
        joined = [p for p in parts if p and not p[-1].isspace()]
        lone = [p for p in parts if not p or p[-1].isspace()]
        for at in range(0, len(joined), 4000):
            part = joined[at : at + 4000]
            (ids,) = self._ids([" " + " ".join(part)])
            cuts = np.flatnonzero(self.opens[ids])
            if len(cuts) != len(part):
                lone += part
                continue
            data, cuts = ids.tobytes(), [*(4 * cuts).tolist(), 4 * len(ids)]
            self.memory.update(zip(part, map(data.__getitem__, map(slice, cuts[:-1], cuts[1:]))))
        for part, ids in zip(lone, self._ids([" " + p for p in lone])):
            self.memory[part] = ids.tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text."""
        cut = [spaced(t) for t in texts]
        first = [t if parts is None else parts[0] for t, parts in zip(texts, cut)]
        after = [parts[1:] if parts else () for parts in cut]
        wanted = set(chain.from_iterable(after))
        if len(self.memory) > MEMORY:
            self.memory, self.older = {}, self.memory
        wanted = wanted.difference(self.memory)
        again = [p for p in wanted if p in self.older]
        self.memory.update(zip(again, map(self.older.__getitem__, again)))
        self._learn(list(wanted.difference(again)))
        # first pieces lack the space, and texts with other blanks before a space go whole
        recall = self.memory.__getitem__
        return [b"".join([ids.tobytes(), *map(recall, parts)]) for ids, parts in zip(self._ids(first), after)]


_encoders: dict[int, Encoder] = {}


def _encoder(shared: Broadcast) -> Encoder:
    if shared.value[0] not in _encoders:
        _encoders[shared.value[0]] = Encoder(shared.value[1])
    return _encoders[shared.value[0]]


def _writer(shared: Broadcast, end_id: int) -> Callable:
    schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("n", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("body", pa.binary())])
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, seq = _encoder(shared), TaskContext.get().partitionId(), 0
        ids, held, n = [], [], 0

        def segment():
            ends = np.cumsum([len(x) // 4 for x in held])
            body = pack(np.frombuffer(b"".join(held), "<u4"))
            return pa.record_batch([pa.array([x], f.type) for x, f in zip((part, seq, n, ids, ends.tolist(), body), schema)], schema=schema)

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                for doc_id, data in zip(rows["doc_id"].to_pylist(), encoder.encode(as_text(rows["text"]))):
                    ids.append(doc_id)
                    held.append(data + end)
                    n += len(data) // 4 + 1
                    if n >= SEGMENT_IDS:
                        yield segment()
                        seq, ids, held, n = seq + 1, [], [], 0
        if held:
            yield segment()

    return run


def write(docs: DataFrame, path: str, tokenizer_path: str, end_id: int) -> None:
    """Encode every text, append ``end_id``, and write segments in ascending ``doc_id`` order."""
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as file:
        definition = file.read()  # a file of fixed size
    shared = spark.sparkContext.broadcast((hash(definition), definition))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("_tie"))
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    order = [F.col("doc_id").asc_nulls_first(), F.col("_tie")]
    placed = texts.repartitionByRange(parts_for(spark, size, PART_BYTES), *order).sortWithinPartitions(*order).drop("_tie")
    placed.mapInArrow(_writer(shared, end_id), FILES).write.option("compression", "zstd").parquet(path)


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = Segment(row["body"]).all()
            begins = [0, *row["ends"][:-1]]
            crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(begins, row["ends"])]
            size = len(begins)
            yield pa.record_batch(
                [pa.array([row["part"]] * size, pa.int32()), pa.array([row["seq"]] * size, pa.int32()), pa.array(row["doc_ids"], pa.int64()),
                 pa.array(begins, pa.int64()), pa.array(np.diff([0, *row["ends"]]), pa.int64()), pa.array(crc, pa.int64())],
                names=["part", "seq", "doc_id", "begin", "n_tokens", "ids_crc32"],
            )


def segment_starts(files: DataFrame) -> DataFrame:
    """``part, seq, start``: ids before each segment.  Sums by part first, so only one row per part is ordered as a whole."""
    sizes = files.select("part", "seq", "n")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n").alias("m")).select("part", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    inner = sizes.select("part", "seq", F.coalesce(F.sum("n").over(within), F.lit(0)).alias("inner"))
    return inner.join(parts, "part").select("part", "seq", (F.col("base") + F.col("inner")).alias("start"))


def documents(spark: SparkSession, path: str) -> DataFrame:
    """The files decoded: ``doc_id, start, n_tokens, ids_crc32``."""
    files = spark.read.schema(FILES).parquet(path)
    decoded = files.select("part", "seq", "doc_ids", "ends", "body").mapInArrow(_reader, "part int, seq int, doc_id long, begin long, n_tokens long, ids_crc32 long")
    return decoded.join(segment_starts(files), ["part", "seq"]).select("doc_id", (F.col("start") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32")


def tokens_at(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """Random access: ``position, id`` for the global positions in ``wanted.position``; positions outside are left out."""
    files = spark.read.schema(FILES).parquet(path)
    spans = segment_starts(files).join(files.select("part", "seq", "n"), ["part", "seq"])
    block = lambda at: F.floor(at / SEGMENT_IDS)
    spans = spans.withColumn("block", F.explode(F.sequence(block(F.col("start")), block(F.col("start") + F.col("n") - 1))))
    asked_blocks = wanted.select("position").distinct().withColumn("block", block(F.col("position")))
    near = asked_blocks.join(spans, "block").filter((F.col("position") >= F.col("start")) & (F.col("position") < F.col("start") + F.col("n")))
    asked = near.groupBy("part", "seq").agg(F.first("start").alias("start"), F.collect_set("position").alias("positions"))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                segment = Segment(row["body"])
                found = [segment[p - row["start"]] for p in row["positions"]]
                yield pa.record_batch([pa.array(row["positions"], pa.int64()), pa.array(found, pa.int64())], names=["position", "id"])

    return files.select("part", "seq", "body").join(asked, ["part", "seq"]).select("body", "start", "positions").mapInArrow(pick, "position long, id long")
