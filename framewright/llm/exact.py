"""Exact deduplication in three merges, each of which compares whole contents.

1. **Local**: the rows of one task with equal contents become one entry, as far as ``LOCAL_BYTES`` reach.
2. **Salted**: entries meet by digest and salt.  All are spread over ``salts`` groups by the place of their row, so a text that a third
   of all rows share, or one that every task holds once, isn't gathered by one task.
3. **Global**: the winners of the salts meet by digest.

A merge sorts its entries by digest and compares the contents of neighbours, so a task holds one digest's different contents
and no list of its rows.  Rows find their group again by SHA-256 and XXH64 of the content, without carrying it.

Defined results: null text counts as empty; texts of blanks only are one group; null ``doc_id`` loses every tie and may be the
kept id only where a group has no other; of rows that tie in length and id the first in the table's order stays; an empty table
gives an empty result; other columns are ignored by :func:`exact_groups` and passed through by :func:`drop_copies`.  Row
order is that of one scan, in which the rows are numbered and written.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.llm.common import BLANKS, as_bytes, stored

#: Contents that a task holds before it sends them on, and what an entry takes besides its content.
LOCAL_BYTES, ENTRY_BYTES = 32_000_000, 200
ENTRY = "digest binary, salt int, content binary, n long, id long, place long, rows long"
_ENTRY = pa.schema(
    [("digest", pa.binary()), ("salt", pa.int32()), ("content", pa.binary()), ("n", pa.int64()), ("id", pa.int64()),
     ("place", pa.int64()), ("rows", pa.int64())]
)
_ROW = pa.schema([("doc_id", pa.int64()), ("place", pa.int64()), ("digest", pa.binary()), ("mark", pa.int64())])


def normalised(text: bytes) -> bytes:
    """The text without blanks."""
    return text.translate(None, BLANKS)


def _rank(n, doc_id, place):
    """Orders rows of a group: longest first, then least id (null last), then first place."""
    return -n, doc_id is None, doc_id or 0, place


def _lengths(column) -> list[int]:
    import pyarrow.compute as pc

    return pc.fill_null(pc.utf8_length(column), 0).to_pylist()


def _local(salts: int):
    def entries(best: dict[bytes, list]) -> pa.RecordBatch:
        columns = {name: [] for name in _ENTRY.names}
        for content, (n, doc_id, place, rows) in best.items():
            # every entry is salted: a text may be alone in each task and still be in very many of them
            for name, value in zip(_ENTRY.names, (hashlib.sha256(content).digest(), place % salts, content, n, doc_id, place, rows)):
                columns[name].append(value)
        return pa.record_batch(columns, schema=_ENTRY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[bytes, list] = {}
        size = 0
        for batch in batches:
            ids, places = batch["doc_id"].to_pylist(), batch["place"].to_pylist()
            for doc_id, place, n, text in zip(ids, places, _lengths(batch["text"]), as_bytes(batch["text"])):
                content = normalised(text)
                held = best.get(content)
                if held is None:
                    best[content] = [n, doc_id, place, 1]
                    size += len(content) + ENTRY_BYTES
                else:
                    held[3] += 1
                    if _rank(n, doc_id, place) < _rank(*held[:3]):
                        held[:3] = n, doc_id, place
            if size > LOCAL_BYTES:
                yield entries(best)
                best, size = {}, 0
        yield entries(best)

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries sorted by digest: equal contents become one.  Holds the different contents of one digest at a time."""
    digest, held = None, []
    for batch in batches:
        out = []
        for row in zip(*(batch[name].to_pylist() for name in _ENTRY.names)):
            if row[0] != digest:
                out += held
                digest, held = row[0], []
            for i, other in enumerate(held):
                if other[2] == row[2]:
                    first = min(other, row, key=lambda x: _rank(*x[3:6]))
                    held[i] = (*first[:6], other[6] + row[6])
                    break
            else:
                held.append(row)
        if out:
            yield pa.record_batch([list(c) for c in zip(*out)], schema=_ENTRY)
    if held:
        yield pa.record_batch([list(c) for c in zip(*held)], schema=_ENTRY)


def _winner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("digest", pa.binary()), ("mark", pa.int64()), ("keep_id", pa.int64()), ("keep_place", pa.int64()), ("group_size", pa.int64())])
    for batch in _merge(batches):
        marks = [xxhash.xxh64_intdigest(x) - (1 << 63) for x in batch["content"].to_pylist()]
        yield pa.record_batch([batch["digest"], pa.array(marks), batch["id"], batch["place"], batch["rows"]], schema=schema)


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        contents = [normalised(x) for x in as_bytes(batch["text"])]
        digests = [hashlib.sha256(x).digest() for x in contents]
        marks = [xxhash.xxh64_intdigest(x) - (1 << 63) for x in contents]
        yield pa.record_batch([batch["doc_id"], batch["place"], pa.array(digests, pa.binary()), pa.array(marks, pa.int64())], schema=_ROW)


def _numbered(docs: DataFrame) -> DataFrame:
    """The rows with a number ``_place``, written: scans may cut the files anew each time, so rows are numbered only once."""
    return stored(docs.withColumn("_place", F.monotonically_increasing_id()), "exact-placed")


def exact_groups(docs: DataFrame, *, salts: int = 16) -> DataFrame:
    """One row per document: ``doc_id, place, keep_id, keep_place, group_size, kept, text_sha256``.

    ``place`` is the row's number in one scan; it tells rows with equal ids apart.
    """
    return _groups(_numbered(docs.select("doc_id", "text")), salts)


def _groups(numbered: DataFrame, salts: int) -> DataFrame:
    placed = numbered.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("_place").alias("place"), "text")
    entries = placed.mapInArrow(_local(salts), ENTRY)
    salted = entries.repartition("digest", "salt").sortWithinPartitions("digest").mapInArrow(_merge, ENTRY)
    merged = salted.repartition("digest").sortWithinPartitions("digest")
    winners = stored(merged.mapInArrow(_winner, "digest binary, mark long, keep_id long, keep_place long, group_size long"), "exact-winners")
    rows = placed.mapInArrow(_marked, "doc_id long, place long, digest binary, mark long")
    return rows.join(winners, ["digest", "mark"]).select(
        "doc_id", "place", "keep_id", "keep_place", "group_size",
        (F.col("place") == F.col("keep_place")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, *, salts: int = 16) -> DataFrame:
    """The rows that stay, with all their columns."""
    numbered = _numbered(docs)
    places = _groups(numbered, salts).filter("kept").select(F.col("place").alias("_place"))
    return numbered.join(places, "_place", "left_semi").drop("_place")
