"""Substring deduplication with fixed-block anchors.

Reference blocks of ``ANCHOR`` words that don't overlap are indexed; every rolling window of ``ANCHOR`` words probes the index.  A
repeat of ``window`` words, at least twice a block less one, holds a whole block at one of its places, so the other place has a
rolling window that hits it.  Only the windows of full length around hits are extended: they repeat exactly where their 128-bit
digests do, and the union of neighbouring repeats is the maximal exact repeat.  No two places are ever paired, so a passage that
thousands of documents share costs its occurrences, not their square.

Questions travel packed: a task sends, for a group of texts and a part of the hash space, one bit per window and four bytes per
rolling window (the part fixes the other bits, so the share of chance hits is the same at every size).  A hash that a group holds
twice is answered on the spot and sent once, so hot passages are combined before the shuffle.  Answers are bits again; they
meet the group's directory, which tells whose windows they are.  Texts themselves are shuffled once, those with hits a second
time.

Defined results: null and empty texts have no words; copies of a text lose every word once they reach the window's length; repeated
rows are copies; windows are judged on the input; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import count, groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.llm.common import as_bytes, parts_for, stored

WINDOW, ANCHOR = 35, 18
#: Bytes of text whose windows make up one part of the hash space.
PART_BYTES = 24_000_000
#: Words that a task works on at once, and word hashes that it remembers.
GROUP_WORDS, MEMORY = 400_000, 300_000
_R = np.uint64(0x9E3779B97F4A7C15)
_QUESTION = (
    "part int, team long, ids binary, counts binary, own binary, own_counts binary, sent binary, low binary, high binary, "
    "anchor binary, many binary"
)
_QUESTION_ARROW = pa.schema(
    [("part", pa.int32()), ("team", pa.int64())]
    + [(n, pa.binary()) for n in ("ids", "counts", "own", "own_counts", "sent", "low", "high", "anchor", "many")]
)
_ANSWER = "team long, part int, ids binary, counts binary, own binary, own_counts binary, hits binary"
_ANSWER_ARROW = pa.schema([("team", pa.int64()), ("part", pa.int32()), *[(n, pa.binary()) for n in ("ids", "counts", "own", "own_counts", "hits")]])
_FOUND = "text_id binary, found array<struct<part:int,at:binary>>"
_FOUND_ARROW = pa.schema([("text_id", pa.binary()), ("found", pa.list_(pa.struct([("part", pa.int32()), ("at", pa.binary())])))])


class _Hashes(dict):
    """Word hashes, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > MEMORY:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def rolling(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` word hashes."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for i in range(size):
        h *= _R
        h += words[i : i + n]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def _placed(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, position and place in the concatenation of every window of ``size`` words."""
    windows = np.maximum(lengths - size + 1, 0)
    owner = np.repeat(np.arange(len(lengths)), windows)
    pos = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    return owner, pos, pos + np.repeat(np.cumsum(lengths) - lengths, windows)


def _groups(texts: list[bytes]) -> Iterator[tuple[int, list[list[bytes]]]]:
    """Words of consecutive texts, about ``GROUP_WORDS`` at a time, with the number of the first text."""
    first, held, n = 0, [], 0
    for i, text in enumerate(texts):
        held.append(text.split())
        n += len(held[-1])
        if n > GROUP_WORDS:
            yield first, held
            first, held, n = i + 1, [], 0
    if held:
        yield first, held


def _anchors(docs: list[list[bytes]], memory: _Hashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, position and hash of every rolling window."""
    lengths = np.array([len(d) for d in docs])
    words = np.array([memory[w] for d in docs for w in d], np.uint64)
    owner, pos, place = _placed(lengths, ANCHOR)
    return owner, pos, rolling(words, ANCHOR)[place]


def _digest_windows(words: list[bytes], starts: np.ndarray, window: int) -> np.ndarray:
    """128-bit digests of whole windows as rows of two numbers."""
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    begins = np.r_[0, ends[:-1]][starts].tolist()
    digest = xxhash.xxh3_128_digest
    raw = b"".join([digest(joined[a:b]) for a, b in zip(begins, (ends[starts + window - 1] - 1).tolist())])
    return np.frombuffer(raw, ">u8").astype(np.uint64).reshape(-1, 2)


def _part(high: np.ndarray, parts: int) -> np.ndarray:
    return ((high >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)


def _same(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order that sorts the keys, and the number of the group of equal keys of each sorted entry."""
    order = np.lexsort(keys) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    new = np.zeros(len(order), bool)
    for key in keys:
        k = key[order]
        new[1:] |= k[1:] != k[:-1]
    return order, np.cumsum(new)


def _bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def _flags(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


def _questions(team: int, ids: list[bytes], owner, pos, low, high, anchor, part, parts: int) -> pa.RecordBatch:
    """Question rows of one group of texts and its directory: the texts, their windows per part, and the positions of windows
    that repeat within the group, which are answered here and sent once."""
    columns: dict[str, list] = {n: [] for n in _QUESTION_ARROW.names}

    def add(**values):
        for name in _QUESTION_ARROW.names:
            columns[name].append(values.get(name))

    keys = (low, part) if high is None else (low, high)
    order, group = _same(*keys)
    many, sent, anchored = np.zeros(len(low), bool), np.ones(len(low), bool), anchor.copy()
    if len(order):
        repeats = np.bincount(group)[group] > 1
        first = np.r_[True, group[1:] != group[:-1]]
        sent[order] = ~repeats | first
        many[order] = repeats
        anchored[order] = (np.bincount(group, anchor[order]) > 0)[group]
    by_part = np.argsort(part, kind="stable")
    cuts = np.searchsorted(part[by_part], np.arange(parts + 1))
    counts = np.bincount(owner * parts + part, minlength=len(ids) * parts).reshape(len(ids), parts)
    own = np.flatnonzero(many)
    add(
        part=team % parts, team=team, ids=b"".join(ids), counts=counts.astype("<u4").tobytes(), own=pos[own].astype("<u4").tobytes(),
        own_counts=np.bincount(owner[own], minlength=len(ids)).astype("<u4").tobytes(),
    )
    for p in np.flatnonzero(np.diff(cuts)).tolist():
        rows = by_part[cuts[p] : cuts[p + 1]]
        kept = rows[sent[rows]]
        add(
            part=p, team=team, sent=_bits(sent[rows]), low=low[kept].tobytes(), high=None if high is None else high[kept].tobytes(),
            anchor=_bits(anchored[kept]), many=_bits(many[kept]), counts=len(rows).to_bytes(8, "little"),
        )
    return pa.record_batch([pa.array(columns[f.name], f.type) for f in _QUESTION_ARROW], schema=_QUESTION_ARROW)


def _teams() -> Iterator[int]:
    """Numbers of a task's groups of texts, equal when the task runs again."""
    return count(TaskContext.get().partitionId() << 32)


def _ask_anchors(parts: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory, teams = _Hashes(), _teams()
        for batch in batches:
            fresh = dict(zip(batch["text_id"].to_pylist(), as_bytes(batch["text"])))
            ids, texts = list(fresh), list(fresh.values())
            for first, docs in _groups(texts):
                owner, pos, h = _anchors(docs, memory)
                low = (h & np.uint64(0xFFFFFFFF)).astype("<u4")
                own = ids[first : first + len(docs)]
                yield _questions(next(teams), own, owner, pos, low, None, pos % ANCHOR == 0, _part(h, parts), parts)

    return run


def _ask_windows(parts: int, window: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        teams = _teams()
        for batch in batches:
            ids, starts = batch["text_id"].to_pylist(), batch["starts"].to_pylist()
            for first, docs in _groups(as_bytes(batch["text"])):
                at = [np.frombuffer(s, "<u4").astype(np.int64) for s in starts[first : first + len(docs)]]
                digests = np.concatenate([_digest_windows(d, s, window) for d, s in zip(docs, at)])
                owner = np.repeat(np.arange(len(docs)), [len(s) for s in at])
                high = digests[:, 0].copy()
                own, every = ids[first : first + len(docs)], np.ones(len(high), bool)
                yield _questions(next(teams), own, owner, np.concatenate(at), digests[:, 1].copy(), high, every, _part(high, parts), parts)

    return run


def _answer_part(asked: list[dict]) -> Iterator[tuple[int, bytes]]:
    """All questions of one part: windows seen more than once, at least once as an anchor, as bits by group of texts."""
    wide = asked[0]["high"] is not None
    low = np.concatenate([np.frombuffer(r["low"], "<u8" if wide else "<u4") for r in asked])
    keys = (low, np.concatenate([np.frombuffer(r["high"], "<u8") for r in asked])) if wide else (low,)
    sent = [_flags(r["sent"], int.from_bytes(r["counts"], "little")) for r in asked]
    kept = [int(s.sum()) for s in sent]
    anchor = np.concatenate([_flags(r["anchor"], k) for r, k in zip(asked, kept)])
    many = np.concatenate([_flags(r["many"], k) for r, k in zip(asked, kept)])
    order, group = _same(*keys)
    times = np.bincount(group, 1 + many[order].astype(np.int64))
    anchored = np.bincount(group, anchor[order]) > 0
    hit = np.zeros(len(low), bool)
    hit[order] = ((times > 1) & anchored)[group]
    hit &= ~many
    at = 0
    for row, bits, n in zip(asked, sent, kept):
        if hit[at : at + n].any():
            own = np.zeros(len(bits), bool)
            own[np.flatnonzero(bits)] = hit[at : at + n]
            yield row["team"], _bits(own)
        at += n


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Answers of each part; directories pass through as part -1."""
    for part, rows in groupby(_rows(batches), key=lambda r: r["part"]):
        asked, out = [], []
        for row in rows:
            if row["ids"] is None:
                asked.append(row)
            else:
                out.append((row["team"], -1, row["ids"], row["counts"], row["own"], row["own_counts"], None))
        if asked:
            out += [(team, part, None, None, None, None, bits) for team, bits in _answer_part(asked)]
        for i in range(0, len(out), 500):
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out[i : i + 500]), _ANSWER_ARROW)], schema=_ANSWER_ARROW)


def _resolved(parts: int) -> Callable:
    """Answers of a group of texts, told apart by its directory: packed ordinals per text and part, or positions as part -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in groupby(_rows(batches), key=lambda r: r["team"]):
            book = next(rows)  # part -1 sorts first
            n = len(book["ids"]) // 32
            counts = np.frombuffer(book["counts"], "<u4").astype(np.int64).reshape(n, parts)
            found: list[list] = [[] for _ in range(n)]

            def deal(part: int, values: np.ndarray, sizes: np.ndarray, found=found) -> None:
                ends = np.cumsum(sizes)
                for doc in np.flatnonzero(sizes).tolist():
                    found[doc].append({"part": part, "at": values[ends[doc] - sizes[doc] : ends[doc]].astype("<u4").tobytes()})

            deal(-1, np.frombuffer(book["own"], "<u4"), np.frombuffer(book["own_counts"], "<u4").astype(np.int64))
            for row in rows:
                own = counts[:, row["part"]]
                begins = np.cumsum(own) - own
                spots = np.flatnonzero(_flags(row["hits"], int(own.sum())))
                doc = np.searchsorted(begins, spots, "right") - 1
                deal(row["part"], spots - begins[doc], np.bincount(doc, minlength=n))
            out = [(book["ids"][32 * d : 32 * d + 32], x) for d, x in enumerate(found) if x]
            if out:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), _FOUND_ARROW)], schema=_FOUND_ARROW)

    return run


def _ask(questions: DataFrame, parts: int, name: str) -> DataFrame:
    """Answers by text: ``text_id, found`` (array of part and packed ordinals, or -1 and packed positions)."""
    dealt = questions.repartition(parts_for(questions.sparkSession, parts, 1), "part").sortWithinPartitions("part")
    answers = dealt.mapInArrow(_answers, _ANSWER).repartition(parts_for(questions.sparkSession, parts, 1), "team")
    found = answers.sortWithinPartitions("team", "part").mapInArrow(_resolved(parts), _FOUND)
    return stored(found.dropDuplicates(["text_id"]), name)  # answers of copies are alike


def _positions(found: list[dict], pos: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Positions of one text's answers."""
    out = []
    for answer in found:
        at = np.frombuffer(answer["at"], "<u4").astype(np.int64)
        out.append(at if answer["part"] < 0 else pos[np.flatnonzero(part == answer["part"])[at]])
    return np.unique(np.concatenate(out))


def _candidates(parts: int, window: int) -> Callable:
    """Windows of full length that hold a hit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory, seen = _Hashes(), set()
        for batch in batches:
            found = batch["found"].to_pylist()
            ids, texts = batch["text_id"].to_pylist(), as_bytes(batch["text"])
            out: list[tuple] = []
            for i, docs in ((f + j, [d]) for f, group in _groups(texts) for j, d in enumerate(group)):
                n = len(docs[0]) - window + 1
                if ids[i] in seen or n <= 0:
                    continue
                seen.add(ids[i])
                _, pos, h = _anchors(docs, memory)
                hits = _positions(found[i], pos, _part(h, parts))
                change = np.zeros(n + 1, np.int64)
                np.add.at(change, np.minimum(np.maximum(hits - (window - ANCHOR), 0), n), 1)
                np.add.at(change, np.minimum(hits + 1, n), -1)
                starts = np.flatnonzero(np.cumsum(change[:-1]) > 0)
                if len(starts):
                    out.append((ids[i], texts[i].decode(), starts.astype("<u4").tobytes()))
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.string(), pa.binary()))], names=["text_id", "text", "starts"])

    return run


def _cut(parts: int, window: int) -> Callable:
    """What is left of texts with repeated windows."""
    schema = pa.schema([("text_id", pa.binary()), ("n_cut", pa.int64()), ("kept", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for text_id, text, starts, found in zip(*(batch[c].to_pylist() for c in ("text_id", "text", "starts", "found"))):
                words, at = text.encode().split(), np.frombuffer(starts, "<u4").astype(np.int64)
                part = _part(_digest_windows(words, at, window)[:, 0], parts)
                change = np.zeros(len(words) + 1, np.int64)
                repeated = _positions(found, at, part)
                change[repeated] += 1
                change[repeated + window] -= 1
                covered = np.cumsum(change[:-1]) > 0
                kept = b" ".join([words[i] for i in np.flatnonzero(~covered).tolist()])
                out.append((text_id, int(covered.sum()), kept.decode()))
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)] if out else [pa.array([], f.type) for f in schema], schema=schema)

    return run


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [t.split() for t in as_bytes(batch["text"])]
        whole = [hashlib.sha256(b" ".join(w)).hexdigest() for w in words]
        yield pa.record_batch(
            [batch["doc_id"], batch["text_id"], pa.array([len(w) for w in words], pa.int64()), pa.array(whole, pa.string())],
            names=["doc_id", "text_id", "n_words", "whole_sha256"],
        )


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text of a batch once."""
    for batch in batches:
        fresh = dict(zip(batch["text_id"].to_pylist(), batch["text"].to_pylist()))
        yield pa.record_batch([pa.array(list(fresh), pa.binary()), pa.array(list(fresh.values()), pa.string())], names=["text_id", "text"])


def repeats(docs: DataFrame, *, window: int = WINDOW) -> DataFrame:
    """Different texts that hold repeated windows: ``text_id, n_cut`` (words covered), ``kept`` (the other words, one blank apart).

    Texts of several rows aren't listed for that reason alone: all their windows repeat.
    """
    if window < 2 * ANCHOR - 1:
        raise ValueError(f"a window of fewer than {2 * ANCHOR - 1} words may hold no whole block")
    spark = docs.sparkSession
    texts = docs.select(F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("text_id"), "text")
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-size // PART_BYTES))
    hits = _ask(texts.mapInArrow(_ask_anchors(parts), _QUESTION), parts, "substrings-hits")
    width = parts_for(spark, size, PART_BYTES)
    near = texts.mapInArrow(_once, "text_id binary, text string").repartition(width, "text_id").join(hits, "text_id")
    held = stored(near.mapInArrow(_candidates(parts, window), "text_id binary, text string, starts binary"), "substrings-candidates")
    found = _ask(held.mapInArrow(_ask_windows(parts, window), _QUESTION), parts, "substrings-windows")
    return held.join(found, "text_id").select("text_id", "text", "starts", "found").mapInArrow(_cut(parts, window), "text_id binary, n_cut long, kept string")


def dedup_substrings(docs: DataFrame, *, window: int = WINDOW) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, kept_sha256``."""
    texts = docs.select("doc_id", F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("text_id"), "text")
    cut = repeats(docs, window=window).select("text_id", "n_cut", F.sha2("kept", 256).alias("cut_sha256"))
    cut = cut.dropDuplicates(["text_id"])
    copies = texts.groupBy("text_id").count().filter("count > 1").withColumnRenamed("count", "copies")
    known = stored(copies.join(cut, "text_id", "full"), "substrings-known")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = texts.mapInArrow(_counted, f"doc_id {id_type}, text_id binary, n_words long, whole_sha256 string").join(known, "text_id", "left")
    copied = F.col("copies").isNotNull() & (F.col("n_words") >= window)
    return rows.select(
        "doc_id", "n_words",
        F.when(copied, F.col("n_words")).otherwise(F.coalesce("n_cut", F.lit(0))).alias("n_removed"),
        F.when(copied, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("cut_sha256", "whole_sha256")).alias("kept_sha256"),
    )
