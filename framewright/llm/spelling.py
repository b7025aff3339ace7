"""Spelling variants: exact neighbours at one edit by a dictionary of trie-node pairs.

1. **Two tries.** The words are sorted over many tasks, and every task walks its range with a stack: a prefix shared with the
   word before keeps its node, the rest get new numbers.  Ranges hand on the few nodes that their first word shares with the
   range before.  The same is done with the reversed words.  So a prefix and a suffix are one integer each, and a word costs its
   length, however long it is.
2. **Pairs.** Skipping position ``i`` of a word leaves the pair (node of what is before, node of what follows).  Two words that meet
   in a skipped pair differ by one replaced code point.  Cutting a word between two positions gives a pair without a skip; a word
   whose skipped pair is another's cut pair has one code point more.  Of equal neighbours in a word only the first is skipped for
   that, so that two words meet exactly once.
3. **Forms.** A pair holds at most one cut word and one skipped word per letter of the alphabet, so its words are listed and
   each sees the best of the others.  Chains of forms are followed by doubling.

Defined results: null texts have no words, a null ``doc_id`` reads as an empty one; repeated rows count as often as they are there;
the most frequent neighbour is the form, ties go to the first in code-point order; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.llm.common import only, stored

#: The letters of a word, and those that are lower-cased.
LETTERS = r"A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Number of the node above all letters, and the bits that number nodes inside one range.
ROOT, NODE_BITS = -1, 40
#: How a word stands in a pair.  Two words are neighbours where the sum is 2 or more.
CUT, SKIPPED, SKIPPED_FIRST = 0, 1, 2
#: Code points of words that a task spells out at once.
POINTS = 500_000

_PAIR = pa.schema([("head", pa.int64()), ("tail", pa.int64()), ("id", pa.int64()), ("n", pa.int64()), ("kind", pa.int8())])


def occurrences(docs: DataFrame, *, least: int = 7, lose: int = 0) -> DataFrame:
    """Lower-cased words of at least ``least`` letters and how often they occur: ``word, n``.

    With ``lose`` above 0 occurrences are misspelt on purpose: one whose CRC-32 of ``doc_id:word`` is divisible by ``lose``
    loses the letter at the CRC modulo its length.
    """
    runs = F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{least},}}"), F.lit(0))
    word = F.translate("_run", UPPER, LOWER)
    found = only(docs, "doc_id", "text").select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), F.explode(runs).alias("_run"))
    found = found.select("doc_id", word.alias("word"))
    if lose:
        check = F.crc32(F.concat_ws(":", "doc_id", "word").cast("binary"))
        at = F.pmod(check, F.length("word")).cast("int")
        less = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
        found = found.select(F.when(check % lose == 0, less).otherwise(F.col("word")).alias("word")).filter(F.length("word") >= least)
    return found.groupBy("word").agg(F.count("*").alias("n"))


def _shared(a: str, b: str) -> int:
    """Length of the common prefix."""
    most, k = min(len(a), len(b)), 0
    while k < most and a[k] == b[k]:
        k += 1
    return k


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the trie nodes of one sorted range: ``nodes`` has one number per prefix; ``edge`` marks the range's ends."""
    before, path, new, waiting, first = "", [], 0, None, True
    for batch in batches:
        if not batch.num_rows:
            continue
        if waiting is not None:
            yield waiting
        nodes, ends = [], [0]
        for word in batch["_spelt"].to_pylist():
            keep = _shared(before, word)
            path = path[:keep] + list(range(new, new + len(word) - keep))
            new += len(word) - keep
            before = word
            nodes += path
            ends.append(len(nodes))
        edge = np.zeros(batch.num_rows, dtype=bool)
        edge[0] = first
        first = False
        lists = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(nodes, pa.int64())).cast(pa.list_(pa.int64()))
        waiting = batch.append_column("nodes", lists).append_column("edge", pa.array(edge))
    if waiting is not None:
        edge = waiting["edge"].to_numpy(zero_copy_only=False).copy()
        edge[-1] = True
        yield waiting.set_column(waiting.num_columns - 1, "edge", pa.array(edge))


def _trie(words: DataFrame, spelt: Column, name: str) -> tuple[DataFrame, dict[int, np.ndarray]]:
    """The words with their nodes in a trie over ``spelt``, numbered by range, and what each range inherits.

    The second value has, per range, the true numbers of the nodes that its first word shares with the range before.  It comes from
    two words per range, as many as a range shuffle itself keeps.
    """
    ordered = words.withColumn("_spelt", spelt).repartitionByRange("_spelt").sortWithinPartitions("_spelt")
    ordered = ordered.withColumn("_range", F.spark_partition_id())
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ordered.schema)
    walked = stored(ordered.mapInArrow(_walk, f"{fields}, nodes array<long>, edge boolean"), name)
    inherited: dict[int, np.ndarray] = {}
    last, ids = "", np.empty(0, dtype=np.int64)
    for row in walked.filter("edge").select("_range", "_spelt", "nodes").orderBy("_spelt").collect():
        if row["_range"] not in inherited:
            inherited[row["_range"]] = ids[: _shared(last, row["_spelt"])]
        own = np.array(row["nodes"], dtype=np.int64)
        last, ids = row["_spelt"], _true(np.full(len(own), row["_range"]), own, inherited)
    return walked.drop("_spelt", "edge"), inherited


def _true(ranges: np.ndarray, nodes: np.ndarray, inherited: dict[int, np.ndarray]) -> np.ndarray:
    """Numbers over all ranges.  They grow with the order of the words that first have them."""
    out = (ranges.astype(np.int64) << NODE_BITS) | nodes
    for at in np.unique(ranges):
        handed = inherited[int(at)]
        mine = np.nonzero((ranges == at) & (nodes < len(handed)))[0]
        out[mine] = handed[nodes[mine]]
    return out


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())


def _names(inherited: dict[int, np.ndarray]):
    """Words by number: the node where a word ends is new in its range, and its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, lengths = _flat(batch["nodes"])
            ends = nodes[np.cumsum(lengths) - 1] if len(lengths) else nodes
            ids = _true(batch["_range"].to_numpy(), ends, inherited)
            yield pa.record_batch([pa.array(ids), batch["word"], batch["n"]], names=["id", "word", "n"])

    return run


def _pairs(heads: dict[int, np.ndarray], tails: dict[int, np.ndarray]):
    """All skipped and cut pairs of the words."""

    def spelt_out(part: pa.RecordBatch) -> pa.RecordBatch:
        head, size = _flat(part["heads"])
        tail, _ = _flat(part["nodes"])
        head = _true(np.repeat(part["_heads"].to_numpy(), size), head, heads)
        tail = _true(np.repeat(part["_range"].to_numpy(), size), tail, tails)
        start = np.cumsum(size) - size
        row = np.repeat(np.arange(len(size)), size)
        at = np.arange(len(head)) - start[row]
        points = np.frombuffer("".join(part["word"].to_pylist()).encode("utf-32-le"), dtype=np.uint32)
        first = (at == 0) | (points != np.roll(points, 1))
        ids, n = head[start + size - 1], part["n"].to_numpy()
        before = np.where(at > 0, np.roll(head, 1), ROOT)  # node of what stands before the position
        left = size[row] - at - 1  # letters after the position
        after = np.where(left > 0, tail[start[row] + np.maximum(left - 1, 0)], ROOT)
        # cuts: before every position, and behind the last
        cut_head = np.concatenate([before, ids])
        cut_tail = np.concatenate([tail[start[row] + left], np.full(len(size), ROOT)])
        rows = np.concatenate([row, row, np.arange(len(size))])
        kinds = np.concatenate([np.where(first, SKIPPED_FIRST, SKIPPED), np.full(len(cut_head), CUT)])
        columns = [np.concatenate([before, cut_head]), np.concatenate([after, cut_tail]), ids[rows], n[rows], kinds.astype(np.int8)]
        return pa.record_batch([pa.array(c) for c in columns], schema=_PAIR)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = np.cumsum(np.diff(batch["nodes"].offsets.to_numpy()))
            begin = 0
            while begin < batch.num_rows:
                done = total[begin - 1] if begin else 0
                end = max(begin + 1, int(np.searchsorted(total, done + POINTS, side="right")))
                yield spelt_out(batch.slice(begin, end - begin))
                begin = end

    return run


def neighbours(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Numbered words ``id, word, n``, and of each word with near ones their number and the most frequent: ``id, n_near, best``.

    ``words`` has distinct, non-empty ``word`` and its ``n``.  ``best`` is a struct of ``n`` and ``back``, the negative number of that word.
    """
    forward, heads = _trie(words.select("word", F.col("n").cast("long").alias("n")), F.col("word"), "spelling-forward")
    names = stored(forward.mapInArrow(_names(heads), "id long, word string, n long"), "spelling-names")
    carried = forward.select("word", "n", F.col("_range").alias("_heads"), F.col("nodes").alias("heads"))
    both, tails = _trie(carried, F.reverse("word"), "spelling-both")
    pairs = both.mapInArrow(_pairs(heads, tails), "head long, tail long, id long, n long, kind byte")
    met = pairs.groupBy("head", "tail").agg(F.collect_list(F.struct("id", "n", "kind")).alias("all")).filter(F.size("all") > 1)
    seen = met.select(F.explode("all").alias("own"), "all")
    others = F.filter("all", lambda x: (x["id"] != F.col("own.id")) & (x["kind"] + F.col("own.kind") >= 2))
    best = F.array_max(F.transform("others", lambda x: F.struct(x["n"].alias("n"), (-x["id"]).alias("back"))))
    seen = seen.select(F.col("own.id").alias("id"), others.alias("others")).filter(F.size("others") > 0)
    near = seen.select("id", F.size("others").cast("long").alias("n_near"), best.alias("best"))
    return names, near.groupBy("id").agg(F.sum("n_near").alias("n_near"), F.max("best").alias("best"))


def _roots(links: DataFrame) -> DataFrame:
    """The end of every chain ``id → root``.  A form is ``factor`` times as frequent, so chains are short; each round doubles the step."""
    most = links.agg(F.max("steps")).first()[0] or 0
    links = links.select("id", "root")
    for _ in range(math.ceil(math.log2(max(most, 1))) + 1 if most else 0):
        ahead = links.select(F.col("id").alias("root"), F.col("root").alias("_far"))
        links = stored(links.join(ahead, "root", "left").select("id", F.coalesce("_far", "root").alias("root")), "spelling-roots")
    return links


def variants(words: DataFrame, *, factor: int = 10) -> DataFrame:
    """Spelling groups of distinct words ``word, n``: ``word, form, root, n, n_near, form_n``.

    A word's form is its near word of largest ``n`` if that is at least ``factor`` times its own; its root is where the forms end.
    ``factor`` must be 2 or more.
    """
    names, near = neighbours(words)
    names = names.withColumnRenamed("n", "_n")
    near = stored(
        names.join(near, "id", "left").select(
            "id", "word", F.col("_n").alias("n"), F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(F.col("best.n") >= factor * F.col("_n"), -F.col("best.back")).alias("form_id"), F.col("best.n").alias("_best"),
        ),
        "spelling-near",
    )
    linked = near.filter("form_id IS NOT NULL")
    steps = F.ceil(F.log("_best") / math.log(factor))
    roots = _roots(linked.select("id", F.col("form_id").alias("root"), steps.alias("steps")))
    named = linked.select("id", "form_id", F.col("_best").alias("form_n")).join(roots, "id")
    spelt = names.select(F.col("id").alias("form_id"), F.col("word").alias("form"))
    named = stored(named.join(spelt, "form_id"), "spelling-forms")
    named = named.join(spelt.select(F.col("form_id").alias("root"), F.col("form").alias("_root")), "root").select("id", "form", "form_n", "_root")
    return near.join(named, "id", "left").select("word", "form", F.coalesce("_root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_groups(docs: DataFrame, *, least: int = 7, seen: int = 2, factor: int = 10, lose: int = 0) -> DataFrame:
    """Spelling variants among the words of ``docs`` with at least ``least`` letters and ``seen`` occurrences; see :func:`variants`."""
    words = occurrences(docs, least=least, lose=lose).filter(F.col("n") >= seen)
    return variants(stored(words, "spelling-words"), factor=factor)
