"""First come, first served over a total order, settled in blocks of the order.

Whether a row stays depends on earlier rows, through chains that can be as long as the table.  Neither a loop over the links of a
chain nor one task per chain would do.  Here the open rows are cut, by a range shuffle, into blocks of bounded size.  Every
task walks its own block in order and decides what it can with three values: taken, free, and *maybe*, where an open row of an earlier
block, or an undecided row of this one, may still come first.  A chain inside a block is settled in that one walk, however long it
is.  What was decided clears the other blocks by joins, and what is left open is cut anew into blocks of twice the size.  The first
block is always settled whole, so every round ends something, and a task never holds more than a block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.session import pin

#: Rows or conflicts of the first blocks, and of the largest.
BLOCK_ROWS, LARGEST_BLOCK = 50_000, 400_000
OPEN, KEPT, LOST = 0, 1, 2


def _blocks(df: DataFrame, rows: int, block: int, *order: str) -> DataFrame:
    """Blocks of the order, cut between values of its first column: rows that share one are judged together, as they stream by."""
    parts = -(-rows // block)
    cut = df.repartitionByRange(parts, order[0]) if parts > 1 else df.coalesce(1)
    return cut.sortWithinPartitions(*order)


def _walk_keys(keys: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows in order: number, keys, number of the first open row of each key → the state of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        taken: list[set] = [set() for _ in range(keys)]
        maybe: list[set] = [set() for _ in range(keys)]
        start = None
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            states = []
            for row in zip(*columns):
                start = row[0] if start is None else start
                own = [(i, row[1 + i], row[1 + keys + i]) for i in range(keys) if row[1 + i] is not None]
                if any(key in taken[i] for i, key, _ in own):
                    state = LOST
                elif any(lead < start or key in maybe[i] for i, key, lead in own):
                    state = OPEN
                else:
                    state = KEPT
                for i, key, _ in own if state != LOST else ():
                    (taken if state == KEPT else maybe)[i].add(key)
                states.append(state)
            kept = [batch.columns[i] for i in range(1 + keys)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(states, pa.int8())], names=[*batch.schema.names[: 1 + keys], "_state"])

    return run


def first_numbers(rows: DataFrame, keys: Sequence[str], *, block: int = BLOCK_ROWS) -> DataFrame:
    """Numbers ``_no`` of the rows that stay: no earlier row that stays shares a key with them; null keys meet nothing.

    ``rows`` must be pinned and have a unique ``_no`` in the order of the rows.
    """
    open_rows, kept = rows.select("_no", *keys), None
    while True:
        n = open_rows.count()
        if not n:
            return kept if kept is not None else rows.select("_no").limit(0)
        led = open_rows
        for i, key in enumerate(keys):
            if n <= block:  # one block: all that could come first is in it
                led = led.withColumn(f"_lead{i}", F.col("_no"))
                continue
            lead = pin(open_rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min("_no").alias(f"_lead{i}")))
            led = led.join(lead, key, "left")
        led = led.select("_no", *keys, *[f"_lead{i}" for i in range(len(keys))])
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in open_rows.select("_no", *keys).schema)
        seen = pin(_blocks(led, n, block, "_no").mapInArrow(_walk_keys(len(keys)), f"{fields}, _state byte"))
        won = seen.filter(F.col("_state") == KEPT)
        kept = won.select("_no") if kept is None else kept.unionByName(won.select("_no"))
        if n <= block:
            return kept
        open_rows = seen.filter(F.col("_state") == OPEN).select("_no", *keys)
        for key in keys:
            open_rows = open_rows.join(won.select(key).distinct(), key, "left_anti")
        open_rows = pin(open_rows.select("_no", *keys))
        block = min(2 * block, LARGEST_BLOCK)


def _walk_conflicts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conflicts ``earlier, later`` in order of ``later`` → the state of each ``later``; who is in no conflict as ``later`` stays."""
    lost: set = set()
    open_ids: set = set()
    first_block = TaskContext.get().partitionId() == 0  # nothing comes before it
    start = at = None
    state = KEPT
    ids, states = [], []

    def close() -> None:
        if at is not None:
            ids.append(at)
            states.append(state)
            if state != KEPT:
                (lost if state == LOST else open_ids).add(at)

    kind = None
    for batch in batches:
        kind = batch.schema.field("later").type
        for earlier, later in zip(batch["earlier"].to_pylist(), batch["later"].to_pylist()):
            start = later if start is None else start
            if later != at:
                close()
                at, state = later, KEPT
            if state == LOST or earlier in lost:
                continue
            state = OPEN if earlier in open_ids or (earlier < start and not first_block) else LOST
        if len(ids) >= 10_000:
            yield pa.record_batch([pa.array(ids, kind), pa.array(states, pa.int8())], names=["id", "_state"])
            ids, states = [], []
    close()
    if ids:
        yield pa.record_batch([pa.array(ids, kind), pa.array(states, pa.int8())], names=["id", "_state"])


def beaten(conflicts: DataFrame, *, block: int = BLOCK_ROWS) -> DataFrame | None:
    """Ids that lose to an earlier one that stays, given all conflicts ``earlier < later``; None where there are no conflicts."""
    kind = conflicts.schema["later"].dataType.simpleString()
    edges, gone = pin(conflicts.select("earlier", "later")), None
    while True:
        n = edges.count()
        if not n:
            return gone
        seen = pin(_blocks(edges, n, block, "later", "earlier").mapInArrow(_walk_conflicts, f"id {kind}, _state byte"))
        lost = seen.filter(F.col("_state") == LOST).select("id")
        if n > block:
            # winners of one block, and those who are later in no conflict, beat whom they meet in others
            heads = edges.select("earlier").distinct().join(edges.select(F.col("later").alias("earlier")), "earlier", "left_anti")
            won = heads.unionByName(seen.filter(F.col("_state") == KEPT).select(F.col("id").alias("earlier")))
            beaten_too = edges.join(won, "earlier", "left_semi").select(F.col("later").alias("id"))
            lost = pin(lost.unionByName(beaten_too).distinct())
        gone = lost if gone is None else gone.unionByName(lost)
        if n <= block:
            return gone
        for end in ("earlier", "later"):
            edges = edges.join(lost.select(F.col("id").alias(end)), end, "left_anti")
        edges = pin(edges)
        block = min(2 * block, LARGEST_BLOCK)
