"""Shards of near-equal bytes from indivisible groups, by Karmarkar-Karp differencing.

Rows with equal texts form a group that must stay together.  A partial partition has one sum of bytes per shard; the two with the
largest spread are combined oppositely ordered, largest sums on smallest, until one is left.  Only what can matter is an
item of its own there:

* **Heavy groups**, with more than a ``PACKETS``-th of all bytes: fewer than ``PACKETS`` of them exist, in any table.
* **Packets**: all other groups, dealt by digest into ``PACKETS`` packets of about the same size.  A group is in one packet, so it stays
  whole, and many small items of slightly different size are what differencing balances best.

So at most ``2 * PACKETS`` sums meet on the driver, whatever the table holds.  A row finds its shard by its digest alone, from two
tables of at most ``PACKETS`` entries: no join by text, and a text that a third of all rows share is no hot key.  Places in a shard are
numbered by a range shuffle in order of ``doc_id``.

Defined results: null texts have no bytes and belong to the group of the empty text; null ``doc_id`` come first in their shard; ties
are placed by size and CRC, and rows alike in all of these are interchangeable; an empty table gives an empty result; other columns
are ignored by :func:`assign`.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.llm.common import only, stored
from framewright.operators.ranking import ordered_rank

#: Packets of light groups, and the share of all bytes above which a group is an item of its own.
PACKETS = 4096


def difference(sizes: Sequence[int], shards: int) -> list[int]:
    """The shard of every item, by largest differencing.

    A partial partition is kept as its sums, largest first, with the bundle of items behind every sum.  Ties go to the partition
    that was made first, so the result depends on the order of ``sizes`` alone.
    """
    made = len(sizes)
    heap: list[tuple] = []
    for item, size in enumerate(sizes):
        sums = [size] + [0] * (shards - 1)
        heap.append((-size if shards > 1 else 0, item, sums, [[item]] + [None] * (shards - 1)))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, _, a, mine = heapq.heappop(heap)
        _, _, b, theirs = heapq.heappop(heap)
        joint = [(x + y, p, q) for x, y, p, q in zip(a, reversed(b), mine, reversed(theirs))]
        joint.sort(key=lambda x: -x[0])
        bundles = [q if p is None else p if q is None else [p, q] for _, p, q in joint]
        sums = [x[0] - joint[-1][0] for x in joint]  # only differences matter
        heapq.heappush(heap, (-sums[0], made, sums, bundles))
        made += 1
    placed = [0] * len(sizes)
    for shard, bundle in enumerate(heap[0][3] if heap else []):
        open_bundles = [bundle] if bundle is not None else []
        while open_bundles:
            top = open_bundles.pop()
            if isinstance(top, list):
                open_bundles += top
            else:
                placed[top] = shard
    return placed


def _measured(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit("")).cast("binary")
    digest = F.unhex(F.sha2(text, 256))
    measured = only(docs, "doc_id", "text").select(
        "doc_id", (F.octet_length(text) + F.lit(1)).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), digest.alias("digest")
    )
    return measured.withColumn("packet", F.pmod(F.xxhash64("digest"), F.lit(PACKETS)).cast("int"))


def _plan(rows: DataFrame, shards: int) -> tuple[list[tuple[bytes, int]], list[int]]:
    """Shards of the heavy groups by digest, and of the packets by number."""
    groups = rows.groupBy("digest", "packet").agg(F.sum("size").alias("bytes"))
    groups = stored(groups, "sharding-groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    heavy = F.col("bytes") * PACKETS > total
    large = groups.filter(heavy).select("digest", "bytes").orderBy(F.desc("bytes"), "digest").collect()
    light = groups.filter(~heavy).groupBy("packet").agg(F.sum("bytes").alias("bytes")).collect()
    packets = [0] * PACKETS
    for row in light:
        packets[row["packet"]] = row["bytes"]
    placed = difference([*[r["bytes"] for r in large], *packets], shards)
    return [(bytes(r["digest"]), s) for r, s in zip(large, placed)], placed[len(large) :]


def assign(docs: DataFrame, *, shards: int = 8) -> DataFrame:
    """Shard of every row: ``doc_id, size, text_crc32, shard, slot``; ``slot`` counts from 0 in each shard."""
    rows = stored(_measured(docs), "sharding-rows")
    large, packets = _plan(rows, shards)
    spark = docs.sparkSession
    heavy = spark.createDataFrame(large, "digest binary, _heavy int")
    by_packet = F.element_at(F.array(*[F.lit(s) for s in packets]), F.col("packet") + 1)
    # at most PACKETS rows, as every heavy group has more than that share of all bytes
    placed = rows.join(F.broadcast(heavy), "digest", "left").withColumn("shard", F.coalesce("_heavy", by_packet).cast("int"))
    placed = placed.select("doc_id", "size", "text_crc32", "shard")
    ranked = ordered_rank(placed, ["doc_id", "size", "text_crc32"], groups=["shard"], rank="slot")
    return ranked.select("doc_id", "size", "text_crc32", "shard", (F.col("slot") - 1).cast("long").alias("slot"))


def balance(assigned: DataFrame) -> DataFrame:
    """Rows and bytes per shard: ``shard, rows, bytes``."""
    return assigned.groupBy("shard").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"))
