"""Near duplicates among vectors: exact similarity pairs and their connected groups."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewright.functions.chance import shuffle_key
from framewright.session import pin

#: Pivots grow with the root of the rows, up to this many bytes; beyond it cells are cut into more blocks.
PIVOT_BYTES = 8_000_000
ROWS_PER_TASK = 50_000
#: Vectors of a batch that are placed at once.
PLACED_AT_ONCE = 512
#: Where pivots prune nothing, slices of the rows meet: bytes of one in double precision, and how many there are at least for the cores' sake.
SLICE_BYTES, LEAST_SLICES = 32_000_000, 12


def _unit(vectors) -> np.ndarray:
    matrix = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    return matrix / (np.linalg.norm(matrix, axis=1, keepdims=True) + 1e-12)


def _spread(vectors: DataFrame, rows: int) -> DataFrame:
    """Vectors in partitions small enough for the Python work per row that follows."""
    tasks = max(vectors.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS_PER_TASK))
    return pin(vectors.repartition(tasks, "id"))


class PivotTree:
    """Pivots in two levels: about the root of them on top, the others below the top pivot nearest to them.

    A task gets the pivots as they came, in single precision where the vectors are, and nothing that grows with their square.  A top
    pivot knows its reach, the largest distance to a pivot below it, so rows look below only where a pivot can matter to them.
    """

    def __init__(self, vectors: np.ndarray, radius: float):
        unit = _unit(vectors)
        tops = unit[: max(1, math.isqrt(len(unit)))]
        below = (unit @ tops.T).argmax(axis=1)
        used, below = np.unique(below, return_inverse=True)  # a top pivot that equals another has none below
        self.radius = radius
        #: Places of the pivots in the order of their cells, and where the cells of each top pivot begin.
        self.order = np.argsort(below, kind="stable")
        self.starts = np.searchsorted(below[self.order], np.arange(len(used) + 1))
        self.tops = vectors[used]
        self.vectors = vectors[self.order]
        self.reach = np.array([_apart(tops[[t]], unit[below == i]).max() for i, t in enumerate(used)])

    def place(self, unit: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """``row, cell, whether it is the row's home, distance to the cell's pivot``, one top pivot at a time.

        The home cell belongs to the nearest pivot.  If two vectors lie within the radius, the plane halfway between their home pivots lies
        between them, so neither is further than the radius from it; visiting all cells whose plane is so near loses no pair.  Such
        a pivot is at most twice the radius further than the home pivot, which with the reach bounds the tops to look below.
        """
        pivots, slack = _unit(self.vectors), 2.0 * self.radius + 1e-6
        to_top = _apart(unit, _unit(self.tops))
        first = to_top.argmin(axis=1)
        best, home = np.full(len(unit), np.inf), np.zeros(len(unit), dtype=np.int64)
        looked = []

        def look(top: int, rows: np.ndarray) -> None:
            if not len(rows):
                return
            away = _apart(unit[rows], pivots[self.starts[top] : self.starts[top + 1]])
            near = away.argmin(axis=1)
            shorter = away[np.arange(len(rows)), near]
            better = shorter < best[rows]
            best[rows[better]], home[rows[better]] = shorter[better], self.starts[top] + near[better]
            looked.append((top, rows, away))

        for top in range(len(self.tops)):
            look(top, np.nonzero(first == top)[0])
        bound = best + slack  # the home is no further than the nearest pivot below the nearest top
        for top in range(len(self.tops)):
            look(top, np.nonzero((first != top) & (to_top[:, top] - self.reach[top] <= bound))[0])
        for top, rows, away in looked:
            begin = self.starts[top]
            planes = _apart(pivots[home[rows]], pivots[begin : self.starts[top + 1]])
            at, cell = np.nonzero(away**2 - (best[rows] ** 2)[:, None] <= 2.0 * planes * self.radius + 1e-9)
            yield rows[at], begin + cell, home[rows[at]] == begin + cell, away[at, cell]


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances between unit vectors."""
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (a @ b.T)))


def _pivots(vectors: DataFrame, rows: int, threshold: float, seed: int) -> tuple[list, PivotTree]:
    """A random set of vectors of bounded size: their ids by cell, and the tree over them."""
    sample = vectors.limit(1).collect()
    single = isinstance(vectors.schema["vector"].dataType.elementType, T.FloatType)
    kind = np.float32 if single else np.float64
    width = max(1, len(sample[0]["vector"])) if sample else 1
    wanted = min(PIVOT_BYTES // (width * np.dtype(kind).itemsize), max(8, math.isqrt(rows)))
    chosen = vectors.orderBy(shuffle_key(seed, "id"), "id").limit(wanted).collect()
    if not chosen:
        return [], PivotTree(np.zeros((1, width), dtype=kind), 0.0)
    tree = PivotTree(np.array([r["vector"] for r in chosen], dtype=kind), math.sqrt(max(0.0, 2.0 - 2.0 * threshold)))
    return [chosen[i]["id"] for i in tree.order], tree


def _placed(vectors: DataFrame, tree: PivotTree, threshold: float) -> DataFrame:
    """Each vector in every cell where a partner may live; ``near`` marks vectors within the radius of the cell's pivot."""
    radius = math.sqrt(max(0.0, 2.0 - 2.0 * threshold))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, own = batch["id"].to_numpy(), batch["vector"].to_numpy()
            for begin in range(0, len(batch), PLACED_AT_ONCE):
                some = own[begin : begin + PLACED_AT_ONCE]
                for row, cell, home, away in tree.place(_unit(some)):
                    yield pd.DataFrame(
                        {"id": ids[begin + row], "vector": some[row], "cell": cell.astype(np.int32), "home": home, "near": away <= radius}
                    )

    schema = T.StructType(
        [*vectors.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("home", T.BooleanType()), T.StructField("near", T.BooleanType())]
    )
    return pin(vectors.mapInPandas(place, schema))


def _slices(tree: PivotTree, rows: int, block: int) -> int:
    """How many slices of the rows to compare with each other, 0 where cells of pivots send fewer copies of a vector.

    Judged by the cells that the pivots themselves, a random set, would be sent to.
    """
    sample = _unit(tree.vectors[:: max(1, len(tree.vectors) // PLACED_AT_ONCE)])
    visits = sum(len(row) for row, *_ in tree.place(sample)) / len(sample)
    slices = max(-(-rows * tree.vectors.shape[1] * 8 // SLICE_BYTES), min(LEAST_SLICES, -(-rows // block)), 1)
    return slices if slices <= visits * (1.0 + rows / (len(tree.vectors) * block)) else 0


def _compare_slices(vectors: DataFrame, slices: int, threshold: float, block: int, *, forest: bool) -> DataFrame:
    """All pairs, every two slices in one task, a tile of ``block`` × ``block`` at a time; each vector goes to ``slices`` tasks."""
    kind = vectors.schema["id"].dataType
    out = T.StructType([T.StructField("id_a", kind), T.StructField("id_b", kind), T.StructField("cosine", T.DoubleType())])
    own = F.pmod(F.xxhash64("id"), F.lit(slices)).cast("int").alias("own")
    dealt = vectors.select("id", "vector", own, F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("_k"))
    dealt = dealt.select("id", "vector", "own", F.least("own", "_k").alias("i"), F.greatest("own", "_k").alias("j"))

    def compare(both: pd.DataFrame) -> pd.DataFrame:
        found = [pd.DataFrame({"id_a": [], "id_b": [], "cosine": []})]
        left, right = both[both["own"] == both["i"]], both[both["own"] == both["j"]]
        if left.empty or right.empty:
            return found[0]
        (a, u), (b, v) = ((side["id"].to_numpy(), _unit(side["vector"])) for side in (left, right))
        same = both["i"].iloc[0] == both["j"].iloc[0]
        for x in range(0, len(a), block):
            for y in range(x if same else 0, len(b), block):
                one, two = a[x : x + block], b[y : y + block]
                cosine = u[x : x + block] @ v[y : y + block].T
                hit = cosine >= threshold
                hit &= one[:, None] < two[None, :] if same and x == y else one[:, None] != two[None, :]
                if forest:
                    found.append(_forest(one, two, hit))
                else:
                    i, j = np.nonzero(hit)
                    found.append(pd.DataFrame({"id_a": np.minimum(one[i], two[j]), "id_b": np.maximum(one[i], two[j]), "cosine": cosine[i, j]}))
        pairs = pd.concat([f for f in found if len(f)] or found[:1], ignore_index=True)
        return _joined(pairs) if forest and len(pairs) else pairs

    return dealt.groupBy("i", "j").applyInPandas(compare, out)


def _joined(links: pd.DataFrame) -> pd.DataFrame:
    """Links that connect what the links connect, one per id."""
    ids, ends = np.unique(np.concatenate([links["id_a"], links["id_b"]]), return_inverse=True)
    one, two = ends[: len(links)], ends[len(links) :]
    root = np.arange(len(ids))
    while True:
        low = np.minimum(root[one], root[two])
        lower = root.copy()
        for end in (one, two):
            np.minimum.at(lower, end, low)
            np.minimum.at(lower, root[end], low)
        lower = lower[lower]
        if (lower == root).all():
            break
        root = lower
    away = root != np.arange(len(ids))
    return pd.DataFrame({"id_a": ids[away], "id_b": ids[root[away]], "cosine": np.nan})


def _address(family: int, side: str, own: Column):
    """Where one copy of a row goes: its own chunk on its side, chunk ``k`` on the other."""

    def at(k: Column) -> Column:
        i, j = (own, k) if side == "L" else (k, own)
        return F.struct(F.lit(family).alias("family"), i.alias("i"), j.alias("j"), F.lit(side).alias("side"))

    return at


def _blocks(placed: DataFrame, families: tuple[tuple[str, str], ...], block: int) -> DataFrame:
    """Cut every cell into blocks of bounded size: left chunk × right chunk, per family of roles."""
    roles = {
        "home_far": F.col("home") & ~F.col("near"),
        "home_near": F.col("home") & F.col("near"),
        "near": F.col("near"),
        "far": ~F.col("near"),
        "any": F.lit(True),
    }
    sizes = placed.groupBy("cell").agg(
        *[F.ceil(F.count_if(test) / F.lit(block)).cast("int").alias(f"_{name}") for name, test in roles.items()]
    )
    sized = placed.join(F.broadcast(sizes), "cell")  # one row per pivot, whose bytes are bounded
    own = F.abs(F.xxhash64("id"))
    entries = []
    for number, (left, right) in enumerate(families):
        chunks = {"L": F.col(f"_{left}"), "R": F.col(f"_{right}")}
        mine = {s: F.pmod(own, F.greatest(chunks[s], F.lit(1))).cast("int") for s in chunks}
        both = (chunks["L"] > 0) & (chunks["R"] > 0)
        for side, other, role in (("L", "R", left), ("R", "L", right)):
            at = F.transform(F.sequence(F.lit(0), chunks[other] - 1), _address(number, side, mine[side]))
            entries.append(F.when(both & roles[role], at))
    return sized.withColumn("_at", F.explode(F.flatten(F.array_compact(F.array(*entries))))).select(
        "id", "vector", "cell", "_at.*"
    )


def _compare(blocks: DataFrame, threshold: float, *, forest: bool) -> DataFrame:
    kind = blocks.schema["id"].dataType
    out = T.StructType([T.StructField("id_a", kind), T.StructField("id_b", kind), T.StructField("cosine", T.DoubleType())])

    def compare(block: pd.DataFrame) -> pd.DataFrame:
        left, right = block[block["side"] == "L"], block[block["side"] == "R"]
        if left.empty or right.empty:
            return pd.DataFrame({"id_a": [], "id_b": [], "cosine": []})
        a, b = left["id"].to_numpy(), right["id"].to_numpy()
        cosine = _unit(left["vector"]) @ _unit(right["vector"]).T
        hit = (cosine >= threshold) & (a[:, None] < b[None, :])
        if forest:
            return _forest(a, b, hit)
        i, j = np.nonzero(hit)
        return pd.DataFrame({"id_a": a[i], "id_b": b[j], "cosine": cosine[i, j]})

    return blocks.groupBy("cell", "family", "i", "j").applyInPandas(compare, out)


def _forest(a: np.ndarray, b: np.ndarray, hit: np.ndarray) -> pd.DataFrame:
    """Links that connect what a block connects, at most one per row instead of one per pair."""
    rows, cols = np.nonzero(hit.any(axis=1))[0], np.nonzero(hit.any(axis=0))[0]
    if not len(rows):
        return pd.DataFrame({"id_a": [], "id_b": [], "cosine": []})
    hit, a, b = hit[np.ix_(rows, cols)], a[rows], b[cols]
    left = np.arange(len(a))
    while True:
        right = np.where(hit, left[:, None], len(a)).min(axis=0)
        lower = np.minimum(left, np.where(hit, right[None, :], len(a)).min(axis=1))
        if (lower == left).all():
            break
        left = lower
    ends = np.concatenate([a, b])
    roots = np.concatenate([a[left], a[right]])
    keep = ends != roots
    return pd.DataFrame({"id_a": ends[keep], "id_b": roots[keep], "cosine": np.nan})


def similar_pairs(vectors: DataFrame, *, threshold: float = 0.97, block: int = 2048, seed: int = 0) -> DataFrame:
    """All pairs ``id_a < id_b`` of vectors (``id, vector``) with cosine of at least ``threshold``; exact."""
    rows = vectors.count()
    spread = _spread(vectors.select("id", "vector"), rows)
    names, tree = _pivots(spread, rows, threshold, seed)
    if names and (slices := _slices(tree, rows, block)):
        return _compare_slices(spread, slices, threshold, block, forest=False)
    placed = _placed(spread, tree, threshold)
    return _compare(_blocks(placed, (("home_far", "any"), ("home_near", "any")), block), threshold, forest=False)


def duplicate_groups(vectors: DataFrame, *, threshold: float = 0.97, block: int = 2048, seed: int = 0) -> DataFrame:
    """Connected groups of vectors with cosine of at least ``threshold``: ``id, group`` (its least id).

    Equal vectors collapse first, and vectors near a pivot hang on that pivot
    without being compared to each other.  So a crowd of copies costs one link
    per member, not one per pair.
    """
    vectors = vectors.select("id", "vector")
    firsts = vectors.groupBy("vector").agg(F.min("id").alias("id"))
    copies = vectors.join(firsts.withColumnRenamed("id", "first"), "vector").filter(F.col("id") != F.col("first"))
    rows = vectors.count()
    distinct = _spread(firsts.select("id", "vector"), rows)
    names, tree = _pivots(distinct, rows, threshold, seed)
    same = copies.select(F.col("id").alias("u"), F.col("first").alias("v"))
    if names and (slices := _slices(tree, rows, block)):
        links = _compare_slices(distinct, slices, threshold, block, forest=True).select(F.col("id_a").alias("u"), F.col("id_b").alias("v"))
        return components(vectors.select("id"), links.unionByName(same))
    placed = _placed(distinct, tree, threshold)
    schema = T.StructType([T.StructField("cell", T.IntegerType()), T.StructField("v", vectors.schema["id"].dataType)])
    pivots = vectors.sparkSession.createDataFrame(list(enumerate(names)), schema)
    stars = placed.filter("near").join(pivots, "cell").select(F.col("id").alias("u"), "v")
    blocks = _blocks(placed, (("home_far", "any"), ("home_near", "far")), block)
    links = _compare(blocks, threshold, forest=True).select(F.col("id_a").alias("u"), F.col("id_b").alias("v"))
    return components(vectors.select("id"), links.unionByName(stars).unionByName(same))


def components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Connected components by alternating star contraction: ``id, group`` with the least id as group.

    Each round hangs neighbours on the least id around them; minima combine
    before the shuffle and no neighbourhood is ever collected.
    """
    current = pin(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = None
    while True:
        seen = current.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if mark == (seen["n"], seen["x"]):
            break
        mark = (seen["n"], seen["x"])
        current = pin(_small_star(_large_star(current)))
    roots = current.select(F.col("u").alias("id"), F.col("v").alias("_root"))
    return vertices.join(roots, "id", "left").select("id", F.coalesce("_root", "id").alias("group"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # pinned: a join of plain tables lets adaptive execution split the hub of a crowd of copies
    least = pin(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
    hung = both.filter(F.col("v") > F.col("u")).join(least, "u")
    return hung.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = pin(down.groupBy("u").agg(F.min("v").alias("m")))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def group_totals(groups: DataFrame) -> DataFrame:
    """Frames, groups, groups of more than one, and frames merged into another's group."""
    sizes = groups.groupBy("group").agg(F.count("*").alias("n"))
    return sizes.agg(
        F.sum("n").alias("frames"),
        F.count("*").alias("groups"),
        F.count_if(F.col("n") > 1).alias("merged_groups"),
        (F.sum("n") - F.count("*")).alias("merged_frames"),
    )
