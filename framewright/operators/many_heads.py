"""Many linear heads at once: every arm, repeat and fold of a cross-validation in the same passes over the data.

A head is a balanced multinomial regression on standardised, unit-length, weighted blocks.  All of them are fitted in step: a pass over the
samples gives the losses and gradients of all heads that still move, summed up over tasks in two levels, and each head makes its
own quasi-Newton step from its own history.  What reaches the driver grows with arms, folds and repeats, not with the samples.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Steps remembered by the quasi-Newton rule, the sufficient decrease of a step, and the shortest step tried.
MEMORY, DECREASE, SHORTEST = 10, 1e-4, 1e-10
#: Tasks whose sums go to the driver directly; more are summed up in between.
DIRECT = 16


def summed(df: DataFrame, measure: Callable[[dict[str, np.ndarray]], np.ndarray], read: Callable[[pa.RecordBatch], dict]) -> np.ndarray:
    """Sum over all rows of what ``measure`` gives for a batch: an array of one length."""

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            if batch.num_rows:
                part = measure(read(batch))
                out = part if out is None else out + part
        if out is not None:
            yield pa.record_batch([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([out.tobytes()])], names=["slot", "part"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            for part in batch["part"].to_pylist():
                out = np.frombuffer(part) if out is None else out + np.frombuffer(part)
        if out is not None:
            yield pa.record_batch([pa.array([0], pa.int32()), pa.array([out.tobytes()])], names=["slot", "part"])

    parts = df.mapInArrow(total, "slot int, part binary")
    tasks = df.rdd.getNumPartitions()
    if tasks > DIRECT:
        parts = parts.repartition(math.isqrt(tasks), "slot").mapInArrow(join, "slot int, part binary")
    return sum((np.frombuffer(r["part"]) for r in parts.collect()), np.zeros(1))


def _lists(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _reader(blocks: Sequence[str], label: str) -> Callable[[pa.RecordBatch], dict]:
    def read(batch: pa.RecordBatch) -> dict:
        rows = {b: _lists(batch[b]) for b in blocks}
        return rows | {"_label": batch[label].to_numpy(zero_copy_only=False).astype(np.int64), "_folds": _lists(batch["folds"]).astype(np.int64)}

    return read


@dataclass(frozen=True)
class Head:
    """One head of the grid: which rows it leaves out, and which blocks it reads."""

    arm: str
    repeat: int
    fold: int
    blocks: tuple[str, ...]
    width: int


class Grid:
    """The heads, the scaling of each pair of repeat and fold, and a common layout of their weights."""

    def __init__(self, arms: Mapping[str, Mapping[str, int]], classes: int, folds: int, repeats: int, weights: Mapping[str, float]):
        self.classes, self.folds, self.repeats, self.weights = classes, folds, repeats, dict(weights)
        self.blocks = sorted({b for arm in arms.values() for b in arm})
        self.widths = {b: next(arm[b] for arm in arms.values() if b in arm) for b in self.blocks}
        self.heads = [
            Head(arm, r, f, tuple(widths), sum(widths.values())) for r in range(repeats) for f in range(folds) for arm, widths in arms.items()
        ]
        sizes = [classes * (h.width + 1) for h in self.heads]
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(int)
        self.scale: dict[tuple[int, int, str], tuple[np.ndarray, np.ndarray]] = {}
        self.balance: dict[tuple[int, int], np.ndarray] = {}
        self.rows: dict[tuple[int, int], float] = {}

    def part(self, i: int) -> slice:
        return slice(self.starts[i], self.starts[i + 1])

    def moments(self, rows: dict) -> np.ndarray:
        """Per repeat and fold: class counts, and sums and squared sums of each block, of the rows in the fold."""
        out = []
        for r in range(self.repeats):
            for f in range(self.folds):
                own = rows["_folds"][:, r] == f
                out.append(np.bincount(rows["_label"][own], minlength=self.classes).astype(float))
                for b in self.blocks:
                    out += [rows[b][own].sum(axis=0), (rows[b][own] ** 2).sum(axis=0)]
        return np.concatenate(out)

    def learn_scales(self, sums: np.ndarray) -> None:
        """Scaling and class weights of what each fold leaves: all rows less the fold's."""
        per_fold = sums.reshape(self.repeats, self.folds, -1)
        for r in range(self.repeats):
            for f in range(self.folds):
                left = per_fold[r].sum(axis=0) - per_fold[r, f]
                counts, at = left[: self.classes], self.classes
                n = counts.sum()
                seen = counts > 0
                self.rows[r, f] = n
                self.balance[r, f] = np.where(seen, n / (max(1, seen.sum()) * np.maximum(counts, 1)), 0.0)
                for b in self.blocks:
                    width = self.widths[b]
                    mean, square = left[at : at + width] / max(n, 1), left[at + width : at + 2 * width]
                    at += 2 * width
                    spread = np.sqrt(np.maximum(0.0, square - n * mean**2) / max(n - 1, 1))
                    flat = spread <= 1e-12 * (1 + np.abs(mean))
                    self.scale[r, f, b] = mean, np.where(flat, 0.0, 1.0 / np.where(flat, 1.0, spread))

    def features(self, rows: dict, own: np.ndarray, r: int, f: int) -> dict[str, np.ndarray]:
        """Scaled, unit-length, weighted blocks of the chosen rows."""
        out = {}
        for b in self.blocks:
            mean, factor = self.scale[r, f, b]
            z = (rows[b][own] - mean) * factor
            length = np.linalg.norm(z, axis=1, keepdims=True)
            out[b] = z * (self.weights.get(b, 1.0) / np.where(length > 0, length, 1.0))
        return out

    def scores(self, head: Head, weights: np.ndarray, blocks: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        x = np.concatenate([blocks[b] for b in head.blocks], axis=1)
        table = weights.reshape(self.classes, head.width + 1)
        return x, x @ table[:, :-1].T + table[:, -1]

    def losses(self, weights: np.ndarray, moving: np.ndarray) -> Callable[[dict], np.ndarray]:
        """Sums of losses of all heads, then of their gradients; heads that don't move are left out."""

        def measure(rows: dict) -> np.ndarray:
            loss, slope = np.zeros(len(self.heads)), np.zeros(len(weights))
            blocks: dict = {}
            at = None
            for i, head in enumerate(self.heads):
                if not moving[i]:
                    continue
                if at != (head.repeat, head.fold):
                    at = head.repeat, head.fold
                    own = rows["_folds"][:, head.repeat] != head.fold
                    blocks, labels = self.features(rows, own, *at), rows["_label"][own]
                    each = self.balance[at][labels]
                x, z = self.scores(head, weights[self.part(i)], blocks)
                z = z - z.max(axis=1, keepdims=True)
                power = np.exp(z)
                total = power.sum(axis=1, keepdims=True)
                places = np.arange(len(labels))
                loss[i] = (each * (np.log(total[:, 0]) - z[places, labels])).sum()
                share = power / total
                share[places, labels] -= 1.0
                share *= each[:, None]
                slope[self.part(i)] = np.concatenate([share.T @ x, share.sum(axis=0)[:, None]], axis=1).ravel()
            return np.concatenate([loss, slope])

        return measure


@dataclass
class Fitted:
    """Weights of all heads, and the largest slope of each at the end."""

    grid: Grid
    weights: np.ndarray
    slopes: np.ndarray


def _direction(slope: np.ndarray, history: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Quasi-Newton direction from the last steps and changes of slope."""
    q, used = -slope, []
    for step, change in reversed(history):
        a = step @ q / (step @ change)
        q = q - a * change
        used.append(a)
    if history:
        step, change = history[-1]
        q = q * (step @ change / (change @ change))
    for (step, change), a in zip(history, reversed(used)):
        q = q + step * (a - change @ q / (step @ change))
    return q


def fit(
    table: DataFrame, arms: Mapping[str, Mapping[str, int]], *, classes: int, folds: int, repeats: int, label: str = "label",
    weights: Mapping[str, float] | None = None, c: float = 1.0, max_iter: int = 3000, tol: float = 1e-5,
) -> Fitted:
    """Fit all heads.  ``table`` is pinned and has ``label``, the blocks as arrays, and ``folds``: the row's fold in every repeat.

    A head stops when no slope of its mean loss exceeds ``tol``, or after ``max_iter`` passes.
    """
    grid = Grid(arms, classes, folds, repeats, weights or {})
    read = _reader(grid.blocks, label)
    grid.learn_scales(summed(table, grid.moments, read))
    many = len(grid.heads)
    n = np.array([max(1.0, grid.rows[h.repeat, h.fold]) for h in grid.heads])
    decay = np.ones(grid.starts[-1])
    for i, head in enumerate(grid.heads):
        decay[grid.part(i)].reshape(classes, head.width + 1)[:, -1] = 0.0  # intercepts are free
    at = np.zeros(grid.starts[-1])

    def evaluate(where: np.ndarray, moving: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sums = summed(table, grid.losses(where, moving), read)
        if len(sums) == 1:  # no rows
            sums = np.zeros(many + grid.starts[-1])
        value, slope = sums[:many] / n, sums[many:].copy()
        for i in range(many):
            own = where[grid.part(i)]
            held = decay[grid.part(i)] * own / (c * n[i])
            value[i] += 0.5 * held @ own
            slope[grid.part(i)] = slope[grid.part(i)] / n[i] + held
        return value, slope

    moving = np.ones(many, dtype=bool)
    value, slope = evaluate(at, moving)
    worst = np.array([np.abs(slope[grid.part(i)]).max(initial=0.0) for i in range(many)])
    history: list[list] = [[] for _ in range(many)]
    steps = [_direction(slope[grid.part(i)], []) for i in range(many)]
    lengths = np.array([1.0 / max(1.0, np.linalg.norm(s)) for s in steps])
    for _ in range(max_iter):
        moving = (worst > tol) & (lengths > SHORTEST)
        if not moving.any():
            break
        trial = at.copy()
        for i in np.flatnonzero(moving):
            trial[grid.part(i)] += lengths[i] * steps[i]
        tried, tried_slope = evaluate(trial, moving)
        for i in np.flatnonzero(moving):
            own = grid.part(i)
            if tried[i] > value[i] + DECREASE * lengths[i] * (slope[own] @ steps[i]):
                lengths[i] /= 2
                continue
            step, change = trial[own] - at[own], tried_slope[own] - slope[own]
            if step @ change > 1e-14 * (change @ change):
                history[i] = [*history[i][1 - MEMORY :], (step, change)]
            at[own], slope[own], value[i] = trial[own], tried_slope[own], tried[i]
            worst[i] = np.abs(slope[own]).max()
            steps[i], lengths[i] = _direction(slope[own], history[i]), 1.0
    return Fitted(grid, at, worst)


def guesses(table: DataFrame, fitted: Fitted, *, key: str, label: str = "label") -> DataFrame:
    """What every head says about the fold it has not seen: ``arm, repeat, fold, key, truth, guess``."""
    grid, weights = fitted.grid, fitted.weights
    read = _reader(grid.blocks, label)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = read(batch)
            for i, head in enumerate(grid.heads):
                own = np.flatnonzero(rows["_folds"][:, head.repeat] == head.fold)
                if not len(own):
                    continue
                _, z = grid.scores(head, weights[grid.part(i)], grid.features(rows, own, head.repeat, head.fold))
                n = len(own)
                columns = [
                    pa.array([head.arm] * n), pa.array([head.repeat] * n, pa.int32()), pa.array([head.fold] * n, pa.int32()), batch[key].take(pa.array(own)),
                    pa.array(rows["_label"][own].astype(float)), pa.array(z.argmax(axis=1).astype(float)),
                ]
                yield pa.record_batch(columns, names=["arm", "repeat", "fold", key, "truth", "guess"])

    number = T.IntegerType()
    schema = T.StructType(
        [T.StructField("arm", T.StringType()), T.StructField("repeat", number), T.StructField("fold", number), table.schema[key]]
        + [T.StructField(c, T.DoubleType()) for c in ("truth", "guess")]
    )
    return table.mapInArrow(run, schema)


def stationarity(table: DataFrame, fitted: Fitted) -> DataFrame:
    """How still every head stands: ``arm, repeat, fold, rows, slope``."""
    grid = fitted.grid
    rows = [(h.arm, h.repeat, h.fold, int(grid.rows[h.repeat, h.fold]), float(s)) for h, s in zip(grid.heads, fitted.slopes)]
    return table.sparkSession.createDataFrame(rows, "arm string, repeat int, fold int, rows long, slope double")
