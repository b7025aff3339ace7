"""Scorecards: answers against the truth, per brand, per run, per fold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright import schemas as C
from framewright.functions.answers import flip_mark
from framewright.functions.geometry import stem


def graded(outcomes: DataFrame) -> DataFrame:
    """Rows with a known truth."""
    return outcomes.filter(F.coalesce("truth", F.lit("")) != "")


def with_truth(answers: DataFrame, truth: DataFrame) -> DataFrame:
    """Truth by file name, else by stem; of several truths of a file the last by ``listed_at`` counts."""
    last = truth.groupBy("file").agg(F.max(F.struct("listed_at", "brand")).alias("_t"))
    known = last.select("file", F.col("_t.brand").alias("brand"))
    by_file = known.select("file", F.col("brand").alias("_by_file"))
    by_stem = known.select(F.col("file").alias("_stem"), F.col("brand").alias("_by_stem"))
    return (
        answers.withColumn("_stem", stem(F.col("file")))
        .join(by_file, "file", "left")
        .join(by_stem, "_stem", "left")
        .withColumn("truth", F.coalesce(F.nullif("_by_file", F.lit("")), F.nullif("_by_stem", F.lit("")), F.lit("")))
        .drop("_stem", "_by_file", "_by_stem")
    )


def answer_shares(outcomes: DataFrame, column: str = "decided") -> DataFrame:
    """Answers per value with their share of all."""
    counts = outcomes.groupBy(column).agg(F.count("*").alias("answers"))
    return counts.withColumn("share", F.col("answers") / outcomes.agg(F.count("*")).scalar())


def failures(outcomes: DataFrame) -> DataFrame:
    """Answers and how many of them are failed calls (``error`` says why)."""
    return outcomes.agg(F.count("*").alias("answers"), F.count_if(F.coalesce("error", F.lit("")) != "").alias("failed"))


def accuracy(outcomes: DataFrame) -> DataFrame:
    """Right answers after and before the trust check (``decided`` and ``brand``)."""
    return graded(outcomes).agg(
        F.count("*").alias("graded"),
        F.count_if(F.col("decided") == F.col("truth")).alias("right"),
        F.count_if(F.col("brand") == F.col("truth")).alias("right_raw"),
        F.avg((F.col("decided") == F.col("truth")).cast("double")).alias("accuracy"),
        F.avg((F.col("brand") == F.col("truth")).cast("double")).alias("accuracy_raw"),
    )


def _pair_counts(outcomes: DataFrame, decided: str) -> DataFrame:
    """Rows per (truth, decision): a handful of rows that all scores derive from."""
    return outcomes.groupBy("truth", F.col(decided).alias("decided")).agg(F.count("*").alias("_n"))


def scorecard(outcomes: DataFrame, targets: Sequence[str], *, decided: str = "decided") -> DataFrame:
    """Hits, total and false positives per target and for ``other``.

    A false positive is charged to the brand that was named, never to ``other``.
    """
    names = (*targets, C.OTHER)
    truth, said, n = F.col("truth"), F.col("decided"), F.col("_n")
    shares = F.array(
        F.struct(truth.alias("name"), F.when(truth == said, n).otherwise(0).alias("h"), n.alias("t"), F.lit(0).alias("f")),
        F.struct(
            said.alias("name"), F.lit(0).alias("h"), F.lit(0).alias("t"),
            F.when((truth != said) & said.isin(*targets), n).otherwise(0).alias("f"),
        ),
    )
    parts = _pair_counts(outcomes, decided).select(F.inline(shares)).filter(F.col("name").isin(*names))
    sums = parts.groupBy("name").agg(F.sum("h").alias("hits"), F.sum("t").alias("total"), F.sum("f").alias("false_positives"))
    return _listed(outcomes, names).join(sums, "name", "left").fillna(0).withColumn(
        "share", F.coalesce(F.try_divide("hits", "total"), F.lit(0.0))
    )


def _listed(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(n) for n in names])).alias("name"))


def score_totals(outcomes: DataFrame, targets: Sequence[str], *, decided: str = "decided") -> DataFrame:
    """Right answers among targets and ``other``, all graded rows, invented brands."""
    said, truth = F.col(decided), F.col("truth")
    return outcomes.agg(
        F.count_if((said == truth) & truth.isin(*targets, C.OTHER)).alias("correct"),
        F.count("*").alias("graded"),
        F.count_if((said != truth) & said.isin(*targets)).alias("invented"),
    )


def common_outcomes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Two runs (one row per file) side by side on the files both know."""
    old = before.select("file", "truth", F.col("decided").alias("before"))
    new = after.select("file", F.col("truth").alias("truth_after"), F.col("decided").alias("after"))
    return old.join(new, "file")


def run_coverage(before: DataFrame, after: DataFrame) -> DataFrame:
    """How many files the runs share, and how many each one has."""
    old = before.select("file", F.lit(1).alias("_old"))
    new = after.select("file", F.lit(1).alias("_new"))
    return old.join(new, "file", "full_outer").agg(
        F.count_if(F.col("_old").isNotNull() & F.col("_new").isNotNull()).alias("common"),
        F.count("_old").alias("before"),
        F.count("_new").alias("after"),
    )


def comparison_totals(before: DataFrame, after: DataFrame, targets: Sequence[str]) -> DataFrame:
    """Right decisions and false positives of both runs over their common files."""
    sums = compare_runs(before, after, targets).agg(
        *[F.sum(c).alias(c) for c in ("hits_before", "hits_after", "false_before", "false_after")]
    )
    return common_outcomes(before, after).agg(F.count("*").alias("common")).join(F.broadcast(sums))  # one row each


def compare_runs(before: DataFrame, after: DataFrame, targets: Sequence[str]) -> DataFrame:
    """Per brand: hits and false positives of both runs on common files, and the shift."""
    both = common_outcomes(before, after)
    pairs = both.groupBy("truth", "truth_after", "before", "after").agg(F.count("*").alias("_n"))
    sides = F.array(
        F.struct(F.lit(0).alias("run"), F.col("truth"), F.col("before").alias("decided")),
        F.struct(F.lit(1).alias("run"), F.col("truth_after").alias("truth"), F.col("after").alias("decided")),
    )
    rows = pairs.select(F.inline(sides), "_n")
    hit = F.col("decided") == F.col("truth")
    names = (*targets, C.OTHER)
    entries = F.array(
        F.struct(F.col("truth").alias("name"), F.when(hit, F.col("_n")).otherwise(0).alias("h"), F.col("_n").alias("t"), F.lit(0).alias("f")),
        F.struct(F.col("decided").alias("name"), F.lit(0).alias("h"), F.lit(0).alias("t"), F.when(~hit & F.col("decided").isin(*targets), F.col("_n")).otherwise(0).alias("f")),
    )
    flat = rows.select("run", F.inline(entries)).filter(F.col("name").isin(*names))
    pick = lambda value, run: F.sum(F.when(F.col("run") == run, F.col(value)).otherwise(0))
    sums = flat.groupBy("name").agg(
        pick("h", 0).alias("hits_before"),
        pick("h", 1).alias("hits_after"),
        pick("t", 0).alias("total_before"),
        pick("t", 1).alias("total_after"),
        pick("f", 0).alias("false_before"),
        pick("f", 1).alias("false_after"),
    )
    joined = _listed(before, names).join(sums, "name", "left").fillna(0)
    return joined.withColumn("shift", F.col("hits_after") - F.col("hits_before"))


def changed_decisions(before: DataFrame, after: DataFrame) -> DataFrame:
    """Files whose decision changed: fixed, broken or still wrong."""
    both = common_outcomes(before, after).filter(F.col("before") != F.col("after"))
    mark = flip_mark(F.col("truth"), F.col("before"), F.col("after"))
    return both.select("file", "truth", "before", "after", mark.alias("mark"))


def precision_recall(outcomes: DataFrame, targets: Sequence[str], *, decided: str = "decided") -> DataFrame:
    """Precision and recall over the target brands; null without cases."""
    said, truth = F.col(decided), F.col("truth")
    counts = graded(outcomes).agg(
        F.count_if(said.isin(*targets)).alias("called"),
        F.count_if(said.isin(*targets) & (said == truth)).alias("correct"),
        F.count_if(truth.isin(*targets)).alias("present"),
        F.count_if(truth.isin(*targets) & (said == truth)).alias("found"),
    )
    return counts.withColumn("precision", F.try_divide("correct", "called")).withColumn(
        "recall", F.try_divide("found", "present")
    )


def confusion(predictions: DataFrame, classes: Sequence[str]) -> DataFrame:
    """Truth × guess counts with every class in place, and the share of right ones per row."""
    known = predictions.filter(F.col("truth").isin(*classes) & F.col("guess").isin(*classes))
    table = known.groupBy(F.col("truth").alias("name")).pivot("guess", list(classes)).agg(F.count(F.lit(1)))
    table = _listed(predictions, classes).join(table, "name", "left").fillna(0)
    total = sum((F.col(c) for c in classes[1:]), F.col(classes[0]))
    table = table.withColumnRenamed("name", "truth")
    right = F.coalesce(*[F.when(F.col("truth") == c, F.col(c)) for c in classes])
    return table.withColumn("right_share", F.coalesce(F.try_divide(right, total), F.lit(0.0)))


def macro_f1(predictions: DataFrame, by: Sequence[str]) -> DataFrame:
    """Macro F1 per fold over the classes seen in truth or guess; a class never hit counts 0."""
    cells = predictions.groupBy(*by, "truth", "guess").agg(F.count("*").alias("_n"))
    n = F.col("_n")
    hit = F.when(F.col("truth") == F.col("guess"), n).otherwise(0)
    ends = F.array(
        F.struct(F.col("truth").alias("name"), n.alias("_all"), hit.alias("_hit")),
        F.struct(F.col("guess").alias("name"), n.alias("_all"), F.lit(0).alias("_hit")),
    )
    per_class = cells.select(*by, F.inline(ends)).groupBy(*by, "name").agg(
        F.sum("_all").alias("_ends"), F.sum("_hit").alias("_hits")
    )
    f1 = 2.0 * F.col("_hits") / F.col("_ends")
    return per_class.groupBy(*by).agg(F.avg(f1).alias("f1"))


def arm_summary(scores: DataFrame, baseline: str, *, shortcut: str = "shortcut", limit: float = 0.5) -> DataFrame:
    """Mean and spread of fold scores per arm, and the paired gain over a baseline arm."""
    base = scores.filter(F.col("arm") == baseline).select("repeat", "fold", F.col("f1").alias("_base"))
    paired = scores.join(base, ["repeat", "fold"], "left").withColumn("_gain", F.col("f1") - F.col("_base"))
    return (
        paired.groupBy("arm")
        .agg(
            F.count("*").alias("folds"),
            F.avg("f1").alias("mean"),
            F.stddev_pop("f1").alias("spread"),
            F.avg("_gain").alias("gain"),
            F.stddev_pop("_gain").alias("gain_spread"),
        )
        .withColumn("suspicious", (F.col("arm") == shortcut) & (F.col("mean") > limit))
    )
