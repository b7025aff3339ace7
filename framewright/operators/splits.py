"""Splits: stratified, leak-free, repeatable."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.functions.naming import blinded_name, is_copy, pair_key
from framewright.operators.pool import has_boxes
from framewright.operators.ranking import ordered_rank, shuffled_rank


def part_sizes(n: Column, validation: float, test: float) -> tuple[Column, Column]:
    """Sizes of validation and test in a stratum of ``n``; at least one member stays in train.

    Shares round half-even and are at least one.  When they take everything, the
    larger part shrinks first, then both in turn; this is its closed form.
    """
    val = F.greatest(F.lit(1), F.bround(n * F.lit(validation), 0).cast("long"))
    tst = F.greatest(F.lit(1), F.bround(n * F.lit(test), 0).cast("long"))
    room = n - 1
    excess = val + tst - room
    small_val = (
        F.when(excess <= 0, val)
        .when((tst > val) & (excess <= tst - val), val)
        .when((val > tst) & (excess <= val - tst), val - excess)
        .otherwise(F.ceil(room / F.lit(2)))
    )
    small_test = (
        F.when(excess <= 0, tst)
        .when((tst > val) & (excess <= tst - val), tst - excess)
        .when((val > tst) & (excess <= val - tst), tst)
        .otherwise(F.floor(room / F.lit(2)))
    )
    return small_val, small_test


def stratified_split(
    df: DataFrame,
    *,
    stratum: Sequence[str | Column],
    key: str | Column,
    validation: float = 0.15,
    test: float = 0.15,
    seed: int = 0,
) -> DataFrame:
    """Adds ``split``.  Strata of fewer than three stay in train whole.

    Stratum and key are columns or expressions; null counts as a stratum of its own.
    """
    parts = [F.col(c) if isinstance(c, str) else c for c in stratum]
    names = [f"_stratum{i}" for i in range(len(parts))]
    filled = {n: F.coalesce(c.cast("string"), F.lit("\0")) for n, c in zip(names, parts, strict=True)}
    keyed = df.withColumns({**filled, "_key": F.col(key) if isinstance(key, str) else key})
    ranked = shuffled_rank(keyed, "_key", groups=names, seed=seed, rank="_rank")
    val, tst = part_sizes(F.col("_rank_of"), validation, test)
    place = F.col("_rank")
    split = (
        F.when(F.col("_rank_of") < 3, F.lit("train"))
        .when(place <= val, F.lit("val"))
        .when(place <= val + tst, F.lit("test"))
        .otherwise(F.lit("train"))
    )
    return ranked.withColumn("split", split).select(*df.columns, "split")


def follow_originals(df: DataFrame) -> DataFrame:
    """An augmented copy goes where its original went; a copy without one stays."""
    keyed = df.withColumn("_pair", pair_key(F.col("file"))).withColumn("_copy", is_copy(F.col("file")))
    home = keyed.filter(~F.col("_copy")).groupBy("_pair").agg(F.max("split").alias("_home"))
    return (
        keyed.join(home, "_pair", "left")
        .withColumn("split", F.when(F.col("_copy"), F.coalesce("_home", "split")).otherwise(F.col("split")))
        .drop("_pair", "_copy", "_home")
    )


def copies_only_in_train(df: DataFrame) -> DataFrame:
    return df.filter(~is_copy(F.col("file")) | (F.col("split") == "train"))


def split_counts(df: DataFrame) -> DataFrame:
    """Frames, empty frames and their share per part."""
    counts = df.groupBy("split").agg(
        F.count("*").alias("frames"), F.count_if(~has_boxes(F.col("text"))).alias("empty")
    )
    return counts.withColumn("empty_share", F.coalesce(F.try_divide("empty", "frames"), F.lit(0.0)))


def with_human_part(df: DataFrame, name: str) -> DataFrame:
    """Human-labelled part of the test, listed once more under a name of its own."""
    human = df.filter((F.col("split") == "test") & F.col("handmade"))
    return df.unionByName(human.withColumn("split", F.lit(name)))


def tally(df: DataFrame, stratum: Sequence[str], parts: Sequence[str]) -> DataFrame:
    """Members of every stratum in every part."""
    return df.groupBy(*stratum).pivot("split", list(parts)).agg(F.count(F.lit(1))).fillna(0, subset=list(parts))


def sample_groups(df: DataFrame, *, group: str, key: str, limits: Mapping[str, int], seed: int = 0) -> DataFrame:
    """Random members of the listed groups, up to each group's limit; 0 takes the group whole."""
    names = F.create_map(*[F.lit(v) for pair in limits.items() for v in pair])
    wanted = df.filter(F.col(group).isin(*limits)).withColumn("_limit", names[F.col(group)])
    whole = wanted.filter(F.col("_limit") == 0)
    ranked = shuffled_rank(wanted.filter(F.col("_limit") > 0), key, groups=[group], seed=seed, rank="_rank")
    chosen = ranked.filter(F.col("_rank") <= F.col("_limit")).drop("_rank", "_rank_of")
    return whole.unionByName(chosen).drop("_limit")


def blind(files: DataFrame, tables: Sequence[tuple[str, DataFrame]], *, seed: int = 0) -> DataFrame:
    """Random numbers for file names, and the key that leads back.

    ``tables`` are named truth tables; the first one, by name, that knows a file
    describes it.
    """
    numbered = shuffled_rank(files.select("file"), "file", seed=seed, rank="number").drop("number_of")
    known = None
    for place, (_, table) in enumerate(sorted(tables, key=lambda t: t[0])):
        cols = [F.col(c) if c in table.columns else F.lit(None).cast("string").alias(c) for c in KEY_FIELDS]
        rows = table.select("file", F.lit(place).alias("_place"), *cols)
        known = rows if known is None else known.unionByName(rows)
    first = known.groupBy("file").agg(F.min(F.struct("_place", *KEY_FIELDS)).alias("_row"))
    return numbered.join(first, "file", "left").select(
        blinded_name(F.col("number"), F.col("file")).alias("file"),
        *[F.coalesce(F.col(f"_row.{c}").cast("string"), F.lit("")).alias(c) for c in KEY_FIELDS],
        F.col("file").alias("original"),
    )


KEY_FIELDS = ("brand", "source", "quality")


def group_folds(df: DataFrame, *, group: str, label: str, key: str, folds: int, seed: int = 0) -> DataFrame:
    """Stratified folds that never cut a group.

    Each group counts as its majority class; the groups of a class are dealt to
    the folds in turn, largest first, ties in random order.
    """
    votes = df.groupBy(group, label).agg(F.count("*").alias("_n"))
    major = votes.groupBy(group).agg(
        F.max(F.struct("_n", (-F.col(label)).alias("_minus"))).alias("_top"), F.sum("_n").alias("_size")
    )
    major = major.select(
        group,
        (-F.col("_top._minus")).alias("_class"),
        (-F.col("_size")).alias("_less"),
        F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(group).cast("string"))).alias("_tie"),
    )
    ranked = ordered_rank(major, ["_less", "_tie", group], groups=["_class"], rank="_rank")
    dealt = ranked.select(group, F.pmod(F.col("_rank") - 1, F.lit(folds)).cast("int").alias("fold"))
    return df.join(dealt, group)
