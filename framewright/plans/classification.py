"""Classifier jobs: features, heads, answers of a vision model, comparison of runs."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright import schemas as C
from framewright.functions.answers import decided, parse_brand_reply, trust
from framewright.functions.naming import probe_name
from framewright.operators import heads, nearest, scoring, splits
from framewright.operators.inference import Extractor, ask_service, extract, require_service
from framewright.operators.ranking import first_listed
from framewright.sources import feature_store

# Folders of other brands that look like a target, taken whole into a probe.
HARD_NEGATIVES = (
    "Сбер",
    "СберМаркет",
    "СберМобайл",
    "Мегамаркет",
    "Магнит",
    "Магнит Косметик",
    "Альфа-Банк",
    "Альфа-Мобайл",
    "Т-Банк",
    "Т-Мобайл",
    "Яндекс Такси",
    "Яндекс Go",
    "Пятёрочка",
    "аптеки",
)
STREET_SOURCE = "щиты с улицы"


def features(samples: DataFrame, extractor: Extractor, column: str, root: str, *, key: str = "id", refresh: bool = False) -> DataFrame:
    """Features from the store, computed when the sample set changed."""
    data, _ = feature_store.features(
        samples.select(key), root, extractor.name, extractor.version, len(extractor.dims),
        lambda: extract(samples, extractor, column, key=key), key=key, refresh=refresh,
    )
    return data


def train(samples: DataFrame, widths: Mapping[str, int], path: str, *, color_weight: float = 1.0, c: float = 1.0) -> PipelineModel:
    """Head over all samples, saved with its metadata."""
    return heads.train_and_save(samples, widths, path, classes=C.HEAD_CLASSES, weights={"color": color_weight}, c=c)


def predict(samples: DataFrame, path: str, blocks: Sequence[str], *, floor: float = 0.55) -> DataFrame:
    return heads.predict(samples, PipelineModel.load(f"{path}/model"), blocks, floor=floor)


def ablate(
    samples: DataFrame, embedding: str, arms: Mapping[str, Mapping[str, int]], baseline: str, *, threshold: float = 0.97, **options
) -> dict[str, DataFrame]:
    """Do the blocks help?  Repeated grouped cross-validation over near-duplicate groups.

    ``options`` go to :func:`heads.ablate` (folds, repeats, seed, weights, ...).
    """
    groups = nearest.duplicate_groups(samples.select("id", F.col(embedding).alias("vector")), threshold=threshold)
    guesses = heads.ablate(samples.join(groups, "id"), arms, **options)
    names = F.array(*[F.lit(c) for c in C.HEAD_CLASSES])
    name = lambda c: F.element_at(names, F.col(c).cast("int") + 1)
    first = guesses.filter((F.col("repeat") == 0) & (F.col("arm") == baseline)).select(name("truth").alias("truth"), name("guess").alias("guess"))
    return {
        "groups": nearest.group_totals(groups),
        "predictions": guesses,
        "scores": scoring.arm_summary(heads.fold_scores(guesses), baseline),
        "confusion": scoring.confusion(first, C.HEAD_CLASSES),
    }


def standard_arms(samples: DataFrame, dims: Mapping[str, Sequence[str]]) -> tuple[DataFrame, dict[str, dict[str, int]]]:
    """Samples with a brand-free colour block, and the arms that tell the blocks apart.

    ``dims`` names the dimensions of ``visual``, ``color`` and, if there, ``shortcut``.
    """
    rows = heads.generic_only(samples.withColumn("color_generic", F.col("color")), "color_generic", dims["color"])
    generic = sum(d.startswith(heads.GENERIC_PREFIXES) for d in dims["color"])
    visual, color, plain = {"visual": len(dims["visual"])}, {"color": len(dims["color"])}, {"color_generic": generic}
    arms = {
        "visual": visual,
        "color": color,
        "visual+color": visual | color,
        "color, no brands": plain,
        "visual+color, no brands": visual | plain,
    }
    if "shortcut" in dims:
        arms["shortcut"] = {"shortcut": len(dims["shortcut"])}
    return rows, arms


def answer(
    frames: DataFrame, truth: DataFrame, make_client: Callable, column: str, *, probe: Callable[[], bool] | None = None,
    limit: int = 0, accept_logo: bool = False, sessions: int | None = None,
) -> DataFrame:
    """Ask the vision model about every frame; trust, decision and truth beside its answer."""
    if probe is not None:
        require_service(probe, "vision model")
    asked = ask_service(first_listed(frames, "file", limit), make_client, column, key="file", sessions=sessions)
    fields = parse_brand_reply(F.col("reply"), F.col("failure"))
    rows = asked.select("file", *[v.alias(k) for k, v in fields.items()])
    rows = rows.withColumn("verdict", trust(*[F.col(c) for c in ("brand", "basis", "visible_text", "error")]))
    rows = rows.withColumn("decided", decided(F.col("brand"), F.col("verdict"), accept_logo=accept_logo))
    return scoring.with_truth(rows, truth)


def score(outcomes: DataFrame) -> dict[str, DataFrame]:
    """Everything a run is judged by."""
    graded = scoring.graded(outcomes)
    return {
        "answers": scoring.answer_shares(outcomes),
        "bases": scoring.answer_shares(outcomes, "basis"),
        "accuracy": scoring.accuracy(outcomes),
        "failures": scoring.failures(outcomes),
        "brands": scoring.precision_recall(outcomes, C.TARGETS),
        "scorecard": scoring.scorecard(graded, C.TARGETS),
        "totals": scoring.score_totals(graded, C.TARGETS),
    }


def compare(before: DataFrame, after: DataFrame) -> dict[str, DataFrame]:
    """Two runs side by side on common files."""
    old, new = scoring.graded(before), scoring.graded(after)
    return {
        "coverage": scoring.run_coverage(old, new),
        "brands": scoring.compare_runs(old, new, C.TARGETS),
        "totals": scoring.comparison_totals(old, new, C.TARGETS),
        "changes": scoring.changed_decisions(old, new),
    }


def probe(
    samples: DataFrame, *, per_hard: int = 0, street: int = 150, random_other: int = 150, per_brand: int = 40, seed: int = 0,
    hard: Sequence[str] = HARD_NEGATIVES, street_source: str = STREET_SOURCE,
) -> DataFrame:
    """A test set rich in look-alikes: hard negatives, street frames, other negatives, every target.

    ``samples`` has ``file, brand, source``.  ``per_hard`` 0 takes the hard ones whole.
    """
    source = F.when(F.col("source") == "", F.col("brand")).otherwise(F.col("source"))
    named = samples.withColumn("source", F.coalesce(source, F.col("brand")))
    rest = (F.col("brand") == C.OTHER) & ~F.col("source").isin(*hard, street_source)
    grouped = named.withColumn("_group", F.when(rest, F.lit("_rest")).otherwise(F.col("source")))
    limits = dict.fromkeys(hard, per_hard)
    wanted = {street_source: street, "_rest": random_other, **dict.fromkeys(C.TARGETS, per_brand)}
    limits |= {name: n for name, n in wanted.items() if n > 0}
    chosen = splits.sample_groups(grouped, group="_group", key="file", limits=limits, seed=seed)
    return chosen.select(probe_name(F.col("source"), F.col("file")).alias("file"), "brand", "source")


def blind(files: DataFrame, tables: Sequence[tuple[str, DataFrame]], *, seed: int = 0) -> DataFrame:
    """Numbered names in random order, with the key that leads back."""
    return splits.blind(files, tables, seed=seed)
