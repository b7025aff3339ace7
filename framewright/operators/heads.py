"""Linear heads over feature blocks: training, prediction, ablation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import ElementwiseProduct, Normalizer, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright import schemas as C
from framewright.functions.answers import class_index, pick_class
from framewright.operators import many_heads
from framewright.operators.palette import GENERIC_PREFIXES
from framewright.operators.scoring import macro_f1
from framewright.operators.splits import group_folds
from framewright.session import pin


def as_vectors(df: DataFrame, blocks: Sequence[str]) -> DataFrame:
    """Array columns → vectors, as the learners want them."""
    return df.withColumns({b: array_to_vector(F.col(b)) for b in blocks})


def block_stages(widths: Mapping[str, int], weights: Mapping[str, float]) -> list:
    """Standardise each block, bring its rows to unit length, weigh it, join the blocks."""
    stages: list = []
    for block, width in widths.items():
        stages.append(StandardScaler(inputCol=block, outputCol=f"{block}_scaled", withMean=True, withStd=True))
        stages.append(Normalizer(inputCol=f"{block}_scaled", outputCol=f"{block}_unit", p=2.0))
        factor = Vectors.dense([float(weights.get(block, 1.0))] * width)
        stages.append(ElementwiseProduct(inputCol=f"{block}_unit", outputCol=f"{block}_weighted", scalingVec=factor))
    stages.append(VectorAssembler(inputCols=[f"{b}_weighted" for b in widths], outputCol="features"))
    return stages


def balanced(df: DataFrame, label: str) -> tuple[DataFrame, int, int]:
    """Adds ``weight`` = n / (classes · class size); also returns n and the number of classes."""
    sizes = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count("*").alias("n")).collect()}  # one row per class
    total = sum(sizes.values())
    table = F.create_map(*[F.lit(v) for k, n in sizes.items() for v in (k, total / (len(sizes) * n))])
    return df.withColumn("weight", table[F.col(label)]), total, len(sizes)


def fit_head(
    df: DataFrame, widths: Mapping[str, int], *, label: str = "label", weights: Mapping[str, float] | None = None,
    c: float = 1.0, max_iter: int = 3000,
) -> PipelineModel:
    """Fit scaler and balanced multinomial head on all rows of ``df``."""
    weighted, total, _ = balanced(df, label)
    head = LogisticRegression(
        featuresCol="features", labelCol=label, weightCol="weight", family="multinomial",
        regParam=1.0 / (c * total), elasticNetParam=0.0, standardization=False, maxIter=max_iter, tol=1e-6,
    )
    return Pipeline(stages=[*block_stages(widths, weights or {}), head]).fit(weighted)


def train_and_save(samples: DataFrame, widths: Mapping[str, int], path: str, *, classes: Sequence[str], **options) -> PipelineModel:
    """Train on everything and save the model with a row of metadata beside it.

    The shortcut block, which only knows picture sizes, never enters a saved model.
    """
    used = {b: w for b, w in widths.items() if b != "shortcut"}
    rows = as_vectors(samples.withColumn("label", class_index(F.col("brand"), tuple(classes)).cast("double")), list(used))
    model = fit_head(rows.filter("label IS NOT NULL"), used, **options)
    model.write().overwrite().save(f"{path}/model")
    meta = samples.sparkSession.createDataFrame(
        [(list(classes), list(used), [int(w) for w in used.values()])], "classes array<string>, blocks array<string>, widths array<int>"
    )
    meta.coalesce(1).write.mode("overwrite").json(f"{path}/meta")
    return model


def predict(
    samples: DataFrame, model: Transformer, blocks: Sequence[str], *, classes: Sequence[str] = C.HEAD_CLASSES,
    floor: float = 0.55, key: str = "file",
) -> DataFrame:
    """Class or ``unsure``, its confidence, and one probability column per class."""
    scored = model.transform(as_vectors(samples, blocks)).withColumn("_p", vector_to_array("probability"))
    pick = pick_class(F.col("_p"), tuple(classes), floor)
    columns = [F.element_at("_p", i + 1).alias(f"p_{c}") for i, c in enumerate(classes)]
    return scored.select(key, pick["brand"].alias("brand"), pick["confidence"].alias("confidence"), *columns)


def generic_only(df: DataFrame, block: str, dims: Sequence[str]) -> DataFrame:
    """Keep the dimensions of a block that know nothing about brands."""
    places = [i + 1 for i, d in enumerate(dims) if d.startswith(GENERIC_PREFIXES)]
    return df.withColumn(block, F.array(*[F.element_at(block, i) for i in places]))


def dealt(
    samples: DataFrame, blocks: Sequence[str], *, label: str = "label", group: str = "group", key: str = "id", folds: int = 5, repeats: int = 5, seed: int = 0
) -> DataFrame:
    """Samples with ``folds``: the fold of the row's group in every repeat; pinned."""
    base = samples.select(key, label, group, *blocks)
    table = base.withColumn("folds", F.array().cast("array<int>"))
    for repeat in range(repeats):
        fold = group_folds(base.select(key, label, group), group=group, label=label, key=key, folds=folds, seed=seed + repeat)
        table = table.join(fold.select(key, "fold"), key).withColumn("folds", F.array_append("folds", F.col("fold"))).drop("fold")
    return pin(table.withColumn(label, F.col(label).cast("int")))


def ablate(
    samples: DataFrame, arms: Mapping[str, Mapping[str, int]], *, label: str = "label", group: str = "group", key: str = "id",
    folds: int = 5, repeats: int = 5, seed: int = 0, weights: Mapping[str, float] | None = None, c: float = 1.0,
    max_iter: int = 3000,
) -> DataFrame:
    """Predictions ``arm, repeat, fold, key, truth, guess`` of repeated grouped cross-validation.

    ``arms`` name the blocks they use and their widths.  The scaler is fitted inside each fold.  The heads of all arms, repeats and folds are
    fitted together (:mod:`framewright.operators.many_heads`), a pass over one pinned table per step.
    """
    blocks = sorted({b for arm in arms.values() for b in arm})
    table = dealt(samples, blocks, label=label, group=group, key=key, folds=folds, repeats=repeats, seed=seed)
    return many_heads.guesses(table, fitted_heads(table, arms, label=label, folds=folds, repeats=repeats, weights=weights, c=c, max_iter=max_iter), key=key, label=label)


def fitted_heads(table: DataFrame, arms: Mapping[str, Mapping[str, int]], *, label: str = "label", folds: int = 5, repeats: int = 5, **options) -> many_heads.Fitted:
    """All heads of a :func:`dealt` table."""
    classes = (table.agg(F.max(label)).first()[0] or 0) + 1
    return many_heads.fit(table, arms, classes=classes, folds=folds, repeats=repeats, label=label, **options)


def fold_scores(predictions: DataFrame) -> DataFrame:
    """Macro F1 per arm, repeat and fold."""
    return macro_f1(predictions, ["arm", "repeat", "fold"])


def visual_weights(model: PipelineModel, block: str, widths: Mapping[str, int], classes: Sequence[str]) -> dict[str, list[float]]:
    """Head weights of one block, put back to the scale of the raw features."""
    head = model.stages[-1].coefficientMatrix.toArray()
    names = list(widths)
    start = sum(widths[b] for b in names[: names.index(block)])
    spread = model.stages[3 * names.index(block)].std.toArray()
    spread = [s if s > 0 else 1.0 for s in spread]
    rows = head[:, start : start + widths[block]]
    return {c: [float(w / s) for w, s in zip(rows[i], spread, strict=True)] for i, c in enumerate(classes) if i < len(rows)}


def explanation(predictions: DataFrame, attribution: DataFrame, colours: DataFrame, dims: Sequence[str], *, key: str = "img") -> DataFrame:
    """Probabilities, the strongest cell per class, and named colour features of every image."""
    best = attribution.groupBy(key, "class").agg(F.max(F.struct("weight", "cell")).alias("_b"))
    named = colours.select(key, F.map_from_arrays(F.array(*[F.lit(d) for d in dims]), "values").alias("colour"))
    return (
        predictions.join(best, key)
        .join(named, key)
        .select(*predictions.columns, "class", F.col("_b.cell").alias("cell"), F.col("_b.weight").alias("weight"), "colour")
    )
