"""Colour measurements over a table of points ``img, x, y, width, height, L, a, b`` (or ``r, g, b``).

Every measure is an aggregate with partial sums per image, grid cell or both,
so an image of any size spreads over many tasks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from framewright.functions import colour as K
from framewright.functions.colour import lab
from framewright.functions.geometry import size_features
from framewright.operators.resample import resampled_sharpness, shrunk
from framewright.session import pin

NAMES = tuple(K.ANCHORS)
BALANCE_POWER = 6


def to_lab(pixels: DataFrame) -> DataFrame:
    """Pixels ``r, g, b`` → points in Lab."""
    parts = lab(F.col("r"), F.col("g"), F.col("b"))
    keep = [c for c in pixels.columns if c not in ("r", "g", "b")]
    return pixels.select(*keep, *[v.alias(k) for k, v in parts.items()])


def membership(points: DataFrame, anchors: dict[str, tuple[float, float, float]] | None = None) -> DataFrame:
    """Soft share of every point in every anchor, columns ``w_<anchor>`` that sum to one.

    The anchors are constants of the plan: no join, and one pass over the points.
    """
    anchors = anchors or {name: K.anchor_lab(rgb) for name, rgb in K.ANCHORS.items()}
    weights = []
    for name, (light, a, b) in anchors.items():
        square = F.pow(F.col("L") - light, F.lit(2)) + F.pow(F.col("a") - a, F.lit(2)) + F.pow(F.col("b") - b, F.lit(2))
        weights.append(F.exp(-square / F.lit(K.KERNEL_SIGMA**2)).alias(f"w_{name}"))
    raw = points.select("*", *weights)
    names = [f"w_{name}" for name in anchors]
    total = sum((F.col(n) for n in names[1:]), F.col(names[0])) + F.lit(1e-9)
    keep = [c for c in points.columns]
    return raw.withColumn("_total", total).select(*keep, *[(F.col(n) / F.col("_total")).alias(n) for n in names])


def _cell(axis: str, size: str, grid: int) -> Column:
    return F.floor(F.col(axis) * F.lit(grid) / F.col(size)).cast("int")


def cell_sums(weighted: DataFrame, *, grid: int = K.FINE_GRID) -> DataFrame:
    """Sums per grid cell: the small table all palette features derive from."""
    cells = weighted.groupBy("img", _cell("y", "height", grid).alias("row"), _cell("x", "width", grid).alias("col"))
    return cells.agg(F.count("*").alias("n"), *[F.sum(f"w_{n}").alias(f"s_{n}") for n in NAMES])


def coarser(cells: DataFrame, factor: int = 2) -> DataFrame:
    """Sums of a grid ``factor`` times coarser; cells nest, so no second pass over the points."""
    up = lambda c: F.floor(F.col(c) / F.lit(factor)).cast("int").alias(c)
    return cells.groupBy("img", up("row"), up("col")).agg(
        F.sum("n").alias("n"), *[F.sum(f"s_{n}").alias(f"s_{n}") for n in NAMES]
    )


def pooled(cells: DataFrame, *, grid: int) -> DataFrame:
    """Mean membership of every cell of every image; a cell without points is 0."""
    spots = F.explode(F.sequence(F.lit(0), F.lit(grid * grid - 1)))
    every = cells.select("img").distinct().withColumn("cell", spots)
    means = [(F.col(f"s_{n}") / F.col("n")).alias(n) for n in NAMES]
    filled = cells.select("img", (F.col("row") * grid + F.col("col")).alias("cell"), *means)
    return every.join(filled, ["img", "cell"], "left").fillna(0.0)


def shares_and_peaks(coarse: DataFrame) -> DataFrame:
    """Mean membership per image, and the greatest mean of a coarse cell."""
    n = F.sum("n")
    return coarse.groupBy("img").agg(
        *[(F.sum(f"s_{c}") / n).alias(f"share_{c}") for c in NAMES],
        *[F.max(F.col(f"s_{c}") / F.col("n")).alias(f"peak_{c}") for c in NAMES],
    )


def palette_entropy(described: DataFrame) -> DataFrame:
    """Normalised entropy of the shares."""
    parts = [F.col(f"share_{c}") * F.log(F.col(f"share_{c}") + 1e-9) for c in NAMES]
    entropy = -sum(parts[1:], parts[0]) / F.lit(math.log(len(NAMES)))
    return described.select("img", entropy.alias("palette_entropy"))


def brand_metrics(coarse: DataFrame) -> DataFrame:
    """Coverage, peak coverage, balance, similarity and score per image and brand palette."""
    covers = {
        brand: sum((F.col(f"s_{c}") for c in list(proto)[1:]), F.col(f"s_{list(proto)[0]}")) / F.col("n")
        for brand, proto in K.PROTOTYPES.items()
    }
    n = F.sum("n")
    base = coarse.groupBy("img").agg(
        *[(F.sum(f"s_{c}") / n).alias(f"share_{c}") for c in NAMES],
        *[F.max(F.col(f"s_{c}") / F.col("n")).alias(f"peak_{c}") for c in NAMES],
        *[F.max(cover).alias(f"cover_{brand}") for brand, cover in covers.items()],
    )
    norm = F.sqrt(sum((F.pow(f"share_{c}", F.lit(2)) for c in NAMES[1:]), F.pow(f"share_{NAMES[0]}", F.lit(2))))
    rows = []
    for brand, proto in K.PROTOTYPES.items():
        coverage = sum((F.col(f"share_{c}") for c in list(proto)[1:]), F.col(f"share_{list(proto)[0]}"))
        logs = [F.log(F.col(f"peak_{c}") + 1e-6) for c in K.REQUIRED[brand]]
        balance = F.exp(sum(logs[1:], logs[0]) / F.lit(len(logs)))
        dots = [F.col(f"share_{c}") * F.lit(weight) for c, weight in proto.items()]
        length = math.sqrt(sum(v * v for v in proto.values()))
        similarity = sum(dots[1:], dots[0]) / (norm * F.lit(length) + 1e-9)
        zero = F.lit(0.0)
        score = F.cbrt(
            F.greatest(F.col(f"cover_{brand}"), zero) * F.greatest(balance, zero) * F.greatest(similarity, zero)
        )
        rows.append(
            F.struct(
                F.lit(brand).alias("brand"),
                coverage.alias("coverage"),
                F.col(f"cover_{brand}").alias("coverage_peak"),
                balance.alias("balance"),
                similarity.alias("similarity"),
                score.alias("score"),
            )
        )
    return base.select("img", F.inline(F.array(*rows)))


def _neighbours(grid: int) -> list[tuple[int, int]]:
    across = [(r * grid + c, r * grid + c + 1) for r in range(grid) for c in range(grid - 1)]
    down = [(r * grid + c, (r + 1) * grid + c) for r in range(grid - 1) for c in range(grid)]
    return across + down


def _joins(i: int, j: int):
    return lambda e: ((e["a"] == i) & (e["b"] == j)) | ((e["a"] == j) & (e["b"] == i))


def adjacency(cells: DataFrame, *, grid: int) -> DataFrame:
    """Share of neighbouring cells whose dominant colours form a brand pair; best pair per brand.

    An image has ``grid²`` cells, so its dominant colours fit in one map.
    """
    means = F.array(*[F.col(f"s_{c}") / F.col("n") for c in NAMES])
    dominant = F.array_position(means, F.array_max(means)) - 1
    spots = cells.select("img", (F.col("row") * grid + F.col("col")).alias("cell"), dominant.alias("colour"))
    table = spots.groupBy("img").agg(F.map_from_entries(F.collect_list(F.struct("cell", "colour"))).alias("_m"))
    places = _neighbours(grid)
    at = lambda cell: F.coalesce(F.try_element_at("_m", cell), F.lit(0))
    edges = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in places])
    joined = table.select("img", F.transform(edges, lambda e: F.struct(at(e["a"]).alias("a"), at(e["b"]).alias("b"))).alias("_e"))
    results = []
    for brand, pairs in K.PAIRS.items():
        found = []
        for first, second in pairs:
            i, j = NAMES.index(first), NAMES.index(second)
            found.append(F.size(F.filter("_e", _joins(i, j))) / F.lit(len(places)))
        best = F.greatest(*found) if len(found) > 1 else found[0]
        results.append(F.struct(F.lit(brand).alias("brand"), best.alias("adjacency")))
    return joined.select("img", F.inline(F.array(*results)))


def image_statistics(points: DataFrame) -> DataFrame:
    """Achromatic share, lightness median and spread, mean chroma.

    Lightness has at most 256 levels, which bounds the state of the exact median.
    """
    chroma = F.sqrt(F.pow("a", F.lit(2)) + F.pow("b", F.lit(2)))
    return points.withColumn("_chroma", chroma).groupBy("img").agg(
        F.avg((F.col("_chroma") < K.ACHROMATIC_CHROMA).cast("double")).alias("achromatic"),
        (F.percentile("L", F.lit(0.5)) / 100.0).alias("lightness_median"),
        (F.stddev_pop("L") / 100.0).alias("lightness_spread"),
        (F.avg("_chroma") / 100.0).alias("chroma"),
    )


def colourfulness(pixels: DataFrame) -> DataFrame:
    """How colourful an image is, from the spread and mean of its opponent channels."""
    red, green, blue = (F.col(c).cast("double") for c in ("r", "g", "b"))
    opponent = pixels.select("img", (red - green).alias("_rg"), (0.5 * (red + green) - blue).alias("_yb"))
    spread = F.sqrt(F.var_pop("_rg") + F.var_pop("_yb"))
    mean = F.sqrt(F.pow(F.avg("_rg"), F.lit(2)) + F.pow(F.avg("_yb"), F.lit(2)))
    return opponent.groupBy("img").agg(((spread + 0.3 * mean) / 100.0).alias("colorfulness"))


def sharpness(grey: DataFrame) -> DataFrame:
    """Log variance of the Laplacian of ``img, x, y, v``; edges mirror their inner neighbour.

    Windows run along single rows and columns of an image, never over a whole image.
    """
    def sides(axis: str, across: str) -> Column:
        line = W.partitionBy("img", across).orderBy(axis)
        before, after = F.lag("v").over(line), F.lead("v").over(line)
        return F.coalesce(before, after, F.col("v")) + F.coalesce(after, before, F.col("v"))

    horizontal = grey.withColumn("_h", sides("x", "y"))
    laplace = horizontal.withColumn("_l", sides("y", "x") + F.col("_h") - 4 * F.col("v"))
    return laplace.groupBy("img").agg(F.log10(F.var_pop("_l") + 1e-6).alias("sharpness"))


def white_balance(pixels: DataFrame, *, power: int = BALANCE_POWER, whole: bool = False) -> DataFrame:
    """Even out the colour of the light: channels scaled to a common power mean, clipped to 0–255.

    ``whole`` cuts the result, in single precision, to whole numbers, as an 8-bit image holds them.
    """
    channels = ("r", "g", "b")
    light = pixels.groupBy("img").agg(
        *[F.pow(F.avg(F.pow(F.col(c) + 1.0, F.lit(power))), F.lit(1.0 / power)).alias(f"_{c}") for c in channels]
    )
    mean = (F.col("_r") + F.col("_g") + F.col("_b")) / 3.0
    keep = [c for c in pixels.columns if c not in channels]
    scaled = [
        F.greatest(F.lit(0.0), F.least(F.lit(255.0), (F.col(c) + 1.0) * mean / F.col(f"_{c}"))).alias(c) for c in channels
    ]
    balanced = pixels.join(light, "img").select(*keep, *scaled)
    return balanced.withColumns({c: F.floor(F.col(c).cast("float")).cast("int") for c in channels}) if whole else balanced


def stretch_lightness(points: DataFrame) -> DataFrame:
    """Lightness stretched between its 2nd and 98th percentile; flat images stay as they are."""
    ends = points.groupBy("img").agg(F.percentile("L", F.array(F.lit(0.02), F.lit(0.98))).alias("_p"))
    low, high = F.col("_p")[0], F.col("_p")[1]
    wide = F.greatest(F.lit(0.0), F.least(F.lit(100.0), (F.col("L") - low) / (high - low) * 90.0 + 5.0))
    joined = points.join(ends, "img")
    return joined.withColumn("L", F.when(high - low < 1.0, F.col("L")).otherwise(wide)).drop("_p")


# Names of the features, and the sides pictures are brought to before measuring.
STATISTICS = ("achromatic", "lightness_median", "lightness_spread", "chroma", "colorfulness", "palette_entropy")
BRAND_MEASURES = ("coverage", "coverage_peak", "balance", "similarity", "score")
SHORTCUTS = ("log_width", "log_height", "aspect", "log_area", "sharpness")
WORK_SIDE, SHARP_SIDE = 160, 128


def feature_names() -> tuple[str, ...]:
    """Names of the colour features, in the order of their vector."""
    return (
        *[f"share_{c}" for c in NAMES],
        *[f"peak_{c}" for c in NAMES],
        *STATISTICS,
        *[f"{brand}_{m}" for brand in K.PROTOTYPES for m in BRAND_MEASURES],
        *[f"{brand}_adjacency_{grid}" for brand in K.PAIRS for grid in ("coarse", "fine")],
    )


def _sideways(long: DataFrame, brands, measures: dict[str, str]) -> DataFrame:
    """One row per image from one row per image and brand."""
    picks = [
        F.max(F.when(F.col("brand") == brand, F.col(column))).alias(f"{brand}_{name}")
        for brand in brands
        for column, name in measures.items()
    ]
    return long.groupBy("img").agg(*picks)


def colour_features(pixels: DataFrame, *, side: int = WORK_SIDE) -> DataFrame:
    """All colour features of every image: ``img, values`` in the order of :func:`feature_names`.

    Pixels are read once: the pass that resamples them to ``side`` also sums up what colourfulness needs of the full picture.
    Every further table has a few rows per image, and all of them meet on ``img``.
    """
    small = pin(shrunk(pixels, side, whole=_opponents()))
    plain = pin(to_lab(white_balance(small, whole=True)))
    fine = pin(cell_sums(membership(stretch_lightness(plain))))
    coarse = coarser(fine)
    shares = shares_and_peaks(coarse)
    tables = [
        image_statistics(plain),
        _colourfulness_of_sums(small),
        palette_entropy(shares),
        _sideways(brand_metrics(coarse), K.PROTOTYPES, {m: m for m in BRAND_MEASURES}),
        _sideways(adjacency(coarse, grid=K.COARSE_GRID), K.PAIRS, {"adjacency": "adjacency_coarse"}),
        _sideways(adjacency(fine, grid=K.FINE_GRID), K.PAIRS, {"adjacency": "adjacency_fine"}),
    ]
    for table in tables:
        shares = shares.join(table, "img")
    return shares.select("img", F.array(*[F.col(n).cast("float") for n in feature_names()]).alias("values"))


def _opponents() -> dict[str, Column]:
    """Sums of the opponent channels and their squares; twice the yellow-blue one, so that all are whole."""
    r, g, b = (F.col(c).cast("long") for c in ("r", "g", "b"))
    rg, yb = r - g, r + g - 2 * b
    return {"_n": F.lit(1).cast("long"), "_rg": rg, "_rg2": rg * rg, "_yb": yb, "_yb2": yb * yb}


def _colourfulness_of_sums(small: DataFrame) -> DataFrame:
    """:func:`colourfulness` of full pictures from the sums that :func:`_opponents` names."""
    total = small.groupBy("img").agg(*[F.sum(c).cast("double").alias(c) for c in ("_n", "_rg", "_rg2", "_yb", "_yb2")])
    rg, yb = F.col("_rg") / F.col("_n"), F.col("_yb") / F.col("_n") / 2
    spread = F.sqrt((F.col("_rg2") / F.col("_n") - rg * rg) + (F.col("_yb2") / F.col("_n") / 4 - yb * yb))
    mean = F.sqrt(rg * rg + yb * yb)
    return total.select("img", ((spread + 0.3 * mean) / 100.0).alias("colorfulness"))


def shortcut_features(pixels: DataFrame) -> DataFrame:
    """What gives away the source of a picture: size, aspect and sharpness at 128 × 128, in the order of ``SHORTCUTS``."""
    grey = F.round(0.299 * F.col("r") + 0.587 * F.col("g") + 0.114 * F.col("b"), 0).cast("int").alias("v")
    sharp = resampled_sharpness(pixels.select("img", "x", "y", "width", "height", grey), side=SHARP_SIDE)
    parts = size_features(F.col("width"), F.col("height"))
    named = sharp.select("img", *[v.alias(k) for k, v in parts.items()], "sharpness")
    return named.select("img", F.array(*[F.col(n).cast("float") for n in SHORTCUTS]).alias("values"))


def attribution(cells: DataFrame, weights: dict[str, list[float]]) -> DataFrame:
    """Contribution of every grid cell to every class, scaled to 0–1 per image and class.

    ``cells`` has ``img, cell, features``; ``weights`` holds one weight per
    channel for each class of the head, already divided by the channel spread.
    """
    classes = F.array(
        *[
            F.struct(F.lit(name).alias("class"), F.array(*[F.lit(float(w)) for w in row]).alias("_w"))
            for name, row in weights.items()
        ]
    )
    each = cells.select("img", "cell", "features", F.inline(classes))
    raw = F.aggregate(F.zip_with("features", "_w", lambda f, w: f * w), F.lit(0.0), lambda acc, v: acc + v)
    positive = each.select("img", "class", "cell", F.greatest(F.lit(0.0), raw).alias("_v"))
    peaks = positive.groupBy("img", "class").agg(F.max("_v").alias("_peak"))
    scaled = F.when(F.col("_peak") > 0, F.col("_v") / F.col("_peak")).otherwise(F.col("_v"))
    return positive.join(peaks, ["img", "class"]).select("img", "class", "cell", scaled.alias("weight"))


def generic_features(named: DataFrame) -> DataFrame:
    """Features ``img, name, value`` that know nothing about brands."""
    return named.filter(F.col("name").rlike("^(" + "|".join(GENERIC_PREFIXES) + ")"))


# Prefixes of colour features that use no brand palette.
GENERIC_PREFIXES = (
    "share_",
    "peak_",
    "achromatic",
    "lightness_",
    "chroma",
    "colorfulness",
    "palette_entropy",
)
