"""Near duplicates, colour measurements, attribution."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from catalog.registry import query
from framewright.functions import colour as K
from framewright.operators import nearest, palette, resample

COSINE = 0.40
N = palette.NAMES

PAIRS = f"""
    WITH v AS (SELECT vec_id AS id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM {{embeddings}})
    SELECT a.id AS id_a, b.id AS id_b, list_cosine_similarity(a.e, b.e) AS cosine
    FROM v a JOIN v b ON a.id < b.id WHERE list_cosine_similarity(a.e, b.e) >= {COSINE}"""


def vectors(d):
    return d.embeddings.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))


@query("jn08_similar_pairs", f"SELECT id_a, id_b, round(cosine, 6) AS cosine FROM ({PAIRS})")
def jn08(d):
    return nearest.similar_pairs(vectors(d), threshold=COSINE).withColumn("cosine", F.round("cosine", 6))


GROUPS = f"""
    WITH RECURSIVE p AS MATERIALIZED ({PAIRS}), e AS (SELECT id_a AS u, id_b AS v FROM p UNION ALL SELECT id_b, id_a FROM p),
    reach AS (SELECT vec_id AS id, vec_id AS other FROM {{embeddings}}
              UNION SELECT r.id, e.v FROM reach r JOIN e ON r.other = e.u)
    SELECT id, min(other) AS "group" FROM reach GROUP BY id"""


@query("gr01_duplicate_groups", GROUPS)
def gr01(d):
    return nearest.duplicate_groups(vectors(d), threshold=COSINE)


@query(
    "ag30_group_totals",
    f"""SELECT sum(n)::BIGINT AS frames, count(*) AS groups, count(*) FILTER (n > 1) AS merged_groups, (sum(n) - count(*))::BIGINT AS merged_frames
        FROM (SELECT count(*) AS n FROM ({GROUPS}) GROUP BY "group")""",
)
def ag30(d):
    return nearest.group_totals(nearest.duplicate_groups(vectors(d), threshold=COSINE))


# --- colour --------------------------------------------------------------


def _curve(t: str) -> str:
    return f"CASE WHEN {t} > 0.008856e0 THEN cbrt({t}) ELSE 7.787e0 * {t} + 16e0 / 116e0 END"


def _linear(c: str) -> str:
    v = f"({c} / 255e0)"
    return f"CASE WHEN {v} <= 0.04045e0 THEN {v} / 12.92e0 ELSE pow(({v} + 0.055e0) / 1.055e0, 2.4e0) END"


POINTS = f"""
    SELECT img, x, y, width, height, r, g, b AS blue,
           round((CASE WHEN fy > 0.008856e0 THEN 116e0 * cbrt(fy) - 16e0 ELSE 903.3e0 * fy END) * 2.55e0, 0) * (100e0 / 255e0) AS L,
           round(500e0 * (({_curve('fx')}) - ({_curve('fy')})), 0) AS a, round(200e0 * (({_curve('fy')}) - ({_curve('fz')})), 0) AS b
    FROM (SELECT *, (lr * 0.412453e0 + lg * 0.357580e0 + lb * 0.180423e0) / 0.950456e0 AS fx,
                    (lr * 0.212671e0 + lg * 0.715160e0 + lb * 0.072169e0) / 1.0e0 AS fy,
                    (lr * 0.019334e0 + lg * 0.119193e0 + lb * 0.950227e0) / 1.088754e0 AS fz
          FROM (SELECT *, {_linear('r')} AS lr, {_linear('g')} AS lg, {_linear('b')} AS lb FROM {{pixels}}))"""

ANCHORS = {n: K.anchor_lab(rgb) for n, rgb in K.ANCHORS.items()}
RAW = ", ".join(
    f"exp(-(pow(L - {l!r}e0, 2) + pow(a - {a!r}e0, 2) + pow(b - {b!r}e0, 2)) / 225e0) AS {n}" for n, (l, a, b) in ANCHORS.items()
)
WEIGHTS = f"""
    SELECT img, x, y, width, height, {', '.join(f'{n} / total AS {n}' for n in N)}
    FROM (SELECT *, {' + '.join(N)} + 1e-9 AS total FROM (SELECT img, x, y, width, height, {RAW} FROM ({POINTS})))"""


def cells_sql(grid: int) -> str:
    return f"""SELECT img, (y * {grid}) // height * {grid} + (x * {grid}) // width AS cell, {', '.join(f'avg({n}) AS {n}' for n in N)}
               FROM ({WEIGHTS}) GROUP BY ALL"""


def points(d):
    return palette.to_lab(d.pixels)


def fine(d):
    return palette.cell_sums(palette.membership(points(d)))


def coarse(d):
    return palette.coarser(fine(d))


def rounded(df, *, skip=("img", "cell", "brand", "class", "x", "y")):
    return df.select(*[F.round(c, 6).alias(c) if c not in skip else c for c in df.columns])


@query(
    "jn15_soft_membership",
    f"SELECT img, x, y, {', '.join(f'round({n}, 6) AS w_{n}' for n in N)} FROM ({WEIGHTS})",
)
def jn15(d):
    return rounded(palette.membership(points(d)).select("img", "x", "y", *[f"w_{n}" for n in N]))


@query(
    "ag24_grid_cells",
    f"SELECT img, cell, {', '.join(f'round({n}, 6) AS {n}' for n in N)} FROM ({cells_sql(4)})",
)
def ag24(d):
    return rounded(palette.pooled(coarse(d), grid=4))


SHARES = f"""
    SELECT * FROM (SELECT img, {', '.join(f'avg({n}) AS share_{n}' for n in N)} FROM ({WEIGHTS}) GROUP BY img)
    JOIN (SELECT img, {', '.join(f'max({n}) AS peak_{n}' for n in N)} FROM ({cells_sql(4)}) GROUP BY img) USING (img)"""


@query(
    "ag23_shares_and_peaks",
    f"SELECT img, {', '.join(f'round(share_{n}, 6) AS share_{n}, round(peak_{n}, 6) AS peak_{n}' for n in N)} FROM ({SHARES})",
)
def ag23(d):
    return rounded(palette.shares_and_peaks(coarse(d)))


@query(
    "ag26_palette_entropy",
    f"""SELECT img, round(-({' + '.join(f'share_{n} * ln(share_{n} + 1e-9)' for n in N)}) / {math.log(len(N))!r}e0, 6) AS palette_entropy
        FROM ({SHARES})""",
)
def ag26_entropy(d):
    return rounded(palette.palette_entropy(palette.shares_and_peaks(coarse(d))))


def _brand_sql(brand: str) -> str:
    proto, required = K.PROTOTYPES[brand], K.REQUIRED[brand]
    length = math.sqrt(sum(v * v for v in proto.values()))
    norm = "sqrt(" + " + ".join(f"share_{n} * share_{n}" for n in N) + ")"
    dot = " + ".join(f"share_{c} * {v}e0" for c, v in proto.items())
    logs = " + ".join(f"ln(peak_{c} + 1e-6)" for c in required)
    return f"""
      SELECT img, '{brand}' AS brand, coverage, coverage_peak, balance, similarity, cbrt(coverage_peak * balance * similarity) AS score FROM (
        SELECT s.img, {' + '.join(f'share_{c}' for c in proto)} AS coverage, c.m AS coverage_peak, exp(({logs}) / {len(required)}) AS balance,
               ({dot}) / ({norm} * {length!r}e0 + 1e-9) AS similarity
        FROM s JOIN (SELECT img, max({' + '.join(proto)}) AS m FROM k GROUP BY img) c USING (img))"""


@query(
    "ag25_brand_palettes",
    f"""WITH s AS MATERIALIZED ({SHARES}), k AS MATERIALIZED ({cells_sql(4)})
        SELECT img, brand, round(coverage, 6) AS coverage, round(coverage_peak, 6) AS coverage_peak, round(balance, 6) AS balance,
               round(similarity, 6) AS similarity, round(score, 6) AS score
        FROM ({' UNION ALL '.join(_brand_sql(b) for b in K.PROTOTYPES)})""",
)
def ag25(d):
    return rounded(palette.brand_metrics(coarse(d)))


def adjacency_sql(grid: int) -> str:
    greatest = f"greatest({', '.join(N)})"
    dominant = "CASE " + " ".join(f"WHEN {n} = {greatest} THEN {i}" for i, n in enumerate(N)) + " END"
    pairs = " UNION ALL ".join(
        f"SELECT '{brand}' AS brand, {N.index(a)} AS i, {N.index(b)} AS j" for brand, ps in K.PAIRS.items() for a, b in ps
    )
    return f"""
      WITH c AS MATERIALIZED ({cells_sql(grid)}), m AS (SELECT img, cell, {dominant} AS colour FROM c),
           e AS (SELECT a.img, a.colour AS p, b.colour AS q FROM m a JOIN m b ON a.img = b.img
                 AND ((b.cell = a.cell + 1 AND b.cell % {grid} <> 0) OR b.cell = a.cell + {grid})),
           s AS (SELECT img, brand, i, j, count(*) FILTER ((p = i AND q = j) OR (p = j AND q = i)) / count(*) AS share
                 FROM e, ({pairs}) GROUP BY ALL)
      SELECT img, brand, round(max(share), 6) AS adjacency FROM s GROUP BY img, brand"""


@query("ag27_adjacency_coarse", adjacency_sql(4))
def ag27(d):
    return rounded(palette.adjacency(coarse(d), grid=4))


@query("ag27_adjacency_fine", adjacency_sql(8))
def ag27_fine(d):
    return rounded(palette.adjacency(fine(d), grid=8))


@query(
    "ag26_image_statistics",
    f"""SELECT img, round(avg((sqrt(a * a + b * b) < 12)::INT), 6) AS achromatic, round(median(L) / 100, 6) AS lightness_median,
               round(stddev_pop(L) / 100, 6) AS lightness_spread, round(avg(sqrt(a * a + b * b)) / 100, 6) AS chroma
        FROM ({POINTS}) GROUP BY img""",
)
def ag26(d):
    return rounded(palette.image_statistics(points(d)))


@query(
    "ag26_colorfulness",
    """SELECT img, round((sqrt(var_pop(r - g) + var_pop(0.5e0 * (r + g) - b)) + 0.3e0 * sqrt(pow(avg(r - g), 2) + pow(avg(0.5e0 * (r + g) - b), 2))) / 100, 6)
              AS colorfulness FROM {pixels} GROUP BY img""",
)
def ag26_colour(d):
    return rounded(palette.colourfulness(d.pixels))


@query(
    "ag26_sharpness",
    """WITH l AS (SELECT img, v, coalesce(lag(v) OVER rx, lead(v) OVER rx) AS p1, coalesce(lead(v) OVER rx, lag(v) OVER rx) AS p2,
                         coalesce(lag(v) OVER ry, lead(v) OVER ry) AS p3, coalesce(lead(v) OVER ry, lag(v) OVER ry) AS p4
                  FROM (SELECT img, x, y, g::DOUBLE AS v FROM {pixels})
                  WINDOW rx AS (PARTITION BY img, y ORDER BY x), ry AS (PARTITION BY img, x ORDER BY y))
       SELECT img, round(log10(var_pop(p1 + p2 + p3 + p4 - 4 * v) + 1e-6), 6) AS sharpness FROM l GROUP BY img""",
)
def ag26_sharp(d):
    return rounded(palette.sharpness(d.pixels.select("img", "x", "y", F.col("g").cast("double").alias("v"))))


@query(
    "ag28_white_balance",
    """WITH i AS (SELECT img, pow(avg(pow(r + 1e0, 6)), 1e0 / 6) AS lr, pow(avg(pow(g + 1e0, 6)), 1e0 / 6) AS lg, pow(avg(pow(b + 1e0, 6)), 1e0 / 6) AS lb
                  FROM {pixels} GROUP BY img)
       SELECT p.img, x, y, width, height, round(least(255, (r + 1) * ((lr + lg + lb) / 3) / lr), 5) AS r,
              round(least(255, (g + 1) * ((lr + lg + lb) / 3) / lg), 5) AS g, round(least(255, (b + 1) * ((lr + lg + lb) / 3) / lb), 5) AS b
       FROM {pixels} p JOIN i USING (img)""",
)
def ag28(d):
    balanced = palette.white_balance(d.pixels)
    return balanced.withColumns({c: F.round(c, 5) for c in ("r", "g", "b")})


@query(
    "ag28_stretched_lightness",
    f"""WITH p AS ({POINTS}), e AS (SELECT img, quantile_cont(L, 0.02) AS lo, quantile_cont(L, 0.98) AS hi FROM p GROUP BY img)
        SELECT p.img, x, y, round(CASE WHEN hi - lo < 1 THEN L ELSE greatest(0, least(100, (L - lo) / (hi - lo) * 90 + 5)) END, 9) AS "L"
        FROM p JOIN e USING (img)""",
)
def ag28_stretch(d):
    return palette.stretch_lightness(points(d)).select("img", "x", "y", F.round("L", 9).alias("L"))


@query(
    "flt08_generic_features",
    f"""SELECT img, name, round(value, 6) AS value FROM (UNPIVOT ({SHARES}) ON COLUMNS(* EXCLUDE img) INTO NAME name VALUE value)
        WHERE starts_with(name, 'share_') OR starts_with(name, 'peak_')""",
)
def flt08(d):
    wide = palette.shares_and_peaks(coarse(d))
    cover = palette.brand_metrics(coarse(d)).select("img", F.concat("brand", F.lit("_score")).alias("name"), F.col("score").alias("value"))
    long = wide.unpivot("img", [c for c in wide.columns if c != "img"], "name", "value").unionByName(cover)
    return palette.generic_features(long).withColumn("value", F.round("value", 6))


BALANCED = """
    SELECT p.img, x, y, width, height, floor(greatest(0, least(255, (r + 1e0) * ((lr + lg + lb) / 3) / lr))::FLOAT)::INT AS r,
           floor(greatest(0, least(255, (g + 1e0) * ((lr + lg + lb) / 3) / lg))::FLOAT)::INT AS g,
           floor(greatest(0, least(255, (b + 1e0) * ((lr + lg + lb) / 3) / lb))::FLOAT)::INT AS b
    FROM {pixels} p JOIN (SELECT img, pow(avg(pow(r + 1e0, 6)), 1e0 / 6) AS lr, pow(avg(pow(g + 1e0, 6)), 1e0 / 6) AS lg,
                                 pow(avg(pow(b + 1e0, 6)), 1e0 / 6) AS lb FROM {pixels} GROUP BY img) i USING (img)"""
STRETCHED = """
    SELECT plain.* REPLACE (CASE WHEN hi - lo < 1 THEN L ELSE greatest(0, least(100, (L - lo) / (hi - lo) * 90 + 5)) END AS L)
    FROM plain JOIN (SELECT img, quantile_cont(L, 0.02) AS lo, quantile_cont(L, 0.98) AS hi FROM plain GROUP BY img) USING (img)"""


def _features_sql() -> str:
    """All colour features, from the same pieces as the single measurements, over balanced and stretched points."""
    over = lambda text: text.replace(POINTS, "stretched")
    brands = " UNION ALL ".join(_brand_sql(b) for b in K.PROTOTYPES)
    measures = [f"max({m}) FILTER (brand = '{b}') AS {b}_{m}" for b in K.PROTOTYPES for m in palette.BRAND_MEASURES]
    beside = {g: ", ".join(f"max(adjacency) FILTER (brand = '{b}') AS {b}_adjacency_{g}" for b in K.PAIRS) for g in ("coarse", "fine")}
    shown = ", ".join(f"round({n}::FLOAT::DOUBLE, 4) AS {n}" for n in palette.feature_names())
    return f"""
      WITH balanced AS MATERIALIZED ({BALANCED}), plain AS MATERIALIZED ({POINTS.replace("{pixels}", "balanced")}),
           stretched AS MATERIALIZED ({STRETCHED}), s AS MATERIALIZED ({over(SHARES)}), k AS MATERIALIZED ({over(cells_sql(4))}),
           stats AS (SELECT img, avg((sqrt(a * a + b * b) < 12)::INT) AS achromatic, median(L) / 100 AS lightness_median,
                            stddev_pop(L) / 100 AS lightness_spread, avg(sqrt(a * a + b * b)) / 100 AS chroma FROM plain GROUP BY img),
           colour AS (SELECT img, (sqrt(var_pop(r - g) + var_pop(0.5e0 * (r + g) - b)) + 0.3e0 * sqrt(pow(avg(r - g), 2) + pow(avg(0.5e0 * (r + g) - b), 2)))
                                  / 100 AS colorfulness FROM {{pixels}} GROUP BY img),
           entropy AS (SELECT img, -({' + '.join(f'share_{n} * ln(share_{n} + 1e-9)' for n in N)}) / {math.log(len(N))!r}e0 AS palette_entropy FROM s),
           brands AS (SELECT img, {', '.join(measures)} FROM ({brands}) GROUP BY img),
           near AS (SELECT img, {beside["coarse"]} FROM ({over(adjacency_sql(4))}) GROUP BY img),
           nearer AS (SELECT img, {beside["fine"]} FROM ({over(adjacency_sql(8))}) GROUP BY img)
      SELECT img, {len(palette.feature_names())} AS dims, {shown}
      FROM s JOIN stats USING (img) JOIN colour USING (img) JOIN entropy USING (img) JOIN brands USING (img) JOIN near USING (img) JOIN nearer USING (img)"""


@query("ag26_colour_features", _features_sql())
def colour_features(d):
    named = palette.colour_features(d.pixels)
    return named.select("img", F.size("values").alias("dims"), *[F.round(F.col("values")[i].cast("double"), 4).alias(n) for i, n in enumerate(palette.feature_names())])


def resampled_sql(source: str, new_width: str, new_height: str, channels: str) -> str:
    """Area means: every pixel meets the target cells it overlaps, by the length they share on both axes."""
    means = ", ".join(f"round_even(sum(wx * wy * {c}) / max(w * h), 0)::INT AS {c}" for c in channels)
    return f"""
      SELECT img, tx AS x, ty AS y, max(nw) AS width, max(nh) AS height, {means}
      FROM (SELECT *, least((x + 1) * nw, (tx + 1) * w) - greatest(x * nw, tx * w) AS wx, least((y + 1) * nh, (ty + 1) * h) - greatest(y * nh, ty * h) AS wy
            FROM (SELECT *, unnest(range(y * nh // h, ((y + 1) * nh - 1) // h + 1)) AS ty
                  FROM (SELECT *, unnest(range(x * nw // w, ((x + 1) * nw - 1) // w + 1)) AS tx
                        FROM (SELECT * EXCLUDE (width, height), width::BIGINT AS w, height::BIGINT AS h, ({new_width})::BIGINT AS nw,
                                     ({new_height})::BIGINT AS nh FROM {source}))))
      GROUP BY img, tx, ty"""


_FIT = "greatest(1, round_even({} * least(1e0, 160e0 / greatest(width, height)), 0))"


@query(
    "ag26_resampled_pixels",
    f"""SELECT img, y, max(width) AS width, max(height) AS height, count(*) AS cells, sum(r)::BIGINT AS r, sum(g * (x + 1))::BIGINT AS g, sum(b * b)::BIGINT AS b
        FROM ({resampled_sql("{pictures}", _FIT.format("width"), _FIT.format("height"), "rgb")}) GROUP BY img, y""",
)
def resampled(d):
    """Sums of every row of the resampled pictures."""
    rows = resample.shrunk(d.pictures, palette.WORK_SIDE).groupBy("img", F.col("y").cast("long").alias("y"))
    return rows.agg(
        F.max("width").cast("long").alias("width"), F.max("height").cast("long").alias("height"), F.count("*").alias("cells"),
        F.sum("r").alias("r"), F.sum(F.col("g") * (F.col("x") + 1)).alias("g"), F.sum(F.col("b") * F.col("b")).alias("b"),
    )


def shortcut_sql(source: str) -> str:
    grey = f"(SELECT img, x, y, width, height, round(0.299e0 * r + 0.587e0 * g + 0.114e0 * b, 0)::INT AS v FROM {source})"
    return f"""
      WITH p AS MATERIALIZED ({resampled_sql(grey, "128", "128", "v")}),
           l AS (SELECT img, v, coalesce(lag(v) OVER rx, lead(v) OVER rx) AS p1, coalesce(lead(v) OVER rx, lag(v) OVER rx) AS p2,
                        coalesce(lag(v) OVER ry, lead(v) OVER ry) AS p3, coalesce(lead(v) OVER ry, lag(v) OVER ry) AS p4 FROM p
                 WINDOW rx AS (PARTITION BY img, y ORDER BY x), ry AS (PARTITION BY img, x ORDER BY y)),
           sizes AS (SELECT img, max(width) AS w, max(height) AS h FROM {source} GROUP BY img)
      SELECT img, round(log10(w)::FLOAT::DOUBLE, 4) AS log_width, round(log10(h)::FLOAT::DOUBLE, 4) AS log_height, round((w / h)::FLOAT::DOUBLE, 4) AS aspect,
             round(log10(w * h)::FLOAT::DOUBLE, 4) AS log_area, round(log10(var_pop(p1 + p2 + p3 + p4 - 4 * v) + 1e-6)::FLOAT::DOUBLE, 4) AS sharpness
      FROM l JOIN sizes USING (img) GROUP BY img, w, h"""


def _shortcuts(pixels):
    values = [F.round(F.col("values")[i].cast("double"), 4).alias(n) for i, n in enumerate(palette.SHORTCUTS)]
    return palette.shortcut_features(pixels).select("img", *values)


@query("prj20_shortcut_features", shortcut_sql("{pixels}"))
def shortcut(d):
    return _shortcuts(d.pixels)


@query("prj20_shortcuts_of_pictures", shortcut_sql("{pictures}"))
def shortcut_of_pictures(d):
    return _shortcuts(d.pictures)


HEAD = {"beeline": [0.5, -0.25, 0.125, 0.75], "megafon": [-0.5, 0.5, -0.125, 0.25], "tele2": [-1.0, -1.0, -1.0, -1.0]}


@query(
    "ag29_attribution_map",
    f"""WITH c AS (SELECT vec_id AS img, cell, list_transform(embedding[cell * 4 + 1:cell * 4 + 4], lambda x: x::DOUBLE) AS f
                   FROM {{embeddings}}, range(16) t(cell)),
             v AS (SELECT img, cell, class, greatest(0, f[1] * w[1]::DOUBLE + f[2] * w[2]::DOUBLE + f[3] * w[3]::DOUBLE + f[4] * w[4]::DOUBLE) AS v FROM c, (VALUES
                   {', '.join(f"('{k}', {v})" for k, v in HEAD.items())}) h(class, w)),
             p AS (SELECT *, max(v) OVER (PARTITION BY img, class) AS peak FROM v)
        SELECT img, class, cell, round(CASE WHEN peak > 0 THEN v / peak ELSE v END, 6) AS weight FROM p""",
)
def ag29(d):
    at = F.explode(F.sequence(F.lit(0), F.lit(15).cast("bigint"))).alias("cell")
    cells = d.embeddings.select(F.col("vec_id").alias("img"), "embedding", at)
    part = F.transform(F.slice("embedding", (F.col("cell") * 4 + 1).cast("int"), F.lit(4)), lambda v: v.cast("double"))
    shown = palette.attribution(cells.select("img", "cell", part.alias("features")), HEAD)
    return rounded(shown)
