import math
import pickle
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewright.functions import colour as K
from framewright.operators import nearest, palette, resample


def _vectors(seed, n=150, d=8, copies=60):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, d))
    near = base[:5].repeat(copies // 5, axis=0) + rng.normal(scale=0.02, size=(copies // 5 * 5, d))
    exact = base[[3] * 10]
    return [(i, [float(x) for x in v]) for i, v in enumerate(np.vstack([base, near, exact]).astype(np.float32))]


def _pairs(rows, t):
    m = np.array([v for _, v in rows], dtype=np.float64)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    i, j = np.nonzero(np.triu(m @ m.T >= t, 1))
    return set(zip(i.tolist(), j.tolist(), strict=True))


def _groups(n, pairs):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in range(n)}


@pytest.mark.parametrize("threshold", [0.97, 0.6])
def test_pairs_and_groups_are_exact(frame, threshold):
    rows = _vectors(1)
    df = frame(rows, "id int, vector array<float>")
    want = _pairs(rows, threshold)
    # blocks far smaller than a cell, so that cells split
    got = [(r["id_a"], r["id_b"]) for r in nearest.similar_pairs(df, threshold=threshold, block=16).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    groups = {r["id"]: r["group"] for r in nearest.duplicate_groups(df, threshold=threshold, block=16).collect()}
    assert groups == _groups(len(rows), want)


def test_near_copies_group_and_strangers_stay_alone(frame):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(3)]
    rows.append((3, (np.array(rows[0][1]) + 0.001).tolist()))
    groups = nearest.duplicate_groups(frame(rows, "id int, vector array<float>"))
    assert {r["id"]: r["group"] for r in groups.collect()} == {0: 0, 1: 1, 2: 2, 3: 0}
    assert tuple(nearest.group_totals(groups).first()) == (4, 3, 1, 1)


def test_vectors_without_structure_meet_in_few_slices(frame, monkeypatch):
    rng = np.random.default_rng(9)
    rows = [(f"v{i:03d}", v.tolist()) for i, v in enumerate(rng.normal(size=(400, 24)).astype(np.float32))]
    df, want = frame(rows, "id string, vector array<float>"), {(rows[i][0], rows[j][0]) for i, j in _pairs(rows, 0.4)}
    monkeypatch.setattr(nearest, "_placed", None)  # no pivot prunes anything here: a copy for every cell would be sent
    got = [(r["id_a"], r["id_b"]) for r in nearest.similar_pairs(df, threshold=0.4, block=40).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    names = _groups(len(rows), _pairs(rows, 0.4))
    groups = {r["id"]: r["group"] for r in nearest.duplicate_groups(df, threshold=0.4, block=40).collect()}
    assert groups == {rows[i][0]: rows[g][0] for i, g in names.items()}


def test_slices_are_few_and_cells_are_kept_where_they_prune():
    rng = np.random.default_rng(4)
    stranger = nearest.PivotTree(rng.normal(size=(700, 64)).astype(np.float32), math.sqrt(1.2))
    assert [nearest._slices(stranger, n, 2048) for n in (2_000, 50_000, 490_000)] == [1, 12, 12]
    crowds = rng.normal(size=(700, 64)).astype(np.float32)
    assert nearest._slices(nearest.PivotTree(crowds, math.sqrt(2 - 2 * 0.97)), 490_000, 2048) == 0


def test_few_copies_of_each_vector_are_placed(frame):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(40, 64))
    rows = [(i, (centres[i % 40] + 0.02 * rng.normal(size=64)).tolist()) for i in range(2000)]
    spread = nearest._spread(frame(rows, "id int, vector array<double>"), len(rows))
    _, tree = nearest._pivots(spread, len(rows), 0.97, 0)
    distance = np.sqrt(np.maximum(0, 2 - 2 * nearest._unit([r[1] for r in rows]) @ nearest._unit(tree.vectors).T))
    by_reach = (distance <= distance.min(axis=1)[:, None] + 2 * np.sqrt(2 - 2 * 0.97)).sum()
    # crowds that hold a pivot stay with it; only vectors far from every pivot go to several cells
    assert nearest._placed(spread, tree, 0.97).count() < 0.95 * by_reach


def test_the_pivot_tree_meets_every_pair_once():
    rng = np.random.default_rng(3)
    base = rng.normal(size=(400, 12))
    unit = nearest._unit(np.vstack([base, base[:200] + rng.normal(scale=0.1, size=(200, 12)), base[:3], base[:3]]))
    for pivots, threshold in [(1, 0.9), (2, 0.9), (40, 0.97), (90, 0.6), (200, 0.9)]:
        tree = nearest.PivotTree(np.vstack([unit[:pivots], unit[:2]]), math.sqrt(2 - 2 * threshold))
        homes, visits = {}, defaultdict(set)
        for rows, cells, home, _ in tree.place(unit):
            for row, cell, own in zip(rows.tolist(), cells.tolist(), home.tolist()):
                visits[cell].add(row)
                if own:
                    assert row not in homes
                    homes[row] = cell
        assert len(homes) == len(unit)
        i, j = np.nonzero(np.triu(unit @ unit.T >= threshold, 1))
        assert all(b in visits[homes[a]] and a in visits[homes[b]] for a, b in zip(i.tolist(), j.tolist()))


@pytest.mark.parametrize("width", [64, 768])
def test_what_a_task_gets_stays_small_at_ten_million_vectors(width):
    wanted = min(nearest.PIVOT_BYTES // (width * 4), math.isqrt(10_000_000))
    tree = nearest.PivotTree(np.random.default_rng(0).normal(size=(wanted, width)).astype(np.float32), 0.2)
    assert len(pickle.dumps(tree)) < 10_000_000
    for rows in (10**9, 10**12):
        assert min(nearest.PIVOT_BYTES // (width * 4), math.isqrt(rows)) * width * 4 <= nearest.PIVOT_BYTES


def test_components_of_chains_stars_and_loops(frame):
    rng = random.Random(2)
    pairs = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 40)] + [(200, 200), (201, 202), (202, 201)]
    rng.shuffle(pairs)
    ids = sorted({x for p in pairs for x in p} | {999})
    got = {r["id"]: r["group"] for r in nearest.components(frame([(i,) for i in ids], "id int"), frame(pairs, "u int, v int")).collect()}
    want = {i: (0 if i <= 30 else 100 if i < 200 else 201 if i in (201, 202) else i) for i in ids}
    assert got == want


def flat(frame, colours, side=16):
    """Image 1: left half one colour, right half another."""
    left, right = colours[0], colours[-1]
    rows = [(1, x, y, side, side, *(left if x < side // 2 else right)) for x in range(side) for y in range(side)]
    return frame(rows, "img int, x int, y int, width int, height int, r int, g int, b int")


def _lab(rgb):
    return K.anchor_lab(rgb)


def test_lab_of_known_colours(frame):
    for rgb in ((0, 0, 0), (255, 255, 255), (255, 0, 0), (20, 50, 140)):
        row = palette.to_lab(flat(frame, [rgb], side=2)).first()
        assert (row["L"], row["a"], row["b"]) == pytest.approx(_lab(rgb), abs=1e-9)
    assert _lab((255, 255, 255))[0] == pytest.approx(100.0)


def test_membership_sums_to_one_and_prefers_its_anchor(frame):
    for name, rgb in K.ANCHORS.items():
        row = palette.membership(palette.to_lab(flat(frame, [rgb], side=2))).first()
        weights = {n: row[f"w_{n}"] for n in palette.NAMES}
        assert sum(weights.values()) == pytest.approx(1.0)
        assert max(weights, key=weights.get) == name


def _measure(frame, colours):
    cells = palette.cell_sums(palette.membership(palette.to_lab(flat(frame, colours))))
    coarse = palette.coarser(cells)
    brands = {r["brand"]: r for r in palette.brand_metrics(coarse).collect()}
    near = {r["brand"]: r["adjacency"] for r in palette.adjacency(coarse, grid=4).collect()}
    return brands, near, palette.shares_and_peaks(coarse).first()


def test_palette_signal_needs_both_colours(frame):
    both, near, shares = _measure(frame, [K.ANCHORS["yellow"], K.ANCHORS["black"]])
    black, none, _ = _measure(frame, [K.ANCHORS["black"]])
    assert both["beeline"]["score"] > 3 * black["beeline"]["score"]
    assert both["beeline"]["score"] > both["megafon"]["score"]
    assert near["beeline"] == pytest.approx(4 / 24) and none["beeline"] == 0.0
    assert shares["share_yellow"] == pytest.approx(0.5, abs=0.01) and shares["peak_yellow"] == pytest.approx(1.0, abs=0.01)


def test_empty_cells_are_zero(frame):
    cells = palette.cell_sums(palette.membership(palette.to_lab(flat(frame, [(20, 20, 20)], side=2))), grid=4)
    rows = palette.pooled(cells, grid=4).collect()
    assert len(rows) == 16 and sum(r["black"] > 0 for r in rows) == 4


def test_white_balance_takes_out_a_cast(frame):
    warm = flat(frame, [(240, 200, 150), (120, 100, 75)])
    row = palette.white_balance(warm).filter("x = 0 and y = 0").first()
    assert max(row["r"], row["g"], row["b"]) - min(row["r"], row["g"], row["b"]) < 8


def test_lightness_stretch_and_flat_images(frame):
    pts = palette.to_lab(flat(frame, [(60, 60, 60), (180, 180, 180)]))
    row = palette.stretch_lightness(pts).agg(F.min("L"), F.max("L")).first()
    assert tuple(row) == pytest.approx((5.0, 95.0))
    same = palette.to_lab(flat(frame, [(60, 60, 60)]))
    assert palette.stretch_lightness(same).agg(F.max("L")).first()[0] == pytest.approx(_lab((60, 60, 60))[0])


def test_sharpness_equals_a_direct_laplacian(frame):
    rng = np.random.default_rng(3)
    grey = rng.integers(0, 255, size=(5, 7)).astype(float)
    padded = np.pad(grey, 1, mode="reflect")
    laplace = padded[:-2, 1:-1] + padded[2:, 1:-1] + padded[1:-1, :-2] + padded[1:-1, 2:] - 4 * grey
    rows = [(1, x, y, float(grey[y, x])) for y in range(5) for x in range(7)]
    got = palette.sharpness(frame(rows, "img int, x int, y int, v double")).first()["sharpness"]
    assert got == pytest.approx(math.log10(laplace.var() + 1e-6))


def test_colourfulness_uses_the_right_channels(frame):
    red = palette.colourfulness(flat(frame, [(255, 0, 0)])).first()["colorfulness"]
    assert red == pytest.approx(0.3 * math.hypot(255, 127.5) / 100)


def test_attribution_is_bounded_and_zero_maps_stay_zero(frame):
    cells = frame([(1, c, [float(c), 1.0]) for c in range(4)], "img int, cell int, features array<double>")
    rows = defaultdict(dict)
    for r in palette.attribution(cells, {"up": [1.0, -1.0], "never": [-1.0, -1.0]}).collect():
        rows[r["class"]][r["cell"]] = r["weight"]
    assert rows["up"] == {0: 0.0, 1: 0.0, 2: 0.5, 3: 1.0} and set(rows["never"].values()) == {0.0}


def test_generic_features_know_no_brand(frame):
    df = frame([(1, n, 0.0) for n in ("share_red", "peak_red", "chroma", "palette_entropy", "beeline_score", "lightness_median")], "img int, name string, value double")
    assert {r["name"] for r in palette.generic_features(df).collect()} == {"share_red", "peak_red", "chroma", "palette_entropy", "lightness_median"}


def _by_hand(pixels):
    """Colour features of one image, step by step."""
    side = pixels.shape[0]
    data = pixels.astype(float) + 1.0
    light = np.power(np.power(data, 6).mean(axis=(0, 1)), 1 / 6)
    even = np.floor(np.clip(data * (light.mean() / light), 0, 255)).astype(int)
    plain = np.array([[_lab(tuple(int(c) for c in even[y, x])) for x in range(side)] for y in range(side)])
    low, high = np.percentile(plain[..., 0], (2, 98))
    wide = plain.copy()
    if high - low >= 1:
        wide[..., 0] = np.clip((plain[..., 0] - low) / (high - low) * 90 + 5, 0, 100)
    anchors = np.array([_lab(rgb) for rgb in K.ANCHORS.values()])
    weight = np.exp(-(np.linalg.norm(wide[:, :, None, :] - anchors, axis=3) / K.KERNEL_SIGMA) ** 2)
    weight /= weight.sum(axis=2, keepdims=True) + 1e-9
    pooled = lambda g: weight.reshape(g, side // g, g, side // g, -1).mean(axis=(1, 3)).reshape(g * g, -1)
    shares, coarse = weight.mean(axis=(0, 1)), pooled(4)
    peaks, chroma = coarse.max(axis=0), np.linalg.norm(plain[..., 1:], axis=2)
    red, green, blue = (pixels[..., i].astype(float) for i in range(3))
    rg, yb = red - green, 0.5 * (red + green) - blue
    out = dict(zip([f"share_{n}" for n in palette.NAMES], shares)) | dict(zip([f"peak_{n}" for n in palette.NAMES], peaks))
    out["achromatic"] = (chroma < 12).mean()
    out["lightness_median"], out["lightness_spread"] = np.median(plain[..., 0]) / 100, plain[..., 0].std() / 100
    out["chroma"] = chroma.mean() / 100
    out["colorfulness"] = (math.hypot(rg.std(), yb.std()) + 0.3 * math.hypot(rg.mean(), yb.mean())) / 100
    out["palette_entropy"] = -(shares * np.log(shares + 1e-9)).sum() / math.log(len(shares))
    at = {n: i for i, n in enumerate(palette.NAMES)}
    for brand, proto in K.PROTOTYPES.items():
        cols = [at[n] for n in proto]
        target = np.zeros(len(at))
        target[cols] = list(proto.values())
        out[f"{brand}_coverage"], out[f"{brand}_coverage_peak"] = shares[cols].sum(), coarse[:, cols].sum(axis=1).max()
        out[f"{brand}_balance"] = np.exp(np.log(peaks[[at[n] for n in K.REQUIRED[brand]]] + 1e-6).mean())
        out[f"{brand}_similarity"] = shares @ target / (np.linalg.norm(shares) * np.linalg.norm(target) + 1e-9)
        out[f"{brand}_score"] = np.cbrt(out[f"{brand}_coverage_peak"] * out[f"{brand}_balance"] * out[f"{brand}_similarity"])
    for brand, pairs in K.PAIRS.items():
        for name, grid in (("coarse", 4), ("fine", 8)):
            top = pooled(grid).argmax(axis=1).reshape(grid, grid)
            edges = [(top[y, x], top[y, x + 1]) for y in range(grid) for x in range(grid - 1)]
            edges += [(top[y, x], top[y + 1, x]) for y in range(grid - 1) for x in range(grid)]
            out[f"{brand}_adjacency_{name}"] = max(sum({a, b} == {at[p], at[q]} for a, b in edges) / len(edges) for p, q in pairs)
    return [out[n] for n in palette.feature_names()]


def test_colour_features_equal_the_steps_by_hand(frame):
    rng = np.random.default_rng(5)
    colours = np.array(list(K.ANCHORS.values()))
    images = {}
    for img in (1, 2):
        blocks = colours[rng.integers(0, len(colours), size=(8, 8))].repeat(2, axis=0).repeat(2, axis=1)
        images[img] = np.clip(blocks + rng.integers(-15, 15, size=blocks.shape), 0, 255)
    rows = [(i, x, y, 16, 16, *map(int, p[y, x])) for i, p in images.items() for y in range(16) for x in range(16)]
    df = frame(rows, "img int, x int, y int, width int, height int, r int, g int, b int")
    for r in palette.colour_features(df).collect():
        assert r["values"] == pytest.approx(_by_hand(images[r["img"]]), abs=1e-5)


def test_standard_arms_cover_controls(frame):
    from framewright.plans.classification import standard_arms

    rows = frame([(1, [1.0, 2.0, 3.0], [0.0])], "id int, color array<double>, visual array<double>")
    out, arms = standard_arms(rows, {"visual": ["v"], "color": ["share_red", "beeline_score", "chroma"], "shortcut": ["a"]})
    assert out.first()["color_generic"] == [1.0, 3.0]
    assert arms["visual+color, no brands"] == {"visual": 1, "color_generic": 2} and arms["shortcut"] == {"shortcut": 1}


def test_area_sums_travel_by_target_row(spark, capsys):
    rng = np.random.default_rng(5)
    rows, want = [], {}
    for img, (h, w) in (("a", (7, 23)), ("b", (31, 9)), (None, (3, 3))):
        pixels = rng.integers(0, 256, (h, w))
        rows += [(img, x, y, w, h, int(pixels[y, x])) for y in range(h) for x in range(w)]
        new_w, new_h = min(w, 8), min(h, 8)
        shared = [[[max(0, min((t + 1) * own, (c + 1) * new) - max(t * own, c * new)) for c in range(own)] for t in range(new)] for own, new in ((w, new_w), (h, new_h))]
        total = np.array(shared[1]) @ pixels @ np.array(shared[0]).T
        want |= {(img, x, y): (int(total[y, x]), w * h) for y in range(new_h) for x in range(new_w)}
    rng.shuffle(order := np.arange(len(rows)))
    pixels = spark.createDataFrame([rows[i] for i in order], "img string, x int, y int, width int, height int, v int").repartition(5)
    got = resample.area_sums(pixels, F.least("width", F.lit(8)), F.least("height", F.lit(8)), channels=["v"], whole={"n": F.lit(1).cast("long")})
    cells = got.collect()
    assert {(r["img"], r["x"], r["y"]): (r["v"], r["v"] and r["own_width"] * r["own_height"]) for r in cells} == want and len(cells) == len(want)
    assert sum(r["n"] for r in cells) == len(rows)
    got.explain()
    assert "Generate" not in capsys.readouterr().out  # no row for each pixel and cell


def test_area_sums_of_packed_pixels_equal_the_plain_sum(spark, frame, monkeypatch):
    monkeypatch.setattr(resample, "BLOCK", 4)
    monkeypatch.setattr(resample, "RUNS_AT_ONCE", 3)
    rng = np.random.default_rng(7)
    sizes = {1: (30, 23), 2: (70, 9), 3: (6, 5), 4: (19, 40), None: (12, 33)}  # some shrink little, some much, one not at all
    rows = [(i, x, y, w, h, int(v)) for i, (w, h) in sizes.items() for y in range(h) for x in range(w) for v in [rng.integers(0, 256)]]
    rows = [r for r in rows if rng.random() > 0.03]  # some are missing, some come twice
    rows += [rows[int(i)] for i in rng.integers(0, len(rows), 40)] + [(1, 2, 3, 30, 23, 70_000), (1, 2, 4, 30, 23, -5)]
    want = {}
    for i, x, y, w, h, v in rows:
        nw, nh = min(w, 17), min(h, 19)
        for tx in range(x * nw // w, ((x + 1) * nw - 1) // w + 1):
            for ty in range(y * nh // h, ((y + 1) * nh - 1) // h + 1):
                share = (min((x + 1) * nw, (tx + 1) * w) - max(x * nw, tx * w)) * (min((y + 1) * nh, (ty + 1) * h) - max(y * nh, ty * h))
                want[i, tx, ty] = want.get((i, tx, ty), 0) + share * v
    rng.shuffle(rows)
    pixels = frame([tuple(None if c is None else int(c) for c in r) for r in rows], "img int, x int, y int, width int, height int, v int").repartition(3)
    got = resample.area_sums(pixels, F.least("width", F.lit(17)), F.least("height", F.lit(19)), channels=["v"]).collect()
    assert {(r["img"], r["x"], r["y"]): r["v"] for r in got} == want and len(got) == len(want)


def test_pixels_of_pictures_that_shrink_little_travel_as_bytes():
    import pyarrow as pa

    place = np.arange(192 * 52)
    columns = {"img": np.zeros(len(place), np.int64), "x": place % 192, "y": place // 192, "width": 0 * place + 192, "height": 0 * place + 900}
    columns |= {"_new_w": 0 * place + 34, "_new_h": 0 * place + 160, "r": place % 256, "g": place % 255}
    for new_w, new_h, most in ((160, 750, 2.2), (34, 160, 2.2)):
        columns |= {"_new_w": 0 * place + new_w, "_new_h": 0 * place + new_h}
        sent = list(resample._runs_of_pixels(["r", "g"])(iter([pa.record_batch({k: pa.array(v) for k, v in columns.items()})])))
        assert sum(len(b) for s in sent for c in ("r", "g") for b in s[c].to_pylist()) < most * len(place)
