import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from framewright.operators import audit, greedy, pool, ranking, scenes, splits
from framewright.plans import detection
from framewright.session import shared_folder


def test_ranks_do_not_depend_on_partitioning(frame, partitions):
    rng = random.Random(3)
    rows = [(f"k{i:04d}", "hot" if rng.random() < 0.5 else f"g{rng.randrange(30)}", rng.randrange(20)) for i in range(600)]
    df = frame(rows, "key string, g string, v int")
    one, seven = partitions(lambda: ranking.shuffled_rank(df, "key", groups=["g"], seed=1).select("key", "rank", "rank_of"))
    assert one == seven
    by_group = defaultdict(list)
    group = {r[0]: r[1] for r in rows}
    for key, rank, size in one:
        by_group[group[key]].append((rank, size))
    for members in by_group.values():
        assert sorted(r for r, _ in members) == list(range(1, len(members) + 1))
        assert {s for _, s in members} == {len(members)}
    one, seven = partitions(lambda: ranking.ordered_rank(df, ["v", "key"], groups=["g"]).select("key", "rank"))
    assert one == seven
    want = {}
    for g in {r[1] for r in rows}:
        for n, r in enumerate(sorted((r[2], r[0]) for r in rows if r[1] == g), 1):
            want[r[1]] = n
    assert dict(one) == want
    one, seven = partitions(lambda: ranking.ordered_rank(df, ["v", "key"]).select("key", "rank"))
    assert one == seven == sorted((r[0], n) for n, r in enumerate(sorted(rows, key=lambda r: (r[2], r[0])), 1))


def _loop(rows):
    stems, marks, kept = set(), set(), []
    for at, stem, mark in sorted(rows):
        if stem not in stems and mark not in marks:
            stems.add(stem)
            marks.add(mark)
            kept.append(at)
    return kept


def test_first_wins_equals_the_loop(frame):
    for seed in range(3):
        rng = random.Random(seed)
        rows = [(i, f"s{rng.randrange(40)}", "hot" if rng.random() < 0.3 else f"m{rng.randrange(40)}") for i in range(120)]
        df = frame(rows, "at int, stem string, mark string")
        got = sorted(r["at"] for r in pool.first_wins(df, ["at"], ["stem", "mark"]).collect())
        assert got == _loop(rows)


def test_first_wins_in_small_blocks_equals_the_loop(spark, frame):
    for seed in range(3):
        rng = random.Random(seed)
        rows = [(i, f"s{rng.randrange(60)}" if rng.random() < 0.9 else None, "hot" if rng.random() < 0.3 else f"m{rng.randrange(60)}") for i in range(200)]
        shared_folder(spark)
        df = frame([(i, i, *row[1:]) for i, row in enumerate(rows)], "at int, _no long, stem string, mark string").checkpoint()
        got = sorted(r["_no"] for r in greedy.first_numbers(df, ["stem", "mark"], block=16).collect())
        taken, kept = set(), []
        for at, stem, mark in rows:
            own = {(0, stem), (1, mark)} - {(0, None)}
            if not own & taken:
                taken |= own
                kept.append(at)
        assert got == kept


def test_a_chain_of_100_000_rows_on_a_hot_key(spark, monkeypatch):
    # the last link of the chain holds the key of a third of the table
    calls = []
    monkeypatch.setattr(greedy, "pin", lambda df, pin=greedy.pin: calls.append(1) or pin(df))
    n = 100_000
    at = F.col("id")
    link = lambda k: F.concat(F.lit(k), F.when(at < n, F.floor((at + int(k == "a")) / 2)).otherwise(-at).cast("string"))
    rows = spark.range(n * 3 // 2).select(at.alias("at"), F.when(at >= n - 1, "hot").otherwise(link("a")).alias("stem"), link("b").alias("mark"))
    shared_folder(spark)
    placed = rows.withColumn("_no", F.col("at")).checkpoint()
    got = greedy.first_numbers(placed, ["stem", "mark"], block=20_000)
    # rows 0, 2, … of the chain stay; row n - 1 loses, so the first row behind the chain takes the hot key
    assert got.filter("_no < 100000 AND _no % 2 = 1").count() == 0
    assert got.filter("_no < 100000").count() == n // 2 and [r[0] for r in got.filter("_no >= 100000").collect()] == [n]
    assert len(calls) <= 40


def test_a_dropped_row_reserves_nothing(frame):
    df = frame([(1, "a", "x"), (2, "a", "y"), (3, "b", "y")], "at int, stem string, mark string")
    assert sorted(r["at"] for r in pool.first_wins(df, ["at"], ["stem", "mark"]).collect()) == [1, 3]


def test_three_valued_labels_survive_the_join(frame):
    images = frame([("x/a.jpg",), ("x/b.jpg",), ("x/c.jpg",), ("y/a.jpg",)], "path string")
    labels = frame([("a", "0 1 1 1 1"), ("b", "")], "stem string, text string")
    got = {r["stem"]: (r["path"], r["text"]) for r in pool.labelled_samples(images, labels).collect()}
    assert got == {"a": ("y/a.jpg", "0 1 1 1 1"), "b": ("x/b.jpg", "")}
    neg = {r["stem"]: r["text"] for r in pool.labelled_samples(images, labels, negative_source=True).collect()}
    assert neg == {"a": "0 1 1 1 1", "b": "", "c": ""}


def test_thinning_keeps_filled_frames(frame):
    rows = [(f"v_{i:02d}", "0 1" if i % 4 == 0 else " \n") for i in range(20)] + [("w_1", "")]
    df = frame(rows, "stem string, text string")
    got = {r["stem"] for r in pool.thin_negatives(df, stride=5, prefix="v_").collect()}
    empties = [s for s, t in rows if s.startswith("v_") and not t.strip()]
    assert got == {s for s, t in rows if t.strip()} | set(empties[4::5])
    assert pool.thin_negatives(df, stride=1, prefix="v_").count() == 20


def _sizes(n, sv, st):
    v, t = max(1, round(n * sv)), max(1, round(n * st))
    while v + t >= n:
        if t >= v:
            t -= 1
        else:
            v -= 1
    return v, t


def test_part_sizes_equal_the_shrinking_loop(spark):
    for sv, st in ((0.15, 0.15), (0.5, 0.5), (0.9, 0.1), (0.2, 0.7), (0.6, 0.6)):
        v, t = splits.part_sizes(F.col("id"), sv, st)
        for r in spark.range(3, 80).select("id", v.alias("v"), t.alias("t")).collect():
            assert (r["v"], r["t"]) == _sizes(r["id"], sv, st), (r, sv, st)


def test_split_properties(frame, partitions):
    rows = [(f"video_{i:03d}.jpg", "0 1") for i in range(30)] + [(f"video_{i:03d}.jpg", "") for i in range(30, 40)]
    rows += [(f"stock_{i}.jpg", "0 1") for i in range(20)] + [("rare_1.jpg", "0 1"), ("rare_2.jpg", "0 1")]
    df = frame(rows, "file string, text string")
    none = df.limit(0)
    one, seven = partitions(lambda: detection.build(df, none).filter("split <> 'test_handmade'").select("file", "split"))
    assert one == seven
    part = dict(one)
    assert len(part) == len(rows)
    assert part["rare_1.jpg"] == part["rare_2.jpg"] == "train"
    seen = Counter((part[f].strip(), f.split("_")[0], bool(t)) for f, t in rows)
    for stratum in (("video", True), ("video", False), ("stock", True)):
        assert all(seen[(p, *stratum)] > 0 for p in ("train", "val", "test"))
    other = {r["file"]: r["split"] for r in detection.build(df, none, seed=1).filter("split <> 'test_handmade'").collect()}
    assert other != part


def test_shared_photos_and_box_totals(frame):
    images = frame([("train", "a.jpg", b"x"), ("val", "b.jpg", b"x"), ("val", "c.jpg", b"x"), ("test", "d.jpg", b"y")], "split string, name string, content binary")
    photos = audit.shared_photos(audit.digests(images)).collect()
    assert [(r["members"], r["parts"]) for r in photos] == [(3, {"train": 1, "val": 2})]
    labels = frame([("train", "a.txt", "0 1 1 1 1\n"), ("train", "orphan.txt", "0 1 1 1 1\n0 2 2 2 2")], "split string, name string, text string")
    found = audit.findings(images, labels)
    counts = {r["kind"]: r["findings"] for r in audit.finding_counts(found).collect()}
    assert counts["same_photo_in_two_splits"] == 1 and found.filter("kind = 'same_photo_in_two_splits'").count() == 3
    totals = {r["split"]: (r["boxes"], r["frames"], r["mean_boxes"]) for r in audit.box_totals(images, labels).collect()}
    assert totals == {"train": (1, 1, 1.0), "val": (0, 2, 0.0), "test": (0, 1, 0.0)}


def test_long_chains_of_keys_take_few_rounds(frame, monkeypatch):
    calls = []
    monkeypatch.setattr(greedy, "pin", lambda df, pin=greedy.pin: calls.append(1) or pin(df))
    # row i shares a key with row i - 1 and another with row i + 1
    rows = [(i, f"a{(i + 1) // 2}", f"b{i // 2}") for i in range(1000)] + [(2000, None, None), (2001, None, "b0")]
    got = sorted(r["at"] for r in pool.first_wins(frame(rows, "at int, stem string, mark string"), ["at"], ["stem", "mark"]).collect())
    assert got == [*range(0, 1000, 2), 2000] and len(calls) <= 20


def test_copies_follow_their_original(frame):
    df = frame([("1.webp", "train"), ("truck_1.jpg", "val"), ("truck_1_aug.jpg", "train"), ("truckaug_1.jpg", "test"), ("lone_aug.jpg", "test")], "file string, split string")
    got = {r["file"]: r["split"] for r in splits.follow_originals(df).collect()}
    assert got == {"1.webp": "train", "truck_1.jpg": "val", "truck_1_aug.jpg": "val", "truckaug_1.jpg": "val", "lone_aug.jpg": "test"}


def _scenes(rows, gap):
    out, by = {}, defaultdict(list)
    for rec, sec, file in rows:
        by[rec].append((sec, file))
    for rec, items in by.items():
        scene, previous = 0, None
        for sec, file in sorted(items):
            if previous is None or sec - previous >= gap:
                scene += 1
            out[file], previous = (rec, scene), sec
    return out


def test_scene_numbers_equal_the_loop(frame):
    rng = random.Random(5)
    rows = [(rng.randrange(3), round(rng.uniform(0, 500), 1), f"f{i}") for i in range(200)]
    rows += [(9, float(s), f"g{s}") for s in (0, 5, 10, 14)]
    df = frame(rows, "recording int, seconds double, file string")
    for gap in (5.0, 2.0, 60.0):
        want = _scenes(rows, gap)
        for span in (1.0, 7.0, 10_000.0):
            got = {r["file"]: (r["recording"], r["scene"]) for r in scenes.number_scenes(df, gap=gap, span=span).collect()}
            assert got == want


def test_handmade_keeps_scenes_whole_and_copies_in_train(frame):
    rows = [(f"frame_{i * 25:06d}_t{i:05d}.000.jpg", i % 3) for i in range(1, 90)]
    rows += [(f"photo_{i:03d}.jpg", 1) for i in range(60)] + [(f"photo_{i:03d}_aug.jpg", 1) for i in range(60)]
    out = detection.handmade(frame(rows, "file string, n_boxes int"), gap=1.0)
    parts = defaultdict(set)
    for r in out["split"].collect():
        parts[r["scene_key"]].add(r["split"])
        assert r["split"] == "train" or not r["file"].endswith("_aug.jpg")
    assert all(len(p) == 1 for p in parts.values())
    assert sum(r["train"] + r["val"] + r["test"] for r in out["tally"].collect()) == out["split"].count()


def test_group_folds_never_cut_a_group(frame):
    rng = random.Random(8)
    rows = [(i, rng.randrange(60), rng.randrange(4)) for i in range(400)]
    folded = splits.group_folds(frame(rows, "id int, g int, label int"), group="g", label="label", key="id", folds=5).collect()
    where, classes = defaultdict(set), defaultdict(Counter)
    for r in folded:
        where[r["g"]].add(r["fold"])
        classes[r["label"]][r["fold"]] += 1
    assert len(folded) == 400 and all(len(f) == 1 for f in where.values())
    assert {f for fs in where.values() for f in fs} == set(range(5))


def test_group_sample_respects_limits(frame):
    rows = [(f"{g}{i}", g) for g, n in (("a", 50), ("b", 3), ("c", 9), ("d", 9)) for i in range(n)]
    got = Counter(r["g"] for r in splits.sample_groups(frame(rows, "file string, g string"), group="g", key="file", limits={"a": 10, "b": 10, "c": 0}).collect())
    assert got == {"a": 10, "b": 3, "c": 9}


def test_blinding_is_a_permutation_with_a_key(frame):
    files = frame([(f"f{i}.JPG",) for i in range(50)], "file string")
    tables = [("b", frame([("f1.JPG", "late")], "file string, brand string")), ("a", frame([("f1.JPG", "early", "q")], "file string, brand string, quality string"))]
    rows = splits.blind(files, tables).collect()
    assert {r["file"] for r in rows} == {f"img_{i:04d}.jpg" for i in range(1, 51)}
    known = {r["original"]: r for r in rows}
    assert known["f1.JPG"]["brand"] == "early" and known["f1.JPG"]["quality"] == "q" and known["f2.JPG"]["brand"] == ""
    assert [r["original"] for r in sorted(rows)] != sorted(r["original"] for r in rows)


IMAGES = "split string, name string, content binary, readable boolean"


def _set(frame, images, labels):
    return audit.findings(frame(images, IMAGES), frame(labels, "split string, name string, text string"))


def test_clean_set_has_no_findings(frame):
    images = [(s, f"{s}{i}.jpg", f"{s}{i}".encode(), True) for s in ("train", "val", "test") for i in range(2)]
    labels = [(s, f"{s}{i}.txt", "0 0.5 0.5 0.2 0.2\n") for s in ("train", "val", "test") for i in range(2)]
    found = _set(frame, images, labels)
    assert found.count() == 0
    assert all(r["findings"] == 0 and r["clean"] for r in audit.finding_counts(found).collect())


def test_every_kind_of_finding(frame):
    images = [("train", "a.jpg", b"same", True), ("val", "b.jpg", b"same", True), ("val", "a.jpg", b"else", True), ("train", "lone.jpg", b"q", True), ("train", "dead.jpg", None, None), ("train", "blur.jpg", b"z", False)]
    bad = "0 0.5 0.5\n0 x 0.5 0.1 0.1\n0 1.5 0.5 0.1 0.1\n\n0 0.5 0.5 0.0 0.1\n1 0.5 0.5 0.1 0.1\n"
    labels = [("train", "a.txt", bad), ("val", "b.txt", ""), ("val", "a.txt", ""), ("train", "blur.txt", ""), ("val", "orphan.txt", "")]
    found = _set(frame, images, labels)
    got = Counter(r["kind"] for r in found.collect())
    assert got == {
        "bad_line": 3, "out_of_range": 1, "degenerate": 1, "same_photo_in_two_splits": 2, "name_in_two_splits": 1,
        "missing_label": 1, "broken_link": 1, "unreadable": 1, "missing_image": 1, "empty_split": 1,
    }
    items = {r["item"] for r in found.filter("kind = 'bad_line'").collect()}
    assert items == {"train/a.jpg:1", "train/a.jpg:2", "train/a.jpg:6 class 1"}
    assert not audit.finding_counts(found).first()["clean"]


def test_build_multi_has_no_leaks(frame):
    rng = random.Random(4)

    def source(name, n, labels=True, tag=None):
        images = [(f"{name}/{(tag or name)}_{i:03d}.jpg", f"c{rng.randrange(60)}") for i in range(n)]
        stems = [(p.split("/")[1][:-4], "0 1" if i % 3 else "") for i, (p, _) in enumerate(images)]
        return detection.Source(name, frame(images, "path string, content_key string"), frame(stems, "stem string, text string") if labels else None)

    out = detection.build_multi([source("a", 40), source("b", 40, tag="a"), source("n", 20, labels=False)], source("h", 10))
    rows = [r for r in out["split"].collect() if r["split"] != "holdout"]
    assert len({r["stem"] for r in rows}) == len(rows) and len({r["content_key"] for r in rows}) == len(rows)
    counts = {r["split"]: r["frames"] for r in out["counts"].collect()}
    assert counts["holdout"] == 10 and sum(counts.values()) == len(rows) + 10
    assert {r["source"] for r in out["by_source"].collect()} == {"a", "b", "n", "h"}


def test_names_that_many_rows_share_are_not_paired(frame, monkeypatch, capsys):
    monkeypatch.setattr(audit, "REPEATS", 7)
    images = frame([("train", "a.jpg", f"{i}") for i in range(40)] + [("train", "b.jpg", "b"), ("val", "a.jpg", None)], "split string, name string, content string")
    labels = frame([("train", "a.txt", "0 x")] * 20 + [("train", "a.txt", "1 0.5 0.5 0.1 0.1")] * 10 + [("test", "c.txt", "")], "split string, name string, text string")
    read = []
    monkeypatch.setattr(audit, "line_findings", lambda texts, found=audit.line_findings, **kw: read.append(texts) or found(texts, **kw))
    found = {(r["kind"], r["item"]): r["n"] for r in audit.findings(images, labels).groupBy("kind", "item").agg(F.count("*").alias("n")).collect()}
    assert found == {
        ("bad_line", "train/a.jpg:1"): 800, ("bad_line", "train/a.jpg:1 class 1"): 400, ("missing_label", "train/b.jpg"): 1, ("missing_image", "test/c.txt"): 1,
        ("broken_link", "val/a.jpg"): 1, ("name_in_two_splits", "a.jpg"): 1, ("empty_split", "test"): 1,
    }
    assert read[0].count() == 2  # not 1,200
    audit.unpaired(images, labels).explain()
    assert "FullOuter" not in capsys.readouterr().out
