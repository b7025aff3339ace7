import random

from pyspark.sql import functions as F

from framewright.functions.decimals import fixed, rounded
from framewright.operators import boxes, greedy, reports, review
from framewright.plans import detection

BOX = "box_id string, file string, index int, center_x double, center_y double, width double, height double, confidence double"


def box(i, file, index=0, conf=0.9):
    return (str(i), file, index, 0.5, 0.5, 0.2, 0.2, conf)


def case(frame):
    frames = frame([(f"{c}.jpg", 100, 100) for c in "abcde"], "file string, width int, height int")
    found = frame([box(1, "a.jpg"), box(2, "b.jpg"), box(3, "b.jpg", 1), box(4, "c.jpg"), box(5, "d.jpg"), box(6, "d.jpg", 1)], BOX)
    answers = frame(
        [("1", "ad_surface", 1), ("2", "ad_surface", 1), ("3", "building", 1), ("4", "road_sign", 1), ("5", "ad_surface", 1), ("6", "ad_surface", 1)],
        "box_id string, category string, answered_at bigint",
    )
    verdicts = frame([("6", "keep", 1), ("6", "disputed", 2)], "box_id string, verdict string, given_at bigint")
    return frames, found, answers, verdicts


def test_fates_of_frames(frame):
    out = detection.apply_verdicts(*case(frame))
    fates = {r["file"][0]: (r["status"], r["boxes_before"], r["boxes_after"]) for r in out["fates"].collect()}
    assert fates == {"a": ("clean", 1, 1), "b": ("fixed", 2, 1), "c": ("negative", 1, 0), "d": ("disputed", 2, 0), "e": ("no_boxes", 0, 0)}
    lines = {(r["file"][0], r["line"]) for r in out["lines"].collect()}
    good = "0 0.500000 0.500000 0.200000 0.200000"
    assert lines == {("a", good), ("b", good), ("c", None)}
    assert sorted(r["file"] for r in out["queue"].collect()) == ["d.jpg", "e.jpg"]
    assert out["disputed"].count() == 2


def test_stride_turns_boxless_frames_into_negatives(frame):
    frames, found, answers, verdicts = case(frame)
    out = detection.apply_verdicts(frames, found, answers, verdicts, empty_stride=1)
    assert {r["file"]: r["status"] for r in out["fates"].collect()}["e.jpg"] == "negative"
    assert [r["file"] for r in out["queue"].collect()] == ["d.jpg"]


def test_human_word_beats_the_model_and_the_last_answer_counts(frame):
    found = frame([box(1, "a.jpg"), box(2, "a.jpg"), box(3, "a.jpg"), box(4, "a.jpg")], BOX)
    answers = frame([("1", "building", 1), ("2", "building", 1), ("2", "ad_surface", 2), ("4", "error", 1)], "box_id string, category string, answered_at bigint")
    verdicts = frame([("1", "drop", 1), ("1", "keep", 2), ("2", "", 1)], "box_id string, verdict string, given_at bigint")
    fate = lambda **kw: {r["box_id"]: r["fate"] for r in review.settle_boxes(found, answers, verdicts, **kw).collect()}
    assert fate() == {"1": "keep", "2": "keep", "3": "disputed", "4": "disputed"}
    assert fate(error_as_unanswered=False)["4"] == "drop"


def test_export_replaces_whole_frames(frame):
    out = detection.apply_verdicts(*case(frame))
    export = frame([("d", "0 .5 .5 .1 .1\n\n0 .2 .2 .1 .1\n"), ("e", "\n")], "stem string, text string")
    old = frame([("a", "old"), ("d", "old")], "stem string, text string")
    done = detection.import_export(out["fates"], old, out["queue"], export)
    fates = {r["file"][0]: (r["status"], r["boxes_after"]) for r in done["fates"].collect()}
    assert fates["d"] == ("from_export", 2) and fates["e"] == ("negative", 0) and fates["a"] == ("clean", 1)
    assert done["queue"].count() == 0
    assert {r["stem"]: r["text"][0] for r in done["labels"].collect()} == {"a": "o", "d": "0", "e": "\n"}
    assert tuple(done["totals"].first()) == (2, 2, 1)


def test_status_thresholds_and_review_order(frame):
    frames = frame([(f, 10, 10) for f in ("ok.jpg", "weak1.jpg", "weak2.jpg", "empty.jpg")], "file string, width int, height int")
    found = frame([box(1, "ok.jpg", conf=0.5), box(2, "weak1.jpg", conf=0.45), box(3, "weak2.jpg", conf=0.26), box(4, "weak2.jpg", conf=0.9)], BOX)
    report = reports.frame_report(frames, found)
    assert {r["file"]: r["status"] for r in report.collect()} == {"ok.jpg": "ok", "weak1.jpg": "weak", "weak2.jpg": "weak", "empty.jpg": "empty"}
    queue = reports.bundles(reports.review_queue(report), size=2).orderBy("position").collect()
    assert [(r["file"], r["part"]) for r in queue] == [("empty.jpg", 1), ("weak2.jpg", 1), ("weak1.jpg", 2)]


def _iou(a, b):
    dx = max(0.0, min(a[0] + a[2] / 2, b[0] + b[2] / 2) - max(a[0] - a[2] / 2, b[0] - b[2] / 2))
    dy = max(0.0, min(a[1] + a[3] / 2, b[1] + b[3] / 2) - max(a[1] - a[3] / 2, b[1] - b[3] / 2))
    union = a[2] * a[3] + b[2] * b[3] - dx * dy
    return dx * dy / union if union else 0.0


def _random_boxes(rng, n, files):
    rows = []
    for i in range(n):
        w, h = rng.choice([(0.2, 0.2), (0.21, 0.19), (rng.uniform(0.01, 0.6), rng.uniform(0.01, 0.6)), (0.0, 0.1)])
        rows.append((f"{i:05d}", f"f{rng.randrange(files)}", rng.uniform(0.3, 0.5), rng.uniform(0.3, 0.5), w, h, round(rng.random(), 4)))
    return rows


SCAN = "id string, file string, cx double, cy double, w double, h double, confidence double"


def test_overlap_pairs_equal_all_pairs(frame):
    rng = random.Random(1)
    left, right = _random_boxes(rng, 250, 3), _random_boxes(rng, 250, 3)
    for t in (0.3, 0.5, 0.6, 0.9):
        want = {(a[0], b[0]) for a in left for b in right if a[1] == b[1] and _iou(a[2:6], b[2:6]) >= t}
        got = [(r["left_id"], r["right_id"]) for r in boxes.overlap_pairs(frame(left, SCAN), frame(right, SCAN), iou_min=t).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_merged_scans_equal_the_loop(frame):
    rng = random.Random(2)
    base, extra = _random_boxes(rng, 60, 3), _random_boxes(rng, 240, 3)
    extra += [(f"{900 + i}", *extra[i][1:]) for i in range(20)]  # exact twins
    extra = [("x" + e[0], *e[1:]) for e in extra]
    kept, want = list(base), []
    for e in sorted(extra):
        if not any(k[1] == e[1] and _iou(e[2:6], k[2:6]) >= 0.6 for k in kept):
            kept.append(e)
            want.append(e[0])
    got = boxes.merge_scans(frame(base, SCAN), frame(extra, SCAN)).collect()
    assert sorted(r["id"] for r in got) == want


def test_merge_adds_only_new_boxes_and_continues_numbers(frame):
    first = frame([("1", "a.jpg", 0.5, 0.5, 0.2, 0.2, 0.9)], SCAN)
    second = frame([("s1", "a.jpg", 0.505, 0.5, 0.2, 0.2, 0.8), ("s2", "a.jpg", 0.1, 0.1, 0.1, 0.1, 0.7)], SCAN)
    fresh = boxes.merge_scans(first, second)
    assert [r["id"] for r in fresh.collect()] == ["s2"]
    numbered = boxes.number_boxes(first.select("file", "id"), ["id"])
    more = boxes.number_boxes(fresh.select("file", "id"), ["id"], after=numbered).first()
    assert (more["number"], more["index"]) == (2, 1)


def test_long_chains_of_overlaps_take_few_rounds(frame, monkeypatch):
    calls = []
    monkeypatch.setattr(greedy, "pin", lambda df, pin=greedy.pin: calls.append(1) or pin(df))
    # each box overlaps the next only
    rows = [(f"e{i:04d}", "a", 0.1 * i, 0.5, 0.4, 0.4, 0.9) for i in range(300)]
    kept = sorted(r["id"] for r in boxes.merge_scans(frame(rows[:0], SCAN), frame(rows, SCAN), iou_min=0.55).collect())
    assert kept == [f"e{i:04d}" for i in range(0, 300, 2)] and len(calls) <= 20


def test_conflicts_in_small_blocks_equal_the_loop(frame):
    for seed, (ids, edges) in enumerate([(60, 150), (200, 220), (300, 2000)]):
        rng = random.Random(seed)
        pairs = {tuple(sorted(rng.sample(range(ids), 2))) for _ in range(edges)} | {(i, i + 1) for i in range(0, ids - 1, 1 + seed)}
        lost = set()
        for later in range(ids):
            if any(e not in lost for e, at in pairs if at == later):
                lost.add(later)
        df = frame([(f"b{a:04d}", f"b{b:04d}") for a, b in pairs], "earlier string, later string")
        for block in (24, 10_000):
            assert sorted(r["id"] for r in greedy.beaten(df, block=block).collect()) == sorted(f"b{i:04d}" for i in lost)


def test_conflicts_of_one_row_are_not_cut_in_two(frame):
    # b loses to a, x to c alone, so y stays; a block that ends between (b, x) and (c, x) must not take x for a winner
    links = [(f"{i:03d}{a}", f"{i:03d}{b}") for i in range(60) for a, b in ("ab", "bx", "cx", "xy")]
    df = frame(links, "earlier string, later string")
    for block in (5, 7):
        assert sorted(r["id"] for r in greedy.beaten(df, block=block).collect()) == sorted(f"{i:03d}{k}" for i in range(60) for k in "bx")


def test_merge_compares_areas_at_the_threshold(frame):
    def box(name, p, s, q):  # as the scans of the catalog have them
        return name, "a.jpg", 0.15 + p % 71 / 101, 0.2 + s % 59 / 103, 0.05 + q / 180, 0.07 + p % 13 / 47, 0.9

    for p, s, wide, slim, enough in [(0, 0, 11, 3, True), (461, 57, 36, 18, True)]:
        got = boxes.merge_scans(frame([box("f", p, s, wide)], SCAN), frame([box("o", p, s, slim)], SCAN)).collect()
        assert len(got) == (0 if enough else 1)


def test_merged_scan_continues_numbers_and_indexes(frame):
    base = frame([(1, "a.jpg", 0, 0.5, 0.5, 0.2, 0.2, 0.9), (2, "b.jpg", 3, 0.5, 0.5, 0.2, 0.2, 0.9)], "number int, file string, index int, cx double, cy double, w double, h double, confidence double")
    extra = frame([("s1", "a.jpg", 0.505, 0.5, 0.2, 0.2, 0.8), ("s2", "c.jpg", 0.1, 0.1, 0.1, 0.1, 0.7), ("s3", "b.jpg", 0.1, 0.1, 0.1, 0.1, 0.6), ("s4", "c.jpg", 0.8, 0.8, 0.1, 0.1, 0.5)], SCAN)
    got = [(r["number"], r["file"], r["index"], r["added"]) for r in boxes.merged_scan(base, extra).orderBy("number").collect()]
    assert got == [(1, "a.jpg", 0, False), (2, "b.jpg", 3, False), (3, "c.jpg", 0, True), (4, "b.jpg", 4, True), (5, "c.jpg", 1, True)]
    alone = boxes.merged_scan(base.limit(0), extra).orderBy("number").collect()
    assert [(r["number"], r["index"]) for r in alone] == [(1, 0), (2, 0), (3, 0), (4, 1)]


def test_quality_tells_confidences_apart_beyond_four_decimals(frame):
    truth = frame([("t", "a", 0.5, 0.5, 0.2, 0.2, 0.0)], SCAN).withColumn("split", F.lit("test"))
    rows = [("p1", "a", 0.1, 0.5, 0.2, 0.2, 0.500001), ("p2", "a", 0.5, 0.5, 0.2, 0.2, 0.500002)]
    row = boxes.detection_quality(frame(rows, SCAN).withColumn("split", F.lit("test")), truth, part="split").first()
    assert row["ap50"] == 1.0 and row["precision"] == 1.0


def test_detection_quality_of_perfect_and_useless_predictions(frame):
    truth = frame([("t1", "a", 0.5, 0.5, 0.2, 0.2, 0.0), ("t2", "b", 0.5, 0.5, 0.2, 0.2, 0.0)], SCAN).withColumn("split", F.lit("test"))
    same = truth.withColumn("id", F.concat(F.lit("p"), "id")).withColumn("confidence", F.lit(0.9))
    row = boxes.detection_quality(same, truth, part="split").first()
    assert (row["ap50"], row["map"], row["precision"], row["recall"]) == (1.0, 1.0, 1.0, 1.0)
    one_wrong = same.withColumn("cx", F.when(F.col("id") == "pt1", 0.1).otherwise(F.col("cx")))
    row = boxes.detection_quality(one_wrong, truth, part="split").first()
    assert row["ap50"] == 0.25 and row["recall"] == 0.5


def test_a_truth_honours_its_most_confident_claim(frame):
    truth = frame([("t", "a", 0.5, 0.5, 0.2, 0.2, 0.0)], SCAN)
    twice = frame([("p1", "a", 0.5, 0.5, 0.2, 0.2, 0.6), ("p2", "a", 0.51, 0.5, 0.2, 0.2, 0.9)], SCAN)
    hits = boxes.matched_detections(twice, truth, steps=(0.5,)).collect()
    assert [r["id"] for r in hits] == ["p2"]


def test_scan_numbers_boxes_and_names_crops(frame):
    frames = frame([("b.jpg", 100, 50, 1.0), ("a.jpg", 100, 50, 2.0)], "file string, width int, height int, n double")

    def make():
        return lambda batch: [[(0.0, 0.0, 50.0, 25.0, 0.3 + 0.1 * k) for k in range(int(n))] + [(0, 0, 1, 1, 0.1)] for n in batch]

    got = detection.scan(frames, make, "n").orderBy("number").collect()
    assert [(r["number"], r["file"], r["index"], r["crop"]) for r in got] == [(1, "a.jpg", 0, "a__0.jpg"), (2, "a.jpg", 1, "a__1.jpg"), (3, "b.jpg", 0, "b__0.jpg")]
    assert (got[0]["cx"], got[0]["w"]) == (0.25, 0.5) and abs(got[0]["confidence"] - 0.4) < 1e-9


def test_review_is_stored_from_kept_rows(spark, frame, tmp_path):
    out = detection.apply_verdicts(*case(frame))
    for name in ("settled", "fates"):  # five writes read them: no join or sum may run again in each
        plan = out[name]._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "Aggregate" not in plan
    detection.store_review(out, str(tmp_path))
    read = lambda part: sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/{part}").select("file", "index").collect())
    assert read("labels") == [("a.jpg", 0), ("b.jpg", 0), ("c.jpg", None)]
    assert read("disputed") == sorted((r["file"], r["index"]) for r in out["disputed"].collect())


def test_fixed_texts_equal_the_formatter(frame):
    values = [0.0, -0.0, 1e-9, -1e-9, 5e-7, 1.5e-6, 0.125, 0.045, 1 / 3, 999999.9999995, 1e6, 2.5e9, -3.25, None]
    df = frame([(v,) for v in values], "v double")
    for n in (0, 2, 4, 6, 8):
        plain = F.format_string(f"%.{n}f", rounded(F.col("v"), n))
        assert df.filter(~fixed(F.col("v"), n).eqNullSafe(plain)).count() == 0
