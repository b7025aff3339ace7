import json

import pytest
from pyspark.sql import functions as F

from framewright import schemas as C
from framewright.operators import scoring
from framewright.plans import classification

RUN = "file string, truth string, brand string, decided string, basis string"


def run(frame, rows):
    return frame([(f, t, d, d, "name_read") for f, t, d in rows], RUN)


def test_false_positives_go_to_the_named_brand(frame):
    rows = [("1", "mts", "mts"), ("2", "mts", "tele2"), ("3", "other", "mts"), ("4", "other", "unclear"), ("5", "mts", "other")]
    card = {r["name"]: (r["hits"], r["total"], r["false_positives"]) for r in scoring.scorecard(run(frame, rows), C.TARGETS).collect()}
    assert card["mts"] == (1, 3, 1) and card["tele2"] == (0, 0, 1) and card["other"] == (0, 2, 0)
    assert tuple(scoring.score_totals(run(frame, rows), C.TARGETS).first()) == (1, 5, 2)


def test_comparison_marks_and_uncommon_files(frame):
    before = run(frame, [("1", "mts", "mts"), ("2", "mts", "other"), ("3", "mts", "tele2"), ("9", "mts", "mts")])
    after = run(frame, [("1", "mts", "other"), ("2", "mts", "mts"), ("3", "mts", "volna"), ("8", "mts", "mts")])
    out = classification.compare(before, after)
    assert {r["file"]: r["mark"] for r in out["changes"].collect()} == {"1": "broken", "2": "fixed", "3": "still_wrong"}
    assert tuple(out["coverage"].first()) == (3, 4, 4)
    mts = out["brands"].filter("name = 'mts'").first()
    assert (mts["hits_before"], mts["hits_after"], mts["total_before"], mts["shift"]) == (1, 1, 3, 0)


def test_precision_and_recall_without_cases_are_null(frame):
    row = scoring.precision_recall(run(frame, [("1", "other", "other")]), C.TARGETS).first()
    assert row["precision"] is None and row["recall"] is None


def test_macro_f1_counts_classes_never_hit(frame):
    rows = frame([(0, "a", "a"), (0, "a", "b"), (0, "c", "a")], "fold int, truth string, guess string")
    # a: 2*1/(2+2) = 0.5, b: 0, c: 0
    assert scoring.macro_f1(rows, ["fold"]).first()["f1"] == pytest.approx(0.5 / 3)


def test_confusion_keeps_all_classes(frame):
    rows = frame([("beeline", "other"), ("beeline", "beeline")], "truth string, guess string")
    table = {r["truth"]: r for r in scoring.confusion(rows, C.HEAD_CLASSES).collect()}
    assert table["beeline"]["right_share"] == 0.5 and table["tele2"]["other"] == 0 and len(table) == 4


def test_arm_summary_pairs_folds(frame):
    rows = [("base", 0, 0, 0.5), ("base", 0, 1, 0.7), ("new", 0, 0, 0.6), ("new", 0, 1, 0.8), ("shortcut", 0, 0, 0.9), ("shortcut", 0, 1, 0.9)]
    out = {r["arm"]: r for r in scoring.arm_summary(frame(rows, "arm string, repeat int, fold int, f1 double"), "base").collect()}
    assert out["new"]["gain"] == pytest.approx(0.1) and out["new"]["gain_spread"] == pytest.approx(0.0)
    assert out["base"]["spread"] == pytest.approx(0.1) and out["shortcut"]["suspicious"] and not out["new"]["suspicious"]


def test_truth_by_file_or_stem(frame):
    answers = frame([("a.jpg",), ("b.jpg",), ("c.jpg",)], "file string")
    truth = frame([("a.jpg", "volna", 1), ("a.jpg", "mts", 2), ("b", "tele2", 1), ("c.jpg", "", 1), ("c", "volna", 1)], "file string, brand string, listed_at int")
    got = {r["file"]: r["truth"] for r in scoring.with_truth(answers, truth).collect()}
    assert got == {"a.jpg": "mts", "b.jpg": "tele2", "c.jpg": "volna"}


def test_answers_of_a_run_with_failures(frame):
    frames = frame([("a.jpg", "МТС тариф"), ("b.jpg", "boom"), ("c.jpg", "пусто")], "file string, content string")

    def make():
        def ask(text):
            if text == "boom":
                raise RuntimeError("HTTP 500")
            return json.dumps({"brand": "mts", "basis": "name_read", "visible_text": text, "evidence": ""})

        return ask

    truth = frame([("a", "mts", 1), ("c", "mts", 1)], "file string, brand string, listed_at int")
    rows = classification.answer(frames, truth, make, "content", probe=lambda: True, sessions=2)
    got = {r["file"]: (r["decided"], r["verdict"], r["truth"], r["error"]) for r in rows.collect()}
    assert got == {"a.jpg": ("mts", "confirmed", "mts", ""), "b.jpg": ("unclear", "confirmed", "", "HTTP 500"), "c.jpg": ("unclear", "review", "mts", "")}
    report = classification.score(rows)
    assert tuple(report["accuracy"].first())[:3] == (2, 1, 2)
    with pytest.raises(ConnectionError):
        classification.answer(frames, truth, make, "content", probe=lambda: False)


def test_probe_takes_hard_negatives_whole(frame):
    rows = [(f"h{i}.jpg", "other", "Сбер") for i in range(7)] + [(f"s{i}.jpg", "other", "щиты с улицы") for i in range(9)]
    rows += [(f"o{i}.jpg", "other", "разное") for i in range(30)] + [(f"m{i}.jpg", "mts", "") for i in range(9)]
    got = classification.probe(frame(rows, "file string, brand string, source string"), street=4, random_other=5, per_brand=3)
    counts = {r["source"]: r["n"] for r in got.groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert counts == {"Сбер": 7, "щиты с улицы": 4, "разное": 5, "mts": 3}
    assert got.filter("source = 'щиты с улицы'").first()["file"].startswith("щиты_с_улицы__s")
