import os
import struct
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from framewright import schemas as C
from framewright.operators import heads, inference, many_heads
from framewright.session import scratch_path
from framewright.sources import feature_store, files, sinks
from framewright.sources import tree as trees
from framewright.streaming import live


def png(pixels: np.ndarray) -> bytes:
    """Smallest PNG writer: grey, RGB or RGBA rows."""
    height, width = pixels.shape[:2]
    channels = 1 if pixels.ndim == 2 else pixels.shape[2]
    raw = b"".join(b"\0" + pixels[y].astype(np.uint8).tobytes() for y in range(height))
    head = struct.pack(">IIBBBBB", width, height, 8, {1: 0, 3: 2, 4: 6}[channels], 0, 0, 0)
    part = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", head) + part(b"IDAT", zlib.compress(raw)) + part(b"IEND", b"")


@pytest.fixture
def tree(tmp_path):
    """Images and labels in folders: a colour, a grey, a transparent and a broken one."""
    red = np.zeros((2, 3, 3))
    red[..., 0] = 200
    clear = np.zeros((2, 2, 4))
    (tmp_path / "mts" / "street").mkdir(parents=True)
    (tmp_path / "other").mkdir()
    (tmp_path / "mts" / "red.PNG").write_bytes(png(red))
    (tmp_path / "mts" / "street" / "clear.png").write_bytes(png(clear))
    (tmp_path / "other" / "grey.png").write_bytes(png(np.full((2, 2), 90)))
    (tmp_path / "other" / "broken.jpg").write_bytes(b"no image")
    (tmp_path / "other" / "notes.md").write_text("x")
    (tmp_path / "other" / "grey.txt").write_text("0 0.5 0.5 0.1 0.1\n")
    (tmp_path / "mts" / "red.txt").write_text("")
    return str(tmp_path)


def test_listing_by_suffix(spark, tree):
    listed = files.list_images(spark, tree, recursive=True)
    assert sorted((r["file"], r["stem"], r["suffix"]) for r in listed.collect()) == [
        ("broken.jpg", "broken", "jpg"), ("clear.png", "clear", "png"), ("grey.png", "grey", "png"), ("red.PNG", "red", "png"),
    ]
    assert files.list_images(spark, f"{tree}/mts").count() == 1
    assert "content" not in listed._jdf.queryExecution().optimizedPlan().toString().split("Relation")[0]
    with pytest.raises(FileNotFoundError):
        files.list_images(spark, f"{tree}/nowhere")


def test_decoding_flags_and_blends(spark, tree):
    images = files.read_images(spark, tree)
    ok = {os.path.basename(r["path"]): r["readable"] for r in images.collect()}
    assert ok == {"red.PNG": True, "clear.png": True, "grey.png": True, "broken.jpg": False}
    pixels = files.image_pixels(images)
    name = F.substring_index("img", "/", -1).alias("name")
    got = {r["name"]: (r["r"], r["g"], r["b"], r["n"]) for r in pixels.groupBy(name, "r", "g", "b").agg(F.count("*").alias("n")).collect()}
    assert got == {"red.PNG": (200, 0, 0, 6), "clear.png": (255, 255, 255, 4), "grey.png": (90, 90, 90, 4)}


def test_labels_exports_and_class_folders(spark, tree):
    labels = {r["stem"]: r["text"] for r in files.read_label_files(spark, tree).collect()}
    assert labels == {"grey": "0 0.5 0.5 0.1 0.1\n", "red": ""}
    pairs = files.read_annotation_export(spark, tree)
    assert sorted((r["stem"], r["handmade"]) for r in pairs.collect()) == [("grey", True), ("red", True)]
    rows = files.read_class_folders(spark, tree, ["mts", "other"])
    assert sorted((r["id"], r["brand"], r["source"]) for r in rows.collect())[:2] == [("mts/red.PNG", "mts", ""), ("mts/street/clear.png", "mts", "street")]
    with pytest.raises(FileNotFoundError):
        files.read_class_folders(spark, tree, ["mts", "tele2"])


def test_tables_with_line_breaks_and_missing_tables(spark, frame, tmp_path):
    text = 'first "quoted"\nsecond, line'
    rows = frame([("a.jpg", "mts", text)], "file string, brand string, visible_text string")
    for name in C.OUTCOMES.names:
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit("mts" if name == "truth" else ""))
    sinks.write_csv(rows.select(*C.OUTCOMES.names), f"{tmp_path}/run")
    back = files.read_table(spark, f"{tmp_path}/run", C.OUTCOMES).first()
    assert back["visible_text"] == text
    assert tuple(files.read_outcomes(spark, f"{tmp_path}/run").first()) == ("a.jpg", "mts", "mts")
    assert files.read_table(spark, f"{tmp_path}/none", C.VERDICTS, optional=True).count() == 0
    with pytest.raises(FileNotFoundError):
        files.read_table(spark, f"{tmp_path}/none", C.VERDICTS)


def test_tables_give_back_every_text(spark, frame, tmp_path):
    texts = [None, "", " ", " x ", "x\n", "\nx", "\t", "\r\n", "x\r", "\0", 'a"\0b', '\0"', '"', ' "a" ', "\\", "\\N", "\\\\N", "\\N\n", "a,b", "\x85", "null"]
    sinks.write_csv(frame([(i, t, t) for i, t in enumerate(texts)], "n int, first string, last string"), f"{tmp_path}/texts")
    back = files.read_table(spark, f"{tmp_path}/texts", "n int, first string, last string")
    assert sorted(map(tuple, back.collect())) == [(i, t, t) for i, t in enumerate(texts)]


def test_csv_round_trip_of_odd_documents(spark, frame, tmp_path):
    import duckdb

    import __spark_entry__ as entry

    rows = [(1, " x ", "en"), (2, "", "en"), (3, None, ""), (None, "x\n", None), (5, '\0"\r', " fr")]
    frame(rows, "doc_id long, text string, lang string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = entry.queries()["src07_csv_round_trip"](spark, str(tmp_path)).collect()
    documents = duckdb.read_parquet(f"{tmp_path}/documents.parquet/*.parquet")  # noqa: F841
    want = duckdb.sql(entry.oracle_sql()["src07_csv_round_trip"]).fetchall()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_rebuilt_split_leaves_nothing_behind(spark, frame, tmp_path):
    path = f"{tmp_path}/set"
    sinks.write_split(frame([("a.jpg", "x", "train"), ("b.jpg", None, "val")], "file string, text string, split string"), path)
    sinks.write_split(frame([("a.jpg", "x", "test"), ("b.jpg", None, "val")], "file string, text string, split string"), path)
    got = sorted((r["file"], r["split"], r["text"]) for r in spark.read.parquet(path).collect())
    assert got == [("a.jpg", "test", "x"), ("b.jpg", "val", "")]


def test_label_texts_keep_empty_frames(spark, frame, tmp_path):
    lines = frame([("a.jpg", 1, "second"), ("a.jpg", 0, "first")], "file string, index int, line string")
    sinks.write_label_texts(lines, frame([("a.jpg",), ("b.jpg",)], "file string"), f"{tmp_path}/labels")
    rows = [(r["file"], r["line"]) for r in spark.read.parquet(f"{tmp_path}/labels").orderBy("file", "index").collect()]
    assert rows == [("a.jpg", "first"), ("a.jpg", "second"), ("b.jpg", None)]


def test_bundles_keep_all_lines_of_a_crowded_frame(spark, frame, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "BUNDLE_LINES", 50)
    queue = frame([(1 + i // 3, i, f"{i}.jpg") for i in range(9)], "part bigint, position bigint, file string")
    lines = frame([("4.jpg", i, f"line {i}") for i in range(400)] + [("0.jpg", 0, "one")], "file string, index int, line string")
    sinks.write_bundles(queue, lines, f"{tmp_path}/b")
    back = spark.read.parquet(f"{tmp_path}/b")
    assert sorted((r["part"], r["file"]) for r in back.select("part", "file").distinct().collect()) == [(1 + i // 3, f"{i}.jpg") for i in range(9)]
    assert sorted(r["index"] for r in back.filter("file = '4.jpg'").collect()) == list(range(400))
    files_ = {p: len(list((tmp_path / "b" / f"part={p}").glob("*.parquet"))) for p in (1, 2, 3)}
    assert files_[1] == files_[3] == 1 and files_[2] > 1


def test_store_reuses_only_the_same_ids(spark, frame, tmp_path):
    calls = []

    def compute(ids):
        calls.append(1)
        return ids.select("id", F.array(F.col("id").cast("float")).alias("values"))

    one, two = frame([(1,), (2,)], "id int"), frame([(1,), (3,)], "id int")
    served = [feature_store.features(ids, str(tmp_path), "f", v, 1, lambda ids=ids: compute(ids), refresh=r)[1] for ids, v, r in ((one, "1", False), (one, "1", False), (two, "1", False), (two, "2", False), (two, "2", True))]
    assert served == [False, True, False, False, False] and len(calls) == 4
    with pytest.raises(ValueError):
        feature_store.features(one, str(tmp_path), "g", "1", 2, lambda: compute(one))
    # a rebuild of the wrong width leaves the store as it was
    feature_store.features(one, str(tmp_path), "h", "1", 1, lambda: compute(one))
    with pytest.raises(ValueError):
        feature_store.features(two, str(tmp_path), "h", "1", 2, lambda: compute(two))
    data, served_ = feature_store.features(one, str(tmp_path), "h", "1", 1, lambda: compute(one))
    assert served_ and sorted(r["id"] for r in data.collect()) == [1, 2]


def test_extractors_check_their_width(spark, frame):
    df = frame([(i, [float(i), 1.0]) for i in range(10)], "id int, v array<float>")
    double = inference.Extractor("double", "1", ("a", "b"), lambda: lambda batch: batch * 2, shape=(2,))
    got = {r["id"]: r["values"] for r in inference.extract(df, double, "v").collect()}
    assert got[3] == [6.0, 2.0]
    wrong = inference.Extractor("wrong", "1", ("a",), lambda: lambda batch: batch, shape=(2,))
    with pytest.raises(Exception, match="expected"):
        inference.extract(df, wrong, "v").collect()
    registry = inference.Registry()
    registry.add(double)
    with pytest.raises(ValueError):
        registry.add(double)
    with pytest.raises(KeyError):
        registry.get("nothing")


def test_a_tree_is_listed_by_many_tasks(spark, tmp_path):
    for i in range(3000):
        (tmp_path / f"f{i:05d}.txt").write_text("" if i % 3 else f"0 {i}")
    for deep in ("a", "a/b/c", "a/b/c/d", "e/f"):
        (tmp_path / deep).mkdir(parents=True, exist_ok=True)
        (tmp_path / deep / "x.TXT").write_text(deep)
        (tmp_path / deep / "x.jpg").write_text("no label")
    found = trees.read_tree(spark, f"file://{tmp_path}", (".txt",), shares=6)
    assert found.count() == 3004 and found.select("path").distinct().count() == 3004
    per_task = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert len(per_task) == 6 and max(per_task) < 800
    assert trees.read_tree(spark, str(tmp_path), (".txt",), recursive=False, contents=False).agg(F.count("*"), F.count("content")).first() == (3000, 0)
    texts = {r["path"]: r["text"] for r in files.read_label_files(spark, str(tmp_path)).collect()}
    assert texts[f"{tmp_path}/a/b/c/d/x.TXT"] == "a/b/c/d" and texts[f"{tmp_path}/f00001.txt"] == "" and len(texts) == 3004
    trees.write_members(spark.createDataFrame([("p/q.txt", bytearray(b"1")), ("r.txt", None)], "member string, content binary"), f"{tmp_path}/out")
    assert (tmp_path / "out/p/q.txt").read_text() == "1" and (tmp_path / "out/r.txt").read_text() == ""


def _blobs(frame, n=120):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(n):
        k = i % 4
        visual = rng.normal(size=6)
        visual[k] += 6
        rows.append((i, C.HEAD_CLASSES[k], k, i // 4, visual.tolist(), rng.normal(size=3).tolist()))
    return frame(rows, "id int, brand string, label int, group int, visual array<double>, color array<double>")


def test_head_learns_saves_and_predicts(spark, frame, tmp_path):
    rows = _blobs(frame)
    widths = {"visual": 6, "color": 3, "shortcut": 2}
    heads.train_and_save(rows, widths, str(tmp_path), classes=C.HEAD_CLASSES, max_iter=100)
    model = PipelineModel.load(f"{tmp_path}/model")
    got = heads.predict(rows, model, ["visual", "color"], key="id", floor=0.5).join(rows.select("id", F.col("brand").alias("truth")), "id")
    assert got.filter("brand = truth").count() >= 115
    probabilities = got.select(sum(F.col(f"p_{c}") for c in C.HEAD_CLASSES).alias("s")).agg(F.min("s"), F.max("s")).first()
    assert probabilities[0] == pytest.approx(1.0) and probabilities[1] == pytest.approx(1.0)
    weights = heads.visual_weights(model, "visual", {"visual": 6, "color": 3}, C.HEAD_CLASSES)
    assert all(int(np.argmax(weights[c])) == i for i, c in enumerate(C.HEAD_CLASSES))


def test_blocks_are_unit_rows_times_their_weight(frame):
    rows = heads.as_vectors(_blobs(frame), ["visual", "color"])
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    model = Pipeline(stages=heads.block_stages({"visual": 6, "color": 3}, {"color": 0.5})).fit(rows)
    for r in model.transform(rows).select(vector_to_array("features").alias("f")).collect():
        assert np.linalg.norm(r["f"][:6]) == pytest.approx(1.0) and np.linalg.norm(r["f"][6:]) == pytest.approx(0.5)


def test_ablation_tells_signal_from_noise(frame):
    guesses = heads.ablate(_blobs(frame), {"visual": {"visual": 6}, "color": {"color": 3}}, folds=3, repeats=1, max_iter=50)
    assert guesses.count() == 240
    scores = {r["arm"]: r["f1"] for r in heads.fold_scores(guesses).groupBy("arm").agg(F.avg("f1").alias("f1")).collect()}
    assert scores["visual"] > 0.9 > 0.6 > scores["color"]


def test_heads_fitted_together_equal_heads_fitted_alone(frame):
    rows, arms = _blobs(frame), {"visual": {"visual": 6}, "both": {"visual": 6, "color": 3}}
    table = heads.dealt(rows, ["visual", "color"], folds=3, repeats=2)
    fitted = heads.fitted_heads(table, arms, folds=3, repeats=2, weights={"color": 0.5})
    assert fitted.slopes.max() <= 1e-5
    got = {(r["arm"], r["repeat"], r["fold"], r["id"]): r["guess"] for r in many_heads.guesses(table, fitted, key="id").collect()}
    assert len(got) == 2 * 2 * 120
    for arm, repeat, fold in [("visual", 0, 1), ("both", 1, 2)]:
        held = F.col("folds")[repeat] == fold
        vectors = heads.as_vectors(table.withColumn("label", F.col("label").cast("double")), ["visual", "color"])
        model = heads.fit_head(vectors.filter(~held), arms[arm], weights={"color": 0.5})
        for r in model.transform(vectors.filter(held)).select("id", "prediction").collect():
            assert got[arm, repeat, fold, r["id"]] == r["prediction"]
        at = next(i for i, h in enumerate(fitted.grid.heads) if (h.arm, h.repeat, h.fold) == (arm, repeat, fold))
        own = fitted.weights[fitted.grid.part(at)].reshape(4, -1)
        alone = model.stages[-1].coefficientMatrix.toArray()
        assert np.abs((own[:, :-1] - own[:, :-1].mean(axis=0)) - (alone - alone.mean(axis=0))).max() < 0.02


def test_sums_of_many_tasks_meet_in_two_levels(spark):
    rows = spark.range(0, 1000, 1, 40)
    total = many_heads.summed(rows, lambda r: np.array([r["v"].sum(), len(r["v"])], dtype=float), lambda b: {"v": b["id"].to_numpy()})
    assert total.tolist() == [499500.0, 1000.0]


def test_judge_stream_resumes(spark, frame, tmp_path):
    frame([(f"b{i}", f"t{i}") for i in range(6)], "box_id string, text string").write.parquet(f"{tmp_path}/boxes")
    schema = "box_id string, category string, reason string, seconds double, answered_at bigint"
    boxes = lambda: spark.readStream.schema("box_id string, text string").parquet(f"{tmp_path}/boxes")

    def make():
        def ask(text):
            if text == "t5":
                raise TimeoutError("late")
            return '{"category": "ad_surface", "reason": "ok"}'

        return ask

    for mark in ("one", "two"):
        live.judge_stream(boxes(), f"{tmp_path}/answers", f"{tmp_path}/{mark}", make, "text", schema=schema).awaitTermination()
    frame([("b9", "t9")], "box_id string, text string").write.mode("append").parquet(f"{tmp_path}/boxes")
    live.judge_stream(boxes(), f"{tmp_path}/answers", f"{tmp_path}/two", make, "text", schema=schema).awaitTermination()
    rows = live.read_answers(spark, f"{tmp_path}/answers", schema).collect()
    assert sorted(r["box_id"] for r in rows) == ["b0", "b1", "b2", "b3", "b4", "b5", "b9"]
    assert {r["box_id"]: r["category"] for r in rows}["b5"] == "error"


def test_batches_read_no_answers(spark, frame, tmp_path):
    schema = "box_id string, category string, reason string, seconds double, answered_at bigint"
    asked = []
    make = lambda: lambda text: '{"category": "other", "reason": "ok"}'
    for turn in range(3):  # every turn has one new box, one repeated inside the batch, and all older ones again
        rows = [(f"b{i}", f"t{i}") for i in range(turn + 2)] + [(f"b{turn + 1}", "again"), (None, "nobody")]
        frame(rows, "box_id string, text string").write.mode("append").parquet(f"{tmp_path}/boxes")
        boxes = spark.readStream.schema("box_id string, text string").parquet(f"{tmp_path}/boxes")
        query = live.judge_stream(boxes, f"{tmp_path}/answers", f"{tmp_path}/mark", make, "text", schema=schema)
        query.awaitTermination()
        sources = [s for p in query.recentProgress for s in p["sources"]]
        assert len({s["description"] for s in sources}) == 1 and "boxes" in sources[0]["description"]
        asked.append(live.read_answers(spark, f"{tmp_path}/answers", schema).count())
    assert asked == [2, 3, 4]
    again = live.read_answers(spark, f"{tmp_path}/answers", schema)
    assert again.count() == again.select("box_id").distinct().count() == 4


def test_a_key_passes_once_until_its_timer(monkeypatch):
    class Cell:
        value = None

        def exists(self):
            return self.value is not None

        def update(self, value):
            self.value = value

        def clear(self):
            self.value = None

    class Handle:
        def __init__(self):
            self.timers = []

        def getValueState(self, name, schema):
            return Cell()

        def registerTimer(self, at):
            self.timers.append(at)

    class Clock:
        def getCurrentProcessingTimeInMs(self):
            return 1000

    handle, sight = Handle(), live.FirstSight(["box_id", "text"], 500)
    sight.init(handle)
    rows = pd.DataFrame({"box_id": ["b", "b"], "text": ["one", "two"]})
    ask = lambda: [r for part in sight.handleInputRows(("b",), iter([rows.head(0), rows]), Clock()) for r in part["text"]]
    assert ask() == ["one"] and ask() == [] and handle.timers == [1500]
    assert list(sight.handleExpiredTimer(("b",), Clock(), None)) == [] and ask() == ["one"]


def test_live_scenes_split_exactly_at_the_gap(spark, frame, tmp_path):
    rows = [(1, 0.0), (1, 4.999), (1, 9.999), (1, 11.0), (2, 0.0)]
    at = F.timestamp_millis((F.col("s") * 1000).cast("long"))
    frame(rows, "recording int, s double").select("recording", at.alias("at")).write.parquet(f"{tmp_path}/frames")
    stream = spark.readStream.schema("recording int, at timestamp").parquet(f"{tmp_path}/frames")
    live.drain(live.live_scenes(stream, gap_seconds=5.0), f"{tmp_path}/out", f"{tmp_path}/mark").awaitTermination()
    got = sorted((r["recording"], r["frames"]) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == [(1, 2), (1, 2), (2, 1)]


def test_live_scenes_close_behind_the_watermark(spark, frame, tmp_path):
    def add(rows):
        at = F.timestamp_millis((F.col("s") * 1000).cast("long"))
        frame(rows, "recording int, s double").coalesce(1).select("recording", at.alias("at")).write.mode("append").parquet(f"{tmp_path}/frames")
        stream = spark.readStream.schema("recording int, at timestamp").parquet(f"{tmp_path}/frames")
        scenes = live.live_scenes(stream, gap_seconds=5.0, lateness="10 seconds")
        live.drain(scenes, f"{tmp_path}/out", f"{tmp_path}/mark", mode="append").awaitTermination()
        return sorted((r["recording"], r["frames"]) for r in spark.read.parquet(f"{tmp_path}/out").collect())

    assert add([(1, 0.0), (1, 4.0), (2, 100.0)]) == [(1, 2)]
    # a late frame behind the watermark is dropped, an open scene grows
    assert add([(1, 2.0), (2, 103.0), (3, 300.0)]) == [(1, 2), (2, 2)]


def test_scratch_stays_below_the_checkpoint_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_path(spark, "x")
    assert path.startswith(named or spark.sparkContext._jsc.sc().getCheckpointDir().get())


def test_every_query_is_registered_with_a_callable(spark):
    import __spark_entry__ as entry

    queries, checks = entry.queries(), entry.oracle_sql()
    assert set(checks) <= set(queries) and len(queries) > 120
    assert entry.entry(spark).count() > 0


def test_streams_read_tables_of_one_file_and_of_many(spark, tmp_path):
    from catalog.flow_queries import stream
    from catalog.registry import Data

    (tmp_path / "many").mkdir()
    spark.range(40).repartition(3).write.parquet(str(tmp_path / "many" / "events.parquet"))
    (tmp_path / "one").mkdir()
    spark.range(40).toPandas().to_parquet(tmp_path / "one" / "events.parquet")
    spark.range(5).toPandas().to_parquet(tmp_path / "one" / "orders.parquet")
    for layout in ("one", "many"):
        query = stream(Data(spark, str(tmp_path / layout)), "events").writeStream.format("memory").queryName(layout).trigger(availableNow=True).start()
        query.awaitTermination()
        assert spark.table(layout).count() == 40
