"""Files and tables written and read back, models, services, streams."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from catalog.pool_queries import SPLIT, split
from catalog.registry import query
from catalog.review_queries import FATES, LINE, QUEUE, REPORT, fates
from catalog.vector_queries import GROUPS
from framewright import schemas as C
from framewright.functions.answers import parse_judge_reply
from framewright.operators import heads, inference, many_heads, nearest, palette, reports, review, scoring
from framewright.plans import classification
from framewright.session import pin, scratch_path
from framewright.sources import feature_store, files, sinks, tree
from framewright.streaming import live

# --- files ---------------------------------------------------------------


def fake_images(d) -> str:
    """Every document as a line of a .jpg file, in a folder per source and language."""
    path = scratch_path(d.spark, "images")
    rows = d.documents.select("source", "lang", F.md5("text").alias("line")).repartition("source", "lang")
    rows.write.partitionBy("source", "lang").option("extension", "jpg").csv(path)
    return path


@query(
    "src01_image_listing",
    "SELECT source, lang, 'jpg' AS suffix, (count(*) * 33)::BIGINT AS bytes FROM {documents} GROUP BY source, lang",
)
def src01(d):
    listed = files.list_images(d.spark, fake_images(d), recursive=True)
    part = lambda name: F.regexp_extract("path", f"{name}=([^/]*)/", 1).alias(name)
    return listed.groupBy(part("source"), part("lang"), "suffix").agg(F.sum("length").alias("bytes"))


@query("src02_unreadable_images", "SELECT DISTINCT source, false AS readable FROM {documents}")
def src02(d):
    images = files.read_images(d.spark, fake_images(d))
    return images.select(F.regexp_extract("path", "source=([^/]*)/", 1).alias("source"), "readable").distinct()


@query(
    "src06_class_folders",
    """SELECT DISTINCT concat('source=', source) AS brand, concat('lang=', lang) AS source FROM {documents} WHERE source IN ('src1', 'src2', 'src3')""",
)
def src06(d):
    brands = ["source=src1", "source=src2", "source=src3"]
    return files.read_class_folders(d.spark, fake_images(d), brands).select("brand", "source").distinct()


@query("src07_csv_round_trip", "SELECT concat(doc_id, '.jpg') AS file, lang AS truth, md5(text) AS text_md5 FROM {documents}")
def src07(d):
    path = scratch_path(d.spark, "outcomes")
    empty = F.lit("")
    rows = d.documents.select(
        F.concat_ws("", "doc_id", F.lit(".jpg")).alias("file"), F.lit("other").alias("brand"), empty.alias("raw_brand"),
        empty.alias("basis"), empty.alias("verdict"), F.col("lang").alias("truth"), F.col("text").alias("visible_text"),
        empty.alias("evidence"), empty.alias("error"),
    )
    sinks.write_csv(rows, path)
    back = files.read_table(d.spark, path, C.OUTCOMES)
    return back.select("file", "truth", F.md5("visible_text").alias("text_md5"))


@query("src07_optional_tables", "SELECT 0::BIGINT AS answers, 0::BIGINT AS verdicts")
def src07_optional(d):
    missing = scratch_path(d.spark, "missing")
    answers = files.read_table(d.spark, missing, C.ANSWERS, optional=True)
    verdicts = files.read_table(d.spark, missing, C.VERDICTS, optional=True)
    judged = d.boxes.join(verdicts, "box_id", "left_semi").agg(F.count("*"))
    return d.boxes.join(answers, "box_id", "left_semi").agg(F.count("*").alias("answers")).withColumn("verdicts", judged.scalar())


@query(
    "src08_recursive_labels",
    "SELECT lang, count(*) FILTER (label_text <> '') AS filled FROM {samples} WHERE label_text IS NOT NULL GROUP BY lang",
)
def src08(d):
    path = scratch_path(d.spark, "labels")
    texts = d.samples.filter("label_text IS NOT NULL").select("lang", F.regexp_replace("label_text", "\n", "").alias("value"))
    texts.repartition("lang").write.partitionBy("lang").text(path)
    read = files.read_label_files(d.spark, path)
    lines = F.size(review.filled_lines(F.col("text")))
    return read.groupBy(F.regexp_extract("path", "lang=([^/]*)/", 1).alias("lang")).agg(F.sum(lines).cast("long").alias("filled"))


@query(
    "src07_stored_report",
    f"""SELECT file, width, height, boxes::INT AS boxes, round_even(min_confidence, 4) AS min_confidence,
               round_even(max_confidence, 4) AS max_confidence, status FROM ({REPORT})""",
)
def snk02_back(d):
    path = scratch_path(d.spark, "report")
    sinks.write_report(reports.frame_report(d.frames, d.boxes), path)
    return files.read_table(d.spark, path, C.REPORT)


@query("snk02_report_text", f"SELECT file, printf('%.4f', min_confidence) AS low, printf('%.4f', max_confidence) AS high, status FROM ({REPORT})")
def snk02(d):
    report = sinks.formatted(reports.frame_report(d.frames, d.boxes), {"min_confidence": 4, "max_confidence": 4})
    return report.select("file", F.col("min_confidence").alias("low"), F.col("max_confidence").alias("high"), "status")


@query(
    "snk03_boxes_table",
    """SELECT box_id, file, index, printf('%.6f', center_x)::DOUBLE AS center_x, printf('%.6f', center_y)::DOUBLE AS center_y,
              printf('%.4f', confidence)::DOUBLE AS confidence, concat(replace(file, '.jpg', ''), '__', index, '.jpg') AS crop FROM {boxes}""",
)
def snk03(d):
    path = scratch_path(d.spark, "boxes")
    sinks.write_boxes(d.boxes.drop("scan"), path)
    back = files.read_table(d.spark, path, C.BOXES)
    return back.select("box_id", "file", "index", "center_x", "center_y", "confidence", "crop")


@query("snk04_review_list", f"SELECT concat_ws(chr(9), status, printf('%.2f', min_confidence), file) AS value FROM ({QUEUE})")
def snk04(d):
    path = scratch_path(d.spark, "review")
    sinks.write_review_list(reports.review_queue(reports.frame_report(d.frames, d.boxes)), path)
    return d.spark.read.text(path)


@query("snk05_fates_and_queue", f"SELECT file, status, boxes_before::INT AS boxes_before, boxes_after::INT AS boxes_after, status IN ('disputed', 'no_boxes') AS queued FROM ({FATES})")
def snk05(d):
    path = scratch_path(d.spark, "fates")
    table = fates(d)
    sinks.write_fates(review.with_notes(table), review.human_queue(table), path)
    frames = files.read_table(d.spark, f"{path}/frames", C.FRAMES)
    queue = d.spark.read.option("header", True).schema("file string, status string").csv(f"{path}/queue")
    marked = frames.join(queue.select("file", F.lit(True).alias("queued")), "file", "left")
    return marked.select("file", "status", "boxes_before", "boxes_after", F.coalesce("queued", F.lit(False)).alias("queued"))


@query("snk06_split_manifest", f"SELECT file, split, coalesce(text, '') AS text FROM ({SPLIT})")
def snk06(d):
    path = scratch_path(d.spark, "split")
    sinks.write_split(split(d).select("file", "split", "text"), path)
    return d.spark.read.parquet(path).select("file", "split", "text")


@query("snk07_answer_log", "SELECT box_id, arg_max(category, answered_at) AS category FROM {answers} GROUP BY box_id")
def snk07(d):
    path = scratch_path(d.spark, "answers")
    for turn in (1, 2):
        sinks.append_answers(d.answers.filter(F.col("answered_at") == turn), path)
    return review.last_answers(d.spark.read.parquet(path))


@query(
    "snk08_task_bundles",
    f"""SELECT q.part::INT AS part, q.file, s.line, 'ad_object' AS class_name
        FROM (SELECT *, (position - 1) // 600 + 1 AS part FROM ({QUEUE})) q LEFT JOIN (SELECT *, {LINE} AS line FROM {{boxes}}) s USING (file)""",
)
def snk08(d):
    path = scratch_path(d.spark, "bundles")
    queue = reports.bundles(reports.review_queue(reports.frame_report(d.frames, d.boxes)))
    lines = d.boxes.select("file", "index", review.box_line().alias("line"))
    sinks.write_bundles(queue, lines, path)
    return d.spark.read.parquet(path).select("part", "file", "line", "class_name")


# --- features and models -------------------------------------------------


def make_sums():
    """A stand-in model: four partial sums of the vector."""
    return lambda batch: np.stack([batch[:, k::4].astype(np.float64).sum(axis=1) for k in range(4)], axis=1)


SUMS = inference.Extractor("sums", "1", ("s0", "s1", "s2", "s3"), make_sums, shape=(64,))
SUMS_SQL = ", ".join(
    f"round(list_sum(list_transform(range(16), lambda k: embedding[k * 4 + {j + 1}]::DOUBLE))::FLOAT::DOUBLE, 4) AS s{j}" for j in range(4)
)


def sums(d):
    return inference.extract(d.embeddings.select(F.col("vec_id").alias("id"), "embedding"), SUMS, "embedding")


def _spread(df):
    return df.select("id", *[F.round(F.col("values")[k].cast("double"), 4).alias(f"s{k}") for k in range(4)])


@query("ml06_extracted_features", f"SELECT vec_id AS id, {SUMS_SQL} FROM {{embeddings}}")
def ml06(d):
    registry = inference.Registry()
    registry.add(SUMS)
    rows = d.embeddings.select(F.col("vec_id").alias("id"), "embedding")
    return _spread(inference.extract(rows, registry.get("sums"), "embedding"))


@query("snk10_feature_store", f"SELECT vec_id AS id, {SUMS_SQL}, true AS served FROM {{embeddings}}")
def snk10(d):
    root = scratch_path(d.spark, "features")
    ids = d.embeddings.select(F.col("vec_id").alias("id"))
    for _ in range(2):
        data, served = feature_store.features(ids, root, "sums", "1", 4, lambda: sums(d))
    return _spread(data).withColumn("served", F.lit(served))


def make_detector():
    """A stand-in detector: up to three boxes per frame, by plain arithmetic on its price."""

    def run(batch):
        return [[(x, x / 2, x + 10.0 * (k + 1), x / 2 + 20.0, 0.2 + 0.1 * k) for k in range(int(x) % 4)] for x in batch]

    return run


@query(
    "ml07_detections",
    """SELECT file, price AS x1, price / 2 AS y1, price + 10e0 * (k + 1) AS x2, price / 2 + 20e0 AS y2, round(0.2e0 + 0.1e0 * k, 6) AS confidence
       FROM {frames}, range(3) t(k) WHERE k < floor(price)::BIGINT % 4 AND 0.2e0 + 0.1e0 * k >= 0.25e0""",
)
def ml07(d):
    found = inference.detect(d.frames, make_detector, "price", min_confidence=0.25)
    return found.withColumn("confidence", F.round("confidence", 6))


def make_client():
    """A stand-in service: answers with the length of the whole text, fails on short ones."""

    def ask(text: str) -> str:
        if len(text) < 100:
            raise TimeoutError("no answer")
        return '{"category": "%s", "reason": "%d characters"}' % ("ad_surface" if len(text) % 2 else "other", len(text))

    return ask


JUDGED = """
    SELECT doc_id, CASE WHEN length(text) < 100 THEN 'error' WHEN length(text) % 2 = 1 THEN 'ad_surface' ELSE 'other' END AS category,
           CASE WHEN length(text) < 100 THEN 'no answer' ELSE concat(length(text), ' characters') END AS reason FROM {documents}"""


@query("ml08_service_answers", JUDGED)
def ml08(d):
    asked = inference.ask_service(d.documents, make_client, "text", key="doc_id")
    fields = parse_judge_reply(F.col("reply"), F.col("failure"))
    return asked.select("doc_id", *[v.alias(k) for k, v in fields.items()])


WIDTHS = {"visual": 48, "color": 16}


def samples(d):
    names = F.array(*[F.lit(c) for c in C.HEAD_CLASSES])
    brand = F.element_at(names, (F.pmod("label", F.lit(4)) + 1).cast("int"))
    return d.embeddings.select(
        F.col("vec_id").alias("id"), brand.alias("brand"), F.pmod("label", F.lit(4)).alias("label"),
        F.slice("embedding", 1, 48).alias("visual"), F.slice("embedding", 49, 16).alias("color"),
    )


@query(
    "ml01_scaled_blocks",
    """WITH l AS (SELECT vec_id AS id, k, embedding[k + 1]::DOUBLE AS v, k >= 48 AS color FROM {embeddings}, range(64) t(k)),
            z AS (SELECT id, k, color, (v - avg(v) OVER c) / stddev_samp(v) OVER c AS z FROM l WINDOW c AS (PARTITION BY k))
       SELECT id, k::INT AS k, round(z / sqrt(sum(z * z) OVER (PARTITION BY id, color)) * CASE WHEN color THEN 0.5e0 ELSE 1 END, 6) AS value FROM z""",
)
def ml01(d):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    rows = heads.as_vectors(samples(d), list(WIDTHS))
    model = Pipeline(stages=heads.block_stages(WIDTHS, {"color": 0.5})).fit(rows)
    values = model.transform(rows).select("id", F.posexplode(vector_to_array("features")).alias("k", "value"))
    return values.withColumn("value", F.round("value", 6))


@query("ml02_balanced_head")
def ml02(d):
    rows = heads.as_vectors(samples(d), list(WIDTHS))
    model = heads.fit_head(rows, WIDTHS, weights={"color": 0.5}, max_iter=3000)
    return model.transform(rows).select("id", "label", "prediction")


@query(
    "ml02_balanced_weights",
    """SELECT label % 4 AS label, count(*) AS n, round((SELECT count(*) FROM {embeddings}) / (4e0 * count(*)), 6) AS weight, true AS still
       FROM {embeddings} GROUP BY label % 4""",
)
def ml02_weights(d):
    """Class weights, and whether the fitted head is a minimum: its slope, from features and probabilities, is close to zero."""
    from pyspark.ml.functions import vector_to_array

    rows = heads.as_vectors(samples(d), list(WIDTHS))
    model = heads.fit_head(rows, WIDTHS, weights={"color": 0.5}, max_iter=3000)
    weighted, total, classes = heads.balanced(rows, "label")
    scored = model.transform(weighted).select("label", "weight", vector_to_array("probability").alias("p"), vector_to_array("features").alias("x"))
    table = model.stages[-1].coefficientMatrix.toArray()
    own = d.spark.createDataFrame([(k, j, float(w)) for k, row in enumerate(table) for j, w in enumerate(row)], "class int, dim int, w double")
    spread = scored.select("label", "weight", "x", F.posexplode("p").alias("class", "p"))
    spread = spread.withColumn("pull", F.col("weight") * (F.col("p") - (F.col("label") == F.col("class")).cast("double")))
    slopes = spread.select("class", "pull", F.posexplode("x").alias("dim", "x")).groupBy("class", "dim").agg(F.sum(F.col("pull") * F.col("x")).alias("g"))
    worst = slopes.join(own, ["class", "dim"]).agg(F.max(F.abs(F.col("g") / total + F.col("w") / total)).alias("worst"))
    counts = weighted.groupBy("label").agg(F.count("*").alias("n"), F.round(F.max("weight"), 6).alias("weight"))
    return counts.select(F.col("label").cast("long").alias("label"), "n", "weight", (worst.scalar() < 1e-3).alias("still"))


@query("ml03_reloaded_head", "SELECT vec_id AS id, true AS same FROM {embeddings}")
def ml03_reloaded(d):
    """A head read back from its folder says what the head in memory says."""
    from pyspark.ml import PipelineModel

    path = scratch_path(d.spark, "head")
    model = heads.train_and_save(samples(d), WIDTHS, path, classes=C.HEAD_CLASSES, max_iter=3000)
    here = heads.predict(samples(d), model, list(WIDTHS), key="id", floor=0.3).select("id", "brand", "confidence")
    there = heads.predict(samples(d), PipelineModel.load(f"{path}/model"), list(WIDTHS), key="id", floor=0.3)
    same = (F.col("here.brand") == F.col("there.brand")) & (F.col("here.confidence") == F.col("there.confidence"))
    return here.alias("here").join(there.alias("there"), "id").select("id", same.alias("same"))


@query("ml04_prediction_rules", "SELECT vec_id AS id, true AS proper, true AS named FROM {embeddings}")
def ml04_rules(d):
    """Every prediction: probabilities of all classes sum to one, the class is their first maximum, or unsure below the floor."""
    said = ml04(d)
    shares = F.array(*[F.col(f"p_{c}") for c in C.HEAD_CLASSES if f"p_{c}" in said.columns])
    names = F.array(*[F.lit(c) for c in C.HEAD_CLASSES])
    best = F.array_max(shares)
    total = F.aggregate(F.filter(shares, lambda p: p.isNotNull()), F.lit(0.0), lambda a, p: a + p)
    brand = F.when(best < 0.3, F.lit(C.UNSURE)).otherwise(F.element_at(names, F.array_position(shares, best).cast("int")))
    return said.select("id", ((F.abs(total - 1.0) < 1e-9) & (F.col("confidence") == best)).alias("proper"), (F.col("brand") == brand).alias("named"))


@query("snk11_stored_predictions", "SELECT vec_id AS id, true AS same, true AS four_decimals FROM {embeddings}")
def snk11_stored(d):
    """Written predictions against those of the head: the class is kept, shares are kept to four decimals."""
    path = scratch_path(d.spark, "predictions")
    shares = ["confidence", *[f"p_{c}" for c in C.HEAD_CLASSES]]
    here = pin(ml04(d))
    sinks.write_predictions(here, path, shares[1:])
    texts = d.spark.read.option("header", True).csv(path)
    close = [F.abs(F.col(f"there.{c}").cast("double") - F.col(f"here.{c}")) <= 0.5e-4 + 1e-12 for c in shares]
    short = [F.col(f"there.{c}").rlike(r"^\d\.\d{4}$") for c in shares]
    every = lambda tests: F.array_min(F.array(*[F.coalesce(t, F.lit(True)) for t in tests]))
    both = here.alias("here").join(texts.withColumn("id", F.col("id").cast("long")).alias("there"), "id")
    return both.select("id", ((F.col("here.brand") == F.col("there.brand")) & every(close)).alias("same"), every(short).alias("four_decimals"))


@query("src05_annotation_export", "SELECT stem, max(label_text) AS text, true AS handmade FROM {samples} WHERE label_text IS NOT NULL GROUP BY stem")
def src05(d):
    """Labels and images written as the members of an export, one file each, then read back as pairs; empty labels stay."""
    path = scratch_path(d.spark, "export")
    named = d.samples.filter("label_text IS NOT NULL").groupBy("stem").agg(F.max("label_text").alias("text"))
    member = lambda folder, suffix: F.concat(F.lit(f"{folder}/"), "stem", F.lit(suffix)).alias("member")
    tree.write_members(named.select(member("data/labels", ".txt"), F.col("text").cast("binary").alias("content")), path)
    tree.write_members(named.select(member("data/images", ".jpg"), F.col("stem").cast("binary").alias("content")), path)
    return files.read_annotation_export(d.spark, path).select("stem", "text", "handmade")


@query("ml03_train_and_reload")
def ml03(d):
    from pyspark.ml import PipelineModel

    path = scratch_path(d.spark, "head")
    heads.train_and_save(samples(d), WIDTHS, path, classes=C.HEAD_CLASSES, max_iter=3000)
    return heads.predict(samples(d), PipelineModel.load(f"{path}/model"), list(WIDTHS), key="id", floor=0.3)


@query("ml04_predictions")
def ml04(d):
    rows = heads.as_vectors(samples(d), list(WIDTHS))
    model = heads.fit_head(rows, WIDTHS, max_iter=3000)
    return heads.predict(samples(d), model, list(WIDTHS), key="id", floor=0.3)


@query("snk11_prediction_table")
def snk11(d):
    path = scratch_path(d.spark, "predictions")
    classes = [f"p_{c}" for c in C.HEAD_CLASSES]
    sinks.write_predictions(ml04(d), path, classes)
    fields = "id bigint, brand string, confidence double, " + ", ".join(f"{c} double" for c in classes)
    return d.spark.read.option("header", True).schema(fields).csv(path)


#: Names of the colour dimensions: some know brands, the others don't.
COLOUR_DIMS = tuple(f"share_{i}" for i in range(10)) + tuple(f"brand_{i}" for i in range(6))


def ablation_arms(d):
    """Samples with groups of near duplicates, and the six arms of an ablation."""
    near = nearest.duplicate_groups(d.embeddings.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector")), threshold=0.45)
    rows = samples(d).withColumn("shortcut", F.slice("color", 13, 4))
    dims = {"visual": [f"v{i}" for i in range(48)], "color": COLOUR_DIMS, "shortcut": ["log_width", "log_height", "aspect", "sharpness"]}
    return classification.standard_arms(rows.join(near, "id"), dims)


@query("ml05_ablation")
def ml05(d):
    rows, arms = ablation_arms(d)
    return scoring.arm_summary(heads.fold_scores(heads.ablate(rows, arms, weights={"color": 0.5})), "visual")


@query(
    "ml05_stationary_heads",
    f"""WITH RECURSIVE g AS MATERIALIZED ({GROUPS.replace(">= 0.4", ">= 0.45")}), s AS (SELECT vec_id AS id, label % 4 AS label, "group" FROM {{embeddings}} JOIN g ON g.id = vec_id),
        v AS (SELECT "group", label, count(*) AS n FROM s GROUP BY ALL),
        m AS (SELECT "group", arg_max(label, (n, -label)) AS class, sum(n) AS size FROM v GROUP BY "group"),
        k AS (SELECT r AS repeat, "group", (row_number() OVER (PARTITION BY r, class ORDER BY size DESC, md5(concat(r, ':', "group")), "group") - 1) % 5 AS fold
              FROM m, range(5) t(r)),
        f AS (SELECT repeat, fold, count(*) AS held FROM s JOIN k USING ("group") GROUP BY ALL)
        SELECT arm, repeat::INT AS repeat, fold::INT AS fold, (SELECT count(*) FROM s) - held AS rows, held AS guessed, true AS stationary, true AS same_f1
        FROM f, unnest(['visual', 'color', 'visual+color', 'color, no brands', 'visual+color, no brands', 'shortcut']) a(arm)""",
)
def ml05_stationary(d):
    """Every head of the grid: rows it learned from and guessed, whether it stands still, and whether its score follows from stored guesses."""
    rows, arms = ablation_arms(d)
    table = heads.dealt(rows, sorted({b for arm in arms.values() for b in arm}))
    fitted = heads.fitted_heads(table, arms, weights={"color": 0.5})
    path = scratch_path(d.spark, "guesses")
    many_heads.guesses(table, fitted, key="id").write.parquet(path)
    said = d.spark.read.parquet(path)
    by = ["arm", "repeat", "fold"]
    again = said.groupBy(*by, "truth", "guess").agg(F.count("*").alias("n")).groupBy(*by).agg(F.collect_list(F.struct("truth", "guess", "n")).alias("cells"))

    def f1(cells):
        classes = F.array_distinct(F.flatten(F.transform(cells, lambda x: F.array(x["truth"], x["guess"]))))
        total = lambda xs: F.aggregate(xs, F.lit(0).cast("long"), lambda a, x: a + x["n"])

        def one(name):
            hits = total(F.filter(cells, lambda x: (x["truth"] == name) & (x["guess"] == name)))
            ends = total(F.filter(cells, lambda x: x["truth"] == name)) + total(F.filter(cells, lambda x: x["guess"] == name))
            return 2.0 * hits / ends

        scores = F.transform(classes, one)
        return F.aggregate(scores, F.lit(0.0), lambda a, x: a + x) / F.size(scores)

    again = again.select(*by, f1(F.col("cells")).alias("_again"), F.aggregate("cells", F.lit(0).cast("long"), lambda a, x: a + x["n"]).alias("guessed"))
    stands = many_heads.stationarity(table, fitted).join(heads.fold_scores(said), by).join(again, by)
    return stands.select(
        *by, "rows", "guessed", (F.col("slope") <= 1e-5).alias("stationary"), (F.abs(F.col("f1") - F.col("_again")) < 1e-9).alias("same_f1")
    )


@query("ml09_explanations")
def ml09(d):
    rows = samples(d)
    model = heads.fit_head(heads.as_vectors(rows, list(WIDTHS)), WIDTHS, max_iter=3000)
    weights = heads.visual_weights(model, "visual", WIDTHS, C.HEAD_CLASSES)
    # a grid of 4 x 4 cells: the mean of their maps is the block the head reads
    shift = lambda v, i: v.cast("double") * (F.pmod(F.col("cell") * 7 + i * 3, F.lit(16)) / 7.5)
    spots = rows.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(15))))
    cells = spots.select(F.col("id").alias("img"), "cell", F.transform("visual", shift).alias("features"))
    guesses = heads.predict(rows, model, list(WIDTHS), key="id").withColumnRenamed("id", "img")
    colours = rows.select(F.col("id").alias("img"), F.col("color").alias("values"))
    return heads.explanation(guesses, palette.attribution(cells, weights), colours, [f"c{i}" for i in range(16)]).select(
        "img", "brand", "class", "cell", "weight", F.element_at("colour", "c0").alias("c0")
    )


# --- streams -------------------------------------------------------------


def stream(d, table: str):
    schema = getattr(d, table).schema
    # a pattern of this one name: a stream takes no plain path to a file, and the table may be a file or a folder of parts
    return d.spark.readStream.schema(schema).parquet(f"{d.sf_dir}/{table}.parque[t]")


@query("st01_resumable_judge", JUDGED.replace("doc_id,", "CAST(doc_id AS string) AS box_id,", 1))
def st01(d):
    base = scratch_path(d.spark, "judge")
    rows = stream(d, "documents").select(F.col("doc_id").cast("string").alias("box_id"), "text")
    schema = "box_id string, category string, reason string, seconds double, answered_at bigint"
    for turn in ("first", "again"):  # the second run finds everything answered
        live.judge_stream(rows, f"{base}/answers", f"{base}/{turn}", make_client, "text", schema=schema).awaitTermination()
    return live.read_answers(d.spark, f"{base}/answers", schema).select("box_id", "category", "reason")


@query(
    "st02_live_scenes",
    """WITH c AS (SELECT user_id AS recording, ts, sum(cut) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS scene
                  FROM (SELECT *, CASE WHEN coalesce(ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) >= INTERVAL 6 HOURS, true)
                                       THEN 1 ELSE 0 END AS cut FROM {events}))
       SELECT recording, epoch_us(min(ts)) AS first_us, epoch_us(max(ts)) AS last_us, count(*) AS frames FROM c GROUP BY recording, scene
       HAVING max(ts) + INTERVAL 6 HOURS <= (SELECT max(ts) FROM {events}) - INTERVAL 10 MINUTES""",
)
def st02(d):
    base = scratch_path(d.spark, "scenes")
    # the wall clock of the recording, taken as it stands in whatever zone the session uses
    at = F.expr("timestamp_micros(timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', CAST(ts AS timestamp_ntz)))")
    frames = stream(d, "events").select(F.col("user_id").alias("recording"), at.alias("at"))
    # closed scenes only: the watermark drops their state, so the open ones at the end aren't written yet
    live.drain(live.live_scenes(frames, gap_seconds=21600), f"{base}/out", f"{base}/mark", mode="append").awaitTermination()
    table = d.spark.read.parquet(f"{base}/out")
    return table.select("recording", F.unix_micros("first_at").alias("first_us"), F.unix_micros("last_at").alias("last_us"), "frames")


@query("st03_running_counts", "SELECT event_type, count(*) AS rows FROM {events} GROUP BY event_type")
def st03(d):
    base = scratch_path(d.spark, "counts")
    counts = live.running_counts(stream(d, "events"), "event_type")
    live.drain(counts, f"{base}/out", f"{base}/mark").awaitTermination()
    return d.spark.read.parquet(f"{base}/out")
