"""Whole jobs over the provided tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.pool_queries import SCENE_ROWS, SCENES
from catalog.registry import query
from catalog.review_queries import FATES, LINE, REPORT, SETTLED
from catalog.score_queries import card
from framewright.operators import pool
from framewright.operators.reports import frame_report
from framewright.plans import classification, detection
from framewright.session import scratch_path
from framewright.sources import files, sinks


def sized(n: str = "n") -> str:
    return f"greatest(1, round_even({n} * 0.15e0, 0))"


def split_case(table: str, stratum: str, key: str) -> str:
    """Split of a table by strata, by the closed form of the part sizes."""
    return f"""
    SELECT *, CASE WHEN n < 3 THEN 'train' WHEN r <= v THEN 'val' WHEN r <= v + t THEN 'test' ELSE 'train' END AS split
    FROM (SELECT *, CASE WHEN 2 * s <= n - 1 THEN s ELSE ceil((n - 1) / 2) END AS v,
                    CASE WHEN 2 * s <= n - 1 THEN s ELSE floor((n - 1) / 2) END AS t
          FROM (SELECT *, {sized()} AS s
                FROM (SELECT *, count(*) OVER (PARTITION BY {stratum}) AS n,
                             row_number() OVER (PARTITION BY {stratum} ORDER BY md5(concat('0:', {key})), {key}) AS r FROM {table})))"""


@query(
    "job_handmade_tally",
    f"""WITH s AS ({split_case('(' + SCENE_ROWS + ')', '"group", density', 'scene_key')}),
             f AS (SELECT k.file, s."group", s.density, s.split FROM ({SCENES}) k JOIN s USING (scene_key)
                   WHERE NOT regexp_matches(k.file, '_aug[.]') OR s.split = 'train')
        SELECT "group", density, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'val') AS val,
               count(*) FILTER (split = 'test') AS test FROM f GROUP BY "group", density""",
)
def handmade(d):
    samples = d.video.withColumn("n_boxes", F.length("event_type") - 4)
    return detection.handmade(samples, gap=0.5, span=20.0)["tally"]


BUILD_ROWS = """
    SELECT file, label_text AS text, labelling = 'positive' AS handmade, 'doc' AS grp, coalesce(label_text, '') <> '' AS filled FROM {samples}"""


@query(
    "job_build_parts",
    f"""WITH s AS ({split_case('(' + BUILD_ROWS + ')', 'grp, filled', 'file')})
        SELECT split, handmade, count(*) AS frames FROM s GROUP BY ALL
        UNION ALL SELECT 'test_handmade', true, count(*) FROM s WHERE split = 'test' AND handmade""",
)
def build(d):
    rows = d.samples.select("file", F.col("label_text").alias("text"), "labelling")
    human, rest = rows.filter("labelling = 'positive'"), rows.filter("labelling <> 'positive'")
    return detection.build(human, rest).groupBy("split", "handmade").agg(F.count("*").alias("frames"))


def _source(d, langs, name, labelled=True):
    rows = d.samples.filter(F.col("lang").isin(*langs))
    images = rows.select(
        F.concat("source", F.lit("/"), "stem", F.lit(".jpg")).alias("path"), pool.content_key(F.col("content")).alias("content_key")
    )
    one = images.groupBy("path").agg(F.min("content_key").alias("content_key"))
    labels = rows.filter("label_text IS NOT NULL").groupBy("stem").agg(F.min("label_text").alias("text"))
    return detection.Source(name, one, labels if labelled else None, handmade=labelled)


@query("job_build_multi_counts")
def build_multi(d):
    sources = [_source(d, ["en"], "stock"), _source(d, ["en", "de"], "older"), _source(d, ["es"], "negatives", labelled=False)]
    return detection.build_multi(sources, _source(d, ["fr"], "foreign"))["counts"]


@query("job_build_multi_sources")
def build_multi_sources(d):
    sources = [_source(d, ["en"], "stock"), _source(d, ["en", "de"], "older"), _source(d, ["es"], "negatives", labelled=False)]
    return detection.build_multi(sources, _source(d, ["fr"], "foreign"))["by_source"]


@query(
    "job_review_queue",
    f"""WITH f AS ({FATES}), r AS (SELECT file, row_number() OVER (ORDER BY file) AS n FROM f WHERE status = 'no_boxes')
        SELECT file, status FROM f WHERE status = 'disputed'""",
)
def review_queue(d):
    return detection.apply_verdicts(d.frames, d.boxes, d.answers, d.verdicts, empty_stride=5)["queue"]


@query("job_import_totals", """SELECT count(*) AS frames, sum(n)::BIGINT AS boxes, count(*) FILTER (n = 0) AS empty FROM (
         SELECT len(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '')) AS n FROM {export})""")  # fmt: skip
def import_totals(d):
    done = detection.apply_verdicts(d.frames, d.boxes, d.answers, d.verdicts)
    old = done["fates"].select(F.regexp_replace("file", r"\.jpg$", "").alias("stem"), F.lit("").alias("text"))
    return detection.import_export(done["fates"], old, done["queue"], d.export)["totals"]


@query(
    "job_preview_layout",
    f"""SELECT file, (n - 1) // 12 + 1 AS sheet, ((n - 1) % 12) // 4 + 1 AS row, (n - 1) % 4 + 1 AS "column" FROM (
          SELECT file, row_number() OVER (ORDER BY file) AS n FROM (
            SELECT file FROM ({REPORT}) ORDER BY md5(concat('0:', file)), file LIMIT 48))""",
)
def preview(d):
    return detection.preview(frame_report(d.frames, d.boxes), n=48)


@query(
    "job_negative_names",
    """SELECT file, printf('truck_%05d', number) AS stem, printf('truck_%05d_aug', number) AS copy_stem FROM (
         SELECT file, row_number() OVER (ORDER BY file) AS number FROM {frames})
       WHERE file NOT IN (SELECT concat(stem, '.jpg') FROM {export})""",
)
def negatives(d):
    skip = d.export.select(F.concat("stem", F.lit(".jpg")).alias("file"))
    return detection.negatives(d.frames, skip).select("file", "stem", "copy_stem")


@query(
    "job_compare_brands",
    f"""SELECT name, a.hits AS hits_before, b.hits AS hits_after, b.hits - a.hits AS shift
        FROM ({card('(SELECT * FROM {run_one_graded} WHERE file IN (SELECT file FROM {run_two_graded}))')}) a
        JOIN ({card('(SELECT * FROM {run_two_graded} WHERE file IN (SELECT file FROM {run_one_graded}))')}) b USING (name)""",
)
def compare(d):
    return classification.compare(d.run_one, d.run_two)["brands"].select("name", "hits_before", "hits_after", "shift")


@query(
    "snk12_probe_labels",
    """SELECT concat(source, '__', file) AS file, brand, source FROM (
         SELECT file, source, CASE WHEN lang = 'en' THEN 'other' ELSE 'mts' END AS brand,
                row_number() OVER (PARTITION BY CASE WHEN lang = 'en' AND source NOT IN ('src1', 'src2', 'src3') THEN '_rest' ELSE source END
                                   ORDER BY md5(concat('0:', file)), file) AS r FROM {samples})
       WHERE source IN ('src1', 'src2') OR (source = 'src3' AND r <= 10) OR (source NOT IN ('src1', 'src2', 'src3') AND brand = 'other' AND r <= 150)""",
)
def probe(d):
    brand = F.when(F.col("lang") == "en", F.lit("other")).otherwise(F.lit("mts"))
    rows = d.samples.select("file", brand.alias("brand"), "source")
    return classification.probe(rows, hard=("src1", "src2"), street_source="src3", street=10)


@query(
    "snk12_written_probe",
    """WITH c AS (SELECT concat(source, '__', file) AS file, brand, source FROM (
         SELECT file, source, CASE WHEN lang = 'en' THEN 'other' ELSE 'mts' END AS brand,
                row_number() OVER (PARTITION BY CASE WHEN lang = 'en' AND source NOT IN ('src1', 'src2', 'src3') THEN '_rest' ELSE source END
                                   ORDER BY md5(concat('0:', file)), file) AS r FROM {samples})
       WHERE source IN ('src1', 'src2') OR (source = 'src3' AND r <= 10) OR (source NOT IN ('src1', 'src2', 'src3') AND brand = 'other' AND r <= 150))
       SELECT file AS original, brand, source, true AS blinded FROM c""",
)
def written_probe(d):
    """The probe and its blinding, written and read back: labels meet the key on the original name; no blinded name tells it."""
    folder = scratch_path(d.spark, "probe")
    sinks.write_probe(probe(d), folder)
    labels = files.read_table(d.spark, f"{folder}/labels", "file string, brand string, source string")
    names = labels.withColumn("quality", F.lit("good"))
    key = sinks.write_blinded(classification.blind(names, [("probe", names)]), f"{folder}/blind")
    back = files.read_table(d.spark, key, "file string, brand string, source string, quality string, original string")
    shown = files.read_table(d.spark, f"{folder}/blind/files", "file string")
    told = F.col("file").contains(F.regexp_replace("original", r"\.[^.]*$", ""))
    return back.join(shown, "file").join(labels.select(F.col("file").alias("original")), "original").select(
        "original", "brand", "source", (~told & (F.col("quality") == "good")).alias("blinded")
    )


def make_client():
    """A stand-in vision model: claims what the text's first letter suggests, reads the whole text."""
    import json

    def ask(text: str) -> str:
        if len(text) < 100:
            raise TimeoutError("no answer")
        brand = "mts" if len(text) % 2 else "other"
        return json.dumps({"brand": brand, "basis": "logo_only", "visible_text": text, "evidence": ""})

    return ask


@query(
    "job_answers",
    """WITH a AS (SELECT file, lang, CASE WHEN length(content) < 100 THEN 'unclear' WHEN length(content) % 2 = 1 THEN 'mts' ELSE 'other' END AS brand,
                         CASE WHEN length(content) < 100 THEN 'no answer' ELSE '' END AS error, lower(content) AS low,
                         regexp_replace(lower(content), '\\s+', '', 'g') AS packed FROM {samples})
       SELECT file, brand, error, CASE WHEN brand <> 'mts' OR contains(low, 'mts') OR contains(low, 'mtc') OR contains(packed, 'mts')
                                            OR contains(packed, 'mtc') THEN 'confirmed' ELSE 'review' END AS verdict,
              CASE WHEN lang = 'en' THEN 'other' ELSE 'mts' END AS truth FROM a""",
)
def answers(d):
    truth = d.samples.select("file", F.when(F.col("lang") == "en", "other").otherwise("mts").alias("brand"), F.lit(1).alias("listed_at"))
    rows = classification.answer(d.samples.select("file", "content"), truth, make_client, "content", probe=lambda: True)
    return rows.select("file", "brand", "error", "verdict", "truth")


@query(
    "job_stored_labels",
    f"""WITH f AS ({FATES}), s AS ({SETTLED})
        SELECT f.file, s.index, s.line FROM f LEFT JOIN (SELECT file, index, {LINE} AS line FROM s WHERE fate = 'keep') s USING (file)
        WHERE f.status IN ('clean', 'fixed', 'negative')""",
)
def stored_labels(d):
    return _stored_review(d, "labels")


@query(
    "job_stored_disputed",
    f"""WITH s AS ({SETTLED})
        SELECT file, index, {LINE} AS line FROM s WHERE fate <> 'drop' AND file IN (SELECT file FROM s WHERE fate = 'disputed')""",
)
def stored_disputed(d):
    return _stored_review(d, "disputed")


def _stored_review(d, part):
    """The review written as a whole, one part read back."""
    path = scratch_path(d.spark, "stored-review")
    detection.store_review(detection.apply_verdicts(d.frames, d.boxes, d.answers, d.verdicts), path)
    return d.spark.read.parquet(f"{path}/{part}")


@query(
    "job_prelabel_boxes",
    """SELECT file, 0.25e0 + (CAST(substr(file, 7, 9) AS int) % 7) / 10e0 AS confidence,
              (least(width, 30.0) + 10) / 2 / width AS cx, (least(height, 45.0) + 20) / 2 / height AS cy
       FROM {frames}""",
)
def prelabel_boxes(d):
    def make():
        # stands in for a detector: one box per frame, told from its name
        return lambda names: [[(10.0, 20.0, 30.0, 45.0, 0.25 + int(n[6:15]) % 7 / 10)] for n in names]

    rows = d.frames.select("file", "width", "height", F.col("file").alias("picture"))
    return detection.prelabel(rows, make, "picture")["boxes"].select("file", "confidence", "cx", "cy")
