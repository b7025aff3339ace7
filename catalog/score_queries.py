"""Scorecards, run comparison, folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query
from framewright import schemas as C
from framewright.functions import requests
from framewright.operators import scoring

T = "('beeline', 'megafon', 'mts', 'tele2', 'volna', 'miranda', 'plus7')"
NAMES = "(VALUES ('beeline'), ('megafon'), ('mts'), ('tele2'), ('volna'), ('miranda'), ('plus7'), ('other')) t(name)"


def card(rows: str) -> str:
    return f"""
    SELECT name, count(*) FILTER (truth = name AND decided = name) AS hits, count(*) FILTER (truth = name) AS total,
           count(*) FILTER (decided = name AND truth <> name AND name <> 'other') AS false_positives
    FROM {NAMES} LEFT JOIN {rows} r ON r.truth = name OR r.decided = name GROUP BY name"""


@query("flt06_graded_rows", "SELECT file, truth, decided FROM {run_one} WHERE truth <> ''")
def flt06(d):
    return scoring.graded(d.run_one).select("file", "truth", "decided")


@query(
    "jn09_truth_by_file_or_stem",
    """WITH listed AS (SELECT CASE WHEN lang = 'en' THEN file ELSE replace(file, '.jpg', '') END AS file, lang AS brand, 1 AS listed_at
                       FROM {samples} WHERE labelling <> 'unlabelled'
                       UNION ALL SELECT file, 'again', 2 FROM {samples} WHERE labelling <> 'unlabelled' AND n_chars % 7 = 0),
            truth AS (SELECT file, arg_max(brand, listed_at) AS brand FROM listed GROUP BY file)
       SELECT a.file, coalesce(t.brand, s.brand, '') AS truth FROM {samples} a LEFT JOIN truth t ON t.file = a.file
       LEFT JOIN truth s ON s.file = replace(a.file, '.jpg', '')""",
)
def jn09(d):
    known = d.samples.filter("labelling <> 'unlabelled'")
    name = F.when(F.col("lang") == "en", F.col("file")).otherwise(F.regexp_replace("file", r"\.jpg$", ""))
    truth = known.select(name.alias("file"), F.col("lang").alias("brand"), F.lit(1).alias("listed_at"))
    again = known.filter("n_chars % 7 = 0").select("file", F.lit("again").alias("brand"), F.lit(2).alias("listed_at"))
    truth = truth.unionByName(again)
    return scoring.with_truth(d.samples.select("file"), truth).select("file", "truth")


@query(
    "ag14_answer_shares",
    "SELECT decided, count(*) AS answers, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM {run_one} GROUP BY decided",
)
def ag14(d):
    return scoring.answer_shares(d.run_one).withColumn("share", F.round("share", 6))


@query(
    "ag14_answers_by_basis",
    "SELECT basis, count(*) AS answers, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM {run_one} GROUP BY basis",
)
def ag14_basis(d):
    return scoring.answer_shares(d.run_one, "basis").withColumn("share", F.round("share", 6))


@query(
    "ag15_accuracy",
    """SELECT count(*) AS graded, count(*) FILTER (decided = truth) AS "right", count(*) FILTER (brand = truth) AS right_raw,
              round(avg((decided = truth)::INT), 6) AS accuracy, round(avg((brand = truth)::INT), 6) AS accuracy_raw
       FROM {run_one} WHERE truth <> ''""",
)
def ag15(d):
    result = scoring.accuracy(d.run_one)
    return result.withColumns({c: F.round(c, 6) for c in ("accuracy", "accuracy_raw")})


@query("ag16_scorecard", f"SELECT *, round(coalesce(hits / nullif(total, 0), 0), 6) AS share FROM ({card('{run_one_graded}')})")
def ag16(d):
    return scoring.scorecard(d.run_one_graded, C.TARGETS).withColumn("share", F.round("share", 6))


@query(
    "ag17_score_totals",
    f"""SELECT count(*) FILTER (decided = truth AND truth IN ('other', 'beeline', 'megafon', 'mts', 'tele2', 'volna', 'miranda', 'plus7')) AS correct,
               count(*) AS graded, count(*) FILTER (decided <> truth AND decided IN {T}) AS invented FROM {{run_one}} WHERE truth <> ''""",
)
def ag17(d):
    return scoring.score_totals(d.run_one_graded, C.TARGETS)


COMMON_ONE = "(SELECT * FROM {run_one_graded} WHERE file IN (SELECT file FROM {run_two_graded}))"
COMMON_TWO = "(SELECT * FROM {run_two_graded} WHERE file IN (SELECT file FROM {run_one_graded}))"


@query(
    "ag18_run_comparison",
    f"""SELECT name, a.hits AS hits_before, b.hits AS hits_after, a.total AS total_before, b.total AS total_after,
               a.false_positives AS false_before, b.false_positives AS false_after, b.hits - a.hits AS shift
        FROM ({card(COMMON_ONE)}) a JOIN ({card(COMMON_TWO)}) b USING (name)""",
)
def ag18(d):
    return scoring.compare_runs(d.run_one_graded, d.run_two_graded, C.TARGETS)


@query(
    "ag18_comparison_totals",
    f"""SELECT (SELECT count(*) FROM {{run_one_graded}} a JOIN {{run_two_graded}} b USING (file)) AS common,
               sum(a.hits)::BIGINT AS hits_before, sum(b.hits)::BIGINT AS hits_after,
               sum(a.false_positives)::BIGINT AS false_before, sum(b.false_positives)::BIGINT AS false_after
        FROM ({card(COMMON_ONE)}) a JOIN ({card(COMMON_TWO)}) b USING (name)""",
)
def ag18_totals(d):
    return scoring.comparison_totals(d.run_one_graded, d.run_two_graded, C.TARGETS)


@query(
    "ag14_failures",
    "SELECT count(*) AS answers, count(*) FILTER (n_chars % 11 = 0) AS failed FROM {samples}",
)
def ag14_failures(d):
    error = F.when(F.col("n_chars") % 11 == 0, "timeout").when(F.col("n_chars") % 2 == 0, "")
    return scoring.failures(d.samples.select("file", error.alias("error")))


@query(
    "ml08_request_bodies",
    """SELECT file, concat('{{"model":"small","messages":[{{"role":"user","content":[{{"type":"image_url","image_url":{{"url":"data:image/jpeg;base64,',
              base64(encode(content)), '"}}}},{{"type":"text","text":"Whose sign is this?"}}]}}],',
              '"response_format":{{"type":"json_schema","json_schema":{{"name":"brand","schema":{{"type":"object","properties":',
              '{{"brand":{{"type":"string"}},"basis":{{"type":"string"}},"evidence":{{"type":"string"}},"visible_text":{{"type":"string"}}}},',
              '"required":["brand","basis","evidence","visible_text"],"additionalProperties":false}},"strict":true}}}},',
              '"temperature":0.0,"max_tokens":400,"chat_template_kwargs":{{"enable_thinking":false}}}}') AS body FROM {samples}""",
)
def ml08_bodies(d):
    schema = requests.answer_schema(requests.BRAND_FIELDS)
    body = requests.chat_request(F.col("content").cast("binary"), "Whose sign is this?", schema, name="brand", model="small")
    return d.samples.select("file", body.alias("body"))


@query(
    "ag18_changed_decisions",
    """SELECT a.file, a.truth, a.decided AS before, b.decided AS after,
              CASE WHEN b.decided = a.truth THEN 'fixed' WHEN a.decided = a.truth THEN 'broken' ELSE 'still_wrong' END AS mark
       FROM {run_one_graded} a JOIN {run_two_graded} b USING (file) WHERE a.decided <> b.decided""",
)
def ag18_changes(d):
    return scoring.changed_decisions(d.run_one_graded, d.run_two_graded)


@query(
    "jn10_run_coverage",
    """SELECT count(*) FILTER (a.file IS NOT NULL AND b.file IS NOT NULL) AS common, count(a.file) AS before, count(b.file) AS after
       FROM {run_one} a FULL JOIN {run_two} b ON a.file = b.file""",
)
def jn10(d):
    return scoring.run_coverage(d.run_one, d.run_two)


@query("se02_common_files", "SELECT file FROM {run_one} INTERSECT SELECT file FROM {run_two}")
def se02(d):
    return d.run_one.select("file").intersect(d.run_two.select("file"))


@query(
    "ag19_precision_recall",
    f"""SELECT *, round(correct / nullif(called, 0), 6) AS "precision", round(found / nullif(present, 0), 6) AS recall FROM (
          SELECT count(*) FILTER (decided IN {T}) AS called, count(*) FILTER (decided IN {T} AND decided = truth) AS correct,
                 count(*) FILTER (truth IN {T}) AS present, count(*) FILTER (truth IN {T} AND decided = truth) AS found
          FROM {{run_one}} WHERE truth <> '')""",
)
def ag19(d):
    result = scoring.precision_recall(d.run_one, C.TARGETS)
    return result.withColumns({c: F.round(c, 6) for c in ("precision", "recall")})


@query(
    "ag20_confusion",
    """SELECT name AS truth, beeline, megafon, tele2, other,
              round(coalesce(CASE name WHEN 'beeline' THEN beeline WHEN 'megafon' THEN megafon WHEN 'tele2' THEN tele2 ELSE other END
                    / nullif(beeline + megafon + tele2 + other, 0), 0), 6) AS right_share
       FROM (SELECT name, count(*) FILTER (decided = 'beeline') AS beeline, count(*) FILTER (decided = 'megafon') AS megafon,
                    count(*) FILTER (decided = 'tele2') AS tele2, count(*) FILTER (decided = 'other') AS other
             FROM (VALUES ('beeline'), ('megafon'), ('tele2'), ('other')) t(name) LEFT JOIN {run_one} r ON r.truth = name GROUP BY name)""",
)
def ag20(d):
    table = scoring.confusion(d.run_one.select("truth", F.col("decided").alias("guess")), C.HEAD_CLASSES)
    return table.withColumn("right_share", F.round("right_share", 6))


F1 = """
    WITH p AS (SELECT lang AS fold, truth, decided AS guess FROM {run_one_graded}),
         c AS (SELECT fold, name, count(*) FILTER (truth = name AND guess = name) AS tp, count(*) FILTER (truth = name) AS t,
                      count(*) FILTER (guess = name) AS g
               FROM p JOIN (SELECT DISTINCT fold AS f, name FROM (SELECT fold, truth AS name FROM p UNION SELECT fold, guess FROM p)) n
                 ON n.f = p.fold GROUP BY fold, name)
    SELECT fold, avg(2 * tp / (t + g)) AS f1 FROM c GROUP BY fold"""


@query("ag21_macro_f1", f"SELECT fold, round(f1, 6) AS f1 FROM ({F1})")
def ag21(d):
    rows = d.run_one_graded.select(F.col("lang").alias("fold"), "truth", F.col("decided").alias("guess"))
    return scoring.macro_f1(rows, ["fold"]).withColumn("f1", F.round("f1", 6))


ARMS = """
    WITH r AS (SELECT *, concat(lang, 'x') AS source FROM {run_one_graded}),
         p AS (SELECT 'raw' AS arm, lang AS fold, source AS repeat, truth, brand AS guess FROM r
               UNION ALL SELECT 'checked', lang, source, truth, decided FROM r
               UNION ALL SELECT 'shortcut', lang, source, truth, 'other' FROM r),
         n AS (SELECT DISTINCT arm, fold, repeat, name FROM (SELECT arm, fold, repeat, truth AS name FROM p UNION SELECT arm, fold, repeat, guess FROM p)),
         c AS (SELECT arm, fold, repeat, name, count(*) FILTER (truth = name AND guess = name) AS tp, count(*) FILTER (truth = name) AS t,
                      count(*) FILTER (guess = name) AS g FROM p JOIN n USING (arm, fold, repeat) GROUP BY ALL),
         s AS (SELECT arm, fold, repeat, avg(2 * tp / (t + g)) AS f1 FROM c GROUP BY arm, fold, repeat)
    SELECT s.arm, count(*) AS folds, round(avg(s.f1), 6) AS mean, round(stddev_pop(s.f1), 6) AS spread, round(avg(s.f1 - b.f1), 6) AS gain,
           round(stddev_pop(s.f1 - b.f1), 6) AS gain_spread, s.arm = 'shortcut' AND avg(s.f1) > 0.5 AS suspicious
    FROM s JOIN s b ON b.arm = 'raw' AND b.fold = s.fold AND b.repeat = s.repeat GROUP BY s.arm"""


@query("ag22_arm_summary", ARMS)
def ag22(d):
    run = d.run_one_graded
    rows = None
    for arm, guess in (("raw", F.col("brand")), ("checked", F.col("decided")), ("shortcut", F.lit("other"))):
        part = run.select(
            F.lit(arm).alias("arm"), F.col("lang").alias("fold"), F.concat("lang", F.lit("x")).alias("repeat"),
            "truth", guess.alias("guess"),
        )
        rows = part if rows is None else rows.unionByName(part)
    scores = scoring.macro_f1(rows, ["arm", "repeat", "fold"])
    table = scoring.arm_summary(scores, "raw")
    return table.withColumns({c: F.round(c, 6) for c in ("mean", "spread", "gain", "gain_spread")})


@query("ag13_frames_per_brand", "SELECT truth AS brand, count(*) AS frames FROM {run_one_graded} GROUP BY truth")
def ag13(d):
    return d.run_one_graded.groupBy(F.col("truth").alias("brand")).agg(F.count("*").alias("frames"))
