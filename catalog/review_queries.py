"""Box review and frame reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query
from framewright.operators import audit, boxes, pool, reports, review
from framewright.operators.ranking import chunk_number, first_listed, ordered_rank, sample_first, sheet_cell

SETTLED = """
    SELECT b.*, a.category, v.verdict AS human,
           coalesce(nullif(v.verdict, ''),
                    CASE WHEN a.category IS NULL OR a.category = 'error' THEN 'disputed'
                         WHEN a.category IN ('ad_surface', 'storefront_sign', 'vehicle_ad') THEN 'keep'
                         ELSE 'drop' END) AS fate
    FROM {boxes} b
    LEFT JOIN (SELECT box_id, arg_max(category, answered_at) AS category FROM {answers} GROUP BY box_id) a USING (box_id)
    LEFT JOIN (SELECT box_id, arg_max(verdict, given_at) AS verdict FROM {verdicts} GROUP BY box_id) v USING (box_id)"""

FATES = f"""
    WITH s AS ({SETTLED}),
    f AS (SELECT file, count(*) AS n, count(*) FILTER (fate = 'keep') AS kept, bool_or(fate = 'disputed') AS d
          FROM s GROUP BY file)
    SELECT file,
           CASE WHEN n IS NULL THEN 'no_boxes' WHEN d THEN 'disputed' WHEN kept = 0 THEN 'negative'
                WHEN kept = n THEN 'clean' ELSE 'fixed' END AS status,
           coalesce(n, 0) AS boxes_before, CASE WHEN d THEN 0 ELSE coalesce(kept, 0) END AS boxes_after
    FROM {{frames}} LEFT JOIN f USING (file)""".replace("{{", "{").replace("}}", "}")

REPORT = """
    SELECT file, width, height, coalesce(n, 0) AS boxes, coalesce(lo, 0.0) AS min_confidence,
           coalesce(hi, 0.0) AS max_confidence,
           CASE WHEN n IS NULL THEN 'empty' WHEN lo < 0.5 THEN 'weak' ELSE 'ok' END AS status
    FROM {frames} LEFT JOIN (SELECT file, count(*) AS n, min(confidence) AS lo, max(confidence) AS hi
                             FROM {boxes} GROUP BY file) USING (file)"""


def settled(d):
    return review.settle_boxes(d.boxes, d.answers, d.verdicts)


def fates(d, **kw):
    return review.frame_fates(d.frames, settled(d), **kw)


@query(
    "jn04_box_verdicts",
    f"SELECT box_id, file, category, human, fate FROM ({SETTLED})",
)
def jn04(d):
    return settled(d).select("box_id", "file", "category", "human", "fate")


@query(
    "prj11_box_fate",
    f"SELECT fate, coalesce(category, 'unanswered') AS category, count(*) AS boxes FROM ({SETTLED}) GROUP BY ALL",
)
def prj11(d):
    known = settled(d).withColumn("category", F.coalesce("category", F.lit("unanswered")))
    return known.groupBy("fate", "category").agg(F.count("*").alias("boxes"))


@query(
    "prj11_box_fate_error_dropped",
    """SELECT fate, count(*) AS boxes FROM (
         SELECT coalesce(nullif(v.verdict, ''), CASE WHEN a.category IS NULL THEN 'disputed'
                  WHEN a.category IN ('ad_surface', 'storefront_sign', 'vehicle_ad') THEN 'keep' ELSE 'drop' END) AS fate
         FROM {boxes} b LEFT JOIN (SELECT box_id, arg_max(category, answered_at) AS category
                                   FROM {answers} GROUP BY box_id) a USING (box_id)
         LEFT JOIN (SELECT box_id, arg_max(verdict, given_at) AS verdict FROM {verdicts} GROUP BY box_id) v USING (box_id)) GROUP BY fate""",
)
def prj11_strict(d):
    boxes_ = review.settle_boxes(d.boxes, d.answers, d.verdicts, error_as_unanswered=False)
    return boxes_.groupBy("fate").agg(F.count("*").alias("boxes"))


@query("ag05_frame_fates", FATES)
def ag05(d):
    return fates(d)


@query(
    "ag05_fate_totals",
    f"""SELECT status, count(*) AS frames, sum(boxes_before)::BIGINT AS boxes_before,
               sum(boxes_after)::BIGINT AS boxes_after FROM ({FATES}) GROUP BY status""",
)
def ag05_totals(d):
    return review.fate_totals(fates(d))


@query(
    "wn04_stride_negatives",
    f"""WITH f AS ({FATES}), r AS (SELECT file, row_number() OVER (ORDER BY file) AS n FROM f WHERE status = 'no_boxes')
        SELECT f.file, CASE WHEN r.n % 5 = 0 THEN 'negative' ELSE f.status END AS status, boxes_before, boxes_after
        FROM f LEFT JOIN r USING (file)""",
)
def wn04(d):
    return fates(d, empty_stride=5)


@query("jn05_pending_boxes", "SELECT box_id, file FROM {boxes} WHERE box_id NOT IN (SELECT box_id FROM {answers})")
def jn05(d):
    return review.pending_boxes(d.boxes, d.answers).select("box_id", "file")


@query("jn06_frames_without_boxes", "SELECT file FROM {frames} WHERE file NOT IN (SELECT file FROM {boxes})")
def jn06(d):
    return review.frames_without_boxes(d.frames, d.boxes).select("file")


OVERLAID = f"""
    SELECT f.file, CASE WHEN e.n IS NULL THEN f.status WHEN e.n = 0 THEN 'negative' ELSE 'from_export' END AS status,
           f.boxes_before, coalesce(e.n, f.boxes_after) AS boxes_after, e.n IS NOT NULL AS from_export
    FROM ({FATES}) f
    LEFT JOIN (SELECT concat(stem, '.jpg') AS file,
                      len(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '')) AS n FROM {{export}}) e USING (file)
""".replace("{{", "{").replace("}}", "}")


@query("jn13_export_overlay", OVERLAID)
def jn13(d):
    return review.overlay_export(fates(d), d.export)


@query(
    "jn13_export_totals",
    """SELECT count(*) AS frames, sum(n)::BIGINT AS boxes, count(*) FILTER (n = 0) AS empty FROM (
         SELECT len(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '')) AS n FROM {export})""",
)
def jn13_totals(d):
    return review.export_totals(d.export)


@query(
    "jn13_merged_labels",
    """SELECT stem, text FROM {export}
       UNION ALL SELECT DISTINCT replace(file, '.jpg', '') AS stem, 'old' AS text FROM {boxes}
       WHERE replace(file, '.jpg', '') NOT IN (SELECT stem FROM {export})""",
)
def jn13_labels(d):
    old = d.boxes.select(F.regexp_replace("file", r"\.jpg$", "").alias("stem"), F.lit("old").alias("text")).distinct()
    return review.merge_labels(old, d.export)


@query(
    "se03_queue_minus_export",
    f"""SELECT file, status FROM ({FATES}) WHERE status IN ('disputed', 'no_boxes')
        AND replace(file, '.jpg', '') NOT IN (SELECT stem FROM {{export}})""".replace("{{", "{").replace("}}", "}"),
)
def se03(d):
    return review.still_pending(review.human_queue(fates(d)), d.export)


@query("ag12_answers_by_category", "SELECT category, count(*) AS answers FROM {answers} GROUP BY category")
def ag12(d):
    return review.answers_by_category(d.answers)


@query(
    "so03_category_order",
    f"""SELECT box_id, category, confidence,
               row_number() OVER (PARTITION BY category ORDER BY confidence, box_id) AS position
        FROM (SELECT box_id, coalesce(category, 'unanswered') AS category, confidence FROM ({SETTLED}))""",
)
def so03(d):
    return review.category_order(settled(d))


LINE = "printf('0 %.6f %.6f %.6f %.6f', center_x, center_y, width, height)"


@query(
    "snk01_kept_lines",
    f"""WITH f AS ({FATES}), s AS ({SETTLED})
        SELECT f.file, replace(f.file, '.jpg', '') AS stem, s.index, s.box_id, s.line
        FROM f LEFT JOIN (SELECT *, {LINE} AS line FROM s WHERE fate = 'keep') s USING (file)
        WHERE f.status IN ('clean', 'fixed', 'negative')""",
)
def snk01(d):
    done = settled(d)
    return review.kept_lines(done, review.frame_fates(d.frames, done))


@query(
    "snk09_disputed_lines",
    f"""WITH s AS ({SETTLED})
        SELECT file, index, box_id, {LINE} AS line FROM s
        WHERE fate <> 'drop' AND file IN (SELECT file FROM s WHERE fate = 'disputed')""",
)
def snk09(d):
    return review.disputed_lines(settled(d))


@query("ag03_frame_report", REPORT)
def ag03(d):
    return reports.frame_report(d.frames, d.boxes)


@query(
    "prj07_frame_status",
    f"SELECT status, count(*) AS frames, min(min_confidence) AS lowest FROM ({REPORT}) GROUP BY status",
)
def prj07(d):
    report = reports.frame_report(d.frames, d.boxes)
    return report.groupBy("status").agg(F.count("*").alias("frames"), F.min("min_confidence").alias("lowest"))


@query(
    "ag04_status_counts",
    f"""SELECT s.status, count(r.file) AS frames FROM (VALUES ('empty'), ('weak'), ('ok')) s(status)
        LEFT JOIN ({REPORT}) r USING (status) GROUP BY s.status""",
)
def ag04(d):
    return reports.zero_filled_counts(reports.frame_report(d.frames, d.boxes), "status", ("empty", "weak", "ok"))


@query("flt01_confident_frames", f"SELECT file, min_confidence FROM ({REPORT}) WHERE status = 'ok'")
def flt01(d):
    return reports.confident(reports.frame_report(d.frames, d.boxes)).select("file", "min_confidence")


@query("flt02_frames_for_human", f"SELECT file, status FROM ({REPORT}) WHERE status <> 'ok'")
def flt02(d):
    return reports.needs_human(reports.frame_report(d.frames, d.boxes)).select("file", "status")


QUEUE = f"""
    SELECT file, status, min_confidence,
           row_number() OVER (ORDER BY CASE status WHEN 'empty' THEN 0 ELSE 1 END,
                              CASE status WHEN 'weak' THEN min_confidence ELSE 0 END, file) AS position
    FROM ({REPORT}) WHERE status <> 'ok'"""


@query("so01_review_order", QUEUE)
def so01(d):
    return reports.review_queue(reports.frame_report(d.frames, d.boxes))


@query(
    "so02_stored_review_order",
    QUEUE.replace("status, min_confidence,", "status, round_even(min_confidence, 4) AS min_confidence,").replace(
        "THEN min_confidence ELSE", "THEN round_even(min_confidence, 4) ELSE"
    ),
)
def so02(d):
    return reports.review_queue(reports.frame_report(d.frames, d.boxes), decimals=4)


@query("wn05_bundles", f"SELECT *, (position - 1) // 600 + 1 AS part FROM ({QUEUE})")
def wn05(d):
    return reports.bundles(reports.review_queue(reports.frame_report(d.frames, d.boxes)), size=600)


@query(
    "wn09_sheet_layout",
    """SELECT file, (n - 1) // 12 + 1 AS sheet, ((n - 1) % 12) // 4 + 1 AS row, (n - 1) % 4 + 1 AS "column"
       FROM (SELECT file, row_number() OVER (ORDER BY file) AS n FROM {frames}
             WHERE file NOT IN (SELECT file FROM {boxes}))""",
)
def wn09(d):
    missed = review.frames_without_boxes(d.frames, d.boxes).select("file")
    ranked = ordered_rank(missed, ["file"])
    cells = sheet_cell(F.col("rank"), columns=4, rows=3)
    return ranked.select("file", *[c.alias(n) for n, c in cells.items()])


@query(
    "wn06_numbered_boxes",
    """SELECT box_id, file, row_number() OVER (ORDER BY file, index, box_id) AS number,
              row_number() OVER (PARTITION BY file ORDER BY index, box_id) - 1 AS place FROM {boxes}""",
)
def wn06(d):
    base = d.boxes.select("box_id", "file", F.col("index").alias("line"))
    done = boxes.number_boxes(base, ["line", "box_id"])
    return done.select("box_id", "file", "number", F.col("index").alias("place"))


@query(
    "wn06_continued_numbers",
    """WITH a AS (SELECT *, row_number() OVER (ORDER BY file, index, box_id) AS number,
                         row_number() OVER (PARTITION BY file ORDER BY index, box_id) - 1 AS place
                  FROM {boxes} WHERE scan = 'F'),
            t AS (SELECT file, max(place) + 1 AS used FROM a GROUP BY file)
       SELECT b.box_id, b.file,
              row_number() OVER (ORDER BY b.file, b.index, b.box_id) + (SELECT max(number) FROM a) AS number,
              row_number() OVER (PARTITION BY b.file ORDER BY b.index, b.box_id) - 1 + coalesce(t.used, 0) AS place
       FROM {boxes} b LEFT JOIN t USING (file) WHERE b.scan = 'O'""",
)
def wn06_continued(d):
    lines = d.boxes.select("box_id", "file", F.col("index").alias("line"), "scan")
    first = boxes.number_boxes(lines.filter("scan = 'F'"), ["line", "box_id"])
    more = boxes.number_boxes(lines.filter("scan = 'O'"), ["line", "box_id"], after=first)
    return more.select("box_id", "file", "number", F.col("index").alias("place"))


@query(
    "wn03_thinned_negatives",
    """WITH p AS (SELECT stem, text FROM (
                    SELECT replace(file, '.jpg', '') AS stem, CASE WHEN status = 'empty' THEN '' ELSE '0 1' END AS text
                    FROM (REPORT))),
            e AS (SELECT stem, row_number() OVER (ORDER BY stem) AS n FROM p WHERE text = '')
       SELECT stem, text FROM p WHERE text <> '' UNION ALL SELECT stem, '' FROM e WHERE n % 3 = 0""".replace(
        "REPORT", REPORT
    ),
)
def wn03(d):
    report = reports.frame_report(d.frames, d.boxes)
    texts = report.select(
        F.regexp_replace("file", r"\.jpg$", "").alias("stem"),
        F.when(F.col("status") == "empty", "").otherwise("0 1").alias("text"),
    )
    return pool.thin_negatives(texts, stride=3, prefix="frame_")


@query(
    "so04_random_sample",
    """SELECT file FROM {frames} WHERE file NOT IN (SELECT file FROM {boxes})
       ORDER BY md5(concat('7:', file)), file LIMIT 40""",
)
def so04(d):
    return sample_first(review.frames_without_boxes(d.frames, d.boxes).select("file"), "file", 40, seed=7)


@query("so05_first_listed", "SELECT file FROM {frames} ORDER BY file LIMIT 100")
def so05(d):
    return first_listed(d.frames.select("file"), "file", 100)


@query(
    "so06_listing_order",
    "SELECT path, doc_id, row_number() OVER (ORDER BY path, doc_id) AS rank FROM {images}",
)
def so06(d):
    return ordered_rank(d.images.select("path", "doc_id"), ["path", "doc_id"])


@query("flt07_frames_without_parsed_boxes", f"SELECT file, boxes FROM ({REPORT}) WHERE boxes = 0")
def flt07(d):
    return reports.frame_report(d.frames, d.boxes).filter("boxes = 0").select("file", "boxes")


@query(
    "snk08_task_parts",
    f"SELECT part, count(*) AS frames, min(file) AS first_file FROM (SELECT *, (position - 1) // 600 + 1 AS part FROM ({QUEUE})) GROUP BY part",
)
def snk08(d):
    queue = reports.review_queue(reports.frame_report(d.frames, d.boxes))
    parts = queue.withColumn("part", chunk_number(F.col("position"), 600))
    return parts.groupBy("part").agg(F.count("*").alias("frames"), F.min("file").alias("first_file"))


@query(
    "audit_unknown_verdicts",
    """SELECT 'unknown_verdict' AS kind, box_id AS item FROM {verdicts}
       WHERE verdict NOT IN ('', 'keep', 'drop', 'disputed')""",
)
def unknown(d):
    return audit.unknown_verdicts(d.verdicts)
