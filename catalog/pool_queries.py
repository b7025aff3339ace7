"""Pools, splits, scenes and the audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query
from framewright.functions import naming as N
from framewright.operators import audit, boxes, pool, scenes, splits
from framewright.operators.ranking import ordered_rank

# --- pools ---------------------------------------------------------------

JOINED = """
    SELECT l.stem, l.text, i.path FROM (SELECT DISTINCT stem, label_text AS text FROM {samples} WHERE label_text IS NOT NULL) l
    JOIN (SELECT stem, max(path) AS path FROM {images} GROUP BY stem) i USING (stem)"""


def texts(d):
    return d.samples.filter("label_text IS NOT NULL").select("stem", F.col("label_text").alias("text")).distinct()


@query("jn01_labelled_samples", JOINED)
def jn01(d):
    return pool.labelled_samples(d.images, texts(d))


@query(
    "jn02_confident_samples",
    """SELECT DISTINCT concat(stem, '.jpg') AS file, stem FROM {samples} WHERE stem IN (SELECT stem FROM {samples} WHERE label_text IS NOT NULL)""",
)
def jn02(d):
    names = d.samples.select(F.concat("stem", F.lit(".jpg")).alias("file")).distinct()
    return pool.confident_samples(names, d.images, texts(d))


@query(
    "jn03_negative_source",
    """SELECT i.stem, i.path, coalesce(l.text, '') AS text FROM (SELECT stem, max(path) AS path FROM {images} GROUP BY stem) i
       LEFT JOIN (SELECT stem, min(label_text) AS text FROM {samples} WHERE label_text IS NOT NULL GROUP BY stem) l USING (stem)""",
)
def jn03(d):
    one = d.samples.filter("label_text IS NOT NULL").groupBy("stem").agg(F.min("label_text").alias("text"))
    return pool.labelled_samples(d.images, one, negative_source=True)


@query(
    "se01_united_pools",
    """SELECT doc_id, 'human' AS source, 0 AS priority FROM {samples} WHERE labelling = 'positive'
       UNION ALL SELECT doc_id, 'confident', 1 FROM {samples} WHERE labelling = 'unlabelled'
       UNION ALL SELECT doc_id, 'negatives', 2 FROM {samples} WHERE labelling = 'negative'""",
)
def se01(d):
    s = d.samples.select("doc_id", "labelling")
    part = lambda kind: s.filter(F.col("labelling") == kind).select("doc_id")
    united = pool.unite([("human", part("positive")), ("confident", part("unlabelled")), ("negatives", part("negative"))])
    return united.select("doc_id", "source", "priority")


def _pool_rows(d):
    return d.samples.select("doc_id", "stem", "file", "lang", pool.content_key(F.col("content")).alias("content_key"))


@query(
    "wn12_ordered_dedupe",
    """WITH RECURSIVE p AS (SELECT doc_id, stem, content, row_number() OVER (ORDER BY doc_id) AS n FROM {samples}),
            walk AS (SELECT 0::BIGINT AS n, []::VARCHAR[] AS stems, []::VARCHAR[] AS contents, -1::BIGINT AS kept
                     UNION ALL
                     SELECT p.n, CASE WHEN ok THEN list_append(stems, p.stem) ELSE stems END,
                            CASE WHEN ok THEN list_append(contents, md5(p.content)) ELSE contents END,
                            CASE WHEN ok THEN p.doc_id ELSE -1 END
                     FROM (SELECT w.*, NOT list_contains(stems, p.stem) AND NOT list_contains(contents, md5(p.content)) AS ok,
                                  p.n AS pn FROM walk w JOIN p ON p.n = w.n + 1) w JOIN p ON p.n = w.pn)
       SELECT kept AS doc_id FROM walk WHERE kept >= 0""",
)
def wn12(d):
    return pool.first_wins(_pool_rows(d), ["doc_id"], ["stem", "content_key"]).select("doc_id")


@query("flt03_holdout_prefix", "SELECT stem, label_text AS text FROM {samples} WHERE starts_with(stem, 'fr_') AND label_text IS NOT NULL")
def flt03(d):
    labels = d.samples.filter("label_text IS NOT NULL").select("stem", F.col("label_text").alias("text"))
    return pool.holdout(labels, "fr_")


@query("flt04_skip_list", "SELECT file FROM {frames} WHERE file NOT IN (SELECT concat(stem, '.jpg') FROM {export})")
def flt04(d):
    skip = d.export.select(F.concat("stem", F.lit(".jpg")).alias("file"))
    return pool.without_skipped(d.frames.select("file"), skip)


@query(
    "wn11_numbered_negatives",
    """SELECT file, number FROM (SELECT file, row_number() OVER (ORDER BY file) AS number FROM {frames})
       WHERE file NOT IN (SELECT concat(stem, '.jpg') FROM {export})""",
)
def wn11(d):
    skip = d.export.select(F.concat("stem", F.lit(".jpg")).alias("file"))
    return pool.numbered_negatives(d.frames, skip)


@query(
    "ag06_frames_per_source",
    """SELECT source, count(DISTINCT md5(content)) AS frames FROM {samples} GROUP BY source""",
)
def ag06(d):
    keyed = d.samples.select("source", "doc_id", pool.content_key(F.col("content")).alias("content_key"))
    # duplicates count only inside their own source
    scoped = keyed.withColumn("content_key", F.concat_ws("/", "source", "content_key"))
    return pool.first_wins(scoped, ["doc_id"], ["content_key"]).groupBy("source").agg(F.count("*").alias("frames"))


# --- splits --------------------------------------------------------------

SPLIT = """
    SELECT doc_id, file, lang, labelling, source, label_text AS text,
           CASE WHEN n < 3 THEN 'train' WHEN r <= v THEN 'val' WHEN r <= v + t THEN 'test' ELSE 'train' END AS split
    FROM (SELECT *, CASE WHEN x <= 0 THEN v0 WHEN t0 > v0 AND x <= t0 - v0 THEN v0 WHEN v0 > t0 AND x <= v0 - t0 THEN v0 - x
                         ELSE ceil((n - 1) / 2) END AS v,
                    CASE WHEN x <= 0 THEN t0 WHEN t0 > v0 AND x <= t0 - v0 THEN t0 - x WHEN v0 > t0 AND x <= v0 - t0 THEN t0
                         ELSE floor((n - 1) / 2) END AS t
          FROM (SELECT *, v0 + t0 - (n - 1) AS x
                FROM (SELECT *, greatest(1, round_even(n * 0.15e0, 0)) AS v0, greatest(1, round_even(n * 0.15e0, 0)) AS t0
                      FROM (SELECT *, count(*) OVER (PARTITION BY lang, source, labelling) AS n,
                                   row_number() OVER (PARTITION BY lang, source, labelling ORDER BY md5(concat('0:', file)), file) AS r
                            FROM {samples}))))"""


def split(d):
    rows = d.samples.select("doc_id", "file", "lang", "labelling", "source", F.col("label_text").alias("text"))
    return splits.stratified_split(rows, stratum=["lang", "source", "labelling"], key="file")


@query("wn02_stratified_split", f"SELECT doc_id, lang, source, labelling, split FROM ({SPLIT})")
def wn02(d):
    return split(d).select("doc_id", "lang", "source", "labelling", "split")


COUNTS = f"""
    SELECT split, count(*) AS frames, count(*) FILTER (coalesce(trim(text, ' ' || chr(10)), '') = '') AS empty,
           round(count(*) FILTER (coalesce(trim(text, ' ' || chr(10)), '') = '') / count(*), 6) AS empty_share
    FROM ({SPLIT}) GROUP BY split"""


@query("ag01_split_counts", COUNTS)
def ag01(d):
    return splits.split_counts(split(d)).withColumn("empty_share", F.round("empty_share", 6))


@query(
    "ag02_human_part",
    f"""SELECT split, count(*) AS frames FROM (SELECT split FROM ({SPLIT}) UNION ALL
        SELECT 'test_handmade' FROM ({SPLIT}) WHERE split = 'test' AND labelling = 'positive') GROUP BY split""",
)
def ag02(d):
    rows = split(d).withColumn("handmade", F.col("labelling") == "positive")
    return splits.with_human_part(rows, "test_handmade").groupBy("split").agg(F.count("*").alias("frames"))


@query(
    "ag07_stratum_tally",
    f"""SELECT lang, labelling, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'val') AS val,
               count(*) FILTER (split = 'test') AS test FROM ({SPLIT}) GROUP BY lang, labelling""",
)
def ag07(d):
    return splits.tally(split(d), ["lang", "labelling"], ["train", "val", "test"])


@query(
    "prj09_empty_share",
    """SELECT lang, coalesce(count(*) FILTER (labelling = 'negative') / nullif(count(*) FILTER (labelling <> 'unlabelled'), 0), 0)::DECIMAL(9,6)::DOUBLE
              AS empty_share FROM {samples} GROUP BY lang""",
)
def prj09(d):
    counts = d.samples.groupBy("lang").agg(
        F.count_if(F.col("labelling") == "negative").alias("empty"),
        F.count_if(F.col("labelling") != "unlabelled").alias("frames"),
    )
    share = F.coalesce(F.try_divide("empty", "frames"), F.lit(0.0))
    return counts.select("lang", F.round(share, 6).alias("empty_share"))


PARTS = """
    SELECT file, CASE WHEN kind IN ('ECONOMY', 'SMALL') THEN 'val' WHEN kind = 'PROMO' THEN 'test' ELSE 'train' END AS split,
           regexp_replace(regexp_replace(regexp_replace(file, '[.][^.]*$', ''), '_aug$', ''), '^truckaug_', 'truck_') AS pair_key,
           regexp_matches(file, '_aug[.]|^truckaug_') AS is_copy
    FROM {named}"""


def parts(d):
    kind = F.col("kind")
    part = F.when(kind.isin("ECONOMY", "SMALL"), "val").when(kind == "PROMO", "test").otherwise("train")
    return d.named.select("file", part.alias("split"))


@query(
    "jn12_copies_follow_originals",
    f"""WITH p AS ({PARTS}), h AS (SELECT pair_key, max(split) AS home FROM p WHERE NOT is_copy GROUP BY pair_key)
        SELECT file, CASE WHEN is_copy THEN coalesce(home, split) ELSE split END AS split FROM p LEFT JOIN h USING (pair_key)""",
)
def jn12(d):
    return splits.follow_originals(parts(d))


@query("flt05_copies_only_in_train", f"SELECT file, split FROM ({PARTS}) WHERE NOT is_copy OR split = 'train'")
def flt05(d):
    return splits.copies_only_in_train(parts(d))


@query(
    "se04_holdout_apart",
    f"""SELECT split, count(*) AS frames, count(DISTINCT lang) AS langs FROM (
          SELECT 'holdout' AS split, lang FROM {{samples}} WHERE lang = 'fr' UNION ALL
          SELECT split, lang FROM ({SPLIT}) WHERE lang <> 'fr') GROUP BY split""",
)
def se04(d):
    rows = d.samples.select("doc_id", "file", "lang", "labelling", "source", F.col("label_text").alias("text"))
    rest = rows.filter("lang <> 'fr'")
    away = rows.filter("lang = 'fr'").withColumn("split", F.lit("holdout"))
    joined = splits.stratified_split(rest, stratum=["lang", "source", "labelling"], key="file").unionByName(away)
    return joined.groupBy("split").agg(F.count("*").alias("frames"), F.countDistinct("lang").alias("langs"))


@query(
    "se04_holdout_overlap",
    """SELECT stem FROM {samples} WHERE lang = 'fr' AND n_chars IN (SELECT n_chars FROM {samples} WHERE lang <> 'fr')""",
)
def se04_overlap(d):
    s = d.samples.select("stem", "n_chars", "lang")
    return audit.holdout_overlap(s.filter("lang <> 'fr'"), s.filter("lang = 'fr'"), "n_chars").select("stem")


@query(
    "wn07_group_sample",
    """SELECT file, source FROM (SELECT file, source, row_number() OVER (PARTITION BY source ORDER BY md5(concat('3:', file)), file) AS r
                                 FROM {samples})
       WHERE (source = 'src1' AND r <= 20) OR (source = 'src2' AND r <= 1000000000) OR (source = 'src7' AND r <= 8) OR source = 'src9'""",
)
def wn07(d):
    limits = {"src1": 20, "src2": 1_000_000_000, "src7": 8, "src9": 0}
    return splits.sample_groups(d.samples.select("file", "source"), group="source", key="file", limits=limits, seed=3)


BLIND = """
    WITH n AS (SELECT file, row_number() OVER (ORDER BY md5(concat('5:', file)), file) AS number FROM {samples}),
         k AS (SELECT file, lang AS brand, source, '' AS quality, 0 AS place FROM {samples} WHERE labelling = 'positive'
               UNION ALL SELECT file, 'second', source, CAST(n_chars AS string), 1 FROM {samples} WHERE lang <> 'en'),
         f AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY file ORDER BY place) = 1)
    SELECT printf('img_%04d.jpg', number) AS file, coalesce(brand, '') AS brand, coalesce(source, '') AS source,
           coalesce(quality, '') AS quality, n.file AS original
    FROM n LEFT JOIN f USING (file)"""


@query("wn08_blinded_names", BLIND)
def wn08(d):
    s = d.samples
    first = s.filter("labelling = 'positive'").select("file", F.col("lang").alias("brand"), "source")
    second = s.filter("lang <> 'en'").select(
        "file", F.lit("second").alias("brand"), "source", F.col("n_chars").cast("string").alias("quality")
    )
    return splits.blind(s, [("b_table", second), ("a_table", first)], seed=5)


@query(
    "jn14_first_known_table",
    f"SELECT original, brand, source FROM ({BLIND})",
)
def jn14(d):
    return wn08(d).select("original", "brand", "source")


@query(
    "prj22_blinded_names",
    f"SELECT file, original FROM ({BLIND})",
)
def prj22(d):
    return wn08(d).select("file", "original")


@query(
    "wn10_group_folds",
    """WITH v AS (SELECT source, quality, count(*) AS n FROM {samples} WHERE quality IS NOT NULL GROUP BY ALL),
            m AS (SELECT source, arg_max(quality, n * 1000 - quality) AS class, sum(n) AS size FROM v GROUP BY source),
            r AS (SELECT source, row_number() OVER (PARTITION BY class ORDER BY size DESC, md5(concat('0:', source)), source) - 1 AS r FROM m)
       SELECT doc_id, source, (r % 5)::INT AS fold FROM {samples} JOIN r USING (source) WHERE quality IS NOT NULL""",
)
def wn10(d):
    rows = d.samples.filter("quality IS NOT NULL").select("doc_id", "source", "quality")
    return splits.group_folds(rows, group="source", label="quality", key="doc_id", folds=5).select("doc_id", "source", "fold")


# --- scenes --------------------------------------------------------------

NUMBERED = """
    SELECT recording, event_id, sum(cut) OVER (PARTITION BY recording ORDER BY seconds, file) AS scene
    FROM (SELECT *, CASE WHEN coalesce(seconds - lag(seconds) OVER (PARTITION BY recording ORDER BY seconds, file) >= 21600, true)
                         THEN 1 ELSE 0 END AS cut FROM {recordings})"""


@query("wn01_scene_numbers", f"SELECT recording, event_id, scene::BIGINT AS scene FROM ({NUMBERED})")
def wn01(d):
    return scenes.number_scenes(d.recordings, gap=21600.0).select("recording", "event_id", "scene")


VIDEO = """
    SELECT *, CASE WHEN s > 0 THEN round_even(n / s, 0)::BIGINT END AS recording, CASE WHEN s > 0 THEN s END AS seconds
    FROM (SELECT event_id, file, event_type, regexp_extract(file, '^frame_(\\d+)_t(\\d+\\.\\d+)', 1)::DOUBLE AS n,
                 regexp_extract(file, '^frame_(\\d+)_t(\\d+\\.\\d+)', 2)::DOUBLE AS s FROM {video})"""
SCENES = f"""
    SELECT concat('video:', recording, ':', sum(cut) OVER (PARTITION BY recording ORDER BY seconds, file)::BIGINT) AS scene_key,
           event_id, file, seconds, event_type
    FROM (SELECT *, CASE WHEN coalesce(seconds - lag(seconds) OVER (PARTITION BY recording ORDER BY seconds, file) >= 0.5e0, true)
                         THEN 1 ELSE 0 END AS cut FROM ({VIDEO}) WHERE seconds IS NOT NULL)
    UNION ALL
    SELECT concat('still:', replace(replace(file, '.jpg', ''), '_aug', '')), event_id, file, seconds, event_type
    FROM ({VIDEO}) WHERE seconds IS NULL"""
SCENE_ROWS = f"""
    SELECT scene_key, frames, first_file, 'frame' AS "group", round(m, 6) AS mean_boxes,
           CASE WHEN m < 0.5 THEN '0' WHEN m < 1.5 THEN '1' WHEN m < 3.5 THEN '2-3' ELSE '4+' END AS density
    FROM (SELECT scene_key, count(*) AS frames, arg_min(file, (coalesce(seconds, 0), file)) AS first_file,
                 avg(length(event_type) - 4) AS m FROM ({SCENES}) GROUP BY scene_key)"""


def keyed(d):
    moment = N.video_moment(F.col("file"))
    rows = d.video.withColumns(moment).withColumn("n_boxes", F.length("event_type") - 4)
    return scenes.scene_keys(rows, gap=0.5, span=20.0)


@query("wn01_scene_keys", f"SELECT event_id, scene_key FROM ({SCENES})")
def wn01_keys(d):
    return keyed(d).select("event_id", "scene_key")


@query("prj08_scene_density", SCENE_ROWS)
def prj08(d):
    return scenes.scene_table(keyed(d)).withColumn("mean_boxes", F.round("mean_boxes", 6))


# --- audit ---------------------------------------------------------------

LINES = """
    SELECT source, n AS line_no, list_filter(string_split(trim(line), ' '), lambda t: t <> '') AS t
    FROM (SELECT concat(split, '/', name) AS source, unnest(string_split(text, chr(10))) AS line,
                 generate_subscripts(string_split(text, chr(10)), 1) AS n FROM {set_labels})
    WHERE trim(line) <> ''"""
PARSED = f"""
    SELECT source, line_no, len(t) AS tokens, TRY_CAST(t[1] AS INT) AS class_id, TRY_CAST(t[2] AS DOUBLE) AS cx,
           TRY_CAST(t[3] AS DOUBLE) AS cy, TRY_CAST(t[4] AS DOUBLE) AS w, TRY_CAST(t[5] AS DOUBLE) AS h FROM ({LINES})"""
LINE_FINDINGS = f"""
    WITH p AS (SELECT *, concat(source, ':', line_no) AS item,
                      tokens = 5 AND class_id IS NOT NULL AND cx + cy + w + h IS NOT NULL AS good FROM ({PARSED}))
    SELECT 'bad_line' AS kind, item FROM p WHERE NOT good
    UNION ALL SELECT 'bad_line', concat(item, ' class ', class_id) FROM p WHERE good AND class_id <> 0
    UNION ALL SELECT 'out_of_range', item FROM p WHERE good AND (least(cx, cy, w, h) < 0 OR greatest(cx, cy, w, h) > 1)
    UNION ALL SELECT 'degenerate', item FROM p WHERE good AND (w <= 0 OR h <= 0 OR w * h < 1e-6)"""


def label_lines(d):
    return d.set_labels.select(F.concat("split", F.lit("/"), "name").alias("source"), "text")


@query("flt09_line_findings", LINE_FINDINGS)
def flt09(d):
    return audit.line_findings(label_lines(d))


@query(
    "src03_parsed_boxes",
    f"SELECT source, line_no, class_id, cx, cy, w, h FROM ({PARSED}) WHERE tokens = 5 AND cx + cy + w + h IS NOT NULL",
)
def src03(d):
    return audit.read_boxes(label_lines(d)).withColumn("line_no", F.col("line_no").cast("bigint"))


@query(
    "src04_has_boxes",
    """SELECT doc_id, label_text IS NOT NULL AND trim(label_text, ' ' || chr(10)) <> '' AS has_boxes, labelling FROM {samples}""",
)
def src04(d):
    return d.samples.select("doc_id", pool.has_boxes(F.col("label_text")).alias("has_boxes"), "labelling")


@query(
    "ag08_boxes_per_split",
    f"""WITH t AS (SELECT split, replace(name, '.txt', '') AS stem, max(len(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> ''))) AS n
                   FROM {{set_labels}} GROUP BY ALL)
        SELECT i.split, coalesce(sum(n), 0)::BIGINT AS boxes, count(*) AS frames, round(coalesce(sum(n), 0) / count(*), 6) AS mean_boxes
        FROM {{set_images}} i LEFT JOIN t ON t.split = i.split AND t.stem = replace(i.name, '.jpg', '')
        WHERE i.content IS NOT NULL GROUP BY i.split""",
)
def ag08(d):
    return audit.box_totals(d.set_images.filter("content IS NOT NULL"), d.set_labels).withColumn("mean_boxes", F.round("mean_boxes", 6))


@query(
    "ag08_three_box_counts",
    f"""WITH p AS (SELECT * FROM ({PARSED})), s AS (SELECT concat(split, '/', name) AS source FROM {{set_labels}}),
             c AS (SELECT source, count(*) AS f, count(*) FILTER (tokens = 5) AS t,
                          count(*) FILTER (tokens = 5 AND class_id = 0 AND cx BETWEEN 0 AND 1 AND cy BETWEEN 0 AND 1 AND w BETWEEN 0 AND 1
                                           AND h BETWEEN 0 AND 1 AND w > 0 AND h > 0 AND w * h >= 1e-6) AS v FROM p GROUP BY source)
        SELECT source, coalesce(f, 0) AS filled_lines, coalesce(t, 0) AS five_token_lines, coalesce(v, 0) AS valid_lines
        FROM (SELECT DISTINCT source FROM s) LEFT JOIN c USING (source)""",
)
def ag08_three(d):
    texts_ = label_lines(d)
    one = texts_.select("source").distinct()
    return one.join(audit.box_counts(texts_).distinct(), "source")


STEMS = """
    SELECT i.split AS isplit, i.name AS iname, i.content, l.split AS lsplit, l.name AS lname
    FROM {set_images} i FULL JOIN {set_labels} l
      ON i.split = l.split AND replace(i.name, '.jpg', '') = replace(l.name, '.txt', '')"""


@query(
    "jn11_unpaired",
    f"""SELECT CASE WHEN lname IS NULL THEN 'missing_label' ELSE 'missing_image' END AS kind,
               concat(coalesce(isplit, lsplit), '/', coalesce(iname, lname)) AS item
        FROM ({STEMS}) WHERE iname IS NULL OR lname IS NULL""",
)
def jn11(d):
    return audit.unpaired(d.set_images, d.set_labels)


@query("ag10_names_in_two_splits", "SELECT name FROM {set_images} GROUP BY name HAVING count(DISTINCT split) > 1")
def ag10(d):
    return audit.names_in_two_splits(d.set_images)


SHARED = """
    SELECT split, name, digest, members FROM (SELECT split, name, sha1(content) AS digest FROM {set_images} WHERE content IS NOT NULL)
    JOIN (SELECT sha1(content) AS digest, count(*) AS members FROM {set_images} WHERE content IS NOT NULL
          GROUP BY 1 HAVING count(DISTINCT split) > 1) USING (digest)"""


@query("ag11_photos_in_two_splits", SHARED)
def ag11(d):
    return audit.photos_in_two_splits(audit.digests(d.set_images.filter("content IS NOT NULL")))


@query(
    "ag11_shared_photos",
    """SELECT sha1(content) AS digest, count(*) AS members, count(DISTINCT split) AS parts FROM {set_images} WHERE content IS NOT NULL
       GROUP BY ALL HAVING count(DISTINCT split) > 1""",
)
def ag11_shared(d):
    photos = audit.shared_photos(audit.digests(d.set_images.filter("content IS NOT NULL")))
    return photos.select("digest", "members", F.size("parts").cast("bigint").alias("parts"))


FOUND = f"""
    WITH dead AS (SELECT concat(split, '/', name) AS item FROM {{set_images}} WHERE content IS NULL),
         texts AS (SELECT concat(i.split, '/', i.name) AS source, l.text FROM {{set_labels}} l JOIN {{set_images}} i
                   ON i.split = l.split AND replace(i.name, '.jpg', '') = replace(l.name, '.txt', '') WHERE i.content IS NOT NULL),
         lines AS (SELECT source, n, list_filter(string_split(trim(line), ' '), lambda t: t <> '') AS t
                   FROM (SELECT source, unnest(string_split(text, chr(10))) AS line,
                                generate_subscripts(string_split(text, chr(10)), 1) AS n FROM texts) WHERE trim(line) <> ''),
         p AS (SELECT concat(source, ':', n) AS item, len(t) AS tokens, TRY_CAST(t[1] AS INT) AS c, TRY_CAST(t[2] AS DOUBLE) AS cx,
                      TRY_CAST(t[3] AS DOUBLE) AS cy, TRY_CAST(t[4] AS DOUBLE) AS w, TRY_CAST(t[5] AS DOUBLE) AS h FROM lines),
         g AS (SELECT *, tokens = 5 AND c IS NOT NULL AND cx + cy + w + h IS NOT NULL AS good FROM p)
    SELECT 'broken_link' AS kind, item FROM dead
    UNION ALL SELECT 'missing_label', concat(isplit, '/', iname) FROM ({STEMS}) WHERE lname IS NULL
              AND concat(isplit, '/', iname) NOT IN (SELECT item FROM dead)
    UNION ALL SELECT 'missing_image', concat(lsplit, '/', lname) FROM ({STEMS}) WHERE iname IS NULL
    UNION ALL SELECT 'bad_line', item FROM g WHERE NOT good
    UNION ALL SELECT 'bad_line', concat(item, ' class ', c) FROM g WHERE good AND c <> 0
    UNION ALL SELECT 'out_of_range', item FROM g WHERE good AND (least(cx, cy, w, h) < 0 OR greatest(cx, cy, w, h) > 1)
    UNION ALL SELECT 'degenerate', item FROM g WHERE good AND (w <= 0 OR h <= 0 OR w * h < 1e-6)
    UNION ALL SELECT 'name_in_two_splits', name FROM {{set_images}} GROUP BY name HAVING count(DISTINCT split) > 1
    UNION ALL SELECT 'same_photo_in_two_splits', concat(digest, ' ', split, '/', name) FROM ({SHARED})
    UNION ALL SELECT 'unreadable', concat(split, '/', name) FROM {{set_images}} WHERE content IS NOT NULL AND NOT readable
    UNION ALL SELECT 'empty_split', s FROM (VALUES ('train'), ('val'), ('test')) v(s) WHERE s NOT IN (SELECT split FROM {{set_images}})
""".replace("{{", "{").replace("}}", "}")


def found(d):
    return audit.findings(d.set_images, d.set_labels)


@query("ag09_findings", FOUND)
def ag09(d):
    return found(d)


@query(
    "ag09_finding_counts",
    f"""WITH k(kind) AS (VALUES ('empty_split'), ('missing_label'), ('missing_image'), ('broken_link'), ('unreadable'), ('bad_line'),
                         ('out_of_range'), ('degenerate'), ('name_in_two_splits'), ('same_photo_in_two_splits')),
             f AS (SELECT * FROM ({FOUND}))
        SELECT kind, count(DISTINCT CASE WHEN kind = 'same_photo_in_two_splits' THEN string_split(f.item, ' ')[1] END)
                     + count(CASE WHEN kind <> 'same_photo_in_two_splits' THEN f.item END) AS findings, (SELECT count(*) = 0 FROM f) AS clean FROM k LEFT JOIN f USING (kind) GROUP BY kind""",
)
def ag09_counts(d):
    return audit.finding_counts(found(d))


@query(
    "ag09_finding_examples",
    f"""SELECT kind, item, rank FROM (SELECT kind, item, row_number() OVER (PARTITION BY kind ORDER BY item) AS rank FROM ({FOUND}))
        WHERE rank <= 5""",
)
def ag09_examples(d):
    return audit.finding_examples(found(d), n=5).withColumn("rank", F.col("rank").cast("bigint"))


# --- box overlaps --------------------------------------------------------

PAIR_IOU = """
    SELECT left_id, right_id, file, left_conf, CASE WHEN un <> 0 THEN inter / un ELSE 0 END AS iou FROM (
      SELECT *, lw * lh + rw * rh - inter AS un FROM (
        SELECT a.id AS left_id, b.id AS right_id, a.file, a.confidence AS left_conf, a.w AS lw, a.h AS lh, b.w AS rw, b.h AS rh,
               greatest(0, least(a.cx + a.w / 2, b.cx + b.w / 2) - greatest(a.cx - a.w / 2, b.cx - b.w / 2))
             * greatest(0, least(a.cy + a.h / 2, b.cy + b.h / 2) - greatest(a.cy - a.h / 2, b.cy - b.h / 2)) AS inter
        FROM {scans} a JOIN {scans} b ON a.file = b.file AND a.scan = 'O' AND b.scan = 'F'))"""


@query(
    "jn16_prediction_truth_pairs",
    f"SELECT left_id, right_id, file, round(iou, 6) AS iou FROM ({PAIR_IOU}) WHERE iou >= 0.5e0",
)
def jn16(d):
    pairs = boxes.overlap_pairs(d.scans.filter("scan = 'O'"), d.scans.filter("scan = 'F'"), iou_min=0.5)
    return pairs.withColumn("iou", F.round("iou", 6))


@query(
    "ag31_matched_detections",
    f"""WITH p AS (SELECT * FROM ({PAIR_IOU}) WHERE iou >= 0.5e0),
             b AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY left_id ORDER BY iou DESC, right_id DESC) = 1),
             s AS (SELECT b.*, step FROM b, unnest([0.5e0, 0.55e0, 0.6e0, 0.65e0, 0.7e0, 0.75e0, 0.8e0, 0.85e0, 0.9e0, 0.95e0]) u(step) WHERE iou >= step)
        SELECT step, left_id AS id FROM s QUALIFY row_number() OVER (PARTITION BY step, right_id ORDER BY left_conf DESC, left_id DESC) = 1""",
)
def ag31_matches(d):
    return boxes.matched_detections(d.scans.filter("scan = 'O'"), d.scans.filter("scan = 'F'"))


@query(
    "ag31_detection_quality",
    f"""WITH p AS (SELECT * FROM ({PAIR_IOU}) WHERE iou >= 0.5e0),
             b AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY left_id ORDER BY iou DESC, right_id DESC) = 1),
             u AS (SELECT unnest([0.5e0, 0.55e0, 0.6e0, 0.65e0, 0.7e0, 0.75e0, 0.8e0, 0.85e0, 0.9e0, 0.95e0]) AS step),
             m AS (SELECT step, left_id AS id FROM b, u WHERE iou >= step
                   QUALIFY row_number() OVER (PARTITION BY step, right_id ORDER BY left_conf DESC, left_id DESC) = 1),
             shown AS (SELECT id, step, 'part ' || substr(id, 1, 0) || right(replace(file, '.jpg', ''), 1) AS part,
                              confidence AS level FROM {{scans}}, u WHERE scan = 'O'),
             pts AS (SELECT part, step, level, count(*) AS n, count(m.id) AS tp FROM shown LEFT JOIN m USING (id, step) GROUP BY ALL),
             t AS (SELECT 'part ' || right(replace(file, '.jpg', ''), 1) AS part, count(*) AS truths FROM {{scans}} WHERE scan = 'F' GROUP BY ALL),
             c AS (SELECT *, sum(tp) OVER w AS ctp, sum(n) OVER w AS cn FROM pts JOIN t USING (part)
                   WINDOW w AS (PARTITION BY part, step ORDER BY level DESC)),
             e AS (SELECT *, max(ctp / cn) OVER (PARTITION BY part, step ORDER BY level DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS best,
                          ctp / truths - coalesce(lag(ctp / truths) OVER (PARTITION BY part, step ORDER BY level DESC), 0) AS rise FROM c),
             s AS (SELECT part, step, sum(rise * best) AS ap, arg_max(ctp / cn, (2 * ctp / (cn + truths), level)) AS prec,
                          arg_max(ctp / truths, (2 * ctp / (cn + truths), level)) AS rec FROM e GROUP BY part, step)
        SELECT part, round(max(ap) FILTER (step = 0.5), 6) AS ap50, round(avg(ap), 6) AS map, round(max(prec) FILTER (step = 0.5), 6) AS "precision",
               round(max(rec) FILTER (step = 0.5), 6) AS recall FROM s GROUP BY part""",
)
def ag31(d):
    part = F.concat(F.lit("part "), F.regexp_extract("file", r"(.)\.jpg$", 1))
    scans = d.scans.withColumn("part", part)
    quality = boxes.detection_quality(scans.filter("scan = 'O'"), scans.filter("scan = 'F'"))
    return quality.select("part", *[F.round(c, 6).alias(c) for c in ("ap50", "map", "precision", "recall")])


@query(
    "jn07_box_iou_merge",
    """WITH RECURSIVE base AS (SELECT * FROM {scans} WHERE scan = 'F'),
       extra AS (SELECT *, row_number() OVER (PARTITION BY file ORDER BY id) AS n FROM {scans} WHERE scan = 'O'),
       files AS (SELECT DISTINCT file FROM extra),
       walk AS (SELECT f.file, 0::BIGINT AS n, ''::VARCHAR AS accepted,
                       coalesce((SELECT list({{'cx': cx, 'cy': cy, 'w': w, 'h': h}}) FROM base b WHERE b.file = f.file), []) AS boxes FROM files f
                UNION ALL
                SELECT k.file, e.n, CASE WHEN e.hit THEN '' ELSE e.id END,
                       CASE WHEN e.hit THEN k.boxes ELSE list_append(k.boxes, {{'cx': e.cx, 'cy': e.cy, 'w': e.w, 'h': e.h}}) END
                FROM walk k JOIN LATERAL (
                  SELECT x.*, len(list_filter(k.boxes, lambda b:
                      greatest(0, least(x.cx + x.w / 2, b.cx + b.w / 2) - greatest(x.cx - x.w / 2, b.cx - b.w / 2))
                    * greatest(0, least(x.cy + x.h / 2, b.cy + b.h / 2) - greatest(x.cy - x.h / 2, b.cy - b.h / 2))
                    * 1.6e0 >= 0.6e0 * (x.w * x.h + b.w * b.h))) > 0 AS hit
                  FROM extra x WHERE x.file = k.file AND x.n = k.n + 1) e ON true)
       SELECT accepted AS id FROM walk WHERE accepted <> ''""",
)
def jn07(d):
    scans = d.scans.select("id", "file", *boxes.SIDES, "scan")
    return boxes.merge_scans(scans.filter("scan = 'F'").drop("scan"), scans.filter("scan = 'O'").drop("scan"), iou_min=0.6).select("id")


@query(
    "jn07_merged_scan",
    """WITH RECURSIVE base AS (SELECT *, row_number() OVER (ORDER BY id) AS number FROM {scans} WHERE scan = 'F'),
       extra AS (SELECT *, row_number() OVER (PARTITION BY file ORDER BY id) AS n FROM {scans} WHERE scan = 'O'),
       files AS (SELECT DISTINCT file FROM extra),
       walk AS (SELECT f.file, 0::BIGINT AS n, ''::VARCHAR AS accepted,
                       coalesce((SELECT list({{'cx': cx, 'cy': cy, 'w': w, 'h': h}}) FROM base b WHERE b.file = f.file), []) AS boxes FROM files f
                UNION ALL
                SELECT k.file, e.n, CASE WHEN e.hit THEN '' ELSE e.id END,
                       CASE WHEN e.hit THEN k.boxes ELSE list_append(k.boxes, {{'cx': e.cx, 'cy': e.cy, 'w': e.w, 'h': e.h}}) END
                FROM walk k JOIN LATERAL (
                  SELECT x.*, len(list_filter(k.boxes, lambda b:
                      greatest(0, least(x.cx + x.w / 2, b.cx + b.w / 2) - greatest(x.cx - x.w / 2, b.cx - b.w / 2))
                    * greatest(0, least(x.cy + x.h / 2, b.cy + b.h / 2) - greatest(x.cy - x.h / 2, b.cy - b.h / 2))
                    * 1.6e0 >= 0.6e0 * (x.w * x.h + b.w * b.h))) > 0 AS hit
                  FROM extra x WHERE x.file = k.file AND x.n = k.n + 1) e ON true),
       used AS (SELECT file, max(index) + 1 AS used FROM base GROUP BY file),
       fresh AS (SELECT s.*, row_number() OVER (ORDER BY s.id) + (SELECT max(number) FROM base) AS number,
                        row_number() OVER (PARTITION BY s.file ORDER BY s.id) - 1 + coalesce(used, 0) AS place
                 FROM walk JOIN {scans} s ON s.id = walk.accepted LEFT JOIN used ON s.file = used.file)
       SELECT number, file, index AS place, confidence, false AS added FROM base
       UNION ALL SELECT number, file, place, confidence, true FROM fresh""",
)
def jn07_merged(d):
    base = ordered_rank(d.scans.filter("scan = 'F'").drop("scan"), ["id"], rank="number").drop("id")
    merged = boxes.merged_scan(base, d.scans.filter("scan = 'O'"), iou_min=0.6)
    return merged.select("number", "file", F.col("index").cast("long").alias("place"), "confidence", "added")
