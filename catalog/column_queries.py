"""Column expressions: geometry, names, answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query
from framewright import schemas as C
from framewright.functions import answers as A
from framewright.functions import geometry as G
from framewright.functions import naming as N
from framewright.operators import boxes
from framewright.operators.augment import augmentation_plan

FORMS = {"en": ("the", "ing the"), "fr": ("les", "que le"), "de": ("nicht", "der die"), "es": ("zzz", "que la")}
WORDS = {"es": ("los",), "de": ("und",)}

PIXELS = """
    SELECT f.file, f.width AS frame_width, f.height AS frame_height, b.box_id, b.confidence,
           floor((b.center_x - b.width) * f.width) + 0.25e0 AS x1, floor((b.center_y - b.height) * f.height) + 0.5e0 AS y1,
           floor((b.center_x + b.width) * f.width) + 0.75e0 AS x2, floor((b.center_y + b.height) * f.height) + 0.125e0 AS y2
    FROM {boxes} b JOIN {frames} f USING (file)"""


def pixels(d):
    b, f = d.boxes, d.frames.select("file", F.col("width").alias("fw"), F.col("height").alias("fh"))
    j = b.join(f, "file")
    side = lambda c, s, sign, full, add: F.floor((F.col(c) + sign * F.col(s)) * F.col(full)) + F.lit(add)
    return j.select(
        "file",
        F.col("fw").alias("frame_width"),
        F.col("fh").alias("frame_height"),
        "box_id",
        "confidence",
        side("center_x", "width", -1, "fw", 0.25).alias("x1"),
        side("center_y", "height", -1, "fh", 0.5).alias("y1"),
        side("center_x", "width", 1, "fw", 0.75).alias("x2"),
        side("center_y", "height", 1, "fh", 0.125).alias("y2"),
    )


CLAMPED = f"""
    SELECT file, box_id, (a + c) / 2 / frame_width AS cx, (b + d) / 2 / frame_height AS cy,
           (c - a) / frame_width AS w, (d - b) / frame_height AS h
    FROM (SELECT *, least(greatest(x1, 0), frame_width) AS a, least(greatest(y1, 0), frame_height) AS b,
                 least(greatest(x2, 0), frame_width) AS c, least(greatest(y2, 0), frame_height) AS d FROM ({PIXELS}))"""


@query(
    "prj01_clamped_shares",
    f"""SELECT file, box_id, cx, cy, w, h,
               printf('0 %.6f %.6f %.6f %.6f', cx, cy, w, h) AS line FROM ({CLAMPED})""",
)
def prj01(d):
    p = pixels(d)
    parts = G.clamped_shares(*[F.col(c) for c in ("x1", "y1", "x2", "y2", "frame_width", "frame_height")])
    line = G.label_line(*parts.values())
    return p.select("file", "box_id", *[v.alias(k) for k, v in parts.items()], line.alias("line"))


@query(
    "prj02_scan_shares",
    f"""SELECT file, confidence, (x1 + x2) / 2 / frame_width AS cx, (y1 + y2) / 2 / frame_height AS cy,
               (x2 - x1) / frame_width AS w, (y2 - y1) / frame_height AS h
        FROM ({PIXELS}) WHERE confidence >= 0.25""",
)
def prj02(d):
    found = boxes.boxes_from_detections(pixels(d))
    return found.select("file", "confidence", "cx", "cy", "w", "h")


@query("flt10_min_confidence", f"SELECT file, confidence FROM ({PIXELS}) WHERE confidence >= 0.6e0")
def flt10(d):
    return boxes.boxes_from_detections(pixels(d), min_confidence=0.6).select("file", "confidence")


@query(
    "prj03_area_and_crop",
    """SELECT id, round(w * h, 6) AS area_share, concat(replace(file, '.jpg', ''), '__', index, '.jpg') AS crop FROM {scans}""",
)
def prj03(d):
    return boxes.named_crops(d.scans).select("id", F.round("area_share", 6).alias("area_share"), "crop")


@query(
    "prj04_crop_window",
    """WITH b AS (SELECT b.box_id, f.width AS fw, f.height AS fh, center_x AS cx, center_y AS cy, b.width AS w, b.height AS h
                  FROM {boxes} b JOIN {frames} f USING (file)),
            c AS (SELECT box_id, greatest(0, trunc((cx - w / 2 - w * 0.15e0) * fw))::INT AS l,
                         greatest(0, trunc((cy - h / 2 - h * 0.15e0) * fh))::INT AS t,
                         least(fw, trunc((cx + w / 2 + w * 0.15e0) * fw))::INT AS r,
                         least(fh, trunc((cy + h / 2 + h * 0.15e0) * fh))::INT AS m FROM b)
       SELECT box_id, l AS "left", t AS top, greatest(r, l + 1) AS "right", greatest(m, t + 1) AS bottom,
              round(least(1.0, 448e0 / greatest(greatest(r, l + 1) - l, greatest(m, t + 1) - t)), 6) AS scale FROM c""",
)
def prj04(d):
    f = d.frames.select("file", F.col("width").alias("fw"), F.col("height").alias("fh"))
    b = d.boxes.join(f, "file")
    cols = [F.col(c) for c in ("center_x", "center_y", "width", "height", "fw", "fh")]
    window = G.crop_window(*cols, margin=0.15, max_side=448)
    window["scale"] = F.round(window["scale"], 6)
    return b.select("box_id", *[v.alias(k) for k, v in window.items()])


GROUP = """CASE WHEN regexp_matches(lower(stem), '^[0-9a-f]{{12,}}$') THEN 'raw'
                WHEN trim(regexp_replace(stem, '[0-9].*$', ''), '_') = '' THEN 'numbers'
                ELSE trim(regexp_replace(stem, '[0-9].*$', ''), '_') END"""


@query(
    "prj05_file_group",
    f"""SELECT file, {GROUP} AS "group" FROM (SELECT file, regexp_replace(file, '[.][^.]*$', '') AS stem FROM {{named}})""",
)
def prj05(d):
    return d.named.select("file", N.group_of(F.col("file")).alias("group"))


MOMENT = """
    SELECT event_id, file, CASE WHEN s > 0 THEN round_even(n / s, 0)::BIGINT END AS recording, CASE WHEN s > 0 THEN s END AS seconds
    FROM (SELECT event_id, file, regexp_extract(file, '^frame_(\\d+)_t(\\d+\\.\\d+)', 1)::DOUBLE AS n,
                 regexp_extract(file, '^frame_(\\d+)_t(\\d+\\.\\d+)', 2)::DOUBLE AS s FROM {video})"""


@query("prj06_video_moment", MOMENT)
def prj06(d):
    moment = N.video_moment(F.col("file"))
    return d.video.select("event_id", "file", *[v.alias(k) for k, v in moment.items()])


@query(
    "prj10_pair_key",
    """SELECT file, regexp_replace(regexp_replace(regexp_replace(file, '[.][^.]*$', ''), '_aug$', ''), '^truckaug_', 'truck_') AS pair_key,
              regexp_matches(file, '_aug[.]|^truckaug_') AS is_copy FROM {named}""",
)
def prj10(d):
    return d.named.select("file", N.pair_key(F.col("file")).alias("pair_key"), N.is_copy(F.col("file")).alias("is_copy"))


IN_TEXT = """
    CASE brand
      WHEN 'en' THEN contains(low, 'the') OR contains(packed, 'the') OR contains(packed, 'ingthe')
      WHEN 'fr' THEN contains(low, 'les') OR contains(packed, 'les') OR contains(low, 'que le') OR contains(packed, 'quele')
      WHEN 'de' THEN contains(low, 'nicht') OR contains(packed, 'nicht') OR contains(low, 'der die') OR contains(packed, 'derdie')
                     OR regexp_matches(low, '(^|[^a-zа-яё])und($|[^a-zа-яё])')
      WHEN 'es' THEN contains(low, 'zzz') OR contains(packed, 'zzz') OR contains(low, 'que la') OR contains(packed, 'quela')
                     OR regexp_matches(low, '(^|[^a-zа-яё])los($|[^a-zа-яё])')
      ELSE false END"""
TRUST = f"""
    SELECT doc_id, brand, named, verdict, CASE WHEN verdict = 'confirmed' THEN brand ELSE 'unclear' END AS decided,
           CASE WHEN verdict IN ('confirmed', 'review') THEN brand ELSE 'unclear' END AS decided_with_logo
    FROM (SELECT *, CASE WHEN error <> '' THEN 'confirmed' WHEN basis = 'colors_only' THEN 'rejected'
                         WHEN named THEN 'confirmed' ELSE 'review' END AS verdict
          FROM (SELECT *, {IN_TEXT} AS named
                FROM (SELECT *, lower(visible_text) AS low, regexp_replace(lower(visible_text), '\\s+', '', 'g') AS packed
                      FROM {{claims}})))""".replace("{{", "{").replace("}}", "}")


def _claims(d):
    c = d.claims.withColumn("named", A.name_in_text(F.col("brand"), F.col("visible_text"), FORMS, WORDS))
    verdict = A.trust(
        F.col("brand"), F.col("basis"), F.col("visible_text"), F.col("error"), FORMS, standalone=WORDS
    )
    return c.withColumn("verdict", verdict)


@query("prj12_name_in_text", f"SELECT doc_id, brand, named FROM ({TRUST})")
def prj12(d):
    return _claims(d).select("doc_id", "brand", "named")


@query("prj13_trust_verdict", f"SELECT doc_id, verdict FROM ({TRUST})")
def prj13(d):
    return _claims(d).select("doc_id", "verdict")


@query("prj14_decided", f"SELECT doc_id, decided, decided_with_logo FROM ({TRUST})")
def prj14(d):
    c = _claims(d)
    brand, verdict = F.col("brand"), F.col("verdict")
    return c.select(
        "doc_id",
        A.decided(brand, verdict).alias("decided"),
        A.decided(brand, verdict, accept_logo=True).alias("decided_with_logo"),
    )


@query(
    "prj15_class_index",
    """SELECT file, CASE truth WHEN 'beeline' THEN 0 WHEN 'megafon' THEN 1 WHEN 'tele2' THEN 2 WHEN 'other' THEN 3 END AS class
       FROM {run_one}""",
)
def prj15(d):
    return d.run_one.select("file", A.class_index(F.col("truth")).alias("class"))


@query(
    "prj16_pick_class",
    """SELECT vec_id, CASE WHEN list_max(p) >= 0.12e0 THEN
                list_extract(['beeline', 'megafon', 'tele2', 'other'], list_position(p, list_max(p))) ELSE 'unsure' END AS brand,
              round(list_max(p), 6) AS confidence
       FROM (SELECT vec_id, list_transform(embedding[1:4], lambda x: abs(x::DOUBLE)) AS p FROM {embeddings})""",
)
def prj16(d):
    p = F.transform(F.slice("embedding", 1, 4), lambda x: F.abs(x.cast("double")))
    pick = A.pick_class(p, C.HEAD_CLASSES, 0.12)
    return d.embeddings.select("vec_id", pick["brand"].alias("brand"), F.round(pick["confidence"], 6).alias("confidence"))


REPLY = """CASE WHEN source = 'src0' THEN 'not json {{' WHEN source = 'src1' THEN '{{"basis": "logo_only"}}'
                WHEN source = 'src2' THEN '{{"brand": "mts", "basis": "name_read", "evidence": "sign"}}'
                ELSE concat('{{"brand": "', lang, '", "basis": "colors_only", "visible_text": "', CAST(n_chars AS string), '"}}') END"""


@query(
    "prj17_parsed_replies",
    """SELECT doc_id, CASE WHEN bad THEN 'unclear' WHEN source = 'src1' THEN 'unclear' WHEN source = 'src2' THEN 'mts' ELSE lang END AS brand,
              CASE WHEN bad THEN 'colors_only' WHEN source = 'src1' THEN 'logo_only' WHEN source = 'src2' THEN 'name_read'
                   ELSE 'colors_only' END AS basis,
              CASE WHEN NOT bad AND source = 'src2' THEN 'sign' ELSE '' END AS evidence,
              CASE WHEN bad OR source IN ('src1', 'src2') THEN '' ELSE CAST(n_chars AS string) END AS visible_text,
              CASE WHEN source = 'src4' THEN 'timeout' WHEN bad THEN 'unreadable reply' ELSE '' END AS error
       FROM (SELECT *, source IN ('src0', 'src4') AS bad FROM {documents})""",
)
def prj17(d):
    failure = F.when(F.col("source") == "src4", F.lit("timeout"))
    replies = d.documents.withColumn("reply", F.expr(REPLY.replace("{{", "{").replace("}}", "}")))
    fields = A.parse_brand_reply(F.col("reply"), failure)
    return replies.select("doc_id", *[v.alias(k) for k, v in fields.items()])


@query(
    "prj17_judge_replies",
    """SELECT doc_id, CASE WHEN source IN ('src0', 'src4') THEN 'error' ELSE coalesce(CASE WHEN source = 'src1' THEN NULL ELSE lang END, 'error') END AS category,
              CASE source WHEN 'src4' THEN 'line one line two' WHEN 'src0' THEN 'unreadable reply' WHEN 'src1' THEN 'no category' ELSE '' END AS reason
       FROM {documents}""",
)
def prj17_judge(d):
    failure = F.when(F.col("source") == "src4", F.lit("line one\nline two"))
    reply = (
        F.when(F.col("source") == "src0", F.lit("{broken"))
        .when(F.col("source") == "src1", F.lit('{"reason": "no category"}'))
        .otherwise(F.concat(F.lit('{"category": "'), "lang", F.lit('"}')))
    )
    fields = A.parse_judge_reply(reply, failure)
    return d.documents.select("doc_id", *[v.alias(k) for k, v in fields.items()])


@query(
    "prj19_fit_in_square",
    """SELECT file, greatest(1, round_even(width * s, 0)::INT) AS new_width, greatest(1, round_even(height * s, 0)::INT) AS new_height,
              (224 - greatest(1, round_even(width * s, 0)::INT)) // 2 AS offset_x,
              (224 - greatest(1, round_even(height * s, 0)::INT)) // 2 AS offset_y, round(s, 6) AS scale
       FROM (SELECT *, 224e0 / greatest(width, height) AS s FROM {frames})""",
)
def prj19(d):
    box = G.letterbox(F.col("width"), F.col("height"), 224)
    box["scale"] = F.round(box["scale"], 6)
    return d.frames.select("file", *[v.alias(k) for k, v in box.items()])


@query(
    "prj19_request_size",
    """SELECT file, greatest(1, round_even(width * s, 0)::INT) AS new_width, greatest(1, round_even(height * s, 0)::INT) AS new_height
       FROM (SELECT *, least(1e0, 1400e0 / greatest(width, height)) AS s FROM {frames})""",
)
def prj19_request(d):
    size = G.shrink(F.col("width"), F.col("height"), 1400)
    return d.frames.select("file", size["new_width"].alias("new_width"), size["new_height"].alias("new_height"))


@query(
    "prj20_size_features",
    """SELECT file, round(log10(width), 6) AS log_width, round(log10(height), 6) AS log_height,
              round(width / height, 6) AS aspect, round(log10(width * height), 6) AS log_area FROM {frames}""",
)
def prj20(d):
    parts = G.size_features(F.col("width"), F.col("height"))
    return d.frames.select("file", *[F.round(v, 6).alias(k) for k, v in parts.items()])


IOU = """
    SELECT left_id, right_id, file, CASE WHEN un <> 0 THEN inter / un ELSE 0 END AS iou FROM (
      SELECT *, lw * lh + rw * rh - inter AS un FROM (
        SELECT a.id AS left_id, b.id AS right_id, a.file, a.w AS lw, a.h AS lh, b.w AS rw, b.h AS rh,
               greatest(0, least(a.cx + a.w / 2, b.cx + b.w / 2) - greatest(a.cx - a.w / 2, b.cx - b.w / 2))
             * greatest(0, least(a.cy + a.h / 2, b.cy + b.h / 2) - greatest(a.cy - a.h / 2, b.cy - b.h / 2)) AS inter
        FROM {scans} a JOIN {scans} b ON a.file = b.file AND a.scan = 'F' AND b.scan = 'O'))"""


@query("prj21_box_iou", f"SELECT left_id, right_id, round(iou, 6) AS iou FROM ({IOU}) WHERE iou >= 0.3e0")
def prj21(d):
    found = boxes.overlap_pairs(d.scans.filter("scan = 'F'"), d.scans.filter("scan = 'O'"), iou_min=0.3)
    return found.select("left_id", "right_id", F.round("iou", 6).alias("iou"))


@query(
    "prj22_probe_names",
    "SELECT file, concat(replace(replace(concat(folder, '/', kind), '/', '-'), ' ', '_'), '__', file) AS probe_name FROM {named}",
)
def prj22(d):
    source = F.concat("folder", F.lit("/"), "kind")
    return d.named.select("file", N.probe_name(source, F.col("file")).alias("probe_name"))


@query(
    "prj18_flip_marks",
    """SELECT a.file, CASE WHEN a.decided = b.decided THEN NULL WHEN b.decided = a.truth THEN 'fixed'
                           WHEN a.decided = a.truth THEN 'broken' ELSE 'still_wrong' END AS mark
       FROM {run_one} a JOIN {run_two} b USING (file)""",
)
def prj18(d):
    both = d.run_one.join(d.run_two.select("file", F.col("decided").alias("later")), "file")
    return both.select("file", A.flip_mark(F.col("truth"), F.col("decided"), F.col("later")).alias("mark"))


def _draw(name: str) -> str:
    return f"(('0x' || substr(md5(concat('0:', file, ':{name}')), 1, 13))::BIGINT / 4503599627370496e0)"


@query(
    "wn13_augmentation_plan",
    f"""SELECT file, concat(stem, '_aug.jpg') AS copy, cw AS crop_width, ch AS crop_height,
               floor({_draw('left')} * (width - cw + 1))::INT AS "left", floor({_draw('top')} * (height - ch + 1))::INT AS top,
               round(0.7e0 + 0.6e0 * {_draw('brightness')}, 6) AS brightness, round(0.8e0 + 0.4e0 * {_draw('contrast')}, 6) AS contrast,
               round(CASE WHEN 1.2e0 * {_draw('blur')} > 0.3e0 THEN 1.2e0 * {_draw('blur')} ELSE 0 END, 6) AS blur_radius
        FROM (SELECT *, trunc(width * (0.85e0 + 0.15e0 * {_draw('share')}))::INT AS cw,
                     trunc(height * (0.85e0 + 0.15e0 * {_draw('share')}))::INT AS ch FROM {{frames}})""",
)
def wn13(d):
    plan = augmentation_plan(d.frames)
    drawn = ("brightness", "contrast", "blur_radius")
    whole = ("file", "copy", "crop_width", "crop_height", "left", "top")
    return plan.select(*whole, *[F.round(c, 6).alias(c) for c in drawn])
