"""Test views over the provided tables.

Each view is one SELECT that Spark and DuckDB both understand; ``{name}`` names
a table or another view.  Where a dialect differs, Spark has its own text.
"""

from __future__ import annotations

from string import Formatter

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

FRAME = "concat('frame_', lpad(CAST({key} AS string), 9, '0'))"
STEM_O = FRAME.format(key="o_orderkey")
STEM_L = FRAME.format(key="l_orderkey")
BOX_ID = (
    "concat(CAST(l_orderkey AS string), '-', CAST(l_linenumber AS string), '-', "
    "CAST(l_partkey AS string), '-', CAST(l_suppkey AS string))"
)
BRAND = (
    "CASE source WHEN 'src0' THEN 'beeline' WHEN 'src1' THEN 'megafon' WHEN 'src2' THEN 'mts' "
    "WHEN 'src3' THEN 'tele2' WHEN 'src4' THEN 'volna' WHEN 'src5' THEN 'miranda' "
    "WHEN 'src6' THEN 'plus7' ELSE 'other' END"
)
DOC_FILE = "concat('doc_', lpad(CAST(d.doc_id AS string), 7, '0'), '.jpg')"

VIEWS = {
    # frames of a recording and what a detector saw on them
    "frames": f"""
        SELECT concat({STEM_O}, '.jpg') AS file, {STEM_O} AS stem,
               CAST(1000 + o_custkey % 921 AS int) AS width, CAST(600 + o_orderkey % 481 AS int) AS height,
               o_orderpriority AS camera, o_orderstatus AS status_flag, o_totalprice AS price
        FROM {{orders}}""",
    "boxes": f"""
        SELECT {BOX_ID} AS box_id, concat({STEM_L}, '.jpg') AS file, CAST(l_linenumber - 1 AS int) AS index,
               0.15e0 + (l_partkey % 71) / 101e0 AS center_x, 0.2e0 + (l_suppkey % 59) / 103e0 AS center_y,
               0.05e0 + l_quantity / 180e0 AS width, 0.07e0 + (l_partkey % 13) / 47e0 AS height,
               0.25e0 + (l_suppkey % 76) / 100e0 AS confidence,
               l_linestatus AS scan
        FROM {{lineitem}}""",
    "scans": """
        SELECT box_id AS id, file, center_x AS cx, center_y AS cy, width AS w, height AS h, confidence,
               index, scan FROM {boxes}""",
    "answers": f"""
        SELECT {BOX_ID} AS box_id,
               CASE WHEN l_quantity <= 26 THEN 'ad_surface' WHEN l_quantity <= 34 THEN 'storefront_sign'
                    WHEN l_quantity <= 41 THEN 'vehicle_ad' WHEN l_quantity <= 43 THEN 'road_sign'
                    WHEN l_quantity <= 45 THEN 'building' WHEN l_quantity <= 46 THEN 'vehicle'
                    WHEN l_quantity <= 47 THEN 'nature_or_blur' WHEN l_quantity <= 48 THEN 'other'
                    WHEN l_quantity <= 49 THEN 'road_sign' ELSE 'error' END AS category,
               1 AS answered_at
        FROM {{lineitem}} WHERE l_discount > 0
        UNION ALL
        SELECT {BOX_ID}, 'other', 2 FROM {{lineitem}} WHERE l_tax = 0.08e0 AND l_discount > 0""",
    "verdicts": f"""
        SELECT {BOX_ID} AS box_id,
               CASE WHEN l_linenumber <= 2 THEN 'keep' WHEN l_linenumber <= 4 THEN 'drop'
                    WHEN l_linenumber = 5 THEN 'disputed' WHEN l_linenumber = 6 THEN '' ELSE 'remove' END AS verdict,
               1 AS given_at
        FROM {{lineitem}} WHERE l_tax = 0
        UNION ALL
        SELECT {BOX_ID}, CASE WHEN l_linenumber = 1 THEN 'drop' ELSE 'disputed' END, 2
        FROM {{lineitem}} WHERE l_tax = 0 AND l_linenumber <= 2 AND l_quantity <= 10""",
    "export": f"""
        SELECT {STEM_O} AS stem,
               CASE WHEN o_totalprice < 100000 THEN '' WHEN o_totalprice < 250000 THEN concat('0 0.5 0.5 0.1 0.1', chr(10))
                    ELSE concat('0 0.5 0.5 0.1 0.1', chr(10), chr(10), '0 0.2 0.3 0.1 0.2', chr(10)) END AS text
        FROM {{orders}} WHERE o_orderpriority = '1-URGENT'""",
    # file names of every shape
    "named": """
        SELECT p_partkey AS id,
               CASE WHEN p_size <= 10 THEN concat(md5(CAST(p_partkey AS string)), '.png')
                    WHEN p_size <= 15 THEN concat(lpad(CAST(p_partkey + 1 AS string), 5, '0'), '.webp')
                    WHEN p_size <= 20 THEN concat('truck_', lpad(CAST(p_partkey AS string), 5, '0'), '.JPG')
                    WHEN p_size <= 23 THEN concat('truck_', lpad(CAST(p_partkey - 1 AS string), 5, '0'), '_aug.jpg')
                    WHEN p_size <= 25 THEN concat('truckaug_', lpad(CAST(p_partkey - 1 AS string), 5, '0'), '.jpg')
                    ELSE concat(replace(p_name, ' ', '_'), '_', lpad(CAST(p_partkey AS string), 6, '0'), '.jpg')
               END AS file,
               p_brand AS folder, p_type AS kind
        FROM {part}""",
    "video": """
        SELECT event_id, event_type,
               concat('frame_', lpad(CAST(event_id AS string), 6, '0'), '_t',
                      lpad(CAST(CAST(value AS decimal(12,3)) AS string), 9, '0'),
                      CASE WHEN event_type = 'view' THEN '_aug.jpg' ELSE '.jpg' END) AS file
        FROM {events}""",
    # labelled samples
    "samples": f"""
        SELECT d.doc_id AS doc_id, d.lang AS lang, d.source AS source, d.n_chars AS n_chars, d.text AS content,
               concat(d.lang, '_', lpad(CAST(d.n_chars AS string), 6, '0')) AS stem,
               {DOC_FILE} AS file, l.quality AS quality, l.toxic AS toxic,
               CASE WHEN l.doc_id IS NULL THEN 'unlabelled' WHEN l.quality = 0 THEN 'negative' ELSE 'positive' END
                   AS labelling,
               CASE WHEN l.doc_id IS NULL THEN NULL WHEN l.quality = 0 THEN ''
                    ELSE concat(CAST(l.toxic AS string), ' ', CAST((d.n_chars % 100) / 80e0 AS string),
                                ' 0.5 0.25 0.125', chr(10)) END AS label_text
        FROM {{documents}} d LEFT JOIN {{labels}} l ON d.doc_id = l.doc_id""",
    "images": "SELECT concat(source, '/', stem, '.jpg') AS path, stem, doc_id FROM {samples}",
    "set_images": """
        SELECT CASE lang WHEN 'en' THEN 'train' WHEN 'fr' THEN 'val' ELSE 'test' END AS split,
               concat(stem, '.jpg') AS name,
               CASE WHEN toxic = 1 THEN NULL ELSE content END AS content, n_chars > 60 AS readable
        FROM {samples}
        UNION ALL
        SELECT 'val', concat('again_', stem, '.jpg'), content, n_chars > 60 FROM {samples} WHERE lang = 'en' AND n_chars % 9 = 0""",
    "set_labels": """
        SELECT CASE lang WHEN 'en' THEN 'train' WHEN 'fr' THEN 'val' ELSE 'test' END AS split,
               concat(CASE WHEN quality = 0 THEN 'lost_' ELSE '' END, stem, '.txt') AS name,
               concat(CAST(toxic AS string), ' ', CAST(CAST((n_chars % 100) / 80e0 AS decimal(8,4)) AS string),
                      ' 0.5 ', CAST(CAST(quality * (n_chars % 7) / 10e0 AS decimal(8,4)) AS string), ' 0.125', chr(10),
                      chr(10), CASE WHEN n_chars % 2 = 0 THEN concat(lang, ' ', source) ELSE '0 0.5 x 0.1 0.1' END,
                      chr(10)) AS text
        FROM {samples} WHERE quality IS NOT NULL""",
    "recordings": """
        SELECT user_id AS recording, event_id, CAST(event_id AS string) AS file,
               epoch_us(ts) / 1e6 AS seconds, event_type FROM {events}""",
    # answers of two model runs with the truth
    "run_one": f"""
        SELECT {DOC_FILE} AS file, CASE WHEN d.n_chars < 200 THEN '' ELSE {BRAND} END AS truth,
               CASE WHEN l.doc_id IS NULL THEN {BRAND} WHEN l.toxic = 1 THEN 'mts' WHEN l.quality = 0 THEN 'other'
                    ELSE {BRAND} END AS brand,
               CASE WHEN d.lang = 'en' AND l.quality = 1 THEN 'unclear' WHEN l.toxic = 1 THEN 'mts'
                    WHEN l.quality = 0 THEN 'other' ELSE {BRAND} END AS decided,
               CASE d.lang WHEN 'en' THEN 'name_read' WHEN 'fr' THEN 'logo_only' ELSE 'colors_only' END AS basis,
               d.lang AS lang
        FROM {{documents}} d LEFT JOIN {{labels}} l ON d.doc_id = l.doc_id""",
    "run_two": f"""
        SELECT {DOC_FILE} AS file, CASE WHEN d.n_chars < 200 THEN '' ELSE {BRAND} END AS truth,
               CASE WHEN d.lang = 'de' THEN 'volna' WHEN l.toxic = 1 AND d.lang = 'en' THEN 'megafon'
                    WHEN l.quality = 0 THEN {BRAND} WHEN d.lang = 'es' THEN 'unclear'
                    WHEN d.n_chars > 9000 THEN 'beeline' ELSE {BRAND} END AS decided
        FROM {{documents}} d LEFT JOIN {{labels}} l ON d.doc_id = l.doc_id WHERE d.n_chars > 100""",
    "run_one_graded": "SELECT * FROM {run_one} WHERE truth <> ''",
    "run_two_graded": "SELECT * FROM {run_two} WHERE truth <> ''",
    # every vector read as a picture of 8 x 8 pixels
    "pixels": """
        SELECT vec_id AS img, CAST(p % 8 AS int) AS x, CAST((p - p % 8) / 8 AS int) AS y, 8 AS width, 8 AS height,
               CAST(greatest(0, least(255, floor(110 + 700e0 * embedding[p + 1]))) AS int) AS r,
               CAST(greatest(0, least(255, floor(110 + 700e0 * embedding[(p + 21) % 64 + 1]))) AS int) AS g,
               CAST(greatest(0, least(255, floor(110 + 700e0 * embedding[(p + 42) % 64 + 1]))) AS int) AS b
        FROM (SELECT vec_id, embedding, unnest(range(64)) AS p FROM {embeddings})""",
    # every longer document read as a picture of 192 columns, a character a pixel
    "pictures": """
        SELECT img, CAST(p % 192 AS int) AS x, CAST(p // 192 AS int) AS y, 192 AS width, CAST(height AS int) AS height,
               CAST(code % 256 AS int) AS r, CAST((code * 7 + p) % 256 AS int) AS g, CAST((code * 3 + p * 5) % 256 AS int) AS b
        FROM (SELECT img, height, unnest(range(len(signs))) AS p, unicode(unnest(signs)) AS code
              FROM (SELECT doc_id AS img, length(text) // 192 AS height, string_split(text, '') AS signs FROM {documents} WHERE length(text) >= 384))
        WHERE p < height * 192""",
    "claims": """
        SELECT doc_id, lang AS brand,
               CASE source WHEN 'src0' THEN 'colors_only' WHEN 'src1' THEN 'logo_only' WHEN 'src2' THEN 'logo_only'
                    ELSE 'name_read' END AS basis,
               text AS visible_text, CASE WHEN source = 'src3' THEN 'timeout' ELSE '' END AS error
        FROM {documents}""",
}

SPARK_VIEWS = {
    "pictures": """
        SELECT img, CAST(p % 192 AS int) AS x, CAST(p div 192 AS int) AS y, 192 AS width, CAST(height AS int) AS height,
               CAST(code % 256 AS int) AS r, CAST((code * 7 + p) % 256 AS int) AS g, CAST((code * 3 + p * 5) % 256 AS int) AS b
        FROM (SELECT img, height, p, CAST(ascii(sign) AS bigint) AS code
              FROM (SELECT doc_id AS img, length(text) div 192 AS height, posexplode(split(text, '')) AS (p, sign) FROM {documents} WHERE length(text) >= 384))
        WHERE p < height * 192""",
    "pixels": """
        SELECT vec_id AS img, CAST(p % 8 AS int) AS x, CAST((p - p % 8) / 8 AS int) AS y, 8 AS width, 8 AS height,
               CAST(greatest(0, least(255, floor(110 + 700e0 * embedding[p]))) AS int) AS r,
               CAST(greatest(0, least(255, floor(110 + 700e0 * embedding[(p + 21) % 64]))) AS int) AS g,
               CAST(greatest(0, least(255, floor(110 + 700e0 * embedding[(p + 42) % 64]))) AS int) AS b
        FROM (SELECT vec_id, embedding, explode(sequence(0, 63)) AS p FROM {embeddings})""",
    "recordings": """
        SELECT user_id AS recording, event_id, CAST(event_id AS string) AS file,
               timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', CAST(ts AS timestamp_ntz)) / 1e6
                   AS seconds, event_type FROM {events}""",
}


def _uses(text: str) -> list[str]:
    return sorted({name for _, name, _, _ in Formatter().parse(text) if name})


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A provided table or a view, as a Spark DataFrame."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text = SPARK_VIEWS.get(name, VIEWS.get(name))
    return spark.sql(text, **{used: load(spark, sf_dir, used) for used in _uses(text)})


def oracle(body: str) -> str:
    """DuckDB text: the views the body names with ``{view}``, then the body."""
    needed: list[str] = []

    def need(text: str) -> None:
        for used in _uses(text):
            if used in TABLES or used in needed:
                continue
            need(VIEWS[used])
            needed.append(used)

    need(body)
    ctes = ",\n".join(f"{n} AS ({_named(VIEWS[n])})" for n in needed)
    head = f"WITH {ctes}\n" if needed else ""
    return f"{head}SELECT * FROM ({_named(body)})"


def _named(text: str) -> str:
    return text.format(**{used: used for used in _uses(text)})
