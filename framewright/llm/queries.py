"""The operators of this subpackage as queries over the provided tables, with the SQL that checks them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.llm import (
    bpe,
    conversations,
    decontaminate,
    exact,
    license_scan,
    secret_scan,
    sharding,
    simhash,
    spelling,
    substrings,
    suffix_tree,
    token_files,
    toxicity,
)
from framewright.llm.common import table
from framewright.session import scratch_path

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def _query(build):
    QUERIES[build.__name__] = build
    return build


@_query
def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


@_query
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact.exact_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLES["op10_exact_dedup"] = r"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm, length(coalesce(text, '')) AS n
  FROM documents
), g AS (SELECT norm, count(*) AS group_size FROM d GROUP BY norm),
w AS (
  SELECT norm, doc_id AS keep_id
  FROM (SELECT norm, doc_id, row_number() OVER (PARTITION BY norm ORDER BY n DESC, doc_id) AS r FROM d) WHERE r = 1
)
SELECT d.doc_id, w.keep_id, g.group_size, d.doc_id = w.keep_id AS kept, sha256(d.norm) AS text_sha256
FROM d JOIN g USING (norm) JOIN w USING (norm)
"""


@_query
def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_id")


ORACLES["op2_benchmark_decontamination"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents
), i AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark
), iw AS (
  SELECT DISTINCT item_id, w[k : k + least(len(w), 10) - 1] AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS k FROM i WHERE len(w) > 0)
), dw AS (
  SELECT r, p, n, w[p : p + n - 1] AS win
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT len(win) AS n FROM iw) WHERE len(w) >= n)
), m AS (SELECT r, p, n, item_id FROM dw JOIN iw USING (win)),
h AS (SELECT r, count(DISTINCT pos) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS pos FROM m) GROUP BY r),
t AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, CAST(item_id AS varchar) AS item FROM m) GROUP BY r
)
SELECT d.doc_id, CAST(len(d.w) AS bigint) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN t USING (r)
"""


@_query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


@_query
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


@_query
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup_substrings(table(spark, sf_dir, "documents"))


ORACLES["op3_substring_dedup"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), p AS (SELECT r, unnest(range(1, len(w) - 33)) AS k, w FROM d WHERE len(w) >= 35),
h AS (SELECT r, k, sha256(array_to_string(w[k : k + 34], ' ')) AS h FROM p),
again AS (SELECT h FROM h GROUP BY h HAVING count(*) > 1),
cut AS (SELECT r, list(DISTINCT pos) AS gone FROM (SELECT r, unnest(range(k, k + 35)) AS pos FROM h SEMI JOIN again USING (h)) GROUP BY r)
SELECT d.doc_id, CAST(len(w) AS bigint) AS n_words, CAST(coalesce(len(gone), 0) AS bigint) AS n_removed,
       sha256(coalesce(array_to_string(CASE WHEN gone IS NULL THEN w
         ELSE list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(gone, i)), lambda i: w[i]) END, ' '), '')) AS kept_sha256
FROM d LEFT JOIN cut USING (r)
"""


@_query
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    versions = docs.select("doc_id", F.col("text").alias("content"))
    ledger = secret_scan.update(versions, scratch_path(spark, "secret-ledger"))
    found = secret_scan.findings(versions, ledger)
    base = secret_scan.of_kinds(F.col("spans"), *(r.kind for r in secret_scan.BASE))
    counts = [
        F.size(secret_scan.of_kinds(F.col("spans"), r.kind)).cast("long").alias(f"n_{r.kind}") for r in secret_scan.BASE
    ]
    return found.select(
        "doc_id", *counts, F.sha2(secret_scan.span_list(base), 256).alias("base_sha256"), secret_scan.span_list(F.col("spans")).alias("spans")
    )


#: The kinds as the SQL engine matches them: pattern, its measured group, least length.
_SECRET_SQL = (
    ("assign", r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
     r"""["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
    ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 0),
    ("forge", r"gh[opsu]_[A-Za-z0-9]{36,}", 0, 0),
    ("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 0),
)  # fmt: skip


def _secret_sql() -> str:
    kinds = []
    for number, (kind, pattern, group, least) in enumerate(_SECRET_SQL):
        kinds.append(f"""
          SELECT r, {number} AS o, '{kind}' AS kind, measured,
                 sum(length(part)) OVER w + coalesce(sum(length(whole)) OVER before, 0) AS a, length(whole) AS n, {least} AS least
          FROM (SELECT r, generate_subscripts(m, 1) AS i, unnest(m) AS whole, unnest(g) AS measured, unnest(parts[1 : len(m)]) AS part
                FROM (SELECT r, regexp_extract_all(t, '{pattern}') AS m, regexp_extract_all(t, '{pattern}', {group}) AS g,
                             string_split_regex(t, '{pattern}') AS parts FROM d))
          WINDOW w AS (PARTITION BY r ORDER BY i), before AS (PARTITION BY r ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
    return f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
    s AS ({" UNION ALL ".join(kinds)}),
    f AS (SELECT r, kind, concat(kind, ':', CAST(a AS bigint), ':', CAST(a + n AS bigint)) AS span, a, o FROM s WHERE length(measured) >= least),
    x AS (
      SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
             count(*) FILTER (kind = 'hex') AS n_hex, string_agg(span, ',' ORDER BY a, o) FILTER (o < 3) AS base,
             string_agg(span, ',' ORDER BY a, o) AS spans
      FROM f GROUP BY r)
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
           sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM d LEFT JOIN x USING (r)"""


ORACLES["op4_secret_scan"] = _secret_sql()


@_query
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.licences(table(spark, sf_dir, "documents"))


def _license_sql() -> str:
    known = ", ".join(f"('{i}', '{s}')" for i, s in license_scan.SENTENCES.items())
    marked = "seq"
    for licence, ids in license_scan.RULES:
        marked = f"replace({marked}, '{license_scan.sequence_of(ids)}', '[{licence}]')"
    return rf"""
    WITH known(id, sentence) AS (VALUES {known}),
    d AS (SELECT row_number() OVER () AS r, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
          FROM documents),
    cut AS (SELECT r, generate_subscripts(p, 1) AS pos, unnest(p) AS raw
            FROM (SELECT r, string_split_regex(t, '[.!?;:]+[\x20\x09-\x0D]+|[.!?;:]+\z|[\n\r]+') AS p FROM d)),
    hit AS (SELECT r, pos, id FROM (SELECT r, pos, trim(regexp_replace(raw, '[^a-z0-9]+', ' ', 'g')) AS sentence FROM cut) JOIN known USING (sentence)),
    s AS (SELECT r, count(*) AS n, string_agg('<' || id || '>', '' ORDER BY pos) AS seq FROM hit GROUP BY r),
    m AS (SELECT r, n, seq, {marked} AS marked FROM s)
    SELECT doc_id, coalesce(n, 0) AS n_sentences, coalesce(seq, '') AS sequence,
           coalesce(array_to_string(regexp_extract_all(marked, '\[([^\]]+)\]', 1), ','), '') AS licenses,
           CAST(coalesce(len(regexp_extract_all(marked, '<[^>]+>')), 0) AS bigint) AS n_unmatched
    FROM d LEFT JOIN m USING (r)"""


ORACLES["op5_license_scan"] = _license_sql()


@_query
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), 2)
    return token_files.documents(spark, path)


@_query
def op7_suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.scores(table(spark, sf_dir, "documents"))


@_query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repairs(conversations.damaged(table(spark, sf_dir, "conversations")))


#: One row with the 256 remainders of CRC-32, which follow from its polynomial.
_REMAINDERS_SQL = """
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS remainders"""


def _crc_sql(text: str) -> str:
    """CRC-32 of the UTF-8 of a text of code points below 2,048; ``remainders`` is in scope."""
    octets = f"""flatten(list_transform(string_split({text}, ''),
      lambda p: CASE WHEN unicode(p) < 128 THEN [CAST(unicode(p) AS bigint)] ELSE [192 + (unicode(p) >> 6), 128 + (unicode(p) & 63)] END))"""
    step = "lambda c, o: xor(c >> 8, remainders[xor(c & 255, o) + 1])"
    return f"xor(list_reduce({octets}, {step}, CAST(4294967295 AS bigint)), 4294967295)"


#: A plain forward table over all rows and states, cheapest and least audit first; up to two insertions before each row.
ORACLES["op11_conversation_repair"] = rf"""
WITH RECURSIVE rest AS ({_REMAINDERS_SQL}),
raw AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               concat(coalesce(CAST(conv_id AS varchar), ' '), ':', coalesce(CAST(turn AS varchar), ' ')) AS place FROM conversations),
fate AS (SELECT * EXCLUDE (place, remainders), {_crc_sql("place")} % 20 AS f FROM raw, rest),
hurt AS (
  SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN f = 1 THEN '' WHEN f = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE WHEN f = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM fate WHERE f <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(concat(length(role), ':', role, ':', text)), copy) AS i
  FROM hurt),
judged AS (
  SELECT *, left(role, 1) AS r, regexp_replace(text, '[ 	-]+\z', '') AS t,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS seen,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM placed),
f AS (
  SELECT conv_id, i, turn, role, text, r, before, CASE WHEN t = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate'
         WHEN right(t, 1) IN ('.', '!', '?') THEN 'fine' ELSE 'truncated' END AS fault
  FROM judged),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || r NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
  FROM f GROUP BY conv_id),
follow(s, t, line) AS (VALUES (0, 2, 'user:'), (1, 2, 'user:'), (2, 3, 'assistant:'), (3, 2, 'user:')),
gap(s, t, cost, audit, lines) AS (
  SELECT s, s, 0, '', '' FROM follow UNION ALL SELECT s, t, 5, 'I', line || chr(10) FROM follow
  UNION ALL SELECT a.s, b.t, 10, 'II', a.line || chr(10) || b.line || chr(10) FROM follow a JOIN follow b ON a.t = b.s),
edge(s, t, r, cost, audit, line) AS (
  SELECT s, s, NULL, 2, 'D', NULL FROM follow UNION ALL SELECT s, t, NULL, 1, 'R', line FROM follow
  UNION ALL SELECT s, t, left(line, 1), 0, 'K', NULL FROM follow UNION ALL SELECT 0, 1, 's', 0, 'K', NULL),
step AS (
  SELECT g.s, e.t, e.r, g.cost + e.cost AS cost, g.audit || e.audit AS audit, e.audit AS kind, g.lines, e.line FROM gap g JOIN edge e ON g.t = e.s),
path(conv_id, i, s, best) AS (
  SELECT conv_id, CAST(0 AS bigint), 0, {{'cost': CAST(0 AS bigint), 'audit': '', 'lines': ''}} FROM counts
  UNION ALL
  SELECT p.conv_id, f.i, e.t, min({{
           'cost': p.best.cost + e.cost + CASE WHEN fault = 'truncated' AND kind <> 'D' THEN 5 ELSE 0 END, 'audit': p.best.audit || e.audit,
           'lines': p.best.lines || e.lines || CASE kind WHEN 'D' THEN '' WHEN 'K' THEN role || ':' || text || chr(10)
                    ELSE e.line || text || chr(10) END}})
  FROM path p JOIN f ON p.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = p.i + 1
    JOIN step e ON e.s = p.s AND (e.r IS NULL OR e.r = f.r) AND (kind = 'D' OR fault IN ('fine', 'truncated'))
  GROUP BY p.conv_id, f.i, e.t),
done AS (
  SELECT p.conv_id, min({{'cost': p.best.cost + g.cost, 'audit': p.best.audit || g.audit, 'lines': p.best.lines || g.lines}}) AS best
  FROM path p JOIN counts c ON p.conv_id IS NOT DISTINCT FROM c.conv_id AND p.i = c.n JOIN gap g ON g.s = p.s AND g.t IN (0, 3)
  GROUP BY p.conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0) AS cost, coalesce(best.audit, '') AS audit,
       sha256(coalesce(left(best.lines, greatest(length(best.lines) - 1, 0)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
  LEFT JOIN done d ON o.conv_id IS NOT DISTINCT FROM d.conv_id
"""


@_query
def op12_byte_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@_query
def op13_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(table(spark, sf_dir, "documents"), lose=31)


ORACLES["op13_spelling_groups"] = rf"""
WITH RECURSIVE rest AS ({_REMAINDERS_SQL}),
runs AS (SELECT coalesce(CAST(doc_id AS varchar), '') AS doc, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents),
marked AS (SELECT w, {_crc_sql("concat(doc, ':', w)")} AS h FROM runs, rest WHERE length(w) >= 7),
words AS (
  SELECT w, count(*) AS n
  FROM (SELECT CASE WHEN h % 31 = 0 THEN concat(left(w, h % length(w)), substring(w, h % length(w) + 2)) ELSE w END AS w FROM marked)
  WHERE length(w) >= 7 GROUP BY w HAVING count(*) >= 2),
spot AS (SELECT w, n, unnest(range(length(w) + 1)) AS i FROM words),
cut AS (SELECT w, n, left(w, i) AS a, substring(w, i + 1) AS b FROM spot),
skip AS (SELECT w, n, left(w, i) AS a, substring(w, i + 2) AS b FROM spot WHERE i < length(w)),
near AS (
  SELECT x.w, x.n, y.w AS v, y.n AS m FROM skip x JOIN skip y USING (a, b) WHERE x.w <> y.w
  UNION SELECT x.w, x.n, y.w, y.n FROM skip x JOIN cut y USING (a, b) UNION SELECT y.w, y.n, x.w, x.n FROM skip x JOIN cut y USING (a, b)),
best AS (SELECT w, count(*) AS n_near, max(m) AS m, arg_min(v, {{'back': -m, 'v': v}}) AS v FROM near GROUP BY w),
form AS (SELECT words.w, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * n THEN v END AS v, CASE WHEN m >= 10 * n THEN m END AS m
         FROM words LEFT JOIN best USING (w)),
walk AS (SELECT w, w AS root, v AS ahead FROM form UNION ALL SELECT walk.w, form.w, form.v FROM walk JOIN form ON walk.ahead = form.w)
SELECT form.w AS word, v AS form, root, n, n_near, m AS form_n FROM form JOIN walk ON form.w = walk.w AND walk.ahead IS NULL
"""
