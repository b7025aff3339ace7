"""Secret scans over an incremental ledger of blobs.

Contents are addressed by their SHA-256.  The ledger has one row per scanned pair of blob and rule version, findings or none.  A
scan takes every historical version of every path, drops the pairs that the ledger knows, scans the contents that are left
(once per task, however many paths share them), and appends.  Findings then join back to all paths and versions.  A changed rule
changes the rule version, so everything counts as unseen again.

Offsets are code points, the end exclusive.  Defined results: null content counts as empty; paths and versions may be null or
repeated; equal spans of different kinds stay; an empty table gives an empty result; other columns are ignored by
:func:`scan_unseen` and passed through by :func:`findings`.
"""

from __future__ import annotations

import hashlib
import re
import string
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.llm.common import as_text


@dataclass(frozen=True)
class Rule:
    """A kind of secret.  ``hints``: lower-case strings of which a text must hold one; ``group`` must have ``least`` characters.

    With ``opens`` the pattern is what follows a run of ``run`` characters, in which the match begins at the first ``opens`` that has
    ``least`` more of them behind it.  So a run is looked at once, however often ``opens`` is in it.
    """

    kind: str
    pattern: str
    hints: tuple[str, ...] = ()
    flags: int = 0
    group: int = 0
    least: int = 0
    opens: str = ""
    run: str = ""


BASE = (
    Rule(
        "assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        ("password", "passwd", "secret", "token", "apikey", "api_key"), re.IGNORECASE | re.ASCII, 2, 6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", ("akia",), 0, 0, 20),
    Rule("hex", r"[0-9a-f]{24,}"),
)
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", ("-----begin",)),
    Rule("jwt", r"\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+", ("eyj",), 0, 0, 8, "eyJ", string.ascii_letters + string.digits + "_-"),
    Rule("forge", r"gh[opsu]_[A-Za-z0-9]{36,}", ("gho_", "ghp_", "ghs_", "ghu_")),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}", ("xox",)),
)
RULES = BASE + MORE
SPANS = "array<struct<kind:string,start:int,stop:int>>"
#: Blobs a task remembers so as not to scan them twice.
MEMORY = 1_000_000


def rule_version(rules: tuple[Rule, ...] = RULES) -> str:
    return hashlib.sha256(repr(rules).encode()).hexdigest()[:16]


def spans(text: str, rules: tuple[Rule, ...] = RULES) -> list[tuple[int, int, int]]:
    """Findings ``(start, number of the rule, end)`` in order of start, then rule."""
    found, lower = [], text.lower()
    for number, rule in enumerate(rules):
        if rule.hints and not any(h in lower for h in rule.hints):
            continue
        if rule.opens:
            found += [(a, number, b) for a, b in _after_runs(rule, text)]
            continue
        for match in re.finditer(rule.pattern, text, rule.flags):
            if len(match[rule.group]) >= rule.least:
                found.append((match.start(), number, match.end()))
    return sorted(found)


def _after_runs(rule: Rule, text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, one after another, of a rule that opens inside a run."""
    pattern, at, free = re.compile(rule.pattern, rule.flags), 0, 0
    while (match := pattern.search(text, at)) is not None:
        run = match.start()
        while run > free and text[run - 1] in rule.run:
            run -= 1
        start = text.find(rule.opens, run, max(run, match.start() - rule.least))
        if start < 0:
            at = match.start() + 1
        else:
            at = free = match.end()
            yield start, free


def _scanner(rules: tuple[Rule, ...], version: str) -> Callable:
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())])
    schema = pa.schema([("blob", pa.binary()), ("rule_version", pa.string()), ("spans", pa.list_(span))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            blobs, found = [], []
            for blob, text in zip(batch["blob"].to_pylist(), as_text(batch["content"])):
                if blob in seen:
                    continue
                if len(seen) < MEMORY:
                    seen.add(blob)
                blobs.append(blob)
                found.append([{"kind": rules[n].kind, "start": a, "stop": b} for a, n, b in spans(text, rules)])
            yield pa.record_batch([pa.array(blobs, pa.binary()), pa.array([version] * len(blobs), pa.string()), pa.array(found, pa.list_(span))], schema=schema)

    return run


def blob_id(content: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(content, F.lit("")), 256))


def ledger_at(spark: SparkSession, path: str) -> DataFrame | None:
    """The ledger of a folder: ``blob, rule_version, spans``; None where nothing was scanned yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def scan_unseen(versions: DataFrame, ledger: DataFrame | None, *, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows for the contents (``content``) whose pair of blob and rule version the ledger lacks."""
    version = rule_version(rules)
    blobs = versions.select(blob_id(F.col("content")).alias("blob"), "content")
    if ledger is not None:
        blobs = blobs.join(ledger.filter(F.col("rule_version") == version).select("blob"), "blob", "left_anti")
    scanned = blobs.mapInArrow(_scanner(rules, version), f"blob binary, rule_version string, spans {SPANS}")
    return scanned.dropDuplicates(["blob", "rule_version"])


def update(versions: DataFrame, path: str, *, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan what the ledger below ``path`` lacks, append it, and return the whole ledger."""
    spark = versions.sparkSession
    scan_unseen(versions, ledger_at(spark, path), rules=rules).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def findings(versions: DataFrame, ledger: DataFrame, *, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Every version of every path with the ``spans`` of its content; ``content`` itself is left out."""
    known = ledger.filter(F.col("rule_version") == rule_version(rules)).select(F.col("blob").alias("_blob"), "spans")
    own = versions.drop("spans").withColumn("_blob", blob_id(F.col("content"))).drop("content")
    return own.join(known, "_blob").drop("_blob")


def span_list(spans_: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans_, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def of_kinds(spans_: Column, *kinds: str) -> Column:
    return F.filter(spans_, lambda s: s["kind"].isin(*kinds))
