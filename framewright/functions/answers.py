"""Model answers: parsing, trust, decisions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewright import schemas as C

SPACES = r"(?U)\s+"


def name_in_text(
    brand: Column,
    text: Column,
    forms: dict[str, tuple[str, ...]] = C.NAME_FORMS,
    standalone: dict[str, tuple[str, ...]] = C.STANDALONE_WORDS,
) -> Column:
    """Does the text hold a spelling of the claimed brand?

    A spelling counts as it stands, without spaces if it is long enough, and as
    a whole word where the word alone proves the brand.
    """
    low = F.lower(text)
    packed = F.regexp_replace(low, SPACES, "")
    test = F.lit(False)
    for name, spellings in forms.items():
        checks = [F.contains(low, F.lit(s)) for s in spellings]
        tight = {"".join(s.split()) for s in spellings}
        checks += [F.contains(packed, F.lit(s)) for s in sorted(tight) if len(s) >= C.PACKED_MIN_LENGTH]
        checks += [
            low.rlike(f"(?<![a-zа-яё]){re.escape(word)}(?![a-zа-яё])") for word in standalone.get(name, ())
        ]
        hit = checks[0]
        for check in checks[1:]:
            hit = hit | check
        test = F.when(brand == name, hit).otherwise(test)
    return F.coalesce(test, F.lit(False))


def trust(
    brand: Column, basis: Column, text: Column, error: Column, forms: dict[str, tuple[str, ...]] = C.NAME_FORMS, **kw
) -> Column:
    """How far the named brand can be trusted."""
    silent = (F.coalesce(error, F.lit("")) != "") | ~brand.isin(*forms)
    return (
        F.when(silent, F.lit(C.CONFIRMED))
        .when(basis == C.BASIS_COLORS, F.lit(C.REJECTED))
        .when(name_in_text(brand, text, forms, **kw), F.lit(C.CONFIRMED))
        .otherwise(F.lit(C.REVIEW))
    )


def decided(brand: Column, verdict: Column, *, accept_logo: bool = False) -> Column:
    """Final answer; an untrusted brand becomes ``unclear``."""
    accepted = (C.CONFIRMED, C.REVIEW) if accept_logo else (C.CONFIRMED,)
    return F.when(verdict.isin(*accepted), brand).otherwise(F.lit(C.UNCLEAR))


def flip_mark(truth: Column, before: Column, after: Column) -> Column:
    """Label of a changed decision; null where the decision stayed."""
    return F.when(
        before != after,
        F.when(after == truth, F.lit("fixed")).when(before == truth, F.lit("broken")).otherwise(F.lit("still_wrong")),
    )


def pick_class(probabilities: Column, classes: tuple[str, ...], floor: float) -> dict[str, Column]:
    """First arg-max class, or ``unsure`` below the confidence floor."""
    best = F.array_max(probabilities)
    names = F.array(*[F.lit(c) for c in classes])
    winner = F.element_at(names, F.array_position(probabilities, best).cast("int"))
    return {"brand": F.when(best >= floor, winner).otherwise(F.lit(C.UNSURE)), "confidence": best}


def class_index(brand: Column, classes: tuple[str, ...] = C.HEAD_CLASSES) -> Column:
    """Position of a class in the fixed order; null for a stranger."""
    place = F.array_position(F.array(*[F.lit(c) for c in classes]), brand)
    return F.when(place > 0, place - 1).cast("int")


def _read_json(reply: Column, schema: T.StructType) -> tuple[Column, Column]:
    """Parsed struct and a flag for text that is not such JSON."""
    flagged = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    parsed = F.from_json(reply, flagged, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    return parsed, parsed.isNull() | parsed["_bad"].isNotNull()


def parse_brand_reply(reply: Column, failure: Column) -> dict[str, Column]:
    """JSON reply → fields with defaults.  Anything unreadable turns into an error row."""
    parsed, unreadable = _read_json(reply, C.BRAND_REPLY)
    error = F.coalesce(failure, F.when(unreadable, F.lit("unreadable reply")), F.lit(""))

    def field(name: str, default: str) -> Column:
        return F.when(error == "", F.coalesce(parsed[name], F.lit(default))).otherwise(F.lit(default))

    return {
        "brand": field("brand", C.UNCLEAR),
        "basis": field("basis", C.BASIS_COLORS),
        "evidence": field("evidence", ""),
        "visible_text": field("visible_text", ""),
        "error": error,
    }


def parse_judge_reply(reply: Column, failure: Column) -> dict[str, Column]:
    """Judge reply → category and one-line reason; a failure is logged as category ``error``."""
    parsed, unreadable = _read_json(reply, C.JUDGE_REPLY)
    failed = failure.isNotNull() | unreadable
    why = F.coalesce(failure, F.lit("unreadable reply"))
    return {
        "category": F.when(failed, F.lit(C.CATEGORY_ERROR)).otherwise(
            F.coalesce(parsed["category"], F.lit(C.CATEGORY_ERROR))
        ),
        "reason": F.translate(
            F.when(failed, why).otherwise(F.coalesce(parsed["reason"], F.lit(""))), "\n", " "
        ),
    }
