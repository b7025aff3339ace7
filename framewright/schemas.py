"""Schemas and codes shared by sources, operators and sinks."""

from __future__ import annotations

from pyspark.sql import types as T

# The codes below are part of the data contract.
STATUS_EMPTY, STATUS_WEAK, STATUS_OK = "empty", "weak", "ok"
FRAME_STATUSES = (STATUS_EMPTY, STATUS_WEAK, STATUS_OK)

KEEP, DROP, DISPUTED = "keep", "drop", "disputed"
BOX_VERDICTS = (KEEP, DROP, DISPUTED)

FATE_CLEAN, FATE_FIXED, FATE_NEGATIVE = "clean", "fixed", "negative"
FATE_DISPUTED, FATE_NO_BOXES, FATE_FROM_EXPORT = "disputed", "no_boxes", "from_export"
FRAME_FATES = (FATE_CLEAN, FATE_FIXED, FATE_NEGATIVE, FATE_DISPUTED, FATE_NO_BOXES)

BOX_CATEGORIES = (
    "ad_surface",
    "storefront_sign",
    "vehicle_ad",
    "road_sign",
    "building",
    "vehicle",
    "nature_or_blur",
    "other",
)
KEPT_CATEGORIES = ("ad_surface", "storefront_sign", "vehicle_ad")
CATEGORY_ERROR = "error"

# Fixed value: an unquoted empty cell of a CSV file is null, a quoted one an empty text; so is this cell, and a text like it gets one more backslash.
NULL_CELL = "\\N"

CONFIRMED, REVIEW, REJECTED = "confirmed", "review", "rejected"
BASIS_NAME, BASIS_LOGO, BASIS_COLORS = "name_read", "logo_only", "colors_only"
OTHER, UNCLEAR, UNSURE = "other", "unclear", "unsure"

SPLITS = ("train", "val", "test")
HUMAN_SPLIT, HOLDOUT_SPLIT = "test_handmade", "holdout"

# Brands the scorecards know, and the classes of the trained head, in label order.
TARGETS = ("beeline", "megafon", "mts", "tele2", "volna", "miranda", "plus7")
HEAD_CLASSES = ("beeline", "megafon", "tele2", "other")

# How a brand is spelled in text read from a picture.
NAME_FORMS = {
    "beeline": ("билайн", "beeline"),
    "megafon": ("мегафон", "megafon"),
    "mts": ("мтс", "mts", "mtc"),
    "tele2": ("tele2", "теле2", "т2", "t2"),
    "volna": ("волна", "volna", "win mobile"),
    "miranda": ("миранда", "miranda"),
    "plus7": ("+7 телеком", "+7телеком", "7 телеком", "7телеком", "7telecom"),
}
STANDALONE_WORDS = {"plus7": ("телеком",)}
PACKED_MIN_LENGTH = 3


def _table(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


S, I, L, D, B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()

REPORT = _table(file=S, width=I, height=I, boxes=I, min_confidence=D, max_confidence=D, status=S)
BOXES = _table(
    box_id=S, file=S, index=I, center_x=D, center_y=D, width=D, height=D, confidence=D, area_share=D, crop=S
)
ANSWERS = _table(box_id=S, crop=S, category=S, reason=S, seconds=D, answered_at=L)
VERDICTS = _table(box_id=S, verdict=S, note=S)
FRAMES = _table(file=S, status=S, boxes_before=I, boxes_after=I, note=S)
TRUTH = _table(file=S, brand=S, source=S, quality=S)
OUTCOMES = _table(
    file=S, brand=S, raw_brand=S, basis=S, verdict=S, truth=S, visible_text=S, evidence=S, error=S
)
DETECTION = _table(x1=D, y1=D, x2=D, y2=D, confidence=D)
JUDGE_REPLY = _table(category=S, reason=S)
BRAND_REPLY = _table(brand=S, basis=S, visible_text=S, evidence=S)
