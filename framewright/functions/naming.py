"""What file names tell: group, recording, time, pair."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from framewright.functions.geometry import stem

# Name patterns the data follows.
HEX_NAME = r"^[0-9a-f]{12,}$"
FRAME_NAME = r"^frame_(\d+)_t(\d+\.\d+)"
COPY_MARK = r"(_aug$|^truckaug_)"


def group_of(file: Column) -> Column:
    """Shooting a frame belongs to: hash names are ``raw``, bare numbers ``numbers``."""
    name = stem(file)
    prefix = F.btrim(F.regexp_replace(name, "[0-9].*$", ""), F.lit("_"))
    return (
        F.when(F.lower(name).rlike(HEX_NAME), F.lit("raw"))
        .when(prefix == "", F.lit("numbers"))
        .otherwise(prefix)
    )


def video_moment(file: Column) -> dict[str, Column]:
    """Recording and seconds of a video frame; both null for a still."""
    name = F.substring_index(file, "/", -1)
    number = F.regexp_extract(name, FRAME_NAME, 1).try_cast("double")
    seconds = F.nullif(F.regexp_extract(name, FRAME_NAME, 2).try_cast("double"), F.lit(0.0))
    return {"recording": F.bround(number / seconds, 0).cast("long"), "seconds": seconds}


def pair_key(file: Column) -> Column:
    """Key an original shares with its augmented copies: ``truckaug_x`` and ``truck_x_aug`` belong to ``truck_x``."""
    return F.regexp_replace(F.regexp_replace(stem(file), "_aug$", ""), "^truckaug_", "truck_")


def without_copy_suffix(file: Column) -> Column:
    return F.regexp_replace(stem(file), "_aug$", "")


def is_copy(file: Column, pattern: str = COPY_MARK) -> Column:
    return stem(file).rlike(pattern)


def blinded_name(number: Column, file: Column) -> Column:
    suffix = F.lower(F.regexp_extract(file, r"(\.[^./]+)$", 1))
    return F.concat(F.format_string("img_%04d", number), suffix)


def probe_name(source: Column, file: Column) -> Column:
    return F.concat(F.translate(source, "/ ", "-_"), F.lit("__"), file)
