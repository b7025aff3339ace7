"""Boxes, crops and layouts as column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from framewright.functions.decimals import fixed

MIN_AREA = 1e-6


def _within(value: Column, upper: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(value.cast("double"), upper.cast("double")))


def shares(x1: Column, y1: Column, x2: Column, y2: Column, width: Column, height: Column) -> dict[str, Column]:
    """Pixel corners → centre and size as shares of the frame, unclamped (scan path)."""
    return {
        "cx": (x1 + x2) / F.lit(2.0) / width,
        "cy": (y1 + y2) / F.lit(2.0) / height,
        "w": (x2 - x1) / width,
        "h": (y2 - y1) / height,
    }


def clamped_shares(
    x1: Column, y1: Column, x2: Column, y2: Column, width: Column, height: Column
) -> dict[str, Column]:
    """Like :func:`shares`, with the corners first pulled inside the frame (label path)."""
    return shares(
        _within(x1, width), _within(y1, height), _within(x2, width), _within(y2, height), width, height
    )


def label_line(cx: Column, cy: Column, w: Column, h: Column, class_id: int = 0) -> Column:
    """One line of label text: class and four shares with six decimals."""
    return F.concat_ws(" ", F.lit(str(class_id)), *[fixed(c, 6) for c in (cx, cy, w, h)])


def stem(file: Column) -> Column:
    """File name without folder and last suffix.

    Plain string functions: this runs once or more per row of every table.
    """
    name = F.substring_index(file, "/", -1)
    dot = F.length(name) - F.length(F.substring_index(name, ".", -1))
    return F.when(dot > 1, F.left(name, dot - 1)).otherwise(name)


def crop_name(file: Column, index: Column) -> Column:
    return F.concat(stem(file), F.lit("__"), index.cast("string"), F.lit(".jpg"))


def intersection(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Area that two centre/size boxes share."""

    def overlap(centre: str, size: str) -> Column:
        low = F.greatest(a[centre] - a[size] / 2, b[centre] - b[size] / 2)
        high = F.least(a[centre] + a[size] / 2, b[centre] + b[size] / 2)
        return F.greatest(F.lit(0.0), high - low)

    return overlap("cx", "w") * overlap("cy", "h")


def iou(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Intersection over union of two centre/size boxes; 0 when the union is empty."""
    inter = intersection(a, b)
    union = a["w"] * a["h"] + b["w"] * b["h"] - inter
    return F.when(union != 0.0, inter / union).otherwise(F.lit(0.0))


def crop_window(
    cx: Column, cy: Column, w: Column, h: Column, width: Column, height: Column, *, margin: float, max_side: int
) -> dict[str, Column]:
    """Crop rectangle around a box: margin on each side, inside the frame, never empty.

    A box beside the frame gives the frame's last row or column.
    """

    def span(centre: Column, size: Column, full: Column) -> tuple[Column, Column]:
        low = F.greatest(F.lit(0), F.least(full - 1, ((centre - size / 2 - size * margin) * full).cast("int")))
        high = F.least(full, ((centre + size / 2 + size * margin) * full).cast("int"))
        return low, F.greatest(high, low + 1)

    left, right = span(cx, w, width)
    top, bottom = span(cy, h, height)
    longest = F.greatest(right - left, bottom - top)
    return {
        "left": left,
        "top": top,
        "right": right,
        "bottom": bottom,
        "scale": F.least(F.lit(1.0), F.lit(float(max_side)) / longest),
    }


def shrink(width: Column, height: Column, side: int, *, enlarge: bool = False) -> dict[str, Column]:
    """New size that fits into a square of ``side``: half-even rounding, at least one pixel."""
    scale = F.lit(float(side)) / F.greatest(width, height)
    if not enlarge:
        scale = F.least(F.lit(1.0), scale)
    fit = lambda c: F.greatest(F.lit(1), F.bround(c * scale, 0).cast("int"))
    return {"scale": scale, "new_width": fit(width), "new_height": fit(height)}


def letterbox(width: Column, height: Column, side: int) -> dict[str, Column]:
    """Centred placement of a frame in a square: size and offsets."""
    size = shrink(width, height, side, enlarge=True)
    offset = lambda c: F.floor((F.lit(side) - c) / F.lit(2)).cast("int")
    return size | {"offset_x": offset(size["new_width"]), "offset_y": offset(size["new_height"])}


def size_features(width: Column, height: Column) -> dict[str, Column]:
    """What the size of a picture gives away about its source."""
    w, h = width.cast("double"), height.cast("double")
    return {
        "log_width": F.log10(w),
        "log_height": F.log10(h),
        "aspect": w / h,
        "log_area": F.log10(w * h),
    }
