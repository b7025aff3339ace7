"""Colour constants and conversions as column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Palette anchors in sRGB, and what brands look like in terms of them.
ANCHORS = {
    "black": (20, 20, 20),
    "dark_gray": (70, 70, 70),
    "gray": (128, 128, 128),
    "light_gray": (190, 190, 190),
    "white": (245, 245, 245),
    "yellow": (255, 204, 0),
    "orange": (240, 130, 20),
    "red": (200, 30, 30),
    "magenta": (230, 0, 126),
    "purple": (115, 25, 130),
    "blue": (20, 50, 140),
    "cyan": (0, 174, 239),
    "green": (0, 185, 86),
    "beige": (200, 170, 140),
}
KERNEL_SIGMA = 15.0
COARSE_GRID, FINE_GRID = 4, 8
ACHROMATIC_CHROMA = 12.0
PROTOTYPES = {
    "beeline": {"yellow": 0.5, "black": 0.5},
    "megafon": {"green": 0.6, "purple": 0.2, "white": 0.2},
    "tele2": {"black": 0.45, "white": 0.35, "magenta": 0.20},
}
REQUIRED = {"beeline": ("yellow", "black"), "megafon": ("green",), "tele2": ("black", "white")}
PAIRS = {
    "beeline": (("yellow", "black"),),
    "megafon": (("green", "white"), ("green", "purple")),
    "tele2": (("black", "white"), ("black", "magenta")),
}
# sRGB to XYZ under D65, and the reference white.
RGB_TO_XYZ = ((0.412453, 0.357580, 0.180423), (0.212671, 0.715160, 0.072169), (0.019334, 0.119193, 0.950227))
WHITE = (0.950456, 1.0, 1.088754)
LINEAR_BELOW = 0.008856


def lab(r: Column, g: Column, b: Column) -> dict[str, Column]:
    """8-bit sRGB → Lab with L in 0–100 and a, b around zero, in steps of an 8-bit image."""

    def linear(c: Column) -> Column:
        v = c / F.lit(255.0)
        return F.when(v <= 0.04045, v / 12.92).otherwise(F.pow((v + 0.055) / 1.055, F.lit(2.4)))

    def curve(t: Column) -> Column:
        return F.when(t > LINEAR_BELOW, F.cbrt(t)).otherwise(7.787 * t + 16.0 / 116.0)

    rgb = (linear(r), linear(g), linear(b))
    x, y, z = (
        (rgb[0] * row[0] + rgb[1] * row[1] + rgb[2] * row[2]) / F.lit(white)
        for row, white in zip(RGB_TO_XYZ, WHITE, strict=True)
    )
    lightness = F.when(y > LINEAR_BELOW, 116.0 * F.cbrt(y) - 16.0).otherwise(903.3 * y)
    return {
        "L": F.round(lightness * 2.55, 0) * F.lit(100.0 / 255.0),
        "a": F.round(500.0 * (curve(x) - curve(y)), 0),
        "b": F.round(200.0 * (curve(y) - curve(z)), 0),
    }


def anchor_lab(rgb: tuple[int, int, int]) -> tuple[float, float, float]:
    """The same conversion for one constant colour."""

    def linear(c: int) -> float:
        v = c / 255.0
        return v / 12.92 if v <= 0.04045 else ((v + 0.055) / 1.055) ** 2.4

    def curve(t: float) -> float:
        return t ** (1 / 3) if t > LINEAR_BELOW else 7.787 * t + 16.0 / 116.0

    values = [linear(c) for c in rgb]
    x, y, z = (
        sum(v * k for v, k in zip(values, row, strict=True)) / white
        for row, white in zip(RGB_TO_XYZ, WHITE, strict=True)
    )
    lightness = 116.0 * y ** (1 / 3) - 16.0 if y > LINEAR_BELOW else 903.3 * y
    eight = round(lightness * 2.55) * (100.0 / 255.0)
    return eight, float(round(500.0 * (curve(x) - curve(y)))), float(round(200.0 * (curve(y) - curve(z))))
