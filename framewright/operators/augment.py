"""Augmentation plan: what to do to each frame, drawn from the seed; the pixels are someone else's work."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.functions.chance import uniform
from framewright.functions.geometry import stem


def augmentation_plan(
    frames: DataFrame,
    *,
    seed: int = 0,
    crop_min_share: float = 0.85,
    brightness: tuple[float, float] = (0.7, 1.3),
    contrast: tuple[float, float] = (0.8, 1.2),
    blur_max: float = 1.2,
    blur_floor: float = 0.3,
) -> DataFrame:
    """One mirrored copy per frame (``file, width, height``): crop, brightness, contrast, blur radius."""

    def between(low: float, high: float, draw: str):
        return F.lit(low) + F.lit(high - low) * uniform(seed, "file", draw)

    def shift(free, draw: str):
        return F.floor(uniform(seed, "file", draw) * (free + 1)).cast("int")

    share = between(crop_min_share, 1.0, "share")
    radius = between(0.0, blur_max, "blur")
    plan = frames.select("file", "width", "height", share.alias("crop_share"))
    plan = plan.withColumn("crop_width", (F.col("width") * F.col("crop_share")).cast("int"))
    plan = plan.withColumn("crop_height", (F.col("height") * F.col("crop_share")).cast("int"))
    return plan.select(
        "file",
        F.concat(stem(F.col("file")), F.lit("_aug.jpg")).alias("copy"),
        F.lit(True).alias("flip"),
        "crop_width",
        "crop_height",
        shift(F.col("width") - F.col("crop_width"), "left").alias("left"),
        shift(F.col("height") - F.col("crop_height"), "top").alias("top"),
        between(*brightness, "brightness").alias("brightness"),
        between(*contrast, "contrast").alias("contrast"),
        F.when(radius > blur_floor, radius).otherwise(F.lit(0.0)).alias("blur_radius"),
    )
