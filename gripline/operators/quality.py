"""Confidence of frames and quality of episodes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gripline.operators.blocks import KEY

# --- fixed values: weights and limits ------------------------------------------------------
WEIGHT_BOX, WEIGHT_CONTACT, WEIGHT_PATCH, WEIGHT_DEPTH = 0.35, 0.25, 0.25, 0.15
MIN_PATCH_POINTS = 10
MIN_CONFIDENCE = 0.6
WORST_ERROR_MM = 50
SHARE_DEPTH, SHARE_LANGUAGE, SHARE_PHASE = 0.4, 0.3, 0.3


def frame_confidence(has_box: Column, has_contact: Column, patch_points: Column, error_mm: Column) -> Column:
    one = lambda c: F.when(c, 1.0).otherwise(0.0)
    patch = F.when(patch_points >= MIN_PATCH_POINTS, 1.0).otherwise(0.5)
    depth = F.when(error_mm < 0, 1.0).otherwise(F.greatest(F.lit(0.0), 1 - error_mm / WORST_ERROR_MM))
    return WEIGHT_BOX * one(has_box) + WEIGHT_CONTACT * one(has_contact) + WEIGHT_PATCH * patch + WEIGHT_DEPTH * depth


def is_valid(confidence: Column) -> Column:
    return confidence >= MIN_CONFIDENCE


def trajectory_quality(frames: DataFrame, language_quality: DataFrame) -> DataFrame:
    """Per episode: mean confidence of contact frames (0 without any), phase confidence, overall mix, counts."""
    conf = F.col("annotation_confidence")
    per_episode = frames.groupBy(KEY).agg(
        F.coalesce(F.avg(F.when(F.col("phase") == "contact", conf)), F.lit(0.0)).alias("depth_quality"),
        F.avg("phase_confidence").alias("phase_det_confidence"),
        *valid_counts(),
    )
    joined = per_episode.join(language_quality, KEY, "left").withColumn("language_quality", F.coalesce("language_quality", F.lit(0.0)))
    mix = SHARE_DEPTH * F.col("depth_quality") + SHARE_LANGUAGE * F.col("language_quality") + SHARE_PHASE * F.col("phase_det_confidence")
    return joined.withColumn("annotation_quality", mix)


def valid_counts() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("num_frames"),
        F.count(F.when(is_valid(F.col("annotation_confidence")), 1)).alias("num_valid_frames"),
    ]
