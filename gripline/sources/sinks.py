"""Output records: frames, trajectories, documents, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gripline.functions.text import subtask_of_phase
from gripline.operators.blocks import KEY
from gripline.operators.documents import record_document

FRAME_FIELDS = (
    "phase",
    "phase_confidence",
    "subtask",
    "affordance_box_2d",
    "contact_point_2d",
    "ee_trace_2d",
    "contact_point_3d",
    "ee_trace_3d",
    "contact_patch_xyz",
    "surface_normal",
    "depth_patch_32x32",
    "deprojection_err_mm",
    "annotation_confidence",
    "annotation_valid",
)


def export_frames(annotated: DataFrame) -> DataFrame:
    """Frame records: time, 2D, 3D and quality fields."""
    subtask = subtask_of_phase(F.col("subtask_sequence"), F.col("phase"))
    return annotated.withColumn("subtask", subtask).select(KEY, "frame_index", "step", *FRAME_FIELDS)


TRAJECTORY_FIELDS = (
    "task_verb",
    "task_object",
    "task_category",
    "requires_precision",
    "depth_quality",
    "language_quality",
    "phase_det_confidence",
    "annotation_quality",
    "num_frames",
    "num_valid_frames",
)


def export_trajectory(quality: DataFrame, language: DataFrame) -> DataFrame:
    """Episode records: language tags, quality and frame counts."""
    return quality.join(language.drop("language_quality", "subtask_sequence"), KEY, "left").select(KEY, *TRAJECTORY_FIELDS)


def export_nested(frames: DataFrame, trajectories: DataFrame, fields: tuple[str, ...] = FRAME_FIELDS) -> DataFrame:
    """Documents with the trajectory and its ordered frames, as ordered lines: one shape for episodes of any length."""
    return record_document(trajectories, frames, "trajectory", fields)


def write_json(rows: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    rows.write.mode("overwrite").partitionBy(*partition_by).json(path)


def write_csv(rows: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    rows.write.mode("overwrite").option("header", "true").partitionBy(*partition_by).csv(path)


def write_frames(rows: DataFrame, path: str, partition_by: tuple[str, ...] = ("phase",)) -> None:
    rows.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def grounding_summary(grounded: DataFrame) -> DataFrame:
    """Six summary fields per episode; boxes as JSON text, null as the word null."""
    text = lambda c: F.coalesce(F.to_json(F.col(c)), F.lit("null"))
    return grounded.select(
        KEY, "target_object", text("bbox_xyxy").alias("bbox_xyxy"), text("center_xy").alias("center_xy"), "confidence", output_path(F.col(KEY)).alias("output_path")
    )


def output_path(episode: Column, name: str = "target_object_grounding.json") -> Column:
    return F.concat_ws("/", episode.cast("string"), F.lit(name))
