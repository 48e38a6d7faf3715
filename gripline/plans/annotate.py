"""Annotation of episodes from numbered frames to frame and trajectory records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gripline.functions.geometry import affordance_box, project_pinhole, whole_pixel
from gripline.operators.blocks import KEY, attach_episode, count_of, longest_of, note_longest, spread
from gripline.operators.depth import contact_patch, crop_grid, depth_patch, deprojection_error, patch_summary
from gripline.operators.language import language_tags
from gripline.operators.phases import five_phases
from gripline.operators.quality import frame_confidence, is_valid, trajectory_quality
from gripline.operators.signals import ee_velocity, past, point
from gripline.sources import sinks
from gripline.sources.session import settle


def geometry(indexed: DataFrame, episodes: DataFrame, calibration: DataFrame, eps: float = 0.02) -> DataFrame:
    """Phases, pixels and traces of every frame, in one shuffle of the frames after numbering.

    `episodes` has n_steps; the camera of an episode comes by block.
    """
    camera = episodes.select(KEY, "n_steps").join(calibration, KEY, "left")
    placed = attach_episode(indexed, camera).drop("blk")
    pixel = project_pinhole(F.col("x"), F.col("y"), F.col("z"), F.col("K"), F.col("T"))
    placed = placed.withColumn("_p", pixel).withColumn(
        "pixel", F.when(F.col("_p").isNotNull(), F.struct(whole_pixel(F.col("_p")["u"]).alias("u"), whole_pixel(F.col("_p")["v"]).alias("v")))
    )
    windows = {"ee_velocity": ee_velocity(), "ee_trace_2d": past(F.col("pixel"), 5), "ee_trace_3d": past(point(), 10)}
    payload = ("frame_index", "n_steps", "x", "y", "z", "pixel", "K", "T")
    rows = five_phases(placed, eps=eps, payload=payload, before=9, windows=windows)
    u, v = F.col("pixel")["u"], F.col("pixel")["v"]
    empty = F.array().cast("array<bigint>")
    return (
        rows.withColumn("affordance_box_2d", affordance_box(u, v))
        .withColumn("contact_point_2d", F.when(F.col("pixel").isNotNull(), F.array(u, v)).otherwise(empty))
        .withColumn("contact_point_3d", F.array("x", "y", "z"))
    )


def with_depth(rows: DataFrame, depth: DataFrame | None, mask: DataFrame | None = None, fields: bool = True) -> DataFrame:
    """Patch, normal, crop and depth error of contact frames; empty and -1 elsewhere and without depth.

    Frames are told apart by step, so that a repeated frame number multiplies nothing. Without `fields` only what quality
    needs is found: patch_points and deprojection_err_mm.
    """
    points, grid = "array<array<double>>", "array<array<double>>"
    empty = {"contact_patch_xyz": points, "surface_normal": "array<double>", "depth_patch_32x32": grid}
    if depth is None:
        none = {c: F.array().cast(kind) for c, kind in empty.items()}
        return rows.withColumns({**none, "patch_points": F.lit(0), "deprojection_err_mm": F.lit(-1.0)})
    u, v = F.col("pixel")["u"].alias("pu"), F.col("pixel")["v"].alias("pv")
    place = [F.col(a).alias(f"contact_{a}") for a in "xyz"]
    # few narrow rows that patch, crop and error read
    touching = settle(rows.where((F.col("phase") == "contact") & F.col("pixel").isNotNull()).select(KEY, "frame_index", "step", *place, u, v, "K", "T"))
    known = touching.where(F.col("K").isNotNull() & F.col("T").isNotNull())
    who = [KEY, "step"]
    # both sides are dealt alike, or Spark would deal the wide rows as the few others lie
    dealt = lambda table: spread(table, count_of(rows), *who)
    wide = dealt(rows)
    if not fields:
        counted = contact_patch(known, depth, mask).groupBy(*who).agg(F.count(F.lit(1)).alias("patch_points"))
        errors = deprojection_error(known, depth).select(*who, "deprojection_err_mm")
        measured = wide.join(dealt(errors.join(counted, who, "left")), who, "left")
        return measured.fillna({"patch_points": 0, "deprojection_err_mm": -1.0})
    patch = patch_summary(contact_patch(known, depth, mask)).select(
        *who, "points", F.col("xyz").alias("contact_patch_xyz"), F.when(F.col("nx").isNotNull(), F.array("nx", "ny", "nz")).alias("surface_normal")
    )
    crop = crop_grid(depth_patch(touching, depth)).select(*who, F.col("grid").alias("depth_patch_32x32"))
    errors = deprojection_error(touching, depth).select(*who, "deprojection_err_mm")
    found = errors.join(patch, who, "left").join(crop, who, "left")
    filled = {c: F.coalesce(F.col(c), F.array().cast(kind)) for c, kind in empty.items()}
    return (
        wide.join(dealt(found), who, "left")
        .withColumns(filled)
        .withColumn("patch_points", F.coalesce("points", F.lit(0)))
        .withColumn("deprojection_err_mm", F.coalesce("deprojection_err_mm", F.lit(-1.0)))
        .drop("points")
    )


def with_quality(rows: DataFrame) -> DataFrame:
    confidence = frame_confidence(
        F.size("affordance_box_2d") > 0, F.size("contact_point_2d") > 0, F.col("patch_points"), F.col("deprojection_err_mm")
    )
    return rows.withColumn("annotation_confidence", confidence).withColumn("annotation_valid", is_valid(F.col("annotation_confidence")))


def annotated_rows(
    indexed: DataFrame, episodes: DataFrame, calibration: DataFrame, depth: DataFrame | None = None, mask: DataFrame | None = None, eps: float = 0.02, fields: bool = True
) -> DataFrame:
    """Every frame with phase, 2D, 3D and quality values; without `fields`, no lists of 3D values."""
    return with_quality(with_depth(geometry(indexed, episodes, calibration, eps), depth, mask, fields))


def frame_records(rows: DataFrame, episodes: DataFrame) -> DataFrame:
    tags = language_tags(episodes)
    return sinks.export_frames(attach_episode(rows.drop("blk"), tags.select(KEY, "n_steps", "subtask_sequence")))


def trajectory_records(rows: DataFrame, episodes: DataFrame) -> DataFrame:
    tags = language_tags(episodes)
    return sinks.export_trajectory(trajectory_quality(rows, tags.select(KEY, "language_quality")), tags)


def annotate(
    indexed: DataFrame, episodes: DataFrame, calibration: DataFrame, depth: DataFrame | None = None, mask: DataFrame | None = None, eps: float = 0.02
) -> tuple[DataFrame, DataFrame]:
    """(frame records, trajectory records). `episodes`: episode_id, n_steps, instruction.

    The annotated frames are written once and both records are read from them.
    """
    done = annotated_rows(indexed, episodes, calibration, depth, mask, eps)
    rows = note_longest(settle(done), longest_of(done))
    return frame_records(rows, episodes), trajectory_records(rows, episodes)


def merge_annotations(*parts: DataFrame) -> DataFrame:
    """Values of separate tables brought together by (episode, step), so that a frame number that repeats multiplies nothing.

    The first table gives the rows; a row that another one lacks has nulls there.
    """
    merged = spread(parts[0], count_of(parts[0]), KEY, "step")
    for part in parts[1:]:
        merged = merged.join(part, [KEY, "step"], "left")
    return merged
