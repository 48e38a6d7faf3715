"""Detections, masks and boxes per image. A detection row: episode_id, frame_index, det_idx, label or
class number, score, x1, y1, x2, y2."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gripline.operators.blocks import KEY
from gripline.operators.depth import FRAME, nearest_first
from gripline.operators.tiles import around, frame_key, squared_gap

# --- fixed values: score thresholds of the detectors --------------------------------------
TRACKER_SCORE = 0.5
PROMPT_SCORE = 0.01
BOX_SCORE = 0.35
GRIPPER_PROMPT = "robot gripper"
CROP_RADIUS = 48


def prompt_union(object_prompts: list[str], gripper_prompt: str = GRIPPER_PROMPT) -> list[str]:
    """Class list for one detector run: the objects, then the gripper."""
    return [*object_prompts, gripper_prompt]


def prompt_union_col(object_prompts: Column, gripper_prompt: str = GRIPPER_PROMPT) -> Column:
    return F.concat(object_prompts, F.array(F.lit(gripper_prompt)))


def label_of_class(prompts: Column, cls: Column) -> Column:
    return F.get(prompts, cls)


def filter_detections(detections: DataFrame, threshold: float, gripper_prompt: str = GRIPPER_PROMPT) -> DataFrame:
    """Detections at or above the threshold, marked as gripper or object."""
    return detections.where(F.col("score") >= threshold).withColumn("is_gripper", F.col("label") == gripper_prompt)


def labels_to_list(names: Column) -> Column:
    """Class map (number -> name) as a list in number order."""
    return F.transform(F.array_sort(F.map_entries(names)), lambda e: e["value"])


def best_gripper(detections: DataFrame, group: tuple[str, ...] = tuple(FRAME), gripper_prompt: str = GRIPPER_PROMPT) -> DataFrame:
    """Gripper detection with the highest score; the first one on a tie."""
    mine = detections.where(F.col("label") == gripper_prompt)
    return best_of(mine, group)


def best_of(detections: DataFrame, group: tuple[str, ...]) -> DataFrame:
    whole = F.struct("det_idx", "label", "score", "x1", "y1", "x2", "y2")
    best = detections.groupBy(*group).agg(F.max_by(whole, F.struct(F.col("score"), (-F.col("det_idx")).alias("first"))).alias("b"))
    return best.select(*group, "b.*")


def object_box(detections: DataFrame, threshold: float = BOX_SCORE, gripper_prompt: str = GRIPPER_PROMPT) -> DataFrame:
    """Best object box per frame among those above the threshold."""
    return best_of(detections.where((F.col("score") > threshold) & (F.col("label") != gripper_prompt)), tuple(FRAME))


def mask_bbox(pixels: DataFrame, group: tuple[str, ...] = (*FRAME, "obj_id"), roster: DataFrame | None = None) -> DataFrame:
    """Tight box around the pixels of a mask, corners included. With a roster of masks, an empty one has a row with null corners."""
    boxes = pixels.groupBy(*group).agg(*box_of_pixels())
    return boxes if roster is None else roster.select(*group).distinct().join(boxes, list(group), "left")


def box_of_pixels() -> list[Column]:
    return [F.min("x").alias("x1"), F.min("y").alias("y1"), F.max("x").alias("x2"), F.max("y").alias("y2")]


def frame_zero_override(mask_boxes: DataFrame, detector_boxes: DataFrame) -> DataFrame:
    """Detector boxes on frame 0, boxes from masks on every other frame; only for episodes with masks.

    Corners of detector boxes are cut to whole pixels; one that is no finite number becomes null.
    """
    tracked = mask_boxes.select(KEY).distinct()
    first = detector_boxes.where("frame_index = 0").join(tracked, KEY, "left_semi").withColumn("source", F.lit("detector"))
    rest = mask_boxes.where("frame_index <> 0").withColumn("source", F.lit("mask"))
    whole = {c: F.col(c).try_cast("bigint").cast(rest.schema[c].dataType) for c in ("x1", "y1", "x2", "y2")}
    return rest.unionByName(first.withColumns(whole).select(*rest.columns))


def mask_contact_crop(pixels: DataFrame, contacts: DataFrame, radius: int = CROP_RADIUS) -> DataFrame:
    """Tight box of the mask pixels within `radius` of the contact pixel, per frame. Only tiles near that pixel are met."""
    near = around(contacts, pixels, radius, radius + 1).where(squared_gap() <= radius * radius)
    return near.groupBy(*frame_key(contacts)).agg(*box_of_pixels(), F.count(F.lit(1)).alias("pixels"))


def top_k_candidates(candidates: DataFrame, k: int = 5, group: tuple[str, ...] = tuple(FRAME), tie: str = "cand_idx") -> DataFrame:
    """The k best scored candidates of each frame, in order."""
    return nearest_first(list(group), [F.col("score").desc(), F.col(tie)], k, candidates, "rank")


DETECTION = "struct<label:string,box_score:double,score:double,box_xyxy:array<double>,xyxy:array<double>>"


def explode_detections(documents: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per detection of each document, the gripper last with is_gripper true.

    Either naming of score and box is read.
    """
    keep = [c for c in documents.columns if c != payload]
    doc = F.from_json(F.col(payload), f"object_detections array<{DETECTION}>, gripper_detection {DETECTION}")
    parsed = documents.select(*keep, doc.alias("_doc")).select(*keep, "_doc.*")
    marked = lambda d, gripper: F.struct(d.alias("d"), F.lit(gripper).alias("is_gripper"))
    empty = F.array().cast(f"array<struct<d:{DETECTION},is_gripper:boolean>>")
    objects = F.coalesce(F.transform("object_detections", lambda d: marked(d, False)), empty)
    gripper = F.col("gripper_detection")
    last = F.when(gripper.isNotNull(), F.array(marked(gripper, True))).otherwise(empty)
    rows = parsed.select(*keep, F.posexplode(F.concat(objects, last)).alias("det_idx", "_r"))
    d, box = F.col("_r")["d"], F.coalesce(F.col("_r")["d"]["box_xyxy"], F.col("_r")["d"]["xyxy"])
    return rows.select(
        *keep,
        "det_idx",
        F.col("_r")["is_gripper"].alias("is_gripper"),
        d["label"].alias("label"),
        F.coalesce(d["box_score"], d["score"]).alias("score"),
        *[F.get(box, i).alias(n) for i, n in enumerate(("x1", "y1", "x2", "y2"))],
    )
