"""Dense object masks as run-length rows, boxes with a row for every mask, and result records of tracked objects.

A mask table has episode_id and `masks`, nested as [frame][object][y][x] with any number or boolean as pixel. A long video comes in
pieces, one row each, with the number of a piece's first frame as `first_frame`. Runs have episode_id, frame_index, obj_id, y, x1
and x2, both ends included.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gripline.operators.blocks import KEY

MASK = [KEY, "frame_index", "obj_id"]
BOX = ("x1", "y1", "x2", "y2")


def object_masks(videos: DataFrame) -> DataFrame:
    """One row per mask: its frame, the object's place in the frame, and its rows of pixels."""
    first = F.col("first_frame") if "first_frame" in videos.columns else F.lit(0)
    frames = videos.select(KEY, first.alias("_first"), F.posexplode("masks").alias("_frame", "objects"))
    rows = frames.select(KEY, (F.col("_first") + F.col("_frame")).alias("frame_index"), F.posexplode("objects").alias("obj_id", "mask"))
    return rows.select(KEY, *[F.col(c).cast("bigint").alias(c) for c in MASK[1:]], "mask")


def is_set(pixel: Column) -> Column:
    """Zero, false and null are not set, NaN is."""
    return F.coalesce(pixel.cast("boolean"), F.lit(False))


def bits(pixels: Column) -> Column:
    """A row of pixels as text: 1 where a pixel is set, else 0."""
    return F.array_join(pixels.cast("array<boolean>").cast("array<int>").cast("array<string>"), "", "0")


def mask_runs(masks: DataFrame) -> DataFrame:
    """Run-length rows of `object_masks`; a mask without set pixels has none.

    Every pixel is looked at once beside the one before it; a run's end is sought from its start.
    """
    lines = masks.select(*MASK, F.posexplode("mask").alias("y", "pixels")).withColumn("on", bits(F.col("pixels")))
    spots = lines.select(*MASK, F.col("y").cast("bigint").alias("y"), "pixels", "on", F.posexplode("pixels").alias("x1", "pixel"))
    starts = spots.where(is_set(F.col("pixel")) & ~is_set(F.get("pixels", F.col("x1") - 1)))
    after = F.expr("locate('0', on, x1 + 1)")
    x2 = F.when(after > 0, after - 2).otherwise(F.length("on") - 1)
    return starts.select(*MASK, "y", F.col("x1").cast("bigint").alias("x1"), x2.cast("bigint").alias("x2"))


def mask_boxes(masks: DataFrame) -> DataFrame:
    """Tight box and number of pixels of every mask of `object_masks`, corners included; null corners where it is empty.

    A mask is one row, so nothing is shuffled.
    """
    pixels = F.col("mask").cast("array<array<boolean>>").cast("array<array<int>>").cast("array<array<string>>")
    lines = masks.select(*MASK, F.transform(pixels, lambda line: F.array_join(line, "", "0")).alias("_on"))
    ends = lines.select("*", F.transform("_on", lambda on: F.length(F.rtrim(on, F.lit("0")))).alias("_ends"))
    firsts = F.transform("_on", lambda on: F.nullif(F.locate("1", on), F.lit(0)))
    marked = ends.select(*MASK, "_on", "_ends", firsts.alias("_firsts"), F.transform("_ends", lambda end: end > 0).alias("_some"))
    place = lambda some: F.nullif(F.array_position(some, True), F.lit(0))
    corners = {
        "x1": F.array_min("_firsts") - 1,
        "y1": place(F.col("_some")) - 1,
        "x2": F.nullif(F.array_max("_ends"), F.lit(0)) - 1,
        "y2": F.size("_some") - place(F.reverse("_some")),
        "pixels": F.coalesce(F.length(F.replace(F.array_join("_on", ""), F.lit("0"), F.lit(""))), F.lit(0)),
    }
    return marked.select(*MASK, *[c.cast("bigint").alias(name) for name, c in corners.items()])


def run_pixels(runs: DataFrame) -> DataFrame:
    """Pixel rows of runs."""
    return runs.select(*MASK, F.explode(F.sequence("x1", "x2")).alias("x"), "y")


def run_boxes(runs: DataFrame, roster: DataFrame | None = None) -> DataFrame:
    """Tight box of each mask from its runs, corners included. With a roster, a mask without pixels has a row with null corners."""
    boxes = runs.groupBy(*MASK).agg(F.min("x1").alias("x1"), F.min("y").alias("y1"), F.max("x2").alias("x2"), F.max("y").alias("y2"), F.sum(F.col("x2") - F.col("x1") + 1).alias("pixels"))
    return boxes if roster is None else with_roster(boxes, roster)


def with_roster(boxes: DataFrame, roster: DataFrame) -> DataFrame:
    """A row for every (episode, frame, object) of the roster; null corners where a mask is empty."""
    out = roster.select(*MASK).distinct().join(boxes, MASK, "left")
    return out.withColumn("pixels", F.coalesce("pixels", F.lit(0).cast("bigint"))) if "pixels" in out.columns else out


def box_array() -> Column:
    """Corners as a list; null for an empty mask."""
    return F.when(F.col("x1").isNotNull(), F.array(*BOX))


def frame_boxes(boxes: DataFrame, first: DataFrame) -> DataFrame:
    """Boxes of all objects of a frame in object order (`target_object_bbox_list`), null for an empty mask; the detector's on frame 0.

    `boxes` are those of the roster, `first` has episode_id, det_idx and corners. Only episodes with masks have rows.
    """
    listed = lambda order: F.transform(F.sort_array(F.collect_list(F.struct(order, box_array().alias("box")))), lambda r: r["box"])
    whole = {c: F.col(c).try_cast("bigint") for c in BOX}
    detected = first.withColumns(whole).groupBy(KEY).agg(listed("det_idx").alias("_detected"))
    tracked = boxes.groupBy(KEY, "frame_index").agg(listed("obj_id").alias("_tracked"))
    none = F.array().cast(detected.schema["_detected"].dataType)
    # the masks are read once; a detector's list meets its episode's frames, which lie together already where masks came by episode
    joined = tracked.join(detected, KEY, "left")
    shown = F.when(F.col("frame_index") == 0, F.coalesce("_detected", none)).otherwise(F.col("_tracked"))
    return joined.select(KEY, "frame_index", shown.alias("target_object_bbox_list"))


def mask_records(samples: DataFrame, first: DataFrame) -> DataFrame:
    """The result record of every sample, from the detections of its first frame.

    `samples` has episode_id and `state` (see ledger.skip_tagged); `first` has episode_id, det_idx, cls, label, score and corners. A
    sample that is worked on gets lists over its detections in their order, one without detections or without video the empty
    record; a sample that is kept has no new record. Boxes of later frames are rows of `frame_boxes`, so that a long video needs no
    list of its own length.
    """
    one = F.struct("det_idx", "cls", "label", "score", F.array(*BOX).alias("box"))
    lists = first.groupBy(KEY).agg(F.sort_array(F.collect_list(one)).alias("d"))
    joined = samples.where("state <> 'kept'").select(KEY, "state").join(lists, KEY, "left")
    found = F.when(F.col("state") == "work", F.col("d"))
    field = lambda name, kind: F.coalesce(found[name], F.array().cast(kind))
    return joined.select(
        KEY,
        "state",
        field("cls", "array<int>").alias("cls_id_dict"),
        field("label", "array<string>").alias("object_cls_list"),
        field("score", "array<double>").alias("yoloe_conf_list"),
        field("box", "array<array<double>>").alias("first_frame_yoloe_bbox_list"),
    )
