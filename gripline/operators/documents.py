"""Nested documents as ordered lines, so that an episode of any length is written without being gathered.

A line has episode_id, section, part, position and text. The lines of an episode in that order are one JSON document; every entry of
a list is a line of its own, with the comma before it. All lines are made by narrow projections of the tables that hold the entries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gripline.functions.text import phase_alias
from gripline.operators.blocks import KEY, longest_of, note_longest
from gripline.operators.evaluate import contact_pose
from gripline.operators.phases import EDGE_PHASE, GRASP, first_contact, grasp_phases, phase_ranges
from gripline.operators.signals import EPS_GRASP, gripper_norm
from gripline.sources.session import settle

ORDER = (KEY, "section", "part", "position")
BEFORE, AFTER = -1, 2**62  # positions of what opens and closes a list
WHOLE = {"ignoreNullFields": "false"}


def lines(rows: DataFrame, section: int, part: Column | int, position: Column | int, text: Column) -> DataFrame:
    at = lambda c: c if isinstance(c, Column) else F.lit(c)
    return rows.select(KEY, F.lit(section).alias("section"), at(part).cast("int").alias("part"), at(position).cast("bigint").alias("position"), text.alias("line"))


def comma(first: Column) -> Column:
    return F.when(first, "").otherwise(",")


def opened(fields: Column, rest: str) -> Column:
    """An object as JSON without its end, and what follows in it."""
    whole = F.to_json(fields, WHOLE)
    return F.concat(F.left(whole, F.length(whole) - 1), F.lit(rest))


def merged(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def record_document(heads: DataFrame, frames: DataFrame, head: str, fields: tuple[str, ...]) -> DataFrame:
    """Lines of {episode_id, <head>: {...}, frames: [...]}: one head row per episode, frames in order of step."""
    named = F.struct(KEY, F.struct(*[c for c in heads.columns if c != KEY]).alias(head))
    return merged(
        lines(heads, 0, 0, 0, opened(named, ',"frames":[')),
        lines(frames, 1, 0, F.col("step"), F.concat(comma(F.col("step") == 0), F.to_json(F.struct("frame_index", *fields), WHOLE))),
        lines(heads, 2, 0, 0, F.lit("]}")),
    )


def phase_document(indexed: DataFrame, labels: DataFrame, grasp: float = 0.4, contact: float = 0.9, sources: tuple[str, ...] = (), style: str = "hyphen") -> DataFrame:
    """Lines of the phase document of every episode.

    `indexed` has gripper, its episode range, gripper_pose and tcp_pose; `labels` has num_frames, gt_contact_frame and the range, and the
    columns in `sources` (such as file names), which open the document. Of rows that repeat the contact frame's number, the last gives
    the poses and the raw reading and the first gives the normalised one.
    """
    kept = ("frame_index", "n_steps", "gripper", "norm")
    phased = grasp_phases(indexed.withColumn("norm", gripper_norm(EPS_GRASP)), grasp, contact, kept)
    phased = note_longest(settle(phased), longest_of(phased))
    ranges = settle(phase_ranges(phased))
    onset = first_contact(phased)
    poses = contact_pose(indexed, onset, ["gripper_pose", "tcp_pose", "gripper"]).withColumnRenamed("frame_index", "contact_frame")
    at_onset = phased.withColumnRenamed("frame_index", "contact_frame").join(onset, [KEY, "contact_frame"], "left_semi")
    norms = at_onset.groupBy(KEY).agg(F.min_by("norm", "step").alias("norm"))
    heads = labels.join(onset, KEY, "left").join(poses, [KEY, "contact_frame"], "left").join(norms, KEY, "left")
    pose = F.struct(
        F.col("contact_frame").alias("frame_index"),
        F.col("gripper_pose").alias("gripper_pose6d"),
        F.col("tcp_pose").alias("tcp_pose6d"),
        F.col("gripper").alias("gripper_position_raw"),
        F.col("norm").alias("gripper_position_normalized"),
    )
    head = F.struct(
        KEY,
        *sources,
        F.col("num_frames").alias("parquet_frame_count"),
        F.lit(float(grasp)).alias("grasp_threshold"),
        F.lit(float(contact)).alias("contact_threshold"),
        F.col("gripper_min").alias("gripper_raw_min"),
        F.col("gripper_max").alias("gripper_raw_max"),
        F.col("contact_frame").alias("first_contact_frame_index"),
        F.col("gt_contact_frame").alias("reference_annotation_contact_frame_index"),
        F.when(F.col("contact_frame").isNotNull(), pose).alias("contact_pose"),
    )
    names = (*GRASP, EDGE_PHASE)
    number = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("phase")) - 1
    pair = F.concat(F.lit("["), F.col("start_step").cast("string"), F.lit(","), F.col("end_step").cast("string"), F.lit("]"))
    frame = F.struct(
        F.col("step").alias("step_index"),
        "frame_index",
        phase_alias(F.col("phase"), style).alias("phase"),
        F.col("phase").alias("robo2vlm_phase"),
        F.col("gripper").alias("gripper_position_raw"),
        F.col("norm").alias("gripper_position_normalized"),
    )
    lists = [
        part
        for i, name in enumerate(names)
        for part in (lines(labels, 1, i, BEFORE, F.lit(f'{"," if i else ""}"{name}":[')), lines(labels, 1, i, AFTER, F.lit("]")))
    ]
    return merged(
        lines(heads, 0, 0, 0, opened(head, ',"phase_ranges":{')),
        *lists,
        lines(ranges, 1, number, F.col("range_index"), F.concat(comma(F.col("range_index") == 0), pair)),
        lines(labels, 2, 0, BEFORE, F.lit('},"phases":[')),
        lines(ranges, 2, 0, F.col("start_step"), F.concat(comma(F.col("start_step") == 0), F.to_json(F.struct("start_step", "end_step", "phase")))),
        lines(labels, 3, 0, BEFORE, F.lit('],"frames":[')),
        lines(phased, 3, 0, F.col("step"), F.concat(comma(F.col("step") == 0), F.to_json(frame, WHOLE))),
        lines(labels, 4, 0, 0, F.lit("]}")),
    )


def write_documents(document: DataFrame, path: str, files: int | None = None) -> None:
    """Write the lines as text: files are ranges of lines, so their order and the order in them is that of the documents."""
    files = files or int(document.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    document.repartitionByRange(files, *ORDER).sortWithinPartitions(*ORDER).select("line").write.mode("overwrite").text(path)
