"""Subtask segments of an episode: cleaning, fallback, poses at their ends."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gripline.functions.replies import extract_json, segment_list
from gripline.functions.text import parse_int_like, parse_text
from gripline.operators.blocks import BLOCK, KEY, PLAIN_ROWS, Carried, block_number, scan_blocks, spread
from gripline.operators.depth import nearest_first
from gripline.operators.evaluate import frame_lookup
from gripline.operators.signals import chosen_frames, uniform_numbers

TASK_SEGMENTS = 1 << 18  # segments of a task, on average, once there are many
DEFAULT_TEXT = "complete this part of the task"  # fixed values
FALLBACK_SOURCE = "single_segment_fallback"
MODEL_SOURCE = "vlm"


def planned_segments(replies: DataFrame, text: str = "raw_text") -> DataFrame:
    """Segments named in model replies, one row each, in the order of the reply (`pos`)."""
    listed = F.posexplode(segment_list(extract_json(F.col(text))))
    rows = replies.select(KEY, listed.alias("pos", "s"))
    number = lambda c: parse_int_like(c, keep_negative=True)
    return rows.select(
        KEY, "pos", number(F.col("s")["start_frame"]).alias("start"), number(F.col("s")["end_frame"]).alias("end"), F.col("s")["subtask_instruction"].alias("text")
    )


def normalize_segments(segments: DataFrame, episodes: DataFrame, size: int | None = None) -> DataFrame:
    """Make segments orderly: inside the episode, not overlapping, first and last stretched to its ends.

    `segments`: episode_id, pos, start, end, text; `episodes`: episode_id, first_frame, last_frame.
    Sorted by (start, end, pos) and counted k = 0, 1, ..., a segment cannot start before
    max(first + k, max over earlier j of (end_j - j) + k). Rank and running maximum are found in blocks
    of start numbers and carried between them. Segments pushed past the last frame drop out; as
    starts never decrease these are the last ones, so the counts of the others stay.

    As segment k starts at first + k or later, only the first last - first + 1 of an episode can stay.
    Ranks up to the longest such number are all that is kept beforehand; where episodes are short each
    then has few segments and needs no blocks.
    """
    size = size or BLOCK
    longest = episodes.agg(F.max(F.col("last_frame") - F.col("first_frame"))).first()[0] or 0
    lo, hi = F.col("first_frame"), F.col("last_frame")
    clamp = lambda c: F.greatest(lo, F.least(hi, F.col(c).cast("bigint")))
    few = longest < size
    # where no episode is long, one shuffle by episode serves all steps, dealt by the number of segments
    count = segments.count() if few else None
    dealt = lambda table: spread(table, count, KEY, each=TASK_SEGMENTS)
    rows = (
        dealt(segments.where(F.col("start").isNotNull() & F.col("end").isNotNull()))
        .join(dealt(episodes), KEY)
        .withColumn("_a", clamp("start"))
        .withColumn("_b", clamp("end"))
        .withColumn("start", F.least("_a", "_b"))
        .withColumn("end", F.greatest("_a", "_b"))
        .withColumn("text", F.when(parse_text(F.col("text")) == "", DEFAULT_TEXT).otherwise(parse_text(F.col("text"))))
        .drop("_a", "_b")
    )
    if longest < PLAIN_ROWS:
        rows = nearest_first([KEY], [F.col(c) for c in ("start", "end", "pos")], longest + 1, rows, "_k").drop("_k")
    rows = rows.withColumn("blk", F.lit(0) if few else block_number(F.col("start"), size))
    order = Window.partitionBy(KEY, "blk").orderBy("start", "end", "pos")
    local = (
        rows.withColumn("_i", F.row_number().over(order) - 1)
        .withColumn("_lead", F.lead("start").over(order))
        .withColumn("_reach", F.max(F.col("end") - F.col("_i")).over(order.rowsBetween(Window.unboundedPreceding, -1)))
    )
    none = F.lit(None).cast("bigint")
    if few:
        joined = local.select("*", F.lit(0).alias("_off"), none.alias("_next"), none.alias("_far"))
    else:
        blocks = local.groupBy(KEY, "blk").agg(
            F.count(F.lit(1)).alias("_n"), F.max(F.col("end") - F.col("_i")).alias("_m"), F.min("start").alias("_s")
        )
        placed = scan_blocks(blocks, {"_off": Carried("sum", "_n"), "_next": Carried("next", "_s")})
        placed = scan_blocks(placed.withColumn("_gm", F.col("_m") - F.col("_off")), {"_far": Carried("max", "_gm")})
        joined = local.join(placed.select(KEY, "blk", "_off", "_next", "_far"), [KEY, "blk"])
    k = F.col("_off") + F.col("_i")
    earlier = F.greatest(F.col("_far"), F.col("_reach") - F.col("_off"))
    with_own = F.greatest(earlier, F.col("end") - k)
    cursor = F.greatest(lo + k, earlier + k)
    following = F.coalesce("_lead", "_next")
    next_start = F.greatest(following, lo + k + 1, with_own + k + 1)
    start = F.greatest(F.col("start"), cursor)
    shaped = joined.select(
        KEY,
        k.cast("bigint").alias("segment_index"),
        start.alias("start_frame"),
        F.least(F.greatest(start, F.col("end")), hi).alias("end_frame"),
        "text",
        lo.alias("first_frame"),
        hi.alias("last_frame"),
        (following.isNull() | (next_start > hi)).alias("_is_last"),
    ).where(F.col("start_frame") <= F.col("last_frame"))
    return shaped.select(
        KEY,
        F.format_string("segment_%03d", "segment_index").alias("segment_id"),
        "segment_index",
        F.when(F.col("segment_index") == 0, F.col("first_frame")).otherwise(F.col("start_frame")).alias("start_frame"),
        F.when(F.col("_is_last"), F.col("last_frame")).otherwise(F.col("end_frame")).alias("end_frame"),
        F.col("text").alias("subtask_instruction"),
        F.lit(MODEL_SOURCE).alias("instruction_source"),
    )


def fallback_segments(segments: DataFrame, episodes: DataFrame) -> DataFrame:
    """Add the whole episode as one segment where no segment is left.

    `episodes`: episode_id, first_frame, last_frame, task_instruction.
    """
    bare = episodes.join(segments.select(KEY).distinct(), KEY, "left_anti").select(
        KEY,
        F.lit("segment_000").alias("segment_id"),
        F.lit(0).cast("bigint").alias("segment_index"),
        F.col("first_frame").alias("start_frame"),
        F.col("last_frame").alias("end_frame"),
        F.col("task_instruction").alias("subtask_instruction"),
        F.lit(FALLBACK_SOURCE).alias("instruction_source"),
    )
    return segments.unionByName(bare)


def subgoal_pose(segments: DataFrame, frames: DataFrame, columns: list[str]) -> DataFrame:
    """Pose at the last frame of every segment; null where that frame does not exist."""
    wanted = segments.withColumn("frame_index", F.col("end_frame"))
    return frame_lookup(wanted, frames, columns).withColumnRenamed("frame_index", "subgoal_frame")


def goal_pose(episodes: DataFrame, frames: DataFrame, columns: list[str]) -> DataFrame:
    """Pose at the last frame of every episode; null where that frame does not exist."""
    wanted = episodes.select("*", F.col("last_frame").alias("frame_index"))
    return frame_lookup(wanted, frames, columns).withColumnRenamed("frame_index", "goal_frame")


def with_instruction(episodes: DataFrame, column: str = "task_instruction") -> DataFrame:
    """Episodes with their instruction read as text; a missing or empty one is an error when the rows are read."""
    text = parse_text(F.col(column))
    named = F.concat(F.lit("no task instruction in episode "), F.col(KEY).cast("string"))
    return episodes.withColumn(column, F.when(F.coalesce(text, F.lit("")) == "", F.raise_error(named).cast("string")).otherwise(text))


def subtask_records(
    segments: DataFrame, episodes: DataFrame, frames: DataFrame, columns: list[str], samples: int = 8, max_frames: int = 0
) -> DataFrame:
    """One record per episode: instruction, frames shown to the model, segments with their end poses, and the goal pose.

    `segments` come from `fallback_segments`, so each episode has one at least; `episodes`: episode_id, first_frame, last_frame,
    task_instruction. A record holds the segments of an episode, at most one per frame, and no frames. All poses wanted are
    looked up together, so the frames are read and reduced once.
    """
    ends = segments.select(KEY, F.struct("segment_index", "segment_id", "start_frame", "end_frame", "subtask_instruction", "instruction_source").alias("_s"), F.col("end_frame").alias("frame_index"))
    goals = episodes.select(KEY, F.lit(None).cast(ends.schema["_s"].dataType).alias("_s"), F.col("last_frame").alias("frame_index"))
    found = frame_lookup(ends.unionByName(goals), frames, columns)
    pose = F.when(F.coalesce(*[F.col(c).isNotNull() for c in columns]), F.struct(*columns))
    is_goal = F.col("_s").isNull()
    listed = F.sort_array(F.collect_list(F.when(~is_goal, F.struct("_s.*", pose.alias("pose")))))
    records = found.groupBy(KEY).agg(listed.alias("subtask_segments"), F.max(F.when(is_goal, pose)).alias("goal_pose"))
    shown = chosen_frames(uniform_numbers(F.col("first_frame"), F.col("last_frame"), F.lit(samples)), max_frames)
    heads = with_instruction(episodes).select(KEY, "task_instruction", shown.alias("shown_frames"), F.col("last_frame").alias("goal_frame"))
    source = F.get("subtask_segments", 0)["instruction_source"]
    return heads.join(records, KEY).withColumn("segment_source", source)


def subtask_summary(segments: DataFrame, episodes: DataFrame) -> DataFrame:
    """One row per episode: number of segments, instruction, source."""
    counts = segments.groupBy(KEY).agg(F.count(F.lit(1)).alias("num_segments"), F.min("instruction_source").alias("segment_source"))
    return episodes.select(KEY, "task_instruction").join(counts, KEY)
