"""Per-frame motion signals and traces. Input: frames numbered by `blocks.index_frames`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gripline.functions.geometry import project_trace
from gripline.operators.blocks import (
    BLOCK,
    KEY,
    Carried,
    attach_episode,
    block_number,
    by_step,
    one_block,
    scan_blocks,
    with_halo,
)

# --- fixed values: smoothing weights of a 5-point quadratic Savitzky-Golay filter -----
SAVGOL_5 = (-3.0, 12.0, 17.0, 12.0, -3.0)
SAVGOL_5_SUM = 35.0

EPS_SIGNALS = 1e-8  # fixed values: guard in the normalisation of the two phase detectors
EPS_GRASP = 1e-6


def gripper_values(gripper: str = "gripper") -> dict:
    """Episode values the normalisation needs: lowest and highest reading, and whether any is NaN."""
    g = F.col(gripper)
    return {
        "gripper_min": (F.min(g), F.min),
        "gripper_max": (F.max(F.nanvl(g, F.lit(None))), F.max),
        "gripper_nan": (F.max(F.isnan(g)), F.max),
    }


def gripper_norm(eps: float, gripper: str = "gripper") -> Column:
    """(g - min) / (max - min + eps); null for the whole episode when one reading is NaN.

    Null makes every later comparison false, as NaN does outside Spark, where NaN sorts last.
    """
    spread = F.col("gripper_max") - F.col("gripper_min") + F.lit(eps)
    return F.when(~F.col("gripper_nan"), (F.col(gripper) - F.col("gripper_min")) / spread)


def nan_to_null(value: Column) -> Column:
    return F.nanvl(value, F.lit(None).cast("double"))


def ee_velocity() -> Column:
    """Distance to the previous position, 0 on the first frame (inside a `by_step` window)."""
    step = [F.col(c) - F.lag(c).over(by_step()) for c in "xyz"]
    return F.coalesce(F.sqrt(sum((d * d for d in step[1:]), step[0] * step[0])), F.lit(0.0))


def gripper_delta(gripper: str = "gripper") -> Column:
    return F.coalesce(F.col(gripper) - F.lag(gripper).over(by_step()), F.lit(0.0))


def with_signals(indexed: DataFrame, eps: float = EPS_SIGNALS) -> DataFrame:
    """Velocity, raw gripper change and normalised gripper in one shuffle."""
    wide = with_halo(indexed, before=1)
    return (
        wide.withColumn("ee_velocity", ee_velocity())
        .withColumn("gripper_delta", gripper_delta())
        .withColumn("gripper_norm", gripper_norm(eps))
        .where("home")
        .drop("home")
    )


def point(x="x", y="y", z="z") -> Column:
    return F.struct(F.col(x).alias("x"), F.col(y).alias("y"), F.col(z).alias("z"))


def future_trace(indexed: DataFrame, horizon: int = 10, include_current: bool = True, out: str = "future_trace") -> DataFrame:
    """The next positions of every frame, shorter at the end of the episode."""
    if horizon <= 0:
        raise ValueError("horizon must be positive")
    first, last = (0, horizon - 1) if include_current else (1, horizon)
    reach = by_step().rowsBetween(first, last)
    return (
        with_halo(indexed, after=last).withColumn(out, F.collect_list(point()).over(reach)).where("home").drop("home")
    )


def past(value: Column, frames: int) -> Column:
    """Values of the last frames, newest first; missing ones drop out (inside a `by_step` window)."""
    return F.reverse(F.collect_list(value).over(by_step().rowsBetween(1 - frames, 0)))


def smoothed(column: str) -> Column:
    """5-point smoothing; the two frames at either end of the episode keep their raw value."""
    parts = [F.lag(column, 2 - i) if i < 2 else F.lead(column, i - 2) for i in range(5)]
    total = sum((F.lit(w) * p.over(by_step()) for w, p in zip(SAVGOL_5[1:], parts[1:])), F.lit(SAVGOL_5[0]) * parts[0].over(by_step()))
    return F.coalesce(total / F.lit(SAVGOL_5_SUM), F.col(column))


def smoothed_trace(indexed: DataFrame, past_frames: int = 10, future_frames: int = 20, out: str = "trace") -> DataFrame:
    """Window of smoothed positions around every frame: `past_frames` before to `future_frames` after."""
    wide = with_halo(indexed, before=past_frames + 2, after=future_frames + 2)
    for axis in "xyz":
        wide = wide.withColumn(f"s{axis}", smoothed(axis))
    return around(wide, point("sx", "sy", "sz"), past_frames, future_frames, out)


def around(wide: DataFrame, value: Column, past_frames: int, future_frames: int, out: str) -> DataFrame:
    """Values of the frames around every frame, nulls kept; `wide` holds the neighbours in reach."""
    held = F.collect_list(F.struct(value.alias("v"))).over(by_step().rowsBetween(-past_frames, future_frames))
    return wide.withColumn(out, F.transform(held, lambda s: s["v"])).where("home").drop("home")


def smoothed_trace_2d(indexed: DataFrame, camera: Column, past_frames: int = 10, future_frames: int = 20, out: str = "trace_2d") -> DataFrame:
    """The same window as pixels of one fixed camera; each smoothed point is projected once and null where it has no pixel."""
    wide = with_halo(indexed, before=past_frames + 2, after=future_frames + 2)
    for axis in "xyz":
        wide = wide.withColumn(f"s{axis}", smoothed(axis))
    pixels = project_trace(F.array(point("sx", "sy", "sz")), camera)
    wide = wide.withColumn("_pixel", F.get(pixels, 0)).drop("sx", "sy", "sz")
    return around(wide, F.col("_pixel"), past_frames, future_frames, out).drop("_pixel")


def stable_contact(indexed: DataFrame, threshold: float = 0.8, window: int = 5, eps: float = EPS_SIGNALS) -> DataFrame:
    """First frame from which the gripper stays closed for `window` frames, and the state around it.

    Adds `contact_step` (null when there is none) and `contact_status`: pre before the onset, in while
    the gripper stays closed, post from the first later frame that falls below the threshold.
    """
    ahead = by_step().rowsBetween(0, window - 1)
    runs = (
        with_halo(indexed.withColumn("g", gripper_norm(eps)), after=window - 1)
        .withColumn("_low", F.min("g").over(ahead))
        .withColumn("_seen", F.count("g").over(ahead))
        .where("home")
        .withColumn("_onset", F.when((F.col("_seen") == window) & (F.col("_low") >= threshold), F.col("step")))
        .drop("home", "_low", "_seen")
    )
    onset = runs.groupBy(KEY).agg(F.min("_onset").alias("contact_step"), F.max("n_steps").alias("n_steps"))
    joined = attach_episode(runs.drop("blk", "_onset"), onset)
    fall = joined.groupBy(KEY).agg(
        F.min(F.when((F.col("step") > F.col("contact_step")) & (F.coalesce(F.col("g"), F.lit(0.0)) < threshold), F.col("step"))).alias("release_step"),
        F.max("n_steps").alias("n_steps"),
    )
    status = (
        F.when(F.col("contact_step").isNull() | (F.col("step") < F.col("contact_step")), "pre")
        .when(F.col("release_step").isNull() | (F.col("step") < F.col("release_step")), "in")
        .otherwise("post")
    )
    return attach_episode(joined.drop("blk"), fall).withColumn("contact_status", status).drop("blk", "g")


def uniform_numbers(first: Column, last: Column, samples: Column) -> Column:
    """`samples` evenly spaced whole numbers from first to last, floored, each once."""
    step = (last - first).cast("double") / F.greatest(samples - 1, F.lit(1))
    # the end point is set, not computed, so that rounding cannot move it
    values = F.transform(
        F.sequence(F.lit(0), samples.cast("int") - 1),
        lambda i: F.when(i == samples - 1, last).otherwise(F.floor(first + i * step)).cast("bigint"),
    )
    one = (samples <= 1) | (first == last)
    return F.when(one, F.array(first.cast("bigint"))).otherwise(F.array_sort(F.array_distinct(values)))


def chosen_frames(numbers: Column, max_frames: int) -> Column:
    """Of a sorted list of frame numbers at most max_frames, evenly spread by place; all of them where that is 0."""
    if max_frames <= 0:
        return numbers
    places = uniform_numbers(F.lit(0).cast("bigint"), (F.size(numbers) - 1).cast("bigint"), F.lit(max_frames))
    return F.when(F.size(numbers) > max_frames, F.transform(places, lambda i: F.get(numbers, i.cast("int")))).otherwise(numbers)


def in_uniform_numbers(place: Column, last: Column, samples: int) -> Column:
    """Whether a place from 0 to last is one of the `samples` evenly spaced ones, without a list of them.

    Place i of the samples is floor(i * step), so only the whole numbers next to place / step can lead to it.
    """
    if samples <= 1:
        return place == 0
    step = last.cast("double") / F.lit(samples - 1)
    near = F.floor(place / F.nullif(step, F.lit(0.0)))
    hit = lambda i: (i >= 0) & (i < samples - 1) & (F.floor(i * step) == place)
    return (place == last) | (place == 0) | F.coalesce(hit(near) | hit(near + 1) | hit(near + 2), F.lit(False))


def uniform_frames(episodes: DataFrame, samples: int, first: str = "first_frame", last: str = "last_frame", max_frames: int = 0) -> DataFrame:
    """Frame numbers to show for each episode, evenly spread between its first and last frame; optionally thinned evenly to max_frames."""
    picks = chosen_frames(uniform_numbers(F.col(first), F.col(last), F.lit(samples)), max_frames)
    return episodes.withColumn("frame_index", F.explode(picks))


def stride_frames(indexed: DataFrame, stride: int = 1, max_frames: int = 0) -> DataFrame:
    """Every stride-th frame of an episode and its last one; optionally thinned evenly to max_frames."""
    stride = max(1, stride)
    last = F.col("n_steps") - 1
    chosen = indexed.where((F.col("step") % stride == 0) | (F.col("step") == last))
    if max_frames <= 0:
        return chosen
    # position among the chosen frames, known from the step alone
    regular = F.floor(last / F.lit(stride)) + 1
    total = regular + F.when(last % stride == 0, 0).otherwise(1)
    place = F.when(F.col("step") % stride == 0, F.floor(F.col("step") / F.lit(stride))).otherwise(regular)
    keep = in_uniform_numbers(place, total - 1, max_frames)
    return chosen.where((total <= max_frames) | keep)


def most_rows(rows: DataFrame) -> int:
    """Number of rows of the episode that has most of them."""
    return rows.groupBy(KEY).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0


def nearest_in_order(frames: DataFrame, marks: DataFrame, mark: str, number: str = "frame_index", size: int | None = None) -> DataFrame:
    """For every frame the marks at or before and at or after it: `before_mark`, `after_mark`.

    `marks` has one row per (episode_id, number) and a struct column `mark`. Both are laid in one
    order per episode and block; what a block needs from outside is carried to it, so no pairs are formed.
    """
    size = size or BLOCK
    whole = "step" in frames.columns and one_block(frames, size) and most_rows(marks) <= size
    both = (
        frames.withColumn("_own", F.lit(1))
        .unionByName(marks.select(KEY, number, mark).withColumn("_own", F.lit(0)), allowMissingColumns=True)
        .withColumn("blk", F.lit(0).cast("bigint") if whole else block_number(F.col(number), size))
    )
    up = Window.partitionBy(KEY, "blk").orderBy(number, "_own").rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy(KEY, "blk").orderBy(F.col(number).desc(), F.col("_own")).rowsBetween(Window.unboundedPreceding, 0)
    near = both.withColumn("_b", F.last(mark, ignorenulls=True).over(up)).withColumn("_a", F.last(mark, ignorenulls=True).over(down))
    if whole:
        return near.where("_own = 1").select(*frames.columns, F.col("_b").alias("before_mark"), F.col("_a").alias("after_mark"))
    has = F.when(F.col(mark).isNotNull(), F.col(number))
    edges = both.groupBy(KEY, "blk").agg(F.max_by(mark, has).alias("_hi"), F.min_by(mark, has).alias("_lo"))
    outside = scan_blocks(edges, {"_before": Carried("last", "_hi"), "_after": Carried("next", "_lo")})
    return (
        near.where("_own = 1")
        .join(outside.select(KEY, "blk", "_before", "_after"), [KEY, "blk"])
        .withColumn("before_mark", F.coalesce("_b", "_before"))
        .withColumn("after_mark", F.coalesce("_a", "_after"))
        .select(*frames.columns, "before_mark", "after_mark")
    )


