"""Phase detection: two finite-state machines, smoothing, and runs of equal phases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from gripline.functions.text import phase_alias
from gripline.operators.blocks import (
    KEY,
    Carried,
    apply_change,
    attach_episode,
    by_step,
    one_block,
    pack_change,
    replay_states,
    scan_blocks,
    with_halo,
)
from gripline.operators.signals import EPS_GRASP, EPS_SIGNALS, gripper_delta, gripper_norm, nan_to_null

# --- fixed values: state names in state order -------------------------------------------
GRASP = ("pre_grasp", "immobilization", "contact", "detach", "post_grasp")
FIVE = ("approach", "stabilize", "contact", "release", "reset")
EDGE_PHASE = "transition"  # part of the nested output, never entered on ordered numbers

CONTACT = 2


def name_of(state: Column, names: tuple[str, ...]) -> Column:
    return F.get(F.array(*[F.lit(n) for n in names]), state)


def grasp_change(g: Column, p: Column, grasp: float, contact: float) -> Column:
    """State change of the grasp machine for a reading g after p."""
    closing, opening = g > p, g < p
    start_closing = (g > grasp) & closing
    return pack_change(
        [
            F.when(start_closing, 1).otherwise(0),
            F.when(g >= contact, 2).when((g <= grasp) & opening, 0).otherwise(1),
            F.when((g < contact) & opening, 3).otherwise(2),
            F.when(g <= grasp, 4).when((g >= contact) & closing, 2).otherwise(3),
            F.when(start_closing, 1).otherwise(4),
        ]
    )


def coded_grasp(indexed: DataFrame, thresholds: list[tuple[float, float]], payload: list[str]) -> tuple[DataFrame, dict[str, str]]:
    """One packed change per threshold pair and frame, ready for `replay_states`."""
    g = F.col("_g")
    wide = with_halo(indexed.withColumn("_g", gripper_norm(EPS_GRASP)), before=1)
    wide = wide.withColumn("_p", F.coalesce(F.lag("_g").over(by_step()), g)).where("home")
    codes = {f"m{i}": f"_code_{i}" for i in range(len(thresholds))}
    coded = wide.select(
        KEY, "blk", "step", *payload, *[grasp_change(g, F.col("_p"), *pair).alias(f"_code_{i}") for i, pair in enumerate(thresholds)]
    )
    return coded, codes


def grasp_phases(
    indexed: DataFrame, grasp: float = 0.4, contact: float = 0.9, payload: tuple[str, ...] = ("frame_index", "n_steps")
) -> DataFrame:
    """Gripper phase of every frame (`phase`)."""
    coded, codes = coded_grasp(indexed, [(grasp, contact)], list(payload))
    run = replay_states(coded, codes, payload=list(payload))
    return run.withColumn("phase", name_of(F.col("m0"), GRASP)).drop("m0", "m0_before")


def five_change(s: Column, d: Column, tau_g: float, tau_c: float, eps: float) -> Column:
    closed = (s >= tau_c) & (F.abs(d) <= eps)
    return pack_change(
        [
            F.when(closed, 2).when((s < tau_g) & (d < -eps), 0).otherwise(1),
            F.when(closed, 2).otherwise(1),
            F.when(d > eps, 3).otherwise(2),
            F.when(s < tau_g, 4).otherwise(3),
            F.lit(0),
        ]
    )


def five_confidence(before: Column, after: Column) -> Column:
    """Confidence of a step, given the states before and after it."""
    same = before == after
    return (
        F.when(before == 0, F.when(after == 2, 0.85).when(same, 0.9).otherwise(0.75))
        .when(before == 1, F.when(after == 2, 0.9).otherwise(0.8))
        .when(before == 2, F.when(after == 3, 0.85).otherwise(0.95))
        .when(before == 3, F.when(after == 4, 0.8).otherwise(0.85))
        .otherwise(0.7)
    )


def five_phases(
    indexed: DataFrame,
    tau_g: float = 0.5,
    tau_c: float = 0.8,
    eps: float = 0.02,
    payload: tuple[str, ...] = ("frame_index", "n_steps"),
    before: int = 1,
    windows: dict[str, Column] | None = None,
) -> DataFrame:
    """Manipulation phase with confidence (`raw_phase`, `phase_confidence`) and smoothed `phase`.

    `windows` are further columns over the same ordered window with a reach of `before` earlier
    frames; they share the shuffle.
    """
    wide = with_halo(indexed.withColumn("gripper_norm", gripper_norm(EPS_SIGNALS)), before=max(1, before), after=1)
    wide = wide.withColumn("gripper_delta", gripper_delta())
    for name, column in (windows or {}).items():
        wide = wide.withColumn(name, column)
    d = nan_to_null(F.col("gripper_delta"))
    stay = pack_change([F.lit(i) for i in range(5)])
    change = F.when(F.col("step") == 0, stay).otherwise(five_change(F.col("gripper_norm"), d, tau_g, tau_c, eps))
    wide = wide.withColumn("_code", change).withColumn("_next", F.lead("_code").over(by_step())).where("home")
    keep = [*payload, *(windows or {}), "gripper_norm", "gripper_delta", "_next"]
    rows = replay_states(wide.select(KEY, "blk", "step", "_code", *keep), {"s": "_code"}, payload=keep)
    following = apply_change(F.col("_next"), F.col("s"))
    # the next state decides whether a frame stands; a lone frame takes the last one that did
    stands = (F.col("step") == 0) | F.col("_next").isNull() | (F.col("s") == following)
    rows = rows.withColumn(
        "phase_confidence", F.when(F.col("step") == 0, 0.0).otherwise(five_confidence(F.col("s_before"), F.col("s")))
    ).withColumn("_firm", F.when(stands, F.col("s")))
    return (
        hold_last(rows, "_firm", "_held")
        .withColumn("raw_phase", name_of(F.col("s"), FIVE))
        .withColumn("phase", name_of(F.col("_held"), FIVE))
        .drop("s", "s_before", "_next", "_firm", "_held")
    )


def hold_last(blocked: DataFrame, value: str, out: str) -> DataFrame:
    """Last non-null value up to each frame of the episode; rows are blocked by (episode_id, blk)."""
    upto = by_step().rowsBetween(Window.unboundedPreceding, 0)
    if one_block(blocked):
        return blocked.withColumn(out, F.last(value, ignorenulls=True).over(upto))
    last = blocked.groupBy(KEY, "blk").agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col("step"))).alias("_last"))
    outside = scan_blocks(last, {"_outside": Carried("last", "_last")}).select(KEY, "blk", "_outside")
    return (
        blocked.withColumn("_inside", F.last(value, ignorenulls=True).over(upto))
        .join(outside, [KEY, "blk"])
        .withColumn(out, F.coalesce("_inside", "_outside"))
        .drop("_inside", "_outside")
    )


def smooth_phases(indexed: DataFrame, phase: str = "phase", out: str = "smoothed") -> DataFrame:
    """Replace single-frame blips, left to right: a frame unlike its successor takes the value before it."""
    wide = with_halo(indexed, after=1)
    follower = F.lead(phase).over(by_step())
    firm = (F.col("step") == 0) | (F.col("step") == F.col("n_steps") - 1) | (F.col(phase) == F.col("_next"))
    marked = wide.withColumn("_next", follower).where("home").withColumn("_firm", F.when(firm, F.col(phase)))
    return hold_last(marked.drop("home", "_next"), "_firm", out).drop("_firm", "blk")


def mean_confidence(phased: DataFrame) -> DataFrame:
    return phased.groupBy(KEY).agg(F.avg("phase_confidence").alias("phase_det_confidence"))


def phase_ranges(phased: DataFrame, phase: str = "phase", names: tuple[str, ...] = GRASP) -> DataFrame:
    """Maximal runs of equal phase: start_step, end_step and range_index (count of earlier runs of that phase).

    Only the first row of each run is kept; runs of one episode may span many blocks.
    """
    wide = with_halo(phased.drop("blk"), before=1)
    earlier = F.lag(phase).over(by_step())
    starts = (
        wide.withColumn("_was", earlier)
        .where(F.col("home") & (F.col("_was").isNull() | (F.col("_was") != F.col(phase))))
        .select(KEY, "blk", "step", "n_steps", F.col(phase).alias("phase"))
    )
    in_block = Window.partitionBy(KEY, "blk").orderBy("step")
    of_phase = Window.partitionBy(KEY, "blk", "phase").orderBy("step")
    local = starts.withColumn("_next_in", F.lead("step").over(in_block)).withColumn("_nth", F.row_number().over(of_phase) - 1)
    last_step = F.coalesce("_next_in", "n_steps") - 1
    if one_block(phased):
        return local.select(KEY, "phase", F.col("_nth").cast("bigint").alias("range_index"), F.col("step").alias("start_step"), last_step.alias("end_step"))
    counts = {f"_n_{n}": F.count(F.when(F.col("phase") == n, 1)) for n in names}
    blocks = starts.groupBy(KEY, "blk").agg(F.min("step").alias("_first"), *[c.alias(n) for n, c in counts.items()])
    carried = {"_next_out": Carried("next", "_first"), **{f"_b{n}": Carried("sum", n) for n in counts}}
    outside = scan_blocks(blocks, carried).select(KEY, "blk", *carried)
    before = F.element_at(F.create_map(*[x for n in names for x in (F.lit(n), F.col(f"_b_n_{n}"))]), F.col("phase"))
    following = F.coalesce("_next_in", "_next_out", "n_steps")
    return local.join(outside, [KEY, "blk"]).select(
        KEY,
        "phase",
        (before + F.col("_nth")).cast("bigint").alias("range_index"),
        F.col("step").alias("start_step"),
        (following - 1).cast("bigint").alias("end_step"),
    )


def ranges_nested(ranges: DataFrame, part_size: int = 4096) -> DataFrame:
    """Ranges of an episode as phase -> [[start, end], ...], in parts of `part_size` ranges per phase.

    Every part holds all phase names, with an empty list where it has no range; an ordinary episode
    is one part.
    """
    part = F.floor(F.col("range_index") / F.lit(part_size)).alias("part")
    pair = F.struct(F.col("range_index"), F.array("start_step", "end_step").alias("r"))

    def of(name: str) -> Column:
        mine = F.sort_array(F.collect_list(F.when(F.col("phase") == name, pair)))
        return mine.getField("r")

    names = (*GRASP, EDGE_PHASE)
    entries = F.create_map(*[x for n in names for x in (F.lit(n), of(n))])
    return ranges.groupBy(KEY, part).agg(entries.alias("phase_ranges"))


def clip_manifest(ranges: DataFrame, fps: DataFrame, names: tuple[str, ...] = GRASP) -> DataFrame:
    """One row per clip to cut: name, start and length in seconds, and file name.

    Clips count in the order of the phase list, then of the range. The number of ranges in earlier
    phases gives each phase its first clip number, so ranges are never gathered by episode.
    """
    counts = ranges.groupBy(KEY).agg(
        (F.max("end_step") + 1).alias("n_steps"), *[F.count(F.when(F.col("phase") == n, 1)).alias(f"_n_{n}") for n in names]
    )
    offsets, so_far = [], F.lit(0)
    for n in names:
        offsets += [F.lit(n), so_far.cast("bigint")]
        so_far = so_far + F.col(f"_n_{n}")
    firsts = counts.join(fps, KEY, "left").select(KEY, "fps", "n_steps", F.create_map(*offsets).alias("_firsts"))
    display = phase_alias(F.col("phase"))
    clip = F.element_at("_firsts", F.col("phase")) + F.col("range_index")
    length = (F.col("end_step") - F.col("start_step") + 1) / F.col("fps")
    return attach_episode(ranges.withColumn("step", F.col("start_step")), firsts).select(
        KEY,
        clip.alias("clip"),
        display.alias("display"),
        "phase",
        "range_index",
        F.col("start_step").alias("start_frame"),
        F.col("end_step").alias("end_frame"),
        (F.col("start_step") / F.col("fps")).alias("start_seconds"),
        length.alias("duration_seconds"),
        F.format_string("%02d_%s_frames_%06d_%06d.mp4", clip, display, F.col("start_step"), F.col("end_step")).alias("path"),
    )


def first_contact(phased: DataFrame, phase: str = "phase", frame: str = "frame_index") -> DataFrame:
    """Smallest contact frame of each episode, null without contact."""
    return phased.groupBy(KEY).agg(F.min(F.when(F.col(phase) == "contact", F.col(frame))).alias("contact_frame"))


