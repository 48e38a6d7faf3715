"""Score detected contact frames and poses against labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gripline.functions.geometry import l2_error
from gripline.functions.text import threshold_tag
from gripline.operators.blocks import KEY, first_in_state, longest_of, note_longest, product_words
from gripline.operators.phases import CONTACT, coded_grasp
from gripline.sources.session import settle

TOLERANCES = (0, 1, 3, 5, 10)  # fixed values
SWEEP = ((0.4, 0.85), (0.4, 0.9), (0.4, 0.93), (0.4, 0.95), (0.5, 0.9))  # fixed values: published pairs


def last_row_per_frame(frames: DataFrame, columns: list[str], position: str = "step") -> DataFrame:
    """One row per (episode, frame); of repeated frames the last one. Combines before the shuffle."""
    return (
        frames.groupBy(KEY, "frame_index")
        .agg(F.max_by(F.struct(*columns), position).alias("_row"))
        .select(KEY, "frame_index", *[F.col("_row")[c].alias(c) for c in columns])
    )


def frame_lookup(wanted: DataFrame, frames: DataFrame, columns: list[str], position: str = "step") -> DataFrame:
    """Values of the wanted (episode_id, frame_index) rows; null where the frame does not exist."""
    asked = frames.join(wanted.select(KEY, "frame_index").distinct(), [KEY, "frame_index"], "left_semi")
    return wanted.join(last_row_per_frame(asked, columns, position), [KEY, "frame_index"], "left")


def earliest(value: Column, position: str = "step") -> tuple[Column, object]:
    """First non-null value of an episode, in a form that partial results can be merged in."""
    return F.min(F.when(value.isNotNull(), F.struct(F.col(position).alias("at"), value.alias("value")))), F.min


def contact_frames(indexed: DataFrame, thresholds: list[tuple[float, float]] | None = None) -> DataFrame:
    """Predicted contact frame per episode and threshold pair: all pairs run as one machine, one fold over the frames."""
    thresholds = list(thresholds or [(0.4, 0.9)])
    coded, codes = coded_grasp(indexed, thresholds, ["frame_index"])
    words = {f"_w{j}": w for j, w in enumerate(product_words([F.col(c) for c in codes.values()]))}
    packed = note_longest(coded.select(KEY, "blk", "step", "frame_index", *[w.alias(n) for n, w in words.items()]), longest_of(coded))
    firsts = first_in_state(packed, list(words), len(thresholds), CONTACT, "frame_index")
    pairs = [
        F.struct(F.lit(float(g)).alias("grasp_threshold"), F.lit(float(c)).alias("contact_threshold"), F.col(f"f{i}").alias("pred_contact_frame"))
        for i, (g, c) in enumerate(thresholds)
    ]
    return firsts.select(KEY, F.inline(F.array(*pairs)))


def episode_errors(
    indexed: DataFrame, labels: DataFrame, thresholds: list[tuple[float, float]] | None = None, poses: tuple[str, str] = ("gripper_pose", "tcp_pose")
) -> DataFrame:
    """One row per episode and threshold pair: frame error and pose errors.

    `labels`: episode_id, num_frames, gt_contact_frame, gt_state_affordance, gripper_min, gripper_max.
    """
    gripper_pose, tcp_pose = poses
    # one row per episode and pair, read three times below
    base = settle(contact_frames(indexed, thresholds).join(labels, KEY))
    wanted = base.select(KEY, F.explode(F.array("pred_contact_frame", "gt_contact_frame")).alias("frame_index")).distinct()
    hits = indexed.select(KEY, "frame_index", "step", gripper_pose, tcp_pose).join(wanted, [KEY, "frame_index"], "left_semi")
    rows = settle(last_row_per_frame(hits, [gripper_pose, tcp_pose]))
    pred = rows.select(
        KEY,
        F.col("frame_index").alias("pred_contact_frame"),
        F.col(tcp_pose).alias("pred_tcp_pose"),
        F.col(gripper_pose).alias("pred_gripper_pose"),
    )
    truth = rows.select(KEY, F.col("frame_index").alias("gt_contact_frame"), F.col(tcp_pose).alias("gt_tcp_pose"))
    both = base.join(pred, [KEY, "pred_contact_frame"], "left").join(truth, [KEY, "gt_contact_frame"], "left")
    error = F.col("pred_contact_frame") - F.col("gt_contact_frame")
    gt = F.col("gt_state_affordance")
    return both.select(
        KEY,
        "grasp_threshold",
        "contact_threshold",
        "num_frames",
        "gt_contact_frame",
        "pred_contact_frame",
        error.alias("frame_error"),
        F.abs(error).alias("abs_frame_error"),
        F.try_divide(F.abs(error).cast("double"), F.col("num_frames")).alias("normalized_abs_frame_error"),
        l2_error(F.col("pred_tcp_pose"), gt, 0, 3).alias("tcp_position_l2_error"),
        l2_error(F.col("pred_tcp_pose"), gt, 3, 6).alias("tcp_rotation_l2_error"),
        l2_error(F.col("pred_tcp_pose"), gt, 0, 6).alias("tcp_pose6d_l2_error"),
        l2_error(F.col("gt_tcp_pose"), gt, 0, 3).alias("oracle_gt_tcp_position_l2_error"),
        "gripper_min",
        "gripper_max",
    )


RANKED = 1 << 20  # values of one group that may be ranked in one task


def exact_median(rows: DataFrame, by: list[str], value: str, out: str, ranked: int = RANKED, buckets: int = 4096) -> DataFrame:
    """Median that interpolates between the middle values, without gathering a group's values in one task.

    Equal values are counted first. While more than `ranked` different values of a group are in
    question, they are spread over `buckets` ranges, the ranges are counted, and only those that hold
    the two middle ranks stay; what is left is ranked. Narrowing ends where it no longer helps, as among
    infinite values. A group with a NaN has the median NaN. `by` names the configured threshold pairs: the driver
    sees one row of bounds for each.
    """
    if not by:
        return exact_median(rows.withColumn("_all", F.lit(0)), ["_all"], value, out, ranked, buckets).drop("_all")
    v, n = F.col(value), F.col("_n")
    every = settle(rows.where(v.isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n")))
    odd = F.isnan(v.cast("double"))
    counted = every.where(~odd)
    first = counted.groupBy(*by).agg(
        F.sum("_n").alias("_size"), F.min(value).alias("_low"), F.max(value).alias("_high"), F.lit(0).cast("bigint").alias("_base"), F.count(F.lit(1)).alias("_left")
    )
    schema, bounds = first.schema, first.collect()
    lower, upper = F.floor((F.col("_size") - 1) / 2), F.floor(F.col("_size") / 2)

    def in_question() -> DataFrame:
        groups = rows.sparkSession.createDataFrame(bounds, schema)
        return counted.join(F.broadcast(groups), by).where(v.between(F.col("_low"), F.col("_high")))

    running = Window.partitionBy(*by)
    most = None
    while bounds and ranked < max(b["_left"] for b in bounds) != most:
        most = max(b["_left"] for b in bounds)
        half = lambda c: F.col(c) / 2.0  # the whole span may overflow
        share = F.coalesce(F.nanvl(F.try_divide(half(value) - half("_low"), half("_high") - half("_low")), F.lit(0.0)), F.lit(0.0))
        spread = in_question().withColumn("_bucket", F.least(F.floor(share * buckets), F.lit(buckets - 1)))
        counts = spread.groupBy(*by, "_bucket", "_size", "_base").agg(
            F.sum("_n").alias("_in"), F.min(value).alias("_lo"), F.max(value).alias("_hi"), F.count(F.lit(1)).alias("_values")
        )
        before = F.sum("_in").over(running.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
        kept = (
            counts.withColumn("_start", F.col("_base") + F.coalesce(before, F.lit(0)))
            .where((F.col("_start") <= upper) & (F.col("_start") + F.col("_in") > lower))
            .groupBy(*by, "_size")
            .agg(F.min("_lo").alias("_low"), F.max("_hi").alias("_high"), F.min("_start").alias("_base"), F.sum("_values").alias("_left"))
        )
        bounds = kept.select(*schema.names).collect()
    placed = in_question().withColumn("_upto", F.col("_base") + F.sum("_n").over(running.orderBy(value)))
    holds = lambda r: (F.col("_upto") > r) & (F.col("_upto") - n <= r)
    middle = (F.max(F.when(holds(lower), v)) + F.max(F.when(holds(upper), v))) / 2.0
    medians = placed.groupBy(*by).agg(middle.alias(out))
    return medians.unionByName(every.where(odd).select(*by, F.lit(float("nan")).alias(out))).groupBy(*by).agg(F.max(out).alias(out))  # NaN is above all numbers


def exact_medians(rows: DataFrame, by: list[str], values: dict[str, str], ranked: int = RANKED, buckets: int = 4096) -> DataFrame:
    """Exact medians of several columns (`values`: column -> result), stacked as (metric, value) and narrowed in the same passes."""
    pairs = [F.struct(F.lit(out).alias("_metric"), F.col(c).cast("double").alias("_value")) for c, out in values.items()]
    stacked = rows.select(*by, F.inline(F.array(*pairs)))
    found = exact_median(stacked, [*by, "_metric"], "_value", "_median", ranked, buckets)
    return found.groupBy(*by).agg(*[F.max(F.when(F.col("_metric") == out, F.col("_median"))).alias(out) for out in values.values()])


MEDIANS = {"abs_frame_error": "median_abs_error_frames", "tcp_position_l2_error": "median_tcp_position_l2_m"}


def summarize(errors: DataFrame, by: list[str], tolerances: tuple[int, ...] = TOLERANCES, medians: tuple[str, ...] = tuple(MEDIANS.values())) -> DataFrame:
    """Contact-frame and pose metrics over all episodes, per threshold pair; of the medians, those asked for."""
    e, s = F.col("abs_frame_error").cast("double"), F.col("frame_error").cast("double")
    main = errors.groupBy(*by).agg(
        F.count(F.lit(1)).alias("num_episodes"),
        F.count("abs_frame_error").alias("num_with_gt_and_prediction"),
        F.avg(e).alias("mae_frames"),
        F.sqrt(F.avg(s * s)).alias("rmse_frames"),
        F.avg(s).alias("mean_signed_error_frames"),
        F.max(e).alias("max_abs_error_frames"),
        F.avg("normalized_abs_frame_error").alias("mean_normalized_abs_error"),
        *[F.avg((e <= t).cast("double")).alias(f"within_{t}_frames") for t in tolerances],
        F.avg("tcp_position_l2_error").alias("mean_tcp_position_l2_m"),
        F.avg("tcp_rotation_l2_error").alias("mean_tcp_rotation_l2_rad"),
        F.avg("tcp_pose6d_l2_error").alias("mean_tcp_pose6d_l2"),
    )
    wanted = {c: out for c, out in MEDIANS.items() if out in medians}
    return main.join(exact_medians(errors, by, wanted), by, "left") if wanted else main


EPISODE_COLUMNS = (
    "num_frames",
    "gt_contact_frame",
    "pred_contact_frame",
    "frame_error",
    "abs_frame_error",
    "normalized_abs_frame_error",
    "tcp_position_l2_error",
    "tcp_rotation_l2_error",
    "tcp_pose6d_l2_error",
    "gripper_raw_min",
    "gripper_raw_max",
)


def mean_row(rows: DataFrame, columns: tuple[str, ...] = EPISODE_COLUMNS, by: tuple[str, ...] = ()) -> DataFrame:
    """Mean of every numeric column over the values present."""
    return rows.groupBy(*by).agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in columns])


def summary_lines(summary: DataFrame, by: list[str], tolerances: tuple[int, ...] = TOLERANCES) -> DataFrame:
    """Summary metrics in long form: metric, value."""
    metrics = {
        "evaluated_episodes": "num_with_gt_and_prediction",
        "total_episodes": "num_episodes",
        "contact_frame_mae_frames": "mae_frames",
        "contact_frame_rmse_frames": "rmse_frames",
        "contact_frame_median_abs_error_frames": "median_abs_error_frames",
        "contact_frame_mean_signed_error_frames": "mean_signed_error_frames",
        "contact_frame_max_abs_error_frames": "max_abs_error_frames",
        "contact_frame_mean_normalized_abs_error": "mean_normalized_abs_error",
        **{f"within_{t}_frames": f"within_{t}_frames" for t in tolerances},
        **{c: c for c in ("mean_tcp_position_l2_m", "median_tcp_position_l2_m", "mean_tcp_rotation_l2_rad", "mean_tcp_pose6d_l2")},
    }
    lines = [F.struct(F.lit(m).alias("metric"), F.col(c).cast("double").alias("value")) for m, c in metrics.items()]
    return summary.select(*by, F.inline(F.array(*lines)))


def report_rows(errors: DataFrame, by: list[str]) -> DataFrame:
    """Report table: a row per episode, a MEAN row and SUMMARY rows, per threshold pair, with the pair's tag."""
    errors = errors.withColumnsRenamed({"gripper_min": "gripper_raw_min", "gripper_max": "gripper_raw_max"})
    rows = errors.select(*by, F.col(KEY).cast("string").alias(KEY), *[F.col(c).cast("double").alias(c) for c in EPISODE_COLUMNS])
    mean = mean_row(rows, by=tuple(by)).withColumn(KEY, F.lit("MEAN"))
    lines = summary_lines(summarize(errors, by), by).withColumn(KEY, F.lit("SUMMARY"))
    out = rows.unionByName(mean).unionByName(lines, allowMissingColumns=True)
    return out.withColumn("tag", threshold_tag(F.col("grasp_threshold"), F.col("contact_threshold")))


def contact_pose(indexed: DataFrame, contact: DataFrame, columns: list[str]) -> DataFrame:
    """Poses and gripper readings at the first contact frame of each episode that has one."""
    wanted = contact.where(F.col("contact_frame").isNotNull()).select(KEY, F.col("contact_frame").alias("frame_index"))
    return frame_lookup(wanted, indexed, columns)


