"""Project traces to the image, compare them with annotated ones, and choose the projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gripline.functions.geometry import camera_rows, project_trace
from gripline.operators.blocks import KEY, attach_episode, longest_of, note_longest
from gripline.operators.signals import nearest_in_order
from gripline.sources.session import settle

VISIBLE_THRESHOLD = 0.2  # fixed value


def nearest_camera(frames: DataFrame, cameras: DataFrame, robot_to_world: Column | None = None) -> DataFrame:
    """Camera with the closest frame number: `cam_pos` and its `camera` rows; a tie goes to the earlier position.

    Best done while the frames are narrow, before traces are built.
    """
    whole = F.struct("cam_pos", F.col("frame_index").alias("cam_frame"), camera_rows(F.col("K"), F.col("E"), robot_to_world).alias("rows"))
    single = cameras.groupBy(KEY, "frame_index").agg(F.min_by(whole, "cam_pos").alias("cam"))
    near = nearest_in_order(frames, single, "cam")

    def rank(mark: str) -> Column:
        gap = F.abs(F.col(mark)["cam_frame"] - F.col("frame_index"))
        return F.when(F.col(mark).isNotNull(), F.struct(gap.alias("gap"), F.col(mark)["cam_pos"].alias("pos")))

    first, second = rank("before_mark"), rank("after_mark")
    after_wins = F.col("before_mark").isNull() | (second < first)
    chosen = F.when(after_wins & F.col("after_mark").isNotNull(), F.col("after_mark")).otherwise(F.col("before_mark"))
    out = near.withColumn("_cam", chosen).select(*frames.columns, F.col("_cam")["cam_pos"].alias("cam_pos"), F.col("_cam")["rows"].alias("camera"))
    return note_longest(out, longest_of(frames)) if "step" in frames.columns else out


def with_projection(frames: DataFrame, trace: str = "future_trace", out: str = "trace_2d") -> DataFrame:
    """Trace through the frame's camera; no camera gives points without a pixel."""
    return frames.withColumn(out, project_trace(F.col(trace), F.col("camera")))


def visible_counts(trace: str, width: Column, height: Column) -> tuple[Column, Column]:
    """(points with a pixel, points inside the image) of one trace."""
    seen = F.filter(F.col(trace), lambda p: p.isNotNull())
    inside = F.filter(seen, lambda p: (p["u"] >= 0) & (p["u"] < width) & (p["v"] >= 0) & (p["v"] < height))
    return F.size(seen), F.size(inside)


def visible_ratio(frames: DataFrame, trace: str = "trace_2d", width: Column | None = None, height: Column | None = None) -> DataFrame:
    """Share of projected points inside the image, per episode; 0 when nothing was projected."""
    seen, inside = visible_counts(trace, width if width is not None else F.col("width"), height if height is not None else F.col("height"))
    return (
        frames.groupBy(KEY)
        .agg(F.sum(seen).alias("points"), F.sum(inside).alias("inside"), F.max("n_steps").alias("n_steps"))
        .withColumn("visible_ratio", ratio_of("inside", "points"))
    )


def zip_traces(left: str, right: str) -> Column:
    """Pairs of two traces by position, up to the shorter one."""
    count = F.least(F.size(left), F.size(right))
    pairs = F.arrays_zip(F.slice(F.col(left), F.lit(1), count).alias("pred"), F.slice(F.col(right), F.lit(1), count).alias("gt"))
    return F.when(count > 0, pairs)


def trace_pairs(frames: DataFrame, trace: str = "future_trace", gt: str = "gt_trace") -> DataFrame:
    """One row per paired point: position in 3D and annotated pixel."""
    pairs = frames.where(F.size(gt) > 0).select(KEY, "frame_index", F.posexplode(zip_traces(trace, gt)).alias("idx", "pair"))
    p, g = F.col("pair")["pred"], F.col("pair")["gt"]
    return pairs.select(
        KEY, "frame_index", "idx", p["x"].alias("x"), p["y"].alias("y"), p["z"].alias("z"), F.get(g, 0).alias("u"), F.get(g, 1).alias("v")
    )


AXES = ("x", "y", "z")


def moments() -> dict[str, Column]:
    """Centred second moments and means of paired points; Spark merges them from partial results."""
    out = {"pair_count": F.count("u")}
    out |= {f"c_{a}{b}": F.covar_pop(a, b) for i, a in enumerate(AXES) for b in AXES[i:]}
    out |= {f"c_{a}{t}": F.covar_pop(a, t) for a in AXES for t in "uv"}
    return out | {f"m_{c}": F.avg(c) for c in (*AXES, "u", "v")}


def fit_affine(pairs: DataFrame) -> DataFrame:
    """Least-squares map from (x, y, z, 1) to (u, v) per episode; null with fewer than four points."""
    sums = pairs.groupBy(KEY).agg(*[c.alias(n) for n, c in moments().items()])
    return solve_affine(sums).select(KEY, "pair_count", *AFFINE)


def solve_affine(sums: DataFrame) -> DataFrame:
    """Closed 3x3 solve over `moments`.

    A set of points that does not span all three axes has no unique map and gives null.
    """

    def c(a: str, b: str) -> str:
        return f"c_{a}{b}" if (a, b) in {("x", "x"), ("x", "y"), ("x", "z"), ("y", "y"), ("y", "z"), ("z", "z")} or b in "uv" else f"c_{b}{a}"

    def det3(r: list[list[str]]) -> str:
        minor = lambda i, j: f"({r[1][i]} * {r[2][j]} - {r[1][j]} * {r[2][i]})"
        return f"({r[0][0]} * {minor(1, 2)} - {r[0][1]} * {minor(0, 2)} + {r[0][2]} * {minor(0, 1)})"

    m = [[c(a, b) for b in AXES] for a in AXES]
    whole = sums.selectExpr("*", f"{det3(m)} as _det")
    usable = f"pair_count >= 4 and abs(_det) > 1e-12D * {m[0][0]} * {m[1][1]} * {m[2][2]}"
    weights = []
    for t in "uv":
        for i, a in enumerate(AXES):
            replaced = [[c(AXES[r], t) if j == i else m[r][j] for j in range(3)] for r in range(3)]
            weights.append(f"case when {usable} then {det3(replaced)} / _det end as a_{a}{t}")
    solved = whole.selectExpr("*", *weights)
    shifts = [f"m_{t} - a_x{t} * m_x - a_y{t} * m_y - a_z{t} * m_z as a_1{t}" for t in "uv"]
    drop = [n for n in moments() if n != "pair_count"]
    return solved.selectExpr("*", *shifts).drop("_det", *drop)


AFFINE = tuple(f"a_{a}{t}" for t in "uv" for a in ("x", "y", "z", "1"))


def apply_affine(trace: str) -> Column:
    """Pixels of a trace by the episode's fitted map; every point null without one."""

    def at(p: Column, t: str) -> Column:
        return p["x"] * F.col(f"a_x{t}") + p["y"] * F.col(f"a_y{t}") + p["z"] * F.col(f"a_z{t}") + F.col(f"a_1{t}")

    fitted = F.col("a_1u").isNotNull()
    return F.transform(F.col(trace), lambda p: F.when(fitted, F.struct(at(p, "u").alias("u"), at(p, "v").alias("v"))))


def choose_projection(ratio: Column, has_fit: Column, mode: str = "auto", threshold: float = VISIBLE_THRESHOLD) -> Column:
    """True where the fitted map replaces the camera projection."""
    if mode == "fit":
        return F.lit(True)
    if mode == "auto":
        return (ratio < threshold) & has_fit
    return F.lit(False)


def two_places(ratio: Column) -> Column:
    """A share from 0 to 1 as text with two places, cut as Python cuts it: by the exact value of the double, ties to even.

    Java's formats round the shortest decimal of a double, and halves up. Times 2^62 a share is a whole number; what is lost
    below 2^-9 is far from any half.
    """
    whole = F.lit(2**62).cast("decimal(20,0)")
    exact = (ratio * F.lit(float(2**62))).cast("bigint").cast("decimal(20,0)") * F.lit(100).cast("decimal(3,0)")
    down = F.floor(exact / whole).cast("bigint")
    # the quotient may have been rounded up to the next whole number
    down = down - F.when(down.cast("decimal(20,0)") * whole > exact, 1).otherwise(0)
    twice = (exact - down.cast("decimal(20,0)") * whole) * F.lit(2).cast("decimal(1,0)")
    cents = down + F.when(twice > whole, 1).when(twice == whole, down % 2).otherwise(0)
    return F.format_string("%d.%02d", F.floor(cents / 100), cents % 100)


def projection_label(use_fit: Column, ratio: Column) -> Column:
    return F.when(use_fit, F.concat(F.lit("fit_from_gt(da3_visible="), two_places(ratio), F.lit(")"))).otherwise(F.lit("da3"))


def with_trace_error(predicted: DataFrame, pred: str = "pred_trace", gt: str = "gt_trace") -> DataFrame:
    """Usable pairs, mean distance over them, and distance at the last common position."""

    def gap(pair: Column) -> Column:
        du, dv = pair["pred"]["u"] - F.get(pair["gt"], 0), pair["pred"]["v"] - F.get(pair["gt"], 1)
        return F.sqrt(du * du + dv * dv)

    total = F.aggregate("_usable", F.lit(0.0), lambda acc, d: acc + d)
    return (
        predicted.withColumn("_gaps", F.transform(zip_traces(pred, gt), gap))
        .withColumn("_usable", F.filter("_gaps", lambda d: d.isNotNull()))
        .withColumn("point_count", F.when(F.col("_usable").isNull(), 0).otherwise(F.size("_usable")).cast("bigint"))
        .withColumn("mean_l2_px", F.when(F.col("point_count") > 0, total / F.col("point_count")))
        .withColumn("endpoint_l2_px", F.element_at("_gaps", -1))
        .drop("_gaps", "_usable")
    )


def project_episodes(
    frames: DataFrame, video_info: DataFrame, mode: str = "auto", threshold: float = VISIBLE_THRESHOLD
) -> DataFrame:
    """Predicted trace of every frame (`pred_trace`) after the choice made for its episode.

    `frames` has future_trace, gt_trace and camera; per-episode values come back by block, not by episode. Every frame is projected once:
    the traces are written, one pass over them gives each episode's moments and counts, and a second one the predictions.
    """
    once = with_projection(frames, out="camera_trace").drop("camera")
    projected = note_longest(settle(once), longest_of(frames))
    stats = episode_stats(projected, video_info, fitted=mode in ("fit", "auto"))
    use_fit = choose_projection(F.col("visible_ratio"), F.col("a_1u").isNotNull(), mode, threshold)
    values = stats.withColumn("use_fit", use_fit).withColumn("projection_label", projection_label(use_fit, F.col("visible_ratio")))
    return (
        attach_episode(projected.drop("blk"), values)
        .drop("blk")
        .withColumn("pred_trace", F.when(F.col("use_fit"), apply_affine("future_trace")).otherwise(F.col("camera_trace")))
    )


def episode_stats(projected: DataFrame, video_info: DataFrame, fitted: bool = True) -> DataFrame:
    """Visible share and fitted map of each episode, from one pass over the frames.

    Every paired point is a row; the counts of visible points ride on the first row of their frame.
    """
    sized = attach_episode(projected.drop("blk"), with_length(projected, video_info)).drop("blk")
    seen, inside = visible_counts("camera_trace", F.col("width"), F.col("height"))
    counted = sized.select(
        KEY, "n_steps", seen.alias("_seen"), inside.alias("_inside"), zip_traces("future_trace", "gt_trace" if fitted else "future_trace").alias("_pairs")
    )
    rows = counted.select(KEY, "n_steps", "_seen", "_inside", F.posexplode_outer(F.col("_pairs") if fitted else F.lit(None).cast(counted.schema["_pairs"].dataType)).alias("_i", "_p"))
    p, g = F.col("_p")["pred"], F.col("_p")["gt"]
    first = F.coalesce("_i", F.lit(0)) == 0
    target = [F.get(g, i) for i in range(2)] if fitted else [F.lit(None).cast("double")] * 2
    points = rows.select(
        KEY,
        "n_steps",
        F.when(first, F.col("_seen")).alias("_seen"),
        F.when(first, F.col("_inside")).alias("_inside"),
        *[p[a].alias(a) for a in AXES],
        target[0].alias("u"),
        target[1].alias("v"),
    )
    sums = points.groupBy(KEY).agg(
        F.max("n_steps").alias("n_steps"), F.sum("_seen").alias("points"), F.sum("_inside").alias("inside"), *[c.alias(n) for n, c in moments().items()]
    )
    return solve_affine(sums.withColumn("visible_ratio", ratio_of("inside", "points"))).drop("points", "inside")


def ratio_of(part: str, whole: str) -> Column:
    return F.coalesce(F.try_divide(F.col(part).cast("double"), F.col(whole)), F.lit(0.0))


def with_length(frames: DataFrame, episodes: DataFrame) -> DataFrame:
    """Add the number of steps to one-row-per-episode values."""
    return frames.groupBy(KEY).agg(F.max("n_steps").alias("n_steps")).join(episodes, KEY, "left")


def trace_summary(predicted: DataFrame) -> DataFrame:
    """Errors of each episode: mean over frames, and the number of frames with an annotated trace."""
    rows = with_trace_error(predicted).withColumn("_gt", F.size("gt_trace"))
    return rows.groupBy(KEY).agg(
        F.max("projection_label").alias("projection_label"),
        F.max("visible_ratio").alias("visible_ratio"),
        F.count(F.when(F.col("_gt") > 0, 1)).alias("frames_with_gt_trace"),
        F.avg("mean_l2_px").alias("mean_trace_l2_px"),
        F.avg("endpoint_l2_px").alias("mean_endpoint_l2_px"),
    )


def with_mean_row(summary: DataFrame) -> DataFrame:
    """Per-episode rows and one MEAN row over the values present."""
    numeric = ("visible_ratio", "frames_with_gt_trace", "mean_trace_l2_px", "mean_endpoint_l2_px")
    rows = settle(summary).withColumn(KEY, F.col(KEY).cast("string")).withColumn("frames_with_gt_trace", F.col("frames_with_gt_trace").cast("double"))
    mean = rows.agg(*[F.avg(c).alias(c) for c in numeric]).withColumn(KEY, F.lit("MEAN")).withColumn("projection_label", F.lit(None).cast("string"))
    return rows.unionByName(mean)
