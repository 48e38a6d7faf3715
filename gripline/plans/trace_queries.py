"""Queries over traces, cameras, depth and annotation records."""

from __future__ import annotations

from pyspark.sql import functions as F

from gripline.functions import geometry as G
from gripline.functions import text as X
from gripline.operators import depth as DP
from gripline.operators import quality as Q
from gripline.operators import signals as S
from gripline.operators import traces as TR
from gripline.operators.blocks import KEY, attach_episode
from gripline.operators.language import language_tags
from gripline.plans import annotate as A
from gripline.plans.registry import query, six
from gripline.plans.sql_parts import (
    CHOSEN,
    DEPTH,
    FIT,
    FIVE,
    FRAMES,
    INSTRUCTIONS,
    LINES,
    MASKS,
    PAIRS,
    PIXELS,
    PROJECTED,
    QUALITY,
    QUALITY_3D,
    TRACES,
    VISIBLE,
    with_,
)
from gripline.sources import driver_tables as D
from gripline.sources import sinks
from gripline.sources.session import settle

WIDTH, HEIGHT = 320, 180


def _video_info(frames):
    return frames.groupBy(KEY).agg(F.lit(WIDTH).alias("width"), F.lit(HEIGHT).alias("height"))


def _seen(spark, folder):
    """Frames with future trace, annotated trace and nearest camera."""
    indexed = D.with_gt_trace(D.frames(spark, folder)).select(KEY, "frame_index", "step", "n_steps", "x", "y", "z", "gt_trace")
    seen = TR.nearest_camera(indexed, D.cameras(indexed.select(KEY).distinct()))
    return S.future_trace(seen).drop("blk")


def _flat_uv(rows, trace):
    return rows.select(KEY, "frame_index", F.posexplode(trace).alias("idx", "p")).select(KEY, "frame_index", "idx", F.col("p")["u"].alias("u"), F.col("p")["v"].alias("v"))


BASE = (FRAMES, TRACES, PROJECTED)


@query("nearest_camera", with_(FRAMES, TRACES, PROJECTED) + "select episode_id, frame_index, c.cam_pos as cam_pos, round(cast(c.tz as double), 6) + 0.0 as tz from cam_of")
def nearest_camera(spark, folder):
    return _seen(spark, folder).select(KEY, "frame_index", "cam_pos", F.get("camera", 11).alias("tz"))


@query("project_camera", with_(*BASE) + "select episode_id, frame_index, idx, " + six("u", "v") + " from projected")
def project_camera(spark, folder):
    """Traces through the nearest camera; points behind it stay in place as null."""
    return _flat_uv(TR.with_projection(_seen(spark, folder)), "trace_2d")


@query("visible_ratio", with_(*BASE, VISIBLE) + "select episode_id, points, inside, round(coalesce(inside::double / nullif(points, 0), 0.0), 6) + 0.0 as visible_ratio from visible")
def visible_ratio(spark, folder):
    return TR.visible_ratio(TR.with_projection(_seen(spark, folder)), width=F.lit(WIDTH), height=F.lit(HEIGHT)).drop("n_steps")


@query("zip_traces", with_(*BASE, PAIRS) + "select episode_id, frame_index, idx, " + six("x", "y", "z", "gu", "gv") + " from pair_pts")
def zip_traces(spark, folder):
    return TR.trace_pairs(_seen(spark, folder)).withColumnsRenamed({"u": "gu", "v": "gv"})


COEFFICIENTS = ["a_xu", "a_yu", "a_zu", "a_1u", "a_xv", "a_yv", "a_zv", "a_1v"]


@query("fit_affine", with_(*BASE, PAIRS, FIT) + "select episode_id, pair_count, " + six(*COEFFICIENTS) + " from fit")
def fit_affine(spark, folder):
    return TR.fit_affine(TR.trace_pairs(_seen(spark, folder)))


@query(
    "apply_affine",
    with_(*BASE, PAIRS, FIT)
    + "select episode_id, frame_index, idx, round(x * a_xu + y * a_yu + z * a_zu + a_1u, 6) + 0.0 as u, round(x * a_xv + y * a_yv + z * a_zv + a_1v, 6) + 0.0 as v from future left join fit using (episode_id)",
)
def apply_affine(spark, folder):
    rows = _seen(spark, folder)
    fits = rows.groupBy(KEY).agg(F.max("n_steps").alias("n_steps")).join(TR.fit_affine(TR.trace_pairs(rows)), KEY, "left")
    return _flat_uv(attach_episode(rows, fits).withColumn("fitted", TR.apply_affine("future_trace")), "fitted")


def _predicted(spark, folder):
    return TR.project_episodes(_seen(spark, folder), _video_info(D.raw_frames(spark, folder)))


CHOICE = (*BASE, PAIRS, FIT, VISIBLE, CHOSEN)
LABEL = "case when use_fit then 'fit_from_gt(da3_visible=' || printf('%.2f', visible_ratio) || ')' else 'da3' end"


@query("choose_projection", with_(*CHOICE) + f"select episode_id, use_fit, {LABEL} as projection_label, round(visible_ratio, 6) + 0.0 as visible_ratio from chosen")
def choose_projection(spark, folder):
    rows = _predicted(spark, folder)
    return rows.groupBy(KEY).agg(F.max("use_fit").alias("use_fit"), F.max("projection_label").alias("projection_label"), F.max("visible_ratio").alias("visible_ratio"))


@query(
    "trace_error",
    with_(*CHOICE)
    + "select f.episode_id, f.frame_index, coalesce(point_count, 0) as point_count, " + six("mean_l2_px", "endpoint_l2_px") + " from frames f left join frame_errors using (episode_id, frame_index)",
)
def trace_error(spark, folder):
    rows = _predicted(spark, folder)
    return TR.with_trace_error(rows).select(KEY, "frame_index", "point_count", "mean_l2_px", "endpoint_l2_px")


TRACE_SUMMARY = f"""summary as (
  select c.episode_id, {LABEL} as projection_label, visible_ratio, (select count(distinct frame_index) from gt_points g where g.episode_id = c.episode_id) as frames_with_gt_trace,
    e.mean_trace_l2_px, e.mean_endpoint_l2_px
  from chosen c left join (select episode_id, avg(mean_l2_px) as mean_trace_l2_px, avg(endpoint_l2_px) as mean_endpoint_l2_px from frame_errors group by 1) e using (episode_id))"""

SUMMARY_COLUMNS = six("visible_ratio", "frames_with_gt_trace", "mean_trace_l2_px", "mean_endpoint_l2_px")


@query(
    "trace_summary",
    with_(*CHOICE, TRACE_SUMMARY)
    + f"select cast(episode_id as varchar) as episode_id, projection_label, {SUMMARY_COLUMNS} from summary union all by name select 'MEAN' as episode_id, cast(null as varchar) as projection_label, "
    + ", ".join(f"round(avg({c}), 6) + 0.0 as {c}" for c in ("visible_ratio", "frames_with_gt_trace", "mean_trace_l2_px", "mean_endpoint_l2_px"))
    + " from summary",
)
def trace_summary(spark, folder):
    """Projection errors of every episode and their mean."""
    return TR.with_mean_row(TR.trace_summary(_predicted(spark, folder)))


# --- pinhole, transforms, boxes -------------------------------------------------------------------
PIXEL_ROWS = with_(FRAMES, FIVE, PIXELS, QUALITY)


def _pixels(spark, folder):
    frames = D.frames(spark, folder)
    episodes = frames.groupBy(KEY).agg(F.max("n_steps").alias("n_steps"))
    camera = episodes.join(D.calibration(episodes), KEY, "left")
    return DP.contact_point(attach_episode(frames, camera).drop("blk"))


@query("project_pinhole", PIXEL_ROWS + "select episode_id, frame_index, " + six("u", "v") + " from pixels")
def project_pinhole(spark, folder):
    return _pixels(spark, folder).select(KEY, "frame_index", "u", "v")


@query("transform_points", with_(FRAMES) + "select episode_id, frame_index, round(0.8 * x - 0.6 * y + 0.05, 6) + 0.0 as wx, round(0.6 * x + 0.8 * y - 0.1, 6) + 0.0 as wy, round(z + 0.4, 6) + 0.0 as wz from frames")
def transform_points(spark, folder):
    moved = G.transform_point(D.matrix(D.T_MATRIX), F.col("x"), F.col("y"), F.col("z"))
    return D.frames(spark, folder).select(KEY, "frame_index", *[c.alias(f"w{a}") for a, c in zip("xyz", moved)])


@query(
    "affordance_box",
    PIXEL_ROWS
    + "select episode_id, frame_index, case when pu is null then 0 else 4 end as size, greatest(pu - 20, case when pu is not null then 0 end) as x1, greatest(pv - 20, case when pv is not null then 0 end) as y1, pu + 20 as x2, pv + 20 as y2 from scored",
)
def affordance_box(spark, folder):
    box = G.affordance_box(F.col("pu"), F.col("pv"))
    rows = _pixels(spark, folder).withColumn("box", box)
    return rows.select(KEY, "frame_index", F.size("box").alias("size"), *[F.get("box", i).alias(n) for i, n in enumerate(("x1", "y1", "x2", "y2"))])


@query("contact_point", PIXEL_ROWS + ", firsts as (select episode_id, min(frame_index) as frame_index from scored where phase = 'contact' group by 1) select episode_id, frame_index, round(x, 6) + 0.0 as x, round(y, 6) + 0.0 as y, round(z, 6) + 0.0 as z, pu as u, pv as v from firsts join scored using (episode_id, frame_index)")
def contact_point(spark, folder):
    """Position and pixel at the first contact frame of each episode."""
    from gripline.operators.evaluate import contact_pose
    from gripline.operators.phases import first_contact

    episodes = D.instructions(spark, folder)
    rows = A.geometry(D.frames(spark, folder), episodes, D.calibration(episodes))
    found = contact_pose(rows, first_contact(rows), ["x", "y", "z", "pixel"])
    return found.select(KEY, "frame_index", "x", "y", "z", F.col("pixel")["u"].alias("u"), F.col("pixel")["v"].alias("v"))


@query(
    "trace_2d",
    with_(FRAMES)
    + """, smoothed as (
      select episode_id, frame_index, n_steps,
        case when frame_index < 2 or frame_index > n_steps - 3 then x else (-3 * lag(x, 2) over w + 12 * lag(x) over w + 17 * x + 12 * lead(x) over w - 3 * lead(x, 2) over w) / 35 end as x,
        case when frame_index < 2 or frame_index > n_steps - 3 then y else (-3 * lag(y, 2) over w + 12 * lag(y) over w + 17 * y + 12 * lead(y) over w - 3 * lead(y, 2) over w) / 35 end as y,
        case when frame_index < 2 or frame_index > n_steps - 3 then z else (-3 * lag(z, 2) over w + 12 * lag(z) over w + 17 * z + 12 * lead(z) over w - 3 * lead(z, 2) over w) / 35 end as z
      from frames window w as (partition by episode_id order by frame_index)),
    around as (
      select a.episode_id, a.frame_index, b.frame_index - greatest(a.frame_index - 10, 0) as idx, b.x, b.y, b.z
      from frames a join smoothed b on b.episode_id = a.episode_id and b.frame_index between a.frame_index - 10 and a.frame_index + 20)
    select episode_id, frame_index, idx, case when z + 0.5 > 1e-6 then round(300.0 * (x / (z + 0.5)) + 160.0, 6) + 0.0 end as u,
      case when z + 0.5 > 1e-6 then round(290.0 * (y / (z + 0.5)) + 90.0, 6) + 0.0 end as v from around""",
)
def trace_2d(spark, folder):
    """Smoothed traces through one fixed camera."""
    e = D.matrix(((1, 0, 0, 0), (0, 1, 0, 0), (0, 0, 1, 0.5)))
    return _flat_uv(S.smoothed_trace_2d(D.frames(spark, folder), G.camera_rows(D.matrix(D.K_MATRIX), e)), "trace_2d")


# --- depth -----------------------------------------------------------------------------------------
# every frame that has pixels counts as a contact frame here, with the pinhole pixel of its pose; every episode has a camera
DEPTH_BASE = with_(FRAMES, LINES, MASKS, DEPTH) + """, cam as (
  select *, case when episode_id % 2 = 0 then 0.8 * x - 0.6 * y + 0.05 else x + 0.1 end as cx, case when episode_id % 2 = 0 then 0.6 * x + 0.8 * y - 0.1 else y - 0.2 end as cy,
    case when episode_id % 2 = 0 then z + 0.4 else z + 0.7 end as cz from frames),
contacts as (
  select episode_id, frame_index, x as contact_x, y as contact_y, z as contact_z, cast(trunc((300.0 * cx + 160.0 * cz) / cz) as bigint) as pu, cast(trunc((290.0 * cy + 90.0 * cz) / cz) as bigint) as pv
  from cam where cz > 0),
lifted as (
  select *, (x - 160.0) / 300.0 * depth_m - case when episode_id % 2 = 0 then 0.05 else 0.1 end as q0, (y - 90.0) / 290.0 * depth_m + case when episode_id % 2 = 0 then 0.1 else 0.2 end as q1,
    depth_m - case when episode_id % 2 = 0 then 0.4 else 0.7 end as q2 from depth_px),
points as (select *, case when episode_id % 2 = 0 then 0.8 * q0 + 0.6 * q1 else q0 end as px, case when episode_id % 2 = 0 then -0.6 * q0 + 0.8 * q1 else q1 end as py, q2 as pz from lifted),
near as (
  select p.*, row_number() over (partition by p.episode_id, p.frame_index order by (p.x - pu) ** 2 + (p.y - pv) ** 2, p.y, p.x) as rank
  from points p join contacts c using (episode_id, frame_index)),
patch as (select * from near where rank <= 32)"""


def _contacts(spark, folder, cameras=D.rigs):
    """Every frame with its pixel, which is null behind the camera."""
    frames = D.frames(spark, folder).select(KEY, "frame_index", "step", "n_steps", "x", "y", "z")
    episodes = frames.groupBy(KEY).agg(F.max("n_steps").alias("n_steps"))
    camera = episodes.join(cameras(episodes), KEY, "left")
    return settle(DP.contact_point(attach_episode(frames, camera).drop("blk")).drop("x", "y", "z", "n_steps"))


@query("contact_patch", DEPTH_BASE + "select episode_id, frame_index, rank, x, y, " + six("px", "py", "pz") + " from patch")
def contact_patch(spark, folder):
    return DP.contact_patch(_contacts(spark, folder), D.depth_pixels(spark, folder), D.mask_pixels(spark, folder)).drop("T", "step")


# all frames with the cameras of even episodes only: without a camera or a pixel the error is -1
CALIBRATED = with_(FRAMES, FIVE, PIXELS, LINES, MASKS, DEPTH) + """, asked as (
  select episode_id, frame_index, x as contact_x, y as contact_y, z as contact_z, cast(trunc(u) as bigint) as pu, cast(trunc(v) as bigint) as pv from pixels),
lifted as (
  select *, (x - 160.0) / 300.0 * depth_m - 0.05 as q0, (y - 90.0) / 290.0 * depth_m + 0.1 as q1, depth_m - 0.4 as q2 from depth_px where episode_id % 2 = 0),
points as (select *, 0.8 * q0 + 0.6 * q1 as px, -0.6 * q0 + 0.8 * q1 as py, q2 as pz from lifted),
errors as (
  select a.*, coalesce(sqrt((contact_x - px) ** 2 + (contact_y - py) ** 2 + (contact_z - pz) ** 2) * 1000, -1.0) as mm
  from asked a left join points p on p.episode_id = a.episode_id and p.frame_index = a.frame_index and p.x = pu and p.y = pv)"""


@query("deprojection_error", CALIBRATED + "select episode_id, frame_index, round(mm, 6) + 0.0 as deprojection_err_mm from errors")
def deprojection_error(spark, folder):
    """Of every frame: -1 where there is no camera, no pixel or no depth."""
    rows = DP.deprojection_error(_contacts(spark, folder, D.calibration), D.depth_pixels(spark, folder))
    return rows.select(KEY, "frame_index", "deprojection_err_mm")


@query("depth_patch", DEPTH_BASE + 'select p.episode_id, p.frame_index, p.y - pv + 16 as "row", p.x - pu + 16 as col, round(depth_m, 6) + 0.0 as depth_m from points p join contacts using (episode_id, frame_index) where p.x >= pu - 16 and p.x < pu + 16 and p.y >= pv - 16 and p.y < pv + 16')
def depth_patch(spark, folder):
    return DP.depth_patch(_contacts(spark, folder), D.depth_pixels(spark, folder)).drop("step")


@query(
    "surface_normal",
    # the direction is checked by what defines it: unit length, turned to the camera, and the spread along it
    # equal to the smallest root of the characteristic cubic, found here by bisection
    DEPTH_BASE
    + """, cov as (select episode_id, frame_index, count(*) as points, var_pop(px) as a, covar_pop(px, py) as b, covar_pop(px, pz) as c, var_pop(py) as d, covar_pop(py, pz) as e, var_pop(pz) as f from patch group by 1, 2),
    bis as (select *, 0 as it, cast(0 as double) as lo, least(a, d, f) as hi from cov
      union all
      select episode_id, frame_index, points, a, b, c, d, e, f, it + 1,
        case when (a - (lo + hi) / 2) * ((d - (lo + hi) / 2) * (f - (lo + hi) / 2) - e * e) - b * (b * (f - (lo + hi) / 2) - c * e) + c * (b * e - c * (d - (lo + hi) / 2)) > 0
          and (a - (lo + hi) / 2) * (d - (lo + hi) / 2) - b * b > 0 then (lo + hi) / 2 else lo end,
        case when (a - (lo + hi) / 2) * ((d - (lo + hi) / 2) * (f - (lo + hi) / 2) - e * e) - b * (b * (f - (lo + hi) / 2) - c * e) + c * (b * e - c * (d - (lo + hi) / 2)) > 0
          and (a - (lo + hi) / 2) * (d - (lo + hi) / 2) - b * b > 0 then hi else (lo + hi) / 2 end
      from bis where it < 60)
    select episode_id, frame_index, points, true as defined, cast(1.0 as double) as length, true as toward_camera, round((lo + hi) / 2, 6) + 0.0 as spread from bis where it = 60""",
)
def surface_normal(spark, folder):
    patch = DP.contact_patch(_contacts(spark, folder), D.depth_pixels(spark, folder), D.mask_pixels(spark, folder))
    # the points come with the normal, in one list of at most 32
    listed = DP.patch_summary(patch).withColumn("p", F.explode("xyz"))
    rows = listed.select("*", *[F.get("p", i).alias(f"p{a}") for i, a in enumerate("xyz")])
    along = sum((F.col(f"n{a}") * F.col(f"p{a}") for a in "yz"), F.col("nx") * F.col("px"))
    # the cameras of even and odd episodes, -R^T t
    even, odd = (-(0.8 * 0.05 + 0.6 * -0.1), -(-0.6 * 0.05 + 0.8 * -0.1), -0.4), (-0.1, 0.2, -0.7)
    at = [F.when(F.col(KEY) % 2 == 0, e).otherwise(o) for e, o in zip(even, odd)]
    to_camera = sum((F.col(f"n{a}") * c for a, c in zip("yz", at[1:])), F.col("nx") * at[0])
    seen = rows.groupBy(KEY, "frame_index", "step").agg(
        F.max("points").alias("points"),
        F.max(F.col("nx").isNotNull()).alias("defined"),
        F.max(F.sqrt(F.col("nx") * F.col("nx") + F.col("ny") * F.col("ny") + F.col("nz") * F.col("nz"))).alias("length"),
        (F.max(to_camera) - F.avg(along) >= 0).alias("toward_camera"),
        F.var_pop(along).alias("spread"),
    )
    return seen.drop("step")


@query("point_cloud", DEPTH_BASE + ", spread as (select *, row_number() over (partition by episode_id, frame_index order by (x * 7919 + y * 104729) % 1000003, y, x) as r from points) select episode_id, frame_index, x, y, " + six("px", "py", "pz") + " from spread where r <= 8192")
def point_cloud(spark, folder):
    """Clouds of all frames with depth."""
    depth = D.depth_pixels(spark, folder)
    return DP.point_cloud(depth, D.rigs(depth.select(KEY).distinct()))


@query("thinned_cloud", DEPTH_BASE + ", spread as (select *, row_number() over (partition by episode_id, frame_index order by (x * 7919 + y * 104729) % 1000003, y, x) as r from points) select episode_id, frame_index, x, y, " + six("px", "py", "pz") + " from spread where r <= 24")
def thinned_cloud(spark, folder):
    """Clouds thinned to 24 points per frame."""
    depth = D.depth_pixels(spark, folder)
    return DP.point_cloud(depth, D.rigs(depth.select(KEY).distinct()), max_points=24)


# --- annotation records ------------------------------------------------------------------------------
def _annotated(spark, folder, fields=False):
    """(annotated frames, episodes), with depth and masks."""
    episodes = D.instructions(spark, folder)
    depth, mask = D.depth_pixels(spark, folder), D.mask_pixels(spark, folder)
    return A.annotated_rows(D.frames(spark, folder), episodes, D.calibration(episodes), depth, mask, fields=fields), episodes


FLOW = (FRAMES, FIVE, PIXELS, LINES, MASKS, DEPTH, QUALITY_3D)
RECORDS = with_(*FLOW, INSTRUCTIONS)
SUBTASK = "case when phase in ('approach', 'stabilize') then 'reach toward the ' || task_object when phase = 'contact' then task_verb || ' the ' || task_object else 'return to home position' end"


@query("language_tags", with_(INSTRUCTIONS) + "select episode_id, task_verb, task_object, task_category, requires_precision, language_quality, 'reach toward the ' || task_object as s0, task_verb || ' the ' || task_object as s1, 'return to home position' as s2 from tags")
def language(spark, folder):
    rows = language_tags(D.instructions(spark, folder))
    seq = [F.get("subtask_sequence", i).alias(f"s{i}") for i in range(3)]
    return rows.select(KEY, "task_verb", "task_object", "task_category", "requires_precision", "language_quality", *seq)


@query("subtask_of_phase", RECORDS + f"select episode_id, frame_index, phase, {SUBTASK} as subtask from scored join tags using (episode_id)")
def subtask_of_phase(spark, folder):
    return A.frame_records(*_annotated(spark, folder, fields=True)).select(KEY, "frame_index", "phase", "subtask")


@query("frame_confidence", CALIBRATED + """, near as (
    select p.episode_id, p.frame_index, row_number() over (partition by p.episode_id, p.frame_index order by (p.x - pu) ** 2 + (p.y - pv) ** 2, p.y, p.x) as rank
    from points p join asked a using (episode_id, frame_index) where pu is not null),
  size as (select episode_id, frame_index, count(*) as patch_points from near where rank <= 32 group by 1, 2),
  conf as (select e.episode_id, e.frame_index, case when pu is null then 0.0 else 0.35 + 0.25 end + 0.25 * (case when coalesce(patch_points, 0) >= 10 then 1.0 else 0.5 end)
    + 0.15 * (case when mm < 0 then 1.0 else greatest(0.0, 1 - mm / 50) end) as annotation_confidence from errors e left join size using (episode_id, frame_index))
  select episode_id, frame_index, round(annotation_confidence, 6) + 0.0 as annotation_confidence, annotation_confidence >= 0.6 as annotation_valid from conf""")
def frame_confidence(spark, folder):
    """Confidence of every frame, with patch size and depth error taken from depth pixels."""
    contacts, depth, mask = _contacts(spark, folder, D.calibration), D.depth_pixels(spark, folder), D.mask_pixels(spark, folder)
    points = DP.contact_patch(contacts.where("K is not null"), depth, mask).groupBy(KEY, "step").agg(F.count(F.lit(1)).alias("n"))
    rows = DP.deprojection_error(contacts, depth).join(points, [KEY, "step"], "left")
    seen = F.col("pu").isNotNull()
    confidence = Q.frame_confidence(seen, seen, F.coalesce("n", F.lit(0)), F.col("deprojection_err_mm"))
    scored = rows.withColumn("annotation_confidence", confidence)
    return scored.select(KEY, "frame_index", "annotation_confidence", Q.is_valid(F.col("annotation_confidence")).alias("annotation_valid"))


QUALITY_ROWS = """per as (
  select episode_id, coalesce(avg(case when phase = 'contact' then annotation_confidence end), 0.0) as depth_quality, avg(phase_confidence) as phase_det_confidence,
    count(*) as num_frames, count(case when annotation_confidence >= 0.6 then 1 end) as num_valid_frames from scored group by 1),
mixed as (select p.*, t.* exclude (episode_id), 0.4 * depth_quality + 0.3 * language_quality + 0.3 * phase_det_confidence as annotation_quality from per p join tags t using (episode_id))"""

MEANS = ("depth_quality", "language_quality", "phase_det_confidence", "annotation_quality")
#: Means to nine places before they are cut to six, so that the order of a sum does not decide a tie.
STEADY = ", ".join(f"round(round(cast({c} as double), 9), 6) + 0.0 as {c}" for c in MEANS)
TRAJECTORY = f"select episode_id, task_verb, task_object, task_category, requires_precision, {STEADY}, num_frames, num_valid_frames from mixed"


def _steady(rows):
    return rows.withColumns({c: F.round(c, 9) for c in MEANS})


@query("trajectory_quality", with_(*FLOW, INSTRUCTIONS, QUALITY_ROWS) + "select episode_id, " + STEADY + " from mixed")
def trajectory_quality(spark, folder):
    return _steady(A.trajectory_records(*_annotated(spark, folder))).select(KEY, *MEANS)


@query("valid_frame_count", with_(FRAMES, FIVE, PIXELS, QUALITY) + "select episode_id, count(*) as num_frames, count(case when annotation_confidence >= 0.6 then 1 end) as num_valid_frames from scored group by 1")
def valid_frame_count(spark, folder):
    rows = _pixels(spark, folder)
    boxed = A.with_quality(
        rows.withColumn("affordance_box_2d", G.affordance_box(F.col("pu"), F.col("pv")))
        .withColumn("contact_point_2d", F.when(F.col("pu").isNotNull(), F.array("pu", "pv")).otherwise(F.array().cast("array<bigint>")))
        .withColumn("patch_points", F.lit(0))
        .withColumn("deprojection_err_mm", F.lit(-1.0))
    )
    return boxed.groupBy(KEY).agg(*Q.valid_counts())


FRAME_SELECT = f"""select episode_id, frame_index, phase, round(phase_confidence, 6) + 0.0 as phase_confidence, {SUBTASK} as subtask, coalesce(pu - 20, -1) as box_x1_raw, pu as u, pv as v,
  round(x, 6) + 0.0 as x, round(y, 6) + 0.0 as y, round(z, 6) + 0.0 as z, round(deprojection_err_mm, 6) + 0.0 as deprojection_err_mm, round(annotation_confidence, 6) + 0.0 as annotation_confidence, annotation_confidence >= 0.6 as annotation_valid,
  patch_points, round(patch_x, 6) + 0.0 as patch_x, round(patch_y, 6) + 0.0 as patch_y, round(patch_z, 6) + 0.0 as patch_z, case when patch_points > 3 then 3 else 0 end as normal_axes, crop_cells, round(crop_depth, 6) + 0.0 as crop_depth,
  least(frame_index + 1, 10) as trace_3d_points, cast((select count(*) from scored b where b.episode_id = scored.episode_id and b.frame_index between scored.frame_index - 4 and scored.frame_index and b.u is not null) as bigint) as trace_2d_points
  from scored join tags using (episode_id)"""


def _flat_frames(rows):
    at = lambda c, i: F.get(c, i)
    cells = F.filter(F.flatten("depth_patch_32x32"), lambda d: d.isNotNull())
    total = lambda i: F.when(F.size("contact_patch_xyz") > 0, F.aggregate("contact_patch_xyz", F.lit(0.0), lambda s, p: s + F.get(p, i)))
    return rows.select(
        KEY,
        "frame_index",
        "phase",
        "phase_confidence",
        "subtask",
        F.coalesce(at("affordance_box_2d", 2) - 40, F.lit(-1)).alias("box_x1_raw"),
        at("contact_point_2d", 0).alias("u"),
        at("contact_point_2d", 1).alias("v"),
        *[at("contact_point_3d", i).alias(a) for i, a in enumerate("xyz")],
        "deprojection_err_mm",
        "annotation_confidence",
        "annotation_valid",
        F.size("contact_patch_xyz").alias("patch_points"),
        *[total(i).alias(f"patch_{a}") for i, a in enumerate("xyz")],
        F.size("surface_normal").alias("normal_axes"),
        F.size(cells).alias("crop_cells"),
        F.when(F.size(cells) > 0, F.aggregate(cells, F.lit(0.0), lambda s, d: s + d)).alias("crop_depth"),
        F.size("ee_trace_3d").alias("trace_3d_points"),
        F.size("ee_trace_2d").alias("trace_2d_points"),
    )


@query("export_frames", RECORDS + FRAME_SELECT)
def export_frames(spark, folder):
    """Frame records of every episode, nested fields flattened for comparison."""
    return _flat_frames(A.frame_records(*_annotated(spark, folder, fields=True)))


@query("merge_annotations", with_(FRAMES, FIVE, PIXELS, QUALITY) + "select episode_id, frame_index // 2 as frame_index, frame_index as step, phase, pu as u, pv as v, round(x, 6) + 0.0 as x, round(annotation_confidence, 6) + 0.0 as annotation_confidence, n_frames from (select s.*, count(*) over (partition by episode_id) as n_frames from scored s)")
def merge_annotations(spark, folder):
    """2D, 3D, quality and phase brought together from separate tables; every frame number occurs twice."""
    episodes = D.instructions(spark, folder)
    frames = D.frames(spark, folder)
    repeated = frames.withColumn("frame_index", F.floor(F.col("step") / 2))
    done = settle(A.with_quality(A.with_depth(A.geometry(repeated, episodes, D.calibration(episodes)), None)))
    part = lambda *columns: done.select(KEY, "step", *columns)
    phase = part("frame_index", "phase", F.col("n_steps").alias("n_frames"))
    two = part(F.col("pixel")["u"].alias("u"), F.col("pixel")["v"].alias("v"))
    return A.merge_annotations(phase, two, part("x"), part("annotation_confidence"))


@query("export_trajectory", with_(*FLOW, INSTRUCTIONS, QUALITY_ROWS) + TRAJECTORY)
def export_trajectory(spark, folder):
    return _steady(A.trajectory_records(*_annotated(spark, folder)))


@query(
    "export_nested",
    with_(*FLOW, INSTRUCTIONS, QUALITY_ROWS)
    + """select episode_id, 0 as section, cast(0 as bigint) as position, task_verb, num_frames, cast(null as bigint) as frame_index, cast(null as varchar) as phase, cast(null as bigint) as patch_points from mixed
    union all select episode_id, 1, frame_index, null, null, frame_index, phase, patch_points from scored
    union all select episode_id, 2, 0, null, null, null, null, null from mixed""",
)
def export_nested(spark, folder):
    """Documents of trajectory and ordered frames as lines, read again for comparison."""
    episodes = D.instructions(spark, folder)
    frames, trajectories = A.annotate(D.frames(spark, folder), episodes, D.calibration(episodes), D.depth_pixels(spark, folder), D.mask_pixels(spark, folder))
    rows = sinks.export_nested(frames, trajectories)
    head = F.from_json(F.when(F.col("section") == 0, F.concat("line", F.lit("]}"))), "trajectory struct<task_verb:string,num_frames:bigint>")["trajectory"]
    frame = F.from_json(F.when(F.col("section") == 1, F.ltrim(F.col("line"), F.lit(","))), "frame_index bigint, phase string, contact_patch_xyz array<array<double>>")
    seen = rows.withColumn("h", head).withColumn("f", frame)
    return seen.select(KEY, "section", "position", "h.*", "f.frame_index", "f.phase", F.when(F.col("section") == 1, F.size("f.contact_patch_xyz")).cast("bigint").alias("patch_points"))


@query("parse_trace", with_(FRAMES, TRACES) + "select episode_id, event_id, idx, gu as u, gv as v from gt_points")
def parse_trace(spark, folder):
    rows = D.raw_frames(spark, folder).select(KEY, "event_id", F.posexplode(X.parse_trace(F.col("trace_text"))).alias("idx", "p"))
    return rows.select(KEY, "event_id", "idx", F.get("p", 0).alias("u"), F.get("p", 1).alias("v"))
