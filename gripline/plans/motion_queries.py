"""Queries over frames: signals, phases, runs, evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from gripline.functions import text as X
from gripline.operators import documents as DC
from gripline.operators import evaluate as EV
from gripline.operators import phases as P
from gripline.operators import signals as S
from gripline.operators.blocks import KEY, index_frames, with_halo
from gripline.plans.registry import query, six
from gripline.plans.sql_parts import FIVE, FRAMES, LABELS, PHASED, PIXELS, RANGES, RAW, grasp_run, with_
from gripline.sources import driver_tables as D

DEFAULT = [(0.4, 0.9)]
SWEEP = list(EV.SWEEP)
BY = ["grasp_threshold", "contact_threshold"]

ONE = with_(FRAMES, grasp_run(DEFAULT), PHASED)


# --- order and signals ------------------------------------------------------------------------
@query("step_index", with_(RAW) + "select episode_id, event_id as frame_index, row_number() over (partition by episode_id order by event_id) - 1 as step, count(*) over (partition by episode_id) as n_steps from raw")
def step_index(spark, folder):
    """Position of every frame in its episode, from sparse frame numbers."""
    raw = D.raw_frames(spark, folder).select(KEY, F.col("event_id").alias("frame_index"))
    return index_frames(raw, span=D.EVENT_SPAN)


@query(
    "ee_velocity",
    with_(FRAMES)
    + "select episode_id, frame_index, round(coalesce(sqrt((x - lag(x) over w) ** 2 + (y - lag(y) over w) ** 2 + (z - lag(z) over w) ** 2), 0.0), 6) + 0.0 as ee_velocity from frames window w as (partition by episode_id order by frame_index)",
)
def ee_velocity(spark, folder):
    return S.with_signals(D.frames(spark, folder)).select(KEY, "frame_index", "ee_velocity")


@query(
    "gripper_delta",
    with_(FRAMES)
    + "select episode_id, frame_index, round(coalesce(gripper - lag(gripper) over (partition by episode_id order by frame_index), 0.0), 6) + 0.0 as gripper_delta from frames",
)
def gripper_delta(spark, folder):
    return S.with_signals(D.frames(spark, folder)).select(KEY, "frame_index", "gripper_delta")


@query(
    "gripper_norm",
    with_(FRAMES)
    + "select episode_id, frame_index, round((gripper - gripper_min) / (gripper_max - gripper_min + 1e-8), 6) + 0.0 as norm_signals, round((gripper - gripper_min) / (gripper_max - gripper_min + 1e-6), 6) + 0.0 as norm_grasp from frames",
)
def gripper_norm(spark, folder):
    """Both normalisations in use; they differ in the guard only."""
    return D.frames(spark, folder).select(
        KEY, "frame_index", S.gripper_norm(S.EPS_SIGNALS).alias("norm_signals"), S.gripper_norm(S.EPS_GRASP).alias("norm_grasp")
    )


@query("gripper_range", "select user_id as episode_id, min(cast(cast(floor(value) as bigint) % 10 as double)) as gripper_min, max(cast(cast(floor(value) as bigint) % 10 as double)) as gripper_max from events group by 1")
def gripper_range(spark, folder):
    return D.raw_frames(spark, folder).groupBy(KEY).agg(F.min("gripper").alias("gripper_min"), F.max("gripper").alias("gripper_max"))


# --- phases -------------------------------------------------------------------------------------
@query("grasp_phases", ONE + "select episode_id, frame_index, phase from phased")
def grasp_phases(spark, folder):
    return P.grasp_phases(D.frames(spark, folder)).select(KEY, "frame_index", "phase")


@query("phase_ranges", with_(FRAMES, grasp_run(DEFAULT), PHASED, RANGES) + "select * from ranges")
def phase_ranges(spark, folder):
    return P.phase_ranges(P.grasp_phases(D.frames(spark, folder)))


@query(
    "phase_ranges_nested",
    with_(FRAMES, grasp_run(DEFAULT), PHASED, RANGES)
    + """, names(phase) as (select unnest(['pre_grasp', 'immobilization', 'contact', 'detach', 'post_grasp', 'transition'])),
    slots as (select episode_id, phase from (select distinct episode_id from frames), names)
    select s.episode_id, 0 as part, s.phase, count(r.start_step) as ranges, coalesce(string_agg(start_step || '-' || end_step, ' ' order by range_index), '') as listed
    from slots s left join ranges r using (episode_id, phase) group by all""",
)
def phase_ranges_nested(spark, folder):
    """The nested form, one row per phase name for comparison."""
    nested = P.ranges_nested(P.phase_ranges(P.grasp_phases(D.frames(spark, folder))))
    rows = nested.select(KEY, "part", F.explode("phase_ranges").alias("phase", "r"))
    shown = F.transform("r", lambda p: F.concat_ws("-", p.cast("array<string>")))
    return rows.select(KEY, "part", "phase", F.size("r").alias("ranges"), F.array_join(shown, " ").alias("listed"))


@query(
    "phase_documents",
    with_(FRAMES, LABELS, grasp_run(DEFAULT), PHASED, RANGES)
    + """, firsts as (select episode_id, min(frame_index) as contact_frame from phased where phase = 'contact' group by 1),
    names(name, part) as (values ('pre_grasp', 0), ('immobilization', 1), ('contact', 2), ('detach', 3), ('post_grasp', 4), ('transition', 5)),
    episodes as (select episode_id, count(*) as n, min(gripper) as low, max(gripper) as high from frames group by 1),
    heads as (select e.*, contact_frame, gt_contact_frame, f.x, f.z - 0.1 as tcp_z, f.gripper, (f.gripper - low) / (high - low + 1e-6) as norm
      from episodes e left join firsts using (episode_id) left join contact_labels using (episode_id) left join frames f on f.episode_id = e.episode_id and f.frame_index = contact_frame),
    opened as (select episode_id, part, name from episodes, names)
    select episode_id, 0 as section, 0 as part, cast(0 as bigint) as position, cast(null as varchar) as text, n as a, contact_frame as b, gt_contact_frame as c, round(x, 6) + 0.0 as d, round(tcp_z, 6) + 0.0 as e, gripper as f, round(norm, 6) + 0.0 as g from heads
    union all select episode_id, 1, part, -1, case when part > 0 then ',' else '' end || '"' || name || '":[', null, null, null, null, null, null, null from opened
    union all select episode_id, 1, part, 4611686018427387904, ']', null, null, null, null, null, null, null from opened
    union all select episode_id, 1, part, range_index, case when range_index > 0 then ',' else '' end || '[' || start_step || ',' || end_step || ']', null, null, null, null, null, null, null from ranges join names on phase = name
    union all select episode_id, 2, 0, -1, '},"phases":[', null, null, null, null, null, null, null from episodes
    union all select episode_id, 2, 0, start_step, case when start_step > 0 then ',' else '' end || '{"start_step":' || start_step || ',"end_step":' || end_step || ',"phase":"' || phase || '"}', null, null, null, null, null, null, null from ranges
    union all select episode_id, 3, 0, -1, '],"frames":[', null, null, null, null, null, null, null from episodes
    union all select p.episode_id, 3, 0, p.frame_index, phase, p.frame_index, p.frame_index, null, null, null, gripper, round((gripper - gripper_min) / (gripper_max - gripper_min + 1e-6), 6) + 0.0 from phased p join frames using (episode_id, frame_index)
    union all select episode_id, 4, 0, 0, ']}', null, null, null, null, null, null, null from episodes""",
)
def phase_documents(spark, folder):
    """Phase documents as ordered lines; heads and frames are read again for comparison."""
    indexed, labels = D.labelled_frames(spark, folder)
    rows = DC.phase_document(indexed, labels)
    section = F.col("section")
    pose = "contact_pose struct<gripper_pose6d:array<double>,tcp_pose6d:array<double>,gripper_position_raw:double,gripper_position_normalized:double>"
    head = F.from_json(F.when(section == 0, F.concat("line", F.lit("}}"))), f"parquet_frame_count bigint, first_contact_frame_index bigint, reference_annotation_contact_frame_index bigint, {pose}")
    entry = (section == 3) & (F.col("position") >= 0)
    frame = F.from_json(F.when(entry, F.ltrim(F.col("line"), F.lit(","))), "step_index bigint, frame_index bigint, robo2vlm_phase string, gripper_position_raw double, gripper_position_normalized double")
    seen = rows.withColumn("h", head).withColumn("fr", frame).withColumn("p", F.col("h")["contact_pose"])
    h, p, fr = F.col("h"), F.col("p"), F.col("fr")
    return seen.select(
        KEY,
        "section",
        "part",
        "position",
        F.when(section == 0, None).when(entry, fr["robo2vlm_phase"]).otherwise(F.col("line")).alias("text"),
        F.coalesce(h["parquet_frame_count"], fr["step_index"]).alias("a"),
        F.coalesce(h["first_contact_frame_index"], fr["frame_index"]).alias("b"),
        h["reference_annotation_contact_frame_index"].alias("c"),
        F.get(p["gripper_pose6d"], 0).alias("d"),
        F.get(p["tcp_pose6d"], 2).alias("e"),
        F.coalesce(p["gripper_position_raw"], fr["gripper_position_raw"]).alias("f"),
        F.coalesce(p["gripper_position_normalized"], fr["gripper_position_normalized"]).alias("g"),
    )


@query("first_contact", ONE + "select episode_id, min(case when phase = 'contact' then frame_index end) as contact_frame from phased group by 1")
def first_contact(spark, folder):
    return P.first_contact(P.grasp_phases(D.frames(spark, folder)))


@query(
    "phase_alias",
    ONE
    + "select episode_id, frame_index, case phase when 'pre_grasp' then 'pre-grasp' when 'immobilization' then 'approach' when 'post_grasp' then 'post-grasp' else replace(phase, '_', '-') end as phase, phase as robo2vlm_phase from phased",
)
def phase_alias(spark, folder):
    rows = P.grasp_phases(D.frames(spark, folder))
    return rows.select(KEY, "frame_index", X.phase_alias(F.col("phase")).alias("phase"), X.phase_alias(F.col("phase"), "robo2vlm").alias("robo2vlm_phase"))


FIVE_ROWS = with_(FRAMES, FIVE)


@query("five_phase_confidence", FIVE_ROWS + "select episode_id, frame_index, raw_phase, phase, round(phase_confidence, 6) + 0.0 as phase_confidence from five_phased")
def five_phase_confidence(spark, folder):
    return P.five_phases(D.frames(spark, folder)).select(KEY, "frame_index", "raw_phase", "phase", "phase_confidence")


@query(
    "smooth_phases",
    with_(FRAMES)
    + """, ahead as (select *, case cast(gripper as int) % 3 when 0 then 'A' when 1 then 'B' else 'C' end as ph from frames),
    seen as (select *, lead(ph) over (partition by episode_id order by frame_index) as nx from ahead),
    smooth as (select episode_id, frame_index, ph as smoothed from seen where frame_index = 0
      union all
      select a.episode_id, a.frame_index, case when a.nx is not null and a.ph <> o.smoothed and a.ph <> a.nx then o.smoothed else a.ph end
      from smooth o join seen a on a.episode_id = o.episode_id and a.frame_index = o.frame_index + 1)
    select episode_id, frame_index, smoothed from smooth""",
)
def smooth_phases(spark, folder):
    """A flickering three-letter series, smoothed."""
    kind = (F.col("gripper").cast("int") % 3).alias("k")
    rows = D.frames(spark, folder).select(KEY, "frame_index", "step", "n_steps", kind)
    named = rows.withColumn("phase", F.when(F.col("k") == 0, "A").when(F.col("k") == 1, "B").otherwise("C"))
    return P.smooth_phases(named).select(KEY, "frame_index", "smoothed")


@query("phase_mean_conf", FIVE_ROWS + "select episode_id, round(avg(phase_confidence), 6) + 0.0 as phase_det_confidence from five_phased group by 1")
def phase_mean_conf(spark, folder):
    return P.mean_confidence(P.five_phases(D.frames(spark, folder)))


@query(
    "clip_manifest",
    with_(FRAMES, grasp_run(DEFAULT), PHASED, RANGES)
    + """, rates as (select episode_id, case episode_id % 3 when 0 then 10.0 when 1 then 30000.0 / 1001.0 else 25.0 end as fps from frames group by episode_id),
    clips as (select r.*, fps, row_number() over (partition by r.episode_id order by list_position(['pre_grasp', 'immobilization', 'contact', 'detach', 'post_grasp'], phase), range_index) - 1 as clip,
      case phase when 'pre_grasp' then 'pre-grasp' when 'immobilization' then 'approach' when 'post_grasp' then 'post-grasp' else phase end as display
      from ranges r join rates using (episode_id))
    select episode_id, clip, display, phase, range_index, start_step as start_frame, end_step as end_frame, round(start_step / fps, 6) + 0.0 as start_seconds,
      round((end_step - start_step + 1) / fps, 6) + 0.0 as duration_seconds,
      lpad(clip::varchar, 2, '0') || '_' || display || '_frames_' || lpad(start_step::varchar, 6, '0') || '_' || lpad(end_step::varchar, 6, '0') || '.mp4' as path
    from clips""",
)
def clip_manifest(spark, folder):
    rows = P.grasp_phases(D.frames(spark, folder))
    text = F.when(F.col(KEY) % 3 == 0, "10/1").when(F.col(KEY) % 3 == 1, "30000/1001").otherwise("25")
    rates = D.table(spark, folder, "events").select(F.col("user_id").alias(KEY)).distinct().withColumn("fps", X.parse_fps(text))
    return P.clip_manifest(P.phase_ranges(rows), rates)


@query("parse_fps", "select o_orderkey, case o_orderkey % 4 when 0 then round((o_custkey + 1) / 7.0, 6) + 0.0 when 1 then cast(o_custkey as double) else null end as fps from orders")
def parse_fps(spark, folder):
    c, k = F.col("o_custkey"), F.col("o_orderkey")
    text = (
        F.when(k % 4 == 0, F.concat((c + 1).cast("string"), F.lit("/7")))
        .when(k % 4 == 1, c.cast("string"))
        .when(k % 4 == 2, F.concat(c.cast("string"), F.lit("/0")))
        .otherwise("none")
    )
    return D.table(spark, folder, "orders").select("o_orderkey", X.parse_fps(text).alias("fps"))


# the gripper is held at its highest reading for one to nine of every 40 frames
HELD = "case when frame_index % 40 between 20 and 20 + (episode_id + frame_index // 40) % 9 then gripper_max else gripper end"


@query(
    "stable_contact_frame",
    with_(FRAMES)
    + f""", n as (select *, ({HELD} - gripper_min) / (gripper_max - gripper_min + 1e-8) as g from frames),
    near as (select *, min(g) over w as low, count(*) over w as seen from n window w as (partition by episode_id order by frame_index rows between current row and 4 following)),
    onset as (select episode_id, min(case when seen = 5 and low >= 0.8 then frame_index end) as contact_step from near group by 1),
    fall as (select n.episode_id, min(case when frame_index > contact_step and g < 0.8 then frame_index end) as release_step from n join onset using (episode_id) group by 1)
    select episode_id, frame_index, contact_step, case when contact_step is null or frame_index < contact_step then 'pre' when release_step is null or frame_index < release_step then 'in' else 'post' end as contact_status
    from n join onset using (episode_id) join fall using (episode_id)""",
)
def stable_contact_frame(spark, folder):
    """The default window of five frames, on readings that are held for up to nine."""
    held = D.frames(spark, folder).withColumn("gripper", F.expr(HELD.replace("//", "div")))
    return S.stable_contact(held).select(KEY, "frame_index", "contact_step", "contact_status")


# --- traces by position --------------------------------------------------------------------------
def _flat(rows, trace):
    return rows.select(KEY, "frame_index", F.posexplode(trace).alias("idx", "p")).select(KEY, "frame_index", "idx", "p.*")


@query(
    "future_trace",
    with_(FRAMES)
    + "select a.episode_id, a.frame_index, b.frame_index - a.frame_index as idx, " + "round(b.x, 6) + 0.0 as x, round(b.y, 6) + 0.0 as y, round(b.z, 6) + 0.0 as z from frames a join frames b on a.episode_id = b.episode_id and b.frame_index between a.frame_index and a.frame_index + 9",
)
def future_trace(spark, folder):
    return _flat(S.future_trace(D.frames(spark, folder)), "future_trace")


PIXEL_ROWS = with_(FRAMES, FIVE, PIXELS)


@query(
    "past_trace_2d",
    PIXEL_ROWS
    + """, kept as (select a.episode_id, a.frame_index, b.frame_index as pos, cast(trunc(b.u) as bigint) as u, cast(trunc(b.v) as bigint) as v
      from pixels a join pixels b on a.episode_id = b.episode_id and b.frame_index between a.frame_index - 4 and a.frame_index where b.u is not null)
    select episode_id, frame_index, row_number() over (partition by episode_id, frame_index order by pos desc) - 1 as idx, u, v from kept""",
)
def past_trace_2d(spark, folder):
    from gripline.plans.annotate import geometry

    episodes = D.instructions(spark, folder)
    return _flat(geometry(D.frames(spark, folder), episodes, D.calibration(episodes)), "ee_trace_2d")


@query(
    "past_trace_3d",
    with_(FRAMES)
    + "select a.episode_id, a.frame_index, a.frame_index - b.frame_index as idx, round(b.x, 6) + 0.0 as x, round(b.y, 6) + 0.0 as y, round(b.z, 6) + 0.0 as z from frames a join frames b on a.episode_id = b.episode_id and b.frame_index between a.frame_index - 9 and a.frame_index",
)
def past_trace_3d(spark, folder):
    wide = with_halo(D.frames(spark, folder), before=9).withColumn("ee_trace_3d", S.past(S.point(), 10)).where("home")
    return _flat(wide, "ee_trace_3d")


SMOOTHED = """smoothed as (
  select episode_id, frame_index, n_steps,
    case when frame_index < 2 or frame_index > n_steps - 3 then x else (-3 * lag(x, 2) over w + 12 * lag(x) over w + 17 * x + 12 * lead(x) over w - 3 * lead(x, 2) over w) / 35 end as x,
    case when frame_index < 2 or frame_index > n_steps - 3 then y else (-3 * lag(y, 2) over w + 12 * lag(y) over w + 17 * y + 12 * lead(y) over w - 3 * lead(y, 2) over w) / 35 end as y,
    case when frame_index < 2 or frame_index > n_steps - 3 then z else (-3 * lag(z, 2) over w + 12 * lag(z) over w + 17 * z + 12 * lead(z) over w - 3 * lead(z, 2) over w) / 35 end as z
  from frames window w as (partition by episode_id order by frame_index)),
around as (
  select a.episode_id, a.frame_index, b.frame_index - greatest(a.frame_index - 10, 0) as idx, b.x, b.y, b.z
  from frames a join smoothed b on b.episode_id = a.episode_id and b.frame_index between a.frame_index - 10 and a.frame_index + 20)"""


@query("smoothed_trace_3d", with_(FRAMES, SMOOTHED) + "select episode_id, frame_index, idx, " + six("x", "y", "z") + " from around")
def smoothed_trace_3d(spark, folder):
    return _flat(S.smoothed_trace(D.frames(spark, folder)), "trace")


# --- frame choice ----------------------------------------------------------------------------------
@query(
    "uniform_frames",
    """with e as (select user_id as episode_id, min(event_id) as first_frame, max(event_id) as last_frame from events group by 1),
    picks as (select e.*, i from e, lateral (select unnest(range(12)) as i)),
    f as (select episode_id, case when i = 11 then last_frame else cast(floor(first_frame + i * ((last_frame - first_frame) / 11.0)) as bigint) end as frame_index from picks)
    select distinct episode_id, frame_index from f""",
)
def uniform_frames(spark, folder):
    e = D.table(spark, folder, "events").groupBy(F.col("user_id").alias(KEY)).agg(F.min("event_id").alias("first_frame"), F.max("event_id").alias("last_frame"))
    return S.uniform_frames(e, 12).select(KEY, "frame_index")


@query(
    "stride_frames",
    with_(FRAMES)
    + """, picked as (select *, row_number() over (partition by episode_id order by frame_index) - 1 as place, count(*) over (partition by episode_id) as total from frames where frame_index % 3 = 0 or frame_index = n_steps - 1),
    places as (select distinct total, case when i = 7 then total - 1 else cast(floor(i * ((total - 1) / 7.0)) as bigint) end as place from (select distinct total from picked), lateral (select unnest(range(8)) as i))
    select episode_id, frame_index from picked where total <= 8 or exists (select 1 from places p where p.total = picked.total and p.place = picked.place)""",
)
def stride_frames(spark, folder):
    return S.stride_frames(D.frames(spark, folder), stride=3, max_frames=8).select(KEY, "frame_index")


# --- evaluation --------------------------------------------------------------------------------------
def _errors(spark, folder, pairs):
    indexed, labels = D.labelled_frames(spark, folder)
    return EV.episode_errors(indexed, labels, pairs)


def errors_sql(pairs) -> str:
    return with_(FRAMES, LABELS, grasp_run(pairs)) + """, pred as (
      select episode_id, gt as grasp_threshold, ct as contact_threshold, min(case when st = 2 then frame_index end) as pred_contact_frame from machine group by 1, 2, 3),
    base as (select p.*, n_steps as num_frames, gripper_min, gripper_max, gt_contact_frame, aff from pred p
      join (select distinct episode_id, n_steps, gripper_min, gripper_max from frames) using (episode_id)
      left join contact_labels using (episode_id) left join affordance_labels using (episode_id)),
    errors as (
      select b.*, pred_contact_frame - gt_contact_frame as frame_error, abs(pred_contact_frame - gt_contact_frame) as abs_frame_error,
        abs(pred_contact_frame - gt_contact_frame) / num_frames as normalized_abs_frame_error,
        (f.x - aff[1]) ** 2 + (f.y - aff[2]) ** 2 + (f.z - 0.1 - aff[3]) ** 2 as pos2, (f.rx - aff[4]) ** 2 + (f.ry - aff[5]) ** 2 + (f.rz - aff[6]) ** 2 as rot2,
        sqrt((t.x - aff[1]) ** 2 + (t.y - aff[2]) ** 2 + (t.z - 0.1 - aff[3]) ** 2) as oracle_gt_tcp_position_l2_error
      from base b left join frames f on f.episode_id = b.episode_id and f.frame_index = b.pred_contact_frame
      left join frames t on t.episode_id = b.episode_id and t.frame_index = b.gt_contact_frame),
    scored as (select * exclude (pos2, rot2), sqrt(pos2) as tcp_position_l2_error, sqrt(rot2) as tcp_rotation_l2_error, sqrt(pos2 + rot2) as tcp_pose6d_l2_error from errors)
    """


EPISODE_SELECT = "select episode_id, grasp_threshold, contact_threshold, num_frames, gt_contact_frame, pred_contact_frame, frame_error, abs_frame_error, " + six(
    "normalized_abs_frame_error", "tcp_position_l2_error", "tcp_rotation_l2_error", "tcp_pose6d_l2_error", "oracle_gt_tcp_position_l2_error", "gripper_min", "gripper_max"
)

SUMMARY_SELECT = """select grasp_threshold, contact_threshold, count(*) as num_episodes, count(abs_frame_error) as num_with_gt_and_prediction,
    round(avg(abs_frame_error), 6) + 0.0 as mae_frames, round(sqrt(avg(frame_error * frame_error)), 6) + 0.0 as rmse_frames, round(avg(frame_error), 6) + 0.0 as mean_signed_error_frames,
    cast(max(abs_frame_error) as double) as max_abs_error_frames, round(avg(normalized_abs_frame_error), 6) + 0.0 as mean_normalized_abs_error,
    round(avg(case when abs_frame_error <= 0 then 1.0 when abs_frame_error is not null then 0.0 end), 6) + 0.0 as within_0_frames,
    round(avg(case when abs_frame_error <= 1 then 1.0 when abs_frame_error is not null then 0.0 end), 6) + 0.0 as within_1_frames,
    round(avg(case when abs_frame_error <= 3 then 1.0 when abs_frame_error is not null then 0.0 end), 6) + 0.0 as within_3_frames,
    round(avg(case when abs_frame_error <= 5 then 1.0 when abs_frame_error is not null then 0.0 end), 6) + 0.0 as within_5_frames,
    round(avg(case when abs_frame_error <= 10 then 1.0 when abs_frame_error is not null then 0.0 end), 6) + 0.0 as within_10_frames,
    round(avg(tcp_position_l2_error), 6) + 0.0 as mean_tcp_position_l2_m, round(avg(tcp_rotation_l2_error), 6) + 0.0 as mean_tcp_rotation_l2_rad, round(avg(tcp_pose6d_l2_error), 6) + 0.0 as mean_tcp_pose6d_l2,
    round(median(abs_frame_error), 6) + 0.0 as median_abs_error_frames, round(median(tcp_position_l2_error), 6) + 0.0 as median_tcp_position_l2_m
  from scored group by 1, 2"""

ACCURACY = [f"within_{t}_frames" for t in EV.TOLERANCES]
CONTACT_METRICS = ["num_episodes", "num_with_gt_and_prediction", "mae_frames", "median_abs_error_frames", "rmse_frames", "mean_signed_error_frames", "max_abs_error_frames", "mean_normalized_abs_error"]
POSE_METRICS = ["mean_tcp_position_l2_m", "median_tcp_position_l2_m", "mean_tcp_rotation_l2_rad", "mean_tcp_pose6d_l2"]


def _summary_sql(pairs, columns):
    return f"select {', '.join([*BY, *columns])} from ({errors_sql(pairs)} {SUMMARY_SELECT})"


@query("l2_error", errors_sql(DEFAULT) + EPISODE_SELECT + " from scored")
def l2_error(spark, folder):
    """Frame and pose errors of every episode at the default thresholds."""
    return _errors(spark, folder, DEFAULT)


@query("contact_metrics", _summary_sql(DEFAULT, CONTACT_METRICS))
def contact_metrics(spark, folder):
    return EV.summarize(_errors(spark, folder, DEFAULT), BY, medians=("median_abs_error_frames",)).select(*BY, *CONTACT_METRICS)


@query("accuracy_at_tolerance", _summary_sql(DEFAULT, ACCURACY))
def accuracy_at_tolerance(spark, folder):
    errors, e = _errors(spark, folder, DEFAULT), F.col("abs_frame_error")
    return errors.groupBy(*BY).agg(*[F.avg((e <= t).cast("double")).alias(f"within_{t}_frames") for t in EV.TOLERANCES])


@query("pose_metrics", _summary_sql(DEFAULT, POSE_METRICS))
def pose_metrics(spark, folder):
    return EV.summarize(_errors(spark, folder, DEFAULT), BY, medians=("median_tcp_position_l2_m",)).select(*BY, *POSE_METRICS)


@query("threshold_sweep", _summary_sql(SWEEP, CONTACT_METRICS + ACCURACY + POSE_METRICS))
def threshold_sweep(spark, folder):
    """All published threshold pairs in one pass over the frames."""
    return EV.summarize(_errors(spark, folder, SWEEP), BY).select(*BY, *CONTACT_METRICS, *ACCURACY, *POSE_METRICS)


MEANS = ["num_frames", "gt_contact_frame", "pred_contact_frame", "frame_error", "abs_frame_error", "normalized_abs_frame_error", "tcp_position_l2_error", "tcp_rotation_l2_error", "tcp_pose6d_l2_error", "gripper_min", "gripper_max"]


@query("mean_row", errors_sql(SWEEP) + "select grasp_threshold, contact_threshold, " + ", ".join(f"round(avg({c}), 6) + 0.0 as {c}" for c in MEANS) + " from scored group by 1, 2")
def mean_row(spark, folder):
    return EV.mean_row(_errors(spark, folder, SWEEP), tuple(MEANS), tuple(BY))


_REPORT = MEANS[:9] + ["gripper_raw_min", "gripper_raw_max"]
_REPORT_NULLS = ", ".join(f"cast(null as double) as {c}" for c in _REPORT)
_METRIC_OF = {
    "evaluated_episodes": "num_with_gt_and_prediction",
    "total_episodes": "num_episodes",
    "contact_frame_mae_frames": "mae_frames",
    "contact_frame_rmse_frames": "rmse_frames",
    "contact_frame_median_abs_error_frames": "median_abs_error_frames",
    "contact_frame_mean_signed_error_frames": "mean_signed_error_frames",
    "contact_frame_max_abs_error_frames": "max_abs_error_frames",
    "contact_frame_mean_normalized_abs_error": "mean_normalized_abs_error",
    **{a: a for a in ACCURACY},
    **{p: p for p in POSE_METRICS},
}


@query(
    "report_rows",
    errors_sql(SWEEP).rstrip()
    + ", named as (select * exclude (gripper_min, gripper_max), gripper_min as gripper_raw_min, gripper_max as gripper_raw_max, 'grasp_' || grasp_threshold || '__contact_' || contact_threshold as tag from scored), summed as ("
    + SUMMARY_SELECT
    + ") select tag, grasp_threshold, contact_threshold, cast(episode_id as varchar) as episode_id, "
    + six(*_REPORT)
    + ", cast(null as varchar) as metric, cast(null as double) as value from named union all by name select tag, grasp_threshold, contact_threshold, 'MEAN' as episode_id, "
    + ", ".join(f"round(avg({c}), 6) + 0.0 as {c}" for c in _REPORT)
    + " from named group by 1, 2, 3 "
    + " ".join(
        f"union all by name select 'grasp_' || grasp_threshold || '__contact_' || contact_threshold as tag, grasp_threshold, contact_threshold, 'SUMMARY' as episode_id, '{m}' as metric, cast({c} as double) as value from summed"
        for m, c in _METRIC_OF.items()
    ),
)
def report_rows(spark, folder):
    return EV.report_rows(_errors(spark, folder, SWEEP), BY)


@query("threshold_tag", "select p_partkey, 'grasp_' || cast((p_partkey % 99 + 1) / 100.0 as varchar) || '__contact_' || cast((p_partkey % 89 + 1) / 100.0 as varchar) as tag from part")
def threshold_tag(spark, folder):
    k = F.col("p_partkey")
    return D.table(spark, folder, "part").select("p_partkey", X.threshold_tag((k % 99 + 1) / 100.0, (k % 89 + 1) / 100.0).alias("tag"))


@query("first_gt", with_(RAW, LABELS) + "select episode_id, gt_contact_frame, " + ", ".join(f"round(aff[{i + 1}], 6) + 0.0 as a{i}" for i in range(6)) + " from (select distinct episode_id from raw) left join contact_labels using (episode_id) left join affordance_labels using (episode_id)")
def first_gt(spark, folder):
    """First readable label of each episode in file order, merged from partial results."""
    contact, merge = EV.earliest(X.parse_int_like(F.col("contact_text")), "event_id")
    pose, _ = EV.earliest(X.parse_vector(F.col("affordance_text")), "event_id")
    rows = D.raw_frames(spark, folder).groupBy(KEY).agg(contact.alias("c"), pose.alias("a"))
    return rows.select(KEY, F.col("c")["value"].alias("gt_contact_frame"), *[F.get(F.col("a")["value"], i).alias(f"a{i}") for i in range(6)])


@query(
    "frame_lookup",
    with_(FRAMES, LABELS)
    + "select c.episode_id, gt_contact_frame as frame_index, " + "round(x, 6) + 0.0 as x, round(z - 0.1, 6) + 0.0 as tcp_z, gripper from contact_labels c left join frames f on f.episode_id = c.episode_id and f.frame_index = c.gt_contact_frame",
)
def frame_lookup(spark, folder):
    """Row of the annotated contact frame; some lie past the end of the episode."""
    indexed, labels = D.labelled_frames(spark, folder)
    wanted = labels.where("gt_contact_frame is not null").select(KEY, F.col("gt_contact_frame").alias("frame_index"))
    found = EV.frame_lookup(wanted, indexed, ["tcp_pose", "gripper"])
    return found.select(KEY, "frame_index", F.get("tcp_pose", 0).alias("x"), F.get("tcp_pose", 2).alias("tcp_z"), "gripper")


@query(
    "contact_pose",
    ONE
    + """, firsts as (select episode_id, min(case when phase = 'contact' then frame_index end) as frame_index from phased group by 1)
    select episode_id, frame_index, round(x, 6) + 0.0 as gripper_x, round(z, 6) + 0.0 as gripper_z, round(z - 0.1, 6) + 0.0 as tcp_z, gripper as gripper_raw, round((gripper - gripper_min) / (gripper_max - gripper_min + 1e-6), 6) + 0.0 as gripper_normalized
    from firsts join frames using (episode_id, frame_index)""",
)
def contact_pose(spark, folder):
    indexed = D.with_poses(D.frames(spark, folder)).withColumn("norm", S.gripper_norm(S.EPS_GRASP))
    found = EV.contact_pose(indexed, P.first_contact(P.grasp_phases(indexed)), ["gripper_pose", "tcp_pose", "gripper", "norm"])
    return found.select(
        KEY,
        "frame_index",
        F.get("gripper_pose", 0).alias("gripper_x"),
        F.get("gripper_pose", 2).alias("gripper_z"),
        F.get("tcp_pose", 2).alias("tcp_z"),
        F.col("gripper").alias("gripper_raw"),
        F.col("norm").alias("gripper_normalized"),
    )


