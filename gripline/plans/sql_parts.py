"""SQL for the test tables in the shape of recordings, shared by the comparison queries."""

RAW = """raw as (
  select user_id as episode_id, event_id, cast(cast(floor(value) as bigint) % 10 as double) as gripper,
    (event_id * 37 % 401) / 200.0 - 1.0 as x, (event_id * 53 % 307) / 150.0 - 1.0 as y,
    (event_id * 71 % 211) / 100.0 - 0.605 as z, (event_id * 13 % 101) / 50.0 as rx,
    (event_id * 17 % 103) / 50.0 as ry, (event_id * 19 % 107) / 50.0 as rz,
    cast(json_extract_string(props, '$.k') as bigint) as k
  from events)"""

FRAMES = RAW + """,
frames as (
  select *, row_number() over w - 1 as frame_index, count(*) over (partition by episode_id) as n_steps,
    min(gripper) over (partition by episode_id) as gripper_min, max(gripper) over (partition by episode_id) as gripper_max
  from raw window w as (partition by episode_id order by event_id))"""

# annotated contact frame and pose: the first readable one of each episode
LABELS = """contact_labels as (
  select episode_id, arg_min(k, event_id) as gt_contact_frame from raw where event_id % 5 in (2, 4) group by 1),
affordance_labels as (
  select episode_id,
    arg_min([((event_id * 3) % 997) / 1000.0, ((event_id * 7) % 997) / 1000.0, ((event_id * 11) % 997) / 1000.0,
      ((event_id * 13) % 997) / 1000.0, ((event_id * 17) % 997) / 1000.0, ((event_id * 19) % 997) / 1000.0], event_id) as aff
  from raw where event_id % 4 = 1 group by 1)"""


def grasp_run(pairs: list[tuple[float, float]]) -> str:
    """The grasp machine, one step at a time, for each threshold pair."""
    values = ", ".join(f"({g}::double, {c}::double)" for g, c in pairs)
    return f"""params(gt, ct) as (values {values}),
signal as (select episode_id, frame_index, n_steps, (gripper - gripper_min) / (gripper_max - gripper_min + 1e-6) as g from frames),
pairs_of as (select *, coalesce(lag(g) over (partition by episode_id order by frame_index), g) as p from signal),
machine as (
  select episode_id, gt, ct, cast(0 as bigint) as frame_index, 0 as st from (select distinct episode_id from frames), params
  union all
  select m.episode_id, m.gt, m.ct, s.frame_index,
    case m.st
      when 0 then case when s.g > m.gt and s.g > s.p then 1 else 0 end
      when 1 then case when s.g >= m.ct then 2 when s.g <= m.gt and s.g < s.p then 0 else 1 end
      when 2 then case when s.g < m.ct and s.g < s.p then 3 else 2 end
      when 3 then case when s.g <= m.gt then 4 when s.g >= m.ct and s.g > s.p then 2 else 3 end
      else case when s.g > m.gt and s.g > s.p then 1 else 4 end end
  from machine m join pairs_of s on s.episode_id = m.episode_id and s.frame_index = m.frame_index + 1)"""


PHASED = """phased as (
  select m.episode_id, m.frame_index, f.n_steps,
    (['pre_grasp', 'immobilization', 'contact', 'detach', 'post_grasp'])[m.st + 1] as phase
  from machine m join frames f using (episode_id, frame_index))"""

RANGES = """marked as (
  select *, case when phase is distinct from lag(phase) over w then 1 else 0 end as is_start from phased
  window w as (partition by episode_id order by frame_index)),
runs as (select *, sum(is_start) over (partition by episode_id order by frame_index) as run_id from marked),
spans as (select episode_id, phase, run_id, min(frame_index) as start_step, max(frame_index) as end_step from runs group by all),
ranges as (
  select episode_id, phase, row_number() over (partition by episode_id, phase order by start_step) - 1 as range_index, start_step, end_step
  from spans)"""

# the five-state machine step by step, then the smoothing loop over each episode's list
FIVE = """sig5 as (
  select *, (gripper - gripper_min) / (gripper_max - gripper_min + 1e-8) as s,
    coalesce(gripper - lag(gripper) over (partition by episode_id order by frame_index), 0.0) as d from frames),
five as (
  select episode_id, cast(0 as bigint) as frame_index, 'approach' as ph, cast(0 as double) as conf from sig5 where frame_index = 0
  union all
  select v.episode_id, s5.frame_index,
    case v.ph
      when 'approach' then case when s >= 0.8 and abs(d) <= 0.02 then 'contact' when s < 0.5 and d < -0.02 then 'approach' else 'stabilize' end
      when 'stabilize' then case when s >= 0.8 and abs(d) <= 0.02 then 'contact' else 'stabilize' end
      when 'contact' then case when d > 0.02 then 'release' else 'contact' end
      when 'release' then case when s < 0.5 then 'reset' else 'release' end
      else 'approach' end,
    cast(case v.ph
      when 'approach' then case when s >= 0.8 and abs(d) <= 0.02 then 0.85 when s < 0.5 and d < -0.02 then 0.9 else 0.75 end
      when 'stabilize' then case when s >= 0.8 and abs(d) <= 0.02 then 0.9 else 0.8 end
      when 'contact' then case when d > 0.02 then 0.85 else 0.95 end
      when 'release' then case when s < 0.5 then 0.8 else 0.85 end
      else 0.7 end as double)
  from five v join sig5 s5 on s5.episode_id = v.episode_id and s5.frame_index = v.frame_index + 1),
ahead as (
  select *, lead(ph) over (partition by episode_id order by frame_index) as nx from five),
smooth as (
  select episode_id, frame_index, ph as out_ph from ahead where frame_index = 0
  union all
  select a.episode_id, a.frame_index,
    case when a.nx is not null and a.ph <> o.out_ph and a.ph <> a.nx then o.out_ph else a.ph end
  from smooth o join ahead a on a.episode_id = o.episode_id and a.frame_index = o.frame_index + 1),
five_phased as (
  select f.*, v.ph as raw_phase, v.conf as phase_confidence, o.out_ph as phase, s5.s as gripper_norm, s5.d as gripper_delta
  from frames f join five v using (episode_id, frame_index) join smooth o using (episode_id, frame_index)
  join (select episode_id, frame_index, s, d from sig5) s5 using (episode_id, frame_index))"""

# pixels with the camera of even episodes, and the plain image spread for the others
PIXELS = """camera_pts as (
  select *, 0.8 * x - 0.6 * y + 0.05 as cx, 0.6 * x + 0.8 * y - 0.1 as cy, z + 0.4 as cz from five_phased),
pixels as (
  select *,
    case when episode_id % 2 = 0 then case when cz > 0 then (300.0 * cx + 160.0 * cz) / cz end else (x + 1) / 2 * 320 end as u,
    case when episode_id % 2 = 0 then case when cz > 0 then (290.0 * cy + 90.0 * cz) / cz end else (y + 1) / 2 * 180 end as v
  from camera_pts)"""

QUALITY = """scored as (
  select *, cast(trunc(u) as bigint) as pu, cast(trunc(v) as bigint) as pv,
    cast(case when u is null then 0.275 else 0.875 end as double) as annotation_confidence from pixels)"""

# frames with depth: the patch, crop and depth error of contact frames that have a camera and depth
QUALITY_3D = """pixel_rows as (select *, cast(trunc(u) as bigint) as pu, cast(trunc(v) as bigint) as pv from pixels),
touching as (select * from pixel_rows where pu is not null and phase = 'contact'),
lifted as (
  select *, (x - 160.0) / 300.0 * depth_m - 0.05 as q0, (y - 90.0) / 290.0 * depth_m + 0.1 as q1, depth_m - 0.4 as q2 from depth_px where episode_id % 2 = 0),
points as (select episode_id, frame_index, x, y, depth_m, 0.8 * q0 + 0.6 * q1 as px, -0.6 * q0 + 0.8 * q1 as py, q2 as pz from lifted),
near as (
  select p.*, row_number() over (partition by episode_id, frame_index order by (p.x - c.pu) ** 2 + (p.y - c.pv) ** 2, p.y, p.x) as rank
  from points p join touching c using (episode_id, frame_index)),
patches as (
  select episode_id, frame_index, count(*) as patch_points, sum(px) as patch_x, sum(py) as patch_y, sum(pz) as patch_z from near where rank <= 32 group by 1, 2),
crops as (
  select d.episode_id, d.frame_index, count(*) as crop_cells, sum(d.depth_m) as crop_depth from depth_px d join touching c using (episode_id, frame_index)
  where d.x >= c.pu - 16 and d.x < c.pu + 16 and d.y >= c.pv - 16 and d.y < c.pv + 16 group by 1, 2),
depth_errors as (
  select c.episode_id, c.frame_index, sqrt((c.x - px) ** 2 + (c.y - py) ** 2 + (c.z - pz) ** 2) * 1000 as mm
  from touching c join points p on p.episode_id = c.episode_id and p.frame_index = c.frame_index and p.x = c.pu and p.y = c.pv),
scored as (
  select f.*, coalesce(patch_points, 0) as patch_points, patch_x, patch_y, patch_z, coalesce(crop_cells, 0) as crop_cells, crop_depth, coalesce(mm, -1.0) as deprojection_err_mm,
    case when pu is null then 0.0 else 0.6 end + 0.25 * (case when coalesce(patch_points, 0) >= 10 then 1.0 else 0.5 end)
      + 0.15 * (case when mm is null then 1.0 else greatest(0.0, 1 - mm / 50) end) as annotation_confidence
  from pixel_rows f left join patches using (episode_id, frame_index) left join crops using (episode_id, frame_index) left join depth_errors using (episode_id, frame_index))"""

INSTRUCTIONS = """users as (select user_id as episode_id, count(*) as n_steps from events group by 1),
texts as (
  select u.episode_id, u.n_steps,
    case when u.episode_id % 17 = 16 then '' else
      (['pick','grab','place','put','open','close','pour','wipe','push','slide','insert','stack','move','look'])[u.episode_id % 14 + 1]
      || ' the ' || coalesce(p_name, 'object') || '.' end as instruction
  from users u left join part on p_partkey = u.episode_id),
tokens as (
  select *, list_filter(string_split_regex(lower(instruction), '\\s+'), lambda t: t <> '') as tok from texts),
verbs as (
  select *, coalesce(list_filter(tok, lambda t: t in ('pick','grab','place','put','open','close','pour','wipe','push','slide','insert','stack'))[1], 'unknown') as task_verb,
    coalesce(rtrim(tok[len(tok)], '.,'), 'unknown') as task_object from tokens),
tags as (
  select *,
    case when task_verb in ('pick','grab','place','put','insert','stack') then 'pick-and-place' when task_verb in ('open','close') then 'articulated'
      when task_verb in ('pour','wipe') then 'tool-use' when task_verb in ('push','slide') then 'non-prehensile' else 'unknown' end as task_category,
    task_verb in ('insert','stack','pour','place') as requires_precision,
    cast(case when task_verb = 'unknown' then 0.3 else 0.9 end as double) as language_quality
  from verbs)"""

# annotated traces: point i of frame e is (31 e + 17 i mod 320, 29 e + 13 i mod 180), e mod 13 points on every third frame
TRACES = """gt_points as (
  select episode_id, event_id, frame_index, i as idx, cast((event_id * 31 + i * 17) % 320 as double) as gu, cast((event_id * 29 + i * 13) % 180 as double) as gv
  from frames, lateral (select unnest(range(event_id % 13)) as i) where event_id % 3 = 0 and event_id % 13 > 0),
future as (
  select a.episode_id, a.frame_index, cast(a.i as bigint) as idx, b.x, b.y, b.z
  from (select episode_id, frame_index, unnest(range(10)) as i from frames) a join frames b on b.episode_id = a.episode_id and b.frame_index = a.frame_index + a.i)"""

# nearest of three cameras at frames 0, 20, 45; ties go to the earlier one
PROJECTED = """cams(cam_pos, cam_frame, tx, ty, tz) as (values (0, 0, 0.0, 0.0, 0.5), (1, 20, 0.1, -0.1, -0.2), (2, 45, 0.2, -0.2, 1.0)),
cam_of as (
  select f.episode_id, f.frame_index, arg_min(struct_pack(cam_pos := cam_pos, tx := tx, ty := ty, tz := tz), abs(cam_frame - f.frame_index) * 10 + cam_pos) as c
  from frames f, cams group by 1, 2),
projected as (
  select t.*, c.cam_pos,
    case when z + c.tz > 1e-6 then 300.0 * ((x + c.tx) / (z + c.tz)) + 160.0 end as u,
    case when z + c.tz > 1e-6 then 290.0 * ((y + c.ty) / (z + c.tz)) + 90.0 end as v
  from future t join cam_of using (episode_id, frame_index))"""

PAIRS = """pair_pts as (
  select p.episode_id, p.frame_index, p.idx, p.x, p.y, p.z, p.u as pu, p.v as pv, g.gu, g.gv
  from projected p join gt_points g using (episode_id, frame_index, idx))"""


# least squares by the normal equations of centred sums, solved by elimination
FIT = """mom as (
  select episode_id, count(*) as n, avg(x) as mx, avg(y) as my, avg(z) as mz, avg(gu) as mu, avg(gv) as mv,
    var_pop(x) as xx, covar_pop(x, y) as xy, covar_pop(x, z) as xz, var_pop(y) as yy, covar_pop(y, z) as yz, var_pop(z) as zz,
    covar_pop(x, gu) as xu, covar_pop(y, gu) as yu, covar_pop(z, gu) as zu, covar_pop(x, gv) as xv, covar_pop(y, gv) as yv, covar_pop(z, gv) as zv
  from pair_pts group by 1),
el1 as (
  select *, yy - xy * xy / xx as yy1, yz - xy * xz / xx as yz1, zz - xz * xz / xx as zz1,
    yu - xy * xu / xx as yu1, zu - xz * xu / xx as zu1, yv - xy * xv / xx as yv1, zv - xz * xv / xx as zv1
  from mom where n >= 4 and abs(xx * (yy * zz - yz * yz) - xy * (xy * zz - yz * xz) + xz * (xy * yz - yy * xz)) > 1e-12 * xx * yy * zz),
el2 as (select *, (zu1 - yz1 * yu1 / yy1) / (zz1 - yz1 * yz1 / yy1) as a_zu, (zv1 - yz1 * yv1 / yy1) / (zz1 - yz1 * yz1 / yy1) as a_zv from el1),
el3 as (select *, (yu1 - yz1 * a_zu) / yy1 as a_yu, (yv1 - yz1 * a_zv) / yy1 as a_yv from el2),
el4 as (select *, (xu - xy * a_yu - xz * a_zu) / xx as a_xu, (xv - xy * a_yv - xz * a_zv) / xx as a_xv from el3),
fit as (
  select m.episode_id, m.n as pair_count, a_xu, a_yu, a_zu, e.mu - a_xu * e.mx - a_yu * e.my - a_zu * e.mz as a_1u,
    a_xv, a_yv, a_zv, e.mv - a_xv * e.mx - a_yv * e.my - a_zv * e.mz as a_1v
  from mom m left join el4 e using (episode_id))"""

VISIBLE = """visible as (
  select episode_id, count(u) as points, count(case when u >= 0 and u < 320 and v >= 0 and v < 180 then 1 end) as inside from projected group by 1)"""

CHOSEN = """chosen as (
  select episode_id, coalesce(inside::double / nullif(points, 0), 0.0) as visible_ratio,
    coalesce(inside::double / nullif(points, 0), 0.0) < 0.2 and a_1u is not null as use_fit, fit.* exclude (episode_id)
  from visible left join fit using (episode_id)),
predicted as (
  select p.episode_id, p.frame_index, p.idx,
    case when c.use_fit then p.x * a_xu + p.y * a_yu + p.z * a_zu + a_1u else p.u end as u,
    case when c.use_fit then p.x * a_xv + p.y * a_yv + p.z * a_zv + a_1v else p.v end as v
  from projected p join chosen c using (episode_id)),
gaps as (
  select episode_id, frame_index, idx, sqrt((u - gu) * (u - gu) + (v - gv) * (v - gv)) as gap
  from predicted join gt_points using (episode_id, frame_index, idx)),
frame_errors as (
  select episode_id, frame_index, count(gap) as point_count, avg(gap) as mean_l2_px, (list(gap order by idx desc))[1] as endpoint_l2_px
  from gaps group by 1, 2)"""

LINES = """line_frames as (
  select l_orderkey // 100 as episode_id, l_orderkey % 100 as line_frame, (l_orderkey % 100) // 10 * 5 + 10 as pixel_frame, * from lineitem)"""

DETECTIONS = LINES + """,
detections as (
  select episode_id, line_frame as frame_index, l_partkey * 100000 + l_suppkey as det_idx, (['cup', 'towel', 'robot gripper'])[l_partkey % 3 + 1] as label,
    l_discount * 10 as score, cast(l_partkey % 300 as double) as x1, cast(l_suppkey % 160 as double) as y1,
    l_partkey % 300 + l_quantity as x2, l_suppkey % 160 + l_quantity / 2 as y2 from line_frames)"""

MASKS = """mask_px as (
  select episode_id, pixel_frame as frame_index, l_linestatus as obj_id, l_partkey % 320 as x, l_suppkey % 180 as y from line_frames)"""

DEPTH = """depth_px as (
  select episode_id, pixel_frame as frame_index, l_partkey % 320 as x, l_suppkey % 180 as y, min(l_quantity) / 50.0 + 0.3 as depth_m
  from line_frames group by 1, 2, 3, 4)"""

SEGMENTS = """episodes_of as (
  select o_orderkey as episode_id, o_orderkey % 3 as first_frame, o_orderkey % 3 + 20 + o_orderkey % 17 as last_frame, o_orderpriority as task_instruction from orders),
planned as (
  select l_orderkey as episode_id, l_partkey * 100000 + l_suppkey as pos, l_linenumber * 5 as a, l_linenumber * 5 + cast(l_quantity as int) - 10 as b,
    case l_partkey % 7 when 0 then '' when 1 then '[]' else l_returnflag || ' part' end as txt from lineitem),
clamped as (
  select p.*, first_frame, last_frame, greatest(first_frame, least(last_frame, a)) as ca, greatest(first_frame, least(last_frame, b)) as cb
  from planned p join episodes_of using (episode_id)),
ordered as (
  select episode_id, first_frame, last_frame, least(ca, cb) as s, greatest(ca, cb) as e, case when txt in ('', '[]') then 'complete this part of the task' else txt end as txt,
    row_number() over (partition by episode_id order by least(ca, cb), greatest(ca, cb), pos) - 1 as k from clamped),
sweep as (
  select episode_id, cast(-1 as bigint) as k, first_frame as cur, cast(null as bigint) as ns, cast(null as bigint) as ne, cast(null as varchar) as txt, false as kept,
    first_frame, last_frame from episodes_of
  union all
  select o.episode_id, o.k, least(greatest(o.s, w.cur, o.e) + 1, o.last_frame + 1), greatest(o.s, w.cur), least(greatest(o.s, w.cur, o.e), o.last_frame), o.txt,
    greatest(o.s, w.cur) <= o.last_frame, o.first_frame, o.last_frame
  from sweep w join ordered o on o.episode_id = w.episode_id and o.k = w.k + 1 where w.k = -1 or w.kept),
clean as (
  select episode_id, 'segment_' || lpad(cast(k as varchar), 3, '0') as segment_id, k as segment_index,
    case when k = 0 then first_frame else ns end as start_frame,
    case when k = max(k) over (partition by episode_id) then last_frame else ne end as end_frame,
    txt as subtask_instruction, 'vlm' as instruction_source
  from sweep where kept)"""


def with_(*parts: str) -> str:
    return "with recursive " + ",\n".join(parts) + "\n"
