import random

import numpy as np
from pyspark.sql import functions as F

from gripline.functions import geometry as G
from gripline.operators import blocks, depth, detections
from gripline.operators import signals as S
from gripline.operators import traces as TR


def path(seed, n):
    rng = random.Random(seed)
    return [(rng.uniform(-1, 1), rng.uniform(-1, 1), rng.uniform(0, 2)) for _ in range(n)]


def frames(spark, lengths):
    rows = [(e, i, *p) for e, n in lengths.items() for i, p in enumerate(path(n, n))]
    return blocks.index_frames(spark.createDataFrame(rows, "episode_id string, frame_index bigint, x double, y double, z double"))


def by_frame(rows, column):
    return {(r.episode_id, r.frame_index): r[column] for r in rows.collect()}


def test_traces(spark, blocking):
    lengths = {"a": 40, "b": 1, "c": 5}
    indexed = frames(spark, lengths)
    ahead = by_frame(S.future_trace(indexed, 5), "future_trace")
    skip = by_frame(S.future_trace(indexed, 5, include_current=False), "future_trace")
    wide = blocks.with_halo(indexed, before=4).withColumn("past", S.past(S.point(), 5)).where("home")
    back = by_frame(wide, "past")
    for e, n in lengths.items():
        pts = path(n, n)
        for i in range(n):
            assert [tuple(p) for p in ahead[(e, i)]] == pts[i : i + 5]
            assert [tuple(p) for p in skip[(e, i)]] == pts[i + 1 : i + 6]
            assert [tuple(p) for p in back[(e, i)]] == pts[max(0, i - 4) : i + 1][::-1]


def test_smoothed_trace(spark, monkeypatch):
    indexed = frames(spark, {"a": 60})
    whole = by_frame(S.smoothed_trace(indexed, 3, 4), "trace")
    monkeypatch.setattr(blocks, "BLOCK", 9)
    cut = by_frame(S.smoothed_trace(indexed, 3, 4), "trace")
    assert whole == cut
    pts = np.array(path(60, 60))
    soft = pts.copy()
    for i in range(2, 58):
        soft[i] = np.array([-3, 12, 17, 12, -3]) @ pts[i - 2 : i + 3] / 35
    for i in (0, 1, 2, 30, 57, 59):
        assert np.allclose(np.array([tuple(p) for p in whole[("a", i)]]), soft[max(0, i - 3) : i + 5])


def test_nearest_camera(spark, blocking):
    rng = random.Random(6)
    k = [[100.0, 0.0, 50.0], [0.0, 100.0, 40.0], [0.0, 0.0, 1.0]]
    e = [[1.0, 0.0, 0.0, 0.0], [0.0, 1.0, 0.0, 0.0], [0.0, 0.0, 1.0, 0.5]]
    where = {"a": [rng.randint(0, 60) for _ in range(12)], "c": [30, 2, 2, 4]}
    cams = spark.createDataFrame([(ep, i, f, k, e) for ep, fs in where.items() for i, f in enumerate(fs)], "episode_id string, cam_pos int, frame_index bigint, K array<array<double>>, E array<array<double>>")
    got = by_frame(TR.nearest_camera(frames(spark, {"a": 40, "b": 3, "c": 5}), cams), "cam_pos")
    for (ep, f), pos in got.items():
        if ep == "b":
            assert pos is None
        else:
            gaps = [abs(c - f) for c in where[ep]]
            assert pos == gaps.index(min(gaps))
    assert len(got) == 48


def test_projection_edges(spark):
    k = [[300.0, 0.0, 160.0], [0.0, 290.0, 90.0], [0.0, 0.0, 1.0]]
    e = [[1.0, 0.0, 0.0, 0.0], [0.0, 1.0, 0.0, 0.0], [0.0, 0.0, 1.0, 0.0]]
    t = e + [[0.0, 0.0, 0.0, 1.0]]
    rows = spark.createDataFrame([(0.5, 0.2, z, k, e, t) for z in (2.0, 0.0, -1.0, 1e-6, 1e-7, 2e-6)], "x double, y double, z double, K array<array<double>>, E array<array<double>>, T array<array<double>>")
    x, y, z = F.col("x"), F.col("y"), F.col("z")
    got = rows.select(G.project_camera(x, y, z, G.camera_rows(F.col("K"), F.col("E"))).alias("c"), G.project_pinhole(x, y, z, F.col("K"), F.col("T")).alias("p")).collect()
    assert [g.c is not None for g in got] == [True, False, False, False, False, True]
    assert [g.p is not None for g in got] == [True, False, False, True, True, True]
    assert abs(got[0].c.u - (300 * 0.25 + 160)) < 1e-9 and abs(got[0].p.v - (290 * 0.1 + 90)) < 1e-9
    moved = rows.select(G.project_camera(x, y, z, G.camera_rows(F.col("K"), F.col("E"), F.col("T"))).alias("c")).first().c
    assert abs(moved.u - got[0].c.u) < 1e-9
    plain = rows.limit(1).select(G.project_pinhole(x, y, z, F.lit(None).cast("array<array<double>>"), F.col("T")).alias("p")).first().p
    assert (plain.u, plain.v) == (0.75 * 320, 0.6 * 180)
    box = spark.sql("select 5L as u, -3L as v").select(G.affordance_box(F.col("u"), F.col("v")).alias("b")).first().b
    assert box == [0, 0, 25, 17]


def test_fit(spark):
    rng = np.random.default_rng(3)
    rows, want = [], {}
    for e in ("a", "b"):
        xyz, noise = rng.normal(size=(50, 3)), rng.normal(size=(50, 2))
        target = np.c_[xyz, np.ones(50)] @ rng.normal(size=(4, 2)) * 50 + noise
        want[e] = np.linalg.lstsq(np.c_[xyz, np.ones(50)], target, rcond=None)[0]
        rows += [(e, *map(float, p), *map(float, q)) for p, q in zip(xyz, target)]
    rows += [("few", 1.0, 2.0, 3.0, 4.0, 5.0)] * 3 + [("flat", float(i), 2.0, 0.0, 1.0, 1.0) for i in range(9)]
    fits = {r.episode_id: r for r in TR.fit_affine(spark.createDataFrame(rows, "episode_id string, x double, y double, z double, u double, v double")).collect()}
    for e in want:
        have = np.array([[fits[e][f"a_{a}{t}"] for t in "uv"] for a in ("x", "y", "z", "1")])
        assert np.allclose(have, want[e], atol=1e-8)
    assert fits["few"].a_1u is None and fits["flat"].a_1u is None


def test_trace_errors(spark):
    p = lambda u, v: {"u": u, "v": v}
    rows = [
        (1, [p(0.0, 0.0), p(3.0, 4.0), None], [[0.0, 0.0], [0.0, 0.0]]),
        (2, [None, p(1.0, 1.0)], [[0.0, 0.0], [1.0, 1.0], [2.0, 2.0]]),
        (3, [p(1.0, 1.0), None], [[1.0, 2.0], [0.0, 0.0]]),
        (4, [p(1.0, 1.0)], None),
        (5, [], [[1.0, 1.0]]),
    ]
    table = spark.createDataFrame(rows, "id int, pred_trace array<struct<u:double,v:double>>, gt_trace array<array<double>>")
    got = {r.id: (r.point_count, r.mean_l2_px, r.endpoint_l2_px) for r in TR.with_trace_error(table).collect()}
    assert got == {1: (2, 2.5, 5.0), 2: (1, 0.0, 0.0), 3: (1, 1.0, None), 4: (0, None, None), 5: (0, None, None)}


def test_modes(spark):
    """Few visible points call for the fit only in auto mode, and only if there is one."""
    cols = spark.sql("select 0.1D as r, true as f union all select 0.1D, false union all select 0.2D, true")
    pick = lambda m: [x[0] for x in cols.select(TR.choose_projection(F.col("r"), F.col("f"), m)).collect()]
    assert pick("auto") == [True, False, False] and pick("fit") == [True] * 3 and pick("da3") == [False] * 3


def test_depth(spark):
    """Pixels of a tilted plane give back the plane's normal and the contact point itself."""
    k = [[100.0, 0.0, 50.0], [0.0, 100.0, 50.0], [0.0, 0.0, 1.0]]
    t = [[1.0, 0.0, 0.0, 0.0], [0.0, 1.0, 0.0, 0.0], [0.0, 0.0, 1.0, 0.0], [0.0, 0.0, 0.0, 1.0]]
    normal = np.array([0.2, -0.1, 1.0]) / np.linalg.norm([0.2, -0.1, 1.0])
    ray = lambda x, y: np.array([(x - 50) / 100, (y - 50) / 100, 1.0])
    deep = lambda x, y: 1.0 / float(normal @ ray(x, y))
    pixels = spark.createDataFrame([("e", 0, x, y, deep(x, y)) for x in range(30, 70) for y in range(30, 70)], "episode_id string, frame_index bigint, x bigint, y bigint, depth_m double")
    point = ray(47, 52) * deep(47, 52)
    contact = spark.createDataFrame([("e", 0, *map(float, point), 47, 52, k, t), ("e", 1, 0.0, 0.0, 1.0, 5, 5, k, t)], "episode_id string, frame_index bigint, contact_x double, contact_y double, contact_z double, pu bigint, pv bigint, K array<array<double>>, T array<array<double>>")
    errors = {r.frame_index: r.deprojection_err_mm for r in depth.deprojection_error(contact, pixels).collect()}
    assert abs(errors[0]) < 1e-6 and errors[1] == -1.0
    patch = depth.contact_patch(contact, pixels)
    assert patch.count() == 32
    gaps = sorted((x - 47) ** 2 + (y - 52) ** 2 for x in range(30, 70) for y in range(30, 70))
    assert sorted((r.x - 47) ** 2 + (r.y - 52) ** 2 for r in patch.collect()) == gaps[:32]
    n = depth.surface_normal(patch).first()
    assert np.allclose([n.nx, n.ny, n.nz], -normal, atol=1e-6)  # toward the camera at the origin
    assert depth.depth_patch(contact, pixels).where("frame_index = 0").count() == 32 * 32
    camera = spark.createDataFrame([("e", k, t)], "episode_id string, K array<array<double>>, T array<array<double>>")
    cloud = depth.point_cloud(pixels, camera, max_points=100).collect()
    assert len(cloud) == 100 and all(abs(normal @ [r.px, r.py, r.pz] - 1) < 1e-9 for r in cloud)


def test_detections(spark):
    payload = """{"object_detections": [{"label": "fleece", "box_xyxy": [169.6, 84.0, 242.4, 137.7], "box_score": 0.0275},
      {"label": "fleece", "xyxy": [0.1, 77.1, 262.9, 179.6], "score": 0.0167}], "gripper_detection": {"label": "robot gripper", "score": 0.022, "xyxy": [218.2, 0.3, 277.8, 57.1]}}"""
    docs = spark.createDataFrame([("e", 0, payload), ("n", 0, '{"object_detections": []}')], "episode_id string, frame_index bigint, payload string")
    rows = detections.explode_detections(docs)
    assert [(r.label, r.score, r.is_gripper) for r in rows.orderBy("det_idx").collect()] == [("fleece", 0.0275, False), ("fleece", 0.0167, False), ("robot gripper", 0.022, True)]
    assert detections.best_gripper(rows).first().x1 == 218.2
    assert detections.filter_detections(rows, 0.02).count() == 2
    tie = spark.createDataFrame([("e", 0, i, "robot gripper", s, 0.0, 0.0, 1.0, 1.0) for i, s in enumerate((0.3, 0.9, 0.9))], "episode_id string, frame_index bigint, det_idx bigint, label string, score double, x1 double, y1 double, x2 double, y2 double")
    assert detections.best_gripper(tie).first().det_idx == 1
    names = spark.sql("select map(10, 'c', 2, 'b', 0, 'a') as m").select(detections.labels_to_list(F.col("m"))).first()[0]
    assert names == ["a", "b", "c"]


def test_large_limits_use_salted_parts(spark, monkeypatch):
    rows = spark.createDataFrame([("hot", i % 5000) for i in range(20000)] + [("cold", i) for i in range(10)], "g string, v int")
    want = depth.nearest_first(["g"], [F.col("v")], 700, rows, "r").groupBy("g").agg(F.count("v"), F.sum("v")).collect()
    monkeypatch.setattr(depth, "GROUP_LIMIT", 10)
    assert sorted(depth.nearest_first(["g"], [F.col("v")], 700, rows, "r").groupBy("g").agg(F.count("v"), F.sum("v")).collect()) == sorted(want)


def test_label_rounds_as_python(spark):
    """Halves go to even and others by the exact double: 0.125 is 0.12, 0.045 is 0.04 and 0.025 is 0.03."""
    ratios = sorted({i / n for n in (1, 3, 7, 8, 16, 40, 200, 500, 1000, 4096) for i in range(n + 1)} | {0.0, 1e-9, 2.0**-40})
    rows = spark.createDataFrame([(r,) for r in ratios], "r double").select("r", TR.projection_label(F.lit(True), F.col("r")).alias("label")).collect()
    assert {r["r"]: r["label"] for r in rows} == {r: f"fit_from_gt(da3_visible={r:.2f})" for r in ratios}


def test_tasks_follow_the_frames(spark, monkeypatch, request):
    """Many frames are dealt to as many tasks as their number asks for, with the same rows; few are left to Spark."""
    lengths = {f"e{i:02d}": 5 + i for i in range(40)}
    plain = frames(spark, lengths)
    assert blocks.count_of(plain) == sum(lengths.values())
    monkeypatch.setattr(blocks, "TASK_ROWS", 50)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # the frames are no small table
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.autoBroadcastJoinThreshold"))
    dealt = frames(spark, lengths)
    assert dealt.rdd.getNumPartitions() == -(-sum(lengths.values()) // 50)
    assert blocks.with_halo(dealt, before=4).withColumn("past", S.past(S.point(), 5)).rdd.getNumPartitions() == -(-sum(lengths.values()) // 50)
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, plain.collect()))


def test_tasks_follow_the_segments(spark, monkeypatch, request):
    from gripline.operators import segments

    rows = spark.range(900).selectExpr("concat('e', id % 90) as episode_id", "id as pos", "id % 40 as start", "id % 40 + 3 as `end`", "'a' as text")
    episodes = spark.range(90).selectExpr("concat('e', id) as episode_id", "0L as first_frame", "60L as last_frame")
    plain = segments.normalize_segments(rows, episodes).collect()
    monkeypatch.setattr(segments, "TASK_SEGMENTS", 45)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.autoBroadcastJoinThreshold"))
    dealt = segments.normalize_segments(rows, episodes)
    assert dealt.rdd.getNumPartitions() == 20
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, plain))
