"""Tiles, dense masks and the 3D fields of frame records, against plain loops; frame numbers may repeat."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gripline.operators import blocks, depth, detections, masks, tiles
from gripline.operators.signals import gripper_values
from gripline.plans import annotate

K = [[100.0, 0.0, 50.0], [0.0, 100.0, 50.0], [0.0, 0.0, 1.0]]
T = [[1.0, 0.0, 0.0, 0.0], [0.0, 1.0, 0.0, 0.0], [0.0, 0.0, 1.0, 0.0], [0.0, 0.0, 0.0, 1.0]]
PIXELS = "episode_id string, frame_index bigint, x bigint, y bigint, depth_m double"
CONTACTS = "episode_id string, frame_index bigint, step bigint, pu bigint, pv bigint, K array<array<double>>, T array<array<double>>"


@pytest.fixture(scope="module")
def scene(spark):
    """Scattered pixels of three images: dense, sparse and with fewer pixels than a patch; contacts inside, at edges and far out."""
    r = np.random.default_rng(4)
    pixels = {("a", 0, int(x), int(y)) for x, y in r.integers(-40, 260, (3000, 2))}
    pixels |= {("a", 1, int(x), int(y)) for x, y in r.integers(0, 900, (300, 2))}
    pixels |= {("b", 0, int(x), 5) for x in range(0, 200, 20)}
    rows = [(*p, float(1 + (p[2] * 7 + p[3] * 3) % 11 / 10)) for p in sorted(pixels)]
    contacts = [("a", 0, 0, 100, 100), ("a", 0, 1, -39, 250), ("a", 0, 2, 31, 32), ("a", 1, 3, 450, 450), ("a", 1, 4, 5000, -5000), ("b", 0, 0, 64, 5), ("b", 9, 1, 64, 5), ("b", 0, 2, None, None), ("b", 0, 3, 2**62, -(2**62))]
    return spark.createDataFrame(rows, PIXELS), spark.createDataFrame([(*c, K, T) for c in contacts], CONTACTS), rows, contacts


def test_nearest_pixels(scene):
    """The patch holds the nearest pixels whatever tiles they lie in; two contacts of one frame number do not mix."""
    pixels, contacts, rows, asked = scene
    for keep in (1, 32, 200):
        got = {}
        for r in depth.contact_patch(contacts, pixels, points=keep).collect():
            got.setdefault((r.episode_id, r.step), []).append((r["rank"], r.x, r.y))
        for e, f, step, pu, pv in asked:
            near = [] if pu is None or abs(pu) >= tiles.FAR else sorted(((x - pu) ** 2 + (y - pv) ** 2, y, x, d) for a, b, x, y, d in rows if (a, b) == (e, f))[:keep]
            assert sorted(got.get((e, step), [])) == [(i + 1, x, y) for i, (_, y, x, _) in enumerate(near)]


def test_few_tiles_are_met(scene):
    pixels, contacts, _, _ = scene
    one = contacts.where("episode_id = 'a' and step = 0")
    every = tiles.tiled(pixels.where("episode_id = 'a' and frame_index = 0"))
    met = tiles.tiles_in_reach(one, every, 32).count()
    assert met < every.select(*tiles.PLACE).distinct().count() / 3


def test_crop_and_grid(scene):
    pixels, contacts, rows, asked = scene
    got = {(r.episode_id, r.step): r.grid for r in depth.crop_grid(depth.depth_patch(contacts, pixels)).collect()}
    for e, f, step, pu, pv in asked:
        near = {} if pu is None else {(y - pv + 16, x - pu + 16): d for a, b, x, y, d in rows if (a, b) == (e, f) and -16 <= x - pu < 16 and -16 <= y - pv < 16}
        want = [[near.get((i, j)) for j in range(32)] for i in range(32)] if near else None
        assert got.get((e, step)) == want


def test_crop_around_contact(scene):
    pixels, contacts, rows, asked = scene
    got = {(r.episode_id, r.step): (r.x1, r.y1, r.x2, r.y2, r.pixels) for r in detections.mask_contact_crop(pixels, contacts, 20).collect()}
    for e, f, step, pu, pv in asked:
        near = [] if pu is None else [(x, y) for a, b, x, y, _ in rows if (a, b) == (e, f) and (x - pu) ** 2 + (y - pv) ** 2 <= 400]
        want = (min(x for x, _ in near), min(y for _, y in near), max(x for x, _ in near), max(y for _, y in near), len(near)) if near else None
        assert got.get((e, step)) == want


def test_cloud_is_thinned_in_spread_order(spark, scene):
    pixels, _, rows, _ = scene
    camera = spark.createDataFrame([("a", K, T)], "episode_id string, K array<array<double>>, T array<array<double>>")
    for most in (1, 100, 5000):
        got = {(r.frame_index, r.x, r.y) for r in depth.point_cloud(pixels, camera, max_points=most).collect()}
        want = set()
        for f in (0, 1):
            order = sorted(((x * 7919 + y * 104729) % 1000003, y, x) for a, b, x, y, _ in rows if (a, b) == ("a", f))
            want |= {(f, x, y) for _, y, x in order[:most]}
        assert got == want


def test_frame_records(spark, blocking):
    """Repeated frame numbers: no row is multiplied, and 3D fields belong to contact frames only."""
    n = 40
    gripper = [min(1.0, i / 12) for i in range(n)]
    rows = [("a", i // 2, i, 0.0, 0.0, 1.0, gripper[i], "pick the cup.") for i in range(n)] + [("b", i, i, 0.0, 0.0, 1.0, gripper[i], "") for i in range(n)]
    frames = spark.createDataFrame(rows, "episode_id string, frame_index bigint, row bigint, x double, y double, z double, gripper double, instruction string")
    indexed = blocks.index_frames(frames.drop("instruction"), ties=("row",), episode_values=gripper_values())
    episodes = spark.createDataFrame([("a", n, "pick the cup."), ("b", n, "")], "episode_id string, n_steps bigint, instruction string")
    camera = spark.createDataFrame([("a", K, T)], "episode_id string, K array<array<double>>, T array<array<double>>")
    pixels = spark.createDataFrame([("a", f, x, y, 1.0) for f in range(n) for x in range(45, 56) for y in range(45, 56)], PIXELS)
    records, trajectories = annotate.annotate(indexed, episodes, camera, pixels)
    got = records.collect()
    assert len(got) == 2 * n and trajectories.count() == 2
    touching = 0
    for r in got:
        if r.episode_id == "a" and r.phase == "contact":
            touching += 1
            assert len(r.contact_patch_xyz) == 32 and np.allclose(np.array(r.contact_patch_xyz)[:, 2], 1.0)
            assert np.allclose(r.surface_normal, [0.0, 0.0, -1.0]) and abs(r.deprojection_err_mm) < 1e-6
            assert np.array([[c is not None for c in line] for line in r.depth_patch_32x32]).sum() == 121
        else:
            assert r.contact_patch_xyz == [] and r.surface_normal == [] and r.depth_patch_32x32 == [] and r.deprojection_err_mm == -1.0
    assert touching > 5


def test_masks(spark):
    """Runs, pixels and boxes of dense masks; an empty mask has a box of nulls."""
    r = np.random.default_rng(6)
    arrays = {"a": (r.random((3, 2, 6, 9)) < 0.4).astype(float), "b": np.zeros((1, 1, 2, 3)), "c": np.full((2, 1, 1, 1), float("nan"))}
    arrays["a"][1, 0] = 0
    rows = [(k, v.tolist()) for k, v in arrays.items()] + [("none", None), ("empty", []), ("blank", [[[]], [[[]]], [[[None, 2.0]]]])]
    videos = spark.createDataFrame(rows, "episode_id string, masks array<array<array<array<double>>>>")
    dense = masks.object_masks(videos)
    runs = masks.mask_runs(dense)
    pixels = {(p.episode_id, p.frame_index, p.obj_id, p.x, p.y) for p in masks.run_pixels(runs).collect()}
    want = {(k, f, o, x, y) for k, v in arrays.items() for f, o, y, x in zip(*(i.tolist() for i in np.nonzero(v)), strict=True)} | {("blank", 2, 0, 1, 0)}
    assert pixels == want
    boxes = {(b.episode_id, b.frame_index, b.obj_id): (b.x1, b.y1, b.x2, b.y2, b.pixels) for b in masks.run_boxes(runs, dense).collect()}
    assert len(boxes) == 6 + 1 + 2 + 3
    direct = {(b.episode_id, b.frame_index, b.obj_id): (b.x1, b.y1, b.x2, b.y2, b.pixels) for b in masks.mask_boxes(dense).collect()}
    assert direct == boxes
    for key, box in boxes.items():
        mine = [(x, y) for *k, x, y in want if tuple(k) == key]
        assert box == ((min(x for x, _ in mine), min(y for _, y in mine), max(x for x, _ in mine), max(y for _, y in mine), len(mine)) if mine else (None, None, None, None, 0))


def test_mask_records(spark):
    samples = spark.createDataFrame([("a", "work"), ("b", "empty"), ("c", "kept"), ("d", "work")], "episode_id string, state string")
    first = spark.createDataFrame([("a", 1, 5, "towel", 0.4, 1.5, 2.5, 3.5, 4.5), ("a", 0, 2, "cup", 0.9, 0.0, 0.0, 9.9, 9.9), ("b", 0, 2, "cup", 0.9, 0.0, 0.0, 9.9, 9.9)], "episode_id string, det_idx int, cls int, label string, score double, x1 double, y1 double, x2 double, y2 double")
    got = {r.episode_id: r for r in masks.mask_records(samples, first).collect()}
    assert set(got) == {"a", "b", "d"}
    assert (got["a"].cls_id_dict, got["a"].object_cls_list, got["a"].yoloe_conf_list) == ([2, 5], ["cup", "towel"], [0.9, 0.4])
    assert got["a"].first_frame_yoloe_bbox_list == [[0.0, 0.0, 9.9, 9.9], [1.5, 2.5, 3.5, 4.5]]
    assert all(got[k][c] == [] for k in "bd" for c in ("cls_id_dict", "object_cls_list", "yoloe_conf_list", "first_frame_yoloe_bbox_list"))
    boxes = spark.createDataFrame([("a", f, o, *((1, 2, 3, 4) if f != 2 else (None,) * 4)) for f in range(3) for o in range(2)], "episode_id string, frame_index bigint, obj_id bigint, x1 bigint, y1 bigint, x2 bigint, y2 bigint")
    lists = {r.frame_index: r.target_object_bbox_list for r in masks.frame_boxes(boxes, first).collect()}
    assert lists == {0: [[0, 0, 9, 9], [1, 2, 3, 4]], 1: [[1, 2, 3, 4]] * 2, 2: [None, None]}


def test_wanted_tiles_are_not_broadcast(spark, tmp_path, capsys):
    """A search of all frames multiplies its rows by tiles: however small its table looks, it is shuffled."""
    spark.range(300).selectExpr("id % 3 as episode_id", "id as frame_index", "id as pu", "id % 50 as pv").write.parquet(f"{tmp_path}/asked")
    spark.range(300).selectExpr("id % 3 as episode_id", "id as frame_index", "id as x", "id % 50 + 40 as y").write.parquet(f"{tmp_path}/pixels")
    asked, pixels = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("asked", "pixels"))
    found = detections.mask_contact_crop(pixels, asked)
    found.explain()
    assert "Broadcast" not in capsys.readouterr().out
    assert found.count() == 300


def test_masks_are_read_once(spark, capsys):
    """Boxes need no roster beside them, and a video in pieces is the same video."""
    r = np.random.default_rng(8)
    arrays = {e: (r.random((n, 2, 3, 70)) < 0.3).astype(int).tolist() for e, n in (("a", 5), ("b", 2))}
    kind = "masks array<array<array<array<int>>>>"
    whole = masks.object_masks(spark.createDataFrame(list(arrays.items()), f"episode_id string, {kind}"))
    pieces = [(e, i, v[i : i + 2]) for e, v in arrays.items() for i in range(0, len(v), 2)]
    cut = masks.object_masks(spark.createDataFrame(pieces, f"episode_id string, first_frame bigint, {kind}"))
    for step in (masks.mask_runs, masks.mask_boxes):
        one, other = (sorted(map(tuple, step(m).collect())) for m in (whole, cut))
        assert one == other and one
    masks.mask_boxes(cut).explain()
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and "Join" not in plan


def test_masked_patch_leaves_depth_where_it_lies(spark, request):
    """Depth dealt by pixel meets the mask there: one shuffle of pixels by tile, and none by frame."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.autoBroadcastJoinThreshold"))
    pixel = ["episode_id", "frame_index", "x", "y"]
    rows = spark.range(600).selectExpr("concat('e', id % 3) as episode_id", "id % 5 as frame_index", "id % 37 as x", "id % 23 as y")
    pixels = rows.groupBy(*pixel).agg(F.lit(1.0).alias("depth_m"))
    eye = F.array(*[F.array(*[F.lit(float(i == j)) for j in range(4)]) for i in range(4)])
    contacts = spark.range(2).selectExpr("concat('e', id) as episode_id", "id as frame_index", "9L as pu", "9L as pv").withColumns({"K": eye, "T": eye})
    patch = depth.contact_patch(contacts, pixels, rows.where("x < 30"), points=4)
    near = lambda e: sorted({((i % 37 - 9) ** 2 + (i % 23 - 9) ** 2, i % 23, i % 37) for i in range(600) if i % 3 == e and i % 5 == e and i % 37 < 30})[:4]
    got = {(r.episode_id, r["rank"]): (r.x, r.y) for r in patch.collect()}
    assert got == {(f"e{e}", k + 1): (x, y) for e in (0, 1) for k, (_, y, x) in enumerate(near(e))}
    plan = patch._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    dealt = [line for line in plan.splitlines() if "hashpartitioning" in line]
    assert len(dealt) < 14, len(dealt)
