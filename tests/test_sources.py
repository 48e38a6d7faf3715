import glob
import itertools
import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from gripline.functions.text import parse_int_like
from gripline.operators import documents, evaluate
from gripline.operators import phases as phases_module
from gripline.operators.blocks import index_frames, number_frames
from gripline.operators.signals import gripper_values
from gripline.plans import annotate as A
from gripline.sources import driver_tables as D
from gripline.sources import frames as S
from gripline.sources import manifests as M
from gripline.sources import sinks
from gripline.sources.session import checkpoint_folder
from gripline.streaming.incremental import commit_batch, compact, current, incremental_episodes, new_recordings, newest_delivery


RECORDED = {
    "frame_index": pa.int64(),
    "episode_index": pa.int64(),
    "observation.state": pa.list_(pa.float64()),
    "language_instruction": pa.string(),
    "annotation.instruction_add": pa.string(),
    "camera_view": pa.string(),
    "annotation.contact_frame": pa.string(),
}


@pytest.fixture()
def dataset(spark, tmp_path):
    """Three recordings in two folders, with meta data, cameras and one missing video."""
    root = tmp_path / "set"
    for e, chunk in ((0, "chunk-000"), (1, "chunk-000"), (2, "chunk-001")):
        rows = [(i, e, [float(i)] * 6 + [i / 10], "  pick up the cup " if e != 1 else None, "put it down" if e == 1 else None, "left", "89.0" if i == 2 else "-1") for i in range(5)]
        folder = root / "data" / chunk
        os.makedirs(folder, exist_ok=True)
        table = pa.table({n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate(RECORDED.items())})
        pq.write_table(table, folder / f"episode_{e:06d}.parquet")
        if e != 2:
            video = root / "videos" / chunk / "observation.images.primary"
            os.makedirs(video, exist_ok=True)
            (video / f"episode_{e:06d}.mp4").write_bytes(b"x")
    os.makedirs(root / "meta" / "calibration")
    (root / "meta" / "episodes.jsonl").write_text("".join(json.dumps({"episode_index": e, "length": 5}) + "\n" for e in range(3)))
    eye = [[1.0 if i == j else 0.0 for j in range(4)] for i in range(4)]
    (root / "meta" / "calibration" / "episode_000001_calib.json").write_text(json.dumps({"intrinsics": [r[:3] for r in eye[:3]], "extrinsics": eye}, indent=1))
    return str(root)


def test_scan(spark, dataset):
    rows = S.scan_frames(spark, f"{dataset}/data")
    assert {"state", "instruction_add", "contact_text", "camera_view"} <= set(rows.columns) and not S.has_depth(rows)
    assert {(r.episode_id, r.chunk, r["count"]) for r in rows.groupBy("episode_id", "chunk").count().collect()} == {
        ("episode_000000", "chunk-000", 5),
        ("episode_000001", "chunk-000", 5),
        ("episode_000002", "chunk-001", 5),
    }
    split = S.split_state(rows).where("frame_index = 3").first()
    assert split.cart == [3.0] * 6 and split.gripper == 0.3
    bare = S.split_state(rows.drop("state")).first()
    assert bare.cart == [0.0] * 6 and bare.gripper == 0.0
    # only the wanted columns reach the files
    plan = rows.select("episode_id", "frame_index")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<frame_index:bigint>" in plan


def test_first_episodes(spark, dataset):
    paths = S.first_episodes(spark, f"{dataset}/data", 2)
    assert [os.path.basename(p) for p in paths] == ["episode_000000.parquet", "episode_000001.parquet"]
    assert S.first_episodes(spark, dataset, 0) is None and S.first_episodes(spark, f"{dataset}/data", 0, zero_means_all=False) == []


def test_side_tables(spark, dataset):
    assert S.scan_episode_meta(spark, dataset).count() == 3
    episodes = S.scan_frames(spark, f"{dataset}/data").select("episode_id").distinct()
    joined = {r.episode_id: (r.has_camera_calib, r.K) for r in S.calibration_join(episodes, S.scan_calibration(spark, dataset)).collect()}
    assert joined["episode_000001"][0] and joined["episode_000001"][1][1] == [0.0, 1.0, 0.0] and joined["episode_000000"] == (False, None)


def test_transform(spark):
    eye = [[float(i == j) for j in range(4)] for i in range(4)]
    moved = [r[:] for r in eye]
    moved[0][3] = 7.0
    docs = [None, json.dumps(moved), json.dumps({"T_robot_to_world": moved}), json.dumps({"T_robot_to_da3": moved, "T_robot_to_world": eye}), json.dumps({"R": [r[:3] for r in eye[:3]], "t": [7.0, 0, 0]})]
    rows = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, d string")
    got = [r.m for r in rows.select("i", S.transform_of(F.col("d")).alias("m")).orderBy("i").collect()]
    assert got == [eye, moved, moved, moved, moved]
    bad = spark.createDataFrame([("[[1, 2], [3, 4]]",)], "d string")
    with pytest.raises(Exception, match="4x4"):
        bad.select(S.transform_of(F.col("d"))).collect()


def test_manifest(spark, dataset):
    first = M.first_rows(S.scan_frames(spark, f"{dataset}/data"), ["episode_index", "language_instruction", "instruction_add", "camera_view"], keys=("episode_id", "chunk"))
    values = M.template_values(F.col("episode_id"), F.col("episode_id"), F.col("episode_index"), F.col("chunk"), F.col("camera_view"))
    rows = M.episode_manifest(first, M.video_path(values, videos_root=f"{dataset}/videos"))
    got = {r.episode_id: r for r in rows.collect()}
    assert got["episode_000000"].text == "<__dj__video> pick up the cup" and got["episode_000001"].language_instruction == "put it down"
    present = S.list_files(spark, f"{dataset}/videos", "*.mp4").select(F.regexp_replace("path", "^file:", "").alias("path"))
    assert [r.episode_id for r in M.missing_videos(rows, present).collect()] == ["episode_000002"]
    named = first.select(M.render_path(M.video_path(values, "v/{camera_view}/{episode_index_06d}.mp4")).alias("p")).distinct().collect()
    assert sorted(r.p for r in named) == [f"./v/left/{i:06d}.mp4" for i in range(3)]


def _records(spark, size=30):
    rows = [("e", i, float(i % 9), i / 50 - 0.3, 0.1, 0.5) for i in range(size)]
    raw = spark.createDataFrame(rows, "episode_id string, frame_index bigint, gripper double, x double, y double, z double")
    episodes = spark.createDataFrame([("e", size, "pick up the cup")], "episode_id string, n_steps bigint, instruction string")
    none = spark.createDataFrame([], "episode_id string, K array<array<double>>, T array<array<double>>")
    return A.annotate(index_frames(raw, episode_values=gripper_values()), episodes, none)


def test_records(spark, tmp_path, blocking):
    frames, trajectory = _records(spark)
    rows = frames.orderBy("frame_index").collect()
    assert len(rows) == 30 and all(abs(r.annotation_confidence - 0.875) < 1e-12 and r.annotation_valid for r in rows)
    u = lambda i: int((i / 50 - 0.3 + 1) / 2 * 320)
    assert rows[12].contact_point_2d == [u(12), 99] and rows[12].affordance_box_2d == [u(12) - 20, 79, u(12) + 20, 119]
    assert [tuple(p) for p in rows[12].ee_trace_2d] == [(u(i), 99) for i in range(12, 7, -1)]
    assert len(rows[12].ee_trace_3d) == 10 and rows[12].ee_trace_3d[0].x == rows[12].contact_point_3d[0]
    only = trajectory.first()
    assert (only.task_verb, only.num_frames, only.num_valid_frames) == ("pick", 30, 30)


def written_text(path):
    """All lines of the files in their order."""
    return "".join(line for name in sorted(glob.glob(f"{path}/part-*")) for line in open(name, encoding="utf-8").read().split("\n"))


def test_phase_documents(spark, tmp_path, blocking):
    """Documents read as JSON equal plain loops, also where ranges of lines cut an episode."""
    r = np.random.default_rng(9)
    series = {"a": r.integers(0, 10, 50), "b": r.integers(0, 3, 7), "c": np.array([4]), "d": np.repeat([0, 5, 9, 9, 6, 0], 4)}
    rows = [(e, i // 2 * 3, i, float(g), [float(i)] * 6, [i + 0.5] * 6, "7.0" if i == 2 else "") for e, v in series.items() for i, g in enumerate(v)]
    frames = spark.createDataFrame(rows, "episode_id string, frame_index bigint, row bigint, gripper double, gripper_pose array<double>, tcp_pose array<double>, contact_text string")
    values = gripper_values() | {"gt": evaluate.earliest(parse_int_like(F.col("contact_text")), "row")}
    indexed, episodes = number_frames(frames, ties=("row",), episode_values=values)
    labels = episodes.select("episode_id", F.col("n_steps").alias("num_frames"), F.col("gt")["value"].alias("gt_contact_frame"), "gripper_min", "gripper_max", F.lit("x.mp4").alias("video"))
    documents.write_documents(documents.phase_document(indexed.drop("gt"), labels, sources=("video",)), f"{tmp_path}/docs", files=7)
    text, found = written_text(f"{tmp_path}/docs"), {}
    while text:
        one, end = json.JSONDecoder().raw_decode(text)
        found[one["episode_id"]], text = one, text[end:]
    assert set(found) == set(series)
    phases = {}
    for row in phases_module.grasp_phases(indexed).collect():
        phases.setdefault(row.episode_id, {})[row.step] = row.phase
    for e, v in series.items():
        doc, names = found[e], [phases[e][i] for i in range(len(v))]
        norm = (v - v.min()) / (v.max() - v.min() + 1e-6)
        runs = [(len(list(g)), n) for n, g in itertools.groupby(names)]
        starts = np.cumsum([0, *(n for n, _ in runs)]).tolist()
        spans = [(a, b - 1, n) for a, b, (_, n) in zip(starts, starts[1:], runs)]
        assert [(p["start_step"], p["end_step"], p["phase"]) for p in doc["phases"]] == spans
        assert doc["phase_ranges"] == {n: [[a, b] for a, b, m in spans if m == n] for n in (*phases_module.GRASP, "transition")}
        assert [(f["step_index"], f["frame_index"], f["robo2vlm_phase"], f["gripper_position_raw"]) for f in doc["frames"]] == [(i, i // 2 * 3, n, float(g)) for i, (n, g) in enumerate(zip(names, v))]
        assert np.allclose([f["gripper_position_normalized"] for f in doc["frames"]], norm)
        assert doc["video"] == "x.mp4" and doc["parquet_frame_count"] == len(v) and doc["reference_annotation_contact_frame_index"] == (7 if len(v) > 2 else None)
        first = next((i for i, n in enumerate(names) if n == "contact"), None)
        if first is None:
            assert doc["first_contact_frame_index"] is None and doc["contact_pose"] is None
        else:
            number = first // 2 * 3
            same = [i for i in range(len(v)) if i // 2 * 3 == number]
            pose = doc["contact_pose"]
            assert doc["first_contact_frame_index"] == pose["frame_index"] == number
            assert pose["gripper_pose6d"] == [float(same[-1])] * 6 and pose["tcp_pose6d"] == [same[-1] + 0.5] * 6 and pose["gripper_position_raw"] == v[same[-1]]
            assert np.isclose(pose["gripper_position_normalized"], norm[same[0]])
    assert any(d["contact_pose"] for d in found.values())


def test_documents_and_files(spark, tmp_path):
    frames, trajectory = _records(spark)
    documents.write_documents(sinks.export_nested(frames, trajectory), f"{tmp_path}/docs", files=3)
    only = json.loads(written_text(f"{tmp_path}/docs"))
    assert only["trajectory"]["task_object"] == "cup" and [f["frame_index"] for f in only["frames"]] == list(range(30))
    assert set(sinks.FRAME_FIELDS) < set(only["frames"][0])
    sinks.write_frames(frames, f"{tmp_path}/frames")
    assert spark.read.parquet(f"{tmp_path}/frames").count() == 30
    sinks.write_csv(trajectory, f"{tmp_path}/csv")
    assert spark.read.csv(f"{tmp_path}/csv", header=True).first().task_verb == "pick"


def test_single_recordings(spark, tmp_path):
    """Videos of recordings given as single files, with real files; paths in records below a base and absolute."""
    for name in ("data/one.mp4", "videos/b/two.mp4", "videos/a-c/two.mp4", "videos/a/z/two.mp4", "videos/a/one.mp4", "other/three.mp4"):
        os.makedirs(os.path.dirname(f"{tmp_path}/{name}"), exist_ok=True)
        with open(f"{tmp_path}/{name}", "w") as out:
            out.write("x")
    listing = M.list_files(spark, str(tmp_path))
    assert listing.count() == 6
    rows = spark.createDataFrame([(f"file://{tmp_path}/data/{n}.parquet",) for n in ("one", "two", "three")], "path string")
    got = [r.video for r in M.single_file_videos(rows, listing, f"{tmp_path}/videos/").orderBy("video").collect()]
    assert got == [f"{tmp_path}/{n}" for n in ("data/one.mp4", "data/three.mp4", "videos/a/z/two.mp4")]
    assert {r.video for r in M.single_file_videos(rows, listing).collect()} == {f"{tmp_path}/data/{n}.mp4" for n in ("one", "two", "three")}


def test_rendered_paths(spark):
    """As Python's path rules have it, without looking at links."""
    paths = ["/a/b/c.mp4", "/a/b", "/a/bc/d.mp4", "b/c.mp4", "./b/c.mp4", "../x.mp4", "/a/./b//e/../c.mp4", "/"]
    frame = spark.createDataFrame([(i, p) for i, p in enumerate(paths)], "i int, p string")
    for base, here in (("/a/b", "/a"), ("b", "/a"), ("/a/b/", "/"), ("/", "/a"), (None, "/a")):
        got = {r.i: (r.r, r.w) for r in frame.select("i", M.render_path(F.col("p"), base, here=here).alias("r"), M.render_path(F.col("p"), base, True, here).alias("w")).collect()}
        for i, p in enumerate(paths):
            whole = os.path.normpath(os.path.join(here, p))
            top = None if base is None else os.path.normpath(os.path.join(here, base))
            shown = p if top is None or os.path.commonpath([whole, top]) != top else os.path.relpath(whole, top)
            assert got[i] == (shown if shown[0] in "./" else f"./{shown}", whole), (p, base, here)


def test_two_drops(spark, tmp_path):
    """A second run works on new recordings only, a third finds nothing; a repeated batch changes nothing, and a recording that
    comes again replaces its older rows, before and after compaction."""
    root, out, state = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state"

    def drop(folder, e, n):
        os.makedirs(f"{root}/{folder}", exist_ok=True)
        spark.createDataFrame([(i, float(n)) for i in range(n)], "frame_index bigint, gripper double").toPandas().to_parquet(f"{root}/{folder}/episode_{e:06d}.parquet")

    seen = []

    def annotate(batch):
        rows = batch.groupBy("episode_id").agg(F.count(F.lit(1)).alias("n"), F.max("gripper").alias("g"))
        seen.append(sorted(r.episode_id for r in rows.collect()))
        return rows

    def run():
        incremental_episodes(new_recordings(spark, root, "frame_index bigint, gripper double"), annotate, out, state).awaitTermination()
        return result()

    result = lambda: sorted((int(r.episode_id[-2:]), r.n, r.g, r.batch) for r in current(spark, out).collect())
    drop("one", 0, 3)
    drop("one", 1, 2)
    assert run() == [(0, 3, 3.0, 0), (1, 2, 2.0, 0)]
    first = spark.createDataFrame([("episode_000000", 3.0)] * 3 + [("episode_000001", 2.0)] * 2, "episode_id string, gripper double")
    commit_batch(first, 0, annotate, out)  # the batch again, as after a lost driver
    assert result() == [(0, 3, 3.0, 0), (1, 2, 2.0, 0)]
    drop("two", 2, 4)
    drop("two", 1, 7)
    assert run() == run() == [(0, 3, 3.0, 0), (1, 7, 7.0, 1), (2, 4, 4.0, 1)]
    assert len(seen) == 3 and seen[-1] == ["episode_000001", "episode_000002"]
    # rows that never made it into the log do not count
    spark.createDataFrame([("episode_000009", 1, 1.0, 5)], "episode_id string, n bigint, g double, batch bigint").write.parquet(f"{out}/rows/part=batch-000000000005")
    gone = compact(spark, out)
    assert result() == [(0, 3, 3.0, 0), (1, 7, 7.0, 1), (2, 4, 4.0, 1)] and len(gone) == 4
    drop("three", 0, 1)
    assert run() == [(0, 1, 1.0, 2), (1, 7, 7.0, 1), (2, 4, 4.0, 1)]
    assert len(compact(spark, out)) == 4 and run() == [(0, 1, 1.0, 2), (1, 7, 7.0, 1), (2, 4, 4.0, 1)]


def test_newest_of_one_batch(spark):
    """Of two files of one episode in a batch, the later one counts."""
    rows = spark.createDataFrame([("a", (1, "x"), 5), ("a", (2, "w"), 6), ("a", (2, "w"), 7), ("b", (1, "y"), 8)], "episode_id string, delivery struct<at:int,path:string>, v int")
    assert sorted(r.v for r in newest_delivery(rows).collect()) == [6, 7, 8]


def test_checkpoint_folder_is_kept(spark):
    named = checkpoint_folder(spark)
    assert checkpoint_folder(spark) == named and spark.sparkContext.getCheckpointDir()


def test_test_tables_are_whole(spark):
    """Every event is a frame of the test recordings."""
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("no test tables here")
    assert D.frames(spark, folder).count() == D.table(spark, folder, "events").count()


def test_detector_boxes_are_cut_to_whole_pixels(spark):
    from gripline.operators.detections import frame_zero_override

    kind = "episode_id string, frame_index bigint, obj_id string, x1 double, y1 double, x2 double, y2 double"
    masks = spark.createDataFrame([("a", 0, "m", 1.0, 1.0, 2.0, 2.0), ("a", 1, "m", 3.0, 3.0, 4.0, 4.0)], kind)
    boxes = spark.createDataFrame([("a", 0, "d", 1.9, -0.5, 7.0, float("nan")), ("b", 0, "d", 1.0, 1.0, 2.0, 2.0)], kind)
    got = sorted((r.frame_index, r.source, r.x1, r.y1, r.x2, r.y2) for r in frame_zero_override(masks, boxes).collect())
    assert got == [(0, "detector", 1.0, 0.0, 7.0, None), (1, "mask", 3.0, 3.0, 4.0, 4.0)]


def test_drops_of_many_batches(spark, monkeypatch):
    """A drop of more files than a batch takes is still one drop."""
    from functools import partial

    from gripline.plans import source_queries
    from gripline.streaming import incremental

    monkeypatch.setattr(source_queries, "new_recordings", partial(incremental.new_recordings, files_per_batch=9))
    got = {r.episode_id: r.batch for r in source_queries.incremental(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) > 9 and set(got.values()) == {0, 1}
    assert all(b == int(int(e) % 3 == 0 or int(e) % 5 == 1) for e, b in got.items())


def test_driver_holds_one_folder_at_a_time(spark, tmp_path, monkeypatch):
    """Many recordings: no stage has a task for each of them, and no stream remembers more than those of its folder."""
    from gripline.plans import source_queries

    monkeypatch.setattr(source_queries, "USERS_PER_FOLDER", 40, raising=False)
    rows = [(i, i % 200 * 7) for i in range(600)]
    spark.createDataFrame(rows, "event_id bigint, user_id bigint").write.parquet(f"{tmp_path}/events.parquet")
    home, tracker = checkpoint_folder(spark), spark.sparkContext.statusTracker()
    known, before = set(os.listdir(home.removeprefix("file:"))), spark._jsc.sc().dagScheduler().nextStageId()
    got = {r.episode_id: (r.num_frames, r.events, r.batch) for r in source_queries.incremental(spark, str(tmp_path)).collect()}
    assert got == {str(u): (3, sum(e for e, v in rows if v == u), int(u % 3 == 0 or u % 5 == 1)) for u in range(0, 1400, 7)}
    stages = [tracker.getStageInfo(i) for i in range(before, spark._jsc.sc().dagScheduler().nextStageId())]
    assert max(s.numTasks for s in stages if s) <= 64
    (base,) = (f"{home.removeprefix('file:')}/{f}" for f in os.listdir(home.removeprefix("file:")) if f.startswith("stream-") and f not in known)
    remembered = {}
    for folder, _, names in os.walk(f"{base}/state"):
        if "/sources/" in folder:
            logs = [open(f"{folder}/{n}").read() for n in names if not n.startswith(".")]
            remembered[folder] = sum(log.count('"path"') for log in logs)
    assert sum(remembered.values()) >= 200 and max(remembered.values()) < 80


def test_folders_of_a_run(spark, tmp_path):
    """Of two deliveries in folders of one run the newer counts, whichever folder is worked on first; a later run has the say over both."""
    from gripline.streaming.incremental import next_run, recording_folders

    root, out, state = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state"
    annotate = lambda batch: batch.groupBy("episode_id").agg(F.count(F.lit(1)).alias("n"))

    def put(folder, e, n, at):
        os.makedirs(f"{root}/{folder}", exist_ok=True)
        path = f"{root}/{folder}/episode_{e}.parquet"
        spark.createDataFrame([(i,) for i in range(n)], "frame_index bigint").toPandas().to_parquet(path)
        os.utime(path, (1700000000 + at, 1700000000 + at))

    def run():
        number = next_run(spark, out)
        for folder in recording_folders(spark, root, 2):
            incremental_episodes(new_recordings(spark, f"{root}/{folder}", "frame_index bigint"), annotate, out, state, folder, number).awaitTermination()
        return result()

    result = lambda: sorted((r.episode_id[-1], r.n, r.batch) for r in current(spark, out).collect())
    put("a/one", 0, 3, 50)
    put("a/two", 0, 5, 20)
    put("b/one", 1, 2, 10)
    put("b/one", 2, 4, 10)
    assert recording_folders(spark, root, 2) == ["a/one", "a/two", "b/one"]
    assert run() == run() == [("0", 3, 0), ("1", 2, 0), ("2", 4, 0)]
    assert len(compact(spark, out)) == 6 and result() == [("0", 3, 0), ("1", 2, 0), ("2", 4, 0)]
    put("a/three", 1, 7, 0)  # copied late, written early
    assert run() == run() == [("0", 3, 0), ("1", 7, 1), ("2", 4, 0)]
    put("a", 9, 1, 0)
    with pytest.raises(ValueError, match="above the folders"):
        recording_folders(spark, root, 2)
