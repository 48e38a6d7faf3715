"""Subtask and grounding records, and frames chosen for a model, against small loops."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gripline.operators import grounding, segments, signals

POSES = "episode_id long, frame_index long, step long, x double, z double"


def chosen(numbers, most):
    """The frames left when a sorted list is thinned evenly."""
    if most <= 0 or len(numbers) <= most:
        return numbers
    return sorted({numbers[i] for i in np.linspace(0, len(numbers) - 1, most, dtype=int)})


@pytest.mark.parametrize("most", [1, 2, 3, 7, 8, 50])
def test_places_without_lists(spark, most):
    rows = [(last, place) for last in (0, 1, 2, 5, 6, 7, 13, 49, 50, 99, 333) for place in range(last + 1)]
    frame = spark.createDataFrame(rows, "last long, place long")
    got = frame.where(signals.in_uniform_numbers(F.col("place"), F.col("last"), most)).collect()
    want = {(last, int(i)) for last, _ in rows for i in np.linspace(0, last, most, dtype=int)}
    assert {(r.last, r.place) for r in got} == want


@pytest.mark.parametrize("most", [0, 1, 3, 5, 20])
def test_uniform_with_a_maximum(spark, most):
    rows = [(e, e, e + span) for e, span in enumerate((0, 1, 4, 11, 12, 40, 1000))]
    got = signals.uniform_frames(spark.createDataFrame(rows, "episode_id long, first_frame long, last_frame long"), 12, max_frames=most).collect()
    for e, first, last in rows:
        picked = sorted({int(v) for v in np.linspace(first, last, 12, dtype=int)}) if first < last else [first]
        assert sorted(r.frame_index for r in got if r.episode_id == e) == chosen(picked, most), (e, most)


def test_subtask_records(spark):
    """Poses at segment ends and at the goal; repeated frame numbers give their last row; an episode without frames has none."""
    episodes = spark.createDataFrame([(1, 0, 9, "lift"), (2, 3, 5, " pour "), (3, 0, 2, "push")], "episode_id long, first_frame long, last_frame long, task_instruction string")
    parts = spark.createDataFrame([(1, 0, 0, 5, "a"), (1, 1, 4, 8, "b"), (2, 0, None, 4, "c")], "episode_id long, pos long, start long, end long, text string")
    poses = [(1, i, i, float(i), -float(i)) for i in range(10)] + [(1, 9, 10, 77.0, None)] + [(2, i, i, float(10 + i), 0.0) for i in range(3, 5)]
    whole = segments.fallback_segments(segments.normalize_segments(parts, episodes), episodes)
    got = {r.episode_id: r for r in segments.subtask_records(whole, episodes, spark.createDataFrame(poses, POSES), ["x", "z"], samples=4, max_frames=3).collect()}
    assert [(s.start_frame, s.end_frame, s.pose and s.pose.x) for s in got[1].subtask_segments] == [(0, 5, 5.0), (6, 9, 77.0)]
    assert (got[1].goal_frame, got[1].goal_pose.x, got[1].goal_pose.z, got[1].segment_source) == (9, 77.0, None, "vlm")
    assert got[1].shown_frames == chosen([0, 3, 6, 9], 3) and got[2].shown_frames == [3, 4, 5]
    assert got[2].goal_pose is None and got[2].segment_source == "single_segment_fallback" and got[2].task_instruction == "pour"
    assert [s.pose for s in got[3].subtask_segments] == [None] and got[3].goal_pose is None
    none = spark.createDataFrame([], POSES)
    assert segments.subtask_records(whole.limit(0), episodes.limit(0), none, ["x"]).count() == 0
    goals = {r.episode_id: (r.goal_frame, r.x) for r in segments.goal_pose(episodes, spark.createDataFrame(poses, POSES), ["x"]).collect()}
    assert goals == {1: (9, 77.0), 2: (5, None), 3: (2, None)}


@pytest.mark.parametrize("text", [None, "", " ", "[]"])
def test_missing_instruction_raises(spark, text):
    rows = spark.createDataFrame([(4, text)], "episode_id long, task_instruction string")
    with pytest.raises(Exception, match="no task instruction in episode 4"):
        segments.with_instruction(rows).collect()


def test_confidence_of_any_type(spark):
    values = {'"high"': (None, "high"), "0.5": (0.5, "0.5"), '"0.25"': (0.25, "0.25"), "[0, 1]": (None, "[0,1]"), '{"p": 1}': (None, '{"p":1}'), "null": (None, None)}
    rows = spark.createDataFrame([(i, f'{{"object": "cup", "confidence": {v}}}') for i, v in enumerate(values)], "episode_id long, raw_text string")
    got = grounding.grounding_record(rows, F.lit(10), F.lit(10)).orderBy("episode_id").collect()
    assert [(r.confidence, r.confidence_text) for r in got] == list(values.values())
    assert grounding.empty_grounding(rows, grounding.DISABLED).columns == ["episode_id", "target_object", "bbox_xyxy", "center_xy", "frame_size", "confidence", "confidence_text", "error"]


def test_numbers_as_python_spells_them(spark):
    from gripline.functions.text import parse_trace, parse_vector

    texts = {
        "[True, 2]": [1.0, 2.0], "[1_0, 2]": [10.0, 2.0], "(False, -1_000.5)": [0.0, -1000.5], "['1_0', 2]": [10.0, 2.0], "True, 3": [1.0, 3.0],
        "['True', 2]": None, "[Truex, 2]": None, "[1__0, 2]": None, "[_1, 2]": None, "[1_, 2]": None, "[true, 2]": None,
    }
    got = spark.createDataFrame(list(enumerate(texts)), "i long, t string").select("i", parse_vector(F.col("t")).alias("v")).orderBy("i").collect()
    assert [r.v for r in got] == list(texts.values())
    trace = spark.createDataFrame([("[[True, 1_0], (2, False)]",)], "t string").select(parse_trace(F.col("t")).alias("v")).first()
    assert [list(p) for p in trace.v] == [[1.0, 10.0], [2.0, 0.0]]


def test_smoothed_pixels(spark):
    """Projecting each smoothed point once gives the traces that projecting whole windows gives; points behind the camera stay as null."""
    from gripline.functions import geometry as G
    from gripline.operators import blocks

    matrix = lambda rows: F.array(*[F.array(*[F.lit(float(v)) for v in r]) for r in rows])
    camera = G.camera_rows(matrix(((300, 0, 160), (0, 290, 90), (0, 0, 1))), matrix(((1, 0, 0, 0), (0, 1, 0, 0), (0, 0, 1, 0.2))))
    r = np.random.default_rng(5)
    rows = [(e, i, *map(float, r.uniform(-1, 1, 3)), 0.5) for e, n in ((1, 45), (2, 3), (3, 1)) for i in range(n)]
    indexed = blocks.index_frames(spark.createDataFrame(rows, "episode_id long, frame_index long, x double, y double, z double, gripper double"))
    once = {(r.episode_id, r.step): r.trace_2d for r in signals.smoothed_trace_2d(indexed, camera).collect()}
    whole = signals.smoothed_trace(indexed).withColumn("t", G.project_trace(F.col("trace"), camera)).collect()
    assert len(once) == len(whole) == 49 and any(p is None for t in once.values() for p in t)
    assert all(once[w.episode_id, w.step] == w.t for w in whole)
