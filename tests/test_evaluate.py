import math

import numpy as np
import random
import statistics

import pytest

from gripline.operators import evaluate as EV
from gripline.operators import segments as SG
from gripline.operators.blocks import index_frames
from gripline.operators.signals import gripper_values

# published per-episode results at thresholds 0.4 and 0.9
PUBLISHED = [
    ("episode_000000", 240, 89, 85, 0.012806266084079445, 0.040501624001807617, 0.04247801781863229),
    ("episode_000001", 104, 51, 55, 0.007110095281811209, 0.028077345128568788, 0.02896361103842543),
    ("episode_000002", 113, 62, 57, 0.010868731817790998, 0.020966207648246898, 0.023615909774481886),
    ("episode_000003", 104, 54, 55, 0.0008251403367046008, 0.0031827394046981053, 0.003287960871645986),
    ("episode_000004", 113, 63, 57, 0.015384392650022354, 0.03144956516595527, 0.035010779573407515),
    ("episode_000005", 126, 75, 74, 0.008598734517444511, 0.02088432932334534, 0.02258524842872962),
    ("episode_000006", 126, 73, 74, 0.00598483237144201, 0.01772257793651134, 0.018705827627506322),
    ("episode_000007", 138, 86, 86, 5.7657724814876965e-06, 6.570471930856704e-06, 8.741580732479488e-06),
    ("episode_000008", 138, 86, 86, 5.7657724814876965e-06, 6.570471930856704e-06, 8.741580732479488e-06),
    ("episode_000009", 154, 49, 61, 0.022821437471970976, 0.03243743083907827, 0.03966112615303639),
]
SUMMARY = {
    "mae_frames": 3.4,
    "median_abs_error_frames": 2.5,
    "rmse_frames": 4.898979485566356,
    "mean_signed_error_frames": 0.2,
    "max_abs_error_frames": 12.0,
    "mean_normalized_abs_error": 0.025588381628204638,
    "within_0_frames": 0.2,
    "within_1_frames": 0.5,
    "within_3_frames": 0.5,
    "within_5_frames": 0.8,
    "within_10_frames": 0.9,
    "mean_tcp_position_l2_m": 0.008441116207622907,
    "median_tcp_position_l2_m": 0.00785441489962786,
    "mean_tcp_rotation_l2_rad": 0.019523496039207337,
    "mean_tcp_pose6d_l2": 0.021432596444733037,
}
BY = ["grasp_threshold", "contact_threshold"]


@pytest.fixture(scope="module")
def errors(spark):
    rows = [(e, 0.4, 0.9, n, g, p, p - g, abs(p - g), abs(p - g) / n, a, b, c, 0.0, 1.0) for e, n, g, p, a, b, c in PUBLISHED]
    return spark.createDataFrame(
        rows,
        "episode_id string, grasp_threshold double, contact_threshold double, num_frames bigint, gt_contact_frame bigint, pred_contact_frame bigint, frame_error bigint, abs_frame_error bigint,"
        " normalized_abs_frame_error double, tcp_position_l2_error double, tcp_rotation_l2_error double, tcp_pose6d_l2_error double, gripper_min double, gripper_max double",
    )


def test_published_summary(errors):
    got = EV.summarize(errors, BY).first()
    assert got.num_episodes == got.num_with_gt_and_prediction == 10
    for name, value in SUMMARY.items():
        assert got[name] == pytest.approx(value, rel=1e-12), name


def test_report(errors):
    rows = EV.report_rows(errors, BY).collect()
    assert len(rows) == 10 + 1 + 17
    mean = next(r for r in rows if r.episode_id == "MEAN")
    assert (mean.num_frames, mean.gt_contact_frame, mean.pred_contact_frame) == (135.6, 68.8, 69.0)
    lines = {r.metric: r.value for r in rows if r.episode_id == "SUMMARY"}
    assert lines["evaluated_episodes"] == 10 and lines["contact_frame_mae_frames"] == 3.4
    assert {r.tag for r in rows} == {"grasp_0.4__contact_0.9"}


def test_median(spark):
    rng = random.Random(1)
    rows = [(g, rng.choice([rng.random(), rng.random() ** 9 * 1e6, 3.0])) for g in "ab" for _ in range(301 if g == "a" else 200)]
    rows += [("same", 2.0)] * 50 + [("one", 7.0), ("none", None)]
    table = spark.createDataFrame(rows, "g string, v double")
    want = {g: statistics.median(v for k, v in rows if k == g and v is not None) for g in ("a", "b", "same", "one")}
    for ranked in (1 << 20, 3):
        got = {r.g: r.m for r in EV.exact_median(table, ["g"], "v", "m", ranked=ranked, buckets=5).collect()}
        assert got == want
    whole = EV.exact_median(table, [], "v", "m").first().m
    assert whole == statistics.median(v for _, v in rows if v is not None)


def test_lookup_takes_the_last_row(spark):
    frames = spark.createDataFrame([("e", 3, 0, "first"), ("e", 3, 5, "last"), ("e", 4, 6, "other")], "episode_id string, frame_index bigint, step bigint, name string")
    wanted = spark.createDataFrame([("e", 3), ("e", 9)], "episode_id string, frame_index bigint")
    assert {(r.frame_index, r.name) for r in EV.frame_lookup(wanted, frames, ["name"]).collect()} == {(3, "last"), (9, None)}


def sweep(segments, first, last):
    """Segments of one episode one after the other, as (start, end)."""
    fit = lambda f: max(first, min(last, f))
    tidy = sorted((min(fit(a), fit(b)), max(fit(a), fit(b)), i) for i, (a, b) in enumerate(segments))
    out, free = [], first
    for a, b, _ in tidy:
        a = max(a, free)
        b = max(a, b)
        if a > last:
            break
        out.append([a, min(b, last)])
        free = min(b + 1, last + 1)
    if out:
        out[0][0], out[-1][1] = first, last
    return out


@pytest.mark.parametrize("size", [None, 4])
def test_segments(spark, size):
    rng = random.Random(9)
    plans = {i: [(rng.randint(-5, 45), rng.randint(-5, 45)) for _ in range(rng.randint(0, 9))] for i in range(60)}
    plans[100] = [(rng.randint(0, 40), rng.randint(0, 40)) for _ in range(80)]
    plans[101] = [(5, 9)] * 60
    ends = {i: (rng.randint(0, 3), rng.randint(4, 40)) for i in plans}
    rows = [(i, k, a, b, "x" if k % 2 else " ") for i, p in plans.items() for k, (a, b) in enumerate(p)] + [(0, 90, None, 4, "bad")]
    segments = spark.createDataFrame(rows, "episode_id bigint, pos bigint, start bigint, end bigint, text string")
    episodes = spark.createDataFrame([(i, *e, f"do {i}") for i, e in ends.items()], "episode_id bigint, first_frame bigint, last_frame bigint, task_instruction string")
    clean = SG.normalize_segments(segments, episodes, size)
    got = {}
    for r in clean.orderBy("episode_id", "segment_index").collect():
        got.setdefault(r.episode_id, []).append([r.start_frame, r.end_frame])
        assert r.segment_id == f"segment_{r.segment_index:03d}" and r.subtask_instruction in ("x", SG.DEFAULT_TEXT)
    assert got == {i: s for i, p in plans.items() if (s := sweep(p, *ends[i]))}
    whole = SG.fallback_segments(clean, episodes)
    bare = {i for i in plans if i not in got}
    assert {r.episode_id for r in whole.where("instruction_source = 'single_segment_fallback'").collect()} == bare and bare


def test_contact_pass_shares_frames(spark):
    """A sweep reads the frames once, however many pairs it has."""
    from gripline.operators.blocks import index_frames
    from gripline.operators.signals import gripper_values

    raw = spark.createDataFrame([("e", i, float(g)) for i, g in enumerate([0, 5, 9, 9, 3, 0])], "episode_id string, frame_index bigint, gripper double")
    indexed = index_frames(raw, episode_values=gripper_values())
    got = EV.contact_frames(indexed, [(0.4, 0.9), (0.4, 0.5), (0.99, 0.9)])
    assert {(r.grasp_threshold, r.contact_threshold): r.pred_contact_frame for r in got.collect()} == {(0.4, 0.9): 2, (0.4, 0.5): 2, (0.99, 0.9): 3}
    assert got._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") <= 2


def test_median_of_odd_values(spark):
    """NaN, infinite, huge and equal values, with and without narrowing, give what numpy gives."""
    groups = {
        "nan": [*map(float, range(9)), float("nan")],
        "inf": [float("-inf"), 1.0, 2.0, 3.0, float("inf"), float("inf"), float("inf")],
        "huge": [-1e308, 1e308, 1.0, 2.0, 5.0, -3.0, 9e307],
        "ties": [7.0] * 50 + [1.0, 2.0, 3.0, 4.0, 9.0],
    }
    rows = spark.createDataFrame([(k, v) for k, values in groups.items() for v in values], "g string, v double")
    for ranked in (3, 1 << 20):
        got = {r["g"]: r["m"] for r in EV.exact_median(rows, ["g"], "v", "m", ranked=ranked, buckets=4).collect()}
        assert math.isnan(got.pop("nan"))
        assert got == {k: float(np.median(v)) for k, v in groups.items() if k != "nan"}


def test_product_machine(spark, blocking):
    """Eleven pairs, so three words: the first contact of each equals the one found by a step-by-step run of that pair alone."""
    pairs = [(0.1 * i, 0.5 + 0.05 * i) for i in range(11)]
    rng = np.random.default_rng(12)
    rows = [(e, 2 * i, float(g)) for e, n in (("a", 90), ("b", 1), ("c", 37), ("d", 13)) for i, g in enumerate(rng.integers(0, 10, n))]
    frames = spark.createDataFrame(rows, "episode_id string, frame_index bigint, gripper double")
    indexed = index_frames(frames, episode_values=gripper_values())
    got = {(r.episode_id, round(r.grasp_threshold, 3)): r.pred_contact_frame for r in EV.contact_frames(indexed, pairs).collect()}
    assert len(got) == 4 * 11
    for e in "abcd":
        g = np.array([v for k, _, v in rows if k == e])
        norm = (g - g.min()) / (g.max() - g.min() + 1e-6)
        for low, high in pairs:
            state, first = 0, None
            for i in range(len(norm)):
                now, before = norm[i], norm[max(i - 1, 0)]
                rise, fall = now > before, now < before
                if state in (0, 4):
                    state = 1 if now > low and rise else state
                elif state == 1:
                    state = 2 if now >= high else 0 if now <= low and fall else 1
                elif state == 2:
                    state = 3 if now < high and fall else 2
                else:
                    state = 4 if now <= low else 2 if now >= high and rise else 3
                if state == 2 and first is None:
                    first = 2 * i
            assert got[e, round(low, 3)] == first


def test_medians_together(spark):
    rng = np.random.default_rng(5)
    rows = [(int(k), float(a), float(b) if b > 0 else None) for k, a, b in zip(rng.integers(0, 3, 900), rng.normal(size=900), rng.normal(size=900))]
    frame = spark.createDataFrame(rows + [(7, 1.0, None)], "k int, a double, b double")
    for ranked in (1 << 20, 40):
        got = {r.k: (r.ma, r.mb) for r in EV.exact_medians(frame, ["k"], {"a": "ma", "b": "mb"}, ranked=ranked, buckets=8).collect()}
        for k in range(3):
            assert np.isclose(got[k][0], np.median([a for j, a, _ in rows if j == k])) and np.isclose(got[k][1], np.median([b for j, _, b in rows if j == k and b is not None]))
        assert got[7] == (1.0, None)
