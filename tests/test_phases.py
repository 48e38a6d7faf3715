import math
import random

import pytest
from pyspark.sql import functions as F

from gripline.operators import blocks
from gripline.operators import phases as P
from gripline.operators import signals as S


def frames_of(spark, series):
    """{episode: readings} -> numbered frames, rows handed over out of order."""
    rows = [(e, i, float(g)) for e, values in series.items() for i, g in enumerate(values)]
    random.Random(5).shuffle(rows)
    raw = spark.createDataFrame(rows, "episode_id string, frame_index bigint, gripper double")
    return blocks.index_frames(raw, episode_values=S.gripper_values())


def grasp_loop(values, low=0.4, high=0.9):
    lo, hi = min(values), max(values)
    norm = [(v - lo) / (hi - lo + 1e-6) for v in values]
    if any(math.isnan(v) for v in values):
        norm = [math.nan] * len(values)
    state, out, last = 0, [], norm[0]
    for g in norm:
        up, down = g > last, g < last
        rules = {
            0: [(g > low and up, 1)],
            1: [(g >= high, 2), (g <= low and down, 0)],
            2: [(g < high and down, 3)],
            3: [(g <= low, 4), (g >= high and up, 2)],
            4: [(g > low and up, 1)],
        }
        state = next((target for holds, target in rules[state] if holds), state)
        out.append(P.GRASP[state])
        last = g
    return out


def runs_of(names):
    out, seen = [], {}
    start = 0
    for i in range(1, len(names) + 1):
        if i == len(names) or names[i] != names[start]:
            n = seen.get(names[start], 0)
            out.append((names[start], n, start, i - 1))
            seen[names[start]] = n + 1
            start = i
    return out


def random_series(count=12, seed=1):
    rng = random.Random(seed)
    series = {}
    for e in range(count):
        level, values = 0.0, []
        for _ in range(rng.randint(1, 60)):
            level = min(9.0, max(0.0, level + rng.choice([-4, -2, -1, 0, 0, 1, 2, 4])))
            values.append(level)
        series[f"e{e:02d}"] = values
    # one episode far longer than the rest, and the odd cases
    series["long"] = [rng.choice([0.0, 3.0, 5.0, 8.5, 9.0]) for _ in range(300)]
    series["flat"] = [2.0] * 20
    series["single"] = [1.0]
    series["nan"] = [0.0, 9.0, math.nan, 9.0, 0.0, 9.0]
    return series


def test_grasp_phases_and_ranges(spark, blocking):
    series = random_series()
    phased = P.grasp_phases(frames_of(spark, series))
    got = {}
    for r in phased.collect():
        got.setdefault(r.episode_id, {})[r.frame_index] = r.phase
    want = {e: grasp_loop(v) for e, v in series.items()}
    assert {e: [got[e][i] for i in range(len(v))] for e, v in series.items()} == want
    ranges = {}
    for r in P.phase_ranges(phased).collect():
        ranges.setdefault(r.episode_id, []).append((r.phase, r.range_index, r.start_step, r.end_step))
    assert {e: sorted(v, key=lambda x: x[2]) for e, v in ranges.items()} == {e: runs_of(v) for e, v in want.items()}


def test_published_ranges(spark):
    """Series built to give ranges that were published for a recording, and for one with two contacts."""
    plain = [0.0] * 60 + [0.5 + 0.016 * i for i in range(25)] + [1.0] * 103 + [0.8 - 0.06 * i for i in range(7)] + [0.0] * 45
    again = [0.0] * 60 + [0.5 + 0.06 * i for i in range(6)] + [1.0] * 2 + [0.8] * 16 + [1.0] * 104 + [0.8 - 0.06 * i for i in range(7)] + [0.0] * 45
    phased = P.grasp_phases(frames_of(spark, {"plain": plain, "again": again}), 0.4, 0.9)
    found = {(r.episode_id, r.phase, r.range_index): (r.start_step, r.end_step) for r in P.phase_ranges(phased).collect()}
    assert found[("plain", "pre_grasp", 0)] == (0, 59)
    assert found[("plain", "immobilization", 0)] == (60, 84)
    assert found[("plain", "contact", 0)] == (85, 187)
    assert found[("plain", "detach", 0)] == (188, 194)
    assert found[("plain", "post_grasp", 0)] == (195, 239)
    assert found[("again", "contact", 0)] == (66, 67) and found[("again", "contact", 1)] == (84, 187)
    assert found[("again", "detach", 0)] == (68, 83) and found[("again", "detach", 1)] == (188, 194)
    rates = spark.createDataFrame([("plain", 10.0), ("again", 10.0)], "episode_id string, fps double")
    clips = P.clip_manifest(P.phase_ranges(phased), rates)
    names = [r.path for r in clips.where("episode_id = 'plain'").orderBy("clip").collect()]
    assert names == [
        "00_pre-grasp_frames_000000_000059.mp4",
        "01_approach_frames_000060_000084.mp4",
        "02_contact_frames_000085_000187.mp4",
        "03_detach_frames_000188_000194.mp4",
        "04_post-grasp_frames_000195_000239.mp4",
    ]
    assert [r.duration_seconds for r in clips.where("episode_id = 'plain'").orderBy("clip").collect()] == [6.0, 2.5, 10.3, 0.7, 4.5]
    # clips count by phase first, then by range
    order = [(r.phase, r.range_index) for r in clips.where("episode_id = 'again'").orderBy("clip").collect()]
    assert order[2:6] == [("contact", 0), ("contact", 1), ("detach", 0), ("detach", 1)]


def test_nested_ranges(spark):
    ranges = P.phase_ranges(P.grasp_phases(frames_of(spark, {"flat": [1.0] * 4})))
    row = P.ranges_nested(ranges).collect()
    assert len(row) == 1 and row[0].phase_ranges["pre_grasp"] == [[0, 3]]
    assert row[0].phase_ranges["transition"] == [] and set(row[0].phase_ranges) == {*P.GRASP, "transition"}
    many = spark.createDataFrame([("e", "contact", i, 2 * i, 2 * i) for i in range(10)], "episode_id string, phase string, range_index bigint, start_step bigint, end_step bigint")
    parts = P.ranges_nested(many, part_size=4).orderBy("part").collect()
    assert [len(p.phase_ranges["contact"]) for p in parts] == [4, 4, 2]
    assert sum((p.phase_ranges["contact"] for p in parts), []) == [[2 * i, 2 * i] for i in range(10)]


def five_loop(values, tau_g=0.5, tau_c=0.8, eps=0.02):
    lo, hi = min(values), max(values)
    names, conf = ["approach"], [0.0]
    for t in range(1, len(values)):
        s, d, now = (values[t] - lo) / (hi - lo + 1e-8), values[t] - values[t - 1], names[-1]
        closed = s >= tau_c and abs(d) <= eps
        if now == "approach":
            step = ("contact", 0.85) if closed else ("approach", 0.9) if s < tau_g and d < -eps else ("stabilize", 0.75)
        elif now == "stabilize":
            step = ("contact", 0.9) if closed else ("stabilize", 0.8)
        elif now == "contact":
            step = ("release", 0.85) if d > eps else ("contact", 0.95)
        elif now == "release":
            step = ("reset", 0.8) if s < tau_g else ("release", 0.85)
        else:
            step = ("approach", 0.7)
        names.append(step[0])
        conf.append(step[1])
    return names, conf, smooth_loop(names)


def smooth_loop(names):
    held = list(names)
    for i in range(1, len(held) - 1):
        if held[i] not in (held[i - 1], held[i + 1]):
            held[i] = held[i - 1]
    return held


def test_five_phases(spark, blocking):
    series = {e: v for e, v in random_series(seed=3).items() if e != "nan"}
    rows = {}
    for r in P.five_phases(frames_of(spark, series)).collect():
        rows.setdefault(r.episode_id, {})[r.frame_index] = r
    for e, values in series.items():
        names, conf, held = five_loop(values)
        got = [rows[e][i] for i in range(len(values))]
        assert [g.raw_phase for g in got] == names, e
        assert [g.phase for g in got] == held, e
        assert [g.phase_confidence for g in got] == conf, e


def test_smoothing_is_left_to_right(spark, blocking):
    rng = random.Random(8)
    series = {"aba": "ABABA", "one": "A", "two": "AB", "tail": "AAB"}
    series |= {f"r{i}": "".join(rng.choice("AB" if i % 2 else "ABC") for _ in range(rng.randint(3, 80))) for i in range(10)}
    series["swing"] = "AB" * 60 + "BC"
    rows = [(e, i, c) for e, text in series.items() for i, c in enumerate(text)]
    raw = spark.createDataFrame(rows, "episode_id string, frame_index bigint, phase string")
    got = {}
    for r in P.smooth_phases(blocks.index_frames(raw)).collect():
        got.setdefault(r.episode_id, {})[r.frame_index] = r.smoothed
    assert {e: "".join(got[e][i] for i in range(len(t))) for e, t in series.items()} == {e: "".join(smooth_loop(t)) for e, t in series.items()}


def test_numbering(spark, blocking):
    """Sparse, unsorted and repeated frame numbers; one episode holds most of the rows."""
    rng = random.Random(2)
    rows = [("big", rng.randint(0, 5000), i) for i in range(400)] + [(f"e{k}", 10 * i - 20, i) for k in range(5) for i in range(k + 1)]
    raw = spark.createDataFrame(rows, "episode_id string, frame_index bigint, row_index bigint").repartition(3)
    got = blocks.index_frames(raw, ties=("row_index",), episode_values={"top": (F.max("row_index"), F.max)})
    assert blocks.longest_of(got) == 400
    have = sorted((r.episode_id, r.step, r.frame_index, r.row_index, r.n_steps, r.top) for r in got.collect())
    want = []
    for e in {r[0] for r in rows}:
        mine = sorted((f, p) for k, f, p in rows if k == e)
        want += [(e, i, f, p, len(mine), max(q for _, q in mine)) for i, (f, p) in enumerate(mine)]
    assert have == sorted(want)


def test_stable_contact(spark, blocking):
    series = {"yes": [0, 9, 9, 9, 9, 9, 9, 2, 9, 9, 0], "short": [0, 9, 9, 9, 9, 0, 9, 9, 9, 9], "end": [0, 0, 9, 9, 9, 9, 9]}
    got = {}
    for r in S.stable_contact(frames_of(spark, series)).collect():
        got.setdefault(r.episode_id, {})[r.frame_index] = (r.contact_step, r.contact_status)
    assert [got["yes"][i] for i in range(11)] == [(1, "pre")] + [(1, "in")] * 6 + [(1, "post")] * 4
    assert {v for v in got["short"].values()} == {(None, "pre")}
    assert [got["end"][i][1] for i in range(7)] == ["pre"] * 2 + ["in"] * 5


def test_window_reach_is_checked(spark):
    indexed = frames_of(spark, {"e": [1.0, 2.0]})
    with pytest.raises(ValueError):
        blocks.with_halo(indexed, before=10, size=4)
    with pytest.raises(ValueError):
        S.future_trace(indexed, horizon=0)


def test_deep_scan(spark):
    """Running values over more levels of runs agree with plain ones."""
    rng = random.Random(4)
    rows = [(e, b, rng.randint(0, 9) if rng.random() > 0.3 else None) for e in ("a", "b") for b in range(60 if e == "a" else 5)]
    table = spark.createDataFrame(rows, "episode_id string, blk bigint, v int")
    kinds = {k: blocks.Carried(k, "v") for k in ("sum", "max", "last", "next")}
    got = {(r.episode_id, r.blk): r for r in blocks.scan_blocks(table, kinds, fan=3, levels=3).collect()}
    for e, b, _ in rows:
        earlier = [v for k, x, v in rows if k == e and x < b and v is not None]
        later = [v for k, x, v in rows if k == e and x > b and v is not None]
        r = got[(e, b)]
        assert (r["sum"], r["max"], r["last"], r["next"]) == (sum(earlier), max(earlier, default=None), earlier[-1] if earlier else None, later[0] if later else None)
