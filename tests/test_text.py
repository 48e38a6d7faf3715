import pytest
from pyspark.sql import functions as F

from gripline.functions import replies as R
from gripline.functions import text as X
from gripline.operators import grounding as GR
from gripline.operators import ledger as L
from gripline.operators.language import language_tags


def apply(spark, values, fn, kind="string"):
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r.o for r in rows.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


def test_numbers(spark):
    texts = ["89.0", " 12 ", "-1", "", "abc", "1e2", "2.9", "-0.5", "nan", "inf", "1d", None, ".5", "+3"]
    assert apply(spark, texts, X.parse_int_like) == [89, 12, None, None, None, 100, 2, 0, None, None, None, None, 0, 3]
    assert apply(spark, ["-3.7", "4"], lambda c: X.parse_int_like(c, keep_negative=True)) == [-3, 4]


def test_lists(spark):
    texts = ["[0.5, 1]", "(1, 2,)", "[]", "", None, "[1, x]", "5", "[1, null]", " [1e-3] "]
    assert apply(spark, texts, X.parse_vector) == [[0.5, 1.0], [1.0, 2.0], None, None, None, None, None, None, [0.001]]
    traces = ["[[1, 2], [3, 4, 9]]", "[[1, 2], [3]]", "[]", "oops", "[(1, 2)]", None, "[1, 2]"]
    assert apply(spark, traces, X.parse_trace) == [[[1.0, 2.0], [3.0, 4.0]], None, None, None, [[1.0, 2.0]], None, None]


def test_lists_as_literals(spark):
    texts = ["0.1, 0.2, 0.3", "(0.1)", "[1., .5]", "[+1, 2]", "['0.1', \"0.2\"]", "(1, 2]", "[1,, 2]", "[[1, 2]]", "(3,)", "[1, 2] 3"]
    assert apply(spark, texts, X.parse_vector) == [[0.1, 0.2, 0.3], None, [1.0, 0.5], [1.0, 2.0], [0.1, 0.2], None, None, None, [3.0], None]
    traces = ["[[1., .5], (+3, 4),]", "([1, 2],)", "[[1, 2] [3, 4]]", "[[1, 2], 3]", "[" + "[1, 2], " * 5000 + "[1, 2]]"]
    assert apply(spark, traces, X.parse_trace) == [[[1.0, 0.5], [3.0, 4.0]], [[1.0, 2.0]], None, None, [[1.0, 2.0]] * 5001]


def test_literal_replies(spark):
    texts = ["{'target_object': 'None of these'}", "{'a': 'True North mug', 'b': None}", "{'bbox': (1, 2, 30, 40)}", "{'target_object': 'cup',}", '{"confidence": 0.9,}', "{'a': 'x, ] (y)'}", "{'a': '" + "w" * 20000 + "', 'b': (1)}"]
    want = ['{"target_object":"None of these"}', '{"a":"True North mug","b":null}', '{"bbox":[1,2,30,40]}', '{"target_object":"cup"}', '{"confidence":0.9}', '{"a":"x, ] (y)"}', '{"a":"' + "w" * 20000 + '","b":1}']
    assert apply(spark, texts, R.parse_grounding) == want
    boxes = ['{"bbox": ["1", "2", "30", "40.5"]}', '{"bbox": ["1", "2", "30", "x"]}', '{"bbox": [1, 2, 30, 40]}']
    read = lambda c: R.numbers_of(R.first_value(F.try_parse_json(c), R.BOX_KEYS), 4)
    assert apply(spark, boxes, read) == [[1.0, 2.0, 30.0, 40.5], None, [1.0, 2.0, 30.0, 40.0]]


def test_segment_entries(spark):
    body = '{"subtask_segments": ["oops", {"start_frame": 3.7, "end_frame": "9", "subtask_instruction": "a"}, 5, {"start_frame": "3.7", "end_frame": 9}, null]}'
    got = apply(spark, [body, "{}", None], R.segment_list)
    assert [(s.start_frame, s.end_frame, s.subtask_instruction) for s in got[0]] == [("3.7", "9", "a"), (None, "9", None)]
    assert got[1:] == [None, None]


def test_raising_model(spark):
    rows = spark.createDataFrame([(i, f"p{i}") for i in range(4)], "i int, prompt string").coalesce(1)

    def fails(prompts):
        raise RuntimeError("busy")

    got = GR.score_batches(rows, fails, lambda a: True).collect()
    assert len(got) == 4 and all(r.raw_text is None and r.attempt is None and r.error == "RuntimeError: busy" for r in got)


def test_absent_side_tables(spark, tmp_path):
    from gripline.sources import frames

    assert frames.scan_episode_meta(spark, str(tmp_path)).count() == 0
    calibration = frames.scan_calibration(spark, str(tmp_path))
    assert calibration.count() == 0 and calibration.columns == ["episode_id", "K", "T"]
    assert frames.scan_episode_meta(spark, str(tmp_path), "episode_index long, split string").columns == ["episode_index", "split"]


def test_texts(spark):
    assert apply(spark, [" a ", "[]", "-1", "None", None, "\t"], X.parse_text) == ["a", "", "", "None", "", ""]
    assert apply(spark, ["None", "nan", "x"], lambda c: X.parse_text(c, X.MISSING_GROUNDING)) == ["", "", "x"]
    assert apply(spark, ["Pick up  the CUP!", "___", "", "a" * 100], X.safe_name) == ["pick_up_the_cup", "subtask", "subtask", "a" * 80]
    assert apply(spark, ["10/1", "25", "30000/1001", "1/0", "x"], X.parse_fps) == [10.0, 25.0, 30000 / 1001, None, None]
    pairs = spark.createDataFrame([(0.4, 0.9), (0.123456789, 12.0), (1e-5, 100000.0)], "a double, b double")
    assert [r[0] for r in pairs.select(X.threshold_tag(F.col("a"), F.col("b"))).collect()] == [
        "grasp_0.4__contact_0.9",
        "grasp_0.123457__contact_12",
        "grasp_1em05__contact_100000",
    ]
    assert apply(spark, ["immobilization", "pre_grasp", "some_thing"], X.phase_alias) == ["approach", "pre-grasp", "some-thing"]


def test_language(spark):
    rows = spark.createDataFrame([(1, "Please PICK up the red cup."), (2, ""), (3, "move it"), (4, "  stack the blocks.,. ")], "id int, instruction string")
    got = {r.id: r for r in language_tags(rows).collect()}
    assert (got[1].task_verb, got[1].task_object, got[1].task_category, got[1].requires_precision, got[1].language_quality) == ("pick", "cup", "pick-and-place", False, 0.9)
    assert (got[2].task_verb, got[2].task_object, got[2].language_quality) == ("unknown", "unknown", 0.3)
    assert (got[3].task_object, got[3].task_category) == ("it", "unknown")
    assert (got[4].task_object, got[4].requires_precision) == ("blocks", True)
    assert got[1].subtask_sequence == ["reach toward the cup", "pick the cup", "return to home position"]


def test_find_json(spark):
    texts = ["<think>{x}</think> say {\"a\": [1, 2]} ok", "none", '{"a": 1} and {"b": 2}', "{'a': 1}", '<think>a</think><think>b</think>{"a": {"b": 2}}']
    assert apply(spark, texts, R.extract_json) == ['{"a":[1,2]}', None, None, None, '{"a":{"b":2}}']


REPLIES = {
    "fenced": ('```json\n{"target_object": " cup ", "bbox": [30, 40, 10, 20], "confidence": 0.5}\n```', "cup", [10.0, 20.0, 30.0, 40.0], [20.0, 30.0], 0.5),
    "literal": ("{'object': 'box', 'bbox_2d': [0, 0, 400, 90], 'extra': None, 'ok': True}", "box", [0.0, 0.0, 320.0, 90.0], [160.0, 45.0], None),
    "list": ('[{"label": "a", "center": [5, 900]}]', "a", None, [5.0, 180.0], None),
    "prose": ('Sure: {"target": "mug", "box": "from (1, 2) to (3.5, 4)"} done', "mug", [1.0, 2.0, 3.5, 4.0], [2.25, 3.0], None),
    "junk": ("no idea", "", None, None, None),
    "flat": ('{"target_object": "a", "bbox": [5, 5, 5, 9], "center_xy": "7 and 8"}', "a", None, [7.0, 8.0], None),
    "off": ('{"target_object": "a", "bbox": [400, 5, 500, 9]}', "a", None, None, None),
    "five": ('{"target_object": "a", "bbox": [1, 2, 3, 4, 5]}', "a", None, None, None),
    "five text": ('{"target_object": "a", "bbox": "[1, 2, 3, 4, 5]"}', "a", [1.0, 2.0, 3.0, 4.0], [2.0, 3.0], None),
    "empty first": ('{"target_object": "", "object": 0, "target": [], "label": "z", "bbox": [], "box": [0, 0, 2, 2]}', "z", [0.0, 0.0, 2.0, 2.0], [1.0, 1.0], None),
    "numbers": ("[1, 2]", "", None, None, None),
    "newline": ('{"target_object": "two\nlines"}', "two\nlines", None, None, None),
}


def test_grounding(spark):
    rows = spark.createDataFrame([(k, v[0]) for k, v in REPLIES.items()], "episode_id string, raw_text string")
    got = {r.episode_id: (r.target_object, r.bbox_xyxy, r.center_xy, r.confidence) for r in GR.grounding_record(rows, F.lit(320), F.lit(180)).collect()}
    assert got == {k: v[1:] for k, v in REPLIES.items()}
    empty = GR.empty_grounding(rows.limit(1), GR.DISABLED, F.lit(320), F.lit(180)).first()
    assert (empty.error, empty.target_object, empty.bbox_xyxy, empty.frame_size) == ("vlm_disabled", "", None, [320, 180])
    assert GR.empty_grounding(rows.limit(1), GR.NO_FRAME).first().frame_size is None


def test_replies(spark):
    texts = ['{"choices": [{"message": {"content": "hi", "reasoning": "x"}}]}', '{"choices": [{"message": {"content": null, "reasoning": "x"}}]}', '{"choices": []}', "?"]
    assert apply(spark, texts, R.model_reply) == ["hi", "x", "", ""]


def test_asking_again(spark):
    def generate(prompts):
        generate.calls = getattr(generate, "calls", 0) + 1
        return [f"{p}:{generate.calls}" if p != "never" else None for p in prompts]

    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "never")], "episode_id int, prompt string").coalesce(1)
    asked = GR.score_batches(rows, generate, lambda a: a.startswith("a") or a.endswith("2"), tries=3)
    assert {(r.episode_id, r.raw_text, r.attempt) for r in asked.collect()} == {(1, "a:1", 0), (2, "b:2", 1), (3, None, None)}
    at_hand = spark.createDataFrame([(1, 0, "?"), (1, 1, '{"a": 1}'), (1, 2, '{"a": 2}'), (2, 0, "?"), (2, 3, "{}")], "episode_id int, attempt int, raw_text string")
    assert {(r.episode_id, r.raw_text) for r in GR.first_parsed(at_hand, R.extract_json(F.col("raw_text"))).collect()} == {(1, '{"a": 1}'), (2, None)}


def test_ledger(spark):
    episodes = spark.createDataFrame([("a",), ("b",), ("a",)], "episode_id string")
    none = spark.createDataFrame([], "episode_id string, module string, status string, error string")
    tasks = L.register_tasks(episodes, none)
    assert tasks.count() == 16
    updates = spark.createDataFrame([("a", "m3_phase", "done", None, 1), ("a", "m3_phase", "failed", "x", 2), ("z", "m3_phase", "done", None, 1)], "episode_id string, module string, status string, error string, seq int")
    marked = L.mark_tasks(tasks, updates)
    assert marked.count() == 16 and marked.where("status = 'failed' and error = 'x'").count() == 1
    assert [r.episode_id for r in L.pending_tasks(marked, "m3_phase").collect()] == ["b"]
    again = L.register_tasks(episodes.union(spark.createDataFrame([("c",)], "episode_id string")), marked)
    assert again.count() == 24 and again.where("status = 'failed'").count() == 1
    assert {(r.module, r.status): r.tasks for r in L.status_summary(again).collect()}[("m3_phase", "pending")] == 2


def test_missing_instruction_is_an_error(spark):
    from gripline.sources import manifests as M

    rows = spark.createDataFrame([("e", " ", None)], "episode_id string, language_instruction string, instruction_add string")
    with pytest.raises(Exception, match="no episode instruction"):
        M.episode_manifest(rows, F.lit("v.mp4")).collect()


def test_plain_vectors_take_the_short_way(spark):
    """Both ways give the same numbers; the query's plan holds few patterns, which each row would meet again and again."""
    texts = ["[1, 2.5,-3e2]", " (1, 2) ", "(1,)", "(1)", "[1,]", "[1,,]", "[]", "", "[ ]", "1, 2", "[1 2]", "[1, oops]", "['1', 2]", "[True, 1_0]", "[.5, 5., +1]", "[1\t, 2]", "[1, 2)", "[nan]", "[1e400]", "[1d, 2]", "(1, 2,)", "[,1]", None]
    v, t = F.col("v"), F.col("t")
    rows = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    got = rows.select("i", X.parse_vector(t).alias("v"), X.vector_or_null(X._items(X._as_digits(t))).alias("slow")).orderBy("i").collect()
    assert [r.v for r in got] == [r.slow for r in got]
    assert [r.v for r in got][:5] == [[1.0, 2.5, -300.0], [1.0, 2.0], [1.0], None, [1.0]]
    plan = rows.select(X.parse_vector(t).alias("v"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") < 40, plan.count("regexp_replace")


def test_names_read_only_their_part(spark):
    """Long texts with long runs between words; names as of the whole text."""
    import re
    import time

    def whole(t):
        plain = re.sub("[^A-Za-z0-9._-]+", "_", t.strip().lower())
        return plain.strip("_")[:80] or "subtask"

    texts = ["  Pick_up  the cup! ", "a" * 79 + "__", "a" * 79 + "  b", "a" * 79 + "_ _ _", "é" * 500, "", "_ _", "x" + " é_ -" * 200, "\u212aelvin \u0130stanbul", ("\u0130 " * 100), "a\n" * 300, "a" + " " * 300000 + "b"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    began = time.time()
    got = rows.select("i", X.safe_name(F.col("t")).alias("n")).orderBy("i").collect()
    assert [r.n for r in got] == [whole(t) for t in texts] and time.time() - began < 30


def test_box_is_computed_once(spark):
    box = R.box_center(R.normalize_bbox(F.col("b"), F.lit(320), F.lit(180)))
    rows = spark.createDataFrame([(0, [10.0, 20.0, 30.0, 40.0]), (1, [5.0, 5.0, 5.0, 9.0]), (2, None)], "i long, b array<double>").select("i", box.alias("c"))
    assert [r.c for r in rows.orderBy("i").collect()] == [[20.0, 30.0], None, None]
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("greatest") < 20


def test_plain_traces_take_the_short_way(spark):
    """Pairs come out the same way by way of one cut; the plan does not hold the reading point by point again and again."""
    texts = ["[[1, 2], [3.5,-0]]", " [ [1e3, .5] , [+1, 2.] ] ", "[[1, 2, 3], [4, 5]]", "[[1, 2],]", "[[1, 2] [3, 4]]", "[(1, 2)]", "([1, 2],)", "[[1, 2], [3]]", "[[1, 2], []]", "[]", "", " ", None, "[1, 2]", "[[1, 2]", "[[1, 2]]]", "[['1', 2]]", "[[1_0, True]]", "[[nan, 1]]", "[[1, 2], oops]"]
    want = [[[1.0, 2.0], [3.5, 0.0]], [[1000.0, 0.5], [1.0, 2.0]], [[1.0, 2.0], [4.0, 5.0]], [[1.0, 2.0]], None, [[1.0, 2.0]], [[1.0, 2.0]], *[None] * 9, [[1.0, 2.0]], [[10.0, 1.0]], None, None]
    assert apply(spark, texts, X.parse_trace) == want
    plan = spark.createDataFrame([("",)], "t string").select(X.parse_trace(F.col("t")).alias("v"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") < 15, plan.count("regexp_replace")
