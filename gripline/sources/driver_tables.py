"""The shared test tables in the shape of robot recordings.

Events of a user are the frames of one episode; line items give detections, mask and depth pixels and
planned segments; documents and orders give model replies and task states. The rules are plain
arithmetic, so the same tables can be written in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gripline.functions.text import parse_int_like, parse_trace, parse_vector
from gripline.operators.blocks import KEY, index_frames, number_frames
from gripline.operators.evaluate import earliest
from gripline.operators.signals import gripper_values

# verbs by episode number: twelve known ones and two unknown
VERBS = ("pick", "grab", "place", "put", "open", "close", "pour", "wipe", "push", "slide", "insert", "stack", "move", "look")

K_MATRIX = ((300.0, 0.0, 160.0), (0.0, 290.0, 90.0), (0.0, 0.0, 1.0))
T_MATRIX = ((0.8, -0.6, 0.0, 0.05), (0.6, 0.8, 0.0, -0.1), (0.0, 0.0, 1.0, 0.4), (0.0, 0.0, 0.0, 1.0))
CAMERA_FRAMES = (0, 20, 45)
CAMERA_SHIFT = (0.5, -0.2, 1.0)
EVENT_SPAN = 1 << 20  # event numbers per block: one user owns at most this many rows of a block


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def matrix(rows) -> Column:
    return F.array(*[F.array(*[F.lit(float(v)) for v in r]) for r in rows])


def raw_frames(spark: SparkSession, folder: str) -> DataFrame:
    """Frames with the event number as (sparse) frame number; labels are texts in several states of repair."""
    k = "get_json_object(props, '$.k')"
    digits = ", ".join(f"concat('0.', lpad(cast((event_id * {m}) % 997 as string), 3, '0'))" for m in (3, 7, 11, 13, 17, 19))
    point = "concat('[', (event_id * 31 + i * 17) % 320, ', ', (event_id * 29 + i * 13) % 180, ']')"
    points = f"array_join(transform(filter(sequence(0, 12), i -> i < event_id % 13), i -> {point}), ', ')"
    return table(spark, folder, "events").selectExpr(
        f"user_id as {KEY}",
        "event_id",
        "cast(floor(value) % 10 as double) as gripper",
        "(event_id * 37 % 401) / 200.0D - 1.0D as x",
        "(event_id * 53 % 307) / 150.0D - 1.0D as y",
        "(event_id * 71 % 211) / 100.0D - 0.605D as z",
        "(event_id * 13 % 101) / 50.0D as rx",
        "(event_id * 17 % 103) / 50.0D as ry",
        "(event_id * 19 % 107) / 50.0D as rz",
        f"case event_id % 5 when 0 then '' when 1 then '-1' when 2 then concat({k}, '.0') when 3 then 'abc' else {k} end as contact_text",
        f"case event_id % 4 when 1 then concat('[', concat_ws(', ', {digits}), ']') when 2 then '[]' when 3 then '' end as affordance_text",
        f"case when event_id % 3 = 0 then concat('[', {points}, ']') end as trace_text",
    )


def frames(spark: SparkSession, folder: str) -> DataFrame:
    """Numbered frames with poses."""
    indexed = index_frames(raw_frames(spark, folder), order="event_id", episode_values=gripper_values(), span=EVENT_SPAN)
    return indexed.withColumn("frame_index", F.col("step"))


def labelled_frames(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Numbered frames with pose arrays, and the annotated contact frame and pose of each episode."""
    values = gripper_values() | {
        "gt_contact": earliest(parse_int_like(F.col("contact_text")), "event_id"),
        "gt_affordance": earliest(parse_vector(F.col("affordance_text")), "event_id"),
    }
    indexed, episodes = number_frames(raw_frames(spark, folder), order="event_id", episode_values=values, span=EVENT_SPAN)
    labels = episodes.select(
        KEY,
        F.col("n_steps").alias("num_frames"),
        F.col("gt_contact")["value"].alias("gt_contact_frame"),
        F.col("gt_affordance")["value"].alias("gt_state_affordance"),
        "gripper_min",
        "gripper_max",
    )
    return with_poses(indexed.withColumn("frame_index", F.col("step"))), labels


def with_poses(indexed: DataFrame) -> DataFrame:
    """Gripper pose and tool pose (the same, 0.1 lower) as arrays."""
    pose = lambda dz: F.array("x", "y", F.col("z") - dz, "rx", "ry", "rz")
    return indexed.withColumn("gripper_pose", pose(0.0)).withColumn("tcp_pose", pose(0.1))


def with_gt_trace(indexed: DataFrame) -> DataFrame:
    return indexed.withColumn("gt_trace", parse_trace(F.col("trace_text")))


def instructions(spark: SparkSession, folder: str) -> DataFrame:
    """One instruction per episode."""
    users = table(spark, folder, "events").groupBy(F.col("user_id").alias(KEY)).agg(F.count(F.lit(1)).alias("n_steps"))
    names = table(spark, folder, "part").select(F.col("p_partkey").alias(KEY), "p_name")
    verb = F.get(F.array(*[F.lit(v) for v in VERBS]), (F.col(KEY) % len(VERBS)).cast("int"))
    text = F.when(F.col(KEY) % 17 == 16, F.lit("")).otherwise(F.concat(verb, F.lit(" the "), F.coalesce("p_name", F.lit("object")), F.lit(".")))
    return users.join(names, KEY, "left").select(KEY, "n_steps", text.alias("instruction"))


def calibration(episodes: DataFrame) -> DataFrame:
    """Camera of every episode with an even number."""
    return episodes.where(F.col(KEY) % 2 == 0).select(KEY, matrix(K_MATRIX).alias("K"), matrix(T_MATRIX).alias("T"))


ODD_MATRIX = ((1.0, 0.0, 0.0, 0.1), (0.0, 1.0, 0.0, -0.2), (0.0, 0.0, 1.0, 0.7), (0.0, 0.0, 0.0, 1.0))


def rigs(episodes: DataFrame) -> DataFrame:
    """A camera for every episode: the calibrated one for even numbers, one that is not turned for odd ones."""
    pose = F.when(F.col(KEY) % 2 == 0, matrix(T_MATRIX)).otherwise(matrix(ODD_MATRIX))
    return episodes.select(KEY, matrix(K_MATRIX).alias("K"), pose.alias("T"))


def cameras(episodes: DataFrame) -> DataFrame:
    """Three cameras per episode; some points lie behind the second."""
    one = lambda i: F.struct(
        F.lit(i).alias("cam_pos"),
        F.lit(CAMERA_FRAMES[i]).cast("bigint").alias("frame_index"),
        matrix(K_MATRIX).alias("K"),
        matrix(((1.0, 0.0, 0.0, 0.1 * i), (0.0, 1.0, 0.0, -0.1 * i), (0.0, 0.0, 1.0, CAMERA_SHIFT[i]))).alias("E"),
    )
    return episodes.select(KEY, F.inline(F.array(*[one(i) for i in range(3)])))


def line_frames(spark: SparkSession, folder: str) -> DataFrame:
    """Line items placed on frames: one hundred orders are one episode."""
    return table(spark, folder, "lineitem").select(
        F.floor(F.col("l_orderkey") / 100).alias(KEY),
        (F.col("l_orderkey") % 100).alias("frame_index"),
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "l_quantity",
        "l_discount",
        "l_tax",
        "l_returnflag",
        "l_linestatus",
        "l_extendedprice",
    )


PROMPTS = ("cup", "towel", "robot gripper")


def detections(spark: SparkSession, folder: str) -> DataFrame:
    """Detections with a class number, labelled through the prompt list. det_idx is unique in its frame."""
    q = F.col("l_quantity")
    cls = (F.col("l_partkey") % 3).cast("int")
    left, top = (F.col("l_partkey") % 300).cast("double"), (F.col("l_suppkey") % 160).cast("double")
    return line_frames(spark, folder).select(
        KEY,
        "frame_index",
        (F.col("l_partkey") * 100000 + F.col("l_suppkey")).alias("det_idx"),
        F.get(F.array(*[F.lit(p) for p in PROMPTS]), cls).alias("label"),
        (F.col("l_discount") * 10).alias("score"),
        left.alias("x1"),
        top.alias("y1"),
        (left + q).alias("x2"),
        (top + q / 2).alias("y2"),
    )


def pixel_frame(orderkey: Column) -> Column:
    """Pixels gather on ten frames of each episode: 10, 15, ... 55."""
    return F.floor((orderkey % 100) / 10) * 5 + 10


def mask_pixels(spark: SparkSession, folder: str) -> DataFrame:
    return line_frames(spark, folder).select(
        KEY,
        pixel_frame(F.col("l_orderkey")).alias("frame_index"),
        F.col("l_linestatus").alias("obj_id"),
        (F.col("l_partkey") % 320).alias("x"),
        (F.col("l_suppkey") % 180).alias("y"),
    )


def depth_pixels(spark: SparkSession, folder: str) -> DataFrame:
    """One depth per pixel of a frame (the smallest line quantity that falls on it)."""
    rows = mask_pixels_with_quantity(spark, folder)
    return rows.groupBy(KEY, "frame_index", "x", "y").agg((F.min("l_quantity") / 50.0 + 0.3).alias("depth_m"))


def mask_pixels_with_quantity(spark: SparkSession, folder: str) -> DataFrame:
    return line_frames(spark, folder).select(
        KEY,
        pixel_frame(F.col("l_orderkey")).alias("frame_index"),
        (F.col("l_partkey") % 320).alias("x"),
        (F.col("l_suppkey") % 180).alias("y"),
        "l_quantity",
    )


def planned(spark: SparkSession, folder: str) -> DataFrame:
    """Planned segments, one per line item, on episodes that are orders."""
    start = F.col("l_linenumber") * 5
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias(KEY),
        (F.col("l_partkey") * 100000 + F.col("l_suppkey")).alias("pos"),
        start.cast("bigint").alias("start"),
        (start + F.col("l_quantity").cast("int") - 10).cast("bigint").alias("end"),
        F.when(F.col("l_partkey") % 7 == 0, "").when(F.col("l_partkey") % 7 == 1, "[]").otherwise(F.concat(F.lit(" "), F.col("l_returnflag"), F.lit(" part "))).alias("text"),
    )


def planned_episodes(spark: SparkSession, folder: str) -> DataFrame:
    """Frame range and instruction of the episodes that are orders."""
    key = F.col("o_orderkey")
    return table(spark, folder, "orders").select(
        key.alias(KEY), (key % 3).alias("first_frame"), (key % 3 + 20 + key % 17).alias("last_frame"), F.col("o_orderpriority").alias("task_instruction")
    )


def json_text(text: Column) -> Column:
    """A text as JSON writes it, with its quotes."""
    return F.regexp_extract(F.to_json(F.struct(F.coalesce(text, F.lit("")).alias("t"))), r'(?s)^\{"t":(.*)\}$', 1)


def python_text(text: Column) -> Column:
    """A text as a Python literal in single quotes."""
    for plain, written in (("\\", "\\\\"), ("'", "\\'"), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(plain), F.lit(written))
    return F.concat(F.lit("'"), F.coalesce(text, F.lit("")), F.lit("'"))


def replies(spark: SparkSession, folder: str) -> DataFrame:
    """Model replies in eight shapes by document number, each around the whole text; confidences are numbers, words, lists or missing."""
    d = F.col("doc_id")
    s = lambda c: c.cast("string")
    text = F.coalesce(F.col("text"), F.lit(""))
    body = json_text(text)
    box = F.concat(F.lit("["), s(d % 300), F.lit(", "), s(d % 170), F.lit(", "), s(d * 7 % 400), F.lit(", "), s(d * 11 % 200), F.lit("]"))
    shapes = [
        F.concat(F.lit('```json\n{"target_object": '), body, F.lit(', "bbox": '), box, F.lit(', "confidence": 0.'), s(d % 10), F.lit("}\n```")),
        F.concat(F.lit("{'object': "), python_text(text), F.lit(", 'bbox_2d': "), box, F.lit(", 'confidence': None}")),
        F.concat(F.lit('Response: [{"target": '), body, F.lit(', "confidence": "high", "box": "'), s(d % 300), F.lit(" and "), s(d % 170), F.lit('", "center": ['), s(d % 350), F.lit(", "), s(d % 90), F.lit("]}]")),
        F.concat(F.lit('The answer is {"label": '), body, F.lit(', "confidence": [0, "'), F.col("lang"), F.lit('"], "center_xy": "'), s(d % 350), F.lit("; "), s(d % 90), F.lit('"} as asked')),
        text,
        F.concat(F.lit('{"target_object": "", "object": '), body, F.lit(', "bbox": [], "box": '), box, F.lit("}")),
        F.concat(F.lit("<think>"), text, F.lit('</think> JSON: {"target_object": '), body, F.lit(', "bbox": '), box, F.lit("}")),
        F.concat(F.lit("["), body, F.lit(', 2, {"a": '), s(d), F.lit("}]")),
    ]
    reply = shapes[0]
    for i in range(1, len(shapes)):
        reply = F.when(d % 8 == i, shapes[i]).otherwise(reply)
    return table(spark, folder, "documents").select(d.alias(KEY), reply.alias("raw_text"))


def plan_replies(spark: SparkSession, folder: str) -> DataFrame:
    """Planning replies in four shapes; whole document texts are the instruction, stand alone, or are thought aloud as well."""
    d = F.col("doc_id")
    s = lambda c: c.cast("string")
    seg = lambda a, b, t: F.concat(F.lit('{"start_frame": '), s(a), F.lit(', "end_frame": '), s(b), F.lit(', "subtask_instruction": '), t, F.lit("}"))
    two = F.concat(F.lit('{"subtask_segments": ['), seg(d % 30, d % 30 + 12, json_text(F.col("text"))), F.lit(", "), seg(d % 50, d % 20, F.lit('" "')), F.lit("]}"))
    text = (
        F.when(d % 4 == 0, two)
        .when(d % 4 == 1, F.concat(F.lit("<think>"), F.col("text"), F.lit("</think>\n"), two))
        .when(d % 4 == 2, F.col("text"))
        .otherwise(F.concat(F.lit("Plan: "), two, F.lit(" done")))
    )
    return table(spark, folder, "documents").select(d.alias(KEY), text.alias("raw_text"))


def tasks(spark: SparkSession, folder: str) -> DataFrame:
    """Task states: customers are episodes, priorities are modules; the newest order counts."""
    return (
        table(spark, folder, "orders")
        .groupBy(F.col("o_custkey").alias(KEY), F.col("o_orderpriority").alias("module"))
        .agg(F.max_by("o_orderstatus", "o_orderkey").alias("status"))
        .select(KEY, "module", F.when(F.col("status") == "O", "pending").when(F.col("status") == "F", "done").otherwise("failed").alias("status"), F.lit(None).cast("string").alias("error"))
    )
