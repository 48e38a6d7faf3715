"""Read recordings: frames from parquet, side tables from JSON."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MATRIX = "array<array<double>>"
EPISODE_LINE = "episode_index bigint, tasks array<string>, length bigint"

# --- fixed values: column names of a recording and their short names -----------------------
COLUMNS = {
    "frame_index": "frame_index",
    "episode_index": "episode_index",
    "observation.state": "state",
    "other_information.observation_gripper_position": "gripper",
    "other_information.observation_gripper_pose6d": "gripper_pose",
    "other_information.observation_tcp_pose6d": "tcp_pose",
    "other_information.language_instruction_2": "task_instruction",
    "language_instruction": "language_instruction",
    "annotation.instruction_add": "instruction_add",
    "task.description": "task_description",
    "annotation.contact_frame": "contact_text",
    "annotation.state_affordance": "state_affordance",
    "annotation.trace": "trace_text",
    "camera_view": "camera_view",
}


def scan_frames(
    spark: SparkSession, root: str, pattern: str = "episode_*.parquet", columns: dict[str, str] | None = None, schema: StructType | str | None = None
) -> DataFrame:
    """Rows of all matching files below `root`, with episode_id (file stem), the folder, and the row's place in the file.

    Columns keep Spark's pruning; names with dots are renamed once here. `columns` maps recorded
    names to short ones; recorded names that are absent are left out. Give the `schema` where files differ or many have to be opened.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    raw = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).parquet(root)
    names = COLUMNS if columns is None else columns
    kept = [F.col(f"`{c}`").alias(names.get(c, c.replace(".", "_"))) for c in raw.columns]
    path = F.col("_metadata.file_path")
    return raw.select(
        F.regexp_extract("_metadata.file_name", r"^(.*?)(\.[^.]*)?$", 1).alias("episode_id"),
        F.element_at(F.split(path, "/"), -2).alias("chunk"),
        F.col("_metadata.row_index").alias("row_index"),
        *kept,
    )


def first_episodes(spark: SparkSession, root: str, n: int, pattern: str = "episode_*.parquet", zero_means_all: bool = True) -> list[str] | None:
    """Paths of the first n recordings in sorted order, so that only these are opened; None means all.

    Only file names are listed, by a reader that opens no file.
    """
    if n == 0 and zero_means_all:
        return None
    listing = list_files(spark, root, pattern).orderBy("path").limit(n)
    return [r.path for r in listing.collect()]


def list_files(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """Paths below root; file contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    return found.select("path")


def split_state(frames: DataFrame, state: str = "state") -> DataFrame:
    """State vector -> cart (first six) and gripper (seventh); zeros when there is no state column."""
    if state in frames.columns:
        return frames.withColumn("cart", F.slice(F.col(state), 1, 6)).withColumn("gripper", F.get(F.col(state), 6))
    return frames.withColumn("cart", F.array_repeat(F.lit(0.0), 6)).withColumn("gripper", F.lit(0.0))


def has_depth(frames: DataFrame) -> bool:
    """True when any recorded column speaks of depth."""
    return any("depth" in c for c in frames.columns)


def flatten_pose(pose: Column, nested: bool = False) -> Column:
    """Pose as a flat array of doubles; null stays null."""
    return F.flatten(pose.cast(MATRIX)) if nested else pose.cast("array<double>")


def _or_empty(spark: SparkSession, read: Callable[[], DataFrame], schema: str) -> DataFrame:
    """What `read` reads, an empty table where its path does not exist."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def scan_episode_meta(spark: SparkSession, root: str, schema: str | None = None) -> DataFrame:
    """Episode list of a dataset: one JSON line per episode, keyed by episode_index; empty where there is no list.

    Without a schema the lines are read once more to find it."""
    reader = spark.read.schema(schema) if schema else spark.read
    return _or_empty(spark, lambda: reader.json(f"{root}/meta/episodes.jsonl"), schema or EPISODE_LINE)


def meta_of(lines: DataFrame, text: str, schema: str) -> DataFrame:
    """Episode list already at hand as JSON text, one episode per row."""
    doc = F.from_json(F.col(text), schema)
    return lines.select(doc.alias("_d")).select("_d.*")


def scan_calibration(spark: SparkSession, root: str) -> DataFrame:
    """One JSON file per episode -> episode_id, K, T; empty where there is no folder."""
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*_calib.json")
    name = F.regexp_extract("_metadata.file_name", r"^(.*)_calib\.json$", 1).alias("episode_id")
    read = lambda: reader.text(f"{root}/meta/calibration", wholetext=True).select(name, "value")
    named = _or_empty(spark, read, "episode_id string, value string")
    return named.select("episode_id", *calibration_of(F.col("value")))


def calibration_of(text: Column) -> list[Column]:
    doc = F.from_json(text, f"intrinsics {MATRIX}, extrinsics {MATRIX}")
    return [doc["intrinsics"].alias("K"), doc["extrinsics"].alias("T")]


def calibration_join(episodes: DataFrame, calibration: DataFrame) -> DataFrame:
    """Optional camera of each episode; has_camera_calib tells whether there is one."""
    return episodes.join(calibration, "episode_id", "left").withColumn("has_camera_calib", F.col("K").isNotNull())


def transform_of(text: Column) -> Column:
    """4x4 matrix from JSON: under either of two names, from R and t, or bare; no text gives the identity.

    A matrix of another shape is an error.
    """
    fields = f"struct<T_robot_to_da3:{MATRIX},T_robot_to_world:{MATRIX},R:{MATRIX},t:array<double>>"
    doc, bare = F.from_json(text, fields), F.from_json(text, MATRIX)
    rows = [F.concat(F.get(doc["R"], i), F.array(F.get(doc["t"], i))) for i in range(3)]
    end = F.array(*[F.lit(float(i == 3)) for i in range(4)])
    joined = F.when(doc["R"].isNotNull() & doc["t"].isNotNull(), F.array(*rows, end))
    found = F.coalesce(doc["T_robot_to_da3"], doc["T_robot_to_world"], joined, bare)
    square = (F.size(found) == 4) & F.forall(found, lambda r: F.size(r) == 4)
    checked = F.when(square, found).otherwise(F.raise_error(F.lit("a transform must be 4x4")).cast(MATRIX))
    identity = F.array(*[F.array(*[F.lit(float(i == j)) for j in range(4)]) for i in range(4)])
    return F.when(text.isNull(), identity).otherwise(checked)


def reshape(values: Column, rows: int, cols: int) -> Column:
    """Flat array -> matrix with `rows` rows."""
    return F.array(*[F.slice(values, r * cols + 1, cols) for r in range(rows)])


def explode_cameras(bundles: DataFrame) -> DataFrame:
    """Camera bundle (frame_indices, intrinsics, extrinsics, flat or nested per camera) -> one row per camera.

    Numbers come flat: 9 per camera for K, 12 for the world-to-camera matrix E.
    """
    rows = bundles.select("episode_id", "intrinsics", "extrinsics", F.posexplode("frame_indices").alias("cam_pos", "frame_index"))
    k = F.slice("intrinsics", F.col("cam_pos") * 9 + 1, F.lit(9))
    e = F.slice("extrinsics", F.col("cam_pos") * 12 + 1, F.lit(12))
    return rows.select("episode_id", "cam_pos", F.col("frame_index").cast("bigint").alias("frame_index"), reshape(k, 3, 3).alias("K"), reshape(e, 3, 4).alias("E"))
