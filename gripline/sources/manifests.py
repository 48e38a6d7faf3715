"""One row per episode for annotation jobs: instruction, video path, what is missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gripline.functions.text import VIDEO_TOKEN, strip
from gripline.operators.blocks import KEY

INSTRUCTION_COLUMNS = ("language_instruction", "instruction_add")  # fixed order of preference


def first_rows(frames: DataFrame, columns: list[str], position: str = "row_index", keys: tuple[str, ...] = (KEY,)) -> DataFrame:
    """First row of each episode in file order. Combines before the shuffle."""
    first = F.min_by(F.struct(*columns), position)
    return frames.groupBy(*keys).agg(first.alias("_r")).select(*keys, *[F.col("_r")[c].alias(c) for c in columns])


def choose_instruction(columns: tuple[str, ...] = INSTRUCTION_COLUMNS) -> Column:
    filled = [F.when(strip(F.col(c)) != "", strip(F.col(c))) for c in columns]
    return F.coalesce(*filled)


def require_instruction(instruction: Column) -> Column:
    return F.when(instruction.isNotNull(), instruction).otherwise(F.raise_error(F.lit("no episode instruction found")).cast("string"))


def fill_template(template: str, values: dict[str, Column]) -> Column:
    """Replace {name} fields by columns."""
    out = F.lit(template)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(value.cast("string"), F.lit("")))
    return out


def template_values(stem: Column, episode: Column, index: Column, chunk: Column, view: Column) -> dict[str, Column]:
    padded = F.format_string("%06d", index.cast("bigint"))
    return {
        "episode_id": episode,
        "parquet_stem": stem,
        "episode_stem": stem,
        "episode_index_06d": F.when(index.isNotNull(), padded),
        "episode_index": index,
        "chunk": chunk,
        "camera_view": view,
    }


def video_path(values: dict[str, Column], template: str | None = None, videos_root: str = "videos") -> Column:
    """Path of an episode's video: from a template, or the default layout below `videos_root`."""
    default = videos_root.rstrip("/") + "/{chunk}/observation.images.primary/{episode_stem}.mp4"
    return fill_template(template or default, values)


def list_files(spark: SparkSession, root: str, pattern: str = "*.mp4") -> DataFrame:
    """Files below a folder as a table of paths; names are listed, contents are not read. Empty files are left out."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    return found.select(plain_path(F.col("path")).alias("path"))


def plain_path(path: Column) -> Column:
    """A path without the scheme of local files."""
    return F.regexp_replace(path, r"^file:(?://)?(?=/)", "")


def name_of_path(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def beside_recording(path: Column, suffix: str = ".mp4") -> Column:
    """The file of the same stem in the recording's own folder."""
    return F.concat(F.regexp_replace(path, r"\.[^./]*$", ""), F.lit(suffix))


def single_file_videos(recordings: DataFrame, listing: DataFrame, video_root: str | None = None) -> DataFrame:
    """Adds `video` to recordings (a row with `path` each) that were given as single files rather than as a folder.

    The video beside the recording counts if the listing has it; else the first one of that name below `video_root`, by the
    names of its folders; else the path beside the recording, which is then missing.
    """
    named = recordings.withColumn("_beside", beside_recording(plain_path(F.col("path"))))
    present = listing.select(F.col("path").alias("_beside")).distinct().withColumn("_here", F.lit(True))
    joined = named.join(present, "_beside", "left").withColumn("_name", name_of_path(F.col("_beside")))
    if video_root is None:
        return joined.withColumn("video", F.col("_beside")).drop("_beside", "_here", "_name")
    below = listing.where(F.col("path").startswith(video_root.rstrip("/") + "/"))
    first = below.groupBy(name_of_path(F.col("path")).alias("_name")).agg(F.min_by("path", F.split("path", "/")).alias("_found"))
    found = joined.join(first, "_name", "left")
    video = F.when(F.col("_here"), F.col("_beside")).otherwise(F.coalesce("_found", "_beside"))
    return found.withColumn("video", video).drop("_beside", "_here", "_name", "_found")


def normal_path(path: Column) -> Column:
    """An absolute path without empty, `.` and `..` steps."""
    kept = F.aggregate(
        F.split(path, "/"),
        F.array().cast("array<string>"),
        lambda done, step: F.when(step.isin("", "."), done).when(step == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).otherwise(F.concat(done, F.array(step))),
    )
    return F.concat(F.lit("/"), F.array_join(kept, "/"))


def render_path(path: Column, base: str | None = None, absolute: bool = False, here: str = "/") -> Column:
    """A path as it stands in records: absolute, or below `base` if it lies there; relative ones start with ./

    Paths that are relative themselves are meant from `here`. Without a base the path stays as it is written.
    """
    whole = normal_path(F.when(path.startswith("/"), path).otherwise(F.concat(F.lit(here.rstrip("/") + "/"), path)))
    if absolute:
        return whole
    shown = path
    if base is not None:
        top = normal_path(F.lit(base if base.startswith("/") else f"{here.rstrip('/')}/{base}"))
        inside = F.concat(F.when(top == "/", "").otherwise(top), F.lit("/"))
        shown = F.when(whole == top, ".").when(whole.startswith(inside), F.substr(whole, F.length(inside) + 1)).otherwise(path)
    return F.when(shown.startswith(".") | shown.startswith("/"), shown).otherwise(F.concat(F.lit("./"), shown))


def episode_manifest(first: DataFrame, path: Column, episode: Column | None = None, columns: tuple[str, ...] = INSTRUCTION_COLUMNS) -> DataFrame:
    """Sample records: videos, text, language_instruction, episode_id. An episode without instruction is an error."""
    instruction = require_instruction(choose_instruction(columns))
    return first.select(
        F.array(render_path(path)).alias("videos"),
        F.concat(F.lit(VIDEO_TOKEN + " "), instruction).alias("text"),
        instruction.alias("language_instruction"),
        (F.col(KEY) if episode is None else episode).alias(KEY),
    )


def missing_videos(manifest: DataFrame, present: DataFrame) -> DataFrame:
    """Episodes whose video path is not among the present files."""
    wanted = manifest.withColumn("path", F.get("videos", 0))
    return wanted.join(present.select("path"), "path", "left_anti").select(KEY, "path")
