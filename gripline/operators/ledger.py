"""Which episode has passed which stage: a table of (episode_id, module, status, error)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gripline.operators.blocks import KEY

# --- fixed values: stage names --------------------------------------------------------------
MODULES = ("m0_ingest", "m1_preprocess", "m2_language", "m3_phase", "m4a_2d", "m4b_3d", "m5_quality", "m6_export")


def register_tasks(episodes: DataFrame, existing: DataFrame, modules: tuple[str, ...] = MODULES) -> DataFrame:
    """Every episode pending in every module; rows that exist stay as they are."""
    new = (
        episodes.select(KEY)
        .distinct()
        .withColumn("module", F.explode(F.array(*[F.lit(m) for m in modules])))
        .join(existing.select(KEY, "module"), [KEY, "module"], "left_anti")
        .select(KEY, "module", F.lit("pending").alias("status"), F.lit(None).cast("string").alias("error"))
    )
    return existing.select(KEY, "module", "status", "error").unionByName(new)


def pending_tasks(tasks: DataFrame, module: str) -> DataFrame:
    return tasks.where((F.col("module") == module) & (F.col("status") == "pending")).select(KEY)


def mark_tasks(tasks: DataFrame, updates: DataFrame, sequence: str = "seq") -> DataFrame:
    """Apply status updates by key; of several the one with the highest sequence counts. Unknown keys do nothing."""
    newest = updates.groupBy(KEY, "module").agg(
        F.max_by(F.struct("status", "error"), sequence).alias("_new")
    )
    joined = tasks.join(newest, [KEY, "module"], "left")
    new = F.col("_new")
    pick = lambda c: F.when(new.isNotNull(), new[c]).otherwise(F.col(c))
    return joined.select(KEY, "module", pick("status").alias("status"), pick("error").alias("error"))


def status_summary(tasks: DataFrame) -> DataFrame:
    return tasks.groupBy("module", "status").agg(F.count(F.lit(1)).alias("tasks"))


def skip_tagged(samples: DataFrame, tag: Column, has_video: Column) -> DataFrame:
    """State of each sample: kept as it is, empty result for lack of a video, or to be worked on."""
    state = F.when(tag, "kept").when(~has_video, "empty").otherwise("work")
    return samples.withColumn("state", state)
