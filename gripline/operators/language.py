"""Tags of an instruction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gripline.functions.text import PRECISION_VERBS, VERB_CATEGORY, literal_map, subtask_sequence, task_object, task_verb, words


def language_tags(episodes: DataFrame, instruction: str = "instruction") -> DataFrame:
    """Verb, object, category, precision flag, quality and subtask sentences of each instruction."""
    verb, known = F.col("task_verb"), F.col("task_verb") != "unknown"
    return (
        episodes.withColumn("_tokens", words(F.lower(F.col(instruction))))
        .withColumn("task_verb", task_verb(F.col("_tokens")))
        .withColumn("task_object", task_object(F.col("_tokens")))
        .withColumn("task_category", F.coalesce(F.element_at(literal_map(VERB_CATEGORY), verb), F.lit("unknown")))
        .withColumn("requires_precision", verb.isin(*PRECISION_VERBS))
        .withColumn("language_quality", F.when(known, 0.9).otherwise(0.3))
        .withColumn("subtask_sequence", subtask_sequence(verb, F.col("task_object")))
        .drop("_tokens")
    )
