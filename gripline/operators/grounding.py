"""Target-object groundings from model replies, prompts to ask for them, and the batch hook that asks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gripline.functions import replies as R
from gripline.functions.text import strip
from gripline.operators.blocks import KEY

# --- fixed values: error codes ---------------------------------------------------------------
DISABLED = "vlm_disabled"
NO_FRAME = "failed_to_read_first_frame"
TRIES = 3


def grounding_record(replies: DataFrame, width: Column, height: Column, text: str = "raw_text") -> DataFrame:
    """Name, box, centre and confidence of the object a reply names; raw keeps the parsed JSON text.

    The centre is the middle of the box when there is one, else the clamped centre of the reply. `confidence` is the reply's
    where that is a number or the text of one; `confidence_text` is it whatever its type: texts as they are, others as JSON.
    """
    parsed = replies.withColumn("raw", R.parse_grounding(F.col(text))).withColumn("_v", F.try_parse_json("raw"))
    v = F.col("_v")
    picked = (
        parsed.withColumn("_name", R.first_value(v, R.OBJECT_KEYS)["text"])
        .withColumn("_box_value", R.first_value(v, R.BOX_KEYS))
        .withColumn("_center_value", R.first_value(v, R.CENTER_KEYS))
        .withColumn("_box", R.numbers_of(F.col("_box_value"), 4))
        .withColumn("_center", R.numbers_of(F.col("_center_value"), 2))
    )
    box = R.normalize_bbox(F.col("_box"), width, height)
    center = R.normalize_center(F.col("_center"), width, height)
    return (
        picked.withColumn("target_object", F.coalesce(strip(F.col("_name")), F.lit("")))
        .withColumn("bbox_xyxy", box)
        .withColumn("center_xy", F.coalesce(R.box_center(F.col("bbox_xyxy")), center))
        .withColumn("frame_size", F.array(width, height))
        .withColumn("confidence", F.try_variant_get(v, "$.confidence", "double"))
        .withColumn("confidence_text", F.try_variant_get(v, "$.confidence", "string"))
        .drop("_v", "_name", "_box_value", "_center_value", "_box", "_center")
    )


def empty_grounding(episodes: DataFrame, error: str, width: Column | None = None, height: Column | None = None) -> DataFrame:
    """Record without an object, for a disabled model or an unreadable frame."""
    size = F.array(width, height) if width is not None else F.lit(None).cast("array<int>")
    return episodes.select(
        KEY,
        F.lit("").alias("target_object"),
        F.lit(None).cast("array<double>").alias("bbox_xyxy"),
        F.lit(None).cast("array<double>").alias("center_xy"),
        size.alias("frame_size"),
        F.lit(None).cast("double").alias("confidence"),
        F.lit(None).cast("string").alias("confidence_text"),
        F.lit(error).alias("error"),
    )


GROUNDING_PROMPT = "Instruction for the robot: %s\nName the object to be handled and mark it in the image. Answer as one JSON object."


def joined_instruction(instruction: Column, is_list: bool = False) -> Column:
    return F.array_join(instruction, " ") if is_list else instruction


def grounding_prompt(instruction: Column) -> Column:
    return F.format_string(GROUNDING_PROMPT, instruction)


PLANNING_PROMPT = (
    "Instruction for the robot: %s\nFrames %d to %d, shown: %s (%s).\n"
    "Split the recording into subtasks. Answer with a JSON object holding subtask_segments."
)


def planning_prompt(instruction: Column, first: Column, last: Column, shown: Column, mode: str) -> Column:
    listed = F.array_join(shown.cast("array<string>"), ", ")
    return F.format_string(PLANNING_PROMPT, instruction, first, last, listed, F.lit(mode))


def first_parsed(replies: DataFrame, parsed: Column, attempt: str = "attempt", tries: int = TRIES, keys: tuple[str, ...] = (KEY,)) -> DataFrame:
    """Reply of the first attempt that can be parsed, null when none of the first `tries` can."""
    usable = F.when(parsed.isNotNull() & (F.col(attempt) < tries), F.col(attempt))
    return replies.groupBy(*keys).agg(F.min_by("raw_text", usable).alias("raw_text"), F.min(usable).alias(attempt))


def score_batches(
    requests: DataFrame,
    generate: Callable[[list[str]], list[str]],
    accept: Callable[[str], bool],
    prompt: str = "prompt",
    tries: int = TRIES,
) -> DataFrame:
    """Ask `generate` for replies, one Arrow batch of prompts at a time; refused ones are asked again.

    A call that raises is a failed try of its whole batch. Adds raw_text (null when no try was accepted), attempt and
    the last error of an open row.
    """
    schema = T.StructType([*requests.schema.fields, T.StructField("raw_text", T.StringType()), T.StructField("attempt", T.IntegerType()), T.StructField("error", T.StringType())])

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = pd.Series([None] * len(batch), index=batch.index, dtype=object)
            tried = pd.Series([None] * len(batch), index=batch.index, dtype="Int32")
            errors = pd.Series([None] * len(batch), index=batch.index, dtype=object)
            open_rows = list(batch.index)
            for attempt in range(tries):
                if not open_rows:
                    break
                try:
                    answers = generate(batch.loc[open_rows, prompt].tolist())
                except Exception as error:  # noqa: BLE001 - whatever the model raises is a failed try
                    errors[open_rows] = f"{type(error).__name__}: {error}"
                    continue
                good = [(i, a) for i, a in zip(open_rows, answers) if a is not None and accept(a)]
                for i, a in good:
                    found[i], tried[i] = a, attempt
                done = {i for i, _ in good}
                open_rows = [i for i in open_rows if i not in done]
            yield batch.assign(raw_text=found, attempt=tried, error=errors)

    return requests.mapInPandas(ask, schema)
