"""Labelled rows for the classifiers, and the split by doc_id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gripline.llm.common import least_hashed, text_of, within_bytes, written


def held_out(doc_id: Column) -> Column:
    """Whether labels of this document may not be learned from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, name: str) -> DataFrame:
    """Rows (id, y) of documents outside the held-out third that have a label 0 or 1."""
    marks = labels.select(labels["doc_id"].cast("long").alias("id"), labels[name].cast("int").alias("y")).where("y in (0, 1)").groupBy("id").agg(F.max("y").alias("y"))
    return docs.where(~held_out(docs["doc_id"])).select(docs["doc_id"].cast("long").alias("id")).distinct().join(marks, "id")


#: Bytes of the texts that a sample holds at most.
SAMPLE_BYTES = 64 << 20


def sample(docs: DataFrame, known: DataFrame, most: int, most_bytes: int = SAMPLE_BYTES) -> tuple[list[str], list[int]]:
    """Texts and labels of at most so many of the rows `known`, those with the smallest id hashes, to the driver.

    Of rows that share an id, the text with the smallest hash counts. Texts that do not fit into `most_bytes` together are left out.
    """
    picked = F.broadcast(least_hashed(known, F.col("id"), most, F.col("id"), F.col("y")))  # `most` rows at most
    texts = docs.select(docs["doc_id"].cast("long").alias("id"), text_of(docs).alias("text")).join(picked, "id")
    one = written(texts.groupBy("id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text")))
    got = sorted(within_bytes(one, most_bytes).select("id", "text", "y").collect())
    return [r["text"] for r in got], [r["y"] for r in got]
