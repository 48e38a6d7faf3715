"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Where rows are put in order of ids, those without one are dealt with this, the largest id; which rows lack one is kept beside it.
LAST = 2**63 - 1
#: Fixed value: the characters that count as space, as a character class.
SPACE = r"\x20\x09-\x0D"


def shared_folder(spark: SparkSession) -> str:
    """A new folder in the one that the cluster names in spark.checkpoint.dir.

    Where none is named, a local session gets a temporary one; a cluster raises, since executors do not share
    a local folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="gripline-llm-")
    return f"{named.rstrip('/')}/llm-{uuid.uuid4().hex}"


def written(rows: DataFrame) -> DataFrame:
    """Rows written once as Parquet to the shared folder and read back: lineage ends here, and lost executors lose nothing."""
    folder = shared_folder(rows.sparkSession)
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def width(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def text_of(docs: DataFrame, name: str = "text") -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(docs[name].cast("string"), F.lit(""))


def id_of(docs: DataFrame, name: str) -> Column:
    """An integer id with null after all others."""
    return F.coalesce(docs[name].cast("long"), F.lit(LAST))


def id_or_content(name: Column, *content: Column) -> Column:
    """A name for a row: its integer id, or a hash of its content where that is missing.

    Names only tell rows apart. Which rows have an id, and the least id of a group, is kept beside them, so every 64-bit id is one.
    """
    return F.coalesce(name.cast("long"), F.xxhash64(*content))


def two_hashes(*columns: Column) -> list[Column]:
    """128 bits that name a value: two hashes with different seeds."""
    return [F.xxhash64(*columns).alias("h1"), F.xxhash64(F.lit(1), *columns).alias("h2")]


def spread(c: Column, parts: int) -> Column:
    """A part from 0 to parts - 1 that depends on the value alone, written so that other SQL engines can repeat it."""
    return F.conv(F.substring(F.md5(F.coalesce(c.cast("string"), F.lit("null")).cast("binary")), 1, 6), 16, 10).cast("long") % F.lit(parts)


def least_hashed(rows: DataFrame, key: Column, most: int, *columns: Column) -> DataFrame:
    """At most so many rows, those whose key has the smallest hashes: the same rows on each run.

    Rows are counted first, and only those below a share of the hashes that holds about `most` of them are sorted, so all tasks
    together send little more than `most` rows, however many tasks there are.
    """
    hashed = rows.select(*columns, F.xxhash64(F.lit("sample"), key).alias("_h"), key.alias("_k"))
    n = rows.count()
    share = min(1.0, 1.2 * (most + 50) / max(1, n))
    while share < 1:
        below = hashed.where(F.col("_h") < F.lit(int(-(2**63) + share * 2**64)))
        if below.count() >= min(most, n):
            hashed = below
            break
        share = min(1.0, 4 * share)  # few keys that repeat often leave gaps
    return hashed.orderBy("_h", "_k").limit(most).drop("_h", "_k")


def within_bytes(texts: DataFrame, most: int) -> DataFrame:
    """Of rows with an integer id and a text, in order of the ids' hashes, those whose texts still fit into so many bytes.

    The rows are few (a bounded sample) and written; the driver sees their ids and lengths. Where no text fits, the shortest stays.
    """
    sizes = sorted(texts.select(F.xxhash64("id").alias("h"), "id", F.octet_length("text").alias("n")).collect())
    chosen, used = [], 0
    for _, name, n in sizes:
        if used + n <= most:
            chosen.append(name)
            used += n
    if sizes and not chosen:
        chosen = [min(sizes, key=lambda r: r["n"])["id"]]
    if len(chosen) == len(sizes):
        return texts
    few = texts.sparkSession.createDataFrame([(i,) for i in chosen], "id long")
    return texts.join(F.broadcast(few), "id", "left_semi")


def cuts(rows: DataFrame, key: Column, parts: int, per_part: int = 200) -> list[int]:
    """Bounds between ranges of nearly equal counts, from a sample of at most parts * per_part ids that each run takes again."""
    got = sorted(r[0] for r in least_hashed(rows, key, parts * per_part, key.alias("id")).collect())
    return sorted({got[len(got) * i // parts] for i in range(1, parts)}) if got else []


def range_of(key: Column, bounds: list[int]) -> Column:
    """The number of bounds not above the key, as a balanced tree of comparisons."""

    def tree(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        mid = (low + high) // 2
        return F.when(key < F.lit(bounds[mid]), tree(low, mid)).otherwise(tree(mid + 1, high))

    return tree(0, len(bounds))
