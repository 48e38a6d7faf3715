"""Line dedup against levelled sorted runs of line hashes."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gripline.llm.common import cuts, id_of, range_of, shared_folder, text_of, two_hashes, width, written

MIN_CHARS = 10
BATCHES = 4
FANOUT = 2
#: A key is hot when its lines are more than this part (one in so many) of a mean task.
HOT_PARTS = 4
#: Space characters and the letters that are lower-cased.
BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
KEY = ["h1", "h2"]


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def key_of(line: Column) -> Column:
    """The line without blanks at both ends, A-Z lower-cased; the general lower() is only used on plain ASCII."""
    bare = F.btrim(line, F.lit(BLANKS))
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, UPPER.lower()))


class Runs:
    """Keys seen so far with the document that owns each, as sorted bucketed runs in levels.

    Runs never hold the same key twice: a batch is joined with every run and adds only keys that none has. When a level
    has `fanout` runs they are merged into one of the next level. All runs have the same buckets, so a batch is
    shuffled once and then merged with run after run.
    """

    def __init__(self, spark: SparkSession, buckets: int, fanout: int = FANOUT):
        self.spark, self.buckets, self.fanout = spark, buckets, fanout
        self.levels: list[list[str]] = []

    def names(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def _store(self, rows: DataFrame, level: int) -> None:
        name = f"line_run_{uuid.uuid4().hex}"
        rows.select(*KEY, "owner").write.bucketBy(self.buckets, *KEY).sortBy(*KEY).format("parquet").option("path", shared_folder(self.spark)).saveAsTable(name)
        self.levels += [[] for _ in range(level + 1 - len(self.levels))]
        self.levels[level].append(name)

    def _compact(self) -> None:
        for level in range(len(self.levels)):
            if len(names := self.levels[level]) >= self.fanout:
                self._store(reduce(DataFrame.unionByName, map(self.spark.table, names)), level + 1)
                self.levels[level] = []
                self._forget(names)

    def _forget(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"drop table {name}")

    def add(self, lines: DataFrame) -> DataFrame:
        """Take in the next batch (doc, h1, h2); returns its keys that other documents hold too, with their owners and numbers of lines."""
        batch = lines.groupBy(*KEY).agg(F.min("doc").alias("low"), F.max("doc").alias("high"), F.count("*").alias("rows"))
        known = F.lit(None).cast(lines.schema["doc"].dataType)
        for i, name in enumerate(self.names()):
            run = self.spark.table(name).withColumnRenamed("owner", f"owner{i}")
            batch, known = batch.join(run, KEY, "left"), F.coalesce(known, F.col(f"owner{i}"))
        joined = written(batch.select(*KEY, "low", "high", "rows", known.alias("known")))
        self._store(joined.where("known is null").withColumnRenamed("low", "owner"), 0)
        self._compact()
        return joined.where("known is not null or low < high").select(*KEY, F.coalesce("known", "low").alias("owner"), "rows")

    def close(self) -> None:
        self._forget(self.names())
        self.levels = []


def lost_lines(lines: DataFrame, owners: DataFrame) -> DataFrame:
    """Lines (doc, text_hash, line) whose key another document owns.

    Lines of hot keys never meet in one task: keys that hold more than 1 / (HOT_PARTS * tasks) of all lines are fewer than
    HOT_PARTS * tasks, whatever the corpus, so their owners are sent to all tasks. All other keys are joined on themselves.
    """
    parts = HOT_PARTS * width(lines.sparkSession)
    owners = written(owners.withColumn("hot", F.col("rows") * parts > lines.count()).drop("rows"))
    hot = F.broadcast(owners.where("hot").select(*KEY, "owner"))  # fewer than `parts` rows, as their lines are more than 1 / parts of all
    found = lines.join(hot, KEY).unionByName(lines.join(hot, KEY, "left_anti").join(owners.where("not hot").select(*KEY, "owner"), KEY))
    return found.where("doc <> owner").select("doc", "text_hash", "line")


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """Rows (doc, n_lines, n_dropped, kept): each row of docs in the struct `doc` and its text without repeated lines.

    Keys (see key_of) of at least min_chars code points that two or more documents hold lose all their lines except
    in the document with the smallest doc_id. Documents enter the runs in batches of ascending doc_id, so the first
    document to bring a key owns it; a key repeated within one document stays.

    A null or empty text is one empty line. Rows with a null doc_id come after all others, as one document; rows that share
    a doc_id count as one document. An empty table gives an empty one. Other columns stay in `doc`.
    """
    spark = docs.sparkSession
    key, text = id_of(docs, "doc_id"), text_of(docs)
    doc = F.struct(docs["doc_id"].cast("long").isNull().alias("missing"), key.alias("id"))
    bounds = cuts(docs, key, batches)
    hashes = F.transform(F.transform(lines_of(text), key_of), lambda k: F.when(F.char_length(k) >= min_chars, F.struct(*two_hashes(k))))
    exploded = docs.select(doc.alias("doc"), F.xxhash64(text).alias("text_hash"), range_of(key, bounds).alias("batch"), F.posexplode(hashes).alias("line", "key"))
    lines = written(exploded.where("key is not null").select("doc", "text_hash", "batch", "line", "key.*"))
    runs = Runs(spark, width(spark), fanout)
    shared = reduce(DataFrame.unionByName, [runs.add(lines.where(F.col("batch") == b)) for b in range(len(bounds) + 1)])
    runs.close()
    lost = lost_lines(lines, shared.groupBy(*KEY).agg(F.min("owner").alias("owner"), F.sum("rows").alias("rows")))
    lost = lost.groupBy("doc", "text_hash").agg(F.collect_list("line").alias("lost"))
    base = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), doc.alias("doc"), text.alias("body"), F.xxhash64(text).alias("text_hash"))
    split = base.join(lost, ["doc", "text_hash"], "left").withColumn("lines", lines_of(F.col("body")))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("lost"))
    split = split.withColumn("stay", F.when(F.col("lost").isNotNull(), stay))
    kept = F.array_join(F.transform("stay", lambda i: F.get(F.col("lines"), i)), "\n")
    n_lines = F.size("lines").cast("long")
    return split.select(
        F.col("row").alias("doc"), n_lines.alias("n_lines"), F.coalesce(n_lines - F.size("stay"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("lost").isNull(), F.col("body")).otherwise(kept).alias("kept"),
    )


__all__ = ["BATCHES", "FANOUT", "HOT_PARTS", "MIN_CHARS", "Runs", "dedup_lines", "key_of", "lines_of"]
