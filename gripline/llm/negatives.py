"""Hard negatives among labelled embeddings: a vertical branch-and-bound scan over whole numbers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gripline.llm.common import written

#: Components become floor(SCALE * x).
SCALE = 256
POSITIVES = 5
NEGATIVES = 10
#: A negative's score lies between these hundredths of its positive's score.
LOW, HIGH = 30, 90
#: Anchors that a task holds at once; the vectors stream past them.
ANCHORS = 1024
#: The vectors are dealt to so many lanes at least, and to one more for so many vectors.
LANES = 8
PER_LANE = 1 << 20
#: Dimensions read before candidates are dropped for the first time; every later step reads as many as all before it.
STEP = 8
#: Whole numbers up to here are exact as doubles.
EXACT = 2.0**53
MOST = 2**63 - 1

FOUND = "a_id long, a_h long, p int, positive_id long, positive_score long, id long, h long, score long"


def quantised(x: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * x)


def _whole(row: np.ndarray) -> list[int]:
    """Components as Python's integers, for those too large for doubles to add exactly."""
    return [int(v) * SCALE if abs(v) >= 2.0**53 else int(np.floor(SCALE * v)) for v in row.tolist()]


class Block:
    """Vectors by columns, with the least and greatest value of each column."""

    def __init__(self, batch: pa.RecordBatch):
        n = batch.num_rows
        ids = batch.column("id")
        self.missing = np.asarray(ids.is_null())
        self.id = np.asarray(ids.fill_null(0))
        self.h = np.asarray(batch.column("h"))
        self.label = np.asarray(batch.column("label"))
        self.raw = batch.column("embedding").flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
        with np.errstate(over="ignore"):
            self.columns = np.ascontiguousarray(quantised(self.raw).T)
        self.low, self.high = self.columns.min(axis=1, initial=np.inf), self.columns.max(axis=1, initial=-np.inf)
        self.all = np.arange(n)

    def exact_scores(self, raw: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Scores by Python's integers, held to the range of 64 bits."""
        a = _whole(raw)
        sums = (sum(x * y for x, y in zip(a, _whole(self.raw[r]), strict=True)) for r in rows)
        return np.array([max(-MOST, min(MOST, s)) for s in sums], np.int64)


class Anchor:
    """An anchor with its windows of scores and the best rows met in each."""

    def __init__(self, id_: int, h: int, label: int, raw: np.ndarray, windows: list[tuple[int, int]], keep: int):
        self.id, self.h, self.label, self.raw, self.windows, self.keep = id_, h, label, raw, windows, keep
        with np.errstate(over="ignore"):
            self.q = quantised(raw)
        self.order = np.argsort(-np.abs(self.q), kind="stable")
        self.best = [np.zeros((0, 4), np.int64) for _ in windows]

    def meet(self, block: Block, same: bool) -> None:
        """Take in the block's rows of the same label (but not the anchor's own) or of the others."""
        alive = np.flatnonzero((block.label == self.label) == same)
        if same:
            alive = alive[(block.id[alive] != self.id) | block.missing[alive] | (block.h[alive] != self.h)]
        if not len(alive) or not self.windows:
            return
        with np.errstate(over="ignore", invalid="ignore"):
            reach = np.abs(self.q) @ np.maximum(np.abs(block.low), np.abs(block.high))
        if reach < EXACT:
            alive, score = self._scan(block, alive)
        else:
            score = block.exact_scores(self.raw, alive)
        for w, (low, high) in enumerate(self.windows):
            inside = np.flatnonzero((score >= low) & (score <= high))
            if len(self.best[w]) == self.keep:
                inside = inside[score[inside] >= self.best[w][-1, 0]]
            if len(inside):
                rows = alive[inside]
                met = np.stack([score[inside], block.missing[rows].astype(np.int64), block.id[rows], block.h[rows]], axis=1)
                every = np.concatenate([self.best[w], met])
                first = np.lexsort((every[:, 3], every[:, 2], every[:, 1], -every[:, 0]))[: self.keep]
                self.best[w] = every[first]

    def _scan(self, block: Block, alive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows that may still be among the first of a window once all columns are read, with their scores.

        Columns are read in descending size of the anchor's components. What the unread columns can still add lies between two
        sums over their least and greatest values; rows that this leaves outside of every window, or below as many rows that
        are surely inside as are kept, are dropped.
        """
        order = self.order
        one, two = self.q[order] * block.low[order], self.q[order] * block.high[order]
        rest = lambda part: np.concatenate([np.cumsum(part[::-1])[::-1], [0.0]])
        least, most = rest(np.minimum(one, two)), rest(np.maximum(one, two))
        bars = [float(b[-1, 0]) if len(b) == self.keep else -np.inf for b in self.best]
        score = np.zeros(len(alive))
        whole = len(alive) == len(block.all)
        start, dims = 0, len(order)
        while start < dims and len(alive):
            end = min(dims, max(STEP, 2 * start))
            part = block.columns[order[start:end]]
            score += self.q[order[start:end]] @ (part if whole else part[:, alive])
            low, high = score + least[end], score + most[end]
            stay = np.zeros(len(alive), bool)
            for w, (bottom, top) in enumerate(self.windows):
                sure = low[(low >= bottom) & (high <= top)]
                if len(sure) >= self.keep:
                    bars[w] = max(bars[w], float(np.partition(sure, len(sure) - self.keep)[len(sure) - self.keep]))
                stay |= (high >= max(bottom, bars[w])) & (low <= top)
            if not stay.all():
                alive, score, whole = alive[stay], score[stay], False
            start = end
        return alive, score.astype(np.int64)


def window_of(positive_score: int) -> tuple[int, int]:
    """The whole scores s with LOW * positive <= 100 * s <= HIGH * positive."""
    return -(-LOW * positive_score // 100), HIGH * positive_score // 100


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], int, pa.RecordBatch]]:
    """The stretches of rows of one task, dimension and kind."""
    for batch in batches:
        marks = np.stack([np.asarray(batch.column(c)).astype(np.int64) for c in ("task", "dim", "kind")], axis=1)
        starts = np.flatnonzero(np.concatenate([[True], (marks[1:] != marks[:-1]).any(axis=1)])) if len(marks) else []
        for a, b in zip(starts, [*starts[1:], len(marks)], strict=True):
            yield (int(marks[a, 0]), int(marks[a, 1])), int(marks[a, 2]), batch.slice(a, b - a)


def _search(same: bool, keep: int):
    """The best rows of every anchor among the vectors of its task: of its label, or of others inside its windows."""

    def results(anchors: list[tuple[Anchor, list]]) -> pa.RecordBatch:
        rows = []
        for a, positives in anchors:
            for w, best in enumerate(a.best):
                p, score = positives[w] if positives else (None, None)
                rows += [(a.id, a.h, w + 1, p, score, None if missing else i, h, s) for s, missing, i, h in best.tolist()]
        kinds = [pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 5]
        columns = list(zip(*rows, strict=True)) if rows else [()] * 8
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], [c.split()[0] for c in FOUND.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, anchors = None, []
        for at, kind, part in _runs(batches):
            if at != key:
                if anchors:
                    yield results(anchors)
                key, anchors = at, []
            if kind == 0:
                raw = part.column("embedding").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                rows = zip(*(part.column(c).to_pylist() for c in ("id", "h", "label", "positives")), raw, strict=True)
                for i, h, label, found, x in rows:
                    positives = [(p["id"], p["score"]) for p in found or []]
                    windows = [(-MOST, MOST)] if same else [window_of(s) for _, s in positives]
                    anchors.append((Anchor(i, h, label, x, windows, keep), positives))
            elif anchors:
                block = Block(part)
                for a, _ in anchors:
                    a.meet(block, same)
        if anchors:
            yield results(anchors)

    return run


def _ranked(rows: DataFrame, group: list[str], keep: int) -> DataFrame:
    """The first rows of each group; Spark applies the limit before the shuffle as well."""
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("h")]
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("rank") <= keep)


def hard_negatives(vectors: DataFrame, label: Column | None = None, anchor: Column | None = None, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for every anchor and each of its positives.

    `vectors` has vec_id, embedding and label; `label` (default: the column) may change the label, `anchor` (default: vec_id is
    divisible by 100) tells which rows are anchors. Components become floor(256 * x) and a score is a sum of products of whole
    numbers, exact in 64 bits and held to their range beyond. Positives are the first rows of the anchor's label,
    negatives the first rows of other labels whose score lies between 30 and 90 hundredths of the positive's; higher scores
    come first, then smaller vec_ids.

    Both searches cut the anchors into blocks and the vectors into lanes, and a task streams one lane past one block. It holds the
    vectors by columns, reads these in descending size of an anchor's components and drops rows as soon as the unread
    columns cannot bring them into a window or above the rows kept. It returns the kept rows, not pairs.

    Rows with a null label, a null vector or a null or non-finite component take no part. An empty vector scores 0. Vectors of
    different lengths do not meet. Rows that are equal in vec_id, label and vector count once; rows that only share a vec_id are rows of their own.
    A row without vec_id is no anchor and comes last among equal scores; its id is returned as null. An empty table gives an empty one. Other columns
    are not used.
    """
    array = vectors["embedding"].cast("array<double>")
    odd = F.exists(array, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    vec = vectors["vec_id"].cast("long")
    named = (vectors["label"] if label is None else label).cast("long")
    asked = F.coalesce((vec % 100 == 0) if anchor is None else anchor, F.lit(False)) & vec.isNotNull()
    usable = F.coalesce(vectors["label"].isNotNull() & named.isNotNull() & ~odd, F.lit(False))
    rows = vectors.where(usable).select(vec.alias("id"), named.alias("label"), asked.alias("asked"), F.transform(array, lambda v: v + 0.0).alias("embedding")).distinct()
    h = F.xxhash64("label", "embedding")
    base = written(rows.select("id", "label", "asked", h.alias("h"), F.size("embedding").alias("dim"), "embedding"))
    n, n_anchors = base.agg(F.count("*"), F.count_if("asked")).first()
    blocks, lanes = max(1, -(-n_anchors // ANCHORS)), max(LANES, -(-n // PER_LANE))
    lane = F.pmod(F.xxhash64("h", "id"), F.lit(lanes)).cast("long")
    block = F.pmod(F.xxhash64("id", "h"), F.lit(blocks)).cast("long")
    none = F.lit(None).cast("array<struct<id:bigint,score:bigint>>")
    fields = ["id", "h", "label", "embedding"]

    def search(anchors: DataFrame, same: bool, keep: int) -> DataFrame:
        every = lambda count: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))
        asking = anchors.select(block.alias("b"), every(lanes).alias("l"), "dim", F.lit(0).alias("kind"), *fields, "positives")
        met = base.select(every(blocks).alias("b"), lane.alias("l"), "dim", F.lit(1).alias("kind"), *fields, none.alias("positives"))
        dealt = asking.unionByName(met).select((F.col("b") * lanes + F.col("l")).alias("task"), "dim", "kind", *fields, "positives")
        count = blocks * lanes
        placed = dealt.repartitionById(count, F.col("task").cast("int")).sortWithinPartitions("task", "dim", "kind")
        return placed.mapInArrow(_search(same, keep), FOUND)

    anchors = base.where("asked").withColumn("positives", none)
    near = _ranked(search(anchors, True, positives), ["a_id", "a_h"], positives)
    lists = near.groupBy("a_id", "a_h").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("found"))
    known = F.transform("found", lambda r: F.struct(r["id"].alias("id"), r["score"].alias("score")))
    lists = lists.select(F.col("a_id").alias("id"), F.col("a_h").alias("h"), known.alias("positives"))
    asking = written(base.where("asked").join(lists, ["id", "h"]))
    hard = _ranked(search(asking, False, negatives), ["a_id", "a_h", "p"], negatives)
    return hard.select(F.col("a_id").alias("anchor_id"), "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def shifted_label(vectors: DataFrame) -> Column:
    """Labels with those of ids divisible by 7 moved to the next of ten."""
    label = vectors["label"].cast("long")
    return F.when(vectors["vec_id"] % 7 == 0, (label + 1) % 10).otherwise(label)
