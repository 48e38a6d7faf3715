"""Benchmark decontamination: an exact filter by the rarest words of each item, then Smith-Waterman alignment of the passages left."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gripline.llm.common import id_or_content, text_of, written
from gripline.llm.minhash import word_hashes

#: Scores of the alignment by words.
MATCH, MISMATCH, GAP = 2, -1, -1
#: An alignment counts from this share of the item's best possible score on.
LEAST = 0.6
#: Items are worked on in batches of about so many words, each in one pass over the documents, so that what is broadcast is bounded.
BATCH_WORDS = 1 << 20
#: The first look at a word of a document is at a table of 2^TABLE_BITS places.
TABLE_BITS = 20
#: Cells and look-ups held at a time.
CELLS = 1 << 24
LOOK_UPS = 1 << 21


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.asarray(column.offsets).astype(np.int64)
    return column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]], offsets - offsets[0]


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


class Items:
    """A batch of items and what an alignment that counts must have.

    An item of n words has 2n as best score, and an alignment of score s or more has at least s / 2 of the item's words in
    place, since a match gives 2 and nothing else gives anything. So it holds at least one of any n - ceil(s / 2) + 1 places of the item:
    those whose words the fewest items share are its seeds. Each word of the passage without a match costs 1 at least, so
    the passage has 3n - s words at most.
    """

    def __init__(self, ids: np.ndarray, flat: np.ndarray, offsets: np.ndarray, least: float):
        self.ids, self.flat, self.offsets = ids, flat, offsets
        self.n = np.diff(offsets)
        best = MATCH * self.n
        s = np.ceil(least * best).astype(np.int64)
        s -= (s - 1) / best >= least
        s += s / best < least
        s = np.maximum(s, 1)
        self.matched = -(-s // MATCH)
        self.span = self.n + best - s
        self.vocabulary, self.codes = np.unique(flat, return_inverse=True)
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[self.vocabulary & ((1 << TABLE_BITS) - 1)] = True
        owner = np.repeat(np.arange(len(ids)), self.n)
        shared = np.bincount(np.unique(owner * max(1, len(self.vocabulary)) + self.codes) % max(1, len(self.vocabulary)), minlength=len(self.vocabulary))
        order = np.lexsort((flat, shared[self.codes], owner))
        rank = np.arange(len(flat)) - np.repeat(offsets[:-1], self.n)
        seeds = order[rank < np.repeat(self.n - self.matched + 1, self.n)]
        pair = np.unique(self.codes[seeds] * max(1, len(ids)) + owner[seeds])
        self.seed_codes, first, self.many = np.unique(pair // max(1, len(ids)), return_index=True, return_counts=True)
        self.first, self.seeded = first, pair % max(1, len(ids))

    def found(self, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of words that items have, and their numbers in the vocabulary."""
        at = np.flatnonzero(self.table[flat & (len(self.table) - 1)])
        code = np.minimum(np.searchsorted(self.vocabulary, flat[at]), len(self.vocabulary) - 1)
        same = self.vocabulary[code] == flat[at]
        return at[same], code[same]

    def candidates(self, row: np.ndarray, code: np.ndarray, rows: int) -> Iterator[tuple[int, int]]:
        """Pairs (row, item) where the row has a seed and enough of the item's words anywhere."""
        there = np.zeros((rows, len(self.vocabulary)), bool)
        there[row, code] = True
        r, k = np.nonzero(there[:, self.seed_codes])
        pairs = np.unique(np.repeat(r, self.many[k]) * len(self.ids) + self.seeded[_ranges(self.first[k], self.many[k])])
        r, item = pairs // len(self.ids), pairs % len(self.ids)
        run = np.cumsum(self.n[item]) // LOOK_UPS
        for part in np.split(np.arange(len(r)), np.flatnonzero(np.diff(run)) + 1):
            if len(part):
                n = self.n[item[part]]
                yes = there[np.repeat(r[part], n), self.codes[_ranges(self.offsets[item[part]], n)]]
                enough = np.add.reduceat(yes, np.cumsum(n) - n, dtype=np.int64) >= self.matched[item[part]]
                yield from zip(r[part][enough].tolist(), item[part][enough].tolist(), strict=True)

    def passages(self, item: int, at: np.ndarray, code: np.ndarray, scratch: np.ndarray) -> list[tuple[int, int]]:
        """Ranges of a row that hold all alignments of the item that count; `at` and `code` are of the row's words in the vocabulary."""
        words, times = np.unique(self.codes[self.offsets[item] : self.offsets[item + 1]], return_counts=True)
        scratch[words] = np.arange(len(words))
        local = scratch[code]
        scratch[words] = -1
        mine = local >= 0
        at, local = at[mine], local[mine]
        need, span = self.matched[item], self.span[item]
        if len(at) < need:
            return []
        k = np.flatnonzero(at[need - 1 :] - at[: len(at) - need + 1] < span)  # so many words near one another
        if not len(k):
            return []
        low, high = at[k + need - 1] - span + 1, at[k] + span
        cut = np.append(True, low[1:] >= high[:-1])
        out = []
        for a, b in zip(low[cut], high[np.append(cut[1:], True)], strict=True):
            inside = local[np.searchsorted(at, a) : np.searchsorted(at, b)]
            if np.minimum(np.bincount(inside, minlength=len(words)), times).sum() >= need:
                out.append((max(0, int(a)), int(b)))
        return out


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Smith-Waterman with linear gaps: best score, and where its alignment begins and ends in the passage."""
    m = len(passage)
    if not m or not len(item):
        return 0, 0, 0
    step = np.arange(m + 1, dtype=np.int64) * -GAP
    score = np.zeros(m + 1, np.int64)
    begin = np.arange(m + 1, dtype=np.int64)  # where the best alignment that ends here began
    best = (0, 0, 0)
    places = np.arange(m + 1, dtype=np.int64)
    for word in item:
        diagonal = score[:-1] + np.where(passage == word, MATCH, MISMATCH)
        up = score[1:] + GAP
        here = np.zeros(m + 1, np.int64)
        start = places.copy()
        here[1:] = np.maximum(0, np.maximum(diagonal, up))
        start[1:] = np.where(here[1:] == 0, places[1:], np.where(diagonal >= up, begin[:-1], begin[1:]))
        raised = here + step  # a gap along the passage: the best earlier cell less the distance
        top = np.maximum.accumulate(raised)
        origin = np.maximum.accumulate(np.where(raised == top, places, 0))
        score = top - step
        begin = start[origin]
        k = int(np.argmax(score))
        if score[k] > best[0]:
            best = (int(score[k]), int(begin[k]), k)
    return best


def _align(shared, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The best alignment of each row and item, where it counts."""
        items = object.__new__(Items)
        vars(items).update(shared.value)
        if not len(items.flat):
            return
        scratch = np.full(len(items.vocabulary), -1, np.int64)
        step = max(1, CELLS // len(items.vocabulary))
        for batch in batches:
            flat, offsets = _lists(batch.column("words"))
            at, code = items.found(flat)
            row = np.repeat(np.arange(len(batch)), np.diff(offsets))[at]
            bounds = np.searchsorted(row, np.arange(len(batch) + 1))
            rows = []
            for r0 in range(0, len(batch), step):
                r1 = min(len(batch), r0 + step)
                a, b = bounds[r0], bounds[r1]
                for r, item in items.candidates(row[a:b] - r0, code[a:b], r1 - r0):
                    r += r0
                    own = items.flat[items.offsets[item] : items.offsets[item + 1]]
                    words = flat[offsets[r] : offsets[r + 1]]
                    mine = slice(bounds[r], bounds[r + 1])
                    got = []
                    for low, high in items.passages(item, at[mine] - offsets[r], code[mine], scratch):
                        score, x, y = align(own, words[low:high])
                        if score / (MATCH * len(own)) >= least:
                            got.append((score / (MATCH * len(own)), -(low + x), low + y))
                    if got:
                        share, first, end = max(got)
                        rows.append((r, items.ids[item], share, -first, end))
            r, *found = zip(*rows, strict=True) if rows else [[]] * 5
            r = pa.array(r, pa.int64())
            columns = [pa.array(c, t) for c, t in zip(found, (pa.int64(), pa.float64(), pa.int64(), pa.int64()), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc").take(r), batch.column("own").take(r), batch.column("text").take(r), *columns], ["doc", "own", "text", "item", "score", "first_word", "end_word"])

    return run


def _leaks(docs: DataFrame, benchmark: DataFrame, least: float) -> DataFrame:
    """Rows (doc, own, text, item_id, score, first_word, end_word); doc and text, a hash, name a row of docs, own is its id."""
    spark = docs.sparkSession
    items = benchmark.select(id_or_content(benchmark["item_id"], text_of(benchmark)).alias("item"), benchmark["item_id"].isNotNull().alias("named"), word_hashes(text_of(benchmark)).alias("words")).where(F.size("words") > 0)
    items = written(items.distinct())
    parts = -(-(items.agg(F.sum(F.size("words"))).first()[0] or 1) // BATCH_WORDS)
    base = docs.select(id_or_content(docs["doc_id"], text_of(docs)).alias("doc"), docs["doc_id"].cast("long").alias("own"), F.xxhash64(text_of(docs)).alias("text"), word_hashes(text_of(docs)).alias("words"))
    found = []
    for k in range(parts):
        batch = items.where(F.pmod(F.xxhash64("item", "words"), F.lit(parts)) == k).toArrow()
        flat, offsets = _lists(batch.column("words").combine_chunks()) if len(batch) else (np.zeros(0, np.int64), np.zeros(1, np.int64))
        shared = spark.sparkContext.broadcast(vars(Items(batch.column("item").to_numpy(), flat, offsets, least)))
        found.append(base.mapInArrow(_align(shared, least), "doc long, own long, text long, item long, score double, first_word long, end_word long"))
    aligned = found[0]
    for more in found[1:]:
        aligned = aligned.unionByName(more)
    best = aligned.groupBy("doc", "own", "text", "item").agg(F.max(F.struct("score", (-F.col("first_word")).alias("minus"), "end_word")).alias("best"))
    # Items are few beside documents; a pair is told the item's id, if it has one.
    named = items.select("item", F.when(F.col("named"), F.col("item")).alias("item_id")).groupBy("item").agg(F.max("item_id").alias("item_id"))
    best = best.join(named, "item")
    return best.select("doc", "own", "text", "item_id", "best.score", (-F.col("best.minus")).alias("first_word"), "best.end_word")


def matches(docs: DataFrame, benchmark: DataFrame, least: float = LEAST) -> DataFrame:
    """Rows (doc_id, item_id, score, first_word, end_word): each pair of a row of docs (doc_id, text) and a benchmark item
    (item_id, text) whose words align with `least` or more of the item's best possible score, and the words of the
    document, from 0, that align best.

    Words are lower-cased and split at blanks. The seeds of an item are its rarest words, by the items that share them, and as many
    as no alignment of `least` can do without; a document with a seed is a candidate. It is aligned where enough of the item's
    words are near one another. Neither step drops an alignment that counts, so the pairs are those of aligning
    all items with all whole documents. Documents are read once for each batch of items; only what aligned is shuffled.

    Null and empty texts hold nothing, and null or empty items match nothing. Items with equal texts match alike. A missing doc_id or item_id is
    returned as null. Repeated rows give repeated pairs once; rows that share a doc_id and hold different texts are rows of their own. Empty tables give an empty table. Other columns are not used.
    """
    return _leaks(docs, benchmark, least).select(F.col("own").alias("doc_id"), "item_id", "score", "first_word", "end_word", F.col("doc").alias("row_id"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, least: float = LEAST) -> DataFrame:
    """The rows of docs that hold no benchmark item."""
    bad = _leaks(docs, benchmark, least).select(F.col("doc").alias("row_id"), F.col("text").alias("row_text")).distinct()
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), id_or_content(docs["doc_id"], text_of(docs)).alias("row_id"), F.xxhash64(text_of(docs)).alias("row_text"))
    return rows.join(bad, ["row_id", "row_text"], "left_anti").select("doc.*")
