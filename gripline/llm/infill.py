"""Fill-in-middle: texts cut into prefix, middle and suffix, and put together anew."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 1
#: Of 100 texts so many stay plain, and of 100 others so many put the suffix first.
PLAIN, SUFFIX_FIRST = 10, 20
#: Bytes of a block of the tree, and bytes looked at together while it is built.
BLOCK = 4096
SLICE = 1 << 20
#: Bytes of output that are sent back together.
BATCH = 8 << 20


class Fenwick:
    """Prefix sums over blocks of several counts at once, each found in as many steps as their number has digits."""

    def __init__(self, counts: np.ndarray):
        tree = np.zeros((len(counts) + 1, counts.shape[1]), np.int64)
        tree[1:] = counts
        size = len(counts)
        step = 1
        while step <= size:  # every node takes in the one half as wide before it
            wide = np.arange(2 * step, size + 1, 2 * step)
            tree[wide] += tree[wide - step]
            step *= 2
        self.tree, self.size = tree, size

    def descend(self, k: int, column: int = 0) -> tuple[int, np.ndarray]:
        """The block that holds item k of one count, and all counts before that block; the number of blocks if no block does."""
        at, before = 0, np.zeros(self.tree.shape[1], np.int64)
        step = 1 << self.size.bit_length()
        while step:
            nxt = at + step
            if nxt <= self.size and before[column] + self.tree[nxt, column] <= k:
                at, before = nxt, before + self.tree[nxt]
            step >>= 1
        return at, before


class Units:
    """Units of a text in UTF-8: runs of ASCII letters, and every other code point by itself.

    A unit begins at each byte that begins a code point and does not go on with a run of letters. Blocks count the units and the
    code points that begin in them.
    """

    def __init__(self, data: bytes, block: int = BLOCK):
        self.data, self.block = np.frombuffer(data, np.uint8), block
        step = max(block, SLICE // block * block)
        counts = []
        for a in range(0, len(self.data), step):
            begins, points = self._marks(a, min(len(self.data), a + step))
            cuts = np.arange(0, len(begins), block)
            counts.append(np.stack([np.add.reduceat(begins, cuts, dtype=np.int64), np.add.reduceat(points, cuts, dtype=np.int64)], axis=1))
        self.tree = Fenwick(np.concatenate(counts) if counts else np.zeros((0, 2), np.int64))
        # The sums over all blocks: no count is as large as the number of bytes and one.
        _, (self.units, self.points) = self.tree.descend(len(self.data) + 1)

    def _marks(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Which bytes of a stretch begin a unit, and which a code point."""
        part = self.data[max(a - 1, 0) : b]
        letter = ((part | 32) - np.uint8(97)) < 26
        points = (part & 0xC0) != 0x80
        goes_on = np.concatenate([[False], letter[:-1]]) & letter
        begins = points & ~goes_on
        skip = 1 if a else 0
        return begins[skip:], points[skip:]

    def cut(self, k: int) -> tuple[int, int]:
        """Bytes and code points before unit k; those of the whole text if it has k units."""
        at, (units, points) = self.tree.descend(k)
        if at == self.tree.size:
            return len(self.data), int(points)
        a = at * self.block
        begins, firsts = self._marks(a, min(len(self.data), a + self.block))
        place = int(np.flatnonzero(begins)[k - units])
        return a + place, int(points) + int(np.count_nonzero(firsts[:place]))


def draws(doc_id: int | None, seed: int = SEED) -> list[int]:
    """Four numbers below 2**32 that the seed and the id give; a missing id counts as an empty one."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12)]


def rearranged(data: bytes, doc_id: int | None, seed: int = SEED) -> tuple[int, str, int | None, int | None, list[bytes]]:
    """Units, form, code points of prefix and middle, and the pieces of the output."""
    units = Units(data)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not data or any(m.encode() in data for m in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= 100 - PLAIN:
        return units.units, "plain", None, None, [data]
    low, high = sorted((h1 % (units.units + 1), h2 % (units.units + 1)))
    (a, before), (b, upto) = units.cut(low), units.cut(high)
    view = memoryview(data)
    prefix, middle, suffix = view[:a], view[a:b], view[b:]
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    if h4 % 100 < SUFFIX_FIRST:
        return units.units, "spm", before, upto - before, [s, suffix, p, prefix, m, middle]
    return units.units, "psm", before, upto - before, [p, prefix, s, suffix, m, middle]


def _run(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"doc_id": pa.int64(), "n": pa.int64(), "form": pa.string(), "prefix_chars": pa.int64(), "middle_chars": pa.int64(), "output": pa.string()}

        def packed(rows: list[tuple], pieces: list) -> pa.RecordBatch:
            ends = np.cumsum([0, *(sum(map(len, p)) for p in pieces)])
            buffer = pa.py_buffer(b"".join(x for p in pieces for x in p))
            output = pa.StringArray.from_buffers(len(pieces), pa.py_buffer(ends.astype(np.int32)), buffer)
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([*[pa.array(c, t) for c, t in zip(columns, list(kinds.values())[:-1], strict=True)], output], list(kinds))

        for batch in batches:
            rows, pieces, size = [], [], 0
            ids = batch.column("doc_id").to_pylist()
            for doc_id, text in zip(ids, batch.column("text").cast(pa.large_binary()), strict=True):
                data = text.as_py()
                n, form, before, inside, parts = rearranged(data, doc_id, seed)
                rows.append((doc_id, n, form, before, inside))
                pieces.append(parts)
                size += len(data)
                if size >= BATCH:
                    yield packed(rows, pieces)
                    rows, pieces, size = [], [], 0
            if rows:
                yield packed(rows, pieces)

    return run


def fill_in_middle(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """Rows (doc_id, n, form, prefix_chars, middle_chars, output), one for each row of doc_id and text.

    A text is n units: runs of ASCII letters, and each other code point. Where the cuts lie, and the form, follow from a hash of the seed
    and the doc_id alone. A prefix-suffix-middle text ("psm") is `<P>`prefix`<S>`suffix`<M>`middle, a suffix-first one ("spm")
    `<S>`suffix`<P>`prefix`<M>`middle; a text that is empty or holds a mark, and one in ten others, stays "plain" with null lengths.

    Units and code points are counted per block of 4,096 bytes, a Fenwick tree holds the counts, and a cut descends it to its block
    and is placed there. A task holds one batch of texts; a text of any length is counted in slices.

    A null text is the empty one. A row without doc_id draws as if its id were empty. Rows that repeat a doc_id are rows of their
    own. An empty table gives an empty one. Other columns are not returned.
    """
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(_run(seed), "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text again from an output and its form; marks never stand in a cut text, so the first one is the right one."""
    width = len(PREFIX)
    body = F.substr(output, F.lit(width + 1))
    left = lambda whole, mark: F.substring_index(whole, mark, 1)
    after = lambda whole, part: F.substr(whole, F.length(part) + F.lit(width + 1))
    first = F.when(form == "spm", left(body, PREFIX)).otherwise(left(body, SUFFIX))
    rest = after(body, first)
    second = left(rest, MIDDLE)
    middle = after(rest, second)
    return F.when(form == "plain", output).when(form == "spm", F.concat(second, middle, first)).otherwise(F.concat(first, middle, second))
