"""Packing of token ids into sequences of one length: first-fit decreasing inside random groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gripline.llm.common import text_of, written
from gripline.llm.tokens import encoder_for, slices

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
PAD_ID = 0
LENGTH = 2048
#: Pieces of a group, on the average: a task packs one group at a time.
GROUP = 16384
PIECES = "uid long, piece long, doc_id long, start long, length int, doc_tokens long, ids binary"


def _cut(path: str, end: int, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(path)
        for batch in batches:
            uids, docs = (batch.column(c) for c in ("uid", "doc_id"))
            for a, texts in slices(batch.column("text")):
                found = encoder.texts(texts)
                sizes = np.fromiter((len(x) + 1 for x in found), np.int64, len(found))
                ends = np.cumsum(sizes)
                flat = np.empty(int(ends[-1]), "<u4")
                flat[ends - 1] = end
                inside = np.ones(len(flat), bool)
                inside[ends - 1] = False
                flat[inside] = np.concatenate(found)
                count = -(-sizes // length)
                which = np.repeat(np.arange(len(found)), count)
                piece = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
                start = piece * length
                n = np.minimum(length, sizes[which] - start)
                first = (ends - sizes)[which] + start
                # Pieces lie one after the other in `flat`, so their starts are the offsets of the binary values.
                for i, j in _portions(n):
                    base = first[i]
                    offsets = np.append(first[i:j], first[j - 1] + n[j - 1]) - base
                    ids = pa.Array.from_buffers(pa.binary(), j - i, [None, pa.py_buffer((4 * offsets).astype(np.int32)), pa.py_buffer(flat[base : base + offsets[-1]].tobytes())])
                    take = pa.array(which[i:j] + a)
                    columns = [uids.take(take), pa.array(piece[i:j]), docs.take(take), pa.array(start[i:j]), pa.array(n[i:j].astype(np.int32)), pa.array(sizes[which[i:j]]), ids]
                    yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in PIECES.split(", ")])

    return run


def _portions(n: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of pieces with about so many ids together."""
    part = np.cumsum(n) // most
    starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(n) else []
    yield from zip(starts, [*starts[1:], len(n)], strict=True)


def pieces(docs: DataFrame, path: str | None = None, end: int = END_ID, length: int = LENGTH) -> DataFrame:
    """Rows (uid, piece, doc_id, start, length, doc_tokens, ids): every document's ids and the id `end`, cut after each `length` ids.

    ids holds little-endian unsigned 32-bit integers. uid numbers the rows of docs; it is fixed by being written, so that a lost executor changes
    nothing. A null text is the empty one and has the id `end` alone. A row without doc_id keeps its null, rows that repeat a
    doc_id are documents of their own, an empty table gives an empty one. Other columns are not used.
    """
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))
    return written(rows.mapInArrow(_cut(path, end, length), PIECES))


class Tournament:
    """Bins of one capacity in a row; each inner node knows the largest room below it."""

    def __init__(self, most: int, capacity: int):
        self.leaves = 1 << max(0, most - 1).bit_length()
        self.room = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> tuple[int, int]:
        """Put an item into the first bin with room; returns the bin and the room it had."""
        room, leaves, at = self.room, self.leaves, 1
        while at < leaves:
            at *= 2
            if room[at] < size:
                at += 1
        had = room[at]
        room[at] = had - size
        bin_ = at - leaves
        while at > 1:
            at //= 2
            best = max(room[2 * at], room[2 * at + 1])
            if room[at] == best:
                break
            room[at] = best
        return bin_, had


def first_fit(sizes: list[int], capacity: int) -> list[tuple[int, int]]:
    """Bin and offset of each item, items taken in the given order; no item is larger than the capacity."""
    bins = Tournament(len(sizes), capacity)
    return [(b, capacity - had) for b, had in (bins.place(s) for s in sizes)]


def _pack(capacity: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        n, uid, piece = (np.asarray(table.column(c)) for c in ("length", "uid", "piece"))
        order = np.lexsort((piece, uid, -n.astype(np.int64)))
        placed = first_fit(n[order].tolist(), capacity)
        bins, offsets = np.array(placed, np.int64).reshape(-1, 2).T
        group = np.asarray(table.column("group"))[order]
        return pa.table({"uid": uid[order], "piece": piece[order], "group": group, "bin": bins, "offset": offsets})

    return run


def pack(cut: DataFrame, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """Rows (uid, piece, sequence_id, offset): the place of each piece of `pieces`.

    Pieces are dealt at random, by a hash of uid and piece, to groups of about `group` pieces. Each group is packed by itself: pieces in
    descending length, each into the first sequence with room, found by descending a tournament tree of rooms. A group knows lengths
    only, no ids. A sequence is numbered by its place in the group and the group, so numbers are unique without counting again.
    Of each group, a few sequences at most are left with room.
    """
    sizes = cut.select("uid", "piece", "length")
    groups = max(1, -(-sizes.count() // group))
    dealt = sizes.withColumn("group", F.pmod(F.xxhash64("piece", "uid"), F.lit(groups)).cast("long"))
    placed = dealt.groupBy("group").applyInArrow(_pack(length), "uid long, piece long, group long, bin long, offset long")
    return placed.select("uid", "piece", (F.col("bin") * groups + F.col("group")).alias("sequence_id"), "offset")


def sequences(cut: DataFrame, placed: DataFrame, length: int = LENGTH, pad: int = PAD_ID) -> DataFrame:
    """Rows (sequence_id, n_tokens, ids): the ids of each sequence in order, padded to `length` unless their number is a power of two."""
    joined = cut.select("uid", "piece", "ids").join(placed, ["uid", "piece"])
    grouped = joined.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    ids = F.aggregate(F.col("parts")["ids"], F.lit(b""), lambda all_, part: F.concat(all_, part))
    rows = grouped.select("sequence_id", ids.alias("ids")).withColumn("n_tokens", (F.length("ids") / 4).cast("int"))
    filler = F.unhex(F.repeat(F.lit(int(pad).to_bytes(4, "little").hex()), F.lit(length) - F.col("n_tokens")))
    whole = F.bit_count("n_tokens") == 1
    return rows.select("sequence_id", "n_tokens", F.when(whole, F.col("ids")).otherwise(F.concat("ids", filler)).alias("ids"))


def packed_pieces(docs: DataFrame, path: str | None = None, end: int = END_ID, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """Rows (doc_id, start, length, ids, doc_tokens, sequence_id, offset) for every piece of every document; see `pieces` and `pack`."""
    cut = pieces(docs, path, end, length)
    joined = cut.join(pack(cut, length, group), ["uid", "piece"])
    return joined.select("doc_id", "start", F.col("length").cast("long").alias("length"), "ids", "doc_tokens", "sequence_id", "offset")


def digest(cut: DataFrame, placed: DataFrame) -> DataFrame:
    """Pieces with a checksum in place of their ids, taken before the places are joined, so that no ids are shuffled."""
    short = cut.select("uid", "piece", "doc_id", "start", F.col("length").cast("long").alias("length"), F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return short.join(placed, ["uid", "piece"]).drop("uid", "piece")
