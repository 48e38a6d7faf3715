"""Near duplicates among texts: ProbMinHash signatures of weighted shingles, banding and verification."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gripline.llm.common import SPACE, id_or_content, shared_folder, text_of, width, written
from gripline.llm.components import components

WORDS = 5
LEAST = 0.8
#: 40 bands of 6 registers miss a pair of similarity 0.8 five times in a million, and propose few pairs far below it.
BANDS = 40
ROWS = 6
#: Shingles worked on at a time.
SLICE = 1 << 18
#: Documents and shingles of a side of a tile, about, and shingles multiplied at a time.
TILE_DOCS = 256
TILE_SHINGLES = 1 << 18
COLUMNS = 1 << 12
#: Constants of a well-known 64-bit mixing function.
STEP = np.uint64(0x9E3779B97F4A7C15)
MIX1 = np.uint64(0xBF58476D1CE4E5B9)
MIX2 = np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


def word_hashes(text: Column) -> Column:
    """Hashes of the lower-cased words of a text, in order."""
    bare = F.btrim(F.lower(text), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(F.octet_length(bare) == 0, F.array().cast("array<bigint>")).otherwise(F.transform(F.split(bare, f"[{SPACE}]+"), lambda w: F.xxhash64(w)))


def shingles(flat: np.ndarray, offsets: np.ndarray, size: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all documents, the document number, hash and count of each different shingle of `size` words, in order of
    document and hash; a document with fewer words has one shingle of all of them, one without words none."""
    n = np.diff(offsets)
    many = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    doc = np.repeat(np.arange(len(n)), many)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(offsets[:-1], many)
    words = flat.view(np.uint64)
    h = np.zeros(len(doc), np.uint64)
    length = n[doc]
    for k in range(size):
        there = length > k
        nxt = mixed(h * STEP + words[np.minimum(at + k, len(words) - 1)] + np.uint64(k + 1))
        h = nxt if there.all() else np.where(there, nxt, h)
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    first = np.flatnonzero(new)
    return doc[first], h[first], np.diff(np.append(first, len(doc)))


def signatures(doc: np.ndarray, h: np.ndarray, weight: np.ndarray, docs: int, registers: int) -> np.ndarray:
    """The shingle that each register of each document holds.

    Every shingle arrives at random times, a Poisson process whose rate is its weight, each time at a random register; times
    and registers come from its hash alone, so all documents agree on them. A register holds the shingle that arrived first.
    Two documents agree in a register with their probability Jaccard similarity. A shingle stops once its next time is
    later than all registers' first arrivals.
    """
    first = np.full(docs * registers, np.inf)
    holder = np.zeros(docs * registers, np.uint64)
    time, state = np.zeros(len(h)), h.copy()
    base = doc * registers
    live = np.arange(len(h))
    with np.errstate(over="ignore"):
        while len(live):
            s = state[live] + STEP
            u = mixed(s)
            s = s + STEP
            state[live] = s
            register = (mixed(s) % np.uint64(registers)).astype(np.int64)
            t = time[live] - np.log(((u >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weight[live]
            time[live] = t
            key = base[live] + register
            better = np.flatnonzero(t < first[key])
            k, v = key[better], t[better]
            np.minimum.at(first, k, v)
            won = first[k] == v
            holder[k[won]] = h[live[better[won]]]
            last = first.reshape(docs, registers).max(axis=1)
            live = live[t < last[doc[live]]]
    return holder.reshape(docs, registers)


def _batches(batch: pa.RecordBatch, most: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Ranges of rows with about so many words, with their word hashes and offsets."""
    words = batch.column("words")
    offsets = np.asarray(words.offsets).astype(np.int64)
    flat = words.values.to_numpy(zero_copy_only=False)
    start = 0
    while start < len(batch):
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + most, side="right")) - 1)
        stop = min(stop, len(batch))
        yield start, stop, flat[offsets[start] : offsets[stop]], offsets[start : stop + 1] - offsets[start]
        start = stop


def _sign(bands: int, rows: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, flat, offsets in _batches(batch):
                with np.errstate(over="ignore"):
                    doc, h, n = shingles(flat, offsets, size)
                    held = signatures(doc, h, n.astype(np.float64), b - a, bands * rows).reshape(b - a, bands, rows)
                    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (b - a, bands)) * STEP
                    for r in range(rows):
                        key = mixed(key + held[:, :, r])
                some = np.diff(offsets) > 0
                ends = np.concatenate([[0], np.cumsum(np.where(some, bands, 0))]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(key[some].view(np.int64).ravel()))
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("doc", "own", "h1", "h2")), lists], ["doc", "own", "h1", "h2", "bands"])

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, flat, offsets in _batches(batch):
                with np.errstate(over="ignore"):
                    doc, h, n = shingles(flat, offsets, size)
                ends = pa.array(np.searchsorted(doc, np.arange(b - a + 1)).astype(np.int32))
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.ListArray.from_arrays(ends, pa.array(h.view(np.int64))), pa.ListArray.from_arrays(ends, pa.array(n.astype(np.int32)))], ["id", "shingles", "counts"])

    return run


def similarity(a: np.ndarray, x: np.ndarray, b: np.ndarray, y: np.ndarray) -> float:
    """Exact probability Jaccard of two weighted sets with sorted hashes a, b and weights x, y: the sum over common
    elements i of 1 / sum over all j of max(x_j / x_i, y_j / y_i)."""
    common, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    if x.max() == 1 and y.max() == 1:
        return len(common) / (len(a) + len(b) - len(common))
    xi, yi = x[i].astype(np.float64), y[j].astype(np.float64)
    only_x, only_y = x.sum() - xi.sum(), y.sum() - yi.sum()
    ratio = yi / xi
    order = np.argsort(ratio, kind="stable")
    xi, yi, ratio = xi[order], yi[order], ratio[order]
    upto = np.searchsorted(ratio, ratio, side="right")  # elements whose ratio is no larger count with x
    sx, sy = np.concatenate([[0], np.cumsum(xi)]), np.concatenate([[0], np.cumsum(yi)])
    return float((1 / ((sx[upto] + only_x) / xi + (sy[-1] - sy[upto] + only_y) / yi)).sum())


def _verify(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arrays = []
            for name in ("a_shingles", "a_counts", "b_shingles", "b_counts"):
                column = batch.column(name)
                arrays.append((np.asarray(column.offsets), column.values.to_numpy(zero_copy_only=False)))
            yes = [k for k in range(len(batch)) if similarity(*(v[o[k] : o[k + 1]] for o, v in arrays)) >= least - 1e-12]
            part = batch.take(pa.array(yes, pa.int64()))
            yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], ["a", "b"])

    return run


def _tiled(apart: DataFrame, stored: DataFrame, tasks: int) -> DataFrame:
    """Rows of the tiles in which documents of a hub that are still apart meet: its rest on the left, all of them on the right.

    Both sides are dealt to blocks of about TILE_DOCS documents and TILE_SHINGLES shingles, so a tile is small however large the group.
    """
    rows = apart.join(stored, "id").withColumn("n", F.size("shingles"))
    blocks = lambda docs, n: F.greatest(F.ceil(docs / F.lit(TILE_DOCS)), F.ceil(n / F.lit(TILE_SHINGLES)), F.lit(1)).cast("long")
    counts = rows.groupBy("hub").agg(
        blocks(F.count_if("rest"), F.sum(F.when(F.col("rest"), F.col("n")))).alias("lefts"), blocks(F.count("*"), F.sum("n")).alias("rights")
    )
    block = lambda many: F.pmod(F.xxhash64("id"), F.col(many))
    every = lambda many: F.sequence(F.lit(0).cast("long"), F.col(many) - 1)
    left = F.when(F.col("rest"), F.transform(every("rights"), lambda c: F.struct(F.lit(0).alias("side"), block("lefts").alias("row"), c.alias("col"))))
    right = F.transform(every("lefts"), lambda r: F.struct(F.lit(1).alias("side"), r.alias("row"), block("rights").alias("col")))
    places = F.concat(F.coalesce(left, F.array().cast("array<struct<side:int,row:bigint,col:bigint>>")), right)
    dealt = rows.join(counts, "hub").select("hub", "id", "class", "shingles", "counts", F.explode(places).alias("at"))
    tile = ["hub", "row", "col"]
    return dealt.select("hub", "at.row", "at.col", "at.side", "id", "class", "shingles", "counts").repartition(tasks, *tile).sortWithinPartitions(*tile, "side", "id")


def tile_links(side: np.ndarray, ids: np.ndarray, classes: np.ndarray, sets: list[tuple[np.ndarray, np.ndarray]], least: float) -> list[tuple[int, int]]:
    """Pairs of a left (side 0) and a right document whose similarity is `least` or more, as many as join their classes."""
    lengths = np.array([len(h) for h, _ in sets])
    owner = np.repeat(np.arange(len(sets)), lengths)
    _, place, often = np.unique(np.concatenate([h for h, _ in sets]), return_inverse=True, return_counts=True)
    weight = np.concatenate([n for _, n in sets]).astype(np.float32)
    totals = np.array([n.sum() for _, n in sets], np.float64)
    repeats = np.array([n.max() > 1 for _, n in sets])
    # Shingles of one document alone are in no intersection.
    common = often > 1
    number = np.cumsum(common) - 1
    held = common[place]
    owner, place, weight = owner[held], number[place[held]], weight[held]
    order = np.argsort(place, kind="stable")
    owner, place, weight = owner[order], place[order], weight[order]
    cut = int((side == 0).sum())
    both = np.zeros((cut, len(sets) - cut))
    of_left, of_right = np.zeros_like(both), np.zeros_like(both)
    for first in range(0, int(common.sum()), COLUMNS):
        a, b = np.searchsorted(place, [first, first + COLUMNS])
        one = np.zeros((len(sets), min(COLUMNS, int(common.sum()) - first)), np.float32)
        one[owner[a:b], place[a:b] - first] = 1
        both += one[:cut] @ one[cut:].T
        if repeats.any():
            many = np.zeros_like(one)
            many[owner[a:b], place[a:b] - first] = weight[a:b]
            of_left += many[:cut] @ one[cut:].T
            of_right += one[:cut] @ many[cut:].T
    weighted = repeats[:cut, None] | repeats[None, cut:]
    plain = both / (lengths[:cut, None] + lengths[None, cut:] - both)
    # The similarity of weighted sets is never above the share of common shingles in either one's weight.
    bound = np.minimum(of_left / totals[:cut, None], of_right / totals[None, cut:])
    may = np.where(weighted, bound >= least - 1e-6, plain >= least - 1e-12) & (classes[:cut, None] != classes[None, cut:])
    root = {int(c): int(c) for c in classes}

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = c = root[root[c]]
        return c

    links = []
    for i, k in np.argwhere(may):
        j = k + cut
        x, y = find(int(classes[i])), find(int(classes[j]))
        if x != y and (not weighted[i, k] or similarity(*sets[i], *sets[j]) >= least - 1e-12):
            root[x] = y
            links.append((int(ids[i]), int(ids[j])))
    return links


def _compare(least: float):
    columns = ("hub", "row", "col", "side", "id", "class")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            side, ids, classes = (np.concatenate([p.column(c).to_numpy(zero_copy_only=False) for p in parts]) for c in ("side", "id", "class"))
            sets = []
            for p in parts:
                h, n = p.column("shingles"), p.column("counts")
                ends, hashes, counts = np.asarray(h.offsets), h.values.to_numpy(zero_copy_only=False), n.values.to_numpy(zero_copy_only=False)
                starts = np.asarray(n.offsets)
                sets += [(hashes[ends[k] : ends[k + 1]], counts[starts[k] : starts[k + 1]]) for k in range(len(p))]
            links = np.array(tile_links(side, ids, classes, sets, least), np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], ["a", "b"])

        open_tile, parts = None, []
        for batch in batches:
            hub, row, col = (batch.column(c).to_numpy(zero_copy_only=False) for c in columns[:3])
            new = np.flatnonzero((np.diff(hub) != 0) | (np.diff(row) != 0) | (np.diff(col) != 0)) + 1
            for a, b in zip([0, *new], [*new, len(batch)], strict=True):
                if a == b:
                    continue
                tile = (hub[a], row[a], col[a])
                if parts and tile != open_tile:
                    yield done(parts)
                    parts = []
                open_tile = tile
                parts.append(batch.slice(a, b - a))
        if parts:
            yield done(parts)

    return run


def near_duplicates(docs: DataFrame, least: float = LEAST, size: int = WORDS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Rows (doc_id, class_id, kept, row_id): for every row of doc_id and text the smallest doc_id of its class of near duplicates.

    Weighted sets: a document's shingles of `size` lower-cased words with their counts; one with fewer words is one shingle. Two
    documents link if their probability Jaccard similarity is `least` or more (plain Jaccard where no shingle repeats); classes are the
    components of links. Documents with equal word sequences are one document here.

    Signatures propose pairs: documents that agree in all registers of a band share a bucket. First each document is verified
    against the hub of each of its buckets, the one with most companions, which joins large groups without pairs among them. Then documents
    whose buckets have one hub and which are still in different components are compared: those outside the hub's largest component with all
    of the others, in tiles of bounded size that return only the links which join components. So every proposed pair is either compared or
    already within one class. Verification is exact, on whole texts.

    Null and empty texts, and those of blanks, have no shingles: each is a class of its own. A row without doc_id has a
    row_id made of its text and comes after all others; its ids are returned as null. Any 64-bit doc_id is an id. Rows that repeat a doc_id share its class. An empty table gives an empty one. Other columns are not used.
    """
    spark = docs.sparkSession
    base = docs.select(id_or_content(docs["doc_id"], text_of(docs)).alias("doc"), docs["doc_id"].cast("long").alias("own"), text_of(docs).alias("text"))
    hashed = base.select("doc", "own", word_hashes(F.col("text")).alias("words"))
    signed = hashed.select("doc", "own", "words", F.xxhash64("words").alias("h1"), F.xxhash64(F.lit(1), "words").alias("h2"))
    signed = written(signed.mapInArrow(_sign(bands, rows, size), "doc long, own long, h1 long, h2 long, bands array<long>"))
    same = ["h1", "h2"]
    texts = written(signed.where(F.size("bands") > 0).groupBy(*same).agg(F.min("doc").alias("id"), F.first("bands").alias("bands")))
    keys = texts.select("id", F.explode("bands").alias("key"))
    shared = written(keys.join(keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "key"))
    # The hub of a bucket is the document that agrees with most others, as a text does with its many edited copies.
    weights = shared.groupBy("id").agg(F.sum("n").alias("weight"))
    weighted = shared.join(weights, "id")
    hubs = weighted.groupBy("key").agg(F.max(F.struct("weight", F.bitwise_not("id").alias("minus"))).alias("best")).select("key", F.bitwise_not("best.minus").alias("hub"))
    buckets = written(shared.select("key", "id").join(hubs, "key"))
    wanted = buckets.select("id").distinct()
    # Documents that share a bucket are read again; only their texts are shuffled with the ids wanted.
    again = base.drop("own").withColumnRenamed("doc", "id").join(wanted, "id", "left_semi").select("id", word_hashes(F.col("text")).alias("words"))
    sets = again.mapInArrow(_sets(size), "id long, shingles array<long>, counts array<int>")
    name = f"shingle_sets_{uuid.uuid4().hex}"
    sets.write.bucketBy(width(spark), "id").sortBy("id").format("parquet").option("path", shared_folder(spark)).saveAsTable(name)
    stored = spark.table(name)

    def verified(pairs: DataFrame) -> DataFrame:
        sides = [stored.select(F.col("id").alias(s), F.col("shingles").alias(f"{s}_shingles"), F.col("counts").alias(f"{s}_counts")) for s in "ab"]
        return written(pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "a_shingles", "a_counts", "b_shingles", "b_counts").mapInArrow(_verify(least), "a long, b long"))

    tried = written(buckets.where("id <> hub").select(F.least("hub", "id").alias("a"), F.greatest("hub", "id").alias("b")).distinct())
    links = verified(tried)
    classes = written(components(links).withColumnRenamed("component", "class"))
    of = buckets.select("hub", "id").distinct().join(classes, "id", "left").select("hub", "id", F.coalesce("class", "id").alias("class"))
    shares = of.groupBy("hub", "class").agg(F.count("*").alias("n"))
    main = shares.groupBy("hub").agg(F.max_by("class", F.struct("n", "class")).alias("main"), F.count("*").alias("classes")).where("classes > 1").drop("classes")
    apart = written(of.join(main, "hub").select("hub", "id", "class", (F.col("class") != F.col("main")).alias("rest")))
    more = written(_tiled(apart, stored, width(spark)).mapInArrow(_compare(least), "a long, b long"))
    spark.sql(f"drop table {name}")
    # Copies are tied to the text that stands for them; so a doc_id that several rows share has one class.
    members = signed.select("doc", "own", *same, (F.size("bands") > 0).alias("some")).join(texts.select(*same, "id", F.lit(True).alias("some")), [*same, "some"], "left")
    members = written(members.select("doc", "own", F.coalesce("id", "doc").alias("id")))
    copies = members.where("doc <> id").select(F.col("id").alias("a"), F.col("doc").alias("b")).distinct()
    classes = components(links.unionByName(more).unionByName(copies))
    # Names of classes only tell them apart; the least doc_id of each is found among its members.
    # Only linked documents meet the classes' least ids; single ones have no class to be dealt by.
    classes = written(classes)
    lows = members.join(classes, "id").groupBy("component").agg(F.min("own").alias("low"))
    found = members.join(classes.join(lows, "component"), "id", "left").withColumn("class", F.coalesce("component", "id"))
    low = F.when(F.col("component").isNull(), F.col("own")).otherwise(F.col("low"))
    kept = F.coalesce(F.col("own") == low, low.isNull() & (F.col("doc") == F.col("class")))
    return found.select(F.col("own").alias("doc_id"), low.alias("class_id"), kept.alias("kept"), F.col("doc").alias("row_id"))


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs that come first in their class, one for each class.

    Of texts that share a doc_id, the one with the least hash has it here and the others count as rows without doc_id, so that each is
    compared for itself.
    """
    every = [docs[c] for c in docs.columns]
    hashed = F.xxhash64(text_of(docs))
    several = docs.where(docs["doc_id"].isNotNull()).groupBy(docs["doc_id"].cast("long").alias("id")).agg(F.min(hashed).alias("least"), F.max(hashed).alias("most"))
    several = written(several.where("least <> most").select("id", "least"))
    named = docs.join(several, docs["doc_id"].cast("long") == several["id"], "left")
    own = F.when(several["id"].isNull() | (hashed == several["least"]), docs["doc_id"].cast("long"))
    rows = named.select(F.struct(*every).alias("doc"), own.alias("own"), text_of(docs).alias("text"), F.xxhash64(*every).alias("tie"))
    kept = near_duplicates(rows.select(F.col("own").alias("doc_id"), "text"), **options).where("kept").select("row_id").distinct()
    rows = rows.select("doc", id_or_content(rows["own"], rows["text"]).alias("row_id"), "tie")
    rows = rows.join(kept, "row_id", "left_semi").groupBy("row_id").agg(F.min_by("doc", "tie").alias("doc"))
    return rows.select("doc.*")
