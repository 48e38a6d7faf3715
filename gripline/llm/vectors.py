"""Near duplicates among embeddings: spherical k-means cells, blocked cosine products, one vector kept per group."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gripline.llm.common import id_or_content, least_hashed, two_hashes, written
from gripline.llm.components import components

LEAST = 0.98
#: Cells are fitted on at most so many vectors, those with the smallest id hashes; every vector gets a cell.
SAMPLE = 8192
#: One cell for so many vectors, between 4 and MOST_CELLS cells; a cell may hold any number.
PER_CELL = 4096
MOST_CELLS = 1024
ROUNDS = 10
#: Vectors of a block: a task holds two blocks and their products.
BLOCK = 1024


def matrix(column: pa.Array) -> np.ndarray:
    """Arrow lists of one length as rows of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def unit(x: np.ndarray) -> np.ndarray:
    scaled = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow or underflow of squares
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def fit_cells(x: np.ndarray, cells: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centroids of spherical k-means; the first ones are the vectors least like those before."""
    x = unit(x)
    chosen, nearest = [0], x @ x[0]
    while len(chosen) < min(cells, len(x)):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, x @ x[chosen[-1]])
    centres = x[chosen].copy()
    for _ in range(rounds):
        cell = np.argmax(x @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, cell, x)
        norm = np.sqrt(np.einsum("ij,ij->i", sums, sums))
        centres = np.where(norm[:, None] > 1e-12, sums / np.maximum(norm, 1e-12)[:, None], centres)
    return centres


def reach(centres: np.ndarray, least: float) -> np.ndarray:
    """For cells a and b: a vector of a whose product with centre b falls short of that with a by more than this has no
    link into b, since links span at most sqrt(2 - 2 * least) and the cells' border is the plane between the centres."""
    apart = np.sqrt(np.maximum(0, 2 - 2 * centres @ centres.T))
    return apart * math.sqrt(2 - 2 * least) + 1e-9


def _place(centres_of: dict[int, np.ndarray], least: float):
    limits = {d: reach(c, least) for d, c in centres_of.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for the cell of each vector, and one for every lower cell that a link of it may lead to."""
        for batch in batches:
            size = np.asarray(batch.column("dim"))
            for d in np.unique(size):
                rows = np.flatnonzero(size == d)
                part = batch.take(pa.array(rows))
                centres, limit = centres_of[int(d)], limits[int(d)]
                near = unit(matrix(part.column("embedding"))) @ centres.T
                home = np.argmax(near, axis=1)
                short = near[np.arange(len(near)), home][:, None] - near
                guest = (short <= limit[home]) & (np.arange(len(centres))[None, :] < home[:, None])
                who, where = np.nonzero(guest)
                take = np.concatenate([np.arange(len(near)), who])
                out = part.take(pa.array(take))
                cell = np.concatenate([home, where]).astype(np.int32)
                is_home = np.concatenate([np.ones(len(near), bool), np.zeros(len(who), bool)])
                for i in range(0, len(cell), 4096):
                    p = out.slice(i, 4096)
                    yield pa.RecordBatch.from_arrays([p.column("label"), p.column("dim"), pa.array(cell[i : i + 4096]), pa.array(is_home[i : i + 4096]), p.column("id"), p.column("h1"), p.column("copies"), p.column("embedding")], ["label", "dim", "cell", "home", "id", "h1", "copies", "embedding"])

    return run


def _exact(x: np.ndarray, y: np.ndarray) -> float:
    return math.fsum(x * y) / math.sqrt(math.fsum(x * x) * math.fsum(y * y))


def linked(x: np.ndarray, y: np.ndarray, least: float) -> np.ndarray:
    """Which rows of x and y have cosine `least` or more; products close to the limit are computed anew in full."""
    near = unit(x) @ unit(y).T
    yes = near >= least
    for i, j in zip(*np.nonzero(np.abs(near - least) < 1e-12), strict=True):
        yes[i, j] = _exact(x[i], y[j]) >= least
    return yes


def _compare(least: float):
    def run(table: pa.Table) -> pa.Table:
        """Links of the two sides of a task: counts per vector, and its smallest id within what this task links."""
        table = table.combine_chunks()
        side = np.asarray(table.column("side"))
        ids, copies = np.asarray(table.column("id")), np.asarray(table.column("copies"))
        x = matrix(table.column("embedding").combine_chunks())
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        count, low = np.zeros(len(ids), np.int64), ids.copy()
        same = table.column("kind")[0].as_py() == "home" and table.column("i")[0] == table.column("j")[0]
        right = left if same else right
        if len(left) and len(right):
            yes = linked(x[left], x[right], least)
            if same:
                np.fill_diagonal(yes, False)
            count[left] += yes @ copies[right]
            if not same:
                count[right] += yes.T @ copies[left]
            most = np.iinfo(np.int64).max
            while True:
                new = low.copy()
                new[left] = np.minimum(new[left], np.where(yes, low[right][None, :], most).min(axis=1))
                new[right] = np.minimum(new[right], np.where(yes, new[left][:, None], most).min(axis=0))
                if (new == low).all():
                    break
                low = new
        keep = np.flatnonzero(count)
        return pa.table({"id": ids[keep], "h1": np.asarray(table.column("h1"))[keep], "n": count[keep], "low": low[keep]})

    return run


def near_duplicates(vectors: DataFrame, least: float = LEAST, sample: int = SAMPLE, per_cell: int = PER_CELL, block: int = BLOCK) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept) for every row of vec_id, embedding and label.

    Vectors of equal labels link if their cosine, in doubles, is `least` or more. Equal vectors are one vector with a number
    of copies. Cells of spherical k-means (per number of components, fitted on a bounded sample) hold the vectors; a vector also
    visits each lower cell whose border is so near that a link may cross it, so no pair is missed or met twice. Cells are cut
    into blocks and each task compares two of them; it returns counts and the smallest id per linked group, not pairs. The
    links of a group are stars, whose components are found by joins.

    n_links counts the rows linked directly, copies included. Vectors that are null or zero or hold null or non-finite
    components, and those without a label, link with nothing; so do vectors of different lengths. A row without vec_id is
    named by its vector and comes after all others; its ids are returned as null. Any 64-bit vec_id is an id. Rows that repeat a vec_id are rows of their own that share a component. An empty table gives an
    empty one. Other columns are not used.
    """
    array = vectors["embedding"].cast("array<double>")
    odd = F.exists(array, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    usable = F.coalesce(vectors["label"].isNotNull() & ~odd & F.exists(array, lambda v: v != 0.0), F.lit(False))
    plain = F.transform(array, lambda v: v + 0.0)  # no negative zero
    base = vectors.select(id_or_content(vectors["vec_id"], vectors["embedding"]).alias("vec"), vectors["vec_id"].cast("long").alias("own"), F.when(usable, vectors["label"].cast("string")).alias("label"), F.when(usable, plain).alias("embedding"))
    hashed = base.select("vec", "own", "label", *two_hashes(F.col("label"), F.col("embedding")), "embedding")
    same = ["label", "h1", "h2"]
    groups = written(hashed.where("embedding is not null").groupBy(*same).agg(F.min("vec").alias("id"), F.min("own").alias("least"), F.count("*").alias("copies"), F.first("embedding").alias("embedding")).withColumn("dim", F.size("embedding")))
    sizes = {r["dim"]: r["n"] for r in groups.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    centres = {}
    for d, n in sizes.items():
        rows = least_hashed(groups.where(F.col("dim") == d), F.col("id"), sample, F.col("embedding")).collect()
        centres[d] = fit_cells(np.array([r[0] for r in rows]), min(MOST_CELLS, max(4, -(-n // per_cell))))
    # One id may stand for several vectors if rows repeat a vec_id; h1 tells them apart.
    placed = written(groups.select("label", "dim", "id", "h1", "copies", "embedding").mapInArrow(_place(centres, least), "label string, dim int, cell int, home boolean, id long, h1 long, copies long, embedding array<double>"))
    cell = ["label", "dim", "cell"]
    blocks = placed.groupBy(*cell).agg(F.ceil(F.count_if("home") / block).alias("homes"), F.ceil(F.count_if(~F.col("home")) / block).alias("guests"))
    own = F.when(F.col("home"), F.col("homes")).otherwise(F.col("guests"))
    dealt = placed.join(blocks, cell).withColumn("part", F.pmod(F.xxhash64("id", "h1"), own))
    others = F.sequence(F.lit(0).cast("long"), F.col("homes") - 1)
    # (kind, i, j, side): home blocks i <= j meet each other, guest block j meets every home block i.
    task = lambda kind, i, j, side: F.struct(F.lit(kind).alias("kind"), i.cast("long").alias("i"), j.cast("long").alias("j"), side.cast("int").alias("side"))
    part = F.col("part")
    with_homes = F.transform(others, lambda k: task("home", F.least(part, k), F.greatest(part, k), F.when(part > k, 1).otherwise(0)))
    with_guests = F.when(F.col("guests") > 0, F.transform(F.sequence(F.lit(0).cast("long"), F.col("guests") - 1), lambda k: task("guest", part, k, F.lit(0)))).otherwise(F.array().cast("array<struct<kind:string,i:bigint,j:bigint,side:int>>"))
    as_guest = F.transform(others, lambda k: task("guest", k, part, F.lit(1)))
    tasks = dealt.where("homes > 0").withColumn("task", F.explode(F.when(F.col("home"), F.concat(with_homes, with_guests)).otherwise(as_guest)))
    found = tasks.select(*cell, "task.*", "id", "h1", "copies", "embedding").groupBy(*cell, "kind", "i", "j").applyInArrow(_compare(least), "id long, h1 long, n long, low long")
    found = written(found)
    stars = components(found.select(F.col("id").alias("a"), F.col("low").alias("b")))
    counts = found.groupBy("id", "h1").agg(F.sum("n").alias("n"))
    # Names of components only tell them apart; the least vec_id of each is found among its members.
    # Only linked vectors meet the components' least ids; single ones have no component to be dealt by.
    stars = written(stars)
    lows = groups.select("id", "least").join(stars, "id").groupBy("component").agg(F.min("least").alias("low"))
    known = groups.drop("embedding").join(counts, ["id", "h1"], "left").join(stars.join(lows, "component"), "id", "left")
    known = known.select(*same, "copies", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("component", "id").alias("component"), F.when(F.col("component").isNull(), F.col("least")).otherwise(F.col("low")).alias("low"))
    rows = hashed.drop("embedding").join(known, same, "left")
    links = F.coalesce(F.col("n") + F.col("copies") - 1, F.lit(0)).cast("long")
    component = F.coalesce("component", "vec")
    low = F.when(F.col("component").isNull(), F.col("own")).otherwise(F.col("low"))
    kept = F.coalesce(F.col("own") == low, low.isNull() & (F.col("vec") == component))
    return rows.select(F.col("own").alias("vec_id"), links.alias("n_links"), low.alias("component_id"), kept.alias("kept"))
