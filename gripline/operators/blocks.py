"""Ordered work over episodes of any length.

A window over a whole episode puts that episode into one task, which breaks down when one episode
holds a large part of the data. So every episode is cut into blocks of at most ``BLOCK`` steps and
all shuffles use (episode_id, blk):

* ``index_frames``  numbers the rows of each episode (``step``) and adds episode-wide values,
* ``with_halo``     copies the few rows near a block edge into the next block, for windows of bounded reach,
* ``scan_blocks``   carries a running value (sum, last value, maximum, state change) from block to block
                    over a table with one row per block,
* ``replay_states`` runs a finite-state machine: each block is folded to one state change, the changes
                    are carried, then every block is replayed from its own entry state.

``index_frames`` counts rows first and notes the longest episode on the ``step`` column. When that
count proves that every episode fits into one block, as recordings of a few thousand frames do,
nothing needs to be carried and one shuffle by episode serves all later steps. Without the note
(it does not survive every operation) the general form is used, which is always right.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gripline.sources.session import settle

BLOCK = 4096  # steps of one episode handled together
RUN = 64  # steps of a block replayed together
FAN = 4096  # blocks handled together when values are carried between blocks
PLAIN_ROWS = 1 << 20  # an episode of at most this many rows is numbered by a plain window
TASK_ROWS = 1 << 15  # frames of a task, on average, once there are many
MANY_TASKS = 16  # fewer than this many such tasks are left to Spark

KEY = "episode_id"


def block_number(value: Column, size: int) -> Column:
    return F.floor(value / F.lit(size))


# --------------------------------------------------------------------------------------
# State changes of a machine with at most five states, packed into one integer: three bits per
# start state, holding the state reached from it.
STATES = 5
STAY = sum(s << (3 * s) for s in range(STATES))


def pack_change(next_states: list[Column]) -> Column:
    code = F.lit(0)
    for start, target in enumerate(next_states):
        code = code + F.shiftleft(target.cast("int"), 3 * start)
    return code.cast("int")


def apply_change(code: Column, state: Column) -> Column:
    return F.call_function("shiftright", code, (state * 3).cast("int")).bitwiseAND(F.lit(7))


def then(first: Column, second: Column) -> Column:
    """The change made by `first` followed by `second`."""
    return pack_change([apply_change(second, apply_change(first, F.lit(s))) for s in range(STATES)])


def fold_changes(codes: Column) -> Column:
    return F.aggregate(codes, F.lit(STAY), then)


# --------------------------------------------------------------------------------------
@dataclass(frozen=True)
class Carried:
    """How one value runs over the blocks of an episode (strictly earlier ones, or later ones for `next`)."""

    kind: str
    value: str

    def over(self, earlier, later) -> Column:
        c = F.col(self.value)
        return {
            "sum": lambda: F.coalesce(F.sum(c).over(earlier), F.lit(0)),
            "max": lambda: F.max(c).over(earlier),
            "last": lambda: F.last(c, ignorenulls=True).over(earlier),
            "next": lambda: F.last(c, ignorenulls=True).over(later),
            "fold": lambda: fold_changes(F.collect_list(c).over(earlier)),
        }[self.kind]()

    def total(self, blk: str) -> Column:
        c = F.col(self.value)
        present = F.when(c.isNotNull(), F.col(blk))
        return {
            "sum": lambda: F.sum(c),
            "max": lambda: F.max(c),
            "last": lambda: F.max_by(c, present),
            "next": lambda: F.min_by(c, present),
            "fold": lambda: fold_changes(
                F.transform(F.sort_array(F.collect_list(F.struct(F.col(blk).alias("b"), c.alias("c")))), lambda pair: pair["c"])
            ),
        }[self.kind]()

    def merge(self, outer: Column, inner: Column) -> Column:
        return {
            "sum": lambda: F.coalesce(outer, F.lit(0)) + inner,
            "max": lambda: F.greatest(outer, inner),
            "last": lambda: F.coalesce(inner, outer),
            "next": lambda: F.coalesce(inner, outer),
            "fold": lambda: then(F.coalesce(outer, F.lit(STAY)), inner),
        }[self.kind]()


def scan_blocks(
    blocks: DataFrame, carried: dict[str, Carried], key: tuple[str, ...] = (KEY,), blk: str = "blk", fan: int | None = None, levels: int = 1
) -> DataFrame:
    """Add the carried values to a table with one row per (key, blk).

    Runs of `fan` blocks are worked on apart and joined through one row per run, so the largest
    group in any task is `fan` rows (or the number of runs of one episode).
    """
    fan = FAN if fan is None else fan
    if levels == 0:
        earlier = Window.partitionBy(*key).orderBy(blk).rowsBetween(Window.unboundedPreceding, -1)
        later = Window.partitionBy(*key).orderBy(F.col(blk).desc()).rowsBetween(Window.unboundedPreceding, -1)
        return blocks.select("*", *[c.over(earlier, later).alias(name) for name, c in carried.items()])
    run = f"{blk}_run"
    runs = blocks.withColumn(run, block_number(F.col(blk), fan))
    inner = Window.partitionBy(*key, run)
    earlier = inner.orderBy(blk).rowsBetween(Window.unboundedPreceding, -1)
    later = inner.orderBy(F.col(blk).desc()).rowsBetween(Window.unboundedPreceding, -1)
    local = runs.select("*", *[c.over(earlier, later).alias(f"_in_{name}") for name, c in carried.items()])
    totals = runs.groupBy(*key, run).agg(*[c.total(blk).alias(f"_t_{name}") for name, c in carried.items()])
    outer = scan_blocks(
        totals, {f"_out_{n}": Carried(c.kind, f"_t_{n}") for n, c in carried.items()}, key, run, fan, levels - 1
    ).select(*key, run, *[f"_out_{n}" for n in carried])
    joined = local.join(outer, [*key, run])
    kept = [F.col(c) for c in blocks.columns]
    return joined.select(*kept, *[c.merge(F.col(f"_out_{n}"), F.col(f"_in_{n}")).alias(n) for n, c in carried.items()])


# --------------------------------------------------------------------------------------
def note_longest(rows: DataFrame, longest: int | None) -> DataFrame:
    """Note the length of the longest episode on the step column."""
    return rows if longest is None else rows.withMetadata("step", {"longest": longest})


def longest_of(rows: DataFrame) -> int | None:
    return rows.schema["step"].metadata.get("longest")


def one_block(rows: DataFrame, size: int | None = None) -> bool:
    """True when a count has proved that every episode fits into one block."""
    longest = longest_of(rows)
    return longest is not None and longest <= (size or BLOCK)


def index_frames(
    frames: DataFrame,
    order: str = "frame_index",
    ties: tuple[str, ...] = (),
    episode_values: dict[str, tuple[Column, Callable[[Column], Column]]] | None = None,
    span: int | None = None,
) -> DataFrame:
    """Frames numbered by `number_frames`."""
    return number_frames(frames, order, ties, episode_values, span)[0]


def number_frames(
    frames: DataFrame,
    order: str = "frame_index",
    ties: tuple[str, ...] = (),
    episode_values: dict[str, tuple[Column, Callable[[Column], Column]]] | None = None,
    span: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Number the rows of every episode from 0 (`step`) and add its length (`n_steps`).

    Returns the numbered frames, and the episodes with their values, which are read from the counts
    and cost no pass over the frames.

    `order` is a whole number; rows are counted in blocks of `span` consecutive numbers, `ties`
    settle equal numbers. `episode_values` maps a name to (aggregate over rows, aggregate over
    partial results): values of the whole episode that ride along with the count, such as the
    lowest and highest gripper reading.
    """
    values = episode_values or {}
    cut = frames.withColumn("_blk", block_number(F.col(order), span or BLOCK))
    blocks = settle(
        cut.groupBy(KEY, "_blk").agg(F.count(F.lit(1)).alias("_n"), *[rows.alias(name) for name, (rows, _) in values.items()])
    )
    whole = blocks.groupBy(KEY).agg(
        F.sum("_n").alias("n_steps"), *[parts(F.col(name)).alias(name) for name, (_, parts) in values.items()]
    )
    longest, count = whole.agg(F.coalesce(F.max("n_steps"), F.lit(0)), F.coalesce(F.sum("n_steps"), F.lit(0))).first()
    if longest <= PLAIN_ROWS:
        place = Window.partitionBy(KEY).orderBy(order, *ties)
        # both sides are dealt alike, or Spark would deal the frames again as their counts lie
        numbered = spread(frames, count, KEY).join(spread(whole, count, KEY), KEY).withColumn("step", F.row_number().over(place) - 1)
    else:
        place = Window.partitionBy(KEY, "_blk").orderBy(order, *ties)
        before = scan_blocks(blocks.select(KEY, "_blk", "_n"), {"_before": Carried("sum", "_n")}, blk="_blk").drop("_n")
        local = spread(cut, count, KEY, "_blk").withColumn("_pos", F.row_number().over(place) - 1)
        numbered = local.join(before.join(whole, KEY), [KEY, "_blk"]).withColumn("step", F.col("_before") + F.col("_pos"))
    out = numbered.select(
        *[F.col(f"`{c}`") for c in frames.columns], F.col("step").cast("bigint").alias("step"), F.col("n_steps").cast("bigint").alias("n_steps"), *values
    )
    return note_longest(out.withMetadata(KEY, {"frames": count}), longest), whole


def spread(rows: DataFrame, count: int | None, *keys: str, each: int | None = None) -> DataFrame:
    """Rows dealt by key to as many tasks as their number asks for.

    Spark sizes tasks by the bytes of a shuffle. Frames are narrow there and grow a hundredfold when sorts, windows and lists hold them,
    so the number of tasks follows the counted rows instead, `each` to a task, and a task's memory does not grow with the input.
    """
    tasks = -(-(count or 0) // (each or TASK_ROWS))
    if tasks < MANY_TASKS:
        return rows
    return rows.repartition(max(tasks, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))), *keys)


def count_of(rows: DataFrame) -> int | None:
    """The number of numbered frames that these rows were made from, as noted on the episode column."""
    return rows.schema[KEY].metadata.get("frames")


def with_blocks(indexed: DataFrame, size: int | None = None) -> DataFrame:
    own = F.lit(0).cast("bigint") if one_block(indexed, size) else block_number(F.col("step"), size or BLOCK)
    return indexed.withColumn("blk", own)


def with_halo(indexed: DataFrame, before: int = 0, after: int = 0, size: int | None = None) -> DataFrame:
    """Rows of each block plus copies of up to `before` earlier and `after` later rows.

    Adds `blk` and `home`; windows over (episode_id, blk) then see their whole reach, and
    `home` rows are the result. Needs before, after <= size.
    """
    size = size or BLOCK
    if max(before, after) > size:
        raise ValueError("a window cannot reach further than one block")
    if one_block(indexed, size) or not (before or after):
        return with_blocks(indexed, size).withColumn("home", F.lit(True))
    own = block_number(F.col("step"), size)
    targets = [own]
    if before:
        ahead = block_number(F.col("step") + before, size)
        targets.append(F.when((ahead != own) & (ahead * size < F.col("n_steps")), ahead))
    if after:
        behind = block_number(F.col("step") - after, size)
        targets.append(F.when((behind != own) & (behind >= 0), behind))
    copies = F.filter(F.array(*targets), lambda b: b.isNotNull())
    return indexed.withColumn("blk", F.explode(copies)).withColumn("home", F.col("blk") == own)


def by_step() -> "Window":
    """The window all ordered work shares, so that one shuffle and one sort serve it."""
    return Window.partitionBy(KEY, "blk").orderBy("step")


def attach_episode(indexed: DataFrame, episodes: DataFrame, size: int | None = None, how: str = "left") -> DataFrame:
    """Join one-row-per-episode values to frames on (episode_id, blk) instead of the episode alone.

    `episodes` carries `n_steps`; it is spread to one row per block, so a long episode meets many
    small partners instead of one task holding all of its rows.
    """
    size = size or BLOCK
    if one_block(indexed, size):
        return with_blocks(indexed, size).join(episodes.drop("n_steps"), KEY, how)
    last = block_number(F.col("n_steps") - 1, size)
    spread = episodes.withColumn("blk", F.explode(F.sequence(F.lit(0).cast("bigint"), last))).drop("n_steps")
    return with_blocks(indexed, size).join(spread, [KEY, "blk"], how)


def replay_states(coded: DataFrame, codes: dict[str, str], start: int = 0, payload: list[str] | None = None) -> DataFrame:
    """Run machines over blocked rows.

    `coded` has episode_id, blk, step and one packed change per machine (`codes`: machine name ->
    column). Returns the payload rows with `<machine>_before` and `<machine>` state numbers.
    A block is cut into runs of RUN steps: each run is folded to one change, changes are composed over
    the runs before it, and the run is replayed from there, so that work stays linear in the block.
    """
    payload = payload or []
    size = F.lit(RUN)
    packed = coded.groupBy(KEY, "blk", F.floor(F.col("step") / size).alias("_run")).agg(
        F.sort_array(F.collect_list(F.struct("step", *codes.values(), *payload))).alias("_rows")
    )
    folded = {n: fold_changes(F.col("_rows").getField(c)) for n, c in codes.items()}
    runs = packed.withColumns({f"_c_{n}": c for n, c in folded.items()})
    earlier = Window.partitionBy(KEY, "blk").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    entered = runs.withColumns({f"_b_{n}": fold_changes(F.collect_list(f"_c_{n}").over(earlier)) for n in codes})
    if one_block(coded):
        entry = {n: F.lit(start) for n in codes}
    else:
        changes = runs.groupBy(KEY, "blk").agg(F.sort_array(F.collect_list(F.struct("_run", *[f"_c_{n}" for n in codes]))).alias("_runs"))
        changes = changes.select(KEY, "blk", *[fold_changes(F.col("_runs").getField(f"_c_{n}")).alias(f"_k_{n}") for n in codes])
        carried = scan_blocks(changes, {f"_a_{n}": Carried("fold", f"_k_{n}") for n in codes})
        entered = entered.join(carried.select(KEY, "blk", *[f"_a_{n}" for n in codes]), [KEY, "blk"])
        entry = {n: apply_change(F.col(f"_a_{n}"), F.lit(start)) for n in codes}
    entered = entered.select(KEY, "blk", "_rows", *[apply_change(F.col(f"_b_{n}"), e).alias(f"_e_{n}") for n, e in entry.items()])
    replayed = entered.select(KEY, "blk", "_rows", *[_states(c, n).alias(f"_s_{n}") for n, c in codes.items()])
    names = [f"_s_{n}" for n in codes]
    zipped = replayed.select(KEY, "blk", F.explode(F.arrays_zip("_rows", *names)).alias("_z"))
    out = [F.col("_z")["_rows"][c].alias(c) for c in ("step", *payload)]
    for n in codes:
        pair = F.col("_z")[f"_s_{n}"]
        out += [F.shiftright(pair, 3).alias(f"{n}_before"), pair.bitwiseAND(F.lit(7)).alias(n)]
    return note_longest(zipped.select(KEY, "blk", *out), longest_of(coded))


def _states(code: str, machine: str) -> Column:
    """States of a run in order, each packed with the state before it (before * 8 + now)."""
    return F.expr(
        f"aggregate(_rows.{code}, struct(cast(_e_{machine} as int) as s, cast(array() as array<int>) as seen),"
        " (acc, c) -> struct(shiftright(c, acc.s * 3) & 7 as s, concat(acc.seen, array(acc.s * 8 + (shiftright(c, acc.s * 3) & 7))) as seen)).seen"
    )


# --------------------------------------------------------------------------------------
PER_WORD = 4  # machines whose changes, of 15 bits each, share one 64-bit word


def product_words(changes: list[Column]) -> list[Column]:
    """The packed changes of many machines, four to a word."""
    words = []
    for first in range(0, len(changes), PER_WORD):
        word = F.lit(0).cast("bigint")
        for i, change in enumerate(changes[first : first + PER_WORD]):
            word = word.bitwiseOR(F.shiftleft(change.cast("bigint"), 3 * STATES * i))
        words.append(word)
    return words


def first_in_state(coded: DataFrame, words: list[str], machines: int, state: int, value: str) -> DataFrame:
    """Smallest `value` of each episode at which each machine is in a state: columns f0, f1 and so on.

    `coded` has episode_id, blk, step, `value` and the words of all machines. They run as one product machine: a fold over the ordered
    rows of a block holds every machine's state and the smallest value so far, whatever their number, and keeps no list of
    states. Blocks of longer episodes are entered in the states that the changes of the blocks before them lead to.
    """
    rows = coded.groupBy(KEY, "blk").agg(F.sort_array(F.collect_list(F.struct("step", F.col(value).cast("bigint").alias("_v"), *words))).alias("_rows"))
    names = [f"s{j}" for j in range(len(words))]
    of_word = [range(j * PER_WORD, min(machines, (j + 1) * PER_WORD)) for j in range(len(words))]
    if one_block(coded):
        entry = [F.lit(0).cast("bigint")] * len(words)
    else:
        changes = rows.select(KEY, "blk", *[_fold_machine(words[i // PER_WORD], i % PER_WORD).alias(f"_k{i}") for i in range(machines)])
        carried = scan_blocks(changes, {f"_a{i}": Carried("fold", f"_k{i}") for i in range(machines)})
        rows = rows.join(carried.select(KEY, "blk", *[f"_a{i}" for i in range(machines)]), [KEY, "blk"])
        start = lambda i: apply_change(F.col(f"_a{i}"), F.lit(0)).cast("bigint")
        entry = [sum((F.shiftleft(start(i), 3 * (i % PER_WORD)) for i in of), F.lit(0).cast("bigint")) for of in of_word]
    none = F.lit(None).cast("bigint")
    initial = F.struct(*[e.alias(n) for e, n in zip(entry, names)], *[none.alias(f"f{i}") for i in range(machines)])
    folded = rows.select(KEY, F.aggregate("_rows", initial, lambda acc, row: _product_step(acc, row, words, of_word, state)).alias("_end"))
    return folded.groupBy(KEY).agg(*[F.min(F.col("_end")[f"f{i}"]).alias(f"f{i}") for i in range(machines)])


def _fold_machine(word: str, place: int) -> Column:
    """The change that one machine of a word undergoes over the rows of a block."""
    shift = 3 * STATES * place
    codes = F.transform(F.col("_rows").getField(word), lambda w: F.shiftright(w, shift).bitwiseAND(F.lit((1 << 3 * STATES) - 1)).cast("int"))
    return fold_changes(codes)


def _product_step(acc: Column, row: Column, words: list[str], of_word: list[range], state: int) -> Column:
    """States and smallest values after one row."""
    fields, firsts = [], []
    for j, (word, machines) in enumerate(zip(words, of_word)):
        after = F.lit(0).cast("bigint")
        for place, i in enumerate(machines):
            now = F.shiftright(acc[f"s{j}"], 3 * place).bitwiseAND(F.lit(7))
            shift = (now * 3 + 3 * STATES * place).cast("int")
            moved = F.call_function("shiftright", row[word], shift).bitwiseAND(F.lit(7))
            after = after.bitwiseOR(F.shiftleft(moved, 3 * place))
        fields.append(after.alias(f"s{j}"))
    together = F.struct(*fields)

    def noted(new: Column) -> Column:
        for j, machines in enumerate(of_word):
            for place, i in enumerate(machines):
                there = F.shiftright(new[f"s{j}"], 3 * place).bitwiseAND(F.lit(7)) == state
                firsts.append(F.when(there, F.least(acc[f"f{i}"], row["_v"])).otherwise(acc[f"f{i}"]).alias(f"f{i}"))
        return F.struct(*[new[f"s{j}"].alias(f"s{j}") for j in range(len(words))], *firsts)

    # the new states are computed once and looked at by every machine
    return F.get(F.transform(F.array(together), noted), 0)
