"""Conversation prefix trie with sums over subtrees by a depth-band rollup.

Every distinct sequence of first turns is a node. Its key is a polynomial hash of the turns (four
lanes modulo 2^31 - 1, some 124 bits), so a node, its parent and the key of any rebuilt conversation come from
running sums along the turns and no sequence is ever put together.

Turns travel as hashes and lengths, never as texts. They are range-partitioned by conversation and
place, so a conversation that holds a third of all turns lies in many tasks; what a task has to know about the
ones before it (how many turns of its first conversation, and their sum) is one small row per task.

Sums over subtrees: depths are cut into bands of BAND levels. A node is exploded only to itself and its
ancestors inside its band. The roots of the bands, with their bands' sums, form a trie BAND times as
flat, which is rolled up in the same way; then each band root's completed total goes to the (at most
BAND) nodes above it in the next band. Depth D takes about log(D) / log(BAND) rounds, and
no row is ever exploded more than BAND times. Ancestors inside a band are found by doubling: each join
appends the ancestors of the furthest known one.

Ids of the conversations that end at a node are joined in ascending order by tasks over ranges of
(node, id), and the pieces of a node are then fed to its checksum one after the other, so a node where a third of
all conversations ends needs no more memory than another.

Defined results: rows without conversation id belong to none and are left out; a null role or text is the empty
one; turns of equal number (null first) are ordered by a hash of role and text, equal rows count as
often as they occur; other columns are not looked at; without conversations there is no root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duebook.llm.rows import pinned

#: Levels of a band.
BAND = 8
#: Turns that a conversation may take from another one, less than this.
SHARED = 6
GROUP = 100
#: Modulus, base and its inverse of the running sums, and their lanes.
PRIME = 2**31 - 1
BASE = 1_103_515_245
INVERSE = pow(BASE, -1, PRIME)
LANES = range(4)
KEY = ("a", "b")


# Turns along their conversations


def thin_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, two hashes of role and text, and the text's code points."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        "turn",
        F.xxhash64(F.lit(1), role, text).alias("h1"),
        F.xxhash64(F.lit(2), text, role).alias("h2"),
        F.char_length(text).cast("bigint").alias("points"),
    )


def powers(first: int, many: int) -> np.ndarray:
    """BASE to the power of ``first``, ``first + 1``, ..."""
    out = np.full(max(many, 1), pow(BASE, first, PRIME), np.int64)
    step, factor = 1, BASE
    while step < many:
        out[step : 2 * step] = out[:step][: many - step] * factor % PRIME
        step, factor = 2 * step, factor * factor % PRIME
    return out[:many]


class Along:
    """Places and running sums of turns that come sorted by conversation, batch by batch."""

    def __init__(self, conv: int | None = None, turns: int = 0, sums: tuple[int, ...] = (0,) * len(LANES)):
        self.first: int | None = None
        self.conv, self.turns, self.sums = conv, turns, np.array(sums, np.int64)
        self.whole = True  # only turns of the first conversation so far

    def read(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each turn's place in its conversation (from 1), its terms, and the sums up to it."""
        conv = batch.column("conv_id").to_numpy()
        starts = np.append(0, np.flatnonzero(np.diff(conv)) + 1)
        goes_on = self.conv == conv[0]
        self.first = int(conv[0]) if self.first is None else self.first
        self.whole &= len(starts) == 1 and self.first == conv[0]
        run = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(conv))))
        before = np.zeros(len(starts), np.int64)
        before[0] = self.turns if goes_on else 0
        place = np.arange(len(conv)) - starts[run] + 1
        factor = powers(1, int(place.max()))[place - 1]
        if goes_on:
            own = run == 0
            factor[own] = factor[own] * pow(BASE, self.turns, PRIME) % PRIME
        place = place + before[run]
        hashes = [batch.column(h).to_numpy().view(np.uint64) for h in ("h1", "h2")]
        low = np.uint64(PRIME)
        lanes = [(h >> np.uint64(shift)) & low for h in hashes for shift in (0, 32)]
        terms = np.stack([lane.astype(np.int64) % PRIME * factor % PRIME for lane in lanes])
        sums = np.cumsum(terms, 1)
        offset = np.where(starts > 0, sums[:, starts - 1], 0)
        if goes_on:
            offset[:, 0] -= self.sums
        sums = (sums - offset[:, run]) % PRIME
        self.conv, self.turns, self.sums = int(conv[-1]), int(place[-1]), sums[:, -1]
        return place, terms, sums


def carried(parts: list) -> dict[int, tuple]:
    """What each task has to start from: conversation, turns and sums at the end of the ones before."""
    out, state = {}, (None, 0, (0,) * len(LANES))
    for part in parts:
        out[part.task] = state
        conv, turns, sums = part.conv, part.turns, tuple(part.sums)
        if part.whole and part.first == state[0]:
            shift = pow(BASE, state[1], PRIME)
            sums = tuple((s + shift * t) % PRIME for s, t in zip(state[2], sums, strict=True))
            turns += state[1]
        state = (conv, turns, sums)
    return out


def along_conversations(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``place``, ``points``, terms ``t0``... and running sums ``s0``... of each turn."""
    order = ("conv_id", "turn", "h1", "h2")
    turns = pinned(thin_turns(conversations).repartitionByRange(*order).sortWithinPartitions(*order))

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Along()
        for batch in batches:
            if batch.num_rows:
                reader.read(batch)
        if reader.conv is not None:
            row = {
                "task": TaskContext.get().partitionId(), "first": reader.first, "conv": reader.conv,
                "turns": reader.turns, "sums": reader.sums.tolist(), "whole": reader.whole,
            }
            yield pa.RecordBatch.from_pylist([row])

    ddl = "task bigint, first bigint, conv bigint, turns bigint, sums array<bigint>, whole boolean"
    parts = turns.select("conv_id", "h1", "h2").mapInArrow(last, ddl).collect()
    starts = carried(sorted(parts, key=lambda part: part.task))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Along(*starts.get(TaskContext.get().partitionId(), ()))
        for batch in batches:
            if batch.num_rows:
                place, terms, sums = reader.read(batch)
                columns = {"conv_id": batch.column("conv_id"), "place": pa.array(place), "points": batch.column("points")}
                columns |= {f"t{i}": pa.array(terms[i]) for i in LANES} | {f"s{i}": pa.array(sums[i]) for i in LANES}
                yield pa.record_batch(columns)

    names = ["conv_id", "place", "points", *(f"t{i}" for i in LANES), *(f"s{i}" for i in LANES)]
    return turns.mapInArrow(number, ", ".join(f"{n} bigint" for n in names))


# Rebuilt conversations


def key_of(sums: list[Column]) -> tuple[Column, Column]:
    """Two lanes in one number, twice."""
    return tuple(sums[i] * F.lit(PRIME + 1) + sums[i + 1] for i in (0, 2))


def conversation_rows(turns: DataFrame) -> DataFrame:
    """One row per conversation: how many turns it takes from where, and how its own sums go on from them."""
    firsts = F.collect_list(
        F.when(F.col("place") < SHARED, F.struct("place", "points", *(f"{k}{i}" for k in "ts" for i in LANES)))
    )
    convs = turns.groupBy("conv_id").agg(F.max("place").alias("turns"), F.array_sort(firsts).alias("firsts"))
    convs = convs.withColumns(
        {
            "skips": (F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED).cast("int"),
            "leader": F.col("conv_id") - F.col("conv_id") % GROUP,
        }
    )
    led = convs.where(f"conv_id % {GROUP} = 0").select(F.col("conv_id").alias("leader"), F.col("firsts").alias("shared"))
    convs = convs.join(led, "leader", "left")
    shared = F.coalesce(F.slice("shared", 1, F.col("skips")), F.array().cast(convs.schema["firsts"].dataType))
    convs = convs.withColumn("shared", shared).withColumn("takes", F.size("shared"))
    steps = {d: pow(BASE, d, PRIME) if d >= 0 else pow(INVERSE, -d, PRIME) for d in range(-SHARED, SHARED)}
    factor = F.element_at(F.create_map(*(F.lit(x) for pair in steps.items() for x in pair)), F.col("takes") - F.col("skips"))
    convs = convs.withColumn("factor", factor.cast("bigint"))

    def sum_after(array: str, many: Column, lane: int) -> Column:
        return F.coalesce(F.get(array, many - 1)[f"s{lane}"], F.lit(0))

    mine = F.least("skips", F.size("firsts"))
    starts = {
        f"from{i}": F.pmod(sum_after("shared", F.col("takes"), i) - F.col("factor") * sum_after("firsts", mine, i) % PRIME, F.lit(PRIME))
        for i in LANES
    }
    return convs.withColumns(starts).drop("firsts", "leader")


def member_rows(conversations: DataFrame) -> DataFrame:
    """A row per node of each rebuilt conversation: key (``a``, ``b``), parent's key (``pa``, ``pb``),
    ``depth``, ``points`` of the last text, ``conv_id`` and whether the conversation ``ends`` there."""
    turns = pinned(along_conversations(conversations))
    convs = pinned(conversation_rows(turns))
    names = ["a", "b", "pa", "pb", "depth", "points", "conv_id", "ends"]

    def rows(df: DataFrame, own: tuple, above: tuple, depth: Column, points: Column, ends: Column) -> DataFrame:
        values = [*own, *above, depth.cast("int"), points.cast("bigint"), F.col("conv_id"), ends]
        return df.select(*(v.alias(n) for v, n in zip(values, names, strict=True)))

    nothing, zero = F.lit(None).cast("bigint"), F.lit(0).cast("bigint")
    no_own = F.col("turns") <= F.col("skips")
    roots = rows(convs, (zero, zero), (nothing, nothing), F.lit(0), F.lit(0), no_own & (F.col("takes") == 0))

    one = convs.select("*", F.posexplode("shared").alias("at", "one"))
    sums = [F.col(f"one.s{i}") for i in LANES]
    parents = [F.pmod(F.col(f"one.s{i}") - F.col(f"one.t{i}"), F.lit(PRIME)) for i in LANES]
    depth = F.col("at") + 1
    taken = rows(one, key_of(sums), key_of(parents), depth, F.col("one.points"), no_own & (depth == F.col("takes")))

    own = turns.join(convs.drop("shared"), "conv_id").where(F.col("place") > F.col("skips"))
    sums = [(F.col(f"from{i}") + F.col("factor") * F.col(f"s{i}") % PRIME) % PRIME for i in LANES]
    before = [F.pmod(F.col(f"s{i}") - F.col(f"t{i}"), F.lit(PRIME)) for i in LANES]
    parents = [(F.col(f"from{i}") + F.col("factor") * before[i] % PRIME) % PRIME for i in LANES]
    depth = F.col("takes") + F.col("place") - F.col("skips")
    rest = rows(own, key_of(sums), key_of(parents), depth, F.col("points"), F.col("place") == F.col("turns"))
    return roots.unionAll(taken).unionAll(rest)


# Sums over subtrees


def named(df: DataFrame, **names: str) -> DataFrame:
    return df.select(*(F.col(old).alias(new) for new, old in names.items()))


def with_paths(nodes: DataFrame, deepest: int, band: int) -> DataFrame:
    """Add ``path``: keys of the ancestors inside the node's band, nearest first."""
    level = F.col("depth") % band
    parent = F.struct(F.col("pa").alias("a"), F.col("pb").alias("b"))
    nodes = pinned(nodes.withColumn("path", F.when(level > 0, F.array(parent)).otherwise(F.array().cast("array<struct<a:bigint,b:bigint>>"))))
    for round_ in range(ceil(log2(min(band, deepest + 1)))):
        known = 2**round_
        short = level > known
        far = F.element_at("path", -1)
        open_ = nodes.where(short).withColumns({"fa": far["a"], "fb": far["b"]})
        onward = nodes.where(level > 0).select(F.col("a").alias("fa"), F.col("b").alias("fb"), F.col("path").alias("_on"))
        longer = open_.join(onward, ["fa", "fb"]).withColumn("path", F.concat("path", "_on"))
        nodes = pinned(longer.select(*nodes.columns).unionAll(nodes.where(~short)))
    return nodes


def subtree_sums(nodes: DataFrame, values: tuple[str, ...], band: int = BAND) -> DataFrame:
    """``a``, ``b`` and the ``values`` added up over each node's subtree, its own included.

    ``nodes``: ``a``, ``b``, ``pa``, ``pb`` (null at the root), ``depth`` and ``values``.
    """
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    nodes = with_paths(nodes.select(*KEY, "pa", "pb", "depth", *values), deepest, band)
    own = F.struct(*KEY)

    def added(df: DataFrame, to: Column) -> DataFrame:
        exploded = df.select(F.explode(to).alias("_to"), *values)
        return exploded.select("_to.a", "_to.b", *values)

    def totals(df: DataFrame) -> DataFrame:
        return df.groupBy(*KEY).agg(*(F.sum(v).alias(v) for v in values))

    inside = totals(added(nodes, F.concat(F.array(own), "path")))
    if deepest < band:
        return inside
    inside = pinned(inside)
    tops = nodes.where((F.col("depth") % band == 0)).drop("path", *values)
    above = nodes.select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.concat(F.array(own), "path").alias("chain"))
    # The root has no parent; every other band root has a whole band above it.
    linked = pinned(tops.where("depth > 0").join(above, ["pa", "pb"]))
    up = F.element_at("chain", -1)
    small = linked.select(*KEY, up["a"].alias("pa"), up["b"].alias("pb"), "depth").unionAll(
        tops.where("depth = 0").select(*KEY, "pa", "pb", "depth")
    )
    small = small.withColumn("depth", (F.col("depth") / band).cast("int")).join(inside, [*KEY])
    completed = pinned(subtree_sums(pinned(small), values, band))
    passed = added(linked.select(*KEY, "chain").join(completed, [*KEY]), F.col("chain"))
    return totals(inside.select(*KEY, *values).unionAll(passed))


def id_digests(ends: DataFrame) -> DataFrame:
    """``a``, ``b``, ``ends_sha256`` of the ids in ``conv_id``, ascending and joined by commas."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (batch.column(k).to_numpy() for k in KEY)
            starts = np.append(0, np.flatnonzero((np.diff(a) != 0) | (np.diff(b) != 0)) + 1)
            ids = batch.column("conv_id")
            lists = pa.ListArray.from_arrays(np.append(starts, len(a)).astype(np.int32), ids.cast(pa.string()))
            at = pa.array(starts)
            pieces = {"a": batch.column("a").take(at), "b": batch.column("b").take(at), "first": ids.take(at)}
            yield pa.record_batch(pieces | {"ids": pc.binary_join(lists, ",")})

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done: list[tuple[int, int, str]] = []
            a, b, ids = (batch.column(n).to_pylist() for n in ("a", "b", "ids"))
            for own, piece in zip(zip(a, b, strict=True), ids, strict=True):
                if own != key:
                    if key:
                        done.append((*key, state.hexdigest()))
                    key, state = own, hashlib.sha256(piece.encode())
                else:
                    state.update(b"," + piece.encode())
            yield out(done)
        if key:
            yield out([(*key, state.hexdigest())])

    def out(done: list[tuple[int, int, str]]) -> pa.RecordBatch:
        a, b, sha = zip(*done, strict=True) if done else ((), (), ())
        return pa.record_batch({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "ends_sha256": pa.array(sha, pa.string())})

    order = (*KEY, "conv_id")
    ranged = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = ranged.mapInArrow(join, "a bigint, b bigint, first bigint, ids string")
    pieces = pieces.repartition(*KEY).sortWithinPartitions(*KEY, "first")
    return pieces.mapInArrow(digest, "a bigint, b bigint, ends_sha256 string")


def prefix_trie(conversations: DataFrame, band: int = BAND) -> DataFrame:
    """One row per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``."""
    members = pinned(member_rows(conversations))
    nodes = pinned(
        members.groupBy(*KEY).agg(
            *(F.max(c).alias(c) for c in ("pa", "pb", "depth", "points")),
            F.min("conv_id").alias("conv_id"),
            F.count("*").alias("n_convs"),
        )
    )
    children = nodes.where("pa IS NOT NULL").groupBy("pa", "pb").agg(F.count("*").alias("n_children"))
    nodes = pinned(
        nodes.join(named(children, a="pa", b="pb", n_children="n_children"), [*KEY], "left").fillna(0, ["n_children"])
    )
    valued = nodes.withColumns(
        {
            "n_leaves": (F.col("n_children") == 0).cast("bigint"),
            "saved_tokens": (F.col("n_convs") - 1) * F.col("points"),
        }
    )
    sums = subtree_sums(valued, ("n_leaves", "saved_tokens"), band)
    digests = id_digests(members.where("ends"))
    # Children of a node may be many; the root's need no lookup.
    parents = named(nodes.where("depth > 0"), pa="a", pb="b", parent_conv_id="conv_id")
    top = nodes.where("depth = 0").select(F.col("conv_id").alias("_top"))
    whole = pinned(nodes.join(sums, [*KEY]).join(digests, [*KEY], "left"))
    deep = whole.where("depth > 1").join(parents, ["pa", "pb"])
    low = whole.where("depth <= 1").join(F.broadcast(top)).withColumn("parent_conv_id", F.when(F.col("depth") == 1, F.col("_top")))
    names = ["conv_id", F.col("depth").cast("bigint").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    none = hashlib.sha256(b"").hexdigest()
    names.append(F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))
    return deep.select(*names).unionAll(low.select(*names))
