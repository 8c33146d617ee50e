"""Mixing sources to target weights by Pfair scheduling, in DataFrame functions only.

With integer tickets that add up to one cycle of slots, a source with ``a`` of ``m`` tickets has its k-th
block (from 0) released at slot floor(k * m / a) and due by slot ceil((k + 1) * m / a). Taking, slot
by slot, the released block that is due first keeps every source less than one block from its
exact share at all times. The schedule repeats after a cycle, so it is worked out once, for one
cycle, and every row finds its slot by arithmetic, without a sequential pass. When a source runs
dry its slots stay empty and the others go on in their proportion; no row is dropped or repeated.

Rows of a source are dealt to cells by hash and ranked within cells, so a source that holds a third
of all rows is ranked by many tasks.

Defined results: rows without a source are a source of their own; a source without a weight (or with one
not above 0) gets the least share, one ticket; repeated rows follow each other; an empty table
gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duebook.llm.rows import packed

#: Slots of a cycle at least, which is the precision of the weights, and rows of a block.
CYCLE, BLOCK_ROWS = 1_000, 16


def tempered_weights(docs: DataFrame, exponent: float = 0.5) -> DataFrame:
    """``source, weight``: row counts to a power below 1, which lifts small sources."""
    return docs.groupBy("source").agg(F.pow(F.count("*"), F.lit(exponent)).alias("weight"))


def tickets(sources: DataFrame, weights: DataFrame, cycle: int = CYCLE) -> DataFrame:
    """``source, number, tickets, cycle``: whole shares of the cycle by largest remainders.

    One row per source. Every source gets a ticket; a cycle has at least four slots per source.
    """
    given = weights.groupBy(F.col("source").alias("_s")).agg(F.greatest(F.max("weight"), F.lit(0.0)).alias("_w"))
    named = sources.join(given, sources["source"].eqNullSafe(given["_s"]), "left")
    every = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_first())
    shares = named.select("source", F.coalesce("_w", F.lit(0.0)).alias("weight")).withColumns(
        {"number": F.row_number().over(by_name) - 1, "sources": F.count("*").over(every), "total": F.sum("weight").over(every)}
    )
    shares = shares.withColumn("cycle", F.greatest(F.lit(cycle), 4 * F.col("sources")).cast("int"))
    share = F.when(F.col("total") > 0, F.col("weight") / F.col("total")).otherwise(1 / F.col("sources"))
    shares = shares.withColumn("exact", share * (F.col("cycle") - F.col("sources")))
    shares = shares.withColumn("whole", F.floor("exact").cast("int"))
    left = F.col("cycle") - F.col("sources") - F.sum("whole").over(every)
    rank = F.row_number().over(Window.orderBy((F.col("exact") - F.col("whole")).desc(), "number"))
    extra = F.when(rank <= left, 1).otherwise(0)
    return shares.select("source", "number", (1 + F.col("whole") + extra).cast("int").alias("tickets"), "cycle")


def schedule(shares: DataFrame) -> DataFrame:
    """``number, turn, slot``: the slot of each source's turns in one cycle. One row per slot."""
    one = shares.agg(
        F.sort_array(F.collect_list(F.struct("number", "tickets"))).alias("shares"), F.max("cycle").alias("cycle")
    ).where("cycle IS NOT NULL")

    def step(state: Column, slot: Column) -> Column:
        def window(share: Column, i: Column) -> Column:
            done = F.get(state["done"], i).cast("bigint")
            release = F.floor(done * F.col("cycle") / share["tickets"])
            due = F.ceil((done + 1) * F.col("cycle") / share["tickets"])
            return F.struct((release > slot).alias("late"), due.alias("due"), i.alias("i"))

        # The released block that is due first; ties: the source that comes first by name.
        first = F.array_min(F.transform(F.col("shares"), window))["i"]
        return F.transform(
            F.array(first),  # evaluated once
            lambda i: F.struct(
                F.transform(state["done"], lambda n, j: F.when(j == i, n + 1).otherwise(n)).alias("done"),
                F.concat(state["order"], F.array(i)).alias("order"),
            ),
        )[0]

    start = F.struct(
        F.transform("shares", lambda _: F.lit(0)).alias("done"), F.array().cast("array<int>").alias("order")
    )
    slots = F.sequence(F.lit(0), F.col("cycle") - 1)
    order = one.select(F.aggregate(slots, start, step, lambda state: state["order"]).alias("order"))
    turns = order.select(F.posexplode("order").alias("slot", "number"))
    turn = F.row_number().over(Window.partitionBy("number").orderBy("slot")) - 1
    return turns.select("number", turn.alias("turn"), "slot")


def interleaved(docs: DataFrame, weights: DataFrame, block_rows: int = BLOCK_ROWS, cycle: int = CYCLE) -> DataFrame:
    """The rows of ``docs`` in a struct ``row``, with ``source``, ``block``, ``slot``, ``place``.

    Sorted by ``slot`` and ``place``, the rows are mixed by weight; within a source they are in the
    order of a hash of the id.
    """
    total = docs.agg(F.count("*").alias("n")).first().n
    cells = max(1, round(total**0.5))
    order = [F.xxhash64(F.lit(9), "_id"), F.col("_id"), F.col("_text")]
    # Never null, so that plain equality serves and the window's placement also serves the join.
    named = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    rows = packed(docs, source=F.col("source"), _name=named, _id=F.col("doc_id"), _text=F.xxhash64("text"))
    rows = rows.withColumn("_cell", F.pmod(F.xxhash64(F.lit(8), "_id"), F.lit(cells)).cast("int"))
    # Rows of the earlier cells of the source: at most sources * sqrt(rows) small rows.
    sizes = docs.groupBy(named.alias("_name"), F.pmod(F.xxhash64(F.lit(8), "doc_id"), F.lit(cells)).cast("int").alias("_cell")).count()
    earlier = Window.partitionBy("_name").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_name", "_cell", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_name", "_cell").orderBy(*order)
    ranked = rows.withColumn("_rank", F.row_number().over(inside) - 1)
    ranked = ranked.join(starts, ["_name", "_cell"]).select("row", "source", "_name", (F.col("_start") + F.col("_rank")).alias("_rank"))

    shares = tickets(docs.select("source").distinct(), weights, cycle)
    plan = schedule(shares)
    # One row per source, and below one per slot of a cycle: their size depends on the sources alone.
    by_name = shares.select(named.alias("_name"), "number", "tickets", "cycle")
    blocks = ranked.join(F.broadcast(by_name), "_name")
    blocks = blocks.withColumn("block", F.floor(F.col("_rank") / block_rows)).withColumn("turn", (F.col("block") % F.col("tickets")).cast("int"))
    placed = blocks.join(F.broadcast(plan.withColumnRenamed("slot", "_slot")), ["number", "turn"])
    slot = F.floor(F.col("block") / F.col("tickets")) * F.col("cycle") + F.col("_slot")
    return placed.select("row", "source", "block", slot.cast("bigint").alias("slot"), (F.col("_rank") % block_rows).cast("int").alias("place"))


def mix(docs: DataFrame, weights: DataFrame) -> DataFrame:
    """All rows and columns of ``docs``, sorted (and so stored) in mixed order."""
    return interleaved(docs, weights).sort("slot", "place").select("row.*")


def mixed_order(docs: DataFrame, weights: DataFrame) -> DataFrame:
    """``doc_id, source, block, slot, position``: each row's place in the mix, counted from 0."""
    # A hash stands for the text, which would otherwise move with its row.
    placed = interleaved(docs.select("doc_id", "source", F.xxhash64("text").alias("text")), weights)
    placed = placed.select("row.doc_id", "source", "block", "slot", "place")
    total = docs.agg(F.count("*").alias("n")).first().n
    reach = max(1, round((total / BLOCK_ROWS) ** 0.5))
    placed = placed.withColumn("_span", F.floor(F.col("slot") / reach))
    spans = placed.groupBy("_span").agg(F.count("*").alias("_n"))  # some sqrt(rows) rows
    before = Window.orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    starts = spans.select("_span", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_span").orderBy("slot", "place")
    position = F.col("_start") + F.row_number().over(inside) - 1
    return placed.join(starts, "_span").select("doc_id", "source", "block", "slot", position.alias("position"))
