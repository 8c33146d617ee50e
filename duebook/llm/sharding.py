"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Rows lie on a ring at the hash of their text; each shard owns the arcs that end at its virtual
nodes. A shard takes the rows of its arcs until it is full; rows beyond that continue clockwise to
the next virtual node whose shard has room. With no slack the loads are bounded exactly: counts
differ by at most one. Copies of a text lie at one point of the ring and so mostly in one shard.

Rows are range-partitioned along the ring (then by a hash of the id, so a text that a third of all rows
share is spread over tasks); only counts per task and arc go to the driver, at most one row per
task and per virtual node. There the overflow is settled for whole runs of rows.

Defined results: a null text has no bytes and crc32 0, and lies where the empty text lies; rows without
id and repeated rows are placed like any others.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook.llm.rows import pinned

VIRTUAL_NODES = 64


class Ring:
    """Virtual nodes in ring order: their places (signed 64-bit) and their shards."""

    def __init__(self, shards: int, virtual_nodes: int = VIRTUAL_NODES):
        nodes = sorted(
            (xxhash.xxh64_intdigest(f"shard {s} node {v}") - 2**63, s)
            for s in range(shards)
            for v in range(virtual_nodes)
        )
        self.shards = shards
        self.places = np.array([place for place, _ in nodes], np.int64)
        self.owner = [shard for _, shard in nodes]

    def arcs(self, places: np.ndarray) -> np.ndarray:
        """The first virtual node clockwise of each place."""
        return np.searchsorted(self.places, places, "left") % len(self.owner)


def placements(
    ring: Ring, runs: list[tuple[int, int, int]], slack: float = 0.0
) -> dict[tuple[int, int], list[tuple[int, int, int]]]:
    """How the rows of each run are dealt out: ``(rows, shard, first slot)`` in the run's order.

    ``runs``: (task, arc, rows) in ring order. Capacities: an equal share of all rows, larger by
    ``slack``; without slack some shards hold one row more, and all are filled exactly.
    """
    total = sum(rows for _, _, rows in runs)
    share, more = divmod(total, ring.shards)
    if slack:
        room = [int(np.ceil((1 + slack) * total / ring.shards))] * ring.shards
    else:
        room = [share + (s < more) for s in range(ring.shards)]
    out: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
    overflow = []
    for task, arc, rows in runs:
        shard = ring.owner[arc]
        taken = min(rows, room[shard])
        room[shard] -= taken
        if taken:
            out[task, arc].append((taken, shard))
        if rows > taken:
            overflow.append((task, arc, rows - taken))
    for task, arc, rows in overflow:
        node = arc
        while rows:
            node = (node + 1) % len(ring.owner)
            shard = ring.owner[node]
            taken = min(rows, room[shard])
            if taken:
                room[shard] -= taken
                rows -= taken
                out[task, arc].append((taken, shard))
    slots = [0] * ring.shards
    placed = {}
    for task, arc, _ in runs:
        placed[task, arc] = []
        for rows, shard in out[task, arc]:
            placed[task, arc].append((rows, shard, slots[shard]))
            slots[shard] += rows
    return placed


def shard_rows(docs: DataFrame, shards: int, slack: float = 0.0, virtual_nodes: int = VIRTUAL_NODES) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` of each row; slots count 0, 1, ... in a shard."""
    ring = Ring(shards, virtual_nodes)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.xxhash64(text).alias("place"),
        F.xxhash64(F.lit(3), "doc_id").alias("tie"),
        "doc_id",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    along = rows.repartitionByRange("place", "tie", "doc_id").sortWithinPartitions("place", "tie", "doc_id")
    along = pinned(along)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, int] = defaultdict(int)
        for batch in batches:
            arcs, numbers = np.unique(ring.arcs(batch.column("place").to_numpy()), return_counts=True)
            for arc, number in zip(arcs.tolist(), numbers.tolist(), strict=True):
                total[arc] += number
        task = TaskContext.get().partitionId()
        yield pa.record_batch(
            {
                "task": pa.array([task] * len(total), pa.int32()),
                "arc": pa.array([*total], pa.int32()),
                "n": pa.array([*total.values()], pa.int64()),
            }
        )

    counted = along.select("place").mapInArrow(count, "task int, arc int, n bigint").collect()
    # Arc 0 holds the places below the first node and, wrapped, those above the last one.
    placed = placements(ring, sorted((r.task, r.arc, r.n) for r in counted), slack)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        done: dict[int, int] = defaultdict(int)  # rows of an arc that are placed
        for batch in batches:
            if not batch.num_rows:
                continue
            arcs = ring.arcs(batch.column("place").to_numpy())
            shard, slot = np.zeros(len(arcs), np.int64), np.zeros(len(arcs), np.int64)
            for arc in np.unique(arcs).tolist():
                own = np.flatnonzero(arcs == arc)
                number = done[arc] + np.arange(len(own))
                done[arc] += len(own)
                pieces = placed[task, arc]
                lengths = np.array([p[0] for p in pieces])
                piece = np.searchsorted(np.cumsum(lengths), number, "right")
                shard[own] = np.array([p[1] for p in pieces])[piece]
                starts = np.array([p[2] for p in pieces]) - (np.cumsum(lengths) - lengths)
                slot[own] = starts[piece] + number
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "size": batch.column("size"),
                    "text_crc32": batch.column("text_crc32"),
                    "shard": pa.array(shard, pa.int32()),
                    "slot": pa.array(slot),
                }
            )

    ddl = "doc_id bigint, size bigint, text_crc32 bigint, shard int, slot bigint"
    return along.mapInArrow(place, ddl)
