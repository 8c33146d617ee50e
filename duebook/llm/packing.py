"""Packing token sequences by vector bin packing with the dot-product heuristic.

A sequence is a bin with three limits: tokens, segments, and tokens that bear loss. Pieces wait in a
bounded pool; the bin in hand takes, again and again, the fitting piece whose demand has the
largest dot product with the room that is left. Where cutting is allowed, a gap that no piece fits
is filled with the head of the largest piece. Tasks pack the rows they read, so nothing is shuffled
and neighbouring rows stay near each other; the open bin that a task is left with is cut into
sequences whose lengths are powers of two, which need no padding. A bin that is closed by its segments
before its tokens stays whole and is padded.

Defined results: a null or empty text is the end token alone; a row without id is packed like any
other; repeated rows are packed once each. Ids of sequences are unique, not gapless. They depend on
how the input is split into tasks, and are the same again if a task is run anew.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from duebook.llm.batches import slices, texts_of
from duebook.llm.tokens import encoder

#: Low bits of a sequence id that count within a task.
LOCAL_BITS = 33
#: Pieces that wait in a task at most.
POOL = 512


@dataclass(frozen=True)
class Limits:
    """What a sequence holds at most, and the shortest head that is cut off to fill a gap."""

    tokens: int = 2048
    segments: int = 64
    loss: int = 2048
    least_cut: int = 16


@dataclass
class Piece:
    owner: object  # what the caller knows the piece by
    start: int
    tokens: int
    loss: int


class Packer:
    """Fills one bin after another from a bounded pool of pieces."""

    def __init__(self, limits: Limits, cuts: bool, pool: int = POOL):
        self.limits, self.cuts, self.pool_size = limits, cuts, pool
        self.room = np.array([limits.tokens, limits.segments, limits.loss], float)
        self.pool: list[Piece] = []
        self.demand = np.zeros((0, 3))

    def add(self, pieces: list[Piece]) -> Iterator[list[Piece]]:
        """Take in pieces; full bins that the pool's size forces out."""
        for low in range(0, len(pieces), self.pool_size):
            self._put(pieces[low : low + self.pool_size])
            while len(self.pool) > self.pool_size:
                yield self._fill()

    def rest(self) -> Iterator[list[Piece]]:
        while self.pool:
            yield self._fill()

    def _put(self, pieces: list[Piece]) -> None:
        self.pool += pieces
        new = np.array([(p.tokens, 1, p.loss) for p in pieces], float).reshape(-1, 3)
        self.demand = np.concatenate([self.demand, new])

    def _take(self, i: int) -> Piece:
        piece, last = self.pool[i], self.pool.pop()
        if i < len(self.pool):
            self.pool[i] = last
            self.demand[i] = self.demand[-1]
        self.demand = self.demand[:-1]
        return piece

    def _fill(self) -> list[Piece]:
        chosen: list[Piece] = []
        left = self.room.copy()
        while self.pool:
            fits = (self.demand <= left).all(axis=1)
            if fits.any():
                value = (self.demand / self.room) @ (left / self.room)
                piece = self._take(int(np.argmax(np.where(fits, value, -1.0))))
            elif self.cuts and left[0] >= self.limits.least_cut and left[1] >= 1 and left[2] >= left[0]:
                piece = self._head(int(left[0]))
            else:
                break
            chosen.append(piece)
            left -= (piece.tokens, 1, piece.loss)
            if not left[0]:
                break
        return chosen

    def _head(self, tokens: int) -> Piece:
        """Cut the head off the largest piece, which is longer than the gap. (All of a piece that
        may be cut bears loss, or none.)"""
        whole = self._take(int(np.argmax(self.demand[:, 0])))
        head_loss = min(whole.loss, tokens)
        rest = Piece(whole.owner, whole.start + tokens, whole.tokens - tokens, whole.loss - head_loss)
        self._put([rest])
        return Piece(whole.owner, whole.start, tokens, head_loss)


def powers_of_two(pieces: list[Piece]) -> Iterator[list[Piece]]:
    """The pieces of one bin as bins whose tokens are powers of two, largest first."""
    rest = [Piece(p.owner, p.start, p.tokens, p.loss) for p in pieces]
    total = sum(p.tokens for p in rest)
    while total:
        space = 1 << (total.bit_length() - 1)
        total -= space
        out = []
        while space:
            piece = rest[0]
            taken = min(space, piece.tokens)
            out.append(Piece(piece.owner, piece.start, taken, min(piece.loss, taken)))
            space -= taken
            if taken == piece.tokens:
                rest.pop(0)
            else:
                rest[0] = Piece(piece.owner, piece.start + taken, piece.tokens - taken, max(0, piece.loss - taken))
        yield out


PIECES = {
    "doc_id": pa.int64(),
    "start": pa.int64(),
    "length": pa.int64(),
    "ids_crc32": pa.int64(),
    "doc_tokens": pa.int64(),
    "sequence_id": pa.int64(),
    "offset": pa.int64(),
    "ids": pa.list_(pa.int32()),
}
PIECES_DDL = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, `offset` bigint, ids array<int>"
)


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int, limits: Limits = Limits(), with_ids: bool = True
) -> DataFrame:
    """One row per piece: its document, its place there, its sequence and its place there.

    ``tokenizer``: a tokenizers file. Every token of a document bears loss. ``with_ids`` adds the
    token ids themselves as ``ids``.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        packer = Packer(limits, cuts=True)
        number = TaskContext.get().partitionId() << LOCAL_BITS
        most = min(limits.tokens, limits.loss)

        def rows(bins: Iterator[list[Piece]]) -> list[tuple]:
            nonlocal number
            out = []
            for pieces in bins:
                place = 0
                for p in pieces:
                    doc_id, ids, total, first = p.owner
                    own = ids[p.start - first : p.start - first + p.tokens]
                    out.append(
                        (doc_id, p.start, p.tokens, zlib.crc32(own.tobytes()), total, number, place, own.view(np.int32) if with_ids else None)
                    )
                    place += p.tokens
                number += 1
            return out

        def table(out: list[tuple]) -> pa.RecordBatch:
            columns = zip(*out, strict=True)
            return pa.record_batch([pa.array(list(c), t) for c, t in zip(columns, PIECES.values(), strict=True)], names=[*PIECES])

        for batch in slices(batches):
            ids, starts = encode(texts_of(batch))
            tails, full = [], []
            for doc_id, low, high in zip(batch.column("doc_id").to_pylist(), starts, starts[1:], strict=False):
                own = np.append(ids[low:high], np.uint32(end_id))
                whole = len(own) // most * most
                full += [[Piece((doc_id, own, len(own), 0), s, most, most)] for s in range(0, whole, most)]
                if whole < len(own):
                    # A copy, so that the pool holds tails and not whole documents.
                    tails.append(Piece((doc_id, own[whole:].copy(), len(own), whole), whole, len(own) - whole, len(own) - whole))
            out = rows(iter(full)) + rows(packer.add(tails))
            if out:
                yield table(out)
        bins = list(packer.rest())
        left = [p for b in bins if not closed(b, limits) for p in b]
        out = rows(b for b in bins if closed(b, limits))
        out += rows(small for b in repacked(left, limits) for small in ([b] if closed(b, limits) else powers_of_two(b)))
        if out:
            yield table(out)

    return docs.select("doc_id", "text").mapInArrow(pack, PIECES_DDL)


def closed(pieces: list[Piece], limits: Limits) -> bool:
    """Has a bin reached one of its limits?"""
    tokens, loss = sum(p.tokens for p in pieces), sum(p.loss for p in pieces)
    return tokens >= limits.tokens or len(pieces) >= limits.segments or loss >= limits.loss


def repacked(pieces: list[Piece], limits: Limits) -> Iterator[list[Piece]]:
    """Bins from the pieces in a row, each closed by one of the limits, and a last bin with the rest.

    Every token of the pieces bears loss.
    """
    current: list[Piece] = []
    room = most = min(limits.tokens, limits.loss)
    for piece in pieces:
        while piece.tokens:
            taken = min(piece.tokens, room)
            current.append(Piece(piece.owner, piece.start, taken, taken))
            piece = Piece(piece.owner, piece.start + taken, piece.tokens - taken, piece.loss - taken)
            room -= taken
            if closed(current, limits):
                yield current
                current, room = [], most
    if current:
        yield current


def pack_examples(examples: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Whole examples under all three limits, without cutting.

    ``examples``: ``example_id`` (long), ``n_tokens``, ``n_loss`` (tokens that bear loss). Returns
    ``example_id, n_tokens, n_loss, sequence_id, offset``. An example that alone breaks a limit
    gets a sequence of its own, as does one whose counts are null (they count as 0).
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(limits, cuts=False)
        number = TaskContext.get().partitionId() << LOCAL_BITS

        def table(bins: list[list[Piece]]) -> pa.RecordBatch:
            nonlocal number
            out = []
            for pieces in bins:
                place = 0
                for p in pieces:
                    out.append((p.owner, p.tokens, p.loss, number, place))
                    place += p.tokens
                number += 1
            names = ["example_id", "n_tokens", "n_loss", "sequence_id", "offset"]
            return pa.record_batch([pa.array(list(c), pa.int64()) for c in zip(*out, strict=True)], names=names)

        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("example_id", "n_tokens", "n_loss")]
            pieces = [Piece(i, 0, t or 0, loss or 0) for i, t, loss in zip(*columns, strict=True)]
            alone = [p for p in pieces if p.tokens > limits.tokens or p.loss > limits.loss or not p.tokens]
            rest = [p for p in pieces if not (p.tokens > limits.tokens or p.loss > limits.loss or not p.tokens)]
            if bins := [[p] for p in alone] + list(packer.add(rest)):
                yield table(bins)
        if bins := list(packer.rest()):
            yield table(bins)

    ddl = "example_id bigint, n_tokens bigint, n_loss bigint, sequence_id bigint, `offset` bigint"
    wanted = examples.selectExpr("CAST(example_id AS bigint) example_id", "CAST(n_tokens AS bigint) n_tokens", "CAST(n_loss AS bigint) n_loss")
    return wanted.mapInArrow(pack, ddl)
