"""Spelling variant grouping by K-d trees over letter-count vectors.

One edit changes a word's letter counts by at most two: a replaced letter takes one from a letter and
gives one to another, an inserted or deleted one changes a single count. So the words near a word lie in
a small box around its counts, and for a given pair of lengths the box is smaller still: equal lengths
allow one letter more and one less, a longer word one letter more and none less, a shorter word the
reverse. A K-d tree whose nodes hold boxes of counts and lengths answers such a range search without
looking at boxes that are too far away; what is left is compared by letter order.

The words of the corpus are counted with a combine in each task. A tree of few nodes, fitted on a drawn
sample of at most SAMPLE_PER_CELL * MOST_CELLS words, cuts the space of counts into cells of similar
size, and it is all that is broadcast. Every word is stored in its cell and sent as a question to all cells
that its boxes reach, so no pair is lost wherever the cuts lie. In a task, the words of a cell come
first and get a tree of their own; the questions stream by in batches and are never held together.

Forms are followed in doubling rounds: each form has at least ``ratio`` times the occurrences of
its word, so the logarithm of the largest count bounds the rounds.

Defined results: null and empty texts have no words; a null id is written as the empty string; repeated
rows count as often as they occur; words of any length are taken whole; other columns are not looked
at; a table without words gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, log, log2

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook.llm.batches import large, slices, texts_of
from duebook.llm.rows import pinned

#: Letters a to z, then U+00C0 to U+00FF: the columns of a count vector.
LETTERS = 26 + 64
#: Words a cell should hold, words of the sample for each cell, and the most cells.
CELL_WORDS = 16_384
SAMPLE_PER_CELL = 64
MOST_CELLS = 4_096
#: Words in a leaf of a cell's tree, and questions answered at once.
LEAF_WORDS = 32
AT_ONCE = 1_024
#: Bytes of letters compared at once, and words up to which checksums run over whole arrays.
COMPARED_BYTES = 16 << 20
LONG_WORD = 48
#: (difference in length, letters that may be added, letters that may be taken).
STEPS = ((0, 1, 1), (1, 1, 0), (-1, 0, 1))

_LEAD = 0xC3  # U+00C0 to U+00FF are this byte and one of 0x80 to 0xBF
_COLUMN = np.zeros(256, np.int64)
_COLUMN[ord("a") : ord("z") + 1] = np.arange(26)
_COLUMN[0xC0:] = np.arange(26, LETTERS)
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[ord("A") : ord("Z") + 1] = _ASCII_LETTER[ord("a") : ord("z") + 1] = True
_CRC = np.array([zlib.crc32(bytes([b])) ^ 0xFF000000 for b in range(256)], np.uint32)
_CRC ^= _CRC[0]  # steps of the checksum of one byte, for a register that starts at 0


# Words


def checksums(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, before: np.ndarray) -> np.ndarray:
    """crc32 of each span of bytes, going on from the checksum ``before`` it."""
    register = before.astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    lengths = stops - starts
    left = np.flatnonzero(lengths <= LONG_WORD)
    for done in range(LONG_WORD):
        left = left[lengths[left] > done]
        if not len(left):
            break
        now = register[left]
        register[left] = _CRC[(now ^ data[starts[left] + done]) & np.uint32(0xFF)] ^ (now >> np.uint32(8))
    out = register ^ np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(lengths > LONG_WORD):
        out[i] = zlib.crc32(data[starts[i] : stops[i]], int(before[i]))
    return out


def words_of(texts: pa.Array, ids: list, least: int, every: int) -> pa.Array:
    """All words of at least ``least`` letters, one letter deleted where the checksum says so."""
    lower = pc.ascii_lower(large(texts))
    borders = np.frombuffer(lower.buffers()[1], np.int64)[lower.offset : lower.offset + len(lower) + 1]
    data = np.frombuffer(lower.buffers()[2] or b"", np.uint8)[: borders[-1]]
    lead = data == _LEAD
    second = np.append(False, lead[:-1]) if len(data) else lead
    inside = _ASCII_LETTER[data] | lead | second
    edge = np.zeros(len(data) + 1, bool)
    edge[borders] = True
    starts = np.flatnonzero(inside & (np.append(True, ~inside)[:-1] | edge[:-1]))
    stops = np.flatnonzero(inside & (np.append(~inside, True)[1:] | edge[1:])) + 1
    letters = np.append(0, np.cumsum(inside & ~second))  # letters before each byte
    size = letters[stops] - letters[starts]
    enough = size >= least
    starts, stops, size = starts[enough], stops[enough], size[enough]

    prefix = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
    row = np.searchsorted(borders, starts, "right") - 1
    checksum = checksums(data, starts, stops, prefix[row]).astype(np.int64)
    hit = np.flatnonzero(checksum % every == 0)
    places = np.flatnonzero(inside & ~second)  # the byte where each letter begins
    gone = places[letters[starts[hit]] + checksum[hit] % size[hit]]
    size[hit] -= 1
    lengths = stops - starts
    lengths[hit] -= 1 + lead[gone]
    keep = np.zeros(len(data) + 1, np.int8)
    short = size < least
    keep[starts[~short]] += 1
    keep[stops[~short]] -= 1
    keep = np.cumsum(keep[:-1], dtype=np.int8).astype(bool)
    keep[gone] = False
    keep[gone[lead[gone]] + 1] = False
    offsets = np.append(0, np.cumsum(lengths[~short])).astype(np.int64)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data[keep])]
    return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, buffers)


def count_words(docs: DataFrame, least: int = 7, every: int = 31, occurrences: int = 2) -> DataFrame:
    """``word``, ``n``: words of at least ``least`` letters that occur at least ``occurrences`` times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, size=8 << 20):
            found = words_of(texts_of(batch), batch.column("doc_id").to_pylist(), least, every)
            counts = found.value_counts()
            word, n = counts.field("values").cast(pa.string()), counts.field("counts")
            yield pa.record_batch({"word": word, "n": n})

    rows = docs.select("doc_id", "text").mapInArrow(run, "word string, n bigint")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= occurrences)


# Letter counts and trees


@dataclass
class Words:
    """Words as letters in a row (Latin-1 codes), with their counts by letter."""

    codes: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray

    @classmethod
    def of(cls, words: pa.Array) -> Words:
        words = large(words)
        borders = np.frombuffer(words.buffers()[1], np.int64)[: len(words) + 1]
        data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[: borders[-1]]
        lead = data == _LEAD
        codes = (data + np.append(np.uint8(0), 0x40 * lead[:-1].astype(np.uint8)))[~lead] if len(data) else data
        before = np.append(0, np.cumsum(~lead))[borders]
        return cls(codes, before[:-1], np.diff(before))

    def counts(self) -> np.ndarray:
        """A row of LETTERS counts for each word. Counts beyond 16 bits are cut, which only brings words nearer."""
        row = np.repeat(np.arange(len(self.sizes)), self.sizes)
        flat = np.bincount(row * LETTERS + _COLUMN[self.codes], minlength=len(self.sizes) * LETTERS)
        return np.minimum(flat, 30_000).astype(np.int16).reshape(-1, LETTERS)

    def letters(self, which: np.ndarray, width: int) -> np.ndarray:
        """The letters of some words, a row for each, filled up with 0."""
        place = np.arange(width)
        inside = place < self.sizes[which][:, None]
        at = np.where(inside, self.starts[which][:, None] + place, 0)
        return np.where(inside, self.codes[at], 0)


def marks(counts: np.ndarray) -> np.ndarray:
    """64 bits for each word, of which one edit changes at most two: is a letter there, is it there twice."""
    plain = counts[:, :26]
    folded = counts[:, 26:].astype(np.int64)
    some = np.stack([folded[:, k::12].sum(1) > 0 for k in range(12)], 1)
    bits = np.concatenate([plain > 0, plain > 1, some], 1)
    return np.packbits(bits, axis=1).view(np.uint64).ravel()


class CountTree:
    """A K-d tree over letter counts and lengths, with a box for each node.

    ``tight`` boxes hold just the given words; otherwise the boxes of the leaves fill the whole space,
    so that a tree fitted on a sample has a place for every word.
    """

    def __init__(self, counts: np.ndarray, sizes: np.ndarray, leaf: int, tight: bool):
        points = np.concatenate([counts, sizes.astype(np.int32)[:, None]], 1, dtype=np.int32)
        low, high, left, right, begin, end = [], [], [], [], [], []
        order = np.arange(len(points))
        whole = (np.zeros(LETTERS + 1, np.int32), np.full(LETTERS + 1, 2**31 - 1, np.int32))
        used = set()
        stack = [(0, len(points), *whole, -1, None)]
        while stack:
            a, b, lo, hi, parent, side = stack.pop()
            own = points[order[a:b]]
            if tight and b > a:
                lo, hi = own.min(0), own.max(0)
            number = len(low)
            if parent >= 0:
                (left if side else right)[parent] = number
            low.append(lo), high.append(hi), left.append(-1), right.append(-1), begin.append(a), end.append(b)
            if b - a <= leaf:
                continue
            on = LETTERS if own[:, LETTERS].min() < own[:, LETTERS].max() else int(own.var(0).argmax())
            values = np.sort(own[:, on])
            if values[0] == values[-1]:
                continue  # all counts are the same
            cut = values[len(values) // 2]
            cut = cut if cut > values[0] else values[np.searchsorted(values, cut, "right")]
            used.add(on)
            below = own[:, on] < cut
            order[a:b] = np.concatenate([order[a:b][below], order[a:b][~below]])
            middle = a + int(below.sum())
            under, over = hi.copy(), lo.copy()
            under[on], over[on] = cut - 1, cut
            stack += [(middle, b, over, hi, number, False), (a, middle, lo, under, number, True)]
        self.order = order
        low, high = np.array(low), np.array(high)
        self.size_low, self.size_high = low[:, LETTERS], high[:, LETTERS]
        # Only columns that can tell boxes apart; in tight boxes, other letters are not there at all.
        told = high[:, :LETTERS].max(0) > 0 if tight else np.isin(np.arange(LETTERS), [*used])
        self.columns, self.absent = np.flatnonzero(told), np.flatnonzero(~told) if tight else np.zeros(0, int)
        bound = 32_000
        self.low = np.minimum(low[:, self.columns], bound).astype(np.int16)
        self.high = np.minimum(high[:, self.columns], bound).astype(np.int16)
        self.left, self.right = np.array(left), np.array(right)
        self.leaves = np.flatnonzero(self.left < 0)
        self.begin, self.end = np.array(begin), np.array(end)

    def reach(self, counts: np.ndarray, sizes: np.ndarray, more: int, less: int) -> tuple[np.ndarray, np.ndarray]:
        """(question, leaf) wherever a leaf's box can hold a word of the question's size whose counts
        are those of the question with at most ``more`` letters added and ``less`` taken."""
        own = counts[:, self.columns]
        spare = counts[:, self.absent].sum(1)
        asked = np.flatnonzero(spare <= less)
        node = np.zeros(len(asked), np.int64)
        questions, leaves = [asked[:0]], [node[:0]]
        while len(asked):
            fits = (self.size_low[node] <= sizes[asked]) & (sizes[asked] <= self.size_high[node])
            asked, node = asked[fits], node[fits]
            point = own[asked]
            added = np.maximum(self.low[node] - point, 0).sum(1)
            taken = np.maximum(point - self.high[node], 0).sum(1) + spare[asked]
            fits = (added <= more) & (taken <= less)
            asked, node = asked[fits], node[fits]
            done = self.left[node] < 0
            questions.append(asked[done]), leaves.append(node[done])
            asked, node = asked[~done], node[~done]
            asked, node = np.tile(asked, 2), np.concatenate([self.left[node], self.right[node]])
        return np.concatenate(questions), np.concatenate(leaves)


# Near words


def one_edit(a: Words, i: np.ndarray, b: Words, j: np.ndarray) -> np.ndarray:
    """Do words ``a[i]`` and ``b[j]``, of sizes at most one apart, differ by exactly one edit?"""
    out = np.zeros(len(i), bool)
    width = int(max(a.sizes[i].max(), b.sizes[j].max())) + 1
    x, y = a.letters(i, width), b.letters(j, width)
    longer = a.sizes[i] > b.sizes[j]
    x[longer], y[longer] = y[longer], x[longer]  # y is never the shorter one
    differ = x != y
    same = a.sizes[i] == b.sizes[j]
    out[same] = differ[same].sum(1) == 1
    first = differ.argmax(1)
    rest = (x[:, :-1] != y[:, 1:]) & (np.arange(width - 1) >= first[:, None])
    out[~same] = ~rest[~same].any(1)
    return out


class Cell:
    """The words of a cell with their tree."""

    def __init__(self, words: pa.Array, n: np.ndarray):
        self.names, self.n = words, n
        self.words = Words.of(words)
        counts = self.words.counts()
        self.marks = marks(counts)
        self.tree = CountTree(counts, self.words.sizes, LEAF_WORDS, tight=True)
        by_name = np.empty(len(n), np.int64)
        by_name[pc.array_sort_indices(words.cast(pa.binary())).to_numpy()] = np.arange(len(n))
        # The best of several words is the one of largest n, then the first by code points.
        self.best_first = np.lexsort((by_name, -n))
        self.rank = np.empty(len(n), np.int64)
        self.rank[self.best_first] = np.arange(len(n))

    def near(self, asked: Words) -> tuple[np.ndarray, np.ndarray]:
        """All (question, word) one edit apart."""
        counts = asked.counts()
        own = marks(counts)
        tree = self.tree
        found = [(np.zeros(0, np.int64),) * 2]
        for step, more, less in STEPS:
            question, leaf = tree.reach(counts, asked.sizes + step, more, less)
            many = tree.end[leaf] - tree.begin[leaf]
            first = np.repeat(tree.begin[leaf] - (np.cumsum(many) - many), many)
            word = tree.order[first + np.arange(many.sum())]
            question = np.repeat(question, many)
            apart = np.bitwise_count(own[question] ^ self.marks[word])
            maybe = (apart <= more + less) & (self.words.sizes[word] == asked.sizes[question] + step)
            question, word = question[maybe], word[maybe]
            # Long words are compared in smaller lots.
            by_size = np.argsort(self.words.sizes[word], kind="stable")
            question, word = question[by_size], word[by_size]
            cost = np.cumsum(self.words.sizes[word] + 2) // COMPARED_BYTES
            borders = [0, *(np.flatnonzero(np.diff(cost)) + 1).tolist(), len(word)]
            for a, b in zip(borders, borders[1:], strict=False):
                if b > a:
                    good = one_edit(asked, question[a:b], self.words, word[a:b])
                    found.append((question[a:b][good], word[a:b][good]))
        return np.concatenate([q for q, _ in found]), np.concatenate([w for _, w in found])

    def answers(self, questions: pa.Array) -> pa.RecordBatch:
        """For each question with near words here: how many, and the best of them."""
        question, word = self.near(Words.of(questions))
        many = np.bincount(question, minlength=len(questions))
        best = np.full(len(questions), len(self.n))
        np.minimum.at(best, question, self.rank[word])
        some = np.flatnonzero(many)
        best = self.best_first[best[some]]
        return pa.record_batch(
            {
                "word": questions.take(pa.array(some)),
                "n_near": pa.array(many[some].astype(np.int64)),
                "form": self.names.take(pa.array(best)),
                "form_n": pa.array(self.n[best]),
            }
        )


def fitted(words: DataFrame) -> CountTree:
    """The tree of cells, by a sample drawn by hash: it places words, but no result depends on it."""
    total = words.count()
    cells = min(MOST_CELLS, max(1, ceil(total / CELL_WORDS)))
    share = cells * SAMPLE_PER_CELL / max(total, 1)
    steps = 1 << 30
    drawn = words.where(F.pmod(F.xxhash64("word"), F.lit(steps)) < int(min(1.0, share) * steps))
    sample = Words.of(pa.array([r.word for r in drawn.select("word").collect()], pa.string()))
    leaf = max(1, ceil(len(sample.sizes) / cells))
    return CountTree(sample.counts(), sample.sizes, leaf, tight=False)


def placed(words: DataFrame, tree: CountTree) -> DataFrame:
    """``cell``, ``asks``, ``word``, ``n``: each word once where it lies, and as a question wherever near words can lie.

    Cells are numbered by the leaves of ``tree``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, AT_ONCE):
                batch = whole.slice(low, AT_ONCE)
                own = Words.of(batch.column("word"))
                counts = own.counts()
                home, cell = tree.reach(counts, own.sizes, 0, 0)
                reached = [tree.reach(counts, own.sizes + step, more, less) for step, more, less in STEPS]
                nodes = len(tree.left)
                both = np.unique(np.concatenate([q * nodes + leaf for q, leaf in reached]))
                rows = np.concatenate([home, both // nodes])
                cell = np.searchsorted(tree.leaves, np.concatenate([cell, both % nodes]))
                columns = {
                    "cell": pa.array(cell.astype(np.int32)),
                    "asks": pa.array(np.arange(len(rows)) >= len(home)),
                    "word": batch.column("word").take(pa.array(rows)),
                    "n": batch.column("n").take(pa.array(rows)),
                }
                yield pa.record_batch(columns)

    return words.select("word", "n").mapInArrow(run, "cell int, asks boolean, word string, n bigint")


def near_words(words: DataFrame) -> DataFrame:
    """``word``, ``n_near``, ``form``, ``form_n`` from each cell that holds near words of the word."""
    tree = fitted(words)
    rows = placed(words, tree)
    together = rows.repartitionById(len(tree.leaves), F.col("cell")).sortWithinPartitions("cell", "asks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # words of the cell that is being read
        cell, current = None, None
        for batch in batches:
            cells = batch.column("cell").to_numpy()
            asks = batch.column("asks").to_numpy(False)
            change = np.flatnonzero((np.diff(cells) != 0) | (np.diff(asks.astype(np.int8)) != 0)) + 1
            borders = [0, *change.tolist(), batch.num_rows]
            for a, b in zip(borders, borders[1:], strict=False):
                if a == b:
                    continue
                if cells[a] != cell:
                    cell, current, held = cells[a], None, []
                if not asks[a]:
                    held.append(batch.slice(a, b - a))
                    continue
                if not held:
                    continue  # nothing lies in this cell
                if current is None:
                    lying = pa.Table.from_batches(held).combine_chunks()
                    current = Cell(lying["word"].combine_chunks(), lying["n"].to_numpy())
                for low in range(a, b, AT_ONCE):
                    yield current.answers(batch.column("word").slice(low, min(AT_ONCE, b - low)))

    return together.mapInArrow(run, "word string, n_near bigint, form string, form_n bigint")


def variant_forms(docs: DataFrame, ratio: int = 10, least: int = 7, every: int = 31) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n``, ``root`` of each counted word.

    ``form`` is the near word of largest n (ties: first by code points) if that is at least ``ratio``
    times the word's own, else null; ``root`` is where following forms ends.
    """
    words = pinned(count_words(docs, least, every))
    none = words.select("word", "n", F.lit(0).alias("n_near"), F.lit(None).alias("best"))
    best = F.struct((-F.col("form_n")).alias("less"), "form")
    found = near_words(words).select("word", F.lit(None).cast("bigint").alias("n"), "n_near", best.alias("best"))
    whole = none.unionByName(found).groupBy("word").agg(
        F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best")
    )
    far = -F.col("best.less") >= ratio * F.col("n")
    whole = pinned(
        whole.select(
            "word", "n", "n_near",
            F.when(far, F.col("best.form")).alias("form"), F.when(far, -F.col("best.less")).alias("form_n"),
        )
    )
    return whole.join(followed(whole, ratio), "word", "left").withColumn("root", F.coalesce("root", "word"))


def followed(words: DataFrame, ratio: int) -> DataFrame:
    """``word``, ``root`` of all words that have a form."""
    jumps = words.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    most = words.agg(F.max("n")).first()[0] or 1
    longest = max(1, int(log(most) / log(ratio)) + 1)  # forms in a row
    for _ in range(ceil(log2(longest))):
        jumps = pinned(jumps)
        onward = jumps.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        jumps = jumps.join(onward, "root", "left").select("word", F.coalesce("_next", "root").alias("root"))
    return jumps
