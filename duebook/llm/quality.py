"""Quality rules judged by isolation forests over rule statistics.

``rule_statistics`` measures every whole text. ``fit`` grows random trees on a bounded sample of
those statistics and calibrates the anomaly scores at which a document is rejected on labelled rows.
``judge`` applies the base rules and the forests: one over what a text is made of and one over its
repetition, since good texts that repeat lines would hide bad ones from a forest over both.

Defined results: a null or empty text has no words and fails the base rules; without labelled rows
(or with one quality only) nothing but the base rules rejects; repeated rows get equal verdicts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook.llm.batches import slices, texts_of
from duebook.llm.rows import SPACES, pinned

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_distinct_words", "n_upper", "n_marks", "n_lines")
STATISTICS = ", ".join(f"{name} bigint" for name in (*BASE, *MORE))

SYMBOLS = "#*$%&|<>"
MARKS = b"!?.,;:"
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))

#: Rows of statistics the forest is grown on (twice as many at most), rows per tree, and trees.
SAMPLE_ROWS, TREE_ROWS, TREES = 20_000, 256, 100
#: Share of the good labelled rows that calibration may reject at most.
GOOD_LOST = 0.005
SCORE_BINS = 2_000
#: Columns of the features that each forest sees: make-up, and repetition.
FORESTS = ((0, 1, 5, 6), (2, 3, 4, 7))


def statistics(text: str) -> tuple[int, ...]:
    """The values of BASE and MORE for one text."""
    data = text.encode()
    words = data.split()  # splits at ASCII white space, as the rules ask
    seen: set[str] = set()
    repeated_lines = n_lines = 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            n_lines += 1
            repeated_lines += line in seen
            seen.add(line)
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        repeated_lines,
        repeated_words(words),
        len(set(words)),
        len(data) - len(data.translate(None, CAPITALS)),
        len(data) - len(data.translate(None, MARKS)),
        n_lines,
    )


def repeated_words(words: list[bytes]) -> int:
    """Words that stand in a window of three words found twice or more in the text."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    total = covered = 0  # words before ``covered`` are counted
    for i, window in enumerate(windows):
        if counts[window] > 1:
            total += i + 3 - max(covered, i)
            covered = i + 3
    return total


def rule_statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """Columns ``keep`` of ``docs`` and the statistics of ``text``. One pass, no shuffle."""
    fields = [docs.schema[name] for name in keep]
    names = [*BASE, *MORE]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = np.array([statistics(t) for t in texts_of(batch).to_pylist()], np.int64)
            columns = {name: batch.column(name) for name in keep}
            columns |= {name: pa.array(found[:, i]) for i, name in enumerate(names)}
            yield pa.record_batch(columns)

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return docs.select(*keep, "text").mapInArrow(measure, f"{ddl}, {STATISTICS}" if ddl else STATISTICS)


def ratios(counts: np.ndarray) -> np.ndarray:
    """All other statistics per word, for rows of BASE and MORE."""
    return counts[:, 1:] / np.maximum(counts[:, :1], 1).astype(float)


def features(counts: np.ndarray, usual: np.ndarray) -> np.ndarray:
    """Deviations from what is usual for as many words, scaled with the text's own length.

    A count scatters with the root of the words it is taken over, so the deviation over that root
    means the same at any length. It is squeezed between -1 and 1: a clear deviation stands out
    beside a huge one.
    """
    words = np.maximum(counts[:, :1], 1).astype(float)
    deviation = (counts[:, 1:] - usual * words) / np.sqrt(words)
    return deviation / (np.abs(deviation) + 1)


@dataclass(frozen=True)
class Forest:
    """Isolation trees as flat arrays: node 2i+1, 2i+2 are the children of node i of a tree."""

    column: np.ndarray  # trees x nodes; -1: leaf
    border: np.ndarray
    depth: np.ndarray  # path length at a leaf, with the expected rest of an unsplit node
    scale: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Anomaly score between 0 and 1 for each row; short paths are anomalous."""
        total = np.zeros(len(rows))
        every = np.arange(len(rows))
        for column, border, depth in zip(self.column, self.border, self.depth, strict=True):
            node = np.zeros(len(rows), np.int64)
            while True:
                split = column[node]
                inner = split >= 0
                if not inner.any():
                    break
                right = rows[every, np.maximum(split, 0)] >= border[node]
                node = np.where(inner, 2 * node + 1 + right, node)
            total += depth[node]
        return 2.0 ** (-total / max(len(self.column), 1) / self.scale)


def expected_path(rows: int) -> float:
    """Mean path of an unsuccessful search in a binary tree of ``rows`` rows."""
    if rows <= 1:
        return 0.0
    return 2 * (np.log(rows - 1) + np.euler_gamma) - 2 * (rows - 1) / rows


def grow(rows: np.ndarray, trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = 7) -> Forest:
    """A forest of random splits on ``rows`` (at least one)."""
    rng = np.random.default_rng(seed)
    size = min(tree_rows, len(rows))
    limit = max(1, int(np.ceil(np.log2(max(size, 2)))))
    nodes = 2 ** (limit + 1) - 1
    column = np.full((trees, nodes), -1, np.int64)
    border, depth = np.zeros((trees, nodes)), np.zeros((trees, nodes))

    def split(tree: int, node: int, part: np.ndarray, level: int) -> None:
        low, high = part.min(0), part.max(0)
        open_columns = np.flatnonzero(high > low)
        if level == limit or len(part) <= 1 or not len(open_columns):
            depth[tree, node] = level + expected_path(len(part))
            return
        chosen = rng.choice(open_columns)
        at = rng.uniform(low[chosen], high[chosen])
        right = part[:, chosen] >= at
        if right.all() or not right.any():
            depth[tree, node] = level + expected_path(len(part))
            return
        column[tree, node], border[tree, node] = chosen, at
        split(tree, 2 * node + 1, part[~right], level + 1)
        split(tree, 2 * node + 2, part[right], level + 1)

    for tree in range(trees):
        split(tree, 0, rows[rng.choice(len(rows), size, replace=False)], 0)
    return Forest(column, border, depth, max(expected_path(size), 1e-9))


@dataclass(frozen=True)
class Model:
    forests: tuple[Forest, ...]
    usual: np.ndarray
    limits: np.ndarray  # a higher anomaly score in any forest rejects

    def scores(self, counts: np.ndarray) -> np.ndarray:
        """One column per forest."""
        rows = features(counts, self.usual)
        return np.column_stack([f.score(rows[:, c]) for f, c in zip(self.forests, FORESTS, strict=True)])

    def rejects(self, counts: np.ndarray) -> np.ndarray:
        return (self.scores(counts) > self.limits).any(axis=1)


def base_failed(counts: np.ndarray) -> np.ndarray:
    return (counts[:, 0] < 50) | (100 * counts[:, 4] > 50 * counts[:, 0])


def matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([batch.column(n).to_numpy(zero_copy_only=False) for n in (*BASE, *MORE)])


def sample(passing: DataFrame) -> np.ndarray:
    """Some SAMPLE_ROWS rows of statistics (all, if there are fewer), in an order of their own.

    Rows are drawn by a hash of id and statistics, so no rows are sorted or moved but those drawn.
    """
    total = passing.count()
    drawn = F.pmod(F.xxhash64(F.lit(11), "doc_id", *BASE), F.lit(max(total, 1))) < SAMPLE_ROWS
    # Copies of one row are drawn together; the limit bounds what they may add.
    found = passing.where(drawn).limit(2 * SAMPLE_ROWS).select(*BASE, *MORE).collect()
    return np.array(sorted(map(tuple, found)), np.int64)


def medians(passing: DataFrame) -> np.ndarray:
    """The usual ratios: medians over all rows (some, so ``passing`` may not be empty)."""
    names = [*BASE, *MORE][1:]
    found = passing.agg(*(F.percentile_approx(F.col(n) / F.greatest("n_words", F.lit(1)), 0.5).alias(n) for n in names)).first()
    return np.array([found[n] for n in names], float)


def fit(stats: DataFrame, labels: DataFrame, good_lost: float = GOOD_LOST) -> Model | None:
    """Grow the forests on a bounded sample of ``stats``; place their limits by ``labels``.

    ``stats``: statistics with ``doc_id``; read several times, so pass a stored table. ``labels``:
    ``doc_id`` and ``quality`` (1 good, 0 bad). The limits are score bins above which at most
    ``good_lost`` of all good labelled rows are, over the whole of ``labels`` and all forests together.
    None when no row passes the base rules.
    """
    passing = stats.where("n_words >= 50 AND 100 * n_repeat_words <= 50 * n_words")
    rows = sample(passing)
    if not len(rows):
        return None
    usual = medians(passing)
    found = features(rows, usual)
    open_model = Model(tuple(grow(found[:, c]) for c in FORESTS), usual, np.full(len(FORESTS), np.inf))
    marked = labels.where("quality IN (0, 1)").select("doc_id", F.col("quality").cast("int").alias("quality"))
    measured = with_scores(passing.join(marked, "doc_id").select("quality", *BASE, *MORE), "quality", open_model)
    binned = measured.groupBy("quality", "forest", F.floor(F.col("score") * SCORE_BINS).cast("int").alias("bin")).count()
    table = np.zeros((2, len(FORESTS), SCORE_BINS + 2), np.int64)  # nothing reaches the last bin
    for quality, forest, place, count in binned.collect():
        table[quality, forest, place] = count
    if not table[1].sum() or not table[0].sum():
        return open_model
    return Model(open_model.forests, usual, limits(*table, good_lost))


def limits(bad: np.ndarray, good: np.ndarray, good_lost: float) -> np.ndarray:
    """The two forests' limits that catch most bad rows, from rows by forest and score bin.

    Good rows lost to both forests count twice, so at most ``good_lost`` of all are lost.
    """
    caught, lost = (rows[:, ::-1].cumsum(axis=1)[:, ::-1] for rows in (bad, good))  # in this bin or a higher one
    left = good_lost * good[0].sum() - lost[0]
    # The lowest bin of the second forest that loses no more than the first one leaves.
    second = good.shape[1] - np.searchsorted(lost[1][::-1], left, "right")
    possible = left >= 0
    both = np.where(possible, caught[0] + caught[1][np.minimum(second, good.shape[1] - 1)], -1)
    first = int(np.argmax(both))
    return np.array([first, second[first]]) / SCORE_BINS


def with_scores(stats: DataFrame, keep: str, model: Model) -> DataFrame:
    """``keep``, the number of the ``forest`` and its anomaly ``score``, for each row of statistics and forest."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                for forest, score in enumerate(model.scores(matrix(batch)).T):
                    number = pa.array(np.full(len(score), forest, np.int32))
                    yield pa.record_batch({keep: batch.column(keep), "forest": number, "score": pa.array(score)})

    kind = stats.schema[keep].dataType.simpleString()
    return stats.select(keep, *BASE, *MORE).mapInArrow(measure, f"`{keep}` {kind}, forest int, score double")


def judge(stats: DataFrame, model: Model | None) -> DataFrame:
    """``stats`` with ``base_failed``, the highest anomaly ``score`` (null without a model) and ``kept``."""
    names = stats.columns

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            counts = matrix(batch)
            failed = base_failed(counts)
            score = model.scores(counts) if model else np.full((len(counts), 1), np.nan)
            kept = ~failed & ~(score > (model.limits if model else np.inf)).any(axis=1)
            added = {
                "base_failed": pa.array(failed),
                "score": pa.array(score.max(axis=1), from_pandas=True),
                "kept": pa.array(kept),
            }
            yield pa.record_batch({n: batch.column(n) for n in names} | added)

    schema = stats.schema.simpleString()[len("struct<") : -1]
    return stats.mapInArrow(decide, f"{schema}, base_failed boolean, score double, kept boolean")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs`` that the base rules and the forest keep, all columns as they were.

    The texts are measured twice, for the model and for the verdict, and never shuffled.
    """
    stats = pinned(rule_statistics(docs.select("doc_id", "text"), "doc_id"))
    model = fit(stats, labels)

    @F.pandas_udf("boolean")
    def is_good(texts: pd.Series) -> pd.Series:
        if not len(texts):
            return pd.Series([], dtype=bool)
        counts = np.array([statistics(t or "") for t in texts], np.int64)
        rejected = model.rejects(counts) if model else np.zeros(len(counts), bool)
        return pd.Series(~base_failed(counts) & ~rejected)

    return docs.where(is_good("text"))
