"""Language identification by error-correcting output codes.

Each language has a codeword of bits; for each bit one binary classifier over character n-grams says
how strongly a text speaks for 1. Decoding sums, for each language, the loss of every classifier
against the language's bit, weighted by how reliable the classifier was in training, and takes
the least; a small gap to the second is flagged as ambiguous.

The classifiers are log-odds of n-gram frequencies, counted over all training documents: per language
and hash bucket one number goes to the driver. What the model holds is bounded by languages and
buckets.

Defined results: a null text or one without letters is ``und`` with score 0 and ambiguous; so is every
text when no labelled row exists; repeated rows get equal predictions; with one language, it is
predicted for every text with letters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook.llm.batches import slices, texts_of

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
UNKNOWN = "und"
#: Languages up to which every split of them gets a classifier; beyond, random codewords.
EXHAUSTIVE = 5
#: Probability gap between the best two languages below which a text is ambiguous.
AMBIGUOUS = 0.2
SMOOTHING = 0.5


def letters_only(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case code points of all texts, 0 for other characters and between texts, and where
    each text begins (one more than texts)."""
    joined = [" " + t.lower() + " " for t in texts]
    starts = np.concatenate([[0], np.cumsum([len(t) for t in joined])]).astype(np.int64)
    points = np.frombuffer("".join(joined).encode("utf-32-le", "surrogatepass"), np.uint32)
    known, place = np.unique(points, return_inverse=True)
    table = np.array([p if chr(p).isalpha() else 0 for p in known.tolist()], np.uint32)
    return table[place], starts


def gram_buckets(points: np.ndarray, order: int) -> np.ndarray:
    """The bucket of the n-gram that begins at each place; -1 where it is not counted.

    Counted are n-grams within words and across their borders; runs of non-letters are not.
    """
    n = len(points) - order + 1
    if n <= 0:
        return np.full(len(points), -1, np.int64)
    value = np.full(n, order, np.uint64)
    any_letter = np.zeros(n, bool)
    for i in range(order):
        part = points[i : i + n]
        value = (value ^ part) * np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(29)
        any_letter |= part > 0
    found = np.full(len(points), -1, np.int64)
    found[:n] = np.where(any_letter, (value >> np.uint64(17)) % np.uint64(BUCKETS), -1)
    return found


def gram_counts(training: DataFrame) -> DataFrame:
    """``lang, bucket, n`` over all rows of ``training`` (``text``, ``lang``)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in slices(batches):
            langs = np.array(batch.column("lang").to_pylist(), object)
            points, starts = letters_only(texts_of(batch).to_pylist())
            names, of_text = np.unique(langs.astype(str), return_inverse=True)
            lang = np.repeat(of_text, np.diff(starts))
            for order in ORDERS:
                bucket = gram_buckets(points, order)
                real = bucket >= 0
                number = np.bincount(lang[real] * BUCKETS + bucket[real], minlength=len(names) * BUCKETS)
                for i, name in enumerate(names.tolist()):
                    own = number[i * BUCKETS : (i + 1) * BUCKETS]
                    totals[name] = totals.get(name, 0) + own
        for name, own in totals.items():
            seen = np.flatnonzero(own)
            yield pa.record_batch({"lang": pa.array([name] * len(seen)), "bucket": pa.array(seen), "n": pa.array(own[seen])})

    counted = training.select("text", "lang").mapInArrow(count, "lang string, bucket bigint, n bigint")
    return counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def codewords(languages: int) -> np.ndarray:
    """Bits of each language, -1 or 1, far apart from each other; no column is constant."""
    if languages == 1:
        return np.ones((1, 1))
    if languages <= EXHAUSTIVE:
        splits = np.arange(1, 2 ** (languages - 1))
        return np.array([[1 - 2 * (s >> c & 1) for s in splits] for c in range(languages)], float)
    rng = np.random.default_rng(3)
    length = max(16, int(np.ceil(10 * np.log2(languages))))
    best, distance = None, -1.0
    for _ in range(200):
        code = rng.choice([-1.0, 1.0], (languages, length))
        if (abs(code.sum(0)) == languages).any():
            continue
        apart = (length - code @ code.T) / 2 + np.eye(languages) * length
        if apart.min() > distance:
            best, distance = code, apart.min()
    return best


@dataclass(frozen=True)
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits
    odds: np.ndarray  # buckets x bits: log-odds of a gram for 1
    scale: np.ndarray  # mean log-odds of the training languages, per bit
    weight: np.ndarray  # reliability, per bit

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, probability and ambiguity of each text."""
        points, starts = letters_only(texts)
        total = np.zeros((len(texts), self.code.shape[1]))
        number = np.zeros(len(texts))
        for order in ORDERS:
            bucket = gram_buckets(points, order)
            # An extra row of zeros for places that don't count; each text ends with such places.
            total += np.add.reduceat(self.odds[bucket], starts[:-1], axis=0)
            number += np.add.reduceat((bucket >= 0).astype(float), starts[:-1])
        margin = total / np.maximum(number, 1)[:, None] / self.scale
        loss = np.logaddexp(0, -4 * margin[:, None, :] * self.code[None])
        cost = (loss * self.weight).sum(2) / self.weight.sum() * self.code.shape[1] ** 0.5
        chance = np.exp(cost.min(1, keepdims=True) - cost)
        chance /= chance.sum(1, keepdims=True)
        best = chance.argmax(1)
        ordered = np.sort(chance, axis=1)
        gap = ordered[:, -1] - (ordered[:, -2] if ordered.shape[1] > 1 else 0)
        none = number == 0
        names = [UNKNOWN if n else self.languages[b] for b, n in zip(best.tolist(), none.tolist(), strict=True)]
        return names, np.where(none, 0.0, chance[np.arange(len(best)), best]), none | (gap < AMBIGUOUS)


def fit(training: DataFrame) -> Model | None:
    """Learn from ``text`` and ``lang`` of all rows with a language; None if there are none."""
    counted = gram_counts(training.where("lang IS NOT NULL")).collect()  # languages x buckets
    languages = sorted({row.lang for row in counted})
    if not languages:
        return None
    number = {name: i for i, name in enumerate(languages)}
    counts = np.zeros((len(languages), BUCKETS))
    for row in counted:
        counts[number[row.lang], row.bucket] = row.n
    # Languages count alike, however many documents they have.
    rate = (counts + SMOOTHING) / (counts + SMOOTHING).sum(1, keepdims=True)
    code = codewords(len(languages))
    ones, zeros = (code > 0).astype(float), (code < 0).astype(float)
    of_one = (rate.T @ ones) / np.maximum(ones.sum(0), 1)
    of_zero = (rate.T @ zeros) / np.maximum(zeros.sum(0), 1)
    odds = np.log(of_one) - np.log(np.where(zeros.sum(0) > 0, of_zero, of_one / np.e))
    mean = rate @ odds  # the usual log-odds of each language's own texts
    scale = np.maximum(abs(mean).mean(0), 1e-9)
    weight = np.maximum((mean * code).min(0) / scale, 0.05)
    return Model(languages, code, np.vstack([odds, np.zeros(odds.shape[1])]).astype(np.float32), scale, weight)


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, lang_pred, score, ambiguous`` of each row, from its whole text alone."""

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = texts_of(batch).to_pylist()
            if model:
                names, score, ambiguous = model.predict(texts)
            else:
                names, score, ambiguous = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "lang_pred": pa.array(names, pa.string()),
                    "score": pa.array(score),
                    "ambiguous": pa.array(ambiguous),
                }
            )

    ddl = "doc_id bigint, lang_pred string, score double, ambiguous boolean"
    return docs.select("doc_id", "text").mapInArrow(predict, ddl)
