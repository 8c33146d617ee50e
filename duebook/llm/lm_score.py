"""Language-model scores by a probabilistic suffix tree, beside a base of word frequencies.

The tree's symbols are the bytes of a text's tokens: words joined by single spaces, then an end symbol, so
its probability is one of the token sequence, unseen words included. Contexts of up to DEPTH
symbols are counted over all training texts. A context is a candidate if at least LEAST_COUNT
symbols follow it, so the tree grows with the corpus; it is retained if its next symbols diverge
from those of its suffix by more than a description of them costs (BIC). Next-symbol distributions
are smoothed with those of the suffix. A text is scored with the longest retained suffix at each
symbol. That is a function of the symbol and the DEPTH symbols before it, its gram: retained contexts
stay distributed; the most frequent grams, at most HOT_GRAMS, are looked up inside the scan, and the others
are joined with their contexts by hash and depth.

Word counts for the base grow with the corpus and stay distributed. Words above 1/HOT_SHARE of all
tokens, fewer than HOT_SHARE, are looked up inside the scan; the others are joined by hash.

Defined results: a null, empty or blank text is the end token alone; a row without id is held out;
repeated rows are scored once each; without training rows all base counts are 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook.llm.batches import MIX, large, slices, texts_of, word_hashes
from duebook.session import settle_down

DEPTH = 5
LEAST_COUNT = 20
HOT_SHARE, HOT_GRAMS = 50_000, 1_000_000
SEGMENT = 1_024
#: Distinct counts that a task gathers before it passes them on.
GATHERED = 3_000_000
END = 10  # a line end: no word and no joining space holds it
END_TOKEN = xxhash.xxh64_intdigest("\n")


def normalized(texts: pa.Array) -> list[bytes]:
    """Words, A-Z in lower case, each with one space behind it."""
    joined = pc.replace_substring_regex(pc.ascii_lower(large(texts)), pattern=r"[ \t-\r]+", replacement=" ")
    trimmed = pc.utf8_trim(joined, characters=" ").to_pylist()
    return [t.encode() + b" " if t else b"" for t in trimmed]


def gram_keys(texts: list[bytes]) -> np.ndarray:
    """DEPTH symbols of context and the next symbol, packed, for each symbol of each text."""
    gap = bytes([END]) * DEPTH
    stream = np.frombuffer(gap + b"".join(t + gap for t in texts), np.uint8).astype(np.uint64)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1  # with the end
    begins = DEPTH + np.cumsum(lengths - 1 + DEPTH) - (lengths - 1 + DEPTH)
    places = np.repeat(begins - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
    key = np.zeros(len(stream), np.uint64)
    for back in range(DEPTH, -1, -1):
        key[DEPTH:] = (key[DEPTH:] << np.uint64(8)) | stream[DEPTH - back : len(stream) - back]
    return key[places]


class Tally:
    """Counts of keys, merged when many have come together."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray) -> None:
        found, number = np.unique(keys, return_counts=True)
        self.parts.append((found, number))
        self.size += len(found)
        if self.size > GATHERED:
            self.parts = [self.merged()]
            self.size = len(self.parts[0][0])

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        keys = np.concatenate([k for k, _ in self.parts])
        number = np.concatenate([n for _, n in self.parts])
        order = np.argsort(keys, kind="stable")
        keys, number = keys[order], number[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        return keys[first], np.add.reduceat(number, first)

    def passed_on(self, kind: int, least: int = 0) -> Iterator[pa.RecordBatch]:
        if self.size > least:
            keys, number = self.merged()
            self.parts, self.size = [], 0
            kinds = np.full(len(keys), kind, np.int32)
            yield pa.record_batch({"kind": pa.array(kinds), "key": pa.array(keys.view(np.int64)), "n": pa.array(number)})


WORDS, GRAMS = 0, 1


def training_counts(training: DataFrame) -> DataFrame:
    """``kind, key, n``: counts of word hashes (with the end token) and of packed grams."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, grams = Tally(), Tally()
        for batch in slices(batches):
            texts = texts_of(batch)
            own, _ = word_hashes(texts)
            words.add(np.concatenate([own, np.full(len(texts), END_TOKEN, np.uint64)]))
            grams.add(gram_keys(normalized(texts)))
            yield from words.passed_on(WORDS, GATHERED // 2)
            yield from grams.passed_on(GRAMS, GATHERED // 2)
        yield from words.passed_on(WORDS)
        yield from grams.passed_on(GRAMS)

    counted = training.select("text").mapInArrow(count, "kind int, key bigint, n bigint")
    return counted.groupBy("kind", "key").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class SuffixTree:
    """The automaton of the retained contexts: next state and log10 probability by symbol.

    The model of a small corpus in one piece, which the distributed scores are held against.
    """

    step: np.ndarray  # states x 256
    log10: np.ndarray  # states x 256

    def token_scores(self, texts: list[bytes]) -> np.ndarray:
        """The log10 probability of each token of each text, the end included, all in a row."""
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        pieces = -(-lengths // SEGMENT)
        owner = np.repeat(np.arange(len(texts)), pieces)
        begin = (np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * SEGMENT
        size = np.minimum(SEGMENT, lengths[owner] - begin)
        order = np.argsort(-size, kind="stable")
        owner, begin, size = owner[order], begin[order], size[order]
        gap = bytes([END]) * DEPTH
        stream = np.frombuffer(gap + b"".join(t + gap for t in texts) + bytes(SEGMENT), np.uint8)
        text_at = np.cumsum(lengths - 1 + DEPTH) - (lengths - 1 + DEPTH)
        at = text_at[owner] + begin
        state = np.zeros(len(owner), np.int64)
        log10 = np.zeros(len(stream))
        flat_step, flat_log10 = self.step.ravel(), self.log10.ravel()
        for t in range(DEPTH + int(size[0])):
            if t > DEPTH:  # segments that have ended leave; the longest stand first
                active = int(np.searchsorted(-size, -(t - DEPTH), "left"))
                state, at = state[:active], at[:active]
            place = state * 256 + stream[at + t]
            if t >= DEPTH:
                log10[at + t] = flat_log10[place]
            state = flat_step[place]
        # A token begins where its text begins and behind each space; nothing is scored between.
        first = np.zeros(len(stream), bool)
        first[text_at + DEPTH] = True
        first[np.flatnonzero(stream == ord(" ")) + 1] = True
        return np.add.reduceat(log10, np.flatnonzero(first))


def context_table(grams: DataFrame) -> DataFrame:
    """``depth, context, n, gain, symbols, numbers``: the candidate contexts with their counts.

    ``gain``: log-likelihood of the next symbols beyond what the suffix context gives them.
    """
    masks = [(1 << 8 * (k + 1)) - 1 for k in range(DEPTH + 1)]
    levels = F.array(*(F.struct(F.lit(k).alias("depth"), F.col("key").bitwiseAND(F.lit(m)).alias("gram")) for k, m in enumerate(masks)))
    by_level = grams.select("n", F.inline(levels)).groupBy("depth", "gram").agg(F.sum("n").alias("n"))
    by_level = settle_down(by_level, "lm-grams")
    contexts = by_level.groupBy("depth", F.shiftright("gram", 8).alias("context")).agg(F.sum("n").alias("n_context"))
    contexts = contexts.where((F.col("n_context") >= LEAST_COUNT) | (F.col("depth") == 0))
    inside = by_level.withColumn("context", F.shiftright("gram", 8)).join(contexts, ["depth", "context"])
    suffix = F.col("gram").bitwiseAND(F.element_at(F.array(*map(F.lit, [0, *masks[:-1]])), F.col("depth") + 1))
    shorter = inside.select((F.col("depth") + 1).alias("depth"), F.col("gram").alias("_suffix"), F.col("n").alias("n_suffix"), F.col("n_context").alias("n_all"))
    pairs = inside.withColumn("_suffix", suffix).join(shorter, ["depth", "_suffix"], "left")
    gain = F.col("n") * F.log(F.col("n") / F.col("n_context") * F.col("n_all") / F.col("n_suffix"))
    return pairs.groupBy("depth", "context").agg(
        F.first("n_context").alias("n"),
        F.sum(gain).alias("gain"),
        F.collect_list(F.col("gram").bitwiseAND(F.lit(255)).cast("int")).alias("symbols"),
        F.collect_list("n").alias("numbers"),
    )


def grow(contexts: DataFrame) -> SuffixTree:
    """The tree of a small corpus, from all of its candidates."""
    found = {(r.depth, r.context): r for r in contexts.collect()}

    def retained(row) -> bool:
        return row.depth == 0 or row.gain > 0.5 * len(row.symbols) * np.log(row.n)

    def suffix(depth: int, context: int) -> tuple[int, int]:
        return depth - 1, context & ((1 << 8 * (depth - 1)) - 1)

    # Every suffix of a retained context predicts as well; every prefix is needed as a state.
    predicts, states = {(0, 0)}, {(0, 0)}
    for key, row in found.items():
        if retained(row):
            while key not in predicts:
                predicts.add(key)
                key = suffix(*key)
    for depth, context in predicts:
        while (depth, context) not in states:
            own = (depth, context)
            while own not in states:
                states.add(own)
                own = suffix(*own)
            depth, context = depth - 1, context >> 8
    ordered = sorted(states)
    number = {key: i for i, key in enumerate(ordered)}
    step = np.zeros((len(ordered), 256), np.int32)
    chance = np.zeros((len(ordered), 256))
    for i, (depth, context) in enumerate(ordered):  # shorter contexts first
        if depth:
            parent = number[suffix(depth, context)]
            step[i], chance[i] = step[parent], chance[parent]
        else:
            chance[i] = 1 / 256
        if (depth, context) in predicts and (row := found.get((depth, context))):
            kinds = len(row.symbols)  # Witten-Bell: as much for the suffix as there are symbols
            own = np.zeros(256)
            own[row.symbols] = row.numbers
            chance[i] = (own + kinds * chance[i]) / (row.n + kinds)
    for i, (depth, context) in enumerate(ordered):
        # From each suffix's steps, those that lead further: contexts that end in the symbol.
        parent = number[suffix(depth, context)] if depth else None
        if parent is not None:
            step[i] = step[parent]
        for symbol in range(256):
            longer = (depth + 1, context << 8 | symbol)
            if longer in number:
                step[i, symbol] = number[longer]
    return SuffixTree(step, np.log10(chance).astype(np.float32))


def predicting(contexts: DataFrame) -> DataFrame:
    """The contexts that predict: the empty one, the retained ones, and every suffix of these."""
    enough = F.col("gain") > 0.5 * F.size("symbols") * F.log("n")
    suffixes = F.array(
        *(F.struct(F.lit(k).alias("depth"), F.col("context").bitwiseAND(F.lit((1 << 8 * k) - 1)).alias("context")) for k in range(1, DEPTH + 1))
    )
    wanted = contexts.where((F.col("depth") > 0) & enough).select(F.inline(F.slice(suffixes, 1, F.col("depth")))).distinct()
    kept = contexts.join(wanted, ["depth", "context"], "left_semi").unionByName(contexts.where("depth = 0"))
    return settle_down(kept.drop("gain"), "lm-contexts")


def shallow_chances(contexts: DataFrame) -> np.ndarray:
    """Chances by the symbol before and the symbol, from the contexts of at most one symbol."""
    rows = {(r.depth, r.context): r for r in contexts.where("depth <= 1").collect()}  # 257 at most

    def smoothed(row, chance: np.ndarray) -> np.ndarray:
        own = np.zeros(256)
        own[row.symbols] = row.numbers
        return (own + len(row.symbols) * chance) / (row.n + len(row.symbols))

    root = np.full(256, 1 / 256)
    if (0, 0) in rows:
        root = smoothed(rows[0, 0], root)
    return np.concatenate([smoothed(rows[1, c], root) if (1, c) in rows else root for c in range(256)])


def log_chances(grams: DataFrame, contexts: DataFrame, shallow: np.ndarray) -> DataFrame:
    """``gram, log10``: each (distinct) gram's probability by the longest of ``contexts`` it ends."""
    table = pa.table({"pair": pa.array(np.arange(len(shallow))), "chance": pa.array(shallow)})
    start = F.broadcast(grams.sparkSession.createDataFrame(table))
    levels = F.array(
        *(
            F.struct(F.lit(k).alias("depth"), F.shiftright(F.col("gram").bitwiseAND(F.lit((1 << 8 * (k + 1)) - 1)), 8).alias("context"))
            for k in range(2, DEPTH + 1)
        )
    )
    asked = grams.select("gram", F.inline(levels)).join(contexts.where("depth > 1"), ["depth", "context"], "left")
    symbol = F.col("gram").bitwiseAND(F.lit(255)).cast("int")
    number = F.coalesce(F.get("numbers", F.array_position("symbols", symbol).cast("int") - 1), F.lit(0))
    # Contexts that do not predict have no row; a list leaves their nulls out.
    step = F.when(F.col("n").isNotNull(), F.struct("depth", number.alias("found"), F.col("n").alias("all"), F.size("symbols").alias("kinds")))
    steps = asked.groupBy("gram").agg(F.sort_array(F.collect_list(step)).alias("steps"))
    chance = F.aggregate("steps", F.col("chance"), lambda p, s: (s["found"] + s["kinds"] * p) / (s["all"] + s["kinds"]))
    pair = F.col("gram").bitwiseAND(F.lit(65_535))
    return steps.join(start, pair == F.col("pair")).select("gram", F.log10(chance).alias("log10"))


def frequent(grams: DataFrame) -> DataFrame:
    """``gram``: those of the highest counts, as many whole bins of counts as HOT_GRAMS rows hold."""
    place = F.floor(F.log2("n") * 4).cast("int")
    bins = sorted(grams.groupBy(place.alias("bin")).count().collect(), reverse=True)  # 256 at most
    held, least = 0, None
    for bin, number in bins:
        held += number
        if held > HOT_GRAMS:
            break
        least = bin
    chosen = F.lit(False) if least is None else place >= least
    return grams.where(chosen).select(F.col("key").alias("gram"))


class Lookup:
    """Values (not NaN) of many keys at once, from a hash table with open addresses."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(2 * len(keys), 2).bit_length()
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.zeros(1 << bits, np.uint64), np.full(1 << bits, np.nan)
        home, left = self._home(keys), np.arange(len(keys))
        step = 0
        while len(left):
            place = (home[left] + step) & self.mask
            free = np.flatnonzero(np.isnan(self.values[place]))
            taken, first = np.unique(place[free], return_index=True)
            put = left[free[first]]
            self.keys[taken], self.values[taken] = keys[put], values[put]
            left = np.delete(left, free[first])
            step += 1

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * MIX) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, NaN where there is none."""
        place = self._home(keys)
        out = self.values[place]
        left = np.flatnonzero((self.keys[place] != keys) & ~np.isnan(out))
        place = place[left]
        while len(left):
            place = (place + 1) & self.mask
            value = self.values[place]
            out[left] = value
            more = (self.keys[place] != keys[left]) & ~np.isnan(value)
            left, place = left[more], place[more]
        return out


def scores(docs: DataFrame, training: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` of each row of ``docs``.

    ``training``: the rows of ``docs`` to learn from.
    """
    spark = docs.sparkSession
    counts = settle_down(training_counts(training), "lm-counts")
    grams = counts.where(F.col("kind") == GRAMS).select("key", "n")
    contexts = predicting(context_table(grams))
    shallow = shallow_chances(contexts)
    found = log_chances(frequent(grams), contexts, shallow).toArrow()
    lookup = Lookup(found["gram"].to_numpy().view(np.uint64), found["log10"].to_numpy())
    words = counts.where(F.col("kind") == WORDS).select(F.col("key").alias("token"), F.col("n").alias("count"))
    sums = words.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    bottom = sums.n + 0.1 * (sums.v + 1)
    often = words.where(F.col("count") > sums.n / HOT_SHARE).collect()  # fewer than HOT_SHARE
    hot = np.array(sorted((r.token, r["count"]) for r in often), np.int64).reshape(-1, 2)
    shared = spark.sparkContext.broadcast((lookup, hot))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup, hot = shared.value
        known, logs = hot[:, 0], np.log10((hot[:, 1] + 0.1) / bottom)
        end = np.uint64(END_TOKEN)
        row = TaskContext.get().partitionId() << 40
        for batch in slices(batches):
            texts = texts_of(batch)
            own, starts = word_hashes(texts)
            tokens, numbers, base, n_known = [], [], [], []
            for low, high in zip(starts, starts[1:], strict=False):
                found, number = np.unique(np.append(own[low:high], end), return_counts=True)
                found = found.view(np.int64)
                place = np.minimum(np.searchsorted(known, found), max(len(known) - 1, 0))
                is_hot = known[place] == found if len(known) else np.zeros(len(found), bool)
                base.append(float((number[is_hot] * logs[place[is_hot]]).sum()) if len(known) else 0.0)
                n_known.append(int(number[is_hot].sum()))
                tokens.append(found[~is_hot])
                numbers.append(number[~is_hot].astype(np.int32))
            cleaned = normalized(texts)
            keys = gram_keys(cleaned)
            begin = np.concatenate([[0], np.cumsum(np.fromiter(map(len, cleaned), np.int64, len(cleaned)) + 1)])
            logs_of = lookup.find(keys)
            unknown = np.flatnonzero(np.isnan(logs_of))
            logs_of[unknown] = 0
            rare, rare_numbers = [], []
            for own_keys in np.split(keys[unknown], np.searchsorted(unknown, begin[1:-1])):
                found, number = np.unique(own_keys, return_counts=True)
                rare.append(found.view(np.int64))
                rare_numbers.append(number.astype(np.int32))
            yield pa.record_batch(
                {
                    "row": pa.array(row + np.arange(len(texts))),
                    "doc_id": batch.column("doc_id"),
                    "n_tokens": pa.array(np.diff(starts) + 1),
                    "n_hot": pa.array(n_known, pa.int64()),
                    "base_hot": pa.array(base),
                    "score_hot": pa.array(np.add.reduceat(logs_of, begin[:-1])),
                    "tokens": pa.array(tokens, pa.list_(pa.int64())),
                    "numbers": pa.array(numbers, pa.list_(pa.int32())),
                    "grams": pa.array(rare, pa.list_(pa.int64())),
                    "gram_numbers": pa.array(rare_numbers, pa.list_(pa.int32())),
                }
            )
            row += len(texts)

    ddl = (
        "row bigint, doc_id bigint, n_tokens bigint, n_hot bigint, base_hot double, score_hot double, "
        "tokens array<bigint>, numbers array<int>, grams array<bigint>, gram_numbers array<int>"
    )
    rows = settle_down(docs.select("doc_id", "text").mapInArrow(measure, ddl), "lm-rows")
    rare = rows.select("row", F.inline(F.arrays_zip("tokens", "numbers"))).toDF("row", "token", "number")
    looked_up = rare.join(words.where(F.col("count") <= sums.n / HOT_SHARE).hint("shuffle_hash"), "token", "left")
    count = F.coalesce("count", F.lit(0))
    of_rare = looked_up.groupBy(F.col("row").alias("_row")).agg(
        F.sum(F.col("number") * F.log10((count + 0.1) / bottom)).alias("base_rare"),
        F.sum(F.when(count > 0, F.col("number")).otherwise(0)).alias("n_rare"),
    )
    rare_grams = rows.select("row", F.inline(F.arrays_zip("grams", "gram_numbers"))).toDF("row", "gram", "number")
    chances = log_chances(rare_grams.select("gram").distinct(), contexts, shallow)
    of_grams = rare_grams.join(chances.hint("shuffle_hash"), "gram").groupBy(F.col("row").alias("_gram_row"))
    of_grams = of_grams.agg(F.sum(F.col("number") * F.col("log10")).alias("score_rare"))
    plain = rows.drop("tokens", "numbers", "grams", "gram_numbers")
    joined = plain.join(of_rare, F.col("row") == F.col("_row"), "left").join(of_grams, F.col("row") == F.col("_gram_row"), "left")
    return joined.select(
        "doc_id",
        "n_tokens",
        (F.col("n_hot") + F.coalesce("n_rare", F.lit(0))).alias("n_known"),
        F.lit(sums.n).cast("bigint").alias("train_tokens"),
        (F.col("base_hot") + F.coalesce("base_rare", F.lit(0.0))).alias("base_score"),
        (F.col("score_hot") + F.coalesce("score_rare", F.lit(0.0))).alias("score"),
    )
