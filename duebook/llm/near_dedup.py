"""Near duplicates by a multi-index Hamming join of MinHash signatures, confirmed on full sets.

1. Each text becomes its set of hashed word shingles, a signature of POSITIONS b-bit MinHash values
   and a key of the whole set. Texts with equal sets form one class, so exact copies never meet.
2. The signature is cut into CHUNKS chunks. If two signatures differ in at most
   CHUNKS * (ERRORS + 1) - 1 positions, then some chunk differs in at most ERRORS of its positions
   (pigeonhole). So each class is filed once per chunk and choice of ERRORS positions to leave out,
   under the remaining values: all pairs within that distance meet under some key.
3. Under a key, a class is first compared with the least class only: of all its keys, with the one
   it meets most often, then with others that are not connected yet. Classes that these links
   already connect need no further comparison. In further rounds, the classes outside a key's
   largest component are each compared with one member of it, another one each round, as long as
   that connects a fair share of them. So a group of n near copies costs some n comparisons, not
   n * n. Components only grow, so a key whose classes are all connected is never looked at again.
4. What is left under the other keys is compared with all classes of other components that are near
   enough by signature, set size and sketch. Near classes share many keys, so each pair is made under
   the first key they share only, which their signatures tell; no link between different components
   is lost. Comparisons use the full sets.

A set's sketch tells, for each of some hundred buckets, whether an odd number of its shingles fall
into it. Each shingle that only one of two sets holds turns one bucket, so two sketches never differ
in more buckets than the sets do in shingles: a pair whose sketches differ in too many can't be
linked, and its texts need not be read. Of groups whose members lie just below the similarity that
excludes most pairs, of sets far larger than the sketch none.

At a similarity of 0.8 a position differs with probability 0.2; more than 20 of 42 differ with
probability 5e-6, which is the chance that a link at the very threshold is not guaranteed to meet.

Defined results: a text without words (or null) has no set and is linked with nothing; a row without
an id takes the component of its class and is kept only if that has none; repeated rows are one
class, and rows with the id of the component are all kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from duebook.llm.batches import mixed, slices, texts_of, word_hashes
from duebook.llm.components import components
from duebook.llm.rows import identified, packed, pinned, shuffle_tasks
from duebook.session import broadcast_if_small, remove_folder, scratch_folder, settle_down, with_columns

CHUNKS, CHUNK_POSITIONS, ERRORS = 7, 6, 2
POSITIONS = CHUNKS * CHUNK_POSITIONS
GUARANTEED = CHUNKS * (ERRORS + 1) - 1
#: A round of links to single members is followed by another one if it connects this share of the classes.
FAIR_SHARE = 0.1
#: Comparisons of signatures under one key that one task makes; a key with more is cut into parts.
PART_PAIRS = 1_000_000
KEPT_POSITIONS = list(combinations(range(CHUNK_POSITIONS), CHUNK_POSITIONS - ERRORS))
#: Bits of a signature's value: the values of a chunk fit in one bigint, for comparisons in SQL.
BITS = 10
LANE_TOPS = sum(1 << BITS * i + BITS - 1 for i in range(CHUNK_POSITIONS))
LANE_RESTS = sum((1 << BITS - 1) - 1 << BITS * i for i in range(CHUNK_POSITIONS))

#: The sketch's words of 64 buckets, as columns.
SKETCH = [f"s{i}" for i in range(8)]

#: Multipliers of the MinHash permutations and of the mixing function, drawn once from a fixed seed.
_DRAWN = np.random.default_rng(20_240_501)
FACTORS = _DRAWN.integers(1, 2**63, POSITIONS, np.uint64) * np.uint64(2) + np.uint64(1)
SHIFTS = _DRAWN.integers(0, 2**63, POSITIONS, np.uint64)


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text: ``size`` words, or all if there are fewer."""
    words, starts = word_hashes(texts)
    # The windows at all words at once; those that leave their text are not used.
    windows = _windows(words, size)
    for low, high in zip(starts, starts[1:], strict=False):
        if high - low >= size:
            yield np.unique(windows[low : high - size + 1])
        else:
            yield _windows(words[low:high], high - low)


def _windows(words: np.ndarray, width: int) -> np.ndarray:
    """The hash of each window of ``width`` words."""
    count = max(len(words) - width + 1, 0) if width else 0
    value = np.zeros(count, np.uint64)
    for i in range(width):
        value = mixed(value) + words[i : i + count]
    return mixed(value + np.uint64(width))


def signature(shingles: np.ndarray) -> np.ndarray:
    """POSITIONS values of BITS bits."""
    least = np.full(POSITIONS, np.uint64(2**64 - 1))
    for low in range(0, len(shingles), 8_192):
        part = shingles[low : low + 8_192] * FACTORS[:, None] + SHIFTS[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return (mixed(least) >> np.uint64(64 - BITS)).astype(np.uint16)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """For each bucket one bit: does an odd number of the shingles fall into it?"""
    buckets = 64 * len(SKETCH)
    odd = np.bincount((shingles % np.uint64(buckets)).astype(np.int64), minlength=buckets) % 2
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def measured(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id, text_key, n_shingles, set_key, signature`` and SKETCH of each row; null key: no words."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counts, keys, signatures, sketches = [], [], [], []
            for shingles in shingle_sets(texts_of(batch), size):
                counts.append(len(shingles))
                empty = not len(shingles)
                keys.append(None if empty else xxhash.xxh3_128_digest(shingles.tobytes()))
                signatures.append(None if empty else signature(shingles).tobytes())
                sketches.append(sketch(shingles))
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "text_key": batch.column("text_key"),
                    "n_shingles": pa.array(counts, pa.int64()),
                    "set_key": pa.array(keys, pa.binary()),
                    "signature": pa.array(signatures, pa.binary()),
                    **dict(zip(SKETCH, map(pa.array, np.stack(sketches, axis=1)), strict=True)),
                }
            )

    ddl = "doc_id bigint, text_key bigint, n_shingles bigint, set_key binary, signature binary"
    return identified(docs).mapInArrow(measure, ", ".join([ddl, *(f"{name} bigint" for name in SKETCH)]))


def index_keys(classes: DataFrame) -> DataFrame:
    """``key, choice, class``: one row per class, chunk and choice of positions, which ``choice`` numbers."""
    kept = np.array(KEPT_POSITIONS)
    salt = np.arange(CHUNKS * len(kept), dtype=np.uint64).reshape(CHUNKS, len(kept))

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 2_000) for i in range(0, batch.num_rows, 2_000)):
                values = np.frombuffer(b"".join(part.column("signature").to_pylist()), np.uint16)
                values = values.reshape(-1, CHUNKS, CHUNK_POSITIONS).astype(np.uint64)
                key = np.broadcast_to(salt, (part.num_rows, *salt.shape)).copy()
                for place in range(kept.shape[1]):
                    key = mixed(key) + values[:, :, kept[:, place]]
                owner = np.repeat(part.column("class").to_numpy(), key[0].size)
                choice = np.tile(np.arange(salt.size, dtype=np.int16), part.num_rows)
                columns = [mixed(key).ravel().view(np.int64), choice, owner]
                yield pa.record_batch([pa.array(c) for c in columns], ["key", "choice", "class"])

    return classes.select("class", "signature").mapInArrow(file, "key bigint, choice smallint, class bigint")


class Confirmer:
    """Compares pairs of classes by their full sets, made of texts that it keeps once needed.

    Texts travel, not sets: a set of random hashes takes more room than the text and can't be
    compressed.
    """

    def __init__(self, docs: DataFrame, classes: DataFrame, size: int, percent: int):
        self.docs, self.classes, self.size, self.percent = docs, classes, size, percent
        self.texts: DataFrame | None = None

    def close(self, pairs: DataFrame) -> DataFrame:
        """The rows of ``pairs`` whose classes ``a, b`` may be near by set size, sketch and signature.

        Their texts are at hand from then on.
        """
        columns = pairs.columns
        facts = self.classes.select("class", "signature", "n_shingles", *SKETCH)
        for side in "ab":
            own = facts.select(*(F.col(c).alias(f"{c}_{side}") for c in facts.columns))
            pairs = pairs.join(own, F.col(side) == F.col(f"class_{side}"))

        near = pairs.where(may_be_linked(self.percent))
        return self.at_hand(near.where(distance("signature_a", "signature_b") <= GUARANTEED).select(columns))

    def at_hand(self, near: DataFrame) -> DataFrame:
        """``near``, written once; the texts of its classes ``a, b`` are at hand from then on."""
        near = pinned(near)
        self._fetch(near.select(F.col("a").alias("class")).union(near.select("b")).distinct())
        return near

    def links(self, close: DataFrame) -> DataFrame:
        """The pairs ``a, b`` of ``close`` whose full sets are similar enough."""
        both = close.select("a", "b")
        for side in "ab":
            own = self.texts.select(F.col("class").alias(side), F.col("text").alias(f"text_{side}"))
            both = both.join(own, side)
        size, percent = self.size, self.percent

        def sets(texts: pa.Array) -> list[np.ndarray]:
            coded = texts.dictionary_encode()  # a head's text stands in many rows in turn
            own = list(shingle_sets(coded.dictionary, size))
            return [own[i] for i in coded.indices.to_pylist()]

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text_a"):
                similar = []
                for one, other in zip(sets(batch.column("text_a")), sets(batch.column("text_b")), strict=True):
                    common = len(np.intersect1d(one, other, assume_unique=True))
                    similar.append(100 * common >= percent * (len(one) + len(other) - common))
                yield batch.select(["a", "b"]).filter(pa.array(similar, pa.bool_()))

        return pinned(both.mapInArrow(compare, "a bigint, b bigint"))

    def _fetch(self, needed: DataFrame) -> None:
        if self.texts is not None:
            needed = pinned(needed.join(self.texts.select("class"), "class", "left_anti"))
            if needed.isEmpty():
                return
        # The text of one row of each class in question, by id and text.
        chosen = needed.join(self.classes, "class").select("class", "doc_id", "text_key")
        if self.texts is not None:
            # The first call brings nearly all texts; for the few that follow, texts stay where they are.
            chosen = broadcast_if_small(chosen)
        rows = identified(self.docs)
        same = rows["doc_id"].eqNullSafe(chosen["doc_id"]) & (rows["text_key"] == chosen["text_key"])
        # Copies of the row give the same text more than once.
        found = rows.join(chosen, same).select("class", "text").dropDuplicates(["class"])
        found = settle_down(found, "near-texts")
        self.texts = found if self.texts is None else self.texts.union(found)


def merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``class, root``: the least class that each class can reach, by ``roots`` and further ``links``."""
    found = links
    for side in "ab":
        found = found.join(roots.select(F.col("class").alias(side), F.col("root").alias(f"root_{side}")), side)
    between = found.where("root_a != root_b").select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
    above = components(between).select(F.col("a").alias("root"), F.col("b").alias("_above"))
    return pinned(roots.join(above, "root", "left").select("class", F.coalesce("_above", "root").alias("root")))


class Crowds:
    """The filed rows under keys whose classes lie in different components, as components grow."""

    def __init__(self, shared: DataFrame):
        self.rows, self.folder = shared, None

    def narrow(self, roots: DataFrame) -> DataFrame:
        """``key, choice, class, root, main``: the rows left, with the root of each class and the
        root that most classes under its key have. Earlier results can't be read any more."""
        spark = roots.sparkSession
        placed = self.rows.select("key", "choice", "class").join(roots, "class")
        span = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("n"))
        # Under a key of two classes, the only pair was compared at first.
        open_ = placed.join(span.where("low != high AND n > 2").select("key"), "key")
        folder = scratch_folder(spark, "near-crowds")
        open_.write.parquet(f"{folder}/placed")
        if self.folder:
            remove_folder(spark, self.folder)
        self.rows, self.folder = spark.read.schema(open_.schema).parquet(f"{folder}/placed"), folder
        sizes = self.rows.groupBy("key", "root").agg(F.count("*").alias("n"))
        main = sizes.groupBy("key").agg(
            F.max_by("root", F.struct("n", "root")).alias("main"),
            F.sum("n").alias("classes"),
            (F.sum("n") - F.max("n")).alias("outside"),
        )
        return self.rows.join(main, "key")


def may_be_linked(percent: int) -> Column:
    """Do sizes and sketches leave room for the similarity?

    With d shingles in one set only and n in both sizes together it is (n - d) / (n + d).
    """
    small, large = F.least("n_shingles_a", "n_shingles_b"), F.greatest("n_shingles_a", "n_shingles_b")
    turned = [F.bit_count(F.col(f"{name}_a").bitwiseXOR(F.col(f"{name}_b"))) for name in SKETCH]
    room = (100 - percent) * (F.col("n_shingles_a") + F.col("n_shingles_b"))
    return (100 * small >= percent * large) & ((100 + percent) * sum(turned[1:], turned[0]) <= room)


@F.arrow_udf(IntegerType())
def distance(one: pa.Array, other: pa.Array) -> pa.Array:
    """The positions in which two signatures differ."""
    sides = (np.frombuffer(b"".join(x.to_pylist()), np.uint16).reshape(-1, POSITIONS) for x in (one, other))
    return pa.array(np.not_equal(*sides).sum(axis=1).astype(np.int32))


def with_chunks(classes: DataFrame) -> DataFrame:
    """``classes`` with ``w0, w1, ...``, each chunk of the signature as one bigint, for the signature."""
    names = [f"w{i}" for i in range(CHUNKS)]
    others = [name for name in classes.columns if name != "signature"]

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shifts = np.arange(CHUNK_POSITIONS, dtype=np.int64) * BITS
        for batch in batches:
            values = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint16)
            chunks = (values.reshape(-1, CHUNKS, CHUNK_POSITIONS).astype(np.int64) << shifts).sum(axis=2)
            columns = [*(batch.column(name) for name in others), *(pa.array(c) for c in chunks.T)]
            yield pa.record_batch(columns, [*others, *names])

    schema = with_columns(classes.select(others).schema, ", ".join(f"{name} bigint" for name in names))
    return classes.mapInArrow(turn, schema)


def differing(name: str) -> Column:
    """The top bit of each lane in which the chunks ``name`` of two signatures differ."""
    lanes = F.col(f"{name}_a").bitwiseXOR(F.col(f"{name}_b"))
    full = lanes.bitwiseAND(F.lit(LANE_RESTS)) + F.lit(LANE_RESTS)  # no lane runs over into the next one
    return full.bitwiseOR(lanes).bitwiseAND(F.lit(LANE_TOPS))


def is_first_shared() -> Column:
    """Is the row's choice the first one under which the two signatures meet?

    No earlier chunk has at most ERRORS differing positions, and in the choice's own chunk the
    positions left out are those that differ and then the last ones of the chunk.
    """
    top = [1 << BITS * i + BITS - 1 for i in range(CHUNK_POSITIONS)]
    last, before = top[-1], top[-2]
    earlier = F.lit(True)
    for chunk in range(CHUNKS - 1):
        earlier &= (F.col("chunk") <= chunk) | (F.bit_count(differing(f"w{chunk}")) > ERRORS)
    spare = F.col("omitted").bitwiseXOR(differing("own"))
    fits = spare.isin(0, last, last | before) | ((spare == before) & (F.col("omitted") == (last | before)))
    return fits & earlier


def pairs_across(placed: DataFrame, classes: DataFrame, percent: int | None = None) -> DataFrame:
    """``class_a, class_b``: all pairs under a key that lie in different components and may be near by
    signature, each once; with ``percent``, those that set size and sketch leave room for, too.

    One side of such a pair is outside the key's main component. Where very many pairs meet under
    a key, its outside rows are dealt over parts, each with a copy of the key's rows.
    """
    sized = [] if percent is None else ["n_shingles", *SKETCH]
    compared = classes.select("class", "signature", *sized)
    facts = with_chunks(compared.join(placed.select("class").distinct(), "class", "left_semi"))
    parts = F.ceil(F.col("outside") * F.col("classes") / PART_PAIRS)
    # What a choice stands for: its chunk, and the top bits of the positions left out.
    left_out = [set(range(CHUNK_POSITIONS)) - set(kept) for kept in KEPT_POSITIONS]
    omitted = F.array(*(F.lit(sum(1 << BITS * i + BITS - 1 for i in places)).cast("bigint") for places in left_out))
    chunk = F.floor(F.col("choice") / len(KEPT_POSITIONS)).cast("int")
    own = F.get(F.array(*(f"w{i}" for i in range(CHUNKS))), chunk)
    rows = (
        placed.join(facts, "class")
        .withColumn("parts", F.greatest(parts, F.lit(1)).cast("int"))
        .withColumns({"chunk": chunk, "own": own, "omitted": F.get(omitted, (F.col("choice") % len(KEPT_POSITIONS)).cast("int"))})
    )
    facing = ["class", "root", *sized, "own", *(f"w{i}" for i in range(CHUNKS))]
    # No value is null. Without the tests for nulls the join's condition stays small enough to be compiled.
    own_side, other_side = ([F.coalesce(c, F.lit(0)).alias(f"{c}_{side}") for c in facing] for side in "ab")
    part = F.pmod(F.xxhash64("class"), F.col("parts")).cast("int").alias("part")
    one = rows.where("root != main").select("key", part, "main", "chunk", "omitted", *own_side)
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    other = rows.select("key", every, *other_side)
    n_differing = sum((F.bit_count(differing(f"w{i}")) for i in range(1, CHUNKS)), F.bit_count(differing("w0")))
    # Few bytes make many comparisons: the planner must not join partitions by their bytes.
    tasks = shuffle_tasks(placed.sparkSession)
    one, other = (side.repartition(tasks, "key", "part") for side in (one, other))
    return (
        one.join(other, ["key", "part"])
        .where("root_a != root_b AND (root_b = main OR class_a > class_b)")
        .where(n_differing <= GUARANTEED)
        .where(F.lit(True) if percent is None else may_be_linked(percent))
        .where(is_first_shared())
        .select("class_a", "class_b")
    )


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, text_key, n_shingles, component_id, kept``.

    Texts are linked when their sets of ``size``-word shingles have a Jaccard similarity of at
    least ``percent`` / 100; ``component_id`` is the smallest id that links reach.
    """
    rows = settle_down(measured(docs, size), "near-rows")
    # The class's number: any one that stays; its row: the one whose text stands for the class.
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key"))
    grouped = (
        rows.where("set_key IS NOT NULL")
        .groupBy("set_key")
        .agg(least.alias("least"), F.first("n_shingles").alias("n_shingles"), *(F.first(c).alias(c) for c in ("signature", *SKETCH)))
        .select("set_key", "least.doc_id", "least.text_key", "n_shingles", "signature", *SKETCH)
    )
    classes = settle_down(grouped.withColumn("class", F.monotonically_increasing_id()), "near-classes")

    filed = index_keys(classes)
    heads = filed.groupBy("key").agg(F.min("class").alias("head"), F.count("*").alias("n")).where("n > 1")
    shared = settle_down(filed.join(heads.select("key", "head"), "key"), "near-shared")
    confirmer = Confirmer(docs, classes, size, percent)
    # Each class meets the head that it shares most keys with first, then those heads that lie in
    # other components still: members of a group of copies have many heads in common.
    met = shared.where("class != head").groupBy("class", "head").agg(F.count("*").alias("n"))
    headed = confirmer.close(met.select(F.col("class").alias("a"), F.col("head").alias("b"), "n"))
    nearest = pinned(headed.groupBy("a").agg(F.max_by("b", F.struct("n", -F.col("b"))).alias("b")))
    roots = merged(classes.select("class", F.col("class").alias("root")), confirmer.links(nearest))
    rest = headed.select("a", "b").join(nearest, ["a", "b"], "left_anti")
    for side in "ab":
        rest = rest.join(roots.select(F.col("class").alias(side), F.col("root").alias(f"root_{side}")), side)
    roots = merged(roots, confirmer.links(rest.where("root_a != root_b")))

    crowds, turn = Crowds(shared), 0
    placed = crowds.narrow(roots)
    while True:
        # One member of the key's largest component, another one in each round.
        turn += 1
        order = F.xxhash64(F.lit(turn), "class")
        member = placed.where("root = main").groupBy("key").agg(F.min_by("class", order).alias("b"))
        outside = placed.where("root != main").select("key", F.col("class").alias("a"))
        found = confirmer.links(confirmer.close(outside.join(member, "key").select("a", "b").distinct()))
        connected, left = found.select("a").distinct().count(), outside.select("a").distinct().count()
        if connected:
            roots = merged(roots, found)
            placed = crowds.narrow(roots)
        if connected <= FAIR_SHARE * left:
            break

    # What the rounds did not connect is compared with every class of another component.
    near = pairs_across(placed, classes, percent)
    near = near.select(F.greatest("class_a", "class_b").alias("a"), F.least("class_a", "class_b").alias("b"))
    across = confirmer.at_hand(near.join(headed, ["a", "b"], "left_anti"))
    roots = merged(roots, confirmer.links(across))

    members = classes.select("class", "set_key", "doc_id").join(roots, "class")
    least_id = members.groupBy("root").agg(F.min("doc_id").alias("component"))
    of_set = members.join(least_id, "root").select("set_key", "component")
    component = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return (
        rows.join(of_set, "set_key", "left")
        .select("doc_id", "text_key", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def keep_one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the near duplicates that are not the first of their component."""
    gone = near_duplicates(docs, size, percent).where("NOT kept").select("doc_id", "text_key").distinct()
    rows = packed(docs, _id=F.col("doc_id"), _key=F.xxhash64(F.coalesce("text", F.lit(""))))
    same = F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_key") == F.col("text_key"))
    return rows.join(gone, same, "left_anti").select("row.*")
