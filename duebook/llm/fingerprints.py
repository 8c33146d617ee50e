"""Document fingerprints by winnowing, in DataFrame functions only.

The words of a text give rolling hashes of GRAM words; from each window of WINDOW hashes the least
is selected, the rightmost of equal ones. Selected hashes keep their positions. Any run of
GRAM + WINDOW - 1 words that two texts share gives them a common selected hash; shorter texts select
their least hash.

A selected gram is one number: 39 bits of hash above 24 bits that fall with its position, so that the
plain least number is the least hash at the rightmost position. (Positions count modulo 2^24.)

Defined results: a null or empty text, or one of white space alone, selects nothing and is like
another such text with likeness 1 and like any other with 0; of rows with equal ids the one with the larger
text hash comes first; rows without id come last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duebook.llm.rows import SPACE_CLASS, identified, shuffle_tasks

GRAM, WINDOW = 3, 8
POSITION_BITS = 24
LAST_POSITION = (1 << POSITION_BITS) - 1


def _from(array: str, shift: int) -> Column:
    """The array without its first ``shift`` values."""
    return F.slice(array, 1 + shift, F.greatest(F.size(array) - shift, F.lit(0)))


def _whole_runs(array: str, length: int) -> Column:
    """As many values as there are runs of ``length`` in the array; one if it is shorter."""
    runs = F.greatest(F.size(array) - (length - 1), F.least(F.size(array), F.lit(1)))
    return F.slice(array, 1, runs)


def _packed(value: Column, place: Column) -> Column:
    hashed = F.shiftleft(F.shiftrightunsigned(value, POSITION_BITS + 1), POSITION_BITS)
    return hashed.bitwiseOR(F.lit(LAST_POSITION) - place.cast("bigint").bitwiseAND(F.lit(LAST_POSITION)))


def with_selected(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add ``name``: the grams of ``text`` selected by winnowing, each once, in order.

    Each step is a column of its own, so that Spark evaluates it once.
    """
    words = F.filter(F.split(text, f"{SPACE_CLASS}+"), lambda w: w != "")
    df = df.withColumn("_words", F.transform(words, lambda w: F.xxhash64(w)))
    df = df.withColumn("_run", F.col("_words"))
    for shift in range(1, GRAM):  # each word's hash, joined with those of the words behind it
        join = lambda a, b: F.when(b.isNull(), a).otherwise(F.xxhash64(a, b))
        df = df.withColumn("_run", F.zip_with("_run", _from("_words", shift), join))
    df = df.withColumn("_run", F.transform(_whole_runs("_run", GRAM), _packed))
    df = df.withColumn("_least", F.col("_run"))
    width = 1
    while width < WINDOW:  # the least of 2, 4, ... grams; WINDOW is a power of two
        df = df.withColumn("_least", F.zip_with("_least", _from("_least", width), lambda a, b: F.least(a, b)))  # skips nulls
        width *= 2
    return df.withColumn(name, F.array_distinct(_whole_runs("_least", WINDOW))).drop("_words", "_run", "_least")


def hash_set(chosen: Column) -> Column:
    return F.array_distinct(F.transform(chosen, lambda p: F.shiftright(p, POSITION_BITS)))


def written(chosen: Column) -> Column:
    """Hash and position of each selected gram as text: ``hash@position``, hexadecimal."""
    position = lambda p: F.lit(LAST_POSITION) - p.bitwiseAND(F.lit(LAST_POSITION))
    return F.concat_ws(" ", F.transform(chosen, lambda p: F.concat(F.hex(F.shiftright(p, POSITION_BITS)), F.lit("@"), F.hex(position(p)))))


def likeness(one: Column, other: Column) -> Column:
    """Common hashes among all hashes of two sets."""
    common = F.size(F.array_intersect(one, other))
    every = F.size(one) + F.size(other) - common
    return F.when(every == 0, 1.0).otherwise(common / every).cast("double")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, n_chars, chosen, fingerprint`` of each row."""
    rows = with_selected(identified(docs), "text", "chosen")
    return rows.select("doc_id", "text_key", F.char_length("text").cast("bigint").alias("n_chars"), "chosen", written(F.col("chosen")).alias("fingerprint"))


def in_ranges(rows: DataFrame, name: str) -> DataFrame:
    """Add ``range``: 0, 1, ... by falling ``doc_id``, about equally many rows each; no id: last.

    The cut points are quantiles, as many as make a range small against a task's memory; a row
    finds its range by a binary search over them.
    """
    ids = rows.agg(F.count("*").alias("n")).first().n
    steps = max(4 * shuffle_tasks(rows.sparkSession), ids // 20_000)
    depth = max(1, (steps - 1).bit_length())
    fractions = [i / 2**depth for i in range(1, 2**depth)]
    cuts = rows.agg(F.percentile_approx("doc_id", fractions, 20 * 2**depth)).first()[0]
    if not cuts:
        return rows.withColumn(name, F.lit(0))
    table = F.array(*map(F.lit, cuts)) if len(cuts) <= 64 else F.from_json(F.lit("[" + ",".join(map(str, cuts)) + "]"), "array<bigint>")
    halves = F.array(*(F.lit(2**k) for k in reversed(range(depth))))
    below = F.aggregate(
        halves, F.lit(0), lambda low, half: F.when(F.get(table, low + half - 1) < F.col("doc_id"), low + half).otherwise(low)
    )
    return rows.withColumn(name, F.when(F.col("doc_id").isNull(), 2**depth).otherwise(2**depth - 1 - below).cast("int"))


def with_next(docs: DataFrame) -> DataFrame:
    """``doc_id, text, chosen, next_text, next_chosen``: each document beside the next one.

    The next one is that with the next smaller id; after the last comes the first. Texts move once, to
    ranges of ids. The first document of each range also goes to the range before it.
    """
    ranged = in_ranges(identified(docs), "_range")
    down = [F.col("doc_id").desc_nulls_last(), F.col("text_key").desc()]
    firsts = (
        ranged.groupBy("_range")
        .agg(F.max(F.struct(F.col("doc_id").isNotNull(), "doc_id", "text_key")).alias("first"))
        .select("_range", F.col("first.doc_id").alias("first_id"), F.col("first.text_key").alias("first_key"))
    )
    # One row per range. The range before it; for the first range, the last one.
    previous = F.lag("_range").over(Window.orderBy("_range"))
    last = F.max("_range").over(Window.partitionBy())
    ends = firsts.select(F.col("_range").alias("_own"), "first_id", "first_key", F.coalesce(previous, last).alias("_before"))
    same = (F.col("_own") == F.col("_range")) & F.col("first_id").eqNullSafe(F.col("doc_id")) & (F.col("first_key") == F.col("text_key"))
    beside = ranged.join(F.broadcast(ends), same, "left")
    copies = F.when(F.col("_before").isNull(), F.array(F.struct(F.col("_range"), F.lit(False).alias("_guest"))))
    copies = copies.otherwise(
        F.array(F.struct(F.col("_range"), F.lit(False).alias("_guest")), F.struct(F.col("_before").alias("_range"), F.lit(True).alias("_guest")))
    )
    spread = beside.select("doc_id", "text", "text_key", F.inline(copies))
    placed = with_selected(spread.repartitionByRange(shuffle_tasks(docs.sparkSession), "_range"), "text", "chosen")
    inside = Window.partitionBy("_range").orderBy("_guest", *down)
    out = placed.withColumns({"next_text": F.lead("text").over(inside), "next_chosen": F.lead("chosen").over(inside)})
    return out.where("NOT _guest").drop("_range", "_guest")


def edited_pairs(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text, and how like they are.

    The edited text has the last third of its code points replaced by as many from the start of the next
    document. Columns: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``.
    """
    length = F.char_length("text")
    third = F.floor(length / 3).cast("int")
    edited = F.concat(F.left("text", length - third), F.left("next_text", third))
    rows = with_next(docs).select(
        "doc_id", length.cast("bigint").alias("n_chars"), edited.alias("edited"), "chosen", "next_chosen"
    )
    rows = with_selected(rows, "edited", "edited_chosen")
    sets = {f"_{c}": hash_set(F.col(c)) for c in ("chosen", "edited_chosen", "next_chosen")}
    return rows.withColumns(sets).select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        written(F.col("chosen")).alias("fingerprint"),
        written(F.col("edited_chosen")).alias("edited_fingerprint"),
        likeness(F.col("_chosen"), F.col("_edited_chosen")).alias("near_edited"),
        likeness(F.col("_chosen"), F.col("_next_chosen")).alias("near_next"),
    )
