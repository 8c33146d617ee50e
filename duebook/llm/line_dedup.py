"""Line deduplication by range-partitioned hashes, with keep bitmaps as the result.

Line hashes are range-partitioned by hash and document and sorted by hash, document (largest
first) and position. Each task streams its rows once: of a hash found in enough documents, the
lines of the first document it meets stay and all others go. A hash may begin in one partition and
end in others, so one that holds a third of all lines is spread over many tasks; for the hashes at
partition borders, one row each says how the whole run looks. The result is a compressed bitmap per
document (bit 1: the line stays); texts are not shuffled to find it.

Defined results: a null or empty text is one empty line, which stays; repeated rows (same id and
text) count as one document and get the same bitmap; rows that share only the id count as one
document when documents are counted; a missing id counts as the smallest one.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from duebook.llm.rows import LOWER, SPACES, UPPER, identified, packed, pinned

#: Keys below this many code points are never dropped; keys in fewer documents neither.
LEAST_LENGTH, LEAST_DOCUMENTS = 20, 3

DROPS = "doc_id bigint, text_key bigint, position int"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACES)), UPPER, LOWER)


def line_rows(docs: DataFrame) -> DataFrame:
    """One row per line that could be dropped: its hash (128 bits), document and position."""
    lines = identified(docs).select(
        "doc_id", "text_key", F.posexplode(F.split("text", "\n")).alias("position", "line")
    )
    keyed = lines.select("doc_id", "text_key", "position", line_key(F.col("line")).alias("key"))
    return keyed.where(F.char_length("key") >= LEAST_LENGTH).select(
        F.xxhash64("key").alias("hash"),
        F.xxhash64(F.lit(1), "key").alias("hash2"),
        "doc_id",
        "text_key",
        "position",
    )


def dropped_lines(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, position`` of each line to drop."""
    down = F.col("doc_id").desc_nulls_last()
    ranged = line_rows(docs).repartitionByRange("hash", "hash2", down)
    ordered = pinned(ranged.sortWithinPartitions("hash", "hash2", down, "text_key", "position"))
    whole, names = border_runs(ordered), ordered.columns

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = keeper = None
        documents = 0
        last: object = None
        waiting: list[tuple] = []  # lines of the second document, until a third one is met
        for batch in batches:
            out: list[tuple] = []
            columns = [batch.column(n).to_pylist() for n in names]
            for hash1, hash2, doc, text_key, position in zip(*columns, strict=True):
                if (hash1, hash2) != run:
                    run, documents, last, waiting = (hash1, hash2), 1, doc, []
                    known = whole.get(run)
                    keeper = known[1] if known else doc
                    if known:  # the whole run's documents count, wherever it began
                        documents = known[0]
                elif doc != last:
                    last = doc
                    if run not in whole:
                        documents += 1
                if doc == keeper:
                    continue
                if documents >= LEAST_DOCUMENTS:
                    out += waiting
                    waiting = []
                    out.append((doc, text_key, position))
                elif run not in whole:
                    waiting.append((doc, text_key, position))
            if out:
                yield pa.record_batch(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int32()), strict=True)],
                    names=["doc_id", "text_key", "position"],
                )

    return ordered.mapInArrow(stream, DROPS)


def border_runs(ordered: DataFrame) -> dict[tuple[int, int], tuple[int, int | None]]:
    """Documents and largest document of each hash that begins or ends a partition.

    At most two hashes per partition, whatever the size of the data.
    """
    ends = ordered.groupBy(F.spark_partition_id()).agg(
        F.min(F.struct("hash", "hash2")).alias("low"), F.max(F.struct("hash", "hash2")).alias("high")
    )
    hashes = ends.select(F.inline(F.array("low", "high"))).distinct()
    counted = (
        ordered.join(F.broadcast(hashes), ["hash", "hash2"], "left_semi")
        .groupBy("hash", "hash2", "doc_id")
        .agg(F.lit(1).alias("one"))
        .groupBy("hash", "hash2")
        .agg(F.count("*").alias("documents"), F.max("doc_id").alias("keeper"))
    )
    return {(r.hash, r.hash2): (r.documents, r.keeper) for r in counted.collect()}


@F.udf(BinaryType())
def keep_bitmap(n_lines: int, dropped: list[int]) -> bytes:
    """Bit i of the packed, compressed bytes is 1 if line i stays; whole bytes, filled with ones."""
    bits = np.ones(-(-n_lines // 8) * 8, np.uint8)
    bits[dropped] = 0
    return zlib.compress(np.packbits(bits, bitorder="little").tobytes(), 1)


def keep_bitmaps(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, n_dropped, bitmap`` for the documents that lose lines.

    ``bitmap`` reaches up to the last line that goes; lines beyond it stay.
    """
    return (
        dropped_lines(docs)
        .groupBy("doc_id", "text_key")
        .agg(F.collect_set("position").alias("positions"))
        .select(
            "doc_id",
            "text_key",
            F.size("positions").cast("bigint").alias("n_dropped"),
            keep_bitmap(F.array_max("positions") + 1, "positions").alias("bitmap"),
        )
    )


@F.udf(StringType())
def kept_text(text: str, bitmap: bytes | None) -> str:
    if bitmap is None:
        return text
    bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), bitorder="little")
    lines = text.split("\n")
    keep = np.ones(len(lines), bool)
    shared = min(len(bits), len(lines))
    keep[:shared] = bits[:shared]
    return "\n".join(line for line, stays in zip(lines, keep.tolist(), strict=True) if stays)


def with_bitmaps(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` in a struct ``row``, with ``text`` (null: empty), ``n_dropped`` and
    ``bitmap`` (both null where no line goes)."""
    text = F.coalesce("text", F.lit(""))
    rows = packed(docs, text=text, _id=F.col("doc_id"), _key=F.xxhash64(text))
    found = keep_bitmaps(docs)
    same = F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_key") == F.col("text_key"))
    return rows.join(found, same, "left").select("row", "text", "n_dropped", "bitmap")


def drop_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the dropped lines gone from ``text``; a null text stays null.

    Another column that counts code points (``n_chars``) is left as it is.
    """
    done = with_bitmaps(docs).withColumn("_kept", kept_text("text", "bitmap"))
    text = F.when(F.col("bitmap").isNull(), F.col("row.text")).otherwise(F.col("_kept"))
    return done.withColumn("row", F.col("row").withField("text", text)).select("row.*")
