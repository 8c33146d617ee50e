"""Token ids in files of Simple-8b words, in document order, and the way back.

A file set is a folder with two Parquet tables. ``ranks`` holds one row: the tokenizer's ids ordered by
frequency in all documents, so that frequent ids get small numbers. ``chunks`` holds one row per
run of whole documents: which part it belongs to and its number there, the ids before it in the
part, the documents' ids and token counts, the words, and the word where each block begins. Parts
are ranges of the documents' order; a part is written by one task as a stream. Texts are encoded once;
their ids, of two bytes where the vocabulary allows, are what is counted, shuffled and packed.

Defined results: a null or empty text is the end token alone; rows without id come first; rows with
equal ids are ordered by a hash of the text; repeated rows are written once each.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duebook.llm import simple8b
from duebook.llm.batches import slices, texts_of
from duebook.llm.rows import identified
from duebook.llm.tokens import encoder
from duebook.session import settle_down

#: Bytes of ids that make a chunk.
CHUNK_BYTES = 2 << 20

CHUNKS_DDL = (
    "part int, chunk int, before bigint, doc_ids array<bigint>, n_tokens array<bigint>, "
    "block_starts array<int>, words binary"
)


def id_type(vocabulary: int) -> np.dtype:
    return np.dtype("<u2" if vocabulary <= 1 << 16 else "<u4")


def id_rows(docs: DataFrame, tokenizer: str, kind: np.dtype) -> DataFrame:
    """``doc_id``, ``text_key`` and the text's ids in a row, written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, size=4 << 20):
            ids, starts = encoder(tokenizer).encode(texts_of(batch))
            places = pa.py_buffer((starts * kind.itemsize).astype(np.int32))
            raw = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, places, pa.py_buffer(ids.astype(kind))])
            yield pa.record_batch([batch.column("doc_id"), batch.column("text_key"), raw], ["doc_id", "text_key", "ids"])

    coded = identified(docs).mapInArrow(run, "doc_id bigint, text_key bigint, ids binary")
    return settle_down(coded, "token-ids")


def ids_of(batch: pa.RecordBatch, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a batch in a row, and where each row's begin."""
    lengths = pc.binary_length(batch.column("ids")).to_numpy().astype(np.int64)
    flat = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column("ids")), b"")
    ids = np.frombuffer(flat[0].as_buffer(), kind)
    return ids, np.append(0, np.cumsum(lengths // kind.itemsize))


def frequency_order(coded: DataFrame, end_id: int, vocabulary: int) -> np.ndarray:
    """Ids by falling frequency in all documents; the vocabulary bounds what reaches the driver."""
    kind = id_type(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            if batch.num_rows:
                total += np.bincount(ids_of(batch, kind)[0], minlength=vocabulary)
        seen = np.flatnonzero(total)
        yield pa.record_batch({"id": pa.array(seen), "n": pa.array(total[seen])})

    counted = coded.select("ids").mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    counts = np.zeros(vocabulary, np.int64)
    for row in counted.collect():
        counts[row.id] = row.n
    counts[end_id] = counts.max() + 1
    return np.argsort(-counts, kind="stable").astype(np.int32)


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int, vocabulary: int) -> None:
    """Encode every text, append ``end_id``, and write the file set below ``folder``."""
    spark = docs.sparkSession
    kind = id_type(vocabulary)
    coded = id_rows(docs, tokenizer, kind)
    order = frequency_order(coded, end_id, vocabulary)
    table = spark.createDataFrame([(order.tolist(),)], "ids array<int>")
    table.write.parquet(f"{folder}/ranks")
    rank = np.empty(vocabulary, np.uint64)
    rank[order] = np.arange(vocabulary)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, number = TaskContext.get().partitionId(), 0, 0
        for batch in slices(batches, "ids", CHUNK_BYTES):
            ids, starts = ids_of(batch, kind)
            # One end token behind each document.
            ends = starts[1:] + np.arange(len(starts) - 1)
            values = np.empty(len(ids) + len(ends), np.uint64)
            is_end = np.zeros(len(values), bool)
            is_end[ends] = True
            values[is_end] = rank[end_id]
            values[~is_end] = rank[ids]
            words, blocks = simple8b.encode(values)
            yield pa.record_batch(
                {
                    "part": pa.array([part], pa.int32()),
                    "chunk": pa.array([number], pa.int32()),
                    "before": pa.array([before], pa.int64()),
                    "doc_ids": pa.array([batch.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                    "n_tokens": pa.array([np.diff(starts) + 1], pa.list_(pa.int64())),
                    "block_starts": pa.array([blocks], pa.list_(pa.int32())),
                    "words": pa.array([words.tobytes()], pa.binary()),
                }
            )
            before += len(values)
            number += 1

    place = [F.col("doc_id").asc_nulls_first(), F.col("text_key").asc()]
    ordered = coded.repartitionByRange(*place).sortWithinPartitions(*place)
    written = ordered.select("doc_id", "ids").mapInArrow(write, CHUNKS_DDL)
    written.write.option("compression", "zstd").parquet(f"{folder}/chunks")


def read_token_files(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` (and ``ids``) of each document, from the files."""
    chunks = spark.read.schema(CHUNKS_DDL).parquet(f"{folder}/chunks")
    order = np.array(spark.read.parquet(f"{folder}/ranks").first().ids, np.uint32)
    total = F.col("before") + F.aggregate("n_tokens", F.lit(0).cast("bigint"), lambda s, n: s + n)
    parts = chunks.groupBy("part").agg(F.max(total).alias("ids")).orderBy("part").collect()  # a row per part
    offset, so_far = {}, 0
    for part in parts:
        offset[part.part] = so_far
        so_far += part.ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i] for n in batch.schema.names}
                counts = np.array(row["n_tokens"].as_py(), np.int64)
                blocks = np.array(row["block_starts"].as_py(), np.int64)
                words = np.frombuffer(row["words"].as_py(), np.uint64)
                ids = order[simple8b.decode(words, blocks, int(counts.sum())).astype(np.int64)]
                borders = np.concatenate([[0], np.cumsum(counts)])
                own = [ids[a:b] for a, b in zip(borders, borders[1:], strict=False)]
                first = offset[row["part"].as_py()] + row["before"].as_py()
                out = {
                    "doc_id": pa.array(row["doc_ids"].as_py(), pa.int64()),
                    "start": pa.array(first + borders[:-1], pa.int64()),
                    "n_tokens": pa.array(counts),
                    "ids_crc32": pa.array([zlib.crc32(x.tobytes()) for x in own], pa.int64()),
                }
                if with_ids:
                    out["ids"] = pa.array([x.view(np.int32) for x in own], pa.list_(pa.int32()))
                yield pa.record_batch(out)

    ddl = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    return chunks.mapInArrow(read, ddl)
