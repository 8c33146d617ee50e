"""Helpers for Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Text handled at once inside a task. It bounds the memory of a Python worker, except that a
#: single longer text is always handled whole.
SLICE_BYTES = 2 << 20
#: Bytes up to which words are hashed in whole arrays.
LONG_WORD = 64
#: Multiplier of the mixing function, white space by byte, and masks for the first 0 to 8 bytes.
MIX = np.uint64(0x9E3779B97F4A7C15)
IS_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def slices(
    batches: Iterator[pa.RecordBatch], text: str = "text", size: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in pieces of about ``size`` bytes of ``text``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(False)
        piece = np.cumsum(lengths.astype(np.int64)) // size
        borders = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
        for low, high in zip(borders, borders[1:], strict=False):
            if high > low:
                yield batch.slice(low, high - low)


def texts_of(batch: pa.RecordBatch, text: str = "text") -> pa.Array:
    """The text column with nulls as empty strings."""
    return pc.fill_null(batch.column(text), "")


def large(texts: pa.Array) -> pa.Array:
    """A copy with 64-bit offsets, so that lists of pieces of many texts can't overflow.

    It begins at offset 0: ``ascii_lower`` misplaces the bytes of a sliced large array.
    """
    empty = pa.array([], pa.large_string())
    return pa.concat_arrays([empty, texts.cast(pa.large_string())])


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    values = (values ^ (values >> np.uint64(32))) * MIX
    values = (values ^ (values >> np.uint64(29))) * MIX
    return values ^ (values >> np.uint64(32))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in a row, and where each text's words begin (one more than texts).

    Words are found and hashed in whole arrays: blocks of 8 bytes are read at each word's place and
    mixed in one after the other. Words of more than LONG_WORD bytes are hashed one by one.
    """
    lower = pc.ascii_lower(large(texts))
    borders = np.frombuffer(lower.buffers()[1], np.int64)[lower.offset : lower.offset + len(lower) + 1]
    raw = lower.buffers()[2]
    data = np.zeros(borders[-1] + 8, np.uint8)  # room to read 8 bytes at the last word's place
    if borders[-1]:
        data[:-8] = np.frombuffer(raw, np.uint8)[: borders[-1]]
    inside = ~IS_SPACE[data[:-8]]
    edge = np.zeros(len(data) - 7, bool)
    edge[borders] = True
    begins = inside & np.concatenate([[True], ~inside])[:-1] | inside & edge[:-1]
    stops = np.concatenate([~inside, [True]])[1:] | edge[1:]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(inside & stops) + 1
    lengths = ends - starts

    blocks = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    hashes = mixed(lengths.astype(np.uint64))
    left = np.flatnonzero(lengths <= LONG_WORD)
    for done in range(0, LONG_WORD, 8):
        left = left[lengths[left] > done]
        if not len(left):
            break
        rest = np.minimum(lengths[left] - done, 8)
        hashes[left] = mixed(hashes[left] + (blocks[starts[left] + done] & MASKS[rest]) * MIX)
    for i in np.flatnonzero(lengths > LONG_WORD):
        hashes[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]])
    return hashes, np.searchsorted(starts, borders)
