"""BPE encoding by forced boundaries, and decoding.

A vocabulary's tokens show which symbols can ever stand side by side inside a token. Where two
neighbouring symbols of a text never do, no merge can join them, whatever stands around: the place is
a certain cut. Fragments between certain cuts are encoded independently, each distinct one once, and
their ids are put in a row again. A symbol is a byte together with whether it ends a word, so ends of
words are certain cuts by the same rule, and a fragment knows whether it ends one.

Texts are cut in two steps. If no token joins white space with anything, a text falls apart at white
space (normalization changes nothing across it); the distinct chunks go through the tokenizer's own
normalization and word splitting. Then the symbols of all their words are cut in one array. Otherwise
a text is one chunk. Tasks need nothing but their rows: no shuffle, and a lost one is simply repeated.

Strings of special tokens inside a text are ordinary text, as in the call in the README of
``public_tokenizers`` (``special_text=False`` gives them their special ids, as the library does when
nothing is set; such texts go through the library as a whole).

Defined results: a null or empty text has no ids and decodes to an empty text; rows without id,
repeated rows and very long texts are encoded like any others; all columns of the caller come back in
the struct ``row``; an empty table gives an empty table.
"""

from __future__ import annotations

import json
import os
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from duebook.llm.batches import IS_SPACE, large, slices, texts_of
from duebook.llm.rows import packed
from duebook.llm.tokens import BYTE_SYMBOLS

#: Fragments and chunks whose ids a Python worker keeps (two generations of half as many each).
CACHED = 600_000
#: A symbol's number is its byte, or its byte plus this at the end of a word.
AT_END = 256
#: Letters below this are composed ones; only their case may change in normalization.
COMPOSED_BELOW = "\u0250"
BYTE_OF = {chr(symbol): byte for byte, symbol in ((b, BYTE_SYMBOLS.get(b, b)) for b in range(256))}


class Kept(dict):
    """A bounded cache: what was not asked for during a whole generation is dropped."""

    def __init__(self, most: int = CACHED):
        super().__init__()
        self.most, self.older = most // 2, {}

    def find(self, keys: list) -> list:
        """What is kept for each key, or None."""
        found = list(map(self.get, keys))
        older = self.older
        for i, value in enumerate(found):
            if value is None and (value := older.get(keys[i])) is not None:
                found[i] = self[keys[i]] = value
        return found

    def turn(self) -> None:
        if len(self) > self.most:
            self.older = dict(self)
            self.clear()


class BoundaryEncoder:
    """Ids of texts by one tokenizer file of byte symbols, and texts of ids."""

    def __init__(self, path: str, special_text: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_text
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        model = json.loads(self.tokenizer.to_str())["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        # Fragments inside a word must not get the suffix that the model adds at a word's end.
        self.inner = BPE(vocab=model["vocab"], merges=merges)
        self.joined = joined_symbols(model["vocab"], self.suffix)
        spaces = np.flatnonzero(np.tile(IS_SPACE, 2))
        alone = not self.joined[spaces].any() and not self.joined[:, spaces].any()
        self.by_chunk = alone and self.tokenizer.normalizer is not None
        # Fewer distinct chunks, where the word splitting parts a letter from a stop in any case.
        words = self.tokenizer.pre_tokenizer.pre_tokenize_str("a.b,c")
        self.stops_alone = self.by_chunk and len(words) == 5
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = [] if special_text else self.special
        self.chunks, self.fragments = Kept(), Kept()
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.tokens = pa.array([self.tokenizer.id_to_token(i) for i in range(size)], pa.string())
        self.decoder = self.tokenizer.decoder

    # Encoding

    def words(self, chunk: str) -> list[bytes]:
        """The chunk's words as bytes, by the tokenizer's own normalization and splitting."""
        tokenizer = self.tokenizer
        if self.by_chunk and chunk.isalpha():
            lower = chunk.lower()
            if max(lower) < COMPOSED_BELOW:  # one word that normalization leaves as it is
                return [lower.encode()]
        text = tokenizer.normalizer.normalize_str(chunk) if tokenizer.normalizer else chunk
        split = tokenizer.pre_tokenizer.pre_tokenize_str(text)
        return [bytes(map(BYTE_OF.__getitem__, word)) for word, _ in split]

    def encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """The ids (uint32 bytes) of each chunk: all words' symbols in one array, cut, encoded."""
        words = [self.words(chunk) for chunk in chunks]
        lengths = np.fromiter((len(w) for ws in words for w in ws), np.int64)
        if not len(lengths):
            return [b""] * len(chunks)
        data = b"".join(w for ws in words for w in ws)
        symbols = np.frombuffer(data, np.uint8).astype(np.int64)
        ends = np.cumsum(lengths)
        if self.suffix:
            symbols[ends - 1] += AT_END
        cut = ~self.joined[symbols[:-1], symbols[1:]]
        cut[ends[:-1] - 1] = True  # also where the vocabulary does not mark ends of words
        stops = np.append(np.flatnonzero(cut) + 1, len(symbols))
        starts = np.append(0, stops[:-1])
        final = symbols[stops - 1] >= AT_END
        pieces = [(data[a:b], f) for a, b, f in zip(starts.tolist(), stops.tolist(), final.tolist(), strict=True)]
        ids = self.encode_fragments(pieces)
        # The fragments of a chunk are those up to the end of its last word.
        last = np.cumsum([sum(map(len, ws)) for ws in words])
        upto = np.searchsorted(stops, last, "right").tolist()
        return [b"".join(ids[a:b]) for a, b in zip([0, *upto], upto, strict=False)]

    def encode_fragments(self, pieces: list[tuple[bytes, bool]]) -> list[bytes]:
        out = self.fragments.find(pieces)
        last, inner, kept = self.tokenizer.model.tokenize, self.inner.tokenize, self.fragments
        for i, ids in enumerate(out):
            if ids is None and (ids := kept.get(pieces[i])) is None:
                text, final = pieces[i]
                symbols = text.decode("latin-1").translate(BYTE_SYMBOLS)
                ids = array("I", [t.id for t in (last if final else inner)(symbols)]).tobytes()
                kept[pieces[i]] = ids
            out[i] = ids
        kept.turn()
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row (uint32), and where each text's ids begin (one more than texts)."""
        pieces = self.pieces(large(texts))
        offsets = pieces.offsets.to_numpy()
        coded = pieces.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        found = self.chunks.find(distinct)
        missing = [i for i, ids in enumerate(found) if ids is None]
        for i, ids in zip(missing, self.encode_chunks([distinct[i] for i in missing]), strict=True):
            found[i] = self.chunks[distinct[i]] = ids
        self.chunks.turn()
        flat = np.frombuffer(b"".join(found), np.uint32)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        starts = np.cumsum(sizes) - sizes
        codes = coded.indices.to_numpy()
        ends = np.cumsum(sizes[codes])
        total = int(ends[-1]) if len(ends) else 0
        place = np.repeat(starts[codes] - (ends - sizes[codes]), sizes[codes]) + np.arange(total)
        ids, before = flat[place], np.append(0, ends)[offsets - offsets[0]]
        if not self.whole:
            return ids, before
        return self.with_special(texts, ids, before)

    def pieces(self, texts: pa.Array) -> pa.LargeListArray:
        if not self.by_chunk:
            return pa.LargeListArray.from_arrays(np.arange(len(texts) + 1), texts)
        if self.stops_alone:
            texts = pc.replace_substring_regex(texts, pattern=r"(\p{L})([,.])", replacement=r"\1 \2")
        return pc.split_pattern(pc.replace_substring_regex(texts, pattern=r"[\t-\r]", replacement=" "), " ")

    def with_special(self, texts: pa.Array, ids: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts that hold a special token's string get the ids of a plain call of the library."""
        parts = [ids[a:b] for a, b in zip(before, before[1:], strict=False)]
        for i, text in enumerate(texts.to_pylist()):
            if any(s in text for s in self.whole):
                parts[i] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        return np.concatenate([np.zeros(0, np.uint32), *parts]), np.append(0, np.cumsum(lengths))

    # Decoding

    def decode(self, ids: np.ndarray, before: np.ndarray) -> pa.Array:
        """The text of each row of ids: tokens joined by spaces, or by the file's byte decoder."""
        if self.decoder is None:
            rows = pa.ListArray.from_arrays(before.astype(np.int32), self.tokens.take(pa.array(ids)))
            return pc.binary_join(rows, " ")
        rows = [ids[a:b].tolist() for a, b in zip(before, before[1:], strict=False)]
        return pa.array(self.tokenizer.decode_batch(rows, skip_special_tokens=False), pa.string())


def joined_symbols(vocabulary: dict[str, int], suffix: str) -> np.ndarray:
    """Which pairs of symbols stand side by side inside any token."""
    joined = np.zeros((2 * AT_END, 2 * AT_END), bool)
    for token in vocabulary:
        final = bool(suffix) and token.endswith(suffix) and token != suffix
        symbols = [BYTE_OF.get(c) for c in (token[: -len(suffix)] if final else token)]
        if None in symbols:
            continue  # not made of byte symbols: a special token
        if final:
            symbols[-1] += AT_END
        joined[symbols[:-1], symbols[1:]] = True
    return joined


@lru_cache(maxsize=4)
def boundary_encoder(path: str, special_text: bool = True) -> BoundaryEncoder:
    """The worker's encoder for a file; it stays with the worker from task to task."""
    return BoundaryEncoder(path, special_text)


def encode(docs: DataFrame, path: str, special_text: bool = True) -> DataFrame:
    """``row`` (the caller's columns) and ``ids`` (array of int) of each document's ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = boundary_encoder(path, special_text)
        for batch in slices(batches):
            ids, before = coder.encode(texts_of(batch))
            lists = pa.ListArray.from_arrays(before.astype(np.int32), ids.astype(np.int32))
            yield pa.record_batch([batch.column("row"), lists], ["row", "ids"])

    rows = packed(docs, text=F.col("text"))
    ids = StructField("ids", ArrayType(IntegerType(), False), False)
    return rows.mapInArrow(run, StructType([rows.schema["row"], ids]))


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``row`` (the caller's columns) and ``decoded``, the text of each row's ids (null: empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = boundary_encoder(path)
        for batch in batches:
            lists = pc.fill_null(batch.column("ids"), [])
            before = np.append(0, np.cumsum(pc.list_value_length(lists).to_numpy(False)))
            text = coder.decode(lists.flatten().to_numpy(False).astype(np.uint32), before)
            yield pa.record_batch([batch.column("row"), text], ["row", "decoded"])

    rows = packed(encoded, ids=F.col(ids).cast("array<int>"))
    return rows.mapInArrow(run, StructType([rows.schema["row"], StructField("decoded", StringType())]))


def round_trip(docs: DataFrame, path: str, special_text: bool = True) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` (little-endian unsigned 32-bit, in a row) and ``decoded`` in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = boundary_encoder(path, special_text)
        for batch in slices(batches):
            ids, before = coder.encode(texts_of(batch))
            raw = pa.py_buffer(np.ascontiguousarray(ids, "<u4"))
            places = pa.py_buffer((4 * before).astype(np.int64))
            packed_ids = pa.Array.from_buffers(pa.large_binary(), len(before) - 1, [None, places, raw])
            columns = {
                "doc_id": batch.column("doc_id"),
                "n_tokens": pa.array(np.diff(before).astype(np.int64)),
                "ids": packed_ids.cast(pa.binary()),
                "decoded": coder.decode(ids, before),
            }
            yield pa.record_batch(columns)

    ddl = "doc_id bigint, n_tokens bigint, ids binary, decoded string"
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, ddl)
