"""Token ids of many texts through a tokenizer file, with each distinct piece encoded once.

A text is cut at places where the tokenizer's own pre-tokenizer always has a border, so the ids
of a text are the ids of its pieces in a row. Pieces repeat a lot; their ids are kept in a bounded
cache of the Python worker. ``tests/llm/test_tokens.py`` holds the result against plain encoding.
"""

from __future__ import annotations

import os
import unicodedata
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from duebook.llm.batches import large

#: Pieces whose ids a Python worker keeps (two generations of half as many each).
CACHE_PIECES = 800_000
#: Pieces in one call of the tokenizer.
AT_ONCE = 4_000
#: By byte: space and line end, signs of ASCII, letters of ASCII, all that ASCII shows.
_BYTES = np.arange(256)
IS_GAP = np.isin(_BYTES, [0x20, 0x0A])
IS_SHOWN = (_BYTES > 0x20) & (_BYTES < 0x7F)
IS_LETTER = np.isin(_BYTES, [*range(0x41, 0x5B), *range(0x61, 0x7B)])
IS_SIGN = IS_SHOWN & ~IS_LETTER & ~np.isin(_BYTES, range(0x30, 0x3A))
#: Letters up to here are the same in all versions of Unicode in use; later blocks have grown.
OLD_LETTERS = 0x530
_KINDS = [unicodedata.category(chr(i))[0] for i in range(1 << 16)]
IS_WORD = np.isin(_KINDS, ["L", "N"])
IS_OLD_LETTER = np.isin(_KINDS, ["L"]) & (np.arange(1 << 16) < OLD_LETTERS)
#: Byte-level vocabularies write each byte as one character: printable ones of Latin-1 as they
#: are, the others from U+0100 on in ascending order.
_PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
BYTE_SYMBOLS = dict(zip((b for b in range(256) if b not in _PRINTABLE), range(0x100, 0x200)))
SYMBOLS = [chr(BYTE_SYMBOLS.get(b, b)) for b in range(256)]
SPACE = SYMBOLS[0x20]


def cut_at_bytes(texts: pa.Array) -> pa.LargeListArray:
    """The pieces of large ``texts`` that begin at offset 0: views of the same bytes, cut before a
    space or line end that follows a letter, a number or what ASCII shows, and between a letter and a
    sign of ASCII. Characters of four bytes are never cut behind."""
    borders = np.frombuffer(texts.buffers()[1], np.int64)[: len(texts) + 1]
    raw = texts.buffers()[2] or pa.py_buffer(b"")
    data = np.frombuffer(raw, np.uint8)[: borders[-1]]
    begins = np.zeros(len(data) + 1, bool)
    if len(data):
        gap, sign = IS_GAP[data[1:]], IS_SIGN[data[1:]]
        begins[1:-1] = gap & IS_SHOWN[data[:-1]] | sign & IS_LETTER[data[:-1]]
        # The character before, from its last bytes.
        at = np.flatnonzero((gap | sign) & (data[:-1] >= 0x80))
        last, middle, first = (data[at - i].astype(np.int32) for i in range(3))
        code = np.where(middle >= 0xC0, (middle & 0x1F) << 6, (first & 0x0F) << 12 | (middle & 0x3F) << 6) | last & 0x3F
        short = (middle >= 0xC0) | (first >= 0xE0)
        begins[at + 1] = short & np.where(gap[at], IS_WORD[code], IS_OLD_LETTER[code])
    begins[borders] = True
    starts = np.flatnonzero(begins)
    pieces = pa.Array.from_buffers(pa.large_string(), len(starts) - 1, [None, pa.py_buffer(starts), raw])
    return pa.LargeListArray.from_arrays(pa.array(np.searchsorted(starts, borders)), pieces)


class PieceEncoder:
    """Ids by one tokenizer file. Special tokens' strings in a text are ordinary text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.drops_space = self.tokenizer.normalizer is not None
        self.fresh: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def pieces(self, texts: pa.Array) -> pa.LargeListArray:
        if self.drops_space:
            # White space separates and vanishes; a letter never joins a full stop or comma.
            lower = pc.replace_substring_regex(
                pc.ascii_lower(texts), pattern=r"(\p{L})([,.])", replacement=r"\1 \2"
            )
            return pc.split_pattern(
                pc.replace_substring_regex(lower, pattern=r"[\t-\r]", replacement=" "), " "
            )
        return cut_at_bytes(texts)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row (uint32), and where each text's ids begin (one more than texts)."""
        pieces = self.pieces(large(texts))
        offsets = pieces.offsets.to_numpy()
        coded = pieces.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        known = self._ids(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        flat = np.frombuffer(b"".join(known), np.uint32)
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        starts = np.cumsum(sizes) - sizes
        codes = coded.indices.to_numpy()
        of_code = sizes[codes]
        ends = np.cumsum(of_code)
        total = int(ends[-1]) if len(ends) else 0
        place = np.repeat(starts[codes] - (ends - of_code), of_code) + np.arange(total)
        before = np.concatenate([[0], ends])
        return flat[place], before[offsets - offsets[0]]

    def _ids(self, pieces: list[str]) -> list[bytes]:
        fresh, older = self.fresh, self.older
        found = list(map(fresh.get, pieces))
        missing = [i for i, ids in enumerate(found) if ids is None]
        if older and missing:
            unseen = []
            for i in missing:
                ids = found[i] = older.get(pieces[i])
                if ids is None:
                    unseen.append(i)
                else:
                    fresh[pieces[i]] = ids
            missing = unseen
        for i, ids in zip(missing, self._encode([pieces[i] for i in missing]), strict=True):
            found[i] = fresh[pieces[i]] = ids
        if len(fresh) > CACHE_PIECES // 2:
            self.older, self.fresh = fresh, {}
        return found

    def _encode(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces: words of letters go straight to the model, others the whole way."""
        out: list[bytes] = [b""] * len(pieces)
        other = []
        tokenize = self.tokenizer.model.tokenize
        for i, piece in enumerate(pieces):
            letters = piece if self.drops_space else piece[piece[:1] == " " :]
            if letters.isalpha() and (not self.drops_space or self._is_normal(letters)):
                if piece.isascii():  # letters stand for themselves, and only the first may be a space
                    symbols = piece if letters is piece else SPACE + letters
                else:
                    symbols = "".join(map(SYMBOLS.__getitem__, piece.encode()))
                out[i] = array("I", [t.id for t in tokenize(symbols)]).tobytes()
            else:
                other.append(i)
        for low in range(0, len(other), AT_ONCE):
            some = other[low : low + AT_ONCE]
            whole = self.tokenizer.encode_batch([pieces[i] for i in some], add_special_tokens=False)
            for i, one in zip(some, whole, strict=True):
                out[i] = array("I", one.ids).tobytes()
        return out

    @staticmethod
    def _is_normal(word: str) -> bool:
        """Does the tokenizer's normalization (NFC, lower case) leave the word as it is?"""
        return word == word.lower() and (word.isascii() or unicodedata.is_normalized("NFC", word))


@lru_cache(maxsize=4)
def encoder(path: str) -> PieceEncoder:
    """The worker's encoder for a file; it stays with the worker from task to task."""
    return PieceEncoder(path)
