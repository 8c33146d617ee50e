"""Cached pieces give the ids of plain encoding; Simple-8b and token files give back what went in."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from duebook.llm import simple8b, token_files
from duebook.llm.tokens import encoder
from tests.llm.conftest import ROWS

FILES = {name: str(public_tokenizers.path(name)) for name in ("word_bpe_49k.json", "byte_bpe_50k.json")}


def plain(name, texts):
    tokenizer = Tokenizer.from_file(FILES[name])
    tokenizer.encode_special_tokens = True
    return [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def pieced(name, texts):
    ids, starts = encoder(FILES[name]).encode(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(starts, starts[1:], strict=False)]


@pytest.mark.parametrize("name", FILES)
def test_awkward_texts(name):
    texts = [r[1] or "" for r in ROWS] + ["a  b \n\n c  d", "don't,stop.", "É́", "́x y", "tab\tnew\r\nline", "a.b,c 1,000.50"]
    assert pieced(name, texts) == plain(name, texts)


@pytest.mark.parametrize("name", FILES)
@settings(max_examples=60, deadline=None)
@given(texts=st.lists(st.text(alphabet=st.sampled_from("abÉéß.,' \n\t ́‍12\x01—Σς!<>|"), max_size=30), min_size=1, max_size=5))
def test_any_text(name, texts):
    assert pieced(name, texts) == plain(name, texts)


def test_signs_are_pieces_of_their_own():
    """A word and the signs behind it repeat more often apart than together."""
    texts = ["one two&&& two### l'été!", "don't {two}; 3% a_b [x]^2 one|two"]
    name = "byte_bpe_50k.json"
    found = encoder(FILES[name]).pieces(pa.array(texts, pa.large_string())).to_pylist()
    assert found[0] == ["one", " two", "&&&", " two", "###", " l", "'été", "!"]
    assert pieced(name, texts) == plain(name, texts)


def test_texts_are_cut_where_their_bytes_tell():
    """No mark is written between pieces, so no character keeps a text from being cut."""
    texts = ["one\x01two three four", "", "Жук где-то 한국 말 e\u0301 x 5² 7", "😀 a\u00a0 b\n\nc", None, "ab, c"]
    name = "byte_bpe_50k.json"
    found = encoder(FILES[name]).pieces(pa.array([t or "" for t in texts], pa.large_string())).to_pylist()
    assert found[0] == ["one\x01two", " three", " four"]
    assert found[1] == []
    assert found[2] == ["Жук", " где", "-то", " 한국", " 말", " e\u0301 x", " 5²", " 7"]
    assert found[3] == ["😀 a\u00a0 b", "\n\nc"]
    assert found[5] == ["ab", ",", " c"]
    assert pieced(name, [t or "" for t in texts]) == plain(name, [t or "" for t in texts])


@settings(max_examples=60, deadline=None)
@given(values=st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60_000), st.integers(0, 2**64 - 1)), max_size=700))
def test_simple8b_round_trip(values):
    array = np.array(values, np.uint64)
    words, blocks = simple8b.encode(array)
    assert simple8b.decode(words, blocks, len(array)).tolist() == values
    assert len(blocks) - 1 == -(-len(values) // simple8b.BLOCK)


def test_simple8b_is_tight_for_small_values():
    words, _ = simple8b.encode(np.ones(256, np.uint64))
    assert len(words) == 5  # 60 to a word


def test_token_files(spark, awkward, folder):
    path = FILES["byte_bpe_50k.json"]
    token_files.write_token_files(awkward, folder, path, 0, 50_257)
    found = token_files.read_token_files(spark, folder).orderBy("start").collect()
    assert [r.doc_id for r in found] == sorted((r[0] for r in ROWS), key=lambda i: (i is not None, i))
    start = 0
    by_id = {}
    for row in found:
        assert row.start == start and row.n_tokens == len(row.ids)
        assert row.ids_crc32 == zlib.crc32(np.array(row.ids, np.uint32).tobytes())
        start += row.n_tokens
        by_id.setdefault(row.doc_id, []).append(row.ids)
    for doc_id, text, *_ in ROWS:
        assert plain("byte_bpe_50k.json", [text or ""])[0] + [0] in by_id[doc_id]


def test_no_documents(spark, empty, folder):
    token_files.write_token_files(empty, folder, FILES["byte_bpe_50k.json"], 0, 50_257)
    assert token_files.read_token_files(spark, folder).count() == 0
