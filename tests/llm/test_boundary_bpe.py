"""Forced boundaries give the library's ids; decoding gives its texts."""

import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from duebook.llm import boundary_bpe
from tests.llm.conftest import ROWS

FILES = {name: str(public_tokenizers.path(name)) for name in ("word_bpe_49k.json", "byte_bpe_50k.json")}
WORDS = FILES["word_bpe_49k.json"]
AWKWARD = [
    "a  b \n\n c  d", "don't,stop. it's 'll'sabc ?'s", "É́", "́x y", "tab\tnew\r\nline", "a.b,c 1,000.50",
    "", "ΣΑΣ İstanbul ȺB x y", "qzxjkq zzzzqqq", "end <|endoftext|> next", "\u0085 x", "a" * 3_000 + "é" * 3_000,
]


def plain(name, special_text=True):
    tokenizer = Tokenizer.from_file(FILES[name])
    tokenizer.encode_special_tokens = special_text
    return tokenizer


def check(name, texts, special_text=True):
    coder, tokenizer = boundary_bpe.boundary_encoder(FILES[name], special_text), plain(name, special_text)
    ids, starts = coder.encode(pa.array(texts, pa.string()))
    decoded = coder.decode(ids, starts).to_pylist()
    for text, a, b, back in zip(texts, starts, starts[1:], decoded, strict=False):
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert ids[a:b].tolist() == want, text[:50]
        assert back == tokenizer.decode(want, skip_special_tokens=False)
    assert len(decoded) == len(texts)


@pytest.mark.parametrize("name", FILES)
@pytest.mark.parametrize("special_text", [True, False])
def test_awkward_texts(name, special_text):
    check(name, AWKWARD + [r[1] or "" for r in ROWS], special_text)
    check(name, [], special_text)


@pytest.mark.parametrize("name", FILES)
@settings(max_examples=80, deadline=None)
@given(texts=st.lists(st.text(st.sampled_from("abzqxjÉéß.,' \n\t́‍12\x01—Σς!<>|"), max_size=40), min_size=1, max_size=5))
def test_any_text(name, texts):
    check(name, texts)


def test_cuts_are_certain():
    """No token of the vocabulary joins a pair that is a cut, and many pairs are cuts."""
    coder = boundary_bpe.boundary_encoder(WORDS)
    assert coder.joined.mean() < 0.05
    for token in [*plain("word_bpe_49k.json").get_vocab(with_added_tokens=False)][:5_000]:
        final = token.endswith("</w>") and token != "</w>"
        symbols = [boundary_bpe.BYTE_OF[c] for c in (token[:-4] if final else token)]
        symbols[-1] += boundary_bpe.AT_END * final
        assert all(coder.joined[a, b] for a, b in zip(symbols, symbols[1:], strict=False)), token


def test_caches_stay_bounded(monkeypatch):
    kept = boundary_bpe.Kept(10)
    for i in range(40):
        assert kept.find([i]) == [None]
        kept[i] = i
        kept.turn()
        assert len(kept) <= 6 and kept.find([i]) == [i]


def test_encode_and_decode(spark, awkward, empty):
    coded = boundary_bpe.encode(awkward, WORDS)
    back = boundary_bpe.decode(coded, WORDS).select("row.row.doc_id", "row.row.text", "row.ids", "decoded", "row.row.shard")
    tokenizer = plain("word_bpe_49k.json")
    rows = back.collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r[0]) for r in ROWS)
    for r in rows:
        assert r.ids == tokenizer.encode(r.text or "", add_special_tokens=False).ids
        assert r.decoded == tokenizer.decode(r.ids, skip_special_tokens=False) and r.shard == "own shard"
    assert boundary_bpe.encode(empty, WORDS).count() == 0
    assert boundary_bpe.decode(spark.createDataFrame([(1, None)], "id int, ids array<int>"), WORDS).first().decoded == ""


def test_registered_query(spark):
    import __spark_entry__ as contract

    folder = "/root/testdata/sf0.001"
    found = {r.doc_id: r for r in contract.queries()["op11_boundary_bpe"](spark, folder).collect()}
    tokenizer = plain("word_bpe_49k.json")
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert len(found) == len(docs)
    for doc_id, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        r = found[doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()
