"""Spelling variants: words, near words, forms and roots against plain Python."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from duebook.llm import spelling
from tests.llm.conftest import SCHEMA

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = ("word", "n", "n_near", "form", "form_n", "root")


def plain_words(rows, least=7):
    found = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += len(run) >= least
    return {w: n for w, n in found.items() if n >= 2}


def plain_forms(rows, least=7):
    words = plain_words(rows, least)
    holes = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            holes[w[:i] + "?" + w[i + 1 :]].add(w)
    near = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            near[w] |= holes[w[:i] + "?" + w[i + 1 :]]
            shorter = w[:i] + w[i + 1 :]
            if shorter in words:
                near[w].add(shorter)
                near[shorter].add(w)
    forms = {}
    for w, n in words.items():
        best = min(near[w] - {w}, key=lambda x: (-words[x], x), default=None)
        forms[w] = best if best and words[best] >= 10 * n else None
    out = set()
    for w, n in words.items():
        root = w
        while forms[root]:
            root = forms[root]
        form = forms[w]
        out.add((w, n, len(near[w] - {w}), form, form and words[form], root))
    return out


def found(spark, docs):
    return {tuple(r[c] for c in COLUMNS) for r in spelling.variant_forms(docs).collect()}


@pytest.mark.parametrize("cell_words", [16_384, 400])
def test_given_documents(spark, monkeypatch, cell_words):
    """One cell, and some forty."""
    monkeypatch.setattr(spelling, "CELL_WORDS", cell_words)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert found(spark, docs) == plain_forms(rows)


def test_registered_query(spark):
    import __spark_entry__ as contract

    df = contract.queries()["op12_spelling_variants"](spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert {tuple(r[c] for c in COLUMNS) for r in df.collect()} == plain_forms([tuple(r) for r in docs])


def test_chains_ties_and_long_words(spark):
    giant = "abcdefgh" * 9_000
    words = ["quickest"] * 1_400 + ["quikest"] * 100 + ["quikests"] * 100 + ["quikezt"] * 8
    words += [giant, giant, giant[:-1], giant[:-1]] + ["anagram", "margana"] * 3 + ["÷×áéíóú", "÷×áéíóù"] * 2
    rows = [(i, w) for i, w in enumerate(words)] + [(None, "without id anywhere"), (None, "without id anywhere"), (7, None), (8, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = found(spark, docs)
    assert got == plain_forms(rows)
    assert any(r[0] == giant for r in got)
    assert {r[5] for r in got if r[0] in ("quikezt", "quikest", "quickest")} == {"quickest"}


def test_awkward_and_empty(spark, awkward, empty):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert found(spark, awkward) == plain_forms(rows)
    assert found(spark, empty) == set()
    assert found(spark, spark.createDataFrame([(1, None), (2, " 12 ")], "doc_id bigint, text string")) == set()
    assert SCHEMA.startswith("doc_id")


LETTER = st.sampled_from("abcé÷")


@settings(max_examples=80, deadline=None)
@given(words=st.sets(st.text(LETTER, min_size=1, max_size=7), min_size=1, max_size=60))
def test_near_words_of_a_cell(words):
    names = sorted(words)
    cell = spelling.Cell(pa.array(names, pa.string()), np.arange(len(names)))
    q, w = cell.near(spelling.Words.of(pa.array(names, pa.string())))

    def edits(a):
        shorter = {a[:i] + a[i + 1 :] for i in range(len(a))}
        longer = {a[:i] + c + a[i:] for i in range(len(a) + 1) for c in "abcé÷"}
        return (shorter | longer | {a[:i] + c + a[i + 1 :] for i in range(len(a)) for c in "abcé÷"}) - {a}

    pairs = [*zip(q.tolist(), w.tolist(), strict=True)]
    assert len(pairs) == len(set(pairs))
    assert {(names[a], names[b]) for a, b in pairs} == {(a, b) for a in names for b in edits(a) & words}


@settings(max_examples=40, deadline=None)
@given(texts=st.lists(st.text(st.sampled_from("abcdefGHIJKLéÀ÷ \n.'1ŁĀ"), max_size=200), min_size=1, max_size=6))
def test_words_of_any_text(texts):
    got = spelling.words_of(pa.array(texts, pa.string()), [*range(len(texts))], 7, 31).to_pylist()
    want = []
    for i, text in enumerate(texts):
        for run in RUN.findall(text):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            want += [run] * (len(run) >= 7)
    assert got == want
