"""Mixing, packing, sharding and the pipeline."""

import os
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as contract
from duebook.llm import mixing, packing, sharding
from duebook.llm.rows import UPPER  # noqa: F401  (the module has to import alone)
from tests.llm.conftest import ROWS, SCHEMA

WORD_BPE = str(public_tokenizers.path("word_bpe_49k.json"))
FOLDER = "/root/testdata/sf0.001"


def source_rows(counts):
    rows, doc_id = [], 0
    for source, n in counts.items():
        for _ in range(n):
            rows.append((doc_id, f"text {doc_id}", "en", source, 1))
            doc_id += 1
    return rows


def weights_of(spark, weights):
    return spark.createDataFrame([*weights.items()], "source string, weight double")


def edf(tickets, cycle):
    """The schedule of one cycle, slot by slot."""
    done, order = [0] * len(tickets), []
    for slot in range(cycle):
        due = [
            (-(-(done[i] + 1) * cycle // a), i) for i, a in enumerate(tickets) if done[i] * cycle // a <= slot
        ]
        chosen = min(due)[1]
        done[chosen] += 1
        order.append(chosen)
    return order


def test_schedule_is_earliest_deadline_first(spark):
    tickets = [333, 250, 1, 17, 399]
    rows = [(f"s{i}", i, a, 1000) for i, a in enumerate(tickets)]
    shares = spark.createDataFrame(rows, "source string, number int, tickets int, cycle int")
    plan = mixing.schedule(shares).orderBy("slot").collect()
    assert [r.number for r in plan] == edf(tickets, 1000)
    done = Counter()
    for r in plan:
        assert r.turn == done[r.number]
        done[r.number] += 1
        for i, a in enumerate(tickets):  # less than one block from the exact share
            assert abs(done[i] - (r.slot + 1) * a / 1000) < 1


def test_mix_follows_the_weights(spark):
    docs = spark.createDataFrame(source_rows({"a": 3000, "b": 2000, "c": 1000}), SCHEMA).repartition(6)
    out = mixing.mixed_order(docs, weights_of(spark, {"a": 0.2, "b": 0.5, "c": 0.3})).orderBy("position").collect()
    assert [r.position for r in out] == list(range(6000))
    assert len({r.doc_id for r in out}) == 6000
    block, so_far = mixing.BLOCK_ROWS, Counter()
    for i, r in enumerate(out[: 3000], 1):  # no source is dry yet
        so_far[r.source] += 1
        if i % block == 0:
            for source, weight in (("a", 0.2), ("b", 0.5), ("c", 0.3)):
                assert abs(so_far[source] - weight * i) < block * 1.01 + i / 500
    again = mixing.mixed_order(docs.repartition(3), weights_of(spark, {"a": 0.2, "b": 0.5, "c": 0.3}))
    assert {(r.doc_id, r.position) for r in again.collect()} == {(r.doc_id, r.position) for r in out}


def test_tickets(spark):
    sources = spark.createDataFrame([("a",), ("b",), (None,), ("d",)], "source string")
    got = {r.source: r.tickets for r in mixing.tickets(sources, weights_of(spark, {"a": 3.0, "b": 1.0, "x": 9.0, "d": -1.0})).collect()}
    assert sum(got.values()) == mixing.CYCLE and got[None] == 1 and got["d"] == 1
    assert abs(got["a"] - 750) <= 2
    even = {r.tickets for r in mixing.tickets(sources, weights_of(spark, {})).collect()}
    assert even == {250}


def test_awkward_mix(awkward, empty):
    out = mixing.mix(awkward, mixing.tempered_weights(awkward))
    assert out.columns == awkward.columns and out.count() == len(ROWS)
    assert mixing.mix(empty, mixing.tempered_weights(empty)).count() == 0
    order = mixing.mixed_order(awkward, mixing.tempered_weights(awkward))
    assert sorted(r.position for r in order.collect()) == list(range(len(ROWS)))
    plan = order._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def check_packing(rows, pieces, limits=packing.Limits()):
    tokenizer = Tokenizer.from_file(WORD_BPE)
    tokenizer.encode_special_tokens = True
    wanted = Counter()
    for doc_id, text, *_ in rows:
        wanted[doc_id, tuple([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1])] += 1
    sequences, parts = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p.length == len(p.ids) > 0
        assert p.ids_crc32 == zlib.crc32(np.array(p.ids, np.uint32).tobytes())
        sequences[p.sequence_id].append(p)
        parts[p.doc_id, p.doc_tokens].append(p)
    for own in sequences.values():
        own.sort(key=lambda p: p.offset)
        place = 0
        for p in own:
            assert p.offset == place
            place += p.length
        assert place <= limits.tokens and len(own) <= limits.segments
    found = Counter()
    for (doc_id, total), own in parts.items():
        by_start = defaultdict(list)
        for p in own:
            by_start[p.start].append(p)
        copies = len(by_start[0])
        for _ in range(copies):
            ids = []
            while len(ids) < total:
                ids += by_start[len(ids)].pop().ids
            found[doc_id, tuple(ids)] += 1
    assert found == wanted
    return {i: sum(p.length for p in own) for i, own in sequences.items()}


def test_awkward_packing(awkward, empty):
    check_packing(ROWS, packing.pack_documents(awkward, WORD_BPE, 1).collect())
    assert packing.pack_documents(empty, WORD_BPE, 1).count() == 0


def test_little_padding(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(["alpha", "beta", "gamma", "delta"], k=int(rng.paretovariate(1) * 60) % 5000 + 1)), "en", "a", 1) for i in range(700)]
    sizes = check_packing(rows, packing.pack_documents(spark.createDataFrame(rows, SCHEMA).repartition(3), WORD_BPE, 1).collect())
    padded = sum(2048 - n for n in sizes.values() if n & (n - 1))
    assert padded <= 0.01 * sum(sizes.values())


@pytest.mark.parametrize("limits", [packing.Limits(), packing.Limits(tokens=256, segments=5, loss=100)])
def test_tails_of_very_short_texts_keep_all_limits(spark, limits):
    rng = random.Random(4)
    rows = [(i, " ".join(["alpha"] * rng.choice([0, 0, 0, 1, 2, 20])), "en", "a", 1) for i in range(2_000)]
    pieces = packing.pack_documents(spark.createDataFrame(rows, SCHEMA).repartition(4), WORD_BPE, 1, limits).collect()
    sizes = check_packing(rows, pieces, limits)
    assert max(sizes.values()) <= limits.loss


def test_examples_stay_whole_under_three_limits(spark):
    rng = random.Random(9)
    rows = [(i, n := rng.randint(1, 900), rng.randint(0, n)) for i in range(800)] + [(900, 5000, 10), (901, 0, 0), (902, None, None)]
    limits = packing.Limits(tokens=2048, segments=5, loss=900)
    out = packing.pack_examples(spark.createDataFrame(rows, "example_id bigint, n_tokens bigint, n_loss bigint"), limits).collect()
    assert sorted(r.example_id for r in out) == sorted(r[0] for r in rows)
    sequences = defaultdict(list)
    for r in out:
        sequences[r.sequence_id].append(r)
    for own in sequences.values():
        if len(own) > 1:
            assert sum(r.n_tokens for r in own) <= 2048 and sum(r.n_loss for r in own) <= 900 and len(own) <= 5
    least = max(sum(r[1] or 0 for r in rows) / 2048, sum(r[2] or 0 for r in rows) / 900, len(rows) / 5)
    assert len(sequences) <= 1.25 * least + 8


def test_ring_bounds_and_movement(spark):
    rows = [(i, f"text {i}" if i % 3 else "the same text", "en", "a", 1) for i in range(3001)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    out = sharding.shard_rows(docs, 8).collect()
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
        text = rows[r.doc_id][1].encode()
        assert (r.size, r.text_crc32) == (len(text) + 1, zlib.crc32(text))
    assert len(out) == 3001 and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    # With slack, most rows stay on the shard that the plain ring gives them.
    loose = {r.doc_id: r.shard for r in sharding.shard_rows(docs.where("doc_id % 3 != 0"), 8, slack=0.25).collect()}
    more = {r.doc_id: r.shard for r in sharding.shard_rows(docs.where("doc_id % 3 != 0"), 9, slack=0.25).collect()}
    assert sum(loose[i] != more[i] for i in loose) < 0.4 * len(loose)


def test_overflow_goes_clockwise():
    ring = sharding.Ring(3, 4)
    placed = sharding.placements(ring, [(0, arc, 30 if arc == 2 else 1) for arc in range(12)])
    loads = Counter()
    for runs in placed.values():
        for rows, shard, _ in runs:
            loads[shard] += rows
    assert sorted(loads.values()) == [13, 14, 14]
    assert placed[0, 2][0][1] == ring.owner[2]


def test_awkward_shards(awkward, empty):
    out = sharding.shard_rows(awkward, 8).collect()
    assert len(out) == len(ROWS) and {r.doc_id: r.size for r in out}[3] == 1
    assert sharding.shard_rows(empty, 8).count() == 0


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_stages_act_on_what_came_before(spark, folder):
    import corpus_pipeline

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, FOLDER).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        assert docs.columns == columns
        counts.append(docs.count())
        assert docs.where("n_chars != char_length(text)").count() == 0
    total, good, lines, near, mixed = counts
    assert total > good == lines > near == mixed
    rows = docs.select("doc_id", "text").collect()
    check_packing([(r.doc_id, r.text) for r in rows], corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect())


def test_all_are_registered():
    names = [n for n in contract.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11)) and "pipeline" in contract.queries()
