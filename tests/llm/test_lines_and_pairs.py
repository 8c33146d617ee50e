"""Line and near dedup against brute force."""

import random
import zlib

import numpy as np
from pyspark.sql.functions import expr

from duebook.llm import line_dedup, near_dedup
from duebook.llm.components import components
from tests.llm.conftest import LINE, ROWS, SCHEMA

SPACES = " \t\n\x0b\x0c\r"


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute_lines(rows):
    """Text without dropped lines, for each row of (doc_id, text)."""
    holders = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            key = lowered(line.strip(SPACES))
            if len(key) >= 20:
                holders.setdefault(key, set()).add(doc_id)
    least = lambda i: (i is not None, i or 0)
    keeper = {k: max(v, key=least) for k, v in holders.items() if len(v) >= 3}
    out = []
    for doc_id, text in rows:
        if text is None:
            out.append((doc_id, None))
            continue
        lines = [x for x in text.split("\n") if keeper.get(lowered(x.strip(SPACES)), doc_id) == doc_id]
        out.append((doc_id, "\n".join(lines)))
    return out


def order(rows):
    return sorted(rows, key=lambda r: [(x is not None, x) for x in r])


def test_awkward_lines(awkward):
    out = line_dedup.drop_lines(awkward)
    assert out.columns == awkward.columns
    got = [(r.doc_id, r.text) for r in out.collect()]
    assert order(got) == order(brute_lines([(r[0], r[1]) for r in ROWS]))


def test_hot_line_over_many_partitions(spark):
    rng = random.Random(4)
    common = [f"common line number {i} with words" for i in range(5)]
    rows = []
    for doc_id in range(600):
        lines = [rng.choice(common) if rng.random() < 0.6 else f"own line {doc_id} {i} of this text" for i in range(6)]
        rows.append((doc_id, "\n".join(lines), "en", "a", 1))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(7)
    got = [(r.doc_id, r.text) for r in line_dedup.drop_lines(docs).collect()]
    assert order(got) == order(brute_lines([(r[0], r[1]) for r in rows]))


def test_bitmap_is_of_whole_text(awkward):
    row = line_dedup.with_bitmaps(awkward).where("row.doc_id = 7").first()
    bits = np.unpackbits(np.frombuffer(zlib.decompress(row.bitmap), np.uint8), bitorder="little")
    assert row.n_dropped == 2 and bits[:3].tolist() == [0, 1, 0]
    assert LINE not in line_dedup.kept_text.func(row.text, row.bitmap)


def test_no_lines(empty):
    assert line_dedup.drop_lines(empty).count() == 0


def brute_components(rows, size, percent):
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        width = min(size, len(words))
        sets.append({tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return [(doc_id, len(sets[i]), least.get(root(i))) for i, (doc_id, _) in enumerate(rows)]


def near_rows(seed, n):
    rng = random.Random(seed)
    words = [f"v{i}" for i in range(400)]
    rows, texts = [], []
    for doc_id in range(n):
        if texts and rng.random() < 0.7:
            own = list(texts[0] if rng.random() < 0.5 else rng.choice(texts))
            for _ in range(rng.randint(0, 9)):
                own[rng.randrange(len(own))] = rng.choice(words)
        else:
            own = [rng.choice(words) for _ in range(rng.randint(60, 120))]
        texts.append(own)
        rows.append((doc_id, " ".join(own)))
    return rows


def test_near_groups(spark):
    rows = near_rows(3, 220)
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], SCHEMA).repartition(5)
    for size, percent in ((2, 80), (5, 80)):
        got = [(r.doc_id, r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(docs, size, percent).collect()]
        assert sorted(got) == sorted(brute_components(rows, size, percent))


def test_awkward_pairs(awkward):
    got = near_dedup.near_duplicates(awkward, 2, 80).collect()
    assert order([(r.doc_id, r.n_shingles, r.component_id) for r in got]) == order(brute_components([(r[0], r[1]) for r in ROWS], 2, 80))
    kept = near_dedup.keep_one_of_each(awkward, 2, 80)
    assert kept.columns == awkward.columns
    assert [r.doc_id for r in kept.where("doc_id IN (1, 10)").collect()] == [1]
    assert kept.where("doc_id IS NULL").count() == 1


def test_no_pairs(empty):
    assert near_dedup.near_duplicates(empty).count() == 0


def test_signatures_within_the_guarantee_meet(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**16, near_dedup.POSITIONS).astype(np.uint16)
    rows = [(0, bytearray(base.tobytes()))]
    for i in range(1, 200):
        other = base.copy()
        wrong = rng.choice(near_dedup.POSITIONS, near_dedup.GUARANTEED, replace=False)
        other[wrong] ^= np.uint16(1 + i)
        rows.append((i, bytearray(other.tobytes())))
    keys = near_dedup.index_keys(spark.createDataFrame(rows, "class bigint, signature binary"))
    own = keys.where("class = 0").select("key").distinct()
    assert keys.join(own, "key").select("class").distinct().count() == 200


def test_each_pair_across_is_made_once(spark, monkeypatch):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << near_dedup.BITS, near_dedup.POSITIONS)
    rows = []
    for i in range(150):
        values = base.copy()
        wrong = rng.choice(near_dedup.POSITIONS, rng.integers(0, 26), replace=False)
        values[wrong] = rng.integers(0, 1 << near_dedup.BITS, len(wrong))
        rows.append((i, bytearray(values.astype(np.uint16).tobytes()), 10))
    classes = spark.createDataFrame(rows, "class bigint, signature binary, n_shingles bigint")
    monkeypatch.setattr(near_dedup, "PART_PAIRS", 50)
    facts = {"root": "class % 40", "main": "3L", "classes": "150L", "outside": "140L"}
    placed = near_dedup.index_keys(classes).withColumns({name: expr(sql) for name, sql in facts.items()})
    got = sorted(tuple(sorted((r.class_a, r.class_b))) for r in near_dedup.pairs_across(placed, classes).collect())
    signatures = np.array([np.frombuffer(bytes(r[1]), np.uint16) for r in rows])
    apart = (signatures[:, None] != signatures[None]).sum(axis=2)
    pairs = [(i, j) for i in range(150) for j in range(i + 1, 150) if i % 40 != j % 40]
    assert got == [p for p in pairs if apart[p] <= near_dedup.GUARANTEED]


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 540)] + [(3, 1), (1, 2), (7, 7)]
    found = components(spark.createDataFrame(links, "a bigint, b bigint"))
    got = {r.a: r.b for r in found.collect()}
    assert got == {**{i: 100 for i in range(101, 161)}, **{i: 500 for i in range(501, 540)}, 2: 1, 3: 1}


def test_sketches_exclude_no_link():
    rng = np.random.default_rng(8)
    for n in (1, 3, 40, 700, 5_000):
        one = np.unique(rng.integers(0, 2**64, n, np.uint64, endpoint=False))
        for changed in {0, 1, n // 20, n // 5, n}:
            other = np.unique(np.concatenate([one[changed:], rng.integers(0, 2**64, changed // 2, np.uint64, endpoint=False)]))
            turned = np.unpackbits((near_dedup.sketch(one) ^ near_dedup.sketch(other)).view(np.uint8)).sum()
            assert turned <= len(np.setxor1d(one, other))


def test_groups_just_below_the_similarity(spark):
    """Members share a text but for some words each: similar to none or to few others."""
    rng = random.Random(6)
    shared = [f"w{i}" for i in range(120)]
    rows = []
    for doc_id in range(160):
        own = list(shared)
        for place in rng.sample(range(120), rng.choice((2, 6, 7, 8))):
            own[place] = f"own{doc_id}x{place}"
        rows.append((doc_id, " ".join(own)))
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], SCHEMA).repartition(6)
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(docs, 2, 80).collect()]
    assert sorted(got) == sorted(brute_components(rows, 2, 80))
