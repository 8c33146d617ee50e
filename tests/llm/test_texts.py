"""Language id, LM scores, quality rules and fingerprints against brute force."""

import math
import random
from collections import Counter
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest

from duebook.llm import fingerprints, language_id, lm_score, quality
from duebook.llm.rows import in_fold, pinned
from tests.llm.conftest import LONG, ROWS, SCHEMA

WORDS = {
    "aa": ["tor", "melin", "karo", "sante", "vilo"],
    "bb": ["whig", "thrump", "skell", "brock", "dwist"],
    "cc": ["zsaj", "czemi", "przet", "wyrok", "szcze"],
}


def language_rows(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for doc_id in range(n):
        lang = rng.choice(["aa", "aa", "bb", "cc"])
        text = " ".join(rng.choice(WORDS[lang]) + rng.choice(WORDS[lang]) for _ in range(rng.randint(5, 60)))
        rows.append((doc_id, text, lang, "s", len(text)))
    return rows


@pytest.fixture(scope="module")
def languages(spark):
    return spark.createDataFrame(language_rows(300), SCHEMA)


def test_held_out_languages(languages):
    model = language_id.fit(languages.where(~in_fold("doc_id", 5)))
    found = language_id.identify(languages, model).join(languages.select("doc_id", "lang"), "doc_id")
    rows = found.where(in_fold("doc_id", 5)).collect()
    assert len(rows) > 30 and all(r.lang == r.lang_pred and 0 <= r.score <= 1 for r in rows)


def test_codewords_correct_errors():
    for n in (2, 3, 4, 5, 9, 30):
        code = language_id.codewords(n)
        apart = [(code[i] != code[j]).sum() for i in range(n) for j in range(i)]
        assert min(apart) >= max(1, code.shape[1] // 4)
        assert (abs(code.sum(0)) < n).all()


def test_awkward_languages(awkward, empty, languages):
    model = language_id.fit(languages)
    found = language_id.identify(awkward, model).collect()
    assert len(found) == len(ROWS)
    by_id = {r.doc_id: r for r in found}
    for doc_id in (2, 3, 9):
        assert (by_id[doc_id].lang_pred, by_id[doc_id].score, by_id[doc_id].ambiguous) == ("und", 0.0, True)
    assert language_id.fit(empty) is None
    assert {r.lang_pred for r in language_id.identify(awkward, None).collect()} == {"und"}
    assert language_id.identify(empty, model).count() == 0
    only = language_id.fit(languages.where("lang = 'bb'"))
    assert {r.lang_pred for r in language_id.identify(awkward.where("doc_id = 5"), only).collect()} == {"bb"}


def tokens(text):
    return (text or "").encode().lower().split() + [b"\n"]


def brute_base(rows, held_out):
    counts = Counter()
    for doc_id, text, *_ in rows:
        if not held_out(doc_id):
            counts.update(tokens(text))
    total, kinds = sum(counts.values()), len(counts)
    out = []
    for doc_id, text, *_ in rows:
        own = tokens(text)
        base = sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (kinds + 1))) for t in own)
        out.append((doc_id, len(own), sum(counts[t] > 0 for t in own), total, base))
    return out


def check_scores(docs, rows):
    out = lm_score.scores(docs, docs.where(~in_fold("doc_id", 10))).collect()
    held_out = lambda i: crc32(str(i if i is not None else "").encode()) % 10 == 0
    key = lambda r: (r[0] is not None, r[0] or 0, r[4])
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in out), key=key)
    wanted = sorted(brute_base(rows, held_out), key=key)
    assert [g[:4] for g in got] == [w[:4] for w in wanted]
    assert np.allclose([g[4] for g in got], [w[4] for w in wanted])
    return out


def test_base_scores(spark, awkward, languages, empty):
    assert all(r.score < 0 for r in check_scores(awkward, ROWS))
    check_scores(languages, language_rows(300))
    assert lm_score.scores(empty, empty).count() == 0


def test_held_out_scores_beat_the_base(spark):
    rng = random.Random(2)
    # Two kinds of texts with words of their own: what stands before tells which.
    kinds = (["th", "an", "er", "in", "ou"], ["zu", "ke", "wi", "pa", "lo"])
    rows = [
        (i, " ".join("".join(rng.choices(kinds[i % 2], k=2)) for _ in range(150)), "en", "a", 1) for i in range(400)
    ]
    out = check_scores(spark.createDataFrame(rows, SCHEMA), rows)
    held = [r for r in out if crc32(str(r.doc_id).encode()) % 10 == 0]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_tree_is_a_distribution_and_uses_the_longest_suffix(spark):
    texts = [b"abc abc abc " * 50, b"abd "] * 5
    keys = np.concatenate([lm_score.gram_keys(texts)])
    found, number = np.unique(keys, return_counts=True)
    grams = spark.createDataFrame([(int(k), int(n)) for k, n in zip(found, number, strict=True)], "key bigint, n bigint")
    tree = lm_score.grow(lm_score.context_table(grams))
    assert np.allclose((10.0 ** tree.log10.astype(float)).sum(1), 1, atol=1e-4)
    state = 0
    for symbol in b"abc ab":
        state = tree.step[state, symbol]
    assert tree.log10[state, ord("c")] > math.log10(0.9)
    # Segments give what one pass gives.
    long = b"abc abd " * 700
    one = 0.0
    state = 0
    for symbol in bytes([lm_score.END]) * lm_score.DEPTH:
        state = tree.step[state, symbol]
    for symbol in long + bytes([lm_score.END]):
        one += float(tree.log10[state, symbol])
        state = tree.step[state, symbol]
    assert tree.token_scores([long]).sum() == pytest.approx(one)


def test_rare_contexts_are_kept_in_large_corpora(spark):
    pack = lambda gram: int.from_bytes(gram, "big")
    grams = [(pack(b"aaaaaa"), 10**9), (pack(b"vwxyzq"), 60), (pack(b"bwxyzr"), 60), (pack(b"cwxyzs"), 60)]
    contexts = lm_score.context_table(spark.createDataFrame(grams, "key bigint, n bigint"))
    kept = {(r.depth, r.context) for r in lm_score.predicting(contexts).collect()}
    assert {(5, pack(b"vwxyz")), (5, pack(b"bwxyz")), (5, pack(b"cwxyz")), (4, pack(b"wxyz")), (0, 0)} <= kept


@pytest.mark.parametrize("hot", [1_000_000, 40, 1])
def test_scores_are_those_of_the_whole_tree(spark, awkward, monkeypatch, hot):
    monkeypatch.setattr(lm_score, "HOT_GRAMS", hot)  # few grams in the scan: the others are joined
    docs = awkward.select("doc_id", "text").unionByName(spark.createDataFrame(language_rows(60), SCHEMA).selectExpr("100 + doc_id doc_id", "text"))
    training = docs.where(~in_fold("doc_id", 3))
    grams = lm_score.training_counts(training).where(f"kind = {lm_score.GRAMS}").select("key", "n")
    tree = lm_score.grow(lm_score.context_table(grams))
    rows = [(r.doc_id if r.doc_id is not None else -1, r.text or "") for r in docs.collect()]
    wanted = [(i, tree.token_scores(lm_score.normalized(pa.array([text]))).sum()) for i, text in rows]
    got = [(r.doc_id if r.doc_id is not None else -1, r.score) for r in lm_score.scores(docs, training).collect()]
    wanted, got = sorted(wanted), sorted(got)
    assert [i for i, _ in got] == [i for i, _ in wanted]
    assert np.allclose([s for _, s in got], [s for _, s in wanted], rtol=1e-5)


@pytest.mark.xfail(reason="DEPTH symbols do not show how many parts a word has had", strict=True)
def test_held_out_scores_beat_the_base_where_words_share_parts(spark):
    rng = random.Random(2)
    parts = ["th", "an", "er", "ing", "ou", "st", "re", "on", "ly", "ed"]
    rows = [(i, " ".join("".join(rng.choices(parts, k=3)) for _ in range(150)), "en", "a", 1) for i in range(400)]
    out = check_scores(spark.createDataFrame(rows, SCHEMA), rows)
    held = [r for r in out if crc32(str(r.doc_id).encode()) % 10 == 0]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def brute_statistics(text):
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text).split(" ") if w]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = text.split("\n")
    dup = sum(bool(x.strip(" \t\n\x0b\x0c\r")) and x in lines[:i] for i, x in enumerate(lines))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def test_rule_statistics(awkward):
    texts = [r[1] or "" for r in ROWS] + ["a b c a b c a b", "x\nx\n\n\n#<>|\nx", "a a a a", "é\x85é ü\x1cß"]
    for text in texts:
        if text != LONG:
            assert quality.statistics(text)[:5] == brute_statistics(text)
    assert quality.rule_statistics(awkward, "doc_id").count() == len(ROWS)


def quality_rows(n):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(rng.randint(60, 300))]
        bad = i % 30 == 0  # anomalies are rare
        if bad:
            words = [w + rng.choice("#*$%") * 3 for w in words]
        rows.append((i, " ".join(words), "en", "a", 1))
        if i % 3 == 0:
            labels.append((i, int(not bad)))
    return rows, labels


def test_forest_rejects_what_is_anomalous(spark):
    rows, labels = quality_rows(900)
    docs = spark.createDataFrame(rows, SCHEMA)
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int")
    stats = pinned(quality.rule_statistics(docs, "doc_id"))
    judged = quality.judge(stats, quality.fit(stats, marks)).collect()
    rejected = {r.doc_id for r in judged if not r.kept}
    bad = {*range(0, 900, 30)}
    assert len(rejected & bad) >= 20 and len(rejected - bad) <= 9
    assert {r.doc_id for r in quality.keep_good(docs, marks).collect()} == {r.doc_id for r in judged if r.kept}


def test_forest_rejects_short_texts_with_clear_junk(spark):
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(1_200):
        n = rng.choice([55, 90, 400, 2_000])
        words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(n)]
        if i % 30 == 0:
            words[:55] = words[:25] + [w + "#" for w in words[25:55]]
        rows.append((i, " ".join(words[: 55 if i % 30 == 0 else n]), "en", "a", 1))
        if i % 3 == 0:
            labels.append((i, int(i % 30 != 0)))
    stats = pinned(quality.rule_statistics(spark.createDataFrame(rows, SCHEMA), "doc_id"))
    judged = quality.judge(stats, quality.fit(stats, spark.createDataFrame(labels, "doc_id bigint, quality int"))).collect()
    rejected, bad = {r.doc_id for r in judged if not r.kept}, {*range(0, 1_200, 30)}
    assert len(rejected & bad) >= 38 and len(rejected - bad) <= 12


@pytest.mark.xfail(reason="one row in ten of one kind is a cluster, not an anomaly, to a forest", strict=True)
def test_forest_catches_nine_in_ten_at_the_former_bar(spark):
    rng = random.Random(8)
    rows, bad = [], {*range(0, 600, 10)}
    for i in range(600):
        words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(rng.randint(60, 300))]
        rows.append((i, " ".join(w + rng.choice("#*$%") * 3 for w in words) if i in bad else " ".join(words), "en", "a", 1))
    marks = spark.createDataFrame([(i, int(i not in bad)) for i in range(0, 600, 3)], "doc_id bigint, quality int")
    stats = pinned(quality.rule_statistics(spark.createDataFrame(rows, SCHEMA), "doc_id"))
    judged = quality.judge(stats, quality.fit(stats, marks)).collect()
    rejected = {r.doc_id for r in judged if not r.kept}
    assert len(rejected & bad) >= 55 and len(rejected - bad) <= 6


def test_usual_ratios_are_medians_of_all_rows(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, " ".join("a" * rng.randint(1, 9) for _ in range(60)), "en", "a", 1) for i in range(301)]
    stats = pinned(quality.rule_statistics(spark.createDataFrame(rows, SCHEMA), "doc_id"))
    monkeypatch.setattr(quality, "SAMPLE_ROWS", 10)
    counts = np.array([quality.statistics(r[1]) for r in rows])
    failed = quality.base_failed(counts)
    model = quality.fit(stats, spark.createDataFrame([], "doc_id bigint, quality int"))
    assert np.allclose(model.usual, np.median(quality.ratios(counts[~failed]), axis=0), rtol=0.02)


def test_limits_spend_the_allowance_once():
    bad, good = np.zeros((2, 2, quality.SCORE_BINS + 2), np.int64)
    bad[0, [900, 1200]], good[0, [500, 950]] = 10, [998, 2]
    bad[1, [500, 1500]], good[1, [500, 700]] = [15, 5], [997, 3]
    found = np.round(quality.limits(bad, good, 0.005) * quality.SCORE_BINS).astype(int).tolist()
    assert found == [501, 501]
    found = np.round(quality.limits(bad, good, 0.002) * quality.SCORE_BINS).astype(int).tolist()
    assert found == [501, 701]


def test_awkward_quality(spark, awkward, empty):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    kept = quality.keep_good(awkward, none)
    assert kept.columns == awkward.columns and [r.doc_id for r in kept.collect()] == [5]
    assert quality.keep_good(empty, none).count() == 0
    stats = pinned(quality.rule_statistics(awkward, "doc_id"))
    judged = quality.judge(stats, quality.fit(stats, none)).collect()
    assert len(judged) == len(ROWS) and all(r.base_failed != r.kept for r in judged)


def test_expected_path_of_the_forest():
    rows = np.random.default_rng(1).normal(size=(2_000, 2))
    forest = quality.grow(np.vstack([rows, [[9.0, 9.0]]]), seed=2)
    scores = forest.score(np.vstack([rows[:200], [[9.0, 9.0]]]))
    assert scores[-1] > np.quantile(scores[:-1], 0.97) and ((0 < scores) & (scores < 1)).all()


def brute_chosen(spark, text):
    """Selected (hash, position) pairs by the definition; hashes come from Spark."""
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text).split(" ") if w]
    if not words:
        return []
    k = min(fingerprints.GRAM, len(words))
    grams = [words[i : i + k] for i in range(len(words) - k + 1)]
    exprs = []
    for gram in grams:
        expr = f"xxhash64('{gram[0]}')"
        for word in gram[1:]:
            expr = f"xxhash64({expr}, xxhash64('{word}'))"
        exprs.append(f"shiftrightunsigned({expr}, {fingerprints.POSITION_BITS + 1})")
    hashes = spark.sql(f"SELECT array({', '.join(exprs)})").first()[0]
    w = min(fingerprints.WINDOW, len(hashes))
    chosen = []
    for i in range(len(hashes) - w + 1):
        window = hashes[i : i + w]
        low = min(window)
        place = i + max(j for j, h in enumerate(window) if h == low)
        if (low, place) not in chosen:
            chosen.append((low, place))
    return chosen


def test_fingerprints_by_definition(spark):
    rng = random.Random(6)
    texts = [" ".join(rng.choices("abc", k=n)) for n in (1, 2, 3, 4, 10, 11, 40)] + ["", "a a a a a a a a a a a a a a a a"]
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in enumerate(texts)], SCHEMA)
    for row in fingerprints.fingerprints(docs).collect():
        wanted = brute_chosen(spark, texts[row.doc_id])
        assert row.fingerprint == " ".join(f"{h:X}@{p:X}" for h, p in wanted)


def brute_edited(rows):
    least = lambda r: (r[0] is not None, r[0] or 0)
    ordered = sorted(rows, key=least, reverse=True)
    out = []
    for (doc_id, text, *_), following in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        text, other = text or "", following[1] or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + other[:third]
        out.append((doc_id, len(text), sha256(edited.encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is not None, r))


def test_edited_texts(spark, awkward, empty, languages):
    # Rows with one id differ in nothing here, so their order does not show.
    got = fingerprints.edited_pairs(awkward).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=lambda r: (r[0] is not None, r)) == brute_edited(ROWS)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    many = fingerprints.edited_pairs(languages.repartition(9)).collect()
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in many) == brute_edited(language_rows(300))
    assert fingerprints.edited_pairs(empty).count() == 0


def test_fingerprints_stay_native(awkward):
    plan = fingerprints.edited_pairs(awkward)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
