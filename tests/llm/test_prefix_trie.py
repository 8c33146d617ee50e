"""The conversation prefix trie against plain Python, whole and in its parts."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from duebook.llm import prefix_trie

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def plain_trie(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        leader = c - (c % 100 if c >= 0 else -(-c % 100))
        built[c] = tuple(own.get(leader, [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    sums = {}
    for node in sorted(members, key=len, reverse=True):
        below = [sums[k] for k in children[node]]
        leaves = sum(x[0] for x in below) or 1
        points = len(node[-1][1]) if node else 0
        sums[node] = (leaves, sum(x[1] for x in below) + (len(members[node]) - 1) * points)
    out = []
    for node, convs in members.items():
        ends = sorted(c for c in convs if len(built[c]) == len(node))
        sha = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        parent = min(members[node[:-1]]) if node else None
        out.append((min(convs), len(node), parent, len(convs), len(children[node]), *sums[node], sha))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def made(seed, convs, longest):
    rnd = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(rnd.randint(1, longest)):
            rows.append((c * rnd.choice([1, 1, 7]) - 40, t, rnd.choice("ua"), rnd.choice(["x", "hello", "bye, then"])))
    # An id that came up twice has turns of equal number; they stay apart by number here.
    seen = defaultdict(int)
    out = []
    for c, _, role, text in rows:
        out.append((c, seen[c], role, text))
        seen[c] += 1
    return out


@pytest.mark.parametrize("band", [3, 8])
def test_small_tries(spark, band):
    rows = made(band, 120, 10)
    rows += [(1_000 + c, t, "u", "same") for c in range(60) for t in range(4)]  # many end at one node
    rows += [(5_000, t, "u", f"turn {t % 3}") for t in range(90)]  # many turns in one conversation
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(prefix_trie.prefix_trie(df, band)) == plain_trie(rows)


def test_registered_query(spark):
    import __spark_entry__ as contract

    folder = "/root/testdata/sf0.01"
    df = contract.queries()["op13_prefix_trie"](spark, folder)
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(df) == plain_trie(rows)


def test_awkward_rows(spark):
    rows = [
        (0, None, None, None), (0, 1, "u", "a" * 100_000), (0, 2, None, ""), (1, 5, "u", "x"), (1, 7, None, "y"),
        (None, 1, "u", "nobody's"), (2, 0, "u", "r"), (2, 1, "u", "r"), (2, 2, "u", "r"), (299, 0, "u", "alone"),
        (-5, 0, "u", "below"), (-105, 0, "ü", "😀"), (-100, 0, "u", "lead"), (7, 3, "u", "é"), (2**60, 0, "u", "far"),
    ]
    df = spark.createDataFrame([(*r, "own", 3) for r in rows], SCHEMA + ", depth string, a int")
    assert found(prefix_trie.prefix_trie(df)) == plain_trie(rows)


def test_repeated_rows_and_ties(spark):
    rows = [(3, 1, "u", "same")] * 9 + [(9, None, "u", "same")] * 4 + [(9, 2, "a", "z")]
    assert found(prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == plain_trie(rows)
    tied = spark.createDataFrame([(3, 1, "u", x) for x in "abcabc"], SCHEMA)
    one = found(prefix_trie.prefix_trie(tied))
    assert one == found(prefix_trie.prefix_trie(tied.repartition(5))) and len(one) >= 1


def test_no_conversations(spark):
    assert found(prefix_trie.prefix_trie(spark.createDataFrame([], SCHEMA))) == []
    assert found(prefix_trie.prefix_trie(spark.createDataFrame([(None, 1, "u", "x")], SCHEMA))) == []
