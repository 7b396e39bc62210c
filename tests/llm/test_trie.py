"""The prefix trie against brute force."""

import hashlib
import random
from collections import Counter, defaultdict
from zlib import crc32

import pytest
from oracle import connect, same
from pyspark.sql import functions as F

from ledgerforge.llm import trie
from ledgerforge.llm.queries import ORACLES, QUERIES


def brute(convs):
    """Rows of {conv_id: [(role, text), ...]}."""
    members, kids = defaultdict(list), defaultdict(set)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                kids[tuple(turns[: d - 1])].add(tuple(turns[:d]))
    leaves, saved = Counter(), Counter()
    for path, own in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not kids[path]
            saved[path[:d]] += (len(own) - 1) * len(path[-1][1]) if path else 0
    return Counter(
        (
            min(own), len(p), min(members[p[:-1]]) if p else None, len(own), len(kids[p]), leaves[p], saved[p],
            hashlib.sha256(",".join(str(c) for c in sorted(own) if len(convs[c]) == len(p)).encode()).hexdigest(),
        )
        for p, own in members.items()
    )


def rebuilt(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", hashlib.md5((text or "").encode()).hexdigest(), text or ""))
    convs = {c: [(t[2], t[4]) for t in sorted(turns)] for c, turns in convs.items()}
    out = {}
    for c, turns in convs.items():
        h = crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        out[c] = convs.get(base, [])[:h] + turns[h:]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, depth int, digest string")


def of(spark, convs, **kw):
    rows = [(c, d + 1, role, hashlib.md5(t.encode()).hexdigest(), len(t)) for c, turns in convs.items() for d, (role, t) in enumerate(turns)]
    steps = spark.createDataFrame(rows, "conv_id long, depth long, role string, digest string, chars long")
    ids = spark.createDataFrame([(c,) for c in convs], "conv_id long")
    return Counter(map(tuple, trie.prefix_trie(steps, ids, **kw).collect()))


def test_two_fattest(spark):
    rows = [(a, b) for a in range(40) for b in range(a + 1, 40)]
    got = spark.createDataFrame(rows, "a long, b long").select("a", "b", trie.two_fattest(F.col("a"), F.col("b"))).collect()
    assert all(f == max(range(a + 1, b + 1), key=lambda x: x & -x) for a, b, f in got)


@pytest.mark.parametrize("block", [4, 512])
def test_against_brute_force(spark, block):
    """Shared starts, ends inside an edge and at a fork, copies, a chain of forks, units over several blocks."""
    random.seed(block)
    convs, n = {}, 0
    for _ in range(120):
        start = random.choice(list(convs.values())) if convs and random.random() < 0.7 else []
        turns = start[: random.randint(0, len(start))] + [(random.choice("ua"), random.choice(["", "a", "bb", "ccc"])) for _ in range(random.randint(0, 12))]
        convs[n] = turns
        n += random.choice([1, 7])
    long = [("u", str(i)) for i in range(40)]
    for k in range(0, 41, 3):
        convs[n + k] = long[:k] + [("u", "off")] * (k % 2)
    assert of(spark, convs, block=block) == brute(convs)


def test_odd_rows(spark):
    rows = [
        (None, 1, "user", "lost"), (100, None, None, None), (100, 2, "user", "é\U0001f600"), (100, 2, "user", "é\U0001f600"), (100, 1, "", ""), (150, 1, "user", "own"), (-5, 3, "user", "x"), (-5, None, "user", "x"),
        (0, 1, "a", "first"), (0, 2, "b", "second"), (0, 3, "c", "third"), (0, 4, "d", "4th"), (0, 5, "e", "5th"), (0, 6, "f", "6th"), (777, 1, "user", "w " * 50_000), (777, 2, "user", "b"),
    ] + [(c, t, "user", f"turn {t}") for c in range(1, 40) for t in range(c % 8)]
    got = trie.prefix_trie(*trie.rebuilt(frame(spark, rows)))
    assert Counter(map(tuple, got.collect())) == brute(rebuilt(rows))
    assert trie.prefix_trie(*trie.rebuilt(frame(spark, []))).count() == 0
    assert of(spark, {3: [], 5: []}) == brute({3: [], 5: []})


def test_long_conversations(spark):
    """Over the size of a block and of a piece, and one that is a start of the other."""
    convs = {1: [("u", str(i % 7)) for i in range(200)], 2: [("u", str(i % 7)) for i in range(128)], 3: [("u", str(i % 7)) for i in range(90)] + [("a", "z")]}
    assert of(spark, convs, block=64) == brute(convs)


def test_query(spark, sf_dir):
    got = QUERIES["op11_prefix_trie"](spark, sf_dir)
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert Counter(map(tuple, got.collect())) == brute(rebuilt(map(tuple, rows)))
    same(got, connect(sf_dir), ORACLES["op11_prefix_trie"])
