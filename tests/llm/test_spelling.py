"""Spelling variants against brute force."""

import random
import re
from collections import Counter
from zlib import crc32

import pytest
from odd_rows import ODD
from oracle import connect, same
from pyspark.sql import functions as F

from ledgerforge.llm import spelling
from ledgerforge.llm.queries import ORACLES, QUERIES


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(counts, ratio=10):
    """(word, form, root, n, n_near, form_n)."""
    by_skeleton = {}
    for w in counts:
        for k in {w} | {w[:i] + w[i + 1 :] for i in range(len(w))}:
            by_skeleton.setdefault(k, []).append(w)
    met = {w: {x for k in {w} | {w[:i] + w[i + 1 :] for i in range(len(w))} for x in by_skeleton[k] if x != w and near(w, x)} for w in counts}
    form = {}
    for w, others in met.items():
        if others:
            n, best = min((-counts[x], x) for x in others)
            if -n >= ratio * counts[w]:
                form[w] = best
    out = []
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(met[w]), counts[form[w]] if w in form else None))
    return Counter(out)


def words_of(rows):
    c = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({k: k + 32 for k in range(65, 91)})
            h = crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            c[run] += 1
    return {w: n for w, n in c.items() if len(w) >= 7 and n >= 2}


def test_composition():
    random.seed(3)
    for t in range(200):
        letters = "ab" if t % 2 else "abcd"
        words = sorted({"".join(random.choices(letters, k=random.randint(0, 6))) for _ in range(random.randint(1, 60))})
        got = [tuple(sorted(p)) for p in spelling.composed(spelling.Acceptor(words))]
        assert len(got) == len(set(got))
        assert set(got) == {(i, j) for j in range(len(words)) for i in range(j) if near(words[i], words[j])}


def test_the_acceptor_is_minimal():
    machine = spelling.Acceptor(["ab", "abc", "bb", "bbc"])
    assert len(machine.arcs) == 4  # the ends of both are one
    assert machine.words[-1] == 4
    assert spelling.composed(spelling.Acceptor([])) == []


@pytest.mark.parametrize("most", [8, 4096])
def test_variants_against_brute_force(spark, most):
    """With large partitions, and cut again and again."""
    random.seed(most)
    counts = {}
    for _ in range(400):
        w = "".join(random.choices("abcé", k=random.randint(7, 9)))
        counts[w] = random.choice([2, 20, 300, 4000])
        if random.random() < 0.6:
            i = random.randrange(len(w))
            counts[random.choice([w[:i] + w[i + 1 :], w[:i] + "b" + w[i:], w[:i] + "c" + w[i + 1 :]])] = random.choice([2, 20, 21, 300])
    for w in ("aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "aaaaaaab"):
        counts[w] = 10 ** len(w.replace("b", ""))
    counts = {w: n for w, n in counts.items() if len(w) >= 7}
    rows = [*counts.items(), ("short", 100), (None, 5)]
    df = spark.createDataFrame([(w, n, "x", 1) for w, n in rows], "word string, n int, form string, side int")
    assert Counter(map(tuple, spelling.variants(df, most=most).collect())) == brute(counts)


def test_very_long_and_no_words(spark):
    long = "x" * 20_000
    counts = {long: 2, long + "x": 20, long[:-9] + "y" + long[-8:]: 200, "y" + long[1:]: 2000}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {(len(w), n): (None if f is None else len(f), k, fn) for w, f, _, n, k, fn in spelling.variants(df).collect()}
    assert got == {(20_000, 2): (20_000, 3, 2000), (20_001, 20): (None, 1, None), (20_000, 200): (None, 1, None), (20_000, 2000): (None, 1, None)}
    assert spelling.variants(df.limit(0)).count() == 0


def test_typed_words(spark, sf_dir, make):
    docs = make([*ODD, (9, "Wörterbuch WÖRTERBUCH wörterbuch Ärgernis-ärgernis ×÷×÷×÷×", None, None), (10, "wörterbuch Wörterbuch ×÷×÷×÷×", None, None)], clash=["id", "run", "word", "n"])
    assert dict(map(tuple, spelling.typed_words(docs).collect())) == words_of((r["doc_id"], r["text"]) for r in docs.collect())
    assert spelling.typed_words(docs.limit(0)).count() == 0
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert dict(map(tuple, spelling.typed_words(docs).collect())) == words_of((r["doc_id"], r["text"]) for r in docs.collect())


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    got = QUERIES["op12_spelling_variants"](spark, sf_dir)
    assert Counter(map(tuple, got.collect())) == brute(words_of(map(tuple, docs.collect())))
    assert got.where(F.col("form").isNotNull()).count() > 0
    same(got, connect(sf_dir), ORACLES["op12_spelling_variants"])
