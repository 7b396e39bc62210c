"""Near-duplicate vectors against brute force."""

import math
from collections import Counter

import numpy as np
import pytest
from oracle import connect, same

from ledgerforge.llm import vectors
from ledgerforge.llm.queries import ORACLES, QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, u string, e int"


def brute(rows, least=0.95):
    """(vec_id, n_links, component_id) of each row."""
    ok = [i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v) for i, v in rows]
    found = [[] for _ in rows]
    for a in range(len(rows)):
        for b in range(a):
            if ok[a] and ok[b] and len(rows[a][1]) == len(rows[b][1]):
                x, y = (np.array(rows[k][1], np.float32).astype(float) for k in (a, b))
                if x @ y / math.sqrt(x @ x) / math.sqrt(y @ y) >= least:
                    found[a].append(b)
                    found[b].append(a)
    out = []
    for a, (i, _) in enumerate(rows):
        seen, todo = {a}, [a]
        while todo:
            new = set(found[todo.pop()]) - seen
            seen |= new
            todo += new
        out.append((i, len(found[a]), min((rows[s][0] for s in seen if rows[s][0] is not None), default=None)))
    return out


def links(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], SCHEMA)
    return [tuple(r) for r in vectors.linked_vectors(df, **kw).collect()]


def test_odd_vectors(spark):
    near, nan, inf = [1.0, 0.01, 0.0], float("nan"), float("inf")
    rows = [
        (5, [1.0, 0.0, 0.0]), (4, near), (4, near), (9, [-1.0, 0.0, 0.0]), (1, None), (2, []), (3, [0.0, 0.0, 0.0]), (6, [1.0, None, 0.0]), (7, [nan, 1.0, 0.0]),
        (8, [inf, 0.0, 0.0]), (None, near), (None, None), (10, [1.0, 0.0]), (11, [1.0, 0.001]), (12, [1e-30, 0.0, 0.0]), (13, [3e38, 0.0, -0.0]), (14, [2.0]), (15, [3.0]), (16, [-3.0]),
    ]
    got = links(spark, rows)
    assert Counter(r[:3] for r in got) == Counter(brute(rows))
    assert all(kept == (c is None or c == i) for i, _, c, kept in got)
    assert links(spark, []) == []


@pytest.mark.parametrize("dense", [0, 2500])
def test_against_brute_force(spark, dense):
    """Pairs just within reach in all directions, chains, copies and a dense group over several blocks."""
    rng = np.random.default_rng(3)
    base = rng.normal(size=(200, 24))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    side = rng.normal(size=base.shape)
    side -= (side * base).sum(1, keepdims=True) * base
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    turned = [math.cos(t) * base + math.sin(t) * side for t in (0.31, 0.62)]
    group = base[:1] + rng.normal(size=(dense, 24)) * 0.005
    x = np.vstack([base, *turned, base[:50], group])
    rows = [(int(i), [float(v) for v in r]) for i, r in zip(rng.permutation(len(x)), x, strict=True)]
    got = {r[0]: r[1:3] for r in links(spark, rows)}
    a = x.astype(np.float32).astype(float)
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    near = a @ a.T >= 0.95
    ids = np.array([i for i, _ in rows])
    label = ids.copy()
    for _ in range(len(x)):
        new = np.array([label[n].min() for n in near])
        if (new == label).all():
            break
        label = new
    counts = near.sum(1) - 1
    assert sum(n for n, _ in got.values()) >= 0.99 * counts.sum()
    assert np.mean([got[i] == (n, c) for i, n, c in zip(ids, counts, label, strict=True)]) >= 0.99
    assert all(got[i][0] <= n for i, n in zip(ids, counts, strict=True))  # no link below the limit


def test_all_lists_miss_nothing(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(120, 6))
    rows = [(i, [float(v) for v in x]) for i, x in enumerate(np.vstack([base, base + rng.normal(size=base.shape) * 0.2]))]
    assert Counter(r[:3] for r in links(spark, rows, slack=1.0)) == Counter(brute(rows))


def test_forest():
    rng = np.random.default_rng(1)
    for n, m in ((1, 0), (30, 20), (30, 200), (100, 99)):
        a, b = rng.integers(0, n, (2, m))
        kept = vectors.forest(a, b, n)

        def parts(a, b, n=n):
            label = list(range(n))
            for x, y in list(zip(a, b, strict=True)) * n:
                label[x] = label[y] = min(label[x], label[y])
            return label

        assert parts(a, b) == parts(a[kept], b[kept])
        assert len(kept) == n - len(set(parts(a, b)))


def test_query_against_sql(spark, sf_dir):
    same(QUERIES["op13_near_vectors"](spark, sf_dir), connect(sf_dir), ORACLES["op13_near_vectors"])
