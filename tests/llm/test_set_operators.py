"""Mixing, URL rules, chat repair, near duplicates, media, and the pipeline."""

import hashlib
import itertools
import random
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest
from odd_rows import ODD
from oracle import connect, same
from pyspark.sql import functions as F

from ledgerforge.llm import chat, common, media, mixing, neardup, urlfilter
from ledgerforge.llm.queries import ORACLES, QUERIES, RULES

# Mixing


def test_targets():
    got = mixing.targets([("b", 100), (None, 10), ("a", 10), ("c", 0)])
    assert [s for s, _, _ in got] == ["a", "b", "c", None]
    assert [t for _, _, t in got] == [20, 140, 0, 20]  # a and the null source are full, c has nothing
    assert sum(t for _, _, t in mixing.targets([(str(i), i * 7 + 1) for i in range(30)])) == pytest.approx(1.5 * sum(i * 7 + 1 for i in range(30)))
    assert mixing.targets([]) == []


def test_mix_of_odd_rows(make):
    docs = make(ODD, clash=["size", "target", "taken"])
    for _ in range(2):
        rows = mixing.mix(docs).collect()
        assert len(rows) == len(ODD)
        by = defaultdict(list)
        for r in rows:
            assert 0 <= r["taken"] <= 2 * r["size"]
            by[r["source"]].append(r)
        for own in by.values():
            assert sum(r["taken"] for r in own) == round(own[0]["target"]) and sum(r["size"] for r in own) == own[0]["source_size"]
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(docs.repartition(3)).collect()))
    assert mixing.mix(make([])).count() == 0


def test_mix_meets_its_targets(spark, sf_dir):
    rows = mixing.mix(common.table(spark, sf_dir, "documents")).collect()
    taken, target = Counter(), {}
    for r in rows:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert r["taken"] <= 2 * r["size"]
    assert all(abs(taken[s] - t) <= 1 for s, t in target.items())


def test_schedule_is_that_of_the_points(spark):
    plan, block = [(700, 500), (300, 400), (100, 300)], 10
    quota = [mixing._quota(t, n, block) for t, n in plan]
    slots, edges = sum(quota), np.cumsum([q / sum(quota) for q in quota])
    rank, times = Counter(), Counter()
    for i in range(1, slots + 1):
        s = min(int(np.searchsorted(edges, i * mixing.PHI % 1.0, side="right")), 2)
        if rank[s] < quota[s]:
            times[s, rank[s] % -(-plan[s][1] // block)] += 1
        rank[s] += 1
    for s in range(3):  # what the points leave open
        for r in range(rank[s], quota[s]):
            times[s, r % -(-plan[s][1] // block)] += 1
    assert {(r["source"], r["block"]): r["times"] for r in mixing.schedule(spark, plan, block).collect()} == dict(times)


# URL rules


def test_url_rules_against_sql(spark, sf_dir):
    same(QUERIES["op5_url_filter"](spark, sf_dir), connect(sf_dir), ORACLES["op5_url_filter"])


def by_hand(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else None
    if rest is None:
        host = path = ""
    else:
        end = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:].split("?")[0].split("#")[0]
    fits = [(len(h + p), len(h), a, h + p) for a, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[2] if best else "allow"


def test_url_rules_against_brute_force(spark):
    rng = random.Random(5)
    label = lambda: rng.choice(["a", "b", "com", "é"])
    path = lambda: "/" + "".join(rng.choice("ab/\U0010ffff") for _ in range(rng.randrange(5)))
    host = lambda: ".".join(label() for _ in range(rng.randrange(1, 4)))
    rules = {(h, p): a for h, p, a in ((host(), rng.choice(["", path()]), rng.choice(["allow", "block"])) for _ in range(60))}
    rules = [(a, h, p) for (h, p), a in rules.items()]
    urls = [None, "", "no scheme", "http://", "http://A.com", "ftp://x://y/z", "http://a\nb/c", "http://com?x", "http://a..com/", "http://b.com/a#b?c"] + [f"http://{host().upper()}{path()}?q" for _ in range(300)]
    df = spark.createDataFrame([(i % 50, u, "x") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    got = Counter((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in urlfilter.judge(df, urlfilter.rules_table(spark, rules + [("allow", None, "/")]), salts=3).collect())
    assert got == Counter((i % 50, *by_hand(u, rules)) for i, u in enumerate(urls))
    assert urlfilter.judge(df.limit(0), urlfilter.rules_table(spark, RULES)).count() == 0
    assert {r["verdict"] for r in urlfilter.judge(df, urlfilter.rules_table(spark, [])).collect()} == {"allow"}


def test_url_rules_need_no_python(spark, sf_dir):
    plan = QUERIES["op5_url_filter"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


# Chat


def cheapest(roles):
    """All sequences of repairs."""
    best = {chat.START: 0.0}
    for role in roles:
        after = {}
        for a, b, c, _, _ in chat.steps(role):
            if a in best:
                after[b] = min(after.get(b, 1e9), best[a] + c)
        best = after
    return min(c + chat.ENDING[z][0] for z, c in best.items())


def repaired(df, **kw):
    by = defaultdict(list)
    for r in chat.formatted(df, **kw).collect():
        by[r["conv_id"]].append(r)
    for rows in by.values():
        rows.sort(key=lambda r: (r["block"], r["place"]))
    return by


@pytest.mark.parametrize("block", [3, 512])
def test_repairs_are_legal_and_cheapest(spark, block):
    rng = random.Random(9)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "xx", " Human "]), f"t{t}") for c in range(25) for t in range(rng.randrange(1, 30))]
    by = repaired(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), block=block)
    for conv, out in by.items():
        state, cost = chat.START, 0.0
        for r in out:
            to = chat.ROLES.index(r["role"])
            assert to == state if r["action"] == "merge" else to in chat.LEGAL[state]
            cost += chat.INSERT if r["action"] == "insert" else (chat.MERGE if r["action"] == "merge" else 0) + chat.label_cost(chat.role_number(r["role_was"]), to)
            state = to
        assert state == 2
        own = [r for r in rows if r[0] == conv]
        assert cost == pytest.approx(cheapest([chat.role_number(r[2]) for r in own]))
        assert [r["text"] for r in out if r["action"] != "insert"] == [r[3] for r in own]
        text = "".join(r["rendered"] for r in out)
        assert text.count("<|im_start|>") == text.count("<|im_end|>") == sum(r["action"] != "merge" for r in out)


def test_odd_conversations(spark):
    schema = "conv_id long, turn long, role string, text string, place string"
    rows = [(1, 0, "user", "a", "x"), (1, 0, "user", "a", "y"), (1, None, "assistant", None, None), (None, 3, None, "b", None), (2, 0, "assistant", "", None), (3, 5, "system", "s", None)]
    by = repaired(spark.createDataFrame(rows, schema))
    assert [(r["role"], r["action"]) for r in by[1]] == [("user", "keep"), ("assistant", "keep")]
    assert [r["role"] for r in by[3]] == ["system", "user", "assistant"] and len(by[None]) == 2
    assert [r["action"] for r in by[2]] == ["insert", "keep"]
    assert chat.formatted(spark.createDataFrame([], schema)).count() == 0


def test_hot_conversations_are_solved_by_pieces(spark):
    """Turns without number or conversation, exact copies among them, over many pieces, blocks and levels."""
    rng = random.Random(4)
    roles = ["user", "assistant", "system", None]
    rows = [(None, None, rng.choice(roles), rng.choice("ab")) for _ in range(300)] + [(1, None, "user", "same")] * 90
    rows += [(None, 7, rng.choice(roles), f"t{i}") for i in range(60)] + [(2, 5, "user", "twice")] * 2
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    by = repaired(df, block=4, piece=20, fan=3)
    for conv in (None, 1, 2):
        own = [r for r in by[conv] if r["action"] != "insert"]
        given = Counter(r[1:] for r in rows if r[0] == conv)
        if conv == 2:
            assert [(r["text"], r["copies"]) for r in own] == [("twice", 2)]
            continue
        assert Counter((r["turn"], r["role_was"], r["text"]) for r in own) == given and {r["copies"] for r in own} == {1}
        assert [r["turn"] is None for r in own] == sorted(r["turn"] is None for r in own)
        state, cost = chat.START, 0.0
        for r in by[conv]:
            to = chat.ROLES.index(r["role"])
            assert to == state if r["action"] == "merge" else to in chat.LEGAL[state]
            cost += chat.INSERT if r["action"] == "insert" else (chat.MERGE if r["action"] == "merge" else 0) + chat.label_cost(chat.role_number(r["role_was"]), to)
            state = to
        assert cost == pytest.approx(cheapest([chat.role_number(r["role_was"]) for r in own]))
        assert max(r["block"] for r in by[conv]) == (len(own) - 1) // 4


# Near duplicates


def shingles(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def brute_classes(rows, least=0.8):
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    holders = defaultdict(set)
    for i, s in enumerate(sets):
        for g in s:
            holders[g].add(i)
    for i, j in {p for h in holders.values() for p in itertools.combinations(sorted(h), 2)}:
        both = sum((sets[i] & sets[j]).values())
        if both >= least * sum((sets[i] | sets[j]).values()):
            up[root(i)] = root(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[root(i)].append(i)
    return groups


def test_classes_are_those_of_brute_force(spark, make):
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(400)}"
    shared = " ".join(word() for _ in range(60))
    rows = []
    for g in range(12):
        base = [word() for _ in range(rng.randrange(40, 120))]
        for _ in range(rng.randrange(1, 9)):
            own = list(base)
            for _ in range(rng.randrange(3)):
                own[rng.randrange(len(own))] = word()
            rows.append((len(rows), " ".join(own)))
    rows += [(len(rows) + i, f"{shared} {' '.join(word() for _ in range(50))}") for i in range(40)]
    got = {r["doc_id"]: r["class_id"] for r in neardup.classes(make(rows)).collect()}
    want = {rows[i][0]: min(rows[j][0] for j in g) for g in brute_classes(rows).values() for i in g}
    assert sum(got[d] != want[d] for d in want) <= 0.02 * len(rows)
    kept = {r["doc_id"] for r in neardup.stage(make(rows)).collect()}
    assert kept == set(got.values())


def test_chains_of_copies_are_whole_classes(make):
    """Copies of copies, each like the one before and few others: a text that meets its lead goes on to meet the others."""
    rng = random.Random(8)
    rows = []
    for _ in range(60):
        text = [f"w{rng.randrange(10**6)}" for _ in range(100)]
        for _ in range(10):
            rows.append((len(rows), " ".join(text)))
            for _ in range(2):
                text[rng.randrange(5, 95)] = f"w{rng.randrange(10**6)}"
    got = {r["doc_id"]: r["class_id"] for r in neardup.classes(make(rows)).collect()}
    want = {rows[i][0]: min(rows[j][0] for j in g) for g in brute_classes(rows).values() for i in g}
    assert len(set(want.values())) < 90 and got == want


def test_odd_near_duplicates(make):
    got = neardup.classes(make(ODD, clash=["key", "class_id", "h"])).collect()
    assert len(got) == len(ODD)
    by = {r["doc_id"]: (r["class_id"], r["members"]) for r in got if r["doc_id"] is not None}
    assert by[6] == (6, 3) and all(by[i][0] == i for i in by) and by[1][1] == by[2][1] == 1
    assert {(r["class_id"], r["members"]) for r in got if r["doc_id"] is None} == {(None, 1), (6, 3)}
    assert neardup.classes(make([])).count() == 0
    assert neardup.classes(make([(1, "a b c"), (2, "A  b\nc"), (3, "a b d")])).where("class_id = 1").count() == 2


def test_one_text_with_two_ids_and_one_id_with_two_texts(make):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    got = Counter((r["doc_id"], r["class_id"]) for r in neardup.classes(make([(1, a), (1, b), (2, a), (3, b + " tail")])).collect())
    assert got == Counter({(1, 1): 2, (2, 1): 1, (3, 1): 1})


def test_stage_keeps_one_row_of_each_class(make):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(1, a), (1, a), (2, b), (2, a), (None, b), (3, None), (3, None), (None, "")]
    got = Counter((r["doc_id"], r["text"]) for r in neardup.stage(make(rows)).collect())
    assert got == Counter({(1, a): 1, (2, b): 1, (3, None): 2, (None, ""): 1})


def test_darts_estimate_weighted_similarity():
    rng = np.random.default_rng(0)
    gaps = []
    for trial in range(30):
        n = int(rng.integers(3, 2000))
        keys, w = rng.integers(0, 2**48, n).astype(np.uint64), rng.random(n) * 3 + 0.01 if trial % 2 else rng.integers(1, 4, n).astype(float)
        keep = rng.random(n) > 0.2
        keep[0] = True
        a, b = (neardup.dart_minhash(keys[m], w[m], np.array([0, m.sum()]), 256)[0] for m in (np.ones(n, bool), keep))
        gaps.append((a == b).mean() - w[keep].sum() / w.sum())
    assert abs(np.mean(gaps)) < 0.02 and np.std(gaps) < 0.05


# Media


def test_media_round_trip(spark, sf_dir, make):
    docs = common.table(spark, sf_dir, "documents").unionByName(make(ODD, clash=["media", "feature"]).drop("media", "feature"))
    got = Counter()
    for r in media.columns(docs).collect():
        got[tuple(r)[:1] + tuple(r)[1:]] += 1
    want = Counter()
    for r in docs.collect():
        data = (r["text"] or "").encode()
        payload = data + b"\xff" * ((-len(data)) % 576 if data else 576)
        form = media.stored(media.chunks(payload))
        assert media.read(form) == payload
        parts = media.chunks(payload)
        want[(r["doc_id"], len(data), len(payload), hashlib.sha256(payload).hexdigest(), crc32(payload[-32:]), len(form), hashlib.sha256(form).hexdigest(), media.feature(payload, len(parts), len(set(parts))))] += 1
    assert got == want
    assert media.columns(make([])).count() == 0


def test_chunks_follow_content():
    rng = random.Random(6)
    passage = bytes(rng.randrange(256) for _ in range(60_000))
    one, two = media.chunks(b"short head" + passage), media.chunks(bytes(rng.randrange(256) for _ in range(777)) + passage)
    assert b"".join(one) == b"short head" + passage and len(set(one) & set(two)) >= len(one) - 3
    assert all(len(c) <= media.MOST for c in one + two)
    with pytest.raises(ValueError):
        media.read(media.stored(one)[:-1] + b"\x00")


# Pipeline


def test_pipeline_on_odd_rows_and_tables(spark, sf_dir, make):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs = make(ODD)
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        if name != "source_mix":
            assert out.columns == docs.columns
            docs = common.written(out, name)
    docs = make([])
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        assert out.count() == 0
        docs = docs if name == "source_mix" else common.written(out, name)


def test_pipeline_against_its_parts(spark, sf_dir):
    pipeline = pytest.importorskip("corpus_pipeline")
    rows = pipeline.run(spark, sf_dir).collect()
    docs = common.table(spark, sf_dir, "documents").collect()
    items = [r["text"] for r in common.table(spark, sf_dir, "benchmark").collect()]
    ids = {r["doc_id"] for r in rows}
    assert len(ids) == len(rows)
    assert not any(t in d["text"] for d in docs if d["doc_id"] in ids for t in items)
    texts = Counter(" ".join(d["text"].lower().split()) for d in docs if d["doc_id"] in ids)
    assert max(texts.values()) == 1
    groups = brute_classes([(d["doc_id"], d["text"]) for d in docs])
    alone = {docs[g[0]]["doc_id"] for g in groups.values() if len(g) == 1}
    clean = {d["doc_id"] for d in docs if d["doc_id"] in alone and len(d["text"]) > 200 and not any(t[:60] in d["text"] for t in items)}
    assert len(clean - ids) <= 0.01 * len(clean)
