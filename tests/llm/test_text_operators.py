"""Language ID, personal data, decontamination, toxicity, LM scores."""

import math
import random
import re
import time
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from odd_rows import ODD
from pyspark.sql import functions as F

from ledgerforge.llm import common, decontam, langid, lm, neardup, pii, toxicity


def docs_of(spark, sf_dir):
    return common.table(spark, sf_dir, "documents")


# Language ID


def test_language_accuracy(spark, sf_dir):
    docs = docs_of(spark, sf_dir)
    model = langid.fit(docs.where(common.id_crc(4) != 2))
    held = langid.identify(docs.where(common.id_crc(4) == 2), model)
    right = held.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.95
    assert held.where("score < 0 or score > 1").count() == 0


def test_languages_are_those_of_plain_encodings(spark, sf_dir):
    """Each whole text encoded anew, one compressor for each block, against the query's choice and margin."""
    docs = docs_of(spark, sf_dir)
    model = langid.fit(docs)
    got = {r["doc_id"]: r for r in langid.identify(docs, model).collect()}
    for r in docs.collect()[::5]:
        words = "".join(c if c.isalpha() else " " for c in re.sub(r"[\W\d_]", " ", r["text"].lower())).split()
        data = " ".join(words).encode()
        sizes = []
        for content in model.snippets.values():
            known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            pieces = (data[i : i + model.block] for i in range(0, len(data), model.block))
            sizes.append(sum(len(zstandard.ZstdCompressor(dict_data=known, level=model.level, write_content_size=False, write_dict_id=False).compress(x)) for x in pieces))
        low, next_ = sorted(sizes)[:2]
        own = got[r["doc_id"]]
        assert own["lang_pred"] == list(model.snippets)[sizes.index(low)]
        assert own["margin"] == pytest.approx((next_ - low) / low) and own["rejected"] == (own["margin"] < model.least_margin)


def test_language_of_odd_rows(make):
    docs = make(ODD, clash=["lang_pred", "score", "extra"])
    out = langid.identify(docs, langid.fit(docs))
    rows = out.collect()
    assert len(rows) == len(ODD) and set(docs.columns) == set(out.columns) - {"margin", "rejected"}
    for r in rows:
        letter = bool(re.search(r"[^\W\d_]", r["text"] or ""))
        assert (r["lang_pred"] == "und") == (not letter) and 0 <= r["score"] <= 1
        assert letter or r["rejected"]
    empty = make([])
    assert langid.identify(empty, langid.fit(empty)).count() == 0
    assert {r["lang_pred"] for r in langid.identify(docs, langid.fit(empty)).collect()} == {"und"}
    assert langid.stage(docs).columns == docs.columns


def test_numerals_are_no_letters(make):
    docs = make([(1, "some words of a text", "en"), (2, "\u00bd \u00b2", "en"), (3, "\u2460\u2461 \u2167", "fr")])
    assert {r["doc_id"] for r in langid.identify(docs, langid.fit(docs)).where("lang_pred = 'und'").collect()} == {2, 3}


def test_stages_keep_columns_of_any_name(spark, make):
    """By content: columns named as the operators' own come back as they were."""
    names = ["score", "margin", "rejected", "lang_pred", "base", "spans", "row", "clean", "asked", "key", "h", "i", "t", "kept"]
    docs = make([(1, "write to a.b@example.com now", "en"), (2, "some other words of a text", "en"), (2, "some other words of a text", "en"), (3, None, "en")], clash=names)
    for stage in (langid.stage, pii.stage, neardup.stage):
        rows = stage(docs).collect()
        assert rows and all(r[n] == "x" for r in rows for n in names)
    assert {r["text"] for r in pii.stage(docs.drop("n_chars")).collect() if r["doc_id"] == 1} == {"write to <EMAIL> now"}


def test_copies_do_not_move_the_model(make):
    rows = [(i, f"text number {i} of some words", "en") for i in range(30)]
    once, often = langid.fit(make(rows)), langid.fit(make(rows + [rows[3]] * 50))
    assert once.snippets == often.snippets


# Personal data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def by_pattern(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            fits = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")[:4]) if kind == "ip" else False, "card": 12 <= len(digits) <= 19 and pii.luhn(digits), "phone": 9 <= len(digits) <= 15}
            if fits[kind]:
                out.append((kind, *m.span()))
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


@pytest.mark.parametrize("alphabet", ["ab.@-+%1234 ()0\n", ["0", "1", "255", "9.", "12", "4111111111111111", ". ", "-", " ", "+", "(", "a@b.c", "@", "é"]])
def test_base_spans_are_those_of_the_patterns(alphabet):
    rng = random.Random(3)
    for _ in range(8000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(30)))
        assert pii.base_spans(text) == by_pattern(text), text


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000 + "@", "1" * 300_000, "1." * 150_000, "+1" + " " * 300_000, "@" * 100_000, "1 " * 100_000):
        pii.base_spans(text)


def test_field_adds_what_repeats(spark, sf_dir):
    weights = pii.fit(docs_of(spark, sf_dir))
    text = "mail bob.x@mail.example.com or later bob.x[at]mail.example.com, and 12 apples for 300 people"
    base = pii.base_spans(text)
    assert pii.added_spans([text], [base], weights) == [[("email", 37, 62)]]
    clean = ["12 apples, 300 pears, chapter 4.2 of 1999", "", None, "no number here"]
    assert pii.added_spans(clean, [pii.base_spans(t) for t in clean], weights) == [[], [], [], []]


def test_altered_repeats_are_found(spark):
    """Spans of given documents said again in other ways, one digit changed too: all are found, and nothing else."""
    docs = docs_of(spark, "/root/testdata/sf0.01")
    weights = pii.fit(docs)
    texts = [r["text"] for r in docs.select("text").collect() if r["text"] and len(r["text"]) < 20_000]
    assert not any(pii.added_spans(texts, [pii.base_spans(t) for t in texts], weights))
    tried = hit = wrong = 0
    for text in texts:
        for kind, a, b in pii.base_spans(text)[:2]:
            for n in range(4):
                piece = pii.altered(kind, text[a:b], n)
                if kind == "card" and n % 2:
                    piece = f"{piece[:-1]}{(int(piece[-1]) + 1) % 10}"
                full, start = f"{text} so we say {piece} again", len(text) + 11
                base = pii.base_spans(full)
                if any(y > start for _, _, y in base):
                    continue
                more = pii.added_spans([full], [base], weights)[0]
                tried += 1
                hit += any(s[0] == kind and s[2] > start for s in more)
                wrong += any(s[0] != kind or s[2] <= start for s in more)
    assert tried > 100 and hit >= 0.95 * tried and wrong <= 0.01 * tried


@pytest.mark.parametrize("times", [1, 2, 5, 30])
@pytest.mark.parametrize("words", [1, 5, 500])
def test_number_and_distance_of_repeats_do_not_matter(spark, times, words):
    weights = pii.fit(docs_of(spark, "/root/testdata/sf0.01"))
    values = {k: set() for k in pii.KINDS}
    for r in docs_of(spark, "/root/testdata/sf0.01").select("text").collect():
        for kind, a, b in pii.base_spans(r["text"]):
            values[kind].add(r["text"][a:b])
    rng = random.Random(times)
    for kind, found in values.items():
        tried = hit = wrong = 0
        for value in sorted(found)[:15]:
            text, want = f"Write: {value}", []
            for n in range(times):
                text += " " + " ".join(rng.choice(["the", "of", "haben", "entre"]) for _ in range(words)) + " "
                piece = pii.altered(kind, value, n)
                want.append((len(text), len(text) + len(piece)))
                text += piece
            text += " in chapter 12 of 2024"
            base = pii.base_spans(text)
            more = pii.added_spans([text], [base], weights)[0]
            want = [(a, b) for a, b in want if not any(x < b and a < y for _, x, y in base)]
            tried += len(want)
            hit += sum(any(k == kind and x <= a + 1 and y >= b - 1 for k, x, y in more) for a, b in want)
            wrong += sum(k != kind or not any(a < y and x < b for a, b in want) for k, x, y in more)
        assert hit >= 0.95 * tried and wrong <= 0.01 * tried, kind


def test_very_many_repeats(spark, sf_dir):
    weights = pii.fit(docs_of(spark, sf_dir))
    text = "Call +1 (152) 555-8590" + "".join(" or " + pii.altered("phone", "+1 (152) 555-8590", n) for n in range(64_000))
    began = time.perf_counter()
    assert len(pii.all_spans([text], weights)[0]) == 64_001
    assert time.perf_counter() - began < 20


def test_messages_on_small_graphs_with_loops():
    """Near the exact marginals where the couplings are weak, evidence and a key among them."""
    rng = np.random.default_rng(2)
    k = len(pii.LABELS)
    for _ in range(5):
        weights = pii.Weights(rng.normal(size=(len(pii.FEATURES), k)), rng.normal(size=(k, k)) * 0.3, 0.4)
        graph = pii.Graph([], np.array([0, 3, 0, 0, 0]), rng.random((5, len(pii.FEATURES))), np.array([[0, 1], [1, 2], [0, 4], [2, 4], [3, 4], [2, 3]]), np.array([False, False, True, True, True, False]), np.zeros(5, int))
        own, exact = graph.features @ weights.unary, np.zeros((5, k))
        for x in np.ndindex(*[k] * 5):
            if x[1] == 3:
                w = math.exp(sum(own[i, x[i]] for i in range(5)) + sum(weights.skip * (x[a] == x[b]) if s else weights.chain[x[a], x[b]] for (a, b), s in zip(graph.edges, graph.skip, strict=True)))
                for i in range(5):
                    exact[i, x[i]] += w
        exact /= exact.sum(1, keepdims=True)
        assert np.abs(pii.marginals(graph, weights) - exact).max() < 0.02


@pytest.mark.parametrize("text", ["1 " + "a" * 500_000, "@" * 300_000, "a" * 500_000 + "@b", "[at]" * 100_000, "x [at] y " * 20_000, "1 " * 100_000, "+1" * 50_000])
def test_candidates_take_linear_time(text):
    began = time.perf_counter()
    pii.graph([text], [pii.base_spans(text)])
    assert time.perf_counter() - began < 20


def test_messages_reach_the_exact_marginals_on_a_tree():
    rng = np.random.default_rng(1)
    k = len(pii.LABELS)
    weights = pii.Weights(rng.normal(size=(len(pii.FEATURES), k)), rng.normal(size=(k, k)), 0.7)
    graph = pii.Graph([], np.array([0, 0, 2, 0]), rng.random((4, len(pii.FEATURES))), np.array([[0, 1], [1, 2], [1, 3]]), np.array([False, True, True]), np.zeros(4, int))
    own = graph.features @ weights.unary
    exact = np.zeros((4, k))
    for a in np.ndindex(k, k, k, k):
        if a[2] != 2:
            continue
        w = math.exp(own[0, a[0]] + own[1, a[1]] + own[3, a[3]] + weights.chain[a[0], a[1]] + weights.skip * ((a[1] == a[2]) + (a[1] == a[3])))
        for i in range(4):
            exact[i, a[i]] += w
    exact /= exact.sum(1, keepdims=True)
    assert np.abs(pii.marginals(graph, weights, rounds=60) - exact).max() < 1e-6


def test_redaction_of_odd_rows(spark, make):
    docs = make([*ODD, (20, "call +1 (743) 555-3824 now", "en", "a"), (20, "call +1 (743) 555-3824 now", "en", "a")], clash=["base", "spans"])
    out = pii.stage(docs)
    assert out.columns == docs.columns and out.count() == len(ODD) + 2
    assert {(r["text"], r["n_chars"]) for r in out.where("doc_id = 20").collect()} == {("call <PHONE> now", 16)}
    assert pii.find(make([]), pii.fit(make([]))).count() == 0
    assert pii.redact("abcdef", [("email", 0, 3), ("ip", 2, 4), ("card", 5, 6)]) == "<EMAIL>e<CARD>"


# Decontamination

ITEM = "Tom has 12 apples and gives 5 apples to Mary, then Mary sells 5 apples for 3 dollars each at noon"


def found(make, spark, docs, items):
    got = decontam.contaminated(make(docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    return {(r["doc_id"], r["item_id"]) for r in got}


def test_leaks_and_new_parameters(spark, make):
    other = ITEM.replace("12", "77").replace("5", "9").replace("Mary", "Paula").replace("3 dollars", "8 dollars")
    slip = ITEM.replace("gives 5", "gives 9")  # one of two equal numbers changed
    mixed = ITEM.replace("gives 5", "gives 9").replace("sells 5", "sells 4").replace("to Mary", "to Paula").replace("then Mary", "then Jane")
    docs = [(1, f"before it all {ITEM} and after"), (2, other), (3, mixed), (4, "some words that have nothing to do with it at all"), (5, None), (None, ITEM), (6, ITEM.upper()), (7, slip)]
    got = found(make, spark, docs, [(7, ITEM), (8, None), (9, "")])
    assert {(1, 7), (2, 7), (None, 7), (6, 7), (7, 7)} >= got >= {(1, 7), (2, 7), (None, 7), (7, 7)}
    assert found(make, spark, docs, [(5, "nothing to do with")]) == {(4, 5)}  # a short item, whole
    assert found(make, spark, [], [(7, ITEM)]) == set() and found(make, spark, docs, []) == set()


def test_new_names_units_and_one_slip(spark, make):
    item = "Natalia sold 48 clips in April to Mary for 5 km of string. She sold 5 clips more in May and kept 12 for herself at home"
    other = item.replace("Natalia", "Anna Maria").replace("48", "52").replace("Mary", "Mary Jane").replace("5 km", "7km").replace(" 5 clips", " 7 clips")
    slip = item.replace("sold 5 clips", "sold 6 clips")
    longer = item.replace("to Mary", "right to Mary")
    docs = [(1, f"So. {other} and so on"), (2, slip), (3, longer), (4, "Natalia sold 48 clips in April, and that was all there is to say of it"), (5, item), (5, "an other text"), (None, item)]
    assert found(make, spark, docs, [(7, item)]) == {(1, 7), (2, 7), (3, 7), (5, 7), (None, 7)}
    kept = decontam.stage(make(docs, clash=["h", "i", "row", "asked"]), spark.createDataFrame([(7, item)], "item_id long, text string")).collect()
    assert sorted((r["doc_id"], r["text"][:2]) for r in kept) == [(4, "Na"), (5, "an")] and {r["h"] for r in kept} == {"x"}


def test_agreeing_windows():
    assert decontam.agreeing([(0, [1, 2], [5, 6]), (1, [2], [6]), (2, [2], [7])]) == (2, 2)
    assert decontam.agreeing([(0, [1], [1]), (1, [1], [1]), (2, [3, 1], [4, 1])]) == (3, 2)
    assert decontam.agreeing([(0, [1, 2], [5, 5])]) == (0, 1) and decontam.agreeing([(0, [], []), (1, [], [])]) == (2, 0)


def by_templates(docs, items, width=8, least=6):
    """All windows of all texts against all windows of all items, as lists of words."""

    def read(text):
        words = []
        for w in re.split("[ \t\n\v\f\r]+", text or ""):
            for kind, value in decontam.canonical(w) if w else ():
                if kind == decontam.NAME and words and words[-1][0] == kind:
                    words[-1] = (kind, f"{words[-1][1]} {value}")
                else:
                    words.append((kind, value))
        return words

    slots = lambda piece: [v for k, v in piece if k in (decontam.NUMBER, decontam.UNIT, decontam.NAME)]
    cut = lambda words, w: [(i, words[i : i + w]) for i in range(len(words) - w + 1)]
    out = {}
    for item, text in items:
        words = read(text)
        w = min(width, len(words))
        own = defaultdict(list)
        for i, piece in cut(words, w) if w else ():
            own[tuple(k for k, _ in piece)].append((i, slots(piece)))
        for doc, other in docs:
            lines = defaultdict(set)
            for j, piece in cut(read(other), w) if own else ():
                for i, values in own.get(tuple(k for k, _ in piece), ()):
                    for kind in range(2):
                        lines[kind, (j - i + kind * decontam.SLACK // 2) // decontam.SLACK].add((i, tuple(values), tuple(slots(piece))))
            for hits in lines.values():
                pairs = Counter(p for _, a, b in hits for p in zip(a, b, strict=True))
                best = {a: max((n, b) for (x, b), n in pairs.items() if x == a) for a, _ in pairs}
                back = {b: max((n, a) for (a, x), n in pairs.items() if x == b) for _, b in pairs}
                tied = any(sum(m == n and x == a for (x, _), m in pairs.items()) > 1 for a, (n, _) in best.items())
                tied |= any(sum(m == n and x == b for (_, x), m in pairs.items()) > 1 for b, (n, _) in back.items())
                agree = {i for i, a, b in hits if all(best[x][1] == y and back[y][1] == x for x, y in zip(a, b, strict=True))}
                n = max(len(agree), len({i for i, a, b in hits if a == b}))
                if n >= min(least, sum(map(len, own.values()))):
                    out.setdefault((doc, item), []).append((n, tied))
    return out


def test_templates_against_brute_force(spark, make):
    """Small vocabulary, so that windows meet often, with items of one template and phrases that all share."""
    rng = random.Random(11)
    word = lambda: rng.choice(["Tom", "Ann Lee", "12", "7km", "5 km", "9", "has", "red", "more", "than", "a"])
    phrase = "we know that in all of these cases the very same words"
    items = [(i, " ".join(word() for _ in range(rng.choice([3, 9, 16, 25])))) for i in range(12)]
    items += [(20 + i, f"{phrase} {' '.join(word() for _ in range(14))}") for i in range(6)] + [(30, None), (31, "...")]
    docs = []
    for i in range(60):
        base = (rng.choice(items)[1] or "").split()
        for _ in range(rng.randrange(3)):
            if base:
                base[rng.randrange(len(base))] = word()
        docs.append((i, " ".join([*(word() for _ in range(5)), phrase * (i % 2), *base, word()])))
    docs += [(3, docs[7][1]), (None, docs[8][1]), (61, docs[9][1]), (62, None), (63, "")]
    want = by_templates(docs, items)
    got = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(make(docs), spark.createDataFrame(items, "item_id long, text string")).collect()}
    sure = {k for k, v in want.items() if not all(tied for _, tied in v)}
    assert len(sure) > 40 and sure <= got <= set(want)


@pytest.mark.parametrize("length", [22, 60])
def test_a_shared_instruction_pairs_nothing(spark, make, length):
    """Items and documents that share an instruction alone are no pairs; items behind it are found, as they are and with new values."""
    rng = random.Random(length)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    instruction = " ".join(word() for _ in range(length))
    question = lambda: " ".join(str(rng.randrange(99)) if i % 5 == 2 else word() for i in range(18))
    items = [(i, f"{instruction} {question()}") for i in range(60)]
    items += [(100 + i, f"{instruction} pick {word()}") for i in range(3)]  # hardly a word of their own
    docs = [(i, f"{word()} {instruction} {question()}") for i in range(60)]
    docs += [(200, f"see {items[7][1]} there"), (201, re.sub("[0-9]+", lambda m: str(int(m[0]) + 100), items[8][1])), (202, f"so {items[61][1]} then"), (203, f"so {instruction} pick any")]
    assert found(make, spark, docs, items) == {(200, 7), (201, 8), (202, 101)}


def test_one_template_of_many_items(spark, make):
    """The least id stands for all."""
    items = [(i, f"A train leaves at {i} and runs {i + 7} miles in {i + 3} hours so how fast was it going") for i in range(5, 25)]
    docs = [(1, items[9][1]), (2, "A train leaves at 900 and runs 31 miles in 44 hours so how fast was it going"), (3, "A train leaves at 9 and runs 16 miles")]
    assert found(make, spark, docs, items) == {(1, 5), (2, 5)}


def test_without_the_bound_on_holders_nothing_is_left_out(spark, make):
    """Items of one template are all given, and a passage that all share is evidence for each."""
    items = [(i, f"A train leaves at {i} and runs {i + 7} miles in {i + 3} hours so how fast was it going") for i in range(5, 25)]
    passage = "in all of these cases we know that the very same words stand before what is asked of you here"
    items += [(100 + i, f"{passage} {w} one two three four five six seven") for i, w in enumerate("abcdefghijkl")]
    docs = [(1, items[9][1]), (2, f"so {passage} and no more"), (3, "A train leaves at 9 and runs 16 miles")]
    texts = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(make(docs), texts, few=None).collect()}
    assert got == {(1, i) for i in range(5, 25)} | {(2, 100 + i) for i in range(12)}
    assert found(make, spark, docs, items) == {(1, 5)}


def test_every_planted_item_is_found(spark, sf_dir):
    docs, items = docs_of(spark, sf_dir), common.table(spark, sf_dir, "benchmark")
    texts = [r["text"] for r in items.collect()]
    whole = {r["doc_id"] for r in docs.collect() if any(t in (r["text"] or "") for t in texts)}
    flagged = {r["doc_id"] for r in decontam.contaminated(docs, items).collect()}
    assert whole and whole <= flagged and len(flagged - whole) <= 0.05 * docs.count()
    kept = decontam.stage(docs, items)
    assert kept.count() == docs.count() - len(flagged) and kept.columns == docs.columns


# Toxicity


def test_decoding():
    counts = Counter()
    for w, n in {"idiot": 50, "moron": 50, "stupid": 50, "people": 500, "hello": 300, "loser": 40}.items():
        c = [toxicity.EDGE, toxicity.EDGE, *toxicity.classes_of(w), toxicity.EDGE]
        for a, b, d in zip(c, c[1:], c[2:], strict=False):
            counts[(a * toxicity.CLASSES + b) * toxicity.CLASSES + d] += n
    model = toxicity.CharModel.of(counts)
    for hidden, word in {"1d10t": "idiot", "i.d.i.o.t": "idiot", "idiooooot": "idiot", "m0r0n": "moron", "st*u*p*1d": "stupid", "hello": "hello", "HELLO!!": "hello", "l0s3r***": "loser", "": "", "???": ""}.items():
        assert toxicity.restore(hidden, model) == word
    words = toxicity.words_of(pa.array(["an i d i o t here", None]), lambda w: toxicity.restore(w, model))
    assert "idiot" in words[2]


def test_doubled_letters_alone_are_decoded_alike():
    rng = random.Random(8)
    for _ in range(20):
        model = toxicity.CharModel.of({rng.randrange(toxicity.CLASSES**3): rng.randrange(1, 5000) for _ in range(2000)})
        for _ in range(100):
            word = "".join(c * rng.choice([1, 1, 2]) for c in rng.sample("abcdeé", rng.randrange(1, 6)))
            assert toxicity.undoubled(word, model) == toxicity.decode(word, model)


def test_hidden_words_and_ordinary_ones(spark):
    """Under a model of the corpus."""
    docs = docs_of(spark, "/root/testdata/sf0.01")
    model = toxicity.CharModel.of(toxicity.char_counts(docs))
    for hidden, word in {"fuuck": "fuck", "shiit": "shit", "stuupid": "stupid", "ｉdiot": "idiot", "ｉｄｉｏｔ": "idiot", "2024": "2024", "+15": "+15", "$100": "$100", "been": "been"}.items():
        assert toxicity.restore(hidden, model) == word
    assert toxicity.restore("@$$", model).isalpha() and toxicity.restore("$#1t", model).isalpha()  # no sign is left as it is
    assert "stupid" in toxicity.words_of(pa.array(["a stu pi d word"]), lambda w: toxicity.restore(w, model))[2]
    words = Counter(w for r in docs.select("text").collect() for w in (r["text"] or "").split())
    plain = {w: n for w, n in words.items() if w.isalpha()}
    changed = sum(n for w, n in plain.items() if toxicity.restore(w, model) != w.lower())
    assert changed <= 0.002 * sum(plain.values())


def sigmoid_of(texts, model):
    """Scores by the words of each text, one at a time."""
    out = []
    for text in texts:
        codes, _, restored = toxicity.words_of(pa.array([text], pa.string()), lambda w: toxicity.restore(w, model.chars))
        held = {g for c in set(codes.tolist()) for g in toxicity.grams(restored[c])}
        out.append(1 / (1 + math.exp(-(model.bias + sum(w for g, w in model.weights.items() if g in held)))))
    return out


def test_scores_against_brute_force(spark, make):
    texts = ["you stupid idiot", "you st*up1d fool", "what a lovely day", "", None, "fu c k this", "s t u p i d", "people say hello 2024"]
    chars = toxicity.CharModel.of(toxicity.char_counts(make([(i, t) for i, t in enumerate(texts)])))
    model = toxicity.Model(chars, {"=stupid": 2.5, "=idiot": 2.0, "stupi": 0.5, "lovel": -1.5, "=fuck": 3.0}, -2.0)
    got = {r["doc_id"]: (r["score"], r["predicted"]) for r in toxicity.score(make(list(enumerate(texts))), model).collect()}
    for i, want in enumerate(sigmoid_of(texts, model)):
        assert got[i][0] == pytest.approx(want, abs=1e-12) and got[i][1] == (want >= 0.5)
    assert got[0][1] == 1 and got[3][0] == got[4][0] == pytest.approx(1 / (1 + math.exp(2.0)))


def readings(word, cost):
    """All readings of a word with their costs, by recursion."""
    out = {}

    def go(i, a, b, text, c):
        if i == len(word):
            c += cost[a, b, toxicity.EDGE]
            out[text] = min(c, out.get(text, 1e9))
            return
        ch, same = word[i], i > 0 and word[i - 1] == word[i]
        if ch.isalpha():
            k = ord(ch) - 97
            go(i + 1, b, k, text + ch, c + cost[a, b, k])
            if same:
                go(i + 1, a, b, text, c + (toxicity.REPEAT if i > 1 and word[i - 2] == ch else toxicity.DOUBLED))
        elif ch == " ":
            go(i + 1, toxicity.EDGE, toxicity.EDGE, text + ch, c + cost[a, b, toxicity.EDGE])
            go(i + 1, a, b, text, c + toxicity.CLOSE)
        else:
            for x in toxicity.LEET.get(ch, ""):
                go(i + 1, b, ord(x) - 97, text + x, c + toxicity.LOOK + cost[a, b, ord(x) - 97])
            again = toxicity.REPEAT if i > 1 and word[i - 2] == ch or ch not in "@$€£" else toxicity.DOUBLED
            go(i + 1, a, b, text, c + (again if same else toxicity.KEEP_SIGN if ch.isdigit() else toxicity.DROP_LOOK if ch in "@$€£" else toxicity.DROP))

    go(0, toxicity.EDGE, toxicity.EDGE, "", 0.0)
    return out


def test_decoding_is_the_best_of_all_readings():
    rng = random.Random(3)
    model = toxicity.CharModel.of({rng.randrange(toxicity.CLASSES**3): rng.randrange(1, 90) for _ in range(3000)})
    for _ in range(400):
        word = "".join(rng.choice("abcdeilost016@$!|-*. ") for _ in range(rng.randrange(1, 10)))
        found = readings(word, model.cost)
        assert found[toxicity.decode(word, model)] == pytest.approx(min(found.values()))


def test_spaced_pieces_are_read_as_one_word():
    counts = Counter()
    for w, n in {"idiot": 50, "scum": 80, "people": 500, "the": 900, "of": 900, "is": 700}.items():
        c = [toxicity.EDGE, toxicity.EDGE, *toxicity.classes_of(w), toxicity.EDGE]
        for a, b, d in zip(c, c[1:], c[2:], strict=False):
            counts[(a * toxicity.CLASSES + b) * toxicity.CLASSES + d] += n
    model = toxicity.CharModel.of(counts)
    codes, owner, words = toxicity.words_of(pa.array(["the sc um is", "of s cum", "is of the", None]), lambda w: toxicity.restore(w, model))
    assert [words[c] for c, o in zip(codes, owner, strict=True) if o == 0].count("scum") == 1
    assert "scum" in [words[c] for c, o in zip(codes, owner, strict=True) if o == 1]
    assert sorted(words[c] for c, o in zip(codes, owner, strict=True) if o == 2) == ["is", "of", "the"]


@pytest.mark.parametrize("word", ["-" * 60 + "a", "-" * 300_000 + "a", "=====x", "-----|", "a1" * 30_000, "!" * 300_000, "a" * 300_000, "f!!!" * 5000])
def test_odd_words_take_linear_time(word):
    began = time.perf_counter()
    toxicity.restore(word, toxicity.CharModel.of({1: 1}))
    assert time.perf_counter() - began < 20


def test_char_counts_are_those_of_brute_force(make):
    rows = [(1, "Ab b é!"), (2, None), (3, "ab"), (4, "")]
    want = Counter()
    for _, t in rows:
        for w in (t or "").split():
            c = [toxicity.EDGE, toxicity.EDGE, *[ord(x) - 97 if "a" <= x <= "z" else toxicity.OTHER if x.isalpha() else toxicity.EDGE for x in w.lower()], toxicity.EDGE]
            c = [x for i, x in enumerate(c) if i < 2 or not (x == toxicity.EDGE and c[i - 1] == toxicity.EDGE)]
            for a, b, d in zip(c, c[1:], c[2:], strict=False):
                want[((toxicity.EDGE if b == toxicity.EDGE else a) * toxicity.CLASSES + b) * toxicity.CLASSES + d] += 1
    assert toxicity.char_counts(make(rows)) == dict(want)


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = docs_of(spark, sf), common.table(spark, sf, "labels")
    model = toxicity.fit(docs, labels.where(common.id_crc(5) != 0))
    got = toxicity.score(docs, model).join(labels, "doc_id").where(common.id_crc(5) == 0).collect()
    toxic, clean = ([r["score"] for r in got if r["toxic"] == x] for x in (1, 0))
    above = sum((a > b) + 0.5 * (a == b) for a in toxic for b in clean) / (len(toxic) * len(clean))
    assert above > 0.75 and sum(s >= 0.5 for s in clean) <= 0.03 * len(clean)


def test_toxicity_of_odd_rows(spark, make):
    docs = make(ODD, clash=["score", "predicted"])
    labels = spark.createDataFrame([(4, None, 1), (6, None, 0), (6, None, 0), (None, None, 1), (99, None, 1), (8, None, None)], "doc_id long, quality int, toxic int")
    got = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    none = toxicity.fit(make([]), labels.limit(0))
    assert toxicity.score(make([]), none).count() == 0 and toxicity.score(docs, none).count() == len(ODD)


# LM scores


def tokens(text):
    return [w for w in re.split("[ \t\n\v\f\r]+", re.sub("[A-Z]", lambda c: c[0].lower(), text or "")) if w] + ["\n"]


@pytest.mark.parametrize("heavy", [None, 3])
def test_lm_against_brute_force(spark, sf_dir, make, monkeypatch, heavy):
    """Also with hardly any word in the broadcast table, so that counts come from the join."""
    if heavy:
        monkeypatch.setattr(lm, "HEAVY", heavy)
    docs = docs_of(spark, sf_dir).unionByName(make(ODD, clash=["score"]).drop("score"))
    model = lm.fit(docs.where(common.id_crc(7) != 2))
    got = lm.score(docs, model).collect()
    rows = docs.collect()
    counts = Counter()
    for r in rows:
        if crc32(str(r["doc_id"] if r["doc_id"] is not None else "").encode()) % 7 != 2:
            counts.update(tokens(r["text"]))
    n, v = sum(counts.values()), len(counts)
    want = sorted((str(r["doc_id"]), len(t := tokens(r["text"])), sum(counts[w] > 0 for w in t), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t), 5)) for r in rows)
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in got) == want
    held = [r for r in got if crc32(str(r["doc_id"]).encode()) % 7 == 2]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_bigrams_seen_once_count(make):
    docs = [(i, " ".join(f"w{i}x{j}" for j in range(50))) for i in range(40)]
    model = lm.fit(make(docs))
    words = [f"w{i}x{j}" for i in range(40) for j in range(50)]
    seen = docs[3][1]
    mixed = " ".join(f"w{j % 40}x{(j * 7) % 50}" for j in range(50))  # the same kind of words, no training bigram
    got = {r["doc_id"]: r["score"] for r in lm.score(make([(1, seen), (2, mixed)]), model).collect()}
    assert len(set(words)) == 2000 and got[1] > got[2] + 50
    data, starts = lm._piece(model, 0, lm.SEGMENTS - 1)
    assert len(starts) == lm.SEGMENTS + 1 and len(data) * 8 >= 10 * (2000 * 2)


def test_filter_gives_levels_back(make):
    model = lm.fit(make([(i, "one two " * (2**i)) for i in range(8)]))
    h = common.hash_strings(["one", "two", "\n", "never"])
    n = np.array([255, 255, 8, 0])
    found = lm.levels(lm._piece(model, 0, lm.SEGMENTS - 1), h)
    assert (found[:3] == lm.level_of(n[:3], np.zeros(3, bool))).all() and found[3] == 0
    assert lm.score(make([]), lm.fit(make([]))).count() == 0


def test_scores_are_those_of_exact_counts(spark, sf_dir):
    """With hardly any false hit the filter gives the levels of exact counts, whether it is broadcast whole or in pieces."""
    docs = docs_of(spark, sf_dir).select("doc_id", "text")
    learns = common.id_crc(7) != 2
    got = {r["doc_id"]: r["score"] for r in lm.fit_and_score(docs, learns, entry_bits=200).collect()}
    parts = {r["doc_id"]: r["score"] for r in lm.fit_and_score(docs, learns, entry_bits=200, piece_bytes=400_000).collect()}
    model = lm.fit(docs.where(learns), entry_bits=200, piece_bytes=400_000)
    assert len(model.pieces) > 2 and parts == pytest.approx(got)
    assert {r["doc_id"]: r["score"] for r in lm.score(docs, model).collect()} == pytest.approx(got)
    one, two = Counter(), Counter()
    rows = {r["doc_id"]: tokens(r["text"]) for r in docs.collect()}
    train = [t for d, t in rows.items() if crc32(str(d).encode()) % 7 != 2]
    for t in train:
        one.update(t)
        two.update(zip(["\n", *t], t, strict=False))
    level = lambda n, pair: 0 if not n else 1 + math.floor((1 if pair else 2) * math.log2(n) + 1e-12)
    held = lambda x, pair: x if x < 2 else 2 ** (x - 0.5 if pair else (x - 1) / 2 + 0.25)
    mass = sum(held(level(n, False), False) for n in one.values())
    total, hit = Counter(), Counter()
    for t in train:
        for a, b in zip(["\n", *t], t, strict=False):
            total[level(one[a], False)] += 1
            hit[level(one[a], False)] += two[a, b] >= 2
    part = {x: min(0.99, n / (2 * n - hit[x])) for x, n in total.items()}
    for d, t in rows.items():
        want = 0.0
        for a, b in zip(["\n", *t], t, strict=False):
            n, w = held(level(one[a], False), False), part.get(level(one[a], False), 0.0)
            p = (1 - w) * (held(level(one[b], False), False) + 1) / (mass + len(one) + 1)
            if two[a, b]:
                p += w * min(held(level(two[a, b], True), True), n) / max(n, 1)
            want += math.log10(p)
        assert got[d] == pytest.approx(want, rel=2e-3), d


def test_a_full_filter_gives_no_probability_above_one(spark, sf_dir):
    docs = docs_of(spark, sf_dir)
    scores = [r["score"] for r in lm.fit_and_score(docs, common.id_crc(7) != 2, entry_bits=0.2).collect()]
    assert all(-1e9 < s <= 0 for s in scores)
