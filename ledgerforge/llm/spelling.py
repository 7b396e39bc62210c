"""Spelling variants by composition of finite-state machines.

Near words are what the composition  acceptor . one edit . acceptor  accepts: the minimised acceptor of the vocabulary reads a
word, a transducer inserts, deletes or replaces one letter, the acceptor reads the result. A state of the composition is a state of each
acceptor and whether the edit is made. Before the edit both acceptors are in one state, which the letters read so far lead to;
so the work is dealt by such initial states: a partition has the words that go on from one prefix, and enumerates the pairs whose
edit lies behind it. Of a pair whose edit lies in the first half, the machines read the words from their ends.

A partition of too many words is cut at its next letter, where the pairs that are edited just there meet by the rest of
the word: that is all that can follow the edit.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerforge.llm import common

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of a partition at most; beyond, it is cut.
MOST = 4096


class Acceptor:
    """The minimal acceptor of sorted, distinct words; successors have lower numbers, the last state is the initial one."""

    def __init__(self, words: list[str]):
        self.arcs: list[tuple[tuple[str, int], ...]] = []
        self.final: list[bool] = []
        known: dict = {}
        open_: list[tuple[list, list]] = [([False], [])]
        letters: list[str] = []

        def close(depth: int) -> None:
            while len(open_) > depth:
                final, arcs = open_.pop()
                key = final[0], tuple(arcs)
                state = known.setdefault(key, len(self.arcs))
                if state == len(self.arcs):
                    self.arcs.append(key[1])
                    self.final.append(key[0])
                if open_:
                    open_[-1][1].append((letters.pop(), state))

        before = ""
        for word in words:
            same = 0
            for a, b in zip(before, word):  # noqa: B905
                if a != b:
                    break
                same += 1
            close(same + 1)
            for c in word[same:]:
                letters.append(c)
                open_.append(([False], []))
            open_[-1][0][0] = True
            before = word
        close(0)
        #: Of each state: words that it accepts, the shortest and the longest, and each successor's first place among the words in order.
        self.words, self.shortest, self.longest, self.places = [], [], [], []
        for arcs, final in zip(self.arcs, self.final, strict=True):
            places, at = [], int(final)
            for _, to in arcs:
                places.append(at)
                at += self.words[to]
            self.places.append(places)
            self.words.append(at)
            self.shortest.append(0 if final else 1 + min((self.shortest[t] for _, t in arcs), default=0))
            self.longest.append(1 + max(self.longest[t] for _, t in arcs) if arcs else 0)


def composed(machine: Acceptor) -> list[tuple[int, int]]:
    """The accepted pairs of places of words with exactly one edit between them, once each."""
    arcs, final, places = machine.arcs, machine.final, machine.places
    after: dict[tuple[int, int], list[tuple[int, int]]] = {}  # what both states accept once the edit is made

    def both(p: int, q: int) -> list[tuple[int, int]]:
        todo = [(p, q)]
        while todo:
            x, y = todo[-1]
            if (x, y) in after:
                todo.pop()
                continue
            if x == y:
                after[x, y] = [(i, i) for i in range(machine.words[x])]
                continue
            if machine.shortest[x] > machine.longest[y] or machine.shortest[y] > machine.longest[x]:
                after[x, y] = []
                continue
            by = {c: (t, at) for (c, t), at in zip(arcs[y], places[y], strict=True)}
            steps = [(t, by[c][0], at, by[c][1]) for (c, t), at in zip(arcs[x], places[x], strict=True) if c in by]
            if missing := [(s, t) for s, t, _, _ in steps if (s, t) not in after]:
                todo += missing
                continue
            found = [(0, 0)] if final[x] and final[y] else []
            for s, t, a, b in steps:
                found += [(a + i, b + j) for i, j in after[s, t]] if a or b else after[s, t]
            after[x, y] = found
        return after[p, q]

    before: list[list[tuple[int, int]]] = []  # of each state in which both machines are before the edit
    for state, out in enumerate(arcs):
        found = []
        for (_, to), at in zip(out, places[state], strict=True):
            found += [(at + i, at + j) for i, j in before[to]] if at else before[to]  # the letter as it is
            # The letter inserted; before one like it the insertion is found behind that.
            found += [(i, at + j) for i, j in both(state, to) if not at <= i < at + machine.words[to]]
        for ((_, s), a), ((_, t), b) in combinations(zip(out, places[state], strict=True), 2):
            found += [(a + i, b + j) for i, j in both(s, t)]  # replaced
        before.append(found)
    return before[-1]


def _shared(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):  # noqa: B905
        if x != y:
            break
        n += 1
    return n


def near_words(words: list[str], counts: list[int], side: str, least: int, done: int, here: bool) -> Iterator[tuple[str, int, int, str]]:
    """(word, near words, count of the commonest, the commonest) of a partition. ``least``: letters of a pair's shorter word; ``done``: letters
    that are read before; ``here``: the edit is the next letter's. A pair belongs to the front unless the edit lies in the first half."""
    half = least // 2
    tails = {(w if side == "front" else w[::-1])[done:]: (w, n) for w, n in zip(words, counts, strict=True)}
    order = sorted(tails)
    met: dict[int, list[int]] = {}
    for i, j in composed(Acceptor(order)):
        (a, _), (b, _) = tails[order[i]], tails[order[j]]
        if min(len(a), len(b)) != least or side == "back" and _shared(a, b) >= half or here and _shared(order[i], order[j]):
            continue
        met.setdefault(i, []).append(j)
        met.setdefault(j, []).append(i)
    for i, near in met.items():
        n, word = min((-tails[order[j]][1], tails[order[j]][0]) for j in near)
        yield tails[order[i]][0], len(near), -n, word


def _partitions(words: DataFrame, least: int, most: int) -> DataFrame:
    """(side, least, done, here, found): the initial states with the (word, n) that go on from them, ``most`` at most, or as many as there are letters."""
    lengths = F.filter(F.array(F.col("length") - 1, F.col("length")), lambda x: x >= least)
    rows = words.withColumn("length", F.length("word")).withColumn("least", F.explode(lengths))
    half = F.floor(F.col("least") / 2).cast("int")
    sides = F.array(F.struct(F.lit("front").alias("side"), half.alias("done")), F.struct(F.lit("back").alias("side"), (F.col("least") - half).alias("done")))
    rows = rows.withColumn("s", F.explode(sides)).select("word", "n", "length", "least", "s.side", "s.done")

    def read(n: Column) -> Column:
        return F.when(F.col("side") == "front", F.substring("word", F.lit(1), n)).otherwise(F.substring("word", F.col("length") - n + 1, n))

    def rest(n: Column) -> Column:
        return F.when(F.col("side") == "front", F.substring("word", n + 1, F.col("length"))).otherwise(F.substring("word", F.lit(1), F.col("length") - n))

    key = ["side", "least", "done", "here", "part"]
    rows = rows.withColumns({"here": F.lit(False), "part": read(F.col("done"))})
    out = None
    while True:
        rows = common.written(rows, "spelling-states")
        large = common.written(rows.groupBy(*key).agg(F.count("*").alias("_n")).where(F.col("_n") > most).select(*key), "large-states")
        ready = rows.join(large, key, "left_anti")
        out = ready if out is None else out.unionByName(ready)
        if not large.head(1):
            return out.groupBy(*key).agg(F.collect_list(F.struct("word", "n")).alias("found")).where(F.size("found") > 1)
        cut = rows.join(large, key, "left_semi")
        deeper = cut.where(F.col("length") > F.col("done")).withColumn("done", F.col("done") + 1)
        deeper = deeper.withColumn("part", read(F.col("done")))
        # The pairs that part here: without its next letter the one is as the other without its own, or as the other whole.
        lost = F.filter(F.array(F.lit(1), F.when(F.col("length") == F.col("least"), F.lit(0))), lambda x: x.isNotNull())
        here = cut.withColumn("_lost", F.explode(lost)).where(F.col("length") >= F.col("done") + F.col("_lost"))
        # Digits and the sign are no letters, so these keys are none of the others.
        here = here.withColumn("part", F.concat_ws("|", "part", rest(F.col("done") + F.col("_lost")))).withColumn("here", F.lit(True)).drop("_lost")
        out = out.unionByName(here)
        rows = deeper


def variants(words: DataFrame, least: int = 7, ratio: int = 10, most: int = MOST) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the distinct ``words`` (word, n) of ``least`` letters or more.

    Near words differ by exactly one inserted, deleted or replaced code point. A word's form is its near word of largest ``n`` (of
    equal ones the first in code-point order), if that is at least ``ratio`` times its own, else null; its root is the last word that forms
    lead to. Null and shorter words are left out. ``most``: words of a partition, before it is cut. Other columns are ignored.
    """
    words = words.where(F.length("word") >= least).select("word", F.col("n").cast("long").alias("n"))
    words = common.written(words, "vocabulary")
    common.small_batches(words.sparkSession)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.batches(stream):
            out = [r for row in zip(*[c.to_pylist() for c in batch.columns], strict=True) for r in near_words(row[4], row[5], *row[:4])]
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=["word", "near", "best_n", "best"])

    found = _partitions(words, least, most).select("found.word", "found.n", "side", "least", "done", "here").select("side", "least", "done", "here", "word", "n")
    near = found.mapInArrow(run, "word string, near long, best_n long, best string")
    best = F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))
    none = F.lit(None).cast("struct<n: bigint, word: string>")
    both = words.select("word", "n", F.lit(0).cast("long").alias("near"), none.alias("best"))
    both = both.unionByName(near.select("word", F.lit(None).cast("long").alias("n"), "near", F.when(F.col("best").isNotNull(), best).alias("best")))
    known = both.groupBy("word").agg(F.max("n").alias("n"), F.sum("near").alias("n_near"), F.min("best").alias("best"))
    form = F.when(-F.col("best.n") >= ratio * F.col("n"), F.col("best"))
    known = known.withColumn("_f", form).select("word", F.col("_f.word").alias("form"), "n", "n_near", (-F.col("_f.n")).alias("form_n"))
    known = common.written(known, "forms")

    # Each form is ``ratio`` times as common, so the way to a root is short; each step doubles what is gone of it.
    top = known.agg(F.max("n")).first()[0] or 1
    roots = known.where("form is not null").select("word", F.col("form").alias("root"))
    way = 1 + math.floor(math.log(top, ratio)) if ratio > 1 else known.count()
    for _ in range(math.ceil(math.log2(max(1, way)))):
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("_on"))
        roots = common.written(roots.join(on, "root", "left").select("word", F.coalesce("_on", "root").alias("root")), "spelling-roots")
    return known.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def typed_words(docs: DataFrame, every: int = 31, least: int = 7) -> DataFrame:
    """(word, n): words of ``least`` letters or more that occur twice or more in whole texts. Words are maximal runs of Latin letters with A-Z in lower case; where
    ``every`` divides the hash of a document's id and a run, one letter of the run is missing. A null text has no words, a null id counts as empty."""
    run = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit("[A-Za-zÀ-ÿ]+"), F.lit(0))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(run).alias("run")).where(F.length("run") >= least)
    rows = rows.withColumn("h", F.crc32(F.concat_ws(":", "id", "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = rows.select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= least).groupBy("word").agg(F.count("*").alias("n")).where("n >= 2")
