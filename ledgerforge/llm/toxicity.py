"""Toxicity of texts behind a noisy channel.

Writers hide words by look-alike characters, separators, spacing and repetition. A word is a
lattice: each character may stand for itself, for a letter that it looks like, for a repetition of the one
before or for nothing, and a space between short pieces may be an end of a word or nothing. Viterbi decoding under a character
trigram model of the whole corpus finds the likeliest reading, with all states kept; a word of letters of which no two neighbours are alike has no other
reading than itself, and digits with fewer signs are a number. The restored words are scored by a logistic model on words and their character n-grams.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerforge.llm import common

LETTERS = "abcdefghijklmnopqrstuvwxyz"
#: Classes of the character model: letters, any other letter, and the edge of a word.
OTHER, EDGE = 26, 27
CLASSES = 28
#: Look-alikes.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "#": "h"}
#: Costs in nats.
LOOK, DOUBLED, REPEAT, DROP, DROP_LOOK, KEEP_SIGN, CLOSE = 1.0, 6.0, 0.2, 0.7, 3.0, 9.0, 1.5
#: Signs that seldom stand between letters, so they are seldom nothing.
_LOOKS = frozenset("@$€£")
#: Two neighbouring words of so many characters at most may be pieces of one.
PIECE = 3
#: So may all of a run of words of RUN characters at most, if a sign or a letter that is no word by itself stands alone in it.
RUN, ALONE = 4, frozenset("aeiouyàéèêáíóúäöü")
#: Signs that may stand for letters, kept at the ends of a word.
_SIGNS = frozenset("@$!|+(€£_")
_DOUBLE, _TRIPLE = re.compile(r"(.)\1"), re.compile(r"(.)\1\1")


def classes_of(word: str) -> list[int]:
    return [ord(c) - 97 if "a" <= c <= "z" else OTHER for c in word]


@dataclass
class CharModel:
    cost: np.ndarray  # (classes, classes, classes): -log p(c | a, b)

    @staticmethod
    def of(counts: dict[int, int]) -> CharModel:
        n = np.zeros(CLASSES**3)
        for i, c in counts.items():
            n[i] = c
        n = n.reshape(CLASSES, CLASSES, CLASSES)
        two, one = n.sum(0), n.sum((0, 1))
        p1 = (one + 1) / (one.sum() + CLASSES)
        p2 = (two + 20 * p1) / (two.sum(1, keepdims=True) + 20)
        p3 = (n + 20 * p2) / (n.sum(2, keepdims=True) + 20)
        return CharModel(-np.log(p3))


def char_counts(docs: DataFrame) -> dict[int, int]:
    """Trigrams of character classes over all words of all texts; at most 28 cubed numbers, whatever the corpus."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES**3, np.int64)
        table = np.full(256, EDGE, np.int64)
        table[ord("a") : ord("z") + 1] = np.arange(26)
        table[128:] = OTHER
        for batch in common.batches(stream):
            codes, _, vocabulary = common.split_words(batch.column(0), lower=True)
            if not len(codes):
                continue
            times = np.bincount(codes, minlength=len(vocabulary))
            data = " ".join(re.sub(r"[^\W\d_a-z]", "\x80", w) for w in vocabulary).encode("latin-1", "replace")
            c = np.append(np.append([EDGE, EDGE], table[np.frombuffer(data, np.uint8)]), EDGE)
            spaces = np.frombuffer(data, np.uint8) == 32
            word = np.append(np.append([0, 0], np.cumsum(spaces)), spaces.sum())
            # Runs of edges between words count as one.
            keep = np.append(True, ~((c[1:] == EDGE) & (c[:-1] == EDGE) & (np.arange(1, len(c)) > 1)))
            c, word = c[keep], word[keep]
            before = c[1:-1]
            earlier = np.where(before == EDGE, EDGE, c[:-2])
            total += np.bincount((earlier * CLASSES + before) * CLASSES + c[2:], weights=times[word[1:-1]], minlength=CLASSES**3).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["gram", "n"])

    found = docs.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    return {r["gram"]: r["n"] for r in found}


def decode(word: str, model: CharModel) -> str:
    """The likeliest reading of a lower-case word, or of pieces with spaces between; exact over all states (the classes of the last two
    characters and the last character). Of equal readings the one found first stays. Time is linear in the length."""
    cost = model.cost
    # A reading is a chain of (character, reading before it), so that readings share their beginnings.
    states: dict[tuple[int, int, str], tuple[float, tuple | None]] = {(EDGE, EDGE, ""): (0.0, None)}
    for i, ch in enumerate(word):
        fresh: dict[tuple[int, int, str], tuple[float, tuple | None]] = {}

        def put(key: tuple[int, int, str], total: float, read: tuple | None, fresh=fresh) -> None:
            if key not in fresh or total < fresh[key][0]:
                fresh[key] = (total, read)

        letter = ch.isalpha()
        repeated = i > 0 and word[i - 1] == ch
        again = REPEAT if repeated and i > 1 and word[i - 2] == ch else DOUBLED  # doubled letters are often meant
        for (a, b, last), (c, read) in states.items():
            if letter:
                k = ord(ch) - 97 if "a" <= ch <= "z" else OTHER
                put((b, k, ch), c + cost[a, b, k], (ch, read))
                if repeated:
                    put((a, b, last), c + again, read)
            elif ch == " ":
                put((EDGE, EDGE, ""), c + cost[a, b, EDGE], (ch, read))
                put((a, b, last), c + CLOSE, read)
            else:
                for x in LEET.get(ch, ""):
                    k = ord(x) - 97
                    put((b, k, x), c + LOOK + cost[a, b, k], (x, read))
                put((a, b, last), c + (again if repeated and ch in _LOOKS else REPEAT if repeated else DROP_LOOK if ch in _LOOKS else DROP if not ch.isdigit() else KEEP_SIGN), read)
        states = fresh
    best, read = None, None
    for (a, b, _), (c, found) in states.items():
        if best is None or c + cost[a, b, EDGE] < best:
            best, read = c + cost[a, b, EDGE], found
    out = []
    while read is not None:
        out.append(read[0])
        read = read[1]
    return "".join(reversed(out))


def undoubled(word: str, model: CharModel) -> str:
    """As ``decode`` of a word of letters, none of them threefold: whether a doubled letter is one depends on its neighbours alone."""
    c, cost = [EDGE, *classes_of(word), EDGE], model.cost
    out = []
    for i, ch in enumerate(word):
        if i and word[i - 1] == ch:
            k = c[i + 1]
            if cost[c[i - 1], k, k] + cost[k, k, c[i + 2]] - cost[c[i - 1], k, c[i + 2]] > DOUBLED:
                continue
        out.append(ch)
    return "".join(out)


def bare(word: str) -> str:
    """A word without adornment: signs three times over or more at its end, signs that stand for no letter at both
    ends, and exclamation marks and their like behind a letter."""
    start, end = 0, len(word)
    while end and not (word[end - 1].isalnum() or word[end - 1] == "_"):
        first = end - 1
        while first and word[first - 1] == word[end - 1]:
            first -= 1
        if end - first < 3:
            break
        end = first
    while start < end and not (word[start].isalnum() or word[start] in _SIGNS):
        start += 1
    while end > start and not (word[end - 1].isalnum() or word[end - 1] in _SIGNS):
        end -= 1
    stop = end
    while stop > start and word[stop - 1] in "!+(|":
        stop -= 1
    return word[start:stop] if stop > start and (word[stop - 1].isalnum() or word[stop - 1] == "_") else word[start:end]


def restore(word: str, model: CharModel) -> str:
    """A word without adornment, in lower case and in plain forms of its characters, as decoded. ``word`` may be pieces with spaces between."""
    if not word.isascii():
        word = unicodedata.normalize("NFKC", word)
    low = word.lower().rstrip(".,;:?")
    if low.isalpha() and not _DOUBLE.search(low):  # as almost all words
        return low
    if " " in low:
        return decode(low, model)
    low = bare(low)
    if low.isalpha() and not _TRIPLE.search(low):
        return undoubled(low, model)
    signs = sum(c in LEET and not c.isdigit() for c in low)
    letters = any(c.isalpha() for c in low)
    # Digits with fewer signs are a number, and two signs hide no word.
    return decode(low, model) if letters or signs >= max(1, sum(map(str.isdigit, low))) and sum(c in LEET for c in low) > 2 else low


def words_of(texts: pa.Array, known) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Codes of the restored words of each text, their texts, and the restored words. ``known`` restores a word.

    Letters that stand alone, three or more in a row, make one more word; so do two short neighbours that read best as one, and what reads as one in a run of
    short words with a stray letter or sign.
    """
    codes, offsets, vocabulary = common.split_words(texts)
    restored = [known(w) for w in vocabulary]
    owner = common.owners(offsets)
    more_codes, more_owner = [], []

    def runs_of(fits: list[bool], some: np.ndarray) -> list[np.ndarray]:
        """Places of neighbouring words of one text that fit, of those runs where ``some`` is true of a word."""
        at = np.flatnonzero(np.array(fits, bool)[codes]) if len(codes) else np.zeros(0, np.int64)
        if not len(at):
            return []
        starts = np.append(0, np.flatnonzero((np.diff(at) != 1) | (owner[at[1:]] != owner[at[:-1]])) + 1)
        ends = np.append(starts[1:], len(at))
        asked = np.flatnonzero(np.logical_or.reduceat(some[codes[at]], starts) & (ends - starts > 1))
        return [at[starts[i] : ends[i]] for i in asked]

    single = [len(w) == 1 and (w.isalnum() or w in LEET) for w in vocabulary]
    for run in runs_of(single, np.ones(len(vocabulary), bool)):
        if len(run) >= 3:
            more_codes.append(len(restored))
            more_owner.append(owner[run[0]])
            restored.append(known("".join(vocabulary[c] for c in codes[run])))
    stray = np.array([len(w) == 1 and (w.isalpha() and w.lower() not in ALONE or w in LEET and not w.isdigit()) for w in vocabulary], bool)
    if stray.any():
        for run in runs_of([len(w) <= RUN and all(c.isalpha() or c in LEET for c in w) for w in vocabulary], stray):
            pieces = [vocabulary[c] for c in codes[run]]
            own = [k for k, p in enumerate(pieces) if p.lower() not in ALONE]  # words of one letter are pieces only between others
            pieces = pieces[own[0] : own[-1] + 1]
            whole = {p.lower() for p in pieces}
            for w in known(" ".join(pieces)).split():
                if w not in whole:
                    more_codes.append(len(restored))
                    more_owner.append(owner[run[0]])
                    restored.append(w)
    short = np.array([len(w) <= PIECE and w[:1].isalpha() and w.isalnum() for w in vocabulary], bool)
    if len(codes) > 1 and short.any():
        first = np.flatnonzero(short[codes[:-1]] & short[codes[1:]] & (owner[:-1] == owner[1:]))
        pairs, which = np.unique(codes[first] * len(vocabulary) + codes[first + 1], return_inverse=True)
        joined = [known(f"{vocabulary[p // len(vocabulary)]} {vocabulary[p % len(vocabulary)]}") for p in pairs.tolist()]
        made = np.array([" " not in w for w in joined], bool)
        number = np.cumsum(made) - 1 + len(restored)
        restored += [w for w in joined if " " not in w]
        more_codes += number[which[made[which]]].tolist()
        more_owner += owner[first[made[which]]].tolist()
    return np.append(codes, np.array(more_codes, np.int64)), np.append(owner, np.array(more_owner, np.int64)), restored


def grams(word: str) -> list[str]:
    """The word itself and its character 5-grams."""
    return ["=" + word, *{word[i : i + 5] for i in range(len(word) - 4)}] if word else []


@dataclass
class Model:
    chars: CharModel
    weights: dict[str, float]
    bias: float


def _remembered(f: Callable[[str], object]) -> Callable[[str], object]:
    """With a memory of words of up to 64 characters, so that it is bounded in bytes."""
    short = lru_cache(1 << 17)(f)
    return lambda w: short(w) if len(w) <= 64 else f(w)


class Reader:
    """Restores and looks up words with a memory of bounded size; one per Python task."""

    def __init__(self, chars: CharModel, features: dict[str, int] | None = None):
        self.restore = _remembered(lambda w: restore(w, chars))
        if features is not None:
            self.hits = _remembered(lambda w: tuple(sorted({features[g] for g in grams(w) if g in features})))

    def features(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (text, feature) pairs."""
        codes, owner, restored = words_of(texts, self.restore)
        hits = [self.hits(w) for w in restored]
        some = np.array([bool(h) for h in hits], bool)
        pick = np.flatnonzero(some[codes]) if len(codes) else np.zeros(0, int)
        pairs = {(int(owner[i]), f) for i in pick for f in hits[codes[i]]}
        who, what = (np.array(x, np.int64) for x in zip(*sorted(pairs), strict=True)) if pairs else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        return who, what


def fit(docs: DataFrame, labels: DataFrame, sample: int = 8000, features: int = 1000, least: int = 5, steps: int = 1500, ridge: float = 0.2) -> Model:
    """Learn the character model from all texts of ``docs``, and the classifier from labelled rows.

    The classifier's rows are a bounded sample: about ``sample`` of ``labels`` (doc_id, toxic), by the hash of their ids, and all of
    them if they are fewer. Its features are the ``features`` words and n-grams that tell the labels apart best, out
    of those in at least ``least`` toxic rows. Labels without an id or a label teach nothing, of several labels of one id the greater counts; null and
    empty texts have no words, repeated rows count as often as they stand; without rows of both labels there are no weights, only the bias. Other columns are ignored.
    """
    spark = docs.sparkSession
    common.small_batches(spark)
    chars = CharModel.of(char_counts(docs))
    labels = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = min(1.0, sample / max(1, labels.count()))
    chosen = labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000)).select("doc_id", F.col("toxic").cast("long").alias("toxic"))
    rows = common.written(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("toxic", "text"), "toxic-sample")  # about ``sample`` rows
    shared = spark.sparkContext.broadcast(chars)

    def count(stream):
        reader, seen = Reader(shared.value), {}
        for batch in common.batches(stream):
            codes, owner, restored = words_of(batch.column(1), reader.restore)
            toxic = batch.column(0).to_pylist()
            by_text: dict[int, set[str]] = {}
            for d, c in set(zip(owner.tolist(), codes.tolist(), strict=True)):
                by_text.setdefault(d, set()).update(grams(restored[c]))
            for d, found in by_text.items():
                for g in found:
                    n = seen.setdefault(g, [0, 0])
                    n[toxic[d] > 0] += 1
            if len(seen) > 400_000:
                yield sent(seen)
                seen = {}
        yield sent(seen)

    def sent(seen: dict[str, list[int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array([n[1] for n in seen.values()], pa.int64()), pa.array([n[0] for n in seen.values()], pa.int64())], names=["gram", "toxic", "clean"])

    sizes = {bool(r["toxic"]): r["n"] for r in rows.groupBy((F.col("toxic") > 0).alias("toxic")).agg(F.count("*").alias("n")).collect()}
    bad, good = sizes.get(True, 0), sizes.get(False, 0)
    if not bad or not good:
        return Model(chars, {}, math.log((bad + 0.5) / (good + 0.5)))
    tally = rows.mapInArrow(count, "gram string, toxic long, clean long").groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    p, q = (F.col("toxic") + 0.5) / (bad + 1), (F.col("clean") + 0.5) / (good + 1)
    gain = F.abs(F.log(p / q)) * F.sqrt(F.greatest("toxic", "clean"))
    best = tally.where(F.col("toxic") >= least).where(p > q * 2).orderBy(gain.desc(), "gram").limit(features).collect()
    names = {r["gram"]: i for i, r in enumerate(sorted(best, key=lambda r: r["gram"]))}
    known = spark.sparkContext.broadcast(names)

    def vectors(stream):
        reader = Reader(shared.value, known.value)
        for batch in common.batches(stream):
            who, what = reader.features(batch.column(1))
            ends = np.searchsorted(who, np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(what))], names=["toxic", "features"])

    # Rows with the same label and features count together.
    data = rows.mapInArrow(vectors, "toxic long, features array<long>").groupBy((F.col("toxic") > 0).cast("int").alias("y"), "features").agg(F.count("*").alias("n")).collect()
    data.sort(key=lambda r: (r["y"], r["features"]))
    y, n = np.array([r["y"] for r in data], float), np.array([r["n"] for r in data], float)
    row = np.repeat(np.arange(len(data)), [len(r["features"]) for r in data])
    column = np.array([f for r in data for f in r["features"]], int)
    w, bias = np.zeros(len(names)), math.log(bad / good)
    support = np.bincount(column, n[row], len(w))
    for _ in range(steps):  # ascent on the penalised likelihood, each weight at the pace of its own curvature
        z = bias + np.bincount(row, w[column], len(data))
        gap = n * (y - 1 / (1 + np.exp(-np.clip(z, -30, 30))))
        w += (np.bincount(column, gap[row], len(w)) - ridge * w) / (2 * support + ridge)
        bias += gap.sum() / n.sum()
    return Model(chars, {g: float(w[i]) for g, i in names.items()}, float(bias))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, predicted) for each row: score from 0 to 1, predicted 1 from 0.5 on.

    A null or empty text scores what the bias says; whole texts are read; repeated rows and null ids are rows like others;
    extra columns are ignored.
    """
    common.small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by fit's parameters

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = sorted(shared.value.weights)
        weights = np.array([shared.value.weights[g] for g in names])
        reader = Reader(shared.value.chars, {g: i for i, g in enumerate(names)})
        for batch in common.batches(stream):
            who, what = reader.features(batch.column(1))
            z = shared.value.bias + np.bincount(who, weights[what] if len(what) else None, batch.num_rows)
            p = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double, predicted int")
