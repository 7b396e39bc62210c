"""Personal data: fixed patterns first, then a skip-chain conditional random field adds spans.

The field's nodes are the candidates of a document: tokens that hold a digit or an at sign (all other
tokens are observed as ``none`` and cut the chain). Its factors are token features, neighbouring
candidates (chain) and distant candidates that repeat one another, share a skeleton or one half of it (skip chain: what they
share is a node of its own, tied to each occurrence, so the ties are linear in number and neither distance nor number of the
repeats weakens them). Where a pattern found a span, its keys are known to be of that kind. Weights are learned from the spans of the
patterns by pseudo-likelihood on a bounded sample; sum-product messages are passed over the loopy graph
of each document, all documents of a batch at once. A candidate without a pattern's span gets one
if its marginal is high and a candidate tied to it, directly or over others, has one of that kind.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerforge.llm import common

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_DIGITS = re.compile(r"[^0-9]")
#: An at sign as a word, and a run that holds digits, with what joins them.
_AT_WORD = re.compile(r"[\[(](?:at|AT)[\])]")
_NUMBER = re.compile(r"\+?[0-9](?:[ ().-]{0,3}[0-9])*")
_SPACE = re.compile(r"\s")
_WORD_START = frozenset(" \t\n\v\f\r@[(")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else (n * 2 - 9 if n > 4 else n * 2)
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    """Leftmost matches of local part, at sign and dotted domain, found from the at signs in linear time."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append(("email", start, m.end()))
            done = m.end()
        else:
            done = at + 1
        at = text.find("@", max(at + 1, done))
    return out


def base_spans(text: str | None) -> list[Span]:
    """What the patterns find, by start and then kind; a null text has none."""
    if not text:
        return []
    out = emails(text)
    if _DIGIT.search(text):
        for m in _DOTTED.finditer(text):
            if m[0].count(".") >= 3:
                parts, at = [], m.start()
                for part in m[0].split("."):
                    parts.append((part, at, at + len(part)))
                    at += len(part) + 1
                for i in range(0, len(parts) - 3, 4):
                    four = parts[i : i + 4]
                    if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p, _, _ in four):
                        out.append(("ip", four[0][1], four[3][2]))
        for m in _CARD.finditer(text):
            if 12 <= len(digits := _DIGITS.sub("", m[0])) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGITS.sub("", m[0])) <= 15:
                out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


@dataclass
class Graph:
    """Candidates of some documents as one graph."""

    spans: list[list[tuple[int, int]]]  # of each document
    labels: np.ndarray  # by the patterns; 0: none
    features: np.ndarray  # (nodes, features)
    edges: np.ndarray  # (edges, 2): first node is the earlier one
    skip: np.ndarray  # of edges: whether it is of the skip chain
    doc: np.ndarray


FEATURES = ("one", "at", "at word", "plus", "dots", "hyphens", "spaces", "parens", "letters", "digits<7", "digits 7-8", "digits 9-11", "digits 12-15", "digits 16", "digits 17+", "groups=1", "groups=4", "groups other", "part>255", "domain tail", "lonely", "in word", "four bytes", "key")


def candidates(text: str) -> list[tuple[int, int]]:
    """Tokens with an at sign; what stands on both sides of an at word; other runs of digits. From the left, in linear time."""
    found: list[tuple[int, int]] = []
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and not text[start - 1].isspace():
            start -= 1
        end = m.start() if (m := _SPACE.search(text, at)) else len(text)
        found.append((start, end))
        done, at = end, text.find("@", end)
    done = 0
    for m in _AT_WORD.finditer(text):
        start = m.start() - (m.start() > done and text[m.start() - 1].isspace())
        first = start
        while first > done and text[first - 1] not in _WORD_START:
            first -= 1
        if first < start:
            after = m.end() + (text[m.end() : m.end() + 1].isspace())
            end = n.start() if (n := _SPACE.search(text, after)) else len(text)
            if end > after:
                found.append((first, end))
                done = end
    found.sort()
    if _DIGIT.search(text):
        numbers = [m.span() for m in _NUMBER.finditer(text)]
        found = sorted(numbers + found)
    out: list[tuple[int, int]] = []
    marked = [s for s in found if "@" in text[s[0] : s[1]] or _AT_WORD.search(text, *s)]
    i = 0
    for s in found:
        while i < len(marked) and marked[i][1] <= s[0]:
            i += 1
        # Numbers inside a marked candidate are part of it; of two marked ones that overlap the first stays.
        if (not out or s[0] >= out[-1][1]) and (i == len(marked) or s == marked[i] or s[1] <= marked[i][0]):
            out.append(s)
    return out


def features(text: str, a: int, b: int) -> list[float]:
    """What a candidate looks like; neither checksum nor pattern, so that the field can judge what they miss."""
    s = text[a:b]
    digits, groups = _DIGITS.sub("", s), re.split(r"[^0-9]+", s.strip("+().- "))
    n, at = len(digits), "@" in s
    word = bool(re.search(r"[\[(](?:at|AT)[\])]", s))
    plain = not at and not word
    groups = [g for g in groups if g]
    return [
        1, at, word, plain and s[0] == "+", plain and s.count(".") == 3, plain and "-" in s, plain and " " in s, plain and "(" in s, not plain,
        plain and n < 7, plain and 7 <= n < 9, plain and 9 <= n < 12, plain and 12 <= n < 16, plain and n == 16, plain and n > 16,
        plain and len(groups) == 1, plain and len(groups) == 4, plain and len(groups) not in (1, 4), plain and any(len(g) > 3 or int(g) > 255 for g in groups), bool(re.search(r"\.[A-Za-z]{2,}\W*$", s)), plain and n == 1,
        plain and (text[a - 1 : a].isalpha() or text[b : b + 1].isalpha()), plain and len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups), 0,
    ]


def skeleton(s: str) -> str:
    """What repeated or similar candidates share: their letters and digits, an at sign for an at word; a leading country 1 falls away."""
    s = re.sub(r"\s?[\[(](?:at|AT)[\])]\s?", "@", s).lower()
    if "@" in s:
        return re.sub(r"[^a-z0-9@]", "", s)
    digits = _DIGITS.sub("", s)
    return digits[1:] if len(digits) == 11 and digits[0] == "1" else digits


def ties(s: str) -> list[str]:
    """What candidates that repeat one another have in common: the skeleton, of numbers of nine digits or more also each half of it, so
    that one changed digit keeps the tie; of four numbers up to 255 these, whatever joins them."""
    key = skeleton(s)
    groups = re.findall(r"[0-9]+", s) if "@" not in key else []
    four = [".".join(g.lstrip("0") or "0" for g in groups)] if len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups) else []
    if len(key) < 7:
        return four
    half = len(key) // 2
    return four + ([key, f"{len(key)}<{key[:half]}", f"{len(key)}>{key[half:]}"] if len(key) >= 9 and key.isdigit() else [key])


def graph(texts: list[str | None], bases: list[list[Span]]) -> Graph:
    spans, labels, rows, edges, skip, doc = [], [], [], [], [], []
    of_key = [0.0] * (len(FEATURES) - 1) + [1.0]
    for d, (text, base) in enumerate(zip(texts, bases, strict=True)):
        own: list[tuple[int, int]] = []
        if text and ("@" in text or _DIGIT.search(text) or "(at)" in text.lower() or "[at]" in text.lower()):
            shared: dict[str, list[int]] = {}
            first, at = len(labels), 0
            order = sorted(base, key=lambda s: (s[1], s[2]))
            for a, b in candidates(text):
                while b > a and text[b - 1] in ".,;:!?)'\"#$%&*":
                    b -= 1
                if b <= a:
                    continue
                node = len(labels)
                while at < len(order) and order[at][2] <= a:
                    at += 1
                kind, k = 0, at
                while not kind and k < len(order) and order[k][1] < b:
                    kind = LABELS.index(order[k][0]) if a < order[k][2] and (min(order[k][2], b) - max(order[k][1], a)) * 2 > b - a else 0
                    k += 1
                own.append((a, b))
                labels.append(kind)
                rows.append(features(text, a, b))
                doc.append(d)
                if node > first and a - own[-2][1] <= 40:
                    edges.append((node - 1, node))
                    skip.append(False)
                for key in ties(text[a:b]):
                    shared.setdefault(key, []).append(node)
            for nodes in shared.values():
                if len(nodes) > 1:
                    edges += [(node, len(labels)) for node in nodes]
                    skip += [True] * len(nodes)
                    labels.append(next((labels[node] for node in nodes if labels[node]), 0))
                    rows.append(of_key)
                    doc.append(d)
        spans.append(own)
    return Graph(spans, np.array(labels, int), np.array(rows, float).reshape(-1, len(FEATURES)), np.array(edges, int).reshape(-1, 2), np.array(skip, bool), np.array(doc, int))


@dataclass
class Weights:
    unary: np.ndarray  # (features, labels)
    chain: np.ndarray  # (labels, labels)
    skip: float  # for equal labels


def learn(g: Graph, steps: int = 3000, rate: float = 1.0, ridge: float = 1e-5, momentum: float = 0.9) -> Weights:
    """Pseudo-likelihood: each label given its neighbours' labels, by gradient ascent with momentum from zero."""
    k, n = len(LABELS), len(g.labels)
    w = Weights(np.zeros((len(FEATURES), k)), np.zeros((k, k)), 0.0)
    if not n:
        return w
    one = np.eye(k)[g.labels]
    left, right = g.edges[~g.skip].T.reshape(2, -1)
    a, b = g.edges[g.skip].T.reshape(2, -1)
    before, after = _summed(right, one[left], n), _summed(left, one[right], n)
    twin = _summed(np.concatenate([a, b]), one[np.concatenate([b, a])], n)
    many = np.maximum(1, twin.sum(1, keepdims=True))  # a key with very many ties must not set the pace of the one weight that all ties share
    step = Weights(np.zeros_like(w.unary), np.zeros_like(w.chain), 0.0)
    for _ in range(steps):
        score = g.features @ w.unary + before @ w.chain + after @ w.chain.T + w.skip * twin
        p = np.exp(score - score.max(1, keepdims=True))
        gap = one - p / p.sum(1, keepdims=True)
        step.unary = momentum * step.unary + rate * (g.features.T @ gap / n - ridge * w.unary)
        step.chain = momentum * step.chain + rate * ((before.T @ gap + (after.T @ gap).T) / n - ridge * w.chain)
        step.skip = momentum * step.skip + rate * ((gap * twin / many).sum() / n - ridge * w.skip)
        w = Weights(w.unary + step.unary, w.chain + step.chain, w.skip + step.skip)
    return w


def _summed(at: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Rows summed by the node that each is for."""
    return np.stack([np.bincount(at, rows[:, i], n) for i in range(rows.shape[1])], 1)


def marginals(g: Graph, w: Weights, rounds: int = 200, damping: float = 0.3, still: float = 1e-7) -> np.ndarray:
    """Sum-product on the loopy graph; labels that a pattern gave, and those of their keys, are evidence. Until no message moves by ``still``, or for
    ``rounds``, as messages may circle on a graph with loops."""
    k, n = len(LABELS), len(g.labels)
    if not n:
        return np.zeros((0, k))
    own, known = g.features @ w.unary, g.labels > 0
    if len(g.edges):
        # What evidence says to a neighbour is fixed, so its edges are factors of that neighbour alone.
        a, b = g.edges.T
        for to, of, chain in ((b, a, w.chain), (a, b, w.chain.T)):
            said = known[of]
            own = own + _summed(to[said], np.where(g.skip[said, None], w.skip * np.eye(k)[g.labels[of[said]]], chain[g.labels[of[said]]]), n)
        free = ~known[a] & ~known[b]
        edges, skip = g.edges[free], np.tile(g.skip[free], 2)
        source, target = np.concatenate([edges, edges[:, ::-1]]).T
        back = np.roll(np.arange(len(source)), len(edges))
        m = int((~g.skip[free]).sum())
        chain = np.exp(np.concatenate([np.repeat(w.chain[None], m, 0), np.repeat(w.chain.T[None], m, 0)]))
        message = np.zeros((len(source), k))
        for _ in range(rounds if len(edges) else 0):
            sent = (own + _summed(target, message, n))[source] - message[back]
            e = np.exp(sent - sent.max(1, keepdims=True))
            out = np.empty_like(e)
            out[skip] = np.log(e[skip].sum(1, keepdims=True) + np.expm1(w.skip) * e[skip])  # the same label weighs more, all others alike
            out[~skip] = np.log((e[~skip][:, :, None] * chain).sum(1))
            new = damping * message + (1 - damping) * (out - out.max(1, keepdims=True))
            moved = np.abs(new - message).max()
            message = new
            if moved < still:
                break
        own = own + _summed(target, message, n)
    own[known] = np.where(np.eye(k)[g.labels[known]] > 0, 0.0, -np.inf)
    p = np.exp(own - own.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def tied_kinds(g: Graph) -> np.ndarray:
    """Of each node the kinds that the patterns gave to what is tied to it, directly or over others, as bits."""
    root = list(range(len(g.labels)))

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in g.edges[g.skip].tolist():
        x, y = top(a), top(b)
        if x != y:
            root[max(x, y)] = min(x, y)
    tops = np.array([top(i) for i in range(len(root))], int)
    bits = np.zeros(len(root), int)
    np.bitwise_or.at(bits, tops, np.where(g.labels > 0, 1 << g.labels, 0))
    return bits[tops]


def added_spans(texts: list[str | None], bases: list[list[Span]], w: Weights, least: float = 0.9) -> list[list[Span]]:
    """Per document, the spans that the field adds: sure candidates tied to a pattern's span of the same kind."""
    g = graph(texts, bases)
    out: list[list[Span]] = [[] for _ in texts]
    if not g.skip.any():
        return out
    p = marginals(g, w)
    kind = p.argmax(1)
    tied = (tied_kinds(g) >> kind) & 1
    first = np.searchsorted(g.doc, np.arange(len(texts)))
    starts = [np.array([a for _, a, _ in base]) for base in bases]
    longest = [max((b - a for _, a, b in base), default=0) for base in bases]
    for i in np.flatnonzero((g.labels == 0) & (kind > 0) & (tied > 0) & (p.max(1) >= least)):
        d = g.doc[i]
        if i - first[d] >= len(g.spans[d]):  # a key
            continue
        a, b = g.spans[d][i - first[d]]
        near = range(*np.searchsorted(starts[d], [a - longest[d], b]))
        if not any(bases[d][k][1] < b and a < bases[d][k][2] for k in near):
            out[d].append((LABELS[kind[i]], a, b))
    return out


def altered(kind: str, s: str, n: int) -> str:
    """Another way to write what a span says; ``n`` chooses."""
    if kind == "email":
        return s.replace("@", (" [at] ", "(at)", "[AT]")[n % 3])
    if kind == "ip":
        return s.replace(".", ("-", " . ")[n % 2])
    digits = _DIGITS.sub("", s)
    if kind == "phone" and len(digits) == 11 and digits[0] == "1":
        digits = digits[1:]
    size = 4 if kind == "card" else 3
    cut = [digits[i : i + size] for i in range(0, len(digits), size)]
    return ("-", ".", " ", "")[n % 4].join(cut if kind == "card" or len(cut) < 3 else [*cut[:2], "".join(cut[2:])])


#: What stands between a span and its repeats, near and far. Without digits and at signs.
_BETWEEN = ("\nor rather ", " or ", ", that is, ", "\nand then there are some more words that say nothing of it, as in any letter, ", ". Much later, when all of this had long been said and done, it was written as ")


def repeated(text: str, most: int = 10) -> tuple[str, list[Span]]:
    """The text with its spans said again in other ways behind it, none to ``most`` times, near one another and far, and where: what teaches the field how
    much a tie tells."""
    more: list[Span] = []
    for n, (kind, a, b) in enumerate(base_spans(text)):
        for k in range((a + 3 * n) % (most + 1)):
            piece, between = altered(kind, text[a:b], n + a + k), _BETWEEN[(a + n + k) % len(_BETWEEN)]
            more.append((kind, len(text) + len(between), len(text) + len(between) + len(piece)))
            text = f"{text}{between}{piece}"
    return text, more


def all_spans(texts: list[str | None], w: Weights) -> list[list[Span]]:
    """The patterns' spans and those that the field adds, by start and kind."""
    bases = [base_spans(t) for t in texts]
    more = added_spans(texts, bases, w)
    return [sorted(b + m, key=lambda s: (s[1], KINDS.index(s[0]), s[2])) for b, m in zip(bases, more, strict=True)]


def fit(docs: DataFrame, buckets: int = 1024, piece: int = 20_000) -> Weights:
    """Learn the weights on a bounded sample, each text with altered repeats of its spans behind it: of the texts that hold a digit or an at sign, the one with the least hash
    in each of ``buckets`` hash buckets; of a text longer than ``piece`` characters a piece of so many, its place chosen by the hash.
    Null texts teach nothing, repeated texts count once; without any text all weights are zero."""
    rows = docs.select("text").where("text rlike '[0-9@]'").withColumn("h", F.xxhash64("text"))
    least = rows.groupBy(F.pmod("h", F.lit(buckets)).alias("b")).agg(F.min("h").alias("h")).select("h")
    room = F.greatest(F.length("text") - piece, F.lit(0)) + 1
    part = F.substring("text", F.pmod(F.shiftright("h", 20), room).cast("int") + 1, F.lit(piece))
    sample = rows.join(F.broadcast(least), "h").groupBy("h").agg(F.min(part).alias("text"))  # at most ``buckets`` rows

    def shrink(stream):
        for batch in common.batches(stream):
            texts, forced = zip(*[repeated(t) for t in batch.column(1).to_pylist()], strict=True)
            g = graph(list(texts), [more + base_spans(t) for t, more in zip(texts, forced, strict=True)])  # a repeat is what it repeats, whatever else it passes for
            for d in range(len(texts)):
                pick = g.doc == d
                inner = pick[g.edges[:, 0]] if len(g.edges) else np.zeros(0, bool)
                first = int(np.argmax(pick)) if pick.any() else 0
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(d, 1), pa.array([g.labels[pick].tolist()], pa.list_(pa.int64())), pa.array([g.features[pick].ravel().tolist()], pa.list_(pa.float64())), pa.array([(g.edges[inner] - first).ravel().tolist()], pa.list_(pa.int64())), pa.array([g.skip[inner].tolist()], pa.list_(pa.bool_()))], names=["h", "labels", "features", "edges", "skip"])

    found = sample.select("h", "text").mapInArrow(shrink, "h long, labels array<long>, features array<double>, edges array<long>, skip array<boolean>").collect()
    labels, rows_, edges, skip = [], [], [], []
    for r in sorted(found, key=lambda r: r["h"]):
        edges += [e + len(labels) for e in r["edges"]]
        labels += r["labels"]
        rows_ += r["features"]
        skip += r["skip"]
    return learn(Graph([], np.array(labels, int), np.array(rows_, float).reshape(-1, len(FEATURES)), np.array(edges, int).reshape(-1, 2), np.array(skip, bool), np.zeros(len(labels), int)))


def find(docs: DataFrame, weights: Weights, text: str = "text") -> DataFrame:
    """Every row with ``base`` and ``spans`` added: arrays of (kind, start, end) by start and kind, in code
    points, ends exclusive. ``spans`` holds all of ``base``. A null or empty text has empty arrays; the whole text is
    searched, whatever its length. Columns that have the added names are replaced."""
    common.small_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c not in ("base", "spans")]
    docs = docs.select(*[F.col(f"`{c}`") for c in kept])
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # a few hundred numbers
    kind = "array<struct<kind:string,start:int,end:int>>"
    made = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.batches(stream):
            texts = batch.column(kept.index(text)).to_pylist()
            bases, every = [base_spans(t) for t in texts], all_spans(texts, shared.value)
            columns = [pa.array([[dict(zip(("kind", "start", "end"), s, strict=True)) for s in x] for x in side], made) for side in (bases, every)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*kept, "base", "spans"])

    return docs.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields), f"base {kind}", f"spans {kind}"]))


def redact(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """Spans become ``<KIND>``; overlapping spans become one placeholder, of the first."""
    if not text or not spans:
        return text
    out, at = [], 0
    for kind, a, b in spans:
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def stage(docs: DataFrame) -> DataFrame:
    """All rows, with personal data in ``text`` replaced by placeholders and ``n_chars``, if there is one, counted anew where a text
    changed. Null and empty texts, repeated rows and null ids stay as they are; other columns may have any names."""
    columns = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), "text")
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs))  # a few hundred numbers
    common.small_batches(docs.sparkSession)

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        every = [t if isinstance(t, str) else None for t in texts]
        return pd.Series([redact(t, s) for t, s in zip(every, all_spans(every, shared.value), strict=True)], dtype=object)

    done = packed.select("row", clean("text").alias("clean"))
    changed = ~F.col("clean").eqNullSafe(F.col("row.text"))
    kinds = dict(docs.dtypes)
    anew = {"text": F.col("clean").cast(kinds["text"])}
    if "n_chars" in columns:
        anew["n_chars"] = F.when(changed, F.length("clean")).otherwise(F.col("row.n_chars")).cast(kinds["n_chars"])
    return done.select(*[anew.get(c, F.col(f"row.`{c}`")).alias(c) for c in columns])


def digest(spans: list[Span]) -> str:
    return hashlib.sha256(joined(spans).encode()).hexdigest()
