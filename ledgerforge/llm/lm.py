"""Language-model scores from a log-frequency Bloom filter of n-gram counts.

Word unigrams and bigrams are counted exactly over all training texts by a shuffle. A count is quantised to
a level, and the filter holds an n-gram once for each level up to its own, so probing level after level until
one is missing gives the level back. The filter is cut into segments by n-gram hash; each is filled by the task that
counts its n-grams, with so many bits for each of its entries that false hits are as rare at every size. The
filter is broadcast in pieces of a bounded size, one after the other: a pass over the texts probes one piece and notes the levels found,
one byte for each token and n-gram. Probabilities interpolate: all bigrams that were seen, and for the rest of a context's mass the
add-one unigram; none is above 1.

Exact unigram counts (the base score) come from a bounded table of the commonest words, broadcast; what other
words a document holds is joined with the count table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerforge.llm import common

SEGMENTS = 4096
PROBES = 3
#: Bits of the filter for each n-gram and level that it holds: 1.7 % of probes for an absent one hit.
ENTRY_BITS = 10
#: Bytes of the filter that are broadcast at once, at most.
PIECE_BYTES = 256 << 20
#: Levels of unigrams go up by a factor of sqrt(2), those of bigrams by 2; level 1 is a count of one.
MOST_LEVELS = 128
END = common.hash_strings(["\n"])[0]
#: Words whose counts are broadcast: 16 MB at most. Others are joined.
HEAVY = 1 << 20


@dataclass
class Model:
    counts: DataFrame  # h, n of each training token
    filter: DataFrame  # segment, bits
    pieces: list[tuple[int, int]]  # first and last segment of each piece of the filter
    heavy: tuple[np.ndarray, np.ndarray]  # hashes, sorted, and counts of the commonest tokens
    tokens: int
    distinct: int
    mass: float  # of all unigrams as the filter gives them back
    seen: np.ndarray  # by level of the context: share of its mass that seen bigrams have


def token_stream(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all tokens, each text followed by the end token; the offsets of the texts; the hashes of the codes."""
    codes, offsets, words = common.split_hashes(texts)
    n = len(offsets) - 1
    out = np.full(len(codes) + n, len(words), np.int64)
    ends = offsets[1:] + np.arange(n)
    inner = np.ones(len(out), bool)
    inner[ends] = False
    out[inner] = codes
    return out, np.append(0, ends + 1), np.append(words, END)


def bigrams(tokens: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Of each token with the one before; each text begins after an end token."""
    with np.errstate(over="ignore"):
        first, second = words * np.uint64(0x9E3779B97F4A7C15), common.mix(words)
        out = second[tokens]
        out[1:] += first[tokens[:-1]]
        out[:1] += first[-1:]
        return common.mix(out)


def level_of(n: np.ndarray, bigram: np.ndarray) -> np.ndarray:
    log = np.log2(np.maximum(n, 1).astype(np.float64)) + 1e-12
    return 1 + np.where(bigram, np.floor(log), np.floor(2 * log)).astype(np.int64)


def count_of(level: np.ndarray, bigram: bool) -> np.ndarray:
    """The count that a level stands for: the geometric middle; 0 for what is not in the filter."""
    level = level.astype(np.float64)
    return np.where(level > 1, 2.0 ** (level - 0.5 if bigram else (level - 1) / 2 + 0.25), level)


def _bits(h: np.ndarray, level: int) -> np.ndarray:
    """One word for each n-gram and level; its halves give the places of all probes."""
    with np.errstate(over="ignore"):
        return common.mix(h + np.uint64(0xD6E8FEB86659FD93) * np.uint64(level))


def _place(bits: np.ndarray, probe: int, size: np.ndarray | np.uint64) -> np.ndarray:
    """Bit of a probe inside the n-gram's segment of ``size`` bits, at most 2 ** 32."""
    half = np.uint64(0xFFFFFFFF)
    return (((bits & half) + np.uint64(probe) * ((bits >> np.uint64(32)) | np.uint64(1)) & half) * size) >> np.uint64(32)


def _hits(filled: tuple[np.ndarray, np.ndarray], h: np.ndarray, level: int) -> np.ndarray:
    """Which of the n-grams have the level."""
    data, starts = filled
    segment = (h & np.uint64(SEGMENTS - 1)).astype(np.int64)
    base = starts[segment]
    left, bits, size = np.arange(len(h)), _bits(h, level), (starts[segment + 1] - base).astype(np.uint64) * np.uint64(8)
    some = np.flatnonzero(size)
    if len(some) < len(left):
        left, bits, base, size = left[some], bits[some], base[some], size[some]
    for probe in range(PROBES):
        at = _place(bits, probe, size)
        hit = np.flatnonzero((data[base + (at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1))
        left, bits, base, size = left[hit], bits[hit], base[hit], size[hit]
    return left


def levels(filled: tuple[np.ndarray, np.ndarray], h: np.ndarray) -> np.ndarray:
    """Levels of n-grams, by probing from level 1 until a probe misses."""
    out = np.zeros(len(h), np.int64)
    left = np.arange(len(h))
    for level in range(1, MOST_LEVELS):
        left = left[_hits(filled, h[left], level)]
        if not len(left):
            break
        out[left] = level
    return out


def _rows(h: np.ndarray, n: np.ndarray, bigram: bool, size: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(h), size):
        x = h[i : i + size]
        yield pa.RecordBatch.from_arrays([pa.array((x & np.uint64(SEGMENTS - 1)).astype(np.int32)), pa.array(np.full(len(x), bigram)), pa.array(common.long_signed(x)), pa.array(n[i : i + size])], names=["segment", "bigram", "h", "n"])


def _counted(stream: Iterator[pa.RecordBatch], room: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """Counts of n-grams, summed over ``room`` tokens before they are sent."""
    words, counts, pairs, held = [], [], [], 0

    def sent() -> Iterator[pa.RecordBatch]:
        if not held:
            return
        h, n = np.concatenate(words), np.concatenate(counts)
        order = np.argsort(h)
        h, n = h[order], n[order]
        first = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
        yield from _rows(h[first], np.add.reduceat(n, first), False)
        h = np.sort(np.concatenate(pairs))
        first = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
        yield from _rows(h[first], np.diff(np.append(first, len(h))), True)

    for batch in common.batches(stream):
        tokens, _, own = token_stream(batch.column(0))
        n = np.bincount(tokens, minlength=len(own))
        some = n > 0
        words.append(own[some])
        counts.append(n[some])
        pairs.append(bigrams(tokens, own))
        held += len(tokens)
        if held > room:
            yield from sent()
            words, counts, pairs, held = [], [], [], 0
    yield from sent()


def fit(docs: DataFrame, entry_bits: float = ENTRY_BITS, piece_bytes: int = PIECE_BYTES) -> Model:
    """Learn from all ``text`` of ``docs`` (null: empty). The filter grows with the n-grams: ``entry_bits`` for each level of each."""
    model = _counts(docs, entry_bits, piece_bytes)
    model.seen = _seen(_probed(docs, model))
    return model


def fit_and_score(docs: DataFrame, learns: Column, entry_bits: float = ENTRY_BITS, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """``score`` of all ``docs`` by the model of those that ``learns`` is true for, with one pass over the texts fewer. Null texts count as empty, repeated rows
    and null ids are rows like others, an empty table gives no row; without a text to learn from the counts are all 0."""
    model = _counts(docs.where(learns), entry_bits, piece_bytes)
    rows = _probed(docs, model, learns)
    model.seen = _seen(rows.where("learns"))
    return _scores(rows, model)


def _counts(docs: DataFrame, entry_bits: float, piece_bytes: int) -> Model:
    """All of the model but ``seen``."""
    common.small_batches(docs.sparkSession)
    counts = docs.select("text").mapInArrow(_counted, "segment int, bigram boolean, h long, n long")
    # Tasks have summed already; a segment's n-grams meet in one partition.
    counts = counts.repartition("segment").groupBy("segment", "bigram", "h").agg(F.sum("n").alias("n"))

    def fill(stream):
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for _, bigram, h, n in _slabs(stream):
            held.append((h, level_of(n, bigram).astype(np.uint8)))
            one = ~bigram
            k = int(one.sum())
            yield pa.RecordBatch.from_arrays([pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary()), pa.array(common.long_signed(h[one])), pa.array(n[one])], names=["segment", "bits", "h", "n"])
        if not held:
            return
        h, level = (np.concatenate(x) for x in zip(*held, strict=True))
        segment = (h & np.uint64(SEGMENTS - 1)).astype(np.int16)
        order = np.argsort(segment, kind="stable")
        own, first = np.unique(segment[order], return_index=True)
        for s, at in zip(own.tolist(), np.split(order, first[1:]), strict=True):
            x = _filled(h[at], level[at], entry_bits)
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([x.tobytes()]), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64())], names=["segment", "bits", "h", "n"])

    both = common.written(counts.mapInArrow(fill, "segment int, bits binary, h long, n long"), "ngrams")
    bits = both.where("segment is not null").select("segment", "bits")
    sizes = {r["segment"]: r["size"] for r in bits.select("segment", F.octet_length("bits").alias("size")).collect()}
    pieces, room = [(0, SEGMENTS - 1)], piece_bytes
    for s in range(SEGMENTS):
        if sizes.get(s, 0) > room and s > pieces[-1][0]:
            pieces[-1:] = [(pieces[-1][0], s - 1), (s, SEGMENTS - 1)]
            room = piece_bytes
        room -= sizes.get(s, 0)
    counts = both.where("segment is null").select("h", "n")
    by_level = counts.groupBy(F.least("n", F.lit(1000)).alias("n")).agg(F.count("*").alias("words")).collect()
    quantised = counts.groupBy((1 + F.floor(2 * F.log2("n") + 2e-12)).alias("level")).agg(F.count("*").alias("words"), F.sum("n").alias("tokens")).collect()
    distinct, tokens = sum(r["words"] for r in by_level), sum(r["tokens"] for r in quantised)
    mass = float(sum(count_of(np.array([r["level"]]), False)[0] * r["words"] for r in quantised))
    above, least = 0, 1001
    for r in sorted(by_level, key=lambda r: -r["n"]):
        above += r["words"]
        if above > HEAVY:
            break
        least = r["n"]
    top = counts.where(F.col("n") >= least).toArrow() if distinct else pa.table({"h": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
    h, n = top.column("h").to_numpy().view(np.uint64), top.column("n").to_numpy()
    order = np.argsort(h)
    return Model(counts, bits, pieces, (h[order], n[order]), tokens, distinct, mass, np.zeros(MOST_LEVELS))


def _piece(model: Model, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """The filter's bytes in some segments, and where each segment starts and the last ends; others are empty."""
    rows = model.filter.where(F.col("segment").between(first, last)).toLocalIterator()
    parts = {r["segment"]: np.frombuffer(r["bits"], np.uint8) for r in rows}
    none = np.zeros(0, np.uint8)
    whole = [parts.pop(s, none) for s in range(SEGMENTS)]
    return np.concatenate(whole), np.append(0, np.cumsum([len(x) for x in whole]))


def _filled(h: np.ndarray, level: np.ndarray, entry_bits: float) -> np.ndarray:
    """The bytes of one segment."""
    out = np.zeros((int(level.sum(dtype=np.int64) * entry_bits) + 7) // 8, np.uint8)
    size = np.uint64(len(out) * 8)
    for j in range(1, MOST_LEVELS):
        h, level = h[level >= j], level[level >= j]
        if not len(h):
            break
        word = _bits(h, j)
        for probe in range(PROBES):
            at = _place(word, probe, size)
            np.bitwise_or.at(out, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
    return out


def _slabs(stream: Iterator[pa.RecordBatch], rows: int = 1 << 19) -> Iterator[list[np.ndarray]]:
    """Columns of many batches together."""
    held, n = [], 0
    for batch in common.batches(stream):
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield _joined(held)
            held, n = [], 0
    if held:
        yield _joined(held)


def _joined(held: list[pa.RecordBatch]) -> list[np.ndarray]:
    t = pa.Table.from_batches(held).combine_chunks()
    segment, bigram, h, n = (t.column(i).to_numpy() for i in range(4))
    return [segment, bigram, h.view(np.uint64), n]


def _probed(docs: DataFrame, model: Model, learns: Column | None = None) -> DataFrame:
    """Each row with what the exact counts of common words say of it, its other words, and the levels of its tokens and bigrams, one byte each:
    (row, doc_id, learns, n_tokens, known, base, rest, own, pair). A pass for each piece of the filter."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model.heavy)
    names = ["n_tokens", "known", "base", "rest", "own", "pair"]
    kinds = ["n_tokens long", "known long", "base double", "rest array<struct<h:long,times:long>>", "own binary", "pair binary"]

    def by_word(stream):
        heavy, heavy_n = shared.value
        for batch in common.batches(stream):
            at, offsets, words = token_stream(batch.column(3))
            n = batch.num_rows
            owner = np.repeat(np.arange(n), np.diff(offsets))
            spot = np.minimum(np.searchsorted(heavy, words), max(0, len(heavy) - 1))
            common_word = heavy[spot] == words if len(heavy) else np.zeros(len(words), bool)
            logs = np.where(common_word, np.log10((heavy_n[spot] if len(heavy) else np.zeros(len(words))) + 1.0), 0.0)
            base = np.bincount(owner, logs[at], n)
            known = np.bincount(owner, common_word[at], n).astype(np.int64)
            # What the bounded table lacks, once for each word of a text.
            rare = np.flatnonzero(~common_word[at])
            key = np.sort(owner[rare] * len(words) + at[rare])
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, int)
            times = np.diff(np.append(first, len(key)))
            o, w = np.divmod(key[first], len(words))
            ends = np.searchsorted(o, np.arange(n + 1)).astype(np.int32)
            rest = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(common.long_signed(words[w])), pa.array(times.astype(np.int64))], names=["h", "times"]))
            yield batch, (at, offsets, words), [pa.array(np.diff(offsets)), pa.array(known), pa.array(base), rest]

    def again(stream):
        for batch in common.batches(stream):
            yield batch, token_stream(batch.column(3)), batch.columns[4:8]

    def probe(piece, first: bool, last: bool):
        def run(stream):
            for batch, (at, offsets, words), columns in by_word(stream) if first else again(stream):
                own, pair = (levels(piece.value, h).astype(np.uint8) for h in (words, bigrams(at, words)))
                own, ends = own[at], pa.array(offsets.astype(np.int32))
                if not first:
                    own, pair = (np.maximum(x, np.frombuffer(b"".join(batch.column(8 + i).to_pylist()), np.uint8)) for i, x in enumerate((own, pair)))
                found = [pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, ends.buffers()[1], pa.py_buffer(x.tobytes())]) for x in (own, pair)]
                yield pa.RecordBatch.from_arrays([*batch.columns[: 3 if last else 4], *columns, *found], names=["row", "doc_id", "learns", *([] if last else ["text"]), *names])

        return run

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), (F.lit(True) if learns is None else learns).alias("learns"), "text")
    for i, ends in enumerate(model.pieces):
        last = i == len(model.pieces) - 1
        piece = spark.sparkContext.broadcast(_piece(model, *ends))  # of PIECE_BYTES, or one segment
        schema = ", ".join(["row long", "doc_id long", "learns boolean", *([] if last else ["text string"]), *kinds])
        rows = common.written(rows.mapInArrow(probe(piece, i == 0, last), schema), "lm-rows")
        piece.unpersist()
    return rows


def _noted(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Levels of the tokens, of their bigrams and of the tokens before (an end token before the first) from the
    columns ``own`` and ``pair``, and where each text starts."""
    own, pair = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8) for c in ("own", "pair"))
    ends = np.cumsum(pc.binary_length(batch.column("own")).to_numpy())
    starts = np.append(0, ends[:-1])
    before = np.roll(own, 1)
    before[starts] = own[ends - 1]  # the last token is an end token
    return own, pair, before, starts


def _seen(rows: DataFrame) -> np.ndarray:
    """By level of the context, the share of its mass that seen bigrams have: n of n tokens and those of them whose bigram
    was seen once, as often as which a new one is expected."""

    def run(stream):
        total, hit = np.zeros(MOST_LEVELS, np.int64), np.zeros(MOST_LEVELS, np.int64)
        for batch in common.batches(stream):
            _, pair, before, _ = _noted(batch)
            total += np.bincount(before, minlength=MOST_LEVELS)
            hit += np.bincount(before[pair >= 2], minlength=MOST_LEVELS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(MOST_LEVELS)), pa.array(total), pa.array(hit)], names=["level", "total", "hit"])

    out = np.zeros(MOST_LEVELS)
    for r in rows.select("own", "pair").mapInArrow(run, "level long, total long, hit long").groupBy("level").agg(F.sum("hit").alias("hit"), F.sum("total").alias("total")).collect():
        out[r["level"]] = r["total"] / (2 * r["total"] - r["hit"]) if r["total"] else 0.0
    return np.minimum(out, 0.99)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) for each row; extra columns are ignored.

    Base: the sum over the words and one end token of log10((c + 1) / (N + V + 1)). A null or empty text has the end token
    only; whole texts count; repeated rows and null ids are rows like others. ``score`` is the model's log10 probability.
    """
    common.small_batches(docs.sparkSession)
    return _scores(_probed(docs, model), model)


def _scores(rows: DataFrame, model: Model) -> DataFrame:
    every = np.arange(MOST_LEVELS)
    count, twice = np.minimum(count_of(every, False), max(model.mass, 1.0)), count_of(every, True)
    unigram = (count + 1) / (max(model.mass, 1.0) + model.distinct + 1)
    part, tokens_in_all = model.seen, model.tokens

    def run(stream):
        for batch in common.batches(stream):
            own, pair, before, starts = _noted(batch)
            p = (1 - part)[before] * unigram[own]
            some = np.flatnonzero(pair)
            b = before[some]
            p[some] += part[b] * np.minimum(twice[pair[some]], count[b]) / np.maximum(count[b], 1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(np.add.reduceat(np.log10(p), starts))], names=["row", "doc_id", "n_tokens", "known", "base", "score"])

    scored = rows.select("row", "doc_id", "n_tokens", "known", "base", "own", "pair").mapInArrow(run, "row long, doc_id long, n_tokens long, known long, base double, score double")
    rest = rows.select("row", F.explode("rest").alias("r")).select("row", "r.h", "r.times").join(model.counts, "h")
    rest = rest.groupBy("row").agg(F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("logs"))
    out = scored.join(rest, "row", "left")
    base = F.col("base") + F.coalesce("logs", F.lit(0.0)) - F.col("n_tokens") * F.lit(math.log10(tokens_in_all + model.distinct + 1))
    return out.select("doc_id", "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(tokens_in_all).cast("long").alias("train_tokens"), base.alias("base_score"), "score")
