"""Near-duplicate embeddings by product quantisation.

Distinct vectors, scaled to length one, lie in coarse inverted lists: the cells of two codebooks, one for each half of the
dimensions (an inverted multi-index), so that few centroids make very many lists. What a cell's centre leaves of a vector is
coded subspace by subspace. A vector probes its own list and every list that a neighbour within reach can lie in; there
its distances to the codes come from a table of its distances to the subspace centroids. A code
whose distance, less the code's own error, is over the reach cannot be a neighbour; the rest are compared exactly, in
double precision.

A list is met in blocks of bounded size, members by probes. A block gives counts and a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerforge.llm import common
from ledgerforge.llm.neardup import components

#: Vectors that the codebooks are fitted on, at most (about); centroids of a half and of a subspace; dimensions of a subspace.
SAMPLE, HALF, CODES, WIDE = 16_384, 1024, 16, 4
#: Members and probes of a block; vectors that a list is planned for.
MEMBERS, PROBES, LIST = 1024, 4096, 64


def centroids(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """At most ``k`` centroids by Lloyd's rounds, from evenly spaced rows; an empty one stays where it was."""
    k = max(1, min(k, len(x)))
    out = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = nearest(x, out)
        n = np.bincount(near, minlength=k)
        sums = np.zeros_like(out)
        np.add.at(sums, near, x)
        out[n > 0] = sums[n > 0] / n[n > 0, None]
    return out


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared, of all rows to all centroids."""
    return np.maximum((x * x).sum(1)[:, None] + (c * c).sum(1)[None] - 2 * x @ c.T, 0)


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.concatenate([distances(x[i : i + 4096], c).argmin(1) for i in range(0, len(x), 4096)]) if len(x) else np.zeros(0, np.int64)


class Index:
    """Codebooks of the halves and of the subspaces, for vectors of one dimension."""

    def __init__(self, sample: np.ndarray, n: int):
        d = sample.shape[1]
        k = min(HALF, math.ceil(math.sqrt(n / LIST)))
        self.cut = d // 2
        self.halves = [centroids(sample[:, s], k) for s in self._halves(d)]
        self.gaps = [np.sqrt(distances(c, c)) for c in self.halves]
        rest = sample - self.centre(self.cells(sample))
        self.parts = [slice(i, min(i + WIDE, d)) for i in range(0, d, WIDE)]
        self.books = [centroids(rest[:, p], CODES) for p in self.parts]

    def _halves(self, d: int) -> list[slice]:
        return [slice(0, self.cut), slice(self.cut, d)] if self.cut else [slice(0, d)]

    def cells(self, x: np.ndarray) -> np.ndarray:
        cell = np.zeros(len(x), np.int64)
        for s, c in zip(self._halves(x.shape[1]), self.halves, strict=True):
            cell = cell * len(c) + nearest(x[:, s], c)
        return cell

    def centre(self, cell: np.ndarray) -> np.ndarray:
        if len(self.halves) == 1:
            return self.halves[0][cell]
        a, b = self.halves
        return np.hstack([a[cell // len(b)], b[cell % len(b)]])

    def codes(self, x: np.ndarray, cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Subspace codes, and how far the coded vector lies from the vector."""
        rest = x - self.centre(cell)
        codes = np.stack([nearest(rest[:, p], b) for p, b in zip(self.parts, self.books, strict=True)], 1)
        left = np.hstack([rest[:, p] - b[codes[:, i]] for i, (p, b) in enumerate(zip(self.parts, self.books, strict=True))])
        return codes.astype(np.uint8), np.sqrt((left * left).sum(1))

    def probes(self, x: np.ndarray, reach: float) -> list[np.ndarray]:
        """For each vector the lists whose border is at most ``reach`` away, its own too: the distance to a cell is, in each half,
        at least that to the plane between its centroid and the nearest."""
        away = []
        for s, c, gap in zip(self._halves(x.shape[1]), self.halves, self.gaps, strict=True):
            d = distances(x[:, s], c)
            own = d.argmin(1)
            to = (d - d[np.arange(len(x)), own][:, None]) / (2 * np.maximum(gap[own], 1e-12))
            to[np.arange(len(x)), own] = 0
            away.append(to * to)
        if len(away) == 1:
            return [np.flatnonzero(a <= reach * reach) for a in away[0]]
        return [np.flatnonzero((a[:, None] + b[None]).ravel() <= reach * reach) for a, b in zip(*away, strict=True)]

    def table(self, x: np.ndarray, cell: int) -> np.ndarray:
        """Squared distances of what the cell's centre leaves of each vector to all centroids of all subspaces: (vector, subspace, code)."""
        rest = x - self.centre(np.array([cell]))
        out = np.full((len(x), len(self.parts), CODES), np.inf)
        for i, (p, b) in enumerate(zip(self.parts, self.books, strict=True)):
            out[:, i, : len(b)] = distances(rest[:, p], b)
        return out


def linked(index: Index, cell: int, probes: np.ndarray, members: np.ndarray, codes: np.ndarray, errors: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(probe, member) numbers with cosine ``least`` or more, some probes at a time: distances from the table, then exact ones."""
    reach = math.sqrt(2 - 2 * least) + 1e-9
    for start in range(0, len(probes), 256):
        some = probes[start : start + 256]
        table = index.table(some, cell)
        far = np.zeros((len(some), len(members)))
        for i in range(codes.shape[1]):
            far += table[:, i, codes[:, i]]
        maybe = np.sqrt(far) - errors[None] <= reach
        at = np.flatnonzero(maybe.any(0))
        if len(at):
            p, m = np.nonzero((some @ members[at].T >= least) & maybe[:, at])
            yield p + start, at[m]


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Numbers of edges (a, b) that connect what all of them connect, without a circle. Of ``n`` nodes."""
    label, kept = np.arange(n), []
    while True:
        x, y = label[a], label[b]
        open_ = np.flatnonzero(x != y)
        if not len(open_):
            return np.concatenate(kept) if kept else np.zeros(0, np.int64)
        high, first = np.unique(np.maximum(x[open_], y[open_]), return_index=True)
        edges = open_[first]
        kept.append(edges)
        label_of = np.arange(n)
        label_of[high] = np.minimum(x[edges], y[edges])
        while (label_of[label_of] != label_of).any():
            label_of = label_of[label_of]
        label = label_of[label]


def unit(flat: np.ndarray, d: int) -> np.ndarray:
    """Rows of ``d`` numbers, scaled to length one."""
    x = flat.reshape(-1, d).astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)  # so that no square overflows
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _rows(blobs: pa.Array, d: int) -> np.ndarray:
    return np.frombuffer(b"".join(blobs.to_pylist()), np.float64).reshape(-1, d)


def _met(vectors: DataFrame, d: int, n: int, least: float, slack: float) -> DataFrame:
    """(u, n, other): links of the distinct vectors (u, e, copies) of dimension ``d`` by block, and edges of their forests."""
    spark = vectors.sparkSession
    # By a hash of the vector, so the sample is the same in a rerun; its size is SAMPLE but for chance.
    sample = vectors.where(F.pmod(F.xxhash64("u"), F.lit(n)) < SAMPLE).select("u", "e").toArrow().sort_by("u")
    if not sample.num_rows:  # of few vectors chance may take none
        sample = vectors.select("u", "e").limit(1).toArrow()
    index = spark.sparkContext.broadcast(Index(unit(sample.column("e").combine_chunks().flatten().to_numpy(zero_copy_only=False), d), n))
    reach = slack * math.sqrt(2 - 2 * least)

    def assign(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.batches(stream):
            x = unit(batch.column(1).flatten().to_numpy(zero_copy_only=False), d)
            cell = index.value.cells(x)
            codes, errors = index.value.codes(x, cell)
            # A pair is met once: by the vector of the lower list in the higher one.
            probes = [p[p >= c] for p, c in zip(index.value.probes(x, reach), cell, strict=True)]
            blobs = pa.array([r.tobytes() for r in x], pa.binary())
            coded = pa.array([r.tobytes() + e.tobytes() for r, e in zip(codes, errors, strict=True)], pa.binary())
            lists = pa.array(probes, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(cell), lists, blobs, coded], names=["u", "copies", "cell", "probes", "x", "coded"])

    held = vectors.select("u", "e", "copies").mapInArrow(assign, "u string, copies long, cell long, probes array<long>, x binary, coded binary")
    held = common.written(held, "coded-vectors")
    probes = held.select(F.explode("probes").alias("at"), "cell", "u", "copies", "x")
    sizes = held.groupBy(F.col("cell").alias("at")).agg(F.count("*").alias("members"))
    asked = probes.groupBy("at").agg(F.count("*").alias("probes")).join(sizes, "at")
    asked = common.written(asked.select("at", F.ceil(F.col("members") / MEMBERS).alias("m"), F.ceil(F.col("probes") / PROBES).alias("p")), "lists")
    salt = F.xxhash64("u", "at")
    every = lambda of: F.explode(F.sequence(F.lit(0).cast("long"), F.col(of) - 1))
    right = held.select(F.col("cell").alias("at"), "cell", "u", "copies", "x", "coded").join(asked, "at")
    right = right.withColumn("mb", F.pmod(salt, "m")).withColumn("pb", every("p"))
    left = probes.withColumn("coded", F.lit(None).cast("binary")).join(asked, "at")
    left = left.withColumn("pb", F.pmod(salt, "p")).withColumn("mb", every("m"))
    columns = ["at", "mb", "pb", "cell", "u", "copies", "x", "coded"]

    def compare(table: pa.Table) -> pa.Table:
        right = table.column("coded").combine_chunks().is_valid()
        probes, members = table.filter(pa.compute.invert(right)), table.filter(right)
        at = table.column("at")[0].as_py()
        names = [t.column("u").to_pylist() for t in (probes, members)]
        copies = [t.column("copies").to_numpy() for t in (probes, members)]
        own = probes.column("cell").to_numpy() == at
        counts = [np.zeros(len(x), np.int64) for x in names]
        found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if all(names):
            _, rank = np.unique(np.array(names[0] + names[1], object), return_inverse=True)
            rank = rank[: len(own)], rank[len(own) :]
            coded = np.frombuffer(b"".join(members.column("coded").to_pylist()), np.uint8).reshape(members.num_rows, -1)
            errors = np.ascontiguousarray(coded[:, -8:]).view(np.float64).ravel()
            for p, m in linked(index.value, at, _rows(probes.column("x"), d), _rows(members.column("x"), d), coded[:, :-8], errors, least):
                once = ~own[p] | (rank[0][p] < rank[1][m])
                p, m = p[once], m[once]
                np.add.at(counts[0], p, copies[1][m])
                np.add.at(counts[1], m, copies[0][p])
                # What is kept of the links of some probes is a forest of them.
                kept = forest(p, m + len(own), len(own) + len(names[1]))
                found[0].append(p[kept])
                found[1].append(m[kept])
        p, m = (np.concatenate(x) for x in found)
        kept = forest(p, m + len(own), len(own) + len(names[1]))
        u = [x for side, n in zip(names, counts, strict=True) for x, k in zip(side, n, strict=True) if k]
        k = [int(x) for n in counts for x in n if x]
        edges = [(names[0][i], names[1][j]) for i, j in zip(p[kept], m[kept], strict=True)]
        rows = [u + [x for x, _ in edges], k + [0] * len(edges), [None] * len(u) + [y for _, y in edges]]
        return pa.table([pa.array(c, t) for c, t in zip(rows, (pa.string(), pa.int64(), pa.string()), strict=True)], names=["u", "n", "other"])

    met = left.select(columns).unionByName(right.select(columns))
    return met.groupBy("at", "mb", "pb").applyInArrow(compare, "u string, n long, other string")


def linked_vectors(vectors: DataFrame, least: float = 0.95, slack: float = 0.5) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row of (vec_id, embedding): the number of other rows with a cosine of
    ``least`` or more, the least id that such links reach, and whether that is the row's own.

    Rows of one vector are compared once and link each other. Null, empty and zero vectors, vectors with a null or non-finite component and
    rows without an id link with nothing; a row without an id has a null component and is kept. Vectors of different
    length do not link; each length has codebooks of its own, fitted on about SAMPLE distinct vectors at most. Repeated ids are rows like
    others. ``slack``: the part of the reach to which a vector probes lists; 1 misses nothing, in many dimensions less is sufficient, as a
    neighbour seldom lies straight across a border. Other columns are ignored.
    """
    common.small_batches(vectors.sparkSession)
    number = F.transform("embedding", lambda x: x.cast("double"))
    fine = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("e", lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), number.alias("e"))
    rows = rows.withColumn("e", F.when(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False)), F.col("e")))
    rows = rows.withColumn("e", F.transform("e", lambda x: F.when(x == 0, 0.0).otherwise(x)))  # no negative zero
    rows = rows.withColumn("u", F.when(F.col("e").isNotNull(), F.format_string("%016x%016x", F.xxhash64("e"), F.xxhash64(F.lit(1), "e"))))
    distinct = rows.where("u is not null").groupBy("u").agg(F.first("e").alias("e"), F.count("*").alias("copies"), F.min("vec_id").alias("low"))
    distinct = common.written(distinct.withColumn("d", F.size("e")), "vectors")
    lengths = distinct.groupBy("d").count().where("count > 1").orderBy("d").collect()
    schema = "u string, n long, other string"
    met = vectors.sparkSession.createDataFrame([], schema)
    for d, n in lengths:
        met = met.unionByName(_met(distinct.where(F.col("d") == d), d, n, least, slack))
    met = common.written(met, "vector-links")
    degree = met.groupBy("u").agg(F.sum("n").alias("links"))
    roots = components(met.where("other is not null").select(F.col("u").alias("a"), F.col("other").alias("b")))
    known = distinct.select("u", "copies", "low").join(degree, "u", "left").join(roots.withColumnRenamed("key", "u"), "u", "left")
    known = common.written(known.withColumn("root", F.coalesce("root", "u")), "vector-roots")
    least_id = known.groupBy("root").agg(F.min("low").alias("component_id"))
    known = known.join(least_id, "root").select("u", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), "component_id")
    out = rows.select("vec_id", "u").join(known, "u", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))
