"""Near-duplicate classes by DartMinHash over weighted word shingles.

A document is the multiset of its five-word shingles; the weight of a shingle is its count. Darts are thrown
at the plane (weight, rank) of each element: unit cells along the weight, dyadic strips along the rank, and
in each a Poisson number of darts, all from a hash of element, cell and strip. A document keeps the darts
under its weights, each dart falls on one of k coordinates, and the earliest of each is the signature: two
documents agree on a coordinate with the probability of their weighted Jaccard similarity. The number of darts
depends on k alone, as the rank is cut where about k (ln k + 2) darts lie.

Signatures are joined by bands; members of a bucket are compared exactly with its lead, the text that lies most amid
its like. Buckets whose members are not all connected by then meet again, whole, by the rarest shingles of their texts:
there every two texts that are not connected and may be similar, by their sizes, the shingles that others have too and
the places of the shared one, are compared.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerforge.llm import common

#: Rank where the first strip ends; the strips beyond double.
FIRST = -3
_POISSON_MAX = 24
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingles(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: 48-bit element hashes, counts, offsets by text, and each element's text.

    A text under ``width`` words is one shingle of all of them.
    """
    if len(texts) >= 1 << 16:
        raise ValueError("a batch has under 65536 texts")
    codes, offsets, words = common.split_hashes(texts)
    hashes = words[codes]
    keys, at = common.windows(hashes, offsets, width)
    owner = common.owners(offsets)[at] if len(at) else np.zeros(0, np.int64)
    for d in np.flatnonzero((np.diff(offsets) > 0) & (np.diff(offsets) < width)):
        with np.errstate(over="ignore"):
            whole = np.uint64(7)
            for h in hashes[offsets[d] : offsets[d + 1]]:
                whole = whole * np.uint64(0x9E3779B97F4A7C15) + h
        keys, owner = np.append(keys, common.mix(np.array([whole], np.uint64))), np.append(owner, d)
    both = np.sort((owner.astype(np.uint64) << np.uint64(48)) | (keys >> np.uint64(16)))
    at = np.flatnonzero(np.append(True, both[1:] != both[:-1])) if len(both) else np.zeros(0, np.int64)
    counts = np.diff(np.append(at, len(both)))
    owner = (both[at] >> np.uint64(48)).astype(np.int64)
    starts = np.searchsorted(owner, np.arange(len(texts) + 1))
    return both[at] & np.uint64((1 << 48) - 1), counts, starts, owner


def _poisson(u: np.ndarray, rate: float) -> np.ndarray:
    """Counts from uniforms by the inverse distribution."""
    total, term = math.exp(-rate), math.exp(-rate)
    out = np.zeros(len(u), np.int64)
    for n in range(1, _POISSON_MAX + int(8 * rate)):
        out += u >= total
        term *= rate / n
        total += term
        if term < 1e-15 and n > rate:
            break
    return out


def _uniform(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(11)).astype(np.float64) * 2.0**-53


def dart_minhash(keys: np.ndarray, weights: np.ndarray, starts: np.ndarray, k: int, seed: int = 1) -> np.ndarray:
    """Signatures, (texts, k) 64-bit: weighted minwise hashing by darts.

    ``weights`` may be any positive numbers. Text d has the elements ``starts[d]:starts[d + 1]``; one without elements has the greatest word everywhere.
    """
    n = len(starts) - 1
    owner = np.repeat(np.arange(n), np.diff(starts))
    total = np.bincount(owner, weights, n) if len(owner) else np.zeros(n)
    darts = k * (math.log(k) + 2)
    # The strip up to which each text's ranks go.
    with np.errstate(divide="ignore"):
        limit = np.where(total > 0, np.maximum(FIRST, np.ceil(np.log2(darts / np.maximum(total, 1e-300)))), FIRST).astype(int)
    signature = np.full(n * k, _NONE)
    cells = np.ceil(weights).astype(np.int64)
    element = np.repeat(np.arange(len(keys)), cells)
    cell = np.arange(len(element)) - np.repeat(np.cumsum(cells) - cells, cells)
    room = np.minimum(1.0, weights[element] - cell)  # of the cell, under the element's weight
    with np.errstate(over="ignore"):
        base = common.mix(keys[element] + np.uint64(seed) * np.uint64(0xD1B54A32D192ED03) + cell.astype(np.uint64) * np.uint64(0x8CB92BA72F3D8DD7))
    who, partly = owner[element], bool((room < 1).any())
    strip = FIRST
    while len(element):
        low, high = (0.0 if strip == FIRST else 2.0 ** (strip - 1)), 2.0**strip
        pieces = max(1, int((high - low) // 4))  # of long strips, which short texts need
        width = (high - low) / pieces
        for piece in range(pieces):
            with np.errstate(over="ignore"):
                area = common.mix(base + np.uint64((strip - FIRST + 1 << 32) + piece) * np.uint64(0x9E3779B97F4A7C15))
            number = _poisson(_uniform(area), width)
            hit = np.repeat(np.arange(len(area)), number)
            nth = np.arange(len(hit)) - np.repeat(np.cumsum(number) - number, number)
            with np.errstate(over="ignore"):
                dart = common.mix(area[hit] + (nth.astype(np.uint64) + np.uint64(1)) * np.uint64(0xA0761D6478BD642F))
                place = common.mix(dart + np.uint64(1))
            rank = low + width * (piece + _uniform(place))
            text = who[hit]
            if partly:
                under = _uniform(common.mix(place)) < room[hit]
                dart, rank, text = dart[under], rank[under], text[under]
            # Rank first, so the least word is the earliest dart.
            word = (rank.astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32)) | (dart >> np.uint64(32))
            np.minimum.at(signature, text * k + ((dart & np.uint64(0xFFFFFFFF)) % np.uint64(k)).astype(np.int64), word)
        strip += 1
        # A text is done at its limit if every coordinate has a dart.
        lacking = (limit < strip) & (total > 0) & (signature.reshape(n, k) == _NONE).any(1) if (limit < strip).any() else np.zeros(n, bool)
        go = (limit >= strip) | lacking
        if not go.all():
            keep = go[who]
            element, base, who, room = element[keep], base[keep], who[keep], room[keep]
    return signature.reshape(n, k)


def _keys(keys: np.ndarray, counts: np.ndarray, owner: np.ndarray, n: int) -> list[bytes]:
    """16 bytes for each text that only the same multiset of shingles has."""
    with np.errstate(over="ignore"):
        part = common.mix(keys + counts.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        sums = np.zeros((2, n), np.uint64)
        np.add.at(sums[0], owner, part)
        np.add.at(sums[1], owner, common.mix(part ^ np.uint64(0xA3B195354A39B70D)))
    packed = sums.T.astype(">u8").tobytes()
    return [packed[16 * i : 16 * i + 16] for i in range(n)]


def signatures(docs: DataFrame, width: int = 5, bands: int = 30, rows: int = 6, text: str = "text") -> DataFrame:
    """(doc_id, h, key, bands) of each row: a hash of the text as it is, a 128-bit key that texts share only if they are the same multiset of shingles,
    and a hash for each band. Texts without a word have a null key."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.batches(stream):
            keys, counts, starts, owner = shingles(batch.column(2), width)
            n = batch.num_rows
            with np.errstate(over="ignore"):
                sign = dart_minhash(keys, counts.astype(np.float64), starts, bands * rows)
                band = np.zeros((n, bands), np.uint64)
                for r in range(rows):
                    band = band * np.uint64(0x9E3779B97F4A7C15) + sign[:, r::rows]
                band = common.mix(band + np.arange(bands, dtype=np.uint64))
            full = np.diff(starts) > 0
            key = _keys(keys, counts, owner, n)
            key = pa.array([x if f else None for x, f in zip(key, full, strict=True)], pa.binary())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * bands), pa.array(common.long_signed(band).ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), key, lists], names=["doc_id", "h", "key", "bands"])

    common.small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(text), text).mapInArrow(run, "doc_id long, h long, key binary, bands array<long>")


def _elements(docs: DataFrame, wanted: DataFrame, width: int, text: str = "text") -> DataFrame:
    """(key, shingles) of the wanted rows: the multiset as sorted hashes, the n-th copy of a shingle as an element of its own.

    ``wanted`` holds ``x``, a hash of id and text hash. Texts stay where they are: a broadcast filter of fixed size picks them. It
    lets some others pass, which nothing joins.
    """
    shared = docs.sparkSession.sparkContext.broadcast(common.sieve(wanted))

    def run(stream):
        for batch in common.batches(stream):
            texts = batch.column(1).take(pa.array(np.flatnonzero(common.sieved(shared.value, batch.column(0).to_numpy()))))
            if not len(texts):
                continue
            keys, counts, starts, owner = shingles(texts, width)
            element = np.repeat(np.arange(len(keys)), counts)
            nth = np.arange(len(element)) - np.repeat(np.cumsum(counts) - counts, counts)
            with np.errstate(over="ignore"):
                values = np.where(nth == 0, keys[element], common.mix(keys[element] + nth.astype(np.uint64)))
            ends = np.searchsorted(owner[element], np.arange(len(texts) + 1))
            sets = [np.sort(values[a:b]).tobytes() for a, b in zip(ends, ends[1:], strict=False)]
            names = pa.array(_keys(keys, counts, owner, len(texts)), pa.binary())
            yield pa.RecordBatch.from_arrays([names, pa.array(sets, pa.binary())], names=["key", "shingles"])

    rows = docs.select(_row_hash(text), text).mapInArrow(run, "key binary, shingles binary")
    return rows.groupBy("key").agg(F.first("shingles").alias("shingles"))


def _row_hash(text: str = "text") -> Column:
    return F.xxhash64(F.col("doc_id").cast("long"), F.xxhash64(text))


def _prefixes(sets: DataFrame, wanted: DataFrame, least: float) -> DataFrame:
    """(bucket, key, root, size, shared, place) of the wanted (key, root): a bucket for each element of a prefix that another text has too.

    The elements of a text are ordered by how many of the wanted texts have them, rarest first. Of n elements the first
    n - ceil(least * n) + 1 are the prefix, and texts of similarity ``least`` or more share an element of their prefixes.
    ``size`` is n, ``shared`` the number of elements that other texts have too, ``place`` that of the element among these. A text
    of which few elements are shared has no bucket at all.
    """

    def run(stream):
        for batch in common.batches(stream):
            for key, root, data in zip(*batch.columns, strict=True):
                x = np.frombuffer(data.as_buffer(), np.int64)
                names = [pa.array([v.as_py()] * len(x), pa.binary()) for v in (key, root)]
                yield pa.RecordBatch.from_arrays([*names, pa.array(np.full(len(x), len(x))), pa.array(x)], names=["key", "root", "size", "bucket"])

    own = sets.join(wanted, "key").select("key", "root", "shingles")
    elements = common.written(own.mapInArrow(run, "key binary, root binary, size long, bucket long"), "elements")
    ends = (F.count("*").alias("texts"), F.min("root").alias("low"), F.max("root").alias("high"))
    counts = elements.groupBy("bucket").agg(*ends).where("texts > 1").select("bucket", "texts", (F.col("low") != F.col("high")).alias("open"))
    of_text = Window.partitionBy("key")
    ranked = elements.join(counts, "bucket").withColumns(
        {"place": F.row_number().over(of_text.orderBy("texts", "bucket")), "shared": F.count("*").over(of_text)}
    )
    room = F.col("shared") - F.ceil(least * F.col("size") - 1e-9) + 1  # the prefix less the elements that no other text has
    return ranked.where((F.col("place") <= room) & F.col("open")).select("bucket", "key", "root", "size", "shared", "place")


def _may_be_similar(least: float) -> Column:
    """Whether texts of ``size`` and ``b_size`` elements can be similar whose first shared element in a common order
    is that at ``place`` and ``b_place``: from there on each has enough elements that others have too, and so have
    both with what may lie before."""
    overlap = F.ceil(least / (1 + least) * (F.col("size") + F.col("b_size")) - 1e-9)
    sizes = F.least("size", "b_size") >= least * F.greatest("size", "b_size") - 1e-9
    after = F.least(F.col("shared") - F.col("place"), F.col("b_shared") - F.col("b_place"))
    return sizes & (after + 1 >= overlap)


def _similar(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Those of the pairs (a, b, a_root, b_root) whose weighted Jaccard similarity is at least ``least``."""

    def run(stream):
        for batch in common.batches(stream):
            keep = []
            for x, y in zip(batch.column(4), batch.column(5), strict=True):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                small, large = sorted((len(p), len(q)))
                if small < least * large:
                    keep.append(False)
                    continue
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(both >= least * (len(p) + len(q) - both))
            yield batch.filter(pa.array(keep, pa.bool_())).select([0, 1, 2, 3])

    both = pairs.join(sets.select(F.col("key").alias("a"), F.col("shingles").alias("x")), "a")
    both = both.join(sets.select(F.col("key").alias("b"), F.col("shingles").alias("y")), "b")
    found = both.select("a", "b", "a_root", "b_root", "x", "y").mapInArrow(run, "a binary, b binary, a_root binary, b_root binary")
    return common.written(found, "links")


def links(nodes: DataFrame, docs: DataFrame, least: float, width: int) -> tuple[DataFrame, DataFrame]:
    """(a, b) of verified links between distinct texts, and (key, root) of the texts that they connect.

    ``nodes``: key, bands, and x, the row hash of one text that has the key. First all members of a bucket are compared
    with its lead. All texts of buckets that are not connected then, whether like the lead or not, meet by their rarest shingles, of
    which similar texts share one for certain, so that texts which share a passage, or are not quite similar
    enough, hardly meet; there all pairs with two roots that may be similar are compared. So every pair that shares
    a bucket is connected, or was compared, or cannot be similar.
    """
    members = nodes.select(F.explode("bands").alias("bucket"), "key", "x")
    several = members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = common.written(members.join(several, "bucket"), "members")
    # A text that lies amid its like shares many large buckets, and leads.
    order = F.struct((-F.sum("n")).alias("weight"), F.xxhash64("key").alias("tie")).alias("order")
    weights = common.written(members.groupBy("key").agg(order, F.min("x").alias("x")), "weights")
    sets = common.written(_elements(docs, weights.select("x"), width), "shingles")
    members = members.select("bucket", "key").join(weights.select("key", "order"), "key")
    lead = members.groupBy("bucket").agg(F.min(F.struct("order", "key"))["key"].alias("b"))
    met = members.join(lead, "bucket").where("key != b").select(F.col("key").alias("a"), "b").distinct()
    first = _similar(met.select("a", "b", F.col("a").alias("a_root"), F.col("b").alias("b_root")), sets, least)
    roots = common.written(components(first.select("a", "b")), "roots")

    # What is not connected by now, bucket by bucket.
    rooted = members.select("bucket", "key").join(roots, "key", "left").select("bucket", "key", F.coalesce("root", "key").alias("root"))
    open_ = rooted.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high").select("bucket")
    left = common.written(rooted.join(open_, "bucket").select("key", "root").distinct(), "left")
    places = common.written(_prefixes(sets, left, least), "prefixes")
    other = places.select("bucket", *[F.col(c).alias(f"b_{c}") for c in ("key", "root", "size", "shared", "place")])
    met = places.join(other, "bucket").where(F.col("key") < F.col("b_key")).where(F.col("root") != F.col("b_root")).where(_may_be_similar(least))
    met = met.select(F.col("key").alias("a"), F.col("b_key").alias("b"), F.col("root").alias("a_root"), "b_root").distinct()
    second = _similar(met, sets, least)

    # Their roots are connected in turn.
    tops = components(second.select(F.col("a_root").alias("a"), F.col("b_root").alias("b")))
    tops = tops.select(F.col("key").alias("root"), F.col("root").alias("top"))
    known = roots.unionByName(tops.select(F.col("root").alias("key"), "root"))  # roots are not listed with themselves
    found = known.join(tops, "root", "left").select("key", F.coalesce("top", "root").alias("root")).distinct()
    return first.select("a", "b").unionByName(second.select("a", "b")), found


def components(edges: DataFrame) -> DataFrame:
    """(key, root) of the nodes of (a, b) edges that are not roots: large-star and small-star steps in turn until all edges
    lead to a root. Each step takes minima of neighbours only, so a node with very many neighbours is aggregated like any other."""
    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    now = common.written(now, "edges")
    while not _stars(now):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")
        now = common.written(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), "stars")
    return now.select(F.col("a").alias("key"), F.col("b").alias("root"))


def _stars(edges: DataFrame) -> bool:
    """Whether each node has one edge down, or none and some up."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("key"), F.lit(1).alias("up"), F.lit(0).alias("down")), F.struct(F.col("b").alias("key"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("e"))
    ends = ends.groupBy("e.key").agg(F.sum("e.up").alias("up"), F.max("e.down").alias("down"))
    return not ends.where("up > 1 or up = 1 and down = 1").agg(F.count("*")).first()[0]


def grouped(docs: DataFrame, least: float = 0.8, width: int = 5, bands: int = 30, rows: int = 6, text: str = "text") -> DataFrame:
    """(doc_id, h, kept, class_id, links, members) of each row of ``docs``, as ``classes``, with a hash of the text, and id and text hash of
    the row that stands for the class (null without a word)."""
    signed = common.written(signatures(docs, width, bands, rows, text), "signatures")
    named = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "h").alias("one")
    nodes = signed.where("key is not null").groupBy("key").agg(F.min(named).alias("one"), F.first("bands").alias("bands"), F.count("*").alias("copies"))
    nodes = common.written(nodes.withColumn("x", F.xxhash64("one.doc_id", "one.h")), "nodes")
    linked, roots = links(nodes.select("key", "bands", "x"), docs, least, width)
    degree = linked.select(F.explode(F.array("a", "b")).alias("key")).groupBy("key").agg(F.count("*").alias("links"))
    roots = roots.unionByName(roots.select(F.col("root").alias("key"), "root").distinct())
    roots = common.written(nodes.select("key", "one", "copies").join(roots, "key").join(degree, "key"), "classes")
    top = roots.groupBy("root").agg(F.min("one").alias("kept"), F.sum("copies").alias("members"))
    in_classes = roots.join(top, "root").select("key", "kept", "links", "members")
    alone = nodes.select("key", "one", "copies").join(in_classes, "key", "left")
    alone = alone.select("key", F.coalesce("kept", "one").alias("kept"), F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("members", "copies").alias("members"))
    found = signed.select("doc_id", "h", "key").join(alone, "key", "left")
    return found.select(
        "doc_id", "h", "kept", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("kept.doc_id")).alias("class_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("links"), F.coalesce("members", F.lit(1)).cast("long").alias("members"),
    )


def classes(docs: DataFrame, least: float = 0.8, width: int = 5, bands: int = 30, rows: int = 6) -> DataFrame:
    """(doc_id, class_id, links, members), one row for each row of ``docs``: the least id of the document's class.

    Documents are linked if the weighted Jaccard similarity of their five-word shingles is ``least`` or more; a class
    is what links connect. ``links`` is the number of links between different texts that hold the text in its class, ``members``
    the number of rows in the class. A null, empty or wordless text is a class of its own, as is one that is like no other. Words are
    compared without ASCII case and whatever the white space. Repeated rows are members each; null ids stay (the class is then named by
    its least id that is not null, if any). Other columns are ignored.
    """
    return grouped(docs, least, width, bands, rows).select("doc_id", "class_id", "links", "members")


def stage(docs: DataFrame) -> DataFrame:
    """One row of each class stays: that with the least id (null ids last) and, where several texts of the class have that id, the least text
    hash; of rows with one id and text one stays, that of the least hash of all columns. So an id with two texts may keep both, one or none.
    Null, empty and wordless texts all stay. Columns may have any names; no text moves but those of rows in question."""
    found = grouped(docs).where("kept is not null")
    gone = ~(F.col("doc_id").eqNullSafe(F.col("kept.doc_id")) & (F.col("h") == F.col("kept.h")))
    asked = found.groupBy("doc_id", "h").agg(F.max(gone).alias("gone"), F.count("*").alias("rows")).where("gone or rows > 1")
    asked = common.written(asked.select("doc_id", "h", "gone"), "in-question")
    every = common.packed(docs, asked)
    known = every.where("asked").join(asked, F.col("i").eqNullSafe(F.col("doc_id")) & (F.col("t") == F.col("h")), "left").where("gone is null or not gone")
    once = F.row_number().over(Window.partitionBy("i", "t").orderBy(F.xxhash64("row")))
    known = known.withColumn("place", once).where((F.col("place") == 1) | F.col("gone").isNull())
    return every.where("not asked").select("row.*").unionByName(known.select("row.*"))
