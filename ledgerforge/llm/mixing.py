"""Mixing sources to target weights with a low-discrepancy schedule.

The words of each source, its documents shuffled by a seeded hash, are cut into blocks of equal
size. Slot i of the schedule goes to the source in whose share of the cumulative weights
the golden-ratio point frac(i * phi) falls, so every stretch of the schedule holds the sources
near their weights. The slots of a source are ranked, and rank r takes its block r modulo the
number of its blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerforge.llm import common

PHI = (5**0.5 - 1) / 2
#: Consecutive slots that are ranked in one piece.
CHUNK = 1 << 20


def words(text: str = "text") -> Column:
    """Number of words: runs without ASCII white space; a null text has none."""
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def targets(sizes: list[tuple[str | None, int]], weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> list[tuple[str | None, int, float]]:
    """(source, size, target) in code-point order, null last: ``share`` of all sizes dealt by the repeating
    weights; a target stops at ``most`` times its source's size and the excess is dealt again."""
    rows = sorted(sizes, key=lambda r: (r[0] is None, [*map(ord, r[0] or "")]))
    weight = [weights[i % len(weights)] for i in range(len(rows))]
    total = share * sum(n for _, n in rows)
    limit = [most * n for _, n in rows]
    full: set[int] = set()
    while True:
        left = total - sum(limit[i] for i in full)
        rest = sum(w for i, w in enumerate(weight) if i not in full)
        goal = [limit[i] if i in full else (left * w / rest if rest else 0.0) for i, w in enumerate(weight)]
        over = {i for i, g in enumerate(goal) if i not in full and g > limit[i]}
        if not over:
            return [(s, n, float(g)) for (s, n), g in zip(rows, goal, strict=True)]
        full |= over


def _in_order(docs: DataFrame, rows: int) -> DataFrame:
    """``start``: words of the source before each row, in shuffled order.

    Every source is cut into pieces by the shuffling hash, so many that a piece holds some thousand rows
    whatever the source's share; sums inside pieces and over pieces make the running sum.
    """
    pieces = max(16, rows // 2000)
    group = math.isqrt(pieces)  # sums of pieces are summed by groups too, so that no window grows with the corpus
    docs = docs.withColumn("piece", F.pmod("order", F.lit(pieces)))
    before = lambda *cols: Window.partitionBy(*cols).rowsBetween(Window.unboundedPreceding, -1)
    part = docs.withColumn("inside", F.coalesce(F.sum("size").over(before("source", "piece").orderBy("order", "doc_id", "copy")), F.lit(0)))
    sums = docs.groupBy("source", "piece").agg(F.sum("size").alias("n")).withColumn("g", F.floor(F.col("piece") / group))
    groups = sums.groupBy("source", "g").agg(F.sum("n").alias("gn"))
    groups = groups.select("source", "g", F.coalesce(F.sum("gn").over(before("source").orderBy("g")), F.lit(0)).alias("g0"))
    sums = sums.withColumn("p0", F.coalesce(F.sum("n").over(before("source", "g").orderBy("piece")), F.lit(0)))
    sums = sums.join(groups, ["source", "g"]).select("source", "piece", (F.col("p0") + F.col("g0")).alias("first"))
    return part.join(sums, ["source", "piece"]).withColumn("start", F.col("inside") + F.col("first")).drop("inside", "first", "piece")


def _quota(target: int, size: int, block: int) -> int:
    """Slots that give a source its target: whole passes over its blocks, then blocks from the first on."""
    if not size:
        return 0
    passes, rest = divmod(target, size)
    return passes * math.ceil(size / block) + math.ceil(rest / block)


def schedule(spark: SparkSession, plan: list[tuple[int, int]], block: int) -> DataFrame:
    """(source, block, times, last): how often the schedule takes each block, and by which rank last.

    ``plan``: target and size of each source, in words. Slots follow from the golden-ratio points in
    chunks: each chunk counts its slots by source, and its first ranks are the counts of the chunks before.
    A source's slots end at its target; what the points leave open at the end is closed in rank order.
    """
    quota = [_quota(t, n, block) for t, n in plan]
    slots = sum(quota)
    edges = np.cumsum([q / max(1, slots) for q in quota])
    chunks = math.ceil(slots / CHUNK)

    def count(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for c in batch.column(0).to_pylist():
                i = np.arange(c * CHUNK, min(slots, (c + 1) * CHUNK), dtype=np.float64) + 1
                n = np.bincount(np.minimum(np.searchsorted(edges, i * PHI % 1.0, side="right"), len(quota) - 1), minlength=len(quota))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), c)), pa.array(np.arange(len(n))), pa.array(n.astype(np.int64))], names=["chunk", "source", "n"])

    over = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    every = spark.range(0, chunks, 1, max(1, min(chunks, 1000))).withColumnRenamed("id", "chunk")
    first = every.mapInArrow(count, "chunk long, source long, n long").withColumn("a", F.coalesce(F.sum("n").over(over), F.lit(0)))
    runs = first.select("source", "a", (F.col("a") + F.col("n")).alias("b"))
    dealt = runs.groupBy("source").agg(F.max("b").alias("a"))
    numbers = spark.createDataFrame([(i, q, math.ceil(n / block)) for i, (q, (_, n)) in enumerate(zip(quota, plan, strict=True))], "source long, quota long, blocks long")
    closing = numbers.join(dealt, "source", "left").select("source", F.coalesce("a", F.lit(0)).alias("a"), F.col("quota").alias("b"))
    runs = runs.unionByName(closing).join(F.broadcast(numbers), "source")  # one row for each source
    runs = runs.withColumn("b", F.least("b", "quota")).where("a < b")
    ranks = runs.select("source", "blocks", F.explode(F.sequence("a", F.col("b") - 1)).alias("rank"))
    return ranks.groupBy("source", F.pmod("rank", F.col("blocks")).alias("block")).agg(F.count("*").alias("times"), F.max("rank").alias("last"))


def mix(docs: DataFrame, block: int = 128, seed: int = 7, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """For every row: ``doc_id``, ``source``, ``size``, ``source_size``, ``target`` and ``taken`` (words the mix
    takes, repeats counted). Only ``doc_id``, ``text`` and ``source`` are read, whatever else there is.

    A null or empty text has size 0 and is taken 0 times; a null source is a source of its own; repeated rows
    are rows of their own. The order inside a source is a hash of text and id, so reruns agree.
    ``taken`` of a source sums to its target, rounded (the last slot takes only what is missing), and no
    row is taken over ``most`` times. The driver keeps one row for each source.
    """
    spark = docs.sparkSession
    common.small_batches(spark)
    sized = docs.select("doc_id", "source", words().alias("size"), F.xxhash64(F.lit(seed), "text", "doc_id").alias("h"))
    # Repeated rows are counted, then told apart by number.
    rows = sized.groupBy("source", "doc_id", "h", "size").agg(F.count("*").alias("copies"))
    rows = common.written(rows.select("*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).drop("copies"), "mix-rows")
    stats = rows.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("rows")).collect()
    plan = targets([(r["source"], r["size"]) for r in stats], weights, share, most)
    known = F.broadcast(spark.createDataFrame([(s, i, n, t) for i, (s, n, t) in enumerate(plan)], "known string, s long, source_size long, target double"))
    rows = rows.join(known, F.col("source").eqNullSafe(F.col("known")), "left").drop("known")
    keys = rows.where("size > 0").select(F.col("s").alias("source"), "doc_id", "copy", "h", "size", F.xxhash64("h", "copy").alias("order"))
    placed = _in_order(keys, sum(r["rows"] for r in stats))
    stop = F.floor((F.col("start") + F.col("size") - 1) / block)
    cut = placed.select("source", "doc_id", "h", "copy", "start", "size", F.explode(F.sequence(F.floor(F.col("start") / block), stop)).alias("block"))
    goal = [(round(t), n) for _, n, t in plan]
    last = [(i, *_last(t, n, block)) for i, (t, n) in enumerate(goal)]
    both = cut.join(schedule(spark, goal, block), ["source", "block"]).join(F.broadcast(spark.createDataFrame(last, "source long, end long, lack long")), "source")
    a, b = F.greatest(F.col("start"), F.col("block") * block), F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block)
    part = F.greatest(F.lit(0), F.least(b, F.col("block") * block + F.col("lack")) - a)
    took = (F.col("times") - (F.col("last") == F.col("end")).cast("int")) * (b - a) + F.when(F.col("last") == F.col("end"), part).otherwise(0)
    taken = both.groupBy(F.col("source").alias("s"), F.col("doc_id").alias("i"), "h", "copy").agg(F.sum(took).cast("long").alias("taken"))
    same = [rows["s"] == taken["s"], rows["h"] == taken["h"], rows["copy"] == taken["copy"], rows["doc_id"].eqNullSafe(taken["i"])]
    out = rows.join(taken, same, "left")
    return out.select(rows["doc_id"], rows["source"], "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))


def _last(target: int, size: int, block: int) -> tuple[int, int]:
    """Rank of a source's last slot, and the words that it takes from the front of its block."""
    end = _quota(target, size, block) - 1
    if end < 0:
        return -1, 0
    passes, at = divmod(end, math.ceil(size / block))
    return end, target - passes * size - at * block
