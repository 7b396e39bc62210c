"""Is the data complete? Grids, gaps, thin minutes, spans, watermarks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerforge.functions import NTZ, trunc
from ledgerforge.operators.browse import carried, in_pieces, numbered, summed_before
from ledgerforge.session import written


def _lit(at: dt.datetime) -> Column:
    return F.lit(at).cast(NTZ)


def grid(rows: DataFrame, now: dt.datetime, hours: int = 72, days: int = 14, time: str = "created_at") -> DataFrame:
    """Every hour and day up to ``now`` with its count and class.

    Outside: an hour that begins before the edge (``hours`` ago); err: none; warn: under a fifth of the upper median
    of the non-empty cells (hours: those inside); ok.
    """
    edge = _lit(now - dt.timedelta(hours=hours))
    spark = rows.sparkSession
    cells = []
    for unit, n in (("hour", hours), ("day", days)):
        last = now.replace(minute=0, second=0, microsecond=0) if unit == "hour" else now.replace(hour=0, minute=0, second=0, microsecond=0)
        cells += [(unit, last - dt.timedelta(**{f"{unit}s": i})) for i in range(n)]
    every = spark.createDataFrame(cells, f"unit string, cell {NTZ}")
    first = min(c for _, c in cells)
    recent = rows.where(F.col(time) >= _lit(first))
    count = lambda unit: recent.groupBy(trunc(unit, F.col(time)).alias("cell")).agg(F.count("*").alias("n")).select(F.lit(unit).alias("unit"), "cell", "n")
    filled = every.join(count("hour").unionByName(count("day")), ["unit", "cell"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    counted = F.when((F.col("n") > 0) & ((F.col("unit") == "day") | (F.col("cell") >= edge)), F.col("n"))
    listed = filled.groupBy("unit").agg(F.sort_array(F.collect_list(counted)).alias("l"))  # at most 86 cells
    median = listed.select("unit", F.when(F.size("l") > 0, F.element_at("l", F.floor(F.size("l") / 2).cast("int") + 1)).alias("median"))
    state = F.when((F.col("unit") == "hour") & (F.col("cell") < edge), "outside").when(F.col("n") == 0, "err").when(F.col("n") < 0.2 * F.col("median"), "warn").otherwise("ok")
    return filled.join(F.broadcast(median), "unit").select("unit", "cell", "n", state.alias("state"))


def minute_counts(rows: DataFrame, time: str = "created_at") -> DataFrame:
    return rows.groupBy(trunc("minute", F.col(time)).alias("minute")).agg(F.count("*").alias("n"))


def thin_minutes(counts: DataFrame, share: float = 0.35, reach: int = 20, block: int = 4096) -> DataFrame:
    """Minutes under ``share`` of the mean of the present minutes from ``reach`` before to ``reach`` after.

    Present minutes are numbered and cut into blocks; a minute near an edge is copied into the block beyond it, so no
    window spans the table.
    """
    placed = numbered(counts, ["minute"], "_i")
    of = lambda shift: F.floor((F.col("_i") + shift) / block)
    both = placed.withColumn("_b", F.explode(F.sequence(of(-reach), of(reach))))
    frame = Window.partitionBy("_b").orderBy("_i").rowsBetween(-reach, reach)
    thin = both.withColumn("mean", F.avg("n").over(frame)).where((F.col("_b") == of(0)) & (F.col("n") < F.lit(share) * F.col("mean")))
    return thin.select("minute", "n", F.round("mean", 6).alias("mean"))


def empty_runs(counts: DataFrame, start: dt.datetime, end: dt.datetime) -> DataFrame:
    """Maximal runs [run_start, run_end) of minutes of [start, end) that have no row.

    Inside a day gaps show between neighbouring occupied minutes; between days, between a day's last minute and
    the first of the next occupied one, on one row for each day.
    """
    step = F.expr("INTERVAL 1 MINUTE")
    inside = counts.where((F.col("minute") >= _lit(start)) & (F.col("minute") < _lit(end))).select("minute", F.to_date("minute").alias("day"))
    before = F.lag("minute").over(Window.partitionBy("day").orderBy("minute"))
    gaps = inside.withColumn("before", before).where(F.col("minute") > F.col("before") + step).select((F.col("before") + step).alias("run_start"), F.col("minute").alias("run_end"))
    ends = inside.groupBy("day").agg(F.min("minute").alias("first"), F.max("minute").alias("last"))
    edges = counts.sparkSession.createDataFrame([(start - dt.timedelta(minutes=1), end)], f"last {NTZ}, first {NTZ}")
    edges = edges.select(F.lit(None).cast(NTZ).alias("first"), "last").unionByName(edges.select("first", F.lit(None).cast(NTZ).alias("last")))
    order = Window.orderBy(F.coalesce("first", "last"))  # one row a day
    across = ends.select("first", "last").unionByName(edges).withColumn("next", F.lead("first").over(order))
    across = across.where(F.col("next") > F.col("last") + step).select((F.col("last") + step).alias("run_start"), F.col("next").alias("run_end"))
    return gaps.unionByName(across)


def bands(streams: DataFrame, minutes: int = 3, most: int = 50) -> DataFrame:
    """Each (stream, from_us, to_us) as equal bands, contiguous, newest first: one for so many minutes, capped."""
    n = F.least(F.lit(most), F.greatest(F.lit(1), F.floor((F.col("to_us") - F.col("from_us")) / (minutes * 60_000_000)))).cast("int")
    rows = streams.where("to_us > from_us").withColumn("n", n).select("*", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("band"))
    edge = lambda i: F.col("to_us") - F.expr(f"(to_us - from_us) * ({i}) div n")
    return rows.select("stream", "band", edge("band + 1").alias("band_from"), edge("band").alias("band_to"))


def row_slices(rows: DataFrame, stream: str, time: str, size: int) -> DataFrame:
    """Ends of slices of about ``size`` rows: the time of each (k * size + 1)-th row of a stream. Rows of one time that hold several such places end
    as many slices."""
    counts = rows.groupBy(stream, time).agg(F.count("*").alias("n"))
    placed = summed_before(counts, stream, time, "n")
    first = F.greatest(F.lit(1), F.expr(f"(before + {size - 1}) div {size}"))  # places k * size from before on
    marks = placed.withColumn("first", first).withColumn("last", F.expr(f"(before + n - 1) div {size}"))
    return marks.where("first <= last").select(stream, F.explode(F.sequence("first", "last")).alias("slice"), F.col(time).alias("slice_end"))


def watermark(bands: DataFrame, stored: DataFrame) -> DataFrame:
    """How far each stream is proven: the bottom of its lowest band that is not done, else the top of all; it never falls.

    ``bands``: stream, band_from, band_to, done; ``stored``: stream, covered.
    """
    found = bands.groupBy("stream").agg(F.min(F.when(~F.col("done"), F.col("band_from"))).alias("open"), F.max("band_to").alias("top"))
    now = found.select("stream", F.coalesce("open", "top").alias("now"))
    return stored.join(now, "stream", "full").select("stream", F.greatest("covered", "now").alias("covered"))


def union_spans(spans: DataFrame, keys: list[str] = ["stream"], piece: int = 1 << 18) -> DataFrame:  # noqa: B006
    """Overlapping or touching spans of a stream become one. By sorted pieces of about ``piece`` spans, so that no stream is one task."""
    held = in_pieces(spans.where("to_us > from_us").select(*keys, "from_us", "to_us"), [*keys, "from_us", "to_us"], piece)
    marked = carried(held, keys, {"_reach": ("max", "to_us")})
    marked = marked.withColumn("_start", F.when(F.col("_reach").isNull() | (F.col("from_us") > F.col("_reach")), F.col("_at")))
    islands = carried(marked, keys, {"_i": ("max", "_start")}, upto=0)
    return islands.groupBy(*keys, "_i").agg(F.min("from_us").alias("from_us"), F.max("to_us").alias("to_us")).drop("_i")


def clip_spans(spans: DataFrame, edge: Column) -> DataFrame:
    """Spans cut at an edge that moves up: what lies under it is lost, the rest stays pending."""
    parts = F.array(
        F.struct(F.lit("lost").alias("state"), F.col("from_us").alias("a"), F.least("to_us", edge).alias("b")),
        F.struct(F.lit("pending").alias("state"), F.greatest("from_us", edge).alias("a"), F.col("to_us").alias("b")),
    )
    cut = spans.select("stream", F.explode(parts).alias("p")).where("p.b > p.a")
    return cut.select("stream", "p.state", F.col("p.a").alias("from_us"), F.col("p.b").alias("to_us"))


def subtract_spans(spans: DataFrame, done: DataFrame, piece: int = 1 << 18) -> DataFrame:
    """What of each stream's spans the done spans leave: a sweep over starts and ends with two depths, by sorted pieces, so that no stream is one task."""
    ends = F.array(F.struct(F.col("from_us").alias("at"), F.lit(1).alias("step")), F.struct(F.col("to_us").alias("at"), F.lit(-1).alias("step")))
    edge = lambda df, kind: df.where("to_us > from_us").select("stream", F.explode(ends).alias("e"), F.lit(kind).alias("kind")).select("stream", "e.at", "e.step", "kind")
    of = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("step")).otherwise(0))
    edges = edge(spans, "want").unionByName(edge(done, "done")).groupBy("stream", "at").agg(of("want").alias("w"), of("done").alias("d"))
    held = in_pieces(edges, ["stream", "at"], piece)
    deep = carried(held, ["stream"], {"_w": ("sum", "w"), "_d": ("sum", "d")}, upto=0)
    # The next edge: in the piece, or the first of the stream's next one.
    nexts = held.groupBy(F.col("stream").alias("_s"), F.col("_piece").alias("_q")).agg(F.min("at").alias("_first"))
    nexts = nexts.withColumn("_next", F.lead("_first").over(Window.partitionBy("_s").orderBy("_q"))).drop("_first")
    deep = deep.withColumn("_lead", F.lead("at").over(Window.partitionBy("_piece", "stream").orderBy("_at")))
    pieces = deep.join(nexts, F.col("stream").eqNullSafe(F.col("_s")) & (F.col("_piece") == F.col("_q")))
    pieces = pieces.where("_w > 0 and _d = 0").select("stream", F.col("at").alias("from_us"), F.coalesce("_lead", "_next").alias("to_us"))
    return union_spans(pieces, piece=piece)


def walk_progress(walks: DataFrame) -> DataFrame:
    """Mean progress in percent of (covered, floor, top, done); a walk without a range counts only if it is done."""
    part = F.when(F.col("done"), 1.0).when(F.col("top") > F.col("floor"), F.least(F.lit(1.0), F.greatest(F.lit(0.0), (F.col("covered") - F.col("floor")) / (F.col("top") - F.col("floor")))))
    return walks.agg(F.round(F.avg(part) * 100, 4).alias("percent"), F.count(part).alias("walks"))


def _digests(rows: DataFrame, stream: str, key: str, bucket: Column) -> DataFrame:
    """Count and order-free digest of each (stream, bucket): the sum of the keys' hashes, so that repetitions do not cancel."""
    h = F.sum(F.xxhash64(key).cast("decimal(20,0)"))
    return rows.groupBy(F.col(stream).alias("_s"), bucket.alias("_b")).agg(F.count("*").alias("n"), h.alias("h"), F.count_if(F.col(key).isNull()).alias("nulls"))


def audit(source: DataFrame, store: DataFrame, stream: str, key: str, bucket: Column | None = None) -> DataFrame:
    """Per stream: rows at the source, stored, missing, only stored, and coverage (100 for an empty source).

    Both sides are first compared by count and digest of each ``bucket`` (an hour of the row's time, say; by default one of 1024 by hash of the key), which needs a row for
    each bucket only; keys are shuffled for buckets that differ alone. The store takes a key once, the source may list it many times. A null key is always missing
    and only stored.
    """
    bucket = F.pmod(F.xxhash64(key), F.lit(1024)) if bucket is None else bucket
    left, right = (_digests(df, stream, key, bucket) for df in (source, store))
    same = F.col("_s").eqNullSafe(F.col("_s2")) & F.col("_b").eqNullSafe(F.col("_b2"))
    both = left.join(right.select(F.col("_s").alias("_s2"), F.col("_b").alias("_b2"), F.col("n").alias("n2"), F.col("h").alias("h2"), F.col("nulls").alias("nulls2")), same, "full")
    equal = F.coalesce((F.col("n") == F.col("n2")) & (F.col("h") == F.col("h2")) & (F.col("nulls") == 0) & (F.col("nulls2") == 0), F.lit(False))
    both = both.select(F.coalesce("_s", "_s2").alias("_s"), F.coalesce("_b", "_b2").alias("_b"), "n", equal.alias("equal"))
    both = written(both, "digests")
    zero = F.lit(0).cast("bigint")
    clean = both.where("equal").groupBy(F.col("_s").alias(stream)).agg(F.sum("n").alias("source_n")).select(stream, "source_n", F.col("source_n").alias("stored_n"), zero.alias("missing"), zero.alias("store_only"))
    open_ = both.where("not equal").select("_s", "_b")
    inside = lambda df: df.withColumn("_bucket", bucket).join(open_, F.col(stream).eqNullSafe(F.col("_s")) & F.col("_bucket").eqNullSafe(F.col("_b")), "left_semi")
    s = inside(source).select(stream, key).distinct().withColumn("_s", F.lit(1))
    h = inside(store).select(stream, key).distinct().withColumn("_h", F.lit(1))
    found = s.join(h, [stream, key], "full").groupBy(stream).agg(
        F.count("_s").alias("source_n"), F.count("_h").alias("stored_n"), F.count_if(F.col("_h").isNull()).alias("missing"), F.count_if(F.col("_s").isNull()).alias("store_only")
    )
    both = found.unionByName(clean).groupBy(stream).agg(*[F.sum(c).alias(c) for c in ("source_n", "stored_n", "missing", "store_only")])
    covered = F.when(F.col("source_n") == 0, 100.0).otherwise(F.round((F.col("source_n") - F.col("missing")) * 100 / F.col("source_n"), 4))
    return both.withColumn("coverage", covered)
