"""The live cycle as streams: ingest, lateness, counts, battles, live rankings, snapshots, usage.

The steps are functions from DataFrames to DataFrames; the streams run them by micro-batch on tables that are published by version
(``sources/published.py``), or keep state by key (``lifecycle.py``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerforge.operators import merge as m
from ledgerforge.operators import usage
from ledgerforge.operators.weekly import prune_finished
from ledgerforge.sources.published import PART, Manifest, Published, bucket_of

WINDOW = "72 hours"


def _name(checkpoint: str) -> str:
    """A stream is what one checkpoint follows."""
    return hashlib.md5(checkpoint.encode()).hexdigest()[:12]


def _each(stream: DataFrame, put: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


# Transactions


def ingested(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of the batches that are published, with stream, batch and day, by which the scan is pruned. ``schema``: the stream's columns."""
    manifest = Manifest(spark, f"{path}/_manifest")
    last = manifest.newest()["batches"]
    full = f"{schema}, stream string, batch long, day date"
    if not last:
        return spark.createDataFrame([], full)
    done = F.lit(False)
    for stream, batch in last.items():  # one for each checkpoint that ever fed the table
        done = done | ((F.col("stream") == stream) & (F.col("batch") <= batch))
    return spark.read.schema(full).parquet(path).where(done)


def ingest(stream: DataFrame, path: str, late_path: str, checkpoint: str, as_of: Callable[[], Column]) -> StreamingQuery:
    """Transactions once each, as the sink takes an id only once within the window; rows that are older than the window at ``as_of`` or have no
    time or id are kept aside, not lost. The stream has no watermark, which would drop late rows before they are seen.

    Both tables lie by stream, batch and day. A batch replaces what an earlier try of it left and is published when both are written, so
    a retry gives each row once. Ids are looked for in the days of the window alone.
    """
    name, schema = _name(checkpoint), _ddl(stream)

    def put(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        manifest = Manifest(spark, f"{path}/_manifest")
        document = manifest.newest()
        if document["batches"].get(name, -1) >= number:
            return
        edge = as_of() - F.expr(f"INTERVAL {WINDOW}")
        rows = batch.withColumn("arrival", F.lit(number)).persist()
        in_time = F.coalesce((F.col("created_at") >= edge) & F.col("tx_id").isNotNull(), F.lit(False))
        rows.where(~in_time).drop("arrival").write.mode("overwrite").parquet(f"{late_path}/stream={name}/batch={number}")
        # Of an id's rows in one batch the earliest counts.
        fresh = rows.where(in_time).withColumn("arrival", F.struct("arrival", "created_at"))
        held = ingested(spark, path, schema).where(F.col("day") >= F.to_date(edge))
        new = m.insert_ignore(held, fresh, ["tx_id"]).select(*batch.columns, F.to_date("created_at").alias("day"))
        new.repartition("day").write.mode("overwrite").option("parquet.bloom.filter.enabled#tx_id", "true").partitionBy("day").parquet(f"{path}/stream={name}/batch={number}")
        manifest.publish(document | {"batches": document["batches"] | {name: number}})
        rows.unpersist()

    return _each(stream, put, checkpoint)


def _ddl(rows: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)


def tumbling_counts(stream: DataFrame, unit: str = "1 minute", late: str = "10 minutes") -> DataFrame:
    """Rows of each tumbling window."""
    w = F.window("created_at", unit)
    return stream.withWatermark("created_at", late).groupBy(w).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), "n")


# Battles and live rankings


def reconcile_battles(stored: DataFrame, live: DataFrame, documents: DataFrame) -> DataFrame:
    """Stored battles after a look at the live list: those that are gone ended, at their document's end or last update."""
    gone = stored.where("ended_at is null").join(live.select("battle_id"), "battle_id", "left_anti").select("battle_id")
    ends = documents.join(gone, "battle_id", "left_semi").select("battle_id", F.coalesce("ended_at", "updated_at").alias("_end"))
    return stored.join(ends, "battle_id", "left").withColumn("ended_at", F.coalesce("ended_at", "_end")).drop("_end")


def live_rankings(stored: DataFrame, batch: DataFrame, battles: DataFrame) -> DataFrame:
    """Partial rows of battles that still run replace those read before: their time is the battle's creation, so a
    repeated read changes nothing."""
    running = battles.where("ended_at is null").select("battle_id", F.col("created_at").alias("_at"))
    rows = batch.join(running, "battle_id").withColumn("created_at", F.col("_at")).drop("_at")
    key = ["battle_id", "side", "entity_id", "created_at"]
    return m.merge(stored, rows, key, {"damage": "new"})


def without_partials(entries: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """Ranking rows without the live ones of battles that ended between two states of the battles: those that bear the battle's
    creation as their time. A repeated step changes nothing."""
    ended = before.where("ended_at is null").join(after.where("ended_at is not null").select("battle_id"), "battle_id", "left_semi")
    return entries.join(ended.select("battle_id", "created_at"), ["battle_id", "created_at"], "left_anti").select(*entries.columns)


def refreshed_stats(stats: DataFrame, entries: DataFrame, touched: DataFrame) -> DataFrame:
    """User-battle sums (entity_id, battle_id, side, damage) with those of the ``touched`` battles counted again from the ranking rows."""
    kept = stats.join(touched.select("battle_id"), "battle_id", "left_anti").select("entity_id", "battle_id", "side", "damage")
    rows = entries.where("side in (1, 2)").join(touched.select("battle_id"), "battle_id", "left_semi")
    return kept.unionByName(rows.groupBy("entity_id", "battle_id", "side").agg(F.sum("damage").alias("damage")))


def settle_due(rows: DataFrame, battles: DataFrame, wait: str = "5 minutes") -> DataFrame:
    """(battle_id) of ended battles whose rows were all read before they had settled: none is from ``wait`` after the end or later.
    ``rows``: battle_id, read_at. A battle without rows is due too."""
    last = rows.groupBy("battle_id").agg(F.max("read_at").alias("_last"))
    ended = battles.where("ended_at is not null").select("battle_id", "ended_at").join(last, "battle_id", "left")
    return ended.where(F.col("_last").isNull() | (F.col("_last") < F.col("ended_at") + F.expr(f"INTERVAL {wait}"))).select("battle_id")


def active_totals(battles: DataFrame, rounds: DataFrame) -> DataFrame:
    """Battles with the totals of those that still run taken from their rounds, as a step after each batch of rounds; a battle
    without rounds keeps its own, and a repeated step changes nothing."""
    sums = rounds.groupBy("battle_id").agg(F.sum("attacker_damages").alias("_a"), F.sum("defender_damages").alias("_d"))
    both = battles.join(sums, "battle_id", "left")
    for side, new in (("attacker_damages", "_a"), ("defender_damages", "_d")):
        both = both.withColumn(side, F.when(F.col("ended_at").isNull(), F.coalesce(new, side)).otherwise(F.col(side)))
    return both.select(*battles.columns)


#: What a live stream keeps, by hash of the battle. A live ranking row bears its battle's creation as its time.
LIVE = {
    "battles": "battle_id long, created_at timestamp_ntz, ended_at timestamp_ntz, attacker_damages long, defender_damages long",
    "rounds": "battle_id long, number int, attacker_damages long, defender_damages long",
    "entries": "battle_id long, side int, entity_id long, created_at timestamp_ntz, damage long",
    "stats": "entity_id long, battle_id long, side int, damage long",
}
#: A document of the live cycle. ``kind``: battle, round, live (a partial ranking row) or final (one with its own time).
DOCUMENTS = (
    "kind string, arrival long, battle_id long, created_at timestamp_ntz, updated_at timestamp_ntz, ended_at timestamp_ntz, gone boolean, number int, side int, entity_id long, damage long,"
    " attacker_damages long, defender_damages long"
)


def cycle_step(tables: dict[str, DataFrame], batch: DataFrame) -> dict[str, DataFrame]:
    """The ``LIVE`` tables after a batch of ``DOCUMENTS``; its battles come first, then rounds, then rankings.

    A battle that is ``gone`` from the live list ended at its end or last update, and loses its live rows; live rows of ended battles are
    skipped; totals of running battles follow their rounds; stats are counted from the rankings.
    """
    of = lambda kind: batch.where((F.col("kind") == kind) & F.col("battle_id").isNotNull())
    seen = of("battle").withColumn("ended_at", F.coalesce("ended_at", F.when(F.coalesce("gone", F.lit(False)), F.col("updated_at"))))
    policies = {"created_at": "old", "ended_at": "coalesce", "attacker_damages": "coalesce", "defender_damages": "coalesce"}
    battles = m.merge(tables["battles"], seen, ["battle_id"], policies)
    rounds = m.merge(tables["rounds"], of("round").where("number is not null"), ["battle_id", "number"], {"attacker_damages": "new", "defender_damages": "new"})
    key = ["battle_id", "side", "entity_id", "created_at"]
    rows = of("live").where("side is not null and entity_id is not null")
    entries = live_rankings(without_partials(tables["entries"], tables["battles"], battles), rows, battles)
    final = of("final").where("side is not null and entity_id is not null and created_at is not null")
    entries = m.merge(entries, final, key, {"damage": "new"})
    stats = entries.where("side in (1, 2)").groupBy("entity_id", "battle_id", "side").agg(F.sum("damage").alias("damage"))
    return {"battles": active_totals(battles, rounds), "rounds": rounds, "entries": entries, "stats": stats}


def follow_battles(stream: DataFrame, store: Published, checkpoint: str, buckets: int = 64) -> StreamingQuery:
    """Keeps the ``LIVE`` tables current: a batch of ``DOCUMENTS`` rewrites the partitions of the battles it touches, all tables at one
    version; other partitions keep their files, and a repeated batch changes nothing."""
    name = _name(checkpoint)

    def put(batch: DataFrame, number: int) -> None:
        at = store.manifest.newest()
        if at["batches"].get(name, -1) >= number:
            return
        rows = batch.where("battle_id is not null").withColumn(PART, bucket_of("battle_id", n=buckets)).persist()
        parts = sorted(r[0] for r in rows.select(PART).distinct().collect())  # at most ``buckets``
        new = cycle_step({t: store.read(t, parts, at).drop(PART) for t in LIVE}, rows)
        store.publish({t: (df.withColumn(PART, bucket_of("battle_id", n=buckets)), parts) for t, df in new.items()} if parts else {}, name, number, at)
        rows.unpersist()

    return _each(stream, put, checkpoint)


# Snapshots

SNAPSHOTS = {"snapshots": "week_start timestamp_ntz, snapshot_at timestamp_ntz, entity_type int, entity_id long, value long"}


def snapshots(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Stored snapshots with a newer document; when a new week begins the old ones are pruned."""
    last = stored.agg(F.max("snapshot_at")).first()[0]
    fresh = batch if last is None else batch.where(F.col("snapshot_at") > F.lit(last).cast(batch.schema["snapshot_at"].dataType))
    both = stored.unionByName(fresh)
    now = both.agg(F.max("week_start")).first()[0]
    return both if now is None else prune_finished(both, F.lit(now).cast(both.schema["week_start"].dataType))


def follow_snapshots(stream: DataFrame, store: Published, checkpoint: str) -> StreamingQuery:
    """Hourly snapshots by type: a document that is not newer than the latest stored of its type is skipped, and a repeated row is one; once
    a type has a new week, its weeks before keep each entity's last value. Weeks are partitions; a batch rewrites those it adds to and those it ends."""
    name = _name(checkpoint)
    week = F.date_format("week_start", "yyyy-MM-dd")

    def put(batch: DataFrame, number: int) -> None:
        at = store.manifest.newest()
        if at["batches"].get(name, -1) >= number:
            return
        stored = store.read("snapshots", None, at).withColumn("batch", F.lit(0))
        of_type = stored.groupBy("entity_type").agg(F.max("snapshot_at").alias("last_at"), F.max("week_start").alias("last_week"))
        known = batch.where("week_start is not null and snapshot_at is not null and entity_id is not null and entity_type is not null")
        fresh = known.join(F.broadcast(of_type), "entity_type", "left").where("last_at is null or snapshot_at > last_at").drop("last_at", "last_week")  # a row for each type
        fresh = fresh.groupBy("week_start", "snapshot_at", "entity_type", "entity_id").agg(F.max("value").alias("value")).withColumn(PART, week).persist()
        now = fresh.groupBy("entity_type").agg(F.max("week_start").alias("new_week"))
        parts = {r[0] for r in fresh.select(PART).distinct().collect()}  # weeks
        ended = now.join(of_type, "entity_type", "left").where("last_week < new_week").select(F.date_format("last_week", "yyyy-MM-dd")).distinct().collect()
        parts = sorted(parts | {r[0] for r in ended})
        rows = store.read("snapshots", parts, at).unionByName(fresh)
        top = of_type.select("entity_type", F.col("last_week").alias("w")).unionByName(now.select("entity_type", F.col("new_week").alias("w"))).groupBy("entity_type").agg(F.max("w").alias("current"))
        rows = rows.join(F.broadcast(top), "entity_type")
        running = rows.where("week_start >= current").drop("current")
        key = ["week_start", "entity_type", "entity_id", PART]
        done = rows.where("week_start < current").groupBy(*key).agg(F.max(F.struct("snapshot_at", "value")).alias("l")).select(*key, "l.*")
        store.publish({"snapshots": (running.unionByName(done), parts)} if parts else {}, name, number, at)
        fresh.unpersist()

    return _each(stream, put, checkpoint)


# Usage


def usage_days(stream: DataFrame, late: str = "1 day") -> DataFrame:
    """Calls of each day and endpoint."""
    return stream.withWatermark("date_used", late).groupBy(F.window("date_used", "1 day"), "endpoint").agg(F.count("*").alias("calls")).select(F.to_date("window.start").alias("day"), "endpoint", "calls")


def usage_requests(stream: DataFrame, late: str = "1 day") -> DataFrame:
    """Calls of each day, distinct requests, and for calls of old without an id (0) distinct instants: the calls of a request, or of an instant, are folded to one row
    first, then counted by day. A call with a null id is a call of no request.

    For ``foreachBatch`` or a batch table; as a stream run it in append mode, where a day is given when it is over.
    """
    marked = stream.withWatermark("date_used", late) if stream.isStreaming else stream
    day, instant = F.window("date_used", "1 day"), F.when(F.col("request_id") == 0, F.unix_micros(F.col("date_used").cast("timestamp")))
    one = marked.groupBy(day.alias("w"), "request_id", instant.alias("instant")).agg(F.count("*").alias("calls"))
    days = one.groupBy(F.window(F.window_time("w"), "1 day").alias("d") if stream.isStreaming else F.col("w").alias("d"))
    exact, legacy = F.count_if(F.col("request_id") != 0).alias("exact_requests"), F.count_if(F.col("request_id") == 0).alias("legacy_requests")
    return days.agg(F.sum("calls").alias("calls"), exact, legacy).select(F.to_date("d.start").alias("day"), "calls", "exact_requests", "legacy_requests")


USAGE = {
    "log": "endpoint string, request_id long, date_used timestamp_ntz",
    "daily": "day date, endpoint string, calls long, last_used timestamp_ntz",
    "totals": "day date, calls long, exact_requests long, legacy_requests long",
}


def follow_usage(stream: DataFrame, store: Published, checkpoint: str) -> StreamingQuery:
    """Appends calls (endpoint, request_id, date_used) to the log of a ``USAGE`` store, by day; a repeated batch adds nothing. Calls without a time are left out."""
    name = _name(checkpoint)

    def put(batch: DataFrame, number: int) -> None:
        at = store.manifest.newest()
        if at["batches"].get(name, -1) >= number:
            return
        rows = batch.where("date_used is not null").withColumn(PART, F.to_date("date_used").cast("string")).persist()
        parts = sorted(r[0] for r in rows.select(PART).distinct().collect())  # days
        both = store.read("log", parts, at).unionByName(rows.select("endpoint", "request_id", "date_used", PART))
        store.publish({"log": (both, parts)} if parts else {}, name, number, at)
        rows.unpersist()

    return _each(stream, put, checkpoint)


def retention(store: Published, cutoff: str) -> int | None:
    """Daily: fold the log's days before ``cutoff`` (yyyy-MM-dd) into the rollups and take them out of the log, at one version.

    Late calls of a day that is rolled already are in the log again and add to it; as what was rolled is out of the log, a repeated
    run adds nothing. The version, or none if no day was due.
    """
    at = store.manifest.newest()
    due = sorted(p for p in at["tables"].get("log", {}) if p < cutoff)
    if not due:
        return None
    log, months = store.read("log", due, at), sorted({p[:7] for p in due})
    month = F.date_format("day", "yyyy-MM")
    daily, totals = (store.read(t, months, at).drop(PART) for t in ("daily", "totals"))
    daily, totals = usage.added(daily, totals, log)
    frames = {"daily": (daily.withColumn(PART, month), months), "totals": (totals.withColumn(PART, month), months), "log": (log.limit(0), due)}
    return store.publish(frames, at=at)
