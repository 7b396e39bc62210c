"""Streams give what batches give."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerforge import fixtures
from ledgerforge.functions import trunc
from ledgerforge.streaming import cycle

SCHEMA = "tx_id string, created_at timestamp, money double"


def _write(spark, rows, path, mode="append"):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode(mode).json(path)


def test_ingest_replay_and_late_rows(spark, tmp_path):
    now = dt.datetime(2026, 8, 10)
    src, sink, late, ck = (f"file://{tmp_path}/{x}" for x in ("src", "sink", "late", "ck"))
    as_of = lambda: F.lit(now).cast("timestamp")
    stream = lambda: spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(src)
    fresh = [(f"t{i}", now - dt.timedelta(hours=i), 1.0) for i in range(5)]
    _write(spark, [*fresh, fresh[0], ("old", now - dt.timedelta(hours=80), 2.0)], src)
    cycle.ingest(stream(), sink, late, ck, as_of).awaitTermination(120)
    _write(spark, fresh[:3] + [("t9", now, 1.0)], src)
    cycle.ingest(stream(), sink, late, ck, as_of).awaitTermination(120)
    assert sorted(r["tx_id"] for r in spark.read.parquet(sink).collect()) == ["t0", "t1", "t2", "t3", "t4", "t9"]
    assert [r["tx_id"] for r in spark.read.parquet(late).collect()] == ["old"]
    cycle.ingest(stream(), sink, late, f"{ck}2", as_of).awaitTermination(120)  # all over again
    assert spark.read.parquet(sink).count() == 6


def test_late_rows_of_a_second_batch(spark, tmp_path):
    now = dt.datetime(2026, 8, 10)
    src, sink, late, ck = (f"file://{tmp_path}/{x}" for x in ("src", "sink", "late", "ck"))
    for rows in (
        [("t0", now, 1.0), ("t1", now - dt.timedelta(hours=1), 1.0)],
        [("t2", now, 1.0), ("t1", now - dt.timedelta(hours=2), 1.0), ("old", now - dt.timedelta(hours=80), 2.0), ("timeless", None, 3.0), (None, now, 4.0)],
        [("older", now - dt.timedelta(hours=200), 5.0)],
    ):
        _write(spark, rows, src)
        stream = spark.readStream.schema(SCHEMA).json(src)
        cycle.ingest(stream, sink, late, ck, lambda: F.lit(now).cast("timestamp")).awaitTermination(120)
    assert sorted(r["tx_id"] for r in spark.read.parquet(sink).collect()) == ["t0", "t1", "t2"]
    assert sorted((r["tx_id"] or "", r["money"]) for r in spark.read.parquet(late).collect()) == [("", 4.0), ("old", 2.0), ("older", 5.0), ("timeless", 3.0)]


def test_hour_counts(spark, sf_dir, tmp_path):
    rows = fixtures.tx_live(spark, sf_dir).select(F.col("created_at").cast("timestamp").alias("created_at"))
    rows.coalesce(1).write.parquet(f"file://{tmp_path}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"file://{tmp_path}/in")
    q = cycle.tumbling_counts(stream, "1 hour").writeStream.format("memory").queryName("hours").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    want = rows.groupBy(trunc("hour", F.col("created_at")).alias("h")).count()
    got = spark.table("hours").select(F.col("start").cast("timestamp_ntz"), "n")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_usage_days(spark, sf_dir, tmp_path):
    log = fixtures.usage_log(spark, sf_dir).withColumn("date_used", F.col("date_used").cast("timestamp"))
    log.coalesce(1).write.parquet(f"file://{tmp_path}/in")
    q = cycle.usage_days(spark.readStream.schema(log.schema).parquet(f"file://{tmp_path}/in")).writeStream.format("memory").queryName("days").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    want = log.groupBy(F.to_date("date_used").alias("day"), "endpoint").agg(F.count("*").alias("calls"))
    assert sorted(map(tuple, spark.table("days").collect())) == sorted(map(tuple, want.collect()))


def test_battles_that_left_the_live_list_end(spark):
    t = dt.datetime(2026, 8, 1)
    stored = spark.createDataFrame([(1, None), (2, None), (3, t)], "battle_id long, ended_at timestamp_ntz")
    docs = spark.createDataFrame([(2, None, t)], "battle_id long, ended_at timestamp_ntz, updated_at timestamp_ntz")
    got = cycle.reconcile_battles(stored, spark.createDataFrame([(1,)], "battle_id long"), docs)
    assert sorted(map(tuple, got.collect())) == [(1, None), (2, t), (3, t)]


def test_live_rankings_twice_are_once(spark):
    t = dt.datetime(2026, 8, 1)
    battles = spark.createDataFrame([(1, t, None), (2, t, t)], "battle_id long, created_at timestamp_ntz, ended_at timestamp_ntz")
    schema = "battle_id long, side int, entity_id long, created_at timestamp_ntz, damage long"
    stored = spark.createDataFrame([], schema)
    batch = spark.createDataFrame([(1, 1, 5, None, 10), (2, 1, 5, None, 10)], schema).withColumn("arrival", F.lit(1))
    once = cycle.live_rankings(stored, batch, battles)
    twice = cycle.live_rankings(once, batch.withColumn("damage", F.lit(12).cast("long")), battles)
    assert [tuple(r) for r in once.collect()] == [(1, 1, 5, t, 10)] and [tuple(r) for r in twice.collect()] == [(1, 1, 5, t, 12)]


def test_snapshots_prune_on_a_new_week(spark):
    d = lambda n: dt.datetime(2026, 8, n)
    schema = "week_start timestamp_ntz, snapshot_at timestamp_ntz, entity_id long, value long"
    stored = spark.createDataFrame([(d(3), d(4), 1, 5), (d(3), d(5), 1, 7)], schema)
    same = cycle.snapshots(stored, stored)
    assert same.count() == 2
    got = cycle.snapshots(stored, spark.createDataFrame([(d(10), d(11), 1, 1)], schema))
    assert sorted((r["snapshot_at"], r["value"]) for r in got.collect()) == [(d(5), 7), (d(11), 1)]


def test_settle_window_and_active_totals(spark):
    battles = spark.sql("""SELECT * FROM VALUES (1, TIMESTAMP_NTZ '2024-01-01 10:00:00', 0L, 0L), (2, TIMESTAMP_NTZ '2024-01-01 10:00:00', 5L, 6L), (3, CAST(NULL AS TIMESTAMP_NTZ), 0L, 0L),
        (4, TIMESTAMP_NTZ '2024-01-01 10:00:00', 0L, 0L), (5, NULL, 7L, 8L) AS v(battle_id, ended_at, attacker_damages, defender_damages)""")
    rows = spark.sql("SELECT * FROM VALUES (1, TIMESTAMP_NTZ '2024-01-01 10:04:59'), (2, TIMESTAMP_NTZ '2024-01-01 10:01:00'), (2, TIMESTAMP_NTZ '2024-01-01 10:05:00'), (3, TIMESTAMP_NTZ '2024-01-01 09:00:00') AS v(battle_id, read_at)")
    assert sorted(r["battle_id"] for r in cycle.settle_due(rows, battles).collect()) == [1, 4]
    rounds = spark.createDataFrame([(2, 50, 60), (3, 1, 2), (3, 10, 20)], "battle_id int, attacker_damages bigint, defender_damages bigint")
    once = cycle.active_totals(battles, rounds)
    want = {1: (0, 0), 2: (5, 6), 3: (11, 22), 4: (0, 0), 5: (7, 8)}
    for df in (once, cycle.active_totals(once, rounds)):
        assert {r["battle_id"]: (r["attacker_damages"], r["defender_damages"]) for r in df.collect()} == want


def test_requests_of_each_day(spark):
    log = spark.sql("SELECT * FROM VALUES (TIMESTAMP '2024-01-01 10:00:00', 1), (TIMESTAMP '2024-01-01 11:00:00', 1), (TIMESTAMP '2024-01-01 12:00:00', 2), (TIMESTAMP '2024-01-01 12:00:00', 0), (TIMESTAMP '2024-01-02 01:00:00', 1) AS v(date_used, request_id)")
    assert sorted((str(r[0]), *r[1:]) for r in cycle.usage_requests(log).collect()) == [("2024-01-01", 4, 2, 1), ("2024-01-02", 1, 1, 0)]


def test_a_battle_that_ends_loses_its_live_rows(spark):
    before = spark.sql("SELECT * FROM VALUES (1, TIMESTAMP_NTZ '2024-01-01 00:00:00', CAST(NULL AS TIMESTAMP_NTZ)), (2, TIMESTAMP_NTZ '2024-01-01 00:00:00', NULL) AS v(battle_id, created_at, ended_at)")
    after = before.withColumn("ended_at", F.when(F.col("battle_id") == 1, F.lit("2024-01-02").cast("timestamp_ntz")))
    entries = spark.sql("""SELECT battle_id, entity_id, side, damage, to_timestamp_ntz(at) AS created_at FROM VALUES (1, 5, 1, 10L, '2024-01-01 00:00:00'), (1, 5, 1, 12L, '2024-01-02 00:01:00'),
        (2, 5, 2, 7L, '2024-01-01 00:00:00') AS v(battle_id, entity_id, side, damage, at)""")
    once = cycle.without_partials(entries, before, after)
    assert sorted((r["battle_id"], r["damage"]) for r in once.collect()) == [(1, 12), (2, 7)]
    assert cycle.without_partials(once, before, after).count() == 2
    stats = spark.createDataFrame([(5, 1, 1, 10), (9, 4, 2, 3)], "entity_id int, battle_id int, side int, damage bigint")
    new = cycle.refreshed_stats(stats, once, after.where("battle_id = 1"))
    assert sorted(map(tuple, new.collect())) == [(5, 1, 1, 12), (9, 4, 2, 3)]
    assert sorted(map(tuple, cycle.refreshed_stats(new, once, after.where("battle_id = 1")).collect())) == [(5, 1, 1, 12), (9, 4, 2, 3)]
