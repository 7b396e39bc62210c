"""Streams that keep published tables or state: replays, restarts and late rows give what one batch gives."""

import datetime as dt
import random
import threading
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerforge import fixtures
from ledgerforge.operators import usage
from ledgerforge.sources.published import PART, Manifest, Published
from ledgerforge.streaming import cycle, lifecycle

T = dt.datetime(2026, 8, 3)


def minutes(n):
    return T + dt.timedelta(minutes=n)


def put(spark, rows, schema, path):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(path)


def source(spark, schema, path):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(path)


def rows_of(df):
    return Counter(map(tuple, df.collect()))


# Tables by version


def test_versions_replace_only_what_they_touch(spark, tmp_path):
    store = Published(spark, f"file://{tmp_path}/t", {"a": "x long", "b": "y string"})
    frame = lambda rows: spark.createDataFrame(rows, f"x long, {PART} string, other int")
    assert store.read("a").count() == 0 and store.manifest.newest()["version"] == 0
    store.publish({"a": (frame([(1, "p", 0), (2, "q", 0), (2, "q", 0)]), None)}, "s", 0)
    before = store.read("a").where("part = 'q'").select("_metadata.file_path").distinct().collect()
    old = store.manifest.newest()
    store.publish({"a": (frame([(9, "p", 0)]), ["p"])}, "s", 1)
    assert rows_of(store.read("a")) == Counter({(9, "p"): 1, (2, "q"): 2})
    assert store.read("a").where("part = 'q'").select("_metadata.file_path").distinct().collect() == before
    assert rows_of(store.read("a", at=old)) == Counter({(1, "p"): 1, (2, "q"): 2})
    store.publish({"a": (frame([]), ["q"])})  # a partition that is empty now
    assert rows_of(store.read("a")) == Counter({(9, "p"): 1})
    assert store.has("s", 1) and store.has("s", 0) and not store.has("s", 2) and not store.has("r", 0)
    with pytest.raises(RuntimeError):
        store.publish({"a": (frame([(7, "p", 0)]), ["p"])}, at=old)  # another writer was quicker
    store.clean(keep=1)
    assert store.manifest.versions() == [3] and rows_of(store.read("a")) == Counter({(9, "p"): 1})


def test_a_reader_sees_whole_versions(spark, tmp_path):
    store = Published(spark, f"file://{tmp_path}/t", {"a": "x long", "b": "x long"})
    swap = lambda n: store.publish({t: (spark.createDataFrame([(n, "p")] * 3 + [(n, "q")], f"x long, {PART} string"), None) for t in ("a", "b")})
    swap(0)
    wrong, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            at = store.manifest.newest()
            seen = [sorted(r[0] for r in store.read(t, at=at).select("x").collect()) for t in ("a", "b")]
            if seen[0] != seen[1] or len(seen[0]) != 4 or len(set(seen[0])) != 1:
                wrong.append(seen)

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(1, 21):
        swap(n)
    stop.set()
    reader.join()
    assert not wrong and store.manifest.newest()["version"] == 21


# Transactions

TX = "tx_id string, created_at timestamp, money double"


def test_a_batch_that_dies_between_its_writes(spark, tmp_path, monkeypatch):
    src, sink, late, ck = (f"file://{tmp_path}/{x}" for x in ("src", "sink", "late", "ck"))
    as_of = lambda: F.lit(T).cast("timestamp")
    put(spark, [("a", T, 1.0), ("b", T - dt.timedelta(hours=1), 1.0), ("old", T - dt.timedelta(hours=90), 2.0), (None, T, 3.0)], TX, src)
    run = lambda: cycle.ingest(source(spark, TX, src), sink, late, ck, as_of).awaitTermination(120)
    for broken in ("insert_ignore", "publish"):  # between the late and the main write, and behind both
        with monkeypatch.context() as patch:
            patch.setattr(cycle.m if broken == "insert_ignore" else Manifest, broken, lambda *a, **k: 1 / 0)
            with pytest.raises(Exception, match="division by zero"):
                run()
        assert cycle.ingested(spark, sink, TX).count() == 0  # nothing half done is seen
    run()
    put(spark, [("a", T, 1.0), ("c", T, 1.0), ("older", T - dt.timedelta(hours=91), 2.0)], TX, src)
    run()
    assert sorted(r["tx_id"] for r in cycle.ingested(spark, sink, TX).collect()) == ["a", "b", "c"]
    assert sorted(r["tx_id"] or "" for r in spark.read.parquet(late).collect()) == ["", "old", "older"]


def test_ingest_reads_the_days_of_the_window_alone(spark, tmp_path):
    src, sink, late, ck = (f"file://{tmp_path}/{x}" for x in ("src", "sink", "late", "ck"))
    put(spark, [("a", T, 1.0)], TX, src)
    cycle.ingest(source(spark, TX, src), sink, late, ck, lambda: F.lit(T).cast("timestamp")).awaitTermination(120)
    held = cycle.ingested(spark, sink, TX).where(F.col("day") >= F.to_date(F.lit(T)))
    plan = held._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert all(x in filters for x in ("day", "stream", "batch"))


# Battles


def life(spark, events, tmp_path, run):
    """Events as files in this order; ``run`` files of them before a stop."""
    src, out, ck = (f"file://{tmp_path}/{x}" for x in ("ev", "out", "ck"))
    kept = {k: spark.conf.get(k, None) for k in ("spark.sql.streaming.stateStore.providerClass",)}
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", lifecycle.STORE)
    try:
        for k, part in enumerate(events):
            put(spark, [(*e, *[None] * (4 - len(e))) for e in part], lifecycle.EVENTS, src)
            if k in run or k == len(events) - 1:
                actions = lifecycle.battle_actions(source(spark, lifecycle.EVENTS, src), late="1 minute")
                q = actions.writeStream.format("parquet").outputMode("append").option("checkpointLocation", ck).option("path", out).trigger(availableNow=True).start()
                q.awaitTermination(300)
                assert q.exception() is None
    finally:
        for k, v in kept.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return [(r["battle_id"], r["action"], int((r["at"] - T).total_seconds() // 60)) for r in spark.read.parquet(out).orderBy("at", "battle_id", "action").collect()]


@pytest.mark.parametrize("run", [(), (0, 1, 3)])
def test_battles_are_asked_for_until_they_settle(spark, tmp_path, run):
    tick = lambda n: (99, "rows", minutes(n))
    events = [
        [(1, "seen", minutes(0)), (2, "seen", minutes(0)), (3, "seen", minutes(0)), (None, "seen", minutes(0)), (4, "seen", None), (5, None, minutes(0))],
        [(1, "seen", minutes(2)), (3, "end", minutes(2), minutes(1)), (3, "rows", minutes(2)), tick(4)],
        [(1, "end", minutes(4)), (1, "rows", minutes(5)), (6, "end", minutes(4), minutes(3)), tick(6)],
        [(2, "end", minutes(6), minutes(3)), (1, "rows", minutes(9)), tick(9)],  # the end was long before it was read
        [(2, "end", minutes(9), minutes(8)), (2, "rows", minutes(9), None)],
        [(3, "rows", minutes(12)), tick(13)],
        [tick(20)],
        [tick(30)],
        [tick(31)],
    ]
    got = life(spark, events, tmp_path, run)
    of = lambda b: [(a, t) for x, a, t in got if x == b]
    assert [x for x in of(1) if x[0] != "missing"] == [("end", 4), ("settled", 9)]
    assert of(3)[0] == ("end", 1) and of(3)[-1] == ("settled", 12) and ("request", 6) in of(3)
    assert of(2)[0] == ("missing", 2) and ("end", 3) in of(2)  # it left the list, so its document was asked for
    assert of(2)[-1] == ("settled", 9) and of(99) == []
    assert not of(4) and not of(5)
    # What is open at the end is what the batch function says.
    flat = [(*e, None)[:4] for part in events for e in part if e[0] in (1, 2, 3, 6) and e[1] and e[2]]
    ends = {}
    for b, kind, at, ended in flat:
        if kind == "end":
            ends.setdefault(b, ended or at)
    battles = spark.createDataFrame(list(ends.items()), "battle_id long, ended_at timestamp")
    read = spark.createDataFrame([(b, at) for b, kind, at, _ in flat if kind == "rows"], "battle_id long, read_at timestamp")
    due = {r[0] for r in cycle.settle_due(read, battles).collect()}
    assert due == {b for b in ends if of(b)[-1][0] != "settled"} == {6}
    asked = [t for a, t in of(6) if a == "request"]  # never settled: asked again and again
    assert asked[0] == 8 and len(asked) >= 3


def documents(seed):
    """Batches of live documents."""
    rng = random.Random(seed)
    out, arrival = [], 0
    for n in range(4):
        batch = []
        for _ in range(25):
            b, arrival = rng.randrange(12), arrival + 1
            kind = rng.choice(["battle", "battle", "round", "live", "live", "final"])
            row = dict.fromkeys([x.split()[0] for x in cycle.DOCUMENTS.split(", ")])
            row |= {"kind": kind, "arrival": arrival, "battle_id": None if rng.random() < 0.05 else b, "attacker_damages": rng.randrange(100), "defender_damages": rng.randrange(100)}
            if kind == "battle":
                row |= {"created_at": minutes(-b), "updated_at": minutes(n), "gone": rng.random() < 0.2, "ended_at": minutes(n) if rng.random() < 0.1 else None}
            elif kind == "round":
                row |= {"number": rng.randrange(3)}
            else:
                row |= {"side": rng.randrange(1, 4), "entity_id": rng.randrange(4), "damage": rng.randrange(1000), "created_at": minutes(50 + n) if kind == "final" else None}
            batch.append(tuple(row.values()))
        out.append(batch)
    return out


def test_live_tables_equal_a_rebuild(spark, tmp_path):
    """After batches and a replay of all of them; partitions that a batch does not touch keep their files."""
    src, batches = f"file://{tmp_path}/src", documents(1)
    store = Published(spark, f"file://{tmp_path}/live", cycle.LIVE)
    tables = {t: spark.createDataFrame([], s) for t, s in cycle.LIVE.items()}
    for batch in batches:
        put(spark, batch, cycle.DOCUMENTS, src)
        cycle.follow_battles(source(spark, cycle.DOCUMENTS, src), store, f"file://{tmp_path}/ck", buckets=5).awaitTermination(200)
        new = cycle.cycle_step(tables, spark.createDataFrame(batch, cycle.DOCUMENTS))
        tables = {t: spark.createDataFrame(df.select(*tables[t].columns).collect(), tables[t].schema) for t, df in new.items()}
    for t, df in tables.items():
        assert rows_of(store.read(t).select(*df.columns)) == rows_of(df), t
    assert tables["entries"].count() and tables["stats"].count() and tables["battles"].where("ended_at is not null").count()
    version = store.manifest.newest()["version"]
    cycle.follow_battles(source(spark, cycle.DOCUMENTS, src), store, f"file://{tmp_path}/ck", buckets=5).awaitTermination(200)
    assert store.manifest.newest()["version"] == version
    one = [batches[0][0][:2] + (3,) + batches[0][0][3:]]
    files = lambda: {r[0] for r in store.read("battles").select("_metadata.file_path").collect()}
    before = files()
    put(spark, one, cycle.DOCUMENTS, src)
    cycle.follow_battles(source(spark, cycle.DOCUMENTS, src), store, f"file://{tmp_path}/ck", buckets=5).awaitTermination(200)
    assert len(before - files()) == 1


# Snapshots


def test_snapshots_by_week_and_type(spark, tmp_path):
    schema = "week_start timestamp_ntz, snapshot_at timestamp_ntz, entity_type int, entity_id long, value long"
    day = lambda n: dt.datetime(2026, 8, n)
    store = Published(spark, f"file://{tmp_path}/s", cycle.SNAPSHOTS)
    src = f"file://{tmp_path}/src"
    for batch in (
        [(day(3), day(4), 1, 7, 5), (day(3), day(4), 1, 7, 5), (day(3), day(4), 2, 9, 1), (None, day(4), 1, 8, 1)],
        [(day(3), day(4), 1, 8, 99), (day(3), day(5), 1, 7, 6)],  # the first is not newer than what is held
        [(day(10), day(11), 1, 7, 1)],  # type 1 has a new week, type 2 has not
        [(day(3), day(6), 2, 9, 2)],
    ):
        put(spark, batch, schema, src)
        cycle.follow_snapshots(source(spark, schema, src), store, f"file://{tmp_path}/ck").awaitTermination(200)
    got = sorted((r["entity_type"], r["snapshot_at"].day, r["entity_id"], r["value"]) for r in store.read("snapshots").collect())
    assert got == [(1, 5, 7, 6), (1, 11, 7, 1), (2, 4, 9, 1), (2, 6, 9, 2)]


# Usage


def test_requests_as_a_stream(spark, sf_dir, tmp_path):
    log = fixtures.usage_log(spark, sf_dir).withColumn("date_used", F.col("date_used").cast("timestamp"))
    path = f"file://{tmp_path}/in"
    log.coalesce(1).write.parquet(path)
    end = log.agg(F.max("date_used")).first()[0] + dt.timedelta(days=5)
    spark.createDataFrame([("x", end, 1)], log.schema).coalesce(1).write.mode("append").parquet(path)  # ends the last day
    spark.createDataFrame([("x", end, 1)], log.schema).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(path)
    q = cycle.usage_requests(stream).writeStream.format("memory").queryName("requests").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(200)
    assert rows_of(spark.table("requests")) == rows_of(usage.requests_per_day(log).select("day", "calls", "exact_requests", "legacy_requests"))


def test_retention_adds_late_calls(spark, tmp_path):
    store, src = Published(spark, f"file://{tmp_path}/u", cycle.USAGE), f"file://{tmp_path}/src"
    schema = cycle.USAGE["log"]
    follow = lambda: cycle.follow_usage(source(spark, schema, src), store, f"file://{tmp_path}/ck").awaitTermination(200)
    put(spark, [("e", 1, minutes(0)), ("e", 1, minutes(1)), ("f", 0, minutes(1)), ("e", 2, minutes(24 * 60)), ("e", 3, None)], schema, src)
    follow()
    assert cycle.retention(store, "2026-08-04") and cycle.retention(store, "2026-08-04") is None
    put(spark, [("e", 5, minutes(7))], schema, src)
    follow()
    assert [tuple(r)[1:] for r in store.read("totals").drop(PART).collect()] == [(3, 1, 1)]
    cycle.retention(store, "2026-08-04")
    assert cycle.retention(store, "2026-08-04") is None
    assert [tuple(r)[1:] for r in store.read("totals").drop(PART).collect()] == [(4, 2, 1)]
    assert rows_of(store.read("daily").select("endpoint", "calls", "last_used")) == Counter({("e", 3, minutes(7)): 1, ("f", 1, minutes(1)): 1})
    assert [r["request_id"] for r in store.read("log").collect()] == [2]
