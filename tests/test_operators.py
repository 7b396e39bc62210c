"""Operators on hand-made rows: nulls, ties, repeats, empty input, replays."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerforge import functions as fn
from ledgerforge.operators import browse, coverage, documents, merge, quality, usage, weekly
from ledgerforge.sources import ids, layout

T0 = dt.datetime(2026, 8, 1)
HOUR = 3_600_000_000


@pytest.mark.parametrize("tie", [20, 99, 100, 101, 150, 250, 1000])
@pytest.mark.parametrize("at", [0, 200, 399])
def test_keyset_pages_hold_every_row_once(spark, tie, at):
    rows = [(T0 + dt.timedelta(hours=i), f"aa{i:022x}") for i in range(400)] + [(T0 + dt.timedelta(hours=at), f"bb{i:022x}") for i in range(tie)]
    df = spark.createDataFrame(rows, "t timestamp_ntz, k string").coalesce(1).cache()
    everything = sorted(rows)
    # Pages are checked around the tie, both ways.
    for forward in (False, True):
        order = everything if forward else everything[::-1]
        start = max(0, order.index(next(r for r in order if r[1][0] == "b")) - 50)
        cursor = order[start - 1] if start else None
        seen = []
        while len(seen) < tie + 60 and start + len(seen) < len(order):
            page = [tuple(r) for r in browse.keyset_page(df, "t", "k", cursor, forward).collect()]
            if not page:
                break
            seen += page
            cursor = page[-1]
        assert seen == order[start : start + len(seen)]
    df.unpersist()


def test_dates_and_ranges():
    utc = dt.timezone.utc
    assert browse.parse_date("2026-08-01") == dt.datetime(2026, 8, 1, tzinfo=utc)
    assert browse.parse_date("01-08-26") == dt.datetime(2026, 8, 1, tzinfo=utc)
    assert browse.parse_date("2026-08-01T10:00:00+02:00") == dt.datetime(2026, 8, 1, 8, tzinfo=utc)
    assert browse.parse_date("1787414400000") == dt.datetime.fromtimestamp(1787414400, utc)
    assert browse.time_range(T0, 99999)[0] == T0 - dt.timedelta(hours=8784)
    low, high, strict = browse.time_range(T0, start=T0, end=T0 - dt.timedelta(days=1))
    assert low < high and not strict
    assert browse.page_count(0) == 1 and browse.page_count(101) == 2


def test_object_ids(spark):
    df = spark.createDataFrame([("65A1B2C3D4E5F60718293A4B",), (None,), ("zz",)], "oid string")
    u = df.select(fn.uuid_of(F.col("oid")).alias("u"), fn.oid_seconds(F.col("oid")).alias("s"))
    got = u.withColumn("back", fn.oid_of(F.col("u"))).collect()
    assert got[0]["u"] == "65a1b2c3-d4e5-f607-1829-3a4b00000000" and got[0]["back"] == "65a1b2c3d4e5f60718293a4b"
    assert got[0]["s"] == 0x65A1B2C3 and got[1]["u"] is None and got[2]["s"] is None


def test_shards_cover_each_key_once(spark):
    df = spark.range(100)
    assert sum(df.where(fn.shard(F.col("id"), 7, i)).count() for i in range(7)) == 100
    assert df.where(fn.shard(F.col("id"), 1, 0)).count() == 100


def test_whole_minutes(spark):
    df = spark.createDataFrame([(T0, T0 + dt.timedelta(seconds=150)), (T0 + dt.timedelta(seconds=5), T0 + dt.timedelta(seconds=50))], "a timestamp_ntz, b timestamp_ntz")
    first, last = fn.whole_minutes(F.col("a"), F.col("b"))
    got = df.select(first.alias("f"), last.alias("l")).collect()
    assert got[0]["f"] == T0 and got[0]["l"] == T0 + dt.timedelta(minutes=1)
    assert got[1]["l"] < got[1]["f"]


POLICIES = {"a": "new", "b": "old", "c": "coalesce", "d": "greatest", "e": "add"}
SCHEMA = "k long, a int, b int, c int, d int, e int, arrival int"


def _rows(df):
    return sorted(map(tuple, df.select("k", *POLICIES).collect()), key=str)


def test_merge_policies(spark):
    target = spark.createDataFrame([(1, 1, 1, 1, 5, 1, 0), (3, 3, 3, 3, 3, 3, 0)], SCHEMA)
    batch = spark.createDataFrame([(1, None, 2, None, 4, 2, 1), (1, 9, 8, 7, None, 1, 0), (2, 4, 4, None, None, None, 0)], SCHEMA)
    assert _rows(merge.merge(target, batch, ["k"], POLICIES)) == sorted([(1, None, 1, 7, 5, 4), (2, 4, 4, None, None, None), (3, 3, 3, 3, 3, 3)], key=str)
    with pytest.raises(ValueError):
        merge.merge(target, batch, ["k"], {"a": "last"})
    assert merge.merge(target.limit(0), batch.limit(0), ["k"], POLICIES).count() == 0


def test_any_split_of_a_batch_is_one_batch(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(6), rng.choice([None, 1, 2]), rng.randrange(9), rng.choice([None, 5, 6]), rng.randrange(9), 1, i) for i in range(40)]
    empty = spark.createDataFrame([], SCHEMA)
    whole = _rows(merge.merge(empty, spark.createDataFrame(rows, SCHEMA), ["k"], POLICIES))
    first = merge.merge(empty, spark.createDataFrame(rows[:17], SCHEMA), ["k"], POLICIES)
    assert _rows(merge.merge(first, spark.createDataFrame(rows[17:], SCHEMA), ["k"], POLICIES)) == whole


def test_insert_ignore_twice_is_once(spark):
    schema = "id string, at timestamp_ntz, v int, arrival int"
    batch = spark.createDataFrame([("a", T0, 1, 1), ("a", T0, 2, 0), ("b", T0, 3, 0), (None, T0, 4, 0)], schema)
    target = spark.createDataFrame([("b", T0, 9)], "id string, at timestamp_ntz, v int")
    new = merge.insert_ignore(target, batch, ["id", "at"], pruned_by="at")
    assert [tuple(r) for r in new.collect()] == [("a", T0, 2)]
    assert merge.insert_ignore(target.unionByName(new), batch, ["id", "at"]).count() == 0


def test_ids_are_dense_stable_and_only_for_new_keys(spark):
    known = spark.createDataFrame([("b", 7), ("z", 2)], "k string, id long")
    keys = spark.createDataFrame([("c",), ("b",), ("a",), ("c",), (None,)], "k string")
    once = merge.assign_ids(known, keys, "k")
    assert sorted(map(tuple, once.collect())) == [("a", 8), ("b", 7), ("c", 9), ("z", 2)]
    assert sorted(map(tuple, merge.assign_ids(once, keys, "k").collect())) == sorted(map(tuple, once.collect()))


def test_numbered(spark):
    rows = [(i % 13, i) for i in range(500)]
    df = spark.createDataFrame(rows, "a long, b long").repartition(5)
    got = {(r["a"], r["b"]): r["ordinal"] for r in browse.numbered(df, ["a", "b"], buckets=16).collect()}
    assert got == {r: i for i, r in enumerate(sorted(rows))}
    assert browse.numbered(df.limit(0), ["a", "b"]).count() == 0


def test_documents(spark):
    docs = [
        '{"_id":"AA","sellerMuId":null,"sellerCountryId":"c","itemCode":"gun","item":{"code":"helmet","skills":{"zz":3,"a":"x","b":4}}}',
        '{"_id":"AB","sellerCountryId":"c","itemCode":"gun","item":{"code":"gun","skills":{"attack":5,"criticalChance":6}}}',
        '{"sellerId":"x"}',
        '{"_id":"AC","sellerMuId":"m"}',
    ]
    got = {r["tx_id"]: r for r in documents.normalised(spark.createDataFrame([(d,) for d in docs], "doc string")).collect()}
    assert set(got) == {"aa", "ab", "ac"}
    assert got["aa"]["seller_second"] is None and got["ab"]["seller_second"] == "c" and got["ac"]["seller_second"] == "m"
    assert got["aa"]["result_code"] == "helmet" and got["ab"]["result_code"] is None
    assert (got["aa"]["skill_1"], got["aa"]["skill_2"]) == (4, None) and (got["ab"]["skill_1"], got["ab"]["skill_2"]) == (5, 6) and got["ac"]["skill_1"] is None


def test_loot_skills(spark):
    df = spark.createDataFrame([('{"dodge":4,"attack":0}',), ('{"b":0,"a":7,"criticalChance":2}',), (None,)], "j string")
    a, b = documents.loot_skills(F.col("j"))
    assert [tuple(r) for r in df.select(a, b).collect()] == [(4, None), (None, 2), (None, None)]


def test_bounties_and_minimised_rounds(spark):
    side = "struct<money_pool:double,per_1k:double,effective_at:timestamp_ntz,is_national:boolean>"
    df = spark.createDataFrame([(1, (None, None, None, True), (None, None, None, None))], f"battle_id long, attacker {side}, defender {side}")
    assert [tuple(r)[:2] for r in documents.unpivot_bounties(df).collect()] == [(1, 1)]
    s = "struct<country:string,tournamentTeam:string,damages:long,hitCount:int,points:int,extra:int>"
    rounds = spark.createDataFrame([], f"_id string, battle string, number int, createdAt string, updatedAt string, endedAt string, aboutToEndNotifiedAt string, wonBy string, live string, junk int, attacker {s}, defender {s}")
    out = documents.minimised(rounds)
    assert "junk" not in out.columns and len(out.schema["attacker"].dataType.fields) == 5


def _spans(df):
    return sorted((r["stream"], r["from_us"], r["to_us"]) for r in df.collect())


NOW = 1_787_414_400_000_000
EDGE = NOW - 72 * HOUR


def test_window_edge_cases(spark):
    """A long outage leaves one span; a healthy run none; an expired band is recorded; ten cycles are one span."""
    make = lambda rows: spark.createDataFrame([("s", a, b) for a, b in rows], "stream string, from_us long, to_us long")
    state = lambda df, s: _spans(df.where(F.col("state") == s))
    outage = coverage.clip_spans(make([(NOW - 80 * HOUR, NOW)]), F.lit(EDGE))
    assert state(outage, "lost") == [("s", NOW - 80 * HOUR, EDGE)]
    assert state(coverage.clip_spans(make([(NOW - HOUR // 2, NOW)]), F.lit(EDGE)), "lost") == []
    expired = coverage.clip_spans(make([(EDGE - 2 * HOUR, EDGE - HOUR)]), F.lit(EDGE))
    assert state(expired, "lost") == [("s", EDGE - 2 * HOUR, EDGE - HOUR)] and state(expired, "pending") == []
    assert _spans(coverage.union_spans(make([(NOW - 80 * HOUR, EDGE)] * 10))) == [("s", NOW - 80 * HOUR, EDGE)]
    touching = make([(0, 5), (5, 9), (20, 30), (10, 10)])
    assert _spans(coverage.union_spans(touching)) == [("s", 0, 9), ("s", 20, 30)]


def test_watermark_never_falls(spark):
    bands = spark.createDataFrame([("s", 10, 20, True), ("s", 20, 30, False), ("s", 0, 10, True), ("t", 0, 10, True)], "stream string, band_from long, band_to long, done boolean")
    stored = spark.createDataFrame([("t", 50), ("u", 1)], "stream string, covered long")
    assert sorted(map(tuple, coverage.watermark(bands, stored).collect())) == [("s", 20), ("t", 50), ("u", 1)]


def test_span_algebra_against_sets(spark):
    rng = random.Random(2)
    want, done = ([(s, a, a + rng.randrange(9)) for s in "ab" for a in (rng.randrange(60) for _ in range(8))] for _ in range(2))
    make = lambda rows: spark.createDataFrame(rows, "stream string, from_us long, to_us long")
    points = lambda rows: {(s, x) for s, a, b in rows for x in range(a, b)}
    assert points(_spans(coverage.subtract_spans(make(want), make(done)))) == points(want) - points(done)
    assert points(_spans(coverage.union_spans(make(want)))) == points(want)
    once = coverage.union_spans(make(want))
    assert _spans(coverage.union_spans(once)) == _spans(once)


def test_bands_are_contiguous(spark):
    df = spark.createDataFrame([("s", 0, 1_000_000_007), ("t", 5, 5), ("u", 0, 10**12)], "stream string, from_us long, to_us long")
    got = {}
    for r in coverage.bands(df).collect():
        got.setdefault(r["stream"], []).append((r["band"], r["band_from"], r["band_to"]))
    assert set(got) == {"s", "u"} and len(got["u"]) == 50
    for rows in got.values():
        rows.sort()
        assert all(a[1] == b[2] for a, b in zip(rows, rows[1:], strict=False)) and rows[-1][1] == 0


def test_grid_and_runs_of_empty_input(spark):
    none = spark.createDataFrame([], "created_at timestamp_ntz")
    cells = coverage.grid(none, T0).groupBy("state").count().collect()
    assert {r["state"] for r in cells} == {"err", "outside"} or {r["state"] for r in cells} == {"err"}
    runs = coverage.empty_runs(coverage.minute_counts(none), T0, T0 + dt.timedelta(hours=1)).collect()
    assert [tuple(r) for r in runs] == [(T0, T0 + dt.timedelta(hours=1))]


def test_thin_minutes_across_days(spark):
    rng = random.Random(3)
    minutes = sorted(rng.sample(range(0, 5000, 7), 300)) + [20_000, 20_001]
    counts = [(T0 + dt.timedelta(minutes=m), rng.choice([1, 50, 60])) for m in minutes]
    df = spark.createDataFrame(counts, "minute timestamp_ntz, n long")
    want = {m for i, (m, n) in enumerate(counts) if n < 0.35 * (sum(x for _, x in counts[max(0, i - 20) : i + 21]) / len(counts[max(0, i - 20) : i + 21]))}
    assert {r["minute"] for r in coverage.thin_minutes(df).collect()} == want


def test_audit_of_empty_source(spark):
    schema = "code string, id string"
    got = coverage.audit(spark.createDataFrame([("a", "1"), ("a", "2")], schema), spark.createDataFrame([("a", "1"), ("b", "9")], schema), "code", "id").collect()
    assert {r["code"]: (r["source_n"], r["stored_n"], r["missing"], r["store_only"], r["coverage"]) for r in got} == {"a": (2, 1, 1, 0, 50.0), "b": (0, 1, 0, 1, 100.0)}


def test_audit_by_digests(spark):
    rng = random.Random(2)
    left = [(rng.choice(["a", "b", None]), str(rng.randrange(400)) if rng.random() < 0.99 else None) for _ in range(600)]
    right = list({x for x in left if rng.random() < 0.9} | {("a", f"x{i}") for i in range(5)} | {("c", "1")})
    schema = "code string, id string"
    for bucket in (None, F.length("id"), F.lit(1)):
        got = coverage.audit(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), "code", "id", bucket)
        for code in "abc":
            s, h = ({i for c, i in side if c == code and i is not None} for side in (left, right))
            r = got.where(F.col("code") == code).first()
            nulls = [int(any(x == (code, None) for x in side)) for side in (left, right)]
            assert (r["source_n"], r["stored_n"], r["missing"], r["store_only"]) == (len(s) + nulls[0], len(h) + nulls[1], len(s - h) + nulls[0], len(h - s) + nulls[1])
    plan = coverage.audit(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), "code", "id")
    assert "LeftSemi" in plan._jdf.queryExecution().executedPlan().toString()  # ids of open buckets alone go on to the comparison


def test_spans_by_pieces(spark):
    """One hot stream in many pieces, and others, null among them."""
    rng = random.Random(5)
    rows = [(rng.choice(["hot", "hot", "hot", "b", None]), a := rng.randrange(3000), a + rng.randrange(-2, 12)) for _ in range(700)] + [("hot", 10, 900), ("late", 5, 5)]
    done = [(rng.choice(["hot", "b", None]), a := rng.randrange(3000), a + rng.randrange(0, 30)) for _ in range(60)]
    frame = lambda r: spark.createDataFrame(r, "stream string, from_us long, to_us long")
    points = lambda r: {(s, x) for s, a, b in r for x in range(a, b)}
    got = [tuple(r) for r in coverage.union_spans(frame(rows), piece=40).select("stream", "from_us", "to_us").collect()]
    assert points(got) == points(rows) and len(got) == len({(s, x) for s, x in points(rows) if (s, x - 1) not in points(rows)})
    rest = [tuple(r) for r in coverage.subtract_spans(frame(rows), frame(done), piece=40).select("stream", "from_us", "to_us").collect()]
    want = points(rows) - points(done)
    assert points(rest) == want and len(rest) == len({(s, x) for s, x in want if (s, x - 1) not in want})
    assert coverage.union_spans(frame([])).count() == 0 and coverage.subtract_spans(frame([]), frame(done)).count() == 0


def test_carried_sums_minima_and_maxima(spark):
    rng = random.Random(6)
    rows = [(rng.choice("ab"), i, rng.choice([None, 1, 5, -3])) for i in range(200)]
    held = browse.in_pieces(spark.createDataFrame(rows, "k string, i int, v long"), ["k", "i"], piece=15)
    for upto in (-1, 0):
        got = browse.carried(held, ["k"], {"s": ("sum", "v"), "lo": ("min", "v"), "hi": ("max", "v")}, upto).collect()
        for r in got:
            before = [v for k, i, v in rows if k == r["k"] and i < r["i"] + upto + 1 and v is not None]
            assert (r["s"], r["lo"], r["hi"]) == ((sum(before), min(before), max(before)) if before else (None, None, None))
        assert len(got) == len(rows)


def test_files_of_a_busy_segment_are_alike(spark, tmp_path):
    path = f"file://{tmp_path}/tx"
    rows = [(T0 + dt.timedelta(seconds=i), "t" if i % 10 else "u", "c", f"{i}") for i in range(5000)] + [(T0 + dt.timedelta(days=1), "t", "c", "x"), (None, "t", "c", "y")]
    df = spark.createDataFrame(rows, "created_at timestamp_ntz, tx_type string, item_code string, tx_id string")
    layout.write(df, path, "transactions", rows_a_file=700, piece=300)
    table = spark.read.parquet(path).withColumn("f", F.col("_metadata.file_path"))
    sizes = {}
    for r in table.groupBy("day", "f").agg(F.count("*").alias("n"), F.min("tx_type").alias("a"), F.max("tx_type").alias("b")).collect():
        sizes.setdefault(str(r["day"]), []).append(r["n"])
    assert sorted(len(x) for x in sizes.values()) == [1, 1, 8] and table.count() == len(rows)
    assert all(max(x) <= min(x) + 1 for x in sizes.values())
    layout.write(df.limit(0), f"{path}-none", "transactions")


def test_usage_fold_adds_late_rows_and_repeats_nothing(spark):
    at = lambda day, hour=0: T0 + dt.timedelta(days=day, hours=hour)
    schema = "endpoint string, date_used timestamp_ntz, request_id long, arrival int"
    log = spark.createDataFrame([("e", T0, 1, 1), ("e", T0, 1, 1), ("f", at(0, 1), 0, 1), ("e", at(2), 2, 1)], schema)
    late = spark.createDataFrame([("e", at(0, 5), 1, 2), ("e", at(0, 5), None, 2)], schema)
    cut = F.lit(at(1)).cast("timestamp_ntz")
    none = usage.rollup_daily(log.limit(0)), usage.requests_per_day(log.limit(0))
    ledger = spark.createDataFrame([], "arrival int, rolled_to timestamp_ntz")
    daily, totals, rest, ledger = usage.fold(*none, log, ledger, cut)
    want = {("e", 2, T0), ("f", 1, at(0, 1))}
    for _ in range(2):
        assert {(r["endpoint"], r["calls"], r["last_used"]) for r in daily.collect()} == want
        assert [tuple(r)[1:] for r in totals.collect()] == [(3, 1, 1)] and rest.count() == 1
        daily, totals, rest, ledger = usage.fold(daily, totals, log, ledger, cut)  # over rows that are still there
    daily, totals, rest, ledger = usage.fold(daily, totals, log.unionByName(late), ledger, cut)
    assert {(r["endpoint"], r["calls"], r["last_used"]) for r in daily.collect()} == {("e", 4, at(0, 5)), ("f", 1, at(0, 1))}
    assert [tuple(r)[1:] for r in totals.collect()] == [(5, 2, 1)]


def test_signed_corrections(spark):
    posts = spark.createDataFrame([(1, T0, 5)], "user_id long, week_start timestamp_ntz, post long")
    assert sorted(r["amount"] for r in weekly.signed_corrections(posts).collect()) == [-5, 5]


def test_keys_and_duplicates(spark):
    rows = [(1, 1, 3, 1, 7, 5), (1, 1, 3, 1, 7, 5), (1, 1, 1, 1, 8, 5)]
    df = spark.createDataFrame(rows, "battle_id long, round_number int, side int, entity_type int, entity_id long, damage long")
    assert quality.duplicates(df).count() == 1 and [r["entity_id"] for r in quality.orphans(df).collect()] == [7]


def test_id_list(spark, tmp_path):
    (tmp_path / "ids.csv").write_text(f"id,name\n{'A' * 24},x\n{'a' * 24}\nbad\n{'0' * 24},y,z\n")
    lines = ids.read(spark, f"file://{tmp_path}/ids.csv")
    assert tuple(ids.report(lines).first()) == (5, 2, 1)
    known = spark.createDataFrame([("a" * 24,)], "external_id string")
    got = ids.new_ids(lines, known).collect()
    assert [(r["external_id"], r["created_at"]) for r in got] == [("0" * 24, dt.datetime(1970, 1, 1))]
    ids.export(spark.createDataFrame([(2, "b", None), (1, "a", "n")], "id long, hex string, username string"), f"file://{tmp_path}/out", files=1)
    assert "".join(p.read_text() for p in (tmp_path / "out").glob("*.csv")) == "id,hex,username\n1,a,n\n2,b,\n"


def test_layout_prunes_and_replaces(spark, tmp_path):
    path = f"file://{tmp_path}/tx"
    rows = spark.createDataFrame([(T0 + dt.timedelta(hours=i), "t", f"{i}") for i in range(72)], "created_at timestamp_ntz, tx_type string, tx_id string")
    layout.write(rows, path, "transactions")
    layout.write(rows.where("day(created_at) = 2").limit(1), path, "transactions")
    table = spark.read.parquet(path)
    assert table.count() == 49
    some = layout.with_bounds(table, "day", T0, T0 + dt.timedelta(hours=5))
    assert some.count() == 5 and "PartitionFilters: [isnotnull(day" in some._jdf.queryExecution().toString()


def test_no_plan_deals_data_to_one_task(spark, sf_dir):
    """No exchange to a single partition but for aggregates without keys and top-k, and no nested-loop join."""
    from ledgerforge.plans import QUERIES

    for name in ("every_nth", "rank_cap_300", "thin_minutes", "v_battle_details", "user_history", "weekly_damage", "span_subtract"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan, name
    for name in ("every_nth", "ordinal_range", "thin_minutes", "row_slices", "listing_age_summary"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan, name


def test_random_sample_is_the_same_on_each_run(spark):
    rows = spark.range(500).withColumnRenamed("id", "k")
    one, two, other = ({r["k"] for r in browse.random_sample(df, "k", 30, seed).collect()} for df, seed in ((rows, "a"), (rows.repartition(7), "a"), (rows, "b")))
    assert one == two != other and len(one) == 30


def test_seeds_and_dead_stamps(spark):
    held = spark.createDataFrame([("buy", 1)], "kind string, id bigint")
    once = merge.seeded(held, ["buy", "sell", "gift"], "kind")
    assert {r["id"] for r in once.collect()} == {1, 2, 3} and {r["kind"] for r in once.where("id > 1").collect()} == {"gift", "sell"}
    assert merge.seeded(once, ["buy", "sell", "gift"], "kind").count() == 3
    users = spark.createDataFrame([(1, None), (2, "2024-01-01"), (3, None), (None, None)], "user_id int, checked string")
    out = merge.stamp_dead(users, spark.createDataFrame([(1,), (1,), (2,), (None,)], "user_id int"), "user_id", "checked", F.lit("now"))
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(1, "now"), (2, "2024-01-01"), (3, None), (None, None)], key=str)


def test_usage_log_registers_endpoints_and_requests(spark):
    log = spark.createDataFrame([], "endpoint_id bigint, request_id bigint, date_used int")
    ends, asks = spark.createDataFrame([("/a", 4)], "endpoint string, id bigint"), spark.createDataFrame([], "request string, id bigint")
    calls = spark.createDataFrame([("/a", "r1", 1), ("/b", "r1", 2), ("/b", None, 3), (None, "r2", 4), ("/b", None, 3)], "endpoint string, request string, date_used int")
    log, ends, asks = usage.append(log, ends, asks, calls)
    assert sorted(map(tuple, log.collect())) == [(4, 1, 1), (5, 0, 3), (5, 0, 3), (5, 1, 2)]
    log, ends, asks = usage.append(log, ends, asks, calls)
    assert log.count() == 8 and ends.count() == 2 and asks.count() == 1


def test_who_is_due_for_a_recheck(spark):
    at = lambda x: F.lit(f"2024-01-08 {x}").cast("timestamp_ntz")
    rows = spark.sql("""SELECT * FROM VALUES (1, TIMESTAMP_NTZ '2024-01-08 09:59:00', CAST(NULL AS TIMESTAMP_NTZ)), (2, TIMESTAMP_NTZ '2024-01-08 11:00:00', NULL),
        (3, NULL, TIMESTAMP_NTZ '2024-01-08 11:40:00'), (4, NULL, TIMESTAMP_NTZ '2024-01-08 11:30:00'), (5, NULL, NULL) AS v(entity_id, last_connected, last_checked)""")
    assert [r["entity_id"] for r in weekly.due_for_recheck(rows, at("12:00:00")).collect()] == [1, 5, 4]
    assert [r["entity_id"] for r in weekly.due_for_recheck(rows, at("12:00:00"), budget=2).collect()] == [1, 5]
    battles = spark.sql("SELECT * FROM VALUES (7, TIMESTAMP_NTZ '2024-01-07 00:00:00', CAST(NULL AS TIMESTAMP_NTZ)), (8, TIMESTAMP_NTZ '2024-01-09 00:00:00', NULL) AS v(battle_id, created_at, ended_at)")
    entries = spark.createDataFrame([(1, 7), (4, 8)], "entity_id int, battle_id int")
    assert sorted(r["entity_id"] for r in weekly.without_open_battles(rows, entries, battles, at("00:00:00")).collect()) == [2, 3, 4, 5]


def test_sums_before_by_pieces(spark):
    rows = [(k, i, (i * 7) % 5) for k in ("a", "b", None) for i in range(60)] + [("c", None, 4), ("c", 1, 2)]
    df = spark.createDataFrame(rows, "k string, i int, n bigint").repartition(7)
    got = {(r["k"], r["i"]): r["before"] for r in browse.summed_before(df, "k", "i", "n", piece=10).collect()}
    for k in ("a", "b", None):
        total = 0
        for i in range(60):
            assert got[(k, i)] == total
            total += (i * 7) % 5
    assert got[("c", None)] == 0 and got[("c", 1)] == 4 and len(got) == len(rows)
    assert browse.summed_before(df.limit(0), "k", "i", "n").count() == 0


def test_merged_rows_against_their_sides(spark):
    rows = [(1, 1, 1, 5, 1, 10), (1, 1, 1, 5, 2, 5), (1, 1, 1, 5, 3, 15), (1, 1, 1, 6, 1, 3), (1, 1, 1, 6, 3, 4), (1, 1, 1, 7, 3, 9), (2, 1, 1, 8, 1, None), (2, 1, 1, 8, 3, None)]
    df = spark.createDataFrame(rows, "battle_id int, round_number int, entity_type int, entity_id int, side int, damage bigint")
    assert sorted(r["entity_id"] for r in quality.leftovers(df, ["damage"]).collect()) == [5, 8]
    assert sorted(r["entity_id"] for r in quality.exceptions(df).collect()) == [5, 6, 8]
    level = df.groupBy("battle_id", "entity_type", "entity_id", "side").agg(F.sum("damage").alias("damage"))
    assert [r["entity_id"] for r in quality.orphans(level, ["battle_id", "entity_type", "entity_id"]).collect()] == [7]


def test_broken_keys_and_references(spark):
    rows = spark.createDataFrame([(1, 10), (1, 10), (1, 10), (2, 11), (None, 12), (3, None)], "id int, parent int")
    parents = spark.createDataFrame([(10,), (10,), (12,), (None,)], "k int")
    got = {r["check"]: r["rows"] for r in quality.key_violations(rows, ["id"], {"parent": (parents, "k")}).collect()}
    assert got == {"repeated key": 2, "null key": 1, "parent without parent": 1}
    empty = {r["check"]: r["rows"] for r in quality.key_violations(rows.limit(0), ["id"], {"parent": (parents, "k")}).collect()}
    assert set(empty.values()) == {0}


def test_first_sightings_that_tie_go_by_the_file(spark, tmp_path):
    """An item that one order line names twice, in the target, in the batch and in both."""
    import duckdb
    from oracle import same

    from ledgerforge.plans import ORACLES, QUERIES

    flags = [(item, order, flag) for item in (4, 7, 6) for order in (2, 3) for flag in ("R", "A", "N")]
    rows = ", ".join(f"({item}, {order}, 1, '{flag}', TIMESTAMP '1996-01-0{order}')" for item, order, flag in flags)
    con = duckdb.connect()
    con.execute(f"COPY (FROM (VALUES {rows}) t(l_partkey, l_orderkey, l_linenumber, l_returnflag, l_shipdate)) TO '{tmp_path}/lineitem.parquet'")
    con.execute(f"CREATE VIEW lineitem AS FROM '{tmp_path}/lineitem.parquet'")
    found = QUERIES["item_merge"](spark, str(tmp_path))
    assert {r["code"] for r in found.collect()} == {"R"}
    same(found, con, ORACLES["item_merge"])


def test_object_ids_beyond_32_bits(spark, tmp_path):
    import duckdb
    from oracle import same

    from ledgerforge.plans import ORACLES, QUERIES

    orders = [(0, 5), (2_655_752, 1), (2_655_753, 2), (54_000_000, 900_000)]  # around 2 ** 32 seconds
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW orders AS FROM '{tmp_path}/orders.parquet/*.parquet'")
    same(QUERIES["oid_timestamp"](spark, str(tmp_path)), con, ORACLES["oid_timestamp"])
    text = spark.createDataFrame([("1" + "0" * 24,), ("65a1b2c3-d4e5-f607-1829-3a4b0000",)], "oid string")
    assert [r["s"] for r in text.select(fn.oid_seconds(F.col("oid")).alias("s")).collect()] == [1 << 32, 0x65A1B2C3]


@pytest.mark.parametrize("size", [1, 3, 5])
def test_slices_whose_ends_fall_on_one_time(spark, size):
    rng = random.Random(size)
    rows = [(k, T0 + dt.timedelta(hours=h)) for k in "ab" for h in range(9) for _ in range(rng.choice([0, 1, 2, 7, 16]))]
    got = coverage.row_slices(spark.createDataFrame(rows, "k string, t timestamp_ntz"), "k", "t", size)
    times = {k: sorted(t for x, t in rows if x == k) for k in "ab"}
    want = [(k, i // size, t) for k, ts in times.items() for i, t in enumerate(ts) if i and i % size == 0]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_long_rounds_make_two_rows_an_entry(spark):
    """Rounds that cross up to hundreds of resets, against each reset by itself."""
    rng = random.Random(4)
    rounds, entries = [], []
    monday = dt.datetime(2026, 8, 3)
    for b in range(40):
        start = rng.choice([monday, T0]) + dt.timedelta(hours=rng.randrange(800))
        end = rng.choice([start, start + dt.timedelta(hours=1), start + dt.timedelta(days=rng.randrange(3000)), monday + dt.timedelta(days=70), None])
        rounds.append((b, 1, start, end))
        entries += [(b, 1, rng.choice([1, 2, 3, None]), rng.choice([1, 2, 3]), rng.choice([0, 5, 8, None])) for _ in range(rng.randrange(4))]
    got = weekly.straddlers(spark.createDataFrame(entries, "battle_id long, round_number int, entity_id long, side int, damage long"), spark.createDataFrame(rounds, "battle_id long, number int, created_at timestamp_ntz, ended_at timestamp_ntz"))
    want = {}
    for b, _, entity, side, damage in entries:
        _, _, start, end = rounds[b]
        reset = dt.datetime.combine(start.date() - dt.timedelta(days=start.weekday() - 7), dt.time())
        while end and side < 3 and damage is not None and reset < end:
            want[entity, reset] = want.get((entity, reset), 0) + damage
            reset += dt.timedelta(days=7)
    assert len(want) > 400 and {(r["entity_id"], r["week_start"]): r["straddle"] for r in got.collect()} == want
    plan = got._jdf.queryExecution().optimizedPlan().toString().split("\n")
    join = next(i for i, line in enumerate(plan) if "Join" in line)
    assert not any("Generate" in line for line in plan[join:])


def test_merged_rows_are_counted_in_one_pass(spark):
    """Against the functions of each check; null keys, sides and measures; nothing at all."""
    rng = random.Random(6)
    rows = [(rng.choice([1, 2, None]), rng.choice([1, 2, 3]), 1, rng.choice([7, 8, None]), rng.choice([1, 2, 3, 3, 3, None]), rng.choice([4, 4, None])) for _ in range(60)]
    schema = "battle_id long, round_number int, entity_type int, entity_id long, side int, damage long"
    for some in (rows, rows[:7], []):
        df = spark.createDataFrame(some, schema)
        got = quality.merged_counts(df, ["damage"])
        want = [f.count() for f in (quality.orphans(df), quality.duplicates(df), quality.leftovers(df, ["damage"]), quality.exceptions(df), df.where("side = 3"))]
        assert [tuple(r) for r in got.collect()] == [tuple(want)]
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_entries_meet_their_rounds_once(spark):
    """All parts of the totals from one join with the rounds, against the single operators joined by user and week."""
    rng = random.Random(6)
    monday = dt.datetime(2026, 8, 3)
    at = lambda: monday + dt.timedelta(hours=rng.randrange(2000))
    rounds, entries, battles = [], [], []
    for b in range(300):
        began = at()
        battles.append((b, began, rng.choice([None, None, began + dt.timedelta(days=2)])))
        rounds += [(b, n, start, rng.choice([(start or monday) + dt.timedelta(hours=rng.randrange(1200)), None])) for n in (1, 2) for start in [rng.choice([at(), at(), None])]]
        entries += [(b, rng.choice([1, 2, 3]), rng.randrange(8), rng.choice([1, 2, 3, None]), rng.choice([0, 5, 8, None])) for _ in range(rng.randrange(9))]
    amounts = [(u, monday + dt.timedelta(days=7 * k), rng.choice([-4, 0, 7, None])) for u in range(12) for k in range(12) if rng.random() < 0.5]
    entries = spark.createDataFrame(entries, "battle_id long, round_number int, entity_id long, side int, damage long")
    rounds = spark.createDataFrame(rounds, "battle_id long, number int, created_at timestamp_ntz, ended_at timestamp_ntz")
    battles = spark.createDataFrame(battles, "battle_id long, created_at timestamp_ntz, ended_at timestamp_ntz")
    amounts = spark.createDataFrame(amounts, "user_id long, week_start timestamp_ntz, amount long")
    got = weekly.explained(entries, rounds, battles, amounts)
    rows = lambda df, *names: {(r["entity_id"], r["week_start"]): tuple(r[n] for n in names) for r in df.collect()}
    straddle = rows(weekly.straddlers(entries, rounds), "straddle")
    derived = rows(weekly.weekly_damage(entries, rounds, amounts).withColumnRenamed("user_id", "entity_id"), "damage")
    active = rows(weekly.active_damage(entries, battles), "active", "began")
    first = {u: min(began for (x, _), (_, began) in active.items() if x == u) for u, _ in active}
    want = {k: (*v, *derived.get(k, (None,)), active.get(k, (None,))[0], first.get(k[0])) for k, v in straddle.items()}
    assert len(want) > 60 and all(len({v[i] is None for v in want.values()}) == 2 for i in (1, 2))
    assert rows(got, "straddle", "derived", "active", "first") == want and got.count() == len(want)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 2


def test_only_accounts_that_wait_are_worked_through(spark, sf_dir, monkeypatch):
    from ledgerforge import fixtures
    from ledgerforge.plans import QUERIES

    seen, explained = [], weekly.explained
    monkeypatch.setattr(weekly, "explained", lambda entries, *rest: [seen.append(entries), explained(entries, *rest)][1])
    QUERIES["reconcile_due"](spark, sf_dir)
    now = dt.datetime(1999, 6, 1)
    wait = {a["account_id"] for a in fixtures.account(spark, sf_dir).collect() if (not a["last_active_at"] or a["last_active_at"] <= now - dt.timedelta(hours=2)) and (not a["checked_at"] or a["checked_at"] <= now - dt.timedelta(minutes=30))}
    every = [r["entity_id"] for r in fixtures.rank_entry(spark, sf_dir).select("entity_id").collect()]
    assert sorted(r["entity_id"] for r in seen[0].collect()) == sorted(u for u in every if u in wait)
    assert 0 < len(wait & set(every)) < len(set(every))
