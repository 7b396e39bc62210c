"""Time coverage and audits."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerforge import fixtures as t
from ledgerforge.functions import shard
from ledgerforge.operators import browse, coverage as c
from ledgerforge.plans.registry import CRC_TABLE, crc32_sql, query

MINUTES = ", m AS (SELECT date_trunc('minute', created_at) AS minute, count(*) AS n FROM tx_live GROUP BY 1)"


@query("tx_live", MINUTES + ", w AS (SELECT *, avg(n) OVER (ORDER BY minute ROWS BETWEEN 20 PRECEDING AND 20 FOLLOWING) AS mean FROM m) SELECT minute, n, round(mean, 6) AS mean FROM w WHERE n < 0.9 * mean")
def thin_minutes(spark: SparkSession, d: str) -> DataFrame:
    return c.thin_minutes(c.minute_counts(t.tx_live(spark, d)), share=0.9)


@query(
    "tx_live",
    MINUTES
    + """, g AS (SELECT range AS minute FROM range(TIMESTAMP '2024-01-05', TIMESTAMP '2024-01-20', INTERVAL 1 MINUTE)),
e AS (SELECT minute, minute - to_minutes(row_number() OVER (ORDER BY minute)) AS island FROM g WHERE minute NOT IN (SELECT minute FROM m))
SELECT min(minute) AS run_start, max(minute) + INTERVAL 1 MINUTE AS run_end FROM e GROUP BY island""",
)
def empty_runs(spark: SparkSession, d: str) -> DataFrame:
    return c.empty_runs(c.minute_counts(t.tx_live(spark, d)), dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 20))


STREAMS = ", s AS (SELECT tx_type AS stream, epoch_us(min(created_at)) AS from_us, epoch_us(max(created_at)) AS to_us FROM tx_live GROUP BY 1)"


def streams(spark: SparkSession, d: str) -> DataFrame:
    us = lambda x: F.unix_micros(x.cast("timestamp"))
    return t.tx_live(spark, d).groupBy(F.col("tx_type").alias("stream")).agg(us(F.min("created_at")).alias("from_us"), us(F.max("created_at")).alias("to_us"))


BANDS = STREAMS + """, n AS (SELECT *, CAST(least(50, greatest(1, floor((to_us - from_us) / 180000000))) AS BIGINT) AS n FROM s),
b AS (SELECT stream, CAST(i AS INTEGER) AS band, to_us - (to_us - from_us) * (i + 1) // n AS band_from, to_us - (to_us - from_us) * i // n AS band_to FROM n, range(0, 50) r(i) WHERE i < n)
"""


@query("tx_live", BANDS + "SELECT * FROM b")
def time_bands(spark: SparkSession, d: str) -> DataFrame:
    return c.bands(streams(spark, d))


@query("tx_live", BANDS + ", o AS (SELECT stream, min(band_from) FILTER (band % 7 = length(stream) % 7) AS open, max(band_to) AS top FROM b GROUP BY 1) SELECT stream, greatest(CAST(1705000000000000 AS BIGINT), coalesce(open, top)) AS covered FROM o")
def coverage_watermark(spark: SparkSession, d: str) -> DataFrame:
    rows = c.bands(streams(spark, d))
    stored = rows.select("stream").distinct().withColumn("covered", F.lit(1_705_000_000_000_000))
    return c.watermark(rows.withColumn("done", F.col("band") % 7 != F.length("stream") % 7), stored)


@query("tx", ", n AS (SELECT item_code, created_at, row_number() OVER (PARTITION BY item_code ORDER BY created_at) - 1 AS i FROM tx) SELECT item_code, CAST(i // 500 AS BIGINT) AS slice, created_at AS slice_end FROM n WHERE i % 500 = 0 AND i > 0")
def row_slices(spark: SparkSession, d: str) -> DataFrame:
    counted = c.row_slices(t.tx(spark, d), "item_code", "created_at", 500)
    return counted


SPANS = ", spans AS (SELECT tx_type AS stream, epoch_us(created_at) AS from_us, epoch_us(created_at) + 60000000 * (account_id % 120 + 1) AS to_us FROM tx_live)"


def spans(spark: SparkSession, d: str) -> DataFrame:
    us = F.unix_micros(F.col("created_at").cast("timestamp"))
    return t.tx_live(spark, d).select(F.col("tx_type").alias("stream"), us.alias("from_us"), (us + 60_000_000 * (F.col("account_id") % 120 + 1)).alias("to_us"))


UNION = SPANS + """, f AS (SELECT *, max(to_us) OVER (PARTITION BY stream ORDER BY from_us, to_us ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM spans),
i AS (SELECT *, sum(CASE WHEN reach IS NULL OR from_us > reach THEN 1 ELSE 0 END) OVER (PARTITION BY stream ORDER BY from_us, to_us ROWS UNBOUNDED PRECEDING) AS island FROM f),
u AS (SELECT stream, min(from_us) AS from_us, max(to_us) AS to_us FROM i GROUP BY stream, island)
"""


@query("tx_live", UNION + "SELECT * FROM u")
def span_union(spark: SparkSession, d: str) -> DataFrame:
    return c.union_spans(spans(spark, d))


EDGE = 1_705_400_000_000_000


@query("tx_live", UNION + f"SELECT stream, 'lost' AS state, from_us, least(to_us, {EDGE}) AS to_us FROM u WHERE from_us < {EDGE} UNION ALL SELECT stream, 'pending', greatest(from_us, {EDGE}), to_us FROM u WHERE to_us > {EDGE}")
def span_clip(spark: SparkSession, d: str) -> DataFrame:
    return c.clip_spans(c.union_spans(spans(spark, d)), F.lit(EDGE))


@query("tx_live", UNION + ", s AS (SELECT tx_type AS stream, epoch_us(min(created_at)) AS from_us, epoch_us(max(created_at)) AS to_us FROM tx_live GROUP BY 1), p AS (SELECT u.stream, u.to_us AS a, lead(u.from_us, 1, s.to_us) OVER (PARTITION BY u.stream ORDER BY u.from_us) AS b FROM u JOIN s USING (stream)) SELECT stream, a AS from_us, b AS to_us FROM p WHERE b > a")
def span_subtract(spark: SparkSession, d: str) -> DataFrame:
    return c.subtract_spans(streams(spark, d), spans(spark, d))


WALKS = STREAMS + ", w AS (SELECT from_us AS floor, to_us AS top, from_us + (to_us - from_us) * length(stream) // 10 AS covered, stream = 'error' AS done FROM s)"


@query("tx_live", WALKS + " SELECT round(avg(CASE WHEN done THEN 1.0 ELSE least(1.0, greatest(0.0, CAST(covered - floor AS DOUBLE) / (top - floor))) END) * 100, 4) AS percent, count(*) AS walks FROM w")
def walk_progress(spark: SparkSession, d: str) -> DataFrame:
    rows = streams(spark, d).select(F.col("from_us").alias("floor"), F.col("to_us").alias("top"), F.expr("from_us + (to_us - from_us) * length(stream) div 10").alias("covered"), (F.col("stream") == "error").alias("done"))
    return c.walk_progress(rows)


PAIRS = ", now AS (SELECT max(created_at) AS now FROM tx), p AS (SELECT tx_type, item_code, min(created_at) AS oldest FROM tx, now WHERE created_at > now - INTERVAL 7 DAY AND tx_type IN ('AF', 'NO', 'RF') GROUP BY 1, 2)"


@query("tx", PAIRS + " SELECT tx_type, item_code, greatest(oldest - INTERVAL 1 DAY, TIMESTAMP '2001-10-25') AS floor FROM p WHERE item_code NOT LIKE '%3'")
def stream_discovery(spark: SparkSession, d: str) -> DataFrame:
    """Streams of the last week that are not registered, with their floors."""
    rows = t.tx(spark, d)
    now = F.lit(rows.agg(F.max("created_at")).first()[0]).cast("timestamp_ntz")
    recent = rows.where((F.col("created_at") > now - F.expr("INTERVAL 7 DAYS")) & F.col("tx_type").isin("AF", "NO", "RF"))
    found = recent.groupBy("tx_type", "item_code").agg(F.min("created_at").alias("oldest"))
    registered = t.load(spark, d, "part").where("p_brand like '%3'").select(F.col("p_brand").alias("item_code")).distinct()
    floor = F.greatest(F.col("oldest") - F.expr("INTERVAL 1 DAY"), F.lit("2001-10-25 00:00:00").cast("timestamp_ntz"))
    return found.join(registered, "item_code", "left_anti").select("tx_type", "item_code", floor.alias("floor"))


@query("account", "SELECT account_id, checked_at - INTERVAL 1 HOUR AS floor FROM account WHERE last_active_at > checked_at + INTERVAL 24 HOUR ORDER BY checked_at, account_id LIMIT 200")
def stale_entities(spark: SparkSession, d: str) -> DataFrame:
    stale = t.account(spark, d).where(F.col("last_active_at") > F.col("checked_at") + F.expr("INTERVAL 24 HOURS"))
    return stale.orderBy("checked_at", "account_id").limit(200).select("account_id", (F.col("checked_at") - F.expr("INTERVAL 1 HOUR")).alias("floor"))


@query("account", "SELECT account_id, xp FROM account WHERE checked_at IS NULL AND account_id % 6 <> 0 ORDER BY xp DESC NULLS LAST, account_id LIMIT 100")
def candidate_queue(spark: SparkSession, d: str) -> DataFrame:
    rows = t.account(spark, d)
    priority = rows.where("account_id % 6 = 0").select("account_id")
    return rows.where("checked_at is null").join(priority, "account_id", "left_anti").orderBy(F.desc_nulls_last("xp"), "account_id").limit(100).select("account_id", "xp")


@query("account", ", n AS (SELECT max(last_active_at) AS now FROM account) SELECT account_id, last_active_at < now - INTERVAL 96 HOUR AS absent FROM account, n WHERE checked_at IS NOT NULL AND checked_at < now - INTERVAL 48 HOUR ORDER BY absent DESC, xp DESC, account_id LIMIT 150")
def refresh_pool(spark: SparkSession, d: str) -> DataFrame:
    rows = t.account(spark, d)
    now = F.lit(rows.agg(F.max("last_active_at")).first()[0]).cast("timestamp_ntz")
    due = rows.where(F.col("checked_at") < now - F.expr("INTERVAL 48 HOURS")).withColumn("absent", F.col("last_active_at") < now - F.expr("INTERVAL 96 HOURS"))
    return due.orderBy(F.desc("absent"), F.desc("xp"), "account_id").limit(150).select("account_id", "absent")


@query("account", f", c AS (SELECT account_id, {crc32_sql('CAST(account_id AS VARCHAR)')} AS h FROM account, {CRC_TABLE}) SELECT account_id FROM c WHERE h % 5 = 2")
def shard_filter(spark: SparkSession, d: str) -> DataFrame:
    rows = t.account(spark, d)
    return rows.where(shard(F.col("account_id"), 5, 2)).select("account_id")


@query("battle", """, r AS (SELECT battle_id, strftime(created_at, '%Y-%m') AS month, md5(battle_id || ':5') AS h FROM battle),
k AS (SELECT greatest(1, CAST(round_even(120 / count(DISTINCT month), 0) AS BIGINT)) AS k FROM r),
p AS (SELECT *, row_number() OVER (PARTITION BY month ORDER BY h, battle_id) AS place FROM r)
SELECT battle_id, month FROM p, k WHERE place <= k ORDER BY h, battle_id LIMIT 120""")
def stratified_pick(spark: SparkSession, d: str, n: int = 120, seed: int = 5) -> DataFrame:
    """About n battles, the same number from each month (one at least), by a seeded digest; at most n in all."""
    digest = F.md5(F.concat_ws(":", "battle_id", F.lit(seed)).cast("binary"))
    rows = t.battle(spark, d).select("battle_id", F.date_format("created_at", "yyyy-MM").alias("month"), digest.alias("h"))
    months = rows.agg(F.countDistinct("month")).first()[0]
    k = max(1, round(n / max(1, months)))
    return browse.top_per_group(rows, ["month"], [F.asc("h"), F.asc("battle_id")], k).orderBy("h", "battle_id").limit(n).select("battle_id", "month")


REGISTRY = ", r AS (SELECT account_id, max(tx_id) AS newest FROM tx_live GROUP BY 1)"


@query("tx_live", REGISTRY + " SELECT account_id, newest, CASE WHEN account_id % 3 = 0 THEN 'new' WHEN newest - account_id % 2 = newest THEN 'done' ELSE 'behind' END AS state FROM r")
def catchup_state(spark: SparkSession, d: str) -> DataFrame:
    now = t.tx_live(spark, d).groupBy("account_id").agg(F.max("tx_id").alias("newest"))
    registry = now.where("account_id % 3 != 0").select("account_id", (F.col("newest") - F.col("account_id") % 2).alias("top"))
    state = F.when(F.col("top").isNull(), "new").when(F.col("top") == F.col("newest"), "done").otherwise("behind")
    return now.join(registry, "account_id", "left").select("account_id", "newest", state.alias("state"))


@query("tx", ", f AS (SELECT item_code, min(created_at) + to_days(CAST(length(item_code) % 3 * 20 AS INTEGER)) AS floor FROM tx GROUP BY 1) SELECT item_code, floor, count(*) AS misses, TIMESTAMP '1970-01-01' AS new_floor FROM tx JOIN f USING (item_code) WHERE created_at < floor GROUP BY 1, 2")
def floor_violations(spark: SparkSession, d: str) -> DataFrame:
    """Rows under a derived floor disprove it: the floor drops to the epoch."""
    rows = t.tx(spark, d).select("item_code", "created_at")
    floors = rows.groupBy("item_code").agg(F.min("created_at").alias("a")).select("item_code", (F.col("a") + F.make_dt_interval(F.length("item_code") % 3 * 20)).alias("floor"))
    low = rows.join(floors, "item_code").where("created_at < floor").groupBy("item_code", "floor").agg(F.count("*").alias("misses"))
    return low.withColumn("new_floor", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


@query("account", "SELECT account_id, CASE WHEN checked_at IS NULL THEN 'pending' WHEN last_active_at > checked_at + INTERVAL 1 DAY THEN 'stale' ELSE 'done' END AS state, count(*) OVER () AS listed FROM account WHERE account_id % 6 = 0")
def priority_status(spark: SparkSession, d: str) -> DataFrame:
    rows = t.account(spark, d)
    listed = rows.where("account_id % 6 = 0")
    state = F.when(F.col("checked_at").isNull(), "pending").when(F.col("last_active_at") > F.col("checked_at") + F.expr("INTERVAL 1 DAY"), "stale").otherwise("done")
    return listed.select("account_id", state.alias("state"), F.lit(listed.count()).cast("bigint").alias("listed"))


AUDIT = ", s AS (SELECT DISTINCT item_code, tx_id, created_at FROM tx WHERE length(tx_id) % 5 <> 0), h AS (SELECT DISTINCT item_code, tx_id FROM tx WHERE length(tx_id) % 4 <> 0)"


def _sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    rows = t.tx(spark, d).select("item_code", "tx_id", "created_at")
    return rows.where("length(tx_id) % 5 != 0"), rows.where("length(tx_id) % 4 != 0").dropDuplicates(["item_code", "tx_id"])  # the store takes an id once


@query("tx", AUDIT + ", b AS (SELECT item_code, s.tx_id IS NOT NULL AS at_source, h.tx_id IS NOT NULL AS held FROM (SELECT DISTINCT item_code, tx_id FROM s) s FULL JOIN h USING (item_code, tx_id)) SELECT item_code, count(*) FILTER (at_source) AS source_n, count(*) FILTER (held) AS stored_n, count(*) FILTER (NOT held) AS missing, count(*) FILTER (NOT at_source) AS store_only, round(CASE WHEN count(*) FILTER (at_source) = 0 THEN 100.0 ELSE (count(*) FILTER (at_source) - count(*) FILTER (NOT held)) * 100.0 / count(*) FILTER (at_source) END, 4) AS coverage FROM b GROUP BY 1")
def audit_streams(spark: SparkSession, d: str) -> DataFrame:
    return c.audit(*_sides(spark, d), "item_code", "tx_id")


@query("tx", """, s AS (SELECT DISTINCT item_code, tx_id FROM tx), h AS (SELECT DISTINCT item_code, tx_id FROM tx WHERE created_at NOT BETWEEN TIMESTAMP '1996-03-01' AND TIMESTAMP '1996-03-20')
SELECT item_code, count(*) AS source_n, count(h.tx_id) AS stored_n, count(*) - count(h.tx_id) AS missing, CAST(0 AS BIGINT) AS store_only, round(count(h.tx_id) * 100.0 / count(*), 4) AS coverage FROM s LEFT JOIN h USING (item_code, tx_id) GROUP BY 1""")
def audit_gap(spark: SparkSession, d: str) -> DataFrame:
    """A store that lacks three weeks: only the months that differ are compared by id."""
    rows = t.tx(spark, d).select("item_code", "tx_id", "created_at").dropDuplicates(["item_code", "tx_id"])
    at = lambda x: F.lit(x).cast("timestamp_ntz")
    return c.audit(rows, rows.where(~F.col("created_at").between(at("1996-03-01"), at("1996-03-20"))), "item_code", "tx_id", F.date_trunc("month", "created_at"))


@query("tx", AUDIT + " SELECT strftime(created_at, '%Y-%m') AS month, count(*) AS missing FROM s WHERE tx_id NOT IN (SELECT tx_id FROM h) GROUP BY 1")
def audit_missing_months(spark: SparkSession, d: str) -> DataFrame:
    source, store = _sides(spark, d)
    gone = source.distinct().join(store.select("tx_id"), "tx_id", "left_anti")
    return gone.groupBy(F.date_format("created_at", "yyyy-MM").alias("month")).agg(F.count("*").alias("missing"))


