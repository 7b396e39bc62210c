"""Aggregations and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerforge import fixtures as t
from ledgerforge.functions import micros_between, trunc
from ledgerforge.operators import browse, coverage
from ledgerforge.plans.registry import query
from ledgerforge.plans.views import last_round


@query("tx", "SELECT coalesce(tx_type, 'all') AS tx_type, count(*) AS n FROM tx GROUP BY GROUPING SETS ((tx_type), ())")
def tx_type_histogram(spark: SparkSession, d: str) -> DataFrame:
    by = t.load(spark, d, "lineitem").select(F.concat("l_returnflag", "l_linestatus").alias("tx_type"), "l_orderkey", "l_partkey")
    by = by.join(t.load(spark, d, "orders").select("o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
    by = by.join(t.load(spark, d, "part").select("p_partkey"), F.col("l_partkey") == F.col("p_partkey"), "left_semi")
    return by.rollup("tx_type").agg(F.count("*").alias("n"), F.grouping("tx_type").alias("g")).select(F.when(F.col("g") == 1, "all").otherwise(F.col("tx_type")).alias("tx_type"), "n")


def _since(days: int) -> str:
    return f"created_at > (SELECT max(ts) FROM events) - INTERVAL {days} DAY"


def newest(spark: SparkSession, d: str):
    """The latest event time: a literal, so that filters on it prune."""
    return F.lit(t.load(spark, d, "events").agg(F.max("ts")).first()[0]).cast("timestamp_ntz")


@query("tx_live", f"SELECT CAST(created_at AS DATE) AS day, count(*) AS n FROM tx_live WHERE {_since(14)} GROUP BY 1")
def tx_day_counts(spark: SparkSession, d: str) -> DataFrame:
    return t.tx_live(spark, d).where(F.col("created_at") > newest(spark, d) - F.expr("INTERVAL 14 DAYS")).groupBy(F.to_date("created_at").alias("day")).agg(F.count("*").alias("n"))


@query("tx_live", f"SELECT date_trunc('hour', created_at) AS hour, count(*) AS n, min(created_at) AS first_at, max(created_at) AS last_at FROM tx_live WHERE {_since(15)} GROUP BY 1")
def tx_hour_stats(spark: SparkSession, d: str) -> DataFrame:
    rows = t.tx_live(spark, d).where(F.col("created_at") > newest(spark, d) - F.expr("INTERVAL 15 DAYS"))
    return rows.groupBy(trunc("hour", F.col("created_at")).alias("hour")).agg(F.count("*").alias("n"), F.min("created_at").alias("first_at"), F.max("created_at").alias("last_at"))


@query(
    "tx_live",
    """, a AS (SELECT max(created_at) AS now, max(created_at) - INTERVAL 72 HOUR AS edge FROM tx_live),
kinds AS (SELECT * FROM (VALUES ('hour', 72), ('day', 14)) v(unit, cells)),
grid AS (SELECT unit, CASE unit WHEN 'hour' THEN date_trunc('hour', now) - to_hours(CAST(i AS INTEGER)) ELSE date_trunc('day', now) - to_days(CAST(i AS INTEGER)) END AS cell, edge FROM kinds, a, range(0, 72) r(i) WHERE i < cells),
counts AS (SELECT 'hour' AS unit, date_trunc('hour', created_at) AS cell, count(*) AS n FROM tx_live GROUP BY 1, 2 UNION ALL SELECT 'day', date_trunc('day', created_at), count(*) FROM tx_live GROUP BY 1, 2),
filled AS (SELECT unit, cell, edge, coalesce(n, 0) AS n FROM grid LEFT JOIN counts USING (unit, cell)),
medians AS (SELECT unit, list_sort(list(n))[CAST(floor(count(*) / 2) AS BIGINT) + 1] AS median FROM filled WHERE n > 0 AND (unit = 'day' OR cell >= edge) GROUP BY 1)
SELECT unit, CAST(cell AS TIMESTAMP) AS cell, n, CASE WHEN cell < edge AND unit = 'hour' THEN 'outside' WHEN n = 0 THEN 'err' WHEN n < 0.2 * median THEN 'warn' ELSE 'ok' END AS state FROM filled LEFT JOIN medians USING (unit)""",
)
def tx_coverage_grid(spark: SparkSession, d: str) -> DataFrame:
    now = t.load(spark, d, "events").agg(F.max("ts")).first()[0]
    return coverage.grid(t.tx_live(spark, d), now)


@query("tx_live", "SELECT CAST(max(created_at) AS TIMESTAMP) AS newest_at, CAST(epoch_us(TIMESTAMP '2024-01-30 23:59:30') - epoch_us(max(created_at)) AS BIGINT) AS lag_us, epoch_us(TIMESTAMP '2024-01-30 23:59:30') - epoch_us(max(created_at)) < 90000000 AS is_fresh, CAST(floor((epoch_us(max(created_at)) - epoch_us(min(created_at))) / 3600000000) AS BIGINT) AS depth_hours FROM tx_live")
def tx_freshness(spark: SparkSession, d: str) -> DataFrame:
    as_of = F.lit("2024-01-30 23:59:30").cast("timestamp_ntz")
    ends = t.tx_live(spark, d).agg(F.max("created_at").alias("newest_at"), F.min("created_at").alias("oldest_at"))
    lag = micros_between(F.col("newest_at"), as_of)
    return ends.select("newest_at", lag.alias("lag_us"), (lag < 90_000_000).alias("is_fresh"), F.floor(micros_between(F.col("oldest_at"), F.col("newest_at")) / 3_600_000_000).alias("depth_hours"))


@query("tx", "SELECT tx_type, count(*) AS n, min(created_at) AS first_at, max(created_at) AS last_at, round(sum(money), 2) AS money FROM tx GROUP BY 1")
def tx_type_coverage(spark: SparkSession, d: str) -> DataFrame:
    return t.tx(spark, d).groupBy("tx_type").agg(F.count("*").alias("n"), F.min("created_at").alias("first_at"), F.max("created_at").alias("last_at"), F.round(F.sum("money"), 2).alias("money"))


TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@query("", " UNION ALL ".join(f"SELECT '{x}' AS table_name, count(*) AS n FROM {x}" for x in TABLES))
def table_counts(spark: SparkSession, d: str) -> DataFrame:
    parts = [t.load(spark, d, x).agg(F.count("*").alias("n")).select(F.lit(x).alias("table_name"), "n") for x in TABLES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("battle", "SELECT count(*) FILTER (ended_at IS NULL) AS active, count(*) FILTER (ended_at IS NOT NULL) AS finished FROM battle")
def battle_status_counts(spark: SparkSession, d: str) -> DataFrame:
    return t.battle(spark, d).agg(F.count_if(F.col("ended_at").isNull()).alias("active"), F.count_if(F.col("ended_at").isNotNull()).alias("finished"))


@query(
    "account tx",
    "SELECT (SELECT count(*) FROM account WHERE checked_at IS NOT NULL) AS checked_users, (SELECT count(*) FROM account WHERE checked_at IS NULL) AS queued_users, count(*) FILTER (created_at < (SELECT max(created_at) FROM tx) - INTERVAL 72 HOUR) AS history_rows, min(created_at) AS oldest_at FROM tx",
)
def progress_card(spark: SparkSession, d: str) -> DataFrame:
    rows = t.tx(spark, d)
    newest_at = F.lit(rows.agg(F.max("created_at")).first()[0]).cast("timestamp_ntz")
    users = t.account(spark, d).agg(F.count_if(F.col("checked_at").isNotNull()).alias("checked_users"), F.count_if(F.col("checked_at").isNull()).alias("queued_users"), F.lit(1).alias("one"))
    facts = rows.agg(F.count_if(F.col("created_at") < newest_at - F.expr("INTERVAL 72 HOURS")).alias("history_rows"), F.min("created_at").alias("oldest_at"), F.lit(1).alias("one"))
    return users.join(facts, "one").drop("one")  # two single rows


STATS = ", stats AS (SELECT entity_id AS user_id, battle_id, side, CAST(sum(damage) AS BIGINT) AS damage, CAST(sum(points) AS BIGINT) AS points, round(sum(money), 2) AS money, count(*) AS entries FROM rank_entry WHERE entity_type = 1 AND side IN (1, 2) GROUP BY 1, 2, 3)"


def battle_stats(entries: DataFrame) -> DataFrame:
    """Sums of each user, battle and side."""
    rows = entries.where("entity_type = 1 and side in (1, 2)")
    return rows.groupBy(F.col("entity_id").alias("user_id"), "battle_id", "side").agg(F.sum("damage").alias("damage"), F.sum("points").alias("points"), F.round(F.sum("money"), 2).alias("money"), F.count("*").alias("entries"))


@query("rank_entry", STATS + " SELECT * FROM stats")
def user_battle_stats(spark: SparkSession, d: str) -> DataFrame:
    return battle_stats(t.rank_entry(spark, d))


HISTORY = STATS + """, h AS (SELECT user_id, battle_id, CAST(sum(damage) AS BIGINT) AS damage, CAST(sum(points) AS BIGINT) AS points, CAST(arg_max(side, damage * 10 - side) AS INTEGER) AS main_side FROM stats GROUP BY 1, 2)
"""


def history(spark: SparkSession, d: str) -> DataFrame:
    main = F.max_by("side", F.struct(F.coalesce("damage", F.lit(-1)), -F.col("side")))
    return battle_stats(t.rank_entry(spark, d)).groupBy("user_id", "battle_id").agg(F.sum("damage").alias("damage"), F.sum("points").alias("points"), main.alias("main_side"))


@query("rank_entry battle rounds", HISTORY + "SELECT h.*, b.created_at, r.attacker_damages AS last_attacker, r.defender_damages AS last_defender FROM h JOIN battle b USING (battle_id) LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY battle_id ORDER BY number DESC) AS k FROM rounds) r ON r.battle_id = h.battle_id AND k = 1")
def user_history(spark: SparkSession, d: str) -> DataFrame:
    last = last_round(t.rounds(spark, d)).select("battle_id", F.col("attacker_damages").alias("last_attacker"), F.col("defender_damages").alias("last_defender"))
    return history(spark, d).join(t.battle(spark, d).select("battle_id", "created_at"), "battle_id").join(last, "battle_id", "left")


@query("rank_entry account", HISTORY + "SELECT account_id, name, xp, country_id, count(battle_id) AS battles, CAST(coalesce(sum(damage), 0) AS BIGINT) AS damage FROM account LEFT JOIN h ON user_id = account_id GROUP BY 1, 2, 3, 4")
def account_profile(spark: SparkSession, d: str) -> DataFrame:
    totals = history(spark, d).groupBy(F.col("user_id").alias("account_id")).agg(F.count("*").alias("battles"), F.sum("damage").alias("damage"))
    out = t.account(spark, d).select("account_id", "name", "xp", "country_id").join(totals, "account_id", "left")
    return out.withColumn("battles", F.coalesce("battles", F.lit(0))).withColumn("damage", F.coalesce("damage", F.lit(0)))


A, B = "1996-01-01", "1997-01-01"
TRACK = f""", l AS (SELECT *, row_number() OVER (PARTITION BY battle_id, side, entity_id ORDER BY created_at DESC, damage DESC, points DESC, money DESC) AS k FROM rank_entry),
track AS (SELECT l.battle_id, side, entity_id, damage, points, l.created_at, b.ended_at, attacker_country_id, defender_country_id FROM l JOIN battle b USING (battle_id) WHERE k = 1 AND side IN (1, 2) AND ended_at >= TIMESTAMP '{A}' AND ended_at <= TIMESTAMP '{B}')
"""


def track(spark: SparkSession, d: str) -> DataFrame:
    rows = t.rank_entry(spark, d).where("side in (1, 2)").select("battle_id", "side", "entity_id", "created_at", "damage", "points", "money")
    rows = browse.latest(rows, ["battle_id", "side", "entity_id"], ["created_at", "damage", "points", "money"])
    ended = t.battle(spark, d).where(F.col("ended_at").between(F.lit(A).cast("timestamp_ntz"), F.lit(B).cast("timestamp_ntz"))).drop("created_at")
    return rows.join(ended, "battle_id")


@query("rank_entry battle", TRACK + "SELECT entity_id, count(DISTINCT battle_id) AS battles, CAST(sum(damage) AS BIGINT) AS damage, CAST(sum(points) AS BIGINT) AS points, max(damage) AS best FROM track GROUP BY 1")
def tracker_summary(spark: SparkSession, d: str) -> DataFrame:
    return track(spark, d).groupBy("entity_id").agg(F.countDistinct("battle_id").alias("battles"), F.sum("damage").alias("damage"), F.sum("points").alias("points"), F.max("damage").alias("best"))


@query(
    "rank_entry battle country",
    TRACK
    + """, r AS (SELECT entity_id, 'for' AS relation, CASE side WHEN 1 THEN attacker_country_id ELSE defender_country_id END AS country_id, damage FROM track
  UNION ALL SELECT entity_id, 'against', CASE side WHEN 1 THEN defender_country_id ELSE attacker_country_id END, damage FROM track)
SELECT entity_id, relation, coalesce(name, '—') AS name, count(*) AS sides, CAST(sum(damage) AS BIGINT) AS damage FROM r LEFT JOIN country USING (country_id) GROUP BY 1, 2, 3""",
)
def tracker_for_against(spark: SparkSession, d: str) -> DataFrame:
    """One pass: each row counts for its own side's country and against the other's."""
    own = F.when(F.col("side") == 1, F.col("attacker_country_id")).otherwise(F.col("defender_country_id"))
    other = F.when(F.col("side") == 1, F.col("defender_country_id")).otherwise(F.col("attacker_country_id"))
    both = F.array(F.struct(F.lit("for").alias("relation"), own.alias("country_id")), F.struct(F.lit("against").alias("relation"), other.alias("country_id")))
    rows = track(spark, d).select("entity_id", "damage", F.explode(both).alias("r")).select("entity_id", "damage", "r.*")
    named = rows.join(F.broadcast(t.country(spark, d).select("country_id", "name")), "country_id", "left")
    return named.groupBy("entity_id", "relation", F.coalesce("name", F.lit("—")).alias("name")).agg(F.count("*").alias("sides"), F.sum("damage").alias("damage"))


@query("rank_entry battle", TRACK + "SELECT battle_id, side, CAST(sum(damage) AS BIGINT) AS damage, epoch_us(min(ended_at)) - epoch_us(max(created_at)) > 300000000 AS is_stale FROM track GROUP BY 1, 2, ended_at ORDER BY ended_at DESC, battle_id DESC, side LIMIT 500")
def tracker_battles(spark: SparkSession, d: str) -> DataFrame:
    rows = track(spark, d).groupBy("battle_id", "side", "ended_at").agg(F.sum("damage").alias("damage"), F.max("created_at").alias("newest_at"))
    top = rows.orderBy(F.desc("ended_at"), F.desc("battle_id"), "side").limit(500)
    return top.select("battle_id", "side", "damage", (micros_between(F.col("newest_at"), F.col("ended_at")) > 300_000_000).alias("is_stale"))


@query(
    "rank_entry battle",
    """, c AS (SELECT battle_id, round_number, side, count(*) AS n FROM rank_entry GROUP BY 1, 2, 3),
p AS (SELECT battle_id, CAST(sum(ceil(n / 100.0)) AS BIGINT) AS pages FROM c GROUP BY 1)
SELECT strftime(created_at, '%Y-%m') AS month, count(*) AS battles, count(pages) AS sampled, CAST(coalesce(sum(pages), 0) AS BIGINT) AS pages,
  round(coalesce(sum(pages), 0) * count(*) / nullif(count(pages), 0), 4) AS estimate FROM battle LEFT JOIN p USING (battle_id) GROUP BY 1""",
)
def page_estimate(spark: SparkSession, d: str) -> DataFrame:
    pages = t.rank_entry(spark, d).groupBy("battle_id", "round_number", "side").agg(F.count("*").alias("n")).groupBy("battle_id").agg(F.sum(F.ceil(F.col("n") / 100)).alias("pages"))
    rows = t.battle(spark, d).select("battle_id", F.date_format("created_at", "yyyy-MM").alias("month")).join(pages, "battle_id", "left")
    out = rows.groupBy("month").agg(F.count("*").alias("battles"), F.count("pages").alias("sampled"), F.coalesce(F.sum("pages"), F.lit(0)).alias("pages"))
    return out.withColumn("estimate", F.round(F.try_divide(F.col("pages") * F.col("battles"), F.col("sampled")), 4))


@query("tx", "SELECT item_code, count(*) AS n FROM tx WHERE tx_type = 'NO' GROUP BY 1 ORDER BY n, item_code")
def stream_sizes(spark: SparkSession, d: str) -> DataFrame:
    return t.tx(spark, d).where("tx_type = 'NO'").groupBy("item_code").agg(F.count("*").alias("n")).orderBy("n", "item_code")


@query("tx", ", c AS (SELECT seller_id, created_at, count(*) AS size FROM tx GROUP BY 1, 2), h AS (SELECT size, count(*) AS clusters FROM c GROUP BY 1) SELECT h.size, h.clusters, round(h.clusters / ((coalesce(a.clusters, 0) + coalesce(b.clusters, 0)) / 2.0 + 1), 4) AS spike FROM h LEFT JOIN h a ON a.size = h.size - 1 LEFT JOIN h b ON b.size = h.size + 1")
def tie_cluster_hist(spark: SparkSession, d: str) -> DataFrame:
    """Sizes of (seller, instant) clusters; a spike at a page limit tells of truncated reading."""
    sizes = t.tx(spark, d).groupBy("seller_id", "created_at").agg(F.count("*").alias("size")).groupBy("size").agg(F.count("*").alias("clusters"))
    near = sizes.select(F.explode(F.array(F.col("size") - 1, F.col("size") + 1)).alias("size"), F.col("clusters").alias("c")).groupBy("size").agg(F.sum("c").alias("near"))
    return sizes.join(near, "size", "left").select("size", "clusters", F.round(F.col("clusters") / (F.coalesce("near", F.lit(0)) / 2 + 1), 4).alias("spike"))


@query(
    "battle rounds",
    """, s AS (SELECT battle_id, CAST(sum(attacker_damages) AS BIGINT) AS a, CAST(sum(defender_damages) AS BIGINT) AS d FROM rounds GROUP BY 1),
b AS (SELECT battle_id, ended_at IS NULL AS active, CAST(battle_id % 4 AS BIGINT) * 5 AS old_a, CAST(0 AS BIGINT) AS old_d FROM battle)
SELECT battle_id, CASE WHEN active OR (old_a = 0 AND old_d = 0 AND a + d > 0) THEN coalesce(a, old_a) ELSE old_a END AS attacker_damages,
  CASE WHEN active OR (old_a = 0 AND old_d = 0 AND a + d > 0) THEN coalesce(d, old_d) ELSE old_d END AS defender_damages FROM b LEFT JOIN s USING (battle_id)""",
)
def repair_zero_totals(spark: SparkSession, d: str) -> DataFrame:
    stored = t.battle(spark, d).select("battle_id", F.col("ended_at").isNull().alias("active"), ((F.col("battle_id") % 4) * 5).alias("old_a"), F.lit(0).cast("bigint").alias("old_d"))
    return repaired(stored, t.rounds(spark, d))


def repaired(stored: DataFrame, rounds: DataFrame) -> DataFrame:
    """Totals of the children replace those of active parents, and of ended parents whose totals are zero."""
    sums = rounds.groupBy("battle_id").agg(F.sum("attacker_damages").alias("a"), F.sum("defender_damages").alias("d"))
    due = F.col("active") | ((F.col("old_a") == 0) & (F.col("old_d") == 0) & (F.col("a") + F.col("d") > 0))
    pick = lambda new, old: F.when(due, F.coalesce(new, old)).otherwise(F.col(old))
    return stored.join(sums, "battle_id", "left").select("battle_id", pick("a", "old_a").alias("attacker_damages"), pick("d", "old_d").alias("defender_damages"))


AGE = ", a AS (SELECT *, epoch_us(created_at) - epoch_us(offer_created_at) AS age FROM tx)"


@query("tx", AGE + " SELECT item_code, count(*) AS buys, count(*) FILTER (age IS NULL) AS no_offer, count(*) FILTER (age < 86400000000) AS under_day, count(*) FILTER (age < 864000000000) AS under_ten_days, CAST(floor(quantile_cont(age, 0.5)) AS BIGINT) AS median_us, max(age) AS slowest_us, min(created_at) AS first_at, max(created_at) AS last_at FROM a GROUP BY 1")
def listing_age_summary(spark: SparkSession, d: str) -> DataFrame:
    """Ages are counted first, so that a code's median comes from running sums of pieces, not from all its ages at once."""
    rows = t.tx(spark, d).withColumn("age", micros_between(F.col("offer_created_at"), F.col("created_at")))
    under = lambda n: F.coalesce(F.sum(F.when(F.col("age") < n, F.col("n"))), F.lit(0))
    ages = rows.groupBy("item_code", "age").agg(F.count("*").alias("n"), F.min("created_at").alias("first_at"), F.max("created_at").alias("last_at"))
    ages = browse.summed_before(ages.withColumn("known", F.when(F.col("age").isNotNull(), F.col("n")).otherwise(0)), "item_code", "age", "known")
    total = ages.groupBy(F.col("item_code").alias("code")).agg(
        F.sum("n").alias("buys"), F.sum(F.col("n") - F.col("known")).alias("no_offer"), F.sum("known").alias("known"), under(86_400_000_000).alias("under_day"),
        under(864_000_000_000).alias("under_ten_days"), F.max("age").alias("slowest_us"), F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at"),
    )
    # The two middle ages, or one twice.
    holds = lambda r: (F.col("a.before") <= r) & (F.col("a.before") + F.col("a.known") > r)
    middle = [F.floor((F.col("t.known") - 1) / 2), F.floor(F.col("t.known") / 2)]
    found = ages.alias("a").join(total.alias("t"), F.col("a.item_code").eqNullSafe(F.col("t.code")))
    at = [F.max(F.when(holds(r), F.col("a.age"))) for r in middle]
    median = found.groupBy("a.item_code").agg(F.floor((at[0] + at[1]) / 2).alias("median_us"))
    out = total.join(median, F.col("code").eqNullSafe(F.col("item_code")))
    return out.select("item_code", "buys", "no_offer", "under_day", "under_ten_days", "median_us", "slowest_us", "first_at", "last_at")


@query("tx", AGE + " SELECT tx_id, age AS age_us, s_name AS seller_name FROM (SELECT * FROM a WHERE age IS NOT NULL ORDER BY age, tx_id LIMIT 50) LEFT JOIN supplier ON s_suppkey = seller_id")
def listing_age_rank(spark: SparkSession, d: str) -> DataFrame:
    rows = t.tx(spark, d).withColumn("age_us", micros_between(F.col("offer_created_at"), F.col("created_at"))).where("age_us is not null")
    top = F.broadcast(rows.orderBy("age_us", "tx_id").limit(50))
    s = t.load(spark, d, "supplier")
    return s.join(top, s["s_suppkey"] == top["seller_id"], "right").select("tx_id", "age_us", F.col("s_name").alias("seller_name"))


@query(
    "rounds rank_entry account",
    """, now AS (SELECT max(created_at) AS now FROM rounds),
a AS (SELECT entity_id, max(r.created_at) AS seen FROM rank_entry e JOIN rounds r ON r.battle_id = e.battle_id AND r.number = e.round_number, now WHERE r.created_at > now - INTERVAL 500 DAY GROUP BY 1)
SELECT coalesce(account_id, entity_id) AS account_id, greatest(last_active_at, seen) AS last_active_at FROM account FULL JOIN a ON entity_id = account_id""",
)
def last_active_refresh(spark: SparkSession, d: str) -> DataFrame:
    r = t.rounds(spark, d).select("battle_id", F.col("number").alias("round_number"), F.col("created_at").alias("seen"))
    now = F.lit(r.agg(F.max("seen")).first()[0]).cast("timestamp_ntz")
    seen = t.rank_entry(spark, d).join(r.where(F.col("seen") > now - F.expr("INTERVAL 500 DAYS")), ["battle_id", "round_number"]).groupBy(F.col("entity_id").alias("account_id")).agg(F.max("seen").alias("seen"))
    return t.account(spark, d).select("account_id", "last_active_at").join(seen, "account_id", "full").select("account_id", F.greatest("last_active_at", "seen").alias("last_active_at"))


ROUTES = ", r AS (SELECT endpoint AS route, date_used, request_id % 97 AS visitor, request_id % 211 AS latency, request_id % 13 = 0 AS failed FROM usage_log WHERE endpoint <> 'error')"


@query("usage_log", ROUTES + ", n AS (SELECT max(date_used) AS now FROM usage_log) SELECT route, count(*) AS hits, round(avg(latency), 4) AS avg_latency, max(latency) AS max_latency, count(*) FILTER (failed) AS errors, count(DISTINCT visitor) AS visitors, count(DISTINCT visitor) FILTER (date_used > now - INTERVAL 24 HOUR) AS visitors_24h FROM r, n GROUP BY 1")
def route_stats(spark: SparkSession, d: str) -> DataFrame:
    log = t.usage_log(spark, d)
    now = F.lit(log.agg(F.max("date_used")).first()[0]).cast("timestamp_ntz")
    r = log.where("endpoint != 'error'").select(F.col("endpoint").alias("route"), "date_used", (F.col("request_id") % 97).alias("visitor"), (F.col("request_id") % 211).alias("latency"), (F.col("request_id") % 13 == 0).alias("failed"))
    recent = F.when(F.col("date_used") > now - F.expr("INTERVAL 24 HOURS"), F.col("visitor"))
    return r.groupBy("route").agg(F.count("*").alias("hits"), F.round(F.avg("latency"), 4).alias("avg_latency"), F.max("latency").alias("max_latency"), F.count_if("failed").alias("errors"), F.countDistinct("visitor").alias("visitors"), F.countDistinct(recent).alias("visitors_24h"))


