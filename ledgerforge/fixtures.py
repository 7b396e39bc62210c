"""Logical tables of the warehouse over the given parquet tables, in Spark and in SQL.

Each function gives a DataFrame; ``SQL`` has the same definitions for the oracle, put together by ``with_tables``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerforge.functions import NTZ, trunc, week
from ledgerforge.session import pin


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return pin(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def tx(spark: SparkSession, d: str) -> DataFrame:
    lines, orders, part = (load(spark, d, t) for t in ("lineitem", "orders", "part"))
    rows = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).join(part, lines["l_partkey"] == part["p_partkey"])
    return rows.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("tx_id"),
        F.col("l_shipdate").alias("created_at"),
        F.when(F.col("o_orderdate") <= F.col("l_shipdate"), F.col("o_orderdate")).alias("offer_created_at"),
        F.col("o_custkey").alias("buyer_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.concat("l_returnflag", "l_linestatus").alias("tx_type"),
        F.col("p_brand").alias("item_code"),
        F.col("l_extendedprice").alias("money"),
        F.col("l_quantity").alias("quantity"),
    )


def tx_live(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "events").select(F.col("event_id").alias("tx_id"), F.col("ts").alias("created_at"), F.col("user_id").alias("account_id"), F.col("event_type").alias("tx_type"), F.col("value").alias("money"))


def battle(spark: SparkSession, d: str) -> DataFrame:
    orders, customer = load(spark, d, "orders"), load(spark, d, "customer")
    return orders.join(customer, orders["o_custkey"] == customer["c_custkey"]).select(
        F.col("o_orderkey").alias("battle_id"),
        F.col("o_orderdate").alias("created_at"),
        F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate") + F.expr("INTERVAL 2 DAYS")).alias("ended_at"),
        F.col("o_orderpriority").alias("battle_type"),
        F.col("c_nationkey").alias("attacker_country_id"),
        (F.col("o_orderkey") % 25).cast("int").alias("defender_country_id"),
    )


def bounty(spark: SparkSession, d: str) -> DataFrame:
    orders = load(spark, d, "orders")
    sides = F.array(
        F.struct(F.lit(1).alias("side"), F.when(F.col("o_orderkey") % 3 == 0, F.col("o_totalprice") - 250000).alias("money_pool")),
        F.struct(F.lit(2).alias("side"), F.when(F.col("o_orderkey") % 5 == 0, F.col("o_totalprice")).alias("money_pool")),
    )
    return orders.select(F.col("o_orderkey").alias("battle_id"), F.explode(sides).alias("s")).select("battle_id", "s.side", "s.money_pool").where("money_pool is not null")


def rounds(spark: SparkSession, d: str) -> DataFrame:
    q = lambda flag: F.coalesce(F.sum(F.when(F.col("l_returnflag") == flag, F.col("l_quantity").cast("bigint"))), F.lit(0))
    return (
        load(spark, d, "lineitem")
        .groupBy(F.col("l_orderkey").alias("battle_id"), F.col("l_linenumber").alias("number"))
        .agg(q("A").alias("attacker_damages"), q("N").alias("defender_damages"), F.min("l_shipdate").alias("created_at"), (F.max("l_shipdate") + F.expr("INTERVAL 1 DAY")).alias("ended_at"))
    )


def rank_entry(spark: SparkSession, d: str) -> DataFrame:
    side = F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2).otherwise(3)
    return load(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("battle_id"),
        F.col("l_linenumber").alias("round_number"),
        F.col("l_suppkey").alias("entity_id"),
        side.alias("side"),
        F.lit(1).alias("entity_type"),
        F.col("l_quantity").cast("bigint").alias("damage"),
        F.round(F.col("l_tax") * 100).cast("int").alias("points"),
        F.col("l_extendedprice").alias("money"),
        F.col("l_shipdate").alias("created_at"),
    )


def country(spark: SparkSession, d: str) -> DataFrame:
    n, r = load(spark, d, "nation"), load(spark, d, "region")
    return n.join(F.broadcast(r), n["n_regionkey"] == r["r_regionkey"]).select(F.col("n_nationkey").alias("country_id"), F.col("n_name").alias("name"), F.col("r_name").alias("region"))


def account(spark: SparkSession, d: str) -> DataFrame:
    orders = load(spark, d, "orders").groupBy("o_custkey").agg(F.max("o_orderdate").alias("last_active_at"), F.min("o_orderdate").alias("first_at"))
    c = load(spark, d, "customer")
    return c.join(orders, c["c_custkey"] == orders["o_custkey"], "left").select(
        F.col("c_custkey").alias("account_id"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("xp"),
        F.col("c_nationkey").alias("country_id"),
        "last_active_at",
        F.when(F.col("c_custkey") % 3 != 0, F.col("first_at") + F.expr("INTERVAL 400 DAYS")).alias("checked_at"),
    )


def usage_log(spark: SparkSession, d: str) -> DataFrame:
    request = F.when(F.col("event_type") == "error", F.lit(0)).otherwise(F.floor(F.col("event_id") / 5) + 1).cast("bigint")
    return load(spark, d, "events").select(F.col("event_type").alias("endpoint"), F.col("ts").alias("date_used"), request.alias("request_id"))


def week_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """One row for each week, day and user: the week's running sum, and the rank of the sums on that day."""
    by_day = load(spark, d, "events").groupBy(week(F.col("ts")).alias("week_start"), trunc("day", F.col("ts")).alias("snapshot_at"), F.col("user_id").alias("entity_id")).agg(F.sum(F.floor("value").cast("bigint")).alias("v"))
    running = Window.partitionBy("week_start", "entity_id").orderBy("snapshot_at").rowsBetween(Window.unboundedPreceding, 0)
    value = by_day.select("week_start", "snapshot_at", "entity_id", F.sum("v").over(running).alias("value"))
    place = Window.partitionBy("week_start", "snapshot_at").orderBy(F.desc("value"), "entity_id")
    return value.withColumn("rank", F.row_number().over(place).cast("bigint"))


SQL: dict[str, str] = {
    "tx": """SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS tx_id, l_shipdate AS created_at,
  CASE WHEN o_orderdate <= l_shipdate THEN o_orderdate END AS offer_created_at, o_custkey AS buyer_id, l_suppkey AS seller_id,
  concat(l_returnflag, l_linestatus) AS tx_type, p_brand AS item_code, l_extendedprice AS money, l_quantity AS quantity
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "tx_live": "SELECT event_id AS tx_id, ts AS created_at, user_id AS account_id, event_type AS tx_type, value AS money FROM events",
    "battle": """SELECT o_orderkey AS battle_id, o_orderdate AS created_at, CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + INTERVAL 2 DAY END AS ended_at,
  o_orderpriority AS battle_type, c_nationkey AS attacker_country_id, CAST(o_orderkey % 25 AS INTEGER) AS defender_country_id
  FROM orders JOIN customer ON o_custkey = c_custkey""",
    "bounty": """SELECT o_orderkey AS battle_id, 1 AS side, o_totalprice - 250000 AS money_pool FROM orders WHERE o_orderkey % 3 = 0
  UNION ALL SELECT o_orderkey, 2, o_totalprice FROM orders WHERE o_orderkey % 5 = 0""",
    "rounds": """SELECT l_orderkey AS battle_id, l_linenumber AS number,
  CAST(coalesce(sum(CAST(floor(l_quantity) AS BIGINT)) FILTER (l_returnflag = 'A'), 0) AS BIGINT) AS attacker_damages,
  CAST(coalesce(sum(CAST(floor(l_quantity) AS BIGINT)) FILTER (l_returnflag = 'N'), 0) AS BIGINT) AS defender_damages,
  min(l_shipdate) AS created_at, max(l_shipdate) + INTERVAL 1 DAY AS ended_at FROM lineitem GROUP BY 1, 2""",
    "rank_entry": """SELECT l_orderkey AS battle_id, l_linenumber AS round_number, l_suppkey AS entity_id,
  CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS side, 1 AS entity_type, CAST(floor(l_quantity) AS BIGINT) AS damage,
  CAST(round(l_tax * 100) AS INTEGER) AS points, l_extendedprice AS money, l_shipdate AS created_at FROM lineitem""",
    "country": "SELECT n_nationkey AS country_id, n_name AS name, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey",
    "account": """SELECT c_custkey AS account_id, c_name AS name, c_acctbal AS xp, c_nationkey AS country_id, last_active_at,
  CASE WHEN c_custkey % 3 <> 0 THEN first_at + INTERVAL 400 DAY END AS checked_at
  FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS last_active_at, min(o_orderdate) AS first_at FROM orders GROUP BY 1) ON c_custkey = o_custkey""",
    "usage_log": """SELECT event_type AS endpoint, ts AS date_used,
  CASE WHEN event_type = 'error' THEN 0 ELSE CAST(floor(event_id / 5) AS BIGINT) + 1 END AS request_id FROM events""",
    "week_snapshot": """SELECT *, row_number() OVER (PARTITION BY week_start, snapshot_at ORDER BY value DESC, entity_id) AS rank FROM (
  SELECT week_start, snapshot_at, entity_id, CAST(sum(v) OVER (PARTITION BY week_start, entity_id ORDER BY snapshot_at) AS BIGINT) AS value FROM (
  SELECT CAST(date_trunc('week', ts) AS TIMESTAMP) AS week_start, CAST(date_trunc('day', ts) AS TIMESTAMP) AS snapshot_at, user_id AS entity_id,
  sum(CAST(floor(value) AS BIGINT)) AS v FROM events GROUP BY 1, 2, 3))""",
}


def with_tables(names: str, query: str) -> str:
    """The query behind the definitions of the named tables; it may begin with more definitions (``, x AS (...)``)."""
    return "WITH " + ",\n".join(f"{n} AS ({SQL[n]})" for n in names.split()) + "\n" + query
