"""Resolved views and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerforge import fixtures as t
from ledgerforge.operators.browse import latest
from ledgerforge.plans.registry import query


def battle_details(battle: DataFrame, country: DataFrame, bounty: DataFrame) -> DataFrame:
    """Both countries and both pools of each battle, and the state that follows from its end."""
    role = lambda r: F.broadcast(country.select(F.col("country_id").alias(f"{r}_country_id"), F.col("name").alias(f"{r}_name")))
    pools = bounty.groupBy("battle_id").agg(F.max(F.when(F.col("side") == 1, F.col("money_pool"))).alias("attacker_pool"), F.max(F.when(F.col("side") == 2, F.col("money_pool"))).alias("defender_pool"))
    out = battle.join(role("attacker"), "attacker_country_id", "left").join(role("defender"), "defender_country_id", "left").join(pools, "battle_id", "left")
    return out.withColumn("is_active", F.col("ended_at").isNull())


def last_round(rounds: DataFrame) -> DataFrame:
    return latest(rounds, ["battle_id"], ["number"])


DETAILS = """, details AS (
  SELECT b.*, a.name AS attacker_name, d.name AS defender_name, p.money_pool AS attacker_pool, q.money_pool AS defender_pool, ended_at IS NULL AS is_active
  FROM battle b LEFT JOIN country a ON a.country_id = attacker_country_id LEFT JOIN country d ON d.country_id = defender_country_id
  LEFT JOIN bounty p ON p.battle_id = b.battle_id AND p.side = 1 LEFT JOIN bounty q ON q.battle_id = b.battle_id AND q.side = 2)
"""


@query("tx", "SELECT t.*, CAST(floor(date_diff('day', offer_created_at, created_at)) AS BIGINT) AS offer_days, s_name AS seller_name, c_name AS buyer_name FROM tx t LEFT JOIN supplier ON s_suppkey = seller_id LEFT JOIN customer ON c_custkey = buyer_id")
def v_transaction_details(spark: SparkSession, d: str) -> DataFrame:
    s = t.load(spark, d, "supplier").select(F.col("s_suppkey").alias("seller_id"), F.col("s_name").alias("seller_name"))
    c = t.load(spark, d, "customer").select(F.col("c_custkey").alias("buyer_id"), F.col("c_name").alias("buyer_name"))
    rows = t.tx(spark, d).withColumn("offer_days", F.datediff("created_at", "offer_created_at").cast("bigint"))
    return rows.join(s, "seller_id", "left").join(c, "buyer_id", "left")


@query("battle country bounty", DETAILS + "SELECT * FROM details")
def v_battle_details(spark: SparkSession, d: str) -> DataFrame:
    return battle_details(t.battle(spark, d), t.country(spark, d), t.bounty(spark, d))


@query(
    "battle country rounds",
    """SELECT r.*, a.name AS attacker_name, f.name AS defender_name,
  CASE WHEN attacker_damages > defender_damages THEN a.name WHEN defender_damages > attacker_damages THEN f.name END AS winner_name
  FROM rounds r LEFT JOIN battle b USING (battle_id) LEFT JOIN country a ON a.country_id = attacker_country_id LEFT JOIN country f ON f.country_id = defender_country_id""",
)
def v_round_details(spark: SparkSession, d: str) -> DataFrame:
    roles = t.battle(spark, d).select("battle_id", "attacker_country_id", "defender_country_id")
    c = t.country(spark, d)
    name = lambda r: F.broadcast(c.select(F.col("country_id").alias(f"{r}_country_id"), F.col("name").alias(f"{r}_name")))
    out = t.rounds(spark, d).join(roles, "battle_id", "left").join(name("attacker"), "attacker_country_id", "left").join(name("defender"), "defender_country_id", "left")
    winner = F.when(F.col("attacker_damages") > F.col("defender_damages"), F.col("attacker_name")).when(F.col("defender_damages") > F.col("attacker_damages"), F.col("defender_name"))
    return out.withColumn("winner_name", winner).drop("attacker_country_id", "defender_country_id")


@query(
    "battle country bounty",
    DETAILS + "SELECT battle_id, attacker_pool, defender_pool, CAST(attacker_pool IS NOT NULL AS INTEGER) + CAST(defender_pool IS NOT NULL AS INTEGER) AS bounty_side_count FROM details WHERE attacker_pool IS NOT NULL OR defender_pool IS NOT NULL",
)
def v_bounty_details(spark: SparkSession, d: str) -> DataFrame:
    rows = v_battle_details(spark, d).select("battle_id", "attacker_pool", "defender_pool")
    count = F.col("attacker_pool").isNotNull().cast("int") + F.col("defender_pool").isNotNull().cast("int")
    return rows.withColumn("bounty_side_count", count).where("bounty_side_count > 0")


def country_bounty(battle: DataFrame, bounty: DataFrame, country: DataFrame) -> DataFrame:
    """Pools by the country that they stand behind: all, those of ended battles (null if none ended), and the number of sides."""
    own = F.when(F.col("side") == 1, F.col("attacker_country_id")).otherwise(F.col("defender_country_id"))
    sides = bounty.join(battle.select("battle_id", "ended_at", "attacker_country_id", "defender_country_id"), "battle_id").select(own.alias("country_id"), "money_pool", "ended_at")
    sums = sides.groupBy("country_id").agg(F.sum("money_pool").alias("total"), F.sum(F.when(F.col("ended_at").isNotNull(), F.col("money_pool"))).alias("ended"), F.count("*").alias("side_count"))
    return sums.join(F.broadcast(country), "country_id").select("country_id", "name", F.round("total", 2).alias("total_pool"), F.round("ended", 2).alias("ended_pool"), "side_count")


COUNTRY_BOUNTY = """, sides AS (
  SELECT CASE side WHEN 1 THEN attacker_country_id ELSE defender_country_id END AS country_id, money_pool, ended_at FROM bounty JOIN battle USING (battle_id)),
country_bounty AS (
  SELECT country_id, name, round(sum(money_pool), 2) AS total_pool, round(sum(money_pool) FILTER (ended_at IS NOT NULL), 2) AS ended_pool, count(*) AS side_count
  FROM sides JOIN country USING (country_id) GROUP BY 1, 2)
"""


@query("battle bounty country", COUNTRY_BOUNTY + "SELECT * FROM country_bounty")
def v_country_bounty(spark: SparkSession, d: str) -> DataFrame:
    return country_bounty(t.battle(spark, d), t.bounty(spark, d), t.country(spark, d))


@query("battle bounty country", COUNTRY_BOUNTY + "SELECT name, total_pool FROM country_bounty ORDER BY total_pool DESC NULLS LAST, name LIMIT 8")
def hidden_pools(spark: SparkSession, d: str) -> DataFrame:
    return v_country_bounty(spark, d).select("name", "total_pool").orderBy(F.desc_nulls_last("total_pool"), "name").limit(8)


@query(
    "battle rounds",
    "SELECT b.battle_id, r.number AS last_number, r.attacker_damages, r.defender_damages FROM battle b LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY battle_id ORDER BY number DESC) AS k FROM rounds) r ON r.battle_id = b.battle_id AND k = 1",
)
def last_round_damage(spark: SparkSession, d: str) -> DataFrame:
    last = last_round(t.rounds(spark, d)).select("battle_id", F.col("number").alias("last_number"), "attacker_damages", "defender_damages")
    return t.battle(spark, d).select("battle_id").join(last, "battle_id", "left")


def resolve(wanted: DataFrame, names: DataFrame) -> DataFrame:
    """Each asked ``text`` as a 24-hex id or a name whatever its case: the id, or absent or ambiguous."""
    by_id = wanted.join(names.select(F.col("external_id").alias("x"), F.col("entity_id").alias("by_id")), F.lower("text") == F.col("x"), "left")
    named = names.groupBy(F.lower("name").alias("low")).agg(F.count("*").alias("n"), F.min("entity_id").alias("by_name"))
    found = by_id.join(named, F.lower("text") == F.col("low"), "left")
    state = F.when(F.col("by_id").isNotNull(), "found").when(F.col("n") == 1, "found").when(F.col("n") > 1, "ambiguous").otherwise("absent")
    return found.select("text", state.alias("state"), F.when(state == "found", F.coalesce("by_id", "by_name")).alias("entity_id"))


@query(
    "",
    """WITH names AS (SELECT c_custkey AS entity_id, lpad(to_hex(c_custkey), 24, '0') AS external_id, concat(c_mktsegment, c_custkey % 400) AS name FROM customer),
wanted AS (SELECT upper(concat(c_mktsegment, c_custkey % 500)) AS text FROM customer UNION SELECT lower(lpad(to_hex(c_custkey * 2), 24, '0')) FROM customer),
named AS (SELECT lower(name) AS low, count(*) AS n, min(entity_id) AS by_name FROM names GROUP BY 1)
SELECT text, CASE WHEN i.entity_id IS NOT NULL OR n = 1 THEN 'found' WHEN n > 1 THEN 'ambiguous' ELSE 'absent' END AS state,
  CASE WHEN i.entity_id IS NOT NULL THEN i.entity_id WHEN n = 1 THEN by_name END AS entity_id
FROM wanted LEFT JOIN names i ON lower(i.external_id) = lower(text) LEFT JOIN named ON low = lower(text)""",
)
def resolve_entities(spark: SparkSession, d: str) -> DataFrame:
    c = t.load(spark, d, "customer")
    hexed = lambda n: F.lower(F.lpad(F.hex(n), 24, "0"))
    names = c.select(F.col("c_custkey").alias("entity_id"), hexed(F.col("c_custkey")).alias("external_id"), F.concat("c_mktsegment", (F.col("c_custkey") % 400).cast("string")).alias("name"))
    wanted = c.select(F.upper(F.concat("c_mktsegment", (F.col("c_custkey") % 500).cast("string"))).alias("text")).union(c.select(hexed(F.col("c_custkey") * 2))).distinct()
    return resolve(wanted, names)


@query("battle", "SELECT battle_id FROM battle WHERE battle_id NOT IN (SELECT l_orderkey FROM lineitem)")
def battles_without_rounds(spark: SparkSession, d: str) -> DataFrame:
    return t.battle(spark, d).select("battle_id").join(t.rounds(spark, d).select("battle_id"), "battle_id", "left_anti")


@query("usage_log", "SELECT endpoint FROM (SELECT DISTINCT event_type AS endpoint FROM events UNION ALL VALUES ('archive'), ('export')) WHERE endpoint NOT IN (SELECT endpoint FROM usage_log WHERE endpoint <> 'error')")
def unused_endpoints(spark: SparkSession, d: str) -> DataFrame:
    log = t.usage_log(spark, d)
    known = log.select("endpoint").distinct().union(spark.createDataFrame([("archive",), ("export",)], "endpoint string"))
    used = log.where("endpoint != 'error'").select("endpoint").distinct()  # few, so that no task gets a row for each use
    return known.join(used, "endpoint", "left_anti")


SIDES = "battle_id, round_number, entity_type, entity_id"


@query(
    "rank_entry",
    f""", s AS (SELECT {SIDES}, sum(damage) AS a, sum(points) AS b FROM rank_entry WHERE side IN (1, 2) GROUP BY ALL),
m AS (SELECT {SIDES}, sum(damage) AS a, sum(points) AS b FROM rank_entry WHERE side = 3 GROUP BY ALL)
SELECT count(*) AS pairs, count(*) FILTER (m.a IS NOT DISTINCT FROM s.a AND m.b IS NOT DISTINCT FROM s.b) AS equal_rows FROM m JOIN s USING ({SIDES})""",
)
def merged_equals_sides(spark: SparkSession, d: str) -> DataFrame:
    key = SIDES.split(", ")
    rows = t.rank_entry(spark, d)
    s = rows.where("side < 3").groupBy(*key).agg(F.sum("damage").alias("a"), F.sum("points").alias("b"))
    m = rows.where("side = 3").groupBy(*key).agg(F.sum("damage").alias("ma"), F.sum("points").alias("mb"))
    return m.join(s, key).agg(F.count("*").alias("pairs"), F.count_if(F.col("ma").eqNullSafe(F.col("a")) & F.col("mb").eqNullSafe(F.col("b"))).alias("equal_rows"))


RESET = "1997-01-06 00:00:00"


@query("rounds rank_entry", f"SELECT entity_id, CAST(sum(damage) AS BIGINT) AS straddle FROM rank_entry e JOIN rounds r ON r.battle_id = e.battle_id AND r.number = e.round_number WHERE r.created_at < TIMESTAMP '{RESET}' AND r.ended_at > TIMESTAMP '{RESET}' GROUP BY 1")
def straddlers(spark: SparkSession, d: str) -> DataFrame:
    at = F.lit(RESET).cast("timestamp_ntz")
    r = t.rounds(spark, d).where((F.col("created_at") < at) & (F.col("ended_at") > at)).select("battle_id", F.col("number").alias("round_number"))
    return t.rank_entry(spark, d).join(r, ["battle_id", "round_number"]).groupBy("entity_id").agg(F.sum("damage").alias("straddle"))


@query(
    "battle country bounty rounds rank_entry",
    DETAILS
    + """, picked AS (SELECT max(battle_id) AS battle_id FROM rounds)
SELECT battle_id, 'round' AS part, CAST(number AS BIGINT) AS k, CAST(attacker_damages AS DOUBLE) AS x, CAST(defender_damages AS DOUBLE) AS y FROM rounds JOIN picked USING (battle_id)
UNION ALL SELECT battle_id, 'bounty', side, money_pool, NULL FROM bounty JOIN picked USING (battle_id) WHERE money_pool > 0
UNION ALL SELECT battle_id, 'players', count(DISTINCT entity_id), CAST(sum(damage) AS DOUBLE), NULL FROM rank_entry JOIN picked USING (battle_id) WHERE damage > 0 GROUP BY 1
UNION ALL SELECT battle_id, 'battle', attacker_country_id, attacker_pool, defender_pool FROM details JOIN picked USING (battle_id)""",
)
def battle_detail(spark: SparkSession, d: str) -> DataFrame:
    """All parts of one battle's page, as (part, k, x, y) rows; the last battle that has rounds."""
    number = t.load(spark, d, "lineitem").agg(F.max("l_orderkey")).first()[0]
    of = lambda df: df.where(F.col("battle_id") == number)
    part = lambda df, name, k, x, y: df.select("battle_id", F.lit(name).alias("part"), k.cast("bigint").alias("k"), x.cast("double").alias("x"), y.cast("double").alias("y"))
    none = F.lit(None)
    players = of(t.rank_entry(spark, d)).where("damage > 0").groupBy("battle_id").agg(F.countDistinct("entity_id").alias("n"), F.sum("damage").alias("s"))
    return (
        part(of(t.rounds(spark, d)), "round", F.col("number"), F.col("attacker_damages"), F.col("defender_damages"))
        .union(part(of(t.bounty(spark, d)).where("money_pool > 0"), "bounty", F.col("side"), F.col("money_pool"), none))
        .union(part(players, "players", F.col("n"), F.col("s"), none))
        .union(part(of(v_battle_details(spark, d)), "battle", F.col("attacker_country_id"), F.col("attacker_pool"), F.col("defender_pool")))
    )
