"""Browsing: filters, search, pages, rankings."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerforge import fixtures as t
from ledgerforge.operators import browse as b
from ledgerforge.plans.registry import query

AS_OF = dt.datetime(1998, 1, 1)


@query("tx", "SELECT tx_id, created_at, tx_type, item_code, money FROM tx WHERE tx_type = 'AF' AND (seller_id = 7 OR buyer_id = 7) AND created_at >= TIMESTAMP '1996-01-01' AND created_at < TIMESTAMP '1998-01-01'")
def tx_browse(spark: SparkSession, d: str) -> DataFrame:
    rows = b.browse(t.tx(spark, d), AS_OF, tx_type="AF", user=7, start=dt.datetime(1998, 1, 1), end=dt.datetime(1996, 1, 1))
    return rows.select("tx_id", "created_at", "tx_type", "item_code", "money")


LIST = "SELECT battle_id, battle_type, created_at FROM battle WHERE (attacker_country_id = 3 OR defender_country_id = 3) AND ended_at IS NOT NULL"


def _list(spark: SparkSession, d: str) -> DataFrame:
    either = (F.col("attacker_country_id") == 3) | (F.col("defender_country_id") == 3)
    return t.battle(spark, d).where(either & F.col("ended_at").isNotNull()).select("battle_id", "battle_type", "created_at")


@query("battle", LIST)
def battle_list(spark: SparkSession, d: str) -> DataFrame:
    return _list(spark, d)


@query("battle", LIST + " ORDER BY created_at DESC, battle_id DESC LIMIT 20 OFFSET 20")
def battle_list_page(spark: SparkSession, d: str) -> DataFrame:
    return b.offset_page(_list(spark, d), [F.desc("created_at"), F.desc("battle_id")], page=2, size=20)


@query("account", "SELECT account_id, name FROM account WHERE contains(lower(name), '0012')")
def user_search(spark: SparkSession, d: str) -> DataFrame:
    return t.account(spark, d).where(b.contains("name", "0012")).select("account_id", "name")


@query(
    "account country",
    """, firsts AS (SELECT * FROM account WHERE starts_with(lower(name), 'customer#0000000') ORDER BY lower(name), account_id LIMIT 3)
SELECT CASE WHEN last_active_at > TIMESTAMP '1998-01-01' - INTERVAL 96 HOUR THEN 'active' ELSE 'inactive' END AS section, account_id AS id, name FROM firsts
UNION ALL SELECT * FROM (SELECT 'country', CAST(country_id AS BIGINT), name FROM country WHERE starts_with(lower(name), 'nation_1') ORDER BY lower(name) LIMIT 3)""",
)
def prefix_search(spark: SparkSession, d: str) -> DataFrame:
    """The first three users overall, then split into sections, and three countries."""
    first = t.account(spark, d).where(F.lower("name").startswith("customer#0000000")).orderBy(F.lower("name"), "account_id").limit(3)
    active = F.col("last_active_at") > F.lit(AS_OF - dt.timedelta(hours=96)).cast("timestamp_ntz")
    users = first.select(F.when(active, "active").otherwise("inactive").alias("section"), F.col("account_id").alias("id"), "name")
    lands = t.country(spark, d).where(F.lower("name").startswith("nation_1")).orderBy(F.lower("name")).limit(3)
    return users.union(lands.select(F.lit("country"), F.col("country_id").cast("bigint"), "name"))


@query("bounty", "SELECT battle_id, side, round(money_pool, 2) AS pool FROM bounty WHERE money_pool > 0 ORDER BY money_pool DESC, battle_id, side LIMIT 200")
def open_bounties(spark: SparkSession, d: str) -> DataFrame:
    return t.bounty(spark, d).where("money_pool > 0").orderBy(F.desc("money_pool"), "battle_id", "side").limit(200).select("battle_id", "side", F.round("money_pool", 2).alias("pool"))


CURSOR = (dt.datetime(1997, 6, 1), "3")
PAGE = "SELECT tx_id, created_at, money FROM tx"


@query("tx", PAGE + " WHERE created_at < TIMESTAMP '1997-06-01' OR (created_at = TIMESTAMP '1997-06-01' AND tx_id < '3') ORDER BY created_at DESC, tx_id DESC LIMIT 100")
def tx_keyset_before(spark: SparkSession, d: str) -> DataFrame:
    return b.keyset_page(t.tx(spark, d).select("tx_id", "created_at", "money"), "created_at", "tx_id", CURSOR)


@query("tx", PAGE + " WHERE created_at > TIMESTAMP '1997-06-01' OR (created_at = TIMESTAMP '1997-06-01' AND tx_id > '3') ORDER BY created_at, tx_id LIMIT 100")
def tx_keyset_after(spark: SparkSession, d: str) -> DataFrame:
    return b.keyset_page(t.tx(spark, d).select("tx_id", "created_at", "money"), "created_at", "tx_id", CURSOR, forward=True)


@query(
    "tx",
    ", page AS (SELECT * FROM tx ORDER BY created_at DESC, tx_id DESC LIMIT 100) SELECT tx_id, created_at, money, s_name AS seller_name, c_name AS buyer_name FROM page LEFT JOIN supplier ON s_suppkey = seller_id LEFT JOIN customer ON c_custkey = buyer_id",
)
def tx_page_details(spark: SparkSession, d: str) -> DataFrame:
    """Limit first; the lookups see the page only."""
    page = F.broadcast(b.keyset_page(t.tx(spark, d), "created_at", "tx_id"))  # 100 rows
    s, c = t.load(spark, d, "supplier"), t.load(spark, d, "customer")
    out = s.join(page, s["s_suppkey"] == page["seller_id"], "right")
    out = c.join(F.broadcast(out), c["c_custkey"] == out["buyer_id"], "right")
    return out.select("tx_id", "created_at", "money", F.col("s_name").alias("seller_name"), F.col("c_name").alias("buyer_name"))


@query("account", "SELECT account_id, name, xp FROM account ORDER BY xp DESC NULLS LAST, account_id LIMIT 100")
def user_leaderboard(spark: SparkSession, d: str) -> DataFrame:
    return b.offset_page(t.account(spark, d).select("account_id", "name", "xp"), [F.desc_nulls_last("xp"), F.asc("account_id")], 1)


def dominant(side: str = "side", damage: str = "damage"):
    """Side of the largest damage; null damage comes last, ties go to the lower side."""
    return F.max_by(side, F.struct(F.coalesce(F.col(damage), F.lit(-1)), -F.col(side)))


@query(
    "rank_entry",
    """, mine AS (SELECT * FROM rank_entry WHERE side IN (1, 2)),
s AS (SELECT battle_id, entity_id, CAST(sum(damage) AS BIGINT) AS damage, CAST(arg_max(side, damage * 10 - side) AS INTEGER) AS main_side FROM mine GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY battle_id ORDER BY damage DESC NULLS LAST, entity_id) AS place FROM s)
SELECT battle_id, entity_id, damage, main_side FROM r WHERE place <= 20""",
)
def battle_top_players(spark: SparkSession, d: str) -> DataFrame:
    rows = t.rank_entry(spark, d).where("side in (1, 2)")
    sums = rows.groupBy("battle_id", "entity_id").agg(F.sum("damage").alias("damage"), dominant().alias("main_side"))
    return b.top_per_group(sums, ["battle_id"], [F.desc_nulls_last("damage"), F.asc("entity_id")], 20)


@query("battle rounds", "SELECT battle_id, CAST(sum(attacker_damages + defender_damages) AS BIGINT) AS damages FROM rounds JOIN battle USING (battle_id) GROUP BY 1 ORDER BY damages DESC, battle_id LIMIT 10")
def biggest_battles(spark: SparkSession, d: str) -> DataFrame:
    sums = t.rounds(spark, d).groupBy("battle_id").agg(F.sum(F.col("attacker_damages") + F.col("defender_damages")).alias("damages"))
    return sums.join(t.battle(spark, d).select("battle_id"), "battle_id", "left_semi").orderBy(F.desc("damages"), "battle_id").limit(10)


@query(
    "tx",
    "SELECT tx_id, created_at, CASE WHEN seller_id = 5 THEN 'sold' ELSE 'bought' END AS direction, CASE WHEN seller_id = 5 THEN buyer_id ELSE seller_id END AS other_id, money FROM tx WHERE seller_id = 5 OR buyer_id = 5 ORDER BY created_at DESC, tx_id DESC LIMIT 20",
)
def account_recent(spark: SparkSession, d: str) -> DataFrame:
    sold = F.col("seller_id") == 5
    rows = t.tx(spark, d).where(sold | (F.col("buyer_id") == 5)).orderBy(F.desc("created_at"), F.desc("tx_id")).limit(20)
    return rows.select("tx_id", "created_at", F.when(sold, "sold").otherwise("bought").alias("direction"), F.when(sold, F.col("buyer_id")).otherwise(F.col("seller_id")).alias("other_id"), "money")


@query("tx", "SELECT tx_id, created_at, money FROM tx ORDER BY md5(CAST(tx_id AS VARCHAR) || 'check'), tx_id LIMIT 20")
def tx_random_sample(spark: SparkSession, d: str) -> DataFrame:
    """Twenty rows to look at, the same on each run."""
    return b.random_sample(t.tx(spark, d), "tx_id", 20, "check").select("tx_id", "created_at", "money")


ORDINALS = ", n AS (SELECT battle_id, created_at, row_number() OVER (ORDER BY created_at, battle_id) - 1 AS ordinal FROM battle)"


@query("battle", ORDINALS + " SELECT battle_id, ordinal FROM n WHERE ordinal % 50 = 0")
def every_nth(spark: SparkSession, d: str) -> DataFrame:
    rows = t.battle(spark, d).select("battle_id", "created_at")
    return b.numbered(rows, ["created_at", "battle_id"]).where("ordinal % 50 = 0").select("battle_id", "ordinal")


@query("battle rank_entry", ORDINALS + " SELECT battle_id, ordinal FROM n WHERE ordinal BETWEEN 100 AND 400 AND battle_id NOT IN (SELECT battle_id FROM rank_entry WHERE side = 3)")
def ordinal_range(spark: SparkSession, d: str) -> DataFrame:
    rows = b.numbered(t.battle(spark, d).select("battle_id", "created_at"), ["created_at", "battle_id"])
    done = t.rank_entry(spark, d).where("side = 3").select("battle_id")
    return rows.where("ordinal between 100 and 400").join(done, "battle_id", "left_anti").select("battle_id", "ordinal")


@query(
    "rank_entry",
    """, s AS (SELECT side, round_number, entity_id, CAST(sum(damage) AS BIGINT) AS damage FROM rank_entry GROUP BY 1, 2, 3),
r AS (SELECT *, row_number() OVER (PARTITION BY side, round_number ORDER BY damage DESC, entity_id) AS place FROM s)
SELECT side, round_number, entity_id, damage FROM r WHERE place <= 300""",
)
def rank_cap_300(spark: SparkSession, d: str) -> DataFrame:
    sums = t.rank_entry(spark, d).groupBy("side", "round_number", "entity_id").agg(F.sum("damage").alias("damage"))
    return b.top_per_group(sums, ["side", "round_number"], [F.desc("damage"), F.asc("entity_id")], 300)


@query(
    "rank_entry",
    ", s AS (SELECT battle_id, side, entity_id, CAST(sum(damage) AS BIGINT) AS damage FROM rank_entry GROUP BY 1, 2, 3) SELECT *, rank() OVER (PARTITION BY battle_id, side ORDER BY damage DESC) AS place FROM s",
)
def damage_rank(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    sums = t.rank_entry(spark, d).groupBy("battle_id", "side", "entity_id").agg(F.sum("damage").alias("damage"))
    return sums.withColumn("place", F.rank().over(Window.partitionBy("battle_id", "side").orderBy(F.desc("damage"))).cast("bigint"))


@query(
    "rank_entry",
    ", r AS (SELECT *, row_number() OVER (PARTITION BY battle_id, side, entity_id ORDER BY created_at DESC, damage DESC, points DESC, money DESC) AS k FROM rank_entry) SELECT battle_id, side, entity_id, created_at, damage, points, money FROM r WHERE k = 1",
)
def latest_per_key(spark: SparkSession, d: str) -> DataFrame:
    rows = t.rank_entry(spark, d).select("battle_id", "side", "entity_id", "created_at", "damage", "points", "money")
    return b.latest(rows, ["battle_id", "side", "entity_id"], ["created_at", "damage", "points", "money"])


