"""Ranking consistency and freshness checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerforge import fixtures as t
from ledgerforge.operators import quality as q
from ledgerforge.plans.registry import query

KEY = "battle_id, round_number, entity_type, entity_id"
#: The battle level as it would be stored: sums over rounds, one in 41 battles off by one.
BATTLE_LEVEL = ", be AS (SELECT battle_id, side, entity_type, entity_id, CAST(sum(damage) + CASE WHEN battle_id % 41 = 0 THEN 1 ELSE 0 END AS BIGINT) AS damage FROM rank_entry GROUP BY 1, 2, 3, 4), re AS (SELECT battle_id, side, entity_type, entity_id, CAST(sum(damage) AS BIGINT) AS r FROM rank_entry GROUP BY 1, 2, 3, 4)"


def battle_level(entries: DataFrame) -> DataFrame:
    off = F.when(F.col("battle_id") % 41 == 0, 1).otherwise(0)
    return entries.groupBy("battle_id", "side", "entity_type", "entity_id").agg(F.sum("damage").alias("damage")).withColumn("damage", F.col("damage") + off)


CHK = "SELECT 'rounds = battle' AS label, count(*) FILTER (damage <> r) AS diff, count(*) AS pairs FROM be JOIN re USING (battle_id, side, entity_type, entity_id)"


@query("rank_entry", BATTLE_LEVEL + " " + CHK)
def chk_rounds_eq_battle(spark: SparkSession, d: str) -> DataFrame:
    rows = t.rank_entry(spark, d)
    return q.sums_equal(rows, battle_level(rows))


MERGED = f", m AS (SELECT * FROM rank_entry WHERE side = 3), s AS (SELECT DISTINCT {KEY} FROM rank_entry WHERE side IN (1, 2))"


@query("rank_entry", MERGED + f" SELECT DISTINCT {KEY} FROM m ANTI JOIN s USING ({KEY})")
def merged_orphans(spark: SparkSession, d: str) -> DataFrame:
    return q.orphans(t.rank_entry(spark, d))


@query("rank_entry", f"SELECT {KEY}, count(*) AS n FROM rank_entry WHERE side = 3 GROUP BY ALL HAVING count(*) > 1")
def merged_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return q.duplicates(t.rank_entry(spark, d))


@query("rank_entry", MERGED + f" SELECT count(*) AS exceptions FROM m SEMI JOIN s USING ({KEY})")
def merged_exceptions(spark: SparkSession, d: str) -> DataFrame:
    rows = t.rank_entry(spark, d)
    key = KEY.split(", ")
    return rows.where("side = 3").join(rows.where("side < 3").select(*key), key, "left_semi").agg(F.count("*").alias("exceptions"))


LAST = ", lr AS (SELECT battle_id, max(number) AS number FROM rounds WHERE attacker_damages + defender_damages > 0 GROUP BY 1)"


@query("rounds rank_entry", LAST + " SELECT battle_id, number FROM lr WHERE (battle_id, number) NOT IN (SELECT battle_id, round_number FROM rank_entry WHERE side = 1)")
def chk_last_round(spark: SparkSession, d: str) -> DataFrame:
    return q.last_round_missing(t.rounds(spark, d), t.rank_entry(spark, d).where("side = 1"))


VERIFIED = ", miss AS (SELECT DISTINCT battle_id FROM rounds WHERE attacker_damages + defender_damages > 0 AND (battle_id, number) NOT IN (SELECT battle_id, round_number FROM rank_entry WHERE side <> 3)), verified AS (SELECT battle_id FROM battle WHERE ended_at < TIMESTAMP '1998-01-01' - INTERVAL 5 MINUTE AND battle_id NOT IN (SELECT battle_id FROM miss))"


def now():
    return F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")


@query("battle rounds rank_entry", VERIFIED + " SELECT * FROM verified")
def battle_verified(spark: SparkSession, d: str) -> DataFrame:
    return q.verified(t.battle(spark, d), t.rounds(spark, d), t.rank_entry(spark, d).where("side != 3"), now())


@query("battle rounds rank_entry", VERIFIED + " SELECT count(*) FILTER (ended_at > TIMESTAMP '1998-01-01' - INTERVAL 7 DAY) AS last_week, count(*) AS total FROM battle WHERE ended_at IS NOT NULL AND battle_id NOT IN (SELECT battle_id FROM verified)")
def chk_unverified(spark: SparkSession, d: str) -> DataFrame:
    left = t.battle(spark, d).where("ended_at is not null").join(battle_verified(spark, d), "battle_id", "left_anti")
    return left.agg(F.count_if(F.col("ended_at") > now() - F.expr("INTERVAL 7 DAYS")).alias("last_week"), F.count("*").alias("total"))


NEED = ", n AS (SELECT battle_id, max(created_at) AS newest FROM rank_entry GROUP BY 1), need AS (SELECT battle_id, ended_at FROM battle LEFT JOIN n USING (battle_id) WHERE ended_at IS NOT NULL AND battle_id % 10 <> 0 AND (newest IS NULL OR ended_at > TIMESTAMP '1998-01-01' - INTERVAL 5 MINUTE OR newest < ended_at - INTERVAL 1 MINUTE))"


@query("battle rank_entry", NEED + " SELECT battle_id FROM need")
def needs_fetch(spark: SparkSession, d: str) -> DataFrame:
    b = t.battle(spark, d)
    return q.needs_fetch(b, t.rank_entry(spark, d), b.where("battle_id % 10 = 0").select("battle_id"), now()).select("battle_id")


@query("battle rank_entry", NEED + " SELECT battle_id FROM need ORDER BY ended_at DESC, battle_id DESC LIMIT 50")
def pick_latest(spark: SparkSession, d: str) -> DataFrame:
    b = t.battle(spark, d)
    return q.needs_fetch(b, t.rank_entry(spark, d), b.where("battle_id % 10 = 0").select("battle_id"), now()).orderBy(F.desc("ended_at"), F.desc("battle_id")).limit(50).select("battle_id")


@query("battle rounds rank_entry", ", dr AS (SELECT battle_id, count(DISTINCT number) AS due FROM rounds WHERE attacker_damages + defender_damages > 0 GROUP BY 1), rr AS (SELECT battle_id, count(DISTINCT round_number) AS ranked FROM rank_entry WHERE side = 1 GROUP BY 1) SELECT battle_id, due, coalesce(ranked, 0) AS ranked FROM battle JOIN dr USING (battle_id) LEFT JOIN rr USING (battle_id) WHERE ended_at > TIMESTAMP '1998-01-01' - INTERVAL 700 DAY AND coalesce(ranked, 0) < due")
def incomplete_rounds(spark: SparkSession, d: str) -> DataFrame:
    due = t.rounds(spark, d).where("attacker_damages + defender_damages > 0").groupBy("battle_id").agg(F.countDistinct("number").alias("due"))
    ranked = t.rank_entry(spark, d).where("side = 1").groupBy("battle_id").agg(F.countDistinct("round_number").alias("ranked"))
    ended = t.battle(spark, d).where(F.col("ended_at") > now() - F.expr("INTERVAL 700 DAYS")).select("battle_id")
    return ended.join(due, "battle_id").join(ranked, "battle_id", "left").withColumn("ranked", F.coalesce("ranked", F.lit(0))).where("ranked < due")


@query("rank_entry", "SELECT (SELECT count(*) FROM (SELECT DISTINCT entity_id, battle_id, side FROM rank_entry WHERE side IN (1, 2))) AS source_groups, (SELECT count(*) FROM (SELECT entity_id, battle_id, side, sum(damage) FROM rank_entry WHERE side IN (1, 2) GROUP BY 1, 2, 3)) AS derived_rows")
def chk_stats_rebuild(spark: SparkSession, d: str) -> DataFrame:
    from ledgerforge.plans.reports import battle_stats

    rows = t.rank_entry(spark, d)
    groups = rows.where("side in (1, 2)").select("entity_id", "battle_id", "side").distinct().agg(F.count("*").alias("source_groups"), F.lit(1).alias("one"))
    return groups.join(battle_stats(rows).agg(F.count("*").alias("derived_rows"), F.lit(1).alias("one")), "one").drop("one")


@query("rounds battle", "SELECT battle_id, number FROM rounds SEMI JOIN (SELECT battle_id FROM battle WHERE ended_at IS NULL) b USING (battle_id) WHERE ended_at > TIMESTAMP '1998-01-01'")
def unfinalized_rounds(spark: SparkSession, d: str) -> DataFrame:
    """Rounds of active battles with no end as of the given time."""
    return t.rounds(spark, d).where(F.col("ended_at") > now()).join(t.battle(spark, d).where("ended_at is null").select("battle_id"), "battle_id", "left_semi").select("battle_id", "number")


CLEAN = f""", e AS (SELECT r.*, b.ended_at FROM rank_entry r JOIN battle b USING (battle_id)),
k1 AS (SELECT * FROM e WHERE NOT (side IN (1, 2) AND ended_at IS NOT NULL AND created_at < ended_at - INTERVAL 2 MINUTE AND ended_at > TIMESTAMP '1998-01-01' - INTERVAL 7 DAY)),
k2 AS (SELECT * FROM k1 WHERE NOT (side = 3 AND ended_at IS NOT NULL AND created_at < ended_at - INTERVAL 2 MINUTE AND ended_at > TIMESTAMP '1998-01-01' - INTERVAL 7 DAY)),
s AS (SELECT {KEY}, sum(damage) AS d FROM k2 WHERE side IN (1, 2) GROUP BY ALL)
SELECT battle_id, round_number, side, entity_id, damage, created_at FROM k2 LEFT JOIN s USING ({KEY}) WHERE NOT (side = 3 AND d IS NOT DISTINCT FROM damage)"""


@query("rank_entry battle", CLEAN)
def rank_cleanup(spark: SparkSession, d: str) -> DataFrame:
    out = q.cleaned(t.rank_entry(spark, d), t.battle(spark, d).select("battle_id", "ended_at"), now())
    return out.select("battle_id", "round_number", "side", "entity_id", "damage", "created_at")


#: The battle level with all its sides as it would be stored: what ``be`` holds, with the other measures.
LEVELS = """, bl AS (SELECT battle_id, side, entity_type, entity_id, CAST(sum(damage) AS BIGINT) AS damage, CAST(sum(points) AS BIGINT) AS points,
  CAST(count(*) AS BIGINT) AS hits, round(sum(money), 2) AS money FROM rank_entry GROUP BY 1, 2, 3, 4),
rl AS (SELECT *, CAST(1 AS BIGINT) AS hits FROM rank_entry)"""
MEASURES = ["damage", "points", "hits", "money"]
BATTLE_KEY = [k for k in q.KEY if k != "round_number"]


def levels(spark: SparkSession, d: str) -> dict[str, tuple[DataFrame, list[str]]]:
    """Ranking rows of the battle and the round level with their keys and four measures."""
    rows = t.rank_entry(spark, d).withColumn("hits", F.lit(1).cast("bigint"))
    sums = [F.sum("damage").alias("damage"), F.sum("points").alias("points"), F.sum("hits").alias("hits"), F.round(F.sum("money"), 2).alias("money")]
    return {"battle": (rows.groupBy("battle_id", "side", "entity_type", "entity_id").agg(*sums), BATTLE_KEY), "round": (rows, q.KEY)}


def _level_sql(level: str, table: str, key: list[str]) -> str:
    """Orphans, duplicates, leftovers and exceptions of a level's merged rows."""
    k = ", ".join(key)
    merged = f"(SELECT * FROM {table} WHERE side = 3)"
    sides = f"(SELECT DISTINCT {k} FROM {table} WHERE side < 3)"
    sums = lambda side: f"(SELECT {k}, " + ", ".join(f"{f'round(sum({m}), 2)' if m == 'money' else f'sum({m})'} AS {m}" for m in MEASURES) + f" FROM {table} WHERE {side} GROUP BY ALL)"
    same = " AND ".join(f"m.{m} IS NOT DISTINCT FROM s.{m}" for m in MEASURES)
    bad = {
        "merged orphans": f"SELECT DISTINCT {k} FROM {merged} ANTI JOIN {sides} USING ({k})",
        "merged duplicates": f"SELECT {k} FROM {merged} GROUP BY ALL HAVING count(*) > 1",
        "leftovers": f"SELECT {k} FROM {sums('side = 3')} m JOIN {sums('side < 3')} s USING ({k}) WHERE {same}",
        "exceptions kept": f"SELECT {k} FROM {merged} SEMI JOIN {sides} USING ({k})",
    }
    return " UNION ALL ".join(f"SELECT '{label}, {level}' AS label, count(*) AS diff, (SELECT count(*) FROM {merged}) AS pairs FROM ({sql})" for label, sql in bad.items())


MERGED_LEVELS = _level_sql("battle", "bl", BATTLE_KEY) + " UNION ALL " + _level_sql("round", "rl", q.KEY)


@query("rank_entry", LEVELS + " " + MERGED_LEVELS)
def merged_report(spark: SparkSession, d: str) -> DataFrame:
    """Orphans, duplicates, leftovers and exceptions of merged rows, by level, with the number of merged rows."""
    parts = []
    for level, (rows, key) in levels(spark, d).items():
        cents = rows.withColumn("money", F.round(F.col("money") * 100).cast("bigint"))  # sums of whole numbers have one value in any order
        names = {"merged orphans": "orphans", "merged duplicates": "duplicates", "leftovers": "leftovers", "exceptions kept": "exceptions"}
        each = F.array(*[F.struct(F.lit(f"{label}, {level}").alias("label"), F.col(c).alias("diff")) for label, c in names.items()])
        parts.append(q.merged_counts(cents, MEASURES, key).select(F.explode(each).alias("p"), F.col("merged").alias("pairs")).select("p.label", "p.diff", "pairs"))
    return reduce(DataFrame.unionByName, parts)


REPORT = BATTLE_LEVEL + LEVELS + LAST + VERIFIED + f"""
{CHK} UNION ALL {MERGED_LEVELS}
UNION ALL SELECT 'last round', count(*) FILTER ((battle_id, number) NOT IN (SELECT battle_id, round_number FROM rank_entry WHERE side = 1)), count(*) FROM lr
UNION ALL SELECT 'unverified', count(*) FILTER (battle_id NOT IN (SELECT battle_id FROM verified)), count(*) FROM battle WHERE ended_at IS NOT NULL
UNION ALL SELECT 'unverified, last week', count(*) FILTER (battle_id NOT IN (SELECT battle_id FROM verified)), count(*) FROM battle WHERE ended_at > TIMESTAMP '1998-01-01' - INTERVAL 7 DAY"""


@query("battle rounds rank_entry", REPORT)
def ranking_quality_report(spark: SparkSession, d: str) -> DataFrame:
    rounds, one = t.rounds(spark, d), F.lit(1).alias("one")  # parts are single rows
    due = rounds.where("attacker_damages + defender_damages > 0").groupBy("battle_id").agg(F.max("number").alias("number"))
    part = lambda label, bad, every: bad.agg(F.count("*").alias("diff"), one).join(every.agg(F.count("*").alias("pairs"), one), "one").select(F.lit(label).alias("label"), "diff", "pairs")
    ended = t.battle(spark, d).where("ended_at is not null").select("battle_id", (F.col("ended_at") > now() - F.expr("INTERVAL 7 DAYS")).alias("late"))
    state = ended.join(battle_verified(spark, d).select("battle_id", F.lit(True).alias("proven")).distinct(), "battle_id", "left")
    of = {"unverified": F.lit(True), "unverified, last week": F.col("late")}
    counts = [F.struct(F.lit(label).alias("label"), F.count_if(x & F.col("proven").isNull()).alias("diff"), F.count_if(x).alias("pairs")) for label, x in of.items()]
    unverified = state.agg(F.array(*counts).alias("p")).select(F.inline("p"))
    parts = [
        chk_rounds_eq_battle(spark, d),
        merged_report(spark, d),
        part("last round", chk_last_round(spark, d), due),
        unverified,
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    "rank_entry battle account",
    f""" SELECT 'repeated key' AS check, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS rows FROM (SELECT count(*) AS n FROM rank_entry GROUP BY {KEY}, side)
UNION ALL SELECT 'null key', count(*) FILTER (battle_id IS NULL OR round_number IS NULL OR entity_type IS NULL OR entity_id IS NULL OR side IS NULL) FROM rank_entry
UNION ALL SELECT 'battle_id without parent', count(*) FROM rank_entry WHERE battle_id NOT IN (SELECT battle_id FROM battle)
UNION ALL SELECT 'entity_id without parent', count(*) FROM rank_entry WHERE entity_id NOT IN (SELECT account_id FROM account)""",
)
def rank_constraints(spark: SparkSession, d: str) -> DataFrame:
    """What keys and references of the ranking rows are broken."""
    parents = {"battle_id": (t.battle(spark, d), "battle_id"), "entity_id": (t.account(spark, d), "account_id")}
    return q.key_violations(t.rank_entry(spark, d), [*q.KEY, "side"], parents)
