"""Weekly totals and boards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerforge import fixtures as t
from ledgerforge.operators import weekly as w
from ledgerforge.plans.registry import query
from ledgerforge.session import written

CORRECTIONS = """, corrections AS (SELECT c_custkey AS user_id, TIMESTAMP '1997-01-06' + to_days(CAST(7 * (c_custkey % 3) AS INTEGER)) AS week_start, CAST(c_custkey % 5 * 10 - 20 AS BIGINT) AS amount FROM customer),
starts AS (SELECT battle_id, number AS round_number, CAST(date_trunc('week', created_at) AS TIMESTAMP) AS week_start FROM rounds),
base AS (SELECT entity_id AS user_id, week_start, CAST(sum(damage) AS BIGINT) AS base FROM rank_entry JOIN starts USING (battle_id, round_number) GROUP BY 1, 2),
weekly AS (SELECT user_id, week_start, coalesce(base, 0) + coalesce(amount, 0) AS damage FROM base FULL JOIN corrections USING (user_id, week_start) WHERE base IS NOT NULL OR amount <> 0)
"""


def corrections(spark: SparkSession, d: str) -> DataFrame:
    c = t.load(spark, d, "customer")
    start = F.lit("1997-01-06 00:00:00").cast("timestamp_ntz") + F.make_dt_interval((F.col("c_custkey") % 3 * 7).cast("int"))
    return c.select(F.col("c_custkey").alias("user_id"), start.alias("week_start"), (F.col("c_custkey") % 5 * 10 - 20).alias("amount"))


@query("rounds rank_entry", CORRECTIONS + "SELECT * FROM weekly")
def weekly_damage(spark: SparkSession, d: str) -> DataFrame:
    return w.weekly_damage(t.rank_entry(spark, d), t.rounds(spark, d), corrections(spark, d))


POSTS = CORRECTIONS.replace("corrections AS (SELECT", "posts AS (SELECT", 1).split("starts AS")[0] + """corrections AS (SELECT user_id, week_start, CAST(sum(amount) AS BIGINT) AS amount FROM (SELECT user_id, week_start, amount FROM posts UNION ALL SELECT user_id, week_start - INTERVAL 7 DAY, -amount FROM posts) GROUP BY 1, 2),
starts AS""" + CORRECTIONS.split("starts AS")[1]


@query("rounds rank_entry", POSTS + "SELECT * FROM weekly")
def apply_corrections(spark: SparkSession, d: str) -> DataFrame:
    posts = corrections(spark, d).withColumnRenamed("amount", "post")
    return w.weekly_damage(t.rank_entry(spark, d), t.rounds(spark, d), w.signed_corrections(posts))


@query("rounds rank_entry", POSTS + """, rounds_only AS (SELECT user_id, week_start, base FROM base),
c AS (SELECT p.user_id, p.week_start, p.amount AS post, x.damage - coalesce(r.base, 0) = p.amount AS c1, y.damage - coalesce(q.base, 0) = -p.amount AS c2
  FROM posts p LEFT JOIN weekly x ON x.user_id = p.user_id AND x.week_start = p.week_start LEFT JOIN base r ON r.user_id = p.user_id AND r.week_start = p.week_start
  LEFT JOIN weekly y ON y.user_id = p.user_id AND y.week_start = p.week_start - INTERVAL 7 DAY LEFT JOIN base q ON q.user_id = p.user_id AND q.week_start = p.week_start - INTERVAL 7 DAY)
SELECT user_id, week_start, post, CASE WHEN c1 AND c2 THEN 'verified' WHEN c1 IS NULL OR c2 IS NULL THEN 'in motion' ELSE 'failed' END AS state FROM c""")
def correction_audit(spark: SparkSession, d: str) -> DataFrame:
    """Whether the derived weeks hold what the corrections say: plus in the week, minus in the one before."""
    posts = corrections(spark, d).withColumnRenamed("amount", "post")
    none = spark.createDataFrame([], "user_id bigint, week_start timestamp_ntz, amount bigint")
    base = w.weekly_damage(t.rank_entry(spark, d), t.rounds(spark, d), none).withColumnRenamed("damage", "base")
    gap = apply_corrections(spark, d).join(base, ["user_id", "week_start"], "left").select("user_id", "week_start", (F.col("damage") - F.coalesce("base", F.lit(0))).alias("gap"))
    here = posts.join(gap, ["user_id", "week_start"], "left").withColumnRenamed("gap", "gap_1")
    before = gap.select("user_id", (F.col("week_start") + F.expr("INTERVAL 7 DAYS")).alias("week_start"), F.col("gap").alias("gap_2"))
    both = here.join(before, ["user_id", "week_start"], "left")
    c1, c2 = F.col("gap_1") == F.col("post"), F.col("gap_2") == -F.col("post")
    state = F.when(c1 & c2, "verified").when(c1.isNull() | c2.isNull(), "in motion").otherwise("failed")
    return both.select("user_id", "week_start", "post", state.alias("state"))


@query("week_snapshot", ", l AS (SELECT week_start, max(snapshot_at) AS last_at FROM week_snapshot GROUP BY 1) SELECT week_start, count(*) AS n, count(DISTINCT snapshot_at) AS fetches, count(*) FILTER (snapshot_at = last_at) AS finals FROM week_snapshot JOIN l USING (week_start) GROUP BY 1")
def weekly_snapshot_stats(spark: SparkSession, d: str) -> DataFrame:
    rows = t.week_snapshot(spark, d)
    last = rows.groupBy("week_start").agg(F.max("snapshot_at").alias("last_at"))
    return rows.join(F.broadcast(last), "week_start").groupBy("week_start").agg(F.count("*").alias("n"), F.countDistinct("snapshot_at").alias("fetches"), F.count_if(F.col("snapshot_at") == F.col("last_at")).alias("finals"))


DERIVED = ", d AS (SELECT CAST(date_trunc('week', ts) AS TIMESTAMP) AS week_start, CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS derived FROM events WHERE event_type <> 'error' GROUP BY 1)"


@query("week_snapshot", DERIVED + ", l AS (SELECT week_start, max(snapshot_at) AS last_at FROM week_snapshot GROUP BY 1), o AS (SELECT week_start, CAST(sum(value) AS BIGINT) AS official FROM week_snapshot JOIN l USING (week_start) WHERE snapshot_at = last_at GROUP BY 1) SELECT week_start, official, derived, round(derived * 100.0 / nullif(official, 0), 4) AS percent FROM o LEFT JOIN d USING (week_start)")
def weekly_derived_vs_official(spark: SparkSession, d: str) -> DataFrame:
    from ledgerforge.functions import week

    rows = t.week_snapshot(spark, d)
    last = rows.groupBy("week_start").agg(F.max("snapshot_at").alias("snapshot_at"))
    official = rows.join(F.broadcast(last), ["week_start", "snapshot_at"]).groupBy("week_start").agg(F.sum("value").alias("official"))
    derived = t.load(spark, d, "events").where("event_type != 'error'").groupBy(week(F.col("ts")).alias("week_start")).agg(F.sum(F.floor("value").cast("bigint")).alias("derived"))
    return official.join(derived, "week_start", "left").withColumn("percent", F.round(F.try_divide(F.col("derived") * 100.0, F.col("official")), 4))


@query("week_snapshot", ", w AS (SELECT max(week_start) AS week_start FROM week_snapshot), s AS (SELECT max(snapshot_at) AS snapshot_at FROM week_snapshot JOIN w USING (week_start)) SELECT week_start, snapshot_at, entity_id, value, rank, c_name AS name FROM week_snapshot JOIN w USING (week_start) JOIN s USING (snapshot_at) LEFT JOIN customer ON c_custkey = entity_id WHERE rank <= 1000")
def weekly_board(spark: SparkSession, d: str) -> DataFrame:
    """The current week at its latest snapshot."""
    rows = t.week_snapshot(spark, d)
    now = rows.agg(F.max(F.struct("week_start", "snapshot_at")).alias("m")).first()["m"]
    lit = lambda x: F.lit(x).cast("timestamp_ntz")
    board = rows.where((F.col("week_start") == lit(now["week_start"])) & (F.col("snapshot_at") == lit(now["snapshot_at"])) & (F.col("rank") <= 1000))
    c = t.load(spark, d, "customer").select(F.col("c_custkey").alias("entity_id"), F.col("c_name").alias("name"))
    return c.join(F.broadcast(board), "entity_id", "right").select("week_start", "snapshot_at", "entity_id", "value", "rank", "name")


LAST3 = ", i AS (SELECT week_start, snapshot_at, row_number() OVER (PARTITION BY week_start ORDER BY snapshot_at DESC) AS p FROM (SELECT DISTINCT week_start, snapshot_at FROM week_snapshot)), l AS (SELECT week_start, entity_id, max(value) FILTER (p = 1) AS value_1, max(value) FILTER (p = 2) AS value_2, max(value) FILTER (p = 3) AS value_3 FROM week_snapshot JOIN i USING (week_start, snapshot_at) WHERE p <= 3 GROUP BY 1, 2)"


@query("week_snapshot", LAST3 + " SELECT * FROM l")
def snapshot_last3(spark: SparkSession, d: str) -> DataFrame:
    return w.last_instants(t.week_snapshot(spark, d))


CURRENT = "2024-01-22 00:00:00"


@query("week_snapshot", f", k AS (SELECT *, row_number() OVER (PARTITION BY week_start, entity_id ORDER BY snapshot_at DESC) AS k FROM week_snapshot) SELECT week_start, snapshot_at, entity_id, value, rank FROM k WHERE k = 1 OR week_start >= TIMESTAMP '{CURRENT}'")
def weekly_prune(spark: SparkSession, d: str) -> DataFrame:
    return w.prune_finished(t.week_snapshot(spark, d), F.lit(CURRENT).cast("timestamp_ntz"))


@query("week_snapshot", f"""SELECT week_start, snapshot_at, entity_id, value, rank FROM week_snapshot WHERE snapshot_at > TIMESTAMP '2024-01-15' AND week_start = TIMESTAMP '2024-01-15'""")
def weekly_ingest(spark: SparkSession, d: str) -> DataFrame:
    """Documents of one week against a store that ends on its Monday: only newer snapshots are new."""
    rows = t.week_snapshot(spark, d)
    monday = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    stored, batch = rows.where(F.col("snapshot_at") <= monday), rows.where(F.col("week_start") == monday)
    latest = stored.agg(F.max("snapshot_at").alias("latest")).first()[0]
    fresh = batch.where(F.col("snapshot_at") > F.lit(latest).cast("timestamp_ntz"))
    return fresh.join(stored.select("week_start", "entity_id", "snapshot_at"), ["week_start", "entity_id", "snapshot_at"], "left_anti").select(*rows.columns)


ACTIVE = ", a AS (SELECT entity_id, battle_id, side, max(damage) AS m FROM rank_entry JOIN battle b USING (battle_id) WHERE ended_at IS NULL AND b.created_at > TIMESTAMP '1997-01-06' GROUP BY 1, 2, 3), active AS (SELECT entity_id, CAST(sum(m) AS BIGINT) AS active FROM a GROUP BY 1)"


@query("rank_entry battle", ACTIVE + " SELECT * FROM active")
def active_damage(spark: SparkSession, d: str) -> DataFrame:
    after = t.battle(spark, d).where(F.col("ended_at").isNull() & (F.col("created_at") > F.lit("1997-01-06 00:00:00").cast("timestamp_ntz"))).select("battle_id")
    top = t.rank_entry(spark, d).join(after, "battle_id").groupBy("entity_id", "battle_id", "side").agg(F.max("damage").alias("m"))
    return top.groupBy("entity_id").agg(F.sum("m").alias("active"))


# Official totals over the ranked weeks: derived and active damage, of most users with a part of what straddled, at three instants (every fourth week: two), which differ for some users.
RECONCILED = CORRECTIONS + """, fixed AS (SELECT * FROM corrections WHERE user_id % 6 = 1),
crossed AS (SELECT battle_id, number AS round_number, ended_at, unnest(generate_series(CAST(date_trunc('week', created_at) AS TIMESTAMP) + INTERVAL 7 DAY, CAST(date_trunc('week', ended_at) AS TIMESTAMP), INTERVAL 7 DAY)) AS week_start FROM rounds),
straddle AS (SELECT entity_id, c.week_start, CAST(sum(damage) AS BIGINT) AS straddle FROM rank_entry JOIN crossed c USING (battle_id, round_number) WHERE c.week_start < c.ended_at AND side IN (1, 2) GROUP BY 1, 2),
derived AS (SELECT user_id AS entity_id, week_start, coalesce(base, 0) + coalesce(amount, 0) AS derived FROM base FULL JOIN fixed USING (user_id, week_start) WHERE base IS NOT NULL OR amount <> 0),
tops AS (SELECT entity_id, CAST(date_trunc('week', b.created_at) AS TIMESTAMP) AS week_start, battle_id, side, max(damage) AS m FROM rank_entry JOIN battle b USING (battle_id) WHERE b.ended_at IS NULL AND side IN (1, 2) GROUP BY 1, 2, 3, 4),
active AS (SELECT entity_id, week_start, CAST(sum(m) AS BIGINT) AS active FROM tops GROUP BY 1, 2),
official AS (
  SELECT entity_id, week_start, CAST(coalesce(derived, 0) + coalesce(active, 0) + CASE entity_id % 5 WHEN 0 THEN 0 WHEN 1 THEN straddle + 1 ELSE (straddle + 1) // 2 END AS BIGINT) AS value
  FROM straddle LEFT JOIN derived USING (entity_id, week_start) LEFT JOIN active USING (entity_id, week_start)),
snaps AS (
  SELECT week_start, week_start + to_days(CAST(i AS INTEGER)) AS snapshot_at, entity_id, value - CASE WHEN entity_id % 9 = 2 AND i = 2 OR entity_id % 9 = 4 AND i = 1 THEN 1 ELSE 0 END AS value
  FROM official, (SELECT unnest([1, 2, 3]) AS i) WHERE i > 1 OR CAST(floor(epoch(week_start) / 604800) AS BIGINT) % 4 <> 0),
placed AS (SELECT week_start, snapshot_at, row_number() OVER (PARTITION BY week_start ORDER BY snapshot_at DESC) AS p FROM (SELECT DISTINCT week_start, snapshot_at FROM snaps)),
latest AS (SELECT entity_id, week_start, max(value) FILTER (p = 1) AS v1, max(value) FILTER (p = 2) AS v2, max(value) FILTER (p = 3) AS v3, (SELECT max(p) FROM placed q WHERE q.week_start = s.week_start) AS n FROM snaps s JOIN placed USING (week_start, snapshot_at) GROUP BY ALL),
began AS (SELECT entity_id, min(b.created_at) AS began FROM rank_entry JOIN battle b USING (battle_id) WHERE b.ended_at IS NULL AND side IN (1, 2) GROUP BY 1),
posted AS (
  SELECT l.entity_id, l.week_start, v1 AS official, straddle, coalesce(derived, 0) AS derived, coalesce(active, 0) AS active, v1 - coalesce(derived, 0) - coalesce(active, 0) AS post
  FROM latest l JOIN straddle USING (entity_id, week_start) LEFT JOIN derived USING (entity_id, week_start) LEFT JOIN active USING (entity_id, week_start) LEFT JOIN began USING (entity_id)
  WHERE (n >= 3 AND v1 = v2 AND v2 = v3 OR n = 2 AND v1 = v2 OR n = 1) AND (began IS NULL OR began >= l.week_start)
    AND NOT EXISTS (SELECT 1 FROM fixed c WHERE c.user_id = l.entity_id AND c.week_start IN (l.week_start, l.week_start - INTERVAL 7 DAY))),
candidates AS (SELECT * FROM posted WHERE post > 0 AND post <= straddle)
"""


def _reconciled(spark: SparkSession, d: str, users: DataFrame | None = None) -> DataFrame:
    """Of all users, or of ``users`` (entity_id): each has every snapshot instant of its weeks, so that the instants are the same without the others."""
    some, entries = corrections(spark, d).where("user_id % 6 = 1"), t.rank_entry(spark, d)
    if users is not None:
        entries = entries.join(users, "entity_id", "left_semi")
    parts = written(w.explained(entries, t.rounds(spark, d), t.battle(spark, d), some), "explained-damage")
    part = F.when(F.col("entity_id") % 5 == 0, 0).when(F.col("entity_id") % 5 == 1, F.col("straddle") + 1).otherwise(F.floor((F.col("straddle") + 1) / 2))
    value = (F.coalesce("derived", F.lit(0)) + F.coalesce("active", F.lit(0)) + part).cast("bigint")
    weeks = F.floor(F.unix_seconds(F.col("week_start").cast("timestamp")) / 604800)
    rows = parts.select("entity_id", "week_start", value.alias("value"), F.explode(F.array(*[F.lit(i) for i in (1, 2, 3)])).alias("i")).where((F.col("i") > 1) | (weeks % 4 != 0))
    moved = F.expr("entity_id % 9 = 2 AND i = 2 OR entity_id % 9 = 4 AND i = 1").cast("bigint")
    snaps = rows.select("week_start", (F.col("week_start") + F.make_dt_interval("i")).alias("snapshot_at"), "entity_id", (F.col("value") - moved).alias("value"))
    return w.reconciled(parts, snaps, some)


@query("rounds rank_entry battle", RECONCILED + "SELECT * FROM candidates")
def reconcile_candidates(spark: SparkSession, d: str) -> DataFrame:
    """All weeks at once."""
    return _reconciled(spark, d)


NOW = "1999-06-01 00:00:00"


@query("rounds rank_entry battle account", RECONCILED + f""", due AS (
  SELECT c.*, checked_at FROM candidates c JOIN account a ON a.account_id = c.entity_id
  WHERE (last_active_at IS NULL OR last_active_at <= TIMESTAMP '{NOW}' - INTERVAL 2 HOUR) AND (checked_at IS NULL OR checked_at <= TIMESTAMP '{NOW}' - INTERVAL 30 MINUTE))
SELECT entity_id, week_start, post FROM due ORDER BY checked_at NULLS FIRST, entity_id, week_start LIMIT 100""")
def reconcile_due(spark: SparkSession, d: str) -> DataFrame:
    """The candidates that may be corrected now: quiet for two hours and not looked at within half an hour, 100 at most."""
    now = F.lit(NOW).cast("timestamp_ntz")
    a = t.account(spark, d).select(F.col("account_id").alias("entity_id"), F.col("last_active_at").alias("last_connected"), F.col("checked_at").alias("last_checked"))
    a = written(w.waiting(a, now), "waiting-accounts")  # only these are worked through
    due = w.due_for_recheck(_reconciled(spark, d, a.select("entity_id")).join(a, "entity_id"), now, tie=("entity_id", "week_start"))
    return due.select("entity_id", "week_start", "post")
