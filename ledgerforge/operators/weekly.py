"""Weekly totals, their snapshots and their reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerforge.functions import week

WEEK = "INTERVAL 7 DAYS"


def weekly_damage(entries: DataFrame, rounds: DataFrame, corrections: DataFrame) -> DataFrame:
    """(user_id, week_start, damage): damage by the Monday of the round's start, plus the signed correction.

    A week that has a correction only is kept unless the correction is 0. ``corrections``: user_id, week_start, amount; one row for
    each key. A rebuild is not clamped at zero.
    """
    starts = rounds.select("battle_id", F.col("number").alias("round_number"), week(F.col("created_at")).alias("week_start"))
    sums = entries.join(starts, ["battle_id", "round_number"]).groupBy(F.col("entity_id").alias("user_id"), "week_start").agg(F.sum("damage").alias("base"))
    both = sums.join(corrections, ["user_id", "week_start"], "full")
    return both.where(F.col("base").isNotNull() | (F.col("amount") != 0)).select("user_id", "week_start", (F.coalesce("base", F.lit(0)) + F.coalesce("amount", F.lit(0))).alias("damage"))


def signed_corrections(posts: DataFrame) -> DataFrame:
    """(user_id, week_start, post) as two rows: + in the week, - in the one before."""
    two = F.array(F.struct("week_start", F.col("post").alias("amount")), F.struct((F.col("week_start") - F.expr("INTERVAL 7 DAYS")).alias("week_start"), (-F.col("post")).alias("amount")))
    return posts.select("user_id", F.explode(two).alias("c")).select("user_id", "c.*").groupBy("user_id", "week_start").agg(F.sum("amount").alias("amount"))


def prune_finished(snapshots: DataFrame, current: Column) -> DataFrame:
    """Weeks before the current one keep each entity's last row; the current week keeps all."""
    rest = [c for c in snapshots.columns if c not in ("week_start", "entity_id", "snapshot_at")]
    old = snapshots.where(F.col("week_start") < current).groupBy("week_start", "entity_id").agg(F.max(F.struct("snapshot_at", *rest)).alias("l"))
    old = old.select("week_start", "entity_id", "l.*")
    return snapshots.where(F.col("week_start") >= current).unionByName(old)


def last_instants(snapshots: DataFrame, n: int = 3) -> DataFrame:
    """Each entity's values at the last ``n`` snapshot instants of the week, instants taken over all entities."""
    instants = snapshots.select("week_start", "snapshot_at").distinct()
    place = F.row_number().over(Window.partitionBy("week_start").orderBy(F.desc("snapshot_at")))
    recent = instants.withColumn("p", place).where(F.col("p") <= n)  # n rows for each week
    rows = snapshots.join(F.broadcast(recent), ["week_start", "snapshot_at"])
    value = lambda i: F.max(F.when(F.col("p") == i, F.col("value"))).alias(f"value_{i}")
    return rows.groupBy("week_start", "entity_id").agg(*[value(i) for i in range(1, n + 1)])


def _spans(rounds: DataFrame) -> DataFrame:
    """(battle_id, round_number, _start, _first, _last): the week that a round began in, and the first and last reset that it crosses; null if none."""
    first, last = week(F.col("created_at")) + F.expr(WEEK), week(F.col("ended_at") - F.expr("INTERVAL 1 MICROSECOND"))
    crosses = (F.col("ended_at") > F.col("created_at")) & (first <= last)
    return rounds.select("battle_id", F.col("number").alias("round_number"), week(F.col("created_at")).alias("_start"), F.when(crosses, first).alias("_first"), F.when(crosses, last).alias("_last"))


def _steps(**more: Column) -> list[Column]:
    """An entry's damage at the first reset that its round crosses, and taken back behind the last; with further columns, the same in both."""
    rest = [c.alias(name) for name, c in more.items()]
    return [
        F.struct(F.col("_first").alias("week_start"), F.col("damage").alias("damage"), F.lit(1).alias("n"), *rest),
        F.struct((F.col("_last") + F.expr(WEEK)).alias("week_start"), (-F.col("damage")).alias("damage"), F.lit(-1).alias("n"), *rest),
    ]


def _runs(sums: DataFrame, *rest: Column) -> DataFrame:
    """(entity_id, week_start, straddle, ...) of each week that something straddles: ``sums`` (entity_id, week_start, damage, n; a row for each key) are
    added up along each entity's weeks. ``rest``: columns of a row of ``sums``, which may use ``_same``: whether the week is the row's own."""
    weeks = Window.partitionBy("entity_id").orderBy("week_start")  # a row for each week
    upto = weeks.rowsBetween(Window.unboundedPreceding, 0)
    rows = sums.withColumns({"straddle": F.sum("damage").over(upto), "n": F.sum("n").over(upto), "_next": F.lead("week_start").over(weeks)})
    same = F.sequence("week_start", F.col("_next") - F.expr(WEEK), F.expr(WEEK))
    rows = rows.where("n > 0").withColumn("_week", F.explode(same)).withColumn("_same", F.col("_week") == F.col("week_start"))
    return rows.select("entity_id", F.col("_week").alias("week_start"), "straddle", *rest)


def straddlers(entries: DataFrame, rounds: DataFrame) -> DataFrame:
    """(entity_id, week_start, straddle): damage of rounds that began before a reset and ended after it, for each reset that they cross.

    An entry adds its damage at the first reset and takes it back behind the last, so it makes two rows however many weeks its round runs; sums
    by entity and week are then added up along each entity's weeks.
    """
    rows = entries.where("side in (1, 2) and damage is not null").select("battle_id", "round_number", "entity_id", "damage")
    steps = rows.join(_spans(rounds).where("_first is not null"), ["battle_id", "round_number"]).select("entity_id", F.explode(F.array(*_steps())).alias("s"))
    return _runs(steps.groupBy("entity_id", "s.week_start").agg(F.sum("s.damage").alias("damage"), F.sum("s.n").alias("n")))


def _tops(entries: DataFrame, battles: DataFrame) -> DataFrame:
    """(entity_id, week_start, m, _began) of each side of the battles that still run: the greatest damage read, and when the battle began."""
    open_ = battles.where("ended_at is null").select("battle_id", week(F.col("created_at")).alias("week_start"), F.col("created_at").alias("_began"))
    rows = entries.where("side in (1, 2)").select("battle_id", "entity_id", "side", "damage").join(open_, "battle_id")
    return rows.groupBy("entity_id", "week_start", "battle_id", "side").agg(F.max("damage").alias("m"), F.min("_began").alias("_began"))


def active_damage(entries: DataFrame, battles: DataFrame) -> DataFrame:
    """(entity_id, week_start, active, began): damage in battles that still run, by the week that they began in, and when the first of them began; of
    each side the greatest value read."""
    return _tops(entries, battles).groupBy("entity_id", "week_start").agg(F.sum("m").alias("active"), F.min("_began").alias("began"))


def explained(entries: DataFrame, rounds: DataFrame, battles: DataFrame, corrections: DataFrame) -> DataFrame:
    """(entity_id, week_start, straddle, derived, active, first) of the weeks whose reset a user's rounds cross; ``first``: when the user's oldest battle
    that still runs began.

    As ``straddlers``, ``weekly_damage`` and ``active_damage`` joined by user and week, but entries meet their rounds once, and all parts are summed
    by one aggregate over user and week.
    """
    none = {"base": "bigint", "amount": "bigint", "active": "bigint", "began": "timestamp_ntz"}
    null = lambda *names: {n: F.lit(None).cast(none[n]) for n in names}
    key, met = ["entity_id", "week_start"], entries.select("battle_id", "round_number", "entity_id", "side", "damage").join(_spans(rounds), ["battle_id", "round_number"])
    own = F.struct(F.col("_start").alias("week_start"), F.lit(0).cast("bigint").alias("damage"), F.lit(0).alias("n"), F.col("damage").alias("base"))
    crosses = F.col("_first").isNotNull() & F.col("side").isin(1, 2) & F.col("damage").isNotNull()
    steps = met.select("entity_id", F.explode(F.when(crosses, F.array(own, *_steps(**null("base")))).otherwise(F.array(own))).alias("s")).select("entity_id", "s.*").withColumns(null("amount", "active", "began"))
    zero = {"damage": F.lit(0).cast("bigint"), "n": F.lit(0)}
    fixed = corrections.where("user_id is not null").select(F.col("user_id").alias("entity_id"), "week_start", "amount").withColumns(zero | null("base", "active", "began"))
    tops = _tops(entries, battles).select(*key, F.col("m").alias("active"), F.col("_began").alias("began")).withColumns(zero | null("base", "amount"))
    sums = steps.unionByName(fixed).unionByName(tops).groupBy(*key).agg(*[F.sum(c).alias(c) for c in ("damage", "n", "base", "amount", "active")], F.min("began").alias("began"))
    sums = sums.withColumn("first", F.min("began").over(Window.partitionBy("entity_id").orderBy("week_start").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    derived = F.when(F.col("base").isNotNull() | (F.col("amount") != 0), F.coalesce("base", F.lit(0)) + F.coalesce("amount", F.lit(0)))
    return _runs(sums, F.when(F.col("_same"), derived).alias("derived"), F.when(F.col("_same"), F.col("active")).alias("active"), F.col("first"))


def reconciled(parts: DataFrame, snapshots: DataFrame, corrections: DataFrame) -> DataFrame:
    """(entity_id, week_start, official, straddle, derived, active, post) of the users and weeks that a correction would explain.

    The official total at the week's last snapshot exceeds derived and active damage by ``post``, which is at most what straddled the reset, and
    the snapshots stand still: the last three are equal, or the last two where the week has two, or it has one. Users that are corrected in the week or
    the one before, and those in a battle that began before the reset and still runs, are left out. ``parts``: as ``explained``; ``snapshots``: week_start,
    snapshot_at, entity_id, value; ``corrections``: user_id, week_start, amount.
    """
    key = ["entity_id", "week_start"]
    n = snapshots.groupBy("week_start").agg(F.countDistinct("snapshot_at").alias("instants"))  # a row for each week
    rows = last_instants(snapshots).join(F.broadcast(n), "week_start").join(parts, key)
    v1, v2, v3 = (F.col(f"value_{i}") for i in (1, 2, 3))
    still = v1.isNotNull() & F.when(F.col("instants") >= 3, (v1 == v2) & (v2 == v3)).when(F.col("instants") == 2, v1 == v2).otherwise(True)
    derived, active = F.coalesce("derived", F.lit(0)), F.coalesce("active", F.lit(0))
    rows = rows.where(still & (F.col("first").isNull() | (F.col("first") >= F.col("week_start"))))
    rows = rows.select(*key, v1.alias("official"), "straddle", derived.alias("derived"), active.alias("active"), (v1 - derived - active).alias("post")).where("post > 0 and post <= straddle")
    done = corrections.select(F.col("user_id").alias("entity_id"), F.explode(F.array("week_start", F.col("week_start") + F.expr(WEEK))).alias("week_start"))
    return rows.join(done, key, "left_anti")


def waiting(rows: DataFrame, now: Column, idle: str = "2 hours", recheck: str = "30 minutes") -> DataFrame:
    """Those that last connected ``idle`` ago or longer, or never, and were not looked at within ``recheck``. ``rows``: last_connected, last_checked."""
    quiet = F.coalesce(F.col("last_connected") <= now - F.expr(f"INTERVAL {idle}"), F.lit(True))
    waited = F.coalesce(F.col("last_checked") <= now - F.expr(f"INTERVAL {recheck}"), F.lit(True))
    return rows.where(quiet & waited)


def due_for_recheck(rows: DataFrame, now: Column, idle: str = "2 hours", recheck: str = "30 minutes", budget: int = 100, tie: tuple[str, ...] = ("entity_id",)) -> DataFrame:
    """Candidates that may be corrected now: those ``waiting``, at most ``budget`` of them, those that wait longest first. ``rows``: entity_id,
    last_connected, last_checked."""
    return waiting(rows, now, idle, recheck).orderBy(F.asc_nulls_first("last_checked"), *tie).limit(budget)


def without_open_battles(rows: DataFrame, entries: DataFrame, battles: DataFrame, reset: Column) -> DataFrame:
    """Candidates (entity_id) less those in a battle that began before the reset and still runs."""
    open_ = battles.where(F.col("ended_at").isNull() & (F.col("created_at") < reset)).select("battle_id")
    return rows.join(entries.join(open_, "battle_id", "left_semi").select("entity_id"), "entity_id", "left_anti")
