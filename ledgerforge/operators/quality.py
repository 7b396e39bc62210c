"""Consistency checks between levels of ranking rows, and what must be fetched again."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = ["battle_id", "round_number", "entity_type", "entity_id"]


def sums_equal(rounds: DataFrame, battles: DataFrame) -> DataFrame:
    """Pairs of round sums and battle rows, and those that differ."""
    key = ["battle_id", "side", "entity_type", "entity_id"]
    sums = rounds.groupBy(*key).agg(F.sum("damage").alias("r"))
    both = battles.join(sums, key)
    return both.agg(F.count_if(F.col("damage") != F.col("r")).alias("diff"), F.count("*").alias("pairs")).select(F.lit("rounds = battle").alias("label"), "diff", "pairs")


def orphans(entries: DataFrame, key: list[str] = KEY) -> DataFrame:  # noqa: B006
    """Keys of merged rows (side 3) that no side has."""
    return entries.where("side = 3").select(*key).distinct().join(entries.where("side < 3").select(*key), key, "left_anti")


def duplicates(entries: DataFrame, key: list[str] = KEY) -> DataFrame:  # noqa: B006
    return entries.where("side = 3").groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def exceptions(entries: DataFrame, key: list[str] = KEY) -> DataFrame:  # noqa: B006
    """Merged rows that are kept beside rows of a side with the same key."""
    return entries.where("side = 3").join(entries.where("side < 3").select(*key), key, "left_semi")


def leftovers(entries: DataFrame, measures: list[str], key: list[str] = KEY) -> DataFrame:  # noqa: B006
    """(key) of those whose merged rows equal the sums of their sides in all measures, null being equal to null."""
    total = lambda side, mark: entries.where(side).groupBy(*key).agg(*[F.sum(m).alias(f"{mark}_{m}") for m in measures])
    same = reduce(lambda x, y: x & y, [F.col(f"m_{m}").eqNullSafe(F.col(f"s_{m}")) for m in measures])
    return total("side = 3", "m").join(total("side < 3", "s"), key).where(same).select(*key)


def merged_counts(entries: DataFrame, measures: list[str], key: list[str] = KEY) -> DataFrame:  # noqa: B006
    """One row: how many keys are ``orphans``, ``duplicates`` and ``leftovers``, how many rows are ``exceptions`` (as in the functions of these names), and
    ``merged`` rows; by one aggregate over the keys."""
    merged, side = F.col("side") == 3, F.col("side") < 3
    sums = [F.sum(F.when(x, F.col(m))).alias(f"{mark}_{m}") for m in measures for mark, x in (("m", merged), ("s", side))]
    by_key = entries.groupBy(*key).agg(F.count_if(merged).alias("m"), F.count_if(side).alias("s"), *sums).where("m > 0")
    met = reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in key]) & (F.col("s") > 0)  # null keys meet none
    same = reduce(lambda x, y: x & y, [F.col(f"m_{m}").eqNullSafe(F.col(f"s_{m}")) for m in measures])
    exceptions = F.coalesce(F.sum(F.when(met, F.col("m"))), F.lit(0))
    return by_key.agg(F.count_if(~met).alias("orphans"), F.count_if(F.col("m") > 1).alias("duplicates"), F.count_if(met & same).alias("leftovers"), exceptions.alias("exceptions"), F.coalesce(F.sum("m"), F.lit(0)).alias("merged"))


def key_violations(rows: DataFrame, key: list[str], parents: dict[str, tuple[DataFrame, str]] | None = None) -> DataFrame:
    """(check, rows) of the constraints of a table: repeated keys, null keys and, for each column of ``parents``, values without a parent row."""
    absent = reduce(lambda x, y: x | y, [F.col(k).isNull() for k in key])
    repeated = rows.where(~absent).groupBy(*key).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("rows"))
    parts = [repeated.select(F.lit("repeated key").alias("check"), "rows"), rows.agg(F.count_if(absent).alias("rows")).select(F.lit("null key").alias("check"), "rows")]
    for column, (parent, name) in (parents or {}).items():
        lost = rows.where(F.col(column).isNotNull()).join(parent.select(F.col(name).alias(column)), column, "left_anti")
        parts.append(lost.agg(F.count("*").alias("rows")).select(F.lit(f"{column} without parent").alias("check"), "rows"))
    return reduce(DataFrame.unionByName, parts)


def last_round_missing(rounds: DataFrame, entries: DataFrame) -> DataFrame:
    """Battles whose last round with damage has no ranking row."""
    last = rounds.where("attacker_damages + defender_damages > 0").groupBy("battle_id").agg(F.max("number").alias("number"))
    return last.join(entries.select("battle_id", F.col("round_number").alias("number")), ["battle_id", "number"], "left_anti")


def verified(battles: DataFrame, rounds: DataFrame, entries: DataFrame, as_of: Column) -> DataFrame:
    """Battles that ended over 5 minutes ago and whose every round with damage has ranking rows."""
    due = rounds.where("attacker_damages + defender_damages > 0").select("battle_id", "number")
    missing = due.join(entries.select("battle_id", F.col("round_number").alias("number")), ["battle_id", "number"], "left_anti")
    return battles.where(F.col("ended_at") < as_of - F.expr("INTERVAL 5 MINUTES")).select("battle_id").join(missing, "battle_id", "left_anti")


def needs_fetch(battles: DataFrame, entries: DataFrame, done: DataFrame, as_of: Column) -> DataFrame:
    """Ended battles, not done, that have no row, ended within 5 minutes, or whose newest row is over a minute older than the end."""
    newest = entries.groupBy("battle_id").agg(F.max("created_at").alias("newest"))
    rows = battles.where("ended_at is not null").join(done, "battle_id", "left_anti").join(newest, "battle_id", "left")
    due = F.col("newest").isNull() | (F.col("ended_at") > as_of - F.expr("INTERVAL 5 MINUTES")) | (F.col("newest") < F.col("ended_at") - F.expr("INTERVAL 1 MINUTE"))
    return rows.where(due).select("battle_id", "ended_at")


def cleaned(entries: DataFrame, battles: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Without partial rows: those of battles that ended in the last days and were read over 2 minutes before the end; sides
    first, then merged rows, then merged rows that equal the sums of the sides that are left."""
    rows = entries.join(battles, "battle_id")
    stale = (F.col("ended_at") > as_of - F.make_dt_interval(F.lit(days))) & (F.col("created_at") < F.col("ended_at") - F.expr("INTERVAL 2 MINUTES"))
    kept = rows.where(~F.coalesce(stale, F.lit(False)))
    sums = kept.where("side < 3").groupBy(*KEY).agg(F.sum("damage").alias("side_sum"))
    joined = kept.join(sums, KEY, "left")
    return joined.where(~((F.col("side") == 3) & F.col("side_sum").eqNullSafe(F.col("damage")))).drop("side_sum", "ended_at")
