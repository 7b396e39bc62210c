"""Keyed merges of a batch into a target, with a policy for each column.

Parquet has no MERGE: a merge is a full outer join on the key. A batch may hold a key many times; it is reduced
first, in order of the explicit ``arrival`` column, as rows of a DataFrame have no order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerforge.operators.browse import numbered
from ledgerforge.session import written

#: new: the batch's value, null included; old: the first value known; coalesce: the batch's unless null; greatest: never
#: falls, null is skipped; add: sum of both.
POLICIES = ("new", "old", "coalesce", "greatest", "add")


def _reduced(batch: DataFrame, key: list[str], policies: dict[str, str], arrival: str) -> DataFrame:
    def one(c: str, policy: str) -> Column:
        if policy == "new":
            return F.max_by(F.struct(c), arrival)[c]
        if policy == "old":
            return F.min_by(F.struct(c), arrival)[c]
        if policy == "coalesce":
            return F.max_by(F.when(F.col(c).isNotNull(), F.struct(c)), F.when(F.col(c).isNotNull(), F.col(arrival)))[c]
        return F.max(c) if policy == "greatest" else F.sum(c)

    return batch.groupBy(*key).agg(*[one(c, p).alias(c) for c, p in policies.items()])


def merge(target: DataFrame, batch: DataFrame, key: list[str], policies: dict[str, str], arrival: str = "arrival") -> DataFrame:
    """The target after the batch. Keys are not null; columns without a policy are dropped."""
    if bad := set(policies.values()) - set(POLICIES):
        raise ValueError(f"no such policy: {sorted(bad)}")
    t = target.select(*key, *[F.col(c).alias(f"_t_{c}") for c in policies], F.lit(True).alias("_t"))
    n = _reduced(batch, key, policies, arrival).select(*key, *[F.col(c).alias(f"_n_{c}") for c in policies], F.lit(True).alias("_n"))

    def pick(c: str, policy: str) -> Column:
        old, new = F.col(f"_t_{c}"), F.col(f"_n_{c}")
        if policy == "new":
            return F.when(F.col("_n"), new).otherwise(old)
        if policy == "old":
            return F.when(F.col("_t"), old).otherwise(new)
        if policy == "coalesce":
            return F.coalesce(new, old)
        return F.greatest(old, new) if policy == "greatest" else F.when(old.isNull() & new.isNull(), None).otherwise(F.coalesce(old, F.lit(0)) + F.coalesce(new, F.lit(0)))

    return t.join(n, key, "full").select(*key, *[pick(c, p).alias(c) for c, p in policies.items()])


def insert_ignore(target: DataFrame, batch: DataFrame, key: list[str], arrival: str = "arrival", pruned_by: str | None = None) -> DataFrame:
    """The rows of the batch that are new: keys without null, the first arrival of each, absent from the target.

    ``pruned_by``: a key column whose range in the batch bounds what of the target is read.
    """
    rest = [c for c in batch.columns if c not in key and c != arrival]
    rows = batch.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key]))
    first = rows.groupBy(*key).agg(F.min(F.struct(arrival, *rest)).alias("_f")).select(*key, *[F.col(f"_f.{c}").alias(c) for c in rest])
    if pruned_by:
        low, high = rows.agg(F.min(pruned_by), F.max(pruned_by)).first()
        target = target.where(F.col(pruned_by).between(F.lit(low).cast(batch.schema[pruned_by].dataType), F.lit(high).cast(batch.schema[pruned_by].dataType)))
    return first.join(target.select(*key), key, "left_anti")


def assign_ids(known: DataFrame, keys: DataFrame, key: str, number: str = "id") -> DataFrame:
    """(key, number) with new keys numbered on from the greatest known number, in order of their md5 digests, which spread them evenly.

    Known numbers stay and only new keys use one up; null keys get none. New keys are numbered by ranges of the digest, so no task sees all of them.
    """
    fresh = keys.select(key).where(F.col(key).isNotNull()).distinct().join(known.select(key), key, "left_anti")
    top = known.agg(F.coalesce(F.max(number), F.lit(0))).first()[0]
    digest = F.conv(F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 12), 16, 10).cast("bigint")
    placed = numbered(fresh.withColumn("_digest", digest), ["_digest", key], number).withColumn(number, F.col(number) + F.lit(top + 1))
    return known.select(key, number).unionByName(placed.select(key, number))


def assign_many(known: DataFrame, keys: DataFrame) -> DataFrame:
    """(dim, key, id) of several dimensions at once: known keys keep their ids, new ones are numbered on within their dimension, in order of
    their md5 digests. ``keys``: dim, key; null keys get none."""
    fresh = keys.select("dim", "key").where(F.col("key").isNotNull()).distinct().join(known.select("dim", "key"), ["dim", "key"], "left_anti")
    digest = F.conv(F.substring(F.md5(F.col("key").cast("binary")), 1, 12), 16, 10).cast("bigint")
    placed = written(numbered(fresh.withColumn("_digest", digest), ["dim", "_digest", "key"], "_n"), "fresh-keys")
    first = placed.groupBy("dim").agg(F.min("_n").alias("_first")).join(known.groupBy("dim").agg(F.max("id").alias("_top")), "dim", "left")  # a row for each dimension
    placed = placed.join(F.broadcast(first), "dim")
    new = placed.select("dim", "key", (F.col("_n") - F.col("_first") + 1 + F.coalesce("_top", F.lit(0))).alias("id"))
    return known.select("dim", "key", "id").unionByName(new)


def resolved(rows: DataFrame, roles: dict[str, str], known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with an id for each role, all keys as (dim, key, id)). ``roles``: a column of text and the dimension whose keys it holds; its id is the
    column ``<role>_id``, null for a null key.

    All roles go as one long table (row, role, key): one get-or-create, one join with the keys and one aggregate back, however many roles there are.
    """
    rows = written(rows.withColumn("_row", F.monotonically_increasing_id()), "rows-to-resolve")
    each = F.array(*[F.struct(F.lit(r).alias("role"), F.lit(d).alias("dim"), F.col(r).cast("string").alias("key")) for r, d in roles.items()])
    long = rows.select("_row", F.explode(each).alias("r")).select("_row", "r.*").where("key is not null")
    ids = written(assign_many(known, long), "dimension-keys")
    found = long.join(ids, ["dim", "key"]).groupBy("_row").agg(*[F.max(F.when(F.col("role") == r, F.col("id"))).alias(f"{r}_id") for r in roles])
    return rows.join(found, "_row", "left").drop("_row"), ids


def seeded(held: DataFrame, values: list, key: str, number: str = "id") -> DataFrame:
    """A dimension with the seed values that it lacks, numbered on; a repeated seed adds nothing."""
    seeds = held.sparkSession.createDataFrame([(v,) for v in values], f"{key} {dict(held.dtypes)[key]}")
    return assign_ids(held, seeds, key, number)


def stamp_dead(users: DataFrame, gone: DataFrame, key: str, checked: str, at: Column) -> DataFrame:
    """Users that the source no longer knows and that were never checked get the time ``at``; all others stay as they are."""
    lost = gone.select(key).distinct().withColumn("_lost", F.lit(True))
    due = F.col("_lost") & F.col(checked).isNull()
    return users.join(lost, key, "left").withColumn(checked, F.when(due, at).otherwise(F.col(checked))).drop("_lost").select(*users.columns)
