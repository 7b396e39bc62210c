"""Nested documents to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Items with both an attack and a critical chance. Fixed values.
WEAPONS = ("knife", "gun", "rifle", "sniper", "tank", "jet")

TRANSACTION = (
    "_id string, createdAt timestamp, offerCreatedAt timestamp, money double, quantity double, sellerId string, buyerId string, sellerMuId string, sellerCountryId string, "
    "buyerMuId string, buyerCountryId string, sellerPartyId string, itemCode string, item struct<_id:string,code:string,skills:string,lastAcquisitionAt:timestamp>, transactionType string"
)


def result_code(inner: Column, outer: Column) -> Column:
    """The item's own code where it differs from the outer one."""
    return F.when(inner.isNotNull() & ~inner.eqNullSafe(outer), inner)


def secondary_role(fields: Column, role: str) -> Column:
    """The secondary seller or buyer in the fields (a map): the unit if its key is present, even as null, else the country."""
    return F.when(F.map_contains_key(fields, f"{role}MuId"), fields[f"{role}MuId"]).otherwise(fields[f"{role}CountryId"])


def _numbers(skills: Column) -> Column:
    """(key, value) pairs of a map whose values are numbers, shortest keys first, then by key."""
    pairs = F.map_entries(skills)
    rows = F.transform(pairs, lambda p: F.struct(F.length(p["key"]).alias("n"), p["key"].alias("key"), p["value"].try_cast("double").alias("value")))
    return F.array_sort(F.filter(rows, lambda p: p["value"].isNotNull()))


def skills(code: Column, json: Column) -> tuple[Column, Column]:
    """Primary and secondary skill: attack and critical chance of a weapon; else the first number. No skills: both null."""
    fields = F.from_json(json, "map<string,string>")
    value = lambda k: fields[k].try_cast("double")
    weapon = code.isin(*WEAPONS)
    numbers = _numbers(fields)
    first = F.when(F.size(numbers) > 0, numbers[0]["value"])
    return F.when(weapon, value("attack")).otherwise(first), F.when(weapon, value("criticalChance"))


def loot_skills(json: Column) -> tuple[Column, Column]:
    """Skills of loot: attack or else the first value in document order; critical chance of any item; 0 reads as missing."""
    values = F.map_values(F.from_json(json, "map<string,string>"))
    attack = F.nullif(F.get_json_object(json, "$.attack").try_cast("double"), F.lit(0.0))
    first = F.when(F.size(values) > 0, F.nullif(values[0].try_cast("double"), F.lit(0.0)))
    return F.coalesce(attack, first), F.nullif(F.get_json_object(json, "$.criticalChance").try_cast("double"), F.lit(0.0))


def normalised(docs: DataFrame, json: str = "doc") -> DataFrame:
    """Transaction documents as rows: fields, roles and the item's codes and skills; documents without ``_id`` fall away."""
    # Exploded, the parsed document is a row of its own, so that it is parsed once and not again for each field and filter.
    parsed = F.explode(F.array(F.from_json(json, TRANSACTION))).alias("_d")
    fields = F.explode(F.array(F.from_json(json, "map<string,string>"))).alias("_f")
    rows = docs.select("*", parsed).where("_d._id is not null").select("*", fields)
    item = F.col("_d.item.skills")  # its JSON
    result = result_code(F.col("_d.item.code"), F.col("_d.itemCode"))
    first, second = skills(F.coalesce(result, F.col("_d.itemCode")), item)
    return rows.select(
        *[c for c in docs.columns if c != json],
        F.lower("_d._id").alias("tx_id"), F.col("_d.createdAt").cast("timestamp_ntz").alias("created_at"), F.col("_d.offerCreatedAt").cast("timestamp_ntz").alias("offer_created_at"),
        F.col("_d.money").alias("money"), F.col("_d.quantity").alias("quantity"), F.col("_d.sellerId").alias("seller"), F.col("_d.buyerId").alias("buyer"), F.col("_d.sellerPartyId").alias("seller_party"),
        secondary_role(F.col("_f"), "seller").alias("seller_second"), secondary_role(F.col("_f"), "buyer").alias("buyer_second"),
        F.col("_d.itemCode").alias("item_code"), result.alias("result_code"), F.col("_d.item._id").alias("item_id"), first.alias("skill_1"), second.alias("skill_2"), F.col("_d.transactionType").alias("tx_type"),
    )


def unpivot_bounties(battles: DataFrame) -> DataFrame:
    """Two side structs become rows of the sides that have any of the four fields."""
    fields = ("money_pool", "per_1k", "effective_at", "is_national")
    side = lambda n, name: F.struct(F.lit(n).alias("side"), *[F.col(f"{name}.{f}").alias(f) for f in fields])
    rows = battles.select("battle_id", F.explode(F.array(side(1, "attacker"), side(2, "defender"))).alias("s")).select("battle_id", "s.*")
    return rows.where(F.coalesce(*[F.col(f).cast("string") for f in fields]).isNotNull())


def round_winner(won_by: Column, attacker_team: Column, attacker: Column, defender_team: Column, defender: Column) -> Column:
    """Who won: the side's team, or else its country; a value that is no side is an old country id."""
    return F.when(won_by == "attacker", F.coalesce(attacker_team, attacker)).when(won_by == "defender", F.coalesce(defender_team, defender)).otherwise(won_by)


def merge_measures(rows: DataFrame, key: list[str], measures: tuple[str, ...] = ("damage", "points", "money"), arrival: str = "arrival") -> DataFrame:
    """Rows of (key, measure, value, loot, created_at) as one row for each key: a column for each measure, the first loot
    that is not empty and the first time."""
    value = lambda m: F.max(F.when(F.col("measure") == m, F.col("value"))).alias(m)
    loot = F.min_by("loot", F.when(F.col("loot").isNotNull(), F.col(arrival))).alias("loot")
    return rows.groupBy(*key).agg(*[value(m) for m in measures], loot, F.min_by("created_at", arrival).alias("created_at"))


def wide_boards(boards: dict[str, DataFrame], key: str = "user_id") -> DataFrame:
    """Lists of (user_id, value) as one wide row for each user."""
    tagged = [b.select(key, F.lit(name).alias("board"), "value") for name, b in boards.items()]
    both = tagged[0]
    for b in tagged[1:]:
        both = both.unionByName(b)
    return both.groupBy(key).pivot("board", list(boards)).agg(F.max("value"))


def minimised(rounds: DataFrame) -> DataFrame:
    """Round documents cut to the stored fields."""
    side = lambda s: F.struct(*[F.col(f"{s}.{f}").alias(f) for f in ("country", "tournamentTeam", "damages", "hitCount", "points")]).alias(s)
    return rounds.select("_id", "battle", "number", "createdAt", "updatedAt", "endedAt", "aboutToEndNotifiedAt", "wonBy", "live", side("attacker"), side("defender"))
