"""Id lists as CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerforge.functions import oid_seconds

HEX = "^[0-9a-f]{24}$"


def read(spark: SparkSession, path: str) -> DataFrame:
    """First field of each line, in lower case; a header is a malformed line like others."""
    return spark.read.csv(path, header=False).select(F.lower(F.trim("_c0")).alias("first"))


def report(lines: DataFrame) -> DataFrame:
    """Lines, malformed ones, and repeated ids, in one pass."""
    low = F.lower("first")
    good = F.coalesce(low.rlike(HEX), F.lit(False))
    return lines.agg(F.count("*").alias("lines"), F.count_if(~good).alias("malformed"), (F.count_if(good) - F.countDistinct(F.when(good, low))).alias("duplicates"))


def new_ids(lines: DataFrame, known: DataFrame) -> DataFrame:
    """Well-formed ids that are not known, with the time of creation that they hold."""
    ids = lines.select(F.lower("first").alias("external_id")).where(F.col("external_id").rlike(HEX)).distinct()
    return ids.join(known.select("external_id"), "external_id", "left_anti").withColumn("created_at", F.timestamp_seconds(oid_seconds(F.col("external_id"))).cast("timestamp_ntz"))


def export_rows(users: DataFrame) -> DataFrame:
    return users.select("id", "hex", F.coalesce("username", F.lit("")).alias("username"))


def export(users: DataFrame, path: str, files: int = 8) -> None:
    """CSV files in order of the id, each sorted, by range of the id."""
    export_rows(users).repartitionByRange(files, "id").sortWithinPartitions("id").write.csv(path, header=True, emptyValue="")
