"""The usage log and its rollups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerforge import fixtures as t
from ledgerforge.operators import usage as u
from ledgerforge.plans.registry import query

FIRST_CUTOFF, CUTOFF = "2024-01-10 00:00:00", "2024-01-16 00:00:00"
PARTS = f", tail AS (SELECT * FROM usage_log WHERE date_used >= TIMESTAMP '{CUTOFF}'), old AS (SELECT * FROM usage_log WHERE date_used < TIMESTAMP '{CUTOFF}')"


def _parts(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    log, cut = t.usage_log(spark, d), F.lit(CUTOFF).cast("timestamp_ntz")
    return log.where(F.col("date_used") >= cut), log.where(F.col("date_used") < cut)


@query("usage_log", "SELECT endpoint, count(*) AS calls, max(date_used) AS last_used FROM usage_log GROUP BY 1")
def usage_alltime(spark: SparkSession, d: str) -> DataFrame:
    """Rolled days and the raw tail together give what the whole log would."""
    tail, old = _parts(spark, d)
    return u.alltime(u.rollup_daily(old), tail)


@query("usage_log", "SELECT endpoint, count(*) AS calls FROM usage_log WHERE date_used > (SELECT max(date_used) FROM usage_log) - INTERVAL 24 HOUR GROUP BY 1")
def usage_last24h(spark: SparkSession, d: str) -> DataFrame:
    log = t.usage_log(spark, d)
    now = F.lit(log.agg(F.max("date_used")).first()[0]).cast("timestamp_ntz")
    return log.where(F.col("date_used") > now - F.expr("INTERVAL 24 HOURS")).groupBy("endpoint").agg(F.count("*").alias("calls"))


REQUESTS = "SELECT CAST(date_used AS DATE) AS day, count(*) AS calls, count(DISTINCT CASE WHEN request_id <> 0 THEN request_id END) AS exact_requests, count(DISTINCT CASE WHEN request_id = 0 THEN date_used END) AS legacy_requests FROM usage_log GROUP BY 1"


@query("usage_log", REQUESTS)
def usage_requests_per_day(spark: SparkSession, d: str) -> DataFrame:
    return u.requests_per_day(t.usage_log(spark, d))


# Rows that came a batch late, some of them after their day was rolled.
_LATE = "request_id % 7 = 3"
FOLDED = f""", arrived AS (SELECT *, CASE WHEN {_LATE} THEN 2 ELSE 1 END AS arrival FROM usage_log),
folded AS (SELECT *, CASE WHEN arrival = 1 AND date_used < TIMESTAMP '{FIRST_CUTOFF}' THEN 1 ELSE 2 END AS fold FROM arrived WHERE date_used < TIMESTAMP '{CUTOFF}'),
days AS (
  SELECT fold, CAST(date_used AS DATE) AS day, count(*) AS calls, count(DISTINCT CASE WHEN request_id <> 0 THEN request_id END) AS exact_requests,
         count(DISTINCT CASE WHEN request_id = 0 THEN date_used END) AS legacy_requests
  FROM folded GROUP BY 1, 2),
rolled AS (SELECT day, CAST(sum(calls) AS BIGINT) AS calls, CAST(sum(exact_requests) AS BIGINT) AS exact_requests, CAST(sum(legacy_requests) AS BIGINT) AS legacy_requests FROM days GROUP BY 1)
"""


def _folded(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(daily, totals, rest of the log) after a fold, late rows of days that it rolled, a second fold, and a repetition of that."""
    log = t.usage_log(spark, d).withColumn("arrival", F.when(F.expr(_LATE), 2).otherwise(1))
    at = lambda x: F.lit(x).cast("timestamp_ntz")
    none = log.limit(0)
    ledger = none.select("arrival", F.col("date_used").alias("rolled_to"))
    daily, totals, rest, ledger = u.fold(u.rollup_daily(none), u.requests_per_day(none), log.where("arrival = 1"), ledger, at(FIRST_CUTOFF))
    every = rest.unionByName(log.where("arrival = 2"))
    daily, totals, rest, ledger = u.fold(daily, totals, every, ledger, at(CUTOFF))
    daily, totals, _, _ = u.fold(daily, totals, every, ledger, at(CUTOFF))  # the rows were not deleted yet
    return daily, totals, rest


@query("usage_log", FOLDED + f", every AS (SELECT * FROM rolled UNION ALL SELECT * FROM ({REQUESTS.replace(' GROUP BY', f" WHERE date_used >= TIMESTAMP '{CUTOFF}' GROUP BY")})) SELECT CAST(sum(calls) AS BIGINT) AS calls, CAST(sum(exact_requests + legacy_requests) AS BIGINT) AS requests, round(sum(calls) / sum(exact_requests + legacy_requests), 4) AS calls_per_request FROM every")
def usage_totals(spark: SparkSession, d: str) -> DataFrame:
    """Rolled days, as each fold counted their requests, and the raw tail."""
    _, totals, rest = _folded(spark, d)
    return u.totals(totals.unionByName(u.requests_per_day(rest)))


@query("usage_log", FOLDED + "SELECT CAST(date_used AS DATE) AS day, endpoint, count(*) AS calls, max(date_used) AS last_used FROM folded GROUP BY 1, 2")
def usage_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Late rows of a rolled day add, a repeated fold adds nothing."""
    return _folded(spark, d)[0]


@query("usage_log", FOLDED + "SELECT * FROM rolled")
def usage_rollup_totals(spark: SparkSession, d: str) -> DataFrame:
    return _folded(spark, d)[1]
