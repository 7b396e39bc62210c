"""Usage log: rollups, totals, requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerforge.operators.merge import assign_ids, merge


def rollup_daily(log: DataFrame) -> DataFrame:
    return log.groupBy(F.to_date("date_used").alias("day"), "endpoint").agg(F.count("*").alias("calls"), F.max("date_used").alias("last_used"))


def added(daily: DataFrame, totals: DataFrame, due: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(daily, totals) with the calls ``due`` added: calls add, the last use rises, and so do the requests of each day as counted among them."""
    calls = rollup_daily(due).withColumn("arrival", F.lit(0))
    days = requests_per_day(due).withColumn("arrival", F.lit(0))
    daily = merge(daily, calls, ["day", "endpoint"], {"calls": "add", "last_used": "greatest"})
    return daily, merge(totals, days, ["day"], {"calls": "add", "exact_requests": "add", "legacy_requests": "add"})


def unrolled(log: DataFrame, ledger: DataFrame) -> DataFrame:
    """The rows of the log that no fold has taken. ``ledger``: (arrival, rolled_to), of each appended batch the time before which it was rolled."""
    return log.join(ledger, "arrival", "left").where(F.col("rolled_to").isNull() | (F.col("date_used") >= F.col("rolled_to"))).select(*log.columns)


def fold(daily: DataFrame, totals: DataFrame, log: DataFrame, ledger: DataFrame, cutoff: Column) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(daily, totals, rest of the log, ledger): what of the log is before the cutoff, and was not folded before, is added to the rollups.

    The log's ``arrival`` is the number of the batch that appended a row. Late rows of a day that is already rolled come in a batch of their
    own and add to it; a repeated run over rows that were not yet deleted adds nothing, as the ledger has their batch.
    """
    daily, totals = added(daily, totals, unrolled(log, ledger).where(F.col("date_used") < cutoff))
    seen = log.select("arrival").distinct().withColumn("rolled_to", cutoff)
    ledger = ledger.unionByName(seen).groupBy("arrival").agg(F.max("rolled_to").alias("rolled_to"))
    return daily, totals, log.where(F.col("date_used") >= cutoff), ledger


def alltime(rolled: DataFrame, tail: DataFrame) -> DataFrame:
    both = rolled.select("endpoint", "calls", "last_used").unionByName(rollup_daily(tail).select("endpoint", "calls", "last_used"))
    return both.groupBy("endpoint").agg(F.sum("calls").alias("calls"), F.max("last_used").alias("last_used"))


def requests_per_day(log: DataFrame) -> DataFrame:
    """Calls; distinct request ids; and for calls of old without an id (0), distinct instants."""
    request = F.when(F.col("request_id") != 0, F.col("request_id"))
    instant = F.when(F.col("request_id") == 0, F.col("date_used"))
    return log.groupBy(F.to_date("date_used").alias("day")).agg(F.count("*").alias("calls"), F.countDistinct(request).alias("exact_requests"), F.countDistinct(instant).alias("legacy_requests"))


def totals(days: DataFrame) -> DataFrame:
    requests = F.sum(F.col("exact_requests") + F.col("legacy_requests"))
    return days.agg(F.sum("calls").alias("calls"), requests.alias("requests"), F.round(F.try_divide(F.sum("calls"), requests), 4).alias("calls_per_request"))


def append(log: DataFrame, endpoints: DataFrame, requests: DataFrame, calls: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(log, endpoints, requests) with the calls in: endpoints and request keys that are new register themselves.

    ``log``: endpoint_id, request_id, date_used. ``endpoints``: endpoint, id. ``requests``: request, id. ``calls``: endpoint, request, date_used.
    A call without a request key gets request id 0, one without an endpoint is not logged. The log takes calls as they
    come; a repeated call is a call.
    """
    calls = calls.where(F.col("endpoint").isNotNull())
    endpoints = assign_ids(endpoints, calls.select("endpoint"), "endpoint")
    requests = assign_ids(requests, calls.select("request"), "request")
    rows = calls.join(endpoints.withColumnRenamed("id", "endpoint_id"), "endpoint")
    rows = rows.join(requests.withColumnRenamed("id", "request_id"), "request", "left").withColumn("request_id", F.coalesce("request_id", F.lit(0)))
    return log.unionByName(rows.select(*log.columns)), endpoints, requests
