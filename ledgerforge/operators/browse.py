"""Filters, search, sorting, paging and ordinals."""

from __future__ import annotations

import math
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerforge.session import written


def parse_date(text: str) -> datetime:
    """ISO date or datetime (naive: UTC), DD-MM-YY, or Unix milliseconds."""
    text = text.strip()
    if text.lstrip("-").isdigit() and len(text) > 8:
        return datetime.fromtimestamp(int(text) / 1000, timezone.utc)
    for layout in ("%d-%m-%y",):
        try:
            return datetime.strptime(text, layout).replace(tzinfo=timezone.utc)
        except ValueError:
            pass
    found = datetime.fromisoformat(text)
    return found if found.tzinfo else found.replace(tzinfo=timezone.utc)


def time_range(as_of: datetime, hours: int = 24, start: datetime | None = None, end: datetime | None = None) -> tuple[datetime, datetime | None, bool]:
    """(from, to, whether from itself is out): a given range wins over the hours back (1 to 8784); a reversed one is swapped."""
    if start or end:
        if start and end and end < start:
            start, end = end, start
        return start or datetime(1970, 1, 1), end, False
    return as_of - timedelta(hours=min(max(hours, 1), 8784)), None, True


def browse(tx: DataFrame, as_of: datetime, tx_type: str | None = None, item_code: str | None = None, user: int | None = None, hours: int = 24, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """Transactions of a type, an item code and a user (as seller or buyer), in a range of time; all are optional."""
    low, high, strict = time_range(as_of, hours, start, end)
    at = F.col("created_at")
    low_value, high_value = F.lit(low).cast("timestamp_ntz"), F.lit(high).cast("timestamp_ntz")
    out = tx.where(at > low_value if strict else at >= low_value)
    if high is not None:
        out = out.where(at < high_value)
    if tx_type is not None:
        out = out.where(F.col("tx_type") == tx_type)
    if item_code is not None:
        out = out.where(F.col("item_code") == item_code)
    if user is not None:
        out = out.where((F.col("seller_id") == user) | (F.col("buyer_id") == user))
    return out


def keyset_page(rows: DataFrame, time: str, key: str, cursor: tuple[object, object] | None = None, forward: bool = False, size: int = 100) -> DataFrame:
    """The page before (older than) a cursor, newest first, or after it, oldest first.

    The order is (time, key), so no row of a tie is lost; the plain bound on the time alone lets scans skip.
    """
    t, k = F.col(time), F.col(key)
    if cursor is not None:
        at, last = F.lit(cursor[0]), F.lit(cursor[1])
        if str(rows.schema[time].dataType) == "TimestampNTZType()":
            at = at.cast("timestamp_ntz")
        rows = rows.where((t >= at) & ((t > at) | (k > last)) if forward else (t <= at) & ((t < at) | (k < last)))
    order = [t.asc(), k.asc()] if forward else [t.desc(), k.desc()]
    return rows.orderBy(*order).limit(size)


def offset_page(rows: DataFrame, order: list[Column], page: int, size: int = 100) -> DataFrame:
    """A shallow page, from 1."""
    return rows.orderBy(*order).offset((page - 1) * size).limit(size)


def page_count(n: int, size: int = 100) -> int:
    return max(1, math.ceil(n / size))


def contains(column: str, text: str) -> Column:
    """Substring search whatever the case; wildcards are plain characters."""
    return F.lower(column).contains(text.lower())


def in_pieces(rows: DataFrame, order: list[str], piece: int = 1 << 18, pieces: int | None = None) -> DataFrame:
    """The rows in sorted range partitions of about ``piece`` rows (or ``pieces`` of them) in the shared folder, with ``_piece``, the
    partition's number, and ``_at``, which rises over all rows. Rows that tie in the whole order share a piece."""
    if pieces is None:
        rows = written(rows, "unsorted")  # so that counting, sampling and sorting run their plan once
        pieces = 1 + rows.count() // piece
    held = rows.repartitionByRange(pieces, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    return written(held, "pieces").withColumn("_piece", F.shiftright("_at", 33))  # ids hold the partition's number above bit 33


def numbered(rows: DataFrame, order: list[str], name: str = "ordinal", buckets: int | None = None) -> DataFrame:
    """Row numbers from 0 over the whole order, without one task that sees all rows.

    Rows are sorted by range partitions, whose number follows the row count unless ``buckets`` gives it; a row's number is its
    place in the partition and the sizes of those before, one row for each partition.
    """
    held = in_pieces(rows, order, pieces=buckets)
    sizes = held.groupBy(F.col("_piece").alias("_p")).agg(F.count("*").alias("n"), F.min("_at").alias("low"))
    before = F.sum("n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))
    shift = sizes.select("_p", (F.coalesce(before, F.lit(0)) - F.col("low")).alias("_shift"))
    out = held.join(shift, F.col("_piece") == F.col("_p"))
    return out.withColumn(name, (F.col("_at") + F.col("_shift")).cast("bigint")).drop("_at", "_piece", "_p", "_shift")


def summed_before(rows: DataFrame, key: str, order: str, value: str, name: str = "before", piece: int = 1 << 18) -> DataFrame:
    """The sum of ``value`` over the rows of the same ``key`` that come before in ``order``, by range pieces, so that no key is one task."""
    held = in_pieces(rows, [key, order], piece)
    inside = F.sum(value).over(Window.partitionBy("_piece", key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    sums = held.groupBy(F.col(key).alias("_k"), F.col("_piece").alias("_p")).agg(F.sum(value).alias("_n"))
    first = F.sum("_n").over(Window.partitionBy("_k").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select("_k", "_p", F.coalesce(first, F.lit(0)).alias("_first"))
    both = held.withColumn("_i", inside).join(sums, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_piece") == F.col("_p")))
    return both.withColumn(name, F.coalesce("_i", F.lit(0)) + F.col("_first")).select(*rows.columns, name)


def carried(held: DataFrame, keys: list[str], values: dict[str, tuple[str, str]], upto: int = -1) -> DataFrame:
    """Rows of ``in_pieces`` with running sums, minima or maxima over the rows of the same keys before them (``upto`` 0: and their own), by pieces, so that no key is
    one task. ``values``: name of the result, (sum, min or max, column); null where there is no such row."""
    of = {"sum": F.sum, "min": F.min, "max": F.max}
    both_of = {"sum": lambda a, b: F.coalesce(a + b, a, b), "min": F.least, "max": F.greatest}
    inside = Window.partitionBy("_piece", *keys).orderBy("_at").rowsBetween(Window.unboundedPreceding, upto)
    before = Window.partitionBy(*[f"_k_{k}" for k in keys]).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    ends = held.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_piece").alias("_p")).agg(*[of[f](c).alias(f"_n_{name}") for name, (f, c) in values.items()])
    ends = ends.select(*[f"_k_{k}" for k in keys], "_p", *[of[f](f"_n_{name}").over(before).alias(f"_b_{name}") for name, (f, _) in values.items()])
    same = F.col("_piece") == F.col("_p")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    rows = held.select("*", *[of[f](c).over(inside).alias(f"_i_{name}") for name, (f, c) in values.items()]).join(ends, same)
    return rows.select(*held.columns, *[both_of[f](F.col(f"_i_{name}"), F.col(f"_b_{name}")).alias(name) for name, (f, _) in values.items()])


def random_sample(rows: DataFrame, key: str, n: int, seed: str = "") -> DataFrame:
    """``n`` rows at random: those with the least digests of key and seed, so that reruns agree and any row is as likely as another.
    Null keys are keys like others."""
    return rows.orderBy(F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(seed)).cast("binary")), key).limit(n)


def top_per_group(rows: DataFrame, group: list[str], order: list[Column], n: int) -> DataFrame:
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("_r") <= n).drop("_r")


def latest(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """The last row of each group, by a partial aggregate."""
    rest = [c for c in rows.columns if c not in group]
    best = F.max(F.struct(*order, *[c for c in rest if c not in order])).alias("_l")
    return rows.groupBy(*group).agg(best).select(*group, *[F.col(f"_l.{c}").alias(c) for c in rest])
