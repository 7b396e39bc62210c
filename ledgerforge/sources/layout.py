"""Time-partitioned, clustered tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerforge.functions import week
from ledgerforge.operators.browse import in_pieces
from ledgerforge.session import written

#: Table: unit of its partitions, segment and order columns inside a file. Fixed by how the tables are read.
LAYOUTS = {
    "transactions": ("day", ["tx_type", "item_code"], ["created_at", "tx_id"]),
    "round_ranking": ("week", ["battle_id", "side"], ["entity_id", "created_at"]),
    "battle_ranking": ("week", ["battle_id", "side"], ["entity_id", "created_at"]),
    "snapshots": ("week", ["entity_type", "entity_id"], ["snapshot_at"]),
}


def partition_column(unit: str, time: str):
    return F.to_date(time) if unit == "day" else F.to_date(week(F.col(time)))


def write(rows: DataFrame, path: str, table: str, time: str = "created_at", rows_a_file: int = 1 << 20, mode: str = "overwrite", piece: int = 1 << 18) -> None:
    """Partitions that the rows touch are replaced; inside files, row groups hold ranges of the segment columns.

    The rows of a day are ranked by segment and order, by range pieces, and dealt to as many files as it needs of about ``rows_a_file``, of equal size, so
    neither a busy day nor a busy segment is one task. A file is one task's.
    """
    unit, segment, order = LAYOUTS[table]
    keys = [c for c in (*segment, *order) if c in rows.columns]
    held = in_pieces(rows.withColumn(unit, partition_column(unit, time)), [unit, *keys], piece)
    sizes = held.groupBy(F.col(unit).alias("_u"), F.col("_piece").alias("_p")).agg(F.count("*").alias("n"), F.min("_at").alias("low"))
    in_unit = Window.partitionBy("_u")
    before = F.coalesce(F.sum("n").over(in_unit.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = written(sizes.select("_u", "_p", (before - F.col("low")).alias("_shift"), F.sum("n").over(in_unit).alias("_total")), "unit-sizes")
    units = sizes.groupBy("_u").agg(F.max("_total").alias("_t")).withColumn("_files", F.ceil(F.col("_t") / rows_a_file))  # a row for each day or week
    first = F.sum("_files").over(Window.orderBy(F.asc_nulls_first("_u")).rowsBetween(Window.unboundedPreceding, -1))
    units = written(units.select(F.col("_u").alias("_v"), "_files", F.coalesce(first, F.lit(0)).alias("_first")), "unit-files")
    files = units.agg(F.sum("_files")).first()[0] or 1
    placed = held.join(sizes, F.col(unit).eqNullSafe(F.col("_u")) & (F.col("_piece") == F.col("_p"))).join(F.broadcast(units), F.col(unit).eqNullSafe(F.col("_v")))
    number = F.col("_first") + F.floor((F.col("_at") + F.col("_shift")) * F.col("_files") / F.col("_total"))
    dealt = placed.withColumn("_file", number.cast("int")).repartitionById(int(files), F.col("_file")).sortWithinPartitions(unit, *keys)
    dealt.select(*rows.columns, unit).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(unit).parquet(path)


def with_bounds(table: DataFrame, unit: str, low, high, time: str = "created_at") -> DataFrame:
    """Rows in [low, high), with the bound on the partition column that lets the scan skip files."""
    a, b = F.lit(low).cast("timestamp_ntz"), F.lit(high).cast("timestamp_ntz")
    first = F.to_date(a) if unit == "day" else F.to_date(week(a))
    return table.where((F.col(unit) >= first) & (F.col(unit) <= F.to_date(b)) & (F.col(time) >= a) & (F.col(time) < b))
