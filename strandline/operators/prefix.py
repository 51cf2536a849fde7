"""Distributed running sums (prefix offsets) without a single-partition window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_TILE = 1 << 16


def running_offset(df: DataFrame, partition_cols: list[str], order_col: str, size_col: str,
                   out_col: str, tile: int = DEFAULT_TILE) -> DataFrame:
    """Add ``out_col`` = sum of ``size_col`` over earlier rows (by ``order_col``) of the same partition.

    A plain ``Window.partitionBy(partition_cols).orderBy(order_col)`` puts every row
    of a partition in one task; with a few partitions holding most rows that is one
    task for a third of the data.  Instead rows are grouped into tiles of
    ``order_col div tile``: tile totals are aggregated (a tiny table), prefixed over
    tiles, joined back as a carry-in, and the exact offset is finished by a window
    inside each ``(partition, tile)``, which holds at most ``tile`` distinct order
    values.  ``order_col`` must be an integer that is unique within a partition.
    """
    d = df.withColumn("_tile", F.floor(F.col(order_col) / F.lit(tile)))
    totals = d.groupBy(*partition_cols, "_tile").agg(F.sum(size_col).alias("_tile_total"))
    over_tiles = Window.partitionBy(*partition_cols).orderBy("_tile").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(*partition_cols, "_tile",
                          F.coalesce(F.sum("_tile_total").over(over_tiles), F.lit(0)).alias("_carry"))
    in_tile = Window.partitionBy(*partition_cols, "_tile").orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    return (d.join(carry, [*partition_cols, "_tile"])
             .withColumn(out_col, (F.col("_carry") + F.coalesce(F.sum(size_col).over(in_tile), F.lit(0))).cast("bigint"))
             .drop("_tile", "_carry"))
