"""Interval (range) joins and depth segments as plain DataFrame plans.

Spark plans ``a.chrom = b.chrom AND a.start <= b.end AND b.start <= a.end`` as an
equi-join on ``chrom`` with a residual predicate: a handful of huge keys.  Here
both sides are exploded to fixed-width bins and joined on ``(chrom, bin)``, so
every key is small and the work spreads over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A side is broadcast only when it has at most this many rows (checked, not assumed).
BROADCAST_MAX_ROWS = 500_000


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> bool:
    """True when ``df`` has at most ``max_rows`` rows; reads at most ``max_rows + 1`` of them."""
    return df.limit(max_rows + 1).count() <= max_rows


MIN_BIN, MAX_BIN = 64, 1 << 20


def choose_bin_size(df: DataFrame, start: str, end: str) -> int:
    """Bin width for a binned join: the 90th percentile interval length of ``df`` rounded up to a
    power of two, within [64, 2^20].  Most intervals then touch one or two bins while a bin holds
    only a few of them, so the per-bin candidate pairs stay small (one approximate-percentile job
    over the annotation-side table)."""
    p90 = df.agg(F.percentile_approx(F.col(end) - F.col(start) + 1, 0.9, 1000)).first()[0]
    if not p90 or p90 <= 0:
        return MIN_BIN
    return int(min(MAX_BIN, max(MIN_BIN, 1 << (int(p90) - 1).bit_length())))


def bins(start: str | Column, end: str | Column, bin_size: int) -> Column:
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    return F.sequence(F.floor(s / F.lit(bin_size)), F.floor(e / F.lit(bin_size)))


def overlap_join(left: DataFrame, right: DataFrame, *, left_cols: tuple[str, str, str],
                 right_cols: tuple[str, str, str], bin_size: int | None = None, how: str = "inner",
                 broadcast_right: bool | None = None, once: bool = True) -> DataFrame:
    """All pairs (l, r) on the same chrom whose closed intervals overlap.

    Column names of the two sides must be disjoint.  ``once=True`` keeps each
    pair only in its first shared bin, so no ``distinct`` is needed.  With
    ``how='left_bins'`` every (left row, bin) is kept with the overlapping right
    rows attached, or nulls: for callers that aggregate per left row.
    ``bin_size=None`` derives the width from the right side (``choose_bin_size``).
    ``broadcast_right=None`` broadcasts the right side when its row count is
    below ``BROADCAST_MAX_ROWS`` (annotation tables); otherwise the bins are
    shuffled on ``(chrom, bin)`` and AQE splits skewed bins.  That join is asked for by name: Spark's
    estimate leaves out how many rows an ``explode`` makes, and would broadcast either side by it.
    """
    lc, ls, le = left_cols
    rc, rs, re_ = right_cols
    if bin_size is None:
        bin_size = choose_bin_size(right, rs, re_)
    lb = left.withColumn("_lbin", F.explode(bins(ls, le, bin_size)))
    rb = right.withColumn("_rbin", F.explode(bins(rs, re_, bin_size)))
    if broadcast_right is None:
        broadcast_right = fits_broadcast(rb)  # the rows that would be sent: one per bin
    rb = F.broadcast(rb) if broadcast_right else rb.hint("merge")
    first_shared = F.greatest(F.floor(F.col(ls) / F.lit(bin_size)), F.floor(F.col(rs) / F.lit(bin_size)))
    cond = ((F.col(lc) == F.col(rc)) & (F.col("_lbin") == F.col("_rbin"))
            & (F.col(ls) <= F.col(re_)) & (F.col(rs) <= F.col(le)))
    if how == "inner":
        if once:
            cond = cond & (F.col("_lbin") == first_shared)
        return lb.join(rb, cond, "inner").drop("_lbin", "_rbin")
    if how == "left_bins":
        # every (left row, bin) survives; overlapping right rows are attached, others null.
        # Callers aggregate per left row, so repeated pairs across bins do not matter.
        return lb.join(rb, cond, "left").drop("_lbin", "_rbin")
    raise ValueError(f"unsupported join type {how!r}")


def depth_segments(intervals: DataFrame, *, key_cols: list[str], start: str = "start", end: str = "end",
                   tile: int = 1 << 16) -> DataFrame:
    """Constant-depth segments of a set of closed intervals.

    Returns ``key_cols + [seg_start, seg_end, depth]`` covering every position with
    depth > 0, with 1-based closed coordinates.  Every interval is cut at tile borders, so
    each tile is complete in itself: its +1/-1 events are added up per position (map-side
    combined) and summed up along the tile, without carries between tiles.  A window partition never exceeds
    ``tile`` rows however deep the coverage.  A segment that crosses a tile border is given in two parts.
    """
    lo, hi = F.col(start).cast("bigint"), F.col(end).cast("bigint")
    t = intervals.select(*key_cols, lo.alias("_lo"), hi.alias("_hi"), F.explode(
        F.sequence(F.floor(lo / F.lit(tile)), F.floor(hi / F.lit(tile)))).alias("_tile"))
    first, after = F.col("_tile") * tile, (F.col("_tile") + 1) * tile
    events = F.array(F.struct(F.greatest("_lo", first).alias("p"), F.lit(1).alias("d")),
                     F.struct(F.least(F.col("_hi") + 1, after).alias("p"), F.lit(-1).alias("d")))
    ev = t.select(*key_cols, "_tile", F.inline(events))
    ev = ev.groupBy(*key_cols, "_tile", "p").agg(F.sum("d").cast("bigint").alias("d")).where(F.col("d") != 0)
    w = Window.partitionBy(*key_cols, "_tile").orderBy("p")
    ev = ev.withColumn("depth", F.sum("d").over(w)).withColumn("_next", F.lead("p").over(w))
    return ev.where(F.col("depth") > 0).select(*key_cols, F.col("p").alias("seg_start"),
                                               (F.col("_next") - 1).alias("seg_end"), "depth")
