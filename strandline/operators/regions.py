"""Set algebra on intervals (1-based, closed): union, difference, introns.

Intervals are cut at tiles of fixed width, so that no contig is ever sorted in one task: a tile has at most one
row per position, and only pieces that touch a tile's edge meet the neighbouring tiles (at most two per tile).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.operators.schema import annotation_columns

TILE = 1 << 16


def _tiled(df: DataFrame, group: list[str], start: str, end: str, tile: int) -> DataFrame:
    """(group, _t, _s, _e): the intervals cut at tile boundaries; empty ones (end before start) are left out."""
    t = df.where(F.col(end) >= F.col(start)).select(
        *group, F.col(start).cast("bigint").alias("_s0"), F.col(end).cast("bigint").alias("_e0"),
        F.explode(F.sequence(F.floor(F.col(start) / tile), F.floor(F.col(end) / tile))).alias("_t"))
    return t.select(*group, "_t", F.greatest("_s0", F.col("_t") * tile).alias("_s"),
                    F.least("_e0", F.col("_t") * tile + (tile - 1)).alias("_e"))


def _merged(df: DataFrame, keys: list[str]) -> DataFrame:
    """Overlapping or adjacent (_s, _e) of each key as one."""
    w = Window.partitionBy(*keys).orderBy("_s")
    before = F.max("_e").over(w.rowsBetween(Window.unboundedPreceding, -1))
    islands = df.withColumn("_new", (before.isNull() | (F.col("_s") > before + 1)).cast("int")) \
        .withColumn("_i", F.sum("_new").over(w))
    return islands.groupBy(*keys, "_i").agg(F.min("_s").alias("_s"), F.max("_e").alias("_e")).drop("_i")


def interval_union(df: DataFrame, *, group: list[str], start: str = "start_pos", end: str = "end_pos", tile: int = TILE) -> DataFrame:
    """The positions that ``df`` covers in each group, as disjoint intervals that do not touch."""
    pieces = _tiled(df, group, start, end, tile).groupBy(*group, "_t", "_s").agg(F.max("_e").alias("_e"))
    own = _merged(pieces, [*group, "_t"])
    edge = (F.col("_s") == F.col("_t") * tile) | (F.col("_e") == F.col("_t") * tile + (tile - 1))
    across = _merged(own.where(edge).drop("_t"), group)
    return own.where(~edge).drop("_t").unionByName(across).select(*group, F.col("_s").alias(start), F.col("_e").alias(end))


def interval_difference(a: DataFrame, b: DataFrame, *, group: list[str], start: str = "start_pos", end: str = "end_pos",
                        tile: int = TILE) -> DataFrame:
    """The positions that ``a`` covers and ``b`` does not, per group, as disjoint intervals that do not touch."""
    def events(df: DataFrame, column: str) -> DataFrame:
        d = _tiled(interval_union(df, group=group, start=start, end=end, tile=tile), group, start, end, tile)
        d = d.select(*group, "_t", F.inline(F.array(F.struct(F.col("_s").alias("_p"), F.lit(1).alias("_d")),
                                                    F.struct((F.col("_e") + 1).alias("_p"), F.lit(-1).alias("_d")))))
        return d.select(*group, "_t", "_p", *[(F.col("_d") if c == column else F.lit(0)).alias(c) for c in ("_a", "_b")])

    at = events(a, "_a").unionByName(events(b, "_b")).groupBy(*group, "_t", "_p").agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    w = Window.partitionBy(*group, "_t").orderBy("_p")
    run = at.select(*group, F.col("_p").alias(start), (F.lead("_p").over(w) - 1).alias(end),
                    F.sum("_a").over(w).alias("_in"), F.sum("_b").over(w).alias("_out"))
    left = run.where((F.col("_in") > 0) & (F.col("_out") == 0) & F.col(end).isNotNull())
    return interval_union(left, group=group, start=start, end=end, tile=tile)


def transcript_exons(exons: DataFrame) -> DataFrame:
    """(chrom, transcript, start_pos, end_pos): the transcript is the column ``transcript_id``, else the attribute
    ``transcript_id`` or each name in ``Parent``, else the gene."""
    e = annotation_columns(exons, parent_attribute="Parent")
    names: list[Column] = []
    if "transcript_id" in e.columns:
        names.append(F.col("transcript_id"))
    if "attributes" in e.columns:
        names += [F.col("attributes")["transcript_id"], F.col("attributes")["Parent"]]
    if "gene_id" in e.columns:
        names.append(F.col("gene_id"))
    return e.select(F.col("seqid").alias("chrom"), F.explode(F.split(F.coalesce(*names), ",")).alias("transcript"), "start_pos", "end_pos")


def introns(exons: DataFrame) -> DataFrame:
    """(chrom, transcript, intron_start, intron_end): the gaps between the merged exons of each transcript."""
    e = transcript_exons(exons)
    w = Window.partitionBy("chrom", "transcript").orderBy("start_pos", "end_pos")  # the exons of one transcript
    reached = F.max("end_pos").over(w.rowsBetween(Window.unboundedPreceding, -1))
    gap = e.withColumn("_r", reached).where(F.col("start_pos") > F.col("_r") + 1)
    return gap.select("chrom", "transcript", (F.col("_r") + 1).alias("intron_start"), (F.col("start_pos") - 1).alias("intron_end"))


def gene_introns(exons: DataFrame) -> DataFrame:
    """(seqid, gene_id, start_pos, end_pos): the positions of each gene's span that no exon of the gene covers."""
    e = annotation_columns(exons, parent_attribute="Parent").select("seqid", "gene_id", "start_pos", "end_pos")
    span = e.groupBy("seqid", "gene_id").agg(F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos"))
    return interval_difference(span, e, group=["seqid", "gene_id"])


def intergenic_regions(features: DataFrame, lengths: DataFrame) -> DataFrame:
    """(seqid, start_pos, end_pos): the positions of each contig (``lengths``: seqid, length) outside all features."""
    whole = lengths.select("seqid", F.lit(1).cast("bigint").alias("start_pos"), F.col("length").cast("bigint").alias("end_pos"))
    return interval_difference(whole, annotation_columns(features).select("seqid", "start_pos", "end_pos"), group=["seqid"])
