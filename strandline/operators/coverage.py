"""Coverage tracks: binned read counts, normalisation, windowed depth, zoom levels, compaction,
gene-body coverage.  Depth comes from +1/-1 events (``intervals.depth_segments``), never
from a per-chromosome window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions.alignment import DUPLICATE, SECONDARY, SUPPLEMENTARY, UNMAPPED, cigar_blocks, has_flag
from strandline.operators.intervals import depth_segments, overlap_join
from strandline.operators.schema import alignment_columns, annotation_columns

# Defaults of the reference configuration.
BIN_SIZE = 10
WINDOW = 25
ZOOM_LEVELS = 5
COMPACT_TILE = 1 << 16
COMPACT_WIDER = 1 << 12  # how much wider the tiles are in which runs at the edges of tiles meet
POINT_BIN = 16  # bases per bin when single bases meet depth segments


def _mapped(alignments: DataFrame, include_duplicates: bool = True) -> DataFrame:
    keep = ~has_flag("flag", UNMAPPED) & ~has_flag("flag", SECONDARY) & ~has_flag("flag", SUPPLEMENTARY)
    if not include_duplicates:
        keep = keep & ~has_flag("flag", DUPLICATE)
    return alignments.where(keep)


def read_blocks(alignments: DataFrame, include_duplicates: bool = True, extra: dict | None = None) -> DataFrame:
    """(sample, frag_id, chrom, start, end, *extra) aligned blocks of mapped primary records (1-based closed);
    ``extra`` names further expressions over the record."""
    more = [c.alias(n) for n, c in (extra or {}).items()]
    b = _mapped(alignments, include_duplicates).select(
        "sample", "frag_id", F.col("ref").alias("chrom"), *more, F.explode(cigar_blocks("pos", "cigar")).alias("_b"))
    return b.select("sample", "frag_id", "chrom", F.col("_b.start").alias("start"), F.col("_b.end").alias("end"),
                    *(extra or {}))


def binned_coverage(alignments: DataFrame, *, bin_size: int = BIN_SIZE) -> DataFrame:
    """V1: reads per bin (a read counts once in every bin one of its blocks touches); empty bins omitted.

    Bins are 0-based half-open [start0, end)."""
    def touched(b):
        return F.sequence(F.floor((b["start"] - 1) / bin_size), F.floor((b["end"] - 1) / bin_size))

    x = _mapped(alignments).select("sample", F.col("ref").alias("chrom"), cigar_blocks("pos", "cigar").alias("_b"))
    # blocks of one read may share a bin; one block never repeats one
    all_bins = F.when(F.size("_b") == 1, touched(F.col("_b")[0])).otherwise(F.array_distinct(F.flatten(F.transform("_b", touched))))
    c = x.select("sample", "chrom", F.explode(all_bins).alias("bin")).groupBy("sample", "chrom", "bin").agg(F.count(F.lit(1)).alias("count"))
    return c.select("sample", "chrom", (F.col("bin") * bin_size).alias("start0"),
                    ((F.col("bin") + 1) * bin_size).alias("end"), "count")


def normalize_coverage(bins: DataFrame, alignments: DataFrame, *, method: str | None = None,
                       effective_genome_size: int | None = None, fragment_length: int | None = None) -> DataFrame:
    """V2: scale bin counts: None (raw), RPKM, CPM, BPM or RPGC (1x depth)."""
    if method is None:
        return bins.withColumn("value", F.col("count").cast("double"))
    mapped = _mapped(alignments).groupBy("sample").agg(F.count(F.lit(1)).alias("_mapped"))
    b = bins.join(F.broadcast(mapped), "sample").withColumn("_kb", (F.col("end") - F.col("start0")) / 1000.0)
    if method == "CPM":
        v = F.col("count") / (F.col("_mapped") / 1e6)
    elif method == "RPKM":
        v = F.col("count") / (F.col("_kb") * F.col("_mapped") / 1e6)
    elif method == "BPM":
        per_kb = F.col("count") / F.col("_kb")
        tot = b.groupBy("sample").agg(F.sum(F.col("count") / F.col("_kb")).alias("_tpk"))
        b = b.join(F.broadcast(tot), "sample")
        v = per_kb / (F.col("_tpk") / 1e6)
    elif method == "RPGC":
        if not (effective_genome_size and fragment_length):
            raise ValueError("RPGC needs effective_genome_size and fragment_length")
        v = F.col("count") / (F.col("_mapped") * fragment_length / effective_genome_size)
    else:
        raise ValueError(f"unknown normalisation {method!r}")
    return b.select("sample", "chrom", "start0", "end", "count", F.round(v, 6).alias("value"))


def fragment_options(alignments: DataFrame, *, extend: int | None = None, min_fragment: int = 0,
                     max_fragment: int = 0) -> DataFrame:
    """V3: fragments of mapped records: extended to ``extend`` bases from the 5' end in read
    direction (single end), kept when the template length lies in [min, max] (0 = no bound).
    A minimum above 0 drops single-end records, which carry no template length."""
    m = _mapped(alignment_columns(alignments))
    rev = has_flag("flag", 16)
    start, end = F.col("pos").cast("bigint"), F.col("pos_end").cast("bigint")
    if extend:
        start = F.when(rev, F.col("pos_end") - extend + 1).otherwise(F.col("pos"))
        end = F.when(rev, F.col("pos_end")).otherwise(F.col("pos") + extend - 1)
    out = m.select("sample", "frag_id", F.col("ref").alias("chrom"), start.alias("frag_start"), end.alias("frag_end"),
                   (F.abs(F.col("tlen")) if "tlen" in m.columns else F.lit(None).cast("bigint")).alias("_tlen"))
    if min_fragment:
        out = out.where(F.col("_tlen") >= min_fragment)
    if max_fragment:
        out = out.where(F.col("_tlen").isNull() | (F.col("_tlen") <= max_fragment))
    return out.drop("_tlen")


def depth(alignments: DataFrame, include_duplicates: bool = True) -> DataFrame:
    """Per-sample depth segments (sample, chrom, seg_start, seg_end, depth) of aligned blocks."""
    return depth_segments(read_blocks(alignments, include_duplicates), key_cols=["sample", "chrom"])


def windowed_depth(alignments: DataFrame, *, window: int = WINDOW, include_duplicates: bool = True) -> DataFrame:
    """V4: mean (over all window bases) and max depth per ``window``-base window; empty windows omitted.

    Windows are 0-based: window w covers 1-based positions w*window+1 .. (w+1)*window."""
    seg = depth(alignments, include_duplicates)
    x = seg.select("sample", "chrom", "seg_start", "seg_end", "depth",
                   F.explode(F.sequence(F.floor((F.col("seg_start") - 1) / window),
                                        F.floor((F.col("seg_end") - 1) / window))).alias("window"))
    lo = F.greatest(F.col("seg_start"), F.col("window") * window + 1)
    hi = F.least(F.col("seg_end"), (F.col("window") + 1) * window)
    x = x.select("sample", "chrom", "window", "depth", (hi - lo + 1).alias("_n"))
    return x.groupBy("sample", "chrom", "window").agg(
        F.sum(F.col("depth") * F.col("_n")).alias("depth_sum"), F.max("depth").alias("max_depth")) \
        .select("sample", "chrom", "window", F.round(F.col("depth_sum") / window, 6).alias("mean_depth"),
                F.col("max_depth"), "depth_sum")


def zoom_levels(windows: DataFrame, *, window: int = WINDOW, levels: int = ZOOM_LEVELS) -> DataFrame:
    """V5: the same statistics at coarser levels: level l merges 2^l windows (from partial sums and maxima)."""
    lv = F.explode(F.sequence(F.lit(1), F.lit(levels))).alias("level")
    x = windows.select("sample", "chrom", "window", "depth_sum", "max_depth", lv)
    z = x.groupBy("sample", "chrom", "level", F.expr("shiftright(window, level)").alias("zoom_window")) \
        .agg(F.sum("depth_sum").alias("_s"), F.max("max_depth").alias("max_depth"))
    return z.select("sample", "chrom", "level", "zoom_window",
                    F.round(F.col("_s") / (F.lit(window) * F.expr("shiftleft(1, level)")), 6).alias("mean_depth"),
                    "max_depth")


def _merged_runs(bins: DataFrame, part: list[str]) -> DataFrame:
    """Runs of adjacent rows with equal ``_v`` within ``part``, ordered by start0: (part, start0, end, _v, _edge); ``_edge``
    marks the first and the last run of a part, which may go on in its neighbours."""
    w = Window.partitionBy(*part).orderBy("start0")
    pend = F.lag("end").over(w)
    start = ~(pend.isNotNull() & (pend == F.col("start0")) & (F.lag("_v").over(w) == F.col("_v")))
    b = bins.withColumn("_start", start).withColumn("_island", F.max(F.when(F.col("_start"), F.col("start0"))).over(
        w.rowsBetween(Window.unboundedPreceding, 0)))
    whole = Window.partitionBy(*part)  # in the same order: no further sort
    b = b.withColumn("_edge", (F.col("_island") == F.min("start0").over(whole)) | (F.col("_island") == F.max("_island").over(whole)))
    return b.groupBy(*part, "_island").agg(F.min("start0").alias("start0"), F.max("end").alias("end"), F.first("_v").alias("_v"),
                                           F.first("_edge").alias("_edge")).drop("_island")


def compact_track(bins: DataFrame, *, value: str = "count", tile: int = COMPACT_TILE) -> DataFrame:
    """V6: merge runs of adjacent bins with equal value into one bedGraph row (islands).

    Runs are found inside (sample, chrom, tile) windows.  Only the first and the last run of a tile can go on in another
    tile; these meet in tiles that are ``COMPACT_WIDER`` times as wide, and what is left at the edges of those in one
    window per (sample, chrom): two rows per wide tile.  Rows without sample, chrom or start are left out.
    """
    key = ["sample", "chrom"]
    out = ["sample", "chrom", "start0", "end", F.col("_v").alias(value)]
    at = F.col("start0")
    b = bins.where(F.col("sample").isNotNull() & F.col("chrom").isNotNull() & at.isNotNull()) \
        .select(*key, "start0", "end", F.col(value).alias("_v"))
    runs = _merged_runs(b.withColumn("_tile", F.floor(at / F.lit(tile))), [*key, "_tile"])
    wide = _merged_runs(runs.where("_edge").select(*key, "start0", "end", "_v", F.floor(at / F.lit(tile * COMPACT_WIDER)).alias("_tile")),
                        [*key, "_tile"])
    last = _merged_runs(wide.where("_edge").select(*key, "start0", "end", "_v"), key)
    return runs.where("not _edge").select(*out).unionByName(wide.where("not _edge").select(*out)).unionByName(last.select(*out))


def gene_body_coverage(alignments: DataFrame, genes: DataFrame, *, points: int = 100) -> DataFrame:
    """B2: summed depth at ``points`` evenly spaced positions of every gene body, 5' -> 3'.

    Point k of a gene of length L sits at start + floor((L - 1) * k / (points - 1)),
    counted from the 3' end for minus-strand genes.  Positions are joined to
    depth segments with the binned interval join.
    """
    genes = annotation_columns(genes)
    g = genes.select(F.col("seqid").alias("g_chrom"), "start_pos", "end_pos", "strand",
                     F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("k"))
    off = F.floor((F.col("end_pos") - F.col("start_pos")) * F.col("k") / (points - 1))
    p = g.select("g_chrom", F.when(F.col("strand") == "-", F.col("end_pos") - off)
                 .otherwise(F.col("start_pos") + off).alias("g_pos"), (F.col("k") + 1).alias("percentile"))
    return _depth_at(depth(alignments), p)


def transcript_body_coverage(alignments: DataFrame, exons: DataFrame, *, points: int = 100,
                             transcript_col: str = "gene_id") -> DataFrame:
    """B2: as ``gene_body_coverage``, but over the exonic bases of every transcript, introns left out.

    Exon i of a transcript holds the exonic offsets [before, before + length); a point's genomic position
    is found in the one exon that holds its offset.
    """
    e = annotation_columns(exons, parent_attribute="Parent").select(
        F.col("seqid").alias("g_chrom"), "start_pos", "end_pos", "strand", F.col(transcript_col).alias("_t"))
    length = F.col("end_pos") - F.col("start_pos") + 1
    order = Window.partitionBy("_t").orderBy("start_pos").rowsBetween(Window.unboundedPreceding, -1)  # exons of one transcript
    e = e.withColumn("_before", F.coalesce(F.sum(length).over(order), F.lit(0))) \
         .withColumn("_len", F.sum(length).over(Window.partitionBy("_t")))
    p = e.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("k"))
    step = F.floor((F.col("_len") - 1) * F.col("k") / (points - 1))
    off = F.when(F.col("strand") == "-", F.col("_len") - 1 - step).otherwise(step) - F.col("_before")
    p = p.withColumn("_off", off).where((F.col("_off") >= 0) & (F.col("_off") < length))
    return _depth_at(depth(alignments), p.select("g_chrom", (F.col("start_pos") + F.col("_off")).alias("g_pos"),
                                                 (F.col("k") + 1).alias("percentile")))


def _depth_at(seg: DataFrame, points: DataFrame) -> DataFrame:
    """(sample, percentile, coverage): summed depth at ``points`` (g_chrom, g_pos, percentile).

    There are ``points`` rows per gene, so they are shuffled by bin and never sent to the driver; a point is one base, so
    narrow bins leave hardly more pairs than points and samples."""
    j = overlap_join(seg, points.withColumn("g_pos2", F.col("g_pos")), left_cols=("chrom", "seg_start", "seg_end"),
                     right_cols=("g_chrom", "g_pos", "g_pos2"), bin_size=POINT_BIN, broadcast_right=False)
    return j.groupBy("sample", "percentile").agg(F.sum("depth").alias("coverage"))
