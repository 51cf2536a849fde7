"""Contaminant / rRNA screen: first-n read selection and a seed-and-verify join.

A read "aligns" to the contaminant reference when, on either strand, the
whole read fits inside a reference sequence (end to end, no gaps) with at most
``seed_mismatches`` mismatches in its first ``seed_length`` bases and a sum of
base qualities over all mismatched positions of at most ``max_quality_sum``
(the short-read aligner's default ``-n 2 -l 28 -e 70`` mode).

Pigeonhole: with at most 2 mismatches in the seed, one of 3 disjoint
pieces of the seed matches exactly.  Every reference position is indexed by
its piece strings; reads are exploded to their 3 pieces and equi-joined to
the index; candidates are verified.  No candidate is dropped or capped.
Reads of 27+ bases use 9-base pieces, reads of 18-26 bases 6-base pieces;
shorter reads are reported with ``screened = false``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions.sequence import reverse_complement
from strandline.operators.align import _windows

# Aligner defaults used by the screen.
SEED_LENGTH = 28
SEED_MISMATCHES = 2
MAX_QUALITY_SUM = 70
PIECES = SEED_MISMATCHES + 1
# (piece length, shortest read that uses it)
PIECE_TIERS = [(9, 27), (6, 18)]
FIRST_READS = 100_000
BROADCAST_MAX_ROWS = 500_000  # index rows (about 80 bytes each) that may be broadcast, after counting the bases
WINDOW = 256  # least width of the reference windows of the other way


def first_reads(reads: DataFrame, n: int = FIRST_READS) -> DataFrame:
    """The first ``n`` reads of each sample in file order (``ordinal`` < n); n = -1 keeps all.

    A plain filter: no window, no shuffle, pushed down to the Parquet scan."""
    return reads if n is None or n < 0 else reads.where(F.col("ordinal") < n)


def _strands(reference: DataFrame) -> DataFrame:
    fwd = reference.select("name", F.lit("+").alias("strand"), F.upper("seq").alias("rseq"))
    rev = reference.select("name", F.lit("-").alias("strand"), reverse_complement(F.upper("seq")).alias("rseq"))
    return fwd.unionByName(rev).withColumn("rlen", F.length("rseq"))


def _index(strands: DataFrame) -> DataFrame:
    """(piece_len, piece, name, strand, pos0): every k-mer of every reference strand, for each tier's k."""
    parts = []
    for piece_len, _ in PIECE_TIERS:
        pos = F.explode(F.sequence(F.lit(0), F.col("rlen") - piece_len)).alias("pos0")
        x = strands.where(F.col("rlen") >= piece_len).select("name", "strand", "rseq", pos)
        parts.append(x.select(F.lit(piece_len).alias("piece_len"),
                              F.expr(f"substring(rseq, pos0 + 1, {piece_len})").alias("piece"), "name", "strand", "pos0"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _read_pieces(reads: DataFrame) -> DataFrame:
    """One pass over the reads: the seed pieces of the read's tier, plus one marker row (piece null)
    so every read reaches the final per-read aggregation without a second scan or join."""
    ln = F.length("seq")
    tier_len = F.lit(None).cast("int")
    for piece_len, min_len in reversed(PIECE_TIERS):
        tier_len = F.when(ln >= min_len, F.lit(piece_len)).otherwise(tier_len)
    r = reads.select("sample", "read_id", "seq", "qual", tier_len.alias("piece_len"))
    ks = F.when(F.col("piece_len").isNotNull(), F.sequence(F.lit(-1), F.lit(PIECES - 1))).otherwise(F.array(F.lit(-1)))
    x = r.select("*", F.explode(ks).alias("k"))
    piece = F.when(F.col("k") >= 0, F.expr("substring(seq, cast(k * piece_len + 1 as int), piece_len)"))
    return x.select("sample", "read_id", "seq", "qual", "piece_len", (F.col("k") * F.col("piece_len")).alias("offset"),
                    piece.alias("piece"))


def _mismatch_stats(read_seq: Column, read_qual: Column, ref_window: Column) -> Column:
    """struct(seed_mm, qsum) of a read against an equally long reference window."""
    pairs = F.arrays_zip(F.split(read_seq, "").alias("a"), F.split(ref_window, "").alias("b"),
                         F.split(read_qual, "").alias("q"))
    return F.aggregate(
        F.transform(pairs, lambda p: F.struct((p["a"] != p["b"]).alias("mm"), (F.ascii(p["q"]) - 33).alias("q"))),
        F.struct(F.lit(0).alias("i"), F.lit(0).alias("seed_mm"), F.lit(0).alias("qsum")),
        lambda acc, e: F.struct(
            (acc["i"] + 1).alias("i"),
            (acc["seed_mm"] + F.when(e["mm"] & (acc["i"] < SEED_LENGTH), 1).otherwise(0)).alias("seed_mm"),
            (acc["qsum"] + F.when(e["mm"], e["q"]).otherwise(0)).alias("qsum")))


def screen_contaminants(reads: DataFrame, reference: DataFrame) -> DataFrame:
    """(sample, read_id, screened, aligned) for every read.

    The reference index (both strands) is broadcast after a count of its rows, so reads are scanned once and never
    shuffled for the join; a larger reference is joined by piece, and its bases by (name, strand, window), so no sequence is one
    key.  Candidates get a JVM edit-distance prefilter on the seed, then the exact per-base check, and
    one map-side-combined aggregation reduces everything to a flag per read.
    """
    strands = _strands(reference)
    # every strand position is in the index once per tier
    rows = (strands.agg(F.sum("rlen")).first()[0] or 0) * len(PIECE_TIERS)
    rp = _read_pieces(reads)
    pieces = rp.where(F.col("piece").isNotNull())  # marker rows (no piece) meet nothing and stay out of the joins
    if rows <= BROADCAST_MAX_ROWS:
        j = pieces.join(F.broadcast(_index(strands)), ["piece_len", "piece"]).withColumn("start0", F.col("pos0") - F.col("offset")) \
            .join(F.broadcast(strands.select("name", "strand", "rseq", "rlen")), ["name", "strand"])
    else:
        longest = reads.agg(F.max(F.length("seq"))).first()[0] or 1
        width = max(WINDOW, 1 << (int(longest) - 1).bit_length())  # a window and the next hold any read
        j = pieces.join(_index(strands), ["piece_len", "piece"]).withColumn("_at", F.col("pos0") - F.col("offset"))
        j = j.withColumn("widx", F.floor(F.col("_at") / width)).join(_windows(strands, width), ["name", "strand", "widx"])
        # from here on positions and length are those inside the window
        j = j.withColumn("start0", F.col("_at") - F.col("wstart0")).withColumn("rlen", F.length("window")).withColumnRenamed("window", "rseq")
    fits = F.col("start0").isNotNull() & (F.col("start0") >= 0) & (F.col("start0") + F.length("seq") <= F.col("rlen"))
    # edit distance never exceeds Hamming distance: a seed with <= 2 mismatches has levenshtein <= 2
    seed_read = F.substring("seq", 1, SEED_LENGTH)
    seed_ref = F.expr(f"substring(rseq, cast(start0 + 1 as int), least(length(seq), {SEED_LENGTH}))")
    cand = fits & (F.levenshtein(seed_read, seed_ref, SEED_MISMATCHES) >= 0)
    window = F.expr("substring(rseq, cast(start0 + 1 as int), length(seq))")
    m = _mismatch_stats(F.col("seq"), F.col("qual"), window)
    hit = F.when(cand, (m["seed_mm"] <= SEED_MISMATCHES) & (m["qsum"] <= MAX_QUALITY_SUM)).otherwise(F.lit(False))
    marks = rp.where(F.col("piece").isNull()).select("sample", "read_id", F.col("piece_len").isNotNull().alias("screened"),
                                                     F.lit(False).alias("aligned"))
    hits = j.where(cand).select("sample", "read_id", F.lit(True).alias("screened"), hit.alias("aligned"))
    return marks.unionByName(hits).groupBy("sample", "read_id").agg(F.max("screened").alias("screened"),
                                                                    F.max("aligned").alias("aligned"))


def contamination_rate(screened: DataFrame) -> DataFrame:
    """C4: per sample, % of all reads that align to the contaminant reference; reads too short to be screened
    count as reads and are listed."""
    s = screened.groupBy("sample").agg(
        F.count(F.lit(1)).alias("reads"), F.count_if(F.col("aligned")).alias("aligned"),
        F.count_if(~F.col("screened")).alias("not_screened"))
    return s.withColumn("reads_aligned_percentage", F.round(F.col("aligned") * 100.0 / F.col("reads"), 6))


def rate_from_metrics(metrics: DataFrame) -> DataFrame:
    """C4 on an aligner's reported figures (sample, metric, value): ``reads_aligned_percentage`` where it is given,
    else 100 - ``not_aligned_percentage``."""
    value = lambda name: F.max(F.when(F.col("metric") == name, F.col("value")))
    r = metrics.groupBy("sample").agg(value("reads_aligned_percentage").alias("_a"), value("not_aligned_percentage").alias("_n"))
    return r.select("sample", F.coalesce(F.col("_a"), 100 - F.col("_n")).alias("reads_aligned_percentage"))


def contamination_band(rates: DataFrame, column: str = "reads_aligned_percentage") -> DataFrame:
    """Mean over samples truncated to two decimals, and its band.

    < 10 low, < 20 moderately low, < 50 relatively high, otherwise very high
    (20 itself falls in "relatively high"); no samples -> "not computed".
    """
    m = rates.agg(F.avg(column).alias("_m"))
    t = F.floor(F.col("_m") * 100) / 100
    band = (F.when(F.col("_m").isNull(), "not computed").when(t < 10, "low").when(t < 20, "moderately low")
            .when(t < 50, "relatively high").otherwise("very high"))
    return m.select(t.alias("contamination"), band.alias("band"))


def contaminant_reference(*, fasta: DataFrame | None = None, contigs: DataFrame | None = None,
                          features: DataFrame | None = None, feature_type: str | None = None) -> DataFrame:
    """(name, seq) of the contaminant reference: either the records of a ``fasta`` file, or the sequences of
    ``feature_type`` cut from ``contigs``.  Exactly one of the two is to be given; a type without features gives the
    dummy record, so that the screen always has a reference."""
    from strandline.operators.annotation import extract_sequences, features_of_type

    if (fasta is None) == (feature_type is None):
        raise ValueError("give either a FASTA table or a feature type")
    if fasta is not None:
        return fasta.select("name", "seq")
    if contigs is None or features is None:
        raise ValueError("a feature type needs contigs and features")
    return extract_sequences(contigs, features_of_type(features, feature_type))
