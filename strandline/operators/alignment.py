"""Mapping-side operators over alignment tables: summaries, read groups, ordering, duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions.alignment import (DUPLICATE, FIRST_IN_PAIR, PAIRED, PROPER_PAIR, SECOND_IN_PAIR, SECONDARY,
                                            SUPPLEMENTARY, UNMAPPED, has_flag, read_strand, unclipped_five_prime)
from strandline.operators.schema import alignment_columns

# Bisection steps for the library-size equation (interval halves each step; 2^-100 is far below 1 read).
LIBRARY_SIZE_STEPS = 100
LIBRARY_SIZE_MAX_MULTIPLE = 1.0e9


def mapping_summary(alignments: DataFrame) -> DataFrame:
    """A4: per sample, reads unmapped / mapped uniquely / mapped to multiple loci, and their shares (%).

    A read is unmapped when none of its records is mapped, unique when its
    mapped records have NH = 1 (or no NH tag), multiple otherwise.
    """
    mapped = ~has_flag("flag", UNMAPPED)
    per_read = alignment_columns(alignments).groupBy("sample", "frag_id").agg(
        F.max(F.when(mapped, F.col("nh"))).alias("_nh"))
    cat = F.when(F.col("_nh").isNull(), "unmapped").when(F.col("_nh") <= 1, "unique").otherwise("multiple")
    return _shares(per_read.select("sample", cat.alias("_c")), ["unmapped", "unique", "multiple"], "reads")


def pair_mapping_summary(alignments: DataFrame) -> DataFrame:
    """A4 (pairs): per sample, fragments aligned concordantly (both mates mapped, proper-pair bit), discordantly
    (both mapped otherwise), by one mate only, or not at all, and their shares (%)."""
    primary = alignments.where(has_flag("flag", PAIRED) & ~has_flag("flag", SECONDARY) & ~has_flag("flag", SUPPLEMENTARY))
    mapped = ~has_flag("flag", UNMAPPED)
    mates = primary.groupBy("sample", "frag_id").agg(
        F.max(F.when(mapped & has_flag("flag", FIRST_IN_PAIR), 1).otherwise(0)).alias("_m1"),
        F.max(F.when(mapped & has_flag("flag", SECOND_IN_PAIR), 1).otherwise(0)).alias("_m2"),
        F.max(F.when(mapped & has_flag("flag", PROPER_PAIR), 1).otherwise(0)).alias("_proper"))
    n = F.col("_m1") + F.col("_m2")
    cat = (F.when(n == 0, "unmapped").when(n == 1, "one_mate").when(F.col("_proper") == 1, "concordant")
           .otherwise("discordant"))
    return _shares(mates.select("sample", cat.alias("_c")), ["unmapped", "one_mate", "discordant", "concordant"], "fragments")


def _shares(rows: DataFrame, kinds: list[str], total: str) -> DataFrame:
    s = rows.groupBy("sample").agg(F.count(F.lit(1)).alias(total),
                                   *[F.count_if(F.col("_c") == k).alias(k) for k in kinds])
    return s.select("sample", total, *kinds,
                    *[F.round(F.col(k) * 100.0 / F.col(total), 6).alias(f"pct_{k}") for k in kinds])


def add_read_group(alignments: DataFrame, *, sample_col: str = "sample") -> DataFrame:
    """A5: tag every record with its read group (ID = SM = sample)."""
    tag = F.create_map(F.lit("RG"), F.col(sample_col))
    tags = F.map_concat(F.col("tags"), tag) if "tags" in alignments.columns else tag
    return alignments.withColumn("tags", tags)


def sort_by_coordinate(alignments: DataFrame, *, num_partitions: int | None = None) -> DataFrame:
    """Coordinate order (ref, pos, ties by fragment and flag) by Spark's global sort: sampled ranges, as many
    partitions as the session's shuffles have unless ``num_partitions`` is given."""
    order = ["ref", "pos", "frag_id", "flag"]
    if num_partitions:
        return alignments.repartitionByRange(num_partitions, *order).sortWithinPartitions(*order)
    return alignments.orderBy(*order)


def mark_duplicates(alignments: DataFrame, *, remove: bool = False, quality_col: str = "base_quality_sum") -> DataFrame:
    """Flag PCR duplicates.

    Single-end records are grouped by (sample, ref, unclipped 5' end, strand); the one with
    the highest base-quality sum (ties: smallest fragment id) is kept, all others
    get the duplicate bit.  Paired records are judged as fragments: by the ends of both mates, or of
    the one mate that is mapped, and both mates get the bit.  The best of each group comes from an
    aggregation (map-side combined, so a hot group costs one row per task), joined back on the
    group key (AQE splits a skewed key).  Unmapped, secondary and supplementary records are never duplicates
    and take no part in the joins.
    """
    a = alignment_columns(alignments)
    eligible = ~has_flag("flag", UNMAPPED) & ~has_flag("flag", SECONDARY) & ~has_flag("flag", SUPPLEMENTARY)
    ends = a.withColumn("_five", unclipped_five_prime("pos", "cigar", "flag")).withColumn("_strand", read_strand("flag"))
    single = _mark_records(ends.where(eligible & ~has_flag("flag", PAIRED)), quality_col)
    paired = _mark_fragments(ends.where(eligible & has_flag("flag", PAIRED)), quality_col)
    rest = a.where(~eligible).withColumn("duplicate", F.lit(False))
    out = single.unionByName(paired).unionByName(rest).withColumn(
        "flag", F.when(F.col("duplicate"), F.col("flag").bitwiseOR(F.lit(DUPLICATE))).otherwise(F.col("flag")))
    return out.where(~F.col("duplicate")) if remove else out


def _mark_records(a: DataFrame, quality_col: str) -> DataFrame:
    key = ["sample", "ref", "_five", "_strand"]
    rank_key = F.struct(-F.col(quality_col), F.col("frag_id"))
    best = a.groupBy(*key).agg(F.min(rank_key).alias("_best"))
    j = a.join(best, key).withColumn("_cand", rank_key == F.col("_best"))
    # rows identical on (group, quality, fragment): keep exactly one of them
    w = Window.partitionBy(*key, "frag_id", "_cand").orderBy("pos", "flag", "cigar")
    keep = F.col("_cand") & (F.row_number().over(w) == 1)
    return j.withColumn("duplicate", ~keep).drop("_five", "_strand", "_best", "_cand")


def _mark_fragments(a: DataFrame, quality_col: str) -> DataFrame:
    # ends are told by 64-bit hashes: smallest, largest and number settle two of them, the sums what repeated ids add;
    # all are numbers, so fragments come from a hash aggregation without sorting records
    h, part = F.xxhash64("ref", "_five", "_strand"), F.lit(1 << 31)
    frags = a.withColumn("_h", h).groupBy("sample", "frag_id").agg(
        F.min("_h").alias("_h1"), F.max("_h").alias("_h2"), F.count(F.lit(1)).alias("_n"),
        F.sum(F.pmod("_h", part)).alias("_s1"), F.sum(F.pmod(F.xxhash64("_h"), part)).alias("_s2"), F.sum(quality_col).alias("_q"))
    ends = ["sample", "_h1", "_h2", "_n", "_s1", "_s2"]
    rank_key = F.struct(-F.col("_q"), F.col("frag_id"))
    best = frags.groupBy(*ends).agg(F.min(rank_key).alias("_best"))
    lost = frags.join(best, ends).where(rank_key != F.col("_best")).select(
        "sample", "frag_id", F.lit(True).alias("_dup"))
    return (a.join(lost, ["sample", "frag_id"], "left")
            .withColumn("duplicate", F.coalesce("_dup", F.lit(False))).drop("_five", "_strand", "_dup"))


def _library_size(n: str, c: str):
    """Lander-Waterman: solve c / x = 1 - exp(-n / x) for x by bisection in m = x / c (JVM-side)."""
    f = lambda m: f"({c} / ({m} * {c}) - 1 + exp(-{n} / ({m} * {c})))"
    return F.expr(f"""
      case when {c} > 0 and {n} > {c} then cast(round({c} * aggregate(sequence(1, {LIBRARY_SIZE_STEPS}),
        named_struct('lo', cast(1.0 as double), 'hi', cast({LIBRARY_SIZE_MAX_MULTIPLE} as double)),
        (acc, i) -> if({f('((acc.lo + acc.hi) / 2)')} > 0,
                       named_struct('lo', (acc.lo + acc.hi) / 2, 'hi', acc.hi),
                       named_struct('lo', acc.lo, 'hi', (acc.lo + acc.hi) / 2)),
        acc -> (acc.lo + acc.hi) / 2)) as bigint) end""")


def duplication_metrics(marked: DataFrame) -> DataFrame:
    """Per sample, mapped records examined, duplicates, fraction duplicated and estimated library size."""
    eligible = ~has_flag("flag", UNMAPPED) & ~has_flag("flag", SECONDARY) & ~has_flag("flag", SUPPLEMENTARY)
    s = marked.where(eligible).groupBy("sample").agg(
        F.count(F.lit(1)).alias("examined"), F.count_if(has_flag("flag", DUPLICATE)).alias("duplicates"))
    return s.select("sample", "examined", "duplicates",
                    F.round(F.col("duplicates") / F.col("examined"), 6).alias("percent_duplication"),
                    _library_size("examined", "(examined - duplicates)").alias("estimated_library_size"))
