"""Differential-expression operators: the relational shell around the per-gene model.

Counts stay long ``(sample, gene_id, count)``.  Per-sample statistics are
aggregations; per-gene statistics group by gene (a gene has one row per
sample, so groups are small); pairwise sample statistics build one array per
gene and reduce pair terms with map-side-combined aggregation, never a
self-join.  Multiple-testing correction uses tiles over the p-value scale so
no contrast is ranked inside one task.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows the count tool writes that are not features.
SPECIAL_ROWS = ["alignment_not_unique", "ambiguous", "no_feature", "not_aligned", "too_low_aQual"]
ALPHA = 0.05
FDR_THRESHOLDS = [0.001, 0.005, 0.01, 0.05, 0.1, 0.2]
P_TILES_PER_OCTAVE = 64


def load_count_matrix(counts: DataFrame, samples: list[str], *, remove: list[str] = SPECIAL_ROWS) -> DataFrame:
    """Long counts of the listed samples with special rows dropped and absent features as 0.

    The zero fill is a pivot over the explicit sample list followed by an
    unpivot — the genes x samples grid is the result itself, built without a cross join.
    A sample that is not listed raises.
    """
    known = F.when(F.col("sample").isin(samples), F.col("sample")).otherwise(
        F.raise_error(F.concat(F.lit("sample outside the list: "), F.coalesce(F.col("sample"), F.lit("null")))))
    c = counts.where(~F.col("gene_id").isin(remove)).withColumn("sample", known)
    wide = c.groupBy("gene_id").pivot("sample", samples).agg(F.sum("n"))
    wide = wide.select("gene_id", *[F.coalesce(F.col(s), F.lit(0)).cast("bigint").alias(s) for s in samples])
    return wide.unpivot("gene_id", samples, "sample", "count")


def check_sample_order(counts: DataFrame, design: DataFrame, samples: list[str]) -> DataFrame:
    """The matrix's sample order (``samples``) against the design's label order, position by position."""
    spark = counts.sparkSession
    have = spark.createDataFrame([(i, s) for i, s in enumerate(samples)], "position int, count_sample string")
    have = have.join(counts.select(F.col("sample").alias("count_sample")).distinct(), "count_sample", "left_semi")
    w = Window.orderBy("_o")  # the design is a handful of rows
    want = design.select(F.col("label").alias("target_sample"), F.monotonically_increasing_id().alias("_o")) \
        .select((F.row_number().over(w) - 1).alias("position"), "target_sample")
    j = have.join(want, "position", "full")
    return j.select("position", "count_sample", "target_sample",
                    F.coalesce(F.col("count_sample") == F.col("target_sample"), F.lit(False)).alias("ok"))


def check_ids(counts: DataFrame, info: DataFrame) -> DataFrame:
    """D3: ids present on one side only: (gene_id, missing_from)."""
    c = counts.select("gene_id").distinct()
    i = info.select("gene_id").distinct()
    return c.join(i, "gene_id", "left_anti").withColumn("missing_from", F.lit("info")).unionByName(
        i.join(c, "gene_id", "left_anti").withColumn("missing_from", F.lit("counts")))


def library_sizes(counts: DataFrame) -> DataFrame:
    """Total count per sample."""
    return counts.groupBy("sample").agg(F.sum("count").cast("bigint").alias("library_size"))


def null_features(counts: DataFrame) -> DataFrame:
    """Zero-count features per sample, and (sample = null) features that are zero everywhere."""
    per = counts.groupBy("sample").agg(F.count_if(F.col("count") == 0).alias("null_features"))
    allz = counts.groupBy("gene_id").agg(F.max("count").alias("_m")).agg(
        F.count_if(F.col("_m") == 0).alias("null_features")).select(F.lit(None).cast("string").alias("sample"),
                                                                     "null_features")
    return per.unionByName(allz)


def count_density(counts: DataFrame, *, width: float = 0.5) -> DataFrame:
    """Per sample, histogram of log2(count + 1) on a fixed grid of ``width``."""
    b = F.floor(F.log2(F.col("count") + 1) / width)
    return counts.groupBy("sample", b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("features")) \
        .withColumn("bin_start", F.col("bin") * width)


def majority_sequences(counts: DataFrame) -> DataFrame:
    """Per sample the feature with the largest count (ties: smallest id) and its share of the library (%)."""
    key = F.struct((-F.col("count")).alias("neg"), F.col("gene_id").alias("gene_id"))
    top = counts.groupBy("sample").agg(F.min(key).alias("_t"), F.sum("count").alias("_lib"))
    return top.select("sample", F.col("_t.gene_id").alias("gene_id"), (-F.col("_t.neg")).alias("count"),
                      F.round(-F.col("_t.neg") * 100.0 / F.col("_lib"), 6).alias("percentage"))


def gene_vectors(counts: DataFrame, samples: list[str], value: str = "count") -> DataFrame:
    """(gene_id, v): one array per gene, element i = value of ``samples[i]`` (0 when absent)."""
    wide = counts.groupBy("gene_id").pivot("sample", samples).agg(F.first(value))
    return wide.select("gene_id", F.array(*[F.coalesce(F.col(s).cast("double"), F.lit(0.0)) for s in samples])
                       .alias("v"))


def _pair_terms(vec: DataFrame, samples: list[str], fields: Callable[[Column, Column], list[Column]]) -> DataFrame:
    """(sample_a, sample_b, *fields(i, j)) for every gene and sample pair i < j.  The pairs come from two nested
    array functions over positions, so the plan does not grow with the number of samples."""
    last = len(samples) - 1
    if last < 1:
        raise ValueError("pairs need two samples")
    pairs = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(last - 1)), lambda i: F.transform(
        F.sequence(i + 1, F.lit(last)), lambda j: F.struct(i.alias("_i"), j.alias("_j"), *fields(i, j)))))
    names = F.array(*[F.lit(s) for s in samples])
    x = vec.select(F.explode(pairs).alias("_p")).select("_p.*")
    return x.withColumn("sample_a", names[F.col("_i")]).withColumn("sample_b", names[F.col("_j")]).drop("_i", "_j")


def pairwise_sere(counts: DataFrame, samples: list[str]) -> DataFrame:
    """SERE for every sample pair: sqrt(sum_g sum_s (o - e)^2 / e / G'), e = library share of the
    gene's pair total, G' = genes with a non-zero pair total.

    Pair terms come from each gene's count array and are summed by a
    partial aggregation: per-gene work is S^2, nothing is shuffled per pair
    beyond the final (pair, sums) rows of each task.
    """
    vec = gene_vectors(counts, samples)
    # one-row table of library sizes, attached by a broadcast equi-join on a constant key
    lib = vec.agg(F.array(*[F.sum(F.col("v")[i]) for i in range(len(samples))]).alias("_lib")).withColumn("_one", F.lit(1))
    v = vec.withColumn("_one", F.lit(1)).join(F.broadcast(lib), "_one")

    def fields(i, j):
        oi, oj, li, lj = F.col("v")[i], F.col("v")[j], F.col("_lib")[i], F.col("_lib")[j]
        tot = oi + oj
        ei, ej = li * tot / (li + lj), lj * tot / (li + lj)
        chi = F.when(tot > 0, (oi - ei) ** 2 / ei + (oj - ej) ** 2 / ej)
        return [chi.alias("chi"), F.when(tot > 0, 1).otherwise(0).alias("nz")]

    x = _pair_terms(v, samples, fields)
    s = x.groupBy("sample_a", "sample_b").agg(F.sum("chi").alias("_chi"), F.sum("nz").alias("_g"))
    return s.select("sample_a", "sample_b", F.round(F.sqrt(F.col("_chi") / F.col("_g")), 6).alias("sere"))


def overall_sere(counts: DataFrame, samples: list[str]) -> DataFrame:
    """One SERE over all samples: sqrt(sum_g sum_s (o - e)^2 / e / ((S - 1) G'))."""
    lib = library_sizes(counts).withColumnRenamed("library_size", "_lib")
    total = counts.agg(F.sum("count").cast("double").alias("_all")).withColumn("_one", F.lit(1))
    genes = counts.groupBy("gene_id").agg(F.sum("count").cast("double").alias("_g")).where(F.col("_g") > 0)
    x = counts.join(F.broadcast(lib), "sample").join(genes, "gene_id").withColumn("_one", F.lit(1)) \
        .join(F.broadcast(total), "_one")
    e = F.col("_g") * F.col("_lib") / F.col("_all")
    per = x.groupBy("gene_id").agg(F.sum((F.col("count") - e) ** 2 / e).alias("_chi"))
    return per.agg(F.count(F.lit(1)).alias("genes"), F.round(F.sqrt(
        F.sum("_chi") / (F.count(F.lit(1)) * (len(samples) - 1))), 6).alias("sere"))


def pairwise_points(counts: DataFrame, samples: list[str], *, width: float = 0.5) -> DataFrame:
    """For every sample pair, a 2-D histogram of (log2(a + 1), log2(b + 1)) over genes."""
    vec = gene_vectors(counts, samples)
    x = _pair_terms(vec, samples, lambda i, j: [
        F.floor(F.log2(F.col("v")[i] + 1) / width).cast("int").alias("bin_a"),
        F.floor(F.log2(F.col("v")[j] + 1) / width).cast("int").alias("bin_b")])
    return x.groupBy("sample_a", "sample_b", "bin_a", "bin_b").agg(F.count(F.lit(1)).alias("genes"))


def design_matrix(design: DataFrame, *, factors: list[str], reference: dict[str, str] | None = None,
                  levels: dict[str, list[str]] | None = None, interaction: bool = False) -> DataFrame:
    """Treatment-coded model matrix, long (label, coefficient, value).

    ``~ f1 + f2 [+ f1:f2]``; the reference level of each factor comes first
    (explicit, or the smallest level).  Levels are passed in or read from the
    (small) design table.
    """
    reference = reference or {}
    if levels is None:
        levels = {f: sorted(r[0] for r in design.select(f).distinct().collect()) for f in factors}
    cols = [F.struct(F.lit("Intercept").alias("coefficient"), F.lit(1.0).alias("value"))]
    dummies = {}
    for f in factors:
        ref = reference.get(f, levels[f][0])
        for lv in levels[f]:
            if lv == ref:
                continue
            name = f"{f}{lv}"
            dummies.setdefault(f, []).append((name, F.when(F.col(f) == lv, 1.0).otherwise(0.0)))
            cols.append(F.struct(F.lit(name).alias("coefficient"), dummies[f][-1][1].alias("value")))
    if interaction and len(factors) == 2:
        for n1, c1 in dummies.get(factors[0], []):
            for n2, c2 in dummies.get(factors[1], []):
                cols.append(F.struct(F.lit(f"{n1}:{n2}").alias("coefficient"), (c1 * c2).alias("value")))
    return design.select("label", F.explode(F.array(*cols)).alias("_c")).select("label", "_c.coefficient", "_c.value")


def log_ratios(counts: DataFrame, n_samples: int) -> DataFrame:
    """(sample, gene_id, _r): log of the count over the gene's geometric mean; genes with a zero anywhere are skipped."""
    lgm = counts.groupBy("gene_id").agg(F.avg(F.log("count")).alias("_lgm"), F.min("count").alias("_min"),
                                         F.count(F.lit(1)).alias("_n"))
    lgm = lgm.where((F.col("_min") > 0) & (F.col("_n") == n_samples)).select("gene_id", "_lgm")
    return counts.join(lgm, "gene_id").select("sample", "gene_id", (F.log("count") - F.col("_lgm")).alias("_r"))


def size_factors(counts: DataFrame, n_samples: int, *, location: str = "median") -> DataFrame:
    """Size factor per sample from the log ratios to the geometric means: their ``median``, or their ``shorth``
    (mean of the shortest run of half of them, the first of equally short ones)."""
    r = log_ratios(counts, n_samples)
    if location == "median":
        return r.groupBy("sample").agg(F.exp(F.percentile("_r", 0.5)).alias("size_factor"))
    if location != "shorth":
        raise ValueError("location must be 'median' or 'shorth'")
    # one row per gene and sample; a sample's window holds its genes
    w = Window.partitionBy("sample").orderBy("_r", "gene_id")
    n = F.count(F.lit(1)).over(Window.partitionBy("sample"))
    r = r.select("sample", "_r", F.row_number().over(w).alias("_i"), n.alias("_n"))
    r = r.withColumn("_h", F.greatest(F.lit(1), F.round(F.col("_n") / 2)).cast("int"))
    ends = r.select("sample", (F.col("_i") - F.col("_h")).alias("_i"), F.col("_r").alias("_end"))
    runs = r.join(ends, ["sample", "_i"]).groupBy("sample").agg(
        F.min(F.struct((F.col("_end") - F.col("_r")).alias("w"), F.col("_i").alias("i"))).alias("_s"))
    inside = r.join(F.broadcast(runs), "sample").where(
        (F.col("_i") >= F.col("_s.i")) & (F.col("_i") < F.col("_s.i") + F.col("_h")))
    return inside.groupBy("sample").agg(F.exp(F.avg("_r")).alias("size_factor"))


def ratio_histogram(counts: DataFrame, n_samples: int, *, width: float = 0.25, shift: float = 0.0) -> DataFrame:
    """Per sample, histogram of log2(count / geometric mean) in bins of ``width``."""
    b = F.floor((F.col("_r") / F.log(F.lit(2.0)) + shift) / width).cast("int")
    return log_ratios(counts, n_samples).groupBy("sample", b.alias("bin")).agg(F.count(F.lit(1)).alias("genes"))


def size_factor_diag(counts: DataFrame, factors: DataFrame) -> DataFrame:
    """Size factor against library size per sample."""
    lib = library_sizes(counts)
    return factors.join(lib, "sample").select(
        "sample", F.round("size_factor", 6).alias("size_factor"), "library_size",
        F.round(F.col("library_size") / F.col("size_factor"), 6).alias("library_per_factor"))


def normalized_counts(counts: DataFrame, factors: DataFrame) -> DataFrame:
    """Count / size factor, and baseMean = mean over samples per gene."""
    n = counts.join(F.broadcast(factors), "sample").withColumn("normalized", F.col("count") / F.col("size_factor"))
    w = Window.partitionBy("gene_id")
    return n.select("sample", "gene_id", "count", "normalized", F.avg("normalized").over(w).alias("base_mean"))


def box_stats(values: DataFrame, column: str) -> DataFrame:
    """Min, quartiles and max of log2(x + 1) per sample (exact percentiles)."""
    x = F.log2(F.col(column) + 1)
    p = F.percentile(x, F.array(*[F.lit(v) for v in (0.0, 0.25, 0.5, 0.75, 1.0)]))
    r = values.groupBy("sample").agg(p.alias("_p"))
    names = ["min", "q1", "median", "q3", "max"]
    return r.select("sample", *[F.round(F.col("_p")[i], 6).alias(n) for i, n in enumerate(names)])


def sample_distances(values: DataFrame, samples: list[str], column: str) -> DataFrame:
    """Euclidean distance between samples over genes of ``column`` (e.g. log2 normalised counts)."""
    vec = gene_vectors(values, samples, column)
    x = _pair_terms(vec, samples, lambda i, j: [((F.col("v")[i] - F.col("v")[j]) ** 2).alias("d2")])
    return x.groupBy("sample_a", "sample_b").agg(F.round(F.sqrt(F.sum("d2")), 6).alias("distance"))


def contrasts(levels: list[str], *, reference: str, all_pairs: bool = True) -> list[tuple[str, str]]:
    """(test, ref) level pairs: every pair (i < j) when ``all_pairs``, else each level vs the reference."""
    if not all_pairs:
        return [(lv, reference) for lv in levels if lv != reference]
    ordered = [reference] + [lv for lv in levels if lv != reference]
    return [(ordered[j], ordered[i]) for i in range(len(ordered)) for j in range(i + 1, len(ordered))]


def _harmonic(m: Column) -> Column:
    """1 + 1/2 + ... + 1/m: summed up to 10,000 terms, beyond that by its expansion (error below 1e-18)."""
    x = m.cast("double")
    total = F.aggregate(F.sequence(F.lit(1), F.least(m, F.lit(10_000)).cast("int")), F.lit(0.0), lambda a, i: a + 1.0 / i)
    return F.when(m <= 10_000, total).otherwise(F.log(x) + 0.5772156649015329 + 1 / (2 * x) - 1 / (12 * x * x))


def _p_tile(p: Column) -> Column:
    # octave-scaled tiles of the p-value: small p -> large tile, p = 0 -> its own last tile
    return F.when(p <= 0, F.lit(1 << 20)).otherwise(F.floor(-F.log2(p) * P_TILES_PER_OCTAVE)).cast("bigint")


def adjust_p(results: DataFrame, *, method: str = "BH", group: str = "contrast", p: str = "pvalue") -> DataFrame:
    """Benjamini-Hochberg (or -Yekutieli) adjusted p-values per ``group``; null p stays null.

    padj(p) = min(1, c(m) * min_{p' >= p} m p' / rank(p')), rank = number of
    p-values <= p'.  Ties collapse first (one row per distinct p-value); ranks
    and the suffix minimum are computed per octave tile with a carry over tiles,
    so no group is ever sorted in a single task.
    """
    if method not in ("BH", "BY"):
        raise ValueError("method must be BH or BY")
    d = results.where(F.col(p).isNotNull()).groupBy(group, p).agg(F.count(F.lit(1)).alias("_k")) \
        .withColumn("_tile", _p_tile(F.col(p)))
    # ascending p == descending tile; rank = rows with smaller-or-equal p
    tt = d.groupBy(group, "_tile").agg(F.sum("_k").alias("_tk"))
    wt = Window.partitionBy(group).orderBy(F.desc("_tile")).rowsBetween(Window.unboundedPreceding, -1)
    carry = tt.select(group, "_tile", F.coalesce(F.sum("_tk").over(wt), F.lit(0)).alias("_carry"),
                      F.sum("_tk").over(Window.partitionBy(group)).alias("_m"))
    if method == "BY":  # one factor per group, before it meets the p-values
        factor = tt.groupBy(group).agg(_harmonic(F.sum("_tk")).alias("_cm"))
        carry = carry.join(factor, group)
    wi = Window.partitionBy(group, "_tile").orderBy(p).rowsBetween(Window.unboundedPreceding, 0)
    d = d.join(carry, [group, "_tile"]).withColumn("_rank", F.col("_carry") + F.sum("_k").over(wi))
    d = d.withColumn("_v", F.col("_m") * F.col(p) / F.col("_rank"))
    # suffix minimum over ascending p: inside the tile, then across later (larger-p) tiles
    # (a running minimum from the largest p down: a frame with an open end is worked out anew for every row)
    ws = Window.partitionBy(group, "_tile").orderBy(F.desc(p)).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("_smin", F.min("_v").over(ws))
    tmin = d.groupBy(group, "_tile").agg(F.min("_v").alias("_tmin"))
    wl = Window.partitionBy(group).orderBy("_tile").rowsBetween(Window.unboundedPreceding, -1)
    later = tmin.select(group, "_tile", F.min("_tmin").over(wl).alias("_later"))
    d = d.join(later, [group, "_tile"])
    adj = F.least(F.col("_smin"), F.coalesce(F.col("_later"), F.col("_smin")))
    if method == "BY":
        adj = adj * F.col("_cm")
    d = d.select(group, p, F.least(F.lit(1.0), adj).alias("padj"))
    return results.join(d, [group, p], "left")


def export_tables(results: DataFrame, *, alpha: float = ALPHA) -> DataFrame:
    """Every gene with a direction: up / down when padj <= alpha, else none."""
    sig = F.col("padj") <= alpha
    return results.withColumn("direction", F.when(sig & (F.col("log2fc") > 0), "up")
                              .when(sig & (F.col("log2fc") < 0), "down").otherwise("none"))


def n_diff_total(exported: DataFrame) -> DataFrame:
    """Up, down and total DE genes per contrast."""
    return exported.groupBy("contrast").agg(F.count_if(F.col("direction") == "up").alias("up"),
                                            F.count_if(F.col("direction") == "down").alias("down"),
                                            F.count_if(F.col("direction") != "none").alias("total"))


def n_diff_by_threshold(results: DataFrame, thresholds: list[float] = FDR_THRESHOLDS) -> DataFrame:
    """Number of genes with padj <= t for each FDR threshold t (cumulative over a small bin table)."""
    b = F.lit(None).cast("int")
    for i, t in reversed(list(enumerate(thresholds))):
        b = F.when(F.col("padj") <= t, F.lit(i)).otherwise(b)
    h = results.where(F.col("padj") <= max(thresholds)).groupBy("contrast", b.alias("_b")).agg(
        F.count(F.lit(1)).alias("_n"))
    grid = results.select("contrast").distinct().select(
        "contrast", F.explode(F.array(*[F.struct(F.lit(i).alias("_b"), F.lit(t).alias("threshold"))
                                        for i, t in enumerate(thresholds)])).alias("_g")).select("contrast", "_g.*")
    g = grid.join(h, ["contrast", "_b"], "left")
    w = Window.partitionBy("contrast").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    return g.select("contrast", "threshold", F.sum(F.coalesce(F.col("_n"), F.lit(0))).over(w).alias("genes"))


def length_normalized(normalized: DataFrame, lengths: DataFrame) -> DataFrame:
    """Normalised count per kilobase of gene length."""
    return normalized.join(lengths, "gene_id").select(
        "sample", "gene_id", F.round(F.col("normalized") * 1000.0 / F.col("length"), 6).alias("per_kb"))


def gene_length_effect(results: DataFrame, lengths: DataFrame) -> DataFrame:
    """Per contrast and log2-length bin: genes, DE genes, mean log2 baseMean."""
    j = results.join(lengths, "gene_id")
    return j.groupBy("contrast", F.floor(F.log2("length")).cast("int").alias("log2_length_bin")).agg(
        F.count(F.lit(1)).alias("genes"), F.count_if(F.col("padj") <= ALPHA).alias("de_genes"),
        F.round(F.avg(F.log2(F.col("base_mean") + 1)), 6).alias("mean_log2_base_mean"))


def logfc_distribution(results: DataFrame, *, width: float = 0.5) -> DataFrame:
    """Histogram of log2 fold changes per contrast."""
    return results.groupBy("contrast", F.floor(F.col("log2fc") / width).cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("genes")).withColumn("bin_start", F.col("bin") * width)


def pvalue_histogram(results: DataFrame, *, bins: int = 20) -> DataFrame:
    """Histogram of raw p-values in ``bins`` equal bins of [0, 1] (p = 1 in the last)."""
    b = F.least(F.floor(F.col("pvalue") * bins), F.lit(bins - 1)).cast("int")
    return results.where(F.col("pvalue").isNotNull()).groupBy("contrast", b.alias("bin")).agg(
        F.count(F.lit(1)).alias("genes"))


def ma_points(results: DataFrame, *, alpha: float = ALPHA) -> DataFrame:
    """(log10 baseMean, log2FC, significant)."""
    return results.select("contrast", "gene_id", F.round(F.log10(F.col("base_mean") + 1), 6).alias("log10_base_mean"),
                          "log2fc", F.coalesce(F.col("padj") <= alpha, F.lit(False)).alias("significant"))


def volcano_points(results: DataFrame, *, alpha: float = ALPHA) -> DataFrame:
    """(log2FC, -log10 padj, significant)."""
    return results.select("contrast", "gene_id", "log2fc", F.round(-F.log10("padj"), 6).alias("neg_log10_padj"),
                          F.coalesce(F.col("padj") <= alpha, F.lit(False)).alias("significant"))


def venn_counts(exported: DataFrame) -> DataFrame:
    """Genes by the exact set of contrasts in which they are DE."""
    s = exported.where(F.col("direction") != "none").groupBy("gene_id").agg(
        F.array_join(F.sort_array(F.collect_set("contrast")), "&").alias("contrasts"))
    return s.groupBy("contrasts").agg(F.count(F.lit(1)).alias("genes"))


def heatmap_matrix(values: DataFrame, genes: DataFrame, column: str) -> DataFrame:
    """Row-centred values of the selected genes (value minus the gene's mean over samples)."""
    x = values.join(genes.select("gene_id").distinct(), "gene_id", "left_semi")
    w = Window.partitionBy("gene_id")
    return x.select("gene_id", "sample", F.round(F.col(column) - F.avg(column).over(w), 6).alias("centred"))


def expression_profile(normalized: DataFrame, design: DataFrame, genes: DataFrame) -> DataFrame:
    """log2(normalised + 1) of chosen genes with the sample's condition."""
    x = normalized.join(genes.select("gene_id").distinct(), "gene_id", "left_semi")
    return x.join(F.broadcast(design.select(F.col("label").alias("sample"), "cond")), "sample").select(
        "gene_id", "sample", "cond", F.round(F.log2(F.col("normalized") + 1), 6).alias("log2_normalized"))


def slim_results(results: DataFrame) -> DataFrame:
    """Id, baseMean, log2FoldChange, padj."""
    return results.select("contrast", "gene_id", "base_mean", "log2fc", "padj")


def guess_design(samples: DataFrame, column: str = "sample") -> DataFrame:
    """(label, condition) guessed from sample names: a trailing replicate number
    (optionally preceded by '_', '.', '-' and/or 'rep') is removed."""
    return samples.select(F.col(column).alias("label"),
                          F.regexp_replace(F.col(column), r"[_.-]?(rep)?\d+$", "").alias("condition")).distinct()


def target_table(files: DataFrame, column: str = "file", suffix: str = "_feature.out") -> DataFrame:
    """target rows from count file names: label = name minus suffix, condition = label, replicat = X."""
    name = F.regexp_extract(F.col(column), r"([^/]*)$", 1)
    label = F.regexp_replace(name, suffix.replace(".", r"\.") + "$", "")
    return files.select(label.alias("label"), name.alias("files"), label.alias("condition"),
                        F.lit("X").alias("replicat"))
