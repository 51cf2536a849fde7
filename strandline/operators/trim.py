"""Read trimming and filtering (the fastp / cutadapt role).

Filters and fixed cuts are JVM-side column expressions; the three scans along a read (adapter, 3' quality,
sliding window) are Arrow-batched numpy kernels.

Each trimmer rewrites ``seq`` and ``qual`` with the same offsets; each filter
drops rows.  ``trim_reads`` chains them in the tool's order with the
reference's switches.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import IntegerType

from strandline.functions.sequence import base_count, gc_count, quals

# Defaults of the reference configuration.
ADAPTER_MIN_OVERLAP = 6
ADAPTER_ERROR_RATE = 0.1
QUALITY_CUTOFF = 30
MIN_LENGTH = 20
CUT_TAIL_WINDOW = 4
CUT_TAIL_MEAN = 20
QUALIFIED_QUALITY = 15
UNQUALIFIED_PERCENT_LIMIT = 40
N_BASE_LIMIT = 5


CHUNK_BYTES = 1 << 22  # bytes of a padded matrix of reads that are worked on at a time


def _by_length(strings: pd.Series, kernel) -> pd.Series:
    """``kernel(bytes, lengths)`` over the strings of a batch as padded byte matrices.  Strings of similar length
    share a matrix of bounded size, so one long read does not widen the others."""
    text = strings.fillna("").tolist()
    n = np.fromiter(map(len, text), dtype=np.int64, count=len(text))
    out = np.zeros(len(text), dtype=np.int32)
    order = np.argsort(n, kind="stable")
    at = 0
    while at < len(order):
        rows = max(1, CHUNK_BYTES // max(1, int(n[order[min(len(order), at + 4096) - 1]])))
        idx = order[at:at + min(rows, 4096)]
        width = max(1, int(n[idx].max()))
        m = np.zeros((len(idx), width), dtype=np.uint8)
        flat = np.frombuffer("".join(text[i] for i in idx).encode("ascii", "replace"), dtype=np.uint8)
        m[np.arange(width)[None, :] < n[idx][:, None]] = flat
        out[idx] = kernel(m, n[idx])
        at += len(idx)
    return pd.Series(out)


def _phred(m: np.ndarray) -> np.ndarray:
    return np.where(m > 0, m.astype(np.int32) - 33, 0)


def _cut_tail_udf(window: int, mean: int):
    def kernel(m, n):
        q = _phred(m)
        w = np.minimum(n, window)
        width = q.shape[1]
        csum = np.concatenate([np.zeros((len(n), 1), dtype=np.int64), np.cumsum(q, axis=1)], axis=1)
        starts = np.arange(width)[None, :]
        sums = np.take_along_axis(csum, np.minimum(starts + w[:, None], width), axis=1) - csum[:, :width]
        ok = (starts <= (n - w)[:, None]) & (sums >= w[:, None] * mean) & (w[:, None] > 0)
        last = np.where(ok.any(axis=1), width - 1 - np.argmax(ok[:, ::-1], axis=1), -1)
        return np.where(last >= 0, last + w, 0)

    @pandas_udf(IntegerType())
    def cut(quals: pd.Series) -> pd.Series:
        return _by_length(quals, kernel)
    return cut


def _quality_trim_udf(cutoff: int):
    def kernel(m, n):
        q = _phred(m)
        width = q.shape[1]
        pos = np.arange(width)[None, :]
        gain = np.where(pos < n[:, None], cutoff - q, 0)
        sums = np.cumsum(gain[:, ::-1], axis=1)[:, ::-1]  # from each position to the 3' end
        # the scan stops where the sum first turns negative, seen from the 3' end
        stop = np.where(sums < 0, pos, -1).max(axis=1)
        inside = (pos > stop[:, None]) & (pos < n[:, None])
        best = np.where(inside, sums, 0)
        top = best.max(axis=1)
        # of equal maxima the one nearest the 3' end
        cut = width - 1 - np.argmax(best[:, ::-1], axis=1)
        return np.where(top > 0, cut, n)

    @pandas_udf(IntegerType())
    def cut(quals: pd.Series) -> pd.Series:
        return _by_length(quals, kernel)
    return cut


def _adapter_udf(adapter: str, min_overlap: int, error_rate: float):
    """0-based start of the leftmost acceptable adapter occurrence, or the read length.

    An occurrence at offset i compares read[i : i + L] with adapter[0 : L], L = min(|adapter|, |read| - i) >=
    ``min_overlap``, and allows floor(L * error_rate) substitutions (no indels).
    """
    probe = np.frombuffer(adapter.upper().encode("ascii"), dtype=np.uint8)
    allowed = np.array([int(k * error_rate) for k in range(len(probe) + 1)])

    def kernel(m, n):
        found = n.copy()
        open_ = np.ones(len(n), dtype=bool)
        for i in range(max(0, m.shape[1] - min_overlap + 1)):
            k = min(len(probe), m.shape[1] - i)
            overlap = np.minimum(len(probe), n - i)
            rows = np.flatnonzero(open_ & (overlap >= min_overlap))
            if not len(rows):
                break
            wrong = ((m[rows, i:i + k] != probe[None, :k]) & (np.arange(k)[None, :] < overlap[rows][:, None])).sum(axis=1)
            hit = rows[wrong <= allowed[overlap[rows]]]
            found[hit] = i
            open_[hit] = False
        return found

    @pandas_udf(IntegerType())
    def start(seqs: pd.Series) -> pd.Series:
        return _by_length(seqs, kernel)
    return start


def _keep(df: DataFrame, start: Column, length: Column) -> DataFrame:
    """Keep ``length`` bases starting at 0-based ``start`` in both seq and qual.

    The new columns leave through a one-row ``inline`` generator: generator
    outputs are plain attributes, so filters stacked on a trimmed read are not
    rewritten by the optimizer into copies of the (array-scanning) trimming
    expression.
    """
    s = (start + 1).cast("int")
    n = F.greatest(length, F.lit(0)).cast("int")
    others = [c for c in df.columns if c not in ("seq", "qual") and not c.startswith("_")]
    trimmed = F.struct(F.when(n > 0, F.substring(F.col("seq"), s, n)).otherwise(F.lit("")).alias("seq"),
                       F.when(n > 0, F.substring(F.col("qual"), s, n)).otherwise(F.lit("")).alias("qual"))
    return df.select(*others, F.inline(F.array(trimmed)))


def adapter_start(seq: str, adapter: str, *, min_overlap: int = ADAPTER_MIN_OVERLAP,
                  error_rate: float = ADAPTER_ERROR_RATE) -> Column:
    """0-based start of the leftmost 3' adapter match, or the read length when none."""
    return _adapter_udf(adapter, min_overlap, error_rate)(F.col(seq))


def trim_adapter(reads: DataFrame, adapter: str, *, mode: str = "a", min_overlap: int = ADAPTER_MIN_OVERLAP,
                 error_rate: float = ADAPTER_ERROR_RATE) -> DataFrame:
    """Remove a 3' adapter (``mode='a'``) and everything after it; ``'g'`` removes a 5' adapter
    (matched on the reversed read); ``'b'`` does either, the 3' match winning when both occur."""
    if mode not in ("a", "g", "b"):
        raise ValueError("mode must be 'a', 'g' or 'b'")
    out = reads
    if mode in ("a", "b"):
        out = _keep(out, F.lit(0), adapter_start("seq", adapter, min_overlap=min_overlap, error_rate=error_rate))
    if mode in ("g", "b"):
        rev = out.withColumn("_rseq", F.reverse("seq"))
        rev = rev.withColumn("_cut", adapter_start("_rseq", adapter[::-1], min_overlap=min_overlap,
                                                   error_rate=error_rate))
        out = _keep(rev, F.length("seq") - F.col("_cut"), F.col("_cut"))
    return out


def trim_n(reads: DataFrame) -> DataFrame:
    """Strip runs of N at both ends."""
    lead = F.length(F.regexp_extract("seq", "^N*", 0))
    trail = F.length(F.regexp_extract("seq", "N*$", 0))
    ln = F.length("seq")
    return _keep(reads, lead, F.when(lead == ln, F.lit(0)).otherwise(ln - lead - trail))


def quality_trim_3p(reads: DataFrame, cutoff: int = QUALITY_CUTOFF) -> DataFrame:
    """3' quality trimming (0 = off; the reference's -1 means the default 30)."""
    if cutoff == 0:
        return reads
    if cutoff < 0:
        cutoff = QUALITY_CUTOFF
    d = reads.withColumn("_cut", _quality_trim_udf(cutoff)(F.col("qual")))
    return _keep(d, F.lit(0), F.col("_cut"))


def min_length(reads: DataFrame, length: int = MIN_LENGTH) -> DataFrame:
    """T4: drop reads shorter than ``length``."""
    return reads.where(F.length("seq") >= length)


def cut_tail(reads: DataFrame, window: int = CUT_TAIL_WINDOW, mean: int = CUT_TAIL_MEAN) -> DataFrame:
    """T5: drop 3' bases while the window's mean quality is below ``mean``."""
    d = reads.withColumn("_cut", _cut_tail_udf(window, mean)(F.col("qual")))
    return _keep(d, F.lit(0), F.col("_cut"))


def qualified_filter(reads: DataFrame, quality: int = QUALIFIED_QUALITY,
                     unqualified_percent: int = UNQUALIFIED_PERCENT_LIMIT) -> DataFrame:
    """Drop reads with more than ``unqualified_percent`` % of bases below ``quality``."""
    low = F.size(F.filter(quals("qual"), lambda x: x < quality))
    return reads.where(low * 100 <= F.length("seq") * unqualified_percent)


def n_base_limit(reads: DataFrame, limit: int = N_BASE_LIMIT) -> DataFrame:
    """Drop reads with more than ``limit`` N bases (the tool's rule: N > limit)."""
    return reads.where(base_count("seq", "Nn") <= limit)


def mean_quality_filter(reads: DataFrame, min_mean: int) -> DataFrame:
    """Drop reads whose mean base quality is below ``min_mean`` (0 = off)."""
    if min_mean <= 0:
        return reads
    q = quals("qual")
    return reads.where(F.aggregate(q, F.lit(0).cast("bigint"), lambda a, x: a + x) >= F.size(q) * min_mean)


def trim_reads(reads: DataFrame, *, adapter: str | None = None, adapter_mode: str = "a",
               adapter_fwd: str | list | None = None, adapter_rev: str | list | None = None, trim_ns: bool = True,
               quality_cutoff: int = QUALITY_CUTOFF, cut_tail_window: int | None = None,
               cut_tail_mean: int = CUT_TAIL_MEAN, minimum_length: int = MIN_LENGTH,
               disable_quality_filtering: bool = False, disable_adapter_trimming: bool = False,
               qualified_quality: int = QUALIFIED_QUALITY, unqualified_percent: int = UNQUALIFIED_PERCENT_LIMIT,
               n_limit: int = N_BASE_LIMIT, average_quality: int = 0) -> DataFrame:
    """T9 + chain: the configured trimmers and filters in the order quality, adapter, Ns, length; each can be
    switched off.  ``adapter`` is one sequence matched without gaps; ``adapter_fwd`` and ``adapter_rev`` are settings
    (bases, a list, or ``file:`` and a path) per mate, matched with gaps (``adapters.trim_adapters``)."""
    out = reads
    if quality_cutoff:
        out = quality_trim_3p(out, quality_cutoff)
    if adapter and not disable_adapter_trimming:
        out = trim_adapter(out, adapter, mode=adapter_mode)
    if (adapter_fwd or adapter_rev) and not disable_adapter_trimming:
        from strandline.operators.adapters import trim_adapters

        out = trim_adapters(out, adapter_fwd, adapter_rev, mode=adapter_mode).drop("adapter", "adapter_errors")
    if trim_ns:
        out = trim_n(out)
    if cut_tail_window:
        out = cut_tail(out, cut_tail_window, cut_tail_mean)
    if not disable_quality_filtering:
        out = qualified_filter(out, qualified_quality, unqualified_percent)
        out = n_base_limit(out, n_limit)
        out = mean_quality_filter(out, average_quality)
    return min_length(out, minimum_length)


def pair_filter(mates1: DataFrame, mates2: DataFrame, keep, *, key: list[str]) -> DataFrame:
    """One row per pair (both mates side by side); a pair survives only when both mates pass.

    ``keep`` maps a single-mate DataFrame to its surviving rows.
    """
    k1 = keep(mates1).select(*key, F.col("seq").alias("seq1"), F.col("qual").alias("qual1"))
    k2 = keep(mates2).select(*key, F.col("seq").alias("seq2"), F.col("qual").alias("qual2"))
    return k1.join(k2, key)


def trim_summary(before: DataFrame, after: DataFrame) -> DataFrame:
    """Reads, bases, Q20/Q30 bases and GC bases per sample, before and after trimming."""
    def stats(df, stage):
        return df.groupBy("sample").agg(
            F.count(F.lit(1)).alias("reads"), F.sum(F.length("seq")).cast("bigint").alias("bases"),
            F.sum(F.size(F.filter(quals("qual"), lambda x: x >= 20))).cast("bigint").alias("q20_bases"),
            F.sum(F.size(F.filter(quals("qual"), lambda x: x >= 30))).cast("bigint").alias("q30_bases"),
            F.sum(gc_count("seq")).cast("bigint").alias("gc_bases")).withColumn("stage", F.lit(stage))
    return stats(before, "before").unionByName(stats(after, "after"))


def duplication_share(reads: DataFrame) -> DataFrame:
    """Per sample, the share of reads (%) that repeat an earlier sequence.  Sequences meet by a pair of 64-bit hashes."""
    key = [F.xxhash64("seq").alias("_h1"), F.xxhash64(F.reverse("seq"), F.length("seq")).alias("_h2")]
    per = reads.select("sample", *key).groupBy("sample", "_h1", "_h2").agg(F.count(F.lit(1)).alias("_n"))
    return per.groupBy("sample").agg(F.sum("_n").alias("reads"), F.round(
        100 - F.count(F.lit(1)) * 100.0 / F.sum("_n"), 6).alias("duplication_percent"))


def trimming_off(reads: DataFrame) -> DataFrame:
    """Trimming disabled, reads flow through unchanged."""
    return reads


def detect_adapters(reads: DataFrame, *, k: int = 12, top: int = 5, buckets: int = 64) -> DataFrame:
    """T10 (single end): the ``top`` most frequent 3' tail k-mers per sample, as adapter candidates.

    Exact top-k in two stages so no task ranks all distinct k-mers of a sample:
    rank inside (sample, hash bucket of the k-mer), keep each bucket's top k,
    then rank those few rows per sample.  Ties: smaller k-mer first.
    """
    from pyspark.sql import Window

    tails = reads.where(F.length("seq") >= k).select("sample", F.expr(f"substring(seq, -{k}, {k})").alias("kmer"))
    c = tails.groupBy("sample", "kmer").agg(F.count(F.lit(1)).alias("count"))
    c = c.withColumn("_b", F.pmod(F.xxhash64("kmer"), F.lit(buckets)))
    w1 = Window.partitionBy("sample", "_b").orderBy(F.desc("count"), "kmer")
    c = c.withColumn("_r", F.row_number().over(w1)).where(F.col("_r") <= top)
    w2 = Window.partitionBy("sample").orderBy(F.desc("count"), "kmer")  # at most buckets x top rows
    return c.select("sample", "kmer", "count", F.row_number().over(w2).alias("rank")).where(F.col("rank") <= top)
