"""Read quality control (the FastQC role, one bin per base) on a reads table.

Every per-position statistic is computed from a histogram first: reads are
exploded to (sample, position, value) and immediately counted, so the shuffle
is bounded by read length x distinct values, not by the number of bases.
"""

from __future__ import annotations

from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from strandline.functions.sequence import PHRED_OFFSET, base_count, gc_count, quals
from strandline.session import ensure_checkpoint_dir

# Percentiles of the per-base quality plot.
QUALITY_PERCENTILES = {"p10": 10, "q1": 25, "median": 50, "q3": 75, "p90": 90}
# Duplication level buckets (label, smallest copy number).
DUPLICATION_LEVELS = [("1", 1), ("2", 2), ("3", 3), ("4", 4), ("5", 5), ("6", 6), ("7", 7), ("8", 8), ("9", 9),
                      (">10", 10), (">50", 50), (">100", 100), (">500", 500), (">1k", 1000), (">5k", 5000),
                      (">10k", 10000)]
# Adapter sequences screened by default (name, sequence).
ADAPTERS = [("Illumina Universal Adapter", "AGATCGGAAGAG"), ("Illumina Small RNA 3' Adapter", "TGGAATTCTCGG"),
            ("Illumina Small RNA 5' Adapter", "GATCGTCGGACT"), ("Nextera Transposase Sequence", "CTGTCTCTTATA"),
            ("PolyA", "AAAAAAAAAAAA"), ("PolyG", "GGGGGGGGGGGG")]
OVERREPRESENTED_SHARE = 0.001


def per_mate(operator):
    """Reads of pairs are judged per mate: where the reads have a ``mate`` column, the unit is (sample, mate)
    and the result has both."""
    @wraps(operator)
    def run(reads: DataFrame, *args, **kwargs) -> DataFrame:
        if "mate" not in reads.columns:
            return operator(reads, *args, **kwargs)
        unit = reads.withColumn("sample", F.struct("sample", "mate")).drop("mate")
        out = operator(unit, *args, **kwargs)
        return out.select("sample.sample", "sample.mate", *[c for c in out.columns if c != "sample"])
    return run


def quality_histogram(reads: DataFrame) -> DataFrame:
    """(sample, position, q, n): base qualities counted per 1-based position."""
    x = reads.select("sample", F.posexplode(quals("qual")).alias("_i", "q"))
    return x.groupBy("sample", (F.col("_i") + 1).alias("position"), "q").agg(F.count(F.lit(1)).alias("n"))


@per_mate
def per_base_quality(reads: DataFrame) -> DataFrame:
    """Q1: per (sample, position): mean and the 10/25/50/75/90th percentiles of base quality.

    Percentile p is the smallest quality whose cumulative count reaches
    max(1, floor(total * p / 100)) — computed on the histogram, so exact.
    """
    return _quality_of(quality_histogram(reads))


def _quality_of(h: DataFrame) -> DataFrame:
    w = Window.partitionBy("sample", "position").orderBy("q").rowsBetween(Window.unboundedPreceding, 0)
    h = h.withColumn("_cum", F.sum("n").over(w)) \
         .withColumn("_tot", F.sum("n").over(Window.partitionBy("sample", "position")))
    aggs = [F.round(F.sum(F.col("q") * F.col("n")) / F.sum("n"), 6).alias("mean")]
    for name, p in QUALITY_PERCENTILES.items():
        target = F.greatest(F.lit(1), F.floor(F.col("_tot") * p / 100))
        aggs.append(F.min(F.when(F.col("_cum") >= target, F.col("q"))).alias(name))
    return h.groupBy("sample", "position").agg(*aggs)


@per_mate
def per_read_quality(reads: DataFrame) -> DataFrame:
    """Q2: per sample, number of reads by mean quality (rounded down)."""
    q = quals("qual")
    mean = F.floor(F.aggregate(q, F.lit(0).cast("bigint"), lambda a, x: a + x) / F.size(q))
    return reads.where(F.length("qual") > 0).groupBy("sample", mean.cast("int").alias("mean_quality")) \
        .agg(F.count(F.lit(1)).alias("reads"))


def _base_histogram(reads: DataFrame) -> DataFrame:
    x = reads.select("sample", F.posexplode(F.split("seq", "")).alias("_i", "base"))
    return x.groupBy("sample", (F.col("_i") + 1).alias("position"), "base").agg(F.count(F.lit(1)).alias("n"))


@per_mate
def per_base_content(reads: DataFrame) -> DataFrame:
    """Q3: per (sample, position): % of A, C, G, T among called (A/C/G/T) bases."""
    return _content_of(_base_histogram(reads))


def _content_of(h: DataFrame) -> DataFrame:
    s = lambda b: F.sum(F.when(F.col("base") == b, F.col("n")).otherwise(0))
    acgt = F.sum(F.when(F.col("base").isin("A", "C", "G", "T"), F.col("n")).otherwise(0))
    r = h.groupBy("sample", "position").agg(*[s(b).alias(f"_n{b}") for b in "ACGT"], acgt.alias("_total"))
    return r.where(F.col("_total") > 0).select(
        "sample", "position",
        *[F.round(F.col(f"_n{b}") * 100.0 / F.col("_total"), 6).alias(f"pct_{b}") for b in "ACGT"])


@per_mate
def gc_distribution(reads: DataFrame) -> DataFrame:
    """Q4: per sample, reads by GC% (rounded to an integer, over A/C/G/T bases)."""
    acgt = base_count("seq", "ACGTacgt")
    gc = F.round(gc_count("seq") * 100.0 / acgt).cast("int")
    return reads.where(acgt > 0).groupBy("sample", gc.alias("gc_percent")).agg(F.count(F.lit(1)).alias("reads"))


@per_mate
def per_base_n(reads: DataFrame) -> DataFrame:
    """Q5: per (sample, position): % of bases called N."""
    return _n_of(_base_histogram(reads))


def _n_of(h: DataFrame) -> DataFrame:
    r = h.groupBy("sample", "position").agg(
        F.sum(F.when(F.col("base") == "N", F.col("n")).otherwise(0)).alias("_n"), F.sum("n").alias("_t"))
    return r.select("sample", "position", F.round(F.col("_n") * 100.0 / F.col("_t"), 6).alias("pct_n"))


@per_mate
def length_distribution(reads: DataFrame) -> DataFrame:
    """Q6: per sample, reads by length."""
    return reads.groupBy("sample", F.length("seq").alias("length")).agg(F.count(F.lit(1)).alias("reads"))


def _level_label(copies):
    expr = F.lit(None).cast("string")
    for label, lo in DUPLICATION_LEVELS:
        expr = F.when(copies >= lo, F.lit(label)).otherwise(expr)
    return expr


@per_mate
def duplication_levels(reads: DataFrame) -> DataFrame:
    """Q7: per sample and duplication level, the number of distinct sequences and of reads."""
    return _levels_of(_sequence_counts(reads).groupBy("sample", "copies").agg(F.count(F.lit(1)).alias("sequences")))


def _levels_of(copies: DataFrame) -> DataFrame:
    return copies.groupBy("sample", _level_label(F.col("copies")).alias("level")).agg(
        F.sum("sequences").alias("sequences"), F.sum(F.col("copies") * F.col("sequences")).alias("reads"))


def _sequence_key() -> list[Column]:
    """Two 64-bit hashes stand for a sequence: 16 bytes are shuffled instead of the read."""
    return [F.xxhash64("seq").alias("h1"), F.xxhash64(F.reverse("seq"), F.length("seq")).alias("h2")]


def _sequence_counts(reads: DataFrame) -> DataFrame:
    """(sample, h1, h2, copies): how often each sequence occurs."""
    return reads.select("sample", *_sequence_key()).groupBy("sample", "h1", "h2").agg(F.count(F.lit(1)).alias("copies"))


@per_mate
def overrepresented_sequences(reads: DataFrame, *, share: float = OVERREPRESENTED_SHARE) -> DataFrame:
    """Q8: sequences making up more than ``share`` of a sample's reads.

    Sequences are counted by their hashes; only for those above the share (at most 1 / ``share`` per sample) the
    letters are fetched."""
    copies = _sequence_counts(reads)
    totals = F.broadcast(copies.groupBy("sample").agg(F.sum("copies").alias("_total")))  # one row per sample
    many = copies.join(totals, "sample").where(F.col("copies") > F.col("_total") * share)
    letters = reads.select("sample", "seq", *_sequence_key()).join(F.broadcast(many), ["sample", "h1", "h2"])
    return letters.groupBy("sample", "h1", "h2", "copies", "_total").agg(F.min("seq").alias("seq")).select(
        "sample", "seq", F.col("copies").alias("count"), F.round(F.col("copies") * 100.0 / F.col("_total"), 6).alias("percentage"))


@per_mate
def adapter_content(reads: DataFrame, adapters: list[tuple[str, str]] = ADAPTERS) -> DataFrame:
    """Q9: per (sample, adapter, position): % of reads with the adapter starting at or before the position."""
    first = reads.select("sample", F.explode(_adapter_starts(adapters)).alias("_a")).select("sample", "_a.adapter", "_a.position") \
        .where(F.col("position") > 0).groupBy("sample", "adapter", "position").agg(F.count(F.lit(1)).alias("n"))
    totals = reads.groupBy("sample").agg(F.count(F.lit(1)).alias("_total"), F.max(F.length("seq")).alias("_len"))
    return _adapters_of(first, totals, adapters)


def _adapter_starts(adapters: list[tuple[str, str]]) -> Column:
    """First 1-based start of each adapter (0 = absent), evaluated per row in the JVM."""
    return F.array(*[F.struct(F.lit(n).alias("adapter"), F.instr("seq", s).alias("position")) for n, s in adapters])


def _adapters_of(first: DataFrame, totals: DataFrame, adapters: list[tuple[str, str]]) -> DataFrame:
    grid = totals.select("sample", "_total", F.explode(F.sequence(F.lit(1), F.col("_len"))).alias("position")) \
        .select("sample", "_total", "position",
                F.explode(F.array(*[F.lit(n) for n, _ in adapters])).alias("adapter"))
    g = grid.join(first, ["sample", "adapter", "position"], "left")
    w = Window.partitionBy("sample", "adapter").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    return g.select("sample", "adapter", "position",
                    F.round(F.sum(F.coalesce(F.col("n"), F.lit(0))).over(w) * 100.0 / F.col("_total"), 6)
                    .alias("pct_reads"))


@per_mate
def basic_stats(reads: DataFrame) -> DataFrame:
    """Q10: per sample total sequences, shortest and longest read, %GC of all bases."""
    return reads.groupBy("sample").agg(
        F.count(F.lit(1)).alias("total_sequences"), F.min(F.length("seq")).alias("min_length"),
        F.max(F.length("seq")).alias("max_length"),
        F.round(F.sum(gc_count("seq")) * 100.0 / F.sum(base_count("seq", "ACGTacgt")), 6).alias("pct_gc"))


# kinds of a profile: base quality, base, mean quality, GC %, length, adapter start, copies of a sequence
_Q, _B, _M, _G, _L, _A, _C = "q", "b", "m", "g", "l", "a", "c"


@per_mate
def read_profile(reads: DataFrame, adapters: list[tuple[str, str]] = ADAPTERS) -> DataFrame:
    """(sample, kind, position, value, n): everything the QC modules count, from one scan of the reads.

    Letters and scores are counted per Arrow batch (``_batch_profile``), so a batch leaves a few rows per sample, position
    and value, and one per sequence: its two hashes, whose counts are then counted themselves.  What is left is small
    however many reads there are."""
    acgt = base_count("seq", "ACGTacgt")
    h1, h2 = _sequence_key()
    kind = reads.schema["sample"].dataType
    unit = F.col("sample") if isinstance(kind, StringType) else F.to_json(F.struct("sample"))
    x = reads.select(
        "sample", unit.alias("unit"), "seq", "qual", F.length("seq").cast("long").alias(_L), h1.alias("h1"), h2.alias("h2"),
        F.when(acgt > 0, F.round(gc_count("seq") * 100.0 / acgt)).cast("long").alias(_G),
        *[F.instr("seq", s).cast("long").alias(f"{_A}{k}") for k, (_, s) in enumerate(adapters)])
    out = StructType([StructField("sample", kind), StructField("kind", StringType()), *[
        StructField(c, LongType()) for c in ("position", "value", "n")]])
    n = x.mapInArrow(_batch_profile(len(adapters)), out).groupBy("sample", "kind", "position", "value").agg(F.sum("n").alias("n"))
    copies = F.col("kind") == _C
    return n.groupBy("sample", "kind", F.when(copies, F.lit(0)).otherwise(F.col("position")).cast("long").alias("position"),
                     F.when(copies, F.col("n")).otherwise(F.col("value")).alias("value")).agg(
        F.sum(F.when(copies, F.lit(1)).otherwise(F.col("n"))).alias("n"))


def _letters(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all strings of a column, and how many each has (null: none)."""
    text = column.fill_null("").cast(pa.large_binary())
    n = pc.binary_length(text).to_numpy(zero_copy_only=False).astype(np.int64)
    first = np.frombuffer(text.buffers()[1], dtype=np.int64)[text.offset]
    flat = np.frombuffer(text.buffers()[2] or b"", dtype=np.uint8)[first:first + n.sum()]
    if (flat > 127).any():
        words = column.fill_null("").to_pylist()
        n = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        flat = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
    return flat, n


def _counted(unit: np.ndarray, position: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct (unit, position, value) of integers from 0 on, and how often each occurs."""
    if not len(unit):
        return unit, position, value, unit
    high, wide = int(value.max()) + 1, int(position.max()) + 1
    code = (unit * wide + position) * high + value
    if (size := (int(unit.max()) + 1) * wide * high) <= 4 * len(code) + (1 << 16):
        n = np.bincount(code, minlength=size)
        code = np.flatnonzero(n)
        n = n[code]
    else:
        code, n = np.unique(code, return_counts=True)
    return code // (wide * high), code // high % wide, code % high, n


def _batch_profile(adapters: int):
    """Counts (sample, kind, position, value, n) of each Arrow batch of reads."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            units = batch.column("unit").dictionary_encode("encode")
            unit = units.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            _, rows = np.unique(unit, return_index=True)  # a row of each unit
            parts = []  # kind, row of the sample, position, value, n

            def add(kind, unit, position, value, n, less=0):
                parts.append((kind, rows[unit], position, value - less, n))

            for kind, name, less in ((_B, "seq", 0), (_Q, "qual", PHRED_OFFSET)):
                flat, n = _letters(batch.column(name))
                begin = np.cumsum(n) - n
                at = np.arange(len(flat)) - np.repeat(begin, n)
                add(kind, *_counted(np.repeat(unit, n), at + 1, flat.astype(np.int64)), less)
                # an empty string is one empty letter
                bare = np.flatnonzero((n == 0) & batch.column(name).is_valid().to_numpy(zero_copy_only=False))
                add(kind, *_counted(unit[bare], np.ones(len(bare), dtype=np.int64), np.zeros(len(bare), dtype=np.int64)), less)
            some = np.flatnonzero(n > 0)  # of the scores
            if len(some):
                total = np.add.reduceat(flat.astype(np.int64), begin[some]) - PHRED_OFFSET * n[some]
                mean = np.floor(total / n[some]).astype(np.int64) + PHRED_OFFSET
                add(_M, *_counted(unit[some], np.zeros_like(some), mean), PHRED_OFFSET)
            for kind, position in ((_G, False), (_L, False), *((f"{_A}{k}", True) for k in range(adapters))):
                column = batch.column(kind)
                known = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
                value = column.fill_null(0).to_numpy(zero_copy_only=False)
                known = known[value[known] > 0] if position else known
                none = np.zeros(len(known), dtype=np.int64)
                if position:
                    u, at, _, n = _counted(unit[known], value[known], none)
                    add(_A, u, at, np.full(len(u), int(kind[1:])), n)
                else:
                    add(kind, *_counted(unit[known], none, value[known]))
            bare = np.flatnonzero(batch.column(_L).is_null().to_numpy(zero_copy_only=False))
            every, sample = np.arange(batch.num_rows), batch.column("sample")

            def table(kind, at, position, value, n):
                return pa.RecordBatch.from_arrays(
                    [sample.take(pa.array(at)), pa.array([kind]).take(pa.array(np.zeros(len(at), dtype=np.int64))),
                     pa.array(position), value, pa.array(n)], ["sample", "kind", "position", "value", "n"])

            for kind, at, position, value, n in parts:
                if len(at):
                    yield table(kind, at, position.astype(np.int64), pa.array(value.astype(np.int64)), n.astype(np.int64))
            zero, one = np.zeros(len(bare), dtype=np.int64), np.ones(batch.num_rows, dtype=np.int64)
            if len(bare):
                yield table(_L, bare, zero, pa.nulls(len(bare), pa.int64()), one[:len(bare)])
            yield table(_C, every, batch.column("h1").to_numpy(zero_copy_only=False), batch.column("h2"), one)

    return run


def profile_tables(profile: DataFrame, adapters: list[tuple[str, str]] = ADAPTERS) -> dict[str, DataFrame]:
    """The tables of Q1-Q7, Q9 and Q10 from a ``read_profile``."""
    if "mate" in profile.columns:
        unit = profile.withColumn("sample", F.struct("sample", "mate")).drop("mate")
        return {k: t.select("sample.sample", "sample.mate", *[c for c in t.columns if c != "sample"])
                for k, t in profile_tables(unit, adapters).items()}

    def kind(k: str) -> DataFrame:
        return profile.where(F.col("kind") == k)

    def per_value(k: str, name: str) -> DataFrame:
        return kind(k).select("sample", F.col("value").cast("int").alias(name), F.col("n").alias("reads"))

    bases = kind(_B).select("sample", F.col("position").cast("int").alias("position"), F.char(F.col("value")).alias("base"), "n")
    lengths = kind(_L).groupBy("sample").agg(F.sum("n").alias("total_sequences"), F.min("value").cast("int").alias("min_length"),
                                             F.max("value").cast("int").alias("max_length"))
    called = bases.groupBy("sample").agg(
        F.round(F.sum(F.when(F.col("base").isin("G", "C", "g", "c"), F.col("n")).otherwise(0)) * 100.0
                / F.sum(F.when(F.col("base").isin(*"ACGTacgt"), F.col("n")).otherwise(0)), 6).alias("pct_gc"))
    names = F.array(*[F.lit(n) for n, _ in adapters])
    first = kind(_A).select("sample", names[F.col("value").cast("int")].alias("adapter"), F.col("position").cast("int").alias("position"), "n")
    totals = lengths.select("sample", F.col("total_sequences").alias("_total"), F.col("max_length").alias("_len"))
    return {
        "per_base_quality": _quality_of(kind(_Q).select("sample", F.col("position").cast("int").alias("position"),
                                                        F.col("value").cast("int").alias("q"), "n")),
        "per_read_quality": per_value(_M, "mean_quality"), "per_base_content": _content_of(bases),
        "gc_distribution": per_value(_G, "gc_percent"), "per_base_n": _n_of(bases), "length_distribution": per_value(_L, "length"),
        "duplication_levels": _levels_of(kind(_C).select("sample", F.col("value").alias("copies"), F.col("n").alias("sequences"))),
        "adapter_content": _adapters_of(first, totals, adapters), "basic_stats": lengths.join(called, "sample", "left"),
        "most_copies": kind(_C).groupBy("sample").agg(F.max("value").alias("copies"), F.sum(F.col("value") * F.col("n")).alias("reads"))}


@per_mate
def qc_status(reads: DataFrame) -> DataFrame:
    """Q11: pass / warn / fail per (sample, module) with the tool's published thresholds.  The reads are scanned once
    (``read_profile``); the small profile is checkpointed and feeds all modules."""
    ensure_checkpoint_dir(reads.sparkSession)
    t = profile_tables(read_profile(reads).checkpoint())

    def graded(table: DataFrame, module: str, fail: Column, warn: Column) -> DataFrame:
        return table.select("sample", F.lit(module).alias("module"), _grade(fail, warn))

    quality = t["per_base_quality"].groupBy("sample").agg(F.min("q1").alias("_lq"), F.min("median").alias("_med"))
    n = t["per_base_n"].groupBy("sample").agg(F.max("pct_n").alias("_n"))
    most = t["most_copies"].withColumn("_p", F.when(F.col("copies") > F.col("reads") * OVERREPRESENTED_SHARE,
                                                    F.round(F.col("copies") * 100.0 / F.col("reads"), 6)))
    by_mean = t["per_read_quality"].groupBy("sample").agg(F.min(F.struct(-F.col("reads"), F.col("mean_quality"))).alias("_m"))
    gap = F.greatest(F.abs(F.col("pct_A") - F.col("pct_T")), F.abs(F.col("pct_G") - F.col("pct_C")))
    content = t["per_base_content"].groupBy("sample").agg(F.max(gap).alias("_g"))
    levels = t["duplication_levels"].groupBy("sample").agg((100 - F.sum("sequences") * 100.0 / F.sum("reads")).alias("_d"))
    adapters = t["adapter_content"].groupBy("sample").agg(F.max("pct_reads").alias("_a"))
    parts = [
        graded(quality, "per_base_sequence_quality", (F.col("_lq") < 5) | (F.col("_med") < 20), (F.col("_lq") < 10) | (F.col("_med") < 25)),
        graded(n, "per_base_n_content", F.col("_n") > 20, F.col("_n") > 5),
        graded(t["basic_stats"], "sequence_length_distribution", F.col("min_length") == 0, F.col("min_length") != F.col("max_length")),
        graded(most, "overrepresented_sequences", F.col("_p") > 1, F.col("_p") > 0.1),
        graded(by_mean, "per_sequence_quality_scores", F.col("_m.mean_quality") < 20, F.col("_m.mean_quality") < 27),
        graded(content, "per_base_sequence_content", F.col("_g") > 20, F.col("_g") > 10),
        graded(levels, "sequence_duplication_levels", F.col("_d") > 50, F.col("_d") > 20),
        graded(adapters, "adapter_content", F.col("_a") > 10, F.col("_a") > 5)]
    out = parts[0]
    for m in parts[1:]:
        out = out.unionByName(m)
    return out


def _grade(fail: Column, warn: Column) -> Column:
    return F.when(fail, "fail").when(warn, "warn").otherwise("pass").alias("status")


def percent_fails(status: DataFrame) -> DataFrame:
    """Q11: per sample (and mate), the share of modules that failed (%)."""
    by = [c for c in ("sample", "mate") if c in status.columns]
    return status.groupBy(*by).agg(F.round(
        F.count_if(F.col("status") == "fail") * 100.0 / F.count(F.lit(1)), 6).alias("percent_fails"))
