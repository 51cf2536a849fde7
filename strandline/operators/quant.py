"""A2: transcript quantification from k-mer equivalence classes and EM (re-aimed quantifier).

Reads are pseudo-aligned: every k-mer of a read is looked up in a k-mer index of both transcript strands; in one
orientation the read is compatible with the transcripts that contain all of its matched k-mers.  Mates are compatible
with a transcript that has them inward, in opposite orientations.  A first pass over these mappings tells each sample's
library type, which then decides the orientations that count, and for pairs the distribution of fragment
lengths, which gives effective lengths.

Fragments with the same transcripts form an equivalence class (EC: the sorted array of transcript ids), so the EM runs
over ECs, not reads: a round is one join of EC members with the current abundances and two aggregations.
Abundances are checkpointed every few rounds (the shared ``spark.checkpoint.dir``) so the lineage stays short.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.operators.align import _strands, kmer_index
from strandline.operators.intervals import fits_broadcast
from strandline.operators.mapping import _by_length, _hashes
from strandline.session import ensure_checkpoint_dir

QUANT_K = 31
EM_ITERATIONS = 500
CHECKPOINT_EVERY = 5
CONVERGED = 1e-6
INDEX_BROADCAST = 300_000  # index rows (about 100 bytes each) that may be broadcast, after counting them
FILTER_BITS = 24  # leading hash bits that are looked up before the hash itself
STRANDED = 0.7  # share of one orientation from which a library is stranded
MAX_FRAGMENT = 1000
FRAGMENT_MEAN, FRAGMENT_SD = 250.0, 25.0  # single ends: the assumed distribution of fragment lengths

READ = ["sample", "read_id", "mate"]


def _numbered(transcripts: DataFrame) -> DataFrame:
    """(tx, name, seq, length): ids are hashes of the names; two names with one hash raise."""
    t = transcripts.select(F.xxhash64("name").alias("tx"), "name", F.upper("seq").alias("seq"),
                           F.length("seq").cast("bigint").alias("length"))
    twice = t.groupBy("tx").agg(F.count_distinct("name").alias("n")).where("n > 1")
    if not twice.isEmpty():
        raise ValueError("two transcript names share an id")
    return t


def _may_match(idx: DataFrame, k: int):
    """Whether a read has a k-mer whose hash is that of an index k-mer; the others need not be cut into rows.  The hashes of
    the index pass through the driver: only for an index that may be broadcast."""
    @F.pandas_udf("long")
    def hashed(kmers: pd.Series) -> pd.Series:
        out = np.zeros(len(kmers), dtype=np.int64)
        for rows, m in _by_length(kmers):  # of one length, k
            out[rows] = _hashes(m, k)[:, 0].view(np.int64)
        return pd.Series(out)

    known = np.sort(idx.select("kmer").where(F.length("kmer") == k).distinct().select(hashed("kmer").alias("h")).toPandas()["h"].to_numpy(np.int64).view(np.uint64))
    shift = np.uint64(64 - FILTER_BITS)

    @F.pandas_udf("boolean")
    def may(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        some = np.zeros(1 << FILTER_BITS, dtype=bool)
        some[(known >> shift).astype(np.int64)] = True
        for seqs in batches:
            found = np.zeros(len(seqs), dtype=bool)
            seqs = seqs.fillna("").reset_index(drop=True)
            for rows, m in _by_length(seqs):
                if m.shape[1] < k or not len(known):
                    continue
                h = _hashes(m, k)
                r, c = np.nonzero(some[(h >> shift).astype(np.int64)])
                x = h[r, c]
                sure = known[np.minimum(np.searchsorted(known, x), len(known) - 1)] == x
                found[rows[r[sure]]] = True
            yield pd.Series(found)

    return may


def mappings(reads: DataFrame, transcripts: DataFrame, *, k: int = QUANT_K) -> DataFrame:
    """(sample, read_id, mate, length, tx, strand, start): the transcripts that hold all matched k-mers of each read, by
    orientation; ``start`` is the read's first base on that strand (0-based).  ``reads`` has sample, read_id, mate, seq;
    k-mers with N are not looked up."""
    idx = kmer_index(_strands(transcripts.select(F.col("tx").alias("name"), "seq")), k=k, width=max(64, 2 * k + 2)) \
        .select("kmer", F.col("name").alias("tx"), "strand", "pos0")
    if fits_broadcast(idx, INDEX_BROADCAST):
        reads = reads.where(F.length("seq") >= k).where(_may_match(idx, k)(F.upper("seq")))
        idx = F.broadcast(idx)
    rk = reads.where(F.length("seq") >= k).select(*READ, F.upper("seq").alias("seq"), F.length("seq").alias("length"),
                                                  F.explode(F.sequence(F.lit(0), F.length("seq") - k)).alias("i"))
    rk = rk.select(*READ, "length", "i", F.expr(f"substring(seq, i + 1, {k})").alias("kmer")).where(~F.col("kmer").contains("N"))
    # from here on all rows of a read are in one task: the aggregations and the join need no further shuffle
    hits = rk.join(idx, "kmer").select(*READ, "length", "i", "tx", "strand", (F.col("pos0") - F.col("i")).alias("start")) \
        .repartition(*READ)
    per_tx = hits.groupBy(*READ, "length", "tx", "strand", "i").agg(F.min("start").alias("start")) \
        .groupBy(*READ, "length", "tx", "strand").agg(F.count(F.lit(1)).alias("_n"), F.min("start").alias("start"))
    per_read = hits.groupBy(*READ, "i").agg(F.first("length").alias("_l")).groupBy(*READ).agg(F.count(F.lit(1)).alias("_m"))
    return per_tx.join(per_read, READ).where(F.col("_n") == F.col("_m")).drop("_n", "_m")


def fragments(maps: DataFrame, transcripts: DataFrame, *, paired: bool) -> DataFrame:
    """(sample, read_id, tx, sense, fragment): each compatible transcript; ``sense`` is the orientation of mate 1 (or of
    the read), ``fragment`` the length between the outer ends of two mates.

    Pairs count where both mates lie inward on one transcript; where one mate has no compatible transcript at all,
    the other one counts alone (without a fragment length)."""
    if not paired:
        return maps.select("sample", "read_id", "tx", F.col("strand").alias("sense"), F.lit(None).cast("bigint").alias("fragment"))
    lengths = transcripts.select("tx", F.col("length").alias("_len"))
    m = maps.join(F.broadcast(lengths) if fits_broadcast(lengths, INDEX_BROADCAST) else lengths, "tx")
    # where the read's outer end is on the forward strand
    outer = F.when(F.col("strand") == "+", F.col("start")).otherwise(F.col("_len") - F.col("start"))
    m = m.select("sample", "read_id", "mate", "tx", "strand", "length", outer.alias("outer")).repartition("sample", "read_id")

    def side(mate: int, strand: str) -> Column:
        return F.max(F.when((F.col("mate") == mate) & (F.col("strand") == strand), F.struct("outer", "length")))

    both = m.groupBy("sample", "read_id", "tx").agg(side(1, "+").alias("f1"), side(2, "-").alias("r2"),
                                                    side(1, "-").alias("r1"), side(2, "+").alias("f2"))

    def pair(fwd: str, rev: str, sense: str) -> Column:
        size = F.col(f"{rev}.outer") - F.col(f"{fwd}.outer")
        ok = size >= F.greatest(F.col(f"{fwd}.length"), F.col(f"{rev}.length"))
        return F.when(ok, F.struct(F.lit(sense).alias("sense"), size.cast("bigint").alias("fragment")))

    paired_rows = both.select("sample", "read_id", "tx", F.explode(F.array_compact(F.array(pair("f1", "r2", "+"), pair("f2", "r1", "-"))))
                              .alias("_p")).select("sample", "read_id", "tx", "_p.sense", "_p.fragment")
    mates = m.groupBy("sample", "read_id").agg(F.count_distinct("mate").alias("_k"))
    alone = m.join(mates.where(F.col("_k") == 1), ["sample", "read_id"])
    turned = F.when(F.col("strand") == "+", F.lit("-")).otherwise(F.lit("+"))
    alone = alone.select("sample", "read_id", "tx", F.when(F.col("mate") == 1, F.col("strand")).otherwise(turned).alias("sense"),
                         F.lit(None).cast("bigint").alias("fragment"))
    return paired_rows.unionByName(alone)


def library_types(frags: DataFrame, *, paired: bool) -> DataFrame:
    """(sample, forward, reverse, library_type): fragments that map in one orientation only, and the type that follows: stranded
    (SF, SR) when at least ``STRANDED`` of them agree, else U; pairs have an I before it."""
    per = frags.groupBy("sample", "read_id").agg(F.min("sense").alias("a"), F.max("sense").alias("b")).where(F.col("a") == F.col("b"))
    n = per.groupBy("sample").agg(F.count_if(F.col("a") == "+").alias("forward"), F.count_if(F.col("a") == "-").alias("reverse"))
    share = F.col("forward") / (F.col("forward") + F.col("reverse"))
    kind = F.when(share >= STRANDED, "SF").when(share <= 1 - STRANDED, "SR").otherwise("U")
    return n.select("sample", "forward", "reverse", F.concat(F.lit("I" if paired else ""), kind).alias("library_type"))


def strand_compatible(frags: DataFrame, types: DataFrame) -> DataFrame:
    """The mappings whose orientation agrees with their sample's library type."""
    f = frags.join(F.broadcast(types.select("sample", "library_type")), "sample")  # one row per sample
    kind = F.regexp_replace("library_type", "^I", "")
    return f.where((kind == "U") | ((kind == "SF") & (F.col("sense") == "+")) | ((kind == "SR") & (F.col("sense") == "-")))


def fragment_lengths(frags: DataFrame, *, longest: int = MAX_FRAGMENT) -> DataFrame:
    """(sample, fragment, n): lengths of the fragments that one transcript alone explains."""
    alone = frags.groupBy("sample", "read_id").agg(F.count(F.lit(1)).alias("_n"), F.max("fragment").alias("fragment"))
    return alone.where((F.col("_n") == 1) & (F.col("fragment") <= longest)).groupBy("sample", "fragment").agg(F.count(F.lit(1)).alias("n"))


def _assumed_lengths(samples: DataFrame, mean: float, sd: float, longest: int = MAX_FRAGMENT) -> DataFrame:
    p = [(i, math.exp(-((i - mean) / sd) ** 2 / 2)) for i in range(1, longest + 1)]
    table = F.array(*[F.struct(F.lit(i).cast("bigint").alias("fragment"), F.lit(v).alias("n")) for i, v in p if v > 1e-12])
    return samples.select("sample", F.inline(table))


def effective_lengths(lengths: DataFrame, distribution: DataFrame) -> DataFrame:
    """(sample, tx, length, eff_length): length less the mean of the fragments that fit in it, plus one; at least 1.

    ``distribution`` has at most ``MAX_FRAGMENT`` rows per sample and travels as two running sums."""
    per = distribution.groupBy("sample").agg(F.sort_array(F.collect_list(F.struct("fragment", F.col("n").cast("double").alias("n")))).alias("d"))
    top = F.lit(MAX_FRAGMENT)
    fit = F.filter("d", lambda x: x["fragment"] <= F.least(F.col("length"), top))
    weight = F.aggregate("_fit", F.lit(0.0), lambda a, x: a + x["n"])
    mass = F.aggregate("_fit", F.lit(0.0), lambda a, x: a + x["n"] * x["fragment"])
    kinds = lengths.select("length").distinct().join(F.broadcast(per))  # different lengths x samples, not transcripts
    eff = kinds.withColumn("_fit", fit).select("sample", "length", F.greatest(
        F.when(weight > 0, F.col("length") - mass / weight + 1).otherwise(F.col("length").cast("double")), F.lit(1.0)).alias("eff_length"))
    return lengths.join(eff, "length").select("sample", "tx", "length", "eff_length")


def equivalence_classes(frags: DataFrame) -> DataFrame:
    """(sample, ec, count): fragments per sorted set of compatible transcripts (an array of ids)."""
    ec = frags.groupBy("sample", "read_id").agg(F.sort_array(F.collect_set("tx")).alias("ec"))
    return ec.groupBy("sample", "ec").agg(F.count(F.lit(1)).alias("count"))


def _em(ecs: DataFrame, effective: DataFrame, iterations: int) -> tuple[DataFrame, bool]:
    """(sample, tx, eff_length, num_reads), and whether the largest change of a share fell below ``CONVERGED``."""
    ecs = ecs.withColumn("_ec", F.monotonically_increasing_id()).checkpoint()
    members = ecs.select("sample", "_ec", "count", F.explode("ec").alias("tx")) \
        .join(effective.select("sample", "tx", "eff_length"), ["sample", "tx"]).checkpoint()
    totals = F.broadcast(ecs.groupBy("sample").agg(F.sum("count").alias("_total")))  # one row per sample
    alpha = members.select("sample", "tx").distinct().withColumn("alpha", F.lit(1.0))
    for it in range(1, iterations + 1):
        w = members.join(alpha, ["sample", "tx"]).withColumn("_w", F.col("alpha") / F.col("eff_length"))
        den = w.groupBy("sample", "_ec").agg(F.sum("_w").alias("_den"))
        n = w.join(den, ["sample", "_ec"]).groupBy("sample", "tx", "eff_length").agg(
            F.max("alpha").alias("_old"), F.sum(F.col("count") * F.col("_w") / F.col("_den")).alias("num_reads"))
        new = n.join(totals, "sample").withColumn("alpha", F.col("num_reads") / F.col("_total"))
        if it % CHECKPOINT_EVERY == 0 or it == iterations:
            new = new.checkpoint()
            change = new.agg(F.max(F.abs(F.col("alpha") - F.col("_old")))).first()[0]
            if change is None or change < CONVERGED:
                return new, True
        alpha = new.select("sample", "tx", "alpha")
    return new, False


def _long(reads: DataFrame) -> tuple[DataFrame, bool]:
    """Reads (sample, read_id, seq) or pairs (sample, pair_id, seq1, seq2) as (sample, read_id, mate, seq)."""
    if "seq2" in reads.columns:
        mates = F.array(*[F.struct(F.lit(k).alias("mate"), F.col(f"seq{k}").alias("seq")) for k in (1, 2)])
        return reads.select("sample", F.col("pair_id").alias("read_id"), F.inline(mates)), True
    return reads.select("sample", "read_id", F.lit(1).alias("mate"), "seq"), False


def mapped_fragments(reads: DataFrame, transcripts: DataFrame, *, k: int = QUANT_K) -> DataFrame:
    """``fragments`` of reads or pairs, whatever their orientation."""
    long, paired = _long(reads)
    tx = _numbered(transcripts)
    return fragments(mappings(long, tx, k=k), tx, paired=paired)


def mapping_rates(reads: DataFrame, frags: DataFrame, types: DataFrame, *, k: int = QUANT_K) -> DataFrame:
    """(sample, reads, short, unmapped, other_strand, mapped, library_type): where every read (or pair) went.  ``short``: no
    mate has ``k`` bases; ``other_strand``: only mappings that the library type rules out."""
    long, _ = _long(reads)
    per = long.groupBy("sample", "read_id").agg(F.max(F.coalesce(F.length("seq"), F.lit(0)) >= k).alias("_long"))
    some = frags.select("sample", "read_id").distinct().withColumn("_some", F.lit(True))
    good = strand_compatible(frags, types).select("sample", "read_id").distinct().withColumn("_good", F.lit(True))
    j = per.join(some, ["sample", "read_id"], "left").join(good, ["sample", "read_id"], "left")
    out = j.groupBy("sample").agg(
        F.count(F.lit(1)).alias("reads"), F.count_if(~F.col("_long")).alias("short"),
        F.count_if(F.col("_long") & F.col("_some").isNull()).alias("unmapped"),
        F.count_if(F.col("_some").isNotNull() & F.col("_good").isNull()).alias("other_strand"),
        F.count_if(F.col("_good").isNotNull()).alias("mapped"))
    return out.join(F.broadcast(types.select("sample", "library_type")), "sample", "left")


def quantify_transcripts(reads: DataFrame, transcripts: DataFrame, *, k: int = QUANT_K, iterations: int = EM_ITERATIONS,
                         library: str = "A", fragment_mean: float = FRAGMENT_MEAN, fragment_sd: float = FRAGMENT_SD) -> DataFrame:
    """A2: (sample, transcript, length, eff_length, num_reads, tpm, library_type, converged) for transcripts with reads.

    ``reads`` are single (sample, read_id, seq) or pairs (sample, pair_id, seq1, seq2).  ``library`` 'A' infers each sample's
    type, any other value sets it for all.  Effective lengths come from the fragments that one transcript explains; for
    single reads, and samples without such fragments, from a normal distribution.  ``converged`` is false where
    ``iterations`` rounds did not bring the largest change below ``CONVERGED``."""
    ensure_checkpoint_dir(reads.sparkSession)
    paired = "seq2" in reads.columns
    tx = _numbered(transcripts)
    frags = mapped_fragments(reads, transcripts, k=k).checkpoint()
    types = library_types(frags, paired=paired)
    if library != "A":
        types = types.withColumn("library_type", F.lit(library))
    types = types.checkpoint()
    frags = strand_compatible(frags, types)
    seen = fragment_lengths(frags) if paired else None
    samples = types.select("sample")
    assumed = _assumed_lengths(samples if seen is None else samples.join(seen.select("sample").distinct(), "sample", "left_anti"),
                               fragment_mean, fragment_sd)
    distribution = assumed if seen is None else seen.withColumn("n", F.col("n").cast("double")).unionByName(assumed)
    effective = effective_lengths(tx.select("tx", "length"), distribution)
    found, done = _em(equivalence_classes(frags), effective, iterations)
    q = found.where(F.col("num_reads") > 0).join(tx.select("tx", F.col("name").alias("transcript"), "length"), "tx")
    rate = F.col("num_reads") / F.col("eff_length")
    tot = F.broadcast(q.groupBy("sample").agg(F.sum(rate).alias("_rt")))
    return q.join(tot, "sample").join(F.broadcast(types.select("sample", "library_type")), "sample").select(
        "sample", "transcript", "length", F.round("eff_length", 6).alias("eff_length"), F.round("num_reads", 6).alias("num_reads"),
        F.round(rate / F.col("_rt") * 1e6, 6).alias("tpm"), "library_type", F.lit(done).alias("converged"))
