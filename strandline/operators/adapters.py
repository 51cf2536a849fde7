"""Adapters: gapped trimming with sets of adapters per mate, and what the overlap of two mates tells.

Both scans are Arrow-batched numpy kernels over length-sorted matrices of bounded size; reads never move.  An adapter
set is checked for its size before it travels with the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from strandline.operators.trim import ADAPTER_ERROR_RATE, ADAPTER_MIN_OVERLAP
from strandline.sources.readers import read_fasta

MAX_ADAPTERS = 10_000  # an adapter file beyond this raises
CHUNK_BYTES = 1 << 22
OVERLAP_MIN = 30
OVERLAP_MAX_MISMATCHES = 5
OVERLAP_MISMATCH_RATE = 0.2

Adapters = list[tuple[str, str]]


def load_adapters(spark: SparkSession, spec: str | Adapters | None) -> Adapters:
    """(name, bases) of an adapter setting: nothing, the bases themselves, or ``file:`` and the path of a FASTA file."""
    if not spec:
        return []
    if not isinstance(spec, str):
        return [(n, s.upper()) for n, s in spec]
    if not spec.startswith("file:"):
        return [("1", spec.upper())]
    rows = read_fasta(spark, spec[5:]).select("name", "seq").limit(MAX_ADAPTERS + 1).collect()
    if len(rows) > MAX_ADAPTERS:
        raise ValueError(f"more than {MAX_ADAPTERS} adapters in {spec}")
    return sorted((r["name"], r["seq"].upper()) for r in rows)


def _matrices(text: list[str], rows: int = 4096) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(positions, upper-case bytes padded with 0, lengths) of strings of similar length."""
    n = np.fromiter(map(len, text), dtype=np.int64, count=len(text))
    order = np.argsort(n, kind="stable")
    at = 0
    while at < len(order):
        longest = max(1, int(n[order[min(len(order), at + rows) - 1]]))
        idx = order[at:at + max(1, min(rows, CHUNK_BYTES // longest))]
        width = max(1, int(n[idx].max()))
        m = np.zeros((len(idx), width), dtype=np.uint8)
        m[np.arange(width)[None, :] < n[idx][:, None]] = np.frombuffer(
            "".join(text[i] for i in idx).upper().encode("ascii", "replace"), dtype=np.uint8)
        yield idx, m, n[idx]
        at += len(idx)


# An alignment's rank: most matched adapter bases (aligned bases - errors), then fewest errors, then the
# smallest start; as one integer, smaller is better.
_BASES, _ERRORS = 40, 32
_NONE = np.iinfo(np.int64).max


def _gapped(m: np.ndarray, n: np.ndarray, probe: np.ndarray, allowed: np.ndarray, min_overlap: int,
            indels: bool) -> np.ndarray:
    """Rank of each read's best alignment with the adapter, whole or (at the read's end) a prefix of it.

    Row i of the state holds, for the first i adapter bases ending at the current read position, the fewest
    errors and with them the smallest start, as ``errors << shift | start``."""
    size, width = len(probe), m.shape[1]
    if indels and width < 1 << 9 and size < 60:  # never more errors than adapter bases and one
        kind, shift = np.int16, 9
    else:
        kind, shift = (np.int32, 16) if width < 1 << 16 and size < 1 << 14 else (np.int64, 32)
    one, low = kind(1 << shift), kind((1 << shift) - 1)
    ramp = (np.arange(size + 1, dtype=kind) * one)[:, None]
    state = np.repeat(ramp, len(m), axis=1)
    if not indels:
        state[1:] += one * kind(1 << 12)  # adapter bases before the read
    best, spare = np.full(len(m), _NONE, dtype=np.int64), np.empty(len(m), dtype=kind)

    def offer(rows, i, cells):
        errors, start = (cells >> shift).astype(np.int64), (cells & low).astype(np.int64)
        ok = errors <= allowed[i]
        rank = (((1 << 20) - (i - errors)) << _BASES) | (errors << _ERRORS) | start
        best[rows[ok]] = np.minimum(best[rows[ok]], rank[ok])

    every = np.arange(len(m))
    wild = (probe == ord("N"))[:, None]
    for e in range(1, width + 1):
        wrong = (m[:, e - 1][None, :] != probe[:, None]) & ~wild
        new = np.empty_like(state)
        new[0] = e
        np.add(state[:-1], wrong * one, out=new[1:])
        if indels:
            np.minimum(new[1:], state[1:] + one, out=new[1:])
            for i in range(1, size + 1):  # row by row over all reads, faster than accumulating down the columns
                np.minimum(new[i], np.add(new[i - 1], one, out=spare), out=new[i])
        state = new
        if size >= min_overlap:
            live = every[n >= e]
            offer(live, size, state[size, live])
        ended = every[n == e]
        if len(ended):
            for i in range(min_overlap, size):
                offer(ended, i, state[i, ended])
    return best


def _reversed(m: np.ndarray, n: np.ndarray) -> np.ndarray:
    at = np.arange(m.shape[1])[None, :]
    return np.where(at < n[:, None], np.take_along_axis(m, np.clip(n[:, None] - 1 - at, 0, None), axis=1), 0).astype(np.uint8)


def _cuts(text: list[str], adapters: Adapters, mode: str, min_overlap: int, error_rate: float, indels: bool) -> np.ndarray:
    """(first, last, adapter, errors) of each read: the bases that stay, and the adapter found (-1: none)."""
    out = np.zeros((len(text), 4), dtype=np.int64)
    out[:, 1], out[:, 2] = [len(t) for t in text], -1
    sides = {"a": (1,), "g": (-1,), "b": (1, -1)}[mode]
    for idx, m, n in _matrices(text):
        settled = np.full(len(idx), _NONE, dtype=np.int64)
        for side in sides:
            own = m if side > 0 else _reversed(m, n)
            best, which = np.full(len(idx), _NONE, dtype=np.int64), np.full(len(idx), -1)
            for k, (_, bases) in enumerate(adapters):
                probe = np.frombuffer(bases[::side].encode("ascii"), dtype=np.uint8)
                allowed = np.array([min(255, int(i * error_rate)) for i in range(len(probe) + 1)])
                rank = _gapped(own, n, probe, allowed, min_overlap, indels)
                which = np.where(rank < best, k, which)
                best = np.minimum(best, rank)
            better = (best >> _ERRORS) < (settled >> _ERRORS)  # on equal terms the 3' end stays
            settled[better] = best[better]
            start = best[better] & 0xFFFFFFFF
            out[idx[better], 0], out[idx[better], 1] = (0, start) if side > 0 else (n[better] - start, n[better])
            out[idx[better], 2], out[idx[better], 3] = which[better], (best[better] >> _ERRORS) & 0xFF
    return out


def _cut_udf(fwd: Adapters, rev: Adapters, mode: str, min_overlap: int, error_rate: float, indels: bool):
    @pandas_udf("first int, last int, adapter int, errors int")
    def cut(seqs: pd.Series, mates: pd.Series) -> pd.DataFrame:
        text = seqs.fillna("")
        out = np.zeros((len(text), 4), dtype=np.int32)
        for mate, adapters in ((1, fwd), (2, rev)):
            own = np.flatnonzero((mates == mate).to_numpy())
            out[own] = _cuts(text.iloc[own].tolist(), adapters, mode, min_overlap, error_rate, indels)
        return pd.DataFrame(out, columns=["first", "last", "adapter", "errors"], index=text.index)
    return cut


def trim_adapters(reads: DataFrame, fwd: str | Adapters | None, rev: str | Adapters | None = None, *, mode: str = "b",
                  min_overlap: int = ADAPTER_MIN_OVERLAP, error_rate: float = ADAPTER_ERROR_RATE,
                  indels: bool = True) -> DataFrame:
    """Trims with a set of adapters in one pass over the reads, allowing substitutions, insertions and deletions.

    ``fwd`` and ``rev`` are settings as in ``load_adapters``; where the reads have a column ``mate``, mate 2 is trimmed
    with ``rev``, all others with ``fwd``.  An adapter matches where it aligns as a whole, or its first bases align with
    the read's end, at least ``min_overlap`` of its bases with at most ``error_rate`` errors each.  Mode 'a' cuts from
    the match to the 3' end; 'g' is the same seen from the 5' end; 'b' takes the better of both.  Of all matches the one
    with the most matched bases counts, then fewest errors, the 3' side, the earliest start (seen from the side's far end),
    the adapter listed first.  N in an adapter matches every base.  Adds ``adapter`` (name or null) and ``adapter_errors``
    (0 without an adapter).

    Work per read is length x adapter length for each adapter."""
    if mode not in ("a", "g", "b"):
        raise ValueError("mode must be 'a', 'g' or 'b'")
    spark = reads.sparkSession
    one, two = load_adapters(spark, fwd), load_adapters(spark, rev)
    mated = "mate" in reads.columns
    if two and not mated:
        raise ValueError("adapters for mate 2 need a column mate")
    mate = F.when(F.col("mate") == 2, 2).otherwise(1) if mated else F.lit(1)
    others = [c for c in reads.columns if c not in ("seq", "qual", "adapter", "adapter_errors")]
    d = reads.withColumn("_cut", _cut_udf(one, two, mode, min_overlap, error_rate, indels)(F.col("seq"), mate.cast("int")))
    at, length = (F.col("_cut.first") + 1).cast("int"), F.greatest(F.col("_cut.last") - F.col("_cut.first"), F.lit(0)).cast("int")
    name = _name(one, mate == 1) if not two else F.coalesce(_name(one, mate == 1), _name(two, mate == 2))
    cut = F.struct(F.substring("seq", at, length).alias("seq"), F.substring("qual", at, length).alias("qual"),
                   name.alias("adapter"), F.col("_cut.errors").alias("adapter_errors"))
    return d.select(*others, F.inline(F.array(cut)))  # generator outputs are not recomputed by filters stacked on them


def _name(adapters: Adapters, mine: Column) -> Column:
    names = F.array(*[F.lit(n) for n, _ in adapters]) if adapters else F.array(F.lit(None).cast("string"))
    return F.when(mine & (F.col("_cut.adapter") >= 0), F.get(names, F.col("_cut.adapter")))


def adapter_summary(before: DataFrame, trimmed: DataFrame) -> DataFrame:
    """T1 report: per sample and adapter, reads cut and bases removed (``before`` and ``trimmed`` share sample, read_id and
    mate where they have one)."""
    key = [c for c in ("sample", "read_id", "mate") if c in before.columns and c in trimmed.columns]
    b = before.select(*key, F.length("seq").alias("_before"))
    t = trimmed.where(F.col("adapter").isNotNull()).select(*key, "adapter", F.length("seq").alias("_after"))
    return t.join(b, key).groupBy("sample", "adapter").agg(
        F.count(F.lit(1)).alias("reads"), F.sum(F.col("_before") - F.col("_after")).cast("bigint").alias("bases_removed"))


# ---------------------------------------------------------------- mates


def reverse_complement(seq: str | Column) -> Column:
    return F.reverse(F.translate(F.upper(seq), "ACGT", "TGCA"))


def _overlap_kernel(m: np.ndarray, n: np.ndarray, r: np.ndarray, k: np.ndarray, min_overlap: int, max_mismatches: int,
                    rate: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Insert length, overlap and mismatches of each pair (-1: none); ``r`` is the other mate's reverse complement, aligned right."""
    best = np.full(len(m), -1, dtype=np.int64)
    insert, over, wrong = (np.full(len(m), -1, dtype=np.int64) for _ in range(3))
    w1, w2 = m.shape[1], r.shape[1]
    for size in range(min_overlap, w1 + w2 - min_overlap + 1):  # position p of mate 1 meets column w2 - size + p
        lo, hi = max(0, size - w2), min(w1, size)
        a, b = m[:, lo:hi], r[:, w2 - size + lo:w2 - size + hi]
        overlap = np.minimum(n, size) - np.maximum(0, size - k)
        miss = ((a != b) & (a > 0) & (b > 0)).sum(axis=1)
        ok = (overlap >= min_overlap) & (miss <= np.minimum(max_mismatches, np.floor(overlap * rate)))
        score = overlap - 2 * miss
        ok &= score > best
        best[ok], insert[ok], over[ok], wrong[ok] = score[ok], size, overlap[ok], miss[ok]
    return insert, over, wrong


def _overlap_udf(min_overlap: int, max_mismatches: int, rate: float):
    @pandas_udf("insert_length int, overlap int, mismatches int")
    def find(one: pd.Series, two: pd.Series) -> pd.DataFrame:
        a, b = one.fillna("").tolist(), two.fillna("").tolist()
        out = np.full((len(a), 3), -1, dtype=np.int64)
        for idx, m, n in _matrices(a):
            other = [b[i][::-1] for i in idx]
            k = np.array([len(x) for x in other])
            rows = max(1, min(len(idx), CHUNK_BYTES // max(1, int(k.max()))))
            for lo in range(0, len(idx), rows):
                width = max(1, int(k[lo:lo + rows].max()))
                r = np.zeros((len(k[lo:lo + rows]), width), dtype=np.uint8)
                r[np.arange(width)[None, :] < k[lo:lo + rows, None]] = np.frombuffer(
                    "".join(other[lo:lo + rows]).encode("ascii", "replace"), dtype=np.uint8)
                found = _overlap_kernel(m[lo:lo + rows], n[lo:lo + rows], r[:, ::-1], k[lo:lo + rows], min_overlap, max_mismatches, rate)
                out[idx[lo:lo + rows]] = np.stack(found, axis=1)
        names = ["insert_length", "overlap", "mismatches"]
        table = pd.DataFrame(out, columns=names, index=one.index)
        return table.astype("Int32").where(table >= 0)
    return find


def mate_overlap(pairs: DataFrame, *, min_overlap: int = OVERLAP_MIN, max_mismatches: int = OVERLAP_MAX_MISMATCHES,
                 mismatch_rate: float = OVERLAP_MISMATCH_RATE) -> DataFrame:
    """Each pair (``seq1``, ``seq2``) with the length of its insert where the mates overlap.

    Every shift of mate 1 against mate 2's reverse complement with ``min_overlap`` common positions and at most
    ``max_mismatches`` (and ``mismatch_rate`` of them) mismatches is an overlap; the one with the most matches less mismatches
    counts, then the shortest insert.  Adds ``insert_length``, ``overlap`` and ``mismatches``, null without overlap."""
    find = _overlap_udf(min_overlap, max_mismatches, mismatch_rate)
    found = pairs.withColumn("_o", find(F.upper("seq1"), reverse_complement("seq2")))
    others = [c for c in pairs.columns if c not in ("insert_length", "overlap", "mismatches")]
    return found.select(*others, F.inline(F.array("_o")))


def trim_by_overlap(pairs: DataFrame, **options) -> DataFrame:
    """Mates cut to their insert where it is shorter than they are: what sticks out is adapter."""
    o = mate_overlap(pairs, **options)

    def cut(c, seq):
        return F.when(F.col("insert_length") < F.length(seq), F.substring(F.col(c), F.lit(1), F.col("insert_length"))) \
            .otherwise(F.col(c)).alias(c)

    others = [c for c in pairs.columns if c not in ("seq1", "qual1", "seq2", "qual2")]
    return o.select(*others, cut("seq1", "seq1"), cut("qual1", "seq1"), cut("seq2", "seq2"), cut("qual2", "seq2"), "insert_length")


def paired_adapters(pairs: DataFrame, *, min_share: float = 0.5, min_reads: int = 10, **options) -> DataFrame:
    """Per sample and mate, the adapter that sticks out past the insert: base by base the most frequent one, up
    to the first position that fewer than ``min_reads`` tails reach or where it has no more than ``min_share`` of them.

    Tails become counts per position and base at once, so what moves is a few rows per sample, mate and position."""
    o = mate_overlap(pairs, **options)
    tails = None
    for mate in (1, 2):
        seq = F.upper(F.col(f"seq{mate}"))
        own = o.where(F.col("insert_length") < F.length(seq)).select(
            "sample", F.lit(mate).alias("mate"), F.posexplode(F.split(F.expr(f"substring(upper(seq{mate}), insert_length + 1)"), "")).alias("position", "base"))
        tails = own if tails is None else tails.unionByName(own)
    n = tails.groupBy("sample", "mate", "position", "base").agg(F.count(F.lit(1)).alias("n"))
    at = n.groupBy("sample", "mate", "position").agg(F.sum("n").alias("reads"), F.min(F.struct(-F.col("n"), "base")).alias("top"))
    good = (F.col("reads") >= min_reads) & (-F.col("top.col1") > F.lit(min_share) * F.col("reads"))
    rows = at.groupBy("sample", "mate").agg(  # at most one row per read position
        F.sort_array(F.collect_list(F.struct("position", "reads", F.col("top.base").alias("base"), good.alias("good")))).alias("p"))
    stop = F.coalesce(F.array_min(F.transform(F.filter("p", lambda x: ~x["good"]), lambda x: x["position"])), F.size("p"))
    bases = F.transform(F.filter("p", lambda x: x["position"] < F.col("stop")), lambda x: x["base"])
    return rows.withColumn("stop", stop).select("sample", "mate", F.array_join(bases, "").alias("adapter"),
                                                F.get("p", F.lit(0))["reads"].alias("reads"))
