"""Plans that have to stay bounded on large tables."""

import contextlib
import io
import random

import pytest
from pyspark.sql import functions as F

from strandline.operators import coverage as V
from strandline.operators import dge as D
from strandline.operators import quant as QU


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


ALIGNMENTS = "sample string, frag_id long, ref string, pos long, cigar string, flag int"


@pytest.mark.parametrize("operator", [V.gene_body_coverage, V.transcript_body_coverage])
def test_points_of_genes_are_not_broadcast(spark, operator):
    aln = spark.createDataFrame([("s", 1, "c", 11, "50M", 0), ("s", 2, "c", 41, "20M", 0), ("s", 3, "c", 900, "20M", 0)], ALIGNMENTS)
    genes = spark.createDataFrame([("c", "gene", 1, 100, "+", "a"), ("c", "gene", 901, 1000, "-", "b")],
                                  "seqid string, type string, start_pos long, end_pos long, strand string, gene_id string")
    out = operator(aln, genes)
    assert "BroadcastHashJoin" not in plan(out)
    depth = {p: (11 <= p <= 60) + (41 <= p <= 60) + (900 <= p <= 919) for p in range(1, 1001)}
    want = {k + 1: depth[1 + k] + depth[1000 - k] for k in range(100)}  # genes of 100 bases: every base is a point
    assert {r.percentile: r.coverage for r in out.collect()} == {k: v for k, v in want.items() if v}


@pytest.mark.parametrize("operator", [V.gene_body_coverage, V.transcript_body_coverage])
def test_points_of_genes_from_files_are_not_broadcast(spark, tmp_path, operator):
    """Of tables in files Spark estimates sizes, without the rows that points add."""
    spark.createDataFrame([("s", 1, "c", 11, "50M", 0), ("s", 2, "c", 41, "20M", 0), (None, 3, "c", 90, "20M", 0), ("s", 4, None, 1, "9M", 0)],
                          ALIGNMENTS).write.parquet(f"{tmp_path}/aln")
    spark.createDataFrame([("c", "gene", 1, 100, "+", "a"), ("c", "gene", 1, 100, "+", "b"), (None, "gene", 1, 100, "+", "d")],
                          "seqid string, type string, start_pos long, end_pos long, strand string, gene_id string").write.parquet(f"{tmp_path}/genes")
    out = operator(spark.read.parquet(f"{tmp_path}/aln"), spark.read.parquet(f"{tmp_path}/genes"))
    assert "BroadcastHashJoin" not in plan(out) and "SortMergeJoin" in plan(out)
    want = {("s", p): 2 * ((11 <= p <= 60) + (41 <= p <= 60)) for p in range(11, 61)} | {(None, p): 2 for p in range(90, 101)}
    assert {(r.sample, r.percentile): r.coverage for r in out.collect()} == want


def test_compact_track_needs_no_window_over_all_tiles(spark, monkeypatch):
    """Runs over no, two and many tiles at each level, against a plain loop."""
    monkeypatch.setattr(V, "COMPACT_WIDER", 4)
    rng = random.Random(7)
    rows = [("s" if c else None, f"c{c}", b * 10, b * 10 + 10, rng.choice([1, 1, 1, 2]) if b % 90 < 45 else 5)
            for c in range(3) for b in range(400) if rng.random() < 0.9 or b % 90 >= 45]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "sample string, chrom string, start0 long, end long, count long")
    want = []
    for r in sorted(r for r in rows if r[0]):
        if want and want[-1][1] == r[1] and want[-1][3] == r[2] and want[-1][4] == r[4]:
            want[-1] = (*want[-1][:3], r[3], r[4])
        else:
            want.append(r)
    out = V.compact_track(df, tile=64)
    assert sorted(tuple(r) for r in out.select("sample", "chrom", "start0", "end", "count").collect()) == want
    assert "_carry" not in plan(out)  # no row per tile in one window of a chromosome


def test_adjusted_p_runs_from_one_end(spark):
    """A frame that is open towards the end is worked out anew for every row of a tile."""
    ps = [(i % 997 + 1) / 1000 for i in range(3000)]
    df = spark.createDataFrame([("c", f"g{i}", p) for i, p in enumerate(ps)], "contrast string, gene_id string, pvalue double")
    out = D.adjust_p(df)
    assert "currentrow$(),unboundedfollowing" not in plan(out).lower().replace(" ", "")
    order = sorted(ps)
    want, low = {}, 1.0
    for i in range(len(order), 0, -1):
        low = min(low, len(order) * order[i - 1] / i)
        want[order[i - 1]] = low
    assert all(abs(r.padj - want[r.pvalue]) < 1e-12 for r in out.collect())


@pytest.mark.parametrize("limit", [QU.INDEX_BROADCAST, 0])
def test_reads_without_an_index_kmer_are_not_cut_into_kmers(spark, monkeypatch, limit):
    """The same mappings with the hashes looked up first and without."""
    monkeypatch.setattr(QU, "INDEX_BROADCAST", limit)
    rng = random.Random(3)
    t = ["".join(rng.choice("ACGT") for _ in range(200)) for _ in range(2)]
    seqs = [t[0][20:90], t[1][5:60].lower(), t[0][:31], t[0][:30], "", None, "N" * 50, "".join(rng.choice("ACGT") for _ in range(80)),
            "é" * 40, "T" + t[1][-31:]]
    reads = spark.createDataFrame([("s", f"r{i}", 1, x) for i, x in enumerate(seqs)], "sample string, read_id string, mate int, seq string")
    tx = QU._numbered(spark.createDataFrame([("a", t[0]), ("b", t[1])], "name string, seq string"))
    out = QU.mappings(reads, tx)
    names = {r.tx: r.name for r in tx.collect()}
    assert {(r.read_id, names[r.tx], r.strand, r.start) for r in out.collect()} == {
        ("r0", "a", "+", 20), ("r1", "b", "+", 5), ("r2", "a", "+", 0), ("r9", "b", "+", 168)}
    if limit:
        idx = spark.createDataFrame([(t[0][i:i + 31],) for i in range(170)], "kmer string")
        kept = reads.where(F.length("seq") >= 31).where(QU._may_match(idx, 31)(F.upper("seq")))
        assert {r.read_id for r in kept.collect()} == {"r0", "r2"}
