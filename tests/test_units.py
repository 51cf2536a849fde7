"""Hand-computed micro cases and brute-force checks for the library's building blocks."""

import math
import random

import pytest
from pyspark.sql import functions as F

from strandline.functions.alignment import cigar_blocks, junctions, reference_span, unclipped_five_prime
from strandline.operators import alignment as AL
from strandline.operators import counting as C
from strandline.operators import coverage as V
from strandline.operators import dge as D
from strandline.operators import screen as SC
from strandline.operators import strand as S
from strandline.operators import trim as T
from strandline.operators.intervals import depth_segments, overlap_join
from strandline.operators.prefix import running_offset
from strandline.sources.annotation import parse_annotation_lines


def test_cigar_blocks_and_spans(spark):
    df = spark.createDataFrame([(100, "10M5N10M"), (100, "3S10M2D5M4S"), (7, "5M2I5M"), (1, "4H6M")],
                               "pos long, cigar string")
    out = df.select(cigar_blocks().alias("b"), reference_span().alias("span"), junctions().alias("j")).collect()
    assert [(x.start, x.end) for x in out[0].b] == [(100, 109), (115, 124)]
    assert out[0].span == 25 and [(x.start, x.end) for x in out[0].j] == [(110, 114)]
    assert [(x.start, x.end) for x in out[1].b] == [(100, 116)]
    assert [(x.start, x.end) for x in out[2].b] == [(7, 16)]
    assert [(x.start, x.end) for x in out[3].b] == [(1, 6)]


def test_unclipped_five_prime(spark):
    df = spark.createDataFrame([(100, "3S10M", 0), (100, "10M4S", 16), (100, "2H3S10M", 0)],
                               "pos long, cigar string, flag int")
    got = [r[0] for r in df.select(unclipped_five_prime()).collect()]
    assert got == [97, 113, 95]


def test_gff_parsing_edge_cases(spark):
    lines = ["##gff-version 3", "# comment",
             "c1\tsrc\tgene\t1\t10\t.\t+\t.\tID=g1;Name=a%20b;Note=x=y;",
             "c1\tsrc\tgene\t5\t20\t.\t-\t.\tID=g2;ID=g2b;Name=p+q",
             "##FASTA", ">c1", "ACGT"]
    g = parse_annotation_lines(spark.createDataFrame([(x,) for x in lines], "value string")).orderBy("start").collect()
    assert len(g) == 2
    assert g[0].attributes == {"ID": "g1", "Name": "a b", "Note": "x=y"}
    assert g[1].attributes["ID"] == "g2b" and g[1].attributes["Name"] == "p+q"
    gtf = ['c1\tsrc\texon\t1\t10\t.\t+\t.\tgene_id "G1"; transcript_id "T1";']
    t = parse_annotation_lines(spark.createDataFrame([(x,) for x in gtf], "value string"), fmt="gtf").first()
    assert t.attributes == {"gene_id": "G1", "transcript_id": "T1"}


def test_binned_overlap_join_equals_naive(spark):
    rnd = random.Random(7)
    a = [(i, "c%d" % rnd.randint(1, 2), s, s + rnd.randint(0, 60)) for i, s in
         ((i, rnd.randint(1, 500)) for i in range(300))]
    b = [(j, "c%d" % rnd.randint(1, 2), s, s + rnd.randint(0, 120)) for j, s in
         ((j, rnd.randint(1, 500)) for j in range(80))]
    A = spark.createDataFrame(a, "aid int, ac string, as_ long, ae long")
    B = spark.createDataFrame(b, "bid int, bc string, bs long, be long")
    for broadcast in (True, False):
        got = overlap_join(A, B, left_cols=("ac", "as_", "ae"), right_cols=("bc", "bs", "be"), bin_size=16,
                           broadcast_right=broadcast).select("aid", "bid").collect()
        want = {(x[0], y[0]) for x in a for y in b if x[1] == y[1] and x[2] <= y[3] and y[2] <= x[3]}
        assert sorted((r.aid, r.bid) for r in got) == sorted(want)  # each pair exactly once


def test_depth_segments_equal_brute_force(spark):
    rnd = random.Random(3)
    iv = [("s", "c", s, s + rnd.randint(0, 30)) for s in (rnd.randint(1, 300) for _ in range(120))]
    df = spark.createDataFrame(iv, "sample string, chrom string, start long, end long")
    seg = depth_segments(df, key_cols=["sample", "chrom"], tile=37).collect()
    got = {}
    for r in seg:
        for p in range(r.seg_start, r.seg_end + 1):
            got[p] = r.depth
    want = {}
    for _, _, s, e in iv:
        for p in range(s, e + 1):
            want[p] = want.get(p, 0) + 1
    assert got == want


def test_running_offset_equals_cumsum(spark):
    rows = [("a" if i % 3 else "b", i, (i * 7) % 5) for i in range(200)]
    df = spark.createDataFrame(rows, "g string, o long, n long")
    got = {(r.g, r.o): r.off for r in running_offset(df, ["g"], "o", "n", "off", tile=16).collect()}
    acc = {}
    for g, o, n in sorted(rows, key=lambda r: (r[0], r[1])):
        assert got[(g, o)] == acc.get(g, 0)
        acc[g] = acc.get(g, 0) + n


def _reads(spark, rows):
    return spark.createDataFrame([("S", f"r{i}", s, q) for i, (s, q) in enumerate(rows)],
                                 "sample string, read_id string, seq string, qual string")


def test_quality_trim_matches_bwa_scan(spark):
    def bwa(q, cut):
        s, mx, idx = 0, 0, len(q)
        for i in reversed(range(len(q))):
            s += cut - q[i]
            if s < 0:
                break
            if s > mx:
                mx, idx = s, i
        return idx
    rnd = random.Random(1)
    quals = ["".join(chr(33 + rnd.randint(2, 40)) for _ in range(rnd.randint(1, 40))) for _ in range(50)]
    df = _reads(spark, [("A" * len(q), q) for q in quals])
    got = {r.read_id: len(r.seq) for r in T.quality_trim_3p(df, 30).collect()}
    for i, q in enumerate(quals):
        assert got[f"r{i}"] == bwa([ord(c) - 33 for c in q], 30)


def test_adapter_and_n_trimming(spark):
    ad = "AGATCGGAAGAGC"
    rows = [("CCCCCCCCCC" + ad + "TTT", "I" * 26), ("CCCCCCCCCCAGATCG", "I" * 16), ("CCCCCCCCCCAGATC", "I" * 15),
            ("CCCCCCCCCCAGTTCGGAAGAGC", "I" * 23), ("NNACGTNN", "IIIIIIII")]
    df = _reads(spark, rows)
    got = {r.read_id: r.seq for r in T.trim_adapter(df, ad).collect()}
    assert got["r0"] == "C" * 10          # full adapter inside
    assert got["r1"] == "C" * 10          # 6-base partial at the end
    assert got["r2"] == "CCCCCCCCCCAGATC"  # 5 bases: below the minimum overlap
    assert got["r3"] == "C" * 10          # one mismatch in 13 bases is allowed
    assert T.trim_n(df).where(F.col("read_id") == "r4").first().seq == "ACGT"


def test_cut_tail_window(spark):
    df = _reads(spark, [("ACGTACGT", "IIII####"), ("ACGT", "####"), ("ACGTACGTAC", "IIIIII#I##")])
    got = {r.read_id: r.seq for r in T.cut_tail(df, 4, 20).collect()}
    # windows [2..5] of r0 (mean 21) and [5..8] of r2 (mean 21) are the last passing ones
    assert got == {"r0": "ACGTAC", "r1": "", "r2": "ACGTACGTA"}


def test_screen_finds_mismatched_reads(spark):
    ref = "".join(random.Random(5).choice("ACGT") for _ in range(300))
    reference = spark.createDataFrame([("c1", ref)], "name string, seq string")
    comp = {"A": "T", "C": "G", "G": "C", "T": "A"}
    rc = "".join(comp[c] for c in reversed(ref))
    two_mm = ref[50:60] + ("A" if ref[60] != "A" else "C") + ref[61:70] + ("A" if ref[70] != "A" else "C") + ref[71:130]
    three_mm = "".join(("A" if c != "A" else "C") if i in (1, 12, 25) else c for i, c in enumerate(ref[10:90]))
    reads = _reads(spark, [(ref[100:180], "I" * 80), (rc[20:120], "I" * 100), (two_mm, "5" * 80),
                           (three_mm, "I" * 80), (ref[280:300] + "ACGTACGTAC", "I" * 30), ("ACG", "III")])
    got = {r.read_id: (r.screened, r.aligned) for r in SC.screen_contaminants(reads, reference).collect()}
    assert got["r0"] == (True, True) and got["r1"] == (True, True) and got["r2"] == (True, True)
    assert got["r3"] == (True, False)   # three mismatches in the seed
    assert got["r4"] == (True, False)   # runs past the reference end
    assert got["r5"] == (False, False)  # too short to screen


def test_strand_classification_edges(spark):
    df = spark.createDataFrame([("a", 0.1), ("b", 0.9), ("c", 0.5), ("d", 0.3), ("e", None)],
                               "sample string, strandness double")
    got = {r.sample: r.strand for r in S.classify_strand(df, tolerance=0.15).collect()}
    assert got == {"a": 2, "b": 1, "c": 0, "d": -1, "e": -1}
    proj = S.project_strand(spark.createDataFrame([(2,), (2,), (1,), (1,)], "strand int")).first()
    assert proj.strand == -1 and proj.most_frequent == 1
    with pytest.raises(ValueError):
        S.classify_strand(df, tolerance=0.3)
    assert S.override_strand(S.project_strand(spark.createDataFrame([(2,)], "strand int")), 0).first().strand == 0


def test_contamination_band_edges(spark):
    for v, band in [(9.999, "low"), (19.999, "moderately low"), (20.0, "relatively high"), (50.0, "very high")]:
        df = spark.createDataFrame([(v,)], "reads_aligned_percentage double")
        assert SC.contamination_band(df).first().band == band
    empty = spark.createDataFrame([], "reads_aligned_percentage double")
    assert SC.contamination_band(empty).first().band == "not computed"


def test_library_size_bisection(spark):
    df = spark.createDataFrame([("s", 1000 + 0, 0)], "sample string, examined long, duplicates long")
    n, c = 10000, 8000
    m = spark.createDataFrame([("s", n, n - c)], "sample string, examined long, duplicates long") \
        .select(AL._library_size("examined", "(examined - duplicates)").alias("x")).first().x
    # c / x = 1 - exp(-n / x)
    assert abs(c / m - (1 - math.exp(-n / m))) < 1e-6
    assert df.count() == 1


def test_bh_adjustment_equals_reference_formula(spark):
    rnd = random.Random(11)
    ps = [rnd.random() ** 3 for _ in range(300)] + [1.0] * 20 + [0.5] * 10
    df = spark.createDataFrame([("c", f"g{i}", p) for i, p in enumerate(ps)], "contrast string, gene_id string, pvalue double")
    got = {r.gene_id: r.padj for r in D.adjust_p(df).collect()}
    m = len(ps)
    order = sorted(range(m), key=lambda i: -ps[i])
    want, running = {}, 1.0
    for rank_desc, i in enumerate(order):
        rank = m - rank_desc
        running = min(running, ps[i] * m / rank)
        want[i] = min(1.0, running)
    # ties share the smallest value of their group
    for i, p in enumerate(ps):
        tie = min(want[j] for j in range(m) if ps[j] == p)
        assert abs(got[f"g{i}"] - tie) < 1e-12


def test_compact_track_across_tiles(spark):
    rows = [("s", "c", b * 10, b * 10 + 10, v) for b, v in enumerate([1, 1, 1, 2, 2, 1, 1, 1, 1, 3])] + \
           [("s", "c", 200, 210, 3)]
    df = spark.createDataFrame(rows, "sample string, chrom string, start0 long, end long, count long")
    got = sorted((r.start0, r.end, r["count"]) for r in V.compact_track(df, tile=20).collect())
    assert got == [(0, 30, 1), (30, 50, 2), (50, 90, 1), (90, 100, 3), (200, 210, 3)]


def test_counting_modes_and_ambiguity(spark):
    feats = spark.createDataFrame([("c", "gene", 100, 200, "+", "A"), ("c", "gene", 150, 300, "-", "B"),
                                   ("c", "gene", 1000, 1100, "+", "E")],
                                  "seqid string, type string, start long, end long, strand string, gid string")
    aln = spark.createDataFrame([
        ("S", 1, "c", 110, "20M", 0, 1),      # A only (+): mode0 A, mode1 A, mode2 none
        ("S", 2, "c", 160, "20M", 16, 1),     # A and B: ambiguous in mode 0; mode1 B; mode2 A
        ("S", 3, "c", 500, "20M", 0, 1),      # nothing
        ("S", 4, "c", 110, "20M", 4, 1),      # unmapped
        ("S", 5, "c", 110, "20M", 0, 2),      # multi-mapping
        ("S", 6, "c", 190, "5M800N20M", 0, 1),  # spliced into A and E (+): ambiguous modes 0 and 1
    ], "sample string, frag_id long, ref string, pos long, cigar string, flag int, nh int")
    got = {(r.strand_mode, r.gene_id): r["count"] for r in
           C.count_features_all_strands(aln, feats, id_column="gid", bin_size=64).collect()}
    # read 6's first block also overlaps B (-), so mode 2 assigns it to B
    assert got == {(0, "A"): 1, (1, "A"): 1, (1, "B"): 1, (2, "A"): 1, (2, "B"): 1}
    summ = {(r.strand_mode, r.status): r["count"] for r in
            C.assignment_summary(aln, feats, id_column="gid", bin_size=64).collect()}
    assert summ[(0, "Unassigned_Ambiguity")] == 2 and summ[(2, "Unassigned_NoFeatures")] == 2
    assert summ[(1, "Unassigned_Unmapped")] == 1 and summ[(2, "Unassigned_MultiMapping")] == 1


def test_ungapped_mapping_equals_brute_force(spark):
    from strandline.operators.align import map_reads_ungapped

    rnd = random.Random(9)
    genome = {"c1": "".join(rnd.choice("ACGT") for _ in range(400)), "c2": "".join(rnd.choice("ACGT") for _ in range(150))}
    comp = {"A": "T", "C": "G", "G": "C", "T": "A"}

    def rc(s):
        return "".join(comp[c] for c in reversed(s))

    def mutate(s, n):
        s = list(s)
        for i in rnd.sample(range(len(s)), n):
            s[i] = "A" if s[i] != "A" else "C"
        return "".join(s)

    reads = [genome["c1"][10:110], mutate(genome["c1"][200:300], 4), rc(genome["c2"][20:80]),
             mutate(genome["c1"][50:150], 7), genome["c1"][300:340] + genome["c2"][0:40], "ACGTACG",
             genome["c1"][380:400] + "A" * 5]
    rdf = spark.createDataFrame([("S", f"r{i}", s) for i, s in enumerate(reads)], "sample string, read_id string, seq string")
    cdf = spark.createDataFrame(list(genome.items()), "name string, seq string")
    got = {}
    for r in map_reads_ungapped(rdf, cdf, k=10).collect():
        got.setdefault(r.read_id, set()).add((r.ref, r.pos, r.strand, r.nm, r.nh, r.flag))

    want = {}
    for i, s in enumerate(reads):
        m, best = int(len(s) * 0.05), []
        for name, g in genome.items():
            for strand, seq in (("+", g), ("-", rc(g))):
                for p in range(len(seq) - len(s) + 1):
                    nm = sum(a != b for a, b in zip(s, seq[p:p + len(s)]))
                    if nm <= m:
                        pos = p + 1 if strand == "+" else len(seq) - p - len(s) + 1
                        best.append((name, pos, strand, nm))
        if best and len(s) >= 10 * (m + 1):
            lo = min(b[3] for b in best)
            top = [b for b in best if b[3] == lo]
            want[f"r{i}"] = {(n, p, st, nm, len(top), 16 if st == "-" else 0) for n, p, st, nm in top}
        else:
            want[f"r{i}"] = {(None, None, None, None, 0, 4)}
    assert got == want


def test_clipping_profile(spark):
    from strandline.operators.rseqc import clipping_profile

    aln = spark.createDataFrame([("S", 1, 100, "3S7M", 0), ("S", 2, 100, "8M2S", 0), ("S", 3, 100, "2S6M2S", 16),
                                 ("S", 4, 100, "10M", 4)],
                                "sample string, frag_id long, pos long, cigar string, flag int")
    got = {r.position: r.clipped for r in clipping_profile(aln).collect()}
    # read positions are 0-based from the read start; the unmapped record is ignored
    assert got == {0: 2, 1: 2, 2: 1, 8: 2, 9: 2}


def test_contaminant_reference_takes_exactly_one_origin(spark):
    from strandline.operators.screen import contaminant_reference
    fasta = spark.createDataFrame([("r", "ACGT", 4)], "name string, seq string, length int")
    contigs = spark.createDataFrame([("c", "AACCGGTT", 8)], "name string, seq string, length bigint")
    feats = spark.createDataFrame([("c", "rRNA", 3, 6, "+")], "seqid string, type string, start bigint, end bigint, strand string")
    assert [tuple(r) for r in contaminant_reference(fasta=fasta).collect()] == [("r", "ACGT")]
    got = contaminant_reference(contigs=contigs, features=feats, feature_type="rRNA").collect()
    assert [tuple(r) for r in got] == [("c:2-6", "CCGG")]
    assert contaminant_reference(contigs=contigs, features=feats, feature_type="tRNA").first()["name"] == "empty"
    for kw in ({}, {"fasta": fasta, "feature_type": "rRNA"}, {"feature_type": "rRNA"}):
        with pytest.raises(ValueError):
            contaminant_reference(**kw)


def test_unlisted_samples_and_types_raise(spark):
    from strandline.operators.annotation import count_type
    from strandline.operators.dge import load_count_matrix
    c = spark.createDataFrame([("a", "g", 1), ("z", "g", 2)], "sample string, gene_id string, n bigint")
    with pytest.raises(Exception, match="sample outside the list: z"):
        load_count_matrix(c, ["a"]).collect()
    gff = spark.createDataFrame([("gene",), ("exon",), ("gene",)], "type string")
    assert count_type(gff, "gene").first()["n"] == 2
    with pytest.raises(Exception, match="valid types: exon, gene"):
        count_type(gff, "tRNA").collect()


def test_short_reads_are_seeded_and_impossible_ratios_raise(spark):
    from strandline.operators.align import map_reads_ungapped
    ref = spark.createDataFrame([("c", "ACGTTGCATGCCATTGACCGATAGGCTTACGGATCCATTA" * 4)], "name string, seq string")
    seq = "TGCATGCCATTGACCGATAG"
    reads = spark.createDataFrame([("s", "r1", seq), ("s", "r2", seq[:7] + "A" + seq[8:])], "sample string, read_id string, seq string")
    got = {r.read_id: (r.flag, r.nm) for r in map_reads_ungapped(reads, ref, max_mismatch_ratio=0.10).collect()}
    assert got["r1"] == (0, 0) and got["r2"][0] == 0 and got["r2"][1] == 1
    with pytest.raises(Exception, match="blocks shorter than the seed"):
        map_reads_ungapped(reads, ref, max_mismatch_ratio=0.30).collect()


def test_pair_statistics_plan_does_not_grow_with_samples(spark):
    import time

    from strandline.operators.dge import pairwise_sere
    samples = [f"s{i}" for i in range(60)]
    rows = [(s, f"g{g}", (i * 7 + g * 3) % 11 + 1) for i, s in enumerate(samples) for g in range(5)]
    df = spark.createDataFrame(rows, "sample string, gene_id string, count bigint")
    t0 = time.time()
    assert pairwise_sere(df, samples).count() == 60 * 59 // 2
    assert time.time() - t0 < 60


def test_project_summary_screens_the_reads_once(spark):
    from strandline.plans.q_coverage import q_project_summary

    plan = q_project_summary(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "doc_id" not in plan and "item_id" not in plan
