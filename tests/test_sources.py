"""Readers and sinks on hand-written micro files."""

import pytest
import gzip

from pyspark.sql import functions as F

from strandline.operators import annotation as A
from strandline.sources import readers as R
from strandline.sources import sinks as K
from strandline.sources.annotation import read_gff
from strandline.sources.fastq import read_fastq


def test_fastq_datasource_gz_and_plain(spark, tmp_path):
    recs = "".join(f"@r{i} extra\nACGT{i}\n+\nIIII{i}\n" for i in range(5))
    with gzip.open(tmp_path / "WT1_R1_001.fastq.gz", "wt") as fh:
        fh.write(recs)
    (tmp_path / "WT1_R2_001.fastq").write_text(recs)
    df = read_fastq(spark, str(tmp_path / "WT1_R*"))
    rows = sorted((r.sample, r.mate, r.ordinal, r.read_id) for r in df.collect())
    assert len(rows) == 10 and rows[0] == ("WT1", 1, 0, "r0") and rows[-1] == ("WT1", 2, 4, "r4")
    assert read_fastq(spark, str(tmp_path / "WT1_R1_001.fastq.gz"), max_reads=2).count() == 2


def test_sample_manifest(spark, tmp_path):
    for n in ["A_R1_.fastq.gz", "A_R2_.fastq.gz", "B_R1_.fastq.gz"]:
        (tmp_path / n).write_bytes(b"x")
    m = {r.sample: (r.mates, r.paired) for r in R.sample_manifest(spark, str(tmp_path)).collect()}
    assert m == {"A": ([1, 2], True), "B": ([1], False)}


def test_fasta_reader_and_writer(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">chrXII:451574-451785 rRNA\nACGT\nAC\n>phi\nGGG\n")
    df = R.read_fasta(spark, str(tmp_path / "a.fa"))
    got = {r.name: (r.description, r.seq, r.length) for r in df.collect()}
    assert got == {"chrXII:451574-451785": ("rRNA", "ACGTAC", 6), "phi": ("", "GGG", 3)}
    K.write_fasta(df.select("name", "seq"), str(tmp_path / "out"))
    back = R.read_fasta(spark, str(tmp_path / "out"))
    assert sorted((r.name, r.seq) for r in back.collect()) == [("chrXII:451574-451785", "ACGTAC"), ("phi", "GGG")]


def test_sam_reader(spark, tmp_path):
    sam = "@HD\tVN:1.6\nq1\t0\tchr1\t100\t60\t10M5N10M\t*\t0\t0\tACGT\tIIII\tNH:i:1\tRG:Z:x\n" \
          "q2\t4\t*\t0\t0\t*\t*\t0\t0\tAC\tII\n"
    (tmp_path / "S1.sam").write_text(sam)
    a = {r.frag_id: r for r in R.read_sam(spark, str(tmp_path / "S1.sam")).collect()}
    assert a["q1"].sample == "S1" and a["q1"].nh == 1 and a["q1"].tags == {"NH": "1", "RG": "x"}
    assert a["q2"].flag == 4 and a["q2"].nh is None


def test_counts_and_summary_readers(spark, tmp_path):
    (tmp_path / "WT_feature.out").write_text(
        "# Program:featureCounts\nGeneid\tChr\tStart\tEnd\tStrand\tLength\tWT.bam\ng1\tc\t1\t10\t+\t10\t5\ng2\tc\t20\t30\t-\t11\t0\n")
    (tmp_path / "WT_feature.out.summary").write_text("Status\tWT.bam\nAssigned\t5\nUnassigned_NoFeatures\t2\n")
    c = {(r.sample, r.gene_id): r["count"] for r in R.read_counts(spark, str(tmp_path / "*_feature.out")).collect()}
    assert c == {("WT", "g1"): 5, ("WT", "g2"): 0}
    s = {r.status: r["count"] for r in R.read_count_summary(spark, str(tmp_path / "*.summary")).collect()}
    assert s == {"Assigned": 5, "Unassigned_NoFeatures": 2}


def test_trim_json_and_tool_log(spark, tmp_path):
    (tmp_path / "S1.json").write_text('{"summary": {"before_filtering": {"total_reads": 10, "total_bases": 1000, '
                                      '"q20_bases": 900, "q30_bases": 800, "gc_content": 0.4}, "after_filtering": '
                                      '{"total_reads": 9, "total_bases": 850, "q20_bases": 840, "q30_bases": 790, '
                                      '"gc_content": 0.41}}}')
    t = {r.stage: r.total_reads for r in R.read_trim_json(spark, str(tmp_path / "S1.json")).collect()}
    assert t == {"before": 10, "after": 9}
    (tmp_path / "S1.log").write_text("# reads processed: 100\n# reads with at least one alignment: 7 (7.00%)\n")
    m = {r.metric: (r["count"], r.percent) for r in R.read_tool_log(spark, str(tmp_path / "S1.log")).collect()}
    assert m["reads processed"] == (100, None)
    assert m["reads with at least one reported alignment"] == (7, 7.0)


def test_gff_roundtrip_and_bed(spark, tmp_path):
    (tmp_path / "a.gff").write_text("##gff-version 3\nc1\tsrc\tgene\t11\t20\t.\t+\t.\tID=g1;Name=a b\n"
                                    "c1\tsrc\ttRNA\t30\t40\t.\t-\t.\tID=t1\n")
    g = read_gff(spark, str(tmp_path / "a.gff"))
    K.write_gff(A.custom_features(g, "gene,tRNA"), str(tmp_path / "custom"))
    back = read_gff(spark, str(tmp_path / "custom"))
    assert sorted((r.type, r.attributes["ID"]) for r in back.collect()) == [("custom", "g1"), ("custom", "t1")]
    K.write_bed(A.gff_to_bed(g, "Name"), str(tmp_path / "bed"))
    bed = spark.read.option("sep", "\t").csv(str(tmp_path / "bed")).collect()
    assert sorted((r[0], int(r[1]), int(r[2])) for r in bed) == [("c1", 10, 20), ("c1", 29, 40)]


def test_bedgraph_sorted_output(spark, tmp_path):
    t = spark.createDataFrame([("c2", 10, 20, 1.0), ("c1", 30, 40, 2.0), ("c1", 0, 10, 3.0)],
                              "chrom string, start0 long, end long, value double")
    K.write_bedgraph(t, str(tmp_path / "bg"), num_partitions=2)
    rows = spark.read.option("sep", "\t").csv(str(tmp_path / "bg")).select(
        "_c0", F.col("_c1").cast("long")).collect()
    assert sorted((r[0], r[1]) for r in rows) == [("c1", 0), ("c1", 30), ("c2", 10)]


def _lines(path):
    import gzip
    import os
    out = []
    for d, _, files in os.walk(path):
        for f in sorted(files):
            if f.startswith("part-"):
                p = os.path.join(d, f)
                raw = gzip.open(p, "rt").read() if f.endswith(".gz") else open(p).read()
                out.append((os.path.relpath(d, path), raw.splitlines()))
    return sorted(out)


def test_fasta_descriptions_may_hold_the_record_sign(spark, tmp_path):
    (tmp_path / "x.fa").write_text(">a one > two\nACG\nT\n>b\nGG\n")
    got = {r.name: (r.description, r.seq) for r in R.read_fasta(spark, str(tmp_path / "x.fa")).collect()}
    assert got == {"a": ("one > two", "ACGT"), "b": ("", "GG")}


def test_small_table_readers(spark, tmp_path):
    (tmp_path / "design.csv").write_text("label,condition\ns1,WT\ns2,KO\n")
    assert [tuple(r) for r in R.read_design(spark, str(tmp_path / "design.csv")).collect()] == [("s1", "WT"), ("s2", "KO")]
    (tmp_path / "target.tsv").write_text("label\tfiles\tcondition\treplicat\ns1\ts1.out\tWT\t1\n")
    assert tuple(R.read_target(spark, str(tmp_path / "target.tsv")).first()) == ("s1", "s1.out", "WT", "1")
    (tmp_path / "len.tsv").write_text("gene_id\tlength\ng1\t100\n")
    assert tuple(R.read_gene_lengths(spark, str(tmp_path / "len.tsv")).first()) == ("g1", 100)
    (tmp_path / "info.tsv").write_text("name\tbiotype\ng1\ttRNA\n")
    info = R.read_info(spark, str(tmp_path / "info.tsv"))
    assert info.columns == ["gene_id", "biotype"] and tuple(info.first()) == ("g1", "tRNA")
    (tmp_path / "s1").mkdir()
    (tmp_path / "s1" / "quant.sf").write_text("Name\tLength\tEffectiveLength\tTPM\tNumReads\nt1\t9\t5.0\t1.5\t3.0\n")
    assert tuple(R.read_quant(spark, str(tmp_path / "s1" / "quant.sf")).first()) == ("s1", "t1", 9, 5.0, 1.5, 3.0)


def test_metric_table_falls_back_to_the_next_path_only(spark, tmp_path):
    (tmp_path / "m.tsv").write_text("Sample\tx\ts\nA\t1\t2\n")
    got = R.read_metric_table(spark, [str(tmp_path / "none.tsv"), str(tmp_path / "m.tsv")], module="m").collect()
    assert sorted((r.file_name, r.module, r.metric, r.value) for r in got) == [("A", "m", "s", 2.0), ("A", "m", "x", 1.0)]
    with pytest.raises(FileNotFoundError):
        R.read_metric_table(spark, [str(tmp_path / "none.tsv")], module="m")


def test_count_sinks_round_trip(spark, tmp_path):
    counts = spark.createDataFrame([("s1", "g1", 5), ("s1", "g2", 0), ("s2", "g1", 7)], "sample string, gene_id string, count bigint")
    K.write_counts(counts, str(tmp_path / "counts"))
    back = spark.read.option("sep", "\t").option("header", "true").csv(str(tmp_path / "counts"))
    assert sorted((r["sample"], r["Geneid"], int(r["count"])) for r in back.collect()) == [("s1", "g1", 5), ("s1", "g2", 0), ("s2", "g1", 7)]
    K.write_count_matrix(spark.createDataFrame([("g1", 5, 7)], "gene_id string, s1 bigint, s2 bigint"), str(tmp_path / "m"))
    assert {x for _, rows in _lines(tmp_path / "m") for x in rows} == {"gene_id\ts1\ts2", "g1\t5\t7"}
    K.write_strand_summary(spark.createDataFrame([("s1", 2)], "sample string, strand int"), str(tmp_path / "st"))
    assert {x for _, rows in _lines(tmp_path / "st") for x in rows} == {"sample,strand", "s1,2"}


def test_bedgraph_has_one_sorted_track_per_sample(spark, tmp_path):
    rows = [(s, c, p * 10, p * 10 + 10, float(p)) for s in ("a", "b") for c in ("c2", "c1") for p in (3, 0, 2, 1)]
    K.write_bedgraph(spark.createDataFrame(rows, "sample string, chrom string, start0 int, end int, value double").repartition(4),
                     str(tmp_path / "bg"))
    for s in ("a", "b"):
        got = [x for d, lines in _lines(tmp_path / "bg") if d == f"sample={s}" for x in lines]
        assert got == [f"{c}\t{p * 10}\t{p * 10 + 10}\t{float(p)}" for c in ("c1", "c2") for p in range(4)]


def test_fastq_sink_keeps_mates_and_order(spark, tmp_path):
    rows = [("s", m, k, f"r{k}", "ACGT", "IIII") for k in (2, 0, 1) for m in (1, 2)]
    K.write_fastq(spark.createDataFrame(rows, "sample string, mate int, ordinal bigint, read_id string, seq string, qual string"),
                  str(tmp_path / "fq"))
    for m in (1, 2):
        got = [x for d, lines in _lines(tmp_path / "fq") if d == f"sample=s/mate={m}" for x in lines]
        assert got[::4] == ["@r0", "@r1", "@r2"] and got[1::4] == ["ACGT"] * 3


def test_de_tables_and_design_sinks(spark, tmp_path):
    de = spark.createDataFrame([("c", "g1", "up"), ("c", "g2", "none"), ("c", "g3", "down")], "contrast string, gene_id string, direction string")
    K.write_de_tables(de, str(tmp_path / "de"))
    back = spark.read.option("sep", "\t").option("header", "true").csv(str(tmp_path / "de")).collect()
    got = {t: sorted(r["gene_id"] for r in back if r["table"] == t) for t in ("complete", "up", "down")}
    assert got == {"complete": ["g1", "g2", "g3"], "up": ["g1"], "down": ["g3"]}
    d = spark.createDataFrame([("s1", "WT")], "label string, condition string")
    K.write_design(d, str(tmp_path / "design"), samples=spark.createDataFrame([("s1",), ("s2",)], "label string"))
    assert sorted(tuple(r) for r in R.read_design(spark, str(tmp_path / "design")).collect()) == [("s1", "WT"), ("s2", "FILL_IN")]


def test_reader_output_feeds_operators(spark, tmp_path):
    """SAM without NH tags and a GFF file go straight into the operators."""
    from strandline.operators import alignment as AL
    from strandline.operators import coverage as CV
    from strandline.operators import exprqc as E
    from strandline.operators import rseqc as RS
    (tmp_path / "S1.sam").write_text("q1\t0\tc1\t101\t60\t20M\t*\t0\t0\t*\t" + "I" * 20 + "\n"
                                     "q2\t0\tc1\t101\t60\t20M\t*\t0\t0\t*\t" + "5" * 20 + "\nq3\t4\t*\t0\t0\t*\t*\t0\t0\tAC\tII\n")
    (tmp_path / "a.gff").write_text("c1\tx\tgene\t91\t200\t.\t+\t.\tID=gnl|x1\nc1\tx\texon\t91\t200\t.\t+\t.\tID=e1;Parent=gnl|x1\n")
    sam, gff = R.read_sam(spark, str(tmp_path / "S1.sam")), read_gff(spark, str(tmp_path / "a.gff"))
    genes, exons = gff.where("type = 'gene'"), gff.where("type = 'exon'")
    s = AL.mapping_summary(sam).first()
    assert (s["reads"], s["unmapped"], s["unique"]) == (3, 1, 2)
    assert {r.frag_id: r.duplicate for r in AL.mark_duplicates(sam).collect()} == {"q1": False, "q2": True, "q3": False}
    assert {(r.frag_start, r.frag_end) for r in CV.fragment_options(sam, extend=50).collect()} == {(101, 150)}
    assert RS.infer_experiment(sam, gff).first()["fraction_same"] == 1.0
    assert CV.gene_body_coverage(sam, genes).count() > 0
    assert E.end_bias(sam, genes, window=20).first()["gene_id"] == "gnl|x1"
    assert E.coverage_stats(sam, exons).first()["gene_id"] == "gnl|x1"
    assert E.read_class_rates(sam, exons, genes).first()["exonic_rate"] == 1.0
    assert RS.junction_annotation(sam, exons).count() == 0


def test_paired_duplicates_are_judged_by_both_ends(spark):
    from strandline.operators.alignment import mark_duplicates
    rows = []
    for f, p2, q in (("a", 180, 5.0), ("b", 180, 9.0), ("c", 120, 1.0)):
        rows += [("s", f, "c1", 1, "50M", 1 + 2 + 64 + 32, q), ("s", f, "c1", p2, "50M", 1 + 2 + 128 + 16, q)]
    df = spark.createDataFrame(rows, "sample string, frag_id string, ref string, pos bigint, cigar string, flag int, base_quality_sum double")
    got = {(r.frag_id, r.flag & 192): r.duplicate for r in mark_duplicates(df).collect()}
    assert got == {("a", 64): True, ("a", 128): True, ("b", 64): False, ("b", 128): False, ("c", 64): False, ("c", 128): False}


def test_fastq_byte_ranges_give_every_record_once(spark, tmp_path):
    # qualities that begin with @ or + must not be taken for headers
    recs = [(f"r{k}", "ACGT" * (k % 7 + 1), ("@+II" * (k % 7 + 1))) for k in range(300)]
    text = "".join(f"@{i} extra\n{s}\n+\n{q}\n" for i, s, q in recs)
    (tmp_path / "S_R1_x.fastq").write_text(text)
    whole = [(r.ordinal, r.read_id, r.seq, r.qual) for r in read_fastq(spark, str(tmp_path / "*.fastq")).orderBy("ordinal").collect()]
    assert whole == [(k, *r) for k, r in enumerate(recs)]
    for size in (97, 1000, 10**6):
        got = read_fastq(spark, f"file://{tmp_path}", split_bytes=size).orderBy("ordinal").collect()
        assert [(r.read_id, r.seq, r.qual) for r in got] == recs
        assert all(text.encode()[r.ordinal:].startswith(f"@{r.read_id} ".encode()) for r in got)
    with pytest.raises(Exception):
        read_fastq(spark, str(tmp_path / "none.fastq")).count()


def test_unequal_mates_raise(spark, tmp_path):
    for n in ("a_R1_.fastq.gz", "a_R2_.fastq.gz", "b_R1_.fastq.gz"):
        with gzip.open(tmp_path / n, "wt") as f:
            f.write("@x\nA\n+\nI\n")
    got = {r["sample"]: r["paired"] for r in R.sample_manifest(spark, str(tmp_path)).collect()}
    assert got == {"a": True, "b": False}
    with pytest.raises(Exception, match="unequal numbers .* sample b"):
        R.sample_manifest(spark, str(tmp_path), strict=True).collect()


def test_count_summary_and_reported_rates(spark, tmp_path):
    from strandline.operators.screen import rate_from_metrics
    counts = spark.createDataFrame([("s1", "g1", 5)], "sample string, gene_id string, count bigint")
    summary = spark.createDataFrame([("s1", "Assigned", 5)], "sample string, status string, count bigint")
    K.write_counts(counts, str(tmp_path / "c"), summary=summary)
    back = spark.read.option("sep", "\t").option("header", "true").csv(str(tmp_path / "c.summary")).first()
    assert (back["Status"], back["count"], back["sample"]) == ("Assigned", "5", "s1")
    m = spark.createDataFrame([("a", "reads_aligned_percentage", 7.0), ("a", "not_aligned_percentage", 90.0),
                               ("b", "not_aligned_percentage", 80.0)], "sample string, metric string, value double")
    assert {r["sample"]: r["reads_aligned_percentage"] for r in rate_from_metrics(m).collect()} == {"a": 7.0, "b": 20.0}


def block_gzip(data, sizes):
    """A block-gzip file: members with their length in a BC field, and the empty last block."""
    import struct
    import zlib

    out, at = b"", 0
    for n in [*sizes, 0]:
        part = data[at:at + n]
        at += n
        z = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = z.compress(part) + z.flush()
        out += (b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x06\0BC\x02\0" + struct.pack("<H", len(body) + 25) + body
                + struct.pack("<II", zlib.crc32(part), len(part)))
    assert at == len(data)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_block_gzip_is_read_by_several_tasks(spark, tmp_path, seed):
    import random

    rng = random.Random(seed)
    recs = []
    for k in range(3000):
        n = rng.randrange(1, 150)
        recs.append((f"r{k}@x", "".join(rng.choice("ACGT") for _ in range(n)), "".join(rng.choice("@+I#ABCDEF") for _ in range(n))))
    data = "".join(f"@{i} y\n{s}\n+\n{q}\n" for i, s, q in recs).encode()
    sizes, left = [], len(data)
    heads = [m.start() for m in __import__("re").finditer(rb"^@r\d", data, 8)]
    while left:  # blocks that end anywhere, some exactly where a line or record ends
        n = min(left, rng.choice([rng.randrange(1, 9000), 60000]))
        done = len(data) - left
        near = [h - done for h in heads if 0 < h - done <= n]
        n = near[-1] if near and rng.random() < 0.3 else n
        sizes.append(n)
        left -= n
    (tmp_path / "S_R1_x.fastq.gz").write_bytes(block_gzip(data, sizes))
    path = str(tmp_path / "S_R1_x.fastq.gz")
    whole = read_fastq(spark, path).orderBy("ordinal").collect()
    assert [(r.read_id, r.seq, r.qual) for r in whole] == recs
    for size in (5000, 40_000, 10**7):
        df = read_fastq(spark, path, split_bytes=size)
        if size < 10**6:
            assert df.rdd.getNumPartitions() > 2
        got = df.orderBy("ordinal").collect()
        assert [(r.read_id, r.seq, r.qual) for r in got] == recs
        assert len({r.ordinal for r in got}) == len(recs)
    with gzip.open(tmp_path / "P_R1_.fastq.gz", "wb") as f:  # ordinary gzip stays one task
        f.write(data)
    assert read_fastq(spark, str(tmp_path / "P_R1_.fastq.gz"), split_bytes=5000).rdd.getNumPartitions() == 1


def test_filters_reach_the_fastq_files(spark, tmp_path):
    for name in ("a_R1_.fastq", "a_R2_.fastq", "b_R1_.fastq"):
        (tmp_path / name).write_text("".join(f"@{name}{k}\nACGT\n+\nIIII\n" for k in range(50)))
    (tmp_path / "c_R1_.fastq.gz").write_bytes(b"this is no gzip file")  # fails if it is ever opened
    df = read_fastq(spark, str(tmp_path))
    one = df.where("sample = 'a' and mate = 2 and ordinal < 7")
    assert one.count() == 7 and one.rdd.getNumPartitions() == 1
    assert {r.read_id for r in one.collect()} == {f"a_R2_.fastq{k}" for k in range(7)}
    assert df.where("sample in ('a', 'b')").count() == 150 and df.where("sample = 'b' and ordinal <= 3").count() == 4
    assert df.where("sample = 'a' and seq = 'ACGT' and ordinal > 47").count() == 4
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "ordinal" not in plan.split("Filter")[-1] if "Filter" in plan else True
