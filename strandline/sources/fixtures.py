"""Genomics-shaped views derived from the driver's parquet tables.

Each view exists twice: as DataFrame code (what the library runs) and as a
DuckDB SQL text (what the independent oracle runs).  Both must describe the
same rows.

Differences from the first draft of the views: reads cover each text
completely (every 100-letter chunk, the last one may be shorter) with a
dense per-sample ordinal, contigs are all documents, and ``fx_exons`` uses
an ``explode`` instead of a cross join.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.operators.prefix import running_offset

# Letter → base and letter → quality character maps of the views.
LETTERS = "abcdefghijklmnopqrstuvwxyz"
LETTER_BASES = "ACGTACGTACGTACGTACGTACGTAN"
LETTER_QUALS = "IHGFEDCBA@?>=<;:98765430/#"
READ_LENGTH = 100


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _chr(key: Column) -> Column:
    return F.concat(F.lit("chr"), (key % 3 + 1).cast("string"))


def _strand_of(key: Column) -> Column:
    return F.when(key % 2 == 0, F.lit("+")).otherwise(F.lit("-"))


def fx_features(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select(
        _chr(k).alias("seqid"),
        F.when(k % 50 == 0, F.lit("rRNA")).otherwise(F.lit("gene")).alias("type"),
        (k * 100 + 1).alias("start_pos"),
        (k * 100 + F.col("p_size") * 7).alias("end_pos"),
        _strand_of(k).alias("strand"),
        F.concat(F.lit("g"), k.cast("string")).alias("gene_id"),
        F.col("p_name").alias("gene_name"),
        F.col("p_type").alias("biotype"),
    )


def fx_gff(spark, sf_dir):
    f = fx_features(spark, sf_dir)
    tab = F.lit("\t")
    attrs = F.concat(
        F.lit("ID="), F.col("gene_id"), F.lit(";Name="), F.replace(F.col("gene_name"), F.lit(" "), F.lit("%20")),
        F.when(F.col("biotype") == "ECONOMY", F.lit("")).otherwise(F.concat(F.lit(";biotype="), F.col("biotype"))),
    )
    return f.select(F.concat(
        F.col("seqid"), tab, F.lit("fx"), tab, F.col("type"), tab, F.col("start_pos").cast("string"), tab,
        F.col("end_pos").cast("string"), tab, F.lit("."), tab, F.col("strand"), tab, F.lit("."), tab, attrs,
    ).alias("line"))


def fx_exons(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    e = p.select(k, F.explode(F.array(F.lit(1), F.lit(2))).alias("n"))
    n = F.col("n")
    return e.select(
        _chr(k).alias("seqid"),
        F.concat(F.lit("g"), k.cast("string")).alias("gene_id"),
        n.alias("exon_no"),
        (k * 100 + F.when(n == 1, 1).otherwise(210)).alias("start_pos"),
        (k * 100 + F.when(n == 1, 59).otherwise(350)).alias("end_pos"),
        _strand_of(k).alias("strand"),
    )


TRANSCRIPTS = ((1, 1, 1, 59), (1, 1, 30, 59), (1, 1, 210, 350), (2, 2, 1, 57), (2, 2, 210, 350), (3, 3, 1, 59), (3, 3, 212, 350),
               (3, 3, 213, 230))  # transcript, every how many genes, first and last base


def fx_transcripts(spark, sf_dir):
    """Exons of one to three transcripts per gene that overlap within and between transcripts."""
    k = F.col("p_partkey")
    t = F.inline(F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(("t", "every", "a", "b"), r)]) for r in TRANSCRIPTS]))
    gene = F.concat(F.lit("g"), k.cast("string"))
    return table(spark, sf_dir, "part").select("p_partkey", t).where(k % F.col("every") == 0).select(
        F.concat(F.lit("chr"), (k % 3 + 1).cast("string")).alias("seqid"), gene.alias("gene_id"),
        F.concat(gene, F.lit(".t"), F.col("t").cast("string")).alias("transcript_id"),
        (k * 100 + F.col("a")).cast("bigint").alias("start_pos"), (k * 100 + F.col("b")).cast("bigint").alias("end_pos"),
        _strand_of(k).alias("strand"))


def fx_alignments(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    q = F.col("l_quantity").cast("int")
    spliced7 = (F.col("l_linestatus") == "F") & (F.col("l_linenumber") == 7)
    spliced = (F.col("l_linestatus") == "F") & (F.col("l_linenumber") >= 5)
    reverse = (F.col("l_partkey") % 2 == 0) != (F.col("l_discount") < 0.01)
    read_key = Window.partitionBy(F.col("l_suppkey") % 6, F.col("l_orderkey"))
    return li.select(
        F.concat(F.lit("S"), (F.col("l_suppkey") % 6).cast("string")).alias("sample"),
        F.col("l_orderkey").alias("frag_id"),
        _chr(F.col("l_partkey")).alias("ref"),
        (F.col("l_partkey") * 100 + 1 + q * 2).alias("pos"),
        (F.col("l_partkey") * 100 + q * 2 + F.when(spliced7, 202).when(spliced, 200).otherwise(50)).alias("pos_end"),
        F.when(spliced7, F.lit("25M152N25M")).when(spliced, F.lit("25M150N25M")).otherwise(F.lit("50M")).alias("cigar"),
        (F.when(reverse, 16).otherwise(0) + F.when(F.col("l_tax") >= 0.08, 4).otherwise(0)).alias("flag"),
        (F.col("l_linenumber") * 8).alias("mapq"),
        F.col("l_extendedprice").cast("double").alias("base_quality_sum"),
        F.count(F.lit(1)).over(read_key).alias("nh"),
    )


def fx_pairs(spark, sf_dir):
    """Fragments with one record, unspliced and mapped (``fx_alignments`` with nh = 1).  One hash aggregation finds them: of a
    single record the largest value is its own."""
    li = table(spark, sf_dir, "lineitem")
    spliced = (F.col("l_linestatus") == "F") & (F.col("l_linenumber") >= 5)
    reverse = (F.col("l_partkey") % 2 == 0) != (F.col("l_discount") < 0.01)
    f = li.select(
        F.concat(F.lit("S"), (F.col("l_suppkey") % 6).cast("string")).alias("sample"), F.col("l_orderkey").alias("frag_id"),
        "l_partkey", F.col("l_quantity").cast("int").alias("q"), (F.col("l_linenumber") * 8).alias("mapq"),
        F.coalesce(spliced, F.lit(False)).alias("spliced"), F.coalesce(reverse, F.lit(False)).alias("reverse"),
        F.coalesce(F.col("l_tax") >= 0.08, F.lit(False)).alias("unmapped"))
    f = f.groupBy("sample", "frag_id").agg(F.count(F.lit(1)).alias("nh"), *[
        F.max(c).alias(c) for c in ("l_partkey", "q", "mapq", "spliced", "reverse", "unmapped")])
    pos = F.col("l_partkey") * 100 + 1 + F.col("q") * 2
    return f.where((F.col("nh") == 1) & ~F.col("spliced") & ~F.col("unmapped")).select(
        "sample", "frag_id", _chr(F.col("l_partkey")).alias("ref"),
        pos.alias("pos1"), (pos + 49).alias("end1"),
        (pos + 60 + F.col("mapq") * 2).alias("pos2"), (pos + 109 + F.col("mapq") * 2).alias("end2"),
        F.when(F.col("reverse"), F.lit("-")).otherwise(F.lit("+")).alias("strand1"),
    )


def fx_letters(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.lower(F.regexp_replace("text", "[^A-Za-z]", "")).alias("letters"))


def fx_contaminants(spark, sf_dir):
    b = table(spark, sf_dir, "benchmark")
    return b.select("item_id", F.translate(F.lower(F.regexp_replace("text", "[^A-Za-z]", "")), LETTERS, LETTER_BASES).alias("seq"))


def fx_contigs(spark, sf_dir):
    le = fx_letters(spark, sf_dir)
    return le.where(F.length("letters") > 0).select(
        F.concat(F.lit("ctg"), F.col("doc_id").cast("string")).alias("name"),
        F.translate("letters", LETTERS, LETTER_BASES).alias("seq"),
        F.length("letters").cast("bigint").alias("length"),
    )


def fx_ctg_features(spark, sf_dir):
    """Intervals on every document contig, one per 200 bases of it (1-based closed), used for sequence extraction."""
    j = F.explode(F.sequence(F.lit(0), F.floor((F.col("length") - 1) / 200))).alias("j")
    c = fx_contigs(spark, sf_dir).select("name", "length", F.expr("cast(substring(name, 4) as bigint)").alias("d"), j)
    start = F.col("j") * 200 + 1 + F.col("d") % 7
    c = c.withColumn("start_pos", start.cast("bigint")).where(F.col("start_pos") <= F.col("length"))
    k = F.col("d") + F.col("j")
    return c.select(
        F.col("name").alias("seqid"), F.when(k % 10 == 0, F.lit("rRNA")).otherwise(F.lit("gene")).alias("type"),
        "start_pos", F.least(F.col("length"), F.col("start_pos") + 19 + (F.col("j") * 13 + F.col("d")) % 80).cast("bigint").alias("end_pos"),
        _strand_of(k).alias("strand"), F.concat(F.lit("g"), F.col("d").cast("string"), F.lit("_"), F.col("j").cast("string")).alias("gene_id"))


def fx_reads(spark, sf_dir, ordinal: bool = True):
    """100-letter chunks of every text; ``ordinal`` is dense per sample in (doc_id, k) order.  The running sum sees
    only (doc_id, number of chunks); without ``ordinal`` it is left out."""
    le = fx_letters(spark, sf_dir).where(F.length("letters") > 0)
    le = le.withColumn("sample", F.concat(F.lit("S"), (F.col("doc_id") % 6).cast("string"))) \
           .withColumn("n_chunks", F.ceil(F.length("letters") / READ_LENGTH).cast("bigint"))
    if ordinal:
        firsts = running_offset(le.select("sample", "doc_id", "n_chunks"), ["sample"], "doc_id", "n_chunks", "first_ordinal")
        le = le.drop("n_chunks").join(firsts.select("doc_id", "first_ordinal"), "doc_id")
    # one linear pass cuts the text into 100-letter chunks; the chunk is a generator output, so
    # expressions pushed down onto seq/qual later stay O(read length)
    chunks = le.select("sample", "doc_id", *(["first_ordinal"] if ordinal else []),
                       F.posexplode(F.regexp_extract_all("letters", F.lit(f".{{1,{READ_LENGTH}}}"), F.lit(0)))
                       .alias("k", "piece"))
    return chunks.select(
        "sample",
        *([(F.col("first_ordinal") + F.col("k")).alias("ordinal")] if ordinal else []),
        F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit("_"), F.col("k").cast("string")).alias("read_id"),
        F.translate("piece", LETTERS, LETTER_BASES).alias("seq"),
        F.translate("piece", LETTERS, LETTER_QUALS).alias("qual"),
    )


# Mates: 35 to 100 bases of a chunk read 75 bases from both ends into these adapters, some of them with a base lost or
# gained, and every third mate 2 with a wrong base.
MATE_LENGTH = 75
MATE_ADAPTERS = ("AGATCGGAAGAGCACACGTCTGAACTCCAGTCA", "AGATCGGAAGAGCGTCGTGTAGGGAAAGAGTGT")


def fx_mates(spark, sf_dir):
    r = fx_reads(spark, sf_dir, ordinal=False).where(F.length("seq") >= 35)
    ids = F.split(F.expr("substring(read_id, 2)"), "_")
    h = ids[0].cast("bigint") * 7 + ids[1].cast("bigint") * 13
    r = r.select("sample", F.col("read_id").alias("pair_id"), "seq", "qual", h.alias("h"),
                 F.least(h % 66 + 35, F.length("seq")).cast("int").alias("n"))
    insert, tail = F.expr("substring(seq, 1, n)"), "A" * 40
    back = F.reverse(F.translate(insert, "ACGT", "TGCA"))

    def adapter(a):
        return F.when(F.col("h") % 5 == 0, a[:6] + a[7:]).when(F.col("h") % 7 == 0, a[:6] + "T" + a[6:]).otherwise(a)

    def read(x):
        return F.substring(F.concat(*x), 1, MATE_LENGTH)

    seq2 = read([back, adapter(MATE_ADAPTERS[1]), F.lit(tail)])
    seq2 = F.when(F.col("h") % 3 == 0, F.concat(F.substring(seq2, 1, 9), F.lit("A"), F.substring(seq2, 11, MATE_LENGTH))).otherwise(seq2)
    fill = F.lit("F" * MATE_LENGTH)
    return r.select("sample", "pair_id", read([insert, adapter(MATE_ADAPTERS[0]), F.lit(tail)]).alias("seq1"),
                    read([F.col("qual"), fill]).alias("qual1"), seq2.alias("seq2"),
                    read([F.reverse(F.expr("substring(qual, 1, n)")), fill]).alias("qual2"))


def fx_mate_reads(spark, sf_dir):
    """The mates as reads: one row per mate."""
    m = F.array(*[F.struct(F.lit(k).alias("mate"), F.col(f"seq{k}").alias("seq"), F.col(f"qual{k}").alias("qual")) for k in (1, 2)])
    return fx_mates(spark, sf_dir).select("sample", F.col("pair_id").alias("read_id"), F.inline(m))


def fx_design(spark, sf_dir):
    """The samples that have counts, first half WT, odd ones in batch b2."""
    i = table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 6).alias("i")).distinct()
    return i.orderBy("i").select(F.concat(F.lit("S"), F.col("i").cast("string")).alias("label"),
                    F.when(F.col("i") < 3, F.lit("WT")).otherwise(F.lit("KO")).alias("cond"),
                    F.when(F.col("i") % 2 == 0, F.lit("b1")).otherwise(F.lit("b2")).alias("batch"))


def fx_counts(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    s = F.col("l_suppkey") % 6
    up = F.when((F.col("l_partkey") % 10 == 0) & (s >= 3), 3).otherwise(1)
    return li.groupBy(s.alias("s"), F.col("l_partkey")).agg(
        (F.sum(F.col("l_quantity").cast("int")) * F.max(up)).cast("bigint").alias("n")
    ).select(
        F.concat(F.lit("S"), F.col("s").cast("string")).alias("sample"),
        F.concat(F.lit("g"), F.col("l_partkey").cast("string")).alias("gene_id"),
        "n",
    )


def fx_lengths(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select(F.concat(F.lit("g"), F.col("p_partkey").cast("string")).alias("gene_id"),
                    (F.col("p_size") * 7).alias("length"))


def fx_de(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    return e.select(
        F.col("event_type").alias("contrast"),
        F.concat(F.lit("g"), eid.cast("string")).alias("gene_id"),
        F.col("value").alias("base_mean"),
        ((F.col("user_id") - 75).cast("double") / F.lit(25.0)).alias("log2fc"),
        (((eid * 7919) % 100003 + 1).cast("double") / F.lit(100004.0)
         * F.when(eid % 5 == 0, 0.001).otherwise(1.0)).alias("pvalue"),
    )


def fx_metrics(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    c = F.col("o_custkey") % 6
    return o.select(
        F.concat(F.lit("run"), c.cast("string"), F.lit("_S"), (c + 1).cast("string"), F.lit("_R1_001.fastq.gz")).alias("file_name"),
        F.when(F.col("o_orderstatus") == "F", F.lit("fastp")).when(F.col("o_orderstatus") == "O", F.lit("bowtie1"))
         .otherwise(F.lit("star")).alias("module"),
        F.col("o_orderpriority").alias("metric"),
        F.col("o_totalprice").alias("value"),
    )


VIEWS = {name: fn for name, fn in globals().items() if name.startswith("fx_")}


# --------------------------------------------------------------------------------------------
# DuckDB texts of the same views (oracle side).  (name, dependencies, sql)
# --------------------------------------------------------------------------------------------

def _duck_adapter(k: int) -> str:
    a = MATE_ADAPTERS[k]
    return f"case when h % 5 = 0 then '{a[:6] + a[7:]}' when h % 7 = 0 then '{a[:6] + 'T' + a[6:]}' else '{a}' end"


DUCK_VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "fx_features": ((), """
select concat('chr', cast(p_partkey % 3 + 1 as varchar)) as seqid, case when p_partkey % 50 = 0 then 'rRNA' else 'gene' end as type,
  p_partkey * 100 + 1 as start_pos, p_partkey * 100 + p_size * 7 as end_pos, case when p_partkey % 2 = 0 then '+' else '-' end as strand,
  concat('g', cast(p_partkey as varchar)) as gene_id, p_name as gene_name, p_type as biotype from part"""),
    "fx_gff": (("fx_features",), """
select concat(seqid, chr(9), 'fx', chr(9), type, chr(9), cast(start_pos as varchar), chr(9), cast(end_pos as varchar), chr(9), '.', chr(9), strand, chr(9), '.', chr(9),
  'ID=', gene_id, ';Name=', replace(gene_name, ' ', '%20'), case when biotype = 'ECONOMY' then '' else concat(';biotype=', biotype) end) as line from fx_features"""),
    "fx_exons": ((), """
select concat('chr', cast(p_partkey % 3 + 1 as varchar)) as seqid, concat('g', cast(p_partkey as varchar)) as gene_id, n as exon_no,
  p_partkey * 100 + case when n = 1 then 1 else 210 end as start_pos, p_partkey * 100 + case when n = 1 then 59 else 350 end as end_pos,
  case when p_partkey % 2 = 0 then '+' else '-' end as strand from part, (select 1 as n union all select 2 as n) e"""),
    "fx_transcripts": ((), f"""
select concat('chr', cast(p_partkey % 3 + 1 as varchar)) as seqid, concat('g', cast(p_partkey as varchar)) as gene_id,
  concat('g', cast(p_partkey as varchar), '.t', cast(t as varchar)) as transcript_id, cast(p_partkey * 100 + a as bigint) as start_pos,
  cast(p_partkey * 100 + b as bigint) as end_pos, case when p_partkey % 2 = 0 then '+' else '-' end as strand
from part join (values {", ".join(map(str, TRANSCRIPTS))}) v(t, every, a, b) on p_partkey % every = 0"""),
    "fx_alignments": ((), """
select concat('S', cast(l_suppkey % 6 as varchar)) as sample, l_orderkey as frag_id, concat('chr', cast(l_partkey % 3 + 1 as varchar)) as ref,
  l_partkey * 100 + 1 + cast(l_quantity as int) * 2 as pos,
  l_partkey * 100 + cast(l_quantity as int) * 2 + case when l_linestatus = 'F' and l_linenumber = 7 then 202 when l_linestatus = 'F' and l_linenumber >= 5 then 200 else 50 end as pos_end,
  case when l_linestatus = 'F' and l_linenumber = 7 then '25M152N25M' when l_linestatus = 'F' and l_linenumber >= 5 then '25M150N25M' else '50M' end as cigar,
  case when (l_partkey % 2 = 0) = (l_discount < 0.01) then 0 else 16 end + case when l_tax >= 0.08 then 4 else 0 end as flag,
  l_linenumber * 8 as mapq, cast(l_extendedprice as double) as base_quality_sum,
  count(*) over (partition by l_suppkey % 6, l_orderkey) as nh from lineitem"""),
    "fx_pairs": (("fx_alignments",), """
select sample, frag_id, ref, pos as pos1, pos + 49 as end1, pos + 60 + mapq * 2 as pos2, pos + 109 + mapq * 2 as end2,
  case when flag % 32 >= 16 then '-' else '+' end as strand1 from fx_alignments where nh = 1 and cigar = '50M' and flag % 8 < 4"""),
    "fx_letters": ((), """
select doc_id, lower(regexp_replace(text, '[^A-Za-z]', '', 'g')) as letters from documents"""),
    "fx_contaminants": ((), """
select item_id, translate(lower(regexp_replace(text, '[^A-Za-z]', '', 'g')), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAN') as seq from benchmark"""),
    "fx_contigs": (("fx_letters",), """
select concat('ctg', cast(doc_id as varchar)) as name, translate(letters, 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAN') as seq,
  cast(length(letters) as bigint) as length from fx_letters where length(letters) > 0"""),
    "fx_ctg_features": (("fx_contigs",), """
select name as seqid, case when (d + j) % 10 = 0 then 'rRNA' else 'gene' end as type, cast(a as bigint) as start_pos,
  cast(least(length, a + 19 + (j * 13 + d) % 80) as bigint) as end_pos, case when (d + j) % 2 = 0 then '+' else '-' end as strand,
  concat('g', cast(d as varchar), '_', cast(j as varchar)) as gene_id
from (select *, j * 200 + 1 + d % 7 as a from (select name, length, cast(substring(name, 4) as bigint) as d,
        unnest(range(0, (length - 1) // 200 + 1)) as j from fx_contigs) x) y where a <= length"""),
    "fx_reads": (("fx_letters",), """
select sample, cast(first_ordinal + k as bigint) as ordinal, concat('d', cast(doc_id as varchar), '_', cast(k as varchar)) as read_id,
  translate(substring(letters, cast(k * 100 + 1 as integer), 100), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAN') as seq,
  translate(substring(letters, cast(k * 100 + 1 as integer), 100), 'abcdefghijklmnopqrstuvwxyz', 'IHGFEDCBA@?>=<;:98765430/#') as qual
from (select sample, doc_id, letters, unnest(range(0, n_chunks)) as k,
        coalesce(sum(n_chunks) over (partition by sample order by doc_id rows between unbounded preceding and 1 preceding), 0) as first_ordinal
      from (select concat('S', cast(doc_id % 6 as varchar)) as sample, doc_id, letters, cast(ceil(length(letters) / 100) as bigint) as n_chunks
            from fx_letters where length(letters) > 0) c) r"""),
    "fx_mates": (("fx_reads",), f"""
select sample, pair_id, substring(concat(ins, {_duck_adapter(0)}, repeat('A', 40)), 1, {MATE_LENGTH}) as seq1, substring(concat(qual, repeat('F', 75)), 1, {MATE_LENGTH}) as qual1,
  case when h % 3 = 0 then concat(substring(s2, 1, 9), 'A', substring(s2, 11)) else s2 end as seq2,
  substring(concat(reverse(substring(qual, 1, n)), repeat('F', 75)), 1, {MATE_LENGTH}) as qual2
from (select *, substring(concat(reverse(translate(ins, 'ACGT', 'TGCA')), {_duck_adapter(1)}, repeat('A', 40)), 1, {MATE_LENGTH}) as s2
  from (select *, substring(seq, 1, n) as ins
    from (select *, cast(least(h % 66 + 35, length(seq)) as integer) as n
      from (select sample, read_id as pair_id, seq, qual,
              cast(split_part(substring(read_id, 2), '_', 1) as bigint) * 7 + cast(split_part(read_id, '_', 2) as bigint) * 13 as h
            from fx_reads where length(seq) >= 35) a) b) c) d"""),
    "fx_mate_reads": (("fx_mates",), """
select sample, pair_id as read_id, 1 as mate, seq1 as seq, qual1 as qual from fx_mates
union all select sample, pair_id, 2, seq2, qual2 from fx_mates"""),
    "fx_design": ((), """
select concat('S', cast(i as varchar)) as label, case when i < 3 then 'WT' else 'KO' end as cond, case when i % 2 = 0 then 'b1' else 'b2' end as batch
from (select distinct l_suppkey % 6 as i from lineitem order by i) s"""),
    "fx_counts": ((), """
select concat('S', cast(l_suppkey % 6 as varchar)) as sample, concat('g', cast(l_partkey as varchar)) as gene_id,
  cast(sum(cast(l_quantity as int)) * max(case when l_partkey % 10 = 0 and l_suppkey % 6 >= 3 then 3 else 1 end) as bigint) as n
from lineitem group by l_suppkey % 6, l_partkey"""),
    "fx_lengths": ((), """
select concat('g', cast(p_partkey as varchar)) as gene_id, p_size * 7 as length from part"""),
    "fx_de": ((), """
select event_type as contrast, concat('g', cast(event_id as varchar)) as gene_id, value as base_mean, cast(user_id - 75 as double) / cast(25 as double) as log2fc,
  cast((event_id * 7919) % 100003 + 1 as double) / 100004.0 * case when event_id % 5 = 0 then 0.001 else 1.0 end as pvalue from events"""),
    "fx_metrics": ((), """
select concat('run', cast(o_custkey % 6 as varchar), '_S', cast(o_custkey % 6 + 1 as varchar), '_R1_001.fastq.gz') as file_name,
  case when o_orderstatus = 'F' then 'fastp' when o_orderstatus = 'O' then 'bowtie1' else 'star' end as module, o_orderpriority as metric, o_totalprice as value from orders"""),
}


@lru_cache(maxsize=None)
def _closure(names: tuple[str, ...]) -> tuple[str, ...]:
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in DUCK_VIEWS[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return tuple(order)


def with_views(sql: str) -> str:
    """Prefix an oracle query with the CTEs of every ``fx_*`` view it mentions."""
    import re

    used = tuple(sorted(set(re.findall(r"\bfx_[a-z_]+\b", sql)) & set(DUCK_VIEWS)))
    if not used:
        return sql
    ctes = ",\n".join(f"{n} as ({DUCK_VIEWS[n][1].strip()})" for n in _closure(used))
    body = sql.strip()
    m = re.match(r"(?is)^with\s+recursive\s", body)
    if m:
        return f"with recursive {ctes},\n{body[m.end():].lstrip()}"
    if re.match(r"(?is)^with\s", body):
        return f"with {ctes},\n{body[4:].lstrip()}"
    return f"with {ctes}\n{body}"
