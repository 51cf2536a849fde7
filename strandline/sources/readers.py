"""Readers for sequence, alignment and report tables (S2, S3, S5-S11).  Explicit schemas; no inference."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.operators.schema import alignment_columns
from strandline.sources.fastq import DEFAULT_READTAG


def _file_name() -> F.Column:
    return F.regexp_extract(F.col("_metadata.file_path"), r"([^/]*)$", 1)


def _sample(df: DataFrame, from_name: F.Column) -> F.Column:
    """The sample of each row: the folder ``sample=...`` that the sinks write, else what the file's name says."""
    return F.col("sample").cast("string") if "sample" in df.columns else from_name


def sample_manifest(spark: SparkSession, directory: str, *, pattern: str = "*fastq.gz",
                    readtag: str = DEFAULT_READTAG, exclude: str | None = None, strict: bool = False) -> DataFrame:
    """(sample, mates, paired) from a file listing; only paths are read, never contents.  Folders ``sample=.../mate=...``,
    as the FASTQ sink writes them, count before file names.  ``strict`` raises when
    some samples of a project have both mates and others do not."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true") \
        .load(directory).select("path")
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    if exclude:
        files = files.where(~name.rlike(exclude))
    tag = F.regexp_extract(name, readtag, 0)
    sample = F.when(tag != "", F.regexp_extract(name, "^(.*?)" + readtag, 1)).otherwise(
        F.regexp_replace(name, r"\.(fastq|fq)(\.gz)?$", ""))
    mate = F.when(tag != "", F.regexp_extract(tag, r"(\d)", 1).cast("int")).otherwise(F.lit(1))
    own, k = F.regexp_extract("path", r"/sample=([^/]*)/", 1), F.regexp_extract("path", r"/mate=(\d)/", 1)
    sample, mate = F.when(own != "", own).otherwise(sample), F.when(k != "", k.try_cast("int")).otherwise(mate)
    m = files.select(sample.alias("sample"), mate.alias("mate"))
    out = m.groupBy("sample").agg(F.sort_array(F.collect_set("mate")).alias("mates"))
    if not strict:
        return out.withColumn("paired", F.size("mates") == 2)
    # a project is paired or not as a whole
    kinds = out.agg(F.count_if(F.size("mates") == 2).alias("_two"), F.count(F.lit(1)).alias("_all")).withColumn("_one", F.lit(1))
    bad = F.raise_error(F.concat(F.lit("unequal numbers of first and second mates, for example in sample "), F.col("sample")))
    odd = (F.col("_two") > 0) & (F.size("mates") != 2)
    return out.withColumn("_one", F.lit(1)).join(F.broadcast(kinds), "_one").select(
        "sample", "mates", F.when(odd, bad).otherwise(F.size("mates") == 2).alias("paired"))


def parse_fasta_records(records: DataFrame, column: str = "value") -> DataFrame:
    """FASTA records split at '>' -> (name, description, seq, length)."""
    r = records.where(F.trim(F.col(column)) != "")
    header = F.substring_index(F.col(column), "\n", 1)
    body = F.expr(f"substring({column}, length(substring_index({column}, '\\n', 1)) + 2)")
    seq = F.regexp_replace(body, r"\s", "")
    return r.select(F.regexp_extract(header, r"^(\S+)", 1).alias("name"),
                    F.trim(F.regexp_replace(header, r"^\S+", "")).alias("description"),
                    seq.alias("seq")).withColumn("length", F.length("seq").cast("bigint"))


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """S3: FASTA -> (name, description, seq, length).  Records are split where a line begins with '>', so
    descriptions may contain that character."""
    records = spark.read.option("lineSep", "\n>").text(path)
    return parse_fasta_records(records.select(F.regexp_replace("value", r"\A>", "").alias("value")))


SAM_FIELDS = ["read_id", "flag", "ref", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual"]


def read_sam(spark: SparkSession, path: str, *, sample: str | None = None) -> DataFrame:
    """SAM text -> alignments (sample, frag_id, flag, ref, pos, mapq, cigar, rnext, pnext, tlen, seq, qual,
    tags map, nh).  The sample is the file name without extension unless given."""
    smp = F.lit(sample) if sample else F.regexp_replace(_file_name(), r"\.sam$", "")
    return parse_sam_lines(spark.read.text(path).select(smp.alias("_sample"), "value"), sample=F.col("_sample"))


def parse_sam_lines(lines: DataFrame, *, sample: F.Column) -> DataFrame:
    """SAM text lines (``value``) -> alignments, headers left out; with ``pos_end`` and ``base_quality_sum``."""
    lines = lines.where(~F.col("value").startswith("@"))
    p = F.split("value", "\t")
    tags = F.slice(p, 12, 1 << 20)
    # "NH:i:1" -> NH -> "1" (type letter dropped)
    tag_map = F.map_from_arrays(F.transform(tags, lambda t: F.substring_index(t, ":", 1)),
                                F.transform(tags, lambda t: F.regexp_extract(t, r"^[^:]*:[^:]*:(.*)$", 1)))
    out = lines.select(
        sample.alias("sample"), p[0].alias("frag_id"), p[1].cast("int").alias("flag"), p[2].alias("ref"),
        p[3].cast("bigint").alias("pos"), p[4].cast("int").alias("mapq"), p[5].alias("cigar"), p[6].alias("rnext"),
        p[7].cast("bigint").alias("pnext"), p[8].cast("bigint").alias("tlen"), p[9].alias("seq"), p[10].alias("qual"),
        tag_map.alias("tags"))
    return alignment_columns(out.withColumn("nh", F.col("tags")["NH"].cast("int")), fill_hits=False)


def read_counts(spark: SparkSession, path: str, *, suffix: str = "_feature.out") -> DataFrame:
    """Per-sample count files (comment line, header, id ... count) -> long (sample, gene_id, count)."""
    raw = spark.read.option("sep", "\t").option("comment", "#").option("header", "true").csv(path) \
        .select("*", "_metadata.file_path")
    cols = [c for c in raw.columns if c not in ("file_path", "sample")]
    name = F.regexp_extract("file_path", r"([^/]*)$", 1)
    return raw.select(_sample(raw, F.regexp_replace(name, suffix + "$", "")).alias("sample"), F.col(f"`{cols[0]}`").alias("gene_id"),
                      F.col(f"`{cols[-1]}`").cast("bigint").alias("count"))


def read_count_summary(spark: SparkSession, path: str, *, suffix: str = "_feature.out.summary") -> DataFrame:
    """``.summary`` files -> (sample, status, count)."""
    raw = spark.read.option("sep", "\t").option("header", "true").csv(path).select("*", "_metadata.file_path")
    cols = [c for c in raw.columns if c not in ("file_path", "sample")]
    name = F.regexp_extract("file_path", r"([^/]*)$", 1)
    return raw.select(_sample(raw, F.regexp_replace(name, suffix.replace(".", r"\.") + "$", "")).alias("sample"),
                      F.col(f"`{cols[0]}`").alias("status"), F.col(f"`{cols[-1]}`").cast("bigint").alias("count"))


DESIGN_SCHEMA = T.StructType([T.StructField("label", T.StringType()), T.StructField("condition", T.StringType())])
TARGET_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ("label", "files", "condition", "replicat")])


def read_design(spark: SparkSession, path: str) -> DataFrame:
    """``label,condition`` design CSV."""
    return spark.read.schema(DESIGN_SCHEMA).option("header", "true").csv(path)


def read_target(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated target (label, files, condition, replicat)."""
    return spark.read.schema(TARGET_SCHEMA).option("header", "true").option("sep", "\t").csv(path)


def read_gene_lengths(spark: SparkSession, path: str) -> DataFrame:
    """(gene_id, length) TSV."""
    schema = "gene_id string, length bigint"
    return spark.read.schema(schema).option("header", "true").option("sep", "\t").csv(path)


def read_info(spark: SparkSession, path: str) -> DataFrame:
    """Annotation info TSV (first column is the gene id); all columns as strings."""
    df = spark.read.option("header", "true").option("sep", "\t").csv(path)
    return df.withColumnRenamed(df.columns[0], "gene_id")


QUANT_SCHEMA = "transcript string, length bigint, eff_length double, tpm double, num_reads double"


def read_quant(spark: SparkSession, path: str, *, suffix: str = "/quant.sf") -> DataFrame:
    """Transcript quantification tables -> (sample, transcript, length, eff_length, tpm, num_reads)."""
    df = spark.read.schema(QUANT_SCHEMA).option("header", "true").option("sep", "\t").csv(path)
    sample = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)" + suffix.replace(".", r"\.") + "$", 1)
    return df.select(_sample(df, sample).alias("sample"), *[c for c in df.columns if c != "sample"])


def read_metric_table(spark: SparkSession, paths: list[str], *, module: str) -> DataFrame:
    """The first existing metric TSV among ``paths`` (fallback locations) -> long (file_name, module, metric, value)."""
    from pyspark.errors import AnalysisException

    last = None
    for p in paths:
        try:
            df = spark.read.option("header", "true").option("sep", "\t").csv(p)
            df.columns  # noqa: B018 - resolves the path
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            last = e  # missing path: try the next one
            continue
        key = df.columns[0]
        metrics = [c for c in df.columns if c != key]
        long = df.unpivot(key, metrics, "metric", "value")
        return long.select(F.col(key).alias("file_name"), F.lit(module).alias("module"), "metric",
                           F.col("value").cast("double").alias("value"))
    raise FileNotFoundError(f"none of {paths} exists") from last


_STAGE = T.StructType([T.StructField(n, T.LongType()) for n in
                       ("total_reads", "total_bases", "q20_bases", "q30_bases")] +
                      [T.StructField("gc_content", T.DoubleType())])
TRIM_JSON_SCHEMA = T.StructType([T.StructField("summary", T.StructType([
    T.StructField("before_filtering", _STAGE), T.StructField("after_filtering", _STAGE)]))])


def read_trim_json(spark: SparkSession, path: str) -> DataFrame:
    """Trimming report JSON -> (sample, stage, total_reads, total_bases, q20_bases, q30_bases, gc_content)."""
    df = spark.read.schema(TRIM_JSON_SCHEMA).option("multiLine", "true").json(path)
    sample = F.regexp_replace(_file_name(), r"\.json$", "")
    st = F.explode(F.array(F.struct(F.lit("before").alias("stage"), F.col("summary.before_filtering").alias("s")),
                           F.struct(F.lit("after").alias("stage"), F.col("summary.after_filtering").alias("s"))))
    return df.select(_sample(df, sample).alias("sample"), st.alias("_x")).select("sample", "_x.stage", "_x.s.*")


def parse_tool_log(lines: DataFrame, column: str = "value", sample: F.Column | None = None) -> DataFrame:
    """Aligner log lines ``# <metric>: <count> [(pct%)]`` -> (sample, metric, count, percent).

    A "reads with at least one alignment" line is also reported under the newer
    wording "reads with at least one reported alignment".
    """
    x = lines.select((sample if sample is not None else F.lit(None).cast("string")).alias("sample"), F.col(column).alias("_l"))
    both = F.when(F.col("_l").contains("least one alignment"),
                  F.array(F.col("_l"), F.replace(F.col("_l"), F.lit("least one alignment"),
                                                  F.lit("least one reported alignment")))) \
        .otherwise(F.array(F.col("_l")))
    x = x.select("sample", F.explode(both).alias("_l"))
    pat = r"^#?\s*([^:]+):\s*([0-9]+)(?:\s*\(([0-9.]+)%\))?"
    return x.where(F.col("_l").rlike(pat)).select(
        "sample", F.trim(F.regexp_extract("_l", pat, 1)).alias("metric"),
        F.regexp_extract("_l", pat, 2).cast("bigint").alias("count"),
        F.when(F.regexp_extract("_l", pat, 3) != "", F.regexp_extract("_l", pat, 3).cast("double")).alias("percent"))


def read_tool_log(spark: SparkSession, path: str) -> DataFrame:
    """Aligner log files -> metrics, the sample taken from the file name."""
    lines = spark.read.text(path)
    name = F.regexp_replace(_file_name(), r"\.(log|txt|err)$", "")
    return parse_tool_log(lines.select("value", _sample(lines, name).alias("_f")), sample=F.col("_f"))
