"""Annotation operators: filters, projections, the pre-flight gate, BED export, sequence extraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.operators.intervals import fits_broadcast

# The dummy records that make a GTF without genes or exons usable.
DUMMY_CHROM = "myCHR"
EMPTY_FASTA_NAME = "empty"
EMPTY_FASTA_SEQ = "AAAAAAAAAAAAAA"


def features_of_type(gff: DataFrame, feature_type: str) -> DataFrame:
    """G1: rows whose column 3 equals ``feature_type`` (pushed into the scan when the source allows)."""
    return gff.where(F.col("type") == feature_type)


def custom_features(gff: DataFrame, types: str, label: str = "custom") -> DataFrame:
    """Comma list of types -> one filtered annotation relabelled ``custom``."""
    wanted = [t.strip() for t in types.split(",") if t.strip()]
    return gff.where(F.col("type").isin(wanted)).withColumn("type", F.lit(label))


def feature_types(gff: DataFrame) -> DataFrame:
    """Distinct feature types."""
    return gff.select("type").distinct()


def attribute_names(gff: DataFrame, feature_type: str | None = None) -> DataFrame:
    """Distinct attribute keys (optionally of one type)."""
    g = gff if feature_type is None else gff.where(F.col("type") == feature_type)
    return g.select(F.explode(F.map_keys("attributes")).alias("attribute")).distinct()


def count_type(gff: DataFrame, feature_type: str | None = None) -> DataFrame:
    """Rows per type.  With ``feature_type``, the count of that type; a type without rows raises an error that
    names the valid types (a short list: a file has a few dozen)."""
    c = gff.groupBy("type").agg(F.count(F.lit(1)).alias("n"))
    if feature_type is None:
        return c
    seen = c.agg(F.array_sort(F.collect_set("type")).alias("types"), F.max(F.when(F.col("type") == feature_type, F.col("n"))).alias("n"))
    failed = F.raise_error(F.concat(F.lit(f"no feature of type {feature_type}; valid types: "), F.array_join("types", ", ")))
    return seen.select(F.when(F.array_contains("types", feature_type), F.lit(feature_type)).otherwise(failed).alias("type"), "n")


def attribute_profile(gff: DataFrame, feature_type: str, attribute: str) -> DataFrame:
    """Rows of the type, rows carrying the attribute, its distinct values, and a non-unique flag."""
    v = F.col("attributes")[attribute]
    return gff.where(F.col("type") == feature_type).agg(
        F.lit(feature_type).alias("type"), F.lit(attribute).alias("attribute"),
        F.count(F.lit(1)).alias("n_rows"), F.count(v).alias("n_with_attribute"),
        F.count_distinct(v).alias("n_distinct"),
    ).withColumn("non_unique", F.col("n_distinct") < F.col("n_with_attribute"))


def check_extra_attributes(gff: DataFrame, feature_type: str, extra: list[str]) -> DataFrame:
    """Each requested extra attribute and whether the type carries it."""
    spark = gff.sparkSession
    wanted = spark.createDataFrame([(a,) for a in extra], "attribute string")
    have = attribute_names(gff, feature_type).withColumn("_present", F.lit(True))
    return wanted.join(have, "attribute", "left").select(
        "attribute", F.coalesce(F.col("_present"), F.lit(False)).alias("present"))


def check_contaminant_feature(gff: DataFrame, rrna_type: str) -> DataFrame:
    """Is the rRNA feature type among the annotation's types."""
    t = feature_types(gff).where(F.col("type") == rrna_type)
    return t.agg(F.lit(rrna_type).alias("type"), (F.count(F.lit(1)) > 0).alias("present"))


def annotation_report(gff: DataFrame, *, feature_type: str, attribute: str, extra: list[str] | None = None,
                      rrna_type: str | None = None) -> DataFrame:
    """The pre-flight gate as one (check, value, ok) table, from one scan of the annotation."""
    own = F.col("type") == feature_type
    extra = extra or []
    flags = [F.max(own & F.map_contains_key("attributes", e)).alias(f"_e{i}") for i, e in enumerate(extra)]
    # rows per type and value of the attribute; then one row with everything the checks need (types are a few dozen)
    per = gff.groupBy("type", F.when(own, F.col("attributes")[attribute]).alias("_v")).agg(F.count(F.lit(1)).alias("_n"), *flags)
    has = own & F.col("_v").isNotNull()
    one = per.agg(F.array_sort(F.collect_set("type")).alias("types"), F.coalesce(F.sum(F.when(own, F.col("_n"))), F.lit(0)).alias("n"),
                  F.coalesce(F.sum(F.when(has, F.col("_n"))), F.lit(0)).alias("n_with"), F.count_if(has).alias("n_distinct"),
                  *[F.coalesce(F.max(f"_e{i}"), F.lit(False)).alias(f"_e{i}") for i in range(len(extra))])

    def row(check: str, value: Column, ok: Column) -> Column:
        return F.struct(F.lit(check).alias("check"), value.alias("value"), ok.alias("ok"))

    checks = [row("count_type", F.concat(F.lit(f"{feature_type}="), F.col("n").cast("string")), F.col("n") > 0),
              row("attribute", F.lit(attribute), (F.col("n_with") > 0) & (F.col("n_distinct") >= F.col("n_with"))),
              *[row("extra_attribute", F.lit(e), F.col(f"_e{i}")) for i, e in enumerate(extra)]]
    if rrna_type:
        checks.append(row("rrna_type", F.lit(rrna_type), F.array_contains("types", rrna_type)))
    return one.select(F.inline(F.concat(F.transform("types", lambda t: row("feature_type", t, F.lit(True))), F.array(*checks))))


def gff_to_bed(gff: DataFrame, name_attribute: str = "Name") -> DataFrame:
    """BED6 (0-based half-open) with the name taken from an attribute."""
    return gff.select(F.col("seqid").alias("chrom"), (F.col("start") - 1).alias("start0"), F.col("end"),
                      F.col("attributes")[name_attribute].alias("name"), F.lit(0).alias("score"), "strand")


def gtf_with_dummies(gtf: DataFrame) -> DataFrame:
    """Append one dummy gene and one dummy exon on ``myCHR`` so downstream tools never see zero rows."""
    spark = gtf.sparkSession
    dummy = spark.createDataFrame(
        [(DUMMY_CHROM, "SGD", t, 0, 0, ".", "+", "0", {f"{t}_id": "dummy"}) for t in ("gene", "exon")],
        "seqid string, source string, type string, start bigint, end bigint, score string, strand string, "
        "phase string, attributes map<string,string>")
    return gtf.unionByName(dummy)


def extract_sequences(contigs: DataFrame, features: DataFrame, *, empty_dummy: bool = True) -> DataFrame:
    """Sub-sequence of each feature, named ``chrom:start0-end``; strand ignored.

    Features beyond the end of their contig are skipped.  The (small) feature
    table is broadcast after a size check so the contig rows never move.
    When nothing is extracted and ``empty_dummy``, one ``>empty`` record is returned.
    """
    start = "start" if "start" in features.columns else "start_pos"
    end = "end" if "end" in features.columns else "end_pos"
    f = features.select(F.col("seqid").alias("_chrom"), F.col(start).cast("bigint").alias("_s"),
                        F.col(end).cast("bigint").alias("_e"))
    if fits_broadcast(f):
        f = F.broadcast(f)
    j = contigs.join(f, contigs["name"] == f["_chrom"]).where((F.col("_e") <= F.col("length")) & (F.col("_s") >= 1))
    out = j.select(F.concat(F.col("name"), F.lit(":"), (F.col("_s") - 1).cast("string"), F.lit("-"),
                            F.col("_e").cast("string")).alias("name"),
                   F.expr("substring(seq, cast(_s as int), cast(_e - _s + 1 as int))").alias("seq"))
    if not empty_dummy or not j.select("name").isEmpty():  # a short job that ends with the first row
        return out
    return contigs.sparkSession.createDataFrame([(EMPTY_FASTA_NAME, EMPTY_FASTA_SEQ)], "name string, seq string")


def contig_lengths(contigs: DataFrame) -> DataFrame:
    """Name and length of every sequence."""
    return contigs.select("name", F.length("seq").cast("bigint").alias("length"))


def subset_by_contig(alignments: DataFrame, contigs: list[str]) -> DataFrame:
    """Records of every read that has at least one mapped record on the chosen contigs."""
    from strandline.functions.alignment import UNMAPPED, has_flag

    keys = alignments.where(F.col("ref").isin(contigs) & ~has_flag("flag", UNMAPPED)).select("sample", "frag_id")
    return alignments.join(keys, ["sample", "frag_id"], "left_semi")


def subset_features(features: DataFrame, contigs: list[str]) -> DataFrame:
    """The features on the chosen contigs."""
    return features.where(F.col("seqid").isin(contigs))


def subset_sequences(sequences: DataFrame, contigs: list[str]) -> DataFrame:
    """The sequences of the chosen contigs."""
    return sequences.where(F.col("name").isin(contigs))


def split_mapped(reads: DataFrame, alignments: DataFrame, *, read_key: str = "read_id") -> tuple[DataFrame, DataFrame]:
    """(mapped, unmapped) reads: those with a mapped record in ``alignments`` of their sample, and the others."""
    from strandline.functions.alignment import UNMAPPED, has_flag

    keys = alignments.where(~has_flag("flag", UNMAPPED)).select("sample", F.col("frag_id").cast("string").alias(read_key))
    return (reads.join(keys, ["sample", read_key], "left_semi"), reads.join(keys, ["sample", read_key], "left_anti"))
