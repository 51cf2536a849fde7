"""GFF3 / GTF annotation readers (1-based closed coordinates kept as is)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FEATURE_COLUMNS = ["seqid", "source", "type", "start", "end", "score", "strand", "phase", "attributes"]


def _gff3_attributes(raw: Column) -> Column:
    # "ID=g1;Name=a%20b;" -> map; a trailing ';' would create an empty key, so trim it first.
    m = F.str_to_map(F.expr("trim(TRAILING ';' FROM _attrs)"), F.lit(";"), F.lit("="))
    decode = lambda v: F.try_url_decode(F.replace(v, F.lit("+"), F.lit("%2B")))
    return F.transform_values(m, lambda k, v: decode(v))


def _gtf_attributes(raw: Column) -> Column:
    keys = F.regexp_extract_all(raw, F.lit(r'([^\s;]+)\s+"([^"]*)"'), F.lit(1))
    vals = F.regexp_extract_all(raw, F.lit(r'([^\s;]+)\s+"([^"]*)"'), F.lit(2))
    return F.map_from_arrays(keys, vals)


def parse_annotation_lines(lines: DataFrame, column: str = "value", fmt: str = "gff3") -> DataFrame:
    """Text lines of a GFF3/GTF file -> feature rows.

    Comment lines and anything with fewer than nine tab fields (an embedded
    ``##FASTA`` section, blank lines) are dropped.  ``attributes`` is a
    ``map<string,string>``; GFF3 values are percent-decoded.
    """
    parts = F.split(F.col(column), "\t")
    rows = lines.where(~F.col(column).startswith("#")).select(parts.alias("_p")).where(F.size("_p") >= 9)
    rows = rows.select(
        F.col("_p")[0].alias("seqid"), F.col("_p")[1].alias("source"), F.col("_p")[2].alias("type"),
        F.col("_p")[3].cast("bigint").alias("start"), F.col("_p")[4].cast("bigint").alias("end"),
        F.col("_p")[5].alias("score"), F.col("_p")[6].alias("strand"), F.col("_p")[7].alias("phase"),
        F.col("_p")[8].alias("_attrs"),
    )
    attrs = _gff3_attributes(F.col("_attrs")) if fmt == "gff3" else _gtf_attributes(F.col("_attrs"))
    return rows.withColumn("attributes", attrs).select(*FEATURE_COLUMNS)


def read_gff(spark: SparkSession, path: str) -> DataFrame:
    """GFF3 file(s) -> features."""
    return parse_annotation_lines(spark.read.text(path), fmt="gff3")


def read_gtf(spark: SparkSession, path: str) -> DataFrame:
    """GTF file(s) -> features."""
    return parse_annotation_lines(spark.read.text(path), fmt="gtf")
