"""Sinks (K1-K10).  Text formats are written by Spark writers in parallel; coordinate sorting
uses range partitioning, never a single-partition sort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _tsv(df: DataFrame, path: str, *, header: bool = True, partition_by: list[str] | None = None,
         sep: str = "\t") -> None:
    w = df.write.mode("overwrite").option("sep", sep).option("header", str(header).lower()).option("quote", "")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def write_counts(counts: DataFrame, path: str, *, summary: DataFrame | None = None) -> None:
    """K1: per-sample count tables of the chosen strand (one folder per sample); ``summary`` (sample, status, count) goes
    beside them, to ``<path>.summary``."""
    _tsv(counts.select("sample", F.col("gene_id").alias("Geneid"), "count"), path, partition_by=["sample"])
    if summary is not None:
        _tsv(summary.select("sample", F.col("status").alias("Status"), "count"), f"{path}.summary", partition_by=["sample"])


def write_count_matrix(matrix: DataFrame, path: str) -> None:
    """K2: the merged gene x sample matrix as one table."""
    _tsv(matrix, path)


def write_strand_summary(summary: DataFrame, path: str) -> None:
    """K3: strand summary CSV with header."""
    _tsv(summary, path, sep=",")


def gff_lines(features: DataFrame) -> DataFrame:
    """Features -> GFF3 text lines (attributes re-encoded as key=value;...)."""
    attrs = F.array_join(F.transform(F.map_entries("attributes"), lambda e: F.concat(
        e["key"], F.lit("="), F.replace(F.replace(F.replace(e["value"], F.lit("%"), F.lit("%25")), F.lit(";"),
                                                  F.lit("%3B")), F.lit(" "), F.lit("%20")))), ";")
    cols = [F.col("seqid"), F.col("source"), F.col("type"), F.col("start").cast("string"), F.col("end").cast("string"),
            F.coalesce("score", F.lit(".")), F.coalesce("strand", F.lit(".")), F.coalesce("phase", F.lit(".")), attrs]
    return features.select(F.concat_ws("\t", *cols).alias("value"))


def write_gff(features: DataFrame, path: str) -> None:
    """K4: filtered or custom annotation as GFF3 text."""
    gff_lines(features).write.mode("overwrite").text(path)


def write_fasta(seqs: DataFrame, path: str) -> None:
    """K5: (name, seq) -> FASTA text."""
    seqs.select(F.concat(F.lit(">"), F.col("name"), F.lit("\n"), F.col("seq")).alias("value")) \
        .write.mode("overwrite").text(path)


def write_bed(bed: DataFrame, path: str) -> None:
    """K6: BED rows (already 0-based half-open), no header."""
    _tsv(bed, path, header=False)


def write_bedgraph(track: DataFrame, path: str, *, value: str = "value", num_partitions: int | None = None) -> None:
    """K7: coverage as bedGraph, globally sorted by (chrom, start); one track (folder) per sample where the
    table has samples.  ``num_partitions`` fixes the number of files; by default the session's shuffles decide."""
    by = ["sample"] if "sample" in track.columns else []
    order = [*by, "chrom", "start0"]
    t = track.select(*order, "end", value)
    t = t.repartitionByRange(num_partitions, *order).sortWithinPartitions(*order) if num_partitions else t.orderBy(*order)
    _tsv(t, path, header=False, partition_by=by)


def write_fastq(reads: DataFrame, path: str, *, compression: str = "gzip") -> None:
    """K8: reads -> FASTQ text (gzip by default), one file set per sample and mate, in ``ordinal`` order where the
    reads carry one."""
    by = [c for c in ("sample", "mate") if c in reads.columns]
    order = [*by, "ordinal"] if "ordinal" in reads.columns else []
    reads = reads.orderBy(*order) if order else reads
    rec = F.concat(F.lit("@"), F.col("read_id"), F.lit("\n"), F.col("seq"), F.lit("\n+\n"), F.col("qual"))
    reads.select(*by, rec.alias("value")).write.mode("overwrite").option("compression", compression) \
        .partitionBy(*by).text(path)


def write_de_tables(exported: DataFrame, path: str) -> None:
    """K9: complete / up / down tables per contrast (folders contrast=.../table=...); complete holds every gene."""
    kinds = F.when(F.col("direction") == "none", F.array(F.lit("complete"))).otherwise(
        F.array(F.lit("complete"), F.col("direction")))
    _tsv(exported.withColumn("table", F.explode(kinds)), path, partition_by=["contrast", "table"])


def write_design(design: DataFrame, path: str, *, samples: DataFrame | None = None) -> None:
    """``label,condition`` design CSV (header, comma separated).  Without conditions, or for ``samples`` (label)
    that the design lacks, a template row to be filled in is written."""
    condition = next((F.col(c) for c in ("condition", "cond") if c in design.columns), F.lit(None).cast("string"))
    d = design.select("label", condition.alias("condition"))
    if samples is not None:
        d = d.unionByName(samples.select("label", F.lit(None).cast("string").alias("condition")).join(d, "label", "left_anti"))
    _tsv(d.withColumn("condition", F.coalesce("condition", F.lit("FILL_IN"))).orderBy("label"), path, sep=",")
