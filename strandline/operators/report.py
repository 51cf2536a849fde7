"""Cross-sample report tables (the MultiQC role) and the project summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sample-name clean-up, applied in this order (truncate at the first match, then removals).
TRUNCATE_AT = [".gz", ".fastq", "_R1_.cutadapt", "_R2_.cutadapt", "_R2_001", "_R1_001", ".err"]
REMOVE = [r"\.sorted", r"_S\d+", r"_bowtie1$"]
# Files never read as metric tables.
IGNORE_NAMES = [".DS_Store", "slurm*out", "*.js"]
IGNORE_DIRS = [".snakemake", "multiqc", "logs"]
IGNORE_PATHS = ["*/feature_counts/*", "*_init_*"]
MAX_FILE_BYTES = 5_000_000


def clean_sample_name(name: str | Column) -> Column:
    """M1: tool file name -> sample name."""
    c = F.col(name) if isinstance(name, str) else name
    for t in TRUNCATE_AT:
        c = F.regexp_replace(c, "(?s)" + _quote(t) + ".*$", "")
    for r in REMOVE:
        c = F.regexp_replace(c, r, "")
    return c


def _quote(s: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?()[]{}|\\" else ch for ch in s)


def _metric_file(path: str, length: str, max_bytes: int, ignore_dirs: tuple[str, ...]) -> Column:
    base = F.regexp_extract(F.col(path), r"([^/]*)$", 1)
    bad = F.col(path).endswith("/")
    for g in IGNORE_NAMES:
        bad = bad | base.rlike("^" + _glob(g) + "$")
    for d in [*IGNORE_DIRS, *ignore_dirs]:
        bad = bad | F.col(path).rlike("(^|/)" + _quote(d) + "/")
    for g in IGNORE_PATHS:
        bad = bad | F.col(path).rlike("^" + _glob(g) + "$")
    return ~bad & (F.col(length) <= max_bytes)


def select_metric_files(listing: DataFrame, *, path: str = "path", length: str = "length",
                        max_bytes: int = MAX_FILE_BYTES, ignore_dirs: tuple[str, ...] = ()) -> DataFrame:
    """M2: keep metric files: not ignored by name, directory (``ignore_dirs`` are added) or path pattern, at most
    ``max_bytes`` long."""
    return listing.where(_metric_file(path, length, max_bytes, ignore_dirs))


def dropped_metric_files(listing: DataFrame, *, path: str = "path", length: str = "length",
                         max_bytes: int = MAX_FILE_BYTES, ignore_dirs: tuple[str, ...] = ()) -> DataFrame:
    """M2: the files that ``select_metric_files`` leaves out."""
    return listing.where(~_metric_file(path, length, max_bytes, ignore_dirs))


def _glob(g: str) -> str:
    return "".join(".*" if ch == "*" else _quote(ch) for ch in g)


def general_statistics(metrics: DataFrame, columns: list[tuple[str, str]]) -> DataFrame:
    """M3: one row per sample, one column per (module, metric): mean value over the sample's files.

    ``columns`` lists the (module, metric) pairs explicitly, so the pivot needs no extra job.
    """
    m = metrics.withColumn("sample", clean_sample_name("file_name")) \
        .withColumn("_col", F.concat_ws(".", "module", "metric"))
    names = [f"{a}.{b}" for a, b in columns]
    wide = m.groupBy("sample").pivot("_col", names).agg(F.round(F.avg("value"), 6))
    return wide.select("sample", *[F.col(f"`{n}`").alias(n.replace(".", "_").replace("-", "_")) for n in names])


def visible_columns(table: DataFrame, *, hide: list[str], order: list[str] | None = None) -> DataFrame:
    """M4: drop hidden columns and put the rest in the module order (unlisted ones last)."""
    keep = [c for c in table.columns if c not in hide]
    if order:
        keep = [c for c in order if c in keep] + [c for c in keep if c not in order]
    return table.select(*keep)


def project_summary(*, contamination: DataFrame, mapping: DataFrame, annotation: DataFrame,
                    strand: DataFrame) -> DataFrame:
    """M5: the project-level figures as one (item, value) table."""
    def kv(df, item, col):
        return df.select(F.lit(item).alias("item"), F.col(col).cast("string").alias("value"))
    parts = [
        kv(contamination, "contamination_band", "band"),
        kv(contamination, "contamination_percent", "contamination"),
        kv(mapping.agg(F.round(F.avg(100 - F.col("pct_unmapped")), 2).alias("v")), "mean_mapping_rate", "v"),
        kv(annotation.agg(F.round(F.avg("annotation_rate"), 2).alias("v")), "mean_annotation_rate", "v"),
        kv(strand, "strand_guess", "strand"),
        kv(strand, "strand_most_frequent", "most_frequent"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
