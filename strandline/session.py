"""Spark session helpers.

Cluster settings (executor sizes, shuffle partitions, checkpoint dir) belong
to whoever launches the job; these helpers only fill in values that are
unset, so the same code runs on a laptop and on a large cluster.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job in this library relies on.  Applied only when unset.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # GFF attribute columns may repeat a key; the last one wins.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # Filters on the FASTQ source reach the files.
    "spark.sql.python.filterPushdown.enabled": "true",
}
# Spark's own defaults of these settings, which stand for unset.
_SPARK_DEFAULTS = {"spark.sql.mapKeyDedupPolicy": "EXCEPTION", "spark.sql.python.filterPushdown.enabled": "false"}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "strandline", driver_memory: str | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults."""
    builder = (SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if master:
        builder = builder.master(master)
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def ship_code() -> None:
    """Serialise this package's functions by value into Python tasks (mapInPandas, pandas_udf), so
    executors need no copy of the package on their path."""
    import strandline
    from pyspark import cloudpickle

    try:
        cloudpickle.register_pickle_by_value(strandline)
    except ValueError:  # already registered
        pass


def configure(spark: SparkSession) -> SparkSession:
    """Apply library defaults to an existing session without overriding user values."""
    ship_code()
    for key, value in _DEFAULTS.items():
        chosen = spark.sparkContext.getConf().contains(key)  # by whoever launched the job
        if not chosen and spark.conf.get(key, None) in (None, _SPARK_DEFAULTS.get(key)):
            spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this must be a shared filesystem set by the launcher.  Only
    when nothing is configured (local tests) do we create a scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must point at a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="strandline-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
