"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.session import ensure_checkpoint_dir

# Fixed value: the white space that separates words.
WHITE = r"[\x20\x09-\x0D]"
NOT_WHITE = r"[^\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder (``spark.checkpoint.dir``)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet into the shared folder and read it back."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, also where ``body`` uses it inside lambdas."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The array of maximal runs of non-white-space; empty for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{WHITE}+"), "")


def count_chars(text: Column, chars: str) -> Column:
    """How many characters of ``text`` match the class ``chars`` (0 for null)."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(chars)).cast("long")


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id written as text, modulo ``n``: the folds of the labelled and language-model splits."""
    return F.pmod(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")), F.lit(n))
