"""Documents in flat token files, found by scanning for separators.

A token file is nothing but ids, one document after the other, each closed by the end-of-document id;
it has no index.  ``scan`` reads such files in blocks of ``BLOCK_BYTES`` spread over all tasks, finds
the separators of a block in one vectorised search, and stitches documents that cross
blocks by a prefix scan over one narrow row per block (how many separators lie before, and where the last one is).
The scan has two levels, so no window holds more than ``TILE`` blocks.

Defined cases: a null or empty text is a document of 0 tokens; tokens after the last separator are a last
document that is not ``closed``; an empty file has no documents; a file whose size is not a whole
number of ids raises; ids of documents may be null or repeat (they do not enter the files); texts of any length
are written in full; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.llm.common import saved, shared_path
from strandline.llm.files import new_file, opened
from strandline.llm.tokens import TOKENIZER, encoder

END_ID = 50256  # the vocabulary's end-of-text id; never produced by text
ID_TYPE = "<u2"  # ids of this vocabulary fit two bytes
FILE_TOKENS = 32 << 20
BLOCK_BYTES = 4 << 20
TILE = 4096


def write(docs: DataFrame, folder: str, tokenizer: str = TOKENIZER, end_id: int = END_ID,
          id_type: str = ID_TYPE, file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Token files below ``folder``; returns (file, ordinal, doc_id) in the order of writing."""
    def run(batches):
        from pyspark import TaskContext

        encode, part = encoder(tokenizer), TaskContext.get().partitionId()
        rows = (r for pdf in batches for r in zip(pdf["doc_id"], pdf["text"]))
        made, row = 0, next(rows, None)
        while row is not None:
            name, size, ids = f"tokens-{part:06d}-{made:04d}.bin", 0, []
            made += 1
            with new_file(folder, name) as out:
                while row is not None and size < file_tokens:
                    t = np.append(encode(row[1] or ""), np.uint32(end_id))
                    if t.max() > np.iinfo(np.dtype(id_type)).max:
                        raise ValueError(f"ids up to {t.max()} do not fit {id_type}")
                    out.write(t.astype(id_type).tobytes())
                    size += len(t)
                    ids.append(None if pd.isna(row[0]) else int(row[0]))
                    row = next(rows, None)
            yield pd.DataFrame({"file": name, "ordinal": np.arange(len(ids)), "doc_id": pd.array(ids, dtype="Int64")})

    cols = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return saved(cols.mapInPandas(run, "file string, ordinal long, doc_id long"), "token-files")


def list_files(spark: SparkSession, names: DataFrame, folder: str) -> DataFrame:
    """(file, bytes) of the files named in ``names`` (file)."""
    def run(batches):
        system, path = opened(folder)
        for pdf in batches:
            info = system.get_file_info([f"{path}/{f}" for f in pdf["file"]])
            yield pd.DataFrame({"file": pdf["file"], "bytes": [i.size for i in info]})

    return names.select("file").distinct().mapInPandas(run, "file string, bytes long")


def scan(files: DataFrame, folder: str, end_id: int = END_ID, id_type: str = ID_TYPE,
         block_bytes: int = BLOCK_BYTES, tile: int = TILE) -> DataFrame:
    """(file, ordinal, start, n_tokens, closed): every document of ``files`` (file, bytes), without its end id."""
    width = np.dtype(id_type).itemsize
    step = max(width, block_bytes - block_bytes % width)
    none = F.lit(-1).cast("long")
    blocks = files.where("bytes > 0").select(
        "file", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("bytes") - 1) / step))).alias("block"))

    def search(batches):
        system, path = opened(folder)
        name, f = None, None
        for pdf in batches:
            for file, size, block in zip(pdf["file"], pdf["bytes"], pdf["block"]):
                if size % width:
                    raise ValueError(f"{file}: {size} bytes are no whole number of ids")
                if file != name:
                    name, f = file, system.open_input_file(f"{path}/{file}")
                at = int(block) * step
                ids = np.frombuffer(f.read_at(min(step, int(size) - at), at), dtype=id_type)
                ends = np.flatnonzero(ids == end_id) + at // width
                yield pd.DataFrame({"file": [file], "block": [block], "ends": [ends], "n": [len(ends)],
                                    "last": [ends[-1] if len(ends) else -1], "stop": [at // width + len(ids)]})

    # one row per block, dealt evenly whatever the files' sizes
    found = saved(blocks.repartition(F.pmod(F.xxhash64("file", "block"), F.lit(1 << 20))).mapInPandas(
        search, "file string, block long, ends array<long>, n long, last long, stop long"), "separators")

    # ends grow from block to block, so the last one before a block is the largest
    narrow = found.select("file", "block", "n", "last", F.floor(F.col("block") / tile).alias("tile"))
    tiles = narrow.groupBy("file", "tile").agg(F.sum("n").alias("n"), F.max("last").alias("last"))
    before = Window.partitionBy("file").orderBy("tile").rowsBetween(Window.unboundedPreceding, -1)
    tiles = tiles.select("file", "tile", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"),
                         F.coalesce(F.max("last").over(before), none).alias("last0"))
    inside = Window.partitionBy("file", "tile").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = narrow.select("file", "block", "tile", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("n1"),
                            F.coalesce(F.max("last").over(inside), none).alias("last1")).join(tiles, ["file", "tile"])
    carried = carried.select("file", "block", (F.col("n0") + F.col("n1")).alias("first"),
                             F.greatest("last0", "last1").alias("previous"))

    stitched = found.join(carried, ["file", "block"])
    closed = stitched.select("file", "first", "previous", "ends", F.posexplode("ends").alias("i", "end")).select(
        "file", (F.col("first") + F.col("i")).alias("ordinal"),
        (F.coalesce(F.get("ends", F.col("i") - 1), F.col("previous")) + 1).alias("start"), "end")
    closed = closed.select("file", "ordinal", "start", (F.col("end") - F.col("start")).alias("n_tokens"),
                           F.lit(True).alias("closed"))
    rest = found.groupBy("file").agg(F.sum("n").alias("ordinal"), F.max("last").alias("last"), F.max("stop").alias("stop"))
    rest = rest.where("stop > last + 1").select("file", "ordinal", (F.col("last") + 1).alias("start"),
                                                (F.col("stop") - F.col("last") - 1).alias("n_tokens"),
                                                F.lit(False).alias("closed"))
    return closed.unionByName(rest)


def token_counts(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, n_tokens, file, ordinal, start) of every document, by way of token files."""
    spark = docs.sparkSession
    folder = shared_path(spark, "token-files")
    named = write(docs, folder, tokenizer)
    if named.limit(1).count() == 0:
        return named.selectExpr("doc_id", "0L as n_tokens", "file", "ordinal", "0L as start")
    found = scan(list_files(spark, named, folder), folder)
    return named.join(found, ["file", "ordinal"]).select("doc_id", "n_tokens", "file", "ordinal", "start")
