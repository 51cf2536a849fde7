"""Packing documents into sequences of fixed length by sum of squares.

A document is its token ids and an end id.  Longer ones are cut into whole sequences and a
shorter first piece.  Open sequences are described by how many have each residual gap; a piece goes
where the sum of the squared counts becomes smallest (ties: the tightest fit), longest pieces
first; a new sequence is opened only when no open one has room.

Pieces are dealt by a hash of their row into groups of about ``PER_GROUP``, packed independently: each group needs only
its lengths and a table of ``size`` counts, and wastes a sequence or two in thousands.

Defined cases: a null or empty text is its end id alone; ids may repeat or be null, every row is
packed; texts of any length are tokenised whole; a special token spelled in a text is plain text, or its id with
``special`` (op8 and the pipeline); an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import saved
from strandline.llm.tokens import TOKENIZER, encoder

SIZE = 2048
END_ID = 0
PER_GROUP = 8192

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, size: int = SIZE, tokenizer: str = TOKENIZER, end_id: int = END_ID,
           special: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document."""
    def run(batches):
        encode = encoder(tokenizer, special)
        for pdf in batches:
            rows = []
            for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
                ids = np.append(encode(text or ""), np.uint32(end_id)).astype("<u4")
                cuts = [0, *range((len(ids) - 1) % size + 1, len(ids) + 1, size)]
                doc = None if pd.isna(doc_id) else int(doc_id)
                rows.extend((doc, k, a, b - a, zlib.crc32(ids[a:b].tobytes()))
                            for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])))
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield out.astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInPandas(run, PIECES)


def sum_of_squares(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each length, taken in the given order."""
    count = np.zeros(size + 1, dtype=np.int64)  # open sequences by gap
    ready: list[list[int]] = [[] for _ in range(size + 1)]
    seq, off, made = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    far = np.int64(1) << 60
    for i, s in enumerate(map(int, lengths)):
        room, after = count[s:], 2 * count[:size + 1 - s] + 1
        after[0] = 0  # a filled sequence is no longer counted
        change = np.where(room > 0, after - 2 * room + 1, far)
        k = int(np.argmin(change))
        if change[k] < far:
            gap = s + k
            at = ready[gap].pop()
            count[gap] -= 1
        else:
            gap, at, made = size, made, made + 1
        seq[i], off[i] = at, size - gap
        if gap > s:
            ready[gap - s].append(at)
            count[gap - s] += 1
    return seq, off


def pack(cut: DataFrame, size: int = SIZE, per_group: int = PER_GROUP) -> DataFrame:
    """Pieces plus ``sequence_id`` and ``offset``."""
    names = [c for c in cut.columns]
    cut = saved(cut.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    groups = max(1, math.ceil(cut.count() / per_group))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", *(c for c in names if c != "length")], ascending=False, kind="stable")
        seq, off = sum_of_squares(pdf["length"].to_numpy(), size)
        return pdf.assign(sequence_id=(pdf["pack_group"].to_numpy() << 32) + seq, offset=off).drop(columns=["pack_group", "_row"])

    # by the row, so that equal rows spread like others
    dealt = cut.withColumn("pack_group", F.pmod(F.xxhash64("_row", "doc_id", "piece"), F.lit(groups)))
    return dealt.groupBy("pack_group").applyInPandas(run, f"{PIECES}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, size: int = SIZE, tokenizer: str = TOKENIZER, end_id: int = END_ID,
                   per_group: int = PER_GROUP, special: bool = False) -> DataFrame:
    return pack(pieces(docs, size, tokenizer, end_id, special), size, per_group)
