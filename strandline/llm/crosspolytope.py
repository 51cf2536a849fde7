"""Near-duplicate vectors by cross-polytope hashing.

A vector is rotated by three rounds of random signs and a fast Hadamard transform; its hash is the
nearest signed axis.  ``hashes`` of these give a bucket, in each of ``tables`` tables; a vector is
also posted under the next likely buckets of each table (multiprobe).  Pairs in a bucket are verified by
cosine in double precision.  Equal vectors form one class first, with a count.

Nothing is written per pair: a pair counts in the smallest bucket that its vectors share, so every
bucket adds its counts to its members, and connectivity leaves as a spanning forest.  Buckets of more than
``BLOCK`` vectors are worked off as pairs of blocks, so no bucket is cut.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, and rows with a null label
or id, link with nothing (a null id has no component and is kept); vectors of different length do not
link; rows that repeat an id count as separate vectors; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import saved
from strandline.llm.components import components
from strandline.llm.neardup import _runs, _starts

TABLES, HASHES, PROBES = 6, 2, 3
COSINE = 0.98
BLOCK = 256
SEED = 20262


def hadamard(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of each row; the row length is a power of two."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x


def codes(x: np.ndarray, tables: int = TABLES, hashes: int = HASHES, probes: int = PROBES, seed: int = SEED) -> np.ndarray:
    """(rows, tables, probes) bucket codes, the nearest first."""
    n, d = x.shape
    width = 1 << max(1, (d - 1).bit_length())
    padded = np.zeros((n, width))
    padded[:, :d] = x
    rng = np.random.default_rng([seed, width])
    out = np.empty((n, tables, probes), dtype=np.int64)
    rows = np.arange(n)
    for t in range(tables):
        best, loss = [], []
        for _ in range(hashes):
            y = padded
            for _ in range(3):
                y = hadamard(y * rng.choice([-1.0, 1.0], width)) / np.sqrt(width)
            size = np.abs(y)
            top = np.argpartition(-size, 1, axis=1)[:, :2] if width > 2 else np.argsort(-size, axis=1)
            flip = size[rows, top[:, 0]] < size[rows, top[:, 1]]
            top[flip] = top[flip][:, ::-1]
            pick = 2 * top + (y[rows[:, None], top] < 0)
            best.append(pick)
            loss.append((size[rows, top[:, 0]] - size[rows, top[:, 1]]) ** 2)
        choice = np.array(list(itertools.product((0, 1), repeat=hashes)))  # which hashes take their second axis
        cost = np.stack(loss, axis=1) @ choice.T
        first = np.argsort(cost, axis=1, kind="stable")[:, :probes]
        for p in range(probes):
            code = np.zeros(n, dtype=np.int64)
            for k in range(hashes):
                code = code * (2 * width) + best[k][rows, choice[first[:, p], k]]
            out[:, t, p] = code
    return out


def _valid(v) -> np.ndarray | None:
    if v is None or len(v) == 0:
        return None
    x = np.asarray(v, dtype=np.float64)
    return x if np.isfinite(x).all() and x.any() else None


def _keyed(vectors: DataFrame) -> DataFrame:
    """(vec_id, key, label, vector): key and vector are null where the row links with nothing."""
    def run(batches):
        for pdf in batches:
            keys, kept = [], []
            for i, v, label in zip(pdf["vec_id"], pdf["embedding"], pdf["label"]):
                x = None if pd.isna(i) or pd.isna(label) else _valid(v)
                kept.append(None if x is None else (x + 0.0).tobytes())
                keys.append(None if x is None else xxhash.xxh3_128_digest(f"{label}|".encode() + kept[-1]))
            yield pd.DataFrame({"vec_id": pdf["vec_id"].astype("Int64"), "key": keys,
                                "label": pdf["label"].astype(object).where(pdf["label"].notna(), None), "vector": kept})

    cols = vectors.select(F.col("vec_id").cast("long"), "embedding", F.col("label").cast("string"))
    return cols.mapInPandas(run, "vec_id long, key binary, label string, vector binary")


def _bucketed(classes: DataFrame, tables: int, hashes: int, probes: int) -> DataFrame:
    """(rep, buckets): the sorted distinct 64-bit bucket keys of each class."""
    def run(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            width = pdf["vector"].map(len).to_numpy() // 8
            found: list = [None] * len(pdf)
            for d in np.unique(width):
                at = np.flatnonzero(width == d)
                x = np.frombuffer(b"".join(pdf["vector"].iloc[at]), dtype=np.float64).reshape(-1, d)
                c = codes(x / np.abs(x).max(axis=1, keepdims=True), tables, hashes, probes)
                for i, own in zip(at, c):
                    head = f"{d}|{pdf['label'].iloc[i]}|"
                    found[i] = sorted({xxhash.xxh3_64_intdigest(f"{head}{t}|{k}") - (1 << 63)
                                       for t, ks in enumerate(own.tolist()) for k in ks})
            yield pd.DataFrame({"rep": pdf["rep"], "buckets": found})

    return classes.select("rep", "label", "vector").mapInPandas(run, "rep long, buckets array<long>")


def _pairs_in(u1, u2, b1, b2, bucket: int, cosine: float, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, own) of the verified pairs: own is whether ``bucket`` is the smallest they share."""
    hit = (u1 @ u2.T) >= cosine
    i, j = np.nonzero(np.triu(hit, 1) if same else hit)
    own = np.empty(len(i), dtype=bool)
    for s in range(0, len(i), 4096):
        a, b = b1[i[s:s + 4096]], b2[j[s:s + 4096]]
        shared = (a[:, :, None] == b[:, None, :]).any(axis=2) & (a < bucket)
        own[s:s + 4096] = ~shared.any(axis=1)
    return i, j, own


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest member of each one's component, by spreading minima along the pairs."""
    root = np.arange(n)
    while True:
        new = root.copy()
        np.minimum.at(new, i, root[j])
        np.minimum.at(new, j, root[i])
        new = new[new]
        if (new == root).all():
            return root
        root = new


def linked(classes: DataFrame, buckets: DataFrame, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """(rep, links, root): per bucket, what it adds to a member's links, and a member of its component."""
    posted = buckets.select("rep", "buckets", F.explode("buckets").alias("bucket"))
    sizes = posted.groupBy("bucket").agg(F.count("*").alias("c")).where("c > 1")
    nb = F.ceil(F.col("c") / block)
    own = F.pmod(F.xxhash64("rep"), nb)
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), nb - 1),
                        lambda o: F.struct(F.least(own, o).alias("lo"), F.greatest(own, o).alias("hi")))
    keys = ["bucket", "lo", "hi"]
    dealt = (posted.join(sizes, "bucket").select("rep", "buckets", "bucket", own.alias("own"), F.explode(pairs).alias("p"))
             .select("rep", "buckets", "bucket", "own", "p.lo", "p.hi")
             .join(classes.select("rep", "m", "vector"), "rep")
             .repartition(*keys).sortWithinPartitions(*keys, "own", "rep"))

    def run(batches):
        for pdf in _runs(batches, keys):
            at = _starts(pdf, keys)
            rep, m, mine, lo, hi = (pdf[c].to_numpy() for c in ("rep", "m", "own", "lo", "hi"))
            vectors, lists, where = pdf["vector"].to_numpy(), pdf["buckets"].to_numpy(), pdf["bucket"].to_numpy()
            out = []
            for s, e in zip(at[:-1], at[1:]):
                if e - s < 2:
                    continue
                u = np.frombuffer(b"".join(vectors[s:e]), dtype=np.float64).reshape(e - s, -1)
                u = u / np.abs(u).max(axis=1, keepdims=True)
                u = u / np.linalg.norm(u, axis=1, keepdims=True)
                most = max(map(len, lists[s:e]))
                b = np.full((e - s, most), np.iinfo(np.int64).max)
                for r, own_list in enumerate(lists[s:e]):
                    b[r, :len(own_list)] = own_list
                same = lo[s] == hi[s]
                cut = e - s if same else int(np.searchsorted(mine[s:e], hi[s]))
                if same:
                    i, j, first = _pairs_in(u, u, b, b, where[s], cosine, True)
                else:
                    i, j, first = _pairs_in(u[:cut], u[cut:], b[:cut], b[cut:], where[s], cosine, False)
                    j = j + cut
                if not len(i):
                    continue
                add = (np.bincount(i[first], weights=m[s + j[first]], minlength=e - s)
                       + np.bincount(j[first], weights=m[s + i[first]], minlength=e - s)).astype(np.int64)
                root = _roots(e - s, i, j)
                say = np.flatnonzero((add > 0) | (root != np.arange(e - s)))
                out.append(pd.DataFrame({"rep": rep[s + say], "links": add[say], "root": rep[s + root[say]]}))
            if out:
                yield pd.concat(out, ignore_index=True)

    return dealt.mapInPandas(run, "rep long, links long, root long")


def near_vectors(vectors: DataFrame, cosine: float = COSINE, tables: int = TABLES, hashes: int = HASHES,
                 probes: int = PROBES) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per vector of (vec_id, embedding, label)."""
    rows = saved(_keyed(vectors), "vectors")
    classes = saved(rows.where("key is not null").groupBy("key").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("m"), F.first("label").alias("label"),
        F.first("vector").alias("vector")), "classes")
    buckets = saved(_bucketed(classes, tables, hashes, probes), "buckets")
    found = saved(linked(classes, buckets, cosine), "links")
    labels = components(found.select("rep", "root"), "rep", "root")
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    per = (classes.select("key", "rep", "m").join(counts, "rep", "left")
           .join(labels, F.col("rep") == F.col("node"), "left")
           .select("key", (F.col("m") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                   F.coalesce("component", "rep").alias("component_id")))
    out = rows.select("vec_id", "key").join(per, "key", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
