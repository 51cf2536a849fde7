"""Centroid clustering of integer vectors by scalar lookup tables.

Components become ``floor(scale * x)``.  Each round tabulates, per dimension, the squared difference of
every integer that occurs there to every centroid; a vector's distances are gathers from these
tables, added up.  Tasks read Arrow batches and send only their sums per centroid and dimension, so a
round shuffles ``k x d`` rows per task and the driver sees ``k x d`` sums: the model itself.

All arithmetic is on integers, so distances and means are exact; components beyond ``SAFE`` are handled as
Python integers.

Defined cases: vectors that are null, have another length than ``dim`` or hold null, NaN or infinite components are
left out; a null id never starts a centroid, its vector is clustered; rows that repeat an id are vectors of
their own (equal hashes are ordered by their components); fewer than ``k`` vectors make fewer centroids; a
distance or inertia beyond 64 bits is null; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import saved

K, DIM, SCALE, ROUNDS, SEED = 16, 64, 64, 3, 1
SAFE = 1 << 26  # |component| up to which a squared distance of up to 2^9 dimensions fits in 64 bits
LIMB = 40  # bits of a partial sum per row
LONG = 1 << 63

Centroids = list[list[int]]


def countable(vectors: DataFrame, dim: int = DIM) -> DataFrame:
    """(vec_id, x): vectors with exactly ``dim`` components, none null or non-finite."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return vectors.where((F.size("embedding") == dim) & finite).select(F.col("vec_id").cast("long"), x.alias("x"))


def integers(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), exactly: int64 where it is small, else Python integers."""
    with np.errstate(over="ignore"):
        y = np.floor(x * scale)
    if not y.size or np.abs(y).max() <= SAFE:
        return y.astype(np.int64)
    return np.array([[int(b) if np.isfinite(b) else int(a) * scale for a, b in zip(*r)] for r in zip(x, y)], dtype=object)


def nearest(q: np.ndarray, centroids: Centroids) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, squared distance) of each row; ties go to the smaller number."""
    far = q.dtype == object or max(abs(c) for row in centroids for c in row) > SAFE
    kind = object if far else np.int64
    c = np.array(centroids, dtype=kind)
    total = np.zeros((len(c), len(q)), dtype=kind)
    for j in range(q.shape[1]):
        values, at = np.unique(q[:, j], return_inverse=True)
        table = (values[None, :] - c[:, j, None]) ** 2  # centroid x occurring value
        total += table[:, at]
    best = np.argmin(total, axis=0)
    return best, total[best, np.arange(len(q))]


def _batches(batches, dim: int, scale: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for b in batches:
        if b.num_rows:
            yield b.column(0), integers(b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim), scale)


def _limbs(v: int) -> Iterator[tuple[int, int]]:
    k = 0
    while True:
        high, low = v >> LIMB, v & ((1 << LIMB) - 1)
        if high in (0, -1):
            yield k, v
            return
        yield k, low
        v, k = high, k + 1


def start(kept: DataFrame, k: int = K, scale: int = SCALE, seed: int = SEED) -> Centroids:
    """The ``k`` vectors whose ids have the smallest hashes, in hash order."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = kept.where("vec_id is not null").select(h.alias("h"), "x").orderBy("h", "x").limit(k).collect()
    return [integers(np.array([r["x"]]), scale)[0].tolist() for r in first]


def moved(kept: DataFrame, centroids: Centroids, dim: int = DIM, scale: int = SCALE) -> Centroids:
    """One round: every non-empty centroid becomes the floor of its vectors' mean."""
    def run(batches):
        sums = np.zeros((len(centroids), dim + 1), dtype=object)
        for _, q in _batches(batches, dim, scale):
            cluster, _ = nearest(q, centroids)
            for c in np.unique(cluster):
                own = q[cluster == c]
                sums[c, :dim] += own.sum(axis=0)
                sums[c, dim] += len(own)
        rows = [(c, j, limb, part) for c in range(len(sums)) if sums[c, dim] for j in range(dim + 1)
                for limb, part in _limbs(int(sums[c, j]))]
        yield pa.RecordBatch.from_pylist([dict(zip(("cluster", "dim", "limb", "part"), r)) for r in rows],
                                         schema=pa.schema([("cluster", pa.int32()), ("dim", pa.int32()),
                                                           ("limb", pa.int32()), ("part", pa.int64())]))

    parts = kept.mapInArrow(run, "cluster int, dim int, limb int, part long")
    total: dict[tuple[int, int], int] = {}
    for r in parts.groupBy("cluster", "dim", "limb").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("part")).collect():
        at = (r["cluster"], r["dim"])
        total[at] = total.get(at, 0) + (int(r["part"]) << (LIMB * r["limb"]))
    return [[total[c, j] // total[c, dim] for j in range(dim)] if (c, dim) in total else own
            for c, own in enumerate(centroids)]


def assigned(kept: DataFrame, centroids: Centroids, dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""
    def run(batches):
        for ids, q in _batches(batches, dim, scale):
            cluster, distance = nearest(q, centroids)
            whole = distance if distance.dtype != object else [d if d < LONG else None for d in distance]
            yield pa.RecordBatch.from_arrays([ids, pa.array(cluster, pa.int32()), pa.array(whole, pa.int64())],
                                             names=["vec_id", "cluster", "distance"])

    return kept.mapInArrow(run, "vec_id long, cluster int, distance long")


def clustered(vectors: DataFrame, k: int = K, dim: int = DIM, scale: int = SCALE, rounds: int = ROUNDS,
              seed: int = SEED) -> tuple[DataFrame, Centroids]:
    """Each vector's cluster and distance, and the final centroids."""
    kept = saved(countable(vectors, dim), "vectors")
    centroids = start(kept, k, scale, seed)
    if not centroids:
        return kept.where("false").selectExpr("vec_id", "0 as cluster", "0L as distance"), centroids
    for _ in range(rounds):
        centroids = moved(kept, centroids, dim, scale)
    return saved(assigned(kept, centroids, dim, scale), "clusters"), centroids


def cluster(vectors: DataFrame, k: int = K, dim: int = DIM, scale: int = SCALE, rounds: int = ROUNDS,
            seed: int = SEED) -> DataFrame:
    """``clustered`` with inertia per cluster and over all, and each final centroid's hash."""
    found, centroids = clustered(vectors, k, dim, scale, rounds, seed)
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"),
                                        F.count(F.when(F.col("distance").isNull(), 1)).alias("lost")).collect()  # k rows
    whole = {r["cluster"]: None if r["lost"] else int(r["s"]) for r in sums}
    every = None if None in whole.values() else sum(whole.values())

    def long(v):
        return v if v is not None and v < LONG else None

    rows = [(c, long(s), long(every), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
            for c, s in whole.items()]
    facts = vectors.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                                                            "centroid_sha256")
