"""Near-duplicate documents by an inverted join over MinHash signature coordinates.

1. Every text becomes its set of distinct 5-word shingles (64-bit hashes) and a signature of
   ``K`` minima.  Texts with equal sets form one class; from here on a class is one row.
2. A signature is a set of ``K`` tokens (coordinate, value).  Two classes that agree on ``T`` or
   more coordinates share a token among the first ``K - T + 1`` of any common order, so only these
   prefixes are posted.  The order is rarest first, by a counting sketch of fixed size, so that
   the long lists of widely shared passages are skipped.
3. Within a posting list agreeing coordinates are counted and pairs with ``T`` or more are
   candidates.  From long lists only a spanning forest is taken, strongest pairs first; lists longer than ``BLOCK``
   are worked off in blocks that share a few anchors.
4. Candidates are confirmed on full shingle sets.  Where a list still holds several components, the
   members of the smaller ones visit the other component with their full sets and are tried against every
   candidate there until a link is confirmed.  So every candidate pair between different components
   is tried, and the components are those of all confirmed links.  There is a row per visitor and host component: where
   many documents lie just below the threshold of each other, each stays a component and visits all others.

``T`` lies 4.2 standard deviations below the expected agreement of a pair at the threshold
(chance of missing such a pair about 1e-5).

Defined cases: a null or empty text and one without words has no shingle and is linked with nothing;
fewer than five words make one shingle; a row with a null id is linked with nothing, has no
component and is kept; rows that repeat an id with the same text share its fate, those that repeat it with different texts
share the links of one of them; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import saved
from strandline.llm.components import components

WORDS = 5
K = 128
SIGMAS = 4.2
CELLS = 1 << 16  # cells of the counting sketch
BLOCK = 512  # members of a posting list that are compared in one go
ANCHORS = 48
SMALL = 12  # lists up to this size give all their candidate pairs
IDS_BROADCAST = 1_000_000  # ids (8 bytes each) that may be broadcast, after counting them


def needed_matches(percent: int, k: int = K) -> int:
    t = percent / 100
    return max(1, math.floor(k * t - SIGMAS * math.sqrt(k * t * (1 - t))))


def _mix(v: np.ndarray) -> np.ndarray:
    v = v ^ (v >> np.uint64(30))
    v = v * np.uint64(0xBF58476D1CE4E5B9)
    v = v ^ (v >> np.uint64(27))
    v = v * np.uint64(0x94D049BB133111EB)
    return v ^ (v >> np.uint64(31))


def shingles(text: str | None, memo: dict[bytes, int], n: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the ``n``-word shingles; A-Z are lower-cased, words are runs of non-white-space."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if len(memo) > 400_000:
        memo.clear()
    for w in found:
        if w not in memo:
            memo[w] = xxhash.xxh3_64_intdigest(w)
    h = np.fromiter(map(memo.__getitem__, found), dtype=np.uint64, count=len(found))
    if not len(h):
        return h
    width = min(n, len(h))
    v = np.full(len(h) - width + 1, width, dtype=np.uint64)
    for j in range(width):
        v = v * np.uint64(0x9E3779B97F4A7C15) + h[j:len(h) - width + 1 + j]
    return np.unique(_mix(v))


def _permutations(k: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(20261)
    return (r.integers(0, 1 << 63, k, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
            r.integers(0, 1 << 63, k, dtype=np.uint64))


def signature(s: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    best = np.full(len(a), 0xFFFFFFFF, dtype=np.uint64)
    for i in range(0, len(s), 2048):
        h = (s[None, i:i + 2048] * a[:, None] + b[:, None]) >> np.uint64(32)
        np.minimum(best, h.min(axis=1), out=best)
    return best.astype("<u4")


def sketches(docs: DataFrame, k: int = K) -> DataFrame:
    """(doc_id, n_shingles, set_key, sig): one row per document; set_key and sig are null without shingles."""
    def run(batches):
        a, b = _permutations(k)
        memo: dict[bytes, int] = {}
        for pdf in batches:
            n, key, sig = [], [], []
            for text in pdf["text"]:
                s = shingles(text, memo)
                n.append(len(s))
                key.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                sig.append(signature(s, a, b).tobytes() if len(s) else None)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_shingles": n, "set_key": key, "sig": sig})

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInPandas(
        run, "doc_id long, n_shingles long, set_key binary, sig binary")


def _tokens(sig: np.ndarray) -> np.ndarray:
    k = sig.shape[1]
    return (np.arange(k, dtype=np.int64) << 32)[None, :] | sig.astype(np.int64)


def _cells(tokens: np.ndarray) -> np.ndarray:
    return (_mix(tokens.astype(np.uint64)) & np.uint64(CELLS - 1)).astype(np.int64)


def _sigs(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype="<u4").reshape(len(column), -1)


def token_sketch(classes: DataFrame) -> np.ndarray:
    """How many tokens fall into each of ``CELLS`` cells: a summary of fixed size."""
    def run(batches):
        total = np.zeros(CELLS, dtype=np.int64)
        for pdf in batches:
            if len(pdf):
                total += np.bincount(_cells(_tokens(_sigs(pdf["sig"]))).ravel(), minlength=CELLS)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"cell": at, "n": total[at]})

    out = np.zeros(CELLS, dtype=np.int64)
    found = classes.select("sig").mapInPandas(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    out[found["cell"].to_numpy(dtype=np.int64)] = found["n"].to_numpy(dtype=np.int64)  # at most CELLS rows
    return out


def postings(classes: DataFrame, prefix: int) -> DataFrame:
    """(token, rep): the ``prefix`` rarest tokens of each class."""
    counts = classes.sparkSession.sparkContext.broadcast(token_sketch(classes))  # CELLS * 8 bytes

    def run(batches):
        rank = counts.value
        for pdf in batches:
            if not len(pdf):
                continue
            t = _tokens(_sigs(pdf["sig"]))
            first = np.lexsort((t, rank[_cells(t)]), axis=1)[:, :prefix]
            yield pd.DataFrame({"token": np.take_along_axis(t, first, axis=1).ravel(),
                                "rep": np.repeat(pdf["rep"].to_numpy(), prefix)})

    return classes.select("rep", "sig").mapInPandas(run, "token long, rep long")


def _runs(batches, keys: list[str]) -> Iterator[pd.DataFrame]:
    """Whole groups of rows with equal ``keys`` from a partition sorted by them, many groups at a time."""
    rest = None
    for pdf in batches:
        if rest is not None:
            pdf = pd.concat([rest, pdf], ignore_index=True)
        if not len(pdf):
            continue
        last = np.ones(len(pdf), dtype=bool)
        for c in keys:
            last &= pdf[c].to_numpy() == pdf[c].iloc[-1]
        cut = len(pdf) - int(last.sum())
        if cut:
            yield pdf.iloc[:cut]
        rest = pdf.iloc[cut:].reset_index(drop=True)
    if rest is not None and len(rest):
        yield rest


def _starts(pdf: pd.DataFrame, keys: list[str]) -> np.ndarray:
    new = np.zeros(len(pdf), dtype=bool)
    new[0] = True
    for c in keys:
        v = pdf[c].to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.append(np.flatnonzero(new), len(pdf))


def _agree(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Agreeing coordinates of every row of ``x`` with every row of ``y``."""
    out = np.empty((len(x), len(y)), dtype=np.int16)
    for i in range(len(x)):
        out[i] = (y == x[i]).sum(axis=1)
    return out


def _sized(nx: np.ndarray, ny: np.ndarray, percent: int) -> np.ndarray:
    """Sizes that allow the similarity: 100 * min >= percent * max."""
    return 100 * np.minimum(nx, ny) >= percent * np.maximum(nx, ny)


def _forest(m: np.ndarray, need: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs with ``m >= need``, strongest pairs first (Prim)."""
    n, out = len(m), []
    best, frm = np.full(n, -1, dtype=np.int32), np.zeros(n, dtype=np.int64)
    left = np.ones(n, dtype=bool)
    for _ in range(n):
        i = int(np.argmax(np.where(left, best, -2)))
        if best[i] >= need:
            out.append((int(frm[i]), i))
        left[i] = False
        better = left & (m[i] > best)
        best[better], frm[better] = m[i][better], i
    return out


def _dealt(lists: DataFrame, classes: DataFrame, keys: list[str]) -> DataFrame:
    """List members with their sizes and low signature bytes, groups together and sorted."""
    return (lists.join(classes.select("rep", "n_shingles", "low"), "rep")
            .repartition(*keys).sortWithinPartitions(*keys, "rep"))


def first_candidates(lists: DataFrame, classes: DataFrame, need: int, percent: int) -> DataFrame:
    """(a, b), a < b: candidate pairs that span each posting list; ``lists`` is (token, rep, c)."""
    blocks = F.ceil(F.col("c") / BLOCK)
    anchor = F.pmod(F.xxhash64("rep", F.lit(7)), F.lit(1 << 20)) * F.col("c") < ANCHORS * (1 << 20)
    block = (F.when(F.col("c") <= BLOCK, F.array(F.lit(0).cast("long")))
             .when(anchor, F.sequence(F.lit(0).cast("long"), blocks - 1))
             .otherwise(F.array(F.pmod(F.xxhash64("rep"), blocks))))
    dealt = _dealt(lists.withColumn("block", F.explode(block)), classes, ["token", "block"])

    def run(batches):
        for pdf in _runs(batches, ["token", "block"]):
            at = _starts(pdf, ["token", "block"])
            size = np.diff(at)
            rep, n = pdf["rep"].to_numpy(), pdf["n_shingles"].to_numpy()
            low = np.frombuffer(b"".join(pdf["low"]), dtype=np.uint8).reshape(len(pdf), -1)
            group = np.repeat(np.arange(len(size)), size)
            small = (size <= SMALL)[group]
            a, b = [], []
            for d in range(1, min(SMALL, len(pdf))):
                i = np.flatnonzero(small[:-d] & (group[d:] == group[:-d]))
                if not len(i):
                    break
                i = i[_sized(n[i], n[i + d], percent)]
                i = i[(low[i] == low[i + d]).sum(axis=1) >= need]
                a.append(rep[i])
                b.append(rep[i + d])
            for g in np.flatnonzero(size > SMALL):
                x = slice(at[g], at[g + 1])
                m = _agree(low[x], low[x])
                m[~_sized(n[x][:, None], n[x][None, :], percent)] = -1
                e = np.asarray(_forest(m, need), dtype=np.int64).reshape(-1, 2) + at[g]
                a.append(rep[e[:, 0]])
                b.append(rep[e[:, 1]])
            if a:
                p, q = np.concatenate(a), np.concatenate(b)
                yield pd.DataFrame({"a": np.minimum(p, q), "b": np.maximum(p, q)}).drop_duplicates()

    return dealt.mapInPandas(run, "a long, b long").where("a < b").distinct()


def visits(lists: DataFrame, labels: DataFrame, classes: DataFrame, need: int, percent: int) -> DataFrame:
    """(rep, host): classes to be tried against another component, because one of its members is a candidate.

    ``labels`` is (rep, comp, k) with the component's size.  The members outside a list's largest
    component (usually few) are compared with all of the list; of two components the smaller visits.
    """
    named = lists.join(labels, "rep")
    most = named.groupBy("token", "comp").agg(F.count("*").alias("n")).groupBy("token").agg(
        F.count("*").alias("kinds"), F.max(F.struct("n", "comp")).alias("top"))
    mixed = named.join(most.where("kinds > 1").select("token", F.col("top.comp").alias("major")), "token")
    blocks = F.ceil(F.col("c") / BLOCK)
    member = mixed.select("token", "rep", "comp", "k", F.lit(0).alias("odd"), F.pmod(F.xxhash64("rep"), blocks).alias("block"))
    odd = mixed.where("comp <> major").select(
        "token", "rep", "comp", "k", F.lit(1).alias("odd"),
        F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("block"))
    dealt = _dealt(member.unionByName(odd), classes, ["token", "block"])

    def run(batches):
        for pdf in _runs(batches, ["token", "block"]):
            at = _starts(pdf, ["token", "block"])
            rep, n, comp, k = (pdf[c].to_numpy() for c in ("rep", "n_shingles", "comp", "k"))
            low = np.frombuffer(b"".join(pdf["low"]), dtype=np.uint8).reshape(len(pdf), -1)
            is_odd = pdf["odd"].to_numpy() == 1
            found = []
            for s, e in zip(at[:-1], at[1:]):
                i = np.flatnonzero(is_odd[s:e]) + s
                j = np.flatnonzero(~is_odd[s:e]) + s
                for part in np.array_split(i, max(1, math.ceil(len(i) / BLOCK))):
                    ok = ((comp[part][:, None] != comp[j][None, :])
                          & _sized(n[part][:, None], n[j][None, :], percent))
                    x, y = np.nonzero(ok)
                    hit = (low[part[x]] == low[j[y]]).sum(axis=1) >= need
                    x, y = part[x[hit]], j[y[hit]]
                    small = (k[x] < k[y]) | ((k[x] == k[y]) & (comp[x] > comp[y]))
                    found.append(np.stack([np.where(small, rep[x], rep[y]), np.where(small, comp[y], comp[x])]))
            if found:
                p, q = np.concatenate(found, axis=1)
                both = np.unique(np.stack([p, q], axis=1), axis=0)  # sorted by visitor
                who, first = np.unique(both[:, 0], return_index=True)
                if len(who):
                    hosts = [x.tolist() for x in np.split(both[:, 1], first[1:])]
                    yield pd.DataFrame({"rep": who, "hosts": hosts})

    # one row per visitor and list, with all its hosts there; a visitor has at most as many lists as its prefix
    found = dealt.mapInPandas(run, "rep long, hosts array<long>")
    return found.groupBy("rep").agg(F.array_distinct(F.flatten(F.collect_list("hosts"))).alias("hosts")).select(
        "rep", F.explode("hosts").alias("host"))


def visit_links(visiting: DataFrame, labels: DataFrame, classes: DataFrame, sets: DataFrame, need: int,
                percent: int) -> DataFrame:
    """(a, b): for each visit the confirmed link of the visitor with the host's members, one per block.

    Hosts and visitors meet in blocks of about ``BLOCK`` by ``BLOCK``; each carries its full set, and
    a visitor's strongest candidates are tried first, until one is confirmed.
    """
    sizes = saved(visiting.groupBy("host").agg(F.count("*").alias("v")), "hosts")
    inside = labels.join(sizes, labels["comp"] == sizes["host"]).select(
        "host", "rep", F.ceil(F.col("k") / BLOCK).alias("nh"), F.ceil(F.col("v") / BLOCK).alias("nv"))
    counts = saved(inside.select("host", "nh", "nv").distinct(), "hosts")
    zero = F.lit(0).cast("long")
    hosts = inside.select("host", "rep", F.lit(0).alias("visitor"), F.pmod(F.xxhash64("rep"), F.col("nh")).alias("hb"),
                          F.explode(F.sequence(zero, F.col("nv") - 1)).alias("vb"))
    guests = visiting.join(counts, "host").select(
        "host", "rep", F.lit(1).alias("visitor"), F.explode(F.sequence(zero, F.col("nh") - 1)).alias("hb"),
        F.pmod(F.xxhash64("rep"), F.col("nv")).alias("vb"))
    keys = ["host", "hb", "vb"]
    full = classes.select("rep", "low").join(sets.select(F.col("id").alias("rep"), "s"), "rep")
    dealt = hosts.unionByName(guests).join(full, "rep").repartition(*keys).sortWithinPartitions(*keys, "rep")

    def run(batches):
        for pdf in _runs(batches, keys):
            at = _starts(pdf, keys)
            rep, s = pdf["rep"].to_numpy(), pdf["s"].to_numpy()
            low = np.frombuffer(b"".join(pdf["low"]), dtype=np.uint8).reshape(len(pdf), -1)
            guest = pdf["visitor"].to_numpy() == 1
            out = []
            for lo, hi in zip(at[:-1], at[1:]):
                j = np.flatnonzero(~guest[lo:hi]) + lo
                for i in np.flatnonzero(guest[lo:hi]) + lo:
                    same = (low[j] == low[i]).sum(axis=1)
                    for t in np.argsort(-same, kind="stable"):
                        if same[t] < need:
                            break
                        x, y = s[i], s[j[t]]
                        if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                            continue
                        both = len(np.intersect1d(x, y, assume_unique=True))
                        if 100 * both >= percent * (len(x) + len(y) - both):
                            out.append((min(rep[i], rep[j[t]]), max(rep[i], rep[j[t]])))
                            break
            yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return dealt.mapInPandas(run, "a long, b long").distinct()


def shingle_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, s): the full shingle sets of the documents in ``ids`` (id)."""
    if ids.limit(IDS_BROADCAST + 1).count() <= IDS_BROADCAST:
        ids = F.broadcast(ids)
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))

    def run(batches):
        memo: dict[bytes, int] = {}
        for pdf in batches:
            if not len(pdf):
                continue
            yield pd.DataFrame({"id": pdf["id"], "s": [shingles(t, memo).view(np.int64) for t in pdf["text"]]})

    return texts.join(ids, "id", "left_semi").mapInPandas(run, "id long, s array<long>").dropDuplicates(["id"])


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets have 100 * intersection >= percent * union."""
    left = sets.select(F.col("id").alias("a"), F.col("s").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("s").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(left, "a").join(right, "b")
            .select("a", "b", both.alias("i"), (F.size("sa") + F.size("sb")).alias("n"))
            .where(100 * F.col("i") >= percent * (F.col("n") - F.col("i"))).select("a", "b"))


def _ids(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()


def near_duplicates(docs: DataFrame, percent: int = 85, k: int = K) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, class_id): one row per document."""
    need = needed_matches(percent, k)
    rows = saved(sketches(docs, k), "sketches")
    usable = rows.where("n_shingles > 0 and doc_id is not null")
    classes = saved(
        usable.groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"),
                                      F.first("sig").alias("sig")), "classes")

    def lower(batches):
        for pdf in batches:
            yield pd.DataFrame({"rep": pdf["rep"], "n_shingles": pdf["n_shingles"],
                                "low": [np.frombuffer(s, dtype="<u4").astype(np.uint8).tobytes() for s in pdf["sig"]]})

    low = classes.select("rep", "n_shingles", "sig").mapInPandas(lower, "rep long, n_shingles long, low binary")
    posted = postings(classes, k - need + 1)
    shared = posted.groupBy("token").agg(F.count("*").alias("c")).where("c > 1")
    lists = saved(posted.join(shared, "token"), "postings")
    members = saved(low.join(lists.select("rep").distinct(), "rep", "left_semi"), "members")

    pairs = saved(first_candidates(lists, members, need, percent), "candidates")
    sets = saved(shingle_sets(docs, _ids(pairs)), "sets")
    links = saved(confirmed(pairs, sets, percent), "links")
    labels = saved(components(links, "a", "b"), "labels")

    named = members.select("rep").join(labels, members["rep"] == labels["node"], "left").select(
        "rep", F.coalesce("component", "rep").alias("comp"))
    named = saved(named, "named")
    sizes = saved(named.groupBy("comp").agg(F.count("*").alias("k")), "sizes")  # on its own: the join can then be split
    named = saved(named.join(sizes, "comp"), "named")
    visiting = saved(visits(lists, named, members, need, percent), "visits")
    tried = visiting.select(F.col("rep").alias("id")).unionByName(
        named.join(visiting.select(F.col("host").alias("comp")).distinct(), "comp", "left_semi")
        .select(F.col("rep").alias("id"))).distinct()
    missing = saved(tried.join(sets.select("id"), "id", "left_anti"), "missing")
    if missing.limit(1).count():
        sets = sets.unionByName(saved(shingle_sets(docs, missing), "sets"))
    more_links = saved(visit_links(visiting, named, members, sets, need, percent), "links")
    if more_links.limit(1).count():
        labels = saved(components(links.unionByName(more_links), "a", "b"), "labels")

    found = classes.select("set_key", F.col("rep").alias("class_id")).join(
        labels, F.col("class_id") == F.col("node"), "left").select(
        "set_key", "class_id", F.coalesce("component", "class_id").alias("component_id"))
    out = rows.drop("sig").join(found, "set_key", "left")
    own = F.col("n_shingles") == 0
    return out.select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNull() | own, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(F.col("doc_id").isNull() | own, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
