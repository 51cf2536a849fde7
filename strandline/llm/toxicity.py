"""Toxicity by multiple-instance learning: a document is a bag of sentences.

Only documents are labelled.  A sentence's probability is a logistic function of the words and
word beginnings it holds; a document's is their noisy-or, ``1 - prod(1 - p)``.  The weights
are fitted to document labels through the noisy-or, so the fit itself decides which sentences
carry the label; ``score`` then returns the document's probability and the spans of the
sentences to blame.

The fit uses at most ``max_docs`` labelled documents (the documented bound), half of them
toxic where there are so many, chosen by a hash of the id; everything else runs over all rows.

Defined cases: a null or empty text has no sentence and scores 0; a text of any length is
scored sentence by sentence; rows with a null or repeated id are scored like others; null labels
are not used; without labelled rows of both kinds every score is 0; extra columns are ignored by
``fit`` and kept by ``score``, whose columns replace columns of the same name.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_DOCS = 6000
MIN_DOCS_WITH = 5  # a feature must occur in that many documents of the sample
PREFIXES = (4, 5, 6)
CUT = 0.5  # a sentence with this probability is reported
THRESHOLD = 0.3
MIN_WEIGHT = 0.5  # smaller weights are no evidence; a sentence without evidence has probability 0

_SENTENCE = re.compile(r"[^.!?\n]+[.!?\n]*")
_WORD = re.compile(r"\w+")


def features_of(word: str) -> list[str]:
    """A word stands for itself and for its beginnings (compounds share a stem)."""
    return [word, *(f"{word[:n]}~" for n in PREFIXES if len(word) >= n)]


def sentences(text: str | None) -> Iterator[tuple[int, int, list[str]]]:
    """(start, end, lower-case words) of every sentence with a word."""
    for m in _SENTENCE.finditer(text or ""):
        found = _WORD.findall(m[0].lower())
        if found:
            yield m.start(), m.end(), found


def _learn(texts: list[str], y: np.ndarray, epochs: int, l1: float) -> tuple[float, dict[str, float]]:
    names: dict[str, int] = {}
    docs_with: list[int] = []
    feat, sent, doc_of = array("i"), array("i"), array("i")
    for d, text in enumerate(texts):
        seen: set[int] = set()
        for _, _, found in sentences(text):
            s = len(doc_of)
            doc_of.append(d)
            own = {names.setdefault(f, len(names)) for w in found for f in features_of(w)}
            feat.extend(own)
            sent.extend(repeat(s, len(own)))
            seen |= own
        docs_with.extend([0] * (len(names) - len(docs_with)))
        for f in seen:
            docs_with[f] += 1
    kept = np.asarray(docs_with) >= MIN_DOCS_WITH
    at, fs = np.frombuffer(sent, dtype=np.int32), np.frombuffer(feat, dtype=np.int32)
    use = kept[fs]
    new = np.cumsum(kept) - 1
    at, fs, n = at[use].astype(np.int64), new[fs[use]], int(kept.sum())
    bag, n_sent, n_doc = np.frombuffer(doc_of, dtype=np.int32).astype(np.int64), len(doc_of), len(texts)
    w, b = np.zeros(n), -8.0
    sum_w, sum_b = np.full(n, 1e-8), 1e-8
    for _ in range(epochs):
        z = b + np.bincount(at, weights=w[fs], minlength=n_sent)
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        none = np.bincount(bag, weights=np.log1p(-np.minimum(p, 1 - 1e-9)), minlength=n_doc)
        clean = np.exp(none)
        # d(-log P)/dz: p for a clean bag, -p (1-P)/P for a toxic one
        per_doc = np.where(y == 1, -clean / np.maximum(1 - clean, 1e-9), 1.0)
        g = p * per_doc[bag] / n_doc
        gw, gb = np.bincount(fs, weights=g[at], minlength=n), float(g.sum())
        sum_w += gw * gw
        sum_b += gb * gb
        step = 0.5 / np.sqrt(sum_w)
        w -= step * gw
        w = np.sign(w) * np.maximum(np.abs(w) - step * l1, 0)  # proximal step: most weights become exactly 0
        b -= 0.1 * gb / np.sqrt(sum_b)
    inv = {int(new[i]): f for f, i in names.items() if kept[i]}
    return float(b), {inv[int(i)]: float(w[i]) for i in np.flatnonzero(np.abs(w) >= MIN_WEIGHT)}


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS, epochs: int = 150, l1: float = 5e-4,
        seed: int = 7) -> tuple[float, dict[str, float]]:
    """Bias and sparse weights from texts (doc_id, text) and labels (doc_id, toxic), ``toxic`` 0 or 1.

    The sample is drawn from the narrow labels, so only its texts move; of rows that repeat an id the smallest text (and
    label) counts.  At most ``max_docs`` rows
    reach the one task that fits; what returns to the driver are the non-zero weights, at most as many as
    the sample has words.
    """
    half = max_docs // 2
    known = labels.where(F.col("toxic").isin(0, 1)).join(docs.select("doc_id"), "doc_id", "left_semi").select(
        "doc_id", F.col("toxic").cast("int").alias("toxic"), F.xxhash64(F.col("doc_id"), F.lit(seed)).alias("_h"))
    many = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}

    def some(kind: int) -> DataFrame:
        rows = known.where(F.col("toxic") == kind)
        share = 2 * half / max(many.get(kind, 0), 1)
        if share < 1:  # about twice the rows that are wanted reach the ordering
            rows = rows.where(F.pmod("_h", F.lit(1 << 30)) < int(share * (1 << 30)))
        return rows.orderBy(F.pmod("_h", F.lit(1 << 30)), "_h").limit(half)

    chosen = some(0).unionByName(some(1))
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen.groupBy("doc_id").agg(  # at most max_docs ids
        F.min("toxic").alias("toxic"), F.min("_h").alias("_h"))), "doc_id")
    sample = texts.groupBy("doc_id", "toxic", "_h").agg(F.min("text").alias("text"))

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["toxic", "_h"], kind="stable")
        y = pdf["toxic"].to_numpy()
        if y.min() == y.max():
            return pd.DataFrame({"feature": [], "weight": []}, dtype=object)
        b, w = _learn(pdf["text"].tolist(), y, epochs, l1)
        return pd.DataFrame({"feature": ["", *w], "weight": [b, *w.values()]})

    got = (sample.select("text", "toxic", "_h").groupBy(F.lit(1).alias("_one"))
           .applyInPandas(learn, "feature string, weight double").collect())
    weights = {r["feature"]: r["weight"] for r in got}
    return weights.pop("", -30.0), weights


def score(docs: DataFrame, model: tuple[float, dict[str, float]], cut: float = CUT) -> DataFrame:
    """``docs`` plus ``score`` and ``sentences``: spans (start, end, p) with probability ``cut`` or more."""
    bias, weights = model
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # bounded by the fitted sample's words
    kept = docs.drop("score", "sentences")
    schema = T.StructType(kept.schema.fields + [
        T.StructField("score", T.DoubleType()),
        T.StructField("sentences", T.ArrayType(T.StructType([
            T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
            T.StructField("p", T.DoubleType())])))])
    empty_model = not weights

    def run(batches):
        w = shared.value
        memo: dict[str, float] = {}
        for pdf in batches:
            scores, spans = [], []
            for text in pdf["text"]:
                none, found = 0.0, []
                for start, end, ws in (() if empty_model else sentences(text)):
                    own: set[str] = set()
                    for x in ws:
                        v = memo.get(x)
                        if v is None:
                            if len(memo) > 400_000:
                                memo.clear()
                            v = memo[x] = [f for f in features_of(x) if f in w] or 0
                        if v:
                            own.update(v)
                    if not own:
                        continue
                    z = bias + sum(w[f] for f in own)
                    none += z + float(np.log1p(np.exp(-z))) if z > 0 else float(np.log1p(np.exp(z)))
                    p = 1 / (1 + float(np.exp(-max(min(z, 30.0), -30.0))))
                    if p >= cut:
                        found.append({"start": start, "end": end, "p": p})
                scores.append(-float(np.expm1(-none)))
                spans.append(found)
            yield pdf.assign(score=scores, sentences=spans)

    return kept.mapInPandas(run, schema)
