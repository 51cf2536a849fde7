"""Language-model scores of texts by a weighted backoff automaton over all training documents.

The automaton has a root, a start state and a state per word.  An arc (state, word) for a bigram seen in
training weighs ``log10((c + m p) / (n + m))``; a state's failure arc to the root weighs
``log10(m / (n + m))`` and the root's arc for a word ``log10(p)``.  c and n count the bigram and the state in
training, ``m = ALPHA * n ** BETA``, p is the smoothed unigram probability.  Every state's
probabilities sum to what the root's do.  An unknown word leads to the root.

The automaton grows with the corpus and is never held whole.  Documents are read in blocks of about
``BLOCK_TOKENS`` tokens.  A block sends its distinct words and bigrams with its own training counts, packed
by hash range; each range adds up all blocks and answers every block with the totals of just the keys it asked for:
the part of the automaton that its texts can reach.  The block then runs its texts through that part, left to
right.  Each block sends a key once, so a frequent word is no hot key; there are as many ranges as the corpus has
``RANGE_CHARS``, so what one range holds does not grow with it.  Blocks wait as files in the shared folder.

Defined cases: a null or empty text is its end token alone; rows with a null id are scored and in no held-out
fold; rows that repeat an id are scored each and count each in training; without training documents every
count is 0; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import io
import zlib

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import crc_mod, saved, shared_path
from strandline.llm.files import new_file, opened

BLOCK_TOKENS = 2_000_000
RANGE_CHARS = 16_000_000  # characters of text per hash range
ALPHA, BETA = 5.0, 0.8
END, START = np.uint64(xxhash.xxh3_64_intdigest(b"\n")), np.uint64(xxhash.xxh3_64_intdigest(b"\n\n"))  # no word has white space


def _mix(v: np.ndarray) -> np.ndarray:
    v = (v ^ (v >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    v = (v ^ (v >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return v ^ (v >> np.uint64(33))


def _bigrams(states: np.ndarray, words: np.ndarray) -> np.ndarray:
    return _mix(states * np.uint64(0x9E3779B97F4A7C15) + words)


def _pack(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, bytes of one rank together, deflated."""
    d = np.diff(keys, prepend=np.uint64(0))
    return zlib.compress(d.view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def _unpack(blob: bytes) -> np.ndarray:
    raw = np.frombuffer(zlib.decompress(blob), dtype=np.uint8)
    return np.cumsum(np.ascontiguousarray(raw.reshape(8, -1).T).view(np.uint64).ravel(), dtype=np.uint64)


def _pack_counts(counts: np.ndarray) -> bytes:
    return zlib.compress(np.asarray(counts, dtype=np.int64).view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def _unpack_counts(blob: bytes) -> np.ndarray:
    raw = np.frombuffer(zlib.decompress(blob), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(8, -1).T).view(np.int64).ravel()


def _states(ids: np.ndarray, lengths: np.ndarray, start: int) -> np.ndarray:
    """The state before each token: the word before it, at a text's first token the start."""
    before = np.empty_like(ids)
    before[1:] = ids[:-1]
    before[np.cumsum(lengths) - lengths] = start
    return before


def _block(texts: list[str | None], train: np.ndarray, memo: dict[bytes, int]) -> dict[str, np.ndarray]:
    """Token ids of a block (0 is the start, 1 the end) with the hashes of its distinct words, and its keys."""
    place: dict[bytes, int] = {}
    found, lengths = [], []
    for t in texts:
        ws = (t or "").encode("utf-8", "surrogatepass").lower().split()
        for w in ws:
            if w not in place:
                place[w] = len(place) + 2
        found.append(np.fromiter(map(place.__getitem__, ws), dtype=np.int64, count=len(ws)))
        lengths.append(len(ws) + 1)
    lengths = np.asarray(lengths, dtype=np.int64)
    ids = np.concatenate([x for f in found for x in (f, [1])]).astype(np.int64)
    hashes = np.concatenate([np.array([START, END]), np.fromiter(
        map(xxhash.xxh3_64_intdigest, place), dtype=np.uint64, count=len(place))])
    seen = np.repeat(train, lengths)
    return {"ids": ids.astype(np.uint32), "lengths": lengths, "hashes": hashes, "seen": seen}


def _word_counts(b: dict[str, np.ndarray]) -> np.ndarray:
    counts = np.bincount(b["ids"][b["seen"]], minlength=len(b["hashes"]))
    counts[0] = b["seen"][np.cumsum(b["lengths"]) - b["lengths"]].sum()  # how often the start state is left
    return counts


def _bigram_keys(b: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    ids = b["ids"].astype(np.int64)
    keys = _bigrams(b["hashes"][_states(ids, b["lengths"], 0)], b["hashes"][ids])
    return np.unique(keys, return_inverse=True)


def _requests(docs: DataFrame, folder: str, bits: int) -> DataFrame:
    """(block, bucket, words, word_counts, bigrams, bigram_counts); the blocks themselves go to ``folder``."""
    edges = (np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else np.array([], np.uint64)

    def run(batches):
        from pyspark import TaskContext

        part, made = TaskContext.get().partitionId(), 0

        def emit(rows: list) -> pd.DataFrame:
            nonlocal made
            name = f"block-{part:06d}-{made:05d}.npz"
            made += 1
            b = _block([r[1] for r in rows], np.array([bool(r[2]) for r in rows]), {})
            w_order = np.argsort(b["hashes"])
            words, w_counts = b["hashes"][w_order], _word_counts(b)[w_order]
            keys, inverse = _bigram_keys(b)
            k_counts = np.bincount(inverse[b["seen"]], minlength=len(keys))
            file = io.BytesIO()
            np.savez(file, ids=b["ids"], lengths=b["lengths"], hashes=b["hashes"],
                     doc=np.array([0 if pd.isna(r[0]) else r[0] for r in rows], dtype=np.int64),
                     null=np.array([pd.isna(r[0]) for r in rows]), held=np.array([bool(r[3]) for r in rows]))
            with new_file(folder, name) as out:
                out.write(zlib.compress(file.getvalue(), 1))
            w_cut, k_cut = ([0, *np.searchsorted(x, edges).tolist(), len(x)] for x in (words, keys))
            return pd.DataFrame([
                (name, i, _pack(words[a:z]), _pack_counts(w_counts[a:z]), _pack(keys[c:d]), _pack_counts(k_counts[c:d]))
                for i, (a, z, c, d) in enumerate(zip(w_cut[:-1], w_cut[1:], k_cut[:-1], k_cut[1:])) if a < z or c < d],
                columns=["block", "bucket", "words", "word_counts", "bigrams", "bigram_counts"])

        held, chars = [], 0
        for pdf in batches:
            for row in zip(pdf["doc_id"], pdf["text"], pdf["train"], pdf["held_out"]):
                held.append(row)
                chars += len(row[1] or "") + 6
                if chars >= 6 * BLOCK_TOKENS:
                    yield emit(held)
                    held, chars = [], 0
        if held:
            yield emit(held)

    return docs.mapInPandas(run, "block string, bucket int, words binary, word_counts binary, bigrams binary, "
                                 "bigram_counts binary")


def _totals(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """The sums of ``counts`` by key, for each list in its own order, and the distinct keys with their sums."""
    distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(inverse, weights=np.concatenate(counts), minlength=len(distinct)).astype(np.int64)
    cuts = np.cumsum([len(k) for k in keys])[:-1]
    return np.split(total[inverse], cuts), distinct, total


def _answers(requests: DataFrame) -> DataFrame:
    """(block, bucket, word_counts, bigram_counts, kinds, tokens): totals of the keys each block asked for; kinds and
    tokens are the bucket's distinct training words and their occurrences, on one row per bucket."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block", ignore_index=True)
        word_sums, distinct, total = _totals([_unpack(x) for x in pdf["words"]],
                                             [_unpack_counts(x) for x in pdf["word_counts"]])
        real = distinct != START
        pair_sums, _, _ = _totals([_unpack(x) for x in pdf["bigrams"]], [_unpack_counts(x) for x in pdf["bigram_counts"]])
        kinds, tokens = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
        kinds[0], tokens[0] = int((total[real] > 0).sum()), int(total[real].sum())
        return pd.DataFrame({"block": pdf["block"], "bucket": pdf["bucket"], "word_counts": list(map(_pack_counts, word_sums)),
                             "bigram_counts": list(map(_pack_counts, pair_sums)), "kinds": kinds, "tokens": tokens})

    return requests.groupBy("bucket").applyInPandas(
        run, "block string, bucket int, word_counts binary, bigram_counts binary, kinds long, tokens long")


def traverse(b: dict[str, np.ndarray], words: np.ndarray, pairs: np.ndarray, inverse: np.ndarray, tokens: int, kinds: int,
             alpha: float = ALPHA, beta: float = BETA) -> dict[str, np.ndarray]:
    """Run a block's texts through the automaton: ``words`` are the counts by word id, ``pairs`` those of the distinct
    bigrams, ``inverse`` the bigram of each token."""
    ids = b["ids"].astype(np.int64)
    doc = np.repeat(np.arange(len(b["lengths"])), b["lengths"])
    root = np.log10((words + 0.5) / (tokens + 0.5 * (kinds + 1)))  # the root's arcs
    mass = np.where(words > 0, alpha * np.power(np.maximum(words, 1), beta), 1.0)
    fail = np.where(words > 0, np.log10(mass / (words + mass)), 0.0)  # failure arcs; unknown words are the root itself
    state = _states(ids, b["lengths"], 0)
    seen = pairs[inverse]
    arc = np.log10((seen + mass[state] * 10.0 ** root[ids]) / (words[state] + mass[state]))
    step = np.where(seen > 0, arc, fail[state] + root[ids])
    n = len(b["lengths"])
    return {"n_tokens": b["lengths"], "n_known": np.bincount(doc[words[ids] > 0], minlength=n),
            "base_score": np.bincount(doc, weights=root[ids], minlength=n), "score": np.bincount(doc, weights=step, minlength=n)}


def score(docs: DataFrame, fold: int = 1, folds: int = 5, alpha: float = ALPHA, beta: float = BETA) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document, learnt from those
    outside ``fold``."""
    spark = docs.sparkSession
    folder = shared_path(spark, "lm-blocks")
    chars = docs.agg(F.sum(F.length(F.col("text").cast("string")) + 6)).first()[0] or 0
    bits = max(3, (chars // RANGE_CHARS).bit_length())
    held = F.coalesce(crc_mod(F.col("doc_id"), folds) == fold, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       (~held).alias("train"), held.alias("held_out"))
    answers = saved(_answers(_requests(rows, folder, bits)), "lm-counts")
    total = answers.agg(F.sum("tokens").alias("n"), F.sum("kinds").alias("v")).first()
    tokens, kinds = int(total["n"] or 0), int(total["v"] or 0)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("bucket")
        system, path = opened(folder)
        with system.open_input_stream(f"{path}/{pdf['block'].iloc[0]}", compression=None) as f:
            b = dict(np.load(io.BytesIO(zlib.decompress(f.read()))))
        sums = np.concatenate([_unpack_counts(x) for x in pdf["word_counts"]])
        words = np.empty_like(sums)
        words[np.argsort(b["hashes"])] = sums
        pairs = np.concatenate([_unpack_counts(x) for x in pdf["bigram_counts"]])
        _, inverse = _bigram_keys(b)
        got = traverse(b, words, pairs, inverse, tokens, kinds, alpha, beta)
        doc = pd.array(b["doc"], dtype="Int64")
        doc[b["null"]] = pd.NA
        return pd.DataFrame({"doc_id": doc, "held_out": b["held"], **got})

    out = answers.select("block", "bucket", "word_counts", "bigram_counts").groupBy("block").applyInPandas(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return out.withColumn("train_tokens", F.lit(tokens).cast("long"))
