"""Token boundaries of two vocabularies aligned on the bytes that both spell.

Every text is encoded by a byte-level vocabulary (A: a space and the text) and a piece vocabulary (B: the
text, to which it adds the space itself), so both token rows tile the same bytes.  Per batch of documents
two ``merge_asof``, keyed by document, find for each token start the covering token of the other side;
the union of both directions is every overlapping pair (a link), and starts that meet cut both rows into groups.

How often a pair of ids is linked is counted in documents, corpus-wide.  A block of about ``BLOCK_BYTES``
of text sends each pair that it holds once, with its number of documents, so a frequent pair is one row per
block; the sums and each A id's highest go back to the blocks by joins.  Nothing is broadcast or collected.

Defined cases: a null or empty text, and one that a vocabulary does not spell byte for byte (say U+2581, which
B reads as a space), has no tokens, zeros and an empty ``groups``; names of special tokens inside a text are plain text; a
document is a row, so rows that repeat an id (or have none) count each; texts are encoded whole; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import saved
from strandline.llm.tokens import TOKENIZER, encoder, tokenizer_path

PIECES = "piece_bpe_32k.model"
SLAB_BYTES = 1 << 20  # text that is aligned in one go
BLOCK_BYTES = 16 << 20  # text whose pairs are sent together


def _byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabularies:
    """Both encoders and, by id, the bytes of their tokens."""

    def __init__(self, a: str = TOKENIZER, b: str = PIECES):
        import sentencepiece

        letters = _byte_alphabet()
        with open(tokenizer_path(a), encoding="utf-8") as f:
            entries = json.load(f)["model"]["vocab"]
        size = max(entries.values()) + 1
        self.a_bytes = self._table(size, {i: bytes(letters[c] for c in t) for t, i in entries.items()
                                          if all(c in letters for c in t)})
        self._pieces = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(b))
        n = self._pieces.get_piece_size()
        spelled = ((i, self._pieces.id_to_piece(i)) for i in range(n))
        self.b_bytes = self._table(n, {i: bytes([int(p[3:5], 16)]) if self._pieces.is_byte(i)
                                       else p.replace("▁", " ").encode() for i, p in spelled})
        self.a_length, self.b_length = (np.fromiter(map(len, t), dtype=np.int64, count=len(t))
                                        for t in (self.a_bytes, self.b_bytes))
        self._encode = encoder(a)
        names = [f"{i}{end}".encode() for k in (size, n) for i in range(k) for end in (",", "|" if k is size else ";")]
        self.names = np.array(names, dtype=object)
        self.size_a = size

    @staticmethod
    def _table(n: int, by_id: dict[int, bytes]) -> np.ndarray:
        out = np.empty(n, dtype=object)
        out[:] = b""
        for i, t in by_id.items():
            out[i] = t
        return out

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of both sides; none where they do not spell the text."""
        none = np.empty(0, dtype=np.int64)
        if not text:
            return none, none
        raw = f" {text}".encode("utf-8", "surrogatepass")
        a = self._encode(f" {text}").astype(np.int64)
        b = np.asarray(self._pieces.encode(text), dtype=np.int64)
        same = b"".join(self.a_bytes[a].tolist()) == raw and b"".join(self.b_bytes[b].tolist()) == raw
        return (a, b) if same else (none, none)


class Aligned:
    """The tokens of some documents, end to end, with their links and groups."""

    def __init__(self, words: Vocabularies, texts: list[str | None]):
        self.words = words
        ids = [words.encode(t) for t in texts]
        self.n_a = np.array([len(a) for a, _ in ids], dtype=np.int64)
        self.n_b = np.array([len(b) for _, b in ids], dtype=np.int64)
        self.a, self.b = (np.concatenate([x[k] for x in ids]) if ids else np.empty(0, np.int64) for k in (0, 1))
        doc = np.arange(len(ids))
        self.a_doc, self.b_doc = np.repeat(doc, self.n_a), np.repeat(doc, self.n_b)
        a_start, b_start = self._starts(words.a_length[self.a]), self._starts(words.b_length[self.b])
        side_a = pd.DataFrame({"start": a_start, "doc": self.a_doc, "a": np.arange(len(self.a))})
        side_b = pd.DataFrame({"start": b_start, "doc": self.b_doc, "b": np.arange(len(self.b))})
        cover_b = pd.merge_asof(side_a, side_b, on="start", by="doc")["b"].to_numpy(dtype=np.int64)
        cover_a = pd.merge_asof(side_b, side_a, on="start", by="doc")["a"].to_numpy(dtype=np.int64)
        self.a_first, self.b_first = b_start[cover_b] == a_start, a_start[cover_a] == b_start  # tokens that open a group
        other = np.flatnonzero(~self.b_first)  # both directions find the pairs whose starts meet
        self.link_a = np.concatenate([side_a["a"].to_numpy(), cover_a[other]])
        self.link_b = np.concatenate([cover_b, other])

    @staticmethod
    def _starts(lengths: np.ndarray) -> np.ndarray:
        return np.cumsum(lengths) - lengths

    def per_document(self, doc: np.ndarray) -> np.ndarray:
        return np.bincount(doc, minlength=len(self.n_a))

    def n_groups(self) -> np.ndarray:
        return self.per_document(self.a_doc[self.a_first])

    def n_links(self) -> np.ndarray:
        return self.per_document(self.a_doc[self.link_a])

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, pair, occurrences) of each document's distinct linked id pairs; pair is ``a << 32 | b``."""
        key = self.a[self.link_a] << 32 | self.b[self.link_b]
        code, distinct = pd.factorize(key)
        at, n = np.unique(self.a_doc[self.link_a] * max(1, len(distinct)) + code, return_counts=True)
        return at // max(1, len(distinct)), distinct[at % max(1, len(distinct))], n

    def groups(self) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of each document: ids of both sides, group by group."""
        g_a, g_b = np.cumsum(self.a_first) - 1, np.cumsum(self.b_first) - 1
        size_a, size_b = np.bincount(g_a, minlength=0), np.bincount(g_b, minlength=0)
        until_a, until_b = np.cumsum(size_a), np.cumsum(size_b)
        last_a, last_b = np.append(self.a_first[1:], True)[:len(g_a)], np.append(self.b_first[1:], True)[:len(g_b)]
        row = np.empty(len(g_a) + len(g_b), dtype=np.int64)
        if len(row):
            row[np.arange(len(g_a)) + (until_b - size_b)[g_a]] = 2 * self.a + last_a
            row[np.arange(len(g_b)) + until_a[g_b]] = 2 * (self.words.size_a + self.b) + last_b
        names = self.words.names[row]
        ends = np.cumsum(self.n_a + self.n_b)
        return [b"".join(names[lo:hi].tolist())[:-1] for lo, hi in zip(ends - self.n_a - self.n_b, ends)]


def _slabs(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Rows in order, cut where the texts reach ``SLAB_BYTES``."""
    size = pdf["text"].fillna("").str.len().to_numpy(dtype=np.int64)
    slab = (np.cumsum(size) - size) // SLAB_BYTES
    for lo, hi in zip(np.flatnonzero(np.diff(slab, prepend=-1)), np.append(np.flatnonzero(np.diff(slab)) + 1, len(pdf))):
        yield pdf.iloc[lo:hi]


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def alignments(docs: DataFrame, a: str = TOKENIZER, b: str = PIECES) -> DataFrame:
    """(doc_id, groups): the ids of both sides as ``a1,a2|b1;a3|b2,b3``, one part per group."""
    def run(batches):
        words = Vocabularies(a, b)
        for pdf in batches:
            for slab in _slabs(pdf):
                found = Aligned(words, slab["text"].tolist())
                yield pd.DataFrame({"doc_id": slab["doc_id"].astype("Int64").to_numpy(),
                                    "groups": [g.decode() for g in found.groups()]})

    return _plain(docs).mapInPandas(run, "doc_id long, groups string")


COUNTS = ("n_a", "n_b", "n_groups", "n_links")
BLOCKS = ("block long, doc_id array<long>, " + "".join(f"{c} array<long>, " for c in COUNTS)
          + "groups_sha256 array<string>, pairs array<long>, pair_docs array<long>, n_pairs array<int>, "
            "places binary, occurrences binary")


def _packed(values: np.ndarray) -> bytes:
    import zstandard

    return zstandard.compress(values.astype("<u4").tobytes(), 3)


def _unpacked(data: bytes) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.decompress(data), dtype="<u4")


class _Block:
    def __init__(self, number: int):
        self.number, self.size, self.ids, self.hashes = number, 0, [], []
        self.counts = {c: [] for c in COUNTS}
        self.docs, self.keys, self.times = [], [], []

    def add(self, slab: pd.DataFrame, found: Aligned) -> None:
        doc, key, n = found.pairs()
        self.docs.append(doc + len(self.ids))
        self.keys.append(key)
        self.times.append(n)
        self.ids.extend(None if pd.isna(i) else int(i) for i in slab["doc_id"])
        for c, v in zip(COUNTS, (found.n_a, found.n_b, found.n_groups(), found.n_links())):
            self.counts[c].append(v)
        self.hashes.extend(hashlib.sha256(g).hexdigest() if g else "" for g in found.groups())
        self.size += int(slab["text"].fillna("").str.len().sum())

    def row(self) -> pd.DataFrame:
        code, pairs = pd.factorize(np.concatenate(self.keys))
        per_doc = np.bincount(np.concatenate(self.docs), minlength=len(self.ids))
        return pd.DataFrame({"block": [self.number], "doc_id": [self.ids],
                             **{c: [np.concatenate(v)] for c, v in self.counts.items()},
                             "groups_sha256": [self.hashes], "pairs": [pairs],
                             "pair_docs": [np.bincount(code, minlength=len(pairs))], "n_pairs": [per_doc.astype(np.int32)],
                             "places": [_packed(code)], "occurrences": [_packed(np.concatenate(self.times))]})


def _blocks(docs: DataFrame, a: str, b: str, block_bytes: int) -> DataFrame:
    def run(batches):
        words, part = Vocabularies(a, b), TaskContext.get().partitionId()
        block = _Block(part << 32)
        for pdf in batches:
            for slab in _slabs(pdf):
                block.add(slab, Aligned(words, slab["text"].tolist()))
                if block.size >= block_bytes:
                    yield block.row()
                    block = _Block(block.number + 1)
        if block.ids:
            yield block.row()

    return _plain(docs).mapInPandas(run, BLOCKS)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, n_docs, best): in how many documents each pair of ids is linked, and whether that is its A id's highest."""
    held = blocks.select(F.explode(F.arrays_zip("pairs", "pair_docs")).alias("p")).select("p.*")
    total = held.groupBy(F.col("pairs").alias("pair")).agg(F.sum("pair_docs").alias("n_docs"))
    top = total.groupBy(F.shiftright("pair", 32).alias("top_a")).agg(F.max("n_docs").alias("top"))
    return total.join(top, F.shiftright("pair", 32) == F.col("top_a")).select(
        "pair", "n_docs", (F.col("n_docs") == F.col("top")).alias("best"))


def align(docs: DataFrame, a: str = TOKENIZER, b: str = PIECES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: tokens of both sides, groups and their hash, links, links whose pair is the best of its A
    id (``n_best``), and the document counts of all links' pairs added up (``count_sum``)."""
    blocks = saved(_blocks(docs, a, b, block_bytes), "token-blocks")
    counted = pair_counts(blocks)
    asked = blocks.select("block", F.posexplode("pairs").alias("place", "asked"))
    answers = asked.join(counted, F.col("asked") == F.col("pair")).select(
        F.col("block").alias("to"), "place", "n_docs", "best")

    def run(own: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        r = own.iloc[0]
        n_docs, best = np.zeros(len(got), np.int64), np.zeros(len(got), np.int64)
        at = got["place"].to_numpy()
        n_docs[at], best[at] = got["n_docs"].to_numpy(), got["best"].to_numpy()
        place, times = _unpacked(r["places"]), _unpacked(r["occurrences"]).astype(np.int64)
        ends = np.cumsum(r["n_pairs"])
        sums = [np.concatenate([[0], np.cumsum(times * v[place])]) for v in (best, n_docs)]
        return pd.DataFrame({"doc_id": pd.array([None if i is None or i != i else int(i) for i in r["doc_id"]], dtype="Int64"),
                             **{c: r[c] for c in COUNTS},
                             **{c: s[ends] - s[ends - r["n_pairs"]] for c, s in zip(("n_best", "count_sum"), sums)},
                             "groups_sha256": r["groups_sha256"]})

    own = blocks.drop("pairs", "pair_docs")
    return own.groupBy("block").cogroup(answers.groupBy("to")).applyInPandas(
        run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
