"""Token alignment, longest previous factors and centroid clustering against brute force."""

import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF_SMALL
from strandline.llm import centroids, crosstok, factors, mixing, packing, tokens, toxicity, warc, wrappers

DOCS = "doc_id long, text string"


def with_clashes(df, names):
    for c in names:
        df = df.withColumn(c, F.lit("x"))
    return df


# ---- 11 token alignment

def plain_alignment(rows):
    """Per row the contract's columns, by loops over bytes and the unmodified tokenizers."""
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    ta = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ta.encode_special_tokens = True
    tb = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letters = crosstok._byte_alphabet()

    def a_bytes(i):
        return bytes(letters[c] for c in ta.id_to_token(i))

    def b_bytes(i):
        p = tb.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if tb.is_byte(i) else p.replace("▁", " ").encode()

    found = []
    for _, text in rows:
        a = ta.encode(" " + text, add_special_tokens=False).ids if text else []
        b = list(tb.encode(text)) if text else []
        raw = (" " + (text or "")).encode()
        if not text or b"".join(map(a_bytes, a)) != raw or b"".join(map(b_bytes, b)) != raw:
            found.append(([], [], [], ""))
            continue
        ends_a, ends_b = np.cumsum([len(a_bytes(i)) for i in a]).tolist(), np.cumsum([len(b_bytes(i)) for i in b]).tolist()
        links, j = [], 0
        for i in range(len(a)):
            lo, hi = ends_a[i - 1] if i else 0, ends_a[i]
            while j and (ends_b[j - 1] if j else 0) > lo:
                j -= 1
            k = j
            while k < len(b) and (ends_b[k - 1] if k else 0) < hi:
                if ends_b[k] > lo:
                    links.append((a[i], b[k]))
                k += 1
            j = max(0, k - 1)
        both = sorted(set(ends_a) & set(ends_b))
        parts, i, j = [], 0, 0
        for e in both:
            i2, j2 = ends_a.index(e, i) + 1, ends_b.index(e, j) + 1
            parts.append(",".join(map(str, a[i:i2])) + "|" + ",".join(map(str, b[j:j2])))
            i, j = i2, j2
        found.append((a, b, links, ";".join(parts)))
    held = collections.Counter(p for _, _, links, _ in found for p in set(links))
    top = collections.Counter()
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    return [(r[0], len(a), len(b), g.count(";") + 1 if g else 0, len(links), sum(held[p] == top[p[0]] for p in links),
             sum(held[p] for p in links), hashlib.sha256(g.encode()).hexdigest() if g else "", g)
            for r, (a, b, links, g) in zip(rows, found)]


def token_rows():
    rng = random.Random(11)
    letters = "abc  deéßж中\U0001f600\n\t.,0123'"
    rows = [(i, "".join(rng.choice(letters) for _ in range(rng.randrange(1, 200)))) for i in range(60)]
    return rows + [(100, None), (101, ""), (102, "sep ▁ sign"), (103, "a <|endoftext|> b </s> <unk> <0x41>"),
                   (104, "x"), (104, "x"), (None, "the same words"), (105, "the same words"), (106, " \n"),
                   (107, "word " * 30_000), (108, "a\x00b")]


def test_alignment_equals_loops(spark):
    rows = token_rows()
    docs = with_clashes(spark.createDataFrame(rows, DOCS).repartition(3), ("block", "pairs", "n_a", "best", "place"))
    want = plain_alignment(rows)
    assert {g.count("|") for *_, g in want} - {0}
    for block_bytes in (300, crosstok.BLOCK_BYTES):
        got = [tuple(r) for r in crosstok.align(docs, block_bytes=block_bytes).collect()]
        assert sorted(got, key=str) == sorted((w[:8] for w in want), key=str)
    texts = [tuple(r) for r in crosstok.alignments(docs).collect()]
    assert sorted(texts, key=str) == sorted(((w[0], w[8]) for w in want), key=str)
    assert crosstok.align(docs.where("false")).count() == 0


def test_alignment_of_slabs(spark, monkeypatch):
    rows = token_rows()[:30]
    monkeypatch.setattr(crosstok, "SLAB_BYTES", 100)
    words = crosstok.Vocabularies()
    import pandas as pd
    pdf = pd.DataFrame(rows, columns=["doc_id", "text"])
    slabs = list(crosstok._slabs(pdf))
    assert len(slabs) > 5 and pd.concat(slabs).equals(pdf)
    whole = crosstok.Aligned(words, pdf["text"].tolist()).groups()
    assert [g for s in slabs for g in crosstok.Aligned(words, s["text"].tolist()).groups()] == whole


def test_alignment_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in entry.queries()["op11_token_alignment"](spark, SF_SMALL).collect()]
    assert sorted(got) == sorted(w[:8] for w in plain_alignment(rows))


# ---- 12 longest previous factors

def plain_removal(rows, length=50):
    first = {}
    for i, t in rows:
        u = (t or "").encode()
        for p in range(len(u) - length + 1) if i is not None else ():
            w = u[p:p + length]
            first[w] = min(first.get(w, i), i)
    out = []
    for i, t in rows:
        u = (t or "").encode()
        gone = np.zeros(len(u), bool)
        for p in range(len(u) - length + 1) if i is not None else ():
            if first[u[p:p + length]] < i:
                gone[p:p + length] = True
        kept = bytes(np.frombuffer(u, np.uint8)[~gone])
        runs = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((i, len(u), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def repeat_rows(seed=12, n=120):
    rng = random.Random(seed)
    word = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(2, 8))) for _ in range(60)]

    def prose(k):
        return " ".join(rng.choice(word) for _ in range(k))

    common = [prose(k) for k in (9, 12, 30, 120)]
    base = [prose(rng.randrange(5, 150)) for _ in range(20)]
    rows = []
    for i in range(n):
        kind = rng.randrange(5)
        t = rng.choice(base)
        if kind == 1:
            t = prose(10) + rng.choice(common) + prose(20) + rng.choice(common)
        if kind == 2:  # an edited copy
            w = t.split(" ")
            w[rng.randrange(len(w))] = "edited"
            t = " ".join(w)
        if kind == 3:
            t = prose(rng.randrange(3, 60))
        if kind == 4:
            t = "x" + t * 2
        rows.append((rng.randrange(1000), t))
    return rows + [(2000, None), (2001, ""), (None, base[0]), (2002, "a" * 400), (2003, "a" * 49), (2004, "a" * 50), (2005, "a" * 120),
                   (2006, "\x00" * 70), (2007, "b" + "\x00" * 60), (2008, base[1] + common[3] * 40), (-5, common[3])]


def rest(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_bytes", "n_removed", F.size("span_starts").alias("n"),
                                                F.sha2("kept", 256).alias("h")).collect()), key=str)


@pytest.mark.parametrize("options", [{}, {"block_bytes": 2000, "range_bytes": 3000, "bucket_bytes": 1000},
                                     {"block_bytes": 5000, "many": 3}])
def test_removal_equals_brute_force(spark, options):
    rows = repeat_rows()
    docs = with_clashes(spark.createDataFrame(rows, DOCS).repartition(3), ("block", "start", "n", "kept", "range"))
    assert rest(factors.remove_repeats(docs, **options)) == sorted(plain_removal(rows), key=str)


def test_removal_of_nothing(spark):
    assert factors.remove_repeats(spark.createDataFrame([], DOCS)).count() == 0


def test_spans_and_rest_make_the_text(spark):
    rows = repeat_rows(5, 40)
    texts = collections.defaultdict(list)
    for i, t in rows:
        texts[i].append((t or "").encode())
    for r in factors.remove_repeats(spark.createDataFrame(rows, DOCS)).collect():
        kept = []
        for u in texts[r["doc_id"]]:
            edges = [0, *[x for s in zip(r["span_starts"], r["span_ends"]) for x in s], len(u)]
            kept.append(b"".join(u[a:b] for a, b in zip(edges[::2], edges[1::2])))
        assert bytes(r["kept"]) in kept


def test_previous_factors_equal_loops():
    rng = np.random.default_rng(4)
    data = rng.integers(0, 3, 700).astype(np.uint8)
    data[300:400] = data[20:120]
    for length in (12, 20, 50):
        at = np.sort(rng.choice(len(data) - length, 200, replace=False))
        owner = rng.integers(0, 6, len(at))
        got = factors.previous_factors(data, at, owner, length)
        for i in range(len(at)):
            best = 0
            for j in np.flatnonzero(owner < owner[i]):
                k = 0
                while k < length and data[at[i] + k] == data[at[j] + k]:
                    k += 1
                best = max(best, k)
            assert got[i] == best


def test_slabs_do_not_change_fragments():
    rng = random.Random(2)
    parts = [t.encode() for _, t in repeat_rows(9, 30) if t]
    rng.shuffle(parts)
    data, sizes = np.frombuffer(b"".join(parts), np.uint8), np.array(list(map(len, parts)))
    ok = np.ones(len(parts), bool)
    whole = factors.Fragments(data, sizes, ok)
    for slab in (64, 777):
        cut = factors.Fragments(data, sizes, ok, slab=slab)
        assert (cut.start == whole.start).all() and (cut.n == whole.n).all()
    assert whole.n.sum() == sum(max(0, len(p) - 49) for p in parts)


def test_removal_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in entry.queries()["op12_longest_previous_factor"](spark, SF_SMALL).collect()]
    want = plain_removal(rows)
    assert sorted(got) == sorted(want) and sum(w[2] for w in want) > 0


# ---- 13 centroids

def plain_clusters(rows, k=16, dim=64, rounds=3):
    def ok(v):
        return v is not None and len(v) == dim and all(x is not None and np.isfinite(x) for x in v)

    def whole(x):  # floor(64 x), exact for any double
        n, d = float(x).as_integer_ratio()
        return 64 * n // d

    kept = [(i, [whole(x) for x in v]) for i, v in rows if ok(v)]
    seeds = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), q) for i, q in kept if i is not None)
    c = [q for _, q in seeds[:k]]
    if not c:
        return []

    def near(q):
        return min((sum((x - y) ** 2 for x, y in zip(q, m)), j) for j, m in enumerate(c))

    for _ in range(rounds):
        own = collections.defaultdict(list)
        for _, q in kept:
            own[near(q)[1]].append(q)
        c = [[sum(x) // len(own[j]) for x in zip(*own[j])] if own[j] else m for j, m in enumerate(c)]
    last = [(i, *near(q)) for i, q in kept]
    total = collections.Counter()
    for _, s, j in last:
        total[j] += s
    def long(v):
        return v if v < 2 ** 63 else None
    lost = {j for _, s, j in last if long(s) is None}
    return [(i, j, long(s), None if j in lost else long(total[j]), None if lost else long(sum(total.values())),
             hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest()) for i, s, j in last]


def vector_rows(n, seed, wide=False):
    rng = np.random.default_rng(seed)
    rows = [(int(i), (rng.normal(size=64) / 4).astype(np.float32).tolist()) for i in range(n)]
    bad = [float("nan"), float("inf"), -float("inf")]
    rows += [(n + 1, None), (n + 2, []), (n + 3, [0.5] * 63), (n + 4, [0.5] * 65), (n + 5, [None] + [0.5] * 63),
             *((n + 6, [b] + [0.5] * 63) for b in bad), (3, rows[3][1]), (4, rows[5][1]), (None, rows[6][1]), (n + 9, [0.0] * 64),
             (n + 10, [-1e-30] * 64)]
    if wide:
        rows += [(n + 11, [3e6] * 64), (n + 12, [1e30, -1e30] * 32)]
    return rows


@pytest.mark.parametrize("n, wide", [(150, False), (0, False), (90, True)])
def test_clusters_equal_loops(spark, n, wide):
    rows = vector_rows(n, 13, wide) if n else []
    kind = "double" if wide else "float"
    df = with_clashes(spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(3),
                      ("cluster", "x", "h", "distance", "label"))
    got = [tuple(r) for r in centroids.cluster(df).collect()]
    assert sorted(got, key=str) == sorted(plain_clusters(rows), key=str)


def test_few_vectors_make_few_centroids(spark):
    rows = vector_rows(7, 5)[:7]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert [r["distance"] for r in centroids.cluster(df).collect()] == [0] * 7


def test_limbs():
    for v in (0, 1, -1, 2 ** 39, 2 ** 40, -2 ** 40, 2 ** 63, -2 ** 90 + 12345, 10 ** 40):
        parts = list(centroids._limbs(v))
        assert sum(p << (centroids.LIMB * k) for k, p in parts) == v and all(abs(p) < 2 ** 41 for _, p in parts)


# ---- cases found in earlier operators

PLAIN_PAGES = [
    ('<div id="page" class="site has-sidebar"><main><p>text</p></main></div>', "text"),
    ('<div class="with-sidebar"><article><p>text</p></article></div>', "text"),
    ('<div class="page social"><article><p>text</p></article></div>', "text"),
    ('<div class="search results"><main><p>text</p></main></div>', "text"),
    ('<form id="aspnetForm"><main><p>text</p></main><input></form>', "text"),
    ('<article><p>text</p><section id="comments"><p>no</p></section><div class="comment-list">no</div>'
     '<div class="social-share">no</div><section id="social-effects"><h2 id="related-work">Rel</h2><p>yes</p></section></article>',
     "text Rel yes"),
    ('<article><p>x <span class="ad">A<span>B</span>C</span> y</p></article>', "x y"),
    ('<div class="search results"><div><p>only</p></div></div>', "only"),
    ('<div class="sidebar-left"><p>x</p></div><div><p>body</p></div>', "body"),
    ('<main><p>text</p></main><div id="thread"><article class="comment">nice</article></div>', "text"),
    ('<div hidden><main>x</main></div>', ""), ("<nav>Home</nav>", "")]


@pytest.mark.parametrize("page, want", PLAIN_PAGES)
def test_no_page_is_lost(page, want):
    assert wrappers.main_text(page, None, None) == want


def plain_matching(a, b):
    """The most nodes of an order-keeping, top-down match, by trying every choice."""
    if a.label != b.label:
        return 0

    def best(x, y):
        if not x or not y:
            return 0
        return max(best(x[1:], y), best(x, y[1:]), plain_matching(x[0], y[0]) + best(x[1:], y[1:]))

    return 1 + best(a.kids, b.kids)


def test_tree_matching_equals_every_choice():
    rng = random.Random(6)

    def tree(depth):
        s = wrappers.Slot(rng.choice("ab"))
        s.kids = [tree(depth - 1) for _ in range(rng.randrange(4))] if depth else []
        return s

    for _ in range(60):
        a, b = tree(3), tree(3)
        assert wrappers.matching(a, b, {}) == plain_matching(a, b)
        if a.label == b.label:
            pairs = wrappers.matched_kids(a, b, {})
            assert pairs == sorted(pairs) and 1 + sum(plain_matching(a.kids[i], b.kids[j]) for i, j in pairs) == plain_matching(a, b)


@pytest.mark.parametrize("ids", ["equal", "null", "some"])
def test_mixing_takes_equal_rows_one_by_one(spark, ids):
    text = " ".join(["w"] * 10)
    rows = [(None if ids == "null" else 1 if ids == "equal" or i % 3 else i, text, "s") for i in range(1000)]
    rows += [(5000 + i, text, "t") for i in range(250)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df, keep=("doc_id", "text", "source")).collect()
    assert len(got) == 1250
    for s in "st":
        own = [r for r in got if r["source"] == s]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 10 and all(r["taken"] <= 20 for r in own)
    again = mixing.mix(df).collect()
    key = lambda r: (str(r["doc_id"]), r["taken"], r["source_size"])
    assert sorted(map(key, again)) == sorted(map(key, got))


def test_packing_spreads_equal_rows(spark):
    df = spark.createDataFrame([(7, "the same words")] * 2000, DOCS)
    got = packing.pack_documents(df, per_group=100).collect()
    assert len({r["sequence_id"] >> 32 for r in got}) == 20 and len(got) == 2000


def test_sample_bound_holds_for_repeated_ids(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "_learn", lambda texts, y, epochs, l1: (0.0, {f"n{len(texts)}": 1.0}))
    docs = spark.createDataFrame([(i % 3, f"text {i}") for i in range(300)], DOCS)
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, 0), (0, 1)], "doc_id long, toxic int")
    _, weights = toxicity.fit(docs, labels, max_docs=10)
    assert list(weights) == ["n3"] and not seen


def test_cut_archives_raise(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"<p>{i}</p>") for i in range(20)], "page_id long, url string, html string")
    folder = f"{tmp_path}/raw"
    made = warc.write(pages.coalesce(1), folder)
    path = f"{folder}/{made.first()['file']}"
    whole = open(path, "rb").read()

    def read(data):
        import io
        return sum(1 for _ in warc.records(warc.inflated(io.BytesIO(data))))

    assert read(whole) == 20 and read(b"") == 0 and read(whole + whole) == 40
    for cut in (1, 4, 8, 9, 30):
        with pytest.raises(ValueError):
            read(whole[:-cut])


def test_very_long_white_space_is_encoded():
    text = "a" + " " * 1_600_000 + "b"
    ids = tokens.encoder()(text)
    from tokenizers import Tokenizer
    full = Tokenizer.from_file(tokens.tokenizer_path(tokens.TOKENIZER))
    full.encode_special_tokens = True
    assert ids.tolist() == full.encode(text, add_special_tokens=False).ids
