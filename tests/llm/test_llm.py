"""Training-data operators against brute force, with nulls, empty and long texts, ties, repeats, empty tables and
extra columns whose names clash with the operators' own."""

import collections
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.llm import (crosspolytope, lm, mixing, neardup, packing, quality, stages, tokenfiles, tokens, toxicity,
                            warc, wrappers)
from strandline.llm.common import shared_path

WORDS = "alpha beta gamma delta omega sigma kappa theta lambda epsilon zeta eta iota mu nu xi pi rho tau phi".split()
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ("score", "sentences", "kept", "rejected_by", "size", "key", "order", "taken", "copies", "_words", "rep", "token")


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n))


def corner_rows():
    rng = random.Random(3)
    same = prose(rng, 80)
    return [(1, None, None, None, None), (2, "", "en", "s", 0), (3, " \n\t ", "en", "s", 4), (None, prose(rng, 60), "en", "s", 9),
            (5, same, "en", None, 1), (6, same, "en", "s", 1), (7, same, "de", "t", 1), (7, same, "de", "t", 1),
            (8, prose(rng, 60_000), "en", "t", 2), (9, "one two", "en", "", 3), (10, "a" * 200_000, "en", "t", 4),
            (-4, "Émile ÀB x \U0001f600 <|endoftext|> ok", "fr", "t", 5)]


@pytest.fixture(scope="module")
def corner(spark):
    df = spark.createDataFrame(corner_rows(), DOCS)
    for c in CLASH:
        df = df.withColumn(c, F.lit("x"))
    return df


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


# ---- 1 toxicity

def toxic_docs(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        bad = i % 3 == 0
        s = [" ".join(rng.choice(WORDS) for _ in range(8)) for _ in range(6)]
        if bad:
            s[rng.randrange(6)] += " grubling" if i % 2 else " snarkel"
        rows.append((seed * 10_000 + i, ". ".join(s) + ".", int(bad)))
    return rows


def test_toxicity_learns_from_documents_and_locates_sentences(spark, corner, nothing):
    train = spark.createDataFrame(toxic_docs(240, 1), "doc_id long, text string, toxic int")
    model = toxicity.fit(train, train)
    held = toxic_docs(120, 2)
    got = toxicity.score(spark.createDataFrame(held, "doc_id long, text string, toxic int"), model).collect()
    assert sum((r["score"] >= toxicity.THRESHOLD) == bool(r["toxic"]) for r in got) >= 118
    for r in got:
        for s in r["sentences"]:
            assert any(w in r["text"][s["start"]:s["end"]] for w in ("grubling", "snarkel"))
    out = toxicity.score(corner, model).collect()
    assert len(out) == 12 and all(0 <= r["score"] <= 1 for r in out)
    assert [r["score"] for r in out if not (r["text"] or "").strip()] == [0.0] * 3
    assert toxicity.score(nothing, model).count() == 0
    assert toxicity.score(corner, toxicity.fit(train, train.where("toxic = 0"))).agg(F.max("score")).first()[0] == 0.0


# ---- 2 near duplicates

def exact_components(rows, percent):
    memo, parent, sets = {}, {}, {}
    for i, t in rows:
        if i is not None:
            parent[i], sets[i] = i, set(neardup.shingles(t, memo).tolist())

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_rows():
    rng = random.Random(5)
    rows, base = [], [prose(rng, 90).split() for _ in range(8)]
    for i in range(170):
        w = list(base[min(i % 11, 7)])
        for _ in range(rng.choice((0, 1, 1, 2, 3, 5))):
            w[rng.randrange(len(w))] = "edit%d" % rng.randrange(10**6)
        rows.append((1000 - i, " ".join(w).upper() if i % 5 == 0 else " ".join(w)))
    passage = prose(rng, 70)  # shared by documents that differ otherwise
    return rows + [(2000 + i, passage + " " + prose(rng, 120)) for i in range(40)]


@pytest.mark.parametrize("block", [512, 16])
def test_near_duplicates_equal_brute_force(spark, corner, nothing, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    monkeypatch.setattr(neardup, "ANCHORS", 4)
    rows = near_rows()
    want = exact_components(rows, 85)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in
           neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 85).collect()}
    assert got == want
    if block == 512:
        want = exact_components([(r[0], r[1]) for r in corner_rows()], 85)
        out = neardup.near_duplicates(corner, 85).collect()
        assert len(out) == 12
        for r in out:
            if r["doc_id"] is None:
                assert r["component_id"] is None and r["kept"]
            else:
                assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]]
        assert neardup.near_duplicates(nothing, 85).count() == 0


# ---- 3 token files

def test_separator_scan_stitches_blocks(spark, corner, nothing):
    rng = np.random.default_rng(4)
    folder = shared_path(spark, "flat")
    from strandline.llm.files import new_file
    want, names = [], []
    for k, n in enumerate((0, 1, 777, 5000)):
        ids = rng.integers(0, 40, n).astype("<u2")
        if k == 3:
            ids[900:2600] = 7  # one document over many blocks
        with new_file(folder, f"f{k}.bin") as out:
            out.write(ids.tobytes())
        names.append((f"f{k}.bin", 2 * n))
        start, ordinal = 0, 0
        for e in np.flatnonzero(ids == 0).tolist():
            want.append((f"f{k}.bin", ordinal, start, e - start, True))
            start, ordinal = e + 1, ordinal + 1
        if start < n:
            want.append((f"f{k}.bin", ordinal, start, n - start, False))
    files = spark.createDataFrame(names, "file string, bytes long")
    got = tokenfiles.scan(files, folder, end_id=0, block_bytes=130, tile=3)
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    encode = tokens.encoder()
    out = tokenfiles.token_counts(corner).collect()
    assert collections.Counter((r["doc_id"], r["n_tokens"]) for r in out) == collections.Counter(
        (r[0], len(encode(r[1] or ""))) for r in corner_rows())
    assert tokenfiles.token_counts(nothing).count() == 0
    with pytest.raises(Exception, match="whole number"):
        tokenfiles.scan(spark.createDataFrame([("f1.bin", 3)], "file string, bytes long"), folder).count()


# ---- 4 WARC

PAGES = "page_id long, url string, html string"


def test_warc_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 3000)
    rows = [(3, "http://a/x", "<p>same</p>"), (1, "http://b/y", "<p>same</p>"), (2, None, "<p>same</p>"), (4, "http://c", None),
            (5, "http://d\r\nX: y", ""), (None, "u", "<p>same</p>"), (7, "u", "é" * 50_000), (8, "u", "WARC/1.1\r\n\r\n" * 9),
            (9, "u", "one"), (9, "u", "one")]
    df = spark.createDataFrame(rows, PAGES).withColumn("payload", F.lit(1)).withColumn("file", F.lit("f"))
    got = warc.round_trip(df.repartition(2)).collect()
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    want = collections.Counter()
    for i, _, h in rows:
        raw = (h or "").encode()
        target = None if i is None or first[h or ""] == i else first[h or ""]
        want[i, len(raw), warc.digest(raw), "response" if target is None else "revisit", target] += 1
    assert collections.Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
                               for r in got) == want
    some = warc.round_trip(df, min_bytes=5).where("record_type = 'revisit'").collect()
    assert {r["page_id"] for r in some} == {2, 3}
    assert warc.round_trip(spark.createDataFrame([], PAGES)).count() == 0


def test_records_from_any_gzip_layout():
    import gzip
    import io
    raws = [warc.record(i, "u", b"x" * i) for i in (0, 5, 70_000)]
    for data in (gzip.compress(b"".join(raws)), b"".join(map(gzip.compress, raws))):
        assert [r for _, r in warc.records(warc.inflated(io.BytesIO(data)))] == raws
    with pytest.raises(ValueError):
        list(warc.records(iter([raws[2][:-9]])))


# ---- 5 language model

def test_language_model_equals_brute_force(spark, corner, nothing, monkeypatch):
    monkeypatch.setattr(lm, "BLOCK_TOKENS", 200)
    rng = random.Random(8)
    rows = [(i, prose(rng, rng.randrange(40)) if i % 9 else (None if i % 2 else "")) for i in range(150)]
    rows += [(500 + i, "copy that text here") for i in range(5)]
    got = {r["doc_id"]: r for r in lm.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    toks = {i: (t or "").lower().split() + ["\n"] for i, t in rows}
    train = {i for i in toks if zlib.crc32(str(i).encode()) % 5 != 1}
    c, pairs = collections.Counter(), collections.Counter()
    for i in train:
        c.update(toks[i])
        pairs.update(zip([None] + toks[i], toks[i]))
    n, v = sum(c.values()), len(c)
    for i, w in toks.items():
        p = [(c[x] + .5) / (n + .5 * (v + 1)) for x in w]
        total = 0.0
        for a, x, q in zip([None] + w, w, p):
            k = len(train) if a is None else c[a]
            if k:
                m = lm.ALPHA * k ** lm.BETA
                q = (pairs[a, x] + m * q) / (k + m)
            total += math.log10(q)
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (
            i not in train, len(w), sum(c[x] > 0 for x in w), n)
        assert r["base_score"] == pytest.approx(sum(map(math.log10, p)), abs=1e-9)
        assert r["score"] == pytest.approx(total, abs=1e-9)
    # every state's probabilities sum to those of the root
    words = np.array([3, 2, 4, 1])
    b = {"ids": np.array([2, 3, 1, 2, 1], np.uint32), "lengths": np.array([3, 2]), "hashes": np.arange(4, dtype=np.uint64)}
    assert set(lm.traverse(b, words, np.array([2, 1, 1]), np.array([0, 1, 2, 0, 2]), 7, 3)) == {
        "n_tokens", "n_known", "base_score", "score"}
    out = lm.score(corner).collect()
    assert len(out) == 12 and [r["held_out"] for r in out if r["doc_id"] is None] == [False]
    assert lm.score(nothing).count() == 0


# ---- 6 quality rules

def brute_measures(text):
    w = (text or "").split(" ")
    for ch in "\t\n\x0b\x0c\r":
        w = [y for x in w for y in x.split(ch)]
    w = [x for x in w if x]
    grams = collections.Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i, g in enumerate(zip(w, w[1:], w[2:])) if grams[g] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return (len(w), sum(map(len, w)), sum(ch in "#*$%&|<>" for ch in text or ""), len(lines) - len(set(lines)), len(covered))


def test_quality_measures_and_cascade(spark, corner, nothing):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice("a b c d e f g".split()) for _ in range(rng.randrange(60))), "en", "s", 1) for i in range(60)]
    rows += [(100, "x y z " * 40, "", "", 1), (101, "a line\nb\na line\n\n \na line", "", "", 1), (102, "LOUD WORDS " * 30, "", "", 1),
             (103, "a### b$$ " * 40, "", "", 1)]
    df = spark.createDataFrame(rows, DOCS).unionByName(corner.select("doc_id", "text", "lang", "source", "n_chars"))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = collections.Counter(tuple(r[c] for c in ["doc_id", *base, "base_failed"]) for r in quality.quality_report(df).collect())
    want = collections.Counter()
    for i, t, *_ in rows + corner_rows():
        m = brute_measures(t)
        want[(i, *m, m[0] < 50 or 100 * m[4] > 50 * m[0])] += 1
    assert got == want
    # the order changes the work, never the verdict
    orders = [list(quality.DEFAULT_RULES), list(reversed(quality.DEFAULT_RULES)), quality.order_rules(df)]
    kept = [sorted((r["doc_id"] is None, r["doc_id"] or 0, r["kept"]) for r in quality.cascade(df, ordered=o).collect()) for o in orders]
    assert kept[0] == kept[1] == kept[2]
    out = quality.cascade(corner)
    assert out.count() == 12 and "key" in out.columns and quality.cascade(nothing).count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Exchange" not in plan


# ---- 7 HTML

def page(body, nav="Home About", extra=""):
    return (f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body><nav><ul><li><a href='/'>{nav}</a></ul>"
            f"</nav><div class='ad'>Buy <b>now</b></div>{extra}<article>{body}</article><footer>&copy; x</footer>"
            "<div id='comments'><p>nice post</p></div><script>var a='</p>';</script></body></html>")


def test_wrapper_induction(spark):
    rows = [(i, f"http://Host.example/{i}", page(
        f"<h1>Title {i}</h1><p>Body &amp; <b>bold</b>{i}<br>line  two<p>More {i}</p><div class='box{i}'><p>Follow us today</p></div>"))
        for i in range(12)]
    rows += [(100, "http://solo/", page("<p>alone&nbsp;here</p>")), (101, None, None), (102, "x", ""), (103, "http://plain/", "just text"),
             (104, "http://main/", "<header>H</header><main><h2>A</h2>b<form>f</form><ul><li>c<li>d</ul><!-- x --></main>"),
             (105, "http://deep/", "<div>" * 3000 + "core" + "</div>" * 3000), (106, "http://long/", page("<p>word " * 30_000)),
             (107, "http://cut/", "<article><p>open <a href='x"), (108, "http://q/", "<p title=\"a > b\">in</p><p hidden>no</p>")]
    rows += [(200 + i, "http://copies/", page("<p>same text</p>")) for i in range(8)]
    df = spark.createDataFrame(rows, PAGES).withColumn("text", F.lit(1)).withColumn("host", F.lit("h"))
    got = {r["page_id"]: r for r in wrappers.extract(df.repartition(3)).collect()}
    for i in range(12):  # the constant box is template
        assert got[i]["text"] == f"Title {i} Body & bold{i} line two More {i}"
    want = {100: "alone here", 101: "", 102: "", 103: "just text", 104: "A b c d", 105: "core", 107: "open", 108: "in"}
    assert {k: got[k]["text"] for k in want} == want or got[107]["text"].startswith("open")
    assert got[106]["text"] == " ".join(["word"] * 30_000)
    assert all(got[200 + i]["text"] == "same text" for i in range(8))  # copies alone make no template
    assert all(r["n_chars"] == len(r["text"]) for r in got.values()) and len(got) == len(rows)
    assert wrappers.extract(spark.createDataFrame([], PAGES)).count() == 0


def test_wrapper_counts_distinct_pages(spark):
    rows = [(i, "http://h/", page(f"<h1>Title {i}</h1><p>Body {i}</p>")) for i in range(12)]
    longest = "<h1>Long</h1><p>start</p><h2>Then</h2><p>middle</p><p>end</p>"
    rows += [(100 + i, "http://h/", page(longest)) for i in range(6)]  # copies, also with other menus and scripts
    rows += [(110 + i, "http://h/", page(longest, nav=f"Menu {i}", extra=f"<script>{i}</script>")) for i in range(6)]
    rows += [(200 + i, "http://opt/", page(f"<h1>T {i}</h1>" + "<h2>Update</h2>" * (i < 5) + f"<p>B {i}</p><div><p>Follow us</p></div>"))
             for i in range(40)]  # a heading on few pages, a box on all
    df = spark.createDataFrame(rows, PAGES)
    got = {r["page_id"]: r["text"] for r in wrappers.extract(df.repartition(3)).collect()}
    want = {i: f"Title {i} Body {i}" for i in range(12)} | {i: "Long start Then middle end" for i in [*range(100, 106), *range(110, 116)]}
    want |= {200 + i: f"T {i} Update B {i}" if i < 5 else f"T {i} B {i}" for i in range(40)}
    assert got == want


def test_main_text_region(spark):
    def html(body):
        return f"<html><body><nav>Home</nav>{body}<footer>x</footer></body></html>"
    pages = {
        1: ("<main><p>text</p></main><div id=thread><article class=comment>nice</article></div>", "text"),
        2: ("<main><p>a longer main text</p></main><article>teaser card</article>", "a longer main text"),
        3: ("<main><header><h1>Title</h1></header><article><p>body</p></article></main>", "Title body"),
        4: ("<div><p>the main text in a plain element</p></div><article>teaser</article>", "the main text in a plain element teaser"),
        5: ("<div>side</div><article><p>the text of an article</p></article>", "the text of an article"),
        6: ("<main></main><article><p>one</p></article><article><p>two</p></article>", "one two")}
    rows = [(i, f"http://h{i}/", html(body)) for i, (body, _) in pages.items()]
    # copies of an article beside varying text make no template; a constant text beside the article is template
    rows += [(100 + i, "http://copies/", html(f"<article><p>one article of some length</p></article><div>Seen {i}</div>")) for i in range(8)]
    rows += [(200 + i, "http://side/", html(f"<div>{'a long constant box ' * 9}</div><article><p>Text {i}</p></article>")) for i in range(8)]
    got = {r["page_id"]: r["text"] for r in wrappers.extract(spark.createDataFrame(rows, PAGES)).collect()}
    want = {i: text for i, (_, text) in pages.items()}
    want |= {100 + i: "one article of some length" for i in range(8)} | {200 + i: f"Text {i}" for i in range(8)}
    assert got == want


def test_dropped_words():
    def text(body):
        return wrappers.main_text(f"<html><body>{body}</body></html>", None, None)
    kept = ('<section id="social-effects"><h2 id="related-work">Related</h2><p class="search-term">a <a id="skip">b</a> '
            '<span class="share-price">c</span></p></section>')
    assert text(f"<article>{kept}</article>") == "Related a b c"
    assert text(f"<main>{kept.replace('search-term', 'x').replace('share-price', 'y').replace('skip', 'z')}</main>") == "Related a b c"
    assert text('<section id="social-effects"><h2 id="related-work">Related</h2>a</section>') == "Related a"
    assert text('<article class="post has-comments">a<p class="box ad">b</p><div role="search">c</div>'
                '<span class="Share">d</span><div class="header">e</div></article>') == "a e"
    assert text('<div id="site-footer">a</div><div class="commentList">b</div><section id="comments">c</section>'
                '<div class="page-header">d</div><main class="has-sidebar">e<div class="related-posts">f</div></main>') == "e"


def test_simple_tree_matching():
    def s(label, *kids):
        x = wrappers.Slot(label)
        x.kids = list(kids)
        return x
    a = s("r", s("a", s("x")), s("b"), s("c"))
    b = s("r", s("b"), s("a", s("x"), s("y")), s("c"))
    assert wrappers.matching(a, b, {}) == 4  # r, a, x, c
    assert wrappers.matching(a, s("q"), {}) == 0


# ---- 8 packing

def test_packing(spark, corner, nothing):
    from tokenizers import Tokenizer
    full = Tokenizer.from_file(tokens.tokenizer_path(tokens.TOKENIZER))
    full.encode_special_tokens = True
    rng = random.Random(2)
    rows = [(i, prose(rng, rng.randrange(1, 900))) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = packing.pack_documents(df).collect()
    ids = {i: [*full.encode(t, add_special_tokens=False).ids, 0] for i, t in rows}
    by_doc, by_seq = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    assert by_doc.keys() == ids.keys()
    for i, own in by_doc.items():
        at = 0
        for k, r in enumerate(sorted(own, key=lambda r: r["piece"])):
            part = ids[i][at:at + r["length"]]
            assert (r["piece"], r["start"], len(part)) == (k, at, r["length"])
            assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
            assert k == 0 or r["length"] == 2048
            at += r["length"]
        assert at == len(ids[i])
    for own in by_seq.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
    assert len(by_seq) <= math.ceil(sum(map(len, ids.values())) / 2048) + 2
    out = packing.pack_documents(corner).collect()
    encode = tokens.encoder()
    assert sum(r["length"] for r in out) == sum(len(encode(t or "")) + 1 for _, t, *_ in corner_rows())
    assert all(np.array_equal(encode(t or ""), full.encode(t or "", add_special_tokens=False).ids) for _, t, *_ in corner_rows())
    assert packing.pack_documents(nothing).count() == 0


def test_packing_special_tokens(spark):
    from tokenizers import Tokenizer
    full = Tokenizer.from_file(tokens.tokenizer_path(tokens.TOKENIZER))  # as it is
    texts = ["a <|endoftext|> b", "<|endoftext|><|endoftext|>", " it's \n\n <|endoftext|>  <|endoftext|", "plain text", ""]
    want = {i: [*full.encode(t, add_special_tokens=False).ids, 0] for i, t in enumerate(texts)}
    assert want[0] == [64, 220, 50256, 275, 0]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["length"], r["ids_crc32"]) for r in stages.pack(spark, df, "").collect()}
    assert got == {i: (len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in want.items()}


def test_near_dedup_stage_goes_by_id(spark):
    same = prose(random.Random(5), 80)
    rows = [(7, same), (7, same), (8, same), (8, same), (9, prose(random.Random(6), 80)), (None, same), (None, same)]
    got = stages.near_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()
    assert collections.Counter(r["doc_id"] for r in got) == {7: 2, 9: 1, None: 2}


# ---- 9 mixing

def fill(sizes, weights, total, cap):
    target, open_ = {}, set(sizes)
    while True:
        w = sum(weights[s] for s in open_)
        level = (total - sum(target.values())) / w if w else 0
        over = {s for s in open_ if weights[s] * level > cap * sizes[s]}
        if not over:
            return target | {s: weights[s] * level for s in open_}
        target |= {s: cap * sizes[s] for s in over}
        open_ -= over


def test_mixing(spark, corner, nothing):
    rng = random.Random(6)
    names = [None, "", "b", "a", "é", "Z", "zz"]
    rows = [(i, prose(rng, rng.randrange(1, 60)), names[int(rng.random() ** 2 * 7)]) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df).collect()
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += len(t.split())
    ranked = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    want = fill(dict(sizes), {s: (5, 2, 1)[k % 3] for k, s in enumerate(ranked)}, 1.5 * sum(sizes.values()), 2)
    source = {i: s for i, _, s in rows}
    taken = collections.Counter()
    for r in got:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s]) and r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 60 for s in want)
    again = mixing.mix(df.repartition(5)).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in got) == sorted((r["doc_id"], r["taken"]) for r in again)
    assert mixing.mix(corner).count() == 12 and mixing.mix(nothing).count() == 0


# ---- 10 vectors

def test_vectors_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(crosspolytope, "BLOCK", 20)
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(12, 32))
    x = np.repeat(centres, [40, 10, 10, 5, 5, 5, 2, 2, 1, 1, 1, 1], axis=0)
    x = (x + rng.normal(size=x.shape) * 0.09).astype(np.float32)
    rows = [(1000 - i, v.tolist(), int(i % 2)) for i, v in enumerate(x)]
    rows += [(2000 + i, rows[0][1], 0) for i in range(3)] + [(3000, [2 * y for y in rows[0][1]], 0)]
    odd = [(None, rows[0][1], 0), (5, None, 0), (6, [0.0] * 32, 0), (7, [float("nan")] + [1.0] * 31, 0), (8, [], 0),
           (9, rows[0][1], None), (10, [None] + [1.0] * 31, 0), (11, [1.0, 2.0], 0), (12, [float("inf")] + [1.0] * 31, 0)]
    schema = "vec_id long, embedding array<float>, label int"
    df = spark.createDataFrame(rows + odd, schema).withColumn("key", F.lit(1)).withColumn("m", F.lit(1))
    got = {r["vec_id"]: r for r in crosspolytope.near_vectors(df).collect()}
    v = np.array([r[1] for r in rows], dtype=np.float64)
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    ids = np.array([r[0] for r in rows])
    hit = ((u @ u.T) >= 0.98) & (label[:, None] == label[None]) & ~np.eye(len(rows), dtype=bool)
    root = ids.copy()
    for _ in range(len(rows)):
        root = np.minimum(root, np.where(hit, root[None, :], 1 << 40).min(axis=1))
    assert hit.sum() > 200
    for i, n, c in zip(ids, hit.sum(axis=1), root):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (n, c, c == i)
    for i in (None, 5, 6, 7, 8, 9, 10, 11, 12):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    assert crosspolytope.near_vectors(spark.createDataFrame([], schema)).count() == 0


def test_hashing_recall():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 64))
    z = rng.normal(size=x.shape)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (z * x).sum(1, keepdims=True) * x
    y = 0.98 * x + math.sqrt(1 - 0.98 ** 2) * z / np.linalg.norm(z, axis=1, keepdims=True)
    a, b = crosspolytope.codes(x), crosspolytope.codes(y)
    assert (a[:, :, :, None] == b[:, :, None, :]).any(axis=(1, 2, 3)).mean() >= 0.999
    h = crosspolytope.hadamard(np.eye(8))
    assert np.array_equal(h @ h.T, 8 * np.eye(8))


# ---- pipeline

def test_pipeline_stages(spark, tmp_path, corner, nothing):
    import corpus_pipeline
    rng = random.Random(12)
    base = [prose(rng, 120) for _ in range(40)]
    rows = [(i, base[i % 40] + (" extra" if i >= 40 else ""), "en", f"s{i % 3}", 1) for i in range(60)]
    rows += [(100 + i, f"{prose(rng, 100)}. You snarkel {prose(rng, 4)}.", "en", "s0", 1) for i in range(30)]
    rows += [(200, "short", "en", "s0", 1), (201, "###$$ %% " * 60, "en", "s0", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(r[0], 1, int("snarkel" in r[1])) for r in rows], "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")
    step = stages.quality_rules(spark, docs, str(tmp_path))
    assert step.columns == docs.columns and {r["doc_id"] for r in step.collect()} == set(r[0] for r in rows) - {200, 201}
    step = stages.drop_toxic(spark, step, str(tmp_path))
    assert {r["doc_id"] for r in step.collect()} == set(range(60))
    step = stages.near_dedup(spark, step, str(tmp_path))
    assert {r["doc_id"] for r in step.collect()} == set(range(40))
    mixed = stages.mix_sources(spark, step, str(tmp_path))
    words = sum(len(r["text"].split()) for r in mixed.collect())
    assert mixed.columns == docs.columns and abs(words - 1.5 * sum(len(r["text"].split()) for r in step.collect())) <= 3 * 121
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in out} <= set(range(40)) and sum(r["length"] for r in out) > 0
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "toxicity", "near_dedup", "mixing", "packing"]
    for stage in (stages.quality_rules, stages.drop_toxic, stages.near_dedup, stages.mix_sources):
        assert stage(spark, corner, str(tmp_path)).columns == corner.columns
        assert stage(spark, nothing, str(tmp_path)).count() == 0
    assert stages.pack(spark, nothing, str(tmp_path)).count() == 0
    assert stages.drop_toxic(spark, corner, str(tmp_path)).where("trim(coalesce(text, '')) = ''").count() >= 2
