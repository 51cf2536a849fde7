"""Main text of web pages by wrapper induction.

Pages of a host are aligned as block trees by simple tree matching: two nodes with the same label
match, children are matched in order so that most nodes are matched in all, and runs of equal siblings
(paragraphs, list items) count as one repeated node.  A host's wrapper is the merge of its
pages' trees; each slot keeps the texts that every page has had there.  A page counts once, however many
copies of it (pages with the same candidate text) a host has.  Texts that stay constant over ``MIN_PAGES``
pages and ``MIN_SHARE`` of the host's pages or more are template; as no two of these pages are the same,
something else varies there; what varies is content.  Slots below elements that never hold main text (menus,
footers, adverts, comments ...) are no content either.

What a page has in main and article elements is aligned apart from what it has beside them: copies of an article
beside varying text are copies.  Of the text that is left the larger part is returned: main without the articles beside it if it holds
at least as much as they do, main and articles if they hold at least as much as the rest, else all.

Wrappers merge associatively: copies are found by hash among the pages' trees, which hold ids for texts; then
each task folds its pages into one wrapper per host, and hosts' wrappers are merged in two steps, so a host
with a third of all pages is spread like the others.
Templates are joined back to the pages by broadcast after a check of their size, else by host.

Defined cases: a null or empty html has an empty text; a null url counts as a host of its own
("") ; repeated pages are all returned; pages of any length and nesting are parsed whole; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import saved
from strandline.llm.dom import Node, clean, parse

MIN_PAGES = 5
MIN_SHARE = 0.5
SALTS = 16
TEMPLATE_BYTES = 64 << 20  # templates of all hosts that may be broadcast, after measuring them
FLUSH_HOSTS = 2000
DEPTH = 100  # levels of nesting that are aligned; deeper text counts at that level


def _text_id(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))


class Slot:
    """A place in a wrapper.  ``common``: ids of the texts, of those that may be main text, that all pages
    so far have had here; ``n``: the pages that have the place, at the root all pages."""

    __slots__ = ("label", "n", "common", "kids")

    def __init__(self, label: str):
        self.label, self.n, self.common, self.kids = label, 1, set(), []

    def dump(self) -> list:
        return [self.label, self.n, sorted(self.common), [k.dump() for k in self.kids]]

    @staticmethod
    def load(x: list) -> "Slot":
        s = Slot(x[0])
        s.n, s.common = x[1], set(x[2])
        s.kids = [Slot.load(k) for k in x[3]]
        return s

    def all(self) -> list["Slot"]:
        out, left = [], [self]
        while left:
            x = left.pop()
            out.append(x)
            left.extend(reversed(x.kids))
        return out


def _json(top: Slot) -> str:
    return json.dumps(top.dump(), separators=(",", ":"))


def slots_of(root: Node) -> tuple[Slot, list[tuple[Slot, str, str]]]:
    """The page as a tree of slots (neighbours with one label share a slot) and those of its texts that may be main
    text in page order, each with its slot and the element that it is in: main, article outside main, or neither ("").
    Below ``DEPTH`` levels no new slots are made."""
    top = Slot(root.label)
    entries: list[tuple[Slot, str, str]] = []
    stack = [[root, top, False, "", 0, -1]]
    while stack:
        frame = stack[-1]
        node, slot, dropped, where, i, pos = frame
        start = i
        while i < len(node.parts) and isinstance(node.parts[i], str):
            i += 1
        if i > start and not dropped:
            text = clean("".join(node.parts[start:i]))
            if text:
                entries.append((slot, text, where))
        if i == len(node.parts):
            stack.pop()
            continue
        child = node.parts[i]
        frame[4] = i + 1
        under = slot
        if len(stack) < DEPTH:
            kids = slot.kids
            if pos < 0 or kids[pos].label != child.label:
                pos = next((j for j in range(pos + 1, len(kids)) if kids[j].label == child.label), pos + 1)
                if pos == len(kids) or kids[pos].label != child.label:
                    kids.insert(pos, Slot(child.label))
                frame[5] = pos
            under = kids[pos]
        if child.tag == "main" or (child.tag == "article" and not where):
            where = child.tag
        stack.append([child, under, dropped or child.dropped, where, 0, -1])
    return top, entries


def shape(s: Slot) -> str:
    return f"{s.label}({','.join(map(shape, s.kids))})"


def matching(a: Slot, b: Slot, memo: dict) -> int:
    """Simple tree matching: the most nodes that an order-keeping, top-down match pairs."""
    if a.label != b.label:
        return 0
    got = memo.get((id(a), id(b)))
    if got is None:
        row = [0] * (len(b.kids) + 1)
        for x in a.kids:
            new = [0]
            for j, y in enumerate(b.kids):
                new.append(max(new[j], row[j + 1], row[j] + matching(x, y, memo)))
            row = new
        got = memo[id(a), id(b)] = 1 + row[-1]
    return got


def matched_kids(a: Slot, b: Slot, memo: dict) -> list[tuple[int, int]]:
    """The pairs of children in a largest match."""
    m = [[0] * (len(b.kids) + 1)]
    for x in a.kids:
        row = [0]
        for j, y in enumerate(b.kids):
            row.append(max(row[j], m[-1][j + 1], m[-1][j] + matching(x, y, memo)))
        m.append(row)
    out, i, j = [], len(a.kids), len(b.kids)
    while i and j:
        if m[i][j] == m[i - 1][j]:
            i -= 1
        elif m[i][j] == m[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            out.append((i, j))
    return out[::-1]


def merge(w: Slot, page: Slot, memo: dict, pairs: dict) -> None:
    """Merge the tree ``page`` into the wrapper ``w``; ``pairs`` maps each slot of ``page`` to its slot in ``w``."""
    pairs[id(page)] = w
    _meet(w, page)
    both = matched_kids(w, page, memo)
    kids, i = [], 0
    ends = [*both, (len(w.kids), len(page.kids))]
    j = 0
    for a, b in ends:
        kids.extend(w.kids[i:a])
        for new in page.kids[j:b]:
            kids.append(new)
            for s in new.all():
                pairs[id(s)] = s
        if a < len(w.kids):
            merge(w.kids[a], page.kids[b], memo, pairs)
            kids.append(w.kids[a])
        i, j = a + 1, b + 1
    w.kids = kids


def _meet(w: Slot, page: Slot) -> None:
    w.common &= page.common
    w.n += page.n


class Wrapper:
    """The merged tree of a host's pages; pages of a shape seen before are met slot by slot."""

    def __init__(self, top: Slot):
        self.top = top
        self.known: dict[str, list[Slot]] = {shape(top): top.all()}

    def add(self, page: Slot) -> None:
        key = shape(page)
        at = self.known.get(key)
        if at is not None:
            for w, s in zip(at, page.all()):
                _meet(w, s)
            return
        own, pairs = page.all(), {}
        merge(self.top, page, {}, pairs)
        if len(self.known) < 1000:  # a memo of alignments only
            self.known[key] = [pairs[id(s)] for s in own]

    def dump(self) -> str:
        return _json(self.top)


def _host() -> Column:
    return F.lower(F.regexp_extract(F.coalesce(F.col("url").cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1))


def trees(pages: DataFrame) -> DataFrame:
    """(host, inside, key, tree): each distinct page of each host once, as JSON, with its texts ``inside`` main and
    article elements or with those beside them.  ``key`` is a hash of the texts inside, or else of all."""
    def read(batches):
        for pdf in batches:
            found: dict[tuple[str, bool, str], str] = {}
            for host, page in zip(pdf["host"], pdf["html"]):
                top, entries = slots_of(parse(page))
                for inside in (True, False):
                    texts = [(slot, text) for slot, text, where in entries if bool(where) == inside]
                    if texts:
                        for slot in top.all():
                            slot.common = set()
                        for slot, text in texts:
                            slot.common.add(_text_id(text))
                        whole = "\0".join(x[1] for x in (texts if inside else entries)).encode("utf-8", "surrogatepass")
                        at, tree = (host, inside, xxhash.xxh3_128_hexdigest(whole)), _json(top)
                        found[at] = min(tree, found.get(at, tree))
            yield pd.DataFrame([(*at, tree) for at, tree in found.items()], columns=["host", "inside", "key", "tree"])

    rows = pages.select(_host().alias("host"), F.col("html").cast("string").alias("html"))
    return rows.mapInPandas(read, "host string, inside boolean, key string, tree string").groupBy("host", "inside", "key").agg(
        F.min("tree").alias("tree"))


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, inside, wrapper): the merged trees of all distinct pages of each host, as JSON."""
    def frame(held: dict) -> pd.DataFrame:
        return pd.DataFrame([(*at, w.dump()) for at, w in held.items()], columns=["host", "inside", "wrapper"])

    def induce(batches):
        held: dict[tuple[str, bool], Wrapper] = {}
        for pdf in batches:
            for host, inside, tree in zip(pdf["host"], pdf["inside"], pdf["tree"]):
                top = Slot.load(json.loads(tree))
                if (host, inside) in held:
                    held[host, inside].add(top)
                else:
                    held[host, inside] = Wrapper(top)
            if len(held) > FLUSH_HOSTS:
                yield frame(held)
                held.clear()
        yield frame(held)

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = sorted(pdf["wrapper"])
        whole = Wrapper(Slot.load(json.loads(rows[0])))
        for x in rows[1:]:
            whole.add(Slot.load(json.loads(x)))
        return frame({(pdf["host"].iloc[0], pdf["inside"].iloc[0]): whole})

    schema = "host string, inside boolean, wrapper string"
    parts = trees(pages).select("host", "inside", "tree").mapInPandas(induce, schema)
    salt = F.pmod(F.xxhash64("wrapper"), F.lit(SALTS)).alias("salt")
    some = parts.groupBy("host", "inside", salt).applyInPandas(join, schema)
    return some.groupBy("host", "inside").applyInPandas(join, schema)


def _constant(s: Slot, top: Slot, min_pages: int) -> bool:
    """Whether the slot's common texts are template: enough of the host's distinct pages have them."""
    return bool(s.common) and s.n >= max(min_pages, MIN_SHARE * top.n)


def templates(induced: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, inner, outer): the hosts' wrappers with template texts inside main and article elements and beside them."""
    def pick(batches):
        for pdf in batches:
            keep = []
            for x in pdf["wrapper"]:
                s = Slot.load(json.loads(x)).all()
                keep.append(any(_constant(k, s[0], min_pages) for k in s))
            yield pdf[np.asarray(keep, dtype=bool)]

    found = induced.mapInPandas(pick, "host string, inside boolean, wrapper string")
    return found.groupBy("host").agg(F.max(F.when(F.col("inside"), F.col("wrapper"))).alias("inner"),
                                     F.max(F.when(~F.col("inside"), F.col("wrapper"))).alias("outer"))


def _aligned(top: Slot, wrapper: Wrapper) -> dict[int, Slot]:
    """The slots of the wrapper for the page's slots."""
    key = shape(top)
    if key in wrapper.known:
        return {id(s): w for s, w in zip(top.all(), wrapper.known[key])}
    at: dict[int, Slot] = {}
    memo: dict = {}
    todo = [(wrapper.top, top)]
    while todo:
        w, s = todo.pop()
        at[id(s)] = w
        todo.extend((w.kids[i], s.kids[j]) for i, j in matched_kids(w, s, memo))
    return at


def main_text(page: str | None, inner: Wrapper | None, outer: Wrapper | None, min_pages: int = MIN_PAGES) -> str:
    """The page's content: its texts without those that the wrappers hold constant, of the part that holds most."""
    top, entries = slots_of(parse(page))
    at = [{} if w is None else _aligned(top, w) for w in (outer, inner)]
    left, size = [], {"main": 0, "article": 0, "": 0}
    for slot, text, where in entries:
        w, whole = at[where != ""].get(id(slot)), inner if where else outer
        if w is None or not _constant(w, whole.top, min_pages) or _text_id(text) not in w.common:
            left.append((text, where))
            size[where] += len(text)
    region = ("main",) if size["main"] >= max(size["article"], 1) else ("main", "article")
    if sum(size[x] for x in region) < size[""]:
        region = tuple(size)
    return " ".join(text for text, where in left if where in region)


def extract(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """(page_id, url, text, n_chars): the main text of every page."""
    found = saved(templates(wrappers(pages), min_pages), "templates")
    rows = pages.select("page_id", "url", _host().alias("host"), F.col("html").cast("string").alias("html"))
    size = found.agg(F.sum(F.length(F.concat_ws("", "inner", "outer")))).first()[0] or 0
    rows = rows.join(F.broadcast(found) if size <= TEMPLATE_BYTES else found, "host", "left")
    fields = {f.name: f.dataType.simpleString() for f in pages.schema.fields}

    def run(batches):
        held: dict[str, list[Wrapper | None]] = {}
        for pdf in batches:
            texts = []
            for host, page, *both in zip(pdf["host"], pdf["html"], pdf["inner"], pdf["outer"]):
                if host not in held:
                    if len(held) > FLUSH_HOSTS:
                        held.clear()
                    held[host] = [Wrapper(Slot.load(json.loads(x))) if isinstance(x, str) else None for x in both]
                texts.append(main_text(page, *held[host], min_pages))
            yield pd.DataFrame({"page_id": pdf["page_id"], "url": pdf["url"], "text": texts})

    out = rows.mapInPandas(run, f"page_id {fields['page_id']}, url {fields['url']}, text string")
    return out.withColumn("n_chars", F.length("text").cast("long"))
