"""A small block tree of a web page: what wrapper induction aligns."""

from __future__ import annotations

import html as _html
import re

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q ruby rt rp s samp "
    "small span strike strong sub sup time tt u var".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split())
# An open element (key) ends when one of these starts beside it, unless a barrier is open in between.
ENDS = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
        "tr": (("tr", "tbody", "tfoot"), ("table",)), "td": (("td", "th", "tr", "tbody", "tfoot"), ("table",)),
        "th": (("td", "th", "tr", "tbody", "tfoot"), ("table",)), "option": (("option", "optgroup"), ("select",))}

# What is never main text, by element and by a word of class, id or role (see ``_said``).
DROPPED = frozenset("head nav footer aside form button select dialog menu script style noscript template iframe "
                    "svg canvas object video audio map textarea title search".split())
DROPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements adsense sponsor sponsored sponsors promo promotion "
    "banner cookie cookies consent gdpr notice notices popup modal menu menus nav navbar navigation breadcrumb "
    "breadcrumbs sidebar sidebars widget widgets footer comment comments respond reply replies disqus share "
    "sharing social related newsletter subscribe subscription login signup search complementary contentinfo "
    "alert pagination pager toolbar skip".split())

# Inside articles a name drops an element only if it is made up of these words and of words for parts of a page.
ASIDES = frozenset("comment comments respond reply replies disqus share sharing social related newsletter subscribe "
                   "subscription sponsor sponsored sponsors promo advert advertisement ads ad".split())
PARTS = frozenset("list area block box section wrapper container content thread form buttons button links link icons bar items "
                  "post posts entry article widget media group row inner outer title heading body count main wrap".split())
# A word behind one of these says what an element has beside it, not what it is.
MODIFIERS = frozenset("has with without no not is show hide include includes js supports".split())

SLUGGED = INLINE | frozenset("h1 h2 h3 h4 h5 h6 section article".split())  # their ids name what the text is about

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)>", re.S)
_ATTR = re.compile(r"(class|id|role|style|aria-hidden|hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)|(?=[\s/]|$))", re.I)
_SPLIT = re.compile(r"[^A-Za-z]+|(?<=[a-z])(?=[A-Z])")


class Node:
    """``label`` is the element with its first class or id; ``parts`` are child nodes and texts in order."""

    __slots__ = ("tag", "label", "dropped", "hidden", "parts")

    def __init__(self, tag: str, label: str, dropped: bool, hidden: bool = False):
        self.tag, self.label, self.dropped, self.hidden, self.parts = tag, label, dropped, hidden, []


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): (m[2] or "").strip("\"'") for m in _ATTR.finditer(raw)} if raw.strip(" /") else {}


def _words(name: str) -> list[str]:
    return [w.lower() for w in _SPLIT.split(name) if w]


def _said(tag: str, attrs: dict[str, str], around: str) -> set[str]:
    """The words that may drop an element: whole names of class and role; outside articles also the id (whole in main and
    where it is a slug) and the parts of these names unless a modifier is among them; in articles, of
    blocks that are no headings or paragraphs, the parts of names and ids that are made up of ``ASIDES`` and ``PARTS``."""
    names = f"{attrs.get('class', '')} {attrs.get('role', '')}".split()
    said, own = {n.lower() for n in names}, attrs.get("id", "")
    if around == "article" or tag == "article":
        if tag not in INLINE and tag not in ("h1", "h2", "h3", "h4", "h5", "h6", "p", "article"):
            for n in (*names, own):
                parts = set(_words(n))
                if parts & ASIDES and parts <= ASIDES | PARTS:
                    said |= parts & DROPPED_WORDS
        return said
    if around == "main" or tag in SLUGGED:
        said.add(own.lower())
    else:
        names.append(own)
    for n in names:
        parts = _words(n)
        if not MODIFIERS.intersection(parts):
            said.update(parts)
    return said


def _new(tag: str, raw: str, around: str) -> Node:
    """``around``: article, else main, if the element is in one, else ""."""
    attrs = _attributes(raw)
    said = _said(tag, attrs, around) if attrs else set()
    hidden = ("hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true"
              or "display:none" in attrs.get("style", "").replace(" ", "").lower())
    dropped = (tag in DROPPED or hidden or bool(said & DROPPED_WORDS)
               or (not around and tag not in INLINE and (tag == "header" or "header" in said)))
    if tag in ("body", "html", "main"):
        dropped = hidden
    label = re.sub(r"\d+", "", (attrs.get("class") or attrs.get("id") or "").split(" ")[0])
    return Node(tag, f"{tag}.{label}" if label else tag, dropped, hidden)


def _keep_main(root: Node) -> None:
    """No element is dropped for what it is called if it holds main, or the article with the most text; and
    where nothing would be left of a page, the outermost dropped elements that are no menus or the like stay."""
    size: dict[int, int] = {}
    parent: dict[int, Node] = {}
    found: list[Node] = []
    stack, order = [(root, False)], []
    while stack:
        node, hidden = stack.pop()
        order.append(node)
        if node.tag in ("main", "article") and not hidden:
            found.append(node)
        for x in node.parts:
            if not isinstance(x, str):
                parent[id(x)] = node
                stack.append((x, hidden or x.hidden))
    for node in reversed(order):
        size[id(node)] = sum(len(x.strip()) if isinstance(x, str) else size[id(x)] for x in node.parts)
    articles = [n for n in found if n.tag == "article"]
    chosen = [n for n in found if n.tag == "main" and size[id(n)]] or (
        [max(articles, key=lambda n: size[id(n)])] if articles else [])
    for n in chosen:
        while (n := parent.get(id(n))) is not None:
            n.dropped = n.hidden

    def left(node: Node) -> bool:
        todo = [node]
        while todo:
            x = todo.pop()
            if x.dropped:
                continue
            for y in x.parts:
                if not isinstance(y, str):
                    todo.append(y)
                elif y.strip():
                    return True
        return False

    while not left(root):
        todo, named = [root], []
        while todo:
            x = todo.pop()
            for y in x.parts:
                if not isinstance(y, str):
                    if not y.dropped:
                        todo.append(y)
                    elif not y.hidden and y.tag not in DROPPED and size[id(y)]:
                        named.append(y)
        if not named:
            return
        for x in named:
            x.dropped = False


def parse(page: str | None) -> Node:
    """The block tree of a page; inline elements only pass their text on, ``br`` is white space."""
    text = page or ""
    root = Node("#root", "#root", False)
    stack, articles, mains, at = [root], 0, 0, 0
    while True:
        around = "article" if articles else "main" if mains else ""
        m = _TOKEN.search(text, at)
        if m is None:
            if at < len(text):
                stack[-1].parts.append(text[at:])
            _keep_main(root)
            return root
        if m.start() > at:
            stack[-1].parts.append(text[at:m.start()])
        at = m.end()
        tag = m["tag"] or m["tag2"]
        if tag is None:
            if m[0].startswith("<![CDATA["):
                stack[-1].parts.append(_html.escape(m[0][9:].removesuffix("]]>"), quote=False))
            continue
        tag = tag.lower()
        if m["end"] or m["end2"]:
            if tag in INLINE:
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    articles -= sum(n.tag == "article" for n in stack[i:])
                    mains -= sum(n.tag == "main" for n in stack[i:])
                    del stack[i:]
                    break
            continue
        raw = m["attrs"] if m["attrs"] is not None else m["attrs2"] or ""
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(text, at)
            at = len(text) if end is None else text.find(">", end.start()) + 1 or len(text)
            continue
        if tag in VOID:
            stack[-1].parts.append(" ")
            continue
        if tag in INLINE:
            node = _new(tag, raw, around) if raw.strip(" /") else None
            if node is None or not node.dropped or raw.rstrip().endswith("/"):
                continue
            depth, to = 1, at  # a hidden or advertising inline element, up to its own end
            for x in re.compile(rf"<(/?){re.escape(tag)}(?=[\s/>])[^>]*>", re.I).finditer(text, at):
                depth += -1 if x[1] else 0 if x[0].endswith("/>") else 1
                if not depth:
                    to = x.end()
                    break
            at = to
            continue
        if tag in CLOSES_P:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    del stack[i:]
                    break
                if stack[i].tag in CLOSES_P or stack[i].tag in ("td", "th", "li", "dd"):
                    break
        for i in range(len(stack) - 1, 0, -1):
            starts, barriers = ENDS.get(stack[i].tag, ((), ()))
            if tag in starts:
                del stack[i:]
                break
            if stack[i].tag in ("ul", "ol", "dl", "table", "select", "menu"):
                break
        node = _new(tag, raw, around)
        stack[-1].parts.append(node)
        if not raw.rstrip().endswith("/"):
            stack.append(node)
            articles += tag == "article"
            mains += tag == "main"


def clean(raw: str) -> str:
    """Character references decoded, white space runs to one space, trimmed."""
    return " ".join(_html.unescape(raw).split())
