"""HTML extraction (8): wrapper induction over the pages of a host.

Every page becomes a small tree: siblings with one label (tag and class names)
are folded into one node, script, style and other rejected elements are left
out.  The trees of a host are aligned by simple tree matching into one
template whose nodes count their pages, whether their text is the same on all
of them, and how much text without links they hold.  Nodes with the same text
on at least ``min_pages`` distinct pages of a host are template; the others
are varying slots.  The host's wrapper holds the paths to its outermost article
and main elements or, without any, to the lowest container of all varying text
outside links.  Extraction reads the blocks below these paths, without rejected
elements, template nodes and containers of links alone without a heading (but what an article or
main element holds is content by declaration, even if other pages of the host
have the same); a page on which no path leads anywhere is its own template.

A class, id or role rejects an element if what it names is no article: its last
telling word is one of ``REJECTED_NAMES`` and only layout words follow
(``cookie-bar``, ``post-comments``, not ``search-results`` or ``has-sidebar``).

Copies of a page count once on their host, wherever they lie: each of c copies
weighs 1/c, in whole numbers, so sums do not depend on the partitions.  Ties
between alignments go to the earlier node of the page.

Templates are merged first in the task that parsed the pages, then in salted
groups, then per host, so a host with a third of all pages is never gathered
as pages.  All pages take part.

Null html is an empty page; pages without text give an empty string; null or
odd urls share the empty host; repeated rows give a row each; rows without
page_id keep a null one; an empty table gives no row; other columns are
ignored.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logflow.llm._common import stored

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][A-Za-z0-9:-]*)"
                  r"((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)/?>|<(/?)([A-Za-z][A-Za-z0-9:-]*)([^>]*)>", re.S)
_ATTR = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NAME = re.compile(r"[a-z]+")
_WORD = re.compile(r"[a-z]+|[0-9]+")
#: Weight of a page in a template; c copies of it weigh 1/c each.
ONE = 1 << 40

# Element names of the HTML standard by their part here.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
REJECTED = {"nav", "header", "footer", "aside", "form", "button", "select", "option", "menu", "dialog", "svg", "math",
            "object", "canvas", "audio", "video", "head", "label", "fieldset", "datalist"}
DECLARED = {"article", "main"}
CONTAINERS = {"html", "body", "main", "article", "section", "div", "center", "table", "tbody", "tr", "td"}
BLOCKS = {"address", "article", "blockquote", "body", "center", "dd", "details", "div", "dl", "dt", "figcaption",
          "figure", "h1", "h2", "h3", "h4", "h5", "h6", "hr", "html", "li", "main", "ol", "p", "pre", "section",
          "summary", "table", "tbody", "tfoot", "thead", "tr", "ul"} | REJECTED
MENUS = {"div", "ul", "ol", "section", "table", "center"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
CLOSES_P = BLOCKS - {"html", "body", "button", "select", "option", "label", "svg", "math"}
OWN_END = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"},
           "option": {"option"}}
SCOPE = {"ul", "ol", "dl", "table", "select"}
# Words in class, id and role that mark what is no article.
REJECTED_NAMES = {"ad", "ads", "advert", "adverts", "advertisement", "banner", "sponsor", "sponsored", "promo", "sidebar",
                  "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer", "cookie", "cookies",
                  "consent", "notice", "notices", "alert", "comment", "comments", "disqus", "reply", "replies", "share",
                  "sharing", "social", "newsletter", "subscribe", "related", "popup", "modal", "toolbar", "pagination",
                  "search", "widget", "complementary", "contentinfo", "aside", "hidden"}
# Words that only say how such a part is laid out.
LAYOUT = {"area", "bar", "block", "body", "bottom", "box", "button", "buttons", "container", "content", "form", "group",
          "header", "icons", "inner", "item", "items", "left", "links", "list", "main", "outer", "panel", "posts", "right",
          "row", "section", "signup", "slot", "thread", "top", "unit", "wrap", "wrapper"}
# First words of names that say what a page has, not what an element is.
STATES = {"has", "is", "no", "not", "with", "without"}


class Node:
    __slots__ = ("label", "tag", "rejected", "text", "size", "links", "children", "order")

    def __init__(self, label: str, tag: str, rejected: bool):
        self.label, self.tag, self.rejected = label, tag, rejected
        self.text: list[str] = []  # own blocks
        self.size = self.links = 0
        self.children: dict[str, Node] = {}


def parse(page: str) -> tuple[Node, list[tuple[tuple[str, ...], str]]]:
    """The folded tree, and the blocks in page order: (path, text).  Rejected
    elements are in neither."""
    root = Node("", "", False)
    blocks: list[tuple[tuple[str, ...], str]] = []
    stack: list[tuple[str, Node, bool]] = [("", root, False)]
    parts: list[str] = []
    link = [0, 0]  # depth in links, characters in them

    def path() -> tuple[str, ...]:
        out = []
        for tag, node, _ in stack[1:]:
            if not out or node.label != out[-1] or node is not prev:
                out.append(node.label)
            prev = node
        return tuple(out)

    def end_block() -> None:
        text = " ".join("".join(parts).split())
        parts.clear()
        if text and not stack[-1][2]:
            node = stack[-1][1]
            node.text.append(text)
            node.size += len(text)
            node.links += min(link[1], len(text))
            blocks.append((path(), text))
        link[1] = 0

    def pop_to(k: int) -> None:
        end_block()
        del stack[k:]

    def close(names: set[str], stop: set[str]) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in names:
                pop_to(k)
                return
            if stack[k][0] in stop:
                return

    at, n = 0, len(page)
    while at < n:
        m = _TAG.search(page, at)
        text = page[at:m.start() if m else n]
        if text and not stack[-1][2]:
            text = html.unescape(text) if "&" in text else text
            parts.append(text)
            if link[0]:
                link[1] += len(text)
        if not m:
            break
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        ending, attrs = m[1] or m[4], m[3] or m[6] or ""
        if ending:
            if name == "a":
                link[0] = max(0, link[0] - 1)
            elif name in BLOCKS or name in CONTAINERS:
                close({name}, set())
            elif name == "br":
                parts.append(" ")
            continue
        if name in RAW:
            end = re.compile(rf"</{name}", re.I).search(page, at)
            at = end.start() if end else n
            continue
        if name == "a":
            link[0] += 1
            continue
        if name in VOID or name not in BLOCKS and name not in CONTAINERS and name != "th":
            if name == "hr":
                end_block()
            elif name == "br":
                parts.append(" ")
            if not (name not in VOID and attrs and _rejected(name, attrs)):
                continue
        if name in CLOSES_P:
            close({"p"}, {"td", "th", "table"} | REJECTED)
        if name in OWN_END:
            close(OWN_END[name], SCOPE)
        if name in ("article", "main"):  # a menu that was never closed does not hold the article
            for k in range(1, len(stack)):
                if stack[k][2] and stack[k][0] in REJECTED:
                    pop_to(k)
                    break
        if name in ("td", "th"):
            parts.append(" ")
        else:
            end_block()
        if attrs.rstrip().endswith("/") and name not in BLOCKS:
            continue
        parent = stack[-1]
        bad = parent[2] or _rejected(name, attrs)
        if bad or name in ("td", "th"):
            stack.append((name, parent[1], bad))
            continue
        names = sorted({w for key, value in _attributes(attrs) if key == "class" for w in _NAME.findall(value)})
        label = ".".join([name, *names])
        node = parent[1].children.get(label)
        if node is None:
            node = parent[1].children[label] = Node(label, name, False)
        stack.append((name, node, False))
    pop_to(1)
    return root, blocks


def _attributes(attrs: str) -> list[tuple[str, str]]:
    """Names and values in lower case; values are never read as names."""
    return [(key.lower(), (a or b or c).lower()) for key, a, b, c in _ATTR.findall(attrs)] if attrs else []


def _names_no_article(key: str, token: str) -> bool:
    words = _WORD.findall(token)
    told = [k for k, w in enumerate(words) if w in REJECTED_NAMES]
    if not told or words[0] in STATES:
        return False
    # a number tells one of many classes apart, but an id with a number names one entry
    return all(w in LAYOUT or key == "class" and w.isdigit() for w in words[told[-1] + 1:])


def _rejected(name: str, attrs: str) -> bool:
    if name in REJECTED:
        return True
    for key, value in _attributes(attrs):
        if key == "hidden" or key == "aria-hidden" and value == "true":
            return True
        if key in ("class", "id", "role") and name not in ("body", "html"):
            if name in DECLARED:  # a comment may be an article of its own
                if key == "class" and not {"comment", "reply"}.isdisjoint(value.split()):
                    return True
            elif any(_names_no_article(key, token) for token in value.split()):
                return True
    return False


# Template nodes are plain lists, so that they travel as JSON:
# [label, tag, weight of its pages, text hash, same text on all pages, size
#  outside links (weighted), children]
def template_of(node: Node, weight: int = ONE) -> list:
    text = "\n".join(node.text)
    return [node.label, node.tag, weight, xxhash.xxh3_64_hexdigest(text) if text else "", True,
            weight * max(0, node.size - node.links), [template_of(c, weight) for c in node.children.values()]]


def _match(a: list, b: list) -> int:
    """Simple tree matching: the most nodes of two trees that can be paired
    in order, roots having one label."""
    if a[0] != b[0]:
        return 0
    return 1 + _pairs(a[6], b[6])[0]


def _pairs(xs: list, ys: list) -> tuple[int, list[tuple[int, int]]]:
    if [x[0] for x in xs] == [y[0] for y in ys]:
        return sum(_match(x, y) for x, y in zip(xs, ys)), [(k, k) for k in range(len(xs))]
    score = np.zeros((len(xs) + 1, len(ys) + 1), dtype=np.int64)
    for i, x in enumerate(xs):
        for j, y in enumerate(ys):
            score[i + 1, j + 1] = max(score[i, j + 1], score[i + 1, j], score[i, j] + _match(x, y))
    pairs, i, j = [], len(xs), len(ys)
    while i and j:
        if score[i, j] == score[i - 1, j]:
            i -= 1
        elif score[i, j] == score[i, j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs.append((i, j))
    return int(score[-1, -1]), pairs[::-1]


def merge(a: list, b: list) -> list:
    """Align ``b`` with template ``a``; unpaired nodes of both stay, in order."""
    children, i, j = [], 0, 0
    for x, y in [*_pairs(a[6], b[6])[1], (len(a[6]), len(b[6]))]:
        children += a[6][i:x] + b[6][j:y]
        if x < len(a[6]):
            children.append(merge(a[6][x], b[6][y]))
        i, j = x + 1, y + 1
    return [a[0], a[1], a[2] + b[2], a[3], a[4] and b[4] and a[3] == b[3], a[5] + b[5], children]


def _pages(t: list) -> int:
    return (t[2] + ONE // 2) // ONE


def _varying(t: list, constant_at: int) -> int:
    own = 0 if t[4] and _pages(t) >= constant_at else t[5]
    return own + sum(_varying(c, constant_at) for c in t[6])


def _declared(t: list, at: list[str]) -> list[tuple[list, list[str]]]:
    """The outermost article and main nodes with text, and their paths."""
    if t[1] in DECLARED:
        return [(t, at)] if _has_text(t) else []
    return [x for c in t[6] for x in _declared(c, [*at, c[0]])]


def _has_text(t: list) -> bool:
    return bool(t[3]) or not t[4] or any(_has_text(c) for c in t[6])


def _has_article(t: list) -> bool:
    return t[1] == "article" and _has_text(t) or any(_has_article(c) for c in t[6])


def _has_heading(t: list) -> bool:
    return t[1] in HEADINGS or any(_has_heading(c) for c in t[6])


def wrapper(template: list, min_pages: int) -> dict:
    """The paths of the content and the paths of template nodes below."""
    constant_at = max(min_pages, _pages(template) * 9 // 10)
    if _pages(template) < min_pages or _varying(template, constant_at) == 0:
        constant_at = 1 << 62  # too few pages, or copies only: nothing tells template and content apart
    roots = _declared(template, [])
    if not roots:
        path, t = [], template
        while True:
            filled = [c for c in t[6] if _varying(c, constant_at)]
            own = 0 if t[4] and _pages(t) >= constant_at else t[5]
            if own or len(filled) != 1 or filled[0][1] not in CONTAINERS:
                break
            t = filled[0]
            path.append(t[0])
        roots = [(t, path)]
    fixed: list[list[str]] = []
    linked: list[list[str]] = []

    def walk(node: list, at: list[str]) -> None:
        if node[1] == "article":
            return
        if node[4] and _pages(node) >= constant_at and node[3]:
            fixed.append(at)
        for c in node[6]:
            below = [*at, c[0]]
            if c[1] in MENUS and _has_text(c) and not _varying(c, 1 << 62) and not _has_heading(c):
                linked.append(below)
            else:
                walk(c, below)

    for node, at in roots:
        if node[1] not in DECLARED or node[1] == "main" and _has_article(node):
            walk(node, at)
    return {"paths": [at for _, at in roots], "fixed": fixed, "linked": linked}


def extract(page: str, rule: dict | None, min_pages: int = 3) -> str:
    root, blocks = parse(page)
    own = None
    for _ in range(2):
        rule = rule or wrapper(template_of(root), min_pages)
        paths, fixed = [tuple(x) for x in rule["paths"]], {tuple(x) for x in rule["fixed"]}
        linked = [tuple(x) for x in rule["linked"]]
        got = [t for p, t in blocks if p not in fixed and any(p[:len(x)] == x for x in paths)
               and not any(p[:len(x)] == x for x in linked)]
        if got or not blocks or own:
            break
        rule = own = wrapper(template_of(root), min_pages)
    return "\n\n".join(got)


def host_of(url):
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)", 1)), F.lit(""))


def _merge_rows(pdf: pd.DataFrame) -> tuple[str, int]:
    out = None
    for text in pdf["template"].tolist():
        t = json.loads(text)
        out = t if out is None else merge(out, t)
    return json.dumps(out), out[2]


def count_copies(pages: DataFrame) -> DataFrame:
    """host, h1, h2, copies: pages of a host that occur more than once.  The
    table is written, so that its measured size decides how it is joined."""
    return stored(pages.select("host", *_hashes()).groupBy("host", "h1", "h2").agg(F.count(F.lit(1)).alias("copies"))
                  .where("copies > 1"), "page-copies")


def _hashes():
    return F.xxhash64("html").alias("h1"), F.xxhash64(F.lit(1), F.reverse("html")).alias("h2")


def induce(pages: DataFrame, *, min_pages: int = 3, salts: int = 64) -> DataFrame:
    """host, rule (JSON) for every host; ``pages`` has host and html."""

    def parse_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found: dict[str, list] = {}
            seen = pdf.groupby(["host", "h1", "h2"], sort=False)
            held = seen["copies"].transform("size").to_numpy()
            first = ~pdf.duplicated(["host", "h1", "h2"]).to_numpy()
            for host, text, n, copies in zip(pdf["host"][first].tolist(), pdf["html"][first].tolist(),
                                             held[first].tolist(), pdf["copies"][first].tolist()):
                t = template_of(parse(text)[0], ONE // int(copies) * n)
                old = found.get(host)
                found[host] = t if old is None else merge(old, t)
            yield pd.DataFrame({"host": list(found), "template": [json.dumps(t) for t in found.values()],
                                "salt": [xxhash.xxh32_intdigest(json.dumps(t)) % salts for t in found.values()]})

    def merge_salted(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"host": pdf["host"].iloc[:1], "template": [_merge_rows(pdf)[0]]})

    def merge_host(pdf: pd.DataFrame) -> pd.DataFrame:
        rule = wrapper(json.loads(_merge_rows(pdf)[0]), min_pages)
        return pd.DataFrame({"host": pdf["host"].iloc[:1], "rule": [json.dumps(rule)]})

    counted = (pages.select("host", "html", *_hashes()).join(count_copies(pages), ["host", "h1", "h2"], "left")
               .withColumn("copies", F.coalesce("copies", F.lit(1))))
    parts = counted.mapInPandas(parse_all, "host string, template string, salt int")
    parts = parts.groupBy("host", "salt").applyInPandas(merge_salted, "host string, template string")
    return parts.groupBy("host").applyInPandas(merge_host, "host string, rule string")


def extract_pages(pages: DataFrame, *, min_pages: int = 3) -> DataFrame:
    """page_id, url, text, n_chars."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html"), F.lit("")).alias("html"), host_of(F.col("url")).alias("host"))
    rules = induce(rows.select("host", "html"), min_pages=min_pages)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, dict] = {}
        for pdf in batches:
            texts = []
            for text, rule in zip(pdf["html"].tolist(), pdf["rule"].tolist()):
                if rule is not None and rule not in known:
                    known[rule] = json.loads(rule)
                texts.append(extract(text, known.get(rule), min_pages))
            yield pd.DataFrame({"page_id": pdf["page_id"].astype("Int64"), "url": pdf["url"], "text": texts,
                                "n_chars": [len(t) for t in texts]})

    return rows.join(rules, "host", "left").drop("host").mapInPandas(
        run, "page_id long, url string, text string, n_chars long")
