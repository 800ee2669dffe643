"""Main text of HTML pages by composite text density (operator 1).

For every DOM node the link-adjusted characters per tag are computed:

    density = C / T * log_b(C / LC * T / LT),
    b = ln(C / (C - LC) * LC + LC_body / C_body * C + e)

with C, T the characters and tags below the node and LC, LT those inside links
(zeros count as one). A node's density sum adds the densities of its children,
where a run of its own text counts as a child without tags. The node with the
largest sum is the core of the page; the smallest density on its path to body
is the threshold, and every node that reaches the threshold on the way down
from body adds its own largest-sum node. This walk runs on every page; an
``article`` that it reaches with at least half the threshold is taken as a whole,
each of several, and headings on the core's path are kept.

Elements that are never content (scripts, forms, navigation, page headers and
footers, asides, adverts, notices, reader comments) are left out beforehand, by
tag, role, or a word of their class or id. Text overrules a word: on a page
without ``article`` or ``main``, an element stays that has most of the text outside
links, and ten times as much as is outside worded elements; inside an article, one
whose characters per tag are at least half the article's. ``header`` inside an
article keeps its headings only.

Text: character references decoded once, white space inside a block turned into
one space and trimmed, blocks (block elements and line breaks) joined by "\\n".

Defined cases: null, empty or tagless html gives "" or the plain text; broken
or unclosed markup never fails; repeated rows give repeated rows; an empty
table gives an empty result; other columns are not read. The page is one value
of a row, so memory is bounded by the longest page.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from larch.llm.common import read_table

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BLOCKS = HEADINGS | frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset header hgroup hr html legend li main menu nav ol option p pre section summary "
    "table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCKS - frozenset("br body html td th tr tbody thead tfoot caption option legend".split())
#: An open element that a new one of the same kind ends, and what shields it.
SELF_CLOSING_KIN = {
    "li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"),
    "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select"),
    "tbody": ("tbody thead tfoot tr td th", "table"), "tfoot": ("tbody thead tfoot tr td th", "table"),
}
SELF_CLOSING_KIN = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in SELF_CLOSING_KIN.items()}
P_SHIELDS = frozenset("table td th caption button object".split())

# What is never part of an article.
NEVER = frozenset(
    "head script style noscript template nav footer aside form button input select textarea iframe object embed "
    "canvas svg audio video map menu dialog".split())
NEVER_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
NEVER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense sponsor sponsored sponsors promo "
    "promos promotion banner banners cookie cookies consent gdpr notice notices notification notifications alert "
    "popup popups modal overlay lightbox sidebar sidebars sidenav rail menu menus nav navbar navigation navs "
    "breadcrumb breadcrumbs pagination pager footer footers masthead topbar toolbar share sharing sharebar social "
    "related recommended recommendations newsletter subscribe subscription signup login paywall skiplink".split())
COMMENT_WORDS = frozenset("comment comments commentlist disqus reply replies respond feedback".split())
HEADER_WORDS = frozenset("header headers".split())
_WORDS = re.compile(r"[A-Za-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def _attr_words(attrs: dict[str, str]) -> set[str]:
    text = " ".join(v for k in ("class", "id") if (v := attrs.get(k)))
    return {w.lower() for w in _WORDS.findall(_CAMEL.sub(" ", text))} if text else set()


#: Elements whose content is not markup, up to their end tag.
RAW_TEXT = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in "script style textarea title iframe xmp noembed noframes".split()}
_MARKUP = re.compile(
    r"""<(?:!--(?:-?>|.*?(?:--!?>|\Z))                       # comment, or one that never ends
        |[!?][^>]*+(?:>|\Z)                                  # doctype and the like
        |/(?P<end>[A-Za-z][^\s/>]*+)[^>]*+(?:>|\Z)
        |(?P<start>[A-Za-z][^\s/>]*+)
         (?P<attrs>(?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+|["'])*+)(?:(?P<whole>>)|\Z))""", re.S | re.X)
_ATTR = re.compile(r"""([^\s/=>"'][^\s/=>]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")


class _Tree:
    """Node i: tag[i], parent[i], kids[i] (node numbers and strings), drop[i]."""

    def __init__(self, html: str) -> None:
        self.tag, self.parent, self.kids, self.drop = ["#root"], [-1], [[]], [""]
        self.open = [0]
        at, end = 0, len(html)
        while at < end:
            m = _MARKUP.search(html, at)
            if (stop := m.start() if m else end) > at:
                data = html[at:stop]
                self.kids[self.open[-1]].append(unescape(data) if "&" in data else data)
            if not m:
                return
            at = m.end()
            if m["start"]:
                if m["whole"]:
                    tag = m["start"].lower()
                    self._start(tag, m["attrs"])
                    if raw := RAW_TEXT.get(tag):
                        close = raw.search(html, at)
                        at = close.start() if close else end
            elif m["end"]:
                self._end(m["end"].lower())

    def _close_to(self, kinds: frozenset[str], shields: frozenset[str]) -> None:
        """Close open elements down to the outermost of ``kinds`` this side of a shield."""
        cut = None
        for depth in range(len(self.open) - 1, 0, -1):
            t = self.tag[self.open[depth]]
            if t in shields:
                break
            if t in kinds:
                cut = depth
        if cut:
            del self.open[cut:]

    def _start(self, tag: str, attrs: str) -> None:
        if tag in CLOSES_P:
            self._close_to(frozenset(("p",)), P_SHIELDS)
        if kin := SELF_CLOSING_KIN.get(tag):
            self._close_to(*kin)
        if tag == "body" and "body" in self.tag:
            return
        n = len(self.tag)
        self.tag.append(tag)
        self.parent.append(self.open[-1])
        self.kids.append([])
        self.kids[self.open[-1]].append(n)
        self.drop.append("tag" if tag in NEVER else _why_dropped(tag, attrs) if attrs else "")
        if tag not in VOID:
            self.open.append(n)

    def _end(self, tag: str) -> None:
        for depth in range(len(self.open) - 1, 0, -1):
            if self.tag[self.open[depth]] == tag:
                if tag in BLOCKS or not any(self.tag[n] in BLOCKS for n in self.open[depth + 1:]):
                    del self.open[depth:]
                else:  # a misnested inline element ends alone
                    del self.open[depth]
                return
        if tag in ("p", "br"):
            self.kids[self.open[-1]].append("\n")


def _why_dropped(tag: str, text: str) -> str:
    """Why an element with these attributes is no content, or ""."""
    attrs: dict[str, str] = {}
    for name, *values in _ATTR.findall(text):
        attrs.setdefault(name.lower(), unescape("".join(values)))
    style = attrs.get("style", "").replace(" ", "").lower()
    if (attrs.get("role", "").lower() in NEVER_ROLES or "hidden" in attrs
            or attrs.get("aria-hidden", "").lower() == "true" or "display:none" in style):
        return "tag"
    words = _attr_words(attrs)
    if tag in ("html", "body", "main") or not words:
        return ""
    if words & COMMENT_WORDS:
        return "word"
    if tag == "article":
        return ""
    return "word" if words & NEVER_WORDS else "header" if words & HEADER_WORDS and tag not in HEADINGS else ""


def _density(c: int, t: int, lc: int, lt: int, body_links: float) -> float:
    if not c:
        return 0.0
    t, lc1, lt1 = max(t, 1), max(lc, 1), max(lt, 1)
    base = math.log(c / max(c - lc, 1) * lc1 + body_links * c + math.e)
    return c / t * math.log(max(c / lc1 * t / lt1, 1.0)) / math.log(base)


def _settle_drops(tree: _Tree) -> list[bool]:
    """Which nodes are left out. A word in a class doesn't outweigh an article
    or main below it; a header inside an article keeps its headings."""
    tag, parent, n = tree.tag, tree.parent, len(tree.tag)
    holds, in_article = [False] * n, [False] * n
    for i in range(n - 1, 0, -1):
        if holds[i] or (tag[i] in ("article", "main") and not tree.drop[i]):
            holds[parent[i]] = True
    out = [False] * n
    for i in range(1, n):
        p = parent[i]
        in_article[i] = in_article[p] or (tag[i] == "article" and not out[p])
        if out[p]:
            out[i] = True
            continue
        why = tree.drop[i] or ("header" if tag[i] == "header" else "")
        if why == "tag":
            out[i] = True
        elif why == "word":
            out[i] = not holds[i]
        elif why == "header":
            out[i] = not holds[i] and not in_article[p]
        if why == "header" and in_article[p] and not out[i]:
            _keep_headings_only(tree, i, out)
    return out


def _keep_headings_only(tree: _Tree, top: int, out: list[bool]) -> None:
    stack = [top]
    while stack:
        i = stack.pop()
        kept: list = []
        for k in tree.kids[i]:
            if isinstance(k, int):
                kept.append(k)
                if tree.tag[k] not in HEADINGS:
                    stack.append(k)
        tree.kids[i] = kept


def _text_of(tree: _Tree, out: list[bool], keep: list[bool]) -> str:
    """Blocks of the kept nodes, in page order."""
    blocks: list[str] = []
    run: list[str] = []

    def end_block() -> None:
        if run and (text := " ".join("".join(run).split())):
            blocks.append(text)
        run.clear()

    stack: list[tuple[int, int]] = [(0, 0)]
    while stack:
        i, at = stack.pop()
        kids = tree.kids[i]
        while at < len(kids):
            k = kids[at]
            at += 1
            if isinstance(k, str):
                if keep[i]:
                    run.append(k)
            elif not out[k]:
                if tree.tag[k] in BLOCKS:
                    end_block()
                keep[k] = keep[k] or keep[i]
                stack.append((i, at))
                i, at, kids = k, 0, tree.kids[k]
        if tree.tag[i] in BLOCKS or i == 0:
            end_block()
    return "\n".join(blocks)


def _leads_to_article(tree: _Tree, inside: list[bool], density: list[float], threshold: float, top: int, core: int) -> bool:
    """Whether an article that the walk reaches lies between ``top`` and ``core``, or
    holds it, or is held by it: it is then kept as a whole instead of the core."""
    i = core
    while i != top:
        if tree.tag[i] == "article":
            return True
        i = tree.parent[i]
    stack = [core]
    while stack:
        i = stack.pop()
        if tree.tag[i] == "article" and density[i] >= threshold:
            return True
        stack.extend(k for k in tree.kids[i] if isinstance(k, int) and inside[k])
    return False


def _overrule_words(tree: _Tree) -> None:
    """Takes back what a word of a class has dropped where the text speaks against it."""
    worded = [i for i, why in enumerate(tree.drop) if why == "word"]
    if not worded:
        return
    tag, parent, n = tree.tag, tree.parent, len(tree.tag)
    gone, link = [False] * n, [False] * n
    chars, tags = [0] * n, [0] * n
    article, holder = [-1] * n, [-1] * n  # nearest article, and topmost worded element inside it or the page
    for i in range(1, n):
        p = parent[i]
        gone[i] = gone[p] or tree.drop[i] == "tag"
        link[i] = link[p] or tag[i] == "a"
        article[i] = i if tag[i] == "article" else article[p]
        holder[i] = holder[p] if holder[p] >= 0 else (i if tree.drop[i] == "word" else -1)
        if not gone[i] and not link[i]:
            chars[i] = sum(len(" ".join(k.split())) for k in tree.kids[i] if isinstance(k, str))
    plain = chars[:]  # of articles: without worded elements
    for i in range(n - 1, 0, -1):
        if not gone[i]:
            chars[parent[i]] += chars[i]
            tags[parent[i]] += tags[i] + 1
            if tree.drop[i] != "word":
                plain[parent[i]] += plain[i]
    marked = any(tag[i] in ("article", "main") and holder[i] < 0 and plain[i] for i in range(n))
    for i in worded:
        a = article[parent[i]]
        if not marked and 2 * chars[i] > chars[0] and 10 * plain[0] < chars[i]:
            tree.drop[i] = ""
        elif a >= 0 and holder[i] == i and tags[i] and 2 * chars[i] / tags[i] >= plain[a] / max(tags[a] - tags[i], 1):
            tree.drop[i] = ""


def main_text(html: str | None) -> str:
    """The main text of one page."""
    if not html:
        return ""
    tree = _Tree(html)
    tag, parent, kids, n = tree.tag, tree.parent, tree.kids, len(tree.tag)
    _overrule_words(tree)
    out = _settle_drops(tree)
    body = tag.index("body") if "body" in tag else 0
    inside, link = [False] * n, [False] * n
    inside[body] = True
    chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    for i in range(n):
        if i and parent[i] >= 0:
            inside[i] = inside[i] or (inside[parent[i]] and not out[i])
            link[i] = tag[i] == "a" or link[parent[i]]
        if inside[i]:
            chars[i] = sum(len(" ".join(k.split())) for k in kids[i] if isinstance(k, str))
            link_chars[i] = chars[i] if link[i] else 0
    for i in range(n - 1, body, -1):
        if inside[i]:
            p = parent[i]
            chars[p] += chars[i]
            tags[p] += tags[i] + 1
            link_chars[p] += link_chars[i]
            link_tags[p] += link_tags[i] + (tag[i] == "a")
    if not chars[body]:
        return ""
    body_links = link_chars[body] / chars[body]
    density = [_density(chars[i], tags[i], link_chars[i], link_tags[i], body_links) if inside[i] else 0.0 for i in range(n)]
    sums, best = [0.0] * n, list(range(n))
    for i in range(n - 1, body - 1, -1):
        if inside[i]:
            for k in kids[i]:
                if isinstance(k, int):
                    if inside[k]:
                        sums[i] += density[k]
                elif c := len(" ".join(k.split())):
                    sums[i] += _density(c, 1, c if link[i] else 0, 1 if link[i] else 0, body_links)
            for k in kids[i]:
                if isinstance(k, int) and inside[k] and sums[best[k]] > sums[best[i]]:
                    best[i] = best[k]
    core, keep = best[body], [False] * n
    path = [core]
    while path[-1] != body:
        path.append(parent[path[-1]])
    threshold, stack = min(density[i] for i in path), [body]
    while stack:
        i = stack.pop()
        if density[i] * (2 if tag[i] == "article" else 1) < threshold:
            continue
        if tag[i] == "article":
            keep[i] = True
            continue
        if not _leads_to_article(tree, inside, density, threshold, i, best[i]):
            keep[best[i]] = True
        if best[i] != i or tag[best[i]] != "article":
            stack.extend(k for k in kids[i] if isinstance(k, int) and inside[k])
    for i in path:
        for k in kids[i]:
            if isinstance(k, int) and inside[k] and tag[k] in HEADINGS:
                keep[k] = True
    return _text_of(tree, out, keep)


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    types = dict(pages.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            text = [main_text(h) for h in b["html"]]
            yield pd.DataFrame({"page_id": b["page_id"], "url": b["url"], "text": text, "n_chars": [len(t) for t in text]})

    return pages.selectExpr(f"`{id_col}` AS page_id", f"`{url_col}` AS url", f"cast(`{html_col}` AS string) AS html").mapInPandas(
        run, f"page_id {types[id_col]}, url {types[url_col]}, text string, n_chars long")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(read_table(spark, sf_dir, "pages"))
