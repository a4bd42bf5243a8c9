"""Main text of web pages: boosted trees over DOM nodes, decoded so that no kept node lies under a dropped one.

A page is read into a tree of block elements; text between their boundaries is a block of the page. Each node gets
statistics of its subtree (text, links, density, controls), of its attributes' words, of its depth and ancestors and
of its siblings. The trees give the log-odds that a subtree holds main text; the decoding takes the labels of most
likelihood among those in which a node that holds main text has ancestors that do too.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_right
from collections.abc import Iterator
from html import unescape
from math import log1p
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boosting import Boosted
from .common import chosen

MODEL = Path(__file__).with_name("html_model.json")
#: A tag with its quoted values whole, and one whose quotes are not closed; both match where they start or fail at once.
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^"'>]++|"[^"]*+"|'[^']*+')*+)>""")
_PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_WORDS = re.compile("[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+")
_ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role|itemprop|aria-label|name|type|style|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)

# Fixed values of the HTML standard: void, raw-text and block elements, and what an opening tag closes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Never text of the page; raw ones run to their own end tag.
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
SILENT = frozenset("head template svg select".split())
#: Silent ones that any block inside ends, as an svg does in browsers.
BREAKS_OUT = frozenset("head svg select".split())
BLOCK = frozenset(
    "html body address article aside blockquote center details dialog dd dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol p pre search section summary noscript "
    "table caption thead tbody tfoot tr td th ul".split()
)
CONTROLS = frozenset("input button select textarea label option".split())
_CLOSES = {"li": ("li", ("ul", "ol", "menu", "dir")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)), "td": ("td th", ("table", "tr")), "th": ("td th", ("table", "tr")), **dict.fromkeys(("tbody", "thead", "tfoot"), ("tbody thead tfoot tr td th", ("table",)))}
CLOSES = {tag: (frozenset(ends.split()), frozenset(stops)) for tag, (ends, stops) in _CLOSES.items()}

#: Kinds of tags and kinds of attribute words that are features; a tag has one kind, a node all kinds of its words.
TAG_KINDS = ("article main", "section", "div center", "p address", "h1 h2", "h3 h4 h5 h6 hgroup", "ul ol dl menu dir", "li dt dd", "table caption thead tbody tfoot tr", "td th", "nav search", "header", "footer", "aside", "form fieldset legend", "blockquote pre figure figcaption details summary", "#text")
TAG_KIND = {t: k for k, tags in enumerate(TAG_KINDS) for t in tags.split()}
WORD_KINDS = (
    "nav navigation navbar menu menubar breadcrumb breadcrumbs crumbs pagination pager toc tabs links",
    "header masthead topbar logo brand branding head top",
    "footer foot bottom copyright legal colophon contentinfo",
    "sidebar side aside rail widget widgets complementary column",
    "related recommended recommendations trending popular latest teaser teasers readmore suggestions",
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion dfp adsense commercial",
    "share sharing social follow like tweet facebook twitter",
    "comment comments disqus reply replies respond discussion feedback reader readers",
    "form newsletter subscribe subscription signup login signin search contact register",
    "cookie cookies consent gdpr notice notices alert popup modal overlay message warning paywall announcement banner privacy",
    "content article post entry story main articlebody prose richtext markdown text",
    "hidden none invisible",
)
WORD_KIND = {w: 1 << k for k, words in enumerate(WORD_KINDS) for w in words.split()}
#: What a browser shows only without scripts is a notice as its class would say.
TAG_WORDS = {"noscript": WORD_KIND["notice"]}


def _attribute_kinds(attributes: str) -> int:
    kinds = 0
    for name, value in _ATTRIBUTE.findall(attributes):
        if name.lower() in ("hidden", "style", "aria-hidden"):
            low = value.lower().replace(" ", "")
            if name.lower() == "hidden" or "display:none" in low or "visibility:hidden" in low or low.strip("\"'") == "true":
                kinds |= WORD_KIND["hidden"]
        else:
            for word in _WORDS.findall(value):
                kinds |= WORD_KIND.get(word.lower(), 0)
    return kinds


class Tokens:
    """Text, tags and the places where they end, in one pass: each question about the rest of a page is asked once."""

    __slots__ = ("source", "size", "last_end", "quotes_close")

    def __init__(self, source: str):
        self.source, self.size = source, len(source)
        #: No tag starts beyond the last '>', and once a quote was never closed, quotes no longer count.
        self.last_end, self.quotes_close = source.rfind(">"), True

    def tag_at(self, begin: int) -> tuple[int, str, str, str]:
        """(end, '/' or '', name, attributes) of what starts with the '<' at begin; no name for comments and the like, end 0 for plain text."""
        source = self.source
        if source.startswith("!--", begin + 1):
            end = source.find("-->", begin + 2)  # '<!-->' is whole
            return (end + 3 if end >= 0 else self.size), "", "", ""
        if source.startswith("![CDATA[", begin + 1):
            end = source.find("]]>", begin + 9)
            return (end + 3 if end >= 0 else self.size), "", "", ""
        if begin > self.last_end:
            return 0, "", "", ""
        if source.startswith(("!", "?"), begin + 1):
            return source.find(">", begin) + 1, "", "", ""
        found = None
        if self.quotes_close and not (found := _TAG.match(source, begin)) and _PLAIN_TAG.match(source, begin):
            self.quotes_close = False
        found = found or _PLAIN_TAG.match(source, begin)
        return (found.end(), found[1], found[2].lower(), found[3]) if found else (0, "", "", "")

    def after_raw(self, tag: str, at: int) -> int:
        """Where the raw text of a tag has ended, its end tag included."""
        found = re.compile(f"</{tag}(?=[\\s/>])[^>]*+>", re.I).search(self.source, at, self.last_end + 1)
        return found.end() if found else self.size


class Page:
    """Nodes of a page in page order: parent, tag, kinds of attribute words, tags inside; and its blocks of text."""

    __slots__ = ("parent", "tag", "kinds", "depth", "inner", "controls", "blocks", "stack", "opened")

    def __init__(self, source: str):
        self.parent, self.tag, self.kinds, self.depth, self.inner, self.controls = [-1], ["html"], [0], [0], [0], [0]
        #: (node, text, characters of it in links)
        self.blocks: list[tuple[int, str, int]] = []
        #: Open nodes, and for each tag its places among them, so that none is looked for in vain.
        self.stack, self.opened = [0], {}
        self._read(source)

    def _node(self, parent: int, tag: str, kinds: int) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.kinds.append(kinds)
        self.depth.append(self.depth[parent] + 1)
        self.inner.append(0)
        self.controls.append(0)
        return len(self.parent) - 1

    def _innermost(self, tags) -> int:
        """Place of the innermost open node with one of these tags, 0 if there is none."""
        return max((places[-1] for t in tags if (places := self.opened.get(t))), default=0)

    def _close(self, place: int) -> None:
        for node in self.stack[place:]:
            self.opened[self.tag[node]].pop()
        del self.stack[place:]

    def _open(self, tag: str, kinds: int) -> None:
        self.opened.setdefault(tag, []).append(len(self.stack))
        self.stack.append(self._node(self.stack[-1], tag, kinds))

    def _read(self, source: str) -> None:
        tokens, stack, inner = Tokens(source), self.stack, self.inner
        parts, linked, link, at, silent, text_from = [], 0, False, 0, [], 0

        def add(end: int) -> None:
            """What lies between text_from and end is text of the page, unless something silent is open."""
            nonlocal linked
            if end > text_from and not silent:
                text = source[text_from:end]
                if "&" in text:
                    text = unescape(text)
                parts.append(text)
                if link:
                    linked += len(text)

        def flush() -> None:
            nonlocal linked
            if parts:
                text = " ".join("".join(parts).split())
                if text:
                    self.blocks.append((stack[-1], text, min(linked, len(text))))
                parts.clear()
            linked = 0

        while (begin := source.find("<", at)) >= 0:
            end, closing, tag, attributes = tokens.tag_at(begin)
            if not end:
                at = begin + 1  # a plain '<'
                continue
            add(begin)
            at = text_from = end
            if not tag:
                continue
            if closing:
                if silent and tag in silent:
                    del silent[silent.index(tag) :]
                elif tag == "a":
                    link = False
                elif tag in BLOCK and (place := self._innermost((tag,))):
                    silent.clear()  # what its own end tag has not closed ends with what it lies in
                    flush()
                    link = False
                    self._close(place)
                continue
            if tag in CONTROLS:
                self.controls[stack[-1]] += 1
            if tag in RAW:
                at = text_from = tokens.after_raw(tag, at)
                continue
            if silent:
                if tag != "body" and (tag not in BLOCK or silent[-1] not in BREAKS_OUT):
                    if tag in SILENT and not attributes.endswith("/"):
                        silent.append(tag)
                    continue
                silent.clear()
            elif tag in SILENT:
                if not attributes.endswith("/"):
                    silent.append(tag)
                continue
            inner[stack[-1]] += 1
            if tag == "br":
                parts.append(" ")
            elif tag == "a":
                link = True
            elif tag in BLOCK:
                flush()
                link = False
                if tag == "html" or (tag == "body" and self.opened.get("body")):
                    if attributes:
                        self.kinds[0] |= _attribute_kinds(attributes)
                    continue
                if tag in CLOSES:
                    ends, stops = CLOSES[tag]
                    # Of nested ones the outermost goes that no stop parts from here.
                    stop = self._innermost(stops)
                    outer = [places[bisect_right(places, stop)] for t in ends if (places := self.opened.get(t)) and places[-1] > stop]
                    if outer:
                        self._close(min(outer))
                if self.tag[stack[-1]] == "p":
                    self._close(len(stack) - 1)
                if tag == "hr":
                    continue
                self._open(tag, (_attribute_kinds(attributes) if attributes else 0) | TAG_WORDS.get(tag, 0))
        add(len(source))
        flush()


#: Numbers of each node besides the kinds of its tag, its words, and its ancestors' tags and words.
NUMBERS = (
    "depth", "text", "link_share", "nodes", "density", "paragraphs", "items", "controls", "place", "siblings", "like_siblings", "page_share", "before", "stops", "words", "children",
    "parent_text", "parent_link_share", "previous_text", "next_text", "previous_link_share", "next_link_share",
)
WIDTH = len(NUMBERS) + len(TAG_KINDS) * 2 + len(WORD_KINDS) * 2


#: Nodes whose rows are made at once, and pages and characters of them that are read at once.
NODES, PAGES, CHARS = 16_384, 100, 4_000_000


def features(page: Page) -> tuple[np.ndarray, list[int], list[int]]:
    """A row for each node, each node's parent, and each block's node; text beside block elements is a node of its own."""
    parts, parent, owner = feature_parts(page)
    return np.vstack(list(parts)), parent, owner


def feature_parts(page: Page) -> tuple[Iterator[np.ndarray], list[int], list[int]]:
    """features, with the rows in parts of bounded size, made as they are asked for."""
    parent, tag, kinds, depth = page.parent, page.tag, page.kinds, page.depth
    elements = len(parent)
    has_child, texts = [False] * elements, [0] * elements
    for k in range(1, elements):
        has_child[parent[k]] = True
    for node, _, _ in page.blocks:
        texts[node] += 1
    owner: list[int] = []
    for b, (node, _, _) in enumerate(page.blocks):
        owner.append(page._node(node, "#text", 0) if has_child[node] or texts[node] > 1 else node)
    n = len(parent)
    chars, linked, stops, words, before = [0] * n, [0] * n, [0] * n, [0] * n, [-1] * n
    so_far = 0
    for node, (_, text, in_links) in zip(owner, page.blocks, strict=True):
        chars[node], linked[node], before[node] = len(text), in_links, so_far
        stops[node], words[node] = text.count(",") + text.count(".") + text.count(";"), text.count(" ") + 1
        so_far += len(text)
    nodes, inner, controls, paragraphs, items, children = [1] * n, page.inner, page.controls, [int(t == "p") for t in tag], [int(t == "li") for t in tag], [0] * n
    for k in range(n - 1, 0, -1):
        # Text nodes have the largest numbers and no children, so every node comes before what is in it.
        p = parent[k]
        chars[p] += chars[k]
        linked[p] += linked[k]
        stops[p] += stops[k]
        words[p] += words[k]
        nodes[p] += nodes[k]
        inner[p] += inner[k]
        controls[p] += controls[k]
        paragraphs[p] += paragraphs[k]
        items[p] += items[k]
        children[p] += 1
        if before[k] >= 0 and (before[p] < 0 or before[k] < before[p]):
            before[p] = before[k]
    total = max(1, so_far)
    own_tag = [TAG_KIND.get(t, 2) for t in tag]
    above_tag, above_words = [0] * n, [0] * n
    seen, like, last, previous, following = [0] * n, {}, [-1] * n, [-1] * n, [-1] * n
    place = [0] * n
    for k in range(1, n):
        p = parent[k]
        above_tag[k] = above_tag[p] | 1 << own_tag[p]
        above_words[k] = above_words[p] | kinds[p]
        place[k] = seen[p]
        seen[p] += 1
        key = (p, own_tag[k])
        like[key] = like.get(key, 0) + 1
        if (q := last[p]) >= 0:
            previous[k], following[q] = q, k
        last[p] = k
    log_text = [log1p(c) for c in chars]
    share = [a / c if c else 0.0 for a, c in zip(linked, chars, strict=True)]
    tags, words_ = np.arange(len(TAG_KINDS)), np.arange(len(WORD_KINDS))
    bits = lambda of, width: (np.array(of, np.int64)[:, None] >> width) & 1

    def rows(some: range) -> np.ndarray:
        numbers = [
            (
                depth[k], log_text[k], share[k], log1p(nodes[k]), log1p(chars[k] / (inner[k] + 1)), log1p(paragraphs[k]), log1p(items[k]), log1p(controls[k]), place[k], seen[(p := parent[k])] if k else 1,
                like[p, own_tag[k]] / seen[p] if k else 1.0, chars[k] / total, before[k] / total, 100.0 * stops[k] / (chars[k] + 1), log1p(words[k]), children[k],
                log_text[p] if k else 0.0, share[p] if k else 0.0, log_text[a] if (a := previous[k]) >= 0 else -1.0, log_text[b] if (b := following[k]) >= 0 else -1.0, share[a] if a >= 0 else -1.0, share[b] if b >= 0 else -1.0,
            )
            for k in some
        ]
        cut = slice(some.start, some.stop)
        return np.hstack([np.array(numbers, np.float64), np.array(own_tag[cut])[:, None] == tags, bits(above_tag[cut], tags), bits(kinds[cut], words_), bits(above_words[cut], words_)])

    return (rows(range(at, min(n, at + NODES))) for at in range(0, n, NODES)), parent, owner


def decode(odds: list[float], parent: list[int]) -> list[bool]:
    """The most likely labels in which no node is kept under a dropped one."""
    n = len(parent)
    gain = list(odds)  # of keeping a node, with the best of what is in it, over dropping all of that
    for k in range(n - 1, 0, -1):
        if gain[k] > 0:
            gain[parent[k]] += gain[k]
    kept = [False] * n
    kept[0] = gain[0] > 0
    for k in range(1, n):
        kept[k] = kept[parent[k]] and gain[k] > 0
    return kept


_model: list[Boosted] = []


def model() -> Boosted:
    if not _model:
        _model.append(Boosted.from_dict(json.loads(MODEL.read_text())))
    return _model[0]


def main_texts(sources: list[str], trees: Boosted) -> list[str]:
    """The main text of each page; rows of nodes go through the trees some ten thousand at a time, of small pages together."""
    pages, shapes, odds, waiting, held = [Page(s) for s in sources], [], [], [], 0
    for page in pages:
        parts, parent, owner = feature_parts(page)
        shapes.append((parent, owner))
        for x in parts:
            waiting.append(x)
            if (held := held + len(x)) >= NODES:
                odds.extend(trees.log_odds(np.vstack(waiting)).tolist())
                waiting, held = [], 0
    if waiting:
        odds.extend(trees.log_odds(np.vstack(waiting)).tolist())
    out, at = [], 0
    for page, (parent, owner) in zip(pages, shapes, strict=True):
        kept = decode(odds[at : at + len(parent)], parent)
        at += len(parent)
        out.append("\n".join(text for (_, text, _), node in zip(page.blocks, owner, strict=True) if kept[node]))
    return out


def groups(lengths: list[int]) -> Iterator[range]:
    """Rows that are worked on together: PAGES at most, and CHARS but for a single longer page."""
    first, chars = 0, 0
    for k, n in enumerate(lengths):
        if k > first and (k - first >= PAGES or chars + n > CHARS):
            yield range(first, k)
            first, chars = k, 0
        chars += n
    if first < len(lengths):
        yield range(first, len(lengths))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars for every row: blocks of the main text in page order, joined by line ends.

    Null html counts as empty; a page without main text has an empty one; an empty table gives no rows. Rows may repeat,
    ids and urls may be null; each row stands alone, so nothing is shuffled. Broken pages of any length take time in
    proportion to it: a tag that is never closed is text, and a comment or raw element that is never closed takes the rest.
    """
    sent = pages.sparkSession.sparkContext.broadcast(model().to_dict())
    cache: list[Boosted] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not cache:
            cache.append(Boosted.from_dict(sent.value))
        for whole in batches:
            for some in groups(pc.fill_null(pc.binary_length(whole.column(2)), 0).to_pylist()):
                batch = whole.slice(some.start, len(some))
                texts = main_texts([h.as_py() or "" for h in batch.column(2)], cache[0])
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    own = chosen(pages, page_id=id_col, url=url_col, html=html_col)
    return own.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), "html").mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
