"""Trains the model of html.py on pages that it makes up: python -m eventloom.llm.html_training writes html_model.json.

Each page draws its layout, tags, attribute words, mess and texts at random; MARK begins every block of main text, so
each node's label is known: whether it holds any.
"""

from __future__ import annotations

import json
import random

import numpy as np

from .boosting import Boosted, train
from .html import MODEL, Page, features

MARK = "\ue000"
PAGES, TREES, SEED = 5000, 90, 11
SYLLABLES = "an ba cor de el fi gra ho in jo ka lu mo ne or pa qui re si ta un ve wo xa yo ze sch ção é ñ ü ку ра ми 中 文".split()
INLINE = ("b", "i", "em", "strong", "span", "code", "u", "mark", "small", "font")


class Maker:
    def __init__(self, seed: int):
        self.r = random.Random(seed)
        #: How telling this page's attributes are, and whether it leaves end tags out.
        self.telling = self.r.choice((0.0, 0.4, 0.9, 1.0))
        self.semantic = self.r.choice((0.0, 0.5, 0.9, 1.0, 1.0))
        self.sloppy = self.r.random() < 0.3
        #: How the page sets its text: in paragraphs, in div elements, or bare with line breaks between paragraphs.
        self.style = self.r.choice(("p", "p", "p", "p", "div", "bare"))
        self.mark = False

    def words(self, low: int, high: int) -> str:
        r = self.r
        return " ".join("".join(r.choices(SYLLABLES, k=r.randint(1, 4))) for _ in range(r.randint(low, high)))

    def sentence(self, low: int = 4, high: int = 22) -> str:
        text = self.words(low, high)
        if self.r.random() < 0.4:
            text = text.replace(" ", ", ", 1)
        return text[:1].upper() + text[1:] + self.r.choice((".", ".", ".", "!", "?"))

    def prose(self, low: int, high: int) -> str:
        parts = []
        for _ in range(self.r.randint(low, high)):
            s, p = self.sentence(), self.r.random()
            if p < 0.12:
                tag = self.r.choice(INLINE)
                s = f"<{tag}>{s}</{tag}>"
            elif p < 0.2:
                s = f'{s} <a href="/{self.words(1, 1)}">{self.words(1, 4)}</a>'
            elif p < 0.24:
                s = f"{s}<br>"
            elif p < 0.3:
                s += self.r.choice((" &amp; ", "&nbsp;", " &mdash; ", " &#233;", " &&& ", " $$$ ", "%%%"))
            parts.append(s)
        return self.r.choice((" ", "\n")).join(parts)

    def attributes(self, *kinds: str) -> str:
        r = self.r
        if r.random() >= self.telling:
            return r.choice(("", "", f' class="{self.words(1, 2)}"', f' id="c{r.randint(1, 99)}"'))
        word = r.choice(kinds)
        word = r.choice((word, word, word, f"{self.words(1, 1)}-{word}", f"{word}__inner", f"{word}s", word.title(), f"l-{word} {self.words(1, 1)}"))
        return f' {r.choice(("class", "class", "class", "id"))}="{word}"'

    def block(self, tag: str, inside: str, *kinds: str, main: bool = False) -> str:
        start = f"<{tag}{self.attributes(*kinds) if kinds else ''}>" + (MARK if main else "")
        if self.sloppy and tag in ("p", "li", "td", "tr", "dd") and self.r.random() < 0.5:
            return start + inside
        return f"{start}{inside}</{tag}>" + self.r.choice(("", "", "\n", "\n  "))

    def named(self, tag: str) -> str:
        return tag if self.r.random() < self.semantic else "div"

    def link_list(self, low: int, high: int, long: int = 3) -> str:
        links = [f'<a href="/{self.words(1, 1)}">{self.words(1, long)}</a>' for _ in range(self.r.randint(low, high))]
        if self.r.random() < 0.7:
            return self.block("ul", "".join(self.block("li", x) for x in links))
        return self.r.choice((" | ", " ", "<br>", " &middot; ")).join(links)

    def nav(self) -> str:
        return self.block(self.named("nav"), self.link_list(3, 12), "nav", "menu", "navbar", "navigation", "breadcrumb")

    def header(self) -> str:
        inside = self.r.choice(("", self.block(self.r.choice(("div", "p", "h1", "h2")), f'<a href="/">{self.words(1, 3)}</a>', "logo", "brand"), self.block("p", self.sentence(2, 8))))
        return self.block(self.named("header"), inside + (self.nav() if self.r.random() < 0.6 else ""), "header", "masthead", "topbar", "banner", "site-header")

    def ad(self) -> str:
        inside = self.r.choice((self.sentence(), self.sentence() + f' <a href="/x">{self.words(1, 4)}</a>', self.prose(1, 3), self.block("p", self.sentence())))
        return self.block(self.r.choice(("div", "div", self.named("aside"), "section")), inside, "ad", "ads", "advert", "advertisement", "sponsored", "promo")

    def notice(self) -> str:
        inside = self.r.choice((self.sentence(), self.block("p", self.prose(1, 2)))) + self.r.choice(("", f"<button>{self.words(1, 2)}</button>", f'<a href="#">{self.words(1, 2)}</a>'))
        return self.block(self.r.choice(("div", "section")), inside, "cookie", "consent", "notice", "alert", "banner", "gdpr", "popup", "paywall")

    def form(self) -> str:
        inside = f"<label>{self.words(1, 3)}</label><input type=text name=q>" + self.r.choice(("", self.block("p", self.sentence()), f"<select><option>{self.words(1, 2)}<option>{self.words(1, 2)}</select>")) + f"<button>{self.words(1, 2)}</button>"
        made = self.block("form", inside, "form", "search", "newsletter", "subscribe", "login")
        return self.block("div", self.block("h3", self.words(2, 5)) + self.block("p", self.sentence()) + made, "newsletter", "subscribe", "signup") if self.r.random() < 0.4 else made

    def sidebar(self) -> str:
        widgets = []
        for _ in range(self.r.randint(1, 4)):
            body = self.r.choice((self.link_list(3, 8, 8), self.block("p", self.prose(1, 3)), self.ad(), self.form(), "".join(self.block("div", f'<a href="/{k}">{self.words(3, 9)}</a> {self.sentence()}', "teaser", "item") for k in range(self.r.randint(2, 5)))))
            widgets.append(self.block(self.r.choice(("div", "section")), self.block(self.r.choice(("h3", "h4", "div")), self.words(1, 4)) + body, "widget", "related", "popular", "recommended"))
        return self.block(self.named("aside"), "".join(widgets) if self.r.random() < 0.8 else self.prose(1, 4), "sidebar", "side", "aside", "rail")

    def comments(self) -> str:
        tag = self.r.choice(("div", "li", self.named("article"), "div"))
        each = [self.block(tag, self.block(self.r.choice(("span", "div", "h4", "cite")), self.words(1, 2)) + self.r.choice((self.block("p", self.prose(1, 5)), self.prose(1, 4))) + self.r.choice(("", '<a href="#r">reply</a>')), "comment", "reply") for _ in range(self.r.randint(1, 8))]
        inside = "".join(each) if tag != "li" else self.block("ol", "".join(each), "comment-list")
        return self.block(self.r.choice(("section", "div", "div")), self.block(self.r.choice(("h2", "h3", "div")), self.words(1, 3)) + inside + (self.form() if self.r.random() < 0.4 else ""), "comments", "comment", "disqus", "discussion", "replies", "reader-comments")

    def footer(self) -> str:
        inside = self.r.choice(("&copy; ", "")) + self.r.choice((self.sentence(2, 8), self.link_list(2, 8), self.block("p", self.prose(1, 3)), self.words(1, 4) + " &middot; " + self.sentence(3, 8)))
        return self.block(self.named("footer"), inside, "footer", "bottom", "legal", "copyright")

    def share(self) -> str:
        return self.block("div", self.link_list(2, 5, 1), "share", "social", "sharing")

    def bare(self) -> str:
        """Paragraphs of plain text beside blocks, parted by line breaks; a block of its own up to the next tag of a block."""
        r = self.r
        gap = r.choice(("<br><br>", "<br>", "<br/>\n<br/>\n", "<br><br>\n"))
        parts = [r.choice(("", "", f"<b>{self.words(1, 5)}</b><br>")) + self.prose(1, 6) for _ in range(r.choice((1, 1, 2, 3, 5)))]
        return MARK + gap.join(parts) + r.choice(("", gap, "\n"))

    def piece(self) -> str:
        r, p = self.r, self.r.random()
        if p < 0.66:
            if self.style == "bare" and r.random() < 0.8:
                made = self.bare()
                return made if r.random() < 0.5 else self.block("div", made)
            return self.block("div" if self.style == "div" and r.random() < 0.8 else "p", self.prose(1, 8), main=True)
        if p < 0.76:
            return self.block(r.choice(("h2", "h3", "h4")), self.words(1, 8), main=True)
        if p < 0.82:
            return self.block(r.choice(("ul", "ol")), "".join(self.block("li", self.prose(1, 2), main=True) for _ in range(r.randint(2, 7))))
        if p < 0.85:
            return self.block("blockquote", self.block("p", self.prose(1, 3), main=True) if r.random() < 0.6 else MARK + self.prose(1, 3))
        if p < 0.88:
            return self.block("table", "".join(self.block("tr", "".join(self.block("td", self.words(1, 4), main=True) for _ in range(2))) for _ in range(r.randint(1, 4))))
        if p < 0.9:
            return self.block("dl", "".join(self.block("dt", self.words(1, 3), main=True) + self.block("dd", self.prose(1, 2), main=True) for _ in range(r.randint(1, 5))))
        if p < 0.92:
            return self.block("figure", '<img src="a.png" alt="">' + self.block("figcaption", self.sentence(3, 14), main=True))
        if p < 0.94:
            return self.block("pre", self.words(3, 20), main=True)
        if p < 0.97:
            return self.bare()
        return self.block("div", self.prose(1, 5), main=True)

    def article(self) -> str:
        r = self.r
        parts = [self.block(r.choice(("h1", "h1", "h2")), self.words(2, 12), main=True)] if r.random() < 0.85 else []
        if parts and r.random() < 0.15:
            parts = [self.block(self.named("header"), parts[0], "entry-header", "title")]
        if r.random() < 0.4:  # a short first paragraph, bold and unclosed at times
            parts.append(self.block("p", r.choice(("<b>", "", "")) + r.choice((self.sentence(1, 8), self.sentence(), self.words(1, 3))) + r.choice(("<br>", "", "")), main=True))
        for _ in range(r.choice((0, 1, 1, 2, 4, 8, 14, 25)) if parts else 2):
            if r.random() < 0.15:
                parts.append(self.block("p", r.choice((self.words(1, 3), self.sentence(1, 6))), main=True))
            parts.append(self.piece())
            if r.random() < 0.06:
                parts.append(r.choice((self.ad, self.share, self.form, self.notice, self.nav))())
        if r.random() < 0.2:
            parts.append(r.choice((self.share, self.form, self.ad))())
        if r.random() < 0.15:
            parts.append(self.comments())
        if r.random() < 0.2:  # a page that says next to nothing
            title = self.sentence(1, 6)
            parts = [self.block("h1", title, main=True), self.block("p", r.choice(("<b>", "")) + r.choice((title, self.sentence(1, 6))) + r.choice(("<br>", "")), main=True)]
            parts += [self.block("p", self.sentence(1, 12), main=True) for _ in range(r.choice((0, 0, 1, 2)))]
        inside = "".join(parts)
        if r.random() < 0.3:
            inside = self.block("div", inside, "content", "article-body", "entry", "text")
        return self.block(self.named(r.choice(("article", "main", "article", "section"))), inside, "article", "content", "post", "entry", "story", "main", "body")

    def layout(self, cells: list[str]) -> str:
        return self.block("table", self.block("tr", "".join(self.block("td", c, "content", "left", "right", "col") for c in cells)))

    def page(self) -> str:
        r = self.r
        chance = lambda p, make: make() if r.random() < p else ""
        if r.random() < 0.06:
            body = "".join(self.piece() for _ in range(r.randint(1, 12)))
        elif r.random() < 0.03:
            body = self.header() + self.link_list(4, 20) + self.footer()
        else:
            middle = [chance(0.25, self.sidebar), self.article(), chance(0.4, self.sidebar), chance(0.3, self.comments)]
            table = r.random() < 0.12  # columns as cells of a table
            if table:
                sides = [r.choice((self.sidebar, self.nav, lambda: self.link_list(4, 15, 4)))() for _ in range(r.choice((1, 1, 2)))]
                cells = [*sides[:1], middle[1] + middle[3], *sides[1:]]
                if r.random() < 0.3:
                    cells.reverse()
                middle = [self.layout(cells)]
            inside = chance(0.15, self.ad) + "".join(middle) + chance(0.15, self.ad)
            for _ in range(r.choice((0, 0, 1, 2))):
                inside = self.block(self.named(r.choice(("main", "section"))) if r.random() < 0.3 else "div", inside, "wrapper", "container", "page", "main", "content")
            top = [chance(0.5, self.header), chance(0.5, self.nav), chance(0.25, self.notice), chance(0.35, self.ad), chance(0.1, self.form)]
            r.shuffle(top)
            if table and r.random() < 0.4:
                inside = self.block("table", self.block("tr", self.block("td", "".join(top))) + self.block("tr", self.block("td", inside)) + self.block("tr", self.block("td", self.footer())))
                top = []
            body = "".join(top) + inside + chance(0.15, self.ad) + chance(0.15, self.form) + chance(0.85, self.footer) + chance(0.1, self.notice)
        if r.random() < 0.1:
            body = f"<noscript>{r.choice((self.sentence(), self.block('p', self.sentence())))}</noscript>" + body
        body = body.replace("<p", f"<!-- {self.words(1, 3)} --><p", 1) if r.random() < 0.3 else body
        head = f'<head><meta charset="utf-8"><title>{self.words(2, 6)}</title><style>p{{margin:0}}</style><script>var t="</p>";</script></head>'
        return f'<!DOCTYPE html><html lang="en">{head}<body>{body}' + ("" if r.random() < 0.15 else "</body></html>")


def labelled(seed: int) -> tuple[np.ndarray, np.ndarray]:
    page = Page(Maker(seed).page())
    x, parent, owner = features(page)
    y = np.zeros(len(parent))
    for node, (_, text, _) in zip(owner, page.blocks, strict=True):
        if text.startswith(MARK):
            y[node] = 1
    for k in range(len(parent) - 1, 0, -1):
        if y[k]:
            y[parent[k]] = 1
    return x, y


def fit(pages: int = PAGES, seed: int = SEED, trees: int = TREES, **how) -> Boosted:
    parts = [labelled(seed * 1_000_000 + k) for k in range(pages)]
    return train(np.vstack([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), trees, **how)


if __name__ == "__main__":
    MODEL.write_text(json.dumps(fit().to_dict(), separators=(",", ":")))
