"""Pages written by hand in layouts that the model's own maker of pages does not have; what is main text is written down beside each."""

import random

WORDS = ("harbour council weather bridge report engine garden winter market signal paper river doctor village measure answer street window morning company number machine letter "
         "border station question building teacher minister summer picture history corner problem kitchen island journey forest capital process").split()


class Writer:
    def __init__(self, seed):
        self.r = random.Random(seed)
        self.main = []

    def phrase(self, low, high):
        return " ".join(self.r.choices(WORDS, k=self.r.randint(low, high)))

    def text(self, sentences=None):
        r = self.r
        return " ".join(f"The {self.phrase(5, 16)}, {self.phrase(2, 9)}." for _ in range(sentences or r.randint(1, 5)))

    def keep(self, text):
        """A block of main text."""
        self.main.append(text)
        return text

    def links(self, n, sep="\n"):
        return sep.join(f'<a href="/{k}.html">{self.phrase(1, 3)}</a>' for k in range(n))


def old_table(w):
    """Everything in one layout table: a banner row, a column of links, text parted by line breaks, a line of copyright."""
    paragraphs = [w.text() for _ in range(w.r.randint(2, 6))]
    title = w.keep(w.phrase(2, 6))
    w.keep(" ".join(paragraphs))
    return f"""<html><body bgcolor=white><table width=100% border=0><tr><td colspan=2><font size=5>{w.phrase(1, 3)}</font></td></tr>
<tr><td width=150 valign=top>{w.links(w.r.randint(5, 12), "<br>")}</td><td valign=top><h2>{title}</h2>{"<br><br>".join(paragraphs)}</td></tr>
<tr><td colspan=2 align=center><small>Copyright 1999 {w.phrase(1, 3)}</small></td></tr></table></body></html>"""


def bare_breaks(w):
    """A div with a heading, bare paragraphs parted by line breaks, and a list."""
    head = w.keep(w.phrase(2, 6))
    paragraphs = [w.text(), w.text()]
    w.keep(" ".join(paragraphs))
    items = [w.keep(w.text(1)) for _ in range(w.r.randint(2, 5))]
    return f"""<html><body><div>{w.links(6, " | ")}</div><div><h2>{head}</h2>{"<br><br>".join(paragraphs)}<ul>{"".join(f"<li>{i}</li>" for i in items)}</ul></div><div>{w.phrase(2, 4)} {w.links(3, " - ")}</div></body></html>"""


def div_soup(w):
    """No element but div; hashed class names that tell nothing."""
    c = lambda: f' class="css-{w.r.getrandbits(24):x}"'
    nav = "".join(f"<div{c()}><a href=#>{w.phrase(1, 2)}</a></div>" for _ in range(w.r.randint(4, 9)))
    body = "".join(f"<div{c()}><span{c()}>{w.keep(w.text())}</span></div>" for _ in range(w.r.randint(3, 9)))
    more = "".join(f"<div{c()}><a href=/{k}><span>{w.phrase(4, 9)}</span></a></div>" for k in range(w.r.randint(3, 7)))
    title = w.phrase(3, 8)
    w.main.insert(0, title)
    return f"<!doctype html><html><head><title>x</title></head><body><div id=root><div{c()}>{nav}</div><div{c()}><div{c()}>{title}</div>{body}</div><div{c()}>{more}</div><div{c()}><span>2021 {w.phrase(1, 3)}</span> {w.links(4)}</div></div></body></html>"


def manual(w):
    """A software manual: a tree of contents, sections, code, definitions, links to the next page."""
    toc = "".join(f'<li><a href="#s{k}">{w.phrase(1, 4)}</a><ul><li><a href="#t{k}">{w.phrase(1, 4)}</a></li></ul></li>' for k in range(w.r.randint(4, 9)))
    parts = [f"<h1>{w.keep(w.phrase(2, 5))}</h1>"]
    for _ in range(w.r.randint(2, 5)):
        parts.append(f"<h2>{w.keep(w.phrase(2, 5))}</h2><p>{w.keep(w.text())}</p>")
        parts.append(w.r.choice(("", f"<pre>{w.keep(w.phrase(4, 12))}</pre>")))
    parts.append("<dl>" + "".join(f"<dt>{w.keep(w.phrase(1, 2))}</dt><dd>{w.keep(w.text(1))}</dd>" for _ in range(3)) + "</dl>")
    return f'<html><body><div class="toctree"><ul>{toc}</ul></div><div class="document">{"".join(parts)}</div><div class="prevnext"><a href=p>Previous</a> <a href=n>Next</a></div><div>Built with {w.phrase(1, 2)}</div></body></html>'


def newspaper(w):
    """Rows and columns with an advert and a box of links in the middle of the text, and letters of readers."""
    parts = [f"<p>{w.keep(w.text())}</p>" for _ in range(3)]
    parts.append(f'<div class="promo-box"><h4>More like this</h4>{w.links(4)}</div>')
    parts += [f"<p>{w.keep(w.text())}</p>" for _ in range(w.r.randint(2, 6))]
    parts.append(f'<div class="adslot"><span>Advertisement</span><p>Buy {w.phrase(3, 8)} today!</p></div>')
    parts += [f"<p>{w.keep(w.text())}</p>"]
    head = w.phrase(4, 9)
    w.main.insert(0, head)
    letters = "".join(f'<div class="user-comment"><b>{w.phrase(1, 1)}</b><p>{w.text(2)}</p><a href=#>Reply</a></div>' for _ in range(w.r.randint(1, 5)))
    return f"""<html><body><div class="row top-nav">{w.links(8)}</div><div class="container"><div class="row"><div class="col-8"><h1>{head}</h1>{"".join(parts)}<div class="comments-area"><h3>{w.r.randint(1, 90)} Comments</h3>{letters}</div></div>
<div class="col-4"><div class="box"><h4>Most read</h4><ol>{"".join(f"<li><a href=/{k}>{w.phrase(4, 9)}</a></li>" for k in range(5))}</ol></div></div></div></div><div class="row site-footer"><p>{w.phrase(3, 9)}</p>{w.links(5)}</div></body></html>"""


def plain_essay(w):
    """A heading and unclosed paragraphs, nothing else but a link home."""
    head = w.keep(w.phrase(2, 6))
    body = "\n".join(f"<P>{w.keep(w.text())}" for _ in range(w.r.randint(3, 12)))
    return f"<HTML><BODY><H1>{head}</H1>\n{body}\n<HR><A HREF=index.html>Home</A></BODY></HTML>"


def weblog(w):
    """Text in a section of its own kind of tags, share buttons, an author's box, tags, a form for letters by mail."""
    head = w.keep(w.phrase(3, 8))
    body = "".join(w.r.choice((lambda: f"<p>{w.keep(w.text())}</p>", lambda: f"<h3>{w.keep(w.phrase(2, 5))}</h3><p>{w.keep(w.text())}</p>", lambda: f"<blockquote><p>{w.keep(w.text(2))}</p></blockquote>"))() for _ in range(w.r.randint(3, 9)))
    return f"""<html><body><header class="blog-top"><a href=/>{w.phrase(1, 2)}</a><nav>{w.links(5)}</nav></header><div class="layout"><div class="post-full"><h1>{head}</h1><section class="post-body">{body}</section>
<div class="sharing-buttons">{w.links(3)}</div></div><div class="subscribe-card"><h3>{w.phrase(2, 5)}</h3><p>{w.phrase(5, 12)}</p><form><input name=e><button>Go</button></form></div></div><footer>{w.phrase(2, 5)} {w.links(3)}</footer></body></html>"""


def cookie_wall(w):
    """A notice before everything, then two columns of which the second holds the text."""
    head = w.phrase(3, 8)
    body = "".join(f"<p>{w.keep(w.text())}</p>" for _ in range(w.r.randint(2, 8)))
    w.main.insert(0, head)
    return f"""<html><body><div id="cookie-bar"><p>We use cookies to {w.phrase(4, 10)}.</p><button>Accept</button></div><div id="left"><ul>{"".join(f"<li><a href=/{k}>{w.phrase(1, 3)}</a>" for k in range(9))}</ul></div><div id="right"><h1>{head}</h1>{body}</div><div id="end">{w.phrase(2, 6)}</div></body></html>"""


LAYOUTS = (old_table, bare_breaks, div_soup, manual, newspaper, plain_essay, weblog, cookie_wall)


def pages(each, seed=5):
    """(layout, html, blocks of main text)"""
    for layout in LAYOUTS:
        for k in range(each):
            w = Writer(f"{seed}-{layout.__name__}-{k}")
            source = layout(w)
            yield layout.__name__, source, w.main


def measure(text_of, each=30, seed=5):
    """layout: (recall, precision) by characters of whole blocks."""
    sums = {}
    for name, source, main in pages(each, seed):
        got = [t for t in text_of(source).split("\n") if t]
        left = list(main)
        hit = 0
        for t in got:
            if t in left:
                left.remove(t)
                hit += len(t)
        a = sums.setdefault(name, [0, 0, 0])
        for i, n in enumerate((hit, sum(map(len, main)), sum(map(len, got)))):
            a[i] += n
    return {name: (h / max(1, m), h / max(1, g)) for name, (h, m, g) in sums.items()}
