"""Made-up web pages whose article is known, to train the extraction model.

Pages vary in layout (one column, bare divisions, tables), in mark-up (semantic elements, telling or
meaningless classes and ids, none at all), in what surrounds the article and in what is set into it; a
few have no article. Everything follows from the seed.
"""

from __future__ import annotations

import random
import re

_LETTERS = "aeiouéönrstlmdkghpbcfvw"


class _Page:
    def __init__(self, r: random.Random) -> None:
        self.r = r
        #: How boxes are marked: by telling names, by meaningless ones, or not at all.
        self.marks = r.choices(("named", "hashed", "bare"), (12, 2, 3))[0]

    def words(self, least: int, most: int) -> str:
        r = self.r
        said = ["".join(r.choices(_LETTERS, k=r.randint(2, 9))) for _ in range(r.randint(least, most))]
        return " ".join(w + r.choices(("", ",", ".", "!", " &amp;"), (30, 2, 3, 0.4, 0.3))[0] for w in said).capitalize()

    def links(self, n: int) -> str:
        item = self.r.choice(("<li><a href='/{0}'>{1}</a></li>", "<a href='/{0}'>{1}</a> ", "<li><a href='{0}'>{1}</a>"))
        inner = "".join(item.format(k, self.words(1, 3)) for k in range(n))
        return f"<ul>{inner}</ul>" if item.startswith("<li") else inner

    def box(self, tags: str, names: str, inner: str) -> str:
        """inner in one of the elements, mostly with one of the class names (a bare tag if semantic)."""
        tag = self.r.choice(tags.split())
        if tag == "p" and re.search("<(p|div|ul|form|h[1-6])\\b", inner):
            tag = "div"  # a paragraph cannot hold blocks
        if tag in ("nav", "aside", "header", "footer", "form") and self.r.random() < 0.6:
            return f"<{tag}>{inner}</{tag}>"
        if self.marks == "bare":
            tag = "div" if tag in ("nav", "aside", "section", "header", "footer") else tag
            return f"<{tag}>{inner}</{tag}>"
        name = self.r.choice(names.split())
        if self.marks == "hashed":
            name = f"{self.r.choice(('css', 'sc', 'x', 'jss'))}-{''.join(self.r.choices('abcdefgh0123456789', k=6))}"
        how = self.r.choice(("class", "class", "id"))
        return f'<{tag} {how}="{name}">{inner}</{tag}>'

    def menu(self) -> str:
        return self.box("nav nav div ul", "nav menu main-nav navbar site-nav breadcrumb topMenu", self.links(self.r.randint(3, 12)))

    def notice(self) -> str:
        return self.box("div section p", "cookie-notice notice alert consent gdpr-banner popup message overlay", f"<p>{self.words(6, 40)}</p><button>{self.words(1, 2)}</button>")

    def advert(self) -> str:
        inner = self.words(3, 40)
        return self.box("div div aside section p", "ad ads advert ad-slot sponsored promo banner-ad adsense", self.r.choice((inner, f"<p>{inner}</p>", f"<a href='#'>{inner}</a>")))

    def form(self) -> str:
        inner = f"<label>{self.words(1, 4)}</label><input name=q><p>{self.words(3, 20)}</p><input type=submit>"
        return f"<form>{inner}</form>" if self.r.random() < 0.6 else self.box("form div", "newsletter subscribe-form search signup login contact-form", inner)

    def sidebar(self) -> str:
        inner = "".join(self.r.choice((f"<h3>{self.words(1, 3)}</h3>{self.links(5)}", f"<p>{self.words(5, 50)}</p>", f"<div>{self.words(4, 30)}</div>")) for _ in range(self.r.randint(1, 4)))
        return self.box("aside aside div", "sidebar side widget rail secondary right-sidebar", inner)

    def comments(self) -> str:
        made = []
        for _ in range(self.r.randint(1, 6)):
            text = self.words(3, 70)
            made.append(self.r.choice((f'<div class="comment"><b>{self.words(1, 2)}</b><p>{text}</p></div>', f"<li><p>{text}</p></li>", f'<article class="comment"><p>{text}</p></article>', f"<p>{text}</p>")))
        return self.box("section div div ol", "comments comment-list discussion replies responses reader-comments", self.r.choice((f"<h3>{self.words(1, 3)}</h3>", "")) + "".join(made))

    def related(self) -> str:
        return self.box("div section ul", "related recommended share social-share more-stories tags trending", f"<h4>{self.words(1, 3)}</h4>{self.links(self.r.randint(2, 6))}")

    def header(self) -> str:
        inner = f"<a href='/'>{self.words(1, 3)}</a>" + self.r.choice(("", f"<p>{self.words(2, 12)}</p>", self.menu(), f"<h1>{self.words(1, 3)}</h1>"))
        return self.box("header header div", "header masthead site-header top-bar banner", inner)

    def footer(self) -> str:
        inner = self.r.choice(("", self.links(4))) + f"&copy; {self.words(2, 5)} &middot; {self.words(3, 25)}" + self.r.choice(("", f"<p>{self.words(3, 20)}</p>"))
        return self.box("footer footer div", "footer site-footer copyright page-bottom", inner)

    def part(self) -> str:
        r = self.r
        text = self.words(*r.choice(((1, 2), (1, 4), (2, 12), (4, 40), (4, 40), (10, 120))))
        if r.random() < 0.1:  # prose without punctuation, or of few different words
            text = " ".join(r.choices(self.words(1, 6).replace(",", "").replace(".", "").split(), k=r.choice((5, 60, 600))))
        inline = r.choice(("{}", "{}", "{}", "<b>{}", "<b>{}</b>", "<em>{}</em> ", "<span>{}</span>", "<a href='/x'>{}</a>"))
        if inline.startswith("<a"):
            text = f"{self.words(3, 30)} {inline.format(self.words(1, 3))} {text}"
        else:
            text = inline.format(text)
        made = f"<p>{text}" + r.choice(("</p>", "</p>", "</p>", "", "<br>"))
        kind = r.random()
        if kind < 0.06:
            made = f"<h2>{self.words(1, 8)}</h2>"
        elif kind < 0.10:
            made = "<ul>" + "".join(f"<li>{self.words(2, 20)}</li>" for _ in range(r.randint(2, 6))) + "</ul>"
        elif kind < 0.13:
            made = f"<blockquote><p>{text}</p></blockquote>"
        elif kind < 0.15:
            made = f"<pre>{self.words(3, 30)}</pre>"
        elif kind < 0.17:
            made = "<table>" + "".join(f"<tr><td>{self.words(1, 4)}</td><td>{self.words(1, 4)}</td></tr>" for _ in range(3)) + "</table>"
        elif kind < 0.19:
            made = f"<figure><img src=x><figcaption>{self.words(3, 12)}</figcaption></figure>"
        elif kind < 0.24:
            made = f"<div>{text}</div>"
        return made


    def body(self, n: int) -> list[str]:
        """The parts of an article, in one of three ways of setting paragraphs."""
        r = self.r
        way = r.choices(("mixed", "breaks", "boxes"), (10, 1, 1))[0]
        if way == "breaks":  # text straight in the container
            return [self.words(10, 80) + r.choice(("<br><br>", "<br>", "<br/><br/>")) for _ in range(n)]
        if way == "boxes":
            return [f"<div>{self.words(4, 80)}</div>" for _ in range(n)]
        return [self.part() for _ in range(n)]


def page(seed: int) -> tuple[str, str, str]:
    """(before, article, after) of a page; in the article, set-in parts stand between the marks \\x01 and \\x02.

    A page without article has an empty one.
    """
    p = _Page(random.Random(seed))
    r = p.r
    before = "<!DOCTYPE html><html><head><meta charset=utf-8><title>" + p.words(2, 8) + "</title><style>p{}</style><script>var t='</p>';</script></head><body>"
    named = p.marks == "named"
    # without names, only what its text and links tell apart can be told apart
    above = [f() for f in ((p.header, p.menu, p.notice, p.advert, p.form) if named else (p.header, p.menu, p.form)) if r.random() < 0.5]
    r.shuffle(above)
    below = [f() for f in ((p.sidebar, p.comments, p.related, p.form, p.advert, p.notice, p.menu) if named else (p.related, p.form, p.menu)) if r.random() < 0.4]
    r.shuffle(below)
    if r.random() < 0.8:
        below.append(p.footer())
    if named and r.random() < 0.25:
        above.append(p.sidebar())
    if r.random() < 0.03:
        return before, "", "".join([*above, *below, p.menu()]) + "</body></html>"
    parts = p.body(r.choice((1, 2, 3, 5, 8, 14)))
    if r.random() < 0.75:
        parts.insert(0, r.choice(("<h1>{}</h1>", "<header><h1>{}</h1></header>", "<h1>{}</h1>", "<h2>{}</h2>")).format(p.words(2, 10)))
    for f in (p.advert, p.related, p.form, p.notice, p.comments, p.sidebar) if named else (p.related,):
        if r.random() < 0.2:
            parts.insert(r.randint(0, len(parts)), f"\x01{f()}\x02")
    inner = "".join(parts)
    if r.random() < 0.15:
        inner = f"<div class='text'>{inner}</div>" if named else f"<div>{inner}</div>"
    if r.random() < 0.12:  # a table that holds the page
        side = [f"<td>{p.links(r.randint(3, 10))}</td>", f"<td>{p.related()}</td>", ""]
        left, right = r.choice(side), r.choice(side)
        top = f"<tr><td{r.choice(('', ' colspan=2', ' colspan=3'))}>{p.header()}</td></tr>" if r.random() < 0.6 else ""
        cell = r.choice(("<td>", "<td valign=top width=70%>", "<td class=main>"))
        end = f"<tr><td>{below.pop()}</td></tr>" if below and r.random() < 0.5 else ""
        return before + "".join(above) + f"<table width=100%>{top}<tr>{left}", f"{cell}{inner}</td>", f"{right}</tr>{end}</table>" + "".join(below) + "</body></html>"
    boxes = ("<article>", "<article>", '<article class="post">', "<main>", '<div class="content">', '<div class="post-content">', '<div id="article-body">', '<section class="story">', '<div class="entry">', "<div>", "<div>")
    box = r.choice(boxes if named else ("<article>", "<main>", "<div>", "<div>", "<section>", '<div class="x-7f3a2b">'))
    article = f"{box}{inner}</{box[1:].split()[0].rstrip('>')}>"
    if r.random() < 0.06 and not inner.startswith(("\x01", "<div")) and "<br" not in inner:
        article = inner  # straight in what is around it
    outer = r.choice(("", "", "<main>", "<div>", '<div id="wrapper">', '<div class="container">'))
    close = f"</{outer[1:].split()[0].rstrip('>')}>" if outer else ""
    return before + "".join(above) + outer, article, "".join(below) + close + r.choice(("</body></html>", ""))
