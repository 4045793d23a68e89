"""Generated pages with known main text, to train the page model on.

Each page is drawn from a seeded grammar: the article (in a semantic element, in
a named container, or in a bare one) among menus, headers, footers, sidebars,
notices, adverts, forms and reader comments, in varied order and markup. Every
element says whether it is or holds main text.
"""

from __future__ import annotations

import random

LETTERS = "eeeeaaaiioounnrrttsslldhcmpgbvfk"


class Maker:
    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def words(self, n: int) -> str:
        r = self.r
        return " ".join("".join(r.choice(LETTERS) for _ in range(r.randint(2, 9))) for _ in range(n))

    def sentence(self) -> str:
        w = self.words(self.r.randint(2, 18)).capitalize()
        return w.replace(" ", ", ", 1) + "." if self.r.random() < 0.3 else w + "."

    def text(self, least: int, most: int) -> str:
        return " ".join(self.sentence() for _ in range(self.r.randint(least, most)))

    def attr(self, words: str, bare: float = 0.1) -> str:
        """A class or id with one of the words, in one of several spellings, or nothing."""
        if self.r.random() < bare:
            return ""
        w = self.r.choice(words.split())
        w = self.r.choice([w, w, f"{w}-box", f"site-{w}", f"{w}_{self.r.randint(1, 9)}", f"x {w}", f"page-{w}"])
        return f' {self.r.choice(["class", "class", "id"])}="{w}"'

    def pick(self, *options):
        return self.r.choice(options)

    # parts that are not main text
    def links(self, n: int) -> str:
        return "".join(f'<li><a href="/{self.words(1)}">{self.words(self.r.randint(1, 4))}</a></li>' for _ in range(n))

    def nav(self) -> str:
        items = self.links(self.r.randint(3, 12))
        return self.pick(f"<nav><ul>{items}</ul></nav>", f"<nav{self.attr('menu main')}><ul>{items}</ul></nav>",
                         f"<div{self.attr('nav menu navbar breadcrumb')}><ul>{items}</ul></div>")

    def header(self) -> str:
        inner = self.pick(f"<a href='/'>{self.words(2)}</a>", f"<h1>{self.words(2)}</h1><p>{self.words(5)}</p>",
                          f"<div{self.attr('logo brand')}>{self.words(2)}</div>")
        return self.pick(f"<header>{inner}</header>", f"<div{self.attr('header masthead topbar')}>{inner}</div>",
                         f"<header>{inner}{self.nav()}</header>")

    def footer(self) -> str:
        inner = self.pick(f"&copy; {self.words(1)} &middot; {self.text(1, 4)}", f"<p>&copy; {self.text(1, 3)}</p>",
                          f"<ul>{self.links(4)}</ul><p>{self.text(1, 1)}</p>")
        return self.pick(f"<footer>{inner}</footer>", f"<div{self.attr('footer copyright legal', 0)}>{inner}</div>")

    def side(self) -> str:
        inner = self.pick(f"<h3>{self.words(2)}</h3><ul>{self.links(6)}</ul>",
                          f"<h3>{self.words(2)}</h3><p>{self.text(1, 3)}</p>", f"<p>{self.text(1, 4)}</p>")
        return self.pick(f"<aside>{inner}</aside>", f"<div{self.attr('sidebar related widget popular', 0)}>{inner}</div>")

    def advert(self) -> str:
        inner = self.pick(self.text(1, 3), f"<p>{self.text(1, 2)}</p>", f"<a href='/x'>{self.words(5)}</a>")
        return f"<div{self.attr('ad ads advert sponsored promo', 0)}>{inner}</div>"

    def notice(self) -> str:
        inner = self.pick(self.text(1, 2), f"<p>{self.text(1, 3)}</p><button>{self.words(1)}</button>")
        return f"<{(t := self.pick('div', 'section', 'p'))}{self.attr('cookie notice consent alert popup', 0)}>{inner}</{t}>"

    def form(self) -> str:
        inner = f"<label>{self.words(2)}</label><input name='q'><p>{self.text(1, 1)}</p><button>{self.words(1)}</button>"
        form = f"<form>{inner}</form>"
        return self.pick(form, f"<div{self.attr('newsletter subscribe search login', 0)}><p>{self.text(1, 2)}</p>{form}</div>")

    def comments(self) -> str:
        each = self.pick("<li><b>{w}</b><p>{t}</p></li>", "<div class='comment'><p>{t}</p></div>",
                         "<article class='comment'><h4>{w}</h4><p>{t}</p></article>", "<p>{t}</p>")
        inner = "".join(each.format(w=self.words(2), t=self.text(1, 5)) for _ in range(self.r.randint(1, 8)))
        inner = f"<ul>{inner}</ul>" if each.startswith("<li") else inner
        head = self.pick("", f"<h3>{self.words(2)}</h3>")
        return f"<{(t := self.pick('div', 'section'))}{self.attr('comments comment replies respond', 0)}>{head}{inner}</{t}>"

    def share(self) -> str:
        return f"<div{self.attr('share social follow', 0)}><ul>{self.links(3)}</ul></div>"

    # main text; * marks an element that is or holds it
    def block(self) -> str:
        k = self.r.random()
        end = self.pick("</p>", "</p>", "")
        if k < 0.62:
            body = self.text(1, 9)
            if self.r.random() < 0.3:
                at = body.find(" ")
                body = f"<{(t := self.pick('a', 'b', 'em', 'span'))}>{body[:at]}</{t}>{body[at:]}"
            return self.pick(f"<p*>{body}{end}", f"<p*>{body}{end}", f"<p*><b>{body}<br>")
        if k < 0.74:
            return f"<{(t := self.pick('h2', 'h3'))}*>{self.words(self.r.randint(1, 6))}</{t}>"
        if k < 0.84:
            items = "".join(f"<li*>{self.text(1, 2)}</li>" for _ in range(self.r.randint(2, 6)))
            return f"<{(t := self.pick('ul', 'ol'))}*>{items}</{t}>"
        if k < 0.89:
            return f"<blockquote*><p*>{self.text(1, 3)}</p></blockquote>"
        if k < 0.93:
            rows = "".join(f"<tr*><td*>{self.words(2)}</td><td*>{self.words(3)}</td></tr>" for _ in range(3))
            return f"<table*>{rows}</table>"
        if k < 0.96:
            return f"<figure*><img src='/i'><figcaption*>{self.text(1, 1)}</figcaption></figure>"
        return f"<{(t := self.pick('div', 'section'))}*>{self.text(1, 4)}</{t}>"

    def article(self) -> str:
        n = self.pick(0, 0, 0, 1, 1, 2, 3, 5, 8, 14, 20)
        parts = [self.block() for _ in range(n)]
        for extra, chance in ((self.advert, 0.25), (self.share, 0.15), (self.form, 0.08), (self.side, 0.1), (self.notice, 0.05)):
            if self.r.random() < chance:
                parts.insert(self.r.randint(0, len(parts)), extra())
        title = f"<h1*>{self.words(self.r.randint(2, 9))}</h1>"
        title = self.pick(title, title, f"<header*>{title}</header>", "" if n else title)
        inner = title + "".join(parts)
        t = self.pick("article", "article", "main", "div", "section")
        named = self.attr("content post entry story article text main", 0.4 if t in ("article", "main") else 0.25)
        out = f"<{t}{named}*>{inner}</{t}>"
        for _ in range(self.pick(0, 0, 0, 1, 2)):
            out = f"<{(t := self.pick('div', 'main', 'section'))}{self.attr('wrapper container content page', 0.4)}*>{out}</{t}>"
        return out

    def page(self) -> str:
        some = lambda make, chance: [make() for _ in range(3) if self.r.random() < chance]
        before = some(self.header, 0.25) + some(self.nav, 0.3) + some(self.notice, 0.15) + some(self.advert, 0.3)
        after = some(self.side, 0.25) + some(self.comments, 0.2) + some(self.advert, 0.15) + some(self.form, 0.15) \
            + some(self.share, 0.1) + some(self.notice, 0.08)
        if self.r.random() < 0.3:
            self.r.shuffle(before)
        self.r.shuffle(after)
        middle = [self.article()]
        if self.r.random() < 0.2 and after:
            middle.insert(0, after.pop())
        inner = "".join(before + middle + after) + "".join(some(self.footer, 0.4)[:1])
        if self.r.random() < 0.25:
            inner = f"<div{self.attr('wrapper container page', 0.5)}*>{inner}</div>"
        return f"<!DOCTYPE html><html><head><title>t</title><script>x()</script></head><body>{inner}</body></html>"


def labelled_pages(n: int, seed: int = 7) -> list[str]:
    """n pages in which a start tag that ends in ``*>`` is or holds main text."""
    maker = Maker(seed)
    return [maker.page() for _ in range(n)]
