"""Invented web pages with known main text, to train the page classifier: no page of any table is used."""

from __future__ import annotations

import random

_SYLLABLES = "an ar be chi da el en for ga his in ka lo mar ne on per qui ra so ter un ver wa zu é ö".split()
_CONTENT_NAMES = ["content", "post", "entry-content", "article-body", "story", "main-text", "post-content", "text", "body-copy", "page-content", "blog-post", "news-item"]
_PLAIN_NAMES = ["wrap", "container", "row", "col-8", "inner", "box", "grid", "layout", "section1", "block"]
_JUNK = {
    "nav": ["nav", "menu", "navbar", "main-menu", "breadcrumb", "breadcrumbs", "topnav", "pagination"],
    "header": ["header", "masthead", "site-header", "top-bar", "branding", "banner"],
    "footer": ["footer", "site-footer", "bottom", "copyright", "colophon", "legal"],
    "side": ["sidebar", "side", "widget", "related", "recommended", "popular-posts", "tags", "rail", "more-stories"],
    "ad": ["ad", "ads", "advert", "ad-box", "sponsored", "promo", "banner-ad", "advertisement"],
    "notice": ["cookie", "cookie-notice", "notice", "consent", "popup", "modal", "alert", "gdpr", "newsletter"],
    "comments": ["comments", "comment-list", "comment", "replies", "respond", "discussion", "reader-comments"],
    "share": ["share", "social", "share-buttons", "follow-us"],
    "form": ["form", "search-form", "signup", "login", "subscribe", "contact-form"],
}


#: Words in names that tell nothing, or mislead, of parts of a page and of main text.
_MISLEADING = {
    "junk": ["content", "text", "body", "inner", "post", "entry", "page"],
    "main": ["news-comment-piece", "news-comment-text", "comment-article", "comment-piece", "header-story", "footer-story", "side-story", "promo-article", "share-text", "related-article", "reader-story", "top-news", "review-article", "recent-post"],
}


class Page:
    """One page: html, and the texts of its main blocks in order."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.blocks: list[str] = []
        self.tidy = self.r.random() < 0.6
        self.html = self.page()

    def word(self) -> str:
        return "".join(self.r.choice(_SYLLABLES) for _ in range(self.r.randint(1, 3)))

    def words(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(low, high)))

    def prose(self, n: int) -> str:
        style = self.style
        mark = {"plain": "", "marks": " &amp;&amp;&amp;", "loud": "!!"}[style]
        out = " ".join(self.words(3, 14).capitalize() + mark + self.r.choice([".", ".", ".", "!", "?"]) for _ in range(n))
        return out.upper() if style == "loud" else out

    def name(self, kind: str) -> str:
        n = self.r.choice(_JUNK.get(kind, ["box"]))
        if self.r.random() < 0.15:
            n += f"-{self.r.choice(_MISLEADING['junk'])}"
        return self.r.choice([f' class="{n}"', f' id="{n}"', f' class="{self.word()} {n}"', f" class='{n} {self.word()}'"])

    def keep(self, text: str) -> str:
        self.blocks.append(text)
        return text

    def inline(self, text: str) -> str:
        words = text.split(" ")
        for _ in range(self.r.choice([0, 0, 1, 2])):
            i = self.r.randrange(len(words))
            tag = self.r.choice(["b", "em", "a href='/x'", "span", "strong", "i"])
            words[i] = f"<{tag}>{words[i]}</{tag.split()[0]}>"
        return " ".join(words)

    def para(self) -> str:
        text = self.inline(self.keep(self.prose(self.r.choice([1, 1, 2, 3, 5, 8])) if self.r.random() < 0.9 else self.words(1, 4).capitalize() + "."))
        if self.tidy or self.r.random() < 0.7:
            return f"<p>{text}</p>"
        return self.r.choice([f"<p>{text}", f"<p><b>{text}<br>", f"<div>{text}</div>", f"<p>{text}<br/></p>"])

    def links(self, low: int = 2, high: int = 8) -> str:
        close = "</li>" if self.tidy or self.r.random() < 0.5 else ""
        item = lambda: self.words(1, self.r.choice([1, 2, 2, 6])) + self.r.choice(["", "", "", "", ",", ".", "!", ". " + self.word().capitalize() + "."])
        return "<ul>" + "".join(f'<li><a href="/{self.word()}">{item()}</a>{close}' for _ in range(self.r.randint(low, high))) + "</ul>"

    def junk(self, kind: str) -> str:
        r, named = self.r, self.r.random() < 0.9
        a = self.name(kind) if named else ""
        if kind == "nav":
            return r.choice([f"<nav{r.choice([a, ''])}>{self.links()}</nav>", f"<div{self.name('nav')}>{self.links()}</div>", f"<div{self.name('nav')}>" + " | ".join(f'<a href="/">{self.word()}</a>' for _ in range(5)) + "</div>"])
        if kind == "header":
            return f"<header{a}><div>{self.words(1, 4)}</div>{r.choice(['', self.links(), f'<h1>{self.words(1, 3)}</h1>', f'<p>{self.words(3, 8)}</p>'])}</header>" if r.random() < 0.6 else f"<div{self.name('header')}>{self.words(1, 6)}{self.links()}</div>"
        if kind == "footer":
            text = r.choice([f"&copy; {self.word()}.example &middot; {self.prose(1)}", self.words(3, 9), f"<p>{self.prose(r.randint(1, 3))}</p>{self.links()}", f"<ul><li>{self.words(1, 4)}</ul>"])
            return f"<footer{r.choice([a, ''])}>{text}</footer>" if r.random() < 0.7 else f"<div{self.name('footer')}>{text}</div>"
        if kind == "side":
            text = f"<h3>{self.words(1, 3)}</h3>" + r.choice([self.links(), f"<p>{self.prose(r.randint(1, 4))}</p>", f"<p>{self.prose(2)}</p>{self.links()}"])
            return f"<aside{r.choice([a, ''])}>{text}</aside>" if r.random() < 0.6 else f"<div{self.name('side')}>{text}</div>"
        if kind == "ad":
            return f"<{(t := r.choice(['div', 'div', 'section', 'p']))}{self.name('ad')}>{r.choice([self.prose(1), self.prose(3), self.words(2, 8)])}</{t}>"
        if kind == "notice":
            return f"<div{self.name('notice')}>{r.choice(['<p>', ''])}{self.prose(r.randint(1, 3))} <button>{self.word()}</button></div>"
        if kind == "comments":
            body = "".join(f"<{(t := r.choice(['div', 'li', 'article']))} class='{r.choice(['comment', 'reply', 'comment-body'])}'>{r.choice(['', f'<b>{self.word()}</b> ', f'<h4>{self.word()}</h4>'])}<p>{self.prose(r.randint(1, 4))}</p></{t}>" for _ in range(r.randint(1, 5)))
            return f"<{(t := r.choice(['section', 'div', 'ol']))}{self.name('comments')}>{r.choice(['', f'<h2>{self.words(1, 2)}</h2>'])}{body}</{t}>"
        if kind == "hidden":
            how = r.choice(["hidden", 'style="display:none"', 'aria-hidden="true"', "style='visibility: hidden'"])
            return f"<div {how}><p>{self.prose(r.randint(1, 3))}</p></div>"
        if kind == "share":
            return f"<div{self.name('share')}>" + " ".join(f'<a href="#">{self.word()}</a>' for _ in range(r.randint(2, 5))) + "</div>"
        fields = "".join(f"<label>{self.word()}</label><input name={self.word()}>" for _ in range(r.randint(1, 3)))
        return f"<form{a}>{r.choice(['', f'<p>{self.prose(1)}</p>'])}{fields}<button>{self.word()}</button></form>"

    def special(self) -> str:
        """Tables, figures, definitions and preformatted text inside the main text."""
        r = self.r
        kind = r.random()
        if kind < 0.35:
            rows = "".join("<tr>" + "".join(f"<td>{self.keep(self.words(1, 4))}</td>" for _ in range(r.randint(1, 3))) + "</tr>" for _ in range(r.randint(1, 4)))
            return f"<table>{rows}</table>"
        if kind < 0.6:
            return f"<figure><img src=/x.png><figcaption>{self.keep(self.words(3, 12))}</figcaption></figure>"
        if kind < 0.8:
            return f"<pre>{self.keep(self.words(2, 20))}</pre>"
        return "<dl>" + "".join(f"<dt>{self.keep(self.words(1, 3))}</dt><dd>{self.keep(self.prose(1))}</dd>" for _ in range(r.randint(1, 3))) + "</dl>"

    def items(self) -> str:
        """A list of the main text; its items may be links, or begin with one."""
        r = self.r
        how = r.random()
        item = lambda: self.keep(self.prose(1))
        if how > 0.8:
            item = lambda: f"<a href='/{self.word()}'>{self.keep(self.words(3, 12).capitalize())}</a>"
        elif how > 0.6:
            item = lambda: (lambda a, b: self.keep(f"{a} {b}") and f"<a href=/x>{a}</a> {b}")(self.words(1, 3), self.prose(1))
        tag = r.choice(["ul", "ul", "ol"])
        return f"<{tag}>" + "".join(f"<li>{item()}</li>" for _ in range(r.randint(2, 7))) + f"</{tag}>"

    def main(self) -> str:
        r = self.r
        self.style = r.choice(["plain"] * 6 + ["marks", "loud"])
        parts = []
        if r.random() < 0.85:
            parts.append(f"<h1>{self.keep(self.words(2, 12).capitalize())}</h1>")
        for _ in range(r.choice([1, 2, 3, 5, 8, 12])):
            kind = r.random()
            if kind < 0.75:
                parts.append(self.para())
            elif kind < 0.82:
                parts.append(f"<h2>{self.keep(self.words(1, 6).capitalize())}</h2>" + self.para())
            elif kind < 0.88:
                parts.append(self.items())
            elif kind < 0.90:
                parts.append(f"<blockquote><p>{self.keep(self.prose(2))}</p></blockquote>")
            elif kind < 0.94:
                parts.append(self.special())
            else:
                parts.append(self.junk(r.choice(["ad", "ad", "share", "side", "form", "notice", "hidden", "footer", "nav"])))
        if r.random() < 0.15:
            parts.append(self.junk(r.choice(["share", "comments", "ad", "footer"])))
        text = "".join(parts)
        n = r.choice(_CONTENT_NAMES if r.random() < 0.75 else _MISLEADING["main"])
        name = r.choice([f' class="{n}"', f' id="{n}"', ""])
        kind = r.random()
        if kind < 0.15:
            return r.choice([text, text, f"<div>{text}</div>"])
        if kind < 0.5:
            return f"<article{r.choice(['', name])}>{text}</article>"
        if kind < 0.7:
            return f"<main>{r.choice(['', '<article>'])}{text}</main>" if r.random() < 0.5 else f'<div role="main">{text}</div>'
        if kind < 0.95:
            return f"<{(t := r.choice(['div', 'div', 'section']))}{name or ' class=content'}>{text}</{t}>"
        return f"<table><tr><td>{text}</td></tr></table>"

    def page(self) -> str:
        r = self.r
        self.style = "plain"
        before = [self.junk(k) for k in r.sample(["header", "nav", "nav", "ad", "notice", "side", "hidden"], r.randint(0, 4))]
        after = [f"<div>{j}</div>" if r.random() < 0.1 else j for j in (self.junk(k) for k in r.sample(["footer", "footer", "side", "comments", "notice", "ad", "form", "share"], r.randint(0, 5)))]
        main = self.main()
        self.style = "plain"
        if r.random() < 0.3:
            around = r.choice(_PLAIN_NAMES)
            main = f'<div class="{around}">{main}</div>' if r.random() < 0.5 else f'<div id="{around}">{main}{after.pop() if after else ""}</div>'
        head = f"<head><meta charset=utf-8><title>{self.words(2, 6)}</title><style>p{{margin:0}}</style><script>var t='<p>x</p>';</script></head>"
        html = "<!DOCTYPE html><html>" + r.choice([head, head, ""]) + r.choice(["<body>", "<body class=page>", ""]) + "".join(before) + "<!-- note <p>x</p> -->" + main + "".join(after)
        return html + (r.choice(["</body></html>", ""]) if not self.tidy else "</body></html>")
