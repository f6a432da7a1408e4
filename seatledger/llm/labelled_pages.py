"""Labelled pages to learn from: layouts of many kinds, with their main parts marked.

Each page is drawn from a seeded generator: containers with the names that web
pages give them, invented sentences, boilerplate before, beside, after and inside
the article, end tags that are missing.  The mark is an attribute that the model never reads.
"""

from __future__ import annotations

import random
from collections.abc import Callable

from .dom import MARK, OTHER

# What site builders call the parts of a page.
MAIN = "content article post entry story main body text page article-body post-content entry-content main-content story-body".split()
SHELL = "wrapper container page site layout row col inner outer root app grid wrap".split()
NOISE = {
    "nav": "nav menu navigation navbar breadcrumb breadcrumbs toc topbar links pagination pager tabs dropdown",
    "header": "header masthead banner top branding logo site-header",
    "footer": "footer bottom copyright legal site-footer colophon imprint",
    "aside": "sidebar aside widget rail related recommended trending popular secondary complementary more-stories teaser",
    "ad": "ad ads advert advertisement sponsor sponsored promo promotion banner-ad adsbygoogle ad-slot",
    "notice": "cookie cookies consent notice alert gdpr cookie-banner privacy-notice message popup modal overlay disclaimer",
    "form": "form search newsletter subscribe signup login contact search-form comment-form",
    "comments": "comments comment discussion responses replies comment-list commentlist reader-comments disqus feedback",
    "share": "share social sharing social-share follow tags tools print toolbar share-buttons",
}
TAGS = {
    "nav": ["nav", "div", "ul"], "header": ["header", "div"], "footer": ["footer", "div"], "aside": ["aside", "div", "section"],
    "ad": ["div", "aside", "section", "ins"], "notice": ["div", "section", "aside", "dialog"], "form": ["form"],
    "comments": ["div", "section", "ol", "ul"], "share": ["div", "ul", "p"],
}


class _Writer:
    def __init__(self, seed: int):
        self.rng = random.Random(seed)

    def one(self, *choices):
        return self.rng.choice(choices)

    def chance(self, p: float) -> bool:
        return self.rng.random() < p

    def words(self, n: int) -> str:
        syllables = "an the re on ti sch aux que de la ver ing ou st le en ar mo pa ki".split()
        return " ".join("".join(self.rng.choices(syllables, k=self.rng.randint(1, 4))) for _ in range(n))

    def sentences(self, most: int) -> str:
        ends = self.rng.choices([".", "!", "?", ". ###", ".&amp;"], [20, 1, 1, 1, 1])[0]
        return " ".join(self.words(self.rng.randint(1, 22)).capitalize() + ends for _ in range(self.rng.randint(1, most)))

    def inline(self, text: str) -> str:
        if self.chance(0.2):
            name = self.one("b", "i", "em", "strong", "a href='/x'", "span", "code")
            text = f"<{name}>{self.words(3)}</{name.split()[0]}> {text}"
        return text + (f"<br>{self.words(4)}" if self.chance(0.05) else "")

    def named(self, name: str) -> str:
        """Attributes with a name, in one of the ways names are written."""
        if self.chance(0.2):
            name += self.one("-1", "_box", "-wrapper", "-area", " " + self.one(*SHELL))
        return f' {self.one("class", "class", "id")}="{name}"'

    def links(self, n: int, name: str = "ul") -> str:
        items = "".join(f"<li><a href='/{i}'>{self.words(self.rng.randint(1, 4))}</a></li>" for i in range(n))
        return items if name in ("ul", "ol") else f"<ul>{items}</ul>" if self.chance(0.7) else " ".join(
            f"<a href='/{i}'>{self.words(1)}</a>" for i in range(n)
        )

    def noise(self, kind: str) -> str:
        tag = self.one(*TAGS[kind])
        plain = tag in ("nav", "header", "footer", "aside", "form") and self.chance(0.6)
        attributes = "" if plain else self.named(self.one(*NOISE[kind].split()))
        rng = self.rng
        if kind in ("nav", "share"):
            inner = self.links(rng.randint(2, 9), tag)
        elif kind == "header":
            title = self.words(rng.randint(1, 3))
            inner = self.one(f"<h1><a href='/'>{title}</a></h1>", f"<h1>{title}</h1>", f"<h1>{title}</h1>", f"<a href='/'>{title}</a>")
            inner += f"<p>{self.words(5)}</p>" * self.chance(0.4)
            inner += f"<nav>{self.links(4)}</nav>" * self.chance(0.5)
        elif kind == "footer":
            inner = f"<p>&copy; {self.words(rng.randint(2, 12))}</p>" if self.chance(0.6) else self.words(rng.randint(2, 20)) + "."
            inner += self.links(3) * self.chance(0.4)
        elif kind == "aside":
            inner = f"<h3>{self.words(2)}</h3>" * self.chance(0.7) + (self.links(rng.randint(2, 6)) if self.chance(0.6) else f"<p>{self.sentences(4)}</p>")
        elif kind == "form":
            inner = f"<label>{self.words(2)}</label><input name='q'><p>{self.sentences(1)}</p><button>{self.words(1)}</button>"
        elif kind == "comments":
            one = self.one("li", "p", "p", "div") if tag not in ("ol", "ul") else "li"
            inner = f"<h2>{self.words(2)}</h2>" * (one != "li") + "".join(
                f"<{one}>{self.words(1) + ': ' if self.chance(0.3) else ''}{self.sentences(5)}</{one}>" for _ in range(rng.randint(1, 8))
            )
        else:  # advert, notice
            inner = self.sentences(3) if self.chance(0.5) else f"<p>{self.sentences(3)}</p>" + f"<a href='/go'>{self.words(2)}</a>" * self.chance(0.5)
        return f"<{tag}{attributes}>{inner}</{tag}>"

    def paragraph(self) -> str:
        end = "" if self.chance(0.1) else "</p>"
        return f"<p>{'<b>' * self.chance(0.1)}{self.inline(self.sentences(self.one(1, 1, 3, 8, 20)))}{end}"

    def part(self) -> str:
        rng = self.rng
        makers: list[tuple[float, Callable[[], str]]] = [
            (12, self.paragraph),
            (1, lambda: f"<h2>{self.words(rng.randint(1, 6))}</h2>"),
            (1, lambda: "<ul>" + "".join(f"<li>{self.inline(self.sentences(1))}</li>" for _ in range(rng.randint(1, 5))) + "</ul>"),
            (0.5, lambda: f"<blockquote><p>{self.sentences(3)}</p></blockquote>"),
            (0.5, lambda: f"<table><tr><td>{self.words(2)}<td>{self.words(3)}</tr><tr><td>{self.words(1)}</td></tr></table>"),
            (0.5, lambda: f"<figure><img src='x'><figcaption>{self.sentences(1)}</figcaption></figure>"),
            (0.5, lambda: f"<pre>{self.words(6)}\n{self.words(4)}</pre>"),
            (0.5, lambda: f"<div>{self.sentences(4)}</div>"),
            (0.5, lambda: f"<section><h3>{self.words(3)}</h3>{self.paragraph()}</section>"),
        ]
        return rng.choices([m for _, m in makers], [w for w, _ in makers])[0]()

    def marked(self, html: str) -> str:
        """The outermost element marked."""
        end = min(i for i in (html.find(" "), html.find(">")) if i > 0)
        return f"{html[:end]} {MARK}{html[end:]}"

    def article(self) -> str:
        rng, parts = self.rng, []
        if self.chance(0.8):
            title = f"<h1>{self.words(rng.randint(2, 9))}</h1>"
            parts.append(f"<header>{title}</header>" if self.chance(0.1) else title)
        parts += [self.part() for _ in range(self.one(1, 2, 4, 8, 16))]
        noise = [k for k in ("ad", "share", "aside", "form", "comments", "nav", "notice") if self.chance(0.08)]
        kind = self.rng.random()
        if kind < 0.25:  # the main parts stand among others, without a container of their own
            parts = [self.marked(p) for p in parts]
            open_, close = "", ""
        else:
            tag, attributes = ("article", "") if kind < 0.55 else (self.one("div", "div", "main", "section", "td", "article"), self.named(self.one(*MAIN)))
            if tag == "td":
                open_, close = f"<table><tr><td {MARK}{attributes}>", "</td></tr></table>"
            else:
                open_, close = f"<{tag} {MARK}{attributes}>", f"</{tag}>"
        for k in noise:
            other = self.noise(k)
            end = min(i for i in (other.find(" "), other.find(">")) if i > 0)
            parts.insert(rng.randint(1, len(parts)), f"{other[:end]} {OTHER}{other[end:]}")
        return open_ + "".join(parts) + close

    def bare(self) -> str:
        """A page of nothing but its text."""
        rng = self.rng
        if self.chance(0.3):
            return f"<html><body {MARK}>{self.sentences(6)}" + f"<p>{self.sentences(4)}</p>" * rng.randint(0, 3)
        return "<html><body>" + "".join(self.marked(self.part()) for _ in range(rng.randint(1, 4))) + "</body></html>"

    def page(self) -> str:
        if self.chance(0.05):
            return self.bare()
        before = [self.noise(k) for k, p in (("notice", 0.2), ("header", 0.4), ("nav", 0.6), ("ad", 0.4), ("form", 0.15), ("aside", 0.15)) if self.chance(p)]
        after = [self.noise(k) for k, p in (("share", 0.15), ("comments", 0.3), ("aside", 0.3), ("form", 0.15), ("ad", 0.2), ("footer", 0.8), ("notice", 0.15)) if self.chance(p)]
        body = "".join(before) + self.article() + "".join(after)
        for _ in range(self.one(0, 0, 1, 2)):
            body = f"<div{self.named(self.one(*SHELL)) if self.chance(0.7) else ''}>{body}</div>"
        end = "</body></html>" if self.chance(0.9) else ""
        return f"<!DOCTYPE html><html><head><title>{self.words(4)}</title><script>x('</p>')</script></head><body>{body}{end}"


def labelled_pages(n: int, seed: int = 0) -> list[str]:
    """``n`` pages; the same for the same seed."""
    return [_Writer(seed * 1_000_003 + i).page() for i in range(n)]
