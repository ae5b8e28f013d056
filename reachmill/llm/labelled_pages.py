"""Labelled pages to train the extraction model on.

Pages of invented words are laid out at random from the parts that pages are made of, once
with sectioning elements and once with plain elements and telling class names. The
attribute data-main says whether an element's text is main text; it holds for what is
inside until another one says otherwise, and no feature looks at it.
"""

from __future__ import annotations

import random

#: Names that authors give to parts of a page.
ARTICLE = ["article", "post", "entry-content", "story-body", "main-content", "post-body", "article-text", "content"]
PARTS = {
    "menu": ["nav", "menu", "navbar", "main-menu", "breadcrumbs", "topnav", "site-nav", "toc-links"],
    "header": ["header", "masthead", "site-header", "top-bar", "branding", "banner-top"],
    "footer": ["footer", "site-footer", "colophon", "page-bottom", "copyright", "legal"],
    "sidebar": ["sidebar", "aside", "widget", "related", "right-rail", "trending", "recommended"],
    "notice": ["cookie-notice", "consent", "gdpr-banner", "alert", "notice", "popup", "privacy-banner"],
    "advert": ["ad", "ads", "advert", "sponsored", "promo", "ad-slot", "banner"],
    "form": ["newsletter", "subscribe", "login", "search-form", "signup", "contact-form"],
    "comments": ["comments", "comment-list", "discussion", "replies", "responses", "user-comments"],
    "share": ["share", "social", "follow-us", "share-buttons"],
}
_SECTION = {"menu": "nav", "header": "header", "footer": "footer", "sidebar": "aside", "form": "form", "comments": "section"}
_SYLLABLES = ["ka", "lo", "mi", "ren", "tas", "vu", "der", "so", "fin", "ble", "or", "pan", "qui", "she", "an"]


class _Layout:
    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def words(self, low: int, high: int, end: str = "") -> str:
        many = self.r.randint(low, high)
        return " ".join("".join(self.r.choices(_SYLLABLES, k=self.r.randint(1, 4))) for _ in range(many)).capitalize() + end

    def prose(self) -> str:
        said = [self.words(3, 20, self.r.choice("....!?")) for _ in range(self.r.choice([1, 1, 2, 4, 7]))]
        if self.r.random() < 0.2:
            said[0] = f'<a href="/x">{said[0]}</a>'
        if self.r.random() < 0.2:
            said[-1] = f"<b>{said[-1]}</b>"
        return " ".join(said)

    def links(self, low: int = 2, high: int = 9) -> str:
        each = [f'<a href="/{i}">{self.words(1, 4)}</a>' for i in range(self.r.randint(low, high))]
        return "<ul>" + "".join(f"<li>{a}</li>" for a in each) + "</ul>" if self.r.random() < 0.6 else " | ".join(each)

    def named(self, tag: str, name: str, content: str, main: int) -> str:
        attribute = self.r.choice(["class", "class", "id"])
        return f'<{tag} {attribute}="{name}" data-main="{main}">{content}</{tag}>'

    def article(self) -> str:
        blocks = [f"<h1>{self.words(2, 10)}</h1>"] if self.r.random() < 0.9 else []
        if blocks and self.r.random() < 0.15:
            blocks = [f"<header>{blocks[0]}<p>{self.words(2, 5)}</p></header>"]
        for _ in range(self.r.choice([1, 2, 4, 8, 14])):
            kind = self.r.random()
            if kind < 0.72:
                blocks.append(f"<p>{self.prose()}</p>")
            elif kind < 0.80:
                blocks.append(f"<h2>{self.words(1, 6)}</h2>")
            elif kind < 0.86:
                blocks.append("<ul>" + "".join(f"<li>{self.words(1, 14)}</li>" for _ in range(self.r.randint(2, 5))) + "</ul>")
            elif kind < 0.91:
                blocks.append(f"<blockquote><p>{self.prose()}</p></blockquote>")
            elif kind < 0.94:
                blocks.append(f"<figure><img src=x><figcaption>{self.words(2, 9)}</figcaption></figure>")
            elif kind < 0.97:
                rows = "".join(f"<tr><td>{self.words(1, 3)}</td><td>{self.words(1, 3)}</td></tr>" for _ in range(2))
                blocks.append(f"<table>{rows}</table>")
            else:
                blocks.append(self.part(self.r.choice(["advert", "share", "sidebar"])))
        inner = "".join(blocks)
        shape = self.r.random()
        if shape < 0.45:
            return f'<article data-main="1">{inner}</article>'
        if shape < 0.6:
            return f'<main data-main="1">{inner}</main>'
        if shape < 0.7:
            return f'<main><article data-main="1">{inner}</article></main>'
        if shape < 0.95:
            return self.named("div", self.r.choice(ARTICLE), inner, 1)
        return f'<div data-main="1">{inner}</div>'

    def part(self, kind: str) -> str:
        if kind in ("menu", "share"):
            content = self.links()
        elif kind == "header":
            content = self.r.choice([f"<h1>{self.words(1, 4)}</h1>", f"<a href='/'>{self.words(1, 3)}</a>", f"<p>{self.words(2, 9)}</p>"])
        elif kind == "footer":
            content = self.r.choice([f"&copy; {self.words(1, 3)} &middot; {self.words(2, 9, '.')}", self.links(), f"<p>{self.words(3, 25, '.')}</p>"])
        elif kind == "sidebar":
            content = f"<h3>{self.words(1, 3)}</h3>" + self.r.choice([self.links(), f"<p>{self.prose()}</p>"])
        elif kind == "notice":
            content = self.r.choice([f"<p>{self.prose()}</p>", self.words(5, 25, ".")]) + self.r.choice(["", "<button>Ok</button>"])
        elif kind == "advert":
            content = self.r.choice([self.prose(), f"<p>{self.prose()}</p>", f'<a href="/b">{self.words(2, 8)}</a>'])
        elif kind == "form":
            content = f"<label>{self.words(1, 5)}</label><input name=a><p>{self.words(3, 12)}</p><button>Go</button>"
        else:
            one = self.r.choice(['<div class="comment">{}</div>', "<p>{}</p>", "<li>{}</li>", '<article class="comment"><p>{}</p></article>'])
            content = f"<h3>{self.words(1, 3)}</h3>" + "".join(one.format(self.prose()) for _ in range(self.r.randint(1, 4)))
        names = self.r.choice(PARTS[kind])
        tag = _SECTION.get(kind, "div") if self.r.random() < 0.6 else self.r.choice(["div", "div", "section"])
        if kind == "form" and tag != "form":
            content = f"<form>{content}</form>"
        if tag in ("nav", "header", "footer", "aside", "form") and self.r.random() < 0.6:
            return f'<{tag} data-main="0">{content}</{tag}>'
        return self.named(tag, names, content, 0)

    def page(self) -> str:
        before = [k for k in ("notice", "header", "menu", "advert", "form", "share") if self.r.random() < 0.45]
        after = [k for k in ("share", "sidebar", "advert", "comments", "form", "menu", "notice") if self.r.random() < 0.4]
        body = "".join(map(self.part, before)) + self.article() + "".join(map(self.part, after))
        if self.r.random() < 0.35:
            body = f'<div class="{self.r.choice(["wrapper", "container", "page", "layout"])}">{body}</div>'
        body += self.part("footer") if self.r.random() < 0.85 else ""
        return f'<!DOCTYPE html><html><head><title>{self.words(1, 5)}</title></head><body data-main="0">{body}</body></html>'


def labelled_pages(n: int, seed: int = 0) -> list[str]:
    return [_Layout(seed * 1_000_003 + i).page() for i in range(n)]
