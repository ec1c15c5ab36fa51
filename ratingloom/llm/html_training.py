"""Labelled pages for the block model: drawn layouts, and the semantic markup of some given pages."""

from __future__ import annotations

import html
import random

from ratingloom.llm.html_blocks import Block, blocks

# Usual names of page parts.
PARTS = {
    "nav": ["nav", "navbar", "menu", "navigation", "topbar", "breadcrumb", "breadcrumbs", "links", "toc", "skip"],
    "header": ["header", "masthead", "site-header", "page-header", "branding", "logo", "top"],
    "footer": ["footer", "site-footer", "copyright", "colophon", "legal", "bottom"],
    "aside": ["sidebar", "side", "widget", "rail", "related", "recommended", "trending", "popular", "teaser", "more"],
    "notice": ["cookie", "cookie-banner", "consent", "notice", "gdpr", "alert", "popup", "modal", "overlay", "warning", "paywall", "message"],
    "ad": ["ad", "ads", "advert", "advertisement", "sponsored", "promo", "sponsor", "banner", "adbox", "promotion"],
    "form": ["form", "newsletter", "subscribe", "signup", "search", "login", "contact"],
    "comments": ["comments", "comment", "comment-list", "respond", "replies", "reply", "discussion", "feedback"],
    "share": ["share", "social", "toolbar", "buttons", "pagination", "pager", "tags", "meta", "rating"],
}
BODIES = ["content", "post", "entry", "story", "article-body", "entry-content", "main", "body", "text", "article", "page-content", "hentry"]
BOILERPLATE_TAGS = frozenset("nav header footer aside form button menu dialog".split())
BOILERPLATE_NAMES = frozenset(w for names in PARTS.values() for n in names for w in n.split("-")) - {"page", "top", "text", "more", "side", "list", "message"}


class Drawer:
    """Draws pages; ``page`` returns the HTML and the texts of its content blocks."""

    def __init__(self, seed: int):
        self.draw = random.Random(seed)
        letters = "abcdefghiklmnoprstuvwzäéñö"
        self.syllables = ["".join(self.draw.choice(letters) for _ in range(self.draw.randint(1, 3))) for _ in range(90)]

    def words(self, n: int) -> str:
        return " ".join("".join(self.draw.choice(self.syllables) for _ in range(self.draw.randint(1, 4))) for _ in range(n))

    def prose(self, least: int = 3, most: int = 90) -> str:
        parts, left = [], self.draw.randint(least, most)
        style = self.draw.random()
        while left > 0:
            n = self.draw.randint(1, 18)
            sentence = self.words(min(n, left)).capitalize() + self.draw.choice([".", ".", ".", "!", "?"])
            parts.append(sentence.upper() if style < 0.08 else sentence)
            left -= n
        return " ".join(parts)

    def element(self, tag: str, inside: str, name: str | None = None, closed: bool = True) -> str:
        label = ""
        if name is not None:
            label = f' {self.draw.choice(["class", "class", "id"])}="{name}"'
        return f"<{tag}{label}>{inside}" + (f"</{tag}>" if closed else "")

    def named(self, kind: str, inside: str) -> str:
        own = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form"}.get(kind)
        tag = own if own and self.draw.random() < 0.6 else self.draw.choice(["div", "div", "section"])
        name = self.draw.choice(PARTS[kind]) if tag != own or self.draw.random() < 0.4 else None
        return self.element(tag, inside, name)

    def links(self, least: int = 2, most: int = 8) -> str:
        items = [f'<a href="/{i}">{self.words(self.draw.randint(1, 5))}</a>' for i in range(self.draw.randint(least, most))]
        kind = self.draw.random()
        if kind < 0.6:
            return "<ul>" + "".join(self.element("li", i, closed=self.draw.random() < 0.8) for i in items) + "</ul>"
        return (" | " if kind < 0.8 else " ").join(items)

    def boilerplate(self, kind: str) -> str:
        say = lambda least, most: html.escape(self.prose(least, most))
        if kind == "nav":
            return self.named(kind, self.links())
        if kind == "header":
            return self.named(kind, self.element("div", self.words(2)) + (self.links(2, 5) if self.draw.random() < 0.5 else ""))
        if kind == "footer":
            mark = self.draw.choice(["&copy; ", "© ", "&copy; 2020 ", ""])
            return self.named(kind, mark + self.words(2) + " &middot; " + say(2, 25) + (self.links(2, 6) if self.draw.random() < 0.4 else ""))
        if kind == "comments":
            each = lambda: self.element("div", self.element("b", self.words(2)) + f"<p>{say(2, 50)}</p>", self.draw.choice(["comment", "reply", "user"]))
            return self.named(kind, f"<h3>{self.words(1)}</h3>" * (self.draw.random() < 0.5) + "".join(each() for _ in range(self.draw.randint(1, 5))))
        if kind == "form":
            fields = f"<label>{self.words(2)}</label><input type=text><button>{self.words(1)}</button>"
            return self.named(kind, f"<p>{say(2, 16)}</p>" * (self.draw.random() < 0.6) + f"<form>{fields}</form>")
        if kind == "aside":
            teaser = "".join(f"<p>{say(3, 22)}</p>" for _ in range(self.draw.randint(0, 3)))
            return self.named(kind, f"<h3>{self.words(2)}</h3>" + teaser + self.links(1, 6))
        if kind == "share":
            return self.named(kind, self.links(2, 5) if self.draw.random() < 0.7 else self.words(3))
        return self.named(kind, say(2, 40) if self.draw.random() < 0.6 else f"<p>{say(2, 40)}</p><a href=#>{self.words(1)}</a>")

    def content(self) -> tuple[str, list[str]]:
        texts, out = [], []

        def add(tag: str, text: str, closed: float = 0.85) -> None:
            inside, shown = html.escape(text), text
            chance = self.draw.random()
            if chance < 0.15:
                inside = f"<b>{inside}" + "</b>" * (self.draw.random() < 0.6)
            elif chance < 0.3:
                link = self.words(2)
                inside, shown = f'{inside} <a href="#">{link}</a>', f"{text} {link}"
            elif chance < 0.4:
                inside += "<br>"
            texts.append(" ".join(shown.split()))
            out.append(self.element(tag, inside, closed=tag not in ("p", "li") or self.draw.random() < closed))

        if self.draw.random() < 0.8:
            add("h1", self.words(self.draw.randint(1, 10)) if self.draw.random() < 0.5 else self.prose(2, 12))
        for _ in range(self.draw.randint(1, 9)):
            kind = self.draw.random()
            if kind < 0.72:
                add("p", self.prose())
            elif kind < 0.8:
                add(self.draw.choice(["h2", "h3"]), self.words(self.draw.randint(1, 7)))
            elif kind < 0.88:
                out.append("<ul>")
                for _ in range(self.draw.randint(1, 5)):
                    add("li", self.prose(2, 15))
                out.append("</ul>")
            elif kind < 0.93:
                add("blockquote", self.prose(3, 40))
            elif kind < 0.97:
                add("div", self.prose())
            else:
                add("pre", self.words(12))
            if self.draw.random() < 0.06:
                out.append(self.boilerplate(self.draw.choice(["ad", "share", "notice", "aside", "form"])))
        return "".join(out), texts

    def page(self) -> tuple[str, list[str]]:
        inside, texts = self.content()
        if self.draw.random() < 0.25:
            inside += self.boilerplate(self.draw.choice(["comments", "share", "aside"]))
        form = self.draw.random()
        if form < 0.5:
            body = self.element("article", inside, self.draw.choice(BODIES) if self.draw.random() < 0.3 else None)
        elif form < 0.65:
            body = self.element("main", inside)
        else:
            body = self.element(self.draw.choice(["div", "div", "section"]), inside, self.draw.choice(BODIES))
        if self.draw.random() < 0.3:
            body = self.element(self.draw.choice(["div", "main"]), body, self.draw.choice(["wrapper", "container", "page", "main", "layout"]))
        before = [self.boilerplate(k) for k in ("header", "nav", "notice", "ad", "nav", "form") if self.draw.random() < 0.4]
        after = [self.boilerplate(k) for k in ("share", "aside", "comments", "form", "ad", "notice") if self.draw.random() < 0.3]
        after += [self.boilerplate("footer")] * (self.draw.random() < 0.85)
        if self.draw.random() < 0.3:
            self.draw.shuffle(before)
        script = '<script>var t="</p>";f(1);</script>' * (self.draw.random() < 0.5)
        head = f"<html><head><title>{self.words(4)}</title>{script}</head><body>"
        return head + "".join(before) + body + "".join(after) + "</body></html>" * (self.draw.random() < 0.8), texts


def drawn_pages(n: int, seed: int) -> list[tuple[list[Block], list[int]]]:
    """Blocks and labels (1: content) of drawn pages."""
    drawer, out = Drawer(seed), []
    for _ in range(n):
        page, texts = drawer.page()
        wanted, found = set(texts), blocks(page)
        out.append((found, [int(b.text in wanted) for b in found]))
    return [p for p in out if p[0]]


def marked_pages(pages: list[str]) -> list[tuple[list[Block], list[int]]]:
    """Blocks and labels of those given pages that mark their article: content is what lies in it, outside
    elements and names of other parts."""
    out = []
    for page in pages:
        found = blocks(page)
        inside = [
            int("article" in b.tags and not BOILERPLATE_TAGS & set(b.tags) and not BOILERPLATE_NAMES & b.names) for b in found
        ]
        if any(inside) and not all(inside):
            out.append((found, inside))
    return out
