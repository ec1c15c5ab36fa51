"""Leaf blocks of HTML pages: runs of inline content between block borders, with their ancestors.

A tolerant scanner, linear in the page however deep or broken it is: unknown and unclosed tags are normal, an end
tag closes down to its start tag or is ignored, script-like elements are skipped to their end tag, and so
is what a browser shows only in place of a picture, a film or a script (object, canvas, audio, video, noscript).
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass

# Element names of the HTML standard.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr "
    "math semantics annotation annotation-xml mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom menclose "
    "msub msup msubsup munder mover munderover mmultiscripts mtable mtr mtd".split()
)
SKIPPED = frozenset("annotation annotation-xml script style noscript template svg iframe object canvas audio video textarea title select head".split())
RAW = frozenset("script style textarea title iframe noscript".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
CLOSES_PARAGRAPH = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li "
    "main menu nav ol p pre section table ul dd dt".split()
)

TAG = re.compile(r"<(?:!--(?P<comment>)|(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|[!?/](?P<odd>))")
NAMED = re.compile(r"(?:^|\s)(class|id|role|aria-label|itemprop)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
WORDS = re.compile(r"[a-z]+")
ITEMS = ("li", "td", "th", "tr", "option", "dd", "dt")
LISTS = ("ul", "ol", "table", "dl", "select")


class Element:
    """An open element: its words of class, id and role, the block tags nearest to its content, and what it adds to the
    tags and words of the elements around it."""

    __slots__ = ("name", "own", "parent", "tag", "outer_tag", "new_tag", "new_words")

    def __init__(self, name: str, own: frozenset[str], parent: Element | None, new_tag: bool, new_words: tuple[str, ...]):
        self.name, self.own, self.parent = name, own, parent
        tags = (parent.tag, parent.outer_tag) if parent else (None, None)
        # after an unclosed inline element only block elements count as ancestors
        self.tag, self.outer_tag = tags if name in INLINE else (name, tags[0])
        self.new_tag, self.new_words = name if new_tag else None, new_words


@dataclass
class Block:
    element: Element | None  # the innermost open one
    text: str
    linked: int  # characters inside links

    def path(self) -> list[Element]:
        """The open elements, innermost first."""
        out, element = [], self.element
        while element is not None:
            out.append(element)
            element = element.parent
        return out

    @property
    def tags(self) -> tuple[str, ...]:
        """Open block elements, outermost first."""
        return tuple(e.name for e in reversed(self.path()) if e.name not in INLINE)

    @property
    def names(self) -> frozenset[str]:
        """Words of class, id and role of the open elements."""
        return frozenset(w for e in self.path() for w in e.new_words)

    @property
    def own(self) -> frozenset[str]:
        return self.element.own if self.element else frozenset()


def _names(rest: str) -> frozenset[str]:
    if "=" not in rest:
        return frozenset()
    found: set[str] = set()
    for _, value in NAMED.findall(rest):
        found.update(WORDS.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower()))
    return frozenset(found)


class _Open:
    """The open elements, with the places of each name."""

    def __init__(self):
        self.stack: list[Element] = []
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.words: Counter[str] = Counter()
        self.skipped = 0

    def last(self, name: str) -> int:
        places = self.places.get(name)
        return places[-1] if places else -1

    def push(self, name: str, words: frozenset[str]) -> None:
        new = tuple(sorted(w for w in words if not self.words[w]))
        self.words.update(words)
        inline = name in INLINE
        parent = self.stack[-1] if self.stack else None
        element = Element(name, words, parent, not inline and self.last(name) < 0, new)
        self.places.setdefault(name, []).append(len(self.stack))
        if not inline:
            self.blocks.append(len(self.stack))
        self.skipped += name in SKIPPED
        self.stack.append(element)

    def pop(self, to: int) -> None:
        while len(self.stack) > to:
            element = self.stack.pop()
            self.places[element.name].pop()
            if self.blocks and self.blocks[-1] == len(self.stack):
                self.blocks.pop()
            for word in element.own:
                self.words[word] -= 1
            self.skipped -= element.name in SKIPPED


def blocks(page: str) -> list[Block]:
    """Blocks with text, in page order; references are decoded and white space is single spaces."""
    out: list[Block] = []
    opened = _Open()
    stack = opened.stack
    parts: list[str] = []
    linked, at, n, lower = 0, 0, len(page), None

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(stack[-1] if stack else None, text, min(linked, len(text))))
            parts.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if opened.skipped and stack[-1].name == "head" and raw.strip():
            close_head()
        if raw and not opened.skipped:
            text = html.unescape(raw)
            parts.append(text)
            if opened.last("a") >= 0:
                linked += len(text.strip())

    def close_head() -> None:
        """Close an open head, whose end tag may be left out, unless one of its elements with markup is open."""
        place = opened.last("head")
        if place >= 0 and all(e.name in RAW for e in stack[place + 1 : place + 3]) and len(stack) <= place + 2:
            opened.pop(place)

    while at < n:
        match = TAG.search(page, at)
        if match is None:
            add(page[at:])
            break
        add(page[at : match.start()])
        at = match.end()
        if match["comment"] is not None or match["odd"] is not None:
            end = page.find("-->" if match["comment"] is not None else ">", at)
            at = n if end < 0 else end + (3 if match["comment"] is not None else 1)
            continue
        name = match["name"].lower()
        if match["close"]:
            place = opened.last(name)
            if place < 0:
                if name == "p":
                    flush()
                continue
            if name not in INLINE:
                flush()
            elif name not in SKIPPED and opened.blocks and opened.blocks[-1] > place:
                continue
            opened.pop(place)
            continue
        if opened.skipped and name not in IN_HEAD:
            close_head()
        if name == "br":
            add(" ")
            continue
        if name not in INLINE:
            flush()
        if name in CLOSES_PARAGRAPH and opened.last("p") >= 0:
            opened.pop(opened.last("p"))
        if name in ITEMS:
            place = opened.last(name)
            if place >= 0 and place > max(opened.last(x) for x in LISTS):
                opened.pop(place)
        if name in VOID or match["rest"].rstrip().endswith("/") and name not in INLINE:
            continue
        if name in RAW:
            if lower is None:
                lower = page.lower()
                lower = lower if len(lower) == n else page
            end = lower.find("</" + name, at)
            at = n if end < 0 else end
        names = _names(match["rest"])
        opened.push(name, names | {"hidden"} if HIDDEN.search(match["rest"]) else names)
    flush()
    return out
