"""Web pages as block trees: tolerant parsing into nodes in page order.

Nodes are block elements and runs of inline text between them. Nothing is built for inline tags;
a run knows how much of it is link text. Scripts, styles, forms' inner controls and the like have
no text. Tags left open are closed where a browser would; those of inner controls and media end
at the next block, so that no text behind them is lost.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterable
from functools import lru_cache

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?/][^>]*+>""", re.S)
_NAMES = re.compile(r"""\b(?:class|id|role|itemprop|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)

# Elements of HTML by what they do.
BLOCKS = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split())
SKIPPED = frozenset("script style noscript template title textarea select button svg math iframe object canvas audio video head".split())
MUTED = frozenset("select button svg math object canvas audio video".split())  # these do not run to the page's end when left open
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"tbody", "thead", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
HOLDS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "tbody": {"table"}, "tfoot": {"table"}}

#: Kinds of blocks, by tag; runs of text are the first kind.
KINDS = ["run", "p", "heading", "item", "list", "div", "section", "article", "nav", "aside", "header", "footer", "form", "table", "quote", "figure", "other"]
_KIND = {
    "p": "p", "h1": "heading", "h2": "heading", "h3": "heading", "h4": "heading", "h5": "heading", "h6": "heading", "hgroup": "heading",
    "li": "item", "dt": "item", "dd": "item", "ul": "list", "ol": "list", "dl": "list", "menu": "list", "div": "div", "center": "div",
    "section": "section", "article": "article", "main": "article", "nav": "nav", "aside": "aside", "header": "header", "footer": "footer",
    "form": "form", "fieldset": "form", "dialog": "form", "table": "table", "tr": "table", "td": "table", "th": "table", "tbody": "table",
    "blockquote": "quote", "pre": "quote", "figure": "figure", "figcaption": "figure", "caption": "figure",
}
KIND_OF = {t: KINDS.index(_KIND.get(t, "other")) for t in BLOCKS}

#: What the words of class, id and role may say of a block.
FAMILIES = {
    "main": "article content post entry story body main text prose".split(),
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs topbar toolbar pager pagination skip tabs".split(),
    "advert": "ad ads adv advert advertisement adsense adslot sponsor sponsored promo promotion banner outbrain taboola commercial".split(),
    "side": "side sidebar aside widget widgets rail related recommended recommend trending popular more also secondary complementary".split(),
    "comment": "comment comments commentlist reply replies respond discussion disqus thread feedback reviews".split(),
    "footer": "footer foot bottom copyright legal colophon contentinfo imprint".split(),
    "header": "header head masthead top logo brand site title branding".split(),
    "form": "form search login signup subscribe newsletter subscription register contact".split(),
    "notice": "notice notices cookie cookies consent gdpr alert popup modal overlay warning message paywall toast".split(),
    "share": "share sharing social byline meta tags author date toolbox print follow".split(),
}
_WORD_FAMILY = {w: 1 << k for k, words in enumerate(FAMILIES.values()) for w in words}
N_FAMILIES = len(FAMILIES)


@lru_cache(maxsize=20_000)
def families(attributes: str) -> int:
    """Bits of the families that the words of an element's class, id and role belong to."""
    bits = 0
    for m in _NAMES.finditer(attributes):
        spaced = re.sub(r"([a-z])([A-Z])", r"\1 \2", m[1] or m[2] or m[3] or "")
        for word in re.split(r"[^a-z]+", spaced.lower()):
            bits |= _WORD_FAMILY.get(word, 0)
    return bits


class Tree:
    """Nodes in page order. parent: -1 for the root; last: the last node below each."""

    def __init__(self):
        self.kind: list[int] = []
        self.parent: list[int] = []
        self.last: list[int] = []
        self.depth: list[int] = []
        self.own: list[int] = []  # families of the element's own attributes
        self.above: list[int] = []  # families of all that it lies in
        self.kinds_above: list[int] = []
        self.tags: list[int] = []  # tags opened directly in a block or within a run
        self.inputs: list[int] = []
        self.links: list[int] = []  # characters of link text of a run
        self.text: list[str] = []

    def add(self, kind: int, parent: int, own: int) -> int:
        self.kind.append(kind)
        self.parent.append(parent)
        self.last.append(len(self.last))
        self.own.append(own)
        if parent >= 0:
            self.depth.append(self.depth[parent] + 1)
            self.above.append(self.above[parent] | self.own[parent])
            self.kinds_above.append(self.kinds_above[parent] | 1 << self.kind[parent])
        else:
            for x in (self.depth, self.above, self.kinds_above):
                x.append(0)
        for x in (self.tags, self.inputs, self.links):
            x.append(0)
        self.text.append("")
        return len(self.kind) - 1


def _ends(page: str) -> dict[int, int]:
    """Where the muted elements that are closed end, by where their start tags end.

    A muted element is left open if a block around it ends before its end tag comes, or, for
    buttons and selections, if another one begins.
    """
    ends: dict[int, int] = {}
    open_: list[tuple[str, int]] = []
    count: Counter = Counter()

    def pop(name: str) -> int:
        while True:
            other, start = open_.pop()
            count[other] -= 1
            if other == name:
                return start

    at = 0
    while m := _TAG.search(page, at):
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if name not in BLOCKS and name not in SKIPPED or name in ("head", "hr"):
            continue
        if m[1] or m[4]:
            if count[name]:
                start = pop(name)
                if name in MUTED:
                    ends[start] = at
            continue
        if (m[3] or m[6] or "").endswith("/") and (name in ("svg", "math") or count["svg"] or count["math"]):
            continue
        if name in BLOCKS or name in MUTED:
            if name in ("button", "select") and count[name]:
                pop(name)
            open_.append((name, at))
            count[name] += 1
        elif stop := re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(page, at):
            at = stop.end()
        else:
            break
    return ends


def parse(page: str | None) -> Tree:
    """The block tree of a page; a null or empty page is a root alone."""
    tree = Tree()
    root = tree.add(KIND_OF["body"], -1, 0)
    page = page or ""
    open_: list[tuple[str, int]] = [("", root)]  # all open elements, inline ones too, with their block
    places: dict[str, list[int]] = {}  # where in open_ the elements of each name are
    blocks: list[int] = [0]  # and where the blocks are
    pieces: list[str] = []
    linked = anchors = tags = at = muted = 0
    ends: dict[int, int] | None = None

    def end_run() -> None:
        nonlocal linked, tags
        text = " ".join("".join(pieces).split())
        if text:
            k = tree.add(0, open_[-1][1], 0)
            tree.text[k], tree.links[k], tree.tags[k] = text, min(linked, len(text)), tags
        pieces.clear()
        linked = tags = 0

    def begin(name: str, block: int) -> None:
        places.setdefault(name, []).append(len(open_))
        if name in BLOCKS:
            blocks.append(len(open_))
        open_.append((name, block))

    def inmost(names: Iterable[str]) -> int:
        return max((places[n][-1] for n in names if places.get(n)), default=0)

    def close(depth: int) -> None:
        nonlocal anchors, muted
        while len(open_) > depth:
            name, block = open_[-1]
            if name in BLOCKS:
                end_run()
                tree.last[block] = len(tree.kind) - 1
                blocks.pop()
            anchors -= name == "a"
            muted -= name in MUTED
            places[name].pop()
            open_.pop()

    def unmute() -> None:
        if muted:
            close(min(places[n][0] for n in MUTED if places.get(n)))

    def say(raw: str) -> None:
        nonlocal linked
        if raw and not muted:
            text = html.unescape(raw) if "&" in raw else raw
            pieces.append(text)
            if anchors:
                linked += len(text.strip())

    while m := _TAG.search(page, at):
        say(page[at : m.start()])
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        if m[1] or m[4]:
            if name in BLOCKS:
                unmute()
            depth = inmost((name,))
            if depth and (name in BLOCKS or blocks[-1] < depth):
                if name in BLOCKS:
                    end_run()
                close(depth)
            continue
        if name in SKIPPED:
            if not (m[3] or m[6] or "").endswith("/") or name not in ("svg", "math"):
                if name == "head":
                    continue  # its text is in elements that are skipped
                if name in MUTED:
                    ends = _ends(page) if ends is None else ends
                    tree.inputs[open_[-1][1]] += name in ("select", "button")
                    if at in ends:
                        at = ends[at]
                    else:
                        unmute()
                        begin(name, open_[-1][1])
                        muted += 1
                    continue
                stop = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(page, at)
                at = stop.end() if stop else len(page)
                tree.inputs[open_[-1][1]] += name == "textarea"
            continue
        if name in BLOCKS:
            unmute()
            end_run()
            if name != "hr":
                if name in CLOSES:
                    closed = inmost(CLOSES[name])
                    if closed > inmost(HOLDS.get(name, ())):
                        close(closed)
                elif open_[blocks[-1]][0] == "p":
                    close(blocks[-1])
                block = open_[-1][1]
                tree.tags[block] += 1
                begin(name, tree.add(KIND_OF[name], block, families(m[3] or m[6] or "")))
            continue
        if name == "br":
            pieces.append(" ")
        tree.inputs[open_[-1][1]] += name == "input"
        tags += 1
        if name not in VOID:
            begin(name, open_[-1][1])
            anchors += name == "a"
    say(page[at:])
    end_run()
    close(1)
    tree.last[root] = len(tree.kind) - 1
    return tree
