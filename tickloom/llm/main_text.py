"""Main text of web pages: gradient-boosted trees over block nodes, decoded as a hierarchy.

Every node of a page's block tree gets the probability that it holds main text, from its tag,
attribute words, depth, the density of text, links and tags below it, its siblings, and what it
lies in. A node that is left out takes all below it along: among the choices that obey this, the
likeliest for the whole page is taken, so no kept block lies in one that is left out.

There are no labelled pages; the trees learn from pages that a grammar of common layouts writes,
where the part of each block is known.
"""

from __future__ import annotations

import random
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tickloom.llm import html_tree
from tickloom.llm.batches import with_columns
from tickloom.llm.html_tree import FAMILIES, KINDS, N_FAMILIES, Tree, parse
from tickloom.llm.trees import Booster

TRAINING_PAGES = 800
#: Shares of training articles with a misleading word in their attributes, of pages without telling tags and words, and of pages without an article.
MISLED = 0.3
NO_ARTICLE = 0.1
PLAIN = 0.12


def features(trees: list[Tree]) -> np.ndarray:
    """One row per node of all trees."""
    sizes = np.array([len(t.kind) for t in trees])
    offset = np.repeat(np.cumsum(sizes) - sizes, sizes)
    col = lambda name: np.concatenate([np.array(getattr(t, name), np.int64) for t in trees])
    kind, depth, own, above, kinds_above, tags, inputs, links = map(col, ("kind", "depth", "own", "above", "kinds_above", "tags", "inputs", "links"))
    parent, last = col("parent") + offset, col("last") + offset
    root = parent < offset
    here = np.arange(len(kind))
    parent[root] = here[root]
    texts = [x for t in trees for x in t.text]
    chars = np.array([len(x) for x in texts])
    stops = np.array([x.count(". ") + x.count(", ") + x.endswith((".", "!", "?")) if x else 0 for x in texts])
    words = np.array([x.count(" ") + 1 if x else 0 for x in texts])

    def below(q: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(q)])
        return total[last + 1] - total[here]

    t_chars, t_links, t_stops, t_tags, t_inputs, t_words = map(below, (chars, links, stops, tags + (kind > 0), inputs, words))
    t_par, t_items, t_heads = below(kind == KINDS.index("p")), below(kind == KINDS.index("item")), below(kind == KINDS.index("heading"))
    # siblings: children of one parent in page order
    order = np.lexsort((here, parent))
    before, after = np.full(len(here), -1), np.full(len(here), -1)
    same = (parent[order[1:]] == parent[order[:-1]]) & ~root[order[1:]] & ~root[order[:-1]]
    before[order[1:][same]], after[order[:-1][same]] = order[:-1][same], order[1:][same]
    starts = np.flatnonzero(np.concatenate([[True], ~same]))
    group = np.searchsorted(starts, np.arange(len(order)), side="right") - 1
    nth, count = np.empty(len(here)), np.empty(len(here))
    nth[order] = np.arange(len(order)) - starts[group]
    count[order] = np.diff(np.append(starts, len(order)))[group]
    page = np.repeat(np.add.reduceat(chars, np.cumsum(sizes) - sizes), sizes)
    seen = np.cumsum(chars) - chars
    seen = seen - seen[offset]
    log = np.log1p
    near = lambda at, q: np.where(at >= 0, q[at], -1)
    columns = [
        depth, nth, count, log(t_chars), log(chars), t_links / (t_chars + 1), t_tags / (t_chars + 1), log(t_stops), t_stops / (t_words + 1),
        t_chars / (page + 1), t_chars / (t_chars[parent] + 1), seen / (page + 1), log(t_words), t_chars / (t_words + 1),
        near(before, log(t_chars)), near(after, log(t_chars)), near(before, kind), near(after, kind),
        log(t_par), log(t_items), log(t_heads), log(t_inputs), t_items / (t_tags + 1), kind[parent], log(t_chars[parent]), (t_links / (t_chars + 1))[parent],
    ]
    columns += [kind == k for k in range(len(KINDS))]
    columns += [own >> k & 1 for k in range(N_FAMILIES)] + [above >> k & 1 for k in range(N_FAMILIES)]
    columns += [kinds_above >> k & 1 for k in range(1, len(KINDS))]
    return np.stack([np.asarray(c, np.float64) for c in columns], axis=1)


def decode(tree: Tree, odds: np.ndarray) -> list[bool]:
    """Which nodes to keep: the likeliest choice in which whatever is kept lies in kept nodes alone.

    odds are log odds; a choice's log likelihood is, up to a constant, the sum over kept nodes.
    """
    n = len(tree.kind)
    gain = odds.tolist()
    for k in range(n - 1, 0, -1):  # what lies below comes later in the page
        if gain[k] > 0:
            gain[tree.parent[k]] += gain[k]
    keep = [True] + [False] * (n - 1)
    for k in range(1, n):
        keep[k] = keep[tree.parent[k]] and gain[k] > 0
    return keep


class Extractor:
    def __init__(self, model: Booster):
        self.model = model

    def extract(self, pages: list[str | None]) -> list[str]:
        """Main text of each page, blocks in page order, parted by an empty line."""
        trees = [parse(p) for p in pages]
        odds = self.model.raw(features(trees))
        out, at = [], 0
        for t in trees:
            keep = decode(t, odds[at : at + len(t.kind)])
            out.append("\n\n".join(x for x, k in zip(t.text, keep) if k and x))
            at += len(t.kind)
        return out


class Grammar:
    """Pages of common layouts; text that belongs to the article has a mark before each block's words."""

    MARK = "\ue000"

    def __init__(self, seed: int):
        self.rng = random.Random(seed)

    def words(self, n: int) -> str:
        r = self.rng
        word = lambda: "".join(r.choice("aeiounrstlmdhc") for _ in range(r.randint(1, 11)))
        joined, sentence = [], 0
        for k in range(n):
            w = word()
            w = w.capitalize() if sentence == 0 else w
            sentence += 1
            if k == n - 1 or r.random() < 0.12:
                w, sentence = w + r.choice([".", ".", ".", "!", "?", ""]), 0
            elif r.random() < 0.08:
                w += ","
            joined.append(w)
        style = r.random()
        if style < 0.05:
            joined = [w + r.choice(["***", "&amp;&amp;", "$$$", "!!", " |"]) for w in joined]
        return " ".join(joined)

    def some(self, low: int, high: int) -> str:
        """Words, mostly few; now and then with a link or stress."""
        r = self.rng
        n = int(low * (high / low) ** r.random())
        text = self.words(n)
        if r.random() < 0.15:
            text += f' <a href="/{r.randint(1, 99)}">{self.words(r.randint(1, 3))}</a> {self.words(r.randint(1, 6))}'
        if r.random() < 0.1:
            text = f"<b>{text}" + ("</b>" if r.random() < 0.6 else "")
        if r.random() < 0.08:
            text += "<br>" + self.words(r.randint(1, 5))
        return text

    def misled(self, attributes: str) -> str:
        """Attributes with a word beside their own that says something else, as pages are full of."""
        r = self.rng
        word = r.choice(FAMILIES[r.choice(list(FAMILIES))])
        return attributes[:-1] + f' {word}"' if attributes else f' class="{word}"'

    def attributes(self, family: str | None, chance: float = 0.8) -> str:
        r = self.rng
        if not family or r.random() > chance:
            return f' class="{r.choice(["row", "col", "box", "wrap", "inner", "x1", "clearfix"])}"' if r.random() < 0.25 else ""
        word = r.choice(FAMILIES[family])
        extra = r.choice(["", "", "", "-box", "-area", "_1", " block", "-wrapper", " box"])
        return f' {r.choice(["class", "class", "class", "id"])}="{word}{extra}"'

    def element(self, tags: list[str], family: str | None, inner: str, chance: float = 0.8) -> str:
        tag = self.rng.choice(tags)
        return f"<{tag}{self.attributes(family, 0.3 if tag not in ('div', 'section', 'ul', 'ol', 'table', 'p', 'span', 'li') else chance)}>{inner}</{tag}>"

    def link_list(self, low: int = 2, high: int = 9) -> str:
        r = self.rng
        items = [f'<a href="/{r.randint(0, 99)}">{self.words(r.randint(1, 4))}</a>' for _ in range(r.randint(low, high))]
        return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>" if r.random() < 0.75 else r.choice([" ", " | ", " &middot; "]).join(items)

    def prose(self, high: int = 40) -> str:
        r = self.rng
        n = r.choice([1, 1, 1, 2, 3])
        bodies = [self.some(1, high) for _ in range(n)]
        return bodies[0] if n == 1 and r.random() < 0.6 else "".join(f"<p>{b}</p>" for b in bodies)

    def aside_part(self, kinds: tuple = ("menu", "advert", "advert", "side", "footer", "header", "form", "notice", "share", "comment", "related")) -> str:
        """Anything but the article."""
        r = self.rng
        kind = r.choice(kinds)
        heading = f"<h{(h := r.randint(2, 4))}>{self.words(r.randint(1, 4))}</h{h}>" if r.random() < 0.4 else ""
        if kind == "menu":
            return self.element(["nav", "nav", "div", "ul"], "menu", self.link_list())
        if kind == "advert":
            return self.element(["div", "div", "aside", "section", "p"], "advert", self.prose(), 1.0)
        if kind == "side":
            return self.element(["aside", "div"], "side", heading + r.choice([self.link_list(), self.prose()]), 0.95)
        if kind == "footer":
            return self.element(["footer", "footer", "div"], "footer", r.choice(["", "&copy; ", "&copy; 2020 "]) + self.some(1, 40) + (self.link_list() if r.random() < 0.3 else ""), 1.0)
        if kind == "header":
            return self.element(["header", "header", "div"], "header", r.choice([self.link_list(), self.some(1, 12), f"<h1>{self.words(2)}</h1>{self.some(1, 8)}"]), 0.95)
        if kind == "form":
            fields = "".join(f'<label>{self.words(r.randint(1, 2))}</label><input name="f{k}">' for k in range(r.randint(1, 3)))
            form = f"<form{self.attributes('form')}>{heading}{self.some(1, 12) if r.random() < 0.5 else ''}{fields}<button>ok</button></form>"
            return form if r.random() < 0.6 else self.element(["div", "section"], "form", heading + self.some(1, 12) + form)
        if kind == "notice":
            return self.element(["div", "div", "section", "p"], "notice", self.prose(), 1.0)
        if kind == "share":
            return self.element(["div", "ul", "p"], "share", self.link_list() if r.random() < 0.5 else self.some(1, 5), 1.0)
        if kind == "comment":
            one = lambda: self.element(["div", "li", "article"], "comment", (f"<b>{self.words(1)}</b> " if r.random() < 0.5 else "") + self.prose(), 0.7)
            return self.element(["section", "div", "ol"], "comment", heading + "".join(one() for _ in range(r.randint(1, 6))), 1.0)
        return self.element(["div", "section", "aside"], "side", heading + "".join(f"<div>{self.link_list(1, 2)}{self.some(1, 10)}</div>" for _ in range(r.randint(1, 4))), 1.0)

    def article(self) -> str:
        r, m = self.rng, self.MARK
        parts = [f"<h1{self.attributes('header', 0.15)}>{m}{self.words(r.randint(1, 12))}</h1>"] if r.random() < 0.8 else []
        long = r.choice([4, 30, 30, 150])
        for _ in range(r.choice([1, 1, 2, 3, 5, 8, 14])):
            kind = r.random()
            if kind < 0.78:
                parts.append(f"<p>{m}{self.some(1, long)}" + ("</p>" if r.random() < 0.8 else ""))
            elif kind < 0.84:
                parts.append(f"<h{(h := r.randint(2, 4))}>{m}{self.words(r.randint(1, 8))}</h{h}>")
            elif kind < 0.9:
                parts.append("<ul>" + "".join(f"<li>{m}{self.some(1, 20)}</li>" for _ in range(r.randint(2, 6))) + "</ul>")
            elif kind < 0.94:
                parts.append(f"<blockquote>{m}{self.some(2, 40)}</blockquote>")
            elif kind < 0.96:
                rows = "".join("<tr>" + "".join(f"<td>{m}{self.words(r.randint(1, 3))}</td>" for _ in range(3)) + "</tr>" for _ in range(r.randint(1, 4)))
                parts.append(f"<table>{rows}</table>")
            elif kind < 0.98:
                parts.append(f'<figure><img src="a.png"><figcaption>{m}{self.words(r.randint(2, 12))}</figcaption></figure>')
            else:
                parts.append(f"<pre>{m}{self.words(r.randint(3, 30))}</pre>")
            if r.random() < 0.05:
                parts.append(self.aside_part())
        if r.random() < 0.15:
            cut = r.randint(0, len(parts))
            parts = [*parts[:cut], self.element(["div", "section"], None, "".join(parts[cut:]))]
        body = "".join(parts)
        if r.random() < 0.08:  # no paragraphs: text between breaks
            body = f"{m}{self.some(20, 200)}<br><br>{self.some(5, 80)}"
        if r.random() < 0.3:
            body = self.element(["div", "section"], "main", body)
        tag = r.choice(["article", "article", "article", "main", "div", "div", "section", "td"])
        own = self.attributes("main", 0.7)
        if r.random() < MISLED:
            own = self.misled(own)
        return f"<{tag}{own}>{body}</{tag}>"

    def plain_page(self) -> str:
        """Text that no tag or word says anything of: bare, in divisions without names, or parted by breaks."""
        r, m = self.rng, self.MARK
        parts = [f"{m}{self.some(3, 60)}" for _ in range(r.choice([1, 1, 2, 4, 9]))]
        style = r.random()
        if style < 0.35:
            return r.choice(["\n\n", "<br><br>", " "]).join([parts[0], *[x.replace(m, "") for x in parts[1:]]])
        body = "".join(f"<div>{x}</div>" for x in parts)
        if r.random() < 0.5:
            body = f"<div>{body}</div>"
        rest = ("menu", "footer", "form")
        before, after = ([self.aside_part(rest) for _ in range(r.randint(0, 2))] for _ in range(2))
        page = "".join([*before, body, *after])
        if style < 0.8:  # what is not the article is told by links, inputs and lengths alone
            page = re.sub(r'(<(?!input)[a-z0-9]+) (?:class|id)="[^"]*"', r"\1", re.sub(r"(</?)(?:nav|footer|header|section|aside|article|main)\b", r"\1div", page))
        return f"<html><body>{page}</body></html>"

    def page(self) -> str:
        r = self.rng
        if r.random() < PLAIN:
            return self.plain_page()
        before, after = ([self.aside_part() for _ in range(r.randint(0, 3))] for _ in range(2))
        if r.random() < 0.7:
            before.insert(0, self.element(["nav"], "menu", self.link_list()))
        if r.random() < 0.7:
            after.append(self.element(["footer", "footer", "div"], "footer", "&copy; " + self.some(1, 40), 1.0))
        body = "".join([*before, self.article() if r.random() > NO_ARTICLE else "", *after])
        if r.random() < 0.4:
            body = self.element(["div"], None, body)
        end = "</body></html>" if r.random() < 0.85 else ""
        return f"<!DOCTYPE html><html><head><title>{self.words(4)}</title><style>p{{}}</style></head><body>{body}{end}"


def _labels(tree: Tree) -> np.ndarray:
    """1 for runs of the article and for all that they lie in."""
    y = np.array([Grammar.MARK in x for x in tree.text], float)
    for k in range(len(y) - 1, 0, -1):
        y[tree.parent[k]] = max(y[tree.parent[k]], y[k])
    return y


@lru_cache(maxsize=1)
def trained(pages: int = TRAINING_PAGES, seed: int = 0) -> Extractor:
    """Trees learned from the grammar's pages: the same at each call."""
    grammar = Grammar(seed)
    trees = [parse(grammar.page()) for _ in range(pages)]
    y = np.concatenate([_labels(t) for t in trees])
    for t in trees:
        t.text = [x.replace(Grammar.MARK, "") for x in t.text]
    return Extractor(Booster().fit(features(trees), y))


def extract(pages: DataFrame, extractor: Extractor | None = None, html: str = "html") -> DataFrame:
    """Pages with `text`, the main text of their whole html, and `n_chars`, its code points.

    A null or empty page has an empty text. Columns of these names give way.
    """
    known = pages.sparkSession.sparkContext.broadcast(extractor or trained())

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        texts = known.value.extract(batch.column(0).to_pylist()) if batch.num_rows else []
        return {"text": texts, "n_chars": [len(t) for t in texts]}

    return with_columns(pages, "text string, n_chars long", work, [html], size=1 << 20)


__all__ = ["Extractor", "Grammar", "decode", "extract", "features", "html_tree", "trained"]
