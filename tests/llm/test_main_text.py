import html
import random
import re
import time

import numpy as np
import pytest

from tickloom.llm import html_tree, main_text
from tickloom.llm.queries import QUERIES
from tickloom.llm.trees import Booster


def blocks(page):
    return [t for t in html_tree.parse(page).text if t]


@pytest.mark.parametrize(
    "page, want",
    [
        (None, []), ("", []), ("just text", ["just text"]), ("<p>a<p>b", ["a", "b"]), ("<p><b>a.<br><p>b</b>c", ["a.", "bc"]),
        ("<div>a <i>b</i>c&nbsp;&amp;\n d&#233;&am</div>", ["a bc & dé&am"]), ("<ul><li>1<li>2<ul><li>3</ul><li>4</ul>x", ["1", "2", "3", "4", "x"]),
        ("<script>var a='</p>';</script>b<style>c</style><title>d</title>", ["b"]), ("<!-- <p>x --><p>y<!-- z", ["y"]), ("a < b <3 c > d", ["a < b <3 c > d"]),
        ("<table><tr><td>1<td>2<tr><td>3</table>", ["1", "2", "3"]), ('<a title="x > y">t</a>', ["t"]), ("<p title=\"open>a</p>b", ["a", "b"]), ("</div></p>a</article>", ["a"]),
        ("<textarea>no</textarea><select><option>no</select>yes", ["yes"]), ("<DIV>A<BR/>B</DIV>", ["A B"]), ("<script>never closed", []),
    ],
)
def test_blocks(page, want):
    assert blocks(page) == want


def test_tree_is_in_page_order():
    t = html_tree.parse("<div class='a'><p>x</p><ul id=menu><li>y</li></ul></div><footer>z</footer>")
    n = len(t.kind)
    assert t.parent[0] == -1 and all(t.parent[k] < k for k in range(1, n)) and t.last[0] == n - 1
    for k in range(n):
        below = {j for j in range(n) if j == k or any(p == k for p in chain(t, j))}
        assert below == set(range(k, t.last[k] + 1))
    assert html_tree.families('class="Side-Bar x"') == html_tree.families("id=side") and html_tree.families(" href=menu") == 0


def chain(t, j):
    while (j := t.parent[j]) >= 0:
        yield j


@pytest.mark.parametrize("seed", range(20))
def test_decoding_is_the_likeliest_without_contradiction(seed):
    rng = random.Random(seed)
    t = html_tree.Tree()
    t.add(1, -1, 0)
    for _ in range(9):
        t.add(1, rng.randrange(len(t.kind)), 0)
    t.parent.sort()  # any such list is a tree, though not in page order; only parents before children matter
    odds = np.array([rng.gauss(0, 2) for _ in t.kind])
    keep = main_text.decode(t, odds)
    assert keep[0] and all(keep[t.parent[k]] for k in range(1, 10) if keep[k])
    best = max(
        sum(odds[k] for k in range(1, 10) if c >> k & 1)
        for c in range(1, 1 << 10, 2)
        if all(c >> t.parent[k] & 1 for k in range(1, 10) if c >> k & 1)
    )
    assert abs(sum(odds[k] for k in range(1, 10) if keep[k]) - best) < 1e-9


def test_booster_learns_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    model = Booster(n_trees=30).fit(x[:2000], y[:2000])
    assert ((model.raw(x[2000:]) > 0) == y[2000:]).mean() > 0.95


def test_pages_of_other_layouts():
    """Held-out pages of the grammar."""
    grammar = main_text.Grammar(12345)
    pages = [grammar.page() for _ in range(150)]
    right = total = 0
    for page, text in zip(pages, main_text.trained().extract([p.replace(main_text.Grammar.MARK, "") for p in pages])):
        want = [t.replace(main_text.Grammar.MARK, "") for t in blocks(page) if main_text.Grammar.MARK in t]
        got = text.split("\n\n") if text else []
        other = [t for t in blocks(page) if main_text.Grammar.MARK not in t]
        right += sum(w in got for w in want) + sum(o not in got for o in other)
        total += len(want) + len(other)
    assert right / total > 0.93


@pytest.mark.parametrize(
    "part",
    [
        '<header class="site-header"><h1>My site</h1><p>All of our news.</p></header>', '<div class="sidebar"><h3>Popular</h3><ul><li><a href="/a">One thing</a></li><li><a href="/b">Another</a></li></ul></div>',
        '<div class="cookie-notice"><p>We use cookies to make this site better for you. Accept them all?</p></div>', '<form action="/s"><label>Search</label><input name="q"><button>Go</button></form>',
        '<section id="comments"><h3>2 comments</h3><div class="comment"><b>Ann</b> I liked this a lot, thank you.</div><div class="comment"><p>So did I.</p></div></section>',
        '<div class="ad">Buy one now. Get two for the price of one, this week only.</div>', '<aside><p>More about this topic, and others.</p></aside>', '<footer>&copy; 2020 The paper. All of it.</footer>',
    ],
)
@pytest.mark.parametrize("where", ["before", "after"])
def test_parts_that_are_not_the_article(part, where):
    article = "<article><h1>The title of it</h1><p>First, some words about one thing.</p><p>Then, more words about quite another.</p><p>Short.</p></article>"
    page = f"<html><body><nav><ul><li><a href='/'>Home</a></li><li><a href='/n'>News</a></li></ul></nav>{part if where == 'before' else ''}{article}{part if where == 'after' else ''}</body></html>"
    assert main_text.trained().extract([page]) == ["The title of it\n\nFirst, some words about one thing.\n\nThen, more words about quite another.\n\nShort."]


MISLEADING = ["post thread", "entry comments", "story promo", "article related", "content widget", "post meta", "main alert", "text more", "sidebar", "post-footer"]
NAV = "<nav><ul><li><a href='/'>Home</a></li><li><a href='/n'>News</a></li></ul></nav>"
FOOT = "<footer>&copy; 2020 The paper. All of it.</footer>"


@pytest.mark.parametrize("name", MISLEADING)
def test_a_misleading_class_does_not_lose_the_article(name):
    inner = "<h1>The title of it</h1><p>First, some words about one thing, and then some more of them.</p><p>Then, more words about quite another.</p>"
    page = f"<html><body>{NAV}<article class='{name}'>{inner}</article>{FOOT}</body></html>"
    assert main_text.trained().extract([page]) == ["The title of it\n\nFirst, some words about one thing, and then some more of them.\n\nThen, more words about quite another."]


@pytest.mark.parametrize(
    "page, want",
    [
        ("just text", "just text"),
        ("First, some words about one thing. Then, more words about quite another.", "First, some words about one thing. Then, more words about quite another."),
        ("<div>First, some words about one thing.</div><div>Then, more words about quite another.</div>", "First, some words about one thing.\n\nThen, more words about quite another."),
        (f"{NAV}{FOOT}", ""),
    ],
)
def test_pages_without_telling_tags(page, want):
    assert main_text.trained().extract([page]) == [want]


@pytest.mark.parametrize("page", ["<i>" * 50_000 + "</b>" * 50_000, "<div><i>" * 30_000 + "</b>" * 30_000, "<ul><li><i>" * 30_000, "<p><b>" * 50_000])
def test_tags_left_open_cost_no_more_than_their_number(page):
    start = time.perf_counter()
    html_tree.parse(page)
    assert time.perf_counter() - start < 10  # looking through all open elements takes minutes


def article_by_tag(page):
    """The articles of the test pages, by their tags."""
    a, b = page.find("<article>"), page.find("</article>")
    inner = page[a + 9 : b if b >= 0 else len(page)]
    parts = [" ".join(html.unescape(re.sub(r"</?b>", "", p.replace("<br>", " "))).split()) for p in re.split(r"</?(?:p|h1)\b[^>]*>", inner)]
    return "\n\n".join(p for p in parts if p)


def test_query(spark, sf_dir):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = QUERIES["op2_boosted_html_extraction"](spark, sf_dir).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.url == pages[r.page_id].url and r.n_chars == len(r.text)
        assert r.text == article_by_tag(pages[r.page_id].html)


def test_odd_rows(spark):
    rows = [(1, None, "t"), (2, "", "t"), (3, "<article><p>" + "long text. " * 20_000, "t"), (None, "<article><h1>x</h1><p>Some text, here.</p></article>", None)]
    got = main_text.extract(spark.createDataFrame(rows, "page_id long, html string, text string")).collect()
    assert [(r.page_id, r.n_chars) for r in got[:3]] == [(1, 0), (2, 0), (3, 219_999)] and got[3].text == "x\n\nSome text, here."
    assert main_text.extract(spark.createDataFrame([], "page_id long, html string")).collect() == []


@pytest.mark.parametrize("name", ["button", "select", "video", "audio", "object", "canvas", "svg", "math"])
@pytest.mark.parametrize("page", ["<div>{}</div><article><p>One.</p><p>Two.</p></article>", "{}<article><p>One.</p><p>Two.</p></article>", "<article>{}<p>One.</p><p>Two.</p></article>", "<article><p>One.</p>{}<p>Two.</p></article>", "<article><p>{}</p><p>One.</p><div>{}x</{name}></div><p>Two.</p></article>"])
def test_inner_elements_left_open(name, page):
    assert blocks(page.replace("{}", f"<{name} id=a>").replace("{name}", name)) == ["One.", "Two."]


def test_closed_inner_elements_have_no_text():
    for name in html_tree.MUTED:
        assert blocks(f"<p>One <{name}><div>in <{name}2>it</div></{name}>two</p>") == ["One two"]
    assert blocks("<p>One<object><object>a</object><p>b</p></object></p><p>Two<button>b</p><p>Three</p>") == ["One", "Two", "Three"]
    assert blocks("<p>One<svg/>two<svg><title/><g>x</g></svg></p><script>'<button>'</script><p>Three</p>") == ["Onetwo", "Three"]
