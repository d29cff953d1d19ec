"""Main text of small pages, tree matching against all alignments, whole table against a direct reading."""

import html
import random
import re
from functools import cache

import pytest

from textlens.llm import html_text as H
from textlens.llm.queries import op8_html_extraction

PAGES = {
    None: "", "": "", "plain": "plain", "<p>a<p>b": "a\n\nb",
    "<body><nav><ul><li>m</ul></nav><article><h1>T</h1><p>a  b\n c<p>d <b>e</b>f<br>g</article><footer>x</footer>": "T\n\na b c\n\nd ef g",
    "<article><p>1 &lt; 2 &amp; 3&nbsp;&#233;&copy</article>": "1 < 2 & 3 é©",
    "<article><p>a<script>var t='</p>';</script>b<style>p{}</style><!-- c -->c</article>": "a b c",
    "<div class='ad'>buy</div><main><div>x<div>y</div>z</div></main>": "x\n\ny\n\nz",
    "<article><p>a<aside>s</aside><form>f<input></form><p>b<div class='comments'><p>c</div><div id='cookie-notice'>k</div></article>": "a\n\nb",
    "<article><header><h1>H</h1></header><p hidden>h<p style='display: none'>n<p>t<footer>f</footer></article><header>x</header>": "H\n\nt",
    "<article><ul><li>one<li>two</ul><table><tr><td>1<td>2</table></article>": "one\n\ntwo\n\n1\n\n2",
    "<article><p>cut <a href='x": "cut", "<article><p>cut &am": "cut &am", "<article><p>a <b>b</article>c": "a b",
    "<article>1 < 2 and <3</article>": "1 < 2 and <3", "<article><p title='a>b'>x</article>": "x",
    "<article><p>a</article><div>between</div><article><p>b</article>": "a\n\nb", "<nav>only</nav>": "",
    "<div>" * 3000 + "deep": "deep",
}


@pytest.mark.parametrize("page", list(PAGES))
def test_page(page):
    assert H.extract([page]) == [PAGES[page]]


def test_template_slots_are_left_out():
    pages = [f"<body><div><p>Welcome to our site</p><p>{k} story {k}</p><p>more {k * k}</p></div>" for k in range(8)]
    assert H.extract(pages) == [f"{k} story {k}\n\nmore {k * k}" for k in range(8)]


def test_copies_and_few_pages_make_no_template():
    same = ["<article><p>one text</p><p>for all</p></article>"] * 20
    assert set(H.extract(same)) == {"one text\n\nfor all"}
    few = [f"<article><p>shared</p><p>{k}</p></article>" for k in range(H.VOTERS - 1)]
    assert H.extract(few) == [f"shared\n\n{k}" for k in range(H.VOTERS - 1)]


def test_tree_matching_is_the_largest():
    rng = random.Random(2)

    def tree(depth):
        node = H.Node(rng.choice("ab"))
        node.children = [tree(depth - 1) for _ in range(rng.randint(0, 3 if depth else 0))]
        return node

    def plain(a, b):
        if a.tag != b.tag:
            return 0

        @cache
        def best(i, j):
            if i == len(a.children) or j == len(b.children):
                return 0
            return max(best(i + 1, j), best(i, j + 1), best(i + 1, j + 1) + plain(a.children[i], b.children[j]))

        return 1 + best(0, 0)

    matcher, shapes = H.Matcher(), {}
    for _ in range(200):
        x, y = tree(3), tree(3)
        H._shaped(x, shapes)
        H._shaped(y, shapes)
        assert matcher.weight(x, y) == plain(x, y)


def direct(page):
    match = re.search(r"<article>(.*?)(</article>|\Z)", page, re.S)
    body = re.sub(r"<[^>]*\Z", "", match[1]) if match else ""
    parts = re.split(r"</?(?:p|h1)\b[^>]*>", body)
    texts = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", " ", p))).strip() for p in parts]
    return "\n\n".join(t for t in texts if t)


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = op8_html_extraction(spark, sf).collect()
    assert {r["page_id"]: r["text"] for r in rows} == {k: direct(p) for k, p in pages.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in rows)


def test_rows(spark):
    rows = [(1, None, None, "k"), (1, "http://a.org/x", "", "k"), (None, "no url", "<p>x", "k"), (2, "http://A.org:80/", "<article>é", "k")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = H.main_text(df)
    assert got.columns == ["page_id", "url", "html", "text"]
    assert sorted(r["text"] for r in got.collect()) == ["", "", "x", "é"]
    assert H.main_text(df.limit(0)).count() == 0


def test_blocks_of_a_large_host(spark, monkeypatch):
    df = spark.range(300).selectExpr("id AS page_id", "concat('https://one.org/', id) AS url", "concat('<article><p>t', id) AS html")
    assert {r["text"] for r in H.main_text(df).collect()} == {f"t{k}" for k in range(300)}
    monkeypatch.setattr(H, "MAX_BIG_HOSTS", -1)
    assert {r["text"] for r in H.main_text(df).collect()} == {f"t{k}" for k in range(300)}


NAMED = {
    "<body><div class='has-sidebar'><article><p>a</article></div>": "a", "<body><div class='no-sidebar'><p>a</div>": "a",
    "<body><div id='sidebar'><div><article><p>a</article></div></div>": "a", "<body><div class='content'><div class='menu'><h1>T</h1></div><p>a</div>": "T\n\na",
    "<article><div class='article-header'><h1>T</h1><p>by x</div><p>a</article>": "T\n\nby x\n\na",
    "<article><div class='search-results'><p>a</div><div class='post social-shares'><p>b</div></article>": "a\n\nb",
    "<article><div class='widget'><p>a</div><p class='notice'>b<p class='alert'>c<p class='side note'>d</article>": "a\n\nb\n\nc\n\nd",
    "<div class='overlay'><p>all the text of the page</div><p>more</p>": "all the text of the page\n\nmore",
    "<article><p>a long enough text<div class='box sidebar'><p>s</div><div class='ad-slot'>x</div><div class='related-posts'>y</div></article>": "a long enough text",
    "<article><p>a long enough text<div class='comments'><article>c</article></div></article><div class='related'><article>r</article></div>": "a long enough text",
    "<article><p>a long enough text</article><nav><h1>menu</h1></nav>": "a long enough text",
}


@pytest.mark.parametrize("page", list(NAMED))
def test_names_take_out_no_main_text(page):
    assert H.extract([page]) == [NAMED[page]]
