from __future__ import annotations

import html
import math
import random
import re
import time

import pytest

from tillflow.llm import style_tree
from tillflow.llm.style_tree import Page, main_text

CASES = [
    ("<article><h1>T</h1><p>a  b\n c</p><p>d</p></article>", "T a b c d"),
    ("<nav>menu</nav><main><p>x<b>y</b>z<br>w</p></main><footer>f</footer>", "xyz w"),
    ("<p>one<p>two", "one two"),
    ("<article><p>text</p><div class='share-buttons'>share</div><section id='comments'><p>first!</p></section></article>", "text"),
    ("<article><p>a &amp; b &lt;c&gt; &#233;&nbsp;&copy;</p></article>", "a & b <c> é ©"),
    ("<script>var a='</p><article>';</script><article>ok</article>", "ok"),
    ("<body><header>Site</header><div class='sidebar'>s</div><p>text</p><aside>x</aside><form>q<input></form></body>", "text"),
    ("<article><p>cut off here</p></artic", "cut off here"),
    ("<article><p>a < b and <!-- no --> c</p><style>p{}</style></article>", "a < b and c"),
    ("<article><p><b>open<br><p>next</p></article><footer>f", "open next"),
    ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>", "a b c d"),
    ("<article><p hidden>no</p><div style='display: none'>no</div><p>yes</p></article>", "yes"),
    ("<ARTICLE><P CLASS=lead>Up</P></ARTICLE>", "Up"),
    ("<article></article><p>outside</p>", "outside"),
    ("", ""), ("plain words", "plain words"), ("<", "<"), ("<p", ""),
]


@pytest.mark.parametrize("page,want", CASES)
def test_one_page(page, want):
    assert " ".join(Page(page).main_blocks()) == want


def test_site_learns_its_notice(spark):
    pages = [
        (i, "https://a.example.com/%d" % i, f"<body><div class='x1'><p>Same words on every page</p></div><div class='x2'><p>Own words {i} here</p></div></body>")
        for i in range(12)
    ]
    pages += [(100 + i, "https://b.example.com/%d" % i, "<body><div class='x1'><p>Same words on every page</p></div></body>") for i in range(3)]
    pages += [(200, None, None), (201, None, ""), (None, "no url", "<p>kept</p>"), (5, pages[5][1], pages[5][2])]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string").selectExpr("*", "1 AS host", "2 AS row", "'t' AS text", "3 AS key").repartition(4)
    got = main_text(df)
    assert got.columns == ["page_id", "url", "text"]
    found = sorted(((r["page_id"], r["text"]) for r in got.collect()), key=repr)
    want = [(i, f"Own words {i} here") for i in range(12)] + [(5, "Own words 5 here")]
    want += [(100 + i, "Same words on every page") for i in range(3)] + [(200, ""), (201, ""), (None, "kept")]
    assert found == sorted(want, key=repr)


def test_page_of_low_importance_alone_is_kept(spark):
    same = "<body><div class='x1'><p>All the same</p></div><p>%s</p></body>"
    pages = [(i, "http://a.example/", same % i) for i in range(9)] + [(9, "http://a.example/", same % "")]
    got = {r["page_id"]: r["text"] for r in main_text(spark.createDataFrame(pages, "page_id bigint, url string, html string")).collect()}
    assert got[3] == "3" and got[9] == "All the same"


def test_empty_table(spark):
    assert main_text(spark.createDataFrame([], "page_id bigint, url string, html string")).collect() == []


def test_given_pages(spark):
    """The pages of the test tables have one article of headings and paragraphs."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: r["text"] for r in main_text(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        plain = re.sub(r"<[^>]*>", "", re.sub(r"<br>|</?(?:p|h1)>", " ", article))
        assert got[r["page_id"]] == " ".join(html.unescape(plain).split())


def test_importance(spark):
    rows = [("h", i, 7, 1, i // 4) for i in range(8)] + [("h", 0, 7, 1, 0)] * 5 + [("h", 0, 8, 1, 1)]
    df = spark.createDataFrame(rows, "host string, page bigint, path bigint, shown bigint, said bigint")
    got = {r["path"]: (r["pages"], round(r["importance"], 6)) for r in style_tree.importance(df).collect()}
    # eight pages, presented alike, with two contents of four pages each: ln 2 / ln 8
    assert got == {7: (8, round(1 / 3, 6)), 8: (1, 1.0)}


def test_repeated_line_among_own_paragraphs(spark):
    """A line that is the same on every page of a host goes, whatever its element, inside articles and outside; own texts stay."""
    for around in ("<article>%s</article>", "<body>%s</body>"):
        for line in ("<p>All rights reserved</p>", "<ul><li>All rights reserved</li></ul>", "<table><tr><td>All rights reserved</td></tr></table>", "<blockquote>All rights reserved</blockquote>"):
            page = lambda i: around % (f"<h1>Title {i}</h1>" + "".join(f"<p>Words {i} {k}</p>" for k in range(1 + i % 3)) + line)  # noqa: E731, B023
            pages = [(i, f"https://a.example/{i}", page(i)) for i in range(8)] + [(100 + i, f"https://b.example/{i}", page(i)) for i in range(3)]
            got = {r["page_id"]: r["text"] for r in main_text(spark.createDataFrame(pages, "page_id bigint, url string, html string")).collect()}
            own = lambda i: " ".join([f"Title {i}", *(f"Words {i} {k}" for k in range(1 + i % 3))])
            assert got == {i: own(i) for i in range(8)} | {100 + i: own(i) + " All rights reserved" for i in range(3)}


@pytest.mark.parametrize("page,want", [
    ("<article style='overflow:hidden'><p>text</p></article>", "text"),
    ("<main class='overflow-hidden' data-state=\"hidden\"><p>text</p></main>", "text"),
    ("<article><p hidden>no</p><p hidden=''>no</p><p style='color:red; DISPLAY : none !important'>no</p><p class='hidden'>no</p><p>yes</p></article>", "yes"),
    ("<div class='no-sidebar has-menu' id='search-result'><article><p>text</p></article></div>", "text"),
    ("<div class='no-sidebar'><p>text</p></div><div class='sidebar'>side</div>", "text"),
    ("<div class='menu-page'><nav>menu</nav><p>skip</p><article><p>the text of the page</p><div class='share'>share</div></article></div><p>x</p>", "the text of the page"),
    ("<form id='aspnetForm'><nav>menu</nav><article><p>text</p></article></form>", "text"),
    ("<article><p>text</p></article><div class='related'><article><p>teaser, longer than the text</p></article></div>", "text"),
    ("<div><p>text</p></div><aside><article><p>teaser, longer than the text</p></article></aside>", "text"),
    ("<div class='popup'><p>all there is</p></div>", "all there is"),
    ("<div hidden><p>no</p></div>", ""),
])
def test_names_weigh_and_do_not_delete(page, want):
    assert " ".join(Page(page).main_blocks()) == want


@pytest.mark.parametrize("page,want", [
    ("<html><head><title>x</title><body><p>text</p>", "text"),
    ("<head><meta charset=utf-8><title>x</title><style>p{}</style><link rel=a href=b><p>text", "text"),
    ("<head><title>x</title>bare text<p>more", "bare text more"),
    ("<head><title>x</title><b>bold</b> text", "bold text"),
    ("<head><title>x</title></head><body><article>text</article>", "text"),
])
def test_head_without_end(page, want):
    assert " ".join(Page(page).main_blocks()) == want


@pytest.mark.parametrize("page,want", [
    ("<body><svg class=icon /><article><p>text</p></article>", "text"),
    ("<svg viewBox='0 0 1 1'><title>icon</title><path d='M0'/><g><text>label</text></g></svg><p>text</p>", "text"),
    ("<p>a</p><svg><path d='M0'><p>b</p><p>c</p>", "a b c"),
    ("<svg><svg><text>x</text></svg><text>y</text></svg><p>text</p>", "text"),
    ("<article><p>where <math><msup><mi>x</mi><mn>2</mn></msup><mo>+</mo><mi>y</mi></math> holds</p></article>", "where x2+y holds"),
    ("<article><p>a</p><math/><p>b</p></article>", "a b"),
    ("<article><object data=x><param name=y><p>fallback</p></object><p>text</p></article>", "fallback text"),
    ("<article><object data=x><p>a</p></article>", "a"),
    ("<svg><title/><style/><path/></svg><p>text</p>", "text"),
    ("<template><p>no</p></template><p>text</p>", "text"),
    ("<article><p>a</p><select><option>no<option>no</select><p>b</p></article>", "a b"),
    ("<div><select><option>no</div><p>text</p>", "text"),
])
def test_drawings_formulas_and_fallbacks(page, want):
    assert " ".join(Page(page).main_blocks()) == want


@pytest.mark.parametrize("page,want", [
    ("<p title=o'clock>It's raining today.</p><p>b</p>", "It's raining today. b"),
    ('<b class="x" ">bold</b> text', "bold text"),
    ('<p title="abc>hello</p><p>there</p>', "hello there"),
    ("<p title='abc>hello", "hello"),
    ("<p a=1 b = 'x > y' c=\"it's\" d>text</p>", "text"),
    ("<p a=b/c/>text", "text"),
    ("<p =x>text</p><p a==b>more</p>", "text more"),
    ("a <1 b </ c <> d", "a <1 b </ c <> d"),
    ("<p>&#" + "9" * 5000 + "; and &#x" + "f" * 5000 + " &amp;</p>", "\ufffd and \ufffd &"),
    ("text <!-- never closed", "text"), ("text <!doctype", "text"), ("<script>never closed <p>text</p>", ""),
])
def test_attributes_and_odd_markup(page, want):
    assert " ".join(Page(page).main_blocks()) == want


@pytest.mark.parametrize("piece,end", [
    ("<a ", ""), ("<div>", "text"), ("<form>", "text"), ("<dl><dd>", "text"), ("<p title=\"", ""), ("<p title='x", ""), ("</x>", "text"), ("<x><div></y>", "text"), ("<p>a", ""), ("<li>", "text"),
    ("<!--", ""), ("<script>", ""), ("<article><div></article>", ""), ("&#9", ""), ("&amp", ""), ("< ", ""), ("<b a", ""), ("<p a= ", ""), ("<table><tr><td>", "text"), ("<svg><p>", "text"), ("<div class='a b'>x", ""),
])
def test_hostile_pages_take_time_as_their_length(page_seconds, piece, end):
    page = piece * (1_000_000 // len(piece)) + end
    assert page_seconds(page) < 30


@pytest.fixture
def page_seconds():
    def measure(page):
        start = time.process_time()
        Page(page).main_blocks()
        return time.process_time() - start

    return measure


def plain(pages, least=style_tree.LEAST_IMPORTANCE):
    """Texts by counting every node of every page of a host, with lists of texts for contents."""
    hosts = {}
    for number, (_, url, markup) in enumerate(pages):
        host = re.match(r"https?://([^/]+)", url or "")
        hosts.setdefault(host[1] if host else "", []).append((number, Page(markup or ""), markup or ""))
    entropy = lambda values: 1.0 if len(values) < 2 else -sum(values.count(v) / len(values) * math.log(values.count(v) / len(values)) for v in set(values)) / math.log(len(values))
    smooth = lambda x, n: (n * x + 1) / (n + 1)
    texts = {}
    for own in hosts.values():
        distinct = {markup: page for _, page, markup in own}
        says, shows, leaves = {}, {}, {}
        for markup, page in distinct.items():
            content, children = {}, {}
            for _, weight, node, _, text in page.blocks:
                up = page.containers[node]
                while up is not None:
                    if up.weight == weight:
                        content.setdefault(id(up), []).append(text)
                    up = up.parent
            paths = {c.path for c in page.containers}
            for element in page.elements:
                if element.path in paths:
                    says.setdefault(element.path, {}).setdefault(markup, []).extend(content.get(id(element), []))
                    shows.setdefault(element.path, {}).setdefault(markup, []).extend(element.children)
            for _, _, node, _, text in page.blocks:
                leaves.setdefault(page.containers[node].path, {}).setdefault(text, set()).add(markup)
        worth = {p: smooth(max(entropy([tuple(v) for v in says[p].values()]), entropy([tuple(v) for v in shows[p].values()])), len(says[p])) for p in says}
        for number, page, _ in own:
            rows = []
            for article, weight, node, _, text in page.blocks:
                element = page.containers[node]
                m, n = len(says[element.path]), len(leaves[element.path][text])
                score, up = smooth(1 - math.log(n) / math.log(m) if m > 1 else 1.0, m), element
                while up is not None:
                    score, up = min(score, worth[up.path]), up.parent
                rows.append((article, weight * (score if score < least else 1.0), text))
            texts[number] = " ".join(style_tree.chosen(rows))
    return [texts[i] for i in range(len(pages))]


def sites(seed):
    """Hosts whose menus, notices and licence lines repeat, with and without names and articles."""
    draw, pages = random.Random(seed), []
    for host in range(7):
        menu = "".join(f"<li><a href='/{k}'>Item {host} {k}</a></li>" for k in range(4))
        article = draw.random() < 0.4
        for i in range(draw.choice([1, 2, 3, 5, 9, 14])):
            own = "".join(f"<p>Own {draw.randrange(10**6)} words <b>{i}</b>" for _ in range(draw.randrange(1, 4)))
            parts = [f"<div class='top'><ul>{menu}</ul></div>", f"<article>{own}</article>" if article else f"<div class='body'>{own}</div>", "<p>All rights reserved", f"<div class='{draw.choice(['ad', 'box'])}'>Buy {draw.randrange(3)}</div>"]
            pages.append((len(pages), f"http://h{host}.example/{i}", "<html><body>" + "".join(p for p in parts if draw.random() < 0.9)))
    return pages + [pages[0], pages[1], (None, None, "<p>x"), (5000, None, None), (5001, "no address", "")]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_whole_operator_against_plain_counts(spark, seed):
    pages = sites(seed)
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string").repartition(3)
    got = sorted(((r["page_id"], r["text"]) for r in main_text(df).collect()), key=repr)
    want = plain(pages)
    assert got == sorted(((p[0], t) for p, t in zip(pages, want, strict=True)), key=repr)
    # names and articles alone leave the repeated parts in
    alone = [" ".join(Page(markup or "").main_blocks()) for *_, markup in pages]
    assert sum(a != b for a, b in zip(alone, want, strict=True)) > len(pages) / 4
