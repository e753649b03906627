"""Layout wrappers with boilerplate words in their names."""

import random
import time

import pytest

from vigor.llm import html_text
from vigor.llm.html_text import parse


@pytest.mark.parametrize("source", [
    "<div class='content-sidebar-wrap'><p>x</p><main>the text</main></div>",
    "<div class='has-sidebar'><article>the text</article></div>",
    "<div class='content-sidebar-wrap'><article>the text</article></div>",
    "<article class='post no-comments'>the text</article>",
    "<article class='post share'>the text</article><p>rest</p>",
    "<div id='skip-target'><article>the text</article></div>",
    "<div class='social'><div itemprop='articleBody'>the text</div></div>",
    "<div class='widget' role='main'>the text</div>",
    "<main>the text<div class='related'><article>teaser</article></div><article class='comment'>no</article></main>",
    "<article>the text</article><div id='comments'><article>a comment that is longer</article></div>",
])
def test_wrappers_keep_their_article(source):
    page = parse(source)
    assert page.has_article and " ".join(x for x, inside in page.lines if inside) == "the text"


def test_teasers_do_not_stand_for_the_page():
    page = parse("<div id='content'><p>a long text of the page</p></div><div class='related'><article>teaser</article></div>")
    assert not page.has_article and page.lines == [("a long text of the page", False)]
    assert parse("<nav><main>menu</main></nav><div class='has-sidebar'>kept</div>").lines == [("kept", False)]


def test_copies_keep_their_text(spark):
    plain = "<body><div>Menu of host</div><p>{}</p><div>All rights</div></body>"
    long = "a passage of some length that no other page of the host has, " * 5
    rows = [(i, f"http://h.x/a?q={i}", plain.format("the same text")) for i in range(150)]  # more than a run
    rows += [(200, "http://h.x/b", plain.format("another text")), (201, "http://h.x/b", plain.format("another text"))]
    rows += [(300 + i, f"http://near.x/{i}", plain.format(f"{long}<p>{i}")) for i in range(3)]  # near copies only
    rows += [(400, "http://alone.x/1", plain.format("twice")), (401, "http://alone.x/2", plain.format("twice"))]
    rows += [(500, "http://mix.x/1", plain.format(f"{long}<p>1")), (501, "http://mix.x/2", plain.format(f"{long}<p>2")),
             (502, "http://mix.x/3", plain.format("short one"))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    got = {r["page_id"]: r["text"] for r in html_text.extract(df).collect()}
    whole = "Menu of host {} All rights"
    want = {i: "the same text" for i in range(150)} | {200: "another text", 201: "another text"}
    want |= {300 + i: whole.format(f"{long}{i}") for i in range(3)} | {400: whole.format("twice"), 401: whole.format("twice")}
    want |= {500: f"{long}1", 501: f"{long}2", 502: "short one"}
    assert got == want


@pytest.mark.parametrize("source,text", [
    ("<article><p class='ad'>Buy now<p>Real text</article>", "Real text"),
    ("<article><ul><li class='share'>Share<li>Real item</ul></article>", "Real item"),
    ("<html><head><title>T</title><body><main>Real text", "Real text"),
    ("<html><head><meta charset=x><title>a <p> b</title><link rel=x><p>One<p>Two<div>Three</div>", ""),
    ("<main><dl><dt class='ad'>No<dd>Yes<dt>Also<dd class='promo'>Not</dl>End</main>", "Yes Also End"),
    ("<main><table><tr><td class='ad'>x<td>one<tr><td>two<th class='share'>y<tbody><tr><td>three</table>four</main>", "one two three four"),
    ("<article><p>a<table><tr><td><p>b<p class='ad'>c</table>d</article>", "a b d"),
    ("<article><h2 id='related-work'>Related work</h2><section id='social-impact'>Impact</section><p class='comment-on-law'>Law</article>", "Related work Impact Law"),
    ("<article><div class='related-posts'>x</div><div id='share'>y</div><div class='ad-2'>z</div><p class='social-links'>u</p><p>Text</article>", "Text"),
    ("<main><ul><li>a<ul><li class='ad'>b<li>c</ul>d<li>e</ul></main>", "a c d e")])
def test_omitted_end_tags_and_names(source, text):
    assert " ".join(x for x, inside in parse(source).lines if inside) == text


def test_text_does_not_depend_on_where_runs_begin(spark, monkeypatch):
    """Copies fill more than a run; the pages beside them still find their neighbour."""
    monkeypatch.setattr(html_text, "RUN", 8)
    page = "<body><div>Menu of the host</div><p>{}</p><div>All rights reserved here</div></body>"
    rows = [(i, f"http://h.x/{i:03d}", page.format(f"text number {i}" if i % 10 == 0 else "the very same long text of a copy " * 9 + str(i))) for i in range(60)]
    got = []
    for skip in range(3):
        df = spark.createDataFrame(rows[skip:], "page_id long, url string, html string")
        got.append({r["page_id"]: r["text"] for r in html_text.extract(df).collect()})
    for i in range(20, 40):
        assert got[0][i] == got[1][i] == got[2][i]
        assert not i % 10 == 0 or got[0][i] == f"text number {i}"


def test_articles_are_differenced(spark):
    """What most neighbours share at a place of its own goes from a container too; quotations and repeated cells stay."""
    page = ("<body><div class='x'>Advert {ad}</div><main><ul class='tools'><li>Print this page<li>Send it by mail</ul>"
            "<h1>Report {i}</h1><p>the text of page {i} and more of it{quote}<table><tr><td>{cell}</table></main>")
    quote = "<p>a passage that some of the articles quote word by word"
    rows = [(i, f"http://h.x/{i:02d}", page.format(i=i, ad=i % 5, quote=quote if i % 3 == 0 else "", cell=("rain", "sun")[i % 2])) for i in range(24)]
    rows += [(100 + i, f"http://few.x/{i}", page.format(i=i, ad=1, quote="", cell="rain")) for i in range(4)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_text.extract(df).collect()}
    text = "Report {i} the text of page {i} and more of it{quote} {cell}"
    want = {i: text.format(i=i, quote=quote.replace("<p>", " ") if i % 3 == 0 else "", cell=("rain", "sun")[i % 2]) for i in range(24)}
    want |= {100 + i: "Print this page Send it by mail " + text.format(i=i, quote="", cell="rain") for i in range(4)}  # too few to tell
    assert got == want


def test_places_decide_without_a_container(spark):
    """Adverts that rotate go, quotations stay, and copies that differ by their adverts keep their text."""
    page = "<body><div class='x'>Advert of the week, number {ad}</div><p>{text}</p><div class='y'>Footer number {foot}</div></body>"
    quote = "</p><p>a passage that some of the articles quote word by word"
    texts = [f"the text of page {i} and more words about number {i}{quote if i % 3 == 0 else ''}" for i in range(30)] + ["the same short text"] * 30
    rows = [(i, f"http://h.x/{i:02d}", page.format(ad=i * 7 % 6, foot=i * 5 % 4, text=x)) for i, x in enumerate(texts)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r["page_id"]: r["text"] for r in html_text.extract(df).collect()}
    assert got == {i: x.replace("</p><p>", " ") for i, x in enumerate(texts)}


def test_blocks_tell_place_and_standing():
    page = parse("<body><nav class='top post-12'><a>menu</a></nav><div>outside</div><main><p>in")
    assert [(x, stands) for x, _, stands in page.blocks] == [("menu", html_text.IN_BOILER), ("outside", html_text.OUTSIDE), ("in", html_text.INSIDE)]
    places = [[place for _, place, _ in parse(f"<body>{x}").blocks] for x in ("<nav class='post-7 top'>a</nav><nav>b</nav>", "<div>c<p>d")]
    assert places[0][0] == page.blocks[0][1] != places[0][1] and places[1][0] == page.blocks[1][1] != places[1][1]


def test_lines_that_repeat_are_aligned_as_well(monkeypatch):
    """Tables of few different cells: bit vectors give a longest common subsequence too, in time."""
    rnd = random.Random(3)
    a, b = ([rnd.choice("abc") for _ in range(3000)] for _ in range(2))
    start = time.perf_counter()
    got = html_text.common_lines(a, b)
    assert time.perf_counter() - start < 0.5
    rest = iter(b)
    assert all(x in rest for x in [a[i] for i in sorted(got)])
    for _ in range(300):
        a, b = ([rnd.choice("abc") for _ in range(rnd.randint(0, 30))] for _ in range(2))
        monkeypatch.setattr(html_text, "DENSE", 1 << 30)
        listed = html_text.common_lines(a, b)
        monkeypatch.setattr(html_text, "DENSE", 0)
        dense = html_text.common_lines(a, b)
        rest = iter(b)
        assert len(dense) == len(listed) and all(x in rest for x in [a[i] for i in sorted(dense)])
