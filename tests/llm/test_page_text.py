"""Page text against plain alignments, and against whole made-up sites."""

import html as references
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sampleflow.llm.page_text import GONE, KEPT, OPEN, common_lines, differences, main_text, page_lines

KIND = "page_id long, url string, html string, text string, gone binary, host string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "t", b"g", "h") for r in rows], KIND).repartition(3)


def texts(df):
    return sorted(((r.page_id, r.url, r.text) for r in df.collect()), key=repr)


def plain_lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=40), st.lists(st.integers(0, 5), max_size=40))
def test_alignment(a, b):
    found = common_lines(a, b)
    picked = iter(b)
    assert all(x in picked for x in (a[i] for i in found)) and len(set(found)) == len(found) == plain_lcs(a, b)


def test_long_alignment():
    a, b = ["x"] * 20_000, ["x"] * 9_000 + ["y"] * 5_000
    assert len(common_lines(a + ["z"], b + ["z"])) == 9_001


@pytest.mark.parametrize(
    "page, want",
    [
        ("", []),
        ("a &lt; b &amp;amp; &eacute;&#233;&#x1F600; 1 < 2", [("a < b &amp; éé😀 1 < 2", OPEN)]),
        ("<p>a\n b&nbsp;c<br>d<p>e", [("a b c d", OPEN), ("e", OPEN)]),
        ("<body><nav><ul><li>m</ul></nav><article><h1>T</h1><p><b>x.<br><p>y</article><footer>f", [("m", GONE), ("T", KEPT), ("x.", KEPT), ("y", KEPT), ("f", GONE)]),
        ('<div class="ad">ad<div>in</div></div>text<div id="comments-list">c</div><div class="no-sidebar">t</div>', [("ad", GONE), ("in", GONE), ("text", OPEN), ("c", GONE), ("t", OPEN)]),
        ("<form action='>'>f<main><p>m</main></form><p>o", [("f", GONE), ("m", KEPT), ("o", GONE)]),
        ("<script>var t='</p>';</SCRIPT >a<style>p{}</style>b<!-- <p>no -->c<!DOCTYPE x>", [("abc", OPEN)]),
        ("<article><header>h</header>t<footer>f</footer></article><section class=comments><article>c</article></section>", [("h", KEPT), ("t", KEPT), ("f", GONE), ("c", GONE)]),
        ("<script>never closed <p>x", []),
        ("text <a href='unclosed", [("text", OPEN)]),
        ("<html class='has-menu'><body class=sidebar><div>x</div></nav></body>", [("x", OPEN)]),
        ("<div role=Navigation>n</div><p>" + "<b>" * 3000 + "deep" + "</i>" * 3000, [("n", GONE), ("deep", OPEN)]),
    ],
)
def test_lines(page, want):
    assert page_lines(page) == want


def site(host, n, seed, frame_lines):
    """Pages without an article: their own lines between lines that all share."""
    pick = random.Random(seed)
    rows, want = [], []
    for i in range(n):
        own = [f"{host} own {i} {k} {pick.random()}" for k in range(pick.randint(1, 4))]
        body = [*frame_lines[:2], *own, *frame_lines[2:]]
        rows.append((i, f"http://{host}/a/{i}", "".join(f"<div>{references.escape(line)}</div>" for line in body)))
        want.append((i, f"http://{host}/a/{i}", "\n\n".join(own)))
    return rows, want


def test_frames(spark):
    lines = ["Home & more", "All about us", "Contact", "Legal <notice>"]
    rows, want = site("h.example", 30, 1, lines)
    more, others = site("other.example", 3, 2, ["Menu", "x", "y"])
    alone = (100, "http://alone/", "<div>Menu</div><div>text</div>")
    assert texts(main_text(frame(spark, [*rows, *more, alone]))) == sorted([*want, *others, (100, "http://alone/", "Menu\n\ntext")], key=repr)


def test_copies_stay(spark):
    """Copies of a page and articles that repeat a line do not delete each other."""
    copy = "".join(f"<p>line {i}</p>" for i in range(12))
    rows = [(1, "http://h/a", copy), (2, "http://h/b", copy), (2, "http://h/b", copy), (3, "http://h/c", copy + "<p>one more</p>")]
    article = "<nav>menu</nav><article><p>same</p><p>text</p></article>"
    rows += [(4, "http://g/a", article), (5, "http://g/b", article + "<p>out"), (6, "http://g/c", "<p>same</p><p>other</p><p>third</p>")]
    got = texts(main_text(frame(spark, rows)))
    whole = "\n\n".join(f"line {i}" for i in range(12))
    assert [t for _, _, t in got] == [whole, whole, whole, whole + "\n\none more", "same\n\ntext", "same\n\ntext", "other\n\nthird"]


def article(lines):
    return "<nav>menu</nav><article>" + "".join(f"<p>{references.escape(line)}</p>" for line in lines) + "</article><footer>f</footer>"


def test_frames_of_articles(spark):
    """Lines that all articles of a host or section share go; quoted lines, copies and few pages lose nothing."""
    rows, want = [], []

    def page(url, own, above=(), below=()):
        rows.append((len(rows), url, article([*above, *own, *below])))
        want.append((len(rows) - 1, url, "\n\n".join(own)))

    for i in range(24):
        own = [f"own {i} {k}" for k in range(4)]
        if i % 2:
            own.insert(2, "a licence & more")
        page(f"http://h.example/{'ab'[i > 11]}/{i}", own, ["Home > News"], ["Share <this>"] + ["Only in b"] * (i > 11))
    for i in range(6):
        page(f"http://h.example/a/7-copy{i}", ["own 7 0", "own 7 1", "a licence & more", "own 7 2", "own 7 3"], ["Home > News"], ["Share <this>"])
    for i in range(20):
        page(f"http://copies.example/{i}", ["title", "text", f"version {i}"])
    for i in range(7):
        page(f"http://few.example/{i}", ["same", *(f"few {i} {k}" for k in range(5))])
    for i in range(12):
        page(None, ["same", *(f"nowhere {i} {k}" for k in range(5))])
    assert texts(main_text(frame(spark, [*rows, *rows[:30]]))) == sorted([*want, *want[:30]], key=repr)


def test_every_page_is_compared(spark):
    """Blocks of the order meet: the nearest pages are those of the whole order, for pages with an article too."""
    rows = [(i, f"http://h/{i:04}", article([f"{i} {k}" for k in range(3)] + [f"pair {i // 2}"])) for i in range(150)]
    pages = frame(spark, rows).withColumn("page_hash", F.unhex(F.md5("html")))
    found = {r.page_id: r for r in differences(pages.select("page_id", "url", "page_hash", "html")).collect()}
    assert len(found) == 150 and all(r.met for r in found.values())
    got = {i: [(x.i, x.vote) for x in r.repeated] for i, r in found.items()}
    # The earlier neighbour comes first, so only the later one of a pair meets the other there.
    assert got == {i: [(4, True)] if i % 2 or i == 0 else [] for i in range(150)}


def test_edges(spark):
    long = "<p>" + "word " * 200_000 + "</p>" + "<p>x</p>" * 5000
    rows = [(1, None, None), (None, "http://h/", ""), (2, "no scheme", "<p>a"), (2, "no scheme", "<p>a"), (None, None, "<p>b"), (3, "http://h/l", long)]
    got = {(i, u, t) for i, u, t in texts(main_text(frame(spark, rows)))}
    assert got == {
        (1, None, ""), (None, "http://h/", ""), (2, "no scheme", "a"), (None, None, "b"),
        (3, "http://h/l", "word " * 199_999 + "word" + "\n\nx" * 5000),
    }
    assert main_text(frame(spark, rows)).count() == len(rows) and main_text(frame(spark, rows).where("false")).collect() == []


def test_given_pages(spark):
    """On the given pages all text stands in one article: a plain reading of that form must agree."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = []
    for r in pages.collect():
        body = re.search(r"<article>(.*?)</article>", r.html, re.DOTALL)[1]
        blocks = (" ".join(references.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", body))
        want.append((r.page_id, r.url, "\n\n".join(b for b in blocks if b)))
    assert texts(main_text(pages)) == sorted(want, key=repr)
