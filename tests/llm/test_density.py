from __future__ import annotations

import html
import math
import re
from pathlib import Path

import pytest

from reviewloom.llm import density
from reviewloom.llm.density import main_text

LONG = "This is a sentence of the article that goes on for a while, as sentences of articles do."
AROUND = (
    "<html><head><title>T</title><script>var x = '<p>no</p>';</script></head><body><header><a href=/>Site</a></header>"
    "<nav><ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul></nav><div class='cookie-notice'>We use cookies. {0}</div>{1}"
    "<aside>See also {0}</aside><section id=comments><h2>Comments</h2><article class=comment><p>{0} {0}</article></section>"
    "<form><p>Your mail<input><button>Send</button></form><footer>&copy; nobody {0}</footer></body></html>"
).replace("{0}", LONG)


def page(article: str) -> str:
    return AROUND.replace("{1}", article)


@pytest.mark.parametrize(
    ("source", "text"),
    [
        (page(f"<article><h1>Title</h1><p><b>{LONG}<br><p>A &lt;b&gt; &amp; c.</article>"), f"Title\n\n{LONG}\n\nA <b> & c."),
        (page("<article><h1>Be.</h1><p>So.</article>"), "Be.\n\nSo."),
        (page(f"<div class=post><h1>Be.</h1><p>{LONG}<p>{LONG}<ul><li>one<li>two</ul><p>End.</div>"), f"Be.\n\n{LONG}\n\n{LONG}\n\none\n\ntwo\n\nEnd."),
        (page(f"<main><section><h2>A</h2><p>{LONG}</p></section><section><h2>B</h2><p>x  y\n\tz</section></main>"), f"A\n\n{LONG}\n\nB\n\nx y z"),
        (page(f"<article><header><h1>T</h1></header><p>{LONG}<div class='ad'>Buy</div><footer>by me</footer></article>"), f"T\n\n{LONG}"),
        (f"<body class='has-sidebar'><div id=content><article><p>{LONG}</article></div>", LONG),
        ("<p>only<p>text", "only\n\ntext"),
        ("plain &eacute; text", "plain é text"),
        ("<div hidden>x</div><nav>y</nav>", ""),
        ("<p>a < b and c > d, a<b", "a < b and c > d, a"),
        ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n\n2\n\n3"),
        ("<!-- <p>no --><p title='a>b'>yes</p><!-- never closed <p>no", "yes"),
        ("<p>cut off <a href='x", "cut off"),
        ("", ""),
        (None, ""),
    ],
)
def test_pages(source, text):
    assert main_text(source) == text


def plain_densities(node: dict, share: float) -> tuple[float, float]:
    """By recursion over nested nodes: (tag, [text or node])."""

    def count(n, linked):
        chars = links = tags = link_tags = 0
        for child in n["inside"]:
            if isinstance(child, str):
                size = len("".join(child.split()))
                chars, links = chars + size, links + size * (linked or n["tag"] == "a")
            else:
                c, lc, t, lt = count(child, linked or n["tag"] == "a")
                chars, links, tags, link_tags = chars + c, links + lc, tags + t + 1, link_tags + lt + (child["tag"] == "a")
        return chars, links, tags, link_tags

    def value(c, lc, t, lt):
        if c == 0:
            return 0.0
        t = max(t, 1)
        base = math.log(c / max(c - lc, 1) * max(lc, 1) + share * c + math.e)
        return c / t * math.log(max(1.0, c / max(lc, 1) * t / max(lt, 1)), base)

    own = sum(len("".join(c.split())) for c in node["inside"] if isinstance(c, str))
    children = [c for c in node["inside"] if not isinstance(c, str)]
    in_link = node["tag"] == "a"
    total = value(own, own * in_link, 1, 0) + sum(value(*count(c, in_link)) for c in children)
    return value(*count(node, False)), total


def test_densities_against_recursion():
    source = "<body><div>ab <a>link text</a> cd<p>para one</p><p>two <a>x</a></p></div><section><h2>hh</h2></section></body>"
    found = density.Page(source)
    nodes = [{"tag": t, "inside": []} for t in found.tags]
    seen = set()
    for node, text in found.items:
        if text is None and node not in seen:
            seen.add(node)
            nodes[found.parents[node]]["inside"].append(nodes[node])
        elif text is not None:
            nodes[node]["inside"].append(text)
    body = found.tags.index("body")
    share = len("linktextx") / len("ablinktextcdparaonetwoxhh")
    value, total = density.densities(found, [False] * len(nodes))
    for node in range(body, len(nodes)):
        if found.tags[node] != "a":  # links are measured from outside below
            assert (value[node], total[node]) == pytest.approx(plain_densities(nodes[node], share)), found.tags[node]


@pytest.mark.parametrize(
    "source",
    ["<div>" * 60_000 + "deep", "<p><table>" + "<div>" * 40_000, "<b><div>" + "<span>" * 20_000 + "</b>" * 20_000, "<" * 100_000,
     '<a "' * 50_000, "<!--" * 100_000, "<ul>" + "<li>x" * 40_000, "</p>" * 100_000, "&" * 500_000, "<script>" * 50_000],
)
def test_hostile_pages_take_linear_time(source):
    main_text(source)


def test_rows(spark):
    rows = [(1, "u", page(f"<article><p>{LONG}</article>")), (2, None, None), (2, None, None), (None, "v", "<p>" + "word " * 200_000), (3, "", "")]
    schema = "page_id long, url string, html string, text string, n_chars string"
    pages = spark.createDataFrame([(*r, "clash", "x") for r in rows], schema).repartition(3)
    out = sorted(map(tuple, density.extract_pages(pages).collect()), key=repr)
    long = ("word " * 200_000).strip()
    want = [(1, "u", LONG, len(LONG)), (2, None, "", 0), (2, None, "", 0), (3, "", "", 0), (None, "v", long, len(long))]
    assert out == sorted(want, key=repr)
    assert density.extract_pages(pages.where("1 = 0")).collect() == []


def test_the_tables_articles(spark):
    """On pages whose article is marked, the text is the whole of it and nothing else."""
    folder = Path("/root/testdata/sf0.001/pages.parquet")
    if not folder.exists():
        pytest.skip("no benchmark tables here")
    for row in density.extract_pages(spark.read.parquet(str(folder))).join(spark.read.parquet(str(folder)).select("page_id", "html"), "page_id").collect():
        inside = re.search(r"<article>(.*?)(</article>|$)", row.html, re.S)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inside)]
        assert row.text == "\n\n".join(b for b in blocks if b)
