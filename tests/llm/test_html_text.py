"""Parsing by hand-made pages, main text of the given pages against their articles, and of layouts the trees have not seen."""

import html
import random
import re

import numpy as np

from barloom.llm import html_text
from barloom.llm.html_text import Page


def whole(source):
    page = Page(source)
    return page.text([True] * len(page.tag))


def test_parsing():
    assert whole("<p>a<b>b</b> &amp; c<p>d<br>e</p>f") == "ab & c d e f"
    assert whole("<ul><li>1<li>2<ul><li>3</ul></ul>&lt;x&gt; 1 < 2 &nbsp; 3") == "1 2 3 <x> 1 < 2 3"
    assert whole("<script>if (a < b) '</p>'</script>x<!-- y <p> -->z<style>q{}</STYLE >!<title>t") == "xz!"
    assert whole("<div title='a>b'>in</div><p class=x>un\nclosed <a href=\"/\">link</a> &copy; &#233; &#x1F600; <di") == "in un closed link © é 😀"
    assert whole("<table><tr><td><p>1<td>2<tr><th>3</table><h1>h</h1>t<h2>u") == "1 2 3 h t u"
    assert whole("") == "" and whole("plain") == "plain" and whole("<") == "<" and whole("</p></div>a") == "a"
    assert [Page("<p><b>x<p>y").tag, Page("<div><p>x<div>y").tag] == [["html", "p", "p"], ["html", "div", "p", "div"]]


def test_hostile_pages_end():
    for source in ("<" * 100_000, "<a " * 50_000, '<a b="' * 50_000, "<div>" * 50_000, "<p><b>" * 30_000, "</b>" * 50_000, "<!--" * 50_000, "<li>" * 50_000):
        whole(source)


def test_no_kept_node_lies_under_a_dropped_one():
    rng = np.random.default_rng(4)
    page = Page("".join(random.Random(3).choices(["<div>", "</div>", "<p>", "some text ", "<ul>", "<li>", "</ul>"], k=400)))
    n = len(page.tag)
    for _ in range(30):
        p = rng.random(n)
        kept = page.decode(p)
        assert kept[0] and all(kept[page.parent[i]] for i in range(1, n) if kept[i])
    small = Page("<div>aa<p>b</p><p>ccc</p></div><ul><li>d</ul>")
    n = len(small.tag)
    for _ in range(50):
        p = rng.random(n)
        w = 1 + np.log1p(np.array(small.own, float))

        def value(choice, p=p, w=w):
            return sum(w[i] * np.log(p[i] if choice[i] else 1 - p[i]) for i in range(1, n))

        options = [[True, *[bool(k >> i & 1) for i in range(n - 1)]] for k in range(2 ** (n - 1))]
        allowed = [c for c in options if all(c[small.parent[i]] for i in range(1, n) if c[i])]
        assert abs(value(small.decode(p)) - max(map(value, allowed))) < 1e-9


def article_text(source):
    inner = re.search(r"<article>(.*?)(</article>|\Z)", source, re.S).group(1)
    inner = re.sub(r"</?b>", "", re.sub(r"<(?:p|br|h1|/p|/h1)>", " ", inner))
    return " ".join(html.unescape(inner).split())


def test_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    source = {r["page_id"]: r["html"] for r in pages.collect()}
    got = html_text.extract(pages).collect()
    assert len(got) == len(source)
    assert all(r["text"] == article_text(source[r["page_id"]]) and r["n_chars"] == len(r["text"]) for r in got)


def test_unseen_layouts_and_odd_rows(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    rows = [(r["page_id"], r["url"], r["html"], 0) for r in pages]
    made = [(1000 + i, "u", html_text.restyled(r["html"], 77 * i + 5), 1) for i, r in enumerate(pages[:60])]
    odd = [(2000, "u", None, 0), (2001, None, "", 0), (None, "u", pages[0]["html"], 0), (2002, "u", pages[1]["html"], 0), (2002, "u", pages[1]["html"], 0)]
    df = spark.createDataFrame([(h, i, u, k) for i, u, h, k in rows + made + odd], "html string, page_id bigint, url string, text int")
    got = {r["page_id"]: r["text"] for r in html_text.extract(df).collect()}
    assert got[2000] == "" == got[2001] and got[None] == article_text(pages[0]["html"]) and got[2002] == article_text(pages[1]["html"])
    right = 0
    for i, _, h, _ in made:
        page = Page(h)
        right += got[i] == page.text([bool(x) for x in page.labels()])
    assert right >= 0.75 * len(made)


def test_no_rows(spark):
    assert html_text.extract(spark.createDataFrame([], "page_id bigint, url string, html string")).collect() == []
