"""Page parsing on hand-written markup."""

from barloom.operators import pages, readable

LONG = "word " * 100


def parse(spark, html, url, **options):
    row = pages.extract(spark.createDataFrame([(1, url, html)], "page_id long, url string, html string"), **options).head()
    return row.title, row.text, row.image


def test_structured_data_first(spark):
    html = (
        '<html><head><title> A  &amp; B </title><script type="application/ld+json">{"@graph": [{"@type": "NewsArticle", "articleBody": "'
        + LONG
        + '", "image": {"url": "/lead.jpg"}}]}</script></head><body><article>short</article></body></html>'
    )
    title, text, image = parse(spark, html, "https://x.example/a/b")
    assert (title, text, image) == ("A & B", LONG.strip(), "https://x.example/lead.jpg")


def test_article_then_paragraphs(spark):
    html = f"<body><nav>menu</nav><article><h1>Head</h1><p>One<script>var x = '</p>';</script> two</p></article><p>{LONG}</p><p>end</body>"
    _, text, _ = parse(spark, html, "https://x.example/")
    assert text.startswith("One two word") and text.endswith("end") and "menu" not in text and "var x" not in text
    _, text, _ = parse(spark, f"<body><main>{LONG}<b>tail</b></main><p>other</p></body>", "")
    assert text == LONG + "tail"
    assert parse(spark, "<body><article>only &lt;this&gt;</article></body>", "")[1] == "only <this>"


def test_broken_structured_data_is_skipped(spark):
    html = '<script type="application/ld+json">{broken</script><article>fine</article>'
    assert parse(spark, html, "")[1] == "fine"


def test_image_order_and_filters(spark):
    html = """<head><meta property="og:image" content="https://x.example/logo.png"><meta name="twitter:image" content=" pic.jpg ">
    <link rel="image_src" href="/other.jpg"></head><body><img src="data:image/png;base64,xx"><img srcset="/s1.jpg 1x, /s2.jpg 2x"></body>"""
    assert parse(spark, html, "https://x.example/d/")[2] == "https://x.example/d/pic.jpg"
    assert parse(spark, '<img src="/favicon.ico"><img data-src="/a.jpg" src="/b.jpg">', "https://x.example")[2] == "https://x.example/a.jpg"
    assert parse(spark, '<img srcset="/s1.jpg 1x, /s2.jpg 2x">', "https://x.example")[2] == "https://x.example/s1.jpg"
    assert parse(spark, "<p>none</p>", "")[2] is None


def test_wide_pattern_is_an_argument(spark):
    html = '<img src="/avatar.jpg"><img src="/lead.jpg">'
    assert parse(spark, html, "https://x.example")[2] == "https://x.example/avatar.jpg"
    assert parse(spark, html, "https://x.example", bad=pages.BAD_IMAGE[:-1] + "|avatar)")[2] == "https://x.example/lead.jpg"


def test_references_and_edges(spark):
    assert parse(spark, "<article>&#233; &#x1F600; &amp;lt; &hellip; a&nbsp;b &copy</article>", "")[1] == "é 😀 &lt; … a b ©"
    assert parse(spark, "<article>&#x10FFFF;&#x110000; &#xD800; &#0; &#1114111; &copyright &amp;amp; &unknown; & &#xZZ;</article>", "")[1] == "\U0010ffff\ufffd \ufffd \ufffd \U0010ffff ©right &amp; &unknown; & &#xZZ;"
    many = " ".join(f"&#{n};" for n in range(0x4E00, 0x4E00 + 3000))
    assert parse(spark, f"<article>{many}</article>", "")[1] == " ".join(chr(n) for n in range(0x4E00, 0x4E00 + 3000))
    for n in (399, 400):
        html = f"<article>{'a' * n}</article><p>{'b' * 500}</p>"
        assert parse(spark, html, "")[1][0] == ("a" if n == 400 else "b")
    assert parse(spark, "<p>x<p>y</p>", "", enough=1)[1] == "x y"


def test_nothing_is_cut_unless_asked(spark):
    html = "<article>" + "abc " * 5000 + "</article>"
    df = spark.createDataFrame([(i, f"https://x.example/{i}", html if i else None) for i in range(5)], "page_id long, url string, html string")
    whole = {r.page_id: r.text for r in pages.extract(df).collect()}
    cut = {r.page_id: r.text for r in pages.extract(df, max_chars=12000).collect()}
    assert whole[0] is None and len(whole[1]) == 19999 and len(cut[1]) == 12000 and whole[1].startswith(cut[1])
    plan = pages.extract(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


PROSE = "This sentence, which is long enough, stands in the body of the page, and it says something. "


def test_readable_body_without_article_main_or_paragraphs(spark):
    body = f"<div class='menu'><a href=/>{PROSE * 9}</a></div><div id=story>{PROSE * 4}<br><br>{PROSE * 4}</div><div class=footer>{PROSE * 6}</div>"
    df = spark.createDataFrame([(1, "", f"<html><body>{body}</body></html>"), (2, "", None), (3, "", "<div>short</div>")], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in pages.extract(df, readable=True).collect()}
    assert got == {1: (PROSE * 8).strip(), 2: None, 3: None}


def test_readable_body_rules():
    paragraph = f"<p>{PROSE}</p>"
    text = PROSE.strip()
    # the part with most prose wins over one with many links; script, comments and side bars are no prose
    html = f"<div><ul>{'<li><a href=x>' + PROSE + '</a></li>' * 9}</ul></div><div class=content>{paragraph * 3}<script>{PROSE}</script><!-- {PROSE} --></div><div class=sidebar>{paragraph * 9}</div>"
    assert readable.body_of(html) == " ".join([text] * 3)
    # siblings: a paragraph with prose, a short closed sentence, but no short open line and no list of links
    more = f"<p>{PROSE}</p><p>It ended.</p><p>Read more</p><p><a href=x>{PROSE}</a></p>"
    assert readable.body_of(f"<div><section id=main-text>{paragraph * 6}</section>{more}</div>") == " ".join([text] * 7 + ["It ended."])
    # paragraphs that are never closed, ends without a start, references, very deep nesting
    assert readable.body_of(f"</b><div><p>{PROSE}<p>{PROSE} &amp; more") == f"{text} {text} & more"
    assert readable.body_of("<div>" * 5000 + paragraph + "</div>" * 5000) == text
    assert readable.body_of("") == readable.body_of("<p>short</p>") == ""


def test_query_is_the_loop_over_whole_pages(spark):
    import __spark_entry__ as entry

    sf = "/root/testdata/sf0.001"
    told = {r.page_id: r.text for r in entry.queries()["page_fulltext"](spark, sf).collect()}
    cascade = {r.page_id: r.text for r in entry.queries()["page_text"](spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/pages.parquet").collect()
    by_readable = 0
    for r in rows:
        body = readable.body_of(r.html or "")
        by_readable += len(body) >= 400
        assert told[r.page_id] == (body if len(body) >= 400 else max(body, cascade[r.page_id] or "", key=len) or None)
    assert by_readable > len(rows) / 3
