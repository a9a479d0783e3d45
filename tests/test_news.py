"""News picks against a plain loop, and text expressions on hand-written cases."""

import hashlib
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from barloom.functions import dates, numbers, text
from barloom.operators import news

SCHEMA = "seq long, bucket string, title string, url string, source string, image string, published_ts long, score double"


def loop_pick(articles, n_general, n_specific):
    def ranked(bucket):
        best, first = {}, {}
        for a in articles:
            if a["bucket"] == bucket:
                first.setdefault(a["title"], a["seq"])
                if a["title"] not in best or a["score"] > best[a["title"]]["score"]:
                    best[a["title"]] = a
        order = sorted(best.values(), key=lambda a: (-a["score"], -(a["published_ts"] or 0), first[a["title"]]))
        return order

    key = lambda a: a["url"] or a["title"]
    pools = [ranked("general"), ranked("specific")]
    seen, chosen = set(), []
    for pool, n in zip(pools, (n_general, n_specific)):
        fresh = [a for i, a in enumerate(pool) if key(a) not in seen and key(a) not in {key(b) for b in pool[:i]}][:n]
        seen |= {key(a) for a in fresh}
        chosen += fresh
    for a in pools[0] + pools[1]:
        if len(chosen) < n_general + n_specific and key(a) not in seen:
            seen.add(key(a))
            chosen.append(a)
    return [a["seq"] for a in sorted(chosen, key=lambda a: (-a["score"], -(a["published_ts"] or 0)))]


@pytest.mark.parametrize("n_general,n_specific", [(3, 3), (5, 1), (1, 5), (0, 4)])
def test_buckets(spark, n_general, n_specific):
    batches, rows = {}, []
    for b in range(12):
        rng = random.Random(b)
        for i in range(rng.choice([2, 9, 40])):
            a = {
                "seq": b * 1000 + i,
                "bucket": rng.choice(["general", "general", "specific"]),
                "title": f"title {chr(97 + rng.randrange(26))}",
                "url": rng.choice(["", *[f"https://u.example/{u}" for u in "abcdefgh"]]),
                "source": "s",
                "image": None,
                "published_ts": rng.choice([None, 5, 6, 7]),
                "score": rng.choice([0.1, 0.2, 0.3]),
            }
            batches.setdefault(b, []).append(a)
            rows.append((b, *a.values()))
    df = spark.createDataFrame(rows, f"batch int, {SCHEMA}")
    got = {}
    for r in news.pick_buckets(df, n_general, n_specific, by=["batch"]).orderBy("batch", "position").collect():
        got.setdefault(r.batch, []).append(r.seq)
    for b, articles in batches.items():
        assert got.get(b, []) == loop_pick(articles, n_general, n_specific), b


def test_bucket_fills_where_its_best_titles_share_an_address(spark):
    rows = [(i, "general", f"title {chr(97 + i // 26)}{chr(97 + i % 26)}", "https://u.example/same", "s", None, 5, 0.9) for i in range(200)]
    rows += [(200 + i, "general", f"other {chr(97 + i)}", f"https://u.example/{i}", "s", None, 5, 0.1) for i in range(10)]
    out = news.pick_buckets(spark.createDataFrame(rows, SCHEMA), 5, 0).orderBy("position")
    assert [r.seq for r in out.collect()] == [0, 200, 201, 202, 203]


def test_candidates_of_one_batch_or_many(spark):
    """Two days: the day of ``as_of`` where it has articles, else the last hours; without batches the same as one batch."""
    day = 86400
    rows = [(1, 0, 10 * day + 5), (2, 0, 10 * day - 5), (3, 1, 10 * day - 5), (4, 1, 8 * day), (5, 1, None), (6, 2, 0)]
    df = spark.createDataFrame(rows, "seq long, batch int, published_ts long")
    pick = lambda d, by=(): sorted(r.seq for r in news.summary_candidates(d, 10 * day + 100, by=by).collect())
    assert pick(df, ["batch"]) == [1, 3] and pick(df) == [1]
    for b in (0, 1, 2):
        part = df.filter(F.col("batch") == b)
        assert pick(part) == pick(part, ["batch"])
    assert pick(df.limit(0)) == []


def test_common_words_need_a_form(spark):
    texts = ['We all went "all in" and it was all good', 'Buy ALL stock now', 'all-shares index', 'He said “BRK.B” twice', 'Allstate Corp. rose', 'brk b shares', "", None]
    df = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], "seq long, title string, snippet string")
    tickers = spark.createDataFrame([("all", "Allstate Corp"), ("BRK.B", None), ("IT", "")], "ticker string, name string")
    got = sorted(map(tuple, news.tag_mentions(df, news.mention_forms(tickers)).collect()))
    assert got == [(1, "ALL", "stock"), (2, "ALL", "shares"), (3, "BRK.B", "quoted"), (4, "ALL", "name"), (5, "BRK.B", "shares")]


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def test_addresses(spark):
    wrapped = "https://news.google.com/rss/articles/abc?url=https%3A%2F%2Fa.example%2Fx%3Fy%3D1&oc=5"
    assert one(spark, text.unwrap_url(F.lit(wrapped))) == "https://a.example/x?y=1"
    assert one(spark, text.unwrap_url(F.lit("https://b.example/?url=z"))) == "https://b.example/?url=z"
    assert one(spark, text.norm_url(F.lit("https://a.example/p?q=1#f"))) == "https://a.example/p"
    assert one(spark, text.favicon(F.lit("no address"))) is None


def test_titles_and_slugs(spark):
    assert one(spark, text.title_key(F.lit("  Hello,   World! "))) == hashlib.md5(b"hello world").hexdigest()
    assert one(spark, text.title_key(F.lit(None).cast("string"))) == hashlib.md5(b"").hexdigest()
    assert one(spark, text.slug(F.lit(" My  Own "), F.lit("t"))) == "my-own"
    assert one(spark, text.slug(F.lit(None).cast("string"), F.lit(" Été: 5_a - b! "))) == "été-5-a--b"
    assert one(spark, text.slug(F.lit(""), F.lit("!!"))) is None


def test_paragraphs(spark):
    assert one(spark, text.tidy_paragraph(F.lit(" A  b .  Summarize the following: x"))) == "A b."
    assert one(spark, text.tidy_paragraph(F.lit("goes on…"))) == "goes on."
    assert one(spark, text.tidy_paragraph(F.lit(""))) == ""
    assert tuple(one(spark, text.two_paragraphs(F.lit("One. Two! Three?")))) == ("One.", "Two! Three?.")
    assert tuple(one(spark, text.two_paragraphs(F.lit("First part\n\nSecond .\n\nThird")))) == ("First part.", "Second.")


def test_numbers_and_dates(spark):
    assert str(one(spark, numbers.decimal(F.lit("2.345"), 2))) == "2.34"
    assert one(spark, numbers.decimal(F.lit("x"), 2)) is None
    assert [one(spark, numbers.rounded_int(F.lit(v))) for v in ("0.5", "1.5", "2.4", "bad")] == [0, 2, 2, None]
    assert [one(spark, numbers.strict_int(F.lit(v))) for v in ("4.0", "4.5", "")] == [4, None, None]
    assert one(spark, F.date_format(dates.feed_time(F.lit("Tue, 2 Jan 2024 10:20:30 GMT")), "yyyy-MM-dd HH:mm:ss")) == "2024-01-02 10:20:30"
    assert one(spark, dates.feed_time(F.lit("soon"))) is None


def test_scores(spark):
    s = text.score(F.lit(1000), F.lit("Reuters"), F.lit("Bank SURGES on merger"), 1000)
    assert one(spark, s) == 0.94
    undated = text.score(F.lit(None).cast("long"), F.lit("Somewhere"), F.lit("quiet"), 1000)
    assert one(spark, undated) == 0.26


def test_summaries_fill_days_that_are_never_null(spark):
    days = spark.range(4).select(F.date_add(F.lit(date(2023, 12, 30)), F.col("id").cast("int")).alias("day"))
    told = spark.createDataFrame([(date(2023, 12, 31), 0.5)], "day date, score double").select("day", F.lit("text").alias("summary"), "score")
    got = sorted(tuple(r) for r in news.fill_daily_summary(told, days).collect())
    assert got == [(date(2023, 12, 31), "text", 0.5, False), (date(2024, 1, 1), "text", 0.5, True), (date(2024, 1, 2), "text", 0.5, True)]
