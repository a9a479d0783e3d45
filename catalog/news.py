"""News scoring, ranking, buckets, digests, daily summaries and text expressions."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from barloom.functions import dates, text
from barloom.operators import asof, dedupe, news
from barloom.plans import digest_job, news_job
from catalog.fixtures import ARTICLES, AS_OF_EPOCH, DAILY_SUMMARY, SCORED, articles, daily_summary, staged, table
from catalog.registry import query


def scored(spark, sf):
    return news.scored(articles(spark, sf), AS_OF_EPOCH)


def published(df):
    return df.withColumn("published_at", F.timestamp_seconds("published_ts").cast("timestamp_ntz"))


@query("news_score", f"with {SCORED} select seq, score, title_key, norm_url, has_image from scored")
def news_score(spark, sf):
    return scored(spark, sf).select(
        "seq",
        "score",
        text.title_key(F.col("title")).alias("title_key"),
        text.norm_url(F.col("url")).alias("norm_url"),
        text.has_real_image(F.col("image")).alias("has_image"),
    )


@query(
    "news_text_functions",
    f"""with {ARTICLES}
select seq, sha256(case when url = '' then title else url end) as article_id, substr(sha256(url), 1, 16) as link_id,
       'https://www.google.com/s2/favicons?domain=' || regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) || '&sz=128' as favicon,
       trim(regexp_replace(source, '\\s+', ' ', 'g')) as source,
       case when length(trim(regexp_replace(snippet, '[ \\t\\n\\r\\f\\v]+', ' ', 'g'))) > 140
            then substr(trim(regexp_replace(snippet, '[ \\t\\n\\r\\f\\v]+', ' ', 'g')), 1, 140) || '…'
            else trim(regexp_replace(snippet, '[ \\t\\n\\r\\f\\v]+', ' ', 'g')) end as clipped,
       coalesce(strftime(make_timestamp(published_ts * 1000000) + interval 8 hour, '%Y-%m-%d %H:%M'), '') as shown_at,
       cast(make_timestamp(published_ts * 1000000) as date) as day
from fx_articles""",
)
def news_text_functions(spark, sf):
    return articles(spark, sf).select(
        "seq",
        text.article_id(F.col("url"), F.col("title")).alias("article_id"),
        text.link_id(F.col("url")).alias("link_id"),
        text.favicon(F.col("url")).alias("favicon"),
        text.normal_source(F.col("source")).alias("source"),
        text.clip(F.col("snippet"), 140).alias("clipped"),
        dates.display_time(F.timestamp_seconds("published_ts")).alias("shown_at"),
        dates.epoch_day(F.col("published_ts")).alias("day"),
    )


@query(
    "news_recent",
    f"with {ARTICLES} select seq, published_ts from fx_articles where published_ts >= {AS_OF_EPOCH} - 36 * 3600",
)
def news_recent(spark, sf):
    return news.recent(articles(spark, sf), AS_OF_EPOCH).select("seq", "published_ts")


@query(
    "news_list",
    f"""with {ARTICLES}, p as (select *, make_timestamp(published_ts * 1000000) as published_at from fx_articles)
select seq, title, source, published_at from p
where published_at >= timestamp '2024-01-29' and published_at <= timestamp '2024-01-31'
  and (title ilike '%the%' or snippet ilike '%the%')
order by published_at desc nulls first, seq limit 20 offset 20""",
)
def news_list(spark, sf):
    out = news.list_news(
        published(articles(spark, sf)), start=datetime(2024, 1, 29), end=datetime(2024, 1, 31), q="the", limit=20, page=2
    )
    return out.select("seq", "title", "source", "published_at")


@query(
    "news_list_source",
    f"""with {ARTICLES}, p as (select *, make_timestamp(published_ts * 1000000) as published_at from fx_articles)
select seq, published_at from p where source = 'Reuters' order by published_at desc nulls first, seq limit 20""",
)
def news_list_source(spark, sf):
    return news.list_news(published(articles(spark, sf)), source="Reuters").select("seq", "published_at")


RANKED = """
best as (
  select *, min(seq) over (partition by title_key) as first_seq from scored
  qualify row_number() over (partition by title_key order by score desc, seq) = 1)"""


@query(
    "news_best_titles",
    f"with {SCORED}, {RANKED} select seq, score, first_seq from best",
)
def news_best_titles(spark, sf):
    return news.best_titles(scored(spark, sf)).select("seq", "score", "first_seq")


@query(
    "news_rank",
    f"""with {SCORED}, {RANKED}
select seq, score, row_number() over (order by score desc, coalesce(published_ts, 0) desc, first_seq)::int as rank from best qualify rank <= 30""",
)
def news_rank(spark, sf):
    return news.rank(scored(spark, sf), 30).select("seq", "score", "rank")


@query(
    "news_top_k",
    f"with {SCORED} select seq, score from scored order by score desc, coalesce(published_ts, 0) desc, seq limit 25",
)
def news_top_k(spark, sf):
    return news.top_k(scored(spark, sf), 25).select("seq", "score")


def buckets_sql(source: str, day: str) -> str:
    """Bucket picks of each batch ``day`` over ``source``."""
    return f"""
kb as (
  select *, {day} as b, sha256(case when url = '' then title else url end) as id,
         case bucket when 'general' then 0 else 1 end as t from {source}),
bests as (
  select *, min(seq) over (partition by b, t, title_key) as first_seq from kb
  qualify row_number() over (partition by b, t, title_key order by score desc, seq) = 1),
uniq as (
  select *, row_number() over (partition by b, t order by score desc, coalesce(published_ts, 0) desc, first_seq) as r from (
    select * from bests qualify row_number() over (partition by b, t, id order by score desc, coalesce(published_ts, 0) desc, first_seq) = 1)),
g as (select *, 0 as stage from uniq where t = 0 qualify row_number() over (partition by b order by r) <= 5),
s as (
  select *, 1 as stage from uniq u where t = 1 and not exists (select 1 from g where g.b is not distinct from u.b and g.id = u.id)
  qualify row_number() over (partition by b order by r) <= 5),
gs as (select * from g union all select * from s),
spare as (
  select *, 2 as stage from uniq p where not exists (select 1 from gs where gs.b is not distinct from p.b and gs.id = p.id)
  qualify row_number() over (partition by b, id order by t, r) = 1),
counted as (select *, (select count(*) from gs where gs.b is not distinct from sp.b) as have from spare sp),
more as (select * exclude (have) from counted qualify row_number() over (partition by b order by t, r) <= 10 - have),
picked as (
  select *, row_number() over (partition by b order by score desc, coalesce(published_ts, 0) desc, stage, t, r)::int as position
  from (select * from gs union all select * from more))"""


@query("news_buckets", f"with {SCORED}, {buckets_sql('scored', '0')} select seq, bucket, score, position from picked")
def news_buckets(spark, sf):
    return news.pick_buckets(scored(spark, sf), 5, 5).select("seq", "bucket", "score", "position")


DAY = "coalesce(cast(make_timestamp(published_ts * 1000000) as date), date '1970-01-01')"


@query(
    "news_buckets_daily",
    f"with {SCORED}, {buckets_sql('scored', DAY)} select b as day, seq, bucket, score, position from picked",
)
def news_buckets_daily(spark, sf):
    daily = scored(spark, sf).withColumn("day", dates.epoch_day(F.coalesce("published_ts", F.lit(0))))
    return news.pick_buckets(daily, 5, 5, by=["day"]).select("day", "seq", "bucket", "score", "position")


@query(
    "news_dedupe",
    f"""with {SCORED}
select seq, norm_url, score from scored where norm_url <> ''
qualify row_number() over (partition by norm_url order by has_image desc, score desc, coalesce(published_ts, 0) desc, seq) = 1""",
)
def news_dedupe(spark, sf):
    out = dedupe.articles(scored(spark, sf))
    return out.select("seq", text.norm_url(F.col("url")).alias("norm_url"), "score")


@query(
    "news_dedupe_titles",
    f"""with {SCORED},
one as (
  select * from scored where norm_url <> ''
  qualify row_number() over (partition by norm_url order by has_image desc, score desc, coalesce(published_ts, 0) desc, seq) = 1)
select seq, score from one
qualify row_number() over (partition by coalesce(source, ''), title_key order by has_image desc, score desc, coalesce(published_ts, 0) desc, seq) = 1""",
)
def news_dedupe_titles(spark, sf):
    return dedupe.articles(scored(spark, sf), by_title=True).select("seq", "score")


@query("news_first_per_link", f"with {ARTICLES} select seq, url from fx_articles qualify row_number() over (partition by url order by seq) = 1")
def news_first_per_link(spark, sf):
    return dedupe.first_per_key(articles(spark, sf), ["url"]).select("seq", "url")


@query(
    "news_cap_per_query",
    f"with {ARTICLES} select seq, source from fx_articles qualify row_number() over (partition by source order by seq) <= 10",
)
def news_cap_per_query(spark, sf):
    return news.cap_per_query(articles(spark, sf), 10, "source").select("seq", "source")


@query(
    "news_tag_tickers",
    f"""with {ARTICLES},
tickers as (select distinct upper(w) as ticker from (select unnest(string_split(text, ' ')) as w from benchmark) where regexp_full_match(w, '[A-Za-z]+([.-][A-Za-z]+)*')),
whole as (select seq, title || ' ' || snippet as t from fx_articles),
words as (select seq, unnest(regexp_split_to_array(t, '[^\\p{{L}}\\p{{N}}]+') || regexp_extract_all(t, '[\\p{{L}}\\p{{N}}]+(?:[.-][\\p{{L}}\\p{{N}}]+)+')) as w from whole)
select distinct seq, ticker from words join tickers on ticker = upper(w)""",
)
def news_tag_tickers(spark, sf):
    names = (
        table(spark, sf, "benchmark")
        .select(F.explode(F.split("text", " ")).alias("ticker"))
        .filter(F.col("ticker").rlike("^[A-Za-z]+([.-][A-Za-z]+)*$"))
    )
    return news.tag_tickers(articles(spark, sf), names)


@query(
    "news_tag_mentions",
    f"""with {ARTICLES},
firms as (
  select distinct upper(string_split(text, ' ')[1]) as ticker, trim(regexp_replace(upper(string_split(text, ' ')[2] || ' ' || string_split(text, ' ')[3]), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) as name
  from benchmark where regexp_matches(text, '^[A-Za-z]+ [A-Za-z]+ [A-Za-z]+ ')),
articles as (select seq, upper(title || ' ' || case when seq % 3 = 0 then '"' || string_split(snippet, ' ')[1] || '" ' || string_split(snippet, ' ')[1] || ' stock ' else '' end || snippet) as t from fx_articles),
words as (select seq, [w for w in regexp_split_to_array(t, '[^\\p{{L}}\\p{{N}}]+') if w <> ''] as w, t from articles),
runs as (
  select distinct seq, w[i] || ' ' || w[i + 1] as phrase from (select seq, w, unnest(range(1, len(w))) as i from words)),
quotes as (
  select distinct seq, trim(regexp_replace(q, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) as phrase
  from (select seq, unnest(regexp_extract_all(t, '["“]([^"“”]+)["”]', 1)) as q from words))
select distinct seq, ticker, 'stock' as form from runs join firms on phrase = ticker || ' STOCK'
union all select distinct seq, ticker, 'shares' from runs join firms on phrase = ticker || ' SHARES'
union all select distinct seq, ticker, 'name' from runs join firms on phrase = name
union all select distinct seq, ticker, 'quoted' from quotes join firms on phrase = ticker""",
)
def news_tag_mentions(spark, sf):
    """Companies are the first words of the benchmark items; every third snippet starts with its first word in quotes and as a stock."""
    parts = F.split("text", " ")
    firms = table(spark, sf, "benchmark").filter(F.col("text").rlike("^[A-Za-z]+ [A-Za-z]+ [A-Za-z]+ "))
    firms = firms.select(parts[0].alias("ticker"), F.concat(parts[1], F.lit(" "), parts[2]).alias("name"))
    first = F.split("snippet", " ")[0]
    lead = F.when(F.col("seq") % 3 == 0, F.concat(F.lit('"'), first, F.lit('" '), first, F.lit(" stock "))).otherwise("")
    return news.tag_mentions(articles(spark, sf).withColumn("snippet", F.concat(lead, F.col("snippet"))), news.mention_forms(firms))


@query(
    "news_summary_candidates",
    f"""with {ARTICLES},
d as (select *, cast(make_timestamp(published_ts * 1000000) as date) = date '2024-01-30' as today from fx_articles
      where published_ts is not null)
select source, seq, published_ts from d
qualify case when max(today::int) over (partition by source) = 1 then today else published_ts >= 1706655600 - 36 * 3600 end""",
)
def news_summary_candidates(spark, sf):
    out = news.summary_candidates(articles(spark, sf), AS_OF_EPOCH - 3600, by=["source"])
    return out.select("source", "seq", "published_ts")


WINDOWS = f"""
starts as (select unnest(generate_series(timestamp '2024-01-27', timestamp '2024-01-31', interval 2 day))::date as window_start),
spread as (
  select s.*, w.window_start, least(w.window_start + 2, date '2024-01-31') as window_end
  from scored s join starts w on cast(make_timestamp(published_ts * 1000000) as date) between w.window_start and least(w.window_start + 2, date '2024-01-31'))"""


@query(
    "news_backfill_windows",
    f"with {SCORED}, {WINDOWS} select seq, window_start, window_end from spread",
)
def news_backfill_windows(spark, sf):
    out = news.backfill_windows(articles(spark, sf), date(2024, 1, 27), date(2024, 1, 31), 3, 1)
    return out.select("seq", "window_start", "window_end")


@query(
    "news_backfill_picks",
    f"""with {SCORED}, {WINDOWS}, {buckets_sql('spread', 'window_start')},
flat as (
  select * from picked where norm_url <> ''
  qualify row_number() over (partition by b, norm_url order by has_image desc, score desc, coalesce(published_ts, 0) desc, seq) = 1)
select norm_url as canonical_url, arg_max(title, b) as title, arg_max(score, b) as score from flat group by 1""",
)
def news_backfill_picks(spark, sf):
    out = news_job.backfill(scored(spark, sf), date(2024, 1, 27), date(2024, 1, 31), 3, 1)
    return out.select("canonical_url", "title", "score")


@query(
    "news_digest",
    f"""with {ARTICLES},
raw as (
  select seq, sha256(url) as article_id, title, url as canonical_url, source, snippet, null::varchar as content,
         make_timestamp(published_ts * 1000000) as ts, strftime(make_timestamp(published_ts * 1000000), '%Y-%m-%dT%H:%M:%SZ') as published_at
  from fx_articles where published_ts is not null),
placed as (select *, cast(ts as date) as dt from raw),
newest as (select *, row_number() over (partition by dt order by ts desc, seq) as rank from placed
           qualify rank <= 10)
select dt, count(*) as article_count,
       string_agg('[' || rank || '] ' || title || chr(10) || 'Source: ' || source || ' | Time: ' || published_at || chr(10)
                  || 'URL: ' || canonical_url || chr(10)
                  || case when snippet <> '' then 'Snippet: ' || substr(snippet, 1, 1000) || chr(10) else '' end, chr(10) order by rank) as text
from newest group by dt""",
)
def news_digest(spark, sf):
    return news.digest(digest_job.as_lines(articles(spark, sf)), snippet_chars=1000, content_chars=1500).select("dt", "article_count", "text")


@query(
    "news_digest_job",
    f"""with {ARTICLES},
raw as (
  select seq, cast(make_timestamp(published_ts * 1000000) as date) as dt, published_ts from fx_articles where published_ts is not null)
select dt, least(count(*), 10) as article_count from raw group by 1""",
)
def news_digest_job(spark, sf):
    from barloom.sources.prices import scratch

    source, target = scratch(spark, "articles"), scratch(spark, "digests")
    from barloom.sources import articles as article_source

    article_source.write_articles(digest_job.as_lines(articles(spark, sf)), source)
    digest_job.run(spark, source, target)
    return spark.read.json(target).select(F.col("dt").cast("date"), "article_count")


@query(
    "news_daily_job",
    f"""with {SCORED}, {buckets_sql('scored', '0')},
flat as (
  select * from picked where norm_url <> ''
  qualify row_number() over (partition by norm_url order by has_image desc, score desc, coalesce(published_ts, 0) desc, seq) = 1)
select sha256(norm_url) as article_id, norm_url as canonical_url, title, source, source as author, score,
       make_timestamp(published_ts * 1000000) as published_at, case when has_image then image end as image_url,
       nullif(trim(snippet), '') as content
from flat""",
)
def news_daily_job(spark, sf):
    out = news_job.select_articles(articles(spark, sf), AS_OF_EPOCH, 5, 5)
    return out.select(
        "article_id",
        "canonical_url",
        "title",
        "source",
        "author",
        "score",
        F.col("published_at").cast("timestamp_ntz").alias("published_at"),
        "image_url",
        "content",
    )


@query(
    "news_table_update",
    f"""with {SCORED},
one as (
  select bucket, norm_url, title, score from scored where norm_url <> ''
  qualify row_number() over (partition by bucket, norm_url order by has_image desc, score desc, coalesce(published_ts, 0) desc, seq) = 1)
select norm_url as canonical_url, title, score from one where bucket = 'specific'
union all
select norm_url, title, score from one g where bucket = 'general' and not exists (select 1 from one s where s.bucket = 'specific' and s.norm_url = g.norm_url)""",
)
def news_table_update(spark, sf):
    flat = dedupe.articles(scored(spark, sf), by=["bucket"])
    old, new = (news_job.article_rows(flat.filter(F.col("bucket") == b)) for b in ("general", "specific"))
    return news_job.update(old, new).select("canonical_url", "title", "score")


@query("news_daily_enriched")
def news_daily_enriched(spark, sf):
    out = news_job.select_articles(articles(spark, sf), AS_OF_EPOCH, 5, 5, page_table=table(spark, sf, "pages"))
    return out.select("article_id", "canonical_url", "title", "score", "content", "image_url")


SQUEEZED = "trim(regexp_replace({c}, '[ \\t\\n\\r\\f\\v]+', ' ', 'g'))"
CLIPPED = f"case when length({SQUEEZED}) > {{n}} then substr({SQUEEZED}, 1, {{n}}) || '…' else {SQUEEZED} end"


@query(
    "news_brief",
    f"""with {ARTICLES},
top as (select *, row_number() over (partition by source order by coalesce(published_ts, 0) desc, seq) as r from fx_articles qualify r <= 10)
select source, string_agg('- [' || coalesce(strftime(make_timestamp(published_ts * 1000000), '%Y-%m-%d %H:%M'), '') || '] '
         || {CLIPPED.format(c="title", n=140)} || ' (' || {CLIPPED.format(c="source", n=40)} || ')', chr(10) order by r) as text,
       list(sha256(regexp_replace(url, '[?#].*$', '')) order by r) as article_ids
from top group by source""",
)
def news_brief(spark, sf):
    return news.brief(articles(spark, sf), by=["source"], title_chars=140, source_chars=40)


# ---------------------------------------------------------------- daily summaries

DAYS = "days as (select unnest(generate_series(timestamp '2023-12-30', timestamp '2024-02-03', interval 1 day))::date as day)"


def _days(spark):
    return spark.sql("select explode(sequence(date '2023-12-30', date '2024-02-03')) as day")


def _requests(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("request"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("o_custkey") % 40).cast("int")).alias("day")
    )


REQUESTS = "requests as (select o_orderkey as request, date '2024-01-01' + cast(o_custkey % 40 as int) as day from orders)"


@query(
    "summary_asof",
    f"""with {DAILY_SUMMARY}, {REQUESTS}
select request, r.day, s.day as fact_day, summary, sentiment_score from requests r asof left join fx_summary s on r.day >= s.day""",
)
def summary_asof(spark, sf):
    return asof.backward(_requests(spark, sf), daily_summary(spark, sf), "day")


@query(
    "summary_asof_strict",
    f"""with {DAILY_SUMMARY}, {REQUESTS}
select request, r.day, s.day as fact_day, summary, sentiment_score from requests r asof left join fx_summary s on r.day > s.day""",
)
def summary_asof_strict(spark, sf):
    return asof.backward(_requests(spark, sf), daily_summary(spark, sf), "day", strict=True)


@query(
    "summary_asof_exact",
    f"""with {DAILY_SUMMARY}, {REQUESTS}
select request, r.day, s.day as fact_day, summary, sentiment_score from requests r left join fx_summary s on r.day = s.day""",
)
def summary_asof_exact(spark, sf):
    return asof.backward(_requests(spark, sf), daily_summary(spark, sf), "day", exact=True)


@query(
    "price_asof",
    """
with bids as (select event_id, user_id, ts from events),
logins as (select user_id, ts, event_id as login from events where event_type = 'signup')
select b.event_id, b.user_id, b.ts, l.ts as fact_ts, login from bids b asof left join logins l on b.user_id = l.user_id and b.ts >= l.ts""",
)
def price_asof(spark, sf):
    events = table(spark, sf, "events")
    bids = events.select("event_id", "user_id", "ts")
    logins = events.filter("event_type = 'signup'").select("user_id", "ts", F.col("event_id").alias("login"))
    return asof.backward(bids, logins, "ts", ["user_id"], chunk=F.to_date("ts"))


@query(
    "news_snippets",
    """
select doc_id, coalesce(nullif(trim(case when doc_id % 3 = 0 then '' when doc_id % 3 = 1 then substr(text, 1, 20) end), ''),
                        nullif(case when length(text) > 200 then substr(text, 1, 200) || '…' else text end, ''), '') as shown from documents""",
)
def news_snippets(spark, sf):
    """The snippet, or the start of the content where it is missing or blank."""
    snippet = F.when(F.col("doc_id") % 3 == 0, "").when(F.col("doc_id") % 3 == 1, F.substring("text", 1, 20))
    return table(spark, sf, "documents").select("doc_id", text.snippet_or_content(snippet, F.col("text")).alias("shown"))


@query(
    "news_daily_summary",
    f"""with {ARTICLES}, {DAILY_SUMMARY},
cand as (
  select *, cast(make_timestamp(published_ts * 1000000) as date) = date '2024-01-31' as today from fx_articles where published_ts is not null
  qualify case when max(today::int) over () = 1 then today else published_ts >= {AS_OF_EPOCH} - 36 * 3600 end),
top as (select *, row_number() over (order by coalesce(published_ts, 0) desc, seq) as r from cand qualify r <= 10),
own as (
  select date '2024-01-31' as day, string_agg('- [' || strftime(make_timestamp(published_ts * 1000000), '%Y-%m-%d %H:%M') || '] '
         || {SQUEEZED.format(c="title")} || ' (' || {SQUEEZED.format(c="source")} || ')', chr(10) order by r) as summary from top),
days as (select day, summary, sentiment_score from fx_summary where day <> date '2024-01-31' union all select day, summary, null from own)
select * from days where day <> date '2024-03-05'
union all select date '2024-03-05', summary, sentiment_score from days where day = (select max(day) from days where day < date '2024-03-05')""",
)
def news_daily_summary(spark, sf):
    """Two runs: a day with articles, and a later one without, which carries the last summary forward."""
    days, found = daily_summary(spark, sf), articles(spark, sf)
    first = news_job.daily_summary(days, found, AS_OF_EPOCH)
    return news_job.daily_summary(first, found, AS_OF_EPOCH + 34 * 86400).select("day", "summary", "sentiment_score")


@query(
    "summary_fill",
    f"""with {DAILY_SUMMARY}, {DAYS}
select d.day, summary, sentiment_score, s.day <> d.day as carried from days d asof join fx_summary s on d.day >= s.day""",
)
def summary_fill(spark, sf):
    return news.fill_daily_summary(daily_summary(spark, sf), _days(spark))


@query(
    "summary_paragraphs",
    """
with t as (select doc_id, replace(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), '…', '...') as x from documents),
p as (
  select doc_id, list_filter(list_transform(string_split(x, chr(10) || chr(10)), lambda q: regexp_replace(q, '^\\s+|\\s+$', '', 'g')), lambda q: q <> '') as parts,
         string_split(regexp_replace(x, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)) as s from t),
c as (
  select doc_id, case when len(parts) >= 2 then parts[1:2]
              else [array_to_string(s[1:greatest(1, len(s) // 2)], ' '), array_to_string(s[greatest(1, len(s) // 2) + 1:], ' ')] end as two from p)
select doc_id, regexp_replace(two[1], '[ .]+$', '') || '.' as summary, regexp_replace(two[2], '[ .]+$', '') || '.' as outlook from c""",
)
def summary_paragraphs(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.two_paragraphs(F.col("text")).alias("p")).select("doc_id", "p.summary", "p.outlook")


@query(
    "summary_labels",
    f"""with {DAILY_SUMMARY}
select day, case when sentiment_score >= 0.15 then 'Positive' when sentiment_score <= -0.15 then 'Negative' else 'Neutral' end as label,
       summary || '.' as paragraph from fx_summary""",
)
def summary_labels(spark, sf):
    return daily_summary(spark, sf).select(
        "day", text.sentiment_label(F.col("sentiment_score")).alias("label"), text.tidy_paragraph(F.col("summary")).alias("paragraph")
    )
