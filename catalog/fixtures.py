"""Input views over the given tables, once as DataFrames and once as SQL for the check.

The tables hold orders, customers, events and documents; the views give them the shape of price bars, companies, statements,
watchlists and articles. Every view reads its whole tables and whole texts.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators import blocks
from barloom.sources.tables import stage

AS_OF = datetime(2024, 1, 31)
AS_OF_EPOCH = 1706659200
NUDGE = 3.3e-9  # keeps a mean of decimals off an exact rounding tie


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def r6(c: Column | str) -> Column:
    return F.round((F.col(c) if isinstance(c, str) else c) + F.lit(NUDGE), 6)


def q6(sql: str) -> str:
    return f"round({sql} + 3.3e-9, 6)"


def ticker_of(c: Column) -> Column:
    return F.concat(F.lit("S"), F.lpad(c.cast("string"), 6, "0"))


def prices(spark: SparkSession, sf: str) -> DataFrame:
    """Daily bars: a random walk per supplier, driven by the discounts of its line items."""
    steps = (
        table(spark, sf, "lineitem")
        .groupBy(ticker_of(F.col("l_suppkey")).alias("ticker"), F.to_date("l_shipdate").alias("date"))
        .agg(
            F.sum(F.round(F.col("l_discount") * 100).cast("int") - 5).alias("r"),
            F.sum("l_quantity").cast("long").alias("volume"),
        )
    )
    walked = blocks.running(
        steps, ["ticker"], "date", {"level": blocks.total(F.col("r")), "was": blocks.total(F.col("r")).before()}
    )

    def price(level: str) -> Column:
        return F.round(100 * F.exp(0.006 * F.col(level)), 4)

    bars = walked.select(
        "ticker", "date", price("level").alias("close"), F.coalesce(price("was"), price("level")).alias("open"), "volume"
    )
    return bars.select(
        "ticker",
        "date",
        "open",
        F.round(F.greatest("open", "close") * 1.01, 6).alias("high"),
        F.round(F.least("open", "close") * 0.99, 6).alias("low"),
        "close",
        "volume",
    )


PRICES = """
steps as (
  select 'S' || lpad(cast(l_suppkey as varchar), 6, '0') as ticker, cast(l_shipdate as date) as date,
         sum(cast(round(l_discount * 100) as int) - 5) as r, cast(sum(l_quantity) as bigint) as volume
  from lineitem group by 1, 2),
closes as (
  select ticker, date, volume, round(100 * exp(0.006 * sum(r) over (partition by ticker order by date
         rows between unbounded preceding and current row)), 4) as close from steps),
opens as (select *, coalesce(lag(close) over (partition by ticker order by date), close) as open from closes),
fx_prices as materialized (
  select ticker, date, open, round(greatest(open, close) * 1.01, 6) as high,
         round(least(open, close) * 0.99, 6) as low, close, volume from opens)"""


def prices_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Two overlapping snapshots of the bars; the older one carries closes that were revised later."""
    daily = bars(spark, sf)
    old, new = F.lit("2000-12-31").cast("date"), F.lit("2001-12-31").cast("date")
    copies = F.filter(
        F.array(
            F.when(F.col("date") <= old, F.struct((F.col("close") * 2).alias("close"), old.alias("snapshot"))),
            F.when(F.col("date") > F.lit("2000-06-30").cast("date"), F.struct(F.col("close"), new.alias("snapshot"))),
        ),
        lambda x: x.isNotNull(),
    )
    return daily.withColumn("_copy", F.explode(copies)).select(
        "ticker", "date", "open", "high", "low", "_copy.close", "volume", "_copy.snapshot"
    )


PRICES_RAW = (
    PRICES
    + """,
fx_prices_raw as (
  select ticker, date, open, high, low, close * 2 as close, volume, date '2000-12-31' as snapshot
  from fx_prices where date <= date '2000-12-31'
  union all
  select ticker, date, open, high, low, close, volume, date '2001-12-31'
  from fx_prices where date > date '2000-06-30')"""
)


_STAGED: dict[tuple[str, str, str], DataFrame] = {}


def staged(spark: SparkSession, sf: str, name: str, make) -> DataFrame:
    """A derived input table, written once per session and scale, as the jobs would find it."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _STAGED:
        _STAGED[key] = stage(make(spark, sf), name)
    return _STAGED[key]


def bars(spark: SparkSession, sf: str) -> DataFrame:
    return staged(spark, sf, "bars", prices)


def companies(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "supplier")
        .join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            ticker_of(F.col("s_suppkey")).alias("ticker"),
            F.col("s_name").alias("name"),
            F.when(F.col("s_suppkey") % 5 != 0, F.concat(F.lit("Sup"), F.col("s_suppkey").cast("string"))).alias("short_name"),
            F.col("r_name").alias("sector"),
            F.col("n_name").alias("country"),
        )
    )


COMPANIES = """
fx_companies as (
  select 'S' || lpad(cast(s_suppkey as varchar), 6, '0') as ticker, s_name as name,
         case when s_suppkey % 5 = 0 then null else 'Sup' || cast(s_suppkey as varchar) end as short_name,
         r_name as sector, n_name as country
  from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey)"""


def watchlist_items(spark: SparkSession, sf: str) -> DataFrame:
    """One watchlist per nation and market segment, one item per customer; the balance is the allocation, also when negative."""
    size = table(spark, sf, "supplier").agg(F.count(F.lit(1)).alias("n"))
    spelled = ticker_of((F.col("c_custkey") * 7) % size.scalar())
    return table(spark, sf, "customer").select(
        F.concat(F.lit("W"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0"), F.lit("-"), "c_mktsegment").alias("watchlist_id"),
        F.when(F.col("c_custkey") % 2 == 1, F.concat(F.lit(" "), F.lower(spelled))).otherwise(spelled).alias("ticker"),
        F.col("c_acctbal").alias("allocation"),
        F.col("c_custkey").alias("position"),
    )


WATCHLIST_ITEMS = """
fx_items as (
  select 'W' || lpad(cast(c_nationkey as varchar), 2, '0') || '-' || c_mktsegment as watchlist_id,
         case when c_custkey % 2 = 1 then ' ' || lower('S' || lpad(cast((c_custkey * 7) % n as varchar), 6, '0'))
              else 'S' || lpad(cast((c_custkey * 7) % n as varchar), 6, '0') end as ticker,
         c_acctbal as allocation, c_custkey as position
  from customer, (select count(*) as n from supplier))"""


def articles(spark: SparkSession, sf: str) -> DataFrame:
    """One article per document: its first line as title, its whole text as snippet, addresses shared through the pages."""
    docs, pages = table(spark, sf, "documents"), table(spark, sf, "pages")
    n_pages = pages.agg(F.count(F.lit(1)).alias("n"))
    heading = F.split_part("text", F.lit("\n"), F.lit(1))
    kind = F.length(heading) % 7
    suffix = (
        F.when(kind == 0, " earnings").when(kind == 1, " merger").when(kind == 2, " dividend").when(kind == 3, " surges").otherwise("")
    )
    source = F.col("source")
    return (
        docs.withColumn("page_id", F.col("doc_id") % n_pages.scalar())
        .join(pages.select("page_id", "url"), "page_id")
        .select(
            F.col("doc_id").alias("seq"),
            F.when(F.col("doc_id") % 3 == 0, "specific").otherwise("general").alias("bucket"),
            F.concat(heading, suffix).alias("title"),
            "url",
            F.when(source == "src0", "Reuters")
            .when(source == "src1", "Bloomberg")
            .when(source == "src2", "CNBC")
            .when(source == "src3", "MarketWatch")
            .otherwise(source)
            .alias("source"),
            F.col("text").alias("snippet"),
            F.when(F.col("doc_id") % 4 == 0, None)
            .when(F.col("doc_id") % 4 == 1, "https://www.google.com/s2/favicons?domain=x")
            .otherwise(F.concat(F.lit("https://img.example.com/"), F.col("doc_id").cast("string"), F.lit(".jpg")))
            .alias("image"),
            F.when(F.col("doc_id") % 17 != 0, F.lit(AS_OF_EPOCH) - (F.col("doc_id") * 7919) % 259200).alias("published_ts"),
        )
    )


ARTICLES = """
fx_articles as materialized (
  select doc_id as seq, case when doc_id % 3 = 0 then 'specific' else 'general' end as bucket,
         title0 || case length(title0) % 7 when 0 then ' earnings' when 1 then ' merger' when 2 then ' dividend'
                   when 3 then ' surges' else '' end as title, url,
         case source when 'src0' then 'Reuters' when 'src1' then 'Bloomberg' when 'src2' then 'CNBC'
                     when 'src3' then 'MarketWatch' else source end as source,
         text as snippet,
         case doc_id % 4 when 0 then null when 1 then 'https://www.google.com/s2/favicons?domain=x'
              else 'https://img.example.com/' || cast(doc_id as varchar) || '.jpg' end as image,
         case when doc_id % 17 = 0 then null else 1706659200 - (doc_id * 7919) % 259200 end as published_ts
  from (select d.*, split_part(d.text, chr(10), 1) as title0, p.url
        from documents d, (select count(*) as n from pages) k, pages p where p.page_id = d.doc_id % k.n))"""

SCORED = (
    ARTICLES
    + """,
scored as materialized (
  select *, round_even(0.55 * case when published_ts is null then 0.2
                    else greatest(0, 1 - least(greatest(0, (1706659200 - published_ts) / 3600.0::double) / 48.0::double, 1.0)) end
         + 0.30 * case source when 'Reuters' then 1.0 when 'Bloomberg' then 0.95 when 'CNBC' then 0.8 when 'MarketWatch' then 0.6 else 0.5 end::double
         + 0.15 * greatest(
             case when regexp_matches(title, '(?i)\\b(surges?|plunges?|spikes?|tumbles?)\\b') then 0.6 else 0 end,
             case when regexp_matches(title, '(?i)\\b(earnings|EPS|guidance|outlook|downgrade|upgrade)\\b') then 0.5 else 0 end,
             case when regexp_matches(title, '(?i)\\b(M&A|acquisition|merger|spin[- ]off)\\b') then 0.4 else 0 end,
             case when regexp_matches(title, '(?i)\\b(SEC filing|lawsuit|investigation)\\b') then 0.4 else 0 end,
             case when regexp_matches(title, '(?i)\\b(dividend|buyback|split)\\b') then 0.3 else 0 end)::double, 4) as score,
         md5(trim(regexp_replace(regexp_replace(lower(coalesce(title, '')), '[^a-z0-9 ]+', '', 'g'), ' +', ' ', 'g'))) as title_key,
         regexp_replace(url, '[?#].*$', '') as norm_url,
         image is not null and not contains(image, 'google.com/s2/favicons') and not contains(image, 'gstatic') as has_image
  from fx_articles)"""
)


def daily_summary(spark: SparkSession, sf: str) -> DataFrame:
    """A summary of each day on which errors were fewer than views."""
    kind = F.col("event_type")
    return (
        table(spark, sf, "events")
        .groupBy(F.to_date("ts").alias("day"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum((kind == "error").cast("int")).alias("errors"),
            F.sum((kind == "view").cast("int")).alias("views"),
        )
        .filter("errors < views")
        .select(
            "day",
            F.concat(F.lit("events "), F.col("n").cast("string")).alias("summary"),
            F.when(F.col("n") % 3 != 0, F.round((F.col("n") % 100) / 100.0 - 0.5, 2).cast("double")).alias("sentiment_score"),
        )
    )


DAILY_SUMMARY = """
fx_summary as (
  select day, 'events ' || cast(n as varchar) as summary,
         case when n % 3 <> 0 then cast(round((n % 100) / 100.0 - 0.5, 2) as double) end as sentiment_score
  from (select cast(ts as date) as day, count(*) as n, sum((event_type = 'error')::int) as errors,
               sum((event_type = 'view')::int) as views from events group by 1) where errors < views)"""


def content(spark: SparkSession, sf: str) -> DataFrame:
    d = F.col("doc_id")
    base = F.lit("2024-01-01").cast("timestamp_ntz")
    return table(spark, sf, "documents").select(
        d.alias("id"),
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"),
        F.when(d % 6 != 0, F.col("text")).alias("excerpt"),
        F.when(d % 3 != 0, F.concat(F.lit("S"), F.lpad((d % 10).cast("string"), 6, "0"))).alias("ticker"),
        F.when(d % 4 == 0, "ai,macro").when(d % 4 == 1, "macd").when(d % 4 == 2, "rsi,  macro, ").alias("tags_csv"),
        F.when(d % 5 == 0, "news").when(d % 5 == 1, "analysis").when(d % 5 == 2, "education").otherwise("opinion").alias("content_type"),
        F.when(d % 8 != 0, base + F.make_dt_interval(mins=(d * 7).cast("int"))).alias("published_at"),
        (base + F.make_dt_interval(mins=(d * 3).cast("int"))).alias("created_at"),
    )


CONTENT = """
fx_content as materialized (
  select doc_id as id, split_part(text, chr(10), 1) as title, case when doc_id % 6 <> 0 then text end as excerpt,
         case when doc_id % 3 <> 0 then 'S' || lpad(cast(doc_id % 10 as varchar), 6, '0') end as ticker,
         case doc_id % 4 when 0 then 'ai,macro' when 1 then 'macd' when 2 then 'rsi,  macro, ' end as tags_csv,
         case doc_id % 5 when 0 then 'news' when 1 then 'analysis' when 2 then 'education' else 'opinion' end as content_type,
         case when doc_id % 8 <> 0 then timestamp '2024-01-01' + to_minutes(doc_id * 7) end as published_at,
         timestamp '2024-01-01' + to_minutes(doc_id * 3) as created_at
  from documents)"""
