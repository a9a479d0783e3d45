"""Companies, statements, content, keyed writes and table rules."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from barloom.functions import dates, numbers, text
from barloom.operators import companies as company_ops
from barloom.operators import content as content_ops
from barloom.operators import financials as statement_ops
from barloom.operators import insights, merge, quality
from barloom.sources import tables
from barloom.sources.prices import scratch
from barloom.sources.tables import conform
from catalog.fixtures import (
    AS_OF,
    COMPANIES,
    CONTENT,
    PRICES_RAW,
    WATCHLIST_ITEMS,
    companies,
    content,
    prices_raw,
    table,
    ticker_of,
    watchlist_items,
)
from catalog.registry import query

# ---------------------------------------------------------------- companies and statements


def statements(spark, sf):
    """Yearly figures of each supplier."""
    year = F.year("l_shipdate")
    money = lambda c: c.cast("decimal(18,2)")
    return (
        table(spark, sf, "lineitem")
        .groupBy("l_suppkey", year.alias("y"))
        .agg(
            F.sum(money(F.col("l_extendedprice"))).cast("decimal(30,2)").alias("revenue"),
            F.sum(money(F.col("l_extendedprice") * 0.6)).cast("decimal(30,2)").alias("cost_of_revenue"),
            (F.sum(money(F.col("l_extendedprice"))) - F.sum(money(F.col("l_quantity") * 1500))).cast("decimal(30,2)").alias("net"),
        )
        .select(
            ticker_of(F.col("l_suppkey")).alias("ticker"),
            F.make_date(F.col("y"), F.lit(12), F.lit(31)).alias("period_end"),
            F.lit("FY").alias("period_type"),
            "revenue",
            "cost_of_revenue",
            F.when((F.col("l_suppkey") + F.col("y")) % 9 != 0, F.col("net")).alias("net_income"),
        )
    )


STATEMENTS = """
fx_financials as materialized (
  select 'S' || lpad(cast(l_suppkey as varchar), 6, '0') as ticker, make_date(cast(year(l_shipdate) as int), 12, 31) as period_end,
         'FY' as period_type,
         cast(sum(cast(l_extendedprice as decimal(18, 2))) as decimal(30, 2)) as revenue,
         cast(sum(cast(l_extendedprice * 0.6 as decimal(18, 2))) as decimal(30, 2)) as cost_of_revenue,
         case when (l_suppkey + year(l_shipdate)) % 9 = 0 then null
              else cast(sum(cast(l_extendedprice as decimal(18, 2))) - sum(cast(l_quantity * 1500 as decimal(18, 2))) as decimal(30, 2)) end as net_income
  from lineitem group by l_suppkey, year(l_shipdate))"""


def statement_items(spark, sf):
    """The figures as item rows, with some statements missing in some years."""
    y = F.year("period_end")
    row = lambda s, i, v: F.struct(F.lit(s).alias("statement"), F.lit(i).alias("item"), v.cast("double").alias("value"))
    rows = F.array(
        row("income", "Total Revenue", F.col("revenue")),
        row("income", "Net Income", F.col("net_income")),
        F.when(y % 2 == 0, row("balance", "Total Assets", F.col("revenue").cast("double") * 2)),
        F.when(y % 3 != 0, row("cashflow", "Capital Expenditures", F.col("cost_of_revenue").cast("double") * 0.1)),
        F.when(y % 2 == 1, row("balance", "totalLiabilities", F.col("cost_of_revenue").cast("double"))),
        F.when(y % 2 == 1, row("balance", "Total Liab", F.lit(0.0))),
    )
    return statements(spark, sf).select("ticker", "period_end", F.inline(F.array_compact(rows)))


@query("insights_top_companies", f"""with {COMPANIES}, {STATEMENTS}
select f.ticker, period_end, net_income, name as company_name from fx_financials f join fx_companies c using (ticker)
where net_income is not null order by net_income desc, ticker, period_end limit 20""")
def insights_top_companies(spark, sf):
    return insights.top_companies(companies(spark, sf), statements(spark, sf), 20)


@query("insights_top_latest", f"""with {COMPANIES}, {STATEMENTS},
newest as (select * from fx_financials qualify row_number() over (partition by ticker order by period_end desc) = 1)
select f.ticker, period_end, net_income, name as company_name from newest f join fx_companies c using (ticker)
where net_income is not null order by net_income desc, ticker limit 20""")
def insights_top_latest(spark, sf):
    return insights.top_companies(companies(spark, sf), statements(spark, sf), 20, latest_only=True)


@query("financials_latest", f"with {STATEMENTS} select * from fx_financials qualify row_number() over (partition by ticker order by period_end desc) = 1")
def financials_latest(spark, sf):
    return statement_ops.latest(statements(spark, sf))


@query("financials_history", f"""with {STATEMENTS}, {COMPANIES}
select f.ticker, period_end, revenue, net_income from fx_financials f join fx_companies c using (ticker) where sector = 'EUROPE'""")
def financials_history(spark, sf):
    wanted = companies(spark, sf).filter("sector = 'EUROPE'")
    return statement_ops.history(statements(spark, sf), wanted).select("ticker", "period_end", "revenue", "net_income")


@query("financials_assemble", f"""with {STATEMENTS}
select ticker, period_end, 'FY' as period_type, cast(cast(revenue as double) as decimal(38, 2)) as revenue,
       cast(cast(net_income as double) as decimal(38, 2)) as net_income,
       case when year(period_end) % 2 = 0 then cast(cast(revenue as double) * 2 as decimal(38, 2)) end as total_assets,
       case when year(period_end) % 2 = 1 then cast(cast(cost_of_revenue as double) as decimal(38, 2)) end as total_liabilities,
       cast(case when year(period_end) % 3 <> 0 then round_even(cast(cast(cast(cost_of_revenue as double) * 0.1 as varchar) as decimal(18, 10)), 2) end as decimal(38, 2)) as capital_expenditures
from fx_financials""")
def financials_assemble(spark, sf):
    return statement_ops.assemble(statement_items(spark, sf)).select(
        "ticker", "period_end", "period_type", "revenue", "net_income", "total_assets", "total_liabilities", "capital_expenditures"
    )


@query("financials_transpose", f"""with {STATEMENTS}
select ticker, 'income' as statement, 'Total Revenue' as item, period_end, cast(revenue as double) as value from fx_financials where revenue is not null""")
def financials_transpose(spark, sf):
    wide = (
        statements(spark, sf)
        .groupBy("ticker")
        .pivot("period_end", [date(y, 12, 31) for y in range(1992, 2003)])
        .agg(F.max(F.col("revenue").cast("double")))
        .withColumns({"statement": F.lit("income"), "item": F.lit("Total Revenue")})
    )
    return statement_ops.transpose(wide).filter("value is not null")


def company_documents(spark, sf):
    """One company document per customer, with that customer as officer; a ticker comes in many documents."""
    size = table(spark, sf, "supplier").agg(F.count(F.lit(1)).alias("n"))
    officer = F.struct(
        F.col("c_name").alias("name"),
        F.when(F.col("c_custkey") % 4 != 0, F.col("c_mktsegment")).alias("title"),
        (1950 + F.col("c_custkey") % 40).alias("yearBorn"),
        F.when(F.col("c_custkey") % 3 != 0, 2023).alias("fiscalYear"),
        F.col("c_acctbal").alias("totalPay"),
        F.col("c_nationkey").alias("nation"),
        F.lit("fixed").alias("pay"),
    )
    info = F.to_json(
        F.struct(
            F.when(F.col("c_custkey") % 5 != 0, F.col("c_name")).alias("longName"),
            F.col("c_mktsegment").alias("shortName"),
            F.col("c_nationkey").alias("fullTimeEmployees"),
            F.col("c_acctbal").alias("beta"),
            (F.lit(1700000000) + F.col("c_custkey") * 86400).alias("lastDividendDate"),
            (F.col("c_custkey") % 2 == 0).alias("esgPopulated"),
            F.array(officer).alias("companyOfficers"),
        )
    )
    return table(spark, sf, "customer").select(
        F.concat(F.lit(" "), F.lower(ticker_of(F.col("c_custkey") % size.scalar()))).alias("ticker"), "c_custkey", info.alias("info")
    )


@query("company_officers", """
select 'S' || lpad(cast(c_custkey % n as varchar), 6, '0') as ticker, c_name as name,
       case when c_custkey % 4 = 0 then '' else c_mktsegment end as title, cast(1950 + c_custkey % 40 as int) as year_of_birth,
       cast(case when c_custkey % 3 = 0 then 0 else 2023 end as int) as fiscal_year, cast(cast(c_acctbal as decimal(38, 10)) as decimal(38, 2)) as total_pay,
       '{"nation":' || c_nationkey || ',"pay":"fixed"}' as extra
from customer, (select count(*) as n from supplier)""")
def company_officers(spark, sf):
    return company_ops.officers(company_documents(spark, sf)).drop("age")


@query("company_profile", """
select 'S' || lpad(cast(c_custkey % n as varchar), 6, '0') as ticker, case when c_custkey % 5 = 0 then c_mktsegment else c_name end as name,
       c_mktsegment as short_name, cast(c_nationkey as bigint) as full_time_employees,
       cast(cast(c_acctbal as decimal(38, 10)) as decimal(38, 6)) as beta, cast(make_timestamp((1700000000 + c_custkey * 86400) * 1000000) as date) as last_dividend_date,
       c_custkey % 2 = 0 as esg_populated
from customer, (select count(*) as n from supplier)""")
def company_profile(spark, sf):
    return company_ops.profile(company_documents(spark, sf)).select(
        "ticker", "name", "short_name", "full_time_employees", "beta", "last_dividend_date", "esg_populated"
    )


@query("number_functions", """
select o_orderkey, cast(round_even(cast(o_totalprice / 7 as decimal(38, 10)), 2) as decimal(38, 2)) as money,
       case when o_custkey % 3 = 0 then null else cast(o_custkey as bigint) end as whole,
       cast(round_even(o_custkey / 2, 0) as int) as nearest, o_orderstatus = 'O' as flag,
       cast(case when o_custkey % 2 <> 0 then o_custkey % 2 else o_orderkey end as bigint) as filled
from orders""")
def number_functions(spark, sf):
    o = table(spark, sf, "orders")
    key = F.col("o_custkey")
    return o.select(
        "o_orderkey",
        numbers.decimal(F.col("o_totalprice") / 7, 2).alias("money"),
        numbers.strict_int(F.when(key % 3 == 0, F.concat(key.cast("string"), F.lit(".5"))).otherwise(key.cast("string"))).alias("whole"),
        numbers.rounded_int((key / 2).cast("string")).alias("nearest"),
        numbers.to_bool(F.when(F.col("o_orderstatus") == "O", "T").otherwise("maybe")).alias("flag"),
        numbers.first_filled(key % 2, F.col("o_orderkey")).cast("long").alias("filled"),
    )


@query("date_functions", """
select o_orderkey, cast(o_orderdate as date) as from_text, cast(o_orderdate as date) as from_epoch,
       cast(o_orderdate as timestamp) + interval 3 hour as feed, null::date as broken
from orders""")
def date_functions(spark, sf):
    ts = F.col("o_orderdate").cast("timestamp")
    feed = F.concat(F.date_format(ts + F.expr("interval 5 hours"), "'Tue, 'dd MMM yyyy HH:mm:ss"), F.lit(" +0200"))
    return table(spark, sf, "orders").select(
        "o_orderkey",
        dates.to_date_or_null(F.date_format(ts, "yyyy-MM-dd")).alias("from_text"),
        dates.to_date_or_null(F.unix_timestamp(ts)).alias("from_epoch"),
        dates.feed_time(feed).cast("timestamp_ntz").alias("feed"),
        dates.to_date_or_null(F.col("o_orderpriority")).alias("broken"),
    )


# ---------------------------------------------------------------- content


def tagged(spark, sf):
    return content(spark, sf).withColumn("tags", text.tags(F.col("tags_csv")))


LIVE = "published_at is not null and published_at <= timestamp '2024-01-31'"


@query("content_page", f"""with {CONTENT}
select id, title, published_at from fx_content where {LIVE} order by published_at desc nulls last, created_at desc, id limit 12 offset 12""")
def content_page(spark, sf):
    out = content_ops.where(tagged(spark, sf), "live", AS_OF)
    return content_ops.page(out, 2, 12).select("id", "title", "published_at")


@query("content_admin_page", f"with {CONTENT} select id, created_at from fx_content order by created_at desc, id limit 500")
def content_admin_page(spark, sf):
    return content_ops.page(tagged(spark, sf), 0, 500, newest="created").select("id", "created_at")


@query("content_count", f"""with {CONTENT}
select count(*) as rows, cast(greatest(1, ceil(count(*) / 12)) as bigint) as pages from fx_content
where {LIVE} and list_has_any(list_transform(string_split(tags_csv, ','), lambda x: trim(x)), ['macro'])""")
def content_count(spark, sf):
    out = content_ops.where(tagged(spark, sf), "live", AS_OF, tags_any=["macro"])
    return content_ops.count_pages(out, 12)


@query("content_search", f"""with {CONTENT}
select id, title from fx_content where published_at is not null and ticker = 'S000004' and (title ilike '%e_r%' or excerpt ilike '%e_r%') and content_type = 'opinion'""")
def content_search(spark, sf):
    out = content_ops.where(tagged(spark, sf), "published", ticker=" s000004 ", term="e_r", content_type="opinion")
    return out.select("id", "title")


@query("content_status", f"with {CONTENT} select id, case when {LIVE} then 'live' when published_at is null then 'draft' else 'planned' end as state from fx_content")
def content_status(spark, sf):
    c = content(spark, sf)
    parts = {"live": content_ops.status("live", AS_OF), "draft": content_ops.status("drafts")}
    return c.select("id", F.when(parts["live"], "live").when(parts["draft"], "draft").otherwise("planned").alias("state"))


@query("content_create", f"""with {CONTENT},
s as (select *, replace(regexp_replace(regexp_replace(regexp_replace(lower(trim(title)), '[^\\p{{L}}\\p{{N}}\\s_-]', '', 'g'), '[\\s_]', '-', 'g'), '^-+|-+$', '', 'g'), '--', '-') as made
      from fx_content)
select id, trim(title) as title, case when ticker is not null then lower(ticker) || '-' || content_type else nullif(made, '') end as slug,
       list_filter(list_transform(string_split(coalesce(tags_csv, ''), ','), lambda x: trim(x)), lambda x: x <> '') as tags,
       case when published_at is null then null else timestamp '2024-01-31' end as published_at from s""")
def content_create(spark, sf):
    raw = content(spark, sf).select(
        "id",
        "title",
        F.when(F.col("ticker").isNotNull(), F.concat_ws(" ", "ticker", "content_type")).alias("slug"),
        F.lit("").alias("body"),
        "excerpt",
        F.lit("  ").alias("image_url"),
        "ticker",
        "tags_csv",
        "content_type",
        F.col("published_at").isNotNull().alias("publish"),
    )
    out = content_ops.create(raw, AS_OF, "publish")
    return out.select("id", "title", "slug", "tags", F.col("published_at").cast("timestamp_ntz").alias("published_at"))


@query("content_patch", f"""with {CONTENT},
votes as (select doc_id, max(quality) as good, max(toxic) as bad from labels group by 1)
select c.id, case when v.good = 1 and v.bad = 0 then 'Checked: ' || c.title else c.title end as title,
       case when v.bad = 1 then null when v.good = 1 then timestamp '2024-01-31' else c.published_at end as published_at,
       case when v.doc_id is not null then timestamp '2024-01-31' else c.created_at end as updated_at
from fx_content c left join votes v on v.doc_id = c.id""")
def content_patch(spark, sf):
    now = F.lit(AS_OF).cast("timestamp_ntz")
    votes = table(spark, sf, "labels").groupBy(F.col("doc_id").alias("id")).agg(F.max("quality").alias("good"), F.max("toxic").alias("bad"))
    rows = content(spark, sf).select("id", "title", "published_at", F.col("created_at").alias("updated_at"))
    fine = (F.col("good") == 1) & (F.col("bad") == 0)
    edits = votes.join(rows.select("id", "title"), "id").select(
        "id",
        F.when(fine, F.concat(F.lit("Checked: "), "title")).alias("title"),
        F.when(F.col("good") == 1, now).alias("published_at"),
        F.when(F.col("bad") == 1, F.array(F.lit("published_at"))).alias("cleared"),
    )
    return merge.patch(rows, edits, ["id"], ["title", "published_at"], cleared="cleared", stamp={"updated_at": now})


@query("content_lookup", f"with {CONTENT} select id, title from fx_content where id in (select doc_id from labels where quality = 1)")
def content_lookup(spark, sf):
    from barloom.operators.query import lookup

    wanted = table(spark, sf, "labels").filter("quality = 1").select(F.col("doc_id").alias("id"))
    return lookup(content(spark, sf), wanted, ["id"]).select("id", "title")


# ---------------------------------------------------------------- keyed writes


def target(spark, sf):
    """One row per customer."""
    key = F.col("c_custkey").cast("long")
    return table(spark, sf, "customer").select(key.alias("k"), F.col("c_acctbal").cast("double").alias("amount"), (-key).alias("created_seq"))


def changes(spark, sf):
    """Every event as a change of its user, many per key; errors delete."""
    return table(spark, sf, "events").select(
        F.col("event_id").alias("seq"),
        F.col("user_id").alias("k"),
        F.when(F.col("event_type") == "error", "D").otherwise("U").alias("op"),
        F.col("value").alias("amount"),
        F.col("event_id").alias("created_seq"),
    )


MERGE = """
tgt as (select cast(c_custkey as bigint) as k, cast(c_acctbal as double) as amount, cast(-c_custkey as bigint) as created_seq from customer),
chg as (select event_id as seq, user_id as k, case when event_type = 'error' then 'D' else 'U' end as op, value as amount, event_id as created_seq from events),
last as (select * from chg qualify row_number() over (partition by k order by seq desc) = 1)"""


@query("merge_upsert", f"with {MERGE} select coalesce(l.k, t.k) as k, coalesce(l.amount, t.amount) as amount, coalesce(l.created_seq, t.created_seq) as created_seq from tgt t full join last l using (k)")
def merge_upsert(spark, sf):
    return merge.upsert(target(spark, sf), changes(spark, sf).drop("op"), ["k"], order="seq")


@query("merge_preserve", f"with {MERGE} select coalesce(l.k, t.k) as k, coalesce(l.amount, t.amount) as amount, coalesce(t.created_seq, l.created_seq) as created_seq from tgt t full join last l using (k)")
def merge_preserve(spark, sf):
    return merge.upsert(target(spark, sf), changes(spark, sf).drop("op"), ["k"], order="seq", preserve=["created_seq"])


@query("merge_insert_new", f"""with {MERGE}, first as (select * from chg qualify row_number() over (partition by k order by seq) = 1)
select * from tgt union all select k, amount, created_seq from first where k not in (select k from tgt)""")
def merge_insert_new(spark, sf):
    return merge.insert_new(target(spark, sf), changes(spark, sf).drop("op"), ["k"], order="seq")


@query("merge_patch", f"""with {MERGE},
touch as (select * from chg where op = 'D' or amount > 50 qualify row_number() over (partition by k order by seq desc) = 1)
select t.k, case when l.k is null then t.amount when l.op = 'U' then l.amount end as amount, t.created_seq, l.k is not null as stamped
from tgt t left join touch l using (k)""")
def merge_patch(spark, sf):
    """All changes of a key folded: the last that sets or clears the amount counts."""
    every = changes(spark, sf).select(
        "k",
        "seq",
        F.when(F.col("amount") > 50, F.col("amount")).alias("amount"),
        F.when(F.col("op") == "D", F.array(F.lit("amount"))).alias("cleared"),
    )
    fold = every.filter("amount is not null or cleared is not null")
    plain = target(spark, sf).withColumn("stamped", F.lit(False))
    return merge.patch(plain, fold, ["k"], ["amount"], cleared="cleared", stamp={"stamped": F.lit(True)}, order="seq")


@query("merge_delete", f"with {MERGE} select * from tgt where k not in (select k from last where op = 'D')")
def merge_delete(spark, sf):
    from barloom.operators.dedupe import latest_per_key

    gone = latest_per_key(changes(spark, sf), ["k"], "seq").filter("op = 'D'")
    return merge.delete(target(spark, sf), gone, ["k"])


@query("merge_apply_changes", f"""with {MERGE}
select * from tgt where k not in (select k from last) union all select k, amount, created_seq from last where op = 'U'""")
def merge_apply_changes(spark, sf):
    return merge.apply_changes(target(spark, sf), changes(spark, sf), ["k"])


@query("merge_rekey", f"""with {MERGE},
moves as (select k as old_k, case when k % 2 = 0 then k + 1000000000 else k end as new_k, amount + 1 as amount, created_seq from tgt)
select new_k as k, amount, created_seq from moves""")
def merge_rekey(spark, sf):
    t = target(spark, sf)
    moves = t.select(
        F.col("k").alias("old_k"),
        F.when(F.col("k") % 2 == 0, F.col("k") + 1000000000).otherwise(F.col("k")).alias("new_k"),
        F.row_number().over(Window.partitionBy("k").orderBy("created_seq")).cast("long").alias("seq"),
        (F.col("amount") + 1).alias("amount"),
        "created_seq",
    )
    return merge.rekey(t, moves, ["k"], "old_k", "new_k")


@query("table_update", f"with {MERGE} select coalesce(l.k, t.k) as k, coalesce(l.amount, t.amount) as amount, coalesce(l.created_seq, t.created_seq) as created_seq from tgt t full join last l using (k)")
def table_update(spark, sf):
    """Read, merge and write back at one path."""
    path = scratch(spark, "update")
    tables.replace(target(spark, sf), path)
    tables.replace(merge.upsert(spark.read.parquet(path), changes(spark, sf).drop("op"), ["k"], order="seq"), path)
    return spark.read.parquet(path)


@query("table_delete", f"with {MERGE} select *, cast(k % 8 as int) as part from tgt where k not in (select k from last where op = 'D') and k % 8 <> 3")
def table_delete(spark, sf):
    """Deletes in a partitioned table, which empty one of its partitions."""
    from barloom.operators.dedupe import latest_per_key

    path = scratch(spark, "delete")
    tables.replace(target(spark, sf).withColumn("part", (F.col("k") % 8).cast("int")), path, by=["part"])
    gone = latest_per_key(changes(spark, sf), ["k"], "seq").filter("op = 'D'").select("k")
    gone = gone.union(target(spark, sf).filter("k % 8 = 3").select("k")).distinct()
    tables.replace(merge.delete(spark.read.parquet(path), gone, ["k"]), path, by=["part"])
    return spark.read.parquet(path)


@query("merge_cascade", "select o_orderkey, o_custkey from orders where o_custkey not in (select c_custkey from customer where c_acctbal < 0)")
def merge_cascade(spark, sf):
    gone = table(spark, sf, "customer").filter("c_acctbal < 0")
    return merge.cascade(gone, table(spark, sf, "orders"), "c_custkey", "o_custkey").select("o_orderkey", "o_custkey")


@query("merge_set_null", "select o_orderkey, case when o_custkey not in (select c_custkey from customer where c_acctbal < 0) then o_custkey end as o_custkey from orders")
def merge_set_null(spark, sf):
    gone = table(spark, sf, "customer").filter("c_acctbal < 0")
    return merge.cascade(gone, table(spark, sf, "orders"), "c_custkey", "o_custkey", "set_null").select("o_orderkey", "o_custkey")


@query("merge_watchlist_items", f"""with {WATCHLIST_ITEMS}
select watchlist_id, upper(trim(ticker)) as ticker, arg_max(allocation, position) as allocation from fx_items group by 1, 2""")
def merge_watchlist_items(spark, sf):
    items = watchlist_items(spark, sf).withColumn("ticker", text.normal_ticker(F.col("ticker")))
    empty = items.limit(0).drop("position")
    return merge.upsert(empty, items, ["watchlist_id", "ticker"], order="position")


@query("merge_csv", f"""with {MERGE} select cast(k as varchar) as k, cast(amount as varchar) as amount from last""")
def merge_csv(spark, sf):
    from barloom.sources.prices import scratch
    from barloom.sources.tables import upsert_csv

    first, second = scratch(spark, "csv-first"), scratch(spark, "csv-second")
    rows = changes(spark, sf).select("seq", "k", "amount")
    middle = F.lit("2024-01-15").cast("timestamp_ntz")
    early = rows.join(table(spark, sf, "events").filter(F.col("ts") < middle).select(F.col("event_id").alias("seq")), "seq", "left_semi")
    upsert_csv(spark, early, None, first, ["k"])
    upsert_csv(spark, rows, first, second, ["k"], sort=["k"])
    return spark.read.option("header", True).csv(second)


# ---------------------------------------------------------------- table rules


@query("quality_unique", f"with {PRICES_RAW} select ticker, date, count(*) as copies from fx_prices_raw group by 1, 2 having count(*) > 1")
def quality_unique(spark, sf):
    return quality.check_unique(prices_raw(spark, sf), ["ticker", "date"])


@query("quality_domain", f"with {WATCHLIST_ITEMS} select watchlist_id, position, allocation from fx_items where allocation < 0")
def quality_domain(spark, sf):
    return quality.check_domain(watchlist_items(spark, sf), "allocation", minimum=0.0).select("watchlist_id", "position", "allocation")


@query("quality_values", f"with {CONTENT} select id, content_type from fx_content where content_type not in ('news', 'analysis', 'education')")
def quality_values(spark, sf):
    out = quality.check_domain(content(spark, sf), "content_type", ["news", "analysis", "education"])
    return out.select("id", "content_type")


@query("quality_not_null", f"with {STATEMENTS} select ticker, period_end from fx_financials where net_income is null")
def quality_not_null(spark, sf):
    return quality.check_not_null(statements(spark, sf), ["ticker", "period_end", "net_income"]).select("ticker", "period_end")


@query("quality_reference", f"""with {WATCHLIST_ITEMS}, {COMPANIES}
select watchlist_id, position, ticker from fx_items where ticker not in (select ticker from fx_companies)""")
def quality_reference(spark, sf):
    out = quality.check_reference(watchlist_items(spark, sf), companies(spark, sf), "ticker", "ticker")
    return out.select("watchlist_id", "position", "ticker")


@query("table_defaults", """
select c_custkey as user_id, c_name as username, false as is_admin, coalesce(case when c_acctbal > 0 then round_even(c_acctbal / 3, 4) end, 0) as balance,
       timestamp '2024-01-31' as created_at, []::varchar[] as tags from customer""")
def table_defaults(spark, sf):
    raw = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("username"), F.when(F.col("c_acctbal") > 0, F.col("c_acctbal") / 3).alias("balance")
    )
    schema = "user_id long, username string, is_admin boolean, balance double, created_at timestamp_ntz, tags array<string>"
    defaults = {
        "is_admin": F.lit(False),
        "balance": F.lit(0.0),
        "created_at": F.lit(AS_OF).cast("timestamp_ntz"),
        "tags": F.array().cast("array<string>"),
    }
    from pyspark.sql import types as T

    return conform(raw, T.StructType.fromDDL(schema), defaults, digits=4)


@query("user_names", "select c_custkey, split_part(c_name || '@example.com', '@', 1) as username from customer")
def user_names(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", text.user_name(F.concat("c_name", F.lit("@example.com"))).alias("username")
    )
