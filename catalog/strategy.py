"""Strategy evaluation: clusters, trades, metrics and equity curves over ranges and cases."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.operators import signals, strategy, timeframes
from catalog.fixtures import PRICES, bars, q6, r6
from catalog.market import EDGES, MACD_EWM, RULE, STARTS, _ranges
from catalog.registry import query

RULE_KNOBS = signals.Rule(require_all=False)
_DONE: dict[tuple[str, str], strategy.Evaluation] = {}


def evaluation(spark, sf) -> strategy.Evaluation:
    """One evaluation per session and scale; its results read the same staged tables."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _DONE:
        _DONE[key] = strategy.Evaluation(bars(spark, sf), RULE_KNOBS)
    return _DONE[key]


# ticker holds 'range|ticker' below, so that the recursive means run per range
SIGNALS = f"""
{PRICES.replace("fx_prices as materialized", "fx_all as materialized").strip()},
{EDGES.replace("fx_prices", "fx_all")},
ranges as materialized ({_ranges("last", {n: STARTS[n] for n in timeframes.STRATEGY_NAMES})}),
fx_prices as materialized (
  select r.timeframe || '|' || p.ticker as ticker, p.date, p.close, r.start_date
  from fx_all p join ranges r on r.ticker = p.ticker and p.date >= r.start_date),
{MACD_EWM}, {RULE},
flagged as materialized (
  select ticker, date, close, start_date, b1::int + b2::int + b3::int >= 2 as buy, s1::int + s2::int + s3::int >= 2 as sell from ruled)"""

CLUSTERS = f"""{SIGNALS},
events as (
  select ticker, 'buy' as side, date, close from flagged where buy
  union all select ticker, 'sell', date, close from flagged where sell),
gaps as (select *, lag(date) over (partition by ticker, side order by date) as was from events),
clustered as materialized (
  select ticker, side, date, close,
         sum(case when was is null or date - was > 3 then 1 else 0 end) over (partition by ticker, side order by date
             rows between unbounded preceding and current row) - 1 as cluster from gaps)"""

PICKED = f"""{CLUSTERS},
placed as (
  select *, row_number() over (partition by ticker, side, cluster order by date) - 1 as i,
         count(*) over (partition by ticker, side, cluster) as n,
         min(date) over (partition by ticker, side, cluster) as start_date from clustered),
picked as materialized (
  select p.ticker, p.side, c."case", p.cluster, p.start_date, p.n as size, p.date, p.close
  from placed p join (values ('min', 0.0::double), ('average', 0.5::double), ('greedy', 0.75::double)) c("case", q)
    on p.i = cast(round_even(c.q * (p.n - 1), 0) as bigint))"""

TRADES = f"""{PICKED},
buys as materialized (select * from picked where side = 'buy'),
sells as materialized (select * from picked where side = 'sell'),
pairs as (
  select b.ticker, b."case", b.cluster as k,
         (select min(s.cluster) from sells s where s.ticker = b.ticker and s."case" = b."case" and s.start_date > b.date) as m
  from buys b where b.cluster = 0
  union all
  select b.ticker, b."case", b.cluster,
         (select min(s.cluster) from sells s where s.ticker = b.ticker and s."case" = b."case" and s.start_date > b.date and s.cluster > p.m)
  from pairs p join buys b on b.ticker = p.ticker and b."case" = p."case" and b.cluster = p.k + 1),
ends as materialized (
  select ticker, max(start_date) as start_date, max(date) as last_date, arg_max(close, date) as last_close from flagged group by 1),
trades as materialized (
  select b.ticker, b."case", b.cluster as trade_no, b.date as entry_date, b.close as entry_price,
         coalesce(s.date, e.last_date) as exit_date, coalesce(s.close, e.last_close) as exit_price, s.date is not null as closed_by_signal
  from buys b join pairs p on p.ticker = b.ticker and p."case" = b."case" and p.k = b.cluster
  left join sells s on s.ticker = b.ticker and s."case" = b."case" and s.cluster = p.m
  join ends e on e.ticker = b.ticker)"""

TF = "split_part(ticker, '|', 1) as timeframe, split_part(ticker, '|', 2) as ticker"


@query("strat_signals", f"with recursive {SIGNALS} select {TF}, date, close, buy as buy_signal, sell as sell_signal from flagged")
def strat_signals(spark, sf):
    return evaluation(spark, sf).flagged.drop("start_date")


@query("strat_clusters", f"with recursive {CLUSTERS} select {TF}, side, date, cast(cluster as bigint) as cluster from clustered")
def strat_clusters(spark, sf):
    return evaluation(spark, sf).clustered.select("timeframe", "ticker", "side", "date", F.col("cluster").cast("long"))


@query(
    "strat_picks",
    f"""with recursive {PICKED} select {TF}, side, "case", cast(cluster as bigint) as cluster, start_date, size, date, close from picked""",
)
def strat_picks(spark, sf):
    return evaluation(spark, sf).picked.withColumn("cluster", F.col("cluster").cast("long"))


@query(
    "strat_trades",
    f"""with recursive {TRADES}
select {TF}, "case", cast(trade_no as bigint) as trade_no, entry_date, entry_price, exit_date, exit_price, closed_by_signal,
       {q6("(exit_price / entry_price - 1) * 100")} as return_pct from trades""",
)
def strat_trades(spark, sf):
    out = strategy.with_return(evaluation(spark, sf).trades)
    return out.withColumn("return_pct", r6("return_pct")).withColumn("trade_no", F.col("trade_no").cast("long"))


@query(
    "strat_metrics",
    f"""with recursive {TRADES},
growth as (
  select *, exit_price / entry_price - 1 as r,
         product(exit_price / entry_price) over (partition by ticker, "case" order by trade_no
             rows between unbounded preceding and current row) as equity from trades),
falls as (
  select *, greatest(1, max(equity) over (partition by ticker, "case" order by trade_no
             rows between unbounded preceding and current row)) as top from growth),
sums as (
  select ticker, "case", count(*) as n, arg_max(equity, trade_no) - 1 as total, avg(case when r > 0 then 1.0 else 0.0 end) as win,
         avg(r) as mean, greatest(1, arg_max(exit_date, trade_no) - arg_min(entry_date, trade_no)) as days,
         least(0, min((equity - top) / top)) as fall, avg(exit_date - entry_date) as held from falls group by 1, 2),
grid as (select ticker, c."case" from ends, (values ('min'), ('average'), ('greedy')) c("case"))
select split_part(g.ticker, '|', 1) as timeframe, split_part(g.ticker, '|', 2) as ticker, g."case",
       cast(coalesce(n, 0) as bigint) as num_trades, {q6("coalesce(total * 100, 0)")} as total_return_pct,
       {q6("coalesce(win, 0)")} as win_rate, {q6("coalesce(mean, 0)")} as avg_return_per_trade,
       {q6("(pow(1 + total, 365.0 / days) - 1) * 100")} as annualized_return_pct,
       {q6("coalesce(fall * 100, 0)")} as max_drawdown_pct, {q6("held")} as avg_holding_days
from grid g left join sums s on s.ticker = g.ticker and s."case" = g."case" """,
)
def strat_metrics(spark, sf):
    soft = ("total_return_pct", "win_rate", "avg_return_per_trade", "annualized_return_pct", "max_drawdown_pct", "avg_holding_days")
    return evaluation(spark, sf).metrics().select("timeframe", "ticker", "case", "num_trades", *[r6(c).alias(c) for c in soft])


@query(
    "strat_equity",
    f"""with recursive {TRADES},
ordered as (
  select t.*, e.start_date, e.last_date, row_number() over w as i,
         product(exit_price / entry_price) over (w rows between unbounded preceding and current row) as after,
         product(exit_price / entry_price) over (w rows between unbounded preceding and 1 preceding) as before,
         lag(exit_date) over w as was, count(*) over (partition by t.ticker, "case") as n
  from trades t join ends e on e.ticker = t.ticker window w as (partition by t.ticker, "case" order by exit_date, trade_no)),
points as (
  select ticker, "case", i, 1 as part, exit_date - 1 as date, coalesce(before, 1) as value from ordered
    where exit_date - 1 > coalesce(was, start_date)
  union all select ticker, "case", i, 2, exit_date, after from ordered
  union all select ticker, "case", 0, 0, start_date, 1 from ordered where i = 1
  union all select ticker, "case", i, 3, last_date, after from ordered where i = n and last_date > exit_date
  union all
  select g.ticker, g."case", 0, 0, unnest(generate_series(g.start_date::timestamp, g.last_date::timestamp, interval 1 day))::date, 1
  from (select ticker, start_date, last_date, c."case" from ends, (values ('min'), ('average'), ('greedy')) c("case")) g
  where not exists (select 1 from trades t where t.ticker = g.ticker and t."case" = g."case"))
select {TF}, "case", cast(row_number() over (partition by ticker, "case" order by i, part, date) - 1 as bigint) as step_no, date,
       {q6("value")} as value from points""",
)
def strat_equity(spark, sf):
    return evaluation(spark, sf).equity().withColumn("value", r6("value")).withColumn("step_no", F.col("step_no").cast("long"))
