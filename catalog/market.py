"""Price bars, indicators and signals."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import functions as F

from barloom.operators import incremental, indicators, quality, query as lookup, signals, timeframes
from barloom.operators.dedupe import latest_snapshot
from barloom.plans import indicator_job, price_table
from barloom.sources import prices as price_source
from barloom.sources import tables
from catalog.fixtures import COMPANIES, PRICES, PRICES_RAW, bars, companies, prices_raw, q6, r6
from catalog.registry import query

W = "window w as (partition by ticker order by date)"


def back(n: int) -> str:
    return f"(w rows between {n - 1} preceding and current row)"


def rounded(df, keep, *names):
    return df.select(*keep, *[r6(n).alias(n) for n in names])


KEYS = ("ticker", "date")

# ---------------------------------------------------------------- scans and quality


@query(
    "price_latest_snapshot",
    f"""with {PRICES_RAW}
select ticker, date, open, high, low, close, volume, snapshot from fx_prices_raw
qualify row_number() over (partition by ticker, date order by snapshot desc) = 1""",
)
def price_latest_snapshot(spark, sf):
    return latest_snapshot(prices_raw(spark, sf), ["ticker", "date"], "snapshot")


@query(
    "price_scan_range",
    f"""with {PRICES}
select ticker, date, close, volume from fx_prices
where ticker = 'S000003' and date between date '1997-01-01' and date '1999-12-31'
order by date limit 10000""",
)
def price_scan_range(spark, sf):
    found = price_source.scan_range(bars(spark, sf), {"ticker": "S000003"}, start="1997-01-01", end="1999-12-31", limit=10000)
    return found.select("ticker", "date", "close", "volume")


@query(
    "price_lookup",
    f"""with {PRICES}, {COMPANIES}
select p.ticker, date, close from fx_prices p
where exists (select 1 from fx_companies c where c.ticker = p.ticker and sector = 'ASIA')""",
)
def price_lookup(spark, sf):
    wanted = companies(spark, sf).filter("sector = 'ASIA'").select("ticker")
    return lookup.lookup(bars(spark, sf), wanted, ["ticker"]).select("ticker", "date", "close")


@query(
    "price_clean",
    """
with texts as (
  select event_id, user_id, case when event_type = 'error' then 'n/a' else cast(ts as varchar) end as day,
         case when event_type = 'view' then 'none' else cast(value as varchar) end as price,
         case event_type when 'signup' then 'true' when 'click' then 'T' when 'purchase' then '1' else 'no' end as flag
  from events)
select event_id, cast(try_cast(day as timestamp) as date) as date, try_cast(price as double) as close, flag in ('true', 'T', '1') as buy_signal
from texts where try_cast(day as timestamp) is not null and try_cast(price as double) is not null""",
)
def price_clean(spark, sf):
    from catalog.fixtures import table

    kind = F.col("event_type")
    price = F.when(kind == "view", "none").otherwise(F.col("value").cast("string"))
    texts = table(spark, sf, "events").select(
        "event_id",
        F.when(kind == "error", "n/a").otherwise(F.col("ts").cast("string")).alias("date"),
        *[price.alias(c) for c in ("open", "high", "low", "close")],
        F.when(kind == "signup", "true").when(kind == "click", "T").when(kind == "purchase", "1").otherwise("no").alias("buy_signal"),
    )
    return quality.clean_prices(texts).select("event_id", "date", "close", "buy_signal")


@query(
    "price_profile",
    f"""with {PRICES}
select ticker, cast(year(date) as int) as year, count(*) as bars, min(date) as first_date, max(date) as last_date
from fx_prices group by 1, 2""",
)
def price_profile(spark, sf):
    return quality.profile_prices(bars(spark, sf))


@query(
    "price_newest",
    f"""with {PRICES}
select ticker, date, close from fx_prices qualify row_number() over (partition by ticker order by date desc) <= 10""",
)
def price_newest(spark, sf):
    return quality.newest(bars(spark, sf), 10).select("ticker", "date", "close")


@query(
    "price_raw_roundtrip",
    f"""with {PRICES_RAW}
select ticker, date, open, high, low, close, volume from fx_prices_raw
qualify row_number() over (partition by ticker, date order by snapshot desc) = 1""",
)
def price_raw_roundtrip(spark, sf):
    path = price_source.scratch(spark, "raw-prices")
    price_source.write_raw_prices(prices_raw(spark, sf), path)
    return price_source.read_prices(spark, path).select("ticker", "date", "open", "high", "low", "close", "volume")


# ---------------------------------------------------------------- indicators


@query(
    "ind_sma",
    f"""with {PRICES}
select ticker, date, {q6(f"avg(close) over {back(20)}")} as sma_20, {q6(f"avg(close) over {back(50)}")} as sma_50
from fx_prices {W}""",
)
def ind_sma(spark, sf):
    out = indicators.add(bars(spark, sf), indicators.sma(20), indicators.sma(50))
    return rounded(out, KEYS, "sma_20", "sma_50")


def _bands(deviation: str, fill: str) -> str:
    return f"""with {PRICES},
parts as (
  select ticker, date, avg(close) over {back(20)} as mid, coalesce({deviation}(close) over {back(20)}, {fill}) as std
  from fx_prices {W})
select ticker, date, {q6("mid")} as bb_mid, {q6("mid + 2 * std")} as bb_upper, {q6("mid - 2 * std")} as bb_lower from parts"""


@query("ind_bollinger_sample", _bands("stddev_samp", "null"))
def ind_bollinger_sample(spark, sf):
    return rounded(indicators.add(bars(spark, sf), indicators.bollinger(20, ddof=1)), KEYS, "bb_mid", "bb_upper", "bb_lower")


@query("ind_bollinger_fill", _bands("stddev_samp", "0"))
def ind_bollinger_fill(spark, sf):
    out = indicators.add(bars(spark, sf), indicators.bollinger(20, ddof=1, fill=0.0))
    return rounded(out, KEYS, "bb_mid", "bb_upper", "bb_lower")


@query("ind_bollinger_pop", _bands("stddev_pop", "0"))
def ind_bollinger_pop(spark, sf):
    out = indicators.add(bars(spark, sf), indicators.bollinger(20, ddof=0, fill=0.0))
    return rounded(out, KEYS, "bb_mid", "bb_upper", "bb_lower")


RSI_SMA = f"""
moves as (select *, close - lag(close) over (partition by ticker order by date) as change from fx_prices),
means as (
  select *, avg(case when change > 0 then change else 0 end) over {back(14)} as avg_gain,
         avg(case when change < 0 then -change else 0 end) over {back(14)} as avg_loss from moves {W})"""


@query(
    "ind_rsi_sma",
    f"""with {PRICES}, {RSI_SMA}
select ticker, date, {q6("avg_gain")} as avg_gain, {q6("avg_loss")} as avg_loss,
       {q6("100 - 100 / (1 + avg_gain / nullif(avg_loss, 0))")} as rsi from means""",
)
def ind_rsi_sma(spark, sf):
    return rounded(indicators.add(bars(spark, sf), indicators.rsi("sma")), KEYS, "avg_gain", "avg_loss", "rsi")


@query(
    "ind_rsi_sma_fill",
    f"""with {PRICES}, {RSI_SMA}
select ticker, date, {q6("coalesce(100 - 100 / (1 + avg_gain / nullif(avg_loss, 0)), 50)")} as rsi from means""",
)
def ind_rsi_sma_fill(spark, sf):
    return rounded(indicators.add(bars(spark, sf), indicators.rsi("sma", fill=50.0)), KEYS, "rsi")


MACD_SMA = f"""
fastslow as (select ticker, date, avg(close) over {back(12)} - avg(close) over {back(26)} as macd from fx_prices {W}),
macds as (select *, avg(macd) over {back(9)} as macd_signal from fastslow {W})"""


@query(
    "ind_macd_sma",
    f"""with {PRICES}, {MACD_SMA}
select ticker, date, {q6("macd")} as macd, {q6("macd_signal")} as macd_signal, {q6("macd - macd_signal")} as macd_hist from macds""",
)
def ind_macd_sma(spark, sf):
    return rounded(indicators.add(bars(spark, sf), indicators.macd("sma")), KEYS, "macd", "macd_signal", "macd_hist")


@query(
    "sig_crossover",
    f"""with {PRICES}, {MACD_SMA},
were as (select *, lag(macd) over w as was, lag(macd_signal) over w as was_signal from macds {W})
select ticker, date,
       cast(case when macd > macd_signal and was <= was_signal then 1 else 0 end as int) as buy,
       cast(case when macd < macd_signal and was >= was_signal then 1 else 0 end as int) as sell from were""",
)
def sig_crossover(spark, sf):
    out = indicators.add(bars(spark, sf), indicators.macd("sma"), signals.crossover())
    return out.select("ticker", "date", "buy", "sell")


def ewm_sql(source: str, value: str, alpha: str, out: str, key: str = "ticker") -> str:
    """A recursive mean over row numbers ``rn`` of ``source``; equal neighbours stay exactly equal."""
    return f"""
{out} as (
  select {key}, rn, cast({value} as double) as y from {source} where rn = 1
  union all
  select s.{key}, s.rn, case when p.y = s.{value} then p.y else (1 - {alpha}) * p.y + {alpha} * s.{value} end
  from {out} p join {source} s on s.{key} = p.{key} and s.rn = p.rn + 1)"""


MACD_EWM = f"""
numbered as materialized (select *, row_number() over (partition by ticker order by date) as rn from fx_prices),
{ewm_sql("numbered", "close", "(2.0::double / 13)", "fast")},
{ewm_sql("numbered", "close", "(2.0::double / 27)", "slow")},
lines as materialized (select ticker, rn, f.y - s.y as macd from fast f join slow s using (ticker, rn)),
{ewm_sql("lines", "macd", "0.2::double", "smooth")},
macd_ewm as materialized (
  select n.*, macd, y as macd_signal, macd - y as macd_hist
  from numbered n join lines using (ticker, rn) join smooth using (ticker, rn))"""


@query(
    "ind_macd_ewm",
    f"""with recursive {PRICES}, {MACD_EWM}
select ticker, date, {q6("macd")} as macd, {q6("macd_signal")} as macd_signal, {q6("macd_hist")} as macd_hist from macd_ewm""",
)
def ind_macd_ewm(spark, sf):
    return rounded(indicators.add(bars(spark, sf), indicators.macd("ewm")), KEYS, "macd", "macd_signal", "macd_hist")


WIDE_MACD = MACD_EWM.replace("2.0::double / 13", "2.0::double / 101").replace("2.0::double / 27", "2.0::double / 201").replace("0.2::double", "(2.0::double / 51)")


@query(
    "ind_macd_wide",
    f"""with recursive {PRICES}, {WIDE_MACD}
select ticker, date, {q6("macd")} as macd, {q6("macd_signal")} as macd_signal, {q6("macd_hist")} as macd_hist from macd_ewm""",
)
def ind_macd_wide(spark, sf):
    """Spans that reach over several blocks."""
    wide = indicators.macd("ewm", fast=100, slow=200, signal=50)
    return rounded(indicators.add(bars(spark, sf), wide, block_rows=64), KEYS, "macd", "macd_signal", "macd_hist")


RSI_WILDER = f"""
steps14 as materialized (
  select ticker, rn - 1 as rn, greatest(close - was, 0) as up, greatest(was - close, 0) as down
  from (select ticker, rn, close, lag(close) over (partition by ticker order by rn) as was from numbered) where was is not null),
{ewm_sql("steps14", "up", "(1.0::double / 14)", "ups")},
{ewm_sql("steps14", "down", "(1.0::double / 14)", "downs")},
wilder as materialized (
  select n.ticker, n.rn, coalesce(case when n.rn > 14 then 100 - 100 / (1 + u.y / nullif(d.y, 0)) end, 50) as rsi
  from numbered n left join ups u on u.ticker = n.ticker and u.rn = n.rn - 1
  left join downs d on d.ticker = n.ticker and d.rn = n.rn - 1)"""


@query(
    "ind_rsi_wilder",
    f"""with recursive {PRICES}, numbered as materialized (select *, row_number() over (partition by ticker order by date) as rn from fx_prices), {RSI_WILDER}
select ticker, date, {q6("rsi")} as rsi from numbered join wilder using (ticker, rn)""",
)
def ind_rsi_wilder(spark, sf):
    return rounded(indicators.add(bars(spark, sf), indicators.rsi("wilder")), KEYS, "rsi")


WIDE_RSI = RSI_WILDER.replace("/ 14)", "/ 200)").replace("n.rn > 14", "n.rn > 200")


@query(
    "ind_rsi_wide",
    f"""with recursive {PRICES}, numbered as materialized (select *, row_number() over (partition by ticker order by date) as rn from fx_prices), {WIDE_RSI}
select ticker, date, {q6("rsi")} as rsi from numbered join wilder using (ticker, rn)""",
)
def ind_rsi_wide(spark, sf):
    return rounded(indicators.add(bars(spark, sf), indicators.rsi("wilder", rows=200), block_rows=64), KEYS, "rsi")


@query(
    "indicator_job",
    f"""with {PRICES_RAW},
latest as (select * from fx_prices_raw qualify row_number() over (partition by ticker, date order by snapshot desc) = 1),
a as (
  select ticker, date, close, avg(close) over {back(20)} as sma20, avg(close) over {back(50)} as sma50,
         avg(close) over {back(12)} as ema12, avg(close) over {back(26)} as ema26,
         stddev_samp(close) over {back(20)} as std20, close - lag(close) over w as change from latest {W}),
b as (
  select *, ema12 - ema26 as macd, avg(case when change > 0 then change else 0 end) over {back(14)} as avg_gain,
         avg(case when change < 0 then -change else 0 end) over {back(14)} as avg_loss from a {W}),
c as (select *, avg(macd) over {back(9)} as signal from b {W}),
d as (select *, lag(macd) over w as was, lag(signal) over w as was_signal from c {W})
select ticker, date, {q6("sma20")} as "SMA20", {q6("sma50")} as "SMA50", {q6("ema12")} as "EMA12", {q6("ema26")} as "EMA26",
       {q6("macd")} as "MACD", {q6("signal")} as "Signal", {q6("macd - signal")} as "Histogram",
       {q6("avg_gain")} as "AvgGain", {q6("avg_loss")} as "AvgLoss",
       {q6("100 - 100 / (1 + avg_gain / nullif(avg_loss, 0))")} as "RSI",
       {q6("std20")} as "StdDev20", {q6("sma20 + 2 * std20")} as "UpperBand", {q6("sma20 - 2 * std20")} as "LowerBand",
       cast(case when macd > signal and was <= was_signal then 1 else 0 end as int) as "BuySignal",
       cast(case when macd < signal and was >= was_signal then 1 else 0 end as int) as "SellSignal" from d""",
)
def indicator_job_query(spark, sf):
    raw = prices_raw(spark, sf).select("ticker", "date", "close", "snapshot")
    out = indicator_job.from_snapshots(latest_snapshot(raw, ["ticker", "date"], "snapshot"))
    names = ("SMA20", "SMA50", "EMA12", "EMA26", "MACD", "Signal", "Histogram", "AvgGain", "AvgLoss", "RSI", "StdDev20", "UpperBand", "LowerBand")
    return rounded(out, ("ticker", F.col("Date").alias("date"), "BuySignal", "SellSignal"), *names)


# ---------------------------------------------------------------- signals

BATCH = f"""
{RSI_SMA},
ready as (
  select m.*, coalesce(100 - 100 / (1 + avg_gain / nullif(avg_loss, 0)), 50) as rsi, avg(close) over {back(20)} as mid,
         coalesce(stddev_samp(close) over {back(20)}, 0) as std, e.macd, e.macd_signal, e.macd_hist
  from means m join (select ticker, date, macd, macd_signal, macd_hist from macd_ewm) e using (ticker, date) {W}),
conds as (
  select *, mid + 2 * std as upper, mid - 2 * std as lower,
         macd < macd_signal and macd < 0 and rsi < 30 and close <= mid - 2 * std as buys,
         macd > macd_signal and macd > 0 and rsi > 70 and close >= mid + 2 * std as sells from ready),
batch as (select *, max(buys) over {back(5)} as buy_signal, max(sells) over {back(5)} as sell_signal from conds {W})"""


@query(
    "sig_batch_rule",
    f"with recursive {PRICES}, {MACD_EWM}, {BATCH} select ticker, date, buy_signal, sell_signal from batch",
)
def sig_batch_rule(spark, sf):
    return signals.batch_rule(bars(spark, sf)).select("ticker", "date", "buy_signal", "sell_signal")


@query(
    "price_table",
    f"""with recursive {PRICES}, {MACD_EWM}, {BATCH}
select ticker, date, volume, buy_signal, sell_signal, round(close, 4) as close,
       round(mid + 3.3e-9, 4) as bb_sma_20, round(upper + 3.3e-9, 4) as bb_upper_20, round(lower + 3.3e-9, 4) as bb_lower_20,
       round(rsi + 3.3e-9, 4) as rsi_14, round(macd + 3.3e-9, 4) as macd, round(macd_signal + 3.3e-9, 4) as macd_signal,
       round(macd_hist + 3.3e-9, 4) as macd_hist from batch""",
)
def price_table_query(spark, sf):
    out = price_table.build(bars(spark, sf), digits=None)
    soft = ("bb_sma_20", "bb_upper_20", "bb_lower_20", "rsi_14", "macd", "macd_signal", "macd_hist")
    return out.select(
        "ticker", "date", "volume", "buy_signal", "sell_signal", F.round("close", 4).alias("close"), *[F.round(F.col(c) + 3.3e-9, 4).alias(c) for c in soft]
    )


RULE = f"""
{RSI_WILDER},
banded as (
  select e.*, r.rsi, avg(close) over {back(20)} as mid, coalesce(stddev_pop(close) over {back(20)}, 0) as std,
         lag(macd_hist, 1, 0) over w as was
  from macd_ewm e join wilder r using (ticker, rn) {W}),
ruled as (
  select *, close < mid - 2 * std as b1, rsi < 35 as b2, macd_hist > 0 and was <= 0 as b3,
         close > mid + 2 * std as s1, rsi > 70 as s2, macd_hist < 0 as s3 from banded)"""


@query(
    "price_table_update",
    f"""with recursive {PRICES.replace("fx_prices as materialized", "fx_prices_all as materialized")},
fx_prices as materialized (select * from fx_prices_all where date >= date '2001-06-29' - 180 and date < date '2001-06-29'), {MACD_EWM}, {BATCH},
newest as (select * from batch qualify row_number() over (partition by ticker order by date desc) = 1)
select ticker, date, close, round(rsi + 3.3e-9, 4) as rsi_14, round(macd + 3.3e-9, 4) as macd from newest
union all
select ticker, date, close, null, null from fx_prices_all p where not exists (select 1 from newest n where n.ticker = p.ticker and n.date = p.date)""",
)
def price_table_update(spark, sf):
    old = price_table.stored(bars(spark, sf), None)
    out = price_table.update(old, bars(spark, sf), as_of=date(2001, 6, 29), lookback_days=180, digits=None)
    return out.select("ticker", "date", "close", *[F.round(F.col(c) + 3.3e-9, 4).alias(c) for c in ("rsi_14", "macd")])


@query(
    "price_table_resume",
    f"""with recursive {PRICES.replace("fx_prices as materialized", "fx_prices_all as materialized")},
fx_prices as materialized (select * from fx_prices_all where date < date '2001-06-29'), {MACD_EWM}, {BATCH}
select ticker, date, close, buy_signal, sell_signal, round(mid + 3.3e-9, 4) as bb_sma_20, round(rsi + 3.3e-9, 4) as rsi_14, round(macd + 3.3e-9, 4) as macd,
       round(macd_signal + 3.3e-9, 4) as macd_signal from batch""",
)
def price_table_resume(spark, sf):
    """The last days one after the other, each from the state the day before has left; the SQL builds the table anew."""
    history = bars(spark, sf)
    out = tables.stage(price_table.build(history.filter(F.col("date") < date(2001, 6, 26)), digits=None, state=True), "price-table")
    late = history.filter(F.col("date").between(date(2001, 6, 26), date(2001, 6, 28))).select("date").distinct()
    for (day,) in sorted(late.collect()):  # three days at most
        out = price_table.update(out, history, as_of=day + timedelta(days=1), digits=None)
    soft = ("bb_sma_20", "rsi_14", "macd", "macd_signal")
    return out.select("ticker", "date", "close", "buy_signal", "sell_signal", *[F.round(F.col(c) + 3.3e-9, 4).alias(c) for c in soft])


@query(
    "sig_votes",
    f"""with recursive {PRICES}, {MACD_EWM}, {RULE}
select ticker, date, b1::int + b2::int + b3::int >= 2 as buy_signal, s1::int + s2::int + s3::int >= 2 as sell_signal from ruled""",
)
def sig_votes(spark, sf):
    out = indicators.add(bars(spark, sf), *signals.mean_reversion(signals.Rule(require_all=False)))
    return out.select("ticker", "date", "buy_signal", "sell_signal")


@query(
    "sig_all",
    f"""with recursive {PRICES}, {MACD_EWM}, {RULE}
select ticker, date, b1 and b2 and b3 as buy_signal, s1 or s2 or s3 as sell_signal from ruled""",
)
def sig_all(spark, sf):
    out = indicators.add(bars(spark, sf), *signals.mean_reversion())
    return out.select("ticker", "date", "buy_signal", "sell_signal")


# ---------------------------------------------------------------- ranges and increments

RANGES = """
select ticker, '{name}' as timeframe, cast({start} as date) as start_date, last as end_date from edges"""


def _ranges(anchor: str, names: dict[str, str]) -> str:
    return " union all ".join(RANGES.format(name=n, start=s.format(a=anchor)) for n, s in names.items())


STARTS = {
    "3M": "{a} - interval 3 month",
    "6M": "{a} - interval 6 month",
    "YTD": "date_trunc('year', {a})",
    "1Y": "{a} - interval 12 month",
    "3Y": "{a} - interval 36 month",
    "5Y": "{a} - interval 60 month",
    "10Y": "{a} - interval 120 month",
    "All": "first",
}
EDGES = "edges as (select ticker, min(date) as first, max(date) as last from fx_prices group by 1)"


@query("timeframe_bounds", f"with {PRICES}, {EDGES} {_ranges('last', STARTS)}")
def timeframe_bounds(spark, sf):
    return timeframes.bounds(bars(spark, sf))


@query(
    "timeframe_bounds_today",
    f"with {PRICES}, {EDGES} {_ranges('''date '2001-11-30' ''', {**{n: STARTS[n] for n in ('YTD', '1Y', '3Y', '5Y')}, 'Max': 'first'})}",
)
def timeframe_bounds_today(spark, sf):
    return timeframes.bounds(bars(spark, sf), timeframes.PORTFOLIO_NAMES, as_of=date(2001, 11, 30))


@query(
    "timeframe_fan_out",
    f"""with {PRICES}, {EDGES}, ranges as ({_ranges('last', STARTS)})
select r.timeframe, p.ticker, p.date, p.close from fx_prices p join ranges r on r.ticker = p.ticker and p.date >= r.start_date""",
)
def timeframe_fan_out(spark, sf):
    return timeframes.fan_out(bars(spark, sf), timeframes.NAMES).select("timeframe", "ticker", "date", "close")


@query(
    "price_incremental",
    f"""with recursive {PRICES.replace("fx_prices as materialized", "fx_prices_all as materialized")},
fx_prices as materialized (select * from fx_prices_all where date >= date '2001-06-29' - 180 and date < date '2001-06-29'), {MACD_EWM}, {BATCH}
select ticker, date, close, {q6("mid")} as bb_mid, {q6("rsi")} as rsi, {q6("macd")} as macd, {q6("macd_hist")} as macd_hist, buy_signal, sell_signal
from batch qualify row_number() over (partition by ticker order by date desc) = 1""",
)
def price_incremental(spark, sf):
    out = incremental.latest_bar(bars(spark, sf), as_of=date(2001, 6, 29), lookback_days=180)
    return rounded(out, ("ticker", "date", "close", "buy_signal", "sell_signal"), "bb_mid", "rsi", "macd", "macd_hist")
