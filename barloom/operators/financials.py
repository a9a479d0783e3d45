"""Financial statements: item rows to one row per period, latest and history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.numbers import decimal, first_filled
from barloom.operators.dedupe import latest_per_key

# Measure, statement, item names in order of preference, decimal places.
MEASURES = (
    ("revenue", "income", ("Total Revenue", "Revenue"), 2),
    ("cost_of_revenue", "income", ("Cost of Revenue", "CostOfRevenue"), 2),
    ("gross_profit", "income", ("Gross Profit", "GrossProfit"), 2),
    ("operating_income", "income", ("Operating Income", "OperatingIncome"), 2),
    ("net_income", "income", ("Net Income", "NetIncome"), 2),
    ("eps_basic", "income", ("Basic EPS",), 6),
    ("eps_diluted", "income", ("Diluted EPS",), 6),
    ("ebitda", "income", ("EBITDA",), 2),
    ("gross_margin", "income", ("Gross Margin",), 8),
    ("operating_margin", "income", ("Operating Margin",), 8),
    ("ebitda_margin", "income", ("EBITDA Margin",), 8),
    ("net_profit_margin", "income", ("Net Profit Margin",), 8),
    ("total_assets", "balance", ("Total Assets",), 2),
    ("total_liabilities", "balance", ("Total Liab", "totalLiabilities"), 2),
    ("total_equity", "balance", ("Total Stockholder's Equity", "Total stockholder equity"), 2),
    ("cash_and_equivalents", "balance", ("Cash And Cash Equivalents", "cashAndShortTermInvestments"), 2),
    ("total_debt", "balance", ("Total Debt",), 2),
    ("operating_cashflow", "cashflow", ("Total Cash From Operating Activities",), 2),
    ("capital_expenditures", "cashflow", ("Capital Expenditures",), 2),
)
# Stored measures no statement delivers.
UNFILLED = {
    "reported_currency": "string",
    "free_cash_flow": "decimal(38,2)",
    "shares_outstanding": "bigint",
    "shares_float": "bigint",
    "market_cap": "decimal(38,2)",
    "price_to_earnings": "decimal(38,8)",
    "forward_pe": "decimal(38,8)",
    "peg_ratio": "decimal(38,8)",
    "revenue_growth": "decimal(38,8)",
    "earnings_growth": "decimal(38,8)",
    "number_of_analysts": "int",
    "recommendation_mean": "decimal(38,8)",
}
PERIOD_TYPE = "FY"


def transpose(df: DataFrame, items: str = "item", keys: Sequence[str] = ("ticker", "statement")) -> DataFrame:
    """Statements with one column per period to rows (keys, item, period_end, value). Column names are days."""
    periods = [c for c in df.columns if c not in (*keys, items)]
    long = df.unpivot([*keys, items], periods, "_period", "value")
    return long.select(*keys, items, F.to_date("_period").alias("period_end"), "value")


def assemble(statements: DataFrame, recent_quarters: DataFrame | None = None, order: str | None = None) -> DataFrame:
    """One row per (ticker, period) from income, balance and cash-flow items.

    One pivot stands for the full outer join of the three statements. An alternate item name is used where the first is missing or zero. A ticker
    without any statement gets one empty row at its most recent quarter, if ``recent_quarters`` (ticker, period_end) knows it. Of an item
    that comes more than once (a restated figure) the last by ``order`` counts, without an order the largest.
    """
    value = F.max_by("value", order) if order else F.max("value")
    statements = statements.groupBy("ticker", "period_end", "statement", "item").agg(value.alias("value"))

    def item(statement: str, name: str, digits: int) -> Column:
        hit = (F.col("statement") == statement) & (F.col("item") == name)
        return decimal(F.max(F.when(hit, F.col("value"))), digits)

    def raw(statement: str) -> Column:
        pairs = F.collect_list(F.when(F.col("statement") == statement, F.struct("item", "value")))
        return F.map_from_entries(F.array_sort(pairs))

    wide = statements.groupBy("ticker", "period_end").agg(
        *[first_filled(*[item(s, n, d) for n in names]).alias(m) for m, s, names, d in MEASURES],
        # a statement has a fixed set of items, so a period's items are few
        F.to_json(F.struct(*[raw(s).alias(s) for s in ("income", "balance", "cashflow")])).alias("raw_json"),
    )
    if recent_quarters is not None:
        empty = recent_quarters.filter("period_end is not null").join(statements.select("ticker").distinct(), "ticker", "left_anti")
        wide = wide.unionByName(empty.select("ticker", "period_end").distinct(), allowMissingColumns=True)
    return wide.withColumn("period_type", F.lit(PERIOD_TYPE)).withColumns({c: F.lit(None).cast(t) for c, t in UNFILLED.items()})


def latest(df: DataFrame) -> DataFrame:
    """Each ticker's newest period."""
    return latest_per_key(df, ["ticker"], "period_end")


def history(df: DataFrame, tickers: DataFrame | None = None) -> DataFrame:
    """Periods of the given tickers (or all), newest first within each ticker."""
    out = df if tickers is None else df.join(tickers.select("ticker"), "ticker", "left_semi")
    return out.orderBy("ticker", F.col("period_end").desc())
