"""Company league table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.operators import financials


def top_companies(companies: DataFrame, statements: DataFrame, n: int = 20, latest_only: bool = False) -> DataFrame:
    """The ``n`` highest known net incomes with the company's name. All periods compete, so a company can repeat, unless ``latest_only``."""
    source = financials.latest(statements) if latest_only else statements
    known = source.filter("net_income is not null").select("ticker", "period_end", "net_income")
    named = known.join(companies.select("ticker", F.col("name").alias("company_name")), "ticker")
    return named.orderBy(F.col("net_income").desc(), "ticker", "period_end").limit(n)
