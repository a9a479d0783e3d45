"""Company profiles and officers from nested company documents (``ticker``, ``info`` as JSON text)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions import numbers, text
from barloom.functions.dates import to_date_or_null

# Stored column, key in the document and kind of value.
PROFILE = (
    ("short_name", "shortName", "text"),
    ("exchange", "exchange", "text"),
    ("market", "market", "text"),
    ("country", "country", "text"),
    ("region", "region", "text"),
    ("city", "city", "text"),
    ("address1", "address1", "text"),
    ("phone", "phone", "text"),
    ("website", "website", "text"),
    ("ir_website", "irWebsite", "text"),
    ("sector", "sector", "text"),
    ("industry", "industry", "text"),
    ("industry_key", "industryKey", "text"),
    ("long_business_summary", "longBusinessSummary", "text"),
    ("full_time_employees", "fullTimeEmployees", "int"),
    ("founded_year", "founded", "int"),
    ("market_cap", "marketCap", "decimal 2"),
    ("float_shares", "floatShares", "int"),
    ("shares_outstanding", "sharesOutstanding", "int"),
    ("beta", "beta", "decimal 6"),
    ("book_value", "bookValue", "decimal 6"),
    ("dividend_rate", "dividendRate", "decimal 8"),
    ("dividend_yield", "dividendYield", "decimal 8"),
    ("last_dividend_date", "lastDividendDate", "date"),
    ("last_split_date", "lastSplitDate", "date"),
    ("last_split_factor", "lastSplitFactor", "text"),
    ("esg_populated", "esgPopulated", "flag"),
)
# Officer keys with a column of their own; the others go to ``extra``.
OFFICER_KEYS = ("name", "title", "yearBorn", "age", "fiscalYear", "totalPay")


def _typed(value: Column, kind: str) -> Column:
    if kind == "int":
        return F.floor(value.try_cast("double")).cast("long")
    if kind == "date":
        return to_date_or_null(value)
    if kind == "flag":
        return F.when(value.isNotNull(), ~value.isin("false", "0", ""))
    if kind.startswith("decimal"):
        return numbers.decimal(value, int(kind.split()[1]))
    return value


def profile(df: DataFrame) -> DataFrame:
    """One flat typed row per company document; the name falls back to the short name. ``raw`` keeps the document."""
    keys = ["longName", "logo", "logo_url", *[k for _, k, _ in PROFILE]]
    parsed = df.withColumn("_i", F.from_json("info", ", ".join(f"`{k}` string" for k in keys)))
    field = lambda k: F.col(f"_i.{k}")
    return parsed.filter(F.trim("ticker") != "").select(
        text.normal_ticker(F.col("ticker")).alias("ticker"),
        F.coalesce(F.nullif(field("longName"), F.lit("")), field("shortName")).alias("name"),
        *[_typed(field(k), kind).alias(c) for c, k, kind in PROFILE],
        F.coalesce(F.nullif(field("logo"), F.lit("")), field("logo_url")).alias("logo_url"),
        F.col("info").alias("raw"),
    )


def officers(df: DataFrame) -> DataFrame:
    """One row per officer in the documents; missing title and year become '' and 0 so that the key (ticker, name, title, fiscal_year) always matches."""
    listed = df.select(
        text.normal_ticker(F.col("ticker")).alias("ticker"),
        F.explode(F.from_json("info", "companyOfficers array<map<string, variant>>")["companyOfficers"]).alias("o"),
    )
    value = lambda k: F.col("o")[k].cast("string")
    return listed.select(
        "ticker",
        value("name").alias("name"),
        F.coalesce(value("title"), F.lit("")).alias("title"),
        numbers.rounded_int(value("yearBorn")).alias("year_of_birth"),
        numbers.rounded_int(value("age")).alias("age"),
        F.coalesce(numbers.rounded_int(value("fiscalYear")), F.lit(0)).alias("fiscal_year"),
        numbers.decimal(value("totalPay"), 2).alias("total_pay"),
        F.to_json(F.map_filter("o", lambda k, _: ~k.isin(*OFFICER_KEYS))).alias("extra"),
    )
