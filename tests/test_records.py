"""Statements and company documents on hand-written cases."""

import json
from datetime import date

from barloom.operators import companies, financials


def test_assemble_takes_alternates_for_missing_and_zero_and_falls_back_to_the_last_quarter(spark):
    day = date(2023, 12, 31)
    rows = [
        ("A", day, "income", "Total Revenue", 0.0),
        ("A", day, "income", "Revenue", 7.125),
        ("A", day, "cashflow", "Capital Expenditures", -3.0),
        ("B", day, "balance", "Total Assets", 1.0),
    ]
    df = spark.createDataFrame(rows, "ticker string, period_end date, statement string, item string, value double")
    quarters = spark.createDataFrame([("C", date(2024, 3, 31)), ("A", date(2024, 3, 31)), ("D", None)], "ticker string, period_end date")
    out = {r.ticker: r for r in financials.assemble(df, quarters).collect()}
    assert sorted(out) == ["A", "B", "C"]
    assert str(out["A"].revenue) == "7.12" and str(out["A"].capital_expenditures) == "-3.00" and out["A"].period_type == "FY"
    assert json.loads(out["A"].raw_json)["income"] == {"Revenue": 7.125, "Total Revenue": 0.0}
    assert out["C"].period_end == date(2024, 3, 31) and out["C"].revenue is None


def test_officers_keep_other_keys_with_their_types(spark):
    info = {"companyOfficers": [{"name": "N", "yearBorn": 1960.5, "totalPay": 10.005, "maxAge": 1, "exercised": {"raw": 0}}, {"name": "M", "title": "CEO"}]}
    df = spark.createDataFrame([(" a ", json.dumps(info)), ("B", "{}"), ("C", "broken")], "ticker string, info string")
    out = {r.name: r for r in companies.officers(df).collect()}
    n = out["N"]
    assert (n.ticker, n.title, n.fiscal_year, n.year_of_birth, str(n.total_pay)) == ("A", "", 0, 1960, "10.00")
    assert json.loads(n.extra) == {"maxAge": 1, "exercised": {"raw": 0}}
    assert len(out) == 2 and out["M"].title == "CEO"


def test_profile_falls_back_to_the_short_name(spark):
    info = {"shortName": "Short", "marketCap": 12.345, "lastSplitDate": "2020-08-31", "lastDividendDate": 1700000000, "esgPopulated": False, "floatShares": 5.0}
    r = companies.profile(spark.createDataFrame([(" x", json.dumps(info)), ("  ", "{}")], "ticker string, info string")).collect()
    assert len(r) == 1
    r = r[0]
    assert (r.ticker, r.name, str(r.market_cap), r.float_shares, r.esg_populated) == ("X", "Short", "12.34", 5, False)
    assert (r.last_split_date, r.last_dividend_date) == (date(2020, 8, 31), date(2023, 11, 14))
