"""What the filing queries shuffle and read, beside what they return."""

import datetime as dt

import pytest

from formlake.plans import queries
from formlake.sources import render

DAY = dt.date(2026, 1, 6)
TRADE = {
    "cik": "7", "accession_number": "0000000001-26-000001", "filing_date": DAY, "ticker": "ACME", "company_name": "A & B <C>", "owner_name": "Jane",
    "owner_title": None, "is_director": True, "is_officer": False, "is_ten_percent_owner": False, "transaction_date": dt.date(2026, 1, 5),
    "transaction_code": "P", "shares": 1.0, "price_per_share": 2.5, "acquired_disposed_code": None,
}
TYPES = (
    "cik string, accession_number string, filing_date date, ticker string, company_name string, owner_name string, owner_title string, is_director boolean, "
    "is_officer boolean, is_ten_percent_owner boolean, transaction_date date, transaction_code string, shares double, price_per_share double, acquired_disposed_code string"
)


def test_trades_are_shuffled_as_values_and_rendered_whole(spark):
    rows = [TRADE, TRADE | {"shares": None, "transaction_code": "S&P", "acquired_disposed_code": "D"}, TRADE | {"cik": "8"}]
    filings = render.render_filings(spark.createDataFrame([tuple(r.values()) for r in rows], TYPES))
    plan = filings._jdf.queryExecution().executedPlan().toString()
    partial = next(line for line in plan.splitlines() if "partial_collect_list" in line)
    assert "nonDerivativeTransaction" not in partial  # before: the texts were made, sorted and shuffled
    text = {r.file_name: r.content for r in filings.collect()}
    assert sorted(text) == ["7_0000000001-26-000001.txt", "8_0000000001-26-000001.txt"]
    both = text["7_0000000001-26-000001.txt"]
    assert both.count("<nonDerivativeTransaction>") == 2 and both.count("<transactionShares>") == 1
    assert "<transactionCode>S&amp;P</transactionCode>" in both and "<issuerName>A &amp; B &lt;C&gt;</issuerName>" in both
    assert both.count("<transactionAcquiredDisposedCode>") == 1 and "<transactionDate><value>2026-01-05</value></transactionDate>" in both


def test_run_dates_joins_the_line_items_once(spark, monkeypatch):
    from tests.conftest import SF_SMALL

    class Stop(Exception):
        pass

    def seen(raw, *args, **kw):
        raise Stop([f.rsplit("/", 2)[-1] for f in raw.inputFiles()])

    monkeypatch.setattr(queries.fx, "day_filings", seen)
    with pytest.raises(Stop) as stop:
        queries.q_run_dates(spark, SF_SMALL)
    assert not {"lineitem.parquet", "orders.parquet"} & set(stop.value.args[0])  # before: joined for the counts, the days and the files
