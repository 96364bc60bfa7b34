"""The driver's three entry points."""

import __spark_entry__ as driver
from riskframe.catalog import QUERIES


def test_entry_is_a_dataframe_with_rows(spark):
    df = driver.entry(spark)
    assert df.columns == ["risk_tier", "min_loan", "max_loan", "avg_loan", "avg_score", "n"]
    assert {r.risk_tier for r in df.collect()} == {"Prime", "Near-Prime", "Subprime"}


def test_every_oracle_belongs_to_a_query():
    names = set(driver.queries())
    assert set(driver.oracle_sql()) <= names
    # every query of the catalog has its SQL
    assert set(QUERIES) <= set(driver.oracle_sql())
