"""Every registered query against its oracle text, on the smallest data set."""

import oracle
import pytest

from rillstream.catalog import all_entries

ENTRIES = all_entries()


@pytest.mark.parametrize("name", [n for n, e in ENTRIES.items() if e.sql is not None])
def test_matches_oracle(spark, duck, data_dir, name):
    problems = oracle.compare(spark, name, ENTRIES[name], data_dir, duck)
    assert [p for p in problems if p != "oracle result is empty"] == []


@pytest.mark.parametrize("name", [n for n, e in ENTRIES.items() if e.sql is None])
def test_rows_only(spark, data_dir, name):
    assert ENTRIES[name].run(spark, data_dir).count() > 0


def test_entry_point(spark):
    import __spark_entry__ as contract

    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).columns[0] == "cc_num"
