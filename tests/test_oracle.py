"""Each registered query against its SQL on DuckDB, smallest scale."""

import pytest

from checks.compare import differences, duck
from checks.oracle import ORACLE
from checks.registry import REGISTRY


@pytest.fixture(scope="module")
def con(folder):
    return duck(folder)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_names_and_types(spark, con, folder, name):
    assert differences(spark, con, name, folder) == []


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(REGISTRY)


def test_entry_returns_rows(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 150
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(REGISTRY) - set(ORACLE) == {"table_sizes"}


def test_table_sizes_lists_every_file(spark, folder):
    got = {r.table_name: r for r in REGISTRY["table_sizes"](spark, folder).collect()}
    import os

    for name, row in got.items():
        assert (row.file_count, row.size_bytes) == (1, os.path.getsize(f"{folder}/{name}.parquet"))
