"""Every registered query against its SQL, at the smallest scale."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import differences, oracle_frame
from checks.oracle import ORACLES
from checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, name):
    expected = oracle_frame(SF_DIR, ORACLES[name])
    assert differences(QUERIES[name](spark, SF_DIR), expected) is None


def test_entry(spark):
    assert entry(spark).count() == 5


def test_everything_is_registered():
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql()) <= set(queries())


def test_a_sample_has_some_rows_without_hidden_columns(spark):
    sample = QUERIES["role_sample"](spark, SF_DIR)
    assert sample.count() == 3 and "_loaded_at" not in sample.columns
