"""Every registered query against its oracle, at the smallest scale."""

import pytest

import __spark_entry__ as entry
from tools.check_oracle import compare, open_oracle

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return open_oracle(SF)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, oracle, name):
    assert compare(spark, oracle, name, SF) == ""


def test_entry_is_lazy_and_has_a_stable_schema(spark):
    assert entry.entry(spark).columns == ["doc_id", "lang", "pos", "sentence", "score", "sign"]


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
