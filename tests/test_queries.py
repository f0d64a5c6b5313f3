"""Every registered query against its SQL, at the smallest size."""

from __future__ import annotations

import pytest

import quillview.plans.library  # noqa: F401
from quillview.plans import registry
from tests.conftest import SF, same_rows


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_sql(spark, duck, name):
    assert same_rows(registry.QUERIES[name](spark, SF), duck.sql(registry.ORACLES[name]))


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 1500


def test_every_oracle_has_a_query():
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
