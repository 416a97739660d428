"""Every query with an SQL twin, on the smallest given tables."""

import pytest

from checks.compare import compare, connect
from checks.oracles import BODIES
from checks.queries import REGISTRY
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_twin_has_a_query():
    assert set(BODIES) <= set(REGISTRY)


@pytest.mark.parametrize("name", sorted(BODIES))
def test_query_equals_sql(spark, duck, name):
    assert compare(spark, duck, SMALL, name) == ""


@pytest.mark.parametrize(
    "name",
    [
        "full_report",
        "low_stock_risk",
        "fk_quarantine",
        "clean_order_items",
        "inventory_report",
        "proportional_allocation",
        "proportional_allocation_remainder",
        "assemble_baskets",
    ],
)
def test_query_equals_sql_without_broadcasts(spark, duck, shuffled, name):
    """As with inputs too large to broadcast, and with partitions split for skew."""
    spark.catalog.clearCache()
    assert compare(spark, duck, SMALL, name) == ""


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).columns == ["section", "rank", "label", "name", "metric", "value"]
    assert set(contract.oracle_sql()) <= set(contract.queries())
