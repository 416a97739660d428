"""Feature queries over every product and day, against plain Python on a small shop of their own."""

import datetime as dt

import pytest

from checks.queries import REGISTRY
from storecast.operators import features

START, DAYS = dt.date(1998, 9, 20), 60
PRODUCTS = [1, 2, 3, 4]
# (product, day, quantity): product 3 sells nothing, product 9 is not known, gaps are longer than a week, and a sale of
# unknown quantity makes a day of zero, as a day without sales.
SALES = [(1, 0, 3.0), (1, 0, 2.5), (1, 30, 4.0), (1, 59, 1.0), (2, 5, 7.0), (2, 6, 1.5), (2, 21, 2.0), (4, 58, 6.0), (9, 40, 8.0), (4, 52, None)]


@pytest.fixture(scope="module")
def shop(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("shop"))
    parts = [(p, f"name {p}", "brand", "type", 1, 10.0) for p in PRODUCTS]
    kinds = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    spark.createDataFrame(parts, kinds).write.parquet(f"{folder}/part.parquet")
    orders = [(i, 1, dt.datetime.combine(START + dt.timedelta(days=day), dt.time())) for i, (_, day, _) in enumerate(SALES)]
    spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz").write.parquet(
        f"{folder}/orders.parquet"
    )
    lines = [(i, p, 1, q, 10.0) for i, (p, _, q) in enumerate(SALES)]
    kinds = "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, l_extendedprice double"
    spark.createDataFrame(lines, kinds).write.parquet(f"{folder}/lineitem.parquet")
    return folder


def whole():
    """{(product, day): (quantity, lag 1, lag 7, rolling 7, day of week, month, weekend, season)} of the whole grid."""
    out = {}
    for p in PRODUCTS:
        sold = [sum(q or 0.0 for s, d, q in SALES if (s, d) == (p, day)) for day in range(DAYS)]
        for i, q in enumerate(sold):
            day = START + dt.timedelta(days=i)
            lags = sold[i - 1] if i else None, sold[i - 7] if i >= 7 else None, sum(sold[i - 7 : i]) / 7 if i >= 7 else None
            calendar = day.weekday(), day.month, int(day.weekday() >= 5), int(day.month in (10, 11))
            out[p, str(day)] = (q, *lags, *calendar)
    return out


COLUMNS = ["quantity", "quantity_lag_1", "quantity_lag_7", "quantity_rolling_7", "day_of_week", "month", "is_weekend", "is_festival_season"]


def by_day(df):
    rows = df.collect()
    out = {(r.product_id, r.order_date): tuple(r[c] for c in COLUMNS) for r in rows}
    assert len(out) == len(rows)
    return out


def test_features_are_built_for_every_product_and_day(spark, shop):
    """days that no sale reaches were left out."""
    got, want = by_day(REGISTRY["build_features"](spark, shop)), whole()
    assert got.keys() == want.keys() and len(got) == len(PRODUCTS) * DAYS
    assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_split_labels_every_product_and_day_with_history(spark, shop):
    """days that no sale reaches were in neither part."""
    rows = REGISTRY["chronological_split"](spark, shop).collect()
    first_test = str(START + dt.timedelta(days=DAYS - 47))
    want = {(p, day): (v[0], "train" if day < first_test else "test") for (p, day), v in whole().items() if v[2] is not None}
    assert {(r.product_id, r.order_date): (r.quantity, r.split) for r in rows} == want
    assert len(rows) == len(PRODUCTS) * (DAYS - 7)


def test_finalized_rows_are_kept_and_counted(spark, shop):
    """rows were counted, not dropped, and only those on days that a sale reaches."""
    found = REGISTRY["finalize_features"](spark, shop)
    want = {k: v for k, v in whole().items() if v[2] is not None}
    got = by_day(found)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    counts = found.select("rows_before", "rows_after", "rows_dropped").distinct().collect()
    assert [tuple(c) for c in counts] == [(len(whole()), len(want), len(whole()) - len(want))]


def test_counts_are_told_where_no_row_is_left(spark):
    rows = [(1, START + dt.timedelta(days=i), 2.0) for i in range(3)]
    built = features.build_features(spark.createDataFrame(rows, "series int, order_date date, quantity double"))
    (row,) = features.finalized(built).collect()
    assert (row.rows_before, row.rows_after, row.rows_dropped, row.series) == (3, 0, 3, None)
