import datetime as dt
from decimal import Decimal as D

import pytest

from storecast.operators import features

START = dt.date(2025, 1, 1)


def daily(spark, data):
    """{series: [quantity per day]} from the start day."""
    out = [
        (s, START + dt.timedelta(days=i), D(str(q)))
        for s, values in data.items()
        for i, q in enumerate(values)
        if q is not None
    ]
    return spark.createDataFrame(out, "series int, order_date date, quantity decimal(12,2)")


@pytest.fixture(scope="module")
def built(spark):
    return features.build_features(daily(spark, {1: range(10), 2: range(10, 20)}))


def test_rolling_never_crosses_series(built):
    got = [
        (r.series, r.quantity_rolling_7) for r in built.orderBy("series", "order_date").collect()
    ]
    expected = [None] * 7 + [3.0, 4.0, 5.0]
    assert [v for s, v in got if s == 1] == expected
    assert [v for s, v in got if s == 2] == [None] * 7 + [13.0, 14.0, 15.0]


def test_lags(built):
    last = built.where("series = 2").orderBy("order_date").collect()[-1]
    assert (last.quantity, last.quantity_lag_1, last.quantity_lag_7) == (19.0, 18.0, 12.0)


def test_history_costs_seven_rows_per_series(built):
    assert features.finalize_features(built).count() == 6
    dropped = features.dropped_history(built).first()
    assert tuple(dropped) == (20, 6, 14)


def test_grid_fills_gaps_and_drops_strangers(spark):
    sales = daily(spark, {1: [5, None, 7], 3: [9]})
    members = spark.createDataFrame([(1,), (2,)], "series int")
    grid = features.complete_grid(sales, members, "2025-01-01", "2025-01-03")
    got = sorted((r.series, r.order_date.day, float(r.quantity)) for r in grid.collect())
    assert got == [(1, 1, 5), (1, 2, 0), (1, 3, 7), (2, 1, 0), (2, 2, 0), (2, 3, 0)]


def test_split_and_checks(built):
    final = features.finalize_features(built)
    train, test = features.chronological_split(final, "2025-01-10")
    assert (train.count(), test.count()) == (4, 2)
    checks = {r.check_name: (r.rows_checked, r.violations) for r in
              features.leakage_checks(train, test).collect()}
    assert checks == {
        "date_overlap": (4, 0),
        "lag_1_is_previous_day": (2, 0),
        "target_in_features": (4, 0),
    }


def test_checks_find_leaks(built):
    final = features.finalize_features(built)
    train, test = features.chronological_split(final, "2025-01-10")
    leaky = train.withColumn("quantity_lag_1", train["quantity"])
    checks = {
        r.check_name: r.violations
        for r in features.leakage_checks(leaky, train, features=["quantity"]).collect()
    }
    assert checks == {"date_overlap": 1, "lag_1_is_previous_day": 2, "target_in_features": 1}


def test_one_hot_keeps_all_levels(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "s string")
    got = sorted(tuple(r)[1:] for r in features.one_hot(df, "s", "product", ["a", "b"]).collect())
    assert got == [(0, 0), (0, 1), (1, 0)]


def test_one_hot_takes_any_number_of_levels(spark):
    df = spark.range(5000).selectExpr("id", "concat('p', id) AS s").unionByName(
        spark.createDataFrame([(-1, None)], "id bigint, s string")
    )
    got = features.one_hot_long(df, "id", "s")
    assert got.columns == ["id", "level", "flag"]
    assert got.where("level = concat('p', id) AND flag = 1").count() == got.count() == 5000


def test_target_among_the_features_is_found_in_the_frame(built):
    train, test = features.chronological_split(features.finalize_features(built), "2025-01-10")
    hidden = train.withColumn("month", train["quantity"])
    checks = {r.check_name: r.violations for r in features.leakage_checks(hidden, test).collect()}
    assert checks["target_in_features"] == 1


def sparse_and_dense(spark, data, members, days):
    sales = daily(spark, data)
    end = str(START + dt.timedelta(days=days - 1))
    listed = spark.createDataFrame([(m,) for m in members], "series int")
    dense = features.build_features(features.complete_grid(sales, listed, str(START), end))
    return features.sparse_features(sales, str(START), end), dense, listed, end


def by_place(df):
    columns = ["quantity", *features.FEATURES]
    return {(r.series, r.order_date): tuple(r[c] for c in columns) for r in df.collect()}


def test_sparse_features_equal_the_dense_grid(spark):
    """Sales at the ends of the calendar, gaps shorter and longer than a week, a return, days that add up to zero."""
    data = {
        1: [3, None, None, 4] + [None] * 12 + [5] + [None] * 7 + [6] + [None] * 6 + [1],
        2: [None] * 25 + [2, None, -2],
        3: [0, None, 1],
        4: list(range(40)),
    }
    sparse, dense, listed, end = sparse_and_dense(spark, data, [1, 2, 3, 4, 5], 40)
    near, whole = by_place(sparse), by_place(dense)
    assert near == {k: whole[k] for k in near}
    sales = {(s, START + dt.timedelta(days=i)) for s, v in data.items() for i, q in enumerate(v) if q is not None}
    reach = {(s, d + dt.timedelta(days=i)) for s, d in sales for i in range(8)}
    assert set(near) == reach & set(whole)
    history = [i for i, c in enumerate(["quantity", *features.FEATURES]) if "quantity" in c]
    assert all(not whole[k][i] for k in set(whole) - set(near) for i in history)


def test_densified_rows_equal_the_dense_grid(spark):
    data = {1: [3, None, None, 4] + [None] * 12 + [5], 2: [None] * 14 + [9]}
    sparse, dense, listed, end = sparse_and_dense(spark, data, [1, 2, 3], 20)
    first = str(START + dt.timedelta(days=12))
    got = features.densified(features.finalize_features(sparse), listed, first, end)
    want = {k: v for k, v in by_place(dense).items() if str(k[1]) >= first}
    assert by_place(got) == want and len(want) == 3 * 8


def test_sparse_features_take_one_shuffle_after_the_daily_sums(spark):
    sparse, *_ = sparse_and_dense(spark, {1: [1, None, 2]}, [1], 30)
    plan = sparse._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_leaks_are_found_in_sparse_rows(spark):
    data = {1: [1] * 9 + [None] * 9 + [5] * 20}
    sparse, *_ = sparse_and_dense(spark, data, [1], 38)
    final = features.finalize_features(sparse)
    train, test = features.chronological_split(final, "2025-02-05")
    checks = lambda df: {r.check_name: (r.rows_checked, r.violations) for r in features.leakage_checks(df, test, sparse=True).collect()}
    rows = train.count()
    assert checks(train) == {"date_overlap": (rows, 0), "lag_1_is_previous_day": (rows - 1, 0), "target_in_features": (rows, 0)}
    # The sale after the gap is one whose day before is not listed.
    leaky = train.withColumn("quantity_lag_1", train["quantity"])
    assert checks(leaky)["lag_1_is_previous_day"][1] >= 2


def task_sorts(plan):
    """What the plan sorts: columns of each Sort."""
    return [line for line in plan.splitlines() if " Sort [" in line]


def test_days_are_listed_after_the_only_sort(spark):
    """The sales are sorted, not the days that follow them."""
    sparse, *_ = sparse_and_dense(spark, {1: [1, None, 2]}, [1], 30)
    plan = sparse._jdf.queryExecution().executedPlan().toString()
    assert len(task_sorts(plan)) == 1
    assert plan.index("Generate") < plan.index(" Sort [")


def test_days_of_unknown_quantity_and_other_types(spark):
    day = lambda i: START + dt.timedelta(days=i)
    rows = [(1, day(0), None), (1, day(1), 2), (1, day(9), None), (None, day(3), 5), (1, None, 7)]
    for kind, unit in (("decimal(22,2)", D("0.01")), ("int", 1), ("double", 0.5)):
        value = lambda q: None if q is None else q if kind == "int" else q * unit  # noqa: E731, B023
        sales = spark.createDataFrame([(s, d, value(q)) for s, d, q in rows], f"series int, order_date date, quantity {kind}")
        got = by_place(features.sparse_features(sales, str(START), str(day(11))))
        assert got[1, day(0)][0] is None and got[1, day(9)][0] is None
        week = {d: got[1, day(d)][-1] for d in (7, 8, 9, 10)}
        assert week == {d: float(value(2)) / 7 if d <= 8 else 0.0 for d in week}
        assert got[None, day(4)][-3] == float(value(5)) and got[None, day(10)][-2] == float(value(5))


def test_dense_features_equal_the_features_of_the_grid(spark):
    """Members without sales or key, listed twice, sales of others and outside the calendar."""
    sales = daily(spark, {1: [3, None, 4] + [None] * 20 + [5], 2: [None] * 8 + [9, -9], 3: [7], 9: [1, 1]})
    end = str(START + dt.timedelta(days=18))
    members = spark.createDataFrame([(m,) for m in (1, 2, 2, 3, 4, None, 5, 5, 5)], "series int")
    want = features.build_features(features.complete_grid(sales, members, str(START), end))
    got = features.dense_features(sales, members, str(START), end)
    assert got.columns == want.columns
    rows = lambda df: sorted(map(repr, df.collect()))
    assert rows(got) == rows(want) and got.count() == 9 * 19
    once = features.dense_features(sales, members.distinct(), str(START), end)
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert all("order_date" not in line or "__day" in line for line in task_sorts(plan.split("Union")[0]))


def test_leaks_are_looked_up_without_a_sort(spark):
    data = {1: [1] * 9 + [None] * 9 + [5] * 20}
    sparse, *_ = sparse_and_dense(spark, data, [1], 38)
    train, test = features.chronological_split(features.finalize_features(sparse), "2025-02-05")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        checked = features.leakage_checks(train, test, sparse=True)
        plan = checked._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    empty = {r.check_name: r.rows_checked for r in features.leakage_checks(train.limit(0), test, sparse=True).collect()}
    assert empty == dict.fromkeys(("date_overlap", "lag_1_is_previous_day", "target_in_features"), 0)


def sold(spark):
    """Repeated lines and orders, keys and quantities without value, orders without lines, lines without orders."""
    lines = [(o, s, q) for o in range(40) for s in (1, 2, o % 7, None) for q in (D("1.50"), None)] + [(None, 1, D(2)), (99, 1, D(3))]
    dates = [(o, START + dt.timedelta(days=o % 9)) for o in range(60)] + [(3, START), (5, None), (None, START)]
    return (
        spark.createDataFrame(lines, "order_id int, product_id int, quantity decimal(12,2)"),
        spark.createDataFrame(dates, "order_id int, order_date date"),
    )


def test_sales_by_series_are_the_daily_sales_in_tasks_of_bounded_size(spark, monkeypatch):
    items, orders = sold(spark)
    rows = lambda df: sorted(map(repr, df.collect()))
    for days in ((None, None), ("2025-01-02", "2025-01-05")):
        want, got = (f(items, orders, "product_id", *days) for f in (features.daily_sales, features.sales_by_series))
        assert got.schema == want.schema and rows(got) == rows(want)
    monkeypatch.setattr(features, "ROWS_PER_TASK", 10)
    dealt = features.sales_by_series(items, orders)
    assert dealt.rdd.getNumPartitions() == -(-items.count() // 10)


def test_sales_by_series_are_windowed_without_another_shuffle(spark, shuffled):
    """Lines are neither sorted nor summed by the tasks that join them; a window takes the sales as they are dealt out."""
    items, orders = sold(spark)
    sparse = features.sparse_features(features.sales_by_series(items, orders), str(START), "2025-01-09", "product_id")
    plan = sparse._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan and len(task_sorts(plan)) == 1
    assert plan.count("Exchange") == 4
    lines = plan.splitlines()
    aggregates = [i for i, line in enumerate(lines) if "HashAggregate" in line]
    assert max(aggregates) < next(i for i, line in enumerate(lines) if "ShuffledHashJoin" in line)
    assert all("Exchange" not in line for line in lines[aggregates[0] : aggregates[-1]])


def test_densified_rows_are_filled_in_without_a_shuffle_of_days(spark, shuffled):
    """Members listed twice, without sales or key; what is not known counts as zero."""
    items, orders = sold(spark)
    members = spark.createDataFrame([(m,) for m in (1, 2, 2, 8, None)], "product_id int")
    daily = features.sales_by_series(items, orders)
    end = "2025-01-16"
    sparse = features.finalize_features(features.sparse_features(daily, str(START), end, "product_id"))
    got = features.densified(sparse, members, "2025-01-08", end, "product_id")
    grid = features.build_features(features.complete_grid(daily, members.distinct(), str(START), end, "product_id"), "product_id")
    dense = grid.where("order_date >= '2025-01-08'").join(members, "product_id")
    rows = lambda df: sorted(repr(r) for r in df.where("product_id is not null").select(got.columns).fillna(0.0, "quantity").collect())
    assert rows(got) == rows(dense) and got.count() == 5 * 9
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert all("order_date" not in line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "REPARTITION" not in line and "order_id" not in line)
