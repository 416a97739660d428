import datetime as dt

import pytest
from pyspark.sql import functions as F

from storecast.operators import features, forecast
from storecast.plans import restock

START = dt.date(2025, 12, 1)


def history(spark, data):
    rows = [
        (s, START + dt.timedelta(days=i), float(q))
        for s, values in data.items()
        for i, q in enumerate(values)
    ]
    return spark.createDataFrame(rows, "series int, order_date date, quantity double")


def by_hand(values, days, predict):
    values, out = list(values), []
    for _ in range(days):
        recent = values[-7:]
        lag_7 = values[-7] if len(values) >= 7 else values[0]
        total = 0.0
        for v in recent:
            total += v
        out.append(predict(values[-1], lag_7, total / len(recent)))
        values.append(out[-1])
    return out


DATA = {1: [3, 1, 4, 1, 5, 9, 2, 6, 5], 2: [2.5] * 9, 3: [0, 0, 0, 0, 0, 0, 0, 1, 2]}


@pytest.mark.parametrize("days", [1, 7, 40])
def test_fold_equals_recursion_by_hand(spark, days):
    predicted = forecast.forecast(history(spark, DATA), forecast.rolling_mean_predictor, days)
    for series, values in DATA.items():
        got = predicted.where(F.col("series") == series).orderBy("horizon").collect()
        assert [r.prediction for r in got] == by_hand(values, days, lambda a, b, m: m)
        assert got[0].order_date == START + dt.timedelta(days=9)


def test_short_history_uses_what_there_is(spark):
    def mix(f):
        return f["quantity_lag_7"] + f["quantity_lag_1"] / 2 + f["quantity_rolling_7"]

    data = {1: [4.0, 2.0, 8.0]}
    got = forecast.forecast(history(spark, data), mix, 6).orderBy("horizon").collect()
    assert [r.prediction for r in got] == by_hand(data[1], 6, lambda a, b, m: b + a / 2 + m)


def test_calendar_reaches_the_predictor(spark):
    got = forecast.forecast(
        history(spark, {1: [1.0] * 9}), lambda f: f["day_of_week"] + 10 * f["is_weekend"], 4
    )
    days = {r.order_date.isoformat(): r.prediction for r in got.collect()}
    assert days == {"2025-12-10": 2, "2025-12-11": 3, "2025-12-12": 4, "2025-12-13": 15}


def test_all_series_start_after_the_newest_day(spark):
    data = history(spark, {1: [1.0] * 9, 2: [1.0] * 5})
    got = forecast.forecast(data, forecast.last_value_predictor, 1).collect()
    assert {r.order_date for r in got} == {START + dt.timedelta(days=9)}


def test_model_recursion_feeds_predictions_back(spark):
    from pyspark.ml import PipelineModel

    from storecast.operators import models

    rows = [
        (s, START + dt.timedelta(days=i), float(10 * s + (i % 7)))
        for s in (1, 2, 3)
        for i in range(60)
    ]
    grid = spark.createDataFrame(rows, "series int, order_date date, quantity double")
    train = features.finalize_features(
        features.build_features(grid.withColumn("quantity", F.col("quantity").cast("decimal(12,2)")))
    )
    model = models.fit_model(train, models.linear_regression())
    assert isinstance(model, PipelineModel)
    got = forecast.forecast(train, model, 16).collect()
    assert len(got) == 48
    for r in got:
        weekday_pattern = 10 * r.series + ((60 + r.horizon - 1) % 7)
        assert abs(r.prediction - weekday_pattern) < 0.2
        assert r.predicted_quantity == round(r.prediction, 2)


def points(spark, predictions):
    data = history(spark, {i: [p] * 9 for i, p in enumerate(predictions)})
    return restock.reorder_points(data, forecast.last_value_predictor)


def test_reorder_point_uses_the_unrounded_prediction(spark):
    got = points(spark, [10.004, 0.3]).orderBy("series").collect()
    assert [(r.predicted_daily_demand, r.reorder_point) for r in got] == [(10.0, 70.0), (0.3, 0.0)]


def test_triggers_and_quantities(spark):
    demand = spark.createDataFrame(
        [(1, 10.0, 70.0), (2, 10.0, 70.0), (3, 10.0, 500.0), (4, -1.0, 5.0)],
        "series int, predicted_daily_demand double, reorder_point double",
    )
    stock = spark.createDataFrame(
        [(1, 70.0), (2, 70.5), (3, 400.0), (4, 0.0)], "series int, stock_available double"
    )
    sized = restock.order_quantities(restock.reorder_triggers(demand, stock))
    got = [
        (r.needs_reorder, r.recommended_order_qty) for r in sized.orderBy("series").collect()
    ]
    assert got == [(True, 230.0), (False, 0.0), (True, 0.0), (True, 0.0)]
    assert tuple(restock.inventory_sanity(sized).first()) == (1, 0)


def test_erratic_from_parameters(spark):
    params = spark.createDataFrame(
        [(1, 0.2), (2, 0.0), (3, None)], "product_id int, zero_order_prob double"
    )
    got = {r[0]: r[1] for r in restock.erratic_from_parameters(params).collect()}
    assert got == {1: True, 2: False, 3: False}


def test_report_puts_action_first(spark):
    data = history(spark, {1: [10.0] * 9, 2: [10.0] * 9})
    stock = spark.createDataFrame([(1, 500.0), (2, 20.0)], "series int, stock_available double")
    erratic = spark.createDataFrame([(2, True)], "series int, erratic_demand_flag boolean")
    rows = restock.inventory_report(
        data, forecast.last_value_predictor, stock, erratic
    ).collect()
    assert [(r.series, r.status, bool(r.review_note)) for r in rows] == [
        (2, "reorder", True),
        (1, "ok", False),
    ]
    assert rows[0].recommended_order_qty == 280.0


def test_days_without_sales_need_no_grid(spark):
    days = [("a", "2025-01-01", 1), ("a", "2025-01-03", 2), ("b", "2025-01-02", 0)]
    daily = spark.createDataFrame(days, "series string, d string, q int").select(
        "series", F.col("d").cast("date").alias("order_date"), F.col("q").cast("decimal(12,2)").alias("quantity")
    )
    members = spark.createDataFrame([("a",), ("b",), ("c",)], "series string")
    grid = features.complete_grid(daily, members, "2025-01-01", "2025-01-04")
    want = restock.erratic_from_history(grid, 0.6)
    got = restock.erratic_from_daily(daily, members, 4, 0.6)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert sorted(map(tuple, got.collect())) == [("a", 0.5, False), ("b", 1.0, True), ("c", 1.0, True)]
