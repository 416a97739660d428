import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal as D

import pytest

from storecast.operators import allocate
from storecast.operators.ranking import BLOCK_BITS
from storecast.schema import PRODUCT_PARAMETERS

TOTALS = "g int, total decimal(12,2)"
PARTS = "g int, k bigint, weight decimal(12,2)"


def split(spark, totals, parts, mode):
    allocated, rejected = allocate.proportional_allocation(
        spark.createDataFrame([(g, D(str(t))) for g, t in totals], TOTALS),
        spark.createDataFrame(
            [(g, k, None if w is None else D(str(w))) for g, k, w in parts], PARTS
        ),
        ["g"],
        "k",
        mode,
    )
    out = defaultdict(dict)
    for r in allocated.collect():
        out[r.g][r.k] = (r.allocated, r.non_positive)
    return out, {r.g: r.reason for r in rejected.collect()}


def by_hand(total, parts, mode):
    """{key: cents} with exact integers."""
    t = int(D(str(total)) * 100)
    units = {k: int(D(str(w)) * 100) for k, w in parts}
    whole = sum(units.values())
    if mode == "last":
        cents = {k: (2 * t * w + whole) // (2 * whole) for k, w in units.items()}
        cents[max(cents)] += t - sum(cents.values())
        return cents
    cents = {k: t * w // whole for k, w in units.items()}
    order = sorted(units, key=lambda k: (-(t * units[k] % whole), -units[k], k))
    for k in order[: t - sum(cents.values())]:
        cents[k] += 1
    return cents


def test_three_equal_parts(spark):
    parts = [(1, k, 1) for k in (1, 2, 3)]
    last, _ = split(spark, [(1, "1.00")], parts, "last")
    assert [last[1][k][0] for k in (1, 2, 3)] == [D("0.33"), D("0.33"), D("0.34")]
    spread, _ = split(spark, [(1, "1.00")], parts, "largest_remainder")
    assert [spread[1][k][0] for k in (1, 2, 3)] == [D("0.34"), D("0.33"), D("0.33")]


def test_tiny_total_flags_the_empty_part(spark):
    parts = [(1, k, 1) for k in range(6)]
    last, _ = split(spark, [(1, "0.10")], parts, "last")
    assert [last[1][k] for k in range(6)] == [(D("0.02"), False)] * 5 + [(D("0.00"), True)]
    spread, _ = split(spark, [(1, "0.10")], parts, "largest_remainder")
    assert sum(v for v, _ in spread[1].values()) == D("0.10")


def test_rejects(spark):
    totals = [(1, 0), (2, -5), (3, 5), (4, 5), (5, 5), (6, 5), (7, 5)]
    parts = [(1, 1, 1), (2, 1, 1), (4, 1, 0), (5, 1, -1), (5, 2, 3), (6, 1, None), (6, 2, 1), (7, 1, 2)]
    out, reasons = split(spark, totals, parts, "last")
    assert set(out) == {7}
    assert reasons == {
        1: "total is not positive",
        2: "total is not positive",
        3: "no parts",
        4: "weights add up to zero",
        5: "missing or negative weight",
        6: "missing or negative weight",
    }


@pytest.mark.parametrize("mode", ["last", "largest_remainder"])
def test_against_exact_integers(spark, mode):
    """Random groups, one of them holding most rows over many key blocks."""
    rng = random.Random(7)
    totals, parts = [], []
    for g in range(40):
        totals.append((g, rng.choice(["0.01", "0.33", "24", "99999999.99", "1000", "7.77"])))
        n = 3000 if g == 0 else rng.randint(1, 9)
        keys = rng.sample(range(40 << BLOCK_BITS), n)
        weights = rng.choice([[1], [1, 2, 5], [0.5, 1.5, 0.01, 333.33]])
        parts += [(g, k, rng.choice(weights)) for k in keys]
    got, rejected = split(spark, totals, parts, mode)
    assert not rejected
    for g, total in totals:
        expected = by_hand(total, [(k, w) for h, k, w in parts if h == g], mode)
        assert {k: int(v * 100) for k, (v, _) in got[g].items()} == expected
        assert sum(v for v, _ in got[g].values()) == D(total)


def params(spark, *rows):
    return spark.createDataFrame(list(rows), PRODUCT_PARAMETERS)


def test_expected_demand(spark):
    df = params(
        spark,
        (1, 10.0, 0.4, [], 1.0, 0.9, 1.1, 0.2),
        (2, 10.0, 0.0, [12], 3.0, 0.95, 1.05, 0.0),
        (3, 10.0, -2.0, [], 1.0, 0.9, 1.1, 0.0),
        (4, 10.0, 0.0, [], 1.0, 0.9, 1.1, 1.0),
    )
    days = allocate.expected_demand(df, "2025-01-01", "2025-12-31", "product_id")
    assert days.count() == 4 * 365
    last = {
        r.product_id: r.expected_quantity
        for r in days.where("order_date = '2025-12-31'").collect()
    }
    assert last[1] == pytest.approx(11.2)
    assert last[2] == pytest.approx(30.0)
    assert last[3] == 0.0
    assert last[4] == 0.0
    mid = days.where("product_id = 2 AND order_date = '2025-06-01'").first()
    assert mid.expected_quantity == pytest.approx(10.0)


@pytest.mark.parametrize(
    "trend, change", [(0.0, 2.2), (0.4, 31.5), (0.5, 38.3), (-0.3, -21.7), (-0.2, -13.5)]
)
def test_designed_trend_shows_in_the_report(spark, trend, change):
    df = params(spark, (1, 10.0, trend, [], 1.0, 0.9, 1.1, 0.0))
    daily = allocate.expected_demand(df, "2025-01-01", "2025-12-31", "product_id")
    base, compare = ("2025-01-01", "2025-04-01"), ("2025-10-01", "2026-01-01")
    found = allocate.period_change(daily, "expected_quantity", base, compare, "product_id")
    assert found.first().pct_change == pytest.approx(change, abs=0.051)


def test_ground_truth_compares_directions(spark):
    days = [dt.date(2025, 1, 1), dt.date(2025, 12, 1)]
    expected = spark.createDataFrame(
        [(1, days[0], 1.0), (1, days[1], 2.0), (2, days[0], 1.0), (2, days[1], 2.0)],
        "series int, order_date date, expected_quantity double",
    )
    measured = spark.createDataFrame(
        [(1, days[0], 5.0), (1, days[1], 6.0), (2, days[0], 5.0), (2, days[1], 4.0)],
        "series int, order_date date, quantity double",
    )
    got = allocate.trend_ground_truth(
        expected, measured, ("2025-01-01", "2025-04-01"), ("2025-10-01", "2026-01-01")
    )
    assert {r.series: (r.expected_pct, r.measured_pct, r.same_direction) for r in got.collect()} == {
        1: (100.0, 20.0, True),
        2: (100.0, -20.0, False),
    }


def test_small_groups_take_one_window_and_no_cells(spark, monkeypatch):
    """The same amounts either way; cells are for groups beyond the bound only."""
    rng = random.Random(11)
    totals = [(g, rng.choice(["0.01", "0.05", "10", "99.97"])) for g in range(30)]
    parts = [(g, k, rng.choice([1, 2, 0.5])) for g, _ in totals for k in rng.sample(range(1 << 20), rng.randint(1, 12))]
    used = []
    cells = allocate._largest_remainders
    monkeypatch.setattr(allocate, "_largest_remainders", lambda *a: used.append(1) or cells(*a))
    by_window, _ = split(spark, totals, parts, "largest_remainder")
    assert not used
    monkeypatch.setattr(allocate, "WINDOW_PARTS", 4)
    mixed, _ = split(spark, totals, parts, "largest_remainder")
    assert used and mixed == by_window and set(mixed) == {g for g, _ in totals}
