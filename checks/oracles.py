"""SQL twins of the queries, written independently of the plans they check."""

from __future__ import annotations

import re

# Views over the given tables; each oracle names the ones it needs.
VIEWS = {
    "r_orders": """
        SELECT o_orderkey AS order_id,
               CASE WHEN o_orderkey % 33 = 0 THEN -1 ELSE o_custkey END AS customer_id,
               CAST(o_orderdate AS DATE) AS order_date
        FROM orders""",
    "r_items": """
        SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_partkey AS product_id,
               CAST(l_quantity AS DECIMAL(12,2)) AS quantity,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS unit_price_at_order
        FROM lineitem""",
    "r_customers": """
        SELECT c_custkey AS customer_id, c_name AS name, r_name AS region
        FROM customer JOIN nation ON c_nationkey = n_nationkey
                      JOIN region ON n_regionkey = r_regionkey
        UNION ALL SELECT -1, 'Unknown Customer', 'Unknown'""",
    "r_stock": """
        SELECT p_partkey AS product_id,
               CAST(p_size * (10 + p_partkey % 12) AS DECIMAL(12,2)) AS stock_available
        FROM part""",
    "shelf": """
        SELECT p_partkey AS product_id,
               CAST(CASE WHEN p_partkey % 5 = 0 THEN 0 ELSE p_size * (p_partkey % 7) END
                    AS DECIMAL(12,2)) AS stock_available
        FROM part""",
    "days": """
        SELECT min(order_date) AS first_day, max(order_date) AS last_day FROM r_orders""",
    "raw_orders": """
        SELECT o_orderkey AS pos, o_orderkey AS order_id,
               CASE WHEN o_orderkey % 33 = 0 THEN NULL ELSE o_custkey END AS customer_id,
               CASE WHEN o_orderkey % 997 = 0 THEN 'bad'
                    WHEN o_orderkey % 67 = 0 THEN strftime(o_orderdate, '%d/%m/%Y')
                    ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_date
        FROM orders
        UNION ALL
        SELECT o_orderkey + 10000000000, o_orderkey,
               CASE WHEN o_orderkey % 33 = 0 THEN NULL ELSE o_custkey END,
               strftime(o_orderdate, '%Y-%m-%d')
        FROM orders WHERE o_orderkey % 50 = 0""",
    "line_originals": """
        SELECT CAST(((l_orderkey * 10 + l_linenumber) * 10000000 + l_partkey) * 100
                    + CAST(l_quantity AS BIGINT) AS BIGINT) AS order_item_id,
               CASE WHEN l_orderkey % 307 = 0 THEN -l_orderkey ELSE l_orderkey END AS order_id,
               CASE WHEN l_orderkey % 499 = 0 THEN 'Unknown Item'
                    ELSE concat(p_name, '#', CAST(p_partkey AS VARCHAR)) END AS product_name,
               CAST(l_quantity AS DECIMAL(12,2)) AS quantity,
               CAST(CAST(p_retailprice AS DECIMAL(12,2))
                    * CASE WHEN (l_orderkey + l_linenumber) % 101 = 0 THEN 2.00
                           WHEN (l_orderkey + l_linenumber) % 25 = 0 THEN 1.15
                           ELSE 1.00 END AS DECIMAL(12,2)) AS unit_price_at_order
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "raw_lines": """
        SELECT order_item_id AS pos, * FROM line_originals
        UNION ALL
        SELECT order_item_id + 4000000000000000000, order_item_id, order_id, product_name, NULL,
               unit_price_at_order
        FROM line_originals WHERE order_id % 50 = 0
        UNION ALL
        SELECT order_item_id - 4000000000000000000, order_item_id, order_id, product_name, quantity,
               CAST(unit_price_at_order + 1 AS DECIMAL(12,2))
        FROM line_originals WHERE order_id % 70 = 0""",
    "raw_items": "SELECT * EXCLUDE (pos) FROM raw_lines",
    "lookup": """
        SELECT concat(p_name, '#', CAST(p_partkey AS VARCHAR)) AS product_name,
               p_partkey AS product_id, CAST(p_retailprice AS DECIMAL(12,2)) AS unit_price
        FROM part""",
    "first_orders": """
        SELECT pos, order_id, customer_id, order_date FROM raw_orders
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY pos) = 1""",
    "first_items": """
        SELECT * EXCLUDE (pos) FROM raw_lines
        QUALIFY row_number() OVER (
            PARTITION BY order_item_id
            ORDER BY pos, order_id, product_name, quantity NULLS LAST, unit_price_at_order) = 1""",
    "fixed_orders": """
        SELECT pos, order_id, customer_id,
               CASE WHEN regexp_full_match(order_date, '[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}')
                    THEN CAST(try_strptime(order_date, '%Y-%m-%d') AS DATE)
                    WHEN regexp_full_match(order_date, '[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}')
                    THEN CAST(try_strptime(order_date, '%d/%m/%Y') AS DATE) END AS order_date
        FROM raw_orders""",
    "cleaned_orders": """
        SELECT order_id, coalesce(customer_id, -1) AS customer_id, order_date
        FROM fixed_orders
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY pos) = 1""",
    "per_order": """
        SELECT i.order_id, customer_id, order_date,
               quantity * unit_price_at_order AS revenue
        FROM r_items i JOIN r_orders o ON i.order_id = o.order_id""",
    "series_daily": """
        SELECT p_brand AS series, order_date, sum(quantity) AS quantity
        FROM r_items i JOIN r_orders o ON i.order_id = o.order_id
                       JOIN part ON product_id = p_partkey
        GROUP BY ALL""",
    "spine": """
        SELECT CAST(unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS DATE)
                   AS order_date
        FROM days""",
    "design_spine": """
        SELECT CAST(unnest(generate_series(DATE '1997-01-01', DATE '1997-12-31',
                                           INTERVAL 1 DAY)) AS DATE) AS order_date""",
    "grid": """
        SELECT b.series, s.order_date, coalesce(d.quantity, 0.00) AS quantity
        FROM (SELECT DISTINCT p_brand AS series FROM part) b
        CROSS JOIN spine s
        LEFT JOIN series_daily d ON d.series = b.series AND d.order_date = s.order_date""",
    "lagged": """
        SELECT series, order_date, quantity,
               CAST(lag(quantity, 1) OVER w AS DOUBLE) AS quantity_lag_1,
               CAST(lag(quantity, 7) OVER w AS DOUBLE) AS quantity_lag_7,
               CASE WHEN count(*) OVER f = 7
                    THEN CAST(sum(quantity) OVER f AS DOUBLE) / 7 END AS quantity_rolling_7
        FROM grid
        WINDOW w AS (PARTITION BY series ORDER BY order_date),
               f AS (PARTITION BY series ORDER BY order_date
                     ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)""",
    "complete": """
        SELECT series, order_date, CAST(quantity AS DOUBLE) AS quantity,
               quantity_lag_1, quantity_lag_7, quantity_rolling_7
        FROM lagged
        WHERE quantity_lag_1 IS NOT NULL AND quantity_lag_7 IS NOT NULL
          AND quantity_rolling_7 IS NOT NULL""",
    "train_rows": "SELECT * FROM complete WHERE order_date < (SELECT last_day - 46 FROM days)",
    "test_rows": "SELECT * FROM complete WHERE order_date >= (SELECT last_day - 46 FROM days)",
    "product_daily": """
        SELECT product_id, order_date, sum(quantity) AS quantity
        FROM r_items i JOIN r_orders o ON i.order_id = o.order_id
        GROUP BY ALL""",
    "product_days": """
        SELECT p.p_partkey AS product_id, s.order_date, coalesce(d.quantity, 0.00) AS quantity
        FROM part p CROSS JOIN spine s
        LEFT JOIN product_daily d ON d.product_id = p.p_partkey AND d.order_date = s.order_date""",
    "product_lagged": """
        SELECT product_id, order_date, CAST(quantity AS DOUBLE) AS quantity,
               CAST(lag(quantity, 1) OVER w AS DOUBLE) AS lag_1,
               CAST(lag(quantity, 7) OVER w AS DOUBLE) AS lag_7,
               CAST(sum(quantity) OVER f AS DOUBLE) / 7 AS rolling_7
        FROM product_days
        WINDOW w AS (PARTITION BY product_id ORDER BY order_date),
               f AS (PARTITION BY product_id ORDER BY order_date
                     ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)""",
    "reached": """
        SELECT g.product_id, g.order_date, g.quantity,
               CAST(lag(g.quantity, 1) OVER w AS DOUBLE) AS quantity_lag_1,
               CAST(lag(g.quantity, 7) OVER w AS DOUBLE) AS quantity_lag_7,
               CASE WHEN count(*) OVER f = 7
                    THEN CAST(sum(g.quantity) OVER f AS DOUBLE) / 7 END AS quantity_rolling_7,
               count(d.quantity) OVER (PARTITION BY g.product_id ORDER BY g.order_date
                     ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS sales
        FROM product_days g
        LEFT JOIN product_daily d ON d.product_id = g.product_id AND d.order_date = g.order_date
        WINDOW w AS (PARTITION BY g.product_id ORDER BY g.order_date),
               f AS (PARTITION BY g.product_id ORDER BY g.order_date
                     ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)""",
    "near_sales": "SELECT * EXCLUDE (sales) FROM reached WHERE sales > 0",
    "near_complete": "SELECT * FROM near_sales WHERE quantity_lag_7 IS NOT NULL",
    "near_train": "SELECT * FROM near_complete WHERE order_date < (SELECT last_day - 46 FROM days)",
    "state": """
        SELECT product_id, list(CAST(quantity AS DOUBLE) ORDER BY order_date) AS q
        FROM product_days WHERE order_date > (SELECT last_day - 7 FROM days)
        GROUP BY product_id""",
    "steps": """
        SELECT product_id, 0 AS horizon, q, CAST(NULL AS DOUBLE) AS prediction FROM state
        UNION ALL
        SELECT product_id, horizon + 1, list_append(q[2:7], p), p
        FROM (SELECT product_id, horizon, q,
                     round_even((((((((0.0 + q[1]) + q[2]) + q[3]) + q[4]) + q[5]) + q[6]) + q[7])
                                / 7 * 1e6, 0) / 1e6 AS p
              FROM steps WHERE horizon < 7)""",
    "next_day": """
        SELECT product_id, round_even(prediction * 100, 0) / 100 AS predicted_daily_demand,
               round_even(prediction * 7.0 / 5.0, 0) * 5.0 AS reorder_point
        FROM steps WHERE horizon = 1""",
    "triggered": """
        SELECT n.product_id, predicted_daily_demand, reorder_point,
               CAST(s.stock_available AS DOUBLE) AS stock_available,
               CAST(s.stock_available AS DOUBLE) <= reorder_point AS needs_reorder
        FROM next_day n JOIN shelf s ON n.product_id = s.product_id""",
    "sized": """
        SELECT *, CASE WHEN NOT needs_reorder THEN 0.0
                       WHEN predicted_daily_demand * 30.0 < stock_available THEN 0.0
                       ELSE round_even((predicted_daily_demand * 30.0 - stock_available) / 5.0, 0)
                            * 5.0 END AS recommended_order_qty
        FROM triggered""",
    "erratic": """
        SELECT product_id,
               CAST(count(*) FILTER (quantity = 0) AS DOUBLE) / CAST(count(*) AS DOUBLE)
                   AS zero_day_share
        FROM product_days GROUP BY product_id""",
    "params": """
        SELECT p_brand AS series, CAST(sum(p_size) AS DOUBLE) / 100.0 AS base_demand,
               CAST(count(*) % 7 - 3 AS DOUBLE) / 10.0 AS trend,
               count(*) % 7 < 3 AS seasonal,
               CAST(count(*) % 5 AS DOUBLE) / 20.0 AS zero_order_prob
        FROM part GROUP BY p_brand""",
    "designed": """
        SELECT series, order_date,
               greatest(base_demand
                 * (CAST(1 AS DOUBLE) + trend * (CAST(date_diff('day', DATE '1997-01-01', order_date) + 1
                                             AS DOUBLE) / CAST(365 AS DOUBLE)))
                 * CASE WHEN seasonal AND month(order_date) IN (10, 11)
                        THEN CAST(3.5 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END
                 * ((CAST(0.9 AS DOUBLE) + CAST(1.1 AS DOUBLE)) / CAST(2 AS DOUBLE))
                 * (CAST(1 AS DOUBLE) - zero_order_prob), CAST(0 AS DOUBLE)) AS expected_quantity
        FROM params CROSS JOIN design_spine""",
    "alloc_parts": """
        SELECT order_id, product_id, CAST(sum(quantity) AS DECIMAL(12,2)) AS weight
        FROM r_items GROUP BY order_id, product_id""",
    "alloc_totals": """
        SELECT o_orderkey AS order_id,
               CAST(CASE WHEN o_orderkey % 97 = 0 THEN 0 ELSE o_totalprice END
                    AS DECIMAL(12,2)) AS total
        FROM orders""",
    "alloc_units": """
        SELECT p.order_id, p.product_id, p.weight, CAST(t.total * 100 AS HUGEINT) AS t,
               CAST(p.weight * 100 AS HUGEINT) AS w,
               CAST(sum(p.weight * 100) OVER (PARTITION BY p.order_id) AS HUGEINT) AS w_sum
        FROM alloc_parts p JOIN alloc_totals t ON p.order_id = t.order_id
        WHERE t.total > 0""",
    "portions": """
        SELECT order_date, i.order_id, line_no, product_id, quantity, unit_price_at_order,
               row_number() OVER (
                   PARTITION BY order_date, product_id
                   ORDER BY i.order_id, line_no, quantity, unit_price_at_order) AS j
        FROM r_items i JOIN r_orders o ON i.order_id = o.order_id""",
    "day_products": """
        SELECT order_date, product_id, count(*) AS k,
               row_number() OVER (PARTITION BY order_date ORDER BY product_id) AS rank
        FROM portions GROUP BY order_date, product_id""",
    "packing": """
        SELECT order_date, product_id, rank, CAST(0 AS BIGINT) AS first_basket, k AS a1,
               CAST(0 AS BIGINT) AS a2, CAST(0 AS BIGINT) AS a3, CAST(0 AS BIGINT) AS a4
        FROM day_products WHERE rank = 1
        UNION ALL
        SELECT d.order_date, d.product_id, d.rank, a4, greatest(a1, a4 + k),
               greatest(a2, least(a1, a4 + k)), greatest(a3, least(a2, a4 + k)),
               greatest(a4, least(a3, a4 + k))
        FROM packing p JOIN day_products d
          ON d.order_date = p.order_date AND d.rank = p.rank + 1""",
    "packed": """
        SELECT p.order_date, p.product_id, p.order_id, p.line_no, p.quantity,
               p.unit_price_at_order, first_basket + j AS basket_no
        FROM portions p JOIN packing b ON p.order_date = b.order_date AND p.product_id = b.product_id""",
    "numbered": """
        SELECT *, row_number() OVER (PARTITION BY order_date, basket_no ORDER BY product_id)
                  AS basket_line
        FROM packed""",
}

X = ["day_of_week", "month", "is_weekend", "is_festival_season", "quantity_lag_1", "quantity_lag_7", "quantity_rolling_7"]
_ALL = [*X, "quantity"]
_CAL = """CAST(isodow(order_date) - 1 AS INTEGER) AS day_of_week,
    CAST(month(order_date) AS INTEGER) AS month,
    CAST(isodow(order_date) >= 6 AS INTEGER) AS is_weekend,
    CAST(month(order_date) IN (10, 11) AS INTEGER) AS is_festival_season"""

# Normal equations over every product and day, solved by elimination, one step after the other.
VIEWS["panel"] = f"""
        SELECT product_id, order_date, CAST(quantity AS DOUBLE) AS quantity, quantity_lag_1, quantity_lag_7,
               quantity_rolling_7, {_CAL}
        FROM reached WHERE quantity_lag_7 IS NOT NULL"""
VIEWS["panel_train"] = "SELECT * FROM panel WHERE order_date < (SELECT last_day - 46 FROM days)"
VIEWS["panel_test"] = "SELECT * FROM panel WHERE order_date >= (SELECT last_day - 46 FROM days)"
VIEWS["panel_mean"] = f"""
        SELECT product_id, {", ".join(f"avg({c}) AS m{i}" for i, c in enumerate(_ALL))}
        FROM panel_train GROUP BY product_id"""
VIEWS["gram0"] = f"""
        SELECT {", ".join(f"sum(d{i} * d{j}) AS a{i}_{j}" for i in range(7) for j in range(8))}
        FROM (SELECT {", ".join(f"{c} - m{i} AS d{i}" for i, c in enumerate(_ALL))}
              FROM panel_train t JOIN panel_mean m ON t.product_id = m.product_id)"""
for _k in range(7):
    VIEWS[f"gram{_k + 1}"] = "SELECT " + ", ".join(
        f"a{i}_{j} / a{_k}_{_k} AS a{i}_{j}" if i == _k else f"a{i}_{j} - a{i}_{_k} * a{_k}_{j} / a{_k}_{_k} AS a{i}_{j}"
        for i in range(7)
        for j in range(8)
    ) + f" FROM gram{_k}"
VIEWS["effect_of"] = f"""
        SELECT product_id, m7 - ({" + ".join(f"a{i}_7 * m{i}" for i in range(7))}) AS effect
        FROM panel_mean, gram7"""
VIEWS["linear_steps"] = f"""
        SELECT product_id, 0 AS horizon, q, CAST(NULL AS DOUBLE) AS prediction FROM state
        UNION ALL
        SELECT product_id, horizon + 1, list_append(q[2:7], p), p
        FROM (SELECT s.product_id, horizon, q,
                     round_even((effect + a0_7 * day_of_week + a1_7 * month + a2_7 * is_weekend
                                 + a3_7 * is_festival_season + a4_7 * q[7] + a5_7 * q[1]
                                 + a6_7 * (q[1] + q[2] + q[3] + q[4] + q[5] + q[6] + q[7]) / 7) * 1e6, 0) / 1e6 AS p
              FROM (SELECT *, {_CAL}
                    FROM (SELECT *, CAST((SELECT last_day FROM days) + horizon + 1 AS DATE) AS order_date
                          FROM linear_steps WHERE horizon < 7)) s
              JOIN effect_of e ON s.product_id = e.product_id, gram7)"""

ORDER_HASH = "((order_id % 2147483648) * 2654435761) % 4294967296"


def _sampled(fraction: str) -> str:
    return f"""
        SELECT order_id, customer_id, order_date FROM r_orders
        QUALIFY row_number() OVER (ORDER BY {ORDER_HASH}, order_id)
                <= floor((SELECT count(*) FROM r_orders) * CAST({fraction} AS DOUBLE))"""


VIEWS["sampled_3"] = _sampled("0.03")
VIEWS["sampled_2"] = _sampled("0.02")

RECURSIVE = {"steps", "packing", "linear_steps"}

PRODUCT_REVENUE = """
    SELECT product_id, p_name AS product_name, p_type AS category,
           sum(quantity) AS q, sum(quantity * unit_price_at_order) AS revenue
    FROM r_items JOIN part ON product_id = p_partkey GROUP BY ALL"""

TREND = """
    SELECT product_id, p_name AS product_name,
           sum(CASE WHEN order_date >= DATE '1997-01-01' AND order_date < DATE '1997-04-01'
                    THEN quantity ELSE 0 END) AS q1,
           sum(CASE WHEN order_date >= DATE '1997-10-01' AND order_date < DATE '1998-01-01'
                    THEN quantity ELSE 0 END) AS q4
    FROM r_items i JOIN r_orders o ON i.order_id = o.order_id
                   JOIN part ON product_id = p_partkey
    GROUP BY product_id, p_name"""

PCT = "round_even((CAST({1} AS DOUBLE) - {0}) / nullif(CAST({0} AS DOUBLE), 0) * 100 * 10, 0) / 10"

TREND_OUT = f"""
    SELECT product_id, product_name, CAST(q1 AS DOUBLE) AS q1_quantity,
           CAST(q4 AS DOUBLE) AS q4_quantity, {PCT.format('q1', 'q4')} AS pct_change
    FROM ({TREND})"""

LOW_STOCK = """
    SELECT product_id, product_name, CAST(stock_available AS DOUBLE) AS stock_available, daily
               AS avg_daily_demand_recent,
           round_even(stock_available::DOUBLE / nullif(daily, 0) * 10, 0) / 10
               AS days_of_stock_remaining
    FROM (SELECT p_partkey AS product_id, p_name AS product_name, stock_available,
                 CAST(sum(quantity) AS DOUBLE) / 30 AS daily
          FROM r_items i JOIN r_orders o ON i.order_id = o.order_id
                         JOIN part ON i.product_id = p_partkey
                         JOIN r_stock s ON s.product_id = p_partkey
          WHERE order_date > (SELECT last_day - 30 FROM days)
          GROUP BY ALL)"""

LOW_STOCK_5 = f"{LOW_STOCK} ORDER BY days_of_stock_remaining NULLS LAST, product_id LIMIT 5"

REGION = """
    SELECT region, count(DISTINCT order_id) AS total_orders,
           CAST(sum(revenue) AS DOUBLE) AS total_revenue
    FROM per_order p JOIN r_customers c ON p.customer_id = c.customer_id
    WHERE c.customer_id <> -1 GROUP BY region"""

TOP = """
    SELECT customer_id, name, region, CAST(spend AS DOUBLE) AS total_spend
    FROM (SELECT c.customer_id, name, region, sum(revenue) AS spend
          FROM per_order p JOIN r_customers c ON p.customer_id = c.customer_id
          WHERE c.customer_id <> -1 GROUP BY ALL
          ORDER BY spend DESC, c.customer_id LIMIT 10)"""

MONTHLY = """
    SELECT strftime(order_date, '%Y-%m') AS month, CAST(sum(revenue) AS DOUBLE) AS total_revenue,
           count(DISTINCT order_id) AS total_orders
    FROM per_order GROUP BY month"""

BEST = f"""
    SELECT product_id, product_name, CAST(q AS DOUBLE) AS total_quantity_sold,
           CAST(revenue AS DOUBLE) AS total_revenue FROM ({PRODUCT_REVENUE})"""

CATEGORY = f"""
    SELECT category AS category_id, category AS category_name,
           CAST(sum(q) AS DOUBLE) AS total_quantity_sold,
           CAST(sum(revenue) AS DOUBLE) AS total_revenue
    FROM ({PRODUCT_REVENUE}) GROUP BY category"""


def _long(body: str, section: str, label: str, name: str, order: str, metrics: list[str]) -> str:
    ranked = f"SELECT *, row_number() OVER (ORDER BY {order}) AS rank FROM ({body})"
    return " UNION ALL ".join(
        f"SELECT '{section}' AS section, rank, CAST({label} AS VARCHAR) AS label, "
        f"CAST({name} AS VARCHAR) AS name, '{m}' AS metric, CAST({m} AS DOUBLE) AS value "
        f"FROM ({ranked})"
        for m in metrics
    )


def _metrics_of(name: str, scored: str) -> str:
    """Errors of rows (quantity, p)."""
    return f"""
        SELECT '{name}' AS model, count(*) AS rows, round(avg(abs(quantity - p)), 6) AS mae,
               round(avg((quantity - p) * (quantity - p)), 6) AS mse,
               round(sqrt(avg((quantity - p) * (quantity - p))), 6) AS rmse,
               round(1 - avg((quantity - p) * (quantity - p)) / var_pop(quantity), 6) AS r2
        FROM {scored}"""


def _metrics(name: str, prediction: str) -> str:
    return _metrics_of(name, f"(SELECT quantity, {prediction} AS p FROM test_rows)")


ITEM_COLUMNS = """order_item_id, order_id, product_name, CAST(quantity AS DOUBLE) AS quantity,
    CAST(unit_price_at_order AS DOUBLE) AS unit_price_at_order"""

CLEAN_ITEMS = """
    SELECT order_item_id, order_id, product_id, quantity, unit_price_at_order
    FROM first_items i LEFT JOIN lookup l ON i.product_name = l.product_name"""

CALENDAR = _CAL

PROFILE_ORDERS = """
    SELECT count(*) AS row_count, count(*) - count(order_id) AS null_order_id,
           count(*) - count(customer_id) AS null_customer_id,
           count(*) - count(order_date) AS null_order_date,
           (SELECT count(*) FROM raw_orders)
             - (SELECT count(*) FROM (SELECT DISTINCT order_id, customer_id, order_date
                                      FROM raw_orders)) AS duplicate_rows,
           count(*) FILTER (try_strptime(order_date, '%Y-%m-%d') IS NULL) AS malformed_dates
    FROM raw_orders"""

PROFILE_ITEMS = """
    SELECT count(*) AS row_count, count(*) - count(order_item_id) AS null_order_item_id,
           count(*) - count(order_id) AS null_order_id,
           count(*) - count(r.product_name) AS null_product_name,
           count(*) - count(quantity) AS null_quantity,
           count(*) - count(unit_price_at_order) AS null_unit_price_at_order,
           (SELECT count(*) FROM raw_items)
             - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw_items)) AS duplicate_rows,
           count(*) FILTER (coalesce(unit_price_at_order <> unit_price, true)) AS price_anomalies
    FROM raw_items r LEFT JOIN lookup l ON r.product_name = l.product_name"""

VALIDATION = """
    SELECT 'missing_values' AS check_name,
           (SELECT count(*) FILTER (order_id IS NULL) + count(*) FILTER (customer_id IS NULL)
                   + count(*) FILTER (order_date IS NULL) FROM cleaned_orders)
           + (SELECT count(*) FILTER (order_item_id IS NULL) + count(*) FILTER (order_id IS NULL)
                     + count(*) FILTER (product_name IS NULL) + count(*) FILTER (quantity IS NULL)
                     + count(*) FILTER (unit_price_at_order IS NULL) FROM first_items)
           AS violations
    UNION ALL SELECT 'duplicate_order_ids', count(*) - count(DISTINCT order_id) FROM cleaned_orders
    UNION ALL SELECT 'duplicate_order_item_ids', count(*) - count(DISTINCT order_item_id)
              FROM first_items
    UNION ALL SELECT 'order_id_references', count(*) FROM first_items i
              WHERE NOT EXISTS (SELECT 1 FROM cleaned_orders o WHERE o.order_id = i.order_id)
    UNION ALL SELECT 'product_names', count(*) FROM first_items i
              WHERE NOT EXISTS (SELECT 1 FROM lookup l WHERE l.product_name = i.product_name)"""


def _not_null(table: str, body: str, columns: list[str]) -> list[str]:
    return [
        f"SELECT '{table}' AS table_name, 'not_null' AS rule, '{c}' AS column_name, "
        f"count(*) - count({c}) AS violations FROM {body}"
        for c in columns
    ]


CONSTRAINTS = " UNION ALL ".join(
    _not_null("customers", "r_customers", ["customer_id", "name", "region"])
    + _not_null("orders", "cleaned_orders", ["order_id", "customer_id", "order_date"])
    + _not_null(
        "order_items",
        f"({CLEAN_ITEMS})",
        ["order_item_id", "order_id", "product_id", "quantity", "unit_price_at_order"],
    )
    + [
        "SELECT 'customers', 'primary_key', 'customer_id', "
        "count(*) - count(DISTINCT customer_id) FROM r_customers",
        "SELECT 'orders', 'primary_key', 'order_id', count(*) - count(DISTINCT order_id) "
        "FROM cleaned_orders",
        "SELECT 'order_items', 'primary_key', 'order_item_id', "
        "count(*) - count(DISTINCT order_item_id) FROM first_items",
        "SELECT 'orders', 'foreign_key', 'customer_id', count(*) FROM cleaned_orders o "
        "WHERE NOT EXISTS (SELECT 1 FROM r_customers c WHERE c.customer_id = o.customer_id)",
        "SELECT 'order_items', 'foreign_key', 'order_id', count(*) FROM first_items i "
        "WHERE NOT EXISTS (SELECT 1 FROM cleaned_orders o WHERE o.order_id = i.order_id)",
    ]
)

BODIES = {
    "total_orders": "SELECT count(*) AS total_orders FROM r_orders",
    "line_revenue": """
        SELECT order_id, line_no, product_id, CAST(quantity AS DOUBLE) AS quantity,
               CAST(unit_price_at_order AS DOUBLE) AS unit_price_at_order,
               CAST(quantity * unit_price_at_order AS DOUBLE) AS revenue
        FROM r_items""",
    "best_sellers": BEST,
    "category_performance": CATEGORY,
    "revenue_trends": MONTHLY,
    "trend_analysis": TREND_OUT,
    "low_stock_risk": LOW_STOCK,
    "low_stock_top5": LOW_STOCK_5,
    "region_performance": REGION,
    "top_customers": TOP,
    "full_report": " UNION ALL ".join(
        [
            _long(
                BEST,
                "best_sellers",
                "product_id",
                "product_name",
                "total_revenue DESC, product_id",
                ["total_quantity_sold", "total_revenue"],
            ),
            _long(
                CATEGORY,
                "category_performance",
                "category_name",
                "category_name",
                "total_revenue DESC, category_id",
                ["total_quantity_sold", "total_revenue"],
            ),
            _long(
                MONTHLY,
                "revenue_trends",
                "month",
                "month",
                "month",
                ["total_revenue", "total_orders"],
            ),
            _long(
                TREND_OUT,
                "trend_analysis",
                "product_id",
                "product_name",
                "pct_change DESC NULLS LAST, product_id",
                ["q1_quantity", "q4_quantity", "pct_change"],
            ),
            _long(
                LOW_STOCK_5,
                "low_stock_risk",
                "product_id",
                "product_name",
                "days_of_stock_remaining NULLS LAST, product_id",
                ["stock_available", "avg_daily_demand_recent", "days_of_stock_remaining"],
            ),
            _long(
                REGION,
                "region_performance",
                "region",
                "region",
                "total_revenue DESC, region",
                ["total_orders", "total_revenue"],
            ),
            _long(
                TOP,
                "top_customers",
                "customer_id",
                "concat_ws(', ', name, region)",
                "total_spend DESC, customer_id",
                ["total_spend"],
            ),
        ]
    ),
    "revenue_reconciliation": f"""
        SELECT CAST(p AS DOUBLE) AS product_total, CAST(c AS DOUBLE) AS category_total,
               CAST(m AS DOUBLE) AS month_total, abs(p - c) < 1 AND abs(p - m) < 1 AS totals_match,
               low > 0 AS all_positive
        FROM (SELECT (SELECT sum(revenue) FROM ({PRODUCT_REVENUE})) AS p,
                     (SELECT sum(s) FROM (SELECT category, sum(revenue) AS s
                                          FROM ({PRODUCT_REVENUE}) GROUP BY 1)) AS c,
                     (SELECT sum(revenue) FROM per_order) AS m,
                     (SELECT min(revenue) FROM ({PRODUCT_REVENUE})) AS low)""",
    "table_info": """
        SELECT CAST(0 AS INTEGER) AS position, 'order_id' AS column_name, 'bigint' AS data_type,
               count(order_id) AS non_null, count(*) AS row_count FROM raw_orders
        UNION ALL SELECT 1, 'customer_id', 'bigint', count(customer_id), count(*) FROM raw_orders
        UNION ALL SELECT 2, 'order_date', 'string', count(order_date), count(*) FROM raw_orders""",
    "scan_csv": """
        SELECT order_id, CAST(customer_id AS VARCHAR) AS customer_id, order_date
        FROM raw_orders""",
    "csv_roundtrip": f"SELECT {ITEM_COLUMNS} FROM raw_items",
    "profile_orders": f"""
        SELECT *, null_customer_id / row_count * 100 AS missing_customer_pct,
               row_count - malformed_dates AS valid_dates,
               malformed_dates / row_count * 100 AS malformed_date_pct
        FROM ({PROFILE_ORDERS})""",
    "profile_order_items": f"""
        SELECT *, price_anomalies / row_count * 100 AS price_anomaly_pct
        FROM ({PROFILE_ITEMS})""",
    "profile_summary": f"""
        WITH o AS ({PROFILE_ORDERS}), i AS ({PROFILE_ITEMS})
        SELECT 'orders' AS metric, row_count AS value FROM o
        UNION ALL SELECT 'missing_customer_ids', null_customer_id FROM o
        UNION ALL SELECT 'duplicate_orders', duplicate_rows FROM o
        UNION ALL SELECT 'malformed_dates', malformed_dates FROM o
        UNION ALL SELECT 'order_items', row_count FROM i
        UNION ALL SELECT 'duplicate_order_items', duplicate_rows FROM i
        UNION ALL SELECT 'price_anomalies', price_anomalies FROM i""",
    "clean_customer_ids": """
        SELECT pos, order_id, coalesce(customer_id, -1) AS customer_id, order_date
        FROM raw_orders""",
    "dedup_orders": """
        SELECT pos, order_id, CAST(customer_id AS VARCHAR) AS customer_id, order_date
        FROM first_orders""",
    "dedup_order_items": f"SELECT {ITEM_COLUMNS} FROM first_items",
    "fix_dates": """
        SELECT pos, order_id, CAST(customer_id AS VARCHAR) AS customer_id,
               CAST(order_date AS VARCHAR) AS order_date
        FROM fixed_orders""",
    "price_sanity": """
        SELECT order_item_id, order_id, r.product_name, CAST(quantity AS DOUBLE) AS quantity,
               CAST(unit_price_at_order AS DOUBLE) AS unit_price_at_order,
               CAST(unit_price AS DOUBLE) AS expected_price
        FROM raw_items r JOIN lookup l ON r.product_name = l.product_name
        WHERE abs(unit_price_at_order - unit_price) * 2 > unit_price""",
    "validate_cleaned": f"""
        SELECT check_name, CAST(violations AS BIGINT) AS violations, violations = 0 AS passed
        FROM ({VALIDATION} UNION ALL SELECT 'all', sum(violations) FROM ({VALIDATION}))""",
    "orphan_items": """
        SELECT count(*) AS violations FROM raw_items i LEFT JOIN r_orders o
          ON i.order_id = o.order_id WHERE o.order_id IS NULL""",
    "orphan_products": """
        SELECT count(*) AS violations FROM raw_items i LEFT JOIN lookup l
          ON i.product_name = l.product_name WHERE l.product_name IS NULL""",
    "fk_quarantine": f"""
        SELECT {ITEM_COLUMNS},
               CASE WHEN NOT EXISTS (SELECT 1 FROM r_orders o WHERE o.order_id = r.order_id)
                    THEN 'order_id'
                    WHEN NOT EXISTS (SELECT 1 FROM lookup l
                                     WHERE l.product_name = r.product_name)
                    THEN 'product_name' ELSE '' END AS reject_reason
        FROM raw_items r""",
    "constraint_report": CONSTRAINTS,
    "resolve_product_ids": """
        SELECT order_item_id, order_id, CAST(product_id AS VARCHAR) AS product_id,
               CAST(quantity AS DOUBLE) AS quantity,
               CAST(unit_price_at_order AS DOUBLE) AS unit_price_at_order
        FROM raw_items r LEFT JOIN lookup l ON r.product_name = l.product_name""",
    "customers_with_sentinel": "SELECT * FROM r_customers",
    "products_enriched": """
        SELECT p_partkey AS product_id, p_name AS product_name, category_id,
               CAST(supplier_id AS VARCHAR) AS supplier_id,
               CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS DOUBLE) AS unit_price
        FROM part p
        JOIN (SELECT p_type AS t, min(p_partkey) AS category_id FROM part GROUP BY 1) c
          ON c.t = p.p_type
        LEFT JOIN (SELECT p_type AS t, max(s_suppkey) AS supplier_id
                   FROM supplier JOIN part ON s_suppkey = p_partkey GROUP BY 1) s
          ON s.t = p.p_type""",
    "clean_orders": """
        SELECT order_id, customer_id, CAST(order_date AS VARCHAR) AS order_date
        FROM cleaned_orders""",
    "clean_order_items": f"""
        SELECT order_item_id, order_id, CAST(product_id AS VARCHAR) AS product_id,
               CAST(quantity AS DOUBLE) AS quantity,
               CAST(unit_price_at_order AS DOUBLE) AS unit_price_at_order
        FROM ({CLEAN_ITEMS})""",
    "scan_text_csv": """
        SELECT CAST(order_item_id AS VARCHAR) AS order_item_id, CAST(order_id AS VARCHAR) AS order_id,
               product_name, CAST(quantity AS VARCHAR) AS quantity,
               CAST(unit_price_at_order AS VARCHAR) AS unit_price_at_order
        FROM raw_items""",
    "literal_rows": """
        SELECT CAST((month(order_date) - 1) // 3 + 1 AS INTEGER) AS quarter, count(*) AS orders
        FROM r_orders GROUP BY 1""",
    "append_orders": """
        SELECT customer_id, count(*) AS orders, CAST(max(order_date) AS VARCHAR) AS last_order
        FROM r_orders GROUP BY customer_id""",
    "append_batch_twice": """
        SELECT CASE WHEN order_id % 2 = 0 THEN 'even' ELSE 'odd' END AS batch, count(*) AS orders,
               count(DISTINCT order_id) AS different, CAST(max(order_date) AS VARCHAR) AS last_order
        FROM r_orders GROUP BY 1""",
    "incremental_dedup": """
        SELECT pos, order_id, CAST(customer_id AS VARCHAR) AS customer_id, order_date,
               CAST(batch AS INTEGER) AS batch
        FROM (SELECT *, CASE WHEN order_id % 3 = 0 OR pos <> order_id THEN 2 ELSE 1 END AS batch FROM raw_orders)
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY batch, pos) = 1""",
    "copied_rows": """
        SELECT 'orders' AS table_name,
               (SELECT count(*) FROM raw_orders)
               - (SELECT count(*) FROM (SELECT DISTINCT order_id, customer_id, order_date FROM raw_orders)) AS duplicate_rows
        UNION ALL
        SELECT 'order_items',
               (SELECT count(*) FROM raw_items) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw_items))""",
    "date_range": """
        SELECT CAST(min(order_date) AS VARCHAR) AS first_day, CAST(max(order_date) AS VARCHAR) AS last_day,
               count(*) AS n
        FROM r_orders""",
    "load_retail": f"""
        WITH enriched AS (
            SELECT p_partkey AS product_id, concat(p_name, '#', p_partkey) AS product_name,
                   category_id, supplier_id, CAST(p_retailprice AS DECIMAL(12,2)) AS unit_price
            FROM part p
            JOIN (SELECT p_type AS t, min(p_partkey) AS category_id FROM part GROUP BY 1) c
              ON c.t = p.p_type
            LEFT JOIN (SELECT p_type AS t, max(s_suppkey) AS supplier_id
                       FROM supplier JOIN part ON s_suppkey = p_partkey GROUP BY 1) s
              ON s.t = p.p_type),
        judged_products AS (
            SELECT *, CASE WHEN supplier_id IS NULL THEN 'missing supplier_id' ELSE '' END AS reason
            FROM enriched),
        judged_orders AS (
            SELECT *, CASE WHEN order_date IS NULL THEN 'missing order_date'
                           WHEN customer_id NOT IN (SELECT customer_id FROM r_customers)
                           THEN 'unknown customer_id' ELSE '' END AS reason
            FROM cleaned_orders),
        judged_items AS (
            SELECT *, CASE WHEN order_id IS NULL THEN 'missing order_id'
                           WHEN product_id IS NULL THEN 'missing product_id'
                           WHEN quantity IS NULL THEN 'missing quantity'
                           WHEN order_id NOT IN (SELECT order_id FROM judged_orders WHERE reason = '')
                           THEN 'unknown order_id'
                           WHEN product_id NOT IN (SELECT product_id FROM judged_products WHERE reason = '')
                           THEN 'unknown product_id' ELSE '' END AS reason
            FROM ({CLEAN_ITEMS}))
        SELECT 'categories' AS table_name, CAST(min(p_partkey) AS VARCHAR) AS row_key,
               concat_ws('|', min(p_partkey), p_type) AS content, '' AS reject_reason
        FROM part GROUP BY p_type
        UNION ALL
        SELECT 'suppliers', CAST(s_suppkey AS VARCHAR), concat_ws('|', 'none', s_name, s_suppkey), ''
        FROM supplier JOIN part ON s_suppkey = p_partkey
        UNION ALL
        SELECT 'customers', CAST(customer_id AS VARCHAR), concat_ws('|', customer_id, name, region), ''
        FROM r_customers
        UNION ALL
        SELECT 'products', CAST(product_id AS VARCHAR),
               concat_ws('|', category_id, product_id, product_name,
                         coalesce(CAST(supplier_id AS VARCHAR), '-'), unit_price), reason
        FROM judged_products
        UNION ALL
        SELECT 'inventory', CAST(s.product_id AS VARCHAR),
               concat_ws('|', CAST((SELECT last_day FROM days) AS VARCHAR), s.product_id, stock_available),
               CASE WHEN reason = '' THEN '' ELSE 'unknown product_id' END
        FROM r_stock s JOIN judged_products p ON s.product_id = p.product_id
        UNION ALL
        SELECT 'orders', CAST(order_id AS VARCHAR),
               concat_ws('|', customer_id, coalesce(CAST(order_date AS VARCHAR), '-'), order_id), reason
        FROM judged_orders
        UNION ALL
        SELECT 'order_items', CAST(order_item_id AS VARCHAR),
               concat_ws('|', order_id, order_item_id, coalesce(CAST(product_id AS VARCHAR), '-'),
                         coalesce(CAST(quantity AS VARCHAR), '-'), unit_price_at_order), reason
        FROM judged_items""",
    "daily_sales": """
        SELECT product_id, CAST(order_date AS VARCHAR) AS order_date,
               CAST(sum(quantity) AS DOUBLE) AS quantity
        FROM r_items i JOIN r_orders o ON i.order_id = o.order_id
        GROUP BY product_id, o.order_date""",
    "complete_grid": """
        SELECT series, CAST(order_date AS VARCHAR) AS order_date,
               CAST(quantity AS DOUBLE) AS quantity
        FROM grid""",
    "calendar_features": f"""
        SELECT order_id, CAST(order_date AS VARCHAR) AS order_date, {CALENDAR} FROM r_orders""",
    "lag_features": """
        SELECT product_id, CAST(order_date AS VARCHAR) AS order_date,
               CAST(quantity AS DOUBLE) AS quantity, quantity_lag_1, quantity_lag_7
        FROM near_sales""",
    "rolling_features": """
        SELECT product_id, CAST(order_date AS VARCHAR) AS order_date,
               CAST(quantity AS DOUBLE) AS quantity, quantity_rolling_7
        FROM near_sales""",
    "build_features": f"""
        SELECT product_id, CAST(order_date AS VARCHAR) AS order_date,
               CAST(quantity AS DOUBLE) AS quantity, quantity_lag_1, quantity_lag_7,
               quantity_rolling_7, {CALENDAR}
        FROM reached""",
    "dense_features": f"""
        SELECT series, CAST(order_date AS VARCHAR) AS order_date,
               CAST(quantity AS DOUBLE) AS quantity, quantity_lag_1, quantity_lag_7,
               quantity_rolling_7, {CALENDAR}
        FROM lagged""",
    "finalize_features": f"""
        SELECT product_id, CAST(order_date AS VARCHAR) AS order_date,
               CAST(quantity AS DOUBLE) AS quantity, quantity_lag_1, quantity_lag_7,
               quantity_rolling_7, {CALENDAR}, rows_before, rows_after, rows_before - rows_after AS rows_dropped
        FROM (SELECT (SELECT count(*) FROM reached) AS rows_before,
                     (SELECT count(*) FROM reached
                      WHERE quantity_lag_1 IS NOT NULL AND quantity_lag_7 IS NOT NULL
                        AND quantity_rolling_7 IS NOT NULL) AS rows_after)
        LEFT JOIN (SELECT * FROM reached
                   WHERE quantity_lag_1 IS NOT NULL AND quantity_lag_7 IS NOT NULL
                     AND quantity_rolling_7 IS NOT NULL) ON true""",
    "chronological_split": """
        SELECT product_id, CAST(order_date AS VARCHAR) AS order_date, CAST(quantity AS DOUBLE) AS quantity,
               CASE WHEN order_date < (SELECT last_day - 46 FROM days) THEN 'train' ELSE 'test' END AS split
        FROM reached
        WHERE quantity_lag_1 IS NOT NULL AND quantity_lag_7 IS NOT NULL AND quantity_rolling_7 IS NOT NULL""",
    "leakage_checks": """
        SELECT 'date_overlap' AS check_name, (SELECT count(*) FROM near_train) AS rows_checked,
               CAST((SELECT max(order_date) FROM near_train)
                    >= (SELECT min(order_date) FROM near_complete WHERE order_date >= (SELECT last_day - 46 FROM days))
                    AS BIGINT) AS violations
        UNION ALL
        SELECT 'lag_1_is_previous_day', count(*),
               count(*) FILTER (abs(a.quantity_lag_1 - b.quantity) > 0.001)
        FROM near_train a JOIN product_days b
          ON a.product_id = b.product_id AND a.order_date = b.order_date + 1
        WHERE a.order_date > (SELECT min(order_date) FROM near_train)
        UNION ALL
        SELECT 'target_in_features', count(*), 0 FROM near_train""",
    "product_grid": """
        SELECT product_id, CAST(order_date AS VARCHAR) AS order_date, quantity, quantity_lag_1, quantity_lag_7,
               quantity_rolling_7, day_of_week, month, is_weekend, is_festival_season
        FROM panel_test""",
    "product_features": """
        SELECT product_id, count(*) AS days, sum(quantity) AS quantity, sum(lag_1) AS lag_1,
               sum(lag_7) AS lag_7, round(sum(rolling_7), 6) AS rolling_7,
               CAST(count(*) FILTER (isodow(order_date) >= 6) AS BIGINT) AS weekend_days
        FROM product_lagged WHERE lag_7 IS NOT NULL GROUP BY product_id""",
    "one_hot_products": """
        SELECT p_partkey AS product_id, p_brand AS level, CAST(1 AS INTEGER) AS flag FROM part""",
    "mean_baseline": _metrics("mean_baseline", "(SELECT avg(quantity) FROM train_rows)"),
    "naive_lag_baseline": _metrics("naive_lag_baseline", "quantity_lag_1"),
    "regression_metrics": _metrics("rolling_mean", "quantity_rolling_7"),
    "recent_state": "SELECT product_id, CAST(len(q) AS INTEGER) AS kept, "
    + ", ".join(f"q[{i}] AS q{i}" for i in range(1, 8))
    + " FROM state",
    "forecast_7d_rolling": """
        SELECT product_id, p_name AS product_name,
               CAST(CAST((SELECT last_day FROM days) + horizon AS DATE) AS VARCHAR) AS order_date,
               CAST(horizon AS INTEGER) AS horizon, prediction,
               round_even(prediction * 100, 0) / 100 AS predicted_quantity
        FROM steps JOIN part ON product_id = p_partkey WHERE horizon > 0""",
    "reorder_points": "SELECT * FROM next_day",
    "reorder_triggers": "SELECT * FROM triggered",
    "order_quantities": "SELECT * FROM sized",
    "erratic_flag": """
        SELECT product_id, zero_day_share, zero_day_share > 0.9875 AS erratic_demand_flag
        FROM erratic""",
    "inventory_report": """
        SELECT s.*, p_name AS product_name, zero_day_share > 0.9875 AS erratic_demand_flag,
               CASE WHEN needs_reorder THEN 'reorder' ELSE 'ok' END AS status,
               CASE WHEN needs_reorder AND zero_day_share > 0.9875
                    THEN 'erratic demand: review by hand' ELSE '' END AS review_note
        FROM sized s JOIN erratic e ON s.product_id = e.product_id
                     JOIN part ON s.product_id = p_partkey""",
    "inventory_sanity": """
        SELECT count(*) FILTER (predicted_daily_demand < 0) AS negative_demand,
               count(*) FILTER (recommended_order_qty < 0) AS negative_orders
        FROM sized""",
    "linear_regression": _metrics_of(
        "linear_regression",
        "(SELECT t.quantity, effect + "
        + " + ".join(f"a{i}_7 * {c}" for i, c in enumerate(X))
        + " AS p FROM panel_test t JOIN effect_of e ON t.product_id = e.product_id, gram7)",
    ),
    "linear_coefficients": " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(a{i}_7, 6) AS coefficient FROM gram7" for i, c in enumerate(X)
    ),
    "linear_effects": "SELECT product_id, round(effect, 6) AS effect FROM effect_of",
    "forecast_linear": """
        SELECT product_id, CAST(CAST((SELECT last_day FROM days) + horizon AS DATE) AS VARCHAR) AS order_date,
               CAST(horizon AS INTEGER) AS horizon, prediction,
               round_even(prediction * 100, 0) / 100 AS predicted_quantity
        FROM linear_steps WHERE horizon > 0""",
    "random_forest": """
        SELECT 'random_forest_best' AS model, count(*) AS rows, true AS finite, true AS beats_mean,
               true AS within_labels
        FROM test_rows""",
    "gradient_boosting": """
        SELECT 'gradient_boosting_default' AS model, count(*) AS rows, true AS finite,
               true AS beats_mean
        FROM test_rows""",
    "model_comparison": f"""
        SELECT model, rows, mae, rmse, CAST(NULL AS BOOLEAN) AS beats_mean
        FROM ({_metrics('mean_baseline', '(SELECT avg(quantity) FROM train_rows)')}
              UNION ALL {_metrics('naive_lag_baseline', 'quantity_lag_1')})
        UNION ALL
        SELECT m, (SELECT count(*) FROM test_rows), NULL, NULL, true
        FROM (VALUES ('linear_regression'), ('random_forest_default'), ('random_forest_best'),
                     ('gradient_boosting_default'), ('gradient_boosting_best')) AS t(m)""",
    "feature_importance": """
        SELECT f AS feature, true AS valid
        FROM (VALUES ('day_of_week'), ('month'), ('is_weekend'), ('is_festival_season'),
                     ('quantity_lag_1'), ('quantity_lag_7'), ('quantity_rolling_7'), ('sum')) AS t(f)
        UNION ALL SELECT DISTINCT concat('series_', p_brand), true FROM part""",
    "model_roundtrip": """
        SELECT count(*) AS rows, CAST(0 AS DOUBLE) AS largest_difference FROM test_rows""",
    "forecast_7d": """
        SELECT p_brand AS series,
               CAST(CAST((SELECT last_day FROM days) + CAST(h AS INTEGER) AS DATE) AS VARCHAR) AS order_date,
               CAST(h AS INTEGER) AS horizon, true AS in_range
        FROM (SELECT DISTINCT p_brand FROM part) b CROSS JOIN generate_series(1, 7) AS g(h)""",
    "expected_demand": """
        SELECT series, CAST(order_date AS VARCHAR) AS order_date,
               round(expected_quantity, 6) AS expected_quantity
        FROM designed""",
    "trend_ground_truth": f"""
        SELECT series, {PCT.format('e1', 'e4')} AS expected_pct,
               {PCT.format('m1', 'm4')} AS measured_pct,
               sign({PCT.format('e1', 'e4')}) = sign({PCT.format('m1', 'm4')}) AS same_direction
        FROM (SELECT d.series,
                     sum(CAST(expected_quantity AS DECIMAL(24,6))) FILTER (d.order_date < DATE '1997-04-01') AS e1,
                     sum(CAST(expected_quantity AS DECIMAL(24,6))) FILTER (d.order_date >= DATE '1997-10-01') AS e4,
                     sum(quantity) FILTER (d.order_date < DATE '1997-04-01') AS m1,
                     sum(quantity) FILTER (d.order_date >= DATE '1997-10-01') AS m4
              FROM designed d JOIN grid g ON d.series = g.series AND d.order_date = g.order_date
              GROUP BY d.series)""",
    "proportional_allocation": """
        SELECT order_id, product_id, CAST(weight AS DOUBLE) AS weight,
               CAST(c AS DOUBLE) / 100 AS allocated, c <= 0 AS non_positive
        FROM (SELECT order_id, product_id, weight,
                     CASE WHEN product_id = max(product_id) OVER g
                          THEN t - sum(share) OVER g + share ELSE share END AS c
              FROM (SELECT *, (2 * t * w + w_sum) // (2 * w_sum) AS share FROM alloc_units)
              WINDOW g AS (PARTITION BY order_id))""",
    "proportional_allocation_remainder": """
        SELECT order_id, product_id, CAST(weight AS DOUBLE) AS weight,
               CAST(c AS DOUBLE) / 100 AS allocated, c <= 0 AS non_positive
        FROM (SELECT order_id, product_id, weight,
                     share + CASE WHEN row_number() OVER (
                                       PARTITION BY order_id
                                       ORDER BY remainder DESC, w DESC, product_id)
                                       <= t - sum(share) OVER (PARTITION BY order_id)
                                  THEN 1 ELSE 0 END AS c
              FROM (SELECT *, (t * w) // w_sum AS share, (t * w) % w_sum AS remainder
                    FROM alloc_units))""",
    "allocation_rejects": """
        SELECT order_id, CAST(total AS DOUBLE) AS total,
               CASE WHEN total <= 0 THEN 'total is not positive' ELSE 'no parts' END AS reason
        FROM alloc_totals t
        WHERE total <= 0
           OR NOT EXISTS (SELECT 1 FROM alloc_parts p WHERE p.order_id = t.order_id)""",
    "assemble_baskets": """
        SELECT CAST(order_date AS VARCHAR) AS order_date, product_id, order_id, line_no,
               CAST(quantity AS DOUBLE) AS quantity,
               CAST(unit_price_at_order AS DOUBLE) AS unit_price_at_order, basket_no,
               CAST(basket_line AS INTEGER) AS basket_line
        FROM numbered""",
    "flatten_orders": """
        SELECT concat(CAST(order_date AS VARCHAR), '/', basket_no) AS order_id,
               CAST(basket_line AS INTEGER) AS basket_line, product_id,
               CAST(quantity AS DOUBLE) AS quantity,
               concat(CAST(order_date AS VARCHAR), '/', basket_no, '/', basket_line)
                   AS order_item_id
        FROM numbered""",
    "exact_sample": """
        SELECT order_id, customer_id, CAST(order_date AS VARCHAR) AS order_date FROM sampled_3""",
    "append_copies": """
        SELECT order_id, count(*) AS copies
        FROM (SELECT order_id FROM r_orders UNION ALL SELECT order_id FROM sampled_2)
        GROUP BY order_id""",
}


def _needed(text: str, found: list[str]) -> list[str]:
    """Views named in the text, each after those it builds on."""
    words = set(re.findall(r"[a-z_0-9]+", text))
    for name in VIEWS:
        if name in words and name not in found:
            inner = re.sub(rf"\b{name}\b", "", VIEWS[name])
            _needed(inner, found)
            found.append(name)
    return found


def oracle(name: str) -> str:
    """Full text of one oracle: the views it needs, then its body."""
    body = BODIES[name]
    views = _needed(body, [])
    if not views:
        return body
    listed = ",\n".join(
        f"{v} AS ({VIEWS[v]})" if v in RECURSIVE else f"{v} AS MATERIALIZED ({VIEWS[v]})"
        for v in views
    )
    head = "WITH RECURSIVE" if RECURSIVE.intersection(views) else "WITH"
    return f"{head} {listed}\nSELECT * FROM ({body})"


def all_oracles() -> dict[str, str]:
    return {name: oracle(name) for name in BODIES}
