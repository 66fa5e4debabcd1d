"""The same queries as plain SQL, for a second engine to cross-check the results.

Written from the definitions, not from the Spark plans: range joins, correlated subqueries and
distinct counts appear here where the operators avoid them.  Source tables are expected under
their own names; the retail tables are common table expressions with the prefix `r_`,
intermediate results have the prefix `t_`, and each statement carries only those it uses.
"""

from __future__ import annotations

import re

FOCUS = "NATION_0"


def half_up(value: str, digits: int) -> str:
    return f"CAST(ROUND(CAST(CAST(CAST({value} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def money(total: str) -> str:
    return f"CAST(ROUND({total}, 2) AS DOUBLE)"


def ratio(part: str, whole: str) -> str:
    return f"(CAST({part} AS DOUBLE) / NULLIF(CAST({whole} AS DOUBLE), 0))"


def percent(part: str, whole: str) -> str:
    return half_up(ratio(f"100.0 * ({part})", whole), 1)


def ratio0(part: str, whole: str, digits: int) -> str:
    return half_up(f"COALESCE({ratio(part, whole)}, 0)", digits)


def big(value: str) -> str:
    return f"CAST(COALESCE({value}, 0) AS BIGINT)"


def months_between(lo: str, hi: str) -> str:
    """Rows (month) from lo to hi; lo and hi are scalar DATE expressions."""
    return f"""SELECT CAST(u.m AS DATE) AS month FROM (SELECT unnest(generate_series(
        CAST(date_trunc('month', {lo}) AS TIMESTAMP), CAST(date_trunc('month', {hi}) AS TIMESTAMP), INTERVAL 1 MONTH)) AS m) u"""


REGRESSORS = ["previous_month_revenue", "m3", "m6", "month_number", "quarter", "growth"]
WEIGHTED = [
    "previous_month_revenue", "previous_3_month_avg_revenue", "previous_6_month_avg_revenue", "month_number", "quarter",
    "revenue_growth_rate",
]


def over_train(aggregate: str) -> str:
    return f"({aggregate} FILTER (WHERE kind = 'train') OVER (PARTITION BY series_id))"


def orthogonal_step(i: int) -> str:
    """Take column i as a direction: fit it, and make the columns after it orthogonal to it."""
    usable = f"{over_train(f'SUM(x{i} * x{i})')} > 1e-9 * v{i}"
    along = lambda c: f"CASE WHEN {usable} THEN x{i} * {over_train(f'SUM({c} * x{i})')} / {over_train(f'SUM(x{i} * x{i})')} ELSE 0 END"
    rest = "".join(f", x{j} - {along(f'x{j}')} AS x{j}, v{j}" for j in range(i + 1, 6))
    return f"SELECT series_id, month, kind, p + {along('y')} AS p, y - {along('y')} AS y{rest} FROM t_step{i}"


MONTH = "CAST(date_trunc('month', {}) AS DATE)".format
AS_OF = "(SELECT MAX(order_date) FROM r_headers)"
LAST_MONTH = f"CAST({MONTH(AS_OF)} - INTERVAL 1 MONTH AS DATE)"

CTES: dict[str, str] = {
    # --- the mapping of the source tables ---------------------------------------------------
    "r_customers": """
        SELECT c_custkey AS customer_id, c_name AS customer_name, lower(c_name) || '@example.com' AS email,
               n_name AS city, c_mktsegment AS segment,
               CAST(DATE '1995-01-01' + CAST(c_custkey * 37 % 2000 AS INT) AS DATE) AS signup_date
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "r_stores": """
        SELECT CAST(n_nationkey * 2 + k AS BIGINT) AS store_id, n_name || ' Store ' || CAST(k AS VARCHAR) AS store_name,
               n_name AS city, r_name AS region, DATE '1994-01-01' AS open_date
        FROM nation JOIN region ON n_regionkey = r_regionkey CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 AS k) x""",
    "r_products": """
        SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
               CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price,
               CAST(FLOOR(p_retailprice * 60) / 100 AS DECIMAL(10,2)) AS unit_cost
        FROM part""",
    "r_headers": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 'online' ELSE 'in_store' END AS channel,
               CASE WHEN o_orderstatus = 'P' THEN 'cancelled' ELSE 'completed' END AS order_status
        FROM orders""",
    "r_orders": """
        SELECT h.order_id, h.customer_id, CAST(c_nationkey * 2 + h.order_id % 2 AS BIGINT) AS store_id,
               h.order_date, h.channel, h.order_status
        FROM r_headers h LEFT JOIN customer ON h.customer_id = c_custkey""",
    "r_items": """
        SELECT (l_orderkey * 134217728 + l_partkey) * 8 + l_linenumber AS order_item_id, l_orderkey AS order_id,
               l_partkey AS product_id, CAST(l_quantity AS BIGINT) AS quantity,
               CAST(FLOOR(l_extendedprice * (1 - l_discount) / l_quantity * 100 + 0.5) / 100 AS DECIMAL(10,2)) AS unit_price,
               CAST(l_discount AS DECIMAL(4,2)) AS discount_pct,
               CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (CAST(1 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2)))
                    AS DECIMAL(18,4)) AS line_total
        FROM lineitem""",
    "r_returns": """
        SELECT (l_orderkey * 134217728 + l_partkey) * 8 + l_linenumber AS return_id, l_orderkey AS order_id,
               l_partkey AS product_id,
               CAST(CAST(o_orderdate AS DATE) + CAST(l_linenumber * 3 % 13 + 1 AS INT) AS DATE) AS return_date,
               l_linestatus AS return_reason
        FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'""",
    "r_inventory": """
        SELECT CAST(l_suppkey % 50 AS BIGINT) AS store_id, l_partkey AS product_id,
               CAST(date_trunc('month', l_shipdate) AS DATE) AS snapshot_date,
               CAST(CAST(SUM(l_quantity) AS BIGINT) % 40 AS BIGINT) AS stock_level, CAST(8 AS BIGINT) AS reorder_level
        FROM lineitem GROUP BY 1, 2, 3""",
    "r_campaigns": """
        SELECT p_partkey AS campaign_id, p_name AS campaign_name, n_name AS city_target, p_brand AS channel,
               CAST(DATE '1995-01-01' + CAST(p_partkey * 79 % 2300 AS INT) AS DATE) AS start_date,
               CAST(DATE '1995-01-01' + CAST(p_partkey * 79 % 2300 + 14 + p_size AS INT) AS DATE) AS end_date,
               CAST(p_retailprice * 10 AS DECIMAL(12,2)) AS budget, CAST(p_retailprice * 9 AS DECIMAL(12,2)) AS spend
        FROM part LEFT JOIN nation ON p_partkey % 25 = n_nationkey""",
    # --- views ---------------------------------------------------------------------------------
    "t_completed": "SELECT * FROM r_orders WHERE order_status = 'completed'",
    "t_sold": """
        SELECT o.order_id, o.customer_id, o.store_id, o.order_date, i.product_id, i.quantity, i.unit_price,
               i.discount_pct, i.line_total
        FROM t_completed o JOIN r_items i ON i.order_id = o.order_id""",
    "t_revenue": f"""
        SELECT s.city, {MONTH("o.order_date")} AS month, COUNT(DISTINCT o.order_id) AS order_count,
               {money("SUM(o.line_total)")} AS revenue
        FROM t_sold o JOIN r_stores s ON s.store_id = o.store_id GROUP BY 1, 2""",
    "t_trend": f"""
        SELECT month, order_count, revenue, lag(revenue) OVER (ORDER BY month) AS prev_month_revenue,
               {percent("revenue - lag(revenue) OVER (ORDER BY month)", "lag(revenue) OVER (ORDER BY month)")} AS mom_pct_change
        FROM t_revenue WHERE city = '{FOCUS}'""",
    "t_spend": f"""
        SELECT city_target AS city, {MONTH("start_date")} AS month, COUNT(*) AS campaign_count,
               {money("SUM(budget)")} AS total_budget, {money("SUM(spend)")} AS total_spend
        FROM r_campaigns GROUP BY 1, 2""",
    "t_return_rate": f"""
        SELECT s.city, {MONTH("o.order_date")} AS month, COUNT(DISTINCT o.order_id) AS order_count,
               COUNT(DISTINCT r.return_id) AS return_count,
               {percent("COUNT(DISTINCT r.return_id)", "COUNT(DISTINCT o.order_id)")} AS return_rate_pct
        FROM t_completed o JOIN r_stores s ON s.store_id = o.store_id LEFT JOIN r_returns r ON r.order_id = o.order_id
        GROUP BY 1, 2""",
    "t_mix": f"""
        SELECT city, month, category, {money("total")} AS revenue,
               {percent("total", "SUM(total) OVER (PARTITION BY city, month)")} AS pct_of_city_month_revenue
        FROM (SELECT s.city, {MONTH("o.order_date")} AS month, p.category, SUM(o.line_total) AS total
              FROM t_sold o JOIN r_products p ON p.product_id = o.product_id JOIN r_stores s ON s.store_id = o.store_id
              GROUP BY 1, 2, 3) g""",
    "t_city_orders": f"""
        SELECT o.order_id, o.customer_id, s.city, {MONTH("o.order_date")} AS month
        FROM t_completed o JOIN r_stores s ON s.store_id = o.store_id""",
    "t_focus_active": f"SELECT DISTINCT customer_id, month FROM t_city_orders WHERE city = '{FOCUS}'",
    "t_focus_marked": """
        SELECT a.month, EXISTS (SELECT 1 FROM t_focus_active b WHERE b.customer_id = a.customer_id
                                AND b.month + INTERVAL 1 MONTH = a.month) AS came_back
        FROM t_focus_active a""",
    "t_focus_months": """
        SELECT month, COUNT(*) AS active, SUM(CAST(came_back AS BIGINT)) AS retained FROM t_focus_marked GROUP BY month""",
    "t_retention": """
        SELECT now.month, now.active, COALESCE(before.active, 0) AS prior, CAST(now.retained AS BIGINT) AS retained
        FROM t_focus_months now LEFT JOIN t_focus_months before ON before.month + INTERVAL 1 MONTH = now.month""",
    # --- analytics tables ------------------------------------------------------------------------
    "t_customer_summary": f"""
        SELECT c.customer_id, c.signup_date, o.first_order_date, o.last_order_date, {big("o.n")} AS total_orders,
               {big("i.units")} AS total_items, {money("COALESCE(i.total, 0)")} AS total_spent,
               {ratio0("i.total", "o.n", 2)} AS average_order_value,
               CAST({AS_OF} - o.last_order_date AS INTEGER) AS days_since_last_purchase,
               CAST({AS_OF} - c.signup_date AS INTEGER) AS lifetime_days,
               COALESCE({AS_OF} - o.last_order_date <= 90, FALSE) AS is_active
        FROM r_customers c
        LEFT JOIN (SELECT customer_id, MIN(order_date) AS first_order_date, MAX(order_date) AS last_order_date,
                          COUNT(DISTINCT order_id) AS n FROM t_completed GROUP BY 1) o ON o.customer_id = c.customer_id
        LEFT JOIN (SELECT customer_id, SUM(quantity) AS units, SUM(line_total) AS total FROM t_sold GROUP BY 1) i
               ON i.customer_id = c.customer_id""",
    "t_days": """
        SELECT CAST(u.d AS DATE) AS date FROM (SELECT unnest(generate_series(
            CAST((SELECT MIN(order_date) FROM r_headers) AS TIMESTAMP),
            CAST((SELECT MAX(order_date) FROM r_headers) AS TIMESTAMP), INTERVAL 1 DAY)) AS d) u""",
    "t_daily_sales": f"""
        SELECT d.date, s.store_id, s.city, {big("o.orders")} AS orders, {big("o.customers")} AS customers,
               {big("i.units")} AS units_sold, {money("COALESCE(i.total, 0)")} AS revenue,
               {ratio0("i.total", "o.orders", 2)} AS average_order_value, {big("x.n")} AS cancelled_orders
        FROM t_days d CROSS JOIN r_stores s
        LEFT JOIN (SELECT order_date, store_id, COUNT(DISTINCT order_id) AS orders, COUNT(DISTINCT customer_id) AS customers
                   FROM t_completed GROUP BY 1, 2) o ON o.order_date = d.date AND o.store_id = s.store_id
        LEFT JOIN (SELECT order_date, store_id, SUM(quantity) AS units, SUM(line_total) AS total
                   FROM t_sold GROUP BY 1, 2) i ON i.order_date = d.date AND i.store_id = s.store_id
        LEFT JOIN (SELECT order_date, store_id, COUNT(*) AS n FROM r_orders WHERE order_status = 'cancelled'
                   GROUP BY 1, 2) x ON x.order_date = d.date AND x.store_id = s.store_id""",
    "t_monthly_sales": f"""
        SELECT strftime(d.month, '%Y-%m') AS month, {big("d.orders")} AS orders, {big("c.customers")} AS customers,
               {big("d.units")} AS units_sold, {money("d.total")} AS revenue,
               {ratio0("d.total", "d.orders", 2)} AS average_order_value
        FROM (SELECT {MONTH("date")} AS month, SUM(orders) AS orders, SUM(units_sold) AS units,
                     SUM(CAST(revenue AS DECIMAL(18,2))) AS total FROM t_daily_sales GROUP BY 1) d
        LEFT JOIN (SELECT {MONTH("order_date")} AS month, COUNT(DISTINCT customer_id) AS customers
                   FROM t_completed GROUP BY 1) c ON c.month = d.month
        WHERE d.month <> {MONTH(AS_OF)}""",
    "t_product_performance": f"""
        SELECT p.product_id, p.product_name, p.category, {big("s.units")} AS units_sold,
               {money("COALESCE(s.total, 0)")} AS revenue, {half_up("COALESCE(s.discount, 0)", 4)} AS average_discount,
               {half_up("s.price", 2)} AS average_price, {ratio0("r.n", "s.units", 4)} AS return_rate
        FROM r_products p
        LEFT JOIN (SELECT product_id, SUM(quantity) AS units, SUM(line_total) AS total,
                          {ratio("SUM(unit_price)", "COUNT(*)")} AS price,
                          {ratio("SUM(discount_pct) FILTER (WHERE discount_pct > 1e-6)",
                                 "COUNT(*) FILTER (WHERE discount_pct > 1e-6)")} AS discount
                   FROM t_sold GROUP BY 1) s ON s.product_id = p.product_id
        LEFT JOIN (SELECT product_id, COUNT(*) AS n FROM r_returns GROUP BY 1) r ON r.product_id = p.product_id""",
    "t_months": months_between("(SELECT MIN(order_date) FROM r_headers)", LAST_MONTH),
    "t_product_months": f"""
        SELECT m.month AS month_date, strftime(m.month, '%Y-%m') AS month, p.product_id, p.product_name, p.category,
               {big("s.units")} AS units_sold, {money("COALESCE(s.total, 0)")} AS revenue,
               {half_up("s.price", 2)} AS average_price, {half_up("s.discount", 4)} AS average_discount,
               {big("r.n")} AS returns, {ratio0("r.n", "s.units", 4)} AS return_rate
        FROM r_products p CROSS JOIN t_months m
        LEFT JOIN (SELECT product_id, {MONTH("order_date")} AS month, SUM(quantity) AS units, SUM(line_total) AS total,
                          {ratio("SUM(unit_price)", "COUNT(*)")} AS price,
                          {ratio("SUM(discount_pct) FILTER (WHERE discount_pct > 1e-6)",
                                 "COUNT(*) FILTER (WHERE discount_pct > 1e-6)")} AS discount
                   FROM t_sold GROUP BY 1, 2) s ON s.product_id = p.product_id AND s.month = m.month
        LEFT JOIN (SELECT product_id, {MONTH("return_date")} AS month, COUNT(*) AS n FROM r_returns GROUP BY 1, 2) r
               ON r.product_id = p.product_id AND r.month = m.month""",
    "t_store_performance": f"""
        SELECT s.store_id, s.city, {big("o.orders")} AS orders, {big("o.customers")} AS customers,
               {money("COALESCE(i.total, 0)")} AS revenue, {ratio0("i.total", "o.orders", 2)} AS average_order_value,
               {ratio0("r.n", "o.orders", 4)} AS return_rate
        FROM r_stores s
        LEFT JOIN (SELECT store_id, COUNT(DISTINCT order_id) AS orders, COUNT(DISTINCT customer_id) AS customers
                   FROM t_completed GROUP BY 1) o ON o.store_id = s.store_id
        LEFT JOIN (SELECT store_id, SUM(line_total) AS total FROM t_sold GROUP BY 1) i ON i.store_id = s.store_id
        LEFT JOIN (SELECT q.store_id, COUNT(DISTINCT q.order_id) AS n FROM r_returns b JOIN r_orders q
                   ON q.order_id = b.order_id GROUP BY 1) r ON r.store_id = s.store_id""",
    "t_inventory_base": f"""
        SELECT p.product_id, p.product_name, {big("k.stock")} AS current_stock, {big("u.units")} AS units_sold_last_30_days
        FROM r_products p
        LEFT JOIN (SELECT product_id, SUM(stock_level) AS stock FROM r_inventory
                   WHERE snapshot_date = (SELECT MAX(snapshot_date) FROM r_inventory) GROUP BY 1) k
               ON k.product_id = p.product_id
        LEFT JOIN (SELECT product_id, SUM(quantity) AS units FROM t_sold
                   WHERE order_date > {AS_OF} - 30 GROUP BY 1) u ON u.product_id = p.product_id""",
    "t_inventory_health": f"""
        SELECT *, CASE WHEN current_stock = 0 THEN 'Critical' WHEN estimated_days_to_stockout IS NULL THEN 'Low'
                       WHEN estimated_days_to_stockout <= 7 THEN 'Critical' WHEN estimated_days_to_stockout <= 14 THEN 'High'
                       WHEN estimated_days_to_stockout <= 30 THEN 'Medium' ELSE 'Low' END AS risk_level
        FROM (SELECT *, {half_up("current_stock / NULLIF(units_sold_last_30_days / 30.0::DOUBLE, 0)", 1)}
                     AS estimated_days_to_stockout FROM t_inventory_base) b""",
    "t_city_days": """
        SELECT s.city, o.order_date, COUNT(DISTINCT o.order_id) AS orders, SUM(v.total) AS total
        FROM t_completed o JOIN r_stores s ON s.store_id = o.store_id
        LEFT JOIN (SELECT order_id, SUM(line_total) AS total FROM r_items GROUP BY 1) v ON v.order_id = o.order_id
        GROUP BY 1, 2""",
    "t_marketing": f"""
        SELECT *, {ratio0("revenue_generated - marketing_spend", "marketing_spend", 3)} AS roi
        FROM (SELECT c.campaign_id, c.campaign_name, c.city_target AS city, c.start_date, c.end_date,
                     CAST(c.spend AS DOUBLE) AS marketing_spend, {big("SUM(d.orders)")} AS orders_generated,
                     {money("COALESCE(SUM(d.total), 0)")} AS revenue_generated
              FROM r_campaigns c LEFT JOIN t_city_days d ON d.city = c.city_target
                   AND d.order_date BETWEEN c.start_date AND c.end_date
              GROUP BY c.campaign_id, c.campaign_name, c.city_target, c.start_date, c.end_date, c.spend) g""",
    "t_returns_summary": f"""
        SELECT p.product_id, p.category, {big("r.n")} AS returns, {big("s.units")} AS units_sold,
               {ratio0("r.n", "s.units", 4)} AS return_rate
        FROM r_products p
        LEFT JOIN (SELECT product_id, COUNT(*) AS n FROM r_returns GROUP BY 1) r ON r.product_id = p.product_id
        LEFT JOIN (SELECT product_id, SUM(quantity) AS units FROM t_sold GROUP BY 1) s ON s.product_id = p.product_id""",
    # --- feature tables ----------------------------------------------------------------------------
    "t_forecasting_raw": """
        SELECT *, CAST(month || '-01' AS DATE) AS d, lag(revenue, 1) OVER o AS lag_1_revenue,
               lag(revenue, 2) OVER o AS lag_2_revenue, lag(revenue, 3) OVER o AS lag_3_revenue,
               CASE WHEN COUNT(revenue) OVER w3 = 3 THEN AVG(revenue) OVER w3 END AS m3,
               CASE WHEN COUNT(revenue) OVER w6 = 6 THEN AVG(revenue) OVER w6 END AS m6,
               CASE WHEN COUNT(revenue) OVER w3 = 3 THEN stddev_samp(revenue) OVER w3 END AS s3
        FROM t_monthly_sales
        WINDOW o AS (ORDER BY month), w3 AS (ORDER BY month ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING),
               w6 AS (ORDER BY month ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING)""",
    "t_forecasting": f"""
        SELECT month, revenue, orders, customers, units_sold, lag_1_revenue, lag_2_revenue, lag_3_revenue,
               {half_up("m3", 4)} AS rolling_mean_3, {half_up("m6", 4)} AS rolling_mean_6,
               {half_up("s3", 4)} AS rolling_std_3,
               {half_up(ratio("lag_1_revenue - lag_2_revenue", "lag_2_revenue"), 4)} AS revenue_growth_rate,
               CAST(month(d) AS INTEGER) AS month_number, CAST(quarter(d) AS INTEGER) AS quarter,
               CAST(year(d) AS INTEGER) AS year, {half_up("m3 - m6", 4)} AS moving_average_difference,
               {half_up(ratio("revenue", "AVG(revenue) OVER (PARTITION BY month(d))"), 4)} AS seasonal_index
        FROM t_forecasting_raw""",
    "t_customer_features": f"""
        SELECT customer_id, total_orders, total_spent, average_order_value, total_items, first_order_date, last_order_date,
               lifetime_days AS customer_lifetime_days, days_since_last_purchase,
               {half_up(ratio("total_orders", "lifetime_days / 30.0::DOUBLE"), 4)} AS purchase_frequency,
               {half_up(ratio("last_order_date - first_order_date", "total_orders - 1"), 2)} AS average_days_between_orders,
               days_since_last_purchase AS recency, total_orders AS frequency, total_spent AS monetary, is_active
        FROM t_customer_summary""",
    "t_product_features": f"""
        SELECT p.product_id, p.category, p.units_sold, p.revenue, p.average_discount, p.average_price, p.return_rate,
               h.units_sold_last_30_days AS sales_last_30_days, CAST(g.q AS BIGINT) AS sales_last_90_days,
               {half_up(ratio("g.u - g.v", "g.v"), 4)} AS rolling_sales_growth,
               CAST(NULL AS VARCHAR) AS product_features_gap
        FROM t_product_performance p JOIN t_inventory_base h ON h.product_id = p.product_id
        LEFT JOIN (SELECT product_id, month_date,
                          SUM(units_sold) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS q,
                          units_sold AS u, lag(units_sold) OVER w AS v
                   FROM t_product_months WINDOW w AS (PARTITION BY product_id ORDER BY month_date)) g
               ON g.product_id = p.product_id AND g.month_date = {LAST_MONTH}""",
    "t_store_months": f"""
        SELECT store_id, {MONTH("date")} AS month, SUM(CAST(revenue AS DECIMAL(18,2))) AS revenue,
               SUM(customers) AS customers FROM t_daily_sales GROUP BY 1, 2""",
    "t_store_features": f"""
        SELECT p.store_id, p.city, p.orders, p.customers, p.revenue, p.average_order_value, p.return_rate,
               a.average_daily_sales, {half_up(ratio("b.revenue - f.revenue", "f.revenue"), 4)} AS sales_growth,
               {half_up(ratio("b.customers - f.customers", "f.customers"), 4)} AS customer_growth
        FROM t_store_performance p
        LEFT JOIN (SELECT store_id, {half_up(ratio("SUM(CAST(revenue AS DECIMAL(18,2)))", "COUNT(*)"), 2)}
                          AS average_daily_sales FROM t_daily_sales GROUP BY 1) a ON a.store_id = p.store_id
        LEFT JOIN t_store_months b ON b.store_id = p.store_id AND b.month = {LAST_MONTH}
        LEFT JOIN t_store_months f ON f.store_id = p.store_id AND f.month = CAST({LAST_MONTH} - INTERVAL 1 MONTH AS DATE)""",
    # --- forecasts ------------------------------------------------------------------------------------
    "t_series": "SELECT city AS series_id, month, order_count AS orders, revenue FROM t_revenue",
    "t_guarded": """
        SELECT s.series_id, s.month, s.orders, s.revenue FROM t_series s
        JOIN (SELECT series_id, MAX(month) AS last_month FROM t_series GROUP BY 1) l ON l.series_id = s.series_id
        LEFT JOIN (SELECT series_id, AVG(orders) AS typical
                   FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY month DESC) AS k FROM t_series) n
                   WHERE k BETWEEN 2 AND 7 GROUP BY 1) t ON t.series_id = s.series_id
        WHERE NOT (s.month = l.last_month AND COALESCE(s.orders < 0.5 * t.typical, FALSE))""",
    "t_features": f"""
        SELECT series_id, month, orders, revenue, l1 AS previous_month_revenue, m3, m6,
               CAST(month(month) AS INTEGER) AS month_number, CAST(quarter(month) AS INTEGER) AS quarter,
               {ratio("l1 - l2", "l2")} AS growth
        FROM (SELECT *, lag(revenue, 1) OVER w AS l1, lag(revenue, 2) OVER w AS l2,
                     AVG(revenue) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS m3,
                     AVG(revenue) OVER (w ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS m6,
                     row_number() OVER w AS position
              FROM t_guarded WINDOW w AS (PARTITION BY series_id ORDER BY month)) x
        WHERE position > 6 AND l2 <> 0""",
    "t_split": """
        SELECT *, CASE WHEN row_number() OVER (PARTITION BY series_id ORDER BY month DESC) <= 3 THEN 'test' ELSE 'train' END
               AS split FROM t_features""",
    "t_probed": f"""
        SELECT series_id, month, split AS kind, revenue AS y, {", ".join(f"CAST({c} AS DOUBLE) AS x{i}" for i, c in enumerate(REGRESSORS))}
        FROM t_split
        UNION ALL
        SELECT series_id, NULL, 'probe' || CAST(k AS VARCHAR), NULL, {", ".join(f"CAST(k = {i + 1} AS DOUBLE)" for i in range(6))}
        FROM (SELECT DISTINCT series_id FROM t_split) s, range(7) r(k)""",
    "t_step0": f"""
        SELECT series_id, month, kind, {over_train("AVG(y)")} AS p, y - {over_train("AVG(y)")} AS y, {", ".join(f"x{i} - {over_train(f'AVG(x{i})')} AS x{i}" for i in range(6))},
               {", ".join(f"{over_train(f'VAR_POP(x{i})')} * {over_train('COUNT(*)')} AS v{i}" for i in range(6))} FROM t_probed""",
    **{f"t_step{i + 1}": orthogonal_step(i) for i in range(6)},
    "t_linear": "SELECT series_id, month, kind, p AS predicted FROM t_step6",
    "t_predicted": """
        SELECT series_id, 0 AS rank, 'naive' AS model, revenue AS actual, previous_month_revenue AS predicted
        FROM t_split WHERE split = 'test'
        UNION ALL
        SELECT series_id, 1, 'rolling_avg', revenue, m3 FROM t_split WHERE split = 'test'
        UNION ALL
        SELECT s.series_id, 2, 'linear_regression', s.revenue, l.predicted FROM t_split s
        JOIN t_linear l ON l.series_id = s.series_id AND l.month = s.month AND l.kind = 'test'""",
    "t_metrics": f"""
        SELECT series_id, rank, model, {half_up("AVG(abs(actual - predicted))", 2)} AS mae,
               {half_up("sqrt(AVG((actual - predicted) * (actual - predicted)))", 2)} AS rmse,
               {half_up("AVG(" + ratio("abs(actual - predicted)", "abs(actual)") + ") * 100", 2)} AS mape_pct
        FROM t_predicted GROUP BY 1, 2, 3""",
    "t_kpis": """
        SELECT k.kpi, k.current, k.previous, k.rn FROM (
          SELECT kpi, value AS current, lag(value) OVER (PARTITION BY kpi ORDER BY month) AS previous,
                 row_number() OVER (PARTITION BY kpi ORDER BY month DESC) AS rn
          FROM (SELECT month, 'revenue' AS kpi, revenue AS value FROM t_monthly_sales
                UNION ALL SELECT month, 'orders', CAST(orders AS DOUBLE) FROM t_monthly_sales
                UNION ALL SELECT month, 'customers', CAST(customers AS DOUBLE) FROM t_monthly_sales
                UNION ALL SELECT month, 'average_order_value', average_order_value FROM t_monthly_sales) v) k
        WHERE k.rn = 1""",
    "t_kpi_changes": f"""
        SELECT kpi, current, previous, {half_up(ratio("100.0 * (current - previous)", "previous"), 4)} AS change_pct
        FROM t_kpis""",
    # --- anomaly -------------------------------------------------------------------------------------
    "t_city_month_total": f"""
        SELECT s.city, {MONTH("o.order_date")} AS month, CAST(SUM(o.line_total) AS DOUBLE) AS revenue
        FROM t_sold o JOIN r_stores s ON s.store_id = o.store_id GROUP BY 1, 2""",
    "t_full_months": """
        SELECT DISTINCT month FROM t_city_month_total WHERE month < (SELECT MAX(month) FROM t_city_month_total)""",
    "t_pre_months": f"""
        SELECT month FROM t_full_months WHERE month < CAST({MONTH(AS_OF)} - INTERVAL 1 MONTH AS DATE)
        ORDER BY month DESC LIMIT 3""",
    "t_changes": f"""
        SELECT city, pre, post, (post - pre) / NULLIF(pre, 0) AS change
        FROM (SELECT city, AVG(revenue) FILTER (WHERE month IN (SELECT month FROM t_pre_months)) AS pre,
                     AVG(revenue) FILTER (WHERE month IN (SELECT month FROM t_full_months)
                         AND month >= CAST({MONTH(AS_OF)} - INTERVAL 1 MONTH AS DATE)) AS post
              FROM t_city_month_total GROUP BY 1) g
        WHERE pre IS NOT NULL OR post IS NOT NULL""",
}

_NAME = re.compile(r"\b[rt]_[a-z0-9_]+\b")


def statement(body: str) -> str:
    """The body, preceded by the common table expressions it needs."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in _NAME.findall(text):
            if name in CTES and name not in needed:
                needed.add(name)
                visit(CTES[name])

    visit(body)
    ctes = ",\n".join(f"{name} AS ({CTES[name].strip()})" for name in CTES if name in needed)
    return f"WITH {ctes}\n{body.strip()}" if ctes else body.strip()


# --- data-quality checks ---------------------------------------------------------------------------

TABLES = {
    "customers": ("r_customers", ["customer_id"],
                  ["customer_id", "customer_name", "email", "city", "segment", "signup_date"]),
    "stores": ("r_stores", ["store_id"], ["store_id", "store_name", "city", "region", "open_date"]),
    "products": ("r_products", ["product_id"], ["product_id", "product_name", "category", "unit_price", "unit_cost"]),
    "orders": ("r_orders", ["order_id"],
               ["order_id", "customer_id", "store_id", "order_date", "channel", "order_status"]),
    "order_items": ("r_items", ["order_item_id"],
                    ["order_item_id", "order_id", "product_id", "quantity", "unit_price", "discount_pct", "line_total"]),
    "inventory": ("r_inventory", ["store_id", "product_id", "snapshot_date"],
                  ["store_id", "product_id", "snapshot_date", "stock_level", "reorder_level"]),
    "returns": ("r_returns", ["return_id"], ["return_id", "order_id", "product_id", "return_date", "return_reason"]),
    "marketing_campaigns": ("r_campaigns", ["campaign_id"],
                            ["campaign_id", "campaign_name", "city_target", "channel", "start_date", "end_date",
                             "budget", "spend"]),
}


def check(category: str, name: str, count: str, what: str) -> str:
    """One check row; `count` is a query for the number of offenders."""
    return (
        f"SELECT '{category}' AS category, '{name}' AS \"check\", CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS status, "
        f"CAST(n AS VARCHAR) || ' {what}' AS detail FROM (SELECT CAST(({count}) AS BIGINT) AS n) v"
    )


def union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def surplus(table: str, columns: list[str]) -> str:
    listed = ", ".join(columns)
    return f"SELECT (SELECT COUNT(*) FROM {table}) - (SELECT COUNT(*) FROM (SELECT DISTINCT {listed} FROM {table}) d)"


def any_null(columns: list[str]) -> str:
    return " OR ".join(f"{c} IS NULL" for c in columns)


KEY_CHECKS = [
    part
    for table, (relation, key, _) in TABLES.items()
    for part in (
        check("Primary key uniqueness", f"{table}.{'+'.join(key)} has no nulls",
              f"SELECT COUNT(*) FROM {relation} WHERE {any_null(key)}", "nulls"),
        check("Primary key uniqueness", f"{table}.{'+'.join(key)} is unique", surplus(relation, key), "duplicate values"),
    )
]
DUPLICATE_CHECKS = [
    *[
        check("Duplicate detection", f"{table} has no exact duplicate rows", surplus(relation, columns), "duplicate rows")
        for table, (relation, _, columns) in TABLES.items()
    ],
    check("Duplicate detection", "order_items has no repeated (order_id, product_id) pairs",
          surplus("r_items", ["order_id", "product_id"]), "repeated pairs"),
    check("Duplicate detection", "customers.email is unique", surplus("r_customers", ["email"]), "duplicate emails"),
]
MISSING_CHECKS = [
    check("Missing values", f"{table} has zero nulls across all columns",
          "SELECT " + " + ".join(f"(SELECT COUNT(*) FROM {relation} WHERE {c} IS NULL)" for c in columns), "null cells")
    for table, (relation, _, columns) in TABLES.items()
]
RELATIONS = [
    ("orders", "customer_id", "customers", "customer_id"),
    ("orders", "store_id", "stores", "store_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("inventory", "store_id", "stores", "store_id"),
    ("inventory", "product_id", "products", "product_id"),
    ("returns", "order_id", "orders", "order_id"),
    ("returns", "product_id", "products", "product_id"),
]
REFERENCE_CHECKS = [
    *[
        check("Referential integrity", f"{child}.{column} -> {parent}.{key}",
              f"SELECT COUNT(*) FROM {TABLES[child][0]} c WHERE NOT EXISTS "
              f"(SELECT 1 FROM {TABLES[parent][0]} p WHERE p.{key} = c.{column})", "orphaned rows")
        for child, column, parent, key in RELATIONS
    ],
    check("Referential integrity", "marketing_campaigns.city_target is a known city",
          "SELECT COUNT(*) FROM r_campaigns c WHERE NOT EXISTS (SELECT 1 FROM r_stores s WHERE s.city = c.city_target)",
          "unrecognised city values"),
]
EARLY_ORDERS = "r_headers o JOIN r_customers c ON c.customer_id = o.customer_id WHERE o.order_date < c.signup_date"
TEMPORAL_CHECKS = [
    check("Temporal integrity", "orders.order_date >= customers.signup_date", f"SELECT COUNT(*) FROM {EARLY_ORDERS}",
          "orders precede their customer''s signup date")
]
INVALID_CHECKS = [
    check("Invalid values", name, f"SELECT COUNT(*) FROM {relation} WHERE {bad}", what)
    for name, relation, bad, what in [
        ("products.unit_price > 0", "r_products", "unit_price <= 0", "non-positive prices"),
        ("products.unit_cost > 0", "r_products", "unit_cost <= 0", "non-positive costs"),
        ("products.unit_cost < unit_price (positive margin)", "r_products", "NOT unit_cost < unit_price",
         "products priced at or below cost"),
        ("order_items.quantity > 0", "r_items", "quantity <= 0", "non-positive quantities"),
        ("order_items.unit_price > 0", "r_items", "unit_price <= 0", "non-positive unit prices"),
        ("order_items.line_total == quantity * unit_price", "r_items",
         "abs(round(CAST(quantity AS DECIMAL(18,0)) * unit_price, 2) - line_total) > 0.01", "mismatched line totals"),
        ("inventory.stock_level >= 0", "r_inventory", "stock_level < 0", "negative stock levels"),
        ("inventory.reorder_level >= 0", "r_inventory", "reorder_level < 0", "negative reorder levels"),
        ("marketing_campaigns.budget > 0", "r_campaigns", "budget <= 0", "non-positive budgets"),
        ("marketing_campaigns.spend >= 0", "r_campaigns", "spend < 0", "negative spend values"),
        ("marketing_campaigns.start_date <= end_date", "r_campaigns", "start_date > end_date",
         "campaigns with end before start"),
        ("returns.return_date >= the order''s order_date",
         "r_returns r JOIN r_headers o ON o.order_id = r.order_id", "r.return_date < o.order_date",
         "returns dated before their order"),
    ]
]


def share_check(name: str, label: str, predicate: str, lo: float, hi: float) -> str:
    share = "x.share"
    return f"""SELECT 'Business distributions' AS category, '{name}' AS "check",
        CASE WHEN {share} BETWEEN {lo} AND {hi} THEN 'PASS' ELSE 'FAIL' END AS status,
        printf('{label}%.1f%%', {half_up(share + " * 100", 1)}) AS detail
        FROM (SELECT AVG(CASE WHEN {predicate} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS share FROM r_headers) x"""


BUSINESS_CHECKS = [
    share_check("online channel share is within 45%-65%", "actual online share: ", "channel = 'online'", 0.45, 0.65),
    share_check("cancellation rate is within 2%-10%", "actual cancellation rate: ", "order_status = 'cancelled'",
                0.02, 0.10),
]


def gap_check(name: str, relation: str, date: str, what: str) -> str:
    expected = months_between(f"(SELECT MIN({date}) FROM {relation})", f"(SELECT MAX({date}) FROM {relation})")
    return check("Time-series validation", name,
                 f"SELECT COUNT(*) FROM (SELECT month FROM ({expected}) e EXCEPT SELECT {MONTH(date)} FROM {relation}) g",
                 what)


GAP_CHECKS = [
    gap_check("every month in the window has at least one order", "r_headers", "order_date", "months with zero orders"),
    gap_check("every month in the window has at least one new signup", "r_customers", "signup_date",
              "months with zero signups"),
]
FOCUS_CHECK = f"""
    SELECT 'Focus anomaly' AS category, '{FOCUS} revenue drops by at least 20% in the anomaly window' AS "check",
           CASE WHEN change <= -0.20 THEN 'PASS' ELSE 'FAIL' END AS status,
           COALESCE('{FOCUS} changed ' || printf('%+.1f%%', {half_up("change * 100", 1)}) || ' (' ||
             format('{{:,}}', CAST(round(pre) AS BIGINT)) || ' -> ' || format('{{:,}}', CAST(round(post) AS BIGINT)) || ')',
             'no revenue to compare') AS detail
    FROM (SELECT MAX(pre) AS pre, MAX(post) AS post, MAX(change) AS change FROM t_changes WHERE city = '{FOCUS}') f"""
ISOLATED_CHECK = f"""
    SELECT 'Focus anomaly' AS category, 'every city but {FOCUS} stays within +/-25% over the same window' AS "check",
           CASE WHEN largest <= 0.25 THEN 'PASS' ELSE 'FAIL' END AS status,
           printf('largest change among other cities: %+.1f%%', {half_up("largest * 100", 1)}) AS detail
    FROM (SELECT COALESCE(MAX(abs(change)), 0) AS largest FROM t_changes WHERE city <> '{FOCUS}') f"""
ALL_CHECKS = union([
    *KEY_CHECKS, *REFERENCE_CHECKS, *TEMPORAL_CHECKS, *DUPLICATE_CHECKS, *MISSING_CHECKS, *INVALID_CHECKS,
    *BUSINESS_CHECKS, *GAP_CHECKS, FOCUS_CHECK, ISOLATED_CHECK,
])


# --- checks of built tables ---------------------------------------------------------------------------


def table_rules(name: str, relation: str, key: list[str], non_negative: list[str], floor: str = "1",
                columns: list[str] | None = None, within: list[str] | None = None, never: dict | None = None) -> str:
    """Check rows (table_name, check, passed, detail) of one built table."""
    listed = str(key).replace("'", "''")

    def rule(title: str, count: str, what: str) -> str:
        return (f"SELECT '{name}' AS table_name, '{title}' AS \"check\", n = 0 AS passed, "
                f"CAST(n AS VARCHAR) || ' {what}' AS detail FROM (SELECT CAST(({count}) AS BIGINT) AS n) v")

    parts = [rule(t, f"SELECT COUNT(*) FROM {relation} WHERE {c}", "violation(s)") for t, c in (never or {}).items()]
    parts += [
        rule(f"unique primary key {listed}", surplus(relation, key), "duplicate(s)"),
        rule(f"no missing primary key {listed}", f"SELECT COUNT(*) FROM {relation} WHERE {any_null(key)}", "missing"),
    ]
    if columns:
        parts.append(rule("no fully duplicate rows", surplus(relation, columns), "duplicate row(s)"))
    parts += [
        rule(f"{c} >= 0", f"SELECT COUNT(*) FROM {relation} WHERE {c} < 0", "negative row(s)") for c in non_negative
    ]
    parts += [
        rule(f"{c} in [0, 1]", f"SELECT COUNT(*) FROM {relation} WHERE {c} NOT BETWEEN 0 AND 1", "out-of-range row(s)")
        for c in within or []
    ]
    parts.append(
        f"SELECT '{name}', 'row count >= ' || CAST(f AS VARCHAR), n >= f, CAST(n AS VARCHAR) || ' rows' "
        f"FROM (SELECT (SELECT COUNT(*) FROM {relation}) AS n, CAST(({floor}) AS BIGINT) AS f) v"
    )
    return union(parts)


def size(relation: str) -> str:
    return f"(SELECT COUNT(*) FROM {relation})"


ANALYTICS_CHECKS = union([
    table_rules("customer_summary", "t_customer_summary", ["customer_id"], ["total_spent", "total_orders", "total_items"],
                f"SELECT {size('r_customers')}", never={"no order before signup_date": "first_order_date < signup_date"}),
    table_rules("daily_sales", "t_daily_sales", ["date", "store_id"], ["revenue", "orders", "units_sold"],
                f"SELECT {size('t_days')} * {size('r_stores')}"),
    table_rules("monthly_sales", "t_monthly_sales", ["month"], ["revenue", "orders", "units_sold"]),
    table_rules("product_performance", "t_product_performance", ["product_id"], ["revenue", "units_sold"],
                f"SELECT {size('r_products')}"),
    table_rules("product_monthly_sales", "t_product_months", ["product_id", "month"], ["units_sold", "revenue", "returns"],
                f"SELECT {size('r_products')} * {size('t_months')}"),
    table_rules("store_performance", "t_store_performance", ["store_id"], ["revenue", "orders"],
                f"SELECT {size('r_stores')}"),
    table_rules("inventory_health", "t_inventory_health", ["product_id"], ["current_stock", "units_sold_last_30_days"],
                f"SELECT {size('r_products')}"),
    table_rules("marketing_performance", "t_marketing", ["campaign_id"], ["marketing_spend", "revenue_generated"],
                f"SELECT {size('r_campaigns')}"),
    table_rules("returns_summary", "t_returns_summary", ["product_id"], ["returns", "units_sold"],
                f"SELECT {size('r_products')}"),
])
FEATURE_CHECKS = union([
    table_rules("sales_forecasting_features", "t_forecasting", ["month"], ["revenue", "orders", "customers", "units_sold"],
                "12", ["*"]),
    table_rules("customer_features", "t_customer_features", ["customer_id"], ["total_orders", "total_spent", "total_items"],
                f"SELECT {size('r_customers')}", ["*"]),
    table_rules("product_features", "t_product_features", ["product_id"], ["units_sold", "revenue", "sales_last_30_days"],
                f"SELECT {size('r_products')}", ["*"], ["return_rate", "average_discount"]),
    table_rules("store_features", "t_store_features", ["store_id"],
                ["orders", "customers", "revenue", "average_daily_sales"], f"SELECT {size('r_stores')}", ["*"],
                ["return_rate"]),
])
COLUMN_COUNTS = {
    "customer_summary": 11, "daily_sales": 9, "monthly_sales": 6, "product_performance": 8, "product_monthly_sales": 10,
    "store_performance": 7, "inventory_health": 6, "marketing_performance": 9, "returns_summary": 5,
    "sales_forecasting_features": 17, "customer_features": 15, "product_features": 11, "store_features": 10,
}
RELATION_OF = {
    "customer_summary": "t_customer_summary", "daily_sales": "t_daily_sales", "monthly_sales": "t_monthly_sales",
    "product_performance": "t_product_performance", "product_monthly_sales": "t_product_months",
    "store_performance": "t_store_performance", "inventory_health": "t_inventory_health",
    "marketing_performance": "t_marketing", "returns_summary": "t_returns_summary",
    "sales_forecasting_features": "t_forecasting", "customer_features": "t_customer_features",
    "product_features": "t_product_features", "store_features": "t_store_features",
}


def summary_of(checks: str) -> str:
    return f"""SELECT table_name, CAST(COUNT(*) AS INTEGER) AS total_checks,
        CAST(COUNT(*) FILTER (WHERE passed) AS INTEGER) AS passed_checks,
        CASE WHEN bool_and(passed) THEN 'PASS' ELSE 'FAIL' END AS status FROM ({checks}) c GROUP BY 1"""


LISTING = f"""SELECT l.table_name, l.row_count, l.column_count, s.status FROM ({union([
    f"SELECT '{name}' AS table_name, (SELECT COUNT(*) FROM {RELATION_OF[name]}) AS row_count, "
    f"CAST({n} AS INTEGER) AS column_count" for name, n in COLUMN_COUNTS.items()
])}) l JOIN ({summary_of(ANALYTICS_CHECKS + " UNION ALL " + FEATURE_CHECKS)}) s ON s.table_name = l.table_name"""


# --- profiles -----------------------------------------------------------------------------------------


def shares(relation: str, column: str) -> str:
    return f"""SELECT '{column}' AS attribute, {column} AS value, COUNT(*) AS n,
        {half_up(ratio("COUNT(*)", "SUM(COUNT(*)) OVER ()"), 4)} AS share FROM {relation} GROUP BY {column}"""


def describe(relation: str, column: str) -> str:
    x = f"CAST({column} AS DOUBLE)"
    quartiles = ", ".join(
        f"{half_up(f'quantile_cont({x}, {p})', 4)} AS {name}" for name, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))
    )
    return f"""SELECT '{column}' AS column_name, COUNT({column}) AS "count", {half_up(f"AVG({x})", 4)} AS mean,
        {half_up(f"stddev_samp({x})", 4)} AS std, MIN({x}) AS "min", {quartiles}, MAX({x}) AS "max" FROM {relation}"""


def histogram(relation: str, column: str, bins: int = 30) -> str:
    return f"""SELECT CAST(b.bin AS INTEGER) AS bin, {half_up("e.lo + b.bin * e.w", 4)} AS bin_start,
        {half_up("e.lo + (b.bin + 1) * e.w", 4)} AS bin_end, COALESCE(h.n, 0) AS n
        FROM (SELECT unnest(range({bins})) AS bin) b
        CROSS JOIN (SELECT MIN(x) AS lo, (MAX(x) - MIN(x)) / {bins} AS w
                    FROM (SELECT CAST({column} AS DOUBLE) AS x FROM {relation}) v) e
        LEFT JOIN (SELECT least(floor((x - lo) / w), {bins - 1}) AS bin, COUNT(*) AS n
                   FROM (SELECT CAST({column} AS DOUBLE) AS x, MIN(CAST({column} AS DOUBLE)) OVER () AS lo,
                                (MAX(CAST({column} AS DOUBLE)) OVER () - MIN(CAST({column} AS DOUBLE)) OVER ()) / {bins} AS w
                         FROM {relation}) v WHERE x IS NOT NULL GROUP BY 1) h ON h.bin = b.bin"""


def alert(label: str, kpi: str, verb: str = "is") -> str:
    return f"""SELECT '{label}' AS alert, CASE WHEN change_pct IS NULL THEN '{label} {verb} stable.' ELSE
        printf('{label} %s %.1f%% vs previous month.', CASE WHEN change_pct >= 0 THEN 'increased' ELSE 'decreased' END,
               {half_up("abs(change_pct)", 1)}) END AS message FROM t_kpi_changes WHERE kpi = '{kpi}'"""


_BODIES: dict[str, str] = {
    "v_monthly_revenue_by_city": "SELECT * FROM t_revenue",
    "v_focus_revenue_trend": "SELECT * FROM t_trend",
    "q_focus_trend_complete": f"SELECT * FROM t_trend WHERE month < {MONTH(AS_OF)}",
    "q_expected_vs_actual": f"""
        SELECT month, revenue AS actual_revenue, {half_up("e", 2)} AS expected_revenue_trailing_3mo,
               {half_up("revenue - e", 2)} AS anomaly_amount, {percent("revenue - e", "e")} AS anomaly_pct
        FROM (SELECT month, revenue, AVG(revenue) OVER (ORDER BY month ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS e
              FROM t_revenue WHERE city = '{FOCUS}' AND month < {MONTH(AS_OF)}) x""",
    "v_marketing_spend_by_city_month": "SELECT * FROM t_spend",
    "q_focus_marketing_spend": f"SELECT city, month, total_spend FROM t_spend WHERE city = '{FOCUS}'",
    "v_focus_stockout_indicators": f"""
        SELECT * FROM (WITH flags AS (
          SELECT {MONTH("snapshot_date")} AS month, store_id, CAST(stock_level = 0 AS INTEGER) AS none_left,
                 CAST(reorder_level >= stock_level AS INTEGER) AS low FROM r_inventory),
        sums AS (
          SELECT month, store_id, SUM(none_left) AS none_left, SUM(low) AS low, COUNT(*) AS n FROM flags GROUP BY ALL)
        SELECT month, store_name, CAST(none_left AS BIGINT) AS zero_stock_snapshots,
               CAST(low AS BIGINT) AS at_or_below_reorder_snapshots, n AS total_snapshots,
               {percent("low", "n")} AS pct_snapshots_constrained
        FROM sums JOIN r_stores USING (store_id) WHERE city = '{FOCUS}') q""",
    "v_return_rate_by_city_month": "SELECT * FROM t_return_rate",
    "q_focus_return_rate": f"""SELECT month, order_count, return_count, return_rate_pct FROM t_return_rate
        WHERE city = '{FOCUS}'""",
    "v_category_revenue_by_city_month": "SELECT * FROM t_mix",
    "q_focus_category_mix": f"SELECT * FROM t_mix WHERE city = '{FOCUS}'",
    "v_monthly_active_customers_by_city":
        "SELECT city, month, COUNT(DISTINCT customer_id) AS active_customers FROM t_city_orders GROUP BY 1, 2",
    "v_new_vs_returning_customers_by_city_month": f"""
        SELECT * FROM (WITH dated AS (
          SELECT store_id, customer_id, {MONTH("order_date")} AS month,
                 {MONTH("MIN(order_date) OVER (PARTITION BY customer_id)")} AS began FROM t_completed),
        seen AS (SELECT DISTINCT city, customer_id, month, month = began AS is_new FROM dated JOIN r_stores USING (store_id))
        SELECT city, month, CAST(SUM(CASE WHEN is_new THEN 1 ELSE 0 END) AS BIGINT) AS new_customers,
               CAST(SUM(CASE WHEN is_new THEN 0 ELSE 1 END) AS BIGINT) AS returning_customers,
               COUNT(customer_id) AS total_active_customers
        FROM seen GROUP BY city, month) q""",
    "v_repeat_purchase_rate_by_city_month": f"""
        SELECT * FROM (WITH numbered AS (
          SELECT city, month, row_number() OVER (PARTITION BY city, month, customer_id ORDER BY order_id) AS k FROM t_city_orders)
        SELECT city, month, CAST(SUM(CAST(k = 1 AS INTEGER)) AS BIGINT) AS active_customers,
               CAST(SUM(CAST(k = 2 AS INTEGER)) AS BIGINT) AS repeat_customers,
               {percent("SUM(CAST(k = 2 AS INTEGER))", "SUM(CAST(k = 1 AS INTEGER))")} AS repeat_purchase_rate_pct
        FROM numbered GROUP BY city, month) q""",
    "v_avg_order_value_by_city_month":
        f"SELECT *, {half_up(ratio('revenue', 'order_count'), 2)} AS avg_order_value FROM t_revenue",
    "v_focus_customer_retention": f"""
        SELECT month, active AS active_customers, prior AS active_prior_month, retained AS retained_from_prior_month,
               prior - retained AS churned_from_prior_month, {percent("retained", "prior")} AS retention_rate_pct,
               {percent("prior - retained", "prior")} AS churn_rate_pct FROM t_retention""",
    "v_customer_cohort_summary": f"""
        SELECT city, cohort_month, cohort_size, CAST(k AS INTEGER) AS month_offset,
               COUNT(DISTINCT customer_id) AS active_customers,
               {percent("COUNT(DISTINCT customer_id)", "cohort_size")} AS pct_of_cohort_active
        FROM (SELECT c.city, c.cohort_month, c.cohort_size, c.customer_id,
                     (year(o.order_date) - year(c.cohort_month)) * 12 + month(o.order_date) - month(c.cohort_month) AS k
              FROM (SELECT city, customer_id, {MONTH("signup_date")} AS cohort_month,
                           COUNT(*) OVER (PARTITION BY city, {MONTH("signup_date")}) AS cohort_size FROM r_customers) c
              JOIN r_headers o ON o.customer_id = c.customer_id AND o.order_status = 'completed') x
        WHERE k BETWEEN 0 AND 6 GROUP BY city, cohort_month, cohort_size, k""",
    "customer_summary": "SELECT * FROM t_customer_summary",
    "daily_sales": "SELECT * FROM t_daily_sales",
    "monthly_sales": "SELECT * FROM t_monthly_sales",
    "product_performance": "SELECT * FROM t_product_performance",
    "product_monthly_sales": """SELECT month, product_id, product_name, category, units_sold, revenue, average_price,
        average_discount, returns, return_rate FROM t_product_months""",
    "store_performance": "SELECT * FROM t_store_performance",
    "inventory_health": "SELECT * FROM t_inventory_health",
    "marketing_performance": "SELECT * FROM t_marketing",
    "returns_summary": "SELECT * FROM t_returns_summary",
    "sales_forecasting_features": "SELECT * FROM t_forecasting",
    "customer_features": "SELECT * FROM t_customer_features",
    "product_features": "SELECT * FROM t_product_features",
    "store_features": "SELECT * FROM t_store_features",
    "dq_primary_keys": union(KEY_CHECKS),
    "dq_referential_integrity": union(REFERENCE_CHECKS),
    "dq_temporal_integrity": union(TEMPORAL_CHECKS),
    "dq_temporal_offenders": f"""SELECT o.order_id, o.customer_id, o.order_date, c.signup_date FROM {EARLY_ORDERS}
        ORDER BY o.order_id LIMIT 10""",
    "dq_duplicates": union(DUPLICATE_CHECKS),
    "dq_missing_values": union(MISSING_CHECKS),
    "dq_missing_by_column": union([
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count "
        f"FROM {relation}" for table, (relation, _, columns) in TABLES.items() for c in columns
    ]),
    "dq_invalid_values": union(INVALID_CHECKS),
    "dq_business_distributions": union(BUSINESS_CHECKS),
    "dq_missing_months": union(GAP_CHECKS),
    "dq_anomaly_changes": f"""SELECT city, {half_up("pre", 4)} AS pre, {half_up("post", 4)} AS post,
        {half_up("change", 4)} AS change FROM t_changes""",
    "dq_focus_anomaly": FOCUS_CHECK,
    "dq_anomaly_isolated": ISOLATED_CHECK,
    "dq_ranges": union([
        check("Ranges", "orders.customer_id in 1..customer count", """SELECT COUNT(*) FROM r_headers
              WHERE customer_id NOT BETWEEN 1 AND (SELECT COUNT(*) FROM r_customers)""", "out-of-range values"),
        """SELECT 'Ranges', 'orders has more than 30000 rows', CASE WHEN n > 30000 THEN 'PASS' ELSE 'FAIL' END,
              CAST(n AS VARCHAR) || ' rows' FROM (SELECT COUNT(*) AS n FROM r_headers) v""",
        check("Ranges", "customers.signup_date in window", """SELECT COUNT(*) FROM r_customers
              WHERE signup_date NOT BETWEEN DATE '1995-01-01' AND DATE '2000-06-23'""", "out-of-range values"),
    ]),
    "dq_quality_score": f"""
        SELECT total_checks, passed_checks, {half_up("100.0 * passed_checks / total_checks", 1)} AS quality_score,
               CASE WHEN 100.0 * passed_checks / total_checks >= 95 THEN 'PASS' ELSE 'FAIL' END AS gate
        FROM (SELECT COUNT(*) AS total_checks, COUNT(*) FILTER (WHERE status = 'PASS') AS passed_checks
              FROM ({ALL_CHECKS}) c) s""",
    "dq_category_summary": f"""
        SELECT category, COUNT(*) FILTER (WHERE status = 'FAIL') AS "FAIL", COUNT(*) FILTER (WHERE status = 'PASS') AS "PASS"
        FROM ({ALL_CHECKS}) c GROUP BY 1""",
    "dq_table_summary": summary_of(ANALYTICS_CHECKS),
    "dq_feature_table_summary": summary_of(FEATURE_CHECKS),
    "dq_table_checks": ANALYTICS_CHECKS,
    "dq_feature_table_checks": FEATURE_CHECKS,
    "dq_final_listing": LISTING,
    "partial_month_guard": "SELECT * FROM t_guarded",
    "forecast_features": f"""
        SELECT series_id, month, orders, revenue, previous_month_revenue,
               {half_up("m3", 4)} AS previous_3_month_avg_revenue, {half_up("m6", 4)} AS previous_6_month_avg_revenue,
               month_number, quarter, {half_up("growth", 4)} AS revenue_growth_rate FROM t_features""",
    "forecast_split": "SELECT series_id, month, revenue, split FROM t_split",
    "forecast_naive": """SELECT series_id, month, revenue, previous_month_revenue AS naive_pred FROM t_split
        WHERE split = 'test'""",
    "forecast_rolling": f"""SELECT series_id, month, revenue, {half_up("m3", 4)} AS rolling_pred FROM t_split
        WHERE split = 'test'""",
    "forecast_linreg": f"""
        SELECT s.series_id, s.month, s.revenue, {half_up("l.predicted", 2)} AS linreg_pred
        FROM t_split s JOIN t_linear l ON l.series_id = s.series_id AND l.month = s.month AND l.kind = 'test'""",
    "forecast_predictions": f"""
        SELECT s.series_id, s.month, s.revenue AS actual_revenue, s.previous_month_revenue AS naive_pred,
               {half_up("m3", 4)} AS rolling_pred, {half_up("l.predicted", 2)} AS linreg_pred
        FROM t_split s JOIN t_linear l ON l.series_id = s.series_id AND l.month = s.month AND l.kind = 'test'""",
    "forecast_model_specs": f"""
        SELECT b.series_id, b.model AS best_model, b.rmse,
               'previous_month_revenue,previous_3_month_avg_revenue,previous_6_month_avg_revenue,month_number,quarter,revenue_growth_rate'
                 AS features,
               CASE WHEN b.rank = 2 THEN {half_up("w.at_zero", 0)} END AS intercept,
               CASE WHEN b.rank = 2 THEN {half_up("w.at_one - w.at_zero", 3)} END AS previous_month_weight
        FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY rmse, rank) AS k FROM t_metrics) b
        JOIN (SELECT series_id, MAX(predicted) FILTER (WHERE kind = 'probe0') AS at_zero,
                     MAX(predicted) FILTER (WHERE kind = 'probe1') AS at_one FROM t_linear GROUP BY 1) w
          ON w.series_id = b.series_id WHERE k = 1""",
    "forecast_model_weights": f"""
        SELECT series_id, {half_up("at_0", 3)} AS intercept,
               {", ".join(f"{half_up(f'at_{k} - at_0', 3)} AS {name}_weight" for k, name in enumerate(WEIGHTED, 1))}
        FROM (SELECT series_id, {", ".join(f"MAX(predicted) FILTER (WHERE kind = 'probe{k}') AS at_{k}" for k in range(7))}
              FROM t_linear GROUP BY 1) w""",
    "forecast_metrics": "SELECT series_id, model, mae, rmse, mape_pct FROM t_metrics",
    "forecast_metrics_guarded": "SELECT series_id, model, mae, rmse, mape_pct FROM t_metrics",
    "forecast_best_model": """
        SELECT series_id, model AS best_model, rmse
        FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY rmse, rank) AS k FROM t_metrics) m WHERE k = 1""",
    "payload_overview": f"""
        SELECT {money("total")} AS total_revenue, CAST(n AS BIGINT) AS total_orders,
               (SELECT COUNT(*) FROM r_customers) AS total_customers, {half_up(ratio(money("total"), "n"), 4)} AS average_order_value
        FROM (SELECT SUM(CAST(revenue AS DECIMAL(20,2))) AS total, SUM(orders) AS n FROM t_monthly_sales) m""",
    "payload_customers_sample": """
        SELECT s.*, f.customer_lifetime_days, f.purchase_frequency, f.average_days_between_orders, f.recency, f.frequency,
               f.monetary, (SELECT COUNT(*) FROM t_customer_summary) AS total_customers
        FROM (SELECT * FROM t_customer_summary ORDER BY customer_id LIMIT 20) s
        JOIN t_customer_features f ON f.customer_id = s.customer_id""",
    "kpi_mom_change": "SELECT * FROM t_kpi_changes",
    "kpi_alerts": union([
        alert("Revenue", "revenue"), alert("Orders", "orders", "are"), alert("AOV", "average_order_value"),
        "SELECT 'Inventory', 'Inventory health is stable across products.'",
    ]),
    "revenue_by_city": f"""SELECT city, {money("SUM(CAST(revenue AS DECIMAL(20,2)))")} AS revenue FROM t_store_performance
        GROUP BY 1""",
    "store_ranking": "SELECT * FROM t_store_performance",
    "monthly_revenue_by_city_from_daily": f"""
        SELECT strftime(date, '%Y-%m') AS month, city, {money("SUM(CAST(revenue AS DECIMAL(20,2)))")} AS revenue
        FROM t_daily_sales WHERE {MONTH("date")} <> {MONTH("(SELECT MAX(date) FROM t_daily_sales)")} GROUP BY 1, 2""",
    "daily_revenue_total": f"""SELECT date, {money("SUM(CAST(revenue AS DECIMAL(20,2)))")} AS revenue FROM t_daily_sales
        GROUP BY 1""",
    "focus_vs_others_monthly": f"""
        SELECT month, SUM(revenue) FILTER (WHERE city = '{FOCUS}') AS focus_revenue,
               {half_up(ratio(f"SUM(CAST(revenue AS DECIMAL(20,2))) FILTER (WHERE city <> '{FOCUS}')",
                              f"COUNT(revenue) FILTER (WHERE city <> '{FOCUS}')"), 2)} AS others_mean_revenue
        FROM t_revenue GROUP BY 1""",
    "top_products_by_revenue": "SELECT * FROM t_product_performance ORDER BY revenue DESC, product_id LIMIT 10",
    "top_products_by_return_rate": "SELECT * FROM t_product_performance ORDER BY return_rate DESC, product_id LIMIT 10",
    "revenue_by_category": f"""
        SELECT category, {money("SUM(CAST(revenue AS DECIMAL(20,2)))")} AS revenue,
               {half_up(ratio("SUM(CAST(revenue AS DECIMAL(20,2)))", "SUM(SUM(CAST(revenue AS DECIMAL(20,2)))) OVER ()"), 4)}
               AS share FROM t_product_performance GROUP BY 1""",
    "inventory_risk_distribution": """
        SELECT CAST(b.position AS INTEGER) AS position, b.risk_level, COUNT(h.product_id) AS products
        FROM (VALUES (1, 'Critical'), (2, 'High'), (3, 'Medium'), (4, 'Low')) b(position, risk_level)
        LEFT JOIN t_inventory_health h ON h.risk_level = b.risk_level GROUP BY 1, 2""",
    "closest_to_stockout": """SELECT * FROM t_inventory_health
        ORDER BY estimated_days_to_stockout ASC NULLS LAST, product_id LIMIT 10""",
    "scan_table_counts": union([
        f"SELECT '{table}' AS table_name, COUNT(*) AS row_count, CAST({len(columns)} AS INTEGER) AS column_count "
        f"FROM {relation}" for table, (relation, _, columns) in TABLES.items()
    ]),
    "channel_status_share": union([shares("r_headers", "channel"), shares("r_headers", "order_status")]),
    "segment_share": shares("r_customers", "segment"),
    "customers_by_city": "SELECT city, COUNT(*) AS customers FROM r_customers GROUP BY 1",
    "products_by_category": "SELECT category, COUNT(*) AS products FROM r_products GROUP BY 1",
    "stores_per_city": """SELECT city, COUNT(*) AS store_count, string_agg(CAST(store_id AS VARCHAR), ',' ORDER BY store_id)
        AS store_ids FROM r_stores GROUP BY 1""",
    "snapshots_per_store": "SELECT store_id, COUNT(*) AS snapshots FROM r_inventory GROUP BY 1",
    "campaign_spend_by_city": f"""SELECT city_target AS city, COUNT(*) AS campaigns, {money("SUM(spend)")} AS total_spend
        FROM r_campaigns GROUP BY 1""",
    "monthly_signups_pivot_city":
        f"SELECT {MONTH('signup_date')} AS month, city, COUNT(*) AS signups FROM r_customers GROUP BY ALL",
    "monthly_orders_pivot_city": f"""
        SELECT {MONTH('o.order_date')} AS month, s.city, COUNT(*) AS orders FROM r_orders o JOIN r_stores s USING (store_id)
        WHERE {MONTH('o.order_date')} > CAST({MONTH(AS_OF)} - INTERVAL 6 MONTH AS DATE) GROUP BY ALL""",
    "monthly_gross_revenue_pivot_city": f"""
        SELECT {MONTH('o.order_date')} AS month, s.city, {money("SUM(i.line_total)")} AS revenue
        FROM r_orders o JOIN r_items i USING (order_id) JOIN r_stores s USING (store_id)
        WHERE {MONTH('o.order_date')} > CAST({MONTH(AS_OF)} - INTERVAL 4 MONTH AS DATE) GROUP BY ALL""",
    "returned_share_by_city_recent": f"""
        SELECT s.city, COUNT(*) AS orders, {half_up('''AVG(CASE WHEN o.order_id IN (SELECT order_id FROM r_returns)
               THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)''', 4)} AS returned_share
        FROM t_completed o JOIN r_stores s ON s.store_id = o.store_id
        WHERE o.order_date >= CAST({AS_OF} - INTERVAL 2 MONTH AS DATE) GROUP BY 1""",
    "eligible_customers_by_month": f"""
        SELECT m.month, COUNT(c.customer_id) AS eligible_customers
        FROM ({months_between("(SELECT MIN(order_date) FROM r_headers)", AS_OF)}) m
        LEFT JOIN r_customers c ON c.signup_date <= last_day(m.month) GROUP BY 1""",
    "fx_month_parts": f"""
        SELECT strftime(m, '%Y-%m') AS month_label, m AS month, CAST(year(m) AS INTEGER) AS year,
               CAST(quarter(m) AS INTEGER) AS quarter, CAST(month(m) AS INTEGER) AS month_number
        FROM (SELECT DISTINCT {MONTH("order_date")} AS m FROM r_headers) d""",
    "fx_email": """SELECT customer_id, lower(split_part(customer_name, '#', 1)) || '.' || lower(split_part(customer_name, '#', 2))
        || CAST(customer_id AS VARCHAR) || '@example.com' AS email FROM r_customers""",
    "describe_numeric": union([
        describe("r_products", "unit_cost"), describe("r_products", "unit_price"), describe("r_inventory", "stock_level"),
    ]),
    "histogram_recency": histogram("t_customer_features", "recency"),
    "histogram_monetary": histogram("t_customer_features", "monetary"),
    "histogram_units": histogram("t_product_features", "units_sold"),
}

_BODIES |= {
    "csv_orders": "SELECT * FROM r_headers",
    "csv_products": """SELECT * REPLACE (CAST(unit_price AS DOUBLE) AS unit_price, CAST(unit_cost AS DOUBLE) AS unit_cost)
        FROM r_products""",
    "csv_rejected_orders": """
        SELECT channel || ',' || CASE WHEN channel = 'online' THEN 'c' ELSE '' END || CAST(customer_id AS VARCHAR) || ','
               || CASE WHEN order_status = 'cancelled' THEN 'none' ELSE CAST(order_date AS VARCHAR) END || ','
               || CAST(order_id AS VARCHAR) || ',' || order_status AS record,
               concat_ws(',', CASE WHEN channel = 'online' THEN 'customer_id' END,
                         CASE WHEN order_status = 'cancelled' THEN 'order_date' END) AS failed
        FROM r_headers WHERE channel = 'online' OR order_status = 'cancelled'""",
    "load_counts": f"""
        SELECT * FROM (WITH
        good_orders AS (SELECT order_id FROM r_orders JOIN r_customers USING (customer_id) JOIN r_stores USING (store_id)),
        good_items AS (SELECT order_item_id FROM r_items JOIN good_orders USING (order_id) JOIN r_products USING (product_id)),
        good_returns AS (SELECT return_id FROM r_returns JOIN good_orders USING (order_id) JOIN r_products USING (product_id)),
        good_stock AS (SELECT product_id FROM r_inventory JOIN r_stores USING (store_id) JOIN r_products USING (product_id)),
        sizes AS ({union([
            f"SELECT '{table}' AS table_name, (SELECT COUNT(*) FROM {good}) AS loaded, (SELECT COUNT(*) FROM {every}) AS n"
            for table, good, every in (
                ("customers", "r_customers", "r_customers"), ("stores", "r_stores", "r_stores"),
                ("products", "r_products", "r_products"), ("orders", "good_orders", "r_orders"),
                ("order_items", "good_items", "r_items"), ("inventory", "good_stock", "r_inventory"),
                ("returns", "good_returns", "r_returns"), ("marketing_campaigns", "r_campaigns", "r_campaigns"),
            )
        ])})
        SELECT table_name, loaded, n - loaded AS set_aside FROM sizes) q""",
}

# Product series on the calendar without gaps.
CTES |= {
    "t_p_series": """
        SELECT product_id AS series_id, month_date AS month, units_sold AS orders, revenue FROM t_product_months""",
    "t_p_features": CTES["t_features"].replace("t_guarded", "t_p_series"),
    "t_p_split": CTES["t_split"].replace("t_features", "t_p_features"),
    "t_p_predicted": """
        SELECT series_id, 'naive' AS model, revenue AS actual, previous_month_revenue AS predicted FROM t_p_split
        WHERE split = 'test'
        UNION ALL SELECT series_id, 'rolling_avg', revenue, m3 FROM t_p_split WHERE split = 'test'""",
}


def product_metrics(mape: str) -> str:
    return f"""
        SELECT series_id, model, {half_up("AVG(abs(actual - predicted))", 2)} AS mae,
               {half_up("sqrt(AVG((actual - predicted) * (actual - predicted)))", 2)} AS rmse, {mape} AS mape_pct
        FROM t_p_predicted GROUP BY 1, 2"""


def percentage_error(of: str) -> str:
    return half_up(f"AVG(abs(actual - predicted) / abs(actual)) {of} * 100", 2)


def missing_of(relation: str) -> str:
    """(column_name, n): nulls per column, in the order of the columns."""
    return f"""UNPIVOT (SELECT SUM(CASE WHEN COLUMNS('.*') IS NULL THEN 1 ELSE 0 END) AS '\\0' FROM ({relation}))
        ON COLUMNS(*) INTO NAME column_name VALUE n"""


def missing_list(relation: str) -> str:
    return f"""COALESCE((SELECT string_agg(column_name || ': ' || CAST(CAST(n AS BIGINT) AS VARCHAR), '; ')
        FROM ({missing_of(relation)}) m WHERE n > 0), '')"""


_BODIES |= {
    "forecast_product_metrics": product_metrics(f"""
        CASE WHEN bool_or(actual = 0) THEN CAST('Infinity' AS DOUBLE) ELSE {percentage_error("FILTER (WHERE actual <> 0)")} END"""),
    "forecast_product_metrics_guarded": product_metrics(percentage_error("FILTER (WHERE actual <> 0)")),
    "export_records_parsed": """
        SELECT product_id, '"' || product_name || '\\ ' || chr(10) || chr(9) || 'é/' AS label,
               CASE WHEN product_id % 5 <> 0 THEN category END AS category, CAST(unit_price AS DOUBLE) AS unit_price,
               CASE WHEN product_id % 7 <> 0 THEN CAST(unit_cost AS DOUBLE) END AS unit_cost,
               CAST(DATE '1995-01-01' + CAST(product_id % 2000 AS INT) AS DATE) AS day, CAST(6 AS INTEGER) AS fields
        FROM r_products""",
    "product_performance_list_price": f"""
        SELECT p.* REPLACE ({half_up("COALESCE(s.discount, 0)", 4)} AS average_discount) FROM t_product_performance p
        LEFT JOIN (SELECT o.product_id, AVG(1 - CAST(o.unit_price AS DOUBLE) / CAST(l.unit_price AS DOUBLE))
                            FILTER (WHERE 1 - CAST(o.unit_price AS DOUBLE) / CAST(l.unit_price AS DOUBLE) > 1e-6) AS discount
                   FROM t_sold o JOIN r_products l ON l.product_id = o.product_id GROUP BY 1) s
               ON s.product_id = p.product_id""",
    "dq_failed_checks": f"""SELECT table_name, "check", detail FROM ({union([ANALYTICS_CHECKS, FEATURE_CHECKS])}) c
        WHERE NOT passed""",
    "dq_feature_missing": union([
        f"""SELECT '{table}' AS table_name, column_name, CAST(n AS BIGINT) AS missing, {percent("n", size(RELATION_OF[table]))}
            AS missing_pct FROM ({missing_of(f"SELECT * FROM {RELATION_OF[table]}")}) m"""
        for table in ("sales_forecasting_features", "customer_features", "product_features", "store_features")
    ]),
    "returned_share_by_city_ranked": f"""
        SELECT *, row_number() OVER (ORDER BY returned_share DESC, city) AS position
        FROM ({_BODIES["returned_share_by_city_recent"]}) q""",
    "focus_signups_recent": f"""
        SELECT * FROM ({_BODIES["monthly_signups_pivot_city"]}) q WHERE city = '{FOCUS}' ORDER BY month DESC LIMIT 6""",
}
_ANALYTICS = [t for t in COLUMN_COUNTS if not t.endswith("_features")]
_BODIES["dq_table_profile"] = f"""
    SELECT l.table_name, l.row_count, l.column_count, s.status, COALESCE(f.failed, '') AS failed_checks, m.missing_values
    FROM ({LISTING}) l JOIN ({summary_of(ANALYTICS_CHECKS)}) s ON s.table_name = l.table_name
    LEFT JOIN (SELECT table_name, string_agg("check" || ': ' || detail, '; ') AS failed FROM ({ANALYTICS_CHECKS}) c
               WHERE NOT passed GROUP BY 1) f ON f.table_name = l.table_name
    JOIN ({union([f"SELECT '{t}' AS table_name, {missing_list(_BODIES[t])} AS missing_values" for t in _ANALYTICS])}) m
      ON m.table_name = l.table_name"""

# The same views, which Spark computes from SQL text.
_BODIES |= {f"sql_{name}": _BODIES[name] for name in list(_BODIES) if name.startswith("v_")}

# The place of every row in the order of a result.
_ORDERS = {
    "v_monthly_revenue_by_city": "city, month",
    "v_focus_revenue_trend": "month",
    "v_marketing_spend_by_city_month": "city NULLS LAST, month",
    "v_focus_stockout_indicators": "month, store_name",
    "v_return_rate_by_city_month": "city, month",
    "v_category_revenue_by_city_month": "city, month, revenue DESC, category",
    "v_monthly_active_customers_by_city": "city, month",
    "v_new_vs_returning_customers_by_city_month": "city, month",
    "v_repeat_purchase_rate_by_city_month": "city, month",
    "v_avg_order_value_by_city_month": "city, month",
    "v_focus_customer_retention": "month",
    "v_customer_cohort_summary": "city NULLS LAST, cohort_month, month_offset",
    "daily_sales": "date, store_id",
    "product_monthly_sales": "product_id, month",
    "customer_features": "customer_id",
}
_BODIES |= {
    f"ordered_{name}": f"SELECT *, row_number() OVER (ORDER BY {order}) AS position FROM ({_BODIES[name]}) ranked"
    for name, order in _ORDERS.items()
}
_BODIES["ordered_closest_to_stockout_all"] = """
    SELECT *, row_number() OVER (ORDER BY estimated_days_to_stockout ASC NULLS LAST, product_id) AS position
    FROM t_inventory_health"""

# Without an entry: the queries with a fitted regression, and the JSON export, whose number
# formatting differs by engine.  They are tested against known answers instead.
ORACLES: dict[str, str] = {name: statement(body) for name, body in _BODIES.items()}
