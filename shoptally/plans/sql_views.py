"""The city views as SQL text over registered tables, views upon views.

Names: the retail tables are ``retail_<table>`` (``retail_order_headers`` are orders without their store), views keep
their names.  Lines are summed per order and orders per
store and month before a dimension joins them, so that no view needs a count of distinct orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shoptally.operators.views import COHORT_MONTHS
from shoptally.sources.files import register_views
from shoptally.sources.retail import Retail

FUNCTIONS = {
    "cents(value DOUBLE) RETURNS DOUBLE": "CAST(ROUND(CAST(value AS DECIMAL(38,18)), 2) AS DOUBLE)",
    "percent(part DOUBLE, whole DOUBLE) RETURNS DOUBLE": "CAST(ROUND(CAST(100D * part / NULLIF(whole, 0D) AS DECIMAL(38,18)), 1) AS DOUBLE)",
    "money(total DECIMAL(38,4)) RETURNS DOUBLE": "CAST(ROUND(total, 2) AS DOUBLE)",
}

# Each view may use those above it.  :city is the focus city.
VIEWS: dict[str, str] = {
    "v_completed_orders": """
        SELECT order_id, customer_id, store_id, order_date, trunc(order_date, 'MM') AS month
        FROM retail_orders WHERE order_status = 'completed'""",
    "v_order_totals": "SELECT order_id, SUM(line_total) AS total FROM retail_order_items GROUP BY order_id",
    "v_monthly_revenue_by_city": """
        WITH store_months AS (
          SELECT store_id, month, COUNT(*) AS orders, SUM(total) AS total
          FROM v_completed_orders JOIN v_order_totals USING (order_id) GROUP BY store_id, month)
        SELECT city, month, SUM(orders) AS order_count, retail_money(SUM(total)) AS revenue
        FROM store_months JOIN retail_stores USING (store_id) GROUP BY city, month""",
    "v_focus_revenue_trend": """
        WITH paired AS (
          SELECT month, order_count, revenue, lag(revenue) OVER (ORDER BY month) AS prev_month_revenue
          FROM v_monthly_revenue_by_city WHERE city = :city)
        SELECT *, retail_percent(revenue - prev_month_revenue, prev_month_revenue) AS mom_pct_change FROM paired""",
    "v_marketing_spend_by_city_month": """
        SELECT city_target AS city, trunc(start_date, 'MM') AS month, COUNT(*) AS campaign_count,
               retail_money(SUM(budget)) AS total_budget, retail_money(SUM(spend)) AS total_spend
        FROM retail_marketing_campaigns GROUP BY ALL""",
    "v_focus_stockout_indicators": """
        WITH per_store AS (
          SELECT store_id, trunc(snapshot_date, 'MM') AS month, count_if(stock_level = 0) AS none_left,
                 count_if(stock_level <= reorder_level) AS low, COUNT(*) AS n
          FROM retail_inventory GROUP BY ALL)
        SELECT month, store_name, SUM(none_left) AS zero_stock_snapshots, SUM(low) AS at_or_below_reorder_snapshots,
               SUM(n) AS total_snapshots, retail_percent(SUM(low), SUM(n)) AS pct_snapshots_constrained
        FROM per_store JOIN retail_stores USING (store_id) WHERE city = :city GROUP BY month, store_name""",
    "v_return_rate_by_city_month": """
        WITH returned AS (
          SELECT order_id, COUNT(return_id) AS n FROM (SELECT DISTINCT order_id, return_id FROM retail_returns) GROUP BY order_id),
        per_store AS (
          SELECT store_id, month, COUNT(*) AS orders, SUM(coalesce(n, 0)) AS returns
          FROM v_completed_orders LEFT JOIN returned USING (order_id) GROUP BY store_id, month)
        SELECT city, month, SUM(orders) AS order_count, SUM(returns) AS return_count,
               retail_percent(SUM(returns), SUM(orders)) AS return_rate_pct
        FROM per_store JOIN retail_stores USING (store_id) GROUP BY city, month""",
    "v_category_revenue_by_city_month": """
        WITH per_store AS (
          SELECT store_id, month, category, SUM(line_total) AS total
          FROM v_completed_orders JOIN retail_order_items USING (order_id) JOIN retail_products USING (product_id)
          GROUP BY store_id, month, category),
        per_city AS (
          SELECT city, month, category, SUM(total) AS total FROM per_store JOIN retail_stores USING (store_id)
          GROUP BY city, month, category)
        SELECT city, month, category, retail_money(total) AS revenue,
               retail_percent(total, SUM(total) OVER (PARTITION BY city, month)) AS pct_of_city_month_revenue
        FROM per_city""",
    "v_customer_months": """
        SELECT city, month, customer_id, COUNT(*) AS orders
        FROM v_completed_orders JOIN retail_stores USING (store_id) GROUP BY city, month, customer_id""",
    "v_monthly_active_customers_by_city": """
        SELECT city, month, COUNT(customer_id) AS active_customers FROM v_customer_months GROUP BY city, month""",
    "v_new_vs_returning_customers_by_city_month": """
        WITH began AS (SELECT customer_id, MIN(month) AS first_month FROM v_completed_orders GROUP BY customer_id)
        SELECT city, month, count_if(month = first_month) AS new_customers, count_if(month > first_month) AS returning_customers,
               COUNT(*) AS total_active_customers
        FROM v_customer_months JOIN began USING (customer_id) GROUP BY city, month""",
    "v_repeat_purchase_rate_by_city_month": """
        SELECT city, month, COUNT(*) AS active_customers, count_if(orders > 1) AS repeat_customers,
               retail_percent(count_if(orders > 1), COUNT(*)) AS repeat_purchase_rate_pct
        FROM v_customer_months GROUP BY city, month""",
    "v_avg_order_value_by_city_month": """
        SELECT *, retail_cents(revenue / NULLIF(order_count, 0)) AS avg_order_value FROM v_monthly_revenue_by_city""",
    "v_focus_customer_retention": """
        WITH marked AS (
          SELECT month, lag(month) OVER (PARTITION BY customer_id ORDER BY month) <=> add_months(month, -1) AS came_back
          FROM v_customer_months WHERE city = :city),
        months AS (SELECT month, COUNT(*) AS active, count_if(came_back) AS retained FROM marked GROUP BY month),
        paired AS (
          SELECT *, if(lag(month) OVER (ORDER BY month) <=> add_months(month, -1), lag(active) OVER (ORDER BY month), 0) AS prior
          FROM months)
        SELECT month, active AS active_customers, prior AS active_prior_month, retained AS retained_from_prior_month,
               prior - retained AS churned_from_prior_month, retail_percent(retained, prior) AS retention_rate_pct,
               retail_percent(prior - retained, prior) AS churn_rate_pct
        FROM paired""",
    "v_cohorts": """
        SELECT customer_id, city, trunc(signup_date, 'MM') AS cohort_month FROM retail_customers""",
    "v_customer_cohort_summary": f"""
        WITH sizes AS (SELECT city, cohort_month, COUNT(*) AS cohort_size FROM v_cohorts GROUP BY city, cohort_month),
        bought AS (
          SELECT DISTINCT customer_id, trunc(order_date, 'MM') AS month FROM retail_order_headers WHERE order_status = 'completed'),
        active AS (
          SELECT city, cohort_month, CAST(months_between(month, cohort_month) AS INT) AS month_offset, COUNT(*) AS active_customers
          FROM v_cohorts JOIN bought USING (customer_id)
          WHERE month BETWEEN cohort_month AND add_months(cohort_month, {COHORT_MONTHS}) GROUP BY ALL)
        SELECT a.city, a.cohort_month, cohort_size, month_offset, active_customers,
               retail_percent(active_customers, cohort_size) AS pct_of_cohort_active
        FROM active a JOIN sizes s ON a.city <=> s.city AND a.cohort_month = s.cohort_month""",
}
#: The views that stand for a result; the others are steps on the way.
STEPS = ("v_completed_orders", "v_order_totals", "v_customer_months", "v_cohorts")
RESULTS = [name for name in VIEWS if name not in STEPS]


def create_views(spark: SparkSession, retail: Retail, city: str) -> None:
    """Register the retail tables, the functions and all views for this session; nothing is computed."""
    register_views(spark, {f"retail_{name}": df for name, df in retail.tables().items()})
    register_views(spark, {"retail_order_headers": retail.order_headers})
    for head, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION retail_{head} RETURN {body}")
    for name, text in VIEWS.items():
        spark.sql(text, args={"city": city}).createOrReplaceTempView(name)


def view(spark: SparkSession, retail: Retail, name: str, city: str) -> DataFrame:
    create_views(spark, retail, city)
    return spark.sql(f"SELECT * FROM {name}")
