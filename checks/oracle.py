"""DuckDB SQL that states each query a second time, straight from the raw tables.

``CTES`` holds the shared definitions; :func:`_sql` prefixes a statement with those it mentions.
Rounding is done on whole numbers (:func:`_half_up`), so both engines round the same exact value.
"""

from __future__ import annotations

import re

# fixed values, stated a second time so that a slip in the library's own lists is found
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
RETENTION_HOURS = {"bronze": 7 * 24, "silver": 14 * 24, "gold": 30 * 24}
US_STATES = (
    "AL AK AZ AR CA CO CT DE FL GA HI ID IL IN IA KS KY LA ME MD MA MI MN MS MO MT NE NV NH NJ "
    "NM NY NC ND OH OK OR PA RI SC SD TN TX UT VT VA WA WV WI WY"
).split()
TAGS = [
    *[("gold", table, None, tag, value) for table, *values in (
        ("customer_360", "customer", "high", "true"), ("daily_sales_summary", "sales", "medium", "false"),
        ("product_performance", "product", "low", "false"), ("store_analytics", "store", "medium", "false"),
    ) for tag, value in zip(("domain", "sensitivity", "pii"), values)],
    *[("silver", "customers", column, tag, value) for column, kind in (
        ("email", "email"), ("phone", "phone"), ("first_name", "name"), ("last_name", "name"),
    ) for tag, value in (("pii", "true"), ("pii_type", kind))],
]

AS_OF = "DATE '2001-08-01'"
STATES = "[" + ", ".join(f"'{s}'" for s in US_STATES) + "]"


def _half_up(num: str, den: str, digits: int) -> str:
    """``num / den`` rounded half up to ``digits`` as double; NULL if ``den`` is 0. Both are whole numbers."""
    n, d = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    whole = f"(2 * abs({n}) * {10**digits} + {d}) // (2 * {d})"
    return f"(CASE WHEN ({den}) <> 0 THEN sign({n}) * CAST({whole} AS DOUBLE) / {10**digits} END)"


def _cents(x: str) -> str:
    return f"CAST(({x}) * 100 AS HUGEINT)"


def _money(x: str, name: str) -> str:
    return f"CAST({x} AS DOUBLE) AS {name}"


def _fine_mean(x: str) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(18,6))) AS DOUBLE) / count({x})"


def _fine_mean_2(x: str) -> str:
    total = f"CAST(sum(CAST({x} AS DECIMAL(18,6))) * 1000000 AS HUGEINT)"
    return _half_up(total, f"count({x}) * 1000000", 2)


CTES = {
    "b_transactions": f"""
        SELECT o_orderkey AS transaction_id,
               CASE WHEN o_orderkey % 97 <> 0 THEN o_custkey + CASE WHEN o_custkey % 19 = 0 THEN 1000000000000 ELSE 0 END END AS customer_id,
               CAST(o_orderkey % 100 AS INTEGER) AS store_id,
               CAST(o_orderdate AS DATE) AS transaction_date,
               CAST(o_orderdate AS TIMESTAMP) + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS transaction_timestamp,
               CASE WHEN (o_orderkey + o_custkey) % 20 < 17 THEN 'purchase'
                    WHEN (o_orderkey + o_custkey) % 20 < 19 THEN 'return' ELSE 'exchange' END AS transaction_type,
               CASE WHEN CAST(floor(o_totalprice) AS BIGINT) % 20 < 9 THEN 'credit_card'
                    WHEN CAST(floor(o_totalprice) AS BIGINT) % 20 < 14 THEN 'debit_card'
                    WHEN CAST(floor(o_totalprice) AS BIGINT) % 20 < 17 THEN 'digital_wallet'
                    WHEN CAST(floor(o_totalprice) AS BIGINT) % 20 < 19 THEN 'cash' ELSE 'gift_card' END AS payment_method,
               CASE WHEN o_orderpriority[1] IN ('1', '2', '3') THEN 'online'
                    WHEN o_orderpriority[1] = '4' THEN 'in_store' ELSE 'mobile_app' END AS channel,
               CAST(1 + o_orderkey % 7 AS INTEGER) AS num_items,
               strftime(o_orderdate, '%Y-%m') AS year_month
        FROM orders""",
    "b_lines": """
        SELECT l_orderkey + CASE WHEN l_orderkey % 23 = 0 THEN 1000000000000 ELSE 0 END AS transaction_id,
               l_partkey + CASE WHEN l_partkey % 17 = 0 THEN 1000000000000 ELSE 0 END AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
               CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price,
               CAST(l_discount * 100 AS DECIMAL(5,2)) AS discount_percent,
               CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(3,2))) AS DECIMAL(12,2)) AS line_total
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "b_products": """
        SELECT product_id, product_sku, product_name, category, subcategory, brand, base_price,
               CAST(base_price * CAST(0.30 + 0.10 * (product_id % 5) AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS cost_price, is_active
        FROM (SELECT p_partkey AS product_id,
                     'SKU-' || upper(p_type[1:3]) || '-' || lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS product_sku,
                     p_name AS product_name, p_type AS category, p_name AS subcategory, p_brand AS brand,
                     CAST(CAST(p_retailprice AS DECIMAL(10,2)) * p_size * CAST(0.02 AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS base_price,
                     p_partkey % 20 <> 0 AS is_active
              FROM part)""",
    "b_customers": f"""
        SELECT c_custkey AS customer_id,
               CASE c_custkey % 10 WHEN 3 THEN '  CUST_' || c_custkey || '@EXAMPLE.COM ' WHEN 7 THEN 'bad-' || c_custkey
                    ELSE 'customer_' || c_custkey || '@example.com' END AS email,
               ' first_' || (c_custkey % 1000) AS first_name, 'LAST_' || (c_custkey % 5000) || ' ' AS last_name,
               CASE WHEN c_nationkey = 24 THEN 'zz' ELSE lower({STATES}[2 * c_nationkey + 1]) END AS state,
               CASE c_custkey % 4 WHEN 0 THEN '+1' || (2000000000 + c_custkey)
                    WHEN 1 THEN '(555) ' || lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') || '-0199'
                    WHEN 2 THEN CAST(c_custkey AS VARCHAR) END AS phone,
               c_mktsegment AS customer_segment, CAST(c_acctbal AS DECIMAL(10,2)) AS lifetime_value,
               DATE '1995-01-01' + CAST((c_custkey * 7) % 2400 AS INTEGER) AS registration_date,
               {AS_OF} - CAST((c_custkey * 11) % 365 AS INTEGER) AS last_purchase_date,
               c_custkey % 10 <> 0 AS is_active
        FROM customer""",
    "b_stores": f"""
        SELECT CAST(s_suppkey AS INTEGER) AS store_id, 'Store #' || s_suppkey AS store_name, {STATES}[s_suppkey % 50 + 1] AS state,
               CAST(CASE WHEN s_suppkey % 50 = 49 THEN 0 ELSE 5000 + (s_suppkey * 997) % 50000 END AS INTEGER) AS square_footage,
               s_suppkey % 20 <> 0 AS is_active
        FROM supplier""",
    "b_inventory": """
        SELECT product_id, warehouse_id, snapshot_date, quantity_on_hand,
               CAST((quantity_on_hand * 3) // 10 AS INTEGER) AS quantity_reserved,
               CAST(quantity_on_hand - (quantity_on_hand * 3) // 10 AS INTEGER) AS quantity_available, reorder_point
        FROM (SELECT p_partkey + CASE WHEN p_partkey % 13 = 0 THEN 1000000000000 ELSE 0 END AS product_id, r_regionkey AS warehouse_id, DATE '2001-07-30' + CAST(dn AS INTEGER) AS snapshot_date,
                     CAST(CASE WHEN p_partkey % 11 = 0 THEN 0 ELSE (p_partkey * 31 + r_regionkey * 17 + dn * 7) % 1000 END AS INTEGER) AS quantity_on_hand,
                     CAST(20 + (p_partkey * 13 + r_regionkey) % 100 AS INTEGER) AS reorder_point
              FROM part, region, range(3) days(dn))""",
    "clicks": """
        SELECT 'evt_' || event_id AS event_id, 'sess_' || user_id || '_' || strftime(ts, '%Y%m%d') AS session_id,
               CASE WHEN event_id % 10 >= 3 THEN user_id END AS customer_id,
               CASE event_type WHEN 'view' THEN 'product_view' WHEN 'click' THEN 'add_to_cart' WHEN 'purchase' THEN 'checkout_complete'
                    WHEN 'signup' THEN 'search' WHEN 'error' THEN 'page_view' END AS event_type,
               CASE WHEN event_id % 5 >= 2 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS product_id,
               '/page/' || (event_id % 1000) AS page_url,
               CASE WHEN event_id % 20 < 6 THEN 'google' WHEN event_id % 20 < 10 THEN 'facebook' WHEN event_id % 20 < 14 THEN 'direct'
                    WHEN event_id % 20 < 17 THEN 'email' ELSE 'other' END AS referrer,
               CASE WHEN event_id % 20 < 11 THEN 'mobile' WHEN event_id % 20 < 17 THEN 'desktop' ELSE 'tablet' END AS device_type,
               CAST(ts AS TIMESTAMP) AS event_timestamp, props AS event_properties
        FROM events""",
    "totals": """
        SELECT transaction_id, CAST(sum(line_total) AS DECIMAL(18,2)) AS calculated_total,
               CAST(sum(quantity) AS BIGINT) AS calculated_total_items, count(*) AS calculated_line_items,
               CAST(sum(discount_percent) AS DOUBLE) / count(discount_percent) AS calculated_avg_discount,
               max(discount_percent) AS calculated_max_discount
        FROM b_lines GROUP BY transaction_id""",
    "s_transactions": """
        SELECT b.*, calculated_total_items, calculated_line_items, calculated_avg_discount, calculated_max_discount,
               coalesce(calculated_total, 0) AS transaction_amount,
               CAST(hour(transaction_timestamp) AS INTEGER) AS transaction_hour,
               CAST(dayofweek(transaction_date) + 1 AS INTEGER) AS transaction_day_of_week,
               CAST(weekofyear(transaction_date) AS INTEGER) AS transaction_week,
               CAST(month(transaction_date) AS INTEGER) AS transaction_month,
               CAST(quarter(transaction_date) AS INTEGER) AS transaction_quarter,
               CAST(year(transaction_date) AS INTEGER) AS transaction_year,
               dayofweek(transaction_date) IN (0, 6) AS is_weekend,
               CASE WHEN hour(transaction_timestamp) BETWEEN 6 AND 11 THEN 'Morning'
                    WHEN hour(transaction_timestamp) BETWEEN 12 AND 17 THEN 'Afternoon'
                    WHEN hour(transaction_timestamp) BETWEEN 18 AND 21 THEN 'Evening' ELSE 'Night' END AS time_of_day,
               CASE WHEN coalesce(calculated_total, 0) < 25 THEN 'Small (<$25)'
                    WHEN coalesce(calculated_total, 0) < 100 THEN 'Medium ($25-$100)'
                    WHEN coalesce(calculated_total, 0) < 500 THEN 'Large ($100-$500)' ELSE 'XLarge ($500+)' END AS amount_bucket,
               calculated_line_items > 0 AS dq_has_items,
               coalesce(calculated_total, 0) > 0 AS dq_valid_amount,
               calculated_line_items = num_items AS dq_consistent_items
        FROM b_transactions b LEFT JOIN totals USING (transaction_id)""",
    "s_customers": f"""
        SELECT *, CASE WHEN tenure_days < 90 THEN 'New' WHEN tenure_days < 365 THEN 'Established'
                       WHEN tenure_days < 730 THEN 'Loyal' ELSE 'VIP' END AS tenure_category,
               CASE WHEN days_since_purchase < 30 THEN 'Active' WHEN days_since_purchase < 90 THEN 'Recent'
                    WHEN days_since_purchase < 180 THEN 'Lapsed' ELSE 'Dormant' END AS recency_category,
               (CAST(dq_valid_email AS INTEGER) + CAST(dq_valid_state AS INTEGER)) * 50.0::DOUBLE AS dq_score
        FROM (SELECT *, regexp_matches(email, '{EMAIL_PATTERN}') AS dq_valid_email, list_contains({STATES}, state) AS dq_valid_state
              FROM (SELECT customer_id, lower(trim(email)) AS email,
                           upper(trim(first_name)[1]) || lower(trim(first_name)[2:]) AS first_name,
                           upper(trim(last_name)[1]) || lower(trim(last_name)[2:]) AS last_name,
                           upper(trim(state)) AS state,
                           CASE length(regexp_replace(phone, '[^0-9]', '', 'g')) WHEN 11 THEN regexp_replace(phone, '[^0-9]', '', 'g')
                                WHEN 10 THEN '1' || regexp_replace(phone, '[^0-9]', '', 'g') END AS phone,
                           customer_segment, lifetime_value, registration_date, last_purchase_date, is_active,
                           CAST({AS_OF} - registration_date AS INTEGER) AS tenure_days,
                           CAST({AS_OF} - last_purchase_date AS INTEGER) AS days_since_purchase
                    FROM b_customers))""",
    "p_metrics": """
        SELECT product_id, count(*) AS times_sold, CAST(sum(quantity) AS BIGINT) AS units_sold,
               CAST(sum(line_total) AS DECIMAL(18,2)) AS total_revenue,
               CAST(sum(unit_price) AS DOUBLE) / count(unit_price) AS avg_selling_price,
               CAST(sum(discount_percent) AS DOUBLE) / count(discount_percent) AS avg_discount_given,
               count(DISTINCT transaction_id) AS unique_transactions
        FROM b_lines GROUP BY product_id""",
    "s_products": f"""
        SELECT product_id, product_sku, product_name, category, subcategory, brand, base_price, cost_price, is_active,
               coalesce(times_sold, 0) AS times_sold, coalesce(units_sold, 0) AS units_sold, coalesce(total_revenue, 0) AS total_revenue,
               avg_selling_price, avg_discount_given, coalesce(unique_transactions, 0) AS unique_transactions,
               {_half_up(_cents("base_price - cost_price") + " * 100", _cents("base_price"), 2)} AS profit_margin,
               CASE WHEN unique_transactions > 0 THEN CAST(total_revenue AS DOUBLE) / unique_transactions ELSE 0 END AS revenue_per_transaction,
               CASE WHEN unique_transactions > 0 THEN CAST(units_sold AS DOUBLE) / unique_transactions ELSE 0 END AS avg_units_per_transaction,
               CASE WHEN total_revenue >= 100000 THEN 'Platinum' WHEN total_revenue >= 50000 THEN 'Gold'
                    WHEN total_revenue >= 10000 THEN 'Silver' WHEN total_revenue > 0 THEN 'Bronze' ELSE 'New' END AS revenue_tier,
               CASE WHEN base_price >= 500 THEN 'Premium' WHEN base_price >= 100 THEN 'Mid-Range'
                    WHEN base_price >= 25 THEN 'Value' ELSE 'Budget' END AS price_tier
        FROM b_products LEFT JOIN p_metrics USING (product_id)""",
    "d_sales": """
        SELECT transaction_date, channel, store_id, count(*) AS transaction_count, sum(transaction_amount) AS gross_sales,
               CAST(sum(calculated_total_items) AS BIGINT) AS items_sold, count(DISTINCT customer_id) AS unique_customers,
               CAST(sum(transaction_amount) AS DOUBLE) / count(*) AS avg_transaction_value, max(transaction_amount) AS max_transaction_value,
               sum(CASE WHEN payment_method = 'credit_card' THEN transaction_amount ELSE 0 END) AS credit_card_sales,
               sum(CASE WHEN payment_method = 'digital_wallet' THEN transaction_amount ELSE 0 END) AS digital_wallet_sales
        FROM s_transactions WHERE transaction_type = 'purchase' GROUP BY ALL""",
    "d_returns": """
        SELECT transaction_date, channel, store_id, count(*) AS return_count, sum(transaction_amount) AS return_amount
        FROM s_transactions WHERE transaction_type = 'return' GROUP BY ALL""",
    "g_daily": f"""
        SELECT s.*, coalesce(return_count, 0) AS return_count, coalesce(return_amount, 0) AS return_amount,
               gross_sales - coalesce(return_amount, 0) AS net_sales,
               {_half_up("coalesce(return_count, 0) * 100", "transaction_count", 2)} AS return_rate,
               {_half_up("items_sold", "transaction_count", 2)} AS items_per_transaction
        FROM d_sales s LEFT JOIN d_returns r USING (transaction_date, channel, store_id)""",
    "c_history": """
        SELECT customer_id, count(*) AS total_transactions,
               count(*) FILTER (transaction_type = 'purchase') AS purchase_count,
               count(*) FILTER (transaction_type = 'return') AS return_count,
               sum(CASE WHEN transaction_type = 'purchase' THEN transaction_amount ELSE 0 END) AS total_spend,
               CAST(sum(transaction_amount) FILTER (transaction_type = 'purchase') AS DOUBLE)
                   / count(*) FILTER (transaction_type = 'purchase') AS avg_order_value,
               max(transaction_amount) FILTER (transaction_type = 'purchase') AS max_order_value,
               CAST(sum(calculated_total_items) AS BIGINT) AS total_items_purchased,
               min(transaction_date) AS first_transaction_date, max(transaction_date) AS last_transaction_date,
               count(DISTINCT store_id) AS stores_visited, count(DISTINCT channel) AS channels_used,
               count(*) FILTER (channel = 'online') AS online_orders, count(*) FILTER (channel = 'in_store') AS instore_orders,
               count(*) FILTER (channel = 'mobile_app') AS mobile_orders,
               count(*) FILTER (payment_method = 'credit_card') AS credit_card_transactions,
               count(*) FILTER (payment_method = 'digital_wallet') AS digital_wallet_transactions
        FROM s_transactions GROUP BY customer_id""",
    "c360": f"""
        SELECT *, CASE WHEN rfm_score >= 13 THEN 'Champions' WHEN rfm_score >= 10 THEN 'Loyal' WHEN rfm_score >= 7 THEN 'Potential'
                       WHEN rfm_score >= 4 THEN 'At Risk' ELSE 'Lost' END AS value_segment,
               CASE WHEN online_orders >= greatest(instore_orders, mobile_orders) THEN 'Online'
                    WHEN instore_orders >= greatest(online_orders, mobile_orders) THEN 'In-Store'
                    WHEN mobile_orders > 0 THEN 'Mobile' ELSE 'Unknown' END AS preferred_channel,
               CASE WHEN purchase_count > 0 THEN {_half_up("return_count * 100", "purchase_count", 2)} ELSE 0 END AS return_rate,
               {_half_up(_cents("total_spend") + " * frequency_score * 12", "purchase_count * 100", 2)} AS predicted_ltv
        FROM (SELECT *, CAST(recency_score + frequency_score + monetary_score AS INTEGER) AS rfm_score
              FROM (SELECT c.*, coalesce(total_transactions, 0) AS total_transactions, coalesce(purchase_count, 0) AS purchase_count,
                           coalesce(return_count, 0) AS return_count, coalesce(total_spend, 0) AS total_spend, avg_order_value,
                           max_order_value, coalesce(total_items_purchased, 0) AS total_items_purchased, first_transaction_date,
                           last_transaction_date, stores_visited, channels_used, online_orders, instore_orders, mobile_orders,
                           credit_card_transactions, digital_wallet_transactions,
                           CASE WHEN days_since_purchase <= 30 THEN 5 WHEN days_since_purchase <= 60 THEN 4
                                WHEN days_since_purchase <= 90 THEN 3 WHEN days_since_purchase <= 180 THEN 2 ELSE 1 END AS recency_score,
                           CASE WHEN purchase_count >= 20 THEN 5 WHEN purchase_count >= 10 THEN 4
                                WHEN purchase_count >= 5 THEN 3 WHEN purchase_count >= 2 THEN 2 ELSE 1 END AS frequency_score,
                           CASE WHEN total_spend >= 5000 THEN 5 WHEN total_spend >= 2000 THEN 4
                                WHEN total_spend >= 500 THEN 3 WHEN total_spend >= 100 THEN 2 ELSE 1 END AS monetary_score
                    FROM s_customers c LEFT JOIN c_history USING (customer_id)))""",
    "pp_agg": """
        SELECT product_id, CAST(sum(quantity) AS BIGINT) AS total_units_sold, sum(line_total) AS total_revenue,
               CAST(sum(unit_price) AS DOUBLE) / count(unit_price) AS avg_selling_price,
               CAST(sum(discount_percent) AS DOUBLE) / count(discount_percent) AS avg_discount, count(*) AS times_purchased,
               count(DISTINCT transaction_id) AS unique_transactions, count(DISTINCT customer_id) AS unique_customers,
               sum(CASE WHEN channel = 'online' THEN line_total ELSE 0 END) AS online_revenue,
               sum(CASE WHEN channel = 'in_store' THEN line_total ELSE 0 END) AS instore_revenue,
               sum(CASE WHEN channel = 'mobile_app' THEN line_total ELSE 0 END) AS mobile_revenue,
               min(transaction_date) AS first_sale_date, max(transaction_date) AS last_sale_date
        FROM b_lines JOIN s_transactions USING (transaction_id) GROUP BY product_id""",
    "g_products": f"""
        SELECT *, CASE WHEN category_revenue_rank <= 10 AND sales_velocity > 1 THEN 'Star' WHEN category_revenue_rank <= 50 THEN 'Strong'
                       WHEN total_units_sold > 0 THEN 'Average' ELSE 'Underperformer' END AS performance_class
        FROM (SELECT *, CASE WHEN days_since_first_sale > 0 THEN CAST(total_units_sold AS DOUBLE) / days_since_first_sale ELSE 0 END AS sales_velocity,
                     CASE WHEN unique_customers > 0 THEN CAST(total_revenue AS DOUBLE) / unique_customers ELSE 0 END AS revenue_per_customer,
                     row_number() OVER (PARTITION BY category ORDER BY total_revenue DESC NULLS LAST, product_id) AS category_revenue_rank,
                     row_number() OVER (PARTITION BY category ORDER BY total_units_sold DESC NULLS LAST, product_id) AS category_units_rank
              FROM (SELECT p.* EXCLUDE (total_revenue, avg_selling_price, avg_discount_given, unique_transactions),
                           coalesce(total_units_sold, 0) AS total_units_sold, coalesce(a.total_revenue, 0) AS total_revenue,
                           a.avg_selling_price, avg_discount, times_purchased, a.unique_transactions,
                           coalesce(unique_customers, 0) AS unique_customers, online_revenue, instore_revenue, mobile_revenue,
                           first_sale_date, last_sale_date, CAST({AS_OF} - first_sale_date AS INTEGER) AS days_since_first_sale
                    FROM s_products p LEFT JOIN pp_agg a USING (product_id)))""",
    "st_metrics": """
        SELECT store_id, count(*) AS total_transactions,
               sum(CASE WHEN transaction_type = 'purchase' THEN transaction_amount ELSE 0 END) AS total_revenue,
               count(DISTINCT customer_id) AS unique_customers, CAST(sum(transaction_amount) AS DOUBLE) / count(*) AS avg_transaction_value,
               count(DISTINCT transaction_date) AS active_days, count(*) FILTER (is_weekend) AS weekend_transactions,
               count(*) FILTER (NOT is_weekend) AS weekday_transactions,
               count(*) FILTER (channel = 'online') AS online_transactions, count(*) FILTER (channel = 'in_store') AS instore_transactions
        FROM s_transactions GROUP BY store_id""",
    "g_stores": """
        SELECT *, CASE WHEN revenue_rank <= 50 THEN 'Top Performer' WHEN revenue_rank <= 200 THEN 'Above Average'
                       WHEN revenue_rank <= 350 THEN 'Average' ELSE 'Below Average' END AS performance_tier
        FROM (SELECT *, row_number() OVER (ORDER BY total_revenue DESC NULLS LAST, store_id) AS revenue_rank,
                     row_number() OVER (ORDER BY revenue_per_sqft DESC NULLS LAST, store_id) AS efficiency_rank
              FROM (SELECT *, CASE WHEN square_footage > 0 THEN CAST(total_revenue AS DOUBLE) / square_footage ELSE 0 END AS revenue_per_sqft,
                           CASE WHEN square_footage > 0 THEN CAST(unique_customers AS DOUBLE) / square_footage ELSE 0 END AS customers_per_sqft,
                           CASE WHEN active_days > 0 THEN CAST(total_revenue AS DOUBLE) / active_days ELSE 0 END AS avg_daily_revenue,
                           CASE WHEN total_transactions > 0 THEN weekend_transactions * 100.0::DOUBLE / total_transactions ELSE 0 END AS weekend_ratio
                    FROM (SELECT s.*, coalesce(total_transactions, 0) AS total_transactions, coalesce(total_revenue, 0) AS total_revenue,
                                 coalesce(unique_customers, 0) AS unique_customers, avg_transaction_value, active_days, weekend_transactions,
                                 weekday_transactions, online_transactions, instore_transactions
                          FROM b_stores s LEFT JOIN st_metrics USING (store_id))))""",
    "tags": "SELECT * FROM (VALUES " + ", ".join(
        "(" + ", ".join("NULL" if v is None else f"'{v}'" for v in row) + ")" for row in TAGS
    ) + ") t(schema_name, table_name, column_name, tag_name, tag_value)",
    "tagged_sizes": """
        SELECT 'gold' AS schema_name, 'customer_360' AS table_name, count(*) AS row_count FROM c360
        UNION ALL SELECT 'gold', 'daily_sales_summary', count(*) FROM g_daily
        UNION ALL SELECT 'gold', 'product_performance', count(*) FROM g_products
        UNION ALL SELECT 'gold', 'store_analytics', count(*) FROM g_stores
        UNION ALL SELECT 'silver', 'customers', count(*) FROM s_customers""",
    "layer_sizes": """
        SELECT 'bronze' AS layer, 'customers' AS table_name, count(*) AS row_count FROM b_customers
        UNION ALL SELECT 'bronze', 'products', count(*) FROM b_products
        UNION ALL SELECT 'bronze', 'stores', count(*) FROM b_stores
        UNION ALL SELECT 'bronze', 'warehouses', count(*) FROM region
        UNION ALL SELECT 'bronze', 'transactions', count(*) FROM b_transactions
        UNION ALL SELECT 'bronze', 'transaction_line_items', count(*) FROM b_lines
        UNION ALL SELECT 'bronze', 'inventory_snapshots', count(*) FROM b_inventory
        UNION ALL SELECT 'silver', 'customers', count(*) FROM s_customers
        UNION ALL SELECT 'silver', 'transactions', count(*) FROM s_transactions
        UNION ALL SELECT 'silver', 'products', count(*) FROM s_products
        UNION ALL SELECT 'gold', 'daily_sales_summary', count(*) FROM g_daily
        UNION ALL SELECT 'gold', 'customer_360', count(*) FROM c360
        UNION ALL SELECT 'gold', 'product_performance', count(*) FROM g_products
        UNION ALL SELECT 'gold', 'store_analytics', count(*) FROM g_stores
        UNION ALL SELECT 'gold', 'mv_executive_summary', count(*) FROM weekly
        UNION ALL SELECT 'gold', 'mv_category_performance', count(*) FROM by_category""",
    "weekly": f"""
        SELECT CAST(date_trunc('week', transaction_date) AS DATE) AS week_start, CAST(sum(net_sales) AS DOUBLE) AS weekly_revenue,
               CAST(sum(transaction_count) AS BIGINT) AS weekly_transactions, CAST(sum(unique_customers) AS BIGINT) AS weekly_customers,
               {_fine_mean("avg_transaction_value")} AS avg_order_value, CAST(sum(return_amount) AS DOUBLE) AS weekly_returns,
               CAST(sum(CAST(return_rate AS DECIMAL(5,2))) AS DOUBLE) / count(return_rate) AS avg_return_rate
        FROM g_daily GROUP BY 1""",
    "by_category": f"""
        SELECT category, count(*) AS product_count, CAST(sum(total_units_sold) AS BIGINT) AS total_units,
               CAST(sum(total_revenue) AS DOUBLE) AS total_revenue, {_fine_mean("avg_selling_price")} AS avg_price,
               CAST(sum(unique_customers) AS BIGINT) AS total_customers
        FROM g_products GROUP BY category""",
    "recent_before": f"""
        SELECT customer_id, count(*) AS purchases, CAST(sum(transaction_amount) AS DOUBLE) AS spend FROM s_transactions
        WHERE transaction_type = 'purchase' AND customer_id IS NOT NULL
          AND transaction_date <= {AS_OF} - 45 GROUP BY customer_id""",
    "recent_now": f"""
        SELECT customer_id, count(*) AS purchases, CAST(sum(transaction_amount) AS DOUBLE) AS spend FROM s_transactions
        WHERE transaction_type = 'purchase' AND customer_id IS NOT NULL
          AND transaction_date <= {AS_OF} AND customer_id NOT IN (SELECT customer_id FROM b_customers WHERE NOT is_active)
        GROUP BY customer_id""",
    "per_minute": """
        SELECT time_bucket(INTERVAL 1 MINUTE, event_timestamp) + INTERVAL 1 MINUTE AS timestamp, count(*) AS events_per_minute,
               count(*) FILTER (event_type = 'checkout_complete') AS conversions
        FROM clicks GROUP BY 1""",
    "marked_customers": """
        SELECT *, concat_ws(',', CASE WHEN customer_id IS NULL THEN 'customer_id_not_null' END,
                                 CASE WHEN NOT (dq_score >= 0 AND dq_score <= 100) THEN 'valid_dq_score' END,
                                 CASE WHEN NOT dq_valid_email THEN 'valid_email' END,
                                 CASE WHEN NOT dq_valid_state THEN 'valid_state' END) AS failed_rules
        FROM s_customers""",
}

_NAMES = re.compile(r"\b(" + "|".join(CTES) + r")\b")


def _sql(statement: str) -> str:
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in dict.fromkeys(_NAMES.findall(text)):
            if name not in needed:
                visit(CTES[name])
                if name not in needed:
                    needed.append(name)

    visit(statement)
    if not needed:
        return statement.strip()
    head = ",\n".join(f"{name} AS ({CTES[name]})" for name in needed)
    body = statement.strip()
    own_ctes = body.removeprefix("WITH ")
    return f"WITH {head}" + (f",\n{own_ctes}" if own_ctes != body else f"\n{body}")


_DOUBLES = {
    "s_transactions": ["transaction_amount", "calculated_max_discount"],
    "s_products": ["base_price", "cost_price", "total_revenue"],
    "s_customers": ["lifetime_value"],
    "totals": ["calculated_total", "calculated_max_discount"],
    "p_metrics": ["total_revenue"],
    "d_sales": ["gross_sales", "max_transaction_value", "credit_card_sales", "digital_wallet_sales"],
    "d_returns": ["return_amount"],
    "g_daily": ["gross_sales", "max_transaction_value", "credit_card_sales", "digital_wallet_sales", "return_amount", "net_sales"],
    "c_history": ["total_spend", "max_order_value"],
    "c360": ["lifetime_value", "total_spend", "max_order_value"],
    "pp_agg": ["total_revenue", "online_revenue", "instore_revenue", "mobile_revenue"],
    "g_products": ["base_price", "cost_price", "total_revenue", "online_revenue", "instore_revenue", "mobile_revenue"],
    "st_metrics": ["total_revenue"],
    "g_stores": ["total_revenue"],
}


def _whole(cte: str, where: str = "", extra: str = "") -> str:
    """All rows and columns of a definition, money as double."""
    swap = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _DOUBLES[cte])
    return f"SELECT * REPLACE ({swap}){extra} FROM {cte} {where}"


_CALENDAR = """, CAST(dayofweek(transaction_date) + 1 AS INTEGER) AS day_of_week, CAST(weekofyear(transaction_date) AS INTEGER) AS week_of_year,
    CAST(month(transaction_date) AS INTEGER) AS month, CAST(quarter(transaction_date) AS INTEGER) AS quarter,
    CAST(year(transaction_date) AS INTEGER) AS year, dayofweek(transaction_date) IN (0, 6) AS is_weekend"""


def _violation(table: str, check: str, source: str) -> str:
    return f"SELECT '{table}' AS table_name, '{check}' AS check_type, count(*) AS violation_count FROM {source}"


def _constraint(name: str, table: str, broken: str) -> str:
    return f"SELECT '{name}' AS \"constraint\", count(*) AS checked_rows, count(*) FILTER ({broken}) AS violations FROM {table}"


def _column_stats(table: str, columns: list[str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count, CAST(min({c}) AS VARCHAR) AS min_value, "
        f"CAST(max({c}) AS VARCHAR) AS max_value, CAST(sum(length(CAST({c} AS VARCHAR))) AS DOUBLE) / count({c}) AS avg_length, "
        f"max(length(CAST({c} AS VARCHAR))) AS max_length, count(DISTINCT {c}) AS distinct_count, true AS approx_ok FROM {table}" for c in columns)


def _z_key(columns: list[str], bits: int = 8) -> str:
    lows = ", ".join(f"min({c}) AS lo{i}, max({c}) AS hi{i}" for i, c in enumerate(columns))
    parts = [
        f"((coalesce((({c} - lo{j}) * {1 << bits}) // (hi{j} - lo{j} + 1), 0) >> {i}) & 1) << {i * len(columns) + j}"
        for j, c in enumerate(columns) for i in range(bits)
    ]
    return f"""SELECT transaction_id, customer_id, store_id, CAST({" | ".join(f"CAST({p} AS BIGINT)" for p in parts)} AS BIGINT) AS z_key
        FROM b_transactions, (SELECT {lows} FROM b_transactions)"""


_STATEMENTS = {
    "silver_customers": _whole("s_customers"),
    "dq_summary": """SELECT count(*) AS total_records, count(*) FILTER (dq_valid_email) AS valid_emails, count(*) FILTER (dq_valid_state) AS valid_states,
        avg(dq_score) AS avg_dq_score, count(*) FILTER (dq_valid_email) * 100.0::DOUBLE / count(*) AS valid_email_pct,
        count(*) FILTER (dq_valid_state) * 100.0::DOUBLE / count(*) AS valid_state_pct FROM s_customers""",
    "transaction_totals": _whole("totals"),
    "silver_transactions": _whole("s_transactions"),
    "product_metrics": _whole("p_metrics"),
    "silver_products": _whole("s_products"),
    "daily_sales": _whole("d_sales"),
    "daily_returns": _whole("d_returns"),
    "gold_daily_sales": _whole("g_daily", extra=_CALENDAR),
    "customer_transactions": _whole("c_history"),
    "customer_360": _whole("c360"),
    "product_performance_agg": _whole("pp_agg"),
    "product_performance": _whole("g_products"),
    "store_metrics": _whole("st_metrics"),
    "store_analytics": _whole("g_stores"),
    "sales_summary_day_product_store": f"""SELECT transaction_date, product_id, store_id, CAST(sum(quantity) AS BIGINT) AS units_sold,
        {_money("sum(line_total)", "revenue")}, count(DISTINCT transaction_id) AS transaction_count
        FROM b_lines JOIN s_transactions USING (transaction_id) WHERE transaction_type = 'purchase' GROUP BY 1, 2, 3""",
    "inventory_status": """SELECT product_id, warehouse_id, snapshot_date, quantity_on_hand, quantity_reserved, quantity_available, reorder_point,
        quantity_available <= reorder_point AS needs_reorder FROM b_inventory WHERE snapshot_date = (SELECT max(snapshot_date) FROM b_inventory)""",
    "latest_snapshot": "SELECT * FROM b_inventory WHERE snapshot_date = (SELECT max(snapshot_date) FROM b_inventory)",
    "sales_trend": f"""SELECT transaction_date, channel, CAST(daily_revenue AS DOUBLE) AS daily_revenue, revenue_7day_avg, revenue_30day_avg,
        CAST(revenue_yoy AS DOUBLE) AS revenue_yoy, {_half_up(_cents("daily_revenue - revenue_yoy") + " * 100", _cents("revenue_yoy"), 2)} AS yoy_growth_pct
        FROM (SELECT *, CAST(sum(daily_revenue) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS DOUBLE) / count(*) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS revenue_7day_avg,
                     CAST(sum(daily_revenue) OVER (w ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS DOUBLE) / count(*) OVER (w ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS revenue_30day_avg,
                     lag(daily_revenue, 365) OVER w AS revenue_yoy
              FROM (SELECT transaction_date, channel, CAST(sum(transaction_amount) AS DECIMAL(18,2)) AS daily_revenue FROM s_transactions
                    WHERE transaction_type = 'purchase' GROUP BY 1, 2)
              WINDOW w AS (PARTITION BY channel ORDER BY transaction_date))
        WHERE transaction_date >= {AS_OF} - 90 ORDER BY transaction_date DESC, channel LIMIT 100""",
    "cohort_retention": f"""WITH buys AS (SELECT DISTINCT customer_id AS who, 12 * year(transaction_date) + month(transaction_date) - 1 AS m
            FROM s_transactions WHERE transaction_type = 'purchase' AND customer_id IS NOT NULL),
        ages AS (SELECT *, min(m) OVER (PARTITION BY who) AS born FROM buys),
        life AS (SELECT born, m - born AS age, count(*) AS alive FROM ages GROUP BY ALL),
        sized AS (SELECT *, max(alive) FILTER (age = 0) OVER (PARTITION BY born) AS members, make_date(born // 12, born % 12 + 1, 1) AS first_day FROM life)
        SELECT first_day AS cohort_month, members AS cohort_customers, CAST(age AS DOUBLE) AS months_since_cohort, alive AS active_customers,
               {_half_up("alive * 100", "members", 2)} AS retention_rate
        FROM sized WHERE age <= 12 AND first_day >= {AS_OF} - 3650""",
    "market_basket": """WITH lists AS (SELECT list(DISTINCT product_id) AS items FROM b_lines SEMI JOIN b_products USING (product_id) GROUP BY transaction_id),
        firsts AS (SELECT unnest(items) AS x, items FROM lists),
        seen AS (SELECT x, count(*) AS n FROM firsts GROUP BY x),
        pairs AS (SELECT x, y, count(*) AS both_n FROM (SELECT x, unnest(list_filter(items, LAMBDA z: z > x)) AS y FROM firsts) GROUP BY x, y)
        SELECT pairs.x AS product_a, pa.category AS category_a, pairs.y AS product_b, pb.category AS category_b, both_n AS co_occurrence_count,
               sa.n AS product_a_count, sb.n AS product_b_count,
               round(both_n * 100.0::DOUBLE / least(sa.n, sb.n), 2) AS confidence, round(both_n * 1000000.0::DOUBLE / (sa.n * sb.n), 4) AS lift
        FROM pairs JOIN seen sa ON sa.x = pairs.x JOIN seen sb ON sb.x = pairs.y
             JOIN b_products pa ON pa.product_id = pairs.x JOIN b_products pb ON pb.product_id = pairs.y
        WHERE both_n >= 3 ORDER BY lift DESC, product_a, product_b LIMIT 50""",
    "inventory_optimization": f"""WITH newest AS (SELECT * FROM b_inventory QUALIFY snapshot_date = max(snapshot_date) OVER ()),
        figures AS (SELECT p.product_id, product_name, category, base_price,
               (SELECT sum(quantity) FROM b_lines l SEMI JOIN (SELECT * FROM b_transactions WHERE transaction_type = 'purchase' AND transaction_date >= {AS_OF} - 30) t
                    USING (transaction_id) WHERE l.product_id = p.product_id) AS sold,
               (SELECT sum(quantity_available) FROM newest i WHERE i.product_id = p.product_id) AS available,
               (SELECT avg(reorder_point) FROM newest i WHERE i.product_id = p.product_id) AS reorder_at,
               (SELECT count(*) FROM newest i WHERE i.product_id = p.product_id) AS sites
            FROM b_products p WHERE is_active)
        SELECT product_id, product_name, category, CAST(base_price AS DOUBLE) AS base_price, CAST(coalesce(sold, 0) AS BIGINT) AS units_sold_30d,
               CAST(coalesce(available, 0) AS BIGINT) AS inventory_available, nullif(sites, 0) AS warehouse_count,
               coalesce(CASE WHEN sold > 0 THEN {_half_up("available * 30", "sold", 1)} END, CASE WHEN sold > 0 THEN NULL ELSE 999 END) AS days_of_inventory,
               CASE WHEN coalesce(available, 0) = 0 THEN 'OUT_OF_STOCK' WHEN reorder_at > available THEN 'LOW_STOCK'
                    WHEN sold > available THEN 'REORDER_SOON' ELSE 'HEALTHY' END AS stock_status,
               {_half_up("coalesce(sold, 0) * " + _cents("base_price") + " * 7", "3000", 2)} AS weekly_revenue_at_risk
        FROM figures ORDER BY weekly_revenue_at_risk DESC, product_id LIMIT 100""",
    "mv_executive_summary": "SELECT * FROM weekly",
    "mv_category_performance": "SELECT * FROM by_category",
    "bench_simple_agg": f"SELECT channel, count(*) AS transaction_count, {_money('sum(transaction_amount)', 'revenue')} FROM s_transactions GROUP BY channel",
    "bench_date_range": f"""SELECT transaction_date, count(*) AS transaction_count, {_money('sum(transaction_amount)', 'revenue')} FROM s_transactions
        WHERE transaction_date >= {AS_OF} - 30 GROUP BY transaction_date""",
    "bench_large_join": f"""SELECT customer_segment, count(DISTINCT customer_id) AS unique_customers, {_money('sum(transaction_amount)', 'revenue')}
        FROM b_customers JOIN (FROM s_transactions WHERE transaction_type = 'purchase') USING (customer_id) GROUP BY ALL""",
    "bench_multi_join": f"""SELECT category, customer_segment, channel, count(*) AS transactions, {_money('sum(line_total)', 'revenue')}
        FROM b_customers JOIN b_transactions USING (customer_id) JOIN b_lines USING (transaction_id) JOIN b_products USING (product_id)
        WHERE {AS_OF} - transaction_date <= 90 GROUP BY ALL""",
    "mix_count": "SELECT count(*) AS transaction_count FROM s_transactions",
    "mix_channel_sum": f"SELECT channel, {_money('sum(transaction_amount)', 'revenue')} FROM s_transactions GROUP BY channel",
    "mix_segment_count": "SELECT customer_segment, count(*) AS customer_count FROM s_customers GROUP BY 1",
    "mix_category_revenue": f"SELECT category, {_money('sum(total_revenue)', 'total_revenue')} FROM g_products GROUP BY category",
    "mix_valid_state_count": "SELECT state, count(*) AS customer_count FROM s_customers WHERE dq_valid_state GROUP BY state",
    "mix_segment_avg_spend": """SELECT value_segment, count(*) AS customer_count, CAST(sum(total_spend) AS DOUBLE) / count(*) AS avg_spend
        FROM c360 GROUP BY value_segment""",
    "mix_tier_count": "SELECT performance_tier, count(*) AS store_count FROM g_stores GROUP BY performance_tier",
    "kpi_daily_revenue": f"""SELECT transaction_date, {_money('sum(net_sales)', 'total_revenue')}, CAST(sum(transaction_count) AS BIGINT) AS total_transactions,
        CAST(sum(unique_customers) AS BIGINT) AS unique_customers, {_half_up(_cents("sum(net_sales)"), "sum(transaction_count) * 100", 2)} AS avg_order_value
        FROM g_daily WHERE transaction_date >= {AS_OF} - 30 GROUP BY transaction_date""",
    "kpi_segment_performance": f"""SELECT value_segment, count(*) AS customer_count, {_half_up(_cents("sum(total_spend)"), "count(*) * 100", 2)} AS avg_spend,
        {_fine_mean_2("avg_order_value")} AS avg_order_value, {_half_up("sum(rfm_score)", "count(*)", 2)} AS avg_rfm_score,
        {_fine_mean_2("return_rate")} AS avg_return_rate FROM c360 GROUP BY value_segment""",
    "kpi_top_products": """SELECT product_id, product_name, category, CAST(total_revenue AS DOUBLE) AS total_revenue, total_units_sold, unique_customers,
        performance_class, category_revenue_rank FROM g_products WHERE performance_class IN ('Star', 'Strong')
        ORDER BY g_products.total_revenue DESC, product_id LIMIT 100""",
    "kpi_store_by_state": f"""SELECT state, count(*) AS store_count, {_money('sum(total_revenue)', 'total_revenue')},
        {_fine_mean_2("revenue_per_sqft")} AS avg_revenue_per_sqft, {_fine_mean_2("avg_daily_revenue")} AS avg_daily_revenue
        FROM g_stores GROUP BY state""",
    "dq_null_customer": _violation("silver.transactions", "NULL customer_id", "s_transactions WHERE customer_id IS NULL"),
    "dq_negative_amount": _violation("silver.transactions", "Negative amount", "s_transactions WHERE transaction_amount < 0"),
    "dq_orphan_line_items": _violation("bronze.transaction_line_items", "Orphaned records",
        "b_lines ANTI JOIN b_transactions USING (transaction_id)"),
    "dq_customer_summary": f"""SELECT 'silver.customers' AS table_name, {_half_up("sum(dq_score)", "count(*)", 2)} AS avg_dq_score,
        count(*) FILTER (dq_valid_email) AS valid_emails, count(*) FILTER (dq_valid_state) AS valid_states, count(*) AS total_records FROM s_customers""",
    "check_constraints": "\nUNION ALL ".join([
        _constraint("customer_id_not_null", "s_customers", "customer_id IS NULL"),
        _constraint("valid_dq_score", "s_customers", "NOT (dq_score >= 0 AND dq_score <= 100)"),
        _constraint("valid_email", "s_customers", "NOT dq_valid_email"),
        _constraint("valid_state", "s_customers", "NOT dq_valid_state"),
        _constraint("positive_amount", "s_transactions", "NOT transaction_amount >= 0"),
        _constraint("consistent_items", "s_transactions", "NOT dq_consistent_items"),
        _constraint("customer_known", "s_transactions", "customer_id IS NULL"),
    ]),
    "quarantine_split": "SELECT customer_id, email, state, failed_rules, failed_rules = '' AS is_ok FROM marked_customers",
    "dq_pass_rate": """SELECT count(*) AS total_rows, count(*) FILTER (failed_rules = '') AS passed_rows,
        count(*) FILTER (failed_rules = '') * 100.0::DOUBLE / count(*) AS pass_rate,
        count(*) FILTER (failed_rules = '') * 100.0::DOUBLE / count(*) >= 99 AS meets_target FROM marked_customers""",
    "dq_timeliness": """SELECT table_name, latest, epoch_us(TIMESTAMP '2024-01-31' - latest) / 3600000000.0::DOUBLE AS lag_hours,
        epoch_us(TIMESTAMP '2024-01-31' - latest) / 3600000000.0::DOUBLE > 24 AS is_late FROM (
        SELECT 'bronze.transactions' AS table_name, max(transaction_timestamp) AS latest FROM b_transactions
        UNION ALL SELECT 'bronze.clickstream_events', max(event_timestamp) FROM clicks)""",
    "column_stats": _column_stats("b_transactions", ["transaction_id", "customer_id", "store_id", "transaction_date", "transaction_timestamp", "transaction_type",
                                                     "payment_method", "channel", "num_items", "year_month"]),
    "dedup_latest": """SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey,
        l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) = 1""",
    "layer_row_counts": "SELECT layer, table_name, row_count FROM layer_sizes",
    "catalog_counts": "SELECT layer, count(*) AS table_count, CAST(sum(row_count) AS BIGINT) AS total_rows FROM layer_sizes GROUP BY layer",
    "freshness_report": """SELECT 'bronze.transactions' AS table_name, count(*) AS row_count, CAST(max(transaction_date) AS TIMESTAMP) AS latest FROM b_transactions
        UNION ALL SELECT 'bronze.clickstream_events', count(*), CAST(CAST(max(event_timestamp) AS DATE) AS TIMESTAMP) FROM clicks
        UNION ALL SELECT 'bronze.inventory_snapshots', count(*), CAST(max(snapshot_date) AS TIMESTAMP) FROM b_inventory
        UNION ALL SELECT 'gold.realtime_dashboard', count(*), max(timestamp) FROM per_minute""",
    "run_sla_report": """SELECT *, (end_time - start_time) / 1000.0::DOUBLE AS duration_seconds, (end_time - start_time) / 1000.0::DOUBLE > 7200 AS sla_breach
        FROM (SELECT event_id AS run_id, event_type AS job, epoch_us(ts) // 1000 AS start_time,
                     epoch_us(ts) // 1000 + CAST(round(value * 60000) AS BIGINT) AS end_time,
                     CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS result_state FROM events)""",
    "latency_summary": """SELECT event_type AS query, count(*) AS runs, CAST(sum(CAST(value AS DECIMAL(18,6))) AS DOUBLE) / count(*) AS avg_elapsed,
        min(value) AS min_elapsed, max(value) AS max_elapsed, list_sort(list(value))[count(*) * 95 // 100 + 1] AS p95_elapsed FROM events GROUP BY event_type""",
    "sink_overwrite_append": """SELECT year_month, transaction_type, count(*) AS row_count, max(transaction_date) AS last_day FROM b_transactions GROUP BY 1, 2""",
    "sql_over_views": f"""SELECT channel, payment_method, count(*) AS transaction_count, {_money('sum(transaction_amount)', 'revenue')}
        FROM s_transactions WHERE transaction_type = 'purchase' GROUP BY 1, 2""",
    "schema_merge": """SELECT transaction_id, transaction_date, CASE WHEN transaction_date < DATE '1998-01-01' THEN channel END AS channel,
        CASE WHEN transaction_date >= DATE '1998-01-01' THEN payment_method END AS payment_method,
        CASE WHEN transaction_date >= DATE '1998-01-01' THEN store_id END AS store_id FROM b_transactions""",
    "schema_validate": r"""SELECT customer_id, phone IS NULL OR regexp_full_match(phone, '[0-9]+') AS is_valid,
        CASE WHEN regexp_full_match(phone, '[0-9]+') THEN CAST(CASE WHEN regexp_full_match(phone, '[0-9]+') THEN phone END AS BIGINT) END AS phone,
        CASE WHEN phone IS NOT NULL AND NOT regexp_full_match(phone, '[0-9]+')
             THEN '{"customer_id": ' || customer_id || ', "phone": ' || phone || '}' END AS rejected_line FROM b_customers""",
    "calendar_spine": f"""WITH x AS (SELECT transaction_date AS d, count(*) AS c, sum(transaction_amount) AS r FROM s_transactions
            GROUP BY 1)
        SELECT CAST(day AS DATE) AS transaction_date, coalesce(c, 0) AS transaction_count, {_money('coalesce(r, 0)', 'revenue')}
        FROM (SELECT unnest(generate_series((SELECT min(d) FROM x), (SELECT max(d) FROM x), INTERVAL 1 DAY)) AS day) LEFT JOIN x ON d = CAST(day AS DATE)""",
    "inventory_grid": """SELECT p_partkey AS product_id, r_regionkey AS warehouse_id, day AS snapshot_date,
        coalesce(quantity_on_hand, 0) AS quantity_on_hand, coalesce(quantity_available, 0) AS quantity_available
        FROM (SELECT p_partkey, r_regionkey, DATE '2001-07-30' + CAST(dn AS INTEGER) AS day FROM part, region, range(3) days(dn))
        LEFT JOIN b_inventory ON product_id = p_partkey AND warehouse_id = r_regionkey AND snapshot_date = day""",
    "expand_rows": """SELECT o_orderkey AS transaction_id, CAST(o_orderkey % 5 AS INTEGER) AS num_items, CAST(unnest(range(1, o_orderkey % 5 + 1)) AS INTEGER) AS item_seq FROM orders""",
    "hash_bucket_split": """SELECT c_custkey AS customer_id, CASE WHEN c_custkey % 100 < 5 THEN 'VIP' WHEN c_custkey % 100 < 20 THEN 'Premium'
        WHEN c_custkey % 100 < 50 THEN 'Regular' ELSE 'New' END AS segment FROM customer""",
    "surrogate_key": "SELECT o_orderkey, 'evt_' || sha256(CAST(o_orderkey AS VARCHAR))[1:16] AS order_sk FROM orders",
    "string_standardize": """SELECT customer_id, lower(trim(email)) AS email, upper(trim(first_name)[1]) || lower(trim(first_name)[2:]) AS first_name,
        upper(trim(last_name)) AS last_name, CAST(length(email) AS INTEGER) AS email_length, trim(email)[1:3] AS email_prefix,
        string_split(trim(email), '@')[2] AS email_domain, regexp_replace(phone, '[^0-9]', '', 'g') AS digits, right(phone, 4) AS phone_end,
        trim(first_name) || ' ' || trim(last_name) AS full_name, regexp_matches(trim(email), '^[a-z_0-9]+@') AS plain_email FROM b_customers""",
    "date_parts": f"""SELECT transaction_id, CAST(hour(transaction_timestamp) AS INTEGER) AS hour, CAST(dayofweek(transaction_date) + 1 AS INTEGER) AS day_of_week,
        CAST(weekofyear(transaction_date) AS INTEGER) AS week, CAST(month(transaction_date) AS INTEGER) AS month, CAST(quarter(transaction_date) AS INTEGER) AS quarter,
        CAST(year(transaction_date) AS INTEGER) AS year, strftime(transaction_date, '%Y%m') AS month_text, CAST(transaction_timestamp AS DATE) AS day,
        CAST(date_trunc('month', transaction_date) AS DATE) AS month_start, CAST(date_trunc('week', transaction_date) AS DATE) AS week_start,
        CAST({AS_OF} - transaction_date AS INTEGER) AS age_days, transaction_date - 30 AS month_before,
        CAST(datediff('month', transaction_date, {AS_OF}) AS DOUBLE) AS age_months, CAST(epoch(transaction_timestamp) AS BIGINT) AS epoch,
        CAST(transaction_date AS TIMESTAMP) + INTERVAL 1 HOUR AS one_oclock FROM b_transactions""",
    "math_cast": f"""SELECT product_id, {_money("base_price + cost_price", "total")}, {_money("base_price - cost_price", "margin")},
        {_half_up(_cents("base_price") + " * 1075", "100000", 2)} AS with_tax, CAST(floor(base_price) AS BIGINT) AS whole,
        pow(CAST(product_id % 7 AS DOUBLE), 2) AS squared, product_id % 13 AS remainder, nullif(product_id % 4, 0) AS nonzero,
        {_money("least(base_price, cost_price)", "smaller")}, {_money("greatest(base_price, cost_price)", "larger")},
        CAST(floor(base_price) AS INTEGER) AS as_int, CAST(base_price AS VARCHAR) AS as_text, {_money("base_price", "wide")},
        CASE WHEN product_id % 3 <> 0 THEN CAST(base_price AS DOUBLE) / (product_id % 3) END AS share,
        coalesce(nullif(product_id % 2, 0), -1) AS odd_or_minus FROM b_products""",
    "json_pack_unpack": """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
        '{"event_id":' || event_id || ',"kind":"' || event_type || '","who":{"user_id":' || user_id || '}}' AS doc, event_type AS kind, user_id FROM events""",
    "array_ops": """SELECT p_partkey, CAST(len(string_split(p_name, ' ')) AS INTEGER) AS word_count, p_type AS second_label,
        string_split(p_name, ' ')[6] AS sixth_word, CAST(unnest(range(len(string_split(p_name, ' ')))) AS INTEGER) AS position,
        unnest(string_split(p_name, ' ')) AS word FROM part""",
    "customer_360_secure": """SELECT customer_id, email[1:3] || '***@' || string_split(email, '@')[2] AS email, '***-***-' || right(phone, 4) AS phone,
        first_name, last_name, state, customer_segment, tenure_category, total_transactions, CAST(total_spend AS DOUBLE) AS total_spend,
        avg_order_value, rfm_score, value_segment, preferred_channel FROM c360""",
    "store_analytics_secure": _whole("g_stores", "WHERE lower(state) IN ('ca', 'ny', 'tx')"),
    "tag_catalog": "SELECT t.*, row_count FROM tags t LEFT JOIN tagged_sizes USING (schema_name, table_name)",
    "find_pii_tables": """SELECT schema_name, table_name, tag_name, tag_value, row_count FROM tags LEFT JOIN tagged_sizes USING (schema_name, table_name)
        WHERE column_name IS NULL AND tag_name = 'pii' AND tag_value = 'true'""",
    "find_pii_columns": """SELECT t.*, CASE column_name WHEN 'email' THEN (SELECT count(email) FROM s_customers) WHEN 'phone' THEN (SELECT count(phone) FROM s_customers)
        WHEN 'first_name' THEN (SELECT count(first_name) FROM s_customers) WHEN 'last_name' THEN (SELECT count(last_name) FROM s_customers) END AS filled_count
        FROM tags t WHERE column_name IS NOT NULL AND tag_name = 'pii'""",
    "tables_by_domain": """SELECT schema_name, table_name, tag_value AS domain, row_count FROM tags LEFT JOIN tagged_sizes USING (schema_name, table_name)
        WHERE column_name IS NULL AND tag_name = 'domain'""",
    "tag_summary": """SELECT tag_name, count(DISTINCT schema_name || '.' || table_name) AS table_count, CAST(sum(row_count) AS BIGINT) AS tagged_rows
        FROM tags LEFT JOIN tagged_sizes USING (schema_name, table_name) WHERE column_name IS NULL GROUP BY tag_name""",
    "encrypt_columns": "SELECT customer_id, email, phone, sha256('retail-2001' || email) AS email_pseudonym FROM s_customers",
    "merge_upsert": """SELECT * FROM recent_now UNION ALL
        SELECT * FROM recent_before WHERE customer_id NOT IN (SELECT customer_id FROM recent_now)""",
    "change_feed": """SELECT n.*, 'insert' AS _change_type FROM recent_now n WHERE customer_id NOT IN (SELECT customer_id FROM recent_before)
        UNION ALL SELECT o.*, 'delete' FROM recent_before o WHERE customer_id NOT IN (SELECT customer_id FROM recent_now)
        UNION ALL SELECT o.*, 'update_preimage' FROM recent_before o JOIN recent_now n USING (customer_id) WHERE o.purchases <> n.purchases OR o.spend <> n.spend
        UNION ALL SELECT n.*, 'update_postimage' FROM recent_before o JOIN recent_now n USING (customer_id) WHERE o.purchases <> n.purchases OR o.spend <> n.spend""",
    "state_as_of": """SELECT * FROM (SELECT customer_id, transaction_id, transaction_type, channel, transaction_date FROM b_transactions
            WHERE customer_id IS NOT NULL AND transaction_id <= (SELECT max(transaction_id) FROM b_transactions WHERE customer_id IS NOT NULL) // 2
            QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY transaction_id DESC) = 1) WHERE transaction_type <> 'exchange'""",
    "gdpr_delete": "\nUNION ALL ".join(
        f"""SELECT '{name}' AS table_name, count(*) AS remaining_rows, count(customer_id) AS with_customer, CAST(sum(customer_id) AS BIGINT) AS key_sum
            FROM {cte} WHERE customer_id IS NULL OR customer_id NOT IN (SELECT customer_id FROM b_customers WHERE NOT is_active)"""
        for name, cte in (("silver.customers", "s_customers"), ("silver.transactions", "s_transactions"), ("gold.customer_360", "c360"))),
    "retention_filter": "\nUNION ALL ".join(
        f"SELECT '{layer}' AS layer, event_id, event_timestamp FROM clicks WHERE event_timestamp >= TIMESTAMP '2024-01-31' - INTERVAL {hours} HOUR"
        for layer, hours in RETENTION_HOURS.items()),
    "zorder_key": _z_key(["customer_id", "store_id"]),
    "quantile_buckets": f"""WITH q AS (SELECT DISTINCT unnest(quantile_disc(customer_id, {[i / 16 for i in range(1, 16)]})) AS b FROM b_transactions)
        SELECT CAST(bucket AS INTEGER) AS bucket, count(*) AS row_count, min(customer_id) AS low, max(customer_id) AS high
        FROM (SELECT customer_id, (SELECT count(*) FROM q WHERE b <= customer_id) AS bucket FROM b_transactions WHERE customer_id IS NOT NULL)
        GROUP BY bucket""",
    "cluster_write": """SELECT channel, transaction_type, count(*) AS row_count, CAST(sum(transaction_id) AS BIGINT) AS key_sum,
        CAST(sum(customer_id) AS BIGINT) AS customer_sum FROM b_transactions GROUP BY 1, 2""",
    "refresh_summaries": """SELECT 'mv_executive_summary' AS summary, count(*) AS row_count,
            (SELECT CAST(sum(net_sales) AS DOUBLE) FROM g_daily) AS revenue FROM weekly
        UNION ALL SELECT 'mv_category_performance', count(*), (SELECT CAST(sum(total_revenue) AS DOUBLE) FROM g_products) FROM by_category""",
    "clickstream_bronze": "SELECT *, CAST(event_timestamp AS DATE) AS event_date, CAST(hour(event_timestamp) AS INTEGER) AS event_hour FROM clicks",
    "clickstream_enriched": """SELECT k.*, CAST(event_timestamp AS DATE) AS event_date, CAST(hour(event_timestamp) AS INTEGER) AS event_hour,
        customer_segment, state AS customer_state, CAST(lifetime_value AS DOUBLE) AS lifetime_value FROM clicks k LEFT JOIN b_customers USING (customer_id)""",
    "session_metrics": """SELECT w AS window_start, w + INTERVAL 5 MINUTE AS window_end, device_type, referrer, count(*) AS event_count,
        count(*) FILTER (event_type = 'product_view') AS product_views, count(*) FILTER (event_type = 'add_to_cart') AS add_to_carts,
        count(*) FILTER (event_type = 'checkout_complete') AS checkouts, count(DISTINCT session_id) AS exact_sessions,
        count(DISTINCT customer_id) AS exact_customers, true AS approx_ok
        FROM (SELECT *, unnest([time_bucket(INTERVAL 1 MINUTE, event_timestamp) - i * INTERVAL 1 MINUTE FOR i IN range(5)]) AS w FROM clicks) GROUP BY ALL""",
    "product_trending": """SELECT w AS window_start, w + INTERVAL 15 MINUTE AS window_end, product_id, count(*) AS total_events,
        count(*) FILTER (event_type = 'product_view') AS views, count(*) FILTER (event_type = 'add_to_cart') AS cart_adds,
        count(*) FILTER (event_type = 'checkout_complete') AS purchases,
        CAST(count(*) FILTER (event_type = 'product_view') + 3 * count(*) FILTER (event_type = 'add_to_cart')
             + 10 * count(*) FILTER (event_type = 'checkout_complete') AS INTEGER) AS engagement_score,
        count(DISTINCT session_id) AS exact_viewers, true AS approx_ok
        FROM (SELECT *, unnest([time_bucket(INTERVAL 5 MINUTE, event_timestamp) - i * INTERVAL 5 MINUTE FOR i IN range(3)]) AS w
              FROM clicks WHERE product_id IS NOT NULL) GROUP BY ALL""",
    "realtime_dashboard": """SELECT timestamp, events_per_minute, conversions, exact_sessions, exact_customers, true AS approx_ok FROM per_minute
        JOIN (SELECT time_bucket(INTERVAL 1 MINUTE, event_timestamp) + INTERVAL 1 MINUTE AS timestamp, count(DISTINCT session_id) AS exact_sessions,
                     count(DISTINCT customer_id) AS exact_customers FROM clicks GROUP BY 1) USING (timestamp)""",
    "late_data_append": """SELECT w AS window_start, w + INTERVAL 1 HOUR AS window_end, count(*) AS event_count
        FROM (SELECT time_bucket(INTERVAL 1 HOUR, event_timestamp) AS w FROM clicks) GROUP BY w
        HAVING w + INTERVAL 1 HOUR <= (SELECT max(event_timestamp) FROM clicks) - INTERVAL 1 HOUR""",
    "stream_dedup": "SELECT * FROM clicks",
    "view_to_purchase_join": """SELECT v.session_id, v.event_id AS view_id, p.event_id AS purchase_id, v.event_timestamp AS view_time, p.event_timestamp AS purchase_time
        FROM clicks v JOIN clicks p ON v.session_id = p.session_id AND v.event_type = 'product_view' AND p.event_type = 'checkout_complete'
         AND p.event_timestamp BETWEEN v.event_timestamp AND v.event_timestamp + INTERVAL 6 HOUR""",
    "session_windows": """SELECT customer_id, min(event_timestamp) AS session_start, max(event_timestamp) + INTERVAL 30 MINUTE AS session_end,
        count(*) AS event_count, count(*) FILTER (event_type = 'checkout_complete') AS checkouts
        FROM (SELECT *, sum(fresh) OVER (PARTITION BY customer_id ORDER BY event_timestamp, event_id) AS no
              FROM (SELECT *, CASE WHEN event_timestamp <= lag(event_timestamp) OVER (PARTITION BY customer_id ORDER BY event_timestamp, event_id) + INTERVAL 30 MINUTE
                                   THEN 0 ELSE 1 END AS fresh FROM clicks WHERE customer_id IS NOT NULL))
        GROUP BY customer_id, no""",
    "metric_anomalies": """SELECT timestamp, events_per_minute, CAST(s AS DOUBLE) / nullif(n, 0) AS mean_before,
        coalesce(n > 1 AND (n * x - s) * (n * x - s) * (n - 1) > 9 * n * (n * q - s * s), false) AS is_anomaly
        FROM (SELECT timestamp, events_per_minute, CAST(events_per_minute AS HUGEINT) AS x, count(*) OVER w AS n,
                     sum(events_per_minute) OVER w AS s, sum(events_per_minute * events_per_minute) OVER w AS q
              FROM (SELECT *, epoch_us(timestamp) // 60000000 AS m FROM per_minute)
              WINDOW w AS (ORDER BY m RANGE BETWEEN 60 PRECEDING AND 1 PRECEDING))""",
    "orders_json_flatten": """SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey) AS order_id, l_suppkey AS customer_id,
        strftime(l_shipdate, '%Y-%m-%d') AS order_date, l_extendedprice AS total_amount, l_linestatus AS status,
        CASE WHEN i = 0 THEN l_partkey ELSE 0 END AS product_id, CAST(CASE WHEN i = 0 THEN l_quantity ELSE 1 END AS INTEGER) AS quantity,
        CASE WHEN i = 0 THEN l_extendedprice ELSE 0 END AS price, '1 Main St' AS street, 'Springfield' AS city, l_returnflag AS state,
        lpad(CAST(l_suppkey AS VARCHAR), 5, '0') AS zip
        FROM (SELECT *, unnest(range(CASE WHEN l_returnflag = 'R' THEN 2 ELSE 1 END)) AS i FROM lineitem)""",
}
_STATEMENTS |= {
    f"{name}_unique_customers": f"""SELECT CAST(date_trunc('{unit}', transaction_date) AS DATE) AS period_start, {more} count(DISTINCT customer_id) AS unique_customers,
        count(*) AS transaction_count, CAST(sum(transaction_amount) AS DOUBLE) AS revenue FROM s_transactions WHERE transaction_type = 'purchase' GROUP BY ALL"""
    for name, unit, more in (("weekly", "week", "channel,"), ("monthly", "month", ""))
}
_STATEMENTS["stored_changes"] = """WITH c AS (
        SELECT year_month, transaction_id, unnest(CASE WHEN transaction_id % 50 = 0 THEN ['update_preimage', 'update_postimage'] ELSE ['delete'] END) AS change_type
        FROM b_transactions WHERE transaction_id % 50 = 0 OR customer_id IN (SELECT customer_id FROM b_customers WHERE NOT is_active))
    SELECT year_month, change_type, count(*) AS row_count, CAST(sum(transaction_id) AS BIGINT) AS key_sum,
        CASE WHEN change_type = 'update_postimage' THEN count(*) ELSE 0 END AS kiosk_rows FROM c GROUP BY year_month, change_type"""
_STATEMENTS["session_windows_by_slot"] = _STATEMENTS["session_windows"]
_STATEMENTS |= {f"{name}_append": _STATEMENTS[name] for name in ("session_metrics", "product_trending", "realtime_dashboard")}
_STATEMENTS["daily_visitors"] = """SELECT CAST(event_timestamp AS DATE) AS day, count(*) AS event_count, count(DISTINCT customer_id) AS exact_customers, true AS approx_ok
    FROM clicks GROUP BY 1"""

ORACLE = {name: _sql(text) for name, text in _STATEMENTS.items()}
