"""The registered queries in SQL, for the comparison engine."""

from __future__ import annotations

from cartflow.registry.oracle_views import VIEWS, cents, ratio, with_views
from cartflow.registry.scenarios import KEPT_SINCE, KNOWN_BEFORE, PUBLISHED_THROUGH

TOTAL = "CAST(total_payment AS DOUBLE) AS total_payment"
MONTH = "CAST(date_trunc('month', order_purchase_timestamp) AS TIMESTAMP)"

ENRICHED = (
    "order_id, customer_id, customer_city, customer_state, order_status, order_purchase_timestamp, "
    "order_approved_at, order_delivered_customer_date, order_estimated_delivery_date, delivery_days, "
    f"is_delayed, delay_days, {TOTAL}, item_count, avg_review_score"
)
REVENUE = (
    "product_id, product_category_name_english, CAST(total_revenue AS DOUBLE) AS total_revenue, "
    "total_orders, avg_price"
)
PERFORMANCE = (
    "seller_id, seller_city, seller_state, total_orders, CAST(total_revenue AS DOUBLE) AS total_revenue, "
    "avg_review_score, on_time_rate"
)
DOCUMENT = (
    "customer_city, customer_state, order_status, order_purchase_timestamp, order_delivered_customer_date, "
    f"order_estimated_delivery_date, delivery_days, is_delayed, delay_days, {TOTAL}, item_count, avg_review_score"
)


def iso(name: str) -> str:
    return f"strftime({name}, '%Y-%m-%dT%H:%M:%S') AS {name}"


def _rename(sql: str, **names: str) -> str:
    for old, new in names.items():
        sql = sql.replace(f"FROM {old}", f"FROM {new}").replace(f"JOIN {old}", f"JOIN {new}")
    return sql


# What the earlier and the later run saw, and the tables derived from it.
RUNS = {
    "old_orders": f"""
        SELECT order_id, customer_id, 'created' AS order_status, order_purchase_timestamp, order_approved_at,
               CAST(NULL AS TIMESTAMP) AS order_delivered_customer_date, order_estimated_delivery_date
        FROM shop_orders WHERE order_approved_at < TIMESTAMP '{KNOWN_BEFORE}'""",
    "old_items": f"SELECT * FROM order_items WHERE shipping_limit_date < TIMESTAMP '{KNOWN_BEFORE}'",
    "old_customers": "SELECT customer_id, 'old ' || customer_city AS customer_city, customer_state FROM customers",
    "old_sellers": "SELECT seller_id, 'old ' || seller_city AS seller_city, seller_state FROM sellers",
    "new_orders": f"SELECT * FROM shop_orders WHERE order_approved_at >= TIMESTAMP '{KEPT_SINCE}'",
    "new_items": f"SELECT * FROM order_items WHERE shipping_limit_date >= TIMESTAMP '{KEPT_SINCE}'",
}
for _name in ("enriched", "revenue", "performance"):
    RUNS[f"old_{_name}"] = _rename(
        VIEWS[_name], shop_orders="old_orders", order_items="old_items", customers="old_customers",
        sellers="old_sellers",
    )
    RUNS[f"new_{_name}"] = _rename(VIEWS[_name], shop_orders="new_orders", order_items="new_items")

RUNS["merged"] = """
    SELECT coalesce(n.order_id, o.order_id) AS order_id,
           CASE WHEN o.order_id IS NOT NULL THEN o.customer_id ELSE n.customer_id END AS customer_id,
           CASE WHEN o.order_id IS NOT NULL THEN o.customer_city ELSE n.customer_city END AS customer_city,
           CASE WHEN o.order_id IS NOT NULL THEN o.customer_state ELSE n.customer_state END AS customer_state,
           CASE WHEN n.order_id IS NOT NULL THEN n.order_status ELSE o.order_status END AS order_status,
           CASE WHEN o.order_id IS NOT NULL THEN o.order_purchase_timestamp
                ELSE n.order_purchase_timestamp END AS order_purchase_timestamp,
           CASE WHEN o.order_id IS NOT NULL THEN o.order_approved_at ELSE n.order_approved_at END AS order_approved_at,
           CASE WHEN n.order_id IS NOT NULL THEN n.order_delivered_customer_date
                ELSE o.order_delivered_customer_date END AS order_delivered_customer_date,
           CASE WHEN o.order_id IS NOT NULL THEN o.order_estimated_delivery_date
                ELSE n.order_estimated_delivery_date END AS order_estimated_delivery_date,
           CASE WHEN n.order_id IS NOT NULL THEN n.delivery_days ELSE o.delivery_days END AS delivery_days,
           CASE WHEN n.order_id IS NOT NULL THEN n.is_delayed ELSE o.is_delayed END AS is_delayed,
           CASE WHEN n.order_id IS NOT NULL THEN n.delay_days ELSE o.delay_days END AS delay_days,
           CASE WHEN n.order_id IS NOT NULL THEN n.total_payment ELSE o.total_payment END AS total_payment,
           CASE WHEN n.order_id IS NOT NULL THEN n.item_count ELSE o.item_count END AS item_count,
           CASE WHEN n.order_id IS NOT NULL THEN n.avg_review_score ELSE o.avg_review_score END AS avg_review_score,
           n.order_id IS NOT NULL AS in_new
    FROM old_enriched o FULL JOIN new_enriched n ON o.order_id = n.order_id"""

RUNS["sync_rows"] = f"""
    SELECT order_id, {TOTAL}, CAST(year(order_approved_at) - 1994 AS BIGINT) AS row_version FROM enriched"""
WAITING = f"(row_version > {PUBLISHED_THROUGH} OR total_payment = 0)"

RUNS["text_documents"] = """
    SELECT CAST(o_orderkey AS VARCHAR) AS _id, o_orderstatus AS order_status,
           CASE WHEN o_orderpriority = '5-LOW' THEN 'soon' ELSE substr(o_orderpriority, 1, 1) END AS delay_days,
           CASE WHEN o_orderstatus = 'P' THEN '' ELSE CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS VARCHAR) END
               AS total_payment,
           o_orderdate AS order_purchase_timestamp
    FROM orders"""

RUNS["short_customers"] = """
    SELECT customer_id, customer_city, replace(customer_state, 'NATION_', '') AS customer_state FROM customers"""
RUNS["loaded"] = _rename(VIEWS["enriched"], order_items="first_items", customers="short_customers")

DELAY_RATE = (
    "CAST(count(*) AS BIGINT) AS total_orders, "
    "CAST(sum(CASE WHEN is_delayed THEN 1 ELSE 0 END) AS BIGINT) AS delayed_orders, "
    + ratio("100 * sum(CASE WHEN is_delayed THEN 1 ELSE 0 END)", "count(*)", 2)
    + " AS delay_rate_pct FROM enriched WHERE order_delivered_customer_date IS NOT NULL"
)
BY_STATE_DAYS = (
    f"SELECT customer_state, {ratio('sum(delivery_days)', 'count(*)', 1)} AS avg_delivery_days, "
    "count(*) AS delivered_orders FROM enriched WHERE delivery_days IS NOT NULL GROUP BY customer_state"
)
SECONDS = "CAST(round((epoch_us(finished_at) - epoch_us(started_at)) / 1000000.0) AS INTEGER) AS duration_sec"
TOP_RUNS = "SELECT * FROM runs ORDER BY started_at DESC NULLS FIRST, run_id DESC LIMIT"
ITEM_TEXT = (
    "CAST(order_id AS VARCHAR) AS order_id, order_item_id, CAST(product_id AS VARCHAR) AS product_id, "
    "CAST(seller_id AS VARCHAR) AS seller_id, shipping_limit_date, CAST(price AS DOUBLE) AS price, "
    "CAST(freight_value AS DOUBLE) AS freight_value"
)
COPIES = "(SELECT order_id AS ok, order_item_id AS oi, count(*) AS load_copies FROM order_items GROUP BY 1, 2)"
DELIVERED, ESTIMATED = "order_delivered_customer_date", "order_estimated_delivery_date"

SQL = {
    # derived tables and reports
    "orders_enriched": f"SELECT {ENRICHED} FROM enriched",
    "product_revenue": f"SELECT {REVENUE} FROM revenue",
    "seller_performance": f"SELECT {PERFORMANCE} FROM performance",
    "seller_performance_order_grain": f"""
        SELECT s.seller_id, s.seller_city, s.seller_state, CAST(count(*) AS BIGINT) AS total_orders,
               CAST(sum(p.revenue) AS DOUBLE) AS total_revenue,
               {ratio('sum(r.score_sum)', 'sum(r.scored)', 2)} AS avg_review_score,
               {ratio(f'100 * sum(CASE WHEN o.{DELIVERED} <= o.{ESTIMATED} THEN 1 ELSE 0 END)', 'count(*)', 2)}
                   AS on_time_rate
        FROM sellers s
        JOIN (SELECT seller_id, order_id, sum(price) AS revenue FROM order_items GROUP BY 1, 2) p
          ON s.seller_id = p.seller_id
        JOIN shop_orders o ON o.order_id = p.order_id
        LEFT JOIN (SELECT order_id, sum(review_score) AS score_sum, count(review_score) AS scored
                   FROM order_reviews GROUP BY 1) r ON r.order_id = o.order_id
        GROUP BY s.seller_id, s.seller_city, s.seller_state""",
    "monthly_order_volume": f"""
        SELECT {MONTH} AS month, count(*) AS order_count, CAST(sum(total_payment) AS DOUBLE) AS total_revenue
        FROM enriched WHERE order_purchase_timestamp IS NOT NULL GROUP BY 1""",
    "order_status_distribution": f"""
        SELECT order_status, "count", {ratio('100 * "count"', 'sum("count") OVER ()', 2)} AS pct
        FROM (SELECT order_status, count(*) AS "count" FROM enriched GROUP BY order_status)""",
    "top_categories": """
        SELECT product_category_name_english AS category, CAST(sum(total_revenue) AS DOUBLE) AS revenue,
               CAST(sum(total_orders) AS BIGINT) AS orders
        FROM revenue GROUP BY 1 ORDER BY sum(total_revenue) DESC NULLS FIRST, 1 LIMIT 10""",
    "avg_delivery_by_state": BY_STATE_DAYS,
    "delay_rate_by_state": f"SELECT customer_state, {DELAY_RATE} GROUP BY customer_state",
    "delay_rate_overall": f"SELECT {DELAY_RATE}",
    "review_score_distribution": """
        SELECT round(avg_review_score) AS score, count(*) AS order_count
        FROM enriched WHERE avg_review_score IS NOT NULL GROUP BY 1""",
    "top_sellers": """
        SELECT seller_id, seller_state, CAST(total_revenue AS DOUBLE) AS total_revenue, total_orders, on_time_rate
        FROM performance ORDER BY performance.total_revenue DESC NULLS FIRST, seller_id LIMIT 10""",
    "run_history": f"""
        SELECT run_id, dag_id, run_type, status, rows_processed, {SECONDS}, started_at FROM ({TOP_RUNS} 20)""",
    # charts
    "chart_monthly_orders": f"""
        SELECT {MONTH} AS month, count(*) AS order_count
        FROM enriched WHERE order_purchase_timestamp IS NOT NULL GROUP BY 1""",
    "chart_revenue_by_category": """
        SELECT product_category_name_english AS category, CAST(sum(total_revenue) AS DOUBLE) AS revenue
        FROM revenue GROUP BY 1""",
    "chart_delivery_days_by_state": BY_STATE_DAYS,
    "chart_delay_rate_by_state": f"SELECT customer_state, {DELAY_RATE} GROUP BY customer_state",
    "orders_in_time_range": """
        SELECT order_id, order_purchase_timestamp, order_status FROM enriched
        WHERE order_purchase_timestamp BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1998-12-31'""",
    # scans and load rules
    "scan_orders_projection": """
        SELECT order_id, customer_id, order_status AS status, order_purchase_timestamp FROM shop_orders""",
    "csv_load_order_items": f"""
        SELECT {ITEM_TEXT}, load_copies FROM first_items JOIN {COPIES} ON order_id = ok AND order_item_id = oi""",
    "csv_load_multiline_text": """
        SELECT CAST(doc_id AS VARCHAR) AS review_id, CAST(doc_id AS VARCHAR) AS order_id,
               CAST(length(text) % 5 + 1 AS INTEGER) AS review_score, nullif(source, '') AS review_comment_title,
               nullif(text, '') AS review_comment_message
        FROM documents""",
    "csv_empty_to_null": """
        SELECT CAST(customer_id AS VARCHAR) AS customer_id, CAST(NULL AS VARCHAR) AS customer_unique_id,
               CAST(NULL AS VARCHAR) AS customer_zip_code_prefix,
               CASE WHEN customer_city <> 'BUILDING' THEN customer_city END AS customer_city,
               CAST(NULL AS VARCHAR) AS customer_state
        FROM customers""",
    "load_translation_skip_null_key": """
        SELECT product_category_name, min(product_category_name_english) AS product_category_name_english,
               count(*) AS load_copies
        FROM translation_rows WHERE product_category_name IS NOT NULL GROUP BY 1""",
    "load_typed_order_items": f"SELECT {ITEM_TEXT} FROM order_items",
    "dedup_first_by_key": f"""
        SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date, CAST(price AS DOUBLE) AS price,
               CAST(freight_value AS DOUBLE) AS freight_value, load_copies
        FROM first_items JOIN {COPIES} ON order_id = ok AND order_item_id = oi""",
    # filters
    "filter_not_null_keys": "SELECT order_id, customer_id FROM shop_orders WHERE customer_id IS NOT NULL",
    "filter_review_score_range": """
        SELECT review_id, order_id, review_score FROM order_reviews WHERE review_score BETWEEN 1 AND 5""",
    "delay_flags": f"""
        SELECT order_id, coalesce({DELIVERED} > {ESTIMATED}, FALSE) AS is_delayed,
               coalesce({DELIVERED} <= {ESTIMATED}, FALSE) AS is_on_time FROM shop_orders""",
    # joins
    "join_orders_customers_left": "SELECT order_id, customer_id, customer_city, customer_state FROM enriched",
    "join_payment_totals": """
        SELECT o.order_id, CAST(p.total AS DOUBLE) AS total_payment FROM shop_orders o
        LEFT JOIN (SELECT order_id, sum(payment_value) AS total FROM order_payments GROUP BY 1) p
               ON p.order_id = o.order_id""",
    "join_item_counts": """
        SELECT o.order_id, i.item_count FROM shop_orders o
        LEFT JOIN (SELECT order_id, count(*) AS item_count FROM order_items GROUP BY 1) i
               ON i.order_id = o.order_id""",
    "join_review_scores": f"""
        SELECT o.order_id, r.avg_review_score FROM shop_orders o
        LEFT JOIN (SELECT order_id, {ratio('sum(review_score)', 'count(review_score)', 2)} AS avg_review_score
                   FROM order_reviews WHERE review_score BETWEEN 1 AND 5 GROUP BY 1) r
               ON r.order_id = o.order_id""",
    "join_items_products_left": """
        SELECT i.order_id, i.order_item_id, i.product_id, p.product_category_name
        FROM order_items i LEFT JOIN products p ON p.product_id = i.product_id""",
    "join_translation_left": """
        SELECT p.product_id, p.product_category_name, t.product_category_name_english
        FROM products p LEFT JOIN category_translation t ON t.product_category_name = p.product_category_name""",
    "join_sellers_items_inner": """
        SELECT i.order_id, i.order_item_id, s.seller_id, s.seller_city, s.seller_state
        FROM sellers s JOIN order_items i ON s.seller_id = i.seller_id""",
    "join_items_orders_inner": """
        SELECT i.order_id, i.order_item_id, o.order_status
        FROM order_items i JOIN shop_orders o ON i.order_id = o.order_id""",
    "join_reviews_fanout": """
        SELECT i.order_id, count(*) AS joined_rows
        FROM order_items i LEFT JOIN order_reviews r ON i.order_id = r.order_id GROUP BY 1""",
    # aggregates and functions
    "agg_item_count": "SELECT order_id, count(*) AS item_count FROM order_items GROUP BY 1",
    "count_orders": "SELECT count(*) AS cnt FROM shop_orders",
    "agg_payment_total": """
        SELECT order_id, CAST(sum(payment_value) AS DOUBLE) AS total_payment FROM order_payments GROUP BY 1""",
    "agg_avg_review": f"""
        SELECT order_id, {ratio('sum(review_score)', 'count(review_score)', 2)} AS avg_review_score
        FROM order_reviews WHERE review_score BETWEEN 1 AND 5 GROUP BY 1""",
    "agg_avg_price": f"""
        SELECT product_id, {ratio(cents('sum(price)'), '100 * count(price)', 2)} AS avg_price
        FROM order_items GROUP BY 1""",
    "agg_distinct_orders": """
        SELECT product_id, count(DISTINCT order_id) AS total_orders FROM order_items GROUP BY 1""",
    "agg_on_time": f"""
        SELECT order_status, CAST(sum(CASE WHEN {DELIVERED} <= {ESTIMATED} THEN 1 ELSE 0 END) AS BIGINT)
                   AS on_time_orders, count(*) AS orders
        FROM shop_orders GROUP BY 1""",
    "agg_delayed": f"""
        SELECT customer_id, CAST(sum(CASE WHEN {DELIVERED} > {ESTIMATED} THEN 1 ELSE 0 END) AS BIGINT)
                   AS delayed_orders, count(*) AS orders
        FROM shop_orders GROUP BY 1""",
    "delivery_days": f"""
        SELECT order_id, CAST((epoch_us({DELIVERED}) - epoch_us(order_purchase_timestamp)) // 86400000000
                              AS INTEGER) AS delivery_days
        FROM shop_orders""",
    "delay_days": f"""
        SELECT order_id, CAST(sign(epoch_us({DELIVERED}) - epoch_us({ESTIMATED}))
                   * (abs(epoch_us({DELIVERED}) - epoch_us({ESTIMATED})) // 86400000000) AS INTEGER) AS delay_days
        FROM shop_orders""",
    "round_ratio": f"""
        SELECT product_id, {ratio(cents('sum(price)'), '100 * count(*)', 2)} AS mean_price,
               {ratio('count(*) * 100', 'sum(freight_value)', 1)} AS items_per_100_freight,
               {ratio('count(*) * 100000', cents('sum(price)'), 4)} AS items_per_1000_spent
        FROM order_items GROUP BY 1""",
    "run_duration": f"SELECT run_id, {SECONDS} FROM runs",
    # upserts
    "upsert_orders_enriched": f"SELECT {ENRICHED} FROM merged",
    "upsert_product_revenue": f"""
        SELECT {REVENUE} FROM (
            SELECT * FROM new_revenue UNION ALL
            SELECT * FROM old_revenue WHERE product_id NOT IN (SELECT product_id FROM new_revenue))""",
    "upsert_seller_performance": """
        SELECT coalesce(n.seller_id, o.seller_id) AS seller_id,
               CASE WHEN o.seller_id IS NOT NULL THEN o.seller_city ELSE n.seller_city END AS seller_city,
               CASE WHEN o.seller_id IS NOT NULL THEN o.seller_state ELSE n.seller_state END AS seller_state,
               CASE WHEN n.seller_id IS NOT NULL THEN n.total_orders ELSE o.total_orders END AS total_orders,
               CAST(CASE WHEN n.seller_id IS NOT NULL THEN n.total_revenue ELSE o.total_revenue END AS DOUBLE)
                   AS total_revenue,
               CASE WHEN n.seller_id IS NOT NULL THEN n.avg_review_score ELSE o.avg_review_score END
                   AS avg_review_score,
               CASE WHEN n.seller_id IS NOT NULL THEN n.on_time_rate ELSE o.on_time_rate END AS on_time_rate
        FROM old_performance o FULL JOIN new_performance n ON o.seller_id = n.seller_id""",
    # publication
    "order_documents": f"""
        SELECT order_id, customer_id, customer_city, customer_state, order_status,
               {iso('order_purchase_timestamp')}, {iso(DELIVERED)}, {iso(ESTIMATED)},
               delivery_days, is_delayed, delay_days, {TOTAL}, item_count, avg_review_score
        FROM enriched""",
    "product_documents": """
        SELECT product_id, product_category_name_english AS category,
               CAST(total_revenue AS DOUBLE) AS total_revenue, total_orders, avg_price
        FROM revenue""",
    "seller_documents": f"SELECT {PERFORMANCE} FROM performance",
    "doc_sink_orders": f"""
        SELECT CAST(order_id AS VARCHAR) AS _id, CAST(customer_id AS VARCHAR) AS customer_id, {DOCUMENT},
               CAST(2 AS BIGINT) AS _version FROM new_enriched
        UNION ALL
        SELECT CAST(order_id AS VARCHAR), CAST(customer_id AS VARCHAR), {DOCUMENT}, 1 FROM old_enriched
        WHERE order_id NOT IN (SELECT order_id FROM new_enriched)""",
    "stream_publish_orders": f"""
        SELECT CAST(order_id AS VARCHAR) AS _id, CAST(customer_id AS VARCHAR) AS customer_id, {DOCUMENT},
               CAST(CASE WHEN in_new THEN 3 ELSE 2 END AS BIGINT) AS _version FROM merged""",
    "doc_sink_rejects": """
        SELECT _id, concat_ws(',', CASE WHEN delay_days = 'soon' THEN 'delay_days' END,
                              CASE WHEN total_payment = '' THEN 'total_payment' END) AS unfit_fields
        FROM text_documents WHERE delay_days = 'soon' OR total_payment = ''""",
    "doc_sink_accepted": """
        SELECT _id, order_status, CAST(delay_days AS INTEGER) AS delay_days,
               CAST(total_payment AS DOUBLE) AS total_payment, order_purchase_timestamp
        FROM text_documents WHERE delay_days <> 'soon' AND total_payment <> ''""",
    "index_count_orders": """
        SELECT count(*) AS documents, CAST(0 AS BIGINT) AS documents_of_missing_index FROM enriched""",
    "unsynced_orders": f"SELECT order_id, total_payment, row_version FROM sync_rows WHERE {WAITING}",
    "count_unsynced": f"SELECT count(*) AS cnt FROM sync_rows WHERE {WAITING}",
    "mark_synced": f"SELECT order_id, total_payment, row_version, NOT {WAITING} AS synced_to_es FROM sync_rows",
    "full_chain": f"""
        SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id,
               order_approved_at, {DOCUMENT}, TRUE AS synced_to_es FROM loaded""",
    # runs and checks
    "run_state": """
        SELECT run_id, dag_id, run_type, status, rows_processed, started_at, finished_at, error_message
        FROM runs""",
    "recent_runs": f"SELECT run_id, run_type, status, rows_processed, started_at FROM ({TOP_RUNS} 5)",
    "recent_failed_runs": f"""
        SELECT run_id, run_type, status, rows_processed, started_at FROM ({TOP_RUNS} 5) WHERE status = 'failed'""",
    "health_checks": f"""
        SELECT 'raw_orders_present' AS check_name, count(*) AS value, count(*) > 0 AS ok FROM shop_orders
        UNION ALL SELECT 'order_documents_counted', count(*), TRUE FROM enriched
        UNION ALL SELECT 'no_recent_failed_runs', count(*), count(*) = 0
        FROM ({TOP_RUNS} 5) WHERE status = 'failed'""",
    # load rules, sinks and jobs that have no other key
    "csv_bom_and_ragged_rows": """
        SELECT CAST(customer_id AS VARCHAR) AS customer_id,
               CASE WHEN customer_id % 4 <> 0 THEN customer_city END AS customer_city,
               CASE WHEN customer_id % 4 <> 0 THEN 'XX' END AS customer_state
        FROM customers""",
    "csv_literal_quotes": """
        SELECT CAST(product_id AS VARCHAR) AS review_id, CAST(product_id % 5 AS INTEGER) AS review_score,
               product_name || ' 5" wide' AS review_comment_title,
               CASE product_id % 3 WHEN 0 THEN product_name
                    WHEN 1 THEN product_name || chr(10) || chr(10) || 'says "hi, you"' || chr(10)
                    ELSE '7"' END AS review_comment_message
        FROM products""",
    "load_geolocation": """
        SELECT CAST(customer_id % 10 AS VARCHAR) AS geolocation_zip_code_prefix, customer_city AS geolocation_city,
               replace(customer_state, 'NATION_', '') AS geolocation_state, count(*) AS rows,
               CAST(sum(CAST(customer_id % 10 / 8.0 AS DECIMAL(10,6))) AS DOUBLE) AS lat, count(*) AS read
        FROM customers GROUP BY 1, 2, 3""",
    "load_misfits_fail": """
        SELECT 'length' AS misfit, count(*) > 0 AS failed FROM sellers WHERE length(seller_state) > 2
        UNION ALL SELECT 'key', count(*) > 0 FROM sellers
        UNION ALL SELECT 'number', count(*) > 0 FROM products WHERE try_cast(product_name AS INTEGER) IS NULL""",
    "index_pattern_read": """
        SELECT CASE WHEN product_id % 2 = 0 THEN 'shop_products_even' ELSE 'shop_products_odd' END AS _index,
               CAST(product_id AS VARCHAR) AS _id, product_category_name_english AS category, total_orders,
               CASE WHEN product_id % 2 = 0 THEN avg_price END AS avg_price
        FROM revenue""",
    "doc_sink_repeated_ids": """
        SELECT CAST(product_id AS VARCHAR) AS _id, max(order_id) AS total_orders, CAST(1 AS BIGINT) AS _version
        FROM order_items GROUP BY 1""",
    "doc_sink_keyless": """
        SELECT product_category_name AS category, 2 * count(*) AS documents, 2 * count(*) AS ids
        FROM products GROUP BY 1""",
    "index_create_if_absent": """
        SELECT seller_state, count(*) AS after, CAST(0 AS BIGINT) AS before FROM sellers GROUP BY 1""",
    "publish_gate": """
        SELECT 1 AS attempt, 'success' AS status, count(*) AS unsynced, count(*) AS documents FROM enriched
        UNION ALL SELECT 2, 'skipped', 0, 0""",
    "ledger_runs": """
        SELECT CAST(i AS BIGINT) AS run_id, 'nightly' AS dag_id, kind AS run_type,
               CASE WHEN i = 2 THEN 'failed' ELSE 'success' END AS status, n AS rows_processed,
               TIMESTAMP '2024-01-01' + to_minutes(CAST(2 * (i - 1) AS INTEGER)) AS started_at,
               TIMESTAMP '2024-01-01' + to_minutes(CAST(2 * i - 1 AS INTEGER)) AS finished_at,
               CASE WHEN i = 2 THEN 'lost' END AS error_message
        FROM (SELECT 1 AS i, 'load' AS kind, count(*) AS n FROM customers
              UNION ALL SELECT 2, 'transform', count(*) FROM sellers
              UNION ALL SELECT 3, 'sync', count(*) FROM products)""",
    "upsert_row_counts": """
        SELECT CAST(1 AS BIGINT) AS row_version, TIMESTAMP '2024-02-03' AS updated_at, count(*) AS rows,
               (SELECT count(*) FROM old_revenue) AS written
        FROM old_revenue WHERE product_id NOT IN (SELECT product_id FROM new_revenue) HAVING count(*) > 0
        UNION ALL
        SELECT 2, TIMESTAMP '2024-02-03', count(*), count(*) FROM new_revenue HAVING count(*) > 0""",
}


def oracle_sql() -> dict[str, str]:
    return {name: with_views(sql, RUNS) for name, sql in SQL.items()}
