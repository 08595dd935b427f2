"""The same queries as plain SQL over the test tables, for an independent engine."""

from __future__ import annotations

from tierstone.contracts import CONTRACTS

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"

_BASE = r"""
WITH src_events AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events
),
users AS (
  SELECT c_custkey AS id, c_mktsegment AS first_name, substring(c_name, 10, 9) AS last_name,
         CASE WHEN c_custkey % 10 = 0 THEN NULL
              WHEN c_custkey % 10 = 1 THEN 'bad-' || c_custkey
              ELSE 'u' || c_custkey || '@example.com' END AS email,
         TIMESTAMP '2023-01-01' + (c_custkey % 28) * INTERVAL 1 DAY AS created_at,
         TIMESTAMP '2023-02-01' + (c_custkey % 5) * INTERVAL 1 DAY AS updated_at
  FROM customer
),
items AS (
  SELECT p_partkey AS id, p_name AS name, lower(p_type) AS category,
         CAST(p_retailprice AS DECIMAL(7,2)) AS price, p_size AS inventory,
         TIMESTAMP '2023-01-01' + (p_partkey % 28) * INTERVAL 1 DAY AS created_at,
         TIMESTAMP '2023-02-01' + (p_partkey % 5) * INTERVAL 1 DAY AS updated_at
  FROM part
),
purchases AS (
  SELECT event_id AS id, user_id, k AS item_id, CAST(event_id % 5 + 1 AS INTEGER) AS quantity,
         CAST(value AS DECIMAL(12,2)) AS purchase_price, ts AS created_at, ts AS updated_at
  FROM src_events WHERE event_type = 'purchase'
),
bulk_purchases AS (
  SELECT l_orderkey * 8 + l_linenumber AS id, o_custkey AS user_id, l_partkey AS item_id,
         l_linenumber AS quantity, CAST(l_extendedprice AS DECIMAL(12,2)) AS purchase_price,
         l_shipdate AS created_at, l_shipdate AS updated_at
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
),
pageviews AS (
  SELECT (event_id * 7919 + k * 31) % (SELECT count(*) // 3 FROM customer) AS user_id,
         CASE event_type WHEN 'error' THEN '/about'
                         WHEN 'signup' THEN '/cart/' || k
                         ELSE '/products/' || (2 * k) END AS url,
         event_type AS channel, ts AS received_at
  FROM src_events WHERE event_type <> 'purchase'
),
silver_users AS (
  SELECT *, regexp_matches(email, '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$') AS valid_email,
         concat_ws(' ', first_name, last_name) AS full_name
  FROM users
),
silver_items AS (
  SELECT id, name, upper(category) AS category,
         CAST(CASE WHEN price < 0 THEN 0 ELSE price END AS DECIMAL(7,2)) AS price,
         inventory, created_at, updated_at
  FROM items
),
enriched AS (
  SELECT p.id, p.user_id, p.item_id, p.quantity, p.purchase_price,
         CAST(p.quantity * p.purchase_price AS DECIMAL(14,2)) AS total_price,
         u.email AS user_email, i.name AS item_name, i.category AS item_category,
         CAST(p.created_at AS DATE) AS purchase_date,
         CAST(hour(p.created_at) AS INTEGER) AS purchase_hour, p.created_at, p.updated_at
  FROM purchases p LEFT JOIN users u ON p.user_id = u.id LEFT JOIN items i ON p.item_id = i.id
),
bulk_enriched AS (
  SELECT p.id, p.user_id, p.item_id, p.quantity, p.purchase_price,
         CAST(p.quantity * p.purchase_price AS DECIMAL(14,2)) AS total_price,
         u.email AS user_email, i.name AS item_name, i.category AS item_category,
         CAST(p.created_at AS DATE) AS purchase_date,
         CAST(hour(p.created_at) AS INTEGER) AS purchase_hour, p.created_at, p.updated_at
  FROM bulk_purchases p LEFT JOIN users u ON p.user_id = u.id LEFT JOIN items i ON p.item_id = i.id
),
parsed AS (
  SELECT user_id, TRY_CAST(regexp_extract(url, '/(\d+)$', 1) AS BIGINT) AS item_id,
         regexp_extract(url, '^/([^/]+)/\d+$', 1) AS page, channel, received_at
  FROM pageviews
),
item_views AS (
  SELECT v.user_id, v.item_id, v.page, i.name AS item_name, i.category AS item_category,
         v.channel, v.received_at
  FROM parsed v LEFT JOIN items i ON v.item_id = i.id
  WHERE v.item_id IS NOT NULL
),
product_views AS (
  SELECT item_id, count(*) AS pageviews FROM item_views WHERE page = 'products' GROUP BY item_id
),
sold AS (
  SELECT item_id, sum(quantity) AS items_sold, count(id) AS orders, sum(total_price) AS revenue
  FROM enriched GROUP BY item_id
),
bulk_sold AS (
  SELECT item_id, sum(quantity) AS items_sold, count(id) AS orders, sum(total_price) AS revenue
  FROM bulk_enriched GROUP BY item_id
),
performance AS (
  SELECT i.id AS item_id, i.name AS item_name, i.category AS item_category,
         CAST(coalesce(s.items_sold, 0) AS BIGINT) AS items_sold,
         CAST(coalesce(s.orders, 0) AS BIGINT) AS orders,
         CAST(coalesce(s.revenue, 0) AS DECIMAL(20,2)) AS revenue,
         CAST(coalesce(v.pageviews, 0) AS BIGINT) AS pageviews,
         CASE WHEN v.pageviews > 0 THEN CAST(s.orders AS DOUBLE) / v.pageviews
              ELSE CAST(0 AS DOUBLE) END AS conversion_rate
  FROM silver_items i LEFT JOIN sold s ON i.id = s.item_id
                      LEFT JOIN product_views v ON i.id = v.item_id
),
bulk_performance AS (
  SELECT i.id AS item_id, i.name AS item_name, i.category AS item_category,
         CAST(coalesce(s.items_sold, 0) AS BIGINT) AS items_sold,
         CAST(coalesce(s.orders, 0) AS BIGINT) AS orders,
         CAST(coalesce(s.revenue, 0) AS DECIMAL(20,2)) AS revenue,
         CAST(coalesce(v.pageviews, 0) AS BIGINT) AS pageviews,
         CASE WHEN v.pageviews > 0 THEN CAST(s.orders AS DOUBLE) / v.pageviews
              ELSE CAST(0 AS DOUBLE) END AS conversion_rate
  FROM silver_items i LEFT JOIN bulk_sold s ON i.id = s.item_id
                      LEFT JOIN product_views v ON i.id = v.item_id
),
last_day AS (
  SELECT * FROM enriched
  WHERE created_at >= @AS_OF - INTERVAL 24 HOUR AND created_at <= @AS_OF
),
scored AS (
  SELECT u.id AS user_id, u.email, u.full_name, count(v.page) AS total_pageviews,
         count(DISTINCT CAST(v.received_at AS DATE)) AS active_days,
         max(CAST(v.received_at AS DATE)) AS last_active_date
  FROM silver_users u
  LEFT JOIN (SELECT * FROM item_views WHERE received_at <= @AS_OF) v ON u.id = v.user_id
  WHERE u.valid_email
  GROUP BY u.id, u.email, u.full_name
),
aged AS (
  SELECT *, CAST(date_diff('day', last_active_date, CAST(@AS_OF AS DATE)) AS INTEGER)
              AS days_since_last_active
  FROM scored
),
segments AS (
  SELECT *, CASE WHEN total_pageviews >= 8 AND days_since_last_active <= 3 THEN 'high_engagement'
                 WHEN total_pageviews >= 3 AND days_since_last_active <= 7 THEN 'medium_engagement'
                 ELSE 'low_engagement' END AS engagement_segment
  FROM aged
),
top_items AS (
  SELECT item_id, item_name, item_category,
         CAST(sum(total_price) AS DECIMAL(20,2)) AS total_revenue
  FROM enriched GROUP BY item_id, item_name, item_category
  ORDER BY total_revenue DESC NULLS LAST, item_id NULLS FIRST LIMIT 10
),
upserted AS (
  SELECT id, name, CASE WHEN id % 9 = 0 THEN 'moved' ELSE category END AS category,
         CASE WHEN id % 3 = 0 THEN CAST(price + 0.10 AS DECIMAL(7,2)) ELSE price END AS price, inventory,
         created_at,
         CASE WHEN id % 3 = 0 THEN updated_at + INTERVAL 1 DAY ELSE updated_at END AS updated_at
  FROM items
  UNION ALL SELECT id + 1000000, name, category, price, inventory, created_at, updated_at
  FROM items WHERE id % 7 = 0
  UNION ALL SELECT NULL, name, category, price, inventory, created_at, updated_at
  FROM items WHERE id % 50 = 0
)
"""

_COUNTS = {
    "bronze.users": "users",
    "bronze.items": "items",
    "bronze.purchases": "purchases",
    "bronze.pageviews": "pageviews",
    "silver.users": "silver_users",
    "silver.items": "silver_items",
    "silver.purchases_enriched": "enriched",
    "silver.pageviews_by_items": "item_views",
    "gold.item_performance": "performance",
    "gold.top_selling_items": "top_items",
    "gold.sales_performance_24h": "(SELECT DISTINCT purchase_hour FROM last_day)",
    "gold.pageviews_by_channel": "(SELECT DISTINCT channel FROM item_views)",
    "gold.user_engagement_segments": "segments",
}

_PARITY = " UNION ALL ".join(
    f"SELECT '{name}' AS t, count(*) AS n_one, count(*) AS n_other, true AS agrees FROM {relation}"
    for name, relation in _COUNTS.items()
)

_LAST_DAY_HOURS = """
SELECT purchase_hour, CAST(sum(total_price) AS DECIMAL(20,2)) AS total_revenue
FROM last_day GROUP BY purchase_hour
"""

_CATEGORY_REVENUE = """
SELECT item_category, CAST(sum(orders) AS BIGINT) AS orders,
       CAST(sum(revenue) AS DECIMAL(20,2)) AS revenue, CAST(sum(pageviews) AS BIGINT) AS pageviews
FROM performance GROUP BY item_category
"""


def _mean(cents: str, rows: str) -> str:
    """Mean of whole non-negative cents to the nearest cent, half up, in integers."""
    return f"CAST((2 * {cents} + {rows}) // (2 * {rows}) AS DOUBLE) / 100"


def _gate(table: str, relation: str, unique: str | None, required: list[str]) -> str:
    checks = [("not_empty", f"SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM {relation}")]
    checks += [
        (f"{c}_present", f"SELECT count(*) FROM {relation} WHERE {c} IS NULL") for c in required
    ]
    if unique:
        checks.append(
            (f"{unique}_unique", f"SELECT count({unique}) - count(DISTINCT {unique}) FROM {relation}")
        )
    return " UNION ALL ".join(
        f"SELECT '{table}' AS \"table\", '{name}' AS \"check\", CAST(({sql}) AS BIGINT) AS failures,"
        f" ({sql}) = 0 AS passed"
        for name, sql in checks
    )


def _content() -> str:
    texts = []
    for name, contract in CONTRACTS.items():
        part, relation = contract.partitioning, _COUNTS[name]
        by_day = part is not None and part.transform == "day"
        day = f"CAST({part.source} AS DATE)" if by_day else "CAST(NULL AS DATE)"
        texts.append(
            f"SELECT '{name}' AS t, {day} AS day, count(*) AS n_one, count(*) AS n_other, true AS agrees"
            f" FROM {relation} GROUP BY {day} HAVING count(*) > 0"
        )
    return " UNION ALL ".join(texts)


def _layouts() -> str:
    """The declared columns, and the folders and rows that follow from the sources."""
    folders = {
        "day": "SELECT count(DISTINCT CAST({source} AS DATE)) FROM {relation}",
        "value": "SELECT count(DISTINCT coalesce({source}, '')) FROM {relation}",
    }
    texts = []
    for name, contract in CONTRACTS.items():
        part, relation = contract.partitioning, _COUNTS[name]
        columns = [(n, kind.simpleString(), False) for n, kind in contract.fields]
        if part:
            columns.append((part.column, part.sql_type.lower(), True))
        count = folders[part.transform].format(source=part.source, relation=relation) if part else "SELECT 0"
        listed = ", ".join(f"('{c}', '{kind}', {str(folder).lower()})" for c, kind, folder in columns)
        texts.append(
            f"SELECT '{name}' AS t, \"column\", type, is_folder, (SELECT count(*) FROM {relation}) AS n,"
            f" ({count})::BIGINT AS folders FROM (VALUES {listed}) v(\"column\", type, is_folder)"
        )
    return " UNION ALL ".join(texts)


_WHOLE_SECONDS = "SELECT * REPLACE (date_trunc('second', received_at) AS received_at) FROM pageviews"

_SELECTS = {
    "table_layouts": _layouts(),
    "listing_after_drop": "SELECT 'bronze' AS layer, 'users' AS table_name, count(*) AS n FROM users",
    "incremental_ingest": f"""
        SELECT *, CAST(CASE WHEN received_at < TIMESTAMP '2024-01-10' THEN 1
                            WHEN received_at < TIMESTAMP '2024-01-20' THEN 2 ELSE 3 END AS BIGINT) AS load_id
        FROM ({_WHOLE_SECONDS})""",
    "stream_deduplicated": f"""
        SELECT DISTINCT *, 'taken' AS place FROM ({_WHOLE_SECONDS})
        UNION ALL SELECT * REPLACE ('/late' AS url), 'late' FROM ({_WHOLE_SECONDS})
        WHERE received_at < TIMESTAMP '2024-01-05'""",
    "audited_publish": """
        SELECT id, quantity, purchase_price, 'published' AS place, CAST(0 AS BIGINT) AS version
        FROM purchases WHERE quantity > 1 AND purchase_price < 500
        UNION ALL SELECT id, quantity, purchase_price, CASE WHEN quantity > 1 THEN 'price' ELSE 'quantity' END, version
        FROM purchases, (VALUES (CAST(1 AS BIGINT)), (2), (2)) v(version)
        WHERE NOT (quantity > 1 AND purchase_price < 500)""",
    "bronze_users": "SELECT * FROM users",
    "bronze_items": "SELECT * FROM items",
    "bronze_purchases": "SELECT * FROM purchases",
    "bronze_pageviews": "SELECT * FROM pageviews",
    "silver_users": "SELECT * FROM silver_users",
    "silver_items": "SELECT * FROM silver_items",
    "purchases_enriched": "SELECT * FROM enriched",
    "purchases_enriched_salted": "SELECT * FROM enriched",
    "purchases_enriched_bulk": "SELECT * FROM bulk_enriched",
    "pageviews_by_items": "SELECT * FROM item_views",
    "negative_clamp": """
        SELECT c_custkey AS id,
               CASE WHEN c_acctbal < 0 THEN CAST(0 AS DECIMAL(7,2))
                    ELSE CAST(c_acctbal AS DECIMAL(7,2)) END AS price
        FROM customer""",
    "item_performance": "SELECT * FROM performance",
    "item_performance_bulk": "SELECT * FROM bulk_performance",
    "top_selling_items": "SELECT * FROM top_items",
    "top_selling_items_bulk": """
        SELECT item_id, item_name, item_category,
               CAST(sum(total_price) AS DECIMAL(20,2)) AS total_revenue
        FROM bulk_enriched GROUP BY item_id, item_name, item_category
        ORDER BY total_revenue DESC NULLS LAST, item_id NULLS FIRST LIMIT 10""",
    "sales_performance_24h": _LAST_DAY_HOURS,
    "partition_pruned_read": _LAST_DAY_HOURS,
    "pageviews_by_channel": """
        SELECT channel, count(*) AS total_pageviews FROM item_views GROUP BY channel""",
    "user_engagement_segments": "SELECT * FROM segments",
    "segments_csv_roundtrip": "SELECT * FROM segments",
    "segment_sizes": """
        SELECT engagement_segment, count(*) AS user_count
        FROM segments GROUP BY engagement_segment""",
    "top_earners": """
        SELECT item_name, item_category, orders, revenue, pageviews,
               round(conversion_rate, 4) AS conversion_rate
        FROM performance ORDER BY revenue DESC, item_id LIMIT 10""",
    "best_converters": """
        SELECT item_name, item_category, orders, pageviews,
               round(conversion_rate, 4) AS conversion_rate
        FROM performance WHERE pageviews > 0
        ORDER BY performance.conversion_rate DESC NULLS LAST, item_id LIMIT 10""",
    "traffic_without_sales": """
        SELECT item_name, item_category, pageviews, orders, conversion_rate
        FROM performance WHERE pageviews > 0
        ORDER BY conversion_rate ASC NULLS FIRST, item_id LIMIT 10""",
    "top5_conversion": """
        SELECT item_id, item_name, revenue, conversion_rate FROM performance
        ORDER BY conversion_rate DESC NULLS LAST, item_id LIMIT 5""",
    "top5_revenue": """
        SELECT item_id, item_name, revenue, conversion_rate FROM performance
        ORDER BY revenue DESC NULLS LAST, item_id LIMIT 5""",
    "revenue_by_category": _CATEGORY_REVENUE,
    "report_csv": _CATEGORY_REVENUE,
    "avg_revenue_by_category": f"""
        SELECT item_category, count(*) AS cnt,
               {_mean("CAST(sum(revenue) * 100 AS BIGINT)", "count(*)")} AS avg_revenue
        FROM performance GROUP BY item_category""",
    "avg_amount_by_supplier": f"""
        SELECT l_suppkey AS supplier, count(*) AS lines,
               {_mean("CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) * 100 AS BIGINT)",
                      "count(*)")} AS mean_amount
        FROM lineitem GROUP BY l_suppkey""",
    "email_validity": """
        SELECT valid_email, count(*) AS user_count FROM silver_users GROUP BY valid_email""",
    "bronze_channel_counts": "SELECT channel, count(*) AS cnt FROM pageviews GROUP BY channel",
    "channel_filter": "SELECT * FROM pageviews WHERE channel = 'view'",
    "time_range_filter": """
        SELECT * FROM pageviews
        WHERE received_at >= TIMESTAMP '2024-01-10' AND received_at < TIMESTAMP '2024-01-20'""",
    "layer_row_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS t, count(*) AS n FROM {name}"
        for name in ("users", "items", "purchases", "pageviews")
    ),
    "sql_over_view": """
        SELECT item_id, item_name, revenue, pageviews FROM performance""",
    "first_record": """
        SELECT unnest(['item_id', 'item_name', 'item_category', 'total_revenue']) AS "column",
               unnest([CAST(item_id AS VARCHAR), item_name, item_category,
                       CAST(total_revenue AS VARCHAR)]) AS "value"
        FROM (SELECT * FROM top_items
              ORDER BY total_revenue DESC NULLS LAST, item_id NULLS FIRST LIMIT 1)""",
    "files_per_table": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{name}.parquet' AS file_name,"
        f" count(*) AS record_count FROM {name}"
        for name in ("customer", "part", "events", "lineitem", "orders")
    ),
    "json_ingest": """
        SELECT user_id, url, channel, date_trunc('second', received_at) AS received_at
        FROM pageviews""",
    "stream_pageviews": """
        SELECT user_id, url, channel, date_trunc('second', received_at) AS received_at
        FROM pageviews""",
    "partitioned_overwrite_roundtrip": "SELECT * FROM pageviews",
    "compaction": "SELECT * FROM pageviews",
    "insert_values_roundtrip": """
        SELECT id, name AS msg FROM items
        UNION ALL SELECT -1, 'hello' UNION ALL SELECT -2, 'world'""",
    "full_refresh": " UNION ALL ".join(
        f"SELECT '{name}' AS t, count(*) AS n FROM {relation}" for name, relation in _COUNTS.items()
    ),
    "serving_top_sellers": "SELECT item_name, item_category, total_revenue FROM top_items",
    "serving_hours": _LAST_DAY_HOURS,
    "serving_channels": """
        SELECT channel, count(*) AS total_pageviews FROM item_views GROUP BY channel""",
    "serving_row_count": "SELECT count(*) AS row_count FROM performance",
    "count_parity": _PARITY,
    "hourly_exact": """
        SELECT date_trunc('hour', created_at) AS purchase_hour_start,
               CAST(sum(total_price) AS DECIMAL(20,2)) AS total_revenue
        FROM last_day GROUP BY 1""",
    "rfm_full": """
        SELECT s.*, CAST(coalesce(p.spent, 0) AS DECIMAL(20,2)) AS total_spent,
               CASE WHEN coalesce(p.spent, 0) >= 200 THEN 'high_value'
                    ELSE 'low_value' END AS value_segment
        FROM segments s
        LEFT JOIN (SELECT user_id, sum(total_price) AS spent FROM enriched
                   WHERE created_at <= @AS_OF GROUP BY user_id) p ON s.user_id = p.user_id""",
    "quality_gates": " UNION ALL ".join(
        [
            _gate("silver.users", "silver_users", "id", ["email", "full_name"]),
            _gate("silver.items", "silver_items", "id", ["name", "price"]),
            _gate("silver.purchases_enriched", "enriched", "id",
                  ["total_price", "user_email", "item_name"]),
            _gate("silver.pageviews_by_items", "item_views", None, ["item_id", "item_name"]),
            _gate("bronze.users", "users", "id", ["email"]),
            _gate("bronze.purchases", "purchases", "id", ["quantity"]),
        ]
    ),
    "latest_per_key": "SELECT * FROM upserted",
    "incremental_load": "SELECT * FROM upserted",
    "stored_upsert": "SELECT * FROM upserted",
    "served_full_table": "SELECT item_id, revenue, pageviews FROM performance",
    "refreshed_silver_users": "SELECT * FROM silver_users",
    "refreshed_silver_items": "SELECT * FROM silver_items",
    "refreshed_silver_purchases_enriched": "SELECT * FROM enriched",
    "refreshed_silver_pageviews_by_items": """
        SELECT * REPLACE (date_trunc('second', received_at) AS received_at) FROM item_views""",
    "refreshed_gold_item_performance": "SELECT * FROM performance",
    "refreshed_gold_top_selling_items": "SELECT * FROM top_items",
    "refreshed_gold_sales_performance_24h": _LAST_DAY_HOURS,
    "refreshed_gold_pageviews_by_channel": """
        SELECT channel, count(*) AS total_pageviews FROM item_views GROUP BY channel""",
    "refreshed_gold_user_engagement_segments": "SELECT * FROM segments",
    "backfill_24h": """
        SELECT purchase_hour, CAST(sum(total_price) AS DECIMAL(20,2)) AS total_revenue
        FROM enriched
        WHERE created_at >= TIMESTAMP '2024-01-09' AND created_at <= TIMESTAMP '2024-01-10'
        GROUP BY purchase_hour""",
    "namespaces": " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, CAST({n} AS BIGINT) AS tables FROM (SELECT count(*) FROM part)"
        for layer, n in (("bronze", 4), ("silver", 4), ("gold", 5))
    ),
    "rejected_values": """
        SELECT 'bronze.purchases' AS "table", 'quantity_kept' AS "check",
               count(*) FILTER (id % 10 = 3) AS failures, count(*) FILTER (id % 10 = 3) = 0 AS passed
        FROM purchases
        UNION ALL SELECT 'bronze.pageviews', 'lines_parsed', count(*) FILTER (channel = 'signup'),
               count(*) FILTER (channel = 'signup') = 0 FROM pageviews
        UNION ALL SELECT 'bronze.pageviews', 'lines_with_values', count(*) FILTER (channel = 'signup'),
               count(*) FILTER (channel = 'signup') = 0 FROM pageviews
        UNION ALL SELECT 'bronze.purchases', 'quantity_present', count(*) FILTER (id % 10 = 3),
               count(*) FILTER (id % 10 = 3) = 0 FROM purchases
        UNION ALL SELECT 'bronze.purchases', 'not_empty', 0, count(*) > 0 FROM purchases
        UNION ALL SELECT 'bronze.purchases', 'id_unique', 0, true FROM (SELECT count(*) FROM part)""",
    "as_of_load": "SELECT * FROM items",
    "interval_history": """
        SELECT *, CAST(1 AS BIGINT) AS load_id FROM items UNION ALL SELECT *, 2 FROM upserted
        UNION ALL SELECT *, 3 FROM items WHERE id % 4 <> 1 UNION ALL SELECT *, 4 FROM upserted""",
    "activity_merged": "SELECT * FROM segments",
    "content_parity": _content(),
    "load_log": """
        SELECT CAST(1 AS BIGINT) AS load_id, TIMESTAMP '2024-01-01' AS loaded_at,
               'overwrite' AS operation, count(*) AS row_count FROM items
        UNION ALL
        SELECT CAST(2 AS BIGINT), TIMESTAMP '2024-01-02', 'upsert', count(*) FROM upserted""",
    "schema_evolution": """
        SELECT user_id, url, NULL AS ua, received_at FROM pageviews
        UNION ALL SELECT user_id, url, 'agent-' || channel, received_at FROM pageviews
        UNION ALL SELECT user_id, url, 'agent-3', received_at FROM pageviews""",
}

#: The sources as three deliveries leave them, under the names that the layers are built from.
_DELIVERED = """
users AS (
  SELECT * REPLACE (
    CASE WHEN id % 4 <> 0 THEN email WHEN email IS NULL THEN 'n' || id || '@example.com' END AS email,
    CASE WHEN id % 4 = 0 THEN updated_at + INTERVAL 1 DAY ELSE updated_at END AS updated_at)
  FROM users_0
),
items AS (
  SELECT id, CASE WHEN id % 11 = 0 THEN name || '!' ELSE name END AS name,
         CASE WHEN id % 11 <> 0 AND id % 9 = 0 THEN 'moved' ELSE category END AS category,
         CASE WHEN id % 11 <> 0 AND id % 3 = 0 THEN CAST(price + 0.10 AS DECIMAL(7,2)) ELSE price END AS price,
         inventory, created_at,
         updated_at + INTERVAL 1 DAY * (CASE WHEN id % 11 = 0 THEN 2 WHEN id % 3 = 0 THEN 1 ELSE 0 END) AS updated_at
  FROM items_0
  UNION ALL SELECT id + 1000000, name, category, price, inventory, created_at, updated_at
  FROM items_0 WHERE id % 7 = 0
),
purchases AS (
  SELECT * EXCLUDE (early) REPLACE (
    CASE WHEN id % 10 = 5 AND early THEN item_id + 1 ELSE item_id END AS item_id,
    CAST(CASE WHEN id % 10 = 0 AND early THEN quantity + 1 ELSE quantity END AS INTEGER) AS quantity,
    CASE WHEN id % 5 = 0 AND early THEN updated_at + INTERVAL 1 DAY ELSE updated_at END AS updated_at)
  FROM (SELECT *, created_at < TIMESTAMP '2024-01-17' AS early FROM purchases_0)
),
pageviews AS (
  SELECT * REPLACE (date_trunc('second', received_at) AS received_at) FROM pageviews_0
),
"""
_AFTER = _BASE
for _name in ("users", "items", "purchases", "pageviews"):
    _AFTER = _AFTER.replace(f"\n{_name} AS (", f"\n{_name}_0 AS (")
_AFTER = _AFTER.replace("silver_users AS (", _DELIVERED.strip() + "\nsilver_users AS (", 1)
# Bulk purchases have a table of their own and are left out.
_MAINTAINED = {
    "maintained_purchases_enriched": "SELECT * FROM enriched",
    "maintained_pageviews_by_items": "SELECT * FROM item_views",
    "maintained_item_performance": "SELECT * FROM performance",
    "maintained_top_selling_items": "SELECT * FROM top_items",
    "maintained_sales_performance_24h": _LAST_DAY_HOURS,
    "maintained_pageviews_by_channel": _SELECTS["pageviews_by_channel"],
    "maintained_user_engagement_segments": "SELECT * FROM segments",
}

ORACLES: dict[str, str] = {
    name: (_AFTER + select).replace("@AS_OF", AS_OF) for name, select in _MAINTAINED.items()
} | {
    name: (_BASE + select).replace("@AS_OF", AS_OF) for name, select in _SELECTS.items()
}
