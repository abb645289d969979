"""DuckDB SQL equivalents of the registered queries, over the test tables as views.

Shared CTEs mirror the Spark mapping in ``sources/testdata.py``: money in
decimal, rounded half-up to cents, exposed as double.
"""

from __future__ import annotations

PRICED_LINES = """
priced_lines AS (
  SELECT order_id, product_id, line_number, title, quantity, up, pct, tax, lt,
         CAST(ROUND(lt * (1 - pct * 0.01), 2) AS DECIMAL(14,2)) AS ldt
  FROM (
    SELECT l.l_orderkey AS order_id, l.l_partkey AS product_id, l.l_linenumber AS line_number,
           p.p_name AS title,
           CAST(l.l_quantity AS INTEGER) AS quantity,
           CAST(p.p_retailprice AS DECIMAL(14,2)) AS up,
           CAST(CAST(l.l_discount AS DECIMAL(6,4)) * 100 AS DECIMAL(5,2)) AS pct,
           CAST(CAST(l.l_tax AS DECIMAL(6,4)) * 100 AS DECIMAL(5,2)) AS tax,
           CAST(ROUND(CAST(p.p_retailprice AS DECIMAL(14,2)) * CAST(l.l_quantity AS INTEGER), 2)
                AS DECIMAL(14,2)) AS lt
    FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey
  )
)"""

STAGED_ITEMS = PRICED_LINES + """,
staged_items AS (
  SELECT pl.order_id, pl.product_id, pl.quantity,
         CAST(pl.up AS DOUBLE) AS unit_price, CAST(pl.lt AS DOUBLE) AS line_total,
         CAST(pl.pct AS DOUBLE) AS discount_percentage,
         CAST(pl.ldt AS DOUBLE) AS line_discounted_total,
         CAST(o.o_orderdate AS DATE) AS extraction_date,
         CAST(o.o_orderdate AS TIMESTAMP) AS loaded_at
  FROM priced_lines pl LEFT JOIN orders o ON pl.order_id = o.o_orderkey
)"""

FACT_ORDER = ("loaded_at DESC, date_key DESC, quantity DESC, unit_price DESC, line_total DESC, "
              "discount_percentage DESC, line_discounted_total DESC")


def fact_from(source: str, name: str = "fact") -> str:
    """CTE: dedup'd fact over a CTE with the staged-items columns."""
    return f"""
{name} AS (
  SELECT CAST(order_id AS VARCHAR) || '_' || CAST(product_id AS VARCHAR) AS order_item_key,
         order_id, product_id, extraction_date AS date_key, quantity, unit_price, line_total,
         discount_percentage, line_discounted_total, loaded_at
  FROM {source}
  QUALIFY row_number() OVER (
    PARTITION BY CAST(order_id AS VARCHAR) || '_' || CAST(product_id AS VARCHAR)
    ORDER BY {FACT_ORDER.replace('date_key', 'extraction_date')}) = 1
)"""


FACT = STAGED_ITEMS + "," + fact_from("staged_items")


def summary_select(fact: str = "fact") -> str:
    return f"""
SELECT date_key,
       CAST(count(DISTINCT order_id) AS BIGINT) AS total_orders,
       CAST(sum(quantity) AS BIGINT) AS total_quantity,
       CAST(ROUND(sum(CAST(line_total AS DECIMAL(14,2))), 2) AS DOUBLE) AS total_revenue,
       CAST(ROUND(sum(CAST(line_discounted_total AS DECIMAL(14,2))), 2) AS DOUBLE)
         AS total_discounted_revenue,
       max(loaded_at) AS loaded_at
FROM {fact}
GROUP BY date_key"""


ORACLE: dict[str, str] = {}

ORACLE["fact_order_items"] = f"WITH {FACT}\nSELECT * FROM fact"
ORACLE["daily_sales_summary"] = f"WITH {FACT}\n{summary_select()}"

ORACLE["stg_products_latest"] = """
WITH sales AS (SELECT l_partkey AS product_id, count(*) AS n FROM lineitem GROUP BY 1)
SELECT p.p_partkey AS product_id, p.p_name AS title, p.p_type AS category,
       CAST(CAST(p.p_retailprice AS DECIMAL(14,2)) AS DOUBLE) AS price,
       CAST(p.p_size AS DOUBLE) / 10 AS rating_rate, CAST(coalesce(n, 0) AS INTEGER) AS rating_count,
       DATE '1998-01-01' AS extraction_date, TIMESTAMP '1998-01-01' AS loaded_at
FROM part p LEFT JOIN sales ON p.p_partkey = sales.product_id"""

ORACLE["dim_product"] = f"""
SELECT product_id, title, category, price, rating_rate, rating_count
FROM ({ORACLE['stg_products_latest']})"""

ORDER_TOTALS = PRICED_LINES + """,
totals AS (
  SELECT order_id, ROUND(sum(lt), 2) AS t, ROUND(sum(ldt), 2) AS dt, count(*) AS n,
         sum(quantity) AS q
  FROM priced_lines GROUP BY order_id
)"""

ORACLE["stg_orders_latest"] = f"""
WITH {ORDER_TOTALS}
SELECT o.o_orderkey AS order_id, o.o_custkey AS user_id,
       CAST(coalesce(t, 0) AS DOUBLE) AS order_total,
       CAST(coalesce(dt, 0) AS DOUBLE) AS order_discounted_total,
       CAST(coalesce(n, 0) AS INTEGER) AS total_products,
       CAST(coalesce(q, 0) AS INTEGER) AS total_quantity,
       CAST(o.o_orderdate AS DATE) AS extraction_date, o.o_orderdate AS loaded_at
FROM orders o LEFT JOIN totals ON totals.order_id = o.o_orderkey"""

ORACLE["stg_orders_incremental"] = f"""
WITH first AS ({ORACLE['stg_orders_latest']})
SELECT * REPLACE (
         CASE WHEN order_id % 14 = 0 THEN user_id + 1 ELSE user_id END AS user_id,
         CASE WHEN order_id % 14 = 0 THEN CAST(extraction_date + INTERVAL 1 DAY AS DATE) ELSE extraction_date END AS extraction_date,
         CASE WHEN order_id % 14 = 0 THEN TIMESTAMP '2026-01-01 03:00:00'
              WHEN year(extraction_date) > 1998 THEN TIMESTAMP '2026-01-01 02:00:00'
              ELSE TIMESTAMP '2026-01-01 01:00:00' END AS loaded_at)
FROM first"""

ORACLE["stg_products_incremental"] = ORACLE["stg_products_latest"]

ORACLE["order_rollup"] = f"""
WITH {ORDER_TOTALS}
SELECT o.o_orderkey AS order_id, o.o_custkey AS user_id,
       CAST(o.o_orderdate AS DATE) AS extraction_date,
       CAST(coalesce(t, 0) AS DOUBLE) AS order_total, CAST(coalesce(dt, 0) AS DOUBLE) AS order_discounted_total,
       CAST(coalesce(n, 0) AS INTEGER) AS total_products, CAST(coalesce(q, 0) AS INTEGER) AS total_quantity
FROM orders o LEFT JOIN totals ON totals.order_id = o.o_orderkey"""

ORACLE["stg_order_items_flatten"] = f"WITH {STAGED_ITEMS}\nSELECT * FROM staged_items"

ORACLE["variant_path_events"] = """
SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events"""

ORACLE["dim_date"] = """
WITH b AS (SELECT min(CAST(o_orderdate AS DATE)) AS s, max(CAST(o_orderdate AS DATE)) AS e
           FROM orders),
spine AS (SELECT CAST(unnest(generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP),
                                             INTERVAL 1 DAY)) AS DATE) AS d FROM b)
SELECT d AS date_key, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
       CAST(day(d) AS INTEGER) AS day, strftime(d, '%a') AS day_name,
       CAST(dayofweek(d) AS INTEGER) AS day_of_week
FROM spine"""

DIM_PRODUCT_CTE = f"dimp AS ({ORACLE['dim_product']})"
JOINED = f"""{FACT}, {DIM_PRODUCT_CTE},
joined AS (
  SELECT f.order_id, f.product_id, f.date_key, f.quantity, f.unit_price, f.line_total,
         f.discount_percentage, f.line_discounted_total,
         p.title, p.category, p.rating_rate, p.rating_count
  FROM fact f LEFT JOIN dimp p ON f.product_id = p.product_id
)"""

ORACLE["fact_product_join"] = f"WITH {JOINED}\nSELECT * FROM joined"

ORACLE["kpi_row"] = f"""
WITH {JOINED}
SELECT coalesce(CAST(ROUND(sum(CAST(line_total AS DECIMAL(14,2))), 2) AS DOUBLE), 0.0) AS total_revenue,
       count(DISTINCT order_id) AS total_orders,
       CAST(coalesce(sum(quantity), 0) AS BIGINT) AS items_sold,
       CAST(sum(CAST(discount_percentage AS DECIMAL(30,12))) AS DOUBLE)
         / CAST(count(discount_percentage) AS DOUBLE) AS avg_discount
FROM joined"""

ORACLE["revenue_by_category"] = f"""
WITH {JOINED}
SELECT category, CAST(ROUND(sum(CAST(line_total AS DECIMAL(14,2))), 2) AS DOUBLE) AS line_total
FROM joined WHERE category IS NOT NULL GROUP BY category ORDER BY line_total DESC, category"""

ORACLE["top10_products"] = f"""
WITH {JOINED}
SELECT title, CAST(sum(quantity) AS BIGINT) AS quantity
FROM joined WHERE title IS NOT NULL GROUP BY title ORDER BY quantity DESC, title LIMIT 10"""

ORACLE["price_vs_rating"] = f"""
WITH {JOINED}
SELECT product_id, rating_rate, unit_price, rating_count, title FROM joined
QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY date_key, order_id, unit_price) = 1"""

ORACLE["daily_trend"] = f"""
WITH {FACT}, summ AS ({summary_select()})
SELECT date_key, total_revenue, (SELECT count(*) FROM summ) < 2 AS few_days FROM summ"""

_DIM_DATE_CTE = f"dimd AS ({ORACLE['dim_date']})"


def _unique(table: str, col: str) -> str:
    return (f"SELECT 'unique' AS check_name, '{table}' AS table_name, '{col}' AS column_name, "
            f"CAST((SELECT count(*) FROM (SELECT {col} FROM {{t}} WHERE {col} IS NOT NULL "
            f"GROUP BY {col} HAVING count(*) > 1)) AS BIGINT) AS failures")


def _check(kind: str, table: str, alias: str, col: str, parent: str | None = None,
           pcol: str | None = None) -> str:
    if kind == "unique":
        return _unique(table, col).format(t=alias)
    if kind == "not_null":
        body = f"SELECT count(*) FROM {alias} WHERE {col} IS NULL"
    else:
        body = (f"SELECT count(*) FROM {alias} c WHERE c.{col} IS NOT NULL AND NOT EXISTS "
                f"(SELECT 1 FROM {parent} p WHERE p.{pcol} = c.{col})")
    return (f"SELECT '{kind}' AS check_name, '{table}' AS table_name, '{col}' AS column_name, "
            f"CAST(({body}) AS BIGINT) AS failures")


_CHECKS = [
    ("unique", "dim_date", "dimd", "date_key"), ("not_null", "dim_date", "dimd", "date_key"),
    ("unique", "dim_product", "dimp", "product_id"),
    ("not_null", "dim_product", "dimp", "product_id"),
    ("unique", "fact_order_items", "fact", "order_item_key"),
    ("not_null", "fact_order_items", "fact", "order_item_key"),
    ("not_null", "fact_order_items", "fact", "product_id"),
    ("relationships", "fact_order_items", "fact", "product_id", "dimp", "product_id"),
    ("not_null", "fact_order_items", "fact", "date_key"),
    ("relationships", "fact_order_items", "fact", "date_key", "dimd", "date_key"),
    ("unique", "agg_daily_sales_summary", "summ", "date_key"),
    ("not_null", "agg_daily_sales_summary", "summ", "date_key"),
]

ORACLE["quality_report"] = (
    f"WITH {FACT}, {DIM_PRODUCT_CTE}, {_DIM_DATE_CTE}, summ AS ({summary_select()}),\n"
    "checks AS (" + "\nUNION ALL\n".join(_check(*c) for c in _CHECKS) + ")\n"
    "SELECT *, failures = 0 AS passed FROM checks")

_DEFECTS = {"dimd": "days_d", "dimp": "parts_d", "fact": "fact_d", "summ": "summ_d"}

ORACLE["quality_report_defects"] = (
    f"WITH {FACT}, {DIM_PRODUCT_CTE}, {_DIM_DATE_CTE},\n" + """
fact_d AS (
  SELECT CASE WHEN order_id % 40 <> 0 THEN order_item_key END AS order_item_key,
         CASE WHEN order_id % 60 <> 0 THEN product_id END AS product_id,
         CASE WHEN order_id % 80 <> 0 THEN date_key END AS date_key
  FROM (SELECT * FROM fact UNION ALL SELECT * FROM fact WHERE order_id % 50 = 0)
),
parts_d AS (
  SELECT product_id FROM dimp WHERE product_id % 17 <> 0
  UNION ALL SELECT product_id FROM dimp WHERE product_id % 19 = 0
  UNION ALL SELECT NULL FROM dimp WHERE product_id % 23 = 0
),
days_d AS (
  SELECT CASE WHEN day <> 2 THEN date_key END AS date_key
  FROM (SELECT * FROM dimd WHERE day <> 31 UNION ALL SELECT * FROM dimd WHERE day = 1)
),
dates AS (SELECT DISTINCT date_key FROM fact_d),
summ_d AS (SELECT * FROM dates UNION ALL SELECT * FROM dates WHERE day(date_key) = 3),
checks AS (""" + "\nUNION ALL\n".join(
        _check(k, t, _DEFECTS[a], c, *([_DEFECTS[more[0]], more[1]] if more else []))
        for k, t, a, c, *more in _CHECKS) + ")\n"
    "SELECT *, failures = 0 AS passed FROM checks")

_BLOCK_IDS = """
ids AS (
  SELECT CAST(o_orderdate AS DATE) AS extraction_date, o_orderkey AS order_id,
         CAST(date_diff('day', DATE '2026-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS day_index,
         row_number() OVER (PARTITION BY CAST(o_orderdate AS DATE) ORDER BY o_orderkey) AS seq_in_day
  FROM orders
)"""

ORACLE["order_id_blocks"] = f"""
WITH {_BLOCK_IDS}
SELECT extraction_date, order_id, day_index, seq_in_day,
       CAST(day_index AS BIGINT) * 100 + seq_in_day AS block_id
FROM ids"""

ORACLE["order_invariants"] = f"""
WITH {STAGED_ITEMS},
totals AS (
  SELECT order_id, ROUND(sum(lt), 2) AS t, ROUND(sum(ldt), 2) AS dt, count(*) AS n
  FROM priced_lines GROUP BY order_id
),
ord AS (
  SELECT o.o_orderkey AS order_id, CAST(coalesce(t, 0) AS DOUBLE) AS order_total,
         CAST(coalesce(dt, 0) AS DOUBLE) AS order_discounted_total,
         CAST(coalesce(n, 0) AS INTEGER) AS total_products
  FROM orders o LEFT JOIN totals ON totals.order_id = o.o_orderkey
),
{_BLOCK_IDS},
per_day AS (
  SELECT extraction_date, min(CAST(day_index AS BIGINT) * 100 + seq_in_day) AS lo,
         max(CAST(day_index AS BIGINT) * 100 + seq_in_day) AS hi
  FROM ids GROUP BY extraction_date
),
lagged AS (
  SELECT lo, max(hi) OVER (ORDER BY extraction_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_hi
  FROM per_day
)
SELECT 'total_below_discounted' AS check_name,
       CAST((SELECT count(*) FROM ord WHERE order_total < order_discounted_total) AS BIGINT) AS failures
UNION ALL SELECT 'items_out_of_range',
       CAST((SELECT count(*) FROM ord WHERE total_products < 1 OR total_products > 5) AS BIGINT)
UNION ALL SELECT 'line_total_mismatch',
       CAST((SELECT count(*) FROM staged_items
             WHERE CAST(line_total AS DECIMAL(14,2)) <> ROUND(CAST(unit_price AS DECIMAL(14,2)) * quantity, 2)) AS BIGINT)
UNION ALL SELECT 'quantity_out_of_range',
       CAST((SELECT count(*) FROM staged_items WHERE quantity < 1 OR quantity > 4) AS BIGINT)
UNION ALL SELECT 'day_id_ranges_disjoint',
       CAST((SELECT count(*) FROM lagged WHERE lo <= prev_hi) AS BIGINT)"""

ORACLE["validate_products"] = """
SELECT p_partkey AS product_id,
       p_size NOT IN (1, 3, 4, 5, 7, 8) AS valid,
       CASE p_size WHEN 1 THEN 'price' WHEN 3 THEN 'title' WHEN 4 THEN 'rating'
                   WHEN 5 THEN 'rating.count' WHEN 7 THEN 'category' WHEN 8 THEN 'description'
                   ELSE '' END AS errors
FROM part"""

ORACLE["stable_daily_sample"] = f"""
WITH {FACT}
SELECT date_key, order_item_key,
       CAST(row_number() OVER (PARTITION BY date_key
            ORDER BY md5(strftime(date_key, '%Y-%m-%d') || '|' || order_item_key), order_item_key)
            AS INTEGER) AS pick_rank
FROM fact
QUALIFY pick_rank <= 3"""

ORACLE["catalogue_sample_per_date"] = """
WITH size AS (SELECT count(*) AS n FROM part WHERE p_partkey IS NOT NULL),
prime AS (
  SELECT min(c) AS p FROM (SELECT unnest(range(greatest(n, 2), greatest(n, 2) + 1000)) AS c FROM size)
  WHERE NOT EXISTS (SELECT 1 FROM range(2, 100000) d(d) WHERE d * d <= c AND c % d = 0)
),
dates AS (
  SELECT DISTINCT CAST(o_orderdate AS DATE) AS extraction_date,
         md5(coalesce(strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d'), '')) AS h
  FROM orders
),
slots AS (
  SELECT extraction_date, j,
         ((1 + ('0x' || substr(h, 1, 13))::BIGINT % (p - 1)) * j + ('0x' || substr(h, 14, 13))::BIGINT % p) % p AS pick
  FROM (SELECT *, unnest(range(0, least(p, 5 + p - n))) AS j FROM dates, size, prime)
),
picks AS (
  SELECT extraction_date, pick, row_number() OVER (PARTITION BY extraction_date ORDER BY j) AS pick_rank
  FROM slots, size WHERE pick < n QUALIFY pick_rank <= 5
),
numbered AS (SELECT *, row_number() OVER (ORDER BY p_partkey) - 1 AS number FROM part WHERE p_partkey IS NOT NULL)
SELECT extraction_date, CAST(pick_rank AS INTEGER) AS pick_rank, p_partkey AS product_id, p_name AS title,
       CAST(CAST(p_retailprice AS DECIMAL(14,2)) AS DOUBLE) AS price
FROM picks JOIN numbered ON pick = number"""

_STAMP_CASE = """CASE WHEN extraction_date >= DATE '1999-01-01' THEN TIMESTAMP '2026-01-01 02:00:00'
            WHEN extraction_date >= DATE '1997-01-01' THEN TIMESTAMP '2026-01-01 01:00:00'
            ELSE TIMESTAMP '2026-01-01 03:00:00' END"""

_STAMPED = f"""{STAGED_ITEMS},
stamped AS (
  SELECT order_id, product_id, quantity, unit_price, line_total, discount_percentage,
         line_discounted_total, extraction_date, {_STAMP_CASE} AS loaded_at
  FROM staged_items
)"""

ORACLE["daily_summary_incremental"] = f"WITH {_STAMPED}, {fact_from('stamped')}\n{summary_select()}"

ORACLE["affected_dates"] = f"""
WITH {_STAMPED}, {fact_from('stamped')},
before_last AS (SELECT * FROM fact WHERE loaded_at < TIMESTAMP '2026-01-01 03:00:00'),
summ AS ({summary_select('before_last')})
SELECT DISTINCT date_key FROM fact
WHERE loaded_at > (SELECT coalesce(max(loaded_at), TIMESTAMP '1900-01-01') FROM summ)"""

ORACLE["fact_incremental_revision"] = f"""
WITH {STAGED_ITEMS},
v1 AS (
  SELECT order_id, product_id, quantity, unit_price, line_total, discount_percentage,
         line_discounted_total, extraction_date, TIMESTAMP '2026-01-01 01:00:00' AS loaded_at
  FROM staged_items
),
v2 AS (
  SELECT l.l_orderkey AS order_id, l.l_partkey AS product_id,
         CAST(l.l_quantity AS INTEGER) AS quantity,
         CAST(CAST(p.p_retailprice AS DECIMAL(14,2)) AS DOUBLE) AS unit_price,
         CAST(ROUND(CAST(p.p_retailprice AS DECIMAL(14,2)) * CAST(l.l_quantity AS INTEGER), 2) AS DOUBLE)
           AS line_total,
         CAST(0 AS DOUBLE) AS discount_percentage,
         CAST(ROUND(CAST(p.p_retailprice AS DECIMAL(14,2)) * CAST(l.l_quantity AS INTEGER), 2) AS DOUBLE)
           AS line_discounted_total,
         CAST(l.l_shipdate AS DATE) AS extraction_date,
         TIMESTAMP '2026-01-01 02:00:00' AS loaded_at
  FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey
  WHERE l.l_returnflag = 'R'
),
allv AS (SELECT * FROM v1 UNION ALL SELECT * FROM v2),
{fact_from('allv')}
SELECT * FROM fact"""

ORACLE["fact_schema_sync"] = f"""
WITH {PRICED_LINES},
items AS (
  SELECT pl.order_id, pl.product_id, pl.quantity,
         CAST(pl.up AS DOUBLE) AS unit_price, CAST(pl.lt AS DOUBLE) AS line_total,
         CAST(pl.pct AS DOUBLE) AS discount_percentage,
         CAST(pl.ldt AS DOUBLE) AS line_discounted_total,
         CAST(pl.tax AS DOUBLE) AS tax_percentage,
         CAST(o.o_orderdate AS DATE) AS date_key,
         CAST(pl.order_id AS VARCHAR) || '_' || CAST(pl.product_id AS VARCHAR) AS order_item_key
  FROM priced_lines pl LEFT JOIN orders o ON pl.order_id = o.o_orderkey
),
f1 AS (
  SELECT order_item_key, order_id, product_id, date_key, quantity, unit_price, line_total,
         line_discounted_total, CAST(NULL AS DOUBLE) AS tax_percentage,
         TIMESTAMP '2026-01-01 01:00:00' AS loaded_at
  FROM items WHERE date_key < DATE '1998-01-01' OR date_key IS NULL
  QUALIFY row_number() OVER (PARTITION BY order_item_key ORDER BY date_key DESC, quantity DESC,
          unit_price DESC, line_total DESC, discount_percentage DESC, line_discounted_total DESC) = 1
),
f2 AS (
  SELECT order_item_key, order_id, product_id, date_key, quantity, unit_price, line_total,
         line_discounted_total, tax_percentage, TIMESTAMP '2026-01-01 02:00:00' AS loaded_at
  FROM items WHERE date_key >= DATE '1998-01-01'
  QUALIFY row_number() OVER (PARTITION BY order_item_key ORDER BY date_key DESC, quantity DESC,
          unit_price DESC, line_total DESC, line_discounted_total DESC, tax_percentage DESC) = 1
)
SELECT * FROM f1 UNION ALL SELECT * FROM f2"""

ORACLE["ledger_pending_files"] = """
WITH files AS (
  SELECT 'orders_' || strftime(d, '%Y-%m-%d') || '.json' AS file_name, d AS extraction_date,
         count(*) AS record_count
  FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders) GROUP BY d
),
ledger AS (SELECT DISTINCT 'orders_' || strftime(l_shipdate, '%Y-%m-%d') || '.json' AS file_name FROM lineitem
           WHERE l_quantity = 1)
SELECT * FROM files f WHERE NOT EXISTS (SELECT 1 FROM ledger l WHERE l.file_name = f.file_name)"""

ORACLE["served_summary"] = f"""
WITH {FACT}
SELECT date_key, total_orders, total_quantity, total_revenue, total_discounted_revenue
FROM ({summary_select()}) ORDER BY date_key"""

ORACLE["push_payload_batches"] = f"""
WITH {FACT}, summ AS ({summary_select()}),
numbered AS (SELECT *, row_number() OVER (ORDER BY date_key) AS rn FROM summ)
SELECT CAST((rn - 1) // 10 AS BIGINT) AS batch_id, CAST(count(*) AS INTEGER) AS n_records,
       min(date_key) AS first_date, max(date_key) AS last_date,
       '{{"performUpsert":{{"fieldsToMergeOn":["date_key"]}},"records":[' || string_agg(
         '{{"fields":{{"date_key":"' || strftime(date_key, '%Y-%m-%d') || '","total_orders":' || total_orders
         || ',"total_quantity":' || total_quantity || ',"total_revenue":' || total_revenue
         || ',"total_discounted_revenue":' || total_discounted_revenue || '}}}}', ',' ORDER BY date_key) || ']}}' AS payload
FROM numbered GROUP BY 1"""

ORACLE["push_upsert_counts"] = f"""
WITH {FACT}, summ AS ({summary_select()}),
numbered AS (SELECT date_key, row_number() OVER (ORDER BY date_key) AS rn FROM summ)
SELECT CAST((rn - 1) // 10 AS BIGINT) AS batch_id,
       CAST(sum(CASE WHEN date_key < DATE '1997-01-01' THEN 1 ELSE 0 END) AS INTEGER) AS created,
       CAST(sum(CASE WHEN date_key >= DATE '1997-01-01' THEN 1 ELSE 0 END) AS INTEGER) AS updated
FROM numbered GROUP BY 1"""

ORACLE["push_delivery"] = f"""
WITH {FACT}, summ AS ({summary_select()}),
numbered AS (SELECT date_key, row_number() OVER (ORDER BY date_key) AS rn FROM summ)
SELECT CAST((rn - 1) // 10 AS BIGINT) AS batch_id, CAST(200 AS INTEGER) AS status, CAST(2 AS INTEGER) AS attempts,
       CAST(sum(CASE WHEN date_key >= DATE '1997-01-01' THEN 1 ELSE 0 END) AS INTEGER) AS created,
       CAST(sum(CASE WHEN date_key < DATE '1997-01-01' THEN 1 ELSE 0 END) AS INTEGER) AS updated,
       CAST(NULL AS VARCHAR) AS error
FROM numbered GROUP BY 1"""

ORACLE["daily_job"] = f"""
WITH {FACT}
SELECT date_key, total_orders, total_quantity, total_revenue, total_discounted_revenue,
       CAST(12 AS INTEGER) AS checks_passed, true AS backfill_loaded
FROM ({summary_select()})"""

_FILE_NAME = "'orders_' || coalesce(strftime({d}, '%Y-%m-%d'), 'undated') || '.json'"

ORACLE["order_envelope"] = f"""
WITH {ORDER_TOTALS}
SELECT CAST(o_orderdate AS DATE) AS extraction_date, 'orders' AS source,
       CAST(count(*) AS BIGINT) AS record_count, CAST(0 AS BIGINT) AS broken_files, count(DISTINCT o_orderkey) AS orders,
       CAST(sum(coalesce(q, 0)) AS BIGINT) AS quantity, CAST(sum(CAST(coalesce(t, 0) AS DECIMAL(14,2))) AS DOUBLE) AS total,
       {_FILE_NAME.format(d='CAST(o_orderdate AS DATE)')} AS file_name
FROM orders LEFT JOIN totals ON order_id = o_orderkey GROUP BY CAST(o_orderdate AS DATE)"""

ORACLE["landed_order_items"] = f"""
WITH {STAGED_ITEMS}
SELECT s.* EXCLUDE (loaded_at), {_FILE_NAME.format(d='extraction_date')} AS source_file
FROM staged_items s JOIN orders ON order_id = o_orderkey"""

ORACLE["relanded_dates"] = f"""
SELECT {_FILE_NAME.format(d='CAST(o_orderdate AS DATE)')} AS file_name, CAST(1 AS BIGINT) AS loads,
       CAST(count(*) AS BIGINT) AS records, CAST(count(*) AS BIGINT) AS raw_rows
FROM orders GROUP BY CAST(o_orderdate AS DATE)"""

ORACLE["ingest_broken_files"] = f"""
WITH files AS (
  SELECT CAST(o_orderdate AS DATE) AS d, {_FILE_NAME.format(d='CAST(o_orderdate AS DATE)')} AS file_name,
         CAST(count(*) AS BIGINT) AS records
  FROM orders GROUP BY CAST(o_orderdate AS DATE)
)
SELECT CAST(run AS INTEGER) AS run, file_name,
       CASE WHEN run = 1 AND day(d) = 13 THEN 'not one JSON document' END AS reason,
       CASE WHEN run = 1 AND day(d) = 13 THEN NULL ELSE records END AS records
FROM files, (VALUES (1), (2)) AS r(run)"""

ORACLE["stream_file_ingest_summary"] = f"""
WITH {FACT}
SELECT date_key, total_orders, total_quantity, total_revenue, total_discounted_revenue
FROM ({summary_select()})"""

# the orders with the planted missing dates
_UNDATED_ITEMS = """undated_orders AS (
  SELECT * REPLACE (CASE WHEN o_orderkey % 7 <> 0 THEN o_orderdate END AS o_orderdate) FROM orders
),""" + STAGED_ITEMS.replace("LEFT JOIN orders o", "LEFT JOIN undated_orders o")

ORACLE["stream_undated"] = f"""
WITH {_UNDATED_ITEMS}, {fact_from('staged_items')}
SELECT date_key, total_orders, total_quantity, total_revenue, total_discounted_revenue
FROM ({summary_select()})"""

ORACLE["daily_summary_incremental_undated"] = (
    f"WITH {_STAMPED.replace(STAGED_ITEMS, _UNDATED_ITEMS)}, {fact_from('stamped')}\n{summary_select()}")

ORACLE["affected_summary_recompute"] = f"""
WITH {_STAMPED}, {fact_from('stamped')},
before_last AS (SELECT * FROM fact WHERE loaded_at < TIMESTAMP '2026-01-01 03:00:00'),
summ AS ({summary_select('before_last')}),
affected AS (
  SELECT DISTINCT date_key FROM fact
  WHERE loaded_at > (SELECT coalesce(max(loaded_at), TIMESTAMP '1900-01-01') FROM summ)
),
affected_fact AS (
  SELECT * FROM fact f WHERE EXISTS (SELECT 1 FROM affected a WHERE a.date_key IS NOT DISTINCT FROM f.date_key)
)
{summary_select('affected_fact')}"""

ORACLE["fact_incremental_nulls"] = f"""
WITH {STAGED_ITEMS},
loads AS (
  SELECT * EXCLUDE (loaded_at, extraction_date, product_id, quantity),
         CASE WHEN order_id % 11 <> 0 THEN product_id END AS product_id, quantity,
         CASE WHEN order_id % 7 <> 0 THEN extraction_date END AS extraction_date,
         CASE WHEN extraction_date >= DATE '1997-01-01' THEN TIMESTAMP '2026-01-01 02:00:00'
              WHEN order_id % 13 <> 0 THEN TIMESTAMP '2026-01-01 01:00:00' END AS loaded_at
  FROM staged_items
  UNION ALL BY NAME
  SELECT * EXCLUDE (loaded_at, product_id, quantity),
         CASE WHEN order_id % 11 <> 0 THEN product_id END AS product_id, quantity + 1 AS quantity,
         TIMESTAMP '2026-01-01 03:00:00' AS loaded_at
  FROM staged_items WHERE order_id % 14 = 0
),
keyed AS (
  SELECT *, row_number() OVER (
    PARTITION BY order_id, product_id
    ORDER BY loaded_at DESC NULLS LAST, extraction_date DESC NULLS LAST, quantity DESC, unit_price DESC,
             line_total DESC, discount_percentage DESC, line_discounted_total DESC) AS rn
  FROM loads
)
SELECT CAST(order_id AS VARCHAR) || '_' || CAST(product_id AS VARCHAR) AS order_item_key,
       order_id, product_id, extraction_date AS date_key, quantity, unit_price, line_total,
       discount_percentage, line_discounted_total, loaded_at
FROM keyed WHERE rn = 1 OR product_id IS NULL"""
