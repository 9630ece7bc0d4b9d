"""CTEs that shape the raw test tables into the star schema, in DuckDB's dialect.

Every oracle statement starts with this text. ``paid``, ``visits``, ``sales``, ``goods`` and
``opinions`` are joins many statements share.
"""

PRELUDE = """
WITH raw_items AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice, l_tax,
         l_returnflag, l_linestatus
  FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
          ORDER BY l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_quantity, l_discount, l_tax,
                   l_returnflag, l_linestatus) AS rn FROM lineitem) t
  WHERE rn = 1
), dim_customers AS (
  SELECT o_orderkey AS customer_id,
         o_custkey * 10 + CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS customer_unique_id,
         c_nationkey AS customer_zip_code_prefix, lower(trim(c_mktsegment)) AS customer_city,
         n_name AS customer_state
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
), dim_sellers AS (
  SELECT s_suppkey AS seller_id, s_nationkey AS seller_zip_code_prefix,
         lower(trim(s_name)) AS seller_city, n_name AS seller_state
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
), category_translation AS (
  SELECT DISTINCT p_brand AS product_category_name,
         concat('category_', substr(p_brand, 7)) AS product_category_name_english
  FROM part WHERE CAST(substr(p_brand, 7) AS INT) <= 20
), dim_products AS (
  SELECT p.product_id, p.product_category_name,
         coalesce(t.product_category_name_english, p.product_category_name) AS product_category_english,
         p.product_weight_g
  FROM (SELECT p_partkey AS product_id, nullif(p_brand, 'Brand#25') AS product_category_name,
               CAST(p_size AS DOUBLE) AS product_weight_g FROM part) p
  LEFT JOIN category_translation t ON p.product_category_name = t.product_category_name
), geo AS (
  SELECT c_nationkey AS zip, CAST(c_acctbal AS DECIMAL(12,2)) AS lat, lower(trim(c_mktsegment)) AS city,
         n_name AS state
  FROM customer JOIN nation ON c_nationkey = n_nationkey
), state_regions AS (
  SELECT n_name AS customer_state, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey
), orders_base AS (
  SELECT o_orderkey AS order_id, o_orderkey AS customer_id,
         CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'P' THEN 'shipped' ELSE 'created' END AS order_status,
         o_orderdate + to_seconds(CAST((o_orderkey * 7919) % 86400 AS BIGINT)) AS order_purchase_timestamp
  FROM orders
), orders_ts AS (
  SELECT order_id, customer_id, order_status, order_purchase_timestamp,
         CASE WHEN order_id % 97 <> 0
              THEN order_purchase_timestamp + to_hours(CAST(order_id % 48 AS BIGINT)) END AS order_approved_at,
         CASE WHEN order_status IN ('delivered', 'shipped')
              THEN order_purchase_timestamp + to_hours(CAST(48 + order_id % 48 AS BIGINT)) END AS order_delivered_carrier_date,
         CASE WHEN order_status = 'delivered'
              THEN order_purchase_timestamp + to_hours(CAST(72 + (order_id * 31) % 600 AS BIGINT)) END AS order_delivered_customer_date,
         CAST(CAST(order_purchase_timestamp AS DATE) AS TIMESTAMP)
           + to_days(CAST(18 + order_id % 11 AS INTEGER)) AS order_estimated_delivery_date
  FROM orders_base
), fact_orders AS (
  SELECT *, date_diff('day', order_purchase_timestamp, order_delivered_customer_date) AS delivery_days,
         date_diff('day', order_delivered_customer_date, order_estimated_delivery_date) AS delivery_vs_estimate_days,
         CAST(date_trunc('month', order_purchase_timestamp) AS TIMESTAMP) AS month,
         CAST(order_purchase_timestamp AS DATE) AS day
  FROM orders_ts
), fact_order_items AS (
  SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id, l_suppkey AS seller_id,
         l_shipdate AS shipping_limit_date, CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS freight_value
  FROM raw_items
), fact_payments AS (
  SELECT l_orderkey AS order_id, l_linenumber AS payment_sequential,
         CASE l_returnflag WHEN 'A' THEN 'credit_card' WHEN 'N' THEN 'boleto'
              ELSE CASE l_linestatus WHEN 'F' THEN 'voucher' ELSE 'debit_card' END END AS payment_type,
         CAST(l_quantity AS INT) % 13 AS payment_installments,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS payment_value
  FROM raw_items
), fact_reviews AS (
  SELECT *, date_diff('day', review_creation_date, review_answer_timestamp) AS answer_latency_days
  FROM (SELECT event_id AS review_id,
               CASE WHEN event_id % 10 = 9 THEN event_id - 1 ELSE event_id END AS order_id,
               1 + CAST(floor(value) AS INT) % 5 AS review_score, ts AS review_creation_date,
               ts + to_hours(CAST(event_id % 240 AS BIGINT)) AS review_answer_timestamp
        FROM events) e
), paid AS (
  SELECT order_id, sum(payment_value) AS amount, count(*) AS n FROM fact_payments GROUP BY order_id
), visits AS (
  SELECT o.*, c.customer_unique_id AS person, c.customer_state AS state, c.customer_city AS city
  FROM fact_orders o JOIN dim_customers c USING (customer_id)
), sales AS (
  SELECT v.*, p.amount, p.n FROM visits v JOIN paid p USING (order_id)
), spend AS (
  SELECT person, count(*) AS orders, sum(amount) AS spent, max(order_purchase_timestamp) AS last_ts
  FROM sales GROUP BY person
), all_goods AS (
  SELECT i.*, d.product_id AS known_product_id, d.product_category_english AS category
  FROM fact_order_items i LEFT JOIN dim_products d ON i.product_id = d.product_id
), goods AS (
  SELECT * FROM all_goods WHERE known_product_id IS NOT NULL
), opinions AS (
  SELECT v.person, v.state, v.order_id, r.review_score FROM fact_reviews r JOIN visits v USING (order_id)
), cat_month AS (
  SELECT o.month, g.category, sum(g.price) AS total
  FROM goods g JOIN fact_orders o USING (order_id) GROUP BY ALL
), first_month AS (
  SELECT person, min(month) AS cohort_month FROM visits GROUP BY person
), rfm AS (
  SELECT person, date_diff('day', last_ts, (SELECT max(order_purchase_timestamp) FROM fact_orders)) AS recency,
         orders AS frequency, spent AS monetary
  FROM spend
), scored AS (
  SELECT *, 6 - ntile(5) OVER (ORDER BY recency, person) AS r, ntile(5) OVER (ORDER BY frequency, person) AS f,
         ntile(5) OVER (ORDER BY monetary, person) AS m
  FROM rfm
), segmented AS (
  SELECT *, CASE WHEN least(r, f, m) >= 4 THEN 'Champions'
                 WHEN r >= 4 THEN CASE WHEN f >= 3 THEN 'Loyal' ELSE 'New / Promising' END
                 WHEN r = 3 THEN 'Needs Attention'
                 WHEN f >= 4 THEN 'At Risk'
                 WHEN m >= 4 THEN 'Cannot Lose Them'
                 ELSE 'Hibernating' END AS segment
  FROM scored
)
"""
