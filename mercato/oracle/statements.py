"""SQL that DuckDB runs on the raw tables, one statement per checked query.

Months are timestamps, money is summed exactly and then made double, counts are BIGINT.
"""

from __future__ import annotations

from mercato.oracle.prelude import PRELUDE


def money(expression: str) -> str:
    return f"ROUND(CAST(sum({expression}) AS DOUBLE), 2)"


def mean(expression: str) -> str:
    return f"CAST(sum({expression}) AS DOUBLE) / count({expression})"


def pct(part: str, total: str) -> str:
    return f"100.0 * CAST({part} AS DOUBLE) / NULLIF(CAST({total} AS DOUBLE), 0)"


def whole(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


def pct_rows(condition: str) -> str:
    return f"ROUND({pct(f'count(*) FILTER (WHERE {condition})', 'count(*)')}, 2)"


def _basics() -> dict[str, str]:
    return {
        "q01_headline_kpi": f"""
            SELECT count(*) AS delivered_orders, {money('amount')} AS revenue
            FROM fact_orders JOIN paid USING (order_id) WHERE order_status = 'delivered'""",
        "q02_aov": f"SELECT ROUND({mean('amount')}, 2) AS aov FROM paid",
        "q03_status_summary": f"""
            SELECT order_status, count(*) AS orders, coalesce({money('payment_value')}, 0.0) AS revenue
            FROM fact_orders LEFT JOIN fact_payments USING (order_id) GROUP BY order_status""",
        "q04_state_revenue_top10": f"""
            SELECT state AS customer_state, {money('amount')} AS revenue FROM sales
            GROUP BY state ORDER BY revenue DESC, state LIMIT 10""",
        "q05_payment_mix": f"""
            SELECT payment_type, count(*) AS payments, {money('payment_value')} AS value,
                   ROUND({pct('sum(payment_value)', '(SELECT sum(amount) FROM paid)')}, 2) AS pct_value
            FROM fact_payments GROUP BY payment_type""",
        "q06_installments": f"""
            SELECT payment_type, ROUND({mean('payment_installments')}, 2) AS avg_installments
            FROM fact_payments WHERE payment_installments > 0 GROUP BY payment_type""",
        "q07_category_top10": f"""
            SELECT coalesce(category, 'unknown') AS category, {money('price')} AS revenue,
                   count(DISTINCT order_id) AS orders
            FROM all_goods GROUP BY 1 ORDER BY revenue DESC, 1 LIMIT 10""",
        "q08_freight_pct": f"""
            SELECT coalesce(category, 'unknown') AS category,
                   ROUND({pct('sum(freight_value)', 'sum(price)')}, 2) AS freight_pct
            FROM all_goods GROUP BY 1 ORDER BY freight_pct DESC, 1 LIMIT 15""",
        "q09_review_by_state": f"""
            SELECT state AS customer_state, ROUND({mean('review_score')}, 3) AS avg_review
            FROM opinions GROUP BY state""",
        "q10_on_time_rate": f"""
            SELECT {pct_rows('delivery_vs_estimate_days >= 0')} AS on_time_pct FROM fact_orders
            WHERE order_status = 'delivered' AND delivery_vs_estimate_days IS NOT NULL""",
        "q11_delivery_by_state": f"""
            SELECT state AS customer_state, ROUND({mean('delivery_days')}, 2) AS avg_delivery_days
            FROM visits WHERE delivery_days IS NOT NULL GROUP BY state""",
        "q12_multi_item_rate": f"""
            SELECT {pct_rows('n > 1')} AS multi_item_pct
            FROM (SELECT count(*) AS n FROM fact_order_items GROUP BY order_id) b""",
    }


def _windows() -> dict[str, str]:
    delivered = """(SELECT month, sum(amount) AS total FROM fact_orders JOIN paid USING (order_id)
                    WHERE order_status = 'delivered' GROUP BY month)"""
    monthly = "(SELECT month, sum(amount) AS total FROM fact_orders JOIN paid USING (order_id) GROUP BY month)"
    daily = "(SELECT day AS d, sum(amount) AS total FROM fact_orders JOIN paid USING (order_id) GROUP BY day)"
    first_last = """
        SELECT person AS customer_unique_id, min(order_purchase_timestamp) AS first_order,
               max(order_purchase_timestamp) AS last_order
        FROM visits GROUP BY person"""
    gap = """
        SELECT person AS customer_unique_id, order_id, order_purchase_timestamp,
               date_diff('second', lag(order_purchase_timestamp) OVER (
                   PARTITION BY person ORDER BY order_purchase_timestamp, order_id),
                   order_purchase_timestamp) AS gap_seconds
        FROM visits"""
    peak = """
        SELECT category, month, ROUND(CAST(total AS DOUBLE), 2) AS revenue,
               ROUND(CAST(max(total) OVER (PARTITION BY category ORDER BY month) AS DOUBLE), 2) AS running_peak
        FROM cat_month"""
    off_mean = """
        SELECT s.person AS customer_unique_id, s.order_id, ROUND(CAST(s.amount AS DOUBLE), 2) AS order_value,
               ROUND(CAST(s.amount AS DOUBLE) - CAST(p.spent AS DOUBLE) / p.orders, 2) AS diff_from_avg
        FROM sales s JOIN spend p USING (person)"""
    board = """
        SELECT month, category, ROUND(CAST(total AS DOUBLE), 2) AS revenue,
               dense_rank() OVER (PARTITION BY month ORDER BY total DESC) AS rank_in_month
        FROM cat_month"""
    abc = f"""
        SELECT product_id, ROUND(CAST(total AS DOUBLE), 2) AS revenue,
               ROUND({pct('running', 'everything')}, 2) AS cum_pct,
               CASE WHEN CAST(running AS DOUBLE) <= CAST(0.8 AS DOUBLE) * CAST(everything AS DOUBLE) THEN 'A'
                    WHEN CAST(running AS DOUBLE) <= CAST(0.95 AS DOUBLE) * CAST(everything AS DOUBLE) THEN 'B'
                    ELSE 'C' END AS abc_class, total, everything
        FROM (SELECT product_id, total, sum(total) OVER (ORDER BY total DESC) AS running,
                     sum(total) OVER () AS everything
              FROM (SELECT product_id, sum(price) AS total FROM fact_order_items GROUP BY product_id) p) q"""
    week = f"""
        SELECT d, ROUND(CAST(total AS DOUBLE), 2) AS revenue,
               ROUND(CAST(sum(total) OVER w AS DOUBLE) / count(total) OVER w, 2) AS rolling_7d_avg
        FROM {daily} t WINDOW w AS (ORDER BY d ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""
    month_active = """
        SELECT d, active, CAST(sum(active) OVER (ORDER BY d ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS BIGINT) AS active_30d
        FROM (SELECT day AS d, count(DISTINCT person) AS active FROM visits GROUP BY day) t"""
    return {
        "q13_cumulative_revenue": f"""
            SELECT month, ROUND(CAST(total AS DOUBLE), 2) AS revenue,
                   ROUND(CAST(sum(total) OVER (ORDER BY month) AS DOUBLE), 2) AS cumulative_revenue
            FROM {delivered} t""",
        "q14_mom_growth": f"""
            SELECT month, ROUND(CAST(total AS DOUBLE), 2) AS revenue,
                   ROUND(CAST(total - prior AS DOUBLE), 2) AS mom_change,
                   ROUND({pct('(total - prior)', 'prior')}, 2) AS mom_pct
            FROM (SELECT *, lag(total) OVER (ORDER BY month) AS prior FROM {delivered} t) u""",
        "q15_moving_avg_3m": f"""
            SELECT month, ROUND(CAST(total AS DOUBLE), 2) AS revenue,
                   ROUND(CAST(sum(total) OVER w AS DOUBLE) / count(total) OVER w, 2) AS moving_avg_3m
            FROM {monthly} t WINDOW w AS (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
        "q16_rank_customers": """
            SELECT person AS customer_unique_id, ROUND(CAST(spent AS DOUBLE), 2) AS total_spent,
                   row_number() OVER (ORDER BY spent DESC, person) AS row_num,
                   rank() OVER (ORDER BY spent DESC) AS rnk, dense_rank() OVER (ORDER BY spent DESC) AS dense_rnk
            FROM spend ORDER BY row_num LIMIT 20""",
        "q16_rank_customers_all": """
            SELECT person AS customer_unique_id, ROUND(CAST(spent AS DOUBLE), 2) AS total_spent,
                   row_number() OVER (ORDER BY spent DESC, person) AS row_num,
                   rank() OVER (ORDER BY spent DESC) AS rnk, dense_rank() OVER (ORDER BY spent DESC) AS dense_rnk,
                   ROUND(percent_rank() OVER (ORDER BY spent DESC), 6) AS pct_rank,
                   ROUND(cume_dist() OVER (ORDER BY spent DESC), 6) AS cume_dist
            FROM spend""",
        "q17_top3_products_per_category": """
            SELECT category, product_id, ROUND(CAST(total AS DOUBLE), 2) AS revenue, rn
            FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY total DESC, product_id) AS rn
                  FROM (SELECT category, product_id, sum(price) AS total FROM goods GROUP BY ALL) p) q
            WHERE rn <= 3""",
        "q18_state_percent_rank": """
            SELECT state AS customer_state, ROUND(CAST(total AS DOUBLE), 2) AS revenue,
                   ROUND(percent_rank() OVER (ORDER BY total), 3) AS pct_rank
            FROM (SELECT state, sum(amount) AS total FROM sales GROUP BY state) t""",
        "q19_spend_quartiles": f"""
            SELECT quartile, count(*) AS customers, ROUND(CAST(min(spent) AS DOUBLE), 2) AS min_spent,
                   ROUND(CAST(max(spent) AS DOUBLE), 2) AS max_spent, ROUND({mean('spent')}, 2) AS avg_spent
            FROM (SELECT spent, ntile(4) OVER (ORDER BY spent, person) AS quartile FROM spend) t GROUP BY quartile""",
        "q20_first_last_order": first_last + " ORDER BY person LIMIT 20",
        "q20_first_last_order_all": first_last,
        "q21_category_share_of_month": f"""
            SELECT month, category, ROUND(CAST(total AS DOUBLE), 2) AS revenue,
                   ROUND({pct('total', 'sum(total) OVER (PARTITION BY month)')}, 2) AS pct_of_month
            FROM cat_month""",
        "q22_order_gap": gap + " ORDER BY person, order_purchase_timestamp, order_id LIMIT 30",
        "q22_order_gap_all": gap,
        "q23_cume_dist_orders": """
            SELECT order_id, ROUND(CAST(amount AS DOUBLE), 2) AS order_value,
                   ROUND(cume_dist() OVER (ORDER BY amount), 4) AS cume_dist
            FROM paid ORDER BY amount DESC, order_id LIMIT 25""",
        "q24_best_product_per_state": """
            SELECT state, product_id, ROUND(CAST(total AS DOUBLE), 2) AS revenue
            FROM (SELECT *, rank() OVER (PARTITION BY state ORDER BY total DESC) AS place
                  FROM (SELECT v.state, i.product_id, sum(i.price) AS total
                        FROM fact_order_items i JOIN visits v USING (order_id) GROUP BY ALL) p) q
            WHERE place = 1""",
        "q25_running_peak": peak + " ORDER BY category NULLS LAST, month LIMIT 50",
        "q25_running_peak_all": peak,
        "q26_diff_from_customer_avg": off_mean + " ORDER BY 1, 2 LIMIT 30",
        "q26_diff_from_customer_avg_all": off_mean,
        "q27_category_leaderboard": board + " ORDER BY month, rank_in_month, category NULLS LAST LIMIT 50",
        "q27_category_leaderboard_all": board,
        "q28_high_value_low_review": f"""
            SELECT s.person AS customer_unique_id, ROUND(CAST(s.spent AS DOUBLE), 2) AS total_spent,
                   ROUND(o.score, 2) AS avg_review
            FROM spend s JOIN (SELECT person, {mean('review_score')} AS score FROM opinions GROUP BY person) o
                 USING (person)
            WHERE o.score <= 2
              AND CAST(s.spent AS DOUBLE) >= (SELECT quantile_cont(CAST(spent AS DOUBLE), 0.9) FROM spend)""",
        "q29_calendar_spine": """
            SELECT date_diff('day', min(day), max(day)) + 1 AS days_in_range, min(day) AS first_day,
                   max(day) AS last_day
            FROM fact_orders""",
        "q30_gap_filled_months": f"""
            SELECT g.month, ROUND(CAST(coalesce(t.total, 0) AS DOUBLE), 2) AS revenue
            FROM (SELECT unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS month FROM fact_orders) g
            LEFT JOIN {monthly} t USING (month)""",
        "q31_category_share_total": f"""
            SELECT category, {money('price')} AS revenue,
                   ROUND({pct('sum(price)', '(SELECT sum(price) FROM goods)')}, 2) AS pct_of_total
            FROM goods GROUP BY category ORDER BY revenue DESC, category LIMIT 20""",
        "q32_month_template": """
            SELECT g.m AS month_number, count(o.order_id) AS orders
            FROM (SELECT unnest(range(CAST(1 AS BIGINT), 13)) AS m) g
            LEFT JOIN fact_orders o ON month(o.order_purchase_timestamp) = g.m GROUP BY g.m""",
        "q33_second_larger_than_first": """
            SELECT person AS customer_unique_id, ROUND(CAST(one AS DOUBLE), 2) AS first_value,
                   ROUND(CAST(two AS DOUBLE), 2) AS second_value
            FROM (SELECT person, amount AS one, lead(amount) OVER p AS two, row_number() OVER p AS seq
                  FROM sales WINDOW p AS (PARTITION BY person ORDER BY order_purchase_timestamp, order_id)) t
            WHERE seq = 1 AND two > one""",
        "q34_state_kpi_table": f"""
            SELECT s.state, s.orders, s.revenue, s.aov, r.avg_review
            FROM (SELECT state, count(*) AS orders, {money('amount')} AS revenue, ROUND({mean('amount')}, 2) AS aov
                  FROM sales GROUP BY state) s
            LEFT JOIN (SELECT state, ROUND({mean('review_score')}, 2) AS avg_review FROM opinions GROUP BY state) r
                 USING (state)""",
        "q35_one_time_vs_repeat": f"""
            SELECT CASE orders WHEN 1 THEN 'one_time' ELSE 'repeat' END AS segment, count(*) AS customers,
                   {money('spent')} AS revenue,
                   ROUND({pct('sum(spent)', '(SELECT sum(spent) FROM spend)')}, 2) AS pct_revenue
            FROM spend GROUP BY 1""",
        "q36_active_month_streak": """
            SELECT min(month) AS streak_start, max(month) AS streak_end, count(DISTINCT month) AS months
            FROM fact_orders""",
        "gaps_and_islands": """
            SELECT state, min(month) AS streak_start, max(month) AS streak_end, count(*) AS months
            FROM (SELECT state, month, sum(fresh) OVER (PARTITION BY state ORDER BY month) AS streak
                  FROM (SELECT state, month,
                               CASE WHEN lag(month) OVER (PARTITION BY state ORDER BY month)
                                         = month - INTERVAL 1 MONTH THEN 0 ELSE 1 END AS fresh
                        FROM (SELECT DISTINCT state, month FROM visits) a) b) c
            GROUP BY state, streak""",
        "q37_basket_composition": f"""
            SELECT ROUND({mean('items')}, 2) AS avg_items, ROUND({mean('kinds')}, 2) AS avg_distinct_products,
                   ROUND({mean('total')}, 2) AS avg_items_value
            FROM (SELECT count(*) AS items, count(DISTINCT product_id) AS kinds, sum(price) AS total
                  FROM fact_order_items GROUP BY order_id) b""",
        "q67_abc_products": f"""
            SELECT product_id, revenue, cum_pct, abc_class FROM ({abc}) z ORDER BY revenue DESC, product_id LIMIT 40""",
        "q67_abc_products_all": f"SELECT product_id, revenue, cum_pct, abc_class FROM ({abc}) z",
        "q68_abc_summary": f"""
            SELECT abc_class, count(*) AS products, {money('total')} AS revenue,
                   ROUND({pct('sum(total)', 'max(everything)')}, 2) AS pct_revenue
            FROM ({abc}) z GROUP BY abc_class""",
        "q69_rolling_7d": week + " ORDER BY d LIMIT 60",
        "q69_rolling_7d_all": week,
        "q69_rolling_7d_calendar": f"""
            SELECT d, ROUND(CAST(total AS DOUBLE), 2) AS revenue,
                   ROUND(CAST(sum(total) OVER w AS DOUBLE) / count(total) OVER w, 2) AS rolling_7d_avg
            FROM {daily} t
            WINDOW w AS (ORDER BY d RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)""",
        "q70_rolling_30d_active": month_active + " ORDER BY d LIMIT 60",
        "q70_rolling_30d_active_all": month_active,
        "q70_rolling_30d_distinct": """
            SELECT a.d, count(DISTINCT CASE WHEN b.d = a.d THEN b.person END) AS active,
                   count(DISTINCT b.person) AS active_30d
            FROM (SELECT DISTINCT day AS d FROM visits) a
            JOIN (SELECT DISTINCT day AS d, person FROM visits) b ON b.d BETWEEN a.d - 29 AND a.d
            GROUP BY a.d""",
    }


def _ranking() -> dict[str, str]:
    return {
        "q38_top_ltv": """
            SELECT person AS customer_unique_id, orders, ROUND(CAST(spent AS DOUBLE), 2) AS ltv
            FROM spend ORDER BY spent DESC, person LIMIT 10""",
        "q39_top_seller_per_state": """
            SELECT state, seller_id, ROUND(CAST(total AS DOUBLE), 2) AS revenue
            FROM (SELECT s.seller_state AS state, i.seller_id, sum(i.price) AS total
                  FROM fact_order_items i JOIN dim_sellers s USING (seller_id) GROUP BY ALL) t
            QUALIFY row_number() OVER (PARTITION BY state ORDER BY total DESC, seller_id) = 1""",
        "q40_bottom_categories": f"""
            SELECT category, count(DISTINCT order_id) AS orders, {money('price')} AS revenue
            FROM goods GROUP BY category HAVING count(DISTINCT order_id) >= 5
            ORDER BY revenue, category NULLS LAST LIMIT 10""",
        "q41_top5_orders_per_month": """
            SELECT month, order_id, ROUND(CAST(amount AS DOUBLE), 2) AS order_value,
                   row_number() OVER (PARTITION BY month ORDER BY amount DESC, order_id) AS rn
            FROM fact_orders JOIN paid USING (order_id) QUALIFY rn <= 5""",
        "q42_pareto_80": f"""
            SELECT category, ROUND(CAST(total AS DOUBLE), 2) AS revenue,
                   ROUND({pct('running', 'everything')}, 2) AS cumulative_pct
            FROM (SELECT category, total, sum(total) OVER (ORDER BY total DESC) AS running,
                         sum(total) OVER () AS everything
                  FROM (SELECT category, sum(price) AS total FROM goods GROUP BY category) c) d
            WHERE CAST(running AS DOUBLE) <= CAST(0.8 AS DOUBLE) * CAST(everything AS DOUBLE)""",
        "q43_state_review_rank": f"""
            SELECT state, ROUND(score, 3) AS avg_review, rank() OVER (ORDER BY score DESC) AS review_rank
            FROM (SELECT state, {mean('review_score')} AS score FROM opinions GROUP BY state) t""",
        "q44_priciest_product": f"""
            SELECT category, product_id, ROUND(average, 2) AS avg_price
            FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY average DESC, product_id) AS place
                  FROM (SELECT category, product_id, {mean('price')} AS average FROM goods GROUP BY ALL) a) t
            WHERE place = 1 ORDER BY avg_price DESC, category NULLS LAST LIMIT 20""",
        "q45_top3_payment_types": """
            SELECT state, payment_type, ROUND(CAST(total AS DOUBLE), 2) AS value
            FROM (SELECT v.state, p.payment_type, sum(p.payment_value) AS total
                  FROM fact_payments p JOIN visits v USING (order_id) GROUP BY ALL) t
            QUALIFY dense_rank() OVER (PARTITION BY state ORDER BY total DESC) <= 3""",
        "q46_seller_deciles": f"""
            SELECT decile, count(*) AS sellers, {money('total')} AS revenue
            FROM (SELECT total, ntile(10) OVER (ORDER BY total DESC, seller_id) AS decile
                  FROM (SELECT seller_id, sum(price) AS total FROM fact_order_items GROUP BY seller_id) s) d
            GROUP BY decile""",
        "q47_category_growth": f"""
            SELECT category, ROUND(CAST(one AS DOUBLE), 2) AS first_rev, ROUND(CAST(last AS DOUBLE), 2) AS last_rev,
                   ROUND({pct('(last - one)', 'one')}, 1) AS growth_pct
            FROM (SELECT category, arg_min(total, month) AS one, arg_max(total, month) AS last
                  FROM cat_month GROUP BY category) t
            WHERE one > 0 ORDER BY growth_pct DESC, category NULLS LAST LIMIT 15""",
    }


def _cohorts() -> dict[str, str]:
    offsets = """
        (SELECT f.cohort_month, v.person, date_diff('month', f.cohort_month, v.month) AS k
         FROM visits v JOIN first_month f USING (person) GROUP BY ALL)"""
    revenue = """
        (SELECT f.cohort_month, s.month, date_diff('month', f.cohort_month, s.month) AS k, s.person, s.amount
         FROM sales s JOIN first_month f USING (person))"""
    second = """
        (SELECT person, order_purchase_timestamp AS one, lead(order_purchase_timestamp) OVER p AS two,
                row_number() OVER p AS seq
         FROM visits WINDOW p AS (PARTITION BY person ORDER BY order_purchase_timestamp, order_id))"""
    payback = f"""
        SELECT k AS months_since_first_order, ROUND(CAST(total AS DOUBLE), 2) AS total_revenue,
               ROUND(CAST(total AS DOUBLE) / people, 2) AS revenue_per_customer,
               ROUND(CAST(sum(total) OVER (ORDER BY k) AS DOUBLE) / people, 2) AS cumulative_revenue_per_customer
        FROM (SELECT k, sum(amount) AS total, (SELECT count(*) FROM first_month) AS people
              FROM {revenue} r GROUP BY k) t"""
    return {
        "q48_cohort_sizes": """
            SELECT cohort_month, count(*) AS new_customers FROM first_month GROUP BY cohort_month""",
        "q49_cohort_retention_matrix": f"""
            SELECT cohort_month, k AS month_offset, count(DISTINCT person) AS active_customers
            FROM {offsets} o GROUP BY ALL""",
        "q50_m1_retention": f"""
            SELECT cohort_month, count(*) FILTER (WHERE k = 0) AS cohort_size,
                   count(*) FILTER (WHERE k = 1) AS retained_m1,
                   ROUND({pct('count(*) FILTER (WHERE k = 1)', 'count(*) FILTER (WHERE k = 0)')}, 2) AS m1_retention_pct
            FROM {offsets} o GROUP BY cohort_month""",
        "q51_repeat_rate": f"""
            SELECT {pct_rows('n > 1')} AS repeat_rate_pct
            FROM (SELECT count(*) AS n FROM visits GROUP BY person) t""",
        "q52_days_to_second": f"""
            SELECT ROUND({mean('days')}, 1) AS avg_days_to_second, min(days) AS min_days, max(days) AS max_days
            FROM (SELECT date_diff('day', one, two) AS days FROM {second} s WHERE seq = 1 AND two IS NOT NULL) t""",
        "q53_monthly_active": """
            SELECT month, count(DISTINCT person) AS active_customers FROM visits GROUP BY month""",
        "q54_new_vs_returning": f"""
            SELECT month, {money('CASE WHEN k = 0 THEN amount ELSE 0 END')} AS new_revenue,
                   {money('CASE WHEN k > 0 THEN amount ELSE 0 END')} AS returning_revenue
            FROM {revenue} r GROUP BY month""",
        "q55_churn_180d": f"""
            SELECT count(*) FILTER (WHERE away > 180) AS churned, count(*) AS total,
                   {pct_rows('away > 180')} AS churn_pct
            FROM (SELECT date_diff('day', max(order_purchase_timestamp),
                                   (SELECT max(order_purchase_timestamp) FROM fact_orders)) AS away
                  FROM visits GROUP BY person) t""",
        "q56_cohort_revenue": f"""
            SELECT cohort_month, count(*) AS customers, {money('spent')} AS cohort_revenue,
                   ROUND({mean('spent')}, 2) AS avg_ltv
            FROM first_month JOIN spend USING (person) GROUP BY cohort_month""",
        "q57_orders_first_90d": f"""
            SELECT ROUND({mean('n')}, 3) AS avg_orders_first_90d
            FROM (SELECT count(*) FILTER (WHERE date_diff('day', f.ts, v.order_purchase_timestamp) <= 90) AS n
                  FROM visits v JOIN (SELECT person, min(order_purchase_timestamp) AS ts FROM visits GROUP BY person) f
                       USING (person)
                  GROUP BY v.person) t""",
        "q85_cohort_revenue_matrix": f"""
            SELECT cohort_month, k AS months_since_first_order, {money('amount')} AS revenue
            FROM {revenue} r GROUP BY ALL""",
        "q86_payback_curve": payback,
        "ui_payback_curve": payback,
        "insight_month0_share": f"""
            SELECT max(months_since_first_order) AS through_month,
                   ROUND({pct('min_by(c, months_since_first_order)', 'max_by(c, months_since_first_order)')}, 1) AS pct_in_month0
            FROM (SELECT months_since_first_order, cumulative_revenue_per_customer AS c FROM ({payback}) p
                  WHERE months_since_first_order <= 12) t""",
    }


def _segments() -> dict[str, str]:
    scores = """
        SELECT person AS customer_unique_id, recency AS recency_days, frequency,
               ROUND(CAST(monetary AS DOUBLE), 2) AS monetary, r AS r_score, f AS f_score, m AS m_score
        FROM scored"""
    win_back = """
        SELECT person AS customer_unique_id, segment, recency AS recency_days, frequency,
               ROUND(CAST(monetary AS DOUBLE), 2) AS monetary
        FROM segmented WHERE segment IN ('At Risk', 'Cannot Lose Them')"""

    def tiers(low: str, mid: str, high: str, labels: tuple[str, str, str, str]) -> str:
        return f"""
            SELECT CASE WHEN spent < {low} THEN '{labels[0]}' WHEN spent < {mid} THEN '{labels[1]}'
                        WHEN spent < {high} THEN '{labels[2]}' ELSE '{labels[3]}' END AS tier,
                   count(*) AS customers, {money('spent')} AS revenue
            FROM spend GROUP BY 1"""

    return {
        "q58_rfm_raw": """
            SELECT person AS customer_unique_id, recency AS recency_days, frequency,
                   ROUND(CAST(monetary AS DOUBLE), 2) AS monetary
            FROM rfm ORDER BY rfm.monetary DESC, person LIMIT 25""",
        "q59_rfm_scores": scores + " ORDER BY scored.monetary DESC, person LIMIT 25",
        "q59_rfm_scores_all": scores,
        "q60_rfm_segments": "SELECT segment, count(*) AS customers FROM segmented GROUP BY segment",
        "q61_quintile_revenue": f"""
            SELECT m AS m_quintile, count(*) AS customers, {money('monetary')} AS revenue,
                   ROUND({pct('sum(monetary)', '(SELECT sum(spent) FROM spend)')}, 2) AS pct_revenue
            FROM scored GROUP BY m""",
        "q62_spend_tiers": tiers(
            "100000", "300000", "1000000",
            ("1_Low (<100k)", "2_Mid (100k-300k)", "3_High (300k-1M)", "4_VIP (1M+)"),
        ),
        "q62_spend_tiers_default": tiers(
            "100", "300", "1000",
            ("1_Low (<100)", "2_Mid (100-300)", "3_High (300-1000)", "4_VIP (1000+)"),
        ),
        "q63_frequency_vs_review": f"""
            SELECT CASE WHEN n = 1 THEN 'single' WHEN n <= 3 THEN '2-3' ELSE '4+' END AS freq_band,
                   count(*) AS customers, ROUND(avg(score), 3) AS avg_review
            FROM (SELECT v.person, count(DISTINCT v.order_id) AS n, {mean('r.review_score')} AS score
                  FROM visits v LEFT JOIN fact_reviews r USING (order_id) GROUP BY v.person
                 ) t GROUP BY 1""".replace("/ count(r.review_score)", "/ NULLIF(count(r.review_score), 0)"),
        "q64_state_concentration": f"""
            SELECT state AS customer_state, count(DISTINCT person) AS customers, {money('amount')} AS revenue,
                   ROUND(CAST(sum(amount) AS DOUBLE) / count(DISTINCT person), 2) AS revenue_per_customer
            FROM sales GROUP BY state""",
        "q65_cross_sell_affinity": """
            SELECT a.category AS category_a, b.category AS category_b, count(*) AS shared_customers
            FROM (SELECT DISTINCT v.person, g.category FROM goods g JOIN visits v USING (order_id)) a
            JOIN (SELECT DISTINCT v.person, g.category FROM goods g JOIN visits v USING (order_id)) b
                 ON a.person = b.person AND a.category < b.category
            GROUP BY ALL ORDER BY shared_customers DESC, category_a, category_b LIMIT 20""",
        "q66_winback_high_aov": f"""
            SELECT person AS customer_unique_id, ROUND(CAST(spent AS DOUBLE), 2) AS total_spent
            FROM spend
            WHERE orders = 1 AND CAST(spent AS DOUBLE) > (SELECT {mean('spent')} FROM spend) * CAST(1.2 AS DOUBLE)
            ORDER BY spent DESC, person LIMIT 25""",
        "q83_winback_list": win_back,
        "ui_rfm_winback_list": win_back,
        "q84_winback_sizing": f"""
            SELECT segment, count(*) AS customers, {money('monetary')} AS total_revenue
            FROM segmented WHERE segment IN ('At Risk', 'Cannot Lose Them') GROUP BY segment""",
        "insight_winback_totals": f"""
            SELECT count(*) AS customers, {money('monetary')} AS revenue
            FROM segmented WHERE segment IN ('At Risk', 'Cannot Lose Them')""",
        "mart_customer_rfm": """
            SELECT person AS customer_unique_id, recency_days, frequency,
                   ROUND(CAST(monetary AS DOUBLE), 2) AS monetary,
                   6 - ntile(5) OVER (ORDER BY recency_days, person) AS r_score,
                   ntile(5) OVER (ORDER BY frequency, person) AS f_score,
                   ntile(5) OVER (ORDER BY t.monetary NULLS LAST, person) AS m_score
            FROM (SELECT v.person, count(*) AS frequency, sum(p.amount) AS monetary,
                         date_diff('day', max(v.order_purchase_timestamp),
                                   (SELECT max(order_purchase_timestamp) FROM fact_orders)) AS recency_days
                  FROM visits v LEFT JOIN paid p USING (order_id) GROUP BY v.person) t""",
        "mart_buyers_by_month": f"""
            SELECT v.person AS customer_unique_id, count(*) AS orders, count(p.order_id) AS paid_orders,
                   {money('p.amount')} AS spent, min(v.order_purchase_timestamp) AS first_purchase,
                   max(v.order_purchase_timestamp) AS last_purchase, CAST(sum(r.score) AS BIGINT) AS review_sum
            FROM visits v LEFT JOIN paid p USING (order_id)
            LEFT JOIN (SELECT order_id, sum(review_score) AS score FROM fact_reviews GROUP BY order_id) r USING (order_id)
            GROUP BY v.person""",
        "customer_rfm": f"""
            SELECT v.person AS customer_unique_id,
                   date_diff('day', CAST(max(v.order_purchase_timestamp) AS DATE), DATE '2002-01-01') AS recency_days,
                   count(*) AS frequency, {money('p.amount')} AS monetary
            FROM visits v LEFT JOIN paid p USING (order_id) GROUP BY v.person""",
        "customer_rfm_sql": f"""
            SELECT v.person AS customer_unique_id,
                   date_diff('day', CAST(max(v.order_purchase_timestamp) AS DATE), DATE '2002-01-01') AS recency_days,
                   count(*) AS frequency, {money('p.amount')} AS monetary
            FROM visits v LEFT JOIN paid p USING (order_id)
            WHERE v.person = (SELECT person FROM spend ORDER BY spent DESC, person LIMIT 1) GROUP BY v.person""",
    }


def _advanced() -> dict[str, str]:
    types = ("credit_card", "boleto", "voucher", "debit_card")
    pivot = ", ".join(
        f"coalesce(ROUND(CAST(sum(payment_value) FILTER (WHERE payment_type = '{t}') AS DOUBLE), 2), 0.0) AS {t}"
        for t in types
    )
    late = f"""
        SELECT state AS customer_state, count(*) AS delivered_orders,
               count(*) FILTER (WHERE delivery_vs_estimate_days < 0) AS late_orders,
               {pct_rows('delivery_vs_estimate_days < 0')} AS late_pct
        FROM visits WHERE order_delivered_customer_date IS NOT NULL GROUP BY state HAVING count(*) >= 30"""
    first_delivery = f"""
        SELECT first_delivery_status, count(*) AS customers, {pct_rows('orders > 1')} AS repeat_rate_pct,
               ROUND({mean('spent')}, 2) AS avg_ltv
        FROM (SELECT person, CASE WHEN delivery_vs_estimate_days < 0 THEN 'late' ELSE 'on_time' END AS first_delivery_status
              FROM visits WHERE order_delivered_customer_date IS NOT NULL
              QUALIFY row_number() OVER (PARTITION BY person ORDER BY order_purchase_timestamp, order_id) = 1) f
        JOIN spend USING (person) GROUP BY first_delivery_status"""

    def freight(keys: str, source: str) -> str:
        return f"""
            SELECT {keys}, count(*) AS items, ROUND({mean('price')}, 2) AS avg_price,
                   ROUND({mean('freight_value')}, 2) AS avg_freight,
                   ROUND(100.0 * ({mean('freight_value')}) / NULLIF({mean('price')}, 0), 2) AS freight_pct_of_price
            FROM {source} GROUP BY ALL HAVING count(*) >= 20"""

    national = freight("coalesce(category, 'unknown') AS category", "all_goods")
    cell = freight(
        "coalesce(g.category, 'unknown') AS category, v.state AS customer_state",
        "all_goods g JOIN visits v USING (order_id)",
    )
    geo = f"""
        SELECT s.state AS customer_state, count(DISTINCT s.person) AS customers,
               ROUND(CAST(sum(p.payment_value) AS DOUBLE) / count(DISTINCT s.person), 2) AS revenue_per_customer,
               ROUND({mean('s.delivery_days')}, 1) AS avg_delivery_days
        FROM visits s JOIN fact_payments p USING (order_id)
        WHERE s.delivery_days IS NOT NULL GROUP BY s.state HAVING count(DISTINCT s.person) >= 30"""
    return {
        "q71_payment_pivot": f"""
            SELECT year(order_purchase_timestamp) AS yr, {pivot}
            FROM fact_payments JOIN fact_orders USING (order_id) GROUP BY 1""",
        "q72_delivery_funnel": """
            SELECT count(*) AS total_orders, count(order_approved_at) AS approved,
                   count(order_delivered_carrier_date) AS shipped, count(order_delivered_customer_date) AS delivered
            FROM fact_orders""",
        "q73_basket_histogram": f"""
            SELECT CASE WHEN amount < 50000 THEN '1: <50k' WHEN amount < 100000 THEN '2: 50k-100k'
                        WHEN amount < 200000 THEN '3: 100k-200k' WHEN amount < 500000 THEN '4: 200k-500k'
                        ELSE '5: 500k+' END AS bucket,
                   count(*) AS orders, {money('amount')} AS revenue
            FROM paid GROUP BY 1""",
        "q74_margin_proxy": f"""
            SELECT category, {money('price')} AS gross_revenue, {money('freight_value')} AS freight_cost,
                   {money('price - freight_value')} AS net_after_freight,
                   ROUND({pct('sum(price - freight_value)', 'sum(price)')}, 2) AS margin_pct
            FROM goods GROUP BY category ORDER BY net_after_freight DESC, category NULLS LAST LIMIT 20""",
        "q75_weekend_split": f"""
            SELECT CASE WHEN dayofweek(order_purchase_timestamp) IN (0, 6) THEN 'weekend' ELSE 'weekday' END AS day_type,
                   count(DISTINCT order_id) AS orders, {money('payment_value')} AS revenue,
                   ROUND({mean('payment_value')}, 2) AS avg_payment
            FROM fact_orders JOIN fact_payments USING (order_id) GROUP BY 1""",
        "q76_hour_pattern": """
            SELECT hour(order_purchase_timestamp) AS hour_of_day, count(*) AS orders FROM fact_orders GROUP BY 1""",
        "q77_first_review_repeat": f"""
            SELECT ROUND(score) AS first_review_score, count(*) AS customers,
                   ROUND({mean('n')}, 3) AS avg_total_orders, {pct_rows('n > 1')} AS repeat_rate_pct
            FROM (SELECT f.person, avg(r.review_score) AS score
                  FROM (SELECT person, order_id FROM visits
                        QUALIFY row_number() OVER (PARTITION BY person ORDER BY order_purchase_timestamp, order_id) = 1) f
                  JOIN fact_reviews r USING (order_id) GROUP BY f.person) a
            JOIN (SELECT person, count(*) AS n FROM visits GROUP BY person) b USING (person) GROUP BY 1""",
        "q78_seller_scorecard": f"""
            SELECT s.seller_id, s.seller_state, count(DISTINCT i.order_id) AS orders, {money('i.price')} AS revenue,
                   ROUND({mean('r.review_score')}, 2) AS avg_review,
                   ROUND({mean('o.delivery_days')}, 1) AS avg_delivery_days
            FROM fact_order_items i JOIN dim_sellers s USING (seller_id) JOIN fact_orders o USING (order_id)
            LEFT JOIN fact_reviews r USING (order_id)
            GROUP BY ALL HAVING count(DISTINCT i.order_id) >= 5 ORDER BY revenue DESC, s.seller_id LIMIT 25""",
        "q79_late_first_delivery": first_delivery,
        "ui_delivery_retention": first_delivery,
        "q80_late_by_state": late,
        "ui_late_delivery_by_state": late,
        "q81_freight_cell": cell,
        "ui_freight_by_category_region": cell,
        "q82_freight_category": national,
        "ui_freight_by_category": national,
        "q87_geo_opportunity": geo,
        "ui_geo_opportunity": geo,
        "insight_revenue_at_risk": f"""
            SELECT late_customers, ROUND(gap, 2) AS repeat_gap_pp, ROUND(risk, 2) AS revenue_at_risk,
                   ROUND(100.0 * risk / total, 3) AS revenue_at_risk_pct
            FROM (SELECT l.customers AS late_customers, t.repeat_rate_pct - l.repeat_rate_pct AS gap, a.total,
                         CAST(l.customers AS DOUBLE) * (t.repeat_rate_pct - l.repeat_rate_pct) / CAST(100 AS DOUBLE)
                           * (a.total / a.n) AS risk
                  FROM (SELECT * FROM ({first_delivery}) x WHERE first_delivery_status = 'late') l,
                       (SELECT * FROM ({first_delivery}) y WHERE first_delivery_status = 'on_time') t,
                       (SELECT CAST(sum(amount) AS DOUBLE) AS total, count(*) AS n FROM paid) a) z""",
        "insight_freight_flags": f"""
            SELECT category, freight_pct_of_price, freight_pct_of_price > 100 AS margin_negative
            FROM ({national}) n WHERE freight_pct_of_price > 4.0""",
        "insight_opportunity_quadrant": f"""
            SELECT g.* FROM ({geo}) g,
                 (SELECT median(revenue_per_customer) AS mr, median(avg_delivery_days) AS md FROM ({geo}) h) m
            WHERE g.revenue_per_customer > m.mr AND g.avg_delivery_days > m.md""",
    }


def _marts() -> dict[str, str]:
    order_facts = """
        SELECT v.order_id, v.customer_id, v.person AS customer_unique_id, v.state AS customer_state, v.order_status,
               v.order_purchase_timestamp, CAST(v.month AS DATE) AS order_month, v.delivery_days,
               v.delivery_vs_estimate_days, CAST(p.amount AS DOUBLE) AS payment_value, r.score AS review_score
        FROM visits v LEFT JOIN paid p USING (order_id)
        LEFT JOIN (SELECT order_id, avg(review_score) AS score FROM fact_reviews GROUP BY order_id) r USING (order_id)"""
    items = """
        SELECT order_id, count(*) AS item_count, count(DISTINCT product_id) AS distinct_products,
               CAST(sum(price) AS DOUBLE) AS items_value, ROUND(CAST(sum(freight_value) AS DOUBLE), 4) AS freight_value
        FROM fact_order_items GROUP BY order_id"""
    payments = """
        SELECT order_id, CAST(sum(payment_value) AS DOUBLE) AS payment_value,
               CAST(max(payment_installments) AS BIGINT) AS max_installments, count(*) AS payment_count
        FROM fact_payments GROUP BY order_id"""
    reviews = """
        SELECT order_id, avg(review_score) AS review_score, max(answer_latency_days) AS answer_latency_days
        FROM fact_reviews GROUP BY order_id"""
    monthly = f"""
        SELECT month AS order_month, count(*) AS orders, {money('p.amount')} AS revenue,
               ROUND({mean('p.amount')}, 2) AS avg_order_value
        FROM fact_orders LEFT JOIN paid p USING (order_id) WHERE order_status = 'delivered' GROUP BY month"""
    star_counts = {
        "dim_customers": "dim_customers",
        "dim_sellers": "dim_sellers",
        "dim_products": "dim_products",
        "dim_geography": "(SELECT DISTINCT zip FROM geo)",
        "dim_dates": "(SELECT unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) FROM fact_orders)",
        "fact_orders": "fact_orders",
        "fact_order_items": "fact_order_items",
        "fact_payments": "fact_payments",
        "fact_reviews": "fact_reviews",
    }
    return {
        "dim_customers": """
            SELECT customer_id, customer_unique_id, customer_zip_code_prefix, customer_city,
                   upper(customer_state) AS customer_state
            FROM dim_customers""",
        "dim_sellers": """
            SELECT seller_id, seller_zip_code_prefix, seller_city, upper(seller_state) AS seller_state FROM dim_sellers""",
        "dim_products": "SELECT * FROM dim_products",
        "dim_geography": f"""
            SELECT zip AS zip_code_prefix, {mean('lat')} AS latitude, {mean('lat')} AS longitude, min(city) AS city,
                   min(state) AS state
            FROM geo GROUP BY zip""",
        "dim_dates": """
            SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS date, year(d) AS year,
                   quarter(d) AS quarter, month(d) AS month, monthname(d) AS month_name, day(d) AS day,
                   dayofweek(d) AS day_of_week, dayname(d) AS day_name, weekofyear(d) AS week_of_year,
                   dayofweek(d) IN (0, 6) AS is_weekend
            FROM (SELECT unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS d FROM fact_orders) t""",
        "fact_orders": """
            SELECT order_id, customer_id, order_status, order_purchase_timestamp,
                   CAST(strftime(order_purchase_timestamp, '%Y%m%d') AS BIGINT) AS purchase_date_key,
                   order_approved_at, order_delivered_carrier_date, order_delivered_customer_date,
                   order_estimated_delivery_date, delivery_days, delivery_vs_estimate_days
            FROM fact_orders""",
        "fact_order_items": f"""
            SELECT order_id, {whole('order_item_id')} AS order_item_id, product_id, seller_id, shipping_limit_date,
                   CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value,
                   CAST(price + freight_value AS DOUBLE) AS total_item_value
            FROM fact_order_items""",
        "fact_payments": f"""
            SELECT order_id, {whole('payment_sequential')} AS payment_sequential, payment_type,
                   {whole('payment_installments')} AS payment_installments,
                   CAST(payment_value AS DOUBLE) AS payment_value
            FROM fact_payments""",
        "fact_reviews": f"""
            SELECT review_id, order_id, {whole('review_score')} AS review_score, review_creation_date,
                   review_answer_timestamp, answer_latency_days
            FROM fact_reviews""",
        "int_order_items_agg": items,
        "int_order_payments": payments,
        "int_order_reviews": reviews,
        "mart_fact_orders_wide": f"""
            SELECT o.order_id, o.customer_id, o.order_status, o.order_purchase_timestamp, o.delivery_days,
                   o.delivery_vs_estimate_days, i.item_count, i.distinct_products, i.items_value, i.freight_value,
                   p.payment_value, p.max_installments, r.review_score
            FROM fact_orders o LEFT JOIN ({payments}) p USING (order_id) LEFT JOIN ({items}) i USING (order_id)
            LEFT JOIN ({reviews}) r USING (order_id)""",
        "fact_orders_enriched": f"""
            SELECT o.order_id, o.customer_id, o.order_status, o.order_purchase_timestamp, o.order_approved_at,
                   o.order_delivered_carrier_date, o.order_delivered_customer_date,
                   o.order_estimated_delivery_date, i.distinct_products, i.item_count, ROUND(i.items_value, 2) AS items_value, ROUND(i.freight_value, 2) AS freight_value,
                   ROUND(p.payment_value, 2) AS payment_value, p.max_installments, o.delivery_days,
                   c.primary_category, year(o.order_purchase_timestamp) AS purchase_year,
                   month(o.order_purchase_timestamp) AS purchase_month
            FROM fact_orders o LEFT JOIN ({payments}) p USING (order_id)
            LEFT JOIN (SELECT order_id, count(*) AS item_count, count(DISTINCT product_id) AS distinct_products,
                              CAST(sum(price) AS DOUBLE) AS items_value,
                              CAST(sum(freight_value) AS DOUBLE) AS freight_value
                       FROM fact_order_items GROUP BY order_id) i USING (order_id)
            LEFT JOIN (SELECT order_id, d.product_category_name AS primary_category
                       FROM fact_order_items JOIN dim_products d USING (product_id)
                       WHERE d.product_category_name IS NOT NULL
                       QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY order_item_id) = 1) c USING (order_id)""",
        "mart_monthly_revenue": monthly,
        "mart_revenue_by_state": f"""
            SELECT state AS customer_state, count(*) AS orders, {money('p.amount')} AS revenue
            FROM visits LEFT JOIN paid p USING (order_id) GROUP BY state""",
        "mart_category_performance": f"""
            SELECT category, count(DISTINCT order_id) AS orders, {money('price')} AS revenue,
                   ROUND({mean('price')}, 2) AS avg_item_price, {money('freight_value')} AS freight
            FROM all_goods GROUP BY category""",
        "vw_order_facts": order_facts,
        "vw_monthly_revenue": f"""
            SELECT CAST(month AS DATE) AS order_month, count(*) AS orders, {money('p.amount')} AS revenue
            FROM visits LEFT JOIN paid p USING (order_id) WHERE order_status = 'delivered' GROUP BY 1""",
        "vw_product_performance": f"""
            SELECT known_product_id AS product_id, category, count(DISTINCT order_id) AS orders,
                   {money('price')} AS revenue, ROUND({mean('price')}, 2) AS avg_price
            FROM all_goods GROUP BY ALL""",
        "star_row_counts": " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {source} t"
            for name, source in star_counts.items()
        ),
        "star_views_sql": """
            SELECT dayname(v.order_purchase_timestamp) AS day_name, v.state AS customer_state, count(*) AS orders,
                   CAST(sum(p.amount) AS DOUBLE) AS revenue
            FROM visits v LEFT JOIN paid p USING (order_id) GROUP BY ALL""",
        "seed_csv": f"""
            SELECT region, count(*) AS orders, {money('amount')} AS revenue
            FROM sales JOIN state_regions ON state = customer_state GROUP BY region""",
        "refresh_snapshot": f"""
            SELECT order_month, orders, revenue, true AS stamped FROM ({monthly}) m""",
    }


def _reports() -> dict[str, str]:
    state = f"SELECT state, {money('amount')} AS revenue, count(*) AS orders FROM sales GROUP BY state"
    category = f"""
        SELECT coalesce(category, 'unknown') AS category, {money('price')} AS revenue,
               count(DISTINCT order_id) AS orders
        FROM all_goods GROUP BY 1"""
    by_month = f"""
        SELECT strftime(order_purchase_timestamp, '%Y-%m') AS period, {money('amount')} AS revenue, count(*) AS orders
        FROM fact_orders JOIN paid USING (order_id)"""
    per_month = "SELECT strftime(order_purchase_timestamp, '%Y-%m') AS {0}, count(*) AS orders FROM fact_orders GROUP BY 1"
    delivered_month = f"""
        SELECT strftime(order_purchase_timestamp, '%Y-%m') AS month, {money('amount')} AS payment_value
        FROM fact_orders JOIN paid USING (order_id) WHERE order_status = 'delivered' GROUP BY 1"""
    customers = """
        SELECT c.customer_id, c.customer_unique_id, c.customer_city, c.customer_state, count(o.order_id) AS orders,
               ROUND(coalesce(CAST(sum(p.amount) AS DOUBLE), 0), 2) AS total_spent
        FROM dim_customers c LEFT JOIN fact_orders o USING (customer_id) LEFT JOIN paid p USING (order_id)
        GROUP BY ALL"""
    order_rows = """
        SELECT o.order_id, o.customer_id, o.order_status,
               strftime(o.order_purchase_timestamp, '%Y-%m-%d %H:%M:%S') AS purchase_timestamp,
               ROUND(CAST(p.amount AS DOUBLE), 2) AS payment_value, o.delivery_days
        FROM fact_orders o LEFT JOIN paid p USING (order_id)"""
    statuses = "SELECT order_status, count(*) AS {0} FROM fact_orders GROUP BY order_status"
    score = f"(SELECT ROUND({mean('review_score')}, 3) FROM fact_reviews)"
    outings = """
        (SELECT order_id, CAST(floor(date_diff('second', order_purchase_timestamp, order_delivered_customer_date) / 86400.0) AS BIGINT) AS days,
                order_delivered_customer_date <= order_estimated_delivery_date AS on_time
         FROM fact_orders WHERE order_delivered_customer_date IS NOT NULL)"""
    tables = {
        "dim_customers": ("dim_customers", 5, "0"),
        "dim_sellers": ("dim_sellers", 4, "0"),
        "dim_products": (
            "dim_products",
            4,
            "2 * count(*) FILTER (WHERE product_category_name IS NULL)",
        ),
        "dim_geography": ("(SELECT DISTINCT zip FROM geo)", 5, "0"),
        "dim_dates": (
            "(SELECT unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) FROM fact_orders)",
            11,
            "0",
        ),
        "fact_orders": (
            "fact_orders",
            11,
            """count(*) FILTER (WHERE order_approved_at IS NULL)
               + count(*) FILTER (WHERE order_delivered_carrier_date IS NULL)
               + 3 * count(*) FILTER (WHERE order_delivered_customer_date IS NULL)""",
        ),
        "fact_order_items": ("fact_order_items", 8, "0"),
        "fact_payments": ("fact_payments", 5, "0"),
        "fact_reviews": ("fact_reviews", 6, "0"),
    }
    order_nulls = """count(*) FILTER (WHERE order_approved_at IS NULL)
        + count(*) FILTER (WHERE order_delivered_carrier_date IS NULL)
        + count(*) FILTER (WHERE order_delivered_customer_date IS NULL)"""
    sources = {
        "customers": ("dim_customers", 5, "0"),
        "sellers": ("dim_sellers", 4, "0"),
        "products": ("dim_products", 3, "count(*) FILTER (WHERE product_category_name IS NULL)"),
        "product_category_translation": ("category_translation", 2, "0"),
        "geolocation": ("geo", 5, "0"),
        "orders": ("fact_orders", 8, order_nulls),
        "order_items": ("fact_order_items", 7, "0"),
        "order_payments": ("fact_payments", 5, "0"),
        "order_reviews": ("fact_reviews", 5, "0"),
    }

    def profile(frames: dict[str, tuple[str, int, str]]) -> str:
        return " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, count(*) AS row_count, CAST({columns} AS BIGINT) AS col_count,"
            f" CAST({nulls} AS BIGINT) AS null_cells FROM {source} t"
            for name, (source, columns, nulls) in frames.items()
        )

    month_figures = f"""
        SELECT v.month, {money('p.amount')} AS total_revenue, count(*) AS total_orders,
               ROUND(CAST(sum(p.amount) AS DOUBLE) / count(*), 2) AS avg_order_value,
               ROUND(CAST(sum(p.amount) FILTER (WHERE v.order_status = 'delivered') AS DOUBLE), 2) AS delivered_revenue,
               {pct_rows('v.delivery_vs_estimate_days >= 0')} AS on_time_pct,
               ROUND(CAST(sum(r.s) AS DOUBLE) / NULLIF(sum(r.c), 0), 3) AS avg_review,
               CAST(sum(p.amount) AS DOUBLE) AS exact, sum(p.amount) AS exact_sum
        FROM visits v LEFT JOIN paid p USING (order_id)
        LEFT JOIN (SELECT order_id, sum(review_score) AS s, count(*) AS c FROM fact_reviews GROUP BY order_id) r
             USING (order_id)
        GROUP BY v.month"""
    return {
        "api_kpis": f"""
            SELECT count(*) AS total_orders, {money('amount')} AS total_revenue,
                   ROUND(CAST(sum(amount) AS DOUBLE) / count(*), 2) AS avg_order_value,
                   count(DISTINCT customer_id) AS unique_customers,
                   ROUND(CAST(count(*) FILTER (WHERE delivery_vs_estimate_days >= 0) AS DOUBLE) / count(*), 4) AS on_time_delivery_rate,
                   {score} AS avg_review_score
            FROM fact_orders LEFT JOIN paid USING (order_id)""",
        "api_monthly_revenue": by_month + " WHERE order_status = 'delivered' GROUP BY 1",
        "ui_monthly_revenue": by_month + " GROUP BY 1",
        "api_revenue_by_state": state + " ORDER BY revenue DESC, state LIMIT 10",
        "ui_revenue_by_state": state,
        "api_customer_search": f"""
            SELECT * FROM ({customers}) c WHERE customer_state = 'NATION_3' AND customer_city = 'machinery'
            ORDER BY total_spent DESC, customer_id LIMIT 20 OFFSET 5""",
        "dynamic_filters": f"""
            SELECT * FROM ({customers}) c WHERE customer_state = 'NATION_3' AND total_spent >= 200000""",
        "api_customer_by_id": f"SELECT * FROM ({customers}) c WHERE customer_id = 7",
        "ui_customer_search": f"""
            SELECT * EXCLUDE (customer_unique_id) FROM ({customers}) c
            WHERE customer_state = 'NATION_7' AND total_spent >= 150000
            ORDER BY total_spent DESC, customer_id LIMIT 500""",
        "api_order_list": order_rows + """
            WHERE o.order_status = 'shipped' ORDER BY purchase_timestamp DESC, o.order_id LIMIT 20 OFFSET 10""",
        "api_order_list_deep": order_rows + """
            WHERE o.order_status = 'delivered' ORDER BY purchase_timestamp DESC, o.order_id LIMIT 30 OFFSET 400""",
        "api_order_list_next": order_rows + """
            ORDER BY purchase_timestamp DESC NULLS LAST, o.order_id LIMIT 30 OFFSET 430""",
        "api_customer_search_deep": f"""
            SELECT * FROM ({customers}) c ORDER BY total_spent DESC, customer_id LIMIT 25 OFFSET 60""",
        "api_order_by_id": order_rows + " WHERE o.order_id = 42",
        "api_status_breakdown": statuses.format("orders"),
        "eda_status_counts": statuses.format("count"),
        "api_top_products": f"""
            SELECT product_id, category, count(DISTINCT order_id) AS orders, {money('price')} AS revenue
            FROM all_goods GROUP BY ALL ORDER BY revenue DESC, product_id LIMIT 10""",
        "api_categories": f"""
            SELECT coalesce(category, 'unknown') AS category, count(DISTINCT order_id) AS orders,
                   {money('price')} AS revenue, ROUND({mean('price')}, 2) AS avg_item_price
            FROM all_goods GROUP BY 1 ORDER BY revenue DESC, 1 LIMIT 15""",
        "api_dashboard": f"""
            SELECT 'kpis' AS section, 'total_orders' AS label, CAST(count(*) AS DOUBLE) AS value FROM fact_orders
            UNION ALL SELECT 'kpis', 'unique_customers', CAST(count(DISTINCT customer_id) AS DOUBLE) FROM fact_orders
            UNION ALL SELECT 'kpis', 'total_revenue', {money('amount')} FROM paid
            UNION ALL SELECT 'monthly_orders', period, CAST(orders AS DOUBLE) FROM ({per_month.format('period')}) m
            UNION ALL SELECT 'top_categories', category, revenue
                      FROM (SELECT * FROM ({category}) c ORDER BY revenue DESC, category LIMIT 5) t""",
        "ui_kpis": f"""
            SELECT count(*) AS total_orders, count(DISTINCT customer_id) AS unique_customers,
                   (SELECT {money('amount')} FROM paid) AS total_revenue,
                   ROUND((SELECT CAST(sum(amount) AS DOUBLE) FROM paid) / count(*), 2) AS avg_order_value,
                   {score} AS avg_review
            FROM fact_orders""",
        "ui_category_revenue": category,
        "ui_top_n_by_metric": category + " ORDER BY orders DESC, category LIMIT 15",
        "ui_states": "SELECT DISTINCT customer_state FROM dim_customers",
        "ui_aov": f"SELECT {mean('amount')} AS aov FROM paid",
        "extract_monthly_orders": per_month.format("month"),
        "export_csv": per_month.format("month"),
        "eda_profile": profile(sources),
        "star_profile": profile(tables),
        "eda_monthly_delivered": delivered_month,
        "bi_pivot_monthly": delivered_month,
        "eda_delivery_stats": f"""
            SELECT count(days) AS count, ROUND({mean('days')}, 4) AS mean, ROUND(stddev_samp(days), 4) AS std,
                   min(days) AS min, quantile_cont(days, 0.25) AS p25, quantile_cont(days, 0.5) AS p50,
                   quantile_cont(days, 0.75) AS p75, max(days) AS max,
                   ROUND({pct('count(*) FILTER (WHERE on_time)', 'count(*)')}, 1) AS on_time_pct
            FROM {outings} d""",
        "eda_delivery_histogram": f"""
            SELECT CAST(least(floor(CAST(days - low AS DOUBLE) * 40 / CAST(high - low AS DOUBLE)), 39) AS BIGINT) AS bin,
                   count(*) AS orders
            FROM {outings} d, (SELECT min(days) AS low, max(days) AS high FROM {outings} e) b GROUP BY 1""",
        "eda_review_by_outcome": f"""
            SELECT CASE WHEN on_time THEN 'on_time' ELSE 'late' END AS outcome, ROUND({mean('review_score')}, 4) AS mean,
                   count(review_score) AS count
            FROM {outings} d JOIN fact_reviews USING (order_id) GROUP BY 1""",
        "bi_measures": f"""
            SELECT a.month AS order_month, a.total_revenue, a.total_orders, a.avg_order_value, a.delivered_revenue,
                   a.on_time_pct, a.avg_review,
                   ROUND({pct('(a.exact_sum - b.exact_sum)', 'b.exact_sum')}, 2) AS revenue_mom_pct
            FROM ({month_figures}) a LEFT JOIN ({month_figures}) b ON b.month = a.month - INTERVAL 1 MONTH""",
        "bi_repeat_customers": f"""
            SELECT count(*) AS customers, count(*) FILTER (WHERE n > 1) AS repeat_customers,
                   {pct_rows('n > 1')} AS repeat_customer_pct
            FROM (SELECT count(*) AS n FROM visits GROUP BY person) t""",
        "bi_pivot_category": f"""
            SELECT product_category_name, {money('price')} AS price, count(order_id) AS order_count
            FROM fact_order_items JOIN dim_products USING (product_id) GROUP BY product_category_name""",
        "bi_pivot_state": f"""
            SELECT state AS customer_state, {money('amount')} AS payment_value FROM sales GROUP BY state""",
        "bi_pivot_payment": f"""
            SELECT payment_type, {money('payment_value')} AS payment_value,
                   ROUND({mean('payment_installments')}, 4) AS avg_installments
            FROM fact_payments GROUP BY payment_type""",
        "bi_pivots": f"""
            SELECT strftime(order_purchase_timestamp, '%Y-%m') AS month,
                   CASE WHEN amount < 100000 THEN 'Low' WHEN amount < 300000 THEN 'Mid'
                        WHEN amount < 1000000 THEN 'High' ELSE 'VIP' END AS tier,
                   count(*) AS orders, count(*) FILTER (WHERE delivery_vs_estimate_days >= 0) AS on_time_orders,
                   {money('amount')} AS revenue
            FROM fact_orders JOIN paid USING (order_id) GROUP BY 1, 2""",
    }


def _checks() -> dict[str, str]:
    sources = {
        "customers": "dim_customers",
        "sellers": "dim_sellers",
        "products": "dim_products",
        "product_category_translation": "category_translation",
        "geolocation": "geo",
        "orders": "fact_orders",
        "order_items": "fact_order_items",
        "order_payments": "fact_payments",
        "order_reviews": "fact_reviews",
    }
    items_raw = """(SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
                           l_suppkey AS seller_id, l_extendedprice AS price, l_extendedprice * l_tax AS freight_value
                    FROM lineitem)"""

    def row(table: str, check: str, count: str) -> str:
        return (
            f"SELECT '{table}' AS table_name, '{check}' AS check_name, coalesce(n, 0) = 0 AS passed,"
            f" CAST(coalesce(n, 0) AS BIGINT) AS violations FROM (SELECT {count}) t(n)"
        )

    def bad(table: str, check: str, condition: str, source: str) -> str:
        return row(table, check, f"(SELECT count(*) FROM {source} s WHERE {condition})")

    def null(table: str, column: str, source: str, name: str | None = None) -> str:
        return bad(table, f"not_null[{name or column}]", f"{column} IS NULL", source)

    def unique(table: str, columns: str, source: str) -> str:
        return row(
            table,
            f"pk_unique[{columns}]",
            f"(SELECT sum(c - 1) FROM (SELECT count(*) AS c FROM {source} s GROUP BY {columns}) g)",
        )

    def reference(table: str, column: str, target: str, source: str) -> str:
        parent, key = target.split(".")
        return bad(
            table,
            f"fk[{column}->{target}]",
            f"s.{column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {sources[parent]} q WHERE q.{key} = s.{column})",
            source,
        )

    def typed(table: str, column: str) -> str:
        wrong = f"(SELECT CASE WHEN max(typeof({column})) = 'TIMESTAMP' THEN 0 ELSE 1 END FROM {sources[table]} s)"
        return row(table, f"timestamp_type[{column}]", wrong)

    def items(table_source: str) -> list[str]:
        t = "order_items"
        return [
            *[null(t, c, table_source) for c in ("order_id", "product_id", "seller_id")],
            *[bad(t, f"non_negative[{c}]", f"{c} < 0", table_source) for c in ("price", "freight_value")],
            unique(t, "order_id,order_item_id", table_source),
            reference(t, "order_id", "orders.order_id", table_source),
            reference(t, "product_id", "products.product_id", table_source),
            reference(t, "seller_id", "sellers.seller_id", table_source),
            typed(t, "shipping_limit_date"),
        ]

    stamps = (
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    )
    orders = [
        *[null("orders", c, "fact_orders") for c in ("order_id", "customer_id", "order_status")],
        unique("orders", "order_id", "fact_orders"),
        reference("orders", "customer_id", "customers.customer_id", "fact_orders"),
        *[typed("orders", c) for c in stamps],
    ]
    reviews = [
        *[null("order_reviews", c, "fact_reviews") for c in ("review_id", "order_id")],
        unique("order_reviews", "review_id", "fact_reviews"),
        reference("order_reviews", "order_id", "orders.order_id", "fact_reviews"),
        *[typed("order_reviews", c) for c in ("review_creation_date", "review_answer_timestamp")],
    ]
    everything = [
        *[null("customers", c, "dim_customers") for c in ("customer_id", "customer_unique_id")],
        unique("customers", "customer_id", "dim_customers"),
        null("sellers", "seller_id", "dim_sellers"),
        unique("sellers", "seller_id", "dim_sellers"),
        null("products", "product_id", "dim_products"),
        unique("products", "product_id", "dim_products"),
        null("product_category_translation", "product_category_name", "category_translation"),
        unique("product_category_translation", "product_category_name", "category_translation"),
        null("geolocation", "zip", "geo", "geolocation_zip_code_prefix"),
        *orders,
        *items("fact_order_items"),
        *[null("order_payments", c, "fact_payments") for c in ("order_id", "payment_type")],
        bad("order_payments", "non_negative[payment_value]", "payment_value < 0", "fact_payments"),
        unique("order_payments", "order_id,payment_sequential", "fact_payments"),
        reference("order_payments", "order_id", "orders.order_id", "fact_payments"),
        *reviews,
    ]
    statuses = "('delivered', 'shipped', 'canceled', 'unavailable', 'invoiced', 'processing', 'created', 'approved')"
    status_check = bad(
        "orders", "accepted_values[order_status]", f"order_status NOT IN {statuses}", "fact_orders"
    )
    score_check = bad(
        "order_reviews", "between[review_score]", "review_score NOT BETWEEN 1 AND 5", "fact_reviews"
    )
    months = """(SELECT month AS order_month, sum(amount) AS revenue FROM sales
                 WHERE order_status = 'delivered' GROUP BY month)"""
    orders_columns = ("order_id", "customer_id", "order_status", *stamps)

    def every(rows: list[str]) -> str:
        return " UNION ALL ".join(rows)

    def typed_rows(table: str, columns: tuple[str, ...], source: str) -> list[str]:
        return [
            f"SELECT '{table}' AS table_name, 'timestamp_type[{c}]' AS check_name,"
            f" max(typeof({c})) = 'TIMESTAMP' AS passed, count(*) AS row_count FROM {source} s"
            for c in columns
        ]

    return {
        "validation_report": every(everything),
        "validation_summary": f"""
            SELECT count(*) AS total, count(*) FILTER (WHERE passed) AS passed,
                   count(*) FILTER (WHERE NOT passed) AS failed
            FROM ({every(everything)}) r""",
        "validation_report_uncleaned": every(items(items_raw)),
        "quality_gate": f"SELECT * FROM ({every(items(items_raw))}) g WHERE NOT passed",
        "check_not_null": every([null("orders", c, "fact_orders") for c in orders_columns]),
        "check_pk_unique": every(
            [
                unique("order_items_uncleaned", "order_id,order_item_id", items_raw),
                unique("order_items", "order_id,order_item_id", "fact_order_items"),
            ]
        ),
        "check_fk": every(
            [
                reference("order_items", "order_id", "orders.order_id", "fact_order_items"),
                reference("order_reviews", "order_id", "orders.order_id", "fact_reviews"),
                reference("orders", "order_id", "order_payments.order_id", "fact_orders"),
            ]
        ),
        "check_timestamp_type": every(
            typed_rows("orders", stamps, "fact_orders")
            + typed_rows("order_items", ("shipping_limit_date",), "fact_order_items")
            + typed_rows(
                "order_reviews", ("review_creation_date", "review_answer_timestamp"), "fact_reviews"
            )
        ),
        "check_non_negative": every(
            [
                bad("order_items", f"non_negative[{c}]", f"{c} < 0", "fact_order_items")
                for c in ("price", "freight_value")
            ]
            + [bad("order_payments", "non_negative[payment_value]", "payment_value < 0", "fact_payments")]
        ),
        "check_between": every(
            [
                score_check,
                bad(
                    "order_reviews",
                    "between[review_score]:2-4",
                    "review_score NOT BETWEEN 2 AND 4",
                    "fact_reviews",
                ),
            ]
        ),
        "check_accepted_values": every(
            [status_check, bad("mart_customer_rfm", "accepted_values[r_score]", "r NOT BETWEEN 1 AND 5", "scored")]
        ),
        "check_singular": bad(
            "mart_monthly_revenue",
            "positive_revenue",
            "total < 0",
            "(SELECT sum(amount) AS total FROM sales WHERE order_status = 'delivered' GROUP BY month)",
        ),
        "suite_from_spec": every([*orders, status_check, *reviews, score_check]),
        "mart_checks": every(
            [
                *[null("dim_customers", c, "dim_customers") for c in ("customer_id", "customer_unique_id")],
                unique("dim_customers", "customer_id", "dim_customers"),
                null("dim_products", "product_id", "dim_products"),
                unique("dim_products", "product_id", "dim_products"),
                null("dim_sellers", "seller_id", "dim_sellers"),
                unique("dim_sellers", "seller_id", "dim_sellers"),
                *[null("fact_orders", c, "fact_orders") for c in ("order_id", "customer_id")],
                unique("fact_orders", "order_id", "fact_orders"),
                bad(
                    "fact_orders",
                    "fk[customer_id->dim_customers.customer_id]",
                    "NOT EXISTS (SELECT 1 FROM dim_customers q WHERE q.customer_id = s.customer_id)",
                    "fact_orders",
                ),
                bad("fact_orders", "accepted_values[order_status]", f"order_status NOT IN {statuses}", "fact_orders"),
                null("mart_monthly_revenue", "order_month", months),
                unique("mart_monthly_revenue", "order_month", months),
                bad("mart_monthly_revenue", "positive_revenue", "revenue < 0", months),
                null("mart_customer_rfm", "person", "first_month", "customer_unique_id"),
                row(
                    "mart_customer_rfm",
                    "pk_unique[customer_unique_id]",
                    "(SELECT count(person) - count(DISTINCT person) FROM first_month)",
                ),
                bad("mart_customer_rfm", "accepted_values[r_score]", "r NOT BETWEEN 1 AND 5", "scored"),
            ]
        ),
    }


def _pipelines() -> dict[str, str]:
    series = """
        (SELECT state AS customer_state, month, CAST(sum(amount) AS DOUBLE) AS v,
                row_number() OVER (PARTITION BY state ORDER BY month) AS i
         FROM sales GROUP BY state, month)"""

    def trimmed(source: str) -> str:
        """Months up to the last one that is not a collapsed tail."""
        return f"""
            (SELECT * FROM (SELECT *, max(CASE WHEN collapsed THEN 0 ELSE i END) OVER (PARTITION BY customer_state) AS last_i
                            FROM (SELECT *, coalesce(i > 4 AND before3 > 0 AND v < CAST(0.3 AS DOUBLE) * before3, false) AS collapsed
                                  FROM (SELECT *, avg(v) OVER (PARTITION BY customer_state ORDER BY month
                                                     ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS before3
                                        FROM {source} s0) s1) s2) s3
             WHERE i <= last_i)"""

    weak = f"""
        (SELECT customer_state, month, i,
                CASE WHEN CAST(substr(customer_state, 8) AS INT) % 2 = 0
                          AND month = max(month) OVER (PARTITION BY customer_state)
                     THEN v * CAST(0.1 AS DOUBLE) ELSE v END AS v
         FROM {series} s)"""
    clean = trimmed(series)
    raw_orders = ", ".join(
        ["CAST(order_id AS VARCHAR) AS order_id", "CAST(customer_id AS VARCHAR) AS customer_id", "order_status"]
        + [
            "order_purchase_timestamp",
            "order_approved_at",
            "order_delivered_carrier_date",
            "order_delivered_customer_date",
            "order_estimated_delivery_date",
        ]
    )
    return {
        "read_csv": f"SELECT {raw_orders} FROM fact_orders",
        "read_csv_nullable": """
            SELECT count(*) AS orders, count(*) - count(order_approved_at) AS not_approved,
                   count(*) - count(order_delivered_customer_date) AS not_delivered
            FROM fact_orders""",
        "run_report": """
            SELECT 'order_items' AS table_name, (SELECT count(*) FROM lineitem) AS rows_in,
                   (SELECT count(*) FROM raw_items) AS rows_out,
                   (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM raw_items) AS duplicates_removed,
                   (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM raw_items) AS rows_dropped
            UNION ALL
            SELECT name, n, out_rows, n - out_rows, n - out_rows FROM (""" + " UNION ALL ".join(
            f"SELECT '{name}' AS name, count(*) AS n, {kept} AS out_rows FROM {source} t"
            for name, source, kept in (
                ("customers", "dim_customers", "count(*)"),
                ("sellers", "dim_sellers", "count(*)"),
                ("products", "part", "count(*)"),
                ("product_category_translation", "category_translation", "count(*)"),
                ("geolocation", "geo", "count(DISTINCT (zip, lat, city, state))"),
                ("orders", "fact_orders", "count(*)"),
                ("order_payments", "fact_payments", "count(*)"),
                ("order_reviews", "fact_reviews", "count(*)"),
            )
        ) + ") r",
        "read_parquet": f"""
            SELECT l_orderkey, {whole('l_linenumber')} AS l_linenumber, l_quantity FROM lineitem""",
        "external_parquet_source": "SELECT * FROM dim_sellers",
        "register_staging": """
            SELECT concat(s.seller_state, ' ', o.order_status) AS label, count(*) AS items,
                   CAST(sum(i.price) AS DOUBLE) AS revenue
            FROM fact_order_items i, fact_orders o, dim_sellers s
            WHERE i.order_id = o.order_id AND i.seller_id = s.seller_id GROUP BY ALL
            UNION ALL """ + " UNION ALL ".join(
            f"SELECT '{name}', count(*), CAST(NULL AS DOUBLE) FROM {source} t"
            for name, source in (
                ("customers", "dim_customers"),
                ("sellers", "dim_sellers"),
                ("products", "part"),
                ("product_category_translation", "category_translation"),
                ("geolocation", "geo"),
                ("orders", "fact_orders"),
                ("order_items", "fact_order_items"),
                ("order_payments", "fact_payments"),
                ("order_reviews", "fact_reviews"),
            )
        ),
        "write_parquet": f"""
            SELECT order_id, {whole('payment_sequential')} AS payment_sequential,
                   CAST(payment_value AS DOUBLE) AS payment_value
            FROM fact_payments""",
        "write_partitioned": """
            SELECT year(day) AS purchase_year, month(day) AS purchase_month, order_status, count(*) AS orders
            FROM fact_orders GROUP BY ALL""",
        "clean_strings": """
            SELECT c_custkey, c_name, nullif(c_mktsegment, 'MACHINERY') AS c_mktsegment FROM customer""",
        "coerce_timestamps": """
            SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' AND o_orderpriority NOT LIKE '5%' THEN o_orderdate END AS o_orderdate
            FROM orders""",
        "coerce_numeric": f"""
            SELECT p_partkey, CASE WHEN p_brand <> 'Brand#1' THEN p_retailprice END AS p_retailprice,
                   {whole("CASE WHEN p_brand <> 'Brand#2' THEN p_size END")} AS p_size
            FROM part""",
        "dedupe": f"""
            SELECT l_orderkey, {whole('l_linenumber')} AS l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate
            FROM lineitem
            QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                       ORDER BY l_partkey, l_suppkey, l_extendedprice, l_shipdate) = 1""",
        "dedupe_rows": "SELECT DISTINCT city AS geolocation_city, state AS geolocation_state FROM geo",
        "distinct_on": """
            SELECT DISTINCT ON (o_custkey) o_custkey, o_orderdate, o_orderkey, o_totalprice
            FROM orders ORDER BY o_custkey, o_orderdate DESC, o_orderkey""",
        "augment_date_parts": """
            SELECT year(day) AS purchase_year, month(day) AS purchase_month, count(*) AS orders
            FROM fact_orders GROUP BY 1, 2""",
        "normalise_geo_text": """
            SELECT c_custkey, lower(c_mktsegment) AS city, upper(c_mktsegment) AS state FROM customer""",
        "coalesce_label": """
            SELECT coalesce(product_category_english, 'unknown') AS category, count(*) AS products,
                   ROUND(avg(product_weight_g), 2) AS avg_weight
            FROM dim_products GROUP BY 1""",
        "nullif_blank_cast": "SELECT order_id, order_delivered_customer_date FROM fact_orders",
        "cents_to_units": f"""
            SELECT order_id, {whole('payment_sequential')} AS payment_sequential,
                   {whole('payment_value * 100')} AS cents, CAST(payment_value AS DOUBLE) AS amount
            FROM fact_payments""",
        "trim_incomplete_tail": f"""
            SELECT customer_state, month AS order_month, ROUND(v, 2) AS revenue FROM {trimmed(weak)} t""",
        "moving_average_forecast": f"""
            SELECT customer_state, strftime(last_month + to_months(CAST(h AS INTEGER)), '%Y-%m') AS period,
                   ROUND(greatest(level, 0), 2) AS forecast_revenue
            FROM (SELECT customer_state, max(month) AS last_month,
                         sum(v ORDER BY month) FILTER (WHERE i > last_i - 3)
                           / count(*) FILTER (WHERE i > last_i - 3) AS level
                  FROM {clean} t GROUP BY customer_state) f, (SELECT unnest([1, 2, 3]) AS h) g""",
        "change_audit": f"""
            SELECT review_id, {whole('review_score')} AS old_score, {whole('review_score - 1')} AS new_score,
                   TIMESTAMP '2002-01-01' AS changed_at
            FROM fact_reviews WHERE answer_latency_days > 5 AND review_score > 1""",
        "change_audit_ranged": f"""
            SELECT review_id, {whole('review_score')} AS old_score, {whole('review_score - 1')} AS new_score,
                   TIMESTAMP '2002-01-01' AS changed_at
            FROM fact_reviews WHERE answer_latency_days > 5 AND review_score > 1""",
        "cancel_orders": """
            SELECT CASE WHEN o.order_status = 'created' AND p.order_id IS NULL THEN 'canceled' ELSE o.order_status END AS order_status,
                   count(*) AS orders
            FROM fact_orders o LEFT JOIN paid p USING (order_id) GROUP BY 1""",
    }


def _holt() -> str:
    """A fold over each series' list per pair of weights: the grid's best, then its neighbours, round by round."""
    grid = "[0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]::DOUBLE[]"

    def error(a: str, b: str) -> str:
        """Squared error of a pair: states and values share one kind of struct."""
        expected = "(s.level + s.trend)"
        level = f"({a} * x.v + (1.0::DOUBLE - {a}) * {expected})"
        return (
            f"list_reduce(vals, lambda s, x: {{'level': {level}, 'trend': {b} * ({level} - s.level) + (1.0::DOUBLE - {b}) * s.trend,"
            f" 'sse': s.sse + (x.v - {expected}) * (x.v - {expected}), 'v': x.v}})"
        )

    def tried(a: str, b: str) -> str:
        return f"{{'sse': {error(a, b)}.sse, 'a': {a}, 'b': {b}}}"

    def moved(at: str, by: str) -> str:
        return f"least(greatest({at} + {by} * h, 0.01::DOUBLE), 0.99::DOUBLE)"

    prelude = PRELUDE.strip().replace("WITH raw_items", "WITH RECURSIVE raw_items", 1)
    offsets = ", ".join(f"{{'x': {x}.0::DOUBLE, 'y': {y}.0::DOUBLE}}" for x in (-1, 0, 1) for y in (-1, 0, 1) if x or y)
    offsets = f"[{offsets}]"
    return f"""{prelude}
        , points AS (
          SELECT state AS customer_state, month, CAST(sum(amount) AS DOUBLE) AS v,
                 row_number() OVER (PARTITION BY state ORDER BY month) AS i
          FROM sales GROUP BY state, month
        ), marked AS (
          SELECT *, coalesce(i > 4 AND avg(v) OVER b > 0 AND v < CAST(0.3 AS DOUBLE) * avg(v) OVER b, false) AS collapsed
          FROM points WINDOW b AS (PARTITION BY customer_state ORDER BY month ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)
        ), kept AS (
          SELECT customer_state, month, v
          FROM (SELECT *, max(CASE WHEN collapsed THEN 0 ELSE i END) OVER (PARTITION BY customer_state) AS last_i FROM marked) m
          WHERE i <= last_i
        ), series AS MATERIALIZED (
          SELECT customer_state, max(month) AS last_month, count(*) AS n, list(v ORDER BY month) AS vs FROM kept GROUP BY customer_state
        ), long AS MATERIALIZED (
          SELECT customer_state, last_month, list_transform(vs, lambda v, i: {{'level': vs[1], 'trend': vs[2] - vs[1], 'sse': 0.0::DOUBLE, 'v': v}}) AS vals
          FROM series WHERE n >= 6
        ), coarse AS (
          SELECT customer_state, last_month, vals,
                 list_sort(flatten(list_transform({grid}, lambda a: list_transform({grid}, lambda b: {tried("a", "b")}))))[1] AS w
          FROM long
        ), search AS (
          SELECT customer_state, last_month, vals, 0 AS round, w, 0.05::DOUBLE AS h FROM coarse
          UNION ALL
          SELECT customer_state, last_month, vals, round + 1, CASE WHEN m.sse < w.sse THEN m ELSE w END, CASE WHEN m.sse < w.sse THEN h ELSE h / 2 END
          FROM (SELECT *, list_sort(list_transform({offsets}, lambda o: {tried(moved("w.a", "o.x"), moved("w.b", "o.y"))}))[1] AS m
                FROM search WHERE round < 24 AND h >= 0.001) t
        ), best AS (
          SELECT customer_state, last_month, w, {error("w.a", "w.b")} AS fit FROM search
          QUALIFY row_number() OVER (PARTITION BY customer_state ORDER BY round DESC) = 1
        ), told AS (
          SELECT customer_state, last_month, fit.level AS level, fit.trend AS trend, w.a AS alpha, w.b AS beta FROM best
          UNION ALL
          SELECT customer_state, last_month, list_sum(vs[-3:]) / len(vs[-3:]), 0, NULL, NULL FROM series WHERE n < 6
        )
        SELECT customer_state, strftime(last_month + to_months(CAST(g AS INTEGER)), '%Y-%m') AS period,
               ROUND(greatest(level + CAST(g AS DOUBLE) * trend, 0), 2) AS forecast_revenue, alpha, beta
        FROM told, (SELECT unnest([1, 2, 3]) AS g) steps"""


def statements() -> dict[str, str]:
    parts = (
        _basics(),
        _windows(),
        _ranking(),
        _cohorts(),
        _segments(),
        _advanced(),
        _marts(),
        _reports(),
        _checks(),
        _pipelines(),
    )
    return {name: PRELUDE + sql for part in parts for name, sql in part.items()} | {
        "holt_forecast": _holt()
    }
