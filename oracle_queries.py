"""DuckDB SQL for each registered query, written on the sample tables alone.

Every query is a chain of the named steps below it needs, then a final SELECT.
"""

from __future__ import annotations

AS_OF = "DATE '2001-08-01'"

# name -> (steps it builds on, SELECT)
STEPS: dict[str, tuple[list[str], str]] = {
    "marked": (
        [],
        """
        SELECT o_orderkey, o_custkey, o_orderdate, l_partkey, l_quantity, l_extendedprice,
               l_discount, l_tax, l_linenumber, n_name,
               l_returnflag = 'R' AND l_quantity >= 48 AS is_cancel
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey
        """,
    ),
    "raw": (
        ["marked"],
        """
        SELECT CASE WHEN l_partkey % 53 <> 0 THEN
                    CASE WHEN is_cancel THEN 'C'
                         WHEN o_custkey % 5 = 0 AND l_partkey % 13 = 0 THEN 'c' ELSE '' END
                    || CAST(o_orderkey AS VARCHAR) END AS invoice,
               CAST(l_partkey AS VARCHAR) AS stock_code,
               CASE WHEN l_linenumber = 1 THEN 'sample "line", caf' || chr(233)
                    ELSE 'sample line' END AS description,
               CAST(CASE WHEN is_cancel OR (l_linenumber = 7 AND l_quantity <= 2)
                         THEN -l_quantity ELSE l_quantity END AS BIGINT) AS quantity,
               CASE WHEN l_partkey % 7 = 0 THEN o_orderdate + INTERVAL 1 MINUTE
                    ELSE o_orderdate END AS invoice_date,
               CASE WHEN l_discount = 0.1 AND l_tax = 0.08 THEN 0.0
                    ELSE l_extendedprice / l_quantity END AS price,
               CASE WHEN o_custkey % 5 = 0 THEN NULL
                    ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
               CASE WHEN l_partkey % 11 = 0 THEN 'ELSEWHERE'
                    WHEN l_partkey % 97 = 0 THEN NULL ELSE n_name END AS country
        FROM marked
        """,
    ),
    "lines": (
        ["raw"],
        """
        SELECT *, CAST(quantity AS DOUBLE) * price AS revenue,
               CAST(CAST(quantity AS DOUBLE) * price AS DECIMAL(28,6)) AS amount
        FROM raw
        """,
    ),
    "sales": (
        ["lines"],
        """
        SELECT * FROM lines
        WHERE customer_id IS NOT NULL AND quantity > 0 AND price > 0
          AND (invoice IS NULL OR substr(invoice, 1, 1) <> 'C')
        """,
    ),
    "takebacks": (
        ["lines"],
        """
        SELECT * FROM lines
        WHERE customer_id IS NOT NULL AND substr(invoice, 1, 1) = 'C' AND quantity < 0
        """,
    ),
    "order_rows": (
        ["sales"],
        """
        SELECT invoice, customer_id, invoice_date, country,
               CAST(SUM(quantity) AS BIGINT) AS total_items,
               CAST(SUM(amount) AS DOUBLE) AS total_revenue,
               COUNT(DISTINCT stock_code) AS unique_products,
               CAST(invoice_date AS DATE) AS order_date
        FROM sales
        WHERE invoice IS NOT NULL AND customer_id IS NOT NULL
          AND invoice_date IS NOT NULL AND country IS NOT NULL
        GROUP BY invoice, customer_id, invoice_date, country
        """,
    ),
    "ranked": (
        ["order_rows"],
        """
        SELECT customer_id, order_date,
               ROW_NUMBER() OVER (PARTITION BY customer_id
                                  ORDER BY order_date, invoice_date, invoice, country) AS rk
        FROM order_rows
        """,
    ),
    "gaps": (
        ["ranked"],
        """
        SELECT customer_id, first_order_date, second_order_date,
               strftime(first_order_date, '%Y-%m') AS cohort_month,
               CAST(datediff('day', first_order_date, second_order_date) AS INTEGER)
                   AS time_to_second_order_days,
               CAST(coalesce(datediff('day', first_order_date, second_order_date) <= 30, FALSE)
                    AS INTEGER) AS had_repeat_within_30d,
               CAST(second_order_date IS NOT NULL AS INTEGER) AS made_second_purchase
        FROM (SELECT customer_id,
                     MAX(order_date) FILTER (WHERE rk = 1) AS first_order_date,
                     MAX(order_date) FILTER (WHERE rk = 2) AS second_order_date
              FROM ranked GROUP BY customer_id)
        """,
    ),
    "home": (
        ["order_rows"],
        """
        SELECT customer_id, country
        FROM (SELECT customer_id, country,
                     ROW_NUMBER() OVER (PARTITION BY customer_id
                                        ORDER BY COUNT(*) DESC, country) AS pos
              FROM order_rows GROUP BY customer_id, country)
        WHERE pos = 1
        """,
    ),
    "totals": (
        ["order_rows"],
        """
        SELECT customer_id, MAX(order_date) AS last_order_date,
               COUNT(DISTINCT invoice) AS total_orders,
               SUM(CAST(total_revenue AS DECIMAL(28,6))) AS amount,
               CAST(SUM(total_items) AS BIGINT) AS total_items
        FROM order_rows GROUP BY customer_id
        """,
    ),
    "features": (
        ["totals", "home", "gaps"],
        f"""
        SELECT customer_id, last_order_date, total_orders,
               CAST(amount AS DOUBLE) AS total_revenue, total_items, country,
               first_order_date, cohort_month,
               CAST(datediff('day', last_order_date, {AS_OF}) AS INTEGER) AS recency_days,
               total_orders AS frequency,
               CAST(ROUND(CAST(amount AS DECIMAL(38,10)), 2) AS DOUBLE) AS monetary,
               time_to_second_order_days, had_repeat_within_30d, made_second_purchase,
               CAST(datediff('day', last_order_date, {AS_OF}) > 90 AS INTEGER) AS churned
        FROM totals JOIN home USING (customer_id) JOIN gaps USING (customer_id)
        """,
    ),
    "edges": (
        ["features"],
        """
        SELECT quantile_cont(CAST(recency_days AS DOUBLE), 0.25) AS r1,
               quantile_cont(CAST(recency_days AS DOUBLE), 0.50) AS r2,
               quantile_cont(CAST(recency_days AS DOUBLE), 0.75) AS r3,
               quantile_cont(monetary, 0.25) AS m1,
               quantile_cont(monetary, 0.50) AS m2,
               quantile_cont(monetary, 0.75) AS m3
        FROM features
        """,
    ),
    "scores": (
        ["features", "edges"],
        """
        SELECT features.*,
               CAST(CASE WHEN recency_days <= r1 THEN 4 WHEN recency_days <= r2 THEN 3
                         WHEN recency_days <= r3 THEN 2 ELSE 1 END AS INTEGER) AS r_score,
               CAST(CASE WHEN monetary <= m1 THEN 1 WHEN monetary <= m2 THEN 2
                         WHEN monetary <= m3 THEN 3 ELSE 4 END AS INTEGER) AS m_score,
               CAST(CASE WHEN frequency <= 1 THEN 1 WHEN frequency <= 3 THEN 2
                         WHEN frequency <= 7 THEN 3 ELSE 4 END AS INTEGER) AS f_score
        FROM features CROSS JOIN edges
        """,
    ),
    "tiers": (
        ["scores"],
        """
        SELECT *, CASE WHEN f_score >= 3 AND r_score >= 3 THEN 'Champions'
                       WHEN f_score >= 3 THEN 'Loyal'
                       WHEN f_score = 1 AND r_score >= 3 THEN 'New'
                       WHEN f_score = 2 AND r_score <= 2 THEN 'At Risk'
                       ELSE 'Lost' END AS rfm_tier
        FROM scores
        """,
    ),
    "returners": (
        ["takebacks"],
        "SELECT DISTINCT customer_id FROM takebacks WHERE customer_id IS NOT NULL",
    ),
    "tier_report": (
        ["tiers"],
        """
        SELECT *, CASE WHEN churn_rate_pct >= 80 THEN 'Critical'
                       WHEN churn_rate_pct >= 50 THEN 'High'
                       WHEN churn_rate_pct >= 25 THEN 'Moderate'
                       ELSE 'Healthy' END AS risk_level
        FROM (SELECT rfm_tier, COUNT(*) AS total_customers,
                     CAST(SUM(churned) AS BIGINT) AS churned_customers,
                     {pct:churned} AS churn_rate_pct,
                     {mean2:monetary} AS avg_revenue_per_customer,
                     {mean1:frequency} AS avg_orders
              FROM tiers GROUP BY rfm_tier)
        """,
    ),
    "cohort_report": (
        ["features", "order_rows"],
        """
        SELECT cohort_month, cohort_size, months_since_first, active_customers,
               CAST(ROUND(CAST(100.0::DOUBLE * active_customers / cohort_size
                               AS DECIMAL(38,10)), 1) AS DOUBLE) AS retention_pct
        FROM (SELECT cohort_month,
                     CAST(trunc(datediff('day', first_order_date, order_date) / 30.44::DOUBLE)
                          AS INTEGER) AS months_since_first,
                     COUNT(DISTINCT customer_id) AS active_customers
              FROM order_rows JOIN (SELECT customer_id, cohort_month, first_order_date
                                    FROM features) USING (customer_id)
              GROUP BY 1, 2)
        JOIN (SELECT cohort_month, COUNT(*) AS cohort_size FROM features GROUP BY 1)
          USING (cohort_month)
        WHERE months_since_first BETWEEN 0 AND 11
        """,
    ),
    "trend_report": (
        ["order_rows"],
        """
        SELECT period, granularity, COUNT(DISTINCT customer_id) AS active_customers,
               COUNT(DISTINCT invoice) AS orders_placed,
               CAST(ROUND(SUM(CAST(total_revenue AS DECIMAL(28,6))), 2) AS DOUBLE) AS revenue
        FROM (SELECT *, strftime(order_date, '%Y-%m-%d %H:%M:%S') AS period,
                     'day' AS granularity FROM order_rows
              UNION ALL
              SELECT *, strftime(order_date, '%Y-%W'), 'week' FROM order_rows)
        GROUP BY period, granularity
        """,
    ),
    "share_report": (
        ["lines", "sales"],
        """
        SELECT customer_type, transaction_count, total_revenue, avg_line_value,
               CAST(ROUND(CAST(100.0::DOUBLE * transaction_count
                    / SUM(transaction_count) OVER () AS DECIMAL(38,10)), 1) AS DOUBLE)
                    AS pct_of_transactions,
               CAST(ROUND(CAST(100.0::DOUBLE * total_revenue
                    / SUM(total_revenue) OVER () AS DECIMAL(38,10)), 1) AS DOUBLE)
                    AS pct_of_revenue
        FROM (SELECT customer_type, COUNT(*) AS transaction_count,
                     CAST(ROUND(SUM(amount), 2) AS DOUBLE) AS total_revenue,
                     {mean2:amount} AS avg_line_value
              FROM (SELECT 'Identified' AS customer_type, amount FROM sales
                    UNION ALL
                    SELECT 'Anonymous', amount FROM lines
                    WHERE customer_id IS NULL AND quantity > 0 AND price > 0
                      AND invoice NOT ILIKE 'C%')
              GROUP BY customer_type)
        """,
    ),
    "returns_report": (
        ["features", "returners"],
        """
        SELECT returner_group, COUNT(*) AS total_customers,
               CAST(SUM(1 - churned) AS BIGINT) AS retained_customers,
               {pct:1 - churned} AS retention_pct,
               {mean2:monetary} AS avg_lifetime_revenue,
               {mean1:frequency} AS avg_orders
        FROM (SELECT *, CASE WHEN customer_id IN (SELECT customer_id FROM returners)
                             THEN 'Made a return' ELSE 'No returns' END AS returner_group
              FROM features)
        GROUP BY returner_group
        """,
    ),
    "second_report": (
        ["features"],
        """
        SELECT repeat_bucket, sort_order, COUNT(*) AS total_customers,
               CAST(SUM(1 - churned) AS BIGINT) AS retained_customers,
               {pct:1 - churned} AS retention_pct
        FROM (SELECT churned,
                     CASE sort_order WHEN 1 THEN 'One-time only' WHEN 2 THEN 'Within 7 days'
                          WHEN 3 THEN '8-30 days' WHEN 4 THEN '31-90 days'
                          ELSE '90+ days' END AS repeat_bucket, sort_order
              FROM (SELECT churned,
                           CAST(CASE WHEN made_second_purchase = 0 THEN 1
                                     WHEN time_to_second_order_days <= 7 THEN 2
                                     WHEN time_to_second_order_days <= 30 THEN 3
                                     WHEN time_to_second_order_days <= 90 THEN 4
                                     ELSE 5 END AS INTEGER) AS sort_order
                    FROM features))
        GROUP BY repeat_bucket, sort_order
        """,
    ),
    "count_report": (
        ["features"],
        """
        SELECT CASE WHEN sort_order = 11 THEN '11+' ELSE CAST(sort_order AS VARCHAR) END
                   AS lifetime_orders,
               sort_order, COUNT(*) AS total_customers,
               CAST(SUM(1 - churned) AS BIGINT) AS retained_customers,
               {pct:1 - churned} AS retention_pct
        FROM (SELECT churned, CAST(least(frequency, 11) AS BIGINT) AS sort_order FROM features)
        GROUP BY sort_order
        """,
    ),
}

_RETENTION = ["total_customers", "retained_customers", "retention_pct"]

# Report -> (step, columns that name a row, columns with figures).
REPORT_SHAPES = {
    "churn_by_rfm_tier": (
        "tier_report",
        ["rfm_tier", "risk_level"],
        ["total_customers", "churned_customers", "churn_rate_pct", "avg_revenue_per_customer",
         "avg_orders"],
    ),
    "cohort_retention": (
        "cohort_report",
        ["cohort_month", "months_since_first"],
        ["cohort_size", "active_customers", "retention_pct"],
    ),
    "activity_trend": (
        "trend_report",
        ["granularity", "period"],
        ["active_customers", "orders_placed", "revenue"],
    ),
    "time_to_second_purchase": ("second_report", ["sort_order", "repeat_bucket"], _RETENTION),
    "order_frequency_aha": ("count_report", ["sort_order", "lifetime_orders"], _RETENTION),
    "anonymous_share": (
        "share_report",
        ["customer_type"],
        ["transaction_count", "total_revenue", "avg_line_value", "pct_of_transactions",
         "pct_of_revenue"],
    ),
    "returns_analysis": (
        "returns_report",
        ["returner_group"],
        [*_RETENTION, "avg_lifetime_revenue", "avg_orders"],
    ),
}

_LINE_CHECKS = {
    "row_count": "COUNT(*)",
    "customers": "COUNT(DISTINCT customer_id)",
    "invoices": "COUNT(DISTINCT invoice)",
    "countries": "COUNT(DISTINCT country)",
    "minutes": "COUNT(DISTINCT invoice_date)",
    "descriptions": "COUNT(DISTINCT description)",
    "quantity": "SUM(quantity)",
    "revenue": "ROUND(SUM(CAST(revenue AS DECIMAL(28,6))), 2)",
}

# Stored table -> (step, check -> SQL that both engines read).
TABLE_CHECKS = {
    "transactions": ("sales", _LINE_CHECKS),
    "anonymous_tx": ("(SELECT * FROM lines WHERE customer_id IS NULL)", _LINE_CHECKS),
    "cancellations": ("takebacks", _LINE_CHECKS),
    "orders": (
        "order_rows",
        {
            "row_count": "COUNT(*)",
            "customers": "COUNT(DISTINCT customer_id)",
            "invoices": "COUNT(DISTINCT invoice)",
            "days": "COUNT(DISTINCT order_date)",
            "items": "SUM(total_items)",
            "products": "SUM(unique_products)",
            "revenue": "ROUND(SUM(CAST(total_revenue AS DECIMAL(28,6))), 2)",
        },
    ),
    "customers": (
        "(SELECT tiers.*, CAST(customer_id IN (SELECT customer_id FROM returners) AS INTEGER)"
        " AS had_return FROM tiers)",
        {
            "row_count": "COUNT(*)",
            "countries": "COUNT(DISTINCT country)",
            "first_days": "COUNT(DISTINCT first_order_date)",
            "tiers": "COUNT(DISTINCT rfm_tier)",
            "scores": "SUM(100 * r_score + 10 * f_score + m_score)",
            "gaps": "SUM(time_to_second_order_days)",
            "churned": "SUM(churned)",
            "returners": "SUM(had_return)",
            "monetary": "ROUND(SUM(CAST(monetary AS DECIMAL(28,6))), 2)",
        },
    ),
}



def _breakdown(key: str, name: str) -> tuple[list[str], str]:
    """Identified and anonymous lines and revenue by a key, and the anonymous shares."""
    share = (
        "CAST(ROUND(CAST(100.0::DOUBLE * anonymous_{0} / NULLIF(anonymous_{0} + identified_{0}, 0)"
        " AS DECIMAL(38,10)), 1) AS DOUBLE) AS pct_anonymous_{0}"
    )
    return (
        ["lines", "sales"],
        f"""
        SELECT *, {share.format("lines")}, {share.format("revenue")}
        FROM (SELECT {key} AS {name},
                     COUNT(*) FILTER (WHERE customer_id IS NOT NULL) AS identified_lines,
                     CAST(ROUND(COALESCE(SUM(amount) FILTER (WHERE customer_id IS NOT NULL), 0), 2)
                          AS DOUBLE) AS identified_revenue,
                     COUNT(*) FILTER (WHERE customer_id IS NULL) AS anonymous_lines,
                     CAST(ROUND(COALESCE(SUM(amount) FILTER (WHERE customer_id IS NULL), 0), 2)
                          AS DOUBLE) AS anonymous_revenue
              FROM (SELECT country, invoice_date, customer_id, amount FROM sales
                    UNION ALL
                    SELECT country, invoice_date, NULL, amount FROM lines
                    WHERE customer_id IS NULL AND quantity > 0 AND price > 0
                      AND invoice NOT ILIKE 'C%')
              GROUP BY 1)
        """,
    )


# Query name -> (steps, final SELECT).
FINALS: dict[str, tuple[list[str], str]] = {
    "raw_csv_feed": (
        ["raw"],
        "SELECT * REPLACE (CAST(customer_id AS DOUBLE) AS customer_id) FROM raw",
    ),
    "clean_transactions": (["sales"], "SELECT * EXCLUDE (amount) FROM sales"),
    "cancellations": (["takebacks"], "SELECT * EXCLUDE (amount) FROM takebacks"),
    "anonymous_lines": (
        ["lines"],
        "SELECT * EXCLUDE (amount) FROM lines WHERE customer_id IS NULL",
    ),
    "order_rollup": (["order_rows"], "SELECT * FROM order_rows"),
    "purchase_gaps": (["gaps"], "SELECT * FROM gaps"),
    "customer_country_mode": (
        [],
        """
        SELECT customer_id, country
        FROM (SELECT CAST(o_custkey AS VARCHAR) AS customer_id, o_orderpriority AS country,
                     ROW_NUMBER() OVER (PARTITION BY o_custkey
                                        ORDER BY COUNT(*) DESC, o_orderpriority) AS pos
              FROM orders GROUP BY o_custkey, o_orderpriority)
        WHERE pos = 1
        """,
    ),
    "customer_features": (["features"], "SELECT * FROM features"),
    "stored_customer_features": (["features"], "SELECT * FROM features"),
    "rfm_scores": (
        ["tiers"],
        """
        SELECT customer_id, recency_days, frequency, monetary,
               r_score, m_score, f_score, rfm_tier
        FROM tiers
        """,
    ),
    "return_flags": (
        ["order_rows", "returners"],
        """
        SELECT DISTINCT customer_id,
               CAST(customer_id IN (SELECT customer_id FROM returners) AS INTEGER) AS had_return
        FROM order_rows
        """,
    ),
    "customers": (
        ["tiers", "returners"],
        """
        SELECT tiers.*,
               CAST(customer_id IN (SELECT customer_id FROM returners) AS INTEGER) AS had_return
        FROM tiers
        """,
    ),
    "churn_by_rfm_tier": (["tier_report"], "SELECT * FROM tier_report"),
    "cohort_retention": (["cohort_report"], "SELECT * FROM cohort_report"),
    "activity_trend": (["trend_report"], "SELECT * FROM trend_report"),
    "time_to_second_purchase": (["second_report"], "SELECT * FROM second_report"),
    "order_frequency_aha": (["count_report"], "SELECT * FROM count_report"),
    "anonymous_share": (["share_report"], "SELECT * FROM share_report"),
    "anonymous_by_country": _breakdown("country", "country"),
    "anonymous_by_month": _breakdown("strftime(invoice_date, '%Y-%m')", "month"),
    "returns_analysis": (["returns_report"], "SELECT * FROM returns_report"),
    "cohort_matrix_pivot": (
        ["cohort_report"],
        "SELECT cohort_month, "
        + ", ".join(
            f"MAX(CASE WHEN months_since_first = {k} THEN retention_pct END) AS m{k}"
            for k in range(12)
        )
        + " FROM cohort_report WHERE cohort_size >= 20 GROUP BY cohort_month",
    ),
    "overview_kpis": (
        ["tier_report", "share_report"],
        """
        SELECT CAST(SUM(total_customers) AS BIGINT) AS total_customers,
               CAST(SUM(churned_customers) AS DOUBLE) * 100 / SUM(total_customers)
                   AS overall_churn_pct,
               (SELECT total_revenue FROM share_report WHERE customer_type = 'Identified')
                   AS total_revenue,
               CAST(SUM(CAST(avg_revenue_per_customer * total_customers AS DECIMAL(28,6)))
                    AS DOUBLE) AS total_revenue_from_tiers,
               100 - (SELECT pct_of_revenue FROM share_report
                      WHERE customer_type = 'Identified') AS anonymous_revenue_pct
        FROM tier_report
        """,
    ),
    "weekly_activity": (["trend_report"], "SELECT * FROM trend_report WHERE granularity = 'week'"),
    "activity_kpis": (
        ["trend_report"],
        """
        SELECT MAX(active_customers) FILTER (WHERE granularity = 'day') AS peak_daily_customers,
               MAX(active_customers) FILTER (WHERE granularity = 'week') AS peak_weekly_customers,
               MAX(revenue) FILTER (WHERE granularity = 'day') AS peak_daily_revenue,
               AVG(orders_placed) FILTER (WHERE granularity = 'day') AS avg_daily_orders
        FROM trend_report
        """,
    ),
    "repeat_30d_retention": (
        ["features"],
        """
        SELECT had_repeat_within_30d, COUNT(*) AS total_customers,
               CAST(SUM(1 - churned) AS BIGINT) AS retained_customers,
               {pct:1 - churned} AS retention_pct
        FROM features GROUP BY had_repeat_within_30d
        """,
    ),
    "tier_counts": (
        ["tiers"],
        "SELECT rfm_tier, COUNT(*) AS customers FROM tiers GROUP BY rfm_tier",
    ),
    "pipeline_audit": (
        ["raw", "sales", "takebacks", "order_rows", "features"],
        """
        SELECT metric, CAST(n AS DOUBLE) AS value
        FROM (SELECT 'raw_rows' AS metric, CAST(COUNT(*) AS DOUBLE) AS n FROM raw
              UNION ALL SELECT 'identified_rows', COUNT(customer_id) FROM raw
              UNION ALL SELECT 'anonymous_rows', COUNT(*) - COUNT(customer_id) FROM raw
              UNION ALL SELECT 'transaction_rows', COUNT(*) FROM sales
              UNION ALL SELECT 'cancellation_rows', COUNT(*) FROM takebacks
              UNION ALL SELECT 'order_rows', COUNT(*) FROM order_rows
              UNION ALL SELECT 'customers', COUNT(*) FROM features
              UNION ALL SELECT 'churn_pct', {pct:churned} FROM features)
        """,
    ),
    "catalog_roundtrip": (
        [
            "tier_report", "cohort_report", "trend_report", "second_report",
            "count_report", "share_report", "returns_report",
        ],
        "\nUNION ALL ".join(
            f"SELECT '{report}' AS report, concat_ws('|', {', '.join(keys)}) AS row_key,"
            f" '{measure}' AS measure, CAST({measure} AS DOUBLE) AS value FROM {step}"
            for report, (step, keys, measures) in REPORT_SHAPES.items()
            for measure in measures
        ),
    ),
    "stored_tables": (
        ["lines", "sales", "takebacks", "order_rows", "tiers", "returners"],
        "\nUNION ALL ".join(
            f"SELECT '{table}' AS table_name, '{name}' AS measure,"
            f" CAST({sql} AS DOUBLE) AS value FROM {step}"
            for table, (step, checks) in TABLE_CHECKS.items()
            for name, sql in checks.items()
        ),
    ),
}

# Shorthands for rounded measures: half away from zero on the decimal form.
_SHORTHANDS = {
    "pct": "CAST(ROUND(CAST(AVG({}) * 100 AS DECIMAL(38,10)), 1) AS DOUBLE)",
    "mean1": "CAST(ROUND(CAST(AVG({}) AS DECIMAL(38,10)), 1) AS DOUBLE)",
    "mean2": "CAST(ROUND(CAST(CAST(SUM(CAST({} AS DECIMAL(28,6))) AS DOUBLE) / COUNT(*)"
    " AS DECIMAL(38,10)), 2) AS DOUBLE)",
}


def _expand(sql: str) -> str:
    for name, template in _SHORTHANDS.items():
        while (start := sql.find("{" + name + ":")) >= 0:
            end = sql.index("}", start)
            argument = sql[start + len(name) + 2 : end]
            sql = sql[:start] + template.format(argument) + sql[end + 1 :]
    return sql


def _in_order(names: list[str], done: list[str]) -> list[str]:
    for name in names:
        if name not in done:
            _in_order(STEPS[name][0], done)
            done.append(name)
    return done


def _query(steps: list[str], final: str) -> str:
    chain = [f"{name} AS ({STEPS[name][1]})" for name in _in_order(steps, [])]
    prefix = "WITH " + ",\n".join(chain) + "\n" if chain else ""
    return _expand(prefix + final)


ORACLE_SQL = {name: _query(steps, final) for name, (steps, final) in FINALS.items()}
