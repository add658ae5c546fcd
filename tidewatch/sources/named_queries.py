"""A closed set of named SQL queries over tables named by parameters.

Table names come in as bound strings and are resolved by ``IDENTIFIER``; a
caller can neither run other SQL nor splice text into a query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

NAMED_QUERIES = {
    "daily_refund_trend": """
        SELECT return_date, SUM(refund_amount_usd) AS total_refund_usd FROM IDENTIFIER(:returns)
        WHERE return_date >= date_sub(CAST(:as_of AS DATE), 30)
        GROUP BY return_date ORDER BY return_date""",
    "returns_by_product": """
        SELECT product_name, COUNT(*) AS return_count, SUM(refund_amount_usd) AS total_refund_usd FROM IDENTIFIER(:returns)
        GROUP BY product_name ORDER BY return_count DESC, product_name LIMIT 10""",
    "worst_lots": """
        WITH back AS (
            SELECT lot_id, COUNT(return_id) AS return_count, SUM(refund_amount_usd) AS total_refund_usd FROM IDENTIFIER(:returns) GROUP BY lot_id),
        by_region AS (
            SELECT lot_id, region, COUNT(*) AS n, SUM(quantity) AS units FROM IDENTIFIER(:items) GROUP BY lot_id, region),
        sold AS (
            SELECT lot_id, SUM(units) AS units_sold, min_by(region, struct(-n, region)) AS region FROM by_region GROUP BY lot_id)
        SELECT l.lot_id, p.product_name, l.facility, s.region, b.return_count, COALESCE(s.units_sold, 0) AS units_sold,
               CASE WHEN s.units_sold > 0 THEN ROUND(b.return_count * 100 / CAST(s.units_sold AS DOUBLE), 1) ELSE 0 END AS return_rate_pct,
               b.total_refund_usd
        FROM back b
        JOIN IDENTIFIER(:lots) l ON l.lot_id = b.lot_id
        JOIN IDENTIFIER(:products) p ON p.product_id = l.product_id
        LEFT JOIN sold s ON s.lot_id = b.lot_id
        ORDER BY return_rate_pct DESC, l.lot_id LIMIT 20""",
}


def run_named(spark: SparkSession, name: str, **params: str) -> DataFrame:
    if name not in NAMED_QUERIES:
        raise KeyError(f"unknown query: {name}")
    text = NAMED_QUERIES[name]
    return spark.sql(text, args={k: v for k, v in params.items() if f":{k}" in text})
