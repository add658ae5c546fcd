"""Queries of the product-returns domain."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators import distinct
from tidewatch.operators import returns as R
from tidewatch.plans.registry import query
from tidewatch.session import cut_lineage

_VOLUME = """COUNT(*) AS return_count, CAST(SUM(CASE WHEN status = 'pending' THEN 1 ELSE 0 END) AS BIGINT) AS pending_count, CAST(SUM(refund_amount_usd) AS DOUBLE) AS total_refund_usd"""
_HIDDEN = "COALESCE(final_tier = 'premium', false) AND NOT COALESCE(premium_status_labeled = 'premium', false)"
_LABELED = "COALESCE(final_tier = 'premium' AND premium_status_labeled = 'premium', false)"


@query("daily_refund_trend", """SELECT return_date, CAST(SUM(refund_amount_usd) AS DOUBLE) AS total_refund_usd FROM silver_returns
  WHERE return_date >= DATE '2024-01-30' - 30 GROUP BY return_date""")
def _(lake):
    return R.daily_refund_trend(lake["silver_returns"], lake.p)


@query("returns_by_product", """SELECT product_name, COUNT(*) AS return_count, CAST(SUM(refund_amount_usd) AS DOUBLE) AS total_refund_usd FROM silver_returns
  GROUP BY product_name ORDER BY return_count DESC, product_name LIMIT 10""")
def _(lake):
    return R.returns_by_product(lake["silver_returns"])


_LOT_REGION = """SELECT lot_id, region FROM (SELECT lot_id, region, ROW_NUMBER() OVER (PARTITION BY lot_id ORDER BY COUNT(*) DESC, region) AS rn
  FROM silver_order_items GROUP BY lot_id, region) WHERE rn = 1"""

_WORST = f"""SELECT l.lot_id, p.product_name, l.facility, g.region, b.return_count, CAST(floor(COALESCE(s.units, 0)) AS BIGINT) AS units_sold,
  CASE WHEN s.units > 0 THEN ROUND(b.return_count * 100 / CAST(s.units AS DOUBLE), 1) ELSE CAST(0 AS DOUBLE) END AS return_rate_pct, CAST(b.refund AS DOUBLE) AS total_refund_usd
  FROM (SELECT lot_id, COUNT(*) AS return_count, SUM(refund_amount_usd) AS refund FROM silver_returns GROUP BY lot_id) b
  JOIN lots l ON l.lot_id = b.lot_id JOIN products p ON p.product_id = l.product_id
  LEFT JOIN (SELECT lot_id, SUM(quantity) AS units FROM silver_order_items GROUP BY lot_id) s ON s.lot_id = b.lot_id
  LEFT JOIN ({_LOT_REGION}) g ON g.lot_id = b.lot_id
  ORDER BY return_rate_pct DESC, l.lot_id LIMIT 20"""


@query("worst_lots", _WORST)
def _(lake):
    return R.worst_lots(lake["lots"], lake["products"], lake["silver_order_items"], lake["silver_returns"])


@query("lot_region", _LOT_REGION)
def _(lake):
    return R.lot_region(lake["silver_order_items"])


@query("status_summary", "SELECT status, COUNT(*) AS n, CAST(SUM(refund_amount_usd) AS DOUBLE) AS total_usd FROM silver_returns GROUP BY status")
def _(lake):
    return R.status_summary(lake["silver_returns"])


@query("facility_summary", f"""SELECT *, ROUND(CAST(return_count * 100 AS DOUBLE) / MAX(return_count) OVER (), 1) AS share_of_max_pct
  FROM (SELECT facility, {_VOLUME} FROM silver_returns GROUP BY facility)""")
def _(lake):
    return R.facility_summary(lake["silver_returns"])


@query("facility_lots", f"""SELECT lot_id, {_VOLUME}, COUNT(DISTINCT product_name) AS product_count, string_agg(DISTINCT product_name, ', ' ORDER BY product_name) AS product_names
  FROM silver_returns WHERE facility = 'Brand#12' GROUP BY lot_id ORDER BY COUNT(*) DESC, SUM(refund_amount_usd) DESC, lot_id LIMIT 5""")
def _(lake):
    return R.facility_lots(lake["silver_returns"], "Brand#12", 5)


@query("lot_summary", f"SELECT lot_id, facility, {_VOLUME} FROM silver_returns GROUP BY lot_id, facility ORDER BY COUNT(*) DESC, SUM(refund_amount_usd) DESC, lot_id")
def _(lake):
    return R.lot_summary(lake["silver_returns"])


_CITY = """SELECT city, country, ROUND(CAST(SUM(CAST(customer_lat AS DECIMAL(12,6))) AS DOUBLE) / COUNT(*), 6) AS lat, ROUND(CAST(SUM(CAST(customer_lng AS DECIMAL(12,6))) AS DOUBLE) / COUNT(*), 6) AS lng,
  COUNT(DISTINCT customer_id) AS total, COUNT(DISTINCT CASE WHEN final_tier = 'premium' THEN customer_id END) AS premium, CAST(SUM(refund_amount_usd) AS DOUBLE) AS refund_usd,
  CAST(floor(COUNT(DISTINCT CASE WHEN final_tier = 'premium' THEN customer_id END) * 100 / COUNT(DISTINCT customer_id) + 0.5) AS BIGINT) AS premium_pct
  FROM silver_returns WHERE customer_lat IS NOT NULL AND customer_lng IS NOT NULL GROUP BY city, country"""


_PENDING_CITY = _CITY.replace("WHERE", "WHERE status = 'pending' AND")


@query("city_breakdown", _CITY)
def _(lake):
    return R.city_breakdown(lake["silver_returns"])


@query("distinct_customers", " UNION ALL ".join(
    f"SELECT '{level}' AS level, {city} AS city, {country} AS country, COUNT(DISTINCT customer_id) AS customers FROM silver_returns{by}" for level, city, country, by in (
        ("city", "city", "country", " GROUP BY city, country"), ("country", "CAST(NULL AS VARCHAR)", "country", " GROUP BY country"),
        ("total", "CAST(NULL AS VARCHAR)", "CAST(NULL AS VARCHAR)", ""))))
def _(lake):
    """All three levels from one written cube of bitmaps."""
    cube = cut_lineage(distinct.bitmap_cube(lake["silver_returns"], ["city", "country"], "customer_id"))
    levels = {"city": ["city", "country"], "country": ["country"], "total": []}
    return reduce(DataFrame.unionByName, [
        distinct.distinct_from_cube(cube, dims, "customers").select(
            F.lit(level).alias("level"), *[(F.col(c) if c in dims else F.lit(None).cast("string")).alias(c) for c in ("city", "country")], "customers")
        for level, dims in levels.items()])


@query("geo_bounds", f"SELECT MIN(lat) AS min_lat, MAX(lat) AS max_lat, MIN(lng) AS min_lng, MAX(lng) AS max_lng, COUNT(*) AS n_cities FROM ({_PENDING_CITY})")
def _(lake):
    return R.geo_bounds(R.city_breakdown(lake["silver_returns"], status="pending"))


@query("country_breakdown", f"""SELECT country, COUNT(*) AS total, COUNT(*) FILTER (WHERE final_tier = 'premium') AS premium, COUNT(*) FILTER (WHERE {_LABELED}) AS premium_labeled,
  COUNT(*) FILTER (WHERE {_HIDDEN}) AS premium_hidden, CAST(SUM(refund_amount_usd) AS DOUBLE) AS refund_usd FROM silver_returns WHERE status = 'pending' GROUP BY country""")
def _(lake):
    return R.country_breakdown(lake["silver_returns"], status="pending")


@query("lot_premium_breakdown", f"""SELECT a.*, c.top_countries FROM (SELECT lot_id, COUNT(*) AS total, COUNT(*) FILTER (WHERE final_tier = 'premium') AS premium_count, COUNT(*) FILTER (WHERE final_tier = 'standard') AS standard_count,
    COUNT(*) FILTER (WHERE {_LABELED}) AS premium_labeled_count, COUNT(*) FILTER (WHERE {_HIDDEN}) AS premium_predicted_hidden_count, COUNT(*) FILTER (WHERE final_tier IS NULL) AS no_prediction_count,
    CAST(SUM(CASE WHEN final_tier = 'premium' THEN refund_amount_usd ELSE 0 END) AS DOUBLE) AS premium_refund_usd, CAST(SUM(CASE WHEN final_tier = 'premium' THEN 0 ELSE refund_amount_usd END) AS DOUBLE) AS standard_refund_usd
    FROM silver_returns WHERE status = 'pending' GROUP BY lot_id) a
  JOIN (SELECT lot_id, string_agg(country, ',' ORDER BY n DESC, country) AS top_countries FROM (SELECT lot_id, country, COUNT(*) AS n
    FROM silver_returns WHERE status = 'pending' GROUP BY lot_id, country) GROUP BY lot_id) c ON a.lot_id = c.lot_id""")
def _(lake):
    return R.lot_premium_breakdown(lake["silver_returns"])


@query("premium_flags", f"SELECT return_id, final_tier, premium_status_labeled, {_LABELED} AS is_labeled, {_HIDDEN} AS is_hidden FROM silver_returns")
def _(lake):
    return R.premium_flags(lake["silver_returns"])


@query("returns_with_tier", """SELECT r.return_id, r.lot_id, r.customer_id, CAST(r.refund_amount_usd AS DOUBLE) AS refund_amount_usd, r.status, c.customer_name, c.customer_city, r.premium_status_labeled, r.anger_score, p.final_tier, CAST(p.premium_prob AS DOUBLE) AS premium_prob
  FROM silver_returns r JOIN return_customers c ON r.customer_id = c.customer_id LEFT JOIN premium_predictions p ON r.customer_id = p.customer_id""")
def _(lake):
    return R.returns_with_tier(lake["silver_returns"], lake["return_customers"], lake["premium_predictions"])


@query("severity_bands", f"SELECT lot_id, return_rate_pct, CASE WHEN return_rate_pct >= 20 THEN 'danger' WHEN return_rate_pct >= 10 THEN 'warning' ELSE 'normal' END AS severity FROM ({_WORST})")
def _(lake):
    worst = R.worst_lots(lake["lots"], lake["products"], lake["silver_order_items"], lake["silver_returns"])
    return R.severity_bands(worst).select("lot_id", "return_rate_pct", "severity")


@query("anger_bands", """SELECT CASE WHEN anger_score >= 0.7 THEN 'high' WHEN anger_score >= 0.4 THEN 'medium' WHEN anger_score IS NOT NULL THEN 'low' END AS anger_band, COUNT(*) AS returns,
  CAST(SUM(refund_amount_usd) AS DOUBLE) AS refund_usd FROM silver_returns GROUP BY 1""")
def _(lake):
    return R.anger_bands(lake["silver_returns"])


@query("customer_orders", """SELECT o.customer_id, o.order_id, o.order_date, CAST(o.total_usd AS DOUBLE) AS total_usd, o.status, CAST(o.rn AS INT) AS rank, COALESCE(i.item_count, 0) AS item_count
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY order_date DESC, order_id DESC) AS rn FROM (SELECT o_custkey AS customer_id, o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date,
    CAST(o_totalprice AS DECIMAL(14,2)) AS total_usd, o_orderstatus AS status FROM orders)) o
  LEFT JOIN (SELECT l_orderkey, COUNT(*) AS item_count FROM lineitem GROUP BY l_orderkey) i ON i.l_orderkey = o.order_id WHERE o.rn <= 10""")
def _(lake):
    return R.customer_orders(lake["orders"], lake["lineitem"])


_QUEUE = "return_id, lot_id, facility, product_name, country, status, final_tier, anger_score, return_date, CAST(refund_amount_usd AS DOUBLE) AS refund_amount_usd"
_QCOLS = ("return_id", "lot_id", "facility", "product_name", "country", "status", "final_tier", "anger_score",
          "return_date", "refund_amount_usd")


@query("queue_filtered", f"SELECT {_QUEUE} FROM silver_returns WHERE status = 'pending' AND final_tier = 'premium' AND country = 'ASIA'")
def _(lake):
    return R.queue(lake["silver_returns"], status="pending", lot_id=None, final_tier="premium", country="ASIA").select(*_QCOLS)


@query("queue_search", f"SELECT {_QUEUE} FROM silver_returns WHERE lower(product_name) LIKE '%ring%' OR lower(city) LIKE '%ring%' OR lower(lot_id) LIKE '%ring%'")
def _(lake):
    return R.searched(lake["silver_returns"], " RING ", ("product_name", "city", "lot_id")).select(*_QCOLS)


@query("queue_sort_value", f"SELECT {_QUEUE} FROM silver_returns ORDER BY silver_returns.refund_amount_usd DESC, return_id")
def _(lake):
    return R.queue(lake["silver_returns"], "value").select(*_QCOLS)


@query("queue_sort_anger", f"SELECT {_QUEUE} FROM silver_returns WHERE status = 'pending' ORDER BY anger_score DESC NULLS LAST, return_id")
def _(lake):
    return R.queue(lake["silver_returns"], "anger", status="pending").select(*_QCOLS)


@query("queue_sort_recent", f"SELECT {_QUEUE} FROM silver_returns ORDER BY return_date DESC, return_id")
def _(lake):
    return R.queue(lake["silver_returns"], "recent").select(*_QCOLS)
