"""Product returns: trends, lots, facilities, places and premium tiers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewatch.functions import rules
from tidewatch.operators.windows import top_per_key
from tidewatch.params import Params


def _n(cond: Column) -> Column:
    return F.count_if(cond)


def daily_refund_trend(returns: DataFrame, p: Params) -> DataFrame:
    return (returns.filter(F.col("return_date") >= F.date_sub(F.lit(p.as_of), p.refund_trend_days))
            .groupBy("return_date").agg(F.sum("refund_amount_usd").alias("total_refund_usd"))
            .orderBy("return_date"))


def returns_by_product(returns: DataFrame, k: int = 10) -> DataFrame:
    return (returns.groupBy("product_name")
            .agg(F.count(F.lit(1)).alias("return_count"), F.sum("refund_amount_usd").alias("total_refund_usd"))
            .orderBy(F.desc("return_count"), "product_name").limit(k))


def lot_region(items: DataFrame) -> DataFrame:
    """Most frequent region per lot.

    Rows are counted per (lot, region) first; the pick is then an aggregate over
    those counts, so no lot is ever sorted as a group.
    """
    counts = items.groupBy("lot_id", "region").agg(F.count(F.lit(1)).alias("n"))
    # Highest count first, then the alphabetically first region.
    return counts.groupBy("lot_id").agg(
        F.min_by("region", F.struct((-F.col("n")).alias("k"), F.col("region"))).alias("region"))


def worst_lots(lots: DataFrame, products: DataFrame, items: DataFrame, returns: DataFrame,
               k: int = 20) -> DataFrame:
    """Lots with returns, by return rate.

    Items and returns are reduced to one row per lot before any join.  The item
    pass yields units and region together from one (lot, region) aggregate.
    """
    by_region = items.groupBy("lot_id", "region").agg(
        F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("units"))
    sold = by_region.groupBy("lot_id").agg(
        F.sum("units").alias("units"),
        F.min_by("region", F.struct((-F.col("n")).alias("k"), F.col("region"))).alias("region"))
    back = returns.groupBy("lot_id").agg(
        F.count("return_id").alias("return_count"), F.sum("refund_amount_usd").alias("refund"))
    units = F.coalesce("units", F.lit(0))
    rate = F.when(units > 0, F.col("return_count") * F.lit(100) / units.cast("double")).otherwise(F.lit(0.0))
    # A lot without returns is dropped by the report, so the join to returns is inner.
    return (lots.join(back, "lot_id", "inner").join(sold, "lot_id", "left").join(products, "product_id", "inner")
            .select("lot_id", "product_name", "facility", "region", "return_count",
                    units.cast("bigint").alias("units_sold"), F.round(rate, 1).alias("return_rate_pct"),
                    F.coalesce("refund", F.lit(0)).alias("total_refund_usd"))
            .orderBy(F.desc("return_rate_pct"), "lot_id").limit(k))


def status_summary(returns: DataFrame) -> DataFrame:
    return returns.groupBy("status").agg(F.count(F.lit(1)).alias("n"),
                                         F.sum("refund_amount_usd").alias("total_usd"))


def _volume() -> list[Column]:
    return [F.count(F.lit(1)).alias("return_count"), _n(F.col("status") == "pending").alias("pending_count"),
            F.sum("refund_amount_usd").alias("total_refund_usd")]


def facility_summary(returns: DataFrame) -> DataFrame:
    """Volume per facility and its share of the largest one."""
    # The window sees a row per facility.
    top = F.max("return_count").over(Window.partitionBy())
    return returns.groupBy("facility").agg(*_volume()).select(
        "facility", "return_count", "pending_count", "total_refund_usd",
        F.round(F.col("return_count") * 100 / top, 1).alias("share_of_max_pct"))


def facility_lots(returns: DataFrame, facility: str, k: int) -> DataFrame:
    """Top lots of one facility with their product names.

    One pass: rows are reduced to one per lot and product, so an array only
    holds the distinct products of one lot (a lot is made of one product).
    """
    per_product = returns.filter(F.col("facility") == facility).groupBy("lot_id", "product_name").agg(*_volume())
    return (per_product.groupBy("lot_id").agg(
        F.sum("return_count").alias("return_count"), F.sum("pending_count").alias("pending_count"),
        F.sum("total_refund_usd").alias("total_refund_usd"), F.count("product_name").alias("product_count"),
        F.array_join(F.sort_array(F.collect_list("product_name")), ", ").alias("product_names"))
        .orderBy(F.desc("return_count"), F.desc("total_refund_usd"), "lot_id").limit(k))


def lot_summary(returns: DataFrame, k: int | None = None) -> DataFrame:
    """Volume per lot, largest first; all lots unless the caller wants k."""
    rows = (returns.groupBy("lot_id", "facility").agg(*_volume())
            .orderBy(F.desc("return_count"), F.desc("total_refund_usd"), "lot_id"))
    return rows.limit(k) if k else rows


def city_breakdown(returns: DataFrame, **filters) -> DataFrame:
    """Customers per city for the map; rows without coordinates are skipped.

    Rows are reduced to one per customer first: a distinct count then is a plain
    count, and a busy customer costs one row.
    """
    rows = filtered(returns, **filters).filter(F.col("customer_lat").isNotNull() & F.col("customer_lng").isNotNull())
    lat, lng = F.col("customer_lat").cast("decimal(12,6)"), F.col("customer_lng").cast("decimal(12,6)")
    per_customer = rows.groupBy("city", "country", "customer_id").agg(
        F.sum(lat).alias("lat"), F.sum(lng).alias("lng"), F.count(F.lit(1)).alias("n"),
        F.bool_or(F.coalesce(F.col("final_tier") == "premium", F.lit(False))).alias("premium"),
        F.sum("refund_amount_usd").alias("refund"))
    return per_customer.groupBy("city", "country").agg(
        rules.exact_avg(F.sum("lat"), F.sum("n")).alias("lat"), rules.exact_avg(F.sum("lng"), F.sum("n")).alias("lng"),
        F.count(F.lit(1)).alias("total"), _n(F.col("premium")).alias("premium"),
        F.sum("refund").alias("refund_usd"),
        F.floor(_n(F.col("premium")) * 100 / F.count(F.lit(1)) + F.lit(0.5)).cast("bigint").alias("premium_pct"))


def geo_bounds(cities: DataFrame) -> DataFrame:
    return cities.agg(F.min("lat").alias("min_lat"), F.max("lat").alias("max_lat"),
                      F.min("lng").alias("min_lng"), F.max("lng").alias("max_lng"),
                      F.count(F.lit(1)).alias("n_cities"))


def _tiers() -> dict[str, Column]:
    tier, label = F.col("final_tier"), F.col("premium_status_labeled")
    return {"premium": F.coalesce(tier == "premium", F.lit(False)),
            "labeled": rules.is_labeled_premium(tier, label),
            "hidden": rules.is_hidden_premium(tier, label)}


def country_breakdown(returns: DataFrame, **filters) -> DataFrame:
    t = _tiers()
    return filtered(returns, **filters).groupBy("country").agg(
        F.count(F.lit(1)).alias("total"), _n(t["premium"]).alias("premium"),
        _n(t["labeled"]).alias("premium_labeled"), _n(t["hidden"]).alias("premium_hidden"),
        F.sum("refund_amount_usd").alias("refund_usd"))


def lot_premium_breakdown(returns: DataFrame) -> DataFrame:
    """Tier split of the pending returns of every lot, with its countries, most returns first."""
    t = _tiers()
    pending = returns.filter(F.col("status") == "pending")
    zero = F.lit(0).cast(rules.MONEY)
    refund = F.col("refund_amount_usd")
    by_country = pending.groupBy("lot_id", "country").agg(
        F.count(F.lit(1)).alias("n"), _n(t["premium"]).alias("p"), _n(t["labeled"]).alias("l"),
        _n(t["hidden"]).alias("h"), _n(F.col("final_tier") == "standard").alias("s"),
        _n(F.col("final_tier").isNull()).alias("u"),
        F.sum(F.when(t["premium"], refund).otherwise(zero)).alias("pr"),
        F.sum(F.when(~t["premium"], refund).otherwise(zero)).alias("sr"))
    # At most one entry per country and lot reaches the array.
    countries = F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("k"), F.col("country"))))
    return by_country.groupBy("lot_id").agg(
        F.sum("n").alias("total"), F.sum("p").alias("premium_count"), F.sum("s").alias("standard_count"),
        F.sum("l").alias("premium_labeled_count"), F.sum("h").alias("premium_predicted_hidden_count"),
        F.sum("u").alias("no_prediction_count"), F.sum("pr").alias("premium_refund_usd"),
        F.sum("sr").alias("standard_refund_usd"),
        F.array_join(F.transform(countries, lambda c: c["country"]), ",").alias("top_countries"))


def premium_flags(returns: DataFrame) -> DataFrame:
    t = _tiers()
    return returns.select("return_id", "final_tier", "premium_status_labeled",
                          t["labeled"].alias("is_labeled"), t["hidden"].alias("is_hidden"))


def returns_with_tier(returns: DataFrame, customers: DataFrame, predictions: DataFrame) -> DataFrame:
    """Returns with customer and the predicted tier, where one exists."""
    rows = returns.select("return_id", "lot_id", "customer_id", "refund_amount_usd", "status", "premium_status_labeled", "anger_score")
    return rows.join(customers, "customer_id", "inner").join(predictions, "customer_id", "left")


def return_detail(returns: DataFrame, customers: DataFrame, predictions: DataFrame, decided: DataFrame, return_id: str) -> DataFrame:
    """One return with its customer, both tier columns, probability, anger score, mails and audit trail."""
    mails = decided.select("return_id", F.col("status").alias("decided_status"),
                           F.array_join(F.transform("emails", lambda e: e["subject"]), "\n").alias("email_subjects"),
                           F.array_join(F.transform("audit_trail", lambda a: a["action"]), ",").alias("audit_actions"))
    one = returns.filter(F.col("return_id") == return_id)
    return (one.join(customers.select("customer_id", "customer_name"), "customer_id")
            .join(predictions.select("customer_id", "premium_prob"), "customer_id", "left").join(mails, "return_id", "left")
            .select("return_id", "lot_id", "facility", "product_name", F.coalesce("decided_status", "status").alias("status"), "final_tier",
                    "premium_status_labeled", "premium_prob", "anger_score", "refund_amount_usd", "customer_name",
                    F.coalesce("email_subjects", F.lit("")).alias("email_subjects"), F.coalesce("audit_actions", F.lit("")).alias("audit_actions")))


def severity_bands(lots_rate: DataFrame) -> DataFrame:
    return lots_rate.withColumn("severity", rules.rate_severity(F.col("return_rate_pct")))


def anger_bands(returns: DataFrame) -> DataFrame:
    return (returns.groupBy(rules.anger_severity(F.col("anger_score")).alias("anger_band"))
            .agg(F.count(F.lit(1)).alias("returns"), F.sum("refund_amount_usd").alias("refund_usd")))


def customer_orders(orders: DataFrame, lineitem: DataFrame, k: int = 10) -> DataFrame:
    """Latest k orders of every customer, with their number of items.

    Orders are ranked before the items are counted, so the item join only sees
    the orders that are kept.
    """
    head = orders.select(F.col("o_custkey").alias("customer_id"), F.col("o_orderkey").alias("order_id"),
                         F.col("o_orderdate").cast("date").alias("order_date"),
                         F.col("o_totalprice").cast("decimal(14,2)").alias("total_usd"),
                         F.col("o_orderstatus").alias("status"))
    latest = top_per_key(head, ["customer_id"], [F.desc("order_date"), F.desc("order_id")], k)
    items = lineitem.groupBy(F.col("l_orderkey").alias("order_id")).agg(F.count(F.lit(1)).alias("item_count"))
    return (latest.join(items, "order_id", "left")
            .withColumn("item_count", F.coalesce("item_count", F.lit(0))))


# ---- queue ----

def filtered(returns: DataFrame, **filters) -> DataFrame:
    """Keep rows that meet every filter that is set; NULL filters do not restrict."""
    preds = [F.col(c) == v for c, v in filters.items() if v is not None]
    return returns.filter(reduce(lambda a, b: a & b, preds)) if preds else returns


def searched(returns: DataFrame, term: str | None, cols) -> DataFrame:
    """Case-insensitive substring search over columns; a blank term keeps all rows."""
    needle = (term or "").strip().lower()
    if not needle:
        return returns
    hits = [F.lower(F.coalesce(F.col(c), F.lit(""))).contains(needle) for c in cols]
    return returns.filter(reduce(lambda a, b: a | b, hits))


SORT_KEYS = {"recent": "return_date", "value": "refund_amount_usd", "anger": "anger_score"}


def queue(returns: DataFrame, sort: str = "recent", limit: int | None = None, **filters) -> DataFrame:
    rows = filtered(returns, **filters).orderBy(F.desc_nulls_last(SORT_KEYS[sort]), "return_id")
    return rows.limit(limit) if limit else rows
