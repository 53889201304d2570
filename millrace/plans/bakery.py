"""Bakery jobs: flagship sales of the latest day, sales figures, store insights, messages for large purchases.

sales: transactionID, customerID, franchiseID, dateTime, product, quantity, totalPrice, paymentMethod
franchises: franchiseID, city, district, country, supplierId;  suppliers: supplierId, ingredient
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.values import settle
from millrace.operators.aggregates import mean_of_group_sums, peak_group, value_share
from millrace.operators.quality import Rule, enforce, expect, expect_or_drop, expect_or_fail
from millrace.operators.relational import latest_day
from millrace.operators.texts import build_prompt
from millrace.sinks.messages import json_payload

FLAGSHIP_RULES = [
    expect_or_drop("supplier_set", "supplierId IS NOT NULL"),
    expect_or_fail("real_city", "city != 'test'"),
]

SALES_RULES = [
    expect("has_sales", "num_sales > 0"),
    expect_or_drop("positive_revenue", "sum_price > 0"),
    expect_or_fail("known_group", "product IS NOT NULL"),
]


def flagship_locations(sales: DataFrame, franchises: DataFrame) -> DataFrame:
    """Sales per location on the most recent day.

    The day is summed per franchise before the join, so the join sees one row
    per franchise whatever the number of sales.
    """
    today = latest_day(sales, "dateTime").groupBy("franchiseID").agg(F.sum("totalPrice").alias("sales"))
    located = today.join(franchises, "franchiseID").groupBy("district", "city", "country", "supplierId")
    return enforce(located.agg(F.round(F.sum("sales"), 2).alias("total_sales")), FLAGSHIP_RULES)


def top_flagships(locations: DataFrame, suppliers: DataFrame, k: int = 5) -> DataFrame:
    """The best locations whose supplier has an ingredient."""
    joined = locations.join(suppliers, "supplierId", "left").filter(F.col("ingredient").isNotNull())
    best = joined.orderBy(F.desc("total_sales"), "district", "city", "country", "ingredient").limit(k)
    return best.select("total_sales", "district", "city", "country", "ingredient")


def sales_stats(sales: DataFrame) -> DataFrame:
    """Figures per product, checked by rules on the aggregated rows."""
    stats = sales.groupBy("product").agg(
        F.count(F.lit(1)).alias("num_sales"),
        F.sum("quantity").alias("sum_quantity"),
        F.round(F.sum("totalPrice"), 2).alias("sum_price"),
        settle(F.avg("totalPrice"), 2).alias("avg_price"),
        F.countDistinct("customerID").alias("n_customers"),
        F.countDistinct("franchiseID").alias("n_franchises"),
    )
    return enforce(stats, SALES_RULES)


def best_products(sales: DataFrame, k: int = 3) -> DataFrame:
    sums = sales.groupBy("product").agg(F.round(F.sum("totalPrice"), 2).alias("revenue"))
    return sums.orderBy(F.desc("revenue"), "product").limit(k)


def store_insights(sales: DataFrame) -> DataFrame:
    """Busiest hour, mean items per transaction and most used payment method in one row."""
    peak = peak_group(sales, F.hour("dateTime"), "hour")
    basket = mean_of_group_sums(sales, "transactionID", "quantity")
    share = value_share(sales, "paymentMethod").orderBy(F.desc("n"), "paymentMethod").limit(1)
    return peak.select(
        F.col("hour").alias("peak_hour"), F.col("n").alias("peak_sales"),
        F.round(basket.scalar(), 4).alias("mean_items"),
        share.select("paymentMethod").scalar().alias("top_payment"), share.select("share").scalar().alias("top_share"),
    )


def large_purchases(sales: DataFrame, limit: float = 25.0) -> DataFrame:
    """JSON messages for purchases above the limit."""
    kept = enforce(sales.filter(F.col("totalPrice") > limit), [expect_or_drop("has_customer", "customerID IS NOT NULL")])
    return json_payload(kept, ["transactionID", "customerID", "franchiseID", "product", "totalPrice"], "transactionID")


def marketing_prompt(product: str = "product", city: str = "city") -> object:
    """Prompt text per row, to be answered by a model column."""
    return build_prompt(["Write one friendly sentence that advertises ", F.col(product), " from our shop in ", F.col(city), "."])


def franchises_in(franchises: DataFrame, city: str) -> DataFrame:
    """Shops of a city, largest size name first."""
    return franchises.filter(F.lower("city") == city.lower()).orderBy(F.desc("size"), "franchiseID")


def franchise_sales(sales: DataFrame, franchise_id) -> DataFrame:
    """Revenue and number of sales per product of one shop."""
    return sales.filter(F.col("franchiseID") == franchise_id).groupBy("product").agg(
        F.count(F.lit(1)).alias("num_sales"), F.round(F.sum("totalPrice"), 2).alias("revenue")
    )


__all__ = [
    "Rule", "best_products", "flagship_locations", "franchise_sales", "franchises_in", "large_purchases",
    "marketing_prompt", "sales_stats", "store_insights", "top_flagships",
]
