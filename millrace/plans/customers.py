"""Customer 360: derived figures, product recommendation, serving extract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import email_of
from millrace.functions.values import value_band

# Factor and divisor of the churn score, number of recommended products, bounds of the bands.
CHURN_FACTOR, PRODUCTS, RECENCY_DAYS = 17, 12, 90
CHURN_BOUNDS, CHURN_LABELS = (0.33, 0.66), ("Low", "Medium", "High")


def customer_360(directory: DataFrame, products: DataFrame, as_of: Column) -> DataFrame:
    """One row per customer with order value, churn band and a recommended product.

    directory: customer_id, full_name, city, segment, total_sales, num_sales;
    products: product_id, product_name, category, price
    """
    cid = F.col("customer_id")
    score = F.round((cid * CHURN_FACTOR % 100) / F.lit(100.0), 2)
    enriched = directory.select(
        "customer_id", "full_name", email_of(F.col("full_name")).alias("email"), "city", "segment",
        F.col("total_sales").alias("lifetime_value"), F.col("num_sales").alias("total_orders"),
        F.round(F.round(F.col("total_sales") / F.greatest(F.col("num_sales"), F.lit(1)), 7), 2).alias("avg_order_value"),
        score.alias("churn_risk_score"), value_band(score, CHURN_BOUNDS, CHURN_LABELS).alias("churn_risk_band"),
        (cid % PRODUCTS + 1).alias("recommended_product_id"),
        F.date_sub(as_of, (cid % RECENCY_DAYS).cast("int")).alias("last_order_date"),
    )
    chosen = products.select(
        F.col("product_id").alias("recommended_product_id"), F.col("product_name").alias("recommended_product_name"),
        F.col("category").alias("recommended_category"), F.col("price").alias("recommended_price"),
    )
    return enriched.join(chosen, "recommended_product_id", "left")


def sales_by_segment(events: DataFrame, directory: DataFrame) -> DataFrame:
    """Fact rows by customer segment; facts are summed per customer before the join."""
    per_customer = events.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"))
    return per_customer.join(directory.select("customer_id", "segment"), "customer_id").groupBy("segment").agg(
        F.sum("n").alias("num_events"), F.round(F.sum("amount"), 2).alias("amount")
    )
