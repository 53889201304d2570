"""Banking job: current customers from a change feed, summaries, prospects and rebalancing advice."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.values import settle
from millrace.operators.changes import apply_changes
from millrace.operators.quality import enforce, expect_or_drop, with_declared_types

NET_WORTH_RULES = [expect_or_drop("customer known", "customer_id IS NOT NULL")]


def customers(feed: DataFrame) -> DataFrame:
    """Current customers: newest change per id, deleted ones removed, sequence column hidden."""
    return apply_changes(feed, ["customer_id"], ["seq"], "operation_type = 'DELETE'", ["seq"])


def banking_summary(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("num_transactions"), F.max("amount").alias("max_amount"), F.avg("amount").alias("avg_amount")
    )


def net_worth(portfolio: DataFrame) -> DataFrame:
    sums = portfolio.groupBy("customer_id").agg(F.round(F.sum("portfolio_value"), 2).alias("total_net_worth"))
    return enforce(with_declared_types(sums, {"customer_id": "string", "total_net_worth": "double"}), NET_WORTH_RULES)


def prospects(worth: DataFrame, bank_customers: DataFrame, campaigns: DataFrame, least: float = 500_000) -> DataFrame:
    """Who invests with us but does not bank with us, with wealth segment and expected revenue."""
    w = F.col("total_net_worth")
    segment = (
        F.when(w > 5_000_000, "Ultra High Net Worth").when(w > 2_000_000, "High Net Worth")
        .when(w > 1_000_000, "Affluent").otherwise("Mass Affluent")
    )
    wealthy = worth.filter(w > least).join(bank_customers, "customer_id", "left_anti")
    return wealthy.join(campaigns.select("customer_id", "campaign_name"), "customer_id", "left").select(
        "customer_id", "total_net_worth", segment.alias("wealth_segment"),
        F.round(F.round(w * 0.015, 7), 0).alias("estimated_revenue"), "campaign_name",
    )


def rebalancing(summary: DataFrame, worth: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Cash against investments per customer and campaign.

    A customer with several rows of one campaign counts them all, as the plain
    three-way join does: the rows are counted first and multiplied in.
    """
    per_campaign = campaigns.groupBy("customer_id", "campaign_name").agg(F.count(F.lit(1)).alias("_rows"))
    joined = (
        summary.filter("avg_amount > 2000").select("customer_id", "avg_amount")
        .join(worth.filter("total_net_worth > 5000"), "customer_id").join(per_campaign, "customer_id")
    )
    cash = F.col("avg_amount") * F.col("_rows")
    invested = F.col("total_net_worth") * F.col("_rows")
    sums = joined.select("customer_id", "campaign_name", cash.alias("cash"), invested.alias("invested"))
    much, little = F.col("cash") > F.col("invested") * 0.5, F.col("cash") < F.col("invested") * 0.05
    return sums.select(
        "customer_id", "campaign_name",
        settle(F.col("cash"), 2).alias("cash_position"), settle(F.col("invested"), 2).alias("investment_position"),
        settle(F.col("cash") / (F.col("cash") + F.col("invested")) * 100, 1).alias("cash_percentage"),
        F.when(much, "Too Much Cash - Suggest Investment").when(little, "Cash Poor - Suggest Liquidity Products")
        .otherwise("Balanced Portfolio").alias("recommendation"),
        settle(F.when(much, F.col("cash") * 0.3).when(little, F.col("invested") * 0.1).otherwise(0.0), 2).alias("suggested_amount"),
    )
