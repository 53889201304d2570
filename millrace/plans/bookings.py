"""Booking job: change log to current bookings, fraud flags, fraud rate by party size and payment method."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.aggregates import rate_percent
from millrace.operators.changes import apply_changes


def current_bookings(updates: DataFrame) -> DataFrame:
    return apply_changes(updates, ["booking_id"], ["booking_update_id"])


def with_fraud(bookings: DataFrame, flags: DataFrame) -> DataFrame:
    """Every booking; those without a flag are not fraud."""
    chosen = flags.select("booking_id", "flag", F.col("confidence").alias("fraud_confidence"), F.col("reason").alias("fraud_reason"))
    joined = bookings.join(chosen, "booking_id", "left")
    return joined.withColumn("is_fraud", F.coalesce(F.col("flag") == "fraud", F.lit(False))).drop("flag")


def fraud_rates(bookings: DataFrame, payments: DataFrame) -> DataFrame:
    """Bookings and fraud share per party size and payment method."""
    paid = bookings.join(payments, "booking_id")
    return paid.groupBy(F.col("guests_count").alias("party_size"), "payment_method").agg(
        F.count(F.lit(1)).alias("total_bookings"),
        F.count_if("is_fraud").alias("fraud_count"),
        rate_percent(F.col("is_fraud")).alias("fraud_rate_pct"),
    )
