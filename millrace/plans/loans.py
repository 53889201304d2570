"""Loan job: enrich transactions, split good from bad, balances.

transactions: id, accounting_treatment_id, balance, arrears_balance, cost_center_code, country_code, count,
next_payment_date (text);  ref: id, accounting_treatment;  history: accounting_treatment_id, revol_bal, addr_state
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.times import us_time
from millrace.operators.quality import enforce, expect, expect_or_drop, expect_or_fail, quarantine
from millrace.operators.relational import union_rows

RULES = [
    expect("payment date after 2020", "next_payment_at > DATE'2020-12-31'"),
    expect_or_drop("positive balance", "balance > 0 AND arrears_balance > 0"),
    expect_or_fail("cost center set", "cost_center_code IS NOT NULL"),
]

# The row is good or bad by this rule alone; the date rule only warns.
SPLIT_RULES = [RULES[1]]


def enriched(transactions: DataFrame, ref: DataFrame) -> DataFrame:
    """Transactions (batch or stream) with the name of their accounting treatment and a parsed payment date."""
    names = ref.select(F.col("id").alias("accounting_treatment_id"), "accounting_treatment")
    return transactions.join(names, "accounting_treatment_id").withColumn("next_payment_at", us_time(F.col("next_payment_date")))


def cleaned(new_transactions: DataFrame, observation=None) -> DataFrame:
    return enforce(new_transactions, RULES, observation)


def quarantined(new_transactions: DataFrame) -> DataFrame:
    """Rows the cleaned table drops, null balances included."""
    return quarantine(new_transactions, SPLIT_RULES)[1]


def historical(history: DataFrame, ref: DataFrame) -> DataFrame:
    names = ref.select(F.col("id").alias("accounting_treatment_id"), "accounting_treatment")
    return history.join(names, "accounting_treatment_id")


def total_balances(history: DataFrame, clean: DataFrame) -> DataFrame:
    """Historical and new balances per location; equal pairs collapse to one row."""
    old = history.groupBy("addr_state").agg(F.round(F.sum(F.col("revol_bal").try_cast("double")), 2).alias("bal"))
    new = clean.groupBy("country_code").agg(F.round(F.sum("balance"), 2).alias("bal"))
    return union_rows([
        old.select("bal", F.col("addr_state").alias("location_code")),
        new.select("bal", F.col("country_code").alias("location_code")),
    ], distinct=True)


def balances_by_cost_center(clean: DataFrame) -> DataFrame:
    return clean.groupBy("cost_center_code").agg(F.round(F.sum("balance"), 2).alias("sum_balance"))


def counts_by_country(clean: DataFrame) -> DataFrame:
    return clean.groupBy("country_code").agg(F.sum("count").alias("sum_count"))
