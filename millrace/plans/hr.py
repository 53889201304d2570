"""HR views: anonymised analytics view, full view, department figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.governance import anonymous_id
from millrace.operators.relational import split_left_join


def analyst_view(employees: DataFrame, pay: DataFrame, reviews: DataFrame, hidden: str = "Legal") -> DataFrame:
    """Pseudonym, department, years and quarters only; one department left out, free text dropped."""
    shown = employees.filter(F.col("department") != hidden)
    # An employee may have very many rows in either table.
    joined = split_left_join(split_left_join(shown, pay, ["employee_id"]), reviews, ["employee_id"])
    return joined.select(
        anonymous_id(F.col("employee_id")).alias("anonymous_id"), "department", F.year("hire_date").alias("hire_year"),
        "base_salary", "bonus", "stock_options", F.year("effective_date").alias("comp_year"), "rating",
        F.quarter("review_date").alias("review_quarter"), F.year("review_date").alias("review_year"),
    )


def full_view(employees: DataFrame, pay: DataFrame, reviews: DataFrame, cases: DataFrame) -> DataFrame:
    out = employees
    for other in (pay, reviews, cases):
        out = split_left_join(out, other, ["employee_id"])
    return out


def performance(view: DataFrame, as_of: Column) -> DataFrame:
    rated = view.filter(F.col("rating").isNotNull())
    return rated.groupBy("department").agg(
        F.avg("rating").alias("avg_rating"), F.min("rating").alias("min_rating"), F.max("rating").alias("max_rating"),
        F.countDistinct("anonymous_id").alias("employee_count"),
        F.avg(F.year(as_of) - F.col("hire_year")).alias("avg_tenure_years"),
    )


def operations(view: DataFrame) -> DataFrame:
    paid = view.filter(F.col("base_salary").isNotNull())
    return paid.groupBy("department").agg(
        F.countDistinct("anonymous_id").alias("employee_count"), F.avg("base_salary").alias("avg_salary"),
        F.avg("bonus").alias("avg_bonus"), F.avg(F.col("base_salary") + F.col("bonus")).alias("avg_total_comp"),
        F.avg("stock_options").alias("avg_stock_options"),
    )
