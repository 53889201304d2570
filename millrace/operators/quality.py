"""Data-quality rules: warn, drop, fail, quarantine, profile, reconcile.

A rule passes only when its predicate is true; null counts as a violation, so
the kept and the quarantined rows are exact complements.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WARN, DROP, FAIL = "warn", "drop", "fail"


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: str | Column
    action: str = WARN

    def passed(self) -> Column:
        cond = F.expr(self.predicate) if isinstance(self.predicate, str) else self.predicate
        return F.coalesce(cond, F.lit(False))


def expect(name: str, predicate: str | Column) -> Rule:
    return Rule(name, predicate, WARN)


def expect_or_drop(name: str, predicate: str | Column) -> Rule:
    return Rule(name, predicate, DROP)


def expect_or_fail(name: str, predicate: str | Column) -> Rule:
    return Rule(name, predicate, FAIL)


def expect_all(rules: Mapping[str, str | Column], action: str = WARN) -> list[Rule]:
    return [Rule(name, predicate, action) for name, predicate in rules.items()]


def all_passed(rules: Sequence[Rule]) -> Column:
    return reduce(lambda a, b: a & b, [r.passed() for r in rules], F.lit(True))


def metric_columns(rules: Sequence[Rule]) -> list[Column]:
    """Row total and violations per rule, for ``observe`` or ``agg``."""
    failed = [F.count_if(~r.passed()).alias(f"failed: {r.name}") for r in rules]
    return [F.count(F.lit(1)).alias("rows"), *failed]


def enforce(df: DataFrame, rules: Sequence[Rule], observation=None) -> DataFrame:
    """Apply the rules; ``observation`` (an Observation or a name) collects counts of the unfiltered input.

    A failing row raises an error with the name of its rule while the rows are
    read, so a batch or micro-batch with such a row commits nothing.
    """
    if observation is not None and rules:
        df = df.observe(observation, *metric_columns(rules))
    stops = [r for r in rules if r.action == FAIL]
    if stops:
        message = F.concat(F.lit("violated: "), F.concat_ws(", ", *[F.when(~r.passed(), r.name) for r in stops]))
        # The partition number makes the filter non-deterministic: Spark must not move it below a join or
        # an aggregate, where it would meet rows that never reach this dataset.
        in_place = F.spark_partition_id() >= 0
        checked = F.when(in_place & all_passed(stops), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
        df = df.filter(checked)
    drops = [r for r in rules if r.action == DROP]
    return df.filter(all_passed(drops)) if drops else df


def rule_metrics(df: DataFrame, dataset: str, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule with passed and failed counts, from a single pass."""
    counts = df.agg(*metric_columns(rules))
    rows = [
        F.struct(
            F.lit(dataset).alias("dataset"), F.lit(r.name).alias("rule"), F.lit(r.action).alias("action"),
            (F.col("rows") - F.col(f"failed: {r.name}")).alias("passed"), F.col(f"failed: {r.name}").alias("failed"),
        )
        for r in rules
    ]
    return counts.select(F.inline(F.array(*rows)))


def quarantine(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Good rows, and all other rows with the names of the rules they violate."""
    names = F.concat_ws("; ", *[F.when(~r.passed(), r.name) for r in rules])
    return df.filter(all_passed(rules)), df.filter(~all_passed(rules)).withColumn("violations", names)


def with_declared_types(df: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """Cast to the declared column list before rules are applied; bad values become null."""
    return df.select(*[F.col(c).try_cast(t).alias(c) for c, t in schema.items()])


#: Registers of a distinct-count sketch as a power of two; the standard error is about 0.83 / sqrt(2 ** 14), 0.65 %.
DISTINCT_BITS = 14


def column_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), numeric: Sequence[str] = ()) -> DataFrame:
    """Per column, and per value of ``by`` (a day, a load): rows, set values, range, and a sketch of the distinct values.

    One pass; the rows of this table can be stored and merged with those of later loads.
    """
    cells = [F.count(F.lit(1)).alias("_n")]
    for c in columns:
        cells += [F.count(c).alias(f"{c}|set"), F.hll_sketch_agg(F.col(c).cast("string"), DISTINCT_BITS).alias(f"{c}|sketch")]
        if c in numeric:
            cells += [F.min(c).cast("double").alias(f"{c}|min"), F.max(c).cast("double").alias(f"{c}|max")]
    none = F.lit(None).cast("double")
    rows = [
        F.struct(
            F.lit(c).alias("column_name"), F.col("_n").alias("n_rows"), F.col(f"{c}|set").alias("n_set"), F.col(f"{c}|sketch").alias("sketch"),
            (F.col(f"{c}|min") if c in numeric else none).alias("min_value"), (F.col(f"{c}|max") if c in numeric else none).alias("max_value"),
        )
        for c in columns
    ]
    return df.groupBy(*by).agg(*cells).select(*by, F.inline(F.array(*rows)))


def merged_profile(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per column: rows, nulls, estimated distinct values, range; from the sketches of any number of parts."""
    merged = sketches.groupBy(*by, "column_name").agg(
        F.sum("n_rows").alias("n_rows"), (F.sum("n_rows") - F.sum("n_set")).alias("n_nulls"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("approx_distinct"), F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value"),
    )
    return merged


def profile(df: DataFrame, columns: Sequence[str], numeric: Sequence[str] = ()) -> DataFrame:
    """Per column: rows, nulls, distinct estimate, and range of numeric columns; one pass over the table."""
    return merged_profile(column_sketches(df, columns, (), numeric))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    if duplicate_keys(df, keys).limit(1).count():
        raise ValueError(f"duplicate keys over {', '.join(keys)}")


def reconcile(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows and null keys of both tables, and the number of joined row pairs.

    Both sides are counted per key first and the counts multiplied, so a hot key
    never produces its pairs.
    """
    def per_key(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias(name))

    a, b = per_key(left, "n_left"), per_key(right, "n_right")
    overlap = a.join(b, "k").agg(
        F.count(F.lit(1)).alias("shared_keys"), F.coalesce(F.sum(F.col("n_left") * F.col("n_right")), F.lit(0)).alias("joined_rows")
    )

    def side(counts: DataFrame, name: str) -> list[Column]:
        # From the counts per key, whose shuffle Spark reuses: each table is read once.
        n = F.col(f"n_{name}")
        rows = counts.agg(F.coalesce(F.sum(n), F.lit(0))).scalar()
        nulls = counts.agg(F.coalesce(F.sum(F.when(F.col("k").isNull(), n)), F.lit(0))).scalar()
        return [rows.alias(f"{name}_rows"), nulls.alias(f"{name}_null_keys")]

    return overlap.select(*side(a, "left"), *side(b, "right"), "shared_keys", "joined_rows")
