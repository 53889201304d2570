"""Grouped figures, shares, histograms and curves."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.values import settle


def rate_percent(condition: Column, digits: int = 2) -> Column:
    """Share of rows that satisfy the condition, in percent."""
    return F.round(F.count_if(condition) * F.lit(100.0) / F.count(F.lit(1)), digits)


def distinct_per_band(df: DataFrame, group: Sequence[str], entity: str, bands: Mapping[str, Column]) -> DataFrame:
    """Distinct entities in total and per band.

    Entities are reduced to one row per group first, each with a flag per band;
    several ``count(distinct)`` would copy every row once per band instead.
    """
    flags = [F.max(F.when(cond, 1).otherwise(0)).alias(name) for name, cond in bands.items()]
    per_entity = df.filter(F.col(entity).isNotNull()).groupBy(*group, entity).agg(*flags)
    sums = [F.sum(name).cast("bigint").alias(name) for name in bands]
    return per_entity.groupBy(*group).agg(F.count(F.lit(1)).alias("total"), *sums)


def value_share(df: DataFrame, column: str, digits: int = 4) -> DataFrame:
    """Share of each value in percent of all non-null rows."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.select(column, "n", F.round(F.col("n") * 100.0 / total, digits).alias("share"))


def peak_group(df: DataFrame, group: Column, name: str) -> DataFrame:
    """The group with most rows (smallest group on ties) and its row count."""
    counts = df.groupBy(group.alias(name)).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), name).limit(1)


def mean_of_group_sums(df: DataFrame, group: str, value: str) -> DataFrame:
    sums = df.groupBy(group).agg(F.sum(value).alias("_sum"))
    return sums.agg(F.avg("_sum").alias("mean_sum"))


def dense_curve(df: DataFrame, bucket: str, values: Sequence[str]) -> DataFrame:
    """One row per bucket from the first to the last, missing ones with zeros.

    ``df`` has one row per bucket, so its length is bounded by the calendar.
    """
    ends = df.agg(F.min(bucket).alias("lo"), F.max(bucket).alias("hi")).filter("lo IS NOT NULL")
    frames = ends.select(F.explode(F.sequence("lo", "hi")).alias(bucket))
    filled = [F.coalesce(F.col(v), F.lit(0)).alias(v) for v in values]
    return frames.join(df, bucket, "left").select(bucket, *filled)


def histogram(df: DataFrame, value: str, width: float, name: str = "bin") -> DataFrame:
    bin_no = F.floor(F.col(value) / width).cast("bigint")
    return df.groupBy(bin_no.alias(name)).agg(F.count(F.lit(1)).alias("n"))


def extents(df: DataFrame, columns: Sequence[str], digits: int = 3) -> DataFrame:
    cells = []
    for c in columns:
        cells += [F.round(F.min(c), digits).alias(f"min_{c}"), F.round(F.max(c), digits).alias(f"max_{c}")]
    return df.agg(*cells)


def client_stats(df: DataFrame, client: str, ts: str, as_of: Column, active_seconds: int = 300) -> DataFrame:
    """Rows, first and last sighting, and whether seen within the active span."""
    stats = df.groupBy(client).agg(
        F.count(F.lit(1)).alias("event_count"), F.min(ts).alias("first_seen"), F.max(ts).alias("last_seen")
    )
    age = F.unix_micros(as_of) - F.unix_micros(F.col("last_seen").cast("timestamp"))
    return stats.withColumn("is_active", age < active_seconds * 1_000_000)


def size_estimate(df: DataFrame, bytes_per_row: float = 288.0) -> DataFrame:
    """Row count and estimated size in MiB."""
    rows = F.count(F.lit(1))
    return df.agg(rows.alias("n_rows"), F.round(rows * bytes_per_row / (1024 * 1024), 2).alias("size_mb"))


SHARES = (0.5, 0.95, 0.99)
#: Size of a quantile sketch; the error of a rank is about 2.3 / size, so 0.06 % here.
SKETCH_SIZE = 4096


def quantile_sketches(df: DataFrame, group: Sequence[str], value: str, size: int = SKETCH_SIZE) -> DataFrame:
    """Per group: rows with a value (n), their sum (total) and a sketch of bounded size, to be stored and merged later."""
    number = F.col(value).cast("double")
    sketch = F.kll_sketch_agg_double(number, size).alias("sketch")
    return df.filter(number.isNotNull() & ~F.isnan(number)).groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.sum(number).alias("total"), sketch)


def merged_sketches(sketches: DataFrame, group: Sequence[str]) -> DataFrame:
    """Sketches of parts, e.g. of batches, as one per group; the rows themselves are not needed again."""
    return sketches.groupBy(*group).agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.kll_merge_agg_double("sketch").alias("sketch"))


def quantiles_of(sketches: DataFrame, group: Sequence[str], value: str, shares: Sequence[float] = SHARES) -> DataFrame:
    """Mean and quantiles per group: the smallest value that reaches the share, up to the error of the sketch."""
    found = F.kll_sketch_get_quantile_double("sketch", F.array(*map(F.lit, shares)))
    cells = [found[i].alias(f"p{round(p * 100)}_{value}") for i, p in enumerate(shares)]
    return sketches.select(*group, "n", settle(F.col("total") / F.col("n"), 4).alias(f"mean_{value}"), *cells)


def exact_quantiles(df: DataFrame, sketches: DataFrame, group: Sequence[str], value: str, slack: float, shares: Sequence[float] = SHARES) -> DataFrame:
    """Mean and exact nearest-rank quantiles per group of ``df``, from the merged sketches of its rows.

    A sketch tells between which two values a quantile lies: those of the shares ``slack`` below and above.  Rows are counted below
    and between them, and only those between are put in order.  Where the counts show that a sketch was wrong, its end is left
    open, so the result is exact whatever the sketch says.
    """
    from millrace.operators.windows import join_on, with_positions

    number = F.col(value).cast("double")
    rows = df.select(*group, number.alias("_value")).filter(F.col("_value").isNotNull() & ~F.isnan("_value"))
    ends = F.array(*[F.lit(x) for p in shares for x in (max(p - slack, 0.0), min(p + slack, 1.0))])
    found = F.kll_sketch_get_quantile_double("sketch", ends)
    places = F.array(*[
        F.struct(F.lit(i).alias("_share"), F.greatest(F.lit(1), F.ceil(F.col("n") * p)).alias("_rank"), found[2 * i].alias("_low"), found[2 * i + 1].alias("_high"))
        for i, p in enumerate(shares)
    ])
    # One row per group and share.
    bounds = sketches.select(*group, F.inline(places))
    counts = join_on(rows, bounds, group).groupBy(*group, "_share", "_rank", "_low", "_high").agg(
        F.count_if(F.col("_value") < F.col("_low")).alias("_below"), F.count_if(F.col("_value") <= F.col("_high")).alias("_reached")
    )
    early, late = F.col("_rank") <= F.col("_below"), F.col("_rank") > F.col("_reached")
    kept = counts.select(
        *group, "_share", F.when(~early, F.col("_low")).alias("_low"), F.when(~late, F.col("_high")).alias("_high"),
        (F.col("_rank") - F.when(early, 0).otherwise(F.col("_below"))).alias("_rank"),
    )
    between = join_on(rows, kept, group).filter((F.col("_low").isNull() | (F.col("_value") >= F.col("_low"))) & (F.col("_high").isNull() | (F.col("_value") <= F.col("_high"))))
    placed = with_positions(between.select(*group, "_share", "_rank", "_value"), [*group, "_share"], ["_value"], "_pos")
    exact = placed.filter(F.col("_pos") == F.col("_rank")).groupBy(*group).agg(
        *[F.max(F.when(F.col("_share") == i, F.col("_value"))).alias(f"p{round(p * 100)}_{value}") for i, p in enumerate(shares)]
    )
    means = sketches.select(*group, "n", settle(F.col("total") / F.col("n"), 4).alias(f"mean_{value}"))
    # A group without a value has a row too.
    return join_on(join_on(df.select(*group).distinct(), means, group, "left"), exact, group, "left")


def percentiles(df: DataFrame, group: Sequence[str], value: str, size: int = SKETCH_SIZE) -> DataFrame:
    """Rows, mean, p50, p95, p99 per group from one mergeable sketch of bounded size a group."""
    return quantiles_of(quantile_sketches(df, group, value, size), group, value)


def ranks_of(df: DataFrame, figures: DataFrame, group: Sequence[str], value: str, shares: Sequence[float] = SHARES) -> DataFrame:
    """The share of a group's rows at or below each of its quantiles, to hold an estimate against its share."""
    from millrace.operators.windows import join_on

    names = [f"p{round(p * 100)}_{value}" for p in shares]
    both = join_on(df.filter(F.col(value).isNotNull()).select(*group, value), figures.select(*group, *names), group)
    cells = [(F.count_if(F.col(value) <= F.col(name)) / F.count(F.lit(1))).alias(f"rank_{name}") for name in names]
    return both.groupBy(*group).agg(*cells)


def exact_quantile(df: DataFrame, group: Sequence[str], value: str, p: float, tie: str) -> DataFrame:
    """Exact nearest-rank quantile per group without holding a group in one task."""
    from millrace.operators.windows import join_on, with_positions

    rows = df.filter(F.col(value).isNotNull())
    totals = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    placed = join_on(with_positions(rows.select(*group, value, tie), group, [value, tie], "_pos"), totals, group)
    rank = F.greatest(F.lit(1), F.ceil(F.col("_n") * p))
    return placed.filter(F.col("_pos") == rank).select(*group, F.col(value).alias("quantile"))


def pivot_text(df: DataFrame, group: Sequence[str], key: str, value: str, names: Sequence[str]) -> DataFrame:
    """Named rows to columns, greatest text per cell; the fixed list saves a pass to find the names."""
    return df.groupBy(*group).pivot(key, list(names)).agg(F.max(value))


def span_stats(df: DataFrame, ts: str, entity: str) -> DataFrame:
    """Rows, distinct entities, first and last time, whole seconds between them."""
    stats = df.agg(
        F.count(F.lit(1)).alias("num_events"), F.countDistinct(entity).alias("n_entities"),
        F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"),
    )
    seconds = F.timestamp_diff("SECOND", F.col("first_ts"), F.col("last_ts"))
    return stats.withColumn("span_seconds", seconds)
