"""Latest rows, positions, lags and resampling that stay balanced when one key is huge.

A window partitioned by a key sorts all rows of that key in one task.  Three
ways around it are used here:

* latest row per key: an aggregate (``max_by``), combined before the shuffle;
* row numbers: a prefix scan, range-partitioned slices numbered by their tasks plus the rows of the slices before;
* bounded look-back (lag, rolling mean, next row): the numbered rows are cut into
  blocks of consecutive rows, each with the few neighbour rows it needs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from millrace.functions.times import bucket_start, time_bucket
from millrace.session import durable

#: Rows of a block: as many rows of one key a window holds at most.
BLOCK_ROWS = 500_000
#: Rows of a task whose rows are kept in memory.
TASK_ROWS = 250_000

_SLICE, _AT, _POS, _BLOCK, _OWN, _COUNT, _BEFORE = "_slice", "_at", "_pos", "_block", "_own", "_count", "_before"


def _order(columns: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in columns]


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], where: Column | None = None) -> DataFrame:
    """Newest row per key, as ``max_by`` over the whole row.

    Partial results are made before the shuffle, so a key with a third of all
    rows costs one row per input task.
    """
    if where is not None:
        df = df.filter(where)
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(newest).select(*keys, *[F.col("_row")[c].alias(c) for c in rest])


def first_row_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """First row per key in the given order; Spark keeps one row per key and task before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*_order(order))
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def numbered(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """0-based place of every row in the whole order: a prefix scan over range-partitioned slices.

    A task sorts its slice and numbers it; the rows of the slices before, one number a slice, are added.  Equal rows of one
    place in the order may be numbered either way, so the slices are written once.
    """
    ranged = df.repartitionByRange(*_order(order)).sortWithinPartitions(*_order(order))
    # The upper bits are the slice, the lower 33 the place in it.
    placed = durable(ranged.withColumn(_AT, F.monotonically_increasing_id()))
    part = F.shiftright(_AT, 33)
    slices = placed.groupBy(part.alias(_SLICE)).agg(F.count(F.lit(1)).alias(_COUNT))
    earlier = Window.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    # One row per task.
    shifts = F.broadcast(slices.select(_SLICE, (F.coalesce(F.sum(_COUNT).over(earlier), F.lit(0)) - F.shiftleft(F.col(_SLICE), 33)).alias(_BEFORE)))
    return placed.withColumn(_SLICE, part).join(shifts, _SLICE).withColumn(name, F.col(_AT) + F.col(_BEFORE)).select(*df.columns, name)


def with_positions(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "position") -> DataFrame:
    """1-based row number per key (of the whole table when ``keys`` is empty).

    ``order`` must be a total order within a key.  Rows are numbered in the order of key and ``order``, and the number of the
    key's first row is taken off; it is looked up per block of rows and key, so a hot key is many lookups of bounded size.
    """
    if not keys:
        return numbered(df, order, name).withColumn(name, F.col(name) + 1)
    scanned = numbered(df, [*keys, *order], _POS).withColumn(_BLOCK, F.floor(F.col(_POS) / BLOCK_ROWS).cast("bigint"))
    pieces = scanned.groupBy(*keys, _BLOCK).agg(F.min(_POS).alias(_BEFORE))
    # One row per block and key.
    firsts = pieces.withColumn(_BEFORE, F.min(_BEFORE).over(Window.partitionBy(*keys)))
    joined = join_on(scanned, firsts, [*keys, _BLOCK])
    return joined.select(*df.columns, (F.col(_POS) - F.col(_BEFORE) + 1).alias(name))


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """``left`` with the other columns of ``right``; a null key matches a null key."""
    named = right.select(*[F.col(c).alias(f"_right_{c}" if c in keys else c) for c in right.columns])
    match = F.lit(True)
    for k in keys:
        match = match & left[k].eqNullSafe(named[f"_right_{k}"])
    return left.join(named, match, how).drop(*[f"_right_{k}" for k in keys])


def in_bounded_tasks(df: DataFrame, keys: Sequence[str], rows: int, task_rows: int | None = None) -> DataFrame:
    """``df`` of at most ``rows`` rows, dealt by ``keys`` to as many tasks as keep each at about ``task_rows`` rows.

    For groups that are much smaller than a task: windows by ``keys`` then need no further shuffle.  Where the session has
    as many tasks anyway, the rows stay as they are.
    """
    tasks = -(-rows // (TASK_ROWS if task_rows is None else task_rows))
    return df.repartition(tasks, *keys) if tasks > df.sparkSession.sparkContext.defaultParallelism else df


def over_groups(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    build: Callable[[WindowSpec], dict[str, Column]],
    before: int = 0,
    after: int = 0,
    block_rows: int | None = None,
) -> DataFrame:
    """Add window columns that look at most ``before`` rows back and ``after`` rows ahead.

    Rows are numbered in the order of key and ``order`` and cut into blocks of ``block_rows``; a block also receives copies of the
    neighbour rows its frames reach, which are removed after the window.  So a window holds at most a block of one key, however
    long the key's group is, and the result equals that of the plain window.
    """
    block_rows = BLOCK_ROWS if block_rows is None else block_rows
    if max(before, after) > block_rows:
        raise ValueError("frames must be shorter than a block")
    scanned = numbered(df, [*keys, *order], _POS)
    home = F.floor(F.col(_POS) / block_rows).cast("bigint")
    offset = F.col(_POS) % block_rows
    targets = F.array(home, F.when(offset >= block_rows - before, home + 1), F.when(offset < after, home - 1))
    spread = scanned.withColumn(_OWN, home).withColumn(_BLOCK, F.explode(F.array_compact(targets)))
    w = Window.partitionBy(*keys, _BLOCK).orderBy(_POS)
    out = spread.select("*", *[c.alias(n) for n, c in build(w).items()])
    return out.filter(F.col(_OWN) == F.col(_BLOCK)).drop(_POS, _OWN, _BLOCK)


def even_subsample(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """At most ``n`` rows per key, evenly spread: the first row of each of ``n`` equal tiles.

    Keys with up to ``n`` rows keep all of them.  The first ``total % n`` tiles
    are one row longer, as with NTILE.
    """
    placed = with_positions(df, keys, order, "_pos")
    totals = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_total"))
    joined = join_on(placed, totals, keys) if keys else placed.withColumn("_total", totals.scalar())
    size, longer = F.floor(F.col("_total") / n).cast("bigint"), F.col("_total") % n
    index = F.col("_pos") - 1
    cut = longer * (size + 1)
    tile = F.when(index < cut, F.floor(index / (size + 1))).otherwise(longer + F.floor((index - cut) / size))
    start = F.when(index < cut, index % (size + 1) == 0).otherwise((index - cut) % size == 0)
    kept = joined.filter((F.col("_total") <= n) | start)
    numbered_tile = F.when(F.col("_total") <= n, F.col("_pos")).otherwise(tile + 1).cast("bigint")
    return kept.withColumn("tile", numbered_tile).select(*df.columns, "tile")


def lag_features(
    daily: DataFrame,
    keys: Sequence[str],
    day: str,
    value: str,
    lags: Sequence[int] = (1, 2, 3, 7),
    mean_rows: int = 7,
) -> DataFrame:
    """Feature rows of a daily series: lags, rolling mean, weekday, next-day target.

    Empty lags are filled with the mean of the group; rows that still miss a
    feature or the target are dropped.  Lags count rows, not calendar days.
    ``daily`` holds one row per key and day, so a group is as long as the calendar.
    """
    w = Window.partitionBy(*keys).orderBy(day)
    group = Window.partitionBy(*keys)
    names = [f"{value}_d{k}" for k in lags]
    mean_name = f"mean_{mean_rows}d_{value}"
    out = daily.select(
        "*",
        *[F.lag(value, k).over(w).alias(name) for k, name in zip(lags, names)],
        F.avg(value).over(w.rowsBetween(-(mean_rows - 1), 0)).alias(mean_name),
        F.lead(value, 1).over(w).alias(f"target_{value}"),
    )
    filled = [F.coalesce(F.col(n), F.avg(n).over(group)).alias(n) for n in (*names, mean_name)]
    out = out.select(*daily.columns, *filled, F.dayofweek(day).alias("dow"), f"target_{value}")
    return out.dropna(subset=[*names, mean_name, "dow", f"target_{value}"])


def impute_with_group_mean(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Fill nulls with the mean of the group.

    The means are aggregated and joined back, so no group is collected; the
    null-safe join keeps rows with a null key.
    """
    means = df.groupBy(*keys).agg(*[F.avg(c).alias(f"_mean_{c}") for c in columns]).alias("m")
    rows = df.alias("r")
    match = F.lit(True)
    for k in keys:
        match = match & F.col(f"r.{k}").eqNullSafe(F.col(f"m.{k}"))
    picked = [
        F.coalesce(F.col(f"r.{c}"), F.col(f"m._mean_{c}")).alias(c) if c in columns else F.col(f"r.{c}")
        for c in df.columns
    ]
    return rows.join(means, match, "left").select(*picked)


def resample(
    df: DataFrame, keys: Sequence[str], ts: str, seconds: int, aggregates: Sequence[Column]
) -> DataFrame:
    """Fixed-width buckets per key: bucket number, its start time and the given aggregates."""
    return (
        df.groupBy(*keys, time_bucket(F.col(ts), seconds).alias("bucket"))
        .agg(*aggregates)
        .withColumn("bucket_start", bucket_start(F.col("bucket"), seconds))
    )


def top_ranked(df: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """All rows that reach the highest value of their group (ties kept), by a join with the group maximum."""
    best = df.groupBy(*keys).agg(F.max(measure).alias(measure))
    return join_on(df.filter(F.col(measure).isNotNull()), best, [*keys, measure], "left_semi")


def dense_ids(df: DataFrame, order: Sequence[str], name: str = "id") -> DataFrame:
    """Consecutive ids from 0 in the given order, for a table with one row per value."""
    return with_positions(df, [], order, "_pos").withColumn(name, F.col("_pos") - 1).drop("_pos")


def number_batches(figures: DataFrame, group: Sequence[str], batch: str | Column, name: str) -> DataFrame:
    """Dense rank of the batch id per group, for a small table with one row per group and batch."""
    return figures.withColumn(name, F.dense_rank().over(Window.partitionBy(*group).orderBy(batch)))


def dense_batch_number(df: DataFrame, group: Sequence[str], batch: str, name: str) -> DataFrame:
    """The same for rows of a batch: the distinct batches are ranked and joined back, not the rows."""
    return join_on(df, number_batches(df.select(*group, batch).distinct(), group, batch, name), [*group, batch])
