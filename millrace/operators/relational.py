"""Filters, routing, joins and unions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.geo import LONGITUDE_BANDS, in_band
from millrace.functions.values import md5_bucket


def latest_day(df: DataFrame, ts: str) -> DataFrame:
    """Rows of the most recent day.

    The start of that day is a scalar subquery compared with the bare column, so
    the scan can skip files and row groups that end before it.
    """
    start = df.agg(F.to_date(F.max(ts)).cast(df.schema[ts].dataType)).scalar()
    return df.filter(F.col(ts) >= start)


def known_position(lat: Column, lon: Column) -> Column:
    """Both coordinates set and neither exactly zero."""
    return lat.isNotNull() & lon.isNotNull() & (lat != 0) & (lon != 0)


def optional_match(value: object | None, condition: Column) -> Column:
    """No restriction when the parameter is absent."""
    return F.lit(True) if value is None else condition


def contains_text(col: Column, needle: str) -> Column:
    return F.lower(col).contains(needle.lower())


def number_starts_with(col: Column, prefix: str) -> Column:
    return col.cast("string").startswith(prefix)


def drop_columns_without_values(df: DataFrame) -> DataFrame:
    """Drop columns that are null in every row, found in one pass."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns]).first()
    return df.select(*[c for c in df.columns if counts[c]])


def fraction_sample(df: DataFrame, key: str, per_mille: int) -> DataFrame:
    """Repeatable sample: rows whose key hashes into the first ``per_mille`` of 1000 buckets."""
    return df.filter(md5_bucket(F.col(key), 1000) < per_mille)


def every_nth(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """Systematic sample: rows n, 2n, 3n ... of each key in the given order."""
    from millrace.operators.windows import with_positions

    return with_positions(df, keys, order, "_pos").filter(F.col("_pos") % n == 0).drop("_pos")


def with_row_ids(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Unique, increasing, not consecutive ids without a shuffle."""
    return df.withColumn(name, F.monotonically_increasing_id())


def split_by_longitude(df: DataFrame, lon: str, bands: Mapping[str, list] | None = None) -> dict[str, DataFrame]:
    """One DataFrame per band; overlapping bands give a row to each of them."""
    return {name: df.filter(in_band(F.col(lon), spans)) for name, spans in (bands or LONGITUDE_BANDS).items()}


def tag_longitude_bands(df: DataFrame, lon: str, name: str = "band") -> DataFrame:
    """The same routing in one pass: a row per band the position lies in."""
    hits = [F.when(in_band(F.col(lon), spans), F.lit(band)) for band, spans in LONGITUDE_BANDS.items()]
    return df.withColumn(name, F.explode(F.array_compact(F.array(*hits))))


def lookup(facts: DataFrame, ref: DataFrame, on, how: str = "left") -> DataFrame:
    """Join with a reference table.

    No hint: Spark broadcasts a reference whose size, estimated or measured at
    run time, is below its threshold, and shuffles a larger one with hot keys split.
    """
    return facts.join(ref, on, how)


def without_match(df: DataFrame, other: DataFrame, on) -> DataFrame:
    """Rows with no partner; the partner side is only used for its keys."""
    return df.join(other, on, "left_anti")


def with_left_attribute(df: DataFrame, other: DataFrame, on: Sequence[str], required: str) -> DataFrame:
    """Left join that keeps rows whose joined attribute is set."""
    return df.join(other, list(on), "left").filter(F.col(required).isNotNull())


#: Rows of one key that one task of a split join takes.
ROWS_PER_PIECE = 1_000_000


def split_left_join(left: DataFrame, right: DataFrame, keys: Sequence[str], rows_per_piece: int = ROWS_PER_PIECE) -> DataFrame:
    """Left join whose right side may hold very many rows of one key, which Spark's own skew handling does not split there.

    A key with more rows than a piece is cut into pieces, and its left rows are copied once for each; a key without rows on the
    right keeps its left rows with nulls.  Keys are looked up, not guessed: their rows are counted with partial counts first.
    Null keys match nothing, as in any join.
    """
    counts = right.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / rows_per_piece).cast("int").alias("_pieces"))
    counts = counts.dropna(subset=list(keys))
    # At most one key per ``rows_per_piece`` rows of the right side.
    large = F.broadcast(counts.filter("_pieces > 1"))
    # By the row itself, so that a task that runs again deals its rows alike; only equal rows stay together.
    own = F.pmod(F.xxhash64(*right.columns), F.coalesce("_pieces", F.lit(1))).cast("int")
    pieces = right.join(large, list(keys), "left").withColumn("_piece", own).drop("_pieces")
    copied = left.join(counts, list(keys), "left").withColumn("_piece", F.explode(F.coalesce(F.sequence(F.lit(0), F.col("_pieces") - 1), F.array(F.lit(0)))))
    found = copied.filter("_pieces IS NOT NULL").drop("_pieces").join(pieces, [*keys, "_piece"]).drop("_piece")
    rest = [c for c in right.columns if c not in keys]
    missing = copied.filter("_pieces IS NULL").select(*[c for c in left.columns], *[F.lit(None).cast(right.schema[c].dataType).alias(c) for c in rest])
    return found.select(*left.columns, *rest).unionByName(missing)


def only_top_groups(df: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    """Rows of the ``k`` largest groups; ties are broken by the key.

    The group list has ``k`` rows; Spark sends it to all tasks if it is below its threshold.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    top = counts.orderBy(F.desc("_n"), *keys).limit(k).select(*keys)
    return df.join(top, list(keys), "left_semi")


def child_summary(parents: DataFrame, children: DataFrame, key: str, order: str, first: str) -> DataFrame:
    """Number of children and an attribute of the first child per parent; parents without children stay."""
    per_key = children.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_children"), F.min_by(first, order).alias(f"first_{first}")
    )
    out = parents.join(per_key, key, "left")
    return out.withColumn("n_children", F.coalesce("n_children", F.lit(0)))


def as_of(history: DataFrame, moment: Column | object, start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """Versions valid at a moment: start <= moment, and no end or moment < end."""
    at = moment if isinstance(moment, Column) else F.lit(moment)
    return history.filter((F.col(start) <= at) & (F.col(end).isNull() | (at < F.col(end))))


def union_rows(frames: Sequence[DataFrame], distinct: bool = False) -> DataFrame:
    out = reduce(DataFrame.union, frames)
    return out.distinct() if distinct else out


def labelled_counts(frames: Mapping[str, DataFrame], by: str, label: str = "table_name") -> DataFrame:
    """Per table one ALL row; the last table also one row per value of ``by``."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias(label), F.lit("ALL").alias(by), "n")
        for name, df in frames.items()
    ]
    name, last = list(frames.items())[-1]
    parts.append(last.groupBy(by).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias(label), by, "n"))
    return union_rows(parts)


def stats_row(spark, metrics: Mapping[str, DataFrame]) -> DataFrame:
    """One row of independent figures, each a scalar subquery over its own table; empty results become 0."""
    cells = [F.coalesce(df.scalar(), F.lit(0)).alias(name) for name, df in metrics.items()]
    return spark.range(1).select(*cells)


def newest(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The ``n`` newest rows; Spark keeps ``n`` rows per task and merges them."""
    return df.orderBy(*[F.desc(c) for c in order]).limit(n)


def high_water_extract(df: DataFrame, updated_at: str, key: str, since: Column | object) -> DataFrame:
    """Rows changed after the mark, ordered so that a reader can resume."""
    mark = since if isinstance(since, Column) else F.lit(since)
    text = F.date_format(updated_at, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return df.filter(F.col(updated_at) > mark).withColumn("watermark", text).orderBy(updated_at, key)


def next_mark(extract: DataFrame) -> DataFrame:
    """The new mark: fixed-width text, so the greatest text is the latest time."""
    return extract.agg(F.max("watermark").alias("watermark"))
