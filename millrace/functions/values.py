"""Casts, null handling, rounding and hashing as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def settle(col: Column, digits: int) -> Column:
    """Round a sum or average of doubles to a value that does not depend on the order of addition.

    The inner rounding removes the noise of float addition, so a value that lies
    exactly between two results always goes the same way.
    """
    return F.round(F.round(col, 7), digits)


def safe_double(col: Column) -> Column:
    """Text or number to double; bad text, NaN and infinities become null."""
    number = col.cast("string").try_cast("double")
    return F.when(~F.isnan(number) & (F.abs(number) != F.lit(float("inf"))), number)


def safe_int(col: Column) -> Column:
    return col.try_cast("int")


def safe_bool(col: Column) -> Column:
    return col.try_cast("boolean")


def safe_epoch(col: Column) -> Column:
    """Epoch seconds as number or text to timestamp; bad values become null."""
    return F.timestamp_seconds(safe_double(col))


def safe_iso(col: Column) -> Column:
    """ISO-8601 text to timestamp (zone-less text is UTC); bad text becomes null."""
    return F.try_to_timestamp(col)


def to_micros(ts: Column) -> Column:
    return F.unix_micros(ts)


def millis_to_timestamp(ms: Column) -> Column:
    return F.timestamp_millis(ms.cast("bigint"))


def span_seconds(first: Column, last: Column) -> Column:
    """Whole seconds from ``first`` to ``last``."""
    return F.timestamp_diff("SECOND", first, last)


def latency_millis(source_ts: Column, sink_ts: Column) -> Column:
    return F.unix_millis(sink_ts) - F.unix_millis(source_ts)


def first_present(*cols: Column) -> Column:
    return F.coalesce(*cols)


def pick_by_hash(choices: Sequence[str], *keys: Column) -> Column:
    """One of ``choices``, fixed by the hash of the keys (no randomness, no UDF)."""
    index = F.pmod(F.hash(*keys), F.lit(len(choices))) + 1
    return F.element_at(F.array(*[F.lit(c) for c in choices]), index)


def md5_bucket(col: Column, buckets: int) -> Column:
    """Bucket number from the first 7 hex digits of the md5 of a value; the same in any SQL engine."""
    digits = F.substring(F.md5(col.cast("string")), 1, 7)
    return F.pmod(F.conv(digits, 16, 10).cast("bigint"), F.lit(buckets))


def choose(pairs: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """Chained CASE: the value of the first true condition, else ``default``."""
    out = None
    for condition, value in pairs:
        out = F.when(condition, value) if out is None else out.when(condition, value)
    if out is None:
        return F.lit(default)
    return out if default is None else out.otherwise(default)


def value_band(col: Column, bounds: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the first bound the value lies below; the last label beyond all bounds."""
    if len(labels) != len(bounds) + 1:
        raise ValueError("one more label than bounds is needed")
    return choose([(col < bound, F.lit(label)) for bound, label in zip(bounds, labels)], F.lit(labels[-1]))
