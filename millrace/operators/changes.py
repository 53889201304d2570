"""Change capture and table rewrites: SCD type 1 and 2, upsert, update, delete."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.windows import latest_per_key, over_groups


def _condition(cond: str | Column | None) -> Column:
    if cond is None:
        return F.lit(False)
    return F.coalesce(F.expr(cond) if isinstance(cond, str) else cond, F.lit(False))


def newest_changes(
    changes: DataFrame, keys: Sequence[str], sequence_by: Sequence[str], delete_when: str | Column | None = None
) -> DataFrame:
    """Newest change per key, deletes included and marked in ``_deleted``."""
    flagged = changes.withColumn("_deleted", _condition(delete_when))
    return latest_per_key(flagged, keys, sequence_by)


def apply_changes(
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by: Sequence[str],
    delete_when: str | Column | None = None,
    except_columns: Sequence[str] = (),
) -> DataFrame:
    """SCD type 1 state of a change log: the newest change per key, keys whose newest change is a delete removed."""
    current = newest_changes(changes, keys, sequence_by, delete_when)
    return current.filter(~F.col("_deleted")).drop("_deleted", *except_columns)


def change_history(
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by: Sequence[str],
    delete_when: str | Column | None = None,
    except_columns: Sequence[str] = (),
    block_rows: int | None = None,
) -> DataFrame:
    """SCD type 2: every version with its validity; a delete ends the version before it.

    Each row only needs the next change of its key, so the rows are cut into
    blocks that carry one row of the next block.
    """
    start = sequence_by[0]
    flagged = changes.withColumn("_deleted", _condition(delete_when))
    chained = over_groups(
        flagged, keys, sequence_by,
        lambda w: {"valid_from": F.col(start), "valid_to": F.lead(start, 1).over(w)},
        after=1, block_rows=block_rows,
    )
    return chained.filter(~F.col("_deleted")).drop("_deleted", *except_columns)


def require_same_schema(a: DataFrame, b: DataFrame) -> None:
    left, right = ({f.name: f.dataType for f in df.schema.fields} for df in (a, b))
    if left != right:
        raise ValueError(f"schemas differ: {sorted(left.items(), key=str)} and {sorted(right.items(), key=str)}")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the source replace target rows with the same key; the others stay."""
    require_same_schema(target, source)
    return source.unionByName(target.join(source, list(keys), "left_anti"))


def insert_absent(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key the target lacks: the increment to append."""
    return source.join(target, list(keys), "left_anti")


def update_where(df: DataFrame, cond: str | Column | None, values: Mapping[str, Column]) -> DataFrame:
    """New values for the rows that satisfy the condition (all rows without one); types stay."""
    hit = F.lit(True) if cond is None else _condition(cond)
    types = {f.name: f.dataType for f in df.schema.fields}
    cells = [
        F.when(hit, values[c].cast(types[c])).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
        for c in df.columns
    ]
    return df.select(*cells)


def delete_where(df: DataFrame, cond: str | Column) -> DataFrame:
    """Rows for which the condition is not true; null keeps the row."""
    return df.filter(~_condition(cond))


def add_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    return df.select("*", *[F.lit(None).cast(t).alias(c) for c, t in columns.items() if c not in df.columns])
