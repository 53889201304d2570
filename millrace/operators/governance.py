"""Column masks, tag policies, anonymised views and usage audits."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Mask = Callable[[Column], Column]


def last_four(col: Column, prefix: str = "***-**-") -> Column:
    return F.concat(F.lit(prefix), F.right(col, F.lit(4)))


def fixed_text(text: str) -> Mask:
    return lambda col: F.when(col.isNotNull(), F.lit(text))


def role_mask(col: Column, roles: Sequence[str], cases: Sequence[tuple[str, Mask]], default: Mask) -> Column:
    """The mask of the first listed role the caller holds, else the default.

    The roles are those of the caller at planning time, so the plan holds only
    the chosen expression.
    """
    for role, mask in cases:
        if role in roles:
            return mask(col)
    return default(col)


def mask_columns(df: DataFrame, masks: Mapping[str, Mask]) -> DataFrame:
    return df.select(*[masks[c](F.col(c)).alias(c) if c in masks else F.col(c) for c in df.columns])


def tag_columns(df: DataFrame, tags: Mapping[str, Sequence[str]]) -> DataFrame:
    """Attach tags to columns; they travel with the schema and are stored with parquet tables."""
    cells = []
    for field in df.schema.fields:
        metadata = dict(field.metadata or {})
        if field.name in tags:
            metadata["tags"] = sorted({*metadata.get("tags", []), *tags[field.name]})
        cells.append(F.col(field.name).alias(field.name, metadata=metadata))
    return df.select(*cells)


def mask_tagged(df: DataFrame, tags: Sequence[str], mask: Mask, caller: str, masked_callers: Sequence[str]) -> DataFrame:
    """Mask all columns that carry one of the tags when the caller is on the list."""
    if caller not in masked_callers:
        return df
    hit = [f.name for f in df.schema.fields if set((f.metadata or {}).get("tags", [])) & set(tags)]
    return mask_columns(df, {c: mask for c in hit})


def anonymous_id(key: Column, prefix: str = "EMP_", width: int = 6) -> Column:
    """Prefix and left-padded key; readable as a pseudonym, still reversible."""
    return F.concat(F.lit(prefix), F.lpad(key.cast("string"), width, "0"))


def classify_table(spark, table: str, properties: Mapping[str, str]) -> None:
    """Sensitivity class and similar notes as table properties."""
    pairs = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({pairs})")


def access_audit(
    accesses: DataFrame, group: Sequence[str], name: str, ts: str, as_of: Column, days: int = 90
) -> DataFrame:
    """Per reader: last access, number of accesses and the names used, within the given days."""
    recent = accesses.filter(F.col(ts) >= as_of - F.make_dt_interval(F.lit(days)))
    return recent.groupBy(*group).agg(
        F.max(ts).alias("last_accessed"),
        F.count(F.lit(1)).alias("reference_count"),
        F.concat_ws(",", F.sort_array(F.collect_set(name))).alias("names_used"),
    )


def mentions(texts: DataFrame, column: str, needle: str, preview: int = 500) -> DataFrame:
    """Rows whose text mentions a name, in any case, with a short preview of the text."""
    hit = F.lower(column).contains(needle.lower())
    return texts.filter(hit).withColumn("preview", F.left(F.col(column), F.lit(preview)))
