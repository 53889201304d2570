"""Text, JSON and header expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_field(text: Column, field: str, kind: str = "string") -> Column:
    """One top-level field of JSON text, also with odd names such as ``$schema``; bad JSON gives null."""
    quoted = field.replace("'", "\\'")
    return F.try_variant_get(F.try_parse_json(text), f"$['{quoted}']", kind)


def line_key(line: Column) -> Column:
    return F.substring_index(line, ":", 1)


def line_value(line: Column) -> Column:
    """Everything after the first colon, trimmed; the whole line when there is none."""
    return F.trim(F.substring(line, F.instr(line, ":") + 1, F.length(line)))


def degrees_of(text: Column) -> Column:
    """Leading number before the ``d`` of a coordinate such as ``-30.147d {...}``."""
    return F.regexp_extract(text, r"([-\d.]+)d", 1).try_cast("double")


def minutes_of(text: Column) -> Column:
    """Minutes of a duration such as ``1080.00 [sec]   (=18.0 [min])``."""
    return F.regexp_extract(text, r"\(=\s*([\d.]+) \[min\]\)", 1).try_cast("double")


def has_header(headers: Column, key: str) -> Column:
    return F.exists(headers, lambda h: h["key"] == key)


def header_value(headers: Column, key: str) -> Column:
    """Text of the first header with that key, null when absent."""
    return F.get(F.filter(headers, lambda h: h["key"] == key), F.lit(0))["value"].cast("string")


def email_of(name: Column, domain: str = "example.com") -> Column:
    return F.concat(F.lower(F.regexp_replace(name, " ", ".")), F.lit("@" + domain))


# The characters the pattern \\s stands for.
SPACES = " \t\n\x0b\f\r"


def words(text: Column) -> Column:
    """White-space separated words of the whole text; blank text has none."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"\s+"))
