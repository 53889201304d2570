"""Incremental file ingest with a stored schema that may widen."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import path_exists

FAIL, ADD, RESCUE = "fail", "add", "rescue"

#: New files that are read for their schema at one start, the newest first.
SAMPLED_FILES = 1000
#: Elements that the schema lacks, in the rescue column of XML.
OTHERS = "_other_elements"

# Settings of the readers this module drives; anything else is passed through.
FORMATS = ("json", "csv", "xml", "parquet", "orc", "text")


class SchemaChanged(RuntimeError):
    """New files have columns the stored schema lacks, or values its types cannot hold."""


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """Every column as text, names from the header."""
    return spark.read.csv(path, header=True)


def read_csv_typed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, inferSchema=True)


def read_path(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A table addressed by its folder, as in SQL ``parquet.`/path` ``."""
    return spark.sql(f"SELECT * FROM {fmt}.`{path}`")


def merge_schemas(old: T.StructType, new: T.StructType) -> T.StructType:
    """Old fields in their order, then the new ones, all nullable; a changed type becomes one that holds both."""
    found, known = {f.name: f.dataType for f in new.fields}, {f.name for f in old.fields}
    fields = [T.StructField(f.name, wider(f.dataType, found.get(f.name, f.dataType)), True) for f in old.fields]
    return T.StructType([*fields, *[T.StructField(f.name, f.dataType, True) for f in new.fields if f.name not in known]])


WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def wider(old: T.DataType, new: T.DataType) -> T.DataType:
    """The old type if it holds the new one's values, else a number type, else text."""
    if old == new or isinstance(new, T.NullType) or isinstance(old, T.StringType) or isinstance(old, (T.StructType, T.ArrayType, T.MapType)):
        return old
    if isinstance(old, T.NullType):
        return new
    if isinstance(old, WHOLE) and isinstance(new, WHOLE):
        return max(old, new, key=lambda t: [k for k, c in enumerate(WHOLE) if isinstance(t, c)][0])
    if isinstance(old, (*WHOLE, T.FloatType, T.DoubleType)) and isinstance(new, (*WHOLE, T.FloatType, T.DoubleType)):
        return T.DoubleType()
    if isinstance(old, T.TimestampType) and isinstance(new, T.DateType):
        return old
    return T.StringType()


class SchemaStore:
    """One JSON text with the schema of a source, kept in its own folder."""

    def __init__(self, spark: SparkSession, location: str):
        self.spark, self.path = spark, f"{location.rstrip('/')}/schema"

    def load(self) -> T.StructType | None:
        if not path_exists(self.spark, f"{self.path}/_SUCCESS"):
            return None
        text = self.spark.read.text(self.path, wholetext=True).first()[0]
        return T.StructType.fromJson(json.loads(text))

    def save(self, schema: T.StructType) -> None:
        row = self.spark.createDataFrame([(schema.json(),)], "value string")
        row.coalesce(1).write.mode("overwrite").text(self.path)


class Ledger:
    """The files of a source whose schema has been looked at: path, time and length, in a folder beside the schema.

    A file that was written anew counts as a new one.  The table grows by one small file per start that finds new files.
    """

    SCHEMA = "path string, modificationTime timestamp, length long"

    def __init__(self, spark: SparkSession, location: str):
        self.spark, self.path = spark, f"{location.rstrip('/')}/files"

    def known(self) -> DataFrame:
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.SCHEMA)
        return self.spark.read.schema(self.SCHEMA).parquet(self.path)

    def pending(self, path: str) -> DataFrame:
        """Files of the source that are not in the ledger; they are listed, not read."""
        # Only the listed columns are asked for, so the reader does not open the files.
        listed = self.spark.read.format("binaryFile").load(path).select(*[f.split()[0] for f in self.SCHEMA.split(", ")])
        return listed.join(self.known(), listed.columns, "left_anti")

    def add(self, files: DataFrame) -> None:
        files.coalesce(1).write.mode("append").parquet(self.path)


def infer_schema(spark: SparkSession, paths: str | list[str], fmt: str, options: Mapping[str, str]) -> T.StructType:
    settings = dict(options)
    if fmt == "csv":
        settings.setdefault("inferSchema", "true")
        settings.setdefault("header", "true")
    return spark.read.format(fmt).options(**settings).load(paths).schema


def resolve_schema(
    spark: SparkSession, path: str, fmt: str, schema_location: str, mode: str = FAIL, options: Mapping[str, str] | None = None,
    rescue: str | None = None,
) -> T.StructType:
    """Schema to read with: inferred from the files no earlier start has seen, and stored.

    Only new files are read for it, the newest ``SAMPLED_FILES`` of them.  When they bring new columns or types, mode ``fail`` raises and
    ``add`` widens the stored schema; the stream is restarted with the same checkpoint.  With a ``rescue`` column types never change, and
    mode ``rescue`` adds no columns either: what does not fit is kept there, also from files that were not looked at.
    """
    if mode not in (FAIL, ADD, RESCUE):
        raise ValueError(f"unknown schema mode {mode!r}")
    if mode == RESCUE and rescue is None:
        raise ValueError("mode 'rescue' needs a column to rescue into")
    store, ledger = SchemaStore(spark, schema_location), Ledger(spark, schema_location)
    stored = store.load()
    new_files = ledger.pending(path).persist()
    try:
        # As many names as the sample has files come to the driver, since the reader takes names.
        sample = [r.path for r in new_files.orderBy(F.desc("modificationTime"), F.desc("path")).limit(SAMPLED_FILES).collect()]
        if not sample and stored is not None:
            return stored
        found = infer_schema(spark, sample or path, fmt, options or {})
        schema = _evolved(stored, found, mode, rescue)
        if schema != stored:
            store.save(schema)
        # Last, so that a start that broke off before is simply repeated.
        ledger.add(new_files)
        return schema
    finally:
        new_files.unpersist()


def _evolved(stored: T.StructType | None, found: T.StructType, mode: str, rescue: str | None) -> T.StructType:
    if stored is None:
        return merge_schemas(T.StructType([]), found)
    merged = merge_schemas(stored, found)
    if rescue is not None:
        merged = T.StructType([*stored.fields, *merged.fields[len(stored.fields) :]])
    new = [f.name for f in merged.fields if f.name not in stored.fieldNames()]
    changed = [f.name for f in stored.fields if merged[f.name].dataType != f.dataType]
    if mode == FAIL and (new or changed):
        raise SchemaChanged("; ".join(f"{what}: {', '.join(names)}" for what, names in (("new columns", new), ("changed types", changed)) if names))
    return stored if mode == RESCUE else merged


def ingest(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema_location: str | None = None,
    schema: T.StructType | str | None = None,
    mode: str = FAIL,
    options: Mapping[str, str] | None = None,
    files_per_batch: int | None = None,
    rescue: str | None = None,
) -> DataFrame:
    """Stream of the files of a folder, each file read once per checkpoint.

    Give either a schema, or a location where the inferred one is kept.  ``rescue`` names a further column for what does not fit:
    of JSON and XML, an object with the fields that the schema lacks or whose value its type cannot hold; of CSV, the line of a row
    with a value that cannot be read or another number of columns.  The values that can be read are in their columns; null where all fits.
    """
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}")
    if rescue is not None and fmt not in ("json", "csv", "xml"):
        raise ValueError(f"nothing to rescue from {fmt!r} files")
    settings = dict(options or {})
    if schema is None:
        if schema_location is None:
            raise ValueError("a schema or a schema location is needed")
        schema = resolve_schema(spark, path, fmt, schema_location, mode, settings, rescue)
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if rescue is not None and rescue.lower() in {name.lower() for name in schema.fieldNames()}:
        raise ValueError(f"column {rescue!r} is in the files; choose another one to rescue into")
    stream = spark.readStream
    if files_per_batch:
        stream = stream.option("maxFilesPerTrigger", str(files_per_batch))
    if fmt == "csv":
        settings.setdefault("header", "true")
    if rescue is None:
        return stream.format(fmt).schema(schema).options(**settings).load(path)
    if fmt == "json":
        return rescued_json(stream, path, schema, rescue, settings)
    return (rescued_csv if fmt == "csv" else rescued_xml)(stream, path, schema, rescue, settings)


def _unfitting(typed: Column, raw: Column, schema: T.StructType, prefix: str = "") -> list[Column]:
    """Maps of the fields of an object (``raw``: names to JSON text) that ``typed`` does not hold; nested names are joined by dots."""
    out = [F.transform_keys(F.map_filter(raw, lambda k, v: v.isNotNull() & ~k.isin(schema.fieldNames())), lambda k, v: F.concat(F.lit(prefix), k))]
    for f in schema.fields:
        text, value = F.element_at(raw, f.name), typed.getField(f.name)
        lost = text.isNotNull() & value.isNull()
        if isinstance(f.dataType, T.StructType):
            inner = F.from_json(text, T.MapType(T.StringType(), T.StringType()))
            lost = text.isNotNull() & inner.isNull()
            out += _unfitting(value, inner, f.dataType, f"{prefix}{f.name}.")
        out.append(F.when(lost, F.create_map(F.lit(prefix + f.name), text)))
    return out


def _joined(parts: list[Column]) -> Column:
    empty = F.create_map().cast("map<string,string>")
    return F.map_concat(*[F.coalesce(part, empty) for part in parts])


def rescued_json(stream, path: str, schema: T.StructType, rescue: str, options: Mapping[str, str]) -> DataFrame:
    """JSON objects, one a line or (``multiLine``) one object or array a file, with the unfitting fields beside the typed ones."""
    whole = str(options.get("multiLine", options.get("multiline", "false"))).lower() == "true"
    text = stream.format("text").option("wholetext", str(whole).lower()).load(path).filter(F.trim("value") != "")
    if whole:
        several = F.from_json("value", T.ArrayType(T.StringType()))
        # A file with one object is no array of objects.
        is_array = F.substring(F.trim(F.regexp_replace("value", r"^\s+", "")), 1, 1) == "["
        text = text.select(F.explode(F.when(is_array & several.isNotNull(), several).otherwise(F.array("value"))).alias("value"))
    reading = {k: v for k, v in options.items() if k.lower() != "multiline"}
    entries = F.from_json("value", T.MapType(T.StringType(), T.StringType()))
    parsed = text.select("value", F.from_json("value", schema, reading).alias("typed"), entries.alias("raw"))
    lost = _joined(_unfitting(F.col("typed"), F.col("raw"), schema))
    broken = F.create_map(F.lit("_corrupt_record"), F.col("value"))
    kept = F.when(F.col("raw").isNull(), broken).when(F.size(lost) > 0, lost)
    return parsed.select("typed.*", F.to_json(kept).alias(rescue))


def rescued_csv(stream, path: str, schema: T.StructType, rescue: str, options: Mapping[str, str]) -> DataFrame:
    """CSV rows, with the line of those that the reader could not read whole."""
    settings = {**options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": rescue, "enforceSchema": "true"}
    return stream.format("csv").schema(T.StructType([*schema.fields, T.StructField(rescue, T.StringType())])).options(**settings).load(path)


def _as_text(kind: T.DataType) -> T.DataType:
    """The type with text for every value in it."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _as_text(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_as_text(kind.elementType))
    return T.StringType()


def _value(text: Column, kind: T.DataType, formats: Mapping[str, str]) -> Column:
    """``text``, of the shape of ``kind``, with its values in their types; null where a value is none of its type."""
    if isinstance(kind, T.StructType):
        fields = [_value(text.getField(f.name), f.dataType, formats).alias(f.name) for f in kind.fields]
        return F.when(text.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        return F.transform(text, lambda x: _value(x, kind.elementType, formats))
    if isinstance(kind, T.TimestampType) and "timestampformat" in formats:
        return F.try_to_timestamp(text, F.lit(formats["timestampformat"]))
    if isinstance(kind, T.DateType) and "dateformat" in formats:
        return F.try_to_timestamp(text, F.lit(formats["dateformat"])).cast("date")
    return text.try_cast(kind)


def _lost(text: Column, kind: T.DataType, formats: Mapping[str, str]) -> Column:
    """Whether some value in ``text`` is none of its type."""
    if isinstance(kind, T.StructType):
        out = F.lit(False)
        for f in kind.fields:
            out = out | _lost(text.getField(f.name), f.dataType, formats)
        return out
    if isinstance(kind, T.ArrayType):
        return F.coalesce(F.exists(text, lambda x: _lost(x, kind.elementType, formats)), F.lit(False))
    return text.isNotNull() & (F.trim(text) != "") & _value(text, kind, formats).isNull()


def rescued_xml(stream, path: str, schema: T.StructType, rescue: str, options: Mapping[str, str]) -> DataFrame:
    """XML rows read as text and cast here, with an object of the columns that hold a value of another type.

    (The reader's own record of a bad row is the text of its whole file.)  Elements that the schema lacks are kept by their content.
    """
    read = _as_text(schema).add(T.StructField(OTHERS, T.ArrayType(T.StringType())))
    rows = stream.format("xml").schema(read).options(**options, wildcardColName=OTHERS).load(path)
    formats = {k.lower(): v for k, v in options.items()}
    parts = []
    for f in schema.fields:
        text = F.col(f.name) if isinstance(f.dataType, T.AtomicType) else F.to_json(f.name)
        parts.append(F.when(_lost(F.col(f.name), f.dataType, formats), F.create_map(F.lit(f.name), text)))
    parts.append(F.when(F.size(OTHERS) > 0, F.create_map(F.lit(OTHERS), F.to_json(OTHERS))))
    lost = _joined(parts)
    typed = [_value(F.col(f.name), f.dataType, formats).alias(f.name) for f in schema.fields]
    return rows.select(*typed, F.when(F.size(lost) > 0, F.to_json(lost)).alias(rescue))


def stream_table(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream of a parquet table: rows present at the first run, then only new files."""
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)
