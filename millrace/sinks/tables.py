"""Writing tables: overwrite, append, schema changes, keyed tables, partition overwrite."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.changes import newest_changes
from millrace.operators.windows import latest_per_key
from millrace.session import delete_path, path_exists

BUCKET, SEQ, DELETED = "_bucket", "_seq", "_deleted"


def overwrite_table(df: DataFrame, table: str, path: str | None = None) -> None:
    """Managed table, or a table at the given path."""
    writer = df.write.mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def append_table(df: DataFrame, table: str) -> None:
    """Rows of the same columns, matched by name; others are an error."""
    have = set(df.sparkSession.table(table).columns)
    if set(df.columns) != have:
        raise ValueError(f"columns differ from those of {table}: {sorted(have ^ set(df.columns))}")
    df.select(*df.sparkSession.table(table).columns).write.mode("append").insertInto(table)


def replace_table(df: DataFrame, table: str, path: str | None = None) -> None:
    """Overwrite also when the columns changed; the old table goes only once the new one is written (``path``: a new folder for it)."""
    spark, aside = df.sparkSession, f"{table}_new"
    spark.sql(f"DROP TABLE IF EXISTS {aside}")
    (df.write.option("path", path) if path else df.write).saveAsTable(aside)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"ALTER TABLE {aside} RENAME TO {table}")


def append_wider(df: DataFrame, path: str) -> None:
    """Append rows that may have new columns; nothing old is rewritten, the merge happens on read."""
    df.write.mode("append").parquet(path)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)


def load_if_empty(df: DataFrame, table: str, path: str | None = None) -> bool:
    """Load only when the table is missing or has no row; tells whether it loaded."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table) and spark.table(table).limit(1).count():
        return False
    overwrite_table(df, table, path)
    return True


def replace_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Overwrite exactly the partitions present in ``df``."""
    (
        # Unlike repartition, the hint lets Spark split a value that has very many rows.
        df.hint("rebalance", *by).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
    )


def write_clustered(df: DataFrame, path: str, by: Sequence[str], mode: str = "overwrite") -> None:
    """Files hold narrow ranges of the given columns, so filters on them skip files and row groups."""
    df.repartitionByRange(*by).sortWithinPartitions(*by).write.mode(mode).parquet(path)


def write_daily(df: DataFrame, path: str, ts: str, mode: str = "append") -> None:
    """Partition by the date of a time column.  The rebalance hint lets Spark split a busy day over as many tasks as its size asks for."""
    dated = df.withColumn("event_date", F.to_date(ts))
    dated.hint("rebalance", "event_date").write.mode(mode).partitionBy("event_date").parquet(path)


class KeyedTable:
    """A parquet table with one row per key, split by key hash into a fixed number of buckets.

    A merge reads and replaces only the buckets that receive changes.  The new
    buckets are written beside the table first; if the job dies while they are
    being moved in, the next merge finds them complete and repeats the move.
    Merging the same changes twice gives the same table.
    Deleted keys stay as hidden rows, so a late older change cannot bring one back.
    Choose the number of buckets so that one holds about a gigabyte; it is stored
    beside the table at its first merge, and holds from then on whatever is asked for.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = 64):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.buckets = self._stored_buckets() or buckets

    def _stored_buckets(self) -> int | None:
        layout = f"{self.path}_layout"
        return self.spark.read.json(layout, "buckets int").first()[0] if path_exists(self.spark, f"{layout}/_SUCCESS") else None

    def _store_buckets(self) -> None:
        if self._stored_buckets() is None:
            one = self.spark.range(1).select(F.lit(self.buckets).alias("buckets"))
            one.write.mode("overwrite").json(f"{self.path}_layout")

    def _bucketed(self, df: DataFrame) -> DataFrame:
        return df.withColumn(BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def exists(self) -> bool:
        return path_exists(self.spark, self.path)

    def _rows(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def read(self) -> DataFrame:
        return self._rows().filter(~F.col(DELETED)).drop(BUCKET, SEQ, DELETED)

    def recover(self) -> None:
        """Finish a merge that was interrupted after its buckets were written."""
        staged = f"{self.path}_staged"
        if path_exists(self.spark, f"{staged}/_SUCCESS"):
            replace_partitions(self.spark.read.parquet(staged), self.path, [BUCKET])
            delete_path(self.spark, staged)

    def merge(
        self, changes: DataFrame, sequence_by: Sequence[str], delete_when=None, except_columns: Sequence[str] = ()
    ) -> None:
        """Keep the row with the highest sequence per key, over the table and the changes."""
        self._store_buckets()
        self.recover()
        newest = newest_changes(changes, self.keys, sequence_by, delete_when)
        newest = newest.withColumn(SEQ, F.struct(*sequence_by)).drop(*except_columns)
        incoming = self._bucketed(newest).persist()
        try:
            merged = incoming
            if self.exists():
                # At most as many numbers as there are buckets.
                touched = [r[0] for r in incoming.select(BUCKET).distinct().collect()]
                kept = self._rows().filter(F.col(BUCKET).isin(touched))
                both = kept.unionByName(incoming, allowMissingColumns=True)
                merged = latest_per_key(both, self.keys, [SEQ])
            merged.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.path}_staged")
        finally:
            incoming.unpersist()
        self.recover()
