"""Nearest vectors by cosine similarity."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from millrace.session import durable

#: Vectors that the centres of an index are fitted on, the most centres, and the rows of a cell that there is one for.
SAMPLE, MAX_CELLS, CELL_ROWS = 8192, 1024, 2000
#: Vectors and queries that one matrix product takes.
PIECE_ROWS, QUERY_ROWS = 8192, 1024


def norm(vec: Column) -> Column:
    return F.sqrt(F.aggregate(vec, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def cosine(a: Column, b: Column) -> Column:
    dot = F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, x: acc + x
    )
    return dot / (norm(a) * norm(b))


def centroids(df: DataFrame, group: str, vector: str) -> DataFrame:
    """Mean vector per group, by averaging each position."""
    cells = df.select(group, F.posexplode(vector).alias("pos", "x"))
    means = cells.groupBy(group, "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    ordered = F.sort_array(F.collect_list(F.struct("pos", "x")))
    return means.groupBy(group).agg(F.transform(ordered, lambda p: p["x"]).alias(vector))


def usable(vector: Column) -> Column:
    """True for vectors that have a direction; a null, empty or zero one, or one with a part that is no finite number, has none."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.unique(column.value_lengths().to_numpy(zero_copy_only=False))
    if len(sizes) > 1:
        raise ValueError(f"vectors of different lengths: {sizes.tolist()}")
    rows = column.flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(len(column), -1)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _arrays(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(0, rows.size + 1, rows.shape[1], dtype="int32"), rows.ravel())


def _centres(sample: np.ndarray, cells: int, rounds: int = 8) -> np.ndarray:
    """Unit centres of a clustering by direction."""
    rng = np.random.default_rng(7)
    centres = sample[rng.permutation(len(sample))[:cells]]
    for _ in range(rounds):
        own = (sample @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        # A centre that nothing is nearest to stays where it is.
        centres = np.where(length > 0, sums / np.where(length > 0, length, 1), centres)
    return centres


class VectorIndex:
    """Vectors in cells around centres, cells in pieces of bounded size.

    The centres are fitted on about ``SAMPLE`` vectors, chosen by the hash of their keys; every vector is indexed.  A cell knows its
    widest angle, so the angle between a query and the centre bounds the similarity of everything in the cell.  Vectors without
    a direction are left out.
    """

    def __init__(self, vectors: DataFrame, key: str, vector: str, cells: int | None = None):
        self.key, spark = key, vectors.sparkSession
        rows = vectors.select(key, F.col(vector).alias("_vector")).filter(usable(F.col("_vector")))
        total = rows.count()
        share = min(1.0, SAMPLE / max(1, total))
        sampled = rows.filter(F.pmod(F.xxhash64(key), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).select("_vector").toArrow()
        n = cells or min(MAX_CELLS, max(1, total // CELL_ROWS))
        sample = _unit(sampled.column(0)) if sampled.num_rows else np.zeros((0, 1))
        self.centres = _centres(sample, n) if len(sample) else sample
        shared = spark.sparkContext.broadcast(self.centres)  # at most MAX_CELLS rows

        def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                unit = _unit(batch.column(1))
                near = unit @ shared.value.T
                cell = near.argmax(axis=1)
                angle = np.arccos(np.clip(near[np.arange(len(cell)), cell], -1, 1))
                yield pa.RecordBatch.from_arrays([batch.column(0), _arrays(unit), pa.array(cell.astype("int32")), pa.array(angle)], names=names)

        names = [key, "_unit", "_cell", "_angle"]
        kind = vectors.schema[key].dataType
        schema = T.StructType([T.StructField(key, kind), *T.StructType.fromDDL("_unit array<double>, _cell int, _angle double").fields])
        self.rows = durable(rows.mapInArrow(placed, schema))
        # One row per cell comes to the driver.
        stats = self.rows.groupBy("_cell").agg(F.max("_angle").alias("widest"), F.count(F.lit(1)).alias("n")).collect()
        self.widest, self.counts = np.zeros(len(self.centres)), np.zeros(len(self.centres), "int64")
        for r in stats:
            self.widest[r["_cell"]], self.counts[r["_cell"]] = r.widest, r.n
        self.pieces = -(-self.counts // PIECE_ROWS)
        self.spark = spark

    def _per_cell(self, numbers: np.ndarray, name: str) -> DataFrame:
        """(cell, number), one row per cell."""
        data = [(i, int(x)) for i, x in enumerate(numbers)]
        return F.broadcast(self.spark.createDataFrame(data, f"_cell int, {name} int"))

    def _asked(self, queries: DataFrame, query_key: str, query_vector: str, k: int, probes: int) -> DataFrame:
        """Every query with its unit vector, its cells to look at first, and the highest similarity that each cell can hold."""
        centres, widest, counts = self.centres, self.widest, self.counts
        shared = self.spark.sparkContext.broadcast((centres, widest, counts))

        def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            centres, widest, counts = shared.value
            for batch in batches:
                if not batch.num_rows:
                    continue
                unit = _unit(batch.column(1))
                angle = np.arccos(np.clip(unit @ centres.T, -1, 1))
                bound = np.cos(np.clip(angle - widest, 0, np.pi))
                bound[:, counts == 0] = -2
                order = np.argsort(angle, axis=1)
                # As many of the nearest cells as were asked for and hold k vectors.
                held = np.cumsum(counts[order], axis=1)
                need = np.maximum(probes, 1 + (held < k).sum(axis=1))
                first = [o[:n].astype("int32") for o, n in zip(order, need)]
                yield pa.RecordBatch.from_arrays([batch.column(0), _arrays(unit), pa.array(first, pa.list_(pa.int32())), _arrays(bound)], names=names)

        names = [query_key, "_query", "_first", "_bound"]
        schema = T.StructType([T.StructField(query_key, queries.schema[query_key].dataType), *T.StructType.fromDDL("_query array<double>, _first array<int>, _bound array<double>").fields])
        usable_queries = queries.select(query_key, F.col(query_vector).alias("_vector")).filter(usable(F.col("_vector")))
        return durable(usable_queries.mapInArrow(asked, schema))

    def _best(self, wanted: DataFrame, query_key: str, k: int) -> DataFrame:
        """The best ``k`` per query and piece of a cell, for queries (key, _query, _cell): a matrix product per piece and block of queries."""
        key = self.key
        blocks = F.broadcast(wanted.groupBy("_cell").agg(F.ceil(F.count(F.lit(1)) / QUERY_ROWS).cast("int").alias("_blocks")))  # one row per cell
        dealt = wanted.join(blocks, "_cell").join(self._per_cell(self.pieces, "_pieces"), "_cell")
        left = dealt.withColumn("_block", F.pmod(F.xxhash64(query_key), F.col("_blocks")).cast("int")).withColumn("_piece", F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1)))
        rows = self.rows.join(blocks, "_cell").join(self._per_cell(self.pieces, "_pieces"), "_cell")
        right = rows.withColumn("_piece", F.pmod(F.xxhash64(key), F.col("_pieces")).cast("int")).withColumn("_block", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))

        def compared(queries: pa.Table, vectors: pa.Table) -> pa.Table:
            ids, keys = queries.column(query_key).combine_chunks(), vectors.column(key).combine_chunks()
            if not len(ids) or not len(keys):
                return schema.empty_table()
            # Rounded, so that equal vectors are equally near in whatever block they stand.
            near = np.round(_unit(queries.column("_query")) @ _unit(vectors.column("_unit")).T, 12)
            rank = np.empty(len(keys), "int64")
            rank[pc.sort_indices(keys).to_numpy()] = np.arange(len(keys))
            take = min(k, len(keys))
            floor = np.partition(near, len(keys) - take, axis=1)[:, len(keys) - take]
            q, v = np.nonzero(near >= floor[:, None])
            order = np.lexsort((rank[v], -near[q, v], q))
            q, v = q[order], v[order]
            place = np.arange(len(q)) - np.searchsorted(q, q)
            q, v = q[place < take], v[place < take]
            return pa.table([ids.take(pa.array(q)), keys.take(pa.array(v)), pa.array(near[q, v])], schema=schema)

        result = T.StructType([wanted.schema[query_key], self.rows.schema[key], T.StructField("similarity", T.DoubleType())])
        schema = to_arrow_schema(result)
        by = ["_cell", "_piece", "_block"]
        pairs = left.select(*by, query_key, "_query").groupBy(*by).cogroup(right.select(*by, key, "_unit").groupBy(*by))
        return pairs.applyInArrow(compared, result)

    def nearest(self, queries: DataFrame, query_key: str, query_vector: str, k: int = 3, probes: int = 2, exact: bool = True) -> DataFrame:
        """(query, key, similarity, rank) of the ``k`` nearest vectors of every query; equal similarities are ordered by key.

        The nearest ``probes`` cells are searched first.  The k-th similarity found there tells which other cells can still hold a
        nearer vector; unless ``exact`` is false these are searched too, so nothing is missed.  Queries without a direction get no rows.
        """
        if query_key == self.key:
            raise ValueError("name the keys of queries and vectors differently")
        best = Window.partitionBy(query_key).orderBy(F.desc("similarity"), self.key)
        ranked = lambda df: df.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        if not len(self.centres):
            none = F.lit(None).cast(self.rows.schema[self.key].dataType).alias(self.key)
            return queries.select(query_key, none, F.lit(0.0).alias("similarity"), F.lit(1).alias("rank")).limit(0)
        asked = self._asked(queries, query_key, query_vector, k, probes)
        found = durable(ranked(self._best(asked.select(query_key, "_query", F.explode("_first").alias("_cell")), query_key, k)))
        if not exact:
            return found
        floor = found.filter(F.col("rank") == k).select(F.col(query_key).alias("_id"), F.col("similarity").alias("_floor"))
        cells = asked.join(floor, F.col(query_key) == F.col("_id"), "left").select(query_key, "_query", "_first", "_floor", F.posexplode("_bound").alias("_cell", "_most"))
        more = cells.filter((F.col("_most") >= F.coalesce(F.col("_floor") - 1e-9, F.lit(-1.5))) & ~F.array_contains("_first", F.col("_cell")))
        rest = self._best(more.select(query_key, "_query", "_cell"), query_key, k)
        return ranked(found.drop("rank").union(rest))


def cosine_top_k(
    vectors: DataFrame, key: str, vector: str, queries: DataFrame, query_key: str, query_vector: str, k: int = 3, probes: int = 2, exact: bool = True
) -> DataFrame:
    """The ``k`` nearest vectors of every query, by an index over the vectors."""
    return VectorIndex(vectors, key, vector).nearest(queries, query_key, query_vector, k, probes, exact)
