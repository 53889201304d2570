"""Comparing the members of a bucket with one another, however large the bucket: pairs of bounded blocks, one at a time in a task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def block_pairs(rows: DataFrame, key: str, member: str | Column, sizes: DataFrame, block: int) -> DataFrame:
    """``rows`` once for every pair of blocks their row belongs to, with columns left and right (block numbers) and side.

    ``sizes`` has the number of rows, n, of every key.  A member's block is a hash of the member, so it is the same in each pair.
    """
    dealt = rows.join(sizes.select(key, F.ceil(F.col("n") / block).cast("int").alias("_count")), key)
    return block_number(dealt, member, F.col("_count"), block).drop("_count")


def block_number(rows: DataFrame, member: str | Column, blocks: Column, block: int) -> DataFrame:
    """The same where the number of blocks of a row's key is known."""
    member = F.col(member) if isinstance(member, str) else member
    dealt = rows.withColumn("_blocks", blocks)
    own = F.pmod(F.xxhash64(member, F.lit(block)), F.col("_blocks")).cast("int")
    return (
        dealt.withColumn("_own", own)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        .withColumn("left", F.least("_own", "_other")).withColumn("right", F.greatest("_own", "_other"))
        .withColumn("side", (F.col("_own") > F.col("_other")).cast("int"))
        .drop("_blocks", "_own", "_other")
    )


def gathered(rows: DataFrame, key: str) -> DataFrame:
    """Rows of one key and pair of blocks next to each other."""
    return rows.repartition(key, "left", "right").sortWithinPartitions(key, "left", "right")


def groups(batches, columns: int) -> Iterator[pa.RecordBatch]:
    """The rows of each key and pair of blocks, from batches that are sorted by their first ``columns`` columns."""
    open_, last = [], None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        keys = list(zip(*(batch.column(i).to_pylist() for i in range(columns))))
        start = 0
        for i in range(len(keys)):
            if keys[i] != last:
                if i > start:
                    open_.append(batch.slice(start, i - start))
                if open_:
                    yield pa.Table.from_batches(open_).combine_chunks().to_batches()[0]
                open_, start, last = [], i, keys[i]
        open_.append(batch.slice(start))
    if open_:
        yield pa.Table.from_batches(open_).combine_chunks().to_batches()[0]


def whole_groups(batches, columns: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches that hold whole groups only, and the first row of each group (one more entry than groups)."""
    rest = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        if rest is not None:
            batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
        starts = group_starts(batch, columns)
        if starts[-1]:
            yield batch.slice(0, starts[-1]), starts
        rest = batch.slice(starts[-1])
    if rest is not None and rest.num_rows:
        yield rest, np.array([0, rest.num_rows])


def group_starts(batch: pa.RecordBatch, columns: int) -> np.ndarray:
    new = np.zeros(batch.num_rows, bool)
    new[0] = True
    for i in range(columns):
        values = batch.column(i).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


class Forest:
    """Union of nodes; the smallest node stands for its tree."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (up := self.parent.get(x, x)) != x:
            self.parent[x] = self.parent.get(up, up)
            x = up
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True
