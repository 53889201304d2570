"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

A document contains an item if at least ``threshold`` (0.8) of the item's distinct five-word shingles stand in it, anywhere.

MinHash estimates Jaccard similarity, which is tiny between a short item and a long document however well the item is
contained.  So both sides are partitioned by size: items by their number of shingles, in classes that double, and, for each
class, every document into windows of one and a half times the class's largest size, each half that size after the last.  An
item that stands in one piece is in one window whole, and their sizes compare: a containment of 0.8 is a Jaccard similarity of
a quarter at least, so all ``HASHES`` minima differ with a probability of 1e-6.  Window minima come from the minima of blocks,
three a window, with array operations.

Candidates are joined in Spark on (class, function, minimum).  Tasks drop minima that no item has by a bit table of fixed size
before anything is shuffled; then the shingles of the candidate documents that some item has are joined to the items'
shingles and counted, which is the exact containment.

Defined results: an item of fewer than five words has no shingle and is contained nowhere; null and empty texts contain
nothing; very long texts are searched whole; repeated items are searched each; repeated rows of a document count once per id; a
containment of exactly the threshold is found; rows without an id are not searched (nothing could be said of them); empty tables give
an empty result; further columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrays import ROLL, give_back, mixed, ngrams_of, text_slices, words_of
from millrace.session import durable

SHINGLE = 5
HASHES = 48
#: Bits of the table of minima and of that of shingles: of fixed size, whatever the number of items.
TABLE_BITS = 22


def size_class(n: np.ndarray) -> np.ndarray:
    """The class of items of n shingles: sizes up to 2, 4, 8 and so on."""
    return np.maximum(1, np.ceil(np.log2(np.maximum(n, 1)))).astype(np.int64)


def hashed(grams: np.ndarray, function: int) -> np.ndarray:
    return mixed(grams ^ mixed(np.array([function + 1], np.uint64) * ROLL))


def place_of(values: np.ndarray, size: int, function: int) -> np.ndarray:
    """The bit of the table for a minimum of one class and function."""
    return (mixed(values + np.uint64(size * 1024 + function)) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def shingles(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, n, gram) of the distinct shingles of the texts."""

    def made(batches):
        for batch in batches:
            row_of, sizes, grams_of = [], [], []
            for row, _, data, offsets in text_slices(batch.column(1)):
                grams, first = ngrams_of(*words_of(data, offsets), SHINGLE)
                for i in range(len(offsets) - 1):
                    own = np.unique(grams[first[i] : first[i + 1]])
                    row_of.append(np.full(len(own), row + i))
                    sizes.append(np.full(len(own), len(own)))
                    grams_of.append(own)
            take = pa.array(np.concatenate([*row_of, np.zeros(0, np.int64)]).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), pa.array(np.concatenate([*sizes, np.zeros(0, np.int64)]).astype(np.int64)),
                 pa.array(np.concatenate([*grams_of, np.zeros(0, np.uint64)]).astype(np.uint64).view(np.int64))],
                names=["item", "n", "gram"],
            )

    kind = items.schema[id_col].dataType.simpleString()
    rows = items.select(F.col(id_col).alias("item"), F.lower(text_col).alias("text"))
    return rows.mapInArrow(made, f"item {kind}, n long, gram long")


def item_minima(grams: DataFrame) -> DataFrame:
    """(size, function, minimum, item) of the items, in Spark: one row per item and hash function."""

    def hashes(batches):
        for batch in batches:
            values = batch.column(2).to_numpy().view(np.uint64)
            size = size_class(batch.column(1).to_numpy())
            for f in range(HASHES):
                # Unsigned order in a signed column.
                minimum = (hashed(values, f) ^ np.uint64(1 << 63)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(size), pa.array(np.full(len(values), f)), pa.array(minimum)], names=["item", "size", "function", "minimum"]
                )

    kind = grams.schema["item"].dataType.simpleString()
    return grams.mapInArrow(hashes, f"item {kind}, size long, function long, minimum long").groupBy("item", "size", "function").agg(F.min("minimum").alias("minimum"))


def bit_table(values: DataFrame, places) -> np.ndarray:
    """A table with the bits of all values set: each task makes its own, and they are or-ed pairwise on the executors."""

    def made(batches):
        bits = np.zeros(1 << TABLE_BITS, bool)
        for batch in batches:
            bits[places(*(c.to_numpy() for c in batch.columns))] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(bits).tobytes()], pa.binary())], names=["bits"])

    def merge(batches):
        total = None
        for batch in batches:
            for bits in batch.column(0).to_pylist():
                own = np.frombuffer(bits, np.uint8)
                total = own if total is None else total | own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["bits"])

    tables = values.mapInArrow(made, "bits binary").coalesce(8).mapInArrow(merge, "bits binary").collect()
    total = np.zeros(1 << (TABLE_BITS - 3), np.uint8)
    for row in tables:
        total = total | np.frombuffer(bytes(row.bits), np.uint8)
    return np.unpackbits(total).astype(bool)


def window_minima(docs: DataFrame, id_col: str, text_col: str, classes: list[int], table: np.ndarray) -> DataFrame:
    """(id, size, function, minimum): the distinct window minima of each document that may be an item's."""

    def minima(batches):
        for batch in batches:
            for row, end, data, offsets in text_slices(batch.column(1)):
                grams, first = ngrams_of(*words_of(data, offsets), SHINGLE)
                counts = np.diff(first)
                if len(grams) == 0:
                    continue
                blocks = []
                for size in classes:
                    # Blocks of half a class's size; a window is a block and the next two of the same row.
                    per_row = -(-counts // (1 << (size - 1)))
                    owner = np.repeat(np.arange(end - row), per_row)
                    number = np.arange(len(owner)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
                    begins = first[:-1][owner] + (number << (size - 1))
                    follow = [np.append(owner[k:] == owner[:-k], np.zeros(min(k, len(owner)), bool))[: len(owner)] for k in (1, 2)]
                    # A window that ends early is part of the one before, unless it is the first of its row.
                    blocks.append((size, owner, begins, follow, follow[1] | (number == 0)))
                for f in range(HASHES):
                    values = hashed(grams, f)
                    for size, owner, begins, follow, whole in blocks:
                        block = np.minimum.reduceat(values, begins)
                        low = block.copy()
                        for k, same in zip((1, 2), follow):
                            at = np.flatnonzero(same)
                            low[at] = np.minimum(low[at], block[at + k])
                        hit = np.flatnonzero(whole & table[place_of(low, size, f)])
                        if len(hit):
                            n = len(hit)
                            yield pa.RecordBatch.from_arrays(
                                [batch.column(0).take(pa.array(owner[hit] + row)), pa.array(np.full(n, size)), pa.array(np.full(n, f)),
                                 pa.array((low[hit] ^ np.uint64(1 << 63)).view(np.int64))],
                                names=["doc", "size", "function", "minimum"],
                            )
        give_back()

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc"), F.lower(text_col).alias("text")).filter("doc IS NOT NULL")
    return rows.mapInArrow(minima, f"doc {kind}, size long, function long, minimum long").distinct()


def shared_shingles(docs: DataFrame, id_col: str, text_col: str, table: np.ndarray) -> DataFrame:
    """(doc, gram): the distinct shingles of each document that may be an item's."""

    def found(batches):
        for batch in batches:
            for row, _, data, offsets in text_slices(batch.column(1)):
                grams, first = ngrams_of(*words_of(data, offsets), SHINGLE)
                hit = np.flatnonzero(table[place_of(grams, 0, 0)])
                if len(hit):
                    owner = np.searchsorted(first, hit, "right") - 1 + row
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner)), pa.array(grams[hit].view(np.int64))], names=["doc", "gram"])
        give_back()

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc"), F.lower(text_col).alias("text"))
    return rows.mapInArrow(found, f"doc {kind}, gram long").distinct()


def contained(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
              threshold: float = 0.8) -> DataFrame:
    """(doc, item, containment) of the items that documents contain."""
    known = items.select(F.monotonically_increasing_id().alias("_row"), F.col(item_col).alias("_item"), F.col(item_text_col).alias("_text"))
    known = durable(known)
    grams = durable(shingles(known, "_row", "_text"))
    index = durable(item_minima(grams))
    classes = sorted(r.size for r in index.select("size").distinct().collect())  # at most 64 doublings
    minima = bit_table(index.select("size", "function", "minimum"), lambda size, f, m: np.concatenate(
        [place_of(m[(size == s) & (f == k)].view(np.uint64) ^ np.uint64(1 << 63), int(s), int(k)) for s in np.unique(size) for k in np.unique(f)] or [np.zeros(0, np.int64)]
    ))
    table = bit_table(grams.select("gram"), lambda g: place_of(g.view(np.uint64), 0, 0))
    candidates = window_minima(docs, id_col, text_col, classes, minima).join(index, ["size", "function", "minimum"]).select("doc", "item").distinct()
    candidates = durable(candidates)
    suspects = docs.select(id_col, text_col).join(candidates.select(F.col("doc").alias(id_col)).distinct(), id_col, "left_semi")
    counted = (
        shared_shingles(suspects, id_col, text_col, table).join(grams, "gram")
        .groupBy("doc", "item").agg(F.count("*").alias("found"), F.max("n").alias("n"))
        .withColumn("containment", F.col("found") / F.col("n")).filter(F.col("containment") >= threshold)
        .join(candidates, ["doc", "item"], "left_semi")
    )
    names = known.select(F.col("_row").alias("item"), F.col("_item"))
    return counted.join(names, "item").select("doc", F.col("_item").alias("item"), "containment")


def flagged(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **names) -> DataFrame:
    """(id, n_items, best): the contained items and the highest containment of every document that contains one."""
    found = contained(docs, items, id_col, **names)
    return found.groupBy(F.col("doc").alias(id_col)).agg(F.count("*").alias("n_items"), F.max("containment").alias("best"))
