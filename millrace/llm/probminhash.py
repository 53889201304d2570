"""Near copies by ProbMinHash: texts whose weighted five-word shingles have a probability Jaccard similarity of 0.8 or more.

The weight of a shingle is how often it stands in the text.  Every shingle sends arrivals to the ``SIZE`` components of a
signature: the order statistics of exponential times whose rate is the weight, dealt to the components in a random order that
the shingle's hash fixes; a component keeps the shingle that arrives first, and a shingle stops once its next arrival is later than
the last component still waits for.  Two signatures agree in a component with the probability Jaccard similarity

    J(a, b) = sum over common i of 1 / sum over all j of max(a_j / a_i, b_j / b_i),

which for unweighted sets is the Jaccard similarity.  ``BANDS`` bands of ``ROWS`` components find candidates (a link of 0.8 is
missed with a probability of 5e-5, short texts included: of drawn pairs with 4 against 5 shingles 4 of 100000 shared no band,
with 9 against 9 none of 30000, with 18 against 18 one of 20000), and the exact similarity of the whole texts decides.

Large groups: texts that are equal to the letter are one node.  In a band's bucket, first every node is compared with one
pivot, the node that shares the most buckets, so a group of m near copies mostly takes m comparisons.  Only in buckets that
still hold several components are nodes of different components compared, in pairs of bounded blocks inside tasks, which give
no more links than connect them.  Every pair that shares a band is compared or connected already, and pairs are never listed.

Defined results: null and empty texts link with nothing; very long texts are compared whole; texts of one to four words are a single shingle;
texts without a word are copies only of equal texts; repeated rows are copies of each other; a similarity of exactly 0.8 is a link; rows
without an id have no class; an empty table gives an empty result; other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.arrays import distinct_shingles, give_back, mixed, ngrams_of, row_numbers, text_slices, words_of
from millrace.llm.blocks import Forest, block_pairs, gathered, groups
from millrace.llm.components import components
from millrace.session import durable, release, setting, shuffles_removed

SHINGLE = 5
SIZE = 127
BANDS, ROWS = 25, 5
#: Nodes of a block; a bucket of more nodes is compared block by block.
BLOCK = 512
#: Shingles that a task keeps of the texts of a block.
KEPT = 1 << 19
#: Bytes of text whose signatures are made at a time.
SLICE = 1 << 18
STEP = np.uint64(0x9E3779B97F4A7C15)


def weighted_shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash and count of the distinct shingles of all rows, by row."""
    words, first = words_of(data, offsets)
    grams, at = ngrams_of(words, first, SHINGLE)
    rows, counts = row_numbers(at), np.diff(first)
    for k in range(1, SHINGLE):
        short = np.flatnonzero(counts == k)
        if len(short):
            whole, begins = ngrams_of(words, first, k)
            rows, grams = np.concatenate([rows, short]), np.concatenate([grams, whole[begins[short]]])
    order = np.lexsort((grams, rows))
    rows, grams = rows[order], grams[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (grams[1:] != grams[:-1])
    places = np.flatnonzero(new)
    return rows[places], grams[places], np.diff(np.append(places, len(rows)))


def signatures(rows: np.ndarray, grams: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    """The signature of each of n rows: the shingle that arrives first in each component; 0 for rows without shingles."""
    times, firsts = np.full(n * SIZE, np.inf), np.zeros(n * SIZE, np.uint64)
    clock, live = np.zeros(len(grams)), np.arange(len(grams))
    # A random permutation per shingle, drawn as far as it is used: row `slot` of `left` holds what the first j draws left over.
    chosen, left, slot = None, None, None
    for j in range(SIZE):
        draw = mixed(grams[live] + np.uint64(int(STEP) * (j + 1) % (1 << 64)))
        uniform = ((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        clock[live] -= np.log(uniform) / (weights[live] * (SIZE - j))
        if j:
            stay = clock[live] < times.reshape(n, SIZE).max(axis=1)[rows[live]]
            live, draw = live[stay], draw[stay]
            if len(live) == 0:
                break
            if left is None:
                left, slot = np.tile(np.arange(SIZE, dtype=np.uint8), (len(live), 1)), np.arange(len(live))
                left[slot, chosen[stay]] = 0
            else:
                slot = slot[stay]
        pick = j + (mixed(draw + STEP) % np.uint64(SIZE - j)).astype(np.int64)
        if j:
            chosen = left[slot, pick].astype(np.int64)
            left[slot, pick] = left[slot, j]
        else:
            chosen = pick
        target = rows[live] * SIZE + chosen
        early = clock[live] < times[target]
        target, source = target[early], live[early]
        order = np.argsort(-clock[source], kind="stable")  # of several arrivals the earliest is written last
        times[target[order]] = clock[source[order]]
        firsts[target[order]] = grams[source[order]]
    return firsts.reshape(n, SIZE)


def band_values(signature: np.ndarray) -> np.ndarray:
    """One 64-bit value per row and band."""
    out = np.empty((len(signature), BANDS), np.uint64)
    for b in range(BANDS):
        value = np.full(len(signature), b + 1, np.uint64)
        for r in range(ROWS):
            value = mixed(value * STEP + signature[:, b * ROWS + r])
        out[:, b] = value
    return out.view(np.int64)


def similarity(a: np.ndarray, a_counts: np.ndarray, b: np.ndarray, b_counts: np.ndarray) -> float:
    """The exact probability Jaccard similarity of two sorted sets of shingles with counts."""
    both, in_a, in_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if len(both) == 0:
        return 0.0
    only_a, only_b = a_counts.sum() - a_counts[in_a].sum(), b_counts.sum() - b_counts[in_b].sum()
    x, y = a_counts[in_a].astype(np.float64), b_counts[in_b].astype(np.float64)
    # For a common shingle of ratio r, others count with their weight in a if their ratio is at most r, else with that in b over r.
    ratio = y / x
    order = np.argsort(ratio)
    ratio, x, y = ratio[order], x[order], y[order]
    last = np.searchsorted(ratio, ratio, "right")
    below, above = np.cumsum(x)[last - 1], np.append(np.cumsum(y[::-1])[::-1], 0.0)[last]
    # Rounded, so that a similarity of exactly the threshold does not depend on the order of the sum.
    return round(float((x / (only_a + below + (only_b + above) / ratio)).sum()), 12)


def small_batches(spark: SparkSession, rows: int):
    """Arrow batches of few rows, for rows that carry whole texts."""
    return setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def banded(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(node, copy, bands): the id, a digest of the text (null for null and empty texts) and the band values."""

    def values(batches):
        for batch in batches:
            lists = []
            for _, _, data, offsets in text_slices(batch.column(2), SLICE):
                n = len(offsets) - 1
                rows, grams, counts = weighted_shingles(data, offsets)
                bands = band_values(signatures(rows, grams, counts, n))
                full = np.bincount(rows, minlength=n) > 0
                ends = np.cumsum([0, *(full * BANDS)])
                lists.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(bands[full].reshape(-1))))
            made = pa.concat_arrays(lists) if lists else pa.array([], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), made], names=["node", "copy", "bands"])
        give_back()

    rows = docs.select(
        F.col(id_col).cast("long").alias("node"), F.when(F.length(text_col) > 0, F.md5(text_col)).alias("copy"), F.lower(text_col).alias("text")
    )
    return rows.mapInArrow(values, "node long, copy string, bands array<long>")


def verified(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str, threshold: float) -> DataFrame:
    """(a, b, similarity) of the pairs whose whole texts reach the threshold."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.lower(text_col).alias("text"))

    def compared(batches):
        last = (None, None)
        for batch in batches:
            out = []
            for a, b, x, y in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if last[0] != (a, x):
                    last = ((a, x), shingles_of(x))
                s = similarity(*last[1], *shingles_of(y))
                if s >= threshold:
                    out.append((a, b, s))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.float64()))], names=["a", "b", "similarity"]
            )
        give_back()

    spark = docs.sparkSession
    with small_batches(spark, 100):
        both = (
            pairs.join(texts.withColumnRenamed("id", "a").withColumnRenamed("text", "x"), "a")
            .join(texts.withColumnRenamed("id", "b").withColumnRenamed("text", "y"), "b")
            .select("a", "b", "x", "y")
        )
        return durable(both.mapInArrow(compared, "a long, b long, similarity double"))


class Recent:
    """The shingles of the texts asked for last, as many as fit in ``KEPT`` numbers, and of one more."""

    def __init__(self):
        self.known, self.size = {}, 0

    def of(self, row: int, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = self.known.pop(row, None)
        if found is None:
            found = shingles_of(texts[row].as_py())
            self.size += len(found[0])
            while self.size > KEPT and self.known:
                self.size -= len(self.known.pop(next(iter(self.known)))[0])
        self.known[row] = found
        return found


def shingles_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(text.encode(), np.uint8)
    words, _ = words_of(data, np.array([0, len(data)]))
    return distinct_shingles(words, SHINGLE)


def links(entries: DataFrame, docs: DataFrame, id_col: str, text_col: str, threshold: float) -> DataFrame:
    """Links (a, b, similarity) that join all nodes which the buckets (key, band, node) and the exact similarity join."""
    entries = durable(entries.join(entries.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "key"))
    # The node that shares the most buckets is the pivot of each of its buckets: in a group of near copies, the text they come from.
    score = entries.groupBy("node").agg(F.sum("n").alias("score"))
    scored = entries.select("key", "node").join(score, "node")
    pivots = scored.groupBy("key").agg(F.max_by("node", F.struct("score", -F.col("node"))).alias("pivot"))
    star = entries.join(pivots, "key").filter("node <> pivot").select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()
    found = verified(star, docs, id_col, text_col, threshold)
    joined = entries.join(components(found), "node", "left").select("key", "band", "node", F.coalesce("component", "node").alias("component"))
    # What is left: buckets that hold several components.
    open_ = joined.groupBy("key").agg(F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high")
    return found.union(compared_in_blocks(durable(joined.join(open_.select("key"), "key")), durable(open_.select("key", "n")), docs, id_col, text_col, threshold))


def compared_in_blocks(entries: DataFrame, sizes: DataFrame, docs: DataFrame, id_col: str, text_col: str, threshold: float) -> DataFrame:
    """Links between nodes of different components in one bucket, as few as connect what the exact similarity connects.

    A pair is compared in the first band it shares, unless it is connected by then; the share of equal components only orders the pairs.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("node"), F.lower(text_col).alias("text"))

    def compared(batches):
        for group in groups(batches, 3):
            band, side, node, component, texts = (group.column(i) for i in range(3, 8))
            node, component, side = node.to_numpy(), component.to_numpy(), side.to_numpy()
            parts = []
            for _, _, data, offsets in text_slices(texts, SLICE):
                parts.append(signatures(*weighted_shingles(data, offsets), len(offsets) - 1).astype(np.uint32))
            signature, forest, out, known = np.concatenate(parts), Forest(), [], Recent()
            for n, c in zip(node.tolist(), component.tolist()):
                forest.join(n, c)
            across = group.column(1)[0].as_py() < group.column(2)[0].as_py()
            pairs = []
            for i in range(len(node)):
                other = component != component[i]
                other &= side != side[i] if across else np.arange(len(node)) > i
                if across and side[i] == 1:
                    continue
                at = np.flatnonzero(other)
                if len(at):
                    equal = signature[at] == signature[i]
                    bands = equal[:, : BANDS * ROWS].reshape(-1, BANDS, ROWS).all(axis=2)
                    first = bands.argmax(axis=1) == band[0].as_py()
                    first &= bands.any(axis=1)
                    found = at[first]
                    pairs.append(np.stack([equal[first].sum(axis=1).astype(np.int32), np.full(len(found), i, np.int32), found.astype(np.int32)]))
            pairs = np.concatenate(pairs, axis=1) if pairs else np.zeros((3, 0), np.int32)
            for at in np.argsort(-pairs[0], kind="stable"):  # the most alike first, so most others are connected by then
                i, j = int(pairs[1, at]), int(pairs[2, at])
                a, b = int(node[i]), int(node[j])
                if forest.root(a) != forest.root(b):
                    s = similarity(*known.of(i, texts), *known.of(j, texts))
                    if s >= threshold:
                        forest.join(a, b)
                        out.append((min(a, b), max(a, b), s))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.float64()))], names=["a", "b", "similarity"]
            )
        give_back()

    dealt = block_pairs(entries, "key", "node", sizes, BLOCK).join(texts, "node")
    rows = gathered(dealt.select("key", "left", "right", "band", "side", "node", "component", "text"), "key")
    with small_batches(docs.sparkSession, 500):
        return durable(rows.mapInArrow(compared, "a long, b long, similarity double"))


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(id, copy_of, class_id) of every row, and the links between the representatives of equal texts.

    copy_of is the smallest id with the same text, class_id the smallest id reachable by links; a null id has neither.
    """
    spark = docs.sparkSession
    with shuffles_removed(spark):  # texts are shuffled twice; the files of each step go before the next
        rows = durable(banded(docs, id_col, text_col))
        nodes = rows.filter("node IS NOT NULL AND copy IS NOT NULL").groupBy("copy").agg(F.min("node").alias("first"), F.any_value("bands").alias("bands"))
        nodes = durable(nodes)
        entries = nodes.select(F.col("first").alias("node"), F.posexplode("bands").alias("band", "key")).distinct()
        found = durable(links(entries, docs, id_col, text_col, threshold))
        release(spark)
        labels = components(found)
    member = nodes.select("copy", "first").join(labels.withColumnRenamed("node", "first"), "first", "left")
    out = rows.select("node", "copy").join(member, "copy", "left")
    return (
        out.select(
            F.col("node").alias(id_col), F.when(F.col("node").isNotNull(), F.coalesce("first", "node")).alias("copy_of"),
            F.when(F.col("node").isNotNull(), F.coalesce("component", "first", "node")).alias("class_id"),
        ),
        found,
    )
