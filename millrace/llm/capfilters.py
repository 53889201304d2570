"""Links of cosine similarity by spherical-cap filters from structured random product codes.

A filter is a direction; a vector passes it if their inner product is at least ``alpha``.  There are ``TABLES`` tables of filters;
those of a table are all combinations of one codeword for each half (or, for very many vectors, third) of the coordinates, which are
permuted and reflected anew for each table.  So there are millions of filters but only a few hundred inner products per vector and table:
codewords that no partner can lift over the threshold are dropped, and the rest are combined, which lists exactly the filters
a vector passes.  Vectors that share a filter are compared in double precision.

The number of filters grows with the number of vectors (``FILTERS`` times as many), and ``alpha`` with it: a vector passes about as many
filters in a large table as in a small one, and meets about as many vectors that it is not linked with.  ``alpha`` is set where, of drawn
pairs at exactly the wanted similarity, all share a filter.

Equal vectors are one node, with the number of its copies.  A filter's members are compared in pairs of bounded blocks by
matrix products inside tasks; a pair counts in the first filter it shares, which follows from the lists of earlier filters that the
members carry.  A block gives a count per node and a star per connected group, never pairs: a dense group of m nodes takes m**2 products for
each filter that it fills, and gives m rows per block pair.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and rows without an id, link with
nothing and are a component of their own; vectors of different length are never compared; very long vectors are compared whole; every row of
an id that stands in several rows counts as a vector; a similarity of exactly the threshold is a link, and is computed
alike wherever a pair meets; an empty table gives an empty result; further columns are not read, so their names cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.blocks import block_number, gathered, whole_groups
from millrace.llm.components import components
from millrace.session import durable

TABLES = 32
#: Filters per vector, codewords of a half at least and at most (beyond it the coordinates are cut in three).
FILTERS = 200
LEAST_WORDS, MOST_WORDS = 16, 4096
#: Drawn pairs that must all share a filter, and the best codewords of a pair that are tried for it.
PAIRS, TRIED = 2000, 6
BLOCK = 1024
#: Groups up to this size are compared pair by pair, larger ones as a matrix; with the same results.
SMALL = 32
#: Products that lie so near to the threshold are computed again in one fixed way.
DOUBT = 1e-9


@dataclass(frozen=True)
class Plan:
    """The filters for vectors of one length."""

    dim: int
    parts: int
    words: int
    alpha: float = 0.0

    @property
    def least(self) -> float:
        """What the products of the parts must add up to: the codewords of a filter are as long as it divided by the root of the parts."""
        return self.alpha * np.sqrt(self.parts)


def shape_of(dim: int, vectors: int) -> Plan:
    """Parts and codewords for so many vectors."""
    wanted = FILTERS * max(1, vectors) / TABLES
    parts = min(dim, 2 if wanted <= MOST_WORDS**2 else 3)
    return Plan(dim, parts, int(np.ceil(max(LEAST_WORDS, min(wanted ** (1 / parts), 1 << 14)))))


@lru_cache(maxsize=8)
def codes(dim: int, parts: int, words: int) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray, list[np.ndarray]]:
    """Permutation and signs of every table, where the parts begin, and the unit codewords of each part."""
    rng = np.random.default_rng((17, dim, parts, words))
    turns = [(rng.permutation(dim), rng.choice([-1.0, 1.0], dim)) for _ in range(TABLES)]
    sizes = [dim // parts + (k < dim % parts) for k in range(parts)]
    made = [rng.standard_normal((words, size)) for size in sizes]
    return turns, np.cumsum([0, *sizes]), [w / np.linalg.norm(w, axis=1, keepdims=True) for w in made]


def products(plan: Plan, x: np.ndarray, table: int) -> list[np.ndarray]:
    """Inner products of every row with the codewords of each part."""
    turns, edges, words = codes(plan.dim, plan.parts, plan.words)
    order, signs = turns[table]
    y = (x * signs)[:, order]
    return [y[:, edges[k] : edges[k + 1]] @ words[k].T for k in range(plan.parts)]


def decoded(plan: Plan, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, filter) of all filters that the unit vectors pass, by row and filter."""
    rows, found = [], []
    for table in range(TABLES):
        scores = products(plan, x, table)
        most = [s.max(axis=1) for s in scores]
        others = sum(most)
        at, code, total = np.arange(len(x)), np.full(len(x), table, np.int64), np.zeros(len(x))
        left = others.copy()
        for score, own in zip(scores, most):
            left = left - own
            # The codewords that can still take part, by row; then every one with every combination so far of its row.
            r, w = np.nonzero(score >= (plan.least - (others - own) - DOUBT)[:, None])
            begin, size = np.searchsorted(r, np.arange(len(x))), np.bincount(r, minlength=len(x))
            times = size[at]
            before = np.repeat(np.arange(len(at)), times)
            place = np.arange(len(before)) - np.repeat(np.cumsum(times) - times, times) + begin[at[before]]
            word = w[place]
            summed = total[before] + score[at[before], word]
            kept = summed >= plan.least - left[at[before]] - DOUBT * (left[at[before]] != 0)
            at, code, total = at[before][kept], code[before][kept] * plan.words + word[kept], summed[kept]
        rows.append(at)
        found.append(code)
    rows, found = np.concatenate(rows), np.concatenate(found)
    order = np.lexsort((found, rows))
    return rows[order], found[order]


def with_alpha(shape: Plan, threshold: float) -> Plan:
    """The highest alpha found at which every drawn pair of the threshold's similarity shares a filter."""
    rng = np.random.default_rng(shape.dim)
    a = rng.standard_normal((PAIRS, shape.dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((PAIRS, shape.dim))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.maximum(np.linalg.norm(b, axis=1, keepdims=True), 1e-12)
    b = threshold * a + np.sqrt(1 - threshold**2) * b
    best = np.full(PAIRS, -np.inf)
    tried = min(TRIED, shape.words)
    for table in range(TABLES):
        low, high = np.zeros((PAIRS, 1)), np.zeros((PAIRS, 1))
        for u, v in zip(products(shape, a, table), products(shape, b, table)):
            top = np.argpartition(-(u + v), tried - 1, axis=1)[:, :tried]
            u, v = np.take_along_axis(u, top, 1), np.take_along_axis(v, top, 1)
            low = (low[:, :, None] + u[:, None, :]).reshape(PAIRS, -1)
            high = (high[:, :, None] + v[:, None, :]).reshape(PAIRS, -1)
        best = np.maximum(best, np.minimum(low, high).max(axis=1))
    return Plan(shape.dim, shape.parts, shape.words, float(best.min() / np.sqrt(shape.parts)))


def plans_for(nodes: DataFrame, threshold: float) -> dict[int, Plan]:
    """The plan for every length of vectors (column vec); one row a length comes to the driver, the plans are made in tasks."""

    def planned(batches):
        for batch in batches:
            alphas = [with_alpha(shape_of(int(d), int(n)), threshold).alpha for d, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(alphas, pa.float64())], names=["dim", "n", "alpha"])

    lengths = nodes.groupBy(F.size("vec").alias("dim")).agg(F.count("*").alias("n")).repartition("dim")
    shapes = {r.dim: (shape_of(r.dim, r.n), r.alpha) for r in lengths.mapInArrow(planned, "dim int, n long, alpha double").collect()}
    return {dim: Plan(s.dim, s.parts, s.words, alpha) for dim, (s, alpha) in shapes.items()}


def usable(vector) -> "F.Column":
    """True for vectors that have a direction."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(rows: pa.Array) -> np.ndarray:
    """Vectors of one length as unit vectors in double precision."""
    x = rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def passed(nodes: DataFrame, plans: dict[int, Plan]) -> DataFrame:
    """(node, filters): the filters of every vector, in ascending order; the length is part of a filter's number."""

    def made(batches):
        for batch in batches:
            vectors = batch.column(1)
            sizes = vectors.value_lengths().to_numpy()
            found = [None] * batch.num_rows
            for dim in np.unique(sizes):
                own = plans[int(dim)]
                for at in np.array_split(np.flatnonzero(sizes == dim), -(-batch.num_rows // (500 if own.parts < 3 else 50))):
                    rows, filters = decoded(own, unit(vectors.take(pa.array(at))))
                    for row, some in zip(at, np.split(filters + (int(dim) << 44), np.searchsorted(rows, np.arange(1, len(at))))):
                        found[row] = some
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["node", "filters"])

    return nodes.select("node", "vec").mapInArrow(made, "node long, filters array<long>")


def products_of(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products row by row, added up in an order that depends on the length only."""
    return np.add.reduce(x * y, axis=1)


def are_links(x: np.ndarray, p: np.ndarray, q: np.ndarray, near: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs reach the threshold, given their products up to rounding."""
    out = near >= threshold
    doubt = np.flatnonzero(np.abs(near - threshold) < DOUBT)
    out[doubt] = products_of(x[p[doubt]], x[q[doubt]]) >= threshold
    return out


def small_pairs(x: np.ndarray, begins: np.ndarray, threshold: float):
    """Linked pairs within the small groups (rows ``begins[i]`` to before ``begins[i + 1]``)."""
    sizes = np.diff(begins)
    after = np.where(np.repeat(sizes, sizes) <= SMALL, np.repeat(begins[1:], sizes) - np.arange(len(x)) - 1, 0)
    total = np.cumsum(after)
    for part in np.split(np.arange(len(x)), np.flatnonzero(np.diff(total // 100_000)) + 1):
        p = np.repeat(part, after[part])
        q = p + 1 + np.arange(len(p)) - np.repeat(np.cumsum(after[part]) - after[part], after[part])
        linked = are_links(x, p, q, np.einsum("ij,ij->i", x[p], x[q]), threshold)
        yield p[linked], q[linked]


def met_before(p: np.ndarray, q: np.ndarray, flat: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Whether the earlier filters of two rows (``flat[first[i]:first[i + 1]]``) have one in common."""
    rows = np.repeat(np.arange(len(first) - 1), np.diff(first))
    known, number = np.unique(flat, return_inverse=True)
    held = np.sort(rows * max(1, len(known)) + number)
    size = np.diff(first)[p]
    pair = np.repeat(np.arange(len(p)), size)
    place = np.arange(len(pair)) - np.repeat(np.cumsum(size) - size, size) + first[p][pair]
    wanted = q[pair] * max(1, len(known)) + number[place]
    at = np.minimum(np.searchsorted(held, wanted), max(0, len(held) - 1))
    out = np.zeros(len(p), bool)
    if len(held):
        out[pair[held[at] == wanted]] = True
    return out


def met_matrix(flat: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The same for all pairs of one group: filters that many have by a product of their members, others pair by pair."""
    m = len(first) - 1
    rows = np.repeat(np.arange(m), np.diff(first))
    out = np.zeros((m, m), bool)
    _, number, count = np.unique(flat, return_inverse=True, return_counts=True)
    often = np.flatnonzero(count >= SMALL)
    for part in np.array_split(often, -(-len(often) // 512)) if len(often) else []:
        column = np.full(len(count), -1)
        column[part] = np.arange(len(part))
        some = np.flatnonzero(column[number] >= 0)
        held = np.zeros((m, len(part)), np.float32)
        held[rows[some], column[number[some]]] = 1
        out |= held @ held.T > 0
    rest = np.flatnonzero(count[number] < SMALL)
    if not len(rest):
        return out
    rest = rest[np.argsort(number[rest], kind="stable")]
    begins = np.flatnonzero(np.append(True, np.diff(number[rest]) > 0))
    after = np.repeat(np.append(begins[1:], len(rest)), np.diff(np.append(begins, len(rest)))) - np.arange(len(rest)) - 1
    p = np.repeat(np.arange(len(rest)), after)
    q = p + 1 + np.arange(len(p)) - np.repeat(np.cumsum(after) - after, after)
    out[rows[rest[p]], rows[rest[q]]] = True
    out[rows[rest[q]], rows[rest[p]]] = True
    return out


def smallest_root(node: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each row, the smallest node of the rows that the pairs connect with it."""
    root = node.copy()
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        if (new == root).all():
            return root
        root = new


def links_of(x: np.ndarray, begins: np.ndarray, side: np.ndarray, across: np.ndarray, flat: np.ndarray, first: np.ndarray, threshold: float):
    """Linked pairs of rows that meet here for the first time; in blocks compared with others only those of different sides."""
    a, b = [], []
    for p, q in small_pairs(x, begins, threshold):
        wanted = ~across[p] | (side[p] != side[q])
        p, q = p[wanted], q[wanted]
        fresh = ~met_before(p, q, flat, first)
        a.append(p[fresh]), b.append(q[fresh])
    for i in np.flatnonzero(np.diff(begins) > SMALL):
        at, end = int(begins[i]), int(begins[i + 1])
        own = x[at:end]
        near = own @ own.T
        open_ = np.triu(near >= threshold - DOUBT, 1)
        if across[at]:
            open_ &= side[at:end, None] != side[None, at:end]
        open_ &= ~met_matrix(flat[first[at] : first[end]], first[at : end + 1] - first[at])
        p, q = np.nonzero(open_)
        linked = are_links(own, p, q, near[p, q], threshold)
        a.append(p[linked] + at), b.append(q[linked] + at)
    return np.concatenate(a), np.concatenate(b)


def linked(entries: DataFrame, threshold: float) -> DataFrame:
    """(node, links, root): per block pair, the vectors linked with a node and the smallest node of its group there."""

    def compared(batches):
        for rows, starts in whole_groups(batches, 3):
            key, side, node, copies = (rows.column(i).to_numpy() for i in (0, 3, 4, 5))
            across = rows.column(1).to_numpy() < rows.column(2).to_numpy()
            by_length = key >> 44
            earlier = rows.column(7)
            a, b = [], []
            for dim in np.unique(by_length):
                own = np.flatnonzero(by_length == dim)
                begins = np.unique(np.append(np.searchsorted(own, starts), len(own)))
                lists = earlier.take(pa.array(own))
                first = np.append(0, np.cumsum(lists.value_lengths().to_numpy()))
                p, q = links_of(unit(rows.column(6).take(pa.array(own))), begins, side[own], across[own], lists.flatten().to_numpy(), first, threshold)
                a.append(own[p]), b.append(own[q])
            a, b = np.concatenate(a), np.concatenate(b)
            if len(a) == 0:
                continue
            links = np.zeros(len(node), np.int64)
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            root = smallest_root(node, a, b)
            some = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays([pa.array(node[some]), pa.array(links[some]), pa.array(root[some])], names=["node", "links", "root"])

    dealt = block_number(entries, "node", F.ceil(F.col("n") / BLOCK).cast("int"), BLOCK)
    rows = gathered(dealt.select("key", "left", "right", "side", "node", "copies", "vec", "earlier"), "key")
    return rows.mapInArrow(compared, "node long, links long, root long")


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.9) -> DataFrame:
    """(id, n_links, component_id, kept) of every row."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"))
    rows = rows.withColumn("vec", F.when(usable(F.col("vec")) & F.col("id").isNotNull(), F.col("vec")))
    nodes = durable(rows.filter("vec IS NOT NULL").groupBy("vec").agg(F.min("id").alias("first"), F.count("*").alias("copies")))
    # An id that stands with several vectors is one node per vector: a node is a number of its own, the smallest id comes back at the end.
    nodes = durable(nodes.withColumn("node", F.monotonically_increasing_id()))
    found = durable(passed(nodes, plans_for(nodes, threshold)))
    entries = found.select("node", F.explode("filters").alias("key"))
    shared = entries.join(entries.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "key")
    # The filters that a vector shares with another: bounded by the tables and alpha, not by the number of vectors.
    lists = shared.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("key", "n"))).alias("shared"))
    held = lists.join(nodes.select("node", "copies", "vec"), "node").select("node", "copies", "vec", "shared", F.posexplode("shared").alias("place", "own"))
    earlier = F.transform(F.slice("shared", F.lit(1), F.col("place")), lambda s: s["key"])
    meeting = held.select("node", "copies", "vec", F.col("own.key").alias("key"), F.col("own.n").alias("n"), earlier.alias("earlier"))
    links = durable(linked(meeting, threshold))
    labels = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    per_node = nodes.join(counts, "node", "left").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    # The smallest id of a component, with partial minima before the shuffle.
    smallest = per_node.groupBy("component").agg(F.min("first").alias("component_id"))
    per_node = per_node.join(smallest, "component").select("vec", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    out = rows.join(per_node, "vec", "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
