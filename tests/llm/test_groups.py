"""Near copies, containment, near vectors and components against brute force."""

import random
from collections import Counter

import numpy as np
import pytest

from millrace.llm import capfilters, contamination, probminhash
from millrace.llm.blocks import Forest
from millrace.llm.components import components


def classes(nodes, pairs):
    forest = Forest()
    for a, b in pairs:
        forest.join(a, b)
    return {n: forest.root(n) for n in nodes}


def test_components_of_chains_stars_and_cycles(spark):
    rng = random.Random(4)
    chain = list(range(100, 140))
    rng.shuffle(chain)
    pairs = [*zip(chain, chain[1:]), *((7, 200 + i) for i in range(30)), (1, 2), (2, 3), (3, 1), (5, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    expected = classes({x for p in pairs for x in p if p[0] != p[1]}, pairs)
    assert got == expected
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingles(text):
    words = (text or "").lower().split()
    k = min(5, len(words))
    return Counter(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if k else Counter()


def plain_similarity(a, b):
    both = set(a) | set(b)
    return round(sum(1 / sum(max(a[j] / a[i], b[j] / b[i]) for j in both) for i in set(a) & set(b)), 12)


def test_exact_similarity_and_signature_estimate():
    rng = np.random.default_rng(0)
    keys = [int(x) for x in rng.integers(1, 1 << 62, 60)]
    a = Counter({k: int(rng.integers(1, 5)) for k in keys[:45]})
    b = Counter({k: a[k] if k in a and rng.random() < 0.7 else int(rng.integers(1, 5)) for k in keys[10:]})
    sides = [(np.array(sorted(c), np.uint64), np.array([c[k] for k in sorted(c)])) for c in (a, b)]
    exact = plain_similarity(a, b)
    assert probminhash.similarity(*sides[0], *sides[1]) == pytest.approx(exact)
    agreed = []
    for _ in range(80):
        salt = np.uint64(rng.integers(1, 1 << 62))
        grams = np.concatenate([s[0] for s in sides]) ^ salt
        rows = np.repeat([0, 1], [len(s[0]) for s in sides])
        x, y = probminhash.signatures(rows, grams, np.concatenate([s[1] for s in sides]), 2)
        agreed.append((x == y).mean())
    assert np.mean(agreed) == pytest.approx(exact, abs=0.02)


def near_texts(seed=2):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    out = []
    for n in (60, 120, 400):
        base = [word() for _ in range(n)]
        for edits in range(0, 14, 2):
            copy = list(base)
            for _ in range(edits):
                copy[rng.randrange(n)] = word()
            out.append(" ".join(copy))
        out.append(" ".join(base * 2))
    out += [" ".join(word() for _ in range(50)) for _ in range(10)]
    out += [out[0], out[0], "one two three", "One two THREE", "one two four", "...", "...", ", ,", "", None, "long " * 30000, "long " * 29000]
    return out


def test_near_copies_against_all_pairs(spark, monkeypatch):
    texts = near_texts()
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, texts[0], "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string").repartition(4)
    counts = [shingles(t) for t in texts]
    small = [i for i in range(len(texts)) if len(counts[i]) < 1000]
    pairs = [(i, j) for i in small for j in small if i < j and counts[i] and plain_similarity(counts[i], counts[j]) >= 0.8]
    same = [(i, j) for i in range(len(texts)) for j in range(i) if texts[i] and texts[i] == texts[j]]
    expected = classes(range(len(texts)), pairs + same)
    for block in (512, 3):  # also with buckets cut into many blocks
        monkeypatch.setattr(probminhash, "BLOCK", block)
        out, links = probminhash.near_copies(docs)
        got = {r.doc_id: r.class_id for r in out.collect()}
        assert got.pop(None) is None
        assert got == expected
        assert all(r.similarity >= 0.8 for r in links.collect())
    empty, _ = probminhash.near_copies(docs.limit(0))
    assert empty.count() == 0


def test_a_large_group_of_near_copies_is_one_class(spark):
    rng = random.Random(9)
    base = [f"w{rng.randrange(10**6)}" for _ in range(80)]
    texts = []
    for i in range(150):
        copy = list(base)
        for _ in range(rng.choice([1, 2])):
            copy[rng.randrange(80)] = f"e{rng.randrange(10**6)}"
        texts.append(" ".join(copy))
    counts = [shingles(t) for t in texts]
    pairs = [(i, j) for i in range(150) for j in range(i) if plain_similarity(counts[i], counts[j]) >= 0.8]
    out, _ = probminhash.near_copies(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert {r.doc_id: r.class_id for r in out.collect()} == classes(range(150), pairs)


def test_containment_against_plain_counting(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    items = [[word() for _ in range(n)] for n in (5, 6, 9, 13, 20, 40, 41, 100, 300)]
    docs = []
    for item in items:
        for size in (0, 50, 3000):
            filler = [word() for _ in range(size)]
            at = rng.randrange(size + 1)
            docs.append(filler[:at] + item + filler[at:])
            cut = item[: int(len(item) * 0.7)]
            docs.append(filler[:at] + cut + filler[at:])
            docs.append(filler[: at // 2] + item[: len(item) // 2] + filler[at // 2 : at] + item[len(item) // 2 :] + filler[at:])
    texts = [" ".join(d) for d in docs] + [None, "", "a b", " ".join(items[4]).upper() + "!"]
    bench = [(i, " ".join(x)) for i, x in enumerate(items)] + [(50, "a b c"), (51, None), (52, ""), (4, " ".join(items[4]))]
    frame = spark.createDataFrame([(i, t, 1.0) for i, t in enumerate(texts)] + [(None, texts[0], 1.0), (0, texts[0], 2.0)], "doc_id long, text string, containment double")
    found = contamination.contained(frame, spark.createDataFrame(bench, "item_id long, text string")).collect()
    grams = lambda t: {tuple(w[i : i + 5]) for w in [t.lower().replace("!", "").split()] for i in range(len(w) - 4)}
    expected = Counter()
    for i, t in enumerate(texts):
        for item, text in bench:
            own = grams(text or "")
            if own and len(own & grams(t or "")) >= 0.8 * len(own):
                expected[i, item] += 1
    assert Counter((r.doc, r.item) for r in found) == expected
    assert contamination.contained(frame, spark.createDataFrame([], "item_id long, text string")).count() == 0
    assert contamination.contained(frame.limit(0), spark.createDataFrame(bench, "item_id long, text string")).count() == 0


def test_items_of_five_words_are_found_at_the_edge_of_documents(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    items = [" ".join(word() for _ in range(5)) for _ in range(1000)]
    docs = [(i, " ".join([x, *(word() for _ in range(60))])) for i, x in enumerate(items)]
    found = contamination.contained(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(list(enumerate(items)), "item_id long, text string"))
    assert len({(r.doc, r.item) for r in found.collect() if r.doc == r.item}) == 1000


def test_near_vectors_against_all_pairs(spark, monkeypatch):
    rng = np.random.default_rng(8)
    centre = rng.standard_normal((12, 48))
    x = np.concatenate([c + rng.standard_normal((15, 48)) * s for c, s in zip(centre, np.linspace(0.1, 0.6, 12))]).astype(np.float32)
    vectors = [v.tolist() for v in x] + [x[0].tolist(), (x[0] * 3).tolist(), x[5].tolist(), None, [], [0.0] * 48, [float("nan")] * 48, [1.0, None], [1.0, 2.0], [1.0, 2.01], [1e30, 1e30], [float("inf"), 1.0]]
    rows = [(i, v, 3, "x") for i, v in enumerate(vectors)] + [(None, vectors[0], 3, "x")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, node string").repartition(3)

    def usable(v):
        return bool(v) and all(c is not None and np.isfinite(c) for c in v) and any(v)

    units = {i: np.array(v, np.float32).astype(float) / np.linalg.norm(np.array(v, np.float32).astype(float)) for i, v in enumerate(vectors) if usable(v)}
    pairs = [(i, j) for i in units for j in units if i < j and len(units[i]) == len(units[j]) and units[i] @ units[j] >= 0.9]
    degree = Counter(i for p in pairs for i in p)
    roots = classes(range(len(vectors)), pairs)
    assert len(pairs) > 300
    for block in (1024, 8):
        monkeypatch.setattr(capfilters, "BLOCK", block)
        got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in capfilters.near_vectors(frame).collect()}
        assert got.pop(None) == (0, None, True)
        # No link too many, and of those at the very threshold all but one in a thousand.
        assert all(n <= degree[i] for i, (n, _, _) in got.items())
        assert sum(n for n, _, _ in got.values()) >= 0.995 * 2 * len(pairs)
        assert {i: (c, k) for i, (_, c, k) in got.items()} == {i: (roots[i], roots[i] == i) for i in range(len(vectors))}
    assert capfilters.near_vectors(frame.limit(0)).count() == 0


@pytest.mark.parametrize("parts, words", [(1, 9), (2, 20), (3, 8)])
def test_decoding_lists_all_filters_that_are_passed(parts, words):
    plan = capfilters.Plan(24, parts, words, 0.35)
    x = np.random.default_rng(1).standard_normal((20, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows, found = capfilters.decoded(plan, x)
    turns, edges, codewords = capfilters.codes(24, parts, words)
    expected = []
    for i, v in enumerate(x):
        for table, (order, signs) in enumerate(turns):
            y = (v * signs)[order]
            sums, code = np.zeros(1), np.array([table])
            for k in range(parts):
                own = codewords[k] @ y[edges[k] : edges[k + 1]]
                sums, code = (sums[:, None] + own).ravel(), (code[:, None] * words + np.arange(words)).ravel()
            expected += [(i, c) for c in code[sums >= plan.least]]
    assert list(zip(rows.tolist(), found.tolist())) == sorted(expected)


@pytest.mark.parametrize("dim", [64, 256])
def test_pairs_at_the_threshold_share_a_filter(dim):
    """Recall of fresh pairs at exactly 0.9, and as many filters per vector for ten times the vectors."""
    rng = np.random.default_rng(99)
    a, b = rng.standard_normal((2, 1500, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b = 0.9 * a + np.sqrt(0.19) * b / np.linalg.norm(b, axis=1, keepdims=True)
    filters, met = [], []
    for n in (3000, 30000):
        plan = capfilters.with_alpha(capfilters.shape_of(dim, n), 0.9)
        sides = [capfilters.decoded(plan, x) for x in (a, b)]
        together = np.intersect1d(*(r * (1 << 40) + f for r, f in sides))
        filters.append(len(sides[0][0]) / len(a))
        met.append(len(np.unique(together >> 40)) / len(a))
    assert min(met) >= 0.998
    assert filters[1] <= 1.6 * filters[0] <= 200


def test_a_dense_group_and_planted_links_in_many_vectors(spark):
    """One group of near vectors with a block border in it, pairs at many similarities, the rest far from all: every link counted once."""
    rng = np.random.default_rng(12)
    dense = rng.standard_normal(64) + 0.15 * rng.standard_normal((1300, 64))
    left = rng.standard_normal((400, 64))
    left /= np.linalg.norm(left, axis=1, keepdims=True)
    other = rng.standard_normal((400, 64))
    other -= (left * other).sum(axis=1, keepdims=True) * left
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    t = np.linspace(0.86, 0.99, 400)[:, None]
    x = np.concatenate([dense, left, t * left + np.sqrt(1 - t * t) * other, rng.standard_normal((2000, 64))])
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(4)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = np.triu(unit @ unit.T >= 0.9, 1)
    degree = near.sum(axis=0) + near.sum(axis=1)
    roots = classes(range(len(x)), zip(*np.nonzero(near)))
    got = {r.vec_id: r for r in capfilters.near_vectors(frame).collect()}
    assert all(got[i].n_links <= degree[i] for i in range(len(x)))
    assert sum(r.n_links for r in got.values()) >= 0.999 * degree.sum()
    assert sum(got[i].component_id != roots[i] for i in range(len(x))) <= 4


def test_earlier_filters_by_matrix_and_by_pair_agree():
    rng = np.random.default_rng(5)
    lists = [np.sort(rng.choice(60 if i % 2 else 4000, rng.integers(0, 12), replace=False)) for i in range(90)]
    flat, first = np.concatenate(lists), np.append(0, np.cumsum([len(x) for x in lists]))
    matrix = capfilters.met_matrix(flat, first)
    p, q = np.triu_indices(90, 1)
    expected = [bool(set(lists[i]) & set(lists[j])) for i, j in zip(p, q)]
    assert capfilters.met_before(p, q, flat, first).tolist() == expected
    assert matrix[p, q].tolist() == expected and (matrix == matrix.T)[p, q].all()


def test_short_near_copies_share_a_band_as_often_as_stated():
    rng, n = np.random.default_rng(7), 20000
    grams = rng.integers(1, 1 << 62, (n, 5)).astype(np.uint64)
    rows = np.concatenate([np.repeat(np.arange(n), 4), n + np.repeat(np.arange(n), 5)])
    signature = probminhash.signatures(rows, np.concatenate([grams[:, :4].ravel(), grams.ravel()]), np.ones(len(rows)), 2 * n)
    same = signature[:n] == signature[n:]
    missed = ~same[:, :125].reshape(n, 25, 5).all(axis=2).any(axis=1)
    assert missed.sum() <= 6  # one is expected


def test_a_pair_of_a_low_estimate_is_compared(spark):
    rng, n = random.Random(1), 40000
    bases = [[f"w{rng.randrange(10**9)}" for _ in range(9)] for _ in range(n)]
    data = [" ".join(w[: 8 + k]).encode() for w in bases for k in (0, 1)]
    offsets = np.cumsum([0, *map(len, data)])
    same = np.concatenate([
        s[0::2] == s[1::2]
        for at in range(0, 2 * n, 8000)
        for part in [np.frombuffer(b"".join(data[at : at + 8000]), np.uint8)]
        for s in [probminhash.signatures(*probminhash.weighted_shingles(part, offsets[at : at + 8001] - offsets[at]), 8000)]
    ])
    bands = same[:, :125].reshape(n, 25, 5).all(axis=2)
    least = 0.8 - 4 * np.sqrt(0.16 / probminhash.SIZE)
    low = np.flatnonzero(bands.any(axis=1) & (same.mean(axis=1) < least))
    assert len(low)
    i = int(low[0])
    docs = spark.createDataFrame([(k, data[2 * i + k].decode()) for k in (0, 1)], "doc_id long, text string")
    band = int(bands[i].argmax())
    entries = spark.createDataFrame([(7, band, 0, 0), (7, band, 1, 1)], "key long, band int, node long, component long")
    sizes = spark.createDataFrame([(7, 2)], "key long, n long")
    assert [(r.a, r.b, r.similarity) for r in probminhash.compared_in_blocks(entries, sizes, docs, "doc_id", "text", 0.8).collect()] == [(0, 1, 0.8)]
