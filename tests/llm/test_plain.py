"""Scores of the trained operators, and the diagonals of the license scan, against versions written with plain loops."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import language, learning, licenses, quality, toxicity
from millrace.llm.arrays import BASE, ROLL, text_slices

MASK = (1 << 64) - 1
TEXTS = [
    "The river runs past the old house.", "", None, "der Fluss fließt am Haus vorbei und weiter", "l'été est là, très chaud!", "a", "xyzzy plugh " * 40,
    "!!! ???", "word " * 300 + "unusual ending", "İ ſ Ω", "stutter stutter stutter", "one  two\n\nthree\tfour",
]


def mixed(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & MASK
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & MASK
    return x ^ x >> 31


def hashed(data: bytes) -> int:
    """A polynomial in the base, lowest byte first, then mixed."""
    total, power = 0, int(BASE)
    total = 0
    power = 1
    for byte in data:
        total = (total + (byte + 1) * power) & MASK
        power = power * int(BASE) & MASK
    return mixed(total)


def lowered(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", F.lower("t").alias("t")).collect()
    return [r.t for r in sorted(rows, key=lambda r: r.i)]


# --- quality -------------------------------------------------------------------------------------------------------------

TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^\x00-\x200-9A-Za-z\x80-\xff]+")


def plain_features(text):
    """{feature: value} of a text: single tokens and pairs of neighbours, as shares of all of them."""
    tokens = TOKEN.findall((text or "").encode())
    codes = [hashed(t) for t in tokens]
    grams = [mixed((c + 1) & MASK) for c in codes]
    for a, b, x, y in zip(tokens, tokens[1:], codes, codes[1:]):
        grams.append(int(quality.REPEATED) if a == b else mixed((x * int(ROLL) + y + 2) & MASK))
    out = {}
    for g in grams:
        out[g >> (64 - quality.BITS)] = out.get(g >> (64 - quality.BITS), 0.0) + quality.SCALE / len(grams)
    return out


def test_quality_updates_and_scores_equal_plain_ones(spark):
    rng = random.Random(4)
    words = "alpha beta gamma delta *** ||| Epsilon".split()
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 12))), rng.randint(0, 1)) for i in range(120)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, quality int")
    weights = quality.train(docs, labels, "doc_id", "text", "quality", 4, 2, passes=2)
    z, n, m = {}, {}, quality.Leader()
    bias = 1 << quality.BITS

    def weight(i):
        v = z.get(i, 0.0)
        if abs(v) <= m.l1:
            return 0.0
        return -math.copysign(abs(v) - m.l1, v) / ((m.beta + math.sqrt(n.get(i, 0.0))) / m.alpha + m.l2)

    import zlib

    known = [(quality.hash_order(i), t, y) for i, t, y in rows if zlib.crc32(str(i).encode()) % 4 != 2]
    for _ in range(2):
        for _, text, y in sorted(known):
            x = {**plain_features(text), bias: 1.0}
            w = {i: weight(i) for i in x}
            p = 1 / (1 + math.exp(-sum(w[i] * x[i] for i in x)))
            for i, value in x.items():
                g = (p - y) * value
                grown = n.get(i, 0.0) + g * g
                z[i] = z.get(i, 0.0) + g - (math.sqrt(grown) - math.sqrt(n.get(i, 0.0))) / m.alpha * w[i]
                n[i] = grown
    expected = np.array([weight(i) if i in z else 0.0 for i in range(bias + 1)])
    assert np.allclose(weights, expected, atol=1e-4) and (np.abs(expected) > 0.01).sum() > 5
    odd = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for r in quality.score(odd, "text", weights).collect():
        logit = float(weights[bias]) + sum(float(weights[i]) * v for i, v in plain_features(r.text).items())
        assert r.score == pytest.approx(1 / (1 + math.exp(-logit)), abs=1e-6)


# --- language --------------------------------------------------------------------------------------------------------------

LETTERS = re.compile(rb"[a-z\x80-\xff]+")


def plain_language(model, text, has_letter):
    """Language and score of a text in lower case, word by word and place by place."""
    if not has_letter or not model.languages:
        return "und", 0.0
    known = dict(zip(model.words.tolist(), model.word_scores.tolist()))
    grams = dict(zip(model.grams.tolist(), model.gram_scores.tolist()))
    count = len(model.languages)
    sums = [0.0] * count
    for word in LETTERS.findall(text.encode()):
        scores = known.get(hashed(word))
        if scores is None:
            points = [2, *map(ord, word.decode(errors="replace")), 3]
            scores = [0.0] * count
            for i in range(len(points) - 1):
                for size in range(min(language.LONGEST, len(points) - i), 0, -1):
                    rolled = 0
                    for c in points[i : i + size]:
                        rolled = (rolled * 0xD6E8FEB86659FD93 + c + 1) & MASK
                    found = grams.get(mixed((rolled + size) & MASK))
                    if found is not None:
                        scores = [a + b * language.BACKOFF ** (language.LONGEST - size) for a, b in zip(scores, found)]
                        break
            scores = [s / max(1, len(points) - 2) for s in scores]
        odds = [math.exp(s - max(scores)) for s in scores]
        sums = [a + o / sum(odds) for a, o in zip(sums, odds)]
    best = max(range(count), key=lambda i: (sums[i], -i))
    return model.languages[best], sums[best] / max(sum(sums), 1e-9)


def test_language_scores_equal_plain_ones(spark):
    rng = random.Random(3)
    stock = {"de": "der die und fluss haus straße weiter", "en": "the and river house street further", "fr": "le la et rivière maison été"}
    rows = [(i, " ".join(rng.choice(stock[k].split()) for _ in range(9)), k) for i, k in enumerate(list(stock) * 40)]
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["de", "en", "fr"]
    texts = [*TEXTS, "river", "rivers flussaufwärts", "maisonette streetwise", "été", "der river la"]
    small = lowered(spark, texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in language.predicted(docs, model).collect():
        lang, score = plain_language(model, small[r.doc_id] or "", any(c.isalpha() for c in r.text or ""))
        assert r.lang_pred == lang and r.score == pytest.approx(score, abs=1e-9), r.text


# --- toxicity ----------------------------------------------------------------------------------------------------------------

WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")


def plain_input(p, word):
    """A word's embedding beside the mean of those of its n-grams (over the root of their number)."""
    marked = [1, *(b + 2 for b in word), 1]
    grams = []
    for i in range(len(marked)):
        rolled = 0
        for size in range(1, max(toxicity.GRAMS) + 1):
            if i + size > len(marked):
                break
            rolled = marked[i] if size == 1 else (rolled * 0xD6E8FEB86659FD93 + marked[i + size - 1]) & MASK
            if size in toxicity.GRAMS:
                grams.append(mixed((rolled + size) & MASK) >> (64 - toxicity.CHAR_BITS))
    own = p["word"][hashed(word) >> (64 - toxicity.WORD_BITS)]
    return np.concatenate([own, sum(p["char"][g] for g in grams) / math.sqrt(len(grams))]).astype(np.float64)


def plain_score(p, text):
    """The highest score of the windows, step by step."""
    words = WORDS.findall((text or "").encode())
    h, best = toxicity.HIDDEN, -math.inf
    starts = range(0, max(1, len(words) - toxicity.WINDOW + toxicity.STRIDE), toxicity.STRIDE)
    sig = lambda x: 1 / (1 + np.exp(-x))
    for at in starts:
        inputs = [plain_input(p, w) for w in words[at : at + toxicity.WINDOW]]
        sides = []
        for d, order in (("f", inputs), ("b", inputs[::-1])):
            s, states = np.zeros(h), []
            for x in order:
                a = x @ p[f"x{d}"] + p[f"c{d}"]
                z, r = sig(a[:h] + s @ p[f"u{d}"][:, :h]), sig(a[h : 2 * h] + s @ p[f"u{d}"][:, h : 2 * h])
                c = np.tanh(a[2 * h :] + (r * s) @ p[f"u{d}"][:, 2 * h :])
                s = (1 - z) * s + z * c
                states.append(s)
            sides.append(states if d == "f" else states[::-1])
        pooled = np.zeros(2 * h)
        if inputs:
            states = [np.concatenate(pair) for pair in zip(*sides)]
            weights = [float(p["query"] @ np.tanh(s @ p["attend"])) for s in states]
            odds = [math.exp(w - max(weights)) for w in weights]
            pooled = sum(o * s for o, s in zip(odds, states)) / sum(odds)
        best = max(best, float(p["out"] @ pooled + p["bias"][0]))
    return 1 / (1 + math.exp(-best))


def test_toxicity_scores_equal_plain_ones(spark):
    network = toxicity.Network(seed=5)
    rng = np.random.default_rng(1)
    for name in ("cf", "cb", "out", "query", "attend"):
        network.p[name] = (network.p[name] + rng.standard_normal(network.p[name].shape) * 0.7).astype(np.float32)
    texts = [*TEXTS, " ".join(f"w{i % 37}" for i in range(150)), "idiot you", "x" * 400]
    small = lowered(spark, texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.score(docs, "text", network).collect()}
    p = {k: v.astype(np.float64) for k, v in network.p.items()}
    for i, text in enumerate(small):
        assert got[i] == pytest.approx(plain_score(p, text), abs=2e-5), texts[i]
    assert max(got.values()) - min(got.values()) > 0.05


# --- license scan --------------------------------------------------------------------------------------------------------------


def plain_spans(words, templates):
    """(name, first word, last word, covered) of the spans of a text, by comparing every place with every place of each template."""
    out = set()
    for t in templates:
        own = licenses.words_in(t.text)
        k = len(own) if t.phrase else min(licenses.K, len(own))
        votes = {}
        for i in range(len(words) - k + 1):
            for j in range(len(own) - k + 1):
                if words[i : i + k] == own[j : j + k]:
                    votes.setdefault(i - j, []).append((i, j))
        groups = []
        for diagonal in sorted(votes):
            if t.phrase or not groups or diagonal - groups[-1][0] > licenses.STEP:
                groups.append([diagonal, []])
            groups[-1][0] = diagonal
            groups[-1][1].extend(votes[diagonal])
        for _, places in groups:
            covered = len({j + x for _, j in places for x in range(k)}) / len(own)
            if covered >= licenses.COVERED:
                out.add((t.name, min(i for i, _ in places), max(i for i, _ in places) + k - 1, round(covered, 9)))
    return out


def test_license_spans_equal_plain_ones(spark):
    rng = random.Random(6)
    notices = [t for t in licenses.NOTICES]
    rows = []
    for i in range(60):
        words = [f"w{rng.randrange(50)}" for _ in range(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 2)):
            own = licenses.words_in(rng.choice(notices).text)
            own = [w for w in own if rng.random() > rng.choice([0, 0.02, 0.1, 0.3])]  # words left out move the diagonal
            for _ in range(rng.choice([0, 0, 1, 3])):
                own.insert(rng.randrange(len(own) + 1), "inserted")
            at = rng.randint(0, len(words))
            words = words[:at] + own + words[at:]
        if rng.random() < 0.3:
            words += licenses.words_in(rng.choice(licenses.PHRASES).text) * rng.choice([1, 2])
        rows.append((i, " ".join(words)))
    out = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    templates = licenses.PHRASES + licenses.NOTICES
    some = 0
    for r in out:
        expected = plain_spans(dict(rows)[r.doc_id].split(), templates)
        got = {(s.name, s.first_word, s.last_word, round(s.covered, 9)) for s in r.spans or []}
        assert got == expected, r.doc_id
        some += len(got)
    assert some > 30


# --- samples ---------------------------------------------------------------------------------------------------------------------


def test_samples_are_bounded_by_rows_and_bytes(spark):
    known = spark.range(30000).select(F.col("id").alias("_id"), F.when(F.col("id") % 1000 == 0, 1).otherwise(0).alias("_label"))
    got = [r[0] for r in learning.dealt(known, 500).collect()]
    assert len(got) == len(set(got)) == 500 and sum(i % 1000 == 0 for i in got) == 30
    assert [r[0] for r in learning.dealt(known.repartition(7), 500).collect()] == got
    assert learning.dealt(known.limit(0), 500).count() == 0
    texts = spark.range(50).select(F.concat(F.lit("t"), F.col("id")).alias("doc"), F.repeat(F.lit("x"), F.when(F.col("id") == 7, 5000).otherwise(100).cast("int")).alias("text"))
    sample = texts.select(F.col("doc").alias("_id"), F.lit(1).alias("_label"))
    few = learning.sampled_texts(texts, sample, "doc", "text", most_bytes=1000).collect()
    assert len(few) == 10 and all(len(r["_text"]) == 100 for r in few)
    assert learning.sampled_texts(texts, sample, "doc", "text").count() == 50


def test_names_that_differ_in_case_are_replaced(spark):
    docs = spark.createDataFrame([(1, "the house", 5, 6)], "doc_id long, text string, SCORE int, Lang_Pred int")
    model = language._model([], [], np.zeros((0, 0)))
    assert language.predicted(docs, model).columns == ["doc_id", "text", "lang_pred", "score"]
    weights = np.zeros((1 << quality.BITS) + 1, np.float32)
    assert quality.score(docs, "text", weights).columns == ["doc_id", "text", "Lang_Pred", "score"]
    assert toxicity.score(docs, "text", None).columns == ["doc_id", "text", "Lang_Pred", "score"]
    assert [s for _, s, *_ in text_slices(pa.array(["a"]))] == [1]
