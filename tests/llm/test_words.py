"""Arrays of words, and the operators that score or split texts, against plain versions."""

import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import language, licenses, quality, toxicity
from millrace.llm.arrays import Members, ngrams_of, text_hashes, text_slices, words_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TEXTS = ["The cat, the CAT", "", None, "été ça  va?", "a", "x" * 5000 + " end", "...", "one two three four five six seven", "🙂 smile 12"]


def lowered(text):
    return "".join(c.lower() if c < "\x80" else c for c in text or "")


def test_words_and_ngrams_equal_plain_ones():
    for size in (1 << 20, 10):  # one slice, and a slice per text
        got, grams = [], []
        for row, end, data, offsets in text_slices(pa.array(TEXTS), size):
            words, first = words_of(data, offsets)
            rolled, at = ngrams_of(words, first, 2)
            got += [words[a:b].tolist() for a, b in zip(first[:-1], first[1:])]
            grams += [rolled[a:b].tolist() for a, b in zip(at[:-1], at[1:])]
        plain = [WORD.findall(lowered(t)) for t in TEXTS]
        assert got == [text_hashes(w).tolist() if w else [] for w in plain]
        assert [len(g) for g in grams] == [max(0, len(w) - 1) for w in plain]
        known = {}
        for g, w in zip(grams, plain):
            for h, pair in zip(g, zip(w, w[1:])):
                assert known.setdefault(h, pair) == pair


def test_members_finds_exactly_the_members():
    rng = np.random.default_rng(3)
    values = rng.integers(0, 1 << 63, 5000).astype(np.uint64)
    members = Members(values[::7])
    assert members.positions(values).tolist() == list(range(0, 5000, 7))
    assert len(Members(np.zeros(0, np.uint64)).positions(values)) == 0


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def made_documents(n):
    good = "the house stands near the river and people walk there"
    out = []
    for i in range(n):
        bad = i % 3 == 0
        text = " ".join((w + ("***" if bad else "")) for w in good.split()) + f" {i}"
        toxic = i % 4 == 0
        out.append((i, text + (" you idiot" if toxic else ""), int(not bad), int(toxic)))
    return out


def odd_rows(n):
    """Rows every operator must take: null, empty, no letters, very long, repeated, without id."""
    return [(n, None), (n + 1, ""), (n + 2, "!!! ???"), (n + 3, "word " * 20000), (n + 4, "same text"), (n + 4, "same text"), (None, "no id at all")]


def test_quality_learns_and_handles_odd_rows(spark):
    made = made_documents(240)
    docs = frame(spark, [(i, t, 0.5, 1) for i, t, _, _ in made] + [(i, t, 0.1, 2) for i, t in odd_rows(1000)], "doc_id long, text string, score double, _id int")
    labels = frame(spark, [(i, q, "x") for i, _, q, _ in made] + [(None, 1, "y"), (5, 0, "z"), (7, None, "z")], "doc_id long, quality int, text string")
    out = quality.classified(docs, labels).collect()
    assert len(out) == 247 and set(out[0].asDict()) == {"doc_id", "text", "_id", "score", "predicted"}
    by_id = {r.doc_id: r for r in out}
    held = [(r.doc_id, q) for (i, _, q, _), r in zip(made, [by_id[m[0]] for m in made]) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum(by_id[i].predicted == q for i, q in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in out)
    assert by_id[1000].score == by_id[1001].score
    assert len({r.score for r in out if r.doc_id == 1004}) == 1
    # One decoration in a text far beyond a slice is scored like any other.
    assert quality.classified(docs.limit(0), labels).count() == 0


def test_quality_without_labels_is_even(spark):
    docs = frame(spark, [(1, "a b")], "doc_id long, text string")
    none = frame(spark, [], "doc_id long, quality int")
    assert quality.classified(docs, none).first().score == 0.5


def test_repeated_tokens_share_a_feature():
    def numbers(text):
        data = np.frombuffer(text.encode(), np.uint8)
        return [set(f.tolist()) for f, _ in quality.features_of(data, np.array([0, len(data)]))][1]

    assert numbers("abc abc") == numbers("xyz xyz") != numbers("abc xyz")


def test_toxicity_gradients_and_scores():
    rng = np.random.default_rng(0)
    network = toxicity.Network()
    network.p = {k: v.astype(np.float64) for k, v in network.p.items()}
    ((_, _, data, offsets),) = text_slices(pa.array(["the idiot was here", "you are fine " * 15, "", None]), 1 << 62)
    inputs, inverse, first = toxicity.distinct_words(data, offsets)
    places, _ = toxicity.windows_of(first)
    windows = np.where(places >= 0, np.append(inverse, 0)[places], -1)
    y = np.arange(len(windows)) % 2

    def loss():
        logits, _ = network.forward(network.projected(network.inputs(*inputs)), windows)
        return np.mean(np.logaddexp(0, logits) - y * logits)

    gradients = network.gradients(network.inputs(*inputs), *inputs, windows, y)
    for name in ("xf", "ub", "uf", "cb", "attend", "query", "out", "bias"):
        at = tuple(rng.integers(0, s) for s in network.p[name].shape)
        kept = network.p[name][at]
        network.p[name][at] = kept + 1e-4
        up = loss()
        network.p[name][at] = kept - 1e-4
        down = loss()
        network.p[name][at] = kept
        assert (up - down) / 2e-4 == pytest.approx(gradients[name][at], rel=1e-3, abs=1e-8)


def test_windows_cover_every_word_and_overlap():
    first = np.array([0, 0, 5, 5 + 32, 37 + 100, 137 + 33])
    places, rows = toxicity.windows_of(first)
    for row in range(5):
        own = places[rows == row]
        assert sorted(set(own[own >= 0].tolist())) == list(range(first[row], first[row + 1]))
        assert len(own) >= 1
    own = places[rows == 3]
    assert (own[1:, : toxicity.STRIDE] == own[:-1, toxicity.STRIDE :]).all()


def test_toxicity_learns_and_handles_odd_rows(spark):
    made = made_documents(160)
    docs = frame(spark, [(i, t, "c") for i, t, _, _ in made] + [(i, t, "c") for i, t in odd_rows(1000)], "doc_id long, text string, _lower string")
    labels = frame(spark, [(i, x) for i, _, _, x in made], "doc_id long, toxic int")
    network = toxicity.train(docs, labels)
    out = {(r.doc_id, r.text): r.score for r in toxicity.score(docs, "text", network).collect()}
    right = [(out[i, t] >= 0.5) == bool(x) for i, t, _, x in made if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(right) > 10 and all(right)
    assert all(0 <= s <= 1 for s in out.values())
    # The word counts wherever it stands in a long text.
    long = frame(spark, [(1, "the river and people walk " * 3000 + "you idiot " + "the house stands " * 3000), (2, "the river and people walk " * 3000)], "doc_id long, text string")
    scores = {r.doc_id: r.score for r in toxicity.score(long, "text", network).collect()}
    assert scores[1] >= 0.5 > scores[2]
    assert toxicity.train(docs, labels.limit(0)) is None
    assert toxicity.score(docs, "text", None).first().score == 0.0


def test_rare_labels_and_languages_are_learnt(spark):
    from pyspark.sql import functions as F

    from millrace.llm.learning import in_fold, labelled_sample

    ids = spark.range(20000).withColumnRenamed("id", "doc_id")
    rare = ids.withColumn("toxic", (F.col("doc_id") % 1000 == 7).cast("int"))
    outside = rare.filter(~in_fold("doc_id", 4, 2))
    sample = labelled_sample(rare, "doc_id", "toxic", 4, 2, 300).collect()
    assert len(sample) == 300 and sum(r._label for r in sample) == outside.filter("toxic = 1").count() > 4
    even = ids.withColumn("toxic", (F.col("doc_id") % 3 == 0).cast("int"))
    plain = even.filter(~in_fold("doc_id", 4, 2)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(300).collect()
    assert {(r._id, r._label) for r in labelled_sample(even, "doc_id", "toxic", 4, 2, 300).collect()} == {(r.doc_id, r.toxic) for r in plain}
    text = F.when(F.col("toxic") == 1, "zwarte kat slaapt hier").otherwise("the black cat sleeps")
    docs = rare.select("doc_id", text.alias("text"), F.when(F.col("toxic") == 1, "nl").otherwise("en").alias("lang"))
    assert language.train(docs, sample_rows=300).languages == ["en", "nl"]


def test_language_words_first_then_shorter_ngrams(spark):
    said = {"aa": "kato hundo birdo sur tablo", "bb": "zwergen mit bart und hut", "cc": "щука и рак"}
    rows = [(i, " ".join([said[k]] * 3), k) for i, k in enumerate(list(said) * 20)]
    docs = frame(spark, rows + [(500, None, "aa"), (501, "123 !!", "bb"), (502, "x", None), (None, "kato", "aa")], "doc_id long, text string, lang string")
    model = language.train(docs, min_count=2)
    assert model.languages == ["aa", "bb", "cc"]
    probe = frame(spark, [(1, "KATO"), (2, "zwergenbart"), (3, "hundoj birdoj"), (4, None), (5, ""), (6, "12 34"), (7, "щукой"), (8, "kato " * 40000)], "doc_id long, text string")
    out = {r.doc_id: (r.lang_pred, r.score) for r in language.predicted(probe, model).collect()}
    assert {k: v[0] for k, v in out.items()} == {1: "aa", 2: "bb", 3: "aa", 4: "und", 5: "und", 6: "und", 7: "cc", 8: "aa"}
    assert all(0 <= s <= 1 for _, s in out.values()) and out[4][1] == 0
    empty = language.train(docs.limit(0))
    assert {r.lang_pred for r in language.predicted(probe, empty).collect()} == {"und"}


def test_backoff_uses_the_longest_known_gram():
    model = language._model(["aa", "bb"], ["katoj", "katon", "zug", "zuge"], np.array([[5, 0], [4, 0], [0, 6], [0, 3]], float))
    seen = model.unseen([b"katos", b"zugzug", b"qqq"])
    assert seen[0, 0] > seen[0, 1] and seen[1, 1] > seen[1, 0] and abs(seen[2, 0] - seen[2, 1]) < 0.05


def plain_places(text):
    words = WORD.findall(lowered(text))
    found = []
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        p = phrase.split()
        found += [(j, label) for j in range(len(words)) if words[j : j + len(p)] == p]
    return len(words), found


def test_licenses_against_plain_search(spark):
    grant = next(t.text for t in licenses.NOTICES if t.name == "mit grant")
    changed = grant.replace("obtaining a copy", "who is obtaining one copy").replace("merge, ", "")
    texts = [
        "Released under the MIT License. mit license MIT-license, General Public License", None, "", "mit", "license mit mit license mit license",
        "Apache (License) general public license general public", changed, "a b c " + grant[:120], "mit license " * 3000, "word " * 500 + grant,
    ]
    docs = frame(spark, [(i, t, 7) for i, t in enumerate(texts)] + [(0, texts[0], 8), (0, "other mit license", 9)], "doc_id long, text string, n_words int")
    rows = licenses.scan(docs).collect()
    assert len(rows) == len(texts) + 2 and sum(r.doc_id == 0 for r in rows) == 3
    by_id = {r.doc_id: r for r in rows if r.doc_id}
    for i, text in enumerate(texts[1:], 1):
        n, found = plain_places(text)
        r = by_id[i]
        assert (r.n_words, r.n_base) == (n, len(found)), i
        assert (r.first_word, r.last_word) == ((min(found)[0], max(found)[0]) if found else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in found}))
        assert 0 <= r.score <= 1
    assert by_id[6].labels == "mit" and by_id[6].score < 1 and by_id[6].n_base == 0
    assert by_id[7].labels == "" and by_id[9].labels == "mit" and by_id[9].score == 1
    span = next(s for s in by_id[9].spans if s.name == "mit grant")
    assert (span.first_word, span.last_word) == (500, 500 + len(licenses.words_in(grant)) - 1)
    assert licenses.scan(docs.limit(0)).count() == 0
