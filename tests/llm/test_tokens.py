"""Encoding, decoding and packed files against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from millrace.llm import bpe, packed
from millrace.llm.lexicon import Lexicon, compile_lexicon
from millrace.llm.queries import vocabulary

tokenizers = pytest.importorskip("tokenizers")
ODD = ["<|endoftext|>", "<|startoftext|>", "İ", "é", "🙂", "Ω", "ς", "Σ", " ", "ſ", "ͅ", "\x1d", "½", "²"]


def library(name):
    tokenizer = tokenizers.Tokenizer.from_file(vocabulary(name))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def odd_texts(n):
    rng = random.Random(1)
    letters = [chr(c) for c in range(0x180)] + list("abc 'stredvml \n  ") * 20 + ODD
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(n)]


TEXTS = [None, "", " ", "The quick brown fox's 123", "word " * 30000, "same", "same", *odd_texts(300)]


POOLS = ["abc 'stredvml \n  ", "αβγ Ωςσ ’“”—…€", "中文字 カナ ", "\u2003\u3000 \t", "éàçüß ½²", "🙂👍\u200d\u0301", "1234 ٣४", "\x1c\x1d\u0085\u180e"]


def mixed_texts(n):
    rng = random.Random(3)

    def one():
        pools = [rng.choice(POOLS) for _ in range(rng.randint(0, 12))]
        return "".join(rng.choice(p) for p in pools for _ in range(rng.randint(1, 6)))

    every = [f"{chr(c)}a {chr(c)} 'b" for c in range(0x3000)]
    return [one() for _ in range(n)] + every + ["IT'S it'LL 'tis ''s", "aaaa aaaaaa aaa", "İstanbul SİĞ", "e\u0301 \u1100\u1161", ""]


def by_parts(encode, texts):
    """Lists of ids of the texts from an encoder that gives ids and offsets."""
    out = []
    for at in range(0, len(texts), 500):
        ids, offsets = encode(texts[at : at + 500])
        out += [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])]
    return out


def test_every_character_is_cut_as_the_library_does():
    texts = mixed_texts(3000) + ["x <|endoftext|>  y", "<|endoftext|>"]
    encoder = packed.Encoder(open(vocabulary("byte_bpe_50k.json")).read())
    tokenizer = library("byte_bpe_50k.json")
    expected = [c.ids for c in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert by_parts(encoder.encode, texts) == expected
    # The same with few words remembered, so that some are forgotten and met again.
    encoder.known = packed.Known(50)
    assert by_parts(encoder.encode, texts) == expected


def test_only_special_tokens_and_young_characters_go_to_the_library():
    model = bpe.WordBpe(open(vocabulary("word_bpe_49k.json")).read())
    tokenizer, asked, real = library("word_bpe_49k.json"), [], model.by_library

    def counted(texts):
        asked.extend(texts)
        return real(texts)

    def encode(texts):
        split, whole = model.pretokens(texts)
        assert whole == [i for i, t in enumerate(texts) if "<|" in t]
        known = bpe.Known(100_000)
        return split.ids(known, lambda words: model.merged([w.encode() for w in words]), counted)

    plain = ["“Curly” quotes — dashes… 5 €", "Ελληνικά και ΣΊΓΜΑ", "中文 字符，。", "Тест русского", "naïve café’s", "word " * 3000, "ﬁne ½ ² №"]
    assert by_parts(encode, plain) == [c.ids for c in tokenizer.encode_batch(plain, add_special_tokens=False)]
    assert asked == []
    mixed = mixed_texts(2000)
    assert by_parts(encode, mixed) == [c.ids for c in tokenizer.encode_batch(mixed, add_special_tokens=False)]
    by_parts(encode, ["smile 🙂 there", "<|endoftext|> x"])
    assert asked[-1] == "🙂"


def test_words_merged_side_by_side_equal_one_by_one():
    model = bpe.WordBpe(open(vocabulary("word_bpe_49k.json")).read())
    pairs = {int(k): (int(r), int(m)) for k, r, m in zip(model.pairs, model.ranks, model.made)}
    rng, n = random.Random(9), len(model.tokens)
    words = [("".join(rng.choice("aabcdelnorst") for _ in range(rng.randint(1, 14)))).encode() for _ in range(800)] + [b"a" * 200, b"a"]
    flat, sizes = model.merged(words)
    for word, got in zip(words, np.split(flat, np.cumsum(sizes)[:-1])):
        ids = [*model.inner[list(word[:-1])].tolist(), int(model.final[word[-1]])]
        while True:
            found = [(pairs[a * n + b][0], i) for i, (a, b) in enumerate(zip(ids, ids[1:])) if a * n + b in pairs]
            if not found:
                break
            i = min(found)[1]
            ids[i : i + 2] = [pairs[ids[i] * n + ids[i + 1]][1]]
        assert got.tolist() == ids, word
    assert [len(x) for x in model.merged([])] == [0, 0]


def test_lexicon_holds_its_words_and_no_others(tmp_path):
    rng = random.Random(5)
    words = {("".join(rng.choice("abé") for _ in range(rng.randint(1, 7)))).encode() for _ in range(400)}
    entries = {w: [len(w), i] for i, w in enumerate(words)}
    path = tmp_path / "l.bin"
    path.write_bytes(compile_lexicon(entries))
    lexicon = Lexicon(str(path))
    others = [b"zzz", b"abx", b"a" * 30, "ü".encode()]
    ranks = lexicon.ranks_of([*words, *others])
    assert sorted(ranks[: len(words)]) == list(range(len(words)))
    assert [lexicon.ids_of(r) for r in ranks[: len(words)]] == [entries[w] for w in words]
    assert (ranks[len(words) :] == -1).all()
    # Endings are shared: far fewer states than letters.
    assert len(lexicon.final) < sum(map(len, words)) / 4
    path.write_bytes(compile_lexicon({}))
    assert Lexicon(str(path)).ranks_of([b"a"]).tolist() == [-1]


def test_word_bpe_equals_the_library(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(TEXTS)] + [(None, "no id", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded int")
    tokenizer = library("word_bpe_49k.json")
    got = {r.doc_id: r for r in bpe.digests(docs, vocabulary("word_bpe_49k.json")).collect()}
    assert len(got) == len(rows)
    for i, text, *_ in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        text = tokenizer.decode(ids, skip_special_tokens=False)
        digest = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), text)]
        assert [got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256] == [len(ids), *digest], repr(rows[i or 0])
    assert bpe.digests(docs.limit(0), vocabulary("word_bpe_49k.json")).count() == 0


def test_packing_any_width():
    rng = np.random.default_rng(0)
    for bits in range(1, 33):
        ids = rng.integers(0, 1 << bits, 9001, dtype=np.uint64).astype(np.uint32)
        segment = packed.Segment(packed.write_segment(np.array([5, 7]), np.array([1, 9000]), ids, bits))
        assert (segment.ids(0, 9001) == ids).all() and (segment.ids(4090, 8200) == ids[4090:8200]).all()
        assert len(segment.ids(7, 7)) == 0 and segment.offsets.tolist() == [0, 1, 9001]
    assert [packed.bits_for(n) for n in (1, 2, 3, 256, 257, 50257, 65537)] == [1, 1, 2, 8, 9, 16, 17]


def test_packed_files_hold_every_id_in_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(packed, "SEGMENT", 2000)
    rows = [(1000 - i, t) for i, t in enumerate(TEXTS)] + [(3, "a"), (3, "b"), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    path = str(tmp_path / "ids")
    packed.write_packed(docs, vocabulary("byte_bpe_50k.json"), path)
    got = sorted(packed.read_packed(spark, path).collect(), key=lambda r: r.start)
    tokenizer, place = library("byte_bpe_50k.json"), 0
    expected = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    assert len(got) == len(expected)
    everything = []
    for r, (i, text) in zip(got, expected):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        assert (r.doc_id, r.start, r.n_tokens, r.ids) == (i, place, len(ids), ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        place += len(ids)
        everything += ids
    assert packed.read_range(spark, path, 1990, 4321).tolist() == everything[1990:4321]
    empty = str(tmp_path / "none")
    packed.write_packed(docs.limit(0), vocabulary("byte_bpe_50k.json"), empty)
    assert packed.read_packed(spark, empty).count() == 0
