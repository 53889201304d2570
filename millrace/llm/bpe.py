"""Encoding and decoding with a word-level BPE vocabulary (lower case, word ends marked), equal to the tokenizers library.

Frequent words are counted over all texts in Spark and compiled, with their ids, into a minimal acyclic transducer
(``lexicon``), a file that Spark sends to every executor and that tasks map into memory.  A word it does not hold is merged
exactly, pair by pair in the order of the vocabulary's merges; the new words of a portion are merged side by side in arrays.  Which
words are compiled changes the speed, never the ids.

Texts are cut into words by array operations (``pretokens``).  Only a stretch without spaces that holds a character younger than
Unicode 3.2 or beyond the first 65536, and a text with a special token in it, are encoded by the tokenizers library.

Defined results: a null or empty text has no ids and decodes to an empty text; a very long text is one portion and is encoded whole;
repeated rows get the same result each, and ties do not arise; an empty table gives an empty result and an empty lexicon; further columns
are kept, those named like a result column, in whatever case, are replaced.
"""

from __future__ import annotations

import json
import os
import tempfile
import unicodedata
import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrays import give_back
from millrace.llm.lexicon import Lexicon, compile_lexicon
from millrace.llm.pretokens import Ids, Known, Pretokens, chosen_ids, flat_ids, special_pattern, with_whole_texts
from millrace.session import durable

#: The lexicon holds the words that make up at least this share of all words, so it has 1 / FREQUENT words at most.
FREQUENT = 5e-6
#: A task counts until it holds this many distinct words, passes on those that make up at least this share of what it
#: counted, and starts anew: a word with that share of all words has it in at least one such portion.
COUNTED = 150_000
SHARE = 1e-6
#: Words that a process remembers, at about 40 bytes a word.
REMEMBERED = 1_000_000
END = "</w>"

def byte_characters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself if it prints, else the next free one."""
    printed = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, free = [""] * 256, 0x100
    for b in range(256):
        if b in printed:
            out[b] = chr(b)
        else:
            out[b], free = chr(free), free + 1
    return out


class WordBpe:
    """The vocabulary, merges and special tokens of one tokenizer file."""

    def __init__(self, text: str):
        self.text = text
        data = json.loads(text)
        vocab = data["model"]["vocab"]
        self.tokens = [""] * (max([*vocab.values(), *(t["id"] for t in data["added_tokens"])]) + 1)
        for token, i in vocab.items():
            self.tokens[i] = token
        for token in data["added_tokens"]:
            self.tokens[token["id"]] = token["content"]
        self.special = special_pattern(data["added_tokens"])
        pairs = [m.split(" ") if isinstance(m, str) else m for m in data["model"]["merges"]]
        keys = np.array([vocab[a] * len(self.tokens) + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.pairs, self.ranks, self.made = keys[order], order, np.array([vocab[a + b] for a, b in pairs], np.int64)[order]
        letters = byte_characters()
        self.inner = np.array([vocab.get(c, -1) for c in letters])
        self.final = np.array([vocab.get(c + END, -1) for c in letters])
        self._library = None

    def merged(self, words: list[bytes]) -> Ids:
        """The ids of words: in each round the pairs of the lowest rank of every word are merged, until no word has a pair left."""
        lengths = np.array([len(w) for w in words], np.int64)
        data = np.frombuffer(b"".join(words), np.uint8)
        symbols = self.inner[data]
        ends = np.cumsum(lengths)
        symbols[ends - 1] = self.final[data[ends - 1]]
        owner, none = np.repeat(np.arange(len(words)), lengths), len(self.pairs)
        done = []
        while len(symbols):
            last = np.append(owner[1:] != owner[:-1], True)
            keys = symbols[:-1] * len(self.tokens) + symbols[1:]
            at = np.minimum(np.searchsorted(self.pairs, keys), max(0, none - 1))
            fits = np.append((self.pairs[at] == keys) if none else np.zeros(len(keys), bool), False) & ~last
            rank = np.full(len(symbols), none)
            rank[:-1][fits[:-1]] = self.ranks[at[fits[:-1]]]
            starts = np.flatnonzero(np.append(True, last[:-1]))
            best = np.minimum.reduceat(rank, starts)
            own = np.repeat(best, np.diff(np.append(starts, len(symbols))))
            over = own == none
            done.append((owner[over], symbols[over]))
            taken = (rank == own) & ~over
            # Of overlapping equal pairs, as in "aaa", every second one counts from the left.
            begun = np.flatnonzero(taken & ~np.append(False, taken[:-1]))
            run = np.cumsum(taken & ~np.append(False, taken[:-1])) - 1
            taken &= (np.arange(len(taken)) - (begun[run] if len(begun) else 0)) % 2 == 0
            first = np.flatnonzero(taken)
            symbols = symbols.copy()
            symbols[first] = self.made[at[first]]
            kept = ~over
            kept[first + 1] = False
            symbols, owner = symbols[kept], owner[kept]
        owner, symbols = (np.concatenate(x) if done else np.zeros(0, np.int64) for x in zip(*done)) if done else (np.zeros(0, np.int64),) * 2
        order = np.argsort(owner, kind="stable")
        return symbols[order].astype(np.uint32), np.bincount(owner, minlength=len(words)).astype(np.int64)

    def by_library(self, texts: list[str]) -> Ids:
        if self._library is None:
            from tokenizers import Tokenizer

            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
            self._library = Tokenizer.from_str(self.text)
            self._library.no_truncation()
            self._library.no_padding()
        return flat_ids([c.ids for c in self._library.encode_batch_fast(texts, add_special_tokens=False)])

    def pretokens(self, texts: list[str]) -> tuple[Pretokens, list[int]]:
        """The words of all texts, and the numbers of the texts left out for the library."""
        whole = [i for i, t in enumerate(texts) if self.special.search(t)]
        apart = set(whole)
        normal = ["" if i in apart else t if t.isascii() else unicodedata.normalize("NFC", t) for i, t in enumerate(texts)]
        return Pretokens(normal, lower=True), whole


def text_portions(column: pa.Array, size: int = 1 << 20) -> Iterator[list[str]]:
    """The texts of consecutive rows, about ``size`` bytes at a time; a longer text comes alone."""
    column = pc.fill_null(column, "")
    ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False))
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(ends, (ends[row - 1] if row else 0) + size, "right")))
        yield column.slice(row, end - row).to_pylist()
        row = end


def frequent_words(docs: DataFrame, text_col: str, model_text, share: float = FREQUENT) -> list[str]:
    """The words that make up at least ``share`` of the words of all texts; there are 1 / share of them at most."""

    def rows(counts):
        total = sum(counts.values())
        least = max(2, SHARE * total)
        kept = [(None, total), *((w, n) for w, n in counts.items() if n >= least)]
        return pa.RecordBatch.from_arrays(
            [pa.array([w for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], names=["word", "n"]
        )

    def counted(batches):
        model, counts = _model(model_text.value), Counter()
        for batch in batches:
            for texts in text_portions(batch.column(0)):
                split, _ = model.pretokens(texts)
                times = np.bincount(split.codes, minlength=len(split.keys))
                own = np.flatnonzero(~split.odd(slice(None)))
                counts.update(dict(zip(split.words(own), times[own].tolist())))
                if len(counts) > COUNTED:
                    yield rows(counts)
                    counts.clear()
        yield rows(counts)
        give_back()

    # The row without a word has the number of all words.
    found = durable(docs.select(text_col).mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")))
    total = found.filter("word IS NULL").agg(F.sum("n")).first()[0] or 0
    return sorted(r.word for r in found.filter(F.col("word").isNotNull() & (F.col("n") >= share * total)).select("word").collect())


@lru_cache(maxsize=2)
def _model(text: str) -> WordBpe:
    return WordBpe(text)


@lru_cache(maxsize=1)
def _remembered(text: str, name: str) -> tuple[Known, Callable[[list[str]], Ids]]:
    """Known words, and the way to the ids of others: from the mapped lexicon or else by merging."""
    model, lexicon = _model(text), Lexicon(SparkFiles.get(name))

    def encode(words: list[str]) -> Ids:
        raw = [w.encode() for w in words]
        ranks = lexicon.ranks_of(raw)
        there = ranks >= 0
        compiled = lexicon.ids_of_all(ranks[there])
        return chosen_ids(~there, compiled, model.merged([w for w, known in zip(raw, there) if not known]))

    return Known(REMEMBERED), encode


def send_lexicon(docs: DataFrame, text_col: str, model_text) -> str:
    """Compiles the frequent words of ``docs`` and sends the file to the executors; returns its name there."""
    model = _model(model_text.value)
    words = [w.encode() for w in frequent_words(docs, text_col, model_text)]
    flat, sizes = model.merged(words)
    data = compile_lexicon(dict(zip(words, (ids.tolist() for ids in np.split(flat, np.cumsum(sizes)[:-1])))) if words else {})
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    path = Path(tempfile.mkdtemp(prefix="lexicon-")) / name
    path.write_bytes(data)
    docs.sparkSession.sparkContext.addFile(str(path))
    return name


def encoded(docs: DataFrame, tokenizer_path: str, text_col: str = "text", into: str = "ids") -> DataFrame:
    """``docs`` without its text but with the ids of each whole text, an array of int."""
    context = docs.sparkSession.sparkContext
    model_text = context.broadcast(Path(tokenizer_path).read_text())  # a vocabulary file: its size does not depend on the data
    name = send_lexicon(docs, text_col, model_text)
    keep = [c for c in docs.columns if c != text_col and c.lower() != into.lower()]

    def encode(batches):
        model, (known, by_method) = _model(model_text.value), _remembered(model_text.value, name)
        for batch in batches:
            row = 0
            for texts in text_portions(batch.column(len(keep))):
                split, whole = model.pretokens(texts)
                ids, offsets = split.ids(known, by_method, model.by_library)
                if whole:
                    flat, sizes = model.by_library([texts[i] for i in whole])
                    ids, offsets = with_whole_texts(ids, offsets, dict(zip(whole, np.split(flat, np.cumsum(sizes)[:-1]))))
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids.view(np.int32)))
                yield pa.RecordBatch.from_arrays([*(c.slice(row, len(texts)) for c in batch.columns[: len(keep)]), lists], names=[*keep, into])
                row += len(texts)
        give_back()

    rows = docs.select(*keep, text_col)
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*keep).schema.fields)
    return rows.mapInArrow(encode, f"{schema}`{into}` array<int>")


def decoded(rows: DataFrame, tokenizer_path: str, ids_col: str = "ids", into: str = "decoded") -> DataFrame:
    """``rows`` with the text of the ids, special tokens kept: this vocabulary has no decoder, so tokens are joined by a space."""
    model_text = rows.sparkSession.sparkContext.broadcast(Path(tokenizer_path).read_text())
    keep = [c for c in rows.columns if c.lower() != into.lower()]
    place = keep.index(ids_col)

    def decode(batches):
        tokens = np.array(_model(model_text.value).tokens, dtype=object)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                some = batch.slice(at, 500)
                lists = some.column(place)
                flat, offsets = lists.values, lists.offsets.to_numpy()
                texts = [" ".join(tokens[flat.slice(a, b - a).to_numpy()].tolist()) for a, b in zip(offsets[:-1], offsets[1:])]
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(texts, pa.string())], names=[*keep, into])
        give_back()

    rows = rows.select(*keep)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(decode, f"{schema}, `{into}` string")


def digests(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_tokens, and the SHA-256 of the decimal ids joined by a space and of the decoded text."""
    ids = encoded(docs.select(id_col, text_col), tokenizer_path, text_col)
    return decoded(ids, tokenizer_path).select(
        id_col, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
