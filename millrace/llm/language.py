"""Language identification, word first: a known word scores by its log frequency per language; an unseen word falls back to
progressively shorter character n-grams, down to single characters.

Learning counts words of a bounded sample of texts (``sample_rows``) per language; a word that stands in at least
``min_count`` places of the sample is known.  The n-gram counts (5 to 1 characters, with word ends marked) come from the
known words, each weighted by its frequency, so they stay small too.  At each position of an unseen word the longest known n-gram scores,
shortened by ``BACKOFF`` for each step; a one-character tail that nobody knows scores alike in all languages.

Each word's scores become shares of the languages, so no odd word decides a text; a text's language is the one with the
highest sum of shares, and ``score`` is its part of that sum, which is low for texts of mixed languages.

Defined results: null and empty texts and texts without a letter are ``und`` with score 0; very long texts are read whole; ties go to the
language first in the alphabet; a corpus without any labelled text makes every prediction ``und``; repeated rows get the same result each; an
empty table gives an empty result; further columns are kept, those named like a result column, in whatever case, are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrays import give_back, joined_bytes, mixed, row_sums, span_hashes, spans, text_slices, byte_table
from millrace.llm.learning import dealt, in_fold, unused

UNKNOWN = "und"
LONGEST = 5
BACKOFF = 0.6
CLIP = 6.0
#: Letters: a-z and every character beyond ASCII; lower case is made by Spark before.
LETTER_BYTES = byte_table((0x61, 0x7A), (0x80, 0xFF))
LETTER = r"\p{L}"


@dataclass
class LanguageModel:
    languages: list[str]
    words: np.ndarray  # sorted hashes of the known words
    word_scores: np.ndarray  # one row per known word, one column per language
    grams: np.ndarray  # sorted hashes of the known n-grams
    gram_scores: np.ndarray

    def unseen(self, words: list[bytes]) -> np.ndarray:
        """Scores of words that are not known, one row each: the longest known n-gram at every character."""
        return _gram_scores(words, self.grams, self.gram_scores, len(self.languages))


def _characters(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words, each between two marks, and the place where each word begins."""
    text = "".join(f"\x02{w.decode(errors='replace')}\x03" for w in words)
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    return points, np.append(np.flatnonzero(points == 2), len(points))


def _gram_hashes(points: np.ndarray, first: np.ndarray):
    """For n from the longest to 1: hashes of the n-grams at every place, and where one fits into its word."""
    left = np.repeat(first[1:], np.diff(first)) - np.arange(len(points))
    hashes, fits = {}, {}
    rolled = np.zeros(len(points), np.uint64)
    for n in range(1, LONGEST + 1):
        ahead = np.zeros(len(points), np.uint64)
        ahead[: max(0, len(points) - n + 1)] = points[n - 1 :]
        rolled = rolled * np.uint64(0xD6E8FEB86659FD93) + ahead + np.uint64(1)
        hashes[n], fits[n] = mixed(rolled + np.uint64(n)), left >= n
    return hashes, fits


def _gram_scores(words, known, scores, languages) -> np.ndarray:
    if not words:
        return np.zeros((0, languages))
    points, first = _characters(words)
    hashes, fits = _gram_hashes(points, first)
    found = np.zeros((len(points), languages))
    open_ = points > 3  # the marks take part in n-grams but start none of their own, but for the first one
    open_[first[:-1]] = True
    if len(known):
        for n in range(LONGEST, 0, -1):
            at = np.flatnonzero(open_ & fits[n])
            place = np.minimum(np.searchsorted(known, hashes[n][at]), len(known) - 1)
            hit = known[place] == hashes[n][at]
            found[at[hit]] = scores[place[hit]] * BACKOFF ** (LONGEST - n)
            open_[at[hit]] = False
    return row_sums(found, first) / np.maximum(1, np.diff(first) - 2)[:, None]


def _centred(counts: np.ndarray, totals: np.ndarray, smooth: float) -> np.ndarray:
    """Log frequency per language less the mean over the languages: what speaks for a language."""
    logs = np.log((counts + smooth) / (totals + smooth * len(counts)))
    return np.clip(logs - logs.mean(axis=1, keepdims=True), -CLIP, CLIP)


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, word, n): how often each word of letters stands in the texts (columns lang and text), in Spark."""
    words = F.explode(F.regexp_extract_all(F.lower("text"), F.lit(f"({LETTER}+)"), F.lit(1)))
    return texts.select("lang", words.alias("word")).groupBy("lang", "word").agg(F.count("*").alias("n"))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 4, held: int = 2,
          sample_rows: int = 12000, min_count: int = 4) -> LanguageModel:
    """Counts from at most ``sample_rows`` texts outside the held-out fold, chosen by language and the hash of their ids."""
    known = docs.select(F.col(id_col).alias("_id"), F.col(lang_col).cast("string").alias("lang"))
    known = known.filter(~in_fold("_id", folds, held) & F.col("lang").isNotNull()).select("_id", F.col("lang").alias("_label")).distinct()
    sample = dealt(known, sample_rows)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    texts = texts.filter(F.col("lang").isNotNull()).join(F.broadcast(sample), "_id")
    counts = word_counts(texts)
    total = counts.groupBy("word").agg(F.sum("n").alias("total")).filter(F.col("total") >= min_count).select("word")
    rows = counts.join(total, "word", "left_semi").toArrow()
    lang, word, n = rows["lang"].to_pylist(), rows["word"].to_pylist(), rows["n"].to_numpy()
    languages = sorted(set(lang))
    column = {x: i for i, x in enumerate(languages)}
    place: dict[str, int] = {}
    for w in word:
        place.setdefault(w, len(place))
    table = np.zeros((len(place), len(languages)))
    if place:
        np.add.at(table, ([place[w] for w in word], [column[x] for x in lang]), n)
    return _model(languages, list(place), table)


def _model(languages: list[str], words: list[str], table: np.ndarray) -> LanguageModel:
    empty = np.zeros(0, np.uint64)
    if not words:
        return LanguageModel(languages, empty, np.zeros((0, len(languages))), empty, np.zeros((0, len(languages))))
    totals = table.sum(axis=0)
    data, offsets = joined_bytes(words)
    hashes = span_hashes(data, offsets[:-1], offsets[1:])
    order = np.argsort(hashes)
    points, first = _characters([w.encode() for w in words])
    grams, fits = _gram_hashes(points, first)
    owner = np.repeat(np.arange(len(words)), np.diff(first))
    found, weight = [], []
    for n in range(1, LONGEST + 1):
        at = np.flatnonzero(fits[n] & ((points > 3) | (np.arange(len(points)) == first[:-1][owner])))
        keys, inverse = np.unique(grams[n][at], return_inverse=True)
        counts = np.zeros((len(keys), len(languages)))
        np.add.at(counts, inverse, np.sqrt(table[owner[at]]))
        often = np.bincount(inverse, minlength=len(keys)) >= (2 if n > 1 else 1)
        found.append(keys[often])
        weight.append(_centred(counts[often], counts.sum(axis=0), 0.5))
    keys, weights = np.concatenate(found), np.concatenate(weight)
    by_key = np.argsort(keys)
    return LanguageModel(languages, hashes[order], _centred(table, totals, 0.5)[order], keys[by_key], weights[by_key])


def predicted(docs: DataFrame, model: LanguageModel, text_col: str = "text", into: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its score, from the whole text."""
    keep = [c for c in docs.columns if c.lower() not in (into.lower(), score.lower())]
    place, languages = keep.index(text_col), np.array([*model.languages, UNKNOWN], dtype=object)

    def scored(batches):
        for batch in batches:
            texts, n = batch.column(len(keep)), batch.num_rows
            sums = np.zeros((n, len(model.languages)))
            for row, end, data, offsets in text_slices(texts):
                starts, ends, first = spans(LETTER_BYTES[data], offsets)
                hashes = span_hashes(data, starts, ends)
                keys, at, inverse = np.unique(hashes, return_index=True, return_inverse=True)
                values = np.zeros((len(keys), len(model.languages)))
                if len(model.words):
                    near = np.minimum(np.searchsorted(model.words, keys), len(model.words) - 1)
                    known = model.words[near] == keys
                    values[known] = model.word_scores[near[known]]
                    new = np.flatnonzero(~known)
                    raw = data.tobytes()
                    values[new] = model.unseen([raw[a:b] for a, b in zip(starts[at[new]], ends[at[new]])])
                odds = np.exp(values - values.max(axis=1, keepdims=True, initial=-np.inf))
                sums[row:end] = row_sums((odds / odds.sum(axis=1, keepdims=True))[inverse], first)
            letters = np.array(batch.column(len(keep) + 1).to_numpy(zero_copy_only=False), dtype=bool)
            best = np.full(n, len(model.languages))
            share = np.zeros(n)
            if model.languages:
                best = np.where(letters, sums.argmax(axis=1), best)
                share = np.where(letters, sums.max(axis=1) / np.maximum(sums.sum(axis=1), 1e-9), 0.0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(languages[best], pa.string()), pa.array(share)],
                names=[*keep, into, score],
            )
        give_back()

    lowered = docs.select(
        *[docs[c] for c in keep],
        F.lower(docs[text_col]).alias(unused("lower", keep)),
        F.coalesce(docs[text_col].rlike(LETTER), F.lit(False)).alias(unused("letters", keep)),
    )
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*[docs[c] for c in keep]).schema.fields)
    return lowered.mapInArrow(scored, f"{schema}, `{into}` string, `{score}` double")
