"""Quality classifier: logistic regression over hashed word n-grams, learnt with follow-the-regularised-leader updates.

A token is a run of word characters or a run of other signs, case kept, so that decoration, capitals and tables are seen
as well as words.  Features are the hashed 1- and 2-grams of tokens; a 2-gram of one token twice is one feature for all
tokens, so stuttering text is known whatever it repeats.  The value of a feature is its share of the text's
n-grams times ``SCALE``, so a score is a sparse dot product that does not grow with the length of the text.

Training reads a bounded sample of labelled rows (``sample_rows``) on the driver, as hashed counts; scoring runs over
Arrow batches with array operations only.  Defined results: a null, empty or blank text has no feature and gets the score
of the intercept; very long texts are scored whole; repeated rows get the same score each, and ties do not arise; of several texts with one id
the greatest is learnt from; without any labelled row every score is 0.5; an empty table gives an empty result; further columns of the
input are kept, those named like a result column, in whatever case, are replaced.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrays import byte_table, give_back, ngrams_of, row_sums, span_hashes, text_slices
from millrace.llm.learning import labelled_sample, sampled_texts

SPACE = byte_table((0x00, 0x20))
WORD = byte_table((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
KIND = np.where(SPACE, 0, np.where(WORD, 1, 2)).astype(np.uint8)
BITS = 18
REPEATED = np.uint64(0x5EED << 40)
SCALE = 24.0


def tokens_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all rows, and the number of the first token of each row."""
    kind, n = KIND[data], len(data)
    change = np.ones(n + 1, bool)
    change[1:n] = kind[1:] != kind[:-1]
    change[offsets] = True
    cuts = np.flatnonzero(change)
    starts, ends = cuts[:-1], cuts[1:]
    real = kind[starts] > 0 if n else np.zeros(0, bool)
    starts, ends = starts[real], ends[real]
    return span_hashes(data, starts, ends), np.searchsorted(starts, offsets)


def features_of(data: np.ndarray, offsets: np.ndarray, bits: int = BITS, orders: tuple[int, ...] = (1, 2)):
    """For each n-gram order, feature numbers and the number of the first one of each row."""
    tokens, first = tokens_of(data, offsets)
    for k in orders:
        grams, at = ngrams_of(tokens, first, k)
        if k > 1 and len(grams):
            begins = np.arange(len(grams)) + np.repeat(first[:-1] - at[:-1], np.diff(at))
            grams[tokens[begins] == tokens[begins + 1]] = REPEATED
        yield (grams >> np.uint64(64 - bits)).astype(np.int64), at


def _feature_batches(batches):
    """Per text: distinct feature numbers and their values."""
    for batch in batches:
        ids, labels, out = batch.column(0), batch.column(1), []
        for _, _, data, offsets in text_slices(batch.column(2)):
            parts = list(features_of(data, offsets))
            for i in range(len(offsets) - 1):
                found = np.concatenate([f[a[i] : a[i + 1]] for f, a in parts])
                index, count = np.unique(found, return_counts=True)
                out.append((index.astype(np.int32), (count * (SCALE / max(1, len(found)))).astype(np.float32)))
        yield pa.RecordBatch.from_arrays(
            [ids, labels, pa.array([x[0] for x in out], pa.list_(pa.int32())), pa.array([x[1] for x in out], pa.list_(pa.float32()))],
            names=["_id", "_label", "_index", "_value"],
        )


@dataclass
class Leader:
    """Follow-the-regularised-leader with per-coordinate rates and L1 and L2 penalties; the last weight is the intercept."""

    bits: int = BITS
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.05
    l2: float = 1e-4

    def __post_init__(self):
        self.z = np.zeros((1 << self.bits) + 1)
        self.n = np.zeros((1 << self.bits) + 1)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def update(self, index: np.ndarray, value: np.ndarray, label: int) -> None:
        at = np.append(index, len(self.z) - 1)
        x = np.append(value, 1.0).astype(np.float64)
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(w @ x, -30, 30)))
        g = (p - label) * x
        grown = self.n[at] + g * g
        self.z[at] += g - (np.sqrt(grown) - np.sqrt(self.n[at])) / self.alpha * w
        self.n[at] = grown


def train(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, folds: int, held: int,
          sample_rows: int = 6000, passes: int = 3) -> np.ndarray:
    """Weights learnt from at most ``sample_rows`` labelled texts outside the held-out fold."""
    sample = labelled_sample(labels, id_col, label_col, folds, held, sample_rows)
    texts = sampled_texts(docs, sample, id_col, text_col).select("_id", "_label", "_text")
    kind = texts.schema["_id"].dataType.simpleString()
    rows = texts.mapInArrow(_feature_batches, f"_id {kind}, _label int, _index array<int>, _value array<float>").toArrow()
    model = Leader()
    order = np.argsort([hash_order(x) for x in rows["_id"].to_pylist()])
    label, index, value = rows["_label"].to_numpy(), rows["_index"].combine_chunks(), rows["_value"].combine_chunks()
    for _ in range(passes):
        for i in order:
            model.update(index[int(i)].values.to_numpy(), value[int(i)].values.to_numpy(), int(label[i]))
    return model.weights().astype(np.float32)


def hash_order(x) -> int:
    """An order of training that does not follow the ids, which are numbers or texts."""
    if isinstance(x, int):
        return (x * 0x9E3779B97F4A7C15) % (1 << 64)
    return int.from_bytes(hashlib.blake2b(str(x).encode(), digest_size=8).digest(), "big")


def score(docs: DataFrame, text_col: str, weights: np.ndarray, into: str = "score") -> DataFrame:
    """``docs`` with a double column ``into``: the probability of label 1 for the whole text."""
    keep = [c for c in docs.columns if c.lower() != into.lower()]
    place = keep.index(text_col)

    def scored(batches):
        for batch in batches:
            logit = np.full(batch.num_rows, weights[-1], np.float64)
            for row, end, data, offsets in text_slices(batch.column(place)):
                total, n = np.zeros(end - row), np.zeros(end - row)
                for found, first in features_of(data, offsets):
                    total += row_sums(weights[found].astype(np.float64), first)
                    n += np.diff(first)
                logit[row:end] += SCALE * total / np.maximum(n, 1)
            p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p)], names=[*batch.schema.names, into])
        give_back()

    kept = docs.select(*[docs[c] for c in keep])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(scored, f"{schema}, `{into}` double")


def classified(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
               folds: int = 4, held: int = 2, threshold: float = 0.7) -> DataFrame:
    """``docs`` with score and predicted (1 if score >= threshold, else 0); labels and fold as in ``train``."""
    weights = train(docs, labels, id_col, text_col, label_col, folds, held)
    out = score(docs, text_col, weights)
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
