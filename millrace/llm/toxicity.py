"""Toxicity: a bidirectional gated recurrent network with attention pooling over windows of words.

A step of the network is a word: its own embedding next to the mean of the embeddings of its character n-grams (3 to 5
characters, word ends marked), so spellings that were never seen still say something.  Embeddings are hashed tables.  One
gated unit layer reads a window forwards, another backwards; attention weighs the words, and a logistic unit scores the
pooled state.  A text is cut into windows of ``WINDOW`` words that overlap by half; all are scored, and the highest score
is the text's.  Everything is numpy; training is by Adam on bags of windows, in which the window that scores highest answers
for its text.

Training reads a bounded sample of labelled texts (``sample_rows``, whole texts, as word numbers) on the driver; scoring runs over Arrow batches.
The inputs of a word's step depend on the word alone, so each distinct word of a batch is computed once.

Defined results: a null text or one without words is a window of padding only and gets the score the network gives it; without any labelled
row every score is 0; very long texts are scored whole, window by window; repeated rows get the same score each; of windows with equal scores
either gives the text's; an empty table gives an empty result; further columns are kept, those named like a result column, in whatever case,
are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrays import WORD_BYTES, mixed, span_hashes, spans, text_slices
from millrace.llm.learning import labelled_sample, sampled_texts, unused

WINDOW, STRIDE = 32, 16
WORD_BITS, CHAR_BITS = 16, 17
WORD_SIZE, CHAR_SIZE, HIDDEN = 8, 12, 8
GRAMS = (3, 4, 5)
#: A row of an embedding that fewer sampled texts than this have stays zero: what one text alone says is not learnt by heart.
LEAST_TEXTS = 4


def word_inputs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Per word: the number of its word embedding; the numbers of its character n-grams and the first one of each word."""
    words = (span_hashes(data, starts, ends) >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    n = len(starts)
    if n == 0:
        return words, np.zeros(0, np.int32), np.zeros(1, np.int64)
    # The bytes of the words with a mark before and after each.
    lengths = ends - starts + 2
    first = np.zeros(n + 1, np.int64)
    np.cumsum(lengths, out=first[1:])
    marked = np.ones(first[-1], np.uint64)
    inside = np.ones(first[-1], bool)
    inside[first[:-1]] = inside[first[1:] - 1] = False
    source = np.arange(first[-1]) - np.repeat(first[:-1] - starts + 1, lengths)
    marked[inside] = data[source[inside]].astype(np.uint64) + np.uint64(2)
    left = np.repeat(first[1:], lengths) - np.arange(first[-1])
    rolled, found, fits = marked.copy(), [], []
    for k in range(2, max(GRAMS) + 1):
        ahead = np.zeros(len(marked), np.uint64)
        ahead[: max(0, len(marked) - k + 1)] = marked[k - 1 :]
        rolled = rolled * np.uint64(0xD6E8FEB86659FD93) + ahead
        if k in GRAMS:
            found.append((mixed(rolled + np.uint64(k)) >> np.uint64(64 - CHAR_BITS)).astype(np.int32))
            fits.append(left >= k)
    # All n-grams that begin at a place stand together, so those of a word do too.
    fits = np.stack(fits, axis=1)
    gram_first = np.append(0, np.cumsum(fits.sum(axis=1)))[first]
    return words, np.stack(found, axis=1)[fits], gram_first


def windows_of(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all windows of a batch, -1 for padding, and the row of each window."""
    counts = np.diff(first)
    per_row = np.where(counts > WINDOW, -(-(counts - WINDOW) // STRIDE) + 1, 1)
    rows = np.repeat(np.arange(len(counts)), per_row)
    begun = (np.arange(len(rows)) - np.repeat(np.cumsum(per_row) - per_row, per_row)) * STRIDE
    places = begun[:, None] + np.arange(WINDOW)
    return np.where(places < counts[rows][:, None], places + first[:-1][rows][:, None], -1), rows


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Network:
    """Parameters: embeddings; per direction input, recurrent weights and bias of the gates (update, reset, candidate); attention; output."""

    seed: int = 7
    p: dict[str, np.ndarray] = field(default_factory=dict)

    def __post_init__(self):
        if self.p:
            return
        rng = np.random.default_rng(self.seed)
        size, h = WORD_SIZE + CHAR_SIZE, HIDDEN
        draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        self.p = {"word": draw(1 << WORD_BITS, WORD_SIZE, scale=0.1), "char": draw(1 << CHAR_BITS, CHAR_SIZE, scale=0.1)}
        for d in "fb":
            self.p[f"x{d}"] = draw(size, 3 * h, scale=size**-0.5)
            self.p[f"u{d}"] = draw(h, 3 * h, scale=h**-0.5)
            self.p[f"c{d}"] = np.zeros(3 * h, np.float32)
        self.p |= {"attend": draw(2 * h, h, scale=0.3), "query": draw(h, scale=0.5), "out": draw(2 * h, scale=0.3), "bias": np.array([-2.0], np.float32)}

    def inputs(self, words, grams, gram_first) -> np.ndarray:
        """The input of each distinct word."""
        out = np.zeros((len(words), WORD_SIZE + CHAR_SIZE), self.p["char"].dtype)
        out[:, :WORD_SIZE] = self.p["word"][words]
        for a in range(0, len(words), 10_000):  # every word has n-grams, and their vectors are many
            b = min(a + 10_000, len(words))
            first = gram_first[a : b + 1]
            sums = np.add.reduceat(self.p["char"][grams[first[0] : first[-1]]], first[:-1] - first[0], axis=0)
            out[a:b, WORD_SIZE:] = sums / np.sqrt(np.diff(first))[:, None]
        return out

    def projected(self, x: np.ndarray) -> dict[str, np.ndarray]:
        """What each distinct word adds to the gates, per direction; the last row is what padding reads."""
        return {d: np.concatenate([x @ self.p[f"x{d}"] + self.p[f"c{d}"], np.zeros((1, 3 * HIDDEN), x.dtype)]) for d in "fb"}

    def forward(self, project: dict[str, np.ndarray], windows: np.ndarray, keep: bool = False):
        """Logits of windows (numbers of distinct words, -1 for padding); padding leaves the state as it is.

        Arrays hold one column per window, so every operation runs over long rows.
        """
        n, h = len(windows), HIDDEN
        at = np.ascontiguousarray(windows.T)
        kind = project["f"].dtype
        there = (at >= 0).astype(kind)
        states, trace = np.empty((WINDOW, 2 * h, n), kind), {}
        for d, order, part in (("f", range(WINDOW), slice(0, h)), ("b", range(WINDOW - 1, -1, -1), slice(h, 2 * h))):
            gate, candidate = np.ascontiguousarray(self.p[f"u{d}"][:, : 2 * h].T), np.ascontiguousarray(self.p[f"u{d}"][:, 2 * h :].T)
            s, steps, own = np.zeros((h, n), kind), [], project[d]
            for t in order:
                a = np.ascontiguousarray(own[at[t]].T)
                gates = sigmoid(a[: 2 * h] + gate @ s)
                z, r = gates[:h], gates[h:]
                c = np.tanh(a[2 * h :] + candidate @ (r * s))
                if keep:
                    steps.append((t, s, z, r, c))
                s = s + (z * there[t]) * (c - s)
                states[t, part] = s
            trace[d] = steps
        seen = np.tanh(self.p["attend"].T @ states)
        weight = np.where(there > 0, np.einsum("k,tkn->tn", self.p["query"], seen), np.asarray(-1e9, kind))
        weight = np.exp(weight - weight.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = np.einsum("tn,tkn->kn", weight, states)
        logits = self.p["out"] @ pooled + self.p["bias"][0]
        return logits, (states, seen, weight, pooled, trace, at, there)

    def gradients(self, x, words, grams, gram_first, windows, labels) -> dict[str, np.ndarray]:
        """Gradients of the mean logistic loss; those of the embeddings as (rows, values)."""
        h, p = HIDDEN, self.p
        logits, (states, seen, weight, pooled, trace, at, there) = self.forward(self.projected(x), windows, keep=True)
        dl = ((sigmoid(logits) - labels) / len(windows)).astype(x.dtype)
        g = {"out": pooled @ dl, "bias": np.array([dl.sum()], x.dtype)}
        dpool = p["out"][:, None] * dl
        dstates = weight[:, None, :] * dpool
        dweight = np.einsum("tkn,kn->tn", states, dpool)
        dscore = weight * (dweight - (weight * dweight).sum(axis=0))
        g["query"] = np.einsum("tn,tkn->k", dscore, seen)
        dseen = dscore[:, None, :] * p["query"][:, None] * (1 - seen * seen)
        g["attend"] = np.einsum("tkn,tjn->kj", states, dseen, optimize=True)
        dstates += p["attend"] @ dseen
        dx = np.zeros_like(x)
        for d, part in (("f", slice(0, h)), ("b", slice(h, 2 * h))):
            gate, candidate = p[f"u{d}"][:, : 2 * h], p[f"u{d}"][:, 2 * h :]
            du, ds = np.zeros_like(p[f"u{d}"]), np.zeros((h, len(windows)), x.dtype)
            da_all = np.empty((WINDOW, 3 * h, len(windows)), x.dtype)
            for t, s, z, r, c in reversed(trace[d]):
                ds = ds + dstates[t, part]
                on = ds * there[t]
                da = da_all[t]
                da[:h] = on * (c - s) * z * (1 - z)
                da[2 * h :] = dc = on * z * (1 - c * c)
                drs = candidate @ dc
                da[h : 2 * h] = drs * s * r * (1 - r)
                du[:, : 2 * h] += s @ da[: 2 * h].T
                du[:, 2 * h :] += (r * s) @ dc.T
                ds = ds - on * z + drs * r + gate @ da[: 2 * h]
            flat, values = at.reshape(-1), da_all.transpose(0, 2, 1).reshape(-1, 3 * h)
            order = np.argsort(flat, kind="stable")
            numbers, begun = np.unique(flat[order], return_index=True)
            sums = np.add.reduceat(values[order], begun, axis=0)
            dproject = np.zeros((len(x), 3 * h), x.dtype)
            dproject[numbers[numbers >= 0]] = sums[numbers >= 0]
            g[f"u{d}"], g[f"x{d}"], g[f"c{d}"] = du, x.T @ dproject, dproject.sum(axis=0)
            dx += dproject @ p[f"x{d}"].T
        g["word"] = (words, dx[:, :WORD_SIZE])
        count = np.diff(gram_first)
        g["char"] = (grams, np.repeat(dx[:, WORD_SIZE:] / np.sqrt(np.maximum(1, count))[:, None], count, axis=0))
        return g


class Adam:
    """Adam; an embedding row is updated only when it took part."""

    def __init__(self, p: dict[str, np.ndarray], learnt: dict[str, np.ndarray], rate: float = 0.01):
        self.p, self.learnt, self.rate, self.t = p, learnt, rate, 0
        self.m, self.v = {k: np.zeros_like(x) for k, x in p.items()}, {k: np.zeros_like(x) for k, x in p.items()}

    def step(self, gradients: dict) -> None:
        self.t += 1
        rate = self.rate * np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
        for k, g in gradients.items():
            at = slice(None)
            if isinstance(g, tuple):
                taken = np.flatnonzero(self.learnt[k][g[0]])
                if len(taken) == 0:
                    continue
                order = taken[np.argsort(g[0][taken], kind="stable")]
                at, begun = np.unique(g[0][order], return_index=True)
                g = np.add.reduceat(g[1][order], begun, axis=0)
            self.m[k][at] = 0.9 * self.m[k][at] + 0.1 * g
            self.v[k][at] = 0.999 * self.v[k][at] + 0.001 * g * g
            self.p[k][at] -= rate * self.m[k][at] / (np.sqrt(self.v[k][at]) + 1e-6)


def distinct_words(data: np.ndarray, offsets: np.ndarray):
    """Inputs of the distinct words of some rows, the number of the distinct word at each place, and the first place of each row."""
    starts, ends, first = spans(WORD_BYTES[data], offsets)
    _, at, inverse = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
    return word_inputs(data, starts[at], ends[at]), inverse, first


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", folds: int = 5,
          held: int = 0, sample_rows: int = 3000, updates: int = 400) -> Network | None:
    """A network learnt from at most ``sample_rows`` labelled whole texts outside the held-out fold; None without any."""
    sample = labelled_sample(labels, id_col, label_col, folds, held, sample_rows)
    rows = sampled_texts(docs, sample, id_col, text_col).select("_id", "_label", F.lower(F.coalesce("_text", F.lit(""))).alias("text")).toArrow()
    if rows.num_rows == 0:
        return None
    order = np.argsort(rows["_id"].to_numpy())
    return fit(rows["text"].combine_chunks().take(pa.array(order)), rows["_label"].to_numpy()[order], updates)


def words_of_sample(texts: pa.Array):
    """The same for all texts of the sample, which is bounded, but slice by slice, so that only the distinct words are held."""
    keys, inputs, places, counts = [], [], [], []
    for _, _, data, offsets in text_slices(texts):
        starts, ends, first = spans(WORD_BYTES[data], offsets)
        own, at, inverse = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        keys.append(own)
        inputs.append(word_inputs(data, starts[at], ends[at]))
        places.append(inverse)
        counts.append(np.diff(first))
    known, taken = np.unique(np.concatenate(keys), return_index=True)
    words = np.concatenate([w for w, _, _ in inputs])[taken]
    sizes = np.concatenate([np.diff(f) for _, _, f in inputs])
    begins = (np.cumsum(sizes) - sizes)[taken]
    gram_first = np.append(0, np.cumsum(sizes[taken]))
    source = np.arange(gram_first[-1]) + np.repeat(begins - gram_first[:-1], sizes[taken])
    grams = np.concatenate([g for _, g, _ in inputs])[source]
    inverse = np.concatenate([np.searchsorted(known, k)[p] for k, p in zip(keys, places)])
    return (words, grams, gram_first), inverse, np.append(0, np.cumsum(np.concatenate(counts)))


def fit(texts: pa.Array, label: np.ndarray, updates: int = 400, passes: int = 16, batch: int = 64, dropped: float = 0.25) -> Network:
    """Bags of windows: after a start with random ones, the window that scores highest answers for a toxic text, and the two
    highest for a clean one.

    Toxic texts are repeated until they are a third of the bags, so that a rare label is learnt too.  A share of the words is
    left out at random in every update, so no single word is relied on.
    """
    network, rng = Network(), np.random.default_rng(11)
    label = label.astype(np.float32)
    (words, grams, gram_first), inverse, first = words_of_sample(texts)
    pairs = np.unique(np.repeat(np.arange(len(label)), np.diff(first)) * (len(words) + 1) + inverse)
    texts_with = np.bincount(pairs % (len(words) + 1), minlength=len(words))
    learnt = {
        "word": np.bincount(words, texts_with, 1 << WORD_BITS) >= LEAST_TEXTS,
        "char": np.bincount(grams, np.repeat(texts_with, np.diff(gram_first)), 1 << CHAR_BITS) >= LEAST_TEXTS,
    }
    for name, rows in learnt.items():
        network.p[name][~rows] = 0
    adam = Adam(network.p, learnt)
    places, row = windows_of(first)
    windows = np.where(places >= 0, np.append(inverse, 0)[places], -1)
    bounds = np.searchsorted(row, np.arange(len(label) + 1))
    toxic = np.flatnonzero(label == 1)
    more = int(np.clip(len(label) // (3 * max(1, len(toxic))), 1, 20))
    bags = np.concatenate([np.flatnonzero(label == 0), np.repeat(toxic, more)])
    done, updates = 0, min(updates, passes * max(1, 2 * len(bags) // batch))
    sizes = bounds[bags + 1] - bounds[bags]
    while done < updates:
        if done < updates / 2:
            # At first no score can be trusted: windows are drawn at random, and what toxic texts share stands out.
            chosen = np.concatenate([bounds[bags] + rng.integers(0, sizes) for _ in range(2)])
        else:
            scores = all_logits(network, network.inputs(words, grams, gram_first), windows)
            ranked = np.lexsort((-scores, row))
            second = bags[(label[bags] == 0) & (sizes > 1)]
            chosen = np.concatenate([ranked[bounds[bags]], ranked[bounds[second] + 1]])
        answer = label[row[chosen]]
        shuffled = rng.permutation(len(chosen))
        for some in np.array_split(shuffled, max(1, len(shuffled) // batch)):
            adam.rate = 0.01 * max(0.1, 1 - done / updates)
            shown = np.where(rng.random((len(some), WINDOW)) < dropped, -1, windows[chosen[some]])
            own, local = np.unique(shown, return_inverse=True)
            local = local.reshape(len(some), WINDOW)
            if own[0] < 0:
                own, local = own[1:], local - 1
            spread = np.concatenate([np.arange(gram_first[w], gram_first[w + 1]) for w in own]) if len(own) else np.zeros(0, np.int64)
            own_first = np.concatenate([[0], np.cumsum(gram_first[own + 1] - gram_first[own])]).astype(np.int64)
            inputs = (words[own], grams[spread], own_first)
            adam.step(network.gradients(network.inputs(*inputs), *inputs, local, answer[some]))
            done += 1
            if done == updates:
                break
    return network


def all_logits(network: Network, x: np.ndarray, windows: np.ndarray, block: int = 1024) -> np.ndarray:
    project = network.projected(x)
    return np.concatenate([network.forward(project, windows[at : at + block])[0] for at in range(0, len(windows), block)])


def scores_of(network: Network, column: pa.Array) -> np.ndarray:
    """The highest window score of each whole text (lower case)."""
    out = np.zeros(len(column))
    for row, end, data, offsets in text_slices(column):
        inputs, inverse, first = distinct_words(data, offsets)
        x = network.inputs(*inputs)
        places, owner = windows_of(first)
        logits = all_logits(network, x, np.where(places >= 0, np.append(inverse, 0)[places], -1))
        best = np.full(end - row, -np.inf)
        np.maximum.at(best, owner, logits)
        out[row:end] = 1 / (1 + np.exp(-np.clip(best, -30, 30)))
    return out


def score(docs: DataFrame, text_col: str, network: Network | None, into: str = "score") -> DataFrame:
    """``docs`` with a double column ``into``: how toxic the worst window of the whole text is."""
    keep = [c for c in docs.columns if c.lower() != into.lower()]

    def scored(batches):
        for batch in batches:
            values = scores_of(network, batch.column(len(keep))) if network else np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(values)], names=[*keep, into])

    kept = docs.select(*[docs[c] for c in keep])
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.schema.fields)
    return docs.select(*[docs[c] for c in keep], F.lower(docs[text_col]).alias(unused("lower", keep))).mapInArrow(scored, f"{schema}`{into}` double")
