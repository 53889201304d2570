"""Texts as arrays of code points, cut into the words of a tokenizer by array operations, and words as ids seen before.

The cuts follow from the kind of each character: space, letter, number or other.  Kinds and lower case are taken from Unicode's own
tables, but only for characters that Unicode 3.2 had and that are of the same kind today, so no library's version can
disagree; a stretch without spaces that holds any other character is one piece for the tokenizers library.  A text with a special token
in it goes to the library whole, since such a token cuts a text wherever it stands.

Words are looked up by a 64-bit hash; words above 64 characters by one that nobody can aim at.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Callable
from functools import lru_cache
from itertools import chain

import numpy as np

from millrace.llm.arrays import span_hashes

SPACE, LETTER, NUMBER, OTHER, ODD = range(5)
#: The white space of Unicode, and the endings that are words of their own.
SPACES = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
LONG = 64
APOSTROPHE, BLANK = 0x27, 0x20


def _kind(category: str) -> int:
    return LETTER if category[0] == "L" else NUMBER if category[0] == "N" else OTHER


@lru_cache(maxsize=1)
def tables() -> tuple[np.ndarray, np.ndarray]:
    """Kind and lower case of every code point; beyond the first 65536 all are odd."""
    old = unicodedata.ucd_3_2_0
    kinds, lower = np.full(0x110000, ODD, np.uint8), np.arange(0x110000, dtype=np.uint32)
    for c in range(0x10000):
        now, then = unicodedata.category(chr(c)), old.category(chr(c))
        if now in ("Cn", "Cs") or then == "Cn" or _kind(now) != _kind(then) or (now[0] == "Z") != (then[0] == "Z"):
            continue
        small = chr(c).lower()
        # Separators that are no white space for the tokenizers, but are for Python.
        if len(small) == 1 and not 0x1C <= c <= 0x1F:
            kinds[c], lower[c] = _kind(now), ord(small)
    kinds[SPACES] = SPACE
    return kinds, lower


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all texts, and the place where each begins (one more entry than texts)."""
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    return np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32), offsets


def kinds_of(points: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The kind of every character; all of a stretch without spaces are odd if one is."""
    kinds = tables()[0][points]
    if (kinds == ODD).any():
        first = _first_of_runs((kinds == SPACE).astype(np.uint8), offsets)
        starts = np.flatnonzero(first)
        odd = np.add.reduceat((kinds == ODD).astype(np.int64), starts) > 0
        kinds = np.where(odd[np.cumsum(first) - 1], np.uint8(ODD), kinds)
    return kinds


def _first_of_runs(kinds: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    first = np.ones(len(kinds), bool)
    first[1:] = kinds[1:] != kinds[:-1]
    edges = offsets[:-1]
    first[edges[edges < len(kinds)]] = True
    return first


def runs_of(kinds: np.ndarray, offsets: np.ndarray, alone: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and kind of every run of one kind within a text; characters of the kind ``alone`` are runs of their own."""
    if len(kinds) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), kinds
    first = _first_of_runs(kinds, offsets)
    if alone is not None:
        first |= kinds == alone
    starts = np.flatnonzero(first)
    return starts, np.append(starts[1:], len(kinds)), kinds[starts]


def endings(points: np.ndarray, starts: np.ndarray, ends: np.ndarray, kinds: np.ndarray, row: np.ndarray, free: np.ndarray) -> np.ndarray:
    """For every run, how many letters of the next run belong to it: those of an ending after a single apostrophe that is ``free``."""
    taken = np.zeros(len(starts), np.int64)
    mark = np.flatnonzero((kinds[:-1] == OTHER) & (ends[:-1] - starts[:-1] == 1) & (points[starts[:-1]] == APOSTROPHE) & (kinds[1:] == LETTER) & (row[1:] == row[:-1]) & free[:-1])
    if len(mark):
        begin, size = starts[mark + 1], ends[mark + 1] - starts[mark + 1]
        padded = np.append(points, [0, 0]).astype(np.uint32)
        for ending in ENDINGS:
            fits = (size >= len(ending)) & (taken[mark] == 0)
            for k, letter in enumerate(ending):
                fits &= padded[np.minimum(begin + k, len(points))] == ord(letter)
            taken[mark[fits]] = len(ending)
    return taken


def _rows(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.searchsorted(offsets, starts, "right") - 1


Words = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def plain_words(points: np.ndarray, offsets: np.ndarray, kinds: np.ndarray) -> Words:
    """Start, end, kind and text of the words without white space: runs of letters, single numbers, endings, runs of others.

    ``points`` is in lower case.
    """
    starts, ends, kind = runs_of(kinds, offsets, alone=NUMBER)
    real = kind != SPACE
    rows = _rows(starts, offsets)
    if len(starts):
        taken = endings(points, starts, ends, kind, rows, np.ones(len(starts), bool))
        ends = ends + taken
        starts = starts + np.append(0, taken[:-1])
        real &= starts < ends
    return starts[real], ends[real], kind[real], rows[real]


def spaced_words(points: np.ndarray, offsets: np.ndarray, kinds: np.ndarray) -> Words:
    """The same for byte-level vocabularies: a blank before a word belongs to it, and other white space is made of words too."""
    starts, ends, kind = runs_of(kinds, offsets)
    rows = _rows(starts, offsets)
    if not len(starts):
        return starts, ends, kind, rows
    space = kind == SPACE
    followed = np.append(space[:-1] & (rows[1:] == rows[:-1]), False)
    blank = followed & (points[ends - 1] == BLANK)
    after_blank = np.append(False, blank[:-1])
    taken = endings(points, starts, ends, kind, rows, ~after_blank)
    # The blank goes to the next word; another last space before a word is one of its own.
    own_ends = np.where(followed, ends - 1, ends + taken)
    own_starts = starts - after_blank + np.append(0, taken[:-1])
    single = np.flatnonzero(followed & ~blank)
    all_starts = np.concatenate([own_starts, ends[single] - 1])
    all_ends = np.concatenate([own_ends, ends[single]])
    real = np.flatnonzero(all_starts < all_ends)
    order = real[np.argsort(all_starts[real], kind="stable")]
    return all_starts[order], all_ends[order], np.concatenate([kind, kind[single]])[order], np.concatenate([rows, rows[single]])[order]


def word_keys(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    keys = span_hashes(points, starts, ends)
    for i in np.flatnonzero(ends - starts > LONG):
        digest = hashlib.blake2b(points[starts[i] : ends[i]].tobytes(), digest_size=8).digest()
        keys[i] = np.frombuffer(digest, np.uint64)[0]
    return keys


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of the distinct key at each place, the distinct keys, and where each stands first."""
    known, first, codes = np.unique(keys, return_index=True, return_inverse=True)
    return codes, known, first


#: The ids of some words one after the other, and how many each word has.
Ids = tuple[np.ndarray, np.ndarray]


class Known:
    """The ids of words seen before in this process: sorted keys of words, and their ids in one array.

    When there are more than ``size`` words, those that were not met since the last time are forgotten; so memory is bounded and
    frequent words stay.
    """

    def __init__(self, size: int):
        self.size = size
        self.keys, self.begins, self.sizes, self.met = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        self.ids = np.zeros(0, np.uint32)

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each key stands or would stand, and whether it is there."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.searchsorted(self.keys, keys)
        return at, self.keys[np.minimum(at, len(self.keys) - 1)] == keys

    def add(self, keys: np.ndarray, at: np.ndarray, ids: Ids) -> None:
        """Sorted new keys, where they go, and their ids."""
        flat, sizes = ids
        begins = len(self.ids) + np.cumsum(sizes) - sizes
        self.ids = np.concatenate([self.ids, flat])
        self.keys, self.begins, self.sizes = (np.insert(old, at, new) for old, new in ((self.keys, keys), (self.begins, begins), (self.sizes, sizes)))
        self.met = np.insert(self.met, at, True)

    def forget(self) -> None:
        kept = np.flatnonzero(self.met)
        sizes = self.sizes[kept]
        self.ids = gathered(self.ids, self.begins[kept], sizes)
        self.keys, self.begins, self.sizes, self.met = self.keys[kept], np.cumsum(sizes) - sizes, sizes, np.zeros(len(kept), bool)

    def of(self, keys: np.ndarray, encode: Callable[[np.ndarray], Ids]) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of distinct keys begin in ``ids``, and how many they are; ``encode`` gets the places of those not seen before."""
        if len(self.keys) > self.size:
            self.forget()
        order = np.argsort(keys)  # in order, so that the search goes through memory once
        keys = keys[order]
        at, there = self.places(keys)
        if not there.all():
            self.add(keys[~there], at[~there], encode(order[~there]))
            at = at + np.cumsum(~there) - ~there
        self.met[at] = True
        begins, sizes = np.empty(len(keys), np.int64), np.empty(len(keys), np.int64)
        begins[order], sizes[order] = self.begins[at], self.sizes[at]
        return begins, sizes


def flat_ids(ids: list[list[int]]) -> Ids:
    sizes = np.array([len(x) for x in ids], np.int64)
    return np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum())), sizes


def chosen_ids(second: np.ndarray, a: Ids, b: Ids) -> Ids:
    """One list of ids per word out of two: from ``b`` where ``second`` is true, else from ``a``."""
    sizes, begins = np.empty(len(second), np.int64), np.empty(len(second), np.int64)
    for where, (_, own), offset in ((~second, a, 0), (second, b, len(a[0]))):
        sizes[where], begins[where] = own, np.cumsum(own) - own + offset
    return gathered(np.concatenate([a[0], b[0]]), begins, sizes), sizes


def gathered(values: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The pieces of ``values`` of the given places and sizes, one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.arange(total) + np.repeat(begins - (ends - sizes), sizes)]


class Pretokens:
    """The words of some texts, and their ids through a table of known words."""

    def __init__(self, texts: list[str], lower: bool):
        raw, self.offsets = code_points(texts)
        self.kinds = kinds_of(raw, self.offsets)
        if lower:
            # Odd stretches stay as they are: the library has its own lower case.
            points = np.where(self.kinds == ODD, raw, tables()[1][raw])
            self.starts, self.ends, self.kind, self.rows = plain_words(points, self.offsets, self.kinds)
        else:
            points = raw
            self.starts, self.ends, self.kind, self.rows = spaced_words(points, self.offsets, self.kinds)
        self.points, self.n = points, len(texts)
        keys = word_keys(points, self.starts, self.ends)
        # A stretch for the library is told from a word that looks alike.
        keys = np.where(self.kind == ODD, ~keys, keys)
        self.codes, self.keys, self.first = distinct(keys)

    def words(self, places=None) -> list[str]:
        """The distinct words, or those at some places among them."""
        at = self.first if places is None else self.first[places]
        sizes = self.ends[at] - self.starts[at]
        text = gathered(self.points, self.starts[at], sizes).tobytes().decode("utf-32-le")
        ends = np.cumsum(sizes).tolist()
        return [text[a:b] for a, b in zip([0, *ends], ends)]

    def odd(self, places) -> np.ndarray:
        return self.kind[self.first[places]] == ODD

    def ids(self, known: Known, by_method: Callable[[list[str]], Ids], by_library: Callable[[list[str]], Ids]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts and the place of the first id of each (one more entry than texts)."""

        def encode(new: np.ndarray) -> Ids:
            words, odd = self.words(new), self.odd(new)
            if not odd.any():
                return by_method(words)
            return chosen_ids(odd, by_method([w for w, o in zip(words, odd) if not o]), by_library([w for w, o in zip(words, odd) if o]))

        offsets = np.zeros(self.n + 1, np.int64)
        if not len(self.codes):
            return np.zeros(0, np.uint32), offsets
        begins, sizes = known.of(self.keys, encode)
        counts = sizes[self.codes]
        offsets[1:] = np.cumsum(np.bincount(self.rows, counts, self.n).astype(np.int64))
        return gathered(known.ids, begins[self.codes], counts), offsets


def special_pattern(added_tokens: list[dict]) -> re.Pattern:
    return re.compile("|".join(re.escape(t["content"]) for t in added_tokens) or "(?!)")


def with_whole_texts(ids: np.ndarray, offsets: np.ndarray, whole: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Ids and offsets with the ids of some rows, so far empty, put in."""
    if not whole:
        return ids, offsets
    parts, sizes, at = [], np.diff(offsets), 0
    for row in sorted(whole):
        parts += [ids[offsets[at] : offsets[row]], whole[row]]
        sizes[row], at = len(whole[row]), row
    parts.append(ids[offsets[at] :])
    return np.concatenate(parts), np.append(0, np.cumsum(sizes))


def portions(texts: list[str], size: int = 1 << 20):
    """Row ranges of about ``size`` characters; a longer text is a range of its own."""
    row = total = 0
    for i, text in enumerate(texts):
        total += len(text)
        if total >= size:
            yield row, i + 1
            row, total = i + 1, 0
    if row < len(texts):
        yield row, len(texts)
