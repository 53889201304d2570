"""A minimal acyclic transducer from words to lists of token ids.

Words with equal endings share the states of those endings.  Every arc carries a number; the sum of the numbers along a word
is the rank of the word among the compiled words, and the ranks index the lists of ids.  The automaton is a handful of flat
arrays in one file, which each task maps into memory; a lookup walks all given words one byte at a time with array operations.
"""

from __future__ import annotations

import numpy as np

MAGIC = b"LEXICON1"


def compile_lexicon(entries: dict[bytes, list[int]]) -> bytes:
    """The file for the given words and ids; words are compiled in order of their bytes."""
    words = sorted(entries)
    # A state is a tuple (final, arcs); the register holds one number per distinct state.
    register: dict[tuple, int] = {}
    states: list[tuple] = []
    open_: list[list] = [[False, []]]  # per depth of the last word: final, [(byte, state or None)]
    last = b""

    def close(depth: int) -> None:
        while len(open_) > depth + 1:
            final, arcs = open_.pop()
            state = (final, tuple(arcs))
            number = register.setdefault(state, len(states))
            if number == len(states):
                states.append(state)
            open_[-1][1][-1] = (open_[-1][1][-1][0], number)

    for word in words:
        common = 0
        while common < min(len(word), len(last)) and word[common] == last[common]:
            common += 1
        close(common)
        for byte in word[common:]:
            open_[-1][1].append((byte, None))
            open_.append([False, []])
        open_[-1][0] = True
        last = word
    close(0)
    states.append((open_[0][0], tuple(open_[0][1])))

    below = np.zeros(len(states), np.int64)  # words accepted from each state; targets come before their sources
    keys, targets, ranks = [], [], []
    for number, (final, arcs) in enumerate(states):
        count = int(final)
        for byte, target in arcs:
            keys.append(number * 256 + byte)
            targets.append(target)
            ranks.append(count)
            count += below[target]
        below[number] = count
    offsets = np.zeros(len(words) + 1, np.int64)
    np.cumsum([len(entries[w]) for w in words], out=offsets[1:])
    parts = [
        np.array(keys, np.int64), np.array(targets, np.int64), np.array(ranks, np.int64),
        np.array([s[0] for s in states], np.int64), offsets, np.array([i for w in words for i in entries[w]], np.int64),
    ]
    header = np.array([len(p) for p in parts], np.int64)
    return MAGIC + header.tobytes() + b"".join(p.tobytes() for p in parts)


class Lexicon:
    """A compiled lexicon, mapped from its file."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            if file.read(len(MAGIC)) != MAGIC:
                raise ValueError(f"{path} is no lexicon")
        flat = np.memmap(path, np.int64, "r", offset=len(MAGIC))
        at, parts = 6, []
        for n in flat[:6]:
            parts.append(flat[at : at + int(n)])
            at += int(n)
        self.keys, self.targets, self.ranks, self.final, self.offsets, self.ids = parts

    def ranks_of(self, words: list[bytes]) -> np.ndarray:
        """The rank of each word, -1 for words that were not compiled."""
        n = len(words)
        out = np.full(n, -1, np.int64)
        if n == 0 or len(self.final) == 0:
            return out
        lengths = np.array([len(w) for w in words], np.int64)
        starts = np.cumsum(lengths) - lengths
        data = np.frombuffer(b"".join(words) + b"\0", np.uint8)
        live, state, rank = np.arange(n), np.full(n, len(self.final) - 1, np.int64), np.zeros(n, np.int64)
        depth = 0
        while len(live):
            ended = lengths[live] == depth
            done = live[ended]
            out[done] = np.where(self.final[state[ended]] == 1, rank[ended], -1)
            live, state, rank = live[~ended], state[~ended], rank[~ended]
            if len(live) == 0 or len(self.keys) == 0:
                break
            wanted = state * 256 + data[starts[live] + depth]
            at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            there = self.keys[at] == wanted
            live, at = live[there], at[there]
            state, rank = self.targets[at], rank[there] + self.ranks[at]
            depth += 1
        return out

    def ids_of(self, rank: int) -> list[int]:
        return self.ids[self.offsets[rank] : self.offsets[rank + 1]].tolist()

    def ids_of_all(self, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some ranks one after the other, and how many each has."""
        sizes = self.offsets[ranks + 1] - self.offsets[ranks]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.arange(total) + np.repeat(self.offsets[ranks] - (ends - sizes), sizes)].astype(np.uint32), sizes
