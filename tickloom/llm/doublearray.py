"""Double-array tries over phrases of numbered words, walked by numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

FRESH = 64
ROUNDS = 200


def digits_of(largest: int) -> int:
    """Bytes that hold every number up to ``largest``."""
    return max(1, (int(largest).bit_length() + 7) // 8)


def _symbols(phrases: np.ndarray, digits: int) -> np.ndarray:
    """Bytes of the numbers of each phrase, the highest first."""
    shifts = 8 * np.arange(digits - 1, -1, -1)
    return ((phrases[:, :, None] >> shifts) & 255).reshape(len(phrases), -1)


@dataclass
class Trie:
    """``check[c]`` is the state that leads to state ``c``; from state ``s`` the byte
    ``b`` leads to ``base[s] + b``. The state at the end of a phrase holds the
    phrase's row in ``base``. State 0 is the root."""

    words: int
    digits: int
    base: np.ndarray
    check: np.ndarray

    @classmethod
    def of(cls, phrases: np.ndarray, digits: int) -> Trie:
        """A trie of distinct phrases (rows of word numbers) in ascending order."""
        count, words = phrases.shape
        symbols = _symbols(phrases, digits)
        node = np.zeros(count, np.int64)
        parents, bytes_, nodes = [], [], 1
        new = np.zeros(count, bool)
        new[:1] = True
        for level in range(symbols.shape[1]):
            new[1:] |= symbols[1:, level] != symbols[:-1, level]
            parents.append(node[new])
            bytes_.append(symbols[new, level])
            node = nodes + np.cumsum(new) - 1
            nodes += int(new.sum())
        parent, symbol = np.concatenate(parents), np.concatenate(bytes_)
        base = placed(parent, symbol)
        cells = int(base.max(initial=0)) + 256
        state = np.concatenate(([0], base[parent] + symbol))
        bases, check = np.zeros(cells, np.int32), np.full(cells, -1, np.int32)
        check[state[1:]] = state[parent]
        bases[state[: len(base)]] = base
        bases[state[node]] = np.arange(count)
        return cls(words, digits, bases, check)

    def walk(self, numbers: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the positions ``start`` of a row of word numbers begin a phrase,
        and the row of that phrase. All positions move on by a byte at a time."""
        alive, state = np.arange(len(start)), np.zeros(len(start), np.int32)
        for word in range(self.words):
            number = numbers[start[alive] + word]
            for digit in range(self.digits - 1, -1, -1):
                cell = self.base[state] + ((number >> (8 * digit)) & 255)
                moved = self.check[cell] == state
                alive, state, number = alive[moved], cell[moved], number[moved]
        return alive, self.base[state]


def placed(parent: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """A base for every inner node such that no two edges share a cell, and none is
    cell 0. Edges come by parent, parents count from 0 without gaps.

    Nodes of many edges get cells of their own one after the other. Smaller ones,
    the larger first, try random bases all at once, and the first to claim a cell has
    it. Nodes of one edge take what is free."""
    sizes = np.bincount(parent)
    first = np.concatenate(([0], np.cumsum(sizes)))
    base = np.zeros(len(sizes), np.int64)
    low, high = symbol[first[:-1]], symbol[first[1:] - 1]
    wide = np.flatnonzero(sizes >= FRESH)
    ends = np.cumsum(high[wide] - low[wide] + 1)
    base[wide] = 256 + ends - (high[wide] + 1)
    top = 256 + int(ends[-1]) if len(ends) else 256
    taken = np.zeros(max(2 * len(symbol), top) + 1024, bool)
    taken[:256] = True
    taken[base[parent[sizes[parent] >= FRESH]] + symbol[sizes[parent] >= FRESH]] = True
    draw = np.random.default_rng(1)
    upper = FRESH
    while upper > 2:
        lower = max(2, upper // 2)
        todo = np.flatnonzero((sizes >= lower) & (sizes < upper))
        tried = 0
        while len(todo):
            if tried == ROUNDS:
                taken, tried = np.concatenate([taken, np.zeros(len(taken), bool)]), 0
            tried += 1
            guess = draw.integers(256, len(taken) - 256, len(todo))
            counts = sizes[todo]
            owner = np.repeat(np.arange(len(todo)), counts)
            edges = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts) + first[todo][owner]
            cells = guess[owner] + symbol[edges]
            won = np.zeros(len(cells), bool)
            won[np.unique(cells, return_index=True)[1]] = True
            good = np.bincount(owner, won & ~taken[cells], len(todo)) == counts
            base[todo[good]] = guess[good]
            taken[cells[good[owner]]] = True
            todo = todo[~good]
        upper = lower
    single = np.flatnonzero(sizes == 1)
    free = np.flatnonzero(~taken)[: len(single)]
    if len(free) < len(single):
        free = np.append(free, len(taken) + np.arange(len(single) - len(free)))
    base[single] = free - symbol[first[single]]
    return base
