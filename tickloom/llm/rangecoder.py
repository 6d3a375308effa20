"""Adaptive range coding of blocks of token ids, many blocks in step.

Every block is coded with tables of its own that start empty, so it can be decoded
alone. For an id three predictions are mixed: the id that last followed the two before
it (order 2), the one that last followed the one before it (order 1), and the
frequencies of the ids the block has had (order 0), counted anew whenever these have
doubled. The shares of the three in the mix, and of ids that are new to the block, are
learned by how often both followers have been right in a row and whether they agree. An
id is coded as the prediction it is taken from and, for order 0, by its frequency; a new
one as it is, all ids of the vocabulary alike. Whole numbers throughout, so coder and
decoder agree on any machine.

A block is cut into ``LANES`` stretches of equal length, coded side by side with the
tables of the block; where lanes write to one cell, the last one counts. Ranges hold 33
to 48 bits and a step takes 16 of them at most, so a lane passes on no more than a word a
step. Carries are added to the words when all are known."""

from __future__ import annotations

import numpy as np

LANES = 8
WORD, AHEAD = 16, 3
BOTTOM, TOP = 1 << 32, 1 << 48
ORDER_2, ORDER_1, ORDER_0, NEW = range(4)
SLOT_BITS, TRUST, MOST_TRUST = 11, 1 << 16, 3 << 16
PLACES = 32  # trust of order 2 and of order 1, and whether they agree
FIRST_COUNT, MOST_COUNTED = 2, (1 << 15) // LANES

# where the shares of the four kinds begin, as four fields of a number
SHARE_BITS, FIELD, RATE, LEAST = 15, 0xFFFF, 4, 32
SHIFTS = np.arange(0, 64, 16)
KEPT = sum((FIELD >> RATE) << shift for shift in range(0, 64, 16))
LAST_END = np.int64(-1 << 63)


def _fields(begins: list[int]) -> int:
    return sum(begin << shift for begin, shift in zip(begins, range(0, 64, 16), strict=True))


EVEN = _fields([k << (SHARE_BITS - 2) for k in range(4)])
STEPS = np.array(
    [
        _fields([(k * LEAST if k <= kind else (1 << SHARE_BITS) - (4 - k) * LEAST) >> RATE for k in range(4)])
        for kind in range(4)
    ]
)


class Encoder:
    def __init__(self, lanes: int, longest: int) -> None:
        self.low = np.zeros(lanes, np.int64)
        self.range = np.full(lanes, TOP, np.int64)
        self.words = np.zeros((lanes, 2 * longest + 1), np.uint32)
        self.flat = self.words.reshape(-1)
        self.first = np.arange(lanes) * self.words.shape[1]
        self.at = self.first.copy()

    def code(self, lane, part: np.ndarray, start: np.ndarray, width: np.ndarray) -> None:
        """Narrow lanes (a slice from 0, or their numbers) to [start, start + width) of
        as many parts."""
        low, span = self.low[lane] + part * start, part * width
        go = (span < BOTTOM).nonzero()[0]
        passed, out = go if isinstance(lane, slice) else lane[go], low[go]
        at = self.at[passed]
        self.flat[at] = out >> 32
        self.at[passed] = at + 1
        low[go] = (out & (BOTTOM - 1)) << WORD
        span[go] <<= WORD
        self.low[lane], self.range[lane] = low, span

    def finish(self) -> tuple[np.ndarray, np.ndarray]:
        """The words of all lanes, one lane after the other, and their numbers."""
        self.flat[self.at] = (self.low + (BOTTOM - 1)) >> 32
        sizes = self.at + 1 - self.first
        words = self.words[:, : sizes.max()]
        while (carry := words >> WORD).any():
            words &= (1 << WORD) - 1
            words[:, :-1] += carry[:, 1:]
        return words[np.arange(words.shape[1]) < sizes[:, None]].astype("<u2"), sizes


class Decoder:
    def __init__(self, words: np.ndarray, sizes: np.ndarray) -> None:
        """``words`` of all lanes as written; those after the last of a lane are 0."""
        gaps = np.arange(len(sizes)) * (AHEAD - 1)
        self.words = np.zeros(len(words) + len(sizes) * (AHEAD - 1), np.uint16)
        self.words[np.arange(len(words)) + np.repeat(gaps, sizes)] = words
        self.at = np.cumsum(sizes) - sizes + gaps
        self.head = np.zeros(len(sizes), np.int64)
        for _ in range(AHEAD):
            self.head = self.head << WORD | self.words[self.at]
            self.at += 1
        self.range = np.full(len(sizes), TOP, np.int64)

    def take(self, lane, part: np.ndarray, start: np.ndarray, width: np.ndarray) -> None:
        head, span = self.head[lane] - part * start, part * width
        go = (span < BOTTOM).nonzero()[0]
        passed = go if isinstance(lane, slice) else lane[go]
        at = self.at[passed]
        head[go] = head[go] << WORD | self.words[at]
        self.at[passed] = at + 1
        span[go] <<= WORD
        self.head[lane], self.range[lane] = head, span


class Followers:
    """What followed in each block: ids by order 2 and order 1, with a trust of 0 to 3,
    and the shares of the mix for every trust."""

    def __init__(self, blocks: int) -> None:
        self.table = np.zeros(2 * blocks << SLOT_BITS, np.int32)
        block = np.repeat(np.arange(blocks), LANES)
        self.base = np.stack([block, block + blocks]) << SLOT_BITS
        self.shares = np.full(blocks * PLACES, EVEN)
        self.own = block * PLACES
        self.last = np.zeros((2, blocks * LANES), np.uint32)

    def look(self, n: int) -> None:
        """Guesses and shares of the first lanes for their next id."""
        before, last = self.last[:, :n]
        key = np.empty((2, n), np.uint32)
        np.multiply(before * np.uint32(0x9E3779B1) ^ last, np.uint32(0x85EBCA6B), out=key[0])
        np.multiply(last, np.uint32(0x9E3779B1), out=key[1])
        key >>= np.uint32(32 - SLOT_BITS)
        self.place = (self.base[:, :n] + key).reshape(-1)
        self.guess = self.table.take(self.place).reshape(2, n)
        trust = self.guess >> 16
        self.guess &= TRUST - 1
        self.trust = trust << 16
        trust[0] *= 4
        trust[0] += trust[1]
        self.cell = self.own[:n] + (trust[0] * 2 + (self.guess[0] == self.guess[1]))
        self.share = self.shares.take(self.cell)

    def spans(self, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the shares of the kinds start and how wide they are."""
        shift = SHIFTS.take(kind)
        start = (self.share >> shift) & FIELD
        return start, (((self.share >> 16 | LAST_END) >> shift) & FIELD) - start

    def kinds(self, target: np.ndarray) -> np.ndarray:
        """The kinds whose shares hold the targets."""
        first = target >= (self.share >> 16) & FIELD
        second = target >= (self.share >> 32) & FIELD
        third = target >= self.share >> 48
        return first.view(np.int8) + second.view(np.int8) + third.view(np.int8)

    def learn(self, kind: np.ndarray, ids: np.ndarray) -> None:
        n = len(ids)
        self.shares[self.cell] = self.share - ((self.share >> RATE) & KEPT) + STEPS.take(kind)
        self.trust += TRUST
        np.minimum(self.trust, MOST_TRUST, out=self.trust)
        self.trust *= self.guess == ids
        self.trust += ids
        self.table[self.place] = self.trust.reshape(-1)
        self.last[0, :n] = self.last[1, :n]
        self.last[1, :n] = ids


class Frequencies:
    """How often each block has had its ids, as of the last count. The ids counted are
    thought in order, so that each has a run with a start and a length. New ids are runs
    of one among all ids."""

    def __init__(self, vocabulary: int) -> None:
        self.vocabulary = vocabulary
        self.next, self.total = FIRST_COUNT, 0

    def recent(self, t: int) -> slice:
        """The steps to count before step ``t``, each with ``LANES`` ids a block."""
        self.next += min(self.next, MOST_COUNTED)
        steps = slice(max(0, t - MOST_COUNTED), t)
        self.total = (steps.stop - steps.start) * LANES
        return steps


class Written(Frequencies):
    """Counts for coding: ids are numbered within their block first."""

    def __init__(self, ids: np.ndarray, vocabulary: int) -> None:
        super().__init__(vocabulary)
        steps, lanes = ids.shape
        self.number = np.empty((lanes // LANES, steps * LANES), np.int32)
        self.most = 1
        for at in range(0, len(self.number), 64):
            chunk = _by_block(ids[:, at * LANES : (at + 64) * LANES])
            order = np.argsort(chunk, axis=1, kind="stable")
            sorted_ = np.take_along_axis(chunk, order, 1)
            new = np.zeros(chunk.shape, np.int32)
            np.not_equal(sorted_[:, 1:], sorted_[:, :-1], out=new[:, 1:], casting="unsafe")
            new = new.cumsum(axis=1, dtype=np.int32)
            np.put_along_axis(self.number[at : at + 64], order, new, 1)
            self.most = max(self.most, int(new[:, -1].max(initial=0)) + 1)
        blocks = len(self.number)
        self.number += (np.arange(blocks, dtype=np.int32) * self.most)[:, None]
        self.number = np.ascontiguousarray(
            self.number.reshape(blocks, steps, LANES).transpose(1, 0, 2).reshape(steps, lanes)
        )
        self.runs = np.zeros(blocks * self.most, np.int64)

    def count(self, t: int, lanes: int) -> None:
        blocks = lanes // LANES
        found = self.number[self.recent(t), :lanes].reshape(-1)
        lengths = np.bincount(found, minlength=blocks * self.most).reshape(blocks, self.most)
        self.runs = ((lengths.cumsum(axis=1) - lengths) << 32 | lengths).reshape(-1)

    def spans(self, t: int, lane: np.ndarray, ids: np.ndarray):
        """Whether the ids have been counted, and the start and width to code of each."""
        runs = self.runs.take(self.number[t].take(lane))
        width = runs & (BOTTOM - 1)
        had = width > 0
        return had, np.where(had, runs >> 32, ids), np.maximum(width, 1)


class Read(Frequencies):
    """Counts for decoding: a run for every place it covers, then all ids by themselves."""

    def __init__(self, vocabulary: int) -> None:
        super().__init__(vocabulary)
        every = np.arange(vocabulary)
        self.every = every | every << 16 | 1 << 40
        self.spots, self.plain = self.every, 0

    def count(self, ids: np.ndarray, t: int) -> None:
        ids = _by_block(ids[self.recent(t)])
        ids.sort(axis=1, kind="stable")
        first = np.ones(ids.shape, bool)
        np.not_equal(ids[:, 1:], ids[:, :-1], out=first[:, 1:])
        start = first.reshape(-1).nonzero()[0]
        lengths = np.diff(start, append=ids.size)
        runs = ids.reshape(-1)[start] | start % self.total << 16 | lengths << 40
        self.spots, self.plain = np.concatenate([np.repeat(runs, lengths), self.every]), ids.size

    def take(self, coder: Decoder, lane: np.ndarray, had: np.ndarray) -> np.ndarray:
        """Ids of the lanes that no follower has guessed."""
        part = coder.range[lane] // np.where(had, self.total, self.vocabulary)
        base = np.where(had, lane // LANES * self.total, self.plain)
        runs = self.spots.take(base + coder.head[lane] // part)
        coder.take(lane, part, (runs >> 16) & 0xFFFFFF, runs >> 40)
        return runs & FIELD


def _by_block(ids: np.ndarray) -> np.ndarray:
    """Rows of blocks from rows of steps."""
    steps, lanes = ids.shape
    return ids.astype(np.uint16).reshape(steps, lanes // LANES, LANES).transpose(1, 0, 2).reshape(-1, steps * LANES)


def encode(blocks: list[np.ndarray], vocabulary: int) -> list[bytes]:
    """Code every block of ids (below ``vocabulary``) by itself."""
    if not blocks:
        return []
    order, steps, active = _plan([len(b) for b in blocks], vocabulary)
    ids = np.zeros((int(steps[0]), len(blocks) * LANES), np.int32)
    for k, at in enumerate(order):
        padded = np.zeros(int(steps[k]) * LANES, np.int32)
        padded[: len(blocks[at])] = blocks[at]
        ids[: steps[k], k * LANES : (k + 1) * LANES] = padded.reshape(LANES, -1).T
    followers, counts = Followers(len(blocks)), Written(ids, vocabulary)
    coder = Encoder(ids.shape[1], len(ids))
    for t, n in enumerate(active):
        if t == counts.next:
            counts.count(t, n)
        now = ids[t, :n]
        followers.look(n)
        missed = followers.guess != now
        kind = missed[0].view(np.int8) + (missed[0] & missed[1])
        rest = (kind == ORDER_0).nonzero()[0]
        had, start, width = counts.spans(t, rest, now[rest])
        kind[rest] = np.where(had, ORDER_0, NEW)
        lanes = slice(0, n)
        coder.code(lanes, coder.range[lanes] >> SHARE_BITS, *followers.spans(kind))
        coder.code(rest, coder.range[rest] // np.where(had, counts.total, vocabulary), start, width)
        followers.learn(kind, now)
    words, sizes = coder.finish()
    sizes = sizes.reshape(-1, LANES)
    ends = np.cumsum(sizes.sum(axis=1))
    coded = [
        size.astype(_size_type(step)).tobytes() + words[end - size.sum() : end].tobytes()
        for size, step, end in zip(sizes, steps, ends, strict=True)
    ]
    return [coded[k] for k in np.argsort(order)]


def decode(blobs: list[bytes], sizes: list[int], vocabulary: int) -> list[np.ndarray]:
    """The ids of coded blocks, given their numbers."""
    if not blobs:
        return []
    order, steps, active = _plan(sizes, vocabulary)
    heads = [np.frombuffer(blobs[at], _size_type(step), LANES) for at, step in zip(order, steps, strict=True)]
    words = b"".join(blobs[at][head.nbytes :] for at, head in zip(order, heads, strict=True))
    coder = Decoder(np.frombuffer(words, "<u2"), np.concatenate(heads).astype(np.int64))
    ids = np.zeros((int(steps[0]), len(blobs) * LANES), np.int32)
    followers, counts = Followers(len(blobs)), Read(vocabulary)
    for t, n in enumerate(active):
        if t == counts.next:
            counts.count(ids[:, :n], t)
        followers.look(n)
        lanes = slice(0, n)
        part = coder.range[lanes] >> SHARE_BITS
        kind = followers.kinds(coder.head[lanes] // part)
        coder.take(lanes, part, *followers.spans(kind))
        now = np.where(kind == ORDER_2, *followers.guess)
        rest = (kind >= ORDER_0).nonzero()[0]
        now[rest] = counts.take(coder, rest, kind[rest] == ORDER_0)
        ids[t, :n] = now
        followers.learn(kind, now)
    found = [
        ids[:step, k * LANES : (k + 1) * LANES].T.reshape(-1)[: sizes[at]].astype(np.uint32)
        for k, (at, step) in enumerate(zip(order, steps, strict=True))
    ]
    return [found[k] for k in np.argsort(order)]


def _plan(sizes: list[int], vocabulary: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Blocks by falling size, their steps, and how many lanes have one left at each."""
    if not 0 < vocabulary < 1 << 16:
        raise ValueError("ids must be below 65,535")
    order = np.argsort(-np.asarray(sizes), kind="stable")
    steps = -(-np.asarray(sizes)[order] // LANES)
    return order, steps, LANES * np.searchsorted(-steps, -np.arange(int(steps[0])), "left")


def _size_type(steps: int) -> str:
    """How numbers of words of a block's lanes are written."""
    return "<u2" if 2 * steps + 1 < 1 << 16 else "<u4"
