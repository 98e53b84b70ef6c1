"""Signature trees: which of some sets of numbers are alike, found by pruning pairs of groups of them."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

#: Children of a node, doc pairs checked between looks at what is already joined, and bits of a bitmap.
FANOUT, STEP, BITS = 8, 4096, (512, 65_536)


def alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, for sorted arrays without repeats."""
    if len(x) > len(y):
        x, y = y, x
    if 100 * len(x) < percent * len(y):
        return False
    at = np.searchsorted(y, x)
    both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


class Level:
    """Nodes of one height: bitmaps of all tokens below, the range of set sizes, and the most tokens that share a bit."""

    def __init__(self, bitmap: np.ndarray, low: np.ndarray, high: np.ndarray, hidden: np.ndarray):
        self.bitmap, self.low, self.high, self.hidden = bitmap, low, high, hidden

    @classmethod
    def of_sets(cls, sets: Sequence[np.ndarray], bits: int) -> Level:
        size = np.fromiter(map(len, sets), np.int64, len(sets))
        flags = np.zeros((len(sets), bits), bool)
        for row, tokens in enumerate(sets):
            flags[row, tokens & np.uint64(bits - 1)] = True
        bitmap = np.packbits(flags, axis=1).view(np.uint64)
        return cls(bitmap, size, size, size - flags.sum(axis=1))

    def above(self) -> Level:
        begin = np.arange(0, len(self.low), FANOUT)
        return Level(
            np.bitwise_or.reduceat(self.bitmap, begin, axis=0),
            np.minimum.reduceat(self.low, begin),
            np.maximum.reduceat(self.high, begin),
            np.maximum.reduceat(self.hidden, begin),
        )

    def may_hold(self, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
        """Whether a set below node a can be alike to one below node b.

        Two sets share at most the bits that both bitmaps have and the tokens hidden behind other
        tokens' bits, and need percent / (100 + percent) of the sum of their sizes.
        """
        fits = (100 * self.high[a] >= percent * self.low[b]) & (100 * self.high[b] >= percent * self.low[a])
        some = np.flatnonzero(fits)
        for at in range(0, len(some), 8192):
            part = some[at : at + 8192]
            x, y = a[part], b[part]
            shared = np.bitwise_count(self.bitmap[x] & self.bitmap[y]).sum(axis=1, dtype=np.int64)
            most = np.minimum(shared + np.minimum(self.hidden[x], self.hidden[y]), np.minimum(self.high[x], self.high[y]))
            fits[part] = (100 + percent) * most >= percent * (self.low[x] + self.low[y])
        return fits


def joins(sets: Sequence[np.ndarray], labels: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links (places in `sets`) that join sets of unlike label until no further link would.

    Sets are sorted, without repeats and not empty. Every pair is checked, ruled out by the bound of
    nodes above it, or has been joined by links already, so the labels end up exactly as if all
    pairs had been checked.
    """
    if len(sets) < 2:
        return []
    order = np.lexsort(([x[0] for x in sets], [len(x) for x in sets]))
    sets, label = [sets[i] for i in order], labels[order].copy()
    links: list[tuple[int, int]] = []

    def check(i: int, j: int) -> None:
        if label[i] != label[j] and alike(sets[i], sets[j], percent):
            links.append((int(order[i]), int(order[j])))
            label[label == label[j]] = label[i]

    by_token = np.argsort([x[0] for x in sets], kind="stable").tolist()
    for i, j in [*zip(by_token, by_token[1:], strict=False), *((i, i + 1) for i in range(len(sets) - 1))]:
        check(i, j)
    if (label == label[0]).all():
        return links
    middle = int(np.median([len(x) for x in sets]))
    levels = [Level.of_sets(sets, int(np.clip(1 << (4 * middle).bit_length(), *BITS)))]
    while len(levels[-1].low) > 1:
        levels.append(levels[-1].above())
    a = b = np.zeros(1, np.int64)
    for height in range(len(levels) - 1, 0, -1):
        kept = levels[height].may_hold(a, b, percent)
        a, b = a[kept], b[kept]
        # nodes of which all sets are joined already need not be paired
        span = FANOUT**height
        begin = np.arange(0, len(label), span)
        low, high = np.minimum.reduceat(label, begin), np.maximum.reduceat(label, begin)
        apart = (low[a] != high[a]) | (low[b] != high[b]) | (low[a] != low[b])
        a, b = a[apart], b[apart]
        child = np.arange(FANOUT)
        x = (a[:, None, None] * FANOUT + child[None, :, None]).repeat(FANOUT, axis=2).ravel()
        y = (b[:, None, None] * FANOUT + child[None, None, :]).repeat(FANOUT, axis=1).ravel()
        n = len(levels[height - 1].low)
        inside = (x < n) & (y < n) & (x <= y)
        a, b = x[inside], y[inside]
    a, b = a[a < b], b[a < b]
    for at in range(0, len(a), STEP):
        x, y = a[at : at + STEP], b[at : at + STEP]
        apart = label[x] != label[y]
        x, y = x[apart], y[apart]
        kept = levels[0].may_hold(x, y, percent)
        for i, j in zip(x[kept].tolist(), y[kept].tolist(), strict=True):
            check(i, j)
    return links


def counted(sets: Sequence[np.ndarray], copies: np.ndarray, side: np.ndarray, percent: int) -> np.ndarray:
    """For each set, the sum of `copies` over all other sets alike to it.

    Sets are as for `joins`. No pair is left out but those of one side: side 0 meets 0 and all
    others, any other number meets all but itself. Each set's shared tokens are counted against all
    sets at once, from the lists of sets by token.
    """
    n, size = len(sets), np.fromiter(map(len, sets), np.int64, len(sets))
    links = np.zeros(n, np.int64)
    if n < 2:
        return links
    tokens = np.unique(np.concatenate(sets), return_inverse=True)[1]
    owner = np.repeat(np.arange(n), size)
    by_token = owner[np.argsort(tokens, kind="stable")]
    end = np.cumsum(np.bincount(tokens))
    begin = np.r_[0, end[:-1]]
    place = np.r_[0, np.cumsum(size)]
    for i in range(n):
        mine = tokens[place[i] : place[i + 1]]
        mine = mine[end[mine] - begin[mine] > 1]
        if not len(mine):
            continue
        met = [by_token[x:y] for x, y in zip(begin[mine].tolist(), end[mine].tolist(), strict=True)]
        both = np.bincount(np.concatenate(met), minlength=n)
        found = (100 * both >= percent * (size[i] + size - both)) & ((side != side[i]) | (side == 0))
        found[i] = False
        links[i] = copies[found].sum()
    return links
