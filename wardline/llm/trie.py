"""A double-array trie of byte strings, walked for many words at once."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator, Sequence

import numpy as np


class DoubleArray:
    """State s has the child t = base[s] + byte if check[t] == s; value[t] is the id of the string that ends there, or -1."""

    def __init__(self, base: np.ndarray, check: np.ndarray, value: np.ndarray):
        self.base, self.check, self.value = base, check, value

    @classmethod
    def build(cls, strings: Sequence[bytes], ids: Sequence[int]) -> DoubleArray:
        """From distinct non-empty strings. Children of a state go to the first places that are all free."""
        order = sorted(range(len(strings)), key=strings.__getitem__)
        keys, values = [strings[i] for i in order], [ids[i] for i in order]
        base, check, value, used = [0], [-2], [-1], bytearray(b"\1")
        seek = 1
        # (state, length of its string, range of the keys that begin with it)
        queue = deque([(0, 0, 0, len(keys))])
        while queue:
            state, depth, low, high = queue.popleft()
            if low < high and len(keys[low]) == depth:
                value[state] = values[low]
                low += 1
            children: list[tuple[int, int, int]] = []
            while low < high:
                byte, begin = keys[low][depth], low
                while low < high and keys[low][depth] == byte:
                    low += 1
                children.append((byte, begin, low))
            if not children:
                continue
            # a single child fills the first hole; for several, look on from the last place found
            place = used.find(0, 1 if len(children) == 1 else seek)
            while True:
                if place < 0:
                    place = len(used)
                at = place - children[0][0]
                if len(used) < at + 257:
                    more = max(at + 257 - len(used), len(used))
                    used.extend(bytes(more))
                    base += [0] * more
                    check += [-1] * more
                    value += [-1] * more
                if at > 0 and not any(used[at + byte] for byte, _, _ in children):
                    break
                place = used.find(0, place + 1)
            if len(children) > 1:
                seek = place
            base[state] = at
            for byte, begin, end in children:
                used[at + byte], check[at + byte] = 1, state
                queue.append((at + byte, depth + 1, begin, end))
        return cls(*(np.array([*x, *[-1] * 256], np.int32) for x in (base, check, value)))

    def walk(self, letters: np.ndarray, size: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """All strings within words, as (start, end, rows, ids), starts ascending.

        `letters` has a word's bytes in each row, padded to the longest; `size` its length.
        """
        for start in range(letters.shape[1]):
            rows = np.flatnonzero(size > start)
            state = np.zeros(len(rows), np.int32)
            for end in range(start + 1, letters.shape[1] + 1):
                inside = size[rows] >= end
                rows, state = rows[inside], state[inside]
                after = self.base[state] + letters[rows, end - 1]
                there = self.check[after] == state
                rows, state = rows[there], after[there]
                if not len(rows):
                    break
                ids = self.value[state]
                ended = ids >= 0
                if ended.any():
                    yield start, end, rows[ended], ids[ended]


def batches(words: Sequence[bytes], cells: int = 400_000) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(places, letters, sizes) of words of like length, so that little of a padded table is padding."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(size, kind="stable")
    at = 0
    while at < len(order):
        # the longest of a batch may be an eighth longer than the shortest, and 8 bytes
        reach = int(np.searchsorted(size[order], size[order[at]] * 1.125 + 8, "right"))
        longest = max(int(size[order[reach - 1]]), 1)
        places = order[at : min(reach, at + max(cells // longest, 1))]
        width = max(int(size[places[-1]]), 1)
        joined = b"".join([words[i].ljust(width, b"\0") for i in places])
        yield places, np.frombuffer(joined, np.uint8).reshape(len(places), width), size[places]
        at += len(places)
