"""Ids of words met before, as flat arrays (one object, whatever the number of words)."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from velograph.llm.textcodes import U64


class IdCache:
    """Maps 64-bit word keys to id lists; starts anew beyond ``limit`` words."""

    def __init__(self, limit: int = 1 << 20):
        self.limit = limit
        self._clear()

    def _clear(self) -> None:
        self.known = np.zeros(0, U64)
        self.start = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)
        self.store = np.zeros(1 << 16, np.int32)
        self.used = 0

    def spans(self, keys: np.ndarray, make: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], keep: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Start of each word's ids in ``store``, and how many it has. ``make`` gives,
        for the places of words not met before, their ids and how many each has.
        With ``keep`` the spans given before stay valid."""
        codes, first, word = np.unique(keys, return_index=True, return_inverse=True)
        if not keep and len(self.known) + len(codes) > self.limit:
            self._clear()
        at = np.searchsorted(self.known, codes)
        fresh = np.ones(len(codes), bool)
        inside = at < len(self.known)
        fresh[inside] = self.known[at[inside]] != codes[inside]
        if fresh.any():
            ids, length = make(first[fresh])
            if self.used + len(ids) > len(self.store):
                self.store = np.concatenate([self.store, np.zeros(max(len(self.store), len(ids)), np.int32)])
            self.store[self.used:self.used + len(ids)] = ids
            start = self.used + np.cumsum(length) - length
            self.used += len(ids)
            self.known = np.insert(self.known, at[fresh], codes[fresh])
            self.start = np.insert(self.start, at[fresh], start)
            self.length = np.insert(self.length, at[fresh], length)
            at = np.searchsorted(self.known, codes)
        return self.start[at][word], self.length[at][word]

    def ids(self, keys: np.ndarray, make: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words of a text, and the bounds of each word's (``make`` as above)."""
        if not len(keys):
            return np.zeros(0, np.int32), np.zeros(1, np.int64)
        start, length = self.spans(keys, make)
        total = np.concatenate([[0], np.cumsum(length)])
        return self.store[np.arange(total[-1]) + np.repeat(start - total[:-1], length)], total
