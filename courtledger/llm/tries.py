"""Double-array tries over bytes, built and walked by whole arrays.

A state is a slot. Its child by byte ``b`` is the slot ``base[state] + b``, if ``check`` of that
slot names the state as its parent. ``value`` holds the number of the key that ends in a slot,
or 0.
"""

from __future__ import annotations

import numpy as np

#: Nodes of so many children get a window of 256 slots for themselves; what they leave free
#: goes to nodes of one child.
WIDE = 32
_ROOT = 0


class _Slots:
    """Free and used slots, and where the children of many nodes go."""

    def __init__(self):
        self.used = np.zeros(512, dtype=bool)
        self.used[:256] = True  # a base is never negative: no child lies below 256
        self.rng = np.random.default_rng(11)

    def _more(self, n: int) -> int:
        """Appends free slots; the first of them."""
        first = len(self.used)
        self.used = np.append(self.used, np.zeros(n, dtype=bool))
        return first

    def place(self, sizes: np.ndarray, starts: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """Bases of nodes whose children are ``symbols[starts : starts + sizes]``."""
        bases = np.zeros(len(sizes), np.int64)
        wide = np.flatnonzero(sizes >= WIDE)
        if len(wide):
            bases[wide] = self._more(256 * len(wide)) + 256 * np.arange(len(wide))
            for size in np.unique(sizes[wide]):
                self._take(bases, wide[sizes[wide] == size], int(size), starts, symbols)
        few = (sizes > 1) & (sizes < WIDE)
        room = 4 * int(sizes[few].sum())
        low = self._more(room + 512) if room else 0
        for size in range(WIDE - 1, 1, -1):
            open_ = np.flatnonzero(sizes == size)
            claim = np.zeros(len(self.used) if len(open_) else 0, np.int64)
            while len(open_):
                bases[open_] = self.rng.integers(low, low + room + 256, len(open_))
                slots = bases[open_][:, None] + symbols[starts[open_][:, None] + np.arange(size)]
                claim[slots] = open_[:, None]
                fits = ((claim[slots] == open_[:, None]) & ~self.used[slots]).all(axis=1)
                self.used[slots[fits]] = True
                open_ = open_[~fits]
        single = np.flatnonzero(sizes == 1)
        if len(single):
            free = np.flatnonzero(~self.used)
            if len(free) < len(single):
                first = self._more(len(single))
                free = np.append(free, np.arange(first, first + len(single)))
            free = free[: len(single)]
            self.used[free] = True
            bases[single] = free - symbols[starts[single]]
        return bases

    def _take(self, bases, nodes, size: int, starts, symbols) -> None:
        self.used[bases[nodes][:, None] + symbols[starts[nodes][:, None] + np.arange(size)]] = True


class DoubleArray:
    """Distinct keys, none empty: ``flat[offsets[k] : offsets[k + 1]]`` has the value ``values[k]``."""

    def __init__(self, flat: np.ndarray, offsets: np.ndarray, values: np.ndarray):
        slots, parents, states, links = _Slots(), [], [], []
        at, left = offsets[:-1].astype(np.int64), np.diff(offsets).astype(np.int64)
        which = np.arange(len(at))
        state = np.zeros(len(at), np.int64)
        ends = np.zeros(len(at), np.int64)
        while len(which):
            pairs = state * 256 + flat[at]
            edges, of_edge = np.unique(pairs, return_inverse=True)
            nodes, starts, sizes = np.unique(edges // 256, return_index=True, return_counts=True)
            symbols = edges % 256
            bases = slots.place(sizes, starts, symbols)
            children = np.repeat(bases, sizes) + symbols
            parents.append((nodes, bases))
            links.append((children, np.repeat(nodes, sizes)))
            state, at, left = children[of_edge], at + 1, left - 1
            done = left == 0
            ends[which[done]] = state[done]
            which, state, at, left = which[~done], state[~done], at[~done], left[~done]
        n = len(slots.used) + 256
        self.base, self.check = np.zeros(n, np.int32), np.full(n, -1, np.int32)
        self.value = np.zeros(n, np.int32)
        for nodes, bases in parents:
            self.base[nodes] = bases
        for children, nodes in links:
            self.check[children] = nodes
        self.value[ends] = values

    def step(self, state: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each state goes by its symbol, and which of them had such a child."""
        there = self.base[state] + symbols
        return there, self.check[there] == state

    def walk(self, key: bytes, state: int = _ROOT) -> int:
        """The state behind ``key``, or -1."""
        for symbol in key:
            there = int(self.base[state]) + symbol
            if self.check[there] != state:
                return -1
            state = there
        return state

    def segments(
        self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, state: np.ndarray
    ) -> np.ndarray:
        """Values of the byte ranges, each from a state of its own (below 0: none), all at once."""
        out = np.zeros(len(starts), np.int32)
        which = np.flatnonzero(state >= 0)
        state, at, left = state[which], starts[which].copy(), (ends - starts)[which]
        while len(which):
            there, found = self.step(state, data[at])
            which, state, at, left = which[found], there[found], at[found] + 1, left[found] - 1
            done = left == 0
            out[which[done]] = self.value[state[done]]
            more = ~done
            which, state, at, left = which[more], state[more], at[more], left[more]
        return out

    def sequences(self, words: np.ndarray, at: np.ndarray, size: int, width: int) -> np.ndarray:
        """Values of the ``size`` numbers from each of the places ``at`` on.

        A number counts as ``width`` bytes, highest first. Every place has a state; all of them
        advance together, byte by byte, until they fall out of the trie or reach the end.
        """
        out = np.zeros(len(at), np.int32)
        which, state = np.arange(len(at)), np.zeros(len(at), np.int32)
        for k in range(size):
            for shift in range(8 * (width - 1), -1, -8):
                symbols = (words[at[which] + k] >> shift) & 255
                there, found = self.step(state, symbols)
                which, state = which[found], there[found]
        out[which] = self.value[state]
        return out


def number_keys(rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of numbers as keys: each number as ``width`` bytes, highest first."""
    n, size = rows.shape
    shifts = np.arange(8 * (width - 1), -1, -8)
    flat = ((rows[:, :, None].astype(np.int64) >> shifts) & 255).astype(np.uint8).ravel()
    return flat, np.arange(n + 1) * size * width
