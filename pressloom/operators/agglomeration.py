"""Average linkage of one group of clusters in memory, by rounds that touch only what the round before has changed.

A group holds its close pairs and the summed vectors of its clusters, never a matrix.  Clusters that are each other's nearest merge
under a new number, so vectors are only appended and stay in order.  By reducibility a merge brings no cluster nearer to a third
one; a cluster must look for its nearest again only if that one has merged.
"""

from __future__ import annotations

import numpy as np

#: Entries of vectors that are looked up at once.
_AT_ONCE = 2_000_000
_NONE = np.iinfo(np.int32).max


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def _added_up(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys in order, the sums of their values, and how many there were of each."""
    if not len(keys):
        return keys, values, keys
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[heads], np.add.reduceat(values[order], heads), np.diff(np.append(heads, len(keys)))


class _Vectors:
    """Summed vectors as (number * terms + term, value) in order of the keys; new numbers are larger than all before."""

    def __init__(self, number: np.ndarray, term: np.ndarray, value: np.ndarray, terms: int, most: int):
        self.terms, order = terms, np.argsort(number * terms + term, kind="stable")
        self.keys, self.values, self.end = (number * terms + term)[order], value[order], len(value)
        self.starts, self.sizes = np.zeros(most, np.int64), np.zeros(most, np.int32)
        self.sizes[: number.max(initial=-1) + 1] = np.bincount(number)
        self.starts[1:] = np.cumsum(self.sizes[:-1])

    def merge(self, left: np.ndarray, right: np.ndarray, new: np.ndarray) -> None:
        for first in range(0, len(new), 10_000):
            both = np.concatenate([side[first : first + 10_000] for side in (left, right)])
            at = _ranges(self.starts[both], self.sizes[both])
            number = np.repeat(np.tile(new[first : first + 10_000], 2), self.sizes[both])
            keys, values, _ = _added_up(number * self.terms + self.keys[at] % self.terms, self.values[at])
            end = self.end + len(keys)
            if end > len(self.keys):
                more = max(end - len(self.keys), len(self.keys) // 4)
                self.keys, self.values = (np.concatenate([x, np.empty(more, x.dtype)]) for x in (self.keys, self.values))
            self.keys[self.end : end], self.values[self.end : end] = keys, values
            mine = new[first : first + 10_000]
            bounds = np.searchsorted(keys, np.append(mine, mine[-1] + 1) * self.terms)
            self.starts[mine], self.sizes[mine] = self.end + bounds[:-1], np.diff(bounds)
            self.end = end

    def keep(self, live: np.ndarray) -> None:
        """Forget the vectors of all other numbers, once they are most of what is held."""
        held = int(self.sizes[live].sum())
        if self.end > 2 * held + 100_000:
            live = np.sort(live)
            at = _ranges(self.starts[live], self.sizes[live])
            self.keys, self.values, self.end = self.keys[at], self.values[at], held
            self.starts[live] = np.cumsum(self.sizes[live]) - self.sizes[live]

    def products(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The terms of the shorter vector of each pair are looked up in the longer one."""
        turn = self.sizes[a] > self.sizes[b]
        short, long = np.where(turn, b, a), np.where(turn, a, b)
        order = np.argsort(long, kind="stable")  # what is looked up close together lies close together
        sizes, out = self.sizes[short[order]], np.zeros(len(a))
        done = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
        keys, first = self.keys[: self.end], 0
        while first < len(order):
            last = max(first + 1, int(np.searchsorted(done, done[first] + _AT_ONCE, side="right")) - 1)
            pairs, size = order[first:last], sizes[first:last]
            at = _ranges(self.starts[short[pairs]], size)
            wanted = np.repeat(long[pairs] * self.terms, size) + keys[at] % self.terms
            found = np.minimum(np.searchsorted(keys, wanted), self.end - 1)
            value = np.where(keys[found] == wanted, self.values[at] * self.values[found], 0.0)
            out[pairs] = np.bincount(np.repeat(np.arange(len(pairs)), size), value, minlength=len(pairs))
            first = last
        return out


def nearest_merges(
    n: np.ndarray, a: np.ndarray, b: np.ndarray, s: np.ndarray, number: np.ndarray, term: np.ndarray, value: np.ndarray, threshold: float
) -> tuple[np.ndarray, np.ndarray]:
    """For clusters 0, 1, ... of `n` members each: the first one of the cluster that each ends in, and the members of that one.

    (a, b, s) are the pairs below the threshold, once each, with the products of their summed vectors (number, term, value).
    """
    count = len(n)
    most = 2 * count + 1
    size = np.zeros(most)
    size[:count] = n
    first = np.full(most, _NONE, np.int32)  # the smallest cluster in each number
    first[:count] = np.arange(count)
    now = np.arange(count, dtype=np.int32)  # the number that goes by each first cluster
    parent = np.arange(most, dtype=np.int32)
    vectors = _Vectors(number, term, value, int(term.max(initial=0)) + 1, most)
    a, b, s = a.astype(np.int32), b.astype(np.int32), s.copy()
    d = np.round(1.0 - s / (size[a] * size[b]), 12)
    free = most - 1  # stands at both ends of a place without a pair
    best, near = np.full(most, np.inf), np.full(most, _NONE, np.int32)  # the nearest by its first cluster
    live, used, gaps = np.ones(count, bool), count, 0
    mark = np.zeros(most, np.uint8)  # 1: looks for its nearest again, 3: has merged
    to = np.arange(most, dtype=np.int32)

    def look(u: np.ndarray, v: np.ndarray, distance: np.ndarray) -> None:
        """Take what is nearer than what is known; ties go to the smaller first cluster."""
        if not len(u):
            return
        before = best[u]
        np.minimum.at(best, u, distance)
        near[u[best[u] < before]] = _NONE
        tied = distance == best[u]
        np.minimum.at(near, u[tied], first[v[tied]])

    look(a, b, d)
    look(b, a, d)
    while True:
        own = np.flatnonzero(live)
        number_of = now[own]
        other = near[number_of]
        has = other < _NONE
        own, number_of, other = own[has], number_of[has], other[has]
        mutual = (near[now[other]] == own) & (own < other) & (best[number_of] < threshold)
        if not mutual.any():
            break
        left, right, gone = number_of[mutual], now[other[mutual]], other[mutual]
        new = np.arange(used, used + len(left), dtype=np.int32)
        used += len(left)
        size[new], first[new] = size[left] + size[right], first[left]
        parent[left] = parent[right] = to[left] = to[right] = new
        now[first[new]] = new
        live[gone] = False
        vectors.merge(left, right, new.astype(np.int64))
        mark[left] = mark[right] = 3
        merged = np.zeros(count, bool)
        merged[own[mutual]] = merged[gone] = True
        again = number_of[merged[other] & (mark[number_of] == 0)]
        mark[again] = 1

        at = np.flatnonzero(mark[a] | mark[b])
        moved = (mark[a[at]] | mark[b[at]]) == 3
        places, stay = at[moved], at[~moved]
        x, y = to[a[places]].astype(np.int64), to[b[places]].astype(np.int64)
        apart = x != y
        keys = np.minimum(x, y)[apart] * most + np.maximum(x, y)[apart]
        keys, sums, known = _added_up(keys, s[places[apart]])
        x, y = np.divmod(keys, most)
        # When all part pairs were close their sums add up; otherwise the sum comes from the vectors.
        part = np.flatnonzero(known < np.where(x >= new[0], 2, 1) * np.where(y >= new[0], 2, 1))
        if len(part):
            sums[part] = vectors.products(x[part], y[part])
        distance = np.round(1.0 - sums / (size[x] * size[y]), 12)
        close = distance < threshold
        x, y, sums, distance = x[close].astype(np.int32), y[close].astype(np.int32), sums[close], distance[close]
        # They take the places of the pairs that they come from, never more than there are.
        a[places], b[places] = free, free
        gaps += len(places) - len(x)
        places = places[: len(x)]
        a[places], b[places], s[places], d[places] = x, y, sums, distance

        best[again], near[again] = np.inf, _NONE
        for u, v in ((a, b), (b, a)):
            mine = stay[mark[u[stay]] == 1]
            look(u[mine], v[mine], d[mine])
        look(x, y, distance)
        look(y, x, distance)
        mark[left] = mark[right] = mark[again] = 0
        if gaps > 0.2 * len(a):
            held, gaps = a != free, 0
            a, b, s, d = a[held], b[held], s[held], d[held]
        vectors.keep(now[live])
    root = parent
    while (root[root] != root).any():
        root = root[root]
    return first[root[:count]], size[root[:count]]
