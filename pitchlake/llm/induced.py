"""External induced suffix sorting with common-prefix values.

Suffixes at local minima (a type-S position after a type-L one) are sorted first,
by naming their substrings and sorting the string of names the same way. Their
order induces that of all type-L suffixes in a rising sweep, and that order all
type-S suffixes in a falling one. A sweep's priority queue holds tuples (symbol,
rank of the following suffix, position, common prefix with the tuple before it in
its symbol's queue), so prefixes need no second pass. Queues, sorts and arrays
that outgrow ``limit`` items live in unnamed temporary files of the task, which
vanish with it.
"""

from __future__ import annotations

import heapq
import pickle
import tempfile
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np

#: Items that a queue or sort keeps in memory.
LIMIT = 400_000
CHUNK = 4096


class Run:
    """Items on disk, written in order, read in order or from the end."""

    def __init__(self) -> None:
        self.file, self.at, self.buffer = tempfile.TemporaryFile(), [], []

    def append(self, item) -> None:
        self.buffer.append(item)
        if len(self.buffer) == CHUNK:
            self.flush()

    def flush(self) -> None:
        if self.buffer:
            self.at.append(self.file.tell())
            pickle.dump(self.buffer, self.file, pickle.HIGHEST_PROTOCOL)
            self.buffer = []

    def read(self, backward: bool = False) -> Iterator:
        self.flush()
        for at in reversed(self.at) if backward else list(self.at):
            self.file.seek(at)
            chunk = pickle.load(self.file)  # noqa: S301  written above
            yield from reversed(chunk) if backward else chunk


def sorted_run(items: list) -> Run:
    items.sort()
    run = Run()
    for x in items:
        run.append(x)
    return run


def external_sort(items: Iterable, limit: int) -> Iterator:
    runs, held = [], []
    for x in items:
        held.append(x)
        if len(held) >= limit:
            runs.append(sorted_run(held))
            held = []
    held.sort()
    return heapq.merge(*(r.read() for r in runs), held)


class Queue:
    """A priority queue that moves what it can't hold to sorted runs."""

    def __init__(self, limit: int):
        self.limit, self.heap, self.heads = limit, [], []

    def push(self, item) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.limit:
            items = sorted_run(self.heap).read()
            self.heap = []
            self.heads.append((next(items), len(self.heads), items))
            heapq.heapify(self.heads)

    def peek(self):
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            return self.heads[0][0]
        return self.heap[0] if self.heap else None

    def pop(self):
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            item, k, items = self.heads[0]
            after = next(items, None)
            if after is None:
                heapq.heappop(self.heads)
            else:
                heapq.heapreplace(self.heads, (after, k, items))
            return item
        return heapq.heappop(self.heap)


def array(n: int, limit: int) -> np.ndarray:
    """Longs in memory, or in a mapped temporary file beyond the limit."""
    if n <= 8 * limit:
        return np.zeros(n, np.int64)
    return np.memmap(tempfile.TemporaryFile(), np.int64, "w+", shape=n)


class Minima:
    """Least value since a rank, over values that arrive in rank order."""

    def __init__(self) -> None:
        self.ranks, self.values = [], []

    def add(self, rank: int, value: int) -> None:
        while self.values and self.values[-1] >= value:
            self.values.pop()
            self.ranks.pop()
        self.values.append(value)
        self.ranks.append(rank)

    def after(self, rank: int) -> int:
        return self.values[bisect_right(self.ranks, rank)]


def quick(values: np.ndarray, limit: int):
    """The values as a list, whose items are faster to read, within the limit of arrays."""
    return values.tolist() if len(values) <= 8 * limit else values


def _types_and_runs(t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """True where a suffix is smaller than the next one; length of the run of equal symbols."""
    n = len(t)
    place = np.int32 if n < 1 << 31 else np.int64
    ends = np.append(np.flatnonzero(t[1:] != t[:-1]), n - 1).astype(place)  # last place of each run
    sizes = np.diff(ends, prepend=place(-1))
    rises = np.append(t[ends[:-1]] < t[ends[:-1] + 1], True)
    runs = np.repeat(ends + place(1), sizes)
    runs -= np.arange(n, dtype=place)
    return np.repeat(rises, sizes), runs


def _order_minima(t: np.ndarray, at: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes at local minima: indices into ``at`` in order, and common prefixes with the one before."""
    m, end = len(at), int(t.max()) + 1
    cuts = quick(np.append(at, len(t) - 1), limit)
    # an end beyond all symbols: of two substrings that differ in length only, the shorter is larger
    text = quick(t, limit)
    substrings = (((*map(int, text[cuts[i] : cuts[i + 1] + 1]), end), i) for i in range(m))
    names, name, before = array(m, limit), -1, None
    for s, i in external_sort(substrings, limit):
        name += s != before
        names[i], before = name, s
    order, common = array(m, limit), array(m, limit)
    if name + 1 == m:
        order[names] = np.arange(m)
    else:
        for k, (i, c) in enumerate(_ascending(names, limit)):
            order[k], common[k] = i, c
    previous = None
    for k in range(m):
        i = int(order[k])
        if previous is not None:
            shared = int(common[k])  # equal names; the next ones differ within their symbols
            a, b = cuts[i + shared] if i + shared < m else len(t), cuts[previous + shared] if previous + shared < m else len(t)
            length = a - cuts[i]
            while a < len(t) and b < len(t) and text[a] == text[b]:
                a, b, length = a + 1, b + 1, length + 1
            common[k] = length
        previous = i
    return order, common


def _ascending(t: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """(position, common prefix with the one before) of all suffixes, in order."""
    run = Run()
    for item in descending(t, limit):
        run.append(item)
    after = None  # descending() pairs a suffix with the larger one
    for i, c in run.read(backward=True):
        yield i, 0 if after is None else after
        after = c


def descending(t: np.ndarray, limit: int = LIMIT) -> Iterator[tuple[int, int]]:
    """(position, symbols in common with the suffix before it here), largest suffix first.

    ``t`` holds whole numbers from 0; the last one is smaller than all others.
    """
    n = len(t)
    if n == 1:
        yield 0, 0
        return
    rising, runs = _types_and_runs(t)
    at = np.flatnonzero(rising[1:] & ~rising[:-1]) + 1
    order, common = (quick(x, limit) for x in _order_minima(t, at, limit))
    t, rising, runs, at = (quick(x, limit) for x in (t, rising, runs, at))

    # Rising sweep: local minima and type-L suffixes in order; each may put the one to its left into the queue.
    falling, queue, minima, last = Run(), Queue(limit), Minima(), {}
    k, rank, before, before_rises = 0, 0, -1, False
    while k < len(at) or queue.peek() is not None:
        head = queue.peek()
        if k < len(at) and (head is None or head[0] > t[at[order[k]]]):
            i, is_rising = int(at[order[k]]), True
            shared = 0
            if before >= 0 and t[before] == t[i]:
                shared = int(common[k]) if before_rises else min(runs[before], runs[i])
            k += 1
        else:
            c, _, i, shared = queue.pop()
            is_rising = False
            if before < 0 or t[before] != c:
                shared = 0
            falling.append((i, shared))
        minima.add(rank, shared)
        if i and t[i - 1] >= t[i] and not rising[i - 1]:
            c = int(t[i - 1])
            queue.push((c, rank, i - 1, 1 + minima.after(last[c]) if c in last else 0))
            last[c] = rank
        before, before_rises, rank = i, is_rising, rank + 1

    # Falling sweep: type-L suffixes backwards and type-S suffixes, largest first.
    queue, minima, last = Queue(limit), Minima(), {}
    left = falling.read(backward=True)
    pending, rank, before, before_rises, before_shared = next(left, None), 0, -1, False, 0
    while pending is not None or queue.peek() is not None:
        head = queue.peek()
        if head is not None and (pending is None or -head[0] >= t[pending[0]]):
            c, _, i, shared = queue.pop()
            is_rising, own = True, 0
            if before < 0 or t[before] != -c:
                shared = 0
        else:
            (i, own), is_rising, shared = pending, False, 0
            if before >= 0 and t[before] == t[i]:
                shared = int(min(runs[before], runs[i])) if before_rises else before_shared
            pending = next(left, None)
        yield i, shared
        minima.add(rank, shared)
        if i and rising[i - 1]:
            c = int(t[i - 1])
            queue.push((-c, rank, i - 1, 1 + minima.after(last[c]) if c in last else 0))
            last[c] = rank
        before, before_rises, before_shared, rank = i, is_rising, own, rank + 1
    yield n - 1, 0
