"""Earliest-deadline-first Pfair schedules whose stretches are scheduled side by side.

A stretch [lo, hi) of slots can be scheduled alone once it is known which blocks
released before lo still wait there. Those are blocks with a deadline after lo,
at most one a source. Which of them wait follows from a queue: blocks up to a
given place in the order of (deadline, source) are served before all others, one
a slot, so the number of them waiting at hi is

    max(waiting at lo + released in [lo, hi) - (hi - lo),
        max over t in [lo, hi] of released in [t, hi) - (hi - t))

The second part does not depend on what came before lo: every stretch computes it
alone, for all sources. A short pass over the stretches then gives what waits at
each cut, exactly as in one sequential schedule.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Plan:
    """Sources by number: whole[s] / sum(whole) is the weight of s, blocks[s] its number of blocks.

    total may be given where weights of sources without blocks take part.
    """

    whole: Sequence[int]
    blocks: Sequence[int]
    total: int

    def release(self, s: int, k: int) -> int:
        return k * self.total // self.whole[s]

    def deadline(self, s: int, k: int) -> int:
        return -(-(k + 1) * self.total // self.whole[s])

    def released(self, s: int, t: int) -> int:
        """Blocks of s released before slot t."""
        return min(self.blocks[s], -(-t * self.whole[s] // self.total))

    def sources(self) -> list[int]:
        return [s for s in range(len(self.whole)) if self.whole[s] and self.blocks[s]]

    def straddling(self, t: int) -> list[tuple[int, int, int]]:
        """(deadline, source, block) of the blocks released before t and due after it, in this order."""
        last = [(s, self.released(s, t) - 1) for s in self.sources()]
        due = [(self.deadline(s, k), s, k) for s, k in last if k >= 0]
        return sorted(block for block in due if block[0] > t)

    def cuts(self, portion: int) -> list[int]:
        """Slots that cut the schedule into stretches of about so many blocks; the last is the end of all."""
        held = self.sources()
        if not held:
            return [0]
        # Blocks started by slot t in the fluid schedule: a line with a bend where a source ends.
        weights = np.array([self.whole[s] / self.total for s in held])
        ends = np.array([self.blocks[s] * self.total / self.whole[s] for s in held])
        order = np.argsort(ends)
        ends, weights = ends[order], weights[order]
        rates = np.cumsum(weights[::-1])[::-1]
        started = np.cumsum(np.diff(ends, prepend=0.0) * rates)
        count = -(-sum(self.blocks[s] for s in held) // portion)
        wanted = np.arange(1, count) * float(portion)
        inner = np.interp(wanted, np.concatenate([[0.0], started]), np.concatenate([[0.0], ends]))
        end = max(self.deadline(s, self.blocks[s] - 1) for s in held)
        return [0, *sorted({int(t) for t in inner if 0 < int(t) < end}), end]

    def slots(self, lo: int, hi: int | None, waiting: Iterable[int]) -> Iterator[tuple[int, int, int]]:
        """(slot, source, block) of a stretch, or from lo to the end; waiting are the sources with a block left at lo."""
        ready = [(self.deadline(s, k), s, k) for s in waiting for k in (self.released(s, lo) - 1,)]
        heapq.heapify(ready)
        first = [(s, self.released(s, lo)) for s in self.sources()]
        coming = [(self.release(s, k), s, k) for s, k in first if k < self.blocks[s]]
        heapq.heapify(coming)
        slot = lo
        while coming or ready:
            if not ready:
                slot = max(slot, coming[0][0])
            if hi is not None and slot >= hi:
                return
            while coming and coming[0][0] <= slot:
                _, s, k = heapq.heappop(coming)
                heapq.heappush(ready, (self.deadline(s, k), s, k))
                if k + 1 < self.blocks[s]:
                    heapq.heappush(coming, (self.release(s, k + 1), s, k + 1))
            deadline, s, k = heapq.heappop(ready)
            assert slot < deadline
            yield slot, s, k
            slot += 1

    def crowding(self, lo: int, hi: int) -> list[int]:
        """For each straddling block at hi: the most by which blocks up to it, released in [t, hi), exceed its slots, over all t."""
        late = self.straddling(hi)
        own = {s: k for _, s, k in late}
        urgent: Counter[int] = Counter()
        for s in self.sources():
            for k in range(self.released(s, lo), self.released(s, hi)):
                if own.get(s) != k:
                    urgent[self.release(s, k)] += 1
        releases = sorted({t for _, s, k in late if (t := self.release(s, k)) >= lo})
        rows = _SuffixSums(len(releases) + 1)
        after = 0
        for t in sorted({*urgent, *releases, hi}, reverse=True):
            after += urgent[t]
            rows.lift(bisect_left(releases, t), after - (hi - t))
        rows.build()
        found = []
        for _, s, k in late:
            if (t := self.release(s, k)) >= lo:
                rows.add(bisect_left(releases, t))
            found.append(rows.best())
        return found

    def waiting_at(self, lo: int, hi: int, waiting: Sequence[int], crowding: Sequence[int]) -> list[int]:
        """The sources with a block left at hi, from those at lo and the stretch's crowding."""
        late = self.straddling(hi)
        at_lo = set(waiting)
        entered = sum(self.released(s, hi) - self.released(s, lo) for s in self.sources())
        # A straddling block counts from its own place on, if it came in the stretch or waits since before.
        counts = [self.release(s, k) >= lo or (s in at_lo and k == self.released(s, lo) - 1) for _, s, k in late]
        queue = len(at_lo) + entered - (hi - lo) - sum(counts)
        found, before = [], 0
        for (_, s, _), counted, most in zip(late, counts, crowding, strict=True):
            queue += counted
            now = max(queue, most)
            if now > before:
                found.append(s)
            before = now
        return found


class _SuffixSums:
    """Places with a value each; add(i) raises all values up to place i by one, best() is the largest value."""

    def __init__(self, places: int):
        self.width = 1 << max(0, places - 1).bit_length()
        self.added = [0] * (2 * self.width)
        self.most: list[float] = [float("-inf")] * (2 * self.width)

    def lift(self, i: int, value: int) -> None:
        self.most[self.width + i] = max(self.most[self.width + i], value)

    def build(self) -> None:
        for node in range(self.width - 1, 0, -1):
            self._join(node)

    def _join(self, node: int) -> None:
        left, right = 2 * node, 2 * node + 1
        self.added[node] = self.added[left] + self.added[right]
        self.most[node] = max(self.most[right], self.most[left] + self.added[right])

    def add(self, i: int) -> None:
        node = self.width + i
        self.added[node] += 1
        self.most[node] += 1
        while node := node // 2:
            self._join(node)

    def best(self) -> int:
        return int(self.most[1])
