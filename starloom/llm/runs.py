"""Periodic runs of words: suffix automaton with link-cut access.

Words are appended one by one to a suffix automaton. A link-cut forest over its
suffix links keeps, on every preferred path, the place where its strings last
ended. Appending word i accesses the node of the new prefix: each path segment on
the way to the root ended last at some place j, its deepest node with L words. If
L >= i - j = p, the last L + p words have the period p, and p is the smallest. The
segment is then recoloured with i. L is the longest common suffix of both
prefixes, so the run's start is known exactly; it grows while the following words
report the same period, which gives its end. No words are compared.

What cannot be part of a run is cut away first, which loses none: each word of a
run occurs at least `exponent` times inside it, so a stretch is split at rarer words,
and its parts again by their own counts, until nothing changes. Prose leaves
nothing to the automaton. Its memory is in proportion to the longest such stretch
of a single text.

Words are runs of bytes other than space and \\x09 to \\x0D. Edge cases: a null or
blank text has no words and no runs. Repeated rows and ids each give a row of their
own; a null id is returned as it is. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Callable, Hashable, Sequence
from dataclasses import dataclass
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.frames import map_batches

Run = tuple[int, int, int]  # start, length, period
# Beyond this many rounds of cutting a stretch goes to the automaton as it is.
_ROUNDS = 32


@dataclass(frozen=True)
class Periodic:
    """A run has at least `words` words and `exponent` times its period (a whole number, 2 at least)."""

    words: int = 6
    exponent: int = 4


def stretches(words: Sequence[Hashable], how: Periodic = Periodic()) -> list[tuple[int, int]]:
    """Ranges of words outside of which no run has a word."""
    frequent = re.compile(b"\x01{%d,}" % max(how.words, how.exponent))
    found, open_ = [], [(0, len(words), 0)]
    while open_:
        first, last, rounds = open_.pop()
        part = words[first:last]
        often = {w for w, n in Counter(part).items() if n >= how.exponent}
        marks = bytes(map(often.__contains__, part))
        for match in frequent.finditer(marks):
            a, b = match.span()
            if b - a == last - first or rounds == _ROUNDS:
                found.append((first + a, first + b))
            else:
                open_.append((first + a, first + b, rounds + 1))
    return sorted(found)


def squares(words: Sequence[Hashable]):
    """(end, period, common): after each word, the periods of squares that end there.

    common is the longest common suffix of the words up to end and up to end - period.
    Node 0 stands for none, node 1 for the empty string.
    """
    length, link, nexts = [0, 0], [0, 0], [{}, {}]
    left, right, parent, ended = [0, 0], [0, 0], [0, 0], [0, 0]

    def splay(x: int) -> None:
        """Bring x to the top of its path's splay tree; the top holds the path's colour."""
        p = parent[x]
        if not p or (left[p] != x and right[p] != x):
            return
        while True:
            p = parent[x]
            if not p:
                return
            if left[p] == x:
                below = True
            elif right[p] == x:
                below = False
            else:
                return
            g = parent[p]
            inner = bool(g) and (left[g] == p or right[g] == p)
            if inner and (left[g] == p) == below:
                turns = (p, x)
            elif inner:
                turns = (x, x)
            else:
                ended[x] = ended[p]
                turns = (x,)
            if inner:
                above = parent[g]
                if not above or (left[above] != g and right[above] != g):
                    ended[x] = ended[g]
            for y in turns:
                q = parent[y]
                above = parent[q]
                if above:
                    if left[above] == q:
                        left[above] = y
                    elif right[above] == q:
                        right[above] = y
                parent[y] = above
                if left[q] == y:
                    child = right[y]
                    left[q], right[y] = child, q
                else:
                    child = left[y]
                    right[q], left[y] = child, q
                if child:
                    parent[child] = q
                parent[q] = y

    def node(size: int, suffix: int, following: dict) -> int:
        length.append(size)
        link.append(suffix)
        nexts.append(following)
        for column in (left, right, parent, ended):
            column.append(0)
        return len(length) - 1

    last = 1
    for end, word in enumerate(words, 1):
        current, p = node(length[last] + 1, 1, {}), last
        while p and word not in nexts[p]:
            nexts[p][word] = current
            p = link[p]
        if p:
            q = nexts[p][word]
            if length[q] != length[p] + 1:
                copy = node(length[p] + 1, link[q], dict(nexts[q]))
                # The copy lies directly above q on q's path and ended where q did.
                splay(q)
                left[copy], parent[copy] = left[q], q
                if left[q]:
                    parent[left[q]] = copy
                left[q] = copy
                while p and nexts[p].get(word) == q:
                    nexts[p][word] = copy
                    p = link[p]
                link[q] = q = copy
            link[current] = q
        parent[current] = link[current]
        last = x = current
        deeper = 0
        while x:
            splay(x)
            before = ended[x]
            if before and length[x] >= end - before:
                yield end, end - before, length[x]
            if right[x]:
                ended[right[x]] = before
            right[x] = deeper
            deeper, x = x, parent[x]
        splay(current)
        ended[current] = end


def find_runs(words: Sequence[Hashable], how: Periodic = Periodic()) -> list[Run]:
    """All runs of a text, by start, then period."""
    found: list[Run] = []
    for first, last in stretches(words, how):
        growing: dict[int, tuple[int, int]] = {}

        def close(period: int) -> None:
            start, end = growing[period]
            if end - start >= max(how.words, how.exponent * period):
                found.append((first + start, end - start, period))

        for end, period, common in squares(words[first:last]):
            if period in growing and growing[period][1] == end - 1:
                growing[period] = growing[period][0], end
                continue
            if period in growing:
                close(period)
            growing[period] = end - common - period, end
        for period in growing:
            close(period)
    return sorted(found, key=lambda run: (run[0], run[2]))


def kept_words(words: Sequence, runs: list[Run]) -> list:
    """The words without the repetitions of each run: its first period stays."""
    kept, at = [], 0
    for first, last in sorted((start + period, start + size) for start, size, period in runs):
        kept += words[at:first] if first > at else []
        at = max(at, last)
    return [*kept, *words[at:]]


def strongest(runs: list[Run]) -> Run | None:
    """The run with the greatest length by period; ties go to the smallest start, then period."""
    return min(runs, key=lambda run: (-Fraction(run[1], run[2]), run[0], run[2]), default=None)


def _split(batch: pa.RecordBatch, column: str) -> list[list[bytes]]:
    return [(text or b"").split() for text in batch.column(column).cast(pa.binary()).to_pylist()]


def document_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", how: Periodic = Periodic()) -> DataFrame:
    """(key, runs): every run of every row's text as (start, length, period)."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        runs = [[dict(zip(("start", "length", "period"), run)) for run in find_runs(words, how)] for words in _split(batch, "_text")]
        return pa.RecordBatch.from_arrays([batch.column("_key"), pa.array(runs, kind)], [key, "runs"])

    source = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, runs array<struct<start:bigint,length:bigint,period:bigint>>"
    return map_batches(source, work, schema)


def repeat_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The text as it is, or, for a tenth of the ids, with a periodic tail. A null id changes nothing."""
    drawn = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if drawn % 10 or not words:
        return words
    drawn //= 10
    first = drawn % len(words)
    size = len(words) - first
    period = 1 + size // (3 + drawn % 8)
    return words[:first] + (words[first : first + period] * (size // period + 1))[:size]


def run_digests(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    how: Periodic = Periodic(),
    rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """Per row the number of runs, the strongest one, and digests of all runs and of the text without repetitions.

    rewrite, if given, changes the words of a text before its runs are sought.
    """
    names = ["start", "length", "period", "exponent_milli"]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: dict[str, list] = {name: [] for name in ("n_runs", *names, "runs_sha256", "collapsed_sha256")}
        for doc_id, words in zip(batch.column("_key").to_pylist(), _split(batch, "_text")):
            if rewrite:
                words = rewrite(doc_id, words)
            runs = find_runs(words, how)
            best = strongest(runs)
            values = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
            listed = "".join(f"{start},{size},{period}\n" for start, size, period in runs)
            kept = b" ".join(kept_words(words, runs) if runs else words)
            digests = hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()
            for name, value in zip(out, (len(runs), *values, *digests)):
                out[name].append(value)
        kinds = [pa.int64()] * 5 + [pa.string()] * 2
        columns = [pa.array(values, kind) for values, kind in zip(out.values(), kinds)]
        return pa.RecordBatch.from_arrays([batch.column("_key"), *columns], [key, *out])

    source = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    longs = ", ".join(f"{name} long" for name in ("n_runs", *names))
    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, {longs}, runs_sha256 string, collapsed_sha256 string"
    return map_batches(source, work, schema)
