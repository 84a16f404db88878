"""Runs of repeating words in whole texts, from the maximal pairs of an LCP-interval tree.

A run is a stretch of words with smallest period q that holds at least two periods and that no neighbouring word extends.
Where it starts at s and ends before e, the strings of e - s - q words at s and at s + q are equal and cannot be made
longer on either side: a maximal pair whose distance is no more than its length. The other way round, a maximal pair at
(i, j) of length l >= j - i covers exactly one run, from i to j + l. So no pair needs to be extended:

1. A pair that can matter is at least ``least`` / 2 words long, so only starts whose next so many words occur again in
   their text enter the suffix array (prefix doubling over the words' numbers), and only LCP intervals that deep its tree.
2. The tree is walked bottom-up. A node keeps the positions below it as sorted lists, one for each left-hand word. Where
   two children meet at depth l, the smaller goes through its positions and looks up those of the larger one within l
   words, in the lists of other left-hand words: these are maximal pairs.
3. Of pairs that cover the same stretch the least distance is the smallest period.

Texts are independent, so each task takes whole texts and no rows move.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.shipping import ship
from tabwright.llm.words import as_text, mix, odd_factors, words_of

BYTES_AT_ONCE = 4_000_000


def _repeated_starts(codes: np.ndarray, bounds: np.ndarray, width: int) -> np.ndarray:
    """Starts whose ``width`` words may occur again in their text: all that do, and by a clash of hashes others."""
    n, text = len(codes), np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    inside = np.flatnonzero(np.arange(n) + width <= bounds[1:][text])
    mark = mix(text[inside].astype(np.uint64) + np.uint64(1))
    for k, factor in enumerate(odd_factors(width, 5)):
        mark += mix(codes[inside + k].astype(np.uint64) + np.uint64(1)) * factor
    order = np.argsort(mark, kind="stable")
    ordered = mark[order]
    same = ordered[1:] == ordered[:-1]
    return np.sort(inside[order[np.concatenate([[False], same]) | np.concatenate([same, [False]])]]) if len(order) else inside


def _first_ranks(codes: np.ndarray, at: np.ndarray, text: np.ndarray, end: np.ndarray, width: int) -> np.ndarray:
    """The place of each start by its text and its next ``width`` words; equal ones share the first of their places."""
    padded = np.concatenate([codes, np.zeros(width, codes.dtype)])
    grams = [text, *(np.where(at + k < end, padded[at + k], -1) for k in range(width))]
    by = np.lexsort(grams[::-1])
    new = np.zeros(len(by), bool)
    new[:1] = True
    for gram in grams:
        new[1:] |= gram[by[1:]] != gram[by[:-1]]
    rank = np.empty(len(by), np.int64)
    rank[by] = np.flatnonzero(new)[np.cumsum(new) - 1]
    return rank


def suffix_array(codes: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes that share ``width`` words or more with another one of their text, in order, and the LCP of each with the
    one before it (0 where that shares fewer)."""
    repeated = _repeated_starts(codes, bounds, width)
    text = np.searchsorted(bounds, repeated, "right") - 1
    # Where a repeated stretch ends, the next start decides the order, so it has a rank too.
    at = np.union1d(repeated, (repeated + width)[repeated + width < bounds[1:][text]])
    text = np.searchsorted(bounds, at, "right") - 1
    end = bounds[text + 1]
    rank = _first_ranks(codes, at, text, end, width)
    m = len(at)
    where = np.full(len(codes) + 1, -1, np.int64)
    where[at] = np.arange(m)
    order = np.argsort(rank, kind="stable")
    levels, reach = [rank], width

    def ahead(i: np.ndarray, by: np.ndarray | int) -> np.ndarray:
        """The number of the suffix ``by`` words further on, or -1."""
        to = at[i] + by
        return np.where(to < end[i], where[np.minimum(to, len(codes))], -1)

    while m:
        sizes = np.bincount(rank, minlength=m)
        slots = np.flatnonzero(sizes[rank[order]] > 1)
        if not len(slots):
            break
        i = order[slots]
        beyond = ahead(i, reach)
        second = np.where(beyond >= 0, rank[beyond], -1)  # the end of the text
        by = np.lexsort((second, rank[i]))
        i, second = i[by], second[by]
        new = np.concatenate([[True], (rank[i[1:]] != rank[i[:-1]]) | (second[1:] != second[:-1])])
        order[slots] = i
        rank = rank.copy()
        rank[i] = slots[np.flatnonzero(new)[np.cumsum(new) - 1]]
        levels.append(rank)
        reach *= 2
    a, b = order[:-1], order[1:]
    lcp = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = ahead(a, lcp), ahead(b, lcp)
        lcp += np.where((x >= 0) & (y >= 0) & (levels[k][x] == levels[k][y]), width << k, 0)
    tail = np.flatnonzero(lcp > 0)
    for _ in range(width - 1):
        p, q = at[a[tail]] + lcp[tail], at[b[tail]] + lcp[tail]
        live = (p < end[a[tail]]) & (q < end[b[tail]])
        tail, p, q = tail[live], p[live], q[live]
        tail = tail[codes[p] == codes[q]]
        lcp[tail] += 1
    lcp = np.concatenate([np.zeros(min(m, 1), np.int64), lcp])
    shares = (lcp > 0) | np.concatenate([lcp[1:] > 0, np.zeros(min(m, 1), bool)])
    return at[order][shares], lcp[shares]


class _Node:
    """Positions below a node of the tree: all of them, and one list for each left-hand word."""

    __slots__ = ("positions", "by_left")

    def __init__(self, position: int, left: int):
        self.positions, self.by_left = [position], {left: [position]}


def _met(a: _Node, b: _Node, depth: int, left: list[int], pairs: list[tuple[int, int, int]]) -> _Node:
    """Join two children of a node: report their maximal pairs at distances up to ``depth``."""
    if len(a.positions) < len(b.positions):
        a, b = b, a
    for own, members in b.by_left.items():
        for p in members:
            low, high = bisect_left(a.positions, p - depth), bisect_right(a.positions, p + depth)
            if high - low <= len(a.by_left):
                pairs.extend((p, q, depth) for q in a.positions[low:high] if left[q] != own)
            else:
                for other, there in a.by_left.items():
                    if other != own:
                        pairs.extend((p, q, depth) for q in there[bisect_left(there, p - depth) : bisect_right(there, p + depth)])
    for own, members in b.by_left.items():
        there = a.by_left.setdefault(own, [])
        for p in members:
            insort(a.positions, p)
            insort(there, p)
    return a


def maximal_pairs(positions: list[int], lcp: list[int], left: list[int]) -> list[tuple[int, int, int]]:
    """``(i, j, length)`` of the maximal pairs no further apart than they are long, from a part of a suffix array."""
    pairs: list[tuple[int, int, int]] = []
    open_: list[tuple[int, _Node]] = []
    last = _Node(positions[0], left[positions[0]])
    for p, depth in zip(positions[1:], lcp[1:], strict=True):
        while open_ and open_[-1][0] > depth:
            above, node = open_.pop()
            last = _met(node, last, above, left, pairs)
        if open_ and open_[-1][0] == depth:
            last = _met(open_.pop()[1], last, depth, left, pairs)
        open_.append((depth, last))
        last = _Node(p, left[p])
    for above, node in reversed(open_):
        last = _met(node, last, above, left, pairs)
    return pairs


def find(codes: np.ndarray, bounds: np.ndarray, least: int = 12) -> np.ndarray:
    """Rows (text, start, length, period) of all runs of at least ``least`` words, by text, start and period."""
    width = max(1, (least + 1) // 2)
    positions, lcp = suffix_array(codes, bounds, width)
    # A part of the array whose positions are all further apart than its longest match holds no run.
    first = np.flatnonzero(lcp == 0)
    size = np.diff(np.concatenate([first, [len(lcp)]]))
    part = np.repeat(np.arange(len(first)), size)
    by = np.lexsort((positions, part))
    gap = np.where(part[by][1:] == part[by][:-1], np.diff(positions[by]), np.iinfo(np.int64).max)
    nearest = np.minimum.reduceat(np.concatenate([[np.iinfo(np.int64).max], gap]), first) if len(first) else first
    longest = np.maximum.reduceat(lcp, first) if len(first) else first
    left = np.concatenate([[-1], codes[:-1]]) if len(codes) else codes
    left[bounds[:-1][np.diff(bounds) > 0]] = -1  # one position a text
    lefts = left.tolist() if (nearest <= longest).any() else []
    pairs: list[tuple[int, int, int]] = []
    for k in np.flatnonzero(nearest <= longest).tolist():
        a, b = int(first[k]), int(first[k] + size[k])
        pairs += maximal_pairs(positions[a:b].tolist(), lcp[a:b].tolist(), lefts)
    found = np.array(pairs, np.int64).reshape(-1, 3)
    start, period = found[:, :2].min(axis=1), np.abs(found[:, 0] - found[:, 1])
    length = found[:, 2] + period
    fits = (found[:, 2] >= period) & (length >= least)
    rows = np.column_stack([start, length, period])[fits]
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    once = np.concatenate([[True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1)]) if len(rows) else np.zeros(0, bool)
    rows = rows[once]
    text = np.searchsorted(bounds, rows[:, 0], "right") - 1
    rows = np.column_stack([text, rows[:, 0] - bounds[text], rows[:, 1], rows[:, 2]])
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _pieces(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``BYTES_AT_ONCE`` bytes; a longer text is a range of its own."""
    ends = texts.buffers()[1] and np.frombuffer(texts.buffers()[1], np.int64)[: len(texts) + 1]
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(ends, ends[a] + BYTES_AT_ONCE, "right")) - 1)
        yield a, min(b, len(texts))
        a = b


def _with_runs(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_text(batch.column("text"))
            for a, b in _pieces(texts):
                bounds, distinct, codes = words_of(as_text(texts.slice(a, b - a)), lower=False)
                codes = codes.astype(np.int64)
                found = find(codes, bounds, least)
                base = bounds[found[:, 0]]
                edge = np.zeros(len(codes) + 1, np.int64)
                np.add.at(edge, base + found[:, 1] + found[:, 3], 1)
                np.add.at(edge, base + found[:, 1] + found[:, 2], -1)
                kept = np.cumsum(edge[:-1]) == 0
                left = np.concatenate([[0], np.cumsum(kept)])[bounds]
                words = pa.LargeListArray.from_arrays(pa.array(left), distinct.take(pa.array(codes[kept])))
                runs_at = np.searchsorted(found[:, 0], np.arange(b - a + 1)).astype(np.int32)
                values = pa.StructArray.from_arrays([pa.array(found[:, k]) for k in (1, 2, 3)], ["start", "length", "period"])
                columns = [
                    batch.column("doc_id").slice(a, b - a),
                    pa.array(np.diff(bounds)),
                    pa.ListArray.from_arrays(pa.array(runs_at), values).cast(_RUN),
                    pc.binary_join(words, pa.scalar(" ", pa.large_string())).cast(pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])

    return run


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, least: int = 12) -> DataFrame:
    """``(doc_id, n_words, runs, collapsed)``, one row for every row of ``docs``.

    Words are runs of anything but the six ASCII blanks, as written, numbered from 0. ``runs`` lists (start, length,
    period) of every stretch of at least ``least`` words and two periods that has that smallest period and that no
    neighbouring word extends, by start and period. ``collapsed`` is the text's words joined by one space, without those
    that some run holds behind its first period. A null or empty text has no words, no runs and "" as ``collapsed``.
    Repeated rows and rows without an id come out like any other; other columns are not read; an empty table gives no
    rows. A text's memory grows with its own words only.
    """
    ship(docs.sparkSession)
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = plain.schema["doc_id"].dataType.simpleString()
    out = f"doc_id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return plain.mapInArrow(_with_runs(least), out)
