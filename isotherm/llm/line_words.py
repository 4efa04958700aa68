"""Constants of line sets, and nodes compared by numpy within a task.

``lines`` works with DataFrame functions alone and takes the constants only;
``meet`` is the same comparison of the nodes of a word in numpy, kept for its test.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

CELL_BITS, NUMBER_BITS = 21, 55
CELLS = 1 << CELL_BITS
#: Sets of fewer words are similar to equal ones only.
LEAST_WORDS = 4
#: Sets of at most so many words go by 64 bits.
SHORT_WORDS = 64
#: Rows of words that are compared at a time, at least; with 256 to a word they give a million pairs.
MEET_ROWS = 1 << 13

MET = "word long, node long, b long, common int, n int, m int, size long, low long, high long"
MET_ARROW = pa.schema([(name, pa.int32() if kind == "int" else pa.int64()) for name, kind in (column.split() for column in MET.split(", "))])


def _met_batch(**columns: np.ndarray) -> pa.RecordBatch:
    """Rows of ``MET``; columns that are not given are null."""
    rows = len(next(iter(columns.values())))
    arrays = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(rows, f.type) for f in MET_ARROW]
    return pa.RecordBatch.from_arrays(arrays, schema=MET_ARROW)


def fitting(rows: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs of ``rows`` (columns ``word, node, size, low, high``) pass the length, the positional and the bitmap filter."""
    n, m = rows[2, i] >> 32, rows[2, j] >> 32
    fit = np.flatnonzero(5 * np.minimum(n, m) >= 4 * np.maximum(n, m))
    i, j, n, m = i[fit], j[fit], n[fit], m[fit]
    low, high = rows[3, i] ^ rows[3, j], rows[4, i] ^ rows[4, j]
    whole = np.bitwise_count(low.view(np.uint64)).astype(np.int64) + np.bitwise_count(high.view(np.uint64))
    apart = np.where(np.minimum(n, m) > SHORT_WORDS, whole, np.bitwise_count((low ^ high).view(np.uint64)))
    near = (9 * apart <= n + m) & (rows[1, i] != rows[1, j])
    fit, i, j, n, m = fit[near], i[near], j[near], n[near], m[near]
    at, to = rows[2, i] & 0x7FFFFFFF, rows[2, j] & 0x7FFFFFFF
    return fit[9 * (np.minimum(at, to) + 1 + np.minimum(n - at, m - to) - 1) >= 4 * (n + m)]


def word_pairs(rows: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> pa.RecordBatch:
    """Of words of few rows, ordered by node: fitting pairs ``node < b`` with the number of words by which they meet here."""
    within = np.arange(rows.shape[1]) - np.repeat(begins, sizes)
    later = np.repeat(np.arange(rows.shape[1]), within)
    earlier = np.arange(len(later)) - np.repeat(np.cumsum(within) - within, within) + np.repeat(np.repeat(begins, sizes), within)
    fit = fitting(rows, earlier, later)
    earlier, later = earlier[fit], later[fit]
    order = np.lexsort((rows[1, later], rows[1, earlier]))
    a, b = rows[1, earlier[order]], rows[1, later[order]]
    new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(a) else np.zeros(0, np.int64)
    n, m = (rows[2, x[order]][new] >> 32 for x in (earlier, later))
    return _met_batch(node=a[new], b=b[new], common=np.diff(new, append=len(a)), n=n, m=m)


def meet(few: int):
    """Task: rows ``word, node, size, low, high`` in this order to ``MET``: pairs by words of at most ``few`` rows, the rows of other words.

    ``size`` is the set's number of words, and in its lower half the word's place.
    Of a word of many rows none is held back, so that it may have any number.
    """

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = np.full((3, 1), -1, np.int64)  # word, node, size of the row before
        many = -1  # the word that has shown to be of many rows and may go on
        held, count = [np.zeros((5, 0), np.int64)], 0

        def settled(rows: np.ndarray, final: bool) -> Iterator[pa.RecordBatch]:
            nonlocal many, held, count
            begins = np.flatnonzero(np.diff(rows[0], prepend=-1))
            sizes = np.diff(begins, append=rows.shape[1])
            of_many = (sizes > few) | (rows[0, begins] == many)
            rest = rows[:, :0]
            if len(begins) and not final:
                many = rows[0, -1] if of_many[-1] else -1
                if many < 0:
                    rows, rest = rows[:, : begins[-1]], rows[:, begins[-1] :]
                    begins, sizes, of_many = begins[:-1], sizes[:-1], of_many[:-1]
            held, count = [rest], rest.shape[1]
            each = np.repeat(of_many, sizes)
            word, node, size, low, high = rows[:, each]
            if len(word):
                yield _met_batch(word=word, node=node, size=size, low=low, high=high)
            left = sizes[~of_many]
            pairs = word_pairs(rows[:, ~each], np.cumsum(left) - left, left)
            if pairs.num_rows:
                yield pairs

        for batch in batches:
            rows = np.stack([batch.column(name).to_numpy() for name in ("word", "node", "size", "low", "high")])
            before = np.concatenate([last, rows[:3, :-1]], axis=1)
            if rows.shape[1]:
                last = rows[:3, -1:]
            held.append(rows[:, (rows[:3] != before[:, : rows.shape[1]]).any(axis=0)])
            count += held[-1].shape[1]
            if count >= MEET_ROWS:
                yield from settled(np.concatenate(held, axis=1), False)
        yield from settled(np.concatenate(held, axis=1), True)

    return task
