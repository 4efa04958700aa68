"""Removal of word sequences that occur earlier, by recompression.

A word goes if a window of ``length`` words that covers it also starts earlier: in
a document with a smaller id, or before in the same one.

1. Rounds of recompression (Jez 2013) shorten the text: a run of one symbol becomes
   a symbol, then each pair of a left and a right symbol does; a bit of its name
   puts a symbol on a side. Names are fingerprints of what a symbol stands for, so
   all tasks give equal strings the same names without a dictionary. Along with a
   symbol goes its context, the words on which its being there depends.
2. Every window has an anchor: of the symbols whose context fits in ``context``
   words, the one of the highest round, then of the greatest fingerprint of these
   words. It depends on the window's words alone, so equal windows have equal
   anchors at one place. Neighbouring windows with one anchor form a run.
3. Anchors that occur once are alone, and so are their windows. Of runs equal as a
   whole all but the first go, without a look at their windows. Where runs of one
   anchor differ, one of each kind goes on, and 128-bit fingerprints of its windows
   are compared; the first of each stays.

Copies are aggregated before any shuffle, so a large group of copies sends one row
per task. A text is read in pieces of about ``PART_BYTES`` with the words beyond.

Defined cases: null texts are empty; with fewer than ``length`` words a text stays
whole; null ids come first; rows that share an id come in the order of their 64-bit
hashes of the text; of repeated rows one is first, the others' windows all go; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.llm.frames import once_each, parts_of, stored, texts
from isotherm.llm.repeats import NO_ID, PolynomialHash, mixed, sliding

# --- fixed values ---------------------------------------------------------
WHITE = b" \t\n\x0b\x0c\r"
# --------------------------------------------------------------------------
LENGTH, CONTEXT, ROUNDS = 20, 10, 3
PART_BYTES = 1 << 22
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_MOST = np.uint64(2**64 - 1)
_RUNS = pa.schema(
    [("key", pa.int64()), ("content", pa.int64()), ("doc_id", pa.int64()), ("tag", pa.int64()), ("first", pa.int64()), ("starts", pa.int32()), ("weight", pa.int32())]
)
_RUNS_DDL = "key long, content long, doc_id long, tag long, first long, starts int, weight int"
_WINDOWS_DDL = "high long, low long, doc_id long, tag long, first long"


def word_places(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin and end."""
    inside = (data != 32) & ((data < 9) | (data > 13))
    change = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
    return change[::2], change[1::2]


class Words:
    """The words of some pieces of texts as fingerprints, and fingerprints of all sequences of them."""

    def __init__(self, pieces: list[bytes], own: list[int], letters: PolynomialHash, sequences: list[PolynomialHash]):
        data = np.frombuffer(b"\n".join(pieces), np.uint8)
        begins = np.append(0, np.cumsum([len(p) + 1 for p in pieces])[:-1])
        starts, ends = word_places(data)
        self.name = letters.of(letters.prefixes(data), starts, ends - starts)
        self.piece = np.searchsorted(begins, starts, "right") - 1
        self.own = starts - begins[self.piece] < np.array(own)[self.piece]
        self.n_own = np.bincount(self.piece[self.own], minlength=len(pieces))
        n = len(starts)
        self.first = np.searchsorted(self.piece, np.arange(len(pieces)))
        self.end = np.searchsorted(self.piece, self.piece, "right")  # of its piece, for each word
        self.sequences, self.sums = sequences, []
        for hashes in sequences:
            hashes.grow(n + 1)
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(self.name * hashes.up[:n], out=sums[1:])
            self.sums.append(sums)

    def fingerprints(self, which: int, starts, length) -> np.ndarray:
        return self.sequences[which].of(self.sums[which], starts, length)


class Symbols:
    """A text after some rounds: names, the words they span, and the words they depend on (from, to)."""

    def __init__(self, words: Words):
        n = np.arange(len(words.name))
        self.name, self.piece = words.name, words.piece
        self.left, self.right = n, n + 1

    def _neighbours(self) -> tuple[np.ndarray, np.ndarray]:
        """Contexts with those of both neighbours; at an end of the piece there is none, whatever the width."""
        inner = self.piece[1:] == self.piece[:-1]
        left = np.append(-1, np.where(inner, self.left[:-1], -1))
        right = np.append(np.where(inner, self.right[1:], 1 << 60), 1 << 60)
        return np.minimum(self.left, left), np.maximum(self.right, right)

    def runs(self) -> None:
        """Each maximal run of a symbol becomes one; that it ends where it does depends on its neighbours."""
        first = np.flatnonzero(np.append(True, (self.name[1:] != self.name[:-1]) | (self.piece[1:] != self.piece[:-1])))
        count = np.diff(np.append(first, len(self.name)))
        left, right = self._neighbours()
        last = first + count - 1
        name = self.name[first]
        name[count > 1] = mixed(name[count > 1] + mixed(count[count > 1].astype(np.uint64)))
        self.name, self.piece, self.left, self.right = name, self.piece[first], left[first], right[last]

    def pairs(self, turn: int) -> None:
        """Each left symbol before a right one becomes one with it; that others stay depends on the neighbour it could go with."""
        is_left = (mixed(self.name + np.uint64(turn)) & np.uint64(1)).astype(bool)
        joins = np.append(is_left[:-1] & ~is_left[1:] & (self.piece[1:] == self.piece[:-1]), False)
        joined = np.append(False, joins[:-1])
        left, right = self._neighbours()
        left = np.where(is_left, self.left, left)
        right = np.where(is_left, right, self.right)
        at = np.flatnonzero(joins)
        name, first = self.name.copy(), self.left
        name[at] = mixed(mixed(self.name[at]) * np.uint64(3) + self.name[at + 1])
        left[at], right[at] = np.minimum(first[at], first[at + 1]), np.maximum(self.right[at], self.right[at + 1])
        keep = ~joined
        self.name, self.piece, self.left, self.right = name[keep], self.piece[keep], left[keep], right[keep]


class Scanner:
    """Cuts texts into runs of windows with one anchor."""

    def __init__(self, length: int, context: int, rounds: int):
        self.length, self.context, self.rounds = length, context, rounds
        self.span = length - context + 1
        self.letters = PolynomialHash(_BASES[0], 7)
        self.sequences = [PolynomialHash(_BASES[0], 8), PolynomialHash(_BASES[1], 9)]

    def words(self, pieces: list[bytes], own: list[int]) -> Words:
        return Words(pieces, own, self.letters, self.sequences)

    def anchors(self, words: Words) -> np.ndarray:
        """For each word, how much a context that begins with it is worth as an anchor; 0 if there is none."""
        n = len(words.name)
        level = np.ones(n, np.uint64)
        symbols = Symbols(words)
        for turn in range(self.rounds):
            symbols.runs()
            symbols.pairs(turn)
            fits = (symbols.left >= 0) & (symbols.right - symbols.left <= self.context)
            level[symbols.left[fits]] = turn + 2
        places = np.arange(n)
        fits = places + self.context <= words.end
        worth = np.zeros(n, np.uint64)
        worth[fits] = (level[fits] << np.uint64(60)) | (words.fingerprints(0, places[fits], self.context) >> np.uint64(4))
        return worth

    def runs(self, words: Words) -> tuple[np.ndarray, ...]:
        """Key, content, first window, number of windows and weight of each run.

        The weight is the number of places of its anchor: with two, a run may hold equal windows itself.
        """
        n = len(words.name)
        if n < self.length:
            return (np.zeros(0, np.int64),) * 5
        worth = self.anchors(words)
        best = sliding(worth, self.span, np.maximum)
        places = np.arange(len(best))
        valid = words.own[places] & (places + self.length <= words.end[places])
        edge = np.full(self.span - 1, _MOST)
        least = sliding(np.concatenate([edge, np.where(valid, best, _MOST), edge]), self.span)
        chosen = np.flatnonzero((least == worth) & (least != _MOST))
        at = np.flatnonzero(valid)
        if not len(at):
            return (np.zeros(0, np.int64),) * 5

        def changes(where: np.ndarray, value: np.ndarray) -> np.ndarray:
            return np.flatnonzero(np.append(True, (value[1:] != value[:-1]) | (words.piece[where[1:]] != words.piece[where[:-1]])))

        begin = changes(at, best[at])
        first, starts = at[begin], np.diff(np.append(begin, len(at)))
        groups = changes(chosen, worth[chosen])
        weight = np.diff(np.append(groups, len(chosen)))
        if len(weight) != len(first):
            raise AssertionError("every run has its own anchors")
        content = words.fingerprints(1, first, starts + self.length - 1)
        return best[first].view(np.int64), content.view(np.int64), first, starts, weight


def scan_runs(length: int, context: int, rounds: int):
    """Task: texts to runs."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(length, context, rounds)
        for batch in batches:
            rows, pieces, own, held = [], [], [], 0
            before = np.zeros(batch.num_rows, np.int64)  # words of a text in earlier pieces

            def done() -> pa.RecordBatch:
                words = scanner.words(pieces, own)
                key, content, first, starts, weight = scanner.runs(words)
                row = np.array(rows, np.int64)[words.piece[first]]
                base = np.zeros(len(rows), np.int64)
                for i, r in enumerate(rows):
                    base[i] = before[r]
                    before[r] += words.n_own[i]
                place = first - words.first[words.piece[first]] + base[words.piece[first]]
                taken = [batch.column(i).take(pa.array(row)) for i in (0, 2)]
                columns = [pa.array(key), pa.array(content), *taken, pa.array(place), pa.array(starts, pa.int32()), pa.array(weight, pa.int32())]
                return pa.RecordBatch.from_arrays(columns, schema=_RUNS)

            for row, text in enumerate(batch.column(1).cast(pa.binary()).to_pylist()):
                for piece, n in parts_of(text, PART_BYTES, WHITE, length):
                    rows.append(row)
                    pieces.append(piece)
                    own.append(n)
                    held += len(piece)
                    if held >= PART_BYTES:
                        yield done()
                        rows, pieces, own, held = [], [], [], 0
            if pieces:
                yield done()

    return task


def window_fingerprints(length: int, context: int):
    """Task: texts with places of runs to 128-bit fingerprints of their windows."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(length, context, 0)
        for batch in batches:
            for row, text in enumerate(batch.column(2).cast(pa.binary()).to_pylist()):
                first, starts = (np.array(batch.column(i)[row].values.to_numpy(), np.int64) for i in (3, 4))
                at = np.sort(np.repeat(first, starts) + np.arange(starts.sum()) - np.repeat(np.cumsum(starts) - starts, starts))
                base = 0
                for piece, n in parts_of(text, PART_BYTES, WHITE, length):
                    words = scanner.words([piece], [n])
                    local = at[(at >= base) & (at < base + words.n_own[0])] - base
                    high, low = (words.fingerprints(i, local, length).view(np.int64) for i in (0, 1))
                    same = [pa.array([batch.column(i)[row].as_py()] * len(local), pa.int64()) for i in (0, 1)]
                    yield pa.RecordBatch.from_arrays([pa.array(high), pa.array(low), *same, pa.array(local + base)], names=["high", "low", "doc_id", "tag", "first"])
                    base += int(words.n_own[0])

    return task


def later_windows(rows: DataFrame, length: int, context: int, rounds: int) -> DataFrame:
    """``doc_id, tag, first, starts``: windows that start earlier, too; ``rows`` has each ``doc_id, tag, text`` once."""
    runs = stored(rows.select("doc_id", "text", "tag").mapInArrow(scan_runs(length, context, rounds), _RUNS_DDL), "runs")
    shared = runs.groupBy("key").agg(F.sum("weight").alias("weight")).where("weight > 1").select("key")
    candidates = stored(runs.join(shared, "key", "left_semi"), "candidates")
    place = F.struct("doc_id", "tag", "first", "starts", "weight")
    kinds = stored(candidates.groupBy("key", "content").agg(F.min(place).alias("run")), "kinds")

    placed = kinds.select("key", "content", F.struct("run.doc_id", "run.tag", "run.first").alias("earliest"))
    copies = candidates.join(placed, ["key", "content"]).where(F.struct("doc_id", "tag", "first") != F.col("earliest"))
    copies = copies.select("doc_id", "tag", "first", "starts")

    several = kinds.groupBy("key").agg(F.sum("run.weight").alias("places")).where("places > 1").select("key")
    unsure = kinds.join(several, "key", "left_semi").select("run.*")
    by_doc = unsure.groupBy("doc_id", "tag").agg(F.collect_list("first").alias("first"), F.collect_list("starts").alias("starts"))
    opened = rows.select("doc_id", "tag", "text").join(by_doc, ["doc_id", "tag"])
    windows = stored(opened.mapInArrow(window_fingerprints(length, context), _WINDOWS_DDL), "windows")
    place = F.struct("doc_id", "tag", "first")
    twice = windows.groupBy("high", "low").agg(F.min(place).alias("earliest"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    later = windows.join(twice, ["high", "low"]).where(place != F.col("earliest"))
    return copies.unionByName(later.select("doc_id", "tag", "first", F.lit(1).alias("starts")))


def cut_texts(length: int):
    """Task: texts with places of windows to the words that stay; a count of -1 stands for all windows."""
    names = ["doc_id", "n_words", "n_removed", "kept"]

    def cut(text: bytes, first: np.ndarray, starts: np.ndarray) -> tuple[int, int, bytes]:
        data = np.frombuffer(text, np.uint8)
        begin, end = word_places(data)
        n = len(begin)
        starts = np.where(starts < 0, max(n - length + 1, 0), starts)
        first, starts = first[starts > 0], starts[starts > 0]
        change = np.zeros(n + 1, np.int64)
        np.add.at(change, first, 1)
        np.add.at(change, first + starts + length - 1, -1)
        kept = np.cumsum(change[:-1]) == 0
        begin, end = begin[kept], end[kept]
        if not len(begin):
            return n, n, b""
        out = np.append(data, np.uint8(32))
        out[end] = 32
        edges = np.zeros(len(out) + 1, np.int8)
        edges[begin] += 1
        edges[end + 1] -= 1
        return n, n - len(begin), out[np.cumsum(edges[:-1], dtype=np.int8) > 0].tobytes()[:-1]

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        for batch in batches:
            out = []
            for row, text in enumerate(batch.column(1).cast(pa.binary()).to_pylist()):
                places = [np.array(batch.column(i)[row].values.to_numpy(), np.int64) if batch.column(i)[row].is_valid else none for i in (2, 3)]
                out.append(cut(text, *places))
            n_words, n_removed, kept = zip(*out, strict=True) if out else ([], [], [])
            columns = [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return task


def cut_later(
    docs: DataFrame, length: int = LENGTH, context: int = CONTEXT, rounds: int = ROUNDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, kept`` (the words that stay, joined by spaces)."""
    if not 1 < context < length:
        raise ValueError("context has to be longer than a word and shorter than a window")
    rows = texts(docs, id_col=id_col, text_col=text_col)
    rows = rows.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "text", F.xxhash64("text").alias("tag"))
    once, named, counted = once_each(rows)
    others = counted.withColumn("n", F.col("n") - (F.col("part") == F.col("first_part")).cast("long")).where("n > 0")
    others = others.withColumn("nth", F.explode(F.expr("sequence(1L, n)"))).select("doc_id", "tag")  # of one task's rows
    others = others.join(once.join(named, ["doc_id", "tag"], "left_semi"), ["doc_id", "tag"])
    by_doc = later_windows(once, length, context, rounds).groupBy("doc_id", "tag").agg(F.collect_list("first").alias("first"), F.collect_list("starts").alias("starts"))
    marked = once.join(by_doc, ["doc_id", "tag"], "left").select("doc_id", "text", "first", "starts")
    whole = others.select("doc_id", "text", F.array(F.lit(0).cast("long")).alias("first"), F.array(F.lit(-1)).alias("starts"))
    cut = marked.unionByName(whole).mapInArrow(cut_texts(length), "doc_id long, n_words long, n_removed long, kept string")
    return cut.withColumn("doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")))
