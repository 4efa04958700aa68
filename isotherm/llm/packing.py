"""Packing of tokenised documents into as few sequences as possible by minimum bin slack.

Only how many pieces there are of each length decides what a sequence can hold,
so the packing is planned over that histogram, which has at most as many rows as
a sequence has tokens, whatever the number of documents. For each sequence the
longest piece left is taken, and a bitset of reachable sums finds the lengths
that fill the rest best; the same combination is then used as often as the
histogram allows. Pieces find their place by their rank among pieces of equal
length, counted per task, so that no piece passes through the driver.

Ids are those of the plain library call: the name of a special token within a text
becomes its one id. Texts that hold such a name go through the library as a whole.

Defined cases: null texts are empty and become one piece of one token (the end
token); repeated rows are packed each on its own; a null id is kept as null.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isotherm.llm.frames import in_batches, per_process, stored, texts

#: Entries a worker keeps of each cache; beyond, it starts anew.
MOST_CHUNKS, MOST_WORDS, LONGEST_KEPT = 1_000_000, 800_000, 64
#: White space for str.split that the tokenizer takes for ordinary characters.
ODD_SPACES = "\x1c\x1d\x1e\x1f"
#: Below this code point our pattern engine and the tokenizer's agree on letters and digits.
PLAIN_BELOW = "ɐ"


class WordTokens(dict):
    """White-space separated chunk to its ids as bytes, by a tokenizer that drops white space.

    A chunk's ids don't depend on its neighbours, so each is encoded once per worker.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # chunks are plain text, see encode
        self.plain = Tokenizer.from_file(path)
        form = json.loads(self.tokenizer.to_str())
        self.added = [token["content"].lower() for token in form["added_tokens"]]
        self.mark = re.match(r"[^A-Za-z]*", os.path.commonprefix(self.added))[0]  # all of them begin so, in any case
        splits = form["pre_tokenizer"]["pretokenizers"]
        self.find = regex.compile(splits[0]["pattern"]["Regex"]).findall
        self.words: dict[str, bytes] = {}

    def library(self, text: str) -> bytes:
        return self._ids(self.tokenizer, text)

    @staticmethod
    def _ids(tokenizer, text: str) -> bytes:
        return np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def word(self, word: str) -> bytes:
        ids = self.words.get(word)
        if ids is None:
            if word.isascii():
                ids = np.array([token.id for token in self.tokenizer.model.tokenize(word)], "<u4").tobytes()
            else:
                ids = self.library(word)
            if len(word) <= LONGEST_KEPT:
                if len(self.words) >= MOST_WORDS:
                    self.words.clear()
                self.words[word] = ids
        return ids

    def __missing__(self, chunk: str) -> bytes:
        if chunk.isascii():
            ids = b"".join(map(self.word, self.find(chunk.lower())))
        elif max(chunk) < PLAIN_BELOW:
            ids = b"".join(map(self.word, self.find(self.tokenizer.normalizer.normalize_str(chunk))))
        else:
            ids = self.library(chunk)
        if len(chunk) <= LONGEST_KEPT:
            if len(self) >= MOST_CHUNKS:
                self.clear()
            self[chunk] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if self.mark in text:
            lowered = text.lower()
            if any(token in lowered for token in self.added):  # may be a control token within the text
                return self._ids(self.plain, text)
        if any(c in text for c in ODD_SPACES):
            return self.library(text)
        return b"".join(map(self.__getitem__, text.split()))


def word_tokens(path: str) -> WordTokens:
    return per_process(("word_tokens", path), lambda: WordTokens(path))


PIECES = [
    ("doc_id", pa.int64(), "long"),
    ("piece", pa.int32(), "int"),
    ("start", pa.int64(), "long"),
    ("length", pa.int64(), "long"),
    ("ids_crc32", pa.int64(), "long"),
    ("task", pa.int32(), "int"),
    ("place", pa.int64(), "long"),
]
IDS = ("ids", pa.binary(), "binary")


def _schemas(fields) -> tuple[pa.Schema, str]:
    return pa.schema([f[:2] for f in fields]), ", ".join(f"{f[0]} {f[2]}" for f in fields)


def tokenized_pieces(
    docs: DataFrame, path: str, most: int = 4096, end_id: int = 1, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Pieces of at most ``most`` tokens; ``task`` and ``place`` number pieces of equal length within a task.

    ``with_ids`` adds the ids as little-endian unsigned 32-bit integers.
    """
    schema, ddl = _schemas([*PIECES, IDS] if with_ids else PIECES)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, seen, number = word_tokens(path), Counter(), TaskContext.get().partitionId()
        end = np.array([end_id], "<u4").tobytes()

        def step(batch: pa.RecordBatch) -> list[pa.Array]:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = tokens.encode(text) + end
                for piece, at in enumerate(range(0, len(ids), 4 * most)):
                    part = ids[at : at + 4 * most]
                    length = len(part) // 4
                    row = (doc_id, piece, at // 4, length, zlib.crc32(part), number, seen[length])
                    rows.append((*row, part) if with_ids else row)
                    seen[length] += 1
            columns = zip(*rows, strict=True)
            return [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]

        yield from in_batches(batches, step, schema)

    return texts(docs, id_col=id_col, text_col=text_col).mapInArrow(task, ddl)


def fullest(counts: dict[int, int], room: int) -> list[int]:
    """Lengths of the fullest combination within ``room``, longest first.

    Subset sums as a bitset: bit s is set if some combination has the sum s. The
    bitset after each length is kept to walk back from the largest sum.
    """
    reachable, steps, full = 1, [], (1 << (room + 1)) - 1
    for length in sorted((x for x in counts if x <= room), reverse=True):
        before, use, taken = reachable, 1, 0
        most = min(counts[length], room // length)
        while taken < most:  # 1, 2, 4 ... copies give every number of copies
            use = min(use, most - taken)
            reachable |= reachable << (use * length) & full
            taken, use = taken + use, use * 2
        if reachable != before:
            steps.append((length, most, before))
        if reachable >> room & 1:
            break
    rest, chosen = reachable.bit_length() - 1, []
    for length, most, before in reversed(steps):
        copies = next(c for c in range(most + 1) if rest >= c * length and before >> (rest - c * length) & 1)
        chosen += [length] * copies
        rest -= copies * length
    return sorted(chosen, reverse=True)


def plan_sequences(histogram: dict[int, int], most: int) -> list[tuple[list[int], int]]:
    """Combinations of lengths with the number of sequences that use each."""
    left, plan = dict(histogram), []
    while left:
        first = max(left)
        rest = dict(left)
        rest[first] -= 1
        if not rest[first]:
            del rest[first]
        lengths = [first, *fullest(rest, most - first)]
        used = Counter(lengths)
        times = min(left[x] // n for x, n in used.items())
        plan.append((lengths, times))
        for x, n in used.items():
            left[x] -= n * times
            if not left[x]:
                del left[x]
    return plan


def places_by_length(plan: list[tuple[list[int], int]]) -> dict[int, dict[str, np.ndarray]]:
    """For each length: from which rank on pieces go to which sequences at which offset.

    A few small arrays: combinations are at most about as many as lengths.
    """
    found: dict[int, list[tuple[int, int, int, int]]] = {}
    taken, sequence = Counter(), 0
    for lengths, times in plan:
        offset = 0
        for length, copies in Counter(lengths).items():
            found.setdefault(length, []).append((taken[length], copies, sequence, offset))
            taken[length] += copies * times
            offset += copies * length
        sequence += times
    return {x: dict(zip(("rank", "copies", "sequence", "offset"), np.array(rows, np.int64).T, strict=True)) for x, rows in found.items()}


def pack(pieces: DataFrame, most: int = 4096) -> DataFrame:
    """``pieces`` (written, so that their ``task`` and ``place`` are fixed) with ``sequence_id`` and ``offset``."""
    by_task = stored(pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")), "lengths")
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    first = by_task.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    histogram = dict(by_task.groupBy("length").agg(F.sum("n")).collect())  # at most `most` rows
    places = places_by_length(plan_sequences(histogram, most))
    # Rows of `first` grow with the number of tasks, so it is not for a broadcast.
    ranked = pieces.join(first.hint("merge"), ["task", "length"]).withColumn("rank", F.col("first") + F.col("place")).drop("first", "task", "place")
    kept = [c for c in ranked.columns if c != "rank"]
    fields = [ranked.schema[c] for c in kept]
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields) + ", sequence_id long, offset long"

    def step(batch: pa.RecordBatch) -> list[pa.Array]:
        length, rank = (batch.column(name).to_numpy(zero_copy_only=False) for name in ("length", "rank"))
        sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
        for x in np.unique(length):
            rows, at = np.flatnonzero(length == x), places[int(x)]
            use = np.searchsorted(at["rank"], rank[rows], "right") - 1
            nth = rank[rows] - at["rank"][use]
            sequence[rows] = at["sequence"][use] + nth // at["copies"][use]
            offset[rows] = at["offset"][use] + nth % at["copies"][use] * x
        return [*(batch.column(c) for c in kept), pa.array(sequence), pa.array(offset)]

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(step(batch), names=[*kept, "sequence_id", "offset"])

    return ranked.mapInArrow(task, ddl)


def pack_documents(
    docs: DataFrame, path: str, most: int = 4096, end_id: int = 1, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset``: one row per piece."""
    pieces = tokenized_pieces(docs, path, most, end_id, with_ids, id_col, text_col)
    return pack(stored(pieces, "pieces"), most)
