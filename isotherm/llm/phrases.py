"""Phrases whose words stand together more often than apart, by prefix-free parsing.

1. A text becomes its words and breaks. Words whose hash ends in zeros trigger a
   cut, so equal stretches of text are cut alike wherever they stand. A chunk runs
   from one cut to the next, and ``LONGEST - 1`` words beyond.
2. Equal chunks of one language are counted, with pre-aggregation: a dictionary of
   distinct chunks with their frequencies. Copies of texts end here.
3. Phrases are counted inside distinct chunks, weighted by frequency. A phrase
   belongs to the chunk in whose own part it starts, so none counts twice where
   chunks overlap, and all of it lies within that chunk.
4. Only phrases whose two shorter halves are frequent can be frequent. The frequent
   word pairs are kept as a bitmap of ``FILTER_CELLS`` bits, 16 MB whatever the
   input, and triples that fail it are not shuffled. A full bitmap lets all pass.

Texts are cut in parts of about ``PART_BYTES`` at separators, with the words beyond
the cut, so a long text needs no more memory than a short one.

Arithmetic is in decimals of 38 digits: exact for counts below 10**16.

Defined cases: null texts are empty; a null language is ``und``; repeated rows and
rows that share an id count each; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isotherm.llm.frames import parts_of, stored
from isotherm.llm.repeats import PolynomialHash
from isotherm.session import configure

# --- fixed values ---------------------------------------------------------
SPACES, BREAKS = b" \t", b".,;:!?\n\x0b\x0c\r"
# --------------------------------------------------------------------------
LONGEST, LEAST, TOP, SHADOW = 3, 10, 2000, 50
#: One word in ``TRIGGER`` cuts; a stretch without such words is cut every ``CHUNK_WORDS``.
TRIGGER, CHUNK_WORDS = 16, 256
PART_BYTES, TOKENS = 1 << 22, 1 << 20
FILTER_CELLS = 1 << 27
UNKNOWN = "und"

_SPACE, _BREAK = 32, 10
_CHUNKS = pa.schema([("lang", pa.string()), ("chunk", pa.string()), ("own", pa.int32())])
_GRAMS = pa.schema([("lang", pa.string()), ("words", pa.int32()), ("phrase", pa.string()), ("f", pa.int64())])


# --- chunks -------------------------------------------------------------------


class Cutter:
    """Cuts many parts at once."""

    def __init__(self):
        self.hashes = PolynomialHash(0x9E3779B97F4A7C15, 6)
        self.plain = np.arange(256, dtype=np.uint8)
        self.plain[65:91] += 32
        self.plain[list(SPACES)], self.plain[list(BREAKS)] = _SPACE, _BREAK

    def chunks(self, parts: list[bytes], own: list[int]) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        """For each chunk: its part, its text and the number of its own words."""
        data = self.plain[np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)]
        begins = np.append(0, np.cumsum([len(p) + 1 for p in parts])[:-1])
        inside = (data != _SPACE) & (data != _BREAK)
        change = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0))
        starts, ends = change[::2], change[1::2]
        if not len(starts):
            return np.zeros(0, np.int64), pa.array([], pa.string()), np.zeros(0, np.int64)

        # The words one behind the other, each with one byte that says how it is divided from the next.
        seen = np.cumsum(data == _BREAK)
        broken = np.append(seen[starts[1:] - 1] > seen[ends[:-1] - 1], True)
        data[ends] = np.where(broken, _BREAK, _SPACE)
        inside[ends] = True
        data = data[inside]
        sizes = ends - starts + 1
        first = np.append(0, np.cumsum(sizes)[:-1])
        hashes = self.hashes.of(self.hashes.prefixes(data), first, sizes - 1)

        part = np.searchsorted(begins, starts, "right") - 1
        new_part = np.append(True, part[1:] != part[:-1])
        lent = starts - begins[part] >= np.array(own)[part]
        cuts = new_part | (hashes % np.uint64(TRIGGER) == 0) | np.append(lent[0], lent[1:] != lent[:-1])
        cuts = np.flatnonzero(cuts)
        pieces = -(-np.diff(np.append(cuts, len(starts))) // CHUNK_WORDS)
        nth = np.arange(pieces.sum()) - np.repeat(np.append(0, np.cumsum(pieces)[:-1]), pieces)
        cuts = np.repeat(cuts, pieces) + nth * CHUNK_WORDS
        following = np.append(cuts[1:], len(starts))
        keep = ~lent[cuts]
        cuts, following = cuts[keep], following[keep]
        part_end = np.append(np.flatnonzero(new_part)[1:], len(starts))[np.cumsum(new_part)[cuts] - 1]
        last = np.minimum(following + LONGEST - 1, part_end) - 1

        lengths = first[last] + sizes[last] - 1 - first[cuts]
        offsets = np.append(0, np.cumsum(lengths))
        bytes_at = np.arange(offsets[-1]) + np.repeat(first[cuts] - offsets[:-1], lengths)
        buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data[bytes_at])]
        return part[cuts], pa.Array.from_buffers(pa.string(), len(cuts), buffers), following - cuts


def cut_texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: languages and texts to chunks."""
    cutter = Cutter()
    for batch in batches:
        rows, parts, own, held = [], [], [], 0

        def done() -> pa.RecordBatch:
            part, chunk, n_own = cutter.chunks(parts, own)
            lang = batch.column(0).take(pa.array(np.array(rows, np.int64)[part]))
            return pa.RecordBatch.from_arrays([lang, chunk, pa.array(n_own, pa.int32())], schema=_CHUNKS)

        for row, text in enumerate(batch.column(1).cast(pa.binary()).to_pylist()):
            for piece, n in parts_of(text, PART_BYTES, SPACES + BREAKS, LONGEST):
                rows.append(row)
                parts.append(piece)
                own.append(n)
                held += len(piece)
                if held >= PART_BYTES:
                    yield done()
                    rows, parts, own, held = [], [], [], 0
        if parts:
            yield done()


def chunk_dictionary(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Distinct chunks of each language with their frequency: ``lang, chunk, own, freq``."""
    rows = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    chunks = rows.mapInArrow(cut_texts, "lang string, chunk string, own int")
    return chunks.groupBy("lang", "chunk", "own").agg(F.count(F.lit(1)).alias("freq"))


# --- counts -------------------------------------------------------------------


def _sums(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the exact sums of their weights."""
    if not len(keys):
        return keys, weights
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(weights[order], first)


class Grams:
    """Tokens of some chunks as numbers, and where phrases of their own start."""

    def __init__(self, rows: pa.Table):
        spaced = pc.replace_substring(rows["chunk"].combine_chunks(), "\n", " \n ")
        lists = pc.split_pattern(spaced, " ")
        words = pc.list_flatten(lists).dictionary_encode()
        langs = rows["lang"].combine_chunks().dictionary_encode()
        self.words, self.langs = words.dictionary, langs.dictionary
        self.token = words.indices.to_numpy().astype(np.int64)
        self.row = pc.list_parent_indices(lists).to_numpy().astype(np.int64)
        self.lang = langs.indices.to_numpy().astype(np.int64)[self.row]
        self.weight = rows["freq"].to_numpy()[self.row]
        breaks = pc.index(self.words, "\n").as_py()
        self.word = self.token != breaks
        nth = np.cumsum(self.word)
        base = np.append(0, nth)[np.flatnonzero(np.append(True, self.row[1:] != self.row[:-1]))]
        self.starts = self.word & (nth - base[np.cumsum(np.append(True, self.row[1:] != self.row[:-1])) - 1] <= rows["own"].to_numpy()[self.row])
        together = self.word[:-1] & self.word[1:] & (self.row[:-1] == self.row[1:])
        self.together = np.append(together, False)

    def one(self) -> pa.RecordBatch:
        at = np.flatnonzero(self.starts)
        key, f = _sums(self.lang[at] * len(self.words) + self.token[at], self.weight[at])
        return self._rows(key // len(self.words), [key % len(self.words)], f)

    def totals(self) -> pa.RecordBatch:
        key, f = _sums(self.lang[self.starts], self.weight[self.starts])
        return self._rows(key, [], f)

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Where pairs stand, also those behind the own words, and their keys."""
        at = np.flatnonzero(self.together)
        n = len(self.words)
        return at, (self.lang[at] * n + self.token[at]) * n + self.token[at + 1]

    def pair_rows(self, key: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
        n = len(self.words)
        return self._rows(key // n // n, [key // n % n, key % n], f)

    def two(self) -> pa.RecordBatch:
        at, key = self.pairs()
        own = self.starts[at]
        return self.pair_rows(*_sums(key[own], self.weight[at[own]]))

    def three(self, filled: np.ndarray) -> pa.RecordBatch:
        """Triples both of whose pairs pass the bitmap."""
        at, key = self.pairs()
        kinds, kind = np.unique(key, return_inverse=True)
        named = self.pair_rows(kinds, kinds)
        cells = np.array([cell_of(x, y) for x, y in zip(*(named.column(i).cast(pa.binary()).to_pylist() for i in (0, 2)), strict=True)], np.int64)
        passing = (filled[cells >> 6] >> (cells & 63).astype(np.uint64) & np.uint64(1)).astype(bool)[kind] if len(kinds) else np.zeros(0, bool)
        good = np.zeros(len(self.token) + 1, bool)
        pair = np.zeros(len(self.token), np.int64)
        good[at], pair[at] = passing, kind
        at = np.flatnonzero(self.starts & good[:-1] & good[1:])
        n = len(self.words)
        key, f = _sums(pair[at] * n + self.token[np.minimum(at + 2, len(self.token) - 1)], self.weight[at])
        both = kinds[key // n]
        return self._rows(both // n // n, [both // n % n, both % n, key % n], f)

    def _rows(self, lang: np.ndarray, words: list[np.ndarray], f: np.ndarray) -> pa.RecordBatch:
        taken = [self.words.take(pa.array(w)) for w in words]
        phrase = pc.binary_join_element_wise(*taken, " ") if taken else pa.array([""] * len(f), pa.string())
        columns = [self.langs.take(pa.array(lang)), pa.array(np.full(len(f), len(words)), pa.int32()), phrase, pa.array(f, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, schema=_GRAMS)


def cell_of(lang: bytes, phrase: bytes) -> int:
    return zlib.crc32(lang + b"\n" + phrase) % FILTER_CELLS


def _cell() -> Column:
    return (F.crc32(F.concat("lang", F.lit("\n"), "phrase").cast("binary")) % FILTER_CELLS).alias("cell")


def _held(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Chunks of about ``TOKENS`` words at a time."""
    held, words = [], 0
    for batch in batches:
        held.append(batch)
        words += pc.sum(batch.column(2)).as_py() or 0
        if words >= TOKENS:
            yield pa.Table.from_batches(held)
            held, words = [], 0
    if words:
        yield pa.Table.from_batches(held)


def _ones_and_twos(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in _held(batches):
        grams = Grams(rows)
        yield from (grams.totals(), grams.one(), grams.two())


def _threes(bitmap):
    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _held(batches):
            yield Grams(rows).three(bitmap.value)

    return task


def frequent_phrases(dictionary: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """Words, pairs and triples that occur ``least`` times: ``lang, words, phrase, f``; with no words: all of a language."""
    spark = dictionary.sparkSession
    ddl = "lang string, words int, phrase string, f long"

    def summed(found: DataFrame, purpose: str) -> DataFrame:
        return stored(found.groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f")).where(f"f >= {least} OR words = 0"), purpose)

    short = summed(dictionary.mapInArrow(_ones_and_twos, ddl), "short-phrases")
    cells = short.where("words = 2").select(_cell())
    bits = cells.groupBy(F.shiftright("cell", 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(cell % 64 AS INT))")).alias("bits"))
    found = bits.toArrow()  # at most FILTER_CELLS / 64 rows
    filled = np.zeros(FILTER_CELLS // 64, np.uint64)
    filled[found["at"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    bitmap = spark.sparkContext.broadcast(filled)
    return short, summed(dictionary.mapInArrow(_threes(bitmap), ddl), "long-phrases")


# --- scores -------------------------------------------------------------------


def score(a: str = "a", left: str = "l", right: str = "r") -> Column:
    """``floor(1000000 * a * a / (l * r))`` without rounding."""
    square = f"CAST(1000000 AS DECIMAL(38, 0)) * CAST({a} AS DECIMAL(19, 0)) * CAST({a} AS DECIMAL(19, 0))"
    return F.expr(f"({square}) DIV (CAST({left} AS DECIMAL(19, 0)) * CAST({right} AS DECIMAL(19, 0)))")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, top: int = TOP, shadow: int = SHADOW) -> DataFrame:
    """The first ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``."""
    configure(docs.sparkSession)
    dictionary = stored(chunk_dictionary(docs, text_col, lang_col), "chunks")
    short, triples = frequent_phrases(dictionary, least)
    totals = short.where("words = 0").select("lang", F.col("f").alias("n"))

    def named(frame: DataFrame, phrase: str, f: str) -> DataFrame:
        return frame.select("lang", F.col("phrase").alias(phrase), F.col("f").alias(f))

    word, pair = short.where("words = 1"), short.where("words = 2")
    head, last = F.substring_index("phrase", " ", 1), F.substring_index("phrase", " ", -1)
    twos = named(pair, "phrase", "a").withColumn("w1", head).withColumn("w2", last)
    twos = twos.join(named(word, "w1", "l"), ["lang", "w1"]).join(named(word, "w2", "r"), ["lang", "w2"])
    cut = F.struct(score().alias("score"), F.lit(1).alias("k"), "l", "r")
    twos = twos.select("lang", "phrase", "a", cut.alias("cut"))

    threes = named(triples, "phrase", "a").withColumn("w1", head).withColumn("w3", last)
    threes = threes.withColumn("w12", F.substring_index("phrase", " ", 2)).withColumn("w23", F.substring_index("phrase", " ", -2))
    shadows = threes.select("lang", "a", F.explode(F.array("w12", "w23")).alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    for side, key, f in ((word, "w1", "l1"), (pair, "w23", "r1"), (pair, "w12", "l2"), (word, "w3", "r2")):
        threes = threes.join(named(side, key, f), ["lang", key])
    cuts = (F.struct(score("a", f"l{k}", f"r{k}").alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")) for k in (1, 2))
    threes = threes.select("lang", "phrase", "a", F.least(*cuts).alias("cut"))

    kept = twos.join(shadows, ["lang", "phrase"], "left").where(f"longer IS NULL OR 100 * longer < {shadow} * a").drop("longer")
    found = kept.unionByName(threes).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).join(totals, "lang")
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
