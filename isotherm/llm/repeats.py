"""Removal of passages that occur anywhere else, by merged Burrows-Wheeler transforms.

A byte is removed if a string of ``length`` bytes that covers it also starts
somewhere else. Three steps, each over all rows:

1. Every start of such a string has a key, the smallest hash of the short grams
   inside the string. Equal strings have equal keys, so starts whose key is found
   once are unique. Starts with one key lie side by side and form a run.
2. Runs that equal another run byte for byte are repeated as a whole. Where runs
   of one key differ, one of each kind goes on.
3. These runs, partitioned by key, are dealt over shards. Each shard gets the
   Burrows-Wheeler transform of its runs; the transforms are merged by refining
   the interleave, one letter a round (Holt and McMillan 2014), and the common
   prefixes that fall out of the rounds (Egidi and Manzini 2017) delimit the
   intervals of suffixes that share ``length`` bytes.

A letter of the transforms is a block of 40 bytes, so that 200 bytes take five
rounds; it is known by a 64-bit hash, whose order serves as the alphabet's. No
suffixes are sorted but those of a shard.

A key whose kinds of runs exceed ``MOST_KEY_BYTES`` would be too much for one
task; its starts are compared by 128-bit hashes of their strings instead, which
are counted with pre-aggregation. That is the exact way for the rest.

Defined cases: null texts are empty; texts shorter than ``length`` stay whole;
rows that share an id are told apart by a 64-bit hash of their text; of repeated
rows one is scanned, and as each occurs elsewhere all of their strings go; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.llm.frames import lean, once_each, stored, texts, width

LENGTH, GRAM, LETTER = 200, 64, 40
#: Bytes of a text that are hashed at once, and starts that a run has at most; longer ones are cut.
SEGMENT, RUN_STARTS = 1 << 20, 4096
#: Bytes of runs whose transforms are merged at once, and of one key at most.
MERGE_BYTES, MOST_KEY_BYTES = 1 << 19, 1 << 20
#: Stands for every start of a text, where a row is repeated.
_ALL = -1
#: Stands for a null id inside, as joins don't match nulls.
NO_ID = -(2**63)

_ONE = np.uint64(1)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


class PolynomialHash:
    """64-bit hashes of all substrings of a text by differences of prefix sums."""

    def __init__(self, base: int, seed: int):
        self.base, self.size = base, 0
        self.values = np.random.default_rng(seed).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + _ONE
        self.grow(1 << 12)

    def grow(self, size: int) -> None:
        if size > self.size:
            up, down = np.full(size, self.base, np.uint64), np.full(size, pow(self.base, -1, 2**64), np.uint64)
            up[0] = down[0] = 1
            self.up, self.down, self.size = np.multiply.accumulate(up), np.multiply.accumulate(down), size

    def prefixes(self, data: np.ndarray) -> np.ndarray:
        self.grow(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.up[: len(data)], out=sums[1:])
        return sums

    def of(self, sums: np.ndarray, starts, length) -> np.ndarray:
        """Hashes of the strings at ``starts``."""
        return mixed((sums[starts + length] - sums[starts]) * self.down[starts])

    def all_of(self, sums: np.ndarray, length: int) -> np.ndarray:
        """Hashes of the strings at every place."""
        found = sums[length:] - sums[:-length]
        found *= self.down[: len(found)]
        return mixed(found)


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= _MIX
    x ^= x >> np.uint64(32)
    return x


def sliding(x: np.ndarray, span: int, best=np.minimum) -> np.ndarray:
    """``best`` over every ``span`` neighbours, from running bests of blocks in both directions."""
    fill = np.iinfo(np.uint64).max if best is np.minimum else 0
    blocks = np.full(-(-len(x) // span) * span, fill, np.uint64)
    blocks[: len(x)] = x
    blocks = blocks.reshape(-1, span)
    ahead = best.accumulate(blocks, axis=1).ravel()
    behind = best.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(behind[: len(x) - span + 1], ahead[span - 1 : len(x)])


class RunScanner:
    """Cuts texts into runs of starts with one key."""

    def __init__(self, length: int, gram: int):
        self.length, self.gram, self.span = length, gram, length - gram + 1
        self.keys, self.contents = PolynomialHash(_BASES[0], 1), PolynomialHash(_BASES[1], 2)

    def runs(self, data: np.ndarray) -> tuple[np.ndarray, ...]:
        """Key, content hash, first start, number of starts and weight of each run of a segment.

        The weight is 2 where a run may hold equal strings itself, as its key
        occurs in it more than once.
        """
        grams = self.keys.all_of(self.keys.prefixes(data), self.gram)
        least = sliding(grams, self.span)
        first = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
        edge = np.zeros(self.span - 1, np.uint64)
        places = np.count_nonzero(grams == sliding(np.concatenate([edge, least, edge]), self.span, np.maximum))
        weight = 1 if places == len(first) else 2
        starts = np.diff(np.append(first, len(least)))
        keys = least[first]
        if starts.max() > RUN_STARTS:
            parts = -(-starts // RUN_STARTS)
            nth = np.arange(parts.sum()) - np.repeat(np.append(0, np.cumsum(parts)[:-1]), parts)
            keys, first, whole = np.repeat(keys, parts), np.repeat(first, parts) + nth * RUN_STARTS, np.repeat(starts, parts)
            starts = np.minimum(whole - nth * RUN_STARTS, RUN_STARTS)
        contents = self.contents.of(self.contents.prefixes(data), first, starts + self.length - 1)
        return keys.view(np.int64), contents.view(np.int64), first, starts, np.full(len(keys), weight)


RUNS = [("key", pa.int64()), ("content", pa.int64()), ("doc_id", pa.int64()), ("tag", pa.int64()), ("first", pa.int64()), ("starts", pa.int32()), ("weight", pa.int32())]


def scan_runs(length: int, gram: int):
    """Task: texts to runs."""
    schema = pa.schema(RUNS)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = RunScanner(length, gram)
        for batch in batches:
            found, docs = [], []
            for row, text in enumerate(batch.column(1).cast(pa.binary()).to_pylist()):
                data = np.frombuffer(text, np.uint8)
                for at in range(0, len(data) - length + 1, SEGMENT):
                    key, content, first, starts, weight = scanner.runs(data[at : at + SEGMENT + length - 1])
                    found.append((key, content, first + at, starts, weight))
                    docs.append(np.full(len(key), row))
            if found:
                key, content, first, starts, weight = (np.concatenate(x) for x in zip(*found, strict=True))
                rows = pa.array(np.concatenate(docs))
                columns = [pa.array(key), pa.array(content), batch.column(0).take(rows), batch.column(2).take(rows)]
                columns += [pa.array(first, pa.int64()), pa.array(starts, pa.int32()), pa.array(weight, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return task


# --- transforms -------------------------------------------------------------


class Letters:
    """The letters of a batch of runs: block hashes as ranks, and each place's successor one block on.

    The places of a run less than a block from its end are terminators, all different.
    """

    def __init__(self, runs: list[bytes], letter: int, hashes: PolynomialHash):
        data = np.frombuffer(b"".join(runs), np.uint8)
        lengths = np.array([len(x) for x in runs])
        ends = np.repeat(np.cumsum(lengths), lengths)
        places = np.arange(len(data))
        self.run = np.repeat(np.arange(len(runs)), lengths)
        self.offset = places - (ends - np.repeat(lengths, lengths))
        full = places + letter <= ends - 1  # the terminator of the chain is a place of the run, too
        codes = hashes.of(hashes.prefixes(data), places[full], letter)
        self.codes = np.zeros(len(data), np.int64)
        self.codes[full] = np.unique(codes, return_inverse=True)[1] + 1
        self.next = np.where(full, places + letter, -1)


class Shard:
    """Sorted suffixes of some runs: in order, first letters and the ranks of the successors.

    ``letters[i]`` and ``follow[i]`` say that the suffix of rank i begins with that
    letter and goes on with the suffix of rank ``follow[i]``: read from the
    successor's side, that is the transform (its letter at rank ``follow[i]``).
    """

    def __init__(self, letters: Letters, places: np.ndarray):
        local = np.full(len(letters.codes), -1)
        local[places] = np.arange(len(places))
        codes, following = letters.codes[places], letters.next[places]
        after = np.where(following >= 0, local[following], -1)
        n, ends = len(places), np.count_nonzero(following < 0)
        # Terminators differ and come first; then prefix doubling until all ranks differ.
        ranks = np.where(after < 0, np.cumsum(after < 0) - 1, codes + ends)
        jump = after
        while True:
            onward = np.where(jump >= 0, ranks[jump] + 1, 0)
            keys = ranks * (max(int(ranks.max(initial=0)), n) + 2) + onward
            order = np.argsort(keys, kind="stable")
            steps = np.append(False, keys[order][1:] != keys[order][:-1])
            ranks = np.empty(n, np.int64)
            ranks[order] = np.cumsum(steps)
            if not n or ranks[order[-1]] == n - 1:
                break
            jump = np.where(jump >= 0, jump[jump], -1)
        self.places = places[order]
        self.letters = codes[order]
        self.follow = np.where(after[order] >= 0, ranks[after[order]], -1)


def repeated_intervals(shards: list[Shard], rounds: int) -> list[np.ndarray]:
    """For each shard, in its order: whether another suffix shares the first ``rounds`` letters.

    The interleave starts as one shard behind the other. A round deals the
    suffixes anew by (first letter, place of the successor in the interleave so
    far); in each shard these pairs ascend already, so a round is a merge. Where
    neighbours first differ after k rounds, their common prefix has k - 1 letters;
    neighbours without a difference after the last round form an interval.
    """
    sizes = [len(s.places) for s in shards]
    total, ends = sum(sizes), [np.count_nonzero(s.follow < 0) for s in shards]
    before = np.append(0, np.cumsum(sizes)[:-1])
    where = [np.arange(n) + b for n, b in zip(sizes, before, strict=True)]
    block = np.zeros(total, np.int64)
    for _ in range(rounds):
        keys, n_ends = [], 0
        for shard, at, end in zip(shards, where, ends, strict=True):
            key = shard.letters * np.int64(total + 1)
            key[end:] += at[shard.follow[end:]] + 1
            key[:end] = np.arange(n_ends, n_ends + end) - sum(ends)  # terminators stay in front, each for itself
            n_ends += end
            keys.append(key)
        fresh = []
        for i, key in enumerate(keys):
            fresh.append(np.arange(len(key)) + sum(np.searchsorted(other, key) for j, other in enumerate(keys) if j != i))
        letter, onward = np.empty(total, np.int64), np.empty(total, np.int64)
        for shard, old, new, end, key in zip(shards, where, fresh, ends, keys, strict=True):
            letter[new] = shard.letters
            onward[new[end:]] = block[old[shard.follow[end:]]]
            onward[new[:end]] = key[:end]
        differs = np.append(False, (letter[1:] != letter[:-1]) | (onward[1:] != onward[:-1]))
        where, block = fresh, np.cumsum(differs)
    alone = np.bincount(block, minlength=1)[block] < 2
    return [~alone[at] for at in where]


def repeated_starts(runs: list[bytes], length: int, letter: int, hashes: PolynomialHash, n_shards: int = 2) -> list[np.ndarray]:
    """For each run, the places in it whose ``length`` bytes also start elsewhere in these runs."""
    letters = Letters([x + b"\0" for x in runs], letter, hashes)
    shards = [Shard(letters, np.flatnonzero(letters.run % n_shards == i)) for i in range(min(n_shards, len(runs)))]
    found = np.zeros(len(letters.codes), bool)
    for shard, repeated in zip(shards, repeated_intervals(shards, length // letter), strict=True):
        found[shard.places] = repeated
    # Suffixes with fewer letters end in a terminator, which no other has: they are never marked.
    rows, offsets = letters.run[found], letters.offset[found]
    cuts = np.searchsorted(rows, np.arange(1, len(runs)))
    return np.split(offsets, cuts)


def spans_of(starts: np.ndarray) -> list[int]:
    """Ascending places as (first, count) pairs of neighbours."""
    if not len(starts):
        return []
    first = np.flatnonzero(np.append(True, np.diff(starts) > 1))
    return np.stack([starts[first], np.diff(np.append(first, len(starts)))], 1).ravel().tolist()


def merge_runs(length: int, letter: int):
    """Task over runs sorted by key: for those that have no equal, which starts are repeated."""
    schema = pa.schema([("doc_id", pa.int64()), ("tag", pa.int64()), ("first", pa.int64()), ("starts", pa.int32())])

    def judged(hashes: PolynomialHash, rows: list[tuple]) -> pa.RecordBatch:
        out = []
        found = repeated_starts([row[-1] for row in rows], length, letter, hashes)
        for (_, doc_id, tag, first, copies, _), starts in zip(rows, found, strict=True):
            if copies < 2:
                spans = spans_of(starts)
                out += [(doc_id, tag, first + a, n) for a, n in zip(spans[::2], spans[1::2], strict=True)]
        columns = zip(*out, strict=True) if out else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held, size = PolynomialHash(_BASES[1], 3), [], 0
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                if size >= MERGE_BYTES and held[-1][0] != row[0]:
                    yield judged(hashes, held)
                    held, size = [], 0
                held.append(row)
                size += len(row[-1])
        if held:
            yield judged(hashes, held)

    return task


def hash_starts(length: int):
    """Task: runs to 128-bit hashes of the string at each start."""
    names = ["high", "low", "doc_id", "tag", "first", "copies"]
    schema = pa.schema(list(zip(names, [pa.int64()] * 6, strict=True)))

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = [PolynomialHash(_BASES[0], 4), PolynomialHash(_BASES[1], 5)]
        for batch in batches:
            for doc_id, tag, first, copies, data in zip(*(batch.column(i).to_pylist() for i in range(1, 6)), strict=True):
                both = [h.all_of(h.prefixes(np.frombuffer(data, np.uint8)), length).view(np.int64) for h in hashes]
                n = len(both[0])
                columns = [*both, [doc_id] * n, [tag] * n, first + np.arange(n), [copies] * n]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return task


def slice_runs(length: int):
    """Task: texts with places of runs to the bytes of the runs."""
    names = ["key", "doc_id", "tag", "first", "copies", "data"]
    schema = pa.schema(list(zip(names, [pa.int64()] * 5 + [pa.binary()], strict=True)))

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, tag, text, runs in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                data = text.encode()
                for run in runs:
                    end = run["first"] + run["starts"] + length - 1
                    rows.append((run["key"], doc_id, tag, run["first"], run["copies"], data[run["first"] : end]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return task


def _texts_by_key(docs: DataFrame, id_col: str, text_col: str, carry: list[str]) -> DataFrame:
    carried = [F.struct(*carry).alias("carried")] if carry else []
    rows = texts(docs, *carried, id_col=id_col, text_col=text_col)
    return rows.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "text", F.xxhash64("text").alias("tag"), *rows.columns[2:])


def repeated_spans(rows: DataFrame, length: int = LENGTH, gram: int = GRAM, letter: int = LETTER) -> DataFrame:
    """``doc_id, tag, first, starts``: places where repeated strings start; ``rows`` has each ``doc_id, tag, text`` once."""
    ddl = "key long, content long, doc_id long, tag long, first long, starts int, weight int"
    runs = stored(rows.select("doc_id", "text", "tag").mapInArrow(lean(scan_runs(length, gram)), ddl), "runs")
    shared = runs.groupBy("key").agg(F.sum("weight").alias("weight")).where("weight > 1").select("key")
    candidates = stored(runs.drop("weight").join(shared, "key", "left_semi"), "candidates")
    place = F.struct("doc_id", "tag", "first", "starts")
    kinds = candidates.groupBy("key", "content").agg(F.count(F.lit(1)).alias("copies"), F.min(place).alias("run"))
    kinds = stored(kinds, "kinds")
    settled = candidates.join(kinds.where("copies > 1").select("key", "content"), ["key", "content"], "left_semi")
    keys = kinds.groupBy("key").agg(F.min("copies").alias("least"), F.sum(F.col("run.starts") + length - 1).alias("bytes"))
    open_keys = keys.where("least < 2").select("key", (F.col("bytes") > MOST_KEY_BYTES).alias("large"))
    unsure = kinds.join(open_keys, "key").select("key", "copies", "large", "run.*")
    by_doc = unsure.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("key", "first", "starts", "copies", "large")).alias("runs"))
    placed = rows.join(by_doc, ["doc_id", "tag"])

    def sliced(large: bool) -> DataFrame:
        own = F.filter("runs", lambda r: r["large"] == large)
        found = placed.withColumn("runs", own).where(F.size("runs") > 0).select("doc_id", "tag", "text", "runs")
        return found.mapInArrow(lean(slice_runs(length)), "key long, doc_id long, tag long, first long, copies long, data binary")

    dealt = sliced(False).repartition(width(rows), "key").sortWithinPartitions("key", "doc_id", "tag", "first")
    merged = dealt.mapInArrow(lean(merge_runs(length, letter)), "doc_id long, tag long, first long, starts int")
    found = settled.select("doc_id", "tag", "first", "starts").unionByName(merged)
    if open_keys.where("large").isEmpty():
        return found
    hashed = stored(sliced(True).mapInArrow(lean(hash_starts(length)), "high long, low long, doc_id long, tag long, first long, copies long"), "starts")
    twice = hashed.groupBy("high", "low").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("high", "low")
    rest = hashed.where("copies < 2").join(twice, ["high", "low"], "left_semi")
    return found.unionByName(rest.select("doc_id", "tag", "first", F.lit(1).alias("starts")))


def cut_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    gram: int = GRAM,
    letter: int = LETTER,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: list[str] | None = None,
    whole_characters: bool = False,
) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept`` (the remaining bytes).

    The columns named in ``carry`` come along as the struct ``carried``. With
    ``whole_characters`` a character that is cut in two goes as a whole, so that
    what remains is text.
    """
    if length % letter or gram >= length:
        raise ValueError("length has to be a multiple of letter, and longer than gram")
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])
    rows = _texts_by_key(docs, id_col, text_col, carry or [])
    carried = ["carried"] if carry else []
    once, many, _ = once_each(rows)
    everywhere = many.select("doc_id", "tag", F.lit(0).cast("long").alias("first"), F.lit(_ALL).alias("starts"))
    spans = repeated_spans(once, length, gram, letter).unionByName(everywhere)
    by_doc = spans.groupBy("doc_id", "tag").agg(F.collect_list("first").alias("first"), F.collect_list("starts").alias("starts"))

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            first, starts = batch.column(2), batch.column(3)
            for row, text in enumerate(batch.column(1).cast(pa.binary()).to_pylist()):
                if not first[row].is_valid:
                    out.append((len(text), 0, 0, text))
                    continue
                begin, count = (np.array(x[row].values.to_numpy(), np.int64) for x in (first, starts))
                count = np.where(count == _ALL, max(len(text) - length + 1, 0), count)
                begin, count = begin[count > 0], count[count > 0]
                change = np.zeros(len(text) + 1, np.int64)
                np.add.at(change, begin, 1)
                np.add.at(change, begin + count + length - 1, -1)
                removed = np.cumsum(change[:-1]) > 0
                if whole_characters:
                    character = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
                    removed = (np.bincount(character, removed) > 0)[character]
                n_spans = np.count_nonzero(np.diff(removed.astype(np.int8), prepend=0) == 1)
                kept = np.frombuffer(text, np.uint8)[~removed].tobytes()
                out.append((len(text), int(removed.sum()), int(n_spans), kept))
            columns = [batch.column(0), *(pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), list(schema)[1:], strict=True))]
            yield pa.RecordBatch.from_arrays([*columns, *batch.columns[4:]], names=[*schema.names, *carried])

    marked = rows.join(by_doc, ["doc_id", "tag"], "left").select("doc_id", "text", "first", "starts", *carried)
    ddl = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    cut = marked.mapInArrow(lean(task), ddl + "".join(f", carried {marked.schema[c].dataType.simpleString()}" for c in carried))
    return cut.withColumn("doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")))
