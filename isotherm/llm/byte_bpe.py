"""Byte-level BPE: texts to token ids by a rank file, and back.

Merging takes the lowest rank first, of equal ranks the leftmost pair. Each rank
has a bucket of places in a linked list of parts; a bitmap in two levels tells
the lowest rank whose bucket has entries. A place whose pair has changed since
is skipped. A merge costs a constant number of steps, so a pre-token of a
million bytes takes no longer per byte than a short one.

Defined cases: null texts are empty and give no ids; ids decode to the bytes of
the text. The rank file must hold all 256 single bytes.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from isotherm.llm.frames import in_batches, per_process, texts

#: Entries that a worker keeps; beyond, it starts anew. Bounds memory only.
MOST_CHUNKS, MOST_TOKENS, LONGEST_KEPT = 1_000_000, 1_000_000, 64


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class RankQueue:
    """Places by rank: a bucket for each rank, and a bitmap of the filled ones in two levels.

    ``leaves`` has a bit per rank, 256 to a word; the top level, held by ``merge``
    itself, has a bit per word. All is empty between two pre-tokens.
    """

    def __init__(self, ranks: int):
        self.leaves = [0] * ((ranks >> 8) + 1)
        self.buckets: list[list[int]] = [[] for _ in range(ranks)]


_BIT = [1 << i for i in range(256)]


def merge(piece: bytes, ranks: dict[bytes, int], queue: RankQueue) -> list[int]:
    """Ids of one pre-token. The queue's steps stand in the loop, as a call for each would double the time."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n, get, leaves, buckets, bit, top = len(piece), ranks.get, queue.leaves, queue.buckets, _BIT, 0
    after, before, pair = list(range(1, n + 1)), list(range(-1, n - 1)), [-1] * n
    for i in range(n - 1):
        rank = get(piece[i : i + 2])
        if rank is not None:
            pair[i] = rank
            bucket = buckets[rank]
            if not bucket:
                leaf = rank >> 8
                leaves[leaf] |= bit[rank & 255]
                top |= 1 << leaf
            bucket.append(i)  # ascending, so the bucket is a heap
    while top:
        # Find first set in both levels, and the leftmost place of that rank.
        leaf = (top & -top).bit_length() - 1
        bits = leaves[leaf]
        rank = leaf << 8 | (bits & -bits).bit_length() - 1
        bucket = buckets[rank]
        i = heappop(bucket)
        if not bucket:
            bits &= bits - 1
            leaves[leaf] = bits
            if not bits:
                top &= top - 1
        if pair[i] != rank:
            continue  # stale: the pair at this place is another by now
        gone = after[i]
        end = after[gone]
        after[i] = end
        pair[gone] = pair[i] = -1
        if end < n:
            before[end] = i
            rank = get(piece[i : after[end]])
            if rank is not None:
                pair[i] = rank
                bucket = buckets[rank]
                if not bucket:
                    leaf = rank >> 8
                    leaves[leaf] |= bit[rank & 255]
                    top |= 1 << leaf
                heappush(bucket, i)
        left = before[i]
        if left >= 0:
            rank = get(piece[left:end])
            if rank is None:
                pair[left] = -1
            else:
                pair[left] = rank
                bucket = buckets[rank]
                if not bucket:
                    leaf = rank >> 8
                    leaves[leaf] |= bit[rank & 255]
                    top |= 1 << leaf
                heappush(bucket, left)
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : after[i]]])
        i = after[i]
    return ids


class _Unsafe(Exception):
    """The chunk can't be cut from its neighbours before the pattern is applied."""


class _Chunks(dict):
    """Chunk of text between spaces to its ids as bytes; filled on demand."""

    def __init__(self, lead: str, encode):
        self.lead, self.encode = lead, encode

    def __missing__(self, chunk: str) -> bytes:
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            raise _Unsafe
        ids = self.encode(self.lead + chunk)
        if len(chunk) <= LONGEST_KEPT:
            if len(self) >= MOST_CHUNKS:
                self.clear()
            self[chunk] = ids
        return ids


class ByteBpe:
    """Encoder and decoder for one rank file and one pre-token pattern."""

    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        self.words = {rank: token for token, rank in self.ranks.items()}
        self.find = regex.compile(pattern).findall
        self.queue = RankQueue(max(self.ranks.values()) + 1)
        self.tokens: dict[str, bytes] = {}
        self.first, self.spaced = _Chunks("", self.by_pattern), _Chunks(" ", self.by_pattern)

    def token(self, token: str) -> bytes:
        ids = self.tokens.get(token)
        if ids is None:
            ids = np.array(merge(token.encode(), self.ranks, self.queue), "<u4").tobytes()
            if len(token) <= LONGEST_KEPT:
                if len(self.tokens) >= MOST_TOKENS:
                    self.tokens.clear()
                self.tokens[token] = ids
        return ids

    def by_pattern(self, text: str) -> bytes:
        return b"".join(map(self.token, self.find(text)))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers.

        A single space or line end between two other characters always begins a
        pre-token, so the text is cut there and equal chunks are encoded once.
        Texts with other white space at such a cut go through the pattern whole.
        """
        out, spaced = [], self.spaced.__getitem__
        line_end = self.token("\n")
        try:
            for line in text.split("\n"):
                chunks = line.split(" ")
                out.append(self.first[chunks[0]])
                out.extend(map(spaced, chunks[1:]))
                out.append(line_end)
        except _Unsafe:
            return self.by_pattern(text)
        out.pop()
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.words.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def codec(path: str, pattern: str) -> ByteBpe:
    """One per worker process, which keeps its cache from task to task."""
    return per_process(("byte_bpe", path, pattern), lambda: ByteBpe(path, pattern))


def encode_texts(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids``: the ids of each whole text as an array of int."""

    def step(batch: pa.RecordBatch) -> list[pa.Array]:
        bpe = codec(path, pattern)
        parts = [np.frombuffer(bpe.encode(text), "<u4").astype(np.int32) for text in batch.column(1).to_pylist()]
        ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
        return [batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts)))]

    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
    rows = texts(docs, id_col=id_col, text_col=text_col)
    return rows.mapInArrow(lambda batches: in_batches(batches, step, schema), "doc_id long, ids array<int>")


def decode_ids(rows: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, data``: the bytes that the ids of ``doc_id, ids`` rows stand for (null: none)."""

    def step(batch: pa.RecordBatch) -> list[pa.Array]:
        bpe = codec(path, pattern)
        data = [bpe.decode(np.array(ids or [], "<u4").tobytes()) for ids in batch.column(1).to_pylist()]
        return [batch.column(0), pa.array(data, pa.binary())]

    schema = pa.schema([("doc_id", pa.int64()), ("data", pa.binary())])
    return rows.select("doc_id", "ids").mapInArrow(lambda batches: in_batches(batches, step, schema), "doc_id long, data binary")


def token_digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: encoded and decoded in one pass."""

    def step(batch: pa.RecordBatch) -> list[pa.Array]:
        bpe = codec(path, pattern)
        counts, ids_hex, text_hex = [], [], []
        for text in batch.column(1).to_pylist():
            ids = bpe.encode(text)
            counts.append(len(ids) // 4)
            ids_hex.append(hashlib.sha256(ids).hexdigest())
            text_hex.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
        return [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_hex), pa.array(text_hex)]

    names = ["n_tokens", "ids_sha256", "decoded_sha256"]
    schema = pa.schema([("doc_id", pa.int64()), *zip(names, [pa.int64(), pa.string(), pa.string()], strict=True)])

    def task(batches: Iterable[pa.RecordBatch]):
        return in_batches(batches, step, schema)

    rows = texts(docs, id_col=id_col, text_col=text_col)
    return rows.mapInArrow(task, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
