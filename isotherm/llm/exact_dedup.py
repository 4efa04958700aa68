"""Exact deduplication through counting quotient filters.

Every task packs the 64-bit fingerprints of its texts into counting quotient
filters, one per range of fingerprints. The filters of a range meet in one
task, where their sorted remainders are merged and counts of equal ones added;
nothing is lost, as quotient and remainder together are the fingerprint.
Fingerprints counted more than once send their texts on to byte comparison.

Defined cases: null texts count as empty and are copies of each other; a null
id ranks below all others; rows that repeat both id and text share one decision;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.llm.frames import stored, texts, width

#: Fingerprints that a task gathers before it packs them; bounds its memory.
FILTER_ROWS = 1 << 20
FILTER_SCHEMA = "bucket int, filter binary"


class CountingQuotientFilter:
    """Static table of (fingerprint, count): quotients are places, remainders are stored.

    A run holds the remainders of one quotient in order; ``occupied`` marks the
    quotients that have a run, ``run_end`` the last slot of each. A remainder
    counted more than once is followed by a slot with its count, marked in
    ``counter``.
    """

    def __init__(self, quotient_bits: int, fingerprint_bits: int, occupied, run_end, counter, slots):
        self.quotient_bits, self.fingerprint_bits = quotient_bits, fingerprint_bits
        self.occupied, self.run_end, self.counter, self.slots = occupied, run_end, counter, slots

    @classmethod
    def build(cls, fingerprints: np.ndarray, counts: np.ndarray, bits: int) -> CountingQuotientFilter:
        """From ascending distinct fingerprints of so many bits."""
        used = 1 + (counts > 1)
        quotient_bits = min(bits - 1, max(1, int(np.ceil(np.log2(max(2, used.sum() / 0.9))))))
        rest = np.uint64(bits - quotient_bits)
        quotients = (fingerprints >> rest).astype(np.int64)
        remainders = fingerprints & ((np.uint64(1) << rest) - np.uint64(1))
        slot_quotients = np.repeat(quotients, used)
        is_counter = np.zeros(len(slot_quotients), bool)
        is_counter[(np.cumsum(used) - 1)[counts > 1]] = True
        values = np.repeat(remainders, used)
        values[is_counter] = counts[counts > 1]
        # A run starts at its quotient, or behind the run before if that is longer.
        order = np.arange(len(values))
        places = np.maximum.accumulate(slot_quotients - order) + order
        size = int(places[-1]) + 1 if len(places) else 0
        slots, run_end, counter = np.zeros(size, np.uint64), np.zeros(size, bool), np.zeros(size, bool)
        slots[places], counter[places] = values, is_counter
        run_end[places[np.append(slot_quotients[1:] != slot_quotients[:-1], True)] if len(places) else places] = True
        occupied = np.zeros(1 << quotient_bits, bool)
        occupied[quotients] = True
        return cls(quotient_bits, bits, occupied, run_end, counter, slots)

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        """The fingerprints in order, and their counts."""
        quotients, ends = np.flatnonzero(self.occupied), np.flatnonzero(self.run_end)
        starts = np.maximum(quotients, np.append(-1, ends[:-1]) + 1)[: len(ends)]
        lengths = ends - starts + 1
        places = np.repeat(starts - np.append(0, np.cumsum(lengths)[:-1]), lengths) + np.arange(lengths.sum())
        owner = np.repeat(quotients, lengths).astype(np.uint64)
        counter = self.counter[places]
        fingerprints = (owner << np.uint64(self.fingerprint_bits - self.quotient_bits)) | self.slots[places]
        counts = np.ones(len(places), np.int64)
        counts[np.flatnonzero(counter) - 1] = self.slots[places][counter].astype(np.int64)
        return fingerprints[~counter], counts[~counter]

    def to_bytes(self) -> bytes:
        head = np.array([self.quotient_bits, self.fingerprint_bits, len(self.slots)], np.int64)
        wide = max(1, (self.fingerprint_bits - self.quotient_bits + 7) // 8, (int(self.slots.max(initial=0)).bit_length() + 7) // 8)
        slots = self.slots.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :wide]
        flags = [np.packbits(x).tobytes() for x in (self.occupied, self.run_end, self.counter)]
        return b"".join([head.tobytes(), bytes([wide]), *flags, slots.tobytes()])

    @classmethod
    def from_bytes(cls, data: bytes) -> CountingQuotientFilter:
        quotient_bits, bits, size = (int(x) for x in np.frombuffer(data, np.int64, 3))
        wide, at, flags = data[24], 25, []
        for count in (1 << quotient_bits, size, size):
            long = (count + 7) // 8
            flags.append(np.unpackbits(np.frombuffer(data, np.uint8, long, at), count=count).astype(bool))
            at += long
        slots = np.zeros((size, 8), np.uint8)
        slots[:, :wide] = np.frombuffer(data, np.uint8, size * wide, at).reshape(size, wide)
        return cls(quotient_bits, bits, *flags, slots.view("<u8").ravel())


def merge_entries(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted entries of several filters as one: counts of equal fingerprints add up."""
    fingerprints, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(fingerprints, kind="stable")  # a merge, as the parts are sorted
    fingerprints, counts = fingerprints[order], counts[order]
    first = np.flatnonzero(np.append(True, fingerprints[1:] != fingerprints[:-1])) if len(fingerprints) else []
    return fingerprints[first], np.add.reduceat(counts, first) if len(fingerprints) else counts


def pack_filters(range_bits: int):
    """Task: fingerprints to filters, one per range of the top bits."""
    schema = pa.schema([("bucket", pa.int32()), ("filter", pa.binary())])
    rest = np.uint64(64 - range_bits)

    def packed(seen: list[np.ndarray]) -> pa.RecordBatch:
        fingerprints, counts = np.unique(np.concatenate(seen), return_counts=True)
        buckets = (fingerprints >> rest).astype(np.int32)
        ids, starts = np.unique(buckets, return_index=True)
        low = fingerprints & ((np.uint64(1) << rest) - np.uint64(1))
        ends = np.append(starts[1:], len(low))
        filters = [
            CountingQuotientFilter.build(low[a:b], counts[a:b], int(rest)).to_bytes() for a, b in zip(starts, ends, strict=True)
        ]
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(filters, pa.binary())], schema=schema)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows = [], 0
        for batch in batches:
            seen.append(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
            rows += batch.num_rows
            if rows >= FILTER_ROWS:
                yield packed(seen)
                seen, rows = [], 0
        if rows:
            yield packed(seen)

    return task


def merge_filters(range_bits: int):
    """Task: the filters of each range merged; gives the fingerprints counted more than once."""
    schema = pa.schema([("fingerprint", pa.int64()), ("n", pa.int64())])

    def repeated(bucket: int, filters: list[bytes]) -> pa.RecordBatch:
        low, counts = merge_entries([CountingQuotientFilter.from_bytes(x).entries() for x in filters])
        whole = (np.uint64(bucket) << np.uint64(64 - range_bits)) | low[counts > 1]
        return pa.RecordBatch.from_arrays([pa.array(whole.view(np.int64)), pa.array(counts[counts > 1])], schema=schema)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, filters = None, []
        for batch in batches:  # sorted by range
            for now, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if now != bucket and filters:
                    yield repeated(bucket, filters)
                    filters = []
                bucket = now
                filters.append(data)
        if filters:
            yield repeated(bucket, filters)

    return task


def repeated_fingerprints(fingerprints: DataFrame) -> DataFrame:
    """``(fingerprint, n)`` for the values of a long column that occur more than once."""
    ranges = max(2, 2 * width(fingerprints))
    range_bits = (ranges - 1).bit_length()
    filters = fingerprints.mapInArrow(pack_filters(range_bits), FILTER_SCHEMA)
    dealt = filters.repartition(width(fingerprints), "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(merge_filters(range_bits), "fingerprint long, n long")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of equal texts the row with the largest id stays. Copies are pre-aggregated
    by their bytes before they are shuffled, so a group may hold any share of
    the rows.
    """
    rows = texts(docs, id_col=id_col, text_col=text_col)
    repeated = stored(repeated_fingerprints(rows.select(F.xxhash64("text").alias("fingerprint"))), "fingerprints")
    suspects = rows.join(repeated.select("fingerprint"), F.xxhash64(rows["text"]) == repeated["fingerprint"], "left_semi")
    groups = (
        suspects.groupBy("text")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select(F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size")
        .where("group_size > 1")
    )
    digests = rows.select("doc_id", F.sha2("text", 256).alias("text_sha256"))
    found = digests.join(groups, "text_sha256", "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return found.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        "text_sha256",
    )
