"""JSON files of any size as readings, their records found by many tasks.

A chunk of bytes does not show whether it begins inside a string, behind a
backslash, or how deep. So each chunk is summed up as a function of the state at
its start: for each of the four (in string, escaped) the state at its end, how the
depth changes, and how low it gets. The functions of a file, a few numbers for
each chunk, are composed in order; then each chunk knows its state and finds the
records that begin in it, on its own. The last one is read to its end.

What counts is what the whole file would give: the elements of a root array, or of
the array ``records`` of a root object (the last one, if there are several), else
the root as the one record. Text behind the root is ignored. A file is malformed if
any record is, or what is around the records. A record, and what is around them,
has to fit a VARIANT of 128 MiB.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isotherm.operators.json_records import MALFORMED, MOST_VALUE_BYTES, TOO_LARGE, json_parser
from isotherm.operators.observations import parse_files
from isotherm.session import cut_lineage, for_parsers
from isotherm.sources.splits import SPLIT_BYTES, Read, dealt, in_batches, list_files, per_file, ranges, reader

# Executors get the functions by value; they need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# --- fixed values ---------------------------------------------------------
SPACE = b" \t\r\n"
BOM = b"\xef\xbb\xbf"
RECORDS = b'"records"'
# --------------------------------------------------------------------------

_SUMMARY = "file_id string, size long, start long, stop long, valid boolean, first_at long, first_byte int, ends array<int>, delta array<long>, low array<long>"
_STATES = "file_id string, size long, start long, stop long, valid boolean, in_string int, escaped int, depth long, root long, kind int"
_RECORDS = "file_id string, at long, record binary, failure string"


# --- a chunk ------------------------------------------------------------------


def _quotes(data: np.ndarray, escaped: int) -> tuple[np.ndarray, int]:
    """Places of the quotes that open or close a string, and whether a backslash is left over at the end."""
    slashes = np.flatnonzero(data == 92)
    first = np.flatnonzero(np.append(True, np.diff(slashes) > 1)) if len(slashes) else slashes
    ends = slashes[np.append(first[1:], len(slashes)) - 1] if len(slashes) else slashes
    odd = np.diff(np.append(first, len(slashes))) % 2
    if len(slashes) and slashes[0] == 0:
        odd[0] ^= escaped
    quotes = np.flatnonzero(data == 34)
    run = np.searchsorted(ends, quotes - 1)
    behind = np.zeros(len(quotes), bool)
    inside = run < len(ends)
    behind[inside] = (ends[run[inside]] == quotes[inside] - 1) & (odd[run[inside]] == 1)
    if len(quotes) and quotes[0] == 0:
        behind[0] = bool(escaped)
    left_over = int(odd[-1]) if len(ends) and ends[-1] == len(data) - 1 else 0
    return quotes[~behind], left_over if len(data) else escaped


class Marks:
    """Brackets and commas outside strings, with the depth behind each."""

    def __init__(self, data: np.ndarray, in_string: int, escaped: int, depth: int):
        quotes, self.escaped = _quotes(data, escaped)
        kinds = np.zeros(256, np.int8)
        kinds[[91, 123]], kinds[[93, 125]], kinds[44] = 1, -1, 2
        kind = kinds[data]
        at = np.flatnonzero(kind)
        at = at[(np.searchsorted(quotes, at) + in_string) % 2 == 0]
        step = np.where(kind[at] == 2, 0, kind[at])
        self.at, self.step, self.depth = at, step.astype(np.int64), depth + np.cumsum(step, dtype=np.int64)
        self.byte, self.quotes = data[at], quotes
        self.in_string = (in_string + len(quotes)) % 2
        self.end_depth = int(self.depth[-1]) if len(at) else depth


def _valid(read: Read, start: int, stop: int, size: int) -> bool:
    """Whether the characters that begin in the range, and the one it begins in, are UTF-8."""
    base = max(start - 3, 0)
    data = read(base, min(stop + 3, size))
    begin, end = start - base, stop - base
    for _ in range(3):
        begin -= begin > 0 and data[begin] & 0xC0 == 0x80
    while end < len(data) and data[end] & 0xC0 == 0x80:
        end += 1
    try:
        data[begin:end].decode()
    except UnicodeDecodeError:
        return False
    return True


def _summaries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            read = reader(row["file_id"])
            data = np.frombuffer(read(row["start"], row["stop"]), np.uint8)
            shown = data[3:] if row["start"] == 0 and data[:3].tobytes() == BOM else data
            plain = np.flatnonzero(~np.isin(shown, list(SPACE)))[:1]
            first = int(plain[0]) + len(data) - len(shown) if len(plain) else None
            ends, delta, low = [], [], []
            for state in range(4):
                marks = Marks(data, state & 1, state >> 1, 0)
                ends.append(marks.in_string | marks.escaped << 1)
                delta.append(marks.end_depth)
                low.append(int(min(marks.depth[marks.step < 0], default=1 << 40)))
            found = (None, None) if first is None else (row["start"] + first, int(data[first]))
            valid = _valid(read, row["start"], row["stop"], row["size"])
            out.append({**row, "valid": valid, "first_at": found[0], "first_byte": found[1], "ends": ends, "delta": delta, "low": low})
        yield pa.RecordBatch.from_pylist(out, schema=_schema(_SUMMARY))


def _schema(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}
    kinds |= {"array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64())}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split(" ") for f in ddl.split(", "))])


def _compose(chunks: list[dict]) -> Iterator[dict]:
    """States at the starts of one file's chunks, up to the one in which the root ends."""
    out, state, depth, root, kind, valid = [], 0, 0, None, None, True
    for row in chunks:
        valid &= row["valid"]
        if kind == -1:
            continue
        if root is None and row["first_at"] is not None:
            root, kind = row["first_at"], row["first_byte"]
        if root is not None:
            keep = {c: row[c] for c in ("file_id", "size", "start", "stop")}
            out.append({**keep, "in_string": state & 1, "escaped": state >> 1, "depth": depth, "root": root, "kind": kind})
            if kind not in (91, 123) or depth + row["low"][state] <= 0:
                kind = -1
        state, depth = row["ends"][state], depth + row["delta"][state]
    if not out:
        out = [{"file_id": chunks[0]["file_id"], "size": chunks[0]["size"], "start": 0, "stop": 0, "root": None, "kind": 0}]
    return ({**row, "valid": valid} for row in out)


# --- records ------------------------------------------------------------------


def _closing(read: Read, at: int, size: int, marks: Marks, level: int, step: int = 1 << 16) -> tuple[int, int] | None:
    """Place and byte of the next comma at ``level`` or of the bracket that leaves it, from ``at`` on, where ``marks`` end."""
    in_string, escaped, depth = marks.in_string, marks.escaped, marks.end_depth
    while at < size:
        data = np.frombuffer(read(at, min(at + step, size)), np.uint8)
        more = Marks(data, in_string, escaped, depth)
        hit = np.flatnonzero(((more.byte == 44) & (more.depth == level)) | ((more.step < 0) & (more.depth == level - 1)))
        if len(hit):
            return at + int(more.at[hit[0]]), int(more.byte[hit[0]])
        in_string, escaped, depth = more.in_string, more.escaped, more.end_depth
        at, step = at + len(data), min(2 * step, SPLIT_BYTES)
    return None


def elements(read: Read, row: dict, level: int, opening: int, closing: int | None) -> Iterator[tuple[int, bytes | None, str | None]]:
    """Elements, of the array whose bracket stands at ``opening``, that begin in a chunk: offset, bytes, failure."""
    start, size = row["start"], row["size"]
    data = np.frombuffer(read(start, row["stop"]), np.uint8)
    marks = Marks(data, row["in_string"], row["escaped"], row["depth"])
    at = marks.at + start
    inside = (at >= opening) & (at <= (size if closing is None else closing))
    opens = inside & (at == opening)
    begins = opens | (inside & (marks.byte == 44) & (marks.depth == level))
    ends = inside & (marks.step < 0) & (marks.depth == level - 1)
    places = np.flatnonzero(begins | ends)
    if closing is None and ends[places].any():  # the root array ends here, whatever follows
        places = places[: int(np.argmax(ends[places])) + 1]
    for n, i in enumerate(places.tolist()):
        if ends[i]:
            continue
        first = int(at[i]) + 1
        if n + 1 < len(places):
            j = places[n + 1]
            last, byte = int(at[j]), int(marks.byte[j])
        else:
            last, byte = _closing(read, row["stop"], size, marks, level) or (None, None)
        if last is None or byte == 125:
            yield -1, None, MALFORMED
        elif last - first > MOST_VALUE_BYTES:
            yield first, None, TOO_LARGE
        else:
            text = data[first - start : last - start].tobytes() if last <= row["stop"] else read(first, last)
            if text.strip(SPACE):
                yield first, text, None
            elif not (opens[i] and byte == 93):  # nothing beside a comma
                yield -1, None, MALFORMED


def _keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task over chunks of root objects: where arrays ``records`` open, where depth falls back to 1, and where the root ends."""
    return in_batches(_key_rows(batches), _schema(_EVENTS))


def _key_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for row in batch.to_pylist():
            read, start = reader(row["file_id"]), row["start"]
            data = np.frombuffer(read(start, row["stop"]), np.uint8)
            marks = Marks(data, row["in_string"], row["escaped"], row["depth"])
            at = marks.at + start
            falls, ends = at[(marks.step < 0) & (marks.depth == 1)], at[(marks.step < 0) & (marks.depth == 0)]
            end = int(ends[0]) if len(ends) else None
            events = []
            text = data.tobytes() + read(row["stop"], min(row["stop"] + len(RECORDS), row["size"]))
            found = text.find(RECORDS)
            while 0 <= found < len(data):
                nth = int(np.searchsorted(marks.quotes, found))
                real = nth < len(marks.quotes) and marks.quotes[nth] == found and (nth + row["in_string"]) % 2 == 0
                before = int(np.searchsorted(marks.at, found)) - 1
                depth = int(marks.depth[before]) if before >= 0 else row["depth"]
                if real and depth == 1:
                    colon = _after_space(read, start + found + len(RECORDS), row["size"])
                    if colon[1] == b":":
                        value = _after_space(read, colon[0] + 1, row["size"])
                        later = falls[falls > value[0]]
                        closed = int(later[0]) if len(later) and value[0] < row["stop"] else None
                        events.append((value[0], value[1] == b"[", closed))
                found = text.find(RECORDS, found + 1)
            least = int(falls[0]) if len(falls) else None
            yield from ((row["file_id"], start, row["root"], at_, is_array, closed, None, None) for at_, is_array, closed in events)
            yield row["file_id"], start, row["root"], None, None, None, least, end


_ARRAYS = "file_id string, opening long, closing long, end long"
_EVENTS = "file_id string, start long, root long, opening long, is_array boolean, closed long, fall long, end long"


def _after_space(read: Read, at: int, size: int) -> tuple[int, bytes]:
    while at < size:
        data = read(at, min(at + 256, size))
        rest = data.lstrip(SPACE)
        if rest:
            return at + len(data) - len(rest), rest[:1]
        at += len(data)
    return size, b""


def _arrays(rows: list[dict]) -> Iterator[dict]:
    """``file_id, opening, closing, end`` of one file: the array ``records`` that counts, if there is one."""
    end = next((r["end"] for r in rows if r["end"] is not None), None)
    named = [r for r in rows if r["opening"] is not None and (end is None or r["opening"] < end)]
    last = max(named, key=lambda r: r["opening"], default=None)
    opening = closing = None
    if last and last["is_array"]:
        opening = last["opening"]
        closing = last["closed"] or next((r["fall"] for r in rows if r["fall"] is not None and r["fall"] > opening), None)
    yield {"file_id": rows[0]["file_id"], "opening": opening, "closing": closing, "end": end}


def _found(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task over chunks with what is known of their files: records, failures, and frames around ``records``."""
    return in_batches(_found_rows(batches), _schema(_RECORDS))


def _found_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for row in batch.to_pylist():
            read, here, out = reader(row["file_id"]), row["root"] is not None and row["start"] <= row["root"] < row["stop"], []
            if not row["valid"] or row["root"] is None:
                out = [(-1, None, MALFORMED)] if here or row["root"] is None else []
            elif row["kind"] == 91:
                out = elements(read, row, 1, row["root"], None)
            elif row["kind"] != 123:
                out = [(row["root"], read(row["root"], row["stop"]), None)]
            elif row["end"] is None or (row["opening"] is not None and row["closing"] is None):
                out = [(-1, None, MALFORMED)] if here else []
            elif row["opening"] is None:
                whole = row["end"] + 1 - row["root"]
                if here:
                    out = [(row["root"], read(row["root"], row["end"] + 1), None) if whole <= MOST_VALUE_BYTES else (-1, None, TOO_LARGE)]
            else:
                out = list(elements(read, row, 2, row["opening"], row["closing"])) if row["stop"] > row["opening"] and row["start"] <= row["closing"] else []
                if here and (row["opening"] - row["root"]) + (row["end"] - row["closing"]) > MOST_VALUE_BYTES:
                    out = [(-1, None, TOO_LARGE)]
                elif here:
                    out.append((-2, read(row["root"], row["opening"] + 1) + read(row["closing"], row["end"] + 1), None))
            yield from ((row["file_id"], *x) for x in out)


def scan_json(spark: SparkSession, path: str | list[str], split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """JSON files of any size as readings: ``file_id, at, date, city, temperature, error``; at least one row per file that is not empty.

    ``at`` is a record's byte offset, -1 for what fails the file as a whole.
    ``split_file_rows`` and ``split_file_outcomes`` take it from there.
    """
    for_parsers(spark)
    chunks = ranges(list_files(spark, path), split_bytes=split_bytes)
    summaries = chunks.select("file_id", "size", "start", "stop").mapInArrow(_summaries, _SUMMARY)
    states = cut_lineage(per_file(summaries, _compose, _STATES, _schema(_STATES)))
    events = dealt(states.where("kind = 123"), split_bytes).mapInArrow(_keys, _EVENTS)
    arrays = per_file(events, _arrays, _ARRAYS, _schema(_ARRAYS))
    known = dealt(states.join(cut_lineage(arrays), "file_id", "left"), split_bytes)
    records = known.mapInArrow(_found, _RECORDS)
    frame = F.expr(f"CASE WHEN at = -2 AND try_parse_json(CAST(record AS STRING)) IS NULL THEN '{MALFORMED}' ELSE failure END")
    records = records.withColumn("failure", frame)

    # Each record as a file of its own, an array of one.
    whole = records.where("record IS NOT NULL AND failure IS NULL AND at >= 0")
    text = F.concat(F.lit("["), F.col("record").cast("string"), F.lit("]"))
    pieces = whole.select(F.struct("file_id", "at").alias("file_id"), text.alias("text"), F.lit("JSON").alias("format"))
    read = parse_files(pieces, [json_parser()])
    at = F.when(F.col("error").isin(MALFORMED, TOO_LARGE), F.lit(-1)).otherwise(F.col("file_id.at"))
    read = read.select(F.col("file_id.file_id").alias("file_id"), at.alias("at"), "date", "city", "temperature", "error")
    none = F.lit(None).cast("string")
    bare = [F.lit(-1).cast("long").alias("at"), none.alias("date"), none.alias("city"), none.cast("int").alias("temperature")]
    failed = records.where("failure IS NOT NULL").select("file_id", *bare, F.col("failure").alias("error"))
    return read.unionByName(failed).unionByName(states.select("file_id").distinct().select("file_id", *bare, none.alias("error")))
