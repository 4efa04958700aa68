"""Fetch named objects from a store, in the tasks."""

from __future__ import annotations

import sys
import time
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isotherm.functions.location import bucket_name
from isotherm.session import cut_lineage

# --- fixed values ---------------------------------------------------------
ATTEMPTS = 3
WAITS_SECONDS = (1.0, 2.0)
NOT_FOUND = "not found"
# --------------------------------------------------------------------------

#: Bytes in flight or in a batch at most, unless one object alone has more.
BATCH_BYTES = 64 << 20
READERS = 8
#: A task of its own costs as much as asking a near store for thousands of objects.
OBJECTS_PER_TASK = 4000
#: What a reader gets at a time at most, unless one object alone has more bytes.
GROUP_OBJECTS, GROUP_BYTES = 32, 1 << 20
TASK_BYTES = 64 << 20
#: Opening an object counts for as many bytes as reading these.
OPEN_BYTES = 16 << 10
#: Objects that take less are read one after the other, if there are many; the first few of a window show it.
SOON_SECONDS, FIRST_FEW, MANY = 0.002, 4, 32 * READERS

# Executors get the functions by value; they need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def retry(
    action: Callable,
    attempts: int = ATTEMPTS,
    waits: Sequence[float] = WAITS_SECONDS,
    final: tuple[type[BaseException], ...] = (),
    sleep: Callable[[float], None] = time.sleep,
):
    """Run ``action`` up to ``attempts`` times; errors in ``final`` are not retried."""
    for attempt in range(attempts):
        try:
            return action()
        except final:
            raise
        except Exception:
            if attempt == attempts - 1:
                raise
            sleep(waits[attempt])


def _read_bytes(store, root: str, name: str) -> bytes:
    """The bytes of an object below ``root``; a name that leads out of it names nothing."""
    if ".." in name.split("/"):
        raise FileNotFoundError(name)
    path = f"{root.rstrip('/')}/{name}"
    with store.open_input_stream(path) as stream:
        return stream.read()


def _stores(location: str) -> Callable:
    """``bucket`` to its store and root, each made once."""
    from pyarrow import fs

    made = {}

    def store(bucket: str):
        if bucket not in made:
            made[bucket] = fs.FileSystem.from_uri(location.format(bucket=bucket))
        return made[bucket]

    return store


def _sizes(store, root: str, names: Sequence[str]) -> list[tuple[int | None, str | None]]:
    """Size and error of each object below ``root``, in one call of the store; asked for one by one if that fails."""
    from pyarrow import fs

    def size(info) -> tuple[int | None, str | None]:
        return (None, NOT_FOUND) if info.type == fs.FileType.NotFound else (info.size or 0, None)

    def alone(name: str) -> tuple[int | None, str | None]:
        try:
            return size(retry(partial(store.get_file_info, paths[name])))
        except OSError as failure:
            return None, str(failure)

    paths = {name: f"{root.rstrip('/')}/{name}" for name in names if ".." not in name.split("/")}
    try:
        found = dict(zip(paths, map(size, store.get_file_info(list(paths.values()))), strict=True))
    except Exception:  # alone() tells refusals from other failures
        found = {name: alone(name) for name in paths}
    return [found.get(name, (None, NOT_FOUND)) for name in names]


def grouped(rows: Sequence[dict], least: int = 4 * READERS) -> Iterator[list[dict]]:
    """``rows`` in order as groups for the readers: small objects together, as a thread's turn costs more than opening a local file.

    At least ``least`` groups if there are as many rows; none has more than
    ``GROUP_OBJECTS`` or ``GROUP_BYTES`` unless one object has more bytes.
    """
    most = max(1, min(GROUP_OBJECTS, len(rows) // least))
    held, size = [], 0
    for row in rows:
        more = row.get("size") or 0
        if held and (len(held) == most or size + more > GROUP_BYTES):
            yield held
            held, size = [], 0
        held.append(row)
        size += more
    if held:
        yield held


def in_turns(pool: ThreadPoolExecutor, work: Callable[[list[dict]], list], rows: Sequence[dict]) -> Iterator[list]:
    """``work`` over ``rows`` in groups, in their order: side by side in ``pool``, or in this thread as long as an object takes less than ``SOON_SECONDS``.

    A near store answers sooner than threads hand over the interpreter to each other.
    """
    groups = list(grouped(rows))
    soon = len(rows) >= MANY
    if soon:
        groups[:1] = [group for group in (groups[0][:FIRST_FEW], groups[0][FIRST_FEW:]) if group]
    at = 0
    while soon and at < len(groups):
        began = time.perf_counter()
        done = work(groups[at])
        soon = time.perf_counter() - began < SOON_SECONDS * len(groups[at])
        at += 1
        yield done
    yield from pool.map(work, groups[at:])


def packed(sizes: Iterable[int | None], task_bytes: int) -> Iterator[int]:
    """Bins of about ``task_bytes``, numbered from 0, in the order of the objects; none holds more unless one object does."""
    number, held = 0, 0
    for size in sizes:
        cost = (size or 0) + OPEN_BYTES
        if held and held + cost > task_bytes:
            number, held = number + 1, 0
        held += cost
        yield number


def with_sizes(wanted: DataFrame, location: str, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Add ``size`` (NULL: no such object), ``read_error``, and ``bin``, the task in which to read it; opens nothing."""
    kinds = {"bucket_url": pa.string(), "object_name": pa.string(), "bucket": pa.string(), "size": pa.int64(), "read_error": pa.string(), "bin": pa.int64()}
    schema = pa.schema(list(kinds.items()))

    def look(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, rows = _stores(location), []

        def sizes(part: list[dict]) -> list[dict]:
            found = {}
            for bucket in {row["bucket"] for row in part}:
                names = [row["object_name"] for row in part if row["bucket"] == bucket]
                found.update({(bucket, name): x for name, x in zip(names, _sizes(*store(bucket), names), strict=True)})
            looked = (found[row["bucket"], row["object_name"]] for row in part)
            return [{**row, "size": n, "read_error": error} for row, (n, error) in zip(part, looked, strict=True)]

        with ThreadPoolExecutor(READERS) as pool:
            for batch in batches:
                part = batch.to_pylist()
                for bucket in {row["bucket"] for row in part}:
                    store(bucket)
                rows += [row for group in in_turns(pool, sizes, part) for row in group]
        if rows:  # names of one task, about OBJECTS_PER_TASK
            bins = packed((row["size"] for row in rows), task_bytes)
            yield pa.RecordBatch.from_pylist([{**row, "bin": n} for row, n in zip(rows, bins, strict=True)], schema=schema)

    ddl = "bucket_url string, object_name string, bucket string, size long, read_error string, bin long"
    sized = cut_lineage(wanted.mapInArrow(look, ddl).withColumn("part", F.spark_partition_id()))
    # Bins of all tasks in one count: a row per task.
    before = F.sum("bins").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = sized.groupBy("part").agg((F.max("bin") + 1).alias("bins"))
    places = parts.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    return sized.join(places, "part").withColumn("bin", F.col("bin") + F.col("before")).drop("part", "before")


def _windows(rows: Iterable[dict]) -> Iterator[list[dict]]:
    """Rows in groups whose objects have ``BATCH_BYTES`` at most, or of one object."""
    held, size = [], 0
    for row in rows:
        if held and size + (row["size"] or 0) > BATCH_BYTES:
            yield held
            held, size = [], 0
        held.append(row)
        size += row["size"] or 0
    if held:
        yield held


def fetch_objects(
    names: DataFrame, location: str = "s3://{bucket}", objects_per_task: int = OBJECTS_PER_TASK, task_bytes: int = TASK_BYTES
) -> DataFrame:
    """Open each named object once and return its bytes.

    ``location`` is the URI of a bucket's root on any file system Arrow knows.
    ``names`` has ``bucket_url, object_name``; repeats are removed. The work
    grows with the objects named, not with the size of the store. Sizes are
    listed first, so that each task reads about ``task_bytes``; it has several
    objects in flight, of ``BATCH_BYTES`` together, or a larger one alone; those of a
    store that answers at once are read in turn. An object
    that does not exist is not retried; any other error is, twice. The result
    has ``bucket_url, object_name, content, read_error``: an object that the
    store refused has no content but an error, so that it can be reported.
    Errors that are not the store's fail the job.
    """
    keys = ["bucket_url", "object_name"]
    wanted = cut_lineage(names.select(*keys).distinct())
    # The names are few bytes, the objects many: a number of tasks by the names
    # keeps adaptive execution from listing them all in one.
    least = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(least, -(-wanted.count() // objects_per_task))
    target = wanted.repartition(tasks, *keys).select(*keys, bucket_name(F.col("bucket_url")).alias("bucket"))
    sized = cut_lineage(with_sizes(target, location, task_bytes))
    bins = (sized.agg(F.max("bin").alias("last")).first()["last"] or 0) + 1
    dealt = sized.repartitionById(bins, F.col("bin").cast("int"))
    kinds = {"bucket_url": pa.string(), "object_name": pa.string(), "content": pa.binary(), "read_error": pa.string()}
    schema = pa.schema(list(kinds.items()))

    def fetch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = _stores(location)

        def read(row: dict) -> dict:
            content, error = None, row["read_error"]
            try:
                if error is None:
                    content = retry(partial(_read_bytes, *store(row["bucket"]), row["object_name"]), final=(FileNotFoundError,))
            except FileNotFoundError:
                error = NOT_FOUND
            except OSError as failure:
                error = str(failure)
            return {"bucket_url": row["bucket_url"], "object_name": row["object_name"], "content": content, "read_error": error}

        with ThreadPoolExecutor(READERS) as pool:
            for rows in _windows(row for batch in batches for row in batch.to_pylist()):
                for bucket in {row["bucket"] for row in rows}:
                    store(bucket)
                parts = in_turns(pool, lambda group: [read(row) for row in group], rows)
                yield pa.RecordBatch.from_pylist([row for part in parts for row in part], schema=schema)

    return dealt.mapInArrow(fetch, "bucket_url string, object_name string, content binary, read_error string")
