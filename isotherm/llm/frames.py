"""What the operators share: their input columns, written tables, digests."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Hashable, Iterable, Iterator
from contextlib import suppress

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.session import configure, scratch_path

ID, TEXT = "doc_id", "text"


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, *more: str, id_col: str = ID, text_col: str = TEXT) -> DataFrame:
    """``doc_id`` and ``text`` (null: empty) alone, so that no other column can clash.

    Arrow batches are kept to a few hundred rows, as a row holds a whole text.
    """
    configure(docs.sparkSession)
    return docs.select(
        F.col(id_col).cast("long").alias(ID),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias(TEXT),
        *more,
    )


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written below the shared folder and read again.

    Cuts the lineage, survives lost executors, and lets Spark know its size.
    """
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def once_each(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``rows`` (``doc_id, tag, text``) with each (id, text) once; the ids of those repeated; and how many of these each task read.

    ``tag`` is a hash of the text. Repeats are found by ids and hashes alone:
    where there are none, no text is shuffled, and copies are combined by task.
    """
    counted = rows.groupBy("doc_id", "tag", F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n"))
    many = counted.groupBy("doc_id", "tag").agg(F.sum("n").alias("copies"), F.min("part").alias("first_part")).where("copies > 1")
    many = stored(many.drop("copies"), "repeated")
    named = many.select("doc_id", "tag")
    one_each = rows.join(named, ["doc_id", "tag"], "left_semi").groupBy("doc_id", "tag").agg(F.min("text").alias("text"))
    once = rows.join(named, ["doc_id", "tag"], "left_anti").select("doc_id", "tag", "text").unionByName(one_each)
    return once, named, counted.join(many, ["doc_id", "tag"])


def width(df: DataFrame) -> int:
    """Partitions for an exchange whose number has to be stated."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def in_batches(batches: Iterable[pa.RecordBatch], step, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """One output batch per input batch: ``step`` turns columns into columns."""
    for batch in batches:
        if batch.num_rows:
            yield pa.RecordBatch.from_arrays(step(batch), schema=schema)


def parts_of(text: bytes, size: int, separators: bytes, beyond: int) -> Iterator[tuple[bytes, int]]:
    """Pieces of a text of about ``size`` bytes, cut at separators, and how many bytes of each are its own.

    Behind its own bytes a piece has at least ``beyond`` - 1 whole words more, if the text has.
    """
    table = bytes(32 if b in separators else 120 for b in range(256))
    at = 0
    while at < len(text):
        cut, reach = -1, size
        while cut < 0 and at + reach < len(text):  # a word may be longer than a piece
            cut = text[at : at + reach].translate(table).rfind(b" ")
            reach *= 2
        if cut < 0:
            yield text[at:], len(text) - at
            return
        cut, more = at + cut + 1, 64
        while len(text[cut : cut + more].translate(table).split()) < beyond and cut + more < len(text):
            more *= 2
        yield text[at : cut + more], cut - at
        at = cut


def per_process(key: Hashable, make: Callable):
    """What ``make`` gives, made once per worker process.

    Functions reach the workers by value, so globals of their modules start anew
    with every task; the interpreter's own module does not.
    """
    kept = sys.__dict__.setdefault("_isotherm_llm", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]


def lean(task: Callable[[Iterable], Iterator]) -> Callable[[Iterable], Iterator]:
    """``task`` for a worker that may have served other operators and lives on for more of them.

    What they have kept by ``per_process`` goes before it starts, and memory that
    is free, but still held by the allocators, goes back to the system at either end.
    """

    def run(batches: Iterable) -> Iterator:
        sys.__dict__.get("_isotherm_llm", {}).clear()
        give_back()
        try:
            yield from task(batches)
        finally:
            give_back()

    return run


def give_back() -> None:
    """Free memory of Arrow's pool and of the C library to the system, where that can be done."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)
