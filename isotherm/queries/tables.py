"""Inputs for the registered queries, derived from the given tables.

The tables hold no weather files, so file texts are built from ``events``: an
event's day is the date, its type the city, its value without the fraction the
temperature, its id the place in the file. A file holds one user's events of
one range of ids, so that no file grows without bound however many events a
user has.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isotherm.session import configure, scratch_path

PART_EVENTS = 65536
BUCKET = "s3://drops"
#: Folders that stored files are dealt to; a listing takes each as one piece of work.
FOLDERS = 64
NO_NAME = "__HIVE_DEFAULT_PARTITION__"

# Executors get the functions by value; they need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "user_id",
        F.expr(f"event_id DIV {PART_EVENTS}").alias("part"),
        F.col("event_id").alias("pos"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.col("event_type").alias("city"),
        F.col("value").cast("int").alias("temperature"),
    )


def by_file(rows: DataFrame, record: str, name: str = "records") -> DataFrame:
    """One row per file with its records in order; a file has at most PART_EVENTS of them."""
    collected = F.array_sort(F.collect_list(F.struct("pos", F.expr(record).alias("record"))))
    return rows.groupBy("user_id", "part").agg(F.transform(collected, lambda r: r["record"]).alias(name))


def _named(files: DataFrame, text: str, extension: str) -> DataFrame:
    return files.select(
        "user_id",
        F.expr(f"concat('user-', user_id, '/part-', part, {extension})").alias("object_name"),
        F.expr(text).alias("text"),
    ).withColumns({"file_id": F.col("object_name"), "bucket_url": F.lit(BUCKET)})


CSV_LINE = "concat_ws(',', date, city, temperature)"
CSV_TEXT = "concat('date,city,temperature\\n', array_join(records, '\\n'), '\\n')"
TSV_LINE = "concat_ws('\\t', temperature, 'x', city, date)"
TSV_TEXT = "concat('Temperature\\tnote\\tCITY\\tDate\\r\\n\\r\\n', array_join(records, '\\r\\n'))"
JSON_RECORD = "to_json(named_struct('date', date, 'city', city, 'temperature', temperature))"
JSON_TEXT = """
CASE user_id % 3
WHEN 0 THEN concat('[', array_join(records, ','), ']')
WHEN 1 THEN concat('{"source":"x","records":[', array_join(records, ', '), ']}')
END
"""
JSON_LIST_TEXT = JSON_TEXT.replace("END\n", "ELSE concat(' [\n', array_join(records, '\n,'), '\n]') END\n")
XML_RECORD = (
    "concat('<{tag}><Date>', date, '</Date><City>', city, "
    "'</City><Temperature unit=\"Fahrenheit\">', temperature, '</Temperature></{tag}>')"
)
XML_TEXT = "concat('<?xml version=\"1.0\" encoding=\"UTF-8\"?>\\n<Report>', array_join(records, '\\n'), '</Report>')"


def csv_files(rows: DataFrame) -> DataFrame:
    return _named(by_file(rows, CSV_LINE), CSV_TEXT, "'.csv'")


def tsv_files(rows: DataFrame) -> DataFrame:
    return _named(by_file(rows, TSV_LINE), TSV_TEXT, "'.TAB'")


def json_files(rows: DataFrame) -> DataFrame:
    """An array or an object with records per file; for every third user an object, and so a file, per event."""
    single = event_files(rows.where("user_id % 3 = 2"), JSON_RECORD, ".json")
    return _named(by_file(rows.where("user_id % 3 < 2"), JSON_RECORD), JSON_TEXT, "'.json'").unionByName(single)


def json_list_files(rows: DataFrame) -> DataFrame:
    """An array, or an object with records, per file of every user."""
    return _named(by_file(rows, JSON_RECORD), JSON_LIST_TEXT, "'.json'")


def event_files(rows: DataFrame, text: str, extension: str) -> DataFrame:
    """A file per event, with ``event_id``-ordered names."""
    named = rows.select("user_id", F.expr(f"concat('user-', user_id, '/event-', pos, '{extension}')").alias("object_name"), F.expr(text).alias("text"))
    return named.withColumns({"file_id": F.col("object_name"), "bucket_url": F.lit(BUCKET)})


# One flaw or peculiarity per file, by the event's number.
JSON_SHAPES = """
CASE pos % 8
WHEN 0 THEN to_json(named_struct('date', date, 'city', city, 'temperature', concat(' ', temperature)))
WHEN 1 THEN concat('{"temperature":', temperature, '.7,"city":"', city, '","date":"', date, '","more":[{}]}')
WHEN 2 THEN to_json(named_struct('date', date, 'city', ''))
WHEN 3 THEN concat('[{"date":"', date, '","city":"', city, '","temperature":null}]')
WHEN 4 THEN concat('{"records":[{"date":"', date, '","city":"', city, '","temperature":""}]} tail')
WHEN 5 THEN concat('{"date":"', date, '","city":"', city, '","temperature":', pos % 16 = 5, '}')
WHEN 6 THEN concat('[{"date":"', date, '","city":"', city, '","temperature":', temperature, '},null]')
ELSE concat('{"date":', replace(date, '-', ''), ',"city":', user_id, ',"temperature":', temperature, '}') END
"""
XML_FIELDS = "concat('<date>', date, '</date><CITY>', city, '</CITY><Temperature>', temperature, '</Temperature>')"
XML_SHAPES = f"""
CASE pos % 7
WHEN 0 THEN '<W/>'
WHEN 1 THEN concat('<W>', {XML_FIELDS}, '</W>')
WHEN 2 THEN concat('<W><Row>', {XML_FIELDS}, '</Row><Row/></W>')
WHEN 3 THEN concat('<!DOCTYPE W><W><Row>', {XML_FIELDS}, '</Row></W>')
WHEN 4 THEN concat('<W><Row><Date>x</Date>', {XML_FIELDS}, '</Row></W>')
WHEN 5 THEN concat('<W><Row a="1">', {XML_FIELDS}, '<City><![CDATA[<&>]]></City></Row></W>')
ELSE concat('<W><Row><Date>', date, '</Date><Temperature>1</Temperature></Row></W>') END
"""
CSV_SHAPES = """
CASE pos % 7
WHEN 0 THEN 'date,city,temperature\n'
WHEN 1 THEN concat('date,city,temperature\r', date, ',', city, ',', temperature, '\r')
WHEN 2 THEN concat(' \n\nTEMPERATURE, City ,x,Date\r\n', temperature, ',', city, ',,', date, '\r\n')
WHEN 3 THEN concat('date,date,city,temperature\nx,', date, ',', city, ', ', temperature, ' \n')
WHEN 4 THEN concat('date,city,temperature\n', date, ',', city, ',', temperature, '.0\n')
WHEN 5 THEN concat('date,city,temperature\n', date, ', ,', temperature, '\n')
ELSE concat('date,city,temperature\n', date, ',', city, ',2147483647\n', date, ',z,2147483647\n') END
"""


def xml_files(rows: DataFrame, tag: str = "Observation") -> DataFrame:
    return _named(by_file(rows, XML_RECORD.format(tag=tag)), XML_TEXT, "'.xml'")


def mixed_files(rows: DataFrame) -> DataFrame:
    """Files whose names say nothing; the user decides on one of four formats."""
    line = f"CASE user_id % 4 WHEN 0 THEN {CSV_LINE} WHEN 1 THEN {TSV_LINE} WHEN 2 THEN {JSON_RECORD} ELSE {XML_RECORD.format(tag='Observation')} END"
    text = f"CASE user_id % 4 WHEN 0 THEN {CSV_TEXT} WHEN 1 THEN {TSV_TEXT} WHEN 2 THEN concat('[', array_join(records, ','), ']') ELSE {XML_TEXT} END"
    return _named(by_file(rows, line), text, "'.payload'")


def flawed_csv_files(rows: DataFrame) -> DataFrame:
    """CSV files; those of every seventh user have flawed temperatures, of every eleventh no city column."""
    line = "concat_ws(',', date, city, CASE WHEN user_id % 7 = 0 AND temperature > 20 THEN concat(temperature, '.5') ELSE CAST(temperature AS STRING) END)"
    text = "concat(CASE WHEN user_id % 11 = 0 THEN 'date,town,temperature\\n' ELSE 'date,city,temperature\\n' END, array_join(records, '\\n'))"
    return _named(by_file(rows, line), text, "'.csv'")


def stored(files: DataFrame, line_end: str = "\n") -> str:
    """Write each text as a file of its own, ``line_end`` behind it; returns the folder above.

    The tasks write the files by Arrow, whose store the folder has to be. Spark's
    writer would make a folder for each file, and a listing a task for each folder.
    Texts without a name share a file.
    """
    root = scratch_path(files.sparkSession, "drops")
    drop = F.coalesce(F.regexp_replace("object_name", "[/.]", "_"), F.lit(NO_NAME))
    path = F.format_string("folder=%d/part-%s.txt", F.pmod(F.xxhash64(drop), F.lit(FOLDERS)), drop)
    rows = files.select(path.alias("path"), "text").repartition("path").sortWithinPartitions("path")

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, top = fs.FileSystem.from_uri(root if "://" in root else f"file://{root}")
        pairs = (pair for batch in batches for pair in zip(batch["path"].to_pylist(), batch["text"].to_pylist(), strict=True))
        made = set()
        for path, group in groupby(pairs, lambda pair: pair[0]):
            folder = path.split("/")[0]
            if folder not in made:
                store.create_dir(f"{top}/{folder}", recursive=True)
                made.add(folder)
            with store.open_output_stream(f"{top}/{path}") as out:
                for _, text in group:
                    out.write(((text or "") + line_end).encode())
        yield pa.RecordBatch.from_pydict({"path": pa.array([], pa.string())})

    rows.mapInArrow(write, "path string").write.format("noop").mode("overwrite").save()
    return root


def drop_name(path: str) -> Column:
    """The name of a file of ``stored``, or of one that is named like it, from its path."""
    return F.regexp_extract(path, r"/(?:part|gone)-([^/]+)\.txt$", 1)


# One message per order: mostly about a new object, some flawed in one way each.
KEY = "concat('in+box/', replace(o_orderpriority, ' ', '+'), '%2F', o_orderkey, '.csv')"
MESSAGE = f"""
CASE o_orderkey % 9
WHEN 0 THEN concat('order {{', o_orderkey)
ELSE to_json(named_struct(
  'time', CASE WHEN o_orderkey % 9 <> 6 THEN date_format(o_orderdate, "yyyy-MM-dd'T'HH:mm:ss'Z'") END,
  'source', CASE WHEN o_orderkey % 9 = 5 THEN 'other' ELSE 'aws.s3' END,
  'detail-type', CASE WHEN o_orderkey % 9 = 7 THEN 'Object Deleted' ELSE 'Object Created' END,
  'detail', named_struct(
    'bucket', named_struct('name', CASE WHEN o_orderkey % 9 <> 3 THEN concat('drops-', lower(o_orderstatus)) ELSE '' END),
    'object', named_struct('key', CASE
      WHEN o_orderkey % 9 = 1 THEN NULL
      WHEN o_orderkey % 9 = 2 THEN concat({KEY}, '%zz')
      ELSE {KEY} END, 'size', o_totalprice))))
END
"""


def order_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{MESSAGE} AS value")


def document_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return documents.selectExpr("'s3://library' AS bucket_url", "concat('doc-', doc_id) AS object_name", "text")


def customer_notifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One notification per order, of the document with three times its customer's number."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "'s3://library/' AS bucket_url", "concat('doc-', o_custkey * 3) AS object_name"
    )
