import datetime
import json
import os
import shutil
import time
import uuid

import pytest
from pyspark.sql import functions as F

from isotherm import create_table, stream_files, stream_notifications, stream_payloads
from isotherm.sinks.table import append_once, append_rows
from isotherm.operators.payloads import number_payloads, payload_files
from isotherm.streaming import jobs
from isotherm.streaming.jobs import starting_position
from isotherm.streaming.ledger import Ledger
from tests.test_notifications import envelope

HEAD = "date,city,temperature\n"


def new_name():
    return f"db_{uuid.uuid4().hex[:8]}.summary"


def put(path, text, age=0):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as out:
        out.write(text)
    then = time.time() - age
    os.utime(path, (then, then))


def content(spark, name):
    return sorted(tuple(r) for r in spark.table(name).collect())


def test_payload_stream(spark, tmp):
    name, seen = new_name(), []

    def run():
        query = stream_payloads(
            spark, f"{tmp}/in", name, f"{tmp}/check", "weather", available_now=True,
            on_outcomes=lambda outcomes, batch: seen.extend((r.object_name, r.bucket_url, r.format, r.status) for r in outcomes.collect()),
        )
        query.awaitTermination()

    put(f"{tmp}/in/1", '[{"date":"d1","city":"a","temperature":1}]', age=50)
    put(f"{tmp}/in/2", " \n", age=45)
    put(f"{tmp}/in/3", "no format here", age=40)
    put(f"{tmp}/in/4", HEAD + "d1,b,9\nd2,b,2", age=30)
    put(f"{tmp}/in/5", HEAD + "d3,b,bad", age=20)
    run()
    assert content(spark, name) == [("d1", 1, "a", 1, "a"), ("d2", 2, "b", 2, "b")]
    assert sorted(seen) == [
        ("message-1.payload", "rabbitmq://weather", "JSON", "SUCCESS"),
        ("message-3.payload", "rabbitmq://weather", "CSV", "SUCCESS"),
        ("message-4.payload", "rabbitmq://weather", "CSV", "FAILURE"),
    ]
    seen.clear()
    put(f"{tmp}/in/6", "<W><Date>d2</Date><City>x</City><Temperature>5</Temperature></W>")
    put(f"{tmp}/in/7", '{"date":"d4","city":"x","temperature":4}')
    run()
    assert content(spark, name) == [("d1", 1, "a", 1, "a"), ("d2", 2, "b", 2, "b"), ("d4", 4, "x", 4, "x")]
    assert sorted(s[0] for s in seen) == ["message-5.payload", "message-6.payload"]
    run()
    assert len(content(spark, name)) == 3


def notify(spark, tmp, table, contents, **options):
    query = stream_notifications(
        spark, f"{tmp}/messages", table, f"{tmp}/check", contents=lambda: contents, available_now=True, **options
    )
    query.awaitTermination()


@pytest.fixture()
def contents(spark):
    rows = [("s3://in", "a.csv", HEAD + "d,c,5\n"), ("s3://in", "b.csv", HEAD + "d,e,6\n")]
    return spark.createDataFrame(rows, "bucket_url string, object_name string, text string")


def test_notification_stream_from_the_start(spark, tmp, contents):
    name = create_table(spark, new_name())
    put(f"{tmp}/messages/1", "\n".join([envelope(key="a.csv"), "junk", envelope(key="gone.csv")]), age=100)
    notify(spark, tmp, name, contents, position="trim_horizon", dead_letter_path=f"{tmp}/dead")
    assert content(spark, name) == [("d", 5, "c", 5, "c")]
    dead = spark.read.json(f"{tmp}/dead").collect()
    assert [(r.value, r.dead_reason) for r in dead] == [("junk", "not_json")]
    put(f"{tmp}/messages/2", envelope(key="a.csv") + "\n" + envelope(key="b.csv"))
    notify(spark, tmp, name, contents, position="TRIM_HORIZON", dead_letter_path=f"{tmp}/dead")
    assert content(spark, name) == [("d", 5, "c", 5, "c"), ("d", 5, "c", 5, "c"), ("d", 6, "e", 6, "e")]


def test_notification_stream_from_now(spark, tmp, contents):
    name = create_table(spark, new_name())
    put(f"{tmp}/messages/1", envelope(key="a.csv"), age=1000)
    notify(spark, tmp, name, contents)
    assert content(spark, name) == []
    put(f"{tmp}/messages/2", envelope(key="b.csv"))
    notify(spark, tmp, name, contents)
    assert content(spark, name) == [("d", 6, "e", 6, "e")]


def test_missing_table_stops_the_stream(spark, tmp, contents):
    put(f"{tmp}/messages/1", envelope(key="a.csv"))
    with pytest.raises(Exception, match="does not exist"):
        notify(spark, tmp, "db_none.t", contents, position="TRIM_HORIZON")


def test_starting_position():
    assert starting_position(None) == "LATEST"
    assert starting_position("trim_horizon") == "TRIM_HORIZON"
    with pytest.raises(ValueError):
        starting_position("EARLIEST")


def test_ledger(spark, tmp):
    ledger = Ledger(spark, tmp)
    assert not ledger.finished(0) and ledger.payloads_before(5) == 0
    ledger.finish(0, 3)
    ledger.finish(1, 4)
    ledger.finish(1, 4)
    assert ledger.finished(1) and not ledger.finished(2)
    assert (ledger.payloads_before(1), ledger.payloads_before(2)) == (3, 7)
    start = ledger.first_start()
    assert Ledger(spark, tmp).first_start() == start


def test_numbers_over_many_tasks(spark):
    rows = spark.range(0, 5000, 1, 13).selectExpr(
        "(id * 7919) % 5000 AS k", "CASE WHEN id % 10 = 0 THEN ' ' ELSE concat('v', (id * 7919) % 5000) END AS value"
    )
    got = {r.k: r.sequence for r in number_payloads(rows, ["k"], start=100).collect()}
    kept = sorted(r.k for r in rows.where("value <> ' '").collect())
    assert got == {k: i + 101 for i, k in enumerate(kept)}


def test_unknown_payloads_leave_gaps(spark):
    df = spark.createDataFrame([(1, "plain"), (2, "a,b"), (3, None), (4, ""), (5, json.dumps({}))], "k int, value string")
    files = payload_files(number_payloads(df, ["k"]), "s", bucket_prefix="x://", event_source="y").orderBy("file_id").collect()
    assert [(r.object_name, r.format, r.bucket_url, r.event_source) for r in files] == [
        ("message-2.payload", "CSV", "x://s", "y"), ("message-3.payload", "JSON", "x://s", "y"),
    ]


def test_numbers_of_missing_and_equal_keys(spark):
    df = spark.createDataFrame([(None, "a,b"), (1, "c,d"), (2, "e,f"), (2, "g,h"), (2, "g,h")], "k int, value string")
    got = sorted((r.sequence, r.k, r.value) for r in number_payloads(df, ["k"]).collect())
    assert got == [(1, None, "a,b"), (2, 1, "c,d"), (3, 2, "e,f"), (4, 2, "g,h"), (5, 2, "g,h")]


def test_payload_bytes_and_time(spark):
    df = spark.range(1).selectExpr("id AS k", "CAST(X'7B2263697479223A2253E36F227D' AS STRING) AS value")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        row = payload_files(number_payloads(df, ["k"]), "s").first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert row.text == '{"city":"S\ufffdo"}'
    told = datetime.datetime.strptime(row.event_time, "%Y-%m-%dT%H:%M:%S.%fZ").replace(tzinfo=datetime.UTC)
    assert abs((datetime.datetime.now(datetime.UTC) - told).total_seconds()) < 600


def test_one_evaluation_per_batch(spark, tmp):
    """Objects are read once, though outcomes are looked at and the first write fails."""
    name, reads, tries, dead = create_table(spark, new_name()), spark.sparkContext.accumulator(0), [], []
    put(f"{tmp}/in/a.csv", HEAD + "d,c,5\n")
    put(f"{tmp}/messages/1", "\n".join([envelope(key="a.csv"), envelope(key="a.csv"), envelope(key="gone.csv"), "junk"]), age=100)

    def counted(text):
        reads.add(1)
        return text

    rows = spark.createDataFrame([("s3://in", "a.csv", HEAD + "d,c,5\n")], "bucket_url string, object_name string, text string")
    contents = rows.withColumn("text", F.udf(counted)("text"))

    def writer(rows, table):
        tries.append(1)
        if len(tries) == 1:
            raise OSError("busy")
        append_rows(rows, table)

    notify(
        spark, tmp, name, contents, position="TRIM_HORIZON", writer=writer, miss_path=f"{tmp}/missed",
        on_outcomes=lambda outcomes, batch: outcomes.collect(), on_dead_letters=lambda n, batch: dead.append((n, batch)),
    )
    assert content(spark, name) == [("d", 5, "c", 5, "c")] * 2
    assert (reads.value, len(tries), dead) == (1, 2, [(1, 0)])
    assert [(r.object_name, r.read_error) for r in spark.read.json(f"{tmp}/missed").collect()] == [("gone.csv", "not found")]


def test_file_stream(spark, tmp):
    name = new_name()

    def run():
        stream_files(spark, f"{tmp}/in", "s3://drop", name, f"{tmp}/check", available_now=True).awaitTermination()

    put(f"{tmp}/in/x/a.tsv", HEAD.replace(",", "\t") + "d1\tc,c\t5\n", age=50)
    put(f"{tmp}/in/b.json", '{"date":"d1","city":"later","temperature":9}', age=40)
    run()
    put(f"{tmp}/in/c.csv", HEAD + "d1,c,1\nd2,c,2\n")
    run()
    run()
    assert content(spark, name) == [("d1", 5, "c,c", 5, "c,c"), ("d2", 2, "c", 2, "c")]


def append_stream(spark, tmp, name):
    query = stream_files(spark, f"{tmp}/in", "s3://in", name, f"{tmp}/check", mode="append", available_now=True)
    query.awaitTermination()


def test_batch_is_not_repeated_after_a_crash_before_its_record(spark, tmp, monkeypatch):
    """The job ends between the table's commit and the ledger's entry; the replay adds nothing."""
    name = create_table(spark, new_name())
    put(f"{tmp}/in/a.csv", HEAD + "d1,b,9\nd2,b,2\nd1,c,11")
    put(f"{tmp}/in/b.csv", HEAD + "d1,b,9")
    want = [("d1", 9, "b", 9, "b"), ("d1", 11, "c", 9, "b"), ("d2", 2, "b", 2, "b")]

    def crash(*args):
        raise RuntimeError("the machine is gone")

    with monkeypatch.context() as broken:
        broken.setattr(Ledger, "finish", crash)
        with pytest.raises(Exception, match="the machine is gone"):
            append_stream(spark, tmp, name)
    assert content(spark, name) == want
    append_stream(spark, tmp, name)
    assert content(spark, name) == want
    put(f"{tmp}/in/c.csv", HEAD + "d1,b,9")
    append_stream(spark, tmp, name)
    assert content(spark, name) == sorted([*want, ("d1", 9, "b", 9, "b")])


def test_append_once_goes_on_after_a_crash_between_files(spark, tmp):
    """Some files are in the table, one is there but not taken from its folder, some are to come."""
    name = create_table(spark, new_name())
    rows = spark.range(40).selectExpr("concat('d', id) AS date", "1 AS max_temp", "'a' AS max_temp_city", "0 AS min_temp", "'b' AS min_temp_city")
    staged, table = f"{tmp}/staged", spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()["data_type"].removeprefix("file:")
    rows.repartition(4).write.parquet(staged)
    files = sorted(f for f in os.listdir(staged) if f.startswith("part-"))
    os.rename(f"{staged}/{files[0]}", f"{table}/{files[0]}")
    shutil.copy(f"{staged}/{files[1]}", f"{table}/{files[1]}")
    for _ in range(3):
        append_once(rows.where("false"), name, staged)
        assert spark.table(name).count() == 40 and spark.table(name).distinct().count() == 40


def test_misses_are_logged_without_a_path(spark, tmp, caplog):
    name = create_table(spark, new_name())
    put(f"{tmp}/in/1", "\n".join([envelope(key="gone.csv"), "no message"]))
    stream_notifications(spark, f"{tmp}/in", name, f"{tmp}/check", location=f"file://{tmp}", position="TRIM_HORIZON", available_now=True).awaitTermination()
    said = [r.getMessage() for r in caplog.records if r.name == "isotherm"]
    assert said == ["batch 0: 1 messages that are no notifications", "batch 0: 1 notifications whose object could not be read"]


def test_a_batch_of_many_files_is_few_tasks(spark, tmp):
    """Spark takes the smallest file for 4 MiB of work; a scan of many has a bounded number of tasks, and the same rows."""
    from isotherm.sources.splits import LEAST_TASKS, few_tasks

    many = spark.range(0, 1000, 1, 1000)
    assert few_tasks(many).rdd.getNumPartitions() == LEAST_TASKS
    assert few_tasks(many).count() == 1000 and few_tasks(spark.range(0, 10, 1, 3)).rdd.getNumPartitions() == 3


@pytest.mark.parametrize("of", ["files", "payloads"])
def test_a_batch_takes_a_bounded_number_of_files(spark, tmp, monkeypatch, of):
    """The driver lists and plans all files of a batch; what one leaves is for the next, in order of arrival."""
    monkeypatch.setattr(jobs, "BATCH_FILES", 2)
    for i in range(5):
        put(f"{tmp}/in/{9 - i}.csv", HEAD + f"d1,c{i},{i}\nd{i + 2},x,1", age=50 - i)

    def run(check, **options):
        name, seen = new_name(), []
        told = {"mode": "create_and_dedupe", "available_now": True, "on_outcomes": lambda rows, batch: seen.append((batch, rows.count())), **options}
        if of == "files":
            stream_files(spark, f"{tmp}/in", "s3://in", name, f"{tmp}/{check}", **told).awaitTermination()
        else:
            stream_payloads(spark, f"{tmp}/in", name, f"{tmp}/{check}", "weather", **told).awaitTermination()
        return content(spark, name), seen

    rows, seen = run("a")
    assert rows == [("d1", 0, "c0", 0, "c0"), *((f"d{i + 2}", 1, "x", 1, "x") for i in range(5))]
    assert seen == [(0, 2), (1, 2), (2, 1)]
    assert run("b", maxFilesPerTrigger="10") == (rows, [(0, 5)])
    if of == "payloads":
        assert Ledger(spark, f"{tmp}/a").payloads_before(3) == 5


def test_batches_are_listed_by_few_tasks_and_not_kept(spark):
    from isotherm.session import LISTING_CACHE_BYTES, LISTING_TASKS, for_file_streams

    before = spark.conf.get(LISTING_TASKS)
    try:
        spark.conf.set(LISTING_TASKS, "10000")
        assert for_file_streams(spark, 300).conf.get(LISTING_TASKS) == "300"
        assert for_file_streams(spark, 900).conf.get(LISTING_TASKS) == "300" and spark.conf.get(LISTING_CACHE_BYTES) == "0"
    finally:
        spark.conf.set(LISTING_TASKS, before)
