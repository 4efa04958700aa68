import os
import threading
import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyarrow import fs
from pyspark.sql import functions as F

import isotherm.queries.catalog as catalog
import isotherm.sources.objects as objects
from isotherm import ingest_notifications, missing_objects, notification_misses, notification_outcomes, read_objects
from isotherm.operators.lookup import notified_objects
from isotherm.sources import files
from isotherm.sources.files import read_object_files
from tests.test_notifications import envelope

HEAD = "date,city,temperature\n"


@pytest.fixture()
def contents(spark):
    rows = [("s3://in", "a.csv", HEAD + "d,c,5\n"), ("s3://in/", "b.csv", "x"), ("s3://other", "a.csv", HEAD + "d,o,9\n")]
    return spark.createDataFrame(rows, "bucket_url string, object_name string, text string")


@pytest.fixture()
def notifications(spark):
    rows = [(1, "s3://in", "a.csv"), (2, "s3://in", "a.csv"), (3, "s3://in", "gone.csv"), (4, "s3://other/", "a.csv")]
    return spark.createDataFrame(rows, "i int, bucket_url string, object_name string")


def test_lookup(notifications, contents):
    found = read_objects(notifications, contents).collect()
    assert sorted((r.i, r.bucket_url, r.text[-6:]) for r in found) == [
        (1, "s3://in", "d,c,5\n"), (2, "s3://in", "d,c,5\n"), (4, "s3://other/", "d,o,9\n"),
    ]
    assert [r.i for r in missing_objects(notifications, contents).collect()] == [3]
    assert sorted(r.object_name for r in notified_objects(notifications, contents).collect()) == ["a.csv", "a.csv"]


def test_repeated_notifications_repeat_outcomes(spark, contents):
    texts = [envelope(key="a.csv", time="t1"), envelope(key="a.csv", time="t1"), envelope(key="a.csv", time="t2"),
             envelope(key="gone.csv"), "junk", envelope(key="b.csv"), envelope(bucket="other", key="a.csv")]
    got = ingest_notifications(spark.createDataFrame([(t,) for t in texts], "value string"), contents).collect()
    assert sorted((r.bucket_url, r.object_name, r.event_time, r.status, [tuple(x) for x in r.records]) for r in got) == [
        ("s3://in", "a.csv", "t1", "SUCCESS", [("d", 5, "c", 5, "c")]),
        ("s3://in", "a.csv", "t1", "SUCCESS", [("d", 5, "c", 5, "c")]),
        ("s3://in", "a.csv", "t2", "SUCCESS", [("d", 5, "c", 5, "c")]),
        ("s3://in", "b.csv", "2024-01-15T10:00:00Z", "SUCCESS", []),
        ("s3://other", "a.csv", "2024-01-15T10:00:00Z", "SUCCESS", [("d", 9, "o", 9, "o")]),
    ]


def test_fetch(spark, tmp):
    os.makedirs(f"{tmp}/in/sub")
    for name, text in [("a b.csv", HEAD + "d,c,5\n"), ("sub/é.dat", '{"date":"d","city":"c","temperature":1}')]:
        with open(f"{tmp}/in/{name}", "w", encoding="utf-8") as out:
            out.write(text)
    texts = [envelope(key="a+b.csv"), envelope(key="sub/%C3%A9.dat"), envelope(key="none.csv"), envelope(key="a%20b.csv")]
    messages = spark.createDataFrame([(t,) for t in texts], "value string")
    got = ingest_notifications(messages, location=f"file://{tmp}/{{bucket}}").collect()
    assert sorted((r.object_name, r.format, r.status) for r in got) == [
        ("a b.csv", "CSV", "SUCCESS"), ("a b.csv", "CSV", "SUCCESS"), ("sub/é.dat", "JSON", "SUCCESS"),
    ]
    names = spark.createDataFrame([("s3://in", "a b.csv"), ("s3://in", "none.csv")], "bucket_url string, object_name string")
    missed = notification_misses(notification_outcomes(messages, location=f"file://{tmp}/{{bucket}}")).collect()
    assert [(r.object_name, r.read_error) for r in missed] == [("none.csv", objects.NOT_FOUND)]
    fetched = {r.object_name: r for r in objects.fetch_objects(names, f"file://{tmp}/{{bucket}}").collect()}
    assert fetched["a b.csv"].read_error is None and bytes(fetched["a b.csv"].content).endswith(b"5\n")
    assert fetched["none.csv"].content is None and fetched["none.csv"].read_error == objects.NOT_FOUND


def test_retry_waits():
    waits, calls = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("busy")
        return "read"

    assert objects.retry(flaky, sleep=waits.append) == "read"
    assert waits == [1.0, 2.0]


def test_object_files(spark, tmp):
    os.makedirs(f"{tmp}/x")
    with open(f"{tmp}/x/a.csv", "w") as out:
        out.write("hello")
    row = read_object_files(spark, tmp, "s3://in").drop("modificationTime").first()
    assert (row.bucket_url, row.object_name, row.length, bytes(row.content)) == ("s3://in", "x/a.csv", 5, b"hello")
    names = read_object_files(spark, tmp, "s3://in").select("object_name")
    assert "content" not in names._jdf.queryExecution().executedPlan().toString()
    assert names.select(F.count("*")).first()[0] == 1


@pytest.mark.parametrize("most", [0, 100])
@pytest.mark.parametrize("options", [{}, {"pathGlobFilter": "{part-[0-1],x?}*"}, {"modifiedBefore": "2020-01-01T00:00:00"}])
def test_many_closed_files_are_listed_by_tasks(spark, tmp, monkeypatch, most, options):
    """The driver held each file's status; few files, and options that Spark alone knows, are still its reader's."""
    monkeypatch.setattr(files, "DRIVER_FILES", most)
    for name in ("part-0", "x/part-1", "x/part-2", "x/y/xy", "x/_part-3", "part-4\n"):
        os.makedirs(os.path.dirname(f"{tmp}/{name}"), exist_ok=True)
        with open(f"{tmp}/{name}", "w") as out:
            out.write(name)
    os.utime(f"{tmp}/part-0", (1.5e9, 1.5e9 + 0.123))
    closed = read_object_files(spark, tmp, "s3://in", closed=True, **options)
    open_ = read_object_files(spark, tmp, "s3://in", **options).drop("content")
    assert closed.columns == open_.columns and closed.dtypes == open_.dtypes
    assert sorted(map(tuple, closed.collect())) == sorted(map(tuple, open_.collect())) != []
    by_tasks = most == 0 and "modifiedBefore" not in options
    assert ("FileScan" not in closed._jdf.queryExecution().executedPlan().toString()) == by_tasks


@pytest.mark.parametrize("query", ["fetch_ingest", "fetch_misses"])
def test_fetch_queries_of_many_files(spark, tmp, monkeypatch, query):
    event = "id AS event_id", "TIMESTAMP'2024-01-01 00:00:00' AS ts", "id % 4 AS user_id", "'a' AS event_type", "CAST(id AS DOUBLE) AS value", "'' AS props"
    spark.range(40).selectExpr(*event).write.parquet(f"{tmp}/events.parquet")
    few = sorted(map(tuple, catalog.QUERIES[query](spark, tmp).collect()))
    monkeypatch.setattr(files, "DRIVER_FILES", 0)
    loaded, read = [], type(spark.read).load
    monkeypatch.setattr(type(spark.read), "load", lambda self, *a, **k: loaded.append(a) or read(self, *a, **k))
    assert sorted(map(tuple, catalog.QUERIES[query](spark, tmp).collect())) == few and len(few) == 4 and not loaded


def test_names_that_lead_out_of_the_store(spark, tmp):
    os.makedirs(f"{tmp}/in")
    with open(f"{tmp}/secret.csv", "w") as out:
        out.write("x")
    names = spark.createDataFrame([("s3://in", "../secret.csv"), ("s3://in", "a/../../secret.csv")], "bucket_url string, object_name string")
    assert {r.read_error for r in objects.fetch_objects(names, f"file://{tmp}/{{bucket}}").collect()} == {objects.NOT_FOUND}


def test_refused_objects_are_reported(spark, tmp):
    os.makedirs(f"{tmp}/in/folder.csv")
    messages = spark.createDataFrame([(envelope(key="folder.csv"),)], "value string")
    found = notification_outcomes(messages, location=f"file://{tmp}/{{bucket}}")
    (row,) = notification_misses(found).collect()
    assert row.object_name == "folder.csv" and row.read_error != objects.NOT_FOUND


def test_one_object_named_by_most_messages(spark, contents):
    """The join of outcomes to notifications is split, and the messages are parsed once."""
    texts = [envelope(key="a.csv" if i % 10 else "b.csv", time=f"t{i}") for i in range(4000)]
    messages = spark.createDataFrame([(t,) for t in texts], "value string").repartition(8)
    kept = {k: spark.conf.get(k, None) for k in SKEW}
    try:
        for key, value in SKEW.items():
            spark.conf.set(key, value)
        got = notification_outcomes(messages, contents).where("status = 'SUCCESS'")
        rows = got.collect()
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in kept.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert len(rows) == 4000
    assert "SortMergeJoin(skew=true)" in plan
    assert "from_json" not in plan and "parse_json" not in plan


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
}


def test_even_tasks(spark, tmp):
    """One large object and many small ones: no task reads much more than it should, unless it reads one object."""
    os.makedirs(f"{tmp}/in")
    sizes = {f"o{i}": 30_000 if i % 7 else 90_000 for i in range(120)} | {"large": 3_000_000, "empty": 0}
    for name, size in sizes.items():
        with open(f"{tmp}/in/{name}", "wb") as out:
            out.write(b"x" * size)
    names = spark.createDataFrame([("s3://in", n) for n in [*sizes, "gone"]], "bucket_url string, object_name string")
    fetched = objects.fetch_objects(names, f"file://{tmp}/{{bucket}}", task_bytes=1_000_000)
    rows = fetched.select("object_name", F.length("content").alias("n"), "read_error", F.spark_partition_id().alias("task")).collect()
    assert {r.object_name: r.n for r in rows} == sizes | {"gone": None}
    assert [r.object_name for r in rows if r.read_error] == ["gone"]
    tasks = {}
    for r in rows:
        tasks.setdefault(r.task, []).append((r.n or 0) + objects.OPEN_BYTES)
    assert all(sum(costs) <= 1_000_000 or len(costs) == 1 for costs in tasks.values())
    assert len(tasks) <= 2 * sum(map(sum, tasks.values())) / 1_000_000 + 4


def test_bytes_in_flight(monkeypatch):
    monkeypatch.setattr(objects, "BATCH_BYTES", 100)
    sizes = [40, 60, 1, 500, 99, None, 1, 1]
    assert [[r["size"] for r in w] for w in objects._windows({"size": n} for n in sizes)] == [[40, 60], [1], [500], [99, None, 1], [1]]


def test_no_names(spark, tmp):
    names = spark.createDataFrame([], "bucket_url string, object_name string")
    assert objects.fetch_objects(names, f"file://{tmp}/{{bucket}}").collect() == []


class CountingStore:
    """A store in a dict that counts its calls; it fails for lists with a bad name and, alone, for the bad name."""

    def __init__(self, sizes):
        self.sizes, self.calls = sizes, 0

    def get_file_info(self, paths):
        self.calls += 1
        if "/r/bad" in paths:
            raise OSError("refused")
        infos = [fs.FileInfo(p, fs.FileType.File if p in self.sizes else fs.FileType.NotFound, size=self.sizes.get(p, -1)) for p in ([paths] if isinstance(paths, str) else paths)]
        return infos[0] if isinstance(paths, str) else infos


def test_sizes_of_many_names_take_one_call(monkeypatch):
    store = CountingStore({f"/r/o{i}": i for i in range(20)})
    names = ["o3", "gone", "../o4", "o3", *[f"o{i}" for i in range(20)]]
    got = objects._sizes(store, "/r/", names)
    assert got == [(3, None), (None, objects.NOT_FOUND), (None, objects.NOT_FOUND), (3, None), *[(i, None) for i in range(20)]]
    assert store.calls == 1
    monkeypatch.setattr(objects.retry, "__defaults__", (objects.ATTEMPTS, (0.0, 0.0), (), lambda seconds: None))
    assert objects._sizes(store, "/r", ["o3", "bad", "gone"]) == [(3, None), (None, "refused"), (None, objects.NOT_FOUND)]


def test_readers_get_small_objects_in_groups():
    def sizes(*of):
        return [[r["size"] for r in g] for g in objects.grouped([{"size": n} for n in of])]

    assert sizes() == [] and sizes(5, None, 7) == [[5], [None], [7]]
    many = sizes(*range(1000))
    assert [n for g in many for n in g] == list(range(1000))
    assert len(many) <= 40 and max(map(len, many)) <= objects.GROUP_OBJECTS
    large = objects.GROUP_BYTES
    mixed = sizes(*[large, 1, large - 1, 1] * 32)
    assert all(sum(g) <= large for g in mixed) and sum(map(len, mixed)) == 128


@pytest.mark.parametrize("seconds, sizes", [(0, [5] * 1000), (0.003, [5] * 300), (0, [5] * 20), (0, [objects.GROUP_BYTES, *[5] * 400]), (0, [])])
def test_many_objects_of_a_near_store_are_read_in_turn(seconds, sizes):
    """Threads that hand over the interpreter for each small local file took eight times as long as one."""
    by = []

    def work(group):
        by.extend([threading.current_thread()] * len(group))
        time.sleep(seconds * len(group))
        return [row["i"] for row in group]

    with ThreadPoolExecutor(objects.READERS) as pool:
        got = [i for part in objects.in_turns(pool, work, [{"i": i, "size": n} for i, n in enumerate(sizes)]) for i in part]
    assert got == list(range(len(sizes)))
    here = by.count(threading.current_thread())
    if len(sizes) < objects.MANY:
        assert here == 0
    else:
        assert here == objects.FIRST_FEW if seconds else here > objects.FIRST_FEW


def test_files_of_the_fetch_queries_are_listed_once(spark, monkeypatch):
    listed = []
    monkeypatch.setattr(catalog, "read_object_files", lambda *a, **k: listed.append(1) or read_object_files(*a, **k))
    plans = []
    monkeypatch.setattr(catalog, "notification_outcomes", lambda named, **k: plans.append(named._jdf.queryExecution().executedPlan().toString()) or named)
    sf_dir = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    named = catalog._fetch(spark, sf_dir)
    keys = [r.value for r in named.collect()]
    assert plans[0].count("FileScan binaryFile") == 1 and len(listed) == 1
    assert len(keys) == len(set(keys)) and sorted(k.replace("part-", "gone-") for k in keys if "part-" in k) == sorted(k for k in keys if "part-" not in k)
