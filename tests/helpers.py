"""Small fixtures: file texts in, plain Python values out."""

from isotherm import ingest_files


def files_frame(spark, named_texts):
    rows = []
    for i, (name, text) in enumerate(named_texts):
        content = text if isinstance(text, bytes) else text.encode("utf-8")
        rows.append((i, "s3://in", name, "2024-01-15T00:00:00Z", "aws:s3", bytearray(content)))
    return spark.createDataFrame(
        rows,
        "file_id long, bucket_url string, object_name string, event_time string, event_source string, content binary",
    )


def outcomes(spark, named_texts, parsers=None):
    """Outcome rows in input order."""
    got = ingest_files(files_frame(spark, named_texts), parsers).collect()
    return sorted(got, key=lambda row: row.file_id)


def results(spark, named_texts, parsers=None):
    """(status, rows or message) per file, in input order."""
    shown = []
    for row in outcomes(spark, named_texts, parsers):
        rows = [tuple(record) for record in row.records]
        shown.append((row.status, rows if row.status == "SUCCESS" else row.error_message))
    return shown
