"""The same answers in SQL for another engine, straight from the given tables.

None of these statements parses a file: they compute from ``events`` and the
other tables what the files built from them must lead to.
"""

from __future__ import annotations

OBS = """
obs AS (
  SELECT user_id, event_id // 65536 AS part, event_id AS pos,
         strftime(ts, '%Y-%m-%d') AS date, event_type AS city, CAST(trunc(value) AS INTEGER) AS t
  FROM events)"""

EXTREMES = """
max(t) AS max_temp, (array_agg(city ORDER BY t DESC, pos))[1] AS max_temp_city,
min(t) AS min_temp, (array_agg(city ORDER BY t, pos))[1] AS min_temp_city"""

FILE_ROWS = f"""{OBS},
file_rows AS (
  SELECT user_id, part, date, {EXTREMES} FROM obs GROUP BY user_id, part, date)"""


def _name(extension: str) -> str:
    return f"'user-' || user_id || '/part-' || part || '{extension}'"


COLUMNS = "date, max_temp, max_temp_city, min_temp, min_temp_city"


def _file_rows(extension: str) -> str:
    return f"WITH {FILE_ROWS} SELECT {_name(extension)} AS object_name, {COLUMNS} FROM file_rows"


MIXED_FORMAT = "CASE user_id % 4 WHEN 0 THEN 'CSV' WHEN 1 THEN 'TSV' WHEN 2 THEN 'JSON' ELSE 'XML' END"

TABLE_ROWS = f"WITH {FILE_ROWS} SELECT {COLUMNS} FROM file_rows"
DROP_NAME = "'user-' || user_id || '_part-' || part || '_csv'"

# White space as the JVM sees it, for the texts at hand.
SPACE = "\\t\\n\\x0B\\f\\r\\x1C-\\x1F \\x{1680}\\x{2000}-\\x{2006}\\x{2008}-\\x{200A}\\x{2028}\\x{2029}\\x{205F}\\x{3000}"


def _format(text: str) -> str:
    bare = f"regexp_replace({text}, '^[{SPACE}]+', '')"
    return (
        f"CASE WHEN {bare} LIKE '{{%' OR {bare} LIKE '[%' THEN 'JSON' WHEN {bare} LIKE '<%' THEN 'XML' "
        f"WHEN contains({bare}, chr(9)) THEN 'TSV' WHEN contains({bare}, ',') THEN 'CSV' ELSE 'UNKNOWN' END"
    )


BY_NAME = """
CASE doc_id % 10 WHEN 0 THEN 'CSV' WHEN 1 THEN 'CSV' WHEN 2 THEN 'TSV' WHEN 3 THEN 'TSV' WHEN 4 THEN 'JSON'
WHEN 5 THEN 'JSON' WHEN 6 THEN 'JSON' WHEN 7 THEN 'XML' END"""
ENDING = "['.csv', '.CSV', '.tsv', '.Tab', '.json', '.JSONL', '.ndjson', '.xml', '.txt', '.csv.gz'][doc_id % 10 + 1]"

DOCUMENTS = f"""
WITH typed AS (
  SELECT doc_id, {_format('text')} AS format,
         [x FOR x IN regexp_split_to_array(text, '\\r\\n|\\r|\\n') IF regexp_matches(x, '[^{SPACE}]')] AS lines
  FROM documents),
headed AS (
  SELECT doc_id, format, len(lines) AS n,
         [lower(trim(x)) FOR x IN string_split(lines[1], CASE format WHEN 'TSV' THEN chr(9) ELSE ',' END)] AS cells
  FROM typed),
judged AS (
  SELECT doc_id, format, CASE
    WHEN format = 'UNKNOWN' THEN 'Unsupported file format: UNKNOWN'
    WHEN n < 2 THEN NULL
    WHEN NOT list_contains(cells, 'date') THEN 'Missing required column: date'
    WHEN NOT list_contains(cells, 'city') THEN 'Missing required column: city'
    ELSE 'Missing required column: temperature' END AS error_message
  FROM headed)
SELECT doc_id, format, CASE WHEN error_message IS NULL THEN 'SUCCESS' ELSE 'FAILURE' END AS status,
       CAST(0 AS BIGINT) AS records_processed, CAST(0 AS BIGINT) AS records_written, error_message
FROM judged"""

NO_ROWS = "'FAILURE' AS status, CAST(0 AS BIGINT) AS records_processed, CAST(0 AS BIGINT) AS records_written"

REASON = "CASE o_orderkey % 9 WHEN 0 THEN 'not_json' WHEN 1 THEN 'missing_field' WHEN 2 THEN 'bad_escape' WHEN 3 THEN 'missing_field' END"

EVENT_NAME = "'user-' || user_id || '/event-' || pos"


def _shapes(extension: str, file_format: str, failed: str, empty: str, date: str, t: str, city: str) -> str:
    """One row per event: its file's outcome with at most one summary row; city by the extremes it stands for."""
    kept = f"NOT ({failed}) AND NOT ({empty})"
    return f"""
        WITH {OBS}
        SELECT {EVENT_NAME} || '{extension}' AS object_name, '{file_format}' AS format,
               CASE WHEN {failed} THEN 'FAILURE' ELSE 'SUCCESS' END AS status,
               CASE WHEN {kept} THEN {date} END AS date,
               CAST(CASE WHEN {kept} THEN {t} END AS INTEGER) AS max_temp, CASE WHEN {kept} THEN {city} END AS max_temp_city,
               CAST(CASE WHEN {kept} THEN {t} END AS INTEGER) AS min_temp,
               CASE WHEN {kept} THEN CASE WHEN {t} = 2147483647 THEN '' ELSE {city} END END AS min_temp_city
        FROM obs"""


JUDGED = """
        judged AS (
          SELECT *, CASE WHEN user_id % 11 = 0 THEN 'Missing required column: city'
                         WHEN user_id % 7 = 0 AND t > 20 THEN 'For input string: "' || t || '.5"' END AS error
          FROM obs)"""

ORACLE = {
    "daily_extremes": f"WITH {OBS} SELECT date, {EXTREMES} FROM obs GROUP BY date",
    "daily_extremes_per_file": f"WITH {OBS} SELECT user_id, date, {EXTREMES} FROM obs GROUP BY user_id, date",
    "csv_ingest": _file_rows(".csv"),
    "tsv_ingest": _file_rows(".TAB"),
    "json_ingest": f"""
        WITH {OBS},
        named AS (SELECT *, CASE WHEN user_id % 3 < 2 THEN {_name('.json')} ELSE {EVENT_NAME} || '.json' END AS object_name FROM obs)
        SELECT object_name, date, {EXTREMES} FROM named GROUP BY object_name, date""",
    "xml_ingest": _file_rows(".xml"),
    "xml_ingest_other_tag": _file_rows(".xml"),
    "mixed_ingest": f"""
        WITH {FILE_ROWS}
        SELECT {_name('.payload')} AS object_name, {MIXED_FORMAT} AS format, {COLUMNS} FROM file_rows""",
    "csv_observations": f"""
        WITH {OBS}
        SELECT {_name('.csv')} AS file_id, row_number() OVER (PARTITION BY user_id, part ORDER BY pos) AS pos,
               date, city, t AS temperature
        FROM obs""",
    "detect_by_content": f"""
        SELECT 'documents' AS source, CAST(doc_id AS VARCHAR) AS key, {_format('text')} AS format FROM documents
        UNION ALL SELECT 'pages', CAST(page_id AS VARCHAR), {_format('html')} FROM pages
        UNION ALL SELECT 'events', CAST(event_id AS VARCHAR), {_format('props')} FROM events
        UNION ALL SELECT 'conversations', conv_id || '-' || turn, {_format('text')} FROM conversations""",
    "detect_by_name": f"""
        SELECT doc_id, 'in/doc-' || doc_id || {ENDING} AS object_name, {BY_NAME} AS named_format,
               coalesce({BY_NAME}, {_format('text')}) AS format
        FROM documents""",
    "file_outcomes": f"""
        WITH {OBS},
        judged AS (
          SELECT *, CASE WHEN user_id % 11 = 0 THEN 'Missing required column: city'
                         WHEN user_id % 7 = 0 AND t > 20 THEN 'For input string: "' || t || '.5"' END AS error
          FROM obs),
        files AS (
          SELECT user_id, part, arg_min(error, CASE WHEN error IS NOT NULL THEN pos END) AS error_message, count(DISTINCT date) AS n
          FROM judged GROUP BY user_id, part)
        SELECT {_name('.csv')} AS object_name, 'CSV' AS format,
               CASE WHEN error_message IS NULL THEN 'SUCCESS' ELSE 'FAILURE' END AS status,
               CASE WHEN error_message IS NULL THEN n ELSE 0 END AS records_processed,
               CASE WHEN error_message IS NULL THEN n ELSE 0 END AS records_written,
               error_message,
               CAST(CASE WHEN error_message IS NULL THEN n ELSE 0 END AS INTEGER) AS row_count
        FROM files""",
    "document_outcomes": DOCUMENTS,
    "page_outcomes": f"SELECT page_id, 'XML' AS format, {NO_ROWS} FROM pages",
    "props_outcomes": f"SELECT event_id, 'JSON' AS format, {NO_ROWS} FROM events",
    "json_shapes": _shapes(
        ".json", "JSON", "pos % 8 IN (5, 6)", "false", "CASE pos % 8 WHEN 7 THEN replace(date, '-', '') ELSE date END",
        "CASE WHEN pos % 8 IN (2, 3, 4) THEN 0 ELSE t END",
        "CASE pos % 8 WHEN 2 THEN '' WHEN 7 THEN CAST(user_id AS VARCHAR) ELSE city END",
    ),
    "xml_shapes": _shapes(
        ".xml", "XML", "pos % 7 IN (2, 3, 6)", "pos % 7 = 0", "date", "t", "CASE pos % 7 WHEN 5 THEN '<&>' ELSE city END"
    ),
    "csv_shapes": _shapes(
        ".csv", "CSV", "pos % 7 IN (4, 5)", "pos % 7 = 0", "date", "CASE pos % 7 WHEN 6 THEN 2147483647 ELSE t END", "city"
    ),
    "parse_notifications": f"""
        SELECT o_orderkey, 's3://drops-' || lower(o_orderstatus) AS bucket_url,
               'in box/' || o_orderpriority || '/' || o_orderkey || '.csv' AS object_name,
               CASE WHEN o_orderkey % 9 <> 6 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END AS event_time,
               CASE WHEN o_orderkey % 9 = 5 THEN 'other' ELSE 'aws.s3' END AS event_source,
               'drops-' || lower(o_orderstatus) AS bucket
        FROM orders WHERE {REASON} IS NULL""",
    "dead_letters": f"SELECT o_orderkey, {REASON} AS dead_reason FROM orders WHERE {REASON} IS NOT NULL",
    "dead_letter_counts": f"""
        SELECT {REASON} AS dead_reason, count(*) AS messages FROM orders WHERE {REASON} IS NOT NULL GROUP BY 1""",
    "dead_letter_messages": """
        SELECT o_orderkey, 'order\\r\\n' || o_orderkey || '\\n' AS message, 'not_json' AS dead_reason FROM orders""",
    "route_events": "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' AND o_orderkey % 9 NOT IN (0, 3, 5, 7)",
    "read_objects": f"""
        SELECT o_orderkey, 'doc-' || o_custkey * 3 AS object_name, CAST(length(text) AS INTEGER) AS chars, {_format('text')} AS format
        FROM orders JOIN documents ON o_custkey * 3 = doc_id""",
    "missing_objects": """
        SELECT o_orderkey, 'doc-' || o_custkey * 3 AS object_name FROM orders
        WHERE NOT EXISTS (SELECT 1 FROM documents WHERE doc_id = o_custkey * 3)""",
    "notification_ingest": f"""
        WITH {OBS},
        files AS (SELECT user_id, part, count(DISTINCT date) AS n FROM obs GROUP BY user_id, part)
        SELECT pos AS event_id, 'user-' || user_id || '/part-' || part || '.csv' AS object_name, 'CSV' AS format,
               'aws.s3' AS event_source, 'SUCCESS' AS status, n AS records_processed, n AS records_written
        FROM obs JOIN files USING (user_id, part)""",
    "payload_files": f"""
        WITH numbered AS (
          SELECT text, row_number() OVER (ORDER BY conv_id, turn) AS sequence
          FROM conversations WHERE regexp_matches(text, '[^{SPACE}]'))
        SELECT sequence, 'rabbitmq://talk' AS bucket_url, 'message-' || sequence || '.payload' AS object_name,
               'rabbitmq-streams' AS event_source, {_format('text')} AS format, CAST(length(text) AS INTEGER) AS chars
        FROM numbered WHERE {_format('text')} <> 'UNKNOWN'""",
    "payload_ingest": f"""
        WITH {FILE_ROWS},
        numbered AS (
          SELECT user_id, part, row_number() OVER (ORDER BY {_name('.payload')}) AS sequence
          FROM (SELECT DISTINCT user_id, part FROM obs))
        SELECT 'message-' || sequence || '.payload' AS object_name, {MIXED_FORMAT} AS format, {COLUMNS}
        FROM file_rows JOIN numbered USING (user_id, part)""",
    "append_table": TABLE_ROWS,
    "dedupe_table": f"""
        WITH {FILE_ROWS}
        SELECT {COLUMNS} FROM file_rows
        QUALIFY row_number() OVER (PARTITION BY date ORDER BY user_id % 2, {_name('.csv')}) = 1""",
    "outcomes_table": f"""
        WITH {FILE_ROWS}, {JUDGED},
        failed AS (SELECT DISTINCT user_id, part FROM judged WHERE error IS NOT NULL)
        SELECT {COLUMNS} FROM file_rows ANTI JOIN failed USING (user_id, part)""",
    "existing_dates": f"WITH {FILE_ROWS} SELECT date FROM file_rows",
    "latest_rows": f"""
        WITH {OBS} SELECT user_id, date, {EXTREMES} FROM obs GROUP BY user_id, date ORDER BY date, user_id LIMIT 20""",
    "rows_by_date": f"WITH {OBS} SELECT user_id, date, {EXTREMES} FROM obs GROUP BY user_id, date ORDER BY date",
    "delimited_scan": f"WITH {FILE_ROWS} SELECT {DROP_NAME} AS file_name, {COLUMNS} FROM file_rows",
    "delimited_scan_outcomes": f"""
        WITH {FILE_ROWS}
        SELECT {DROP_NAME} AS file_name, 'SUCCESS' AS status, count(*) AS records_processed, count(*) AS records_written
        FROM file_rows GROUP BY user_id, part""",
    "json_scan": f"WITH {FILE_ROWS} SELECT replace({DROP_NAME}, '_csv', '_json') AS file_name, {COLUMNS} FROM file_rows",
    "json_scan_outcomes": f"""
        WITH {FILE_ROWS}
        SELECT replace({DROP_NAME}, '_csv', '_json') AS file_name,
               CASE WHEN user_id % 5 = 0 THEN 'FAILURE' ELSE 'SUCCESS' END AS status,
               CASE WHEN user_id % 5 = 0 THEN 0 ELSE count(*) END AS records_processed,
               CASE WHEN user_id % 5 = 0 THEN 0 ELSE count(*) END AS records_written,
               CASE WHEN user_id % 5 = 0 THEN 'Malformed JSON document' END AS error_message
        FROM file_rows GROUP BY user_id, part""",
    "xml_scan": f"WITH {FILE_ROWS} SELECT replace({DROP_NAME}, '_csv', '_xml') AS file_name, {COLUMNS} FROM file_rows",
    "xml_scan_outcomes": f"""
        WITH {FILE_ROWS}
        SELECT replace({DROP_NAME}, '_csv', '_xml') AS file_name,
               CASE WHEN user_id % 5 = 0 THEN 'FAILURE' ELSE 'SUCCESS' END AS status,
               CASE WHEN user_id % 5 = 0 THEN 0 ELSE count(*) END AS records_processed,
               CASE WHEN user_id % 5 = 0 THEN 0 ELSE count(*) END AS records_written,
               CASE WHEN user_id % 5 = 0 THEN 'Malformed XML document' END AS message_start
        FROM file_rows GROUP BY user_id, part""",
    "fetch_ingest": f"WITH {FILE_ROWS} SELECT {DROP_NAME} AS file_name, {COLUMNS} FROM file_rows",
    "fetch_misses": f"""
        WITH {FILE_ROWS}
        SELECT DISTINCT replace({DROP_NAME}, 'part-', 'gone-') AS file_name, 'aws.s3' AS event_source, 'not found' AS read_error
        FROM file_rows""",
    "stream_files": TABLE_ROWS,
    "stream_payloads": TABLE_ROWS,
    "stream_payload_dates": f"WITH {OBS} SELECT DISTINCT date FROM obs",
    "stream_notifications": TABLE_ROWS,
    "bad_bytes": f"""
        WITH {OBS},
        marked AS (SELECT *, CASE WHEN pos % 3 < 2 THEN chr(65533) ELSE chr(233) END || city AS place FROM obs)
        SELECT {EVENT_NAME} || '.csv' AS object_name, date, t AS max_temp, place AS max_temp_city, t AS min_temp, place AS min_temp_city
        FROM marked""",
    "json_malformed": f"""
        WITH {OBS}
        SELECT {EVENT_NAME} || '.json' AS object_name, CASE WHEN pos % 6 = 5 THEN 'SUCCESS' ELSE 'FAILURE' END AS status,
               CAST(pos % 6 = 5 AS BIGINT) AS records_processed, CAST(pos % 6 = 5 AS BIGINT) AS records_written,
               pos % 6 <> 5 AS has_message, CAST(pos % 6 = 5 AS INTEGER) AS row_count
        FROM obs""",
    "record_order": f"""
        WITH {FILE_ROWS}
        SELECT {_name('.csv')} AS object_name, CAST(row_number() OVER (PARTITION BY user_id, part ORDER BY date) - 1 AS INTEGER) AS place, date
        FROM file_rows""",
    "processing_times": f"""
        WITH {OBS}, files AS (SELECT DISTINCT user_id, part FROM obs)
        SELECT 'message-' || row_number() OVER (ORDER BY {_name('.csv')}) || '.payload' AS object_name,
               true AS event_is_new, true AS processed_now
        FROM files""",
    "empties_table": f"""
        WITH {OBS}
        SELECT date, CASE pos % 7 WHEN 6 THEN 2147483647 ELSE t END AS max_temp, city AS max_temp_city,
               CASE pos % 7 WHEN 6 THEN 2147483647 ELSE t END AS min_temp, CASE pos % 7 WHEN 6 THEN '' ELSE city END AS min_temp_city
        FROM obs WHERE pos % 7 NOT IN (0, 4, 5)""",
    "partial_table": f"""
        WITH {FILE_ROWS}, {JUDGED},
        failed AS (SELECT DISTINCT user_id, part FROM judged WHERE error IS NOT NULL)
        SELECT {COLUMNS} FROM file_rows ANTI JOIN failed USING (user_id, part)""",
    "tables_by_format": f"""
        WITH {FILE_ROWS}
        SELECT 'rows_' || lower({MIXED_FORMAT}) AS table_name, count(*) AS n_rows FROM file_rows GROUP BY 1
        UNION ALL SELECT 'temperature_summary', 0""",
    "rows_of_new_dates": f"""
        WITH {FILE_ROWS}
        SELECT {_name('.csv')} AS object_name, {COLUMNS} FROM file_rows
        WHERE date NOT IN (SELECT date FROM obs WHERE substring(date, 9, 2) <= '10')""",
    "csv_output": f"""
        WITH {FILE_ROWS}
        SELECT {_name('.csv')} AS object_name, date, CAST(max_temp AS VARCHAR) AS max_temp, max_temp_city,
               CAST(min_temp AS VARCHAR) AS min_temp, min_temp_city
        FROM file_rows""",
    "write_retry": f"WITH {FILE_ROWS} SELECT {COLUMNS}, CAST(3 AS INTEGER) AS tries, CAST(3.0 AS DOUBLE) AS waited FROM file_rows",
    "missing_table": f"""
        WITH {OBS} SELECT DISTINCT {_name('.csv')} AS object_name, CAST(1 AS INTEGER) AS tries, true AS names_table FROM obs""",
    "custom_parser": f"""
        WITH {FILE_ROWS}
        SELECT CASE user_id % 2 WHEN 0 THEN {_name('.pipe')} ELSE {_name('.csv')} END AS object_name,
               CASE user_id % 2 WHEN 0 THEN 'PIPE' ELSE 'CSV' END AS format, {COLUMNS}
        FROM file_rows""",
    "stream_latest": f"WITH {FILE_ROWS} SELECT {COLUMNS} FROM file_rows WHERE user_id % 2 = 1",
}
