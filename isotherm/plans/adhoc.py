"""SQL over the result table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from isotherm.functions.location import resolve_table

DEFAULT_TABLE = "temperature_summary"
DEFAULT_ROWS = 20


def run_sql(
    spark: SparkSession, text: str | None = None, table: str = DEFAULT_TABLE, **frames: DataFrame
) -> DataFrame:
    """Any SQL text; without one the first rows of the table by date.

    ``frames`` may stand in the text as ``{name}`` where a table would.
    """
    default = f"SELECT * FROM {resolve_table(table)} ORDER BY date LIMIT {DEFAULT_ROWS}"
    return spark.sql(text or default, **frames)


def list_tables(spark: SparkSession, namespace: str = "default") -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {namespace}")


def write_csv(result: DataFrame, path: str) -> None:
    """A query result as CSV with a header line, all values quoted."""
    result.write.option("header", True).option("quoteAll", True).csv(path)
