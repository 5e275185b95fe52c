"""Reading and writing the raw sheet and the two tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from meterlark import schemas as S
from meterlark.sources.quoted import read_quoted


# Quotes inside a text are doubled, as spreadsheets write them.
CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"'}


def read_raw_csv(
    spark: SparkSession, path: str, columns: list[str], multi_line: bool = True
) -> DataFrame:
    """Raw sheet saved as CSV, every column as text. `columns` lists all columns in file order.

    Texts may hold line breaks (see `sources.quoted`). Turn `multi_line` off for files that are
    known to have none; they are then read in one pass.
    """
    if multi_line:
        return read_quoted(spark, path, S.raw_sheet(columns), CSV_OPTIONS, check_header=True)
    return (
        spark.read.schema(S.raw_sheet(columns))
        .options(**CSV_OPTIONS, enforceSchema=False)
        .csv(path)
    )


def read_raw_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    return spark.read.schema(S.raw_sheet(columns)).parquet(path)


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def write_table(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Overwrite a Parquet table. Partition the measures by year so that later scans can skip years."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Overwrite a folder of CSV parts, each with a header. Parent folders are created.

    An empty text is quoted and a NULL is left blank, so that both survive a round trip, as do
    quotes, blanks at either end and line breaks.
    """
    kept = {"emptyValue": '""', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").options(**CSV_OPTIONS, **kept).csv(path)


def read_csv(
    spark: SparkSession, path: str, schema: StructType, multi_line: bool = True
) -> DataFrame:
    """What `write_csv` wrote; see `read_raw_csv` for `multi_line`."""
    # A blank field is NULL anyway; with this marker a quoted empty text is not.
    options = {**CSV_OPTIONS, "nullValue": "\0"}
    if multi_line:
        return read_quoted(spark, path, schema, options)
    return spark.read.schema(schema).options(**options).csv(path)


def run_sql(spark: SparkSession, text: str, **tables: DataFrame) -> DataFrame:
    """Result of SQL text in which `{name}` stands for the table passed as `name`."""
    return spark.sql(text, **tables)


def scan(table: DataFrame, columns: list[str]) -> DataFrame:
    """All rows, with the columns in table order."""
    return table.select(*columns)
