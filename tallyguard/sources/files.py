"""Bronze, gold, CSV and NDJSON files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyguard.functions.numeric import nan_to_null
from tallyguard.functions.text import strip
from tallyguard.sources.schemas import BRONZE_SCHEMA, TRANSACTION_SCHEMA, snake_name

# The texts that a CSV reader of data frames takes as missing by default.
MISSING_WORDS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def read_bronze(
    spark: SparkSession,
    path: str,
    fallback: Callable[[], DataFrame] | None = None,
    force: bool = False,
) -> DataFrame:
    """The bronze table, or ``fallback()`` where it is absent or empty, or where ``force`` is set.

    Without a fallback an absent table is an error and an empty one is returned as it is. Absence is
    what Spark reports for the path, so any file system works.
    """
    if force:
        if fallback is None:
            raise ValueError("force needs a fallback")
        return fallback()
    try:
        bronze = spark.read.schema(BRONZE_SCHEMA).parquet(path)
    except AnalysisException as error:
        if fallback is None or error.getCondition() != "PATH_NOT_FOUND":
            raise
        return fallback()
    if fallback is not None and bronze.isEmpty():
        return fallback()
    return bronze


def write_gold(summary: DataFrame, path: str) -> DataFrame:
    """Replace the summary table and return what was written, so that it is computed once."""
    summary.write.mode("overwrite").parquet(path)
    return summary.sparkSession.read.schema(summary.schema).parquet(path)


def read_transactions_csv(
    spark: SparkSession, path: str, types: T.StructType = TRANSACTION_SCHEMA, multi_line: bool = False
) -> DataFrame:
    """Labelled CSV with a header, in snake-case names, columns in any order.

    Columns that ``types`` knows get its type, others stay text; an unreadable number and the usual
    words for a missing value become NULL. ``multi_line`` allows line ends within quotes, at the price
    of one task per file.
    """
    raw = (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(path)
    )
    known = {f.name: f.dataType for f in types.fields}
    columns = []
    for title in raw.columns:
        name = snake_name(title)
        text = F.col(f"`{title}`")
        present = F.when(~text.isin(*MISSING_WORDS), text)
        columns.append(present.try_cast(known.get(name, T.StringType())).alias(name))
    return nan_to_null(raw.select(*columns))


def write_csv(df: DataFrame, path: str) -> None:
    """Export with a header, quotes doubled within quotes, and white space kept."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def ndjson_lines(df: DataFrame) -> DataFrame:
    """The messages that hold a value, one line each."""
    return df.where(F.col("raw_json").isNotNull()).select(F.col("raw_json").alias("value"))


def export_topic(bronze: DataFrame, path: str, max_rows: int | None = None) -> None:
    """Append messages to NDJSON files. ``max_rows`` counts messages read, NULL values included."""
    taken = bronze if max_rows is None else bronze.limit(max_rows)
    ndjson_lines(taken).write.mode("append").text(path)


def read_ndjson(
    spark: SparkSession, path: str, max_rows: int | None = None, streaming: bool = False
) -> DataFrame:
    """Lines of NDJSON files without the blank ones, as ``raw_json``, ``file_name`` and ``valid``."""
    reader = spark.readStream if streaming else spark.read
    lines = (
        reader.schema("value string")
        .text(path)
        .select(strip(F.col("value")).alias("raw_json"), F.col("_metadata.file_name").alias("file_name"))
        .where("raw_json != ''")
    )
    if max_rows is not None:
        lines = lines.limit(max_rows)
    parsed = F.try_parse_json(F.col("raw_json"))
    return lines.withColumn("valid", parsed.isNotNull())


def ingest_ndjson(
    spark: SparkSession, path: str, max_rows: int | None = None, streaming: bool = False
) -> tuple[DataFrame, DataFrame]:
    """NDJSON lines to (messages, rejects): key = text of the id, value = the line."""
    lines = read_ndjson(spark, path, max_rows, streaming)
    good = lines.where("valid").select(
        F.get_json_object("raw_json", "$.transaction_id").alias("key"),
        F.col("raw_json").alias("value"),
    )
    bad = lines.where("NOT valid").select("file_name", "raw_json")
    return good, bad
