"""Value dictionaries as CSV (header, every value quoted)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


#: How a NULL is written; blanks stay blank.
NULL_CELL = "<null>"


def write_dictionary(pairs: DataFrame, path: str) -> None:
    """Write distinct value pairs as quoted CSV, one file per partition."""
    pairs.write.mode("overwrite").option("header", True).option("quoteAll", True).option("nullValue", NULL_CELL).csv(path)


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Read a dictionary CSV; blank cells stay blank strings, not NULL."""
    return (spark.read.option("header", True).option("emptyValue", "")
            .option("nullValue", NULL_CELL).csv(path))
