"""Binary files that Spark itself writes and reads, so that any file system it knows will do."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

END = b"\n"


def write(df: DataFrame, column: str, path: str, records: int, compression: str = "none") -> None:
    """The binary records of ``column``, one after the other, each followed by one ``\\n`` byte.

    The text writer puts the bytes of a string out as they are. ``records`` bounds the records of a
    file and, with the records' own bound, its size: files are read whole.
    """
    (
        df.select(F.col(column).cast("string").alias("value"))
        .write.option("lineSep", "\n")
        .option("compression", compression)
        .option("maxRecordsPerFile", records)
        .text(path)
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """The files under ``path``: ``path``, ``content``."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "part-*")
        .load(path)
        .select("path", "content")
    )
