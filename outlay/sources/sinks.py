"""Report outputs, written by the executors."""

from pyspark.sql import DataFrame


def write_report(
    report: DataFrame, path: str, data_format: str = "csv", keep_other_days: bool = False
) -> None:
    """One folder per day, rows in rank order within each file.

    An existing report is replaced as a whole, or with ``keep_other_days`` only the days that
    ``report`` has: their folders are replaced when all files are written, so a second attempt gives
    the same, and the files of other days are not touched.
    """
    writer = report.sortWithinPartitions("segments_date", "rank").write.mode("overwrite")
    if data_format == "csv":
        writer = writer.option("header", True)
    writer = writer.option("partitionOverwriteMode", "dynamic" if keep_other_days else "static")
    writer.partitionBy("segments_date").format(data_format).save(path)


def write_lines(lines: DataFrame, path: str) -> None:
    """Text files that give the report when read in name order."""
    lines.orderBy("line_no").select("line").write.mode("overwrite").text(path)
