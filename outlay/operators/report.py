"""The spend report: order, numbers and dates as text, fixed-width lines."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outlay.functions.values import fixed2
from outlay.operators.ordinals import global_rank

COLUMNS = ["segments_date", "country", "brand", "channel_type", "total_spend_eur"]


def spend_report(
    spend: DataFrame,
    text_order: bool = False,
    number: Callable[[Column], Column] = fixed2,
    date_format: str = "yyyy-MM-dd",
) -> DataFrame:
    """Ranked report rows, all values as text, ``domain`` renamed to ``country``.

    Ordered by day and unrounded amount, NULLs first, then by the remaining columns so that ranks are
    unique. ``text_order`` compares amounts as text, as a report that formats before sorting does.
    """
    amount = number(F.col("total_spend_eur"))
    rows = spend.select(
        "segments_date",
        F.col("domain").alias("country"),
        "brand",
        "channel_type",
        F.col("total_spend_eur").alias("_amount"),
        amount.alias("total_spend_eur"),
    )
    by = ["segments_date", "total_spend_eur" if text_order else "_amount"]
    order = [F.col(c).asc_nulls_first() for c in [*by, "country", "brand", "channel_type"]]
    return global_rank(rows, order, "rank").select(
        "rank",
        F.date_format("segments_date", date_format).alias("segments_date"),
        *COLUMNS[1:],
    )


def report_lines(report: DataFrame, text_amounts: bool = False) -> DataFrame:
    """Right-aligned lines (line_no, line); line 0 is the header.

    Laid out like a printed frame: one space between columns, and one more before a column of
    numbers, which the amounts are unless ``text_amounts`` says otherwise.

    Needs the widest value of each column first: one row of lengths, read from the ranked report,
    which is checkpointed already.
    """
    shown = {
        c: F.coalesce(F.col(c), F.lit("NaN" if c == "total_spend_eur" else "None")) for c in COLUMNS
    }
    longest = report.agg(*[F.max(F.length(text)).alias(c) for c, text in shown.items()]).first()
    width = {c: max(len(c), longest[c] or 0) for c in COLUMNS}

    gap = "" if text_amounts else " "

    def line(cells: list[Column]) -> Column:
        return F.concat_ws(" ", *cells[:-1], F.concat(F.lit(gap), cells[-1])).alias("line")

    header = report.sparkSession.range(1, numPartitions=1).select(
        F.lit(0).cast("bigint").alias("line_no"),
        line([F.lit(c.rjust(width[c])) for c in COLUMNS]),
    )
    body = report.select(
        F.col("rank").alias("line_no"), line([F.lpad(shown[c], width[c], " ") for c in COLUMNS])
    )
    return header.unionByName(body)
