import pandas as pd
import pytest

from outlay.functions.values import half_even
from outlay.operators.report import report_lines, spend_report
from tests.frames import d

SCHEMA = "segments_date date, domain string, brand string, channel_type string, total_spend_eur double"


def spend(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def ranked(report):
    return [r.total_spend_eur for r in report.orderBy("rank").collect()]


def test_numeric_and_text_order(spark):
    df = spend(spark, *[(d(1), "com", "b", "on", x) for x in (100.0, 9.0, 10.0)])
    assert ranked(spend_report(df)) == ["9.00", "10.00", "100.00"]
    assert ranked(spend_report(df, text_order=True, number=half_even)) == ["10", "100", "9"]


def test_days_first_nulls_first_and_domain_becomes_country(spark):
    df = spend(spark, (d(2), "a", "b", "on", 1.0), (d(1), "z", "b", "on", 5.0), (d(1), None, None, None, None))
    report = spend_report(df)
    assert report.columns == ["rank", "segments_date", "country", "brand", "channel_type", "total_spend_eur"]
    assert [tuple(r) for r in report.orderBy("rank").collect()] == [
        (1, "2024-01-01", None, None, None, None),
        (2, "2024-01-01", "z", "b", "on", "5.00"),
        (3, "2024-01-02", "a", "b", "on", "1.00"),
    ]
    full = spend_report(df, date_format="yyyy-MM-dd HH:mm:ss").orderBy("rank").first()
    assert full.segments_date == "2024-01-01 00:00:00"


def test_equal_amounts_are_ranked_by_the_other_columns(spark):
    df = spend(spark, *[(d(1), k, "b", "on", 1.0) for k in "dbca"])
    assert [r.country for r in spend_report(df).orderBy("rank").collect()] == list("abcd")


@pytest.mark.parametrize("long", ["x", "a-rather-long-domain.example"])
def test_lines_look_like_a_printed_frame(spark, long):
    data = [(d(1), long, "b", "online", 1000000.0), (d(2), "com", None, "off", 2.456), (d(2), "com", "b", "off", None)]
    lines = report_lines(spend_report(spend(spark, *data)))
    text = "\n".join(r.line for r in lines.orderBy("line_no").collect())
    frame = pd.DataFrame(
        sorted(data, key=lambda r: (r[0], r[4] or 0)),
        columns=["segments_date", "country", "brand", "channel_type", "total_spend_eur"],
    )
    frame["segments_date"] = frame["segments_date"].astype(str)
    assert text == frame.to_string(index=False, float_format="%.2f")


def test_lines_with_amounts_as_text(spark):
    data = [(d(1), "com", "b", "online", 1000000.0), (d(2), "com", "b", "off", 25.0)]
    report = spend_report(spend(spark, *data), text_order=True, number=half_even)
    text = "\n".join(r.line for r in report_lines(report, True).orderBy("line_no").collect())
    frame = pd.DataFrame(data, columns=["segments_date", "country", "brand", "channel_type", "total_spend_eur"])
    frame["segments_date"] = frame["segments_date"].astype(str)
    frame["total_spend_eur"] = frame["total_spend_eur"].map("{:.0f}".format)
    assert text == frame.to_string(index=False)


def test_lines_of_an_empty_report(spark):
    lines = report_lines(spend_report(spend(spark)))
    assert [r.line for r in lines.collect()] == ["segments_date country brand channel_type  total_spend_eur"]
