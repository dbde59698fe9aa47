import pytest
from pyspark.sql import functions as F

from outlay.functions.values import typed
from outlay.sources.files import read_csv
from outlay.sources.schemas import RATES

from tests.frames import rows


def test_header_is_cleaned_and_values_stay_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text(" ACCOUNT_ID ,Channel Type\n007,\n8,NA\n")
    df = read_csv(spark, str(tmp_path / "a.csv"))
    assert df.columns == ["account_id", "channel_type", "src_ord", "src_malformed"]
    assert rows(df, "account_id", "channel_type") == [("007", None), ("8", "NA")]
    with_tokens = read_csv(spark, str(tmp_path / "a.csv"), na_tokens=True)
    assert rows(with_tokens, "channel_type") == [(None,), (None,)]


def test_columns_are_bound_by_name(spark, tmp_path):
    (tmp_path / "r.csv").write_text(
        "VALID_TO,RATE,BASE,CURRENCY,VALID_FROM\n2024-01-31,1.2,EUR,USD,2024-01-01\n"
    )
    row = typed(read_csv(spark, str(tmp_path / "r.csv")), RATES).first()
    assert (row.currency, row.base, row.rate, str(row.valid_from)) == ("USD", "EUR", 1.2, "2024-01-01")


def test_files_with_different_headers_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("A,B\n1,2\n")
    (tmp_path / "b.csv").write_text("B,A\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(tmp_path)).collect()


def test_ordinal_follows_each_file_across_splits(spark, tmp_path, conf):
    conf(spark__sql__files__maxPartitionBytes="2000")
    for name, n in (("small", 50), ("large", 2000)):
        (tmp_path / f"{name}.csv").write_text(
            "NAME,LINE\n" + "".join(f"{name},{i}\n" for i in range(n))
        )
    df = read_csv(spark, str(tmp_path))
    assert df.rdd.getNumPartitions() > 4
    ordered = df.orderBy("src_ord").select("name", F.col("line").cast("int")).collect()
    for name, n in (("small", 50), ("large", 2000)):
        assert [r.line for r in ordered if r.name == name] == list(range(n))


def test_order_is_that_of_the_list_then_of_file_names(spark, tmp_path):
    orders = []
    for folder in ("zeta", "alpha", "m"):
        (tmp_path / folder).mkdir()
        for name, value in (("a", 1), ("b", 2)):
            (tmp_path / folder / f"{name}.csv").write_text(f"V\n{value}\n")
        base = str(tmp_path / folder)
        for paths in (base, [f"{base}/a.csv", f"{base}/b.csv"], [f"{base}/b.csv", f"{base}/a.csv"]):
            orders.append([r.v for r in read_csv(spark, paths).orderBy("src_ord").collect()])
    assert orders == [["1", "2"], ["1", "2"], ["2", "1"]] * 3


def test_doubled_quotes_and_line_breaks(spark, tmp_path):
    (tmp_path / "q.csv").write_text('A,B\n"x ""y"" z",1\n"two\nlines",2\n')
    df = read_csv(spark, str(tmp_path / "q.csv"), line_breaks=True)
    assert rows(df, "a", "b", "src_malformed") == [
        ("two\nlines", "2", False),
        ('x "y" z', "1", False),
    ]


def test_rows_of_another_width_are_marked(spark, tmp_path):
    (tmp_path / "w.csv").write_text("A,B\n1,2\n3\n4,5,6\n")
    df = read_csv(spark, str(tmp_path / "w.csv"))
    assert rows(df, "a", "src_malformed") == [("1", False), ("3", True), ("4", True)]


def test_files_with_mixed_headers_are_bound_by_name(spark, tmp_path):
    (tmp_path / "a b.csv").write_text('A,"B c"\n1,2\n3,4\n')
    (tmp_path / "c+d%20.csv").write_text(" b C ,A\n6,5\n")
    (tmp_path / "e.csv").write_text("\nB_C,a\n8,7\n")
    (tmp_path / "f.csv").write_text("")
    df = read_csv(spark, str(tmp_path), mixed_headers=True)
    assert rows(df, "a", "b_c") == [("1", "2"), ("3", "4"), ("5", "6"), ("7", "8")]
    assert [r.a for r in df.orderBy("src_ord").collect()] == ["1", "3", "5", "7"]
    (tmp_path / "g.csv").write_text("A,D\n1,2\n")
    with pytest.raises(ValueError, match="differ"):
        read_csv(spark, str(tmp_path), mixed_headers=True)


def test_mixed_headers_of_one_kind_and_of_none(spark, tmp_path):
    (tmp_path / "a.csv").write_text("A\n1\n")
    assert rows(read_csv(spark, str(tmp_path), mixed_headers=True), "a") == [("1",)]
