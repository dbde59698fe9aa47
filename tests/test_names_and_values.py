import pytest
from pyspark.sql import functions as F

from outlay.functions.names import normalize_columns
from outlay.functions.values import NA_TOKENS, fixed2, half_even, is_close, na_to_null, typed
from outlay.sources.schemas import COSTS, RATES


def test_names_are_trimmed_lowered_and_joined(spark):
    df = spark.createDataFrame([(1, 2, 3)], [" My Col ", "CUSTOMER_ID", "rate"])
    assert normalize_columns(df).columns == ["my_col", "customer_id", "rate"]


def test_colliding_names_are_an_error(spark):
    df = spark.createDataFrame([(1, 2)], ["A B", "a_b"])
    with pytest.raises(ValueError, match="a_b"):
        normalize_columns(df)


def test_unusable_values_become_null_and_ids_stay_text(spark):
    raw = spark.createDataFrame(
        [("abc", "007", "1", "x", "soon"), ("2024-01-05", "8", "2", "12", "2024-01-05T10:00:00Z")],
        "segments_date string, customer_id string, campaign_id string, "
        "metrics_cost_micros string, last_extracted_at string",
    )
    bad, good = typed(raw, COSTS).orderBy(F.col("segments_date").asc_nulls_first()).collect()
    assert (bad.segments_date, bad.customer_id, bad.metrics_cost_micros) == (None, "007", None)
    assert bad.last_extracted_at is None
    assert (str(good.segments_date), good.metrics_cost_micros) == ("2024-01-05 00:00:00", 12)


def test_time_of_day_is_dropped_from_days(spark):
    raw = spark.createDataFrame(
        [("USD", "EUR", "1.2", "2024-01-05T23:30:00", "2024-01-06")],
        "currency string, base string, rate string, valid_from string, valid_to string",
    )
    assert str(typed(raw, RATES).first().valid_from) == "2024-01-05"


def test_missing_column_is_named(spark):
    with pytest.raises(ValueError, match="valid_to"):
        typed(spark.createDataFrame([("USD",)], ["currency"]), RATES)


def test_na_tokens(spark):
    values = [*NA_TOKENS, "na", "unknown"]
    df = spark.createDataFrame([(v, 1) for v in values], "a string, n int")
    kept = [r.a for r in na_to_null(df).filter("a is not null").collect()]
    assert sorted(kept) == ["na", "unknown"]
    assert na_to_null(spark.createDataFrame([(None, 1)], "a string, n int")).first().a is None


@pytest.mark.parametrize(
    ("x", "two", "even"),
    [
        (2.5, "2.50", "2"),
        (3.5, "3.50", "4"),
        (-2.5, "-2.50", "-2"),
        (1e9, "1000000000.00", "1000000000"),
        (0.125, "0.12", "0"),
        (2.675, "2.67", "3"),
        (1.005, "1.00", "1"),
        (-0.375, "-0.38", "0"),
        (0.005, "0.01", "0"),
        (99.995, "100.00", "100"),
        (None, None, None),
    ],
)
def test_number_text(spark, x, two, even):
    df = spark.createDataFrame([(x,)], "x double")
    assert tuple(df.select(fixed2(F.col("x")), half_even(F.col("x"))).first()) == (two, even)


def test_is_close_is_relative_and_null_aware(spark):
    df = spark.createDataFrame([(1e9, 1e9 + 1.0), (1.0, 1.1), (None, 1.0)], "a double, b double")
    close = [r[0] for r in df.select(is_close(F.col("a"), F.col("b"))).collect()]
    assert close == [True, False, None]


def test_cents_are_those_of_exact_formatting(spark):
    import random

    random.seed(7)
    values = [random.uniform(-1, 1) * 10 ** random.randint(-6, 14) for _ in range(3000)]
    values += [n / 8 for n in range(-200, 200)] + [n / 1000 for n in range(3000)] + [1e-300, 2.0**52]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    wrong = [r for r in df.select("x", fixed2(F.col("x")).alias("t")).collect() if r.t != f"{r.x:.2f}"]
    assert [r for r in wrong if r.x != 0 or r.t != "0.00"] == []


def test_numbers_that_are_not_finite_are_close_to_nothing_and_no_rates(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(nan, nan), (inf, inf), (1.0, nan)], "a double, b double")
    assert [r[0] for r in df.select(is_close(F.col("a"), F.col("b"))).collect()] == [False] * 3
    raw = spark.createDataFrame(
        [("USD", "EUR", r, "2024-01-05", "2024-01-06") for r in ("NaN", "Infinity", "2")],
        "currency string, base string, rate string, valid_from string, valid_to string",
    )
    assert sorted(str(r.rate) for r in typed(raw, RATES).collect()) == ["2.0", "None", "None"]
