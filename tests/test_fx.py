from datetime import date

import pytest
from pyspark.sql import functions as F

from outlay.operators import fx
from tests.frames import d, rates, rows

ALL = [fx.with_every_rate]
LIMITS = [0, 1 << 20]


def facts(spark, *data):
    return spark.createDataFrame(
        [(i, c, d(day) if day else None, m) for i, (c, day, m) in enumerate(data)],
        "id int, currency string, segments_date date, metrics_cost_micros bigint",
    )


@pytest.mark.parametrize("limit", LIMITS)
@pytest.mark.parametrize("join", [*ALL, fx.with_first_rate])
def test_both_ends_of_the_interval_match(spark, join, limit):
    costs = facts(spark, ("USD", 4, 1), ("USD", 5, 1), ("USD", 9, 1), ("USD", 10, 1))
    found = join(costs, rates(spark, ("USD", "EUR", 1.2, 5, 9)), limit=limit)
    assert rows(found, "id", "rate") == [(0, None), (1, 1.2), (2, 1.2), (3, None)]


@pytest.mark.parametrize("limit", LIMITS)
def test_overlap_first_match_keeps_one_row_all_matches_keeps_both(spark, limit):
    costs = facts(spark, ("BRL", 6, 1), ("BRL", 2, 1))
    quotes = rates(spark, ("BRL", "EUR", 5.0, 1, 7), ("BRL", "EUR", 5.5, 5, 9))
    assert rows(fx.with_first_rate(costs, quotes, limit=limit), "id", "rate") == [(0, 5.0), (1, 5.0)]
    for join in ALL:
        found = join(costs, quotes, limit=limit)
        assert rows(found, "id", "rate") == [(0, 5.0), (0, 5.5), (1, 5.0)]
        assert rows(found, "id", "valid_from")[1] == (0, d(5))


@pytest.mark.parametrize("join", [*ALL, fx.with_first_rate])
def test_base_currency_wrong_base_and_nulls_match_nothing(spark, join):
    costs = facts(spark, ("EUR", 3, 1), ("USD", 3, 1), (None, 3, 1), ("GBP", None, 1), ("SEK", 3, 1))
    quotes = rates(
        spark,
        ("EUR", "EUR", 1.0, 1, 9),
        ("EUR", "EUR", 1.0, 2, 8),
        ("USD", "GBP", 1.3, 1, 9),
        (None, "EUR", 9.0, 1, 9),
        ("GBP", "EUR", 0.9, 1, 9),
        ("SEK", "EUR", 11.0, None, 9),
    )
    assert rows(join(costs, quotes), "id", "rate") == [(i, None) for i in range(5)]


def test_first_quote_counts_even_without_a_rate(spark):
    costs = facts(spark, ("USD", 3, 1))
    quotes = rates(spark, ("USD", "EUR", None, 1, 9), ("USD", "EUR", 1.1, 1, 9))
    assert rows(fx.with_first_rate(costs, quotes), "rate") == [(None,)]


@pytest.mark.parametrize("join", [*ALL, fx.with_first_rate])
def test_open_ended_and_backward_intervals(spark, join):
    costs = facts(spark, ("USD", 3, 1), ("GBP", 3, 1))
    quotes = rates(
        spark,
        ("USD", "EUR", 1.1, date(1, 1, 1), date(9999, 12, 31)),
        ("GBP", "EUR", 0.9, 9, 1),
    )
    assert rows(join(costs, quotes), "id", "rate") == [(0, 1.1), (1, None)]


def test_open_ended_intervals_unroll_to_the_days_of_the_costs_only(spark):
    costs = facts(spark, ("USD", 3, 1), ("USD", 5, 1))
    quotes = rates(spark, ("USD", "EUR", 1.1, date(1, 1, 1), date(9999, 12, 31)))
    assert fx.quotes_by_day(quotes, fx.cost_days(costs)).count() == 2


@pytest.mark.parametrize("join", [*ALL, fx.with_first_rate])
def test_no_costs_at_all(spark, join):
    assert join(facts(spark, ("USD", 1, 1)).filter("id < 0"), rates(spark, ("USD", "EUR", 1.1, 1, 9))).count() == 0


def test_cost_eur(spark):
    costs = facts(spark, ("EUR", 3, 5), ("USD", 3, 6), ("GBP", 3, 7), ("SEK", 3, 8), ("USD", 3, None))
    quotes = rates(
        spark, ("EUR", "EUR", 2.0, 1, 9), ("USD", "EUR", 1.2, 1, 9), ("GBP", "EUR", 0.0, 1, 9)
    )
    priced = fx.with_cost_eur(fx.with_first_rate(costs, quotes))
    assert rows(priced, "id", "rate", "cost_eur") == [
        (0, 1.0, 5.0),
        (1, 1.2, 6 / 1.2),
        (2, 0.0, None),
        (3, None, None),
        (4, 1.2, None),
    ]
    assert dict(priced.dtypes)["cost_eur"] == "double"


def test_work_of_a_quote_grows_with_its_own_days(spark):
    """A hundred years of days: quotes of three days reach into two months at most."""
    costs = spark.range(36_525).select(
        F.lit("USD").alias("currency"), F.date_add(F.lit(d(1)), F.col("id").cast("int")).alias("segments_date")
    )
    quotes = spark.range(3000).select(
        F.lit("USD").alias("currency"), F.lit("EUR").alias("base"), F.col("id").cast("double").alias("rate"),
        F.date_add(F.lit(d(1)), (F.col("id") * 12).cast("int")).alias("valid_from"),
        F.date_add(F.lit(d(1)), (F.col("id") * 12 + 2).cast("int")).alias("valid_to"),
        F.col("id").alias("src_ord"),
    )
    days = fx.cost_days(costs)
    months = F.array_sort(F.collect_set(fx._month(F.col("segments_date"))))
    reached = fx.quotes_by_month(quotes, costs.agg(months).scalar())
    assert 3000 <= reached.count() <= 6000
    by_day = fx.quotes_by_day(quotes, days)
    assert by_day.count() == 9000
    assert by_day.where("quote_day < valid_from or quote_day > valid_to").count() == 0
    text = by_day._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_wrong_dates_far_off_do_not_unroll_what_lies_between(spark):
    costs = spark.createDataFrame(
        [(0, "USD", date(1, 1, 1), 1), (1, "USD", d(3), 1), (2, "USD", date(9999, 12, 31), 1)],
        "id int, currency string, segments_date date, metrics_cost_micros bigint",
    )
    quotes = rates(spark, *[("USD", "EUR", 1.0 + i, date(1, 1, 1), date(9999, 12, 31)) for i in range(5)])
    assert fx.quotes_by_day(quotes, fx.cost_days(costs)).count() == 15
    assert rows(fx.with_first_rate(costs, quotes), "id", "rate") == [(i, 1.0) for i in range(3)]
