import pytest
from pyspark.sql import functions as F

from outlay.operators import quality
from outlay.plans.daily_spend import spend_audit
from tests.frames import accounts, costs, rates, rows

TEXT = "customer_id string, segments_date string, campaign_id string, metrics_cost_micros string, last_extracted_at string"
GOOD = ("1", "2024-01-01", "x", "10", "2024-01-02T10:00:00Z")


def text_costs(spark, *data):
    return spark.createDataFrame(list(data), TEXT)


def text_rates(spark, *values):
    return spark.createDataFrame(
        [("USD", "EUR", v, "2024-01-01", "2024-01-31") for v in values],
        "currency string, base string, rate string, valid_from string, valid_to string",
    )


def checks(report):
    return {r["check"]: (r["passed"], r["n_bad"]) for r in report.collect()}


def test_costs_summary(spark):
    df = text_costs(
        spark, GOOD, (None, "2024-01-01", "x", "10", "now"), ("1", "abc", "x", "ten", None)
    )
    assert quality.costs_summary(df).first().asDict() == {
        "n_rows": 3,
        "n_null_customer_id": 1,
        "n_bad_segments_date": 1,
        "n_bad_cost": 1,
        "n_bad_last_extracted_at": 2,
    }


def test_rates_and_accounts_summary(spark):
    row = quality.rates_summary(text_rates(spark, "1.2", "abc", None, "0", "0.0")).first()
    assert tuple(row) == (5, 2, 2, 0, 0)
    odd = quality.rates_summary(text_rates(spark, "NaN", "-Infinity", "-2", "1")).first()
    assert tuple(odd) == (4, 0, 0, 2, 1)
    assert tuple(quality.accounts_summary(accounts(spark, ("1", "EUR"), (None, "EUR"))).first()) == (2, 1)


def test_orphans(spark):
    c = costs(spark, (1, "a", "x", 1), (1, "b", "x", 1), (2, "b", "x", 1), (1, None, "x", 1))
    assert rows(quality.orphan_customers(c, accounts(spark, ("a", "EUR")))) == [("b",), (None,)]
    assert rows(quality.orphan_customers(c, accounts(spark, ("a", "EUR"), (None, "EUR")))) == [("b",), (None,)]
    assert rows(quality.orphan_customers_except(c, accounts(spark, ("a", "EUR")))) == [("b",), (None,)]
    assert rows(quality.orphan_customers_except(c, accounts(spark, ("a", "EUR"), (None, "EUR")))) == [("b",)]


def test_duplicates_as_groups_and_as_rows(spark):
    c = costs(
        spark,
        (1, "a", "x", 1, 3),
        (1, "a", "x", 2, 3),
        (1, "a", "x", 2, 4),
        (1, None, "x", 5),
        (1, None, "x", 6),
        (2, "a", "x", 1),
    )
    assert rows(quality.duplicate_groups(c), "customer_id", "n") == [("a", 2), (None, 2)]
    flagged = quality.flag_duplicates(c)
    assert rows(flagged, "src_ord", "is_duplicate") == [
        (0, True), (1, True), (2, False), (3, True), (4, True), (5, False),
    ]


def constant_rate_audit(spark, n=2000):
    c = costs(spark, *[(1, "u", f"c{i}", 1_000_003 * (i + 1)) for i in range(n)])
    return spend_audit(c, accounts(spark, ("u", "USD")), rates(spark, ("USD", "EUR", 1.0837, 1, 31)))


def test_long_group_at_one_rate_is_close(spark):
    assert quality.cost_mismatches(constant_rate_audit(spark)).count() == 0


def test_absolute_tolerance_judges_by_size_of_the_difference(spark):
    audit = constant_rate_audit(spark, 5).withColumn("total_spend_eur", F.col("total_spend_eur") + 0.01)
    assert quality.cost_mismatches(audit).count() == 0
    assert quality.cost_mismatches(audit, rtol=0.0, atol=1e-5).count() == 1


def test_mixed_currencies_mismatch_but_are_not_reported(spark):
    c = costs(spark, (1, "e", "x", 100), (1, "u", "x", 300))
    audit = spend_audit(c, accounts(spark, ("e", "EUR"), ("u", "USD")), rates(spark, ("USD", "EUR", 2.0, 1, 31)))
    assert quality.cost_mismatches(audit).count() == 1
    assert quality.single_currency(audit).count() == 0
    assert checks(quality.output_report(audit))["spend_matches_cost_over_rate"] == (True, 0)


def test_output_report(spark):
    groups = [
        (5.0, 10, 2.0, "USD", 1, 0, 2.0, 2.0),
        (6.0, 10, 2.0, "USD", 1, 0, 2.0, 2.0),
        (7.5, 20, 3.0, "USD", 1, 0, 2.0, 4.0),  # two rates: not comparable
        (float("nan"), 10, 2.0, "USD", 1, 0, 2.0, 2.0),
        (None, 10, None, "SEK", 1, 1, None, None),
        (5.0, 10, 2.0, "EUR", 1, 0, 2.0, 2.0),
        (1.0, 1, None, None, 0, 0, None, None),
    ]
    audit = spark.createDataFrame(
        groups,
        "total_spend_eur double, total_metrics_cost bigint, rate double, currency string, "
        "n_currencies bigint, n_missing_rate bigint, least_rate double, greatest_rate double",
    )
    assert checks(quality.output_report(audit)) == {
        "spend_matches_cost_over_rate": (False, 2),
        "spend_has_no_missing_rate": (False, 1),
        "spend_eur_rate_is_one": (False, 1),
    }
    assert quality.eur_rate_not_one(audit).count() == 1
    empty = checks(quality.output_report(audit.filter("false")))
    assert set(empty.values()) == {(True, 0)}


def test_input_report_and_enforce(spark):
    good = quality.input_report(text_costs(spark, GOOD, GOOD), accounts(spark, ("1", "EUR")), text_rates(spark, "1.2"))
    found = checks(good)
    assert all(passed for passed, _ in found.values())
    assert found["costs_duplicate_groups"] == (True, 1) and found["costs_duplicate_rows"] == (True, 2)
    quality.enforce(good)

    bad = quality.input_report(text_costs(spark, GOOD), accounts(spark, ("2", "EUR")), text_rates(spark, "abc"))
    with pytest.raises(quality.QualityError, match=r"rates_rate_is_numeric \(1\)") as error:
        quality.enforce(bad)
    assert "costs_customers_have_accounts (1)" in str(error.value)
    quality.enforce(bad, ignore=("rates_rate_is_numeric", "costs_customers_have_accounts"))


def test_absent_columns_fail_without_running_the_checks_that_need_them(spark):
    report = quality.input_report(
        text_costs(spark, GOOD).drop("customer_id"),
        accounts(spark, ("1", "EUR")).drop("currency", "account_id"),
        text_rates(spark, "1"),
    )
    found = checks(report)
    assert found["costs_columns_present"] == (False, 1)
    assert found["accounts_columns_present"] == (False, 2)
    assert "costs_customers_have_accounts" not in found and "rates_rate_is_numeric" in found


def test_findings_name_all_that_is_wrong_with_a_row(spark):
    df = text_costs(
        spark, GOOD, ("9", "soon", "x", "ten", "never"), (None, *GOOD[1:]), ("9", *GOOD[1:]), ("2", *GOOD[1:])
    )
    known = accounts(spark, ("1", "EUR"), ("1", "USD"), ("2", "EUR"), (None, "EUR"))
    found = quality.with_findings(df, known)
    assert found.count() == 5  # an account listed twice repeats no cost
    good, bad = quality.route(found)
    assert good.columns == df.columns and rows(good) == sorted([GOOD, ("2", *GOOD[1:])])
    no_account = "costs_customers_have_accounts"
    assert rows(bad, "customer_id", "findings", "offending") == sorted([
        ("9", ["costs_segments_date_parses", "costs_cost_is_numeric", "costs_last_extracted_at_parses", no_account],
         ["soon", "ten", "never", "9"]),
        ("9", [no_account], ["9"]),
        (None, ["costs_customer_id_not_null", no_account], [None, None]),
    ], key=repr)


def test_offenders_are_few_and_the_most_frequent(spark):
    rows_of = [(str(i % 40), *GOOD[1:]) for i in range(100)] + [("a", *GOOD[1:])] * 5
    found = quality.with_findings(text_costs(spark, *rows_of), accounts(spark, ("x", "EUR")))
    worst = quality.offenders(found, most=3)
    assert rows(worst, "value", "n") == [("0", 3), ("1", 3), ("a", 5)]


def test_error_names_offending_values(spark):
    df = text_costs(spark, GOOD, *[(i, *GOOD[1:]) for i in ("8", "9", "9")])
    known = accounts(spark, ("1", "EUR"))
    report = quality.input_report(df, known, text_rates(spark, "1"))
    with pytest.raises(quality.QualityError) as error:
        quality.enforce(report, costs=quality.with_findings(df, known))
    assert str(error.value) == "costs_customers_have_accounts (2): '9' 2x; '8' 1x"


def test_counts_taken_while_writing_are_the_same(spark, tmp_path):
    df = text_costs(spark, GOOD, (None, "soon", "x", "ten", None), ("9", *GOOD[1:]))
    known, quotes = accounts(spark, ("1", "EUR")), text_rates(spark, "1", "abc")
    counting, seen = quality.observed(df)
    counting.write.parquet(str(tmp_path / "costs"))
    written = spark.read.parquet(str(tmp_path / "costs"))
    assert checks(quality.input_report(written, known, quotes, seen)) == checks(
        quality.input_report(df, known, quotes)
    )


def test_one_wrong_group_shows(spark):
    key = "segments_date date, domain string, brand string, channel_type string"
    day = costs(spark, (1, "1", "x", 1)).first().segments_date
    one, two = (day, "a", None, "on"), (day, "b", "c", "on")
    priced = spark.createDataFrame([(*one, 1e12), (*one, 5.0), (*two, 7.0), (*two, None)], f"{key}, cost_eur double")

    def n_bad(*groups):
        audit = spark.createDataFrame(groups, f"{key}, total_spend_eur double")
        return quality.groups_report(priced, audit).first().n_bad

    assert n_bad((*one, 1e12 + 5), (*two, 7.0)) == 0
    assert n_bad((*one, 1e12 + 5), (*two, 9.0)) == 1
    assert n_bad((*one, 1e12 + 5)) == 1 and n_bad((*one, 1e12 + 5), (*two, None)) == 1
    assert n_bad((*one, 1e12 + 5), (*two, 7.0), (None, "z", "z", "z", None)) == 1
