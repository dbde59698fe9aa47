"""Counts and totals known from an independent calculation over the same tables.

The inputs here differ from those of the queries: a fixed list of quotes, and accounts with gaps.
"""

import pytest
from pyspark.sql import functions as F

from outlay.operators import fx, quality
from outlay.operators.accounts import with_accounts
from outlay.plans.daily_spend import SpendOptions, daily_spend, latest_costs, spend_audit
from outlay.sources import tables
from tests.frames import rates as quotes

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def costs(spark):
    return tables.costs(spark, SF)


@pytest.fixture(scope="module")
def accounts(spark):
    customer = tables.load(spark, SF, "customer").filter(F.col("c_custkey") % 10 != 7)
    nation, region = tables.load(spark, SF, "nation"), tables.load(spark, SF, "region")
    return (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("c_custkey").cast("string").alias("account_id"),
            tables._currency("c_custkey").alias("currency"),
            F.col("r_name").alias("channel_type"),
            F.nullif("c_mktsegment", F.lit("FURNITURE")).alias("brand"),
            F.col("n_name").alias("domain"),
        )
    )


@pytest.fixture(scope="module")
def rates(spark):
    return quotes(
        spark,
        ("USD", "EUR", 1.1, 1, 31),
        ("BRL", "EUR", 5.0, 1, 20),
        ("BRL", "EUR", 5.5, 15, 31),
        ("GBP", "EUR", 0.85, 1, 10),
        ("GBP", "EUR", 0.86, 16, 31),
        ("USD", "GBP", 1.3, 1, 31),
        ("EUR", "EUR", 1.0, 1, 31),
    )


def test_duplicates_and_latest(costs):
    assert costs.count() == 1000
    assert quality.duplicate_groups(costs).count() == 6
    latest = latest_costs(costs)
    assert latest.count() == 792
    assert latest.agg(F.sum("metrics_cost_micros")).first()[0] == 39_408_740_000


def test_orphans(costs, accounts):
    assert quality.orphan_customers(costs, accounts).count() == 1
    joined = with_accounts(latest_costs(costs), accounts)
    assert joined.filter("account_id is null").count() == 60


def test_conversion(costs, accounts, rates):
    joined = with_accounts(latest_costs(costs), accounts)
    first = fx.with_cost_eur(fx.with_first_rate(joined, rates))
    every = fx.with_cost_eur(fx.with_every_rate(joined, rates))
    assert (first.count(), every.count()) == (792, 816)
    assert first.agg(F.sum("cost_eur")).first()[0] == pytest.approx(23_073_543_990.55, abs=0.05)
    assert every.agg(F.sum("cost_eur")).first()[0] == pytest.approx(23_258_869_445.09, abs=0.05)
    assert first.filter("rate is null").count() == 254


def test_spend(costs, accounts, rates):
    audit = spend_audit(costs, accounts, rates)
    assert audit.count() == 373
    assert audit.filter("total_spend_eur is null").count() == 97
    assert audit.filter("n_currencies > 1").count() == 24
    assert quality.cost_mismatches(audit).count() == 24
    assert audit.agg(F.sum("total_spend_eur")).first()[0] == pytest.approx(23_073_543_990.55, abs=0.05)
    every = daily_spend(costs, accounts, rates, SpendOptions(every_match=True))
    assert every.agg(F.sum("total_spend_eur")).first()[0] == pytest.approx(23_258_869_445.09, abs=0.05)
    dropped = daily_spend(costs, accounts, rates, SpendOptions(drop_null_keys=True))
    assert dropped.count() == 263
