"""What the physical plans have to look like, whatever the data."""

import pytest
from pyspark.sql import functions as F

from outlay.operators import fx, quality
from outlay.operators.accounts import with_accounts
from outlay.operators.joins import fits_broadcast, measured_bytes
from outlay.operators.latest import keep_latest_max_by, latest_state, merge_latest
from outlay.plans import catalogue
from outlay.plans.daily_spend import NEWEST, SpendOptions, daily_spend, latest_costs
from outlay.sources import tables
from outlay.sources.schemas import COST_KEY
from tests.frames import accounts, at, d, rates

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(conf):
    """Every table counts as large, every partition above 20 kB as skewed."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20000",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20000",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    )


def hot_costs(spark, n=200_000):
    """A third of all rows in one customer, campaign, day and hour."""
    hot = F.col("id") % 3 == 0
    return spark.range(n, numPartitions=8).select(
        F.when(hot, F.lit(d(3)))
        .otherwise(F.date_add(F.lit(d(1)), (F.col("id") % 7).cast("int")))
        .alias("segments_date"),
        F.when(hot, "hot").otherwise((F.col("id") % 500).cast("string")).alias("customer_id"),
        F.when(hot, "x").otherwise((F.col("id") % 11).cast("string")).alias("campaign_id"),
        F.abs(F.xxhash64("id") % 1000).alias("metrics_cost_micros"),
        F.lit(at(5)).cast("timestamp_ntz").alias("last_extracted_at"),
        F.col("id").alias("src_ord"),
    )


def finished(df):
    """The plan after adaptive execution; the aggregate keeps all rows in play."""
    total = df.groupBy("src_ord").agg(*[F.max(c).alias(c) for c in df.columns if c != "src_ord"])
    total.collect()
    return plan(total)


def test_latest_is_trimmed_before_the_shuffle(spark):
    text = plan(latest_costs(tables.costs(spark, SF)))
    assert "row_number(), 1, Partial" in text and "row_number(), 1, Final" in text
    assert text.count("Exchange hashpartitioning") == 1


def test_latest_trims_a_hot_key_to_one_row_per_task(spark):
    kept = latest_costs(hot_costs(spark))
    rows = kept.collect()
    metrics = [r for r in rows if r.customer_id == "hot"]
    assert [r.src_ord for r in metrics] == [199_998]


def test_aggregate_form_combines_before_the_shuffle(spark):
    text = plan(keep_latest_max_by(tables.costs(spark, SF), COST_KEY, NEWEST))
    assert "partial_max_by" in text


def test_flagship_broadcasts_small_sides_and_shuffles_costs_once(spark):
    text = plan(catalogue.queries()["daily_spend"](spark, SF))
    assert "BroadcastHashJoin [customer_id" in text and "CartesianProduct" not in text
    assert "NestedLoop" not in text and "Python" not in text
    assert text.count("Exchange hashpartitioning(campaign_id") == 1
    # Only the columns in use are read.
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint" in text
    assert "props" not in text and "c_name" not in text and "o_totalprice" not in text


def test_public_spend_prunes_the_audit_columns(spark):
    text = plan(catalogue.queries()["daily_spend"](spark, SF))
    assert "avg(" not in text and "currency, currency" not in text
    assert "min(_first" not in text and "sum(_rows" not in text


def test_rates_are_looked_up_after_the_first_sum(spark):
    text = plan(daily_spend(*catalogue._inputs(spark, SF)))
    join = text.index("unix_date(segments_date")
    assert text.index("partial_sum(_micros", join) > join  # deeper in the tree: runs earlier


def test_large_accounts_meet_costs_summed_per_customer_and_day(spark, no_broadcast):
    inputs = catalogue._inputs(spark, SF)
    large = daily_spend(*inputs, limit=0)
    text = plan(large)
    assert "HashAggregate(keys=[segments_date" in text
    assert "SortMergeJoin [customer_id" in text
    small = daily_spend(*inputs)
    assert _rounded(large) == _rounded(small)


def _rounded(df):
    return sorted(map(str, df.withColumn("total_spend_eur", F.round("total_spend_eur", 2)).collect()))


def test_hot_customer_is_split_when_accounts_are_large(spark, no_broadcast):
    acc = accounts(spark, ("hot", "USD"), ("7", "EUR"))
    joined = with_accounts(hot_costs(spark), acc, limit=0)
    assert "SortMergeJoin(skew=true)" in finished(joined)
    assert joined.filter("account_id = 'hot'").count() == 66_667


@pytest.mark.parametrize("lookup", [fx.with_first_rate, fx.with_every_rate])
def test_hot_currency_and_day_is_split_when_rates_are_large(spark, no_broadcast, lookup):
    costs = hot_costs(spark).withColumnRenamed("customer_id", "currency")
    quotes = rates(spark, ("hot", "EUR", 1.2, 1, 9), ("7", "EUR", 3.0, 1, 9))
    priced = lookup(costs, quotes, limit=0)
    assert "SortMergeJoin(skew=true)" in finished(priced)
    assert priced.filter("currency = 'hot' and rate = 1.2").count() == 66_667


def test_copies_of_a_hot_key_are_split(spark, no_broadcast):
    flagged = quality.flag_duplicates(hot_costs(spark))
    assert "SortMergeJoin(skew=true)" in finished(flagged)
    assert "Window" not in plan(flagged)
    assert flagged.filter("is_duplicate and customer_id = 'hot'").count() == 66_667


@pytest.mark.parametrize("options", [SpendOptions(), SpendOptions(every_match=True)])
def test_unrolled_quotes_are_broadcast_if_measured_small(spark, conf, options):
    conf(spark__sql__autoBroadcastJoinThreshold="1g")
    inputs = catalogue._inputs(spark, SF)
    small, large = daily_spend(*inputs, options), daily_spend(*inputs, options, limit=0)
    assert "BroadcastHashJoin [currency" in plan(small)
    assert "SortMergeJoin [currency" in plan(large)
    assert plan(small).count("Exchange hashpartitioning") <= 5
    assert _rounded(small) == _rounded(large)


def test_both_forms_of_the_interval_join(spark):
    queries = catalogue.queries()
    assert "BroadcastHashJoin [currency" in plan(queries["fx_interval_join_broadcast"](spark, SF))
    assert "SortMergeJoin [currency" in plan(queries["fx_interval_join"](spark, SF))


def test_lookups_are_computed_once(spark):
    """What is joined is the table that was written and measured, not what it was made from."""
    made = spark.range(100).groupBy((F.col("id") % 7).cast("string").alias("account_id")).count()
    text = plan(with_accounts(hot_costs(spark), made))
    assert "/lookup-" in text and "Aggregate" not in text and "BroadcastHashJoin" in text
    assert "/lookup-" not in plan(with_accounts(hot_costs(spark), made, limit=0))


def test_costs_are_read_once_for_the_input_checks(spark):
    report = quality.input_report(
        tables.costs_text(spark, SF), tables.accounts(spark, SF), tables.rates_text(spark, SF)
    )
    assert "events.parquet" not in plan(report)  # what is left reads the costs by key
    assert plan(catalogue.dq_report(spark, SF)).count("events.parquet") <= 2


def test_state_is_merged_without_a_shuffle_of_its_own(spark, no_broadcast):
    costs = tables.costs(spark, SF)
    state = latest_state(latest_costs(costs.where("src_ord % 2 = 0")), COST_KEY, buckets=4)
    merged = merge_latest(state, costs.where("src_ord % 2 = 1"), COST_KEY, NEWEST)
    text = plan(merged)
    assert "Bucketed: true" in text and "SortMergeJoin" in text
    side = text[: text.index("Bucketed: true")]
    assert "Exchange" not in side[side.index("SortMergeJoin") :]
    assert text.count("Exchange hashpartitioning") == 2  # of the new rows: by key, then by bucket


def test_size_check(spark):
    df = spark.createDataFrame([("abcd", 1), (None, 2)], "a string, n int")
    assert measured_bytes(df) == 2 * 2 * 16 + 4
    assert fits_broadcast(df, 68) and not fits_broadcast(df, 67) and not fits_broadcast(df, 0)
    assert measured_bytes(df.filter("n > 5")) == 0


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_no_query_leaves_the_jvm_or_crosses(spark, name):
    text = plan(catalogue.queries()[name](spark, SF))
    for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text
