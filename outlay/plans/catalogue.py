"""Every query by name: ``(spark, sf_dir) -> DataFrame`` over the whole tables."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from outlay.functions.names import normalize_columns
from outlay.functions.values import fixed2, half_even, typed
from outlay.operators import fx, quality
from outlay.operators.accounts import with_accounts
from outlay.operators.latest import keep_latest_max_by, latest_state, merge_latest
from outlay.operators.ordinals import global_rank, rank_within
from outlay.operators.report import report_lines, spend_report
from outlay.plans.daily_spend import NEWEST, SpendOptions, daily_spend, latest_costs, spend_audit
from outlay.sources import tables
from outlay.sources.files import read_csv
from outlay.sources.schemas import COST_KEY, COSTS, RATES, SPEND_KEY
from outlay.sources.scratch import new_table_path
from outlay.sources.sinks import write_report

Query = Callable[[SparkSession, str], DataFrame]


def _inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tables.costs(spark, sf_dir), tables.accounts(spark, sf_dir), tables.rates(spark, sf_dir)


def _cents(df: DataFrame, *columns: str) -> DataFrame:
    """Round sums of doubles, whose last digits depend on the order of addition."""
    return df.withColumns({c: F.round(c, 2) for c in columns})


def _spend(options: SpendOptions = SpendOptions()) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _cents(daily_spend(*_inputs(spark, sf_dir), options), "total_spend_eur")

    return query


def daily_spend_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals as they are, to the last digit."""
    return daily_spend(*_inputs(spark, sf_dir), SpendOptions(exact=True))


def _audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spend_audit(*_inputs(spark, sf_dir))


def daily_spend_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cents(_audit(spark, sf_dir), "total_spend_eur").withColumn("rate", F.round("rate", 9))


# --- sources and typing ---------------------------------------------------------------------


def _costs_csv(spark: SparkSession, text: DataFrame) -> str:
    """Write costs the way exports look: upper-case headers, one of them padded."""
    path = new_table_path(spark, "costs-csv")
    names = [c.upper() for c in text.columns]
    names[0] = f" {names[0]} "
    text.toDF(*names).write.option("header", True).csv(path)
    return path


def _typed_costs(text: DataFrame) -> DataFrame:
    """Typed costs; the extraction time as epoch seconds, free of any time zone.

    Both numbers can be NULL here and leave as DOUBLE, which data frames on either side of a
    comparison represent alike.
    """
    return typed(text, COSTS, keep=("event_id",)).withColumns(
        {
            "metrics_cost_micros": F.col("metrics_cost_micros").cast("double"),
            "last_extracted_at": F.unix_seconds("last_extracted_at").cast("double"),
            "segments_date": F.col("segments_date").cast("date"),
        }
    )


def _numbered(text: DataFrame) -> DataFrame:
    return text.withColumnRenamed("src_ord", "event_id")


def scan_csv_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _costs_csv(spark, _numbered(tables.costs_text(spark, sf_dir)))
    return _typed_costs(read_csv(spark, path)).withColumn(
        "event_id", F.col("event_id").cast("bigint")
    )


def scan_csv_na_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text columns, where ``n/a`` counts as missing and ``unknown`` does not."""
    path = _costs_csv(spark, _numbered(tables.costs_text(spark, sf_dir)))
    return read_csv(spark, path, na_tokens=True).select(
        F.col("event_id").cast("bigint").alias("event_id"),
        "segments_date",
        "customer_id",
        "metrics_cost_micros",
    )


def scan_csv_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of one folder with their columns in two orders and two spellings."""
    text = _numbered(tables.costs_text(spark, sf_dir))
    path = _costs_csv(spark, text.where("event_id % 2 = 0"))
    other = text.where("event_id % 2 = 1").select(*reversed(text.columns))
    names = [c.title().replace("_", " ") for c in other.columns]
    other.toDF(*names).write.option("header", True).mode("append").csv(path)
    return _typed_costs(read_csv(spark, path, mixed_headers=True)).withColumn(
        "event_id", F.col("event_id").cast("bigint")
    )


def normalized_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = tables.load(spark, sf_dir, "events").select(
        F.col("event_id").alias(" Event Id "),
        F.col("user_id").alias("USER_ID"),
        F.col("event_type").alias("Event Type"),
        F.col("value").alias("value "),
    )
    return normalize_columns(raw)


def preprocess_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _typed_costs(_numbered(tables.costs_text(spark, sf_dir)))


def preprocess_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed(tables.rates_text(spark, sf_dir), RATES, keep=("src_ord",))


# --- ordinals and de-duplication ------------------------------------------------------------


def row_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    costs = tables.costs(spark, sf_dir).select("src_ord", "customer_id", "metrics_cost_micros")
    return global_rank(costs, [F.col("src_ord").asc()], "row_ordinal", start=0)


def extraction_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    costs = tables.costs(spark, sf_dir).select(*COST_KEY, *NEWEST)
    newest = [F.col(c).desc_nulls_last() for c in NEWEST]
    return rank_within(costs, COST_KEY, newest, "extraction_rank").drop("last_extracted_at")


def keep_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_costs(tables.costs(spark, sf_dir)).drop("last_extracted_at")


def keep_latest_by_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    costs = tables.costs(spark, sf_dir)
    return keep_latest_max_by(costs, COST_KEY, NEWEST).drop("last_extracted_at")


def keep_latest_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest of one half of the extractions, kept as a state, with the other half merged in."""
    costs = tables.costs(spark, sf_dir)
    state = latest_state(latest_costs(costs.where("src_ord % 2 = 0")), COST_KEY, buckets=8)
    merged = merge_latest(state, costs.where("src_ord % 2 = 1"), COST_KEY, NEWEST)
    return merged.drop("last_extracted_at")


# --- joins and conversion -------------------------------------------------------------------


def costs_with_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    costs = latest_costs(tables.costs(spark, sf_dir)).drop("last_extracted_at")
    return with_accounts(costs, tables.accounts(spark, sf_dir))


def _in_currency(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, Column]:
    """Latest costs with their currency, the quotes, and the days."""
    costs, accounts, rates = _inputs(spark, sf_dir)
    priced = with_accounts(
        latest_costs(costs).select(
            "src_ord", "segments_date", "customer_id", "metrics_cost_micros"
        ),
        accounts.select("account_id", "currency"),
    ).drop("account_id")
    return priced, rates, fx.cost_days(costs)


def fx_interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes by day are shuffled, whatever their size."""
    return fx.with_every_rate(*_in_currency(spark, sf_dir), limit=0)


def fx_interval_join_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same result with the other join: quotes by day are measured and sent to all."""
    return fx.with_every_rate(*_in_currency(spark, sf_dir))


def fx_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.with_first_rate(*_in_currency(spark, sf_dir))


def base_currency_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    looked_up = fx_first_match(spark, sf_dir)
    return looked_up.select(
        "src_ord",
        "currency",
        F.col("rate").alias("looked_up_rate"),
        fx.base_rate(F.col("currency"), F.col("rate")).alias("rate"),
    )


def cost_eur(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.with_cost_eur(fx_first_match(spark, sf_dir))


# --- times of day, decimals, many quotes ------------------------------------------------------


def keep_latest_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Costs by hour: the hour is part of the key."""
    costs = _hourly(spark, sf_dir)
    kept = latest_costs(costs).drop("last_extracted_at")
    return kept.withColumn("segments_date", F.col("segments_date").cast("string"))


def _hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tables.load(spark, sf_dir, "events").select(
        "event_id", F.date_trunc("hour", "ts").cast("timestamp").alias("segments_date"),
        F.col("ts").alias("last_extracted_at"),
    )
    costs = tables.costs(spark, sf_dir).drop("segments_date", "last_extracted_at")
    return costs.join(events, costs["src_ord"] == events["event_id"]).drop("event_id")


def spend_decimal_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spend of costs that come as text with two decimals, by hour; rates go by day."""
    text = tables.load(spark, sf_dir, "events").select(
        F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias(
            "segments_date"
        ),
        F.col("user_id").cast("string").alias("customer_id"),
        F.col("event_type").alias("campaign_id"),
        F.concat(tables.micros().cast("string"), F.lit("."),
                 F.lpad((F.col("event_id") % 100).cast("string"), 2, "0"))
        .alias("metrics_cost_micros"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("last_extracted_at"),
        F.col("event_id").alias("src_ord"),
    )
    costs = typed(text, COSTS, keep=("src_ord",))
    _, accounts, rates = _inputs(spark, sf_dir)
    spend = daily_spend(costs, accounts, rates)
    return _cents(spend, "total_spend_eur").withColumn(
        "segments_date", F.col("segments_date").cast("string")
    )


def _many_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed(tables.rates_text(spark, sf_dir), RATES, keep=("src_ord",))


def fx_first_match_many_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One quote per order; the lookup by day is small."""
    priced, _, days = _in_currency(spark, sf_dir)
    return fx.with_first_rate(priced, _many_quotes(spark, sf_dir), days)


def fx_first_match_many_quotes_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the lookup treated as too large to send to all."""
    priced, _, days = _in_currency(spark, sf_dir)
    return fx.with_first_rate(priced, _many_quotes(spark, sf_dir), days, limit=0)


def daily_spend_many_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    costs, accounts, _ = _inputs(spark, sf_dir)
    return _cents(daily_spend(costs, accounts, _many_quotes(spark, sf_dir)), "total_spend_eur")


# --- quality --------------------------------------------------------------------------------


def dq_costs_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.costs_summary(tables.costs_text(spark, sf_dir))


def dq_rates_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rates_summary(tables.rates_text(spark, sf_dir))


def dq_accounts_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.accounts_summary(tables.accounts(spark, sf_dir))


def dq_orphan_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    costs, accounts = tables.costs_text(spark, sf_dir), tables.accounts(spark, sf_dir)
    return quality.orphan_customers(costs, accounts)


def dq_orphan_customers_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    costs, accounts = tables.costs_text(spark, sf_dir), tables.accounts(spark, sf_dir)
    return quality.orphan_customers_except(costs, accounts)


def dq_duplicate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = quality.duplicate_groups(tables.costs(spark, sf_dir))
    return groups.withColumn("last_extracted_at", F.col("last_extracted_at").cast("string"))


def dq_duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = quality.flag_duplicates(tables.costs(spark, sf_dir))
    return flagged.select("src_ord", *COST_KEY, "is_duplicate")


def dq_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Costs that fail a check, with all they fail."""
    found = quality.with_findings(tables.costs_text(spark, sf_dir), tables.accounts(spark, sf_dir))
    _, bad = quality.route(found)
    return bad.select("src_ord", "customer_id", F.array_join("findings", " ").alias("findings"))


def dq_offenders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each check of a cost the values that fail it most often."""
    found = quality.with_findings(tables.costs_text(spark, sf_dir), tables.accounts(spark, sf_dir))
    return quality.offenders(found)


def dq_cost_eur_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mismatching groups; ``comparable`` tells those where the comparison has to hold."""
    mismatches = quality.cost_mismatches(_audit(spark, sf_dir))
    return _cents(mismatches, "total_spend_eur", "expected_spend_eur").select(
        "segments_date",
        "domain",
        "brand",
        "channel_type",
        "total_spend_eur",
        "expected_spend_eur",
        quality.comparable().alias("comparable"),
    )


def dq_single_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups in which cost over rate has to give the spend, with both."""
    audit = quality.single_currency(_audit(spark, sf_dir))
    return _cents(audit, "total_spend_eur").select(*SPEND_KEY, "total_spend_eur", "currency")


def dq_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report's total against that of the rows."""
    return quality.total_report(cost_eur(spark, sf_dir), _audit(spark, sf_dir))


def dq_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every group's spend against that of its rows, in an audit that is spoilt in some places."""
    audit = _audit(spark, sf_dir)
    spoilt = F.when(F.col("total_metrics_cost") % 3 == 0, F.col("total_spend_eur") + 1e5)
    rows = with_accounts(
        latest_costs(tables.costs(spark, sf_dir)), tables.accounts(spark, sf_dir)
    )
    priced = fx.with_cost_eur(fx.with_first_rate(rows, tables.rates(spark, sf_dir)))
    return quality.groups_report(
        priced, audit.withColumn("total_spend_eur", F.coalesce(spoilt, F.col("total_spend_eur")))
    )


def dq_eur_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups in EUR whose rate is not 1, in an audit whose EUR rates are spoilt in some places."""
    audit = _audit(spark, sf_dir)
    spoilt = F.when(F.col("total_metrics_cost") % 3 == 0, F.col("rate") + 1.0)
    found = quality.eur_rate_not_one(
        audit.withColumn("rate", F.coalesce(spoilt, F.col("rate")))
    )
    return found.select(*SPEND_KEY, F.round("rate", 9).alias("rate"))


def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = quality.input_report(
        tables.costs_text(spark, sf_dir),
        tables.accounts(spark, sf_dir),
        tables.rates_text(spark, sf_dir),
    )
    return inputs.unionByName(quality.output_report(_audit(spark, sf_dir)))


# --- report ---------------------------------------------------------------------------------


def daily_spend_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spend_report(_spend()(spark, sf_dir))


def daily_spend_report_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A written report whose odd days were written again, with amounts ten times as high."""
    spend = _spend()(spark, sf_dir)
    path = new_table_path(spark, "report")
    write_report(spend_report(spend), path, "parquet")
    again = spend.where(F.dayofmonth("segments_date") % 2 == 1).withColumn(
        "total_spend_eur", F.col("total_spend_eur") * 10
    )
    write_report(spend_report(again), path, "parquet", keep_other_days=True)
    schema = "rank bigint, country string, brand string, channel_type string, total_spend_eur string"
    back = spark.read.schema(f"{schema}, segments_date string").parquet(path)
    return back.drop("rank")


def report_rank_text_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spend_report(_spend()(spark, sf_dir), text_order=True, number=half_even)


def spend_text_half_even(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts rounded to tenths first, so that exact ties occur and show the rule."""
    costs = tables.costs(spark, sf_dir)
    tenths = F.round(F.col("metrics_cost_micros") / F.lit(100000.0), 1)
    return costs.select("src_ord", tenths.alias("amount")).withColumn(
        "amount_text", half_even(F.col("amount"))
    )


def spend_text_cents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts in eighths, so that every other one is a tie between two cents."""
    eighths = (F.col("metrics_cost_micros") % 1000003).cast("double") / F.lit(8.0)
    costs = tables.costs(spark, sf_dir).select("src_ord", eighths.alias("amount"))
    return costs.withColumn("amount_text", fixed2(F.col("amount")))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report_lines(daily_spend_report(spark, sf_dir))


def queries() -> dict[str, Query]:
    return {
        "daily_spend": _spend(),
        "daily_spend_exact": daily_spend_exact,
        "daily_spend_audit": daily_spend_audit,
        "daily_spend_all_matches": _spend(SpendOptions(every_match=True)),
        "daily_spend_drop_null_keys": _spend(SpendOptions(drop_null_keys=True)),
        "daily_spend_zero_fill": _spend(SpendOptions(zero_fill=True)),
        "scan_csv_typed": scan_csv_typed,
        "scan_csv_na_tokens": scan_csv_na_tokens,
        "scan_csv_mixed_headers": scan_csv_mixed_headers,
        "normalize_columns": normalized_columns,
        "preprocess_costs": preprocess_costs,
        "preprocess_rates": preprocess_rates,
        "row_ordinal": row_ordinal,
        "extraction_rank": extraction_rank,
        "keep_latest": keep_latest,
        "keep_latest_max_by": keep_latest_by_aggregate,
        "keep_latest_incremental": keep_latest_incremental,
        "costs_with_accounts": costs_with_accounts,
        "fx_interval_join": fx_interval_join,
        "fx_interval_join_broadcast": fx_interval_join_broadcast,
        "fx_first_match": fx_first_match,
        "base_currency_rate": base_currency_rate,
        "cost_eur": cost_eur,
        "dq_costs_summary": dq_costs_summary,
        "dq_rates_summary": dq_rates_summary,
        "dq_accounts_summary": dq_accounts_summary,
        "dq_orphan_customers": dq_orphan_customers,
        "dq_orphan_customers_except": dq_orphan_customers_except,
        "dq_duplicate_groups": dq_duplicate_groups,
        "dq_duplicate_rows": dq_duplicate_rows,
        "dq_cost_eur_mismatch": dq_cost_eur_mismatch,
        "dq_eur_rate": dq_eur_rate,
        "dq_quarantine": dq_quarantine,
        "dq_offenders": dq_offenders,
        "dq_report": dq_report,
        "dq_single_currency": dq_single_currency,
        "dq_total": dq_total,
        "dq_groups": dq_groups,
        "spend_text_cents": spend_text_cents,
        "keep_latest_hourly": keep_latest_hourly,
        "spend_decimal_costs": spend_decimal_costs,
        "fx_first_match_many_quotes": fx_first_match_many_quotes,
        "fx_first_match_many_quotes_shuffled": fx_first_match_many_quotes_shuffled,
        "daily_spend_many_quotes": daily_spend_many_quotes,
        "daily_spend_report": daily_spend_report,
        "daily_spend_report_by_day": daily_spend_report_by_day,
        "report_rank_text_order": report_rank_text_order,
        "spend_text_half_even": spend_text_half_even,
        "report_lines": lines,
    }
