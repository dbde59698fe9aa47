"""From three CSV inputs to the written report, with quality gates before and after."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outlay.functions.values import fixed2, half_even, typed
from outlay.operators import fx, quality
from outlay.operators.accounts import with_accounts
from outlay.operators.report import report_lines, spend_report
from outlay.operators.spend import public_spend
from outlay.plans.daily_spend import SpendOptions, latest_costs, spend_audit
from outlay.sources.files import ORDINAL, read_csv
from outlay.sources.schemas import ACCOUNTS, COSTS, RATES, SPEND_KEY
from outlay.sources.scratch import shared_dir, staged
from outlay.sources.sinks import write_lines, write_report

# Output checks that only inform by default: a missing rate shows as a NULL total.
INFORMATIVE = ("spend_has_no_missing_rate",)


@dataclass(frozen=True)
class ReportStyle:
    """``text_order`` and ``half_even`` follow reports that turn amounts into text first."""

    text_order: bool = False
    half_even: bool = False
    date_format: str = "yyyy-MM-dd"


@dataclass(frozen=True)
class Outcome:
    spend: DataFrame
    audit: DataFrame
    checks: DataFrame


def run(
    spark: SparkSession,
    costs_path: str | list[str],
    accounts_path: str | list[str],
    rates_path: str | list[str],
    options: SpendOptions = SpendOptions(),
    na_tokens: bool = False,
    gate: bool = True,
    ignore: tuple[str, ...] = INFORMATIVE,
    line_breaks: bool = False,
    mixed_headers: bool = False,
    quarantine: str | None = None,
    days_as: str | None = None,
) -> Outcome:
    """Read, check, compute, check again. With ``gate`` a failed check raises ``QualityError``, which
    names the values that most costs fail by.

    With ``quarantine``, a folder, costs that fail a check are written there with their reasons, and
    the run goes on with the others. ``days_as`` (``date``, ``timestamp``) fixes the type of the
    report's days; else it is ``date`` unless a cost has a time of day.

    Bare dates and times are read in the session time zone, which should be UTC. Each CSV is parsed
    once, to Parquet in the shared folder: the checks and the plan then read only their columns.
    Inside :func:`outlay.sources.scratch.scope` those tables go when the scope ends; the outcome is
    checkpointed by then and needs none of them.
    """
    reading = {"na_tokens": na_tokens, "line_breaks": line_breaks, "mixed_headers": mixed_headers}
    raw_accounts = staged(read_csv(spark, accounts_path, **reading), "accounts")
    raw_rates = staged(read_csv(spark, rates_path, **reading), "rates")
    raw_costs = read_csv(spark, costs_path, **reading)
    seen = None
    findable = "customer_id" in raw_costs.columns and "account_id" in raw_accounts.columns
    if quarantine and findable:
        raw_costs, _ = quality.route(quality.with_findings(raw_costs, raw_accounts), quarantine)
    else:
        # Bad values are counted by the tasks that write the costs.
        raw_costs, seen = quality.observed(raw_costs)
        raw_costs = staged(raw_costs, "costs")

    shared_dir(spark)
    # The reports are a few rows; a checkpoint keeps later looks from running the checks again.
    before = quality.input_report(raw_costs, raw_accounts, raw_rates, seen).checkpoint()
    if gate:
        named = quality.with_findings(raw_costs, raw_accounts) if findable else None
        quality.enforce(before, ignore, named)

    inputs = (
        typed(raw_costs, COSTS, keep=(ORDINAL,)),
        typed(raw_accounts, ACCOUNTS),
        typed(raw_rates, RATES, keep=(ORDINAL,)),
    )
    spend = spend_audit(*inputs, options).checkpoint()
    audit = _in_days(spend, days_as)
    # One pass over the rows, a row per group, for the check of every group and of the total.
    by_rows = staged(
        _row_by_row(*inputs, options).groupBy(*SPEND_KEY).agg(F.sum("cost_eur").alias("cost_eur")), "by-rows"
    )
    after = (
        quality.output_report(audit)
        .unionByName(quality.total_report(by_rows, audit))
        .unionByName(quality.groups_report(by_rows, spend))
        .checkpoint()
    )
    if gate:
        quality.enforce(after, ignore)
    return Outcome(public_spend(audit), audit, before.unionByName(after))


def _in_days(audit: DataFrame, days_as: str | None) -> DataFrame:
    """Days of spend as the type asked for, or as dates unless one of them has a time of day."""
    if days_as:
        return audit.withColumn("segments_date", F.col("segments_date").cast(days_as))
    timed = F.col("segments_date") != F.date_trunc("day", "segments_date")
    if audit.filter(timed).limit(1).count():
        return audit
    return audit.withColumn("segments_date", F.col("segments_date").cast("date"))


def _row_by_row(
    costs: DataFrame, accounts: DataFrame, rates: DataFrame, options: SpendOptions
) -> DataFrame:
    """The latest costs, each converted for itself: what the report's total is checked against."""
    rows = with_accounts(latest_costs(costs), accounts)
    if options.drop_null_keys:
        rows = rows.dropna(subset=SPEND_KEY)
    look_up = fx.with_every_rate if options.every_match else fx.with_first_rate
    return fx.with_cost_eur(look_up(rows, rates))


def write(
    outcome: Outcome,
    path: str,
    style: ReportStyle = ReportStyle(),
    data_format: str = "lines",
    keep_other_days: bool = False,
) -> None:
    """Write the report to ``path`` as fixed-width ``lines``, or as ``csv`` / ``parquet`` by day, where
    ``keep_other_days`` leaves the days that this run does not have as they are."""
    report = spend_report(
        outcome.spend,
        text_order=style.text_order,
        number=half_even if style.half_even else fixed2,
        date_format=style.date_format,
    )
    if data_format == "lines":
        write_lines(report_lines(report, text_amounts=style.text_order), path)
    else:
        write_report(report, path, data_format, keep_other_days)
