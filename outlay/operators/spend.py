"""Daily spend per domain, brand and channel.

The account decides the currency and the currency and day decide the rate, so costs are summed
per report group *and currency* before any rate is looked up. That sum is an exact integer, its
map-side combine absorbs hot customers and currencies, and the rate join then sees only report
cells instead of cost rows.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outlay.operators import fx
from outlay.operators.accounts import same_account
from outlay.functions.values import exact_parts, exact_total
from outlay.operators.joins import BROADCAST_BYTES, left_join, lookup_table
from outlay.sources.schemas import SPEND_KEY

_MICROS, _ROWS, _FIRST = "_micros", "_rows", "_first"
_SPEND, _RATED, _UNRATED, _RATE_SUM = "_spend", "_rated", "_unrated", "_rate_sum"
_LEAST, _MOST = "_least_rate", "_most_rate"


def spend_cells(
    costs: DataFrame,
    accounts: DataFrame,
    drop_null_keys: bool = False,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Costs summed per report group and currency, with their row count and first ordinal.

    Accounts too large to broadcast are joined to costs already summed per customer and day,
    which leaves a hot customer with one row per day.
    """
    attributes, small = lookup_table(accounts.select("account_id", "currency", *SPEND_KEY[1:]), limit)
    if small:
        part = costs.select(
            "segments_date",
            "customer_id",
            F.col("metrics_cost_micros").alias(_MICROS),
            F.lit(1).cast("bigint").alias(_ROWS),
            F.col("src_ord").alias(_FIRST),
        )
    else:
        part = costs.groupBy("segments_date", "customer_id").agg(
            F.sum("metrics_cost_micros").alias(_MICROS),
            F.count(F.lit(1)).alias(_ROWS),
            F.min("src_ord").alias(_FIRST),
        )
    joined = left_join(part, attributes, same_account(), small)
    if drop_null_keys:
        joined = joined.dropna(subset=SPEND_KEY)
    return joined.groupBy(*SPEND_KEY, "currency").agg(
        F.sum(_MICROS).alias(_MICROS), F.sum(_ROWS).alias(_ROWS), F.min(_FIRST).alias(_FIRST)
    )


def price_cells(
    cells: DataFrame,
    rates: DataFrame,
    days: Column,
    every_match: bool = False,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Convert each cell with its first matching quote, or once with every matching quote.

    Still one row per group and currency. Besides the amounts it has what a mean rate over cost
    rows needs: the rows with a rate, their rates' sum, and the rows without.
    """
    look_up = fx.with_every_rate if every_match else fx.with_first_rate
    priced = look_up(cells, rates, days, limit)
    rate = fx.base_rate(F.col("currency"), F.col("rate"))
    rated_rows = F.when(rate.isNotNull(), F.col(_ROWS)).otherwise(F.lit(0))
    amounts = {
        _MICROS: F.col(_MICROS),
        _SPEND: fx.in_base_currency(F.col(_MICROS), rate),
        _RATED: rated_rows,
        _RATE_SUM: rate * rated_rows,
        _UNRATED: F.col(_ROWS) - rated_rows,
    }
    priced = priced.select(
        *SPEND_KEY,
        "currency",
        _FIRST,
        *[value.alias(name) for name, value in amounts.items()],
        rate.alias(_LEAST),
        rate.alias(_MOST),
    )
    if not every_match:
        return priced
    return priced.groupBy(*SPEND_KEY, "currency").agg(
        F.min(_FIRST).alias(_FIRST),
        *[F.sum(name).alias(name) for name in amounts],
        F.min(_LEAST).alias(_LEAST),
        F.max(_MOST).alias(_MOST),
    )


def _exact_sum(name: str) -> Column:
    """The sum of doubles rounded once, whatever the order they are added in."""
    whole, fraction = exact_parts(F.col(name))
    return exact_total(F.sum(whole), F.sum(fraction))


def audit_spend(priced: DataFrame, zero_fill: bool = False, exact: bool = False) -> DataFrame:
    """Spend per report group with the columns the output checks need.

    ``rate`` is the mean over cost rows that have one, ``currency`` that of the first row with
    one, ``least_rate`` and ``greatest_rate`` bound the rates. A group without any rate has a NULL
    total, or 0 with ``zero_fill``. With ``exact`` the total does not depend on how data are split.
    """
    total = _exact_sum(_SPEND) if exact else F.sum(_SPEND)
    first_seen = F.when(F.col("currency").isNotNull(), F.col(_FIRST))
    return priced.groupBy(*SPEND_KEY).agg(
        (F.coalesce(total, F.lit(0.0)) if zero_fill else total).alias("total_spend_eur"),
        F.sum(_MICROS).alias("total_metrics_cost"),
        F.try_divide(F.sum(_RATE_SUM), F.sum(_RATED)).alias("rate"),
        F.min_by("currency", first_seen).alias("currency"),
        F.count("currency").alias("n_currencies"),
        F.sum(_UNRATED).alias("n_missing_rate"),
        F.min(_LEAST).alias("least_rate"),
        F.max(_MOST).alias("greatest_rate"),
    )


def public_spend(audit: DataFrame) -> DataFrame:
    """The report itself, without the audit columns."""
    return audit.select(*SPEND_KEY, "total_spend_eur")
