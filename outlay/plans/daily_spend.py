"""The daily-spend plan over typed inputs."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from outlay.operators import fx, spend
from outlay.operators.joins import BROADCAST_BYTES
from outlay.operators.latest import keep_latest
from outlay.sources.schemas import COST_KEY

NEWEST = ["last_extracted_at", "src_ord"]


@dataclass(frozen=True)
class SpendOptions:
    """Choices on which existing implementations of this report differ.

    every_match     sum a cost once per matching quote instead of using the first quote
    drop_null_keys  leave out groups with a NULL key
    zero_fill       total 0 instead of NULL for a group without any rate
    exact           totals are the exact sums, rounded once, in whatever order they are added
    """

    every_match: bool = False
    drop_null_keys: bool = False
    zero_fill: bool = False
    exact: bool = False


def latest_costs(costs: DataFrame) -> DataFrame:
    """The last extraction per campaign, day and customer; of equal ones the last in the source."""
    return keep_latest(costs, COST_KEY, NEWEST)


def spend_audit(
    costs: DataFrame,
    accounts: DataFrame,
    rates: DataFrame,
    options: SpendOptions = SpendOptions(),
    days: Column | None = None,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Spend per group with its audit columns. ``days`` saves a pass over them if known."""
    cells = spend.spend_cells(latest_costs(costs), accounts, options.drop_null_keys, limit)
    days = fx.cost_days(costs) if days is None else days
    priced = spend.price_cells(cells, rates, days, options.every_match, limit)
    return spend.audit_spend(priced, options.zero_fill, options.exact)


def daily_spend(
    costs: DataFrame,
    accounts: DataFrame,
    rates: DataFrame,
    options: SpendOptions = SpendOptions(),
    days: Column | None = None,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Spend in EUR micros per day, domain, brand and channel."""
    return spend.public_spend(spend_audit(costs, accounts, rates, options, days, limit))
