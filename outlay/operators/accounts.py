"""Attach account attributes to costs."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outlay.operators.joins import BROADCAST_BYTES, left_lookup


def same_account() -> Column:
    return F.col("customer_id") == F.col("account_id")


def with_accounts(costs: DataFrame, accounts: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Left join on ``customer_id = account_id``.

    Costs without an account stay, with NULL attributes; a NULL id matches nothing; an account
    listed twice doubles its costs. Both key columns are kept.
    """
    return left_lookup(costs, accounts, same_account(), limit)
