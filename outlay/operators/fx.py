"""Exchange rates with validity intervals, and the conversion of costs.

``rate`` is units of the currency per one unit of the base currency. Both ends of a validity
interval are included, at day grain.

Spark evaluates a range condition once per candidate pair, and hashing by currency alone leaves a
handful of groups. Intervals are therefore unrolled to days, which turns the range join into an
equi-join on (currency, day). Only days that occur in the costs are unrolled: a quote open until
9999 gives one row for each of them, also where a wrong date lies millennia off.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outlay.operators.joins import BROADCAST_BYTES, left_lookup
from outlay.sources.schemas import BASE_CURRENCY


def _day() -> Column:
    return F.col("segments_date").cast("date")


def cost_days(costs: DataFrame) -> Column:
    """The distinct days of the costs, as a scalar subquery over that single column.

    Their number is bounded by the calendar, whatever the number of costs.
    """
    days = costs.select(_day().alias("day")).distinct()
    return days.agg(F.array_sort(F.collect_set("day"))).scalar()


def _month(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day)


def _before(months: str, month: Column, after: bool = False) -> Column:
    """How many of the sorted ``months`` lie before ``month`` (with ``after``: not after it).

    Each step halves the range that is left; there are as many steps as bits in their number.
    """

    def halved(span: Column, _: Column) -> Column:
        middle = F.floor((span["low"] + span["high"]) / 2).cast("int")
        here = F.get(months, middle)
        right = (here <= month) if after else (here < month)
        return F.when(span["low"] >= span["high"], span).otherwise(
            F.struct(
                F.when(right, middle + 1).otherwise(span["low"]).alias("low"),
                F.when(right, span["high"]).otherwise(middle).alias("high"),
            )
        )

    steps = F.sequence(F.lit(1), F.length(F.bin(F.size(months))).cast("int"))
    whole = F.struct(F.lit(0).alias("low"), F.size(months).alias("high"))
    return F.aggregate(steps, whole, halved)["low"]


def usable_quotes(rates: DataFrame, base: str = BASE_CURRENCY) -> DataFrame:
    """Quotes against the base currency. The base itself needs none: its rate is 1."""
    return rates.filter((F.col("base") == base) & (F.col("currency") != base))


def quotes_by_month(rates: DataFrame, months: Column, base: str = BASE_CURRENCY) -> DataFrame:
    """One row per quote and month of the sorted ``months`` it reaches into."""
    first = _before("_months", _month(F.col("valid_from")))
    behind = _before("_months", _month(F.col("valid_to")), after=True)
    return (
        usable_quotes(rates, base)
        .filter(F.col("valid_from") <= F.col("valid_to"))
        .withColumn("_months", months)
        .withColumn("_month", F.explode(F.slice("_months", first + 1, behind - first)))
        .drop("_months")
    )


def quotes_by_day(rates: DataFrame, days: Column, base: str = BASE_CURRENCY) -> DataFrame:
    """One row per quote and day of ``days`` it is valid on.

    An index of months: a quote is unrolled to those of its months that have days, one slice of the
    sorted months, and meets the days of each; in the first and last one the range decides. So the
    work of a quote is its own days, however many there are. The days are sent to every executor:
    the calendar bounds them.
    """
    spark = rates.sparkSession
    calendar = spark.range(1, numPartitions=1).select(days.alias("_days")).select(
        F.explode("_days").alias("quote_day")
    )
    calendar = calendar.select("quote_day", _month(F.col("quote_day")).alias("_month"))
    months = calendar.agg(F.array_sort(F.collect_set("_month"))).scalar()
    valid = F.col("quote_day").between(F.col("valid_from"), F.col("valid_to"))
    by_month = quotes_by_month(rates, months, base)
    return by_month.join(F.broadcast(calendar), "_month").filter(valid).drop("_month")


def first_rate_by_day(rates: DataFrame, days: Column, base: str = BASE_CURRENCY) -> DataFrame:
    """One rate per currency and day: that of the earliest quote (``src_ord``) covering the day.

    At most one row for every currency and day, whatever the number of quotes.
    """
    return (
        quotes_by_day(rates, days, base)
        .groupBy("currency", "quote_day")
        .agg(F.min_by("rate", "src_ord").alias("rate"))
    )


def _lookup_by_day(facts: DataFrame, by_day: DataFrame, limit: int) -> DataFrame:
    # Joining on the day's number instead of the grouped column makes a shuffled join exchange
    # both sides, which adaptive execution needs in order to split a hot (currency, day).
    lookup = by_day.select(
        F.col("currency").alias("_currency"),
        F.unix_date("quote_day").alias("_day"),
        *[c for c in by_day.columns if c not in ("currency", "quote_day")],
    )
    same = (F.col("currency") == F.col("_currency")) & (
        F.unix_date(_day()) == F.col("_day")
    )
    return left_lookup(facts, lookup, same, limit).drop("_currency", "_day")


def with_first_rate(
    costs: DataFrame, rates: DataFrame, days: Column | None = None, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Add the looked-up ``rate``: the first matching quote, else NULL. Row count is unchanged."""
    days = cost_days(costs) if days is None else days
    return _lookup_by_day(costs, first_rate_by_day(rates, days), limit)


def with_every_rate(
    costs: DataFrame, rates: DataFrame, days: Column | None = None, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Add the looked-up ``rate`` and ``valid_from``, ``valid_to`` of every matching quote.

    A cost covered by two quotes comes out twice; one covered by none stays, with NULLs. Quotes by
    day of at most ``limit`` measured bytes are sent to every executor.
    """
    days = cost_days(costs) if days is None else days
    by_day = quotes_by_day(rates, days).drop("base", "src_ord")
    return _lookup_by_day(costs, by_day, limit)


def base_rate(currency: Column, looked_up: Column, base: str = BASE_CURRENCY) -> Column:
    """1 for the base currency, else the looked-up rate."""
    return F.when(currency == base, F.lit(1.0)).otherwise(looked_up)


def in_base_currency(micros: Column, rate: Column) -> Column:
    """Micros of the base currency; NULL where the rate is missing or zero."""
    return F.try_divide(micros.cast("double"), rate)


def with_cost_eur(priced: DataFrame) -> DataFrame:
    """Apply the base-currency rule to ``rate`` and add ``cost_eur`` (micros of EUR)."""
    return priced.withColumn("rate", base_rate(F.col("currency"), F.col("rate"))).withColumn(
        "cost_eur", in_base_currency(F.col("metrics_cost_micros"), F.col("rate"))
    )
