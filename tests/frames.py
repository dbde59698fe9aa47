"""Hand-made frames for the tests."""

from datetime import date, datetime

COSTS = (
    "segments_date date, customer_id string, campaign_id string, metrics_cost_micros bigint, "
    "last_extracted_at timestamp_ntz, src_ord bigint"
)
ACCOUNTS = (
    "account_id string, currency string, channel_type string, brand string, domain string"
)
RATES = (
    "currency string, base string, rate double, valid_from date, valid_to date, src_ord bigint"
)


def d(day, month=1):
    return date(2024, month, day)


def at(hour, day=2):
    return datetime(2024, 1, day, hour)


def costs(spark, *rows):
    """Rows (day, customer, campaign, micros[, hour]); the ordinal is the position."""
    full = [
        (d(r[0]) if r[0] else None, r[1], r[2], r[3], at(r[4] if len(r) > 4 else 10), i)
        for i, r in enumerate(rows)
    ]
    return spark.createDataFrame(full, COSTS)


def accounts(spark, *rows):
    """Rows (id, currency[, channel, brand, domain])."""
    rest = ("online", "brand", "com")
    return spark.createDataFrame([(*r[:2], *(r[2:] or rest)) for r in rows], ACCOUNTS)


def rates(spark, *rows):
    """Rows (currency, base, rate, from, to); the ordinal is the position."""
    full = [
        (c, b, r, f if isinstance(f, date) or f is None else d(f), t if isinstance(t, date) else d(t), i)
        for i, (c, b, r, f, t) in enumerate(rows)
    ]
    return spark.createDataFrame(full, RATES)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)
