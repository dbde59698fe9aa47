"""Column types of the three inputs. Names are the cleaned (lower-case) ones."""

from pyspark.sql import types as T

COSTS = T.StructType(
    [
        # A time of day, where there is one, is part of the key; the day alone decides the rate.
        T.StructField("segments_date", T.TimestampType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("campaign_id", T.StringType()),
        # Sums have ten more digits, so they cannot overflow.
        T.StructField("metrics_cost_micros", T.DecimalType(28, 6)),
        T.StructField("last_extracted_at", T.TimestampType()),
    ]
)

ACCOUNTS = T.StructType(
    [
        T.StructField("account_id", T.StringType()),
        T.StructField("currency", T.StringType()),
        T.StructField("channel_type", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("domain", T.StringType()),
    ]
)

RATES = T.StructType(
    [
        T.StructField("currency", T.StringType()),
        T.StructField("base", T.StringType()),
        T.StructField("rate", T.DoubleType()),
        T.StructField("valid_from", T.DateType()),
        T.StructField("valid_to", T.DateType()),
    ]
)

# Columns an input must have: all the plan uses.
REQUIRED = {
    "costs": COSTS.fieldNames(),
    "rates": RATES.fieldNames(),
    "accounts": ACCOUNTS.fieldNames(),
}

# Grain of a cost after de-duplication, and the grain at which a re-delivered row counts as a copy.
COST_KEY = ["campaign_id", "segments_date", "customer_id"]
EXTRACTION_KEY = [*COST_KEY, "last_extracted_at"]

# Grain of the daily report.
SPEND_KEY = ["segments_date", "domain", "brand", "channel_type"]

BASE_CURRENCY = "EUR"
