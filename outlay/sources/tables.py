"""Costs, accounts and rates as views over the driver's tables.

events    -> cost extractions; hourly extraction times give ties, ``event_id`` is the ordinal
customer  -> accounts; a negative balance leaves the account without an id, FURNITURE without brand
orders    -> quotes; each currency's orders are summed up per third of the month. BRL intervals
             overlap, GBP ones leave gaps, SEK is quoted against the wrong base only

The ``*_text`` tables are raw text, some of it unusable.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Currency by the key's remainder, first day of the quoted month.
CURRENCIES = ["EUR", "USD", "BRL", "GBP", "SEK"]
MONTH_START = "2024-01-01"

# The columns in use. Naming them saves a look into the files before every query.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
}


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[table]).parquet(f"{sf_dir}/{table}.parquet")


def _currency(key: str) -> Column:
    return F.element_at(
        F.array(*[F.lit(c) for c in CURRENCIES]), (F.col(key) % len(CURRENCIES) + 1).cast("int")
    )


def micros() -> Column:
    """An event's value as a cost in micros."""
    return F.round(F.col("value") * 1000000).cast("bigint")


def costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").select(
        F.col("ts").cast("date").alias("segments_date"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.col("event_type").alias("campaign_id"),
        micros().alias("metrics_cost_micros"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("last_extracted_at"),
        F.col("event_id").alias("src_ord"),
    )


def costs_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    error = F.col("event_type") == "error"
    anonymous = (F.col("event_type") == "signup") & (F.col("value") < 2)
    extracted = F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return load(spark, sf_dir, "events").select(
        F.when(error & (F.col("value") > 100), "unknown")
        .otherwise(F.col("ts").cast("date").cast("string"))
        .alias("segments_date"),
        F.when(~anonymous, F.col("user_id").cast("string")).alias("customer_id"),
        F.col("event_type").alias("campaign_id"),
        F.when(error & (F.col("value") < 1), "n/a")
        .otherwise(micros().cast("string"))
        .alias("metrics_cost_micros"),
        F.when(error & (F.col("value") < 2), "never")
        .otherwise(extracted)
        .alias("last_extracted_at"),
        F.col("event_id").alias("src_ord"),
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = load(spark, sf_dir, "nation"), load(spark, sf_dir, "region")
    return (
        load(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.when(F.col("c_acctbal") >= 0, F.col("c_custkey").cast("string")).alias("account_id"),
            _currency("c_custkey").alias("currency"),
            F.col("r_name").alias("channel_type"),
            F.nullif("c_mktsegment", F.lit("FURNITURE")).alias("brand"),
            F.col("n_name").alias("domain"),
        )
    )


def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    third = F.least(F.floor((F.dayofmonth("o_orderdate") - 1) / 10), F.lit(2)).cast("int")
    quotes = (
        load(spark, sf_dir, "orders")
        .select(_currency("o_custkey").alias("currency"), third.alias("third"), "o_orderkey")
        .groupBy("currency", "third")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.max("o_orderkey").alias("last_key"),
            F.min("o_orderkey").alias("src_ord"),
        )
    )
    days = F.when(F.col("currency") == "BRL", 14).when(F.col("currency") == "GBP", 6).otherwise(9)
    days = F.when((F.col("third") == 2) & (F.col("currency") != "GBP"), 10).otherwise(days)
    start = F.date_add(F.lit(MONTH_START).cast("date"), F.col("third") * 10)
    return quotes.select(
        "currency",
        F.when(F.col("currency") == "SEK", "GBP").otherwise("EUR").alias("base"),
        (((F.col("n") + F.col("last_key")) % 4000 + 500).cast("double") / F.lit(1000.0)).alias(
            "rate"
        ),
        start.alias("valid_from"),
        F.date_add(start, days).alias("valid_to"),
        "src_ord",
    )


def rates_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One quote per order, three days long."""
    day = F.date_add(F.lit(MONTH_START).cast("date"), F.dayofmonth("o_orderdate") - 1)
    return load(spark, sf_dir, "orders").select(
        _currency("o_custkey").alias("currency"),
        F.when(F.col("o_orderstatus") == "P", "USD").otherwise("EUR").alias("base"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "not quoted")
        .when(F.col("o_totalprice") < 2000, "0")
        .otherwise(F.col("o_totalprice").cast("string"))
        .alias("rate"),
        day.cast("string").alias("valid_from"),
        F.when(F.col("o_orderstatus") == "O", "open")
        .otherwise(F.date_add(day, 2).cast("string"))
        .alias("valid_to"),
        F.col("o_orderkey").alias("src_ord"),
    )
