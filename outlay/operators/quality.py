"""Quality checks as data.

Costs are read once for all input checks: grouped by the extraction key, written, and looked at
there. What tells good rows from bad ones can also be counted while the rows are written
(:func:`observed`), or routed with them (:func:`route`).
"""

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from outlay.functions.values import is_close, is_finite, unparsed
from outlay.sources.files import MALFORMED
from outlay.operators.joins import left_lookup
from outlay.sources.schemas import BASE_CURRENCY, EXTRACTION_KEY, REQUIRED, SPEND_KEY
from outlay.sources.scratch import new_table_path, staged

OFFENDERS = 5  # values named for each failed check, at most


def _count_if(condition: Column, name: str) -> Column:
    return F.count_if(condition).alias(name)


def costs_summary(costs: DataFrame) -> DataFrame:
    """One row of counts over costs, typed or still text."""
    return costs.agg(
        F.count(F.lit(1)).alias("n_rows"),
        _count_if(F.col("customer_id").isNull(), "n_null_customer_id"),
        _count_if(unparsed("segments_date", "timestamp"), "n_bad_segments_date"),
        _count_if(unparsed("metrics_cost_micros", "decimal(28,6)"), "n_bad_cost"),
        _count_if(unparsed("last_extracted_at", "timestamp"), "n_bad_last_extracted_at"),
    )


def rates_summary(rates: DataFrame) -> DataFrame:
    """One row of counts over rates, typed or still text."""
    rate = F.col("rate").try_cast("double")
    return rates.agg(
        F.count(F.lit(1)).alias("n_rows"),
        _count_if(rate.isNull(), "n_bad_rate"),
        _count_if(rate == 0.0, "n_zero_rate"),
        _count_if(~is_finite(rate), "n_not_finite_rate"),
        _count_if(is_finite(rate) & (rate < 0), "n_negative_rate"),
    )


def accounts_summary(accounts: DataFrame) -> DataFrame:
    """One row of counts over accounts."""
    return accounts.agg(
        F.count(F.lit(1)).alias("n_rows"),
        _count_if(F.col("account_id").isNull(), "n_null_account_id"),
    )


def orphan_customers(costs: DataFrame, accounts: DataFrame) -> DataFrame:
    """Customer ids without an account; a NULL id has none."""
    return (
        costs.select("customer_id")
        .distinct()
        .join(accounts, F.col("customer_id") == F.col("account_id"), "left_anti")
    )


def orphan_customers_except(costs: DataFrame, accounts: DataFrame) -> DataFrame:
    """The same as a set difference, where a NULL account id does cover NULL customer ids.

    Spark joins before it removes repeats; making the ids distinct first keeps the costs
    themselves out of that join.
    """
    return costs.select("customer_id").distinct().subtract(
        accounts.select(F.col("account_id").alias("customer_id"))
    )


def duplicate_groups(costs: DataFrame, keys: list[str] = EXTRACTION_KEY) -> DataFrame:
    """Keys that occur more than once, with their row count ``n``."""
    return costs.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def flag_duplicates(costs: DataFrame, keys: list[str] = EXTRACTION_KEY) -> DataFrame:
    """All rows, with ``is_duplicate`` set on every copy.

    A count over a window would gather each key in one task. The counts come from an aggregate
    with map-side combine instead. The join compares a hash of the key as well, so that a
    shuffled join exchanges both sides and adaptive execution can split the copies of a hot key.
    """
    repeated = duplicate_groups(costs, keys).select(
        F.xxhash64(*keys).alias("_hash"), *[F.col(k).alias(f"_r_{k}") for k in keys]
    )
    same = F.xxhash64(*keys) == F.col("_hash")
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_r_{key}"))
    return costs.join(repeated, same, "left").select(
        *costs.columns, F.col("_hash").isNotNull().alias("is_duplicate")
    )


def comparable() -> Column:
    """Where cost over mean rate must equal the spend: one currency, one rate, none missing."""
    one_rate = F.col("least_rate") == F.col("greatest_rate")
    return (F.col("n_currencies") == 1) & (F.col("n_missing_rate") == 0) & one_rate


def _expected_spend() -> Column:
    return F.try_divide(F.col("total_metrics_cost").cast("double"), F.col("rate"))


def _eur_not_one() -> Column:
    all_eur = (F.col("currency") == BASE_CURRENCY) & (F.col("n_currencies") == 1)
    return all_eur & (F.col("rate") != 1.0)


def single_currency(audit: DataFrame) -> DataFrame:
    """Groups for which cost over mean rate must equal the spend (:func:`comparable`)."""
    return audit.filter(comparable())


def cost_mismatches(audit: DataFrame, rtol: float = 1e-5, atol: float = 1e-8) -> DataFrame:
    """Groups whose spend differs from total cost over mean rate. NULLs are not compared."""
    return audit.withColumn("expected_spend_eur", _expected_spend()).filter(
        ~is_close(F.col("total_spend_eur"), F.col("expected_spend_eur"), rtol, atol)
    )


def eur_rate_not_one(audit: DataFrame) -> DataFrame:
    """Single-currency groups in the base currency whose rate is not 1."""
    return audit.filter(_eur_not_one())


def total_report(priced_rows: DataFrame, audit: DataFrame) -> DataFrame:
    """One check (check, passed, n_bad): the report's total against that of the cost rows.

    ``priced_rows`` are converted row by row (``cost_eur``), without the sums, cells and grouped
    lookups that the report goes through, so a fault in one of them shows as a difference.
    """
    by_rows = priced_rows.agg(F.coalesce(F.sum("cost_eur"), F.lit(0.0))).scalar()
    total = F.coalesce(F.sum("total_spend_eur"), F.lit(0.0)).alias("total")
    differs = ~F.coalesce(is_close(F.col("total"), F.col("by_rows")), F.lit(False))
    counted = audit.agg(total).select("total", by_rows.alias("by_rows")).select(
        differs.cast("bigint").alias("n")
    )
    return _unpivot(counted, {"spend_total_matches_rows": "n"})


def groups_report(priced_rows: DataFrame, audit: DataFrame) -> DataFrame:
    """One check (check, passed, n_bad): every group's spend against that of its cost rows.

    A wrong group of a few euros does not show in a total of billions. Groups that only one side has
    are wrong; a group without any rate has no spend (or 0) on either side. Both sides are a row per
    group when they meet; NULL keys are keys like any other.
    """
    rows = priced_rows.groupBy(*SPEND_KEY).agg(F.sum("cost_eur").alias("_by_rows"))
    rows = rows.select(*[F.col(c).alias(f"_r_{c}") for c in SPEND_KEY], "_by_rows", F.lit(True).alias("_in_rows"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in SPEND_KEY])
    met = audit.select(*SPEND_KEY, "total_spend_eur", F.lit(True).alias("_in_audit")).join(rows, same, "full_outer")
    close = is_close(F.coalesce("total_spend_eur", F.lit(0.0)), F.coalesce("_by_rows", F.lit(0.0)))
    bad = F.col("_in_rows").isNull() | F.col("_in_audit").isNull() | ~close
    return _unpivot(met.agg(_count_if(bad, "n")), {"spend_groups_match_rows": "n"})


def missing_columns(df: DataFrame, table: str) -> list[str]:
    return [name for name in REQUIRED[table] if name not in df.columns]


def _unpivot(one_row: DataFrame, checks: dict[str, str]) -> DataFrame:
    """Turn the named counts of a summary row into (check, passed, n_bad) rows."""
    rows = F.array(
        *[F.struct(F.lit(c).alias("check"), F.col(n).alias("n_bad")) for c, n in checks.items()]
    )
    return one_row.select(F.inline(rows)).select(
        "check", (F.col("n_bad") == 0).alias("passed"), "n_bad"
    )


def _none_of(bad: DataFrame, check: str) -> DataFrame:
    """A check that passes when ``bad`` has no rows."""
    return _unpivot(bad.agg(F.count(F.lit(1)).alias("n")), {check: "n"})


def _columns_check(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table, known from the schemas alone."""
    rows = []
    for table, df in tables.items():
        n = len(missing_columns(df, table))
        rows.append(
            F.struct(
                F.lit(f"{table}_columns_present").alias("check"),
                F.lit(n == 0).alias("passed"),
                F.lit(n).cast("bigint").alias("n_bad"),
            )
        )
    spark = next(iter(tables.values())).sparkSession
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*rows)))


def _union(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _has(df: DataFrame, *columns: str) -> bool:
    return all(c in df.columns for c in columns)


# What each check of a row looks at, and when that is bad.
_COST_CHECKS = {
    "costs_customer_id_not_null": ("customer_id", F.isnull),
    "costs_segments_date_parses": ("segments_date", lambda c: unparsed(c, "timestamp")),
    "costs_cost_is_numeric": ("metrics_cost_micros", lambda c: unparsed(c, "decimal(28,6)")),
    "costs_last_extracted_at_parses": ("last_extracted_at", lambda c: unparsed(c, "timestamp")),
    "costs_rows_well_formed": (MALFORMED, F.col),
}
_HAVE_ACCOUNTS = "costs_customers_have_accounts"


def _cost_checks(costs: DataFrame) -> dict[str, Column]:
    return {name: bad(c) for name, (c, bad) in _COST_CHECKS.items() if _has(costs, c)}


def observed(costs: DataFrame) -> tuple[DataFrame, Observation | None]:
    """``costs`` that count their bad values when they are written, and where the counts will be:
    :func:`input_report` then need not read them for it."""
    of_costs = _cost_checks(costs)
    if not of_costs:
        return costs, None
    seen = Observation()
    return costs.observe(seen, *[_count_if(bad, name) for name, bad in of_costs.items()]), seen


def _costs_by_key(costs: DataFrame) -> DataFrame:
    """Rows by extraction key, as text or typed, with the bad values among them: one pass."""
    rest = {n: bad for n, bad in _cost_checks(costs).items() if _COST_CHECKS[n][0] not in EXTRACTION_KEY}
    grouped = costs.groupBy(*EXTRACTION_KEY).agg(
        F.count(F.lit(1)).alias("n"), *[_count_if(bad, name) for name, bad in rest.items()]
    )
    return staged(grouped, "by-key")


def _bad_costs(by_key: DataFrame, costs: DataFrame) -> DataFrame:
    """One row with the number of rows that fail each check."""
    counts = []
    for name, bad in _cost_checks(costs).items():
        in_key = _COST_CHECKS[name][0] in EXTRACTION_KEY
        n = F.sum(F.when(bad, F.col("n")) if in_key else F.col(name))
        counts.append(F.coalesce(n, F.lit(0)).alias(name))
    return by_key.agg(*counts)


def _known(seen: Observation, like: DataFrame) -> DataFrame:
    counts = seen.get
    row = like.sparkSession.range(1, numPartitions=1)
    return row.select(*[F.lit(n).cast("bigint").alias(name) for name, n in counts.items()])


def input_report(
    costs: DataFrame, accounts: DataFrame, rates: DataFrame, seen: Observation | None = None
) -> DataFrame:
    """All input checks as rows (check, passed, n_bad). ``seen`` has the counts of bad costs where
    they were taken already (:func:`observed`).

    Checks that need an absent column are left out; the column check itself has failed then.
    Repeated extractions are counted for information and always pass.
    """
    parts = [_columns_check({"costs": costs, "accounts": accounts, "rates": rates})]
    whole_key = _has(costs, *EXTRACTION_KEY)
    by_key = _costs_by_key(costs) if whole_key else None
    of_costs = _cost_checks(costs)
    if of_costs:
        if seen is not None:
            counted = _known(seen, costs)
        elif whole_key:
            counted = _bad_costs(by_key, costs)
        else:
            counted = costs.agg(*[_count_if(bad, name) for name, bad in of_costs.items()])
        parts.append(_unpivot(counted, {name: name for name in of_costs}))
    if whole_key:
        copies = by_key.filter(F.col("n") > 1).agg(
            F.count(F.lit(1)).alias("groups"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")
        )
        parts.append(
            _unpivot(
                copies, {"costs_duplicate_groups": "groups", "costs_duplicate_rows": "rows"}
            ).withColumn("passed", F.lit(True))
        )
    if _has(rates, "rate"):
        parts.append(
            _unpivot(
                rates_summary(rates),
                {
                    "rates_rate_is_numeric": "n_bad_rate",
                    "rates_rate_not_zero": "n_zero_rate",
                    "rates_rate_is_finite": "n_not_finite_rate",
                    "rates_rate_not_negative": "n_negative_rate",
                },
            )
        )
    if _has(accounts, "account_id"):
        parts.append(
            _unpivot(
                accounts_summary(accounts), {"accounts_account_id_not_null": "n_null_account_id"}
            )
        )
    if _has(costs, "customer_id") and _has(accounts, "account_id"):
        customers = by_key if whole_key else costs
        parts.append(_none_of(orphan_customers(customers, accounts), _HAVE_ACCOUNTS))
    return _union(parts)


def with_findings(costs: DataFrame, accounts: DataFrame) -> DataFrame:
    """All costs with ``findings``, the names of the checks that the row fails, and ``offending``,
    the value each of them looked at, as text.

    Accounts are looked up as a table of their distinct ids, so that no cost is repeated.
    """
    ids = accounts.select(F.col("account_id").alias("_account")).where("_account is not null").distinct()
    looked_up = left_lookup(costs, ids, F.col("customer_id") == F.col("_account"))
    checks = [(name, _COST_CHECKS[name][0], bad) for name, bad in _cost_checks(costs).items()]
    checks.append((_HAVE_ACCOUNTS, "customer_id", F.col("_account").isNull()))
    found = [
        F.when(bad, F.struct(F.lit(name).alias("check"), F.col(c).cast("string").alias("value")))
        for name, c, bad in checks
    ]
    return looked_up.withColumn("_found", F.array_compact(F.array(*found))).select(
        *costs.columns, F.col("_found.check").alias("findings"), F.col("_found.value").alias("offending")
    )


def route(found: DataFrame, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Costs with their findings (:func:`with_findings`), written in one pass to two folders below
    ``path``: the rows without any, as they came, and the quarantined ones with their reasons."""
    spark = found.sparkSession
    path = path or new_table_path(spark, "routed")
    marked = found.withColumn("quarantined", F.size("findings") > 0)
    marked.write.mode("overwrite").partitionBy("quarantined").parquet(path)
    both = spark.read.schema(marked.schema).parquet(path)
    good = both.where(~F.col("quarantined")).drop("quarantined", "findings", "offending")
    return good, both.where("quarantined").drop("quarantined")


def offenders(quarantined: DataFrame, most: int = OFFENDERS) -> DataFrame:
    """For each check the values that fail it in the most rows, ``most`` of them: ``check``,
    ``value``, ``n``. A missing value is one of them."""
    pairs = F.explode(F.arrays_zip("findings", "offending")).alias("pair")
    counted = (
        quarantined.select(pairs)
        .groupBy(F.col("pair.findings").alias("check"), F.col("pair.offending").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    first = Window.partitionBy("check").orderBy(F.desc("n"), F.asc_nulls_first("value"))
    return counted.withColumn("_rank", F.row_number().over(first)).where(F.col("_rank") <= most).drop("_rank")


def output_report(audit: DataFrame) -> DataFrame:
    """All output checks as rows (check, passed, n_bad), from one pass over the audit frame.

    Cost over mean rate is compared only where it has to hold (:func:`single_currency`); groups
    with a missing rate have a check of their own.
    """
    mismatch = comparable() & ~is_close(F.col("total_spend_eur"), _expected_spend())
    bad = {
        "spend_matches_cost_over_rate": mismatch,
        "spend_has_no_missing_rate": F.col("n_missing_rate") > 0,
        "spend_eur_rate_is_one": _eur_not_one(),
    }
    counted = audit.agg(
        *[_count_if(condition, name) for name, condition in bad.items()],
        *[
            F.coalesce(F.bool_and(~F.coalesce(condition, F.lit(False))), F.lit(True)).alias(
                f"{name}_passed"
            )
            for name, condition in bad.items()
        ],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("check"),
                F.col(f"{name}_passed").alias("passed"),
                F.col(name).alias("n_bad"),
            )
            for name in bad
        ]
    )
    return counted.select(F.inline(rows))


class QualityError(Exception):
    """A quality gate did not pass."""


def enforce(
    report: DataFrame, ignore: tuple[str, ...] = (), costs: DataFrame | None = None
) -> None:
    """Raise if any check of the report failed, naming all that did.

    ``costs`` with their findings are looked at only then, for the values that fail most often.
    """
    failed = report.filter(~F.col("passed") & ~F.col("check").isin(*ignore, "")).collect()
    if not failed:
        return
    named: dict[str, list[str]] = {}
    if costs is not None:
        worst = offenders(costs).where(F.col("check").isin([r["check"] for r in failed]))
        for r in worst.orderBy("check", F.desc("n"), "value").collect():
            named.setdefault(r["check"], []).append(f"{r['value']!r} {r['n']}x")
    raise QualityError(", ".join(
        f"{r['check']} ({r['n_bad']})" + "".join(f": {'; '.join(named[r['check']])}" for _ in named.get(r["check"], [])[:1])
        for r in failed
    ))
