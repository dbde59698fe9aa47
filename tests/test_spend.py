import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from outlay.functions.values import exact_parts, exact_total
from outlay.operators.spend import audit_spend, price_cells, spend_cells
from outlay.operators import fx
from outlay.plans.daily_spend import SpendOptions, daily_spend, spend_audit
from tests.frames import accounts, costs, d, rates, rows

USD = ("USD", "EUR", 2.0, 1, 31)
LIMITS = pytest.mark.parametrize("limit", [0, 1 << 20])


def one(df):
    (row,) = df.collect()
    return row


@LIMITS
def test_null_keys_are_kept_or_dropped(spark, limit):
    c = costs(spark, (1, "a", "x", 10), (1, "b", "x", 20), (1, "orphan", "x", 30), (1, None, "x", 40))
    acc = accounts(spark, ("a", "EUR"), ("b", "EUR", "online", None, "com"), (None, "EUR"))
    r = rates(spark, USD)
    kept = daily_spend(c, acc, r, limit=limit)
    assert rows(kept, "domain", "brand", "total_spend_eur") == [
        ("com", "brand", 10.0),
        ("com", None, 20.0),
        (None, None, None),
    ]
    dropped = daily_spend(c, acc, r, SpendOptions(drop_null_keys=True), limit=limit)
    assert rows(dropped, "domain", "total_spend_eur") == [("com", 10.0)]


@LIMITS
def test_group_without_any_rate(spark, limit):
    inputs = costs(spark, (1, "a", "x", 10)), accounts(spark, ("a", "SEK")), rates(spark, USD)
    row = one(spend_audit(*inputs, limit=limit))
    assert (row.total_spend_eur, row.rate, row.total_metrics_cost, row.n_missing_rate) == (None, None, 10, 1)
    assert one(spend_audit(*inputs, SpendOptions(zero_fill=True), limit=limit)).total_spend_eur == 0.0


@LIMITS
def test_partly_missing_rates_sum_what_there_is(spark, limit):
    c = costs(spark, (1, "s", "x", 10), (1, "u", "x", 30), (1, "u", "y", 50))
    row = one(spend_audit(c, accounts(spark, ("s", "SEK"), ("u", "USD")), rates(spark, USD), limit=limit))
    assert (row.total_spend_eur, row.total_metrics_cost, row.rate) == (40.0, 90, 2.0)
    assert (row.n_missing_rate, row.n_currencies, row.currency) == (1, 2, "SEK")


@LIMITS
def test_first_currency_skips_nulls_and_mean_rate_counts_rows(spark, limit):
    c = costs(spark, (1, "n", "x", 1), (1, "u", "x", 2), (1, "u", "y", 2), (1, "u", "z", 2), (1, "e", "x", 3))
    acc = accounts(spark, ("n", None), ("u", "USD"), ("e", "EUR"))
    row = one(spend_audit(c, acc, rates(spark, USD), limit=limit))
    assert (row.currency, row.n_currencies, row.rate) == ("USD", 2, (3 * 2.0 + 1.0) / 4)


@LIMITS
def test_account_listed_twice_counts_twice(spark, limit):
    c = costs(spark, (1, "a", "x", 10))
    acc = accounts(spark, ("a", "EUR"), ("a", "USD"))
    row = one(spend_audit(c, acc, rates(spark, USD), limit=limit))
    assert (row.total_spend_eur, row.total_metrics_cost, row.n_currencies) == (15.0, 20, 2)


@LIMITS
def test_base_currency_is_never_multiplied_by_its_own_quotes(spark, limit):
    r = rates(spark, ("EUR", "EUR", 1.0, 1, 31), ("EUR", "EUR", 1.0, 1, 31))
    for options in (SpendOptions(), SpendOptions(every_match=True)):
        row = one(spend_audit(costs(spark, (1, "a", "x", 10)), accounts(spark, ("a", "EUR")), r, options, limit=limit))
        assert (row.total_spend_eur, row.total_metrics_cost, row.rate) == (10.0, 10, 1.0)


def brute_force(c, acc, quotes, every_match):
    latest = {}
    for day, customer, campaign, micros, hour, i in c:
        key = (campaign, day, customer)
        if key not in latest or (hour, i) > latest[key][:2]:
            latest[key] = (hour, i, micros)
    groups = defaultdict(list)
    for (campaign, day, customer), (_, i, micros) in latest.items():
        for a in [a for a in acc if a[0] == customer] or [(None,) * 5]:
            if a[1] == "EUR":
                found = [1.0]
            else:
                found = [
                    r
                    for cur, base, r, lo, hi in quotes
                    if cur == a[1] and base == "EUR" and lo <= day <= hi
                ] or [None]
            for rate in found if every_match else found[:1]:
                groups[(d(day), a[4], a[3], a[2])].append((i, a[1], micros, rate))
    result = {}
    for key, members in groups.items():
        rated = [(m, r) for _, _, m, r in members if r is not None]
        named = [(i, cur) for i, cur, _, _ in members if cur is not None]
        result[key] = (
            round(sum(m / r for m, r in rated), 4) if rated else None,
            sum(m for _, _, m, _ in members),
            round(sum(r for _, r in rated) / len(rated), 9) if rated else None,
            min(named)[1] if named else None,
            len({cur for _, cur in named}),
            sum(r is None for *_, r in members),
        )
    return result


@LIMITS
@pytest.mark.parametrize("every_match", [False, True])
def test_against_brute_force(spark, every_match, limit):
    rng = random.Random(11)
    c = []
    for i in range(1500):
        customer = "hot" if rng.random() < 0.35 else rng.choice("abcdefgh")
        c.append((rng.randrange(1, 12), customer, rng.choice("xyz"), rng.randrange(1, 10**7), rng.randrange(6), i))
    choices = (["EUR", "USD", "BRL", "SEK", None], ["on", "off"], ["p", None], ["com", "de"])
    acc = [(k, *[rng.choice(c) for c in choices]) for k in ["hot", *"abcdefg"]]
    acc.append(("a", "USD", "on", "p", "com"))
    quotes = [
        ("USD", "EUR", 1.1, 1, 8),
        ("USD", "EUR", 1.3, 5, 9),
        ("BRL", "GBP", 9.0, 1, 12),
        ("BRL", "EUR", 5.5, 1, 12),
        ("EUR", "EUR", 1.0, 1, 12),
    ]
    audit = spend_audit(
        costs(spark, *[r[:5] for r in c]).repartition(5),
        accounts(spark, *acc),
        rates(spark, *quotes),
        SpendOptions(every_match=every_match),
        limit=limit,
    )
    got = {
        tuple(r)[:4]: (
            None if r.total_spend_eur is None else round(r.total_spend_eur, 4),
            r.total_metrics_cost,
            None if r.rate is None else round(r.rate, 9),
            r.currency,
            r.n_currencies,
            r.n_missing_rate,
        )
        for r in audit.collect()
    }
    assert got == brute_force(c, acc, quotes, every_match)


def test_public_total_equals_audit_total(spark):
    c = costs(spark, *[(1 + i % 5, "ab"[i % 2], f"c{i}", i * 1000) for i in range(100)])
    acc, r = accounts(spark, ("a", "EUR"), ("b", "USD")), rates(spark, USD)
    total = lambda df: sum(row.total_spend_eur for row in df.collect())
    assert total(daily_spend(c, acc, r)) == pytest.approx(total(spend_audit(c, acc, r)))


def test_cells_keep_exact_integers(spark):
    big = 2**53
    c = costs(spark, (1, "a", "x", big), (1, "a", "y", 1))
    cells = spend_cells(c, accounts(spark, ("a", "EUR")))
    assert one(cells)["_micros"] == big + 1
    priced = price_cells(cells, rates(spark, USD), fx.cost_days(c))
    assert one(audit_spend(priced)).total_metrics_cost == big + 1


def test_exact_totals_do_not_depend_on_the_order_of_addition(spark):
    r = random.Random(11)
    size = {0: (-8, 20), 1: (0, 62), 2: (40, 60)}
    data = [(i % 3, math.ldexp(r.uniform(0.5, 1), r.randrange(*size[i % 3]) + 1) * r.choice([1, -1]))
            for i in range(600)]
    data += [(0, None), (3, None), (4, 0.0), (5, 1e18), (5, 1.0), (5, -1e18)]
    whole, fraction = exact_parts(F.col("x"))
    total = exact_total(F.sum(whole), F.sum(fraction)).alias("total")
    for parts in (1, 64):
        df = spark.createDataFrame(data, "g int, x double").repartition(parts)
        got = {row.g: row.total for row in df.groupBy("g").agg(total).collect()}
        assert got == {
            g: math.fsum(x for k, x in data if k == g and x is not None) if g != 3 else None for g in range(6)
        }


def test_exact_spend_is_the_same_however_costs_are_split(spark, conf):
    quotes = rates(spark, ("USD", "EUR", 1.1, 1, 31), ("GBP", "EUR", 0.7, 1, 31))
    known = accounts(spark, *[(str(i), ("USD", "GBP", "EUR")[i % 3]) for i in range(30)])
    raw = costs(spark, *[(1 + i % 3, str(i % 30), f"x{i}", 1 + i * 7919) for i in range(600)])
    found = []
    for parts in (1, 64):
        conf(spark__sql__shuffle__partitions=str(parts))
        found.append(rows(daily_spend(raw.repartition(parts), known, quotes, SpendOptions(exact=True))))
    assert found[0] == found[1]
