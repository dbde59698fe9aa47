import random

import pytest

from outlay.operators.latest import keep_latest, keep_latest_max_by, latest_state, merge_latest
from outlay.plans.daily_spend import NEWEST
from outlay.sources.schemas import COST_KEY
from tests.frames import COSTS, at, costs, d, rows

both = pytest.mark.parametrize("keep", [keep_latest, keep_latest_max_by])


@both
def test_later_extraction_wins_and_ties_go_to_the_later_row(spark, keep):
    df = costs(spark, (1, "a", "x", 10, 12), (1, "a", "x", 20, 11), (1, "b", "x", 30), (1, "b", "x", 40))
    assert rows(keep(df, COST_KEY, NEWEST), "customer_id", "metrics_cost_micros") == [
        ("a", 10),
        ("b", 40),
    ]


@both
def test_null_keys_form_one_group_and_null_times_come_last(spark, keep):
    data = [
        (d(1), None, "x", 1, None, 5),
        (d(1), None, "x", 2, at(1), 1),
        (d(1), "n", "x", 3, None, 1),
        (d(1), "n", "x", 4, None, 2),
    ]
    df = spark.createDataFrame(data, COSTS)
    kept = keep(df, COST_KEY, NEWEST)
    assert kept.columns == df.columns
    assert rows(kept, "metrics_cost_micros") == [(2,), (4,)]


@both
def test_against_brute_force_with_a_hot_key(spark, keep):
    rng = random.Random(7)
    data = []
    for i in range(3000):
        hot = rng.random() < 0.4
        key = ("hot", d(1), "hot") if hot else (str(rng.randrange(5)), d(rng.randrange(1, 9)), str(rng.randrange(20)))
        data.append((key[1], key[2], key[0], i, at(rng.randrange(6)), i))
    best = {}
    for r in data:
        key = (r[2], r[0], r[1])
        if key not in best or (r[4], r[5]) > (best[key][4], best[key][5]):
            best[key] = r
    df = spark.createDataFrame(data, COSTS).repartition(6)
    assert rows(keep(df, COST_KEY, NEWEST)) == sorted(best.values(), key=repr)


KEYS, ORDER = ["k", "l"], ["at", "src_ord"]


def by_state(batches):
    state = latest_state(keep_latest(batches[0], KEYS, ORDER), KEYS, 3)
    for batch in batches[1:]:
        state = latest_state(merge_latest(state, batch, KEYS, ORDER), KEYS, 3)
    return rows(state.select("k", "l", "at", "src_ord"))


def test_state_gives_what_all_rows_give(spark):
    r = random.Random(5)
    data = [(r.choice(["a", "b", None]), r.choice([1, 2, None]), r.choice([1, 2, 3, None]), i) for i in range(90)]
    schema = "k string, l int, at int, src_ord int"
    batches = [spark.createDataFrame(data[i : i + 30], schema) for i in (0, 30, 60)]
    want = rows(keep_latest(spark.createDataFrame(data, schema), KEYS, ORDER))
    assert by_state(batches) == want
    assert by_state([batches[0].limit(0), *batches, batches[1], batches[0].limit(0)]) == want
