import random

import pytest
from pyspark.sql import functions as F

from outlay.operators.ordinals import global_rank, rank_within
from tests.frames import rows


def data(spark, n=4000):
    rng = random.Random(3)

    def key():
        return rng.choice([None, *["hot"] * 5, *[str(rng.randrange(40)) for _ in range(4)]])

    raw = [(key(), rng.randrange(100), i) for i in range(n)]
    return raw, spark.createDataFrame(raw, "k string, v int, i int").repartition(7)


@pytest.fixture(autouse=True)
def many_partitions(conf):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")


def test_global_rank(spark):
    raw, df = data(spark)
    expected = sorted(raw, key=lambda r: (r[1], -r[2]))
    ranked = global_rank(df, [F.col("v").asc(), F.col("i").desc()], "rank", start=0)
    assert ranked.columns == ["k", "v", "i", "rank"]
    got = {r.i: r["rank"] for r in ranked.collect()}
    assert got == {r[2]: n for n, r in enumerate(expected)}


def test_rank_within_a_key_that_spans_partitions(spark):
    raw, df = data(spark)
    expected, seen = [], {}
    for r in sorted(raw, key=lambda r: (-r[1], -r[2])):
        seen[r[0]] = seen.get(r[0], 0) + 1
        expected.append((*r, seen[r[0]]))
    ranked = rank_within(df, ["k"], [F.col("v").desc(), F.col("i").desc()], "rank")
    assert rows(ranked) == sorted(expected, key=repr)


def test_empty_input(spark):
    empty = spark.createDataFrame([], "k string, v int")
    assert global_rank(empty, [F.col("v")], "rank").count() == 0
    assert rank_within(empty, ["k"], [F.col("v")], "rank").count() == 0
