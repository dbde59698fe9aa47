"""Records that recur, and passages in crowded bands and whole copies, against plain Python."""

import random
from collections import defaultdict

import numpy as np
import pytest

from outlay.llm import recurring, substrings


@pytest.mark.parametrize("together", [7, 10**6])
def test_records_whose_key_recurs(spark, monkeypatch, together):
    monkeypatch.setattr(recurring, "PACKED_TOGETHER", together)
    monkeypatch.setattr(recurring, "ROWS_AT_ONCE", 5)
    r = random.Random(5)
    rows = [(r.choice([1, r.randrange(2, 300)]), r.randrange(40), i % 9 == 0) for i in range(200)]
    rows += rows[:50]
    dtype = [("key", "u8"), ("what", "u8"), ("sure", "?")]

    def records(batch):
        found = np.zeros(batch.num_rows, dtype)
        for name, _ in dtype:
            found[name] = np.asarray(batch.column(name).to_pylist())
        return found

    docs = spark.createDataFrame(rows, "key bigint, what bigint, sure boolean").repartition(3)
    found = recurring.recurring(docs, docs.columns, records, dtype, ["key", "what", "sure"], 10, "sure")
    others = defaultdict(set)
    for row in rows:
        others[row[0]].add(row)
    want = {row for row in rows if row[2] or len(others[row[0]]) > 1}
    assert {tuple(x) for x in found.collect()} == want


def test_crowded_bands_and_copies(spark, monkeypatch):
    monkeypatch.setattr(substrings, "CROWDED", 1)
    r = random.Random(6)

    def noise(n):
        return [f"w{r.randrange(10**6)}" for _ in range(n)]

    phrase, texts = noise(6), {}
    for i in range(12):
        rest = noise(30)
        texts[i] = " ".join([*phrase, *rest])
        texts[100 + i] = " ".join([*phrase, *rest[:-1], "changed"])
    texts |= {200: texts[3], 201: texts[103], 202: " ".join(noise(30))}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    found = substrings.repeated_passages(docs).collect()
    gone = {x.doc_id: (x.n_words, x.keep_id) for x in found if x.removed}
    assert gone == {100 + i: (36, i) for i in range(12)} | {200: (36, 3), 201: (36, 3)}
    assert {x.doc_id for x in found if not x.removed} >= set(range(12)) and 202 not in {x.doc_id for x in found}
