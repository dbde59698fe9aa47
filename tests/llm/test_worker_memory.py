"""What Python workers hold while a task runs and after it."""

import gc
import weakref

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from outlay.llm import common, tokens

PATHS = ["byte_bpe_50k.json", "word_bpe_49k.json"]
CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


@pytest.fixture
def batches():
    yield lambda: iter([pa.RecordBatch.from_pydict({"text": list("abcdefg")})])
    common._KEPT.clear()


def test_tokenizer_stays_for_tasks_that_keep_it_only(batches):
    found = weakref.ref(tokens.encoder(public_tokenizers.path(PATHS[0])))
    assert sum(b.num_rows for b in common.arrow_rows(batches(), 3, keeps=True)) == 7
    gc.collect()
    assert found() is tokens.encoder(public_tokenizers.path(PATHS[0]))
    assert [b.num_rows for b in common.arrow_rows(batches(), 3)] == [3, 3, 1]
    gc.collect()
    assert found() is None


@pytest.mark.parametrize("name", PATHS)
def test_pieces_kept_are_as_few_as_asked_for(batches, name):
    path = public_tokenizers.path(name)
    few, many = tokens.Encoder(path, 50), tokens.Encoder(path)
    for i in range(40):
        texts = [f"word {n} some-thing, else{n}\nÜber{n} n" for n in range(10 * i, 10 * i + 10)] + ["", " "]
        for a, b in zip(few.ids(texts), many.ids(texts), strict=True):
            np.testing.assert_array_equal(a, b)
        new = 8 * len(texts)
        assert max(map(len, (few.pieces, few.older, few.words))) <= 50 + new
    assert len(many.pieces) > 200


@pytest.mark.parametrize("before, most", [("10000", common.BATCH_ROWS), ("0", common.BATCH_ROWS), ("7", 7)])
def test_few_rows_at_a_time_reach_python(spark, conf, before, most):
    conf(**{CONF.replace(".", "__"): before})

    def sizes(parts):
        for batch in parts:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    rows = spark.range(0, 4100 if most > 7 else 50, 1, 1).mapInArrow(sizes, "n bigint")
    found = [r.n for r in common.staged(rows, "sizes").collect()]
    assert max(found) == most and sum(found) == (4100 if most > 7 else 50)
    assert spark.conf.get(CONF) == before
