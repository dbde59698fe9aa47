"""Archives, toxicity, transcripts, components, and the pipeline over the small tables."""

import itertools
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from outlay.llm import common, queries, toxicity, transcripts, warc
from outlay.llm.common import components

SMALL = "/root/testdata/sf0.001"
PAGES = "page_id bigint, url string, html string, sha string, first string"


def test_components(spark):
    r = np.random.default_rng(4)
    edges = [(int(a), int(b)) for a, b in r.integers(0, 400, (260, 2))]
    edges += [(1000 + i, 1001 + i) for i in range(50)] + [(7, 7)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    want = {x: find(x) for e in edges for x in e if e[0] != e[1]}
    got = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r.node: r.root for r in got} == want and len(got) == len(want)
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_components_of_stars_take_half_a_round(spark, monkeypatch):
    written = []
    staged = common.staged
    monkeypatch.setattr(common, "staged", lambda df, name: written.append(name) or staged(df, name))
    edges = [(100 * i, 100 * i + j) for i in range(5) for j in range(1, 40)]
    got = common.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r.node: r.root for r in got} == {x: a for a, b in edges for x in (a, b)}
    assert written == ["edges", "least", "large", "least"]
    # the same where the minima are sent to nobody
    monkeypatch.setattr(common, "FEW_ROWS", -1)
    edges = [(i, i + 1) for i in range(9)] + [(20, 22), (21, 22), (20, 21)]
    got = common.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r.node: r.root for r in got} == {**dict.fromkeys(range(10), 0), 20: 20, 21: 20, 22: 20}


def test_pages_through_archives(spark):
    rows = [
        (1, "http://a/ b\r\nX: y", "<p>ä€</p>" * 4000, "s", "f"),
        (5, None, "<p>ä€</p>" * 4000, "s", "f"),
        (2, "u", None, "s", "f"), (3, "u", "", "s", "f"), (4, "u", "WARC/1.1\r\n\r\n\r\n", "s", "f"),
        (None, "u", "x", None, None), (7, "u", "x", None, None), (7, "u", "x", None, None),
        (6, "u", "x\r\n0\r\n\r\n", "s", "f"),
    ]
    got = warc.through_archives(spark.createDataFrame(rows, PAGES), segment=300).collect()
    first = defaultdict(lambda: 10**9)
    for i, _, html, *_ in rows:
        if i is not None:
            first[html or ""] = min(first[html or ""], i)
    want = []
    for i, _, html, *_ in rows:
        data = (html or "").encode()
        again = i is not None and first[html or ""] < i
        want.append((i, len(data), warc.digest(data), "revisit" if again else "response",
                     first[html or ""] if again else None))
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert warc.through_archives(spark.createDataFrame([], PAGES)).count() == 0


def test_page_ids_that_are_text(spark):
    ids = [" a b ", "a\r\nWARC-Type: revisit", "%41", "A", "", "ü:", "a" * 300]
    pages = spark.createDataFrame([(x, "u", "same", "", "") for x in ids], PAGES.replace("bigint", "string", 1))
    got = warc.through_archives(pages).collect()
    assert sorted(r.page_id for r in got) == sorted(ids)
    assert {r.refers_to for r in got if r.page_id != ""} == {""}


def test_short_payloads_are_not_revisited(spark):
    pages = spark.createDataFrame([(1, "u", "ab", "", ""), (2, "u", "ab", "", "")], PAGES)
    kinds = [r.record_type for r in warc.through_archives(pages, min_revisit=3).collect()]
    assert kinds == ["response", "response"]


@pytest.mark.parametrize("size", [1, 7, 4096])
def test_chunked_framing(size):
    payload = bytes(range(256)) * 20
    assert warc.unchunked(warc.chunked(payload, size)) == payload
    assert warc.unchunked(b"3;x=y\r\nabc\r\n0\r\nTrailer: z\r\n\r\n") == b"abc"
    for broken in (b"", b"zz\r\nabc\r\n", b"5\r\nabc\r\n0\r\n\r\n"):
        with pytest.raises(warc.WarcError):
            warc.unchunked(broken)


def test_segments_must_be_whole():
    block = warc.HTTP_HEAD + warc.chunked(b"payload " * 50)
    parts = [{"segment": 1, "total": None, "block": block[:100]},
             {"segment": 2, "total": len(block), "block": block[100:]}]
    assert warc.reassembled(parts, None) == b"payload " * 50
    for broken in (parts[1:], [*parts, parts[1]], [parts[0], parts[1] | {"total": 9}]):
        with pytest.raises(warc.WarcError):
            warc.reassembled(broken, None)


def _toxic(spark, n=600):
    r = np.random.default_rng(3)
    rows, labels = [], []
    for i in range(n):
        words = [f"w{x}" for x in r.integers(0, 3000, 60)]
        bad = i % 5 == 0
        if bad:
            for at in r.integers(0, 60, 3):
                words[at] = f"awful{'abcdefgh'[r.integers(8)]}"
        rows.append((i, " ".join(words), "own"))
        if i % 3 != 2:
            labels.append((i, int(bad)))
    rows += [(n, None, None), (n + 1, "", None), (None, "w1 w2", None), (0, rows[0][1], None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score string")
    return docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"), dict(labels)


def test_toxicity_on_held_out_rows(spark):
    docs, labels, truth = _toxic(spark)
    got = toxicity.score(docs, labels).collect()
    assert len(got) == docs.count()
    for r in got:
        text = "null" if r.doc_id is None else str(r.doc_id)
        assert r.held_out == (zlib.crc32(text.encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.95
    left = toxicity.drop_toxic(docs, labels)
    assert left.columns == docs.columns and 470 < left.count() < 500


@pytest.mark.parametrize("value", [0, 1, None])
def test_labels_of_one_kind_or_none(spark, value):
    docs, labels, _ = _toxic(spark, 20)
    same = labels.withColumn("toxic", F.lit(value).cast("int"))
    assert len({r.score for r in toxicity.score(docs, same).collect()}) == 1


def test_risk_is_never_driven_below_zero():
    positive = [np.array([1, 2]), np.array([1, 3]), np.array([1, 4])]
    weights, bias = toxicity.fit(positive, [np.array([9])] * 30, prior=0.1)
    assert weights[1] > 0 and bias < 0 and np.isfinite(weights).all()


def _conversations(spark):
    return spark.read.parquet(f"{SMALL}/conversations.parquet")


def test_transcripts_follow_the_best_path_however_they_are_cut(spark):
    turns = _conversations(spark)
    lines = transcripts.raw_lines(turns)
    model = transcripts._counts(lines)
    long = transcripts.raw_lines(
        turns.select(F.lit(7).cast("bigint").alias("conv_id"), "role", "text",
                     (F.col("conv_id") * 100 + F.col("turn")).alias("turn"))
    )
    for source in (lines, long):
        runs = defaultdict(list)
        for r in source.orderBy("conv_id", "place", "line").collect():
            runs[r.conv_id].append(r)
        want = {}
        for conv, run in runs.items():
            states = model.path([model.emissions(r.line) for r in run], None, None)
            for r, state in zip(run, states, strict=True):
                role, begins = transcripts.STATES[state]
                if begins:
                    want[now := (conv, r.place.turn, r.place.at)] = [role, []]
                want[now][1].append(transcripts.marker(r.line)[1] if begins else r.line)
        found = transcripts.parse(source.select("conv_id", "place", "line"), model).collect()
        have = {(r.conv_id, r.place.turn, r.place.at): [r.role, r.content.split("\n")] for r in found}
        assert have == want and len(found) == len(want)


def test_roles_of_held_out_conversations(spark):
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    got = {(r.conv_id, r.turn): r.role for r in transcripts.canonical(turns).where("line = 0").collect()}
    held = [r for r in turns.collect() if zlib.crc32(str(r.conv_id).encode()) % 5 == 0]
    assert sum(got.get((r.conv_id, r.turn)) == r.role for r in held) / len(held) > 0.85


def test_odd_conversations(spark):
    schema = "conv_id bigint, turn bigint, role string, text string, line string"
    rows = [(None, 0, "user", None, "x"), (1, None, None, "", "x"), (1, 0, "user", "Hi\nthere", "x"),
            (1, 0, "user", "Hi\nthere", "x"), (1, 1, "robot", "b" * 50000, "x")]
    found = transcripts.canonical(spark.createDataFrame(rows, schema)).collect()
    assert sum(r.n_lines for r in found) == 7
    assert all(r.rendered.startswith(f"<|im_start|>{r.role}\n") for r in found)
    assert transcripts.canonical(spark.createDataFrame([], schema)).count() == 0


def test_stages_keep_the_columns_and_the_clean_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    left, counts = docs, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, left, SMALL)
        assert left.columns == docs.columns
        counts.append(left.count())
    assert docs.count() >= counts[0] >= counts[1] >= counts[2] == counts[3] > 0.7 * docs.count()
    packed = corpus_pipeline.run(spark, SMALL)
    assert packed.select("doc_id").distinct().count() == counts[3]


def test_every_numbered_query_is_registered():
    assert [n.split("_")[0] for n in queries.queries()] == [f"op{i}" for i in range(1, 11)]


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_agree_with_their_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "pages"):
        db.sql(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    found = queries.queries()[name](spark, SMALL)
    columns = sorted(found.columns)
    want = db.sql(f"select {', '.join(columns)} from ({queries.oracle_sql()[name]})").fetchall()
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, found.select(columns).collect()), key=key) == sorted(want, key=key)


def test_long_pages_that_repeat_an_id_or_have_none(spark):
    long = "<p>ä€</p>" * 400
    rows = [(7, "u", long, "", "")] * 3 + [(None, "u", long, "", "")] * 2
    rows += [(8, "u", long, "", ""), (None, "v", long + "x", "", "")]
    got = warc.through_archives(spark.createDataFrame(rows, PAGES), segment=300).collect()
    have = sorted((str(r.page_id), r.payload_bytes, r.record_type, r.refers_to) for r in got)
    n = len(long.encode())
    assert have == [("7", n, "response", None)] * 3 + [("8", n, "revisit", 7)] + [
        ("None", n, "response", None)] * 2 + [("None", n + 1, "response", None)]


def test_toxicity_where_all_documents_are_labelled(spark):
    docs, _, _ = _toxic(spark)
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(600)], "doc_id bigint, toxic int")
    got = [r for r in toxicity.score(docs, labels).collect() if r.held_out and r.doc_id is not None]
    got = [r for r in got if r.doc_id < 600]
    assert sum(r.predicted == (r.doc_id % 5 == 0) for r in got) / len(got) > 0.95


def test_the_best_path_is_the_best_of_all_paths():
    n = len(transcripts.STATES)
    for seed in range(8):
        draw = np.random.default_rng(seed)
        model = transcripts.Markov(draw.integers(0, 9, n), draw.integers(0, 9, (n, n)), {})
        rows = list(draw.normal(size=(4, n)))

        def value(path, first, model=model, rows=rows):
            steps = sum(model.step[a, b] for a, b in itertools.pairwise(path))
            return first[path[0]] + steps + sum(r[s] for r, s in zip(rows, path, strict=True))

        paths = list(itertools.product(range(n), repeat=4))
        for entry in (None, 0, n - 1):
            first = model.start if entry is None else model.step[entry]
            scores = {p: value(p, first) for p in paths}
            best = max(scores.values())
            assert scores[tuple(model.path(rows, entry, None))] == pytest.approx(best)
            matrix = model.transfer(rows, opening=entry is None)
            for last in range(n):
                most = max(v for p, v in scores.items() if p[-1] == last)
                assert matrix[entry or 0, last] == pytest.approx(most)
                if np.isfinite(most):
                    found = tuple(model.path(rows, entry, last))
                    assert found[-1] == last and scores[found] == pytest.approx(most)


def test_control_marks_in_turns_are_content(spark):
    rng = random.Random(3)
    pieces = ["<|im_end|>", "<|im_start|>", "<\\|im_end|>", "<\\\\|im_start|>", "<", "\\", "|im_end|>", "\n", "user", "$1", ""]
    contents = ["".join(rng.choices(pieces, k=rng.randrange(9))) for _ in range(300)]
    rows = [(i, rng.choice(transcripts.ROLES), c) for i, c in enumerate(contents)]
    table = spark.createDataFrame(rows, "i int, role string, content string").withColumn(
        "one", transcripts.rendered(F.col("role"), F.col("content"))
    )
    for r in table.withColumn("back", transcripts.turns_of(F.col("one"))).collect():
        assert r.one.count("<|im_end|>") == 1 and r.one.count("<|im_start|>") == 1
        assert [(t.role, t.content) for t in r.back] == [(r.role, r.content)]
    whole = table.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "one"))),
                                               lambda x: x["one"]), "").alias("text"))
    back = whole.select(transcripts.turns_of(F.col("text")).alias("back")).first().back
    assert [(t.role, t.content) for t in back] == [r[1:] for r in rows]
