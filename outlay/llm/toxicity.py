"""Toxicity by non-negative positive-unlabelled learning, with numpy."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outlay.llm.common import SMALL_BYTES, arrow_rows, measured, same_row, staged, text_of, without

FOLDS = 5  # rows whose crc32(id as text) mod FOLDS is 0 are held out
MAX_POSITIVE, MAX_UNLABELLED = 3000, 6000  # documents a classifier is fitted on, about, at most
MAX_CALIBRATION = 20_000  # labelled documents whose scores set its scale, about, at most
DIMENSIONS = 1 << 20
MIN_POSITIVE = 3  # confirmed documents that must hold a feature
MIN_Z, MIN_RATIO = 4.0, 3.0  # how clearly it must be more frequent there than in unlabelled text
PREFIX = 4  # letters of a word's stem
ROWS_AT_ONCE = 128
WORD = re.compile(r"[^\W\d_]+")
KNOWN_WORDS = 400_000


def features(word: str) -> tuple[int, int]:
    """A word counts as itself and by its first letters."""
    return (
        zlib.crc32(word.encode()) % DIMENSIONS,
        zlib.crc32(b"^" + word[:PREFIX].encode()) % DIMENSIONS,
    )


def words(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


@dataclass
class Classifier:
    """Weights by feature, bias, and the scale on which 0 stands for probability one half."""

    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def margins(self, texts: list[str], known: dict[str, float]) -> np.ndarray:
        """Sum of the weights of a text's distinct words; ``known`` keeps those of words."""
        if len(known) > KNOWN_WORDS:
            known.clear()
        out = np.full(len(texts), self.bias)
        for i, text in enumerate(texts):
            total = 0.0
            for word in words(text):
                value = known.get(word)
                if value is None:
                    a, b = features(word)
                    value = known[word] = float(self.weights[a] + self.weights[b])
                total += value
            out[i] += total
        return out

    def scores(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.shift, -30, 30)))


def telling(positive: list[np.ndarray], unlabelled: list[np.ndarray]) -> np.ndarray:
    """Features that confirmed documents hold clearly more often than unlabelled ones do."""
    n, m = max(len(positive), 1), max(len(unlabelled), 1)
    p, u = np.zeros(DIMENSIONS), np.zeros(DIMENSIONS)
    for seen, documents in ((p, positive), (u, unlabelled)):
        for x in documents:
            seen[np.unique(x)] += 1
    pooled = (p + u) / (n + m)
    error = np.sqrt(np.maximum(pooled * (1 - pooled), 1e-12) * (1 / n + 1 / m))
    clear = (p / n - u / m) / error >= MIN_Z
    return np.flatnonzero(clear & (p >= MIN_POSITIVE) & (p / n >= MIN_RATIO * u / m))


def fit(
    positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float,
    steps: int = 250, rate: float = 0.05, decay: float = 1e-4,
) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear classifier that minimise the non-negative risk.

    With loss l, class prior p and margins f, the risk is

        p * mean_P l(f) + max(0, mean_U l(-f) - p * mean_P l(-f))

    The second term is the risk of negatives, estimated without any; it cannot truly be negative,
    so where the estimate is, the step goes the other way until it no longer is.
    """
    kept = telling(positive, unlabelled)
    weights = np.zeros(DIMENSIONS)
    if not positive or not unlabelled or not len(kept):
        return weights, float(np.log(max(prior, 1e-6) / max(1 - prior, 1e-6)))
    place = np.full(DIMENSIONS, -1)
    place[kept] = np.arange(len(kept))
    sides = []
    for documents in (positive, unlabelled):
        sizes = np.array([len(x) for x in documents])
        flat = place[np.concatenate(documents)]
        owner = np.repeat(np.arange(len(documents)), sizes)[flat >= 0]
        sides.append((owner, flat[flat >= 0], len(documents)))
    w, b = np.zeros(len(kept)), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(len(kept) + 1), np.zeros(len(kept) + 1)

    def sigmoid(x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))

    def slope(side: tuple, g: np.ndarray) -> np.ndarray:
        owner, flat, n = side
        out = np.bincount(flat, g[owner], minlength=len(kept)) / n
        return np.append(out, g.mean())

    for step in range(1, steps + 1):
        fp, fu = (b + np.bincount(o, w[i], minlength=n) for o, i, n in sides)
        negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        against = slope(sides[1], sigmoid(fu)) - prior * slope(sides[0], sigmoid(fp))
        if negative >= 0:
            g = prior * slope(sides[0], -sigmoid(-fp)) + against
        else:
            g = -against
        g[:-1] += decay * w
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w -= move[:-1]
        b -= float(move[-1])
    weights[kept] = w
    return weights, b


def scale(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift that make the margins log odds (Platt), by Newton steps."""
    if len(set(labels.tolist())) < 2:
        return 1.0, 0.0
    centre, spread = margins.mean(), margins.std() or 1.0
    x = np.stack([(margins - centre) / spread, np.ones(len(margins))], 1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (labels - p) - 1e-3 * beta)
        beta += np.clip(step, -5, 5)
    slope = max(beta[0], 1e-3) / spread
    return float(slope), float(beta[1] - slope * centre)


def fold(key: str) -> Column:
    """crc32 of the id as text, mod ``FOLDS``; a null id counts as the text ``null``."""
    text = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    return F.crc32(text.cast("binary")) % FOLDS


def _share(rows: int, most: int) -> Column:
    """Keeps about ``most`` of ``rows`` rows: those whose hashed id falls below a bound."""
    part = min(1.0, most / max(rows, 1))
    return F.pmod(F.xxhash64("_id", F.lit("sample")), F.lit(1 << 30)) < int(part * (1 << 30))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> Classifier:
    """A classifier from the labels (``key``, ``toxic``) of the rows that are not held out.

    Confirmed toxic documents and texts without a label (where those are too few, labelled ones as
    well, without regard to their labels), at most about ``MAX_POSITIVE`` and
    ``MAX_UNLABELLED`` of them chosen by hashes of their ids, are all it is fitted on; the class
    prior is the share of toxic ones among all labels. About ``MAX_CALIBRATION`` labelled documents
    then set its scale. Features of the chosen documents come to the driver, which is what these
    bounds are for; texts do not. Where nothing is labelled toxic or all is, the classifier knows
    only the prior.
    """
    known = (
        labels.where(F.col("toxic").isNotNull())
        .select(F.col(key).alias("_id"), F.col("toxic").cast("int").alias("_toxic"))
        .where(F.col("_id").isNotNull() & (fold("_id") != 0))
        .groupBy("_id")
        .agg(F.max("_toxic").alias("_toxic"))
    )
    known = staged(known, "labels")
    n, toxic = known.agg(F.count(F.lit(1)), F.sum("_toxic")).first()
    toxic = toxic or 0
    if not toxic or toxic == n:
        prior = 0.5 if not n else min(max(toxic / n, 1e-3), 1 - 1e-3)
        bias = float(np.log(prior / (1 - prior)))
        return Classifier(np.zeros(DIMENSIONS), bias)
    texts = docs.select(F.col(key).alias("_id"), text_of("text").alias("_text")).where(
        F.col("_id").isNotNull() & (fold("_id") != 0)
    )
    chosen = known.where(
        ((F.col("_toxic") == 1) & _share(toxic, MAX_POSITIVE)) | _share(n, MAX_CALIBRATION)
    ).select("_id", "_toxic", F.when(F.col("_toxic") == 1, _share(toxic, MAX_POSITIVE))
             .otherwise(False).alias("_fit"))
    ids = known.select("_id").hint("merge")
    free, rest = texts.join(ids, "_id", "left_anti"), texts.join(ids, "_id", "left_semi")
    n_free = free.count()
    free = free.where(_share(n_free, MAX_UNLABELLED))
    if n_free < MAX_UNLABELLED:  # labelled texts, their labels unread, make up for the others
        free = free.unionByName(rest.where(_share(rest.count(), MAX_UNLABELLED - n_free)))
    labelled = staged(
        texts.join(measured(chosen, SMALL_BYTES), "_id").select("_toxic", "_fit", "_text"),
        "labelled",
    )
    positive = labelled.where("_fit").select("_text")
    prior = toxic / n
    weights, bias = fit(
        _features_of(positive),
        _features_of(free.select("_text")),
        prior,
    )
    model = Classifier(weights, bias)
    sample = _margins(labelled.select("_toxic", "_text"), model).toPandas()
    model.slope, model.shift = scale(
        sample["margin"].to_numpy(float), sample["_toxic"].to_numpy(float)
    )
    return model


def _features_of(texts: DataFrame) -> list[np.ndarray]:
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_rows(batches, ROWS_AT_ONCE):
            rows = [
                np.array([f for w in words(t) for f in features(w)], np.int32)
                for t in batch.column(0).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.int32()))], ["features"])

    found = texts.mapInArrow(extract, "features array<int>").toArrow()
    return [np.asarray(x.values, np.int32) for x in found.column("features")]


def _margins(rows: DataFrame, model: Classifier) -> DataFrame:
    """``rows`` with the column ``margin`` in place of ``_text``. The model, a few MB whatever the
    data, is sent to every executor once."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast((model.weights.astype(np.float32), model.bias))
    names = [c for c in rows.columns if c != "_text"]
    schema = rows.select(*names, F.lit(0.0).alias("margin")).schema

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier, known = Classifier(*shared.value), {}
        for batch in arrow_rows(batches, ROWS_AT_ONCE):
            margins = classifier.margins(batch.column("_text").to_pylist(), known)
            columns = [batch.column(c) for c in names] + [pa.array(margins)]
            yield pa.RecordBatch.from_arrays(columns, [*names, "margin"])

    return rows.mapInArrow(apply, schema)


def score(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per document: ``key``, ``held_out``, ``score`` (0 to 1), ``predicted``, ``_id`` and
    ``_text`` (see :func:`common.same_row`).

    Only texts are scored; a null text is the empty one and, like a text without words, gets what
    the bias alone says. Held out are documents whose crc32(id as text) mod ``FOLDS`` is 0; their
    labels are not looked at. Rows may repeat; a null id counts as the text ``null``.
    """
    model = train(docs, labels, key)
    rows = docs.select(
        F.col(key).alias("_key"), (fold(key) == 0).alias("held_out"),
        F.struct(*same_row(key)).alias("_same"), text_of("text").alias("_text"),
    )
    chance = 1 / (1 + F.exp(-(F.col("margin") * model.slope + model.shift)))
    return (
        _margins(rows, model)
        .withColumn("score", chance)
        .select(
            F.col("_key").alias(key), "held_out", "score",
            (F.col("score") >= 0.5).cast("int").alias("predicted"),
            "_same._id", "_same._text",
        )
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows predicted toxic, all columns as they are."""
    gone = score(docs, labels).where("predicted = 1").select("_id", "_text").distinct()
    return without(docs, staged(gone, "toxic"))
