"""Toxicity by a linear classifier over character n-grams, scaled by naive Bayes log-count ratios.

Training. From the labelled texts a sample of at most ``Training.most_texts`` rows is drawn by a hash of the id. Tasks
count, for each hashed n-gram, the toxic and the other texts that hold it; the log ratio of the smoothed shares is the
feature's scale. The ``most_features`` n-grams whose ratio is best supported make up the model; a text's counts of them,
brought to one length for all texts and times their scales, are the features of a logistic regression. What reaches the
driver is bounded by the number of features.

Scoring. Every whole text is scored inside a task, with the weights in one table of hash buckets. N-grams are taken over
the characters of the lower-cased text in which any run of other characters than letters and digits is one blank, with a
blank at both ends, so they see the ends of words. Only the text is an input of the score.

An empty or null text holds no n-gram and has the score of the intercept. Without rows of both labels, or without an
n-gram that enough texts hold, the score is the share of label 1, smoothed. Of several labels of one id the largest counts; null labels do not. Repeated rows are scored
each. Columns beside those named are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloom.session import written

BUCKETS = 1 << 20
SIZES = range(4, 8)
LENGTH = 5.0  # of a text's vector of counts
LETTERS = np.array([chr(i).isalnum() for i in range(1 << 16)])


@dataclass(frozen=True)
class Training:
    most_texts: int = 20_000
    most_features: int = 20_000
    least_texts: int = 3  # an n-gram counts from so many texts on
    smoothing: float = 1.0
    penalty: float = 0.001
    rounds: int = 60


@dataclass(frozen=True)
class Model:
    buckets: np.ndarray
    weights: np.ndarray
    intercept: float


def ngrams(text: str | None) -> np.ndarray:
    """The hash buckets of all n-grams of a text, with repeats."""
    points = np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.where(LETTERS[np.minimum(points, len(LETTERS) - 1)] | (points >= len(LETTERS)), points, np.uint32(32))
    points = points[np.append(True, (points[1:] != 32) | (points[:-1] != 32))]
    if len(points) < 2:
        return np.zeros(0, np.uint32)
    rolled, out = points.copy(), []
    for size in range(2, min(SIZES[-1], len(points)) + 1):
        rolled = rolled[:-1] * np.uint32(0x01000193) + points[size - 1 :]
        if size in SIZES:
            mixed = (rolled ^ (rolled >> np.uint32(15))) * np.uint32(0x85EBCA6B)
            mixed = (mixed ^ (mixed >> np.uint32(13))) * np.uint32(0xC2B2AE35)
            out.append(mixed >> np.uint32(32 - BUCKETS.bit_length() + 1))
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def features(at: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The model's features among n-grams and their counts as a vector of one length. ``place``: by bucket, or -1."""
    held = place[at]
    found, counts = np.unique(held[held >= 0], return_counts=True)
    return found, counts * (LENGTH / max(1e-9, float(np.sqrt((counts.astype(np.float64) ** 2).sum()))))


def places(buckets: np.ndarray) -> np.ndarray:
    """The place of each hash bucket among the model's, or -1."""
    place = np.full(BUCKETS, -1, np.int32)
    place[buckets] = np.arange(len(buckets))
    return place


def sample(labelled: DataFrame, most: int) -> DataFrame:
    """At most about ``most`` rows of ``(id, text, y)``, chosen by a hash of the id."""
    rows = labelled.count()
    if rows <= most:
        return labelled
    part = int(most / rows * 2**31)
    return labelled.where(F.pmod(F.xxhash64("id", F.lit("toxicity")), F.lit(2**31)) < part)


def _counts(rows: DataFrame) -> DataFrame:
    """Toxic and other texts by n-gram; bucket -1 counts the texts themselves."""

    def count(batches):
        held = np.zeros((2, BUCKETS), np.int32)
        texts = [0, 0]
        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held[y, np.unique(ngrams(text))] += 1
                texts[y] += 1
        some = np.flatnonzero(held.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(some, -1), pa.int32()), pa.array(np.append(held[0, some], texts[0]), pa.int64()),
             pa.array(np.append(held[1, some], texts[1]), pa.int64())],
            names=["bucket", "n0", "n1"],
        )

    return (
        rows.select("text", "y").mapInArrow(count, "bucket int, n0 long, n1 long")
        .groupBy("bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    )


def _vectors(rows: DataFrame, buckets: np.ndarray, scale: np.ndarray) -> DataFrame:
    """``(y, features)``: the scaled counts of the model's n-grams in each text."""

    def vectors(batches):
        place = places(buckets)
        for batch in batches:
            ys, index, value = [], [], []
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                at, counts = features(ngrams(text), place)
                ys.append(float(y))
                index.append(at)
                value.append(scale[at] * counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ys, pa.float64()), pa.array(index, pa.list_(pa.int32())), pa.array(value, pa.list_(pa.float64()))],
                names=["y", "at", "value"],
            )

    size = len(buckets)
    to_vector = F.udf(lambda at, value: SparseVector(size, at, value), VectorUDT())
    packed = rows.select("text", "y").mapInArrow(vectors, "y double, at array<int>, value array<double>")
    return packed.select("y", to_vector("at", "value").alias("features"))


def fit(labelled: DataFrame, how: Training = Training()) -> Model:
    """A model from ``(id, text, y)`` with y 0 or 1."""
    rows = written(sample(labelled, how.most_texts), "labelled_texts")
    counts = written(_counts(rows), "ngram_counts")
    n0, n1 = counts.where("bucket = -1").agg(F.sum("n0"), F.sum("n1")).first()
    n0, n1 = n0 or 0, n1 or 0
    share = (n1 + how.smoothing) / (n0 + n1 + 2 * how.smoothing)
    nothing = Model(np.zeros(0, np.int64), np.zeros(0), float(np.log(share / (1 - share))))
    if not n0 or not n1:
        return nothing
    a = how.smoothing
    ratio = F.log((F.col("n1") + a) / (n1 + 2 * a)) - F.log((F.col("n0") + a) / (n0 + 2 * a))
    spread = F.sqrt(1 / (F.col("n1") + a) + 1 / (F.col("n0") + a))
    chosen = (
        counts.where((F.col("bucket") >= 0) & (F.col("n0") + F.col("n1") >= how.least_texts))
        .select("bucket", ratio.alias("r"), F.abs(ratio / spread).alias("support"))
        .orderBy(F.desc("support"), "bucket").limit(how.most_features).orderBy("bucket").collect()
    )
    if not chosen:
        return nothing
    buckets, scale = np.array([c["bucket"] for c in chosen], np.int64), np.array([c["r"] for c in chosen])
    training = written(_vectors(rows, buckets, scale), "training_vectors")
    learner = LogisticRegression(
        featuresCol="features", labelCol="y", maxIter=how.rounds, regParam=how.penalty, standardization=False
    )
    fitted = learner.fit(training)
    return Model(buckets, scale * fitted.coefficients.toArray(), float(fitted.intercept))


def scored(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``score``, the probability of label 1, for every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the number of features

    def score(batches):
        model, place = shared.value, places(shared.value.buckets)
        for batch in batches:
            out = np.empty(batch.num_rows)
            for i, text in enumerate(batch.column(1)):
                at, counts = features(ngrams(text.as_py()), place)
                out[i] = float(model.weights[at] @ counts) + model.intercept
            out = 1 / (1 + np.exp(-np.clip(out, -700, 700)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out)], names=[key, "score"])

    schema = T.StructType([T.StructField(key, docs.schema[key].dataType), T.StructField("score", T.DoubleType())])
    return docs.select(F.col(f"`{key}`").alias(key), F.col(f"`{text}`").alias("text")).mapInArrow(score, schema)


def held_out(key: Column) -> Column:
    """Whether a row's label is kept from training."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string")), F.lit(3)) == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> DataFrame:
    """``(id, text, y)`` of the labelled rows that are not held out."""
    known = labels.where(F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").alias("id")).agg(F.max(label).cast("int").alias("y")).where("y IN (0, 1)")
    return docs.select(F.col("doc_id").alias("id"), "text").join(known, "id").dropDuplicates(["id"])
