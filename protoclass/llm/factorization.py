"""Operator 5: quality classifier, a factorisation machine.

A text's features are its hashed words (weight: log of the count, brought to
unit length) and statistics of its structure and length, each in the bin it
falls in and as a value. The machine scores

    b + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2),

the pairwise terms by the identity of sums and squares, so in time linear in
the features. It is trained by Adagrad on mini-batches over a bounded sample:
at most ``TRAIN_ROWS`` labelled rows, those of the smallest hash of the id
(every labelled row while there are fewer). The model has a fixed size and
goes to the tasks that score whole texts, each document on its own.

Inputs of a score are the text and nothing else of the row: no label, lang,
source or id. Defined results: null and empty texts have the same features and
get a score like any; labels that are null or of unknown documents are not
learnt; a document with contradicting labels is learnt with each; with labels
of one kind, or none, scores are the (smoothed) share of label 1; repeated rows
each get a row; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from protoclass.llm.common import CACHES, WORDS, in_worker, table

#: Most labelled rows learnt from.
TRAIN_ROWS = 12_000
HASHED = 1 << 15
RANK = 8
EPOCHS = 12
BATCH = 256
RATE = 0.08
DECAY = 1e-5
SEED = 7
#: Bins of a statistic in [0, 1].
BINS = 8
STATISTICS = ("symbols", "upper", "digits", "repeats", "repeat_lines", "distinct", "word_length", "line_length", "length", "punctuation", "marks_alone")
FEATURES = HASHED + len(STATISTICS) * (BINS + 1)
HELD_FOLD = 1


class _Hashes(dict):
    """Word to hashed feature; bounded."""

    def __missing__(self, word: str) -> int:
        if len(self) > 400_000:
            self.clear()
        h = xxhash.xxh32_intdigest(word) % HASHED
        self[word] = h
        return h


_HASHES = _Hashes()
CACHES["factorization"] = _HASHES.clear


def _share(a: float, n: float) -> float:
    return min(1.0, a / n) if n else 0.0


def statistics(text: str, words: list[str], counts: Counter) -> list[float]:
    """The structure of a text, each value in [0, 1]."""
    n = len(words)
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    chars = sum(map(len, words))
    pairs = Counter(zip(words, words[1:], words[2:])) if n > 2 else {}
    return [
        math.sqrt(_share(sum(map(text.count, "#*$%&|<>@^~")), chars)),
        math.sqrt(_share(sum(map(str.isupper, words)), n)),
        math.sqrt(_share(sum(1 for w in words if w[0].isdigit()), n)),
        math.sqrt(_share(n - 2 - len(pairs), n)) if n > 2 else 0.0,
        math.sqrt(_share(len(lines) - len(set(lines)), len(lines))),
        _share(len(counts), n) ** 2,
        _share(math.log1p(chars / n), 4) if n else 0.0,
        _share(math.log1p(n / len(lines)), 8) if lines else 0.0,
        _share(math.log1p(n), 12),
        math.sqrt(_share(sum(map(text.count, ".,;:!?")), n)),
        math.sqrt(_share(sum(1 for w in words if not any(map(str.isalnum, w[:3]))), n)),
    ]


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(indices, values) of a text's features; an index may repeat (its values add up)."""
    words = WORDS.findall(text)
    counts = Counter(words)
    index = np.fromiter(map(_HASHES.__getitem__, counts), np.int64, len(counts))
    value = np.log1p(np.fromiter(counts.values(), np.float64, len(counts)))
    if len(value):
        value /= math.sqrt(float(value @ value))
    stats = statistics(text, words, counts)
    base = [HASHED + i * (BINS + 1) for i in range(len(stats))]
    bins = [b + min(BINS - 1, int(s * BINS)) for b, s in zip(base, stats, strict=True)]
    return (np.concatenate((index, np.array(bins + [b + BINS for b in base], np.int64))),
            np.concatenate((value, np.full(len(bins), 0.5), np.array(stats))))


@dataclass
class Model:
    bias: float
    weight: np.ndarray
    factor: np.ndarray

    def margin(self, index: np.ndarray, value: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Raw scores of documents whose features stand one after another."""
        linear = np.add.reduceat(self.weight[index] * value, starts)
        vx = self.factor[index] * value[:, None]
        sums, squares = np.add.reduceat(vx, starts, axis=0), np.add.reduceat(vx * vx, starts, axis=0)
        return self.bias + linear + 0.5 * (sums * sums - squares).sum(axis=1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> Model:
    """Adagrad on the logistic loss, both labels with equal total weight."""
    rng = np.random.default_rng(seed)
    model = Model(0.0, np.zeros(FEATURES), rng.normal(0, 0.02, (FEATURES, RANK)))
    n, ones = len(labels), float(labels.sum())
    if not 0 < ones < n:
        model.factor[:] = 0
        model.bias = math.log((ones + 1) / (n - ones + 1))
        return model
    # Between the labels' own shares and equal ones, so that 0.5 stays the likelier label.
    cost = np.where(labels == 1, math.sqrt(n / (2 * ones)), math.sqrt(n / (2 * (n - ones))))
    g_bias, g_weight, g_factor = 1e-6, np.full(FEATURES, 1e-6), np.full((FEATURES, RANK), 1e-6)
    for _ in range(epochs):
        order = rng.permutation(n)
        for a in range(0, n, BATCH):
            pick = order[a : a + BATCH]
            index = np.concatenate([rows[i][0] for i in pick])
            value = np.concatenate([rows[i][1] for i in pick])
            lengths = np.array([len(rows[i][0]) for i in pick])
            starts = np.cumsum(lengths) - lengths
            vx = model.factor[index] * value[:, None]
            sums, squares = np.add.reduceat(vx, starts, axis=0), np.add.reduceat(vx * vx, starts, axis=0)
            raw = model.bias + np.add.reduceat(model.weight[index] * value, starts) + 0.5 * (sums * sums - squares).sum(axis=1)
            error = (_sigmoid(raw) - labels[pick]) * cost[pick] / len(pick)
            each = np.repeat(error, lengths)
            used, inverse = np.unique(index, return_inverse=True)
            d_weight = np.bincount(inverse, each * value, len(used)) + DECAY * model.weight[used]
            grad = (each * value)[:, None] * (np.repeat(sums, lengths, axis=0) - vx)
            d_factor = np.stack([np.bincount(inverse, grad[:, f], len(used)) for f in range(RANK)], axis=1) + DECAY * model.factor[used]
            d_bias = float(error.sum())
            g_bias += d_bias * d_bias
            g_weight[used] += d_weight * d_weight
            g_factor[used] += d_factor * d_factor
            model.bias -= RATE * d_bias / math.sqrt(g_bias)
            model.weight[used] -= RATE * d_weight / np.sqrt(g_weight[used])
            model.factor[used] -= RATE * d_factor / np.sqrt(g_factor[used])
    return model


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3; null ids are of no fold."""
    return F.crc32(doc_id.cast("string")) % 3


def fit(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> Model:
    """A model from at most ``most`` labelled documents outside the held-out fold."""
    told = (labels.select(F.col("doc_id").cast("bigint").alias("_id"), F.col("quality").cast("int").alias("_label"))
            .filter(F.col("_label").isin(0, 1) & (fold(F.col("_id")) != HELD_FOLD)))
    # TRAIN_ROWS rows of two numbers: a bounded broadcast.
    sample = told.orderBy(F.xxhash64(F.lit(SEED), "_id"), "_id", "_label").limit(most)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [features(t or "") for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("_label"), pa.array([i.astype("<u4").tobytes() for i, _ in made], pa.binary()),
                 pa.array([v.astype("<f4").tobytes() for _, v in made], pa.binary())], names=["doc_id", "label", "index", "value"])

    chosen = texts.join(F.broadcast(sample), F.col("doc_id") == F.col("_id")).select("doc_id", "text", "_label")
    learnt = chosen.mapInArrow(in_worker("factorization", run), "doc_id bigint, label int, index binary, value binary")
    # Copies of an id can make the join longer than the sample: the bound holds for what comes here, too.
    rows = learnt.orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id", "label", F.xxhash64("index", "value")).limit(most).collect()
    made = [(np.frombuffer(r["index"], "<u4").astype(np.int64), np.frombuffer(r["value"], "<f4").astype(np.float64)) for r in rows]
    return train(made, np.array([r["label"] for r in rows], np.float64))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast((model.bias, model.weight.astype(np.float32), model.factor.astype(np.float32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*sent.value)
        for b in batches:
            scores = np.zeros(b.num_rows)
            texts = b.column("text").to_pylist()
            at = 0
            while at < len(texts):
                made, held, a = [], 0, at
                while at < len(texts) and held < 200_000:
                    made.append(features(texts[at] or ""))
                    held += len(made[-1][0])
                    at += 1
                lengths = np.array([len(i) for i, _ in made])
                raw = m.margin(np.concatenate([i for i, _ in made]), np.concatenate([v for _, v in made]), np.cumsum(lengths) - lengths)
                scores[a:at] = _sigmoid(raw)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                                             names=["doc_id", "held_out", "score", "predicted"])

    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(fold(F.col("doc_id").cast("bigint")) == HELD_FOLD, F.lit(False)).alias("held_out"),
                         F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(in_worker("factorization", run), "doc_id bigint, held_out boolean, score double, predicted int")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))
