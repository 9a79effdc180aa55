"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A text's features are the distinct hashes of its lower-cased character n-grams.  From labelled
texts come r = log of the ratio of a feature's share among toxic and other texts; a logistic
regression is then trained on the features scaled by r, so the weight of a feature is w * r.

Training reads a sample of the labelled texts of either class, bounded in number and characters and chosen by a hash of their
id; their features are found by the executors, the fit of a weight vector of fixed size runs on the driver.
Scoring reads every text whole and holds the weights only (2**BITS floats).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .sparkops import Scratch, own_columns, row_key, without
from .textops import seeded

BITS = 18
SIZES = (3, 4, 5)
#: Largest number of labelled texts of a class that are used for the fit.
SAMPLE = 2000
#: Most characters of one text that is used for the fit, and of those of a class together.
LONGEST, SAMPLE_CHARS = 100_000, 4_000_000
#: Features that the fit takes at a time.
BLOCK = 1_000_000

_MULTIPLIERS = seeded(8, 51).astype(np.uint32) | np.uint32(1)


def features(text: str) -> np.ndarray:
    """The sorted distinct feature numbers of a text; white space counts as one space, also at both ends."""
    letters = np.frombuffer((" " + " ".join(text.lower().split()) + " ").encode("utf-32-le", "replace"), np.uint32)
    seen = np.zeros(1 << BITS, bool)
    run = np.zeros(len(letters), np.uint32)
    for n in range(1, max(SIZES) + 1):
        if len(letters) < n:
            break
        run = (run[: len(letters) - n + 1] * np.uint32(0x01000193) ^ letters[n - 1 :]) * _MULTIPLIERS[0]
        if n in SIZES:
            h = (run ^ (run >> np.uint32(15))) * _MULTIPLIERS[n]
            seen[h >> np.uint32(32 - BITS)] = True
    return np.flatnonzero(seen).astype(np.int32)


@dataclass(frozen=True)
class Model:
    """score = 1 / (1 + exp(-(weights over the features + bias)))."""

    weights: np.ndarray
    bias: float

    def score(self, text: str) -> float:
        z = float(self.weights[features(text)].sum()) + self.bias
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def _blocks(rows: list[np.ndarray]) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Feature lists joined in blocks of BLOCK features or so: (first row, features, where each row begins)."""
    out, lo = [], 0
    sizes = np.array([len(x) for x in rows])
    while lo < len(rows):
        hi = max(lo + 1, lo + int(np.searchsorted(np.cumsum(sizes[lo:]), BLOCK)))
        out.append((lo, np.concatenate(rows[lo:hi]), np.r_[0, np.cumsum(sizes[lo:hi])[:-1]]))
        lo = hi
    return out


def _spread(values: np.ndarray, index: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Each text's value at each of its features."""
    return np.repeat(values, np.diff(np.r_[starts, len(index)]))


def fit(rows: list[np.ndarray], labels: np.ndarray, smooth: float = 1.0, l2: float = 2e-4, rounds: int = 100) -> Model:
    """The log-count ratios, then the regression: mean logistic loss, both classes of equal weight, and l2 / 2 times the squared
    weights, minimised by accelerated gradient steps whose length is the inverse of the loss's largest curvature (by power iteration).
    """
    size = 1 << BITS
    if not len(rows) or labels.min() == labels.max():
        share = float(np.clip(labels.mean() if len(rows) else 0.0, 0.001, 0.999))
        return Model(np.zeros(size, np.float32), float(np.log(share / (1 - share))))
    n, y = len(rows), labels.astype(np.float64)
    blocks = _blocks(rows)
    p, q = np.full(size, smooth), np.full(size, smooth)
    for lo, index, starts in blocks:
        toxic = np.bincount(index, _spread(y[lo : lo + len(starts)], index, starts), size)
        p += toxic
        q += np.bincount(index, minlength=size) - toxic
    # shares of texts, so that a feature as common in both kinds has ratio 0
    r = np.log(p / (y.sum() + 2 * smooth)) - np.log(q / ((1 - y).sum() + 2 * smooth))
    balance = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))

    def sums(weights: np.ndarray) -> np.ndarray:
        """The sum of a text's weights, for every text."""
        scaled = weights * r
        return np.concatenate([np.add.reduceat(scaled[index], starts) for _, index, starts in blocks])

    def back(values: np.ndarray) -> np.ndarray:
        """The mean over the texts of a value at each of their features."""
        out = np.zeros(size)
        for lo, index, starts in blocks:
            out += np.bincount(index, _spread(values[lo : lo + len(starts)], index, starts), size)
        return out * r / n

    v = np.ones(size)
    for _ in range(8):
        v /= np.sqrt((v * v).sum())
        v = back(balance * sums(v))
    step = 1 / (0.25 * 1.1 * float(np.sqrt((v * v).sum())) + l2)
    w, bias, at, at_bias, last, last_bias = (np.zeros(size), 0.0, np.zeros(size), 0.0, np.zeros(size), 0.0)
    for t in range(1, rounds + 1):
        error = (1 / (1 + np.exp(-np.clip(sums(at) + at_bias, -500, 500))) - y) * balance
        w, bias = at - step * (back(error) + l2 * at), at_bias - 2 * error.mean()
        at, at_bias = w + (t - 1) / (t + 2) * (w - last), bias + (t - 1) / (t + 2) * (bias - last_bias)
        last, last_bias = w, bias
    return Model((w * r).astype(np.float32), float(bias))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", learn: str = "true", sample: int = SAMPLE, sample_chars: int = SAMPLE_CHARS, longest: int = LONGEST) -> Model:
    """Fits a model on labelled texts whose id meets the SQL condition `learn` (on column doc_id).

    At most `sample` texts of each class take part, of `longest` characters at most each and `sample_chars` in all: those first in
    the order of a hash of the id.  A text of c characters has 3 c features at most, of four bytes each: that bounds what comes to the driver.
    Null ids, labels and texts don't take part; of an id's repeated labels the largest counts, of its texts the least.
    """
    labels = labels.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("label")).filter("doc_id is not null and label is not null").filter(learn)
    labels = labels.groupBy("doc_id").agg((F.max("label") > 0).alias("label"))
    order = F.xxhash64("doc_id")
    chosen = None
    for kind in (True, False):
        part = labels.filter(F.col("label") == F.lit(kind)).orderBy(order, "doc_id").limit(sample)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = own_columns(docs, doc_id=id_col, text=text_col).filter("text is not null").withColumn("doc_id", F.col("doc_id").cast("long"))
    rows = texts.join(F.broadcast(chosen), "doc_id").filter(F.length("text") <= longest)
    rows = rows.groupBy("doc_id", "label").agg(F.min("text").alias("text"))  # an id may stand in any number of rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = part.column(2).to_pylist()
                found = [features(t).tobytes() for t in texts]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([len(t) for t in texts], pa.int32()), pa.array(found, pa.binary())], ["doc_id", "label", "chars", "found"])

    each = Scratch(docs.sparkSession, "toxicity").store(rows.mapInArrow(run, "doc_id long, label boolean, chars int, found binary"), "sample")
    # at most 2 * sample rows
    so_far = F.sum("chars").over(Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id", "chars", F.xxhash64("found")).rowsBetween(Window.unboundedPreceding, 0))
    got = each.withColumn("so_far", so_far).filter(F.col("so_far") <= sample_chars).select("doc_id", "label", "found").toArrow()
    labelled = [x for x in zip(got["doc_id"].to_pylist(), got["label"].to_pylist(), (np.frombuffer(x.as_py(), np.int32) for x in got["found"]), strict=True) if len(x[2])]
    del got
    labelled.sort(key=lambda x: (x[0], len(x[2])))  # the fit doesn't depend on the order of tasks
    return fit([x for _, _, x in labelled], np.array([label for _, label, _ in labelled], np.float64))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted) for every row; a null text counts as empty, repeated rows and null ids stay."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # of a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sent.value.score(t.as_py() or "") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64()), pa.array([int(x >= 0.5) for x in found], pa.int32())], ["doc_id", "score", "predicted"])

    docs = own_columns(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    return docs.mapInArrow(run, "doc_id long, score double, predicted int")


#: The fold that a classifier never learns from.
HELD_OUT = "crc32(cast(doc_id as string)) % 5 = 0"


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Trains outside the held-out fold and scores all texts: doc_id, held_out, score, predicted.

    Without usable labels of both classes every text gets the share of toxic labels (near 0 without any).
    """
    model = train(docs, labels, id_col, text_col, learn=f"NOT ({HELD_OUT})")
    return score(docs, model, id_col, text_col).select("doc_id", F.expr(HELD_OUT).alias("held_out"), "score", "predicted")


def keep_clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns, whose text isn't predicted toxic; null ids and texts under one id are judged by their text, too."""
    model = train(docs, labels, id_col, text_col, learn=f"NOT ({HELD_OUT})")
    rows = docs.select(row_key(id_col, text_col).alias("rid"), F.col(f"`{text_col}`").alias("text"))
    return without(docs, score(rows, model, "rid", "text").filter("predicted = 1").select("doc_id"), row_key(id_col, text_col))
