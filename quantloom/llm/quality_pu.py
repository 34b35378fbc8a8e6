"""Quality by positive-unlabelled learning: trusted positives, all text as unlabelled, an estimated class prior.

One pass over the texts gives each document a short row of statistics (`STATS`); everything after it reads these rows.
They are standardised over all documents, and each enters as itself and as its distance from the mean.

Positives are documents of the training fold that are labelled 1 and never 0; unlabelled are all documents, whose labels
aren't looked at. A first model tells positives from unlabelled ones. Its scores give the prior: above no threshold can the share of
unlabelled documents be less than the prior times that of positives, so the least such ratio, with its
sampling error added, bounds it. The second model minimises the unbiased risk with the logistic loss,

    prior * E+[loss(z)] + max(0, E[loss(-z)] - prior * E+[loss(-z)]),

whose unclamped form is convex: Newton steps, each one job over all rows with sums that combine within tasks. The clamped
term estimates the risk of negatives; a step that takes it below zero is halved, and where halving doesn't help
learning ends, so that it never follows an estimate which a risk can't have.

Cases: null and empty texts have statistics of zero words. Without trusted positives every score is 0.5. Long texts are
measured whole. Repeated rows give repeated rows; an id's labels count for each of its rows. A null id is never held out and has
no label. Of the documents only id and text are read. An empty table gives an empty result.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from .common import cut, in_batches, owned, slices

#: Shares unless said otherwise, so that long and short texts compare.
STATS = ["words_log", "marks", "symbols", "digits", "capitals", "word_length", "distinct_words", "repeated_windows", "same_neighbours", "short_words", "capital_words", "marked_words", "lines_ended", "repeated_lines", "words_a_line_log", "compressed"]

#: Bytes by kind: letters that are capital, digits, symbols of markup, other marks.
KINDS = np.zeros(256, np.uint8)
for kind, chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&|<>{}[]\\^~=_@+/", b"!\"'(),-.:;?`"), 1):
    KINDS[list(chars)] = kind
ENDS = (".", "!", "?", ":", ";", '"', "'", ")")


def statistics(text: str) -> list[float]:
    raw = text.encode("utf-8", "replace")
    words = text.split()
    n, chars = len(words), sum(map(len, words))
    _, capitals, digits, symbols, marks = (np.bincount(KINDS[np.frombuffer(raw, np.uint8)], minlength=5) / max(chars, 1)).tolist()
    hashed = np.fromiter(map(hash, words), np.int64, n)
    windows = hashed.copy()
    for _ in range(4):  # five words
        windows = windows[:-1] * np.int64(31) + hashed[len(hashed) - len(windows) + 1 :] if len(windows) > 1 else windows[:0]
    lines = [s for x in text.split("\n") if (s := x.strip())]
    m = max(len(lines), 1)
    some = max(n, 1)
    return [
        float(np.log1p(n)), marks, symbols, digits, capitals, chars / some, len(np.unique(hashed)) / some,
        1 - len(np.unique(windows)) / max(len(windows), 1) if len(windows) else 0.0,
        float((hashed[1:] == hashed[:-1]).sum()) / some, sum(len(w) < 4 for w in words) / some,
        sum(w[0].isupper() for w in words) / some, sum(not w[-1].isalnum() for w in words) / some,
        sum(x.endswith(ENDS) for x in lines) / m, 1 - len(set(lines)) / m if lines else 0.0,
        float(np.log1p(n / m)), min(len(zlib.compress(raw, 1)) / max(len(raw), 1), 1.5) if raw else 0.0,
    ]


def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    with np.errstate(over="ignore"):
        for b in slices(batches):
            rows = np.array([statistics(t or "") for t in b.column(1).to_pylist()]).ravel()
            offsets = np.arange(0, len(rows) + 1, len(STATS), dtype=np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(offsets, pa.array(rows))], names=["id", "stats"])


@dataclass
class Model:
    """A linear function of the expanded statistics."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def inputs(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -6, 6)
        return np.concatenate([np.ones((len(z), 1)), z, np.abs(z)], 1)

    def __call__(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(self.inputs(stats) @ self.weights, -30, 30)


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def summed(rows: DataFrame, of: Callable[[np.ndarray, np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """The sum over all rows of a vector that `of` makes from statistics and times trusted; at most `size` rows a task are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for b in batches:
            if b.num_rows:
                total += of(matrix(b.column(0)), b.column(1).to_numpy(zero_copy_only=False).astype(float))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], names=["at", "value"])

    out = np.zeros(size)
    for r in in_batches(rows.select("stats", "trusted"), run, "at long, value double").groupBy("at").agg(F.sum("value").alias("value")).collect():
        out[r.at] = r.value
    return out


@dataclass
class Terms:
    """Losses, gradients and the Hessian of either model at its weights, as one vector."""

    model: Model
    telling: bool  # the first model: positives against unlabelled

    def __call__(self, stats: np.ndarray, trusted: np.ndarray) -> np.ndarray:
        x = self.model.inputs(stats)
        z = np.clip(x @ self.model.weights, -30, 30)
        p = 1 / (1 + np.exp(-z))
        up, down = np.logaddexp(0, z), np.logaddexp(0, -z)  # losses of calling a negative and a positive by z
        mine = [trusted @ down, trusted @ up, up.sum()]
        curve = (x * (p * (1 - p))[:, None]).T
        by_trusted = (curve * trusted) @ x if self.telling else np.zeros((x.shape[1],) * 2)
        return np.concatenate([mine, trusted @ x, (trusted * p) @ x, p @ x, (curve @ x).ravel(), by_trusted.ravel()])


def learn(rows: DataFrame, model: Model, n: float, n_trusted: float, prior: float | None, ridge: float = 0.002, steps: int = 12) -> np.ndarray:
    """Newton's method from zero weights. prior None: the first model."""
    size = 1 + 2 * len(STATS)
    keep = ridge * np.diag([1e-6, *[1.0] * (size - 1)])
    keep += np.diag([0.0, *[1 / n_trusted] * (size - 1)])
    at = np.zeros(size)

    def look(weights: np.ndarray) -> tuple[float, float, np.ndarray, np.ndarray]:
        s = summed(rows, Terms(Model(model.mean, model.scale, weights), prior is None), 3 + 3 * size + 2 * size * size)
        down, up, all_up = s[:3] / [n_trusted, n_trusted, n]
        x_t, p_t, p_u = s[3 : 3 + 3 * size].reshape(3, size) / [[n_trusted], [n_trusted], [n]]
        h_u, h_t = s[3 + 3 * size :].reshape(2, size, size)
        pull = weights @ keep @ weights / 2
        if prior is None:
            return down + all_up + pull, 0.0, p_t - x_t + p_u + keep @ weights, h_u / n + h_t / n_trusted + keep
        negatives = all_up - prior * up
        return prior * down + negatives + pull, negatives, p_u - prior * x_t + keep @ weights, h_u / n + keep

    risk, _, slope, curve = look(at)
    for _ in range(steps):
        step = np.linalg.solve(curve, slope)
        for share in (1.0, 0.5, 0.25, 0.125):
            new = look(at - share * step)
            if new[0] <= risk + 1e-12 and new[1] >= 0:
                break
        else:
            break
        gain, at = risk - new[0], at - share * step
        risk, _, slope, curve = new
        if gain < 1e-7:
            break
    return at


def class_prior(rows: DataFrame, model: Model, n: float, n_trusted: float, bins: int = 400) -> float:
    """The least share of unlabelled above a threshold in terms of that of positives, each with its sampling error."""

    def of(stats: np.ndarray, trusted: np.ndarray) -> np.ndarray:
        at = np.minimum((bins / (1 + np.exp(-model(stats)))).astype(int), bins - 1)
        return np.concatenate([np.bincount(at, trusted, bins), np.bincount(at, minlength=bins)])

    s = summed(rows, of, 2 * bins)
    mine, all_ = np.cumsum(s[:bins][::-1]) / n_trusted, np.cumsum(s[bins:][::-1]) / n
    error = np.sqrt(np.log(4 * bins) / (2 * n_trusted)) * 0.5 + np.sqrt(np.log(4 * bins) / (2 * n)) * 0.5
    usable = mine > 0.05
    best = np.argmin(((all_ + error) / np.maximum(mine, 1e-9))[usable])
    return float(np.clip((all_ / np.maximum(mine, 1e-9))[usable][best], 0.01, 0.99))


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(rows: DataFrame) -> Model | None:
    """The second model, learnt from rows (stats, trusted); None without trusted positives."""
    k = len(STATS)
    s = summed(rows, lambda x, t: np.concatenate([[len(x), t.sum()], x.sum(0), (x * x).sum(0)]), 2 + 2 * k)
    n, n_trusted = s[:2]
    if not n_trusted:
        return None
    mean = s[2 : 2 + k] / n
    spread = np.sqrt(np.maximum(s[2 + k :] / n - mean * mean, 0))
    model = Model(mean, np.where(spread > 1e-9, spread, 1.0), np.zeros(1 + 2 * k))
    model.weights = learn(rows, model, n, n_trusted, None)
    prior = class_prior(rows, model, n, n_trusted)
    model.weights = learn(rows, model, n, n_trusted, prior)
    return model


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, held_out, score, predicted."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = texts.schema["id"].dataType
    schema = StructType([StructField("id", kind), StructField("stats", ArrayType(DoubleType()))])
    label = F.col("quality").cast("int")
    known = labels.select(F.col("doc_id").cast(kind).alias("id"), label.alias("quality")).where(label.isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    trusted = known.groupBy("id").agg(F.min("quality").alias("trusted")).where("trusted = 1")
    with owned(f"quality {uuid.uuid4().hex}"):
        rows = cut(in_batches(texts, measure, schema).join(trusted, "id", "left").select("id", "stats", F.coalesce("trusted", F.lit(0)).cast("double").alias("trusted")), "stats")
    model = fit(rows)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b.column(1)) if b.num_rows else np.zeros((0, len(STATS)))
            p = 1 / (1 + np.exp(-model(x))) if model else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p)], names=["id", "score"])

    scored = in_batches(rows.select("id", "stats"), score, StructType([schema[0], StructField("score", DoubleType())]))
    return scored.select(F.col("id").alias(id_col), held_out("id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
