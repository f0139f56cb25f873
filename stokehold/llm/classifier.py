"""Quality classifier by positive-unlabelled learning.

Trusted positives (documents labelled good) and unlabelled web text are all it
learns from; labelled bad documents are never used. The class prior is read
off a first positive-against-unlabelled fit: in any region the unlabelled
share is at least prior times the positive share, so the least ratio over
high-score regions bounds it. The classifier then minimises the non-negative
unbiased risk: prior * E+[loss(f)] + max(0, Eu[loss(-f)] - prior * E+[loss(-f)]).

Nothing is sampled: means, deviations, both risks and the score histograms behind
the prior are sums over all training rows. With the logistic loss the unbiased risk is convex, so a few damped
Newton steps find its least value, each one pass of sums (a gradient and a matrix of the size of the features squared)
over the written features; a step that would make the non-negative part negative is halved until it doesn't.
Every document's features are computed in the tasks, from its whole text.

Null and empty texts have the features of an empty text and a score; null ids
are never labelled or held out; of several labels of a document the least
counts; repeated rows stay; other columns are ignored. Where every training row is labelled, all of them, without their labels, are the unlabelled
text. Without positives every score is 0.5; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blobs, slices, written

#: Byte classes whose share of the text is a feature. Digits and quotes are left
#: out: a number or a key in a text says nothing about its quality.
CLASSES = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#*$%&<>", b"|", b"!", b".", b",", b"?", b"\n", b":;()[]{}"]
N_FEATURES = len(CLASSES) + 10


def features(text: bytes) -> list[float]:
    size = len(text)
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * N_FEATURES
    shares = [(size - len(text.translate(None, c))) / size for c in CLASSES]
    distinct = len(set(words))
    pairs = len(set(zip(words, words[1:])))
    doubled = sum(map(bytes.__eq__, words, words[1:]))
    lines = [x for x in text.split(b"\n") if x.strip()]
    ended = sum(x.rstrip()[-1:] in b".!?:;" for x in lines)
    mean = size / n - 1
    return [*shares, distinct / n, pairs / max(1, n - 1), doubled / max(1, n - 1), mean, min(map(len, words)),
            len(lines) / n, ended / max(1, len(lines)), len(set(lines)) / max(1, len(lines)), np.log1p(n), len(text.translate(None, bytes(range(128)))) / size]


def expand(x: np.ndarray) -> np.ndarray:
    """Linear, square-root and squared terms."""
    return np.concatenate([x, np.sqrt(np.abs(x)), x * x], axis=1)


class Model:
    """A standardised linear model; its margin is a logit. The last weight is the bias."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray):
        self.mean, self.scale, self.weights = mean, scale, weights

    def inputs(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((expand(x) - self.mean) / self.scale, -4, 4)
        return np.concatenate([z, np.ones((len(z), 1))], axis=1)

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.inputs(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.margin(x))

    def at(self, weights: np.ndarray) -> "Model":
        return Model(self.mean, self.scale, weights)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


#: Bins of the score histograms behind the prior.
BINS = 2000


def risk_sums(model: Model, x: np.ndarray) -> np.ndarray:
    """Sums over rows, end to end: rows, loss(f), loss(-f), gradients of both (by the
    weights), and the matrix of second derivatives (the same for both)."""
    z = model.inputs(x)
    f = z @ model.weights
    p = sigmoid(f)
    return np.concatenate([[len(x), np.logaddexp(0, -f).sum(), np.logaddexp(0, f).sum()], z.T @ (p - 1), z.T @ p, ((z * (p * (1 - p))[:, None]).T @ z).ravel()])


def moment_sums(x: np.ndarray) -> np.ndarray:
    e = expand(x)
    return np.concatenate([[len(x)], e.sum(0), (e * e).sum(0)])


def histogram(model: Model, x: np.ndarray) -> np.ndarray:
    return np.histogram(model.score(x), BINS, (0, 1))[0].astype(float)


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Least ratio of unlabelled to positive mass over regions above a score (from two
    histograms), with a margin for the sampling error of the unlabelled share."""
    n, above_p, above_u = unlabelled.sum(), np.cumsum(positive[::-1])[::-1] / positive.sum(), np.cumsum(unlabelled[::-1])[::-1] / unlabelled.sum()
    best = 1.0
    for q in np.linspace(0.02, 0.6, 30):
        t = np.flatnonzero(above_p >= 1 - q)[-1]  # the first q of the positives are below
        a, c = above_u[t], above_p[t]
        best = min(best, (a + np.sqrt(a * (1 - a) / n) + 1 / n) / max(c, 1e-9))
    return float(min(max(best, 0.01), 0.99))


def newton(sums, start: Model, prior: float | None, decay: float = 1e-2, steps: int = 15) -> Model:
    """The model of least risk. ``sums(model)`` gives ``risk_sums`` of the positive and the
    unlabelled rows. Without a prior the risk is the plain positive-against-unlabelled one."""
    k = len(start.weights)
    ridge = decay * np.append(np.ones(k - 1), 0.0)

    def parts(model):
        p, u = sums(model)
        p, u = p / p[0], u / u[0]
        gp, gp_neg, hp = p[3:3 + k], p[3 + k:3 + 2 * k], p[3 + 2 * k:].reshape(k, k)
        gu, hu = u[3 + k:3 + 2 * k], u[3 + 2 * k:].reshape(k, k)
        keep = (ridge * model.weights ** 2).sum() / 2
        if prior is None:
            return (p[1] + u[2]) / 2 + keep, 1.0, (gp + gu) / 2 + ridge * model.weights, (hp + hu) / 2
        negative = u[2] - prior * p[2]
        # the positives' second derivatives cancel: loss(f) - loss(-f) = -f
        return prior * p[1] + negative + keep, negative, prior * (gp - gp_neg) + gu + ridge * model.weights, hu

    value, _, gradient, matrix = parts(start)
    for _ in range(steps):
        move, length = np.linalg.solve(matrix + np.diag(ridge + 1e-9), gradient), 1.0
        if gradient @ move < 1e-9:
            break
        while length > 1e-3:
            new = start.at(start.weights - length * move)
            found = parts(new)
            # the negative part must not fall below zero
            if found[0] < value and found[1] >= 0:
                break
            length /= 2
        else:
            break
        start, (value, _, gradient, matrix) = new, found
    return start


def fold(id_col: str) -> Column:
    """crc32 of the id as text, modulo 5 (null: none)."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5))


def featurize(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and ``features`` of every document."""
    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, features array<float>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "_text"):
                x = np.array([features(t or b"") for t in blobs(batch, "_text")], np.float32).reshape(-1, N_FEATURES)
                ends = np.arange(0, (len(x) + 1) * N_FEATURES, N_FEATURES, dtype=np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends, pa.array(x.ravel()))], names=[id_col, "features"])

    return docs.select(F.col(id_col), F.col(text_col).alias("_text")).mapInArrow(run, schema)


def totals(rows: DataFrame, of) -> dict[int, np.ndarray]:
    """``of`` (features to an array of sums) over the rows of each ``kind``: the tasks
    send one array a kind, which are added up by place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, N_FEATURES)
            kind = batch.column(0).to_numpy(zero_copy_only=False)
            for k in np.unique(kind).tolist():
                held[k] = held.get(k, 0) + of(x[kind == k])
        for k, v in held.items():
            yield pa.RecordBatch.from_pydict({"kind": pa.array(np.full(len(v), k), pa.int32()), "i": pa.array(np.arange(len(v)), pa.int32()), "v": pa.array(v, pa.float64())})

    found = rows.select("kind", "features").mapInArrow(run, "kind int, i int, v double").groupBy("kind", "i").agg(F.sum("v").alias("v")).toArrow()
    kind, at, v = (found.column(c).to_numpy() for c in ("kind", "i", "v"))
    out = {}
    for k in np.unique(kind).tolist():
        out[k] = np.zeros(int(at[kind == k].max()) + 1)
        out[k][at[kind == k]] = v[kind == k]
    return out


def fit(rows: DataFrame) -> tuple[Model, float] | None:
    """The model and the prior from ``rows`` with kind (1 positive, 0 unlabelled, 2
    labelled otherwise) and features; None without positives."""
    moments = totals(rows, moment_sums)
    if 1 not in moments:
        return None
    alone = 0 not in moments  # every row is labelled: all of them are the unlabelled text
    kinds = [1, 2] if alone else [0]
    both = sum(moments[k] for k in {1, *kinds} if k in moments)
    d = (len(both) - 1) // 2
    mean = both[1:d + 1] / both[0]
    scale = np.sqrt(np.maximum(0, both[d + 1:] / both[0] - mean ** 2)) + 1e-9
    used = rows.filter(F.col("kind").isin(1, *kinds))

    def sums(model: Model) -> tuple[np.ndarray, np.ndarray]:
        found = totals(used, lambda x: risk_sums(model, x))
        return found[1], sum(found[k] for k in kinds if k in found)

    blank = Model(mean, scale, np.zeros(d + 1))
    first = newton(sums, blank, None)
    bars = totals(used, lambda x: histogram(first, x))
    prior = class_prior(bars[1], sum(bars[k] for k in kinds if k in bars))
    return newton(sums, blank, prior), prior


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality") -> DataFrame:
    """Id, held_out, score and predicted of every document."""
    marked = labels.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label")).groupBy("_id").agg(F.min("_label").alias("_label"))
    rows = written(featurize(docs, id_col, text_col))
    kind = F.when(F.col("_label") == 1, 1).when(F.col("_label").isNull(), 0).otherwise(2).alias("kind")
    # features travel, a fraction of the texts; the labels are hashed in each task, so a hot id's rows are split by AQE
    seen = rows.filter(F.coalesce(fold(id_col), F.lit(-1)) != 0).join(marked, F.col(id_col) == F.col("_id"), "left")
    fitted = fit(written(seen.select(kind, "features")))
    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, held_out boolean, score double"

    model = fitted[0] if fitted else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, N_FEATURES)
            s = model.score(x) if model else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s, pa.float64())], names=[id_col, "held_out", "score"])

    scored = rows.select(id_col, F.coalesce(fold(id_col) == 0, F.lit(False)).alias("held_out"), "features").mapInArrow(run, schema)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
