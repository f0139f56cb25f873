"""Random forests by histograms (ML4, ML5, ML14, FE15), for MLlib's estimators and models.

The method is MLlib's (bins between quantiles, Poisson bootstrap, a feature subset for each node, gain of
the impurity, pruning of leaves that agree); what is kept for a row is not:

* **Packed rows.** A row is a byte a feature (its bin), a byte for its (label, weight) and its hash, written
  once in blocks. Bootstrap counts are hashes of (row, tree) and are never stored, so nothing grows with rows x trees.
* **Few rows** (``UNIT_ROWS``): a task reads all blocks and grows its trees whole; rows keep their node between levels.
* **More rows**: all trees grow by levels. A task routes its rows through the trees and sends one histogram of the open
  nodes; histograms are added and split by (tree, nodes) in tasks, and the driver gets the splits.
* **Draws** come from hashes of (seed, tree, node): a tree is the same grown either way, and a tree
  cut at a depth, or where nodes have few rows, is the tree grown with these limits.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, ship_package, written
from .iforest import _mix, _shares, _STEP, _sums_from, _sums_of

#: Rows of which each task may hold all; more are grown by levels.
UNIT_ROWS = 1 << 22
#: Rows of a packed block, values that stand for a longer list of them, kinds of (label, weight) told apart.
BLOCK_ROWS, SUMMARY, KINDS = 1 << 16, 2048, 64
#: Cells of the histograms that a task holds, and nodes whose histograms travel together.
CELLS, TOGETHER = 1 << 24, 128
_GOLD = np.uint64(0x9E3779B97F4A7C15)


# ---------------------------------------------------------------------------
# draws
# ---------------------------------------------------------------------------

def poisson_steps(rate: float) -> np.ndarray:
    """2^32 x the distribution function of the Poisson law, as far as 32 bits tell it from 1."""
    term = total = math.exp(-rate)
    steps = [total]
    while total < 1 - 2.0 ** -33 and len(steps) < 255:
        term *= rate / len(steps)
        total += term
        steps.append(total)
    return np.array([s for s in (int(round(t * 2 ** 32)) for t in steps) if s < 2 ** 32], np.uint32)


class Copies:
    """How often each row is in a tree's sample, by 32 bits of a hash that two trees share."""

    def __init__(self, bootstrap: bool, rate: float):
        self.all = not bootstrap and rate >= 1.0
        self.steps = poisson_steps(rate) if bootstrap else np.array([min(2 ** 32 - 1, int(round((1 - rate) * 2 ** 32)))], np.uint32)
        first = np.arange(1 << 16, dtype=np.uint32) << np.uint32(16)
        lo, hi = (np.searchsorted(self.steps, e, "right") for e in (first, first + np.uint32(65535)))
        # by the upper half of the bits; 255: the lower half decides
        self.table = np.where(lo == hi, lo, 255).astype(np.uint8)

    def __call__(self, h: np.ndarray, seed: int, tree: int) -> np.ndarray:
        if self.all:
            return np.ones(len(h), np.uint8)
        with np.errstate(over="ignore"):
            u = _mix(h ^ _mix(_mix(np.uint64(seed & (2 ** 64 - 1))) ^ np.uint64(tree // 2)))
        w = self.table.take(u.view(np.uint16).reshape(-1, 4)[:, 2 * (tree % 2) + 1])
        some = np.flatnonzero(w == 255)
        if len(some):
            w[some] = np.searchsorted(self.steps, u.view(np.uint32).reshape(-1, 2)[some, tree % 2], "right")
        return w


def root_id(seed: int, tree: int) -> np.uint64:
    return _mix(_mix(np.uint64(seed & (2 ** 64 - 1))) ^ np.uint64(tree) ^ (_GOLD >> np.uint64(1)))


def child_ids(ids: np.ndarray) -> np.ndarray:
    """Left and right child of each node, in turn."""
    with np.errstate(over="ignore"):
        return np.stack([_mix(ids), _mix(ids + np.uint64(1))], axis=1).ravel()


def subsets(ids: np.ndarray, d: int, k: int) -> np.ndarray:
    """(nodes, k): the features that each node may split on, ascending."""
    if k >= d:
        return np.tile(np.arange(d), (len(ids), 1))
    with np.errstate(over="ignore"):
        draw = _mix(ids[:, None] ^ _mix(np.arange(2, d + 2).astype(np.uint64))[None, :])
    return np.sort(np.argsort(draw, axis=1, kind="stable")[:, :k], axis=1)


def subset_size(strategy: str, d: int, trees: int, classification: bool) -> int:
    """MLlib's numbers of features a node."""
    if strategy == "auto":
        strategy = "all" if trees == 1 else "sqrt" if classification else "onethird"
    if strategy in ("all", "sqrt", "log2", "onethird"):
        return {"all": d, "sqrt": math.ceil(math.sqrt(d)), "log2": max(1, math.ceil(math.log2(d))), "onethird": math.ceil(d / 3)}[strategy]
    if "." in strategy or float(strategy) < 1:
        return max(1, math.ceil(float(strategy) * d))
    return min(int(strategy), d)


# ---------------------------------------------------------------------------
# packed rows
# ---------------------------------------------------------------------------

@dataclass
class Packed:
    """Rows by their bins. ``kinds``: the (label, weight) pairs that a byte of each row tells apart, None if there
    are too many or labels are numbers (the rows then carry both). ``classes`` is 0 for numbers."""

    blocks: DataFrame
    n: int
    cuts: list[np.ndarray]
    kinds: np.ndarray | None
    classes: int
    weighted: bool
    weight: float
    counts: np.ndarray | None  # rows of each kind

    @property
    def d(self) -> int:
        return len(self.cuts)

    @property
    def bins(self) -> int:
        return max(len(c) for c in self.cuts) + 1

    @property
    def channels(self) -> int:
        """Sums kept for each bin."""
        return len(self.kinds) if self.kinds is not None else self.classes + 1 if self.classes else 3 + self.weighted

    def matrix(self) -> np.ndarray:
        """(channels, statistics): of classes the weight of each, of numbers weight, sum and sum of squares; last the rows."""
        if self.kinds is not None:
            out = np.zeros((len(self.kinds), self.classes + 1))
            out[np.arange(len(self.kinds)), self.kinds[:, 0].astype(int)] = self.kinds[:, 1]
            out[:, -1] = 1
            return out
        if self.classes or self.weighted:
            return np.eye(self.channels)
        return np.array([[1.0, 0, 0, 1], [0, 1, 0, 0], [0, 0, 1, 0]])


def distinct(v: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    v, at = np.unique(v, return_inverse=True)
    return v, np.bincount(at, w, len(v))


def summary(v: np.ndarray, w: np.ndarray, most: int = SUMMARY) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and their weights; of more than ``most`` values, that many at even steps of the weight."""
    v, w = distinct(v, w)
    if len(v) <= most:
        return v, w
    total = np.cumsum(w)
    at = np.searchsorted(total, (np.arange(most) + 0.5) / most * total[-1])
    return distinct(v[np.minimum(at, len(v) - 1)], np.full(most, total[-1] / most))


def cut_points(v: np.ndarray, w: np.ndarray, bins: int) -> np.ndarray:
    """Thresholds of at most ``bins`` bins: between all values if they are few, else at even strides of the weight."""
    if len(v) < 2:
        return np.zeros(0)
    with np.errstate(invalid="ignore"):
        middle = v[:-1] / 2 + v[1:] / 2
    middle = np.where((middle >= v[:-1]) & (middle < v[1:]), middle, v[:-1])
    if len(v) <= bins:
        return middle
    stride, out, held = w.sum() / bins, [], w[0]
    for i in range(1, len(v)):
        target = stride * (len(out) + 1)
        if abs(held - target) < abs(held + w[i] - target):
            out.append(middle[i - 1])
            if len(out) == bins - 1:
                break
        held += w[i]
    return np.array(out)


def _input(df: DataFrame, features: Sequence[str], label: str, weight: str | None) -> DataFrame:
    """Hash of the whole row, label, weight and features (nulls and NaN to 0, as ``assemble`` has them)."""
    from pyspark.sql.types import ArrayType, MapType, StructType

    plain = [F.col(f"`{x.name}`") for x in df.schema.fields if isinstance(x.dataType, (ArrayType, MapType, StructType)) is False and hasattr(x.dataType, "sqlType") is False]
    number = lambda x: F.nanvl(F.coalesce(F.col(f"`{x}`").cast("double"), F.lit(0.0)), F.lit(0.0))
    return df.select(F.xxhash64(*plain).alias("_h"), F.col(f"`{label}`").cast("double").alias("_y"),
                     (F.col(f"`{weight}`").cast("double") if weight else F.lit(1.0)).alias("_w"), F.array(*[number(x) for x in features]).alias("_x"))


def _columns(batch: pa.RecordBatch, d: int):
    col = lambda name: batch.column(batch.schema.get_field_index(name))
    x = col("_x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
    return col("_h").to_numpy().view(np.uint64), col("_y").to_numpy(zero_copy_only=False), col("_w").to_numpy(zero_copy_only=False), x


def _pairs(y: np.ndarray, w: np.ndarray, n: np.ndarray):
    """Distinct (label, weight) pairs with their rows."""
    both, at = np.unique(np.stack([y, w], axis=1), axis=0, return_inverse=True)
    return both[:, 0], both[:, 1], np.bincount(at.ravel(), n, len(both))


_FOUND = "feature int, a binary, b binary, c binary, many boolean, bad long, low double, high double, n long, weight double"


def _found(feature: int, a, b, c=(), many=False, bad=0, low=0.0, high=0.0, n=0, weight=0.0) -> pa.RecordBatch:
    raw = lambda v: pa.array([np.asarray(v, np.float64).tobytes()], pa.binary())
    return pa.RecordBatch.from_pydict({"feature": pa.array([feature], pa.int32()), "a": raw(a), "b": raw(b), "c": raw(c), "many": pa.array([many]), "bad": pa.array([bad], pa.int64()),
                                       "low": pa.array([low], pa.float64()), "high": pa.array([high], pa.float64()), "n": pa.array([n], pa.int64()), "weight": pa.array([weight], pa.float64())})


def pack(df: DataFrame, features: Sequence[str], label: str, classification: bool, weight: str | None = None, bins: int = 32) -> Packed:
    """Two passes: one for the bins and labels, one that writes the packed rows."""
    spark, d = df.sparkSession, len(features)
    ship_package(spark)
    if not 2 <= bins <= 256:
        raise ValueError("a feature has 2 to 256 bins")
    rows = _input(df, features, label, weight)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting, values = [], 0, [[] for _ in range(d)]
        kinds, many, bad, low, high, n, weight_sum = [], False, 0, np.inf, -np.inf, 0, 0.0

        def settle():
            nonlocal kinds, many, bad, low, high, n, weight_sum
            y, w, x = (np.concatenate(a) for a in zip(*held))
            wrong = ~np.isfinite(y) | ~np.isfinite(w) | (w < 0)
            if classification:
                wrong |= (y < 0) | (y != np.floor(y)) | (y >= 100)
            bad, n = bad + int(wrong.sum()), n + len(y)
            y, w, x = y[~wrong], w[~wrong], x[~wrong]
            if not len(y):
                return
            low, high, weight_sum = min(low, y.min()), max(high, y.max()), weight_sum + w.sum()
            if classification and not many:
                a, b, c = zip(*kinds, _pairs(y, w, np.ones(len(y))))
                kinds = [_pairs(np.concatenate(a), np.concatenate(b), np.concatenate(c))]
                many = len(kinds[0][0]) > KINDS
            for j in range(d):
                values[j].append(summary(x[:, j], w))

        for batch in batches:
            _, y, w, x = _columns(batch, d)
            held.append((y, w, x))
            waiting += len(y)
            if waiting >= 1 << 18:
                settle()
                held, waiting = [], 0
        if waiting:
            settle()
        if n:
            for j in range(d):
                v, w = (np.concatenate(a) for a in zip(*values[j])) if values[j] else (np.zeros(0), np.zeros(0))
                yield _found(j, *summary(v, w))
            y, w, c = kinds[0] if kinds and not many else ((), (), ())
            yield _found(-1, y, w, c, many, bad, low, high, n, weight_sum)

    def merge(group: pa.Table) -> pa.Table:
        part = lambda name: np.concatenate([np.frombuffer(b, np.float64) for b in group.column(name).to_pylist()])
        feature = group.column("feature")[0].as_py()
        if feature >= 0:
            return pa.Table.from_batches([_found(feature, cut_points(*distinct(part("a"), part("b")), bins), ())])
        many = any(group.column("many").to_pylist())
        y, w, c = _pairs(part("a"), part("b"), part("c"))
        many = many or len(y) > KINDS
        total = lambda name: sum(group.column(name).to_pylist())
        return pa.Table.from_batches([_found(-1, *(((), (), ()) if many else (y, w, c)), many, total("bad"), min(group.column("low").to_pylist()), max(group.column("high").to_pylist()),
                                             total("n"), math.fsum(group.column("weight").to_pylist()))])

    found = {r["feature"]: r for r in rows.mapInArrow(look, _FOUND).groupBy("feature").applyInArrow(merge, _FOUND).collect()}  # a row a feature
    if -1 not in found:
        raise ValueError("a forest needs training rows")
    about = found[-1]
    if about["bad"]:
        raise ValueError(f"{about['bad']} rows have a null or invalid label (`{label}`) or weight")
    array = lambda f, name: np.frombuffer(found[f][name], np.float64)
    cuts = [array(j, "a") for j in range(d)]
    classes = max(2, int(about["high"]) + 1) if classification else 0
    kinds = np.stack([array(-1, "a"), array(-1, "b")], axis=1) if classification and not about["many"] else None
    blocks = written(rows.mapInArrow(_packer(cuts, kinds, bool(weight)), "n int, x binary, k binary, y binary, w binary, h binary"))
    return Packed(blocks, about["n"], cuts, kinds, classes, bool(weight), about["weight"], None if kinds is None else array(-1, "c"))


def _packer(cuts: list[np.ndarray], kinds: np.ndarray | None, weighted: bool):
    d = len(cuts)

    def block(h, y, w, x) -> pa.RecordBatch:
        # equal rows of a block are drawn apart
        order = np.argsort(h, kind="stable")
        twin = np.flatnonzero(h[order][1:] == h[order][:-1]) + 1
        if len(twin):
            run = np.arange(len(h))
            first = np.ones(len(h), bool)
            first[twin] = False
            nth = run - np.maximum.accumulate(np.where(first, run, 0))
            h = h.copy()
            with np.errstate(over="ignore"):
                h[order[twin]] = _mix(h[order[twin]] + nth[twin].astype(np.uint64) * _GOLD)
        codes = np.empty((len(h), d), np.uint8)
        for j in range(d):
            codes[:, j] = np.searchsorted(cuts[j], x[:, j], "left")
        if kinds is not None:
            lookup = {(a, b): i for i, (a, b) in enumerate(kinds.tolist())}
            a, b, _ = _pairs(y, w, np.ones(len(y)))
            k = np.zeros(len(y), np.uint8)
            for l, v in zip(a, b):
                k[(y == l) & (w == v)] = lookup[float(l), float(v)]
            carried = (k.tobytes(), b"", b"")
        else:
            carried = (b"", y.tobytes(), w.tobytes() if weighted else b"")
        return pa.RecordBatch.from_pydict({"n": pa.array([len(h)], pa.int32()), "x": pa.array([codes.tobytes()], pa.binary()),
                                           **{c: pa.array([v], pa.binary()) for c, v in zip("kyw", carried)}, "h": pa.array([h.tobytes()], pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(_columns(batch, d))
                waiting += batch.num_rows
            if waiting >= BLOCK_ROWS:
                yield block(*(np.concatenate(a) for a in zip(*held)))
                held, waiting = [], 0
        if held:
            yield block(*(np.concatenate(a) for a in zip(*held)))

    return run


@dataclass
class _Rows:
    """Arrays of a block: bins by rows, hash, and the values that the channels sum."""

    x: np.ndarray
    h: np.ndarray
    kind: np.ndarray | None
    values: list[np.ndarray | None] | None

    def __len__(self):
        return len(self.h)


@dataclass
class _Layout:
    """What tasks know of the packed rows."""

    d: int
    bins: int
    channels: int
    classes: int
    kinded: bool
    weighted: bool

    @staticmethod
    def of(p: Packed) -> "_Layout":
        return _Layout(p.d, p.bins, p.channels, p.classes, p.kinds is not None, p.weighted)

    def values(self, y, w) -> list[np.ndarray | None]:
        """What each channel adds for a row (None: one)."""
        if self.classes:
            return [*[np.where(y == k, w if w is not None else 1.0, 0.0) for k in range(self.classes)], None]
        v = y if w is None else w * y
        return [w, v, v * y, *([None] if w is not None else [])]

    def blocks(self, batches: Iterator[pa.RecordBatch]) -> Iterator[_Rows]:
        for batch in batches:
            for r in range(batch.num_rows):
                raw = lambda name, kind: np.frombuffer(batch.column(batch.schema.get_field_index(name))[r].as_buffer(), kind)  # noqa: B023, E731
                x, h = raw("x", np.uint8).reshape(-1, self.d), raw("h", np.uint64)
                if self.kinded:
                    yield _Rows(x, h, raw("k", np.uint8), None)
                else:
                    yield _Rows(x, h, None, self.values(raw("y", np.float64), raw("w", np.float64) if self.weighted else None))

    def whole(self, batches: Iterator[pa.RecordBatch]) -> _Rows | None:
        held = list(self.blocks(batches))
        if not held:
            return None
        cat = lambda parts: None if parts[0] is None else np.concatenate(parts)
        return _Rows(cat([b.x for b in held]), cat([b.h for b in held]), cat([b.kind for b in held]),
                     None if self.kinded else [cat(list(v)) for v in zip(*[b.values for b in held])])

    def tally(self, rows: _Rows, some: np.ndarray, copies: np.ndarray, place: np.ndarray, subset: np.ndarray) -> np.ndarray:
        """Histogram (nodes x features x bins, channels) of the rows ``some`` at the open nodes ``place``."""
        nodes, k = subset.shape
        flat, at, cells = rows.x.ravel(), some * self.d, nodes * k * self.bins
        w = copies.astype(np.float64)
        size = cells * (self.channels if self.kinded else 1)
        out = np.zeros(size if self.kinded else (self.channels, size))
        low = place * (k * self.bins)
        kind = rows.kind.take(some).astype(np.int64) if self.kinded else None
        given = None if self.kinded else [w if v is None else v.take(some) * w for v in rows.values]
        for s in range(k):
            key = flat.take(at + (s if k == self.d else subset[:, s].take(place))) + low
            key += s * self.bins
            if self.kinded:
                key *= self.channels
                key += kind
                out += np.bincount(key, w, size)
            else:
                for j, v in enumerate(given):
                    out[j] += np.bincount(key, v, size)
        return out.reshape(cells, -1) if self.kinded else np.ascontiguousarray(out.T)


# ---------------------------------------------------------------------------
# splits
# ---------------------------------------------------------------------------

@dataclass
class Rules:
    """What decides a split; ``balance``: classes are weighed by their share of each tree's sample."""

    k: int
    impurity: str = "gini"
    min_leaf: int = 1
    min_gain: float = 0.0
    min_weight: float = 0.0
    min_split: int = 2
    depth: int | None = 10
    balance: bool = False

    def spread(self, s: np.ndarray) -> np.ndarray:
        """Impurity of statistics (..., C)."""
        with np.errstate(divide="ignore", invalid="ignore"):
            if self.impurity == "variance":
                return np.where(s[..., 0] > 0, (s[..., 2] - s[..., 1] * s[..., 1] / s[..., 0]) / s[..., 0], 0.0)
            total = s[..., :-1].sum(-1)
            share = s[..., :-1] / total[..., None]
            if self.impurity == "entropy":
                out = -np.where(share > 0, share * np.log2(np.where(share > 0, share, 1.0)), 0.0).sum(-1)
            else:
                out = 1.0 - (share * share).sum(-1)
        return np.where(total > 0, out, 0.0)

    def weight(self, s: np.ndarray) -> np.ndarray:
        return s[..., 0] if self.impurity == "variance" else s[..., :-1].sum(-1)

    def gains(self, left: np.ndarray, total: np.ndarray) -> np.ndarray:
        """Gain of each split (-1: not allowed)."""
        right = total - left
        a, b = self.weight(left), self.weight(right)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = self.spread(total) - a / (a + b) * self.spread(left) - b / (a + b) * self.spread(right)
        ok = (left[..., -1] >= self.min_leaf) & (right[..., -1] >= self.min_leaf) & (a > 0) & (b > 0) & (a >= self.min_weight) & (b >= self.min_weight)
        return np.where(ok & (gain >= self.min_gain), gain, -1.0)

    def weighed(self, matrix: np.ndarray, sums: np.ndarray) -> np.ndarray:
        """``matrix`` with each class weighed by its share of ``sums``, the rows of a tree's sample by kind."""
        if not self.balance:
            return matrix
        out = (matrix != 0).astype(float)
        rows = sums @ out[:, :-1]
        with np.errstate(divide="ignore"):
            out[:, :-1] *= np.where(rows > 0, rows.sum() / (np.count_nonzero(rows) * rows), 0.0)
        return out


def best_of(hist: np.ndarray, matrix: np.ndarray, subset: np.ndarray, bins: int, rules: Rules):
    """Best split of each node from its histogram: feature (-1: none), bin, gain, statistics of the node and of its left side."""
    nodes, k = subset.shape
    sums = hist.reshape(nodes, k, bins, -1)
    left = np.cumsum(sums, axis=2)
    total = left[:, :1, -1:] @ matrix
    left = left[:, :, :-1] @ matrix
    gain = rules.gains(left, total).reshape(nodes, -1)
    if not gain.shape[1]:
        return np.full(nodes, -1), np.zeros(nodes, np.int64), np.zeros(nodes), total[:, 0, 0], total[:, 0, 0]
    best = gain.argmax(1)
    row = np.arange(nodes)
    top, slot, at = gain[row, best], best // (bins - 1), best % (bins - 1)
    return np.where(top > 0, subset[row, slot], -1), at, top, total[:, 0, 0], left[row, slot, at]


def best_of_few(layout: _Layout, rows: _Rows, some: np.ndarray, copies: np.ndarray, place: np.ndarray, subset: np.ndarray, matrix: np.ndarray, rules: Rules):
    """``best_of`` for many nodes of few rows: only bins that have rows are looked at."""
    nodes, k = subset.shape
    flat, at, w = rows.x.ravel(), some * layout.d, copies.astype(np.float64)
    key = np.concatenate([(place * k + s) * layout.bins + flat.take(at + subset[:, s].take(place)) for s in range(k)])
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    who = order % len(some)
    if layout.kinded:
        kind, held = rows.kind.take(some)[who], w[who]
        each = [np.where(kind == j, held, 0.0) for j in range(layout.channels)]
    else:
        each = [(w if v is None else v.take(some) * w)[who] for v in rows.values]
    sums = np.stack([np.add.reduceat(e, first) for e in each], axis=1)
    run = key[first]
    group = run // layout.bins
    opens = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    held = np.cumsum(sums, axis=0)
    base = np.concatenate([np.zeros((1, held.shape[1])), held])[opens]
    sizes = np.diff(np.append(opens, len(run)))
    left = (held - np.repeat(base, sizes, axis=0)) @ matrix
    total = left[opens + sizes - 1]
    node = group // k
    gain = rules.gains(left, np.repeat(total, sizes, axis=0))
    starts = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))  # every open node has rows
    top = np.maximum.reduceat(gain, starts)
    hit = np.flatnonzero(gain == np.repeat(top, np.diff(np.append(starts, len(node)))))
    best = hit[np.flatnonzero(np.concatenate([[True], node[hit][1:] != node[hit][:-1]]))]
    total = total[np.searchsorted(opens, starts)]
    return np.where(top > 0, subset[np.arange(nodes), (group[best] % k)], -1), run[best] % layout.bins, top, total, left[best]


@dataclass
class Tree:
    """A tree in level order: feature (-1: leaf), bin (rows up to it go left), left child (right: the next), gain and statistics."""

    number: int
    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    gain: np.ndarray
    stats: np.ndarray

    def packed(self) -> dict:
        return dict(tree=self.number, n=len(self.feature), feature=self.feature.astype("<i2").tobytes(), bin=self.bin.astype("<i2").tobytes(), left=self.left.astype("<i4").tobytes(),
                    gain=self.gain.astype("<f8").tobytes(), stats=self.stats.astype("<f8").tobytes())

    @staticmethod
    def unpacked(r) -> "Tree":
        get = lambda name, kind: np.frombuffer(r[name], kind)
        return Tree(r["tree"], get("feature", "<i2"), get("bin", "<i2"), get("left", "<i4"), get("gain", "<f8"), get("stats", "<f8").reshape(r["n"], -1))


TREE_SCHEMA = "tree int, n int, feature binary, bin binary, left binary, gain binary, stats binary"
_KINDS = dict(tree=pa.int32(), n=pa.int32(), feature=pa.binary(), bin=pa.binary(), left=pa.binary(), gain=pa.binary(), stats=pa.binary())


class Growing:
    """A tree while it grows: its nodes so far, level by level, and the open ones."""

    def __init__(self, number: int, seed: int):
        self.number, self.depth, self.matrix = number, 0, None
        self.parts: list[tuple] = []
        self.stats: list[np.ndarray] = []
        self.size, self.open = 1, np.zeros(1, np.int64)  # positions of the open nodes
        self.ids = np.array([root_id(seed, number)], np.uint64)

    def settle(self, rules: Rules, feature, at, gain, total, left) -> tuple[np.ndarray, np.ndarray]:
        """Takes the splits of the open nodes. Returns for each its first child's place in the next
        level (-1: none) and, for these children, the place among the open ones (-1: closed)."""
        if not self.depth:
            self.stats.append(total)
        split = np.flatnonzero(feature >= 0)
        kids = np.stack([left[split], total[split] - left[split]], axis=1).reshape(-1, total.shape[1])
        ids = child_ids(self.ids[split])
        self.parts.append((self.open[split], feature[split], at[split], self.size + 2 * np.arange(len(split)), gain[split]))
        first = np.full(len(feature), -1, np.int64)
        first[split] = 2 * np.arange(len(split))
        rows = kids[:, -1]
        can = (rows >= max(2, rules.min_split, 2 * rules.min_leaf)) & (np.abs(rules.spread(kids)) >= 1e-16)
        self.depth += 1
        if rules.depth is not None and self.depth >= rules.depth:
            can[:] = False
        self.stats.append(kids)
        self.open, self.ids = self.size + np.flatnonzero(can), ids[can]
        self.size += len(kids)
        place = np.full(len(kids), -1, np.int64)
        place[can] = np.arange(can.sum())
        return first, place

    def table(self):
        """Feature, bin and left child of all nodes so far, for walks (a leaf leads to itself), and the place of the open ones."""
        feature, at, left = np.zeros(self.size, np.int64), np.full(self.size, 255, np.uint8), np.arange(self.size)
        for where, f, b, kids, _ in self.parts:
            feature[where], at[where], left[where] = f, b, kids
        place = np.full(self.size, -1, np.int64)
        place[self.open] = np.arange(len(self.open))
        return feature, at, left, place

    def tree(self) -> Tree:
        feature, at, left, gain = np.full(self.size, -1, np.int64), np.zeros(self.size, np.int64), np.full(self.size, -1, np.int64), np.full(self.size, -1.0)
        for where, f, b, kids, g in self.parts:
            feature[where], at[where], left[where], gain[where] = f, b, kids, g
        return Tree(self.number, feature, at, left, gain, np.concatenate(self.stats))


def grow(layout: _Layout, rows: _Rows, copies: np.ndarray, number: int, seed: int, matrix: np.ndarray, rules: Rules) -> Tree:
    """A whole tree from the rows of a task, level by level."""
    out = Growing(number, seed)
    some = np.flatnonzero(copies)
    copies, place = copies[some], np.zeros(len(some), np.int32)
    flat = rows.x.ravel()
    if not len(some) or rules.depth == 0:
        sums = layout.tally(rows, some, copies, place.astype(np.int64), subsets(out.ids, layout.d, rules.k))
        weighed = rules.weighed(matrix, sums[:layout.bins].sum(0))
        out.settle(rules, np.full(1, -1), np.zeros(1, np.int64), np.zeros(1), sums[:layout.bins].sum(0)[None] @ weighed, np.zeros((1, matrix.shape[1])))
        return out.tree()
    while len(out.open):
        subset = subsets(out.ids, layout.d, rules.k)
        cells = subset.size * layout.bins
        if cells * layout.channels <= CELLS and cells <= 4 * len(some) * rules.k or not out.depth:
            hist, step = np.zeros((cells, layout.channels)), max(BLOCK_ROWS, cells * layout.channels)
            for lo in range(0, len(some), step):
                part = slice(lo, lo + step)
                hist += layout.tally(rows, some[part], copies[part], place[part].astype(np.int64), subset)
            if out.matrix is None:
                out.matrix = rules.weighed(matrix, hist[:layout.bins].sum(0))
            # a few nodes at a time, for what the sums take
            step = max(1, (1 << 18) // (rules.k * layout.bins))
            best = [best_of(hist[lo * rules.k * layout.bins:(lo + step) * rules.k * layout.bins], out.matrix, subset[lo:lo + step], layout.bins, rules) for lo in range(0, len(subset), step)]
            best = [np.concatenate(a) for a in zip(*best)]
        else:
            best = best_of_few(layout, rows, some, copies, place.astype(np.int64), subset, out.matrix, rules)
        feature, at = best[0], best[1]
        first, opened = out.settle(rules, *best)
        if not len(out.open):
            break
        kept = []
        for lo in range(0, len(some), BLOCK_ROWS):
            s, p = some[lo:lo + BLOCK_ROWS], place[lo:lo + BLOCK_ROWS].astype(np.int64)
            kid = first.take(p)
            # nodes without a split: any value, left out below
            kid += flat.take(s * layout.d + np.maximum(feature, 0).take(p)) > at.take(p)
            next_place = np.where(first.take(p) >= 0, opened.take(np.maximum(kid, 0)), -1)
            stay = np.flatnonzero(next_place >= 0)
            kept.append((s[stay], copies[lo:lo + BLOCK_ROWS][stay], next_place[stay].astype(np.int32)))
        some, copies, place = (np.concatenate(a) for a in zip(*kept))
    return out.tree()


# ---------------------------------------------------------------------------
# forests
# ---------------------------------------------------------------------------

def every_block(frame: DataFrame, tasks: int) -> DataFrame:
    """``tasks`` partitions with all rows of ``frame`` each, and the number of the task: every task reads the files, nothing is shuffled."""
    each = frame.sparkSession.range(0, tasks, 1, tasks).select(F.col("id").cast("int").alias("task"))
    return each.crossJoin(frame.coalesce(1).hint("shuffle_replicate_nl"))


def _first(batches: Iterator[pa.RecordBatch]):
    """The number of the task and its batches."""
    held = [b for b in batches if b.num_rows]
    return (held[0].column(held[0].schema.get_field_index("task"))[0].as_py() if held else -1), held


def grow_trees(packed: Packed, trees: int, seed: int, rules: Rules, copies: Copies, unit_rows: int = UNIT_ROWS) -> list[Tree]:
    """All trees of a forest, on the driver (so many as a model there may hold)."""
    spark, layout, matrix = packed.blocks.sparkSession, _Layout.of(packed), packed.matrix()
    if packed.n > unit_rows:
        return _by_levels(packed, range(trees), seed, rules, copies, matrix)
    tasks = max(1, min(trees, 3 * spark.sparkContext.defaultParallelism))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held = _first(batches)
        rows = layout.whole(iter(held))
        for t in range(task, trees, tasks) if rows is not None else ():
            tree = grow(layout, rows, copies(rows.h, seed, t), t, seed, matrix, rules)
            yield pa.RecordBatch.from_pydict({k: pa.array([v], _KINDS[k]) for k, v in tree.packed().items()})

    found = {r["tree"]: Tree.unpacked(r) for r in every_block(packed.blocks, tasks).mapInArrow(run, TREE_SCHEMA).collect()}
    return [found[t] for t in range(trees)]


_SPLIT_SCHEMA = "tree int, chunk int, feature binary, bin binary, gain binary, total binary, left binary, sums binary"


def _shrunk(v: np.ndarray) -> tuple[str, bytes]:
    """Cells in the fewest bytes that hold them."""
    if len(v) and v.min() >= 0 and v.max() < 2 ** 32 and (v == np.floor(v)).all():
        kind = next(k for k, most in (("<u1", 2 ** 8), ("<u2", 2 ** 16), ("<u4", 2 ** 32)) if v.max() < most)
        return kind, v.astype(kind).tobytes()
    return "<f8", v.astype("<f8").tobytes()


def _by_levels(packed: Packed, trees: Sequence[int], seed: int, rules: Rules, copies: Copies, matrix: np.ndarray) -> list[Tree]:
    """The trees of these numbers a level at a time; of wide levels, as many trees at once as a task can hold the histograms of."""
    spark, layout = packed.blocks.sparkSession, _Layout.of(packed)
    blocks = packed.blocks.coalesce(max(1, spark.sparkContext.defaultParallelism))
    growing = [Growing(t, seed) for t in trees]
    for g in growing:
        g.matrix = None if rules.balance else matrix
    if rules.depth == 0:
        rules = replace(rules, min_leaf=packed.n * 256)  # no split is allowed
    live = list(growing)
    while live:
        cost = rules.k * layout.bins * layout.channels
        groups, room = [], 0
        for g in live:
            if not groups or room < len(g.open) * cost:
                groups.append([])
                room = CELLS
            groups[-1].append(g)
            room -= len(g.open) * cost
        for group in groups:
            _one_level(blocks, layout, group, seed, rules, matrix, copies)
        live = [g for g in live if len(g.open)]
    return [g.tree() for g in growing]


def _one_level(blocks: DataFrame, layout: _Layout, group: list[Growing], seed: int, rules: Rules, matrix: np.ndarray, copies: Copies) -> None:
    spark = blocks.sparkSession
    known = spark.sparkContext.broadcast({g.number: (*g.table(), subsets(g.ids, layout.d, rules.k), g.depth, g.matrix) for g in group})
    cell = rules.k * layout.bins

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {t: np.zeros((k[4].shape[0] * cell, layout.channels)) for t, k in known.value.items()}
        for rows in layout.blocks(batches):
            flat = rows.x.ravel()
            for t, (feature, at, left, place, subset, depth, _) in known.value.items():
                w = copies(rows.h, seed, t)
                some = np.flatnonzero(w)
                node, start = np.zeros(len(some), np.int64), some * layout.d
                f, v, b, kid = np.empty_like(node), np.empty(len(some), np.uint8), np.empty(len(some), np.uint8), np.empty_like(node)
                for _ in range(depth):
                    feature.take(node, out=f, mode="clip")
                    f += start
                    flat.take(f, out=v, mode="clip")
                    at.take(node, out=b, mode="clip")
                    left.take(node, out=kid, mode="clip")
                    kid += v > b
                    node, kid = kid, node
                mine = place.take(node)
                if depth:
                    stay = np.flatnonzero(mine >= 0)
                    some, mine = some[stay], mine[stay]
                held[t] += layout.tally(rows, some, w[some], mine, subset)
        for t, hist in held.items():
            for c, lo in enumerate(range(0, len(hist), TOGETHER * cell)):
                kind, raw = _shrunk(hist[lo:lo + TOGETHER * cell].ravel())
                yield pa.RecordBatch.from_pydict({"tree": pa.array([t], pa.int32()), "chunk": pa.array([c], pa.int32()), "kind": pa.array([kind]), "hist": pa.array([raw], pa.binary())})

    def split(table: pa.Table) -> pa.Table:
        t, c = table.column("tree")[0].as_py(), table.column("chunk")[0].as_py()
        subset, own = known.value[t][4][c * TOGETHER:(c + 1) * TOGETHER], known.value[t][6]
        hist = np.zeros(subset.size * layout.bins * layout.channels)
        for kind, raw in zip(table.column("kind").to_pylist(), table.column("hist")):
            hist += np.frombuffer(raw.as_buffer(), kind)
        hist = hist.reshape(-1, layout.channels)
        sums = hist[:layout.bins].sum(0)
        found = best_of(hist, rules.weighed(matrix, sums) if own is None else own, subset, layout.bins, rules)
        return pa.table({"tree": pa.array([t], pa.int32()), "chunk": pa.array([c], pa.int32()), **{k: pa.array([np.ascontiguousarray(v).astype(kind).tobytes()], pa.binary()) for k, v, kind in zip(
            ("feature", "bin", "gain", "total", "left", "sums"), (*found, sums), ("<i2", "<i2", "<f8", "<f8", "<f8", "<f8"))}})

    by_tree: dict[int, list] = {}
    for r in blocks.mapInArrow(tally, "tree int, chunk int, kind string, hist binary").groupBy("tree", "chunk").applyInArrow(split, _SPLIT_SCHEMA).collect():
        by_tree.setdefault(r["tree"], []).append(r)
    for g in group:
        parts = sorted(by_tree[g.number], key=lambda r: r["chunk"])
        get = lambda name, kind: np.concatenate([np.frombuffer(p[name], kind) for p in parts])  # noqa: B023, E731
        if g.matrix is None:
            g.matrix = rules.weighed(matrix, np.frombuffer(parts[0]["sums"], "<f8"))
        width = matrix.shape[1]
        g.settle(rules, get("feature", "<i2").astype(np.int64), get("bin", "<i2").astype(np.int64), get("gain", "<f8"), get("total", "<f8").reshape(-1, width), get("left", "<f8").reshape(-1, width))
    known.unpersist()


# ---------------------------------------------------------------------------
# MLlib's estimators and models
# ---------------------------------------------------------------------------

def decided(stats: np.ndarray, classes: int) -> np.ndarray:
    """Prediction of each node."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return stats[:, :-1].argmax(1).astype(float) if classes else np.where(stats[:, 0] > 0, stats[:, 1] / stats[:, 0], 0.0)


def pruned(left: np.ndarray, leaf: np.ndarray, says: np.ndarray) -> np.ndarray:
    """Leaves (a mask) when splits whose two sides are leaves that say the same are taken back."""
    leaf = leaf.copy()
    levels, node = [], np.zeros(1, np.int64)
    while len(node):
        node = node[~leaf[node]]
        levels.append(node)
        node = np.concatenate([left[node], left[node] + 1])
    for node in reversed(levels):
        a, b = left[node], left[node] + 1
        leaf[node[leaf[a] & leaf[b] & (says[a] == says[b])]] = True
    return leaf


def _nodes(tree: Tree, classes: int, cuts: list[np.ndarray], rules: Rules) -> pa.Table:
    """The pruned tree's nodes as MLlib keeps them."""
    says = decided(tree.stats, classes)
    leaf = pruned(tree.left, tree.feature < 0, says)
    keep, node = np.zeros(len(leaf), bool), np.zeros(1, np.int64)
    while len(node):
        keep[node] = True
        node = node[~leaf[node]]
        node = np.concatenate([tree.left[node], tree.left[node] + 1])
    at = np.flatnonzero(keep)
    number, inner = np.cumsum(keep) - 1, ~leaf[at]
    child = np.where(inner, number[np.where(inner, tree.left[at], 0)], -1)
    n = len(at)
    limits = [cuts[f][b] for f, b in zip(tree.feature[at][inner], tree.bin[at][inner])]
    offsets = np.concatenate([[0], np.cumsum(inner)]).astype(np.int32)
    width = classes or 3
    fields = {"id": pa.array(np.arange(n), pa.int32()), "prediction": pa.array(says[at]), "impurity": pa.array(rules.spread(tree.stats[at])),
              "impurityStats": pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(np.ascontiguousarray(tree.stats[at][:, :width]).ravel())),
              "rawCount": pa.array(tree.stats[at][:, -1].astype(np.int64)), "gain": pa.array(np.where(inner, tree.gain[at], -1.0)),
              "leftChild": pa.array(child, pa.int32()), "rightChild": pa.array(np.where(inner, child + 1, -1), pa.int32()),
              "split": pa.StructArray.from_arrays([pa.array(np.where(inner, tree.feature[at], -1), pa.int32()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(limits, pa.float64())),
                                                   pa.array(np.full(n, -1), pa.int32())], ["featureIndex", "leftCategoriesOrThreshold", "numCategories"])}
    return pa.table({"treeID": pa.array(np.full(n, tree.number), pa.int32()), "nodeData": pa.StructArray.from_arrays(list(fields.values()), list(fields))})


def _model(est, trees: list[Tree], packed: Packed, rules: Rules):
    """MLlib's model of the trees, by the files that it is saved as."""
    from pyspark.ml.classification import RandomForestClassificationModel
    from pyspark.ml.regression import RandomForestRegressionModel

    spark, classes = packed.blocks.sparkSession, packed.classes
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/forest-{uuid.uuid4().hex}"
    kind = ("classification", "Classification") if classes else ("regression", "Regression")
    own, given = ({p.name: v for p, v in m.items()} for m in (est._paramMap, est._defaultParamMap))
    of_tree = {"cacheNodeIds", "checkpointInterval", "featuresCol", "impurity", "labelCol", "leafCol", "maxBins", "maxDepth", "maxMemoryInMB", "minInfoGain", "minInstancesPerNode",
               "minWeightFractionPerNode", "predictionCol", "probabilityCol", "rawPredictionCol", "seed"}

    def about(name: str, uid: str, only=None, **more) -> str:
        pick = lambda m: {k: v for k, v in m.items() if only is None or k in only}
        return json.dumps({"class": f"org.apache.spark.ml.{kind[0]}.{name}{kind[1]}Model", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "uid": uid,
                           "paramMap": pick(own), "defaultParamMap": pick(given), **more})

    more = {"numFeatures": packed.d, **({"numClasses": classes} if classes else {})}
    text = about("RandomForest", est.uid, **more, numTrees=len(trees))
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    spark.createDataFrame([(t.number, about("DecisionTree", f"tree_{t.number}", of_tree, **more), 1.0) for t in trees], "_1 int, _2 string, _3 double") \
        .coalesce(1).write.parquet(f"{path}/treesMetadata")
    spark.createDataFrame(pa.concat_tables([_nodes(t, classes, packed.cuts, rules) for t in trees])).write.parquet(f"{path}/data")
    return (RandomForestClassificationModel if classes else RandomForestRegressionModel).load(path)


def fit(est, df: DataFrame, features: Sequence[str], unit_rows: int = UNIT_ROWS):
    """The model that MLlib's random-forest estimator ``est`` describes, of the columns ``features`` of ``df``."""
    from pyspark.ml.classification import RandomForestClassifier

    of = est.getOrDefault
    classification = isinstance(est, RandomForestClassifier)
    weight = of("weightCol") if est.isDefined("weightCol") else None
    packed = pack(df, features, of("labelCol"), classification, weight, of("maxBins"))
    rules = Rules(subset_size(of("featureSubsetStrategy"), packed.d, of("numTrees"), classification), of("impurity"), of("minInstancesPerNode"), of("minInfoGain"),
                  of("minWeightFractionPerNode") * packed.weight, depth=of("maxDepth"))
    trees = grow_trees(packed, of("numTrees"), of("seed"), rules, Copies(of("bootstrap"), of("subsamplingRate")), unit_rows)
    return _model(est, trees, packed, rules)


# ---------------------------------------------------------------------------
# searches
# ---------------------------------------------------------------------------

@dataclass(frozen=True)
class Draw:
    """A forest of a search. ``classWeight``: None, "balanced" (by the training rows) or "balanced_subsample" (by each tree's sample)."""

    trees: int = 100
    depth: int | None = 10
    minInstancesPerNode: int = 1
    minRowsToSplit: int = 2
    featureSubsetStrategy: str = "auto"
    classWeight: str | None = None

    def kind(self) -> tuple:
        """Draws of one kind have the same trees, cut at other places."""
        return self.minInstancesPerNode, self.featureSubsetStrategy, self.classWeight


def shares(tree: Tree, classes: int, draws: Sequence[Draw]) -> list[np.ndarray]:
    """For each draw the shares of classes 1, 2, ... that a row at each node gets, as multiples of 2^-32: those of the
    first node on its way that is a leaf of the draw's (pruned) tree."""
    says = decided(tree.stats, classes)
    with np.errstate(divide="ignore", invalid="ignore"):
        total = tree.stats[:, :-1].sum(1)
        share = np.where(total[:, None] > 0, np.round(tree.stats[:, 1:-1] / total[:, None] * _STEP) / _STEP, 0.0).T
    levels, node = [], np.zeros(1, np.int64)
    while len(node):
        levels.append(node)
        node = node[tree.feature[node] >= 0]
        node = np.stack([tree.left[node], tree.left[node] + 1], axis=1).ravel().astype(np.int64)
    deep = np.empty(len(tree.feature), np.int64)
    for at, node in enumerate(levels):
        deep[node] = at
    out, known = [], {}
    for draw in draws:
        cut = draw.depth, draw.minRowsToSplit
        if cut not in known:
            leaf = (tree.feature < 0) | (tree.stats[:, -1] < draw.minRowsToSplit)
            leaf = pruned(tree.left, leaf if draw.depth is None else leaf | (deep >= draw.depth), says)
            ends = np.where(leaf, np.arange(len(leaf)), -1)
            for node in levels[:-1]:
                node = node[tree.feature[node] >= 0]
                for kid in (tree.left[node].astype(np.int64), tree.left[node].astype(np.int64) + 1):
                    ends[kid] = np.where(ends[node] >= 0, ends[node], ends[kid])
            known[cut] = share[:, ends]
        out.append(known[cut])
    return out


def walk(tree: Tree, x: np.ndarray) -> np.ndarray:
    """The leaf of each row of bins."""
    d, leaf = x.shape[1], tree.feature < 0
    feature, at, left = np.where(leaf, 0, tree.feature).astype(np.int64), np.where(leaf, 255, tree.bin).astype(np.uint8), np.where(leaf, np.arange(len(leaf)), tree.left).astype(np.int64)
    out, flat = np.empty(len(x), np.int64), x.ravel()
    for lo in range(0, len(x), BLOCK_ROWS):
        row = np.arange(lo, min(lo + BLOCK_ROWS, len(x)))
        start, node = row * d, np.zeros(len(row), np.int64)
        while len(row):
            for _ in range(3):
                node = left.take(node) + (flat.take(start + feature.take(node)) > at.take(node))
            done = leaf.take(node)
            out[row[done]] = node[done]
            row, start, node = row[~done], start[~done], node[~done]
    return out


class _Votes:
    """Sums of the class shares of a task's rows, draw by draw."""

    def __init__(self, classes: int, draws: list[Draw], kinds: list[tuple], mine: list[tuple[int, int]], n: int):
        self.classes, self.draws = classes, draws
        self.touched = {k: [i for i, d in enumerate(draws) if d.kind() == kinds[k]] for k in sorted({k for k, _ in mine})}
        self.cols = sorted(i for v in self.touched.values() for i in v)
        self.total = np.zeros((len(self.cols), classes - 1, n))

    def add(self, kind: int, number: int, tree: Tree, x: np.ndarray) -> None:
        some = [i for i in self.touched[kind] if number < self.draws[i].trees]
        node = walk(tree, x)
        for i, share in zip(some, shares(tree, self.classes, [self.draws[i] for i in some])):
            self.total[self.cols.index(i)] += share[:, node]

    def sent(self, blocks: list[tuple[int, int, bytes]]) -> Iterator[pa.RecordBatch]:
        at, cols = 0, np.array(self.cols, np.int32).tobytes()
        for block, n, y in blocks:
            part = self.total[:, :, at:at + n].reshape(-1, n)
            yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int64()), **{k: pa.array([v], pa.binary()) for k, v in (("y", y), ("cols", cols), ("total", _sums_of(part)))}})
            at += n


def search(train: DataFrame, val: DataFrame, features: Sequence[str], label: str, draws: Sequence[Draw], seed: int = 42, unit_rows: int = UNIT_ROWS) -> DataFrame:
    """Confusion counts of every draw's forest on ``val`` (trial, tn, fp, fn, tp; class 1 against the others). Draws of one kind
    share their trees, which grow once, as deep as the deepest of them, and are scored as cut for each. While a task may hold all rows, trees
    are scored where they grow and nowhere kept; of more rows they grow by levels, are written, and tasks with a part of ``val`` each read them."""
    spark, draws = train.sparkSession, list(draws)
    packed = pack(train, features, label, True)
    layout, classes, d = _Layout.of(packed), packed.classes, packed.d
    if packed.kinds is None:
        raise ValueError(f"a search tells {KINDS} classes apart at most")
    held = written(_input(val, features, label, None).mapInArrow(_packer(packed.cuts, None, False), "n int, x binary, k binary, y binary, w binary, h binary")
                   .withColumn("block", F.monotonically_increasing_id()).drop("k", "w", "h"))
    n_val = held.agg(F.sum("n")).first()[0] or 0
    kinds = list(dict.fromkeys(x.kind() for x in draws))
    of = lambda k: [x for x in draws if x.kind() == kinds[k]]
    rules, matrices = [], []
    for k, (leaf, subset, balance) in enumerate(kinds):
        if balance not in (None, "balanced", "balanced_subsample"):
            raise ValueError(balance)
        depths = [x.depth for x in of(k)]
        rules.append(Rules(subset_size(subset, d, max(x.trees for x in of(k)), True), min_leaf=leaf, min_split=min(x.minRowsToSplit for x in of(k)),
                           depth=None if None in depths else max(depths), balance=balance == "balanced_subsample"))
        matrices.append(replace(rules[-1], balance=True).weighed(packed.matrix(), packed.counts) if balance == "balanced" else packed.matrix())
    todo = [(k, t) for k in range(len(kinds)) for t in range(max(x.trees for x in of(k)))]
    copies, tasks = Copies(True, 1.0), max(1, spark.sparkContext.defaultParallelism)

    def arrays(batch: pa.RecordBatch, r: int) -> tuple[np.ndarray, tuple[int, int, bytes]]:
        get = lambda name: batch.column(batch.schema.get_field_index(name))[r]
        return np.frombuffer(get("x").as_buffer(), np.uint8).reshape(-1, d), (get("block").as_py(), get("n").as_py(), get("y").as_py())

    schema = "block long, y binary, cols binary, total binary"
    if packed.n + n_val <= unit_rows:
        ends = _shares([1] * len(todo), tasks)
        runs = [todo[a:b] for a, b in zip(ends, ends[1:])]

        def grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            task, parts = _first(batches)
            mine = runs[task] if task >= 0 else []
            if not mine:
                return
            block = lambda batch: batch.column(batch.schema.get_field_index("block"))
            # blocks without a number are training rows
            learnt = [b.filter(block(b).is_null()) for b in parts]
            scored = [arrays(b, r) for b in parts for r in range(b.num_rows) if block(b)[r].as_py() is not None]
            rows = layout.whole(b for b in learnt if b.num_rows)
            x = np.concatenate([a for a, _ in scored]) if scored else np.zeros((0, d), np.uint8)
            votes = _Votes(classes, draws, kinds, mine, len(x))
            for k, t in mine:
                votes.add(k, t, grow(layout, rows, copies(rows.h, seed, t), t, seed, matrices[k], rules[k]), x)
            yield from votes.sent([b for _, b in scored])

        both = packed.blocks.select("n", "x", "k", "y", "w", "h", F.lit(None).cast("long").alias("block")) \
            .unionByName(held, allowMissingColumns=True)
        sums = every_block(both, tasks).mapInArrow(grown, schema)
    else:
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/search-{uuid.uuid4().hex}"
        for k in range(len(kinds)):
            numbers = [t for j, t in todo if j == k]
            for lo in range(0, len(numbers), 10):  # so many on the driver at once
                some = _by_levels(packed, numbers[lo:lo + 10], seed, rules[k], copies, matrices[k])
                rows = [(k, *[bytearray(v) if isinstance(v, bytes) else v for v in t.packed().values()]) for t in some]
                spark.createDataFrame(rows, "kind int, " + TREE_SCHEMA).write.mode("append").parquet(path)
        everyone = spark.read.schema("kind int, " + TREE_SCHEMA).parquet(path)
        parts = max(tasks, -(-n_val // unit_rows))

        def scored(left: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found, votes = None, None
            for batch in left:
                for r in range(batch.num_rows):
                    row = {name: batch.column(i)[r].as_py() for i, name in enumerate(batch.schema.names)}
                    if row["tree"] is None:
                        found = found or []
                        found.append(arrays(batch, r))
                        continue
                    if not found:
                        return
                    if votes is None:
                        x = np.concatenate([a for a, _ in found])
                        votes = _Votes(classes, draws, kinds, todo, len(x))
                    votes.add(row["kind"], row["tree"], Tree.unpacked(row | {"n": row["nodes"]}), x)
            if votes is not None:
                yield from votes.sent([b for _, b in found])

        # each task has all trees, after its part of the rows
        both = every_block(everyone.withColumnRenamed("n", "nodes").unionByName(held.select("block", "n", "x", "y"), allowMissingColumns=True), parts)
        both = both.filter(F.col("tree").isNotNull() | (F.pmod(F.xxhash64("block"), F.lit(parts)) == F.col("task"))).sortWithinPartitions(F.col("tree").asc_nulls_first(), "kind")
        sums = both.mapInArrow(scored, schema)

    def counted(group: pa.Table) -> pa.Table:
        y = np.frombuffer(group.column("y")[0].as_py(), np.float64)
        total = np.zeros((len(draws), classes - 1, len(y)))
        for cols, raw in zip(group.column("cols").to_pylist(), group.column("total").to_pylist()):
            cols = np.frombuffer(cols, np.int32)
            total[cols] += _sums_from(raw, len(cols) * (classes - 1), len(y)).reshape(len(cols), classes - 1, -1)
        every = np.concatenate([np.array([x.trees for x in draws])[:, None, None] - total.sum(1, keepdims=True), total], axis=1)
        hit, yes, no = every.argmax(1) == 1, y == 1, (y != 1) & ~np.isnan(y)
        return pa.table({"trial": pa.array(np.arange(len(draws)), pa.int32()), **{name: pa.array((a & b).sum(1)) for name, a, b in (
            ("tn", no, ~hit), ("fp", no, hit), ("fn", yes, ~hit), ("tp", yes, hit))}})

    return sums.groupBy("block").applyInArrow(counted, "trial int, tn long, fp long, fn long, tp long").groupBy("trial").agg(*[F.sum(x).alias(x) for x in ("tn", "fp", "fn", "tp")])
