"""Isolation forests on Spark (ML8, EV1, XP1, XP8, SNK5), after Liu, Ting & Zhou (2008).

Many trees of many forests are grown in one job, each from a sample of any size:

* **Sampling.** A row has one key hash; mixed with a tree's salt it gives a
  uniform number, and the tree takes the rows with the psi smallest ones (one pass counts the
  rows surely below the cut, the few near it are ranked by a window). Nothing depends on partitioning or retries.
* **Growing by levels.** While a node has more rows than a task should hold,
  tasks route their rows through the tops of all trees and send only the bounds
  (count, least and greatest value of each feature) of the open nodes.
* **Finishing in tasks.** What is left, subtrees of at most ``UNIT_ROWS`` rows (whole trees on most
  tables), is dealt into bins. A row is sent once to each bin that needs it, in packed blocks, and a bin's
  task grows its subtrees level by level in numpy.
* **Draws** come from hashes of (seed, tree, node), so a tree is the same however it was grown.
* **Scoring.** A small model (``BROADCAST_BYTES``) is broadcast. A larger one stays a table: rows are
  dealt to the bins like above, each bin sends path sums, and these are added up by row. Path lengths are multiples of 2^-32,
  so their sums are exact in any order.

s = 2^(-E[h(x)]/c(psi)), higher = more anomalous (the reference's sign flip).
"""

from __future__ import annotations

import json
import math
import os
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from ..session import ensure_checkpoint_dir, ship_package, written

EULER_GAMMA = 0.5772156649015329
#: Rows of one subtree that a task grows by itself.
UNIT_ROWS = 1 << 20
#: Rows of which each task may hold all, to grow whole trees and score the rows beside them; sampled rows of a forest
#: whose nodes are not kept but grown again for each scoring.
WHOLE_ROWS, KEPT_ROWS = 1 << 22, 1 << 27
#: Largest model that is sent to every worker.
BROADCAST_BYTES = 64 << 20
#: Rows that one scoring task handles at most, as dealt.
SCORE_ROWS = 1 << 21
#: Sampled rows that a task holds of a bin, and draws near cuts, before it sends them.
BLOCK_ROWS, SENT_ROWS = 1 << 13, 1 << 16
UNIT_SCHEMA = "tree int, node long, depth int, n int, size long, feature binary, value binary, splits array<long>"
NODE_SCHEMA = ("tree int, node long, feature int, threshold double, left long, right long, size long, depth int, "
               "leaf boolean, path double")
_STEP = 2.0 ** 32


def c_factor(n: float) -> float:
    """Average path length of an unsuccessful BST search, c(n)."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + EULER_GAMMA) - 2.0 * (n - 1.0) / n


def _c_vec(n: np.ndarray) -> np.ndarray:
    n = n.astype(float)
    out = np.zeros_like(n)
    out[n == 2] = 1.0
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER_GAMMA) - 2.0 * (n[big] - 1.0) / n[big]
    return out


# ---------------------------------------------------------------------------
# hashed draws
# ---------------------------------------------------------------------------

_MIX1, _MIX2, _GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def _mix(z: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser."""
    with np.errstate(over="ignore"):
        z = np.asarray(z, np.uint64) + _GOLD
        if z.ndim:  # in place
            t = z >> np.uint64(30)
            z ^= t
            z *= _MIX1
            z ^= np.right_shift(z, np.uint64(27), out=t)
            z *= _MIX2
            z ^= np.right_shift(z, np.uint64(31), out=t)
            return z
        z = (z ^ (z >> np.uint64(30))) * _MIX1
        z = (z ^ (z >> np.uint64(27))) * _MIX2
        return z ^ (z >> np.uint64(31))


def _draw(salt: np.uint64, node: np.ndarray, k: int) -> np.ndarray:
    """k-th 64-bit draw of each node of a tree."""
    with np.errstate(over="ignore"):
        return _mix(_mix(node.astype(np.uint64) ^ salt) + np.uint64(k) * _GOLD)


def _unit(z: np.ndarray) -> np.ndarray:
    return (z >> np.uint64(11)).astype(np.float64) * 2.0 ** -53


# ---------------------------------------------------------------------------
# parameters
# ---------------------------------------------------------------------------

@dataclass
class IsolationForestParams:
    """``fold`` leaves out the training rows whose fold column has that value,
    ``share`` takes only that part of the others (by their own uniform draw)."""

    features: Sequence[str]
    key: Sequence[str]
    n_estimators: int = 100
    max_samples: str | float | int = "auto"
    contamination: str | float = "auto"
    max_features: float = 1.0
    bootstrap: bool = False
    seed: int = 42
    fold: int | None = None
    share: float = 1.0


def sample_size(params: IsolationForestParams, n: int) -> int:
    ms = params.max_samples
    if ms == "auto":
        return max(1, min(256, n))
    return max(1, int(ms * n) if isinstance(ms, float) and ms <= 1.0 else min(int(ms), n))


@dataclass
class _Tree:
    salt: int
    cut: int | None        # rows with a draw up to this belong (None: drawn with replacement)
    rate: float            # mean copies of a row when drawn with replacement
    depth: int
    features: list[int]
    fold: int | None
    share: float

    def copies(self, h: np.ndarray, fold: np.ndarray, share: np.ndarray) -> np.ndarray:
        """How often each row is in the tree's sample."""
        u = _mix(h ^ np.uint64(self.salt))
        if self.cut is not None:
            w = (u <= np.uint64(self.cut)).astype(np.int64)
        else:
            term = total = math.exp(-self.rate)
            steps = [total]
            while total < 1 - 1e-15 and len(steps) < 1000:
                term *= self.rate / len(steps)
                total += term
                steps.append(total)
            w = np.searchsorted(np.array(steps), _unit(u), "right").astype(np.int64)
        outside = self.outside(fold, share)
        if outside is not None:
            w[outside] = 0
        return w

    def outside(self, fold: np.ndarray, share: np.ndarray) -> np.ndarray | None:
        """Rows that the tree may not use (none: all may be)."""
        if self.fold is None and self.share >= 1.0:
            return None
        return (fold == self.fold if self.fold is not None else False) | (share >= self.share)


# ---------------------------------------------------------------------------
# growing and walking one subtree (numpy, inside tasks)
# ---------------------------------------------------------------------------

def choose(salt: np.uint64, node: np.ndarray, allowed: np.ndarray, bounds) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature (-1: constant on all allowed ones) and bounds of each node:
    features are drawn until one varies. ``bounds(which, feature)`` gives the
    least and greatest value of ``feature`` in the nodes ``which``."""
    feature, lo, hi = np.full(len(node), -1), np.zeros(len(node)), np.zeros(len(node))
    left = np.arange(len(node))
    for attempt in range(8):
        if not len(left):
            return feature, lo, hi
        f = allowed[(_draw(salt, node[left], 2 + attempt) % np.uint64(len(allowed))).astype(np.int64)]
        a, z = bounds(left, f)
        ok = z > a
        feature[left[ok]], lo[left[ok]], hi[left[ok]] = f[ok], a[ok], z[ok]
        left = left[~ok]
    if len(left):  # an order of all features for the few nodes still constant
        order = np.argsort(np.stack([_draw(salt, node[left], 64 + int(f)) for f in allowed]), axis=0, kind="stable")
        for rank in range(len(allowed)):
            f = allowed[order[rank]]
            a, z = bounds(left, f)
            ok = (z > a) & (feature[left] < 0)
            feature[left[ok]], lo[left[ok]], hi[left[ok]] = f[ok], a[ok], z[ok]
    return feature, lo, hi


def split_value(salt: np.uint64, node: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    at = lo + _unit(_draw(salt, node, 1)) * (hi - lo)
    return np.where(at <= lo, np.nextafter(lo, hi), np.minimum(at, hi))


def _path(depth, size: np.ndarray) -> np.ndarray:
    """Path length of leaves at ``depth`` with ``size`` rows, a multiple of 2^-32."""
    return np.round((depth + _c_vec(size)) * _STEP) / _STEP


def grow(x: np.ndarray, copies: np.ndarray, salt: int, root: int, depth: int, limit: int, allowed: Sequence[int], ends: np.ndarray | None = None):
    """A subtree below node ``root`` at ``depth`` from the rows ``x`` (features by
    rows), all nodes of a level at once. Nodes in level order: feature (-1: leaf),
    value (threshold; of a leaf its size) and the number of splits by feature. ``ends`` takes the path length of each row."""
    salt, allowed = np.uint64(salt), np.asarray(allowed)
    d, m = x.shape
    flat = np.ascontiguousarray(x).ravel()
    # places in 32 bits while they fit: half the memory moved by each level
    small = np.int32 if d * m < 1 << 31 else np.int64
    order, places = np.arange(m, dtype=small), np.arange(m, dtype=small)
    weight = None if (copies == 1).all() else copies
    starts, sizes, node = np.zeros(1, np.int64), np.array([m]), np.array([root], np.int64)
    features, values = [], []
    while len(node):
        held = sizes if weight is None else np.add.reduceat(weight[order], starts) if len(order) else np.zeros(len(node), np.int64)
        can = np.flatnonzero((held > 1) & (sizes > 1) & (depth < limit))
        feature, value = np.full(len(node), -1, np.int16), held.astype(np.float64)
        if len(can):
            # rows of the nodes that may split, node by node
            if len(can) < len(node):
                inside = np.repeat(_mask(can, len(node)), sizes)
                if ends is not None:
                    out = ~_mask(can, len(node))
                    ends[order[~inside]] = np.repeat(_path(depth, held[out]), sizes[out])
                order = order[inside]
                starts, sizes, node = None, sizes[can], node[can]
            starts = np.cumsum(sizes) - sizes
            drawn = {}

            def bounds(which, f):
                if len(which) == len(sizes):
                    rows, at, mine = order, starts, np.repeat((f * m).astype(small), sizes)
                else:
                    part = sizes[which]
                    at = np.cumsum(part) - part
                    rows = order[np.repeat(starts[which] - at, part) + np.arange(part.sum())]
                    mine = np.repeat(f * m, part)
                v = flat.take(mine + rows)
                if len(which) == len(sizes):
                    drawn["f"], drawn["v"] = f, v
                return np.minimum.reduceat(v, at), np.maximum.reduceat(v, at)

            f, lo, hi = choose(salt, node, allowed, bounds)
            at = split_value(salt, node, lo, hi)
            split = f >= 0
            feature[can] = f
            value[can[split]] = at[split]
            v = drawn["v"]
            again = np.flatnonzero(split & (drawn["f"] != f))
            if len(again):  # nodes whose first feature was constant
                part = sizes[again]
                place = np.repeat(starts[again] - (np.cumsum(part) - part), part) + np.arange(part.sum())
                v[place] = flat[np.repeat(f[again] * m, part) + order[place]]
            if not split.all():
                keep = np.repeat(split, sizes)
                if ends is not None:
                    ends[order[~keep]] = np.repeat(_path(depth, held[can[~split]]), sizes[~split])
                order, v = order[keep], v[keep]
                sizes, node, at = sizes[split], node[split], at[split]
                starts = np.cumsum(sizes) - sizes
            if len(node):
                # rows move to their child, in order, within the place of their node
                left = v < np.repeat(at, sizes)
                before = np.cumsum(left, dtype=small)
                before -= left
                first = before[starts]
                n_left = np.add.reduceat(left, starts, dtype=np.int64)
                # left rows: start of the node + rows gone left before; right rows: their place + left rows still to come
                up = before + np.repeat((starts - first).astype(small), sizes)
                down = places[:len(order)] - before
                down += np.repeat((n_left + first).astype(small), sizes)
                moved = np.empty_like(order)
                moved[np.where(left, up, down)] = order
                order = moved
                sizes = np.stack([n_left, sizes - n_left], axis=1).ravel()
                starts = np.cumsum(sizes) - sizes
                node = np.stack([2 * node, 2 * node + 1], axis=1).ravel()
        elif ends is not None:
            ends[order] = np.repeat(_path(depth, held), sizes)
        features.append(feature)
        values.append(value)
        depth += 1
        if not (feature >= 0).any():
            break
    feature, value = np.concatenate(features), np.concatenate(values)
    return feature, value, np.bincount(feature[feature >= 0], minlength=d)


def _mask(which: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, bool)
    out[which] = True
    return out


def unfold(feature: np.ndarray, value: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a subtree in level order: left child of each node (right: the next; -1 for leaves),
    depth, and value with the path length in the place of a leaf's size."""
    inner = feature >= 0
    left = np.where(inner, 2 * (np.cumsum(inner) - inner) + 1, -1)
    depths = np.empty(len(feature), np.int64)
    lo, hi = 0, 1
    while lo < len(feature):
        depths[lo:hi] = depth
        lo, hi, depth = hi, hi + 2 * int(inner[lo:hi].sum()), depth + 1
    path = _path(depths, np.where(inner, 1, value))
    return left, depths, np.where(inner, value, path)


def walkable(feature: np.ndarray, value: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature, threshold and left child of each node for a walk without tests for leaves: a leaf leads to itself."""
    leaf = feature < 0
    return np.where(leaf, 0, feature).astype(np.int64), np.where(leaf, np.nan, value), np.where(leaf, np.arange(len(feature)), left).astype(np.int64)


def paths(x: np.ndarray, feature: np.ndarray, value: np.ndarray, left: np.ndarray, root: int = 0, chunk: int = 1 << 13, ready=None) -> np.ndarray:
    """Path length of each column of ``x`` (features by rows), a few rows at a
    time so that what a step reads and writes stays in the cache. Rows at a leaf stay there
    until many are; ``ready``: the ``walkable`` arrays, if they are at hand."""
    d, n = x.shape
    out = np.empty(n)
    split, limit, child = walkable(feature, value, left) if ready is None else ready
    for lo in range(0, n, chunk):
        flat = x[:, lo:lo + chunk].T.ravel()  # by rows
        done, w = out[lo:lo + chunk], min(chunk, n - lo)
        rows, at, live = np.arange(w) * d, np.full(w, root, np.int64), None
        place, kid, v, t, right = np.empty(w, np.int64), np.empty(w, np.int64), np.empty(w), np.empty(w), np.empty(w, bool)
        step = 0
        while True:
            split.take(at, out=place, mode="clip")
            place += rows
            flat.take(place, out=v, mode="clip")
            limit.take(at, out=t, mode="clip")
            np.greater_equal(v, t, out=right)
            child.take(at, out=kid, mode="clip")
            kid += right
            at, kid = kid, at
            step += 1
            if step < 8 or step % 4:
                continue
            inner = feature.take(at) >= 0
            going = np.count_nonzero(inner)
            if not going:
                break
            if going * 4 < 3 * len(at):
                live = np.arange(w) if live is None else live
                done[live[~inner]] = value.take(at[~inner])
                rows, at, live = rows[inner], at[inner], live[inner]
                place, kid, v, t, right = place[:going], kid[:going], v[:going], t[:going], right[:going]
        if live is None:
            value.take(at, out=done, mode="clip")
        else:
            done[live] = value.take(at)
    return out


def _walkable(a: dict):
    """The ``walkable`` arrays of a flat model, made once a worker."""
    if "ready" not in a:
        a["ready"] = walkable(a["feature"], a["value"], a["left"])
    return a["ready"]


def boxes(feature: np.ndarray, value: np.ndarray, left: np.ndarray, root: int, d: int):
    """Nodes of one tree of a flat model in level order, and the least (reached) and first
    excluded value of each feature there: (nodes, lo, hi), the bounds as (features, nodes)."""
    node, lo, hi = np.array([root]), np.full((d, 1), -np.inf), np.full((d, 1), np.inf)
    levels = []
    while len(node):
        levels.append((node, lo, hi))
        inner = np.flatnonzero(feature[node] >= 0)
        at, f, place = value[node[inner]], feature[node[inner]].astype(np.int64), np.arange(len(inner))
        below, above = hi[:, inner].copy(), lo[:, inner].copy()
        below[f, place], above[f, place] = np.minimum(below[f, place], at), np.maximum(above[f, place], at)
        kids = left[node[inner]].astype(np.int64)
        node, lo, hi = np.concatenate([kids, kids + 1]), np.concatenate([lo[:, inner], above], axis=1), np.concatenate([below, hi[:, inner]], axis=1)
    return np.concatenate([a for a, _, _ in levels]), np.concatenate([a for _, a, _ in levels], axis=1), np.concatenate([a for _, _, a in levels], axis=1)


def add_varied(total: np.ndarray, x: np.ndarray, feature: np.ndarray, value: np.ndarray, left: np.ndarray, root: int, j: int, points: np.ndarray) -> None:
    """Adds one tree's path lengths of the columns of ``x`` with feature ``j`` set to each of the
    ascending ``points``, as steps: ``total`` (rows, points + 1) has them after a running sum. A row
    goes both ways at the splits of ``j`` that part the points, so it is walked once for all of them."""
    node, lo, hi = boxes(feature, value, left, root, x.shape[0])
    base, width = int(node.min()), points.size + 1
    # points of each node: from first to last
    first, last = np.zeros(int(node.max()) - base + 1, np.int64), np.zeros(int(node.max()) - base + 1, np.int64)
    first[node - base] = np.searchsorted(points, lo[j], "left")
    last[node - base] = np.where(np.isposinf(hi[j]), points.size, np.searchsorted(points, hi[j], "left"))
    n, flat, steps = x.shape[1], x.ravel(), total.ravel()
    rows, at = np.arange(n), np.full(n, root, np.int64)
    while len(rows):
        f = feature.take(at).astype(np.int64)
        leaf = f < 0
        if leaf.any():
            r, end = rows[leaf], at[leaf]
            path, r, end = value.take(end), r * width, end - base
            # leaves of one row hold different points: no place comes twice
            steps[r + first.take(end)] += path
            steps[r + last.take(end)] -= path
            rows, at, f = rows[~leaf], at[~leaf], f[~leaf]
        kids = left.take(at).astype(np.int64)
        free = f == j
        if not free.any():
            at = kids + (flat.take(f * n + rows) >= value.take(at))
            continue
        bound = ~free
        both, kids_both, r, k = rows[free], kids[free], rows[bound], kids[bound]
        at = np.concatenate([k + (flat.take(f[bound] * n + r) >= value.take(at[bound])), kids_both, kids_both + 1])
        rows = np.concatenate([r, both, both])
        some = first.take(at - base) < last.take(at - base)
        rows, at = rows[some], at[some]


class Walker:
    """Scores of arrays (features, rows) in tasks that score many variants of their rows."""

    #: Cells of the largest table of one tree and set of features.
    CELLS = 1 << 15

    def __init__(self, bc, order: list[int], trees: list[int], scale: float):
        self.bc, self.order, self.trees, self.scale = bc, order, trees, scale

    def _roots(self):
        a = self.bc.value
        return a, [int(a["roots"][t]) for t in self.trees if a["roots"][t] >= 0]

    def _score(self, total: np.ndarray) -> np.ndarray:
        return np.power(2.0, -total / len(self.trees) / self.scale) if self.scale > 0 and self.trees else np.full(total.shape, 0.5)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        a, roots = self._roots()
        mine = np.ascontiguousarray(x[self.order])
        total = np.zeros(x.shape[1])
        for r in roots:
            total += paths(mine, a["feature"], a["value"], a["left"], r, ready=_walkable(a))
        return self._score(total)

    def varied(self, x: np.ndarray, j: int, points: np.ndarray) -> np.ndarray:
        """(rows, points): scores with feature ``j`` set to each point."""
        points = np.asarray(points, float)
        points = np.where(np.isnan(points), -np.inf, points)  # goes left everywhere
        if j not in self.order:
            return np.repeat(self(x)[:, None], points.size, axis=1)
        order = np.argsort(points, kind="stable")
        a, roots = self._roots()
        mine, at = np.ascontiguousarray(x[self.order]), self.order.index(j)
        total = np.zeros((x.shape[1], points.size + 1))
        for r in roots:
            add_varied(total, mine, a["feature"], a["value"], a["left"], r, at, points[order])
        out = np.empty((x.shape[1], points.size))
        out[:, order] = np.cumsum(total[:, :-1], axis=1)
        return self._score(out)

    def beside(self, x: np.ndarray, own: Sequence[int], background: np.ndarray) -> np.ndarray | None:
        """(rows, background): scores with the features ``own`` (one or two) of each row and the
        others of each background column, from a table of each tree over the cells of ``own``. None if one is too large."""
        a, roots = self._roots()
        mine, back = np.ascontiguousarray(x[self.order]), np.ascontiguousarray(background[self.order])
        own = [self.order.index(j) for j in own if j in self.order]
        others = [j for j in range(len(self.order)) if j not in own]
        total = np.zeros((x.shape[1], back.shape[1]))
        for r in roots:
            node, lo, hi = boxes(a["feature"], a["value"], a["left"], r, len(self.order))
            leaf = a["feature"][node] < 0
            path, lo, hi = a["value"][node[leaf]], lo[:, leaf], hi[:, leaf]
            cuts = [np.unique(lo[j])[1:] for j in own]
            shape = [len(t) + 1 for t in cuts]
            if math.prod(shape) > self.CELLS:
                return None
            inside = np.ones((len(path), back.shape[1]), bool)
            for j in others:
                # as in a walk: right from the threshold on
                inside &= ~(back[j][None, :] < lo[j][:, None]) & ((back[j][None, :] < hi[j][:, None]) | np.isposinf(hi[j])[:, None])
            table = np.zeros([*shape, back.shape[1]])
            begin = [np.searchsorted(t, lo[j], "right") for t, j in zip(cuts, own)]
            end = [np.where(np.isposinf(hi[j]), n, np.searchsorted(t, hi[j], "left") + 1) for t, j, n in zip(cuts, own, shape)]
            for k in np.flatnonzero(inside.any(axis=1)):
                table[tuple(slice(int(b[k]), int(e[k])) for b, e in zip(begin, end))] += path[k] * inside[k]
            cell = np.zeros(x.shape[1], np.int64)
            for t, j, n in zip(cuts, own, shape):
                cell = cell * n + np.searchsorted(t, mine[j], "right")
            total += table.reshape(-1, back.shape[1]).take(cell, axis=0)
        return self._score(total)


# ---------------------------------------------------------------------------
# the tops of trees: nodes grown by levels, above the units
# ---------------------------------------------------------------------------

class Tops:
    """Split nodes above the units of each tree, by their number (root 1, children 2i and 2i+1)."""

    def __init__(self, trees: int):
        self.splits: list[dict[int, tuple[int, float]]] = [{} for _ in range(trees)]
        self._tables: dict[int, tuple] = {}  # filled by the tasks that route

    def route(self, tree: int, x: np.ndarray) -> np.ndarray:
        """Number of the unit (or open node) of each row."""
        node = np.ones(x.shape[1], np.int64)
        if not self.splits[tree]:
            return node
        if tree not in self._tables:
            nodes = sorted(self.splits[tree])
            self._tables[tree] = (np.array(nodes, np.int64), np.array([self.splits[tree][k][0] for k in nodes], np.int64),
                                  np.array([self.splits[tree][k][1] for k in nodes]))
        keys, feature, at = self._tables[tree]
        live = np.arange(x.shape[1])
        while len(live):
            place = np.minimum(np.searchsorted(keys, node[live]), len(keys) - 1)
            inner = keys[place] == node[live]
            live, place = live[inner], place[inner]
            node[live] = 2 * node[live] + (x[feature[place], live] >= at[place])
        return node


# ---------------------------------------------------------------------------
# forests
# ---------------------------------------------------------------------------

def _by_salt(trees: list[_Tree], which) -> list[tuple[int, list[int]]]:
    """Trees of one salt together: a row has the same draw for all of them."""
    out: dict[int, list[int]] = {}
    for t in which:
        out.setdefault(trees[t].salt, []).append(t)
    return list(out.items())


def _sampled(trees: list[_Tree], salted: list[tuple[int, list[int]]], h: np.ndarray, fold: np.ndarray, share: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each tree with the places of its sample's rows. Rows above the largest cut of
    a salt's trees are left at once, so folds and shares are looked at for few."""
    for salt, ts in salted:
        cuts = [trees[t].cut for t in ts if trees[t].cut is not None]
        if cuts:
            u = _mix(h ^ np.uint64(salt))
            near = np.flatnonzero(u <= np.uint64(max(cuts)))
            u = u[near]
        for t in ts:
            tree = trees[t]
            if tree.cut is None:
                yield t, np.flatnonzero(tree.copies(h, fold, share))
                continue
            some = near if tree.cut == max(cuts) else near[u <= np.uint64(tree.cut)]
            outside = tree.outside(fold[some], share[some])
            yield t, some if outside is None else some[~outside]


def _numbers(df: DataFrame, features: Sequence[str], key: Sequence[str], fold: str | None, share: Column | None, keep: Sequence[Column] = ()) -> DataFrame:
    return df.select(F.xxhash64(*[F.col(f"`{k}`") for k in key]).alias("_h"), (F.col(f"`{fold}`") if fold else F.lit(-1)).cast("int").alias("_fold"),
                     (share if share is not None else F.lit(0.0)).alias("_share"), F.array(*[F.nanvl(F.coalesce(F.col(f"`{f}`").cast("double"), F.lit(0.0)), F.lit(0.0)) for f in features]).alias("_x"), *keep)


def _arrays(batch: pa.RecordBatch, d: int):
    """h, fold, share and the features by rows of a batch."""
    col = lambda name: batch.column(batch.schema.get_field_index(name))
    x = col("_x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d).T
    return col("_h").to_numpy().view(np.uint64), col("_fold").to_numpy(zero_copy_only=False), col("_share").to_numpy(), np.ascontiguousarray(x)


def _cuts(rows: DataFrame, trees: list[_Tree], want: list[int], members: list[int], d: int) -> None:
    """Sets each tree's cut to its psi-th smallest draw. One pass sends, for each
    tree, the number of rows below a bracket around psi/n and the draws inside it."""
    alike: dict[tuple, list[int]] = {}  # trees with the same draws of the same rows have the same cut
    for t, tree in enumerate(trees):
        if tree.cut == -1:
            alike.setdefault((tree.salt, want[t], members[t], tree.fold, tree.share), []).append(t)
    twins = {ts[0]: ts for ts in alike.values()}
    todo = list(twins)
    wide = 6.0
    while todo:
        ends = {}
        for t in todo:
            p = want[t] / members[t]
            slack = wide * math.sqrt(max(p * (1 - p), 1 / members[t]) / members[t])
            ends[t] = tuple(min(2 ** 64 - 1, max(0, int(e * 2.0 ** 64))) for e in (p - slack, p + slack))

        salted = [(salt, ts, max(ends[t][1] for t in ts)) for salt, ts in _by_salt(trees, todo)]

        def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            below, held, waiting = dict.fromkeys(todo, 0), [], 0

            def sent():
                # signed, in the same order
                u = np.concatenate([v for _, v in held])
                return pa.RecordBatch.from_pydict({"t": pa.array(np.repeat([t for t, _ in held], [len(v) for _, v in held]), pa.int32()),
                                                   "u": pa.array((u ^ np.uint64(1 << 63)).view(np.int64)), "below": pa.array(np.zeros(len(u), np.int64))})

            for batch in batches:
                h, fold, share, _ = _arrays(batch, d)
                for salt, ts, most in salted:
                    u = _mix(h ^ np.uint64(salt))
                    some = np.flatnonzero(u <= np.uint64(most))
                    u = u[some]
                    for t in ts:
                        lo, hi = ends[t]
                        outside = trees[t].outside(fold[some], share[some])
                        v = u if outside is None else u[~outside]
                        below[t] += int(np.count_nonzero(v < np.uint64(lo)))
                        v = v[(v >= np.uint64(lo)) & (v <= np.uint64(hi))]
                        if len(v):
                            held.append((t, v))
                            waiting += len(v)
                # few draws of a batch are near a cut: those of many batches go together
                if waiting >= SENT_ROWS:
                    yield sent()
                    held, waiting = [], 0
            if held:
                yield sent()
            yield pa.RecordBatch.from_pydict({"t": pa.array(todo, pa.int32()), "u": pa.array([None] * len(todo), pa.int64()),
                                              "below": pa.array(list(below.values()), pa.int64())})

        found = written(rows.mapInArrow(near, "t int, u long, below long"))
        below = {r["t"]: r["below"] for r in found.groupBy("t").agg(F.sum("below").alias("below")).collect()}
        need = rows.sparkSession.createDataFrame([(t, want[t] - below[t]) for t in todo], "t int, need long")
        from pyspark.sql import Window

        ranked = found.filter("u is not null").withColumn("r", F.row_number().over(Window.partitionBy("t").orderBy("u")))
        for r in ranked.join(F.broadcast(need), "t").filter("r = need").collect():  # one row a tree
            for t in twins[r["t"]]:
                trees[t].cut = r["u"] + (1 << 63)
        todo, wide = [t for t in todo if trees[t].cut == -1], wide * 4


def _level(rows: DataFrame, trees: list[_Tree], tops: Tops, open_nodes: dict[int, list[int]], d: int) -> dict:
    """Count, least and greatest values of the open nodes: {(tree, node): (n, lo, hi)}."""
    wanted = {t: np.array(sorted(v), np.int64) for t, v in open_nodes.items()}

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {t: (np.zeros(len(v), np.int64), np.full((d, len(v)), np.inf), np.full((d, len(v)), -np.inf)) for t, v in wanted.items()}
        for batch in batches:
            h, fold, share, x = _arrays(batch, d)
            for t, nodes in wanted.items():
                w = trees[t].copies(h, fold, share)
                some = np.flatnonzero(w)
                mine = x[:, some]
                node = tops.route(t, mine)
                place = np.minimum(np.searchsorted(nodes, node), len(nodes) - 1)
                ok = nodes[place] == node
                n, lo, hi = held[t]
                np.add.at(n, place[ok], w[some][ok])
                for j in range(d):
                    np.minimum.at(lo[j], place[ok], mine[j, ok])
                    np.maximum.at(hi[j], place[ok], mine[j, ok])
        for t, nodes in wanted.items():
            n, lo, hi = held[t]
            some = np.flatnonzero(n)
            if len(some):
                yield pa.RecordBatch.from_pydict({
                    "t": pa.array(np.full(len(some), t), pa.int32()), "node": pa.array(nodes[some]), "n": pa.array(n[some]),
                    **{f"a{j}": pa.array(lo[j, some]) for j in range(d)}, **{f"z{j}": pa.array(hi[j, some]) for j in range(d)}})

    schema = "t int, node long, n long, " + ", ".join(f"a{j} double" for j in range(d)) + ", " + ", ".join(f"z{j} double" for j in range(d))
    sent = rows.mapInArrow(bounds, schema).groupBy("t", "node").agg(
        F.sum("n").alias("n"), *[F.min(f"a{j}").alias(f"a{j}") for j in range(d)], *[F.max(f"z{j}").alias(f"z{j}") for j in range(d)])
    return {(r["t"], r["node"]): (r["n"], np.array([r[f"a{j}"] for j in range(d)]), np.array([r[f"z{j}"] for j in range(d)])) for r in sent.collect()}


def _tops(rows: DataFrame, trees: list[_Tree], sizes: list[int], d: int, unit_rows: int) -> tuple[Tops, list[tuple[int, int, int]], list[tuple]]:
    """Grows all trees by levels until no node has more than ``unit_rows`` rows.
    Returns the tops, the units (tree, node, rows) left to tasks, and the leaves met on the way."""
    tops, units, leaves = Tops(len(trees)), [], []
    units += [(t, 1, n) for t, n in enumerate(sizes) if n <= unit_rows]
    open_nodes = {t: [1] for t, n in enumerate(sizes) if n > unit_rows}
    while open_nodes:
        below: dict[int, list[int]] = {}
        for (t, node), (n, lo, hi) in _level(rows, trees, tops, open_nodes, d).items():
            tree, depth = trees[t], node.bit_length() - 1
            if n <= unit_rows:
                units.append((t, node, n))
                continue
            salt, one = np.uint64(tree.salt), np.array([node], np.int64)
            f, a, z = choose(salt, one, np.asarray(tree.features), lambda which, f: (lo[f], hi[f])) if depth < tree.depth else ([-1], None, None)
            if f[0] < 0:
                leaves.append((t, node, depth, n))
                continue
            tops.splits[t][node] = (int(f[0]), float(split_value(salt, one, a, z)[0]))
            below.setdefault(t, []).extend([2 * node, 2 * node + 1])
        open_nodes = below
    return tops, units, leaves


def _bins(units: list[tuple[int, int, int]], tasks: int, unit_rows: int) -> dict[tuple[int, int], int]:
    """A bin for each unit: whole trees, which share rows, evenly over the
    tasks; lower subtrees together while their rows stay within one unit's."""
    out, held, current, tops = {}, 0, 0, [u for u in units if u[1] == 1]
    for i, (t, node, _) in enumerate(tops):
        out[t, node] = i % max(1, min(tasks, len(tops)))
    current = max(out.values(), default=-1) + 1
    for t, node, n in sorted(u for u in units if u[1] != 1):
        if held and held + n > unit_rows:
            current, held = current + 1, 0
        out[t, node], held = current, held + n
    return out


def _deal(rows: DataFrame, trees: list[_Tree], tops: Tops, bins: dict[tuple[int, int], int], d: int, everything: bool) -> DataFrame:
    """Packed blocks of the rows that each bin needs: those of its units' samples, or with
    ``everything`` all rows (with ``_rid``), whatever the samples."""
    by_tree: dict[int, dict[int, int]] = {}
    for (t, node), b in bins.items():
        by_tree.setdefault(t, {})[node] = b
    tables = {t: (np.array(sorted(v), np.int64), np.array([v[k] for k in sorted(v)])) for t, v in by_tree.items()}
    count = max(bins.values(), default=-1) + 1

    salted = _by_salt(trees, tables)

    def block(b: int, at: int, h, fold, share, x, rid) -> pa.RecordBatch:
        """``x`` by rows."""
        return pa.RecordBatch.from_pydict({
            "bin": pa.array([b], pa.int32()), "block": pa.array([at], pa.int64()), "n": pa.array([len(h)], pa.int32()),
            "h": pa.array([h.tobytes()], pa.binary()), "fold": pa.array([fold.astype(np.int32).tobytes()], pa.binary()),
            "share": pa.array([share.tobytes()], pa.binary()), "x": pa.array([x.tobytes()], pa.binary()), "rid": pa.array([rid], pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        waiting: dict[int, int] = {}

        def sent(b: int) -> pa.RecordBatch:
            parts = held.pop(b)
            waiting.pop(b)
            return block(b, 0, *[np.concatenate(a) for a in zip(*parts)], b"")

        for batch in batches:
            h, fold, share, x = _arrays(batch, d)
            if not len(h):
                continue
            wanted: list[list] = [[] for _ in range(count)]
            everyone = np.arange(len(h)) if everything else None
            for t, some in (((t, everyone) for t in tables) if everything else _sampled(trees, salted, h, fold, share)):
                nodes, into = tables[t]
                if not len(some):
                    continue
                if len(nodes) == 1 and nodes[0] == 1:
                    wanted[into[0]].append(some)
                    continue
                node = tops.route(t, x[:, some])
                place = np.minimum(np.searchsorted(nodes, node), len(nodes) - 1)
                some, place = some[nodes[place] == node], place[nodes[place] == node]
                for b in np.unique(into[place]).tolist():
                    wanted[b].append(some[into[place] == b])
            rid = batch.column(batch.schema.get_field_index("_rid")).to_numpy() if everything else None
            # one block at a time: a batch has as many as there are bins
            for b, parts in enumerate(wanted):
                if not parts:
                    continue
                keep = np.zeros(len(h), bool)
                for p in parts:
                    keep[p] = True
                pick = np.flatnonzero(keep)
                if not len(pick):
                    continue
                if everything:
                    yield block(b, int(rid[0]), h[pick], fold[pick], share[pick], x[:, pick].T, rid[pick].tobytes())
                    continue
                # samples take few rows of a batch: those of many batches go together
                held.setdefault(b, []).append((h[pick], fold[pick], share[pick], x[:, pick].T))
                waiting[b] = waiting.get(b, 0) + len(pick)
                if waiting[b] >= BLOCK_ROWS:
                    yield sent(b)
        for b in list(held):
            yield sent(b)

    return rows.mapInArrow(run, "bin int, block long, n int, h binary, fold binary, share binary, x binary, rid binary")


def _together(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    """All packed blocks of a task."""
    held = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(held) if held else None


def _block(group, d: int):
    """Arrays of all packed blocks of a group."""
    col = lambda name, kind: np.concatenate([np.frombuffer(b, kind) for b in group.column(name).to_pylist()])
    return col("h", np.uint64), col("fold", np.int32), col("share", np.float64), np.ascontiguousarray(col("x", np.float64).reshape(-1, d).T)


def _by_bin(blocks: DataFrame, bins: dict[tuple[int, int], int]) -> DataFrame:
    """A task for each bin: hashed, some tasks would get several bins and others none, and small blocks one task."""
    return blocks.repartitionById(max(bins.values(), default=0) + 1, F.col("bin"))


def _grown(trees: list[_Tree], tops: Tops, bins: dict[tuple[int, int], int], d: int):
    mine: dict[int, list[tuple[int, int]]] = {}
    for unit, b in bins.items():
        mine.setdefault(b, []).append(unit)

    kinds = dict(tree=pa.int32(), node=pa.int64(), depth=pa.int32(), n=pa.int32(), size=pa.int64(), feature=pa.binary(), value=pa.binary(), splits=pa.list_(pa.int64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = _together(batches)
        if group is None:
            return
        h, fold, share, x = _block(group, d)
        for t, node in mine[group.column("bin")[0].as_py()]:
            tree = trees[t]
            w = tree.copies(h, fold, share)
            some = np.flatnonzero(w)
            if node != 1:
                some = some[tops.route(t, x[:, some]) == node]
            depth = node.bit_length() - 1
            feature, value, splits = grow(x[:, some], w[some], tree.salt, node, depth, tree.depth, tree.features)
            row = (t, node, depth, len(feature), int(w[some].sum()), feature.astype("<i2").tobytes(), value.astype("<f8").tobytes(), splits.tolist())
            yield pa.RecordBatch.from_pydict({k: pa.array([v], kind) for (k, kind), v in zip(kinds.items(), row)})

    return run


#: What the rows of a block are for: to grow trees, to be scored, or both.
BOTH, TO_GROW, TO_SCORE = 0, 1, 2
_BLOCKS = "role int, block long, n int, h binary, fold binary, share binary, x binary, rid binary"


def _packed(d: int, role: int):
    """Whole batches as packed blocks, cut so that the work of summing them is shared."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, fold, share, x = _arrays(batch, d)
            rid = batch.column(batch.schema.get_field_index("_rid")).to_numpy()
            for lo in range(0, len(h), BLOCK_ROWS):
                at = slice(lo, lo + BLOCK_ROWS)
                yield pa.RecordBatch.from_pydict({
                    "role": pa.array([role], pa.int32()), "block": pa.array([int(rid[lo])], pa.int64()), "n": pa.array([len(rid[at])], pa.int32()),
                    "h": pa.array([h[at].tobytes()], pa.binary()), "fold": pa.array([fold[at].astype(np.int32).tobytes()], pa.binary()),
                    "share": pa.array([share[at].tobytes()], pa.binary()), "x": pa.array([x[:, at].T.tobytes()], pa.binary()), "rid": pa.array([rid[at].tobytes()], pa.binary())})

    return run


def _sums_of(total: np.ndarray) -> bytes:
    """Path sums, which are multiples of 2^-32, in six bytes each while they fit."""
    if not total.size or total.max() < 2.0 ** 15:
        return np.ascontiguousarray((np.ascontiguousarray(total) * _STEP).astype("<i8").reshape(-1, 1).view(np.uint8)[:, :6]).tobytes()
    return total.astype("<f8").tobytes()


def _sums_from(raw: bytes, n: int, width: int) -> np.ndarray:
    if len(raw) == n * width * 8:
        return np.frombuffer(raw, "<f8").reshape(n, width)
    out = np.zeros((n * width, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return (out.view("<i8").ravel() / _STEP).reshape(n, width)


def _shares(cost: list[int], tasks: int) -> list[int]:
    """Runs of trees of about the same cost: where each begins, and the end."""
    done = np.cumsum(cost)
    return [0, *np.searchsorted(done, done[-1] * np.arange(1, tasks) / tasks, "left").tolist(), len(cost)]


def _grown_walks(trees: list[_Tree], runs: list[list[int]], parts: dict[int, int], d: int):
    """Grows the whole trees of a task, each from its sample of all rows, and sends the path sums of the rows to be
    scored, by the parts of the forests that its trees are. Rows of a sample are not walked: they end in the leaf they grew."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(batch, r) for batch in batches for r in range(batch.num_rows)]
        if not held:
            return
        get = lambda batch, name, r: batch.column(batch.schema.get_field_index(name))[r]
        mine = runs[get(*held[0][:1], "task", 0).as_py()]
        if not mine:
            return
        # rows that only grow, rows for both, rows that are only scored
        roles = [get(b, "role", r).as_py() for b, r in held]
        held = [x for role in (TO_GROW, BOTH, TO_SCORE) for x, y in zip(held, roles) if y == role]
        raw = lambda name, kind: np.concatenate([np.frombuffer(get(b, name, r).as_buffer(), kind) for b, r in held])
        counts = [get(b, "n", r).as_py() for b, r in held]
        roles = sorted(roles, key=(TO_GROW, BOTH, TO_SCORE).index)
        to = sum(n for n, y in zip(counts, roles) if y != TO_SCORE)
        since = sum(n for n, y in zip(counts, roles) if y == TO_GROW)
        h, fold, share = raw("h", np.uint64), raw("fold", np.int32), raw("share", np.float64)
        x = np.ascontiguousarray(raw("x", np.float64).reshape(-1, d).T)
        scored = [(get(b, "block", r).as_py(), n, get(b, "rid", r).as_py()) for (b, r), n, y in zip(held, counts, roles) if y != TO_GROW]
        del held
        mine_parts = sorted({parts[t] for t in mine})
        total = np.zeros((len(mine_parts), x.shape[1] - since))
        for t in mine:
            tree, row = trees[t], total[mine_parts.index(parts[t])]
            w = tree.copies(h[:to], fold[:to], share[:to])
            some = np.flatnonzero(w)
            ends = np.zeros(len(some))
            feature, value, _ = grow(x[:, some], w[some], tree.salt, 1, 0, tree.depth, tree.features, ends)
            left, _, value = unfold(feature, value, 0)
            rest = np.ones(x.shape[1] - since, bool)
            met = some >= since
            rest[some[met] - since] = False
            row[some[met] - since] += ends[met]
            rest = np.flatnonzero(rest)
            row[rest] += paths(x[:, rest + since], feature, value, left)
        at, cols = 0, np.array(mine_parts, np.int32).tobytes()
        for block, n, rid in scored:
            yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int64()), "rid": pa.array([rid], pa.binary()), "cols": pa.array([cols], pa.binary()),
                                              "total": pa.array([_sums_of(total[:, at:at + n].T)], pa.binary())})
            at += n

    return run


_SUMS = "block long, rid binary, cols binary, total binary"


@dataclass
class Forests:
    """Several forests grown together: ``units`` has a packed subtree a row.
    Forest f owns the trees ``owner[f]``; trees may belong to several."""

    spark: object
    params: list[IsolationForestParams]
    features: list[str]
    trees: list[_Tree]
    tops: Tops
    bins: dict[tuple[int, int], int]
    units: DataFrame | None
    psi: list[int]
    n_train: list[int]
    owner: list[list[int]]
    _flat: dict | None = None
    #: Packed training rows, their number and the rows themselves, of forests that grow again for each scoring.
    source: tuple[DataFrame, int, DataFrame] | None = None

    def kept(self) -> DataFrame:
        """The units; those of a forest that keeps none are grown and written now."""
        if self.units is None and self.source is not None:
            d = len(self.features)
            names = ["h", "fold", "share", "x"]
            rows = self.source[0].select(*names).mapInArrow(_unpacked(d), "_h long, _fold int, _share double, _x array<double>")
            self.bins = _bins([(t, 1, 0) for t in range(len(self.trees))], self.spark.sparkContext.defaultParallelism, UNIT_ROWS)
            self.units = written(_by_bin(_deal(rows, self.trees, self.tops, self.bins, d, False), self.bins).mapInArrow(_grown(self.trees, self.tops, self.bins, d), UNIT_SCHEMA))
        return self.units

    def train_scores(self, df: DataFrame) -> DataFrame:
        """Scores of the training rows ``df``, alone; forests that grow again do so beside them."""
        if self.units is not None or self.source is None:
            return self.scores(df, [])
        blocks, n, base = self.source
        return self._whole_scores(blocks.withColumn("role", F.lit(BOTH)), n, base, {})

    def model_bytes(self) -> int:
        """Size of the node arrays, from the units' own node counts."""
        return 14 * (self.kept().agg(F.sum("n")).first()[0] or 0)

    def _whole_scores(self, blocks: DataFrame, n: int, base: DataFrame, names: dict[str, str]) -> DataFrame:
        """The rows of ``base`` with their scores by trees that grow in tasks which hold all of ``blocks`` (``n`` rows)."""
        from .forest import every_block

        # trees that the same forests have are summed together
        of = _Scorer(self.psi, self.owner).of
        forests = list(dict.fromkeys(tuple(of[t]) for t in sorted(of)))
        parts, mine = {t: forests.index(tuple(of[t])) for t in of}, sorted(of)
        tasks = max(1, min(len(mine), self.spark.sparkContext.defaultParallelism))
        psi = {t: self.psi[f] for f, o in enumerate(self.owner) for t in o}
        cuts = _shares([psi[t] + n // 2 for t in mine], tasks)
        runs = [mine[a:b] for a, b in zip(cuts, cuts[1:])]
        sums = every_block(blocks, tasks).mapInArrow(_grown_walks(self.trees, runs, parts, len(self.features)), _SUMS)
        return self._summed(sums, base, names, forests)

    def flat(self) -> dict:
        """All trees as flat arrays (their tops included), for models within ``BROADCAST_BYTES``."""
        if self._flat is None:
            by_tree: dict[int, list] = {}
            for r in self.kept().collect():
                by_tree.setdefault(r["tree"], []).append(r)
            feature, value, left, roots, at = [], [], [], [], 0
            for t in range(len(self.trees)):
                spot = {}
                for r in by_tree.get(t, []):
                    f, v = np.frombuffer(r["feature"], "<i2"), np.frombuffer(r["value"], "<f8")
                    kids, _, v = unfold(f, v, r["depth"])
                    spot[r["node"]] = at
                    feature.append(f); value.append(v); left.append(np.where(kids >= 0, kids + at, -1))
                    at += len(f)
                # tops from below: a split needs its children side by side, so they are copied there
                for node in sorted(self.tops.splits[t], reverse=True):
                    f, v = self.tops.splits[t][node]
                    pair = [spot[2 * node], spot[2 * node + 1]]
                    flat_f, flat_v, flat_l = (np.concatenate(a) for a in (feature, value, left))
                    feature, value, left = ([np.concatenate([flat_f, flat_f[pair], [f]]).astype(np.int16)],
                                            [np.concatenate([flat_v, flat_v[pair], [v]])], [np.concatenate([flat_l, flat_l[pair], [at]])])
                    spot[node] = at + 2
                    at += 3
                roots.append(spot.get(1, -1))
            cat = lambda a, kind: np.concatenate(a).astype(kind) if a else np.zeros(0, kind)
            self._flat = dict(feature=cat(feature, np.int16), value=cat(value, np.float64), left=cat(left, np.int32), roots=np.array(roots, np.int64))
        return self._flat

    def _broadcast_scores(self, own: tuple[str, str] | None = None) -> Column:
        """Scores of all forests, an array column; ``own``: see ``scores``."""
        bc = self.spark.sparkContext.broadcast(self.flat())
        score, width = _Scorer(self.psi, self.owner), len(self.owner)

        scopes = [(p.fold, p.share) for p in self.params]

        def scores(x: np.ndarray, fold=None, share=None) -> np.ndarray:
            a = bc.value
            total, parts = np.zeros((width, x.shape[1])), {}
            for t, of in score.of.items():
                if a["roots"][t] < 0:
                    continue
                if own and tuple(of) not in parts:
                    some = np.flatnonzero(np.any([(fold == scopes[f][0]) | (share < scopes[f][1]) for f in of], axis=0))
                    parts[tuple(of)] = some, np.ascontiguousarray(x[:, some])
                some, mine = parts[tuple(of)] if own else (slice(None), x)
                p = paths(mine, a["feature"], a["value"], a["left"], int(a["roots"][t]), ready=_walkable(a))
                for f in of:
                    total[f, some] += p
            return score(total.T)

        @F.pandas_udf(DoubleType())
        def _one(*cols: pd.Series) -> pd.Series:
            return pd.Series(scores(np.stack([s.fillna(0.0).to_numpy(dtype=float) for s in cols]))[:, 0])

        @F.arrow_udf(ArrayType(DoubleType()))
        def _all(*cols: pa.Array) -> pa.Array:
            x = [np.asarray(c.to_numpy(zero_copy_only=False), float) for c in cols]
            found = scores(np.nan_to_num(np.stack(x[:len(x) - 2 * bool(own)]), nan=0.0, posinf=np.inf, neginf=-np.inf), *(x[-2:] if own else ()))
            return pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1) * width, pa.int32()), pa.array(np.ascontiguousarray(found).ravel()))

        of_row = [F.col(f"`{f}`").cast("double") for f in self.features]
        return F.array(_one(*of_row)) if width == 1 and not own else _all(*of_row, *[F.col(f"`{c}`").cast("double") for c in own or ()])

    def scores(self, df: DataFrame, keep: Sequence[str] | None = None, own: tuple[str, str] | None = None) -> DataFrame:
        """``df`` (its columns ``keep``) with ``_scores``, an array with one score a forest. ``own``, the columns of fold and
        share, says that a forest's scores are read for its fold and its share of the rows only: others may be left out (any number)."""
        ship_package(self.spark)
        keep = list(df.columns if keep is None else keep)
        if self.units is None and self.source is not None:
            names = {k: f"_k{i}" for i, k in enumerate(keep)}
            base = _numbers(df, self.features, self.params[0].key, None, None, [F.col(f"`{k}`").alias(n) for k, n in names.items()])
            base = written(base.withColumn("_rid", F.monotonically_increasing_id()))
            n = base.count() + self.source[1]
            if n <= WHOLE_ROWS:
                rows = base.select("_h", "_fold", "_share", "_x", "_rid").mapInArrow(_packed(len(self.features), TO_SCORE), _BLOCKS)
                return self._whole_scores(self.source[0].unionByName(written(rows)), n, base, names)
        if self.model_bytes() <= BROADCAST_BYTES:
            return df.select(*[F.col(f"`{k}`") for k in keep], self._broadcast_scores(own).alias("_scores"))
        return self._dealt_scores(df, keep)

    def _dealt_scores(self, df: DataFrame, keep: list[str], score_rows: int = SCORE_ROWS) -> DataFrame:
        d, names = len(self.features), {k: f"_k{i}" for i, k in enumerate(keep)}
        base = _numbers(df, self.features, self.params[0].key, None, None, [F.col(f"`{k}`").alias(n) for k, n in names.items()])
        base = written(base.withColumn("_rid", F.monotonically_increasing_id()))
        salts = max(1, -(-base.count() // score_rows))
        blocks = _deal(base.select("_h", "_fold", "_share", "_x", "_rid"), self.trees, self.tops, self.bins, d, True)
        blocks = blocks.withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int"))
        spread = self.kept().withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        tops, score = self.tops, _Scorer(self.psi, self.owner)
        width = len(self.owner)

        def walk(left: pa.Table, right: pa.Table) -> pa.Table:
            kept = {k: [] for k in ("block", "rid", "cols", "total")}
            cols = np.arange(width, dtype=np.int32).tobytes()
            if left.num_rows:
                _, _, _, x = _block(left, d)
                total = np.zeros((x.shape[1], width))
                for r in right.select(["tree", "node", "depth", "feature", "value"]).to_batches(max_chunksize=1):
                    r = r.to_pylist()[0]
                    f, v = np.frombuffer(r["feature"], "<i2"), np.frombuffer(r["value"], "<f8")
                    kids, _, v = unfold(f, v, r["depth"])
                    some = np.arange(x.shape[1]) if r["node"] == 1 else np.flatnonzero(tops.route(r["tree"], x) == r["node"])
                    p = paths(x[:, some], f, v, kids)
                    for o in score.of[r["tree"]]:
                        total[some, o] += p
                at = 0
                for block, n, rid in zip(left.column("block").to_pylist(), left.column("n").to_pylist(), left.column("rid").to_pylist()):
                    kept["block"].append(block); kept["rid"].append(rid); kept["cols"].append(cols); kept["total"].append(_sums_of(total[at:at + n]))
                    at += n
            return pa.table({"block": pa.array(kept["block"], pa.int64()), **{k: pa.array(kept[k], pa.binary()) for k in ("rid", "cols", "total")}})

        sums = blocks.groupBy("bin", "salt").cogroup(spread.withColumn("bin", self._bin_of()).groupBy("bin", "salt")).applyInArrow(
            walk, _SUMS)

        return self._summed(sums, base, names, [(f,) for f in range(width)])

    def _summed(self, sums: DataFrame, base: DataFrame, names: dict[str, str], forests: list[tuple[int, ...]]) -> DataFrame:
        """The rows of ``base`` with their scores from the bins' path sums; ``forests``: those that each column counts for."""
        score, width = _Scorer(self.psi, self.owner), len(self.owner)

        def add(group: pa.Table) -> pa.Table:
            rids = [np.frombuffer(b, np.int64) for b in group.column("rid").to_pylist()]
            rows = np.unique(np.concatenate(rids))
            total = np.zeros((len(rows), width))
            for rid, cols, raw in zip(rids, group.column("cols").to_pylist(), group.column("total").to_pylist()):
                cols, place = np.frombuffer(cols, np.int32), np.searchsorted(rows, rid)
                part = _sums_from(raw, len(rid), len(cols))
                for i, col in enumerate(cols.tolist()):
                    for f in forests[col]:
                        total[place, f] += part[:, i]
            ends = pa.array(np.arange(len(rows) + 1) * width, pa.int32())
            return pa.table({"_rid": pa.array(rows), "_scores": pa.ListArray.from_arrays(ends, pa.array(score(total).ravel()))})

        scored = sums.groupBy("block").applyInArrow(add, "_rid long, _scores array<double>")
        return base.join(scored, "_rid", "left").select(*[F.col(n).alias(k) for k, n in names.items()], "_scores")

    def _bin_of(self) -> Column:
        table = json.dumps([{"t": t, "v": n, "b": b} for (t, n), b in self.bins.items()])
        found = F.from_json(F.lit(table), "array<struct<t:int,v:long,b:int>>")
        return F.filter(found, lambda e: (e["t"] == F.col("tree")) & (e["v"] == F.col("node")))[0]["b"]

    def f1_table(self, df: DataFrame, label: str, by: str, limits: Sequence[float]) -> DataFrame:
        """Confusion counts and metrics of every forest in each group ``by`` of a frame
        with ``_scores``, in one aggregate: (forest, by, tn, fp, ..., f1)."""
        from ..operators.evaluate import metrics_from_counts

        y, n = F.col(f"`{label}`") == 1, len(limits)
        hit = lambda f: F.col("_scores")[f] > F.lit(limits[f])
        row = df.groupBy(F.col(f"`{by}`").alias(by)).agg(F.count_if(y).alias("p"), F.count_if(~y).alias("n"), *[x for f in range(n) for x in (
            F.count_if(y & hit(f)).alias(f"tp{f}"), F.count_if(~y & hit(f)).alias(f"fp{f}"))])
        each = F.array(*[F.struct(F.lit(f).alias("forest"), (F.col("n") - F.col(f"fp{f}")).alias("tn"), F.col(f"fp{f}").alias("fp"),
                                  (F.col("p") - F.col(f"tp{f}")).alias("fn"), F.col(f"tp{f}").alias("tp")) for f in range(n)])
        return metrics_from_counts(row.select(by, F.inline(each)))

    def model(self, f: int = 0) -> "IsolationForestModel":
        return IsolationForestModel(self, f)

    def viewed(self, views: Sequence[tuple[int, IsolationForestParams]]) -> "Forests":
        """Forests of the first trees of these: of forest ``f`` as many as the parameters have, for each (f, parameters)."""
        return replace(self, params=[p for _, p in views], psi=[self.psi[f] for f, _ in views], n_train=[self.n_train[f] for f, _ in views],
                       owner=[self.owner[f][:p.n_estimators] for f, p in views], _flat=None)

    def prefixes(self, f: int, sizes: Sequence[int]) -> "Forests":
        """The forests of the first k trees of forest ``f``, for each k."""
        p = self.params[f]
        return replace(self, params=[replace(p, n_estimators=k) for k in sizes], psi=[self.psi[f]] * len(sizes), n_train=[self.n_train[f]] * len(sizes),
                       owner=[self.owner[f][:k] for k in sizes], _flat=None)


class _Scorer:
    """Path sums to scores, in tasks; ``of`` lists the forests of each tree."""

    def __init__(self, psi: list[int], owner: list[list[int]]):
        self.psi, self.sizes = psi, [len(o) for o in owner]
        self.of: dict[int, list[int]] = {}
        for f, o in enumerate(owner):
            for t in o:
                self.of.setdefault(t, []).append(f)

    def __call__(self, total: np.ndarray) -> np.ndarray:
        out = np.full(total.shape, 0.5)
        for f, (psi, n) in enumerate(zip(self.psi, self.sizes)):
            if c_factor(psi) > 0 and n:
                out[:, f] = np.power(2.0, -total[:, f] / n / c_factor(psi))
        return out


def grow_forests(df: DataFrame, params: Sequence[IsolationForestParams], n: int | None = None, fold: str | None = None,
                 share: Column | None = None, unit_rows: int = UNIT_ROWS) -> Forests:
    """Grows all forests of ``params`` (which share their key) in one job. ``fold``
    names the column that ``params.fold`` refers to, ``share`` is the uniform draw beside ``params.share``."""
    spark, params = df.sparkSession, list(params)
    ship_package(spark)
    ensure_checkpoint_dir(spark)
    features = _features(params)
    d = len(features)
    rows = _numbers(df, features, list(params[0].key), fold, share)
    trees, want, owner, psis, n_train = _planned(rows, params, features, n)
    if not any(n_train):
        empty = spark.createDataFrame([], UNIT_SCHEMA)
        return Forests(spark, params, features, trees, Tops(len(trees)), {}, empty, psis, n_train, owner)
    tops, units, leaves = _tops(rows, trees, want, d, unit_rows)
    # counts of samples drawn with replacement vary: a root within a few deviations of the limit is still one unit
    # a row is sent to every bin that needs it, and large samples need nearly all rows: no more bins than tasks run at once
    bins = _bins(units, spark.sparkContext.defaultParallelism, unit_rows)
    grown = _by_bin(_deal(rows, trees, tops, bins, d, False), bins).mapInArrow(_grown(trees, tops, bins, d), UNIT_SCHEMA)
    for t, node, depth, size in leaves:
        bins[t, node] = bins.get((t, node), 0)
    if leaves:
        flat = [(t, node, depth, 1, size, np.array([-1], "<i2").tobytes(), np.array([size], "<f8").tobytes(), [0] * d) for t, node, depth, size in leaves]
        grown = grown.unionByName(spark.createDataFrame([(*r[:5], bytearray(r[5]), bytearray(r[6]), r[7]) for r in flat], UNIT_SCHEMA))
    return Forests(spark, params, features, trees, tops, bins, written(grown), psis, n_train, owner)


def _features(params: Sequence[IsolationForestParams]) -> list[str]:
    return list(dict.fromkeys(f for p in params for f in p.features))


def feature_count(params: IsolationForestParams) -> int:
    """Features of one tree."""
    return max(1, int(params.max_features * len(params.features)))


def _planned(rows: DataFrame, params: list[IsolationForestParams], features: list[str], n: int | None = None):
    """The trees of all forests with their samples drawn, the sample size of each tree, each forest's
    trees and sample size, and its number of training rows."""
    scopes = list(dict.fromkeys((p.fold, p.share) for p in params))
    if n is not None and scopes == [(None, 1.0)]:
        members = {scopes[0]: n}
    else:
        inside = lambda f, s: (F.lit(True) if f is None else ~F.coalesce(F.col("_fold") == f, F.lit(False))) & (F.lit(True) if s >= 1 else F.col("_share") < s)
        row = rows.agg(*[F.count_if(inside(f, s)).alias(f"n{i}") for i, (f, s) in enumerate(scopes)]).first()
        members = {s: row[f"n{i}"] for i, s in enumerate(scopes)}
    trees, want, count, owner, psis = [], [], [], [], []
    for p in params:
        n_rows = members[p.fold, p.share]
        psi = sample_size(p, n_rows)
        mine = np.array([features.index(f) for f in p.features])
        k = feature_count(p)
        owner.append(list(range(len(trees), len(trees) + p.n_estimators)))
        psis.append(psi)
        for t in range(p.n_estimators):
            salt = int(_mix(_mix(np.uint64(p.seed)) ^ np.uint64(t)))
            order = np.argsort(_draw(np.uint64(salt), mine, 63), kind="stable")
            trees.append(_Tree(salt, None if p.bootstrap else -1 if psi < n_rows else 2 ** 64 - 1, psi / max(n_rows, 1),
                               int(math.ceil(math.log2(max(psi, 2)))), sorted(mine[order[:k]].tolist()), p.fold, p.share))
            want.append(psi)
            count.append(n_rows)
    _cuts(rows, trees, want, count, len(features))
    return trees, want, owner, psis, [members[p.fold, p.share] for p in params]


def grow_and_score(df: DataFrame, params: Sequence[IsolationForestParams], views: Sequence[tuple[int, IsolationForestParams]], keep: Sequence[str],
                   fold: str | None = None, unit_rows: int = WHOLE_ROWS) -> tuple[Forests, DataFrame]:
    """Grows the forests of ``params`` and gives the ``views`` on them (see ``Forests.viewed``), and ``df`` (its columns ``keep``)
    with ``_scores``, one a view. While a task may hold all rows, each tree is walked where it grows and its nodes are neither
    kept nor sent (the forests then have no ``units``); of more rows, the trees are written and scored as ever."""
    spark, params = df.sparkSession, list(params)
    ship_package(spark)
    ensure_checkpoint_dir(spark)
    features, names = _features(params), {k: f"_k{i}" for i, k in enumerate(keep)}
    d = len(features)
    base = _numbers(df, features, list(params[0].key), fold, None, [F.col(f"`{k}`").alias(n) for k, n in names.items()])
    base = written(base.withColumn("_rid", F.monotonically_increasing_id()))
    held = base.count()
    if held <= unit_rows:
        rows = base.select("_h", "_fold", "_share", "_x", "_rid")
        trees, want, owner, psis, n_train = _planned(rows, params, features)
        if any(n_train):
            forests = Forests(spark, params, features, trees, Tops(len(trees)), {}, None, psis, n_train, owner).viewed(views)
            return forests, forests._whole_scores(written(rows.mapInArrow(_packed(d, BOTH), _BLOCKS)), held, base, names)
    forests = grow_forests(df, params, fold=fold, unit_rows=min(unit_rows, UNIT_ROWS)).viewed(views)
    return forests, forests.scores(df, keep)


def _unpacked(d: int):
    """The rows of packed blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                x = np.frombuffer(r["x"], np.float64)
                ends = pa.array(np.arange(len(x) // d + 1) * d, pa.int32())
                yield pa.RecordBatch.from_pydict({"_h": pa.array(np.frombuffer(r["h"], np.int64)), "_fold": pa.array(np.frombuffer(r["fold"], np.int32)),
                                                  "_share": pa.array(np.frombuffer(r["share"], np.float64)), "_x": pa.ListArray.from_arrays(ends, pa.array(x))})

    return run


def _regrown(df: DataFrame, params: IsolationForestParams, n: int | None) -> Forests | None:
    """A forest that keeps its training rows, not its nodes, which would be many times the rows; None if there
    are few, or more rows than a task may hold."""
    spark = df.sparkSession
    features, d = _features([params]), len(params.features)
    if n is None:
        n = df.count()
    if n > WHOLE_ROWS or sample_size(params, n) * params.n_estimators <= KEPT_ROWS:
        return None
    ship_package(spark)
    ensure_checkpoint_dir(spark)
    rows = written(_numbers(df, features, list(params.key), None, None).withColumn("_rid", F.monotonically_increasing_id()))
    blocks = written(rows.mapInArrow(_packed(d, TO_GROW), _BLOCKS))
    trees, _, owner, psis, n_train = _planned(rows, [params], features, n)
    return Forests(spark, [params], features, trees, Tops(len(trees)), {}, None, psis, n_train, owner, source=(blocks, n, rows.select("_rid")))


class IsolationForestModel:
    """One forest of a ``Forests``, with its threshold."""

    def __init__(self, forests: Forests, at: int = 0, threshold: float = 0.5):
        self.forests, self.at, self.threshold = forests, at, threshold
        self.params, self.psi, self.n_train = forests.params[at], forests.psi[at], forests.n_train[at]

    @property
    def nodes(self) -> DataFrame:
        """One row a node: its number (root 1, children 2i and 2i+1), split or leaf."""
        own = self.forests.owner[self.at]
        first = own[0] if own else 0
        features = self.forests.features
        mine = [self.params.features.index(f) if f in list(self.params.features) else -1 for f in features]

        def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for r in batch.to_pylist():
                    f, v = np.frombuffer(r["feature"], "<i2"), np.frombuffer(r["value"], "<f8")
                    kids, depth, w = unfold(f, v, r["depth"])
                    leaf = f < 0
                    node, size = np.empty(len(f), np.int64), np.where(leaf, v, 0).astype(np.int64)
                    node[0] = r["node"]
                    inner = np.flatnonzero(~leaf)
                    for level in np.unique(depth[inner]):
                        at = inner[depth[inner] == level]
                        node[kids[at]], node[kids[at] + 1] = 2 * node[at], 2 * node[at] + 1
                    for level in np.unique(depth[inner])[::-1]:
                        at = inner[depth[inner] == level]
                        size[at] = size[kids[at]] + size[kids[at] + 1]
                    yield pa.RecordBatch.from_pydict({
                        "tree": pa.array(np.full(len(f), r["tree"] - first), pa.int32()), "node": pa.array(node),
                        "feature": pa.array(np.where(leaf, -1, np.array([*mine, -1])[f]), pa.int32()), "threshold": pa.array(np.where(leaf, 0.0, v)),
                        "left": pa.array(np.where(leaf, -1, 2 * node)), "right": pa.array(np.where(leaf, -1, 2 * node + 1)), "size": pa.array(size),
                        "depth": pa.array(depth, pa.int32()), "leaf": pa.array(leaf), "path": pa.array(np.where(leaf, w, 0.0))})

        # units hold any number of nodes: one batch a unit
        below = self.forests.kept().filter(F.col("tree").between(first, first + len(own) - 1)).mapInArrow(unpack, NODE_SCHEMA)
        tops = [(t - first, node, mine[f], v, 2 * node, 2 * node + 1, None, node.bit_length() - 1, False, 0.0)
                for t in own for node, (f, v) in self.forests.tops.splits[t].items()]
        return below.unionByName(self.forests.spark.createDataFrame(tops, NODE_SCHEMA)) if tops else below

    def scorer(self, features: Sequence[str]):
        """A ``Walker``, called with (features, rows) arrays in tasks that score many variants of
        their rows; the model travels by broadcast and must be within ``BROADCAST_BYTES``."""
        forests = self.forests
        if forests.model_bytes() > BROADCAST_BYTES:
            raise ValueError("explanations walk the forest inside tasks: grow it from fewer rows a tree")
        ship_package(forests.spark)
        bc, order = forests.spark.sparkContext.broadcast(forests.flat()), [list(features).index(f) for f in forests.features]
        return Walker(bc, order, list(forests.owner[self.at]), c_factor(self.psi))

    def arrays(self) -> DataFrame:
        """The finished model (already written when ``fit`` returns, or written now)."""
        return self.forests.kept()

    def transform(self, df: DataFrame, score: str = "score", pred: str = "pred") -> DataFrame:
        """EV1 — add the score and the predicted label (score above the threshold)."""
        base = [x for x in df.columns if x not in (score, pred, "_scores")]
        out = self.forests.scores(df, base).withColumn(score, F.col("_scores")[self.at]).drop("_scores")
        return out.withColumn(pred, (F.col(score) > F.lit(self.threshold)).cast("int"))

    # -- persistence (SNK5) --------------------------------------------------
    def save(self, path: str) -> None:
        own = self.forests.owner[self.at]
        units = self.forests.kept().filter(F.col("tree").isin(own)).withColumn("tree", F.col("tree") - own[0])
        units.write.mode("overwrite").parquet(os.path.join(path, "units"))
        mine = {t: i for i, t in enumerate(own)}
        meta = dict(params=asdict(self.params) | {"features": list(self.params.features), "key": list(self.params.key)}, columns=self.forests.features,
                    psi=self.psi, n_train=self.n_train, threshold=self.threshold, trees=[asdict(self.forests.trees[t]) for t in own],
                    tops=[[[k, *v] for k, v in self.forests.tops.splits[t].items()] for t in own],
                    bins=[[mine[t], n, b] for (t, n), b in self.forests.bins.items() if t in mine])
        spark = self.forests.spark
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").json(os.path.join(path, "meta"))

    @staticmethod
    def load(spark, path: str) -> "IsolationForestModel":
        meta = json.loads(spark.read.json(os.path.join(path, "meta")).first()["meta"])
        trees = [_Tree(**t) for t in meta["trees"]]
        tops = Tops(len(trees))
        for t, held in enumerate(meta["tops"]):
            tops.splits[t] = {k: (f, v) for k, f, v in held}
        forests = Forests(spark, [IsolationForestParams(**meta["params"])], meta["columns"], trees, tops, {(t, n): b for t, n, b in meta["bins"]},
                          spark.read.parquet(os.path.join(path, "units")), [meta["psi"]], [meta["n_train"]], [list(range(len(trees)))])
        return IsolationForestModel(forests, 0, meta["threshold"])


def thresholds(scored: DataFrame, forests: Forests, contamination: Sequence[str | float]) -> list[float]:
    """Each forest's threshold: the (1 - contamination) quantile of the training
    scores in ``scored`` (0.5 for "auto")."""
    from ..operators.core import order_statistics

    out = [0.5] * len(contamination)
    # of each forest's scores only its own quantile
    share = {f"s{i}": 1.0 - float(c) for i, c in enumerate(contamination) if c != "auto"}
    if not share:
        return out

    def ends(p: float):
        return lambda n: [math.floor((n - 1) * p), min(math.floor((n - 1) * p) + 1, n - 1)]

    places = {int(k[1:]): p for k, p in share.items()}
    found = _at_ranks(scored, {i: ends(p) for i, p in places.items()})
    if found is None:  # many equal or nearly equal scores
        cols = scored.select(*[F.col("_scores")[int(k[1:])].alias(k) for k in share])
        named = order_statistics(cols, {k: (F.col(k), ends(p), [p]) for k, p in share.items()})
        found = {int(k[1:]): v for k, v in named.items()}
    for i, p in places.items():
        n, at = found[i]
        lo, h = math.floor((n - 1) * p), (n - 1) * p
        out[i] = float(at[lo] + (h - lo) * (at[min(lo + 1, n - 1)] - at[lo]) if n else None)
    return out


#: Bins of the scores from 0 to 1, and the most scores of a bin that a task sorts.
SCORE_BINS, SORTED_ROWS = 1 << 16, 1 << 22


def _score_columns(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """(rows, width): the array column ``_scores`` of a batch (null: NaN)."""
    return batch.column(batch.schema.get_field_index("_scores")).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _at_ranks(scored: DataFrame, positions: dict[int, object]) -> dict[int, tuple[int, dict[int, float]]] | None:
    """For each forest the number of its scores (null: none) and those at the positions given for that number, from two passes:
    one counts the scores by bins, one sends those of the bins that hold a position. None if a bin holds too many."""
    spark = scored.sparkSession
    rows = scored.select("_scores").coalesce(max(1, spark.sparkContext.defaultParallelism))
    if not (first := rows.select(F.size("_scores").alias("n")).first()):
        return {i: (0, {}) for i in positions}
    width, mine = first["n"], sorted(positions)
    place = lambda v: np.minimum((v * SCORE_BINS).astype(np.int64), SCORE_BINS - 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((len(mine), SCORE_BINS), np.int64)
        for batch in batches:
            x = _score_columns(batch, width)
            for at, i in enumerate(mine):
                v = x[:, i]
                b = place(v[~np.isnan(v)])
                held[at] += np.bincount(b, minlength=SCORE_BINS)
        for at, i in enumerate(mine):
            some = np.flatnonzero(held[at])
            yield pa.RecordBatch.from_pydict({"i": pa.array([i], pa.int32()), "bin": pa.array([some.astype("<i4").tobytes()], pa.binary()), "n": pa.array([held[at][some].tobytes()], pa.binary())})

    def total(group: pa.Table) -> pa.Table:
        i, held = group.column("i")[0].as_py(), np.zeros(SCORE_BINS, np.int64)
        for b, n in zip(group.column("bin").to_pylist(), group.column("n").to_pylist()):
            held[np.frombuffer(b, "<i4")] += np.frombuffer(n, np.int64)
        done = np.cumsum(held)
        n = int(done[-1])
        at = sorted(set(positions[i](n))) if n else []
        b = np.searchsorted(done, at, "right")
        return pa.table({"i": pa.array([i] * len(at) or [i], pa.int32()), "n": pa.array([n] * max(1, len(at)), pa.int64()), "rank": pa.array(at or [None], pa.int64()),
                         "bin": pa.array(b.tolist() or [None], pa.int32()), "below": pa.array((done[b] - held[b]).tolist() or [None], pa.int64()), "inside": pa.array(held[b].tolist() or [None], pa.int64())})

    found = rows.mapInArrow(count, "i int, bin binary, n binary").groupBy("i").applyInArrow(total, "i int, n long, rank long, bin int, below long, inside long").collect()
    if any((r["inside"] or 0) > SORTED_ROWS for r in found):
        return None
    bins = {i: sorted({r["bin"] for r in found if r["i"] == i and r["bin"] is not None}) for i in mine}

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list] = {}
        for batch in batches:
            x = _score_columns(batch, width)
            for i in mine:
                v = x[:, i]
                v = v[~np.isnan(v)]
                b = place(v)
                for k in bins[i]:
                    held.setdefault((i, k), []).append(v[b == k])
        for (i, k), parts in held.items():
            v, n = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.RecordBatch.from_pydict({"i": pa.array([i], pa.int32()), "bin": pa.array([k], pa.int32()), "v": pa.array([v.tobytes()], pa.binary()), "n": pa.array([n.astype(np.int64).tobytes()], pa.binary())})

    ranks = [(r["i"], r["bin"], r["rank"] - r["below"], r["rank"]) for r in found if r["rank"] is not None]

    def pick(group: pa.Table) -> pa.Table:
        i, k = group.column("i")[0].as_py(), group.column("bin")[0].as_py()
        v, n = (np.concatenate([np.frombuffer(b, kind) for b in group.column(name).to_pylist()]) for name, kind in (("v", np.float64), ("n", np.int64)))
        order = np.argsort(v, kind="stable")
        v, done = v[order], np.cumsum(n[order])
        some = [(at, rank) for j, b, at, rank in ranks if (j, b) == (i, k)]
        return pa.table({"i": pa.array([i] * len(some), pa.int32()), "rank": pa.array([r for _, r in some], pa.int64()),
                         "v": pa.array([float(v[np.searchsorted(done, at, "right")]) for at, _ in some], pa.float64())})

    out = {r["i"]: (r["n"], {}) for r in found}
    for r in rows.mapInArrow(near, "i int, bin int, v binary, n binary").groupBy("i", "bin").applyInArrow(pick, "i int, rank long, v double").collect():
        out[r["i"]][1][r["rank"]] = r["v"]
    return out


def fit(df: DataFrame, params: IsolationForestParams, n: int | None = None) -> IsolationForestModel:
    """ML8 — one forest; its threshold from ``contamination`` (see ``thresholds``)."""
    forests = _regrown(df, params, n) or grow_forests(df, [params], n)
    model = forests.model()
    if params.contamination != "auto":
        # score the training rows once: the quantile takes several passes
        scored = written(forests.train_scores(df))
        model.threshold = thresholds(scored, forests, [params.contamination])[0]
    return model


# ---------------------------------------------------------------------------
# model-table analyses (XP1, XP8)
# ---------------------------------------------------------------------------

def split_importance(model: IsolationForestModel) -> DataFrame:
    """XP1 — number of splits per feature across all trees (and share)."""
    forests = model.forests
    own, spark = forests.owner[model.at], forests.spark
    names = spark.createDataFrame(list(enumerate(forests.features)), "feature int, name string")
    below = forests.kept().filter(F.col("tree").isin(own)).select(F.posexplode("splits").alias("feature", "splits"))
    tops = [(f, 1) for t in own for f, _ in forests.tops.splits[t].values()]
    if tops:
        below = below.unionByName(spark.createDataFrame(tops, "feature int, splits long"))
    cnt = below.groupBy("feature").agg(F.sum("splits").alias("splits")).filter("splits > 0")
    tot = cnt.agg(F.sum("splits").alias("_t"))
    return cnt.join(F.broadcast(names), "feature").crossJoin(F.broadcast(tot)) \
        .select(F.col("name").alias("feature"), "splits", (F.col("splits") / F.col("_t")).alias("share"))


def tree_convergence(model: IsolationForestModel, train: DataFrame, df: DataFrame, label: str, sizes: Sequence[int],
                     contamination: float = 0.05) -> DataFrame:
    """XP8 — precision, recall and F1 on ``df`` of the first k trees, for each k; every
    k has its own threshold from the training scores. Rows are scored once for all k."""
    grown = model.forests.prefixes(model.at, sizes)
    limits = thresholds(written(grown.scores(train, [])), grown, [contamination] * len(sizes))
    scored = grown.scores(df.withColumn("_all", F.lit("all")), [label, "_all"])
    names = F.element_at(F.array(*[F.lit(int(k)) for k in sizes]), F.col("forest") + 1)
    return grown.f1_table(scored, label, "_all", limits).select(names.alias("trees"), "tn", "fp", "fn", "tp", "precision", "recall", "f1")
