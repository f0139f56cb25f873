"""Vector code compression: product codes learnt over tries of distinct parts.

A vector's components become integers, the vector is cut into ``parts`` equal
parts, and each part is coded by the nearest of ``entries`` codebook entries of its place.
The distinct parts of a block of rows, sorted, are the leaves of a lexicographic
trie: parts that begin with the same dimensions share a path. The trie is
walked depth first with the vector of accumulated distances to all entries; a
node adds one dimension to its parent's vector, so a shared prefix is computed
once. A leaf takes the least distance (ties: lower entry) and counts as often as its part occurs.

Blocks of sorted distinct parts with their counts are written once to the shared folder; each round reads them and
sends back ``parts * entries * (width + 1)`` integers. No row is shuffled, equal vectors are one leaf a block,
and all arithmetic is in integers, so the result doesn't depend on how rows are dealt.

Rows whose vector is null or has a null or non-finite component are dropped. Components are held within
+-2^25 after scaling (|x| <= 8,192 at scale 4,096), which keeps every distance of up to 1,024 dimensions below 2^62; beyond that they
are cut off there. Shorter vectors (empty ones too) are filled up with zeros to the greatest length, rounded up to a
multiple of ``parts``. Null ids come after all others; rows with one id are ordered by their vectors. With fewer
rows than ``entries`` the codebooks have that many entries; an empty table gives no rows and empty codebooks. Other columns are ignored unless kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from .common import prepare, written

LIMIT = 1 << 25
#: Component values held by one block of rows (16 MB).
BLOCK_VALUES = 1 << 22
#: Leaves of a subtrie that is walked down level by level.
LEAVES = 4096


def integers(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component."""
    whole = lambda x: F.floor(F.least(F.greatest(x.cast("double") * scale, F.lit(-float(LIMIT))), F.lit(float(LIMIT))))
    return F.transform(vector, lambda x: whole(x).cast("int"))


def usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as rows of ``width`` integers, short ones filled with zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    ends = lists.offsets.to_numpy()
    values, sizes = lists.values.to_numpy(zero_copy_only=False)[ends[0]:ends[-1]], np.diff(ends)
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int32)
    out[np.arange(width) < sizes[:, None]] = values
    return out


def distinct(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct rows in lexicographic order, their counts, and the place of each row among them."""
    if not rows.shape[1]:
        return rows[:1], np.full(min(1, len(rows)), len(rows)), np.zeros(len(rows), np.int64)
    order = np.lexsort(rows.T[::-1])
    held = rows[order]
    first = np.ones(len(held), bool)
    first[1:] = (held[1:] != held[:-1]).any(axis=1)
    group = np.cumsum(first) - 1
    place = np.empty(len(held), np.int64)
    place[order] = group
    return held[first], np.bincount(group), place


def walk(leaves: np.ndarray, book: np.ndarray, size: int = LEAVES) -> Iterator[tuple[int, int, np.ndarray]]:
    """Depth-first over the trie of sorted distinct ``leaves``: (from, to, distances
    to the entries of ``book`` of the leaves from..to), in the order of the leaves."""
    n, width = leaves.shape
    if not n or not width:
        yield 0, n, np.zeros((n, len(book)), np.int64)
        return
    # depth at which each leaf leaves the path of the one before it
    branch = np.zeros(n, np.int64)
    branch[1:] = (leaves[1:] != leaves[:-1]).argmax(axis=1)
    wide = leaves.astype(np.int64)
    # a segment: nodes of one depth with the leaves lo..hi below them, where each node starts, its accumulated distances
    stack = [(0, n, 0, np.zeros(1, np.int64), np.zeros((1, len(book)), np.int64))]
    while stack:
        lo, hi, depth, starts, held = stack.pop()
        if len(starts) > 1 and hi - lo > size:
            ends = np.append(starts[1:], hi)
            cut, groups = 0, []
            while cut < len(starts):
                to = max(cut + 1, int(np.searchsorted(ends, starts[cut] + size, "right")))
                groups.append((int(starts[cut]), int(ends[to - 1]), depth, starts[cut:to], held[cut:to]))
                cut = to
            stack.extend(reversed(groups))
            continue
        while depth < width:
            nodes = np.flatnonzero(branch[lo:hi] <= depth) + lo
            above = np.searchsorted(starts, nodes, "right") - 1
            step = wide[nodes, depth][:, None] - book[:, depth]
            held = held[above] + step * step
            starts, depth = nodes, depth + 1
            if hi - lo > size and len(starts) > 1:
                break
        if depth == width:
            yield lo, hi, held
        else:
            stack.append((lo, hi, depth, starts, held))


def nearest(leaves: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of each leaf."""
    code, far = np.empty(len(leaves), np.int64), np.empty(len(leaves), np.int64)
    for lo, hi, held in walk(leaves, book):
        code[lo:hi] = held.argmin(axis=1)
        far[lo:hi] = held.min(axis=1)
    return code, far


def _blocks(parts: int, width: int):
    """Vectors to blocks of sorted distinct parts with counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, values = [], 0

        def flush():
            rows = np.concatenate(held)
            rows = rows.reshape(len(rows), parts, width)
            found = [distinct(rows[:, p])[:2] for p in range(parts)]
            return pa.RecordBatch.from_pydict({
                "part": pa.array(range(parts), pa.int32()), "n": pa.array([len(x) for x, _ in found], pa.int64()),
                "leaves": pa.array([np.ascontiguousarray(x, "<i4").tobytes() for x, _ in found], pa.binary()),
                "counts": pa.array([c.astype("<i8").tobytes() for _, c in found], pa.binary())})

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(matrix(batch.column(0), parts * width))
            values += max(held[-1].size, batch.num_rows)
            if values >= BLOCK_VALUES:
                yield flush()
                held, values = [], 0
        if held:
            yield flush()

    return run


def _sums(books: np.ndarray):
    """Blocks to (part, entry, dim, total): dim -1 is the number of parts that take the entry."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, width + 1), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                p, leaves = row["part"], np.frombuffer(row["leaves"], "<i4").reshape(row["n"], width)
                counts = np.frombuffer(row["counts"], "<i8")
                code, _ = nearest(leaves, books[p])
                # doubles are exact here: at most 2^22 values of at most 2^25
                total[p, :, 0] += np.bincount(code, counts, entries).astype(np.int64)
                for d in range(width):
                    total[p, :, d + 1] += np.bincount(code, counts * leaves[:, d].astype(np.float64), entries).astype(np.int64)
        p, e, d = (x.ravel() for x in np.indices(total.shape))
        yield pa.RecordBatch.from_pydict({"part": pa.array(p, pa.int32()), "entry": pa.array(e, pa.int32()),
                                          "dim": pa.array(d - 1, pa.int32()), "total": pa.array(total.ravel(), pa.int64())})

    return run


def _code(books: np.ndarray, vector: str):
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = matrix(batch.column(batch.schema.get_field_index(vector)), parts * width).reshape(batch.num_rows, parts, width)
            codes, error = np.zeros((len(rows), parts), np.int32), np.zeros(len(rows), np.int64)
            for p in range(parts) if len(rows) else ():
                leaves, _, place = distinct(rows[:, p])
                code, far = nearest(leaves, books[p])
                codes[:, p], error = code[place], error + far[place]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * parts, pa.int32()), pa.array(codes.ravel(), pa.int32()))
            keep = [i for i, f in enumerate(batch.schema) if f.name != vector]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in keep], lists, pa.array(error, pa.int64())],
                                             [*[batch.schema.names[i] for i in keep], "_code", "_error"])

    return run


def learn(vectors: DataFrame, first: list[list[int]], parts: int, width: int, rounds: int) -> np.ndarray:
    """Codebooks (parts, entries, width) after ``rounds`` of assigning all parts
    and replacing each used entry by the floored mean of its parts. ``vectors``
    has one integer array column; ``first`` are the vectors that the codebooks start from."""
    start = np.zeros((len(first), parts * width), np.int64)
    for i, v in enumerate(first):
        start[i, :len(v)] = v
    books = start.reshape(len(first), parts, width).transpose(1, 0, 2).copy()
    blocks = written(vectors.mapInArrow(_blocks(parts, width), "part int, n long, leaves binary, counts binary"))
    for _ in range(rounds):
        sums = blocks.mapInArrow(_sums(books), "part int, entry int, dim int, total long")
        total = np.zeros((parts, len(first), width + 1), np.int64)
        for r in sums.groupBy("part", "entry", "dim").agg(F.sum("total").alias("total")).collect():
            total[r["part"], r["entry"], r["dim"] + 1] = r["total"]
        used = total[:, :, 0] > 0
        books[used] = total[used][:, 1:] // total[used][:, :1]
    return books


def compress(rows: DataFrame, id_col: str, vector_col: str, parts: int = 8, entries: int = 16, rounds: int = 6,
             scale: int = 4096, keep: list[str] | None = None) -> tuple[DataFrame, np.ndarray]:
    """Rows (id, columns ``keep``, code array<int>, error long) and the codebooks, (parts, entries, width)."""
    spark = rows.sparkSession
    prepare(spark)
    held = list(dict.fromkeys([id_col, *(keep or [])]))
    names = {c: f"_c{i}" for i, c in enumerate(held)}
    usable_rows = rows.filter(usable(rows[vector_col]))
    kept = usable_rows.select(*[usable_rows[c].alias(n) for c, n in names.items()], integers(usable_rows[vector_col], scale).alias("_v"))
    longest = kept.agg(F.max(F.size("_v"))).first()[0] or 0
    width = -(-longest // parts)
    first = kept.select(names[id_col], "_v").orderBy(F.col(names[id_col]).asc_nulls_last(), "_v").limit(entries).collect()
    books = learn(kept.select("_v"), [r["_v"] for r in first], parts, width, rounds)
    schema = StructType([*[f for f in kept.schema if f.name != "_v"], StructField("_code", ArrayType(IntegerType())), StructField("_error", LongType())])
    coded = kept.mapInArrow(_code(books, "_v"), schema)
    return coded.select(*[F.col(n).alias(c) for c, n in names.items()], F.col("_code").alias("code"), F.col("_error").alias("error")), books
