"""Shared DataFrame building blocks.

* one-pass multi-column aggregates unpivoted on the one-row result,
* a dense global row index over a total order (range sort + per-partition
  offsets, materialised with a reliable checkpoint),
* neighbour access (lag/lead) through fixed-size row blocks with a halo, so no
  window ever runs over an unpartitioned frame,
* running sums over a global order built on the same blocks,
* a size-checked broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DateType, DecimalType, IntegralType, NumericType, TimestampNTZType,
                               TimestampType)

from ..session import ensure_checkpoint_dir

ROW_INDEX = "_rn"
_BLOCK = "_blk"


def c(name: str) -> Column:
    """Column reference that tolerates dots, spaces and non-ASCII in names."""
    return F.col("`" + name.replace("`", "``") + "`")


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, NumericType) and not isinstance(f.dataType, BooleanType) and f.name not in skip
    ]


def nan_to_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One notion of missing: NaN becomes NULL on floating columns."""
    cols = cols if cols is not None else numeric_columns(df)
    floating = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    return df.withColumns({x: F.nanvl(c(x), F.lit(None).cast(df.schema[x].dataType)) for x in cols if x in floating})


def unpivot_metrics(row: DataFrame, columns: Sequence[str], metrics: Sequence[str], key: str = "column",
                    types: dict[str, str] | None = None) -> DataFrame:
    """Turn a one-row aggregate with fields ``{col}__{metric}`` into one row per column.

    The unpivot runs on the single aggregated row, never on the data.
    """
    types = types or {}
    structs = []
    for col in columns:
        fields = [F.lit(col).alias(key)]
        for m in metrics:
            v = c(f"{col}__{m}")
            if m in types:
                v = v.cast(types[m])
            fields.append(v.alias(m))
        structs.append(F.struct(*fields))
    return row.select(F.inline(F.array(*structs)))


def checked_broadcast(small: DataFrame, max_rows: int, known_rows: int | None = None) -> DataFrame:
    """Broadcast ``small`` only when its row count is proven to be below ``max_rows``.

    ``known_rows`` is a bound that holds by construction (e.g. one row per
    partition or per class); otherwise the rows are counted.
    """
    n = known_rows if known_rows is not None else small.count()
    return F.broadcast(small) if n <= max_rows else small


def with_row_index(df: DataFrame, order: Sequence[Column | str], name: str = ROW_INDEX) -> tuple[DataFrame, int]:
    """Dense 0-based index over a total order, plus the row count.

    The frame is range-sorted (balanced by sampling, no single partition), each
    row gets (partition id, position), the sorted frame is checkpointed so a
    lost executor recomputes the same layout, then per-partition counts (one row
    per partition) give the offsets.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    sorted_ = (
        df.orderBy(*order)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    counts = sorted_.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"), "_cnt")
    rows = offsets.collect()  # one row per partition
    total = int(sum(r["_cnt"] for r in rows))
    off_map = F.create_map(*[x for r in rows for x in (F.lit(int(r["_pid"])), F.lit(int(r["_off"])))]) if rows else None
    if off_map is None:
        return sorted_.withColumn(name, F.lit(None).cast("long")).drop("_pid", "_mid"), 0
    idx = off_map[c("_pid")] + (c("_mid") - F.shiftleft(c("_pid").cast("long"), 33))
    return sorted_.withColumn(name, idx.cast("long")).drop("_pid", "_mid"), total


def boundary_keys(df: DataFrame, order: Sequence[str], fractions: Sequence[float],
                  positions: Callable[[int], list[int]]) -> DataFrame | None:
    """One row with the order keys (``_key0``, ``_key1``, …) at ``positions(n)`` of the
    order, without sorting the frame; a key is null where its position is n or more.

    ``percentile_approx`` of the leading order column brackets each position
    (``fractions`` of the rows), one aggregate counts the rows before and inside
    the brackets, and only the keys inside are indexed. A leading column of
    another type, or a bracket that misses, takes the keys of all rows.
    None if rows with one key lie on both sides of a boundary."""
    ensure_checkpoint_dir(df.sparkSession)
    keys = df.select(*[c(x) for x in order])
    lead, width = c(order[0]), 3.0 / APPROX_ACCURACY
    numeric = isinstance(df.schema[order[0]].dataType, (IntegralType, DecimalType, DateType, TimestampType, TimestampNTZType))
    wanted = [min(1.0, max(0.0, f + s * width)) for f in fractions for s in (-1, 1)]
    probe = [F.percentile_approx(lead, wanted, APPROX_ACCURACY).alias("_q")] if numeric else []
    stats = keys.agg(F.count(F.lit(1)).alias("_n"), F.count_if(lead.isNull()).alias("_nulls"), *probe).checkpoint()
    n, nulls = stats.select("_n", "_nulls").first()
    targets = positions(n)
    inside, shift = keys, [0] * len(targets)
    if numeric and n > nulls:
        beside = keys.crossJoin(F.broadcast(stats.select("_q")))  # one row
        ends = [(F.col("_q")[2 * i], F.col("_q")[2 * i + 1]) for i in range(len(targets))]
        held = reduce(lambda a, b: a | b, [lead.between(a, z) for a, z in ends])
        aggs = [x for i, (a, z) in enumerate(ends) for x in (
            F.count_if(lead < a).alias(f"b{i}"), F.count_if(lead.between(a, z)).alias(f"i{i}"), F.count_if(held & (lead < a)).alias(f"u{i}"))]
        row = beside.agg(*aggs).first()
        first = [row[f"b{i}"] + nulls for i in range(len(targets))]
        if all(p >= n or (first[i] <= max(p - 1, 0) and p < first[i] + row[f"i{i}"]) for i, p in enumerate(targets)):
            inside = beside.filter(held).select(*[c(x) for x in order])
            shift = [first[i] - row[f"u{i}"] for i in range(len(targets))]
    indexed, _ = with_row_index(inside, [c(x) for x in order])
    key = F.struct(*[c(x).alias(f"k{j}") for j, x in enumerate(order)])

    def at(p: int, i: int) -> Column:
        return F.max(F.when(c(ROW_INDEX) == F.lit(p - shift[i]), key) if 0 <= p < n else F.lit(None).cast(found_type))

    found_type = indexed.select(key.alias("k")).schema["k"].dataType
    found = indexed.agg(*[x for i, p in enumerate(targets) for x in (at(p, i).alias(f"_key{i}"), at(p - 1, i).alias(f"_prev{i}"))]).checkpoint()
    tied = found.select(*[F.coalesce(c(f"_key{i}") == c(f"_prev{i}"), F.lit(False)) for i in range(len(targets))]).first()
    return None if any(tied) else found.select(*[f"_key{i}" for i in range(len(targets))])


def before_boundary(order: Sequence[str], i: int) -> Column:
    """Whether a row lies before the ``i``-th key of ``boundary_keys`` (all do before a null one)."""
    return F.coalesce(F.struct(*[c(x).alias(f"k{j}") for j, x in enumerate(order)]) < c(f"_key{i}"), F.lit(True))


def block_size(n: int, halo: int, parallelism: int) -> int:
    """Rows per window block: enough blocks to use the cluster, each bounded."""
    target = math.ceil(max(n, 1) / max(2 * parallelism, 1))
    return int(min(max(target, 4 * halo + 1, 4096), 1 << 21))


def with_neighbors(indexed: DataFrame, n: int, cols: Sequence[str], lags: int = 0, leads: int = 0,
                   rn: str = ROW_INDEX, suffix_lag: str = "__lag", suffix_lead: str = "__lead",
                   keep: Sequence[str] = ()) -> DataFrame:
    """Add ``{col}__lag{k}`` / ``{col}__lead{k}`` over the global order ``rn``.

    Rows are cut into fixed-size blocks of consecutive ``rn``; the first/last
    ``k`` rows of every block are copied into the neighbouring block as a halo,
    so ``lag``/``lead`` inside a block equal the global ones. Block size is a
    row count, so a hot timestamp can never make one block large.
    """
    k = max(lags, leads, 1)
    spark = indexed.sparkSession
    b = block_size(n, k, spark.sparkContext.defaultParallelism)
    blk = F.floor(c(rn) / F.lit(b)).cast("long")
    pos = c(rn) - blk * F.lit(b)
    keep = [x for x in keep if x not in cols and x != rn]
    base = indexed.select(rn, *[c(x) for x in cols], *[c(x) for x in keep]).withColumn(_BLOCK, blk).withColumn("_halo", F.lit(False))
    # the last `lags` rows of a block are the lag halo of the next block,
    # the first `leads` rows the lead halo of the previous one
    tail = (base.filter(pos >= F.lit(b - lags)).withColumn(_BLOCK, blk + 1).withColumn("_halo", F.lit(True))
            if lags else None)
    head = (base.filter(pos < F.lit(leads)).withColumn(_BLOCK, blk - 1).withColumn("_halo", F.lit(True))
            if leads else None)
    u = base
    for extra in (tail, head):
        if extra is not None:
            u = u.unionByName(extra)
    w = Window.partitionBy(_BLOCK).orderBy(rn)
    exprs = []
    for col in cols:
        for j in range(1, lags + 1):
            exprs.append(F.lag(c(col), j).over(w).alias(f"{col}{suffix_lag}{j}"))
        for j in range(1, leads + 1):
            exprs.append(F.lead(c(col), j).over(w).alias(f"{col}{suffix_lead}{j}"))
    out = u.select(rn, "_halo", *[c(x) for x in cols], *[c(x) for x in keep], *exprs).filter(~c("_halo")).drop("_halo")
    return out


def running_sums(indexed: DataFrame, n: int, cols: Sequence[str], rn: str = ROW_INDEX,
                 suffix: str = "__cum", op: str = "sum", reverse: bool = False) -> DataFrame:
    """Inclusive running ``sum`` / ``max`` / ``min`` of ``cols`` over the global
    order ``rn`` (or its reverse).

    In-block cumulative values (window per block) combined with the running
    value of all earlier blocks, computed on the per-block totals table (one
    row per block).
    """
    spark = indexed.sparkSession
    agg = {"sum": F.sum, "max": F.max, "min": F.min}[op]
    b = block_size(n, 1, spark.sparkContext.defaultParallelism)
    with_blk = indexed.withColumn(_BLOCK, F.floor(c(rn) / F.lit(b)).cast("long"))
    totals = with_blk.groupBy(_BLOCK).agg(*[agg(c(x)).alias(f"{x}__tot") for x in cols])
    order_blk = F.desc(_BLOCK) if reverse else F.asc(_BLOCK)
    prior = Window.orderBy(order_blk).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(_BLOCK, *[agg(c(f"{x}__tot")).over(prior).alias(f"{x}__off") for x in cols])
    n_blocks = (n + b - 1) // b
    offsets = checked_broadcast(offsets, 1_000_000, known_rows=n_blocks)
    order_rn = F.desc(rn) if reverse else F.asc(rn)
    w = Window.partitionBy(_BLOCK).orderBy(order_rn).rowsBetween(Window.unboundedPreceding, 0)
    local = with_blk.select("*", *[agg(c(x)).over(w).alias(f"{x}__loc") for x in cols])
    joined = local.join(offsets, _BLOCK, "left")

    def combine(x):
        loc, off = c(f"{x}__loc"), c(f"{x}__off")
        if op == "sum":
            return loc + F.coalesce(off, F.lit(0))
        pick = F.greatest if op == "max" else F.least
        return F.when(off.isNull(), loc).otherwise(pick(loc, off))

    return joined.select(*[c(x) for x in indexed.columns], *[combine(x).alias(f"{x}{suffix}") for x in cols])


def distinct_value_ranks(counts: DataFrame, value: str, count_col: str = "cnt") -> DataFrame:
    """Average (mid) ranks for a table of distinct values with their multiplicities.

    ``counts`` has one row per distinct ``value``; rank of a value =
    rows strictly below + (cnt + 1) / 2 — ties averaged. Only the distinct-value
    table is ordered, never the raw rows.
    """
    indexed, n = with_row_index(counts, [c(value)])
    cum = running_sums(indexed, n, [count_col])
    return cum.select(
        c(value), c(count_col),
        (c(f"{count_col}__cum") - c(count_col) + (c(count_col) + F.lit(1.0)) / F.lit(2.0)).alias("midrank"),
    )


def round_cols(df: DataFrame, digits: int = 6, cols: Sequence[str] | None = None) -> DataFrame:
    """Round floating columns (results are compared after rounding)."""
    floating = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    targets = [x for x in (cols if cols is not None else floating) if x in floating]
    # "+ 0.0" turns a rounded -0.0 into 0.0 so signed zeros compare equal
    return df.withColumns({x: F.round(c(x), digits) + F.lit(0.0) for x in targets})


# ---------------------------------------------------------------------------
# exact quantiles without a single-task value map
# ---------------------------------------------------------------------------

def quantile_table(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles (linear interpolation at h = (n−1)p, as ``percentile``)
    as rows (by…, column, prob, value), computed without any task holding all
    values of a column:

    1. (group, column, value) multiplicities — map-side combined, so a hot
       value or group is one row;
    2. one range sort of that table with a dense index and running counts;
    3. per (group, column) start and size (one row each);
    4. only the rows holding order statistics ⌊h⌋ and ⌊h⌋+1 survive, then
       interpolate."""
    by = list(by)
    pairs = F.array(*[F.struct(F.lit(x).alias("column"), c(x).cast("double").alias("v")) for x in cols])
    long = df.select(*[c(b) for b in by], F.explode(pairs).alias("_p")).select(*[c(b) for b in by], "_p.column", "_p.v") \
        .filter(F.col("v").isNotNull() & ~F.isnan("v"))
    counts = long.groupBy(*[c(b) for b in by], "column", "v").agg(F.count(F.lit(1)).alias("cnt"))
    idx, n = with_row_index(counts, [c(b) for b in by] + [F.col("column"), F.col("v")])
    cum = running_sums(idx, n, ["cnt"])
    keys = by + ["column"]
    grp = cum.groupBy(*[c(k) for k in keys]).agg(F.min(F.col("cnt__cum") - F.col("cnt")).alias("_start"),
                                                 F.sum("cnt").alias("_n"))
    j = cum.join(checked_broadcast(grp, 1_000_000), keys)
    end = F.col("cnt__cum") - F.col("_start")
    begin = end - F.col("cnt")
    t = j.select(*[c(k) for k in keys], "v", begin.alias("_b"), end.alias("_e"), "_n",
                 F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob"))
    h = (F.col("_n") - 1) * F.col("prob")
    lo = F.floor(h)
    hi = F.least(lo + 1, F.col("_n") - 1)
    t = t.withColumn("_h", h).withColumn("_lo", lo).withColumn("_hi", hi)
    covers_lo = (F.col("_b") <= F.col("_lo")) & (F.col("_lo") < F.col("_e"))
    covers_hi = (F.col("_b") <= F.col("_hi")) & (F.col("_hi") < F.col("_e"))
    picked = t.filter(covers_lo | covers_hi).groupBy(*[c(k) for k in keys], "prob").agg(
        F.max(F.when(covers_lo, F.col("v"))).alias("_vlo"), F.max(F.when(covers_hi, F.col("v"))).alias("_vhi"),
        F.first("_h").alias("_h"), F.first("_lo").alias("_lo"))
    value = F.col("_vlo") + (F.col("_h") - F.col("_lo")) * (F.col("_vhi") - F.col("_vlo"))
    return picked.select(*[c(k) for k in keys], "prob", value.alias("value"))


APPROX_ACCURACY = 10_000


def order_statistics(df: DataFrame, targets: dict[str, tuple[Column, Callable[[int], list[int]], list[float]]],
                     accuracy: int = APPROX_ACCURACY) -> dict[str, tuple[int, dict[int, float]]]:
    """Exact values at given positions of many columns, by brackets that shrink
    round by round: {name: (rows, {position: value})}.

    ``targets`` gives for each name its values (nulls and NaN are left out), the 0-based positions for a
    row count, and the shares of the rows near which they lie. Each round is one
    aggregate that counts the rows before every bracket's ends and one whose ``percentile_approx``
    narrows it to about 1/1,000 of the rows strictly inside; a bracket with fewer rows than half the
    accuracy is read exactly, one whose ends meet is settled. Only counts and bracket ends
    reach the driver, and every size of table takes the same way."""
    value = {k: F.nanvl(v.cast("double"), F.lit(None).cast("double")) for k, (v, _, _) in targets.items()}
    slack = 3.0 / accuracy
    near = {k: sorted({min(1.0, max(0.0, p + s * slack)) for p in ps for s in (-1, 1)}) for k, (_, _, ps) in targets.items()}
    names = list(targets)
    first = df.agg(*[x for i, k in enumerate(names) for x in (
        F.count(value[k]).alias(f"n{i}"), F.percentile_approx(value[k], near[k], accuracy).alias(f"q{i}"))]).first()
    out, state = {}, {}
    for i, k in enumerate(names):
        n = first[f"n{i}"]
        out[k] = (n, {})
        for pos in set(targets[k][1](n)) if n else ():
            # percentile_approx gives the ceil(p n)-th value
            below = [p for p in near[k] if p * n < pos + 1 - n / accuracy] or [None]
            above = [p for p in near[k] if p * n > pos + 1 + n / accuracy] or [None]
            ends = dict(zip(near[k], first[f"q{i}"])) | {None: None}
            state[k, pos] = (ends[below[-1]], ends[above[0]])
    while state:
        for (k, pos), (a, b) in list(state.items()):
            if a is not None and a == b:
                out[k][1][pos] = a
                del state[k, pos]
        if not state:
            break
        held = list(state.items())
        before = lambda k, x, equal: F.count_if(value[k] <= F.lit(x) if equal else value[k] < F.lit(x))
        counts = df.agg(*[x for i, ((k, _), (a, b)) in enumerate(held) for x in (
            *([before(k, a, e).alias(f"a{int(e)}_{i}") for e in (False, True)] if a is not None else []),
            *([before(k, b, e).alias(f"b{int(e)}_{i}") for e in (False, True)] if b is not None else []))] or [F.lit(0)]).first()
        probes, state = [], {}
        for i, ((k, pos), (a, b)) in enumerate(held):
            n = out[k][0]
            lt_a, le_a = (0, 0) if a is None else (counts[f"a0_{i}"], counts[f"a1_{i}"])
            lt_b, le_b = (n, n) if b is None else (counts[f"b0_{i}"], counts[f"b1_{i}"])
            if pos < lt_a or pos >= le_b:  # the sketch missed: open that end
                state[k, pos] = (None, a) if pos < lt_a else (b, None)
            elif pos < le_a or pos >= lt_b:
                out[k][1][pos] = a if pos < le_a else b
            else:
                share, exact = (pos - le_a + 0.5) / (lt_b - le_a), 2 * (lt_b - le_a) < accuracy
                probes.append((k, pos, i, [share] if exact else [max(0.0, share - slack), min(1.0, share + slack)], a, b))
        if probes:
            inside = lambda k, a, b: (F.lit(True) if a is None else value[k] > F.lit(a)) & (F.lit(True) if b is None else value[k] < F.lit(b))
            row = df.agg(*[F.percentile_approx(F.when(inside(k, a, b), value[k]), ps, accuracy).alias(f"q{i}") for k, _, i, ps, a, b in probes]).first()
            for k, pos, i, ps, a, b in probes:
                q = row[f"q{i}"]
                # values strictly inside the bracket: every round leaves its ends behind
                state[k, pos] = (q[0], q[-1])
    return out


def quantile_values(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict[tuple[str, float], float | None]:
    """Exact quantiles of whole columns (linear interpolation at h = (n-1)p, as
    ``percentile``) as {(column, p): value}; see ``order_statistics``."""
    cols, probs = list(cols), [float(p) for p in probs]
    if not cols:
        return {}

    def positions(n: int) -> list[int]:
        return [r for p in probs for r in {math.floor((n - 1) * p), min(math.floor((n - 1) * p) + 1, n - 1)}]

    found = order_statistics(df, {x: (c(x), positions, probs) for x in cols})
    out: dict[tuple[str, float], float | None] = {}
    for x in cols:
        n, at = found[x]
        for p in probs:
            h = (n - 1) * p
            lo = math.floor(h)
            out[(x, p)] = at[lo] + (h - lo) * (at[min(lo + 1, n - 1)] - at[lo]) if n else None
    return out
