"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Each shard stands at ``vnodes`` places of a ring of 2^60 positions; a key's
position is a hash of the key alone, and its home is the shard of the first
place at or after it. No shard takes more than its bound: rows beyond it go on
clockwise to the next places until a shard with room comes. With ``slack`` 0
the bounds are the even shares themselves (row counts differ by one at most);
with more slack fewer rows leave their homes and fewer move when shards are added.

Every row between two neighbouring places (an arc) meets the same shards in the
same order, so the walk needs only the number of rows of each arc: at most
``shards * vnodes + 1`` integers, whatever the data. It gives each arc a few
ranges of ranks with their shard, and a row finds its own by its rank in the arc.
Ranks come from one range sort of the narrow rows, so a hot key (one position
with a third of all rows) is spread over tasks like any other rows.

Rows of an arc are ranked by position, then the ``ties`` columns; equal rows are
interchangeable. A null key is a key of its own; repeated keys are separate
rows, and may part where a bound cuts between them; an empty table gives no rows. Columns of any name are kept, and given back as
they came (``shard``, ``slot`` and ``home_shard`` must not be among them). Only SQL functions touch the rows.
"""

from __future__ import annotations

import hashlib
import json
import math
from bisect import bisect_left

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare, written

VNODES = 64
#: Hex digits of the hash that make a position: 60 bits.
DIGITS = 15
RESULT = ("shard", "slot", "home_shard")


def position(key: Column) -> Column:
    """Place of a key on the ring: the leading 60 bits of the MD5 of its text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("\0null")))
    return F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("long")


def ring(shards: int, vnodes: int = VNODES) -> list[tuple[int, int]]:
    """(position, shard) of every virtual node, clockwise."""
    place = lambda s, v: int(hashlib.md5(f"shard {s} node {v}".encode()).hexdigest()[:DIGITS], 16)
    return sorted((place(s, v), s) for s in range(shards) for v in range(vnodes))


def bounds(rows: int, shards: int, slack: float = 0.0) -> list[int]:
    """Most rows of each shard: even shares at ``slack`` 0, else (1 + slack) times the mean."""
    if slack > 0:
        return [math.ceil((1 + slack) * rows / shards)] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def walk(counts: list[int], owners: list[int], most: list[int]) -> list[list[tuple[int, int, int, int]]]:
    """For each arc its (from rank, to rank, shard, slot of from): first what its
    own shard has room for, then the overflow in the order in which it is carried
    clockwise. ``counts`` and ``owners`` are by arc."""
    used, pieces, carried = [0] * len(most), [[] for _ in counts], []
    for i, (n, s) in enumerate(zip(counts, owners)):
        take = min(n, most[s] - used[s])
        if take:
            pieces[i].append((0, take, s, used[s]))
            used[s] += take
    head = 0  # of the queue of (arc, next rank, end)
    for step in range(2 * len(counts)):
        i, s = step % len(counts), owners[step % len(counts)]
        home = pieces[i][0][1] if pieces[i] and step < len(counts) else 0
        if step < len(counts) and home < counts[i]:
            carried.append([i, home, counts[i]])
        while head < len(carried) and used[s] < most[s]:
            arc, at, end = carried[head]
            take = min(end - at, most[s] - used[s])
            pieces[arc].append((at, at + take, s, used[s]))
            used[s] += take
            carried[head][1] += take
            head += carried[head][1] == end
    return pieces


def assign(rows: DataFrame, key: str, shards: int, vnodes: int = VNODES, slack: float = 0.0, ties: list[str] | None = None) -> DataFrame:
    """``rows`` with shard int, slot long (gapless from 0 within the shard) and
    home_shard int (where the key would be without bounds). ``ties`` are the
    sortable columns that order rows of one position; pass few columns, as all are sorted."""
    spark = rows.sparkSession
    prepare(spark)
    if taken := {c.lower() for c in rows.columns} & set(RESULT):
        raise ValueError(f"columns {sorted(taken)} are taken by the result")
    places = ring(shards, vnodes)
    at, owners = [p for p, _ in places], [s for _, s in places]
    owners.append(owners[0])  # positions after the last place
    # the ring in equal cells, each with the places inside it: a row compares its position with those of one cell
    bits = max(1, (2 * len(at)).bit_length())
    edge = [bisect_left(at, c << (4 * DIGITS - bits)) for c in range((1 << bits) + 1)]
    cells = [[edge[c], at[edge[c]:edge[c + 1]]] for c in range(1 << bits)]
    table = F.from_json(F.lit(json.dumps([{"n": n, "at": a} for n, a in cells])), "array<struct<n:int,at:array<long>>>")
    names = {c: f"_c{i}" for i, c in enumerate(rows.columns)}
    inner = rows.toDF(*names.values()).withColumn("_pos", position(F.col(names[key])))
    inner = inner.withColumn("_cell", F.element_at(table, F.shiftright("_pos", 4 * DIGITS - bits).cast("int") + 1))
    arc = F.col("_cell.n") + F.size(F.filter("_cell.at", lambda p: p < F.col("_pos")))
    inner = written(inner.withColumn("_arc", arc).drop("_cell").withColumn("_row", F.monotonically_increasing_id()))

    count = [0] * len(owners)
    for r in inner.groupBy("_arc").agg(F.count(F.lit(1)).alias("n")).collect():  # one row an arc
        count[r["_arc"]] = r["n"]
    pieces = walk(count, owners, bounds(sum(count), shards, slack))

    order = ["_arc", "_pos", *[names[c] for c in ties or []], "_row"]
    ranked = written(inner.orderBy(*order).drop("_row").withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    sizes = {r["p"]: r["n"] for r in ranked.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a task
    first, total = [], 0
    for p in range(max(sizes, default=-1) + 1):
        first.append(total)
        total += sizes.get(p, 0)
    start, total = [], 0
    for n in count:
        start.append(total)
        total += n
    firsts = F.from_json(F.lit(json.dumps(first)), "array<long>")
    arcs = F.from_json(F.lit(json.dumps([{"start": a, "home": s, "pieces": [dict(zip("abst", x)) for x in p]}
                                         for a, s, p in zip(start, owners, pieces)])),
                       "array<struct<start:long,home:int,pieces:array<struct<a:long,b:long,s:int,t:long>>>>")
    ranked = ranked.withColumn("_mine", F.element_at(arcs, F.col("_arc") + 1))
    rank = F.element_at(firsts, part.cast("int") + 1) + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) - F.col("_mine.start")
    ranked = ranked.withColumn("_rank", rank)
    ranked = ranked.withColumn("_piece", F.filter("_mine.pieces", lambda p: (p["a"] <= F.col("_rank")) & (F.col("_rank") < p["b"]))[0])
    return ranked.select(*[F.col(n).alias(c) for c, n in names.items()], F.col("_piece.s").alias("shard"),
                         (F.col("_piece.t") + F.col("_rank") - F.col("_piece.a")).alias("slot"), F.col("_mine.home").alias("home_shard"))
