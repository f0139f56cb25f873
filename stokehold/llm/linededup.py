"""Line deduplication by winnowing over line hashes.

A document is the sequence of its lines that hold a word. A gram is the
shortest stretch of lines from a line on with at least ``gram_words`` words;
a window is the shortest such stretch with at least ``run_words``. Of the
grams inside each window the one with the smallest hash is selected, so any
two documents that share a run of lines of ``run_words`` words or more share a
selected gram, and nothing under ``gram_words`` words is ever matched.

The first place of a gram (smallest document id, text hash, line) is its
leader. Every later place is compared with the leader: the lines before and
after, which each place carries as far as one window reaches, extend the match
both ways, and the matched run is deleted from the later document. Where a
place goes on differently from the leader, the gram with 1, 2, ... of its lines on
that side is a key of its own, and the longest key that an earlier place has
too extends the run. No pairs of places are formed. A place's lines can go only because
a still earlier place has them, so one copy of everything stays. After the pass
no line stands in a window of ``run_words`` words that an earlier place had.

Blank lines go with the line before them. Null texts stay null; a text all
of whose lines repeat becomes empty; null ids come after all others; rows
with equal id and text are one place and are treated alike; other columns
pass unchanged whatever their names; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import blobs, salted_join, slices, text_hash

GRAM_WORDS, RUN_WORDS = 25, 50


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def stretches(words: np.ndarray, least: int) -> np.ndarray:
    """For each line the end (exclusive) of the shortest stretch from it on with
    ``least`` words; lines without one are left out (they are the last ones)."""
    total = np.append(0, np.cumsum(words))
    ends = np.searchsorted(total, total[:-1] + least, "left")
    return ends[ends <= len(words)]


def winnow(hashes: list[bytes], words: np.ndarray, gram_words: int, run_words: int) -> list[tuple[int, int, int]]:
    """Selected grams as (line, end, hash)."""
    windows = stretches(words, run_words)
    if not len(windows):
        return []
    ends = stretches(words, gram_words)
    digest = xxhash.xxh64_intdigest
    grams = [digest(b"".join(hashes[i:e])) for i, e in enumerate(ends.tolist())]
    chosen, last = [], -1
    for start, stop in enumerate(windows.tolist()):
        # grams that begin in the window and end in it: ends never fall
        limit = int(np.searchsorted(ends, stop, "right"))
        if last >= start and limit and last < limit:
            best = last  # still inside: only later grams can undercut it
            for i in range(max(start, seen), limit):
                if grams[i] < grams[best]:
                    best = i
        else:
            best = min(range(start, limit), key=lambda i: (grams[i], i))
        seen = limit
        if best != last:
            chosen.append((best, int(ends[best]), grams[best]))
            last = best
    return chosen


def fingerprints(docs: DataFrame, gram_words: int = GRAM_WORDS, run_words: int = RUN_WORDS, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per selected gram: id, row_hash, line, stop, gram, and the hashes of
    the lines before (nearest first) and after it, as far as a window reaches."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, row_hash bigint, line int, stop int, gram bigint, before array<bigint>, after array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "_text"):
                row, line, stop, gram, before, after = [], [], [], [], [], []
                for k, text in enumerate(blobs(batch, "_text")):
                    if not text:
                        continue
                    parted = [x for x in (y.split() for y in text.split(b"\n")) if x]
                    words = np.fromiter(map(len, parted), np.int64, len(parted))
                    raw = [xxhash.xxh64_digest(b" ".join(x)) for x in parted]
                    keys = np.frombuffer(b"".join(raw), "<i8")
                    total = np.append(0, np.cumsum(words))
                    for i, e, g in winnow(raw, words, gram_words, run_words):
                        a = int(np.searchsorted(total, total[i] - run_words, "right")) - 1
                        z = int(np.searchsorted(total, total[e] + run_words, "left"))
                        row.append(k)
                        line.append(i)
                        stop.append(e)
                        gram.append(signed(g))
                        before.append(keys[max(a, 0):i][::-1])
                        after.append(keys[e:z])
                at = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array(line, pa.int32()), pa.array(stop, pa.int32()),
                     pa.array(gram, pa.int64()), pa.array(before, pa.list_(pa.int64())), pa.array(after, pa.list_(pa.int64()))],
                    names=[id_col, "row_hash", "line", "stop", "gram", "before", "after"])

    return docs.select(F.col(id_col), text_hash(text_col).alias("row_hash"), F.col(text_col).alias("_text")).mapInArrow(run, schema)


def agreeing(a: Column, b: Column) -> Column:
    """How many elements of two arrays agree from the start on."""
    n = F.least(F.size(a), F.size(b))
    first = F.array_position(F.zip_with(F.slice(a, 1, n), F.slice(b, 1, n), lambda x, y: x == y), False)
    return F.when(first == 0, n).otherwise(first.cast("int") - 1)


def beyond(lines: str, held: str, side: int) -> Column:
    """(side, k, key) for each number k of ``lines`` beyond the ``held`` ones: gram and k lines, hashed."""
    keys = F.transform(F.sequence(F.col(held) + 1, F.size(lines)), lambda k: F.struct(
        F.lit(side).alias("side"), k.alias("k"), F.xxhash64(F.col("gram"), F.lit(side), F.slice(F.col(lines), F.lit(1), k)).alias("key")))
    return F.when(F.size(lines) > F.col(held), keys).otherwise(F.array().cast("array<struct<side: int, k: int, key: bigint>>"))


def repeated_runs(docs: DataFrame, gram_words: int = GRAM_WORDS, run_words: int = RUN_WORDS, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Per document with repeats: id, row_hash and ``runs``, the stretches of lines
    [start, stop) that an earlier place has (lines with a word, from 0; may overlap)."""
    prints = fingerprints(docs, gram_words, run_words, id_col, text_col).checkpoint()
    place = F.struct(F.col(id_col).isNull().alias("x"), F.col(id_col).alias("id"), F.col("row_hash").alias("h"), F.col("line").alias("line"))
    leaders = prints.groupBy("gram").agg(F.min(place).alias("lead"), F.count(F.lit(1)).alias("n")).filter("n > 1").checkpoint()
    total = leaders.agg(F.sum("n").alias("t"))
    hot = leaders.join(F.broadcast(total)).filter("n * 1000 > t").select("gram")  # 1,000 grams at most
    spread = [id_col, "row_hash", "line"]
    met = salted_join(prints, leaders.select("gram", "lead"), ["gram"], hot, spread, "inner").withColumn("own", place == F.col("lead")).checkpoint()
    first = met.filter("own").dropDuplicates(["gram"]).select("gram", F.col("before").alias("lead_before"), F.col("after").alias("lead_after"))
    later = salted_join(met.filter("not own"), first, ["gram"], hot, spread, "inner")
    later = later.withColumns({"back": agreeing(F.col("before"), F.col("lead_before")), "on": agreeing(F.col("after"), F.col("lead_after"))})
    later = later.select(id_col, "row_hash", "line", "stop", "back", "on",
                         F.concat(beyond("before", "back", -1), beyond("after", "on", 1)).alias("keys")).checkpoint()
    # lines the leader doesn't have: the first place of the gram with these lines beside it
    each = later.select(id_col, "row_hash", "line", "stop", F.inline("keys"))
    firsts = each.groupBy("key").agg(F.min(place).alias("lead"), F.count(F.lit(1)).alias("n")).filter("n > 1").checkpoint()
    total = firsts.agg(F.sum("n").alias("t"))
    hot = firsts.join(F.broadcast(total)).filter("n * 1000 > t").select("key")  # 1,000 keys at most
    more = salted_join(each, firsts.select("key", "lead"), ["key"], hot, spread, "inner").filter(place != F.col("lead"))
    far = lambda side: F.coalesce(F.max(F.when(F.col("side") == side, F.col("k"))), F.lit(0))
    more = more.groupBy(id_col, "row_hash", "line", "stop").agg(far(-1).alias("back"), far(1).alias("on"))
    run = F.struct((F.col("line") - F.col("back")).alias("start"), (F.col("stop") + F.col("on")).alias("stop"))
    runs = later.select(id_col, "row_hash", run.alias("run")).unionByName(more.select(id_col, "row_hash", run.alias("run")))
    return runs.groupBy(id_col, "row_hash").agg(F.collect_set("run").alias("runs"))


def without(text: str, runs: list[dict]) -> tuple[str, int]:
    """The text less the lines of ``runs``, and the number of lines with a word gone."""
    gone = set()
    for r in runs:
        gone.update(range(r["start"], r["stop"]))
    kept, n, drop = [], -1, False
    for line in text.split("\n"):
        if line.encode().split():
            n += 1
            drop = n in gone
        if not drop:
            kept.append(line)
    return "\n".join(kept), len(gone)


def drop_repeats(docs: DataFrame, gram_words: int = GRAM_WORDS, run_words: int = RUN_WORDS, id_col: str = "doc_id", text_col: str = "text",
                 removed: str | None = None) -> DataFrame:
    """``docs`` with repeated runs deleted from the text; ``removed`` names an extra
    column with the number of lines gone."""
    name = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    inner = docs.toDF(*[name[c] for c in docs.columns])
    runs = repeated_runs(inner, gram_words, run_words, name[id_col], name[text_col]).select(
        F.col(name[id_col]).alias("_id"), F.col("row_hash").alias("_hash"), F.array_sort("runs").alias("_runs"))
    same = F.col(name[id_col]).eqNullSafe(F.col("_id")) & (text_hash(name[text_col]) == F.col("_hash"))
    joined = inner.join(runs, same, "left").drop("_id", "_hash")
    at = docs.columns.index(text_col)
    names = [*name.values(), "_removed"]
    out = StructType([*inner.schema.fields, StructField("_removed", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(i) for i in range(batch.num_columns)]
            found = columns.pop()
            gone = np.zeros(batch.num_rows, np.int64)
            some = np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False))
            if len(some):
                texts = columns[at].to_pylist()
                for k in some.tolist():
                    texts[k], gone[k] = without(texts[k], found[k].as_py())
                columns[at] = pa.array(texts, columns[at].type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(gone)], names=names)

    done = joined.mapInArrow(run, out)
    return done.select(*[F.col(name[c]).alias(c) for c in docs.columns], *([F.col("_removed").alias(removed)] if removed else []))
