"""Best-fit packing of tokenised documents by bin completion.

A document becomes the ids of its text and the end id. Only a document longer
than the capacity is cut, into pieces of exactly the capacity and a rest. All
pieces of the table are packed together: as pieces of equal length are
interchangeable, the search needs the number of pieces of each length only (at
most ``capacity`` rows, whatever the data). It returns patterns with
multiplicities; every piece then finds its place from its length and its rank
among the pieces of that length, in the tasks.

The search is bin completion: the largest length left opens a sequence, its
undominated fillings are enumerated (a filling is dominated if its pieces fit
in groups into another's pieces), each is applied as often as the counts
allow, and a branch ends when its waste leaves no room below the incumbent.
Best-fit decreasing gives the first incumbent; a branch that runs out of
nodes is completed by best fit and may become the next.

Nulls count as empty texts (one piece, the end id); empty tables give empty
results; repeated rows are packed as often as they occur; columns beyond id
and text are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions, slices

CACHE_WORDS = 600_000


# ---------------------------------------------------------------- tokenising

class WordTokenizer:
    """Ids of whole texts through a word-level BPE file: white space only
    separates, so a text's ids are those of its chunks, kept in a bounded cache."""

    #: Below U+0130 lower-casing is per character and NFC changes nothing.
    PLAIN = re.compile(r"[\x00-į]*")
    SPACE = re.compile("[\t-\r \x85\xa0  -     　]+")
    ODD_SPACE = re.compile("[\x1c-\x1f]")

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.chunks: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        spec = json.loads(self.tokenizer.to_str())
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.split = regex.compile(split)
        self.special = [t["content"] for t in spec["added_tokens"]]
        keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in keep]
        self.shown = {b: chr(b) for b in keep} | {b: chr(256 + i) for i, b in enumerate(rest)}

    def _word(self, word: str) -> bytes:
        got = self.words.get(word)
        if got is None:
            shown = word if word.isascii() and word.isalpha() else "".join(map(self.shown.__getitem__, word.encode()))
            got = np.fromiter([t.id for t in self.tokenizer.model.tokenize(shown)], "<u4").tobytes()
            if len(self.words) >= CACHE_WORDS:
                self.words.clear()
            self.words[word] = got
        return got

    def _chunk(self, chunk: str) -> bytes:
        if self.PLAIN.fullmatch(chunk) and not ("<" in chunk and any(s in chunk for s in self.special)):
            got = b"".join(map(self._word, self.split.findall(chunk.lower())))
        else:
            got = np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()
        if len(self.chunks) >= CACHE_WORDS:
            self.chunks.clear()
        self.chunks[chunk] = got
        return got

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        parts = self.SPACE.split(text) if self.ODD_SPACE.search(text) else text.split()
        get = self.chunks.get
        found = [get(p) for p in parts]
        if None in found:
            found = [self._chunk(p) if b is None else b for p, b in zip(parts, found)]
        return b"".join(found)


_CODERS: dict[str, WordTokenizer] = {}


def coder(path: str) -> WordTokenizer:
    """One tokenizer, with its cache, for all tasks of a worker process."""
    if path not in _CODERS:
        _CODERS[path] = WordTokenizer(path)
    return _CODERS[path]


def tokenize(docs: DataFrame, vocabulary: str, capacity: int = 2048, end_id: int = 0,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, piece, start (ids before it), length, ids (binary)."""
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, piece int, start bigint, length bigint, ids binary"
    end = np.array([end_id], "<u4").tobytes()
    width = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = coder(vocabulary)
        for whole in batches:
            for batch in slices(whole, "_text"):
                rows, number, ids = [], [], []
                for i, text in enumerate(batch.column(1).to_pylist()):
                    coded = (words.encode(text) if text else b"") + end
                    for k, at in enumerate(range(0, len(coded), width)):
                        rows.append(i)
                        number.append(k)
                        ids.append(coded[at:at + width])
                lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(number, pa.int32()),
                     pa.array(np.array(number, np.int64) * capacity), pa.array(lengths), pa.array(ids, pa.binary())],
                    names=[id_col, "piece", "start", "length", "ids"])

    return docs.select(F.col(id_col), F.col(text_col).alias("_text")).mapInArrow(run, schema)


# ------------------------------------------------------------------- search

Pattern = tuple[int, ...]


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing on (length: number), bins of one shape held together."""
    open_bins: dict[int, list[tuple[Pattern, int]]] = {}
    full: list[tuple[Pattern, int]] = []

    def put(pattern: Pattern, n: int) -> None:
        room = capacity - sum(pattern)
        (open_bins.setdefault(room, []) if room else full).append((pattern, n))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            room = min((r for r in open_bins if r >= length), default=None)
            if room is None:
                each = capacity // length
                if left // each:
                    put((length,) * each, left // each)
                if left % each:
                    put((length,) * (left % each), 1)
                break
            pattern, n = open_bins[room].pop()
            if not open_bins[room]:
                del open_bins[room]
            each = room // length
            whole = min(n, left // each)
            if whole:
                put(pattern + (length,) * each, whole)
                left -= whole * each
                n -= whole
            if n and left and left < each:
                put(pattern + (length,) * left, 1)
                left, n = 0, n - 1
            if n:
                open_bins.setdefault(room, []).append((pattern, n))
    return full + [x for group in open_bins.values() for x in group]


def fits_into(pieces: Pattern, rooms: Pattern) -> bool:
    """Whether ``pieces`` can be dealt in groups into ``rooms`` (largest first)."""
    if not pieces:
        return True
    tried = set()
    for k, room in enumerate(rooms):
        if room >= pieces[0] and room not in tried:
            tried.add(room)
            if fits_into(pieces[1:], rooms[:k] + (room - pieces[0],) + rooms[k + 1:]):
                return True
    return False


def fillings(counts: dict[int, int], lengths: list[int], room: int, allowed: int, width: int, effort: int) -> list[Pattern]:
    """Undominated fillings of ``room`` that waste at most ``allowed``, the
    fullest first. ``lengths`` are those left, descending."""
    if counts.get(room):
        return [(room,)]  # one piece that fills the room dominates every other filling
    found: list[Pattern] = []
    steps = 0

    def grow(at: int, left: int, chosen: Pattern) -> bool:
        nonlocal steps
        steps += 1
        if steps > effort:
            return False
        tail = chosen[-1] if chosen else None
        closed = True
        if counts.get(left, 0) - (chosen.count(left) if left == tail else 0) > 0 and (tail is None or left <= tail):
            found.append(chosen + (left,))
            return len(found) < 4 * width
        for i in range(at, len(lengths)):
            length = lengths[i]
            if length > left:
                continue
            if chosen.count(length) >= counts[length]:
                continue
            closed = False
            if not grow(i, left - length, chosen + (length,)):
                return False
            if steps > effort or len(found) >= 4 * width:
                return False
        if closed and left <= allowed:
            found.append(chosen)
        return True

    grow(0, room, ())
    found.sort(key=lambda p: (room - sum(p), len(p), tuple(-x for x in p)))
    kept: list[Pattern] = []
    for p in found:
        if p not in kept and not any(len(p) <= 8 and len(q) <= 8 and fits_into(p, q) for q in kept):
            kept.append(p)
        if len(kept) == width:
            break
    return kept


def bin_completion(counts: dict[int, int], capacity: int, nodes: int = 6000, width: int = 4,
                   effort: int = 3000) -> list[tuple[Pattern, int]]:
    """Patterns with multiplicities that use as few bins as the search finds.
    ``nodes`` bounds the branches opened, ``width`` the fillings kept at one and
    ``effort`` the steps of one enumeration; none of them depends on the data."""
    counts = {k: v for k, v in counts.items() if v}
    total = sum(k * v for k, v in counts.items())
    best = best_fit(counts, capacity)
    least = max(-(-total // capacity), sum(v for k, v in counts.items() if 2 * k > capacity))
    best_n = sum(n for _, n in best)
    # a stack of (counts left, lengths left, waste so far, bins so far, patterns so far as a linked list)
    stack = [(counts, sorted(counts, reverse=True), 0, 0, None)]
    opened = 0
    while stack and best_n > least:
        left, lengths, waste, bins, chain = stack.pop()
        if not lengths:
            if bins < best_n:
                best, best_n = unlink(chain), bins
            continue
        slack = (best_n - 1) * capacity - total - waste
        if slack < 0:
            continue
        opened += 1
        if opened > nodes:
            rest = best_fit(left, capacity)
            if bins + sum(n for _, n in rest) < best_n:
                best = unlink(chain) + rest
                best_n = sum(n for _, n in best)
            if opened > nodes + 50:
                break
            continue
        top = lengths[0]
        room = capacity - top
        inner = dict(left)
        inner[top] -= 1
        options = fillings(inner, [x for x in lengths if x <= room and inner[x]], room, min(room, slack), width, effort) if room else [()]
        for filling in reversed(options):
            pattern = (top, *filling)
            need: dict[int, int] = {}
            for x in pattern:
                need[x] = need.get(x, 0) + 1
            lost = room - sum(filling)
            times = min(left[x] // n for x, n in need.items())
            if lost:
                times = max(1, min(times, slack // lost if slack // lost else 1))
            after = dict(left)
            for x, n in need.items():
                after[x] -= n * times
                if not after[x]:
                    del after[x]
            if waste + lost * times <= (best_n - 1) * capacity - total:
                stack.append((after, [x for x in lengths if x in after], waste + lost * times, bins + times,
                              (pattern, times, chain)))
    return best


def unlink(chain) -> list[tuple[Pattern, int]]:
    out = []
    while chain:
        out.append((chain[0], chain[1]))
        chain = chain[2]
    return out[::-1]


def places(patterns: list[tuple[Pattern, int]]) -> dict[str, np.ndarray]:
    """Where the r-th piece of a length goes: per (pattern, length) the first rank,
    first sequence, pieces a sequence and offset, sorted by (length, rank)."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, times in patterns:
        offset = 0
        ordered = sorted(pattern, reverse=True)
        for length in dict.fromkeys(ordered):
            each = ordered.count(length)
            rows.append((length, used.get(length, 0), sequence, each, offset))
            used[length] = used.get(length, 0) + each * times
            offset += each * length
        sequence += times
    rows.sort()
    cols = np.array(rows, np.int64).reshape(-1, 5)
    return {"key": (cols[:, 0] << 44) + cols[:, 1], "rank": cols[:, 1], "sequence": cols[:, 2], "each": cols[:, 3], "offset": cols[:, 4]}


# ------------------------------------------------------------------ packing

def pack(pieces: DataFrame, capacity: int = 2048, id_col: str = "doc_id", **search) -> DataFrame:
    """``pieces`` (id, piece, length and any narrow columns) with ``sequence_id``
    and ``offset``. Each piece is at most ``capacity`` long."""
    spark = pieces.sparkSession
    buckets = shuffle_partitions(spark)
    pieces = pieces.withColumn("_bucket", F.pmod(F.xxhash64(id_col, "piece"), F.lit(buckets)).cast("int")).checkpoint()
    cells = pieces.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("n"))
    # at most capacity rows
    counts = {int(r.length): int(r.n) for r in cells.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = spark.sparkContext.broadcast(places(bin_completion(counts, capacity, **search)))
    # rank within a length: rows before this bucket, then the row number inside it, so a length that many pieces have is spread
    before = cells.select("length", "_bucket", (F.sum("n").over(Window.partitionBy("length").orderBy("_bucket")) - F.col("n")).alias("_before"))
    rest = [c for c in pieces.columns if c not in ("length", "_bucket", id_col, "piece")]
    order = Window.partitionBy("length", "_bucket").orderBy(id_col, "piece", *[c for c in rest if c in ("start", "ids_crc32")])
    ranked = (pieces.withColumn("_row", F.row_number().over(order) - 1)
              .join(before, ["length", "_bucket"])
              .withColumn("_rank", F.col("_row") + F.col("_before")).drop("_row", "_before", "_bucket"))
    columns = [c for c in pieces.columns if c != "_bucket"]
    schema = ranked.select(*columns).schema.add("sequence_id", "long").add("offset", "long")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = plan.value
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column(batch.schema.get_field_index("_rank")).to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.searchsorted(p["key"], (length << 44) + rank, "right") - 1
            within = rank - p["rank"][at]
            each = p["each"][at]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in columns]
                + [pa.array(p["sequence"][at] + within // each), pa.array(p["offset"][at] + within % each * length)],
                names=[*columns, "sequence_id", "offset"])

    return ranked.select(*columns, "_rank").mapInArrow(place, schema)


def sequences(pieces: DataFrame, placed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The packed sequences themselves: sequence_id, length, ids (binary), from
    the tokenised pieces and their places. A sequence has at most ``capacity`` ids."""
    rows = pieces.select(id_col, "piece", "ids").join(placed.select(id_col, "piece", "sequence_id", "offset"), [id_col, "piece"])
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    whole = rows.groupBy("sequence_id").agg(parts.alias("p"))
    ids = F.aggregate("p", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"]))
    return whole.select("sequence_id", (F.length(ids) / 4).cast("bigint").alias("length"), ids.alias("ids"))
