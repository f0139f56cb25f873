"""Language-model scoring by prediction by partial matching (PPM).

A text is read as bytes: its words in lower case (A-Z), joined by one space,
then an end mark. The model is a trie of byte contexts up to ``order`` with the
counts of the bytes that follow, gathered from all training documents. A byte is
coded in the longest context that knows it; each context that doesn't gives
way by its escape probability d/2n (method D: d different bytes in n, each half
a count short), and the bytes it knew are excluded from the shorter ones; the last resort is uniform over the bytes never seen. A document's score is the
log10 probability of its bytes under this pretrained model.

The trie holds every context of the corpus and is never in one place. Its nodes are dealt into shards by the last
two bytes of their context; contexts of one byte, of which there are 2^16 at most with their next bytes, go to all. Texts are read in slices,
each sends its distinct grams to the shards, which code them (a gram's code doesn't depend on the document), and the
codes come back to the slice. A shard's grams come in parts of bounded size, so more text means more parts.

Beside it stands a smoothed unigram model over whole words. Its counts are
exact for every word: the ``hot_words`` most frequent ones travel to the tasks,
the counts of all others are joined to the documents' rarer words, of which no one is frequent.

Null texts are empty (the end alone); null ids train and are not held out;
rows with equal id and text are scored once and repeated; other columns
are ignored; without training documents every byte is uniform; empty tables give empty results.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, blobs, count_floor, ragged, slices, text_hash, written

END = b"\n"
CHUNK = 1 << 16  # places that fit beside a gram of six bytes in 64 bits
FLUSH_WORDS = 400_000
#: Bytes of text whose distinct grams are coded together.
SLICE_TEXT = 8 << 20
#: Full contexts of one shard, on average.
SHARD_NODES = 1 << 20
#: Shards there can be: one for each two bytes.
MOST_SHARDS = 1 << 16
#: Bytes of grams that one task codes, as dealt.
PART_BYTES = 64 << 20


def split(text: bytes | None) -> list[bytes]:
    return text.translate(LOWER).split() if text else []


def grams(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """(context and byte, packed) of each byte of texts and of the end after
    each; contexts begin with end marks. Second: bytes of each text."""
    pad = END * order
    data = np.frombuffer(b"".join(pad + t + END for t in texts), np.uint8)
    size = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    packed = np.zeros(max(0, len(data) - order), np.uint64)
    for j in range(order + 1):
        packed <<= np.uint64(8)
        packed |= data[j:len(data) - order + j]
    return packed[ragged(size + order)[order:] >= order], size


# ------------------------------------------------------------------ the trie

class Trie:
    """Levels of (context, byte) counts as sorted arrays, with what coding needs of
    each context: total, different bytes, and the count of its bytes one level up."""

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray]]):
        self.levels = levels
        self.contexts = []
        for k, (key, n) in enumerate(levels):
            if not len(key):
                self.contexts.append((np.zeros(0, np.uint64), *[np.zeros(0)] * 3))
                continue
            context = key >> np.uint64(8)
            first = np.flatnonzero(np.append(True, context[1:] != context[:-1]))
            total, kinds = np.add.reduceat(n, first), np.diff(np.append(first, len(key))).astype(float)
            above = np.zeros(len(first))
            if k:
                upper, count = levels[k - 1]
                at = np.searchsorted(upper, key & np.uint64((1 << 8 * k) - 1))
                above = np.add.reduceat(count[at], first)
            self.contexts.append((context[first], total, kinds, above))

    def code(self, q: np.ndarray) -> np.ndarray:
        """log10 probability of packed (context, byte), which are sorted."""
        out = np.zeros(len(q))
        todo = np.arange(len(q))
        known, mass = np.zeros(len(q)), np.zeros(len(q))  # bytes excluded, and their count at this level
        for k in range(len(self.levels) - 1, -1, -1):
            key, n = self.levels[k]
            context, total, kinds, above = self.contexts[k]
            if not len(key):
                continue
            part = q[todo] & np.uint64((1 << 8 * (k + 1)) - 1)
            at = np.minimum(np.searchsorted(context, part >> np.uint64(8)), len(context) - 1)
            seen = context[at] == part >> np.uint64(8)
            fresh = np.where(seen, kinds[at] - known, 0)
            weight = np.where(seen, total[at] - mass, 0)
            place = np.minimum(np.searchsorted(key, part), len(key) - 1)
            hit = (key[place] == part) & (fresh > 0)
            out[todo[hit]] += np.log10((n[place[hit]] - 0.5) / weight[hit])
            gone = (fresh > 0) & ~hit
            out[todo[gone]] += np.log10(fresh[gone] / (2 * weight[gone]))
            stay = ~hit
            known = np.where(seen, kinds[at], 0.0)[stay]
            mass = np.where(seen, above[at], 0.0)[stay]
            todo = todo[stay]
        out[todo] -= np.log10(np.maximum(1, 256 - known))
        return out


def code_lengths(trie: Trie, packed: np.ndarray) -> np.ndarray:
    """log10 probability of each of ``packed``. Equal ones are coded once: chunks are
    sorted together with their places, which fit below a gram of six bytes."""
    out = np.empty(len(packed))
    for at in range(0, len(packed), 16 * CHUNK):
        part = packed[at:at + 16 * CHUNK]
        rows = -(-len(part) // CHUNK)
        wide = np.full(rows * CHUNK, part[-1], np.uint64)
        wide[:len(part)] = part
        wide = (wide << np.uint64(16)).reshape(rows, CHUNK) | np.arange(CHUNK, dtype=np.uint64)
        wide.sort(axis=1)
        key = wide >> np.uint64(16)
        first = np.ones(key.shape, bool)
        first[:, 1:] = key[:, 1:] != key[:, :-1]
        some = key[first]
        coded = np.empty(len(some))
        ends = np.append(0, np.cumsum(first.sum(axis=1)))
        for a, z in zip(ends, ends[1:]):
            coded[a:z] = trie.code(some[a:z])
        spread = np.empty(key.shape)
        np.put_along_axis(spread, (wide & np.uint64(CHUNK - 1)).astype(np.int64), coded[np.cumsum(first) - 1].reshape(key.shape), axis=1)
        out[at:at + len(part)] = spread.ravel()[:len(part)]
    return out


# ------------------------------------------------------------------ counting

def held_out(id_col: str = "doc_id", folds: int = 5, fold: int = 1) -> Column:
    """crc32 of the id as text falls into ``fold`` (null: no)."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))


def counts(docs: DataFrame, order: int = 5, text_col: str = "text") -> DataFrame:
    """(key, n) over all of ``docs``: keys are ``w`` and a word (or the end), and
    ``g`` and the bytes of a full context with the byte after it."""
    if order > 5:
        raise ValueError("contexts of up to five bytes fit the packed form")

    def rows(keys: list[bytes] | pa.Array, n) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(n, pa.int64())], names=["key", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for whole in batches:
            for batch in slices(whole, "_text"):
                texts = []
                for text in blobs(batch, "_text"):
                    found = split(text)
                    words.update(found)
                    texts.append(b" ".join(found))
                words[END] += len(texts)
                packed = np.sort(grams(texts, order)[0])
                first = np.flatnonzero(np.append(True, packed[1:] != packed[:-1]))
                held.append((packed[first], np.diff(np.append(first, len(packed)))))
                if len(words) > FLUSH_WORDS:
                    yield rows([b"w" + w for w in words], list(words.values()))
                    words.clear()
                if sum(len(g) for g, _ in held) > 2_000_000:
                    held = [merge(held)]
                    if len(held[0][0]) > 1_000_000:
                        yield rows(*named(held.pop()))
        if words:
            yield rows([b"w" + w for w in words], list(words.values()))
        if held:
            yield rows(*named(merge(held)))

    def merge(parts):
        key, n = np.concatenate([k for k, _ in parts]), np.concatenate([n for _, n in parts])
        by = np.argsort(key, kind="stable")
        key, n = key[by], n[by]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        return key[first], np.add.reduceat(n, first)

    def named(part):
        raw = part[0].astype(">u8").tobytes()
        return [b"g" + raw[i + 7 - order:i + 8] for i in range(0, len(raw), 8)], part[1]

    return docs.select(F.col(text_col).alias("_text")).mapInArrow(run, "key binary, n long").groupBy("key").agg(F.sum("n").alias("n"))


def shard_of(gram: np.ndarray, shards: int) -> np.ndarray:
    """Shard of packed grams, by the last two bytes of their contexts."""
    mixed = (gram >> np.uint64(8)) * np.uint64(40503) & np.uint64(0xFFFF)
    return (mixed * np.uint64(shards) >> np.uint64(16)).astype(np.int32)


def shard_column(gram: Column, shards: int) -> Column:
    mixed = (F.shiftright(gram, 8).bitwiseAND(F.lit(0xFFFF)) * 40503).bitwiseAND(F.lit(0xFFFF))
    return F.shiftright(mixed * shards, 16).cast("int")


def sub_trie(gram: np.ndarray, n: np.ndarray, order: int, tops: list[tuple[np.ndarray, np.ndarray]]) -> Trie:
    """The trie of one shard's full contexts: their shorter ones down to two bytes lie in
    the same shard; ``tops`` are the levels above, of the whole corpus."""
    levels = list(tops[:order + 1])
    for k in range(2, order + 1):
        key, place = np.unique(gram & np.uint64((1 << 8 * (k + 1)) - 1), return_inverse=True)
        levels.append((key, np.bincount(place, n, len(key))))
    return Trie(levels)


def squeeze(*columns: np.ndarray) -> bytes:
    """64-bit columns of equal length in one frame."""
    return zstandard.ZstdCompressor(level=1).compress(np.stack([c.view(np.uint64) for c in columns]).tobytes())


def spread(blob: bytes, columns: int) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint64).reshape(columns, -1)


class Coded:
    """Codes of a slice's distinct grams, where ``code_lengths`` looks them up."""

    def __init__(self, grams_: np.ndarray, codes: np.ndarray):
        order = np.argsort(grams_)
        self.grams, self.codes = grams_[order], codes[order]

    def code(self, q: np.ndarray) -> np.ndarray:
        return self.codes[np.searchsorted(self.grams, q)]


def text_scores(docs: DataFrame, found: DataFrame, order: int, id_col: str, text_col: str, shard_nodes: int = SHARD_NODES,
                part_bytes: int = PART_BYTES, slice_bytes: int = SLICE_TEXT) -> DataFrame:
    """(id, row_hash, score) of every row of ``docs`` under the trie of the counted grams in ``found``."""
    full = found.filter(F.substring("key", 1, 1) == F.lit(b"g")).select(F.conv(F.hex(F.expr("substring(key, 2)")), 16, 10).cast("long").alias("g"), "n")
    shards = min(MOST_SHARDS, max(16, -(-full.count() // shard_nodes)))
    low = full.groupBy(F.col("g").bitwiseAND(F.lit(0xFFFF)).alias("g")).agg(F.sum("n").alias("n")).toArrow()  # 2^16 rows at most
    pair, n = low.column("g").to_numpy().astype(np.uint64), low.column("n").to_numpy().astype(float)
    by = np.argsort(pair)
    one, place = np.unique(pair & np.uint64(0xFF), return_inverse=True)
    tops = [(one, np.bincount(place, n, len(one)) if len(one) else np.zeros(0)), (pair[by], n[by])]

    def pack(group: pa.Table) -> pa.Table:
        g, c = (group.column(x).to_numpy().astype(np.uint64) for x in ("g", "n"))
        return pa.table({"shard": pa.array([group.column("shard")[0].as_py()], pa.int32()), "nodes": pa.array([squeeze(g, c)], pa.binary())})

    model = written(full.withColumn("shard", shard_column(F.col("g"), shards)).groupBy("shard").applyInArrow(pack, "shard int, nodes binary"))

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, row_hash long, idx int, slice long, texts binary, shard int, size long, grams binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for whole in batches:
            for batch in slices(whole, "_text", slice_bytes):
                if not batch.num_rows:
                    continue
                texts = [b" ".join(split(t)) for t in blobs(batch, "_text")]
                q = np.unique(grams(texts, order)[0])
                shard = shard_of(q, shards)
                by = np.argsort(shard, kind="stable")
                q, shard = q[by], shard[by]
                first = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
                runs = [squeeze(x) for x in np.split(q, first[1:])]
                held = zstandard.ZstdCompressor(level=1).compress(END.join(texts))
                rows, m = batch.num_rows, len(runs)
                none = lambda k: [None] * k
                at = pa.array([*range(rows), *none(m)], pa.int64())
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(at), batch.column(1).take(at), pa.array([*range(rows), *none(m)], pa.int32()), pa.array([number] * (rows + m), pa.int64()),
                    pa.array([held, *none(rows + m - 1)], pa.binary()), pa.array([*none(rows), *shard[first].tolist()], pa.int32()),
                    pa.array([*none(rows), *map(len, runs)], pa.int64()), pa.array([*none(rows), *runs], pa.binary())],
                    names=[id_col, "row_hash", "idx", "slice", "texts", "shard", "size", "grams"])
                number += 1

    made = written(docs.select(F.col(id_col), text_hash(text_col).alias("row_hash"), F.col(text_col).alias("_text")).mapInArrow(cut, schema))
    runs = made.filter("shard is not null").select("slice", "shard", "size", "grams")
    parts = max(1, -(-(runs.agg(F.sum("size")).first()[0] or 0) // (shards * part_bytes)))
    runs = runs.withColumn("part", F.pmod(F.xxhash64("slice"), F.lit(parts)).cast("int"))
    spread_model = model.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def coded(left: pa.Table, right: pa.Table) -> pa.Table:
        nodes = np.concatenate([spread(b, 2) for b in right.column("nodes").to_pylist()], axis=1) if right.num_rows else np.zeros((2, 0), np.uint64)
        trie = sub_trie(nodes[0], nodes[1].astype(float), order, tops)
        out = []
        for blob in left.column("grams").to_pylist():
            q = spread(blob, 1)[0]
            out.append(squeeze(q, trie.code(q)))
        return pa.table({"slice": left.column("slice").combine_chunks() if left.num_rows else pa.array([], pa.int64()), "codes": pa.array(out, pa.binary())})

    codes = runs.select("slice", "shard", "part", "grams").groupBy("shard", "part").cogroup(spread_model.groupBy("shard", "part")).applyInArrow(coded, "slice long, codes binary")

    def summed(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"slice": [], "idx": [], "score": []}
        parts_ = [spread(b, 2) for b in right.column("codes").to_pylist()]
        lookup = Coded(np.concatenate([p[0] for p in parts_]), np.concatenate([p[1] for p in parts_]).view(np.float64)) if parts_ else None
        for number, held in zip(left.column("slice").to_pylist(), left.column("texts").to_pylist()):
            packed, size = grams(zstandard.ZstdDecompressor().decompress(held).split(END), order)
            score = np.add.reduceat(code_lengths(lookup, packed), np.cumsum(size) - size)
            out["slice"] += [number] * len(size)
            out["idx"] += range(len(size))
            out["score"] += score.tolist()
        return pa.table({"slice": pa.array(out["slice"], pa.int64()), "idx": pa.array(out["idx"], pa.int32()), "score": pa.array(out["score"], pa.float64())})

    scores = made.filter("texts is not null").select("slice", "texts").groupBy("slice").cogroup(codes.groupBy("slice")).applyInArrow(
        summed, "slice long, idx int, score double")
    return made.filter("idx is not null").select(id_col, "row_hash", "slice", "idx").join(scores, ["slice", "idx"]).select(id_col, "row_hash", "score")


# ------------------------------------------------------------------- scoring

def score(docs: DataFrame, training: Column, order: int = 5, hot_words: int = 1 << 18, id_col: str = "doc_id", text_col: str = "text", **dealing) -> DataFrame:
    """Id, n_tokens, n_known, train_tokens, base_score and score of every row of
    ``docs``; the model learns from the rows where ``training`` holds. ``dealing``
    (``shard_nodes``, ``part_bytes``, ``slice_bytes``) moves the work, not the scores."""
    spark = docs.sparkSession
    found = written(counts(docs.filter(training), order, text_col))
    words = found.filter(F.substring("key", 1, 1) == F.lit(b"w"))
    total, kinds = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).collect()[0]
    scale = total + 0.5 * (kinds + 1)
    floor = count_floor(words, "n", hot_words)
    hot = words.filter(F.col("n") >= floor).toArrow()  # hot_words rows at most
    held = spark.sparkContext.broadcast(dict(zip((k[1:] for k in hot.column("key").to_pylist()), hot.column("n").to_pylist())))
    kind = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "row_hash", "key", "count", "tokens", "hot_known", "hot_score"]
    schema = f"`{id_col}` {kind}, row_hash long, key binary, count long, tokens long, hot_known long, hot_score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = held.value.get
        for whole in batches:
            for batch in slices(whole, "_text", 4 << 20):
                row, key, count, tokens, hot_known, hot_score = [], [], [], [], [], []
                for i, text in enumerate(blobs(batch, "_text")):
                    tokens_here = split(text)
                    tokens_here.append(END)
                    c = [get(w, 0) for w in tokens_here]
                    rare = Counter(w for w, n in zip(tokens_here, c) if not n) if 0 in c else {}
                    some = np.array(c, float)
                    some = some[some > 0]
                    tokens.append(len(c))
                    hot_known.append(len(some))
                    hot_score.append(float(np.log10((some + 0.5) / scale).sum()))
                    row.extend([i] * len(rare))
                    key.extend(b"w" + w for w in rare)
                    count.extend(rare.values())
                n, m = len(tokens), len(key)
                # the document's own row carries a key of its own, so that these rows spread too
                own = [b"d%d" % h for h in batch.column(1).to_pylist()]
                at = pa.array([*row, *range(n)], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array([*key, *own], pa.binary()), pa.array([*count, *[0] * n], pa.int64()),
                     pa.array([*[0] * m, *tokens], pa.int64()), pa.array([*[0] * m, *hot_known], pa.int64()), pa.array([*[0.0] * m, *hot_score], pa.float64())], names=names)

    parts = docs.select(F.col(id_col), text_hash(text_col).alias("row_hash"), F.col(text_col).alias("_text")).mapInArrow(run, schema)
    rare = words.filter(F.col("n") < floor).select(F.col("key").alias("_key"), "n")
    joined = parts.join(rare, F.col("key") == F.col("_key"), "left")
    rest = F.col("count") * F.log10((F.coalesce(F.col("n"), F.lit(0)) + 0.5) / F.lit(scale))
    none = lambda *names_: [F.lit(0).cast("long").alias(x) for x in names_]
    base = joined.select(id_col, "row_hash", (F.col("tokens") > 0).cast("long").alias("m"), "tokens",
                         (F.col("hot_known") + F.when(F.col("n") > 0, F.col("count")).otherwise(F.lit(0))).alias("known"), (F.col("hot_score") + rest).alias("base"), F.lit(0.0).alias("score"))
    coded = text_scores(docs, found, order, id_col, text_col, **dealing).select(id_col, "row_hash", *none("m", "tokens", "known"), F.lit(0.0).alias("base"), "score")
    rows = base.unionByName(coded).groupBy(id_col, "row_hash").agg(*[F.sum(x).alias(x) for x in ("m", "tokens", "known", "base", "score")])
    rows = rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("m").cast("int"))))
    each = lambda c, t: (F.col(c) / F.col("m")).cast(t)
    return rows.select(id_col, each("tokens", "long").alias("n_tokens"), each("known", "long").alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
                       each("base", "double").alias("base_score"), each("score", "double").alias("score"))
