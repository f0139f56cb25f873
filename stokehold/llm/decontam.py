"""Benchmark decontamination with a distributed positional inverted index.

The index is partitioned by document: a row holds a document's postings, the
positions of each test-set term in it, and rows live wherever the document
was read, so postings are stored without a shuffle. A query is a window of
consecutive words of a test item. In every partition the position lists of
the window's terms are intersected after adjustment by their offset in the
window, starting from the term that is rarest in the whole corpus (the
corpus frequencies come from the stored postings); a window with a term that
no document has is never looked up. Exact matches are the positions that
survive all terms; proximity matches are the positions of the rarest term
with every other term of the window within ``slop`` words of the window's length.

The test set is taken in blocks of bounded size (``block_words``), each
against all documents, so what a task holds of it doesn't grow.

Null texts have no words and no matches; items without words have no
windows; repeated documents stay as rows; repeated items are reported by
each of their ids; null item ids are reported as an empty string; other
columns are ignored; empty tables give empty results or documents without matches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blobs, ragged, renamed, slices, text_hash

#: Bytes to words: letters A-Z lowered, other ASCII than letters and digits parted.
WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: The same words for SQL.
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(WORDS).split() if text else []


class Windows:
    """The windows of a block of test items: term ids, lengths and owners."""

    def __init__(self, items: list[tuple[str, bytes | None]], size: int):
        self.size = size
        self.terms: dict[bytes, int] = {}
        found: dict[tuple[int, ...], list[str]] = {}
        for item, text in items:
            ids = [self.terms.setdefault(w, len(self.terms)) for w in words_of(text)]
            for at in range(max(1, len(ids) - size + 1) if ids else 0):
                owners = found.setdefault(tuple(ids[at:at + size]), [])
                if not owners or owners[-1] != item:
                    owners.append(item)
        self.owners = [sorted(set(o)) for o in found.values()]
        self.length = np.array([len(w) for w in found], np.int64)
        self.ids = np.full((len(found), size), -1, np.int64)
        for k, w in enumerate(found):
            self.ids[k, :len(w)] = w

    def by_rarity(self, frequency: np.ndarray) -> np.ndarray:
        """Slots of each window from its rarest term on; missing slots last."""
        cost = np.where(self.ids >= 0, np.append(frequency, 0)[self.ids], np.iinfo(np.int64).max)
        return np.argsort(cost, axis=1, kind="stable")


def build_index(docs: DataFrame, terms: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Positional postings: id, row_hash, n_words, and the document's term ids with
    the end of each one's run in ``positions`` (ascending)."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, row_hash bigint, n_words bigint, terms array<int>, ends array<int>, positions array<int>"
    held = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = held.value.get
        for whole in batches:
            for batch in slices(whole, "_text"):
                split = [words_of(t) for t in blobs(batch, "_text")]
                n = np.fromiter(map(len, split), np.int64, len(split))
                ids = np.fromiter([get(w, -1) for ws in split for w in ws], np.int64, int(n.sum()))
                doc = np.repeat(np.arange(len(n)), n)
                pos = ragged(n)
                known = ids >= 0
                doc, pos, ids = doc[known], pos[known], ids[known]
                key = doc * max(1, len(held.value)) + ids
                order = np.argsort(key, kind="stable")
                key, pos = key[order], pos[order]
                first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
                runs = np.diff(np.append(first, len(key)))
                run_doc = doc[order][first]
                per_doc = np.bincount(doc, minlength=len(n))
                doc_start = np.cumsum(per_doc) - per_doc
                ends = np.cumsum(runs) - doc_start[run_doc]
                terms_at = np.append(0, np.cumsum(np.bincount(run_doc, minlength=len(n)))).astype(np.int32)
                pos_at = np.append(0, np.cumsum(per_doc)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(n),
                     pa.ListArray.from_arrays(terms_at, pa.array(ids[order][first].astype(np.int32))),
                     pa.ListArray.from_arrays(terms_at, pa.array(ends.astype(np.int32))),
                     pa.ListArray.from_arrays(pos_at, pa.array(pos.astype(np.int32)))],
                    names=[id_col, "row_hash", "n_words", "terms", "ends", "positions"])

    return docs.select(F.col(id_col), text_hash(text_col).alias("row_hash"), F.col(text_col).alias("_text")).mapInArrow(run, schema)


def unpack(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Postings of a batch, by (document, term): document row, term and length of
    each list, and all positions end to end."""
    col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
    counts = np.diff(col["terms"].offsets.to_numpy())
    row = np.repeat(np.arange(batch.num_rows), counts)
    term = col["terms"].flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    ends = col["ends"].flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    before = np.append(0, ends[:-1])
    before[np.cumsum(counts)[:-1][np.cumsum(counts)[:-1] < len(ends)]] = 0
    if len(ends):
        before[0] = 0
    return row, term, ends - before, col["positions"].flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def term_counts(index: DataFrame, n_terms: int) -> np.ndarray:
    """Occurrences of each term in all documents, from the stored postings."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            _, term, length, _ = unpack(batch)
            np.add.at(total, term, length)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["term", "n"])

    rows = index.select("terms", "ends", "positions").mapInArrow(run, "term bigint, n bigint")
    out = np.zeros(n_terms, np.int64)
    for r in rows.groupBy("term").agg(F.sum("n").alias("n")).collect():  # one row a term of the block
        out[r.term] = r.n
    return out


def match_batch(n: np.ndarray, row: np.ndarray, term: np.ndarray, length: np.ndarray, pos: np.ndarray, windows: Windows,
                order: np.ndarray, usable: np.ndarray, slop: int | None, at_once: int = 1 << 21):
    """(window, document row, position) of exact and of proximity matches in a batch."""
    gap = windows.size + (slop or 0) + 1
    base = np.cumsum(n + gap) - n  # room before the first and after the last
    span = int(base[-1] + n[-1] + gap) if len(n) else 0
    at = np.repeat(base[row], length) + pos
    terms = np.repeat(term, length)
    there = np.full(span, -1, np.int32)  # the position lists, addressed by position
    there[at] = terms
    by_term = np.argsort(terms, kind="stable")
    lists = at[by_term]
    n_terms = len(windows.terms)
    counts = np.bincount(terms, minlength=n_terms)
    starts = np.cumsum(counts) - counts
    exact, near = [], []
    rare = order[usable, 0]
    anchor = windows.ids[usable, rare]
    some = np.flatnonzero((counts[np.where(windows.ids[usable] >= 0, windows.ids[usable], anchor[:, None])] > 0).all(axis=1))
    work = np.append(0, np.cumsum(counts[anchor[some]]))
    lo = 0
    keys = terms[by_term].astype(np.int64) * (span + 1) + lists if slop is not None else None
    while lo < len(some):
        hi = max(lo + 1, int(np.searchsorted(work, work[lo] + at_once, "right")) - 1)
        part = some[lo:hi]
        lo = hi
        m = counts[anchor[part]]
        w = np.repeat(usable[part], m)
        where = lists[np.repeat(starts[anchor[part]], m) + ragged(m)]
        begin = where - np.repeat(rare[part], m)
        live = begin >= 0
        ew, eb = w[live], begin[live]
        nw, na = w, where
        for k in range(1, windows.size):
            slot = order[ew, k]
            want = windows.ids[ew, slot]
            fits = (want < 0) | (there[np.minimum(eb + slot, span - 1)] == want)
            ew, eb = ew[fits], eb[fits]
            if slop is not None and len(nw):
                want = windows.ids[nw, order[nw, k]]
                reach = windows.length[nw] + slop - 1
                lowest = np.searchsorted(keys, want * (span + 1) + np.maximum(na - reach, 0))
                highest = np.searchsorted(keys, want * (span + 1) + np.minimum(na + reach, span), "right")
                fits = (want < 0) | (highest > lowest)
                nw, na = nw[fits], na[fits]
        exact.append((ew, eb))
        if slop is not None:
            near.append((nw, na))

    def located(found):
        w = np.concatenate([x for x, _ in found]) if found else np.zeros(0, np.int64)
        p = np.concatenate([x for _, x in found]) if found else np.zeros(0, np.int64)
        doc = np.searchsorted(base, p, "right") - 1
        return w, doc, p - base[doc] if len(p) else p

    return located(exact), located(near)


def search(index: DataFrame, windows: Windows, frequency: np.ndarray, slop: int | None = None, id_col: str = "doc_id") -> DataFrame:
    """One row a document of ``index``: n_words, ``items`` (ids with an exact match,
    sorted), ``spans`` (words inside matches, as merged [start, stop)), ``near`` (ids with a proximity match)."""
    kind = index.schema[id_col].dataType.simpleString()
    schema = (f"`{id_col}` {kind}, row_hash bigint, n_words bigint, items array<string>, "
              "spans array<struct<start: int, stop: int>>, near array<string>")
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
    order = windows.by_rarity(frequency)
    usable = np.flatnonzero((np.append(frequency, 1)[windows.ids] > 0).all(axis=1))
    held = index.sparkSession.sparkContext.broadcast((windows, order, usable))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows, order, usable = held.value
        for batch in batches:
            n = batch.column(2).to_numpy(zero_copy_only=False)
            (w, doc, pos), (nw, ndoc, _) = match_batch(n, *unpack(batch), windows, order, usable, slop)
            items: list[set] = [set() for _ in n]
            spans: list[list] = [[] for _ in n]
            near: list[set] = [set() for _ in n]
            by = np.lexsort((pos, doc))
            for d, p, k in zip(doc[by].tolist(), pos[by].tolist(), w[by].tolist()):
                items[d].update(windows.owners[k])
                stop = p + int(windows.length[k])
                if spans[d] and spans[d][-1]["stop"] >= p:
                    spans[d][-1]["stop"] = max(spans[d][-1]["stop"], stop)
                else:
                    spans[d].append({"start": p, "stop": stop})
            for d, k in set(zip(ndoc.tolist(), nw.tolist())):
                near[d].update(windows.owners[k])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                 pa.array(spans, span_type), pa.array([sorted(x) for x in near], pa.list_(pa.string()))],
                names=[id_col, "row_hash", "n_words", "items", "spans", "near"])

    return index.mapInArrow(run, schema)


def covered(spans: str = "spans"):
    """Words in the union of spans that may overlap."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("at"))
    step = lambda a, s: F.struct((a["n"] + F.greatest(F.lit(0), s["stop"] - F.greatest(s["start"], a["at"]))).alias("n"),
                                 F.greatest(a["at"], s["stop"]).alias("at"))
    return F.aggregate(F.array_sort(spans), start, step)["n"]


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = 10, slop: int | None = None, block_words: int = 2_000_000,
                  id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document: id, row_hash, n_words, items, spans, near, n_hit."""
    test = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.col(item_text).alias("text"))
    chars = test.agg(F.sum(F.octet_length("text"))).collect()[0][0] or 0
    blocks = max(1, -(-chars // (2 * block_words)))  # a word and its separator have two bytes at least
    found = None
    for k in range(blocks):
        part = test.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k) if blocks > 1 else test
        windows = Windows([(r.item, r.text.encode() if r.text else None) for r in part.collect()], size)
        index = build_index(docs, windows.terms, id_col, text_col).checkpoint()
        rows = search(index, windows, term_counts(index, len(windows.terms)), slop, id_col)
        found = rows if found is None else found.unionByName(rows)
    if blocks > 1:
        merged = found.groupBy(id_col, "row_hash").agg(
            F.first("n_words").alias("n_words"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
            F.flatten(F.collect_list("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"),
            (F.count(F.lit(1)) / blocks).cast("int").alias("_copies"))
        found = merged.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_copies"))).drop("_copies", "_copy")
    return found.withColumn("n_hit", covered())


def keep_clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that hold a window of the test set."""
    inner, names = renamed(docs)
    key, text = names[id_col], names[text_col]
    hit = decontaminate(inner, benchmark, id_col=key, text_col=text, **options).filter("n_hit > 0")
    bad = hit.select(F.col(key).alias("_id"), F.col("row_hash").alias("_hash")).distinct()
    same = F.col(key).eqNullSafe(F.col("_id")) & (text_hash(text) == F.col("_hash"))
    return inner.join(bad, same, "left_anti").select(*[F.col(n).alias(c) for c, n in names.items()])
