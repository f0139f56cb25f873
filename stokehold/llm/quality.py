"""Quality rules: shape statistics and a hashed n-gram log-likelihood ratio.

Words and pairs of neighbouring words are hashed into ``buckets``. Their
counts over the trusted documents and over all documents give two
multinomials, the raw one smoothed by a half, the trusted one by the raw one. A document's score is the mean, over its
n-grams, of log(trusted / raw): length-normalised, so long and short texts
meet one threshold, and deterministic, so no document's fate is drawn. Ratios within the noise of their bucket
(``evidence`` standard deviations of its trusted count) are shrunk to 0: otherwise the noise of many rare n-grams
hides the few words, an insult among hundreds, that trusted documents never hold.

Everything is built from SQL functions. The counts of all documents are
combined in the map tasks, so the shuffle holds ``buckets`` rows a task; the
model is ``buckets`` numbers and travels as a literal.

Null texts have no words; a text without words has a null score and fails
the base rules; ids that are null are never trusted; repeated rows stay and count; an
empty trusted set gives every bucket ratio 1 (score 0); other columns are ignored, and dropped from ``score``.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import renamed

BUCKETS = 1 << 18
#: Weight of the raw multinomial as the trusted one's prior, as a share of all trusted n-grams.
PRIOR_SHARE = 0.001
#: Standard deviations of a bucket's trusted count up to which its ratio is 0.
EVIDENCE = 3.0
#: Mean log ratio below which a text is unlike the trusted ones.
THRESHOLD = -0.02

#: Bits of a window's place beside its hash.
PLACE_BITS = 20
SYMBOLS = "#*$%&|<>"
SPACES = "\t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+` of a text (null: none)."""
    return F.coalesce(F.array_remove(F.split(F.translate(text, SPACES, " " * 5), " ", -1), ""), F.array().cast("array<string>"))


def hashed(w: Column) -> Column:
    """A 64-bit hash of each word: what follows compares and pairs these numbers."""
    return F.transform(w, lambda x: F.xxhash64(x))


def grams(h: str, buckets: int) -> Column:
    """Bucket (from 1) of each word and each pair of neighbours of an array column of hashes."""
    one = F.transform(h, lambda x: F.pmod(x, F.lit(buckets)).cast("int") + 1)
    two = F.transform(F.slice(F.col(h), 1, F.greatest(F.size(h) - 1, F.lit(0))),
                      lambda x, i: F.pmod(F.xxhash64(x, F.get(F.col(h), i + 1)), F.lit(buckets)).cast("int") + 1)
    return F.concat(one, two)


def base_statistics(docs: DataFrame, text: str = "_text", h: str = "_hashes") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words; ``h`` holds the hashes of the words."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.length(F.translate(x, " " + SPACES, "")) > 0)
    out = docs.withColumns({
        "n_words": F.size(h).cast("long"),
        "word_chars": F.char_length(F.translate(t, " " + SPACES, "")).cast("long"),
        "n_symbols": (F.char_length(t) - F.char_length(F.translate(t, SYMBOLS, ""))).cast("long"),
        "_lines": lines,
        "_windows": F.when(F.size(h) >= 3, F.transform(F.slice(F.col(h), 1, F.size(h) - 2),
                                                       lambda x, i: F.xxhash64(x, F.get(F.col(h), i + 1), F.get(F.col(h), i + 2))))})
    # windows that occur twice: neighbours with an equal hash after a sort; skipped where all differ. Hash and
    # place share one number (44 and 20 bits), which sorts far faster than a pair; the whole hashes are compared after
    some = F.size(F.array_distinct("_windows")) < F.size("_windows")
    place = lambda s: s.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int")
    hash_of = lambda s: F.get("_windows", place(s))
    packed = F.transform("_windows", lambda h, i: h.bitwiseAND(F.lit(-1 << PLACE_BITS)).bitwiseOR(i.cast("long")))
    pairs = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    out = out.withColumns({
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_sorted": F.when(some & (F.size("_windows") <= 1 << PLACE_BITS), F.sort_array(packed)),
        "_pairs": F.when(some & (F.size("_windows") > 1 << PLACE_BITS), pairs)})
    near = lambda s, o: (F.shiftright(s, PLACE_BITS) == F.shiftright(o, PLACE_BITS)) & (hash_of(s) == hash_of(o))
    twice = F.filter("_sorted", lambda s, j: F.coalesce(near(s, F.get("_sorted", j - 1)), F.lit(False)) | F.coalesce(near(s, F.get("_sorted", j + 1)), F.lit(False)))
    wide = F.filter("_pairs", lambda s, j: (s["h"] == F.get("_pairs", j - 1)["h"]) | (s["h"] == F.get("_pairs", j + 1)["h"]))
    places = F.sort_array(F.coalesce(F.transform(twice, place), F.transform(wide, lambda s: s["i"])))
    held = F.aggregate(places, F.struct(F.lit(-3).alias("at"), F.lit(0).cast("long").alias("n")),
                       lambda a, i: F.struct(i.alias("at"), (a["n"] + F.least(F.lit(3), i - a["at"])).alias("n")))["n"]
    return out.withColumn("n_repeat_words", F.coalesce(held, F.lit(0).cast("long"))).drop("_lines", "_windows", "_sorted", "_pairs")


def log_ratios(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, prior: float | None = None, id_col: str = "doc_id",
               text_col: str = "text", evidence: float = 0.0) -> list[float]:
    """log(trusted / raw) of each bucket, from all n-grams of ``docs``; ``trusted``
    holds the ids of the trusted documents. ``prior`` is in n-grams a bucket (none: ``PRIOR_SHARE`` of the trusted ones)."""
    ids = trusted.select(F.col(id_col).alias("_id")).filter("_id is not null").distinct().withColumn("_trusted", F.lit(1))
    # the ids are the small side: hashed in each task, so that no text is sorted
    rows = docs.select(F.col(id_col), F.col(text_col).alias("_text")).join(ids.hint("shuffle_hash"), F.col(id_col) == F.col("_id"), "left")
    rows = rows.select(hashed(words(F.col("_text"))).alias("_hashes"), F.coalesce("_trusted", F.lit(0)).alias("_trusted"))
    each = rows.select(F.explode(grams("_hashes", buckets)).alias("b"), "_trusted")
    found = each.groupBy("b").agg(F.sum("_trusted").alias("t"), F.count(F.lit(1)).alias("n")).toArrow()  # buckets rows
    t, n = np.zeros(buckets), np.zeros(buckets)
    at = found.column("b").to_numpy() - 1
    t[at], n[at] = found.column("t").to_numpy(), found.column("n").to_numpy()
    if not t.sum():
        return [0.0] * buckets
    # the raw multinomial is the prior of the trusted one: little evidence, ratio near 1
    raw = (n + .5) / (n.sum() + .5 * buckets)
    weight = PRIOR_SHARE * t.sum() if prior is None else prior * buckets
    ratio = np.log((t + weight * raw) / (t.sum() + weight) / raw)
    share = t.sum() / n.sum()
    variance, off = n * share * (1 - share), (t - n * share) ** 2
    # all documents trusted: no bucket can differ
    return (ratio * np.maximum(0, 1 - evidence ** 2 * np.divide(variance, off, out=np.full(buckets, np.inf), where=off > 0))).tolist() if evidence else ratio.tolist()


def score(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS, prior: float | None = None,
          id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, evidence: float = EVIDENCE) -> DataFrame:
    """Id, base statistics, base_failed, llr and kept for every row of ``docs``,
    with its columns ``keep`` before them."""
    ratio = F.from_json(F.lit(json.dumps(log_ratios(docs, trusted, buckets, prior, id_col, text_col, evidence))), "array<double>")
    held = list(dict.fromkeys([id_col, *(keep or [])]))
    rows = docs.select(*held, F.col(text_col).alias("_text"), hashed(words(F.col(text_col))).alias("_hashes"))
    rows = base_statistics(rows).withColumn("_grams", grams("_hashes", buckets))
    total = F.aggregate("_grams", F.lit(0.0), lambda a, b: a + F.element_at(ratio, b))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = rows.withColumn("llr", F.when(F.size("_grams") > 0, total / F.size("_grams")))
    kept = ~failed & F.coalesce(F.col("llr") >= threshold, F.lit(False))
    # one generated row: a filter on a result is not pushed below, where it would repeat every expression
    result = F.struct("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), "llr", kept.alias("kept"))
    return rows.select(*held, F.inline(F.array(result)))


def keep_good(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    inner, name = renamed(docs)
    same = trusted.withColumnRenamed(id_col, name[id_col])
    out = score(inner, same, id_col=name[id_col], text_col=name[text_col], keep=list(inner.columns), **options).filter("kept")
    return out.select(*[F.col(name[c]).alias(c) for c in docs.columns])
