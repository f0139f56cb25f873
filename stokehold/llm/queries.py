"""Registered queries of the training-data operators: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat, classifier, decontam, htmlcut, linededup, lm, packing, pii, quality, sharding, simhash, spillcount,
               vectorcode)
from .common import hot_keys, salted_join, table, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql.strip()
        return fn

    return add


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Trusted documents: labelled good and not toxic."""
    return labels.filter("quality = 1 and coalesce(toxic, 0) = 0").select("doc_id")


@query()
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), trusted_ids(table(spark, sf_dir, "labels"))).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "llr")


def packed(docs: DataFrame) -> DataFrame:
    pieces = packing.tokenize(docs, public_tokenizers.path("word_bpe_49k.json"), 2048, 0)
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), 2048)


@query()
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


_ESCAPED = "replace(text, '\\', '\\\\')"
for _mark in chat.CONTROL:
    _ESCAPED = f"replace({_ESCAPED}, '{_mark}', '{_mark[0]}\\{_mark[1:]}')"


@query(f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) loss_sha256,
       CAST(sum({len(chat.OPEN + chat.CLOSE) + 1} + length(role) + length({_ESCAPED})) AS BIGINT) formatted_chars
FROM c GROUP BY conv_id
""")
def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-7).alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(odd).alias("text"))
    segments, members = chat.format_trees(rows.unionByName(extra))
    return chat.read_back(segments, members).withColumnRenamed("conv", "conv_id")


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(rf"""
WITH d AS (SELECT row_number() OVER () rid, doc_id, coalesce(regexp_extract_all({_LOWER}, '{decontam.WORD_PATTERN}'), []) w FROM documents),
b AS (SELECT item_id, coalesce(regexp_extract_all({_LOWER}, '{decontam.WORD_PATTERN}'), []) w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(10, len(w)) n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') g
       FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) i FROM b WHERE len(w) > 0)),
p AS (SELECT rid, w, unnest(range(1, len(w) + 1)) i FROM d),
dw AS (SELECT rid, i, n, array_to_string(w[i:i + n - 1], ' ') g FROM p, (SELECT DISTINCT n FROM bw) s WHERE i + n - 1 <= len(w)),
m AS (SELECT rid, i, dw.n, item_id FROM dw JOIN bw ON bw.n = dw.n AND bw.g = dw.g),
h AS (SELECT rid, count(DISTINCT x) n_hit FROM (SELECT rid, unnest(range(i, i + n)) x FROM m) GROUP BY rid),
t AS (SELECT rid, count(*) n_items, string_agg(s, ',' ORDER BY s) a FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) s FROM m) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) n_words, CAST(coalesce(n_hit, 0) AS BIGINT) n_hit, CAST(coalesce(n_items, 0) AS BIGINT) n_items,
       sha256(coalesce(a, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
FROM d LEFT JOIN h USING (rid) LEFT JOIN t USING (rid)
""")
def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), size=10)
    return found.select("doc_id", "n_words", F.col("n_hit").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@query()
def benchmark_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The proximity matches of operator 4: items with a window all of whose words stand within the window's length and two more words."""
    found = decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), size=10, slop=2)
    return found.select("doc_id", "n_hit", F.size("near").cast("long").alias("n_near"), F.concat_ws(",", F.array_sort("near")).alias("near_items"))


@query()
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.drop_repeats(table(spark, sf_dir, "documents"), removed="n_removed").select("doc_id", "n_removed", "text")


@query()
def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm.score(table(spark, sf_dir, "documents"), ~lm.held_out("doc_id"))
    return scored.select("doc_id", lm.held_out("doc_id").alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query()
def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=2, seed=42)
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query()
def op9_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a deployment passes its own secret
    done = pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), key="example key", found="values")
    return done.select("doc_id", "text", F.size("values").cast("long").alias("n_values"), "values")


@query()
def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = htmlcut.extract(table(spark, sf_dir, "pages"), keep=["page_id", "url"])
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


_ROUNDS, _PARTS, _ENTRIES, _SCALE = 6, 8, 16, 4096


def _assign_sql(books: str) -> str:
    return f"""SELECT rid, part, x, arg_min(entry, (d, entry)) entry, min(d) d FROM (SELECT rid, p.part, p.x, c.entry,
        list_sum(list_transform(list_zip(p.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) d FROM p JOIN {books} c USING (part)) GROUP BY ALL"""


_ROUND_SQL = "".join(f"""
a{r} AS MATERIALIZED ({_assign_sql(f"c{r}")}),
m{r} AS (SELECT part, entry, list(m ORDER BY i) x FROM (SELECT part, entry, i, CAST((sum(v) - ((sum(v) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) m
  FROM (SELECT part, entry, unnest(x) v, generate_subscripts(x, 1) i FROM a{r}) GROUP BY ALL) GROUP BY ALL),
c{r + 1} AS MATERIALIZED (SELECT c.part, c.entry, coalesce(m.x, c.x) x FROM c{r} c LEFT JOIN m{r} m USING (part, entry)),""" for r in range(_ROUNDS))


@query(f"""
WITH k AS (SELECT row_number() OVER (ORDER BY vec_id) rid, vec_id, label, list_transform(embedding, lambda x: CAST(floor({_SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) e
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
w AS (SELECT max(len(e)) // {_PARTS} w FROM k),
p AS MATERIALIZED (SELECT rid, part, e[part * w + 1:part * w + w] x FROM k, w, range({_PARTS}) q(part)),
c0 AS (SELECT part, rid - 1 entry, x FROM p WHERE rid <= {_ENTRIES}),{_ROUND_SQL}
f AS MATERIALIZED ({_assign_sql(f"c{_ROUNDS}")}),
g AS (SELECT rid, string_agg(printf('%02x', entry), '' ORDER BY part) code, CAST(sum(d) AS BIGINT) error FROM f GROUP BY rid),
s AS (SELECT sha256(coalesce(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry), '')) h FROM c{_ROUNDS})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) label_error, h codebooks_sha256 FROM k JOIN g USING (rid), s
""")
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vectorcode.compress(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", _PARTS, _ENTRIES, _ROUNDS, _SCALE, keep=["label"])
    coded = written(coded)
    errors = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    joined = salted_join(coded, errors, ["label"], hot_keys(coded, ["label"]), ["vec_id"])
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    code = F.concat_ws("", F.transform("code", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))))
    return joined.select("vec_id", code.alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


@query()
def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spillcount.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                            public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.PATTERN)


# CRC-32 by its table; the ring, the bounded walk (one step a place) and the ranks as in ``sharding``
@query(r"""
WITH RECURSIVE tab8(k, i, c) AS (SELECT 0, i, i FROM range(256) r(i)
  UNION ALL SELECT k + 1, i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM tab8 WHERE k < 8),
tab AS (SELECT list(c ORDER BY i) t FROM tab8 WHERE k = 8),
d AS (SELECT doc_id, coalesce(text, '') tx, CAST(strlen(coalesce(text, '')) + 16 AS BIGINT) AS size,
             CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), chr(0) || 'null')), 1, 15) AS BIGINT) pos FROM documents),
e AS (SELECT doc_id, size, pos, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(tx)), '..'),
             lambda x: CAST('0x' || x AS BIGINT))), lambda a, b: xor(a >> 8, t[1 + (xor(a, b) & 255)]))) crc FROM d, tab),
ring AS (SELECT pos, shard, row_number() OVER (ORDER BY pos) - 1 arc FROM (SELECT s shard,
         CAST('0x' || substr(md5('shard ' || s || ' node ' || v), 1, 15) AS BIGINT) pos FROM range(40) a(s), range(64) b(v))),
owners AS (SELECT arc, shard, pos FROM ring UNION ALL SELECT 2560, shard, NULL FROM ring WHERE arc = 0),
placed AS (SELECT e.*, coalesce(r.arc, 2560) arc FROM e ASOF LEFT JOIN ring r ON r.pos >= e.pos),
counts AS (SELECT o.arc, o.shard, count(p.pos) n FROM owners o LEFT JOIN placed p USING (arc) GROUP BY ALL),
total AS (SELECT sum(n)::BIGINT n FROM counts),
most AS (SELECT list(n // 40 + CASE WHEN s < n % 40 THEN 1 ELSE 0 END ORDER BY s) m FROM total, range(40) a(s)),
homes AS (SELECT arc, shard, n, greatest(0, least(n, m[shard + 1] - coalesce(sum(n) OVER (PARTITION BY shard ORDER BY arc ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)))::BIGINT take,
          least(m[shard + 1], coalesce(sum(n) OVER (PARTITION BY shard ORDER BY arc ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT base FROM counts, most),
flow AS (SELECT list(n - take ORDER BY arc) extra, list(shard ORDER BY arc) own FROM homes),
first AS (SELECT list(used ORDER BY shard) u FROM (SELECT shard, sum(take)::BIGINT used FROM homes GROUP BY shard)),
w(step, carry, gone, used, shard, t) AS (
  SELECT -1, 0::BIGINT, 0::BIGINT, u, 0::BIGINT, 0::BIGINT FROM first
  UNION ALL
  SELECT step + 1, c - take, gone + take, list_transform(used, lambda x, i: x + CASE WHEN i = s + 1 THEN take ELSE 0 END), s, take
  FROM (SELECT *, least(c, m[s + 1] - used[s + 1]) take FROM
        (SELECT w.step, w.gone, w.used, carry + CASE WHEN step + 1 <= 2560 THEN extra[step + 2] ELSE 0 END c, own[(step + 1) % 2561 + 1] s FROM w, flow WHERE step + 1 < 2 * 2561), most)),
steps AS (SELECT shard, gone - t lo, gone hi, used[shard + 1] - t base FROM w WHERE t > 0),
enter AS (SELECT arc, shard, take, base, coalesce(sum(n - take) OVER (ORDER BY arc ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT e FROM homes),
ranks AS (SELECT *, row_number() OVER (PARTITION BY arc ORDER BY pos, doc_id, crc, size) - 1 r FROM placed)
SELECT doc_id, size, CAST(crc AS BIGINT) text_crc32, 'rows' AS law, CAST(coalesce(s.shard, h.shard) AS INTEGER) shard,
       CAST(CASE WHEN r < take THEN h.base + r ELSE s.base + e + r - take - s.lo END AS BIGINT) slot, CAST(NULL AS INTEGER) grown_shard, CAST(h.shard AS INTEGER) home_shard
FROM ranks JOIN enter h USING (arc) LEFT JOIN steps s ON r >= take AND e + r - take >= s.lo AND e + r - take < s.hi
""")
def op13_consistent_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    placed = sharding.assign(rows, "doc_id", 40, ties=["doc_id", "text_crc32", "size"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "home_shard")


@query()
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpus_pipeline import run

    return run(spark, sf_dir)
