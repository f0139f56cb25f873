"""The corpus pipeline: all five stages on a small table with clashing columns, nulls, repeats and
copies, against plain Python over the texts that each stage is given."""

import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from stokehold.llm import simhash

HELPERS = ("_id", "_hash", "_row", "row_hash", "fp", "items", "_text", "n_words", "kept", "llr", "_c0", "shard")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage is given and what it returns."""
    folder = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").withColumns({c: F.lit(i) for i, c in enumerate(HELPERS)})
    again = docs.filter("doc_id % 50 = 0")  # repeated rows
    odd = docs.limit(4).withColumn("text", F.lit(None).cast("string")).withColumn("doc_id", F.col("doc_id") + 10_000_000)
    null_id = docs.filter("doc_id % 37 = 1").withColumn("doc_id", F.lit(None).cast("long"))
    docs = docs.unionByName(again).unionByName(odd).unionByName(null_id)
    docs.write.parquet(str(folder / "start"))
    held = [spark.read.parquet(str(folder / "start"))]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, held[-1], SF_SMALL).write.parquet(str(folder / name))
        held.append(spark.read.parquet(str(folder / name)))
    return held


def rows(frame):
    return [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]


def test_stages_keep_columns_and_only_drop_rows(stages):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "near_dedup", "decontamination", "best_fit_packing"]
    for before, after in zip(stages, stages[1:-1]):
        assert after.columns == before.columns
        assert not Counter(r[0] for r in rows(after)) - Counter(r[0] for r in rows(before))


def test_quality_rules_drop_what_the_base_rules_fail(stages):
    kept = Counter(rows(stages[1]))
    assert not kept - Counter(rows(stages[0]))
    for _, text in kept:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        c = Counter(zip(w, w[1:], w[2:]))
        again = {k + j for k, g in enumerate(zip(w, w[1:], w[2:])) if c[g] > 1 for j in range(3)}
        assert len(w) >= 50 and 100 * len(again) <= 50 * len(w)


def test_line_dedup_leaves_no_repeated_run_of_fifty_words(stages):
    before, after = stages[1], stages[2]
    assert Counter(i for i, _ in rows(after)) == Counter(i for i, _ in rows(before))
    seen = Counter()
    for _, text in set(rows(after)):  # repeated rows of one document are one place
        lines = [x for x in (text or "").split("\n") if x.split()]
        mine = set()
        for a in range(len(lines)):
            n, z = 0, a
            while z < len(lines) and n < 50:
                n += len(lines[z].split())
                z += 1
            if n >= 50:
                mine.add("\n".join(" ".join(x.split()) for x in lines[a:z]))
        seen.update(mine)
    assert not [k for k, n in seen.items() if n > 1]
    chars = [(r.n_chars, r.text) for r in after.collect()]
    assert all(n == len(t or "") for n, t in chars)


def test_near_dedup_keeps_one_of_each_group(stages):
    given, kept = rows(stages[2]), rows(stages[3])
    prints = [simhash.fingerprint(t.encode(), 3, 42) if t else 0 for _, t in given]
    group = list(range(len(given)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(given)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 2:
                group[root(i)] = root(j)
    members = {}
    for i, (d, t) in enumerate(given):
        members.setdefault(root(i), []).append((d is None, d))
    assert Counter((d is None, d) for d, _ in kept) == Counter(min(m, key=lambda x: (x[0], x[1] or 0)) for m in members.values())


def test_decontamination_drops_exactly_the_documents_with_a_window(spark, stages):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    windows = set()
    for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect():
        w = words(r.text)
        windows |= {tuple(w[i:i + min(10, len(w))]) for i in range(max(1, len(w) - 9)) if w}
    sizes = {len(w) for w in windows}
    clean = [x for x in rows(stages[3]) if not any(tuple(w[i:i + n]) in windows for w in [words(x[1])] for n in sizes for i in range(len(w) - n + 1))]
    assert Counter(rows(stages[4])) == Counter(clean)


def test_packing_holds_every_token(stages):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for i, text in rows(stages[4]):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 2048):
            part = ids[k:k + 2048]
            want[(i, k // 2048, k, len(part), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part)))] += 1
    got = stages[5].collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(places) <= 1.02 * -(-sum(n for (*_, n, _), k in want.items() for _ in range(k)) // 2048) + 1


def test_stages_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF_SMALL).count() == 0, name
