"""Vector codes, tokenizer alignment and consistent-hash shards against brute force,
with nulls, empty and long inputs, ties, repeats, clashing columns, hot keys and empty tables."""

import hashlib
import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stokehold.llm import sharding, spillcount, vectorcode

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# ------------------------------------------------------------------ vector codes

def lloyd(vectors, parts, entries, rounds, scale):
    """Integer product codes the plain way: (codes, errors, codebooks)."""
    ints = [[int(np.floor(scale * x)) for x in v] for v in vectors]
    width = -(-max(map(len, ints), default=0) // parts)
    ints = [v + [0] * (width * parts - len(v)) for v in ints]
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for v in ints]
    books = [[list(v[p]) for v in cut[:entries]] for p in range(parts)]
    far = lambda x, y: sum((a - b) ** 2 for a, b in zip(x, y))
    near = lambda x, book: min(range(len(book)), key=lambda e: (far(x, book[e]), e))
    for _ in range(rounds):
        for p in range(parts):
            held = defaultdict(list)
            for v in cut:
                held[near(v[p], books[p])].append(v[p])
            for e, xs in held.items():
                books[p][e] = [sum(c) // len(xs) for c in zip(*xs)]
    codes = [[near(v[p], books[p]) for p in range(parts)] for v in cut]
    return codes, [sum(far(v[p], books[p][c[p]]) for p in range(parts)) for v, c in zip(cut, codes)], books


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, _v string, code string")


def test_vector_codes_match_plain_rounds(spark):
    r = random.Random(7)
    near = [[r.choice([-.5, 0, .25, .5]) + r.choice([0, 0, .001]) for _ in range(24)] for _ in range(150)]
    odd = [None, [.1, None, .2], [float("nan")] * 24, [float("inf")] + [0.] * 23, [], [.3] * 5, near[3], near[3], [1e30] * 24, [-9000.] * 24]
    rows = [(i, v, i % 3, "x", "y") for i, v in enumerate(near)] + [(1000 + i, v, None, None, "") for i, v in enumerate(odd)]
    rows += [(5, near[9], None, "x", "y"), (None, near[8], 1, "x", "y")]
    frame = vectors(spark, [(i, None if v is None else [None if x is None else float(x) for x in v], *r) for i, v, *r in rows]).repartition(7)
    coded, books = vectorcode.compress(frame, "vec_id", "embedding", 8, 16, 6, 4096, keep=["label"])
    got = Counter((x.vec_id, tuple(x.code), x.error) for x in coded.collect())
    fine = [(i, v) for i, v, *_ in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    f32 = [(i, [float(max(-8192, min(8192, np.float32(x)))) for x in v]) for i, v in fine]
    f32.sort(key=lambda x: (x[0] is None, x[0] or 0, [int(np.floor(4096 * y)) for y in x[1]]))
    codes, errors, want_books = lloyd([v for _, v in f32], 8, 16, 6, 4096)
    assert books.tolist() == want_books
    assert got == Counter((i, tuple(c), e) for (i, _), c, e in zip(f32, codes, errors))


@pytest.mark.parametrize("rows", [[], [(1, None, 1, "", "")], [(1, [], 1, "", ""), (2, [], None, "", "")], [(1, [.5] * 8, 1, "", "")] * 3])
def test_vector_codes_small_tables(spark, rows):
    coded, books = vectorcode.compress(vectors(spark, rows), "vec_id", "embedding")
    fine = [v for _, v, *_ in rows if v is not None]
    assert sorted(x.error for x in coded.collect()) == [0] * len(fine)
    assert books.shape[1] == len(fine)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(-3, 3), min_size=4, max_size=4), min_size=1, max_size=60), st.integers(1, 5))
def test_trie_walk_equals_all_distances(rows, size):
    leaves, counts, place = vectorcode.distinct(np.array(rows, np.int32))
    assert [tuple(x) for x in leaves.tolist()] == sorted(set(map(tuple, rows))) and counts.sum() == len(rows)
    assert (leaves[place] == np.array(rows)).all()
    book = np.array([[0, 1, 2, 3], [-1, 0, 0, 2], [3, 3, 3, 3]])
    walked = list(vectorcode.walk(leaves, book, size))
    assert [lo for lo, _, _ in walked] == sorted(lo for lo, _, _ in walked)  # depth first: leaves in their order
    assert (np.concatenate([d for _, _, d in walked]) == ((leaves[:, None, :] - book) ** 2).sum(axis=2)).all()


# ------------------------------------------------------------------ tokenizer alignment

@pytest.fixture(scope="module")
def both():
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B_PATH)


def plain_alignment(both, texts):
    """The contract, token by token and pair by pair."""
    a, b = both
    chars = spillcount._plain_bytes()
    out, held, docs = [], [], defaultdict(set)
    for d, text in enumerate(texts):
        row = dict(n_a=0, n_b=0, n_groups=0, n_links=0, n_best=0, count_sum=0, groups_sha256="")
        out.append(row)
        held.append([])
        if not text:
            continue
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        bytes_a = [bytes(chars[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, b.id_to_piece(i)) for i in ids_b)]
        if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            continue
        ends_a, ends_b = (list(itertools.accumulate(map(len, x))) for x in (bytes_a, bytes_b))
        groups, ga, gb = [], [], []
        i = j = 0
        for end in sorted(set(ends_a) & set(ends_b)):
            ga, gb = [], []
            while i < len(ids_a) and ends_a[i] <= end:
                ga.append(ids_a[i])
                i += 1
            while j < len(ids_b) and ends_b[j] <= end:
                gb.append(ids_b[j])
                j += 1
            groups.append((ga, gb))
        links = [(x, y) for g, h in groups for x in g for y in h]
        held[-1] = links
        for pair in set(links):
            docs[pair].add(d)
        text_ = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        row |= dict(n_a=len(ids_a), n_b=len(ids_b), n_groups=len(groups), n_links=len(links), groups_sha256=hashlib.sha256(text_.encode()).hexdigest())
    most = Counter()
    for (x, _), ds in docs.items():
        most[x] = max(most[x], len(ds))
    for row, links in zip(out, held):
        row["n_best"] = sum(len(docs[p]) == most[p[0]] for p in links)
        row["count_sum"] = sum(len(docs[p]) for p in links)
    return out


TEXTS = ["", None, " ", "one", "the the the", " two  spaces", "tab\there\n\nlines \r\n", "<|endoftext|> </s> <s> <unk> [INST]", "▁ lower block", "é́ 日本語テキスト 🙂🙂", "a" * 3000,
         "x\x00y\x1f\x85", " " * 40 + "z", "don't I'LL 12345 3.14", "the the the", "ab" * 1500 + " " + "ö" * 700]


@pytest.mark.parametrize("group_bytes, fan, text_bytes, listed", [(24 << 20, 16, 4 << 20, 1024), (40, 2, 200, 1)])
def test_alignment_matches_plain_counting(spark, both, monkeypatch, group_bytes, fan, text_bytes, listed):
    r = random.Random(3)
    words = ["the", "cat", "Zürich", "naïve", "token", "izers", "日本", "e-mail", "ß", "WORD", "under_score", "1999"]
    texts = TEXTS + [" ".join(r.choice(words) for _ in range(r.randrange(1, 60))) for _ in range(60)]
    rows = [(i if i % 9 else None, t, "x", 1, "y") for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, _id string, slice int, radix string").repartition(5)
    if fan != 16:
        monkeypatch.setattr(spillcount, "FAN", fan)
        # small slices in the workers: the closure carries the module's values only as defaults, so cut the batches instead
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = Counter((x.doc_id, x.n_a, x.n_b, x.n_groups, x.n_links, x.n_best, x.count_sum, x.groups_sha256)
                      for x in spillcount.align(frame, A_PATH, B_PATH, public_tokenizers.PATTERN, group_bytes=group_bytes).collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = Counter((i, *x.values()) for (i, *_), x in zip(rows, [
        {k: w[k] for k in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")} for w in plain_alignment(both, texts)]))
    assert got == want


def test_alignment_of_an_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id string, text string")
    assert spillcount.align(frame, A_PATH, B_PATH).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=80))
def test_both_encoders_of_side_a_agree(text):
    a = spillcount.sides(A_PATH, B_PATH, public_tokenizers.PATTERN)[0]
    assert a.encode(text).tolist() == a.slow.encode(" " + text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from(" \n\t\xa0\u3000'a1.,▁é日"), st.characters(exclude_categories=["Cs"])), max_size=6), max_size=12).map(" ".join))
def test_segments_are_encoded_as_in_the_whole_text(text):
    a, b, _ = spillcount.sides(A_PATH, B_PATH, public_tokenizers.PATTERN)
    parts = spillcount.segments(text)
    assert " ".join(parts) == text
    for side in (a, b):
        whole = side.encode(text)
        if side.pieces.joined(whole).tobytes() == b" " + text.encode():
            ids, counts = spillcount.encoded(side, parts, np.array([len(p.encode()) + 1 for p in parts]),
                                            np.array([spillcount.bare(p) for p in parts]))
            assert ids.tolist() == whole.tolist() and counts.sum() == len(ids)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 5), min_size=1, max_size=6), st.lists(st.integers(0, 5), min_size=1, max_size=6), st.integers(0, 3)), min_size=1, max_size=12),
       st.sampled_from([1, 4, 1000]))
def test_links_of_groups(groups, listed):
    groups = sorted(groups, key=lambda g: g[2])
    a, b = (np.array([x for g in groups for x in g[k]]) for k in (0, 1))
    ga, gb = (np.repeat(np.arange(len(groups)), [len(g[k]) for g in groups]) for k in (0, 1))
    key, doc, n = spillcount.links(a, b, ga, gb, np.array([g[2] for g in groups]), 4, listed)
    want = Counter((x << spillcount.SHIFT | y, g[2]) for g in groups for x in g[0] for y in g[1])
    assert list(zip(key.tolist(), doc.tolist())) == sorted(want) and Counter(dict(zip(zip(key.tolist(), doc.tolist()), n.tolist()))) == want


# ------------------------------------------------------------------ shards

def plain_ring(keys, shards, slack=0.0):
    """Row by row: homes first in ring order, then the overflow clockwise, first come first served."""
    places = sharding.ring(shards)
    at = lambda k: int(hashlib.md5(("\0null" if k is None else str(k)).encode()).hexdigest()[:sharding.DIGITS], 16)
    most, used = sharding.bounds(len(keys), shards, slack), [0] * shards
    owners = [s for _, s in places] + [places[0][1]]
    arcs = defaultdict(list)
    for i, k in enumerate(keys):
        arcs[sum(p < at(k) for p, _ in places)].append(((at(k), i)))
    out, left = {}, {}
    for arc in range(len(owners)):
        for pos, i in sorted(arcs[arc]):
            s = owners[arc]
            if used[s] < most[s]:
                out[i] = (s, used[s])
                used[s] += 1
            else:
                left.setdefault(arc, []).append(i)
    queue = []
    for step in range(2 * len(owners)):
        arc = step % len(owners)
        if step < len(owners):
            queue += left.get(arc, [])
        while queue and used[owners[arc]] < most[owners[arc]]:
            out[queue.pop(0)] = (owners[arc], used[owners[arc]])
            used[owners[arc]] += 1
    return out


@pytest.mark.parametrize("slack", [0.0, 0.25])
def test_shards_match_row_by_row_walk(spark, slack):
    keys = [*range(300), *[7] * 200, None, None, "x"]
    rows = [(None if k is None else str(k), i, "a", 0) for i, k in enumerate(keys)]
    frame = spark.createDataFrame(rows, "doc_id string, n long, _pos string, _row int").repartition(6)
    got = sharding.assign(frame, "doc_id", 7, slack=slack, ties=["n"])
    assert got.columns == [*frame.columns, "shard", "slot", "home_shard"]
    assert {r.n: (r.shard, r.slot) for r in got.collect()} == plain_ring([r[0] for r in rows], 7, slack)


def test_shards_balance_and_move_little(spark):
    frame = spark.range(5000).withColumn("key", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")))
    before, after = (sharding.assign(frame, "key", s, ties=["id"]) for s in (16, 17))
    sizes = [r["count"] for r in before.groupBy("shard").count().collect()]
    assert len(sizes) == 16 and max(sizes) - min(sizes) <= 1
    slots = before.groupBy("shard").agg(F.min("slot").alias("a"), F.max("slot").alias("z"), F.count_distinct("slot").alias("d"), F.count("*").alias("n")).collect()
    assert all(r.a == 0 and r.z == r.n - 1 == r.d - 1 for r in slots)
    loose = [sharding.assign(spark.range(5000), "id", s, slack=.3, ties=["id"]).select("id", F.col("shard").alias(f"s{s}")) for s in (16, 17)]
    moved = loose[0].join(loose[1], "id").filter("s16 <> s17").count()
    assert moved < 5000 * 2.5 / 17  # the new shard's share, and what overflows


def test_shards_of_small_tables(spark):
    frame = spark.createDataFrame([], "doc_id long")
    assert sharding.assign(frame, "doc_id", 40).collect() == []
    three = sharding.assign(spark.range(3), "id", 40).collect()
    assert sorted(r.slot for r in three) == [0, 0, 0]
    with pytest.raises(ValueError):
        sharding.assign(spark.range(3).withColumn("Slot", F.lit(1)), "id", 4)
