"""Quality rules, packing, decontamination, line and near-duplicates against brute force,
with nulls, empty and long texts, ties, repeats, clashing columns and empty tables."""

import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from stokehold.llm import decontam, linededup, packing, quality, simhash
from stokehold.llm.graph import components

VOCAB = public_tokenizers.path("word_bpe_49k.json")


def prose(seed, n, vocabulary=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


ODD = [None, "", " \n\t ", "one", "a b c a b c\n\na b c a b c", "X\x1cY é\x85z <|endoftext|> #$%", prose(5, 9000)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(10 + i, prose(i, 120) + "\n" + prose(i + 50, 60)) for i in range(20)]
    rows += [(40, prose(3, 120) + "\n" + prose(53, 60)), (10, prose(0, 120) + "\n" + prose(50, 60)), (None, prose(9, 80)), (None, None)]
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, _text string, n long")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, _text string, n long")


@pytest.fixture(scope="module")
def clashing(docs):
    """The same rows with extra columns named like helpers."""
    return docs.withColumns({c: F.lit(i) for i, c in enumerate(("_id", "_hash", "_row", "_copy", "row_hash", "fp", "_n", "_total", "items"))})


def text_rows(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


def test_quality_statistics_and_rows(spark, docs, empty):
    trusted = spark.createDataFrame([(i,) for i in range(10, 25)] + [(None,)], "doc_id long")
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                  for r in quality.score(docs, trusted).collect())
    want = Counter()
    for i, t in text_rows(docs):
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        c = Counter(zip(w, w[1:], w[2:]))
        held = {k + j for k, g in enumerate(zip(w, w[1:], w[2:])) if c[g] > 1 for j in range(3)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want[(i, len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in t), len(lines) - len(set(lines)), len(held),
              len(w) < 50 or 100 * len(held) > 50 * len(w))] += 1
    assert got == want
    kept = quality.keep_good(docs, trusted)
    assert kept.columns == docs.columns
    assert all(r.text is not None and len(r.text.split()) >= 50 for r in kept.collect())
    assert quality.score(empty, trusted).count() == 0 and quality.keep_good(empty, trusted).count() == 0
    none = quality.score(docs, trusted.limit(0)).filter("llr is not null")
    assert none.filter("llr != 0").count() == 0


def test_quality_ratio_is_the_hashed_multinomial_ratio(spark):
    rows = [(1, "a b a"), (2, "c d")]
    ratio = quality.log_ratios(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1,)], "doc_id long"), 64, 2.0)

    def bucket(*words):
        own = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
        h = own[0]
        if len(own) > 1:  # a pair is the hash of its words' hashes
            h = 42
            for x in own:
                h = xxhash.xxh64_intdigest(x.to_bytes(8, "little"), h)
        return (h - (1 << 64) if h >> 63 else h) % 64

    t, n = np.zeros(64), np.zeros(64)
    for i, text in rows:
        w = text.split()
        for b in [bucket(x) for x in w] + [bucket(x, y) for x, y in zip(w, w[1:])]:
            n[b] += 1
            t[b] += i == 1
    raw = (n + .5) / (n.sum() + 32)
    assert np.allclose(ratio, np.log((t + 128 * raw) / (t.sum() + 128) / raw))


def test_quality_tells_junk_from_prose(spark):
    from conftest import SF_MEDIUM
    docs, labels = (spark.read.parquet(f"{SF_MEDIUM}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.score(docs, labels.filter("quality = 1 and toxic = 0")).join(labels, "doc_id").filter("not base_failed")
    r = {x.quality: x.k for x in got.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k")).collect()}
    assert r[1] > 0.97 and r[0] < 0.4


def test_quality_drops_toxic_text_and_keeps_unlabelled_clean_text(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet").repartition(8) for t in ("documents", "labels"))
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 0
    got = quality.score(docs, labels.filter("quality = 1 and toxic = 0").filter(~held)).join(labels, "doc_id").filter("not base_failed")
    rate = F.avg(F.col("kept").cast("int")).alias("k")
    toxic = got.filter("quality = 1 and toxic = 1").agg(rate).first().k  # no label of theirs is ever read
    clean = got.filter("quality = 1 and toxic = 0").filter(held).agg(rate).first().k
    junk = got.filter("quality = 0").agg(rate).first().k
    print("kept:", toxic, clean, junk)
    assert toxic < 0.65 and clean > 0.97 and junk < 0.05


def test_packing_round_trip_and_places(spark, docs, empty):
    from tokenizers import Tokenizer
    coder = Tokenizer.from_file(VOCAB)
    pieces = packing.tokenize(docs, VOCAB, 256).cache()
    placed = packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), 256).toPandas()
    total = 0
    for i, t in text_rows(docs):
        ids = coder.encode(t or "", add_special_tokens=False).ids + [0]
        total += len(ids)
        if i is not None and i not in (10,):
            own = pieces.filter(F.col("doc_id") == i).orderBy("piece").collect()
            assert [x for r in own for x in np.frombuffer(r.ids, "<u4").tolist()] == ids
            assert all(r.length == 256 for r in own[:-1]) and [r.start for r in own] == [256 * k for k in range(len(own))]
    assert placed.length.sum() == total
    ordered = placed.sort_values(["sequence_id", "offset"])
    assert (ordered.groupby("sequence_id").length.cumsum() - ordered.length == ordered.offset).all()
    assert ordered.groupby("sequence_id").length.sum().max() <= 256
    # no two pieces over half the capacity share a sequence
    assert placed.sequence_id.nunique() <= max(-(-total // 256), (placed.length > 128).sum()) + 1
    assert packing.pack(packing.tokenize(empty, VOCAB).drop("ids")).count() == 0


def test_bin_completion_is_optimal_on_small_sets():
    def least(items, capacity):
        items, best = sorted(items, reverse=True), len(items)

        def go(k, bins):
            nonlocal best
            if len(bins) >= best:
                return
            if k == len(items):
                best = len(bins)
                return
            for i in {b: j for j, b in enumerate(bins)}.values():
                if bins[i] >= items[k]:
                    go(k + 1, bins[:i] + [bins[i] - items[k]] + bins[i + 1:])
            go(k + 1, bins + [capacity - items[k]])

        go(0, [])
        return best

    r = random.Random(1)
    for _ in range(60):
        items = [r.randint(1, 30) for _ in range(r.randint(1, 9))]
        found = packing.bin_completion(dict(Counter(items)), 30)
        used = Counter()
        for pattern, n in found:
            assert sum(pattern) <= 30
            for x in pattern:
                used[x] += n
        assert used == Counter(items) and sum(n for _, n in found) == least(items, 30)


def test_decontamination_against_brute_force(spark, docs, empty):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = lambda t: re.findall(decontam.WORD_PATTERN, (t or "").translate(low))
    long = prose(5, 9000).split()
    items = [(1, " ".join(long[100:140]).upper()), (2, "A, b; C"), (3, None), (4, "!!"), (5, " ".join(long[120:160])), (6, prose(77, 30)), (5, "a b c")]
    bench = spark.createDataFrame([(i, t, "c") for i, t in items], "item_id long, text string, doc_id string")
    windows = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[k:k + 10]), set()).add(str(i))
    want = Counter()
    for i, t in text_rows(docs):
        w, hit, found = words(t), set(), set()
        for k in range(len(w)):
            for n in range(1, 11):
                g = tuple(w[k:k + n])
                if len(g) == n and g in windows:
                    hit.update(range(k, k + n))
                    found |= windows[g]
        want[(i, len(w), len(hit), tuple(sorted(found)))] += 1
    for block in (2_000_000, 20):
        got = decontam.decontaminate(docs, bench, block_words=block)
        assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(sorted(r["items"]))) for r in got.collect()) == want
    clean = decontam.keep_clean(docs, bench)
    assert clean.columns == docs.columns and clean.count() == sum(n for k, n in want.items() if not k[2])
    assert decontam.decontaminate(empty, bench).count() == 0
    assert decontam.decontaminate(docs, bench.limit(0)).filter("n_hit > 0").count() == 0


def test_proximity_matches(spark):
    docs = spark.createDataFrame([(1, "x a q b z c"), (2, "c b a"), (3, "a b k k k k k k k c"), (4, "a b")], "doc_id long, text string")
    bench = spark.createDataFrame([(9, "a b c")], "item_id long, text string")
    got = {r.doc_id: (list(r["items"]), list(r.near)) for r in decontam.decontaminate(docs, bench, slop=2).collect()}
    assert got == {1: ([], ["9"]), 2: ([], ["9"]), 3: ([], []), 4: ([], [])}


def test_line_dedup_deletes_later_runs_only(spark, empty):
    a, b, c, short = prose(1, 60), prose(2, 30), prose(3, 30), prose(4, 8)
    rows = [(1, f"{short}\n{a}\nend one"), (2, f"{short}\n\n{a}\nend two"), (3, f"{b}\n{c}\nmore"), (4, f"x\n{b}\n{c}"), (5, f"{a}\nmid\n{a}"),
            (6, short), (None, a), (7, None), (8, ""), (1, f"{short}\n{a}\nend one")]
    docs = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, _runs string")
    out = linededup.drop_repeats(docs, removed="gone")
    got = sorted(((r.doc_id, r.text, r.gone) for r in out.collect()), key=str)
    want = [(1, f"{short}\n{a}\nend one", 0)] * 2 + [(2, "end two", 2), (3, f"{b}\n{c}\nmore", 0), (4, "x", 2), (5, "mid", 2), (6, short, 0), (None, "", 1),
                                                     (7, None, 0), (8, "", 0)]
    assert got == sorted(want, key=str)
    assert out.columns == [*docs.columns, "gone"]
    assert linededup.drop_repeats(empty).count() == 0


def test_line_dedup_deletes_all_lines_of_repeated_windows(spark):
    # every line that stands in a window of 50 words which an earlier place has goes, whatever the leader of its gram looks like
    r = random.Random(7)
    pool = [prose(200 + i, r.choice([3, 12, 15, 15, 26])) for i in range(40)]
    parts = [prose(100 + i, 15) for i in range(4)]
    rows = [(0, [parts[1], parts[2]]), (1, parts), (2, parts)]
    for i in range(3, 60):
        at = r.randrange(30)
        rows.append((i, [f"own {i} {r.random()}", *pool[at:at + r.randint(3, 10)], f"end {i}", *pool[(at + 13) % 30:][:r.randint(0, 6)]]))
    texts = spark.createDataFrame([(i, "\n".join(x)) for i, x in rows], "doc_id long, text string")
    runs = {x.doc_id: {k for s in x.runs for k in range(s["start"], s["stop"])} for x in linededup.repeated_runs(texts).collect()}
    seen, lines = set(), set()
    for i, x in rows:
        want = set()
        for a in range(len(x)):
            z = next((z for z in range(a, len(x) + 1) if sum(len(y.split()) for y in x[a:z]) >= 50), None)
            if z:
                if tuple(x[a:z]) in seen:
                    want |= set(range(a, z))
                seen.add(tuple(x[a:z]))
        got = runs.get(i, set())
        assert want <= got, (i, sorted(want - got))
        for k, y in enumerate(x):
            assert k not in got or y in lines
            lines.add(y)


def test_winnowing_selects_the_same_gram_inside_a_shared_window():
    r = random.Random(2)
    for _ in range(50):
        shared = [r.randbytes(8) for _ in range(12)]
        size = np.array([r.randint(3, 12) for _ in shared])
        picks = []
        for k in (2, 5):
            raw = [r.randbytes(8) for _ in range(k)] + shared + [r.randbytes(8) for _ in range(k)]
            words = np.concatenate([np.full(k, 9), size, np.full(k, 9)])
            picks.append({g for i, e, g in linededup.winnow(raw, words, 20, 40) if i >= k and e <= k + len(shared)})
        assert size.sum() < 40 or picks[0] & picks[1]


def brute_components(points, near):
    parent = list(range(len(points)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(points)):
        for j in range(i):
            if near(points[i], points[j]):
                a, b = find(i), find(j)
                parent[a] = b
    groups = {}
    for i in range(len(points)):
        groups.setdefault(find(i), []).append(points[i])
    return {frozenset(g) for g in groups.values()}


def test_covering_links_find_every_pair(spark):
    r = random.Random(3)
    base = r.getrandbits(64)
    points = {0, base}
    for _ in range(40):
        x = r.choice(sorted(points)) if r.random() < 0.7 else r.getrandbits(64)
        for b in r.sample(range(64), r.randint(1, 3)):
            x ^= 1 << b
        points.add(x)
    for _ in range(60):  # a crowded bucket
        points.add(base ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)))
    points = sorted(points)
    for i in points:
        for j in points:
            if 0 < (i ^ j).bit_count() <= 2:
                assert any(i & m == j & m for m in simhash.covering_masks(2))
    frame = spark.createDataFrame([(simhash.signed(x),) for x in points], "fp long")
    links = simhash.links(frame)
    assert all(((x.src ^ x.dst) & (1 << 64) - 1).bit_count() <= 2 for x in links.collect())
    root = {x.node: x.root for x in components(links).collect()}
    got = {}
    for x in points:
        got.setdefault(root.get(simhash.signed(x), simhash.signed(x)), set()).add(x)
    assert {frozenset(g) for g in got.values()} == brute_components(points, lambda a, b: (a ^ b).bit_count() <= 2)


def test_fingerprints_and_groups(spark, docs, empty):
    def brute(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        if not w:
            return 0
        h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    got = simhash.near_duplicates(docs).collect()
    want = [(i, brute(t)) for i, t in text_rows(docs)]
    assert Counter((r.doc_id, r.fp & (1 << 64) - 1) for r in got) == Counter(want)
    groups = brute_components(list({f for _, f in want}), lambda a, b: (a ^ b).bit_count() <= 2)
    least = {f: min((i for i, g in want if g in s and i is not None), default=None) for s in groups for f in s}
    assert all(r.component_id == least[r.fp & (1 << 64) - 1] for r in got)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0


def test_components_of_long_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 130)] + [(1, k) for k in range(2, 50)] + [(300, 300), (401, 400)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {**{i: 100 for i in range(100, 131)}, **{k: 1 for k in range(1, 50)}, 400: 400, 401: 400}
    assert components(spark.createDataFrame([], "src long, dst long")).count() == 0
