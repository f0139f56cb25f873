"""Cross-tokenizer alignment with external spill counting.

Two tokenizers cut the same bytes. Where a token of each side ends at one
offset, a group ends; every token of a group is linked with every token of the
other side in it. A pair of ids is counted once for each document that holds it
linked, over the whole corpus, and each document gets back how often its
links are the commonest of their side-A id, and the sum of their counts.

* **Segments.** Neither tokenizer has a token across a single space between two words, so texts are cut
  there; each distinct segment of a slice is encoded and aligned once, and texts are sums over their segments.
* **Runs.** A task turns a slice of texts into (pair, document, links) records,
  sorts them by (a, b, document) and writes them, radix-partitioned by the
  side-A id, as zstd runs: one row a radix and slice, the pairs with their document counts
  apart from the documents. One row a document keeps its own figures.
* **Counting.** The runs of a radix are dealt into merge groups of bounded
  bytes, so a radix with a hot id only has more groups. Each group merges the pair
  columns of its runs with a heap, side-major; a second heap merge of the groups' partial counts yields
  the totals of each id in turn, and with its last pair its maximum.
* **Streaming back.** The totals go to every group of their radix; a group walks its runs' pairs
  beside them and sends, for each document of a run, the sums of its links.

Memory is bounded by a group's bytes, a slice's bytes (one text at least) and ``FAN`` times the distinct pairs of one radix, which
the vocabularies bound; the records of a hot id or pair are never in one task whole. Partial counts of many groups meet in rounds of ``FAN``. Everything dealt is written to the shared folder first, so a lost executor repeats tasks, not the job.

Texts that are null, empty or not valid UTF-8, or whose joined token bytes on either side differ from space + text, have no tokens: zeros and an
empty string. Repeated rows and repeated or null ids are documents of their own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .common import blobs, prepare, ragged, slices, written

#: Side-A ids are dealt by their remainder.
RADIX = 64
#: Compressed bytes of the runs of one merge group.
GROUP_BYTES = 24 << 20
#: Bytes of text turned into records at once.
TEXT_BYTES = 4 << 20
#: Pairs of a group that are listed at once; a longer group is reduced to its distinct ids first.
LISTED = 1024
#: Rows of totals in one message.
CHUNK = 1 << 16
#: Partial counts merged at once, in groups.
FAN = 16
#: Bits of a side-B id in a pair.
SHIFT = 20

FIGURES = ["n_a", "n_b", "n_groups", "n_links"]


# ------------------------------------------------------------------ tokens

def _plain_bytes() -> dict[str, int]:
    """Characters of the byte-level alphabet: printable Latin-1 stands for itself, the other bytes follow from U+0100."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pieces:
    """The bytes of every id, end to end."""

    def __init__(self, pieces: list[bytes]):
        self.sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(pieces), np.uint8)

    def __len__(self) -> int:
        return len(self.sizes)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of a list of ids."""
        sizes = self.sizes[ids]
        return self.flat[np.repeat(self.starts[ids] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))]


class ByteSide:
    """Side A: a byte-level vocabulary file. ``path`` is the JSON; the merge ranks
    beside it under the suffix .tiktoken, if there, encode the same ids faster."""

    def __init__(self, path: str, pattern: str | None = None):
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.slow.encode_special_tokens = True
        plain = _plain_bytes()
        vocabulary = self.slow.get_vocab(with_added_tokens=True)
        pieces = [b""] * (max(vocabulary.values()) + 1)
        special = {t.content for t in self.slow.get_added_tokens_decoder().values()}
        for piece, i in vocabulary.items():
            pieces[i] = piece.encode() if piece in special else bytes(plain[c] for c in piece)
        self.pieces = Pieces(pieces)
        self.fast = None
        if pattern:
            ranks = {p: i for i, p in enumerate(pieces) if p and i not in self.slow.get_added_tokens_decoder()}
            self.fast = tiktoken.Encoding("side a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        """Ids of a space and ``text``."""
        if self.fast:
            try:
                return self.fast.encode_to_numpy(" " + text).astype(np.int64)
            except BaseException as e:  # the pattern engine gives up on very long runs of white space
                if isinstance(e, (KeyboardInterrupt, SystemExit, MemoryError)):
                    raise
        return np.array(self.slow.encode(" " + text, add_special_tokens=False).ids, np.int64)


class PieceSide:
    """Side B: a sentencepiece model, which adds the space itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        #: No piece goes on after a word's end: words can be encoded one by one.
        self.by_word = not any("▁" in self.model.id_to_piece(i).lstrip("▁") for i in range(self.model.get_piece_size()))
        n = self.model.get_piece_size()
        pieces = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
                  for i, p in ((i, self.model.id_to_piece(i)) for i in range(n))]
        self.pieces = Pieces(pieces)

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text, num_threads=1), np.int64)


@lru_cache(maxsize=2)
def sides(path_a: str, path_b: str, pattern: str | None) -> tuple[ByteSide, PieceSide, list[bytes]]:
    """Both sides, and every id's decimal with each of the ends `,` `|` `;` (see ``listing``)."""
    a, b = ByteSide(path_a, pattern), PieceSide(path_b)
    plain = [b"%d" % i for side in (a, b) for i in range(len(side.pieces))]
    return a, b, [p + end for end in (b",", b"|", b";") for p in plain]


# ------------------------------------------------------------------ links of a slice

def cut(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group of each token, for two rising lists of ends that share their last one."""
    held = np.zeros(int(ends_a[-1]) + 1, np.uint8)
    held[ends_a] = 1
    held[ends_b] |= 2
    shared = held == 3
    before = np.cumsum(shared) - shared
    return before[ends_a], before[ends_b]


def listing(a: np.ndarray, b: np.ndarray, ga: np.ndarray, gb: np.ndarray, groups: int, names: list[bytes], base: int) -> list[bytes]:
    """Pieces of text, in order, of `a1,a2|b1;a3|b2,b3;`. ``names`` has every id of
    both sides (those of b from ``base``) ended by `,`, then by `|`, then by `;`."""
    na, nb = np.bincount(ga, minlength=groups), np.bincount(gb, minlength=groups)
    before_a, before_b = np.cumsum(na) - na, np.cumsum(nb) - nb
    ids = np.empty(len(a) + len(b), np.int64)
    last = len(names) // 3
    ids[np.arange(len(a)) + before_b[ga]] = a
    ids[np.arange(len(b)) + (before_a + na)[gb]] = b + base
    ids[before_a + na + before_b - 1] += last
    ids[before_a + na + before_b + nb - 1] += 2 * last
    return [names[i] for i in ids.tolist()]


def links(a: np.ndarray, b: np.ndarray, ga: np.ndarray, gb: np.ndarray, doc: np.ndarray, docs: int, listed: int = LISTED):
    """(pair, document, links) of all groups: pair is a << SHIFT | b, one row each
    distinct (pair, document), sorted. ``doc`` (below ``docs``) is by group."""
    groups = len(doc)
    na, nb = np.bincount(ga, minlength=groups), np.bincount(gb, minlength=groups)
    small = na * nb <= listed
    keys, owner, times = [], [], []
    at_a, at_b = np.cumsum(na) - na, np.cumsum(nb) - nb
    # each token of a meets all of b of its group
    mine = np.flatnonzero(small[ga])
    many = nb[ga[mine]]
    keys.append(np.repeat(a[mine], many) << SHIFT | b[np.repeat(at_b[ga[mine]], many) + ragged(many)])
    owner.append(np.repeat(doc[ga[mine]], many))
    times.append(np.ones(len(keys[0]), np.int64))
    for g in np.flatnonzero(~small):
        ia, ka = np.unique(a[at_a[g]:at_a[g] + na[g]], return_counts=True)
        ib, kb = np.unique(b[at_b[g]:at_b[g] + nb[g]], return_counts=True)
        keys.append((ia[:, None] << SHIFT | ib).ravel())
        owner.append(np.full(len(keys[-1]), doc[g]))
        times.append((ka[:, None] * kb).ravel())
    bits = max(1, docs.bit_length())
    record = np.concatenate(keys) << bits | np.concatenate(owner)
    if len(keys) == 1:
        record.sort()
        start = np.flatnonzero(np.append(True, record[1:] != record[:-1]))
        n = np.diff(np.append(start, len(record)))
    else:
        order = np.argsort(record, kind="stable")
        record = record[order]
        start = np.flatnonzero(np.append(True, record[1:] != record[:-1]))
        n = np.add.reduceat(np.concatenate(times)[order], start)
    record = record[start]
    return record >> bits, record & ((1 << bits) - 1), n


_BETWEEN = re.compile(r"(?<=\S) (?=\S)")


def segments(text: str) -> list[str]:
    """``text`` cut at the single spaces between two other characters that are no white space."""
    return _BETWEEN.split(text)


def bare(part: str) -> bool:
    """No white space at either end, and not empty: a text of such parts between spaces is cut at each space."""
    return bool(part) and part.strip() == part


class _Numbers(dict):
    """Strings numbered as they come."""

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        return n

    def of(self, parts: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, parts), np.int64, len(parts))


#: Segments encoded at one call.
TOGETHER = 2048


def encoded(side: ByteSide | PieceSide, parts: list[str], sizes: np.ndarray, plain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all segments (``sizes`` bytes with their space) and how many each has. ``plain`` (bare) segments
    are encoded in one text, where both sides part them; if the bytes don't fall in place, one by one."""
    ids, counts = [], []
    cuts = np.flatnonzero(np.diff(plain.astype(np.int8), prepend=-1))
    for lo, to in zip(cuts.tolist(), [*cuts[1:].tolist(), len(parts)]):
        for at in range(lo, to, TOGETHER):
            end = min(to, at + TOGETHER)
            if plain[at] and end - at > 1:
                found = side.encode(" ".join(parts[at:end]))
                ends, want = np.cumsum(side.pieces.sizes[found]), np.cumsum(sizes[at:end])
                last = np.searchsorted(ends, want)
                if len(ends) and ends[-1] == want[-1] and (ends[last] == want).all():
                    ids.append(found)
                    counts.append(np.diff(last, prepend=-1))
                    continue
            each = [side.encode(p) for p in parts[at:end]]
            ids += each
            counts.append(np.fromiter(map(len, each), np.int64, len(each)))
    none = np.zeros(0, np.int64)
    return np.concatenate(ids) if ids else none, np.concatenate(counts) if counts else none


class _Aligned:
    """Segments encoded by both sides and aligned: their figures, listings and links."""

    def __init__(self, parts: list[str], side_a: ByteSide, side_b: PieceSide, names: list[bytes]):
        want = [b" " + p.encode() for p in parts]
        size = np.fromiter(map(len, want), np.int64, len(want))
        plain = np.fromiter(map(bare, parts), bool, len(parts))
        (a, len_a), (b, len_b) = (encoded(side, parts, size, plain) for side in (side_a, side_b))
        self.fits = np.ones(len(parts), bool)
        flat = np.frombuffer(b"".join(want), np.uint8)
        for side, ids, lengths in ((side_a, a, len_a), (side_b, b, len_b)):
            ends = np.append(0, np.cumsum(side.pieces.sizes[ids]))
            bytes_of = np.diff(ends[np.append(0, np.cumsum(lengths))])
            self.fits &= bytes_of == size
            if (bytes_of == size).all():
                wrong = np.flatnonzero(side.pieces.joined(ids) != flat)
                self.fits[np.searchsorted(np.cumsum(size), wrong, "right")] = False
            else:  # lengths differ somewhere: one by one
                at = np.append(0, np.cumsum(lengths))
                for i in np.flatnonzero(self.fits):
                    self.fits[i] = side.pieces.joined(ids[at[i]:at[i + 1]]).tobytes() == want[i]
        keep_a, keep_b = np.repeat(self.fits, len_a), np.repeat(self.fits, len_b)
        a, b = a[keep_a], b[keep_b]
        self.n_a, self.n_b = np.where(self.fits, len_a, 0), np.where(self.fits, len_b, 0)
        self.n_groups, self.n_links = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        self.names = [b""] * len(parts)
        self.key, self.times, self.first = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(parts) + 1, np.int64)
        if not len(a):
            return
        ga, gb = cut(np.cumsum(side_a.pieces.sizes[a]), np.cumsum(side_b.pieces.sizes[b]))
        groups = int(ga[-1]) + 1
        na, nb = np.bincount(ga, minlength=groups), np.bincount(gb, minlength=groups)
        of = np.repeat(np.arange(len(parts)), self.n_a)
        part = np.zeros(groups, np.int64)
        part[ga] = of  # segment of each group
        self.n_groups = np.bincount(part, minlength=len(parts))
        np.add.at(self.n_links, part, na * nb)
        words, at = listing(a, b, ga, gb, groups, names, len(side_a.pieces)), 0
        for i, n in enumerate((self.n_a + self.n_b).tolist()):
            self.names[i] = b"".join(words[at:at + n])
            at += n
        key, at_part, times = links(a, b, ga, gb, part, len(parts))
        order = np.argsort(at_part, kind="stable")
        self.key, self.times = key[order], times[order]
        self.first = np.append(0, np.cumsum(np.bincount(at_part, minlength=len(parts))))

    def of(self, parts: list[np.ndarray], docs: np.ndarray, rows: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Writes the figures of the documents ``docs`` (their segments in ``parts``)
        into ``rows``; returns their sorted (pair, document, links)."""
        none = np.zeros(0, np.int64)
        if not parts:
            return none, none, none
        for p, d in zip(parts, docs.tolist()):
            digest = hashlib.sha256(b"".join(map(self.names.__getitem__, p.tolist()))[:-1]).hexdigest()
            rows[d] |= {"groups_sha256": digest, **{f: int(getattr(self, f)[p].sum()) for f in FIGURES}}
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        # each distinct segment of a document once, with its number of places
        seen, places = np.unique(np.repeat(docs, sizes) * len(self.names) + np.concatenate(parts), return_counts=True)
        doc, part = np.divmod(seen, len(self.names))
        many = self.first[part + 1] - self.first[part]
        at = np.repeat(self.first[part], many) + ragged(many)
        bits = max(1, int(docs[-1] + 1).bit_length())
        record = self.key[at] << bits | np.repeat(doc, many)
        order = np.argsort(record, kind="stable")
        record = record[order]
        start = np.flatnonzero(np.append(True, record[1:] != record[:-1])) if len(record) else none
        n = np.add.reduceat((self.times[at] * np.repeat(places, many))[order], start) if len(record) else none
        return record[start] >> bits, record[start] & ((1 << bits) - 1), n


# ------------------------------------------------------------------ runs

def pack(*columns: np.ndarray) -> bytes:
    """Integer columns of any lengths as one zstd frame: small types, a header with their lengths."""
    small = [np.ascontiguousarray(c, next(t for t in ("<u1", "<u2", "<u4", "<u8") if not len(c) or int(c.max()) <= np.iinfo(t).max)) for c in columns]
    head = np.array([x for c in small for x in (len(c), c.itemsize)], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(len(small).to_bytes(8, "little") + head + b"".join(c.tobytes() for c in small))


def unpack(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    k = int.from_bytes(raw[:8], "little")
    head, at, out = np.frombuffer(raw, "<i8", 2 * k, 8), 8 + 16 * k, []
    for n, size in head.reshape(k, 2).tolist():
        out.append(np.frombuffer(raw, f"<u{size}", n, at).astype(np.int64))
        at += n * size
    return out


def pack_pairs(key: np.ndarray, n: np.ndarray) -> bytes:
    """Sorted pairs by their steps, with a count each."""
    return pack(key[:1], np.diff(key), n)


def unpack_pairs(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    first, steps, n = unpack(blob)
    return np.cumsum(np.append(first, steps)), n


RUN_SCHEMA = ("slice long, idx int, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
              "radix int, size long, docs int, pairs binary, postings binary")
RUN_TYPES = {"slice": pa.int64(), "idx": pa.int32(), **{f: pa.int64() for f in FIGURES}, "groups_sha256": pa.string(),
             "radix": pa.int32(), "size": pa.int64(), "docs": pa.int32(), "pairs": pa.binary(), "postings": pa.binary()}


def _runs(path_a: str, path_b: str, pattern: str | None):
    """Texts to rows of documents (radix null) and runs (idx null)."""
    def block(batch: pa.RecordBatch, number: int, side_a: ByteSide, side_b: PieceSide, names: list[bytes]) -> list[dict]:
        ids, raw = batch.column(0).to_pylist(), blobs(batch, "_text")
        texts = [(t or b"").decode("utf-8", "replace") for t in raw]
        numbers = _Numbers()
        parts = {i: numbers.of(t.split(" ") if side_b.by_word else [t]) for i, t in enumerate(texts) if t}
        if side_b.by_word:  # few texts have other white space beside a space
            clear = np.fromiter(map(bare, numbers), bool, len(numbers))
            parts |= {i: numbers.of(segments(texts[i])) for i, p in parts.items() if not clear[p].all()}
        known = _Aligned(list(numbers), side_a, side_b, names)
        # a text with a segment that a side doesn't give back whole is looked at whole
        again = [i for i, p in parts.items() if not known.fits[p].all()]
        whole = _Numbers()
        for i in again:
            parts[i] = whole.of([texts[i]])
        plain = [i for i in parts if i not in set(again) and texts[i].encode() == raw[i]]
        rows = [{"_id": x, "slice": number, "idx": i, **dict.fromkeys(FIGURES, 0), "groups_sha256": ""} for i, x in enumerate(ids)]
        found = [known.of([parts[i] for i in plain], np.array(plain, np.int64), rows)]
        if again:
            odd = _Aligned(list(whole), side_a, side_b, names)
            fine = [i for i in again if odd.fits[parts[i]].all() and texts[i].encode() == raw[i]]
            found.append(odd.of([parts[i] for i in fine], np.array(fine, np.int64), rows))
        key, at_doc, times = (np.concatenate(c) for c in zip(*found))
        radix = ((key >> SHIFT) % RADIX).astype(np.uint8)
        order = np.argsort(radix, kind="stable") if len(found) == 1 else np.lexsort((at_doc, key, radix))
        key, at_doc, times = key[order], at_doc[order], times[order]
        edges = np.searchsorted(radix[order], np.arange(RADIX + 1))
        for r in range(RADIX):
            lo, hi = edges[r], edges[r + 1]
            if lo < hi:
                k = key[lo:hi]
                start = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
                pairs, postings = pack_pairs(k[start], np.diff(np.append(start, hi - lo))), pack(at_doc[lo:hi], times[lo:hi])
                rows.append({"slice": number, "radix": r, "size": len(pairs) + len(postings), "docs": len(ids), "pairs": pairs, "postings": postings})
        return rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        side_a, side_b, names = sides(path_a, path_b, pattern)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for piece in slices(batch, "_text", TEXT_BYTES):
                if piece.num_rows:
                    schema = pa.schema([("_id", piece.schema.field(0).type), *RUN_TYPES.items()])
                    yield pa.RecordBatch.from_pylist(block(piece, number, side_a, side_b, names), schema)
                    number += 1

    return run


# ------------------------------------------------------------------ merging

def merge(runs: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """k-way merge of sorted (pairs, counts) runs, one side-A id at a time: its
    distinct pairs and their summed counts. The heap holds the next id of each run."""
    heap, cuts = [], []
    for i, (key, _) in enumerate(runs):
        side = key >> SHIFT
        at = np.flatnonzero(np.append(True, side[1:] != side[:-1])) if len(key) else np.zeros(0, np.int64)
        cuts.append((side[at].tolist(), [*at.tolist(), len(key)]))
        if len(key):
            heap.append((cuts[-1][0][0], i, 0))
    heapq.heapify(heap)
    while heap:
        side, held = heap[0][0], []
        while heap and heap[0][0] == side:
            _, i, j = heap[0]
            ids, at = cuts[i]
            held.append((runs[i][0][at[j]:at[j + 1]], runs[i][1][at[j]:at[j + 1]]))
            if j + 1 < len(ids):
                heapq.heapreplace(heap, (ids[j + 1], i, j + 1))
            else:
                heapq.heappop(heap)
        if len(held) == 1:
            yield held[0]
        else:
            key, place = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            yield key, np.bincount(place, np.concatenate([n for _, n in held])).astype(np.int64)


def _chunks(merged: Iterator[tuple[np.ndarray, ...]]) -> Iterator[list[np.ndarray]]:
    """Ids together until a chunk is full."""
    held, n = [], 0
    for part in merged:
        held.append(part)
        n += len(part[0])
        if n >= CHUNK:
            yield [np.concatenate(c) for c in zip(*held)]
            held, n = [], 0
    if held:
        yield [np.concatenate(c) for c in zip(*held)]


def _partial(group: pa.Table) -> pa.Table:
    """Runs, or partial counts, of one merge group to its partial counts."""
    radix, part = group.column("radix")[0].as_py(), group.column("part")[0].as_py()
    found = [pack_pairs(k, n) for k, n in _chunks(merge([unpack_pairs(x) for x in group.column("pairs").to_pylist()]))]
    return pa.table({"radix": pa.array([radix] * len(found), pa.int32()), "part": pa.array([part] * len(found), pa.int32()),
                     "pairs": pa.array(found, pa.binary())})


def _totals(group: pa.Table) -> pa.Table:
    """Partial counts of one radix to totals; ``best`` marks the most of each side-A id."""
    radix = group.column("radix")[0].as_py()
    flagged = ((k, n, (n == n.max()).astype(np.int64)) for k, n in merge([unpack_pairs(x) for x in group.column("pairs").to_pylist()]))
    found = [pack(k[:1], np.diff(k), n, best) for k, n, best in _chunks(flagged)]
    return pa.table({"radix": pa.array([radix] * len(found), pa.int32()), "totals": pa.array(found, pa.binary())})


def _back(key, left: pa.Table, right: pa.Table) -> pa.Table:
    """Runs of one merge group beside their totals, to sums for each document of each run."""
    found = [unpack(x) for x in right.column("totals").to_pylist()]
    pairs = np.concatenate([np.cumsum(np.append(k, steps)) for k, steps, _, _ in found]) if found else np.zeros(0, np.int64)
    order = np.argsort(pairs)  # the messages come in any order
    pairs = pairs[order]
    total, best = (np.concatenate([f[c] for f in found])[order] if found else pairs for c in (2, 3))
    out = {"slice": [], "idx": [], "n_best": [], "count_sum": []}
    for r in left.select(["slice", "docs", "pairs", "postings"]).to_pylist():
        mine, n = unpack_pairs(r["pairs"])
        doc, times = unpack(r["postings"])
        at = np.repeat(np.searchsorted(pairs, mine), n)
        # exact sums: bincount's doubles could round beyond 2^53
        sums, bests = np.zeros(r["docs"], np.int64), np.zeros(r["docs"], np.int64)
        np.add.at(sums, doc, total[at] * times)
        np.add.at(bests, doc, best[at] * times)
        some = np.flatnonzero(sums)
        for name, x in (("slice", np.full(len(some), r["slice"])), ("idx", some), ("n_best", bests[some]), ("count_sum", sums[some])):
            out[name].append(x)
    flat = {k: np.concatenate(v) if v else np.zeros(0, np.int64) for k, v in out.items()}
    return pa.table({"slice": pa.array(flat["slice"], pa.int64()), "idx": pa.array(flat["idx"], pa.int32()),
                     "n_best": pa.array(flat["n_best"], pa.int64()), "count_sum": pa.array(flat["count_sum"], pa.int64())})


def align(docs: DataFrame, path_a: str, path_b: str, pattern: str | None = None, id_col: str = "doc_id",
          text_col: str = "text", group_bytes: int = GROUP_BYTES) -> DataFrame:
    """Id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row of ``docs``.
    ``pattern`` is the splitting pattern of the byte-level vocabulary; with it, a faster encoder of the same vocabulary is used."""
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    schema = StructType([StructField("_id", rows.schema["_id"].dataType), *StructType.fromDDL(RUN_SCHEMA).fields])
    made = written(rows.mapInArrow(_runs(path_a, path_b, pattern), schema))
    own = made.filter("radix is null").select("_id", "slice", "idx", *FIGURES, "groups_sha256")
    runs = made.filter("radix is not null").select("slice", "radix", "size", "docs", "pairs", "postings")

    size = {r["radix"]: r["size"] for r in runs.groupBy("radix").agg(F.sum("size").alias("size")).collect()}  # RADIX rows
    parts = [max(1, -(-size.get(r, 0) // group_bytes)) for r in range(RADIX)]
    many = F.element_at(F.from_json(F.lit(json.dumps(parts)), "array<int>"), F.col("radix") + 1)
    dealt = runs.withColumn("part", F.pmod(F.xxhash64("slice"), many.cast("long")).cast("int"))
    partial = dealt.select("radix", "part", "pairs").groupBy("radix", "part").applyInArrow(_partial, "radix int, part int, pairs binary")
    left = max(parts)
    while left > FAN:
        met = partial.withColumn("part", F.floor(F.col("part") / FAN).cast("int"))
        partial = met.groupBy("radix", "part").applyInArrow(_partial, "radix int, part int, pairs binary")
        left = -(-left // FAN)
    totals = written(partial.groupBy("radix").applyInArrow(_totals, "radix int, totals binary"))
    sent = totals.withColumn("part", F.explode(F.sequence(F.lit(0), many - 1)))
    back = dealt.groupBy("radix", "part").cogroup(sent.groupBy("radix", "part")).applyInArrow(
        _back, "slice long, idx int, n_best long, count_sum long")
    sums = back.groupBy("slice", "idx").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    out = own.join(sums, ["slice", "idx"], "left")
    return out.select(F.col("_id").alias(id_col), *FIGURES, F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
                      F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"), "groups_sha256")
