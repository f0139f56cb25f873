"""Chat formatting as prefix trees.

Conversations that begin with the same turns share those turns: every prefix
is a node, named by a hash chained over its turns, and every node's formatted
turn is emitted once. The distinct conversations are sorted by their chain of
node names, which is the depth-first order of all trees at once, so a
conversation emits exactly the nodes beyond what it shares with the one before it. The
sort is by range over whole chains: a first turn that a third of all
conversations share is spread over as many tasks as its conversations fill.

The segments of a tree, laid end to end in that order, are its packed text. A
segment has its start there, the position of its first character in its own
conversation, and the intervals of the packed text that it may attend to, its
ancestors (merged where they touch). Places are code points.

Template: ``<s>`` role newline text ``</s>`` newline. Control strings inside roles
and texts get a backslash after their first character, backslashes are doubled
and a role's newlines get one, so that every turn can be read back.

Null roles and texts count as empty; turns are ordered by turn number (null
first), then role and text; rows with a null conversation id form one
conversation; equal rows are turns of their own; other columns are ignored;
empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hot_keys, salted_join, shuffle_partitions

#: Strings that the template or a reader of it may take for marks.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>")
OPEN, CLOSE = "<s>", "</s>\n"
_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"<s>((?:[^\\\n]|\\.)*)\n(.*)</s>\n\Z", re.S)

ID, ELEMENT = 16, 24  # bytes of a node's name, and of its name with its length


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text) if "\\" in text else text


def format_turn(role: str, text: str) -> tuple[str, int]:
    """The formatted turn and the place of its text in it."""
    head = OPEN + escape(role).replace("\n", "\\\n") + "\n"
    return head + escape(text) + CLOSE, len(head)


def read_turn(segment: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    m = _TURN.match(segment)
    return unescape(m[1]), unescape(m[2])


def turns(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per turn: conv, depth, node, parent, role, segment, n_chars. Streams over
    sorted rows: a conversation of any length holds one hash."""
    spark = conversations.sparkSession
    rows = conversations.select(F.col(id_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"),
                                F.coalesce(text_col, F.lit("")).alias("text"))
    rows = rows.repartition(shuffle_partitions(spark), "conv").sortWithinPartitions("conv", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, node, depth = object(), b"", 0
        for batch in batches:
            depths, nodes, parents, segments = [], [], [], []
            for conv, role, text in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3))):
                if conv != now:
                    now, node, depth = conv, b"", 0
                segment = format_turn(role, text)[0]
                parents.append(node)
                node = hashlib.blake2b(node + segment.encode(), digest_size=ID).digest()
                depth += 1
                depths.append(depth)
                nodes.append(node)
                segments.append(segment)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(depths, pa.int32()), pa.array(nodes, pa.binary()), pa.array(parents, pa.binary()), batch.column(2),
                 pa.array(segments, pa.string()), pa.array(list(map(len, segments)), pa.int64())],
                names=["conv", "depth", "node", "parent", "role", "segment", "n_chars"])

    return rows.mapInArrow(run, "conv long, depth int, node binary, parent binary, role string, segment string, n_chars long")


def shared(a: bytes, b: bytes) -> int:
    """Elements that two chains share from the start on."""
    n = min(len(a), len(b)) // ELEMENT
    if a[:n * ELEMENT] == b[:n * ELEMENT]:
        return n
    lo, hi = 0, n
    while lo + 1 < hi:
        mid = (lo + hi) // 2
        lo, hi = (mid, hi) if a[:mid * ELEMENT] == b[:mid * ELEMENT] else (lo, mid)
    return lo


class Walk:
    """Depth-first walk over sorted chains: keeps the way to the last node."""

    def __init__(self, chain: bytes = b"", starts: list[int] | None = None, at: int = 0):
        self.chain, self.at = chain, at
        self.starts = list(starts or [])  # start of each element of the chain in the stream

    def step(self, chain: bytes) -> int:
        """Moves on to ``chain``; returns how many elements were there already."""
        same = shared(self.chain, chain)
        del self.starts[same:]
        for k in range(same, len(chain) // ELEMENT):
            self.starts.append(self.at)
            self.at += int.from_bytes(chain[k * ELEMENT + ID:(k + 1) * ELEMENT], "big")
        self.chain = chain
        return same


def layout(chains: DataFrame) -> DataFrame:
    """Places of all nodes from the sorted distinct chains (one partition after the
    other): node, tree, start (in the packed text of its tree), position, and the ancestors' intervals."""
    spark = chains.sparkSession

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = None
        for batch in batches:
            if batch.num_rows:
                chain = batch.column(0)[batch.num_rows - 1].as_py()
        if chain is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([chain], pa.binary())], names=["p", "chain"])

    # a row a partition: where the one before it ended
    ends = sorted((r.p, bytes(r.chain)) for r in chains.mapInArrow(last, "p int, chain binary").collect())
    before = {p: chain for (p, _), (_, chain) in zip(ends[1:], ends)}

    def length(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk, some = None, False
        for batch in batches:
            if walk is None:
                chain = before.get(TaskContext.get().partitionId(), b"")
                walk = Walk(chain, [-1] * (len(chain) // ELEMENT))
            for chain in batch.column(0).to_pylist():
                walk.step(chain)
                some = True
        if some:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([walk.at], pa.int64()),
                                              pa.array([walk.starts], pa.list_(pa.int64()))], names=["p", "n", "starts"])

    # a row a partition again: what it adds, and where the nodes on its last way start (-1: an earlier one)
    state: dict[int, tuple[bytes, list[int], int]] = {}
    at, way = 0, []
    for r in sorted(chains.mapInArrow(length, "p int, n long, starts array<long>").collect(), key=lambda r: r.p):
        state[r.p] = (before.get(r.p, b""), way, at)
        way = [way[k] if s < 0 else at + s for k, s in enumerate(r.starts)]
        at += r.n
    held = spark.sparkContext.broadcast(state)
    interval = pa.struct([("start", pa.int64()), ("stop", pa.int64())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = None
        for batch in batches:
            if walk is None:
                walk = Walk(*held.value[TaskContext.get().partitionId()]) if batch.num_rows else None
            rows = [[] for _ in range(5)]
            for chain in batch.column(0).to_pylist():
                same = walk.step(chain)
                if same == len(walk.starts):
                    continue
                sizes = [int.from_bytes(chain[k * ELEMENT + ID:(k + 1) * ELEMENT], "big") for k in range(len(walk.starts))]
                root = walk.starts[0]
                position, way = 0, []
                for k, (start, size) in enumerate(zip(walk.starts, sizes)):
                    if k >= same:
                        for column, value in zip(rows, (chain[k * ELEMENT:k * ELEMENT + ID], chain[:ID], start - root, position,
                                                        [{"start": a, "stop": z} for a, z in way])):
                            column.append(value)
                    position += size
                    if way and way[-1][1] == start - root:
                        way[-1] = (way[-1][0], start - root + size)
                    else:
                        way.append((start - root, start - root + size))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[0], pa.binary()), pa.array(rows[1], pa.binary()), pa.array(rows[2], pa.int64()), pa.array(rows[3], pa.int64()),
                 pa.array(rows[4], pa.list_(interval))], names=["node", "tree", "start", "position", "attends"])

    return chains.mapInArrow(place, "node binary, tree binary, start long, position long, attends array<struct<start: long, stop: long>>")


def format_trees(conversations: DataFrame, **columns) -> tuple[DataFrame, DataFrame]:
    """(segments, members). Segments: tree, node, parent, depth, role, segment, n_chars,
    start, position, attends, loss_start, loss_stop (the part of the segment under the loss
    mask; empty but for assistants). Members: conv, node (its last turn) and chain."""
    spark = conversations.sparkSession
    rows = turns(conversations, **columns).checkpoint()
    element = F.concat("node", F.unhex(F.lpad(F.hex("n_chars"), 16, "0")))
    members = rows.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("depth", element.alias("e")))).alias("w"))
    members = members.select("conv", F.aggregate("w", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["e"])).alias("chain"))
    members = members.withColumn("node", F.substring("chain", F.length("chain") - ELEMENT + 1, ID)).checkpoint()
    distinct = members.groupBy("node").agg(F.first("chain").alias("chain")).select("chain")
    chains = distinct.repartitionByRange(shuffle_partitions(spark), "chain").sortWithinPartitions("chain").checkpoint()
    nodes = rows.select("node", "parent", "depth", "role", "segment", "n_chars").dropDuplicates(["node"])
    # a text is as long as its segment less the template; the head ends at the first newline without a backslash
    head = F.length(F.regexp_extract("segment", r"\A<s>(?:[^\\\n]|\\[\s\S])*\n", 0))
    loss = F.col("role") == "assistant"
    segments = layout(chains).join(nodes, "node").select(
        "tree", "node", "parent", "depth", "role", "segment", "n_chars", "start", "position", "attends",
        F.when(loss, head).otherwise(F.lit(0)).cast("long").alias("loss_start"),
        F.when(loss, F.length("segment") - len(CLOSE)).otherwise(F.lit(0)).cast("long").alias("loss_stop"))
    return segments, members


def chain_nodes(chain: str = "chain") -> Column:
    """Names of the nodes of a chain, with their depth."""
    n = (F.length(chain) / ELEMENT).cast("int")
    return F.transform(F.sequence(F.lit(1), n), lambda k: F.struct(k.alias("depth"), F.substring(F.col(chain), (k - 1) * ELEMENT + 1, F.lit(ID)).alias("node")))


def read_back(segments: DataFrame, members: DataFrame) -> DataFrame:
    """What each conversation says, read from the packed output: conv, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars. Equal conversations are read once;
    segments that many conversations share are dealt over several tasks."""
    spark = segments.sparkSession
    distinct = members.groupBy("node").agg(F.first("chain").alias("chain"))
    ways = distinct.select(F.col("node").alias("leaf"), F.explode(chain_nodes()).alias("w")).select("leaf", "w.depth", "w.node")
    texts = segments.select("node", "segment", "loss_start", "loss_stop")
    parts = salted_join(ways, texts, ["node"], hot_keys(ways, ["node"]), ["leaf"], "inner").drop("node")
    parts = parts.repartition(shuffle_partitions(spark), "leaf").sortWithinPartitions("leaf", "depth")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        leaf = None

        def done() -> None:
            if leaf is not None:
                rows.append((leaf, n, said.hexdigest(), loss, masked.hexdigest(), size))

        def out() -> pa.RecordBatch:
            kinds = (pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)],
                                              names=["leaf", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for batch in batches:
            for now, segment, a, z in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("leaf", "segment", "loss_start", "loss_stop"))):
                if now != leaf:
                    done()
                    leaf, n, loss, size, said, masked = now, 0, 0, 0, hashlib.sha256(), hashlib.sha256()
                role, text = read_turn(segment)
                said.update(f"{role}\n{text}\n".encode())
                n, size = n + 1, size + len(segment)
                if z > a:
                    under = unescape(segment[a:z])
                    loss += len(under)
                    masked.update(under.encode())
            if rows:
                yield out()
                rows = []
        done()
        if rows:
            yield out()

    read = parts.mapInArrow(run, "leaf binary, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    of = read.withColumnRenamed("leaf", "node")
    convs = members.select("conv", "node")
    return salted_join(convs, of, ["node"], hot_keys(convs, ["node"]), ["conv"], "inner").drop("node")
