"""Chat formatting into a prefix tree with position ids and attention intervals (operator 8).

Conversations that share their first turns share nodes: a node is a turn together with all
turns in front of it.  The distinct nodes are written once, depth-first, to one stream of
tokens.  With each node come its place in the stream, the position id of its first token (its
distance from the start of its conversation) and the intervals of the stream that hold its
ancestors, to which its tokens attend besides their own.  Neighbouring intervals are joined,
so a long unbranched conversation has one.

Depth-first order is the sorted order of the conversations' paths (the sequences of node
ids): a path's nodes that its predecessor lacks follow it.  Sorting is a range partitioning;
node places are running sums inside partitions plus the sums of the partitions before.  No
tree is ever gathered, so one may hold any share of all conversations, and a conversation is
read as a stream of rows.

A turn is written as ``<|turn|>role\\ntext<|end|>``.  In roles and texts the backslash and the
characters that begin control strings are escaped, so no text can form a control string, and
unescaping restores it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from boardlake.llm.bpe import automaton, read_vocabulary
from boardlake.llm.common import join_uneven, materialise

TURN, END = "<|turn|>", "<|end|>"
#: What is escaped, and how.
ESCAPES = {"\\": "\\\\", "<": "\\l", "[": "\\b", "\n": "\\n"}
_FORWARD = {ord(c): e for c, e in ESCAPES.items() if c != "\n"}
_ROLE = {ord(c): e for c, e in ESCAPES.items()}
_BACK = {e[1]: c for c, e in ESCAPES.items()}
_TURNS = re.compile(re.escape(TURN) + r"([^\n]*)\n([^<]*)" + re.escape(END))
ID_BYTES = 16
#: Tokens of the stream in one block of the read-back join.
BLOCK = 512


def escape(text: str, role: bool = False) -> str:
    return text.translate(_ROLE if role else _FORWARD)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: _BACK[m[1]], text, flags=re.S)


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation."""
    return [(unescape(r), unescape(t)) for r, t in _TURNS.findall(formatted)]


def _child(parent: bytes, role: str, text: str) -> bytes:
    r = role.encode()
    return hashlib.sha256(parent + len(r).to_bytes(8, "big") + r + text.encode()).digest()[:ID_BYTES]


def _turns(rows: DataFrame) -> DataFrame:
    """(conv_id, node, role, text, path): each turn with its node; path, the ids of all nodes of
    the conversation, is on the last one.  Rows come sorted, and are read as a stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "node", "role", "text", "path"]
        held: tuple | None = None
        conv, path = None, bytearray()
        for batch in batches:
            out = []
            for c, role, text in zip(batch.column("conv_id").to_pylist(), batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if held is not None:
                    same = c == conv
                    out.append((*held, None if same else bytes(path)))
                    if not same:
                        path = bytearray()
                conv = c
                role, text = role or "", text or ""
                node = _child(bytes(path[-ID_BYTES:]), role, text)
                path += node
                held = (c, node, role, text)
            if out:
                yield pa.RecordBatch.from_pydict(dict(zip(names, zip(*out, strict=True), strict=True)), schema=schema)
        if held is not None:
            yield pa.RecordBatch.from_pydict(dict(zip(names, ([x] for x in (*held, bytes(path))), strict=True)), schema=schema)

    schema = pa.schema([("conv_id", pa.int64()), ("node", pa.binary()), ("role", pa.string()), ("text", pa.string()), ("path", pa.binary())])
    return rows.mapInArrow(run, "conv_id long, node binary, role string, text string, path binary")


def _tokens(nodes: DataFrame, vocabulary: str, learn_role: str) -> DataFrame:
    """Token ids of each node's turn, and the span of those that a loss counts."""
    content = nodes.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = automaton(content.value)
        for batch in batches:
            roles, texts = batch.column("role").to_pylist(), batch.column("text").to_pylist()
            pieces = [p for r, t in zip(roles, texts, strict=True) for p in (TURN + escape(r, True) + "\n", escape(t), END)]
            ids = list(auto.encode(pieces, special=False))
            head, body = [len(x) for x in ids[::3]], [len(x) for x in ids[1::3]]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node"),
                    pa.array([np.concatenate(ids[k : k + 3]).astype(np.int32) for k in range(0, len(ids), 3)], pa.list_(pa.int32())),
                    pa.array(head, pa.int32()),
                    pa.array([a + b if r == learn_role else a for a, b, r in zip(head, body, roles, strict=True)], pa.int32()),
                ],
                ["node", "ids", "loss_from", "loss_to"],
            )

    return nodes.mapInArrow(run, "node binary, ids array<int>, loss_from int, loss_to int")


def _ranked(paths: DataFrame, n: int) -> DataFrame:
    """(part, nth, path, fresh): paths in sorted order; the first ``fresh`` nodes are also the
    predecessor's in its partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, count = b"", 0
        for batch in batches:
            fresh = []
            for path in batch.column("path").to_pylist():
                a = np.frombuffer(before[: min(len(before), len(path))], np.uint8)
                differ = np.flatnonzero(a != np.frombuffer(path[: len(a)], np.uint8))
                fresh.append((int(differ[0]) if len(differ) else len(a)) // ID_BYTES)
                before = path
            nth = np.arange(count, count + len(fresh))
            count += len(fresh)
            yield pa.RecordBatch.from_arrays([batch.column("part"), pa.array(nth), batch.column("path"), pa.array(fresh, pa.int32())], ["part", "nth", "path", "fresh"])

    order = paths.repartitionByRange(n, "path").sortWithinPartitions("path").withColumn("part", F.spark_partition_id())
    return order.mapInArrow(run, "part int, nth long, path binary, fresh int")


def _attention(steps: DataFrame) -> DataFrame:
    """(node, position, attend) of the nodes that a path owns, from the path's nodes in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple | None = None
        position, spans = 0, []
        for batch in batches:
            out = []
            for part, nth, node, owned, start, n in zip(*(batch.column(c).to_pylist() for c in ("part", "nth", "node", "owned", "start", "n")), strict=True):
                if at != (part, nth):
                    at, position, spans = (part, nth), 0, []
                if owned:
                    out.append((node, position, [{"from": a, "to": b} for a, b in spans]))
                position += n
                if spans and spans[-1][1] == start:
                    spans[-1] = (spans[-1][0], start + n)
                else:
                    spans.append((start, start + n))
            if out:
                yield pa.RecordBatch.from_pydict(dict(zip(schema.names, zip(*out, strict=True), strict=True)), schema=schema)

    schema = pa.schema([("node", pa.binary()), ("position", pa.int64()), ("attend", pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())])))])
    return steps.mapInArrow(run, "node binary, position long, attend array<struct<from:long,to:long>>")


def format_chat(rows: DataFrame, vocabulary: str, learn_role: str = "assistant") -> tuple[DataFrame, DataFrame]:
    """(segments, members) for rows (conv_id, turn, role, text).

    ``segments`` has a row for each distinct node: node, start (place of its first token in the
    stream), ids, position (of its first token; the others follow), attend (intervals of its
    ancestors), loss_from and loss_to (the span of its ids under the loss mask: the text of a
    ``learn_role`` turn).  ``members`` has (conv_id, node) for each conversation's last node.

    Turns are ordered by turn, role and text, nulls first.  A null text or role is empty, a
    null conv_id is a conversation of its own, equal rows are equal turns one after the other.
    A conversation is read in order by one task, as a stream, whatever its length; what grows
    with it in memory is its path, 16 bytes a turn.  A node's intervals are as many as the
    places where its conversation leaves one that was written before, at most its turns.
    An empty table gives empty results; other columns are ignored.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = rows.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    turns = materialise(_turns(own.repartition(n, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")))
    tokens = materialise(_tokens(turns.select("node", "role", "text").dropDuplicates(["node"]), vocabulary, learn_role))
    last = turns.where(F.col("path").isNotNull())
    ranked = materialise(_ranked(last.select("path").distinct(), n))
    nodes = F.transform(F.sequence(F.lit(0), (F.length("path") / ID_BYTES).cast("int") - 1), lambda k: F.substring("path", k * ID_BYTES + 1, F.lit(ID_BYTES)))
    # the path itself does not go along with each of its steps
    steps = ranked.select("part", "nth", "fresh", F.posexplode(nodes).alias("depth", "node"))
    owner = steps.where("depth >= fresh").groupBy("node").agg(F.min(F.struct("part", "nth", "depth")).alias("o")).select("node", "o.*")
    sized = owner.join(tokens.select("node", F.size("ids").cast("long").alias("n")), "node")
    run = W.partitionBy("part").orderBy("nth", "depth")
    local = materialise(sized.withColumn("upto", F.sum("n").over(run.rowsBetween(W.unboundedPreceding, W.currentRow))))
    base = local.groupBy("part").agg(F.sum("n").alias("total"))  # one row for each partition
    base = base.select("part", F.coalesce(F.sum("total").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    placed = local.join(F.broadcast(base), "part").select("node", F.col("part").alias("p"), F.col("nth").alias("q"), (F.col("base") + F.col("upto") - F.col("n")).alias("start"), "n")
    # a first turn that very many conversations share is a step of all of them
    full = join_uneven(steps.drop("fresh"), placed, "node", ["part", "nth"]).select("part", "nth", "depth", "node", ((F.col("p") == F.col("part")) & (F.col("q") == F.col("nth"))).alias("owned"), "start", "n")
    attention = _attention(full.repartition(n, "part", "nth").sortWithinPartitions("part", "nth", "depth"))
    segments = placed.select("node", "start").join(attention, "node").join(tokens, "node")
    members = last.select("conv_id", F.expr(f"substring(path, length(path) - {ID_BYTES - 1}, {ID_BYTES})").alias("node"))
    return segments.select("node", "start", "ids", "position", "attend", "loss_from", "loss_to"), members


def read_back(segments: DataFrame, members: DataFrame, vocabulary: str) -> DataFrame:
    """What the stream says of every conversation: (conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars).

    A conversation is its last node and the intervals that node attends to.  Intervals are
    joined to segments by blocks of the stream, so a join key has few segments; blocks that
    very many conversations read are dealt over several tasks."""
    n = int(segments.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ends = segments.join(members.select("node").distinct(), "node").select(
        F.col("node").alias("leaf"), F.concat("attend", F.array(F.struct(F.col("start").alias("from"), (F.col("start") + F.size("ids")).alias("to")))).alias("spans"))
    spans = ends.select("leaf", F.explode("spans").alias("s")).select("leaf", "s.*")
    blocks = spans.select("leaf", "from", "to", F.explode(F.sequence(F.expr(f"`from` div {BLOCK}"), F.expr(f"(`to` - 1) div {BLOCK}"))).alias("block"))
    pieces = segments.select(F.expr(f"start div {BLOCK}").alias("block"), "start", "ids", "loss_from", "loss_to")
    # all leaves under a shared first turn read its block
    joined = join_uneven(blocks, pieces, "block", ["leaf"]).where("start >= `from` AND start < `to`").select("leaf", "start", "ids", "loss_from", "loss_to")
    content = segments.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = automaton(content.value)
        state: list = []

        def closed() -> dict:
            leaf, turns, sha, loss, loss_sha, chars = state
            return {"leaf": leaf, "n_turns": turns, "turns_sha256": sha.hexdigest(), "loss_chars": loss, "loss_sha256": loss_sha.hexdigest(), "formatted_chars": chars}

        for batch in batches:
            out = []
            leaves, froms, tos = (batch.column(c).to_pylist() for c in ("leaf", "loss_from", "loss_to"))
            for k, leaf in enumerate(leaves):
                if not state or state[0] != leaf:
                    if state:
                        out.append(closed())
                    state = [leaf, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                ids = batch.column("ids")[k].values.to_numpy().astype(np.int64)
                formatted = auto.labels(ids)[0].tobytes().decode()
                for role, text in parse(formatted):
                    state[1] += 1
                    state[2].update(f"{role}\n{text}\n".encode())
                learnt = unescape(auto.labels(ids[froms[k] : tos[k]])[0].tobytes().decode())
                state[3] += len(learnt)
                state[4].update(learnt.encode())
                state[5] += len(formatted)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
        if state:
            yield pa.RecordBatch.from_pylist([closed()], schema=schema)

    schema = pa.schema([("leaf", pa.binary()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
    digests = joined.repartition(n, "leaf").sortWithinPartitions("leaf", "start").mapInArrow(run, "leaf binary, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    return members.join(digests, members.node == digests.leaf).drop("node", "leaf")
