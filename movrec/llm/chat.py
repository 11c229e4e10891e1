"""Chat formatting as packed prefix trees.

Conversations that share initial turns are merged to a tree: a turn's node is
the digest of all turns up to it, so equal beginnings have equal nodes.  Each
tree's tokens are emitted once, depth first; every node carries its offset in
the packed sequence, the position id of its first token (the tokens of its
ancestors), the loss range inside it, and the packed intervals of its
ancestors, which together with its own earlier tokens are all it may attend to.

Template of a turn: ``<|im_start|>`` role, line feed, text, ``<|im_end|>``, line
feed.  The two marks are ids of their own beyond the vocabulary.  Inside roles
and texts ``<`` followed by any number of backslashes and ``|`` gets one more
backslash, so no text can contain a mark, and reading removes exactly that one;
in roles line feeds and backslashes are written ``\\n`` and ``\\\\`` first.

How it is spread: a conversation's turns are read as a sorted stream (state: one
digest and its path of 16 bytes a turn); only its last turn carries the path, and
a path is cut into its nodes in one pass.  Distinct paths are range-sorted, and a
node belongs to the first path through it, which makes depth-first order a
plain rank.  Offsets are running sums over range partitions, split for a tree
of any size; joins on nodes shared by many conversations are skewed joins with
one row on the other side.

Defined results: rows of a conversation are ordered by turn (null first), then
role, then text, and repeated rows count as turns; null text, null role: empty;
null ``conv_id`` is a conversation of its own; other columns are not read.  Texts of
any length are one turn; a conversation of any number of turns costs 16 bytes a turn
of memory in one task, and work in step with its turns.  A node's ancestor intervals
are as many as its ancestors have that do not follow their parent at once.  The
vocabulary file is a parameter; the driver reads and broadcasts it, after a
check of its size.
"""

from __future__ import annotations

import hashlib
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from movrec.llm.common import arrow_map, running_before, settle, written

MAX_VOCABULARY_BYTES = 64 << 20
START, END = "<|im_start|>", "<|im_end|>"
LEARNED_ROLE = "assistant"
NODE = 16

_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<(\\*)\\\|")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*)<\|im_end\|>\n", re.DOTALL)


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def format_turn(role: str, text: str) -> str:
    return f"{START}{escape_role(role)}\n{escape(text)}{END}\n"


def parse_turn(formatted: str) -> tuple[str, str]:
    m = _TURN.fullmatch(formatted)
    if m is None:
        raise ValueError("not one formatted turn")
    return unescape_role(m[1]), unescape(m[2])


class Tokens:
    """A byte-level vocabulary with the two marks behind it."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_str(vocabulary)
        self.model.encode_special_tokens = True
        size = self.model.get_vocab_size()
        self.start, self.end = size, size + 1

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def turns(self, rows: list[tuple[str, str]]) -> list[tuple[list[int], int, int]]:
        """Ids of each turn, and where the text's ids begin and end."""
        heads = self.encode([escape_role(r) + "\n" for r, _ in rows])
        bodies = self.encode([escape(t) for _, t in rows])
        tail = [self.end, *self.encode(["\n"])[0]]
        return [([self.start, *h, *b, *tail], 1 + len(h), 1 + len(h) + len(b)) for h, b in zip(heads, bodies)]

    def texts(self, rows: list[np.ndarray]) -> list[str]:
        """Ids of each row back to its formatted text."""
        pieces, plans = [], []
        for ids in rows:
            plan, at = [], 0
            for cut in [*np.flatnonzero(ids >= self.start).tolist(), len(ids)]:
                if cut > at:
                    plan.append(len(pieces))
                    pieces.append(ids[at:cut].tolist())
                if cut < len(ids):
                    plan.append(START if ids[cut] == self.start else END)
                at = cut + 1
            plans.append(plan)
        decoded = self.model.decode_batch(pieces, skip_special_tokens=False)
        return ["".join(x if isinstance(x, str) else decoded[x] for x in plan) for plan in plans]

    def text(self, ids: list[int]) -> str:
        return self.texts([np.asarray(ids, np.int64)])[0]


_LOADED: list = []


def _tokens(shared) -> Tokens:
    """One tokenizer for each worker process and vocabulary."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    text = shared.value
    if not (_LOADED and _LOADED[0] is text):
        _LOADED[:] = [text, Tokens(text)]
    return _LOADED[1]


def _batch(rows: list[tuple], first: pa.DataType, types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    """Rows as a record batch whose first column has the type of the input's ids."""
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), [first, *types])], names)


def load_vocabulary(spark, path: str):
    if os.path.getsize(path) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {MAX_VOCABULARY_BYTES} bytes")
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def conversation_nodes(conversations: DataFrame) -> DataFrame:
    """``conv_id, depth, node, role, text, path`` for every turn; ``path`` (all nodes) only on the last one."""
    kind = conversations.schema["conv_id"].dataType
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches):
        now, path, waiting, ids = None, bytearray(), None, None
        for batch in batches:
            out, ids = [], batch.schema.field(0).type
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in (0, 2, 3))):
                if waiting is None or conv != now:
                    if waiting is not None:
                        out.append((*waiting, bytes(path)))
                    now, path = conv, bytearray()
                else:
                    out.append((*waiting, None))
                digest = hashlib.blake2b(bytes(path[-NODE:]), digest_size=NODE)
                for part in (role.encode(), text.encode()):
                    digest.update(len(part).to_bytes(8, "big") + part)
                waiting = (conv, len(path) // NODE, digest.digest(), role, text)
                path += waiting[2]
            if out:
                yield _batch(out, ids, types, names)
        if waiting is not None:
            yield _batch([(*waiting, bytes(path))], ids, types, names)

    names = ["conv_id", "depth", "node", "role", "text", "path"]
    types = [pa.int32(), pa.binary(), pa.string(), pa.string(), pa.binary()]

    return arrow_map(rows, run, f"conv_id {kind.simpleString()}, depth int, node binary, role string, text string, path binary")


def tokenise_nodes(nodes: DataFrame, shared) -> DataFrame:
    """``node, ids, n_ids, loss_from, loss_to`` for every distinct node (node, role, text)."""

    def run(batches):
        tokens = _tokens(shared)
        for batch in batches:
            node, roles, texts = batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for at in range(0, len(roles), 256):
                found = tokens.turns(list(zip(roles[at : at + 256], texts[at : at + 256])))
                learned = [r == LEARNED_ROLE for r in roles[at : at + 256]]
                yield pa.RecordBatch.from_arrays(
                    [
                        node.slice(at, len(found)), pa.array([f[0] for f in found], pa.list_(pa.int32())), pa.array([len(f[0]) for f in found], pa.int64()),
                        pa.array([f[1] if y else 0 for f, y in zip(found, learned)], pa.int32()), pa.array([f[2] if y else 0 for f, y in zip(found, learned)], pa.int32()),
                    ],
                    ["node", "ids", "n_ids", "loss_from", "loss_to"],
                )

    return arrow_map(nodes.select("node", "role", "text"), run, "node binary, ids array<int>, n_ids bigint, loss_from int, loss_to int")


def path_steps(ranked: DataFrame) -> DataFrame:
    """``rank, tree, depth, node`` for every node of the paths in ``ranked`` (path, rank): 36 bytes a node, whatever the path's length."""

    def run(batches):
        for batch in batches:
            for path, rank in zip(batch.column(0), batch.column(1).to_pylist()):
                nodes = path.as_buffer()
                for at in range(0, nodes.size // NODE, 8192):
                    n = min(8192, nodes.size // NODE - at)
                    node = pa.Array.from_buffers(pa.binary(NODE), n, [None, nodes.slice(at * NODE, n * NODE)])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(n, rank)), pa.array([nodes.slice(0, NODE).to_pybytes()] * n, pa.binary()),
                            pa.array(np.arange(at, at + n, dtype=np.int32)), node.cast(pa.binary()),
                        ],
                        ["rank", "tree", "depth", "node"],
                    )

    return arrow_map(ranked.select("path", "rank"), run, "rank bigint, tree binary, depth int, node binary")


def pack_trees(turns: DataFrame, vocabulary: str) -> DataFrame:
    """The packed trees of :func:`conversation_nodes` rows, one row for each node.

    ``tree, node, depth, start, position, ids, loss_from, loss_to, ancestors``:
    ``start`` is the node's offset in its tree's sequence, ``position`` the
    position id of its first token, ``ancestors`` the merged packed intervals
    (start, end) of its ancestors.
    """
    shared = load_vocabulary(turns.sparkSession, vocabulary)
    distinct = turns.groupBy("node").agg(F.first("role").alias("role"), F.first("text").alias("text"))
    nodes = written(tokenise_nodes(distinct, shared))
    paths = turns.filter(F.col("path").isNotNull()).select("path").distinct()
    ranked = settle(paths.repartitionByRange("path").sortWithinPartitions("path").withColumn("rank", F.monotonically_increasing_id()))
    steps = path_steps(ranked)
    owner = settle(steps.groupBy("node").agg(F.min("rank").alias("owner")).join(nodes.select("node", "n_ids"), "node"))
    steps = settle(steps.join(owner, "node"))
    own = steps.filter("rank = owner")
    sizes = own.groupBy("tree", "rank").agg(F.sum("n_ids").alias("n"))
    begins = running_before(sizes, "tree", ["rank"], "n", "begin").select(F.col("rank").alias("owner"), "begin")
    inner = Window.partitionBy("rank").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    placed = own.withColumn("before", F.coalesce(F.sum("n_ids").over(inner), F.lit(0))).join(begins, "owner")
    placed = settle(placed.select("node", (F.col("begin") + F.col("before")).alias("start")))
    walked = steps.join(placed, "node").repartition("rank").sortWithinPartitions("rank", "depth")
    walked = walked.select("rank", "owner", "tree", "node", "depth", "start", "n_ids")
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        now, position, above = None, 0, []
        for batch in batches:
            cols = [c.to_pylist() for c in batch.columns]
            rows, places, lists = [], [], []
            for k, (rank, owner, _, _, _, start, n) in enumerate(zip(*cols)):
                if rank != now:
                    now, position, above = rank, 0, []
                if rank == owner:
                    rows.append(k)
                    places.append(position)
                    lists.append([{"start": a, "end": b} for a, b in above])
                position += n
                if above and above[-1][1] == start:
                    above[-1] = (above[-1][0], start + n)
                else:
                    above.append((start, start + n))
            if rows:
                kept = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [kept.column(2), kept.column(3), kept.column(4), kept.column(5), pa.array(places, pa.int64()), pa.array(lists, spans)],
                    ["tree", "node", "depth", "start", "position", "ancestors"],
                )

    found = arrow_map(walked, run, "tree binary, node binary, depth int, start bigint, position bigint, ancestors array<struct<start:bigint,end:bigint>>")
    return written(found).join(nodes.drop("n_ids"), "node").select("tree", "node", "depth", "start", "position", "ids", "loss_from", "loss_to", "ancestors")


def read_back(turns: DataFrame, packed: DataFrame, vocabulary: str) -> DataFrame:
    """Each conversation decoded from the packed trees, digested turn by turn.

    ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``.
    """
    shared = load_vocabulary(turns.sparkSession, vocabulary)
    kind = turns.schema["conv_id"].dataType
    rows = turns.select("conv_id", "depth", "node").join(packed.select("node", "ids", "loss_from", "loss_to"), "node")
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "depth").select("conv_id", "depth", "ids", "loss_from", "loss_to")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches):
        tokens, state, kinds = _tokens(shared), None, None
        for batch in batches:
            done, kinds = [], batch.schema.field(0).type
            convs, depths, starts, ends = (batch.column(c).to_pylist() for c in (0, 1, 3, 4))
            values, offsets = batch.column(2).values.to_numpy(), np.asarray(batch.column(2).offsets)
            for at in range(0, batch.num_rows, 256):
                part = range(at, min(at + 256, batch.num_rows))
                ids = [values[offsets[k] : offsets[k + 1]] for k in part]
                whole = tokens.texts(ids)
                masked = tokens.texts([x[starts[k] : ends[k]] for k, x in zip(part, ids)])
                for k, formatted, learned in zip(part, whole, masked):
                    if depths[k] == 0:
                        if state is not None:
                            done.append(close(state))
                        state = [convs[k], 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                    role, text = parse_turn(formatted)
                    learned = unescape(learned)
                    state[1] += 1
                    state[2].update(f"{role}\n{text}\n".encode())
                    state[3] += len(learned)
                    state[4].update(learned.encode())
                    state[5] += len(formatted)
            if done:
                yield _batch(done, kinds, types, names)
        if state is not None:
            yield _batch([close(state)], kinds, types, names)

    def close(s):
        return s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), s[5]

    return arrow_map(
        rows, run,
        f"conv_id {kind.simpleString()}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    )


def format_conversations(conversations: DataFrame, vocabulary: str) -> tuple[DataFrame, DataFrame]:
    """The turns with their nodes, and the packed trees.

    The turns, and the places and the tokens of the nodes, are tables in the shared
    folder; the packed trees join the last two, so that tokens are stored once.
    """
    turns = written(conversation_nodes(conversations))
    return turns, pack_trees(turns, vocabulary)
