"""Prefix trie of conversations by time-forward processing.

A conversation is a sequence of turns (role, text). Each distinct sequence
of first turns is a node of the trie, the empty one its root; a node's
members are the conversations that start with it. Every node gets its
members' smallest id and their number, its parent's smallest id, its
children, and the totals of its subtree: childless nodes, and the
characters that storing each shared turn once saves.

A node is known by its depth and a 128-bit hash of its turns: the exclusive
or of one hash per turn, which has the turn's place mixed in. Prefix hashes
are therefore running aggregates; a very long conversation is cut into
bands of turns, each with its own window, and the bands' totals are added.

Totals go up the trie by time-forward processing. Nodes are sorted by
reverse level order, deepest first (Spark sorts outside memory); one pass
takes a node's messages from a priority queue, adds its own share, and
sends its totals to its parent, which comes later in that order. The queue
keeps a bounded number of messages in memory and spills sorted runs to an
unnamed temporary file, which the task needs only while it lasts.

The passes run in shards. A node is *large* when several conversations
share it and more than ``SHARD`` turns lie in its subtree, counted once a
member; the root always is. All ancestors of a large node are large. A
node that is not large belongs to the shard of its topmost ancestor that is
not, so a shard is bounded, whatever turn or beginning many conversations
share; a single long conversation's own end is cut into bands, whose totals
are known without a message. The totals of the shard roots are summed by
their large parents, map-side first, and a last pass over the large nodes
takes them up to the root.

Defined cases: rows without a conversation id take no part; a null role or
text is empty; turns come by number, null first, those of one number by role
and text, and repeated rows are turns each; a conversation may have no turn
(a member of the root); empty and very long texts are turns like others; columns of other
names are ignored; an empty table has no nodes.
"""

from __future__ import annotations

import hashlib
import heapq
import struct
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sizing import broadcast_if_small
from ..operators.capacity import capacity_split
from ..session import write_scratch_table
from .common import share_code

SHARD = 50_000         # turns of a shard, and of a band of a long conversation
ROOM = 200_000         # messages in memory

# --- Fixed values: conversations share the head of the first one of their
# --- hundred, up to five turns.
FAMILY = 100
HEADS = 6


# ------------------------------------------------------------ conversations

def ordered_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                  role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows ``conv, k, h1, h2, chars``: the turns of every conversation
    numbered from 1, with a hash of role and text and the text's length."""
    rows = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ranked = capacity_split(rows, 1, order_by=("turn", "role", "text"), cell_col="conv")
    return write_scratch_table(ranked.select(
        "conv", F.col("cell_rank").alias("k"),
        *[F.xxhash64(F.lit(i), "role", "text").alias(f"h{i}") for i in (1, 2)],
        F.length("text").cast("long").alias("chars")), "trie-turns")


def shared_heads(turns: DataFrame, family: int = FAMILY, heads: int = HEADS) \
        -> tuple[DataFrame, DataFrame]:
    """Rebuilds every conversation: the first h turns of the first
    conversation of its family (all, if it has fewer), then its own after
    the first h, where h follows from a checksum of its id. Returns rows
    ``conv, p, h1, h2, chars`` with new places, and ``conv, n`` (turns left,
    possibly none) for every conversation."""
    sizes = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("own"))
    base = (F.col("conv") - F.col("conv") % family).alias("base")
    ids = sizes.select("conv", "own", base, (F.crc32(
        F.col("conv").cast("string").cast("binary")) % heads).alias("h"))
    have = sizes.select(F.col("conv").alias("base"), F.col("own").alias("base_own"))
    ids = ids.join(have, "base", "left").withColumn(
        "head", F.least("h", F.coalesce("base_own", F.lit(0))))
    ids = write_scratch_table(ids.withColumn(
        "n", F.col("head") + F.greatest(F.col("own") - F.col("h"), F.lit(0))), "trie-ids")
    first = turns.where(F.col("k") < heads).withColumnRenamed("conv", "base")
    head = (ids.where("head > 0").select("conv", "base", "head").join(first, "base")
            .where("k <= head").select("conv", F.col("k").alias("p"), "h1", "h2", "chars"))
    tail = turns.join(ids.select("conv", "h", "head"), "conv").where("k > h").select(
        "conv", (F.col("head") + F.col("k") - F.col("h")).alias("p"), "h1", "h2", "chars")
    return head.union(tail), ids.select("conv", "n")


# -------------------------------------------------------------------- nodes

def members(turns: DataFrame, ids: DataFrame, band: int = SHARD) -> DataFrame:
    """Rows ``conv, n, d, x1, x2, y1, y2, chars``: every conversation at every
    depth from 0, with the node's hash ``x``, its parent's ``y``, and the
    characters of the node's last turn."""
    terms = turns.select(
        "conv", "p", "chars", F.floor((F.col("p") - 1) / band).alias("band"),
        *[F.xxhash64(F.lit(10 + i), "p", "h1", "h2").alias(f"t{i}") for i in (1, 2)])
    inside = Window.partitionBy("conv", "band").orderBy("p").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    rows = terms.select("*", *[F.bit_xor(f"t{i}").over(inside).alias(f"x{i}") for i in (1, 2)])
    longest = ids.agg(F.max("n")).first()[0] or 0
    if longest > band:             # what the earlier bands of a conversation come to
        before = Window.partitionBy("conv").orderBy("band").rowsBetween(
            Window.unboundedPreceding, -1)
        bands = terms.groupBy("conv", "band").agg(
            *[F.bit_xor(f"t{i}").alias(f"b{i}") for i in (1, 2)])
        bands = bands.select("conv", "band", *[F.bit_xor(f"b{i}").over(before).alias(f"o{i}")
                                               for i in (1, 2)]).where("band > 0")
        rows = rows.join(bands, ["conv", "band"], "left")
        for i in (1, 2):
            rows = rows.withColumn(f"x{i}", F.col(f"x{i}").bitwiseXOR(
                F.coalesce(f"o{i}", F.lit(0).cast("long"))))
    rows = rows.join(ids, "conv").select(
        "conv", "n", F.col("p").alias("d"), "x1", "x2",
        *[F.col(f"x{i}").bitwiseXOR(F.col(f"t{i}")).alias(f"y{i}") for i in (1, 2)], "chars")
    zero = F.lit(0).cast("long")
    roots = ids.select("conv", "n", zero.alias("d"), zero.alias("x1"), zero.alias("x2"),
                       zero.alias("y1"), zero.alias("y2"), zero.alias("chars"))
    return write_scratch_table(rows.union(roots), "trie-members")


_NODE = ["d", "x1", "x2"]


def nodes_of(rows: DataFrame) -> DataFrame:
    """One row per node: ``d, x1, x2, y1, y2, rep`` (smallest member),
    ``n_convs, own`` (characters saved at it), ``weight`` (turns in its
    subtree, once a member)."""
    return write_scratch_table(rows.groupBy(*_NODE).agg(
        F.min("conv").alias("rep"), F.count(F.lit(1)).alias("n_convs"),
        F.sum(F.col("n") - F.col("d") + 1).alias("weight"),
        *[F.min(c).alias(c) for c in ("y1", "y2", "chars")])
        .withColumn("own", (F.col("n_convs") - 1) * F.col("chars")).drop("chars"), "trie-nodes")


# --------------------------------------------------- time-forward processing

class SpillingQueue:
    """A priority queue of messages ``(key, children, leaves, saved)``, where
    the key is three numbers. At most ``room`` messages are in memory; the
    later half of more is written out as a sorted run."""

    _FORM = struct.Struct("<6q")

    def __init__(self, room: int = ROOM):
        self.room, self.heap, self.runs, self.files = room, [], [], []

    def push(self, message: tuple) -> None:
        heapq.heappush(self.heap, message)
        if len(self.heap) > self.room:
            self.heap.sort()
            half = len(self.heap) // 2
            file = tempfile.TemporaryFile()          # has no name, goes with the task
            for m in self.heap[half:]:
                file.write(self._FORM.pack(*m))
            del self.heap[half:]
            file.seek(0)
            self.files.append(file)
            self._refill(len(self.files) - 1)

    def _refill(self, run: int) -> None:
        record = self.files[run].read(self._FORM.size)
        if record:
            heapq.heappush(self.runs, (self._FORM.unpack(record), run))
        else:
            self.files[run].close()

    def take(self, key: tuple) -> tuple[int, int, int]:
        """Sums over all messages of the key, which no waiting message's
        precedes."""
        children = leaves = saved = 0
        while True:
            if self.heap and self.heap[0][:3] == key:
                message = heapq.heappop(self.heap)
            elif self.runs and self.runs[0][0][:3] == key:
                message, run = heapq.heappop(self.runs)
                self._refill(run)
            else:
                return children, leaves, saved
            children += message[3]
            leaves += message[4]
            saved += message[5]


_OUT = ("d bigint, x1 bigint, x2 bigint, y1 bigint, y2 bigint, rep bigint, n_convs bigint, "
        "top boolean, n_children bigint, n_leaves bigint, saved bigint")


def _time_forward(nodes: DataFrame, room: int) -> DataFrame:
    """Totals of the nodes ``d, x1, x2, y1, y2, rep, n_convs, own, top`` with
    what comes from outside, ``in_children, in_leaves, in_saved``. Within a
    partition the nodes are in reverse level order; a node that is not
    ``top`` has its parent there too."""
    share_code(nodes.sparkSession)

    def run(batches):
        queue = SpillingQueue(room)
        for batch in batches:
            c = {n: batch.column(n).to_pylist() for n in batch.schema.names}
            totals = []
            for d, x1, x2, y1, y2, own, top, children, leaves, saved in zip(
                    *[c[n] for n in ("d", "x1", "x2", "y1", "y2", "own", "top", "in_children",
                                     "in_leaves", "in_saved")]):
                more = queue.take((-d, x1, x2))
                children += more[0]
                leaves += more[1]
                saved += more[2] + own
                if not children:
                    leaves = 1
                if not top:
                    queue.push((1 - d, y1, y2, 1, leaves, saved))
                totals.append((children, leaves, saved))
            done = [pa.array(x, pa.int64()) for x in zip(*totals)] if totals else \
                [pa.array([], pa.int64())] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in ("d", "x1", "x2", "y1", "y2", "rep", "n_convs", "top")]
                + done, ["d", "x1", "x2", "y1", "y2", "rep", "n_convs", "top", "n_children",
                         "n_leaves", "saved"])

    return nodes.sortWithinPartitions(F.desc("d"), "x1", "x2").mapInArrow(run, _OUT)


def subtree_totals(nodes: DataFrame, rows: DataFrame, shard: int = SHARD,
                   room: int = ROOM) -> DataFrame:
    """Rows ``d, x1, x2, y1, y2, rep, n_convs, n_children, n_leaves,
    saved``: within the shards first, then over the shard roots."""
    is_large = (F.col("d") == 0) | ((F.col("weight") > shard) & (F.col("n_convs") > 1))
    zero = F.lit(0).cast("long")
    large = nodes.where(is_large)
    # The first depth at which a conversation's node is not large, and that node.
    cuts = (rows.join(broadcast_if_small(large.select(*_NODE)), _NODE, "left_semi")
            .groupBy("conv").agg((F.max("d") + 1).alias("cut")))
    cuts = (rows.join(cuts, "conv").where("d = cut")
            .select(F.col("conv").alias("rep"), "cut", F.col("x1").alias("s1"),
                    F.col("x2").alias("s2")))
    below = F.col("d") - F.col("cut")
    # The last node of a band has its one child in the next band.
    open_end = ((below % shard == shard - 1) & (F.col("weight") > 1)).cast("long")
    small = nodes.where(~is_large).join(cuts, "rep").select(
        *_NODE, "y1", "y2", "rep", "n_convs", "own",
        (below % shard == 0).alias("top"),
        open_end.alias("in_children"), open_end.alias("in_leaves"), zero.alias("in_saved"),
        "s1", "s2", "cut", F.floor(below / shard).alias("band"))
    inside = write_scratch_table(
        _time_forward(small.repartition("cut", "s1", "s2", "band"), room), "trie-inside")
    # Shard roots hand over to large parents; bands of one conversation have
    # done so already.
    up = (inside.where("top").groupBy((F.col("d") - 1).alias("d"), F.col("y1").alias("x1"),
                                      F.col("y2").alias("x2"))
          .agg(F.count(F.lit(1)).alias("in_children"), F.sum("n_leaves").alias("in_leaves"),
               F.sum("saved").alias("in_saved")))
    top = large.join(up, _NODE, "left").select(
        *_NODE, "y1", "y2", "rep", "n_convs", "own", (F.col("d") == 0).alias("top"),
        *[F.coalesce(c, zero).alias(c) for c in ("in_children", "in_leaves", "in_saved")])
    across = write_scratch_table(_time_forward(top.repartition(1), room), "trie-across")
    return inside.union(across).drop("top")


# ------------------------------------------------------------------- output

def end_digests(rows: DataFrame) -> DataFrame:
    """Rows ``d, x1, x2, ends_sha256``: the digest of the ids of the
    conversations that end at a node, in decimal, ascending, joined by
    commas. The ids stream through, however many there are."""
    share_code(rows.sparkSession)
    ends = rows.where("d = n").select(*_NODE, "conv")

    def run(batches):
        key, digest, done = None, None, []
        for batch in batches:
            cols = [batch.column(n).to_numpy(zero_copy_only=False) for n in (*_NODE, "conv")]
            change = np.zeros(batch.num_rows, bool)
            for col in cols[:3]:
                change[1:] |= col[1:] != col[:-1]
            starts = np.flatnonzero(change | (np.arange(batch.num_rows) == 0)).tolist()
            for s, e in zip(starts, [*starts[1:], batch.num_rows]):
                own = tuple(int(col[s]) for col in cols[:3])
                if own != key:
                    if key is not None:
                        done.append((*key, digest.hexdigest()))
                    key, digest = own, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(",".join(map(str, cols[3][s:e].tolist())).encode())
            yield _digest_rows(done)
            done = []
        if key is not None:
            yield _digest_rows([(*key, digest.hexdigest())])

    return (ends.repartition(*_NODE).sortWithinPartitions(*_NODE, "conv")
            .mapInArrow(run, "d bigint, x1 bigint, x2 bigint, ends_sha256 string"))


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[], [], [], []]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.string()))],
        ["d", "x1", "x2", "ends_sha256"])


def prefix_trie(turns: DataFrame, ids: DataFrame, shard: int = SHARD,
                room: int = ROOM) -> DataFrame:
    """One row per node of the trie of the conversations ``ids`` (``conv,
    n``) with turns ``conv, p, h1, h2, chars``: ``conv_id`` (smallest
    member), ``depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256``."""
    rows = members(turns, ids, shard)
    totals = subtree_totals(nodes_of(rows), rows, shard, room)
    parents = totals.where("n_children > 0").select(
        (F.col("d") + 1).alias("d"), F.col("x1").alias("y1"), F.col("x2").alias("y2"),
        F.col("rep").alias("parent_conv_id"))
    none = hashlib.sha256(b"").hexdigest()
    return (totals.join(parents, ["d", "y1", "y2"], "left").join(end_digests(rows), _NODE, "left")
            .select(F.col("rep").alias("conv_id"), F.col("d").alias("depth"), "parent_conv_id",
                    "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256")))
