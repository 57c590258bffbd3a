"""Prefix trie of conversations, with subtree totals by time-forward processing.

A conversation is a path of turns; conversations that begin alike share nodes. A node is named by
its depth and a digest of its path: the turns' SHA-256 lanes times powers of an odd constant, added
modulo 2^64 in two lanes, so a conversation that lies in several partitions is summed in each of
them and put together from one small row per partition. No text is shuffled.

Totals flow from the leaves up. Nodes are sorted by reverse level order, and each sends its own
total to its parent through a priority queue ordered like the nodes; when a parent's turn comes, the
messages for it lead the queue. The queue keeps a bounded number of messages in memory and spills
the rest as sorted runs. The trie is cut into shards, the subtrees below the nodes with many
conversations: shards are dealt out by their root and run side by side, the totals of shard roots
are added by parent, and the nodes above, whose number `CUT` bounds, are run last. A first turn that
a third of all conversations share is thus one of the upper nodes and gathers nothing in one task.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.llm.common import stored

CUT = 4096  # a node with more than one in so many of all turns below it stands above the shards
LEAST_SHARD = 8  # conversations that a shard may hold whatever the number of turns
QUEUE = 200_000  # messages that a queue keeps in memory
SHARED_TURNS = 8  # most turns that `members` takes from another conversation
CHUNK = 4096  # ids of conversations that end at a node, joined in one row

_ODD = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)  # one per lane
_MASK = (1 << 64) - 1
KEY = ["depth", "k1", "k2"]
TURN = ["conv_id", "pos", "k1", "k2", "q1", "q2", "bytes"]


def _signed(x: int) -> int:
    x &= _MASK
    return x - (1 << 64) if x >> 63 else x


def _power(lane: int, n: int) -> int:
    return pow(_ODD[lane], n, 1 << 64)


def positions(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Every turn with its place in its conversation: `conv_id`, `pos` from 1, and the columns of `TURN`.

    Turns are ordered by number, null first; turns of one number by their digest, so that the order
    is the same in every run, and rows that repeat are turns of their own. `k1`, `k2` are the digest
    of the conversation up to the turn, `q1`, `q2` up to the turn before, `bytes` the length of its
    text. Null roles and texts count as empty; rows without a conversation are left out.
    """
    role_text = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role_text[0]).cast("string"), F.lit(":"), *role_text), 256))
    rows = turns.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"), digest.alias("digest"), F.octet_length(role_text[1]).cast("long").alias("bytes")
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest")]
    # ranges, not hashes, so that one conversation may spread over many tasks
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Places and sums within the partition; in the last row what its last conversation has come to."""
        part, first, last, place, sums = TaskContext.get().partitionId(), None, None, 0, [0, 0]
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            conv = batch.column("conv_id").to_numpy(zero_copy_only=False)
            digests = np.frombuffer(b"".join(batch.column("digest").to_pylist()), "<u8").reshape(n, 4)
            starts = np.concatenate(([0], 1 + np.flatnonzero(conv[1:] != conv[:-1])))
            run = np.repeat(np.arange(len(starts)), np.diff([*starts, n]))
            pos = 1 + np.arange(n) - starts[run]
            head = slice(0, starts[1] if len(starts) > 1 else n) if conv[0] == last else slice(0, 0)  # goes on from before
            keys, before = [], []
            for lane in (0, 1):
                powers = np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(n, _ODD[lane], np.uint64))))[pos]
                powers[head] *= np.uint64(_power(lane, place))
                added = digests[:, lane] * powers
                whole = np.add.accumulate(added)
                key = whole - (whole - added)[starts][run]
                key[head] += np.uint64(sums[lane])
                keys.append(key)
                before.append(key - added)
            pos[head] += place
            first, last, place, sums = int(conv[0]) if first is None else first, int(conv[-1]), int(pos[-1]), [int(k[-1]) for k in keys]
            columns = [pos, *[x.view(np.int64) for x in (*keys, *before)]]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, part, np.int32)), batch.column("conv_id"), *map(pa.array, columns), batch.column("bytes"), pa.nulls(n, pa.int64())], names=names)
        if last is not None:
            row = (part, last, place, *map(_signed, sums), 0, 0, None, first)
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64() if i else pa.int32()) for i, x in enumerate(row)], names=names)

    names = ["part", *TURN, "first"]
    found = stored(ranged.mapInArrow(number, "part int, " + ", ".join(f"{c} long" for c in (*TURN, "first"))), "trie-turns")
    # one row per partition, not per conversation: how far the conversation open at its start has come
    carried: dict[int, tuple[int, int, int, int]] = {}
    open_conv, place, sums = None, 0, [0, 0]
    for row in sorted(found.where("bytes is null").collect(), key=lambda r: (r["first"], r["part"])):
        if row["first"] == open_conv:
            carried[row["part"]] = (row["first"], place, *sums)
        goes_on = row["conv_id"] == open_conv
        sums = [((sums[i] if goes_on else 0) + row[k] * (_power(i, place) if goes_on else 1)) & _MASK for i, k in enumerate(("k1", "k2"))]
        place = row["pos"] + (place if goes_on else 0)
        open_conv = row["conv_id"]
    found = found.where("bytes is not null")
    if carried:
        found = _continued(found, carried)
    return found.select(*TURN)


def _continued(found: DataFrame, carried: dict[int, tuple[int, int, int, int]]) -> DataFrame:
    """Places and digests of the conversations that began in an earlier partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, conv, pos, *keys = [batch.column(c).to_numpy(zero_copy_only=False).copy() for c in ("part", *TURN[:-1])]
            for p in np.unique(part):
                if int(p) in carried:
                    of, place, *sums = carried[int(p)]
                    ours = (part == p) & (conv == of)
                    pos[ours] += place
                    for i, key in enumerate(keys):
                        lane = i % 2
                        key[ours] = (key[ours].view(np.uint64) * np.uint64(_power(lane, place)) + np.uint64(sums[lane])).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (conv, pos, *keys)] + [batch.column("bytes")], names=TURN)

    return found.mapInArrow(run, ", ".join(f"{c} long" for c in TURN))


MEMBER = "conv_id long, depth long, k1 long, k2 long, p1 long, p2 long, bytes long, ends boolean"


def members(turns: DataFrame, base: Column | None = None, shared: Column | None = None) -> DataFrame:
    """The nodes on the path of each conversation, root included, one row each, from `positions`.

    With `base` and `shared`, expressions of `conv_id`, the path of a conversation begins with the
    first `shared` turns (8 at most) of conversation `base` and goes on with its own turns after as
    many. `p1`, `p2` name the parent, `bytes` is the length of the node's text, `ends` tells
    whether the conversation ends there.
    """
    base = F.col("conv_id") if base is None else base
    shared = F.lit(0) if shared is None else F.least(shared, F.lit(SHARED_TURNS))
    heads = turns.groupBy("conv_id").agg(
        F.max("pos").alias("n"),
        *[F.max(F.when(F.col("pos") == i, F.col(c))).alias(f"{c}_{i}") for i in range(1, SHARED_TURNS + 1) for c in ("k1", "k2", "bytes")],
    )
    heads = stored(heads, "trie-heads")
    other = heads.select([F.col(c).alias(f"base_{c}") for c in heads.columns])
    plans = heads.withColumns({"base": base.cast("long"), "shared": shared.cast("long")}).join(other, F.col("base") == F.col("base_conv_id"), "left")

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Root and the turns taken from the base; `cut`, `taken`, `own` and `from` for the conversation's own."""
        for batch in batches:
            rows: list[tuple] = []
            for row in batch.to_pylist():
                n, h = row["n"], row["shared"]
                k = min(h, row["base_n"] or 0)
                total = k + max(0, n - h)
                path = [(0, 0, 0)] + [(row[f"base_k1_{i}"], row[f"base_k2_{i}"], row[f"base_bytes_{i}"]) for i in range(1, k + 1)]
                own = (row[f"k1_{h}"], row[f"k2_{h}"]) if 0 < h < n else (0, 0)
                for d, (k1, k2, size) in enumerate(path):
                    up = path[d - 1] if d else (0, 0, 0)
                    last = d == k and total > k  # the row that the conversation's own turns continue
                    rows.append((row["conv_id"], d, k1, k2, up[0], up[1], size, d == total, h if last else None, own[0], own[1]))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)] if rows else [pa.nulls(0, t) for t in types], names=names)

    names = ["conv_id", "depth", "k1", "k2", "p1", "p2", "bytes", "ends", "cut", "o1", "o2"]
    types = [pa.int64()] * 7 + [pa.bool_()] + [pa.int64()] * 3
    begun = stored(plans.mapInArrow(begin, MEMBER + ", cut long, o1 long, o2 long"), "trie-begun")
    goes_on = begun.where("cut is not null").select("conv_id", F.col("depth").alias("taken"), F.col("k1").alias("f1"), F.col("k2").alias("f2"), "cut", "o1", "o2")
    lengths = heads.select(F.col("conv_id").alias("__conv"), "n")
    goes_on = goes_on.join(lengths, F.col("conv_id") == F.col("__conv")).drop("__conv").withColumnRenamed("conv_id", "__conv")
    tail = turns.join(goes_on, F.col("conv_id") == F.col("__conv")).where("pos >= cut")

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Digest of a path = that of the taken turns + (own digest - own digest at the cut) moved to its place."""
        for batch in batches:
            at = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names}
            moved, keys = at["taken"] - at["cut"], {}
            for lane, (cut, begun) in enumerate((("o1", "f1"), ("o2", "f2"))):
                powers = {int(m): pow(_ODD[lane], int(m), 1 << 64) for m in np.unique(moved)}
                power = np.array([powers[m] for m in moved.tolist()], np.uint64)
                for mine, made in ((f"k{lane + 1}", f"k{lane + 1}"), (f"q{lane + 1}", f"p{lane + 1}")):
                    keys[made] = (at[begun].view(np.uint64) + (at[mine].view(np.uint64) - at[cut].view(np.uint64)) * power).view(np.int64)
            made = (at["conv_id"], at["pos"] + moved, keys["k1"], keys["k2"], keys["p1"], keys["p2"], at["bytes"], at["pos"] == at["n"])
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in made], names=names[:8])

    own = tail.where("pos > cut").select(*TURN, "taken", "cut", "f1", "f2", "o1", "o2", "n").mapInArrow(follow, MEMBER)
    return begun.select(*names[:8]).unionByName(own)


class Queue:
    """Smallest first, with at most `most` items in memory; the rest lies in sorted runs on disk."""

    def __init__(self, most: int):
        self.most, self.heap, self.runs = most, [], []

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.most:
            run = self._read(self._write(sorted(self.heap)))
            heapq.heappush(self.runs, (next(run), len(self.runs), run))
            self.heap = []

    @staticmethod
    def _write(items: list[tuple]) -> Any:
        file = tempfile.TemporaryFile()  # the task's own, gone with it, like what Spark's sorts spill
        for start in range(0, len(items), 1000):
            pickle.dump(items[start : start + 1000], file)
        file.seek(0)
        return file

    @staticmethod
    def _read(file: Any) -> Iterator[tuple]:
        with file:
            while True:
                try:
                    yield from pickle.load(file)
                except EOFError:
                    return

    def __bool__(self) -> bool:
        return bool(self.heap or self.runs)

    def first(self) -> tuple:
        return min(x for x in (self.heap[:1] + [r[0] for r in self.runs[:1]]))

    def pop(self) -> tuple:
        if not self.runs or self.heap and self.heap[0] < self.runs[0][0]:
            return heapq.heappop(self.heap)
        item, number, run = self.runs[0]
        following = next(run, None)
        if following is None:
            heapq.heappop(self.runs)
        else:
            heapq.heapreplace(self.runs, (following, number, run))
        return item


NODE = ["shard", "depth", "k1", "k2", "p1", "p2", "conv_id", "n_convs", "own_saved", "in_children", "in_leaves", "in_saved"]
TOTALS = ["conv_id", "depth", "k1", "k2", "p1", "p2", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]


def forward(nodes: DataFrame, most: int = QUEUE) -> DataFrame:
    """Totals of nodes (`NODE`) that are sorted by shard and reverse level order within their partition.

    A node is returned when its parent has taken its message, with the parent's `conv_id`; one whose
    parent is not in its shard comes back at the end of the shard, without it (`above` true).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue, shard, done = Queue(most), None, []

        def rest() -> None:
            while queue:
                done.append((*queue.pop()[3:], None, True))

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)
            done.clear()
            return batch

        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in NODE]):
                if row[0] != shard:
                    rest()
                    shard = row[0]
                _, depth, k1, k2, p1, p2, conv, n_convs, saved, children, leaves, below = row
                place = (-depth, k1, k2)
                while queue and queue.first()[:3] == place:
                    child = queue.pop()[3:]
                    children, leaves, below = children + 1, leaves + child[-2], below + child[-1]
                    done.append((*child, conv, False))
                queue.push((1 - depth, p1, p2, conv, depth, k1, k2, p1, p2, n_convs, children, leaves or 1, saved + below))
                if len(done) >= 10_000:
                    yield flush()
        rest()
        if done:
            yield flush()

    names = ["conv_id", "depth", "k1", "k2", "p1", "p2", "n_convs", "n_children", "n_leaves", "saved_tokens", "parent_conv_id", "above"]
    types = [pa.int64()] * 11 + [pa.bool_()]
    return nodes.select(*NODE).mapInArrow(run, ", ".join(f"{c} {'boolean' if c == 'above' else 'long'}" for c in names))


def ends(paths: DataFrame) -> DataFrame:
    """`depth`, `k1`, `k2` and `ends_sha256` of the nodes at which conversations end.

    The digest of many ids has to be taken in their order, so ids are first joined in runs of
    `CHUNK`, wherever they lie, and what meets in the task of a node is a run per row, streamed.
    """
    order = [*KEY, "conv_id"]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            key, ids = None, []
            for *at, conv in zip(*[batch.column(c).to_pylist() for c in order]):
                if at != key or len(ids) >= CHUNK:
                    if ids:
                        rows.append((*key, ids[0], ",".join(map(str, ids))))
                    key, ids = at, []
                ids.append(conv)
            if ids:
                rows.append((*key, ids[0], ",".join(map(str, ids))))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=[*order, "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, hashed = None, None
        for batch in batches:
            rows: list[tuple] = []
            for *at, ids in zip(*[batch.column(c).to_pylist() for c in (*KEY, "ids")]):
                if at != key:
                    if key is not None:
                        rows.append((*key, hashed.hexdigest()))
                    key, hashed = at, hashlib.sha256(ids.encode())
                else:
                    hashed.update(b"," + ids.encode())
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=[*KEY, "ends_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, hashed.hexdigest())], names=[*KEY, "ends_sha256"])

    ended = paths.where("ends").select(*order)
    runs = ended.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(join, "depth long, k1 long, k2 long, conv_id long, ids string")
    return runs.repartition(*KEY).sortWithinPartitions(*order).mapInArrow(digest, "depth long, k1 long, k2 long, ends_sha256 string")


def trie(paths: DataFrame, cut: int = CUT, queue: int = QUEUE) -> DataFrame:
    """One row for each node of the paths (`members`), named by its smallest member and its depth.

    `conv_id`, `depth`, `parent_conv_id` (null for the root), `n_convs`, `n_children`, `n_leaves`
    (nodes without children in the subtree), `saved_tokens` (over the subtree, text bytes that all
    but one member repeat), `ends_sha256` (of the ids that end there, ascending). Without paths
    there is no node. One conversation is one chain and is run through by one task, in bounded memory.
    """
    paths = stored(paths, "trie-paths")
    total = paths.count()
    nodes = paths.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.max("bytes").alias("bytes")
    )
    nodes = stored(nodes, "trie-nodes").withColumn("own_saved", (F.col("n_convs") - 1) * F.col("bytes"))
    # fewer than `cut` nodes have more than total / cut members
    limit = max(LEAST_SHARD, total // cut)
    upper = nodes.where(F.col("n_convs") > limit)
    marks = F.broadcast(upper.select(*[F.col(c).alias(f"u_{c}") for c in (*KEY, "conv_id")]))
    is_upper = (F.col("depth") == F.col("u_depth")) & (F.col("k1") == F.col("u_k1")) & (F.col("k2") == F.col("u_k2"))
    low = paths.join(marks, is_upper, "left").where("u_depth is null")
    # the subtree of a conversation: depth and digest of the first node on its path that is not above
    shards = low.groupBy(F.col("conv_id").alias("__conv")).agg(F.min(F.shiftleft("depth", 32).bitwiseOR(F.col("k1").bitwiseAND(0xFFFFFFFF))).alias("shard"))
    none = {c: F.lit(0).cast("long") for c in ("in_children", "in_leaves", "in_saved")}
    light = nodes.where(F.col("n_convs") <= limit).join(shards, F.col("conv_id") == F.col("__conv")).withColumns(none)
    reverse = ["shard", F.col("depth").desc(), "k1", "k2"]
    below = stored(forward(light.repartition("shard").sortWithinPartitions(*reverse), queue), "trie-below")

    roots = below.where("above and depth > 0")
    sums = roots.groupBy((F.col("depth") - 1).alias("u_depth"), F.col("p1").alias("u_k1"), F.col("p2").alias("u_k2")).agg(
        F.count("*").alias("in_children"), F.sum("n_leaves").alias("in_leaves"), F.sum("saved_tokens").alias("in_saved")
    )
    met = upper.join(sums, is_upper, "left").fillna(0, ["in_children", "in_leaves", "in_saved"]).withColumn("shard", F.lit(0).cast("long"))
    above = forward(met.repartition(1).sortWithinPartitions(*reverse), queue)  # fewer than `cut` rows

    parents = (F.col("depth") - 1 == F.col("u_depth")) & (F.col("p1") == F.col("u_k1")) & (F.col("p2") == F.col("u_k2"))
    joined = roots.drop("parent_conv_id").join(marks, parents).withColumn("parent_conv_id", F.col("u_conv_id"))
    found = below.where("not above or depth = 0").select(*TOTALS).unionByName(joined.select(*TOTALS)).unionByName(above.select(*TOTALS))
    ended = ends(paths).select(*[F.col(c).alias(f"e_{c}") for c in KEY], "ends_sha256")
    found = found.join(ended, (F.col("depth") == F.col("e_depth")) & (F.col("k1") == F.col("e_k1")) & (F.col("k2") == F.col("e_k2")), "left")
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
