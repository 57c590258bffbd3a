"""Documents whose word n-gram sets are similar, as connected components, by a token-group matrix.

Similar documents are partitioned into groups first. Tokens have one order, by hash; two linked sets
agree in so many of their first tokens (`prefix`, `least_shared`), so only documents that share
enough of those with others go on, and each joins the group of the document, its leader, that it
shares most of them with. A group holds its leader and a bounded number of members, so a leader that
a third of all documents follow has many groups, which its own set connects.

The matrix holds the token union of each group. A document that queries a group is bounded by its
overlap with the union: no member can share more. Only a group whose bound qualifies is opened, and
the query is compared with its members, one class of connected members after the other. Documents
query their own group as they join it. Then those that still share enough first tokens with
documents of another component are queries to the groups of these.

Equal sets are one set with a digest of 128 bits; the others are linked by comparing them.
"""

from __future__ import annotations

import contextlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymill.llm.common import discard, in_mask, mask, mask_place, stored, tidy

BLOCK = 4000  # documents whose first tokens are combined before they are shuffled
SHARES = (4, 48, 24)  # see `_spare`
GROUP = 64  # members of a group of the matrix


_STEP = np.uint64(0x9E3779B97F4A7C15)
PIECE = 1 << 14  # bytes of a text whose words are hashed at a time
_SPACES = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
_BYTES = np.random.default_rng(8).integers(1, 1 << 63, 256, np.uint64) * ~_SPACES  # a number for each byte, 0 for white space
_BASE = 0xD6E8FEB86659FD93
_UNBASE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    made = np.full(n, base, np.uint64)
    made[:1] = 1
    return np.multiply.accumulate(made)


_POWERS = (_powers(_BASE, PIECE), _powers(_UNBASE, PIECE))


def _mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    x = (x ^ np.uint64(salt * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _pieces(data: bytes) -> Iterator[bytes]:
    """`data` cut at white space into pieces of about `PIECE` bytes; only a longer word makes a longer piece."""
    start = 0
    while len(data) - start > PIECE:
        end = start + PIECE
        while end < len(data) and not _SPACES[data[end]]:
            end += 1
        yield data[start:end]
        start = end
    yield data[start:]


def _word_hashes(piece: bytes) -> np.ndarray:
    """A hash of each word, a polynomial in its bytes, from sums over all bytes of the piece."""
    codes = np.frombuffer(piece, np.uint8)
    n = len(codes)
    up, down = _POWERS if n <= PIECE else (_powers(_BASE, n), _powers(_UNBASE, n))
    values = np.zeros(n + 2, np.uint64)  # white space is 0, and so are both ends
    values[1:-1] = _BYTES[codes]
    space = values == 0
    edge = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edge[::2], edge[1::2]
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values[1:-1] * up[:n], out=sums[1:])
    return _mix((sums[ends] - sums[starts]) * down[starts])


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the text's word n-grams; a shorter text is one n-gram, an empty one none."""
    data = (text or "").encode("utf-8", "replace").lower()  # of bytes: A-Z only, ASCII white space
    hashed = np.concatenate([_word_hashes(p) for p in _pieces(data)])
    n = min(width, len(hashed))
    if not n:
        return hashed
    places = len(hashed) - n + 1
    total = hashed[:places].copy()
    for k in range(1, n):
        total *= _STEP
        total += hashed[k : k + places]
    total = _mix(total, n)
    total.sort()
    return total[np.r_[True, total[1:] != total[:-1]]]


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether 100 x intersection >= percent x union, for sorted sets that are not empty."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = _overlap(x, y)
    return 100 * both >= percent * (len(x) + len(y) - both)


def _overlap(x: np.ndarray, y: np.ndarray) -> int:
    if not len(x) or not len(y):
        return 0
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum())


def _common(n: int, percent: int) -> int:
    """The fewest tokens that a set of n shares with any that it is linked with."""
    return -(-n * percent // 100)


def _spare(n: int) -> int:
    """First tokens beyond those that find a link at all, so that more than one has to agree.

    A quarter for short sets, of which one common line is a large part, then fewer; never falls with n.
    """
    few, most, many = SHARES
    return max(1, min(n // few, most), n // many)


def least_shared(n: int, percent: int) -> int:
    """How many of its first tokens a set of n shares at least with the first ones of any set that it is linked with."""
    return _spare(_common(n, percent))


def prefix(tokens: np.ndarray, percent: int) -> np.ndarray:
    """The first tokens of a set, in the order of their hashes.

    Linked sets x and y share `_common` tokens or more. The first k of those, in order, are followed
    by all the others in both sets, so they stand among the first n - common + k of each.
    """
    n = len(tokens)
    return tokens[: n - _common(n, percent) + _spare(n)]


def _sets(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int | None, np.ndarray]]:
    for node, text in zip(batch.column(0), batch.column(1), strict=True):
        yield node.as_py(), shingles(text.as_py(), width)


def _facts(width: int):
    """Size and digests of every document's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [(len(t), xxhash.xxh128_digest(t.tobytes())) for _, t in _sets(batch, width)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([n for n, _ in made], pa.int64()), pa.array([d for _, d in made], pa.binary())], ["node", "n_shingles", "digest"])

    return run


def _placed(width: int, percent: int):
    """(sig, node, leader, shared) for blocks of documents; `sig` is one of the node's first tokens.

    A token's other nodes stand under their leader of the block, whose own row says so by `shared`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sigs: list[np.ndarray] = []
        nodes: list[int] = []
        seen: dict[bytes, int] = {}

        def flush() -> pa.RecordBatch:
            sig = np.concatenate(sigs).view(np.int64)
            node = np.repeat(np.array(nodes, np.int64), [len(s) for s in sigs])
            order = np.lexsort((node, sig))
            sig, node = sig[order], node[order]
            fresh = np.r_[True, (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])]
            sig, node = sig[fresh], node[fresh]
            first = np.r_[True, sig[1:] != sig[:-1]]
            leader = node[first][np.cumsum(first) - 1]
            shared = np.add.reduceat(np.ones(len(sig), np.int64), np.flatnonzero(first))[np.cumsum(first) - 1] > 1
            for kept in (sigs, nodes, seen):
                kept.clear()
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (sig, node, leader, shared)], ["sig", "node", "leader", "shared"])

        for batch in batches:
            for node, tokens in _sets(batch, width):
                data = xxhash.xxh128_digest(tokens.tobytes())
                if node is None or not len(tokens) or seen.get(data, node + 1) <= node:
                    continue  # an equal set of a smaller id is signed; the two are linked by their digest
                seen[data] = node
                sigs.append(prefix(tokens, percent))
                nodes.append(node)
                if len(nodes) >= BLOCK:
                    yield flush()
        if nodes:
            yield flush()

    return run


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of tokens that several nodes share, under the smallest node; input sorted by token and node.

    A token's rows may go through many batches: only its leader is held, and whether it has gone out.
    """
    names = ["sig", "node", "leader"]
    sig = leader = None
    waiting = False  # the leader's row goes out when a second node comes
    for batch in batches:
        s, n, own, shared = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        passed = n != own  # already under a leader of their block
        if passed.any():
            yield pa.RecordBatch.from_arrays([pa.array(x[passed]) for x in (s, n, own)], names)
            s, n, shared = s[~passed], n[~passed], shared[~passed]
        if not len(s):
            continue
        goes_on = sig is not None and s[0] == sig
        if goes_on and waiting:  # put the leader before its second node
            s, n, shared, goes_on = np.r_[sig, s], np.r_[leader, n], np.r_[False, shared], False
        first = np.r_[True, s[1:] != s[:-1]]
        at, group = np.flatnonzero(first), np.cumsum(first) - 1
        heads = n[first].copy()
        if goes_on:
            heads[0] = leader
        leaders = heads[group]
        many = np.logical_or.reduceat((n != leaders) | shared, at)
        many[0] |= goes_on
        fresh = first | (s != np.r_[s[:1], s[:-1]]) | (n != np.r_[n[:1], n[:-1]])  # a node of two blocks counts once
        out = many[group] & fresh
        if out.any():
            yield pa.RecordBatch.from_arrays([pa.array(x[out]) for x in (s, n, leaders)], names)
        sig, leader, waiting = s[-1], leaders[-1], not many[-1]


def _sets_of(texts: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """(node, tokens) of the `ids`, one row per id and text. The mask keeps most other texts out of the join."""
    bits = texts.sparkSession.sparkContext.broadcast(mask(ids, "node"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(in_mask(bits.value, batch.column(2).to_numpy())))
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                tokens = [t.view(np.int64) for _, t in _sets(part, width)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(tokens, pa.list_(pa.int64()))], ["node", "tokens"])

    placed = texts.select("node", "text", mask_place(F.col("node")).alias("place"))
    return placed.mapInArrow(tidy(run), "node long, tokens array<long>").join(ids, "node", "left_semi")


def _only(sets: DataFrame, ids: DataFrame) -> DataFrame:
    """The sets of `ids`, and of few others: what a mask leaves, for joins that are exact without it."""
    bits = sets.sparkSession.sparkContext.broadcast(mask(ids, "node"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.select([0, 1]).filter(pa.array(in_mask(bits.value, batch.column(2).to_numpy())))

    return sets.select("node", "tokens", mask_place(F.col("node")).alias("place")).mapInArrow(tidy(run), "node long, tokens array<long>")


def _lists(column: pa.Array) -> list[np.ndarray]:
    """Sets of a list column, as unsigned numbers in order."""
    values, at = column.values.to_numpy(), column.offsets.to_numpy()
    return [values[a:z].view(np.uint64) for a, z in zip(at[:-1], at[1:], strict=True)]


def _group_links(percent: int, most: int):
    """Links (a, b) within the groups of a leader; input sorted by leader, salt, and the leader's own row first.

    Each document queries the group that it joins: unless its overlap with the group's union bounds
    it out, it is compared with the members, of each class until one is linked. A full group is left
    for a fresh one that begins with the leader again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, union = None, np.zeros(0, np.uint64)
        leaders: list[tuple[int, np.ndarray]] = []
        classes: list[list[tuple[int, np.ndarray]]] = []
        for batch in batches:
            found: list[tuple[int, int]] = []
            for leader, salt, node, tokens in zip(*[batch.column(c).to_pylist() for c in range(3)], _lists(batch.column(3)), strict=True):
                tokens = tokens.copy()  # not a view that keeps the batch
                if (leader, salt) != key:
                    key, leaders, classes = (leader, salt), [], []
                if node == leader:
                    leaders.append((node, tokens))
                    continue
                if not classes or sum(map(len, classes)) > most:
                    classes = [list(leaders)] if leaders else []  # one that shares too little with all has no set here
                    union = np.unique(np.concatenate([np.zeros(0, np.uint64), *[t for _, t in leaders]]))
                mine = [(node, tokens)]
                if 100 * _overlap(tokens, union) >= percent * len(tokens):
                    apart = []
                    for own in classes:
                        other = next((n for n, t in own if linked(tokens, t, percent)), None)
                        if other is None:
                            apart.append(own)
                        else:
                            found.append((node, other))
                            mine = own + mine
                    classes = [*apart, mine]
                else:
                    classes.append(mine)
                union = np.union1d(union, tokens)
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], ["a", "b"])

    return run


def _chosen(every: DataFrame) -> DataFrame:
    """(node, leader): the leader of most of the node's first tokens. `every`: sig, node, leader."""
    shared = every.where("node <> leader").groupBy("node", "leader").agg(F.count("*").alias("n"))
    best = F.max(F.struct("n", (-F.col("leader")).alias("minus")))["minus"]
    return shared.groupBy("node").agg((-best).alias("leader"))


def _within_groups(chosen: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of documents with the members of the group that they join."""
    sizes = chosen.groupBy("leader").agg(F.ceil(F.count("*") / (4 * GROUP)).cast("long").alias("salts"))
    member = chosen.join(sizes, "leader").select("leader", F.pmod(F.xxhash64("node"), "salts").alias("salt"), "node")
    heads = sizes.select("leader", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"), F.col("leader").alias("node"))
    rows = member.unionByName(heads).join(sets, "node").select("leader", "salt", "node", "tokens")
    order = ["leader", "salt", F.col("node") != F.col("leader"), "node"]
    return rows.repartition("leader", "salt").sortWithinPartitions(*order).mapInArrow(tidy(_group_links(percent, GROUP)), "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of `edges` (a, b): the label is the smallest node that it reaches.

    Labels spread to neighbours and then jump to the label of the label, until nothing changes.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    both = stored(both, "edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("m"))
        spread = labels.join(near, labels["node"] == near["a"]).select("node", F.col("label").alias("old"), F.least("label", "m").alias("label"))
        spread = stored(spread, "spread")
        at = spread.select(F.col("node").alias("label"), F.col("label").alias("next"))
        after = stored(spread.join(at, "label", "left").select("node", "old", F.coalesce("next", "label").alias("label")), "labels")
        discard(labels, spread)
        labels = after
        if after.where("old <> label").isEmpty():
            discard(both)
            return labels


BUCKETS = 256  # of a sketch


def _sketch(tokens: np.ndarray) -> bytes:
    """How many tokens fall in each bucket of their hash; larger numbers count as the largest there is."""
    return np.minimum(np.bincount((tokens >> np.uint64(20)).astype(np.int64) % BUCKETS, minlength=BUCKETS), 0xFFFF).astype("<u2").tobytes()


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = _lists(batch.column(1))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(map(len, sets)), pa.int64()), pa.array(list(map(_sketch, sets)), pa.binary())], ["node", "size", "sketch"])


def _open(percent: int, best: bool):
    """Pairs (a, b) of a query and a member of another label whose sketches do not rule out a link.

    With `best`, only the nearest member of each label.

    Input sorted by group, members first, so that a group is held once, whatever queries it. The
    union's sketch, the largest number of each bucket, bounds a query: what it has more in a bucket
    no member shares. Likewise for a pair: sets differ in the difference of their numbers at least.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key: list | None = None
        nodes: list[int] = []
        labels: list[int] = []
        sizes: list[int] = []
        sketches: list[np.ndarray] = []
        union = np.zeros(BUCKETS, np.int32)
        for batch in batches:
            found: list[tuple[int, int]] = []
            columns = [batch.column(c).to_pylist() for c in ("leader", "kind", "salt", "asks", "node", "label", "size", "sketch")]
            for *group, asks, node, label, size, sketch in zip(*columns, strict=True):
                if group != key:
                    key, nodes, labels, sizes, sketches, union = group, [], [], [], [], np.zeros(BUCKETS, np.int32)
                counts = np.frombuffer(sketch, "<u2").astype(np.int32)
                if not asks:
                    nodes.append(node)
                    labels.append(label)
                    sizes.append(size)
                    sketches.append(counts)
                    union = np.maximum(union, counts)
                    continue
                if not nodes or np.maximum(counts - union, 0).sum() > size - _common(size, percent):
                    continue
                apart = np.abs(np.stack(sketches) - counts).sum(axis=1)
                total = np.array(sizes) + size
                close = (apart <= total * (100 - percent) // (100 + percent)) & (np.array(labels) != label)
                at = np.flatnonzero(close)
                if best:  # of each label the first in the order of difference
                    at = at[np.argsort(apart[at], kind="stable")]
                    at = at[np.unique(np.array(labels)[at], return_index=True)[1]]
                found += [(node, nodes[i]) for i in at]
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], ["a", "b"])

    return run


def _verify(percent: int):
    """Pairs (a, b, their sets) that are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [linked(x, y, percent) for x, y in zip(_lists(batch.column(2)), _lists(batch.column(3)), strict=True)]
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    return run


@contextlib.contextmanager
def _batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Fewer rows in the batches that go to Python, for wide rows."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before) if int(before) > 0 else rows)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _still_mixed(named: DataFrame) -> DataFrame:
    """Rows of first tokens with several labels, of nodes that have enough of those for a link."""
    mixed = named.groupBy("sig").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("sig")
    rows = named.join(mixed, "sig", "left_semi")
    enough = rows.groupBy("node").agg(F.count("*").alias("n"), F.min("least").alias("least")).where("n >= least").select("node")
    return rows.join(enough, "node", "left_semi")


def _across_groups(named: DataFrame, chosen: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Labels (a, b) whose documents are linked. `named`: sig, node, label, least, the first tokens that several labels hold.

    Documents that share tokens with another label form groups with those that chose the same leader.
    The matrix has a row for each token of a group's union. Linked documents share `least` tokens or
    more, so of the tokens in the order of their frequency a query needs all but the last `least - 1`
    to meet a group that it could be linked with.
    """
    held = named.select("node", "label").distinct()
    sketches = sets.join(held.select("node"), "node", "left_semi").mapInArrow(tidy(_sketched), "node long, size long, sketch binary")
    # sizes of linked sets are at most a class apart
    kind = F.floor(F.log(F.col("size").cast("double")) / (1.000001 * math.log(100 / percent))).cast("int")
    own = held.join(chosen, "node", "left").withColumn("leader", F.coalesce("leader", "node")).join(sketches, "node").withColumn("kind", kind)
    sizes = own.groupBy("leader", "kind").agg(F.ceil(F.count("*") / GROUP).cast("long").alias("salts"))
    own = own.join(sizes, ["leader", "kind"]).withColumn("salt", F.pmod(F.xxhash64("node"), "salts")).drop("salts")
    own = stored(own.select("node", "label", "leader", "kind", "salt", "size", "sketch"), "members")
    counts = named.groupBy("sig").agg(F.count("*").alias("n"))
    ordered = named.join(counts, "sig").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("n", "sig"))).alias("sigs"), F.max("least").alias("least"))
    first = F.slice("sigs", 1, F.greatest(F.lit(1), F.size("sigs") - F.col("least").cast("int") + 1))
    tokens = stored(ordered.select("node", F.explode(first).alias("s")).select("node", F.col("s.sig").alias("sig")), "asked")
    places = own.select("node", "leader", "kind", "salt").distinct()
    matrix = tokens.join(places, "node").select("sig", "leader", "kind", "salt").distinct()
    near_kinds = F.explode(F.array(*[F.col("kind") + i for i in (-1, 0, 1)])).alias("kind")
    asked = tokens.join(own.select("node", near_kinds).distinct(), "node")
    opened = stored(asked.join(matrix, ["sig", "kind"]).select("node", "leader", "kind", "salt").distinct(), "opened")

    # one link joins two labels, so the likeliest are tried first, and all that these leave apart then
    label_of = stored(own.select("node", F.col("label").alias("now")).distinct(), "label-of")
    edges = None
    for best in (True, False):
        mine = own.drop("label").join(label_of, "node").withColumnRenamed("now", "label")
        asking = opened.join(mine.select("node", "label", "size", "sketch"), "node").withColumn("asks", F.lit(True))
        rows = mine.withColumn("asks", F.lit(False)).unionByName(asking)
        order = ["leader", "kind", "salt", "asks", "node"]
        near = rows.repartition("leader", "kind", "salt").sortWithinPartitions(*order).mapInArrow(tidy(_open(percent, best)), "a long, b long")
        near = stored(near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "near")
        some = stored(_only(sets, near.select(F.explode(F.array("a", "b")).alias("node"))), "some-sets")
        one = near.join(some.select(F.col("node").alias("a"), F.col("tokens").alias("x")), "a")
        two = one.join(some.select(F.col("node").alias("b"), F.col("tokens").alias("y")), "b").select("a", "b", "x", "y")
        found = two.mapInArrow(tidy(_verify(percent)), "a long, b long")
        found = found.join(label_of.select(F.col("node").alias("a"), F.col("now").alias("one")), "a")
        found = found.join(label_of.select(F.col("node").alias("b"), F.col("now").alias("two")), "b")
        found = stored(found.select(F.col("one").alias("a"), F.col("two").alias("b")).distinct(), "joined")
        edges = found if edges is None else edges.unionByName(found)
        discard(near, some)
        if best and not found.isEmpty():
            merged = components(found).select(F.col("node").alias("now"), F.col("label").alias("lower"))
            label_of = stored(label_of.join(merged, "now", "left").select("node", F.coalesce("lower", "now").alias("now")), "label-of")
    discard(own, tokens, opened)
    return edges


def components_of(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of `docs`: the id column, `n_shingles` and `component_id`, the smallest id reachable by links.

    Two documents link when 100 x intersection >= `percent` x union of their sets of distinct n-grams
    of `width` lower-case words (A-Z; words end at ASCII white space). A shorter text is one n-gram.
    A text without words has an empty set, and a null text likewise; neither is linked with anything.
    Documents are told apart by id, an integer: rows that repeat an id are one document whose texts
    all count. A null id is linked with nothing, and its component is null.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("node"), F.col(text_col).alias("text"))
    facts = stored(texts.mapInArrow(tidy(_facts(width)), "node long, n_shingles long, digest binary"), "facts")
    alike = facts.where("n_shingles > 0 and node is not null").groupBy("digest").agg(F.min("node").alias("first"), F.count("*").alias("n")).where("n > 1")
    same = stored(facts.join(alike, "digest").where("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b")).distinct(), "same")

    placed = texts.mapInArrow(tidy(_placed(width, percent)), "sig long, node long, leader long, shared boolean")
    key = F.when(F.col("node") == F.col("leader"), F.col("sig")).otherwise(F.xxhash64("sig", "node"))
    dealt = placed.repartition(key).sortWithinPartitions("sig", "node")
    every = stored(dealt.mapInArrow(tidy(_together), "sig long, node long, leader long"), "shared")
    common, (few, most, many) = F.ceil(F.col("n_shingles") * percent / 100), SHARES
    least = F.greatest(F.lit(1), F.least(F.floor(common / few), F.lit(most)), F.floor(common / many)).cast("long")  # as in `least_shared`
    needs = facts.where("n_shingles > 0").groupBy("node").agg(F.min(least).alias("least"))
    enough = every.groupBy("node").agg(F.count("*").alias("n")).join(needs, "node").where("n >= least").select("node", "least")
    nodes = stored(enough, "nodes")
    sets = stored(_sets_of(texts, nodes.select("node"), width), "sets")
    chosen = stored(_chosen(every).join(nodes.select("node"), "node"), "chosen")
    with _batches_of(docs.sparkSession, 500):
        links = stored(_within_groups(chosen, sets, percent).unionByName(same), "links")
    labels = components(links)

    known = nodes.join(labels, "node", "left").select("node", "least", F.coalesce("label", "node").alias("label"))
    named = stored(_still_mixed(every.select("sig", "node").join(known, "node")), "mixed")
    discard(every)
    if not named.isEmpty():
        with _batches_of(docs.sparkSession, 500):
            across = _across_groups(named, chosen, sets, percent)
        merged = components(across).select(F.col("node").alias("label"), F.col("label").alias("lower"))
        alone = merged.join(labels, merged["label"] == labels["node"], "left_anti").select(F.col("label").alias("node"), F.col("lower").alias("label"))
        labels = labels.join(merged, "label", "left").select("node", F.coalesce("lower", "label").alias("label")).unionByName(alone)
    discard(named, sets, nodes)
    found = facts.join(labels, "node", "left")
    return found.select(F.col("node").alias(id_col), "n_shingles", F.coalesce("label", "node").alias("component_id"))
