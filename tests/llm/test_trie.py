"""Conversation prefix trie: against a brute-force walk, for every way of cutting and spilling."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tallymill.llm import prefix_trie
from tallymill.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows, share=lambda c: zlib.crc32(str(c).encode()) % 9):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    turns = {c: [x[1:] for x in sorted(v, key=lambda x: x[0])] for c, v in convs.items()}
    built = {c: tuple(turns.get(c - c % 5, [])[: share(c)] + own[share(c) :]) for c, own in turns.items()}
    members, children = defaultdict(list), defaultdict(list)
    for conv in sorted(built):
        for depth in range(len(built[conv]) + 1):
            members[built[conv][:depth]].append(conv)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    out, totals = [], {}
    for path in sorted(members, key=len, reverse=True):
        own = (len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0
        totals[path] = sum(totals[k][0] for k in children[path]) or 1, own + sum(totals[k][1] for k in children[path])
        ended = ",".join(str(c) for c in members[path] if len(built[c]) == len(path))
        out.append((members[path][0], len(path), members[path[:-1]][0] if path else None, len(members[path]), len(children[path]), *totals[path], hashlib.sha256(ended.encode()).hexdigest()))
    return sorted(out, key=repr)


def built(turns, **settings):
    conv_id = F.col("conv_id")
    paths = prefix_trie.members(prefix_trie.positions(turns), conv_id - conv_id % 5, F.crc32(conv_id.cast("string").cast("binary")) % 9)
    return sorted((tuple(r) for r in prefix_trie.trie(paths, **settings).collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(3)
    out = []
    for conv in [*range(0, 120), 1000, 1003, 2004]:
        if conv % 11 == 5:
            continue  # bases that are absent
        for turn in range(rnd.randint(1, 12)):
            text = rnd.choice([None, "", "yes", "nö", f"{rnd.randint(0, 3)}", "a" * rnd.randint(1, 9)])
            out.append((conv, turn if rnd.random() < 0.95 or turn else None, rnd.choice(["user", "user", None]), text))
    first = [(c, -5, "user", "Hello") for c in range(0, 120)]  # a first turn that most share
    return out + first + out[:7] + [(None, 1, "user", "lost"), (7, 99, None, None)]


@pytest.mark.parametrize("settings", [{}, {"cut": 3, "queue": 2}, {"cut": 40, "queue": 5}])
def test_trie_agrees_with_a_walk(spark, rows, monkeypatch, settings):
    monkeypatch.setattr(prefix_trie, "LEAST_SHARD", 1)
    once = list(dict.fromkeys(rows))
    assert built(spark.createDataFrame(once, SCHEMA).repartition(5), **settings) == brute(once)


def test_one_conversation_may_hold_most_turns(spark, monkeypatch):
    """It lies in several partitions, and its places and digests go on from one to the next."""
    monkeypatch.setattr(prefix_trie, "LEAST_SHARD", 1)
    rows = [(10, t, "user", str(t % 7)) for t in range(3000)] + [(11, t, "user", str(t % 7)) for t in range(40)] + [(c, 0, "user", "x") for c in range(20, 60)]
    turns = spark.createDataFrame(rows, SCHEMA)
    assert prefix_trie.positions(turns).agg(F.max("pos")).first()[0] == 3000
    parts = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert built(turns, cut=20, queue=50) == brute(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", parts)


def test_turns_with_odd_columns(spark):
    """Repeated turns are turns of their own, extra columns are not read, an empty table has no node."""
    assert built(spark.createDataFrame([], SCHEMA)) == []
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (2, None, None, None), (2, 1, "user", "b" * 300_000)]
    turns = spark.createDataFrame([(*r, "x", 5) for r in rows], SCHEMA + ", pos string, k1 int")
    assert built(turns) == brute(rows)
    paths = prefix_trie.members(prefix_trie.positions(turns))
    assert sorted((r["conv_id"], r["depth"], r["n_convs"], r["parent_conv_id"]) for r in prefix_trie.trie(paths).collect()) == [(1, 0, 2, None), (1, 1, 1, 1), (1, 2, 1, 1), (2, 1, 1, 1), (2, 2, 1, 2)]
    same = [spark.createDataFrame(order, SCHEMA).repartition(2) for order in ([(1, 0, "a", "x"), (1, 0, "a", "y")], [(1, 0, "a", "y"), (1, 0, "a", "x")])]
    assert built(same[0]) == built(same[1])  # turns of one number


def test_queue_spills_in_order():
    rnd = random.Random(1)
    items = [(rnd.randint(0, 50), i) for i in range(500)]
    queue = prefix_trie.Queue(7)
    out = []
    for i, item in enumerate(items):
        queue.push(item)
        if i % 5 == 4:
            out.append(queue.pop())
            assert not queue or out[-1] <= queue.first()
    rest = []
    while queue:
        rest.append(queue.pop())
    assert rest == sorted(rest) and sorted(out + rest) == sorted(items)


def test_query(spark):
    path = "/root/testdata/sf0.001"
    turns = [tuple(r) for r in spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted((tuple(r) for r in QUERIES["op11_prefix_trie"](spark, path).collect()), key=repr) == brute(turns)
