"""Ranked search against brute force; quality scores against held-out labels and closed forms."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymill.llm import lexical, quality
from tallymill.llm.queries import QUERIES


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def ranked(docs, queries, k):
    counts = [(i, Counter(words(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in counts]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in queries:
        found = []
        for (doc, c), size in zip(counts, sizes):
            m = 75 + 25 * size * n // total if total else 0
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in words(text) if c[t])
            if score > 0:
                found.append((-score, (doc is not None, doc or 0), doc))
        out += [(item, rank, doc, -minus) for rank, (minus, _, doc) in enumerate(sorted(found, key=lambda x: x[:2])[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("sizes", [(4096, 1 << 18), (7, 1 << 18), (4096, 30)])
def test_search_agrees_with_brute_force(spark, monkeypatch, sizes):
    rnd = random.Random(8)
    vocabulary = [f"w{i}" for i in range(60)] + ["Über", "naïve", "ÉTÉ", "x9", "Q"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    docs = [(i, " ".join(rnd.choices(vocabulary, weights, k=rnd.randint(0, 60)))) for i in range(300)]
    docs += [(1000 + i, docs[5][1]) for i in range(40)]  # equal scores, more than are returned
    docs += [(7, docs[7][1]), (None, "w1 w2 w60"), (2000, None), (2001, ""), (2002, "?! ..."), (2003, "w3-W3_w3\tW4 w4")]
    queries = [(i, " ".join(rnd.choices(vocabulary, k=rnd.randint(1, 25)))) for i in range(25)]
    queries += [(3, "w1 w1 W1 w2"), (None, "w5"), (90, None), (91, "..."), (92, "unheard"), (93, docs[5][1])]
    monkeypatch.setattr(lexical, "SEGMENT_DOCS", sizes[0])
    monkeypatch.setattr(lexical, "SEGMENT_POSTINGS", sizes[1])
    left = spark.createDataFrame([(i, t, "s", 1) for i, t in docs], "doc_id long, text string, score string, rank int").repartition(3)
    right = spark.createDataFrame([(i, t, 2) for i, t in queries], "item_id long, text string, query int")
    found = lexical.search(left, right, k=12)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == ranked(docs, queries, 12)


def test_search_in_blocks_of_queries(spark, monkeypatch):
    docs = [(i, f"common word{i % 9} {'long ' * i}") for i in range(60)]
    queries = [(i, f"word{i} common") for i in range(9)]
    monkeypatch.setattr(lexical, "blocks", lambda *a, f=lexical.blocks: f(*a, most=20))
    found = lexical.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(queries, "item_id long, text string"), k=5)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == ranked(docs, queries, 5)


def test_search_of_empty_tables_and_long_texts(spark, monkeypatch):
    none, some = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert lexical.search(none, some).collect() == []
    assert lexical.search(some.withColumnRenamed("item_id", "doc_id"), some.where("false")).collect() == []
    monkeypatch.setattr(lexical, "TEXT_BLOCK", 50)
    docs = [(i, " ".join(f"t{j % (i + 2)}" for j in range(3000)) + "z" * 200) for i in range(5)]
    queries = [(0, "t1 t3"), (1, "z" * 200)]
    found = lexical.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(queries, "item_id long, text string"))
    assert sorted((tuple(r) for r in found.collect()), key=repr) == ranked(docs, queries, 20)


def test_accumulators_stop():
    """Once what is ahead cannot reach the kth score, postings of new documents are passed over."""
    at = np.array([0, 1, 2, 3, 4, 5, 6, 7, 8, 9])
    impact = np.array([100, 90, 1, 1, 1, 1, 1, 1, 1, 1])
    plan, tops = [(0, 2, 1), (2, 10, 1)], {0: 100, 2: 1}
    found, scores = lexical.best_of(plan, at, impact, tops, 10, 2, 0)
    assert found.tolist() == [0, 1] and scores.tolist() == [100, 90]
    found, _ = lexical.best_of(plan, at, impact, tops, 10, 3, 0)
    assert found.tolist() == [0, 1, 2]  # an equal score goes to the smaller place
    found, _ = lexical.best_of(plan, at, impact, tops, 10, 3, 50)
    assert found.tolist() == [0, 1]  # beneath the floor of earlier segments


def test_statistics_of_odd_texts():
    for text in (None, b"", b" ", b"\n\n", b"a", "ß".encode(), b"\x00", b"x" * 3_000_000, b"x y " * 800_000):
        found = quality.statistics_of(text)
        assert len(found) == len(quality.STATISTICS) and all(map(math.isfinite, found))
    at = dict(zip(quality.STATISTICS, quality.statistics_of("Go go go!\nGo go go!\nÜ".encode())))
    assert at["same_word_again"] == 0 and at["distinct_words"] == 4 / 7 and at["distinct_lines"] == 2 / 3


def test_isotonic_is_the_least_squares_fit():
    rnd = random.Random(4)
    for _ in range(30):
        x = np.arange(6.0)
        n, y = np.array([rnd.randint(1, 5) for _ in x], float), np.array([rnd.random() for _ in x])
        knots, levels = quality.isotonic(x, n, n * y)
        fitted = np.array([max(min(np.average(y[i:j], weights=n[i:j]) for j in range(k + 1, 7)) for i in range(k + 1)) for k in range(6)])  # max-min formula
        assert (np.diff(levels) > 0).all() and np.allclose(sorted(set(fitted.round(9))), levels.round(9))
        assert len(knots) == len(levels)


def test_normal_equations_are_sums_over_all_rows(spark):
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(400, len(quality.STATISTICS))), rng.integers(0, 2, 400)
    rows = spark.createDataFrame([(i, a.tolist(), int(b)) for i, (a, b) in enumerate(zip(x, y))], "doc_id long, statistics array<double>, label int").repartition(5)
    model = quality.train(rows)
    z = model.cosines(x)
    penalty = np.diag([quality.RIDGE * 400] * quality.COSINES + [1e-9])
    assert np.allclose(model.weights, np.linalg.solve(z.T @ z + penalty, z.T @ y), atol=1e-5)
    assert (np.diff(model.levels) > 0).all() and 0 <= model.levels.min() and model.levels.max() <= 1


def test_quality_with_odd_tables(spark):
    docs = [(i, "good words in a line of text" if i % 2 else "bad bad bad bad ###", "x") for i in range(60)]
    docs += [(100, None, "x"), (101, "", "x"), (102, "word " * 60_000, "x"), (1, "good words in a line of text", "y"), (None, "nobody", "z")]
    left = spark.createDataFrame(docs, "doc_id long, text string, score string").repartition(3)
    labels = [(i, i % 2) for i in range(60)] + [(1, 1), (500, 1), (None, 0), (3, None), (4, 7)]
    right = spark.createDataFrame(labels, "doc_id long, quality int")
    found = quality.classify(left, right, F.col("doc_id") % 5 != 0).collect()
    assert len(found) == len(docs) and found[0].asDict().keys() == {"doc_id", "score"}
    scores = {r["doc_id"]: r["score"] for r in found}
    assert all(0 <= s <= 1 for s in scores.values()) and scores[5] > 0.7 > 0.3 > scores[10]
    assert scores[100] == scores[101]
    for wanted, kept in ((0.5, []), (1.0, [(i, 1) for i in range(60)])):
        one = quality.classify(left, spark.createDataFrame(kept, "doc_id long, quality int"), F.lit(True)).collect()
        assert all(abs(r["score"] - wanted) < 0.002 for r in one)
    assert quality.classify(left.where("false"), right, F.lit(True)).collect() == []


def test_quality_of_held_out_documents(spark):
    path = "/root/testdata/sf0.01"
    found = QUERIES["op12_quality"](spark, path).join(spark.read.parquet(f"{path}/labels.parquet"), "doc_id").where("held_out").toPandas()
    good, bad = found[found["quality"] == 1], found[found["quality"] == 0]
    assert (good["predicted"] == 1).mean() > 0.97 and (bad["predicted"] == 0).mean() > 0.9
