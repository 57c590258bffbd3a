"""Ranked lexical search, term at a time with limited accumulators.

Documents are dealt into segments, each an inverted index of its own: for every term that a query
of the block names, the documents that hold it and how often. Counts over all segments give the
weight of a term. A segment then answers each query term by term, the rarest term of the whole
corpus first. A document gets an accumulator when the first of its terms is read. Before each term
the largest scores that the terms still to come can add are summed; once that sum is below the kth
best partial score (or the kth best score of earlier segments of the task), no document without an
accumulator can reach the first k any more, so none is created. Those that exist go on to be updated
with every later term, so that the scores returned are exact. Equal sums still get an accumulator,
because an equal score with a smaller id ranks first.

A segment holds a bounded number of documents and postings, whatever its terms, so a word that
stands in every document is spread like any other. What leaves a task is k rows for each query.
Queries go in blocks of bounded size; the driver holds the terms of one block.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from tallymill.llm.common import stored

BLOCK_BYTES = 4 << 20  # text of the queries that are searched at a time
SEGMENT_DOCS, SEGMENT_POSTINGS = 4096, 1 << 18
TEXT_BLOCK = 1 << 20  # bytes of a text that are split into terms at a time
BUCKET = 256  # tasks whose best rows meet before the last ranking

#: ASCII letters and digits and every byte of a longer character belong to terms; A-Z is lower-cased.
_KEEP = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def terms(text: bytes | None) -> Iterator[list[bytes]]:
    """All terms of a text in order, in lists of bounded size (one term is never cut)."""
    data = (text or b"").translate(_KEEP)
    start = 0
    while start < len(data):
        end = len(data)
        if end - start > TEXT_BLOCK:
            end = data.rfind(b" ", start + 1, start + TEXT_BLOCK)
            end = end if end > 0 else data.find(b" ", start + TEXT_BLOCK)
            end = end if end > 0 else len(data)
        yield data[start:end].split()
        start = end


@dataclass
class Block:
    """Some queries: their ids, and the terms of each with the number of times it is named."""

    ids: list[Any]
    counts: list[dict[int, int]]
    vocabulary: dict[bytes, int]


def blocks(queries: DataFrame, id_col: str, text_col: str, most: int = BLOCK_BYTES) -> Iterator[Block]:
    """The queries that have a term, in blocks of `most` bytes of text and at least one query."""
    made, size = Block([], [], {}), 0
    for row in queries.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")).toLocalIterator():
        found: Counter[bytes] = Counter()
        for some in terms(row["text"]):
            found.update(some)
        if not found:
            continue
        made.ids.append(row["id"])
        made.counts.append({made.vocabulary.setdefault(t, len(made.vocabulary)): n for t, n in found.items()})
        size += len(row["text"])
        if size >= most:
            yield made
            made, size = Block([], [], {}), 0
    if made.ids:
        yield made


def _order(ids: list[Any]) -> list[int]:
    """Positions by ascending id, null first."""
    return sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i]) if ids[i] is not None else (False,))


def index(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Segments: documents in the order of their ids with their numbers of terms, and postings by term.

    `docs` and `lengths` run along the documents that hold a term of the vocabulary, `term` and `df`
    along the terms, `at` and `tf` along the postings (place in `docs`, occurrences), term after
    term. `with_terms` and `total` count the documents with any term at all and all their terms.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # of one block of queries
    id_type = docs.schema[id_col].dataType
    ints = T.ArrayType(T.IntegerType())
    schema = T.StructType(
        [T.StructField("docs", T.ArrayType(id_type)), T.StructField("lengths", T.ArrayType(T.LongType()))]
        + [T.StructField(c, ints) for c in ("term", "df", "at", "tf")]
        + [T.StructField("with_terms", T.LongType()), T.StructField("total", T.LongType())]
    )
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        ids: list[Any] = []
        lengths: list[int] = []
        found: list[tuple[int, int, int]] = []  # term, place in ids, occurrences
        some = total = 0

        def segment() -> pa.RecordBatch:
            order = _order(ids)
            rank = np.empty(len(ids), np.int64)
            rank[order] = np.arange(len(ids))
            post = np.array(found, np.int64).reshape(-1, 3)
            post[:, 1] = rank[post[:, 1]]
            post = post[np.lexsort((post[:, 1], post[:, 0]))]
            term, df = np.unique(post[:, 0], return_counts=True)
            row = ([ids[i] for i in order], [lengths[i] for i in order], term, df, post[:, 1], post[:, 2], some, total)
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, arrow)], schema=arrow)

        for batch in batches:
            for doc, text in zip(batch.column("id"), batch.column("text")):
                counts: Counter[bytes] = Counter()
                n = 0
                for words in terms(text.as_py()):
                    n += len(words)
                    counts.update(words)
                some += n > 0
                total += n
                hits = [(number[w], len(ids), c) for w, c in counts.items() if w in number]
                if hits:
                    ids.append(doc.as_py())
                    lengths.append(n)
                    found += hits
                if len(ids) >= SEGMENT_DOCS or len(found) >= SEGMENT_POSTINGS:
                    yield segment()
                    ids, lengths, found, some, total = [], [], [], 0, 0
        if some:
            yield segment()

    return rows.mapInArrow(run, schema)


@dataclass
class Statistics:
    n_docs: int  # with at least one term
    n_terms: int
    df: np.ndarray
    weight: np.ndarray


def statistics(segments: DataFrame, n_vocabulary: int) -> Statistics:
    """Counts over all segments; of a size that the block of queries bounds."""
    n_docs, n_terms = segments.agg(F.sum("with_terms"), F.sum("total")).first()
    n_docs, n_terms = int(n_docs or 0), int(n_terms or 0)
    per_term = segments.select(F.explode(F.arrays_zip("term", "df")).alias("x")).groupBy(F.col("x.term").alias("term")).agg(F.sum("x.df").alias("df"))
    df = np.zeros(n_vocabulary, np.int64)
    for row in per_term.collect():
        df[row["term"]] = row["df"]
    weight = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)
    return Statistics(n_docs, n_terms, df, weight)


def impacts(tf: np.ndarray, m: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """What one occurrence of the term in the query adds."""
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))


def best_of(plan: list[tuple[int, int, int]], at: np.ndarray, impact: np.ndarray, tops: dict[int, int], n_docs: int, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the first k documents of a segment; those below `floor` may be missing.

    `plan`: (start, end, times named) of the postings of each term, the rarest first; `tops`: the
    largest impact of a term's postings, by their start.
    """
    scores = np.zeros(n_docs, np.int64)
    ahead = sum(times * tops[start] for start, _, times in plan)
    alive = None
    for start, end, times in plan:
        if alive is None:
            least = floor
            if ahead < scores.max():
                least = max(floor, int(np.partition(scores, n_docs - k)[n_docs - k])) if n_docs >= k else floor
            if ahead < least:  # no new document can reach the kth any more
                alive = scores > 0
        ahead -= times * tops[start]
        places, values = at[start:end], impact[start:end]
        if alive is not None:
            ours = alive[places]
            places, values = places[ours], values[ours]
        scores[places] += times * values
    found = np.flatnonzero(scores > 0)
    if len(found) > k:
        kth = np.partition(scores[found], len(found) - k)[len(found) - k]
        found = found[scores[found] >= kth]
    found = found[np.lexsort((found, -scores[found]))][:k]
    return found, scores[found]


def _search_block(segments: DataFrame, block: Block, known: Statistics, k: int, doc_type: T.DataType, query_type: T.DataType) -> DataFrame:
    spark = segments.sparkSession
    plans = [sorted(counts.items(), key=lambda x: (known.df[x[0]], x[0])) for counts in block.counts]
    shared = spark.sparkContext.broadcast((block.ids, plans, known))  # one block of queries
    schema = T.StructType([T.StructField("task", T.IntegerType()), T.StructField("query", T.IntegerType()), T.StructField("query_id", query_type), T.StructField("doc", doc_type), T.StructField("score", T.LongType())])
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, plans, known = shared.value
        best: list[list[tuple[int, tuple, Any]]] = [[] for _ in plans]
        for batch in batches:
            for row in range(batch.num_rows):
                docs = batch.column("docs")[row].values
                if docs is None or not len(docs):
                    continue
                get = lambda c: batch.column(c)[row].values.to_numpy(zero_copy_only=False).astype(np.int64)
                term, df, at, tf = get("term"), get("df"), get("at"), get("tf")
                m = np.array([100 - 25 + 25 * n * known.n_docs // known.n_terms for n in batch.column("lengths")[row].as_py()], np.int64)
                impact = impacts(tf, m[at], np.repeat(known.weight[term], df))
                starts = np.cumsum(df) - df
                tops = dict(zip(starts.tolist(), np.maximum.reduceat(impact, starts).tolist()))
                place = {t: (s, s + n) for t, s, n in zip(term.tolist(), starts.tolist(), df.tolist())}
                for q, plan in enumerate(plans):
                    ours = [(*place[t], times) for t, times in plan if t in place]
                    if not ours:
                        continue
                    floor = -best[q][-1][0] if len(best[q]) == k else 0
                    found, scores = best_of(ours, at, impact, tops, len(docs), k, floor)
                    if len(found):
                        new = [(-int(s), (d is not None, d) if d is not None else (False,), d) for d, s in zip(docs.take(pa.array(found)).to_pylist(), scores)]
                        best[q] = sorted(best[q] + new, key=lambda x: x[:2])[:k]
        task = TaskContext.get().partitionId()
        rows = [(task, q, ids[q], doc, -minus) for q, some in enumerate(best) for minus, _, doc in some]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    found = segments.mapInArrow(run, schema)
    order = [F.col("score").desc(), F.col("doc").asc_nulls_first()]
    bucket = F.floor(F.col("task") / BUCKET)
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("query", bucket).orderBy(*order))).where(F.col("rank") <= k)
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("rank") <= k)


def search(docs: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text", query_id: str = "item_id", query_text: str = "text") -> DataFrame:
    """The `k` best documents of every query: the query's id, `rank` from 1, the document's id, `score`.

    Only documents with a score above 0 are returned; equal scores rank by ascending document id, a
    null id first. A null or empty text has no term, and neither does a text without a letter or
    digit: such a document counts nowhere, such a query returns nothing. Rows that repeat a document
    are documents of their own, rows that repeat a query's id are queries of their own and ranked
    apart. Other columns are not read. Empty tables give an empty result.
    """
    spark = docs.sparkSession
    doc_type, query_type = docs.schema[id_col].dataType, queries.schema[query_id].dataType
    result: DataFrame | None = None
    for block in blocks(queries, query_id, query_text):
        segments = stored(index(docs, block.vocabulary, id_col, text_col), "lexical-segments")
        known = statistics(segments, len(block.vocabulary))
        if known.n_docs:
            found = _search_block(segments, block, known, k, doc_type, query_type)
            result = found if result is None else result.unionByName(found)
    if result is None:
        result = _nothing(spark, doc_type, query_type)
    return result.select(F.col("query_id").alias(query_id), "rank", F.col("doc").alias(id_col), "score")


def _nothing(spark: SparkSession, doc_type: T.DataType, query_type: T.DataType) -> DataFrame:
    return spark.createDataFrame([], T.StructType([T.StructField("query_id", query_type), T.StructField("rank", T.IntegerType()), T.StructField("doc", doc_type), T.StructField("score", T.LongType())]))
