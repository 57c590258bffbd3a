"""From raw documents to token ids: language, exact copies, near copies, benchmark passages, encoding.

Each stage is a function of (spark, docs, sf_dir) that returns a DataFrame; it is written as Parquet
and read again as the next stage's documents. All but the last return the columns of `documents`.

A null text has no language and goes with the first stage, as does an empty one. Rows that repeat an
id and a text are copies, of which one stays; rows of one id with other texts are documents that
the later stages keep or drop together. A null id is kept unless its text goes. Of equal texts the
row with the largest id stays, of similar ones that with the smallest. Empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymill.llm import bpe, jaccard, language, radix_dedup, templates
from tallymill.llm.common import leave_out, read, stored
from tallymill.llm.queries import tokenizer_path


ROWS = 1000  # documents in a batch that goes to Python: Spark's own number is meant for narrow rows


def _small_batches(spark: SparkSession) -> None:
    """For the stage and what is written of it: bounds what a task and its Python hold of texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS))


def _packed(docs: DataFrame) -> DataFrame:
    """Id and text, and all else in one column, so that no name clashes with those of an operator."""
    return docs.select("doc_id", "text", F.struct(*[F.col(c) for c in docs.columns if c != "text"]).alias("__row"))


def _unpacked(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[F.col("text") if c == "text" else F.col(f"__row.`{c}`").alias(c) for c in docs.columns])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a trusted score; texts without a letter go, too."""
    _small_batches(spark)
    model = language.train(language.sample(docs))
    return _unpacked(language.identify(_packed(docs), model).where("accepted"), docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    _small_batches(spark)
    return _unpacked(radix_dedup.dedup(_packed(docs)).where("kept"), docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar texts (five-word shingles, 0.8), the document with the smallest id."""
    _small_batches(spark)
    found = jaccard.components_of(docs.select("doc_id", "text"), width=5, percent=80)
    return leave_out(docs, "doc_id", found.where("doc_id <> component_id"), "doc_id")


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that give away no benchmark item."""
    _small_batches(spark)
    return templates.remove(docs, templates.find(docs.select("doc_id", "text"), read(spark, sf_dir, "benchmark")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, and the digest of the text that they decode to."""
    _small_batches(spark)
    found = bpe.encode(docs.select("doc_id", "lang", "source", "text"), tokenizer_path())
    return found.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language", identify_language),
    ("exact copies", drop_exact_copies),
    ("near copies", drop_near_copies),
    ("benchmark", drop_benchmark),
    ("encode", encode),
]

#: The language stage is a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the documents of `sf_dir`."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
