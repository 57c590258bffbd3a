"""Messages that do not parse: the dead-letter envelope and its retries."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymill.sources.topics import parse_or_reject, replay_topics
from tallymill.streaming.land import each_batch, write_batch

# Retry headers and their defaults.
RETRY, RETRY_MAX = "dlq_retry", "dlq_retry_max"
DEFAULT_RETRY, DEFAULT_RETRY_MAX = "0", "3"


def with_headers(messages: DataFrame) -> DataFrame:
    """Messages with a `headers` map of text holding at least the retry headers; all others are kept.

    Headers may come as a map, or as the connector delivers them, an array of key and binary value;
    of a key given twice the last value counts.
    """
    none = F.create_map().cast("map<string,string>")
    given = none
    if "headers" in messages.columns:
        given = F.col("headers")
        if isinstance(messages.schema["headers"].dataType, T.ArrayType):
            entries = given
            keys = F.array_distinct(F.transform(entries, lambda e: e["key"]))
            last = F.transform(keys, lambda k: F.element_at(F.filter(entries, lambda e: e["key"] == k), -1)["value"])
            given = F.map_from_arrays(keys, F.transform(last, lambda v: v.cast("string")))
        given = F.coalesce(given, none)
    return messages.withColumn("headers", _defaulted(_defaulted(given, RETRY, DEFAULT_RETRY), RETRY_MAX, DEFAULT_RETRY_MAX))


def _defaulted(headers: Column, key: str, default: str) -> Column:
    """`headers` with a value for `key`: its own, or else the default."""
    return _with_header(headers, key, F.coalesce(headers[key], F.lit(default)))


def _with_header(headers: Column, key: str, value: Column) -> Column:
    return F.map_concat(F.map_filter(headers, lambda k, _: k != key), F.create_map(F.lit(key), value))


def envelope(messages: DataFrame) -> DataFrame:
    """Rejected messages in the shape of the dead-letter topic."""
    return with_headers(messages).select(
        "topic",
        F.col("value").cast("string").alias("original_message"),
        "error_message",
        "timestamp",
        "partition",
        "offset",
        "headers",
    )


def accepted(parsed: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows of `parse_or_reject` that parse, as topic and flat columns."""
    fields = [F.col(f"d.{f}") for f in schema.fieldNames()]
    return parsed.where(F.col("error_message").isNull()).select("topic", *fields)


def rejected(parsed: DataFrame) -> DataFrame:
    """The rows of `parse_or_reject` that do not parse, as dead letters."""
    return envelope(parsed.where(F.col("error_message").isNotNull()))


def split(messages: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(parsed rows with topic, dead letters)."""
    parsed = parse_or_reject(messages, schema)
    return accepted(parsed, schema), rejected(parsed)


@contextmanager
def kept_parsed(messages: DataFrame, schema: T.StructType) -> Iterator[DataFrame]:
    """`parse_or_reject`, kept for several writes while the block runs.

    A task keeps all messages of its part of the source, so they are kept small: the fields in
    columns of their own, which Spark compresses, and what only a dead letter needs of its message
    (all but the topic) for dead letters only. A lost block is read from the source and parsed again.
    """
    parsed = parse_or_reject(messages, schema)
    dead = F.col("error_message").isNotNull()
    message = [c for c in messages.columns if c != "topic"]
    fields = {f"_field{i}": f for i, f in enumerate(schema.fieldNames())}
    flat = parsed.select(
        "topic",
        "error_message",
        *[F.when(dead, F.col(f"`{c}`")).alias(c) for c in message],
        *[F.col("d")[f].alias(n) for n, f in fields.items()],
    ).persist()
    try:
        data = F.struct(*[F.col(n).alias(f) for n, f in fields.items()]).alias("d")
        yield flat.select("topic", *[F.col(f"`{c}`") for c in message], data, "error_message")
    finally:
        flat.unpersist()


def land_or_reject(messages: DataFrame, schema: T.StructType, good: str, dead: str, checkpoint: str):
    """Stream: good rows to `good`, the others to `dead`; one bad message costs only itself."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        with kept_parsed(batch, schema) as parsed:
            write_batch(accepted(parsed, schema), good, batch_id, by=["topic"])
            write_batch(rejected(parsed), dead, batch_id)

    return each_batch(messages, handle, checkpoint)


def retry(dead: DataFrame) -> DataFrame:
    """Dead letters with tries left, as messages again, their retry header raised by one."""
    tries = F.col("headers")[RETRY].cast("int")
    left = dead.where(tries < F.col("headers")[RETRY_MAX].cast("int"))
    raised = _with_header(F.col("headers"), RETRY, (tries + 1).cast("string"))
    return left.select(
        "topic", "partition", "offset", "timestamp", F.col("original_message").alias("value"), raised.alias("headers")
    )


def exhausted(dead: DataFrame) -> DataFrame:
    return dead.where(F.col("headers")[RETRY].cast("int") >= F.col("headers")[RETRY_MAX].cast("int"))


def as_connector(messages: DataFrame) -> DataFrame:
    """Messages with their headers as a topic delivers them: an array of key and binary value."""
    entries = F.map_entries("headers")
    shaped = F.transform(entries, lambda e: F.struct(e["key"].alias("key"), e["value"].cast("binary").alias("value")))
    return messages.withColumn("headers", shaped)


def land_with_retries(
    messages: DataFrame, schema: T.StructType, out: str, checkpoint: str, mend: Callable[[DataFrame], DataFrame] | None = None
) -> None:
    """Stream: every message ends in `out/good` or, when its tries are spent, in `out/exhausted`.

    Dead letters with tries left are messages again, with the retry header raised, on a topic of
    their own, `out/again`, which the stream reads beside the messages; so the tries of one message
    lie in different batches, and a restart goes on where the stream stood. `mend` is applied to the
    messages that come back. Runs until nothing comes back any more.
    """
    spark = messages.sparkSession
    headers = T.ArrayType(T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType())]))
    if "headers" not in messages.columns:
        messages = messages.withColumn("headers", F.lit(None).cast(headers))
    columns = ["topic", "partition", "offset", "timestamp", "value", "headers"]
    messages = messages.select(*columns).withColumn("value", F.col("value").cast("string"))
    spark.createDataFrame([], messages.schema).write.mode("overwrite").parquet(f"{out}/again/start")
    back = replay_topics(spark, f"{out}/again/*", messages.schema, "parquet")
    arriving = messages.unionByName(mend(back) if mend else back)

    def handle(batch: DataFrame, batch_id: int) -> None:
        with kept_parsed(batch, schema) as parsed:
            write_batch(accepted(parsed, schema), f"{out}/good", batch_id, by=["topic"])
            dead = rejected(parsed)
            write_batch(exhausted(dead), f"{out}/exhausted", batch_id)
            # no later batch has read this folder yet, so a batch that runs again may replace it
            as_connector(retry(dead)).select(*columns).write.mode("overwrite").parquet(f"{out}/again/{batch_id:08d}")

    while any(p["numInputRows"] for p in each_batch(arriving, handle, checkpoint).recentProgress):
        pass
