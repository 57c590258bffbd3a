"""Topic messages: source, payload parsing, encoding and the topic sink.

The topic connector is a separate jar. Everything downstream only needs the message columns
(topic, partition, offset, timestamp, value), so a file stream with those columns can stand in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymill.functions.keys import surrogate_key
from tallymill.operators.rows import evaluate_once

CORRUPT = "_corrupt_record"


def read_topics(
    spark: SparkSession, servers: str, topics: Sequence[str], max_per_trigger: int | None = None
) -> DataFrame:
    """Stream of messages from the earliest offset; offsets live in the sink's checkpoint."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "earliest")
        .option("includeHeaders", True)
    )
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load()


def replay_topics(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json", max_files: int | None = None
) -> DataFrame:
    """Stream of stored messages from files, in place of a broker."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def parse_payload(messages: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """The JSON payload as flat columns. A payload that is not JSON gives a row of nulls."""
    data = F.from_json(F.col("value").cast("string"), schema).alias("d")
    return messages.select(*keep, data).select(*keep, "d.*")


def parse_or_reject(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """Message columns, parsed struct `d`, and `error_message`, null when the payload is good.

    Broken JSON and values of the wrong type both land in the corrupt-record field.
    """
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    text = F.col("value").cast("string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    # once, or every filter on the error would parse the payload again
    parsed = evaluate_once(messages, "d", F.from_json(text, with_corrupt, options))
    error = F.when(text.isNull(), "empty message").when(F.col(f"d.{CORRUPT}").isNotNull(), "payload does not parse")
    return parsed.withColumn("error_message", error)


def encode(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """The row as a JSON object; null fields are written out as null."""
    return F.to_json(F.struct(*(columns or df.columns)), {"ignoreNullFields": "false"})


def as_messages(df: DataFrame, topic: Column, columns: Sequence[str] | None = None) -> DataFrame:
    return df.select(topic.alias("topic"), encode(df, columns).alias("value"))


def with_ids(df: DataFrame, batch_id: int, keys: Sequence[str] = ()) -> DataFrame:
    """Rows with `batch_id` and `row_id`, a hash of `keys` or else of all columns; a repeated batch gives the same ids.

    Rows that are alike in the keys share an id, so give keys that tell apart what must not be dropped.
    """
    return df.withColumns({"row_id": surrogate_key(*(keys or df.columns)), "batch_id": F.lit(batch_id).cast("bigint")})


def publish(df: DataFrame, servers: str, topic: str, batch_id: int | None = None, keys: Sequence[str] = ()) -> None:
    """Publish rows as JSON messages. Delivery is at least once.

    With `batch_id`, each message carries it and a row id, so a reader can drop what a repeated batch
    sends twice. An empty DataFrame publishes nothing.
    """
    tagged = df if batch_id is None else with_ids(df, batch_id, keys)
    out = tagged.select(encode(tagged).alias("value"))
    out.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
