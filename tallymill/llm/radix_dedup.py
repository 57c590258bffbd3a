"""Exact duplicates by distributed MSD radix partitioning.

The key of a document is its byte length followed by its normalised bytes. A round splits every
open group by the next bytes of the key; a group of one is settled, and so is a group whose texts
have ended, because its members then agree in every byte. No digest decides equality. The first
round needs the length and 24 bytes of each document and settles almost all of them, which go
straight to the result; a mask that the groups still open leave keeps them out of all later steps.
Each later digit is wider, so copies of any length settle in a few rounds.

Counts per digit are combined before they are shuffled and are joined back to the rows, so a group
that holds a third of the table is one row of the joins' small side, and Spark can split the large side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.llm.common import ascii_lower, discard, masked, stored, whole, without

OUT = ["keep_id", "group_size", "kept"]


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", widths: tuple[int, int] = (24, 1024), growth: int = 64) -> DataFrame:
    """All rows of `docs` with `keep_id`, `group_size` and `kept`.

    Texts are equal when they agree after lower-casing A-Z. The row with the largest id of a group
    stays. Null text counts as empty; a null id is smaller than any other. Rows that repeat both id
    and text are copies like any other: exactly one of them is kept. An empty table gives an empty
    one. Input columns named like the three new ones are replaced.

    `widths`: bytes of the first two digits; each later digit is `growth` times as wide.
    """
    docs = without(docs, OUT)
    text = whole(F.col(f"`{text_col}`"))
    size = F.octet_length(text).cast("long")
    head = F.substring(ascii_lower(F.substring(text, 1, widths[0])).cast("binary"), 1, widths[0])
    heads = docs.select(size.alias("grp"), head.alias("digit"))
    opened = heads.groupBy("grp", "digit").agg(F.count("*").alias("n")).where("n > 1").select(F.xxhash64("grp", "digit").alias("key"))
    packed = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = masked(docs.select(packed, size.alias("grp"), F.xxhash64(size, head).alias("key")), "key", opened, "key")
    one = F.col("row").getField(id_col).alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept")
    done = [rows.where("not in_mask").select("row", *one)]

    state = stored(rows.where("in_mask").select("row", "grp", F.monotonically_increasing_id().alias("number")), "radix-open")
    offset, width = 0, widths[1]
    while not state.isEmpty():
        step = _round(state, id_col, text_col, offset, width)
        done.append(step.where("settled").select("row", "keep_id", "group_size", "kept"))
        state = step.where("not settled").select("row", F.col("next").alias("grp"), "number")
        offset, width = offset + width, width * growth
    found = done[0]
    for part in done[1:]:
        found = found.unionByName(part)
    return found.select("row.*", *OUT)


def _round(state: DataFrame, id_col: str, text_col: str, offset: int, width: int) -> DataFrame:
    """Rows of `row`, `grp`, `number`, split by the digit at `offset`: `settled` ones with their decision, others with their `next` group."""
    bytes_ = ascii_lower(whole(F.col("row").getField(text_col))).cast("binary")
    keyed = state.withColumn("digit", F.substring(bytes_, offset + 1, width)).withColumn("id", F.col("row").getField(id_col))
    counts = keyed.groupBy("grp", "digit").agg(
        F.count("*").alias("n"), F.max("id").alias("top"), F.coalesce(F.max_by("number", "id"), F.max("number")).alias("pick")
    )
    counts = stored(counts.where("n > 1").withColumn("next", F.monotonically_increasing_id()), "radix-counts")
    joined = keyed.join(counts, ["grp", "digit"], "left")
    alone = F.col("n").isNull()
    step = joined.select(
        "row",
        "number",
        "next",
        (alone | (F.octet_length("digit") < width)).alias("settled"),
        F.when(alone, F.col("id")).otherwise(F.col("top")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("number") == F.col("pick"))).alias("kept"),
    )
    step = stored(step, "radix-round")
    discard(counts)
    return step
