"""Shards by extendible hashing.

The directory is indexed by the leading bits of a document's hash. Only buckets over the byte limit
are split on another bit; the rest keep their depth. A round reads `STEP` bits: bytes are summed once
per prefix of that many bits, combined on the map side, and the shallower prefixes are summed from
those, so a round costs one small shuffle and touches only documents of buckets still too large.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.llm.common import stored, whole, without

HALF = 60  # bits from the id; as many again from the row's number
STEP = 12
ADDED = ["shard", "depth", "shard_bytes", "shard_rows", "fits"]


def _hash(value: Column) -> Column:
    """60 evenly spread bits as a long."""
    hexed = F.substring(F.md5(value.cast("string").cast("binary")), 1, HALF // 4)
    return F.conv(hexed, 16, 10).cast("long")


def _bits(hashed: Column) -> Column:
    return F.lpad(F.conv(hashed.cast("string"), 10, 2), HALF, "0")


def _prefix(depth: int) -> Column:
    first = F.substring(_bits(F.col("__h")), 1, depth)
    return first if depth <= HALF else F.concat(first, F.substring(_bits(_hash(F.col("__n"))), 1, depth - HALF))


def directory(rows: DataFrame, limit: int) -> DataFrame:
    """The leaves: `shard` (prefix), `depth`, `shard_bytes`, `shard_rows`. Reads `__h`, `__n`, `__size`."""
    columns = ["shard", "depth", "shard_bytes", "shard_rows"]
    sums = [F.sum("__size").alias("shard_bytes"), F.count("*").alias("shard_rows")]
    root = stored(rows.groupBy(F.lit("").alias("shard"), F.lit(0).alias("depth")).agg(*sums), "shard-root")
    over = (F.col("shard_bytes") > limit) & (F.col("shard_rows") > 1)
    leaves = root.where(~over).select(columns)
    if root.where(over).isEmpty():
        return leaves
    open_rows, at = rows, 0
    while True:
        to = min(at + STEP, 2 * HALF)
        cells = open_rows.groupBy(_prefix(to).alias("cell")).agg(*sums)
        levels = stored(
            cells.select("*", F.explode(F.sequence(F.lit(at + 1), F.lit(to))).alias("depth"))
            .groupBy("depth", F.expr("substring(cell, 1, depth)").alias("shard"))
            .agg(F.sum("shard_bytes").alias("shard_bytes"), F.sum("shard_rows").alias("shard_rows"))
            .withColumn("over", over & (F.col("depth") < 2 * HALF)),
            "shard-levels",
        )
        split = levels.where("over").select(F.col("shard").alias("parent"))
        # a bucket exists if its parent was split; in the round's first level all parents were
        deeper = levels.where(F.col("depth") > at + 1).withColumn("parent", F.expr("substring(shard, 1, depth - 1)"))
        born = levels.where(F.col("depth") == at + 1).unionByName(deeper.join(split, "parent", "left_semi").drop("parent"))
        leaves = leaves.unionByName(born.where("not over").select(columns))
        left = stored(born.where(F.col("over") & (F.col("depth") == to)).select(F.col("shard").alias("__cell")), "shard-left")
        if left.isEmpty():
            return leaves
        open_rows = open_rows.withColumn("__cell", _prefix(to)).join(left, "__cell", "left_semi").drop("__cell")
        at = to


def shard(docs: DataFrame, limit: int, id_col: str = "doc_id", text_col: str = "text", size: Column | None = None) -> DataFrame:
    """All rows of `docs` with `shard` (a hash prefix), `depth`, `shard_bytes`, `shard_rows`, `fits`.

    A row's size is `size`, by default its text in UTF-8 bytes; null counts as empty. Every shard is
    within `limit`, but for a single row that is larger by itself: it has a shard to itself, and
    `fits` is false. The hash is that of the id; rows that share an id, or have none, are split by
    further bits from the row's number in the stored table. A table within the limit is one shard
    with the empty prefix; an empty table gives no row. Input columns named like the new ones are
    replaced.
    """
    docs = without(docs, ADDED)
    size = F.octet_length(whole(F.col(text_col))) if size is None else size
    rows = docs.select(
        "*",
        _hash(whole(F.col(id_col).cast("string"))).alias("__h"),
        F.monotonically_increasing_id().alias("__n"),
        F.coalesce(size.cast("long"), F.lit(0)).alias("__size"),
    )
    rows = stored(rows, "shard-rows")
    leaves = stored(directory(rows.select("__h", "__n", "__size"), limit), "shard-leaves")
    depths = sorted(r[0] for r in leaves.select("depth").distinct().collect())  # 121 at most
    slots = F.array(*[_prefix(d) for d in depths]) if depths else F.array(F.lit(""))
    # a row is in one leaf, at one of the depths that occur
    found = rows.select("__n", F.explode(slots).alias("shard")).join(leaves, "shard")
    out = rows.join(found, "__n").withColumn("fits", F.col("shard_bytes") <= limit)
    return out.select(*docs.columns, *ADDED)


def write_shards(docs: DataFrame, path: str, limit: int, **named) -> None:
    """Write each shard as one Parquet folder `shard=b<prefix>` below `path`; the letter keeps prefixes from being read as numbers."""
    placed = shard(docs, limit, **named).drop("depth", "shard_bytes", "shard_rows", "fits")
    placed = placed.withColumn("shard", F.concat(F.lit("b"), "shard"))
    placed.repartition("shard").write.partitionBy("shard").parquet(path)
