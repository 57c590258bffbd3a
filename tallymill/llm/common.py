"""Shared tables between steps, and expressions that several operators use."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymill.session import work_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def whole(text: Column) -> Column:
    """The text, empty for null."""
    return F.coalesce(text, F.lit(""))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as Parquet to the folder that all executors share, and read it back.

    The written table cuts the lineage: executors lost later cost the tasks that read it, not the
    steps that made it. `discard` removes it once nothing that is still to run reads it.
    """
    path = work_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    made = df.sparkSession.read.schema(df.schema).parquet(path)
    made.stored_at = path
    return made


def discard(*tables: DataFrame) -> None:
    """Remove tables of `stored` whose last reader is done, and the shuffle files of what is no longer referred to.

    Spark's cleaner drops shuffle files when the driver's memory is collected, which otherwise
    happens by memory needed there, not by disk used on the executors.
    """
    for table in tables:
        spark = table.sparkSession
        place = spark._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    if tables:
        gc.collect()
        tables[0].sparkSession._jvm.System.gc()


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """`df` without input columns whose names an operator's own output takes."""
    taken = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in taken])


MASK_BITS = 23


def mask_place(key: Column) -> Column:
    """The bit of a key in `mask`."""
    return F.pmod(F.xxhash64(key), F.lit(1 << MASK_BITS))


def mask_table(keys: DataFrame, name: str) -> DataFrame:
    """`mask` as a table (word, bits) of at most 2^17 rows, small enough to broadcast whatever the keys."""
    place = mask_place(F.col(name))
    return keys.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(xxhash64({name}), 64) as int))")).alias("bits"))


def masked(rows: DataFrame, key: str, keys: DataFrame, name: str) -> DataFrame:
    """`rows` with `in_mask`: true for every row whose `key` is among `keys`, and for few others."""
    words = mask_table(keys, name).withColumnsRenamed({"word": "__word", "bits": "__bits"})
    place = mask_place(F.col(key))
    joined = rows.join(F.broadcast(words), F.shiftright(place, 6) == F.col("__word"), "left")
    hit = F.coalesce(F.getbit("__bits", F.pmod(place, F.lit(64)).cast("int")) == 1, F.lit(False))
    return joined.select(*[F.col(f"`{c}`") for c in rows.columns], hit.alias("in_mask"))


def leave_out(rows: DataFrame, key: str, keys: DataFrame, name: str) -> DataFrame:
    """`rows` whose `key` is not among `keys` (null is like null); only rows that the mask lets through are shuffled for it."""
    keys = stored(keys.select(F.col(name).cast(rows.schema[key].dataType).alias("__key")).distinct(), "left-out")  # read twice
    marked = masked(rows, key, keys, "__key")
    left = marked.where("in_mask")
    left = left.join(keys, left[key].eqNullSafe(keys["__key"]), "left_anti")
    return marked.where("not in_mask").unionByName(left).drop("in_mask")


def mask(keys: DataFrame, name: str) -> np.ndarray:
    """One bit set for each key, 2^23 bits whatever the number of keys.

    It keeps most rows without a partner out of a join that is exact without it. It is a megabyte on
    the driver and in each executor, and with very many keys it merely lets more rows through.
    """
    found = mask_table(keys, name).toPandas()  # 131,072 rows at most
    bits = np.zeros(1 << (MASK_BITS - 6), np.int64)
    bits[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return bits


def in_mask(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (bits[places >> 6] >> (places & 63)) & 1 == 1


#: What operators remember in a Python worker from task to task, by operator.
REMEMBERED: dict[str, Any] = {}


def tidy(run: Callable[[Iterator[Any]], Iterator[Any]], owner: str = "") -> Callable[[Iterator[Any]], Iterator[Any]]:
    """`run` for `mapInArrow`, in a worker that Spark goes on to use for other operators.

    What another operator than `owner` remembers there is dropped first, and memory that is free is
    given back at the end, or a worker would hold the most that any operator has ever needed.
    """

    def wrapped(batches: Iterator[Any]) -> Iterator[Any]:
        from tallymill.llm import common  # the worker's own, not a copy that travels with the function

        for name in [n for n in common.REMEMBERED if n != owner]:
            del common.REMEMBERED[name]
        yield from run(batches)
        common.give_back()

    return wrapped


def give_back() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)
