"""Schema and referential contracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _broken(field: T.StructField) -> Column:
    col = F.col(f"`{field.name}`")
    empty = col.isNull() | (col.cast("string") == "")
    if isinstance(field.dataType, T.StringType):
        return empty
    return empty | col.try_cast(field.dataType).isNull()


def _check_fields(df: DataFrame, schema: T.StructType) -> None:
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"fields missing from the data: {missing}")


def contract_report(df: DataFrame, schema: T.StructType) -> DataFrame:
    """(field, n_bad, n_rows): values that are null, empty or not of the declared type; one scan."""
    _check_fields(df, schema)
    totals = df.agg(
        F.count("*").alias("n_rows"), *[F.count_if(_broken(f)).alias(f"b{i}") for i, f in enumerate(schema)]
    )
    per_field = F.array(
        *[F.struct(F.lit(f.name).alias("field"), F.col(f"b{i}").alias("n_bad")) for i, f in enumerate(schema)]
    )
    return totals.select(F.inline(per_field), "n_rows")


def require_contract(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The same rows; the job fails at the first row that breaks the contract."""
    _check_fields(df, schema)
    guarded = {}
    for f in schema:
        message = F.lit(f"field {f.name} is missing, empty or of the wrong type")
        guarded[f.name] = F.when(~_broken(f), F.col(f"`{f.name}`")).otherwise(
            F.raise_error(message).cast(df.schema[f.name].dataType)
        )
    return df.withColumns(guarded)


def orphan_keys(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys that are not in the parent, with their number of rows; a warning, not a failure.

    The child is reduced to one row per key before the join, so a hot key costs one row per task.
    """
    per_key = (
        child.where(F.col(child_key).isNotNull())
        .groupBy(F.col(child_key).alias("key"))
        .agg(F.count("*").alias("n_rows"))
    )
    return per_key.join(parent.select(F.col(parent_key).alias("key")), "key", "left_anti").withColumn(
        "severity", F.lit("warn")
    )
