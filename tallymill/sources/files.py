"""File sources and sinks: CSV, Parquet, JSON, literal rows, file-name columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymill.functions.text import file_name_parts


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header. Without a schema the types are inferred, which reads the files twice."""
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def read_parquet(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    paths = [path] if isinstance(path, str) else path
    return spark.read.schema(schema).parquet(*paths)


def read_catalogue(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A JSON array of objects, pretty-printed or not, as rows."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def base_name(path: Column) -> Column:
    """Last part of a path or URL column, with %20 read as a space."""
    return F.replace(F.substring_index(path, "/", -1), F.lit("%20"), F.lit(" "))


def with_file_dims(df: DataFrame) -> DataFrame:
    """Rows of a file source plus `file_name` and the dimensions it carries (`file_year`, ...)."""
    name = base_name(F.col("_metadata.file_name"))
    parts = file_name_parts(F.col("file_name"))
    return df.select("*", name.alias("file_name")).withColumns({f"file_{k}": v for k, v in parts.items()})


def read_counts(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Every count CSV under `root` as one DataFrame with file dimensions; no loop over files."""
    return with_file_dims(
        spark.read.schema(schema).option("header", True).option("recursiveFileLookup", True).csv(root)
    )


def is_complete(spark: SparkSession, folder: str) -> bool:
    """Whether a write to `folder` has come to its end, by the mark that Spark leaves last."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)
