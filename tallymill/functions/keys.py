"""Row and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: text that stands for a null field inside a surrogate key.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*columns: Column | str) -> Column:
    """md5 over the fields joined by '-', nulls as a fixed token."""
    fields = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.md5(F.concat_ws("-", *[F.coalesce(c.cast("string"), F.lit(NULL_TOKEN)) for c in fields]))
