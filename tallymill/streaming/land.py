"""Running streams to the end of what is available, and the sinks they land in.

Every query needs its own checkpoint. Sinks without transactions are written one folder per batch
id with overwrite, so a batch that runs again after a failure replaces itself.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tallymill.session import folders_side_by_side
from tallymill.sources.tables import append_jdbc, save
from tallymill.sources.versions import VersionedTable


def run_available(writer: DataStreamWriter) -> StreamingQuery:
    """Process everything available now, in as many batches as the source options ask for, then stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run_for(writer: DataStreamWriter, seconds: float) -> None:
    """Run for a bounded time; the query is stopped whatever happens."""
    query = writer.start()
    try:
        query.awaitTermination(seconds)
    finally:
        query.stop()


def file_writer(
    df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", by: Sequence[str] = (), **options: str
) -> DataStreamWriter:
    writer = df.writeStream.format(fmt).outputMode("append").options(**options)
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    return writer.partitionBy(*by) if by else writer


def land(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", by: Sequence[str] = (), **options: str):
    """Append a stream to files, optionally routed into one folder per value of `by`."""
    return run_available(file_writer(df, path, checkpoint, fmt, by, **options))


def each_batch(df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return run_available(df.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint))


def write_batch(df: DataFrame, path: str, batch_id: int, by: Sequence[str] = ()) -> str:
    """Store one batch under its id; running it again replaces it.

    With `by`, the rows of a folder are brought together first, or each task would add a file to each
    folder; a folder that holds most rows is still split over tasks.
    """
    target = f"{path}/batch_id={batch_id}"
    writer = (df.hint("rebalance", *by) if by else df).write.mode("overwrite")
    with folders_side_by_side(df.sparkSession):
        (writer.partitionBy(*by) if by else writer).parquet(target)
    return target


def land_batches(df: DataFrame, path: str, checkpoint: str, by: Sequence[str] = ()) -> StreamingQuery:
    return each_batch(df, lambda batch, batch_id: write_batch(batch, path, batch_id, by) and None, checkpoint)


def land_once(df: DataFrame, path: str, query: str, checkpoint: str) -> StreamingQuery:
    """Append a stream to the versioned table at `path`; a batch that runs again is not added again.

    `query` names the stream in the table's ledger: give a stream that starts over with a new
    checkpoint a new name, since its batches are counted from 0 again.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        VersionedTable(batch.sparkSession, path).append(batch, query, batch_id)

    return each_batch(df, handle, checkpoint)


def _logged(handle: Callable[[DataFrame], None], ledger: str | None, query: str) -> Callable[[DataFrame, int], None]:
    """`handle` for batches that the ledger does not know yet; a batch is entered when it was handled."""

    def once(batch: DataFrame, batch_id: int) -> None:
        book = VersionedTable(batch.sparkSession, ledger) if ledger else None
        if book and book.done(query, batch_id):
            return
        handle(batch)
        if book:
            entry = batch.sparkSession.createDataFrame([(query, batch_id)], "query string, batch_id bigint")
            book.append(entry, query, batch_id)

    return once


def land_jdbc(
    df: DataFrame, url: str, table: str, properties: Mapping[str, str], checkpoint: str, ledger: str | None = None
) -> StreamingQuery:
    """Append a stream over JDBC. With `ledger`, a folder, batches that are entered there are skipped.

    The store is not part of the ledger's commit: a batch that breaks after its append and before
    its entry is appended again.
    """
    handle = lambda batch: append_jdbc(batch, url, table, properties)
    return each_batch(df, _logged(handle, ledger, table), checkpoint)


def land_connector(
    df: DataFrame, fmt: str, options: Mapping[str, str], checkpoint: str, mode: str = "append", ledger: str | None = None
) -> StreamingQuery:
    """Write a stream through a connector, batch by batch; `ledger` as in `land_jdbc`."""
    return each_batch(df, _logged(lambda batch: save(batch, fmt, mode, options), ledger, fmt), checkpoint)
