"""WARC archives as a Python data source: `spark.read.format("warc")` and `df.write.format("warc")`.

Reading plans one partition per byte range of a file. A partition starts at the last place before its
range that the index beside the file has (at the file's start for files of others, which have none),
walks record headers and jumps over payloads by their length, so a record that no predicate wants costs its header only. Equality
and IN predicates on the record type and on header columns are pushed into the walk; the payload is
read and decoded only for records that pass, and only if the payload column is asked for. Files are
opened with pyarrow's file systems, so any store that those and Spark both reach will do.

Archives are written one file per task, to a temporary name that the commit takes away. A task that
runs again writes another file, and files of failed attempts are removed.
"""

from __future__ import annotations

import gzip
import io
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    WriterCommitMessage,
)

from tallymill.llm.common import masked, whole
from tallymill.session import work_path

VERSION = b"WARC/1.1"
# Header of each column (fixed values of the format; the last is an extension of ours).
HEADERS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
    "content_type": "Content-Type",
    "full_length": "X-Payload-Length",
}
SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in HEADERS] + [T.StructField("content_length", T.LongType()), T.StructField("payload", T.BinaryType())])
RANGE = 64 << 20  # bytes of a plain file per partition
MOST_HEADERS = 1 << 20  # bytes of a header value; what is longer goes on in lines of its own, which the reader joins
INDEX = ".idx"  # after the name of a plain file: where records begin, about one for each `EVERY` bytes
EVERY = 1 << 20
MORE = "X-More-"  # before the name of the header that goes on


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def _uri(path: str) -> str:
    """file:/x, which Hadoop writes, as file:///x."""
    return "file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path


def one_line(value: str) -> str:
    """A header value; line ends and the bytes that would break the block are percent-encoded."""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if "\r" in value or "\n" in value else value


def record(headers: dict[str, str | None], payload: bytes) -> bytes:
    lines = [VERSION]
    for k, v in headers.items():
        value = b"" if v is None else one_line(v).encode()
        if len(value) <= MOST_HEADERS // 2:
            lines += [] if v is None else [f"{k}: ".encode() + value]
            continue
        # in hex, so that no cut falls inside a character or beside a space that a reader would strip
        lines += [f"{k}: ".encode(), *[f"{MORE}{k}: {value[i : i + MOST_HEADERS // 4].hex()}".encode() for i in range(0, len(value), MOST_HEADERS // 4)]]
    lines.append(b"Content-Length: %d" % len(payload))
    return b"\r\n".join(lines) + b"\r\n\r\n" + payload + b"\r\n\r\n"


def read_headers(file) -> tuple[dict[str, str], int] | None:
    """The next record's headers (names in lower case) and their size, or None at the end."""
    line = file.readline(MOST_HEADERS)
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"no WARC record here: {line[:40]!r}")
    headers, more, size = {}, {}, len(line)
    while True:
        line = file.readline(MOST_HEADERS)
        size += len(line)
        if line in (b"\r\n", b"\n", b""):
            return headers | {k: b"".join(v).decode("utf-8", "replace") for k, v in more.items()}, size
        if len(line) >= MOST_HEADERS and not line.endswith(b"\n"):
            raise ValueError("a header line is too long")
        name, _, value = line.decode("utf-8", "replace").rstrip("\r\n").partition(":")
        name = name.strip().lower()
        if name.startswith(MORE.lower()):
            more.setdefault(name[len(MORE) :], []).append(bytes.fromhex(value.strip()))
        else:
            headers[name] = value.strip()


@dataclass
class _Range(InputPartition):
    path: str
    start: int
    end: int

    def __init__(self, path: str, start: int, end: int) -> None:
        self.path, self.start, self.end = path, start, end


@dataclass
class _Wanted:
    """One pushed predicate on a header column: its value is one of `values`, or any if None."""

    column: str
    values: tuple | None

    def holds(self, row: dict) -> bool:
        value = row.get(self.column)
        return value is not None if self.values is None else value in self.values


class WarcReader(DataSourceReader):
    def __init__(self, path: str, schema: T.StructType, span: int) -> None:
        self.path, self.schema, self.span = _uri(path), schema, span
        self.wanted: list[_Wanted] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        columns = {*HEADERS, "content_length"}
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name in columns and isinstance(f, (EqualTo, EqualNullSafe)) and f.value is not None:
                self.wanted.append(_Wanted(name, (f.value,)))
            elif name in columns and isinstance(f, In):
                self.wanted.append(_Wanted(name, tuple(v for v in f.value if v is not None)))
            elif name in columns and isinstance(f, IsNotNull):
                self.wanted.append(_Wanted(name, None))
            else:
                yield f

    def partitions(self) -> Sequence[InputPartition]:
        fs, path = _open(self.path)
        info = fs.get_file_info(path)
        found = [info] if info.type == pafs.FileType.File else fs.get_file_info(pafs.FileSelector(path, recursive=True))
        ranges: list[InputPartition] = []
        for f in sorted(found, key=lambda f: f.path):
            if f.type != pafs.FileType.File or not f.path.endswith((".warc", ".warc.gz")):
                continue
            step = f.size if f.path.endswith(".gz") else self.span  # a compressed file has no places to start from
            ranges += [_Range(f.path, at, min(at + step, f.size)) for at in range(0, f.size, max(step, 1))]
        return ranges or [_Range("", 0, 0)]

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        fs, _ = _open(self.path)
        names = [f.name for f in self.schema.fields]
        arrow = pa.schema([(f.name, {"bigint": pa.int64(), "binary": pa.binary()}.get(f.dataType.simpleString(), pa.string())) for f in self.schema.fields])
        rows, held = [], 0
        packed = partition.path.endswith(".gz")
        with fs.open_input_stream(partition.path, compression=None) if packed else fs.open_input_file(partition.path) as raw:
            file = gzip.GzipFile(fileobj=raw) if packed else io.BufferedReader(raw, 1 << 20)
            at = 0 if packed else _indexed(fs, partition)
            file.seek(at)
            while packed or at < partition.end:
                found = read_headers(file)
                if found is None:
                    break
                headers, size = found
                length = int(headers.get("content-length", 0))
                row: dict = {c: headers.get(h.lower()) for c, h in HEADERS.items()}
                row["content_length"] = length
                mine = packed or at >= partition.start
                if mine and "payload" in names and all(w.holds(row) for w in self.wanted):
                    row["payload"] = file.read(length)
                    file.read(4)
                elif packed:
                    _skip(file, length + 4)
                else:
                    file.seek(at + size + length + 4)
                at += size + length + 4
                if mine and all(w.holds(row) for w in self.wanted):
                    rows.append([row.get(n) for n in names])
                    held += length if "payload" in names else 0
                    if len(rows) >= 2000 or held >= 16 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), arrow, strict=True)], schema=arrow)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), arrow, strict=True)], schema=arrow)


def _indexed(fs: pafs.FileSystem, partition: _Range) -> int:
    """Where the last record begins that the index beside the file has before the range; 0 without an index."""
    if not partition.start or fs.get_file_info(f"{partition.path}{INDEX}").type != pafs.FileType.File:
        return 0
    with fs.open_input_file(f"{partition.path}{INDEX}") as file:
        places = np.frombuffer(file.read(), "<i8")
    found = int(np.searchsorted(places, partition.start, "right"))
    return int(places[found - 1]) if found else 0


def _skip(file, size: int) -> None:
    """Pass over a payload of a compressed file in pieces; it is inflated but not kept."""
    while size > 0:
        size -= len(file.read(min(size, 1 << 20)) or b" " * size)


@dataclass
class _Written(WriterCommitMessage):
    path: str
    records: int


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, schema: T.StructType, packed: bool, overwrite: bool) -> None:
        self.path, self.names, self.packed = _uri(path), [f.name for f in schema.fields], packed
        fs, at = _open(self.path)
        if overwrite and fs.get_file_info(at).type == pafs.FileType.Directory:
            fs.delete_dir_contents(at)
        fs.create_dir(at, recursive=True)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        fs, at = _open(self.path)
        name, n = f"{at}/part-{uuid.uuid4().hex}.warc{'.gz' * self.packed}", 0
        size, places = 0, [0]  # every `EVERY` bytes the place where a record begins
        with fs.open_output_stream(f"{name}.tmp", compression=None) as out:
            for batch in iterator:
                columns = {c: batch.column(i) for i, c in enumerate(self.names)}
                for i in range(batch.num_rows):
                    headers = {h: columns[c][i].as_py() for c, h in HEADERS.items() if c in columns}
                    payload = columns["payload"][i].as_py() if "payload" in columns else b""
                    data = record(headers, payload or b"")
                    out.write(gzip.compress(data, 6, mtime=0) if self.packed else data)
                    n += 1
                    if size - places[-1] >= EVERY:
                        places.append(size)
                    size += len(data)
        if n and not self.packed:
            with fs.open_output_stream(f"{name}{INDEX}", compression=None) as out:
                out.write(np.array(places, "<i8").tobytes())
        return _Written(name, n)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, _ = _open(self.path)
        for m in messages:
            if m is not None and m.records:
                fs.move(f"{m.path}.tmp", m.path)
            elif m is not None:
                fs.delete_file(f"{m.path}.tmp")

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, _ = _open(self.path)
        for m in messages:
            for made in (f"{m.path}.tmp", f"{m.path}{INDEX}") if m is not None else ():
                if fs.get_file_info(made).type == pafs.FileType.File:
                    fs.delete_file(made)


class WarcSource(DataSource):
    """Options: `path`; `range`, bytes per partition; `compression`, "gzip" for a member per record."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> T.StructType:
        return SCHEMA

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return WarcReader(self.options["path"], schema, int(self.options.get("range", RANGE)))

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        return WarcWriter(self.options["path"], schema, self.options.get("compression") == "gzip", overwrite)


def register(spark: SparkSession) -> None:
    """Make the source known to a session, with predicates pushed down."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 100) -> DataFrame:
    """A record per page, with `page` (its id) beside the columns of the source.

    Of payloads that agree and have `least` bytes, the page with the smallest id is the response and
    the others revisit it, without a payload of their own. Null html is an empty payload. Only
    payloads whose digest repeats are shuffled; the join has one row per digest on its small side. Pages that share an id and a
    payload are both responses.
    """
    payload = whole(F.col(html_col)).cast("binary")
    rows = pages.select(
        F.col(id_col).alias("page"), F.col(url_col).alias("url"), payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("size"), F.sha2(payload, 256).alias("digest"),
    )
    firsts = rows.where(F.col("size") >= least).groupBy("digest").agg(F.min("page").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    # payloads that nothing repeats go straight to the writer
    marked = masked(rows, "digest", firsts, "digest")
    first_type = marked.schema["page"].dataType
    lone = marked.where("not in_mask").withColumn("first", F.lit(None).cast(first_type))
    joined = lone.unionByName(marked.where("in_mask").join(firsts, "digest", "left"))
    again = F.col("first").isNotNull() & ~F.col("page").eqNullSafe(F.col("first"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    return joined.select(
        "page",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        urn(F.col("page")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit("1970-01-01T00:00:00Z").alias("date"),  # pages carry no time of capture
        F.when(again, urn(F.col("first"))).alias("refers_to"),
        F.concat(F.lit("sha256:"), "digest").alias("payload_digest"),
        F.lit("text/html; charset=utf-8").alias("content_type"),
        F.col("size").cast("string").alias("full_length"),
        F.when(again, F.lit(b"")).otherwise(F.col("payload")).alias("payload"),
    )


def archive(pages: DataFrame, path: str, compression: str = "none", **named) -> None:
    """Write `pages` as WARC files below `path`."""
    register(pages.sparkSession)
    records(pages, **named).drop("page").write.format("warc").option("compression", compression).mode("append").save(path)


def load(spark: SparkSession, path: str, span: int = RANGE, payload: bool = True) -> DataFrame:
    """The records below `path`. Without `payload`, payloads are passed over and not read."""
    register(spark)
    reader = spark.read.format("warc").option("range", str(span))
    return (reader if payload else reader.schema(T.StructType(SCHEMA.fields[:-1]))).load(path)


def round_trip(pages: DataFrame, **named) -> DataFrame:
    """The records of `pages`, written to the shared folder and read back.

    Responses are read with their payload, whose length and digest are computed anew; revisits are
    read by their headers alone.
    """
    path = work_path(pages.sparkSession, "llm-warc")
    archive(pages, path, **named)
    number = lambda c: F.regexp_extract(c, r"<urn:page:(-?\d+)>", 1).try_cast("long")
    spark = pages.sparkSession
    responses = load(spark, path).where("record_type = 'response'").select(
        number("record_id").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to"),
    )
    revisits = load(spark, path, payload=False).where("record_type = 'revisit'").select(
        number("record_id").alias("page_id"), F.col("full_length").cast("long").alias("payload_bytes"),
        F.substring_index("payload_digest", ":", -1).alias("payload_digest"), "record_type", number("refers_to").alias("refers_to"),
    )
    return responses.unionByName(revisits)
