"""Removes repeated byte strings of a minimum length, by Burrows-Wheeler transforms of what may repeat.

Every window of `least` bytes has an anchor: the gram with the smallest hash in it, the leftmost of
equals. Equal windows have equal anchors, so windows that do not share their anchor with another
place are settled by one small row per anchor. The bytes around an anchor whose windows it stands
for are its segment. Segments that agree are told by a digest: all but the first are repeats in
full, and within a block of documents they do not even leave the task. Only the first of each of
several different segments of an anchor is cut out. Its windows fall into pieces by where the anchor
stands in them; windows of one piece share most of their bytes, and equal windows are in pieces that
share them all. Pieces that share theirs with no other are dropped, the rest goes to the interval
expansion in `bwt`, which says which windows agree. An anchor with more different segments than one
transform takes is split into its pieces first, and those into smaller ones where that is not enough.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymill.llm.bwt import window_groups
from tallymill.llm.common import in_mask, mask, mask_place, stored, whole, without

LEAST = 100
GRAM = 24  # bytes of an anchor
PIECE = 1 << 22  # windows of a text that are hashed at a time; an anchor's place takes 24 bits
BLOCK = 1 << 25  # bytes of documents whose equal segments are combined before they are shuffled
TEXT = 1 << 21  # bytes of segments in one transform
MOST = 4096  # different segments of an anchor that go through one transform; more are split into pieces
BASE = 0x9E3779B97F4A7C15 | 1
_TABLE = np.random.default_rng(11).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW = {"up": _powers(BASE, 1), "down": _powers(BASE, 1)}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if len(_POW["up"]) < n:
        n = min(max(2 * n, 1 << 16), PIECE + 4 * LEAST) if n <= PIECE + 4 * LEAST else n
        _POW["up"], _POW["down"] = _powers(BASE, n), _powers(pow(BASE, -1, 1 << 64), n)
    return _POW["up"], _POW["down"]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def anchors(data: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(anchor, segment digest, first window, further windows) of the segments of a text, piece by piece."""
    for at in range(0, len(data) - least + 1, PIECE):
        part = data[at : at + PIECE + least - 1]
        n, up_down = len(part), _power(len(part) + 1)
        up, down = up_down
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_TABLE[part] * up[:n], out=sums[1:])
        grams = _mix((sums[GRAM:] - sums[:-GRAM]) * down[: n - GRAM + 1])
        keyed = (grams & np.uint64(0xFFFFFFFFFF000000)) | np.arange(len(grams), dtype=np.uint64)
        span, width = least - GRAM + 1, 1
        while 2 * width <= span:  # smallest of the next 2, 4, 8, ... grams
            keyed = np.minimum(keyed[:-width], keyed[width:])
            width *= 2
        if span > width:
            keyed = np.minimum(keyed[: len(keyed) - (span - width)], keyed[span - width :])
        place = (keyed & np.uint64(0xFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        last = np.r_[first[1:], len(place)] - 1
        anchor = grams[place[first]]
        shape = ((last - first) * 4096 + place[first] - first).astype(np.uint64)
        digest = _mix(_mix((sums[last + least] - sums[first]) * down[first]) + shape * np.uint64(BASE))
        yield anchor, digest, first + at, last - first


def _segments(least: int):
    """Rows (anchor, digest, doc, at, more, again): the segments of a block; `again` if an equal one of the block is earlier."""
    names = ["anchor", "digest", "doc", "at", "more", "again"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            anchor, digest, doc, at, more = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            order = np.lexsort((at, doc, digest, anchor))
            anchor, digest, doc, at, more = (x[order] for x in (anchor, digest, doc, at, more))
            again = np.r_[False, (anchor[1:] == anchor[:-1]) & (digest[1:] == digest[:-1])]
            columns = [anchor.view(np.int64), digest.view(np.int64), doc, at, more.astype(np.int32), again]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

        for batch in batches:
            for doc, text in zip(batch.column(0).to_numpy(), batch.column(1), strict=True):
                data = np.frombuffer(text.as_buffer() or b"", np.uint8) if text.is_valid else np.zeros(0, np.uint8)
                for anchor, digest, at, more in anchors(data, least):
                    held.append((anchor, digest, np.full(len(at), doc, np.int64), at, more))
                size += len(data)
                if size >= BLOCK and held:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    return run


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Input sorted by anchor, digest, document, place. Repeats in full (`whole`), and the first of each of
    several segments of an anchor. Only the last anchor's first row is held between batches."""
    names = ["anchor", "doc", "at", "more", "whole"]
    last: tuple[int, int] | None = None  # anchor and digest
    waiting: tuple | None = None  # the anchor's only segment so far
    for batch in batches:
        anchor, digest, doc, at, more, again = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(6))
        if again.any():
            yield _record(names, anchor[again], doc[again], at[again], more[again], np.ones(int(again.sum()), bool))
            anchor, digest, doc, at, more = (x[~again] for x in (anchor, digest, doc, at, more))
        if not len(anchor):
            continue
        new_anchor = np.r_[last is None or anchor[0] != last[0], anchor[1:] != anchor[:-1]]
        new = new_anchor | np.r_[last is None or digest[0] != last[1], digest[1:] != digest[:-1]]
        group = np.cumsum(new_anchor)  # 0: goes on from the batch before
        heads = np.bincount(group[new], minlength=int(group[-1]) + 1)
        several = heads > 1
        if not new_anchor[0]:
            several[0] = heads[0] > 0  # one came before
            if several[0] and waiting is not None:
                yield _record(names, *[np.array([v]) for v in waiting], np.array([False]))
                waiting = None
        out = ~new | several[group]
        if out.any():
            yield _record(names, anchor[out], doc[out], at[out], more[out], ~new[out])
        last = (anchor[-1], digest[-1])
        if group[-1]:  # the last anchor began in this batch
            k = int(np.flatnonzero(new_anchor)[-1])
            waiting = None if several[-1] else (anchor[k], doc[k], at[k], more[k])
        elif several[0]:
            waiting = None


def _record(names: list[str], *columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)


def _cut(least: int):
    """(anchor, doc, at, bytes) of the segments listed for each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                rows = []
                for row in batch.slice(start, 64).to_pylist():
                    data = row["text"].encode()
                    rows += [(s["anchor"], row["doc"], s["at"], data[s["at"] : s["at"] + s["more"] + least]) for s in row["cut"]]
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["anchor", "doc", "at", "bytes"])

    return run


def _steps(least: int) -> list[int]:
    """Places of an anchor that make a piece, from the widest pieces to single windows."""
    wide = -(-(least - GRAM + 1) // 4)
    return sorted({wide, -(-wide // 4), 1}, reverse=True)


def _pieces(gram: np.ndarray, data: np.ndarray, lengths: np.ndarray, least: int, step: int) -> tuple[np.ndarray, ...]:
    """(segment, first and last window, digest) of the windows with the anchor at `step` neighbouring places.

    The digest is of the bytes that lie in all windows of such a piece. `data` holds the segments one
    after the other, `gram` their anchors. Pieces of a segment come from its end to its start.
    """
    starts, more = np.cumsum(lengths) - lengths, lengths - least
    up, down = _power(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_TABLE[data] * up[: len(data)], out=sums[1:])
    sites = least - GRAM + 1 - more  # where a gram is in every window
    owner = np.repeat(np.arange(len(lengths)), sites)
    at = np.arange(len(owner)) - (np.cumsum(sites) - sites - starts - more)[owner]
    hit = np.flatnonzero(_mix((sums[at + GRAM] - sums[at]) * down[at]) == gram[owner])
    place = (at - starts[owner])[hit[np.r_[True, owner[hit[1:]] != owner[hit[:-1]]]]]  # the leftmost, as in `anchors`

    lowest = (place - more) // step
    count = place // step - lowest + 1
    owner = np.repeat(np.arange(len(lengths)), count)
    kind = np.arange(len(owner)) - (np.cumsum(count) - count - lowest)[owner]
    near, far = place[owner] - kind * step, place[owner] - np.minimum((kind + 1) * step - 1, least - GRAM)
    begin, end = starts[owner] + near, starts[owner] + far + least
    digest = _mix(_mix((sums[end] - sums[begin]) * down[begin]) + kind.astype(np.uint64) * np.uint64(BASE))
    return owner, np.maximum(far, 0), np.minimum(near, more[owner]), digest


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The strings of a column one after the other, and their lengths."""
    strings = column.to_pylist()
    return np.frombuffer(b"".join(strings), np.uint8), np.array([len(s) for s in strings], np.int64)


def _split(least: int, step: int):
    """(anchor, gram, doc, at, bytes) of the pieces of segments (gram, doc, at, bytes), each under its digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for start in range(0, whole_batch.num_rows, MOST):
                batch = whole_batch.slice(start, MOST)
                gram, doc, at = (batch.column(i).to_numpy() for i in range(3))
                data, lengths = _bytes(batch.column(3))
                owner, first, last, digest = _pieces(gram.view(np.uint64), data, lengths, least, step)
                begin = (np.cumsum(lengths) - lengths)[owner]
                text = data.tobytes()
                cut = [text[a:b] for a, b in zip(begin + first, begin + last + least, strict=True)]
                columns = [digest.view(np.int64), gram[owner], doc[owner], at[owner] + first]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(cut, pa.binary())], ["anchor", "gram", "doc", "at", "bytes"])

    return run


def _likely(batch: pa.RecordBatch, least: int) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(doc, at, bytes) of what is left of segments without the pieces that share their bytes with no other."""
    gram, doc, at = (batch.column(i).to_numpy() for i in (1, 2, 3))
    data, lengths = _bytes(batch.column(4))
    owner, first, last, digest = _pieces(gram.view(np.uint64), data, lengths, least, _steps(least)[0])
    order = np.argsort(digest)
    same = np.r_[False, digest[order[1:]] == digest[order[:-1]], False]
    shared = np.empty(len(order), bool)
    shared[order] = same[:-1] | same[1:]
    owner, first, last = owner[shared], first[shared], last[shared]
    if not len(owner):
        return doc[:0], at[:0], []
    runs = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (last[1:] + 1 != first[:-1])])
    first, last, owner = first[np.r_[runs[1:], len(first)] - 1], last[runs], owner[runs]
    begin, text = (np.cumsum(lengths) - lengths)[owner], data.tobytes()
    return doc[owner], at[owner] + first, [text[a:b] for a, b in zip(begin + first, begin + last + least, strict=True)]


def _expand(least: int):
    """Windows (doc, at, more) that an earlier segment has, by transforms of up to TEXT bytes; input (anchor, gram,
    doc, at, bytes) sorted by anchor."""

    def solve(doc: np.ndarray, at: np.ndarray, strings: list[bytes]) -> pa.RecordBatch:
        if not strings:
            return _record(["doc", "at", "more"], doc, at, np.zeros(0, np.int32))
        groups = window_groups(strings, least)
        sizes = [len(g) for g in groups]
        number = np.concatenate(groups)
        docs = np.repeat(doc, sizes)
        places = np.concatenate([a + np.arange(k) for a, k in zip(at, sizes, strict=True)])
        order = np.lexsort((places, docs, number))
        again = np.zeros(len(number), bool)
        again[order[1:]] = number[order[1:]] == number[order[:-1]]
        docs, places = docs[again], places[again]
        return _record(["doc", "at", "more"], docs, places, np.zeros(len(docs), np.int32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def done(batch: pa.RecordBatch) -> pa.RecordBatch:
            return _merged(solve(*_likely(batch, least)))

        for batch in batches:
            while batch.num_rows:
                ends = np.cumsum(pc.binary_length(batch.column(4)).to_numpy()) + size
                over = int(np.searchsorted(ends, TEXT))
                anchor = batch.column(0).to_numpy()
                # past the size, the text goes on to the end of its anchor
                k = over if over < batch.num_rows else batch.num_rows
                if over < batch.num_rows:
                    before = anchor[k - 1] if k else held[-1].column(0)[-1].as_py()
                    k += int(np.searchsorted(anchor[k:], before, "right"))
                held.append(batch.slice(0, k))
                size = int(ends[k - 1]) if k else size
                if k < batch.num_rows:
                    yield done(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
                    held, size = [], 0
                batch = batch.slice(k)
        if held:
            yield done(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    return run


def _merged(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Single windows as runs of neighbours."""
    doc, at, _ = (batch.column(i).to_numpy() for i in range(3))
    if not len(doc):
        return batch
    order = np.lexsort((at, doc))
    doc, at = doc[order], at[order]
    first = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (at[1:] > at[:-1] + 1)])
    last = np.r_[first[1:], len(doc)] - 1
    return _record(["doc", "at", "more"], doc[first], at[first], (at[last] - at[first]).astype(np.int32))


def repeats(texts: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc, at, more): runs of `more` + 1 windows that also start earlier. `texts`: `doc` (long, unique, the order), `text`."""
    rows = texts.mapInArrow(_segments(least), "anchor long, digest long, doc long, at long, more int, again boolean")
    key = F.when(F.col("again"), F.xxhash64("doc", "at")).otherwise(F.col("anchor"))
    dealt = rows.repartition(key).sortWithinPartitions("anchor", "digest", "doc", "at")
    settled = stored(dealt.mapInArrow(_settle, "anchor long, doc long, at long, more int, whole boolean"), "segments")
    found = settled.where("whole").select("doc", "at", "more")

    several = settled.where("not whole")
    many = _many(several)
    by_doc = several.groupBy("doc").agg(F.collect_list(F.struct("anchor", "at", "more")).alias("cut"))
    likely = kept_by(mask(by_doc, "doc"), texts, "doc")
    cut = likely.join(by_doc, "doc").select("doc", "text", "cut").mapInArrow(_cut(least), "anchor long, doc long, at long, bytes binary")
    cut = stored(cut, "cut").select("anchor", F.col("anchor").alias("gram"), "doc", "at", "bytes")
    windows = "doc long, at long, more int"
    for step in _steps(least):
        if many.isEmpty():
            break
        few, hot = cut.join(many, "anchor", "left_anti"), cut.join(many, "anchor", "left_semi")
        found = found.unionByName(_dealt(few).mapInArrow(_expand(least), windows))
        pieces = hot.select("gram", "doc", "at", "bytes").mapInArrow(_split(least, step), "anchor long, gram long, doc long, at long, bytes binary")
        pieces = stored(pieces, "pieces")
        first = pieces.groupBy("anchor", "gram", "bytes").agg(F.min(F.struct("doc", "at")).alias("first"), F.count("*").alias("n"))
        first = stored(first, "first-pieces")
        again = pieces.join(first.where("n > 1"), ["anchor", "gram", "bytes"]).where(F.struct("doc", "at") > F.col("first"))
        found = found.unionByName(again.select("doc", "at", (F.octet_length("bytes") - least).alias("more")))
        cut = first.select("anchor", "gram", "first.doc", "first.at", "bytes")
        many = _many(cut)
    return found.unionByName(_dealt(cut).mapInArrow(_expand(least), windows))


def _many(segments: DataFrame) -> DataFrame:
    """Anchors with more different segments than one transform takes."""
    return stored(segments.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > MOST).select("anchor"), "hot-anchors")


def _dealt(segments: DataFrame) -> DataFrame:
    return segments.repartition("anchor").sortWithinPartitions("anchor").select("anchor", "gram", "doc", "at", "bytes")


def kept_by(bits: np.ndarray, df: DataFrame, name: str, wanted: bool = True) -> DataFrame:
    """Rows whose key the mask lets through, or the others."""
    shared = df.sparkSession.sparkContext.broadcast(bits)

    @F.pandas_udf("boolean")
    def likely(place: pd.Series) -> pd.Series:
        return pd.Series(in_mask(shared.value, place.to_numpy()))

    chosen: Column = likely(mask_place(F.col(name)))
    return df.where(chosen if wanted else ~chosen)


def _spans(least: int):
    """Maximal removed runs and what is left, from a document's runs of windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                texts, runs = part.column(part.num_columns - 2), part.column(part.num_columns - 1)
                spans, kept = [], []
                for text, own in zip(texts, runs, strict=True):
                    data, out, left, at = (text.as_py() or "").encode(), [], [], 0
                    for begin, end in sorted((r["at"], r["at"] + r["more"] + least) for r in own.as_py() or []):
                        if out and begin <= out[-1]["end"]:
                            out[-1]["end"] = max(out[-1]["end"], end)
                        else:
                            out.append({"start": begin, "end": end})
                    for s in out:
                        left.append(data[at : s["start"]])
                        at = s["end"]
                    spans.append(out)
                    kept.append(b"".join([*left, data[at:]]))
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                columns = [*part.columns[:-2], pa.array(spans, kind), pa.array(kept, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names[:-2], "spans", "kept_bytes"])

    return run


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def remove(docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and all other columns of `docs` but the text, with `spans` (maximal removed byte ranges) and `kept_bytes`.

    A byte goes if a string of `least` bytes that covers it also starts earlier, in a document with a
    smaller id or earlier in the same one; all is judged on the input. Null text is empty. What is
    left need not be valid UTF-8. Ids are integers; rows that repeat an id, and rows without one (the
    smallest), are documents of their own in the order of their texts. Input columns named like the
    new ones are replaced.
    """
    if least < GRAM:
        raise ValueError(f"least must be {GRAM} or more")
    docs = without(docs, ["spans", "kept_bytes"])
    others = [c for c in docs.columns if c != text_col]
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), whole(F.col(text_col)).alias("text"), F.struct(*others).alias("row"))
    ids = rows.groupBy("doc").agg(F.count("*").alias("n"))
    if not ids.where("doc is null or n > 1").isEmpty():  # number the rows in order
        ordered = rows.orderBy(F.col("doc").asc_nulls_first(), "text")
        rows = stored(ordered.withColumn("doc", F.monotonically_increasing_id()), "numbered")
    found = stored(repeats(rows.select("doc", "text"), least), "repeats")
    by_doc = found.groupBy("doc").agg(F.collect_list(F.struct("at", "more")).alias("runs"))
    bits = mask(by_doc, "doc")
    touched = kept_by(bits, rows, "doc").join(by_doc, "doc", "left").select("row", "text", "runs")
    schema = T.StructType([rows.schema["row"], T.StructField("spans", SPANS), T.StructField("kept_bytes", T.BinaryType())])
    out = touched.mapInArrow(_spans(least), schema)
    rest = kept_by(bits, rows, "doc", wanted=False).select("row", F.array().cast(SPANS).alias("spans"), F.col("text").cast("binary").alias("kept_bytes"))
    return out.unionByName(rest).select("row.*", "spans", "kept_bytes")
