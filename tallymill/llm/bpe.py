"""Byte-level BPE: encoding by a queue of merge ranks, decoding by joining vocabulary strings.

A piece of text is a doubly linked list of symbols. All neighbouring pairs that can merge stand in
a priority queue by rank, then by place; an entry whose symbols have changed since is skipped.
Short pieces, which are nearly all, are merged on plain lists in the same order.
The vocabulary file has a fixed size and is sent to the executors; pieces are remembered between
documents up to a fixed number, as packed ids.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallymill.llm.common import REMEMBERED as REMEMBERED_BY
from tallymill.llm.common import tidy, without

# The usual splitting rule of byte-level BPE vocabularies (fixed value).
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
REMEMBERED = 100_000  # pieces per task process and generation, of which there are two; about 17 MB each
SHORT = 48  # bytes of a piece whose pairs are looked through for the next one to merge
LONGEST = 64  # characters of a piece that is remembered
BLOCK = 128  # documents whose ids and texts a task holds before they go on


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Bpe:
    """Encoder and decoder of one vocabulary file (the JSON text of a `tokenizers` BPE model)."""

    def __init__(self, source: str) -> None:
        model = json.loads(source)
        vocab = model["model"]["vocab"]
        letters = _byte_letters()
        back = {c: b for b, c in letters.items()}
        self.byte_ids = [vocab[letters[b]] for b in range(256)]
        self.strings = {i: bytes(back[c] for c in t) for t, i in vocab.items() if all(c in back for c in t)}
        self.special = {t["content"]: t["id"] for t in model.get("added_tokens", [])}
        self.decimals: dict[int, str] = {}
        self.strings |= {i: t.encode() for t, i in self.special.items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
        self.made = [vocab[a + b] for a, b in pairs]
        self.ranks = {(vocab[a], vocab[b]): rank for rank, (a, b) in enumerate(pairs)}
        self.pieces = regex.compile(PIECES)
        marks = sorted(self.special, key=len, reverse=True)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, marks)) + ")") if marks else None

    def merge(self, data: bytes) -> list[int]:
        """Ids of one piece."""
        n = len(data)
        byte_ids, ranks, merged = self.byte_ids, self.ranks, self.made
        ids = [byte_ids[b] for b in data]
        found = ranks.get
        if n <= SHORT:
            # the queue is a plain list, whose smallest entry is the leftmost pair of lowest rank
            none = len(merged)
            queue = [found(pair, none) for pair in zip(ids, ids[1:])]
            while queue and (rank := min(queue)) < none:
                i = queue.index(rank)
                ids[i] = made = merged[rank]
                del ids[i + 1], queue[i]
                if i < len(queue):
                    queue[i] = found((made, ids[i + 1]), none)
                if i:
                    queue[i - 1] = found((ids[i - 1], made), none)
            return ids
        queue = [(r, i) for i, pair in enumerate(zip(ids, ids[1:])) if (r := found(pair)) is not None]
        if not queue:
            return ids
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heapq.heapify(queue)
        pop, push = heapq.heappop, heapq.heappush
        while queue:
            rank, i = pop(queue)
            j = after[i]
            if j >= n or found((ids[i], ids[j])) != rank:
                continue  # stale: one of the two has merged since
            made, k = merged[rank], after[j]
            ids[i], ids[j], after[i] = made, -1, k
            if k < n:
                before[k] = i
                if (r := found((made, ids[k]))) is not None:
                    push(queue, (r, i))
            h = before[i]
            if h >= 0 and (r := found((ids[h], made))) is not None:
                push(queue, (r, h))
        return [x for x in ids if x >= 0]

    def parts(self, text: str) -> list[str]:
        """Pieces of the text; the string of a special token is a piece of its own."""
        if self.marks is None or not any(m in text for m in self.special):
            return self.pieces.findall(text)
        found = []
        for part in self.marks.split(text):
            found += [part] if part in self.special else self.pieces.findall(part)
        return found

    def piece(self, part: str) -> list[int]:
        mark = self.special.get(part)
        return self.merge(part.encode()) if mark is None else [mark]

    def encode(self, text: str) -> list[int]:
        return [i for part in self.parts(text) for i in self.piece(part)]

    def listed(self, ids: list[int]) -> str:
        """The ids in decimal, joined by commas."""
        if not self.decimals:
            self.decimals = {i: str(i) for i in self.strings}
        return ",".join(map(self.decimals.__getitem__, ids))

    def decode_bytes(self, ids: list[int]) -> bytes:
        return b"".join(map(self.strings.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        """Text of the ids; bytes that are no UTF-8 become the replacement character."""
        return self.decode_bytes(ids).decode("utf-8", "replace")


class _Memory:
    """Ids of pieces seen before, four bytes each, as what a document's ids are joined from.

    When a generation is full it becomes the old one: what is met again moves to the new one, and
    what is not is gone with the next change.
    """

    def __init__(self, bpe: Bpe) -> None:
        self.bpe = bpe
        self.ids: dict[str, bytes] = {}
        self.old_ids: dict[str, bytes] = {}

    def of(self, text: str) -> np.ndarray:
        parts = self.bpe.parts(text)
        if len(self.ids) > REMEMBERED:
            self.old_ids, self.ids = self.ids, {}
        ids, own = self.ids, {}
        for part in set(parts).difference(ids):
            if (kept := self.old_ids.get(part)) is None:
                kept = array("i", self.bpe.piece(part)).tobytes()
            if len(part) > LONGEST:
                own[part] = kept
            else:
                ids[part] = kept
        found = [own[p] if p in own else ids[p] for p in parts] if own else map(ids.__getitem__, parts)
        return np.frombuffer(b"".join(found), np.int32)


def _memory(source: str) -> _Memory:
    """One per process and vocabulary: tasks of a reused worker share it."""
    key, made = REMEMBERED_BY.get("bpe", (None, None))
    if key != hash(source):
        made = _Memory(Bpe(source))
        REMEMBERED_BY["bpe"] = hash(source), made
    return made


def _texts(column: pa.ChunkedArray | pa.Array) -> Iterator[str]:
    for x in column:
        yield x.as_py() or ""


def _with(docs: DataFrame, path: str, added: list[T.StructField], of_text, text_col: str) -> DataFrame:
    """`docs` with columns that `of_text(memory, text)` gives for each text, in small blocks."""
    docs = without(docs, [f.name for f in added])
    schema = T.StructType([*docs.schema.fields, *added])
    with open(path, encoding="utf-8") as file:  # on the driver
        source = docs.sparkSession.sparkContext.broadcast(file.read())
    types = pa.schema([(f.name, pa.list_(pa.int32()) if isinstance(f.dataType, T.ArrayType) else pa.int64() if isinstance(f.dataType, T.LongType) else pa.string()) for f in added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _memory(source.value)
        for whole in batches:
            for start in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(start, BLOCK)
                made = [of_text(memory, text) for text in _texts(batch.column(text_col))]
                columns = [pa.array([m[i] for m in made], t.type) for i, t in enumerate(types)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *types.names])

    return docs.mapInArrow(tidy(run, "bpe"), schema)


def _encoded(memory: _Memory, text: str) -> tuple[np.ndarray, str]:
    ids = memory.of(text)
    return ids, memory.bpe.decode(ids.tolist())


def _digested(memory: _Memory, text: str) -> tuple[int, str, str]:
    ids = memory.of(text).tolist()
    decoded = memory.bpe.decode(ids).encode()
    return len(ids), hashlib.sha256(memory.bpe.listed(ids).encode()).hexdigest(), hashlib.sha256(decoded).hexdigest()


def encode(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """`docs` with `ids` (array of int) and `decoded` (the text that the ids decode to).

    Null text counts as empty and gives no ids. Strings of special tokens in a text become those
    tokens. Input columns named like the new ones are replaced.
    """
    added = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]
    return _with(docs, path, added, _encoded, text_col)


def digests(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """As `encode`, with digests in place of the ids and the text: `n_tokens`, `ids_sha256`, `decoded_sha256`."""
    added = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    return _with(docs, path, added, _digested, text_col)
