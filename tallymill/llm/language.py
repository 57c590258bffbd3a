"""Language identification from averaged embeddings of hashed subwords.

A text is lower-cased, everything but letters becomes a blank, and the hashed 2-, 3- and 4-byte
pieces of the whole text are averaged in an embedding that a linear softmax reads. Both are trained
by stochastic gradient descent on a bounded sample of labelled rows (`SAMPLE`). A temperature and a
least score are fitted on rows held back from that training. The product of embedding and softmax is
one small table, so scoring a text is one gather per subword, of fixed memory per block of text.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tallymill.llm.common import tidy, without

SAMPLE = {"rows_per_label": 1200, "rows": 12000, "chars": 1500}  # bounds of the training sample
BUCKETS, DIM = 1 << 15, 16
WIDTHS = (2, 3, 4)
BLOCK = 1 << 20  # bytes whose subwords are hashed at a time
UNKNOWN = "und"
_NOT_LETTERS = regex.compile(r"[^\p{L}\p{M}]+")


def letters(text: str | None) -> bytes:
    """The words of a text, each between blanks; empty without a letter."""
    kept = _NOT_LETTERS.sub(" ", (text or "").lower()).strip()
    return f" {kept} ".encode() if any(c.isalpha() for c in kept) else b""


def subwords(data: bytes) -> Iterator[np.ndarray]:
    """Bucket numbers of all 2- to 4-byte pieces, in blocks."""
    for start in range(0, len(data), BLOCK):
        codes = np.frombuffer(data, np.uint8, min(BLOCK + 3, len(data) - start), start).astype(np.uint32)
        rolled = codes
        for width in range(2, max(WIDTHS) + 1):
            if len(codes) < width:
                break
            rolled = rolled[:-1] | (codes[width - 1 :] << np.uint32(8 * (width - 1)))
            if width in WIDTHS:
                mixed = (rolled ^ np.uint32(width * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
                yield (mixed >> np.uint32(17))[:BLOCK]


@dataclass
class Model:
    labels: list[str]
    table: np.ndarray  # bucket x label: embedding times softmax weights
    bias: np.ndarray
    temperature: float
    least: float

    def scores(self, data: bytes) -> np.ndarray:
        total, n = np.zeros(len(self.labels)), 0
        for ids in subwords(data):
            total += np.bincount(ids, minlength=BUCKETS) @ self.table if len(ids) > BUCKETS else self.table[ids].sum(axis=0, dtype=np.float64)
            n += len(ids)
        return _softmax((total / max(n, 1) + self.bias) / self.temperature)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Label, calibrated score, and whether the score is high enough to be trusted."""
        data = letters(text)
        if not data or not self.labels:
            return UNKNOWN, 0.0, False
        scores = self.scores(data)
        best = int(np.argmax(scores))
        return self.labels[best], float(scores[best]), bool(scores[best] >= self.least)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(rows: list[tuple[str, str]], epochs: int = 3, rate: float = 0.5, seed: int = 7) -> Model:
    """Fit on (text, label) rows; a fifth of them, by checksum of the text, fits the calibration only."""
    rng = np.random.default_rng(seed)
    labels = sorted({label for _, label in rows})
    if not labels:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0), 1.0, 1.0)
    number = {label: i for i, label in enumerate(labels)}
    kept = [(data, number[label], zlib.crc32(data) % 5 == 0) for text, label in sorted(rows) if (data := letters(text))]
    fit = [(d, y) for d, y, held in kept if not held] or [(d, y) for d, y, _ in kept]
    held = [(d, y) for d, y, h in kept if h] or fit
    embed = rng.uniform(-0.1, 0.1, (BUCKETS, DIM)).astype(np.float32)
    weights, bias = rng.normal(0, 0.5, (DIM, len(labels))).astype(np.float32), np.zeros(len(labels), np.float32)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        order = rng.permutation(len(fit))
        for start in range(0, len(order), 32):
            bags, ys = [], []
            for at in order[start : start + 32]:
                data, y = fit[at]
                size = int(rng.integers(20, 320))  # snippets of many lengths, so that short texts are met
                begin = int(rng.integers(0, max(1, len(data) - size)))
                ids = list(subwords(data[begin : begin + size]))
                if ids:
                    bags.append(np.concatenate(ids))
                    ys.append(y)
            if not bags:
                continue
            means = np.stack([embed[ids].mean(axis=0) for ids in bags])
            error = _softmax(means @ weights + bias)
            error[np.arange(len(ys)), ys] -= 1
            back = error @ weights.T
            weights -= step * means.T @ error / len(ys) * 10
            bias -= step * error.mean(axis=0)
            sizes = np.array([len(ids) for ids in bags])
            np.add.at(embed, np.concatenate(bags), np.repeat(-step * 10 * back / sizes[:, None], sizes, axis=0))
    model = Model(labels, embed @ weights, bias.astype(np.float64), 1.0, 0.0)
    return _calibrate(model, held, rng)


def _calibrate(model: Model, held: list[tuple[bytes, int]], rng: np.random.Generator, trust: float = 0.95) -> Model:
    """The temperature of least loss, and the least score at which `trust` of the rows above it are right."""
    logits, ys = [], []
    for data, y in held:
        size = int(rng.integers(8, 1500))
        cut = data[:size] if rng.random() < 0.5 else data
        logits.append(np.log(model.scores(cut) + 1e-30))
        ys.append(y)
    logits, ys = np.array(logits), np.array(ys)
    rows = np.arange(len(ys))
    losses = {t: -np.log(_softmax(logits / t)[rows, ys] + 1e-30).mean() for t in np.geomspace(0.02, 20, 60)}
    model.temperature = float(min(losses, key=losses.get))
    scores = _softmax(logits / model.temperature)
    best, right = scores.max(axis=1), scores.argmax(axis=1) == ys
    for least in (0.0, *np.linspace(0.3, 0.95, 14)):
        taken = best >= least
        if taken.any() and right[taken].mean() >= trust:
            break
    model.least = max(float(least), 1.5 / len(model.labels) if len(model.labels) > 1 else 0.0)
    return model


def fold(id_col: str) -> Column:
    """crc32 of the id as text, modulo 5; 0 is held out."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5


def sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> list[tuple[str, str]]:
    """At most `SAMPLE` rows that are not held out, the same at every run: the first by checksum per label.

    Labels are counted first, so that only the share of a label's rows with small checksums, about
    twice what is wanted, meets in one task. Where rows repeat so that it falls short, all rows are ranked.
    """
    labelled = docs.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull() & (fold(id_col) != 0))
    rows = labelled.select(
        F.substring(text_col, 1, SAMPLE["chars"]).alias("text"),
        F.col(label_col).cast("string").alias("label"),
        F.xxhash64(F.col(id_col).cast("string"), F.substring(text_col, 1, 200)).alias("h"),
    )
    counted = rows.groupBy("label").agg(F.count("*").alias("n")).orderBy("label").limit(SAMPLE["rows"]).collect()
    most = SAMPLE["rows_per_label"]
    shares = {r["label"]: min(1.0, (2 * most + 200) / r["n"]) for r in counted}
    bounds = json.dumps({label: int(share * (2**64 - 1)) - 2**63 for label, share in shares.items()})
    near = rows.where(F.col("h") <= F.from_json(F.lit(bounds), "map<string,bigint>")[F.col("label")])
    order = Window.partitionBy("label").orderBy("h", "text")

    def first(rows: DataFrame) -> list[Row]:
        ranked = rows.withColumn("at", F.row_number().over(order)).where(F.col("at") <= most)
        return ranked.orderBy("at", "label").limit(SAMPLE["rows"]).collect()

    found = first(near)
    if len(found) < min(SAMPLE["rows"], sum(min(r["n"], most) for r in counted)):
        found = first(rows)
    return [(r["text"], r["label"]) for r in found]


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """`docs` with `lang_pred`, `score` (0 to 1) and `accepted`.

    A null text, or one without a letter, is `und` with score 0 and not accepted. Nothing but the
    text is read. Input columns named like the new ones are replaced.
    """
    docs = without(docs, ["lang_pred", "score", "accepted"])
    added = pa.schema([("lang_pred", pa.string()), ("score", pa.float64()), ("accepted", pa.bool_())])
    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("accepted", T.BooleanType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x labels floats

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                made = [shared.value.predict(x.as_py()) for x in batch.column(text_col)]
                columns = [pa.array([m[i] for m in made], f.type) for i, f in enumerate(added)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *added.names])

    return docs.mapInArrow(tidy(run), schema)
