"""Quality scores: ridge regression on random Fourier features of document statistics, calibrated.

Each document becomes a short vector of statistics of its whole text (sizes, kinds of characters,
repetition of words and lines). Standardised, the vector goes through cosines of random projections,
whose inner products approximate a Gaussian kernel. Every task adds up its part of the normal
equations, by fold; the parts are added by row of the matrix, and the driver solves a system whose
size is the number of cosines. What the folds that lack a row say about it is the score that an
isotonic regression (pool adjacent violators over a fixed grid of scores) turns into a probability.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymill.llm.common import stored, without

COSINES = 384
RIDGE = 1e-4  # of the number of rows
FOLDS = 5
GRID = 2048  # scores that the calibration tells apart
TEXT_BLOCK = 1 << 20  # bytes of a text that are looked at at a time
FAR = 6.0  # standard deviations beyond which a statistic counts as this far

_CLASSES = np.full(256, 5)  # of bytes: lower, upper, digit, blank, punctuation, other symbol, beyond ASCII
for _byte in range(256):
    _char = chr(_byte)
    _CLASSES[_byte] = 6 if _byte >= 0x80 else 0 if _char.islower() else 1 if _char.isupper() else 2 if _char.isdigit() else 3 if _char.isspace() else 4 if _char in ".,;:!?'\"-()" else 5
_ENDS = b".,;:!?'\"-()"

STATISTICS = [
    "log_bytes", "log_words", "log_lines", "word_length", "word_length_spread", "distinct_words", "top_word", "same_word_again", "distinct_pairs", "distinct_lines",
    "lower", "upper", "digit", "blank", "punctuation", "symbol", "beyond_ascii", "entropy", "words_without_letter", "words_ending_in_symbol", "words_per_line", "top_symbol", "longest_word", "sentence_ends",
]


def _words(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in lists of bounded size."""
    start = 0
    while start < len(data):
        end = len(data)
        if end - start > TEXT_BLOCK:
            end = data.rfind(b" ", start + 1, start + TEXT_BLOCK)
            end = end if end > 0 else data.find(b" ", start + TEXT_BLOCK)
            end = end if end > 0 else len(data)
        yield data[start:end].split()
        start = end


def statistics_of(text: bytes | None) -> list[float]:
    """One number for each of `STATISTICS`; a null text counts as empty."""
    data = text or b""
    n_bytes = len(data)
    bytes_seen = np.zeros(256, np.int64)
    for start in range(0, n_bytes, TEXT_BLOCK):
        bytes_seen += np.bincount(np.frombuffer(data, np.uint8, min(TEXT_BLOCK, n_bytes - start), start), minlength=256)
    classes = np.bincount(_CLASSES, weights=bytes_seen, minlength=7) / max(n_bytes, 1)
    share = bytes_seen[bytes_seen > 0] / max(n_bytes, 1)
    entropy = float(-(share * np.log2(share)).sum())
    words: Counter[bytes] = Counter()
    pairs: set[int] = set()
    n = again = total = squares = bare = symbol = longest = ends = 0
    last = None
    for some in _words(data):
        words.update(some)
        n += len(some)
        follow = list(zip([last, *some], some)) if last is not None else list(zip(some, some[1:]))
        pairs.update(map(hash, follow))
        again += sum(a == b for a, b in follow)
        last = some[-1] if some else last
    for word, count in words.items():
        size = len(word)
        total += size * count
        squares += size * size * count
        longest = max(longest, size)
        final = word[-1]
        if final < 0x80 and not (0x61 <= final <= 0x7A or 0x41 <= final <= 0x5A or 0x30 <= final <= 0x39):
            if final in _ENDS:
                ends += count * (final in b".!?")
            else:
                symbol += count
        if size < 4 and not any(b >= 0x80 or 0x61 <= b <= 0x7A or 0x41 <= b <= 0x5A for b in word):
            bare += count
    lines = [x for x in data.split(b"\n") if x.strip()]
    most, mean = max(n, 1), total / max(n, 1)
    symbols = bytes_seen[_CLASSES == 5]
    return [
        math.log1p(n_bytes), math.log1p(n), math.log1p(len(lines)), mean, math.sqrt(max(squares / most - mean * mean, 0.0)),
        len(words) / most, max(words.values(), default=0) / most, again / most, len(pairs) / most, len(set(lines)) / max(len(lines), 1),
        *classes.tolist(), entropy, bare / most, symbol / most, math.log1p(n / max(len(lines), 1)), float(symbols.max()) / max(n_bytes, 1), math.log1p(longest), ends / most,
    ]


def statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """`docs` without its text, with `statistics`, an array of doubles."""
    docs = without(docs, ["statistics"])
    rest = [c for c in docs.columns if c != text_col]
    schema = T.StructType([*docs.select(*[F.col(f"`{c}`") for c in rest]).schema.fields, T.StructField("statistics", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array([statistics_of(x.as_py()) for x in batch.column(text_col)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest], made], names=[*rest, "statistics"])

    return docs.withColumn(text_col, F.col(f"`{text_col}`").cast("binary")).mapInArrow(run, schema)


@dataclass
class Model:
    mean: np.ndarray
    spread: np.ndarray
    projection: np.ndarray  # statistics x cosines
    phase: np.ndarray
    weights: np.ndarray  # cosines + 1
    fold_weights: np.ndarray  # fold x (cosines + 1): fitted without the fold
    knots: np.ndarray  # raw scores, ascending
    levels: np.ndarray  # the probability at each knot, never falling

    def cosines(self, x: np.ndarray) -> np.ndarray:
        """Random Fourier features of rows of statistics, and a constant."""
        x = np.clip((x - self.mean) / self.spread, -FAR, FAR)
        z = math.sqrt(2 / len(self.phase)) * np.cos(x @ self.projection + self.phase)
        return np.column_stack([z, np.ones(len(z))])

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Between 0 and 1; of the places where the calibration is level, a thousandth keeps the order."""
        raw = np.round(self.cosines(x) @ self.weights, 9)  # the last digits depend on the rows beside
        order = 1 / (1 + np.exp(-4 * np.clip(raw - 0.5, -20, 20)))
        return 0.999 * np.interp(raw, self.knots, self.levels) + 0.001 * order


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("statistics").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(STATISTICS))


def _normal_equations(rows: DataFrame, model: Model) -> np.ndarray:
    """fold x (cosines + 1) x (cosines + 2): sums of z z' and z y, added within each task, then by row."""
    size = COSINES + 1

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((FOLDS, size, size + 1))
        for batch in batches:
            z, y, fold = model.cosines(_matrix(batch)), batch.column("label").to_numpy(zero_copy_only=False), batch.column("fold").to_numpy(zero_copy_only=False)
            for f in np.unique(fold):
                ours = fold == f
                sums[f] += z[ours].T @ np.column_stack([z[ours], y[ours]])
        yield from _as_rows({(f, i): sums[f, i] for f in range(FOLDS) for i in range(size) if sums[f].any()})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for f, i, values in zip(*[batch.column(c).to_pylist() for c in ("fold", "row", "sums")]):
                sums[f, i] = sums.get((f, i), 0) + np.frombuffer(values)
        yield from _as_rows(sums)

    schema = "fold int, row int, sums binary"
    found = rows.select("statistics", "label", "fold").mapInArrow(part, schema).repartition("fold", "row").mapInArrow(add, schema).collect()  # FOLDS x size rows
    out = np.zeros((FOLDS, size, size + 1))
    for f, i, values in found:
        out[f, i] += np.frombuffer(values)
    return out


def _as_rows(sums: dict[tuple[int, int], np.ndarray]) -> Iterator[pa.RecordBatch]:
    if sums:
        keys = list(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()), pa.array([sums[k].tobytes() for k in keys], pa.binary())], names=["fold", "row", "sums"]
        )


def _solve(sums: np.ndarray) -> np.ndarray:
    """Ridge weights; the constant carries no penalty."""
    matrix, right = sums[:, :-1].copy(), sums[:, -1]
    penalty = np.full(len(matrix), RIDGE * max(sums[-1, -2], 1.0))
    penalty[-1] = 1e-9
    matrix[np.diag_indices(len(matrix))] += penalty
    return np.linalg.solve(matrix, right)


def isotonic(x: np.ndarray, n: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: ascending places `x` with `n` rows and a sum of labels each."""
    blocks: list[list[float]] = []  # place times rows, rows, labels
    for a, b, c in zip(x, n, total):
        blocks.append([a * b, b, c])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last)]
    return np.array([b[0] / b[1] for b in blocks]), np.array([b[2] / b[1] for b in blocks])


def train(rows: DataFrame, id_col: str = "doc_id", seed: int = 11) -> Model:
    """Fit on rows of an id, `statistics` and `label` (0 or 1); rows with a null label do not count.

    The rows of a fold share the hash of their id. Without rows every score is a half; with labels
    of one kind only, every score is that label.
    """
    rows = rows.where(F.col("label").isNotNull()).select(
        "statistics", F.col("label").cast("double").alias("label"), F.pmod(F.xxhash64(id_col), F.lit(FOLDS)).cast("int").alias("fold")
    )
    d = len(STATISTICS)
    moments = rows.agg(F.count("*"), F.avg("label"), *[f(F.col("statistics")[i]) for i in range(d) for f in (F.avg, F.stddev_pop)]).first()
    n, share = moments[0], moments[1]
    rng = np.random.default_rng(seed)
    mean, spread = np.array([x or 0.0 for x in moments[2::2]]), np.array([x or 0.0 for x in moments[3::2]])
    spread = np.where(spread > 1e-9, spread, 1.0)
    projection = rng.normal(0, 1 / math.sqrt(d), (d, COSINES))  # the kernel's width: the root of the dimension
    phase = rng.uniform(0, 2 * math.pi, COSINES)
    flat = np.zeros(COSINES + 1)
    model = Model(mean, spread, projection, phase, flat, np.tile(flat, (FOLDS, 1)), np.array([0.0]), np.array([0.5 if share is None else share]))
    if not n or share in (0.0, 1.0):
        return model
    parts = _normal_equations(rows, model)
    whole = parts.sum(axis=0)
    model.weights = _solve(whole)
    model.fold_weights = np.stack([_solve(whole - p) if whole[-1, -2] > p[-1, -2] else model.weights for p in parts])

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fold = batch.column("fold").to_numpy(zero_copy_only=False)
            found = np.einsum("ij,ij->i", model.cosines(_matrix(batch)), model.fold_weights[fold])
            yield pa.RecordBatch.from_arrays([pa.array(np.clip((found + 1) / 3 * GRID, 0, GRID).astype(np.int32)), batch.column("label")], names=["cell", "label"])

    cells = rows.mapInArrow(raw, "cell int, label double").groupBy("cell").agg(F.count("*").alias("n"), F.sum("label").alias("total"))
    found = cells.orderBy("cell").toPandas()  # GRID + 1 rows at most
    model.knots, model.levels = isotonic(found["cell"].to_numpy(np.float64) / GRID * 3 - 1 + 1.5 / GRID, found["n"].to_numpy(np.float64), found["total"].to_numpy(np.float64))
    return model


def score(rows: DataFrame, model: Model) -> DataFrame:
    """Rows of `statistics` with `score` in its place."""
    rows = without(rows, ["score"])
    rest = [c for c in rows.columns if c != "statistics"]
    schema = T.StructType([*rows.select(*[F.col(f"`{c}`") for c in rest]).schema.fields, T.StructField("score", T.DoubleType())])
    shared = rows.sparkSession.sparkContext.broadcast(model)  # about COSINES x (statistics + folds) doubles

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest], pa.array(shared.value.scores(_matrix(batch)), pa.float64())], names=[*rest, "score"])

    return rows.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """`docs` without its text, with `score`: 0 to 1, the higher, the likelier the label is 1.

    `learn` says of a document, by columns of `docs`, whether its labels may be learnt from. Nothing
    but the text enters a score. A null text counts as empty, and an empty text is scored like any
    other. Rows without a label are scored, rows that repeat are scored alike; each row of `labels`
    with a 0 or 1 counts once for each document of its id, labels of no document and null ids or
    labels count nowhere. An empty table gives an empty one. Columns named `statistics` or `score`
    are replaced.
    """
    found = stored(statistics(without(docs, ["score"]), text_col), "quality-statistics")
    marked = labels.select(F.col(id_col).alias("__id"), F.col(label_col).alias("label")).where("label in (0, 1)")
    taught = found.where(learn).select(id_col, "statistics")
    model = train(taught.join(marked, taught[id_col] == marked["__id"]).select(id_col, "statistics", "label"), id_col)
    return score(found, model)
