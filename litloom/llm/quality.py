"""Quality classifier: random Fourier features of document statistics, ridge, isotonic calibration.

Statistics of a whole text (composition, word and line shape, repetition) are standardised and mapped
by random cosines whose inner products approximate a Gaussian kernel; the statistics themselves stand beside the
cosines, so a part of the fit is linear. Tasks sum normal equations, fold by fold; ridge scores of each fold, from the
other folds' equations, are calibrated by pooled adjacent violators on a fixed grid of scores. A score is 0.99 times the
calibrated one plus 0.01 times the raw one: calibration is flat within a block, and the hundredth keeps the raw order there
without changing the order between blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litloom.llm import kernels
from litloom.llm.langid import held_out
from litloom.llm.storage import settle, small_batches

COSINES = 160
BANDWIDTH = 1.0
RIDGE = 1.0
FOLDS = 4
GRID = 400
SEED = 11
THRESHOLD = 0.3
CLIP = 6.0

CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "space": b" \t\r\x0b\x0c",
    "line": b"\n",
    "stop": b".,;:?",
    "bang": b"!",
    "pipe": b"|",
    "quote": b"\"'()[]{}",
    "symbol": b"#$%&*+-/<=>@\\^_`~",
}
STATISTICS = [
    "bytes", "words", *CLASSES, "foreign", "shout", "word_length", "word_spread", "long_words", "ended_words", "distinct_words",
    "distinct_runs", "lines", "line_length", "distinct_lines", "repeated_lines",
]


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values, dtype=np.float64)))
    return total[offsets[1:]] - total[offsets[:-1]]


_LABEL = np.full(256, 255, np.uint8)
for _i, _bytes in enumerate(CLASSES.values()):
    _LABEL[list(_bytes)] = _i
_LABEL[128:] = len(CLASSES)


def _kinds(hashes: np.ndarray, before: np.ndarray) -> np.ndarray:
    """For each text the number of distinct hashes."""
    owner = np.repeat(np.arange(len(before) - 1, dtype=np.uint64), np.diff(before))
    mixed = kernels.mix(hashes ^ kernels.mix(owner + np.uint64(1)))
    order = np.lexsort((mixed, owner))
    mixed, owner = mixed[order], owner[order]
    new = np.ones(len(mixed), bool)
    new[1:] = (mixed[1:] != mixed[:-1]) | (owner[1:] != owner[:-1])
    return np.bincount(owner[new].astype(np.int64), minlength=len(before) - 1).astype(float)


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of STATISTICS for each text. Long texts are summed over as a whole, in arrays of their bytes."""
    n = len(offsets) - 1
    size = np.maximum(np.diff(offsets), 1).astype(float)
    out = {"bytes": np.log1p(np.diff(offsets))}
    label = _LABEL[data]
    for i, name in enumerate([*CLASSES, "foreign"]):
        out[name] = _sums(label == i, offsets) / size
    out["shout"] = out["upper"] / np.maximum(out["upper"] + out["lower"], 1e-9)
    starts, ends, before = kernels.word_spans(data, offsets)
    words = np.maximum(np.diff(before), 1).astype(float)
    lengths = (ends - starts).astype(float)
    out["words"] = np.log1p(np.diff(before))
    out["word_length"] = _sums(lengths, before) / words
    out["word_spread"] = np.sqrt(np.maximum(_sums(lengths**2, before) / words - out["word_length"] ** 2, 0))
    out["long_words"] = _sums(lengths > 15, before) / words
    last = label[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    out["ended_words"] = _sums((last >= 5) & (last <= 9), before) / words
    hashes = kernels.hash_spans(data, starts, ends)
    out["distinct_words"] = _kinds(hashes, before) / words
    runs, ahead = kernels.shingles(hashes, before, 3)
    out["distinct_runs"] = _kinds(runs, ahead) / np.maximum(np.diff(ahead), 1)
    # A line is hashed as the sum of its words' hashes times their place in it.
    newlines = np.concatenate((np.flatnonzero(data == 10), offsets[:-1]))
    marks = np.unique(newlines)
    line_of = np.searchsorted(marks, starts, "right") - 1
    first = np.concatenate(([True], line_of[1:] != line_of[:-1])) if len(starts) else np.zeros(0, bool)
    at = np.flatnonzero(first)
    if len(at):
        place = np.arange(len(starts)) - np.repeat(at, np.diff(np.append(at, len(starts))))
        line_hash = np.add.reduceat(hashes * (place.astype(np.uint64) * np.uint64(2) + np.uint64(1)), at)
        line_before = np.searchsorted(at, before)
    else:
        line_hash, line_before = np.zeros(0, np.uint64), np.zeros(n + 1, np.int64)
    lines = np.maximum(np.diff(line_before), 1).astype(float)
    out["lines"] = np.log1p(np.diff(line_before))
    out["line_length"] = np.log1p(words / lines)
    kinds = _kinds(line_hash, line_before)
    out["distinct_lines"] = kinds / lines
    out["repeated_lines"] = np.log1p(np.maximum(np.diff(line_before) - kinds, 0))
    return np.stack([out[s] for s in STATISTICS], axis=1)


def document_statistics(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns doc_id, x (array of STATISTICS): one row per input row; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = kernels.flat(batch.column("text"))
            ids = batch.column("doc_id")
            for a, b, block, inner in kernels.blocks(data, offsets):
                x = pa.array(statistics(block, inner).ravel())
                ends = pa.array(np.arange(b - a + 1, dtype=np.int32) * len(STATISTICS))
                yield pa.RecordBatch.from_arrays([ids.slice(a, b - a), pa.ListArray.from_arrays(ends, x)], names=["doc_id", "x"])

    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, x array<double>")


class QualityModel:
    """Standardisation, cosines, ridge weights and the calibration curve."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, seed: int = SEED):
        rng = np.random.default_rng(seed)
        d = len(mean)
        self.mean, self.spread = mean, spread
        self.directions = rng.normal(size=(d, COSINES)) * BANDWIDTH / np.sqrt(d)
        self.phases = rng.uniform(0, 2 * np.pi, COSINES)
        self.weights = np.zeros(COSINES + d + 1)
        self.curve: tuple[np.ndarray, np.ndarray] = (np.array([0.0, 1.0]), np.array([0.5, 0.5]))

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -CLIP, CLIP)
        return np.concatenate((np.sqrt(2 / COSINES) * np.cos(z @ self.directions + self.phases), z / np.sqrt(z.shape[1]), np.ones((len(z), 1))), axis=1)

    def scores(self, x: np.ndarray) -> np.ndarray:
        raw = self.features(x) @ self.weights
        return np.clip(0.99 * np.interp(raw, *self.curve) + 0.01 * np.clip(raw, 0, 1), 0, 1)


def ridge(sums: np.ndarray, penalty: float = RIDGE) -> np.ndarray:
    """Weights from normal equations: the last row holds the right-hand side."""
    gram = sums[:-1] + penalty * np.eye(sums.shape[1])
    return np.linalg.solve(gram, sums[-1])


def isotonic(counts: np.ndarray, totals: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pooled adjacent violators over cells: mean score and mean label of each block."""
    stack: list[list[float]] = []
    for n, y, c in zip(counts, totals, centres, strict=True):
        if n == 0:
            continue
        stack.append([n, y, n * c])
        while len(stack) > 1 and stack[-2][1] * stack[-1][0] >= stack[-1][1] * stack[-2][0]:
            top = stack.pop()
            stack[-1] = [a + b for a, b in zip(stack[-1], top, strict=True)]
    if not stack:
        return np.array([0.0, 1.0]), np.array([0.5, 0.5])
    return np.array([s[2] / s[0] for s in stack]), np.array([s[1] / s[0] for s in stack])


def _summed(rows: DataFrame, columns: list[str], shape: tuple[int, ...], of) -> np.ndarray:
    """The sum over all tasks of of(columns of a batch), in two rounds, so that few arrays reach the driver."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            if batch.num_rows:
                total += of(*[batch.column(c) for c in columns])
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sum"])

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            for value in batch.column("sum"):
                total += np.frombuffer(value.as_py()).reshape(shape)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sum"])

    parts = rows.mapInArrow(partial, "sum binary").repartition(8).mapInArrow(again, "sum binary").collect()
    return sum((np.frombuffer(p["sum"]).reshape(shape) for p in parts), np.zeros(shape))


def _matrix(column) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1)


def train(statistics_: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> QualityModel:
    """A model from the labelled rows that are not held out; all of them, as sums.

    `statistics_` has doc_id and x. Null labels and ids teach nothing; an id with several labels counts as
    their mean. Without any labelled row every score is near a half.
    """
    marks = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("double").alias("y")).where(F.col("y").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    marks = marks.groupBy("doc_id").agg(F.avg("y").alias("y"))
    rows = settle(statistics_.join(marks, "doc_id").select("x", "y", F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(FOLDS)).cast("int").alias("fold")))
    d = len(STATISTICS)

    def moments(x) -> np.ndarray:
        x = _matrix(x)
        return np.stack((x.sum(0), (x**2).sum(0), np.full(d, float(len(x)))))

    first, second, n = _summed(rows, ["x"], (3, d), moments)
    if not n[0]:
        return QualityModel(np.zeros(d), np.ones(d))
    mean = first / n
    model = QualityModel(mean, np.sqrt(np.maximum(second / n - mean**2, 0)) + 1e-6)
    width = len(model.weights)

    def equations(x, y, fold) -> np.ndarray:
        z, y, fold = model.features(_matrix(x)), np.asarray(y), np.asarray(fold)
        out = np.zeros((FOLDS, width + 1, width))
        for f in range(FOLDS):
            own = fold == f
            out[f, :-1] = z[own].T @ z[own]
            out[f, -1] = y[own] @ z[own]
        return out

    sums = _summed(rows, ["x", "y", "fold"], (FOLDS, width + 1, width), equations)
    whole = sums.sum(0)
    model.weights = ridge(whole)
    others = np.stack([ridge(whole - part) for part in sums])
    edges = np.linspace(-0.5, 1.5, GRID + 1)

    def cells(x, y, fold) -> np.ndarray:
        raw = (model.features(_matrix(x)) * others[np.asarray(fold)]).sum(1)
        cell = np.clip(np.searchsorted(edges, raw, "right") - 1, 0, GRID - 1)
        return np.stack((np.bincount(cell, minlength=GRID), np.bincount(cell, np.asarray(y), GRID)))

    counts, totals = _summed(rows, ["x", "y", "fold"], (2, GRID), cells)
    model.curve = isotonic(counts, totals, (edges[1:] + edges[:-1]) / 2)
    return model


def score(statistics_: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """Columns doc_id, held_out, score, predicted: one row per row of statistics."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.scores(_matrix(batch.column("x"))))], names=["doc_id", "score"])

    scored = statistics_.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def classify(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """Quality scores of every whole text, learned from `labels`; the statistics are checkpointed, the texts read once."""
    small_batches(df.sparkSession)
    found = settle(document_statistics(df, id_col, text_col))
    return score(found, train(found, labels, id_col, label_col))
