"""Quality classifier: ridge regression on random Fourier features of document statistics."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import map_slices, narrow, row_key, utf8, written

#: Number of random features, and the weight of the ridge per training row.
FEATURES, RIDGE = 128, 1e-4
#: Scores of the ridge are counted in bins of this width before the isotonic fit.
BIN = 0.002

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGITS = b"0123456789"
_SPACE = b" \t\n\x0b\x0c\r"
_STOPS = b".,;:!?"
_MARKS = bytes(c for c in range(33, 127) if c not in _UPPER + _LOWER + _DIGITS + _STOPS)
STATISTICS = (
    "log_words", "log_bytes", "word_bytes", "word_spread", "distinct", "runs", "lines", "line_copies",
    "upper", "digits", "stops", "marks", "exclaims", "high", "longest", "words_a_line",
)


def statistics(text: bytes) -> list[float]:
    """Form and repetition of a text; all 0 for an empty one. No language, source or id."""
    words = text.split()
    if not words:
        return [0.0] * len(STATISTICS)
    n, size = len(words), len(text)
    lengths = np.fromiter(map(len, words), np.int64, n)
    lines = [line for line in text.split(b"\n") if line.strip()]
    share = lambda chars: (size - len(text.translate(None, chars))) / size
    return [
        math.log1p(n),
        math.log1p(size),
        float(lengths.mean()),
        float(lengths.std()),
        len(set(words)) / n,
        len(set(zip(words, words[1:], words[2:], strict=False))) / max(1, n - 2),
        math.log1p(len(lines)),
        len(set(lines)) / len(lines),
        share(_UPPER),
        share(_DIGITS),
        share(_STOPS),
        share(_MARKS),
        text.count(b"!") / n,
        1 - len(text.translate(None, bytes(range(128, 256)))) / size,
        math.log1p(int(lengths.max())),
        math.log(n / len(lines)),
    ]


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id, row_key, x`` (the statistics) of every row; a null text is empty."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = [statistics(t or b"") for t in utf8(batch["text"])]
        return pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["row_key"], pa.array(values, pa.list_(pa.float64()))],
            names=["doc_id", "row_key", "x"],
        )

    rows = docs.select("doc_id", row_key().alias("row_key"), "text")
    return map_slices(rows, work, "doc_id long, row_key long, x array<double>")


class Fourier:
    """cos(w x + b) of standardised statistics: inner products approximate a Gaussian kernel."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, features: int, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        self.mean, self.spread = mean, np.where(spread > 1e-9, spread, 1.0)
        self.waves = rng.normal(0, len(mean) ** -0.5, (len(mean), features))
        self.phase = rng.uniform(0, 2 * np.pi, features)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -8, 8)
        waves = np.cos(z @ self.waves + self.phase) * (2 / len(self.phase)) ** 0.5
        return np.column_stack([waves, np.ones(len(x))])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _normal_equations(train: DataFrame, fourier: Fourier) -> tuple[np.ndarray, np.ndarray]:
    """Sums of f f' and f y: each task adds its own rows up, the sums of tasks are aggregated."""
    width = len(fourier.phase) + 1

    def sums(batches):
        total = np.zeros((width, width + 1))
        for batch in batches:
            f = fourier(_matrix(batch["x"], len(STATISTICS)))
            y = batch["y"].to_numpy(zero_copy_only=False)
            total += f.T @ np.column_stack([f, y])
        if total.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(width), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))],
                names=["i", "row"],
            )

    parts = train.select("x", "y").mapInArrow(sums, "i int, row array<double>")
    cells = parts.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
    total = np.zeros((width, width + 1))
    for i, j, v in cells.collect():  # as many numbers as the model has, whatever the input
        total[i, j] = v
    return total[:, :width], total[:, width]


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Non-decreasing values with the least weighted squared error to y, for ascending x."""
    blocks: list[list[float]] = []
    for value, weight in zip(y.tolist(), w.tolist(), strict=True):
        blocks.append([value, weight, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            b, a = blocks.pop(), blocks.pop()
            total = a[1] + b[1]
            blocks.append([(a[0] * a[1] + b[0] * b[1]) / total, total, a[2] + b[2]])
    return np.repeat([b[0] for b in blocks], [int(b[2]) for b in blocks])


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    features: int = FEATURES,
) -> DataFrame:
    """``doc_id, row_key, held_out, score, predicted`` for every row.

    Rows whose crc32 of the id as text leaves 1 modulo 3 are held out: their labels are never
    read. Of the others that have a label, four fifths fit the ridge and one fifth calibrates it.
    Null labels are ignored; an id with several labels counts with their mean; a row without id
    has no label and is not held out. Without any label all scores are 0.5. A null or empty text
    is scored by statistics of 0. Repeated rows get equal results; other columns are ignored.
    """
    rows = written(measured(narrow(docs, id_col, text_col)), "statistics")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    held = F.coalesce(fold == 1, F.lit(False))
    known = labels.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("double").alias("y")
    ).filter("doc_id IS NOT NULL AND y IS NOT NULL")
    known = known.groupBy("doc_id").agg(F.avg("y").alias("y"))
    train = written(
        rows.filter(~held & F.col("doc_id").isNotNull())
        .join(known, "doc_id")
        .select("x", "y", (F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0).alias("apart")),
        "train",
    )
    width = range(len(STATISTICS))
    moments = train.agg(
        F.count("*").alias("n"),
        *(F.avg(F.col("x")[i]).alias(f"m{i}") for i in width),
        *(F.stddev_pop(F.col("x")[i]).alias(f"s{i}") for i in width),
    ).first()
    base = rows.select("doc_id", "row_key", held.alias("held_out"), "x")
    if not moments["n"]:
        return base.select("doc_id", "row_key", "held_out", F.lit(0.5).alias("score"), F.lit(1).alias("predicted"))
    fourier = Fourier(
        np.array([moments[f"m{i}"] for i in width]), np.array([moments[f"s{i}"] for i in width]), features
    )
    gram, moment = _normal_equations(train.filter(~F.col("apart")), fourier)
    ridge = RIDGE * max(1.0, gram[-1, -1]) * np.eye(len(gram))
    ridge[-1, -1] = 1e-9
    weights = np.linalg.solve(gram + ridge, moment)

    def raw(batch: pa.RecordBatch) -> np.ndarray:
        return fourier(_matrix(batch["x"], len(STATISTICS))) @ weights

    def bins(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = np.clip(np.round(raw(batch) / BIN), -1 / BIN, 2 / BIN).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(at), batch["y"]], names=["at", "y"])

    apart = train.filter("apart") if not train.filter("apart").isEmpty() else train
    binned = map_slices(apart.select("x", "y"), bins, "at long, y double")
    curve = sorted(map(tuple, binned.groupBy("at").agg(F.avg("y"), F.count("*")).collect()))
    at, y, n = (np.array(c, np.float64) for c in zip(*curve, strict=True))
    level = isotonic(at, y, n)

    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = np.clip(np.interp(raw(batch) / BIN, at, level), 0.0, 1.0)
        return pa.RecordBatch.from_arrays(
            [
                *(batch[c] for c in ("doc_id", "row_key", "held_out")),
                pa.array(scores),
                pa.array((scores >= 0.5).astype(np.int32)),
            ],
            names=["doc_id", "row_key", "held_out", "score", "predicted"],
        )

    return map_slices(
        base, score, "doc_id long, row_key long, held_out boolean, score double, predicted int"
    )
