"""Quality scores by random Fourier features and ridge regression, with isotonic calibration.

Each text is reduced to a few statistics. Cosines of random projections of the standardised statistics approximate a
Gaussian kernel, so a linear model of them is a kernel model. Its normal equations are sums over rows: every task sums
its own rows and Spark adds up the sums, so any number of labelled rows can be fitted. A share of the training rows
calibrates the raw scores: their range is cut into bins, and the bins' label shares are made monotone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .base import process_state, settle
from .toxicity import remainder

FEATURES = 256
SEED = 20_240_501
#: Kernel width, in standard deviations of the statistics, for each root of their number.
WIDTH = 1.0
RIDGE = 1e-3
BINS = 512
#: Training rows that one task sums, and one in so many that calibrates instead.
ROWS = 50_000
CALIBRATION = 4
THRESHOLD = 0.3

STATISTICS = (
    "characters words mean_word spread_word unique_words repeated_next unique_lines line_words letters upper digits "
    "stops marks symbols blanks other short_words long_words"
).split()


def _classes() -> np.ndarray:
    """0 other, 1 blank, 2 lower-case or caseless letter, 3 upper-case letter, 4 digit, 5 . ! ?, 6 other punctuation
    inside prose, 7 symbols."""
    out = np.zeros(1 << 16, np.uint8)
    for cp in range(1 << 16):
        c = chr(cp)
        if c.isspace():
            out[cp] = 1
        elif c.isupper():
            out[cp] = 3
        elif c.isalpha():
            out[cp] = 2
        elif c.isdigit():
            out[cp] = 4
        elif c in ".!?":
            out[cp] = 5
        elif c in ",;:'\"()-":
            out[cp] = 6
        elif c.isprintable():
            out[cp] = 7
    return out


def statistics(text: str) -> list[float]:
    """The statistics of a text, in the order of `STATISTICS`; all zero for a text without words."""
    words = text.split()
    if not words:
        return [0.0] * len(STATISTICS)
    table = process_state("quality_classes", _classes)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    kinds = np.bincount(table[np.minimum(points, 0xFFFF)], minlength=8)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    lines = [x for x in text.split("\n") if x.strip()]
    n, size = len(words), len(text)
    return [
        float(np.log1p(size)),
        float(np.log1p(n)),
        float(np.minimum(lengths.mean(), 100)),
        float(np.minimum(lengths.std(), 100)),
        len(set(words)) / n,
        sum(map(eq, words, words[1:])) / n,
        len(set(lines)) / len(lines),
        float(np.log1p(n / len(lines))),
        (kinds[2] + kinds[3]) / size,
        kinds[3] / n,
        kinds[4] / size,
        kinds[5] / n,
        kinds[6] / n,
        float(np.log1p(kinds[7] / n)),
        kinds[1] / size,
        kinds[0] / size,
        float((lengths <= 2).mean()),
        float((lengths >= 12).mean()),
    ]


@dataclass
class Model:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray | None = None
    steps: tuple[np.ndarray, np.ndarray] | None = None  # raw scores and the calibrated shares at them

    def expand(self, stats: np.ndarray) -> np.ndarray:
        """Random Fourier features with a constant."""
        random = np.random.default_rng(SEED)
        width = WIDTH * np.sqrt(len(self.mean))
        directions = random.normal(size=(len(self.mean), FEATURES)) / width
        phases = random.uniform(0, 2 * np.pi, FEATURES)
        x = np.clip((stats - self.mean) / self.spread, -8, 8)
        waves = np.sqrt(2 / FEATURES) * np.cos(x @ directions + phases)
        return np.concatenate([np.ones((len(x), 1)), waves], axis=1)

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.expand(stats) @ self.weights

    def probability(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), *self.steps), 0, 1)


def measured(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Key and `stats` of every row, repeated rows one by one; other columns are not carried along.

    Null and empty texts have the statistics of an empty text; texts of any length are measured whole. A null key stays.
    """
    kind = docs.schema[key].dataType.simpleString()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = pa.array([statistics(t.as_py() or "") for t in b.column(1)], type=pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b.column(0), values], names=[key, "stats"])

    return docs.select(key, F.col(text).alias("_text")).mapInArrow(measure, f"`{key}` {kind}, stats array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))


def isotonic(positions: np.ndarray, weights: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: the points of the closest monotone curve, for linear interpolation."""
    blocks: list[list[float]] = []  # weight, sum of values, sum of positions
    for x, w, v in zip(positions, weights, values, strict=True):
        blocks.append([w, w * v, w * x])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    return np.array([b[2] / b[0] for b in blocks]), np.array([b[1] / b[0] for b in blocks])


def fit(stats: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality") -> Model:
    """A model from the rows of `stats` that `labels` names; rows with a null key or label are left out.

    Without labelled rows every score is 0.5; with one class only, the share of that class.
    """
    spark = stats.sparkSession
    known = labels.select(F.col(key).alias("_key"), F.col(label).cast("double").alias("y")).dropna()
    rows = stats.join(known, F.col(key) == F.col("_key")).select(
        "stats", "y", (F.pmod(F.xxhash64(F.col("_key").cast("string")), F.lit(CALIBRATION)) == 0).alias("calibrates")
    )
    rows = settle(rows)
    width = len(STATISTICS)
    at = [F.col("stats")[i] for i in range(width)]
    sums = rows.agg(F.count("*"), *[F.avg(a) for a in at], *[F.stddev_pop(a) for a in at]).first()
    if not sums[0]:
        model = Model(np.zeros(width), np.ones(width), np.zeros(FEATURES + 1))
        model.steps = (np.array([0.0]), np.array([0.5]))
        return model
    spread = np.array(sums[1 + width :], dtype=np.float64)
    model = Model(np.array(sums[1 : 1 + width], dtype=np.float64), np.where(spread > 1e-9, spread, 1.0))

    shared = spark.sparkContext.broadcast(vars(model).copy())
    size = FEATURES + 1
    upper = np.triu_indices(size)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        square, right = np.zeros((size, size)), np.zeros(size)
        for b in batches:
            waves = Model(**shared.value).expand(_matrix(b.column(0)))
            square += waves.T @ waves
            right += waves.T @ b.column(1).to_numpy()
        values = np.concatenate([square[upper], right])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values)], names=["cell", "v"])

    taught = rows.where("NOT calibrates").select("stats", "y")
    parts = max(1, -(-sums[0] // ROWS))
    cells = taught.repartition(parts).mapInArrow(summed, "cell int, v double").groupBy("cell").agg(F.sum("v").alias("v"))
    cells = cells.toArrow()
    values = np.zeros(len(upper[0]) + size)
    values[cells.column("cell").to_numpy()] = cells.column("v").to_numpy()
    square = np.zeros((size, size))
    square[upper] = values[: len(upper[0])]
    square = square + np.triu(square, 1).T
    ridge = RIDGE * max(1.0, square[0, 0]) * np.eye(size)
    ridge[0, 0] = 1e-9
    model.weights = np.linalg.solve(square + ridge, values[len(upper[0]) :])

    ready = spark.sparkContext.broadcast(vars(model).copy())

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            place = np.clip((Model(**ready.value).raw(_matrix(b.column(0))) + 0.5) / 2, 0, 1)  # raw scores lie about 0 to 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.minimum((place * BINS).astype(np.int32), BINS - 1)), b.column(1)], names=["bin", "y"]
            )

    held = rows.where("calibrates").select("stats", "y").mapInArrow(binned, "bin int, y double")
    held = held.groupBy("bin").agg(F.count("*").alias("n"), F.avg("y").alias("y")).orderBy("bin").collect()
    if held:
        places = np.array([(r["bin"] + 0.5) / BINS * 2 - 0.5 for r in held])
        model.steps = isotonic(places, np.array([float(r["n"]) for r in held]), np.array([r["y"] for r in held]))
    else:
        model.steps = (np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    return model


def score(stats: DataFrame, model: Model, key: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """Key, `score` (the probability of label 1) and `predicted` of every row of `measured`, null keys and repeated rows
    included. An empty table gives an empty result."""
    shared = stats.sparkSession.sparkContext.broadcast(vars(model).copy())
    kind = stats.schema[key].dataType.simpleString()

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = Model(**shared.value).probability(_matrix(b.column(1)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(values, type=pa.float64())], names=[key, "score"])

    out = stats.select(key, "stats").mapInArrow(scored, f"`{key}` {kind}, score double")
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


__all__ = ["Model", "fit", "measured", "remainder", "score", "statistics"]
