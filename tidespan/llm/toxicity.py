"""Toxicity by two class-conditional Kneser-Ney models.

Texts become strings of 28 symbols: a boundary, a to z without accents, and one for all digits; letters of other
scripts are mapped onto the 26. For each class, toxic and ordinary, the symbol 5-grams of the labelled training texts
are counted. A class model discounts its counts and backs off to shorter contexts, and from contexts of one symbol to
one distribution that both classes share: it is built from the continuation counts of all texts, labelled or not, so
expressions that a class has hardly seen weigh nearly the same under either model.

A text is scored by length-normalised log-likelihood ratios of its parts: the highest mean per symbol over sliding windows,
for an insult of one word must not be diluted by thousands of ordinary ones; the mean ratio of the words that stand out
most, for a text can be toxic by several words of which each alone is doubtful; and the mean over the text. A logistic
function of these and of the number of words, fitted on training rows whose grams were not counted, gives the probability.

The tables have one cell for each possible gram, 28**5 bytes (17 MB), at any corpus size; that bounds the broadcast.
The labels that a model learns from are a bounded sample, at most `SAMPLE` rows, so texts need no shuffle to meet them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .base import process_state, replacing, settle

SYMBOLS = 28
ORDER = 5
#: Up to this order the distributions are shared by the classes.
SHARED = 2
GRAMS = SYMBOLS**ORDER
DISCOUNT = 0.9
WINDOWS = (6, 12)
#: Numbers of outstanding words whose mean log ratio counts.
WORDS = (1, 2, 3, 5, 8)
FEATURES = len(WINDOWS) + len(WORDS) + 2
#: Log ratios are stored as small integers of this many nats.
STEP = 1 / 12
#: Symbols that are worked on at a time.
CHUNK = 1 << 20
THRESHOLD = 0.7
#: Labelled rows whose grams are counted, and labelled rows that fit the logistic function.
SAMPLE, CALIBRATION_ROWS = 200_000, 20_000
#: One in so many training rows fits the logistic function instead of being counted.
CALIBRATION = 4


def _symbol(cp: int) -> int:
    import unicodedata

    c = chr(cp)
    base = unicodedata.normalize("NFKD", c)[:1].lower()
    if "a" <= base <= "z":
        return ord(base) - 96
    if c.isdigit() or base.isdigit():
        return 27
    return 1 + cp % 26 if c.isalpha() else 0


def _symbol_table() -> np.ndarray:
    return np.array([_symbol(cp) for cp in range(1 << 16)], np.uint8)


def symbols(text: str) -> np.ndarray:
    """The text's symbols, runs of boundaries as one, with a boundary at both ends."""
    table = process_state("toxicity_symbols", _symbol_table)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    out = np.zeros(len(points) + 2, np.uint8)
    out[1:-1] = table[np.minimum(points, 0xFFFF)]
    far = np.flatnonzero(points > 0xFFFF)
    if len(far):  # letters outside the basic plane, such as mathematical ones
        met, which = np.unique(points[far], return_inverse=True)
        out[1 + far] = np.array([_symbol(int(cp)) for cp in met], np.uint8)[which]
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != 0) | (out[:-1] != 0)
    return out[keep]


def grams(found: np.ndarray) -> np.ndarray:
    """The number of the gram that ends at each symbol but the first; boundaries stand before the text."""
    padded = np.concatenate([np.zeros(ORDER - 2, np.int32), found.astype(np.int32)])
    size = len(found) - 1
    key = np.zeros(size, np.int32)
    for i in range(ORDER):
        key *= SYMBOLS
        key += padded[i : i + size]
    return key


@dataclass
class Model:
    """Log ratios of all grams in units of STEP, and the logistic function."""

    ratios: np.ndarray
    coefficients: tuple[float, ...] = ()

    def features(self, text: str) -> tuple[float, ...]:
        """Best mean log ratio over windows of each size, mean log ratios of the outstanding words, the mean over the
        whole text, and the logarithm of the number of words. A word's ratio is the sum over its symbols and the
        boundary behind it."""
        found = symbols(text)
        if len(found) < 2:
            return (0.0,) * FEATURES
        best, total = [-np.inf] * len(WINDOWS), 0.0
        reach = max(WINDOWS)
        keep = np.zeros(0, np.float32)  # the end of the chunk before, for windows across chunks
        begun, words, highest = 0.0, 0, np.zeros(0)  # the ratio of a word that goes on in the next chunk
        for at in range(0, len(found) - 1, CHUNK):
            lead = max(0, at - ORDER + 2)
            part = grams(found[lead : at + CHUNK + 1])[at - lead :]
            ratio = self.ratios[part].astype(np.float32) * STEP
            total += float(ratio.sum())
            line = np.concatenate([keep, ratio])
            sums = np.concatenate([[0.0], np.cumsum(line, dtype=np.float64)])
            for i, size in enumerate(WINDOWS):
                if len(line) >= size:
                    best[i] = max(best[i], float((sums[size:] - sums[:-size]).max()) / size)
            upto = sums[len(keep) + 1 :] - sums[len(keep)]
            ends = np.flatnonzero(found[at + 1 : at + 1 + len(ratio)] == 0)
            if len(ends):
                own = np.diff(upto[ends], prepend=0.0)
                own[0] += begun
                begun = float(upto[-1] - upto[ends[-1]])
                words += len(own)
                highest = np.sort(np.concatenate([highest, own]))[::-1][: max(WORDS)]
            else:
                begun += float(upto[-1])
            keep = line[-(reach - 1) :]
        mean = total / (len(found) - 1)
        windows = (b if b > -np.inf else total / size for b, size in zip(best, WINDOWS, strict=True))
        return (*windows, *(float(highest[:k].sum()) / k for k in WORDS), mean, float(np.log1p(words)))

    def probability(self, features: np.ndarray) -> np.ndarray:
        z = features @ np.array(self.coefficients[1:]) + self.coefficients[0]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _mixed(counts: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Discounted counts by context (row) and symbol (column), with the mass left over spread like `lower`."""
    totals, kinds = counts.sum(axis=1, keepdims=True), (counts > 0).sum(axis=1, keepdims=True)
    with np.errstate(invalid="ignore", divide="ignore"):
        mixed = np.maximum(counts - DISCOUNT, 0) / totals + DISCOUNT * kinds / totals * lower
    return np.where(totals > 0, mixed, lower)


def _repeated(lower: np.ndarray, contexts: int) -> np.ndarray:
    """The distributions of shorter contexts, for each of the contexts that end in them."""
    return np.tile(lower, (contexts // len(lower), 1))


def _continuations(keys: np.ndarray, lowest: int, highest: int, lower: np.ndarray) -> np.ndarray:
    """The distribution of the order `highest`, from how many symbols were seen before each shorter gram."""
    for order in range(lowest, highest + 1):
        before = np.unique(keys % SYMBOLS ** (order + 1)) % SYMBOLS**order
        counts = np.bincount(before, minlength=SYMBOLS**order).reshape(-1, SYMBOLS).astype(np.float64)
        lower = _mixed(counts, _repeated(lower, len(counts)))
    return lower


def kneser_ney(keys: np.ndarray, toxic: np.ndarray, ordinary: np.ndarray) -> np.ndarray:
    """Log ratios of all grams, from the grams seen (keys in rising order) and their counts in either class.

    A gram may have no count: it was seen in a text without a label and serves the shared distribution only.
    """
    shared = _continuations(keys, 1, SHARED, np.full((1, SYMBOLS), 1 / SYMBOLS))
    lower = [_continuations(keys[c > 0], SHARED + 1, ORDER - 1, shared) for c in (toxic, ordinary)]
    out = np.empty(SYMBOLS**ORDER, np.int8)
    contexts = SYMBOLS ** (ORDER - 2)  # those that begin with one symbol
    for first in range(SYMBOLS):
        lo, hi = np.searchsorted(keys, [first * contexts * SYMBOLS, (first + 1) * contexts * SYMBOLS])
        logs = []
        for counts, below in zip((toxic, ordinary), lower, strict=True):
            own = np.zeros(contexts * SYMBOLS)
            own[keys[lo:hi] % (contexts * SYMBOLS)] = counts[lo:hi]
            logs.append(np.log(_mixed(own.reshape(-1, SYMBOLS), _repeated(below, contexts))))
        out[first * contexts * SYMBOLS : (first + 1) * contexts * SYMBOLS] = _stored(logs[0] - logs[1]).reshape(-1)
    return out


def _stored(ratio: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(ratio / STEP), -127, 127).astype(np.int8)


def logistic(features: np.ndarray, labels: np.ndarray, ridge: float = 0.5, rounds: int = 50) -> tuple[float, ...]:
    """Coefficients by Newton's method, the constant first; without both classes the share of the one there is."""
    x = np.concatenate([np.ones((len(features), 1)), features], axis=1)
    w = np.zeros(x.shape[1])
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    w[0] = np.log(share / (1 - share))
    if len(labels) == 0 or labels.min() == labels.max():
        return tuple(w)
    penalty = ridge * np.eye(len(w))
    penalty[0, 0] = 1e-9
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - labels) + penalty @ w
        curve = (x * (p * (1 - p))[:, None]).T @ x + penalty + 1e-9 * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w -= step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
    return tuple(w)


def remainder(key: str, modulus: int):
    """crc32 of the key as text, modulo `modulus`; a null key counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % modulus


def _fold(key: str):
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(CALIBRATION))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The grams of (text, label) rows, of the whole partition: (gram, toxic, ordinary); without a label both are 0."""
    present = np.zeros(GRAMS, bool)
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    waiting, size = [], 0

    def merged(keys, counts):
        new, often = np.unique(np.concatenate(waiting), return_counts=True)
        both, place = np.unique(np.concatenate([keys, new]), return_inverse=True)
        return both, np.bincount(place, np.concatenate([counts, often]), len(both)).astype(np.int64)

    for b in batches:
        for text, label in zip(b.column(0), b.column(1).to_pylist(), strict=True):
            found = symbols(text.as_py() or "")
            for at in range(0, len(found) - 1, CHUNK):
                lead = max(0, at - ORDER + 2)
                part = grams(found[lead : at + CHUNK + 1])[at - lead :]
                present[part] = True
                if label is not None:
                    waiting.append(2 * part.astype(np.int64) + (label == 1))
                    size += len(part)
            if size > 2 * CHUNK:
                keys, counts = merged(keys, counts)
                waiting, size = [], 0
    if waiting:
        keys, counts = merged(keys, counts)
    seen = np.flatnonzero(present)
    place = np.searchsorted(seen, keys // 2)
    toxic = np.bincount(place, counts * (keys % 2), len(seen)).astype(np.int64)
    ordinary = np.bincount(place, counts * (1 - keys % 2), len(seen)).astype(np.int64)
    columns = [pa.array(seen), pa.array(toxic), pa.array(ordinary)]
    yield pa.RecordBatch.from_arrays(columns, names=["gram", "toxic", "ordinary"])


def _sampled(known: DataFrame, rows: int) -> DataFrame:
    """The distinct (key, label) rows, of more than `rows` a part by the hashes of their keys, fewer than `rows`."""
    known = settle(known.distinct())
    total = known.count()
    if total <= rows:
        return known
    span = 1 << 30
    return known.where(F.pmod(F.xxhash64("_key", F.lit("sample")), F.lit(span)) < int(0.9 * rows / total * span))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    label: str = "toxic",
    sample: int = SAMPLE,
    calibration_rows: int = CALIBRATION_ROWS,
) -> Model:
    """Models of both classes from the labelled rows, and their shared distribution from all rows.

    Label rows with a null key or label are left out, repeated ones count once. One in `CALIBRATION` fits the logistic
    function, at most `calibration_rows` of them; the others are counted, at most `sample`. Both bounds are kept by
    sampling label rows, so what is broadcast is bounded.
    """
    spark = docs.sparkSession
    known = labels.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_label")).dropna()
    texts = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    taught = F.broadcast(_sampled(known.where(_fold("_key") != 0), sample))
    picked = F.broadcast(_sampled(known.where(_fold("_key") == 0), calibration_rows))

    rows = texts.join(taught, "_key", "left").select("_text", "_label")
    counts = rows.mapInArrow(_counted, "gram bigint, toxic bigint, ordinary bigint")
    total = counts.groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")).toArrow()
    seen = total.column("gram").to_numpy()
    order = np.argsort(seen)
    columns = [total.column(n).to_numpy().astype(np.float64)[order] for n in ("toxic", "ordinary")]
    model = Model(kneser_ney(seen[order].astype(np.int64), *columns))

    shared = spark.sparkContext.broadcast(vars(model).copy())

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(**shared.value)
        for b in batches:
            values = [model.features(t.as_py() or "") for t in b.column(0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, type=pa.list_(pa.float64())), b.column(1)], names=["features", "label"]
            )

    checked = texts.join(picked, "_key").select("_text", "_label")
    checked = checked.mapInArrow(measured, "features array<double>, label int").toArrow()
    features = np.array(checked.column("features").to_pylist(), dtype=np.float64).reshape(-1, FEATURES)
    model.coefficients = logistic(features, checked.column("label").to_numpy().astype(np.float64))
    return model


def score(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """All rows with `score`, the probability of being toxic, and `predicted`, 1 from the threshold on.

    Null and empty texts have no grams: all features are 0. Repeated rows are scored one by one, texts of any length whole;
    columns of the input named like the new ones are replaced. An empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(model).copy())
    names = docs.columns
    rows = docs.select(F.struct("*").alias("row"), F.col(text).alias("_text"))
    schema = rows.select("row").schema.add("_score", "double")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(**shared.value)
        for b in batches:
            features = np.array([model.features(t.as_py() or "") for t in b.column(1)], dtype=np.float64)
            values = model.probability(features.reshape(-1, FEATURES))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(values)], names=["row", "_score"])

    out = rows.mapInArrow(scored, schema)
    predicted = (F.col("_score") >= threshold).cast("int")
    return out.select(*replacing("row", names, score=F.col("_score"), predicted=predicted))
