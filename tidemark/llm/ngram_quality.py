"""Quality rules: fixed limits on counts, then a calibrated model on hashed n-grams.

The model is a logistic regression on the shares of hashed word 1- and 2-grams and of character 3-grams
(code points) in a text. It is fitted on the driver on bounded samples of labelled rows (FIT_ROWS and
CALIBRATE_ROWS, chosen by hash): one fold gives the weights, another one the two numbers of a
Platt calibration, and the third stays unseen. Texts are scored in Arrow batches; a text is kept if
no rule fails and its calibrated probability reaches KEEP_FROM.

Defined cases: a null text has no words, so it fails; without labels of both kinds the model has no say
and rules alone decide; rows with a null id are judged like others; repeated rows are judged alike; an
empty table gives no rows; extra columns are kept, and one named like an added column is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.batches import field, map_batches
from tidemark.llm.bytescan import LEADING, slices, windows
from tidemark.llm.labelled import FOLDS, HELD_OUT, labelled_sample
from tidemark.llm.statistics import SYMBOLS, Scan

BUCKETS = 1 << 15  # of each family of n-grams
FAMILIES = 3
FIT_ROWS, CALIBRATE_ROWS = 4000, 3000
_POINT = np.uint64(0x9E3779B97F4A7C15)
SLICE = 1 << 20  # entries summed at once
LEAST_WORDS, MOST_REPEATED = 50, 50  # words; percent of words
KEEP_FROM = 0.5
SCALE, ROUNDS, RATE, DECAY = 20.0, 120, 0.5, 1e-5


def _grams(scan: Scan) -> list[tuple[np.ndarray, np.ndarray]]:
    """(bucket, text) of every n-gram, a family at a time."""
    w, t = scan.words, scan.texts
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    pairs, pair_text, _ = windows(scan.hashes, w.first, w.last, 2)
    # Code points of the whole slice; the line feed that closes a text is part of its last 3-gram only.
    points = np.frombuffer(t.data.tobytes().decode().encode("utf-32-le"), np.uint32)
    place = np.concatenate(([0], np.cumsum(LEADING[t.data])))
    begin, end = place[t.begin], place[t.end]
    count = np.maximum(end - begin - 1, 0)
    text = np.repeat(np.arange(len(t)), count)
    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(begin, count)
    with np.errstate(over="ignore"):
        three = np.zeros(len(at), np.uint64)
        for j in range(3):
            three = three * _POINT + points[at + j]
        three = (three * _POINT) >> shift
    return [
        ((scan.hashes >> shift).astype(np.int64), w.owner()),
        ((pairs >> shift).astype(np.int64), pair_text),
        (three.astype(np.int64), text),
    ]


@dataclass
class Model:
    weights: np.ndarray  # [families * buckets]
    bias: float
    slope: float  # of the calibration
    shift: float

    def margin(self, scan: Scan) -> np.ndarray:
        out = np.full(len(scan.texts), self.bias)
        for k, (bucket, text) in enumerate(_grams(scan)):
            count = np.bincount(text, minlength=len(out))
            total = np.bincount(text, self.weights[k * BUCKETS + bucket], len(out))
            out += SCALE * total / np.maximum(count, 1)
        return out

    def probability(self, scan: Scan) -> np.ndarray:
        return _sigmoid(self.slope * self.margin(scan) + self.shift)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _sparse(scan: Scan) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text its columns and values."""
    columns, values, owner = [], [], []
    for k, (bucket, text) in enumerate(_grams(scan)):
        key, count = np.unique(text * BUCKETS + bucket, return_counts=True)
        own = key // BUCKETS
        columns.append(key % BUCKETS + k * BUCKETS)
        values.append(SCALE * count / np.bincount(text, minlength=len(scan.texts))[own])
        owner.append(own)
    columns, values, owner = (np.concatenate(x) for x in (columns, values, owner))
    order = np.argsort(owner, kind="stable")
    cut = np.searchsorted(owner[order], np.arange(1, len(scan.texts)))
    return list(zip(np.split(columns[order], cut), np.split(values[order], cut), strict=True))


def _rows(sample: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(columns, values, row, label) of a labelled sample, rows in an order of their own content."""

    def work(batches):
        for b in batches:
            for texts in slices(field(b, "text")):
                labels = field(b, "label").slice(texts.first, len(texts))
                found = _sparse(Scan(texts))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([c.astype(np.int32).tobytes() for c, _ in found], pa.binary()),
                        pa.array([v.astype(np.float32).tobytes() for _, v in found], pa.binary()),
                        labels.cast(pa.int32()),
                    ],
                    ["columns", "values", "label"],
                )

    rows = sorted(tuple(r) for r in map_batches(sample, "columns binary, values binary, label int", work).collect())
    owner = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r[0]) // 4 for r in rows])
    y = np.array([r[2] for r in rows], float)
    columns = np.frombuffer(b"".join(r[0] for r in rows), np.int32)
    rows = [r[1] for r in rows]  # frees the bytes of the columns
    values = np.frombuffer(b"".join(rows), np.float32)
    return columns, values, owner, y


def _margins(weights: np.ndarray, columns, values, owner, rows: int) -> np.ndarray:
    """Sum of weight times value in each row, in single precision but for the sums."""
    return _sums(owner, weights, columns, values, rows)


def _sums(to: np.ndarray, factors: np.ndarray, of: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sums of factors[of] * values by `to`, in slices, as bincount widens its arguments."""
    single, out = factors.astype(np.float32), np.zeros(size)
    for lo in range(0, len(to), SLICE):
        hi = lo + SLICE
        out += np.bincount(to[lo:hi], single[of[lo:hi]] * values[lo:hi], size)
    return out


def _fit(columns, values, owner, y) -> tuple[np.ndarray, float]:
    """Weights and bias by gradient descent with a step size of its own for each weight."""
    size = FAMILIES * BUCKETS
    weights, square, bias, bias_square = np.zeros(size), np.full(size, 1e-8), 0.0, 1e-8
    for _ in range(ROUNDS):
        margin = bias + _margins(weights, columns, values, owner, len(y))
        error = (_sigmoid(margin) - y) / len(y)
        slope = _sums(columns, error, owner, values, size) + DECAY * weights
        square += slope**2
        weights -= RATE * slope / np.sqrt(square)
        bias_square += error.sum() ** 2
        bias -= RATE * error.sum() / np.sqrt(bias_square)
    return weights, bias


def _calibrate(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Platt scaling: slope and shift of least log loss, targets smoothed by pseudo-counts.

    The loss is convex. Margins may be so wide that a full Newton step overshoots into a flat region,
    so they are scaled first, the start is a slope of 0, and a step is halved until the loss falls.
    """
    good = y.sum()
    target = np.where(y == 1, (good + 1) / (good + 2), 1 / (len(y) - good + 2))
    width = max(float(np.abs(margin).max()), 1e-12)
    x = np.column_stack([margin / width, np.ones(len(y))])

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((np.logaddexp(0, z) - target * z).sum())

    found = np.array([0.0, np.log((good + 1) / (len(y) - good + 1))])
    for _ in range(100):
        p = _sigmoid(x @ found)
        slope = x.T @ (p - target)
        bend = (x * (p * (1 - p))[:, None]).T @ x + 1e-9 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        size, before = 1.0, loss(found)
        while size > 1e-10 and loss(found - size * step) > before - 1e-4 * size * float(slope @ step):
            size /= 2
        if size <= 1e-10 or np.abs(size * step).max() < 1e-9:
            break
        found = found - size * step
    return float(found[0] / width), float(found[1])


def train(documents: DataFrame, labels: DataFrame) -> Model | None:
    """The calibrated model, or None where the samples lack one of the two labels."""
    fit_fold, calibrate_fold = (k for k in range(FOLDS) if k != HELD_OUT)
    columns, values, owner, y = _rows(labelled_sample(documents, labels, (fit_fold,), FIT_ROWS))
    if not 0 < y.sum() < len(y):
        return None
    weights, bias = _fit(columns, values, owner, y)
    del columns, values, owner
    columns, values, owner, y = _rows(labelled_sample(documents, labels, (calibrate_fold,), CALIBRATE_ROWS))
    if not 0 < y.sum() < len(y):
        return Model(weights.astype(np.float32), bias, 1.0, 0.0)
    margin = bias + _margins(weights, columns, values, owner, len(y))
    return Model(weights.astype(np.float32), bias, *_calibrate(margin, y))


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def counts(scan: Scan) -> dict[str, np.ndarray]:
    found = (scan.words.count, scan.word_chars(), scan.count(SYMBOLS), scan.duplicate_lines(), scan.repeated_words())
    return dict(zip(COUNTS, found, strict=True))


def failed(found: dict[str, np.ndarray]) -> np.ndarray:
    return (found["n_words"] < LEAST_WORDS) | (100 * found["n_repeat_words"] > MOST_REPEATED * found["n_words"])


def judge(documents: DataFrame, model: Model | None, drop: bool = False, added: bool = True) -> DataFrame:
    """Add the counts, base_failed, probability and kept; or, with `drop`, keep what passes."""
    types = {c: "bigint" for c in COUNTS} | {"base_failed": "boolean", "probability": "double", "kept": "boolean"}
    types = types if added else {}
    own = [f for f in documents.schema if f.name not in types]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in own] + [f"{n} {t}" for n, t in types.items()])

    def work(batches):
        for b in batches:
            found: list[dict[str, np.ndarray]] = []
            for texts in slices(field(b, "text")):
                scan = Scan(texts)
                row = counts(scan)
                row["base_failed"] = failed(row)
                row["probability"] = model.probability(scan) if model else np.ones(len(texts))
                row["kept"] = ~row["base_failed"] & (row["probability"] >= KEEP_FROM)
                found.append(row)
            if not found:
                continue
            columns = {n: np.concatenate([r[n] for r in found]) for n in found[0]}
            out = pa.RecordBatch.from_arrays(
                [*[field(b, f.name) for f in own], *[pa.array(columns[n]) for n in types]], [f.name for f in own] + list(types)
            )
            yield out.filter(pa.array(columns["kept"])) if drop else out

    return map_batches(documents, schema, work)
