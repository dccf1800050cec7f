"""Quality rules: counted base rules, then a calibrated logistic regression over hashed word and character n-grams.

The regression is fitted on at most ``SAMPLE_ROWS`` labelled rows, taken by the hash of their id, whose features are
hashed on the executors, so the driver holds at most that many sparse rows of at most ``2 * DIM`` entries. A fifth of
the sample is held back to calibrate the probability (a sigmoid over the raw score). Every text is scored whole, in
Arrow batches, against the fixed ``THRESHOLD``.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.session import forget

SAMPLE_ROWS = 2_000
DIM = 1 << 16
THRESHOLD = 0.5
LEAST_WORDS, MOST_REPEATED = 50, 50
CHUNK = 1 << 20
ENTRIES = 1 << 18
SYMBOLS = b"#*$%&|<>"
WHITE = b" \t\n\x0b\x0c\r"
ROUNDS, PENALTY = 150, 1e-6
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(48)

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
VERDICT = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, kept boolean, probability double"

_IS_WHITE = np.isin(np.arange(256), list(WHITE))
_IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur at least twice, the first occurrence included."""
    if len(words) < 4:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)
    pairs = np.unique(ids[:-1] * len(seen) + ids[1:], return_inverse=True)[1]
    _, window, count = np.unique(pairs[:-1] * len(seen) + ids[2:], return_inverse=True, return_counts=True)
    twice = count[window] > 1
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k : k + len(twice)] |= twice
    return int(covered.sum())


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    words = text.split()
    raw = np.frombuffer(text, np.uint8)
    points = int(((raw & 0xC0) != 0x80).sum())
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (
        len(words),
        points - int(_IS_WHITE[raw].sum()),
        int(_IS_SYMBOL[raw].sum()),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < LEAST_WORDS or 100 * n_repeat_words > MOST_REPEATED * n_words


def _chunks(text: bytes):
    """Stretches of about a megabyte, cut at white space where there is any; n-grams do not cross a cut."""
    start = 0
    while start < len(text):
        end = min(len(text), start + CHUNK)
        if end < len(text):
            end = max(text.rfind(b" ", start + 1, end), text.rfind(b"\n", start + 1, end), -1)
            end = end if end > start else start + CHUNK
        yield text[start:end]
        start = end


def features(text: bytes):
    """``(word slots, character slots)`` for each chunk: words and word pairs, 3- and 4-grams of bytes."""
    for chunk in _chunks(text):
        raw = np.frombuffer(chunk, np.uint8).astype(np.uint64)
        three = (raw[:-2] << np.uint64(16) | raw[1:-1] << np.uint64(8) | raw[2:]) if len(raw) > 2 else raw[:0]
        four = three[:-1] << np.uint64(8) | raw[3:] | np.uint64(1 << 40) if len(raw) > 3 else raw[:0]
        characters = (np.concatenate([three, four]) * _MIX) >> _SHIFT
        inside = ~_IS_WHITE[raw.astype(np.int64)]
        first = inside & ~np.concatenate([[False], inside[:-1]])
        starts = np.flatnonzero(first)
        if not len(starts):
            yield starts, characters.astype(np.int64)
            continue
        place = np.arange(len(raw)) - np.repeat(starts, np.diff(np.append(starts, len(raw))), axis=0) if starts[0] == 0 else (
            np.arange(len(raw)) - np.concatenate([np.zeros(starts[0], np.int64), np.repeat(starts, np.diff(np.append(starts, len(raw))))])
        )
        powers = np.cumprod(np.full(int(place.max()) + 1, 0x100000001B3, np.uint64))
        words = np.add.reduceat(np.where(inside, (raw + np.uint64(1)) * powers[place], np.uint64(0)), starts)
        pairs = words[:-1] * np.uint64(31) + words[1:] * _MIX
        yield ((np.concatenate([words, pairs]) ^ (np.concatenate([words, pairs]) >> np.uint64(29))) * _MIX >> _SHIFT).astype(np.int64), characters.astype(np.int64)


def sparse(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """``(slots, shares)``: word slots first, character slots after them; each family's shares sum to one."""
    totals = np.zeros((2, DIM))
    for words, characters in features(text):
        totals[0] += np.bincount(words, minlength=DIM)
        totals[1] += np.bincount(characters, minlength=DIM)
    totals /= np.maximum(totals.sum(axis=1, keepdims=True), 1)
    slots = np.flatnonzero(totals.ravel())
    return slots.astype(np.int32), totals.ravel()[slots].astype(np.float32)


class Model(NamedTuple):
    weights: np.ndarray  # 2 x DIM
    bias: float
    slope: float  # of the calibration
    shift: float

    def raw(self, text: bytes) -> float:
        sums, counts = np.zeros(2), np.zeros(2)
        for family in features(text):
            for k, slots in enumerate(family):
                sums[k] += self.weights[k][slots].sum()
                counts[k] += len(slots)
        return float((sums / np.maximum(counts, 1)).sum() + self.bias)

    def probability(self, text: bytes) -> float:
        return float(_sigmoid(self.slope * self.raw(text) + self.shift))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def fit_entries(labels: np.ndarray, row: np.ndarray, slot: np.ndarray, share: np.ndarray) -> Model | None:
    """Logistic regression by Adam on all rows but each fifth, calibrated on those; None without both labels."""
    held = np.arange(len(labels)) % 5 == 4
    if any(len(set(labels[part])) < 2 for part in (held, ~held)):
        return None
    parts = [slice(at, at + ENTRIES) for at in range(0, len(row), ENTRIES)]
    weights, bias = np.zeros(2 * DIM), 0.0
    moments = np.zeros((2, 2 * DIM + 1))
    balance = np.where(labels == 1, 0.5 / labels[~held].mean(), 0.5 / (1 - labels[~held].mean()))

    def scores() -> np.ndarray:
        return sum(np.bincount(row[p], weights[slot[p]] * share[p], len(labels)) for p in parts) + bias

    for step in range(1, ROUNDS + 1):
        error = np.where(held, 0, (_sigmoid(scores()) - labels) * balance) / max(1, (~held).sum())
        gradient = sum(np.bincount(slot[p], error[row[p]] * share[p], 2 * DIM) for p in parts) + PENALTY * weights
        whole = np.append(gradient, error.sum())
        moments[0] = 0.9 * moments[0] + 0.1 * whole
        moments[1] = 0.99 * moments[1] + 0.01 * whole**2
        move = moments[0] / (1 - 0.9**step) / (np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-9)
        weights -= 0.3 * move[:-1]
        bias -= 0.03 * move[-1]
    raw = scores()
    slope, shift = _calibrate(raw[held], labels[held])
    return Model(weights.reshape(2, DIM).astype(np.float32), bias, slope, shift)


def _calibrate(raw: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """The sigmoid ``slope * raw + shift`` that fits the held-back labels, softened by the size of each class."""
    good, bad = labels.sum(), (1 - labels).sum()
    target = np.where(labels == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    scale = max(float(np.abs(raw).max()), 1e-9)
    x, at = np.stack([raw / scale, np.ones(len(raw))], axis=1), np.zeros(2)
    for _ in range(50):
        p = _sigmoid(x @ at)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        at -= np.clip(np.linalg.solve(hessian, x.T @ (p - target)), -5, 5)
    return float(at[0] / scale), float(at[1])


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, key: str = "doc_id", text: str = "text") -> Model | None:
    """The model, or None where the labels do not hold both kinds. Of contradictory labels the lower counts, of texts
    under one id the first in order, so however often an id repeats, the sample keeps its bound."""
    wanted = (
        labels.where(F.col(key).isNotNull() & F.col("quality").isNotNull())
        .groupBy(F.col(key).cast("long").alias("_id")).agg(F.min("quality").alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id").limit(sample_rows)
    )
    slim = docs.select(F.col(key).cast("long").alias("_id"), F.col(text).cast("string").alias("_text"))
    labelled = slim.join(F.broadcast(wanted), "_id").groupBy("_id", "_label").agg(F.min("_text").alias("_text"))
    rows = labelled.select("_id", "_text", F.col("_label").cast("int"))

    def hashed(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            pairs = [sparse(t or b"") for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([p[0] for p in pairs], pa.list_(pa.int32())),
                 pa.array([p[1] for p in pairs], pa.list_(pa.float32()))], ["id", "label", "slots", "shares"],
            )

    found = rows.mapInArrow(hashed, "id long, label int, slots array<int>, shares array<float>").toArrow().sort_by("id")
    ids = np.array([(int(i) * 0x9E3779B97F4A7C15) & (1 << 64) - 1 for i in found["id"].to_pylist()], np.uint64)
    found = found.take(pa.array(np.argsort(ids, kind="stable")))
    labels = found["label"].to_numpy().astype(float)
    slots, shares = (found[c].combine_chunks() for c in ("slots", "shares"))
    del found
    sizes = np.diff(slots.offsets.to_numpy()) if len(labels) else np.zeros(0, np.int64)
    slot, share = (c.flatten().to_numpy() if len(labels) else np.zeros(0) for c in (slots, shares))
    del slots, shares
    model = fit_entries(labels, np.repeat(np.arange(len(labels), dtype=np.int32), sizes), slot, share)
    del slot, share
    pa.default_memory_pool().release_unused()
    forget(docs.sparkSession)
    return model


def verdict(text: bytes, model: Model | None, threshold: float) -> tuple:
    counts = base_counts(text)
    failed = base_failed(counts[0], counts[4])
    probability = model.probability(text) if model is not None else 1.0
    return *counts, failed, not failed and probability >= threshold, probability


def judge(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, counts, base_failed, kept, probability)``, a row for each row of ``docs``.

    A null text counts as empty, and so fails on its words. Without a model the base rules decide alone. Repeated
    rows are judged each time; other columns play no part.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        for batch in batches:
            rows = [verdict(t or b"", shared.value, threshold) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            columns = list(zip(*rows, strict=True)) or [[]] * 8
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                ["doc_id", *COUNTS, "base_failed", "kept", "probability"],
            )

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(score, VERDICT)


def keep_good(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all their columns, in one pass without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches):
        for batch in batches:
            texts = batch.column(text).cast(pa.binary()).to_pylist()
            yield batch.filter(pa.array([verdict(t or b"", shared.value, threshold)[6] for t in texts], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
