"""Hashed n-gram logistic regression, shared by quality and mixing.

A text has three groups of features, hashed to ``1 << BITS`` columns each:
its distinct words and its distinct word pairs (weight one over the root of
their number), and its runs of four bytes (weight their share).  Training
works on a bounded sample in the driver; scoring is a numpy function over
batches of whole texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheetcraft.llm.common import EXACT, joined, shingle_hashes, text_groups, word_hashes

BITS = 17
_WIDE = 1 << BITS
BYTE_WEIGHT = 4.0  # of a text's byte runs against its words


def word_keys(texts: list[bytes], data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text number and column of each distinct word and word pair."""
    words, starts, _ = word_hashes(data, EXACT)
    bounds = np.searchsorted(starts, offsets)
    owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
    shift = np.uint64(64 - BITS)
    single = (words >> shift).astype(np.int64)
    pairs = (shingle_hashes(words, 2) >> shift).astype(np.int64) + _WIDE
    within = owner[1:] == owner[:-1]
    keys = np.unique(np.concatenate((owner * (2 * _WIDE) + single, (owner[1:] * (2 * _WIDE) + pairs)[within])))
    return keys // (2 * _WIDE), keys % (2 * _WIDE)


def hashed_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, column and value of every feature, by text."""
    data, offsets = joined(texts)
    rows, columns = word_keys(texts, data, offsets)
    values = 1.0 / np.sqrt(np.bincount(rows, minlength=len(texts))[rows])
    grams, gram_rows = byte_grams(data, offsets)
    keys, counts = np.unique(gram_rows * _WIDE + grams, return_counts=True)
    gram_rows = keys // _WIDE
    lengths = np.maximum(np.diff(offsets) - 1, 1)
    rows = np.concatenate((rows, gram_rows))
    columns = np.concatenate((columns, keys % _WIDE + 2 * _WIDE))
    values = np.concatenate((values, BYTE_WEIGHT * counts / lengths[gram_rows]))
    order = np.argsort(rows, kind="stable")
    return rows[order], columns[order], values[order]


def byte_grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Column and text number of each run of four bytes (the line feed that
    follows a text may be part of its last runs)."""
    if len(data) < 4:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    wide = data.astype(np.uint32)
    grams = wide[:-3] | wide[1:-2] << np.uint32(8) | wide[2:-1] << np.uint32(16) | wide[3:] << np.uint32(24)
    columns = (grams * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(grams)]
    return columns.astype(np.int64), rows


def grouped_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``hashed_features`` of many texts, a bounded group at a time, compact."""
    parts = []
    for positions, group in text_groups(range(len(texts)), texts):
        rows, columns, values = hashed_features(group)
        parts.append(((rows + positions[0]).astype(np.int32), columns.astype(np.int32), values.astype(np.float32)))
    return tuple(np.concatenate(x) for x in zip(*parts))


@dataclass
class Classifier:
    """Class scores are linear in the features, then calibrated."""

    classes: list[str]
    weights: np.ndarray  # classes x (3 << BITS), float32
    bias: np.ndarray
    slope: float = 1.0
    offset: np.ndarray | None = None

    def raw_scores(self, texts: list[bytes]) -> np.ndarray:
        """Uncalibrated scores, texts x classes, over whole texts."""
        data, offsets = joined(texts)
        rows, columns = word_keys(texts, data, offsets)
        root = np.sqrt(np.maximum(np.bincount(rows, minlength=len(texts)), 1))
        grams, gram_rows = byte_grams(data, offsets)
        lengths = np.maximum(np.diff(offsets) - 1, 1)
        out = np.empty((len(texts), len(self.classes)))
        for k, own in enumerate(self.weights):
            by_word = np.bincount(rows, weights=own.take(columns), minlength=len(texts)) / root
            by_byte = np.bincount(gram_rows, weights=own[2 * _WIDE :].take(grams), minlength=len(texts)) / lengths
            out[:, k] = by_word + BYTE_WEIGHT * by_byte + self.bias[k]
        return out

    def posteriors(self, texts: list[bytes]) -> np.ndarray:
        return softmax(self.raw_scores(texts) * self.slope + (0 if self.offset is None else self.offset))


def softmax(scores: np.ndarray) -> np.ndarray:
    shares = np.exp(scores - scores.max(axis=1, keepdims=True))
    return shares / shares.sum(axis=1, keepdims=True)


def train(texts: list[bytes], labels: list[str], priors: dict[str, float], rounds: int = 60, rate: float = 2.0) -> Classifier:
    """Multinomial logistic regression by AdaGrad over three quarters of the
    sample; a slope and class offsets are then fitted on the other quarter,
    whose rows are weighted to the given class shares (calibration).  With one
    class it always answers that class."""
    classes = sorted(set(labels))
    target = np.array([classes.index(x) for x in labels])
    n, dims = len(texts), 3 * _WIDE
    model = Classifier(classes, np.zeros((len(classes), dims), dtype=np.float32), np.zeros(len(classes)))
    if len(classes) < 2:
        return model
    held = np.arange(n) % 4 == 3
    fit = np.flatnonzero(~held)
    rows, columns, values = grouped_features([texts[i] for i in fit])
    hot = np.eye(len(classes))[target[fit]]
    balance = 1.0 / np.maximum(hot.sum(axis=0), 1)
    share = (hot * balance).sum(axis=1, keepdims=True)
    share = share / share.sum()
    used, place = np.unique(columns, return_inverse=True)
    place = place.astype(np.int32)
    del columns
    weights, bias = np.zeros((len(classes), len(used))), np.zeros(len(classes))
    squares, bias_squares = np.full(weights.shape, 1e-8), np.full(len(classes), 1e-8)
    for _ in range(rounds):
        scores = np.stack([np.bincount(rows, weights=values * w[place], minlength=len(fit)) for w in weights], axis=1) + bias
        error = (softmax(scores) - hot) * share
        for k in range(len(classes)):
            grad = np.bincount(place, weights=values * error[rows, k], minlength=len(used)) + 1e-6 * weights[k]
            squares[k] += grad**2
            weights[k] -= rate * grad / np.sqrt(squares[k])
        grad = error.sum(axis=0)
        bias_squares += grad**2
        bias -= 0.2 * rate * grad / np.sqrt(bias_squares)
    model.weights[:, used] = weights
    model.bias = bias
    calibrate(model, [texts[i] for i in np.flatnonzero(held)], target[held], priors)
    return model


def calibrate(model: Classifier, texts: list[bytes], target: np.ndarray, priors: dict[str, float]) -> None:
    """Slope and offsets that minimise the weighted log loss on held-out rows."""
    if not len(texts):
        return
    raw = np.concatenate([model.raw_scores(group) for _, group in text_groups(range(len(texts)), texts)])
    hot = np.eye(len(model.classes))[target]
    share = np.array([priors.get(c, 0.0) for c in model.classes]) / np.maximum(hot.sum(axis=0), 1)
    weight = (hot * share).sum(axis=1, keepdims=True)
    weight = weight / max(weight.sum(), 1e-12)
    log_slope, offset = 0.0, np.zeros(len(model.classes))
    for _ in range(400):
        error = (softmax(raw * np.exp(log_slope) + offset) - hot) * weight
        log_slope -= 0.2 * float(np.clip((error * raw).sum() * np.exp(log_slope), -1, 1)) + 0.002 * log_slope
        offset = offset - 2.0 * error.sum(axis=0)
    model.slope, model.offset = float(np.exp(log_slope)), offset


def labelled_rows(
    docs: DataFrame, labels: DataFrame, label_col: str, per_class: int, classes: int, chars: int, id_col: str = "doc_id", named: list[str] | None = None
) -> tuple[list[bytes], list[str], dict[str, float]]:
    """Texts and labels of at most ``per_class`` labelled documents of each of
    the ``named`` and then most frequent labels, ``classes`` or all named (those of the smallest id hash, cut
    at ``chars`` characters), and the share of each label among all labels."""
    own = labels.where(F.col(label_col).isNotNull()).select(F.col(id_col).alias("key"), F.col(label_col).cast("string").alias("label"))
    counts = own.groupBy("label").count().orderBy(F.desc(F.col("label").isin(named or [])), F.desc("count"), "label")
    counts = counts.limit(max(classes, len(named or []))).collect()
    total = sum(r["count"] for r in counts)
    rank = F.row_number().over(Window.partitionBy("label").orderBy(F.xxhash64("key"), "key"))
    chosen = own.where(F.col("label").isin([r["label"] for r in counts])).withColumn("rank", rank)
    chosen = chosen.where(F.col("rank") <= per_class).drop("rank")
    texts = docs.select(F.col(id_col).alias("key"), F.substring("text", 1, chars).alias("excerpt"))
    found = texts.join(F.broadcast(chosen), "key").groupBy("key", "label").agg(F.min("excerpt").alias("excerpt"))
    found = found.where("excerpt is not null").collect()  # per_class * classes rows at most
    found.sort(key=lambda r: (hash_order(r["key"]), r["label"], r["excerpt"]))
    return (
        [r["excerpt"].encode("utf-8", "surrogatepass") for r in found],
        [r["label"] for r in found],
        {r["label"]: r["count"] / total for r in counts},
    )


def hash_order(key: int | None) -> int:
    return -1 if key is None else key * 0x9E3779B97F4A7C15 % (1 << 64)
