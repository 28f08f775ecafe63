"""Operator 6: quality rules and a calibrated n-gram classifier.

Base figures are exact counts over whole texts; texts that pass the base rules
are judged by hashed word and byte n-gram logistic regression, trained on a
bounded sample of labelled rows, calibrated on rows kept from training and
compared with a fixed threshold.  One pass over the documents, in Arrow
batches; nothing is shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sheetcraft.llm.classifier import Classifier, labelled_rows, train
from sheetcraft.llm.common import EXACT, joined, keyed_text, mix, prepare, shingle_hashes, spaces, text_groups, word_hashes

MIN_WORDS = 50
MAX_REPEATED = 50  # per cent of the words in repeated three-word windows
KEEP_FROM = 0.3  # probability of good quality from which a text is kept

_SYMBOL = np.zeros(256, dtype=np.int64)
_SYMBOL[list(b"#*$%&|<>")] = 1
_BLANKS = " \t\n\x0b\x0c\r"


def base_figures(texts: list[bytes]) -> dict[str, np.ndarray]:
    """Counts by text: n_words, word_chars, n_symbols, n_dup_lines and
    n_repeat_words."""
    data, offsets = joined(texts)
    words, starts, _ = word_hashes(data, EXACT)
    bounds = np.searchsorted(starts, offsets)

    def per_text(flags: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))[cuts])

    owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
    repeated = np.zeros(len(words), dtype=bool)
    if len(words) > 2:
        windows = mix(shingle_hashes(words, 3) + owner[2:].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        whole = np.flatnonzero(owner[2:] == owner[:-2])
        order = whole[np.argsort(windows[whole], kind="stable")]
        same = windows[order][1:] == windows[order][:-1]
        for place in (order[1:][same], order[:-1][same]):
            for k in range(3):
                repeated[place + k] = True
    return {
        "n_words": np.diff(bounds),
        "word_chars": per_text(((data & 0xC0) != 0x80) & ~spaces(data), offsets),
        "n_symbols": per_text(_SYMBOL.take(data), offsets),
        "n_dup_lines": np.array([dup_lines(t) for t in texts], dtype=np.int64),
        "n_repeat_words": per_text(repeated, bounds),
    }


def dup_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = text.split(b"\n")
    if len(set(lines)) == len(lines):
        return 0
    worded = [x for x in lines if x.strip(_BLANKS.encode())]
    return len(worded) - len(set(worded))


def quality_model(docs: DataFrame, labels: DataFrame, per_class: int = 1200, chars: int = 20_000) -> Classifier:
    """Trained on at most ``per_class`` labelled documents of either quality,
    the first ``chars`` characters of each."""
    texts, classes, priors = labelled_rows(docs, labels, "quality", per_class, 2, chars)
    return train(texts, classes, priors)


def quality_rules(docs: DataFrame, model: Classifier, id_col: str = "doc_id", text_col: str = "text", good: str = "1") -> DataFrame:
    """``(id_col, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, p_good)``, a row a document row.

    A null text has no words and fails.  ``p_good`` is the calibrated
    probability of the class ``good``; without labelled rows, or of one class
    only, there is no verdict beyond the base rules and it is 1."""
    prepare(docs.sparkSession)
    usable = len(model.classes) > 1 and good in model.classes
    at = model.classes.index(good) if usable else 0

    def run(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for positions, group in text_groups(range(len(texts)), texts):
                base = base_figures(group)
                p_good = model.posteriors(group)[:, at] if usable else np.ones(len(group))
                failed = (base["n_words"] < MIN_WORDS) | (100 * base["n_repeat_words"] > MAX_REPEATED * base["n_words"])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(positions)),
                        *(pa.array(base[k].astype(np.int64)) for k in FIGURES),
                        pa.array(failed),
                        pa.array(~failed & (p_good >= KEEP_FROM)),
                        pa.array(p_good),
                    ],
                    ["id", *FIGURES, "base_failed", "kept", "p_good"],
                )

    figures = ", ".join(f"{k} long" for k in FIGURES)
    return keyed_text(docs, id_col, text_col).mapInArrow(
        run, f"{id_col} long, {figures}, base_failed boolean, kept boolean, p_good double"
    )


FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
