"""Operator 7: mixing to target weights by soft membership.

A classifier trained on a bounded sample of labelled documents gives every
document a posterior over domains.  Rates r >= 0, one a document, are fitted
by distributed projected gradient: they minimise the distance between the
expected tokens of each domain, sum of r * tokens * posterior, and its target,
in the metric of the domains' token Gram matrix, from r = 1 with each document
weighted by its tokens.  A step needs the domain totals only (one aggregate
over the documents); the rates are a function of a document's own posterior
and the few vectors of the steps so far, so no state is kept between steps.

Copies follow from the rate: its whole part, and one more where the fraction
exceeds a hash of the id, so that the expected tokens of the copies are those
of the rates.  Under the default budget the scarcest domain is wanted whole:
the rates of its documents are then bounded by one from below, if the targets
can be met so.
"""

from __future__ import annotations

import warnings

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetcraft.llm.classifier import labelled_rows, train
from sheetcraft.llm.common import EXACT, joined, prepare, text_groups, word_hashes, written

STEPS = 40
TOLERANCE = 1e-6
MET = 1e-3  # share of the budget by which a domain may miss its target
ADDED = ("n_tokens", "posterior", "domain", "rate", "copies")


def memberships(docs: DataFrame, model, carry: list[str], text_col: str) -> DataFrame:
    """``carry`` columns with n_tokens (words of the whole text) and posterior."""
    carried = [f"c{i}" for i in range(len(carry))]
    rows = docs.select(
        F.col(text_col).cast("string").alias("text"), *(F.col(f"`{c}`").alias(n) for c, n in zip(carry, carried))
    )
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
    width = len(model.classes)

    def run(batches):
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for positions, group in text_groups(range(len(texts)), texts):
                _, starts, _ = word_hashes((joined(group))[0], EXACT)
                n_tokens = np.diff(np.searchsorted(starts, joined(group)[1]))
                flat = pa.array(model.posteriors(group).ravel() if width else np.empty(0))
                posterior = pa.ListArray.from_arrays(pa.array(np.arange(len(group) + 1) * width, pa.int32()), flat)
                own = batch.take(pa.array(positions))
                yield pa.RecordBatch.from_arrays(
                    [*own.columns[1:], pa.array(n_tokens, pa.int64()), posterior], [*carried, "n_tokens", "posterior"]
                )

    found = rows.mapInArrow(run, ", ".join(x for x in (fields, "n_tokens long, posterior array<double>") if x))
    return found.toDF(*carry, "n_tokens", "posterior")


def rate_column(steps: list[np.ndarray], most: float, whole: int | None = None) -> Column:
    """The rate after the given steps, from a document's posterior; at least
    one where domain ``whole`` is the most probable."""
    least = F.lit(0.0)
    if whole is not None:
        least = F.when(F.array_position("posterior", F.array_max("posterior")) == whole + 1, F.lit(1.0)).otherwise(least)
    rate = F.lit(1.0)
    for step in steps:
        change = sum((F.col("posterior")[k] * float(y) for k, y in enumerate(step)), F.lit(0.0))
        rate = F.greatest(least, F.least(F.lit(float(most)), rate - change))
    return rate


def totals(rows: DataFrame, weight: Column, width: int) -> np.ndarray:
    found = rows.agg(*(F.sum(F.col("n_tokens") * weight * F.col("posterior")[k]) for k in range(width))).first()
    return np.array([x or 0.0 for x in found])


def fit_rates(rows: DataFrame, classes: list[str], weights: dict[str, float], budget: float | None, most: float) -> Column:
    """The rate by projected gradient; only domain totals reach the driver."""
    width = len(classes)
    wanted = np.array([weights.get(c, 0.0) for c in classes])
    if not width or wanted.sum() <= 0:
        return F.lit(1.0)
    wanted = wanted / wanted.sum()
    present = totals(rows, F.lit(1.0), width)
    if present.sum() <= 0:
        return F.lit(1.0)
    whole = None
    if budget is None:  # as much as the scarcest domain gives without repeating it
        whole = min((k for k in range(width) if wanted[k] > 0), key=lambda k: present[k] / wanted[k])
        budget = float(present[whole] / wanted[whole])
    target = wanted * budget
    posterior = F.col("posterior")
    pairs = rows.agg(
        *(F.sum(F.col("n_tokens") * posterior[i] * posterior[j]) for i in range(width) for j in range(width))
    ).first()
    gram = np.array([x or 0.0 for x in pairs]).reshape(width, width)
    gram += np.eye(width) * 1e-9 * np.trace(gram)
    if whole is not None:
        steps, gap = projected_steps(rows, present, target, gram, budget, most, whole)
        if gap <= MET * budget:
            return rate_column(steps, most, whole)
    steps, gap = projected_steps(rows, present, target, gram, budget, most)
    if gap > MET * budget:
        warnings.warn(f"rates of 0 to {most} miss the target of a domain by {gap:.0f} of {budget:.0f} tokens", stacklevel=3)
    return rate_column(steps, most)


def projected_steps(
    rows: DataFrame, present: np.ndarray, target: np.ndarray, gram: np.ndarray, budget: float, most: float, whole: int | None = None
) -> tuple[list[np.ndarray], float]:
    """Steps of the projected gradient, and the largest gap to a target that is left."""
    steps: list[np.ndarray] = []
    now = present
    for _ in range(STEPS):
        gap = now - target
        if np.abs(gap).max() <= TOLERANCE * max(budget, 1.0):
            break
        steps.append(np.linalg.solve(gram, gap))
        new = totals(rows, rate_column(steps, most, whole), len(target))
        settled = np.abs(new - now).max() <= TOLERANCE * max(budget, 1.0)
        now = new
        if settled:
            break
    return steps, float(np.abs(now - target).max())


def mix_documents(
    docs: DataFrame,
    labels: DataFrame,
    weights: dict[str, float],
    label_col: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: list[str] | None = None,
    budget: float | None = None,
    most: float = 4.0,
    per_class: int = 1200,
    classes: int = 32,
    chars: int = 20_000,
) -> DataFrame:
    """``carry`` columns (all but those named as added ones, by default), then
    n_tokens, posterior, domain (most probable), rate and copies.

    ``weights``: token share wanted of each domain (label value as text);
    domains not named get none.  ``budget``: expected tokens of the mix; by
    default what the scarcest domain allows without repeats.  ``most``: the
    largest rate.  The classifier learns from at most ``per_class`` documents
    of each wanted domain and of the most frequent other labels, ``classes``
    in all or as many as are wanted; a wanted domain without such a document is
    an error, a target that the rates cannot reach a warning.  Null texts have no
    tokens and keep their prior posterior; without labels every rate is one.
    Repeated rows keep their rows; equal ids get equal hashes."""
    prepare(docs.sparkSession)
    carry = [c for c in docs.columns if c not in ADDED] if carry is None else carry
    named = [c for c, w in weights.items() if w > 0]
    texts, found, priors = labelled_rows(docs, labels, label_col, per_class, classes, chars, id_col, named)
    if found and (missing := sorted(set(named) - set(found))):
        raise ValueError(f"no labelled document to learn the wanted domains from: {missing}")
    model = train(texts, found, priors)
    rows = written(memberships(docs, model, carry, text_col), "memberships")
    rate = fit_rates(rows, model.classes, weights, budget, most)
    names = F.array(*(F.lit(c) for c in model.classes)) if model.classes else F.lit(None).cast("array<string>")
    best = F.array_position("posterior", F.array_max("posterior")).cast("int")
    domain = F.when(F.size("posterior") > 0, F.get(names, best - 1))
    share = F.pmod(F.xxhash64(id_col, F.lit(17)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return rows.select("*", domain.alias("domain"), rate.alias("rate"), F.floor(rate + share).cast("int").alias("copies"))
