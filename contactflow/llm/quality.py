"""Quality scores by positive-unlabelled learning with the non-negative risk."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, order_id

#: Figures of a text; each is cut into bins at quantiles of all documents.
FIGURES = (
    "words", "word_length", "marks", "stops", "digits", "upper", "distinct", "top", "echo", "lines", "line_length", "loud",
)
QUANTILES = (0.01, 0.03, 0.08, 0.15, 0.3, 0.5, 0.7, 0.85, 0.92, 0.97, 0.99)
#: Documents that a bin holds at least: in a small table the outer quantiles are left out.
BIN_ROWS = 50
ROUNDS = 16
#: Weight of the ridge, and what a small table adds to it, divided by its documents.
RIDGE, RIDGE_ROWS = 5e-5, 0.5
#: Trusted positives that a bin must hold to speak for the prior, and the standard errors it is given.
PRIOR_ROWS, PRIOR_ERRORS = 30, 1.0
#: Largest change of a weight in a round, and the share of a step that undoes an over-fit.
STEP, UNDO = 1.0, 0.25
SIZE = 1 + len(FIGURES) * (len(QUANTILES) + 1)

OTHER, LETTER, CAPITAL, DIGIT, BLANK, STOP, LOUD = range(7)


def _classes() -> np.ndarray:
    """Class of each character of the basic plane."""
    out = np.full(1 << 16, OTHER, np.uint8)
    for i in range(1 << 16):
        c = chr(i)
        if c.isalpha():
            out[i] = CAPITAL if c.isupper() else LETTER
        elif c.isdigit():
            out[i] = DIGIT
        elif c.isspace():
            out[i] = BLANK
    out[[ord(c) for c in ".,;:'\"()-"]] = STOP
    out[[ord(c) for c in "!?"]] = LOUD
    return out


CLASSES = _classes()


def figures(text: str | None) -> tuple[float, ...]:
    """The FIGURES of a whole text; shares of nothing are 0."""
    if not text:
        return (0.0,) * len(FIGURES)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = np.bincount(CLASSES[np.minimum(codes, 0xFFFF)], minlength=7).tolist()
    words = text.lower().split()
    n = max(1, len(words))
    counts = Counter(words)
    rows = [r for r in text.split("\n") if r]
    chars = len(text)
    letters = max(1, kinds[LETTER] + kinds[CAPITAL])
    solid = max(1, chars - kinds[BLANK])
    return (
        float(np.log1p(len(words))),
        solid / n if words else 0.0,
        kinds[OTHER] / chars,
        kinds[STOP] / n,
        kinds[DIGIT] / chars,
        kinds[CAPITAL] / letters,
        len(counts) / n,
        max(counts.values(), default=0) / n,
        sum(map(str.__eq__, words, words[1:])) / n,
        1 - len(set(rows)) / max(1, len(rows)),
        float(np.log1p(chars / max(1, len(rows)))),
        kinds[LOUD] / n,
    )


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        table = np.array([figures(t) for t in batch.column(2).to_pylist()], np.float64).reshape(-1, len(FIGURES))
        columns = [pa.array(np.ascontiguousarray(c)) for c in table.T]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=["order_id", "doc_id", *FIGURES])


def bin_edges(rows: DataFrame, n: int) -> list[np.ndarray]:
    """Quantiles of each figure over all rows, those beyond which at least BIN_ROWS lie."""
    use = [q for q in QUANTILES if min(q, 1 - q) * n >= BIN_ROWS] or [0.5]
    cuts = rows.approxQuantile(list(FIGURES), use, 0.002)
    # Missing cuts repeat the last one: their bins stay empty.
    return [np.array((c + c[-1:] * (len(QUANTILES) - len(c))) if c else [0.0] * len(QUANTILES)) for c in cuts]


def class_prior(n_all: float, sum_all: np.ndarray, n_pos: float, sum_pos: np.ndarray) -> float:
    """Share of positives among all documents, from positives and unlabelled documents alone.

    All documents hold at least the positives' share of every bin, so no bin can be rarer among
    them than prior * its share among trusted positives: the prior is the least of these ratios,
    each taken PRIOR_ERRORS standard errors up, over bins with PRIOR_ROWS trusted positives.
    """
    use = sum_pos >= min(PRIOR_ROWS, n_pos)
    share_all, share_pos = sum_all[use] / n_all, sum_pos[use] / n_pos
    error = np.sqrt((1 - share_all) / np.maximum(sum_all[use], 1) + (1 - share_pos) / sum_pos[use])
    return float(np.clip((share_all / share_pos * (1 + PRIOR_ERRORS * error)).min(), 1 / (n_all + 2), (n_all + 1) / (n_all + 2)))


def _design(table: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Indicator columns: a constant, and the bin of each figure."""
    out = np.zeros((len(table), SIZE))
    out[:, 0] = 1
    rows = np.arange(len(table))
    for i, cuts in enumerate(edges):
        out[rows, 1 + i * (len(QUANTILES) + 1) + np.searchsorted(cuts, table[:, i], side="left")] = 1
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


def _sums(weights: np.ndarray, edges: list[np.ndarray]):
    """Sums that the risk, its gradient and its curvature need, over a partition, as (slot, value) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * (2 + 2 * SIZE) + SIZE * SIZE)
        for batch in batches:
            table = np.stack([batch.column(f).to_numpy(zero_copy_only=False) for f in FIGURES], axis=1)
            trusted = batch.column("trusted").to_numpy(zero_copy_only=False)
            x = _design(table, edges)
            z = x @ weights
            p = _sigmoid(z)
            for i, own in enumerate((np.ones(len(z), bool), trusted)):
                block = total[i * (2 + 2 * SIZE) :]
                block[0] += own.sum()
                block[1] += np.logaddexp(0, z[own]).sum()  # loss if the label were 0
                block[2 : 2 + SIZE] += p[own] @ x[own]
                block[2 + SIZE : 2 + 2 * SIZE] += x[own].sum(axis=0)
            total[-SIZE * SIZE :] += ((x * (p * (1 - p))[:, None]).T @ x).ravel()
        slots = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"slot": pa.array(slots, pa.int32()), "value": pa.array(total[slots])})

    return run


def fit(rows: DataFrame, edges: list[np.ndarray], prior: float | None = None) -> np.ndarray:
    """Weights that minimise the non-negative risk over rows(*FIGURES, trusted), by damped Newton rounds.

    Without a prior it is estimated by `class_prior` from the sums of the first round.

    risk = prior * E_trusted[loss of 1] + max(0, E_all[loss of 0] - prior * E_trusted[loss of 0]).
    All documents stand for the unlabelled ones. Where the second part falls below zero, a round
    moves against it, which undoes the over-fit. The weights of the least risk are returned. Each round is one pass over the figures; only
    SIZE * SIZE sums reach the driver, however many documents there are.
    """
    weights = best = np.zeros(SIZE)
    least = np.inf
    for _ in range(ROUNDS):
        found = rows.mapInArrow(_sums(weights, edges), "slot int, value double").groupBy("slot").agg(F.sum("value").alias("value")).toPandas()
        total = np.zeros(2 * (2 + 2 * SIZE) + SIZE * SIZE)
        total[found["slot"].to_numpy(dtype=np.int64)] = found["value"].to_numpy(dtype=np.float64)
        (n_all, loss_all, grad_all, sum_all), (n_pos, loss_pos, grad_pos, sum_pos) = (
            (b[0], b[1], b[2 : 2 + SIZE], b[2 + SIZE : 2 + 2 * SIZE]) for b in (total, total[2 + 2 * SIZE :])
        )
        if not n_pos:
            break
        if prior is None:
            prior = class_prior(n_all, sum_all, n_pos, sum_pos)
        ridge = RIDGE + RIDGE_ROWS / n_all
        negative = loss_all / n_all - prior * loss_pos / n_pos
        negative_grad = grad_all / n_all - prior * grad_pos / n_pos
        positive_grad = prior * (grad_pos - sum_pos) / n_pos
        risk = prior * (loss_pos - weights @ sum_pos) / n_pos + max(0.0, negative)
        if risk < least:
            least, best = risk, weights
        gradient = positive_grad + negative_grad if negative >= 0 else -negative_grad
        curvature = total[-SIZE * SIZE :].reshape(SIZE, SIZE) / n_all + ridge * np.eye(SIZE)
        step = np.linalg.solve(curvature, gradient + ridge * weights)
        step *= min(1.0, STEP / max(1e-12, np.abs(step).max())) * (1.0 if negative >= 0 else UNDO)
        weights = weights - step
        if np.abs(step).max() < 1e-3:
            break
    return best


def score_quality(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """((order_id, doc_id, score) for each row of docs(doc_id, text, ...), weights).

    labels(doc_id, quality): documents labelled 1 are trusted positives; labels 0 are not used. A
    document with several labels counts as 1 if all are; null ids and labels are ignored. score is the model's
    probability of label 1. Null and empty texts are scored by their figures, which are 0. Without
    a trusted positive every score is 0.5. Repeated rows are scored each, a null doc_id stays null,
    other columns are not read, an empty table gives an empty table. Ties share a bin and so a score. Whole texts are measured, however long. The figures are of all
    documents, and so are the bins and the risk; no sample is taken.
    """
    rows = docs.select(order_id().alias("order_id"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "order_id long, doc_id long, " + ", ".join(f"{f} double" for f in FIGURES)
    measured = materialize(spark, rows.mapInArrow(_measure, schema), "figures")
    known = (
        labels.select(F.col("doc_id").cast("long").alias("label_id"), F.col("quality").cast("int").alias("quality"))
        .where("label_id is not null and quality is not null")
        .groupBy("label_id")
        .agg(F.min("quality").alias("quality"))
    )
    joined = measured.join(known, F.col("doc_id") == F.col("label_id"), "left")
    marked = materialize(
        spark, joined.select("order_id", "doc_id", *FIGURES, "quality", (F.coalesce("quality", F.lit(0)) == 1).alias("trusted")), "marked"
    )
    edges = bin_edges(marked, marked.count())
    weights = fit(marked, edges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = np.stack([batch.column(f).to_numpy(zero_copy_only=False) for f in FIGURES], axis=1)
            score = _sigmoid(_design(table, edges) @ weights)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(np.clip(score, 0.0, 1.0))], names=["order_id", "doc_id", "score"])

    return marked.select("order_id", "doc_id", *FIGURES).mapInArrow(run, "order_id long, doc_id long, score double"), weights
