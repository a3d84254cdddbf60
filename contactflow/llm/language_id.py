"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import released

ORDERS = (1, 2, 3)
BITS = 15
SMOOTHING = 0.5
#: The model holds languages x 2**BITS floats; more languages than this are an error.
MAX_LANGUAGES = 1000
UNDETERMINED = "und"
#: Characters that are hashed at once; bounds the memory of a task.
SLICE = 1 << 18
#: Languages whose counts a training task holds at a time.
HELD_LANGUAGES = 64


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    #: (languages, buckets), log-probabilities.
    log_likelihood: np.ndarray
    log_prior: np.ndarray


def _codes(lowered: str) -> np.ndarray:
    return np.frombuffer(lowered.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def _grams(codes: np.ndarray) -> Iterator[np.ndarray]:
    """Hashed n-grams of the code points, one array per order."""
    mixed = codes + np.uint64(1)
    rolled = np.zeros(len(codes), np.uint64)
    for n in ORDERS:
        if len(codes) < n:
            return
        rolled = rolled[: len(codes) - n + 1] * np.uint64(0x100000001B3) + mixed[n - 1 :]
        yield ((rolled + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)


_PLAIN = np.zeros(0, bool)


def _plain(codes: np.ndarray) -> Iterator[np.ndarray]:
    """For each n-gram of _grams, whether it holds only letters and spaces."""
    global _PLAIN
    if not len(_PLAIN):
        _PLAIN = np.fromiter((c == 32 or chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    one = _PLAIN[codes.astype(np.int64)]
    rolled = np.ones(len(codes), bool)
    for n in ORDERS:
        if len(codes) < n:
            return
        rolled = rolled[: len(codes) - n + 1] & one[n - 1 :]
        yield rolled


def _slices(text: str) -> Iterator[np.ndarray]:
    """Buckets of all n-grams of a whole text; slices overlap so that no n-gram is lost.

    The text is made lower case before it is cut, as that may lengthen it.
    """
    text = text.lower()
    for at in range(0, len(text), SLICE):
        codes = _codes(text[max(0, at - max(ORDERS) + 1) : at + SLICE])
        lead = min(at, max(ORDERS) - 1)
        for n, grams in zip(ORDERS, _grams(codes), strict=False):
            yield grams[max(0, lead - n + 1) :].astype(np.int64)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    sizes: dict[str, int] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for lang, have in totals.items():
            at = np.flatnonzero(have)
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang] * (len(at) + 1), pa.string()),
                "bucket": pa.array(np.append(at, -1), pa.int32()),
                "n": pa.array(np.append(have[at], sizes[lang]), pa.int64()),
            })
        totals.clear()
        sizes.clear()

    for batch in batches:
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if not has_letter(text):
                continue
            if lang not in totals:
                if len(totals) == HELD_LANGUAGES:
                    yield from out()
                totals[lang], sizes[lang] = np.zeros(2**BITS, np.int64), 0
            sizes[lang] += 1
            for grams in _slices(text):
                totals[lang] += np.bincount(grams, minlength=2**BITS)
    yield from out()


def train(rows: DataFrame) -> Model:
    """Fit on every row of rows(text, lang) with a letter and a lang; counts cover all rows.

    The languages are counted first, from the lang column alone, and more than MAX_LANGUAGES are an
    error before any text is read. Map tasks add up their own counts, so at most languages x 2**BITS
    rows reach the driver. No usable row gives a model without languages.
    """
    rows = rows.select("text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    if (several := rows.select("lang").distinct().limit(MAX_LANGUAGES + 1).count()) > MAX_LANGUAGES:
        raise ValueError(f"at least {several} languages, more than {MAX_LANGUAGES}")
    counts = rows.mapInArrow(released(_count), "lang string, bucket int, n long")
    table = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = tuple(sorted(set(table["lang"])))
    row = {lang: i for i, lang in enumerate(languages)}
    counted = np.zeros((len(languages), 2**BITS))
    docs = np.zeros(len(languages))
    at = table["lang"].map(row).to_numpy(dtype=np.int64)
    bucket, n = table["bucket"].to_numpy(dtype=np.int64), table["n"].to_numpy(dtype=np.float64)
    docs[at[bucket < 0]] = n[bucket < 0]
    counted[at[bucket >= 0], bucket[bucket >= 0]] = n[bucket >= 0]
    smooth = counted + SMOOTHING
    likelihood = np.log(smooth) - np.log(smooth.sum(axis=1, keepdims=True))
    prior = np.log(docs) - np.log(docs.sum()) if len(languages) else docs
    return Model(languages, likelihood.astype(np.float32), prior)


def score(model: Model, text: str | None, fit: bool = True) -> tuple[str, float, float, int]:
    """Most probable language, its posterior probability; with fit, the mean log-likelihood per plain n-gram and their number."""
    if not has_letter(text) or not model.languages:
        return UNDETERMINED, 0.0, 0.0, 0
    # The text as a sparse count vector: only the buckets that occur meet the matrix.
    counts = np.zeros(2**BITS, np.int64)
    for grams in _slices(text):
        counts += np.bincount(grams, minlength=2**BITS)
    at = np.flatnonzero(counts)
    joint = model.log_prior + model.log_likelihood[:, at].astype(np.float64) @ counts[at]
    best = int(np.argmax(joint))
    total, size = 0.0, 0
    text = text.lower() if fit else ""
    for at in range(0, len(text), SLICE):
        codes = _codes(text[max(0, at - max(ORDERS) + 1) : at + SLICE])
        lead = min(at, max(ORDERS) - 1)
        for n, grams, plain in zip(ORDERS, _grams(codes), _plain(codes), strict=False):
            own = slice(max(0, lead - n + 1), None)
            use = grams[own][plain[own]].astype(np.int64)
            total += float(model.log_likelihood[best][use].sum(dtype=np.float64))
            size += len(use)
    return model.languages[best], float(1.0 / np.exp(joint - joint[best]).sum()), total / max(size, 1), size


def _fits(model: Model, codes: np.ndarray, best: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean log-likelihood of the plain n-grams of texts that stand one behind the other, and their numbers."""
    ends = np.cumsum(lengths)
    owner = np.repeat(best, lengths)
    fit, count = np.zeros(len(lengths)), np.zeros(len(lengths), np.int64)
    for n, grams, plain in zip(ORDERS, _grams(codes), _plain(codes), strict=False):
        stop, begin = np.minimum(np.maximum(ends - n + 1, ends - lengths), len(grams)), np.minimum(ends - lengths, len(grams))
        own = np.where(plain, model.log_likelihood[owner[: len(grams)], grams.astype(np.int64)], 0.0)
        sums = np.concatenate([[0.0], np.cumsum(own, dtype=np.float64)])
        seen = np.concatenate([[0], np.cumsum(plain)])
        fit += sums[stop] - sums[begin]
        count += seen[stop] - seen[begin]
    return fit / np.maximum(count, 1), count


def _score_batch(model: Model, texts: list[str | None], fit: bool) -> tuple[list[str], np.ndarray, list[bool], np.ndarray, np.ndarray]:
    """Score short texts together; long ones go through score() by themselves."""
    langs, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
    fits, sizes = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
    lettered = [has_letter(t) for t in texts]
    if not model.languages:
        return langs, scores, lettered, fits, sizes
    group: list[int] = []
    size = 0

    def flush() -> None:
        if not group:
            return
        codes = [_codes(texts[i].lower()) for i in group]
        lengths = np.array([len(c) for c in codes])
        ends = np.cumsum(lengths)
        joint = np.repeat(model.log_prior[:, None], len(group), axis=1)
        joined = np.concatenate(codes)
        for n, grams in zip(ORDERS, _grams(joined), strict=False):
            at = grams.astype(np.int64)
            stop = np.maximum(ends - n + 1, ends - lengths)
            for c in range(len(model.languages)):
                sums = np.concatenate([[0.0], np.cumsum(model.log_likelihood[c][at], dtype=np.float64)])
                joint[c] += sums[np.minimum(stop, len(at))] - sums[np.minimum(ends - lengths, len(at))]
        best = joint.argmax(axis=0)
        if fit:
            fits[group], sizes[group] = _fits(model, joined, best, lengths)
        top = 1.0 / np.exp(joint - joint.max(axis=0)).sum(axis=0)
        for k, i in enumerate(group):
            langs[i], scores[i] = model.languages[best[k]], top[k]
        group.clear()

    for i, text in enumerate(texts):
        if not lettered[i]:
            continue
        if len(text) > SLICE:
            langs[i], scores[i], fits[i], sizes[i] = score(model, text, fit)
            continue
        if size + len(text) > SLICE:
            flush()
            size = 0
        group.append(i)
        size += len(text)
    flush()
    return langs, scores, lettered, fits, sizes


VERDICT = "struct<lang_pred: string, score: double, has_letter: boolean, fit: double, grams: bigint>"


def verdict(spark: SparkSession, model: Model, text: Column, fit: bool = False) -> Column:
    """Struct column (lang_pred, score, has_letter, fit, grams) of a text; only the text goes to Python.

    fit is the mean log-likelihood under lang_pred of the text's n-grams of letters and spaces, so
    that numbers, links and codes do not count against a text; grams is their number. Both are 0
    unless asked for. The matrix is broadcast; it has at most MAX_LANGUAGES x 2**BITS floats.
    """
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            langs, scores, lettered, fits, sizes = _score_batch(shared.value, texts.to_pylist(), fit)
            yield pa.StructArray.from_arrays(
                [
                    pa.array(langs, pa.string()), pa.array(np.clip(scores, 0.0, 1.0), pa.float64()), pa.array(lettered, pa.bool_()),
                    pa.array(fits, pa.float64()), pa.array(sizes, pa.int64()),
                ],
                names=["lang_pred", "score", "has_letter", "fit", "grams"],
            )

    # The type hints are names here, which the evaluation of string annotations cannot see in a task.
    task = released(run)
    task.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(task, VERDICT)(text.cast("string"))


def identify(spark: SparkSession, docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) for each row of docs(doc_id, text, ...).

    A null text or one without a letter gets "und" and 0, as does every text under a model without
    languages. Ties go to the language that sorts first. Very long texts are hashed in slices. A
    null doc_id stays null, repeated rows are scored each, and other columns are not read, whatever
    their names. An empty table gives an empty table.
    """
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), verdict(spark, model, F.col("text")).alias("verdict"))
    return found.select("doc_id", "verdict.lang_pred", "verdict.score")


def rejected(model: Model, least: float, name: str) -> Column:
    """By the verdict column of that name: texts without a letter, and those whose language is unsure; the latter only if languages were learned."""
    unsure = F.col(f"{name}.score") < least if model.languages else F.lit(False)
    return ~F.col(f"{name}.has_letter") | unsure


def _gram_variance(model: Model) -> dict[str, float]:
    """Variance of the log-likelihood of one n-gram drawn from each language."""
    out = {}
    for lang, row in zip(model.languages, model.log_likelihood.astype(np.float64), strict=True):
        p = np.exp(row)
        out[lang] = float((p * row**2).sum() - (p * row).sum() ** 2)
    return out


def drop_foreign(spark: SparkSession, judged: DataFrame, model: Model, deviations: float, name: str, label: str) -> DataFrame:
    """Rows of judged, with a verdict column of that name, whose text fits its predicted language as that language's rows do.

    The spread of a language is that of the fit over all rows with its label that are predicted so;
    rows without a label do not widen it. As the n-grams of the ORDERS overlap, a text of n of them
    is taken for n / len(ORDERS) draws, so short texts have more room. At most MAX_LANGUAGES rows
    are broadcast.
    """
    own = judged.select(F.col(label).cast("string").alias("label"), f"{name}.*").where((F.col("label") == F.col("lang_pred")) & F.col("has_letter"))
    spread = own.groupBy("lang_pred").agg(F.avg("fit").alias("mean"), F.var_pop("fit").alias("var"))
    pairs = [F.struct(F.lit(lang).alias("lang_pred"), F.lit(v).alias("one")) for lang, v in _gram_variance(model).items()]
    if not pairs:
        return judged
    one = spark.range(1).select(F.inline(F.array(*pairs)))
    limits = spread.join(one, "lang_pred").select("lang_pred", F.struct("mean", "var", "one").alias("__limit"))
    joined = judged.join(F.broadcast(limits.withColumnRenamed("lang_pred", "__lang")), F.col(f"{name}.lang_pred") == F.col("__lang"), "left")
    own_variance = F.lit(float(len(ORDERS))) * F.col("__limit.one") / F.col(f"{name}.grams")
    room = F.lit(deviations) * F.sqrt(F.col("__limit.var") + own_variance)
    far = F.coalesce(F.col(f"{name}.fit") < F.col("__limit.mean") - room, F.lit(False))
    return joined.where(~far).drop("__lang", "__limit")
