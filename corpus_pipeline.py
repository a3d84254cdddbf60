"""Corpus pipeline: language, exact copies, near copies, benchmark passages, sampled segmentations.

Each stage is (spark, docs, sf_dir) -> DataFrame and works on all rows of the stage before. All but
the last return the columns of documents, for the rows that stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contactflow.llm import decontamination, exact_dedup, language_id, segmentation, simhash
from contactflow.llm.common import LAST_ID, materialize, order_id, read_documents
from contactflow.llm.queries import DRAWS, PIECES, SEED
from contactflow.session import configure

#: Least posterior probability of the predicted language.
LEAST_LANGUAGE_SCORE = 0.5
#: Deviations below the mean fit of a language's own rows from which a text counts as foreign to it.
FOREIGN_DEVIATIONS = 12.0
#: Keys of documents that a stage drops up to which they are broadcast: about 10 MB.
SMALL_KEYS = 200_000

#: Names of helper columns; documents may have columns of any other name.
ID, KEY, VERDICT = "__row_id", "__row_key", "__verdict"


def _keyed(docs: DataFrame, key) -> DataFrame:
    return docs.withColumns({ID: order_id(), KEY: F.xxhash64(key)})


def _without(keyed: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of keyed whose (ID, KEY) is not in keys, which are written and distinct.

    Up to SMALL_KEYS of them, 16 bytes each, are broadcast, so that no text is moved; beyond that both sides are sorted.
    """
    small = keys.count() <= SMALL_KEYS
    return keyed.join(F.broadcast(keys) if small else keys, [ID, KEY], "left_anti")


def _staying(spark: SparkSession, docs: DataFrame, key, decided: DataFrame) -> DataFrame:
    """The rows of docs that decided(ID, KEY, stays), a row per document, lets stay; equal ID and KEY stay once.

    Only keys that go or repeat meet the texts; what repeats, if anything, is a second pass.
    """
    odd = decided.groupBy(ID, KEY).agg(F.max("stays").alias("__stays"), F.count("*").alias("__n"))
    odd = materialize(spark, odd.where("not __stays or __n > 1"), "odd")
    keyed = _keyed(docs, key)
    once = _without(keyed, odd.select(ID, KEY)).select(docs.columns)
    repeated = odd.where("__stays").select(ID, KEY)
    if repeated.isEmpty():
        return once
    return once.unionByName(keyed.join(repeated, [ID, KEY], "left_semi").dropDuplicates([ID, KEY]).select(docs.columns))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter, in no learned language or of an unsure one; the model learns from all rows of the stage.

    Verdicts are a column beside the text, so no text is moved and rows are judged each. Rows with a
    null text go; rows with a null doc_id are judged like any other; repeated rows stay or go
    together; an empty table stays empty.
    """
    model = language_id.train(docs)
    judged = materialize(spark, docs.withColumn(VERDICT, language_id.verdict(spark, model, F.col("text"), fit=True)), "judged")
    judged = judged.where(~language_id.rejected(model, LEAST_LANGUAGE_SCORE, VERDICT))
    kept = language_id.drop_foreign(spark, judged, model, FOREIGN_DEVIATIONS, VERDICT, "lang")
    return kept.select(docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of equal texts; rows that repeat a doc_id and its text become one.

    A null text counts as empty, a null doc_id as larger than any other. An empty table stays empty.
    """
    decided = exact_dedup.deduplicate(spark, docs)
    decided = decided.select(F.col("order_id").alias(ID), F.xxhash64("digest").alias(KEY), F.col("kept").alias("stays"))
    return _staying(spark, docs, exact_dedup.sha256(exact_dedup.normalised(F.col("text"))), decided)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each class of near copies; rows that repeat it and its text become one.

    Rows without a doc_id go where their class has one with an id, else their different texts stay.
    A null or empty text has fingerprint zero, linked like any other. An empty table stays empty.
    """
    marked = simhash.near_duplicates(spark, docs)
    first = F.col("order_id") == F.coalesce("component_id", F.lit(LAST_ID))
    decided = marked.select(F.col("order_id").alias(ID), F.xxhash64("text_key").alias(KEY), first.alias("stays"))
    return _staying(spark, docs, F.xxhash64("text"), decided)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item.

    Null and empty texts hold none and stay, rows that repeat go or stay together, rows without a
    doc_id are judged by their text. Without documents or items the table stays as it is.
    """
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontamination.contaminated(spark, docs, items)
    leak = materialize(spark, found.select(F.col("order_id").alias(ID), F.xxhash64("text_key").alias(KEY)).distinct(), "leak")
    return _without(_keyed(docs, F.xxhash64("text")), leak).select(docs.columns)


def segment(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of what is left, one row per document and draw.

    A null or empty text has one segmentation, repeated rows have equal ones, a null doc_id stays
    null. An empty table gives no rows.
    """
    return segmentation.summary(segmentation.sample_segmentations(docs, PIECES, DRAWS, SEED))


STAGES = [
    ("language_id", language),
    ("exact_dedup", exact),
    ("simhash_near_dedup", near),
    ("benchmark_decontamination", decontaminate),
    ("sentencepiece", segment),
]

#: The classifier and the sampler are not SQL; tests hold the result against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written and read again."""
    configure(spark)
    docs = read_documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(spark, stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
