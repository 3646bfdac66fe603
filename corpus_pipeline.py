"""Corpus pipeline: stages over ``documents``, each written as Parquet below the
shared folder and read again as the next one's input.

Every stage works on all rows its predecessor kept; all but the last return the
columns of their input.  A null or letterless text leaves at the first stage;
an empty table passes through as an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamtab.llm import common, decontaminate, langid, near_dup, packing, toxicity
from streamtab.llm.registry import tokenizer_path

#: At this mean rank distance none of a text's n-grams is in any profile.
NO_LANGUAGE = 0.999


def _decide(docs: DataFrame, work, keep) -> DataFrame:
    """The rows of ``docs`` that ``keep`` holds for, after ``work`` added its
    columns.  Input columns go by number meanwhile, so that any name may occur."""
    numbered = {c: "body" if c == "text" else f"in{i}" for i, c in enumerate(docs.columns)}
    rows = docs.select(*[F.col(f"`{c}`").alias(k) for c, k in numbered.items()])
    return work(rows).where(keep).select(*[F.col(k).alias(c) for c, k in numbered.items()])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the labelled documents teach."""
    common.prepare(spark)
    profiles = langid.learn(docs)
    return _decide(docs, lambda d: langid.identify(d, profiles, "body"),
                   (F.col("lang_pred") != langid.UNKNOWN) & (F.col("distance") < NO_LANGUAGE))


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below one half."""
    model = toxicity.learn(docs, common.table(spark, sf_dir, "labels"))
    return _decide(docs, lambda d: toxicity.score(d, model, "body"), F.col("predicted") == 0)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near_dup.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    items = common.table(spark, sf_dir, "benchmark")
    return _decide(docs, lambda d: decontaminate.search(d, items, "body"), F.col("n_hit") == 0)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequence and place."""
    pieces = packing.tokenize(docs, tokenizer_path("word_bpe_49k.json"), with_ids=False).drop("ids")
    return packing.pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [("language_id", language), ("toxicity", toxic), ("near_dedup", near_duplicates),
          ("decontamination", decontaminated), ("packing", packed)]

#: Language profiles, a trained classifier and a tokenizer: not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    common.prepare(spark)
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
