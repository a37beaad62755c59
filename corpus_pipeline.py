"""From raw documents to token counts: quality, toxicity, near duplicates,
benchmark leaks, tokens.

Each stage takes (spark, docs, sf_dir) and returns what it keeps; all but the
last return the columns of ``documents``.  ``run`` writes what a stage keeps to
the shared folder and reads it as the next one's input.  Quality and toxicity
judge each row by its text alone, in place.  The other decisions are made for
ids: rows with a null id never count as near duplicates, and a leak found in
one row of an id (null included) takes all of its rows.  A stage that has
nothing to go by (an empty table, no labels of one kind) keeps all rows;
further columns pass through unchanged.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from contrail.llm import bpe_tree, contamination, near_dups, toxic_spans, weak_quality
from contrail.llm.common import settled, table, work_folder

TOXIC_AT = 0.5
WORDS, PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly trained scorer calls good."""
    return weak_quality.good_documents(docs, work_folder(spark, "pipeline-quality"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxic score stays below TOXIC_AT; learned from the labelled ones here."""
    model = toxic_spans.train_model(docs, table(spark, sf_dir, "labels"))
    return toxic_spans.clean_documents(docs, model, TOXIC_AT)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group of near duplicates."""
    return near_dups.deduplicated(docs, words=WORDS, percent=PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return contamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens and digests of each document left."""
    return bpe_tree.bpe_digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("quality", quality), ("toxicity", toxicity), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("tokens", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the documents of ``sf_dir``."""
    docs, folder = table(spark, sf_dir, "documents"), work_folder(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), folder, name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Trained models and the tokenizer can't be said in SQL.
ORACLE_SQL = None
