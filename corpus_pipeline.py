"""The corpus pipeline: good documents in a known language, one of each group of near copies, mixed and packed.

Every stage takes the documents its predecessor kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from hazegrid.llm import gam, langid, mixing, packing, simhash
from hazegrid.llm.common import keep, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the additive model scores at 0.3 or more. It learns from the labelled documents of its input.

    Null and empty texts have a score like any other, and so may go or stay; an input without labels keeps all rows.
    """
    return gam.keep_good(docs, gam.train(docs, table(spark, sf_dir, "labels")))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; null texts and texts without a letter go, as do scores below 0.3."""
    return langid.keep_known(docs, langid.train(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose 64-bit fingerprints of three-word shingles are linked by 2 or fewer differing
    bits; the smallest id stays. Null and empty texts are copies of each other; of repeated rows one stays."""
    return simhash.one_of_each_group(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order in which their sources meet their target weights. Null and empty texts, repeated rows
    and null ids are placed like any other; a null source is a source of its own; an empty table stays empty."""
    return mixing.in_mixed_order(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens; each is made of documents near each other in the order in
    which the stage before wrote them, which is the mix.

    Null and empty texts are one id long, very long ones are cut, repeated rows are packed each; no rows give no pieces."""
    return packing.pack_in_order(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality classifier", quality), ("language ID", language), ("SimHash near-dedup", near_duplicates),
          ("mixing sources", mix), ("best-fit packing", pack)]

#: SQL cannot express the fitted models, the fingerprints or the tokenizer; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = keep(docs, "stage")
    return docs
