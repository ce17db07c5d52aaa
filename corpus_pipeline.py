"""A corpus pipeline over ``documents``: language ID, line dedup, SimHash
near-dedup, mixing to target weights, BPE coding.

Each stage takes (spark, docs, sf_dir) and works on all that the stage
before it kept; ``run`` writes each stage's rows to the shared checkpoint
folder and reads them again.  All stages but the last return the columns of
``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.llm.bpe import bpe_digest, bpe_encode
from tillcast.llm.common import stored, table
from tillcast.llm.language_id import known_language
from tillcast.llm.line_dedup import line_dedup
from tillcast.llm.mixing import mix_to_weights
from tillcast.llm.queries import DOMAIN_WEIGHTS, LANG_WEIGHTS, SOURCE_WEIGHTS, with_domain
from tillcast.llm.simhash import simhash_dedup


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that are in no language (null, or without a letter) go."""
    return known_language(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; n_chars is that of the text that is left."""
    kept = line_dedup(docs)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by their fingerprints the smallest doc_id stays."""
    return simhash_dedup(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many tokens as there are, in the target weights; no document more than
    twice.  The document in which a leaf's budget ends stays whole."""
    taken = mix_to_weights(with_domain(docs), ["domain", "lang", "source"], [DOMAIN_WEIGHTS, LANG_WEIGHTS, SOURCE_WEIGHTS], share=(1, 1), max_epochs=2)
    return taken.select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document that is taken, with digests of the ids and of
    the text that they decode to."""
    coded = bpe_encode(docs.select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"), decoded_col="decoded")
    return bpe_digest(coded, "ids")


STAGES = [("language ID", language_id), ("line dedup", lines), ("SimHash near-dedup", near_dedup), ("mixing", mixing), ("BPE", tokens)]

# Language ID, fingerprints and BPE have no form in SQL: the test holds run()
# against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
