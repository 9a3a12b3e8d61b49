"""A corpus pipeline over ``documents``: five stages, each an operator of ``civicstat.llm``.

Each stage gets what the one before it kept, whole, and its decisions take effect:

1. documents whose language can't be told go;
2. of documents linked by their SimHash, the one with the smallest id stays;
3. documents that hold an item of ``benchmark`` go;
4. personal data and secrets get surrogates;
5. the texts that are left are encoded by byte-level BPE and decoded again.

The first four return the columns of ``documents``. ``run`` writes each result as Parquet into the
shared folder and reads it back as the next stage's input, so that a lost executor costs the
stage at hand at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicstat.llm import bpe, decontam, langid, pii, simhash
from civicstat.llm.common import documents, stage
from civicstat.llm.queries import PII_KEY


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.identified(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.dedup(docs, size=simhash.SHINGLE, radius=simhash.RADIUS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, documents(spark, sf_dir, "benchmark"))


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.replace(docs, PII_KEY)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the decoded bytes, as query op2 has them."""
    found = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return found.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"), F.sha2(bpe.id_text("token_ids"), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("decontaminate", decontaminate),
    ("pii_surrogates", surrogates),
    ("byte_bpe", tokens),
]

#: Surrogates and merges have no SQL; the stages are held against brute force in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
