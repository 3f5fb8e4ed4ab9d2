"""Corpus preparation: five stages over ``documents``, each written as Parquet and read again.

1. quality: documents that the byte CNN rejects (score below 0.5) go;
2. near_dedup: of each group of SimHash near-duplicate texts the row with the smallest id stays;
3. substrings: windows of 13 words that an earlier document holds are cut out;
4. decontaminate: documents with a leaked benchmark passage go;
5. mix: the rest gets rates that bring the domains to their target weights.

Stages 1 to 4 return the columns of their input, in order and with other
columns untouched, so the next stage reads ``documents`` again. Defined results:
rows with a null id are judged by their own text in stages 1 and 4, stage 2
drops none of them and stage 3 cuts nothing in them; rows that repeat an id are
judged each by its own text in stages 1, 2 and 4, so no text is lost unless a
kept row holds it or a near copy; a document that stage 3 empties stays with an
empty text; empty tables pass through.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayrisk.llm import decontam, mixing, quality, simhash, substring
from stayrisk.llm.text import fold
from stayrisk.session import ensure_checkpoint_dir, ship_package


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labelled documents outside the held-out fold, like the operator's own query."""
    labels = _table(spark, sf_dir, "labels")
    model = quality.train(_table(spark, sf_dir, "documents"), labels, learn=fold(F.col("doc_id"), 3) != 1)
    return quality.keep(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return simhash.keep_one(docs, shingle=3, bits=3)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    out = substring.dedup(docs, keep=others)
    return out.select(*[F.col("rest").getField(c).alias(c) if c in others else F.col(c) for c in docs.columns])


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, _table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    every = _table(spark, sf_dir, "documents")
    labelled = mixing.domain_labels(every, _table(spark, sf_dir, "labels"))
    return mixing.rates(docs, labelled).select("doc_id", "copies", "n_tokens", "domain", "rate")


STAGES = [("quality", quality_filter), ("near_dedup", near_dedup), ("substrings", substrings),
          ("decontaminate", decontaminate), ("mix", mix)]
#: Trained filters and fingerprints are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every result but the last is written to the shared folder and read again."""
    docs = _table(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
