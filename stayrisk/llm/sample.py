"""Bounded labelled samples that models are fitted on."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def labelled(docs: DataFrame, labels: DataFrame | None, label: str, learn: Column, max_docs: int, max_chars: int,
             id_col: str = "doc_id", text_col: str = "text", max_total: int = 40_000_000) -> pd.DataFrame:
    """``text, label`` of at most ``max_docs`` labelled documents, the same ones on every run.

    ``labels`` gives ids their labels; without it ``label`` is a column of
    ``docs``, and a text only goes with the label of its own row. ``learn`` is a
    condition on the id column of the table that has the labels. Documents are
    drawn by a hash of their id, each with one text: of rows that repeat an id
    the least text counts (and, in ``docs``, its label); rows that repeat
    (id, label) are one label. A text longer than ``max_chars`` is not drawn (it
    is never cut), and no more than ``max_total`` characters reach the driver at
    any size: in the order of the hashes, texts beyond them are left out. Null
    labels, ids and texts are not drawn.
    """
    told = (docs if labels is None else labels).filter(F.col(label).isNotNull() & F.col(id_col).isNotNull() & learn)
    texts = docs.filter(F.col(label).isNotNull() & learn) if labels is None else docs
    texts = texts.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), *([F.col(label).alias("label")] if labels is None else []))
    ids = told.select(F.col(id_col).alias("id"), *([] if labels is None else [F.col(label).alias("label")])).distinct()
    ids = ids.withColumn("h", F.xxhash64(F.col("id").cast("string"))).orderBy("h", *ids.columns).limit(max_docs)
    found = texts.filter(F.length("text") <= max_chars).join(F.broadcast(ids), "id")
    if labels is None:
        one = found.groupBy("id", "h").agg(F.min(F.struct("text", "label")).alias("one")).select("id", "h", "one.text", "one.label")
    else:
        one = found.groupBy("id", "label", "h").agg(F.min("text").alias("text"))
    one = one.orderBy("h", "id", "label").limit(max_docs).checkpoint()  # so few that one task may hold their lengths
    so_far = Window.orderBy("h", "id", "label").rowsBetween(Window.unboundedPreceding, 0)
    within = one.select("h", "id", "label", F.sum(F.length("text")).over(so_far).alias("chars")).filter(F.col("chars") <= max_total)
    out = one.join(F.broadcast(within.select("id", "label")), ["id", "label"])
    return out.toPandas().sort_values(["h", "label", "text"], ignore_index=True)[["text", "label"]]
