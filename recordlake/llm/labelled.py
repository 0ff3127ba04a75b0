"""Bounded samples of labelled rows for the classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out

#: Labelled rows that a classifier is fitted on at most.
MAX_ROWS = 20_000
#: doc_id modulo-5 fold that is held out of every fit.
FOLDS = 5


def sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int) -> DataFrame:
    """text, label of at most max_rows labelled documents out of the held-out fold, the first by a hash of the id.

    A null label is no label; of several labels of a document the largest holds. Null text counts as empty; a repeated row is an example again.
    """
    chosen = (
        labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("label"))
        .filter(F.col("_id").isNotNull() & F.col("label").isNotNull() & ~held_out("_id", FOLDS))
        .groupBy("_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(max_rows)
    )
    found = docs.select(F.col("doc_id").alias("_doc"), F.coalesce(F.col("text"), F.lit("")).alias("text")).join(F.broadcast(chosen), F.col("_doc") == F.col("_id"))  # at most max_rows
    return found.select("text", "label")
