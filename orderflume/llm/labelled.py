"""Bounded samples of labelled documents to fit classifiers on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflume.llm.common import fold, spread, texts


def sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, folds: int | None) -> DataFrame:
    """doc_id, text, label of about ``per_class`` documents of either label (twice that at most), each text once.

    Chosen by a hash of doc_id among rows outside fold 0, or all if ``folds`` is None. Labels that are neither 0 nor 1 and
    null ids do not count; a doc_id labelled twice has the larger label.
    """
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
    if folds:
        rows = rows.where(fold("doc_id", folds) != 0)
    rows = rows.groupBy(F.col("doc_id").cast("long").alias("labelled")).agg(F.max(label).cast("int").alias("label"))
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    share = F.when(F.col("label") == 1, per_class / counts.get(1, 1)).otherwise(per_class / counts.get(0, 1))
    order = spread(F.col("labelled"))
    chosen = rows.where(order < share).orderBy(order, "labelled").limit(4 * per_class)
    joined = texts(docs).join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled"))
    return joined.select("doc_id", "text", "label").dropDuplicates(["text", "label"])
