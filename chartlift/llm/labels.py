"""The split of labelled rows into those that may be learned from and those held out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(id_col: Column) -> Column:
    """Whether a row is in the fold that is never learned from (a null id counts as the text 'null')."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("null")).cast("binary")) % FOLDS == 0


def training_labels(labels: DataFrame, label_col: str, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, label 0 or 1), one row for each id; ids with contradicting or no labels are left out."""
    rows = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & ~held_out(F.col(id_col)))
    rows = rows.groupBy(F.col(id_col).alias("doc_id")).agg(F.min(label_col).alias("label"), F.max(label_col).alias("most"))
    return rows.where("label = most").select("doc_id", "label")
