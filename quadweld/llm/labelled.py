"""Bounded samples of labelled documents, for the operators that learn."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold_of(doc_id: Column, folds: int) -> Column:
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds).cast("int")


def least_hashes(rows: DataFrame, digest: Column, at_most: int, *ties: str) -> DataFrame:
    """The ``at_most`` rows with the least digests.

    Only a share of the rows, about four times as many as asked for, goes into the sort.
    """
    n = rows.count()
    part = F.pmod(digest, F.lit(1 << 20))
    share = -(-(4 * at_most * (1 << 20)) // n) if n else 1
    near = rows if share >= 1 << 20 else rows.where(part < share)
    return near.orderBy(part, digest, *ties).limit(at_most)


def training_rows(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, at_most: int) -> DataFrame:
    """Text and label of at most ``at_most`` labelled documents outside the held-out fold.

    Which ones follows from a digest of the id alone. The ids are few by construction, so they are
    sent to the scan of the documents. Ids with contradicting labels are left out.
    """
    usable = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (fold_of(F.col("doc_id"), folds) != held_out))
        .groupBy("doc_id")
        .agg(F.min(label).cast("int").alias("label"), F.max(label).cast("int").alias("_most"))
        .where("label = _most")
    )
    chosen = least_hashes(usable, F.xxhash64("doc_id"), at_most, "doc_id").select("doc_id", "label")
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label")
