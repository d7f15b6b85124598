"""Bounded samples of labelled rows, for fitting."""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(key: str = "doc_id") -> Column:
    """Rows never learned from: crc32 of the id as text, modulo 5, is 0 (a null id counts as an empty text)."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def is_held_out(key) -> bool:
    return zlib.crc32(("" if key is None else str(key)).encode()) % FOLDS == 0


def sample(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """(doc_id, text, label) of at most ``rows`` labelled rows outside the held-out fold.

    The rows with the smallest digests of their id, so the sample is the same
    on every run and does not follow the order of the table.  Null labels and
    null ids are not used; an id with several rows in either table gives one
    pair (the largest label, the smallest text).  The sample's ids are
    broadcast: ``rows`` bounds them.
    """
    ids = (labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out())
           .groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label")).orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(rows))
    return (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(ids), "doc_id")
            .groupBy("doc_id").agg(F.min(F.struct("text", "label")).alias("x")).select("doc_id", "x.text", "x.label"))
