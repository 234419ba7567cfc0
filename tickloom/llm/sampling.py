"""Bounded samples of rows for fitting a classifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id's text modulo the divisor; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % divisor


_SHARES = 1 << 30


def sample_per_class(rows: DataFrame, label: str, doc_id: str, per_class: int) -> DataFrame:
    """At most `per_class` rows of each label, by the order of a hash of their ids: the same at each run.

    Labels are counted first. Of one with more than twice as many rows, those pass whose hash lies in
    the share that holds about twice as many, so what is sorted does not grow with the table or its tasks.
    """
    counts = rows.groupBy(F.col(label).alias("_label")).agg(F.count(F.lit(1)).alias("_n"))
    hashed = rows.withColumn("_hash", F.xxhash64(doc_id))
    # one row for each label a classifier knows
    known = hashed.join(F.broadcast(counts), hashed[label] == counts["_label"])
    inside = F.pmod("_hash", F.lit(_SHARES)) * F.col("_n") < F.lit(2 * per_class * _SHARES)
    order = Window.partitionBy(label).orderBy("_hash", doc_id)
    drawn = known.where((F.col("_n") <= 2 * per_class) | inside).withColumn("_nth", F.row_number().over(order))
    return drawn.where(F.col("_nth") <= per_class).drop("_nth", "_hash", "_label", "_n")
