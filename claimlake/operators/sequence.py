"""Stable, dense, 1-based sequence ids without a single-partition window.

A global ``row_number() OVER (ORDER BY ...)`` funnels every row through one
task.  Here the leading order key is cut into ranges at quantile boundaries
computed once (a literal array, so every recomputation assigns the same
range); rows are numbered inside their range by a window partitioned by the
range, and each range adds the number of rows in all lower ranges (one small
count per range).  Nothing is written and no partition ids are relied on.

For a leading key that has no numeric order (e.g. text) the rows are
range-partitioned and materialised with a reliable checkpoint instead, so the
counting pass and the numbering pass read identical partitions.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlake.session import cut_lineage, dropped_shuffles

_QUANTILE_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
                   T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType)


def with_sequence_id(df: DataFrame, order_cols: list[str], name: str = "record_id",
                     start: int = 1, num_partitions: int | None = None, lead_from: DataFrame | None = None,
                     position: tuple[str, int] | None = None) -> DataFrame:
    """``lead_from``: a cheaper frame that holds the leading key, to place the range boundaries (they decide the balance
    of the ranges, never an id).  ``position`` (name, n) also numbers the rows that are equal in the first n order columns,
    1.. in the order of their ids; such rows share a range, so they need no shuffle or sort of their own."""
    spark = df.sparkSession
    if num_partitions is None:
        num_partitions = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    num_partitions = max(1, min(num_partitions, 1024))  # keeps the range search expression small
    # Tie-break on every column so the order inside a range is total and a
    # recomputed task numbers its rows the same way.
    tie = [c for c in df.columns if c not in order_cols and _orderable(df, c)]
    keys = [F.col(c).asc_nulls_first() for c in order_cols + tie]
    lead = order_cols[0]
    if not isinstance(df.schema[lead].dataType, _QUANTILE_TYPES):
        out = _by_checkpoint(df, order_cols, keys, name, start, num_partitions)
        if position:
            w = Window.partitionBy(*order_cols[:position[1]]).orderBy(name)
            out = out.withColumn(position[0], F.row_number().over(w).cast("bigint"))
        return out
    probs = [i / num_partitions for i in range(1, num_partitions)]
    bounds = []
    if probs:
        row = (df if lead_from is None else lead_from).agg(F.percentile_approx(F.col(lead), probs, 10000).alias("q")).first()
        bounds = sorted(set(row["q"] or []))
    bucket = F.when(F.col(lead).isNull(), F.lit(-1)).otherwise(_search(F.col(lead), bounds, 0, len(bounds)))
    b = df.withColumn("_seq_bucket", bucket)
    with dropped_shuffles(spark):
        counts = {r["_seq_bucket"]: r["n"] for r in
                  b.groupBy("_seq_bucket").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per range
    ordered = sorted(counts)
    offsets = dict(zip(ordered, [0] + list(accumulate(counts[k] for k in ordered))[:-1]))
    off = F.element_at(F.create_map(*[x for k in ordered for x in (F.lit(k), F.lit(int(offsets[k])))]),
                       F.col("_seq_bucket")) if ordered else F.lit(0)
    w = Window.partitionBy("_seq_bucket").orderBy(*keys)
    out = b.withColumn(name, (off + F.row_number().over(w) + F.lit(start - 1)).cast("bigint"))
    if position:
        n = position[1]
        w = Window.partitionBy("_seq_bucket", *order_cols[:n]).orderBy(*keys[n:])
        out = out.withColumn(position[0], F.row_number().over(w).cast("bigint"))
    return out.drop("_seq_bucket")


def _search(key, bounds, i: int, j: int):
    """Number of boundaries below ``key`` as a balanced CASE tree
    (log2(#ranges) comparisons per row instead of one per boundary)."""
    if i == j:
        return F.lit(i)
    mid = (i + j) // 2
    return F.when(F.lit(bounds[mid]) < key, _search(key, bounds, mid + 1, j)).otherwise(_search(key, bounds, i, mid))


def _by_checkpoint(df, order_cols, keys, name, start, num_partitions):
    ranged = cut_lineage(df.repartitionByRange(num_partitions, *keys[:len(order_cols)])
                           .sortWithinPartitions(*keys))
    ranged = (ranged.withColumn("_seq_pid", F.spark_partition_id())
                    .withColumn("_seq_mono", F.monotonically_increasing_id()))
    counts = {r["_seq_pid"]: r["n"] for r in
              ranged.groupBy("_seq_pid").agg(F.count(F.lit(1)).alias("n")).collect()}
    sizes = [counts.get(i, 0) for i in range(max(counts, default=-1) + 1)]
    offsets = [0] + list(accumulate(sizes))[:-1]
    offset_arr = F.array(*[F.lit(int(o)) for o in offsets] or [F.lit(0)])
    # monotonically_increasing_id = (partition id << 33) + position in partition
    pos = F.col("_seq_mono") - F.shiftleft(F.col("_seq_pid").cast("bigint"), 33)
    out = ranged.withColumn(
        name, (F.element_at(offset_arr, F.col("_seq_pid") + 1) + pos + F.lit(start)).cast("bigint"))
    return out.drop("_seq_pid", "_seq_mono")


def _orderable(df: DataFrame, c: str) -> bool:
    t = df.schema[c].dataType.typeName()
    return t not in ("variant", "map", "binary")
