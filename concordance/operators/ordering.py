"""Running sums, numbers and neighbours within groups of any size.

A window over a key sorts all rows of the key in one task. Here rows are range-partitioned
by key and order, so a key with a third of all rows lies in many tasks; each partition sums
on its own, and the sums of the partitions before it, a few rows per key, are added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concordance.session import materialise


def running(df: DataFrame, key: list[str], order: list[str], values: dict[str, Column]) -> DataFrame:
    """``df`` with, for each name, the sum of its value up to and including the row.

    ``order`` has to make rows distinct within a key; nulls come first. All sums come from
    one partitioning and one table written.
    """
    at = [*(F.col(c).asc_nulls_first() for c in (*key, *order))]
    split = materialise(df.select("*", *(v.alias("_v_" + n) for n, v in values.items())).repartitionByRange(*at).withColumn("_part", F.spark_partition_id()))
    w = Window.partitionBy("_part", *key).orderBy(*(F.col(c).asc_nulls_first() for c in order)).rowsBetween(Window.unboundedPreceding, 0)
    parts = split.groupBy(*key, "_part").agg(*(F.sum("_v_" + n).alias("_s_" + n) for n in values))
    ahead = Window.partitionBy(*key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(*(F.col(k).alias("_o_" + k) for k in key), F.col("_part").alias("_o_part"), *(F.coalesce(F.sum("_s_" + n).over(ahead), F.lit(0)).alias("_b_" + n) for n in values))
    same = F.col("_part") == F.col("_o_part")
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col("_o_" + k))
    local = split.select("*", *(F.sum("_v_" + n).over(w).alias("_l_" + n) for n in values))
    return local.join(offsets, same).select(*df.columns, *((F.col("_l_" + n) + F.col("_b_" + n)).alias(n) for n in values))


def running_sum(df: DataFrame, key: list[str], order: list[str], value: Column, name: str) -> DataFrame:
    """``df`` with ``name``, the sum of ``value`` up to and including the row."""
    return running(df, key, order, {name: value})


def numbered(df: DataFrame, key: list[str], order: list[str], name: str) -> DataFrame:
    """``df`` with ``name``, the row's number within its key, from 1."""
    return running(df, key, order, {name: F.lit(1)})


def with_next(df: DataFrame, key: list[str], order: list[str], columns: dict[str, str]) -> DataFrame:
    """``df`` with the next row's values: {column: new name}; null at the end of a key."""
    rows = materialise(numbered(df, key, order, "_n"))
    following = rows.select(*(F.col(k).alias("_k_" + k) for k in key), (F.col("_n") - 1).alias("_m"), *(F.col(c).alias(n) for c, n in columns.items()))
    same = F.col("_n") == F.col("_m")
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col("_k_" + k))
    return rows.join(following, same, "left").select(*df.columns, *columns.values())
