"""First-seen distinct rows, ranked picks and set operations with a defined order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_rows(df: DataFrame, key: list, order: list) -> DataFrame:
    """The first row of each key. Aggregated, not windowed: a hot key is combined map-side."""
    rest = [c for c in df.columns]
    packed = df.withColumn("_k", F.struct(*(k if isinstance(k, Column) else F.col(k) for k in key))).groupBy("_k").agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_v"))
    return packed.select("_v.*")


def top_rows(df: DataFrame, key: list[str], order: list, k: int) -> DataFrame:
    """The first ``k`` rows of each key (Spark limits groups before the shuffle)."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k).drop("_r")


def only_one_side(a: DataFrame, b: DataFrame) -> DataFrame:
    """Symmetric difference of distinct rows."""
    return a.subtract(b).unionAll(b.subtract(a))


def ranked_union(parts: list[DataFrame], key: list[str]) -> DataFrame:
    """Rows of the first part that has the key: fallbacks in order."""
    tagged = [p.withColumn("_p", F.lit(k)) for k, p in enumerate(parts)]
    return first_rows(reduce(DataFrame.unionByName, tagged), key, ["_p"]).drop("_p")
