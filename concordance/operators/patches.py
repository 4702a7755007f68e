"""Correction patches on blocks: update, insert, keep; several in order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def apply_patches(blocks: DataFrame, decisions: DataFrame, key: list[str]) -> DataFrame:
    """Blocks after the decisions.

    ``blocks``: key..., block_id, order_index, text; ``decisions``: key..., block_id,
    decision_no, decision, text. 'keep' and 'reject' change nothing. Of several patches of
    one block each set field of the last wins; a block that isn't there is appended with
    the next order numbers of its page.
    """
    live = decisions.filter("decision not in ('keep', 'reject') and block_id is not null")
    last = live.groupBy(*key, "block_id").agg(F.max_by("text", F.when(F.col("text").isNotNull(), F.col("decision_no"))).alias("patch"), F.min("decision_no").alias("first_no"))
    at = [*key, "block_id"]
    updated = blocks.join(last, at, "left").select(*key, "block_id", "order_index", F.coalesce("patch", "text").alias("text"), F.col("first_no").isNotNull().alias("patched"))
    new = last.join(blocks.select(*at), at, "left_anti")
    top = blocks.groupBy(*key).agg(F.max("order_index").alias("top"))
    number = F.row_number().over(Window.partitionBy(*key).orderBy("first_no", "block_id"))
    added = new.join(top, key, "left").select(*key, "block_id", (F.coalesce("top", F.lit(0)) + number).alias("order_index"), F.col("patch").alias("text"), F.lit(True).alias("patched"))
    return updated.unionByName(added)


def overreach(proposed: DataFrame, evidence: DataFrame, key: list[str], most: int) -> DataFrame:
    """Keys whose proposal holds more than ``most`` members that no evidence has."""
    new = proposed.distinct().subtract(evidence.select(*proposed.columns).distinct())
    return new.groupBy(*key).agg(F.count("*").alias("novel")).filter(F.col("novel") > most)
