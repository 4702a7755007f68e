"""Markdown tables: parsing to cells, cell-by-cell comparison and scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concordance.functions import text


def lines(df: DataFrame, key: list[str], column: str) -> DataFrame:
    """(key..., line_no, line) of a text column."""
    return df.select(*key, F.posexplode(F.split(F.col(column), r"\r?\n", -1)).alias("line_no", "line")).withColumn("line", F.rtrim("line"))


def parse_table(df: DataFrame, key: list[str], column: str) -> DataFrame:
    """(key..., row_index, col_index, text, normalized_text, is_header, formulas) of the
    first Markdown table of each text.

    A table starts at a line with a bar whose next line is a separator and goes on while
    lines hold a bar; rows are cut or filled to the header's width. All of a text's lines
    stay in its row, so nothing is shuffled.
    """
    rows = F.transform(F.split(F.col(column), r"\r?\n", -1), lambda x: F.rtrim(x))
    held = df.select(*key, rows.alias("_l")).filter(F.exists("_l", text.is_separator))
    n = F.size("_l")
    starts = F.filter(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.get("_l", i - 1).contains("|") & F.coalesce(text.is_separator(F.get("_l", i)), F.lit(False)))
    first = held.withColumn("_s", F.try_element_at(starts, F.lit(1))).filter("_s is not null")
    ends = F.filter(F.sequence(F.col("_s") + 2, n + 1), lambda i: ~F.coalesce(F.get("_l", i - 1).contains("|"), F.lit(False)))
    cut = first.withColumn("_e", F.try_element_at(ends, F.lit(1)))
    body = F.concat(F.slice("_l", F.col("_s"), 1), F.when(F.col("_e") > F.col("_s") + 2, F.slice("_l", F.col("_s") + 2, F.col("_e") - F.col("_s") - 2)).otherwise(F.array().cast("array<string>")))
    split = cut.select(*key, F.size(text.row_cells(F.get("_l", F.col("_s") - 1))).alias("_w"), F.posexplode(body).alias("row_index", "_row"))
    padded = F.slice(F.concat(text.row_cells(F.col("_row")), F.array_repeat(F.lit(""), F.col("_w"))), F.lit(1), F.col("_w"))
    cells = split.select(*key, "row_index", F.posexplode(padded).alias("col_index", "text"))
    return cells.select(*key, "row_index", "col_index", "text", text.cell_text(F.col("text")).alias("normalized_text"), (F.col("row_index") == 0).alias("is_header"), text.formulas(F.col("text")).alias("formulas"))


def cell_diff(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
    """Cells of two tables by place: matched, missing (only in a) or extra (only in b)."""
    at = [*key, "row_index", "col_index"]
    left, right = (d.select(*at, F.col("normalized_text").alias("text_" + s), F.col("formulas").alias("formulas_" + s)) for d, s in ((a, "a"), (b, "b")))
    kind = F.when(F.col("text_b").isNull(), "missing").when(F.col("text_a").isNull(), "extra").otherwise("matched")
    return left.join(right, at, "full_outer").withColumn("kind", kind)


def table_scores(diff: DataFrame, key: list[str], similarity=text.cell_similarity) -> DataFrame:
    """Grid, cell, header, numeric and formula similarity and the weighted table score."""
    a, b, matched, head = F.col("text_a"), F.col("text_b"), F.col("kind") == "matched", F.col("row_index") == 0
    na, nb = text.numbers_with_units(a), text.numbers_with_units(b)
    d = diff.withColumn("_sim", F.when(matched, similarity(a, b)))
    d = d.withColumn("_num", F.when(matched & ((F.size(na) > 0) | (F.size(nb) > 0)), text.numeric_list_similarity(na, nb)))
    fa, fb = F.col("formulas_a"), F.col("formulas_b")
    d = d.withColumn("_for", F.when(matched & ((F.size(fa) > 0) | (F.size(fb) > 0)), text.jaccard(fa, fb)))
    dims = [F.max(F.when(t.isNotNull(), F.col(c) + 1)) for t in (a, b) for c in ("row_index", "col_index")]
    names = ["rows_a", "cols_a", "rows_b", "cols_b"]
    agg = d.groupBy(*key).agg(
        *(F.coalesce(x, F.lit(0)).alias(n) for x, n in zip(dims, names)), F.count_if(matched).alias("matched"), F.count("text_a").alias("n_a"), F.count("text_b").alias("n_b"),
        F.avg("_sim").alias("sim"), F.avg(F.when(head, F.col("_sim"))).alias("head_sim"),
        F.count_if(head & matched & (a == b)).alias("head_equal"), F.count_if(head & a.isNotNull()).alias("head_a"), F.count_if(head & b.isNotNull()).alias("head_b"),
        F.avg("_num").alias("num"), F.avg("_for").alias("form"),
    )
    total = F.col("n_a") + F.col("n_b") - F.col("matched")
    grid = 0.3 * text.ratio_similarity(F.col("rows_a"), F.col("rows_b")) + 0.3 * text.ratio_similarity(F.col("cols_a"), F.col("cols_b")) + 0.4 * F.when(total == 0, 1.0).otherwise(F.col("matched") / total)
    cell = F.coalesce("sim", F.lit(0.0)) * F.col("matched") / F.greatest("n_a", "n_b")
    head_total = F.col("head_a") + F.col("head_b") - F.col("head_equal")
    header = 0.7 * F.coalesce("head_sim", F.lit(0.0)) + 0.3 * F.when(head_total == 0, 1.0).otherwise(F.col("head_equal") / head_total)
    parts = agg.select(
        *key, grid.alias("grid"), cell.alias("cell"), header.alias("header"), F.coalesce("num", F.lit(1.0)).alias("numeric"), F.coalesce("form", F.lit(1.0)).alias("formula"),
        F.round((F.col("n_a") - F.col("matched")) / F.greatest("n_a", F.lit(1)), 4).alias("omission"), F.round((F.col("n_b") - F.col("matched")) / F.greatest("n_b", F.lit(1)), 4).alias("hallucination"),
    )
    score = 0.40 * F.col("grid") + 0.30 * F.col("cell") + 0.10 * F.col("header") + 0.10 * F.col("numeric") + 0.10 * F.col("formula")
    severe = (F.col("grid") < 0.55) | (F.col("omission") > 0.35) | (F.col("hallucination") > 0.35) | (F.col("formula") < 0.55)
    rounded = parts.withColumn("table_score", F.round(score, 4)).withColumn("severe", severe)
    for c in ("grid", "cell", "header", "numeric", "formula"):
        rounded = rounded.withColumn(c, F.round(c, 4))
    return rounded


def best_reference(scores: DataFrame, key: list[str], preferred: str = "anchor") -> DataFrame:
    """The role with the best mean score against the others; ties: preferred, alphabet.

    ``scores``: key..., role_a, role_b, score with role_a < role_b.
    """
    both = scores.select(*key, F.col("role_a").alias("role"), "score").unionAll(scores.select(*key, F.col("role_b"), "score"))
    # means equal but for the order of addition are ties
    mean = both.groupBy(*key, "role").agg(F.round(F.avg("score"), 9).alias("mean_score"))
    w = Window.partitionBy(*key).orderBy(F.desc("mean_score"), F.col("role") != preferred, "role")
    return mean.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def consensus_state(best: Column, others: Column, least: Column) -> Column:
    """'agreed' if all pairs reach 0.88, 'outlier' if the best pair does and others stay to 0.68."""
    return F.when(least >= 0.88, "agreed").when((best >= 0.88) & (others <= 0.68), "outlier").otherwise("conflict")
