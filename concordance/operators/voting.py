"""Quorum votes, majorities and fused graphs over claims of several sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordance.functions import geometry, text
from concordance.operators.ordering import numbered


def quorum(n: Column) -> Column:
    """Both of two sources, else two thirds rounded up."""
    return F.when(n <= 2, n).otherwise(F.ceil(2 * n / 3)).cast("int")


def _tally(values: Column) -> Column:
    """array<struct<v, n>> of the distinct values in order of their first place."""
    return text.let(values, lambda vs: F.transform(F.array_distinct(vs), lambda v: F.struct(v.alias("v"), F.size(F.filter(vs, lambda w: w == v)).alias("n"))))


def majority(values: Column) -> Column:
    """The commonest value of an array; of equally common ones the first seen."""
    ranked = F.transform(_tally(values), lambda x, i: F.struct(x["n"].alias("n"), (-i).alias("i"), x["v"].alias("v")))
    return F.array_max(ranked)["v"]


def majority_ratio(values: Column) -> Column:
    """Share of the commonest value; no values give 0."""
    return F.coalesce(F.array_max(F.transform(_tally(values), lambda x: x["n"])) / F.nullif(F.size(values), F.lit(0)), F.lit(0.0))


def average_pairwise(values: Column, similarity) -> Column:
    """Mean similarity over all pairs of an array; one value 0.5, none 0."""

    def body(vs: Column) -> Column:
        n = F.size(vs)
        rows = F.transform(vs, lambda a, i: F.aggregate(F.transform(F.slice(vs, i + 2, F.greatest(n - i - 1, F.lit(0))), lambda b: similarity(a, b)), F.lit(0.0), lambda s, v: s + v))
        total = F.aggregate(rows, F.lit(0.0), lambda s, v: s + v)
        return F.when(n == 0, 0.0).when(n == 1, 0.5).otherwise(total / (n * (n - 1) / 2))

    return text.let(values, body)


def text_consistency(votes: Column) -> Column:
    """Mean character-pair Jaccard of the collapsed non-empty votes; up to one vote 1."""
    kept = F.filter(F.transform(votes, text.collapsed), lambda v: v != "")
    return text.let(F.transform(kept, text.bigrams), lambda sets: F.when(F.size(sets) <= 1, 1.0).otherwise(average_pairwise(sets, text.jaccard)))


def representative_shape(votes: Column) -> Column:
    """By votes, known before unknown, then the alphabet."""
    ranked = F.transform(_tally(votes), lambda x: F.struct((-x["n"]).alias("n"), (x["v"] == "unknown").cast("int").alias("u"), x["v"].alias("v")))
    return F.coalesce(F.array_min(ranked)["v"], F.lit("unknown"))


def representative_text(votes: Column) -> Column:
    """The group of equal collapsed texts with most votes, most visible characters, the
    longest key, then the alphabet; of its spellings the largest."""
    keyed = F.filter(F.transform(F.filter(votes, lambda v: v.isNotNull()), lambda v: F.struct(text.collapsed(v).alias("k"), v.alias("v"))), lambda x: x["k"] != "")

    def body(rows: Column) -> Column:
        ranked = F.transform(_tally(F.transform(rows, lambda x: x["k"])), lambda x: F.struct((-x["n"]).alias("n"), (-text.visible_score(x["v"])).alias("s"), (-F.length(x["v"])).alias("l"), x["v"].alias("k")))
        return text.let(F.array_min(ranked)["k"], lambda best: F.array_max(F.transform(F.filter(rows, lambda x: x["k"] == best), lambda x: x["v"])))

    return F.coalesce(text.let(keyed, body), F.lit(""))


def fuse_edges(claims: DataFrame, sources: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """Edges with support, by quorum of the graph's sources.

    ``claims``: graph, source_model, source, target, label; ``sources``: graph, n; ``nodes``:
    graph, node_id of the fused nodes, to which edges must belong (else see ``edge_errors``).
    A claim counts once per model and label, every label is a vote, and the support is the
    number of models. An edge claimed both ways has ``conflict``.
    """
    if nodes is not None:
        for end in ("source", "target"):
            claims = claims.join(nodes.select("graph", F.col("node_id").alias(end)), ["graph", end], "left_semi")
    once = claims.groupBy("graph", "source", "target", "source_model", F.trim("label").alias("label")).agg(F.lit(1).alias("one"))
    edges = once.groupBy("graph", "source", "target").agg(F.count_distinct("source_model").alias("support"), F.sort_array(F.collect_list("label")).alias("labels"))
    back = edges.select("graph", F.col("source").alias("target"), F.col("target").alias("source"), F.lit(True).alias("reverse"))
    out = edges.join(back, ["graph", "source", "target"], "left").join(sources, "graph")
    status = F.when(F.col("support") >= quorum(F.col("n")), "fused").otherwise("low_support")
    return out.select("graph", "source", "target", F.col("support").cast("bigint").alias("support"), "n", "labels", status.alias("status"), F.coalesce("reverse", F.lit(False)).alias("conflict"))


def edge_errors(claims: DataFrame, claimed: DataFrame, fused: DataFrame) -> DataFrame:
    """(graph, source_model, source, target, error) of claims that can't be fused: 'unknown_node'
    where an end isn't among the model's own nodes, 'unfused_node' where it isn't fused,
    'duplicate' where the model claims the same edge and label again.

    ``claimed``: graph, source_model, node_id; ``fused``: graph, node_id.
    """
    rows = claims.groupBy("graph", "source_model", "source", "target", F.trim("label").alias("label")).agg(F.count("*").alias("times"))
    for end in ("source", "target"):
        rows = rows.join(claimed.select("graph", "source_model", F.col("node_id").alias(end), F.lit(True).alias("own_" + end)).distinct(), ["graph", "source_model", end], "left")
        rows = rows.join(fused.select("graph", F.col("node_id").alias(end), F.lit(True).alias("fused_" + end)).distinct(), ["graph", end], "left")
    both = lambda c: F.coalesce(F.col(c + "_source") & F.col(c + "_target"), F.lit(False))
    error = F.when(~both("own"), "unknown_node").when(~both("fused"), "unfused_node").when(F.col("times") > 1, "duplicate")
    return rows.select("graph", "source_model", "source", "target", "label", error.alias("error")).filter("error is not null")


def fuse_nodes(claims: DataFrame, sources: DataFrame) -> DataFrame:
    """Nodes with support and confidence. ``claims``: graph, source_model, node_id, shape, text."""
    once = claims.groupBy("graph", "node_id", "source_model").agg(F.min("shape").alias("shape"), F.min("text").alias("text"))
    nodes = once.groupBy("graph", "node_id").agg(F.count("*").alias("support"), F.sort_array(F.collect_list("shape")).alias("shapes"), F.sort_array(F.collect_list("text")).alias("texts"))
    out = nodes.join(sources, "graph")
    return out.select("graph", "node_id", "support", "n", (F.col("support") / F.col("n")).alias("confidence"), representative_shape(F.col("shapes")).alias("shape"), representative_text(F.col("texts")).alias("text"), text_consistency(F.col("texts")).alias("text_consistency"))


def select_nodes(nodes: DataFrame) -> DataFrame:
    """Graphs with the nodes that reach the quorum and whether all sources agree."""
    reach = F.col("support") >= quorum(F.col("n"))
    g = nodes.groupBy("graph", "n").agg(F.count("*").alias("claimed"), F.count_if(reach).alias("selected"), F.count_if(F.col("support") == F.col("n")).alias("common"))
    status = F.when(F.col("selected") == 0, "failed").when(F.col("common") == F.col("claimed"), "fused").when(F.col("n") == 2, "partial").otherwise(F.when(F.col("selected") < F.col("claimed"), "partial").otherwise("fused"))
    return g.withColumn("status", status)


def graph_confidence(node: Column, edge: Column, consistency: Column, label: Column, status: Column, errors: Column, low: Column, low_text: Column, critical: Column, edges: Column) -> Column:
    """Weighted means less capped penalties (fixed weights)."""
    base = 0.45 * node + 0.25 * edge + 0.20 * consistency + 0.10 * label
    penalty = F.when(status == "partial", 0.08).when(status == "ambiguous", 0.18).when(status == "failed", 0.35).otherwise(0.0)
    capped = F.least(F.lit(0.18), 0.03 * errors) + F.least(F.lit(0.12), 0.04 * low) + F.least(F.lit(0.10), 0.03 * low_text) + F.least(F.lit(0.15), 0.05 * critical) + F.when(edges == 0, 0.08).otherwise(0.0)
    return F.round(text.clamp(base - penalty - capped), 4)


def renumbered(nodes: DataFrame, *order: str) -> DataFrame:
    """Nodes of each graph numbered N001.. in the given order."""
    return numbered(nodes, ["graph"], list(order), "order_index").withColumn("new_id", F.format_string("N%03d", F.col("order_index")))


#: Distances between what two models say of one node (fixed values).
FAR, TOO_FAR, APART = 0.20, 0.28, 0.05


def node_conflicts(claims: DataFrame) -> DataFrame:
    """(graph, node_id, model_a, model_b, conflict) for each pair of models and each conflict:
    rows or columns more than one apart, known shapes that differ, box centres far apart, and
    'position_conflict' where they are too far, hardly overlap and rows or columns differ too.

    ``claims``: graph, node_id, source_model, row, col, shape, box (null if there is none).
    """
    a, b = (claims.select("graph", "node_id", *(F.col(c).alias(f"{c}_{s}") for c in ("source_model", "row", "col", "shape", "box"))) for s in "ab")
    pairs = a.join(b, ["graph", "node_id"]).filter("source_model_a < source_model_b")
    gap = lambda c: F.abs(F.col(c + "_a") - F.col(c + "_b"))
    boxed = F.col("box_a").isNotNull() & F.col("box_b").isNotNull()
    distance = geometry.center_distance(F.col("box_a"), F.col("box_b"))
    apart = (F.coalesce(gap("row"), F.lit(0)) > 1) | (F.coalesce(gap("col"), F.lit(0)) > 1)
    found = F.array(
        F.when(gap("row") > 1, "row_conflict"), F.when(gap("col") > 1, "column_conflict"),
        F.when((F.col("shape_a") != "unknown") & (F.col("shape_b") != "unknown") & (F.col("shape_a") != F.col("shape_b")), "shape_conflict"),
        F.when(boxed & (distance > FAR), "far_apart"), F.when(boxed & (distance > TOO_FAR) & (geometry.iou(F.col("box_a"), F.col("box_b")) < APART) & apart, "position_conflict"),
    )
    return pairs.select("graph", "node_id", F.col("source_model_a").alias("model_a"), F.col("source_model_b").alias("model_b"), F.explode(F.array_compact(found)).alias("conflict"))


def reindexed(nodes: DataFrame, edges: DataFrame, *order: str) -> DataFrame:
    """(graph, source, target, new_source, new_target, dangling): edges under the new ids of
    their nodes; an edge whose end is no node is dangling and has no new ids."""
    ids = renumbered(nodes, *order).select("graph", "node_id", "new_id")
    out = edges
    for end in ("source", "target"):
        out = out.join(ids.select("graph", F.col("node_id").alias(end), F.col("new_id").alias("_" + end)), ["graph", end], "left")
    lost = F.col("_source").isNull() | F.col("_target").isNull()
    return out.select("graph", "source", "target", *(F.when(~lost, F.col("_" + end)).alias("new_" + end) for end in ("source", "target")), lost.alias("dangling"))
