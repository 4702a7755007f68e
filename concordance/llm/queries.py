"""Queries of the training-data problems on texts and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concordance.llm import crowd, langid, leaks, lookalike, mixing, truncation
from concordance.session import table


def _stretches(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return langid.stretches(documents, langid.fit(documents))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a missing or wrong label, or several languages; a row per language."""
    return langid.mislabelled(_stretches(spark, sf_dir))


def p8_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's languages with shares and confidence."""
    return langid.languages(_stretches(spark, sf_dir))


def p8_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every single-language stretch with its place, language and confidence."""
    return _stretches(spark, sf_dir).select("doc_id", F.posexplode("segments").alias("segment", "s")).select("doc_id", "segment", "s.*")


def _leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the evaluation items they repeat a passage of."""
    return _leaks(spark, sf_dir).select("doc_id", "item_id")


def p6_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest repeated passage of each document and item, with its edits."""
    return _leaks(spark, sf_dir)


def p6_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every evaluation item with the number of documents it leaked into."""
    found = _leaks(spark, sf_dir).groupBy("item_id").agg(F.count("*").alias("documents"), F.max("passage_tokens").alias("longest"))
    items = table(spark, sf_dir, "eval_items").select("item_id", "split")
    return items.join(found, "item_id", "left").select("item_id", "split", F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("longest", F.lit(0)).alias("longest"))


def _endings(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = truncation.features(table(spark, sf_dir, "model_outputs"), "model_outputs", "output_id", "raw_text", "model_name", "text")
    codes = truncation.features(table(spark, sf_dir, "snapshots"), "snapshots", "snapshot_id", "code", "origin", "code")
    return texts.unionAll(codes)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts and codes whose end was lost."""
    return truncation.posteriors(_endings(spark, sf_dir)).filter("posterior > 0.5").select("source_table", "record_id")


def p3_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of cut values per model and per origin."""
    return truncation.rates(truncation.posteriors(_endings(spark, sf_dir)))


def p3_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate limits with the fitted length distributions."""
    return truncation.limits(_endings(spark, sf_dir))


def _looks(spark: SparkSession, sf_dir: str) -> DataFrame:
    ocr = table(spark, sf_dir, "ocr_regions").select(F.lit("ocr_regions.text").alias("field"), "image_id", F.col("region_id").alias("id"), F.lit(0).alias("pos"), F.col("text").alias("value"))
    nodes = table(spark, sf_dir, "fused_nodes").select("image_id", F.col("node_row_id").alias("id"), F.posexplode("text_votes").alias("pos", "value"))
    edges = table(spark, sf_dir, "visual_graphs").select("image_id", F.col("graph_id").alias("id"), F.posexplode("edges.label").alias("pos", "value"))
    parts = [ocr, *(d.select(F.lit(f).alias("field"), "image_id", "id", "pos", "value") for f, d in (("fused_nodes.text_votes", nodes), ("visual_graphs.edges.label", edges)))]
    values = parts[0].unionAll(parts[1]).unionAll(parts[2]).filter("value is not null and value != ''")
    return lookalike.canonical(values, "value", lookalike.fit(values.select("value")))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of one field and image that look the same but differ."""
    return lookalike.alike(_looks(spark, sf_dir))


def p5_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value in its one form."""
    return _looks(spark, sf_dir).select("field", "image_id", "id", "pos", "value", "canonical")


def _votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(image_id, item, aspect, voter, label) of nodes and edges, texts in one form."""

    def pairs(name: str, votes: str, *keys) -> DataFrame:
        both = F.explode(F.arrays_zip(F.col("support_models").alias("voter"), F.col(votes).alias("label")))
        return table(spark, sf_dir, name).select("image_id", *keys, both.alias("v")).select("image_id", "item", "aspect", F.col("v.voter").alias("voter"), F.col("v.label").alias("label"))

    node, edge = F.col("fused_id").alias("item"), F.concat_ws(">", "source", "target").alias("item")
    shapes = pairs("fused_nodes", "shape_votes", node, F.lit("shape").alias("aspect")).filter("label not in ('', 'unknown')")
    texts = pairs("fused_nodes", "text_votes", node, F.lit("text").alias("aspect")).filter("label != ''")
    labels = pairs("fused_edges", "label_votes", edge, F.lit("label").alias("aspect"))
    written = texts.unionAll(labels).filter("voter is not null and label is not null")
    formed = lookalike.canonical(written, "label", lookalike.fit(written.select("label"))).filter("aspect = 'label' or canonical != ''")
    return shapes.unionAll(formed.select("image_id", "item", "aspect", "voter", F.col("canonical").alias("label")))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The true label of every node's shape and text and of every labelled edge."""
    found = crowd.consensus(*crowd.fit(_votes(spark, sf_dir))).filter("not (aspect = 'label' and label = '')")
    return found.select("image_id", "item", "aspect", "label")


def p2_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every item's label with posterior, difficulty and agreement."""
    return crowd.consensus(*crowd.fit(_votes(spark, sf_dir)))


def p2_voters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reliability of every voter, per aspect."""
    return crowd.voters(*crowd.fit(_votes(spark, sf_dir)))


def p7_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of the mixture, each with its number of copies."""
    return mixing.mixture(mixing.sizes(table(spark, sf_dir, "documents")), table(spark, sf_dir, "mix_targets"))


def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target shares and the shares reached."""
    return mixing.shares(p7_mixture(spark, sf_dir), table(spark, sf_dir, "mix_targets"))


QUERIES = {"p7_mixture": p7_mixture, "p7_shares": p7_shares, "p2_found": p2_found, "p2_consensus": p2_consensus, "p2_voters": p2_voters, "p5_found": p5_found, "p5_values": p5_values, "p3_found": p3_found, "p3_rates": p3_rates, "p3_limits": p3_limits, "p6_found": p6_found, "p6_passages": p6_passages, "p6_items": p6_items, "p8_found": p8_found, "p8_documents": p8_documents, "p8_segments": p8_segments}
SQL: dict[str, str] = {}
