"""Outputs: per-stage tables, Markdown per page, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_stage(df: DataFrame, root: str, stage: str, *partitions: str) -> None:
    """JSON lines of one stage, replaced as a whole."""
    out = df.write.mode("overwrite").option("ignoreNullFields", "true")
    (out.partitionBy(*partitions) if partitions else out).json(f"{root}/{stage}")


def markdown_fragment(kind: Column, text: Column, level: Column, items: Column) -> Column:
    """Markdown of a block: heading, list, code, formula or plain text."""
    heading = F.concat(F.repeat(F.lit("#"), F.greatest(F.lit(1), F.least(F.lit(6), F.coalesce(level, F.lit(1))))), F.lit(" "), text)
    listed = F.when(F.size(items) > 0, F.array_join(F.transform(items, lambda x: F.concat(F.lit("- "), x)), "\n")).otherwise(F.concat(F.lit("- "), text))
    return (
        F.when(F.coalesce(F.trim(text), F.lit("")) == "", F.lit("")).when(kind == "title", heading).when(kind == "list", listed)
        .when(kind.isin("code", "algorithm"), F.concat(F.lit("```\n"), text, F.lit("\n```"))).when(kind == "equation_interline", F.concat(F.lit("$$\n"), text, F.lit("\n$$"))).otherwise(text)
    )


def page_markdown(blocks: DataFrame, key: list[str]) -> DataFrame:
    """(key..., page_idx, markdown): the fragments of each page in order."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("order_index", "block_id", "fragment"))), lambda x: x["fragment"])
    return blocks.filter("fragment != ''").groupBy(*key, "page_idx").agg(F.array_join(parts, "\n\n").alias("markdown"))


def merged_pages(crops: DataFrame, *key: str) -> DataFrame:
    """(key..., page_output_id, markdown): the crops of a page by number, then by name."""
    order = F.struct(F.col("merge_order").try_cast("bigint").isNull().alias("a"), F.col("merge_order").try_cast("bigint").alias("b"), F.col("merge_order").alias("c"), F.col("image_id").alias("d"), F.trim("markdown").alias("m"))
    parts = F.transform(F.array_sort(F.collect_list(order)), lambda x: x["m"])
    return crops.filter("page_output_id is not null and trim(markdown) != ''").groupBy(*key, "page_output_id").agg(F.array_join(parts, "\n\n").alias("markdown"), F.count("*").alias("crops"))


def extraction_results(blocks: DataFrame, key: list[str]) -> DataFrame:
    """(key..., total_pages, extraction_results): every page up to the last, empty ones too."""
    item = F.struct("order_index", "block_id", "kind", "text", "box")
    pages = blocks.groupBy(*key, "page_idx").agg(F.array_sort(F.collect_list(item)).alias("items"))
    doc = pages.groupBy(*key).agg((F.max("page_idx") + 1).alias("total_pages"), F.map_from_entries(F.collect_list(F.struct("page_idx", "items"))).alias("by_page"))
    empty = F.array().cast("array<struct<order_index:int,block_id:string,kind:string,text:string,box:array<int>>>")
    listed = F.transform(F.sequence(F.lit(0), F.col("total_pages") - 1), lambda p: F.struct(p.alias("page"), F.coalesce(F.try_element_at("by_page", p), empty).alias("json_res")))
    return doc.select(*key, "total_pages", F.to_json(listed).alias("extraction_results"))


def summary(outputs: DataFrame) -> DataFrame:
    """One row per image: answers, successes, sorted models, latency and the first error."""
    first = F.min_by("error", F.when(F.col("error").isNotNull(), F.col("output_id")))
    return outputs.groupBy("image_id").agg(F.count("*").alias("answers"), F.count_if("success").alias("successes"), F.array_join(F.sort_array(F.collect_set("model_name")), ",").alias("models"), F.coalesce(F.sum("latency_ms"), F.lit(0)).alias("latency_ms"), first.alias("first_error"))
