"""Records of an image put together: candidates, references, defaults, Markdown of a page."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concordance.functions import predicates
from concordance.operators.matching import consume
from concordance.operators.ordering import numbered

#: Roles of the sources in the order of trust (fixed values).
ROLES = ("anchor-pro", "aux-layout", "aux-vision", "judge-xl")
VISUAL = ("image", "chart", "table")


def reference_texts(readings: DataFrame, key: list[str], source: str, value: str, order: str, most: int, in_all: int) -> DataFrame:
    """The first distinct values of every source, ``most`` each, then the first distinct of
    all, ``in_all`` at most, with their place.

    First occurrences are aggregated, so copies never meet; the windows hold distinct values.
    """
    once = readings.groupBy(*key, source, value).agg(F.min(order).alias(order))
    few = once.withColumn("_n", F.row_number().over(Window.partitionBy(*key, source).orderBy(order))).filter(F.col("_n") <= most)
    first = few.groupBy(*key, value).agg(F.min(F.struct(F.col(order), F.col(source))).alias("f")).select(*key, value, f"f.{order}", f"f.{source}")
    return first.withColumn("place", F.row_number().over(Window.partitionBy(*key).orderBy(order))).filter(F.col("place") <= in_all)


def seal_candidates(readings: DataFrame) -> DataFrame:
    """Per image and model the regions, the distinct texts in order, and their signature.

    ``readings``: image_id, model_name, region_id, text, key (the comparable form).
    """
    once = readings.groupBy("image_id", "model_name", "key").agg(F.count("*").alias("regions"), F.min(F.struct("region_id", "text")).alias("f"))
    listed = F.array_sort(F.collect_list(F.struct("f.region_id", "key", "f.text")))
    g = once.groupBy("image_id", "model_name").agg(F.sum("regions").alias("regions"), F.count("*").alias("texts"), listed.alias("l"))
    return g.select("image_id", "model_name", "regions", "texts", F.array_join(F.transform("l", lambda x: x["key"]), "|").alias("signature"), F.array_join(F.transform("l", lambda x: x["text"]), "; ").alias("full_text"))


def bundles(outputs: DataFrame, key: list[str], role: str, order: str) -> DataFrame:
    """For every key and role of ROLES the last row; a role without one is ``skipped``.

    ``outputs``: key..., role, order, success, latency_ms.
    """
    last = outputs.groupBy(*key, role).agg(F.max(F.struct(order, "success", "latency_ms")).alias("o"))
    wanted = outputs.select(*key).distinct().withColumn(role, F.explode(F.array(*map(F.lit, ROLES))))
    return wanted.join(last, [*key, role], "left").select(*key, role, f"o.{order}", F.coalesce("o.success", F.lit(False)).alias("success"), "o.latency_ms", F.col("o").isNull().alias("skipped"))


def payload_source(parsed: Column, raw: Column) -> Column:
    """'parsed', else 'raw_text' where that begins as JSON, fenced or not, else 'none'."""
    return F.when(parsed.isNotNull(), "parsed").when(F.coalesce(raw.rlike(r"^\s*(```(json)?\s*)?[{\[]"), F.lit(False)), "raw_text").otherwise("none")


def special_kind(kind: Column, sub_type: Column, content: Column, roles: Column) -> Column:
    """'diagram', 'seal' or 'table' for blocks that Markdown shows in their own way, else null."""
    sub = F.coalesce(F.lower(F.trim(sub_type)), F.lit(""))
    return F.when(sub == "flowchart", "diagram").when(predicates.seal_block(kind, sub_type, roles), "seal").when(kind.isin("table", "chart"), "table")


def filled(blocks: DataFrame, kind: str, sub_type: str, content: str, angle: str) -> DataFrame:
    """Blocks with the written type and the fields of their type; what is missing is ''.

    Flow diagrams are written as charts, paragraphs as text; pictures have a path and a
    caption list, tables a body; angles are whole numbers, 0 if there is none.
    """
    k, t = F.col(kind), F.trim(F.coalesce(content, F.lit("")))
    sub = F.coalesce(F.lower(F.trim(sub_type)), F.lit(""))
    return blocks.select(
        "*", F.when(sub == "flowchart", "chart").when(k == "paragraph", "text").otherwise(k).alias("out_type"), F.when(k == "table", "").otherwise(t).alias("text"), F.when(k.isin(*VISUAL), "").alias("img_path"),
        F.when(k == "table", t).alias("table_body"), F.when((k == "image") & (t != ""), F.array(t)).otherwise(F.array().cast("array<string>")).alias("caption"), F.coalesce(F.rint(angle), F.lit(0)).cast("int").alias("out_angle"),
    )


def any_sign(*signs: DataFrame) -> DataFrame:
    """The distinct images of any of the given one-column tables."""
    return reduce(DataFrame.unionAll, signs).filter("image_id is not null").distinct()


def range_similarity(least: Column, most: Column) -> Column:
    """1 - distance over the larger; both 0 gives 1."""
    return F.when(most == 0, 1.0).otherwise(1 - (most - least) / most)


def fragment(kind: str, text: str, special: str | None) -> str:
    """Markdown of one block."""
    text = (text or "").strip()
    if special == "diagram" and text:
        return f"```mermaid\n{text}\n```"
    if kind == "title" and text:
        return f"# {text}"
    return text


def final_markdown(blocks: DataFrame, page: str, order: str, row: str) -> DataFrame:
    """(page, part, fragments, markdown): blocks in order, each special one replaced by the
    later block of its page that matches it by kind and place, a replacement used once.

    ``blocks``: page, order, row, kind, text, box, special. Later rows of one place are
    revisions of the first. Pages are cut into parts of PART blocks by order, so a page with
    a tenth of all rows is many groups; matching blocks share their order and so their part.
    """
    first = Window.partitionBy(page, order).orderBy(row)
    ranked = blocks.withColumn("_k", F.row_number().over(first))
    part = (F.col(order) / PART).cast("bigint")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([order, "_k"])
        base, later = pdf[pdf["_k"] == 1], pdf[(pdf["_k"] > 1) & pdf["special"].notna()].reset_index(drop=True)
        record = lambda r: {"id": None, "kind": r["special"], "order": r[order], "box": tuple(r["box"]) if r["box"] is not None else None, "path": None}
        anchors = base[base["special"].notna()]
        taken = dict(zip(anchors.index, consume([record(r) for r in anchors.to_dict("records")], [record(r) for r in later.to_dict("records")])))
        out = []
        for k, r in zip(base.index, base.to_dict("records")):
            hit = taken.get(k)
            r = later.iloc[hit] if hit is not None else r
            out.append(fragment(r["kind"], r["text"], r["special"] if isinstance(r["special"], str) else None))
        kept = [f for f in out if f]
        return pd.DataFrame({"page": [pdf[page].iloc[0]], "part": [int(pdf["_part"].iloc[0])], "fragments": [len(kept)], "markdown": ["\n\n".join(kept)]})

    return ranked.withColumn("_part", part).groupBy(page, "_part").applyInPandas(run, "page string, part bigint, fragments int, markdown string")


#: Blocks of a part of a page.
PART = 2000


def in_order(rows: DataFrame, key: list[str], *order: str) -> DataFrame:
    """Rows with their place in the canonical order of a document, in groups of any size."""
    return numbered(rows, key, list(order), "place")
