"""Scans: pictures, layout files, configuration, gold records, earlier outputs."""

from __future__ import annotations

import json
import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from concordance.functions import labels

#: Picture extensions (fixed values).
EXTENSIONS = ("png", "jpg", "jpeg", "webp", "bmp")
MIME = {"png": "image/png", "jpg": "image/jpeg", "jpeg": "image/jpeg", "webp": "image/webp", "bmp": "image/bmp"}


def images(spark: SparkSession, root: str, skip: str | None = None, limit: int | None = None, content: bool = False) -> DataFrame:
    """(image_id, image_path, file_name, file_ext, page_output_id, merge_order, ...) of all
    pictures below ``root``, by name; two of one stem are an error. Contents are read only
    if asked for; paths that begin with ``skip`` are left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    rows = files.select(F.col("path").alias("image_path"), *(["content"] if content else []))
    rows = rows.withColumn("file_name", F.regexp_extract("image_path", r"([^/]+)$", 1)).withColumn("file_ext", F.lower(F.regexp_extract("file_name", r"\.([^.]+)$", 1))).filter(F.col("file_ext").isin(*EXTENSIONS))
    if skip:
        rows = rows.filter(~F.regexp_replace("image_path", r"^file:/+", "/").startswith(skip))
    rows = rows.withColumn("image_id", labels.file_stem(F.col("image_path")))
    twice = rows.groupBy("image_id").agg(F.count("*").alias("n"))
    checked = rows.join(twice, "image_id").withColumn("image_id", F.when(F.col("n") > 1, F.raise_error(F.concat(F.lit("two pictures named "), "image_id")).cast("string")).otherwise(F.col("image_id"))).drop("n")
    out = checked.withColumn("_p", labels.crop_parts(F.col("image_id"))).select("*", "_p.*", F.col("_p.page_output_id").isNotNull().alias("is_page_crop")).drop("_p").orderBy("file_name", "image_path")
    return out.limit(limit) if limit else out


def data_url(content: Column, extension: Column) -> Column:
    """A picture as a data URL; an unknown extension is an error."""
    mime = labels.mapped(extension, MIME, "")
    return F.when(mime == "", F.raise_error(F.concat(F.lit("no media type for "), extension)).cast("string")).otherwise(F.concat(F.lit("data:"), mime, F.lit(";base64,"), F.base64(content)))


def layouts(spark: SparkSession, root: str) -> DataFrame:
    """(page, pattern, payload) of layout files: of '<page>.json', '<page>_layout.json' and
    '<page>/layout.json' the first that is there."""
    files = spark.read.option("wholetext", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").text(root).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("payload"))
    name = F.regexp_extract("path", r"([^/]+)\.json$", 1)
    pattern = F.when(name == "layout", 3).when(name.endswith("_layout"), 2).otherwise(1)
    page = F.when(name == "layout", F.regexp_extract("path", r"([^/]+)/layout\.json$", 1)).otherwise(F.regexp_replace(name, "_layout$", ""))
    rows = files.select(page.alias("page"), pattern.alias("pattern"), "payload")
    return rows.groupBy("page").agg(F.min_by(F.struct("pattern", "payload"), "pattern").alias("r")).select("page", "r.*")


def gold(spark: SparkSession, root: str, splits: tuple[str, ...] = ("train", "test")) -> DataFrame:
    """(id, mermaid, split) of gold files; of one id the later split counts."""
    parts = None
    for k, split in enumerate(splits):
        text = spark.read.option("wholetext", "true").text(f"{root}/{split}_full.json")
        part = text.select(F.explode(F.from_json("value", "map<string, struct<mermaid:string>>")).alias("id", "r")).select("id", "r.mermaid", F.lit(split).alias("split"), F.lit(k).alias("k"))
        parts = part if parts is None else parts.unionAll(part)
    return parts.groupBy("id").agg(F.max_by(F.struct("mermaid", "split"), "k").alias("r")).select("id", "r.*")


def config(path: str) -> list[dict]:
    """The ``models`` of a configuration file, YAML if that reader is there, else JSON."""
    text = Path(path).read_text()
    try:
        import yaml

        loaded = yaml.safe_load(text)
    except ImportError:
        loaded = json.loads(text)
    models = loaded.get("models") if isinstance(loaded, dict) else None
    if not isinstance(models, list) or not all(isinstance(m, dict) for m in models):
        raise ValueError(f"{path} has no list of models")
    return models


def earlier(spark: SparkSession, *folders: str) -> DataFrame:
    """(image_id, rank, payload) of JSON outputs by id: the first folder that has it."""
    parts = None
    for k, folder in enumerate(folders):
        rows = spark.read.option("wholetext", "true").option("pathGlobFilter", "*.json").text(folder).select(labels.file_stem(F.col("_metadata.file_path")).alias("image_id"), F.lit(k).alias("rank"), F.col("value").alias("payload"))
        parts = rows if parts is None else parts.unionAll(rows)
    return parts.groupBy("image_id").agg(F.min_by(F.struct("rank", "payload"), "rank").alias("r")).select("image_id", "r.*")


def prompt(path: str, name: str) -> str:
    """A named, non-empty prompt of a file of prompts: YAML, or 'name: text' and blocks after
    'name: |' where no reader of it is there."""
    text = Path(path).read_text()
    try:
        import yaml

        found = yaml.safe_load(text) or {}
    except ImportError:
        found, at = {}, ""
        for line in text.splitlines():
            head = re.match(r"(\w+):\s*(.*)", line)
            if head:
                at = head[1]
                found[at] = "" if head[2].rstrip() == "|" else head[2].strip().strip("'\"")
            elif at:
                found[at] += line.removeprefix("  ") + "\n"
    value = found.get(name)
    if not isinstance(value, str) or not value.strip():
        raise ValueError(f"{path} has no prompt named {name}")
    return value.strip()


def layout_source(spark: SparkSession, kind: str, root: str | None = None, fetch=None) -> DataFrame:
    """Layouts by the configured source: 'json' reads files below ``root``, 'service' calls
    ``fetch``; a source without its argument, or an unknown one, is an error."""
    if kind == "json" and root:
        return layouts(spark, root)
    if kind == "service" and fetch:
        return fetch()
    raise ValueError(f"layout source {kind!r} needs {'root' if kind == 'json' else 'fetch' if kind == 'service' else 'to be json or service'}")


def first_picture(candidates: DataFrame, pictures: DataFrame) -> DataFrame:
    """(key, image_path, url): of each key's candidate paths the first that exists, as a data URL.

    ``candidates``: key, rank, image_path; ``pictures``: image_path, file_ext, content.
    """
    there = candidates.join(pictures.select("image_path"), "image_path", "left_semi")
    first = there.groupBy("key").agg(F.min_by("image_path", "rank").alias("image_path"))
    return first.join(pictures, "image_path").select("key", "image_path", data_url(F.col("content"), F.col("file_ext")).alias("url"))
