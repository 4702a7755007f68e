"""Conflicts between two documents as issue rows, verdicts on them, and their outcome."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concordance.functions import text
from concordance.operators.dedup import first_rows
from concordance.operators.payloads import repaired

#: Kinds whose unmatched blocks are worth an issue (fixed values).
ADDABLE = ("chart", "table", "image")


def texts_conflict(a: Column, b: Column, containment: bool = True) -> Column:
    """Do two lists of texts differ? Empty lists don't, nor, unless forbidden, lists with a
    text that holds one of the other."""
    clean = lambda x: F.array_sort(F.array_distinct(F.filter(F.transform(x, text.squeezed), lambda t: t != "")))
    x, y = clean(a), clean(b)
    inside = F.exists(x, lambda p: F.exists(y, lambda q: p.contains(q) | q.contains(p))) if containment else F.lit(False)
    return (F.size(x) > 0) & (F.size(y) > 0) & (x != y) & ~inside


def detect(base: DataFrame, other: DataFrame, matches: DataFrame, key: list[str]) -> DataFrame:
    """Issues of two aligned documents: kind disagreement, missing text, text conflict, and
    blocks of the other side without a partner."""
    at = [*key, "page_idx"]
    a, b = (d.select(*at, F.col("pos").alias("pos_" + s), F.col("kind").alias("kind_" + s), F.col("text").alias("text_" + s)) for d, s in ((base, "a"), (other, "b")))
    paired = matches.select(*at, "pos_a", "pos_b").join(a, [*at, "pos_a"]).join(b, [*at, "pos_b"])
    ta, tb = F.array("text_a"), F.array("text_b")
    kind = F.when(F.col("kind_a") != F.col("kind_b"), "type_disagreement").when((text.squeezed(F.col("text_a")) == "") & (text.squeezed(F.col("text_b")) != ""), "missing_text").when(texts_conflict(ta, tb), "text_conflict")
    pairs = paired.select(*at, "pos_a", "pos_b", kind.alias("issue_type")).filter("issue_type is not null")
    alone = other.filter(F.col("kind").isin(*ADDABLE)).select(*at, F.col("pos").alias("pos_b")).join(matches.select(*at, "pos_b"), [*at, "pos_b"], "left_anti")
    every = pairs.unionByName(alone.select(*at, F.lit(None).cast("int").alias("pos_a"), "pos_b", F.lit("unmatched_candidate").alias("issue_type")))
    once = first_rows(every, [*at, "issue_type", "pos_a", "pos_b"], ["pos_b"])
    number = F.row_number().over(Window.partitionBy(*key).orderBy("page_idx", F.coalesce("pos_a", F.lit(1 << 30)), "pos_b", "issue_type"))
    return once.withColumn("issue_id", F.format_string("I%03d", number))


def verdict(x: Column) -> Column:
    """A judge's wording as one of keep_anchor, keep_candidate, use_reference, merge,
    add_block, reject_issue; anything else keeps the anchor."""
    clean = F.lower(F.trim(F.coalesce(x, F.lit(""))))
    return (
        F.when(clean.isin("merge", "reject_issue"), clean).when(clean.rlike("^keep_(candidate|fusion|graph_candidate)"), "keep_candidate")
        .when(clean.rlike("^(use|adopt)_"), "use_reference").when(clean.rlike("^add_"), "add_block").otherwise("keep_anchor")
    )


def verdicts(answers: DataFrame, record: str, raw: str) -> DataFrame:
    """(record_id, issue_id, decision, patch_text, reason) of the answers that judge an issue.

    An answer that isn't JSON has no row; a missing reason is 'patch_applied'.
    """
    get = lambda p: F.get_json_object(raw, p)
    rows = answers.filter(F.col(raw).startswith("{")).select(F.col(record).alias("record_id"), get("$.issue_id").alias("issue_id"), verdict(get("$.decision")).alias("decision"), get("$.patch.text").alias("patch_text"), F.coalesce(F.nullif(F.trim(get("$.reason")), F.lit("")), F.lit("patch_applied")).alias("reason"))
    return rows.filter("issue_id is not null")


_READ = "record_id bigint, issue_id string, decision string, patch_text string, reason string"


def read_verdicts(answers: DataFrame, record: str, raw: str) -> DataFrame:
    """``verdicts`` of all answers that name an issue, also fenced ones, ones after words, and
    ones cut short, which are closed where they were cut."""
    text_of = lambda v: v if isinstance(v, str) else None if v is None else json.dumps(v, ensure_ascii=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for rid, answer in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                value = repaired(answer)
                if isinstance(value, dict) and value.get("issue_id") is not None:
                    patch = value.get("patch") if isinstance(value.get("patch"), dict) else {}
                    out.append((rid, *(text_of(x) for x in (value["issue_id"], value.get("decision"), patch.get("text"), value.get("reason")))))
            columns = list(zip(*out)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), *[pa.string()] * 4))], [x.split()[0] for x in _READ.split(", ")])

    rows = answers.filter(F.col(raw).contains('"issue_id"')).select(F.col(record).cast("bigint"), F.col(raw).cast("string")).mapInArrow(run, _READ)
    return rows.select("record_id", "issue_id", verdict(F.col("decision")).alias("decision"), "patch_text", F.coalesce(F.nullif(F.trim("reason"), F.lit("")), F.lit("patch_applied")).alias("reason"))


def outcomes(issues: DataFrame, verdicts_: DataFrame, key: list[str]) -> DataFrame:
    """Issues with their last verdict; without one the anchor stays and the issue is open.

    Issues are numbered within a document, so a verdict belongs to the issue of its own
    document. ``verdicts_``: key..., record_id, issue_id, decision, patch_text, reason.
    """
    last = verdicts_.groupBy(*key, "issue_id").agg(F.max_by(F.struct("decision", "patch_text", "reason"), "record_id").alias("v"))
    joined = issues.join(last, [*key, "issue_id"], "left")
    return joined.select(*key, "issue_id", "issue_type", F.coalesce("v.decision", F.lit("keep_anchor")).alias("decision"), F.col("v.patch_text").alias("patch_text"), F.coalesce("v.reason", F.lit("no_verdict")).alias("reason"), F.col("v").isNull().alias("open"))


def overriding(default: Column, *modes: tuple[Column, Column]) -> Column:
    """A value with overrides in order, the last whose condition holds."""
    out = default
    for condition, value in modes:
        out = F.when(condition, value).otherwise(out)
    return out
