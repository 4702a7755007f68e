"""Labels of several models for one image: normal form, agreement, overall score."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from concordance.functions import seals, text
from concordance.operators import comparison, graphs, voting
from concordance.operators.payloads import repaired

#: Types, kinds and the format of each kind (fixed values).
IMAGE_TYPES = ("flowchart", "chart", "table", "seal", "document", "screenshot", "diagram", "natural_image", "mixed", "unknown")
KINDS = {"none": "none", "mermaid": "mermaid", "table": "markdown", "text": "plain_text"}

LABELS = "record_id bigint, image_type string, caption string, visible_text array<string>, kind string, content string, format string, seal_text string, uncertainty string, warnings array<string>"


def _strings(value: object) -> list[str]:
    if isinstance(value, str):
        value = [value]
    return [s for v in value if (s := str(v).strip())] if isinstance(value, list) else []


def label_of(value: object) -> dict | None:
    """A label in normal form, with a warning for each correction; None if it is no label."""
    if not isinstance(value, dict) or not {"image_type", "caption", "visible_text", "structured_label"} & set(value):
        return None
    warnings = _strings(value.get("warnings"))

    def checked(name: str, raw: object, valid: object, otherwise: str) -> str:
        clean = str(raw or "").strip().lower()
        if clean in valid:
            return clean
        warnings.append(f"{name} normalized from '{clean or 'missing'}' to '{otherwise}'")
        return otherwise

    kind_image = checked("image_type", value.get("image_type"), IMAGE_TYPES, "unknown")
    inner = value.get("structured_label") if isinstance(value.get("structured_label"), dict) else {}
    kind = checked("structured_label.kind", inner.get("kind") or "none", KINDS, "text")
    caption = str(value.get("caption") or "").strip()
    brief = value["caption_structured"].get("brief") if isinstance(value.get("caption_structured"), dict) else None
    if not caption and brief:
        caption = str(brief).strip()
        warnings.append("caption filled from caption_structured.brief")
    regions = [r for r in value.get("ocr_regions") or [] if isinstance(r, dict)] if isinstance(value.get("ocr_regions"), list) else []
    seal = next((str(r.get("text")).strip() for r in regions if r.get("role") == "seal" and r.get("text")), "")
    return {"image_type": kind_image, "caption": caption, "visible_text": _strings(value.get("visible_text")), "kind": kind, "content": str(inner.get("content") or "").strip(), "format": KINDS[kind], "seal_text": seal, "uncertainty": str(value.get("uncertainty") or "").strip(), "warnings": warnings}


def label_rows(df: DataFrame, record: str, raw: str) -> DataFrame:
    """The labels found in raw answers, bare, fenced or cut; other answers have no row."""
    names = [x.split()[0] for x in LABELS.split(", ")]
    types = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.string()), *[pa.string()] * 5, pa.list_(pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(r, label) for r, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if t and "{" in t and (label := label_of(repaired(t)))]
            columns = [[r for r, _ in found], *([label[n] for _, label in found] for n in names[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return df.select(F.col(record).cast("bigint"), F.col(raw).cast("string")).mapInArrow(run, LABELS)


def structure_score(kinds: list[str], contents: list[str]) -> float:
    """Agreement of structured contents under the commonest kind (fixed weights)."""
    if not kinds:
        return 0.0
    major, count = Counter(kinds).most_common(1)[0]
    share = count / len(kinds)
    own = [c.strip() for k, c in zip(kinds, contents) if k == major]
    if major == "none":
        return 0.95 if share == 1 else min(1.0, 0.65 + 0.35 * share)
    empty = 0.6 if not all(own) else 1.0
    pairs = list(combinations(own, 2))
    mean = lambda f: sum(f(a, b) for a, b in pairs) / len(pairs) if pairs else 0.5
    if major == "mermaid":
        drawn = {c: graphs.parse_diagram(c) for c in own}
        if len(own) == 1:
            return 0.4 + 0.1 * bool(drawn[own[0]][1])
        same = {(a, b): comparison.compare_graphs(*drawn[a][1:], *drawn[b][1:]) for a, b in pairs}
        structure = mean(lambda a, b: same[a, b]["structure"])

        def whole(a: str, b: str) -> float:
            s = same[a, b]
            render = comparison.render_score(drawn[a][0], drawn[b][0], len(drawn[a][1]), len(drawn[b][1]))
            ast = comparison.ast_score(*drawn[a][1:], *drawn[b][1:])
            return comparison.diagram_score(s["structure"], comparison.text_score(a, b), ast, s["paths"], s["edge_f1"], s["node_f1"], render, bool(drawn[a][1] and drawn[b][1]))

        return min(1.0, 0.15 * share + 0.25 * mean(whole) + 0.60 * structure) * empty
    words = lambda c: set("".join(x if x.isalnum() else " " for x in c.lower()).split())
    overlap = lambda a, b: len(words(a) & words(b)) / len(words(a) | words(b)) if words(a) and words(b) else 0.0
    if major == "table":
        size = lambda c: ((rows := [r for r in c.splitlines() if r.strip()]) and (len(rows), max(r.count("|") for r in rows))) or (0, 0)
        ratio = lambda x, y: 1.0 if x == y else min(x, y) / max(x, y)
        shape = mean(lambda a, b: sum(ratio(x, y) for x, y in zip(size(a), size(b))) / 2)
        return (0.5 * share + 0.25 * shape + 0.25 * mean(overlap)) * empty
    return (0.6 * share + 0.4 * mean(lambda a, b: comparison.text_score(a, b) if a and b else 0.0)) * empty


@F.pandas_udf(DoubleType())
def structure_agreement(kinds: pd.Series, contents: pd.Series) -> pd.Series:
    return pd.Series([structure_score(list(k), list(c)) for k, c in zip(kinds, contents)])


def consensus(labels: DataFrame) -> DataFrame:
    """Agreement scores per image. ``labels``: image_id, model_name and the label's columns.

    One label per model counts, so an image's group is as small as the number of models.
    """
    one = labels.groupBy("image_id", "model_name").agg(F.max_by(F.struct("image_type", "caption", "visible_text", "kind", "content", "seal_text"), "record_id").alias("l"))
    g = one.groupBy("image_id").agg(F.array_sort(F.collect_list(F.struct("model_name", "l"))).alias("a")).select("image_id", F.transform("a", lambda x: x["l"]).alias("a"))
    types, captions = F.transform("a", lambda x: x["image_type"]), F.transform("a", lambda x: x["caption"])
    stamped = F.transform("a", lambda x: seals.primary(x["seal_text"]))
    scored = g.select(
        "image_id", F.size("a").alias("labels"), voting.majority(types).alias("majority_type"), voting.majority_ratio(types).alias("type_agreement"),
        (0.5 * voting.average_pairwise(captions, text.field_similarity) + 0.5 * voting.average_pairwise(F.transform("a", lambda x: x["visible_text"]), text.list_overlap)).alias("caption_agreement"),
        structure_agreement(F.transform("a", lambda x: x["kind"]), F.transform("a", lambda x: x["content"])).alias("structure_agreement"),
        voting.average_pairwise(stamped, text.field_equality).alias("seal_agreement"), seals.stamp_only(types, stamped).alias("stamp_only"),
    )
    c = F.col
    overall = F.when(c("stamp_only"), 0.3 * c("type_agreement") + 0.7 * c("seal_agreement")).otherwise(0.3 * c("type_agreement") + 0.3 * c("caption_agreement") + 0.4 * c("structure_agreement"))
    return scored.withColumn("overall_score", F.round(text.clamp(overall), 4))
