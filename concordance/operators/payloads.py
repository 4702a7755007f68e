"""Heterogeneous JSON answers into one ordered block model.

Answers come wrapped, as nested pages, flat lists, page results or layout lists, some held
in strings, fenced, or cut short. ``blocks`` gives one row per block with page and order.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordance.functions.labels import BLOCK_TYPES

#: Keys under which an answer is wrapped, in the order of trial (fixed values).
WRAPPERS = ("parsed", "data", "result", "payload", "output", "response")
#: Texts of a block beside its body: before and after (fixed values).
CAPTIONS, FOOTNOTES = ("captions", "image_caption", "table_caption", "chart_caption"), ("footnotes", "image_footnote", "table_footnote", "chart_footnote")


def repaired(text: str | None) -> object:
    """The JSON value in a text, or None.

    Fences and words before it are passed over; a value that was cut within a string is closed
    there, one that is damaged elsewhere after the last complete member before the damage.
    """
    if not text:
        return None
    try:
        return json.loads(text)
    except (ValueError, RecursionError):
        pass
    if m := re.search(r"```(?:json)?\s*\n?(.*?)(?:```|\Z)", text, re.S):
        text = m[1]
    starts = [k for k in (text.find("{"), text.find("[")) if k >= 0]
    if not starts:
        return None
    text = text[min(starts) :]
    try:
        return json.JSONDecoder().raw_decode(text)[0]
    except json.JSONDecodeError as error:
        # whatever is closed after the damage holds it
        end = error.pos
    except (ValueError, RecursionError):
        end = len(text)
    closing: tuple | None = None  # the brackets to close, innermost first
    cuts: list[tuple[int, tuple | None]] = []
    quoted = escaped = False
    for k, c in enumerate(text):
        if quoted:
            quoted, escaped = escaped or c != '"', c == "\\" and not escaped
            continue
        if c == '"':
            quoted, escaped = True, False
        elif c in "{[":
            closing = ("}" if c == "{" else "]", closing)
            cuts.append((k + 1, closing))
        elif c in "}]" and closing:
            closing = closing[1]
            cuts.append((k + 1, closing))
        elif c == ",":
            cuts.append((k, closing))
    if quoted:
        # cut within a string: what is there of it is kept
        tail = text[:-1] if escaped else re.sub(r"\\u[0-9a-fA-F]{0,3}\Z", "", text)
        try:
            return json.loads(tail + '"' + _closers(closing))
        except (ValueError, RecursionError):
            pass
    for at, closing in reversed(cuts):
        if at > end:
            continue
        try:
            return json.loads(text[:at] + _closers(closing))
        except (ValueError, RecursionError):
            continue
    return None


def _closers(closing: tuple | None) -> str:
    close = []
    while closing:
        close.append(closing[0])
        closing = closing[1]
    return "".join(close)


def _list(value: object) -> list:
    value = repaired(value) if isinstance(value, str) else value
    return value if isinstance(value, list) else [value] if isinstance(value, dict) else []


def pages_of(value: object) -> list[tuple[int, list]]:
    """(page, blocks) of an unwrapped or wrapped answer; of repeated pages the last counts."""
    while True:
        if isinstance(value, list):
            if value and all(isinstance(v, dict) and "json_res" in v for v in value):
                return _page_results(value)
            if value and all(isinstance(v, list) for v in value):
                return list(enumerate(value))
            flat: dict[int, list] = {}
            for v in value:
                if isinstance(v, dict):
                    page = v.get("page_idx")
                    flat.setdefault(page if isinstance(page, int) else 0, []).append(v)
            return sorted(flat.items())
        if not isinstance(value, dict):
            return []
        for key in ("extraction_result", "extraction_results"):
            if value.get(key) is not None:
                break
        else:
            key = ""
        if key:
            value = value[key]
            if isinstance(value, list):
                return _page_results(value)
        elif "json_res" in value:
            value = _list(value["json_res"])
        elif "content_list_v2" in value:
            value = value["content_list_v2"]
        elif "content_list" in value:
            value = value["content_list"]
        elif isinstance(value.get("pdf_info"), list):
            pages = [p for p in value["pdf_info"] if isinstance(p, dict)]
            return [(p.get("page_idx") if isinstance(p.get("page_idx"), int) else k, _list(p.get("para_blocks"))) for k, p in enumerate(pages)]
        elif "parsing_res_list" in value:
            listed = [b for b in _list(value["parsing_res_list"]) if isinstance(b, dict)]
            order = sorted(range(len(listed)), key=lambda k: (listed[k].get("block_order") is None, listed[k].get("block_order") or 0, k))
            names = (("block_label", "type"), ("block_content", "text"), ("block_bbox", "bbox"))
            return [(0, [{**listed[k], **{n: listed[k].get(o) for o, n in names if o in listed[k]}} for k in order])]
        elif "blocks" in value:
            value = value["blocks"]
        else:
            value = next((value[k] for k in WRAPPERS if isinstance(value.get(k), (dict, list))), None)


def _page_results(results: list) -> list[tuple[int, list]]:
    """Page results with 1-based pages shifted; the last of equal pages counts."""
    kept = [r for r in results if isinstance(r, dict)]
    numbers = [r.get("page") if isinstance(r.get("page"), int) else k for k, r in enumerate(kept)]
    shift = 1 if numbers and min(numbers) == 1 else 0
    pages = {n - shift: _list(r.get("json_res")) for n, r in zip(numbers, kept)}
    return sorted(pages.items())


def _texts(value: object) -> list[str]:
    """All texts under a value, in order."""
    if isinstance(value, str):
        return [value.strip()] if value.strip() else []
    if isinstance(value, list):
        return [t for v in value for t in _texts(v)]
    if isinstance(value, dict):
        return [t for k in ("text", "content", "spans", "lines") for t in _texts(value.get(k))]
    return []


def block_text(block: dict) -> str:
    """Captions, body and footnotes, joined by spaces."""
    parts = [t for k in CAPTIONS for t in _texts(block.get(k))]
    for k in ("text", "content", "lines", "table_body", "code_body", "list_items"):
        if own := _texts(block.get(k)):
            parts += own
            break
    return " ".join(parts + [t for k in FOOTNOTES for t in _texts(block.get(k))])


def _per_mille(box: object) -> list[int] | None:
    if not isinstance(box, list) or len(box) != 4 or any(isinstance(v, bool) or not isinstance(v, (int, float)) for v in box):
        return None
    scale = 1000 if all(0 <= v <= 1 for v in box) else 1
    return [max(0, min(1000, round(v * scale))) for v in box]


BLOCKS = "record_id bigint, page_idx int, order_index int, block_id string, kind string, sub_type string, box array<int>, text string, text_level int, score double"


def blocks(df: DataFrame, record: str, payload: str) -> DataFrame:
    """The ordered blocks of every answer; answers without any have no rows.

    The page of a block counts from 0, its order from 1 within the page; unknown types are
    paragraphs; boxes are per mille; a block without an id is named by page and order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.string(), pa.int32(), pa.float64())
        for batch in batches:
            rows = []
            for rid, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for page, listed in pages_of(repaired(text)):
                    for order, b in enumerate((b for b in listed if isinstance(b, dict)), 1):
                        level, score = b.get("text_level"), b.get("score")
                        kind = BLOCK_TYPES.get(str(b.get("type") or "").strip().lower(), "paragraph")
                        rows.append((rid, page, order, str(b.get("block_id") or f"p{page}_b{order}"), kind, b.get("sub_type") if isinstance(b.get("sub_type"), str) else None, _per_mille(b.get("bbox")), block_text(b), level if type(level) is int else None, float(score) if isinstance(score, (int, float)) else None))
            columns = list(zip(*rows)) if rows else [[]] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [x.split()[0] for x in BLOCKS.split(", ")])

    narrow = df.select(F.col(record).cast("bigint").alias("record_id"), F.col(payload).cast("string").alias("payload")).filter("payload is not null")
    return narrow.mapInArrow(run, BLOCKS)


def label_type(kinds: Column) -> Column:
    """Summary type of a document from its blocks' kinds, the first that occurs."""
    column = F.lit("document")
    for kind in ("seal", "chart", "table", "flowchart"):
        column = F.when(F.array_contains(kinds, kind), kind).otherwise(column)
    return column
