"""Enumerations, ids and coercions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Raw block types and their canonical type (fixed values).
BLOCK_TYPES = {
    "text": "paragraph",
    "paragraph": "paragraph",
    "title": "title",
    "image": "image",
    "table": "table",
    "chart": "chart",
    "equation_interline": "equation_interline",
    "equation": "equation_interline",
    "code": "code",
    "algorithm": "algorithm",
    "list": "list",
    "header": "page_header",
    "page_header": "page_header",
    "footer": "page_footer",
    "page_footer": "page_footer",
    "page_number": "page_number",
    "aside_text": "page_aside_text",
    "page_aside_text": "page_aside_text",
    "page_footnote": "page_footnote",
}
VISUAL, TEXTUAL = ("image", "chart", "table"), ("paragraph", "title", "list", "page_header", "page_footer")
#: Wordings of the roles of recognised texts (fixed values).
OCR_ROLES = {
    "seal": ("seal", "stamp", "印章", "公章"),
    "watermark": ("watermark", "水印"),
    "footer": ("footer", "页脚", "底部文字"),
    "body": ("body", "正文"),
    "title": ("title", "标题"),
}
#: Wordings of confidence beside the words themselves (fixed values).
CONFIDENCE = {"very_high": "high", "strong": "high", "sure": "high", "mid": "medium", "moderate": "medium", "weak": "low"}
#: Kinds of images, their names and the parts of names that tell them, in order (fixed values).
IMAGE_TYPES = ("flowchart", "chart", "table", "seal", "document", "screenshot", "diagram", "natural_image", "mixed", "unknown")
IMAGE_NAMES = {"流程图": "flowchart", "图表": "chart", "表格": "table", "印章": "seal", "公章": "seal", "文档": "document", "截图": "screenshot", "示意图": "diagram", "自然图像": "natural_image", "混合": "mixed", "未知": "unknown"}
IMAGE_PARTS = {
    "flowchart": "flow|流程", "chart": "chart|plot|graph|图表", "table": "table|表格", "seal": "seal|stamp|印章|公章", "screenshot": "screen|截图",
    "document": "doc|文档", "diagram": "diagram|示意", "natural_image": "natural|photo|scene|自然", "mixed": "mixed|混合",
}
NODE_SHAPES = ("rectangle", "rounded", "diamond", "ellipse")


def mapped(x: Column, table: dict[str, str], otherwise: str | None) -> Column:
    """A look-up in a literal map."""
    pairs = F.create_map(*(F.lit(v) for kv in table.items() for v in kv))
    return F.coalesce(F.try_element_at(pairs, F.lower(F.trim(x))), F.lit(otherwise))


def block_type(x: Column) -> Column:
    """Canonical block type; unknown ones are paragraphs."""
    return mapped(x, BLOCK_TYPES, "paragraph")


def type_compatibility(a: Column, b: Column) -> Column:
    """Equal 1, both visual 0.75, both textual 0.65, else 0."""
    return F.when(a == b, 1.0).when(a.isin(*VISUAL) & b.isin(*VISUAL), 0.75).when(a.isin(*TEXTUAL) & b.isin(*TEXTUAL), 0.65).otherwise(0.0)


def ocr_role(x: Column) -> Column:
    """The role of a recognised text from its wording; others are 'other'."""
    return mapped(x, {word: role for role, words in OCR_ROLES.items() for word in words}, "other")


def node_shape(x: Column) -> Column:
    clean = F.lower(F.trim(x))
    return F.when(clean.isin(*NODE_SHAPES), clean).otherwise("unknown")


def confidence(x: Column) -> Column:
    """low / medium / high from a word or a number (0.85 high, 0.5 medium)."""
    clean = F.lower(F.trim(x))
    number = clean.try_cast("double")
    word = mapped(x, {**CONFIDENCE, "low": "low", "medium": "medium", "high": "high"}, None)
    return F.coalesce(word, F.when(number >= 0.85, "high").when(number >= 0.5, "medium").when(number.isNotNull(), "low"), F.lit("medium"))


def image_type(x: Column, otherwise: Column | None = None) -> Column:
    """Kind of an image from free wording: a kind, a known name, else the first part of a
    name that occurs; no wording and none known give ``otherwise`` ('unknown')."""
    clean = F.lower(F.trim(F.coalesce(x, F.lit(""))))
    column = F.when(clean.isin(*IMAGE_TYPES), clean).when(clean.isin(*IMAGE_NAMES), mapped(x, IMAGE_NAMES, "unknown"))
    for kind, parts in IMAGE_PARTS.items():
        column = column.when(clean.rlike(parts), kind)
    return column.otherwise(F.lit("unknown") if otherwise is None else otherwise)


def node_id(raw: Column, position: Column) -> Column:
    """N and the first digits on three places, the position if there are none."""
    digits = F.regexp_extract(F.coalesce(raw, F.lit("")), r"(\d+)", 1)
    return F.format_string("N%03d", F.coalesce(digits.try_cast("int"), position.cast("int")))


def node_index(ident: Column) -> Column:
    """The number in a node's id, null without digits."""
    return F.regexp_extract(ident, r"(\d+)", 1).try_cast("int")


def crop_parts(image_id: Column) -> Column:
    """struct<page_output_id, merge_order> from 'name_p#_r#_rest' or 'a_b_<digits>_rest'."""
    first = r"^(.*_p_?\d+)_r_?(\d+)_.+$"
    pieces = F.split(image_id, "_", 4)
    plain = (F.size(pieces) >= 4) & F.try_element_at(pieces, F.lit(3)).rlike(r"^\d+$")
    page = F.when(image_id.rlike(first), F.regexp_extract(image_id, first, 1)).when(plain, F.concat_ws("_", pieces[0], pieces[1]))
    order = F.when(image_id.rlike(first), F.regexp_extract(image_id, first, 2)).when(plain, pieces[2])
    return F.struct(page.alias("page_output_id"), order.alias("merge_order"))


def file_stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1)


def positive_int(x: Column) -> Column:
    n = x.try_cast("int")
    return F.when(n > 0, n)


def default_source_type(provider: Column) -> Column:
    return F.when(provider.endswith("_local"), "local_service").otherwise("remote_service")
