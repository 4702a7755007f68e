"""Conditions on blocks, labels and texts, as boolean columns; a missing value is false."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from concordance.functions import text
from concordance.functions.labels import VISUAL


def _yes(x: Column) -> Column:
    return F.coalesce(x, F.lit(False))


def looks_like_diagram(x: Column) -> Column:
    """A flow diagram's head or an arrow between names; the parser has the last word."""
    return _yes(x.rlike(r"(?im)^\s*(?:flowchart|graph)\s+(?:TD|TB|LR|RL|BT)\b|[\w\])}]\s*(?:-->|-\.->|==>)"))


def looks_like_table(x: Column) -> Column:
    """A Markdown table from the first line that isn't blank."""
    lines = F.filter(F.split(F.coalesce(x, F.lit("")), r"\r?\n", -1), lambda v: F.trim(v) != "")
    return _yes(text.let(lines, lambda v: F.get(v, F.lit(0)).contains("|") & text.is_separator(F.get(v, F.lit(1)))))


def flowchart_block(kind: Column, sub_type: Column, content: Column, any_kind: bool = False) -> Column:
    """A picture or chart that is marked as a flowchart or holds a diagram."""
    marked = _yes(F.lower(F.trim(sub_type)) == "flowchart") | looks_like_diagram(content)
    return marked if any_kind else _yes(kind.isin("chart", "image")) & marked


def seal_block(kind: Column, sub_type: Column, roles: Column, any_kind: bool = False) -> Column:
    """A picture that is marked as a seal or has a region read as one."""
    marked = _yes(F.lower(F.trim(sub_type)) == "seal") | _yes(F.exists(roles, lambda r: r == "seal"))
    return marked if any_kind else _yes(kind == "image") & marked


def table_block(kind: Column, content: Column) -> Column:
    return _yes(kind == "table") | looks_like_table(content)


def chart_with_table(kind: Column, sub_type: Column, content: Column) -> Column:
    """A chart that isn't a flowchart and whose content is a table."""
    return _yes(kind == "chart") & ~flowchart_block(kind, sub_type, content) & looks_like_table(content)


def flowchart_path(*parts: Column) -> Column:
    """Does a path or name say flowchart?"""
    whole = F.lower(F.concat_ws("/", *parts))
    return whole.contains("flowchart") | whole.contains("流程图")


def worth_adding(kind: Column, sub_type: Column) -> Column:
    """Kinds of unmatched blocks that a document takes over."""
    return _yes(kind.isin("chart", "table")) | (_yes(kind == "image") & _yes(F.lower(F.trim(sub_type)) == "seal"))


def auxiliary_node(ident: Column, label: Column) -> Column:
    """Nodes that only join or split lines, or that say nothing."""
    names = r"(?i)^(?:split|merge|junction|join|branch|router|connector|hub)\d*$"
    plain = F.trim(F.coalesce(label, F.lit("")))
    return (plain == "") | _yes(plain.rlike(names)) | (_yes(ident.rlike(names)) & (plain == ident))


def continuous(ids: Column) -> Column:
    """Are the numbers of the ids just 1..n?"""
    numbers = F.transform(ids, lambda i: F.regexp_extract(i, r"(\d+)", 1).try_cast("int"))
    return _yes((F.size(ids) > 0) & (F.array_min(numbers) == 1) & (F.array_max(numbers) == F.size(ids)) & (F.size(F.array_distinct(numbers)) == F.size(ids)))


def complete_answer(success: Column, finish: Column, content: Column) -> Column:
    """A successful answer, not stopped for its length, that holds a diagram."""
    return _yes(success) & (F.coalesce(finish, F.lit("stop")) != "length") & looks_like_diagram(content)


def visual(kind: Column) -> Column:
    return _yes(kind.isin(*VISUAL))
