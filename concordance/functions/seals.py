"""Names on seals: the best piece of a text, and when a document is stamp-only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from concordance.functions.text import squeezed

#: Wordings that name no particular seal, and endings of organisations (fixed values).
GENERIC = ("公章", "印章", "红色公章", "红色印章", "红色圆形公章", "红色圆形印章", "公司公章", "公司印章")
ENDINGS = ("公司", "有限公司", "研究院", "医院", "大学")
STRUCTURED = ("flowchart", "chart", "table")


def _rank(x: Column) -> Column:
    ending = F.lit(False)
    for e in ENDINGS:
        ending = ending | x.endswith(e)
    return F.struct(x.rlike("[一-鿿]").alias("cjk"), ending.alias("org"), F.length(squeezed(x)).alias("n"), x.alias("x"))


def primary(x: Column) -> Column:
    """The token of a seal's text that names it best; '' if there is none but digits."""
    clean = F.regexp_replace(F.trim(F.regexp_replace(F.coalesce(x, F.lit("")), r"(?U)\s+", " ")), r"^[ ,;:|/\\_.\-]+|[ ,;:|/\\_.\-]+$", "")
    bare = F.when(clean.rlike("[一-鿿]"), F.regexp_replace(clean, r"^\d+|\d+$", "")).otherwise(clean)
    tokens = F.regexp_extract_all(bare, F.lit("[一-鿿A-Za-z0-9]+"), F.lit(0))
    wide = F.filter(tokens, lambda t: t.rlike("[一-鿿]"))
    named = F.filter(tokens, lambda t: ~t.rlike(r"^\d+$"))
    chosen = F.when(F.size(wide) > 0, wide).otherwise(named)
    best = F.array_max(F.transform(chosen, _rank))
    return F.coalesce(best["x"], F.when(bare.rlike(r"^\d*$"), F.lit("")).otherwise(bare))


def specific(x: Column) -> Column:
    """Does a text name a particular seal: four characters, CJK, no general wording?"""
    key = squeezed(x)
    return (F.length(key) >= 4) & key.rlike("[一-鿿]") & ~key.isin(*GENERIC)


def stamp_only(types: Column, seals: Column) -> Column:
    """No structured type among the labels, and some seal text."""
    return ~F.exists(types, lambda t: t.isin(*STRUCTURED)) & F.exists(seals, lambda s: F.coalesce(s, F.lit("")) != "")
