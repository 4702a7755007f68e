"""Comparable forms and similarities of texts, as column expressions inside the JVM.

Every similarity names what it gives for empty operands, since callers differ in that.
Compatibility normalisation (NFKC) has no built-in; ``compatible`` maps what becomes other
single characters, and the common expansions, inside the JVM. What only a composer can do (a
letter and its accent apart, rarer expansions) ``nfkc``, an Arrow function, does before.
"""

from __future__ import annotations

import difflib
import html
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

#: Token letters: CJK ideographs, Latin letters and digits (fixed value).
TOKEN = r"[一-鿿A-Za-z0-9_]+"


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row.

    Functions over arrays aren't compiled, and a value named twice in them is computed
    twice, in a lambda once per element; bound as a lambda's variable it is computed once.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def let_two(a: Column, b: Column, body) -> Column:
    """The same for two values."""
    return let(F.struct(a.alias("a"), b.alias("b")), lambda x: body(x["a"], x["b"]))


def _empty(x: Column) -> Column:
    return F.coalesce(x, F.lit(""))


def _single_forms() -> tuple[str, str]:
    """Characters whose compatibility form is one other character, and these forms."""
    pairs = [(c, n) for k in (*range(0x80, 0xD800), *range(0xE000, 0x10000)) if len(n := unicodedata.normalize("NFKC", c := chr(k))) == 1 and n != c]
    return "".join(c for c, _ in pairs), "".join(n for _, n in pairs)


SINGLE_FORMS = _single_forms()
def _near_ranges(chars: str, gap: int = 48) -> str:
    """A character class of few ranges that holds all of the characters, and some between."""
    ranges: list[list[int]] = []
    for k in sorted(map(ord, chars)):
        if ranges and k - ranges[-1][1] <= gap:
            ranges[-1][1] = k
        else:
            ranges.append([k, k])
    return "[" + "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in ranges) + "]"


#: Texts without a character of these ranges have no single form.
_MAY_CHANGE = _near_ranges(SINGLE_FORMS[0])
#: Common characters whose compatibility form is several characters.
EXPANDED = {c: unicodedata.normalize("NFKC", c) for c in "…‥ﬀﬁﬂﬃﬄ℃℉№㎏㎎㎡㎝㎜㎞㏄½¼¾"}


def compatible(x: Column) -> Column:
    """Compatibility forms of single characters and common expansions; ASCII is left alone."""
    single = F.when(x.rlike(_MAY_CHANGE), F.translate(x, *SINGLE_FORMS)).otherwise(x)
    out = single
    for c, form in EXPANDED.items():
        out = F.replace(out, F.lit(c), F.lit(form))
    return F.when(x.rlike("[" + "".join(EXPANDED) + "]"), out).otherwise(single)


def collapsed(x: Column) -> Column:
    """Compatibility form in lower case, each run of white space one space, trimmed."""
    return F.lower(F.trim(F.regexp_replace(compatible(_empty(x)), r"(?U)\s+", " ")))


def document_key(x: Column) -> Column:
    """The same without compatibility forms, for whole documents."""
    return F.lower(F.trim(F.regexp_replace(_empty(x), r"(?U)\s+", " ")))


def squeezed(x: Column) -> Column:
    """Compatibility form in lower case without white space."""
    return F.lower(F.regexp_replace(compatible(_empty(x)), r"(?U)\s+", ""))


def compact(x: Column) -> Column:
    """Only digits, small Latin letters and CJK ideographs."""
    return F.regexp_replace(F.lower(_empty(x)), r"[^0-9a-z一-鿿]", "")


@F.pandas_udf(StringType())
def nfkc(x: pd.Series) -> pd.Series:
    """Compatibility composition; null stays null."""
    return x.map(lambda s: s if s is None or s.isascii() else unicodedata.normalize("NFKC", s))


@F.pandas_udf(StringType())
def unescaped(x: pd.Series) -> pd.Series:
    """HTML entities resolved, line breaks as spaces, NFKC."""
    return x.map(lambda s: s if s is None else unicodedata.normalize("NFKC", html.unescape(s)))


def graph_text(x: Column) -> Column:
    """Signature of a node's text: no markup breaks, quotes or punctuation, no spaces."""
    plain = F.regexp_replace(unescaped(_empty(x)), r"(?i)<br\s*/?>|\\n", " ")
    return F.lower(F.regexp_replace(plain, r"(?U)[\s\p{Punct}]+", ""))


def bigrams(x: Column) -> Column:
    """Distinct pairs of neighbouring characters; one character is itself, '' has none."""
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.length(x) - 1, F.lit(1))), lambda i: F.substring(x, i, F.lit(2)))
    return F.when(F.length(x) == 0, F.array().cast("array<string>")).otherwise(F.array_distinct(pairs))


def jaccard(a: Column, b: Column, both_empty: float = 1.0) -> Column:
    """Of two sets as arrays."""
    # |a or b| = |a| + |b| - |a and b| for arrays of distinct values
    def body(x: Column, y: Column) -> Column:
        return let(F.size(F.array_intersect(x, y)), lambda n: F.when(F.size(x) + F.size(y) == 0, F.lit(both_empty)).otherwise(n / (F.size(x) + F.size(y) - n)))

    return let_two(a, b, body)


def bigram_jaccard(a: Column, b: Column, both_empty: float = 1.0, one_empty: float = 0.0) -> Column:
    """Jaccard of the character pairs of two texts in comparable form."""
    def body(x: Column, y: Column) -> Column:
        return F.when((F.length(x) == 0) & (F.length(y) == 0), F.lit(both_empty)).when((F.length(x) == 0) | (F.length(y) == 0), F.lit(one_empty)).otherwise(jaccard(bigrams(x), bigrams(y)))

    return let_two(a, b, body)


def alignment_similarity(a: Column, b: Column) -> Column:
    """For block alignment: without white space, equal or both empty 1, to four places."""
    return let_two(squeezed(a), squeezed(b), lambda x, y: F.when(x == y, F.lit(1.0)).otherwise(F.round(bigram_jaccard(x, y), 4)))


def keywords(x: Column) -> Column:
    """Distinct token runs in lower case."""
    return F.array_distinct(F.regexp_extract_all(F.lower(_empty(x)), F.lit(TOKEN), F.lit(0)))


def keyword_similarity(a: Column, b: Column) -> Column:
    """Jaccard of token runs; either empty gives 0."""
    return let_two(keywords(a), keywords(b), lambda x, y: F.when((F.size(x) == 0) | (F.size(y) == 0), F.lit(0.0)).otherwise(jaccard(x, y)))


def char_similarity(a: Column, b: Column) -> Column:
    """Jaccard of character pairs of collapsed texts; either empty gives 0, equal 1."""
    return let_two(collapsed(a), collapsed(b), lambda x, y: F.when((x == "") | (y == ""), F.lit(0.0)).when(x == y, F.lit(1.0)).otherwise(bigram_jaccard(x, y)))


def phrase_similarity(a: Column, b: Column) -> Column:
    """The best of containment (0.45 + 0.5 length ratio), 0.6 keyword + 0.4 character, character."""
    def body(x: Column, y: Column) -> Column:
        ratio = F.least(F.length(x), F.length(y)) / F.greatest(F.length(x), F.length(y))
        inside = F.when((x != "") & (y != "") & (x.contains(y) | y.contains(x)), 0.45 + 0.5 * ratio).otherwise(0.0)
        best = let(char_similarity(a, b), lambda char: F.greatest(inside, 0.6 * keyword_similarity(a, b) + 0.4 * char, char))
        return F.when((x == "") | (y == ""), F.lit(0.0)).when(x == y, F.lit(1.0)).otherwise(best)

    return let_two(compact(a), compact(b), body)


def list_overlap(a: Column, b: Column, similarity=phrase_similarity) -> Column:
    """Mean of both directed means of best matches; both empty 0.5, one empty 0."""

    def directed(x: Column, y: Column) -> Column:
        best = F.transform(x, lambda p: F.array_max(F.transform(y, lambda q: similarity(p, q))))
        return F.aggregate(best, F.lit(0.0), lambda s, v: s + v) / F.size(x)

    none_a, none_b = F.size(F.coalesce(a, F.array())) == 0, F.size(F.coalesce(b, F.array())) == 0
    return F.when(none_a & none_b, 0.5).when(none_a | none_b, 0.0).otherwise((directed(a, b) + directed(b, a)) / 2)


def field_similarity(a: Column, b: Column) -> Column:
    """Character similarity of a field; both empty 0.5."""
    return F.when((collapsed(a) == "") & (collapsed(b) == ""), 0.5).otherwise(char_similarity(a, b))


def field_equality(a: Column, b: Column) -> Column:
    """1 if the collapsed texts are equal; both empty 0.5."""
    x, y = collapsed(a), collapsed(b)
    return F.when((x == "") & (y == ""), 0.5).when(x == y, 1.0).otherwise(0.0)


def without_title_prefix(x: Column) -> Column:
    """A title without 'Figure 3:' and the like."""
    return F.trim(F.regexp_replace(_empty(x), r"(?iU)^\s*(?:figure|fig\.?|table|chart|图|表|图表)\s*\d+(?:[.\-]\d+)*\s*[:：.、\-]?\s*", ""))


def _contained(a: Column, b: Column, base: float, share: float) -> Column:
    """``base`` + ``share`` of the length ratio if one compact text holds the other."""

    def body(x: Column, y: Column) -> Column:
        ratio = F.least(F.length(x), F.length(y)) / F.greatest(F.length(x), F.length(y))
        return F.when((x == "") | (y == ""), 0.0).when(x == y, 1.0).when(x.contains(y) | y.contains(x), base + share * ratio).otherwise(char_similarity(a, b))

    return let_two(compact(a), compact(b), body)


def title_alignment(a: Column, b: Column) -> Column:
    """Of two titles without their numbering: containment counts 0.75 and more."""
    return _contained(without_title_prefix(a), without_title_prefix(b), 0.75, 0.25)


def visible_alignment(a: Column, b: Column) -> Column:
    """Of a key text and a visible one: containment counts 0.45 and more."""
    return _contained(a, b, 0.45, 0.5)


def best_candidate(x: Column, candidates: Column, similarity=visible_alignment, least: float = 0.5) -> Column:
    """The candidate most like ``x``, the first of equals, if it reaches ``least``, else ``x``."""
    scored = F.transform(candidates, lambda c, i: F.struct(similarity(x, c).alias("s"), (-i).alias("i"), c.alias("c")))
    return let(F.array_max(scored), lambda b: F.when(b["s"] >= least, b["c"]).otherwise(x))


def aligned_keys(keys: Column, visible: Column, most: int = 10) -> Column:
    """Key texts replaced by the visible texts they mean, distinct, ten at most; filled up
    from the visible ones while there are fewer than three."""
    own = first_seen(F.transform(keys, lambda k: best_candidate(k, visible)), "squeezed")
    return let_two(own, first_seen(visible, "squeezed"), lambda k, v: F.slice(F.when(F.size(k) >= 3, k).otherwise(F.slice(F.array_distinct(F.concat(k, v)), 1, F.greatest(F.size(k), F.lit(3)))), 1, most))


def excerpt(lines: Column, terms: Column, most: int = 20) -> Column:
    """Lines that hold a term, with one before and after, the first and the last line too."""

    def body(rows: Column) -> Column:
        hit = F.transform(rows, lambda r: F.exists(terms, lambda t: (t != "") & r.contains(t)))
        near = lambda h, i: F.coalesce(F.get(h, i - 1), F.lit(False)) | F.get(h, i) | F.coalesce(F.get(h, i + 1), F.lit(False))
        return let(hit, lambda h: F.slice(F.filter(rows, lambda r, i: near(h, i) | (i == 0) | (i == F.size(rows) - 1)), 1, most))

    return let(lines, body)


def ratio_similarity(a: Column, b: Column) -> Column:
    """Smaller over larger; both 0 gives 1, one 0 gives 0."""
    return F.when((a == 0) & (b == 0), 1.0).when((a == 0) | (b == 0), 0.0).otherwise(F.least(a, b) / F.greatest(a, b))


def optional_number_similarity(a: Column, b: Column) -> Column:
    """1 - distance over the larger size; both missing 1, one missing 0."""
    both = F.greatest(F.lit(0.0), 1 - F.abs(a - b) / F.greatest(F.abs(a), F.abs(b), F.lit(1)))
    return F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.0).otherwise(both)


def visible_score(x: Column) -> Column:
    """Characters that belong to token runs."""
    return F.aggregate(F.regexp_extract_all(_empty(x), F.lit(TOKEN), F.lit(0)), F.lit(0), lambda s, t: s + F.length(t))


def clamp(x: Column) -> Column:
    """Between 0 and 1; null stays null."""
    return F.when(x.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), x)))


def has_cjk(x: Column) -> Column:
    """Does the text hold a CJK ideograph?"""
    return _empty(x).rlike("[一-鿿]")


def joined_errors(*parts: Column) -> Column:
    """Messages joined by '; ', empty ones left out; null if none is left."""
    text = F.array_join(F.filter(F.array(*parts), lambda x: x.isNotNull() & (x != "")), "; ")
    return F.nullif(text, F.lit(""))


@F.pandas_udf(DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Longest-matching-blocks ratio; an Arrow function since no built-in has it. Equal pairs
    of a batch are compared once; a null operand gives 0."""
    known: dict[tuple, float] = {}
    out = []
    for pair in zip(a, b):
        if pair[0] is None or pair[1] is None:
            out.append(0.0)
            continue
        if pair not in known:
            known[pair] = difflib.SequenceMatcher(None, *pair).ratio()
        out.append(known[pair])
    return pd.Series(out, dtype=float)


def cell_similarity(a: Column, b: Column) -> Column:
    """Of two normalised cells: the ratio, or 0.6 keyword Jaccard + 0.4 ratio if larger."""
    x, y = _empty(a), _empty(b)
    # equal and empty cells are decided here, only the others are sent to Python
    open_ = (x != y) & (x != "") & (y != "")
    ratio = sequence_ratio(F.when(open_, x), F.when(open_, y))
    token = jaccard(keywords(x), keywords(y), both_empty=0.0)
    return F.when(x == y, 1.0).when((x == "") | (y == ""), 0.0).otherwise(F.greatest(ratio, 0.6 * token + 0.4 * ratio))


# --- numbers, formulas and cells ---------------------------------------------------------

#: Units after a number, in the order in which they are tried (fixed value).
UNITS = "%|‰|℃|°C|kg|g|mg|μg|ug|lb|lbs|ms|s|min|h|hz|khz|mhz|ghz|ml|mL|l|L|mm|cm|m|km|m²|cm²|mm²|km²|㎡|亩|元|万元|亿元|美元|万美元|亿美元|万亿|万|亿|人|次|倍|天|年|月|周|小时|分钟|秒"
NUMBER = r"([+-]?(?:\d{1,3}(?:[,，]\d{3})+|\d+)(?:\.\d+)?|[+-]?\.\d+)\s*(" + UNITS + ")?"


def cell_text(x: Column) -> Column:
    """A cell in comparable form: no hard spaces, no thousands separators, collapsed."""
    x = compatible(_empty(x))
    plain = F.regexp_replace(F.replace(_empty(x), F.lit(" "), F.lit(" ")), r"(?<=\d)[,，](?=\d{3}(?:\D|$))", "")
    return F.trim(F.regexp_replace(plain, r"(?U)\s+", " "))


def numbers_with_units(x: Column) -> Column:
    """array<struct<value, unit>> of the numbers of a text, in order."""
    pattern = F.lit("(?i)" + NUMBER)
    text = _empty(x)
    return F.zip_with(
        F.regexp_extract_all(text, pattern, F.lit(1)), F.regexp_extract_all(text, pattern, F.lit(2)),
        lambda v, u: F.struct(F.regexp_replace(v, "[,，]", "").cast("double").alias("value"), F.lower(u).alias("unit")),
    )


def numeric_list_similarity(a: Column, b: Column) -> Column:
    """Pairwise 0.7 value + 0.3 unit, times the ratio of counts; both empty 1, one 0."""
    pairs = F.least(F.size(a), F.size(b))
    scores = F.zip_with(F.slice(a, 1, pairs), F.slice(b, 1, pairs), lambda p, q: F.when(F.abs(p["value"] - q["value"]) <= 1e-9, 0.7).otherwise(0.0) + F.when(p["unit"] == q["unit"], 0.3).otherwise(0.0))
    mean = F.aggregate(scores, F.lit(0.0), lambda s, v: s + v) / pairs
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when(pairs == 0, 0.0).otherwise(mean * pairs / F.greatest(F.size(a), F.size(b)))


#: Display and inline formulas (fixed values).
FORMULAS = (r"(?s)\$\$(.+?)\$\$", r"(?s)\\\[(.+?)\\\]", r"(?s)\\\((.+?)\\\)", r"(?s)(?<!\$)\$(?!\$)(.+?)(?<!\$)\$(?!\$)")


def formulas(x: Column) -> Column:
    """Distinct formulas of a text: display first, then inline, each in order."""
    found = [F.regexp_extract_all(_empty(x), F.lit(p), F.lit(1)) for p in FORMULAS]
    return F.array_distinct(F.filter(F.transform(F.concat(*found), lambda f: F.trim(f)), lambda f: f != ""))


def row_cells(x: Column) -> Column:
    """The cells of a Markdown row; outer bars don't count, bars aren't escaped."""
    inner = F.regexp_replace(F.trim(_empty(x)), r"^\||\|$", "")
    return F.transform(F.split(inner, r"[|]", -1), lambda c: F.trim(c))


def is_separator(x: Column) -> Column:
    """Is it the row of dashes under a header?"""
    return x.contains("|") & F.forall(row_cells(x), lambda c: c.rlike("^:?-+:?$"))


#: Kinds of first-seen distinct: how texts are compared (rules by name).
KEYS = {"exact": lambda x: x, "trimmed": F.trim, "folded": F.lower, "collapsed": collapsed, "squeezed": squeezed, "spaced": lambda x: F.trim(F.regexp_replace(x, r"(?U)\s+", " "))}


def first_seen(values: Column, key: str = "exact") -> Column:
    """The distinct values in order, the first of equals; nulls and blanks left out."""
    rule = KEYS[key]
    kept = F.filter(values, lambda v: v.isNotNull() & (F.trim(v) != ""))
    keyed = let(kept, lambda vs: F.struct(vs.alias("v"), F.transform(vs, rule).alias("k")))
    return let(keyed, lambda x: F.filter(x["v"], lambda v, i: F.array_position(x["k"], F.get(x["k"], i)) == i + 1))
