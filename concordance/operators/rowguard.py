"""Sound rows from broken ones, with the reason and the first broken field.

For each schema one anchored pattern for the whole row is generated. A row that matches is
sound. Only failures go through the incremental patterns, one field more each: lexical
prefixes (is the quoting sound up to field k, and does the row go on?), then typed prefixes
(are the first k values valid?). The first prefix that fails names the broken field, and
where it fails gives the reason. All of it runs inside the JVM.

Delimiters other than '|' follow RFC 4180. '|' rows start and end with '|', ``\\|`` is a
plain bar and quotes are plain characters. A field is valid if, after trimming, it is empty
or of its type.

JSON payloads likewise: one that matches the whole-payload pattern is well-formed and its
nodes are valid. The others go member by member and item by item through the patterns of
names, nodes, edges and values; the first that fails gives reason and field. JSON has no
regular language, so what the patterns call broken is parsed to make sure.

Defined results: a null row or null payload is broken ('column_count', 'broken_json'); an
unknown kind is 'unknown_kind'; the header (line_no 0) is sound; repeated rows keep theirs.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A registry of schemas is small by nature; each becomes literals in the plan.
MAX_KINDS = 500

_SPACE = r"\s\x{85}\x1c-\x1f\p{Z}"


def _types(grouped: bool) -> dict[str, str | None]:
    """Value patterns; ``grouped`` admits commas between groups of three."""
    whole = r"(?:[0-9]{1,3}(?:,[0-9]{3})++|[0-9]++)" if grouped else "[0-9]++"
    leap = r"(?:[0-9]{2}(?:0[48]|[2468][048]|[13579][26])|(?:[02468][048]|[13579][26])00)"
    return {
        "text": None,
        "int": f"-?{whole}",
        "dec": r"-?[0-9]++(?:\.[0-9]++)?",
        "pct": r"0*+(?:100(?:\.0++)?|[0-9]{0,2}(?<=[0-9])(?:\.[0-9]++)?)%",
        "date": rf"(?!0000)(?:[0-9]{{4}}-(?:(?:0[13578]|1[02])-(?:0[1-9]|[12][0-9]|3[01])|(?:0[469]|11)-(?:0[1-9]|[12][0-9]|30)|02-(?:0[1-9]|1[0-9]|2[0-8]))|{leap}-02-29)",
        "flag": "(?:yes|no)",
        "code": "[A-Z]{2}[0-9]{4}",
    }


class RowSchema:
    """The patterns generated for one kind of row."""

    def __init__(self, delimiter: str, names: list[str], types: list[str]):
        self.names, self.bar = names, delimiter == "|"
        d = re.escape(delimiter) if delimiter != "\t" else r"\t"
        self.d = d
        if self.bar:
            self.lexical = r"(?:[^|\\]++|\\\|?)*+"
            self.fields = [self._typed(t, r"(?:[^|\\]++|\\\|?)*+", _types(True), False) for t in types]
        else:
            self.lexical = rf'(?:"[^"]*+(?:""[^"]*+)*+"|[^"{d}]*+)'
            self.fields = [self._typed(t, self.lexical, _types(delimiter != ","), True) for t in types]

    def _typed(self, kind: str, lexical: str, types: dict[str, str | None], quotable: bool) -> str:
        value = types[kind]
        if value is None:
            return lexical
        outside = rf"[{_SPACE}&&[^{self.d}]]*+"
        bare = f"{outside}(?:{value}{outside})?"
        if not quotable:
            return f"(?:{bare})"
        inside = f"[{_SPACE}]*+"
        return f'(?:"{inside}(?:{_types(True)[kind]}{inside})?"|{bare})'

    def whole(self) -> str:
        """The anchored pattern of a sound row."""
        if self.bar:
            return r"\A\|" + "".join(f + r"\|" for f in self.fields) + r"\z"
        return r"\A" + self.d.join(self.fields) + r"\z"

    def prefix(self, k: int, typed: bool) -> str:
        """The anchored pattern of the first ``k`` fields."""
        parts = self.fields[:k] if typed else [self.lexical] * k
        if self.bar:
            return r"\A\|" + "".join(f + r"\|" for f in parts)
        return r"\A" + self.d.join(parts) + rf"(?:{self.d}|\z)"

    def rest(self) -> str:
        """Sound quoting in any fields that follow the last column; bars have no quoting."""
        return r"\A" if self.bar else rf"\A{self.lexical}(?:{self.d}{self.lexical})*+\z"

    def ends_after(self, k: int) -> str:
        """A row of exactly ``k`` fields."""
        if self.bar:
            return rf"\A\|(?:{self.lexical}\|){{{k}}}\z"
        return rf"\A{self.lexical}(?:{self.d}{self.lexical}){{{k - 1}}}\z" if k else r"(?!)"


def schemas(kinds: DataFrame) -> dict[str, RowSchema]:
    """The registry of row schemas; refuses one that isn't small."""
    rows = kinds.select("kind", "delimiter", "col_names", "col_types").limit(MAX_KINDS + 1).collect()
    if len(rows) > MAX_KINDS:
        raise ValueError(f"more than {MAX_KINDS} row schemas; give each family of schemas its own call")
    return {r["kind"]: RowSchema(r["delimiter"], list(r["col_names"]), list(r["col_types"])) for r in rows}


def _per_kind(found: dict[str, RowSchema], make, otherwise: Column) -> Column:
    column = None
    for kind, schema in found.items():
        test, value = F.col("kind") == kind, make(schema)
        column = F.when(test, value) if column is None else column.when(test, value)
    return otherwise if column is None else column.otherwise(otherwise)


def _first_failing(row: Column, schema: RowSchema, typed: bool) -> Column:
    """1-based number of the first field whose prefix pattern fails, else the next one."""
    tests = [F.when(~row.rlike(schema.prefix(k, typed)), F.lit(k)) for k in range(1, len(schema.fields) + 1)]
    return F.coalesce(*tests, F.lit(len(schema.fields) + 1))


def judge_rows(lines: DataFrame, kinds: DataFrame) -> DataFrame:
    """``lines`` with ``reason`` (null: sound) and ``broken_field`` (1-based, null: sound)."""
    found, row = schemas(kinds), F.col("raw_line")
    longest: dict[str, RowSchema] = {}
    for s in found.values():
        if s.d not in longest or len(s.fields) > len(longest[s.d].fields):
            longest[s.d] = s

    def prefix(d: str) -> Column:
        # lexical prefixes are the same for all kinds with one delimiter
        return _first_failing(row, longest[d], False)

    def reason(s: RowSchema) -> Column:
        # where a prefix fails, a row whose quoting is sound throughout has no such field
        quoted = F.when(row.rlike(s.rest()), "column_count").otherwise("broken_quoting")
        return F.when((F.col("_prefix") > len(s.fields)) & row.rlike(s.ends_after(len(s.fields))), "invalid_value").otherwise(quoted)

    def field(s: RowSchema) -> Column:
        return F.when(F.col("reason") == "invalid_value", _first_failing(row, s, True)).otherwise(F.least(F.col("_prefix"), F.lit(len(s.fields) + 1)))

    header, none = F.coalesce(F.col("line_no") == 0, F.lit(False)), F.lit(None).cast("int")
    sound = header | F.coalesce(_per_kind(found, lambda s: row.rlike(s.whole()), F.lit(False)), F.lit(False))
    first = none
    for d in longest:
        first = F.when(F.col("kind").isin(*(k for k, s in found.items() if s.d == d)), prefix(d)).otherwise(first)
    # the whole-row pattern decides for nearly all rows; only the others see the prefixes
    at = lines.withColumn("_sound", sound).withColumn("_prefix", F.when(~F.col("_sound") & row.isNotNull(), first))
    why = F.when(F.col("_sound"), F.lit(None).cast("string")).when(row.isNull(), "column_count").otherwise(_per_kind(found, reason, F.lit("unknown_kind")))
    return at.withColumn("reason", why).withColumn("broken_field", F.when(F.col("_prefix").isNotNull(), _per_kind(found, field, none))).drop("_sound", "_prefix")


def load_rows(judged: DataFrame, kinds: DataFrame) -> DataFrame:
    """The sound data rows with their trimmed, unquoted values in ``fields``; '' becomes null."""
    found, row = schemas(kinds), F.col("raw_line")

    def split(s: RowSchema) -> Column:
        if s.bar:
            body = F.expr("substring(raw_line, 2, length(raw_line) - 2)")
            parts = F.split(body, r"(?<!\\)\|", -1)
            return F.transform(parts, lambda x: F.trim(F.replace(x, F.lit("\\|"), F.lit("|"))))
        parts = F.regexp_extract_all(F.concat(row, F.lit("")), F.lit(rf"(?:\A|(?<={s.d}))(?:{s.lexical})(?={s.d}|\z)"), F.lit(0))
        return F.transform(parts, lambda x: F.trim(F.when(x.startswith('"'), F.replace(F.substring(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))).otherwise(x)))

    names = _per_kind(found, lambda s: F.array(*map(F.lit, s.names)), F.lit(None).cast("array<string>"))
    sound = judged.filter("reason is null and line_no is distinct from 0")
    values = F.transform(_per_kind(found, split, F.lit(None).cast("array<string>")), lambda x: F.when(x != "", x))
    return sound.withColumn("fields", values).withColumn("names", names)


# --- JSON payloads: the same rule, member by member ---------------------------------------

_WS = r"[ \t\n\r]*+"
_STR = r'"(?:[^"\\\x00-\x1f]++|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*+"'
#: A member's name without coded letters, so that it reads as it is written.
_NAME = r'"(?:[^"\\\x00-\x1f]++|\\["\\/bfnrt])*+"'
_NUM = r"-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?(?:[eE][+-]?[0-9]++)?"
#: The shapes a node may have (fixed values).
SHAPES = ("rectangle", "diamond", "ellipse", "rounded", "unknown")


def _json_value(depth: int) -> str:
    scalar = rf"{_STR}|{_NUM}|true|false|null"
    if not depth:
        return f"(?:{scalar})"
    inner = _json_value(depth - 1)
    following = lambda end: rf"{_WS}(?:,{_WS}(?!{end})|(?={end}))"
    return rf"(?:{scalar}|\[{_WS}(?:{inner}{following(r'\]')})*+\]|\{{{_WS}(?:{_STR}{_WS}:{_WS}{inner}{following(r'\}')})*+\}})"


def _members(special: dict[str, str], depth: int, needed: bool = False) -> str:
    """An object whose named members match their own patterns; others hold any value.

    With ``needed`` every named member occurs.
    """
    names = "|".join(map(re.escape, special))
    each = "|".join(rf'"{re.escape(k)}"{_WS}:{_WS}{v}' for k, v in special.items())
    member = rf'(?:{each}|(?!"(?:{names})"){_NAME}{_WS}:{_WS}{_json_value(depth)}){_WS}'
    plain = rf"{_NAME}{_WS}:{_WS}{_json_value(depth)}{_WS},{_WS}"
    there = "".join(rf'(?=\{{{_WS}(?:{plain})*?"{re.escape(k)}"{_WS}:)' for k in special) if needed else ""
    return rf"{there}\{{{_WS}(?:{member}(?:,{_WS}{member})*+)?\}}"


def _array(item: str) -> str:
    return rf"\[{_WS}(?:{item}{_WS}(?:,{_WS}{item}{_WS})*+)?\]"


#: Patterns of a node's members, in the order of the check.
_NODE_PARTS = {"node_id": r'"N[0-9]++"', "order_index": r"[1-9][0-9]*+(?![.eE0-9])", "shape": '"(?:' + "|".join(SHAPES) + ')"'}


@lru_cache(maxsize=1)
def payload_patterns() -> dict[str, re.Pattern]:
    """The whole-payload pattern and the pieces its failures are narrowed down with.

    A payload that matches is well-formed and its nodes are valid.
    """
    node, edge = _members(_NODE_PARTS, 1, needed=True), _members({"source": _STR, "target": _STR}, 1)
    whole = _WS + _members({"nodes": _array(node), "edges": _array(edge)}, 2) + _WS
    pieces = {"whole": whole, "name": rf"({_NAME}){_WS}:{_WS}", "node": node, "value": _json_value(3), "space": _WS}
    # a node of which the first members are valid, one member more each
    names = list(_NODE_PARTS)
    for k, name in enumerate(names):
        pieces["until_" + name] = _members({n: _NODE_PARTS[n] for n in names[: k + 1]}, 1, needed=True)
    return {k: re.compile(v) for k, v in pieces.items()}


def _reject_constant(name: str) -> None:
    raise ValueError(name)


def _bad_node(text: str, at: int, p: dict[str, re.Pattern]) -> str:
    """The first member of the node at ``at`` whose prefix pattern fails."""
    if not text.startswith("{", at):
        return ""
    return next(("." + name for name in _NODE_PARTS if not p["until_" + name].match(text, at)), "")


def narrowed(text: str, p: dict[str, re.Pattern]) -> tuple[str | None, str]:
    """(reason, field) by incremental patterns: the first member or item that fails.

    A payload that can't be read to its end is broken where reading stops, whatever its
    nodes; else the first bad node counts.
    """
    space = lambda k: p["space"].match(text, k).end()
    at, bad = space(0), ""
    if not text.startswith("{", at):
        m = p["value"].match(text, at)
        return (None, "") if m and space(m.end()) == len(text) else ("broken_json", "")
    at, field, first = space(at + 1), "", True
    while not (first and text.startswith("}", at)):
        m = p["name"].match(text, at)
        if not m:
            return "broken_json", field
        field, at = m[1][1:-1], m.end()
        if field in ("nodes", "edges") and text.startswith("[", at):
            at, k = space(at + 1), 0
            while not (k == 0 and text.startswith("]", at)):
                m = p["node"].match(text, at) if field == "nodes" else None
                if not m:
                    m = p["value"].match(text, at)
                    if not m:
                        return "broken_json", f"{field}[{k}]"
                    if field == "nodes" and not bad:
                        bad = f"nodes[{k}]" + _bad_node(text, at, p)
                at, k = space(m.end()), k + 1
                if text.startswith("]", at):
                    break
                if not text.startswith(",", at):
                    return "broken_json", f"{field}[{k}]"
                at = space(at + 1)
            at = space(at + 1)
        else:
            m = p["value"].match(text, at)
            if not m:
                return "broken_json", field
            at = space(m.end())
        first = False
        if text.startswith("}", at):
            break
        if not text.startswith(",", at):
            return "broken_json", field
        at = space(at + 1)
    if space(at + 1) != len(text):
        return "broken_json", ""
    return ("invalid_node", bad) if bad else (None, "")


def judge_payload(text: str | None, p: dict[str, re.Pattern]) -> tuple[str | None, str | None]:
    """(reason, broken field) of one payload; (None, None) if it is sound."""
    if text is None:
        return "broken_json", None
    if p["whole"].fullmatch(text):
        value = json.loads(text, parse_int=str)
        return _edge_ends(value.get("edges", []), {n["node_id"] for n in value.get("nodes", [])})
    reason, field = narrowed(text, p)
    if reason == "invalid_node" and "\\u" not in text and text.count('"nodes"') == 1:
        return reason, field
    # deeper than the patterns go, names written with escapes, or a member twice: the parser has the last word
    try:
        value = json.loads(text, parse_constant=_reject_constant)
    except (ValueError, RecursionError):
        return "broken_json", field
    return _judged_value(value)


def _judged_value(value: object) -> tuple[str | None, str | None]:
    """The same of a parsed payload."""
    value = value if isinstance(value, dict) else {}
    nodes, edges = value.get("nodes"), value.get("edges")
    nodes, edges = nodes if isinstance(nodes, list) else [], edges if isinstance(edges, list) else []
    known = set()
    for k, n in enumerate(nodes):
        if not isinstance(n, dict):
            return "invalid_node", f"nodes[{k}]"
        ident, order, shape = n.get("node_id"), n.get("order_index"), n.get("shape")
        if not isinstance(ident, str) or not re.fullmatch("N[0-9]+", ident):
            return "invalid_node", f"nodes[{k}].node_id"
        if type(order) is not int or order < 1:
            return "invalid_node", f"nodes[{k}].order_index"
        if shape not in SHAPES:
            return "invalid_node", f"nodes[{k}].shape"
        known.add(ident)
    return _edge_ends(edges, known)


def _edge_ends(edges: list, known: set[str]) -> tuple[str | None, str | None]:
    """The first end of an edge that is no known node."""
    for k, e in enumerate(edges):
        for end in ("source", "target"):
            found = e.get(end) if isinstance(e, dict) else None
            if not isinstance(found, str) or found not in known:
                return "unknown_edge_end", f"edges[{k}].{end}"
    return None, None


def judge_payloads(graphs: DataFrame) -> DataFrame:
    """(graph_id, reason, broken_field) of every payload; reason null: sound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = payload_patterns()
        for batch in batches:
            judged = [judge_payload(t, patterns) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([j[0] for j in judged], pa.string()), pa.array([j[1] for j in judged], pa.string())], ["graph_id", "reason", "broken_field"])

    return graphs.select("graph_id", "payload").mapInArrow(run, "graph_id bigint, reason string, broken_field string")
