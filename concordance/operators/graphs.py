"""Flow graphs: text to graph and back, reachability, depth, pruning, comparison."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import count

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from concordance.functions import labels
from concordance.session import materialise

# --- diagram text ------------------------------------------------------------------------

_HEAD = re.compile(r"^\s*(?:flowchart|graph)\s+(TD|TB|LR|RL|BT)\b", re.I)
_SKIP = re.compile(r"^\s*(?:%%|classdef\b|class\s|style\s|linkstyle\b|click\s|direction\s)", re.I)
_IDENT = r"[A-Za-z0-9_]+(?:[:.-][A-Za-z0-9_]+)*"
_NODE = re.compile(rf'({_IDENT})\s*(?:(\(\[)\s*"?([^"\n]*?)"?\s*\]\)|(\[)\s*"?([^\]"\n]*)"?\s*\]|(\(\(?)\s*"?([^)"\n]*)"?\s*\)\)?|(\{{)\s*"?([^}}"\n]*)"?\s*\}})?(?:\s*:::\w+)?')
_ARROW = re.compile(r"\s*(?:(-->|-\.->|==>|---)\s*(?:\|\s*([^|]*?)\s*\|)?|--\s+(.+?)\s*-->)\s*")
_SHAPE = {"([": "ellipse", "[": "rectangle", "(": "rounded", "((": "ellipse", "{": "diamond"}


def parse_diagram(code: str | None) -> tuple[str | None, list[dict], list[dict]]:
    """(direction, nodes, edges) of diagram text; unreadable lines are passed over.

    Nodes: node_id, order_index, shape, text, parent (the enclosing subgraph); edges:
    source, target, label, edge_type. Code fences around the text don't matter.
    """
    direction, parents = None, []
    nodes: dict[str, dict] = {}
    edges: list[dict] = []

    def seen(m: re.Match) -> str:
        ident = m[1]
        kind = m[2] or m[4] or m[6] or m[8]
        label = next((g for g in (m[3], m[5], m[7], m[9]) if g is not None), None)
        node = nodes.setdefault(ident, {"node_id": ident, "order_index": len(nodes) + 1, "shape": "unknown", "text": "", "parent": parents[-1] if parents else ""})
        if kind:
            node["shape"], node["text"] = _SHAPE[kind], re.sub(r"(?i)<br\s*/?>", " ", label).strip()
        return ident

    text = re.sub(r"(?s)^\s*```\w*\n(.*?)(?:```\s*)?$", r"\1", code or "")
    for line in re.split(r"[\n;]", text):
        if _SKIP.match(line) or not line.strip():
            continue
        if m := _HEAD.match(line):
            direction = m[1].upper()
            line = line[m.end() :]
        word = line.strip()
        if m := re.match(r"subgraph\s+(.*)", word):
            title = re.search(r'[\[(]\s*"?([^\])"]*)', m[1])
            parents.append((title[1] if title else m[1]).strip())
            continue
        if word == "end":
            parents = parents[:-1]
            continue
        at = len(line) - len(line.lstrip())
        m = _NODE.match(line, at)
        if not m or not (line[m.end() :].strip() == "" or _ARROW.match(line, m.end())):
            continue
        left, at = seen(m), m.end()
        while a := _ARROW.match(line, at):
            m = _NODE.match(line, a.end())
            if not m:
                break
            right = seen(m)
            edges.append({"source": left, "target": right, "label": (a[2] or a[3] or "").strip().strip('"'), "edge_type": a[1] or "-->"})
            left, at = right, m.end()
    return direction, list(nodes.values()), edges


def write_diagram(nodes: list[dict], edges: list[dict], direction: str = "TD") -> str:
    """Diagram text of a graph; quotes and bars are escaped."""
    wrap = {"rectangle": '["{}"]', "rounded": '("{}")', "diamond": '{{"{}"}}', "ellipse": '(["{}"])'}
    safe = lambda s: str(s).replace('"', "'").replace("\n", " ").replace("|", "/")
    out = [f"flowchart {direction}"]
    out += [f"    {n['node_id']}" + wrap.get(n.get("shape"), '["{}"]').replace("{}", "\0").replace("{{", "{").replace("}}", "}").replace("\0", safe(n.get("text") or n["node_id"])) for n in nodes]
    out += [f"    {e['source']} -->" + (f"|{safe(e['label'])}|" if e.get("label") else "") + f" {e['target']}" for e in edges]
    return "\n".join(out)


_LABELLED = re.compile(r"(?<![\w.:-])([\w.:-]+)(?:(\(\()(.*?)(\)\))|(\[)(.*?)(\])|(\{)(.*?)(\})|(\()(.*?)(\)))")
_BREAKS = re.compile(r"<\s*br\s*/?\s*>", re.I)


def cleaned(code: str | None) -> str:
    """Diagram text without fences, its labels quoted: breaks as '<br/>' in nodes and ' / ' on
    edges, quotes within labels escaped; other text stays as it is."""

    def node(m: re.Match) -> str:
        ident, start, label, end = [g for g in m.groups() if g is not None]
        plain = label.strip()
        if len(plain) > 1 and plain[0] == plain[-1] == '"':
            plain = plain[1:-1].strip()
        plain = _BREAKS.sub("<br/>", plain).replace('"', '\\"')
        return f'{ident}{start}"{plain}"{end}' if label.strip() else m.group()

    text = (code or "").strip()
    if text.startswith("```"):
        lines = text.splitlines()[1:]
        text = "\n".join(lines[:-1] if lines and lines[-1].strip() == "```" else lines).strip()
    out = []
    for line in text.replace("\r\n", "\n").replace("\r", "\n").split("\n"):
        if re.search(r"-->|==>|-\.->", line):
            line = re.sub(r"\|([^|]+)\|", lambda m: "|" + _BREAKS.sub(" / ", m[1].strip()) + "|", line)
        out.append(_LABELLED.sub(node, line) if line.strip() else "")
    return "\n".join(out).strip()


@F.pandas_udf(StringType())
def cleaned_code(code: pd.Series) -> pd.Series:
    """``cleaned`` as a column; null stays null."""
    return code.map(lambda c: c if c is None else cleaned(c))


def drawn(nodes: Column, edges: Column) -> Column:
    """Diagram text of fused nodes and edges, inside the JVM: nodes by order and id, edges by
    the order of their ends; '' without nodes. Quotes are written as entities, bars in labels
    as '/'."""
    safe = lambda x: F.replace(F.coalesce(x, F.lit("")), F.lit('"'), F.lit("&quot;"))
    ordered = F.array_sort(F.transform(nodes, lambda n: F.struct(n["order_index"].alias("o"), n["node_id"].alias("i"), n["shape"].alias("s"), F.when(F.trim(n["text"]) != "", F.trim(n["text"])).otherwise(n["node_id"]).alias("t"))))

    def line(n: Column) -> Column:
        start = F.when(n["s"] == "diamond", '{"').when(n["s"] == "rounded", '("').when(n["s"] == "ellipse", '(("').otherwise('["')
        end = F.when(n["s"] == "diamond", '"}').when(n["s"] == "rounded", '")').when(n["s"] == "ellipse", '"))').otherwise('"]')
        return F.concat(n["i"], start, safe(n["t"]), end)

    place = lambda i: F.coalesce(F.array_min(F.transform(F.filter(nodes, lambda n: n["node_id"] == i), lambda n: n["order_index"])), F.lit(10**9))
    arrows = F.array_sort(F.transform(edges, lambda e: F.struct(place(e["source"]).alias("a"), place(e["target"]).alias("b"), e["source"].alias("s"), e["target"].alias("t"), F.trim(e["label"]).alias("l"))))
    arrow = lambda e: F.concat(e["s"], F.when(e["l"] != "", F.concat(F.lit(" -->|"), F.replace(safe(e["l"]), F.lit("|"), F.lit("/")), F.lit("| "))).otherwise(F.lit(" --> ")), e["t"])
    whole = F.array_join(F.concat(F.array(F.lit("flowchart TD")), F.transform(ordered, line), F.transform(arrows, arrow)), "\n")
    return F.when(F.size(nodes) > 0, whole).otherwise("")


NODES = "array<struct<node_id:string,order_index:int,shape:string,text:string,parent:string>>"
EDGES = "array<struct<source:string,target:string,label:string,edge_type:string>>"


def parsed(df: DataFrame, key: str, column: str) -> DataFrame:
    """(key, direction, nodes, edges) of a column of diagram texts."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node = pa.list_(pa.struct([("node_id", pa.string()), ("order_index", pa.int32()), ("shape", pa.string()), ("text", pa.string()), ("parent", pa.string())]))
        edge = pa.list_(pa.struct([(c, pa.string()) for c in ("source", "target", "label", "edge_type")]))
        for batch in batches:
            found = [parse_diagram(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], node), pa.array([f[2] for f in found], edge)], [key, "direction", "nodes", "edges"])

    return df.select(key, column).filter(F.col(column).isNotNull()).mapInArrow(run, f"`{key}` {kind}, direction string, nodes {NODES}, edges {EDGES}")


def _coded(raw: Column) -> Column:
    """N and the first digits of an id on three places; null without digits."""
    digits = F.regexp_extract(F.coalesce(raw, F.lit("")), r"(\d+)", 1).try_cast("int")
    return F.when(digits.isNotNull(), F.format_string("N%03d", digits))


def normalised(df: DataFrame, key: str, payload: str) -> DataFrame:
    """(key, nodes, edges, dropped) of graph payloads in normal form, inside the JVM.

    A node's id is N and the first digits of what it was called, else its order, else its
    place; edges are re-pointed by what their ends were called, by new id or by order, the
    last node of a name counts; an edge with an end that means nothing is dropped. Payloads
    that aren't JSON have no row.
    """
    schema = "nodes array<struct<node_id:string,order_index:string,shape:string,text:string>>, edges array<struct<source:string,target:string,label:string>>"
    whole = F.col(payload)
    rows = df.filter(F.try_parse_json(whole).isNotNull()).select(key, F.from_json(whole, schema).alias("p"))
    none = lambda c: F.coalesce(c, F.array())

    def node(n: Column, i: Column) -> Column:
        order = labels.positive_int(n["order_index"])
        ident = F.coalesce(_coded(F.trim(n["node_id"])), F.format_string("N%03d", F.coalesce(order, i + 1)))
        return F.struct(ident.alias("node_id"), F.coalesce(order, labels.node_index(ident)).alias("order_index"), labels.node_shape(F.coalesce(n["shape"], F.lit(""))).alias("shape"), F.trim(F.coalesce(n["text"], F.lit(""))).alias("text"), F.trim(n["node_id"]).alias("raw"))

    nodes = F.transform(none(F.col("p.nodes")), node)
    named = F.flatten(F.transform("nodes", lambda n: F.array(F.struct(n["raw"].alias("k"), n["node_id"].alias("v")), F.struct(n["node_id"].alias("k"), n["node_id"].alias("v")), F.struct(n["order_index"].cast("string").alias("k"), n["node_id"].alias("v")))))
    end = lambda raw: F.when(F.coalesce(F.trim(raw), F.lit("")) != "", F.coalesce(F.try_element_at(F.filter("named", lambda x: x["k"] == F.trim(raw)), F.lit(-1))["v"], _coded(raw)))
    edges = F.transform(none(F.col("p.edges")), lambda e: F.struct(end(e["source"]).alias("source"), end(e["target"]).alias("target"), F.trim(F.coalesce(e["label"], F.lit(""))).alias("label")))
    read = rows.withColumn("nodes", nodes).withColumn("named", named).withColumn("all_edges", edges)
    kept = F.filter("all_edges", lambda e: e["source"].isNotNull() & e["target"].isNotNull())
    plain = F.transform("nodes", lambda n: n.dropFields("raw"))
    return read.select(key, plain.alias("nodes"), kept.alias("edges"), (F.size("all_edges") - F.size(kept)).alias("dropped"))


# --- relations over many graphs ----------------------------------------------------------


def reachable(edges: DataFrame) -> DataFrame:
    """(graph, source, target) for every target that a path leads to.

    Each round joins the paths found last with all that are known, so a path doubles its
    length and is built from new ones only; a round writes its new paths, and rounds end when
    there are none. A node reaches itself only through a cycle.
    """
    front = materialise(edges.select("graph", "source", "target").distinct())
    known = front
    while not front.isEmpty():
        # a shortest path of more than 2^k steps begins with one of 2^k, which was found last
        link = (F.col("a.graph") == F.col("b.graph")) & (F.col("a.target") == F.col("b.source"))
        further = front.alias("a").join(known.alias("b"), link).select("a.graph", "a.source", "b.target")
        front = materialise(further.distinct().join(known, ["graph", "source", "target"], "left_anti"))
        known = known.unionAll(front)
    return known


def depths(nodes: DataFrame, edges: DataFrame, base: int = 1) -> DataFrame:
    """(graph, node_id, depth): steps from the nearest root, roots have ``base``.

    ``nodes``: graph, node_id, order_index. A graph without roots and nodes that no root
    reaches have their order number, 1 at least. One round per step, until nothing new is
    found; a found node never returns, so the rounds end.
    """
    known = edges.join(nodes.select("graph", F.col("node_id").alias("source")), ["graph", "source"], "left_semi").join(nodes.select("graph", F.col("node_id").alias("target")), ["graph", "target"], "left_semi").select("graph", "source", "target").distinct()
    known = materialise(known)
    roots = nodes.join(known.select("graph", F.col("target").alias("node_id")), ["graph", "node_id"], "left_anti")
    front = materialise(roots.select("graph", "node_id", F.lit(base).alias("depth")))
    found = front
    for step in count(1):
        nxt = front.join(known, (front.graph == known.graph) & (front.node_id == known.source)).select(known.graph, F.col("target").alias("node_id")).distinct()
        front = materialise(nxt.join(found.select("graph", "node_id"), ["graph", "node_id"], "left_anti").withColumn("depth", F.lit(base + step)))
        if front.isEmpty():
            break
        found = materialise(found.unionByName(front))
    return nodes.join(found, ["graph", "node_id"], "left").select("graph", "node_id", F.coalesce("depth", F.greatest(F.lit(1), F.coalesce("order_index", F.lit(1)))).alias("depth"))


def pruned(nodes: DataFrame, fused: DataFrame, low: DataFrame) -> DataFrame:
    """Nodes without those that lack support and agreement and that only weak edges touch.

    ``nodes``: graph, node_id, support, n, text_consistency; ``fused`` and ``low``: edges.
    Repeated until nothing is removed; each round removes nodes, so the rounds end.
    """
    ends = lambda e: e.select("graph", F.col("source").alias("node_id")).unionAll(e.select("graph", F.col("target").alias("node_id"))).distinct()
    while True:
        weak = nodes.filter((F.col("support") < F.col("n")) & (F.col("text_consistency") < 0.35))
        gone = materialise(weak.join(ends(fused), ["graph", "node_id"], "left_anti").join(ends(low), ["graph", "node_id"], "left_semi").select("graph", "node_id"))
        if gone.isEmpty():
            break
        nodes = materialise(nodes.join(gone, ["graph", "node_id"], "left_anti"))
        for side in ("source", "target"):
            low = low.join(gone.withColumnRenamed("node_id", side), ["graph", side], "left_anti")
        low = materialise(low)
    return nodes
