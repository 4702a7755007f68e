"""Two flow graphs compared: best one-to-one mapping of their nodes, scores and differences."""

from __future__ import annotations

import html
import re
import unicodedata
from collections import Counter, deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

#: Weights of the node score, of the mapping's objective and of the structure score, and the
#: scores from which nodes and edges match (fixed values).
NODE_PARTS = {"label": 0.35, "shape": 0.10, "subgraph": 0.10, "incoming": 0.15, "outgoing": 0.15, "degree": 0.10, "position": 0.05}
OBJECTIVE = {"nodes": 0.45, "edges": 0.40, "paths": 0.10, "subgraphs": 0.05}
STRUCTURE = {"node_f1": 0.35, "edge_f1": 0.45, "paths": 0.10, "subgraphs": 0.05, "collapsed": -0.025, "split": -0.025}
NODE_MATCH, EDGE_MATCH, LABEL_MATCH, SPLIT = 0.65, 0.70, 0.4, 0.75
#: Names of nodes that only join or split lines, and characters without a meaning in labels
#: (fixed values).
AUXILIARY = re.compile(r"(?:split|merge|junction|join|branch|router|connector|hub)\d*", re.I)
_DROP = re.compile(r"[\s\-_.,，、;；:：!?？！\"'`“”‘’·•()\[\]{}<>/\\|—–]+")
_BREAK = re.compile(r"<\s*br\s*/?\s*>", re.I)


def signature(value: object) -> str:
    """A label's comparable form: entities resolved, no breaks, spaces or punctuation."""
    return _DROP.sub("", unicodedata.normalize("NFKC", _BREAK.sub("", html.unescape(str(value or "").strip()))).lower())


def _pairs(s: str) -> frozenset[str]:
    return frozenset(s[k : k + 2] for k in range(max(1, len(s) - 1))) if s else frozenset()


def _overlap(x: frozenset[str], y: frozenset[str]) -> float:
    return 1.0 if x == y else len(x & y) / len(x | y)


def text_score(a: object, b: object) -> float:
    """Jaccard of the character pairs of two labels; both empty 1."""
    return _overlap(_pairs(signature(a)), _pairs(signature(b)))


def dice(a: Counter, b: Counter) -> float:
    total = sum(a.values()) + sum(b.values())
    return 2 * sum((a & b).values()) / total if total else 1.0


def is_auxiliary(node: dict) -> bool:
    """A node without text, or one of unknown shape that only joins or splits lines."""
    text = str(node.get("text") or "").strip()
    if not text:
        return True
    return (node.get("shape") or "unknown") == "unknown" and bool(AUXILIARY.fullmatch(signature(text)))


def distinct_edges(edges: list[dict]) -> list[dict]:
    """The first of the edges whose ends and label read alike."""
    first: dict[tuple, dict] = {}
    for e in edges:
        first.setdefault((signature(e["source"]), signature(e["label"]), signature(e["target"])), e)
    return list(first.values())


def simplified(nodes: list[dict], edges: list[dict]) -> tuple[list[dict], list[dict]]:
    """The graph without auxiliary nodes: what leads into one leads on to where it leads.

    Nodes are taken out in the order of their names; labels before and after are joined.
    """
    out = sorted({n["node_id"] for n in nodes if is_auxiliary(n)})
    left = [{"source": e["source"], "target": e["target"], "label": str(e.get("label") or "").strip()} for e in edges]
    gone = set(out)
    for node in out:
        into, onward = ([e for e in left if e[end] == node] for end in ("target", "source"))
        left = [e for e in left if node not in (e["source"], e["target"])]
        for a in into:
            for b in onward:
                if a["source"] != b["target"] and not {a["source"], b["target"]} & gone:
                    same = not a["label"] or not b["label"] or signature(a["label"]) == signature(b["label"])
                    left.append({"source": a["source"], "target": b["target"], "label": b["label"] or a["label"] if same else f"{a['label']} / {b['label']}"})
    return [n for n in nodes if n["node_id"] not in gone], distinct_edges([e for e in left if not {e["source"], e["target"]} & gone])


def distances(ids: list[str], out: dict[str, set[str]], seeds: list[str]) -> dict[str, int]:
    """Steps from the seeds; without seeds 1, 2, .. by name; the unreached follow the farthest."""
    if not seeds:
        return {n: k for k, n in enumerate(sorted(ids), 1)}
    got = dict.fromkeys(seeds, 0)
    queue = deque(sorted(set(seeds)))
    while queue:
        n = queue.popleft()
        for t in sorted(out.get(n, ())):
            if t not in got:
                got[t] = got[n] + 1
                queue.append(t)
    last = max(got.values(), default=0)
    for n in ids:
        if n not in got:
            last += 1
            got[n] = last
    return got


class Features:
    """What the comparison needs of one graph, with its nodes in order as numbers."""

    def __init__(self, nodes: list[dict], edges: list[dict]):
        nodes, edges = simplified(nodes, edges)
        by_id = {n["node_id"]: n for n in nodes}
        self.ids = sorted(by_id, key=lambda i: by_id[i].get("order_index") or 0)
        number = {i: k for k, i in enumerate(self.ids)}
        self.nodes = [by_id[i] for i in self.ids]
        self.text = [str(n.get("text") or "").strip() or n["node_id"] for n in self.nodes]
        self.label = [signature(t) or f"id:{i}" for t, i in zip(self.text, self.ids)]
        self.pairs = [_pairs(signature(t)) for t in self.text]
        self.shape = [str(n.get("shape") or "unknown").strip().lower() for n in self.nodes]
        self.parent = [signature(n.get("parent")) for n in self.nodes]
        n = len(self.ids)
        self.edges = [(number[e["source"]], number[e["target"]], e["label"]) for e in edges if e["source"] in number and e["target"] in number]
        self.between: dict[tuple[int, int], list[int]] = {}
        self.degree = np.zeros((2, n), int)
        self.context = [[Counter() for _ in range(n)] for _ in range(2)]
        step = np.zeros((n, n), bool)
        for k, (s, t, label) in enumerate(self.edges):
            self.between.setdefault((s, t), []).append(k)
            self.degree[0, t] += 1
            self.degree[1, s] += 1
            self.context[0][t][self.label[s], signature(label)] += 1
            self.context[1][s][self.label[t], signature(label)] += 1
            step[s, t] = True
        ids = range(n)
        near = lambda m: {self.ids[k]: {self.ids[j] for j in np.flatnonzero(m[k])} for k in ids}
        depth = [distances(self.ids, near(m), [self.ids[k] for k in ids if not self.degree[d, k]]) for d, m in ((0, step), (1, step.T))]
        self.depth = np.array([[d[i] for i in self.ids] for d in depth], float).reshape(2, n)
        self.place = np.arange(n) / max(1, n - 1)
        self.reach = step.copy()
        while True:
            further = self.reach | (self.reach.astype(np.int32) @ self.reach.astype(np.int32) > 0)
            if (further == self.reach).all():
                break
            self.reach = further

    def key(self, k: int) -> str:
        """A node's label, with its id if others read alike."""
        return self.label[k] if self.label.count(self.label[k]) == 1 else f"{self.label[k]}:{self.ids[k]}"


def _near(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum(0, 1 - np.abs(x[:, None] - y[None]) / np.maximum(np.maximum(np.abs(x)[:, None], np.abs(y)[None]), 1))


def _table(rows: list, columns: list, score) -> np.ndarray:
    return np.array([[score(x, y) for y in columns] for x in rows], float).reshape(len(rows), len(columns))


def _subgraph(g: str, h: str) -> float:
    return 1.0 if g == h else 0.0 if not g or not h else _overlap(_pairs(g), _pairs(h))


def similarities(a: Features, b: Features) -> dict[str, np.ndarray]:
    """The parts of the node score, and the score, of every pair of nodes."""
    total = np.maximum(np.maximum(a.degree.sum(axis=0)[:, None], b.degree.sum(axis=0)[None]), 1)
    apart = sum(np.abs(a.degree[d][:, None] - b.degree[d][None]) for d in (0, 1))
    role = sum(((a.degree[d] == 0)[:, None] == (b.degree[d] == 0)[None]) / 2 for d in (0, 1))
    parts = {
        "label": _table(a.pairs, b.pairs, _overlap),
        "shape": _table(a.shape, b.shape, lambda s, t: 1.0 if s == t else 0.5 if "unknown" in (s, t) else 0.0),
        "subgraph": _table(a.parent, b.parent, _subgraph),
        "incoming": _table(a.context[0], b.context[0], dice),
        "outgoing": _table(a.context[1], b.context[1], dice),
        "degree": np.clip(1 - apart / (2 * total), 0, 1),
        "position": 0.35 * role + 0.25 * _near(a.depth[0], b.depth[0]) + 0.20 * _near(a.depth[1], b.depth[1]) + 0.20 * (1 - np.abs(a.place[:, None] - b.place[None])),
    }
    return {**parts, "node": sum(w * parts[k] for k, w in NODE_PARTS.items())}


def assignment(weight: np.ndarray | list) -> list[int]:
    """For each row its column in a one-to-one choice of largest total weight, -1 if none.

    Shortest augmenting paths with dual prices, a whole row of reduced costs at a time.
    """
    cost = -np.asarray(weight, float)
    if cost.size == 0:
        return [-1] * len(cost)
    if cost.shape[0] > cost.shape[1]:
        other = assignment(-cost.T)
        out = [-1] * cost.shape[0]
        for column, row in enumerate(other):
            out[row] = column
        return out
    rows, columns = cost.shape
    price_row, price_column = np.zeros(rows), np.zeros(columns)
    row_of, column_of = np.full(columns, -1), np.full(rows, -1)
    for start in range(rows):
        reached, came = np.full(columns, np.inf), np.full(columns, -1)
        closed, visited = np.zeros(columns, bool), [start]
        row, far = start, 0.0
        while True:
            through = far + cost[row] - price_row[row] - price_column
            better = ~closed & (through < reached)
            reached[better], came[better] = through[better], row
            column = int(np.argmin(np.where(closed, np.inf, reached)))
            far = reached[column]
            closed[column] = True
            if row_of[column] < 0:
                break
            row = int(row_of[column])
            visited.append(row)
        price_row[start] += far
        for r in visited[1:]:
            price_row[r] += far - reached[column_of[r]]
        price_column[closed] -= far - reached[closed]
        while True:
            row = int(came[column])
            row_of[column] = row
            column_of[row], column = column, column_of[row]
            if row == start:
                break
    return column_of.tolist()


def f1(precision: float, recall: float) -> float:
    return 2 * precision * recall / (precision + recall) if precision + recall else 0.0


class Comparison:
    """Scores of mappings between two graphs; a mapping has a column or -1 for every row."""

    def __init__(self, a: Features, b: Features):
        self.a, self.b = a, b
        self.parts = similarities(a, b)
        self.node = self.parts["node"]
        self._labels: dict[tuple[str, str], float] = {}
        self._groups: dict[str, list[int]] = {}
        for k, label in enumerate(a.label):
            self._groups.setdefault(label, []).append(k)

    def _label(self, x: str, y: str) -> float:
        if (x, y) not in self._labels:
            self._labels[x, y] = text_score(x, y)
        return self._labels[x, y]

    def edges(self, to: np.ndarray) -> tuple[int, list[tuple[str, int, int]]]:
        """(matched edges, differences as (kind, edge of a, edge of b or -1)) under a mapping."""
        used: set[int] = set()
        wrong = []
        for k, (s, t, label) in enumerate(self.a.edges):
            x, y = int(to[s]), int(to[t])
            same = [j for j in self.b.between.get((x, y), ()) if j not in used] if min(x, y) >= 0 else []
            back = self.b.between.get((y, x), []) if min(x, y) >= 0 else []
            if same:
                best = max(same, key=lambda j: self._label(label, self.b.edges[j][2]))
                score = self._label(label, self.b.edges[best][2])
                # ends, kind and direction agree
                if 0.75 + 0.25 * score >= EDGE_MATCH and (score >= LABEL_MATCH or not signature(label)):
                    used.add(best)
                else:
                    wrong.append(("edge_label_conflict", k, best))
            elif back:
                wrong.append(("edge_direction_conflict", k, max(back, key=lambda j: self._label(label, self.b.edges[j][2]))))
            else:
                wrong.append(("missing_edge", k, -1))
        return len(used), wrong

    def score(self, mapping: np.ndarray) -> dict:
        """All scores of a mapping."""
        rows = np.flatnonzero(mapping >= 0)
        rows = rows[self.node[rows, mapping[rows]] >= NODE_MATCH]
        columns = mapping[rows]
        to = np.full(len(self.a.ids), -1)
        to[rows] = columns
        n, m, k = len(self.a.ids), len(self.b.ids), len(rows)
        hits, wrong = self.edges(to)
        if k > 1:
            same = self.a.reach[np.ix_(rows, rows)] == self.b.reach[np.ix_(columns, columns)]
            paths = (same.sum() - np.trace(same)) / (k * (k - 1))
        else:
            paths = float(k)
        twins = [g for g in self._groups.values() if len(g) > 1]
        lost = sum(len(g) - sum(to[x] >= 0 for x in g) for g in twins)
        free = np.setdiff1d(np.arange(m), columns)
        got = {
            "node_f1": f1(k / max(m, 1), k / max(n, 1)), "edge_f1": f1(hits / max(len(self.b.edges), 1), hits / max(len(self.a.edges), 1)),
            "nodes": float(self.node[rows, columns].mean()) if k else 0.0, "paths": float(paths), "subgraphs": float(self.parts["subgraph"][rows, columns].mean()) if k else 0.0,
            "collapsed": lost / max(1, sum(map(len, twins))), "split": float((self.node[np.ix_(rows, free)].max(axis=0) >= SPLIT).sum()) / k if k and len(free) else 0.0,
        }
        got["edges"] = got["edge_f1"]
        clamp = lambda x: round(min(1.0, max(0.0, x)), 4)
        objective, structure = (clamp(sum(w * got[c] for c, w in weights.items())) for weights in (OBJECTIVE, STRUCTURE))
        return {**got, "objective": objective, "structure": structure, "to": to, "wrong": wrong, "matched": k, "matched_edges": hits}

    def best(self) -> tuple[np.ndarray, dict]:
        """The optimal mapping by node score, then up to two changes that raise the objective:
        the first swap of two nodes' partners that does, else the first other partner."""
        mapping = np.array(assignment(self.node))
        found = self.score(mapping)
        for _ in range(2):
            best = found["objective"] + 1e-6
            trial = next((t for t in self._changes(mapping, best) if t[1]["objective"] > best), None) if best < 1 else None
            if trial is None:
                break
            mapping, found = trial
        return mapping, found

    def _promising(self, mapping: np.ndarray, least: float) -> Iterator[tuple[int, int]]:
        """Swaps whose objective could exceed ``least``: the mean similarity is known exactly,
        edges count only between nodes that match, paths and subgraphs are at best 1."""
        taken = np.flatnonzero(mapping >= 0)
        if len(taken) < 2:
            return
        sim = self.node[np.ix_(taken, mapping[taken])]
        own = np.where(np.diag(sim) >= NODE_MATCH, np.diag(sim), 0.0)
        good = own > 0
        x, y = np.triu_indices(len(taken), 1)
        new = [np.where(s >= NODE_MATCH, s, 0.0) for s in (sim[x, y], sim[y, x])]
        count = good.sum() - good[x] - good[y] + (new[0] > 0) + (new[1] > 0)
        mean = (own.sum() - own[x] - own[y] + new[0] + new[1]) / np.maximum(count, 1)
        links = np.zeros((len(mapping), len(mapping)))
        np.add.at(links, ([e[0] for e in self.a.edges], [e[1] for e in self.a.edges]), 1)
        links = (links + links.T)[np.ix_(taken, taken)]
        loops = np.diag(links) / 2
        touch = links @ good - np.diag(links) * good  # edges to other matching nodes
        inside = ((links * good[:, None] * good[None]).sum() - (np.diag(links) * good).sum()) / 2 + (loops * good).sum()
        cross = links[x, y]
        rest = inside - good[x] * (touch[x] + loops[x]) - good[y] * (touch[y] + loops[y]) + good[x] * good[y] * cross
        add = sum((n > 0) * (touch[k] - good[o] * cross + loops[k]) for n, k, o in ((new[0], x, y), (new[1], y, x))) + (new[0] > 0) * (new[1] > 0) * cross
        edges = 2 * np.minimum(rest + add, len(self.b.edges)) / max(1, len(self.a.edges) + len(self.b.edges))
        most = OBJECTIVE["nodes"] * mean + OBJECTIVE["edges"] * edges + OBJECTIVE["paths"] + OBJECTIVE["subgraphs"]
        for k in np.flatnonzero(most + 1e-4 > least):
            yield int(taken[x[k]]), int(taken[y[k]])

    def _changes(self, mapping: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, dict]]:
        for x, y in self._promising(mapping, least):
            trial = mapping.copy()
            trial[[x, y]] = trial[[y, x]]
            yield trial, self.score(trial)
        free = np.setdiff1d(np.arange(len(self.b.ids)), mapping)
        for x in range(len(mapping)):
            for y in (-1, *free):
                if y != mapping[x]:
                    trial = mapping.copy()
                    trial[x] = y
                    yield trial, self.score(trial)


def compare_graphs(nodes_a: list[dict], edges_a: list[dict], nodes_b: list[dict], edges_b: list[dict]) -> dict:
    """Scores and differences of two graphs under the best mapping found.

    Two empty graphs are equal; one empty graph agrees in nothing.
    """
    a, b = Features(nodes_a, edges_a), Features(nodes_b, edges_b)
    if a.ids and b.ids:
        compared = Comparison(a, b)
        _, found = compared.best()
    else:
        equal = float(not a.ids and not b.ids)
        none = {c: equal for c in ("node_f1", "edge_f1", "nodes", "paths", "subgraphs", "objective", "structure")}
        found = {**none, "collapsed": float(bool(a.ids)), "split": 0.0, "matched": 0, "matched_edges": 0, "to": np.full(len(a.ids), -1), "wrong": [("missing_edge", k, -1) for k in range(len(a.edges))]}
    edge = lambda g, k: "|".join((g.key(g.edges[k][0]), signature(g.edges[k][2]), g.key(g.edges[k][1])))
    missing = [("missing_node", a.key(k), "") for k in range(len(a.ids)) if found["to"][k] < 0]
    differences = missing + [(kind, edge(a, k), edge(b, j) if j >= 0 else "") for kind, k, j in found["wrong"]]
    pairs = {a.ids[k]: b.ids[j] for k, j in enumerate(found["to"].tolist()) if j >= 0}
    return {**{k: v for k, v in found.items() if k not in ("to", "wrong")}, "mapping": pairs, "differences": differences}


SCORES = ("node_f1", "edge_f1", "nodes", "paths", "subgraphs", "collapsed", "split", "objective", "structure")
COMPARED = ", ".join(f"{c} double" for c in SCORES) + ", matched int, matched_edges int, differences array<struct<kind:string,reference:string,current:string>>"


def compared(pairs: DataFrame, key: list[str]) -> DataFrame:
    """Scores and differences of rows (key..., nodes_a, edges_a, nodes_b, edges_b), a pair per row."""
    types = {f.name: f.dataType.simpleString() for f in pairs.schema.fields}

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for r in pdf.to_dict("records"):
                s = compare_graphs(*(list(r[c]) if r[c] is not None else [] for c in ("nodes_a", "edges_a", "nodes_b", "edges_b")))
                told = [dict(kind=k, reference=x, current=y) for k, x, y in s["differences"]]
                rows.append([*(r[k] for k in key), *(round(s[c], 4) for c in SCORES), s["matched"], s["matched_edges"], told])
            yield pd.DataFrame(rows, columns=[*key, *SCORES, "matched", "matched_edges", "differences"])

    return pairs.mapInPandas(run, ", ".join(f"`{k}` {types[k]}" for k in key) + ", " + COMPARED)


def diagram_score(structure: float, text: float, ast: float, path: float, edge_f1: float, node_f1: float, render: float, valid: bool = True) -> float:
    """The weighted diagram score (fixed weights); an invalid diagram scores 0.2 of its text at most."""
    if not valid:
        return min(0.2, 0.2 * text)
    semantic = 0.55 * path + 0.25 * (0.5 * edge_f1 + 0.5 * path) + 0.20 * (0.5 * node_f1 + 0.5 * path)
    return 0.10 * text + 0.15 * ast + 0.45 * structure + 0.20 * semantic + 0.10 * render


def ast_score(nodes_a: list[dict], edges_a: list[dict], nodes_b: list[dict], edges_b: list[dict]) -> float:
    """Numbers of nodes, edges, nodes in subgraphs, and shapes compared."""
    a, b = Features(nodes_a, edges_a), Features(nodes_b, edges_b)
    if not a.ids and not b.ids:
        return 1.0
    ratio = lambda x, y: 1.0 if x == y == 0 else 0.0 if not x or not y else min(x, y) / max(x, y)
    inside = lambda g: sum(bool(p) for p in g.parent)
    shapes = sum((Counter(a.shape) & Counter(b.shape)).values()) / max(len(a.ids), len(b.ids))
    return 0.35 * ratio(len(a.ids), len(b.ids)) + 0.30 * ratio(len(a.edges), len(b.edges)) + 0.15 * ratio(inside(a), inside(b)) + 0.20 * shapes


def render_score(direction_a: str | None, direction_b: str | None, nodes_a: int, nodes_b: int) -> float:
    """Direction (unknown 0.5, another 0.6) and the ratio of node counts."""
    direction = 0.5 if not direction_a or not direction_b else 1.0 if direction_a == direction_b else 0.6
    return 0.6 * direction + 0.4 * (1.0 if nodes_a == nodes_b == 0 else min(nodes_a, nodes_b) / max(nodes_a, nodes_b))
