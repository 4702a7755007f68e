"""Page layout: sound blocks, caption groups, reading rows, single-block views."""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordance.functions import geometry
from concordance.operators.ordering import numbered, running

#: Types that make a crop, and types that may join one (fixed values).
PRIMARY = ("chart", "image", "table")
CONTEXT = ("image_caption", "image_footnote", "table_caption", "table_footnote", "chart_caption", "chart_footnote")


def sound_blocks(raw: DataFrame, page: str, order: str, block_type: str, box: str, ties: tuple[str, ...] = (), context: tuple[str, ...] = CONTEXT) -> DataFrame:
    """Blocks with a type and a box of four numbers, corners in order, renumbered from 0, and
    their chunk: a new one begins at each block that is neither primary nor context."""
    kind = F.lower(F.trim(F.col(block_type)))
    kept = raw.withColumn("kind", kind).withColumn("box", geometry.sorted_corners(F.col(box))).filter("kind != '' and box is not null")
    counted = running(kept, [page], [order, *ties], {"position": F.lit(1), "chunk": _barrier(context)})
    return counted.withColumn("position", (F.col("position") - 1).cast("int"))


def _barrier(context: tuple[str, ...]) -> Column:
    return (~F.col("kind").isin(*PRIMARY, *context)).cast("int")


def attach(kinds: list[str], boxes: list[list[float]], least_overlap: float = 0.25, most_gap: float = 0.08, context: tuple[str, ...] = CONTEXT) -> list[list[int]]:
    """For each primary block of one page its group of positions.

    From a primary block the walk goes back, then on, over context blocks that overlap
    enough and lie close; one already used is passed over, anything else ends the walk.
    """
    used: set[int] = set()
    groups = []

    def fits(c: int, p: int) -> bool:
        a, b = boxes[c], boxes[p]
        overlap = max(0.0, min(a[2], b[2]) - max(a[0], b[0])) / min(max(1e-6, a[2] - a[0]), max(1e-6, b[2] - b[0]))
        return overlap >= least_overlap and max(0.0, b[1] - a[3], a[1] - b[3]) <= most_gap

    for p, kind in enumerate(kinds):
        if kind not in PRIMARY:
            continue
        own = [p]
        for step in (-1, 1):
            c = p + step
            while 0 <= c < len(kinds) and kinds[c] in context:
                if c not in used:
                    if not fits(c, p):
                        break
                    used.add(c)
                    own.append(c)
                c += step
        groups.append(sorted(own))
    return groups


GROUPS = "page string, group_index int, main_type string, members array<bigint>, member_types array<string>, box array<double>"


def crop_groups(blocks: DataFrame, page: str, least_overlap: float = 0.25, most_gap: float = 0.08, context: tuple[str, ...] = CONTEXT) -> DataFrame:
    """Caption groups of every page.

    A context block can only join the nearest primary blocks, so a page is cut into chunks
    at blocks that are neither. Chunks are spread over tasks, and a task streams its sorted
    rows and holds one chunk at a time, so a page with a tenth of all rows is no burden.
    ``blocks``: ``sound_blocks`` under the same ``context``.
    """
    chunked = blocks.withColumnRenamed(page, "page")

    def grouped(name: str, rows: list[tuple]) -> list[tuple]:
        kinds, boxes, position = [r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows]
        out = []
        for own in attach(kinds, boxes, least_overlap, most_gap, context):
            part = [boxes[k] for k in own]
            hull = [min(b[0] for b in part), min(b[1] for b in part), max(b[2] for b in part), max(b[3] for b in part)]
            first = next(k for k in own if kinds[k] in PRIMARY)
            out.append((name, position[first], kinds[first], [position[k] for k in own], [kinds[k] for k in own], hull))
        return out

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        types = (pa.string(), pa.int32(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.float64()))
        columns = list(zip(*out)) if out else [[]] * 6
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [x.split()[0] for x in GROUPS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows = None, []
        for batch in batches:
            out = []
            for name, chunk, kind, box, position in zip(*(c.to_pylist() for c in batch.columns)):
                if (name, chunk) != at:
                    out += grouped(at[0], rows) if at else []
                    at, rows = (name, chunk), []
                rows.append((kind, box, position))
            yield batch_of(out)
        yield batch_of(grouped(at[0], rows) if at else [])

    spread = chunked.select("page", "chunk", "kind", "box", "position").repartition("page", "chunk").sortWithinPartitions("page", "chunk", "position")
    made = spread.mapInArrow(run, GROUPS).withColumnRenamed("group_index", "first")
    return numbered(made, ["page"], ["first"], "group_index").drop("first").withColumn("group_index", F.col("group_index").cast("int"))


def crop_name(page: Column, index: Column, kind: Column) -> Column:
    """File name of a crop."""
    slug = F.regexp_replace(F.lower(kind), r"[^0-9a-z]+", "_")
    return F.concat(page, F.format_string("_%03d_", index), slug, F.lit(".png"))


def single_block_view(blocks: DataFrame, key: list[str]) -> DataFrame:
    """A document as one block: texts in order, the hull, the first non-empty picture path.

    ``blocks``: key..., page_idx, order_index, block_id, text, box, kind.
    """
    place = F.struct("page_idx", "order_index", "block_id")
    texts = F.filter(F.transform(F.array_sort(F.collect_list(F.struct(place.alias("o"), F.trim("text").alias("t")))), lambda x: x["t"]), lambda t: t != "")
    return blocks.groupBy(*key).agg(F.array_join(texts, "\n\n").alias("text"), geometry.hull(F.col("box")).alias("box"), F.min_by("kind", place).alias("kind"), F.count("*").alias("blocks"))


#: How far a step of depth moves a node down, and the least tolerance of a row (fixed values).
DEPTH_STEP, LEAST_TOLERANCE = 0.12, 0.045


def reading_rows(nodes: list[dict], depths: dict[str, int] | None = None) -> list[list[str]]:
    """Ids of nodes by visual row, each row from left to right.

    Nodes go from top to bottom by their centre, moved down by their depth. A node joins the
    row while it is near the row's running mean, by the upper median of all heights or its
    own, or while it overlaps the row's extent and lies nearly as near.
    ``nodes``: node_id, order_index, box [x0, y0, x1, y1] or None.
    """
    depths = depths or {}
    place = {}
    for n in nodes:
        box = n.get("box")
        number = n.get("order_index") or int((re.search(r"\d+", n["node_id"]) or ["1000000"])[0])
        y, x, h = ((box[1] + box[3]) / 2, (box[0] + box[2]) / 2, max(0.0, box[3] - box[1])) if box else (number * 0.1, 0.1, 0.0)
        place[n["node_id"]] = (y, y + DEPTH_STEP * max(0, depths.get(n["node_id"], 1) - 1), x, h, number, box)
    heights = sorted(p[5][3] - p[5][1] for p in place.values() if p[5])
    common = max(LEAST_TOLERANCE, 1.1 * heights[len(heights) // 2] if heights else 0.0)
    key = lambda i: (round(place[i][1], 4), round(place[i][2], 4), place[i][4], i)
    rows: list[list[str]] = []
    mean, top, bottom = 0.0, None, None
    for i in sorted(place, key=key):
        raw, y, _, h, _, box = place[i]
        near = max(common, 0.9 * h)
        joins = bool(rows) and abs(y - mean) <= near
        if rows and not joins and box and top is not None:
            lap, least = min(bottom, box[3]) - max(top, box[1]), min(bottom - top, box[3] - box[1])
            joins = lap > 0 and least > 0 and lap / least >= 0.35 and max(abs(y - mean), abs(raw - (top + bottom) / 2)) <= max(near, 0.08)
        if joins:
            rows[-1].append(i)
            mean += (y - mean) / len(rows[-1])
        else:
            rows.append([i])
            mean, top, bottom = y, None, None
        if box:
            top, bottom = (box[1], box[3]) if top is None else (min(top, box[1]), max(bottom, box[3]))
    across = lambda i: (round(place[i][2], 4), *key(i)[:1], place[i][4], i)
    return [sorted(row, key=across) for row in rows]


def node_depths(ids: list[str], edges: list[dict], order: dict[str, int]) -> dict[str, int]:
    """Steps from the roots, from 1; what no root reaches has its order number."""
    out: dict[str, list[str]] = {}
    into = set()
    for e in edges:
        if e.get("source") in order and e.get("target") in order:
            out.setdefault(e["source"], []).append(e["target"])
            into.add(e["target"])
    queue = deque(i for i in ids if i not in into)
    depth = dict.fromkeys(queue, 1)
    while queue:
        i = queue.popleft()
        for t in out.get(i, ()):
            if t not in depth:
                depth[t] = depth[i] + 1
                queue.append(t)
    return {i: depth.get(i) or max(1, order.get(i) or 1) for i in ids}


ROWS = "graph bigint, node_id string, row_index int, col_index int"


def visual_rows(graphs: DataFrame) -> DataFrame:
    """(graph, node_id, row_index, col_index) from rows (graph, nodes, edges) of one graph
    each; a graph is one record and never leaves its row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for graph, nodes, edges in zip(*(c.to_pylist() for c in batch.columns)):
                known = [{**n, "box": n["bbox_hint"] if n.get("bbox_hint") and len(n["bbox_hint"]) == 4 and None not in n["bbox_hint"] else None} for n in nodes if n and n.get("node_id")]
                order = {n["node_id"]: n.get("order_index") or 0 for n in known}
                depths = node_depths(list(order), [e for e in edges or [] if e], order)
                out += [(graph, i, r, c) for r, row in enumerate(reading_rows(known, depths), 1) for c, i in enumerate(row, 1)]
            columns = list(zip(*out)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.int32(), pa.int32()))], [x.split()[0] for x in ROWS.split(", ")])

    return graphs.select("graph", "nodes", "edges").mapInArrow(run, ROWS)
