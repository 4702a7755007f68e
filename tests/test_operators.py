"""Grouped operators against values worked out by hand and against brute force."""

import inspect
import itertools
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from concordance.operators import comparison, dedup, graphs, issues, layout, matching, ordering, pages, patches, payloads, scoring, tables, voting
from concordance.session import table
from concordance.functions import seals
from concordance.sources import connectors, files, sinks
from concordance.streaming import incremental

SF = "/root/testdata/sf0.001"
TABLE = "| a | b |\n| --- | --- |\n| 1 | {} |"


def test_table_scores(spark):
    df = spark.createDataFrame([(1, TABLE.format(2), TABLE.format(3)), (2, TABLE.format(2), TABLE.format(2) + "\n| 5 | 6 | 7 |\nend"), (3, "no table", "| x |")], "k long, a string, b string")
    a, b = tables.parse_table(df, ["k"], "a"), tables.parse_table(df, ["k"], "b")
    assert [tuple(r) for r in b.filter("k = 2 and row_index = 2").select("row_index", "col_index", "text").orderBy("col_index").collect()] == [(2, 0, "5"), (2, 1, "6")]
    got = {r.k: r for r in tables.table_scores(tables.cell_diff(a, b, ["k"]), ["k"]).collect()}
    assert set(got) == {1, 2}
    r = got[1]
    assert (r.grid, r.cell, r.header, r.numeric, r.formula, r.table_score, r.omission, r.severe) == (1.0, 0.75, 1.0, 0.65, 1.0, 0.89, 0.0, False)
    assert got[2].hallucination == 0.3333 and got[2].omission == 0.0


def test_caption_chains(spark):
    # a picture, its two captions, a far one, a chart that shares the caption between
    kinds = ["image_caption", "image", "image_caption", "chart", "paragraph", "table_caption", "table"]
    boxes = [[0, 0, 10, 1], [0, 1, 10, 5], [0, 5, 10, 6], [0, 6, 10, 9], [0, 9, 10, 10], [20, 10, 30, 11], [0, 11, 10, 12]]
    assert layout.attach(kinds, boxes) == [[0, 1, 2], [3], [6]]
    rows = [("p", k, kind, [float(x) for x in b]) for k, (kind, b) in enumerate(zip(kinds, boxes))] + [("p", 9, "image", None), ("p", 10, "", [0.0, 0.0, 1.0, 1.0]), ("q", 0, "IMAGE", [5.0, 5.0, 1.0, 1.0])]
    df = spark.createDataFrame(rows, "page string, o int, kind string, bbox array<double>")
    got = layout.crop_groups(layout.sound_blocks(df, "page", "o", "kind", "bbox"), "page").orderBy("page", "group_index").collect()
    assert [(r.page, r.group_index, list(r.members)) for r in got] == [("p", 1, [0, 1, 2]), ("p", 2, [3]), ("p", 3, [6]), ("q", 1, [0])]
    assert got[0].box == [0, 0, 10, 6] and got[3].box == [1, 1, 5, 5]


def test_crop_groups_against_whole_pages(spark):
    raw = table(spark, SF, "layout_blocks").filter("image_id is not null")
    blocks = layout.sound_blocks(raw, "image_id", "block_index", "block_type", "bbox", ("block_row_id",), (*layout.CONTEXT, "page_footer", "title"))
    context = (*layout.CONTEXT, "page_footer", "title")
    got = sorted((r.page, list(r.members)) for r in layout.crop_groups(blocks, "image_id", most_gap=80.0, context=context).collect())
    want = []
    for page, own in blocks.select("image_id", "position", "kind", "box").toPandas().sort_values("position").groupby("image_id"):
        want += [(page, g) for g in layout.attach(own["kind"].tolist(), [list(b) for b in own["box"]], 0.25, 80.0, context)]
    assert got == sorted(want) and got


def test_greedy_is_one_to_one_and_by_score(spark):
    rng = random.Random(5)
    side = lambda n: [(1, 0, k, [float(x), float(y), float(x + 40), float(y + 40)], rng.choice(["abc", "abd", "xyz"]), "paragraph") for k in range(n) for x, y in [(rng.randrange(80), rng.randrange(80))]]
    schema = "k int, page_idx int, pos int, box array<double>, text string, kind string"
    a, b = (spark.createDataFrame(side(n), schema) for n in (9, 7))
    scored = matching.candidates(a, b, ["k"]).cache()
    got = [(r.pos_a, r.pos_b) for r in matching.greedy(scored, ["k"]).collect()]
    want, used_a, used_b = [], set(), set()
    for r in sorted(scored.collect(), key=lambda r: (-r.score, -r.overlap, -r.similarity, r.pos_a, r.pos_b)):
        if r.pos_a not in used_a and r.pos_b not in used_b:
            want.append((r.pos_a, r.pos_b))
            used_a.add(r.pos_a)
            used_b.add(r.pos_b)
    assert sorted(got) == sorted(want) and got
    left = matching.leftovers(a, matching.greedy(scored, ["k"]), ["k"], "a").count()
    assert left == 9 - len(got)


def test_positional_fallback(spark):
    schema = "k int, page_idx int, pos int, box array<double>, text string, kind string"
    far = lambda p, t: (1, 0, p, [float(900 * (t == "q")), 0.0, float(900 * (t == "q") + 10), 10.0], t, "code" if t == "q" else "table")
    a, b = spark.createDataFrame([far(1, "p"), far(2, "p")], schema), spark.createDataFrame([far(5, "q"), far(6, "q")], schema)
    none = matching.align(a, b, ["k"])
    assert none.count() == 0
    assert sorted((r.pos_a, r.pos_b) for r in matching.with_positional(a, b, none, ["k"]).collect()) == [(1, 5), (2, 6)]
    assert matching.with_positional(a, b.limit(1), none, ["k"]).count() == 0


def test_consuming_join():
    anchors = [{"id": "x", "kind": "t", "order": 1}, {"id": "z", "kind": "t", "order": 2}, {"kind": "s", "path": "p"}, {"kind": "s", "path": "p"}]
    specials = [{"id": "q", "kind": "t", "order": 2}, {"id": "x", "kind": "u"}, {"kind": "s", "path": "p"}]
    assert matching.consume(anchors, specials) == [1, 0, 2, None]


def test_patches_in_order(spark):
    blocks = spark.createDataFrame([("i", "b1", 1, "one"), ("i", "b2", 2, "two")], "g string, block_id string, order_index int, text string")
    moves = [("i", "b1", 1, "replace", "x"), ("i", "b1", 2, "replace", "y"), ("i", "b1", 3, "keep", "z"), ("i", "b2", 4, "reject", "w"), ("i", "b9", 5, "add", "new"), ("j", "b1", 6, "add", "first"), ("i", None, 7, "add", "lost")]
    decisions = spark.createDataFrame(moves, "g string, block_id string, decision_no int, decision string, text string")
    got = sorted(tuple(r) for r in patches.apply_patches(blocks, decisions, ["g"]).collect())
    assert got == [("i", "b1", 1, "y", True), ("i", "b2", 2, "two", False), ("i", "b9", 3, "new", True), ("j", "b1", 1, "first", True)]


def test_first_rows_and_unions(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), (None, 3, "z")], "k string, o int, v string")
    assert sorted(r.v for r in dedup.first_rows(df, ["k"], ["o"]).collect()) == ["y", "z"]
    assert sorted(r.v for r in dedup.ranked_union([df.filter("k = 'a'").limit(1), df], ["k"]).collect()) == ["x", "z"]
    assert dedup.top_rows(df, ["k"], ["o"], 1).count() == 2


@pytest.mark.parametrize(
    ("given", "want"),
    [
        ('{"a": 1}', {"a": 1}), ('```json\n{"a": [1, 2]}\n```', {"a": [1, 2]}), ('Here: {"a": 1} done', {"a": 1}), ('{"a": 1, "b": [1, 2', {"a": 1, "b": [1]}),
        ('{"a": "x, y", "b": "cut he', {"a": "x, y", "b": "cut he"}), ("", None), (None, None), ("words", None), ('{"a": {"b": 1}, "c', {"a": {"b": 1}}), ('[{"x": "}"}, {"y": ', [{"x": "}"}, {}]),
    ],
)
def test_json_repair(given, want):
    assert payloads.repaired(given) == want


def test_json_repair_far_from_the_end():
    blocks = ", ".join(f'{{"block_id": "b{k}"}}' for k in range(300))
    damaged = '{"blocks": [{"block_id": "a"}, {"block_id" "x"}, ' + blocks + "]}"
    assert payloads.repaired(damaged) == {"blocks": [{"block_id": "a"}, {}]}


def test_payload_shapes():
    block = {"type": "text", "text": "t"}
    for wrapped in ({"data": {"content_list": [block]}}, {"result": {"payload": {"content_list_v2": [[block]]}}}, {"extraction_results": [{"page": 1, "json_res": json.dumps([block])}]}, {"pdf_info": [{"page_idx": 0, "para_blocks": [block]}]}, [block], {"blocks": [block]}):
        assert payloads.pages_of(wrapped) == [(0, [block])], wrapped
    twice = {"extraction_results": [{"page": 1, "json_res": [block]}, {"page": 2, "json_res": []}, {"page": 1, "json_res": []}]}
    assert payloads.pages_of(twice) == [(0, []), (1, [])]
    order = {"parsing_res_list": [{"block_label": "table", "block_content": "b", "block_order": 2}, {"block_label": "text", "block_content": "a", "block_order": 1}]}
    assert [b["text"] for b in payloads.pages_of(order)[0][1]] == ["a", "b"]
    assert payloads.pages_of({"x": 1}) == payloads.pages_of(None) == []
    assert payloads.block_text({"captions": [{"text": "c"}], "lines": [{"spans": [{"content": "x"}, {"content": "y"}]}], "footnotes": "f"}) == "c x y f"


def test_blocks_of_answers(spark):
    df = spark.createDataFrame([(1, '{"content_list": [{"type": "title", "text": "T", "bbox": [0.1, 0.2, 0.3, 0.4], "page_idx": 1, "text_level": 2}, {"type": "odd"}, 5]}'), (2, None), (3, "broken")], "r long, p string")
    got = payloads.blocks(df, "r", "p").orderBy("page_idx").collect()
    assert [(r.page_idx, r.order_index, r.kind, r.box, r.text) for r in got] == [(0, 1, "paragraph", None, ""), (1, 1, "title", [100, 200, 300, 400], "T")]


# --- graphs ------------------------------------------------------------------------------


def test_depths_have_no_number_of_rounds(spark, monkeypatch):
    monkeypatch.setattr(graphs, "range", lambda low, high: range(low, min(high, 3)), raising=False)
    chain = [(f"n{k}", f"n{k + 1}") for k in range(7)]
    nodes = spark.createDataFrame([("g", f"n{k}", 1) for k in range(8)], "graph string, node_id string, order_index int")
    got = {r.node_id: r.depth for r in graphs.depths(nodes, edges_df(spark, chain)).collect()}
    assert got == {f"n{k}": k + 1 for k in range(8)} and "rounds" not in inspect.signature(graphs.depths).parameters


def edges_df(spark, pairs):
    return spark.createDataFrame([("g", a, b) for a, b in pairs], "graph string, source string, target string")


def test_reachability_through_a_cycle(spark):
    got = {(r.source, r.target) for r in graphs.reachable(edges_df(spark, ["ab", "bc", "ca", "cd"])).collect()}
    assert got == {(x, y) for x in "abc" for y in "abcd"}


def test_depths(spark):
    edges = edges_df(spark, ["ab", "bc", "ac", "de", "ed"])
    nodes = spark.createDataFrame([("g", n, k) for k, n in enumerate("abcde", 1)], "graph string, node_id string, order_index int")
    assert {r.node_id: r.depth for r in graphs.depths(nodes, edges).collect()} == {"a": 1, "b": 2, "c": 2, "d": 4, "e": 5}


def test_distances_without_seeds():
    assert comparison.distances(["b", "a"], {"a": {"b"}, "b": {"a"}}, []) == {"a": 1, "b": 2}
    assert comparison.distances(["a", "b", "c"], {"a": {"b"}}, ["a"]) == {"a": 0, "b": 1, "c": 2}


def test_pruning(spark):
    nodes = spark.createDataFrame([("g", "a", 2, 3, 0.1), ("g", "b", 3, 3, 0.1), ("g", "c", 2, 3, 0.9), ("g", "d", 1, 3, 0.2)], "graph string, node_id string, support int, n int, text_consistency double")
    left = graphs.pruned(nodes, edges_df(spark, ["bc"]), edges_df(spark, ["ab"]))
    assert {r.node_id for r in left.collect()} == {"b", "c", "d"}


def test_assignment_is_optimal():
    rng = random.Random(1)
    for _ in range(100):
        r, c = rng.randint(1, 5), rng.randint(1, 5)
        w = [[rng.random() for _ in range(c)] for _ in range(r)]
        got = [(i, j) for i, j in enumerate(comparison.assignment(w)) if j >= 0]
        best = max(sum(w[i][p[i]] for i in range(r)) if r <= c else sum(w[p[j]][j] for j in range(c)) for p in itertools.permutations(range(max(r, c)), min(r, c)))
        assert abs(sum(w[i][j] for i, j in got) - best) < 1e-9 and len({j for _, j in got}) == len(got) == min(r, c)


def test_comparison_by_hand():
    """Two nodes of one label of which one is taken; an extra node like a taken one; a
    reversed edge; a label that differs."""
    a = [{"node_id": x, "order_index": k, "shape": "rectangle", "text": t, "parent": ""} for k, (x, t) in enumerate([("A", "start"), ("B", "check"), ("C", "check")])]
    f = comparison.Features(a, [{"source": "A", "target": "B", "label": "x"}, {"source": "A", "target": "C", "label": ""}])
    assert f.reach.tolist() == [[False, True, True], [False] * 3, [False] * 3] and f.key(1) == "check:B" and f.key(0) == "start"
    turned = comparison.Comparison(comparison.Features(a, [{"source": "A", "target": "B", "label": "yes"}]), comparison.Features(a[:2], [{"source": "B", "target": "A", "label": "yes"}]))
    turned.node[:] = 0.9
    got = turned.score(np.array([0, 1, -1]))
    assert got["collapsed"] == 0.5 and got["node_f1"] == pytest.approx(0.8) and got["paths"] == 0 and got["split"] == 0
    assert got["wrong"] == [("edge_direction_conflict", 0, 0)] and got["edge_f1"] == 0
    assert got["objective"] == round(0.45 * 0.9 + 0.05, 4) and got["structure"] == round(0.35 * 0.8 + 0.05 - 0.025 * 0.5, 4)
    b = [*a[:2], {**a[0], "node_id": "D", "order_index": 9}]
    other = comparison.Comparison(comparison.Features(a[:2], [{"source": "A", "target": "B", "label": "yes"}]), comparison.Features(b, [{"source": "A", "target": "B", "label": "nein"}]))
    other.node[:] = 0.9
    got = other.score(np.array([0, 1]))
    assert got["node_f1"] == pytest.approx(0.8) and got["split"] == 0.5 and got["wrong"] == [("edge_label_conflict", 0, 0)]


def test_auxiliary_nodes_are_taken_out():
    nodes = [{"node_id": i, "shape": s, "text": t} for i, s, t in (("A", "rectangle", "a"), ("J", "unknown", "join1"), ("K", "rectangle", ""), ("B", "rectangle", "join2"))]
    edges = [{"source": "A", "target": "J", "label": "p"}, {"source": "J", "target": "B", "label": "q"}, {"source": "A", "target": "K", "label": "P"}, {"source": "K", "target": "B", "label": "p"}, {"source": "A", "target": "B", "label": "p"}]
    left, kept = comparison.simplified(nodes, edges)
    assert [n["node_id"] for n in left] == ["A", "B"]
    assert sorted(e["label"] for e in kept) == ["p", "p / q"]


def test_diagram_round_trip(spark):
    code = 'flowchart LR\n  subgraph G["Num"]\n    A("x y")\n    B["s"] --> C{"q"}\n  end\n  C -->|No| D(["e"])\n  D -- maybe --> A\n  classDef hot fill:#f96\n  %% note'
    direction, nodes, edges = graphs.parse_diagram(code)
    assert direction == "LR" and [(n["shape"], n["parent"]) for n in nodes] == [("rounded", "Num"), ("rectangle", "Num"), ("diamond", "Num"), ("ellipse", "")]
    assert [(e["source"], e["target"], e["label"]) for e in edges] == [("B", "C", ""), ("C", "D", "No"), ("D", "A", "maybe")]
    _, again, more = graphs.parse_diagram(graphs.write_diagram(nodes, edges))
    assert [(n["node_id"], n["shape"], n["text"]) for n in again] == [(n["node_id"], n["shape"], n["text"]) for n in nodes] and more == edges
    assert graphs.parse_diagram(None) == (None, [], []) and graphs.parse_diagram("```mermaid\ngraph TD\nA --> B\n```")[2][0]["target"] == "B"
    rows = [(n["node_id"], n["text"]) for r in table(spark, SF, "snapshots").filter("code is not null").collect() for n in graphs.parse_diagram(r.code)[1]]
    assert len(rows) > 50


def test_graph_comparison():
    nodes = [{"node_id": n, "order_index": k, "shape": "rectangle", "text": t, "parent": ""} for k, (n, t) in enumerate([("A", "start"), ("B", "check"), ("C", "done")], 1)]
    edges = [{"source": "A", "target": "B", "label": "yes"}, {"source": "B", "target": "C", "label": ""}]
    same = comparison.compare_graphs(nodes, edges, nodes, edges)
    assert same["node_f1"] == same["edge_f1"] == same["paths"] == same["objective"] == 1.0
    renamed = [{**n, "node_id": "z" + n["node_id"]} for n in reversed(nodes)]
    moved = [{**e, "source": "z" + e["source"], "target": "z" + e["target"]} for e in edges]
    assert comparison.compare_graphs(nodes, edges, renamed, moved)["edge_f1"] == 1.0
    back = [{**e, "source": e["target"], "target": e["source"]} for e in edges]
    turned = comparison.compare_graphs(nodes, edges, nodes, back)
    assert turned["edge_f1"] < 1 and 0 <= turned["structure"] < same["structure"]
    assert comparison.compare_graphs([], [], [], [])["objective"] == 1.0 and comparison.compare_graphs(nodes, edges, [], [])["objective"] == 0.0
    assert comparison.diagram_score(0.95, 1, 1, 1, 1, 1, 1) == pytest.approx(0.9775) and comparison.diagram_score(1, 1, 1, 1, 1, 1, 1, valid=False) == 0.2


def test_reading_rows():
    node = lambda i, y, h=0.02, x=0.1: {"node_id": i, "order_index": 1, "box": [x, y - h / 2, x + 0.1, y + h / 2]}
    rows = layout.reading_rows([node("a", 0.10, x=0.5), node("b", 0.11), node("c", 0.30), node("d", 0.31), node("e", 0.6)])
    assert [sorted(r) for r in rows] == [["a", "b"], ["c", "d"], ["e"]] and rows[0] == ["b", "a"]
    # depth moves a node down; its own height widens its tolerance
    assert layout.reading_rows([node("a", 0.1), node("b", 0.1)], {"b": 2}) == [["a"], ["b"]]
    assert layout.reading_rows([node("a", 0.1), node("b", 0.1), node("c", 0.2, h=0.2)]) == [["a", "b", "c"]]
    assert layout.reading_rows([]) == [] and layout.reading_rows([{"node_id": "N2", "box": None}, {"node_id": "N1", "box": None}]) == [["N1"], ["N2"]]
    assert layout.node_depths(["a", "b", "c", "d"], [{"source": "a", "target": "b"}, {"source": "b", "target": "c"}, {"source": "a", "target": "c"}, {"source": "d", "target": "d"}], {"a": 1, "b": 2, "c": 3, "d": 4}) == {"a": 1, "b": 2, "c": 2, "d": 4}


# --- sources, sinks, streaming -------------------------------------------------------------


def test_image_scan(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name in ("b_p1_r2_chart.png", "a.JPG", "note.txt"):
        (tmp_path / "in" / name).write_bytes(b"x")
    got = files.images(spark, str(tmp_path / "in")).collect()
    assert [(r.image_id, r.file_ext, r.merge_order, r.is_page_crop) for r in got] == [("a", "jpg", None, False), ("b_p1_r2_chart", "png", "2", True)]
    url = files.images(spark, str(tmp_path / "in"), content=True).select(files.data_url(F.col("content"), F.col("file_ext")).alias("u")).first().u
    assert url == "data:image/jpeg;base64,eA=="
    (tmp_path / "in" / "a.png").write_bytes(b"y")
    with pytest.raises(Exception, match="two pictures named a"):
        files.images(spark, str(tmp_path / "in")).collect()


def test_layout_and_gold_files(spark, tmp_path):
    (tmp_path / "l" / "p3").mkdir(parents=True)
    (tmp_path / "l" / "p1.json").write_text("[1]")
    (tmp_path / "l" / "p1_layout.json").write_text("[2]")
    (tmp_path / "l" / "p3" / "layout.json").write_text("[3]")
    assert sorted((r.page, r.payload) for r in files.layouts(spark, str(tmp_path / "l")).collect()) == [("p1", "[1]"), ("p3", "[3]")]
    for split, body in (("train", {"x": {"mermaid": "a"}, "y": {"mermaid": "b"}}), ("test", {"y": {"mermaid": "c"}})):
        (tmp_path / f"{split}_full.json").write_text(json.dumps(body))
    assert sorted((r.id, r.mermaid) for r in files.gold(spark, str(tmp_path)).collect()) == [("x", "a"), ("y", "c")]
    (tmp_path / "m.yaml").write_text(json.dumps({"models": [{"provider": "http", "name": "m"}, {"provider": "none"}, {"provider": "http", "enabled": False}]}))
    assert connectors.enabled(files.config(str(tmp_path / "m.yaml")), 9) == [{"timeout": 9, "provider": "http", "name": "m"}]


def test_connector_rows(spark):
    class Flaky:
        def __init__(self):
            self.calls = 0

        def analyze(self, item):
            self.calls += 1
            if item["image_id"] == "bad" or self.calls == 1:
                raise ValueError("no answer")
            return {"raw_text": item["image_id"].upper()}

    items = spark.createDataFrame([("a",), ("bad",)], "image_id string").coalesce(1)
    got = {r.image_id: r for r in connectors.call(items, "m", Flaky, retries=1, provider="x_local", wait=lambda s: None).collect()}
    assert got["a"].success and got["a"].raw_text == "A" and got["a"].source_type == "local_service"
    assert not got["bad"].success and got["bad"].error == "ValueError: no answer" and got["bad"].latency_ms >= 0
    assert connectors.message_text({"choices": [{"message": {"content": [{"text": "a"}, {"text": "b"}]}}]}) == "ab"
    again = connectors.replay(items, table(spark, SF, "model_outputs"), "anchor-pro").collect()
    assert {r.error for r in again} == {"no recorded answer"}


def test_markdown_sink(spark, tmp_path):
    rows = [(1, 0, 2, "b", "title", "T", 2), (1, 0, 1, "a", "code", "x", None), (1, 2, 1, "c", "paragraph", "p", None), (1, 0, 3, "d", "list", "", None)]
    df = spark.createDataFrame(rows, "k int, page_idx int, order_index int, block_id string, kind string, text string, text_level int").withColumn("box", F.lit(None).cast("array<int>"))
    pages = df.withColumn("fragment", sinks.markdown_fragment(F.col("kind"), F.col("text"), F.col("text_level"), F.array().cast("array<string>")))
    got = {r.page_idx: r.markdown for r in sinks.page_markdown(pages, ["k"]).collect()}
    assert got == {0: "```\nx\n```\n\n## T", 2: "p"}
    (doc,) = sinks.extraction_results(df, ["k"]).collect()
    assert doc.total_pages == 3 and [len(p["json_res"]) for p in json.loads(doc.extraction_results)] == [3, 0, 1]
    crops = spark.createDataFrame([("p", "10", "x10", "ten"), ("p", "9", "x9", "nine"), ("p", "z", "xz", "last"), ("p", "1", "x1", " ")], "page_output_id string, merge_order string, image_id string, markdown string")
    assert sinks.merged_pages(crops).first().markdown == "nine\n\nten\n\nlast"
    sinks.write_stage(df, str(tmp_path), "final", "kind")
    assert spark.read.json(str(tmp_path / "final")).count() == 4


def test_stream_equals_batch(spark, tmp_path):
    answers = table(spark, SF, "model_outputs").filter("captured_at is not null and image_id is not null").orderBy("output_id")
    answers.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = incremental.streamed(spark, str(tmp_path / "in"), answers.schema, files_per_trigger=1)
    query = incremental.tumbling(stream, "captured_at", lateness="3650 days").writeStream.format("memory").queryName("hourly").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination(120)
    want = sorted(map(tuple, incremental.tumbling(answers, "captured_at").collect()))
    assert sorted(map(tuple, spark.table("hourly").collect())) == want and want
    kept = incremental.summaries(stream, str(tmp_path / "out"), str(tmp_path / "check"))
    kept.awaitTermination(120)
    want = incremental.latest(answers)
    got = incremental.current(spark, str(tmp_path / "out")).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_single_block_view(spark):
    rows = [(1, 0, 2, "b", "two", [5.0, 5.0, 9.0, 9.0], "chart"), (1, 0, 1, "a", "one", [1.0, 2.0, 6.0, 6.0], "image"), (1, 1, 1, "c", " ", None, "image")]
    df = spark.createDataFrame(rows, "k int, page_idx int, order_index int, block_id string, text string, box array<double>, kind string")
    (r,) = layout.single_block_view(df, ["k"]).collect()
    assert (r.text, r.box, r.kind, r.blocks) == ("one\n\ntwo", [1, 2, 9, 9], "image", 3)


def test_running_sums_and_neighbours(spark):
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.5 else None if rng.random() < 0.1 else rng.choice("abc"), k, rng.randrange(5)) for k in range(400)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, o int, v int").repartition(7)
    got = {(r.k, r.o): r.s for r in ordering.running_sum(df, ["k"], ["o"], F.col("v"), "s").collect()}
    want, total = {}, {}
    for k, o, v in sorted(rows, key=lambda r: r[1]):
        total[k] = total.get(k, 0) + v
        want[k, o] = total[k]
    assert got == want
    after = {(r.k, r.o): r.n for r in ordering.with_next(df, ["k"], ["o"], {"o": "n"}).collect()}
    for k in total:
        own = sorted(o for kk, o, _ in rows if kk == k)
        assert [after[k, o] for o in own] == [*own[1:], None]
    assert ordering.numbered(df.limit(0), ["k"], ["o"], "n").count() == 0


def test_labels_and_agreement(spark):
    label = scoring.label_of({"image_type": "Table", "caption": " c ", "visible_text": ["a", " ", 3], "structured_label": {"kind": "odd", "content": "x"}})
    assert (label["image_type"], label["caption"], label["visible_text"], label["kind"], len(label["warnings"])) == ("table", "c", ["a", "3"], "text", 1)
    assert scoring.label_of({"issue_id": 1}) is None and scoring.label_of([1]) is None
    assert scoring.structure_score(["none"] * 3, [""] * 3) == 0.95
    assert round(scoring.structure_score(["none", "none", "text"], [""] * 3), 4) == 0.8833
    assert scoring.structure_score([], []) == 0.0 and scoring.structure_score(["mermaid"], ["graph TD\nA --> B"]) == 0.5
    assert scoring.structure_score(["mermaid"] * 2, ["graph TD\nA --> B"] * 2) > 0.9
    rows = [(1, "i", "m", "seal", "c", ["a"], "none", "", "红色印章 测试有限公司"), (2, "i", "n", "seal", "c", ["a"], "none", "", "测试有限公司9"), (3, "j", "m", "table", "x", [], "text", "y", ""), (4, "j", "n", "chart", "x", [], "text", "y", "")]
    df = spark.createDataFrame(rows, "record_id long, image_id string, model_name string, image_type string, caption string, visible_text array<string>, kind string, content string, seal_text string")
    got = {r.image_id: r for r in scoring.consensus(df).collect()}
    assert got["i"].stamp_only and got["i"].overall_score == 1.0
    assert not got["j"].stamp_only and got["j"].type_agreement == 0.5 and got["j"].majority_type == "table"


def test_seal_names(spark):
    one = lambda *c: spark.range(1).select(*c).first()
    L = F.lit
    assert tuple(one(*(seals.primary(L(x)) for x in ("测试公司 12", "12 abc de", "123", "", " ABC有限 测试有限公司 ")))) == ("测试公司", "abc", "", "", "测试有限公司")
    assert tuple(one(seals.specific(L("测试公司")), seals.specific(L("红色公章")), seals.specific(L("abcd")))) == (True, False, False)


def test_issues_and_verdicts(spark):
    schema = "k int, page_idx int, pos int, box array<double>, text string, kind string"
    here = [0.0, 0.0, 10.0, 10.0]
    base = spark.createDataFrame([(1, 0, 1, here, "abc", "image"), (1, 0, 2, [50.0, 50.0, 60.0, 60.0], "", "table")], schema)
    other = spark.createDataFrame([(1, 0, 1, here, "xyz", "chart"), (1, 0, 2, [50.0, 50.0, 60.0, 60.0], "new", "table"), (1, 0, 3, [90.0, 90.0, 99.0, 99.0], "more", "image"), (1, 0, 4, [70.0, 90.0, 72.0, 92.0], "para", "paragraph")], schema)
    found = issues.detect(base, other, matching.align(base, other, ["k"]), ["k"])
    assert [(r.issue_id, r.issue_type, r.pos_b) for r in found.orderBy("issue_id").collect()] == [("I001", "type_disagreement", 1), ("I002", "missing_text", 2), ("I003", "unmatched_candidate", 3)]
    answers = spark.createDataFrame([(1, '{"issue_id": "I001", "decision": "Use_It", "patch": {"text": "t"}}'), (2, "no json"), (3, '{"issue_id": "I002", "decision": "odd", "reason": "r"}'), (4, None), (5, '{"broken')], "r long, t string")
    done = {r.issue_id: r for r in issues.outcomes(found, issues.verdicts(answers, "r", "t").withColumn("k", F.lit(found.first().k)), ["k"]).collect()}
    assert (done["I001"].decision, done["I001"].patch_text, done["I002"].decision, done["I002"].reason, done["I003"].open) == ("use_reference", "t", "keep_anchor", "r", True)
    conflict = lambda a, b, c=True: spark.range(1).select(issues.texts_conflict(F.array(*map(F.lit, a)), F.array(*map(F.lit, b)), c)).first()[0]
    assert [conflict(["a b"], ["AB"]), conflict(["ab"], ["abc"]), conflict(["ab"], ["abc"], False), conflict([""], ["x"]), conflict(["ab"], ["cd"])] == [False, False, True, False, True]


def test_cut_answers_keep_their_last_string():
    assert payloads.repaired('{"a": 1, "reason": "it was mo') == {"a": 1, "reason": "it was mo"}
    assert payloads.repaired('{"a": 1, "b": "x\\u00') == {"a": 1, "b": "x"} and payloads.repaired('{"a": 1, "b": "x\\') == {"a": 1, "b": "x"}
    assert payloads.repaired('{"a": 1, "rea') == {"a": 1} and payloads.repaired('{"a": "x\\\\') == {"a": "x\\"}
    deep: object = [{"type": "text", "text": "x"}]
    for k in range(40):
        deep = {payloads.WRAPPERS[k % len(payloads.WRAPPERS)]: deep}
    assert payloads.pages_of(deep) == [(0, [{"type": "text", "text": "x"}])]


def test_verdicts_settle_issues_of_their_own_document(spark):
    found = spark.createDataFrame([("p", "I001", "text_conflict"), ("q", "I001", "text_conflict")], "k string, issue_id string, issue_type string")
    given = spark.createDataFrame([("p", 1, "I001", "merge", "t", "r")], "k string, record_id long, issue_id string, decision string, patch_text string, reason string")
    assert {r.k: (r.decision, r.open) for r in issues.outcomes(found, given, ["k"]).collect()} == {"p": ("merge", False), "q": ("keep_anchor", True)}


def test_boxes_of_any_size_meet(spark):
    """A box of a million units, tiny ones, and the best of several."""
    rows = [(1, 0, [0.0, 0.0, 1e6, 1e6], False), (1, 1, [10.0, 10.0, 12.0, 12.0], True), (1, 2, [0.0, 0.0, 9e5, 1e6], True), (1, 3, [10.0, 10.0, 12.0, 13.0], False), (2, 4, [10.0, 10.0, 12.0, 12.0], True), (1, 5, [-50.0, -9.0, -40.0, -2.0], False), (1, 6, [-45.0, -9.0, -40.0, -2.0], True), (1, 7, [5.0, 5.0, 5.0, 5.0], False)]
    df = spark.createDataFrame(rows, "k int, pos int, box array<double>, t boolean")
    got = {r.pos: r.target_pos for r in matching.best_overlap(df, ["k"], F.col("t")).collect()}
    assert got == {0: 2, 3: 1, 5: 6}


def test_a_large_page_is_not_compared_pair_by_pair(spark):
    """Best overlaps of a crowded page equal brute force, odd boxes too, and few of its pairs are looked at."""
    rng = np.random.default_rng(3)
    corner, size = rng.uniform(0, 800, (2400, 2)), 10 ** rng.uniform(-3, 2.3, (2400, 2))
    corner[:500], size[:500] = rng.integers(0, 20, (500, 2)), rng.integers(0, 7, (500, 2))  # many ties
    box, target = np.hstack([corner, corner + size]), rng.random(2400) < 0.4
    cut = np.prod([np.maximum(0, np.minimum(box[:, None, k + 2], box[None, :, k + 2]) - np.maximum(box[:, None, k], box[None, :, k])) for k in (0, 1)], axis=0)
    area = (box[:, 2] - box[:, 0]) * (box[:, 3] - box[:, 1])
    union = area[:, None] + area[None, :] - cut
    share = np.where(target[None, :] & (union > 0), cut / np.where(union > 0, union, 1), 0)
    rounded = np.floor(share * 10000 + 0.5 + 1e-9) / 10000
    want = {int(k): (int(rounded[k].argmax()), rounded[k].max()) for k in np.flatnonzero(~target) if rounded[k].max() > 0}
    rows = [("p", k, box[k].tolist(), bool(target[k])) for k in range(2400)]
    schema = "k string, pos long, box array<double>, t boolean"
    df = spark.createDataFrame(rows, schema).repartition(4)
    got = {r.pos: (r.target_pos, r.overlap) for r in matching.best_overlap(df, ["k"], F.col("t"), most_pairs=1000).collect()}
    assert got == want

    far = float("inf")
    odd = [(k, 3000 + n, b, n % 2 == 0) for k in "pq" for n, b in enumerate([[0.0, 0.0, far, far]] * 2 + [[5.0, 5.0, 5.0, 9.0]] * 2 + [[0.0, 0.0, float("nan"), 9.0]] * 2 + [[1e300, 0.0, 1.1e300, 1e-200]] * 2 + [[1.0, 1.0, 3.0, 3.0]] * 2)]
    small = spark.createDataFrame([r for r in rows if r[1] % 8 == 0] + odd, schema).repartition(4)
    searched, compared = ({(r.k, r.pos): (r.target_pos, str(r.overlap)) for r in matching.best_overlap(small, ["k"], F.col("t"), most_pairs=m).collect()} for m in (0, 10**9))
    assert searched == compared and searched["q", 3009] == searched["p", 3009]

    c = F.col("box")
    boxes = df.select("k", "pos", "t", *(c[n].alias(e) for n, e in enumerate(("x0", "y0", "x1", "y1"))), (c[2] - c[0]).alias("w"), (c[3] - c[1]).alias("h")).filter("w > 0 and h > 0").withColumn("area", F.col("w") * F.col("h"))
    seen = {(r.pos, r.target_pos) for r in matching.alike(boxes.filter("not t"), boxes.filter("t"), ["k"], 0.45).collect()}
    due = set(zip(*(x.tolist() for x in np.nonzero(~target[:, None] & (share >= 0.45)))))
    assert due <= seen and len(seen) < 0.1 * target.sum() * (~target).sum()


def test_edges_belong_to_fused_nodes(spark):
    claims = spark.createDataFrame([("g", "m", "A", "B", "x"), ("g", "m", "A", "B", " x "), ("g", "m", "A", "B", "y"), ("g", "n", "A", "B", "x"), ("g", "n", "A", "Z", ""), ("g", "n", "A", "C", "")], "graph string, source_model string, source string, target string, label string")
    claimed = spark.createDataFrame([("g", m, x) for m in "mn" for x in "ABC"], "graph string, source_model string, node_id string")
    fused = claimed.filter("node_id != 'C'").select("graph", "node_id").distinct()
    sources = spark.createDataFrame([("g", 2)], "graph string, n int")
    (edge,) = voting.fuse_edges(claims, sources, fused).collect()
    assert (edge.support, edge.labels, edge.status) == (2, ["x", "x", "y"], "fused")
    errors = {(r.source_model, r.target, r.error) for r in voting.edge_errors(claims, claimed, fused).collect()}
    assert errors == {("m", "B", "duplicate"), ("n", "Z", "unknown_node"), ("n", "C", "unfused_node")}


def test_upload_and_prompts(spark, tmp_path):
    form, kind = connectors.Upload("http://x/", fields={"a": "b"}).body({"image_id": "i", "content": b"PNG"})
    mark = kind.split("boundary=")[1]
    assert form.count(mark.encode()) == 3 and b'filename="i.png"' in form and b"PNG" in form and b'name="a"\r\n\r\nb' in form
    body, kind = connectors.Upload("http://x", form=False).body({"image_id": "i", "content": b"PNG"})
    assert kind == "application/json" and json.loads(body) == {"filename": "i.png", "image": "UE5H"}
    assert connectors.jsonable({1: (b"a", {2, 1}), "o": type("T", (), {})()}) == {"1": ["YQ==", [1, 2]], "o": {}}
    models = [{"provider": "qa_local"}, {"provider": "zz", "role": " Judge "}, {"provider": "zz"}]
    assert [connectors.role_of(m, {"qa": "anchor"}) for m in models] == ["anchor", "judge", "zz"] and connectors.pick_role(models, "judge", {}) is models[1] and connectors.pick_role(models, "none", {}) is None
    assert connectors.request_control("", True, False, True)["thinking"] == "disabled_then_default" and connectors.with_control([1], {"mode": "x"}) == {"response": [1], "_request_control": {"mode": "x"}}
    assert connectors.prompt_text(" p ", "seal", {"a": 1}).startswith("p\n\nThese are candidates") and connectors.prompt_text("p", "", None) == "p"
    (tmp_path / "p.yaml").write_text("one: |\n  first line\n  second\ntwo: 'x'\nempty: ''\n")
    assert files.prompt(str(tmp_path / "p.yaml"), "one") == "first line\nsecond" and files.prompt(str(tmp_path / "p.yaml"), "two") == "x"
    for bad in ("empty", "three"):
        with pytest.raises(ValueError, match=bad):
            files.prompt(str(tmp_path / "p.yaml"), bad)
    for kind, root in (("json", None), ("service", "x"), ("other", "x")):
        with pytest.raises(ValueError, match="layout source"):
            files.layout_source(spark, kind, root)
    candidates = spark.createDataFrame([("k", 1, "gone"), ("k", 2, "b"), ("k", 3, "c"), ("n", 1, "gone")], "key string, rank int, image_path string")
    pictures = spark.createDataFrame([("b", "png", bytearray(b"x")), ("c", "png", bytearray(b"y"))], "image_path string, file_ext string, content binary")
    assert [tuple(r) for r in files.first_picture(candidates, pictures).collect()] == [("k", "b", "data:image/png;base64,eA==")]


def test_node_conflicts_with_boxes(spark):
    rows = [("g", "N1", "m", 1, 1, "diamond", [0.0, 0.0, 0.1, 0.1]), ("g", "N1", "n", 4, 1, "unknown", [0.5, 0.5, 0.6, 0.6]), ("g", "N1", "o", 1, 2, "ellipse", None), ("g", "N2", "m", None, 1, "diamond", [0.0, 0.0, 0.1, 0.1]), ("g", "N2", "n", 4, 1, "diamond", [0.2, 0.1, 0.3, 0.2])]
    df = spark.createDataFrame(rows, "graph string, node_id string, source_model string, row int, col int, shape string, box array<double>")
    got = {(r.node_id, r.model_a + r.model_b, r.conflict) for r in voting.node_conflicts(df).collect()}
    assert got == {("N1", "mn", "row_conflict"), ("N1", "mn", "far_apart"), ("N1", "mn", "position_conflict"), ("N1", "no", "row_conflict"), ("N1", "mo", "shape_conflict"), ("N2", "mn", "far_apart")}


def test_merged_blocks(spark):
    schema = "k int, page_idx int, pos int, box array<double>, text string, kind string"
    here = [0.0, 0.0, 10.0, 10.0]
    base = spark.createDataFrame([(1, 0, 1, here, "abc", "image"), (1, 0, 2, [50.0, 50.0, 60.0, 60.0], "", "table"), (1, 1, 1, None, "z", "title")], schema)
    other = spark.createDataFrame([(1, 0, 1, here, "abd", "image"), (1, 0, 2, [50.0, 50.0, 60.0, 60.0], "new", "table"), (1, 0, 3, [90.0, 90.0, 99.0, 99.0], "more", "image"), (1, 0, 4, None, "no", "list")], schema)
    rows = matching.merged(base, other, matching.align(base, other, ["k"]), ["k"], ("image", "table")).orderBy("page_idx", "pos").collect()
    assert [(r.page_idx, r.pos, r.text, r.origin) for r in rows] == [(0, 1, "abc", "matched"), (0, 2, "new", "filled"), (0, 3, "more", "added"), (1, 1, "z", "base")]


def test_final_markdown_takes_revisions(spark):
    rows = [("p", 1, 1, "title", "T", None, None), ("p", 2, 2, "table", "| a |", [0.0, 0.0, 1.0, 1.0], "table"), ("p", 2, 5, "table", "| b |", [0.0, 0.0, 1.0, 1.0], "table"), ("p", 3, 3, "image", "", None, "seal"), ("p", 3, 6, "chart", "graph", None, "diagram"), ("q", 1, 4, "paragraph", "x", None, None)]
    df = spark.createDataFrame(rows, "page string, o long, r long, kind string, text string, box array<double>, special string")
    got = {r.page: (r.fragments, r.markdown) for r in pages.final_markdown(df, "page", "o", "r").collect()}
    assert got == {"p": (2, "# T\n\n| b |"), "q": (1, "x")}


def test_only_hopeless_swaps_are_passed_over():
    rng = random.Random(8)
    for _ in range(25):
        side = lambda n: ([{"node_id": f"N{k}", "order_index": k, "shape": rng.choice(["rectangle", "diamond"]), "text": rng.choice(["start", "check", "checks", "done", "stop"]), "parent": ""} for k in range(n)], [{"source": f"N{rng.randrange(n)}", "target": f"N{rng.randrange(n)}", "label": rng.choice(["", "yes"])} for _ in range(n)])
        c = comparison.Comparison(comparison.Features(*side(rng.randint(2, 6))), comparison.Features(*side(rng.randint(2, 6))))
        mapping = np.array(comparison.assignment(c.node))
        least = c.score(mapping)["objective"] + 1e-6
        kept, taken = set(c._promising(mapping, least)), np.flatnonzero(mapping >= 0).tolist()
        for x, y in itertools.combinations(taken, 2):
            trial = mapping.copy()
            trial[[x, y]] = trial[[y, x]]
            assert c.score(trial)["objective"] <= least or (x, y) in kept


def test_cleaned_diagrams():
    code = '```mermaid\r\ngraph TD\r\nA[one <br> "two"] -->|yes<br/>no| B{"ok"}\nC((x)) --> D( y )\nE[] --> F\n%% note\n```'
    want = 'graph TD\nA["one <br/> \\"two\\""] -->|yes / no| B{"ok"}\nC(("x")) --> D("y")\nE[] --> F\n%% note'
    assert graphs.cleaned(code) == want and graphs.cleaned(None) == "" and graphs.cleaned(graphs.cleaned("A[x]")) == 'A["x"]'


def test_verdicts_in_any_wrapping(spark):
    rows = [(1, '{"issue_id": "I1", "decision": "Use_It", "patch": {"text": "t"}}'), (2, 'Here:\n```json\n{"issue_id": "I2", "decision": "merge", "reason": " "}\n```'), (3, '{"issue_id": "I3", "decision": "add_block", "reason": "it was cu'), (4, "issue_id"), (5, None), (6, '{"issue_id": null}')]
    df = spark.createDataFrame(rows, "r long, t string")
    got = sorted(tuple(r) for r in issues.read_verdicts(df, "r", "t").collect())
    assert got == [(1, "I1", "use_reference", "t", "patch_applied"), (2, "I2", "merge", None, "patch_applied"), (3, "I3", "add_block", None, "it was cu")]
    empty = spark.createDataFrame([], "k int, pos int, box array<double>, t boolean")
    assert matching.best_overlap(empty, ["k"], F.col("t")).count() == 0
