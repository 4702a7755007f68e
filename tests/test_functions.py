"""Scalar functions against values worked out by hand."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from concordance.functions import geometry, labels, predicates, text
from concordance.operators import decisions, voting


@pytest.fixture(scope="module")
def one(spark):
    df = spark.range(1)
    return lambda *columns: df.select(*columns).collect()[0]


L = F.lit

def null():
    return F.lit(None).cast("string")



def box(*v):
    return F.array(*(F.lit(float(x)) for x in v))


def strings(*v):
    return F.array(*(F.lit(x) for x in v)).cast("array<string>")


def test_block_match_score(one):
    a, b = box(0, 0, 100, 100), box(50, 0, 150, 100)
    overlap, similar, kind = one(geometry.iou(a, b), text.alignment_similarity(L("abcd"), L("abce")), labels.type_compatibility(L("chart"), L("image")))
    assert (overlap, similar, kind) == (0.3333, 0.5, 0.75)
    assert one(F.round(0.5 * L(overlap) + 0.3 * L(similar) + 0.2 * L(kind), 4))[0] == 0.4667 or round(0.5 * overlap + 0.3 * similar + 0.2 * kind, 4) == 0.4667


def test_quorum(one):
    assert list(one(*(voting.quorum(L(n)) for n in range(1, 8)))) == [1, 2, 2, 3, 4, 4, 5]


def test_scores_and_thresholds(one):
    s = one(decisions.validation_scores(L(1.0), L(0.0), L(False), L(False)))[0]
    assert tuple(s) == (0.9, 0.85, 0.1)
    assert one(decisions.accept_score(L(0.9), L(0.9), L(0.85), L(0.1)))[0] == 0.8875
    assert list(one(*(decisions.threshold(k, L(n)) for k in ("overall", "risk") for n in (2, 3)))) == [0.85, 0.8, 0.3, 0.35]
    assert list(one(*(decisions.many_low_support(L(a), L(b)) for a, b in ((0, 5), (1, 0), (2, 2), (3, 5), (3, 6), (2, 3))))) == [False, True, True, True, False, False]


def test_decisions(one):
    good = {"overall": L(0.9), "type": L(1.0), "structure": L(0.9), "evidence": L(0.9), "validator": L(0.9), "risk": L(0.1)}
    ask = lambda m, s, p, e=0, **o: decisions.decide(L(m), L(s), L(p), {**good, **{k: L(v) for k, v in o.items()}}, L(e))
    assert list(one(ask(2, 2, 2), ask(2, 0, 0), ask(2, 2, 0), ask(2, 2, 1), ask(2, 2, 2, 1), ask(2, 2, 2, type=0.9), ask(3, 3, 3, type=0.9), ask(3, 3, 3, risk=0.36))) == ["accepted", "failed", "failed", "review", "review", "review", "accepted", "review"]


def test_numbers_and_units(one):
    got = one(*(text.numbers_with_units(L(x)) for x in ("1,234 kg", "50hz", "none", "-2.5% and 3")))
    assert [[tuple(y) for y in x] for x in got] == [[(1234.0, "kg")], [(50.0, "h")], [], [(-2.5, "%"), (3.0, "")]]
    a, b = text.numbers_with_units(L("2 kg")), text.numbers_with_units(L("3 kg"))
    none = text.numbers_with_units(L(""))
    assert one(text.numeric_list_similarity(a, b), text.numeric_list_similarity(none, none), text.numeric_list_similarity(a, none)) == (0.3, 1.0, 0.0)


def test_first_seen(one):
    assert one(text.first_seen(strings("A b", "ab", "C", "", None), "squeezed"))[0] == ["A b", "C"]
    assert one(text.first_seen(strings("A", "a", " A"), "exact"))[0] == ["A", "a", " A"]
    assert one(text.first_seen(strings("A", "a", " A"), "collapsed"))[0] == ["A"]
    assert one(text.first_seen(strings(), "exact"))[0] == []


def test_crop_ids(one):
    got = one(*(labels.crop_parts(L(x)) for x in ("doc_p_1_r_2_x", "rep_p3_r12_chart", "a_b_003_chart", "plain")))
    assert [tuple(x) for x in got] == [("doc_p_1", "2"), ("rep_p3", "12"), ("a_b", "003"), (None, None)]


def test_majority(one):
    v = strings("X", "Y", "Y", "X")
    assert one(voting.majority(v), voting.majority_ratio(v)) == ("X", 0.5)
    assert one(voting.majority(strings()), voting.majority_ratio(strings())) == (None, 0.0)
    assert one(voting.representative_shape(strings("unknown", "b", "a")), voting.representative_shape(strings("unknown")))[0:2] == ("a", "unknown")
    assert one(voting.representative_text(strings("Ab c", "ab  c", "zz", None)), voting.representative_text(strings()))[0:2] == ("ab  c", "")


def test_empty_texts(one):
    e = L("")
    assert one(text.alignment_similarity(e, e), text.char_similarity(e, e), text.field_similarity(e, e), text.cell_similarity(e, e), text.keyword_similarity(e, e), text.field_equality(e, null())) == (1.0, 0.0, 0.5, 1.0, 0.0, 0.5)
    assert one(text.list_overlap(strings(), strings()), text.list_overlap(strings("a"), strings()))[0:2] == (0.5, 0.0)
    assert one(text.joined_errors(L("a"), null(), L("b")), text.joined_errors(null(), L("")))[0:2] == ("a; b", None)
    assert one(text.clamp(L(1.5)), text.clamp(F.lit(None).cast("double")))[0:2] == (1.0, None)


def test_normal_forms(one):
    assert one(text.collapsed(L("  A  b ")), text.squeezed(L("A b\n")), text.compact(L("A-b 1 中")), text.without_title_prefix(L("Figure 3: Big")), text.cell_text(L("1,234 x  y")), text.nfkc(L("Ｎｏ")))[0:6] == ("a b", "ab", "ab1中", "Big", "1234 x y", "No")
    assert one(text.formulas(L(r"a $x$ b $$y$$ c \(z\) $x$")))[0] == ["y", "z", "x"]
    assert one(text.row_cells(L("| a |  | b|")), text.is_separator(L("|:--|-:|")), text.is_separator(L("| a |")))[0:3] == (["a", "", "b"], True, False)


def test_boxes(one):
    assert one(geometry.per_mille(box(0.1, 0.2, 0.3, 1)), geometry.per_mille(box(1.5, 2.5, 2000, -3)))[0:2] == ([100, 200, 300, 1000], [2, 2, 1000, 0])
    assert one(geometry.sorted_corners(box(5, 6, 1, 2)), geometry.sorted_corners(box(1, 2)))[0:2] == ([1, 2, 5, 6], None)
    assert one(geometry.horizontal_overlap(box(0, 0, 10, 1), box(5, 0, 25, 1)), geometry.vertical_gap(box(0, 0, 1, 1), box(0, 3, 1, 4)), geometry.center_distance(box(0, 0, 2, 2), box(3, 4, 5, 6)))[0:3] == (0.5, 2.0, 5.0)
    assert one(geometry.to_pixels(box(0.1, 0.1, 0.2, 0.2), L(1000), L(500), 5), geometry.to_pixels(box(0, 0, 1000, 1000), L(100), L(100), 3))[0:2] == ([95, 45, 205, 105], [0, 0, 100, 100])


def test_labels(one):
    assert one(labels.node_id(L("node 7"), L(3)), labels.node_id(L("x"), L(3)), labels.node_index(L("N012")), labels.confidence(L("0.9")), labels.confidence(L("0.5")), labels.confidence(null()), labels.block_type(L(" Header ")), labels.block_type(null()))[0:8] == ("N007", "N003", 12, "high", "medium", "medium", "page_header", "paragraph")


def test_wordings(one):
    got = one(labels.ocr_role(L("公章")), labels.ocr_role(L("Watermark ")), labels.ocr_role(L("axis")), labels.confidence(L("strong")), labels.confidence(L("weak")), labels.image_type(L("流程图")), labels.image_type(L("Flow chart of seals")), labels.image_type(L("a graph with table")), labels.image_type(L("photo")), labels.image_type(L("screenshot")), labels.image_type(L(" "), L("table")), labels.image_type(L("else")))
    assert got[0:12] == ("seal", "watermark", "other", "high", "low", "flowchart", "flowchart", "chart", "natural_image", "screenshot", "table", "unknown")


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.text(max_size=12), st.text(max_size=12)), min_size=1, max_size=20))
def test_similarities_are_symmetric_and_bounded(spark, pairs):
    df = spark.createDataFrame([(a.replace("\x00", ""), b.replace("\x00", "")) for a, b in pairs], "a string, b string")
    a, b = F.col("a"), F.col("b")
    for similarity in (text.alignment_similarity, text.char_similarity, text.phrase_similarity, text.keyword_similarity):
        for x, y, z in df.select(similarity(a, b), similarity(b, a), similarity(a, a)).collect():
            assert 0 <= x <= 1 and abs(x - y) < 1e-9 and z in (0.0, 1.0)


def test_predicates(one):
    p = predicates
    table = L("\n| a | b |\n|---|---|\n| 1 | 2 |")
    code = L("graph TD\nA --> B")
    assert list(one(p.looks_like_diagram(code), p.looks_like_diagram(L("a - b")), p.looks_like_diagram(null()), p.looks_like_table(table), p.looks_like_table(L("x\n| a |\n|-|")), p.looks_like_table(null()))) == [True, False, False, True, False, False]
    assert list(one(p.flowchart_block(L("image"), null(), code), p.flowchart_block(L("table"), L("flowchart"), null()), p.flowchart_block(L("table"), L("flowchart"), null(), True), p.seal_block(L("image"), null(), strings("body", "seal")), p.seal_block(L("chart"), L("seal"), strings()), p.chart_with_table(L("chart"), null(), table), p.table_block(null(), table))) == [True, False, True, True, False, True, True]
    assert list(one(p.auxiliary_node(L("x"), L("Merge2")), p.auxiliary_node(L("hub"), L("hub")), p.auxiliary_node(L("x"), L("pay")), p.continuous(strings("N001", "N002")), p.continuous(strings("N001", "N003")), p.continuous(strings()), p.worth_adding(L("image"), L("seal")), p.worth_adding(L("image"), null()), p.complete_answer(L(True), null(), code), p.complete_answer(L(True), L("length"), code))) == [True, True, False, True, False, False, True, False, True, False]


def test_alignment_to_visible_text(one):
    visible = strings("Total cost", "Net weight", "Page 3")
    assert one(text.title_alignment(L("Figure 2: Cost"), L("Cost")), text.title_alignment(L("Cost"), L("Total cost")))[0:2] == (1.0, pytest.approx(0.75 + 0.25 * 4 / 9))
    assert one(text.best_candidate(L("cost"), visible), text.best_candidate(L("zzz"), visible), text.best_candidate(L("x"), strings()))[0:3] == ("Total cost", "zzz", "x")
    assert one(text.aligned_keys(strings("cost", "total  cost"), visible))[0] == ["Total cost", "Net weight", "Page 3"]
    assert one(text.excerpt(strings("head", "a", "b", "hit", "c", "d", "tail"), strings("hit", "")))[0] == ["head", "b", "hit", "c", "tail"]
