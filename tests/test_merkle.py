import json

from pyspark.sql import functions as F

from concordance.operators import merkle
from concordance.plans import problems
from concordance.session import table

SF = "/root/testdata/sf0.001"


def brute(value, keys, owner="", out=None):
    out = [] if out is None else out
    if isinstance(value, str) and value.lstrip()[:1] in ("{", "["):
        try:
            value = json.loads(value)
        except ValueError:
            return out
    if isinstance(value, dict):
        own = next((value[k] for k in keys if value.get(k) is not None), None)
        if own is not None:
            out.append((own, owner))
        for v in value.values():
            brute(v, keys, owner if own is None else own, out)
    elif isinstance(value, list):
        for v in value:
            brute(v, keys, owner, out)
    return out


def test_found_against_brute_force(spark):
    want = set()
    for name, (record, payload, keys) in merkle.SOURCES.items():
        for r in table(spark, SF, name).select(record, payload).toJSON().map(json.loads).collect():
            want |= {(name, r[record], *x) for x in brute(r.get(payload), keys)}
    got = [tuple(r) for r in problems.p1_found(spark, SF).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 1000


def test_edge_cases(spark):
    rows = [
        (1, None), (2, ""), (3, "{broken"), (4, "[]"), (5, '{"id": null, "a": [{"id": 7}, {"id": 7}]}'),
        (6, '{"id": "x", "w": "[{\\"id\\": \\"y\\"}]"}'), (6, '{"id": "x", "w": "[{\\"id\\": \\"y\\"}]"}'),
        (7, json.dumps({"id": "big", "t": "é" * 300_000})), (8, "[" * 900 + "]" * 900), (9, "3"), (10, "[" * 200000),
    ]
    df = spark.createDataFrame(rows, "rid long, payload string").selectExpr("*", "'clash' as record_id_", "1 as occurrence")
    got = merkle.bridge(df, "s", "rid", "payload", ("id",)).collect()
    found = sorted((r.record_id, r.child_id, r.parent_id) for r in got if r.child_id)
    assert found == [(5, "7", ""), (5, "7", ""), (6, "x", ""), (6, "x", ""), (6, "y", "x"), (6, "y", "x"), (7, "big", "")]
    assert merkle.bridge(df.limit(0), "s", "rid", "payload", ("id",)).count() == 0
    linked = merkle.bridge(df, "s", "rid", "payload", ("id",), identified_only=True, distinct_links=True)
    assert linked.filter("record_id = 5").count() == 1


def test_identity_is_the_content(spark):
    rows = [(1, '{"b": 1.0, "a": {"x": [1, {"y": "q"}]}}'), (2, '{"a": {"x": [1, {"y": "q"}]}, "b": 1}'), (3, '{"a": {"x": [{"y": "q"}, 1]}, "b": 1}')]
    df = spark.createDataFrame(rows, "rid long, payload string")
    bridged = merkle.bridge(df, "s", "rid", "payload", ("id",))
    root = {r.record_id: r.object_hash for r in bridged.filter("parent_occurrence = -1").collect()}
    assert root[1] == root[2] != root[3]
    store = merkle.store(merkle.bridge(df, "s", "rid", "payload", ("id",), objects=True))
    assert store.count() == bridged.select("object_hash").distinct().count() == 5
    assert bridged.count() == 9
    assert {r.ordinal for r in bridged.filter("field = 'x' and record_id = 1").collect()} == {1}


def test_json_after_many_blanks_is_opened():
    walker = merkle._Walker(("id",))
    walker.walk({"a": " " * 70 + '{"id": 7}', "b": "\n" * 64 + '[{"id": 8}]', "c": " " * 70 + "x"}, -1, "", "", "")
    assert [row[7] for row in walker.rows] == [None, "7", "8"]


def test_places_in_nested_arrays_and_parents(spark):
    """Pages of blocks keep both places; every parent joins; the store gives back all fields."""
    payload = json.dumps({"pages": [[{"id": "a", "z": [1, {"q": "NaN"}]}, {"id": "b"}], [{"id": "c", "w": '{"id": "d", "n": 1.50}'}]], "x": None})
    df = spark.createDataFrame([(1, payload), (2, payload)], "rid long, payload string")
    written = merkle.bridge(df, "s", "rid", "payload", ("id",), objects=True).cache()
    assert {(r.child_id, r.places, r.ordinal) for r in written.filter("child_id is not null").collect()} == {("a", "0.0", 0), ("b", "0.1", 1), ("c", "1.0", 0), ("d", "", 0)}
    orphans = written.alias("c").join(written.alias("p"), F.expr("c.record_id = p.record_id and c.parent_occurrence = p.occurrence"), "left_anti")
    assert {r.parent_occurrence for r in orphans.collect()} == {-1}
    rows = merkle.flat(written, "id", "n double").orderBy("record_id", "occurrence").collect()
    assert [(r.record_id, r.id, r.parent_id, r.n) for r in rows] == [(k, *x) for k in (1, 2) for x in (("a", "", None), ("b", "", None), ("c", "", None), ("d", "c", 1.5))]
    stored = {r.object_hash: json.loads(r.canonical) for r in merkle.store(written).collect()}

    def built(value):
        if isinstance(value, dict):
            if set(value) == {"#"}:
                return {k: built(v) for k, v in stored[value["#"]].items()}
            return json.dumps(built(value["json"])) if set(value) == {"json"} else value
        return [built(v) for v in value] if isinstance(value, list) else value

    root = written.filter("parent_occurrence = -1 and record_id = 2").first().object_hash
    again, want = built({"#": root}), json.loads(payload)
    again["pages"][1][0]["w"], want["pages"][1][0]["w"] = (json.loads(x["pages"][1][0]["w"]) for x in (again, want))
    assert again == want


def test_rejects(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "{broken"), (4, "[]"), (5, "[" * 200_000 + "]" * 200_000)], "rid long, payload string")
    assert {(r.record_id, r.reason) for r in merkle.rejects(df, "s", "rid", "payload").collect()} == {(3, "malformed"), (5, "too_deep")}


def test_flat_tables_join_bridge_and_store(spark):
    bridge, objects = problems.p1_bridge(spark, SF).cache(), problems.p1_objects(spark, SF)
    assert bridge.select("object_hash").distinct().count() == objects.count()
    spans = problems.p1_spans(spark, SF)
    assert spans.count() == bridge.filter("id_key = 'span_id'").count() == spans.join(bridge.filter("source_table = 'layout_blocks'").selectExpr("record_id", "occurrence as parent_occurrence"), ["record_id", "parent_occurrence"]).count()
    assert problems.p1_rejects(spark, SF).filter("reason = 'too_deep'").count() == 0


def test_spans_have_one_content_as_received(spark, tmp_path):
    """A span's text and the JSON of all its fields are two columns; a text that is JSON stays as it is."""
    texts = ["x", None, "", "[1]", " [ 1.0 ]", '{"a": 1.50}', '["\u00e9"]', "[1", '{"span_id": "in", "content": "[2]"}']
    lines = [{"line_id": "L", "spans": [{"span_id": f"S{k}", "content": c} for k, c in enumerate(texts)]}]
    spark.createDataFrame([(k, json.dumps({"content": "[0]", "lines": lines})) for k in (1, 2)], "block_row_id long, raw string").write.parquet(f"{tmp_path}/layout_blocks.parquet")
    problems.p1_spans(spark, str(tmp_path)).write.parquet(f"{tmp_path}/spans")
    rows = spark.read.parquet(f"{tmp_path}/spans").collect()
    want = {(k, *x) for k in (1, 2) for x in [("L", f"S{n}", c) for n, c in enumerate(texts)] + [("S8", "in", "[2]")]}
    assert {(r.record_id, r.parent_id, r.span_id, r.content) for r in rows} == want and len(rows) == 20
    assert all(json.loads(r.canonical)["span_id"] == r.span_id for r in rows)


def test_flat_tables_name_each_column_once(spark):
    for name in ("p1_blocks", "p1_lines", "p1_spans", "p1_checks", "p1_findings", "p1_evidence"):
        columns = problems.QUERIES[name](spark, SF).columns
        assert len(columns) == len({c.lower() for c in columns}), name
