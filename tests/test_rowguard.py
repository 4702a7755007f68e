import datetime
import json
import random
import re

import pytest

from concordance.operators import rowguard
from concordance.session import table

SF = "/root/testdata/sf0.01"


def ok(value, kind):
    value = value.strip()
    if not value or kind == "text":
        return True
    if kind == "int":
        return bool(re.fullmatch(r"-?(\d+|\d{1,3}(,\d{3})+)", value, re.A))
    if kind == "dec":
        return bool(re.fullmatch(r"-?\d+(\.\d+)?", value, re.A))
    if kind == "pct":
        return bool(re.fullmatch(r"\d+(\.\d+)?%", value, re.A)) and float(value[:-1]) <= 100
    if kind == "date":
        if not re.fullmatch(r"\d{4}-\d\d-\d\d", value, re.A):
            return False
        try:
            datetime.date.fromisoformat(value)
        except ValueError:
            return False
        return True
    if kind == "flag":
        return value in ("yes", "no")
    return bool(re.fullmatch(r"[A-Z]{2}\d{4}", value, re.A))


def split(line, d):
    """Fields by a state machine, or the reason why there are none."""
    if d == "|":
        out, cur, k = [], "", 0
        while k < len(line):
            if line[k] == "\\" and line[k + 1 : k + 2] == "|":
                cur, k = cur + "|", k + 2
            elif line[k] == "|":
                out.append(cur)
                cur, k = "", k + 1
            else:
                cur, k = cur + line[k], k + 1
        out.append(cur)
        return out[1:-1] if len(out) > 1 and not out[0] and not out[-1] else "column_count"
    out, k = [], 0
    while True:
        if line[k : k + 1] == '"':
            end = k + 1
            while True:
                end = line.find('"', end)
                if end < 0:
                    return "broken_quoting"
                if line[end + 1 : end + 2] == '"':
                    end += 2
                    continue
                break
            out.append(line[k + 1 : end].replace('""', '"'))
            k = end + 1
            if k < len(line) and line[k] != d:
                return "broken_quoting"
        else:
            end = line.find(d, k)
            end = len(line) if end < 0 else end
            if '"' in line[k:end]:
                return "broken_quoting"
            out.append(line[k:end])
            k = end
        if k >= len(line):
            return out
        k += 1


def brute(line, d, types):
    fields = split(line, d)
    if isinstance(fields, str):
        return fields, None
    if len(fields) != len(types):
        return "column_count", None
    return (None, [f.strip() or None for f in fields]) if all(map(ok, fields, types)) else ("invalid_value", None)


def test_lines_against_state_machine(spark):
    kinds = table(spark, SF, "table_kinds")
    known = {r.kind: r for r in kinds.collect()}
    lines = table(spark, SF, "table_lines")
    want = {r.line_id: (None, None) if r.line_no == 0 else brute(r.raw_line, known[r.kind].delimiter, known[r.kind].col_types) for r in lines.collect()}
    judged = rowguard.judge_rows(lines, kinds)
    assert {r.line_id: r.reason for r in judged.collect()} == {k: v[0] for k, v in want.items()}
    loaded = {r.line_id: r.fields for r in rowguard.load_rows(judged, kinds).collect()}
    assert loaded == {k: v[1] for k, v in want.items() if v[1]}


CASES = [
    ("c", 'a,"1,234",1.5,50%,2024-02-29,yes,AB1234', None, None),
    ("c", "a,1,234,1.5,50%,2024-02-29,yes,AB1234", "column_count", 8),
    ("c", ",,,,,,", None, None),
    ("c", ' a , 1 , -2.5 , 100.00% ," 2023-12-31 ",no, ZZ0000 ', None, None),
    ("c", "a,1,2,100.01%,2024-01-01,no,AB1234", "invalid_value", 4),
    ("c", "a,1,2,3%,2023-02-29,no,AB1234", "invalid_value", 5),
    ("c", "a,1,2,3%,1900-02-29,no,AB1234", "invalid_value", 5),
    ("c", "a,1,2,3%,2000-02-29,no,AB1234", None, None),
    ("c", "a,1,2,3%,0000-01-01,no,AB1234", "invalid_value", 5),
    ("c", 'a,1,2,3%,2000-02-29,"no" ,AB1234', "broken_quoting", 6),
    ("c", 'a,"1', "broken_quoting", 2),
    ("c", '"a ""q"" b",1,2,3%,,no,', None, None),
    ("c", "a\x00,1,2,3%,,no,", None, None),
    ("c", None, "column_count", None),
    ("c", "", "column_count", 2),
    ("c", "x" * 200_000 + ",1,2,3%,,no,", None, None),
    ("c", '"' + '""' * 100_000 + '",1,2,3%,,no,', None, None),
    ("b", r"| a \| ""b | 12,345 |", None, None),
    ("b", r"| a | 1 \|", "column_count", 2),
    ("b", "| a | 1 | 2 |", "column_count", 3),
    ("b", " | a | 1 |", "column_count", 1),
    ("b", "| a | 1234,5 |", "invalid_value", 2),
    ("t", "a\t 5 ", None, None),
    ("t", "a\t", None, None),
    ("t", 'a"\t5', "broken_quoting", 1),
    ("?", "a", "unknown_kind", None),
    (None, "a", "unknown_kind", None),
]


def test_hand_made_lines(spark):
    kinds = spark.createDataFrame([("c", ",", list("abcdefg"), ["text", "int", "dec", "pct", "date", "flag", "code"]), ("b", "|", ["x", "y"], ["text", "int"]), ("t", "\t", ["x", "y"], ["text", "int"])], "kind string, delimiter string, col_names array<string>, col_types array<string>")
    rows = [(k, 1, c[0], 1, c[1], "extra") for k, c in enumerate(CASES)]
    lines = spark.createDataFrame(rows, "line_id long, table_id long, kind string, line_no int, raw_line string, delimiter string")
    got = {r.line_id: (r.reason, r.broken_field) for r in rowguard.judge_rows(lines, kinds).collect()}
    for k, c in enumerate(CASES):
        assert got[k] == (c[2], c[3]), (c[0], str(c[1])[:80])
    assert rowguard.judge_rows(lines.limit(0), kinds).count() == 0
    assert rowguard.judge_rows(lines, kinds.limit(0)).filter("reason is distinct from 'unknown_kind'").count() == 1


GOOD = {"node_order_rule": "r", "nodes": [{"node_id": "N001", "order_index": 1, "shape": "diamond", "text": "a\"b", "bbox_hint": [0.1, 1e-3]}, {"shape": "unknown", "node_id": "N2", "order_index": 12}], "edges": [{"source": "N001", "target": "N2", "label": ""}]}


def changed(path, value):
    x = json.loads(json.dumps(GOOD))
    at = x
    for p in path[:-1]:
        at = at[p]
    at[path[-1]] = value
    return json.dumps(x)


@pytest.mark.parametrize(
    ("text", "reason", "field"),
    [
        (json.dumps(GOOD), None, None),
        (json.dumps(GOOD, separators=(",", ":")), None, None),
        (" " + json.dumps(GOOD) + "\n", None, None),
        (json.dumps(GOOD).replace("N001", "\\u004e001"), None, None),
        (json.dumps(GOOD)[:-1], "broken_json", None),
        (json.dumps(GOOD) + "{}", "broken_json", None),
        (json.dumps(GOOD).replace('"shape": "diamond"', '"shape" "diamond"'), "broken_json", None),
        (json.dumps(GOOD).replace("12", "NaN"), "broken_json", "nodes[1]"),
        (json.dumps(GOOD)[: json.dumps(GOOD).index('"edges"') + 20], "broken_json", "edges[0]"),
        (changed(["nodes", 1, "extra"], json.loads("[" * 30 + "]" * 30)), None, None),
        (changed(["nodes", 1, "extra"], json.loads("[" * 30 + "]" * 30)).replace('"unknown"', '"round"'), "invalid_node", "nodes[1].shape"),
        ('{"nodes": [{"node_id": "X"}], "nodes": []}', None, None),
        (None, "broken_json", None),
        ("", "broken_json", None),
        ("[]", None, None),
        ("7", None, None),
        ('{"nodes": null, "edges": []}', None, None),
        (changed(["nodes", 0, "node_id"], "X1"), "invalid_node", "nodes[0].node_id"),
        (changed(["nodes", 1, "order_index"], 0), "invalid_node", "nodes[1].order_index"),
        (changed(["nodes", 1, "order_index"], True), "invalid_node", "nodes[1].order_index"),
        (changed(["nodes", 1, "shape"], ""), "invalid_node", "nodes[1].shape"),
        (changed(["nodes", 1], 5), "invalid_node", "nodes[1]"),
        (changed(["edges", 0, "target"], None), "unknown_edge_end", "edges[0].target"),
        (changed(["edges", 0], None), "unknown_edge_end", "edges[0].source"),
    ],
)
def test_payloads(text, reason, field):
    got = rowguard.judge_payload(text, rowguard.payload_patterns())
    assert got[0] == reason
    if field:
        assert got[1] == field


def test_a_match_settles_the_nodes():
    p = rowguard.payload_patterns()
    sound = json.dumps(GOOD)
    assert p["whole"].fullmatch(sound)
    for text in ('{"nodes": [{}]}', '{"nodes": [{"node_id": "N1", "shape": "diamond"}]}', sound.replace('"text"', '"\\u0073hape"'), sound.replace('"node_order_rule"', '"\\u006eodes"'), changed(["nodes", 0, "order_index"], 0)):
        assert not p["whole"].fullmatch(text), text
        assert rowguard.judge_payload(text, p)[0] == ("invalid_node" if "u006e" not in text else None), text
    assert rowguard.judge_payload(changed(["nodes", 0, "shape"], ""), {**p, "whole": re.compile(".*", re.S)}) == (None, None)
    assert rowguard.judge_payload(changed(["edges", 0, "target"], "N3"), p) == ("unknown_edge_end", "edges[0].target")


def test_prefixes_give_reason_and_field():
    """What the patterns say needs no parser: deep values and escapes apart."""
    p = rowguard.payload_patterns()
    assert rowguard.narrowed(changed(["nodes", 1, "order_index"], 0), p) == ("invalid_node", "nodes[1].order_index")
    assert rowguard.narrowed(changed(["nodes", 0, "shape"], "x").replace("N2", "n2"), p) == ("invalid_node", "nodes[0].shape")
    assert rowguard.narrowed(changed(["nodes", 0, "shape"], "x")[:-2], p) == ("broken_json", "edges[1]")
    assert rowguard.narrowed(json.dumps(GOOD), p) == (None, "")
    inert = {**p, "node": re.compile("(?!)"), "until_shape": re.compile("")}
    assert rowguard.judge_payload(changed(["nodes", 0, "shape"], "x"), inert) != rowguard.judge_payload(changed(["nodes", 0, "shape"], "x"), p)


def test_mutated_payloads_against_the_parser():
    rng = random.Random(4)
    p, base = rowguard.payload_patterns(), json.dumps(GOOD)
    for _ in range(4000):
        text = list(base)
        for _ in range(rng.randint(1, 2)):
            k = rng.randrange(len(text))
            text[k : k + rng.randint(0, 2)] = rng.choice(['"', ",", "{", "}", "[", "]", "0", "-", "N", ":", "", " ", "\\"])
        text = "".join(text)
        try:
            want = rowguard._judged_value(json.loads(text, parse_constant=rowguard._reject_constant))[0]
        except ValueError:
            want = "broken_json"
        assert rowguard.judge_payload(text, p)[0] == want, text


def test_whole_pattern_decides_most_payloads(spark):
    p = rowguard.payload_patterns()["whole"]
    texts = [r.payload for r in table(spark, SF, "visual_graphs").select("payload").collect()]
    assert sum(p.fullmatch(t) is not None for t in texts if t) > 0.9 * len(texts)
