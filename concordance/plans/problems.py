"""Queries of the general training-data problems (1 and 4)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concordance.operators import merkle, rowguard
from concordance.session import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each object with an own id, with its nearest enclosing id."""
    parts = [merkle.identified(merkle.bridge_of(table(spark, sf_dir, name), name, identified_only=True, distinct_links=True)) for name in merkle.SOURCES]
    return reduce(DataFrame.unionAll, parts)


def _flat(name: str, id_key: str, fields: str, whole: str = "content", texts: tuple[str, ...] = ()):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return merkle.flat(merkle.written(table(spark, sf_dir, name), name, texts), id_key, fields, whole, texts)

    query.__doc__ = f"The flat table of the objects with {id_key} in {name}."
    return query


p1_blocks = _flat("model_outputs", "block_id", "type string, text string, bbox array<double>, score double, text_level int")
p1_lines = _flat("layout_blocks", "line_id", "bbox array<double>")
p1_spans = _flat("layout_blocks", "span_id", "content string", whole="canonical", texts=("content",))
p1_checks = _flat("validations", "check_id", "name string, passed boolean")
p1_findings = _flat("validations", "finding_id", "severity string, target_block_id string")
p1_evidence = _flat("validations", "evidence_id", "model_name string, quote string, bbox array<double>")


def p1_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every occurrence of every object, with its parent's; nothing is left out."""
    return reduce(DataFrame.unionAll, [merkle.bridge_of(table(spark, sf_dir, name), name) for name in merkle.SOURCES])


def p1_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct object of the three payloads, stored once."""
    return merkle.store(*(merkle.bridge_of(table(spark, sf_dir, name), name, objects=True) for name in merkle.SOURCES))


def p1_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads that can't be read, with the reason."""
    return reduce(DataFrame.unionAll, [merkle.rejects(merkle.payloads(table(spark, sf_dir, name), name), name, "record_id", "payload") for name in merkle.SOURCES])


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and payloads that can't be loaded, with the reason."""
    lines = rowguard.judge_rows(table(spark, sf_dir, "table_lines"), table(spark, sf_dir, "table_kinds"))
    graphs = rowguard.judge_payloads(table(spark, sf_dir, "visual_graphs"))
    a = lines.filter("reason is not null").select(F.lit("table_lines").alias("source_table"), F.col("line_id").alias("record_id"), "reason")
    b = graphs.filter("reason is not null").select(F.lit("visual_graphs").alias("source_table"), F.col("graph_id").alias("record_id"), "reason")
    return a.unionAll(b)


def p4_broken_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The broken lines with the first broken field and its name."""
    kinds = table(spark, sf_dir, "table_kinds")
    judged = rowguard.judge_rows(table(spark, sf_dir, "table_lines"), kinds).filter("reason is not null")
    return judged.select("line_id", "kind", "reason", "broken_field")


def p4_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sound lines, loaded."""
    kinds = table(spark, sf_dir, "table_kinds")
    loaded = rowguard.load_rows(rowguard.judge_rows(table(spark, sf_dir, "table_lines"), kinds), kinds)
    return loaded.select("line_id", "table_id", "kind", "line_no", "names", "fields")


QUERIES = {f.__name__: f for f in (p1_found, p1_bridge, p1_objects, p1_rejects, p4_found, p4_broken_fields, p4_rows)} | {
    "p1_blocks": p1_blocks, "p1_lines": p1_lines, "p1_spans": p1_spans, "p1_checks": p1_checks, "p1_findings": p1_findings, "p1_evidence": p1_evidence,
}

#: White space in SQL's regular expressions (fixed value).
_WS = r"[\s\x{0b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{1c}-\x{1f}]"
_P1_FOUND = r"""
with recursive w as (
  select 'model_outputs' as source_table, output_id as record_id, ['block_id'] as ids, parsed::json as v, '' as owner from model_outputs where json_valid(parsed)
  union all select 'layout_blocks', block_row_id, ['line_id', 'span_id'], raw::json, '' from layout_blocks where json_valid(raw)
  union all select 'validations', validation_id, ['check_id', 'finding_id', 'evidence_id'], to_json(details), '' from validations where details is not null
  union all
  select source_table, record_id, ids, c, coalesce(own, owner) from (
    select source_table, record_id, ids, owner, case when json_type(v) = 'OBJECT' then list_filter(list_transform(ids, lambda k: json_extract_string(v, '$.' || k)), lambda x: x is not null)[1] end as own,
      unnest(case json_type(v) when 'OBJECT' then json_extract(v, '$.*') when 'ARRAY' then json_extract(v, '$[*]') when 'VARCHAR' then case when regexp_matches(json_extract_string(v, '$'), '^\s*[\[{]') and json_valid(json_extract_string(v, '$')) then [json_extract_string(v, '$')::json] else [] end else [] end) as c from w) where json_type(c) in ('OBJECT', 'ARRAY', 'VARCHAR'))
select distinct source_table, record_id, own as child_id, owner as parent_id from (select source_table, record_id, owner, list_filter(list_transform(ids, lambda k: json_extract_string(v, '$.' || k)), lambda x: x is not null)[1] as own from w where json_type(v) = 'OBJECT') where own is not null"""
_P4_FOUND = rf"""
with l as (select line_id, kind, delimiter as d, col_types as types, raw_line as x from table_lines join table_kinds using (kind) where line_no != 0 and raw_line is not null),
f as (select *, case when d = '|' then true else regexp_full_match(x, '("([^"]|"")*"|[^"' || d || ']*)(' || d || '("([^"]|"")*"|[^"' || d || ']*))*', 's') end as quoted,
  case when d = '|' then case when replace(x, '\|', chr(1)) like '|%|' then list_transform(string_split(replace(x, '\|', chr(1))[2:-2], '|'), lambda v: replace(v, chr(1), '|')) else [] end
  else list_transform(regexp_extract_all(x || d, '("(?:[^"]|"")*"|[^"' || d || ']*)' || d, 1, 's'), lambda v: case when v like '"%' then replace(v[2:-2], '""', '"') else v end) end as fields from l),
v as (select *, len(fields) = len(types) and len(list_filter(list_zip(list_transform(fields, lambda v: regexp_replace(v, '^{_WS}+|{_WS}+$', '', 'g')), types), lambda z: not (z[1] = '' or case z[2]
    when 'text' then true when 'int' then regexp_full_match(z[1], '-?([0-9]{{1,3}}(,[0-9]{{3}})+|[0-9]+)') when 'dec' then regexp_full_match(z[1], '-?[0-9]+(\.[0-9]+)?')
    when 'pct' then regexp_full_match(z[1], '[0-9]+(\.[0-9]+)?%') and coalesce(try_cast(z[1][:-2] as double) <= 100, false)
    when 'date' then regexp_full_match(z[1], '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') and z[1][:4] != '0000' and try_cast(z[1] as date) is not null
    when 'flag' then z[1] in ('yes', 'no') else regexp_full_match(z[1], '[A-Z]{{2}}[0-9]{{4}}') end))) = 0 as valid from f),
a as (select 'table_lines' as source_table, line_id as record_id, case when not quoted then 'broken_quoting' when len(fields) != len(types) then 'column_count' when not valid then 'invalid_value' end as reason from v
  union all select 'table_lines', line_id, 'column_count' from table_lines where line_no != 0 and raw_line is null and kind in (select kind from table_kinds)
  union all select 'table_lines', line_id, 'unknown_kind' from table_lines where line_no != 0 and raw_line is not null and (kind is null or kind not in (select kind from table_kinds))),
g as (select graph_id, payload, coalesce(json_valid(payload) and not regexp_matches(regexp_replace(payload, '"(\\.|[^"\\])*"', '""', 'g'), ',\s*[}}\]]|NaN|Infinity|inf|nan'), false) as sound from visual_graphs),
j as (select graph_id, sound, case when sound then payload::json end as p from g),
n as (select graph_id, unnest(json_extract(p, '$.nodes[*]')) as n from j where sound),
bad as (select distinct graph_id from n where not coalesce(json_type(n, '$.node_id') = 'VARCHAR' and regexp_full_match(n->>'$.node_id', 'N[0-9]+') and json_type(n, '$.order_index') in ('UBIGINT', 'BIGINT') and not regexp_full_match(n->>'$.order_index', '-.*|0')
  and json_type(n, '$.shape') = 'VARCHAR' and (n->>'$.shape') in ('rectangle', 'diamond', 'ellipse', 'rounded', 'unknown'), false)),
ids as (select distinct graph_id, n->>'$.node_id' as id from n),
e as (select graph_id, unnest(json_extract(p, '$.edges[*]')) as e from j where sound),
ends as (select graph_id, case when json_type(e, '$.source') = 'VARCHAR' then e->>'$.source' end as id from e union all select graph_id, case when json_type(e, '$.target') = 'VARCHAR' then e->>'$.target' end from e),
lost as (select distinct graph_id from ends where not exists (select 1 from ids where ids.graph_id = ends.graph_id and ids.id = ends.id)),
b as (select 'visual_graphs' as source_table, graph_id as record_id, case when not sound then 'broken_json' when graph_id in (select graph_id from bad) then 'invalid_node' when graph_id in (select graph_id from lost) then 'unknown_edge_end' end as reason from j)
select * from (select * from a union all select * from b) where reason is not null"""
SQL = {"p1_found": _P1_FOUND, "p4_found": _P4_FOUND}
