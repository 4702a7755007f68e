"""Queries that assemble, compare and order the records of an image, with SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concordance.functions import geometry, labels, predicates, text
from concordance.operators import dedup, graphs, layout, ordering, pages, tables, voting
from concordance.plans.fusion import _CELLS, _SQUEEZED
from concordance.session import table


def _node_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(graph, node_id, source_model, row, col, shape): what each model says of a node, once."""
    votes = F.arrays_zip(F.col("support_models").alias("m"), F.col("row_index_votes").alias("r"), F.col("col_index_votes").alias("c"), F.col("shape_votes").alias("s"))
    rows = table(spark, sf_dir, "fused_nodes").filter("image_id is not null").select(F.col("image_id").alias("graph"), F.col("fused_id").alias("node_id"), F.explode(votes).alias("v")).filter("v.m is not null")
    shape = labels.node_shape(F.coalesce("v.s", F.lit("")))
    return rows.groupBy("graph", "node_id", F.col("v.m").alias("source_model")).agg(F.min("v.r").alias("row"), F.min("v.c").alias("col"), F.min(shape).alias("shape"))


_CLAIMED = """claims as (select image_id as graph, fused_id as node_id, m as source_model, min(r) as row, min(c) as col, min(case when lower(trim(s)) in ('rectangle', 'rounded', 'diamond', 'ellipse') then lower(trim(s)) else 'unknown' end) as shape
  from (select image_id, fused_id, unnest(support_models) as m, unnest(row_index_votes) as r, unnest(col_index_votes) as c, unnest(shape_votes) as s from fused_nodes where image_id is not null) where m is not null group by all)"""


def node_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of models that put one node in different rows or columns or draw it otherwise."""
    return voting.node_conflicts(_node_claims(spark, sf_dir).withColumn("box", F.lit(None).cast("array<double>")))


_WARNINGS = f"""
with {_CLAIMED}, p as (select a.graph, a.node_id, a.source_model as model_a, b.source_model as model_b, a.row as ra, b.row as rb, a.col as ca, b.col as cb, a.shape as sa, b.shape as sb from claims a join claims b on a.graph = b.graph and a.node_id = b.node_id and a.source_model < b.source_model)
select graph, node_id, model_a, model_b, 'row_conflict' as conflict from p where abs(ra - rb) > 1 union all select graph, node_id, model_a, model_b, 'column_conflict' from p where abs(ca - cb) > 1
union all select graph, node_id, model_a, model_b, 'shape_conflict' from p where sa != 'unknown' and sb != 'unknown' and sa != sb"""


def _placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _node_claims(spark, sf_dir).groupBy("graph", "node_id").agg(F.min("row").alias("row"), F.min("col").alias("col"))


def reindexed_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fused edges under the ids that their nodes get by row and column; dangling ones have none."""
    edges = table(spark, sf_dir, "fused_edges").filter("image_id is not null").select(F.col("image_id").alias("graph"), "source", "target").distinct()
    return voting.reindexed(_placed(spark, sf_dir), edges, "row", "col", "node_id")


_REINDEXED = f"""
with {_CLAIMED}, n as (select graph, node_id, min(row) as row, min(col) as col from claims group by all),
i as (select graph, node_id, printf('N%03d', row_number() over (partition by graph order by row nulls first, col nulls first, node_id)) as id from n),
e as (select distinct image_id as graph, source, target from fused_edges where image_id is not null)
select e.graph, e.source, e.target, case when s.id is not null and t.id is not null then s.id end as new_source, case when s.id is not null and t.id is not null then t.id end as new_target, s.id is null or t.id is null as dangling
from e left join i s on s.graph = e.graph and s.node_id = e.source left join i t on t.graph = e.graph and t.node_id = e.target"""


def _readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "ocr_regions").filter("image_id is not null").select("image_id", "region_id", "model_name", labels.ocr_role(F.col("role")).alias("role"), F.trim("text").alias("text"), text.squeezed(F.col("text")).alias("key")).filter("key != ''")


_ROLE = "case when lower(trim(role)) in ('seal', 'stamp', '印章', '公章') then 'seal' when lower(trim(role)) in ('watermark', '水印') then 'watermark' when lower(trim(role)) in ('footer', '页脚', '底部文字') then 'footer' when lower(trim(role)) in ('body', '正文') then 'body' when lower(trim(role)) in ('title', '标题') then 'title' else 'other' end"
_READ = f"r as (select * from (select image_id, region_id, model_name, {_ROLE} as role, trim(text, ' ') as text, {_SQUEEZED.format('text')} as key from ocr_regions where image_id is not null) where key != '')"


def distinct_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first region of each role and text of an image."""
    return dedup.first_rows(_readings(spark, sf_dir).select("image_id", "role", "key", "region_id", "model_name"), ["image_id", "role", "key"], ["region_id"]).drop("key")


def reference_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts read in an image, first seen first: 20 a model and 40 in all at most."""
    return pages.reference_texts(_readings(spark, sf_dir), ["image_id"], "model_name", "key", "region_id", 20, 40).select("image_id", "model_name", "region_id", "place")


_REFERENCES = f"""
with {_READ}, once as (select image_id, model_name, key, min(region_id) as region_id from r group by all), m as (select * from once qualify row_number() over (partition by image_id, model_name order by region_id) <= 20),
d as (select * from m qualify row_number() over (partition by image_id, key order by region_id) = 1)
select image_id, model_name, region_id, row_number() over (partition by image_id order by region_id)::int as place from d qualify place <= 40"""


def seal_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each model reads on the seals of an image: regions, distinct texts, their signature."""
    return pages.seal_candidates(_readings(spark, sf_dir).filter("role = 'seal'"))


_SEALS = f"""with {_READ}, s as (select * from r where role = 'seal'), d as (select image_id, model_name, key, min(region_id) as first, min_by(text, region_id) as text from s group by all),
g as (select image_id, model_name, count(*) as texts, string_agg(key, '|' order by first) as signature, string_agg(text, '; ' order by first) as full_text from d group by all)
select image_id, model_name, (select count(*) from s where s.image_id = g.image_id and s.model_name is not distinct from g.model_name) as regions, texts, signature, full_text from g"""


def distinct_seal_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the models that read the same on an image's seals the first by name."""
    return dedup.first_rows(seal_candidates(spark, sf_dir).filter("model_name is not null").select("image_id", "signature", "model_name"), ["image_id", "signature"], ["model_name"]).withColumn("signature", F.md5("signature"))


def seal_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model with most to say on an image's seals: regions, texts, then the order of trust."""
    rank = F.coalesce(F.array_position(F.array(*map(F.lit, pages.ROLES)), F.col("model_name")), F.lit(0))
    scored = seal_candidates(spark, sf_dir).filter("model_name is not null").withColumn("rank", F.when(rank > 0, rank).otherwise(99))
    return dedup.top_rows(scored.select("image_id", "model_name", "regions", "texts", "rank"), ["image_id"], [F.desc("regions"), F.desc("texts"), "rank", "model_name"], 1).drop("rank")


def source_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every image and role the last answer, or an empty place for a role that gave none."""
    outputs = table(spark, sf_dir, "model_outputs").filter("image_id is not null").select("image_id", F.col("model_name").alias("role"), "output_id", "success", "latency_ms")
    return pages.bundles(outputs, ["image_id"], "role", "output_id")


_BUNDLES = """with i as (select distinct image_id from model_outputs where image_id is not null), roles as (select unnest(['anchor-pro', 'aux-layout', 'aux-vision', 'judge-xl']) as role),
l as (select image_id, model_name as role, max(output_id) as output_id, arg_max(struct_pack(s := success, l := latency_ms), output_id) as v from model_outputs where image_id is not null group by all)
select i.image_id, roles.role, l.output_id, coalesce(l.v.s, false) as success, l.v.l as latency_ms, l.output_id is null as skipped from i cross join roles left join l on l.image_id = i.image_id and l.role = roles.role"""


def raw_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where an answer's payload is: parsed, else the raw text if it holds JSON."""
    return table(spark, sf_dir, "model_outputs").select("output_id", pages.payload_source(F.col("parsed"), F.col("raw_text")).alias("payload"), F.coalesce(F.length("parsed"), F.length("raw_text"), F.lit(0)).alias("chars"))


def largest_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of an image's documents the one whose first table has most cells; ties: the first."""
    documents = table(spark, sf_dir, "documents").filter("image_id is not null")
    cells = tables.parse_table(documents, ["image_id", "doc_id"], "text").groupBy("image_id", "doc_id").agg(F.count("*").alias("cells"))
    return dedup.top_rows(cells, ["image_id"], [F.desc("cells"), "doc_id"], 1)


def page_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crops in order of their names, and whether a crop is the last of its page."""
    crops = table(spark, sf_dir, "validations").filter("image_id is not null").select("image_id").distinct().select("image_id", labels.crop_parts(F.col("image_id")).page_output_id.alias("page"))
    after = ordering.with_next(crops, [], ["image_id"], {"page": "next_page", "image_id": "next_id"})
    return after.select("image_id", "page", (F.col("next_id").isNull() | ~F.col("page").eqNullSafe(F.col("next_page"))).alias("ends_page"))


def special_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks that stand in Markdown as a diagram, a seal or a table, by kind."""
    kind = pages.special_kind(labels.block_type(F.col("block_type")), F.col("sub_type"), F.col("content"), F.array().cast("array<string>"))
    return table(spark, sf_dir, "layout_blocks").select("block_row_id", kind.alias("special")).filter("special is not null")


_TYPE = "case coalesce(lower(trim(block_type)), '') " + " ".join(f"when '{k}' then '{v}'" for k, v in labels.BLOCK_TYPES.items()) + " else 'paragraph' end"


def filled_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every block with the fields of its type, missing ones by default."""
    rows = table(spark, sf_dir, "layout_blocks").select("block_row_id", labels.block_type(F.col("block_type")).alias("kind"), "sub_type", "content", "angle")
    return pages.filled(rows, "kind", "sub_type", "content", "angle").select("block_row_id", "out_type", "text", "img_path", "table_body", F.array_join("caption", "|").alias("caption"), "out_angle")


_FILLED = f"""
with b as (select block_row_id, {_TYPE} as kind, lower(trim(coalesce(sub_type, ''))) as sub, trim(coalesce(content, ''), ' ') as t, angle from layout_blocks)
select block_row_id, case when sub = 'flowchart' then 'chart' when kind = 'paragraph' then 'text' else kind end as out_type, case when kind = 'table' then '' else t end as text, case when kind in ('image', 'chart', 'table') then '' end as img_path,
  case when kind = 'table' then t end as table_body, case when kind = 'image' and t != '' then t else '' end as caption, coalesce(round_even(angle, 0), 0)::int as out_angle from b"""


def flowchart_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images with any sign of a flow diagram: a marked block, a drawn graph or diagram code."""
    marked = table(spark, sf_dir, "layout_blocks").filter(F.lower(F.trim("sub_type")) == "flowchart").select("image_id")
    drawn = table(spark, sf_dir, "visual_graphs").filter(F.size("edges") > 0).select("image_id")
    code = table(spark, sf_dir, "snapshots").filter(predicates.looks_like_diagram(F.col("code"))).select("image_id")
    return pages.any_sign(marked, drawn, code)


_FLOW = r"""select distinct image_id from (select image_id from layout_blocks where lower(trim(sub_type)) = 'flowchart' union all select image_id from visual_graphs where len(edges) > 0
union all select image_id from snapshots where regexp_matches(code, '(?im)^\s*(?:flowchart|graph)\s+(?:TD|TB|LR|RL|BT)\b|[\w\])}]\s*(?:-->|-\.->|==>)')) where image_id is not null"""


def arrow_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrows in an image's diagrams and how near their numbers are."""
    rows = table(spark, sf_dir, "snapshots").filter("image_id is not null and code is not null").select("image_id", F.regexp_count("code", F.lit(r"-->|-\.->|==>")).alias("arrows"))
    g = rows.groupBy("image_id").agg(F.min("arrows").alias("least"), F.max("arrows").alias("most"), F.count("*").alias("codes"))
    return g.withColumn("likeness", F.round(pages.range_similarity(F.col("least"), F.col("most")), 6))


def distinct_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first of a drawn graph's edges whose ends and label read alike."""
    rows = table(spark, sf_dir, "visual_graphs").select("graph_id", F.posexplode("edges").alias("pos", "e")).filter("e.source is not null and e.target is not null")
    keyed = rows.select("graph_id", "pos", *(text.squeezed(F.col("e." + c)).alias(c) for c in ("source", "label", "target")))
    return dedup.first_rows(keyed, ["graph_id", "source", "label", "target"], ["pos"]).select("graph_id", "pos", "source", "label", "target")


def visual_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of drawn graphs by visual row, from their boxes and depths."""
    read = F.from_json("payload", "nodes array<struct<node_id:string,order_index:int,bbox_hint:array<double>>>, edges array<struct<source:string,target:string>>")
    rows = table(spark, sf_dir, "visual_graphs").select(F.col("graph_id").alias("graph"), read.alias("p")).filter("size(p.nodes) > 0").select("graph", "p.nodes", "p.edges")
    return layout.visual_rows(rows)


def final_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Markdown of every image's layout, its special blocks taken from the later rows of the
    same page where they match."""
    rows = table(spark, sf_dir, "layout_blocks").filter("image_id is not null").select(
        "image_id", "block_row_id", "block_index", labels.block_type(F.col("block_type")).alias("kind"), F.coalesce("content", F.lit("")).alias("text"), geometry.sorted_corners(F.col("bbox")).alias("box"),
        pages.special_kind(labels.block_type(F.col("block_type")), F.col("sub_type"), F.col("content"), F.array().cast("array<string>")).alias("special"),
    )
    return pages.final_markdown(rows, "image_id", "block_index", "block_row_id")


def normal_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of drawn graphs' payloads in normal form."""
    rows = graphs.normalised(table(spark, sf_dir, "visual_graphs"), "graph_id", "payload")
    return rows.select("graph_id", F.posexplode("nodes").alias("pos", "n")).select("graph_id", "pos", "n.*")


def normal_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges of drawn graphs' payloads, re-pointed to the nodes' new ids; how many were dropped."""
    rows = graphs.normalised(table(spark, sf_dir, "visual_graphs"), "graph_id", "payload")
    return rows.select("graph_id", "dropped", F.posexplode_outer("edges").alias("pos", "e")).select("graph_id", "pos", "e.*", "dropped")


def drawn_graphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Diagram text of every drawn graph in normal form."""
    rows = graphs.normalised(table(spark, sf_dir, "visual_graphs"), "graph_id", "payload")
    return rows.select("graph_id", F.md5(graphs.drawn(F.col("nodes"), F.col("edges"))).alias("digest"))


def clean_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Diagram codes with their labels quoted, and whether that changed them."""
    rows = table(spark, sf_dir, "snapshots").filter("code is not null").select("snapshot_id", "code", graphs.cleaned_code(F.col("code")).alias("clean"))
    return rows.select("snapshot_id", F.md5("clean").alias("digest"), (F.col("code") != F.col("clean")).alias("changed"))


_PAYLOADS = r"""
j as (select graph_id, payload::json as p from visual_graphs where json_valid(payload) and not regexp_matches(regexp_replace(payload, '"(\\.|[^"\\])*"', '""', 'g'), ',\s*[}\]]|NaN|Infinity|inf|nan')),
l as (select graph_id, json_extract(p, '$.nodes[*]') as ns, json_extract(p, '$.edges[*]') as es from j),
n as (select graph_id, generate_subscripts(ns, 1) as i, unnest(ns) as n from l),
m as (select graph_id, i, trim(n->>'$.node_id') as raw, case when try_cast(n->>'$.order_index' as int) > 0 then try_cast(n->>'$.order_index' as int) end as o, case when lower(trim(n->>'$.shape')) in ('rectangle', 'rounded', 'diamond', 'ellipse') then lower(trim(n->>'$.shape')) else 'unknown' end as shape, trim(coalesce(n->>'$.text', '')) as text from n),
k as (select *, printf('N%03d', coalesce(try_cast(regexp_extract(coalesce(raw, ''), '(\d+)', 1) as int), o, i::int)) as node_id from m),
nodes as (select graph_id, (i - 1)::int as pos, node_id, coalesce(o, try_cast(regexp_extract(node_id, '(\d+)', 1) as int)) as order_index, shape, text, raw, i from k)"""
_NAMED = """
named as (select graph_id, k, arg_max(v, seq) as v from (select graph_id, raw as k, node_id as v, i * 3 as seq from nodes union all select graph_id, node_id, node_id, i * 3 + 1 from nodes union all select graph_id, order_index::varchar, node_id, i * 3 + 2 from nodes) where k is not null group by all),
e as (select graph_id, generate_subscripts(es, 1) as i, unnest(es) as e from l),
f as (select graph_id, i, trim(coalesce(e->>'$.source', '')) as s, trim(coalesce(e->>'$.target', '')) as t, trim(coalesce(e->>'$.label', '')) as label from e),
g as (select f.graph_id, i, coalesce(a.v, case when regexp_matches(s, '\\d') then printf('N%03d', regexp_extract(s, '(\\d+)', 1)::int) end) as source, coalesce(b.v, case when regexp_matches(t, '\\d') then printf('N%03d', regexp_extract(t, '(\\d+)', 1)::int) end) as target, label
  from f left join named a on a.graph_id = f.graph_id and a.k = s and s != '' left join named b on b.graph_id = f.graph_id and b.k = t and t != ''),
c as (select graph_id, (row_number() over (partition by graph_id order by i) - 1)::int as pos, source, target, label from g where source is not null and target is not null),
d as (select l.graph_id, (len(es) - coalesce((select count(*) from c where c.graph_id = l.graph_id), 0))::int as dropped from l)
select d.graph_id, c.pos, c.source, c.target, c.label, d.dropped from d left join c using (graph_id)"""


_DRAWN = r"""
w as (select graph_id, order_index as o, node_id as i, case when text != '' then text else node_id end as t, shape as s from nodes),
x as (select graph_id, string_agg(i || case s when 'diamond' then '{"' when 'rounded' then '("' when 'ellipse' then '(("' else '["' end || replace(t, '"', '&quot;') || case s when 'diamond' then '"}' when 'rounded' then '")' when 'ellipse' then '"))' else '"]' end, chr(10) order by o nulls first, i, s, t) as ns from w group by 1),
pl as (select graph_id, i, min(o) as o from w group by all),
y as (select c.graph_id, string_agg(c.source || case when c.label != '' then ' -->|' || replace(replace(c.label, '"', '&quot;'), '|', '/') || '| ' else ' --> ' end || c.target, chr(10) order by coalesce(a.o, 1000000000), coalesce(b.o, 1000000000), c.source, c.target, c.label) as es from c left join pl a on a.graph_id = c.graph_id and a.i = c.source left join pl b on b.graph_id = c.graph_id and b.i = c.target group by 1)
select l.graph_id, md5(case when x.ns is null then '' else 'flowchart TD' || chr(10) || x.ns || case when y.es is null then '' else chr(10) || y.es end end) as digest from l left join x using (graph_id) left join y using (graph_id)"""


QUERIES = {f.__name__: f for f in (
    node_warnings, reindexed_edges, distinct_regions, reference_texts, seal_candidates, distinct_seal_candidates, seal_references, source_bundles, raw_payloads, largest_tables, page_boundaries,
    special_blocks, filled_blocks, flowchart_images, arrow_ranges, distinct_edges, visual_rows, final_markdown, normal_nodes, normal_edges, drawn_graphs, clean_codes,
)}
SQL = {
    "normal_nodes": f"with {_PAYLOADS} select graph_id, pos, node_id, order_index, shape, text from nodes",
    "normal_edges": f"with {_PAYLOADS}, {_NAMED}",
    "drawn_graphs": f"with {_PAYLOADS}, {_NAMED[: _NAMED.index('d as (select l.graph_id')].rstrip().rstrip(',')}, {_DRAWN}",
    "node_warnings": _WARNINGS,
    "reindexed_edges": _REINDEXED,
    "distinct_regions": f"with {_READ} select image_id, role, region_id, model_name from r qualify row_number() over (partition by image_id, role, key order by region_id) = 1",
    "reference_texts": _REFERENCES,
    "seal_candidates": _SEALS,
    "distinct_seal_candidates": f"select image_id, md5(signature) as signature, min(model_name) as model_name from ({_SEALS}) where model_name is not null group by image_id, signature",
    "seal_references": f"select image_id, model_name, regions, texts from ({_SEALS}) where model_name is not null qualify row_number() over (partition by image_id order by regions desc, texts desc, coalesce(list_position(['anchor-pro', 'aux-layout', 'aux-vision', 'judge-xl'], model_name), 99), model_name) = 1",
    "source_bundles": _BUNDLES,
    "raw_payloads": "select output_id, case when parsed is not null then 'parsed' when regexp_matches(raw_text, '^\\s*(```(json)?\\s*)?[{\\[]') then 'raw_text' else 'none' end as payload, coalesce(length(parsed), length(raw_text), 0) as chars from model_outputs",
    "largest_tables": f"select * from (select d.image_id, c.doc_id, count(*) as cells from ({_CELLS}) c join documents d using (doc_id) where d.image_id is not null group by d.image_id, c.doc_id) qualify row_number() over (partition by image_id order by cells desc, doc_id) = 1",
    "page_boundaries": r"with c as (select distinct image_id, nullif(regexp_extract(image_id, '^(.*_p_?\d+)_r_?(\d+)_.+$', 1), '') as page from validations where image_id is not null) select image_id, page, lead(image_id) over w is null or page is distinct from lead(page) over w as ends_page from c window w as (order by image_id)",
    "special_blocks": f"select * from (select block_row_id, case when lower(trim(sub_type)) = 'flowchart' then 'diagram' when {_TYPE} = 'image' and lower(trim(sub_type)) = 'seal' then 'seal' when {_TYPE} in ('table', 'chart') then 'table' end as special from layout_blocks) where special is not null",
    "filled_blocks": _FILLED,
    "flowchart_images": _FLOW,
    "arrow_ranges": r"with a as (select image_id, len(regexp_extract_all(code, '-->|-\.->|==>')) as n from snapshots where image_id is not null and code is not null) select image_id, min(n)::int as least, max(n)::int as most, count(*) as codes, round(case when max(n) = 0 then 1.0 else 1 - (max(n) - min(n))::double / max(n) end, 6) as likeness from a group by 1",
    "distinct_edges": f"with e as (select graph_id, generate_subscripts(edges, 1) - 1 as pos, unnest(edges) as e from visual_graphs), k as (select graph_id, pos, {_SQUEEZED.format('e.source')} as source, {_SQUEEZED.format('e.label')} as label, {_SQUEEZED.format('e.target')} as target from e where e.source is not null and e.target is not null) select graph_id, pos::int as pos, source, label, target from k qualify row_number() over (partition by graph_id, source, label, target order by pos) = 1",
}
