"""Queries of the fusion operators over the test tables, with SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concordance.functions import geometry, labels, text
from concordance.operators import comparison, decisions, dedup, graphs, issues, layout, matching, ordering, patches, payloads, scoring, tables, voting
from concordance.session import materialise, table
from concordance.sources import sinks
from concordance.streaming import incremental

#: White space in SQL's regular expressions (fixed value).
WS = r"[\s\x{0b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


class _Sql(str):
    """A piece of SQL with places {0}, {1}; other braces stand for themselves."""

    def format(self, *values: str) -> str:
        out = str(self)
        for k, v in enumerate(values):
            out = out.replace("{%d}" % k, v)
        return out


def _compatible(x: str) -> str:
    """The compatibility form in SQL, as ``text.compatible`` has it."""
    for c, form in text.EXPANDED.items():
        x = f"replace({x}, '{c}', '{form}')"
    before, after = (s.replace("'", "''") for s in text.SINGLE_FORMS)
    return f"translate({x}, '{before}', '{after}')"


_PLAIN = _Sql("lower(trim(regexp_replace(coalesce({0}, ''), '" + WS + "+', ' ', 'g')))")
_COLLAPSED = _Sql("lower(trim(regexp_replace(" + _compatible("coalesce({0}, '')") + ", '" + WS + "+', ' ', 'g')))")
_SQUEEZED = _Sql("lower(regexp_replace(" + _compatible("coalesce({0}, '')") + ", '" + WS + "+', '', 'g'))")
_BIGRAMS = _Sql("case when length({0}) = 0 then []::varchar[] else list_distinct(list_transform(range(1, greatest(length({0}) - 1, 1) + 1), lambda i: substring({0}, i, 2))) end")
_JACCARD = _Sql("case when len({0}) = 0 and len({1}) = 0 then 1.0 else len(list_intersect({0}, {1}))::double / len(list_distinct(list_concat({0}, {1}))) end")


def _edge_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    graphs_ = table(spark, sf_dir, "visual_graphs").filter("image_id is not null and model_name is not null")
    return graphs_.select(F.col("image_id").alias("graph"), F.col("model_name").alias("source_model"), F.explode("edges").alias("e")).select("graph", "source_model", "e.source", "e.target", F.coalesce("e.label", F.lit("")).alias("label")).filter("source is not null and target is not null")


def _graph_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "visual_graphs").filter("image_id is not null and model_name is not null").groupBy(F.col("image_id").alias("graph")).agg(F.count_distinct("model_name").alias("n"))


def quorum_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges fused by quorum of the models that drew the image."""
    return voting.fuse_edges(_edge_claims(spark, sf_dir), _graph_sources(spark, sf_dir)).withColumn("labels", F.array_join("labels", "|"))


_CLAIMS = "select image_id as graph, model_name as source_model, e.source as source, e.target as target, coalesce(e.label, '') as label from (select image_id, model_name, unnest(edges) as e from visual_graphs where image_id is not null and model_name is not null) where e.source is not null and e.target is not null"
_FUSED = f"""
with claims as ({_CLAIMS}), once as (select distinct graph, source, target, source_model, trim(label) as label from claims),
e as (select graph, source, target, count(distinct source_model) as support, string_agg(label, '|' order by label) as labels from once group by all),
n as (select image_id as graph, count(distinct model_name) as n from visual_graphs where image_id is not null and model_name is not null group by 1)
select e.graph, e.source, e.target, e.support, n.n, e.labels,
  case when e.support >= case when n.n <= 2 then n.n else ceil(2 * n.n / 3) end then 'fused' else 'low_support' end as status,
  exists(select 1 from e r where r.graph = e.graph and r.source = e.target and r.target = e.source) as conflict
from e join n using (graph)"""


def graph_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per image: fused and weak edges, conflicts, and whether there are too many weak ones."""
    g = quorum_vote(spark, sf_dir).groupBy("graph", "n").agg(F.count_if(F.col("status") == "fused").alias("fused"), F.count_if(F.col("status") == "low_support").alias("low"), F.count_if("conflict").alias("conflicts"))
    return g.withColumn("many_low", decisions.many_low_support(F.col("low"), F.col("fused")))


def _votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "fused_nodes").select("node_row_id", F.filter("shape_votes", lambda v: v.isNotNull() & (v != "")).alias("shapes"), F.filter("text_votes", lambda v: v.isNotNull()).alias("texts"))


def majority_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The commonest shape vote, the first seen of equally common ones, and its share."""
    return _votes(spark, sf_dir).select("node_row_id", voting.majority(F.col("shapes")).alias("majority"), F.round(voting.majority_ratio(F.col("shapes")), 6).alias("ratio"))


def representative_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shape by votes, known before unknown, then the alphabet."""
    return _votes(spark, sf_dir).select("node_row_id", voting.representative_shape(F.col("shapes")).alias("shape"))


def representative_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of the strongest group of equal votes."""
    return _votes(spark, sf_dir).select("node_row_id", voting.representative_text(F.col("texts")).alias("text"))


def text_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean pairwise similarity of a node's text votes."""
    return _votes(spark, sf_dir).select("node_row_id", F.round(voting.text_consistency(F.col("texts")), 6).alias("consistency"))


def distinct_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First-seen distinct text votes without regard to white space and case."""
    return _votes(spark, sf_dir).select("node_row_id", F.array_join(text.first_seen(F.col("texts"), "squeezed"), "|").alias("votes"))


def fuse_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes by image with support, confidence, shape and text over all rows."""
    nodes = table(spark, sf_dir, "fused_nodes").filter("image_id is not null")
    claims = nodes.select(F.col("image_id").alias("graph"), F.col("fused_id").alias("node_id"), F.explode(F.arrays_zip("support_models", "shape_votes", "text_votes")).alias("v")).select("graph", "node_id", F.col("v.support_models").alias("source_model"), labels.node_shape(F.coalesce("v.shape_votes", F.lit(""))).alias("shape"), F.coalesce("v.text_votes", F.lit("")).alias("text")).filter("source_model is not null")
    sources = claims.groupBy("graph").agg(F.count_distinct("source_model").alias("n"))
    return voting.fuse_nodes(claims, sources).select("graph", "node_id", "support", "n", F.round("confidence", 6).alias("confidence"), "shape")


def selected_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per image: claimed, selected and common nodes, and the status of the selection."""
    return voting.select_nodes(fuse_nodes(spark, sf_dir))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    outputs = table(spark, sf_dir, "model_outputs").filter("image_id is not null").groupBy("image_id").agg(F.count_distinct("model_name").alias("models"), F.count_if("success").alias("successes"), F.count("parsed").alias("parsed"))
    v = table(spark, sf_dir, "validations").filter("image_id is not null")
    detail = v.select("validation_id", "image_id", F.coalesce("evidence_score", F.lit(0.0)).alias("evidence"), F.coalesce("validator_score", F.lit(0.0)).alias("validator"), F.coalesce("hallucination_risk", F.lit(1.0)).alias("risk"), F.when(F.coalesce("details.type_conflict", F.lit(False)), 0.5).otherwise(1.0).alias("type"), F.when(F.coalesce("details.structure_conflict", F.lit(False)), 0.5).otherwise(1.0).alias("structure"), F.coalesce("details.match_ratio", F.lit(0.0)).alias("overall"), F.coalesce(F.size("critical_errors"), F.lit(0)).alias("errors"))
    return detail.join(outputs, "image_id", "left").select("*", *(F.coalesce(c, F.lit(0)).alias("n_" + c) for c in ("models", "successes", "parsed")))


def decision_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted, review or failed for every validation, with score and reasons."""
    d = _scored(spark, sf_dir)
    models, successes, parsed = F.col("n_models"), F.col("n_successes"), F.col("n_parsed")
    scores = {k: F.col(k) for k in ("overall", "type", "structure", "evidence", "validator", "risk")}
    out = d.withColumn("decision", decisions.decide(models, successes, parsed, scores, F.greatest(F.col("errors"), F.lit(0))))
    return out.select("validation_id", "decision", decisions.accept_score(*(F.col(c) for c in ("overall", "evidence", "validator", "risk"))).alias("accept_score"), F.array_join(decisions.reasons(F.col("decision"), models, successes, parsed, scores), "; ").alias("reasons"))


#: Four places as Spark rounds: half up on the shortest decimal form.
_ROUND4 = _Sql("round(cast(cast({0} as varchar) as decimal(30, 20)), 4)::double")
_GATE = " and ".join(f"{c} {'<=' if c == 'risk' else '>='} case when n_models = 2 then {decisions.THRESHOLDS[c][0]!r}::double else {decisions.THRESHOLDS[c][1]!r}::double end" for c in decisions.THRESHOLDS)
_REASONS = ", ".join(f"case when decision = 'review' and {c} {'>' if c == 'risk' else '<'} case when n_models = 2 then {decisions.THRESHOLDS[c][0]!r}::double else {decisions.THRESHOLDS[c][1]!r}::double end then '{r}' end" for c, (r, _) in decisions.REASONS.items())
_DECISION = f"""
with o as (select image_id, count(distinct model_name) as models, count_if(success) as successes, count(parsed) as parsed from model_outputs where image_id is not null group by 1),
d as (select validation_id, coalesce(evidence_score, 0) as evidence, coalesce(validator_score, 0) as validator, coalesce(hallucination_risk, 1) as risk,
  case when coalesce(details.type_conflict, false) then 0.5::double else 1.0::double end as type, case when coalesce(details.structure_conflict, false) then 0.5::double else 1.0::double end as structure,
  coalesce(details.match_ratio, 0) as overall, coalesce(len(critical_errors), 0) as errors, coalesce(o.models, 0) as n_models, coalesce(o.successes, 0) as n_successes, coalesce(o.parsed, 0) as n_parsed
  from validations left join o using (image_id) where validations.image_id is not null),
e as (select *, case when n_successes = 0 or n_parsed = 0 then 'failed' when n_parsed = 1 then 'review' when n_models > 1 and errors = 0 and {_GATE} then 'accepted' else 'review' end as decision from d)
select validation_id, decision, {_ROUND4.format('0.35 * overall + 0.30 * evidence + 0.25 * validator + 0.10 * (1 - risk)')} as accept_score,
  concat_ws('; ', case when n_successes = 0 then 'no models succeeded' when n_parsed = 0 then 'no parsable labels' when n_parsed = 1 then 'single model result cannot be auto-accepted' end,
    case when n_models > 0 and n_successes < n_models / 2 then 'less than half models succeeded' end, {_REASONS}) as reasons
from e"""


def validation_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence, validator and risk scores from match and addition ratios."""
    d = table(spark, sf_dir, "validations").filter("details is not null")
    value = lambda c, n: F.coalesce(F.col("details." + c), F.lit(n))
    s = decisions.validation_scores(value("match_ratio", 0.0), value("qwen_add_ratio", 0.0), value("type_conflict", False), value("structure_conflict", False))
    return d.select("validation_id", s.alias("s")).select("validation_id", "s.*")


def first_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first document of each collapsed text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.md5(text.document_key(F.col("text"))).alias("key"))
    return dedup.first_rows(docs, ["key"], ["doc_id"])


def edge_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges that only the drawn or only the fused graphs of an image have."""
    drawn = _edge_claims(spark, sf_dir).select("graph", "source", "target")
    fused = table(spark, sf_dir, "fused_edges").filter("image_id is not null").select(F.col("image_id").alias("graph"), "source", "target")
    return dedup.only_one_side(drawn, fused)


def longest_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten longest blocks of every image."""
    blocks = table(spark, sf_dir, "layout_blocks").filter("image_id is not null").select("image_id", "block_row_id", F.coalesce(F.length("content"), F.lit(0)).alias("n"))
    return dedup.top_rows(blocks, ["image_id"], [F.desc("n"), "block_row_id"], 10)


def crop_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page and order of every image from its id."""
    return table(spark, sf_dir, "validations").filter("image_id is not null").select("image_id").distinct().select("image_id", labels.crop_parts(F.col("image_id")).alias("p")).select("image_id", "p.*")


def page_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per model and page the last answers of its crops, in the order of the crops."""
    last = table(spark, sf_dir, "model_outputs").filter("image_id is not null and model_name is not null").groupBy("image_id", "model_name").agg(F.max_by(F.coalesce("raw_text", F.lit("")), "output_id").alias("markdown"))
    crops = last.select("image_id", "model_name", "markdown", labels.crop_parts(F.col("image_id")).alias("p")).select("image_id", "model_name", "markdown", "p.*")
    return sinks.merged_pages(crops, "model_name").select("model_name", "page_output_id", "crops", F.md5("markdown").alias("digest"))


def renumber(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of an image numbered N001.. in reading order."""
    blocks = table(spark, sf_dir, "layout_blocks").filter("image_id is not null").select(F.col("image_id").alias("graph"), "block_index", "block_row_id")
    return voting.renumbered(blocks, "block_index", "block_row_id").select(F.col("graph").alias("image_id"), "block_row_id", F.col("order_index").cast("bigint").alias("order_index"), "new_id")


def status_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots whose status differs from the image's next one."""
    s = table(spark, sf_dir, "snapshots").select("snapshot_id", "image_id", "status", "received_at")
    after = ordering.with_next(s, ["image_id"], ["received_at", "snapshot_id"], {"status": "next_status", "snapshot_id": "next_id"})
    return after.filter("next_id is not null and status is distinct from next_status").select("snapshot_id", "status", "next_status")


def markdown_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of the first Markdown table of every document."""
    cells = tables.parse_table(table(spark, sf_dir, "documents"), ["doc_id"], "text")
    return cells.select("doc_id", "row_index", "col_index", "text", "is_header")


_CELLS = r"""
with l as (select doc_id, generate_subscripts(lines, 1) as i, unnest(lines) as line from (select doc_id, list_transform(regexp_split_to_array(text, '\r?\n'), lambda x: rtrim(x)) as lines from documents where text is not null)),
c as (select *, contains(line, '|') as bar, list_transform(string_split(regexp_replace(trim(line), '^\||\|$', '', 'g'), '|'), lambda x: trim(x)) as cells from l),
s as (select *, bar and len(list_filter(cells, lambda x: not regexp_matches(x, '^:?-+:?$'))) = 0 as sep from c),
f as (select a.doc_id, min(a.i) as start from s a join s b on a.doc_id = b.doc_id and b.i = a.i + 1 where a.bar and b.sep group by 1),
e as (select f.doc_id, f.start, coalesce(min(s.i), 1000000000) as stop from f left join s on s.doc_id = f.doc_id and s.i >= f.start + 2 and not s.bar group by all),
r as (select s.doc_id, case when s.i = e.start then 0 else s.i - e.start - 1 end as row_index, s.cells, h.cells as head from s join e using (doc_id) join s h on h.doc_id = e.doc_id and h.i = e.start where s.i = e.start or (s.i >= e.start + 2 and s.i < e.stop))
select doc_id, row_index::int as row_index, (k - 1)::int as col_index, coalesce(cells[k], '') as text, row_index = 0 as is_header from (select *, unnest(range(1, len(head) + 1)) as k from r)"""


#: The source that the others are compared with.
ANCHOR = "anchor-pro"


def _last_answers(spark: SparkSession, sf_dir: str, column: str) -> DataFrame:
    """(image_id, role, output_id, column): every model's last answer to an image."""
    rows = table(spark, sf_dir, "model_outputs").filter(F.col("image_id").isNotNull() & F.col("model_name").isNotNull() & F.col(column).isNotNull())
    return rows.groupBy("image_id", F.col("model_name").alias("role")).agg(F.max(F.struct("output_id", column)).alias("r")).select("image_id", "role", "r.*")


def _against_anchor(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The anchor's rows, once for every other role that has some on the image, and the others'."""
    others = rows.filter(F.col("role") != ANCHOR)
    met = others.select("image_id", "role").distinct()
    return rows.filter(F.col("role") == ANCHOR).drop("role").join(met, "image_id"), others


def table_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of the anchor's answers and of every other model's compared cell by cell and scored."""
    cells = tables.parse_table(_last_answers(spark, sf_dir, "raw_text"), ["image_id", "role"], "raw_text")
    return tables.table_scores(tables.cell_diff(*_against_anchor(cells), ["image_id", "role"]), ["image_id", "role"])


def best_reader(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each node's voters the one whose text is nearest to the others'."""
    rows = table(spark, sf_dir, "fused_nodes").select("node_row_id", F.posexplode(F.arrays_zip("support_models", "text_votes")).alias("pos", "v")).select("node_row_id", "pos", F.col("v.support_models").alias("role"), text.squeezed(F.col("v.text_votes")).alias("t")).filter("role is not null and t != ''")
    a, b = (rows.select("node_row_id", *(F.col(c).alias(f"{c}_{s}") for c in ("pos", "role", "t"))) for s in "ab")
    pairs = a.join(b, "node_row_id").filter("pos_a < pos_b").withColumn("score", text.bigram_jaccard(F.col("t_a"), F.col("t_b")))
    return tables.best_reference(pairs, ["node_row_id"], "anchor-pro").select("node_row_id", "role", F.round("mean_score", 6).alias("mean_score"))


def best_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each text block of an image the picture, chart or table it overlaps most."""
    blocks = table(spark, sf_dir, "layout_blocks").filter("image_id is not null").select("image_id", F.col("block_row_id").alias("pos"), geometry.sorted_corners(F.col("bbox")).alias("box"), labels.block_type(F.col("block_type")).alias("kind"))
    return matching.best_overlap(blocks, ["image_id"], F.col("kind").isin(*layout.PRIMARY))


_KIND = "case coalesce(lower(trim(block_type)), '') " + " ".join(f"when '{k}' then '{v}'" for k, v in labels.BLOCK_TYPES.items()) + " else 'paragraph' end"
_OVERLAP = f"""
with b as (select image_id, block_row_id as pos, least(bbox[1], bbox[3]) as x0, least(bbox[2], bbox[4]) as y0, greatest(bbox[1], bbox[3]) as x1, greatest(bbox[2], bbox[4]) as y1, {_KIND} in ('chart', 'image', 'table') as target
  from layout_blocks where image_id is not null and len(bbox) = 4 and len(list_filter(bbox, lambda v: v is null)) = 0),
p as (select a.image_id, a.pos, t.pos as target_pos, (least(a.x1, t.x1) - greatest(a.x0, t.x0)) * (least(a.y1, t.y1) - greatest(a.y0, t.y0)) as cut, (a.x1 - a.x0) * (a.y1 - a.y0) + (t.x1 - t.x0) * (t.y1 - t.y0) as areas
  from b a join b t on a.image_id = t.image_id and not a.target and t.target and least(a.x1, t.x1) > greatest(a.x0, t.x0) and least(a.y1, t.y1) > greatest(a.y0, t.y0)),
s as (select *, {_ROUND4.format('cut / (areas - cut)')} as overlap from p)
select image_id, pos, target_pos, overlap from s where overlap > 0 qualify row_number() over (partition by image_id, pos order by overlap desc, target_pos) = 1"""


def page_hulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hull of an image's blocks."""
    blocks = table(spark, sf_dir, "layout_blocks").filter("image_id is not null").select("image_id", geometry.sorted_corners(F.col("bbox")).alias("box")).filter("box is not null")
    return blocks.groupBy("image_id").agg(geometry.hull(F.col("box")).alias("h"), F.count("*").alias("blocks")).select("image_id", "blocks", *(F.col("h")[k].alias(n) for k, n in enumerate(("x0", "y0", "x1", "y1"))))


def crop_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Caption groups of every image; page headers and footers serve as captions here."""
    raw = table(spark, sf_dir, "layout_blocks").filter("image_id is not null")
    context = (*layout.CONTEXT, "page_footer", "title")
    blocks = layout.sound_blocks(raw, "image_id", "block_index", "block_type", "bbox", ("block_row_id",), context)
    return layout.crop_groups(blocks, "image_id", most_gap=80.0, context=context)


def _drawn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "visual_graphs").select(F.col("graph_id").alias("graph"), F.explode("edges").alias("e")).select("graph", "e.source", "e.target").filter("source is not null and target is not null")


def reachability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of nodes of a drawn graph with a path."""
    return graphs.reachable(_drawn(spark, sf_dir))


def node_depths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps of every node from the roots of its drawn graph."""
    edges = _drawn(spark, sf_dir)
    ends = edges.select("graph", F.col("source").alias("node_id")).unionAll(edges.select("graph", F.col("target"))).distinct()
    return graphs.depths(ends.withColumn("order_index", labels.node_index(F.col("node_id"))), edges).select("graph", "node_id", F.col("depth").cast("bigint").alias("depth"))


def pruned_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fused nodes without those that only weak edges touch and whose texts disagree."""
    votes = table(spark, sf_dir, "fused_nodes").filter("image_id is not null")
    per = votes.groupBy("image_id", "fused_id").agg(F.flatten(F.collect_list("text_votes")).alias("texts"), F.size(F.array_distinct(F.flatten(F.collect_list("support_models")))).alias("support"))
    sources = votes.select("image_id", F.explode("support_models").alias("m")).groupBy("image_id").agg(F.count_distinct("m").alias("n"))
    nodes = per.join(sources, "image_id").select(F.col("image_id").alias("graph"), F.col("fused_id").alias("node_id"), "support", "n", voting.text_consistency(F.col("texts")).alias("text_consistency"))
    edges = quorum_vote(spark, sf_dir).select("graph", "source", "target", "status")
    return graphs.pruned(nodes, edges.filter("status = 'fused'"), edges.filter("status = 'low_support'")).select("graph", "node_id", "support", "n")


def diagrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes and edges of every snapshot's code, parsed and written back."""
    return graphs.parsed(table(spark, sf_dir, "snapshots"), "snapshot_id", "code").select("snapshot_id", "direction", F.size("nodes").alias("nodes"), F.size("edges").alias("edges"))


def _compared_diagrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = table(spark, sf_dir, "snapshots").filter("code is not null and image_id is not null and origin in ('gold_file', 'final_mermaid')").groupBy("image_id", "origin").agg(F.max_by("code", "snapshot_id").alias("code"), F.max("snapshot_id").alias("snapshot_id"))
    drawn = graphs.parsed(last, "snapshot_id", "code").join(last.select("snapshot_id", "image_id", "origin"), "snapshot_id")
    side = lambda o, s: drawn.filter(F.col("origin") == o).select("image_id", F.col("nodes").alias("nodes_" + s), F.col("edges").alias("edges_" + s))
    return comparison.compared(side("gold_file", "a").join(side("final_mermaid", "b"), "image_id"), ["image_id"])


def graph_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold diagram of an image against its final one, under the best mapping."""
    return _compared_diagrams(spark, sf_dir).drop("differences")


def graph_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the final diagram of an image lacks of the gold one or has otherwise."""
    return _compared_diagrams(spark, sf_dir).select("image_id", F.explode("differences").alias("d")).select("image_id", "d.*")


def model_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ordered blocks of every model's answer."""
    return payloads.blocks(table(spark, sf_dir, "model_outputs"), "output_id", "parsed")


def _documents(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The anchor's blocks and those of every other model, by image and other role."""
    last = materialise(_last_answers(spark, sf_dir, "parsed"))
    rows = payloads.blocks(last, "output_id", "parsed").withColumnRenamed("record_id", "output_id").join(last.select("output_id", "image_id", "role"), "output_id")
    return _against_anchor(materialise(rows.select("image_id", "role", "page_idx", F.col("order_index").alias("pos"), "box", "text", "kind")))


_PAIR = ["image_id", "role"]


def align_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of the anchor's answer matched one to one with those of every other model."""
    return matching.align(*_documents(spark, sf_dir), _PAIR)


def unmatched_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of other models that no anchor block takes, of kinds worth adding."""
    base, other = _documents(spark, sf_dir)
    return matching.leftovers(other, matching.align(base, other, _PAIR), _PAIR, "b").filter(F.col("kind").isin("chart", "table", "image")).select(*_PAIR, "page_idx", "pos", "kind", "text")


def merged_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The anchor's blocks, empty texts filled from their match, and unmatched blocks worth
    adding appended to their page."""
    base, other = _documents(spark, sf_dir)
    return matching.merged(base, other, matching.align(base, other, _PAIR), _PAIR, ("chart", "table", "image"))


def page_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Markdown of every page of every answer."""
    rows = model_blocks(spark, sf_dir)
    return sinks.page_markdown(rows.withColumn("fragment", sinks.markdown_fragment(F.col("kind"), F.col("text"), F.col("text_level"), F.array().cast("array<string>"))), ["record_id"])


def number_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of every block with their units."""
    rows = table(spark, sf_dir, "ocr_regions").select("region_id", F.posexplode(text.numbers_with_units(F.col("text"))).alias("pos", "x"))
    return rows.select("region_id", "pos", "x.value", "x.unit")


def token_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens used per model, from the answers' usage records."""
    n = lambda p: F.sum(F.coalesce(F.get_json_object("parsed", p).try_cast("bigint"), F.lit(0)))
    return table(spark, sf_dir, "model_outputs").groupBy("model_name").agg(F.count("*").alias("answers"), n("$.usage.prompt_tokens").alias("prompt_tokens"), n("$.usage.completion_tokens").alias("completion_tokens"))


def block_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks by canonical type."""
    return table(spark, sf_dir, "layout_blocks").groupBy(labels.block_type(F.col("block_type")).alias("kind")).agg(F.count("*").alias("blocks"))


def region_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recognised regions by role and confidence."""
    return table(spark, sf_dir, "ocr_regions").groupBy(labels.ocr_role(F.col("role")).alias("role"), labels.confidence(F.col("confidence")).alias("confidence")).agg(F.count("*").alias("regions"))


def summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per image: answers, successes, models, latency, first error."""
    return sinks.summary(table(spark, sf_dir, "model_outputs").filter("image_id is not null"))


def best_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each image its code from the first origin that has one."""
    s = table(spark, sf_dir, "snapshots").filter("image_id is not null and code is not null")
    parts = [s.filter(F.col("origin") == o).groupBy("image_id").agg(F.max("snapshot_id").alias("snapshot_id")).withColumn("origin", F.lit(o)) for o in ORIGINS]
    return dedup.ranked_union(parts, ["image_id"])


#: Origins of diagram code in the order of trust (fixed values).
ORIGINS = ("final_mermaid", "legacy_dump", "artifact_block", "derived_label")


def images_without_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validated images without any snapshot that holds code."""
    code = table(spark, sf_dir, "snapshots").filter("code is not null").select("image_id")
    return table(spark, sf_dir, "validations").filter("image_id is not null").select("image_id").distinct().join(code, "image_id", "left_anti")


def patched_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks after the findings' corrections: quotes of severe findings replace texts."""
    finding = table(spark, sf_dir, "validations").filter("image_id is not null").select("image_id", "validation_id", F.posexplode("details.checks").alias("i", "c")).select("image_id", "validation_id", "i", F.posexplode("c.findings").alias("j", "f"))
    rows = finding.select("image_id", F.col("f.target_block_id").alias("block_id"), (F.col("validation_id") * 10000 + F.col("i") * 100 + F.col("j")).alias("decision_no"), F.when(F.col("f.severity") == "high", "replace").otherwise("keep").alias("decision"), F.try_element_at("f.evidence", F.lit(1))["quote"].alias("text"))
    blocks = table(spark, sf_dir, "layout_blocks").filter("image_id is not null").select("image_id", F.concat(F.lit("b"), "block_index").alias("block_id"), F.col("block_index").alias("order_index"), F.col("content").alias("text"))
    first = blocks.groupBy("image_id", "block_id", "order_index").agg(F.max("text").alias("text"))
    return patches.apply_patches(first, rows, ["image_id"]).select("image_id", "block_id", F.col("order_index").cast("bigint").alias("order_index"), "text", "patched")


_PATCHED = """
with f as (select image_id, validation_id, i, generate_subscripts(c.findings, 1) - 1 as j, unnest(c.findings) as f from (select image_id, validation_id, generate_subscripts(details.checks, 1) - 1 as i, unnest(details.checks) as c from validations where image_id is not null)),
d as (select image_id, f.target_block_id as block_id, validation_id * 10000 + i * 100 + j as no, f.evidence[1].quote as text from f where f.severity = 'high' and f.target_block_id is not null),
l as (select image_id, block_id, arg_max(text, no) filter (text is not null) as patch, min(no) as first_no from d group by all),
b as (select image_id, 'b' || block_index as block_id, block_index as order_index, max(content) as text from layout_blocks where image_id is not null group by all),
top as (select image_id, max(order_index) as top from b group by 1)
select b.image_id, b.block_id, b.order_index::bigint as order_index, coalesce(l.patch, b.text) as text, l.first_no is not null as patched from b left join l using (image_id, block_id)
union all
select image_id, block_id, (coalesce(top.top, 0) + row_number() over (partition by image_id order by first_no, block_id))::bigint, patch, true from (select * from l anti join b using (image_id, block_id)) left join top using (image_id)"""


def hourly_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers and successes per model and hour; the same plan runs on a stream."""
    rows = table(spark, sf_dir, "model_outputs").filter("captured_at is not null")
    return incremental.tumbling(rows, "captured_at").withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


def latest_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last received answer of each image and model."""
    return incremental.latest(table(spark, sf_dir, "model_outputs").filter("image_id is not null")).select("image_id", "model_name", "output_id", "success")


def gold_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final diagrams with the gold one of their image and whether the texts are equal."""
    s = table(spark, sf_dir, "snapshots").filter("image_id is not null")
    final = s.filter("origin = 'final_mermaid'").select("snapshot_id", "image_id", text.squeezed(F.col("code")).alias("code"))
    gold = s.filter("origin = 'gold_file' and code is not null").groupBy("image_id").agg(F.max_by(text.squeezed(F.col("code")), "snapshot_id").alias("gold"))
    return final.join(gold, "image_id", "left").select("snapshot_id", F.col("gold").isNotNull().alias("has_gold"), F.coalesce(F.col("code") == F.col("gold"), F.lit(False)).alias("equal"))


def neighbour_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similarity of each block's text with the next one's of its image."""
    blocks = table(spark, sf_dir, "layout_blocks").filter("image_id is not null").select("image_id", "block_index", "block_row_id", "content")
    pairs = ordering.with_next(blocks, ["image_id"], ["block_index", "block_row_id"], {"content": "following"})
    rows = pairs.select("block_row_id", F.coalesce("content", F.lit("")).alias("a"), F.coalesce("following", F.lit("")).alias("b"))
    return rows.select("block_row_id", F.round(text.bigram_jaccard(text.squeezed(F.col("a")), text.squeezed(F.col("b"))), 6).alias("bigram"), F.round(text.keyword_similarity(F.col("a"), F.col("b")), 6).alias("keyword"))


def block_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes in whole per mille."""
    rows = table(spark, sf_dir, "layout_blocks").filter("bbox is not null and size(bbox) = 4").select("block_row_id", geometry.per_mille(F.col("bbox")).alias("b"))
    return rows.select("block_row_id", *(F.col("b")[k].alias(n) for k, n in enumerate(("x0", "y0", "x1", "y1"))))


def seal_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images whose models read different texts in one role."""
    rows = table(spark, sf_dir, "ocr_regions").filter("image_id is not null and text is not null").select("image_id", "model_name", "role", text.squeezed(F.col("text")).alias("t")).filter("t != '' and role is not null")
    sets = rows.groupBy("image_id", "role", "model_name").agg(F.array_join(F.sort_array(F.collect_set("t")), "|").alias("texts"))
    return sets.groupBy("image_id", "role").agg(F.count("*").alias("models"), F.count_distinct("texts").alias("readings")).filter("readings > 1")


def model_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels in the models' raw answers, in normal form."""
    return scoring.label_rows(table(spark, sf_dir, "model_outputs"), "output_id", "raw_text")


def label_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agreement of the labels of every image."""
    outputs = table(spark, sf_dir, "model_outputs").filter("image_id is not null and model_name is not null")
    rows = scoring.label_rows(outputs, "output_id", "raw_text")
    return scoring.consensus(rows.join(outputs.select(F.col("output_id").alias("record_id"), "image_id", "model_name"), "record_id"))


def document_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conflicts between the anchor's blocks and those of every other model."""
    base, other = _documents(spark, sf_dir)
    return issues.detect(base, other, matching.align(base, other, _PAIR), _PAIR)


def issue_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Those conflicts with the last verdict on each, from the judgements on the same image."""
    given = read_verdicts(spark, sf_dir).join(table(spark, sf_dir, "model_outputs").select(F.col("output_id").alias("record_id"), "image_id"), "record_id")
    found = document_issues(spark, sf_dir)
    roles = found.select("image_id", "role").distinct()
    return issues.outcomes(found, given.join(roles, "image_id"), _PAIR)


def judge_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on issues among the raw answers."""
    return issues.verdicts(table(spark, sf_dir, "model_outputs"), "output_id", "raw_text")


def read_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on issues among the raw answers, also fenced and cut ones."""
    return issues.read_verdicts(table(spark, sf_dir, "model_outputs"), "output_id", "raw_text")


def verdict_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts by decision, and those that carry a patch."""
    return judge_verdicts(spark, sf_dir).groupBy("decision").agg(F.count("*").alias("verdicts"), F.count("patch_text").alias("patches"))


def text_similarities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first two text votes of every node under each similarity of texts."""
    rows = table(spark, sf_dir, "fused_nodes").select("node_row_id", F.coalesce(F.get("text_votes", F.lit(0)), F.lit("")).alias("a"), F.coalesce(F.get("text_votes", F.lit(1)), F.lit("")).alias("b"))
    a, b = F.col("a"), F.col("b")
    forms = {
        "alignment": text.alignment_similarity(a, b), "keywords": text.keyword_similarity(a, b), "characters": text.char_similarity(a, b), "phrase": text.phrase_similarity(a, b),
        "field": text.field_similarity(a, b), "equal_field": text.field_equality(a, b), "title": text.title_alignment(a, b), "visible": text.visible_alignment(a, b),
        "lists": text.list_overlap(F.array(a), F.array(a, b)),
    }
    return rows.select("node_row_id", text.compact(a).alias("compact"), text.without_title_prefix(a).alias("bare_title"), text.visible_score(a).alias("visible_score"), text.has_cjk(a).alias("cjk"), *(F.round(v, 6).alias(k) for k, v in forms.items()))


def _similarity_sql() -> str:
    """The same in SQL: forms first, then each similarity from them."""
    token, jac = r"[\x{4e00}-\x{9fff}A-Za-z0-9_]+", _JACCARD.format
    compact = _Sql("regexp_replace(lower({0}), '[^0-9a-z\\x{4e00}-\\x{9fff}]', '', 'g')")
    title = _Sql("trim(regexp_replace({0}, '^' || '" + WS + "*(?:figure|fig\\.?|table|chart|图表|图|表)" + WS + "*\\d+(?:[.\\-]\\d+)*" + WS + "*[:：.、\\-]?" + WS + "*', '', 'i'))")
    words = _Sql("list_distinct(regexp_extract_all(lower({0}), '" + token + "'))")
    char = _Sql("case when c{0} = '' or c{1} = '' then 0.0 when c{0} = c{1} then 1.0 else " + jac("p{0}", "p{1}") + " end")
    inside = _Sql("case when {0} = '' or {1} = '' then 0.0 when {0} = {1} then 1.0 when contains({0}, {1}) or contains({1}, {0}) then {2} + {3} * least(length({0}), length({1}))::double / greatest(length({0}), length({1})) else {4} end")
    ratio = "least(length(x), length(y))::double / greatest(length(x), length(y))"
    key = "case when len(ka) = 0 or len(kb) = 0 then 0.0 else " + jac("ka", "kb") + " end"
    phrase = f"case when x = '' or y = '' then 0.0 when x = y then 1.0 else greatest(case when contains(x, y) or contains(y, x) then 0.45 + 0.5 * {ratio} else 0.0 end, 0.6 * kw + 0.4 * ch, ch) end"
    return rf"""
with r as (select node_row_id, coalesce(text_votes[1], '') as a, coalesce(text_votes[2], '') as b from fused_nodes),
f as (select *, {_COLLAPSED.format('a')} as ca, {_COLLAPSED.format('b')} as cb, {_SQUEEZED.format('a')} as sa, {_SQUEEZED.format('b')} as sb, {compact.format('a')} as x, {compact.format('b')} as y, {words.format('a')} as ka, {words.format('b')} as kb, {title.format('a')} as ta, {title.format('b')} as tb from r),
g as (select *, {_BIGRAMS.format('ca')} as pa, {_BIGRAMS.format('cb')} as pb, {_BIGRAMS.format('sa')} as qa, {_BIGRAMS.format('sb')} as qb, {compact.format('ta')} as xt, {compact.format('tb')} as yt, {_COLLAPSED.format('ta')} as cta, {_COLLAPSED.format('tb')} as ctb from f),
h as (select *, {_BIGRAMS.format('cta')} as pta, {_BIGRAMS.format('ctb')} as ptb, {key} as kw, {char.format('a', 'b')} as ch from g),
i as (select *, {char.format('ta', 'tb')} as cht, {phrase} as ph from h),
j as (select *, case when x = '' then 0.0 else 1.0 end as self, case when y = '' then 0.0 else 1.0 end as other from i)
select node_row_id, x as compact, ta as bare_title, coalesce(list_sum(list_transform(regexp_extract_all(a, '{token}'), lambda t: length(t))), 0)::int as visible_score, regexp_matches(a, '[\x{{4e00}}-\x{{9fff}}]') as cjk,
  case when sa = sb then 1.0 when sa = '' or sb = '' then 0.0 else round({jac('qa', 'qb')}, 4) end as alignment, round(kw, 6) as keywords, round(ch, 6) as characters, round(ph, 6) as phrase,
  round(case when ca = '' and cb = '' then 0.5 else ch end, 6) as field, (case when ca = '' and cb = '' then 0.5 when ca = cb then 1.0 else 0.0 end)::double as equal_field,
  round({inside.format('xt', 'yt', '0.75', '0.25', 'cht')}, 6) as title, round({inside.format('x', 'y', '0.45', '0.5', 'ch')}, 6) as visible,
  round((greatest(self, ph) + (self + ph) / 2) / 2, 6) as lists from j"""


def box_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every block's box against the hull of its image, and in pixels of a page of 1000 x 700."""
    blocks = table(spark, sf_dir, "layout_blocks").filter("image_id is not null").select("image_id", "block_row_id", geometry.sorted_corners(F.col("bbox")).alias("box")).filter("box is not null")
    hulls = blocks.groupBy("image_id").agg(geometry.hull(F.col("box")).alias("hull"))
    a, b = F.col("box"), F.col("hull")
    rows = blocks.join(hulls, "image_id")
    pixels = geometry.to_pixels(a, F.lit(1000), F.lit(700), 2)
    measures = {"overlap": geometry.iou(a, b), "distance": F.round(geometry.center_distance(a, b), 6), "horizontal": F.round(geometry.horizontal_overlap(a, b), 6), "gap": geometry.vertical_gap(a, b)}
    return rows.select("block_row_id", *(v.cast("double").alias(k) for k, v in measures.items()), *(pixels[k].alias(n) for k, n in enumerate(("left", "top", "right", "bottom"))))


_MEASURES = f"""
with b as (select image_id, block_row_id, least(bbox[1], bbox[3]) as x0, least(bbox[2], bbox[4]) as y0, greatest(bbox[1], bbox[3]) as x1, greatest(bbox[2], bbox[4]) as y1 from layout_blocks where image_id is not null and len(bbox) = 4 and len(list_filter(bbox, lambda v: v is null)) = 0),
h as (select image_id, min(x0) as u0, min(y0) as v0, max(x1) as u1, max(y1) as v1 from b group by 1),
j as (select *, (x1 - x0) * (y1 - y0) as own, (u1 - u0) * (v1 - v0) as whole, case when greatest(abs(x0), abs(y0), abs(x1), abs(y1)) <= 1.5 then 1.0 else 1000.0 end as unit from b join h using (image_id)),
p as (select *, greatest(0, floor(x0 / unit * 1000)::int - 2) as "left", greatest(0, floor(y0 / unit * 700)::int - 2) as "top", least(1000, ceil(x1 / unit * 1000)::int + 2) as r, least(700, ceil(y1 / unit * 700)::int + 2) as bo from j)
select block_row_id, case when whole <= 0 then 0.0 else {_ROUND4.format('own / whole')} end as overlap, round(sqrt(((x0 + x1 - u0 - u1) / 2) ** 2 + ((y0 + y1 - v0 - v1) / 2) ** 2), 6) as distance,
  round(greatest(0.0, x1 - x0) / least(greatest(1e-6, x1 - x0), greatest(1e-6, u1 - u0)), 6) as horizontal, case when y1 < v0 then v0 - y1 when v1 < y0 then y0 - v1 else 0.0 end as gap,
  "left", "top", greatest(r, "left" + 1) as "right", greatest(bo, "top" + 1) as bottom from p"""


def value_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids, coercions and messages of every answer in normal form."""
    rows = table(spark, sf_dir, "model_outputs")
    n = F.col("latency_ms")
    return rows.select(
        "output_id", labels.node_id(F.col("image_id"), F.col("output_id")).alias("node_id"), labels.node_index(F.col("image_id")).alias("node_index"), labels.file_stem(F.concat(F.lit("in/"), F.col("image_id"), F.lit(".png"))).alias("stem"),
        labels.positive_int(n.cast("string")).alias("latency"), labels.image_type(F.col("source_type")).alias("kind"), labels.default_source_type(F.col("model_name")).alias("source_type"), text.joined_errors(F.col("error"), F.lit(""), F.col("vendor")).alias("message"),
        text.clamp(n / 5000).alias("share"), F.round(text.ratio_similarity(n.cast("double"), F.lit(1000.0)), 6).alias("ratio"), F.round(text.optional_number_similarity(n, F.lit(1000)), 6).alias("near"),
    )


_FORMS = r"""
with n as (select *, regexp_extract(coalesce(image_id, ''), '(\d+)', 1) as digits, latency_ms::double as l, lower(trim(coalesce(source_type, ''))) as k from model_outputs)
select output_id, 'N' || lpad(coalesce(try_cast(digits as int), output_id)::varchar, greatest(3, length(coalesce(try_cast(digits as int), output_id)::varchar))::int, '0') as node_id, try_cast(regexp_extract(image_id, '(\d+)', 1) as int) as node_index, image_id as stem,
  case when latency_ms > 0 then latency_ms::int end as latency,
  case when k in ('flowchart', 'chart', 'table', 'seal', 'document', 'screenshot', 'diagram', 'natural_image', 'mixed', 'unknown') then k when regexp_matches(k, 'flow') then 'flowchart' when regexp_matches(k, 'chart|plot|graph') then 'chart' when regexp_matches(k, 'table') then 'table'
    when regexp_matches(k, 'seal|stamp') then 'seal' when regexp_matches(k, 'screen') then 'screenshot' when regexp_matches(k, 'doc') then 'document' when regexp_matches(k, 'diagram') then 'diagram' when regexp_matches(k, 'natural|photo|scene') then 'natural_image' when regexp_matches(k, 'mixed') then 'mixed' else 'unknown' end as kind,
  case when model_name like '%\_local' escape '\' then 'local_service' else 'remote_service' end as source_type, nullif(concat_ws('; ', nullif(error, ''), nullif(vendor, '')), '') as message,
  case when l is not null then greatest(0.0, least(1.0, l / 5000)) end as share, round(case when l = 0 then 0.0 else least(l, 1000.0) / greatest(l, 1000.0) end, 6) as ratio, round(case when l is null then 0.0 else greatest(0.0, 1 - abs(l - 1000) / greatest(abs(l), 1000)) end, 6) as near from n"""


QUERIES = {f.__name__: f for f in (text_similarities, box_measures, value_forms,
    quorum_vote, graph_support, majority_first, representative_shape, representative_text, text_consistency, distinct_votes, fuse_nodes, selected_nodes, decision_gate, validation_scores, first_copies,
    edge_differences, longest_blocks, crop_identity, page_merge, renumber, status_changes, markdown_cells, table_diff, best_reader, best_overlap, page_hulls, crop_groups, reachability, node_depths, pruned_nodes,
    diagrams, graph_similarity, graph_differences, model_blocks, align_blocks, unmatched_blocks, merged_blocks, issue_outcomes, page_markdown, number_units, token_usage, block_kinds, region_labels, summaries, best_snapshots, images_without_code, patched_blocks,
    hourly_answers, latest_answers, gold_matches, neighbour_similarity, block_boxes, seal_conflicts, model_labels, label_consensus, document_issues, judge_verdicts, read_verdicts, verdict_counts,
)}

_SHAPES = "select node_row_id, generate_subscripts(s, 1) as pos, unnest(s) as v from (select node_row_id, list_filter(shape_votes, lambda x: x is not null and x != '') as s from fused_nodes)"
_TEXTS = "select node_row_id, generate_subscripts(s, 1) as pos, unnest(s) as v from (select node_row_id, list_filter(text_votes, lambda x: x is not null) as s from fused_nodes)"
_RANKED = f"select node_row_id, v, count(*) as n, min(pos) as first from ({_SHAPES}) group by all"
_NODE_CLAIMS = "select image_id as graph, fused_id as node_id, unnest(support_models) as m, unnest(shape_votes) as s from fused_nodes where image_id is not null"
_NODES = f"""
with c as (select graph, node_id, m, case when lower(trim(coalesce(s, ''))) in ('rectangle', 'rounded', 'diamond', 'ellipse') then lower(trim(s)) else 'unknown' end as s from ({_NODE_CLAIMS}) where m is not null),
n as (select graph, count(distinct m) as n from c group by 1), once as (select graph, node_id, m, min(s) as s from c group by all),
sup as (select graph, node_id, count(*) as support from once group by all),
sh as (select graph, node_id, s as shape from (select graph, node_id, s, count(*) as k from once group by all) qualify row_number() over (partition by graph, node_id order by k desc, s = 'unknown', s) = 1)
select graph, node_id, support, n, round(support / n, 6) as confidence, shape from sup join n using (graph) join sh using (graph, node_id)"""
_BEST_READER = f"""
with r as (select node_row_id, pos, role, t from (select node_row_id, generate_subscripts(support_models, 1) as pos, unnest(support_models) as role, unnest(text_votes) as v from fused_nodes) q, lateral (select {_SQUEEZED.format('q.v')} as t) where role is not null and t != ''),
g as (select *, {_BIGRAMS.format('t')} as b from r),
p as (select a.node_row_id, a.role as ra, b.role as rb, {_JACCARD.format('a.b', 'b.b')} as score from g a join g b on a.node_row_id = b.node_row_id and a.pos < b.pos),
m as (select node_row_id, role, round(avg(score), 9) as mean_score from (select node_row_id, ra as role, score from p union all select node_row_id, rb, score from p) group by all)
select node_row_id, role, round(mean_score, 6) as mean_score from m qualify row_number() over (partition by node_row_id order by mean_score desc, role != 'anchor-pro', role) = 1"""
_UNITS = text.UNITS
_VERDICTS = """
with v as (select output_id as record_id, json_extract_string(raw_text, '$.issue_id') as issue_id, lower(trim(coalesce(json_extract_string(raw_text, '$.decision'), ''))) as d, json_extract_string(raw_text, '$.patch.text') as patch_text, trim(json_extract_string(raw_text, '$.reason')) as reason
  from (select output_id, case when json_valid(raw_text) then raw_text end as raw_text from model_outputs where raw_text like '{%'))
select record_id, issue_id, case when d in ('merge', 'reject_issue') then d when regexp_matches(d, '^keep_(candidate|fusion|graph_candidate)') then 'keep_candidate' when regexp_matches(d, '^(use|adopt)_') then 'use_reference' when regexp_matches(d, '^add_') then 'add_block' else 'keep_anchor' end as decision,
  patch_text, coalesce(nullif(reason, ''), 'patch_applied') as reason from v where issue_id is not null"""
SQL = {
    "text_similarities": _similarity_sql(),
    "box_measures": _MEASURES,
    "value_forms": _FORMS,
    "judge_verdicts": _VERDICTS,
    "verdict_counts": f"select decision, count(*) as verdicts, count(patch_text) as patches from ({_VERDICTS}) group by 1",
    "quorum_vote": _FUSED,
    "graph_support": f"with q as ({_FUSED}), g as (select graph, n, count_if(status = 'fused') as fused, count_if(status = 'low_support') as low, count_if(conflict) as conflicts from q group by all) select *, case when low = 0 then false when fused = 0 or low >= fused then true else low >= 3 and low / (low + fused) >= 0.35 end as many_low from g",
    "majority_first": f"with r as ({_RANKED}) select f.node_row_id, m.v as majority, coalesce(round(m.n / m.total, 6), 0) as ratio from fused_nodes f left join (select *, sum(n) over (partition by node_row_id) as total from r qualify row_number() over (partition by node_row_id order by n desc, first) = 1) m using (node_row_id)",
    "representative_shape": f"with r as ({_RANKED}) select f.node_row_id, coalesce(m.v, 'unknown') as shape from fused_nodes f left join (select * from r qualify row_number() over (partition by node_row_id order by n desc, v = 'unknown', v) = 1) m using (node_row_id)",
    "representative_text": f"""with k as (select node_row_id, v, {_COLLAPSED.format('v')} as k from ({_TEXTS})), g as (select node_row_id, k, count(*) as n, max(v) as v, list_sum(list_transform(regexp_extract_all(k, '[\\x{{4e00}}-\\x{{9fff}}A-Za-z0-9_]+'), lambda x: length(x))) as s from k where k != '' group by all)
select f.node_row_id, coalesce(m.v, '') as text from fused_nodes f left join (select * from g qualify row_number() over (partition by node_row_id order by n desc, coalesce(s, 0) desc, length(k) desc, k) = 1) m using (node_row_id)""",
    "text_consistency": f"""with k as (select node_row_id, pos, k, {_BIGRAMS.format('k')} as b from (select node_row_id, pos, {_COLLAPSED.format('v')} as k from ({_TEXTS})) where k != ''),
p as (select a.node_row_id, avg({_JACCARD.format('a.b', 'b.b')}) as s from k a join k b on a.node_row_id = b.node_row_id and a.pos < b.pos group by 1) select f.node_row_id, coalesce(round(p.s, 6), 1.0) as consistency from fused_nodes f left join p using (node_row_id)""",
    "distinct_votes": f"with k as (select node_row_id, pos, v, {_SQUEEZED.format('v')} as k from ({_TEXTS}) where trim(v) != ''), d as (select * from k qualify row_number() over (partition by node_row_id, k order by pos) = 1) select f.node_row_id, coalesce(m.votes, '') as votes from fused_nodes f left join (select node_row_id, string_agg(v, '|' order by pos) as votes from d group by 1) m using (node_row_id)",
    "fuse_nodes": _NODES,
    "selected_nodes": f"with f as ({_NODES}), g as (select graph, n, count(*) as claimed, count_if(support >= case when n <= 2 then n else ceil(2 * n / 3) end) as selected, count_if(support = n) as common from f group by all) select *, case when selected = 0 then 'failed' when common = claimed then 'fused' when n = 2 then 'partial' when selected < claimed then 'partial' else 'fused' end as status from g",
    "decision_gate": _DECISION,
    "validation_scores": f"""with d as (select validation_id, coalesce(details.match_ratio, 0) as m, coalesce(details.qwen_add_ratio, 0) as a, coalesce(details.type_conflict, false)::int as t, coalesce(details.structure_conflict, false)::int as s from validations where details is not null)
select validation_id, {_ROUND4.format('greatest(0, least(1, 0.55 + 0.35 * m - 0.10 * a))')} as evidence, {_ROUND4.format('greatest(0, least(1, 0.60 + 0.25 * m - 0.10 * t - 0.10 * s))')} as validator, {_ROUND4.format('greatest(0, least(1, 0.10 + 0.35 * (1 - m) + 0.20 * a + 0.15 * s))')} as risk from d""",
    "first_copies": f"select min(doc_id) as doc_id, key from (select doc_id, md5({_PLAIN.format('text')}) as key from documents) group by key",
    "edge_differences": f"with a as (select distinct graph, source, target from ({_CLAIMS})), b as (select distinct image_id as graph, source, target from fused_edges where image_id is not null) (select * from a except select * from b) union all (select * from b except select * from a)",
    "longest_blocks": "select image_id, block_row_id, coalesce(length(content), 0) as n from layout_blocks where image_id is not null qualify row_number() over (partition by image_id order by n desc, block_row_id) <= 10",
    "crop_identity": r"""select image_id, nullif(regexp_extract(image_id, '^(.*_p_?\d+)_r_?(\d+)_.+$', 1), '') as page_output_id, nullif(regexp_extract(image_id, '^(.*_p_?\d+)_r_?(\d+)_.+$', 2), '') as merge_order from (select distinct image_id from validations where image_id is not null)""",
    "page_merge": r"""with l as (select image_id, model_name, arg_max(coalesce(raw_text, ''), output_id) as m from model_outputs where model_name is not null and image_id is not null group by 1, 2),
c as (select image_id, model_name, trim(m) as m, nullif(regexp_extract(image_id, '^(.*_p_?\d+)_r_?(\d+)_.+$', 1), '') as page, regexp_extract(image_id, '^(.*_p_?\d+)_r_?(\d+)_.+$', 2) as o from l)
select model_name, page as page_output_id, count(*) as crops, md5(string_agg(m, E'\n\n' order by try_cast(o as bigint), o, image_id)) as digest from c where page is not null and m != '' group by 1, 2""",
    "renumber": "select image_id, block_row_id, n as order_index, printf('N%03d', n) as new_id from (select image_id, block_row_id, row_number() over (partition by image_id order by block_index, block_row_id) as n from layout_blocks where image_id is not null)",
    "status_changes": "select snapshot_id, status, next_status from (select snapshot_id, status, lead(status) over w as next_status, lead(snapshot_id) over w as next_id from snapshots window w as (partition by image_id order by received_at, snapshot_id)) where next_id is not null and status is distinct from next_status",
    "markdown_cells": _CELLS,
    "best_reader": _BEST_READER,
    "best_overlap": _OVERLAP,
    "page_hulls": "select image_id, count(*) as blocks, min(least(bbox[1], bbox[3])) as x0, min(least(bbox[2], bbox[4])) as y0, max(greatest(bbox[1], bbox[3])) as x1, max(greatest(bbox[2], bbox[4])) as y1 from layout_blocks where image_id is not null and len(bbox) = 4 and len(list_filter(bbox, lambda v: v is null)) = 0 group by 1",
    "reachability": "with recursive e as (select distinct graph, s as source, t as target from (select graph_id as graph, unnest(edges).source as s, unnest(edges).target as t from visual_graphs) where s is not null and t is not null), r as (select * from e union select r.graph, r.source, e.target from r join e on r.graph = e.graph and r.target = e.source) select * from r",
    "node_depths": """with recursive e as (select distinct graph, s as source, t as target from (select graph_id as graph, unnest(edges).source as s, unnest(edges).target as t from visual_graphs) where s is not null and t is not null),
n as (select graph, source as node_id from e union select graph, target from e), roots as (select n.* from n anti join e on n.graph = e.graph and n.node_id = e.target),
size as (select graph, count(*) as nodes from n group by 1),
d as (select graph, node_id, 1 as depth from roots union select d.graph, e.target, d.depth + 1 from d join e on d.graph = e.graph and d.node_id = e.source join size on size.graph = d.graph where d.depth < size.nodes)
select n.graph, n.node_id, coalesce(min(d.depth), greatest(1, coalesce(try_cast(nullif(regexp_extract(n.node_id, '(\\d+)', 1), '') as int), 1)))::bigint as depth from n left join d using (graph, node_id) group by n.graph, n.node_id""",
    "number_units": f"""with x as (select region_id, regexp_extract_all(coalesce(text, ''), '(?i)([+-]?(?:\\d{{1,3}}(?:[,，]\\d{{3}})+|\\d+)(?:\\.\\d+)?|[+-]?\\.\\d+)\\s*({_UNITS})?', 1) as v, regexp_extract_all(coalesce(text, ''), '(?i)([+-]?(?:\\d{{1,3}}(?:[,，]\\d{{3}})+|\\d+)(?:\\.\\d+)?|[+-]?\\.\\d+)\\s*({_UNITS})?', 2) as u from ocr_regions)
select region_id, (generate_subscripts(v, 1) - 1)::int as pos, regexp_replace(unnest(v), '[,，]', '', 'g')::double as value, lower(coalesce(unnest(u), '')) as unit from x""",
    "token_usage": "select model_name, count(*) as answers, sum(coalesce(try_cast(json_extract_string(parsed, '$.usage.prompt_tokens') as bigint), 0))::bigint as prompt_tokens, sum(coalesce(try_cast(json_extract_string(parsed, '$.usage.completion_tokens') as bigint), 0))::bigint as completion_tokens from model_outputs group by 1",
    "block_kinds": f"select {_KIND} as kind, count(*) as blocks from layout_blocks group by 1",
    "region_labels": "select case when lower(trim(role)) in ('seal', 'stamp', '印章', '公章') then 'seal' when lower(trim(role)) in ('watermark', '水印') then 'watermark' when lower(trim(role)) in ('footer', '页脚', '底部文字') then 'footer' when lower(trim(role)) in ('body', '正文') then 'body' when lower(trim(role)) in ('title', '标题') then 'title' else 'other' end as role, case when lower(trim(confidence)) in ('low', 'medium', 'high') then lower(trim(confidence)) when lower(trim(confidence)) in ('very_high', 'strong', 'sure') then 'high' when lower(trim(confidence)) in ('mid', 'moderate') then 'medium' when lower(trim(confidence)) = 'weak' then 'low' when try_cast(confidence as double) >= 0.85 then 'high' when try_cast(confidence as double) >= 0.5 then 'medium' when try_cast(confidence as double) is not null then 'low' else 'medium' end as confidence, count(*) as regions from ocr_regions group by 1, 2",
    "summaries": "select image_id, count(*) as answers, count_if(success) as successes, coalesce(string_agg(distinct model_name, ',' order by model_name), '') as models, coalesce(sum(latency_ms), 0)::bigint as latency_ms, arg_min(error, output_id) filter (error is not null) as first_error from model_outputs where image_id is not null group by 1",
    "best_snapshots": "select image_id, max(snapshot_id) as snapshot_id, origin from snapshots where image_id is not null and code is not null and origin in ('final_mermaid', 'legacy_dump', 'artifact_block', 'derived_label') group by image_id, origin qualify row_number() over (partition by image_id order by list_position(['final_mermaid', 'legacy_dump', 'artifact_block', 'derived_label'], origin)) = 1",
    "images_without_code": "select distinct image_id from validations where image_id is not null and image_id not in (select image_id from snapshots where code is not null and image_id is not null)",
    "patched_blocks": _PATCHED,
    "hourly_answers": "select strftime(date_trunc('hour', captured_at), '%Y-%m-%d %H:%M:%S') as window_start, model_name, count(*) as answers, count_if(success) as successes from model_outputs where captured_at is not null group by 1, 2",
    "latest_answers": "select image_id, model_name, output_id, success from model_outputs where image_id is not null qualify row_number() over (partition by image_id, model_name order by received_at desc, output_id desc) = 1",
    "gold_matches": f"with g as (select image_id, arg_max({_SQUEEZED.format('code')}, snapshot_id) as gold from snapshots where image_id is not null and origin = 'gold_file' and code is not null group by 1) select s.snapshot_id, g.gold is not null as has_gold, coalesce({_SQUEEZED.format('s.code')} = g.gold, false) as equal from snapshots s left join g using (image_id) where s.image_id is not null and s.origin = 'final_mermaid'",
    "neighbour_similarity": f"""with r as (select block_row_id, coalesce(content, '') as a, coalesce(lead(content) over (partition by image_id order by block_index, block_row_id), '') as b from layout_blocks where image_id is not null),
s as (select *, {_SQUEEZED.format('a')} as x, {_SQUEEZED.format('b')} as y, list_distinct(regexp_extract_all(lower(a), '[\\x{{4e00}}-\\x{{9fff}}A-Za-z0-9_]+')) as ka, list_distinct(regexp_extract_all(lower(b), '[\\x{{4e00}}-\\x{{9fff}}A-Za-z0-9_]+')) as kb from r),
t as (select *, {_BIGRAMS.format('x')} as p, {_BIGRAMS.format('y')} as q from s)
select block_row_id, round(case when x = '' and y = '' then 1.0 when x = '' or y = '' then 0.0 else {_JACCARD.format('p', 'q')} end, 6) as bigram, round(case when len(ka) = 0 or len(kb) = 0 then 0.0 else {_JACCARD.format('ka', 'kb')} end, 6) as keyword from t""",
    "block_boxes": "with b as (select block_row_id, list_transform(bbox, lambda v: greatest(0, least(1000, round_even(v * case when len(list_filter(bbox, lambda w: not (w >= 0 and w <= 1))) = 0 then 1000 else 1 end, 0)))::int) as b from layout_blocks where bbox is not null and len(bbox) = 4) select block_row_id, b[1] as x0, b[2] as y0, b[3] as x1, b[4] as y1 from b",
    "seal_conflicts": f"with r as (select image_id, role, model_name, t from (select image_id, role, model_name, {_SQUEEZED.format('text')} as t from ocr_regions where image_id is not null and text is not null) where t != '' and role is not null), s as (select image_id, role, model_name, string_agg(distinct t, '|' order by t) as texts from r group by all) select image_id, role, count(*) as models, count(distinct texts) as readings from s group by all having count(distinct texts) > 1",
}
