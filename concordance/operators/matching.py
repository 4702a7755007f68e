"""Joins of the blocks of two documents: by fuzzy score, by best overlap, by rules."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concordance.functions import geometry, labels, text
from concordance.session import materialise, small

#: Least score of a match.
LEAST = 0.35
#: Pairs of a page up to which all are compared for the best overlap.
MOST_PAIRS = 4_000_000
#: Overlaps searched for in turn; what is below the last rounds to 0. The first ones only on a page of so many targets.
SHARES = (0.85, 0.7, 0.45, 0.25, 0.1, 0.03, 0.005, 0.00005)
_DENSE = {0.85: 300_000, 0.7: 20_000, 0.45: 1_000}
_EDGES = ("x0", "y0", "x1", "y1")


def match_score(a: str, b: str) -> Column:
    """0.5 overlap + 0.3 text + 0.2 type of the columns box_, text_, kind_ of sides a and b."""
    c = F.col
    return F.round(0.50 * c("overlap") + 0.30 * c("similarity") + 0.20 * labels.type_compatibility(c("kind_" + a), c("kind_" + b)), 4)


def candidates(base: DataFrame, other: DataFrame, key: list[str], least: float = LEAST) -> DataFrame:
    """Scored pairs of blocks on the same page. Sides: key..., page_idx, pos, box, text, kind."""
    at = [*key, "page_idx"]
    # a text's form and character pairs are made once per block, not once per pair
    formed = (d.withColumn("text", text.squeezed(F.col("text"))).withColumn("pairs", text.bigrams(F.col("text"))) for d in (base, other))
    left, right = (d.select(*at, *(F.col(c).alias(f"{c}_{s}") for c in ("pos", "box", "text", "kind", "pairs"))) for d, s in zip(formed, "ab"))
    pairs = left.join(right, at)
    alike = F.when(F.col("text_a") == F.col("text_b"), F.lit(1.0)).otherwise(F.round(text.jaccard(F.col("pairs_a"), F.col("pairs_b")), 4))
    pairs = pairs.withColumn("overlap", geometry.iou(F.col("box_a"), F.col("box_b"))).withColumn("similarity", alike)
    return pairs.withColumn("score", match_score("a", "b")).filter(F.col("score") >= least).select(*at, "pos_a", "pos_b", "overlap", "similarity", "score")


def greedy(scored: DataFrame, key: list[str]) -> DataFrame:
    """One-to-one matches: pairs by (score, overlap, similarity) downwards, first come first served.

    Pairs of different pages never compete, so a page of a document is one group.
    """
    at = [*key, "page_idx"]
    fields = {f.name: f.dataType.simpleString() for f in scored.schema.fields}
    names = [*at, "pos_a", "pos_b", "overlap", "similarity", "score"]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["score", "overlap", "similarity", "pos_a", "pos_b"], ascending=[False, False, False, True, True], kind="stable")
        used_a: set = set()
        used_b: set = set()
        keep = []
        for a, b in zip(pdf["pos_a"], pdf["pos_b"]):
            ok = a not in used_a and b not in used_b
            keep.append(ok)
            if ok:
                used_a.add(a)
                used_b.add(b)
        return pdf[keep].sort_values("pos_a")[names]

    return scored.groupBy(*at).applyInPandas(run, ", ".join(f"`{n}` {fields[n]}" for n in names))


def align(base: DataFrame, other: DataFrame, key: list[str], least: float = LEAST) -> DataFrame:
    """The matches of two documents' blocks."""
    return greedy(candidates(base, other, key, least), key)


def leftovers(blocks: DataFrame, matches: DataFrame, key: list[str], side: str) -> DataFrame:
    """Blocks of a side without a match."""
    return blocks.join(matches.select(*key, "page_idx", F.col("pos_" + side).alias("pos")), [*key, "page_idx", "pos"], "left_anti")


def merged(base: DataFrame, other: DataFrame, matches: DataFrame, key: list[str], addable: tuple[str, ...]) -> DataFrame:
    """(key..., page_idx, pos, kind, box, text, origin): base blocks enriched by their match.

    A base block without a text or box takes its match's; blocks of the other side without a
    match, of the ``addable`` kinds, follow the last block of their page.
    """
    at = [*key, "page_idx"]
    found = matches.select(*at, F.col("pos_a").alias("pos"), "pos_b").join(other.select(*at, F.col("pos").alias("pos_b"), F.col("text").alias("_t"), F.col("box").alias("_b")), [*at, "pos_b"])
    empty = F.coalesce(F.trim("text"), F.lit("")) == ""
    filled = base.join(found, [*at, "pos"], "left").select(*at, "pos", "kind", F.coalesce("box", "_b").alias("box"), F.when(empty, F.coalesce("_t", "text")).otherwise(F.col("text")).alias("text"), F.when(empty & (F.coalesce("_t", F.lit("")) != ""), "filled").when(F.col("pos_b").isNotNull(), "matched").otherwise("base").alias("origin"))
    top = base.groupBy(*at).agg(F.max("pos").alias("_top"))
    new = leftovers(other, matches, key, "b").filter(F.col("kind").isin(*addable))
    number = F.row_number().over(Window.partitionBy(*at).orderBy("pos"))
    added = new.withColumn("_n", number).join(top, at, "left").select(*at, (F.coalesce("_top", F.lit(0)) + F.col("_n")).alias("pos"), "kind", "box", "text", F.lit("added").alias("origin"))
    return filled.unionByName(added)


def with_positional(base: DataFrame, other: DataFrame, matches: DataFrame, key: list[str]) -> DataFrame:
    """Matches, and where as many blocks are left on both sides those in order."""
    w = Window.partitionBy(*key).orderBy("page_idx", "pos")
    a, b = (leftovers(d, matches, key, s).select(*key, F.col("page_idx"), F.col("pos")).withColumn("n", F.row_number().over(w)) for d, s in ((base, "a"), (other, "b")))
    equal = a.groupBy(*key).agg(F.count("*").alias("c")).join(b.groupBy(*key).agg(F.count("*").alias("d")), key).filter("c = d").select(*key)
    zipped = a.join(equal, key, "left_semi").withColumnRenamed("pos", "pos_a").join(b.select(*key, "n", F.col("pos").alias("pos_b")), [*key, "n"])
    zero = F.lit(0.0)
    return matches.unionByName(zipped.select(*key, "page_idx", "pos_a", "pos_b", zero.alias("overlap"), zero.alias("similarity"), zero.alias("score")))


def best_overlap(blocks: DataFrame, key: list[str], targets: Column, most_pairs: int = MOST_PAIRS, shares: tuple[float, ...] = SHARES) -> DataFrame:
    """For each other block the target block of its page with most overlap; ties: the first.

    Pages of up to ``most_pairs`` pairs are compared pair by pair. On larger ones (a page may
    have a tenth of all blocks) blocks are first compared with the targets so like them in
    size and place that the overlap can reach the first of ``shares``; who finds none goes on
    to the next share, the last of which is the least overlap there is. ``blocks``: key..., pos, box.
    """
    flat = blocks.filter("box is not null").dropna(subset=key).select(*key, "pos", *(F.col("box")[k].alias(n) for k, n in enumerate(_EDGES)), targets.alias("target"))
    counts = flat.groupBy(*key).agg(F.count_if("target").alias("many"), F.count_if(~F.col("target")).alias("rest"))
    large = small(counts.filter(F.col("many").cast("double") * F.col("rest") > most_pairs).select(*key, "many"))
    flat = flat.join(large, key, "left").withColumn("w", F.col("x1") - F.col("x0")).withColumn("h", F.col("y1") - F.col("y0")).withColumn("area", F.col("w") * F.col("h"))
    # a box of no usable size (NaN, infinite) meets all of its page, and all meet it; an empty one overlaps nothing
    searched, odd = F.col("many").isNotNull(), ~(F.least("w", "h") <= 0) & ~((F.least("w", "h") > 1e-150) & (F.greatest("w", "h") < 1e150))
    rest = flat.filter("not target").select(*key, "pos", *_EDGES, F.when(searched & ~odd, 1).otherwise(0).alias("side"))
    t = flat.filter("target").select(*key, *_as_target(), F.explode(F.when(searched & odd, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("side"))
    best = _best(_overlapping(rest.join(t, [*key, "side"]), shares[-1]), key)
    if not (most := large.agg(F.max("many")).first()[0]):
        return _unpacked(best, key)
    boxes = flat.filter(searched & ~odd & (F.least("w", "h") > 0))
    parts = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left = materialise(boxes.filter("not target").select(*key, "pos", *_EDGES, "w", "h", "area").repartition(parts))
    # of equal targets the first will do
    t = materialise(boxes.filter("target").groupBy(*key, *_EDGES, "w", "h").agg(F.min("pos").alias("pos")))
    for share in shares:
        if most < _DENSE.get(share, 0):
            continue
        found = materialise(_best(_overlapping(alike(left, t, key, share), share), key))
        best = best.unionByName(found)
        if share == shares[-1]:
            break
        # whatever rounds to as much or more has been compared, if that's above the share
        left = materialise(left.join(found.filter(F.col("best.overlap") > share + 1e-4), [*key, "pos"], "left_anti").repartition(parts))
        if left.isEmpty():
            break
    return _unpacked(best.groupBy(*key, "pos").agg(F.max("best").alias("best")), key)


def _as_target() -> list[Column]:
    return [F.col(n).alias("target_" + n) for n in ("pos", *_EDGES)]


def _overlapping(pairs: DataFrame, share: float) -> DataFrame:
    """Pairs with ``overlap``, if it may reach ``share``.

    Rounding is dear, so most are passed over before. No filter on ``overlap`` here: it would
    become part of the join's condition and be evaluated first, for every pair.
    """
    a, b = ([F.col(p + n) for n in _EDGES] for p in ("", "target_"))
    cut = geometry.common(a, b)
    union = geometry.area(a) + geometry.area(b) - cut
    near = pairs.filter((cut > 0) & ((cut >= union * (share * (1 - 1e-6))) | F.isnan(union)))
    return near.withColumn("overlap", geometry.iou(F.array(*a), F.array(*b)))


def _best(pairs: DataFrame, key: list[str]) -> DataFrame:
    return pairs.groupBy(*key, "pos").agg(F.max(F.struct("overlap", (-F.col("target_pos")).alias("order"))).alias("best")).filter("best.overlap > 0")


def _unpacked(best: DataFrame, key: list[str]) -> DataFrame:
    return best.select(*key, "pos", (-F.col("best.order")).alias("target_pos"), "best.overlap")


def alike(blocks: DataFrame, targets: DataFrame, key: list[str], share: float) -> DataFrame:
    """Pairs of a block and a target of its page, among them all with an overlap of ``share`` or more.

    Boxes have levels of width and of height. Overlap is at most the common length over the
    joint length, in either direction, and at most the ratio of the areas: that bounds the
    levels of the targets, and where their first corner lies. Corners are in grid cells as
    large as the larger of both, so a block looks into a few cells for each pair of levels.
    Both sides: key..., pos, x0, y0, x1, y1, w, h of more than 0; ``blocks`` also area.
    """
    least, base = share * (1 - 1e-9), min(8.0, max(share**-0.5, min(1 / share, 2.0)))
    level = lambda v: F.floor(F.log(v) / math.log(base)).cast("int")
    power = lambda k: F.pow(F.lit(base), k)
    c = F.col
    t = targets.withColumn("t_w", level(c("w"))).withColumn("t_h", level(c("h")))
    lows = {f"{n}_{d}": power(c(f"t_{d}") + k) * (1 - e) for d in "wh" for n, k, e in (("lo", 0, 1e-9), ("hi", 1, -1e-9))}
    levels = small(t.select(*key, "t_w", "t_h").distinct().select("*", *(v.alias(n) for n, v in lows.items())))
    apart = {d: F.greatest(F.lit(1.0), c("lo_" + d) / c(d), c(d) / c("hi_" + d)) for d in "wh"}
    fits = (apart["w"] + apart["h"] - 1 <= 1 / least) & (c("lo_w") * c("lo_h") <= c("area") / least) & (c("hi_w") * c("hi_h") >= c("area") * least)
    near = blocks.withColumn("b_w", level(c("w"))).withColumn("b_h", level(c("h"))).join(levels, key).filter(fits)
    near = near.withColumn("g_w", F.greatest("b_w", "t_w")).withColumn("g_h", F.greatest("b_h", "t_h"))
    cell = lambda v, d: F.floor(v / (power(c("g_" + d) + 1) * (1 - share)))
    for d, lo, hi in (("w", "x0", "x1"), ("h", "y0", "y1")):
        slack = (F.abs(lo) + F.abs(hi)) * 1e-15
        first, last = c(lo) + (c(d) * least - c("hi_" + d)) / (1 + least) - slack, c(hi) - (c(d) + c("lo_" + d)) * least / (1 + least) + slack
        near = near.withColumn("cell_" + d, F.explode(F.sequence(cell(first, d), cell(last, d))))
    meet = F.xxhash64("t_w", "t_h", "g_w", "g_h", "cell_w", "cell_h").alias("meet")
    near = near.select(*key, "pos", *_EDGES, meet)
    # a target is found by blocks of its own level and smaller, and by larger ones as far as the share lets them be
    far = math.floor(math.log(1 / least) / math.log(base) + 1e-6)
    ups = F.array(*(F.struct(F.lit(i).alias("w"), F.lit(j).alias("h")) for i in range(far + 2) for j in range(far + 2) if i + j <= far + 2))
    t = t.withColumn("up", F.explode(ups)).withColumn("g_w", c("t_w") + c("up.w")).withColumn("g_h", c("t_h") + c("up.h"))
    t = t.withColumn("cell_w", cell(c("x0"), "w")).withColumn("cell_h", cell(c("y0"), "h"))
    return near.join(t.select(*key, *_as_target(), meet), [*key, "meet"])


def consume(anchors: list[dict], specials: list[dict]) -> list[int | None]:
    """For each anchor the special block it takes: by id, else by kind and order, kind and
    box, kind and picture; a taken one is gone."""
    left = list(range(len(specials)))
    rules = (("id",), ("kind", "order"), ("kind", "box"), ("kind", "path"))
    out: list[int | None] = []
    for a in anchors:
        hit = None
        for rule in rules:
            hit = next((k for k in left if all(a.get(f) not in (None, "") and specials[k].get(f) == a.get(f) for f in rule)), None)
            if hit is not None:
                left.remove(hit)
                break
        out.append(hit)
    return out
