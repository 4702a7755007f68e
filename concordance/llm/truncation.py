"""Text values that lost their end, and how often each source loses it.

Per source a right-censored log-normal length distribution is fitted by maximum likelihood
(EM on the sufficient statistics of a length histogram, for characters and for UTF-8 bytes).
Lengths that hold far more values than their surroundings are candidate limits, where a
value is censored with probability 1 - expected / seen. Each value's ending has a grade: an
open fence, bracket, quotation or number, half a table row, a line without an end mark, an
arrow without a target, a full stop, a closed row and so on; a line without an end mark is
common or rare by how often its shape ends values of the table.

What endings cuts leave and whole values have is learned per table by EM over the places (a
source's limits, and all its other lengths): a value is cut with the place's probability
and then shows a grade as cuts there do, or is whole and shows one as whole values do. How
often cuts leave a sound ending is known from whole values cut on trial at a place in their
second half; at a limit the fitted censoring stands for ``WEIGHT`` values. So the length fit
decides wherever endings don't, and endings correct it where whole values are just as long
as cut ones. The posterior of a value is that of its place and grade.

Defined results: null and empty values are no cases; a repeated row has its own result; a
null source is a source named ''; marks of cutting ('…', '[cut') are taken off before the
ending is judged; texts and last lines are judged whole, however long.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordance.session import materialise, small

#: Grades that whole values hardly have: such an ending is laid to cuts unless the places say
#: otherwise (each step of the fit takes a part YIELD of its share in whole values away).
BROKEN = frozenset("damaged json_open fence_open row_half quote_open number_open marked_line space_tail line_rare subgraph_open nodes_open class_open half_line".split())
YIELD = 0.1
#: Their share in whole values before any is seen, the share of sound endings that cuts leave
#: before any trial, and the trials and values that these and the length fit stand for.
BROKEN_IF_WHOLE, SOUND_IF_CUT, TRIALS, WEIGHT = 0.002, 0.03, 100, 50
#: A length is a candidate limit from so many values, and so many times its surroundings.
LEAST_AT_LIMIT, SPIKE = 8, 4.0
#: Share of a table from which the shape of a last line is common, and the least count.
COMMON, LEAST_COMMON = 0.0025, 4

_MARK = re.compile(r"(?:\s*(?:…|\.\.\.|\[(?:cut|truncated|snip)[^\]\n]*\]?)|\ufffd)+\s*\Z", re.I)
_STOP = ".!?。！？"
_CLOSE = "\"'”’»)]}」』）】"
_NUMBER_CUT = re.compile(r"(?:^|[^\d.,])0\.\Z")


def shape(line: str) -> str:
    """A line with names and numbers put out of it; plain words and sentences stay as they are."""
    form = re.sub(r"[^\W_]+(?:-[^\W_]+)*", lambda m: "9" if m.group().isdigit() else "w", line.strip())
    return _key(line.strip() if re.search(r"\A[w9 ]*\Z|[.!?。！？] ", form) else form)


def _key(line: str) -> str:
    """The line itself, or the hash of a long one."""
    return line if len(line) <= 60 else blake2b(line.encode("utf-8", "replace"), digest_size=16).hexdigest()


def _row_cells(line: str) -> int:
    return len(re.findall(r"(?<!\\)\|", line))


def text_ending(text: str) -> tuple[str, str | None]:
    """(grade of the ending, shape of the last line where the grade is 'line')."""
    bare = _MARK.sub("", text)
    marked = len(bare) < len(text)
    end = bare.rstrip()
    if not end or marked and text.rstrip().endswith("\ufffd"):
        return "damaged", None
    head = end.lstrip()[:1]
    if head in "{[":
        try:
            json.loads(end)
            return "json", None
        except (ValueError, RecursionError):
            if head == "{" or end[-1] in "\"':,{":
                return "json_open", None
    if end.count("```") % 2:
        return "fence_open", None
    lines = end.rsplit("\n", 3)
    last = lines[-1].strip()
    if last.startswith("|"):
        above = [x.strip() for x in lines[-3:-1]]
        first = not above or not above[-1].startswith("|")
        separator = re.fullmatch(r"\|[\s|:-]+\|", last)
        width = _row_cells(above[-1]) if not first else _row_cells(last)
        return ("row_half" if first or separator or not last.endswith("|") or _row_cells(last) != width else "row"), None
    if end.endswith("```") or re.fullmatch(r"[-=_*]{3,}|\[[^\[\]]*\]", last):
        return "block", None
    tail = end.rstrip(_CLOSE)
    closed = len(tail) < len(end)
    if closed and (last.count('"') % 2 or last.count("(") + last.count("（") > last.count(")") + last.count("）")):
        return "quote_open", None
    if end[-1] in _STOP or closed:
        return ("number_open" if _NUMBER_CUT.search(last) else "closed" if closed else "stop"), None
    if marked:
        return "marked_line", None
    if bare != end and bare.rstrip("\n") != end:
        return "space_tail", None
    return "line", shape(last)


_NODE = re.compile(r"^[ \t]*([A-Za-z]\w*)[ \t]*(?:\(\[\"[^\"\n]*\"\]\)|\[\[?\"[^\"\n]*\"\]?\]|\(\(?\"[^\"\n]*\"\)?\)|\{\{?\"[^\"\n]*\"\}?\})[ \t]*$", re.M)
_EDGE = re.compile(r"^[ \t]*([A-Za-z]\w*)[ \t]*[-=.]+>[ \t]*(?:\|[^|\n]*\|)?[ \t]*([A-Za-z]\w*)[ \t]*$", re.M)
_CLASS = re.compile(r"class\s+([\w,]+)\s+(\w+)")


def code_ending(code: str) -> tuple[str, str | None]:
    """The same for diagram code."""
    bare = _MARK.sub("", code)
    end = bare.rstrip("\n")
    last = end.rsplit("\n", 1)[-1]
    text = last.strip()
    if not text or len(bare) < len(code) and code.endswith("\ufffd"):
        return "damaged", None
    if last != last.rstrip():
        return "space_tail", None
    nodes = set(_NODE.findall(end))
    edges = _EDGE.findall(end)
    used = {x for e in edges for x in e}
    if len(re.findall(r"^[ \t]*subgraph\b", end, re.M)) > len(re.findall(r"^[ \t]*end[ \t]*$", end, re.M)):
        return "subgraph_open", None
    if nodes and (used - nodes or (nodes - used and len(nodes) > 1)):
        return "nodes_open", None
    if _EDGE.fullmatch(last):
        return "edge", None
    if m := _CLASS.fullmatch(text):
        named = set(re.findall(r"^[ \t]*classDef[ \t]+(\w+)", end, re.M))
        return ("class" if not named or m[2] in named else "class_open"), None
    if text == "end" or _NODE.fullmatch(last):
        return "node", None
    # comments and styles end freely: what is common as a last line is whole
    return ("line", _key(text)) if text.startswith(("%%", "classDef", "style", "linkStyle", "click")) else ("half_line", None)


ENDINGS = {"text": text_ending, "code": code_ending}
FEATURES = "source_table string, record_id bigint, source string, chars bigint, bytes bigint, ending string, shape string, trial string, trial_shape string"


def _cut(text: str) -> str:
    """The text cut at a place in its second half that its content chooses."""
    half = len(text) // 2
    return text[: half + zlib.crc32(text.encode("utf-8", "replace")) % (len(text) - half)]


def features(df: DataFrame, source_table: str, record: str, value: str, source: str, kind: str) -> DataFrame:
    """Lengths and the evidence of the ending of every value that isn't null or empty.

    ``trial`` is the ending of a value that looks whole after a cut in its second half.
    """
    judge = ENDINGS[kind]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(4).to_pylist()
            judged = [judge(t) for t in values]
            judged = [j + (judge(_cut(t)) if j[0] not in BROKEN and len(t) > 1 else (None, None)) for t, j in zip(values, judged)]
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([pa.array([source_table] * n), *(batch.column(k) for k in range(4)), *(pa.array([j[k] for j in judged], pa.string()) for k in range(4))], [x.split()[0] for x in FEATURES.split(", ")])

    text = F.col(value)
    narrow = df.filter(text.isNotNull() & (text != "")).select(
        F.col(record).cast("bigint").alias("record_id"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"),
        F.length(text).cast("bigint").alias("chars"), F.octet_length(text).cast("bigint").alias("bytes"), text.alias("value"),
    )
    return narrow.mapInArrow(run, FEATURES)


def fit_censored(lengths: np.ndarray, counts: np.ndarray, unit: str) -> list[dict]:
    """Candidate limits of one histogram with the censoring probability there.

    The log-normal is fitted by EM: censored values enter with their truncated moments.
    """
    total = counts.sum()
    if not total:
        return []
    logs = np.log(lengths)
    limits = []
    reach = 4 if unit == "bytes" else 1
    for k, length in enumerate(lengths):
        at = (lengths > length - reach) & (lengths <= length) if reach > 1 else lengths == length
        near = (np.abs(lengths - length) <= max(12, length // 12)) & ~((lengths > length - reach) & (lengths < length + reach))
        width = 2 * max(12, length // 12) + 1
        here, around = counts[at].sum(), reach * (counts[near].sum() + 1) / width
        if counts[k] >= LEAST_AT_LIMIT / 2 and here >= LEAST_AT_LIMIT and here >= SPIKE * max(1.0, around) and here > around + 5 * math.sqrt(around):
            limits.append((int(length), int(here), float(around)))
    # of overlapping byte candidates the fullest stands for the limit
    limits.sort(key=lambda x: -x[1])
    kept: list[tuple[int, int, float]] = []
    for x in limits:
        if all(abs(x[0] - y[0]) >= reach for y in kept):
            kept.append(x)
    censored = {x[0]: max(0.0, x[1] - x[2]) for x in kept}
    weight = counts.astype(float).copy()
    for length, cut in censored.items():
        own = (lengths > length - reach) & (lengths <= length)
        weight[own] *= 1 - cut / max(1, counts[own].sum())
    mu = (weight * logs).sum() / max(weight.sum(), 1e-9)
    sigma = max(0.05, math.sqrt((weight * (logs - mu) ** 2).sum() / max(weight.sum(), 1e-9)))
    for _ in range(60):
        s0, s1, s2 = weight.sum(), (weight * logs).sum(), (weight * logs**2).sum()
        for length, cut in censored.items():
            z = (math.log(length) - mu) / sigma
            hazard = math.exp(-z * z / 2) / math.sqrt(2 * math.pi) / max(1e-12, 0.5 * math.erfc(z / math.sqrt(2)))
            first = mu + sigma * hazard
            second = mu * mu + sigma * sigma + sigma * (math.log(length) + mu) * hazard
            s0, s1, s2 = s0 + cut, s1 + cut * first, s2 + cut * second
        new = s1 / s0, max(0.05, math.sqrt(max(0.0, s2 / s0 - (s1 / s0) ** 2)))
        done = abs(new[0] - mu) + abs(new[1] - sigma) < 1e-9
        mu, sigma = new
        if done:
            break
    out = []
    for length, here, around in kept:
        z = (math.log(length) - mu) / sigma
        density = total * reach * math.exp(-z * z / 2) / (length * sigma * math.sqrt(2 * math.pi))
        expected = max(around, min(density, here / 2))
        out.append(dict(unit=unit, limit=length, reach=reach, mu=mu, sigma=sigma, seen=here, expected=expected, censoring=max(0.0, 1 - expected / here)))
    return out


LIMITS = "source_table string, source string, unit string, limit bigint, reach bigint, mu double, sigma double, seen bigint, expected double, censoring double"


def limits(found: DataFrame) -> DataFrame:
    """Candidate limits of every source, fitted on its length histograms.

    The histogram is aggregated first, so a task gets the distinct lengths of a source and
    never its rows.
    """
    long = found.select("source_table", "source", F.expr("stack(2, 'chars', chars, 'bytes', bytes) as (unit, length)"))
    histogram = long.groupBy("source_table", "source", "unit", "length").agg(F.count("*").alias("n"))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("length")
        rows = fit_censored(pdf["length"].to_numpy(), pdf["n"].to_numpy(), pdf["unit"].iloc[0])
        names = [x.split()[0] for x in LIMITS.split(", ")]
        return pd.DataFrame([dict(source_table=pdf["source_table"].iloc[0], source=pdf["source"].iloc[0], **r) for r in rows], columns=names)

    return histogram.groupBy("source_table", "source", "unit").applyInPandas(fit, LIMITS)


def learned(counts: np.ndarray, prior: np.ndarray, weight: np.ndarray, kind: np.ndarray, broken: np.ndarray, sound: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(share of cuts per place, grades of cuts for each kind of place, grades of whole values) by EM.

    ``counts``: places x grades; ``prior`` and ``weight``: the share of cuts at each place as
    the length fit sees it and the values it stands for; ``kind``: 1 for limits; ``broken``:
    which grades whole values hardly have; ``sound``: how often a cut leaves each other grade.
    """
    every = counts.sum(axis=0)
    whole = np.where(broken, BROKEN_IF_WHOLE * every / max(every[broken].sum(), 1), (1 - BROKEN_IF_WHOLE) * every / max(every[~broken].sum(), 1))
    least = whole.copy()
    left = max(1e-9, 1 - sound.sum())
    mix = lambda seen: sound + left * np.where(broken, seen + 1e-6, 0) / max((seen[broken] + 1e-6).sum(), 1e-9)
    cut = np.stack([mix(counts[kind == z].sum(axis=0)) for z in (0, 1)])
    share = prior.copy()
    for _ in range(500):
        lost = counts * _odds(share[:, None], cut[kind], whole)
        new = (lost.sum(axis=1) + weight * prior) / np.maximum(counts.sum(axis=1) + weight, 1e-9)
        moved = np.abs(new - share).max(initial=0)
        share = new
        cut = np.stack([mix(lost[kind == z].sum(axis=0)) for z in (0, 1)])
        rest = (counts - lost).sum(axis=0) * np.where(broken, 1 - YIELD, 1) + least
        whole = rest / max(rest.sum(), 1e-9)
        if moved < 1e-7:
            break
    return share, cut, whole


def _odds(share: np.ndarray, cut: np.ndarray, whole: np.ndarray) -> np.ndarray:
    a, b = share * cut, (1 - share) * whole
    return a / np.maximum(a + b, 1e-300)


GRADES = "source_table string, grade string, cut double, cut_at_limit double, whole double"


def grades(places: DataFrame, trials: DataFrame) -> DataFrame:
    """(source_table, grade, cut, cut_at_limit, whole): how often cuts and whole values end so.

    Places of like prior are taken together (steps of half a logit, limits apart from the
    rest), so a table's task gets a few hundred rows, whatever the number of its sources.
    """
    logit = F.log(F.greatest(F.col("prior"), F.lit(1e-9)) / F.greatest(1 - F.col("prior"), F.lit(1e-9)))
    pooled = places.groupBy("source_table", (F.col("limit") > 0).cast("int").alias("kind"), F.round(logit * 2).cast("int").alias("step"), "grade").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("prior")).alias("expected"))
    rows = pooled.unionByName(trials.select("source_table", F.lit(2).alias("kind"), F.lit(0).alias("step"), "grade", F.col("trials").alias("n"), F.lit(0.0).alias("expected")))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        names, grade = np.unique(pdf["grade"].to_numpy(str), return_inverse=True)
        broken = np.array([g in BROKEN for g in names])
        trial = (pdf["kind"] == 2).to_numpy()
        tried = np.bincount(grade[trial], weights=pdf["n"][trial], minlength=len(names))
        seen, number = pdf[~trial], grade[~trial]
        where = seen.groupby(["kind", "step"], sort=True).ngroup().to_numpy()
        size = where.max(initial=-1) + 1
        counts = np.zeros((size, len(names)))
        counts[where, number] = seen["n"]
        prior = np.bincount(where, weights=seen["expected"], minlength=size) / np.maximum(counts.sum(axis=1), 1)
        kind = np.zeros(size, int)
        kind[where] = seen["kind"]
        # grades that no trial leaves share what is left for the start
        sound = np.where(broken, 0, tried + TRIALS * SOUND_IF_CUT / max((~broken).sum(), 1)) / (tried.sum() + TRIALS)
        _, cut, whole = learned(counts, prior, np.where(kind == 1, WEIGHT, 1), kind, broken, sound)
        return pd.DataFrame({"source_table": pdf["source_table"].iloc[0], "grade": names, "cut": cut[0], "cut_at_limit": cut[1], "whole": whole})

    return rows.groupBy("source_table").applyInPandas(fit, GRADES)


PLACED = "source_table string, source string, unit string, limit bigint, grade string, share double, posterior double"


def _judged(places: DataFrame) -> DataFrame:
    """(source_table, source, unit, limit, grade, share, posterior) of every place and grade met."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        where = pdf.groupby(["unit", "limit"], sort=True).ngroup().to_numpy()
        n, given = pdf["n"].to_numpy(float), pdf["prior"].to_numpy(float)
        at = pdf["limit"].to_numpy() > 0
        cut, whole = np.where(at, pdf["cut_at_limit"], pdf["cut"]), pdf["whole"].to_numpy(float)
        size = where.max() + 1
        prior, total = np.zeros(size), np.bincount(where, weights=n, minlength=size)
        prior[where] = given
        weight = np.where(np.bincount(where, weights=at, minlength=size) > 0, WEIGHT, 1)
        share = prior
        for _ in range(500):
            new = (np.bincount(where, weights=n * _odds(share[where], cut, whole), minlength=size) + weight * prior) / (total + weight)
            moved, share = np.abs(new - share).max(), new
            if moved < 1e-7:
                break
        return pdf[["source_table", "source", "unit", "limit", "grade"]].assign(share=share[where], posterior=_odds(share[where], cut, whole))

    return places.groupBy("source_table", "source").applyInPandas(run, PLACED)


def posteriors(found: DataFrame) -> DataFrame:
    """Every value with the posterior probability that its end was lost."""
    found = materialise(found)
    shapes = found.filter("ending = 'line'").groupBy("source_table", "shape").agg(F.count("*").alias("n"))
    total = found.groupBy("source_table").agg(F.count("*").alias("total"))
    # at most 1 / COMMON shapes of a table can be common
    common = shapes.join(total, "source_table").filter((F.col("n") >= LEAST_COMMON) & (F.col("n") >= COMMON * F.col("total"))).select("source_table", "shape", F.lit(True).alias("common"))
    graded = lambda ending, known: F.when(ending != "line", ending).when(known.isNotNull(), "line_common").otherwise("line_rare")
    judged = found.join(F.broadcast(common), ["source_table", "shape"], "left").withColumn("grade", graded(F.col("ending"), F.col("common")))
    after = common.select("source_table", F.col("shape").alias("trial_shape"), F.col("common").alias("trial_common"))
    tried = judged.filter(~F.col("grade").isin(*BROKEN) & F.col("trial").isNotNull()).join(F.broadcast(after), ["source_table", "trial_shape"], "left")
    trials = tried.groupBy("source_table", graded(F.col("trial"), F.col("trial_common")).alias("grade")).agg(F.count("*").alias("trials"))
    fitted = limits(found).groupBy("source_table", "source").agg(F.collect_list(F.struct("censoring", "unit", "limit", "reach")).alias("limits"))
    near = F.transform("limits", lambda x: F.when(F.when(x["unit"] == "chars", F.col("chars")).otherwise(F.col("bytes")).between(x["limit"] - x["reach"] + 1, x["limit"] + F.when(x["unit"] == "bytes", 2).otherwise(0)), x))
    at = judged.join(small(fitted), ["source_table", "source"], "left").withColumn("at", F.array_max(near))
    # off the limits unit and limit are '' and 0
    placed = at.withColumn("unit", F.coalesce("at.unit", F.lit(""))).withColumn("limit", F.coalesce("at.limit", F.lit(0)).cast("bigint")).withColumn("censoring", F.col("at.censoring")).drop("limits", "at")
    keys = ["source_table", "source", "unit", "limit"]
    broken = F.col("grade").isin(*BROKEN)
    counts = materialise(placed.groupBy(*keys, "grade").agg(F.count("*").alias("n"), F.max("censoring").alias("censoring")))
    # off the limits the share of broken endings is where the share of cuts starts
    share = counts.groupBy(*keys).agg(((F.sum(F.when(broken, F.col("n")).otherwise(0)) + 0.5) / (F.sum("n") + 1)).alias("told"))
    places = materialise(counts.join(share, keys).select(*keys, "grade", "n", F.coalesce("censoring", "told").alias("prior")))
    known = grades(places, trials)
    told = _judged(places.join(F.broadcast(known), ["source_table", "grade"]))
    joined = placed.join(small(told), [*keys, "grade"])
    return joined.select("source_table", "record_id", "source", "chars", "bytes", (F.col("limit") > 0).alias("at_limit"), "grade", F.col("share").alias("prior"), "posterior")


def rates(judged: DataFrame) -> DataFrame:
    """Cut values and their share, per source."""
    cut = (F.col("posterior") > 0.5).cast("int")
    return judged.groupBy("source_table", "source").agg(F.count("*").alias("records"), F.sum(cut).alias("cut"), F.avg(cut).alias("share"), F.sum(cut * F.col("at_limit").cast("int")).alias("cut_at_limit"))
