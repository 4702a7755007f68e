"""One label per item from voters who disagree, with voters' abilities and items' difficulties.

Latent ability and difficulty: a vote shows the truth with probability
``s = sigmoid(ability of the voter * easiness of the item)`` and is else drawn from the
voter's habits given the true label, so that a voter who always says one thing or mixes up
two labels is understood. Expectation-maximisation with gradient steps learns all of it:
each pass computes label posteriors and the easiness of every item beside its votes, and
sums the gradients of the abilities and the expected habits; Newton steps on these sums
move the abilities. Voters that repeat each other's errors are found from the posteriors
(share of common errors) and equal votes of such a group count once.

What a pass needs of an item is who said which of its labels and how frequent these are, so
passes run over the distinct ballots with their numbers of items. A pass sends one row per
voter and per slip met; an item never moves again. Votes lie in flat arrays (votes, and pairs
of a vote and a candidate label of its item), so an item costs what its own votes cost.

Defined results: null votes are abstentions and so are values the caller declares so; equal
votes of one voter on one item count once, however often rows repeat; different votes of
one voter all count; an item without votes has no row; ties go to the label that more
voters chose, then to the smaller label.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from concordance.session import materialise

PASSES, INNER = 14, 4
#: Mean movement of the abilities, over all votes, at which the passes stop.
SETTLED = 0.02
#: Pairs of votes and labels, or of votes, that are handled at once.
AT_ONCE = 2_000_000
#: Frequent labels (share of an aspect's votes from FREQUENT, so at most 1 / FREQUENT of
#: them) have habits of their own. Any other label is a priori RARE, and as a slip of the
#: true label, say a letter misread, RARE_SLIP.
FREQUENT, RARE, RARE_SLIP = 0.004, 0.0002, 0.02
#: Votes that the general habits weigh against a voter's own, and the most slips (voter, true
#: label, label) that may be met; they are gathered and sent to the workers.
SMOOTHING, MAX_SLIPS = 10.0, 20_000_000
#: Voters and aspects together; their abilities are gathered and sent to the workers.
MAX_VOTERS = 20_000
#: Two voters are dependent if so many of the items either gets wrong are wrong alike.
COMMON_ERRORS, LEAST_ERRORS = 0.6, 15.0
#: Or, from so many common items, if their agreement exceeds what others explain by this.
LEAST_COMMON, EXCESS = 30, 0.3
#: Pairs of voters whose agreement is gathered at once; more are compared where they are.
MAX_PAIRS = 1_000_000

ENCODED = "image_id string, item string, aspect string, voters array<int>, codes array<int>, labels array<string>, numbers array<int>, priors array<double>"


@dataclass
class Model:
    """What the passes need to know about voters; small and bounded by MAX_VOTERS."""

    names: list[tuple[str, str]]  # (aspect, voter)
    ability: np.ndarray
    group: np.ndarray
    general: np.ndarray  # voters x labels: habits whatever the truth
    # habits given the true label are the general ones but for the slips met: sorted places
    # (voter, true label, label) in one index, expected votes there, their sums per voter and
    # true label; the last label is any rare one
    places: np.ndarray
    slips: np.ndarray
    missed: np.ndarray

    def habit(self, voters: np.ndarray, truth: np.ndarray, said: np.ndarray) -> np.ndarray:
        """Probability of a label said by a voter who doesn't show the truth."""
        width = self.general.shape[1]
        row = voters * width + truth
        general = self.general[voters, said]
        if not len(self.places):
            return general
        place = row * width + said
        at = np.minimum(np.searchsorted(self.places, place), len(self.places) - 1)
        met = np.where(self.places[at] == place, self.slips[at], 0.0)
        return np.where(said == width - 1, RARE_SLIP, (met + SMOOTHING * general) / (self.missed[row] + SMOOTHING))


def _model(names: list, ability: np.ndarray, group: np.ndarray, general: np.ndarray, places: np.ndarray, slips: np.ndarray) -> Model:
    width = general.shape[1]
    return Model(names, ability, group, general, places, slips, np.bincount(places // width, weights=slips, minlength=len(ability) * width))


def ballots(votes: DataFrame) -> DataFrame:
    """One row per item from rows (image_id, item, aspect, voter, label)."""
    kept = votes.filter("voter is not null and label is not null")
    return kept.groupBy("image_id", "item", "aspect").agg(F.collect_set(F.struct("label", "voter")).alias("votes"))


def encode(votes: DataFrame) -> tuple[DataFrame, Model]:
    """The ballots with voters and labels as numbers, written once, and a first model."""
    cast = materialise(ballots(votes))
    single = cast.select("aspect", F.explode("votes").alias("v")).select("aspect", "v.voter", "v.label")
    counts = single.groupBy("aspect", "voter").agg(F.count("*").alias("n"))
    rows = counts.limit(MAX_VOTERS + 1).collect()
    if len(rows) > MAX_VOTERS:
        raise ValueError(f"more than {MAX_VOTERS} voters")
    rows.sort(key=lambda r: (r.aspect, r.voter))
    index = {(r.aspect, r.voter): k for k, r in enumerate(rows)}
    totals: dict[str, int] = {}
    for r in rows:
        totals[r.aspect] = totals.get(r.aspect, 0) + r.n
    frequent = single.groupBy("aspect", "label").agg(F.count("*").alias("n")).withColumn("total", F.sum("n").over(Window.partitionBy("aspect"))).filter(F.col("n") >= FREQUENT * F.col("total")).select("aspect", "label", (F.col("n") / F.col("total")).alias("share"))
    share = {(r.aspect, r.label): r.share for r in frequent.collect()}
    own = single.join(F.broadcast(frequent.select("aspect", "label")), ["aspect", "label"]).groupBy("aspect", "voter", "label").agg(F.count("*").alias("n"))
    label_number: dict[tuple[str, str], int] = {}
    for aspect, label in sorted(share):
        label_number[aspect, label] = sum(a == aspect for a, _ in label_number)
    width = max(label_number.values(), default=-1) + 2
    n = len(rows)
    general = np.zeros((n, width))
    total = np.array([r.n for r in rows], float)
    for (aspect, label), k in label_number.items():
        general[[v for v, r in enumerate(rows) if r.aspect == aspect], k] = 20 * share[aspect, label]
    # at most MAX_VOTERS rows of 1 / FREQUENT labels
    given = own.toPandas()
    for aspect, voter, label, count in zip(given["aspect"], given["voter"], given["label"], given["n"]):
        general[index[aspect, voter], label_number[aspect, label]] += count
    general /= total[:, None] + 20
    general[:, -1] = RARE_SLIP
    tables = votes.sparkSession.sparkContext.broadcast((index, share, label_number, width - 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, share, label_number, rare = tables.value
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            given_by = batch.column(3)
            sizes = np.diff(given_by.offsets.to_numpy())
            ends, flat = np.cumsum(sizes), given_by.flatten()
            names, said = flat.field("voter").to_pylist(), flat.field("label").to_pylist()
            for aspect, end, size in zip(batch.column(2).to_pylist(), ends.tolist(), sizes.tolist()):
                # by voter, labels numbered as they come: like ballots are equal, whatever their texts
                given = sorted((index[aspect, names[v]], said[v]) for v in range(end - size, end))
                code: dict[str, int] = {}
                out[1].append([code.setdefault(x, len(code)) for _, x in given])
                out[0].append([v for v, _ in given])
                labels = list(code)
                out[2].append(labels)
                out[3].append([label_number.get((aspect, x), rare) for x in labels])
                out[4].append([share.get((aspect, x), RARE) for x in labels])
            types = (pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(3)), *(pa.array(c, t) for c, t in zip(out, types))], [x.split()[0] for x in ENCODED.split(", ")])

    encoded = materialise(cast.select("image_id", "item", "aspect", "votes").mapInArrow(run, ENCODED))
    return encoded, _model(list(index), np.ones(n), np.arange(n), general, np.zeros(0, np.int64), np.zeros(0))


def patterns(encoded: DataFrame) -> DataFrame:
    """The distinct ballots (voters, codes, numbers, priors) with their number of items ``n``,
    written once. The label texts don't matter to the passes."""
    return materialise(encoded.groupBy("voters", "codes", "numbers", "priors").agg(F.count("*").alias("n")))


@dataclass
class Ballots:
    """Items of a batch with their votes and candidate labels in flat arrays."""

    items: np.ndarray  # how many items each row stands for
    item: np.ndarray  # of each vote
    voters: np.ndarray
    codes: np.ndarray
    at: np.ndarray  # each vote's own label among all candidates
    owner: np.ndarray  # the item of each candidate
    first: np.ndarray  # each item's first candidate
    numbers: np.ndarray
    prior: np.ndarray


def _flat(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """Sizes and values of a column of lists."""
    return np.diff(column.offsets.to_numpy()), column.flatten().to_numpy(zero_copy_only=False).astype(kind)


def read(batch: pa.RecordBatch) -> Ballots:
    """A batch with columns voters, codes, numbers, priors and perhaps n."""
    columns = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
    votes, voters = _flat(columns["voters"], np.int64)
    _, codes = _flat(columns["codes"], np.int64)
    labels, numbers = _flat(columns["numbers"], np.int64)
    _, prior = _flat(columns["priors"], float)
    n = columns["n"].to_numpy(zero_copy_only=False).astype(float) if "n" in columns else np.ones(batch.num_rows)
    item, first = np.repeat(np.arange(batch.num_rows), votes), np.cumsum(labels) - labels
    return Ballots(n, item, voters, codes, first[item] + codes, np.repeat(np.arange(batch.num_rows), labels), first, numbers, prior)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of about AT_ONCE pairs of a vote and a label, or of votes."""
    names = batch.schema.names
    votes = np.diff(batch.column(names.index("voters")).offsets.to_numpy())
    labels = np.diff(batch.column(names.index("numbers")).offsets.to_numpy())
    piece = np.cumsum(votes * np.maximum(labels, votes)) // AT_ONCE
    cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
    for start, end in zip(cuts, cuts[1:]):
        if end > start:
            yield batch.slice(start, end - start)


def _ranges(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sizes (2, 1): the owners (0, 0, 1) and the places (0, 1, 0)."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Pass:
    """Posteriors of a batch of items."""

    weight: np.ndarray  # of each vote
    posterior: np.ndarray  # of each candidate
    shown: np.ndarray  # probability that a vote shows the truth
    right: np.ndarray  # probability that a vote's label is true
    easiness: np.ndarray  # of each item
    expected: np.ndarray  # s
    vote: np.ndarray  # of each pair of a vote and a candidate of its item
    candidate: np.ndarray


def infer(b: Ballots, model: Model) -> Pass:
    """Label posteriors and easiness of the items of a batch under the abilities."""
    n, votes, labels = len(b.items), len(b.item), len(b.owner)
    ability, group, said = model.ability[b.voters], model.group[b.voters], b.numbers[b.at]
    # equal votes of dependent voters count once
    _, inverse, same = np.unique(b.at * (len(model.group) + 1) + group, return_inverse=True, return_counts=True)
    weight = 1 / same[inverse]
    vote, place = _ranges(np.bincount(b.owner, minlength=n)[b.item])
    candidate = b.first[b.item[vote]] + place
    rare = model.general.shape[1] - 1
    slip = np.full(len(vote), RARE_SLIP)
    known = said[vote] != rare
    slip[known] = model.habit(b.voters[vote[known]], b.numbers[candidate[known]], said[vote[known]])
    own = model.habit(b.voters, said, said)
    equal = candidate == b.at[vote]
    log_prior, log_easy = np.log(b.prior), np.zeros(n)
    for step in range(INNER):
        easy = np.exp(log_easy)[b.item]
        s = _sigmoid(ability * easy)
        told = np.log(np.where(equal, s[vote], 0) + (1 - s[vote]) * slip + 1e-9) * weight[vote]
        log = log_prior + np.bincount(candidate, weights=told, minlength=labels)
        log -= np.maximum.reduceat(log, b.first)[b.owner]
        posterior = np.exp(log)
        posterior /= np.add.reduceat(posterior, b.first)[b.owner]
        right = posterior[b.at]
        shown = right * s / (s + (1 - s) * own)
        if step < INNER - 1:
            # gradient step on the log easiness with a standard normal prior
            slope = np.bincount(b.item, weights=weight * (shown - s) * ability * easy, minlength=n) - log_easy
            curve = np.bincount(b.item, weights=weight * s * (1 - s) * (ability * easy) ** 2, minlength=n) + 1
            log_easy = np.clip(log_easy + np.clip(slope / curve, -1, 1), -3, 3)
    return Pass(weight, posterior, shown, right, np.exp(log_easy), s, vote, candidate)


def _slips(b: Ballots, p: Pass, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Expected votes that don't show the truth, by (voter, true label, label) in one index."""
    width = model.general.shape[1]
    own = p.candidate == b.at[p.vote]
    missed = np.where(own, (p.right - p.shown)[p.vote], p.posterior[p.candidate]) * (p.weight * b.items[b.item])[p.vote]
    key = (b.voters[p.vote] * width + b.numbers[p.candidate]) * width + b.numbers[b.at][p.vote]
    return _summed([key], [missed])


def _summed(places: list[np.ndarray], weights: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted places with the sums of their weights."""
    key, inverse = np.unique(np.concatenate([np.zeros(0, np.int64), *places]), return_inverse=True)
    return key, np.bincount(inverse, weights=np.concatenate([np.zeros(0), *weights]), minlength=len(key))


class _Pairs:
    """Two sums per pair of voters, summed up within a task."""

    def __init__(self, size: int):
        self.size, self.parts, self.held = size, [], 0

    def add(self, b: Ballots, first, second) -> None:
        """``first`` and ``second``: values of the votes x and y of one item."""
        votes = np.bincount(b.item, minlength=len(b.items))
        last = np.cumsum(votes)[b.item]
        x, place = _ranges(last - np.arange(len(b.item)) - 1)
        y = x + 1 + place
        other = b.voters[x] != b.voters[y]
        x, y = x[other], y[other]
        key = np.minimum(b.voters[x], b.voters[y]) * self.size + np.maximum(b.voters[x], b.voters[y])
        items = b.items[b.item[x]]
        unique, inverse = np.unique(key, return_inverse=True)
        self.parts.append((unique, *(np.bincount(inverse, weights=f(x, y) * items, minlength=len(unique)) for f in (first, second))))
        self.held += len(unique)
        if self.held > AT_ONCE:
            self.parts = [self.total()]
            self.held = len(self.parts[0][0])

    def total(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        key = [k for k, _, _ in self.parts]
        place, one = _summed(key, [a for _, a, _ in self.parts])
        return place, one, _summed(key, [a for _, _, a in self.parts])[1]


STATS = "a bigint, b bigint, slope double, curve double, right double, votes double"


def _statistics(distinct: DataFrame, model: Model, pairs: bool) -> DataFrame:
    """Per voter (a = b) the gradient sums; at b = -1 the expected slips of index a; with
    ``pairs`` also per pair of voters the common and all errors. Summed per task before the
    shuffle. ``distinct``: the patterns."""
    given = distinct.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = given.value
        size = len(model.ability)
        sums = np.zeros((4, size))
        slips = np.zeros(0, np.int64), np.zeros(0)
        errors = _Pairs(size)
        for batch in (part for batch in batches for part in _slices(batch)):
            b = read(batch)
            p = infer(b, model)
            easy, items = p.easiness[b.item], b.items[b.item]
            slips = _summed(*zip(slips, _slips(b, p, model)))
            for k, value in enumerate((p.weight * (p.shown - p.expected) * easy, p.weight * p.expected * (1 - p.expected) * easy**2, p.right, 1.0)):
                sums[k] += np.bincount(b.voters, weights=value * items, minlength=size)
            if pairs:
                wrong = lambda x, y: np.where(b.codes[x] == b.codes[y], 1 - p.right[x], 0.0)  # noqa: B023, E731
                errors.add(b, wrong, lambda x, y: np.where(b.codes[x] == b.codes[y], 1 - p.right[x], 1.0))  # noqa: B023
        met, told = np.flatnonzero(sums[3]), slips[1] > 1e-3
        missed, slipped = slips[0][told], slips[1][told]
        key, common, either = errors.total()
        zero = lambda x: np.zeros(len(x))
        a, b_ = np.concatenate([met, missed, key // size]), np.concatenate([met, np.full(len(missed), -1), key % size])
        columns = [np.concatenate([sums[k][met], slipped if k == 0 else zero(missed), (common, either, zero(key), zero(key))[k]]) for k in range(4)]
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b_, pa.int64()), *(pa.array(c, pa.float64()) for c in columns)], [x.split()[0] for x in STATS.split(", ")])

    return distinct.mapInArrow(run, STATS).groupBy("a", "b").agg(*(F.sum(c).alias(c) for c in ("slope", "curve", "right", "votes")))


def _grouped(size: int, pairs: list[tuple[int, int]]) -> np.ndarray:
    """The groups that the pairs connect, each named by its first voter."""
    group = np.arange(size)
    for a, b in pairs:
        low, high = sorted((int(group[a]), int(group[b])))
        group[group == high] = low
    return group


def fit(votes: DataFrame) -> tuple[DataFrame, Model]:
    """The encoded ballots and the fitted abilities and groups of dependent voters."""
    encoded, model = encode(votes)
    distinct = patterns(encoded)
    copies = dependent(distinct, model)
    model.group = _grouped(len(model.group), copies)
    settled = False
    for k in range(PASSES):
        # dependence is looked for early, and again when the abilities have settled
        pairs = k == 2 or settled
        stats = _statistics(distinct, model, pairs)
        # gathered are voters, their slips and dependent pairs, never items
        rows = stats.filter((F.col("a") == F.col("b")) | (F.col("b") == -1) | ((F.col("slope") >= COMMON_ERRORS * F.col("curve")) & (F.col("curve") >= LEAST_ERRORS))).limit(MAX_VOTERS + MAX_SLIPS + 1).toPandas()
        if len(rows) > MAX_VOTERS + MAX_SLIPS:
            raise ValueError(f"more than {MAX_SLIPS} slips of voters")
        rows = rows.sort_values(["a", "b"], kind="stable")
        own, slipped = rows[rows["a"] == rows["b"]], rows[rows["b"] == -1]
        new, group, at = model.ability.copy(), model.group, own["a"].to_numpy()
        # Newton step with a normal prior around 1
        step = (own["slope"].to_numpy() - (new[at] - 1)) / (own["curve"].to_numpy() + 1)
        new[at] = np.clip(new[at] + np.clip(step, -1, 1), -4, 8)
        if pairs:
            alike = rows[(rows["a"] != rows["b"]) & (rows["b"] >= 0)]
            group = _grouped(len(new), [*copies, *zip(alike["a"].tolist(), alike["b"].tolist())])
        # what the votes feel of the movement, so that voters of a few votes don't hold it up
        felt = own["votes"].to_numpy()
        moved = (np.abs(new - model.ability)[at] * felt).sum() / max(felt.sum(), 1)
        done = settled and np.array_equal(group, model.group)
        model = _model(model.names, new, group, model.general, slipped["a"].to_numpy(np.int64), slipped["slope"].to_numpy(float))
        if done:
            break
        settled = k > 2 and moved < SETTLED
    return encoded, model


def _agreements(distinct: DataFrame, size: int) -> DataFrame:
    """(a, b, n, equal): common items and equal votes of each pair of voters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = _Pairs(size)
        for batch in (part for batch in batches for part in _slices(batch)):
            b = read(batch)
            total.add(b, lambda x, y: np.ones(len(x)), lambda x, y: b.codes[x] == b.codes[y])  # noqa: B023
        key, n, equal = total.total()
        yield pa.RecordBatch.from_arrays([pa.array(key // size, pa.int64()), pa.array(key % size, pa.int64()), pa.array(n.astype(np.int64), pa.int64()), pa.array(equal, pa.float64())], ["a", "b", "n", "equal"])

    return distinct.mapInArrow(run, "a bigint, b bigint, n bigint, equal double").groupBy("a", "b").agg(F.sum("n").alias("n"), F.sum("equal").alias("equal"))


def dependent(distinct: DataFrame, model: Model) -> list[tuple[int, int]]:
    """Pairs of voters that agree far more than their agreement with others explains.

    Among independent voters the chance-corrected agreement of a and b is about the product
    of two reliabilities; each is the median over all partners, so copies can't lift it.
    Beyond MAX_PAIRS pairs the medians are taken where the pairs are.
    """
    size = len(model.ability)
    chance = np.clip((model.general[:, :-1] ** 2).sum(axis=1), 0, 0.9)
    spark = distinct.sparkSession
    number = spark.createDataFrame(pd.DataFrame({"v": np.arange(size), "chance": chance}), "v bigint, chance double") if size else None
    found = _agreements(distinct, max(1, size)).filter(F.col("n") >= LEAST_COMMON)
    if number is None:
        return []
    for x in "ab":
        found = found.join(F.broadcast(number.select(F.col("v").alias(x), F.col("chance").alias("chance_" + x))), x)
    base = (F.col("chance_a") + F.col("chance_b")) / 2
    found = materialise(found.select("a", "b", ((F.col("equal") / F.col("n") - base) / (1 - base)).alias("x")))
    level = np.full(size, 0.7)
    if found.count() <= MAX_PAIRS:
        pdf = found.toPandas()
        a, b, x = (pdf[c].to_numpy() for c in ("a", "b", "x"))
        for _ in range(30):
            ratio = pd.Series(np.concatenate([x / level[b], x / level[a]])).groupby(np.concatenate([a, b])).median()
            level[ratio.index.to_numpy()] = np.clip(ratio.to_numpy(), 0.05, 1)
        told = (x > 0.4) & (x - level[a] * level[b] > EXCESS)
        return list(zip(a[told].tolist(), b[told].tolist()))
    both = found.unionAll(found.select(F.col("b").alias("a"), F.col("a").alias("b"), "x"))
    levels = lambda c: F.broadcast(spark.createDataFrame(pd.DataFrame({c: np.arange(size), "level_" + c: level}), f"{c} bigint, level_{c} double"))
    for _ in range(30):
        ratio = both.join(levels("b"), "b").groupBy("a").agg(F.median(F.col("x") / F.col("level_b")).alias("m")).toPandas()
        level[ratio["a"].to_numpy()] = np.clip(ratio["m"].to_numpy(), 0.05, 1)
    told = found.join(levels("a"), "a").join(levels("b"), "b").filter((F.col("x") > 0.4) & (F.col("x") - F.col("level_a") * F.col("level_b") > EXCESS))
    return [(r.a, r.b) for r in told.select("a", "b").limit(MAX_PAIRS).toLocalIterator()]


LABELS = "image_id string, item string, aspect string, label string, posterior double, difficulty double, agreement double, votes int"


def consensus(encoded: DataFrame, model: Model) -> DataFrame:
    """One label per item with its posterior, difficulty and chance-corrected agreement.

    Agreement is (observed - expected) / (1 - expected) over pairs of votes, expected from
    the voters' general habits; null for a single vote.
    """
    given = encoded.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = given.value
        for batch in (part for batch in batches for part in _slices(batch)):
            first, where = _distinct(batch)
            b = read(batch.take(first))
            p = infer(b, model)
            count = np.bincount(b.item, minlength=len(b.items))
            tally = np.bincount(b.at, minlength=len(b.owner))
            score = np.round(p.posterior, 9) + 1e-12 * tally
            # the first of the best candidates
            order = np.lexsort((np.arange(len(score)), -score, b.owner))
            best = order[b.first]
            observed = np.add.reduceat(tally * (tally - 1), b.first) / np.maximum(count * (count - 1), 1)
            chance = np.bincount(b.item, weights=model.general[b.voters, b.numbers[b.at]], minlength=len(b.items))
            expected = np.minimum(0.95, chance / np.maximum(count, 1))
            agreement = np.where(count > 1, (observed - expected) / (1 - expected), np.nan)
            chosen, labels = (best - b.first)[where], batch.column(5)
            sizes = np.diff(labels.offsets.to_numpy())
            start = np.cumsum(sizes) - sizes
            # of equally good labels the smaller one
            ties = np.add.reduceat((np.abs(score - score[best][b.owner]) < 1e-13).astype(int), b.first)[where] > 1
            for k in np.flatnonzero(ties):
                own = labels[int(k)].as_py()
                tied = np.flatnonzero(np.abs(score[b.first[where[k]] :][: sizes[k]] - score[best[where[k]]]) < 1e-13)
                chosen[k] = min(tied, key=lambda c: own[c])  # noqa: B023
            names = labels.flatten().take(pa.array(start + chosen))
            data = [batch.column(0), batch.column(1), batch.column(2), names.cast(pa.string()), pa.array(p.posterior[best][where]), pa.array((1 / p.easiness)[where]), pa.array(agreement[where], pa.float64(), from_pandas=True), pa.array(count[where], pa.int32())]
            yield pa.RecordBatch.from_arrays(data, [x.split()[0] for x in LABELS.split(", ")])

    return encoded.mapInArrow(run, LABELS)


def _distinct(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray]:
    """The first rows of the batch's distinct ballots, and which of them each row has."""
    seen: dict[bytes, int] = {}
    first, where = [], np.zeros(batch.num_rows, np.int64)
    columns = []
    for name in ("voters", "codes", "numbers"):
        column = batch.column(batch.schema.names.index(name))
        sizes, values = _flat(column, np.int32)
        ends = np.cumsum(sizes)
        columns.append((values, ends - sizes, ends))
    for k in range(batch.num_rows):
        key = b"|".join([values[start[k] : end[k]].tobytes() for values, start, end in columns])
        at = seen.setdefault(key, len(first))
        if at == len(first):
            first.append(k)
        where[k] = at
    return pa.array(first, pa.int64()), where


def voters(encoded: DataFrame, model: Model) -> DataFrame:
    """Per voter and aspect: votes, share of true labels, ability, and whom it depends on."""
    stats = {r.a: r for r in _statistics(patterns(encoded), model, False).filter("a = b").collect()}
    rows = [(name, aspect, int(stats[k].votes), float(stats[k].right / stats[k].votes), float(model.ability[k]), model.names[model.group[k]][1]) for k, (aspect, name) in enumerate(model.names)]
    schema = "voter string, aspect string, votes bigint, reliability double, ability double, voting_group string"
    return encoded.sparkSession.createDataFrame(pd.DataFrame(rows, columns=[x.split()[0] for x in schema.split(", ")]), schema)
