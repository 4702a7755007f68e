"""Mixtures of sources with target shares of tokens, by balanced sampling (cube method).

The mixture's size is the largest that every source can supply with its capped repeats, or
a given one. A source that must give ``w`` times its own tokens gives every document
floor(w) times and a sample of documents once more. That sample is drawn by the cube
method: every document starts with the probability w - floor(w); three documents at a time
move along the null space of the constraints (tokens and number of documents stay as they
are) until one of them is in or out. Documents are handled in blocks of a bounded size, so
a source with a third of all rows is many tasks; what a block leaves undecided, two
documents at most, goes into the blocks of the next round, and the last two of each source
land where the token total is met best.

Defined results: null texts have no tokens and are not drawn; empty texts have 0 tokens and
are drawn like others; documents of no or an unlisted source are left out; a listed source
without tokens gets nothing and the others share in proportion; a copy under a new id is a
document of its own; repeats of a document never exceed its source's cap.
"""

from __future__ import annotations

import base64
import random
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from concordance.session import materialise

#: Documents of a block; a block is one group of one task.
BLOCK = 4096
#: Listed sources; their targets and totals are gathered.
MAX_SOURCES = 100_000
#: Place of a public tokenizer's ranks; the same on every worker.
RANKS = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: How that vocabulary splits texts (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=2)
def encoder(ranks: str):
    """The tokenizer of a file of ranks."""
    import tiktoken

    with open(ranks, "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})


def token_count(text: str, encoding) -> int:
    """Tokens of a whole text, however long."""
    return len(encoding.encode_ordinary(text))


def sizes(documents: DataFrame, ranks: str = RANKS) -> DataFrame:
    """(doc_id, source, tokens) of every document with a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = encoder(ranks)
        for batch in batches:
            counts = [token_count(t, encoding) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.int64())], ["doc_id", "source", "tokens"])

    narrow = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"))
    return narrow.filter("text is not null").mapInArrow(run, "doc_id bigint, source string, tokens bigint")


def flight(tokens: list[int], chance: list[float], rng: random.Random) -> list[float]:
    """Moves the probabilities to 0 or 1 but for two at most; sums of ``chance`` and of
    ``chance * tokens`` stay as they are."""
    p = list(chance)
    eps = 1e-9
    free = [k for k in range(len(p)) if eps < p[k] < 1 - eps]
    hand = free[:3]
    at = 3
    while len(hand) == 3:
        a, b, c = hand
        u = (tokens[b] - tokens[c], tokens[c] - tokens[a], tokens[a] - tokens[b])
        if not any(u):
            u = (1, -1, 0)
        up = min((1 - p[k]) / x if x > 0 else p[k] / -x for k, x in zip(hand, u) if x)
        down = min(p[k] / x if x > 0 else (1 - p[k]) / -x for k, x in zip(hand, u) if x)
        step = up if rng.random() * (up + down) < down else -down
        for k, x in zip(hand, u):
            p[k] += step * x
            if p[k] <= eps or p[k] >= 1 - eps:
                p[k] = float(p[k] > 0.5)
        hand = [k for k in hand if eps < p[k] < 1 - eps]
        while len(hand) < 3 and at < len(free):
            hand.append(free[at])
            at += 1
    return p


def land(tokens: list[int], chance: list[float]) -> list[float]:
    """The last few in or out, so that the token total is met best, then the count."""
    free = [k for k, x in enumerate(chance) if 0 < x < 1]
    best = None
    for bits in range(1 << len(free)):
        out = list(chance)
        for j, k in enumerate(free):
            out[k] = float(bits >> j & 1)
        off = (abs(sum(t * (x - y) for t, x, y in zip(tokens, out, chance))), abs(sum(out) - sum(chance)))
        if best is None or off < best[0]:
            best = (off, out)
    return best[1]


def plan(totals: dict[str, tuple[int, int]], targets: dict[str, tuple[float, int]], total: float | None = None) -> tuple[dict[str, float], float]:
    """How many times each source is given, and the mixture's tokens.

    ``totals``: source -> (documents, tokens); ``targets``: source -> (share, most repeats).
    """
    able = {s: share for s, (share, most) in targets.items() if share > 0 and most > 0 and totals.get(s, (0, 0))[1] > 0}
    whole = sum(able.values())
    if not whole:
        return {}, 0.0
    able = {s: share / whole for s, share in able.items()}
    limit = min(targets[s][1] * totals[s][1] / share for s, share in able.items())
    total = min(limit, total) if total else limit
    return {s: share * total / totals[s][1] for s, share in able.items()}, total


def mixture(sized: DataFrame, targets: DataFrame, total: float | None = None, seed: int = 1) -> DataFrame:
    """(doc_id, source, tokens, copies) of the documents in the mixture."""
    spark = sized.sparkSession
    sized = materialise(sized)
    given = targets.filter("source is not null").select("source", "target_share", "max_repeats").limit(MAX_SOURCES + 1).collect()
    if len(given) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} target sources")
    asked = {r.source: (float(r.target_share or 0), int(r.max_repeats or 0)) for r in given}
    # one row per listed source comes to the driver
    names = spark.createDataFrame([(s,) for s in sorted(asked)], "source string")
    listed = sized.join(F.broadcast(names), "source")
    totals = {r.source: (r.n, r.tokens) for r in listed.groupBy("source").agg(F.count("*").alias("n"), F.sum("tokens").alias("tokens")).collect()}
    times, _ = plan(totals, asked, total)
    if not times:
        return sized.limit(0).select("doc_id", "source", "tokens", F.lit(0).alias("copies"))
    rates = spark.createDataFrame([(s, int(w + 1e-9), max(0.0, w - int(w + 1e-9)), totals[s][0]) for s, w in times.items()], "source string, base int, chance double, n bigint")
    start = sized.join(F.broadcast(rates), "source").select("doc_id", "source", "tokens", "base", "chance", "n")

    schema = "doc_id bigint, source string, tokens bigint, base int, chance double, n bigint"

    def fly(last: bool):
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("doc_id", kind="stable").reset_index(drop=True)
            rng = random.Random(f"{seed} {pdf['source'].iloc[0]} {int(pdf['doc_id'].iloc[0])}")
            order = list(range(len(pdf)))
            rng.shuffle(order)
            pdf = pdf.iloc[order].reset_index(drop=True)
            tokens = pdf["tokens"].tolist()
            p = flight(tokens, pdf["chance"].tolist(), rng)
            pdf["chance"] = land(tokens, p) if last else p
            return pdf[["doc_id", "source", "tokens", "base", "chance", "n"]]

        return run

    done, open_ = start.filter("chance <= 1e-9"), start.filter("chance > 1e-9")
    most = max(n for n, _ in totals.values())
    parts = [done]
    level = 0
    while True:
        last = most <= BLOCK
        blocks = F.greatest(F.lit(1), F.ceil(F.col("n") / (F.lit(BLOCK) * F.pow(F.lit(BLOCK / 4.0), F.lit(level))))).cast("bigint")
        flown = materialise(open_.groupBy("source", F.pmod(F.xxhash64("doc_id", F.lit(seed + level)), blocks).alias("block")).applyInPandas(fly(last), schema))
        settled = (F.col("chance") <= 1e-9) | (F.col("chance") >= 1 - 1e-9)
        parts.append(flown.filter(settled))
        if last:
            break
        # a block leaves two at most; the next round has that many fewer
        open_, most, level = flown.filter(~settled), -(-most // (BLOCK // 4)), level + 1
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out.select("doc_id", "source", "tokens", (F.col("base") + F.round("chance").cast("int")).alias("copies")).filter("copies > 0")


def shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """Per listed source the target share and what was reached."""
    got = mixed.groupBy("source").agg(F.count("*").alias("documents"), F.sum(F.col("tokens") * F.col("copies")).alias("mixed_tokens"), F.max("copies").alias("most_copies"))
    whole = F.sum("mixed_tokens").over(Window.partitionBy())  # over one row per listed source
    joined = targets.select("source", "target_share", "max_repeats").join(got, "source", "left")
    number = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return joined.select("source", "target_share", "max_repeats", number("documents"), number("mixed_tokens"), number("most_copies"), (F.coalesce("mixed_tokens", F.lit(0)) / whole).alias("share"))
