import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from concordance.llm import mixing
from concordance.llm.queries import p7_mixture, p7_shares
from concordance.session import table

SF = "/root/testdata/sf0.01"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 500), st.floats(0.01, 0.99)), max_size=60), st.integers(0, 99))
def test_flight_keeps_the_balance(units, seed):
    tokens, chance = [t for t, _ in units], [c for _, c in units]
    p = mixing.flight(tokens, chance, random.Random(seed))
    assert sum(0 < x < 1 for x in p) <= 2 and all(0 <= x <= 1 for x in p)
    assert abs(sum(p) - sum(chance)) < 1e-5
    assert abs(sum(a * b for a, b in zip(p, tokens)) - sum(a * b for a, b in zip(chance, tokens))) < 1e-3
    landed = mixing.land(tokens, p)
    assert set(landed) <= {0.0, 1.0}
    assert abs(sum(a * b for a, b in zip(landed, tokens)) - sum(a * b for a, b in zip(chance, tokens))) <= max(tokens, default=0) + 1e-3


def test_flight_is_unbiased():
    tokens, chance = [5, 9, 14, 2, 30, 7, 7, 7], [0.3, 0.6, 0.5, 0.8, 0.2, 0.4, 0.4, 0.8]
    runs = 4000
    mean = [0.0] * 8
    for seed in range(runs):
        for k, x in enumerate(mixing.flight(tokens, chance, random.Random(seed))):
            mean[k] += x / runs
    assert all(abs(a - b) < 0.04 for a, b in zip(mean, chance))


def test_shares_on_the_data(spark):
    rows = p7_shares(spark, SF).collect()
    biggest = max(r.tokens for r in p7_mixture(spark, SF).collect())
    total = sum(r.mixed_tokens for r in rows)
    for r in rows:
        assert abs(r.share - r.target_share) * total <= 1.5 * biggest
        assert r.most_copies <= r.max_repeats
    assert abs(sum(r.share for r in rows) - 1) < 1e-9


def test_rounds_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 16)
    sized = spark.createDataFrame([(k, "big" if k % 3 else "small", 10 + k % 37) for k in range(6000)], "doc_id long, source string, tokens long")
    targets = spark.createDataFrame([("big", 0.4, 1), ("small", 0.6, 3)], "source string, target_share double, max_repeats int")
    mixed = mixing.mixture(sized, targets)
    shares = {r.source: r for r in mixing.shares(mixed, targets).collect()}
    assert abs(shares["big"].share - 0.4) < 0.002 and shares["small"].most_copies <= 3
    assert mixed.count() == mixed.select("doc_id").distinct().count()


def test_edge_cases(spark):
    docs = [(1, "a b c", "s", 9), (2, None, "s", 9), (3, "", "s", 9), (4, "x y", None, 9), (5, "x y", "other", 9), (6, "word " * 60_000, "t", 9), (7, "w" * 150_000, "t", 9), (8, "a b c", "s", 9), (8, "a b c", "s", 9)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, tokens int")
    targets = spark.createDataFrame([("s", 0.5, 2), ("t", 0.3, 1), ("none", 0.2, 5), (None, 0.0, 1)], "source string, target_share double, max_repeats int")
    sized = mixing.sizes(df)
    got = {r.doc_id for r in sized.collect()}
    assert got == {1, 3, 4, 5, 6, 7, 8}
    mixed = mixing.mixture(sized, targets).collect()
    assert {r.source for r in mixed} <= {"s", "t"} and all(r.copies <= {"s": 2, "t": 1}[r.source] for r in mixed)
    assert mixing.mixture(sized.limit(0), targets).count() == 0
    assert mixing.mixture(sized, targets.limit(0)).count() == 0
    assert {r.source: r.mixed_tokens for r in mixing.shares(mixing.mixture(sized, targets), targets.filter("source = 'none'")).collect()} == {"none": 0}


def test_plan():
    totals, targets = {"a": (10, 1000), "b": (5, 100)}, {"a": (0.5, 1), "b": (0.5, 4), "c": (0.2, 9)}
    times, total = mixing.plan(totals, targets)
    assert total == pytest.approx(800) and times == {"a": pytest.approx(0.4), "b": pytest.approx(4)}


def test_long_texts_are_counted_whole():
    encoding = mixing.encoder(mixing.RANKS)
    for text in ("a" * 150_000, "word and word " * 12_000, "中文" * 80_000):
        assert mixing.token_count(text, encoding) == len(encoding.encode_ordinary(text))
