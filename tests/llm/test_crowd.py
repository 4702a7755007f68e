import random

import numpy as np
import pytest

from concordance.llm import crowd

SHAPES = ["a", "b", "c", "d"]
SKILL = {"good": 0.95, "fair": 0.8, "poor": 0.45, "copied": 0.6}


def simulated(seed=3, items=900):
    rng = random.Random(seed)
    truth, rows = {}, []
    for k in range(items):
        t = truth[str(k)] = rng.choice(SHAPES)
        said = {v: t if rng.random() < s else rng.choice([x for x in SHAPES if x != t]) for v, s in SKILL.items()}
        said["copier"] = said["copied"]
        said["copier2"] = said["copied"]
        said["constant"] = "a"
        said["swapper"] = {"c": "d", "d": "c"}.get(t, t) if rng.random() < 0.9 else rng.choice(SHAPES)
        for v, label in said.items():
            if rng.random() < 0.7:
                rows.append(("i", str(k), "shape", v, label))
    return truth, rows


@pytest.fixture(scope="module")
def fitted(spark):
    truth, rows = simulated()
    df = spark.createDataFrame(rows + rows[:50], "image_id string, item string, aspect string, voter string, label string")
    return truth, rows, crowd.fit(df)


def test_beats_the_majority(fitted):
    truth, rows, (encoded, model) = fitted
    got = {r["item"]: r for r in crowd.consensus(encoded, model).collect()}
    tally = {}
    for _, item, _, _, label in rows:
        tally.setdefault(item, []).append(label)
    majority = sum(max(sorted(set(v)), key=v.count) == truth[k] for k, v in tally.items())
    ours = sum(got[k].label == truth[k] for k in tally)
    assert len(got) == len(tally)
    assert ours > majority + 40 and ours / len(tally) > 0.9
    assert all(0 < r.posterior <= 1 and r.difficulty > 0 for r in got.values())


def test_voters(fitted):
    _, _, (encoded, model) = fitted
    v = {r.voter: r for r in crowd.voters(encoded, model).collect()}
    for name, skill in SKILL.items():
        assert abs(v[name].reliability - skill) < 0.08, name
    assert len({v[x].voting_group for x in ("copied", "copier", "copier2")}) == 1
    assert len({v[x].voting_group for x in ("good", "fair", "poor", "copied")}) == 4
    assert v["good"].ability > v["fair"].ability > v["poor"].ability


def test_habits_depend_on_the_truth_with_many_voters_and_labels(spark):
    """100 labels and 2,100 voters; the swappers mix up the labels 0 and 1 and have no other slips."""
    rng = random.Random(4)
    rows = []
    for k in range(3000):
        t = k % 100
        for v in rng.sample(range(2100), 4):
            rows.append(("i", str(k), "shape", f"v{v}", f"l{t:02d}"))
    for k in [x for x in range(3000) if x % 100 < 6]:
        t = k % 100
        rows.append(("i", str(k), "shape", "swapper", f"l{ {0: 1, 1: 0}.get(t, t):02d}"))
    df = spark.createDataFrame(rows, "image_id string, item string, aspect string, voter string, label string")
    _, model = crowd.fit(df)
    assert len(model.names) > 2000
    v = np.array([model.names.index(("shape", "swapper"))])
    habit = lambda truth, said: model.habit(v, np.array([truth]), np.array([said]))[0]
    assert habit(0, 1) > 0.5 and habit(1, 0) > 0.5 and habit(3, 1) < 0.3 and habit(3, 0) < 0.3


def test_edge_cases(spark):
    rows = [("i", "1", "t", "v", "x"), ("i", "1", "t", "v", "x"), ("i", "1", "t", "w", None), ("i", "2", "t", None, "x"), ("i", "3", "t", "v", "p"), ("i", "3", "t", "w", "q"), (None, "4", "t", "v", ""), ("i", "5", "t", "v", "x" * 50_000), ("i", "6", "u", "v", "a"), ("i", "6", "u", "v", "b")]
    df = spark.createDataFrame(rows, "image_id string, item string, aspect string, voter string, label string").selectExpr("*", "1 as votes", "2 as n")
    got = {r["item"]: r for r in crowd.consensus(*crowd.fit(df)).collect()}
    assert set(got) == {"1", "3", "4", "5", "6"}
    assert got["1"].label == "x" and got["1"].votes == 1 and got["1"].agreement is None
    assert got["3"].label == "p" and got["3"].agreement < 0 and got["6"].label == "a" and got["4"].label == ""
    assert crowd.consensus(*crowd.fit(df.limit(0))).count() == 0
