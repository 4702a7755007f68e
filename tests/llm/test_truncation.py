import numpy as np
import pytest

from concordance.llm import truncation as t

TEXT = [
    ("The desk moved it on sheet 5.", "sound"), ("The desk moved it on sh", "line"), ("A note with a score of 0.", "broken"), ("It said \"yes\"", "sound"),
    ("It said \"ye", "line"), ("第一行完整。", "sound"), ("The desk moved …", "broken"), ("The desk moved it. [cut", "sound"), ("The desk mov [cut", "broken"), ("bro�", "broken"),
    ('{"a": [1, 2]}', "sound"), ('{"a": [1, 2', "broken"), ("x\n```json\n{}\n```", "sound"), ("x\n```json\n{}\n", "broken"),
    ("| a | b |\n| --- | --- |\n| 1 | 2 |", "sound"), ("| a | b |\n| --- | --- |\n| 1 |", "broken"), ("| a | b |\n| --- | --- |", "broken"), ("| a | b |", "broken"),
    ("Text.\n\n[page 3/4]", "sound"), ("Text.\n---", "sound"), ("Text.\nSigned: Bo", "line"), ("   ", "broken"), ("word " * 100_000, "broken"), ("Fine. (Bo)", "sound"),
]
CODE = [
    ('graph TD\n  A["x"]\n  B{"y"}\n  A --> B', "sound"), ('graph TD\n  A["x"]\n  B{"y"}\n  A --> ', "broken"), ('graph TD\n  A["x"]\n  B{"y"}\n  A -->|no', "broken"),
    ('graph TD\n  N001["x"]\n  N002["y"]\n  N001 --> N00', "broken"), ('graph TD\n  A["x"]\n  B["y"]\n  C["z"]\n  A --> B', "broken"), ("graph TD", "broken"),
    ('graph TD\n  subgraph S["s"]\n  A["x"]\n  B["y"]\n  A --> B', "broken"), ('graph TD\n  subgraph S["s"]\n  A["x"]\n  B["y"]\n  A --> B\n  end', "sound"),
    ('graph TD\n  A["x"]\n  B["y"]\n  A --> B\n  classDef hot fill:#f96\n  class A hot', "sound"), ('graph TD\n  A["x"]\n  B["y"]\n  A --> B\n  classDef hot fill:#f96\n  class A ho', "broken"),
    ('graph TD\n  A["x"]\n  B["y"]\n  A --> B\n%% done', "line"), ('graph TD\n  A["x"]\n  B["y"]\n  A --> B\n', "sound"),
]


def kind(grade):
    return "line" if grade == "line" else "broken" if grade in t.BROKEN else "sound"


@pytest.mark.parametrize(("text", "want"), TEXT)
def test_text_endings(text, want):
    assert kind(t.text_ending(text)[0]) == want


@pytest.mark.parametrize(("code", "want"), CODE)
def test_code_endings(code, want):
    assert kind(t.code_ending(code)[0]) == want


def test_censored_fit_recovers_the_distribution():
    rng = np.random.default_rng(5)
    true = np.maximum(1, np.exp(rng.normal(6, 0.6, 20_000))).astype(int)
    seen = np.minimum(true, 700)
    lengths, counts = np.unique(seen, return_counts=True)
    (limit,) = t.fit_censored(lengths, counts, "chars")
    assert limit["limit"] == 700 and limit["censoring"] > 0.95
    assert abs(limit["mu"] - 6) < 0.03 and abs(limit["sigma"] - 0.6) < 0.03
    assert not t.fit_censored(*np.unique(true, return_counts=True), "chars")


def test_held_out_cuts(spark):
    """Whole sentences, some cut at a limit and some in transfer; copies and odd rows too."""
    rng = np.random.default_rng(2)
    rows, truth = [], set()
    for k in range(1500):
        text = " ".join("The desk " + "moved " + "".join(rng.choice(list("abcdefgh"), 6)) + f" on sheet {rng.integers(10, 99999)}." for _ in range(rng.integers(3, 25)))
        source = "limited" if k % 2 else "free"
        if source == "limited" and len(text) > 400:
            text = text[:400]
            if text.rstrip()[-1] != ".":
                truth.add(k)
        elif k % 20 == 0:
            text = text[: len(text) // 2]
            if text.rstrip()[-1] != ".":
                truth.add(k)
        rows.append((k, text, source))
    rows += [(9001, None, "free"), (9002, "", "free"), (9003, rows[1][1], "limited"), (9004, "Whole. " * 200_000, None)]
    df = spark.createDataFrame(rows, "rid long, txt string, src string").selectExpr("*", "1 as chars", "'x' as source", "'y' as ending")
    found = t.posteriors(t.features(df, "s", "rid", "txt", "src", "text"))
    got = {r.record_id for r in found.filter("posterior > 0.5").collect()} - {9003}
    assert got == truth
    shares = {r.source: r for r in t.rates(found).collect()}
    assert shares["limited"].cut_at_limit > 200 and shares["free"].cut_at_limit < 10 and shares[""].cut == 0
    assert {r.record_id for r in found.select("record_id").collect()} >= {9004} and found.filter("record_id in (9001, 9002)").count() == 0


def test_long_last_lines_are_compared_whole():
    graph = 'graph TD\n  A["x"]\n  B["y"]\n  A --> B\n'
    style = "classDef hot fill:#f96,stroke:#333,stroke-width:4px,color:#000,font-size:12px"
    whole, cut = t.code_ending(graph + style), t.code_ending(graph + style[:70])
    assert whole[0] == cut[0] == "line" and whole[1] != cut[1] and whole == t.code_ending(graph + style + "\n")
    long = "Note: " + "w-" * 40
    assert t.shape(long + "? x") != t.shape(long + "? y")


def _at_limit(spark, whole_at_limit, transfers):
    """600 values cut at 500 characters, others whole; some whole ones just as long as a cut one."""
    rng = np.random.default_rng(11)
    words = lambda: "".join("".join(rng.choice(list("abcdefgh"), rng.integers(3, 9))) + (". " if rng.random() < 0.15 else " ") for _ in range(200))
    rows = [(k, words()[:500], "s") for k in range(600)]
    rows += [(1000 + k, words()[: int(np.exp(rng.normal(5.4, 0.4)))].rstrip() + ".", "s") for k in range(1400)]
    rows += [(3000 + k, words()[:498] + "x.", "s") for k in range(whole_at_limit)]
    rows += [(5000 + k, words()[:313] + "x", "s") for k in range(transfers)]
    df = spark.createDataFrame([r for r in rows if r[0] < 1000 or r[0] >= 3000 or len(r[1]) < 500], "rid long, txt string, src string")
    sound = {k for k, text, _ in rows if k < 1000 and kind(t.text_ending(text)[0]) == "sound"}
    return t.features(df, "s", "rid", "txt", "src", "text"), sound


def test_censoring_at_a_limit_decides(spark, monkeypatch):
    found, sound = _at_limit(spark, 0, 0)
    cut = lambda: {r.record_id for r in t.posteriors(found).filter("posterior > 0.5").collect()}
    assert len(sound) > 5 and cut() == set(range(600))
    fit = t.fit_censored
    monkeypatch.setattr(t, "fit_censored", lambda *a: [{**x, "censoring": 0.5} for x in fit(*a)])
    assert cut() == set(range(600)) - sound
    # without the limits the endings stand alone
    monkeypatch.setattr(t, "fit_censored", lambda *a: [])
    assert cut() == set(range(600)) - sound


def test_shares_of_cuts_and_grades_are_learned():
    """From a limit and other lengths the fit finds how many are cut and how they end."""
    broken = np.array([True, True, False, False])
    sound, whole = np.array([0, 0, 0.03, 0.02]), np.array([0, 0, 0.3, 0.7])
    cuts = [sound + 0.95 * np.array([0.2, 0.8, 0, 0]), sound + 0.95 * np.array([0.6, 0.4, 0, 0])]
    counts = np.array([10_000 * (s * cuts[z] + (1 - s) * whole) for z, s in ((0, 0.02), (1, 0.8))])
    share, cut, w = t.learned(counts, np.array([0.05, 0.97]), np.array([1.0, 50.0]), np.array([0, 1]), broken, sound)
    assert np.abs(share - (0.02, 0.8)).max() < 0.005
    assert np.abs(cut - cuts).max() < 0.01 and np.abs(w - whole).max() < 0.01


def test_long_lines_can_be_common(spark):
    """A long last line without an end mark is whole if it is common, and cut if it is rare."""
    note = "Recorded by the night desk of the harbour office and filed under the usual heading"
    rows = [(k, f"The desk moved {k} boxes.\n{note}", "s") for k in range(200)] + [(900 + k, f"The desk moved it.\n{note[: 62 + k]}", "s") for k in range(3)]
    df = spark.createDataFrame(rows, "rid long, txt string, src string")
    got = {r.record_id for r in t.posteriors(t.features(df, "s", "rid", "txt", "src", "text")).filter("posterior > 0.5").collect()}
    assert got == {900, 901, 902}


def test_whole_values_as_long_as_cut_ones_stay_whole(spark):
    found, sound = _at_limit(spark, 120, 5)
    got = {r.record_id for r in t.posteriors(found).filter("posterior > 0.5").collect()}
    assert got == set(range(600)) - sound | set(range(5000, 5005))


def test_empty(spark):
    df = spark.createDataFrame([], "rid long, txt string, src string")
    assert t.posteriors(t.features(df, "s", "rid", "txt", "src", "text")).count() == 0
