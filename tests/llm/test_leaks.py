import random

from hypothesis import given, settings
from hypothesis import strategies as st

from concordance.llm import leaks
from concordance.llm.queries import p6_found
from concordance.session import table

random.seed(1)
WORDS = [f"w{a}{b}" for a in "abcdefgh" for b in "klmnopqrst"]
ITEM = [f"x{k}" if k % 3 else random.choice(WORDS) for k in range(90)]


def text(n, rng):
    return [rng.choice(WORDS) for _ in range(n)]


def best_by_dp(doc, item, least):
    """Is there a passage of ``least`` item tokens with at most a tenth edited? By full DP."""
    for start in range(len(item) - least + 1):
        for length in range(least, min(2 * least, len(item) - start) + 1):
            row = [0] * (len(doc) + 1)
            for w in item[start : start + length]:
                new = [row[0] + 1]
                for k, d in enumerate(doc, 1):
                    new.append(min(row[k - 1] + (d != w), row[k] + 1, new[-1] + 1))
                row = new
            if min(row) <= length // 10:
                return True
    return False


def test_wu_manber_finds_every_occurrence():
    rng = random.Random(7)
    for _ in range(50):
        seqs = [[rng.randint(1, 3) for _ in range(rng.randint(0, 14))] for _ in range(4)]
        doc = [rng.randint(0, 3) for _ in range(200)]
        got = sorted((i, s, j) for i, f in leaks.WuManber(seqs, 4).find(doc) for s, j in f)
        want = sorted((i, s, j) for s, q in enumerate(seqs) for j in range(len(q) - 7) for i in range(len(doc) - 7) if doc[i : i + 8] == q[j : j + 8])
        assert got == want


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 10**6), st.integers(30, 60), st.integers(0, 8))
def test_against_dynamic_programming(seed, length, edits):
    rng = random.Random(seed)
    at = rng.randint(0, len(ITEM) - length)
    part = ITEM[at : at + length]
    for _ in range(edits):
        k, what = rng.randrange(1, len(part) - 1), rng.random()
        part[k : k + 1] = [] if what < 0.3 else ["new"] if what < 0.7 else [part[k], "new"]
    doc = text(15, rng) + part + text(15, rng)
    found = leaks.Searcher([(1, " ".join(ITEM))]).find([" ".join(doc)])[0]
    want = best_by_dp(doc, ITEM, leaks.MIN_WORDS)
    if found:
        assert want
    elif want:
        # a passage counts from an unchanged word to an unchanged one
        assert not leaks.Searcher([(1, " ".join(ITEM))]).find([" ".join(part)])[0]
        assert length <= 44 or edits >= 4


def test_edge_cases(spark):
    rng = random.Random(3)
    item = " ".join(ITEM)
    zh = "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(120))
    upper = "> - " + "</p><p> ".join(w.upper().replace("X", "X́") for w in ITEM[5:60])
    docs = [
        (1, item), (2, None), (3, ""), (4, " ".join(ITEM[:39])), (5, " ".join(ITEM[:40])), (6, upper), (7, zh[:50]), (8, zh[:49]),
        (9, " ".join(zh[20:90])), (10, " ".join(text(150_000, rng) + ITEM[10:70] + text(1000, rng))), (11, item), (12, " ".join(ITEM[:30] + text(3, rng) + ITEM[30:60:2])),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as item_id", "2 as edits")
    items = spark.createDataFrame([(100, item), (101, zh), (102, None), (103, "short"), (104, "")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.passage_tokens, r.edits) for r in leaks.leaks(df, items).collect()}
    assert got == {(1, 100): (90, 0), (5, 100): (40, 0), (6, 100): (55, 0), (7, 101): (50, 0), (9, 101): (70, 0), (10, 100): (60, 0), (11, 100): (90, 0)}
    assert leaks.leaks(df.limit(0), items).count() == leaks.leaks(df, items.limit(0)).count() == 0


def test_items_in_blocks(spark, monkeypatch):
    docs, items = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "eval_items")
    want = {tuple(r) for r in p6_found(spark, "/root/testdata/sf0.01").collect()}
    monkeypatch.setattr(leaks, "ITEMS_AT_ONCE", 100)
    assert {tuple(r)[:2] for r in leaks.leaks(docs, items).collect()} == want and want


def test_long_tags_and_tags_over_lines_leave_nothing():
    style = "; ".join(f"margin-{k}: {k}px" for k in range(12))
    for tag in (f'<span style="{style}">', '<a\n  href="x y z"\n  hidden>', f"<td class='{style}' nowrap data-a=b/>", "<br\n/>"):
        assert leaks.tokens(f"one {tag}two</span> three") == ["one", "two", "three"], tag
    prose = "one, two. " * 20
    assert len(leaks.tokens(f"a <b, {prose}> c")) == 43
    assert leaks.tokens("<a " * 50_000)[-1] == "a"


def test_long_passages_with_many_edits():
    """400 words with a change in every 13th are one passage of full length."""
    words = [f"w{k}x" for k in range(400)]
    changed = [w if k % 13 else "other" for k, w in enumerate(words)]
    (found,) = leaks.Searcher([(1, " ".join(words))]).find([" ".join(["so"] * 30 + changed[1:399] + ["so"] * 30)])
    assert found == [(1, 398, 30)]


def test_items_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(leaks, "ITEMS_AT_ONCE", 2)
    texts = [" ".join(f"{c}{k}y" for k in range(50)) for c in "abcde"]
    items = spark.createDataFrame([(k, t) for k, t in enumerate(texts)] + [(9, None)], "item_id long, text string")
    documents = spark.createDataFrame([(k, f"Before it. {t} After it.") for k, t in enumerate(texts)], "doc_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in leaks.leaks(documents, items).collect()) == [(k, k) for k in range(5)]
