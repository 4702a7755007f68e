import random
import unicodedata

import pytest

from concordance.llm import lookalike as lk
from concordance.llm.queries import p5_found
from concordance.session import table

SF = "/root/testdata/sf0.01"
WORDS = ["Final stamp", "Déjà signé", "Готово", "Нет данных", "Petición recibida", "Contrôle terminé", "Prüfung läuft", "人工复核", "On-hold", "Start", "Вася", "Office flow 12", "Νέα"]


@pytest.fixture(scope="module")
def canon():
    counts = {}
    for w in WORDS * 50:
        for g in lk.bigrams(w):
            counts[g] = counts.get(g, 0) + 1
    return lk.Canon(counts)


def disguised(word, rng):
    out = []
    for c in unicodedata.normalize("NFD", word):
        r = rng.random()
        if c in lk._CLASS and r < 0.4:
            c = rng.choice([x for x in lk._CLASS[c]])
        elif c == " ":
            c = rng.choice("    　")
        elif c == "-":
            c = rng.choice("-‐‑－")
        elif "!" <= c <= "~" and r > 0.8:
            c = chr(ord(c) + 0xFEE0)
        out.append(c)
        if rng.random() < 0.2:
            out.append(rng.choice("​‌‍⁠﻿­"))
    s = "".join(out)
    return unicodedata.normalize("NFC", s) if rng.random() < 0.5 else s


def test_disguises_come_back(canon):
    rng = random.Random(4)
    for _ in range(3000):
        w = rng.choice(WORDS)
        assert canon(disguised(w, rng)) == w


def test_what_differs_stays_different(canon):
    for a, b in (("No", "NO"), ("Deja", "Déjà"), ("O2", "02"), ("m²", "m2"), ("①", "1"), ("l", "I"), ("cl", "d"), ("a b", "ab"), ("Fin", "Fín")):
        assert canon(a) != canon(b), (a, b)
    for a, b in (("ﬁnal", "final"), ("⼈", "人"), ("Ｎｏ", "No"), ("ϲat", "cat"), ("а́", "á"), ("​", ""), ("x­y", "xy")):
        assert canon(a) == canon(b), (a, b)
    assert canon(None) is None and canon("") == "" and canon("Start " * 20_000) == "Start " * 20_000


def skeleton(value):
    """The look, letter by letter, without any search."""
    return unicodedata.normalize("NFC", "".join(lk._CLASS.get(c, c)[0] for c in lk.plain(value)))


def test_found_against_brute_force(spark):
    values = []
    for r in table(spark, SF, "ocr_regions").collect():
        values.append(("ocr_regions.text", r.image_id, r.region_id, 0, r.text))
    for r in table(spark, SF, "fused_nodes").collect():
        values += [("fused_nodes.text_votes", r.image_id, r.node_row_id, k, v) for k, v in enumerate(r.text_votes or [])]
    for r in table(spark, SF, "visual_graphs").collect():
        values += [("visual_graphs.edges.label", r.image_id, r.graph_id, k, e.label) for k, e in enumerate(r.edges or [])]
    groups = {}
    for f, image, i, p, v in values:
        if v and image is not None and skeleton(v):
            groups.setdefault((f, image, skeleton(v)), []).append((i, p, v))
    want = {(f, *a[:2], *b[:2]) for (f, _, _), own in groups.items() for a in own for b in own if a[:2] < b[:2] and a[2] != b[2]}
    got = [tuple(r) for r in p5_found(spark, SF).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 100


def test_edge_cases(spark):
    rows = [("f", "i", 1, 0, "Start"), ("f", "i", 1, 1, "Stаrt"), ("f", "i", 2, 0, "Start"), ("f", None, 3, 0, "Stаrt"), ("f", "i", 4, 0, "​"), ("f", "i", 5, 0, "﻿"), ("g", "i", 6, 0, "Stаrt"), ("f", "i", 7, 0, None)]
    df = spark.createDataFrame(rows, "field string, image_id string, id long, pos int, value string").selectExpr("*", "array(1.5) as extra")
    counts = lk.fit(df.select("value"))
    out = lk.canonical(df, "value", counts)
    assert sorted(tuple(r) for r in lk.alike(out).collect()) == [("f", 1, 0, 1, 1), ("f", 1, 1, 2, 0)]
    assert out.columns[-2:] == ["extra", "canonical"]
    assert lk.canonical(df.withColumnRenamed("extra", "canonical"), "value", counts).columns[-1] == "canonical_"
    assert lk.alike(lk.canonical(df.limit(0), "value", lk.fit(df.limit(0).select("value")))).count() == 0
