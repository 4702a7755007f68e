"""One form for texts that look the same.

A value is normalised for compatibility (full-width forms, ligatures, radicals; not raised
or circled digits), ignorable characters are deleted, every space becomes a space and every
hyphen a hyphen. Each run of letters is then a lattice: a letter stands for all letters of
other scripts that look like it, and Viterbi finds the best path under character n-gram
scores of each script, where a change of script within the run costs much. The n-grams are
counted over all values. The lattice depends on the look alone, so two values come out in
one form exactly if they look the same.

Defined results: null stays null; '' and values of ignorable characters only become '';
letters keep case and accents, composed (NFC); very long values are read whole; repeated
rows have their own results; values without an image have no pairs.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Letters that look alike across scripts: Latin, Cyrillic, Greek (fixed values).
LOOKALIKES = (
    "AАΑ BВΒ CСϹ EЕΕ HНΗ IІΙ JЈͿ KКΚ MМΜ NΝ OОΟ PРΡ QԚ SЅ TТΤ VѴ WԜ XХΧ YҮΥ ZΖ "
    "aа cсϲ dԁ eе hһ iі jјϳ oоο pрρ qԛ sѕ vѵν wԝ xх yу lӏ ГΓ ПΠ ФΦ кκ"
).split()
#: Hyphens (fixed values).
HYPHENS = "‐‑⁃﹣－"
#: Compatibility mappings that keep the look.
_KEEPS_LOOK = ("<wide>", "<narrow>", "<noBreak>", "<font>", "<compat>", "<initial>", "<medial>", "<final>", "<isolated>")
#: Cost of changing the script within a run, in units of log probability.
SWITCH = 14.0

_CLASS = {c: group for group in LOOKALIKES for c in group}
_IGNORED = {0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0}


@lru_cache(maxsize=None)
def script(c: str) -> str:
    """'L', 'C' or 'G' for a letter of these scripts, else ''."""
    if not c.isalpha():
        return ""
    name = unicodedata.name(c, "")
    return {"LATIN": "L", "CYRILLIC": "C", "GREEK": "G"}.get(name.split(" ")[0], "")


class _Plain(dict):
    """Per code point: its plain, decomposed form."""

    def __missing__(self, code: int) -> str:
        self[code] = out = self._plain(chr(code))
        return out

    def _plain(self, c: str) -> str:
        kind = unicodedata.category(c)
        if kind == "Cf" or ord(c) in _IGNORED or 0xFE00 <= ord(c) <= 0xFE0F or 0xE0000 <= ord(c) <= 0xE0FFF or kind == "Cc" and not c.isspace():
            return ""
        if c.isspace() or kind == "Zs":
            return " "
        if c in HYPHENS:
            return "-"
        if c in _CLASS:
            return c
        parts = unicodedata.decomposition(c).split(" ")
        if parts[0] in _KEEPS_LOOK and not (len(parts) > 2 and parts[1] == "0020"):
            return "".join(self[int(x, 16)] for x in parts[1:])
        if parts[0] and parts[0][0] != "<":
            return "".join(self[int(x, 16)] for x in parts)
        return unicodedata.normalize("NFD", c)


_PLAIN = _Plain()


def plain(value: str) -> str:
    """Compatibility-normalised, without ignorable characters, decomposed."""
    return unicodedata.normalize("NFD", value.translate(_PLAIN))


def _runs(text: str) -> Iterator[tuple[bool, str]]:
    """Runs of letters of the three scripts with their marks, and what lies between."""
    start, inside = 0, False
    for k, c in enumerate(text):
        letter = bool(script(c)) or (inside and unicodedata.combining(c) > 0)
        if letter != inside:
            if k > start:
                yield inside, text[start:k]
            start, inside = k, letter
    if start < len(text):
        yield inside, text[start:]


def bigrams(value: str) -> Iterator[tuple[str, str, str]]:
    """(script, letter, next letter) of the runs of one script, ends marked by '^' and '$'."""
    for letters, run in _runs(plain(value)):
        if letters:
            base = [c for c in run if not unicodedata.combining(c)]
            scripts = {script(c) for c in base}
            if len(scripts) == 1:
                (s,) = scripts
                for a, b in zip(["^", *base], [*base, "$"]):
                    yield s, a, b


class Canon:
    """Brings values into one form under given bigram counts."""

    def __init__(self, counts: dict[tuple[str, str, str], int], remembered: int = 200_000):
        self.counts = counts
        self.before: Counter = Counter()
        for (s, a, _), n in counts.items():
            self.before["" if a == "^" else s, a] += n
        self.run = lru_cache(maxsize=remembered)(self._run)
        self.value = lru_cache(maxsize=remembered)(self._value)

    def _score(self, s: str, a: str, b: str) -> float:
        # a run's first letter chooses among all scripts, so rare scripts stay rare
        return math.log((self.counts.get((s, a, b), 0) + 0.02) / (self.before["" if a == "^" else s, a] + 3.0))

    def _run(self, run: str) -> str:
        """The best path through the run's lattice."""
        base = [c for c in run if not unicodedata.combining(c)]
        columns = [sorted(_CLASS.get(c, c), key=lambda x: "LCG".find(script(x))) for c in base]
        best = {("^", ""): (0.0, ())}
        paths: list[dict] = []
        for column in columns:
            now = {}
            for c in column:
                s = script(c)
                options = [(v + (self._score(s, a if p in ("", s) else "^", c) - (SWITCH if p not in ("", s) else 0.0)), (a, p)) for (a, p), (v, _) in best.items()]
                score, back = max(options, key=lambda o: o[0])
                now[c, s] = (score, back)
            paths.append(now)
            best = now
        end = max(best, key=lambda k: best[k][0] + self._score(k[1], k[0], "$"))
        letters = []
        for now in reversed(paths):
            letters.append(end[0])
            end = now[end][1]
        letters.reverse()
        out, k = [], 0
        for c in run:
            if unicodedata.combining(c):
                out.append(c)
            else:
                out.append(letters[k])
                k += 1
        return "".join(out)

    def _value(self, value: str) -> str:
        return unicodedata.normalize("NFC", "".join(self.run(r) if letters else r for letters, r in _runs(plain(value))))

    def __call__(self, value: str | None) -> str | None:
        if value is None:
            return None
        return self.value(value) if len(value) < 500 else self._value(value)


def fit(*columns: DataFrame) -> dict[tuple[str, str, str], int]:
    """Bigram counts over all values of the given one-column data.

    Each batch counts first; what is gathered are letter pairs within a script, a number
    bounded by the square of an alphabet, however many values there are.
    """
    values = columns[0]
    for other in columns[1:]:
        values = values.unionAll(other)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for value, n in Counter(batch.column(0).to_pylist()).items():
                if value:
                    for gram in bigrams(value):
                        total[gram] += n
        keys = list(total)
        yield pa.RecordBatch.from_arrays([*(pa.array([k[j] for k in keys], pa.string()) for j in range(3)), pa.array([total[k] for k in keys], pa.int64())], ["s", "a", "b", "n"])

    counted = values.mapInArrow(run, "s string, a string, b string, n bigint").groupBy("s", "a", "b").agg(F.sum("n").alias("n"))
    return {(r.s, r.a, r.b): r.n for r in counted.collect()}


def canonical(values: DataFrame, column: str, counts: dict) -> DataFrame:
    """``values`` with ``canonical``, the one form of ``column``; any other columns are kept."""
    given = values.sparkSession.sparkContext.broadcast(counts)
    name = "canonical"
    while name in values.columns:
        name += "_"
    at = values.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        canon = Canon(given.value)
        for batch in batches:
            out = pa.array([canon(v) for v in batch.column(at).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, out], [*batch.schema.names, name])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in values.schema.fields) + f", `{name}` string"
    return values.mapInArrow(run, schema)


def alike(values: DataFrame) -> DataFrame:
    """(field, id_a, pos_a, id_b, pos_b): values of one field and image that look the same
    but differ. ``values``: field, image_id, id, pos, value, canonical.

    The result is pairs by definition; only groups with two different strings reach the
    join, whose hot groups the adaptive skew handling splits.
    """
    kept = values.filter("image_id is not null and canonical != ''").select("field", "image_id", "canonical", "value", "id", "pos")
    key = ["field", "image_id", "canonical"]
    mixed = kept.groupBy(*key).agg(F.min("value").alias("lo"), F.max("value").alias("hi")).filter("lo < hi").select(*key)
    rows = kept.join(mixed, key)
    a, b = (rows.select(*key, F.col("value").alias("v" + x), F.col("id").alias("id_" + x), F.col("pos").alias("pos_" + x)) for x in "ab")
    first: Column = (F.col("id_a") < F.col("id_b")) | ((F.col("id_a") == F.col("id_b")) & (F.col("pos_a") < F.col("pos_b")))
    return a.join(b, key).filter(first & (F.col("va") != F.col("vb"))).select("field", "id_a", "pos_a", "id_b", "pos_b")
