"""Languages of documents and of their single-language stretches.

Language-bitmask n-gram filters: one Bloom filter per language, stored bit-sliced, so one
look-up returns the languages of an n-gram as a bit mask. A sentence's popcounts per
language, corrected for the filter's false positives, decide; neighbouring sentences of
one language form a stretch.

The filters are fitted on a bounded sample of labelled documents (``PER_LANGUAGE`` for each
language, the first in order of a hash of the document id). Labels are noisy, so an n-gram
belongs to a language only if its share of documents there is a good part of the largest.

A document none of whose sentences is sure alone, say one of short sentences, is judged by
all of them together.

Defined results: null or empty text, or text of headings, tables, code and quotations only,
has no stretches and no language; a repeated document has its own rows; ties go to the
language that comes first in ``LANGUAGES``; texts are read whole, however long.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LANGUAGES = ("en", "de", "fr", "es", "it", "ru", "zh")
#: The sample for fitting: documents per language, none longer than MAX_CHARS.
PER_LANGUAGE, MAX_CHARS = 400, 16_000
GRAMS, HASHES, BITS = (2, 4), 2, 21
#: Share of the most common language's document share from which an n-gram counts.
KEEP = 0.2
#: The lead that a sentence needs for its language; one of fewer letters than MIN_LETTERS (CJK
#: letters count double) needs an end mark, and a larger lead in proportion.
MIN_LETTERS, MIN_LEAD = 16, 0.12
#: Documents over the sample's size that its hash threshold lets through.
SPARE = 1.5

#: Spellings of each language's code and name (fixed values).
SPELLINGS = {
    "en": "en eng english anglais englisch",
    "de": "de deu ger german deutsch allemand",
    "fr": "fr fra fre french français francais französisch",
    "es": "es spa spanish español espanol castellano",
    "it": "it ita italian italiano",
    "ru": "ru rus russian русский",
    "zh": "zh zho chi cmn chinese mandarin 中文 汉语 漢語",
}


def label_code(label: Column) -> Column:
    """The ISO 639-1 code a label names, in any spelling; null if it names none of them."""
    head = F.element_at(F.split(F.lower(F.trim(label)), r"[-_ (]"), 1)
    table = F.create_map(*(F.lit(x) for code, names in SPELLINGS.items() for name in names.split() for x in (name, code)))
    return F.try_element_at(table, head)


_FENCE = re.compile(r"```.*?(?:```|\Z)|~~~.*?(?:~~~|\Z)", re.S)
_LINE = re.compile(r"^[ \t]*(?:#+[ \t].*|\|.*|[-=_*]{3,}[ \t]*)$", re.M)
_QUOTE = re.compile(r'"[^"\n]*"|“[^”\n]*”|«[^»\n]*»|„[^“”\n]*[“”]|「[^」\n]*」|《[^》\n]*》')
_MARK = re.compile(r"</?[A-Za-z][^<>]*>|<[^<>\n]{1,80}>|`[^`\n]*`|https?://\S+|^[ \t]*(?:>|[-*+]|\d+[.)])[ \t]+|\[\d\d?:\d\d\]", re.M)
_END = re.compile(r"(?<=[.!?…])\s+|(?<=[。！？])|\n+")
#: The end of a whole sentence.
_WHOLE = re.compile(r"[.!?…。！？]['\"’”»)]*\s*\Z")
_LETTER = re.compile(r"[^\W\d_]")
_WIDE = re.compile(r"[぀-ヿ㐀-鿿가-힯]")


def _blank(m: re.Match) -> str:
    return re.sub(r"[^\n]", " ", m.group())


def sentences(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, text) of the sentences; headings, tables, code and quotations are blanked."""
    if not text:
        return []
    if "```" in text or "~~~" in text:
        text = _FENCE.sub(_blank, text)
    text = _MARK.sub(_blank, _QUOTE.sub(_blank, _LINE.sub(_blank, text)))
    out, at = [], 0
    for m in _END.finditer(text):
        if m.start() > at:
            out.append((at, m.start(), text[at : m.start()]))
        at = m.end()
    if at < len(text):
        out.append((at, len(text), text[at:]))
    return out


def _letters(s: str) -> int:
    return len(_LETTER.findall(s)) + len(_WIDE.findall(s))


_PAD = "   "


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one array of code points with padding between, and where each begins."""
    folded = [t.casefold() for t in texts]
    starts = np.cumsum([0] + [len(t) + len(_PAD) for t in folded[:-1]]) if folded else np.zeros(0, int)
    return np.frombuffer((_PAD.join(folded) + _PAD).encode("utf-32-le"), np.uint32), starts


def _hashed(codes: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of the n-gram at each position."""
    m = max(0, len(codes) - n + 1)
    h = np.full(m, n, np.uint64)
    for k in range(n):
        h = (h ^ codes[k : k + m]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def _slots(h: np.ndarray) -> list[np.ndarray]:
    mask = np.uint64((1 << BITS) - 1)
    return [(h >> np.uint64(k * BITS)) & mask for k in range(HASHES)]


class Filters:
    """Bit-sliced Bloom filters: bit l of a cell belongs to language l."""

    def __init__(self, cells: np.ndarray):
        self.cells = cells
        fill = np.array([((cells >> cells.dtype.type(k)) & 1).mean() for k in range(len(LANGUAGES))])
        self.false = fill**HASHES

    @classmethod
    def fit(cls, labelled: list[tuple[str, str]]) -> Filters:
        """From (language, text) pairs; each n-gram counts once per document."""
        grams: list[list[np.ndarray]] = [[] for _ in LANGUAGES]
        for lang, text in labelled:
            parts = [s for _, _, s in sentences(text) if _letters(s) >= MIN_LETTERS]
            if parts and lang in LANGUAGES:
                codes, _ = _codes(parts)
                grams[LANGUAGES.index(lang)].append(np.unique(np.concatenate([_hashed(codes, n) for n in GRAMS])))
        every = [np.unique(np.concatenate(g), return_counts=True) if g else (np.zeros(0, np.uint64), np.zeros(0, int)) for g in grams]
        keys = np.unique(np.concatenate([k for k, _ in every]))
        share = np.zeros((len(LANGUAGES), len(keys)))
        for k, (own, count) in enumerate(every):
            share[k, np.searchsorted(keys, own)] = np.where(count > 1, count, 0) / max(1, len(grams[k]))
        kind = np.min_scalar_type((1 << len(LANGUAGES)) - 1)  # a bit for each language
        cells = np.zeros(1 << BITS, kind)
        top = share.max(axis=0)
        for k in range(len(LANGUAGES)):
            for slot in _slots(keys[(share[k] > 0) & (share[k] >= KEEP * top)]):
                cells[slot] |= kind.type(1 << k)
        return cls(cells)

    def scores(self, texts: list[str]) -> np.ndarray:
        """For each text and language the share of n-grams found, without false positives."""
        if not texts:
            return np.zeros((0, len(LANGUAGES)))
        codes, starts = _codes(texts)
        total = np.diff(np.append(starts, len(codes)))
        hits = np.zeros((len(texts), len(LANGUAGES)))
        for n in GRAMS:
            first, *rest = _slots(_hashed(codes, n))
            found = self.cells[first]
            for slot in rest:
                found &= self.cells[slot]
            for k in range(len(LANGUAGES)):
                hits[:, k] += np.add.reduceat((found >> found.dtype.type(k)) & found.dtype.type(1), np.minimum(starts, len(found) - 1), dtype=np.int32)
        share = hits / (len(GRAMS) * total[:, None])
        return np.maximum(0, (share - self.false) / np.maximum(1e-9, 1 - self.false))


def fit(documents: DataFrame) -> Filters:
    """Filters fitted on the bounded sample of labelled documents.

    A threshold on a hash of the id, set by each language's number of documents, lets a few
    more through than the sample needs, and only these leave their tasks.
    """
    coded = documents.select("doc_id", "text", label_code(F.col("lang")).alias("code")).filter(F.col("code").isNotNull())
    counts = {r.code: r.n for r in coded.groupBy("code").agg(F.count("*").alias("n")).collect()}
    most = 1 << 31
    place = F.pmod(F.xxhash64("doc_id"), F.lit(most))
    found: dict[str, list[tuple]] = {}
    share = {code: SPARE * PER_LANGUAGE / n for code, n in counts.items()}
    while share:
        # languages with too few of a fit length get a larger threshold and another pass
        wanted = F.coalesce(*(F.when(F.col("code") == code, F.lit(int(min(1, x) * most))) for code, x in share.items()))
        rows = coded.filter(F.col("code").isin(*share) & (place < wanted) & F.length("text").between(1, MAX_CHARS)).select("code", "doc_id", "text", place.alias("place"))
        for code in share:
            found[code] = []
        # about SPARE * PER_LANGUAGE rows a language
        for r in rows.collect():
            found[r.code].append((r.place, r.doc_id, r.text))
        share = {code: 4 * x for code, x in share.items() if x < 1 and len(found[code]) < PER_LANGUAGE}
    return Filters.fit([(code, text) for code in sorted(found) for _, _, text in sorted(found[code])[:PER_LANGUAGE]])


def _stretches(filters: Filters, texts: list[str | None]) -> list[list[tuple]]:
    """For each text its stretches: (start, end, language index, confidence, sentences)."""
    cut = [[(*s, n) for s in sentences(t) if (n := _letters(s[2])) >= MIN_LETTERS or n and _WHOLE.search(s[2])] for t in texts]
    order, best, second = _ranked(filters.scores([s[2] for own in cut for s in own]))
    letters = np.array([s[3] for own in cut for s in own])
    lead = np.where(best > 0, (best - second) / np.maximum(best, 1e-9), 0)
    sure = (best > 0) & (lead >= MIN_LEAD * np.maximum(1, MIN_LETTERS / np.maximum(letters, 1)))
    confidence = _confidence(best, second)
    out, at, open_ = [], 0, []
    for own in cut:
        merged: list[tuple] = []
        for start, end, _, _ in own:
            lang, c, told = int(order[at]), float(confidence[at]), sure[at]
            at += 1
            if not told:
                continue
            if merged and merged[-1][2] == lang:
                p = merged[-1]
                merged[-1] = (p[0], end, lang, (p[3] * p[4] + c) / (p[4] + 1), p[4] + 1)
            else:
                merged.append((start, end, lang, c, 1))
        if own and not merged:
            open_.append(len(out))
        out.append(merged)
    if open_:
        order, best, second = _ranked(filters.scores([" ".join(s[2] for s in cut[k]) for k in open_]))
        confidence = _confidence(best, second)
        for n, k in enumerate(open_):
            if best[n] > second[n]:
                out[k] = [(cut[k][0][0], cut[k][-1][1], int(order[n]), float(confidence[n]), len(cut[k]))]
    return out


def _ranked(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best language of each row, its score and the second one's."""
    order = np.argsort(-scores, axis=1, kind="stable")[:, :2] if len(scores) else np.zeros((0, 2), int)
    rows = np.arange(len(scores))
    return order[:, 0], scores[rows, order[:, 0]], scores[rows, order[:, 1]]


def _confidence(best: np.ndarray, second: np.ndarray) -> np.ndarray:
    return best * best / np.maximum(1e-9, best * best + second * second)


SEGMENTS = "array<struct<start:int,end:int,lang:string,confidence:double,sentences:int>>"
_SEGMENT_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string()), ("confidence", pa.float64()), ("sentences", pa.int32())]))


def stretches(documents: DataFrame, filters: Filters) -> DataFrame:
    """(doc_id, label, segments): each document's single-language stretches in order.

    A document never leaves its row, so there is no shuffle; the filters are a fixed 2 MB.
    """
    cells = documents.sparkSession.sparkContext.broadcast(filters.cells)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Filters(cells.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                found = [[dict(start=a, end=b, lang=LANGUAGES[k], confidence=round(c, 4), sentences=n) for a, b, k, c, n in s] for s in _stretches(own, part.column(2).to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(found, _SEGMENT_TYPE)], ["doc_id", "label", "segments"])

    narrow = documents.select("doc_id", label_code(F.col("lang")).alias("label"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, f"doc_id bigint, label string, segments {SEGMENTS}")


def languages(cut: DataFrame) -> DataFrame:
    """One row per document and language: sentences, their share and a confidence."""
    codes = F.array_distinct(F.transform("segments", lambda s: s["lang"]))
    each = cut.select("doc_id", "label", "segments", F.explode(codes).alias("lang"))
    own = F.filter("segments", lambda s: s["lang"] == F.col("lang"))
    count = F.aggregate(own, F.lit(0), lambda a, s: a + s["sentences"])
    weight = F.aggregate(own, F.lit(0.0), lambda a, s: a + s["sentences"] * s["confidence"])
    every = F.aggregate("segments", F.lit(0), lambda a, s: a + s["sentences"])
    return each.select("doc_id", "label", "lang", count.alias("sentences"), (count / every).alias("share"), (weight / count).alias("confidence"))


def mislabelled(cut: DataFrame) -> DataFrame:
    """(doc_id, lang) of documents with no, a wrong, or not the only language label."""
    codes = F.array_distinct(F.transform("segments", lambda s: s["lang"]))
    held = cut.select("doc_id", "label", codes.alias("codes"))
    wrong = F.col("label").isNull() | (F.size("codes") > 1) | ~F.array_contains("codes", F.col("label"))
    return held.filter(wrong).select("doc_id", F.explode("codes").alias("lang"))
