"""Evaluation passages inside a corpus, found by Wu-Manber search over tokens.

Texts become tokens: words without case, accents, punctuation and tags, and single
characters where a run of text holds CJK letters. By the pigeonhole principle a passage of
``MIN_WORDS`` tokens with at most one edit in ten holds a run of ``RUN`` unchanged tokens,
so every run of that length in an item is a pattern. Wu-Manber finds them: a shift table on
the last two tokens skips impossible positions, a bucket per suffix pair selects patterns,
and direct comparison confirms. Each hit is then checked exactly: necessary counts of equal
token pairs on nearby diagonals first, then the furthest reach left and right for each
number of edits.

Defined results: null and empty texts hold nothing; an item shorter than the least passage
can't leak; copies of a document have their own rows; a document that holds an item twice
has one row for it, its longest passage (ties: fewer edits, then the earlier one).
"""

from __future__ import annotations

import re
import unicodedata
from array import array
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Least passage in words and in CJK characters, and the edits allowed among ten.
MIN_WORDS, MIN_CHARS, EDITS_IN_TEN = 40, 50, 1
#: Unchanged tokens that any such passage holds in a row.
RUN = 8
#: Items searched for at once; more are searched in further passes over the corpus.
ITEMS_AT_ONCE = 20_000

#: Short tags of any form; longer ones, also over lines, by a name and attributes; times.
_TAG = re.compile(
    r"""<[^<>\n]{0,80}>|</?[A-Za-z][\w:.-]*+(?:\s++[^\s"'<>/=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'<>=]++))?|\s*+/)*+\s*+>|\[\d\d?:\d\d\]"""
)
_CJK = re.compile(r"[぀-ヿ㐀-鿿가-힯]")
_SPLIT = re.compile(r"[\s|/\\_#*>~`=—–-]+")


class _Fold(dict):
    """Per code point: what is left of it; letters and digits folded, the rest dropped."""

    def __missing__(self, c: int) -> str:
        ch = chr(c)
        if _SPLIT.match(ch) or ch.isspace():
            out = " "
        else:
            out = "".join(x for x in unicodedata.normalize("NFKD", ch).casefold() if x.isalnum())
        self[c] = out
        return out


_FOLD = _Fold()


def tokens(text: str | None) -> list[str]:
    """The comparable tokens of a text."""
    if not text:
        return []
    if "<" in text or "[" in text:
        text = _TAG.sub(" ", text)
    words = text.translate(_FOLD).split()
    if not _CJK.search(text):
        return words
    wide = [bool(_CJK.search(w)) for w in words]
    out: list[str] = []
    for k, w in enumerate(words):
        if wide[k] or (k and wide[k - 1]) or (k + 1 < len(words) and wide[k + 1]):
            out += w
        else:
            out.append(w)
    return out


class WuManber:
    """Multi-pattern search over token ids; all patterns are ``RUN`` long, blocks are pairs."""

    def __init__(self, sequences: list[list[int]], size: int):
        self.size = size
        self.shift: dict[int, int] = {}
        self.buckets: dict[int, dict[tuple, list[tuple[int, int]]]] = defaultdict(dict)
        for item, seq in enumerate(sequences):
            for at in range(len(seq) - RUN + 1):
                pattern = tuple(seq[at : at + RUN])
                for k in range(RUN - 1):
                    block = pattern[k] * size + pattern[k + 1]
                    skip = RUN - 2 - k
                    if skip < self.shift.get(block, RUN - 1):
                        self.shift[block] = skip
                self.buckets[pattern[-2] * size + pattern[-1]].setdefault(pattern, []).append((item, at))

    def find(self, ids: list[int]) -> Iterator[tuple[int, list[tuple[int, int]]]]:
        """(position, [(item, position in the item)]) of every occurrence."""
        shift, buckets, size, most = self.shift.get, self.buckets, self.size, RUN - 1
        at, end = RUN - 1, len(ids)
        while at < end:
            block = ids[at - 1] * size + ids[at]
            skip = shift(block, most)
            if skip:
                at += skip
                continue
            begin = at - RUN + 1
            found = buckets[block].get(tuple(ids[begin : at + 1]))
            if found:
                yield begin, found
            at += 1


def _reach(doc: list[int], i: int, item: list[int], j: int, step: int, most: int) -> list[int]:
    """For k = 0..most edits: the furthest item tokens from (i, j) that end in a match."""
    best, out = {0: 0}, []
    n = len(doc) - i if step > 0 else i + 1
    m = len(item) - j if step > 0 else j + 1
    top = 0
    for k in range(most + 1):
        now: dict[int, int] = {}
        for d, x in best.items():
            # x item tokens consumed on diagonal d, x + d document tokens
            y = x + d
            start = x
            while x < m and y < n and item[j + step * x] == doc[i + step * y]:
                x, y = x + 1, y + 1
            now[d] = x
            if x > start and x > top:
                top = x
        out.append(top)
        nxt: dict[int, int] = {}
        for d, x in now.items():
            for dd, xx in ((d, x + 1), (d - 1, x + 1), (d + 1, x)):
                if xx <= m and 0 <= xx + dd <= n and nxt.get(dd, -1) < xx:
                    nxt[dd] = xx
        best = nxt
    return out


class Searcher:
    """Items prepared once; finds (item, passage length, edits) in token lists."""

    def __init__(self, items: list[tuple[int, str]]):
        words = [tokens(t) for _, t in items]
        vocabulary = {w: k + 1 for k, w in enumerate(dict.fromkeys(w for ws in words for w in ws))}
        self.vocabulary = vocabulary
        self.ids = [i for i, _ in items]
        self.items = [[vocabulary[w] for w in ws] for ws in words]
        wide = [sum(bool(_CJK.match(w)) for w in ws) * 3 > len(ws) for ws in words]
        self.least = np.array([MIN_CHARS if w else MIN_WORDS for w in wide] or [0])
        self.search = WuManber(self.items, len(vocabulary) + 1)
        self.edge = 2 * MIN_CHARS  # no passage needs to be longer than twice the least one
        self.most = self.edge * EDITS_IN_TEN // 10
        pad = [-1] * (self.edge + RUN)
        flat, self.starts = list(pad), []
        for seq in self.items:
            self.starts.append(len(flat))
            flat += seq + pad
        self.flat = np.array(flat + pad, np.int32)
        self.starts = np.array(self.starts or [0])

    def _plausible(self, flat: np.ndarray, at: np.ndarray, item: np.ndarray, j: np.ndarray) -> np.ndarray:
        """A necessary condition: enough equal neighbouring tokens on nearby diagonals.

        A passage of L tokens with e edits keeps L - 2e - 1 of its token pairs, each on a
        diagonal at most e from the run's; so in some stretch of the least length all but a
        fifth of twice the least length are kept.
        """
        span, most = self.edge, self.most
        keep = np.zeros(len(at), bool)
        docs = np.lib.stride_tricks.sliding_window_view(flat, 2 * span + 2 * most)
        items = np.lib.stride_tricks.sliding_window_view(self.flat, 2 * span)
        for k in range(0, len(at), 1000):
            a, it, jj = at[k : k + 1000], item[k : k + 1000], j[k : k + 1000]
            own = items[self.starts[it] + jj - span]
            text = docs[a - span - most]
            any_pair = np.zeros((len(a), 2 * span - 1), bool)
            for d in range(2 * most + 1):
                same = text[:, d : d + 2 * span] == own
                any_pair |= same[:, 1:] & same[:, :-1]
            sums = np.zeros((len(a), 2 * span), np.int16)
            np.cumsum(any_pair, axis=1, dtype=np.int16, out=sums[:, 1:])
            for least in (MIN_WORDS, MIN_CHARS):
                enough = (sums[:, least:] - sums[:, :-least]).max(axis=1) >= least - 2 * (2 * least // 10) + 2
                keep[k : k + 1000] |= enough & (self.least[it] == least)
        return keep

    def _passage(self, doc: list[int], i: int, item: int, j: int) -> tuple[int, int] | None:
        """The longest sound passage through the run at (i, j): (tokens, edits)."""
        seq = self.items[item]
        found = self._longest(doc, i, item, j, self.most)
        # where there is a passage of the least length a longer one may have more edits, up to
        # a tenth of the item
        most = len(seq) * EDITS_IN_TEN // 10 + 1
        return self._longest(doc, i, item, j, most) if found and most > self.most else found

    def _longest(self, doc: list[int], i: int, item: int, j: int, most: int) -> tuple[int, int] | None:
        seq, least = self.items[item], int(self.least[item])
        right = _reach(doc, i, seq, j, 1, most)
        left = _reach(doc, i - 1, seq, j - 1, -1, most)
        best = None
        for a, x in enumerate(left):
            for b, y in enumerate(right):
                if x + y >= least and 10 * (a + b) <= EDITS_IN_TEN * (x + y) and (best is None or (x + y, -a - b) > (best[0], -best[1])):
                    best = (x + y, a + b)
        return best

    def find(self, texts: list[str | None]) -> list[list[tuple[int, int, int]]]:
        """For each text its leaks: (item id, tokens, edits)."""
        known = self.vocabulary.get
        docs = [list(map(known, tokens(t), repeat(0))) for t in texts]
        pad = np.zeros(2 * self.edge + RUN, np.int32)
        parts, offset, where = [pad], len(pad), []
        hits: list[tuple[int, int, int, int]] = []
        for n, ids in enumerate(docs):
            where.append(offset)
            before = len(hits)
            for i, found in self.search.find(ids):
                hits += [(n, item, i - j, i) for item, j in found]
            if len(hits) > before:
                parts += [np.frombuffer(array("i", ids), np.int32), pad]
                offset += len(ids) + len(pad)
        out: list[list[tuple[int, int, int]]] = [[] for _ in docs]
        if not hits:
            return out
        h = np.array(hits, np.int64)
        h = h[np.lexsort((h[:, 3], h[:, 2], h[:, 1], h[:, 0]))]
        # the first hit stands for a run of hits on one diagonal
        first = np.ones(len(h), bool)
        first[1:] = (h[1:, :3] != h[:-1, :3]).any(axis=1) | (h[1:, 3] != h[:-1, 3] + 1)
        h = h[first]
        flat = np.concatenate(parts)
        h = h[self._plausible(flat, np.array(where)[h[:, 0]] + h[:, 3], h[:, 1], h[:, 3] - h[:, 2])]
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for n, item, diagonal, i in h.tolist():
            p = self._passage(docs[n], i, item, i - diagonal)
            if p and ((n, item) not in best or (p[0], -p[1]) > (best[n, item][0], -best[n, item][1])):
                best[n, item] = p
        for (n, item), p in best.items():
            out[n].append((self.ids[item], *p))
        return out


LEAKS = "doc_id bigint, item_id bigint, passage_tokens int, edits int"


@lru_cache(maxsize=2)
def _searcher(given) -> Searcher:
    """The searcher of a block of items, prepared once per worker and not per task."""
    return Searcher(given.value)


def _blocks(items: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items in order of their ids, ITEMS_AT_ONCE at a time; the driver holds one block."""
    rows = items.select("item_id", "text").filter("text is not null").orderBy("item_id")
    block: list[tuple[int, str]] = []
    for r in rows.toLocalIterator():
        block.append((r.item_id, r.text))
        if len(block) == ITEMS_AT_ONCE:
            yield block
            block = []
    if block:
        yield block


def leaks(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, passage_tokens, edits): every item a document repeats a passage of.

    The items are the stated query set; they are searched for in blocks, each block in one
    pass over the corpus without a shuffle.
    """
    context = documents.sparkSession.sparkContext

    def scan(block: list[tuple[int, str]]) -> DataFrame:
        given = context.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            searcher = _searcher(given)
            for batch in batches:
                for start in range(0, batch.num_rows, 128):
                    part = batch.slice(start, 128)
                    found = [(d, *x) for d, own in zip(part.column(0).to_pylist(), searcher.find(part.column(1).to_pylist())) for x in own]
                    columns = list(zip(*found)) if found else [[]] * 4
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))], ["doc_id", "item_id", "passage_tokens", "edits"])

        return documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).filter("text is not null").mapInArrow(run, LEAKS)

    scans = [scan(block) for block in _blocks(items)] or [scan([])]
    return reduce(DataFrame.unionAll, scans)
