"""Evaluation texts that leaked into training text (problem 9).

The n-grams of the normalised test items are one hash set, which every task holds; the windows of
the training tokens are looked up in it, and items that are hit often enough are verified by
aligning the item with the text. The set is broadcast for a block of items of a bounded number of
words at a time, so a test set beyond that means more passes, never a larger broadcast.

An item leaks if one or two stretches of it, in its order, hold at least half of its words with at
most one word in twelve altered; a stretch holds RUN words in a row. The longest run of words that
such a case leaves intact, and the words that whole n-grams then cover, follow from these numbers
by the length of the item; so does the length of its n-grams (five words of items of 27 words or
more, four of 13, three of five), and the search loses no case: a second stretch without a whole
n-gram is looked for in all of the text.

Defined results: null and empty texts hold no leak; an item of fewer than WHOLE words leaks only
as a whole, all its words in a row; repeated documents each give rows; Han characters count as
words; offsets are characters of the raw text, also where lower case or entities change its length.
"""

from __future__ import annotations

import html
import math
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of a looked-up n-gram at most; shorter items have shorter ones.
NGRAM = 5
#: Words in a row that a stretch holds.
RUN = 3
#: Items of fewer words leak only as a whole.
WHOLE = 5
#: Share of an item's words that must stand in the text, and words of which one may be altered.
SHARE, ALTERED = 0.5, 12
#: Words of the items that are broadcast at a time: about 60 bytes each.
BLOCK_WORDS = 1_000_000
#: Words that an alteration may span at most, in the item and in the text.
GAP = 6
#: Words before and behind an equal stretch in which shorter ones are looked for.
ENDS = 2 * GAP

_TOKEN = re.compile(r"[㐀-鿿豈-﫿]|[^\W_㐀-鿿豈-﫿]+")
# What normalising takes out of a text: tags and comments, and entities, with their semicolon or without.
_MARKUP = re.compile(r"</?[A-Za-z][^<>]*>|<!--.*?-->|&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]{1,31};?)", re.S)


def _plain(m: re.Match) -> str:
    return " " if m[0][0] == "<" else html.unescape(m[0])


def normalise(text: str) -> str:
    """Tags as spaces, entities decoded, lower case."""
    if "<" in text or "&" in text:
        text = _MARKUP.sub(_plain, text)
    return text.lower()


def tokens(text: str) -> list[str]:
    return _TOKEN.findall(normalise(text))


def places(text: str) -> list[tuple[int, int]]:
    """Where in the raw text each token of ``tokens`` stands: the same steps, with the origin of every character."""
    origin: list[tuple[int, int]] = []
    at = 0
    for m in _MARKUP.finditer(text):
        origin += [(k, k + 1) for k in range(at, m.start())]
        origin += [m.span()] * len(_plain(m))
        at = m.end()
    origin += [(k, k + 1) for k in range(at, len(text))]
    raw = _MARKUP.sub(_plain, text)
    low = raw.lower()
    if len(low) != len(raw):
        origin = [o for o, c in zip(origin, raw, strict=True) for _ in c.lower()]
    return [(origin[m.start()][0], origin[m.end() - 1][1]) for m in _TOKEN.finditer(low)]


class Need(NamedTuple):
    """Of an item: words that must be covered, words of its n-grams, words that whole n-grams cover at least."""

    words: int
    gram: int
    hits: int


@cache
def need(n: int) -> Need:
    """What a leak of an item of n words is, and what the least favourable one leaves of its n-grams.

    Of c covered words, c // ALTERED are altered; with the gap between the two stretches, if there can
    be two, these part what is left into runs, of which one is as long as their mean.
    """
    if n < WHOLE:
        return Need(n, n, n)
    least = math.ceil(SHARE * n)
    for gram in range(NGRAM, 0, -1):
        cases = [(c - c // ALTERED, c // ALTERED + (2 if c >= 2 * RUN else 1)) for c in range(least, n + 1)]
        if all(left > runs * (gram - 1) for left, runs in cases):
            break
    return Need(least, gram, max(gram, min(left - runs * (gram - 1) for left, runs in cases)))


_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xBF58476D1CE4E5B9)]


def _grams(ids: np.ndarray, size: int) -> np.ndarray:
    """Hash of the n-gram of ``size`` words that starts at each word."""
    n = len(ids) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, size, np.uint64)
    for i in range(size):
        h = (h ^ ids[i : i + n]) * _MIX[i % len(_MIX)]
        h ^= h >> np.uint64(29)
    return h


class Index:
    """The n-grams of a block of items."""

    BITS = 22

    def __init__(self, items: list[tuple[int, list[str]]]):
        self.vocabulary: dict[str, int] = {}
        for _, words in items:
            for x in words:
                self.vocabulary.setdefault(x, len(self.vocabulary) + 1)
        self.items = [(i, np.array([self.vocabulary[x] for x in words], np.uint64)) for i, words in items if words]
        #: By size of n-gram: hashes in order, with item (by its place in the block) and word.
        self.sorted: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        #: By size: which leading bits of a hash occur.
        self.bits: dict[int, np.ndarray] = {}
        parts: dict[int, list] = defaultdict(list)
        for k, (_, ids) in enumerate(self.items):
            size = need(len(ids)).gram
            grams = _grams(ids, size)
            parts[size].append((grams, np.full(len(grams), k, np.int32), np.arange(len(grams), dtype=np.int32)))
        for size, found in parts.items():
            grams, item, word = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.argsort(grams, kind="stable")
            self.sorted[size] = grams[order], item[order], word[order]
            self.bits[size] = np.zeros(1 << self.BITS, bool)
            self.bits[size][grams >> np.uint64(64 - self.BITS)] = True

    def leaks(self, ids: np.ndarray) -> dict[int, list[tuple[int, int]]]:
        """The items that leaked into a text, each with its stretches (first and last word but one of the text)."""
        hits: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for size, (known, item, word) in self.sorted.items():
            grams = _grams(ids, size)
            at = np.flatnonzero(self.bits[size][grams >> np.uint64(64 - self.BITS)])
            if not len(at):
                continue
            low, high = np.searchsorted(known, grams[at], "left"), np.searchsorted(known, grams[at], "right")
            for p, a, z in zip(at.tolist(), low.tolist(), high.tolist(), strict=True):
                for k in range(a, z):
                    hits[int(item[k])].append((p, int(word[k])))
        found = {}
        for k, pairs in hits.items():
            name, words = self.items[k]
            wanted = need(len(words))
            if len({q + d for q in {q for _, q in pairs} for d in range(wanted.gram)}) < wanted.hits:
                continue
            if spans := aligned(words, ids, [p for p, _ in pairs]):
                found[name] = spans
        return found


def _distance(a: np.ndarray, b: np.ndarray) -> int:
    """Words to add, drop or change between two short stretches."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a.tolist(), 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b.tolist(), 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def _blocks(item: np.ndarray, text: np.ndarray, hits: list[int] | None) -> list[tuple[int, int, int]]:
    """(place in the item, place in the text, words) of equal stretches near the hits, or in all of the text."""
    n = len(item)
    windows: list[list[int]] = [[0, len(text)]] if hits is None else []
    for p in sorted(set(hits or ())):
        a, z = max(0, p - n), min(len(text), p + n)
        if windows and a <= windows[-1][1]:
            windows[-1][1] = z
        else:
            windows.append([a, z])
    place: dict[int, np.ndarray] = {}
    sort = np.argsort(item, kind="stable")
    keys = item[sort]
    blocks = []
    for a, z in windows:
        part = text[a:z]
        lo, hi = np.searchsorted(keys, part, "left"), np.searchsorted(keys, part, "right")
        many = hi - lo
        if not many.any():
            continue
        j = np.repeat(np.arange(len(part)), many)
        i = sort[np.repeat(lo, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)]
        # Runs along a diagonal.
        order = np.lexsort((j, j - i))
        i, j = i[order], j[order]
        new = np.ones(len(i), bool)
        new[1:] = (np.diff(i) != 1) | (np.diff(j) != 1)
        start = np.flatnonzero(new)
        length = np.diff(np.append(start, len(i)))
        keep = length >= RUN
        blocks += zip(i[start[keep]].tolist(), (j[start[keep]] + a).tolist(), length[keep].tolist(), strict=True)
    return sorted(_with_ends(blocks, item, text), key=lambda b: (b[1], b[0]))


def _with_ends(blocks: list[tuple[int, int, int]], item: np.ndarray, text: np.ndarray) -> set[tuple[int, int, int]]:
    """Also the shorter equal stretches just before and behind each block, where a word was altered near an end."""
    out = set(blocks)
    n, m = len(item), len(text)
    for i, j, size in blocks:
        for moved in (-1, 0, 1):
            for a, b in ((i - ENDS, j - ENDS + moved), (i + size, j + size + moved)):
                k = 0
                while k < ENDS:
                    run = 0
                    while k + run < ENDS and 0 <= a + k + run < n and 0 <= b + k + run < m and item[a + k + run] == text[b + k + run]:
                        run += 1
                    if run:
                        out.add((a + k, b + k, run))
                    k += run + 1
    return out


def aligned(item: np.ndarray, text: np.ndarray, hits: list[int]) -> list[tuple[int, int]]:
    """The one or two stretches of the text that make the item a leak; none if it is none.

    Equal blocks are chained in order; a step over at most GAP words costs the words altered in
    between, one longer step opens the second stretch. Of all chains with equal cost the one that
    covers most is kept at each block. Only if the blocks near the hits are too few, all blocks count.
    """
    n = len(item)
    wanted = need(n)
    if n < WHOLE:
        at = next((p for p in sorted(set(hits)) if np.array_equal(text[p : p + n], item)), None)
        return [] if at is None else [(at, at + n)]
    return _chained(_blocks(item, text, hits), item, text, wanted) or _chained(_blocks(item, text, None), item, text, wanted)


def _chained(blocks: list[tuple[int, int, int]], item: np.ndarray, text: np.ndarray, wanted: Need) -> list[tuple[int, int]]:
    n = len(item)
    most = n // ALTERED
    # best[k][(stretch 0 or 1, whether it holds RUN words in a row, altered)] = (covered words, spans)
    best: list[dict[tuple[int, bool, int], tuple[int, tuple]]] = []
    done: list[tuple[int, int, int, int, tuple]] = []  # ends of first stretches: item end, text end, altered, covered, spans
    ends = [(i + m, j + m) for i, j, m in blocks]
    winner: tuple[int, tuple] | None = None
    for k, (i, j, m) in enumerate(blocks):
        state: dict[tuple[int, bool, int], tuple[int, tuple]] = {(0, m >= RUN, 0): (m, ((j, j + m),))}

        def put(key: tuple[int, bool, int], covered: int, spans: tuple, state=state) -> None:
            if key[2] <= most and (key not in state or state[key][0] < covered):
                state[key] = (covered, spans)

        for h in range(k - 1, -1, -1):
            ie, je = ends[h]
            if je < j - GAP - n:
                break
            gi, gj = i - ie, j - je
            cut = max(0, -gi, -gj)
            if cut >= m or gi + cut > GAP or gj + cut > GAP or blocks[h][0] >= i or blocks[h][1] >= j:
                continue
            cost = _distance(item[ie : i + cut], text[je : j + cut])
            for (second, whole, altered), (covered, spans) in best[h].items():
                put((second, whole or m - cut >= RUN, altered + cost), covered + gi + m, (*spans[:-1], (spans[-1][0], j + m)))
        for ie, je, altered, covered, spans in done:
            if je <= j and ie - i < m:
                over = max(0, ie - i)
                put((1, m - over >= RUN, altered), covered + m - over, (*spans, (j + over, j + m)))
        best.append(state)
        for (second, whole, altered), (covered, spans) in state.items():
            if not whole:
                continue
            if covered >= wanted.words and altered * ALTERED <= covered and (winner is None or covered > winner[0]):
                winner = (covered, spans)
            if not second:
                done.append((i + m, j + m, altered, covered, spans))
        if len(done) > 64:  # of ends that another one dominates only the other can be part of a best chain
            done = _undominated(done)
    return list(winner[1]) if winner else []


def _undominated(done: list) -> list:
    """Without those that end later in item and text, cost more and cover less than another."""
    kept: list = []
    for d in sorted(done, key=lambda d: (-d[3], d[2], d[0], d[1])):
        if not any(k[0] <= d[0] and k[1] <= d[1] and k[2] <= d[2] and k[3] >= d[3] for k in kept):
            kept.append(d)
    return kept


def _blocks_of(items: DataFrame) -> Iterator[Index]:
    """The test set, a block of a bounded number of words at a time."""
    rows = items.where("item_id is not null and text is not null").select(F.col("item_id").cast("long"), "text").orderBy("item_id").toLocalIterator()
    block: list[tuple[int, list[str]]] = []
    n = 0
    for r in rows:
        words = tokens(r[1])
        if block and n + len(words) > BLOCK_WORDS:
            yield Index(block)
            block, n = [], 0
        block.append((r[0], words))
        n += len(words)
    yield Index(block)


def leaks(documents: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, spans (first and last character but one in the text) of every leak."""
    whole: DataFrame | None = None
    for index in _blocks_of(items):
        shared = documents.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            index = shared.value
            get = index.vocabulary.get
            for b in batches:
                rows = []
                for doc_id, text in zip(b["doc_id"], b["text"], strict=True):
                    words = tokens(text)
                    ids = np.fromiter((get(w, 0) for w in words), np.uint64, len(words))
                    found = index.leaks(ids)
                    if found:
                        place = places(text)
                        rows += [(doc_id, item, [{"first": place[a][0], "last": place[z - 1][1]} for a, z in spans]) for item, spans in found.items()]
                yield pd.DataFrame(rows, columns=["doc_id", "item_id", "spans"])

        part = documents.where(F.length("text") > 0).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(run, "doc_id long, item_id long, spans array<struct<first:int,last:int>>")
        whole = part if whole is None else whole.unionByName(part)
    return whole


def cleaned(documents: DataFrame, items: DataFrame, drop_share: float = 0.5) -> DataFrame:
    """doc_id, text, n_items: the documents without leaked spans; those that are mostly leaks are left out.

    Other columns are not carried along.
    """
    found = leaks(documents, items).groupBy("doc_id").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.count_distinct("item_id").alias("n_items"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc_id, text, spans, n in zip(b["doc_id"], b["text"], b["spans"], b["n_items"], strict=True):
                if spans is not None and len(spans):
                    out, at = [], 0
                    for s in sorted(spans, key=lambda s: s["first"]):
                        if s["last"] > at:
                            out.append(text[at : max(at, s["first"])])
                            at = s["last"]
                    kept = "".join([*out, text[at:]])
                    if len(kept) < (1 - drop_share) * len(text):
                        continue
                    text = kept
                rows.append((doc_id, text, int(n) if n == n and n is not None else 0))
            yield pd.DataFrame(rows, columns=["doc_id", "text", "n_items"])

    # A document's leaks are at most as many as the test set has items.
    joined = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(found, "doc_id", "left")
    return joined.mapInPandas(run, "doc_id long, text string, n_items long")
