"""New batches against all history (problem 1).

What is known of the history lives in the shared folder as immutable parts, split by shards: the
keys of the records (id, page, words), and a suffix array over the concatenated words of their
summaries. A batch is a run. Its substrings are binary-searched in the suffix arrays of the runs
before it and in its own; the words of the matches are summed for every pair of records, those
covered most come first, and a pair is a repeat if its matches, extended to their longest, cover
all words but two. Arrays
of equal size are merged, so that there are as many as the logarithm of the runs. A task reads the
files of its own shard only: nothing of the history is shuffled, sorted again or written again but
by a merge. Several runs can be taken in by one call (`accept`), which then replays them one by one.

Which suffixes: two texts within two edits share one of three stretches: the first q words, the
last q words, or q words from word q on, there moved by at most one word (of texts of up to five
words: any word). So a text's array holds the suffixes at which a later text's substring can match;
all others can only match inside those, and are reached by extending. A substring routes to a
shard by its place and words; what a shard gets of a text is stored there once.

A substring that very many texts share is no place to meet: such texts meet by it and by a second
substring of what they have besides, and where that is shared by very many too, by a third.

Defined results: a null or blank summary, url or id agrees with nothing; of at most three words
only equal summaries agree, of four to six one word may differ; Han characters count as words,
marks inside words are no part of them; rows with equal ordinal are one row; links are followed on,
so the first row of an item is the smallest ordinal that can be reached; rows without
first_seen_at belong to the last run.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.text import is_blank, strip
from newsloom.functions.urls import params, unescape
from newsloom.operators.components import components
from newsloom.runtime import read_state, remove, scratch, small_side, write_state

#: Words that two summaries may differ by.
EDITS = 2
#: Words of a substring that is looked up, at most.
KEY_WORDS = 8
#: Substrings by which texts meet, at most: one, and as many more as are needed where it is hot.
LEVELS = 3
#: One text in so many is sampled for hot substrings; how often one must occur there; how many are found by one call at most.
SAMPLED, HOT, HOT_KEYS = 16, 32, 10_000
#: Calls by which a whole archive is taken in, and how many records a shard is laid out for.
CALLS, SHARD_RECORDS = 4, 20_000
#: Matches that a task holds at a time, but for those of one text.
MATCHES = 1_000_000

# Hosts of videos, and parameters that do not choose the page.
VIDEO_HOSTS = ("vids.example", "vid.example")
IDLE_PARAMS = "^(?:utm_.*|from|share|feature|t|ref|ref_src|source|spm|fbclid|gclid|igshid|mkt_tok|mc_cid|mc_eid|_hsenc|_hsmi|amp|output|list|index|si|pp)$"


def with_keys(rows: DataFrame) -> DataFrame:
    """run, ordinal, id_key, page_key, summary of (run, ordinal, id, url, summary); null where there is none.

    Page keys are equal for urls that name the same page or video. The steps are projections of
    their own, so that each value is computed once.
    """
    u = F.col("u")
    kept = ("run", "ordinal", "id", "summary")
    steps = rows.select(*kept, strip(F.col("url")).alias("u"))
    steps = steps.select(
        *kept,
        "u",
        F.lower(F.regexp_extract(u, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:(?:www|m|amp|mobile)\.)*([^/?#]*)", 1)).alias("host"),
        F.regexp_extract(u, r"^(?:(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//[^/?#]*)?([^?#]*)", 1).alias("path"),
        F.filter(params(u), lambda p: ~F.lower(F.substring_index(p, "=", 1)).rlike(IDLE_PARAMS)).alias("kept"),
    )
    steps = steps.select(*kept, "u", F.regexp_replace("host", ":(?:80|443)$", "").alias("host"), F.regexp_replace("path", r"(?:/amp|/index\.html?|\.amp|\.html?|/)+$", "").alias("path"), "kept")
    video = F.when(
        F.col("host").isin(*VIDEO_HOSTS),
        F.coalesce(
            F.nullif(F.regexp_extract(F.array_join("kept", "&"), r"(?:^|&)v=([^&]+)", 1), F.lit("")),
            F.nullif(F.regexp_extract("path", r"^/(?:(?:shorts|live|embed|v)/)?([^/]+)$", 1), F.lit("")),
        ),
    )
    page = F.concat_ws("\u0001", "host", unescape(F.col("path")), F.array_join(F.array_sort(F.transform("kept", unescape)), "&"))
    return steps.select(
        "run",
        "ordinal",
        F.nullif(strip(F.col("id")), F.lit("")).alias("id_key"),
        F.when(F.col("u") != "", F.coalesce(F.concat(F.lit("video\u0001"), video), page)).alias("page_key"),
        "summary",
    )


def _hashed(kind: int, key: str) -> list[Column]:
    """A key of 128 bits, zero where there is none."""
    there = F.col(key).isNotNull()
    return [F.when(there, h).otherwise(0).alias(f"{key}_{n}") for n, h in (("h1", F.xxhash64(F.lit(kind), key)), ("h2", F.xxhash64(key, F.lit(~kind))))]


# ---- words -------------------------------------------------------------------------------------


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of 64 bits of the words of all texts, and where each text starts (one more at the end)."""
    t = pc.fill_null(texts, "")
    t = pc.replace_substring_regex(pc.utf8_lower(t), r"[^\p{L}\p{N}\s\x{85}\p{Z}]+", "")
    t = pc.replace_substring_regex(t, r"(\p{Han})", r" \1 ")
    t = pc.utf8_split_whitespace(pc.utf8_trim_whitespace(t))
    lengths = pc.list_value_length(t).to_numpy(zero_copy_only=False).astype(np.int64)
    words = pc.list_flatten(t)
    empty = pc.equal(words, "").to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    coded = words.dictionary_encode()
    each = np.array([xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
    codes = each[coded.indices.to_numpy(zero_copy_only=False)] if len(each) else np.zeros(0, np.uint64)
    if empty.any():
        starts = np.concatenate([[0], np.cumsum(~empty)])[starts]
        codes = codes[~empty]
    return codes, starts


def _whole(hashes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A key of 128 bits of the words of each text in order; zero for a text without words."""
    n = np.diff(starts)
    place = (np.arange(len(hashes)) - np.repeat(starts[:-1], n)).astype(np.uint64)
    out = []
    for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mix(hashes + (place + np.uint64(1)) * np.uint64(c)))])
        out.append(np.where(n > 0, _mix(sums[starts[1:]] - sums[starts[:-1]] + n.astype(np.uint64)) | np.uint64(1), np.uint64(0)).view(np.int64))
    return out[0], out[1]


def stretch(n: np.ndarray) -> np.ndarray:
    """Words q of the stretches of a text of n words: a third of it, rounded down to 1, 2, 3, 4, 6 or 8."""
    steps = np.array([0, 1, 2, 3, 4, 6, KEY_WORDS])
    third = np.minimum(np.maximum(n, 0) // 3, KEY_WORDS)
    return steps[np.searchsorted(steps, third, "right") - 1]


#: Texts of so many words share a word at any place; places of substrings: first, middle, last, any.
SHORT = 5
FIRST, MIDDLE, LAST, ANY = range(4)


class _Lookups(NamedTuple):
    """Substrings: text, place, words, whether the text stores the suffix there, and where it begins in the text."""

    text: np.ndarray
    role: np.ndarray
    q: np.ndarray
    stored: np.ndarray
    at: np.ndarray

    def take(self, which: np.ndarray) -> _Lookups:
        return _Lookups(*[c[which] for c in self])


def _lookups(n: np.ndarray) -> _Lookups:
    """The substrings by which texts of ``n`` words are found, and find others."""
    own = stretch(n)
    z = np.zeros(0, np.int64)
    parts = [(z, z, z, z.astype(bool), z)]
    sizes = [(n + d, stretch(n + d)) for d in range(-EDITS, EDITS + 1)]
    for q in np.unique(np.concatenate([s for _, s in sizes])) if len(n) else ():
        near = np.any([(s == q) & (m > SHORT) for m, s in sizes], axis=0) & (q > 0)
        for role, moved in ((FIRST, 0), (MIDDLE, 0), (MIDDLE, -1), (MIDDLE, 1), (LAST, 0)):
            at = n - q if role == LAST else np.full(len(n), moved + q if role == MIDDLE else 0)
            i = np.flatnonzero(near & (at >= 0) & (at + q <= n))
            parts.append((i, np.full(len(i), role), np.full(len(i), q), (own[i] == q) & (n[i] > SHORT) & (moved == 0), at[i]))
    i = np.flatnonzero((n <= SHORT + EDITS) & (n > 0))
    text = np.repeat(i, n[i])
    at = np.arange(len(text)) - np.repeat(np.cumsum(n[i]) - n[i], n[i])
    parts.append((text, np.full(len(text), ANY), np.full(len(text), 1), n[text] <= SHORT, at))
    return _Lookups(*[np.concatenate(x) for x in zip(*parts, strict=True)])


def _gram(codes: np.ndarray, at: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Hash of the q words from ``at``."""
    h = q.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for i in range(KEY_WORDS):
        which = np.flatnonzero(q > i)
        h[which] = _mix((h[which] ^ codes[at[which] + i].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15))
    return h


def _tag(before: np.ndarray, role: np.ndarray, q: np.ndarray) -> np.ndarray:
    """What a substring must share beside its words: its place, its size, and the substrings before it."""
    return _mix(before * np.uint64(0xC2B2AE3D27D4EB4F) + (role * 16 + q).astype(np.uint64) + np.uint64(1))


# ---- what a batch sends to the shards ----------------------------------------------------------------
#
# A row for each shard and Arrow batch, with arrays as bytes: keys (h1, h2, ordinal), links that are
# known already (u, v), the words of texts (each once), and entries: which text, where in it, how many
# words, tag, whether it is stored, and the cuts by which words that hot substrings cover are left out.

_PACK = {
    "k1": np.int64, "k2": np.int64, "k_ordinal": np.int64, "u": np.int64, "v": np.int64, "words": np.uint32, "length": np.int32, "ordinal": np.int64, "run": np.int32,
    "text": np.int32, "at": np.int32, "q": np.int8, "tag": np.uint64, "stored": np.bool_, "cut1": np.int32, "size1": np.int32, "cut2": np.int32, "size2": np.int32,
}
_SENT = pa.schema([("shard", pa.int32()), *[(c, pa.binary()) for c in _PACK]])
_SENT_DDL = "shard int, " + ", ".join(f"{c} binary" for c in _PACK)


class _Texts(NamedTuple):
    """Distinct texts of an Arrow batch with their keys and the links of the rows that repeat one."""

    ordinal: np.ndarray
    run: np.ndarray
    codes: np.ndarray
    start: np.ndarray
    n: np.ndarray
    keys: tuple[np.ndarray, np.ndarray, np.ndarray]
    links: tuple[np.ndarray, np.ndarray]


def _texts(b: pa.RecordBatch) -> _Texts:
    """Of equal keys only the smallest ordinal goes on; the other rows are linked to it here."""
    ordinal, run = b["ordinal"].to_numpy(), b["run"].to_numpy()
    hashes, starts = word_hashes(b["summary"])
    w1, w2 = _whole(hashes, starts)
    kinds = [(w1, w2), *[(b[f"{k}_h1"].to_numpy(), b[f"{k}_h2"].to_numpy()) for k in ("id_key", "page_key")]]
    h1, h2 = (np.concatenate(x) for x in zip(*kinds, strict=True))
    o, row = np.tile(ordinal, 3), np.tile(np.arange(len(ordinal)), 3)
    there = np.flatnonzero((h1 != 0) | (h2 != 0))
    order = there[np.lexsort((row[there], o[there], h2[there], h1[there]))]
    h1, h2, o, row = h1[order], h2[order], o[order], row[order]
    new = np.ones(len(h1), bool)
    new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
    first = o[new][np.cumsum(new) - 1] if len(o) else o
    is_text = new & (order < len(ordinal))
    i = row[is_text]
    i = i[np.diff(starts)[i] >= 3]
    other = o != first
    return _Texts(ordinal[i], run[i], (hashes >> np.uint64(32)).astype(np.uint32), starts[i], np.diff(starts)[i], (h1[new], h2[new], o[new]), (o[other], first[other]))


class _Entries(NamedTuple):
    found: _Lookups
    tag: np.ndarray
    hash: np.ndarray
    cuts: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _levels(t: _Texts, hot: np.ndarray, late: np.ndarray) -> Iterator[tuple[int, _Entries, np.ndarray]]:
    """Entries level by level, with whether each is hot, so that the next level goes on from it.

    ``late`` are hot substrings that were not from the start: they are also looked up as they are.
    """
    owner = np.arange(len(t.n))
    codes, start, n = t.codes, t.start, t.n
    before = np.zeros(len(n), np.uint64)
    cuts = tuple(np.zeros(len(n), np.int64) for _ in range(4))
    for level in range(LEVELS):
        if not len(n):
            return
        found = _lookups(n)
        tag = _tag(before[found.text], found.role, found.q)
        h = _mix(tag + _gram(codes, start[found.text] + found.at, found.q))
        entries = _Entries(found._replace(text=owner[found.text]), tag, h, tuple(c[found.text] for c in cuts))
        is_hot = np.isin(h, hot) & (level + 1 < LEVELS)
        yield level, entries, is_hot
        deep = np.flatnonzero(is_hot)
        rest = [np.concatenate([codes[start[x] : start[x] + a], codes[start[x] + a + q : start[x] + n[x]]]) for x, a, q in zip(found.text[deep], found.at[deep], found.q[deep], strict=True)]
        text = found.text[deep]
        owner, before = owner[text], h[deep]
        cuts = tuple(c[text] for c in cuts)
        cuts = (found.at[deep], found.q[deep], *cuts[2:]) if not level else (*cuts[:2], found.at[deep], found.q[deep])
        n = np.array([len(r) for r in rest], np.int64)
        codes = np.concatenate(rest) if rest else codes[:0]
        start = np.cumsum(n) - n


def _sampled(level: int, hot: np.ndarray):
    """Hashes of the substrings of one level of a sample, with how often each occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, e, _ in _levels(_texts(b), hot, hot[:0]):
                if k == level:
                    h, n = np.unique(e.hash[e.found.stored], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], names=["h", "n"])

    return run


def _sent(shards: int, hot: np.ndarray, late: np.ndarray):
    """The rows that a batch sends to the shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = _texts(b)
            parts = []
            for _, e, is_hot in _levels(t, hot, late):
                which = np.flatnonzero(~is_hot | np.isin(e.hash, late))
                f = e.found.take(which)
                parts.append((e.hash[which], f.text, f.at, f.q, e.tag[which], f.stored & ~is_hot[which], *[c[which] for c in e.cuts]))
            z = np.zeros(0, np.int64)
            h, text, at, q, tag, stored, *cuts = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else [z] * 10
            of = {
                "key": (t.keys[0].view(np.uint64) & np.uint64(shards - 1)).astype(np.int64), "link": (t.links[0] % shards).astype(np.int64), "entry": (h.view(np.uint64) & np.uint64(shards - 1)).astype(np.int64)
            }
            order = {k: np.argsort(s, kind="stable") for k, s in of.items()}
            bounds = {k: np.searchsorted(s[order[k]], np.arange(shards + 1)) for k, s in of.items()}
            rows = []
            for shard in range(shards):
                k, x, e = (order[c][bounds[c][shard] : bounds[c][shard + 1]] for c in ("key", "link", "entry"))
                if not (len(k) or len(x) or len(e)):
                    continue
                mine, which = np.unique(text[e], return_inverse=True)
                size = t.n[mine]
                place = np.repeat(t.start[mine] - (np.cumsum(size) - size), size) + np.arange(size.sum())
                values = {
                    "k1": t.keys[0][k], "k2": t.keys[1][k], "k_ordinal": t.keys[2][k], "u": t.links[0][x], "v": t.links[1][x], "words": t.codes[place.astype(np.int64)], "length": size,
                    "ordinal": t.ordinal[mine], "run": t.run[mine], "text": which, "at": at[e], "q": q[e], "tag": tag[e], "stored": stored[e],
                    "cut1": cuts[0][e], "size1": cuts[1][e], "cut2": cuts[2][e], "size2": cuts[3][e],
                }
                rows.append((shard, *[values[c].astype(kind).tobytes() for c, kind in _PACK.items()]))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * len(_SENT), _SENT, strict=True)], schema=_SENT)

    return run


# ---- search ------------------------------------------------------------------------------------


class Suffixes:
    """A suffix array over the concatenated words of the texts of one shard: entries in order of tag and words.

    An entry is a place in a text; its suffix is what follows there, without the words that a cut leaves out.
    """

    #: What is stored: words of all texts, words and ordinal of each, and of each entry text, place, size, tag and cuts.
    STORED = ("words", "length", "ordinal", "text", "at", "q", "tag", "cut1", "size1", "cut2", "size2")

    def __init__(self, columns: dict[str, np.ndarray], key: np.ndarray | None = None):
        self.__dict__.update(columns)
        self.start = np.cumsum(self.length, dtype=np.int64) - self.length
        self.key = self.keys() if key is None else key

    def keys(self) -> np.ndarray:
        """Tag and words of each entry, as bytes that sort as these do."""
        k = np.zeros((len(self.text), 2 + KEY_WORDS), ">u4")
        k[:, 0], k[:, 1] = self.tag >> np.uint64(32), self.tag & np.uint64(0xFFFFFFFF)
        base = self.start[self.text]
        for i in range(KEY_WORDS):
            j = np.flatnonzero(self.q > i)
            x = self.at[j].astype(np.int64) + i
            for cut, size in ((self.cut2, self.size2), (self.cut1, self.size1)):
                x += np.where(x >= cut[j], size[j], 0)
            k[j, 2 + i] = self.words[base[j] + x]
        return k.view(f"S{4 * (2 + KEY_WORDS)}").ravel()

    def sorted(self) -> Suffixes:
        order = np.lexsort((self.ordinal[self.text], self.key))
        return Suffixes({c: getattr(self, c) if c in ("words", "length", "ordinal") else getattr(self, c)[order] for c in self.STORED}, self.key[order])

    def only(self, which: np.ndarray) -> Suffixes:
        """Some of the entries, with their texts alone."""
        mine, text = np.unique(self.text[which], return_inverse=True)
        size = self.length[mine]
        place = np.repeat(self.start[mine] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        columns = {c: getattr(self, c)[which] for c in self.STORED[3:]} | {"words": self.words[place], "length": size, "ordinal": self.ordinal[mine], "text": text.astype(np.int32)}
        return Suffixes(columns, self.key[which])

    @staticmethod
    def merged(parts: list[Suffixes]) -> Suffixes:
        """One array of several: texts that stand in more than one are stored once."""
        texts = np.cumsum([0, *[len(p.length) for p in parts]])
        columns = {c: np.concatenate([getattr(p, c) for p in parts]) for c in Suffixes.STORED}
        columns["text"] = np.concatenate([p.text.astype(np.int64) + base for p, base in zip(parts, texts, strict=False)]).astype(np.int32)
        return Suffixes(columns, np.concatenate([p.key for p in parts])).sorted()

    def of(self, t: int) -> bytes:
        """The words of a text as bytes."""
        return self.words[self.start[t] : self.start[t] + self.length[t]].tobytes()


WORD = 4


def agree(a: bytes, b: bytes) -> bool:
    """Matches, extended to their longest and put in order, cover all words of both but for as many as may differ."""
    n = max(len(a), len(b)) // WORD
    return _within(a, b, min(EDITS, (n - 1) // 3))


def _within(a: bytes, b: bytes, k: int) -> bool:
    """At most k words added, dropped or changed turn one into the other: the longest match from here, then on behind an edit."""
    if abs(len(a) - len(b)) > WORD * k:
        return False
    m = min(len(a), len(b))
    if a[:m] == b[:m]:
        return True
    if not k:
        return False
    i = WORD * int(np.argmax(np.frombuffer(a[:m], np.uint32) != np.frombuffer(b[:m], np.uint32)))
    a, b = a[i:], b[i:]
    return _within(a[WORD:], b[WORD:], k - 1) or _within(a[WORD:], b, k - 1) or _within(a, b[WORD:], k - 1)


class _Links:
    """Links found in one shard, and what they connect."""

    def __init__(self) -> None:
        self.found: list[tuple[int, int]] = []
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = self.up.get(y, y)
            x = y
        return x

    def apart(self, a: int, b: int) -> bool:
        return a != b and self.root(a) != self.root(b)

    def join(self, a: int, b: int) -> None:
        self.up[self.root(max(a, b))] = self.root(min(a, b))
        self.found.append((max(a, b), min(a, b)))


def _matches(query: Suffixes, which: np.ndarray, array: Suffixes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of texts (of the query, of the array) that share substrings, with the words of these, summed.

    Every substring is binary-searched; of its matches those remain whose texts differ in size by no
    more than the edits. A block of substrings at a time: all of a text's, and few matches.
    """
    which = which[np.argsort(query.text[which], kind="stable")]
    key = query.key[which]
    low, high = np.searchsorted(array.key, key, "left"), np.searchsorted(array.key, key, "right")
    which, low, many = which[high > low], low[high > low], (high - low)[high > low]
    total = np.cumsum(many)
    begin = 0
    while begin < len(which):
        end = max(begin + 1, int(np.searchsorted(total, (total[begin - 1] if begin else 0) + MATCHES, "right")))
        while end < len(which) and query.text[which[end]] == query.text[which[end - 1]]:
            end += 1
        n = many[begin:end]
        e = np.repeat(which[begin:end], n)
        s = np.repeat(low[begin:end] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        a, b = query.text[e], array.text[s]
        ok = (np.abs(query.length[a] - array.length[b]) <= EDITS) & (query.ordinal[a] != array.ordinal[b])
        e, a, b = e[ok], a[ok].astype(np.int64), b[ok].astype(np.int64)
        _, first, inverse = np.unique(a * len(array.length) + b, return_index=True, return_inverse=True)
        yield a[first], b[first], np.bincount(inverse, query.q[e].astype(float), len(first)).astype(np.int64)
        begin = end


def search(query: Suffixes, which: np.ndarray, array: Suffixes, links: _Links) -> np.ndarray:
    """Links of the texts of a run to those of an array; gives the texts of the run that are there word by word.

    The pairs that matches cover most come first; a pair that is connected already is not compared again.
    """
    same = []
    if not len(which) or not len(array.key):
        return np.zeros(0, np.int64)
    for a, b, words in _matches(query, which, array):
        order = np.lexsort((-words, a))
        for i, x, y in zip(order.tolist(), query.ordinal[a[order]].tolist(), array.ordinal[b[order]].tolist(), strict=True):
            if not links.apart(x, y):
                continue
            left, right = query.of(a[i]), array.of(b[i])
            if left == right:
                same.append(a[i])
            elif not agree(left, right):
                continue
            links.join(x, y)
    return np.array(same, np.int64)


def _columns(rows: pa.Table) -> dict[str, np.ndarray]:
    """The arrays of all rows of a shard, put together; texts count on."""
    texts = [len(x) // 4 for x in rows["length"].to_pylist()]
    out = {c: np.frombuffer(b"".join(rows[c].to_pylist()), kind) for c, kind in _PACK.items() if c in rows.column_names}
    base = np.cumsum([0, *texts])[:-1]
    out["text"] = out["text"] + np.repeat(base, [len(x) // 4 for x in rows["text"].to_pylist()]).astype(np.int32)
    return out


_KEYS = ("k1", "k2", "k_ordinal")
_BLOBS = (*_KEYS, *Suffixes.STORED)
_OUT = pa.schema([("shard", pa.int32()), ("u", pa.int64()), ("v", pa.int64()), *[(c, pa.binary()) for c in _BLOBS]])
_OUT_DDL = "shard int, u long, v long, " + ", ".join(f"{c} binary" for c in _BLOBS)
_LINKS_DDL = "u long, v long, shard int"


class Part(NamedTuple):
    """A stored part: its folder, the runs that it holds and the shards that it is split by."""

    path: str
    runs: int
    shards: int


def _stored(part: Part, shard: int, shards: int) -> dict[str, np.ndarray] | None:
    """What a part holds for a shard, read from the files of that shard alone; null if there is nothing.

    A part of fewer shards holds it together with others, whose entries are left out.
    """
    from pyarrow import fs

    system, root = fs.FileSystem.from_uri(part.path.replace("s3a://", "s3://", 1))
    files = [f.path for f in system.get_file_info(fs.FileSelector(f"{root}/shard={shard % part.shards}", allow_not_found=True)) if f.path.endswith(".parquet")]
    tables = [pq.read_table(f, columns=list(_BLOBS), filesystem=system, partitioning=None) for f in files]
    rows = pa.concat_tables(tables) if tables else None
    if rows is not None:
        rows = rows.filter(pc.is_valid(rows["length"]))
    if rows is None or not rows.num_rows:
        return None
    out = _columns(rows)
    if part.shards < shards:
        k = (out["k1"].view(np.uint64) & np.uint64(shards - 1)) == shard
        out |= {c: out[c][k] for c in _KEYS}
        array = Suffixes({c: out[c] for c in Suffixes.STORED})
        mine = np.flatnonzero((_route(array) & np.uint64(shards - 1)) == shard)
        array = array.only(mine)
        out |= {c: getattr(array, c) for c in Suffixes.STORED}
    return out


def _route(array: Suffixes) -> np.ndarray:
    """The hash by which each entry came to its shard."""
    k = array.key.view(np.uint8).reshape(-1, 4 * (2 + KEY_WORDS)).view(">u4").astype(np.uint32)
    codes = np.ascontiguousarray(k[:, 2:]).ravel()
    return _mix(array.tag + _gram(codes, np.arange(len(k)) * KEY_WORDS, array.q.astype(np.int64)))


def _keyed(new: tuple[np.ndarray, ...], old: list[tuple[np.ndarray, ...]]) -> tuple[tuple[np.ndarray, ...], np.ndarray, np.ndarray]:
    """(keys that are new with their first ordinal; rows that have a key of another row, that row)."""
    k1, k2, ordinal = new
    order = np.lexsort((ordinal, k2, k1))
    k1, k2, ordinal = k1[order], k2[order], ordinal[order]
    fresh = np.ones(len(k1), bool)
    fresh[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
    group = np.cumsum(fresh) - 1
    first = ordinal[fresh]
    g1, g2 = k1[fresh], k2[fresh]
    both = np.empty(len(g1), [("a", np.int64), ("b", np.int64)])
    both["a"], both["b"] = g1, g2
    known = np.zeros(len(g1), bool)
    for o1, o2, o in old:
        at = np.searchsorted(o1, g1, "left")
        # Keys of 64 bits that are equal are next to each other: there are hardly ever two.
        while len(o1) and ((hit := np.flatnonzero((at < len(o1)) & (o1[np.minimum(at, len(o1) - 1)] == g1) & ~known)).size):
            same = hit[o2[at[hit]] == g2[hit]]
            known[same], first[same] = True, o[at[same]]
            at[hit] += 1
    v = first[group] if len(first) else first
    apart = ordinal != v
    return (g1[~known], g2[~known], first[~known]), ordinal[apart], v[apart]


def _take_in(shards: int, parts: list[Part], absorbed: frozenset[str]):
    """The task of a shard: replays the runs that came in against the stored arrays, and gives links and the shard's new array."""

    def one(shard: int, rows: pa.Table) -> Iterator[pa.Table]:
        new = _columns(rows)
        stored = [(p, c) for p in parts if (c := _stored(p, shard, shards)) is not None]
        fresh, u, v = _keyed(tuple(new[c] for c in _KEYS), [tuple(c[k] for k in _KEYS) for _, c in stored])
        links = _Links()
        arrays: list[tuple[int, Suffixes]] = []  # (runs, array): those that are only read, and those that this call merges
        fixed: list[Suffixes] = []
        keep = [tuple(x for x in fresh)]
        for p, c in stored:
            array = Suffixes({k: c[k] for k in Suffixes.STORED})
            if p.path in absorbed:
                arrays.append((p.runs, array))
                keep.append(tuple(c[k] for k in _KEYS))
            else:
                fixed.append(array)
        batch = Suffixes({c: new[c] for c in Suffixes.STORED})
        of_run = new["run"][batch.text] if len(batch.text) else new["run"][:0]
        order = np.argsort(of_run, kind="stable")
        edges = np.flatnonzero(np.diff(of_run[order], prepend=-1, append=-1)) if len(order) else []
        for a, z in zip(edges[:-1], edges[1:], strict=True):
            mine = order[a:z]
            store = mine[new["stored"][mine]]
            own = batch.only(store).sorted()
            known = [search(batch, mine, x, links) for x in (*fixed, *(x for _, x in arrays))]
            search(batch, mine, own, links)
            # What the history holds word by word is not stored again.
            again = np.unique(np.concatenate(known)) if known else np.zeros(0, np.int64)
            if len(again):
                own = batch.only(store[~np.isin(batch.text[store], again)]).sorted()
            if len(own.text):
                arrays.append((1, own))
            while len(arrays) > 1 and arrays[-2][0] <= arrays[-1][0]:
                (n, x), (m, y) = arrays[-2:]
                arrays[-2:] = [(n + m, Suffixes.merged([x, y]))]
        whole = Suffixes.merged([x for _, x in arrays]) if arrays else batch.only(np.zeros(0, np.int64))
        keys = [np.concatenate(x) for x in zip(*keep, strict=True)]
        by = np.lexsort((keys[1], keys[0]))
        blobs = {c: k[by].tobytes() for c, k in zip(_KEYS, keys, strict=True)} | {c: getattr(whole, c).tobytes() for c in Suffixes.STORED}
        yield pa.Table.from_pylist([{"shard": shard, **blobs}], schema=_OUT)
        near = np.array(links.found, np.int64).reshape(-1, 2)
        u, v = np.concatenate([new["u"], u, near[:, 0]]), np.concatenate([new["v"], v, near[:, 1]])
        none = pa.nulls(len(u), pa.binary())
        yield pa.Table.from_arrays([pa.array(np.full(len(u), shard, np.int32)), pa.array(u), pa.array(v), *[none] * len(_BLOBS)], schema=_OUT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches), schema=_SENT)  # one shard, or a few: bounded by how shards are laid out
        for shard in np.unique(rows["shard"].to_numpy()).tolist():
            for t in one(shard, rows.filter(pc.equal(rows["shard"], shard))):
                yield from t.to_batches()

    return run


class History:
    """All that was accepted, under ``path`` in the shared folder, where nothing is rewritten in place.

    A numbered manifest names the parts in force; a new one is put beside the old one when a batch
    is in, so a batch that is broken off leaves no trace, a stop loses nothing, and a history that
    is opened again goes on from there.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, shards: int = 16):
        self.spark, self.path = spark, (path or scratch(spark, "history")).rstrip("/")
        self.shards = 1 << max(0, (shards - 1).bit_length())
        self.parts: list[Part] = []
        #: Folders with links, records taken in, calls.
        self.links: list[str] = []
        self.records = 0
        #: Hot substrings, with the call from which on they are.
        self.hot: dict[int, int] = {}
        if known := read_state(spark, f"{self.path}/manifest"):
            m = json.loads(known)
            self.shards, self.links, self.records = m["shards"], m["links"], m["records"]
            self.parts = [Part(*p) for p in m["parts"]]
            self.hot = {int(h): b for h, b in m["hot"].items()}

    def _save(self) -> None:
        state = {"shards": self.shards, "parts": self.parts, "links": self.links, "records": self.records, "hot": self.hot}
        write_state(self.spark, f"{self.path}/manifest", json.dumps(state), len(self.links))

    def _heat(self, keyed: DataFrame, call: int) -> tuple[np.ndarray, np.ndarray]:
        """The substrings that are hot so far, and those of them that were not from the first call on.

        They are counted in a sample, level by level: it decides how texts meet, not which are
        compared. The hottest count, so that their number is bounded; what is left is shared by fewer texts.
        """
        sample = keyed.where((F.pmod(F.xxhash64("ordinal"), F.lit(SAMPLED)) == 0) & ~is_blank(F.col("summary")))
        for level in range(LEVELS - 1):
            known = np.array(list(self.hot), np.int64).view(np.uint64)
            counts = sample.mapInArrow(_sampled(level, known), "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= HOT)
            found = [r.h for r in counts.orderBy(F.col("n").desc()).limit(HOT_KEYS).collect()]
            for h in found:
                self.hot.setdefault(h, call)
            if not found:
                break
        return np.array(list(self.hot), np.int64).view(np.uint64), np.array([h for h, since in self.hot.items() if since], np.int64).view(np.uint64)

    def accept(self, batch: DataFrame, runs: int = 1) -> None:
        """Takes in a batch (ordinal, id, url, summary), or several: then ``run`` (int) tells which row is of which, in order."""
        call = len(self.links)
        run = F.col("run").cast("int") if "run" in batch.columns else F.lit(0)
        rows = batch.select(run.alias("run"), F.col("ordinal").cast("long").alias("ordinal"), F.col("id").cast("string").alias("id"), F.col("url").cast("string").alias("url"), F.col("summary").cast("string").alias("summary")).where("ordinal is not null")
        self.records += rows.count()
        while self.records > self.shards * SHARD_RECORDS:
            self.shards *= 2
        keyed = with_keys(rows).select("run", "ordinal", *_hashed(1, "id_key"), *_hashed(2, "page_key"), "summary")
        hot, late = self._heat(rows.select("run", "ordinal", *[F.lit(0).cast("long").alias(f"{k}_h{i}") for k in ("id_key", "page_key") for i in (1, 2)], "summary"), call)
        # A part that is no larger than what it is merged with is taken up: each record is written again as often as the logarithm of the runs.
        size, absorbed, parts = runs, [], list(self.parts)
        while parts and parts[-1].runs <= size:
            absorbed.append(parts.pop())
            size += absorbed[-1].runs
        to = f"{self.path}/part-{call}-{uuid.uuid4().hex[:8]}"
        sent = keyed.mapInArrow(_sent(self.shards, hot, late), _SENT_DDL)
        # Every shard has a row, so that what is taken up is written again also where nothing new came.
        empty = self.spark.range(self.shards).select(F.col("id").cast("int").alias("shard"), *[F.lit(b"").alias(c) for c in _PACK])
        routed = sent.unionByName(empty).repartitionById(self.shards, F.col("shard"))
        done = routed.mapInArrow(_take_in(self.shards, self.parts, frozenset(p.path for p in absorbed)), _OUT_DDL)
        done.write.partitionBy("shard").parquet(to)
        self.parts = [*parts, Part(to, size, self.shards)]
        self.links.append(to)
        self._save()

    def found(self) -> DataFrame:
        """u, v: all links, of each row to an earlier one."""
        each = [self.spark.read.schema(_LINKS_DDL).parquet(p).where("u is not null").select("u", "v") for p in self.links]
        out = self.spark.createDataFrame([], "u long, v long")
        for e in each:
            out = out.unionByName(e)
        return out

    def repeats(self) -> DataFrame:
        """kept_ordinal, dup_ordinal: every row taken in that repeats an item, with the item's first row."""
        return components(self.found()).select(F.col("root").alias("kept_ordinal"), F.col("u").alias("dup_ordinal"))


def replay(archive: DataFrame, calls: int = CALLS, path: str | None = None) -> History:
    """Takes in a whole archive run by run, in order of their clocks, by so many calls."""
    at = F.col("first_seen_at")
    spark = archive.sparkSession
    clocks = [r[0] for r in archive.select(at).where(at.isNotNull()).distinct().orderBy(at).collect()]  # one row a run
    numbers = small_side(spark.createDataFrame(list(zip(clocks, range(len(clocks)), strict=True)), "first_seen_at timestamp, run int"))
    rows = archive.select("ordinal", "id", "url", "summary", at.cast("timestamp").alias("first_seen_at")).join(numbers, "first_seen_at", "left")
    rows = rows.withColumn("run", F.coalesce("run", F.lit(len(clocks))))
    history = History(spark, path)
    calls = max(1, min(calls, len(clocks)))
    ends = [len(clocks) * i // calls for i in range(calls + 1)]
    for a, z in zip(ends[:-1], ends[1:], strict=True):
        history.accept(rows.where((F.col("run") >= a) & ((F.col("run") < z) | F.lit(z == ends[-1]))), z - a)
    return history
