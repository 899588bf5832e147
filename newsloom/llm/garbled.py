"""Titles decoded with the wrong character encoding, restored (problem 4).

Character n-gram counts of all clean titles are kept in hashed tables of fixed size; three orders,
interpolated, give the likelihood of a text. Of each part of a title every encode-decode chain
(see candidates) that its characters allow is scored (up to three steps, legacy encodings first),
also chains that lost characters, and the likeliest is accepted if it beats the text as it stands
by a margin. The margin is validated on all clean titles, as they are and garbled on purpose: they
are in folds, and each fold is judged by the counts of all others. The candidates of a whole Arrow
batch are scored at once.

Defined results: null and blank titles are sound; a title with U+FFFD has lost characters; where a
chain that lost characters is the likeliest by the margin, restored_title is the empty string. An
empty table gives no rows. Repeated rows each give a row.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import cache, lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Sizes of the hashed count tables for one, two and three characters: the bound of what is broadcast.
TABLE_BITS = (16, 18, 20)
#: Folds of the clean titles; each is kept out of the counts while the margins are validated on it.
HELD_OUT = 8
#: Margins that are tried, in nats.
MARGINS = tuple(range(1, 31))

# Single-byte encodings that feeds are wrongly read as, and those of several bytes.
SINGLE = ("latin-1", "cp1252", "mac_roman", "cp437", "cp850", "cp1250", "cp1251", "koi8-r", "iso8859-15")
MULTI = ("gb18030", "big5hkscs", "shift_jis", "euc_kr")
LEGACY = ("gb18030", "big5hkscs", "shift_jis", "cp1251", "mac_roman", "cp437", "cp1250")

#: Han characters that a reading in an encoding of two bytes must have at least.
LEGACY_CHARS = 3

_UTF8 = re.compile("[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xef][\x80-\xbf]{2}|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2}")
# The scripts and signs that a pair or triple of bytes may stand for; others meet by accident.
_SCRIPTS = re.compile("[\x80-\u017f\u0370-\u045f\u2000-\u206f\u20a0-\u20bf\u2100-\u214f\u2190-\u21ff\u2500-\u27bf\u3000-\u30ff\u3400-\u9fff\uac00-\ud7af\uff00-\uffef\U0001f000-\U0001faff]")
_HIGH = re.compile(r"[^\x00-\x7f]+")
_HIGHS = re.compile(r"[^\x00-\x7f]{2,}")
_CJK = re.compile("[㐀-鿿]")
_NONE = "￿"
#: Characters of no single-byte code page.
_WIDE = re.compile("[\u2e80-\ud7ff]")


class _Bytes(dict):
    """Translation of characters to those that stand for their bytes; what has no byte becomes a mark."""

    def __missing__(self, c: int) -> str:
        self[c] = _NONE
        return _NONE


@cache
def _to_byte(encoding: str) -> dict[int, str]:
    """The table of one code page; its holes are themselves."""
    table = _Bytes({c: chr(c) for c in range(0x80)})
    for b in range(0x80, 0x100):
        try:
            c = bytes([b]).decode(encoding)
        except UnicodeDecodeError:
            c = chr(b)
        table.setdefault(ord(c), chr(b))
    return table


@cache
def _paged() -> frozenset[int]:
    """Characters of the single-byte code pages; what was read wrongly twice passes through them."""
    return frozenset(c for e in SINGLE for c, b in _to_byte(e).items() if b != _NONE)


def _bytes_view(text: str, encoding: str) -> str:
    """One character a character: the byte it has in the encoding, or a mark that it has none."""
    return text.translate(_to_byte(encoding))


@cache
def _page_pattern(*pages: str) -> re.Pattern:
    """Two neighbours of which the first may be a lead byte of UTF-8 and the second one that follows, in some of the code pages."""

    def of(a: str, z: str) -> str:
        return re.escape("".join(sorted({chr(c) for e in pages for c, b in _to_byte(e).items() if b != _NONE and a <= b <= z})))

    return re.compile(f"[{of(chr(0xC2), chr(0xF4))}][{of(chr(0x80), chr(0xBF))}]")


@lru_cache(1 << 17)
def _sign(raw: str) -> str:
    """The character that the bytes stand for, if it is one that texts have; else nothing."""
    try:
        c = raw.encode("latin-1").decode("utf-8")
    except UnicodeDecodeError:
        return ""
    return c if _SCRIPTS.match(c) or ord(c) in _paged() else ""


def _utf8_runs(text: str, encoding: str) -> str | None:
    """The text with each stretch that is UTF-8 in the bytes of ``encoding`` decoded; null if there is none."""
    if not _page_pattern(encoding).search(text):
        return None
    view = _bytes_view(text, encoding)
    at, out = 0, []
    for m in _UTF8.finditer(view):
        if not (c := _sign(m[0])):
            continue
        out += [text[at : m.start()], c]
        at = m.end()
    return "".join([*out, text[at:]]) if out else None


@lru_cache(1 << 15)
def _run_readings(run: str) -> tuple[str | None, ...]:
    return tuple(_utf8_runs(run, e) for e in SINGLE)


def _readings(text: str) -> Iterator[str]:
    """The text with each stretch decoded that is UTF-8 in the bytes of a single-byte encoding, by encoding; ASCII is in no stretch."""
    known = {run: _run_readings(run) for run in _HIGHS.findall(text)}
    for read in dict.fromkeys(zip(*known.values(), strict=True)):
        if any(r is not None for r in read):
            now = {run: run if r is None else r for run, r in zip(known, read, strict=True)}
            yield _HIGHS.sub(lambda m, now=now: now[m[0]], text)


@cache
def _run(encoding: str) -> dict[str, str | None]:
    return {}


def _multi_runs(text: str, encoding: str) -> str | None:
    """The text with each run beyond ASCII that is UTF-8 in the bytes of ``encoding`` decoded."""
    known = _run(encoding)
    if len(known) > 200_000:
        known.clear()
    done = False

    def one(m: re.Match) -> str:
        nonlocal done
        run = m[0]
        if run not in known:
            try:
                known[run] = run.encode(encoding).decode("utf-8")
            except UnicodeError:
                known[run] = None
        if (c := known[run]) is None:
            return run
        done = True
        return c

    out = _HIGH.sub(one, text)
    return out if done else None


#: Single-byte encodings that legacy ones are wrongly read as.
READ_AS = ("latin-1", "cp1252", "mac_roman")
_HIGH_SPACE = re.compile(r"(?![\x00-\x7f])\s")


def _legacy(text: str, raw: bytes, encoding: str) -> str | None:
    """The text whose bytes are ``raw``, in ``encoding``."""
    try:
        out = raw.decode(encoding)
    except UnicodeError:
        return None
    if out == text or "�" in out:
        return None
    if encoding in MULTI:
        # Two bytes of any two accented letters make some character, so short stretches are no evidence.
        return out if len(_CJK.findall(out)) >= LEGACY_CHARS else None
    # White space is what it is; no code page was read so that a letter became a space.
    if any(text[m.start()].isspace() and not out[m.start()].isspace() for m in _HIGH_SPACE.finditer(text)):
        return None
    return out


def _read_as(text: str) -> Iterator[tuple[str, bytes]]:
    """The bytes that the text is in the encodings that legacy ones are wrongly read as, each once."""
    if _WIDE.search(text):
        return
    known = set()
    for r in READ_AS:
        view = _bytes_view(text, r)
        if _NONE not in view and view not in known:
            known.add(view)
            yield r, view.encode("latin-1")


def _multi(text: str) -> Iterator[str]:
    for e in MULTI:
        if (c := _multi_runs(text, e)) is not None:
            yield c


def _legacies(text: str) -> Iterator[str]:
    for r, raw in _read_as(text):
        for e in LEGACY:
            if e != r and (c := _legacy(text, raw, e)) is not None:
                yield c


def candidates(text: str) -> list[str]:
    """What the text may have been, by chains of up to three steps that lose nothing.

    UTF-8 may have been read wrongly again and again, and each reading is taken a step further: there
    are few, since hardly any is UTF-8 once more. An encoding of several bytes is only ever the last
    that was wrongly read as, a legacy encoding only ever the first.
    """
    seen = dict.fromkeys(_multi(text))
    level = [text, *seen]
    for _ in range(3):
        level = [t for t in level if _page_pattern(*SINGLE).search(t)]
        level = list(dict.fromkeys(c for t in level for c in _readings(t) if c not in seen))
        seen.update(dict.fromkeys(level))
    seen.update(dict.fromkeys(_legacies(text)))
    seen.pop(text, None)
    return list(seen)


# What bytes of a code page are dropped on the way, by the page; and likely characters behind a lone lead byte.
_DROPPED = {"latin-1": frozenset(map(chr, range(0x80, 0xA0))), "cp1252": frozenset("\x81\x8d\x8f\x90\x9d")}
_PUNCTUATION = "’“”–—…‘„•、。「」《》：，？！（）；"


@cache
def _shrunk(dropped: frozenset[str]) -> dict[str, tuple[str, ...]]:
    """By what is left of a character's UTF-8 form when bytes are dropped: the characters. Of two bytes all, of three punctuation and Han."""
    out: dict[str, list[str]] = {}
    for c in (*map(chr, (*range(0x80, 0x800), *range(0x4000, 0xA000))), *_PUNCTUATION):
        raw = c.encode("utf-8").decode("latin-1")
        left = "".join(b for b in raw if b not in dropped)
        if len(left) < len(raw) and c.isprintable():
            out.setdefault(left, []).append(c)
    return {left: tuple(cs) for left, cs in out.items()}


def _fillers(lead: str, rest: str, dropped: frozenset[str]) -> tuple[str, ...]:
    """Characters whose UTF-8 form shrinks to ``lead`` and ``rest`` when bytes are dropped."""
    return _shrunk(dropped).get(lead + rest, ())


_LEAD = re.compile("([\xc2-\xf4])([\x80-\xbf]*)|[^\x00-\x7f]")


def lossy(text: str, model: Model) -> str | None:
    """The likeliest text that became ``text`` when its UTF-8 bytes were read as a code page and some were dropped; null if none can have."""
    best = None
    if _WIDE.search(text):
        return None
    for encoding, dropped in _DROPPED.items():
        view = _bytes_view(text, encoding)
        if _NONE in view:
            continue
        out, at, lost = "", 0, False
        for m in _LEAD.finditer(view):
            if m[1] is None:
                break
            out += view[at : m.start()]
            at = m.end()
            need = 2 if m[1] <= "\xdf" else 3 if m[1] <= "\xef" else 4
            if len(m[2]) >= need - 1:
                try:
                    out += (m[1] + m[2][: need - 1]).encode("latin-1").decode("utf-8")
                except UnicodeDecodeError:
                    break
                if len(m[2]) >= need:
                    break
                continue
            after = view[at : at + 1]
            # A Chinese sign that lost bytes has other bytes beside it; alone, it is an accented letter.
            alone = not ("\x80" <= view[m.start() - 1 : m.start()] or "\x80" <= after)
            if (m[1] in "\xe3\xef" or "\xe4" <= m[1] <= "\xe9") and not m[2] and alone:
                break
            after = after if after and after < "\x80" else ""
            if (c := model.fill(out[-2:], m[1], m[2], dropped, after)) is None:
                break
            out += c
            lost = True
        else:
            out += view[at:]
            if lost and (best is None or model.score(out) > model.score(best)):
                best = out
    return best


_KEYS = tuple(map(np.uint64, (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)))


def _times(c: int, back: int) -> np.uint64:
    """One character's part of a hash; it stands so many back."""
    return np.uint64(c * int(_KEYS[back]) & 0xFFFFFFFFFFFFFFFF)


def _mixed(h: np.ndarray | np.uint64, bits: int) -> np.ndarray:
    h = np.multiply(h ^ (h >> np.uint64(31)), np.uint64(0xD6E8FEB86659FD93))
    return (h >> np.uint64(64 - bits)).astype(np.int64)


def _buckets(c: np.ndarray, b1: np.ndarray | int, b0: np.ndarray | int) -> list[np.ndarray]:
    """Buckets of the grams of one, two and three characters that end at ``c``, behind b1 and b0."""
    one = c.astype(np.uint64) * _KEYS[0]
    two = one ^ np.multiply(b1, _KEYS[1], dtype=np.uint64)
    three = two ^ np.multiply(b0, _KEYS[2], dtype=np.uint64)
    out = [(c.astype(np.uint64) & np.uint64((1 << TABLE_BITS[0]) - 1)).astype(np.int64)]  # no two of the basic plane share one
    return out + [_mixed(h, bits) for h, bits in zip((two, three), TABLE_BITS[1:], strict=True)]


def _grams(codes: np.ndarray) -> list[np.ndarray]:
    """Buckets of the grams that end at each character; before the first two stands nothing."""
    c = codes.astype(np.uint64)
    b1, b0 = np.zeros_like(c), np.zeros_like(c)
    b1[1:], b0[2:] = c[:-1], c[:-2]
    return _buckets(c, b1, b0)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(f"\x02\x02{text}\x03".encode("utf-32-le", "surrogatepass"), np.uint32)


class Pool(NamedTuple):
    """Characters to choose from: their part of a hash as the last and as the one before, their counts and likelihoods."""

    chars: tuple[str, ...]
    one: np.ndarray
    behind: np.ndarray
    n: np.ndarray
    p1: np.ndarray


class Model:
    """Interpolated likelihood of a text from hashed counts."""

    def __init__(self, tables: list[np.ndarray]):
        self.tables = tables
        self.total = float(tables[0].sum())
        self.logs: dict[str, float] = {}
        self.filled: dict[tuple, str | None] = {}
        self.pools: dict[tuple, Pool] = {}

    def score(self, text: str) -> float:
        known = self.logs.get(text)
        if known is None:
            grams = _grams(_codes(text))
            known = float(self._log([g[2:] for g in grams], self.tables[0][grams[0][1:-1]], self.tables[1][grams[1][1:-1]]).sum())
            if len(self.logs) > 4096:
                self.logs.clear()
            self.logs[text] = known
        return known

    def scores(self, texts: list[str]) -> np.ndarray:
        """Of many texts at once."""
        if not texts:
            return np.zeros(0)
        codes = [_codes(t) for t in texts]
        ends = np.cumsum([len(c) for c in codes])
        grams = _grams(np.concatenate(codes))
        inside = np.ones(ends[-1], bool)
        starts = np.concatenate([[0], ends[:-1]])
        inside[starts] = inside[starts + 1] = False
        at = np.flatnonzero(inside)
        logs = self._log([g[at] for g in grams], self.tables[0][grams[0][at - 1]], self.tables[1][grams[1][at - 1]])
        return np.add.reduceat(logs, starts - 2 * np.arange(len(texts)))

    def fill(self, before: str, lead: str, rest: str, dropped: frozenset[str], after: str) -> str | None:
        """The character that shrank to ``lead`` and ``rest`` and fits best between its neighbours; null if there is none."""
        key = before, lead, rest, dropped, after
        if key not in self.filled:
            if len(self.filled) > 1 << 15:
                self.filled.clear()
            if (pool := self.pools.get(key[1:4])) is None:
                chars = _fillers(lead, rest, dropped)
                pool = self.pools[key[1:4]] = self._pool(tuple(c for c in chars if lead > "\xdf" or self.knows(c)))
            self.filled[key] = self.choose(before, pool, after) if pool.chars else None
        return self.filled[key]

    def _pool(self, chars: tuple[str, ...]) -> Pool:
        codes = np.array([ord(c) for c in chars], np.uint64)
        n = self.tables[0][_buckets(codes, 0, 0)[0]].astype(float)
        return Pool(chars, codes * _KEYS[0], codes * _KEYS[1], n, self._p1(n))

    def choose(self, before: str, pool: Pool, after: str) -> str:
        """The character of the pool that fits best between its neighbours."""
        b0, b1 = (ord(x) for x in f"\x02\x02{before}"[-2:])
        two = pool.one ^ _times(b1, 1)
        twos = self._at(1, two)
        p2 = (twos + 2 * pool.p1) / (self._ones(b1) + 2)
        score = np.log((self._at(2, two ^ _times(b0, 2)) + 2 * p2) / (float(self._at(1, _times(b1, 0) ^ _times(b0, 1))) + 2))
        if after:
            two = _times(ord(after), 0) ^ pool.behind
            p2 = (self._at(1, two) + 2 * self._p1(self._ones(ord(after)))) / (pool.n + 2)
            score = score + np.log((self._at(2, two ^ _times(b1, 2)) + 2 * p2) / (twos + 2))
        return pool.chars[int(np.argmax(score))]

    def _ones(self, c: int) -> float:
        return float(self.tables[0][c & (1 << TABLE_BITS[0]) - 1])

    def _at(self, level: int, h: np.ndarray | np.uint64):
        """Counts of grams of two or three characters by their unmixed hash."""
        return self.tables[level][_mixed(h, TABLE_BITS[level])].astype(float)

    def knows(self, c: str) -> bool:
        """The character stands in clean titles."""
        return self._ones(ord(c)) > 0

    def _p1(self, n):
        return (n + 0.01) / (self.total + 0.01 * 70_000)

    def _log(self, grams: list[np.ndarray], before, both) -> np.ndarray:
        """Log likelihood from the grams, the count of the character before, and of the two before."""
        one, two, three = (t[g].astype(float) for t, g in zip(self.tables, grams, strict=True))
        p2 = (two + 2 * self._p1(one)) / (before + 2)
        return np.log((three + 2 * p2) / (both + 2))


class Margins(NamedTuple):
    """In nats: by how much a reading must beat the text as it stands; and one that lost characters all others."""

    lossless: float
    lost: float


class Verdict(NamedTuple):
    text: str
    gain: float
    lost_gain: float


def judge(parts: list[str], model: Model) -> list[Verdict]:
    """Of each text the likeliest lossless reading with its gain, and by how much a reading that lost characters beats all of these."""
    found = [[] if p.isascii() else candidates(p) for p in parts]
    lost = [None if p.isascii() else lossy(p, model) for p in parts]
    flat = [t for p, c, h in zip(parts, found, lost, strict=True) if c or h is not None for t in (p, *c, *([h] if h is not None else []))]
    scored = iter(model.scores(flat).tolist())
    out = []
    for p, c, h in zip(parts, found, lost, strict=True):
        if not c and h is None:
            out.append(Verdict(p, 0.0, 0.0))
            continue
        at = next(scored)
        best, gain = p, 0.0
        for t in c:
            g = next(scored) - at
            if g > gain:
                best, gain = t, g
        out.append(Verdict(best, gain, 0.0 if h is None else next(scored) - at - gain))
    return out


def restore(titles: list[str | None], model: Model, margins: Margins) -> list[str | None]:
    """Each title as it was; the empty string if that is lost; null if the title is sound."""
    known: dict[str, str | None] = {t: "" if "�" in t else None for t in titles if t and not t.isascii()}
    open_ = [t for t, r in known.items() if r is None]
    parts = list(dict.fromkeys(p for t in open_ for p in _parts(t)))
    verdicts = dict(zip(parts, judge(parts, model), strict=True))
    several = [t for t in open_ if "|" in t]
    whole = dict(zip(several, judge(several, model), strict=True))
    for t in open_:
        vs = [verdicts[p] for p in _parts(t)]
        if any(v.lost_gain > margins.lost for v in vs):
            known[t] = ""
            continue
        taken = [v.gain > margins.lossless for v in vs]
        best = "|".join(v.text if take else p for v, take, p in zip(vs, taken, _parts(t), strict=True))
        if (v := whole.get(t)) and v.gain > margins.lossless and model.score(v.text) > model.score(best):
            known[t] = v.text
        elif any(taken):
            known[t] = best
    return [known.get(t) if t else None for t in titles]


def _parts(title: str) -> list[str]:
    return title.split("|")


_CONTROLS = re.compile("[\x80-\x9f�]")


def _suspect(title: str) -> bool:
    """Some chain applies that hardly ever does by accident, or characters are lost: no evidence of sound spelling."""
    if _CONTROLS.search(title) or any(_multi_runs(title, e) is not None for e in MULTI[:2]):
        return True
    return _page_pattern(*SINGLE).search(title) is not None and (next(_readings(title), None) is not None or any(_legacy(title, raw, e) is not None for _, raw in _read_as(title) for e in MULTI))


def _fold(title: str) -> int:
    """Each fold is held out of the counts while the margins are validated on it."""
    return hash_of(title) % HELD_OUT


def hash_of(text: str) -> int:
    h = 2166136261
    for b in text.encode("utf-8", "surrogatepass"):
        h = (h ^ b) * 16777619 & 0xFFFFFFFF
    return h


#: Where the tables of one fold begin, laid end to end, and where they end.
_STARTS = tuple(sum(1 << bits for bits in TABLE_BITS[:level]) for level in range(len(TABLE_BITS) + 1))


def _count(titles: DataFrame) -> DataFrame:
    """slot, n: gram counts of the clean parts of all titles; a slot is a place in the tables of all folds, laid end to end."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts, folds = [], []
            for t, n in Counter(b["title"]).items():
                clean = [part for part in _parts(t) if part.isascii() or not _suspect(part)] * n
                texts += clean
                folds += [_fold(t)] * len(clean)
            if not texts:
                continue
            codes = [_codes(t) for t in texts]
            fold = np.repeat(folds, [len(c) for c in codes]) * _STARTS[-1]
            slots = [fold + start + g for start, g in zip(_STARTS, _grams(np.concatenate(codes)), strict=False)]
            slot, n = np.unique(np.concatenate(slots).astype(np.int32), return_counts=True)
            yield pd.DataFrame({"slot": slot, "n": n})

    return titles.select("title").mapInPandas(run, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n"))


def _tables(counts: pa.Table) -> np.ndarray:
    """A row of counts for each fold."""
    out = np.zeros(HELD_OUT * _STARTS[-1], np.float32)
    for b in counts.to_batches():
        out[b["slot"].to_numpy()] = b["n"].to_numpy()
    return out.reshape(HELD_OUT, -1)


def _model(folds: np.ndarray, without: int | None = None) -> Model:
    """From the counts of all folds, or of all but one."""
    n = folds.sum(axis=0, dtype=float)
    if without is not None:
        n -= folds[without]
    return Model(np.split(n.astype(np.float32), _STARTS[1:-1]))


# Chains by which held-out titles are garbled on purpose, (written in, read as) for each step.
GARBLINGS = (
    (("utf-8", "latin-1"),),
    (("utf-8", "cp1252"),),
    (("utf-8", "mac_roman"),),
    (("utf-8", "cp437"),),
    (("utf-8", "cp1251"),),
    (("utf-8", "gb18030"),),
    (("gb18030", "latin-1"),),
    (("utf-8", "latin-1"), ("utf-8", "latin-1")),
)


def garble(text: str, chain: tuple[tuple[str, str], ...]) -> str | None:
    try:
        for written, read in chain:
            text = text.encode(written).decode(read)
    except UnicodeError:
        return None
    return text


def drop(text: str) -> str:
    """What is left when UTF-8 was read as latin-1 and control characters were thrown away."""
    return "".join(c for c in text.encode("utf-8").decode("latin-1") if not "\x80" <= c <= "\x9f")


def _gains(titles: dict[str, int], model: Model) -> Counter[tuple[str, int]]:
    """How many margins the gains of titles exceed, by kind; each title as often as it is there."""
    sound, bad, dropped = [], [], []
    for title, n in titles.items():
        for t in _parts(title):
            if t.isascii() or _suspect(t):
                continue
            sound.append((t, n))
            b = garble(t, GARBLINGS[hash_of(title) // HELD_OUT % len(GARBLINGS)])
            if b and b != t:
                bad.append((b, t, n))
            d = drop(t)
            if len(d) < len(t.encode()):
                dropped.append((d, n))
    rows: Counter[tuple[str, int]] = Counter()
    for (_, n), v in zip(sound, judge([t for t, _ in sound], model), strict=True):
        rows["sound", sum(m < v.gain for m in MARGINS)] += n
        rows["sound lost", sum(m < v.lost_gain for m in MARGINS)] += n
    for (_, t, n), v in zip(bad, judge([b for b, _, _ in bad], model), strict=True):
        rows["garbled" if v.text == t else "wrong", sum(m < v.gain for m in MARGINS)] += n
    for (_, n), v in zip(dropped, judge([d for d, _ in dropped], model), strict=True):
        rows["lost", sum(m < v.lost_gain for m in MARGINS)] += n
    return rows


def _validate(titles: DataFrame, folds: np.ndarray) -> pd.DataFrame:
    """kind, above, n: over all clean titles beyond ASCII, each judged without the counts of its fold, how many margins each gain exceeds.

    Kinds: a sound title's gain and its gain as lost; the gain of one garbled on purpose; the gain
    as lost of one that was robbed of characters on purpose. Titles in ASCII have no other reading.
    """
    shared = titles.sparkSession.sparkContext.broadcast(folds)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = cache(lambda fold: _model(shared.value, fold))
        for b in batches:
            held: dict[int, dict[str, int]] = {}
            for t, n in Counter(b["title"]).items():
                held.setdefault(_fold(t), {})[t] = n
            rows = sum((_gains(ts, model(fold)) for fold, ts in held.items()), Counter())
            if rows:
                yield pd.DataFrame([(k, i, n) for (k, i), n in rows.items()], columns=["kind", "above", "n"])

    high = titles.where(F.col("title").rlike(r"[^\x00-\x7F]"))
    return high.select("title").mapInPandas(run, "kind string, above int, n long").groupBy("kind", "above").agg(F.sum("n").alias("n")).toPandas()


def _best(seen: pd.DataFrame, sound: str, bad: str) -> float:
    """The margin with the fewest sound titles changed and bad ones let pass; of equals the middle one."""
    n, above = seen["n"], seen["above"]
    errors = [n[(seen["kind"] == sound) & (above > i)].sum() + n[(seen["kind"] == bad) & (above <= i)].sum() for i in range(len(MARGINS))]
    least = [m for m, e in zip(MARGINS, errors, strict=True) if e == min(errors)]
    return float(least[len(least) // 2])


def train(items: DataFrame) -> tuple[Model, Margins]:
    """The model over all clean titles and the validated margins."""
    titles = items.select("title").where(F.col("title").isNotNull())
    folds = _tables(_count(titles).toArrow())  # bounded by the tables
    seen = _validate(titles, folds)
    return _model(folds), Margins(_best(seen, "sound", "garbled"), _best(seen, "sound lost", "lost"))


def restored(items: DataFrame, model: Model | None = None, margins: Margins | None = None) -> DataFrame:
    """ordinal, restored_title of every garbled row."""
    if model is None or margins is None:
        model, margins = train(items)
    shared = items.sparkSession.sparkContext.broadcast(model.tables)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lm = Model(shared.value)
        for b in batches:
            found = [(o, r) for o, r in zip(b["ordinal"], restore(b["title"].tolist(), lm, margins), strict=True) if r is not None]
            yield pd.DataFrame(found, columns=["ordinal", "restored_title"])

    high = F.col("title").rlike(r"[^\x00-\x7F]")
    return items.where(high).select(F.col("ordinal").cast("long").alias("ordinal"), "title").mapInPandas(run, "ordinal long, restored_title string")
