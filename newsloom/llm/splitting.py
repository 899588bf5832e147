"""Texts above a token limit cut at natural boundaries, with overlap (problem 10).

Giant texts are never looked at as a whole: they are laid out in ranges with halos on both sides.
A first pass counts the tokens of each range; prefix sums over the ranges of a text give every
range its first token; a second pass finds, for each point of a grid of tokens, the best boundary
at or shortly before it, with the place where the overlap before it begins; the candidates of
neighbouring ranges are stitched, and pieces are emitted by offset. Texts of one range take the
same steps within one task.

Where a text may be cut (its marks) is told by what stands within FINE characters of a place, and
ranges end at marks; so marks and counts between them are the same whatever the ranges, and so are
the pieces. Marks are natural boundaries; white space where these are far apart; and offsets in
steps of a fixed size where there is no white space either.

The grid makes every cut independent of the cuts before it: cut k is the best boundary among the
tokens (k S - W, k S]. A piece has less than S + W tokens besides the overlap, and S and W are
chosen so that it stays under the limit. Should the counts of parts belie the whole, a piece gives
up its overlap, and if that is not enough it is emitted in parts, in order, with the same number.

Defined results: null and empty texts give no piece; a text within the limit is one piece; the
pieces without their overlaps are the text, letter by letter; where there is no boundary, a cut
falls between two characters. Rows are told apart by doc_id and a row key, so repeated rows are
cut each.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.llm.tokens import DEFAULT, tokenizer
from newsloom.runtime import cut

LIMIT, OVERLAP = 1024, 64
#: Characters of a range; the halo on each side of it has an eighth of that, and four times FINE at least.
RANGE = 65_536
#: Characters between natural boundaries, or of a word, beyond which a text is marked inside them.
FINE = 1024
#: Tokens by which counts of parts and of the whole may differ in a piece.
SLACK = 24

#: Tokens that one character can have at most: its bytes.
CHAR_TOKENS = 4

HEADING, PARAGRAPH, LINE, SENTENCE, SPACE, NONE = 5, 4, 3, 2, 1, 0
KINDS = ("none", "space", "sentence", "line", "paragraph", "heading")

# A cut falls before the white space that follows a unit, or behind a sentence mark of Chinese,
# where the tokenizer's words end as well, so that counts add up.
_CUT = re.compile(
    r"(?P<heading>\n\s*(?=#{1,6}\s|\d+\.\s+\S[^\n]{0,80}\n\s*\n|={3,}|-{3,}\s*\n))"
    r"|(?P<paragraph>\r?\n[ \t]*\r?\n\s*)"
    r"|(?P<line>\r?\n)"
    r"|(?<=[.!?…;:。！？；”’\"')\]»])(?P<sentence>[ \t　\xa0]+)(?=\S)"
    r"|(?<=[。！？；])(?P<han>)(?=[^\s。！？；”’」』）\"')\]])"
    r"|(?<=[。！？；][”’」』）])(?P<quoted>)(?=[^\s。！？；”’」』）\"')\]])"
)
_LEVEL = {"heading": HEADING, "paragraph": PARAGRAPH, "line": LINE, "sentence": SENTENCE, "han": SENTENCE, "quoted": SENTENCE}
_SPACE = re.compile(r"(?<=\S)\s")


def boundaries(text: str) -> list[tuple[int, int]]:
    """(offset, level) of the natural boundaries, ascending; an offset stands before the white space it cuts at."""
    out = []
    for m in _CUT.finditer(text):
        if m.start():
            out.append((m.start(), _LEVEL[m.lastgroup]))
    return out


def grid(limit: int, overlap: int) -> tuple[int, int]:
    """S and W: tokens between points of the grid, and tokens before a point in which a cut is looked for."""
    room = limit - overlap - SLACK
    if room < 8:
        raise ValueError("the limit leaves no room beside the overlap")
    step = room * 4 // 5
    return step, room - step


def marks(text: str, begins: bool, grid_of: Callable[[int, int], list[int]]) -> tuple[list[int], list[int]]:
    """Offsets and levels of the marks of a stretch of text, ascending, by its characters alone.

    ``begins``: the stretch begins where the text does; ``grid_of(a, b)``: the offsets in steps of a
    fixed size that lie between a and b. What stands within FINE characters of the stretch's ends
    may differ from what the whole text has.
    """
    at: list[int] = []
    level: list[int] = []

    def put(o: int, k: int) -> None:
        if not at or o > at[-1]:
            at.append(o)
            level.append(k)
        elif o == at[-1]:
            level[-1] = max(level[-1], k)

    a = 0
    for b, k in [*boundaries(text), (len(text), NONE)]:
        if b - a > FINE:
            x = a
            for y in [m.start() for m in _SPACE.finditer(text, a + 1, b)] + [b]:
                if y - x > FINE:
                    for o in grid_of(x + 1, y):
                        put(o, NONE)
                if y < b:
                    put(y, SPACE)
                x = y
        if b < len(text) and (b or not begins):
            put(b, k)
        a = b
    return at, level


class Units:
    """The marks of a stretch of text from ``first`` to ``last``, which are marks or its ends, with the tokens before each.

    Units between marks with more than ``fine`` tokens have marks inside: at white space, and in words of more than that in steps.
    """

    def __init__(self, text: str, path: str, fine: int, first: int = 0, last: int | None = None, known: tuple[list[int], list[int]] | None = None, steps: Steps | None = None):
        self.text, self.counts = text, tokenizer(path).counts
        steps = steps or Steps(text, 0, fine)
        at, level = known or marks(text, True, steps.between)
        last = len(text) if last is None else last
        i, j = bisect.bisect_right(at, first), bisect.bisect_left(at, last)
        end = level[j] if j < len(at) and at[j] == last else PARAGRAPH
        at, level = [first, *at[i:j], last], [PARAGRAPH, *level[i:j], end]
        n = self.counts([text[a:b] for a, b in zip(at, at[1:], strict=False)])
        #: Tokens by the marks of ``known`` alone but for steps; ``total`` is on the scale of all marks.
        self.at, self.level, self.tokens = [first], [PARAGRAPH], [0]
        for a, b, k, size in zip(at, at[1:], level[1:], n, strict=False):
            if size > fine:
                self._refine(a, b, fine, steps)
                a = self.at[-1]
                size = self.counts([text[a:b]])[0]
            if b > a:
                self._mark(b, k, size)

    def _refine(self, a: int, b: int, fine: int, steps: Steps) -> None:
        ends = [m.start() for m in _SPACE.finditer(self.text, a + 1, b)] + [b]
        x = a
        for y, size in zip(ends, self.counts([self.text[x:y] for x, y in zip([a, *ends], ends, strict=False)]), strict=True):
            if size > fine:
                inner = steps.between(x + 1, y)
                for o, n in zip(inner, self.counts([self.text[p:q] for p, q in zip([x, *inner], inner, strict=False)]), strict=True):
                    self._mark(o, NONE, n)
                size = self.counts([self.text[self.at[-1] : y]])[0]
            if y < b:
                self._mark(y, SPACE, size)
            x = y

    def _mark(self, at: int, level: int, size: int) -> None:
        self.at.append(at)
        self.level.append(level)
        self.tokens.append(self.tokens[-1] + size)

    @property
    def total(self) -> int:
        return self.tokens[-1]

    def back(self, i: int, n: int) -> int | None:
        """The last offset that lies at least n tokens before mark i, at a word if one is near; null if the stretch has fewer."""
        end = self.at[i]
        j = bisect.bisect_right(self.tokens, self.tokens[i] - n, 0, i + 1) - 1
        if j < 0:
            return None
        a, b = self.at[j], self.at[min(j + 1, i)]
        want = n - (self.tokens[i] - self.tokens[min(j + 1, i)])  # tokens of the unit behind mark j that are in the overlap
        if want <= 0 or b <= a:
            return b if want <= 0 else a
        lo, hi = a, b
        while hi - lo > 1:
            mid = (lo + hi) // 2
            if self.counts([self.text[mid:b]])[0] >= want:
                lo = mid
            else:
                hi = mid
        if near := max((m.start() for m in _SPACE.finditer(self.text, max(a, lo - 32), lo + 1)), default=None):
            lo = near
        # Inside unbroken text, parts have more tokens than the whole.
        while lo and (have := self.counts([self.text[lo:end]])[0]) < n:
            lo = max(0, lo - (n - have))
        return min(lo, end)


class Steps:
    """Offsets in steps of a fixed size, of characters from the text's beginning, or of bytes from a file's."""

    def __init__(self, text: str, at: int, fine: int, in_bytes: bool = False):
        self.text, self.at, self.size, self.in_bytes = text, at, max(1, fine // CHAR_TOKENS), in_bytes

    def between(self, a: int, b: int) -> list[int]:
        """Those in [a, b): where a step is inside a character, the next character."""
        if not self.in_bytes:
            return list(range(a + (-(self.at + a)) % self.size, b, self.size))
        out, o = [], self.at + len(self.text[:a].encode())
        before = (o - 1) // self.size if o else -1
        for k in range(a, b):
            if o // self.size != before if o % self.size == 0 else (o - 1) // self.size != before and k > a:
                out.append(k)
            before = (o - 1) // self.size
            o += len(self.text[k].encode())
        return out


def best_cuts(u: Units, base: int, total: int, step: int, width: int) -> list[tuple[int, int, int]]:
    """(k, level, mark): for each point of the grid the best mark of the stretch, its first one left out."""
    out: dict[int, tuple[int, int]] = {}
    n_cuts = -(-total // step) - 1
    for i, (level, t) in enumerate(zip(u.level, u.tokens, strict=True)):
        k = -(-(base + t) // step)
        if i and 1 <= k <= n_cuts and base + t > k * step - width and (k not in out or (level, i) > out[k]):
            out[k] = (level, i)
    return [(k, level, i) for k, (level, i) in sorted(out.items())]


# ---- texts of one range ---------------------------------------------------------------------------

_PIECE = "doc_id long, piece_no int, first_char long, end_char long, overlap_chars int, n_tokens int, cut_at string, text string"
_PIECE_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("piece_no", pa.int32()), ("first_char", pa.int64()), ("end_char", pa.int64()), ("overlap_chars", pa.int32()), ("n_tokens", pa.int32()), ("cut_at", pa.string()), ("text", pa.string())]
)


def fitted(text: str, begin: int, cut_from: int, end: int, limit: int, path: str) -> list[tuple[int, int, int]]:
    """(begin, end, tokens) of a piece, or of its parts: its overlap is given up where counts of parts belied the whole,
    and what is above the limit even so is halved at the white space next to its middle, if there is any."""
    count = tokenizer(path).count
    n = count(text[begin:end])
    while n > limit and begin < cut_from:
        begin = min(cut_from, begin + n - limit)
        n = count(text[begin:end])
    if n <= limit or end - begin < 2:
        return [(begin, end, n)]
    middle = (begin + end) // 2
    half = next((m.start() for m in _SPACE.finditer(text, middle, end - 1)), middle)
    return [*fitted(text, begin, begin, half, limit, path), *fitted(text, half, half, end, limit, path)]


def pieces_of(text: str, limit: int, overlap: int, path: str) -> list[tuple[int, int, int, int, int, str]]:
    """(piece_no, first_char, end_char, overlap_chars, n_tokens, kind of the cut behind) of a whole text."""
    if len(text) <= limit // CHAR_TOKENS or (n := tokenizer(path).count(text)) <= limit:
        return [(0, 0, len(text), 0, tokenizer(path).count(text) if len(text) <= limit // CHAR_TOKENS else n, "end")]
    step, width = grid(limit, overlap)
    u = Units(text, path, width // 2)
    out = []
    begin = mark = 0
    for no, (_, level, i) in enumerate([*best_cuts(u, 0, u.total, step, width), (0, -1, len(u.at) - 1)]):
        for a, z, n in fitted(text, begin, mark, u.at[i], limit, path):
            out.append((no, a, z, max(0, mark - a), n, KINDS[level] if level >= 0 else "end"))
        mark = u.at[i]
        begin = (u.back(i, overlap) or 0) if overlap else mark
    return out


def _whole(limit: int, overlap: int, path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc, text in zip(b["doc_id"].to_pylist(), b["text"].to_pylist(), strict=True):
                for k, a, z, over, n, kind in pieces_of(text, limit, overlap, path):
                    rows.append((doc, k, a, z, over, n, kind, text[a:z]))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * 8, _PIECE_ARROW, strict=True)], schema=_PIECE_ARROW)

    return run


# ---- giant texts, by ranges ------------------------------------------------------------------------
#
# A range is a row: row_key, doc_id (or file), range_no, at (offset of its chunk), chunk (the range
# with halos), lead (characters of the halo before it), span (characters of the range), total (size
# of the whole), ends (whether it is the last). Offsets are characters of a column's text, or bytes of a file.


def _halo(size: int, in_bytes: bool = False) -> int:
    return max(size // 8, 4 * FINE * (4 if in_bytes else 1))


class _Own:
    """A range's own stretch of its chunk: from the first mark at or behind where it nominally begins to the first at or behind where it ends."""

    def __init__(self, r, fine: int, in_bytes: bool):
        self.chunk, self.first_range = r.chunk, r.range_no == 0
        self.steps = Steps(r.chunk, int(r.at), fine, in_bytes)
        self.known = marks(r.chunk, int(r.at) == 0, self.steps.between)
        self.first = 0 if self.first_range else self._next(int(r.lead))
        self.last = len(r.chunk) if r.ends else self._next(int(r.lead) + int(r.span))

    def _next(self, nominal: int) -> int:
        i = bisect.bisect_left(self.known[0], nominal)
        return self.known[0][i] if i < len(self.known[0]) else len(self.chunk)

    def units(self, path: str, fine: int, first: int | None = None, last: int | None = None) -> Units:
        return Units(self.chunk, path, fine, self.first if first is None else first, self.last if last is None else last, self.known, self.steps)


def ranges(documents: DataFrame, size: int = RANGE) -> DataFrame:
    """Ranges of ``size`` characters of the texts of (row_key, doc_id, text): a text is gone through once."""
    halo = _halo(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for key, doc, text in zip(*(b[c].to_pylist() for c in ("row_key", "doc_id", "text")), strict=True):
                n, rows = len(text), []
                for no in range(-(-n // size)):
                    start = no * size
                    low, high = max(0, start - halo), min(n, start + size + halo)
                    rows.append((key, doc, no, low, text[low:high], start - low, min(size, n - start), n, start + size >= n))
                    if len(rows) == 64 or start + size >= n:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _CHUNK, strict=True)], schema=_CHUNK)
                        rows = []

    return documents.select("row_key", "doc_id", "text").mapInArrow(run, "row_key long, doc_id long, range_no int, at long, chunk string, lead int, span int, total long, ends boolean")


_CHUNK = pa.schema([("row_key", pa.int64()), ("doc_id", pa.int64()), ("range_no", pa.int32()), ("at", pa.int64()), ("chunk", pa.string()), ("lead", pa.int32()), ("span", pa.int32()), ("total", pa.int64()), ("ends", pa.bool_())])


def _counted(limit: int, overlap: int, path: str, in_bytes: bool):
    _, width = grid(limit, overlap)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = tokenizer(path).count
        for b in batches:
            own = [_Own(r, width // 2, in_bytes) for r in b.itertuples(index=False)]
            n = [o.units(path, width // 2).total if o.first < o.last else 0 for o in own]
            yield pd.DataFrame({"row_key": b["row_key"], "range_no": b["range_no"], "n": n, "plain": [count(o.chunk[o.first : o.last]) for o in own]})

    return run


def _candidates(limit: int, overlap: int, path: str, in_bytes: bool):
    step, width = grid(limit, overlap)
    fine = width // 2

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for r in b.itertuples(index=False):

                def offset(o: int, r=r) -> int:
                    return int(r.at) + (len(r.chunk[:o].encode()) if in_bytes else o)

                if r.plain <= limit:
                    continue
                own = _Own(r, fine, in_bytes)
                if own.first >= own.last:
                    continue
                u = own.units(path, fine)
                for k, level, i in best_cuts(u, int(r.base), int(r.all), step, width):
                    o = u.at[i]
                    if not overlap:
                        back = o
                    elif (back := u.back(i, overlap)) is None:  # the overlap begins before the range: in its halo, or where the text does
                        before = own.units(path, fine, 0 if int(r.at) == 0 else own._next(FINE), o)
                        back = before.back(len(before.at) - 1, overlap) or 0
                    rows.append((r.row_key, r.doc_id, k, level, offset(o), offset(back)))
            yield pd.DataFrame(rows, columns=["row_key", "doc_id", "k", "level", "cut_at", "back_at"])

    return run


def _spans(spread: DataFrame, limit: int, overlap: int, path: str, in_bytes: bool) -> DataFrame:
    """row_key, doc_id, piece_no, first, end, mark (where the overlap ends), kind: pieces by offset."""
    kind = spread.schema["doc_id"].dataType.simpleString()
    counted = cut(spread.select("row_key", "range_no", "at", "lead", "span", "chunk", "ends").mapInPandas(_counted(limit, overlap, path, in_bytes), "row_key long, range_no int, n long, plain long"), "counted")
    by_range = Window.partitionBy("row_key").orderBy("range_no")
    sums = counted.select(
        "row_key",
        "range_no",
        F.coalesce(F.sum("n").over(by_range.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"),
        F.sum("n").over(Window.partitionBy("row_key")).alias("all"),
        F.sum("plain").over(Window.partitionBy("row_key")).alias("plain"),
    )
    found = spread.join(sums, ["row_key", "range_no"]).mapInPandas(_candidates(limit, overlap, path, in_bytes), f"row_key long, doc_id {kind}, k int, level int, cut_at long, back_at long")
    # Neighbouring ranges may both have a mark for a point of the grid: the better one counts, of equals the later.
    cuts = found.groupBy("row_key", "doc_id", "k").agg(F.max(F.struct("level", "cut_at", "back_at")).alias("c")).select("row_key", "doc_id", "k", "c.*")
    zero = F.lit(0).cast("long")
    ends = spread.where("range_no = 0").select("row_key", "doc_id", F.lit((1 << 31) - 1).alias("k"), F.lit(-1).alias("level"), F.col("total").alias("cut_at"), zero.alias("back_at"))
    by_cut = Window.partitionBy("row_key").orderBy("k")
    return cuts.unionByName(ends).select(
        "row_key",
        "doc_id",
        (F.row_number().over(by_cut) - 1).alias("piece_no"),
        F.coalesce(F.lag("back_at").over(by_cut), zero).alias("first"),
        F.col("cut_at").alias("end"),
        F.coalesce(F.lag("cut_at").over(by_cut), zero).alias("mark"),
        F.when(F.col("level") < 0, "end").otherwise(F.element_at(F.array(*map(F.lit, KINDS)), F.greatest(F.col("level"), F.lit(0)) + 1)).alias("kind"),
    )


def _exact(limit: int, path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for r in b.itertuples(index=False):
                over = int(r.mark - r.first)
                for a, z, n in fitted(r.text, 0, over, len(r.text), limit, path):
                    rows.append((r.doc_id, r.piece_no, r.first + a, r.first + z, max(0, over - a), n, r.kind, r.text[a:z]))
            yield pd.DataFrame(rows, columns=["doc_id", "piece_no", "first_char", "end_char", "overlap_chars", "n_tokens", "cut_at", "text"])

    return run


def giant_pieces(documents: DataFrame, limit: int, overlap: int, path: str, size: int = RANGE) -> DataFrame:
    """Pieces of texts of more than one range."""
    keyed = documents.select(F.monotonically_increasing_id().alias("row_key"), "doc_id", "text")
    tasks = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = cut(ranges(cut(keyed, "giant"), size).repartition(tasks, "row_key", "range_no"), "ranges")
    spans = cut(_spans(spread, limit, overlap, path, False), "spans")
    # Nearly every piece lies in the chunk of the range that it ends in.
    owned = spans.withColumn("range_no", F.floor((F.col("end") - 1) / size).cast("int")).join(spread.select("row_key", "range_no", "at", "chunk"), ["row_key", "range_no"])
    columns = ["row_key", "doc_id", "piece_no", "first", "end", "mark", "kind"]
    near = owned.where("first >= at").select(*columns, F.substring("chunk", (F.col("first") - F.col("at")).cast("int") + 1, (F.col("end") - F.col("first")).cast("int")).alias("text"))
    # One that is longer than a halo is put together from its ranges.
    far = owned.where("first < at").select(*columns, F.explode(F.sequence(F.floor(F.col("first") / size).cast("int"), F.col("range_no"))).alias("range_no"))
    start = F.greatest(F.col("first"), F.col("range_no").cast("long") * size)
    part = F.substring("chunk", (start - F.col("at")).cast("int") + 1, (F.least("end", (F.col("range_no").cast("long") + 1) * size) - start).cast("int"))
    parts = far.join(spread.select("row_key", "range_no", "at", "chunk"), ["row_key", "range_no"]).select(*columns, F.struct("range_no", part.alias("t")).alias("p"))
    whole = parts.groupBy(*columns).agg(F.array_join(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["t"]), "").alias("text"))
    return near.unionByName(whole).mapInPandas(_exact(limit, path), _PIECE)


# ---- files, without loading any as a whole -------------------------------------------------------------


def _open(uri: str):
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(uri)
    return system.open_input_file(name)


def _decoded(data: bytes) -> str:
    """Text of the same length in bytes: a byte that is no UTF-8 is one question mark."""
    out, at = [], 0
    while True:
        try:
            return "".join([*out, data[at:].decode()])
        except UnicodeDecodeError as e:
            out.append(data[at : at + e.start].decode() + "?" * (e.end - e.start))
            at += e.end


def _aligned(data: bytes, at: int) -> int:
    """The first place at or behind ``at`` where a character begins."""
    for k in range(at, min(at + 4, len(data))):
        if data[k] & 0xC0 != 0x80:
            return k
    return min(at, len(data))


_RANGE = "row_key long, doc_id string, range_no int, at long, chunk string, lead int, span int, total long, ends boolean"


def file_ranges(spark: SparkSession, path: str, size: int = RANGE) -> DataFrame:
    """Ranges of ``size`` bytes of the files under ``path``: each task reads only its bytes and their halos."""
    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")  # names and sizes alone
    each = files.select(F.monotonically_increasing_id().alias("row_key"), "path", "length").withColumn("range_no", F.explode(F.sequence(F.lit(0), F.floor((F.col("length") - 1) / size).cast("int"))))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for r in b.itertuples(index=False):
                start = int(r.range_no) * size
                low = max(0, start - _halo(size, True))
                with _open(r.path) as f:
                    f.seek(low)
                    data = f.read(min(int(r.length), start + size + _halo(size, True)) - low)
                first = _aligned(data, 0) if low else 0
                last = len(data) if low + len(data) == r.length else _whole_characters(data)
                a, z = _aligned(data, start - low), _aligned(data, min(start + size - low, last))
                rows.append((r.row_key, r.path, r.range_no, low + first, _decoded(data[first:last]), len(_decoded(data[first:a])), len(_decoded(data[a:z])), r.length, start + size >= r.length))
            yield pd.DataFrame(rows, columns=["row_key", "doc_id", "range_no", "at", "chunk", "lead", "span", "total", "ends"])

    return each.repartition(tasks, "row_key", "range_no").mapInPandas(run, _RANGE)


def _whole_characters(data: bytes) -> int:
    """The length of ``data`` without a character that is cut off at its end."""
    for k in range(1, min(4, len(data)) + 1):
        c = data[-k]
        if c & 0xC0 != 0x80:
            need = 4 if c >= 0xF0 else 3 if c >= 0xE0 else 2 if c >= 0xC0 else 1
            return len(data) if k >= need else len(data) - k
    return len(data)


def file_pieces(spark: SparkSession, path: str, limit: int = LIMIT, overlap: int = OVERLAP, tokens: str = DEFAULT, size: int = RANGE) -> DataFrame:
    """path, piece_no, first_byte, end_byte, overlap_bytes, n_tokens, cut_at, text of the files under ``path``."""
    spread = cut(file_ranges(spark, path, size), "ranges")
    spans = cut(_spans(spread, limit, overlap, tokens, True), "spans")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for r in b.itertuples(index=False):
                with _open(r.doc_id) as f:
                    f.seek(int(r.first))
                    data = f.read(int(r.end - r.first))
                text, over = _decoded(data), len(_decoded(data[: int(r.mark - r.first)]))
                for a, z, n in fitted(text, 0, over, len(text), limit, tokens):
                    start, stop = len(text[:a].encode()), len(text[:z].encode())
                    rows.append((r.doc_id, r.piece_no, r.first + start, r.first + stop, max(0, r.mark - r.first - start), n, r.kind, text[a:z]))
            yield pd.DataFrame(rows, columns=["path", "piece_no", "first_byte", "end_byte", "overlap_bytes", "n_tokens", "cut_at", "text"])

    return spans.mapInPandas(run, "path string, piece_no int, first_byte long, end_byte long, overlap_bytes long, n_tokens int, cut_at string, text string")


def pieces(documents: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP, path: str = DEFAULT, size: int = RANGE) -> DataFrame:
    """The ordered pieces of every text, each within the limit, with offsets, text and exact token count."""
    rows = documents.where(F.length("text") > 0).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    small = rows.where(F.length("text") <= size).mapInArrow(_whole(limit, overlap, path), _PIECE)
    return small.unionByName(giant_pieces(rows.where(F.length("text") > size), limit, overlap, path, size))
