"""Texts packed into sequences of one fixed token capacity (problem 8).

Online best fit with bounded space: a task keeps at most so many bins open; a bitset over free
space finds the bin that a text fits best; when no bin fits and no more may be opened, the fullest
is closed. Bins that are still open when a task ends are items of the next round: the same packer,
with the same number of open bins, takes them in as they come, in fewer and fewer tasks, so what
is wasted at the ends doesn't grow with the number of tasks.

Only a text above the capacity is split: into full sequences and a rest, which is an item.

Defined results: null and empty texts are in no sequence; repeated rows are packed each; between
two items of a sequence stands a separator, behind the last none, so a text of exactly the
capacity is one sequence; the number of a sequence is that of its round, task and place.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.tokens import DEFAULT, tokenizer
from newsloom.runtime import cut

CAPACITY = 2048
#: Bins that a task keeps open.
OPEN_BINS = 128
#: Open bins that one task packs again.
REPACKED = 20_000

Part = tuple[int, int, int, int]  # doc_id, piece_no, first token, tokens


class Packer:
    """Bounded-space best fit; ``close`` gets the parts and the used space of each bin that is closed."""

    def __init__(self, capacity: int, open_bins: int, close):
        self.capacity, self.open_bins, self.close = capacity, open_bins, close
        self.bits = 0  # bit f: some open bin has f free
        self.bins: dict[int, list[list]] = {}
        self.n = 0

    def add(self, parts: list, size: int) -> None:
        above = self.bits >> size
        if above:
            free = size + (above & -above).bit_length() - 1
            old = self._take(free)
            old.extend(parts)
            self._put(old, free - size)
        else:
            if self.n == self.open_bins:
                fullest = (self.bits & -self.bits).bit_length() - 1
                self.close(self._take(fullest), self.capacity - fullest)
            self._put(list(parts), self.capacity - size)

    def _take(self, free: int) -> list:
        same = self.bins[free]
        out = same.pop()
        if not same:
            del self.bins[free]
            self.bits &= ~(1 << free)
        self.n -= 1
        return out

    def _put(self, parts: list, free: int) -> None:
        if not free:
            self.close(parts, self.capacity)
            return
        self.bins.setdefault(free, []).append(parts)
        self.bits |= 1 << free
        self.n += 1

    def rest(self) -> Iterator[tuple[list, int]]:
        for free, same in self.bins.items():
            for parts in same:
                yield parts, self.capacity - free


_PART = pa.struct([("doc_id", pa.int64()), ("piece_no", pa.int32()), ("first_token", pa.int64()), ("n_tokens", pa.int32())])
_SCHEMA = pa.schema([("task", pa.int64()), ("no", pa.int64()), ("open", pa.bool_()), ("used", pa.int32()), ("parts", pa.list_(_PART))])
_DDL = "task long, no long, open boolean, used int, parts array<struct<doc_id:long,piece_no:int,first_token:long,n_tokens:int>>"


class _Out:
    """Closed and open bins of a task as rows; ``used`` counts no separator behind the last part."""

    def __init__(self, separator: int):
        self.task, self.separator, self.no = TaskContext.get().partitionId(), separator, 0
        self.waiting: list[tuple[bool, int, list]] = []

    def closed(self, parts: list, used: int) -> None:
        self.waiting.append((False, used, parts))

    def rows(self, at_least: int = 0) -> Iterator[pa.RecordBatch]:
        out = self.waiting
        if len(out) < at_least:
            return
        parts = [[{"doc_id": d, "piece_no": p, "first_token": f, "n_tokens": n} for d, p, f, n in parts] for _, _, parts in out]
        columns = [
            pa.array([self.task] * len(out), pa.int64()), pa.array(range(self.no, self.no + len(out)), pa.int64()), pa.array([o for o, _, _ in out], pa.bool_()),
            pa.array([u - self.separator for _, u, _ in out], pa.int32()), pa.array(parts, pa.list_(_PART)),
        ]
        self.no += len(out)
        self.waiting = []
        yield pa.RecordBatch.from_arrays(columns, schema=_SCHEMA)

    def last(self, packer: Packer) -> Iterator[pa.RecordBatch]:
        self.waiting += [(True, used, parts) for parts, used in packer.rest()]
        yield from self.rows()


# A bin has room for one separator more than its capacity, and every item brings one: the last one's is not there.


def _pack(capacity: int, open_bins: int, separator: int, path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = tokenizer(path).counts
        out = _Out(separator)
        packer = Packer(capacity + separator, open_bins, out.closed)
        for b in batches:
            for doc, n in zip(b["doc_id"].to_pylist(), counts(b["text"].to_pylist()), strict=True):
                for piece in range(-(-n // capacity)):
                    size = min(capacity, n - piece * capacity)
                    packer.add([(doc, piece, piece * capacity, size)], size + separator)
            yield from out.rows(1000)
        yield from out.last(packer)

    return run


def _repack(capacity: int, open_bins: int, separator: int):
    """Open bins as items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(separator)
        packer = Packer(capacity + separator, open_bins, out.closed)
        for b in batches:
            for r in b.to_pylist():
                packer.add([(p["doc_id"], p["piece_no"], p["first_token"], p["n_tokens"]) for p in r["parts"]], r["used"] + separator)
            yield from out.rows(1000)
        yield from out.last(packer)

    return run


def packed(documents: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS, separator: int = 1, path: str = DEFAULT) -> DataFrame:
    """seq_no, n_tokens, waste, parts: one row a sequence; parts are pieces of documents in order."""
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.length("text") > 0)
    stage = cut(texts.mapInArrow(_pack(capacity, open_bins, separator, path), _DDL), "packed").withColumn("round", F.lit(0))
    done, left = stage.where("not open"), stage.where("open")
    n = left.count()
    for number in range(1, 32):
        tasks = max(1, -(-n // REPACKED))
        again = cut(left.drop("round").repartition(tasks, "task", "no").mapInArrow(_repack(capacity, open_bins, separator), _DDL), "packed").withColumn("round", F.lit(number))
        done, left = done.unionByName(again.where("not open")), again.where("open")
        before, n = n, 0 if tasks == 1 else left.count()
        if tasks == 1 or n > before // 2:  # nothing more to gain by packing them once more
            break
    number = F.shiftleft(F.col("round").cast("long"), 58) + F.shiftleft("task", 32) + F.col("no")
    return done.unionByName(left).select(number.alias("seq_no"), F.col("used").alias("n_tokens"), (F.lit(capacity) - F.col("used")).alias("waste"), "parts")


def assignments(sequences: DataFrame) -> DataFrame:
    """seq_no, position, doc_id, piece_no, first_token, n_tokens: one row a piece."""
    return sequences.select("seq_no", F.posexplode("parts").alias("position", "p")).select("seq_no", "position", "p.*")
