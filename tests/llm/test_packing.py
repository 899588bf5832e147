"""Problem 8: every token in exactly one place, no text split that fits, little waste."""

import random
from collections import defaultdict

import pytest

from newsloom.llm import packing as P
from newsloom.llm.tokens import DEFAULT, tokenizer


def docs(spark, n=3000, seed=2):
    rng = random.Random(seed)
    rows = [(i, "word " * max(1, int(rng.lognormvariate(3, 1.2))), "x", 1) for i in range(n)]
    rows += [(-1, None, "x", 1), (-2, "", "x", 1), (-3, "long " * 5000, "x", 1), (-4, "x" * 30_000, "x", 1), (5, "word again", "x", 1), (5, "word again", "x", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, parts string, used int")


@pytest.mark.parametrize("separator", [0, 1])
def test_round_trip_and_waste(spark, separator):
    df = docs(spark).repartition(6)
    packed = P.packed(df, capacity=512, open_bins=32, separator=separator)
    rows = packed.collect()
    count = tokenizer(DEFAULT).count
    want = defaultdict(list)
    for r in df.collect():
        if r.text:
            want[r.doc_id].append(count(r.text))
    got = defaultdict(list)
    for r in rows:
        assert r.n_tokens == sum(p.n_tokens for p in r.parts) + separator * (len(r.parts) - 1) <= 512 and r.waste == 512 - r.n_tokens
        for p in r.parts:
            got[p.doc_id].append((p.piece_no, p.first_token, p.n_tokens))
    for d, sizes in want.items():
        assert sum(n for _, _, n in got[d]) == sum(sizes)
        if max(sizes) <= 512:  # never split
            assert sorted(n for _, _, n in got[d]) == sorted(sizes)
        else:
            pieces = sorted(got[d])
            assert [p[0] for p in pieces] == list(range(len(pieces))) and all(n == 512 for _, _, n in pieces[:-1])
    assert set(got) == set(want) and -1 not in got and -2 not in got
    assert sum(r.waste for r in rows) < 0.02 * 512 * len(rows)
    assert len({r.seq_no for r in rows}) == len(rows)
    assert P.assignments(packed).count() == sum(len(v) for v in got.values())


def test_best_fit_takes_the_fullest_bin_that_fits():
    closed = []
    p = P.Packer(10, 3, lambda parts, used: closed.append((parts, used)))
    for name, size in [("a", 4), ("b", 7), ("c", 9), ("d", 3), ("e", 6), ("f", 5)]:
        p.add([name], size)
    # d goes to b (3 free), e to a (6 free); f opens a bin.
    assert closed == [(["b", "d"], 10), (["a", "e"], 10)]
    assert sorted(used for _, used in p.rest()) == [5, 9]


def test_the_fullest_closes_first():
    closed = []
    p = P.Packer(10, 2, lambda parts, used: closed.append(used))
    for size in (6, 8, 7):
        p.add([size], size)
    assert closed == [8]


@pytest.mark.parametrize("separator", [0, 1, 3])
def test_a_text_of_exactly_the_capacity_is_one_sequence(spark, separator):
    text = "word " * 700
    n = tokenizer(DEFAULT).count(text)
    df = spark.createDataFrame([(1, text), (2, text + text), (3, text + "word ")], "doc_id long, text string")
    rows = {tuple((p.doc_id, p.piece_no, p.n_tokens) for p in r.parts): r.waste for r in P.packed(df, capacity=n, separator=separator).collect()}
    assert rows[(1, 0, n),] == 0 and rows[(3, 0, n),] == 0
    assert len(rows) in (4, 5) and sum(p[2] for parts in rows for p in parts) == n + sum(tokenizer(DEFAULT).count(t) for t in (text + text, text + "word "))


def test_no_round_holds_more_than_its_open_bins(spark, monkeypatch):
    """Many tasks leave many open bins; the rounds after the first are bounded too."""
    most = []
    put = P.Packer._put
    monkeypatch.setattr(P.Packer, "_put", lambda self, parts, free: (put(self, parts, free), most.append(self.n))[0])
    packer = P.Packer(512, 8, lambda parts, used: None)
    rng = random.Random(3)
    for i in range(4000):
        packer.add([i], rng.randrange(1, 512))
    assert max(most) <= 8
    df = docs(spark, 2000).repartition(16)
    numbers = [r.seq_no for r in P.packed(df, capacity=512, open_bins=8).collect()]
    assert len(set(numbers)) == len(numbers)


def test_empty(spark):
    assert P.packed(docs(spark, 1).limit(0)).count() == 0
