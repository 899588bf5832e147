"""Problem 7 against a plain grouping."""

import random
from collections import defaultdict
from urllib.parse import unquote

import pytest

from newsloom.operators import format_dedup

DDL = "ordinal long, title string, url string, meta map<string,string>, part int, title_key string"


def frame(spark, rows):
    return spark.createDataFrame([(o, t, u, None, 0, "x") for o, t, u in rows], DDL)


def plain(rows):
    groups = defaultdict(list)
    for o, t, u in rows:
        if not t or not t.strip(" \t\n﻿　​") or not u or not u.strip():
            continue
        parts = ["".join(c for c in p.casefold() if c.isalnum()) for p in t.split("|")]
        key = min("".join(x) for x in ([parts, parts[::-1]] if len(parts) == 2 else [parts]))
        u = u.strip()
        scheme, _, rest = u.partition("://")
        head, _, query = rest.partition("?")
        host, _, path = head.partition("/")
        groups[key, scheme.lower(), host.lower(), unquote(path.removesuffix("/")), tuple(sorted(map(unquote, query.split("&"))))].append(o)
    return sorted((min(g), o) for g in groups.values() for o in g if o != min(g))


CASES = [
    (1, "Foo Bar: baz", "https://a.example/P/x"), (2, " FOO  bar baz ", "HTTPS://A.example/P/x/"), (3, "Foo Bar: baz", "https://a.example/p/x"),
    (4, "Straße | Ort", "https://a.example/q?b=2&a=1"), (5, "ORT | STRASSE", "https://A.EXAMPLE/q?a=1&b=2"), (6, "Ort Straße", "https://a.example/q?a=1&b=2"),
    (7, "里", "https://a.example/%E9%87%8C"), (8, "里。", "https://a.example/里"), (9, "里", "https://a.example/%e9%87%8c/"),
    (10, None, "https://a.example"), (11, "x", None), (12, "  ", "https://a.example"), (13, "x", " "), (14, "!!!", "https://z.example"), (15, "??", "https://z.example/"),
    (16, "x", "no url"), (17, "X", "no url"),
]


def pairs(df):
    return sorted((r.first_ordinal, r.copy_ordinal) for r in df.collect())


def test_cases(spark):
    assert pairs(format_dedup.copies(frame(spark, CASES), 3)) == [(1, 2), (4, 5), (4, 6), (7, 8), (7, 9), (14, 15), (16, 17)]


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_hot_group_over_several_partitions(spark, parts):
    rng = random.Random(5)
    rows = []
    for o in range(600):
        n = 0 if rng.random() < 0.4 else rng.randrange(200)
        rows.append((o, rng.choice(["Title {} x", " title {}  X!", "TITLE: {} x"]).format(n), rng.choice(["https://h.example/{}?a=1&b=2", "HTTPS://H.example/{}/?b=2&a=1"]).format(n)))
    rng.shuffle(rows)
    df = frame(spark, rows).repartition(5)
    assert pairs(format_dedup.copies(df, parts)) == plain(rows)
    counts = {r.first_ordinal: r.n_copies for r in format_dedup.records(df, parts).collect()}
    assert sum(counts.values()) == 600 and len(counts) == 600 - len(plain(rows))


def test_one_group_alone(spark):
    rows = [(o, "Same", "https://h.example/") for o in range(50)]
    assert pairs(format_dedup.copies(frame(spark, rows), 7)) == [(0, o) for o in range(1, 50)]


def test_empty(spark):
    assert format_dedup.copies(frame(spark, CASES).limit(0)).count() == 0
    assert format_dedup.records(frame(spark, CASES).limit(0)).count() == 0


def test_very_long_texts(spark):
    rows = [(1, "ab " * 60_000, "https://h.example/" + "x" * 50_000), (2, "AB" * 60_000, "https://h.example/" + "x" * 50_000 + "/")]
    assert pairs(format_dedup.copies(frame(spark, rows), 2)) == [(1, 2)]
