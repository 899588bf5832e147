"""Problem 1: batches against brute force, whatever the batches; keys; hot summaries."""

import datetime as dt
import random

import pytest

from newsloom.llm import history as H

UTC = dt.timezone.utc
DDL = "ordinal long, id string, url string, summary string, first_seen_at timestamp, u string, h1 long, shard int"
WORDS = [f"w{i}" for i in range(400)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], DDL)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def brute(rows):
    parent = {r[0]: r[0] for r in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    words = {r[0]: (r[3] or "").lower().replace(".", "").split() for r in rows}
    for i, a in enumerate(rows):
        for b in rows[:i]:
            x, y = words[a[0]], words[b[0]]
            near = x and y and distance(x, y) <= min(2, (max(len(x), len(y)) - 1) // 3)
            if (a[1] and a[1] == b[1]) or (a[2] and a[2] == b[2]) or near:
                p, q = sorted((find(a[0]), find(b[0])))
                parent[q] = p
    return {(find(x), x) for x in parent if find(x) != x}


def made(n, seed):
    rng = random.Random(seed)
    rows = []
    for o in range(n):
        kind = rng.random()
        words = [rng.choice(WORDS) for _ in range(rng.choice([1, 3, 5, 9, 20, 24, 31]))]
        if rows and kind < 0.5:
            words = (rng.choice(rows)[3] or "w1").split()
            for _ in range(rng.choice([0, 1, 2, 2, 3, 4])):
                i = rng.randrange(len(words) + 1)
                what = rng.randrange(3)
                if what == 0:
                    words.insert(i, rng.choice(WORDS))
                elif words and what == 1:
                    del words[min(i, len(words) - 1)]
                elif words:
                    words[min(i, len(words) - 1)] = rng.choice(WORDS)
        clock = dt.datetime(2025, 10, 1, tzinfo=UTC) + dt.timedelta(hours=o // 20)
        rows.append((o, f"i{o}" if rng.random() < 0.95 else f"i{rng.randrange(o + 1)}", f"https://a.example/{o}", " ".join(words) or None, clock))
    return rows


def pairs(df):
    return {(r.kept_ordinal, r.dup_ordinal) for r in df.collect()}


@pytest.mark.parametrize("calls", [1, 2, 5])
def test_against_brute_force(spark, calls):
    rows = made(260, 11)
    assert pairs(H.replay(frame(spark, rows), calls).repeats()) == brute(rows)


def test_any_division_into_runs_gives_the_same(spark):
    """The same rows as one run, as two, and as 240 by one call: brute force each time."""
    base = made(480, 23)
    for runs in (1, 2, 240):
        rows = [(*r[:4], dt.datetime(2025, 10, 1, tzinfo=UTC) + dt.timedelta(hours=r[0] * runs // len(base))) for r in base]
        assert pairs(H.replay(frame(spark, rows), 1).repeats()) == brute(rows)


def test_parts_are_merged_logarithmically(spark):
    rows = made(120, 4)
    path = H.History(spark).path
    for k in range(6):
        h = H.History(spark, path, shards=3)  # opened again each time: it goes on from the manifest
        h.accept(frame(spark, rows[20 * k : 20 * k + 20]))
        assert [p.runs for p in h.parts] == {1: [1], 2: [2], 3: [2, 1], 4: [4], 5: [4, 1], 6: [4, 2]}[k + 1]
    assert pairs(h.repeats()) == brute(rows)


def test_shards_double_without_writing_anything_again(spark, monkeypatch):
    rows = made(240, 5)
    h = H.History(spark, shards=2)
    monkeypatch.setattr(H, "SHARD_RECORDS", 30)
    for k, n in enumerate((120, 60, 40)):
        a = sum((120, 60, 40)[:k])
        h.accept(frame(spark, rows[a : a + n]), n // 20)
    assert h.shards == 8 and [p.shards for p in h.parts] == [4, 8, 8]
    assert pairs(h.repeats()) == brute(rows[:220])


def test_a_stop_anywhere_leaves_the_history_as_it_was(spark, monkeypatch):
    rows = made(120, 7)
    path = H.History(spark).path
    H.History(spark, path).accept(frame(spark, rows[:60]))

    class Stop(Exception):
        pass

    def stop(*_):
        raise Stop

    before = H.read_state(spark, f"{path}/manifest")
    for name in ("write_state", "_take_in", "_sent"):
        with monkeypatch.context() as m:
            m.setattr(H, name, stop)
            with pytest.raises(Stop):
                H.History(spark, path).accept(frame(spark, rows[60:]))
        assert H.read_state(spark, f"{path}/manifest") == before
    h = H.History(spark, path)
    h.accept(frame(spark, rows[60:]))
    assert pairs(H.History(spark, path).repeats()) == brute(rows)


def test_pages(spark):
    same = [
        ["https://f.example/news?id=3&lang=en", "http://f.example/news?lang=en&id=3", "https://www.f.example/news?id=3&lang=en&from=rss", "https://m.f.example/news?id=3&lang=en&share=1"],
        ["https://vids.example/watch?v=AbC123", "https://vid.example/AbC123", "https://vids.example/shorts/AbC123", "http://www.vids.example/watch?v=AbC123&t=3s", "https://m.vids.example/watch?feature=share&v=AbC123"],
        ["https://vids.example/watch?v=abc123"],
        ["https://f.example/p/1/x", "https://amp.f.example/p/1/x", "https://f.example/p/1/x/amp", "https://f.example/p/1/x/"],
        ["https://f.example/p/1/X"], ["https://f.example/news?id=4&lang=en"], ["no url at all"],
    ]
    rows = [(10 * g + k, None, u, None, None) for g, urls in enumerate(same) for k, u in enumerate(urls)]
    want = {(10 * g, 10 * g + k) for g, urls in enumerate(same) for k in range(1, len(urls))}
    assert pairs(H.replay(frame(spark, rows)).repeats()) == want


def test_hot_summary_and_dirt(spark):
    hot = "the same words stand here in a third of all the rows that there are today"
    rows = [(o, f"i{o}", f"https://a.example/{o}", hot if o % 3 == 0 else (None, " ", "", "!!")[o % 4], None) for o in range(600)]
    rows += [(1000, None, None, None, None), (1001, "", "", "x " * 30_000, None), (1002, " ", " ", "x " * 30_000 + "y", None)]
    rows += [(1003, "i5", None, None, None)]
    want = {(0, o) for o in range(3, 600, 3)} | {(1001, 1002), (5, 1003)}
    assert pairs(H.replay(frame(spark, rows)).repeats()) == want


def test_empty(spark):
    assert pairs(H.replay(frame(spark, made(5, 1)).limit(0)).repeats()) == set()


def test_three_words_apart_are_two_items(spark):
    base = [f"z{i}" for i in range(24)]
    rows = [(0, None, None, " ".join(base), None)]
    for k, at in enumerate([(0, 23), (11, 12), (3, 20), (0, 1)], 1):
        rows.append((k, None, None, " ".join("q" if i in at else w for i, w in enumerate(base)), None))
    rows.append((9, None, None, " ".join("q" if i in (2, 9, 21) else w for i, w in enumerate(base)), None))
    got = {d for _, d in pairs(H.replay(frame(spark, rows)).repeats())}
    assert {1, 2, 3, 4} <= got


def series(seed, n=320):
    """Very many texts that share stretches, near copies of one text and exactly numbered series among them."""
    rng = random.Random(seed)
    base = [f"h{i}" for i in range(26)]
    rows = []
    for o in range(n):
        kind = rng.random()
        if kind < 0.3:
            w = list(base)
        elif kind < 0.5:
            w = base[:9] + [rng.choice(WORDS) for _ in range(rng.choice([4, 8, 15]))]
        elif kind < 0.65:
            w = [rng.choice(WORDS) for _ in range(12)] + base[-9:]
        elif kind < 0.75:
            w = base[:6] + [rng.choice(WORDS) for _ in range(rng.randrange(4))]
        elif kind < 0.87:  # a series whose numbers differ in three words or fewer
            w = base[:12] + [f"n{rng.randrange(6)}" for _ in range(3)] + base[12:20]
        else:
            w = base[3:13] + [f"n{rng.randrange(40)}" for _ in range(rng.randrange(4))]
        for _ in range(rng.randrange(3)):
            k = rng.randrange(len(w))
            w[k : k + rng.randrange(2)] = [rng.choice(WORDS)] * rng.randrange(2)
        rows.append((o, None, None, " ".join(w), dt.datetime(2025, 10, 1, tzinfo=UTC) + dt.timedelta(hours=o // 20)))
    return rows


@pytest.mark.parametrize(("calls", "seed"), [(1, 8), (3, 8), (1, 9), (2, 10)])
def test_hot_substrings_lose_no_link(spark, monkeypatch, calls, seed):
    monkeypatch.setattr(H, "SAMPLED", 2)
    monkeypatch.setattr(H, "HOT", 4)
    rows = series(seed)
    h = H.replay(frame(spark, rows), calls)
    assert h.hot and pairs(h.repeats()) == brute(rows)
    if calls > 1:
        assert any(h.hot.values())  # some became hot later


def test_texts_that_share_two_hot_substrings_meet_by_a_third():
    import numpy as np
    import pyarrow as pa

    texts = [" ".join(f"h{i}" for i in range(16)) + f" n{k} m{k % 7}" for k in range(40)]
    b = pa.RecordBatch.from_pydict({"run": [0] * 40, "ordinal": list(range(40)), **{f"{k}_h{i}": [0] * 40 for k in ("id_key", "page_key") for i in (1, 2)}, "summary": texts})
    t = H._texts(b)
    hot = np.zeros(0, np.uint64)
    for level in range(H.LEVELS - 1):
        e = [e for k, e, _ in H._levels(t, hot, hot[:0]) if k == level][0]
        h, n = np.unique(e.hash, return_counts=True)
        hot = np.concatenate([hot, h[n > 20]])
    levels = [e for _, e, _ in H._levels(t, hot, hot[:0])]
    assert len(levels) == H.LEVELS and (levels[-1].cuts[3] > 0).all()


def test_matches_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(H, "MATCHES", 3)
    rows = series(4, 120)
    assert pairs(H.replay(frame(spark, rows), 1).repeats()) == brute(rows)


def test_what_routes_an_entry_can_be_told_from_the_array():
    import numpy as np
    import pyarrow as pa

    rows = made(60, 3)
    b = pa.RecordBatch.from_pydict({"run": [0] * 60, "ordinal": list(range(60)), **{f"{k}_h{i}": [0] * 60 for k in ("id_key", "page_key") for i in (1, 2)}, "summary": pa.array([r[3] for r in rows], pa.string())})
    some = np.array([h for _, e, _ in H._levels(H._texts(b), np.zeros(0, np.uint64), np.zeros(0, np.uint64)) for h in e.hash[:5]], np.uint64)
    sent = pa.Table.from_batches(list(H._sent(4, some, some[:0])(iter([b]))))
    for shard in range(4):
        c = H._columns(sent.filter(pa.compute.equal(sent["shard"], shard)))
        array = H.Suffixes({k: c[k] for k in H.Suffixes.STORED})
        assert len(array.text) and ((H._route(array) & np.uint64(3)) == shard).all()
        assert (array.sorted().key[:-1] <= array.sorted().key[1:]).all()
        half = array.only(np.arange(0, len(array.text), 2))
        assert (half.keys() == array.key[::2]).all() and [half.of(x) for x in half.text] == [array.of(x) for x in array.text[::2]]


def test_replay_merges_arrays_of_runs(spark):
    rows = made(240, 6)
    h = H.replay(frame(spark, rows), 3)
    assert len(h.links) == 3 and sum(p.runs for p in h.parts) == 12 and len(h.parts) <= 2
    assert pairs(h.repeats()) == brute(rows)


@pytest.mark.parametrize("calls", [1, 2])
def test_equal_words_in_other_spelling(spark, calls):
    """Marks within words make other summary keys of the same words; in one Arrow batch or two, such rows are linked."""
    texts = ["a well-known fact of long standing", "a wellknown fact of long standing", "A WELL-KNOWN fact of long standing!", "今天早上河水涨到最高", "今天早上，河水涨到最高", "It's the fact well-known", "Its the fact wellknown", "quite another text of seven long words"]
    clock = dt.datetime(2025, 10, 1, tzinfo=UTC)
    rows = [(o, f"i{o}", f"https://a.example/{o}", s, clock + dt.timedelta(hours=o // 3)) for o, s in enumerate(texts)]
    got = pairs(H.replay(frame(spark, rows).coalesce(1), calls).repeats())
    assert got == {(0, 1), (0, 2), (3, 4), (5, 6)}
