"""Problem 10: round trip, limits, overlap, natural boundaries; ranges give what the whole gives."""

import random

import pytest

from newsloom.llm import splitting as S
from newsloom.llm.tokens import DEFAULT, tokenizer

COUNT = tokenizer(DEFAULT).count


def prose(n, seed=1):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        if k % 9 == 0:
            out.append(f"\n\n## Part {k}\n\n")
        out.append(" ".join(rng.choice(["river", "quiet", "a", "Größe", "trains,", "of"]) for _ in range(rng.randrange(4, 30))) + rng.choice([". ", "? ", ".\n", ".\n\n"]))
    return "".join(out)


HAN = "今天早上河水涨到最高。没有人知道为什么，大家都很高兴！"
TEXTS = [prose(400), HAN * 300, "x" * 9000, "河" * 5000, prose(40) + "y" * 4000 + prose(40), "short", "a b " * 4000, " " * 5000, "\n" * 3000, "é" * 3000, prose(100).replace("\n", "\r\n"), "😀" * 2500]


@pytest.mark.parametrize("text", TEXTS, ids=range(len(TEXTS)))
@pytest.mark.parametrize(("limit", "overlap"), [(256, 32), (200, 0), (1024, 64)])
def test_whole_text(text, limit, overlap):
    got = S.pieces_of(text, limit, overlap, DEFAULT)
    assert "".join(text[a + o : z] for _, a, z, o, _, _ in got) == text
    for k, (no, a, z, o, n, _) in enumerate(got):
        assert no == k
        assert n == COUNT(text[a:z]) <= limit
        assert o == 0 if k == 0 or not overlap else o >= 0
    if len(got) > 1 and overlap:
        short = [1 for _, a, z, o, _, _ in got[1:] if COUNT(text[a : a + o]) < overlap - 2]
        assert len(short) <= len(got) // 10
    if COUNT(text) <= limit:
        assert len(got) == 1
    else:
        assert len(got) <= 3 + COUNT(text) / (S.grid(limit, overlap)[0] * 0.7)


def test_cuts_at_natural_boundaries():
    text = prose(400)
    kinds = [k for *_, k in S.pieces_of(text, 1024, 64, DEFAULT)]
    assert kinds[-1] == "end" and set(kinds[:-1]) <= {"heading", "paragraph"}
    assert {k for *_, k in S.pieces_of("One more word here. " * 3000, 1024, 64, DEFAULT)[:-1]} == {"sentence"}
    assert {k for *_, k in S.pieces_of(HAN * 300, 1024, 64, DEFAULT)[:-1]} == {"sentence"}


def test_levels():
    text = "Intro text.\n\n# Head\n\nFirst. Second one\nthird"
    kinds = [S.KINDS[k] for _, k in S.boundaries(text)]
    assert kinds == ["heading", "paragraph", "sentence", "line"]


def rows(df):
    return sorted((r.doc_id, r.piece_no, r.first_char, r.end_char, r.text) for r in df.collect())


def test_ranges_give_what_the_whole_gives(spark):
    texts = [(i, t) for i, t in enumerate([prose(1500, 5), HAN * 900, "a b " * 9000, prose(30) + "z" * 9000 + prose(200), "x" * 20_000])]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    whole = rows(S.pieces(df, 300, 40))
    parts = rows(S.giant_pieces(df, 300, 40, DEFAULT, size=4096))
    for doc, text in texts:
        mine = [p for p in parts if p[0] == doc]
        assert [p[1] for p in mine] == list(range(len(mine)))
        assert all(COUNT(p[4]) <= 300 and text[p[2] : p[3]] == p[4] for p in mine)
        assert mine[0][2] == 0 and mine[-1][3] == len(text) and all(b[2] <= a[3] for a, b in zip(mine, mine[1:], strict=False))
        assert mine == [p for p in whole if p[0] == doc]


def test_unbroken_texts_of_several_ranges_keep_the_limit(spark):
    """At the production range size: pieces over range borders too, with their overlap; and what is within the limit stays whole."""
    json = "".join(f'{{"id":{k},"v":"{k * 7919 % 1000:x}"}},' for k in range(9000))
    texts = dict(enumerate(["x" * 200_000, json, " " * 70_000, "=" * 70_000, prose(200) + "y" * 150_000 + prose(200)]))
    assert min(map(len, texts.values())) > S.RANGE
    got = S.pieces(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    for doc, text in texts.items():
        mine = sorted((r for r in got if r.doc_id == doc), key=lambda r: r.piece_no)
        assert "".join(r.text[r.overlap_chars :] for r in mine) == text
        assert all(r.n_tokens == COUNT(r.text) <= S.LIMIT for r in mine), (doc, [r.n_tokens for r in mine])
        assert all(r.overlap_chars for r in mine[1:])
    rule = "-" * 70_000
    assert COUNT(rule) <= 4400 < S.Units(rule, DEFAULT, S.grid(4400, 64)[1] // 2).total
    assert S.pieces(spark.createDataFrame([(1, rule)], "doc_id long, text string"), 4400).count() == 1


def mixed(seed):
    """Text of all kinds of density: words, Han with few marks, base-64, emoji, tables, long blank stretches."""
    rng = random.Random(seed)
    b64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    kinds = [
        lambda: prose(rng.randrange(3, 60), rng.random()), lambda: "".join(rng.choice("河水涨到最高没有人知道为什么") for _ in range(rng.randrange(10, 5000))), lambda: "".join(rng.choice(b64) for _ in range(rng.randrange(10, 6000))),
        lambda: "".join(rng.choice("😀🎉é") for _ in range(rng.randrange(10, 3000))), lambda: "|".join(str(rng.randrange(10**6)) for _ in range(rng.randrange(5, 900))), lambda: " " * rng.randrange(1, 900), lambda: HAN * rng.randrange(1, 80),
    ]
    return "".join(rng.choice(kinds)() + rng.choice(["", " ", "\n", "\n\n"]) for _ in range(14))


@pytest.mark.parametrize(("limit", "overlap"), [(300, 40), (1024, 64)])
def test_pieces_are_the_same_at_any_range_size(spark, limit, overlap):
    texts = [(i, mixed(i)) for i in range(12)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    whole = rows(S.pieces(df, limit, overlap, size=1 << 30))
    for size in (4096, 8000, 20_000):
        assert rows(S.giant_pieces(df.where(f"length(text) > {size}"), limit, overlap, DEFAULT, size)) == [p for p in whole if len(dict(texts)[p[0]]) > size]
    for doc, text in texts:
        mine = [p for p in whole if p[0] == doc]
        assert all(COUNT(p[4]) <= limit for p in mine)
        assert mine[0][2] == 0 and mine[-1][3] == len(text) and all(a[2] < b[2] <= a[3] < b[3] for a, b in zip(mine, mine[1:], strict=False))
        assert all(COUNT(text[b[2] : a[3]]) >= overlap - 2 for a, b in zip(mine, mine[1:], strict=False))


def test_files_give_the_same_pieces_at_any_range_size(spark, tmp_path):
    for i in range(6):
        (tmp_path / f"{i}.txt").write_bytes(mixed(50 + i).encode())
    got = [sorted((r.path, r.first_byte, r.end_byte, r.text) for r in S.file_pieces(spark, str(tmp_path), 300, 40, size=size).collect()) for size in (4096, 17_000, 1 << 22)]
    assert got[0] == got[2] and got[1] == got[2]


def test_a_piece_above_the_limit_is_parted(monkeypatch):
    text = prose(60)
    parts = S.fitted(text, 10, 40, 3000, 100, DEFAULT)
    assert parts[0][0] >= 10 and parts[-1][1] == 3000 and all(a[1] == b[0] for a, b in zip(parts, parts[1:], strict=False)) and all(n == COUNT(text[a:z]) <= 100 for a, z, n in parts)


def test_files_by_bytes(spark, tmp_path):
    texts = {"a.txt": prose(1500, 5) + HAN * 300 + "😀é" * 2000, "b.txt": HAN * 900, "c.txt": "tiny", "d.txt": "", "e.txt": "x\n" * 9000}
    for n, t in texts.items():
        (tmp_path / n).write_bytes(t.encode())
    (tmp_path / "f.txt").write_bytes(b"bad \xff\xfe bytes " * 3000)
    got = S.file_pieces(spark, str(tmp_path), 300, 40, size=4096).collect()
    for n, t in texts.items():
        mine = sorted((r for r in got if r.path.endswith(n)), key=lambda r: r.piece_no)
        raw = t.encode()
        assert b"".join(raw[r.first_byte + r.overlap_bytes : r.end_byte] for r in mine) == raw
        assert all(raw[r.first_byte : r.end_byte].decode() == r.text and COUNT(r.text) == r.n_tokens <= 300 for r in mine)
        assert len(mine) == (0 if not t else 1 if COUNT(t) <= 300 else len(mine)) and (len(mine) < 2 or COUNT(t) > 300)
    bad = [r for r in got if r.path.endswith("f.txt")]
    assert len(bad) > 10 and max(r.end_byte for r in bad) == 13 * 3000 and all(r.n_tokens <= 300 for r in bad)


def test_frames(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "word", "x"), (4, prose(800), "x"), (4, prose(800), "x"), (None, "no id", "x")], "doc_id long, text string, chunk string")
    got = S.pieces(df, 256, 32, size=8192).collect()
    assert {r.doc_id for r in got} == {3, 4, None}
    assert len([r for r in got if r.doc_id == 4]) % 2 == 0
    assert S.pieces(df.limit(0)).count() == 0


def test_no_room():
    with pytest.raises(ValueError):
        S.grid(60, 50)
