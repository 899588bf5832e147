"""Problem 3 against a plain scan of neighbours."""

from hypothesis import given, settings
from hypothesis import strategies as st

from newsloom.llm import repeats as R


def vtt(lines):
    out = ["WEBVTT", ""]
    for i, text in enumerate(lines):
        out += [f"00:00:{i:02d}.000 --> 00:00:{i + 1:02d}.000", text, ""]
    return "\n".join(out)


def plain(lines):
    """Runs by the definition: each line like the one before."""
    kept = [(i + 1, x) for i, t in enumerate(lines) for x in t.split("\n") if any(c.isalnum() for c in x)]
    key = lambda x: "".join(c for c in x.casefold() if c.isalnum())

    def like(a, b):
        if key(a) == key(b):
            return True
        x, y = [w for w in map(key, a.split()) if w], [w for w in map(key, b.split()) if w]
        if max(len(x), len(y)) < 6:
            return False
        if len(x) == len(y):
            return sum(p != q for p, q in zip(x, y, strict=True)) <= 1
        s, t = sorted((x, y), key=len)
        return len(t) - len(s) == 1 and any(t[:i] + t[i + 1 :] == s for i in range(len(t)))

    out, i = [], 0
    while i < len(kept):
        j = i
        while j + 1 < len(kept) and like(kept[j][1], kept[j + 1][1]):
            j += 1
        if j > i:
            out.append((kept[i][0], kept[j][0], j - i + 1))
        i = j + 1
    return out


words = st.lists(st.sampled_from(["a", "B", "b", "cc", "-", "d!", "ß", "SS"]), min_size=0, max_size=8).map(" ".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(words, st.builds(lambda a, b: a + "\n" + b, words.filter(str.strip), words.filter(str.strip))), max_size=14))
def test_against_plain_scan(lines):
    lines = [x if x.strip() else "♪" for x in lines]
    assert [(a, z, n) for a, z, n, *_ in R.runs(vtt(lines)) if n > 1] == plain(lines)


def test_tags_entities_order_and_clocks():
    text = "﻿WEBVTT\r\n\r\nNOTE x\r\n\r\n1\r\n00:05.000 --> 00:06.000 align:start\r\n<c.mono>Fish &amp; chips</c>\r\n\r\n2\r\n00:01.000 --> 00:02.000\r\nhello\r\n\r\n3\r\n01:00:03,000 --> 01:00:04,000\r\nfish chips!\r\n[music]\r\n"
    assert [r[:3] for r in R.runs(text)] == [(2, 2, 1), (1, 3, 2), (3, 3, 1)]


def test_more_forms_than_code_points(monkeypatch):
    monkeypatch.setattr(R, "_MANY", 3)
    lines = [f"x{i}" for i in range(40)]
    assert all(n == 1 for *_, n, _, _, _ in [(0, 0, r[2], 0, 0, 0) for r in R.runs(vtt(lines))]) and len(R.runs(vtt(lines))) == 40


def test_frames(spark):
    ddl = "vtt_id long, item_id string, lang string, file_name string, vtt string, line string"
    rows = [(1, "a", "en", "f", vtt(["one", "One!", "two"]), "x"), (1, "a", "en", "f", vtt(["one", "One!", "two"]), "x"), (2, None, None, None, None, None), (3, "a", "en", "f", "", ""), (4, "a", "en", "f", "WEBVTT\n\n00:01.000 --> 00:02.000", "")]
    df = spark.createDataFrame(rows, ddl)
    assert sorted(map(tuple, R.repeated(df).collect())) == [(1, 1, 2, 2), (1, 1, 2, 2)]
    assert R.collapsed(df).count() == 4 and R.collapsed(df.limit(0)).count() == 0
    assert {r.duration_ms for r in R.collapsed(df).where("n_lines = 2").collect()} == {2000}


def test_very_long_file():
    assert len(R.runs(vtt(["la la la"] * 50).replace("la la la", "la " * 20_000))) == 1
