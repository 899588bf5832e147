"""Problem 9: planted leaks of all kinds, quotations and shared instructions that are none."""

import random

import pytest

from newsloom.llm import leaks as L

RNG = random.Random(9)
WORDS = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in ("lan", "mer", "tis", "rod")]
HAN = "的一是在不了有和人这中大为上个国我以要他时来用们生到作地于出就分对成会可主发年动同工也能下过子说产种面而方后多定行学法所民得经十三之进着等部度家电力里如水化高自二理起小物现实加量都两体制机当使点从业本去把性好应开它合还因由其些然前外天政四日那社义事平形相全表间样与关各重新线内数正心反你明看原又么利比或但质气第向道命此变条只没结解问意建月公无系军很情者最立代想已通并提直题党程展五果料象员革位入常文总次品式活设及管特件长求老头基资边流路级少图山统接知较将组见计别她手角期根论运农指几九区强放决西被干做必战先回则任取据处队南给色光门即保治北造百规热领七海口东导器压志世金增争济阶油思术极交受联什认六共权收证改清己美再采转更单风切打白教速花带安场身车例真务具万每目至达走积示议声报斗完类八离华名确才科张信马节话米整空元况今集温传土许步群广石记需段研界拉林律叫且究观越织装"


def passage(n, rng=RNG):
    return [rng.choice(WORDS) for _ in range(n)]


def around(words, rng=RNG):
    return " ".join(passage(60, rng)) + ". " + words + " " + " ".join(passage(60, rng))


INSTRUCTION = "answer the question using only the passage that follows".split()
ITEMS = {i: INSTRUCTION + passage(80) for i in range(1, 9)}
HAN_ITEM = "".join(RNG.sample(HAN, 150))


def altered(words, every, start=3):
    return [w if (k + start) % every else "zzz" for k, w in enumerate(words)]


def cases():
    w = ITEMS[1]
    yield "whole", " ".join(w), True
    yield "capitals and marks", ", ".join(x.upper() for x in w) + "!", True
    yield "markup", " ".join(f"<em>{x}</em>" if k % 3 else f"**{x}**&nbsp;" for k, x in enumerate(w)), True
    yield "lines", "\n".join(w), True
    yield "one in twelve altered", " ".join(altered(w, 13)), True
    yield "one in five altered", " ".join(altered(w, 5)), False
    yield "first half", " ".join(w[: len(w) // 2 + 2]), True
    yield "a third", " ".join(w[: len(w) // 3]), False
    yield "two stretches", " ".join(w[5:30]) + " " + " ".join(passage(40)) + " " + " ".join(w[50:75]), True
    yield "two stretches out of order", " ".join(w[50:75]) + " " + " ".join(passage(40)) + " " + " ".join(w[5:30]), False
    yield "three stretches", " ".join(" ".join(w[k : k + 16]) + " " + " ".join(passage(20)) for k in (5, 30, 60)), False
    yield "words dropped", " ".join(x for k, x in enumerate(w) if k % 14 != 5), True
    yield "words added", " ".join(x if k % 14 else f"{x} zzz" for k, x in enumerate(w)), True
    yield "instruction alone", " ".join(INSTRUCTION), False
    yield "shuffled", " ".join(RNG.sample(w, len(w))), False


@pytest.mark.parametrize(("name", "text", "leak"), list(cases()), ids=lambda x: x if isinstance(x, str) and len(x) < 40 else "")
def test_case(name, text, leak):
    index = L.Index(list(ITEMS.items()))
    import numpy as np

    words = L.tokens(around(text))
    ids = np.array([index.vocabulary.get(x, 0) for x in words], np.uint64)
    assert set(index.leaks(ids)) == ({1} if leak else set())


@pytest.mark.parametrize("seed", range(40))
def test_random_plants_are_found(seed):
    """Leaks right at the limits: half the words, in two stretches, one word in twelve altered."""
    import numpy as np

    rng = random.Random(seed)
    w = ITEMS[2]
    n = -(-len(w) // 2)
    a = rng.randrange(NG := 8, n - 8)
    assert NG
    start = rng.randrange(0, len(w) - n - 3)
    gap = rng.randrange(0, len(w) - n - start)
    first, second = w[start : start + a], w[start + a + gap : start + n + gap]
    both = first + second
    for k in rng.sample(range(4, len(both) - 4), len(both) // 12):
        if k not in (a - 1, a):
            both[k] = "zzz"
    text = " ".join(both[:a]) + " " + " ".join(passage(30, rng)) + " " + " ".join(both[a:])
    index = L.Index(list(ITEMS.items()))
    ids = np.array([index.vocabulary.get(x, 0) for x in L.tokens(around(text, rng))], np.uint64)
    assert 2 in index.leaks(ids)


def test_frames(spark):
    items = spark.createDataFrame([(i, "en", "choice", " ".join(w)) for i, w in ITEMS.items()] + [(50, "zh", "passage", HAN_ITEM), (51, "en", "choice", "too short"), (52, None, None, None)], "item_id long, lang string, kind string, text string")
    han = "，".join([HAN_ITEM[:40], HAN_ITEM[40:90]])
    rows = [
        (1, around(" ".join(ITEMS[3])), "x"), (1, around(" ".join(ITEMS[3])), "x"), (2, "前言" + han + "后记", "x"), (3, None, "x"), (4, "", "x"), (5, around(""), "x"),
        (6, "a &lt; b <p>" + " ".join(ITEMS[4]) + "</p> and <b>" + " ".join(ITEMS[5]) + "</b>", "x"), (7, "filler " * 100_000 + " ".join(ITEMS[6]), "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id string")
    got = sorted((r.doc_id, r.item_id) for r in L.leaks(docs, items).collect())
    assert got == [(1, 3), (1, 3), (2, 50), (6, 4), (6, 5), (7, 6)]
    for r in L.leaks(docs, items).where("doc_id = 7").collect():
        assert rows[7][1][r.spans[0].first : r.spans[0].last] == " ".join(ITEMS[6])
    clean = {r.doc_id: r.text for r in L.cleaned(docs, items).where("text is not null").collect()}
    assert 6 not in clean and 2 not in clean and "filler" in clean[7] and ITEMS[6][20] not in clean[7].split() and clean[5] == rows[5][1]
    assert L.leaks(docs.limit(0), items).count() == 0 and L.leaks(docs, items.limit(0)).count() == 0


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(L, "BLOCK_WORDS", 300)
    items = spark.createDataFrame([(i, " ".join(w)) for i, w in ITEMS.items()], "item_id long, text string")
    docs = spark.createDataFrame([(i, around(" ".join(w))) for i, w in ITEMS.items()], "doc_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in L.leaks(docs, items).collect()) == [(i, i) for i in ITEMS]


def found(item, text):
    import numpy as np

    index = L.Index([(1, item)])
    words = L.tokens(text)
    return bool(index.leaks(np.array([index.vocabulary.get(x, 0) for x in words], np.uint64)))


@pytest.mark.parametrize(("n", "stretches", "leak"), [
    (16, ((0, 4), (8, 12)), True), (16, ((0, 4), (8, 11)), False), (16, ((2, 10),), True), (16, ((2, 9),), False), (24, ((0, 4), (10, 18)), True),
    (11, ((0, 3), (6, 9)), True), (11, ((0, 3), (6, 8)), False), (9, ((2, 7),), True), (8, ((4, 8),), True), (6, ((1, 4),), True), (6, ((1, 3),), False), (5, ((0, 3),), True), (4, ((0, 4),), True), (4, ((0, 3),), False), (1, ((0, 1),), True),
])
def test_short_items(n, stretches, leak):
    item = [f"s{k}" for k in range(n)]
    text = around((" " + " ".join(passage(20)) + " ").join(" ".join(item[a:z]) for a, z in stretches))
    assert found(item, text) == leak


def test_short_item_with_an_altered_word_in_its_second_stretch():
    item = [f"s{k}" for k in range(24)]
    text = " ".join(item[:4]) + " " + " ".join(passage(20)) + " " + " ".join([*item[8:12], "zzz", *item[13:16]])
    assert found(item, around(text))


@pytest.mark.parametrize("seed", range(60))
def test_no_leak_of_an_item_of_any_length_is_lost(seed):
    """Random splits at the very limits, of items of 5 to 40 words: one or two stretches, one covered word in twelve altered."""
    rng = random.Random(100 + seed)
    for n in range(5, 41):
        item = [f"s{k}" for k in range(n)]
        want = L.need(n)
        covered = rng.randrange(want.words, n + 1)
        both = list(range(covered))
        first = rng.randrange(L.RUN, covered - L.RUN + 1) if covered >= 2 * L.RUN and rng.random() < 0.8 else covered
        start = rng.randrange(n - covered + 1)
        gap = rng.randrange(n - covered - start + 1) if first < covered else 0
        words = [item[start + k + (gap if k >= first else 0)] for k in both]
        inner = [k for k in both if k not in (0, first - 1, first, covered - 1)]
        for k in rng.sample(inner, min(len(inner), covered // L.ALTERED)):
            words[k] = "zzz"
        runs = [max((len(r.split()) for r in " ".join(part).split("zzz")), default=0) for part in (words[:first], words[first:]) if part]
        if min(runs) < L.RUN:  # not a stretch
            continue
        text = " ".join(words[:first]) + " " + " ".join(passage(rng.choice((1, 25, 300)), rng)) + " " + " ".join(words[first:])
        assert found(item, around(text, rng)), (n, covered, first, start, gap)


def test_places_are_those_of_the_tokens():
    for text in ("İstanbul'da İĞÜŞ ve ΑΣ", "caf&eacute and na&iumlve caf&eacute;s &amp;c &notanentity; &#233;t&#xe9 x", "a<b>c</b>d <!-- no --> e &lt;f&gt; g", "ß ŉ ǆ ẞ \u0130\u0130 end", "", "<p"):
        at = L.places(text)
        words = L.tokens(text)
        assert len(at) == len(words)
        for (a, z), w in zip(at, words, strict=True):
            assert "".join(L.tokens(text[a:z])) == w or w in L.normalise(text[max(0, a - 1) : z + 1])


def test_leaks_in_texts_whose_lower_case_is_longer(spark):
    text = "İ İstanbul " + around(" ".join(ITEMS[3])) + " caf&eacute end"
    docs = spark.createDataFrame([(1, text), (2, "na&iumlve &copy 2020 " + " ".join(ITEMS[4]) + " tail &eacute x")], "doc_id long, text string")
    items = spark.createDataFrame([(i, " ".join(w)) for i, w in ITEMS.items()], "item_id long, text string")
    spans = {r.doc_id: (r.item_id, r.spans) for r in L.leaks(docs, items).collect()}
    assert spans[1][0] == 3 and text[spans[1][1][0].first : spans[1][1][0].last] == " ".join(ITEMS[3])
    assert {r.doc_id: r.text for r in L.cleaned(docs, items, drop_share=1.0).collect()}[2] == "na&iumlve &copy 2020  tail &eacute x"
