"""Problem 4: held-out accuracy on titles garbled on purpose, decoys left alone."""

import random

import pytest

from newsloom.llm import garbled as G

NOUNS = ["Brücke", "Küche", "Straße", "façade", "théâtre", "señal", "canción", "café", "mañana", "Übung", "naïve", "élève"]
HAN = "市中心的老图书馆重新开放了，大家都很高兴。今天早上河水涨到最高"


def titles(n, seed=3):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        kind = i % 4
        if kind == 0:
            out.append(f"Die {rng.choice(NOUNS)} von {rng.choice('ABCDEFG')}ort {rng.randrange(90)} – „{rng.choice(NOUNS)}“")
        elif kind == 1:
            out.append(f"Inside Studio {rng.randrange(90)}’s {rng.choice(['quiet', 'early', 'late'])} {rng.choice(NOUNS)} — and who sold it")
        elif kind == 2:
            k = rng.randrange(len(HAN) - 12)
            out.append(HAN[k : k + 10] + HAN[rng.randrange(12) :][:8])
        else:
            out.append(f"Plain words {rng.randrange(99)} again and again")
    return out


@pytest.fixture(scope="module")
def trained(spark):
    rows = [(i, t) for i, t in enumerate(titles(3000))] + [(9000 + i, t) for i, t in enumerate(["MAÇÃ: a quiet day", "Ânima — another day", "«Été» of the year"] * 30)]
    return G.train(spark.createDataFrame(rows, "ordinal long, title string").repartition(4))


def restored(title, trained):
    return G.restore([title], *trained)[0]


@pytest.mark.parametrize("chain", G.GARBLINGS, ids=lambda c: "+".join(f"{a}>{b}" for a, b in c))
def test_restores_held_out_titles(trained, chain):
    good = bad = 0
    for t in titles(400, seed=77):
        g = G.garble(t, chain)
        if g is None or g == t or (chain[0][0] != "utf-8" and not G._CJK.search(t)):  # legacy encodings of Chinese are met with Chinese
            continue
        good += (r := restored(g, trained)) == t
        bad += r not in (t, None)
    assert good and bad <= 0.02 * (good + bad) and good >= 0.9 * (good + bad)


def test_sound_titles_stay(trained):
    held = titles(400, seed=78) + ["MAÇÃ: a quiet day", "Ânima — another day", "«Été» of the year", "Niño ©", ""]
    assert [t for t in held if restored(t, trained) is not None] == []


def test_lost_characters(trained):
    lost = [t for t in titles(200, seed=79) if "’" in t or "„" in t]
    found = sum(restored(G.drop(t), trained) == "" for t in lost)
    assert found >= 0.95 * len(lost)
    assert restored("caf� au lait", trained) == ""


def test_part_of_a_title(trained):
    t = "Inside Studio 7’s early café — and who sold it"
    assert restored(G.garble(t, (("utf-8", "cp1252"),)) + " | «Été»", trained) == t + " | «Été»"


def test_frames(spark, trained):
    model, margins = trained
    bad = G.garble("Die Küche von Bort 5 – „Brücke“", (("utf-8", "latin-1"),))
    df = spark.createDataFrame([(1, None, "a"), (2, "", "a"), (3, bad, "a"), (3, bad, "a"), (4, "plain", None), (5, "Die Küche von Bort " * 5_000, None)], "ordinal long, title string, restored_title string")
    got = sorted((r.ordinal, r.restored_title) for r in G.restored(df, model, margins).collect())
    assert got == [(3, "Die Küche von Bort 5 – „Brücke“")] * 2
    assert G.restored(df.limit(0), model, margins).count() == 0
    assert G.restored(df.limit(0)).count() == 0


def test_many_are_judged_as_one_by_one(trained):
    model, margins = trained
    rows = titles(200, seed=80)
    rows += [g for t in rows for chain in G.GARBLINGS[:4] if (g := G.garble(t, chain))][::3] + [None, "", "caf\ufffd", "a | b"]
    assert G.restore(rows, model, margins) == [restored(t, trained) for t in rows]
    some = [t for t in rows if t][:50]
    assert max(abs(a - model.score(t)) for a, t in zip(model.scores(some), some, strict=True)) < 1e-3


def test_every_reading_goes_a_step_further():
    """A text garbled three times over, by other code pages each time: the original is among the candidates."""
    rng = random.Random(4)
    tried = 0
    for t in titles(400, seed=81):
        chain = tuple(("utf-8", rng.choice(("latin-1", "cp1252", "mac_roman", "cp437", "cp850", "cp1250"))) for _ in range(rng.choice((2, 3))))
        if (g := G.garble(t, chain)) and g != t:
            tried += 1
            assert t in G.candidates(g), (t, chain)
    assert tried > 100


def test_margins_come_from_all_clean_titles(spark, monkeypatch):
    """Sound titles that read better otherwise, few and all in some folds: the margin keeps them; each clean title is judged, whatever the partitions."""
    base = list(dict.fromkeys(titles(1500, seed=82)))
    rare = [t for i in range(20) if G.hash_of(t := "Tröukek " * 12 + f"Lou {i}") % G.HELD_OUT][:6]
    rows = base + ["Trˆukek " * 12 + f"Lou {j}" for j in range(60)] + rare * 2
    best, seen = G._best, []
    monkeypatch.setattr(G, "_best", lambda counts, *kinds: seen.append(counts) or best(counts, *kinds))
    frame = spark.createDataFrame(list(enumerate(rows)), "ordinal long, title string")
    model, margins = G.train(frame.repartition(3))
    clean = sum(not p.isascii() and not G._suspect(p) for t in rows for p in t.split("|"))
    assert [counts.loc[counts["kind"] == "sound", "n"].sum() for counts in seen] == [clean, clean]
    assert G.restore(rare, model, margins) == [None] * len(rare)
    assert G.train(frame.repartition(7))[1] == margins
