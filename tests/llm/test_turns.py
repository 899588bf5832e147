"""Problem 5: labels in all habits, marks, sounds, repaired clocks."""

import pytest

from newsloom.llm import turns as T

PEOPLE = [("Ann Marlowe", "Host"), ("Bob Keystone", "Guest")]


def vtt(*cues):
    return "WEBVTT\n\n" + "\n\n".join(f"00:00:{i:02d}.000 --> 00:00:{i + 1:02d}.000\n{c}" for i, c in enumerate(cues))


def said(*cues, lang="en", people=PEOPLE):
    return [(t.first_cue_no, t.speaker.split()[0], t.text) for t in T.turns(vtt(*cues), lang, people)]


@pytest.mark.parametrize(
    "label",
    ["Ann Marlowe:", "ANN:", "Marlowe :", "Marlowe：", "[Ann]", "[MARLOWE]:", "(Ann Marlowe)", "Ann Marlowe (host):", "- Ann:", "&gt;&gt; Ann:", "&gt;&gt; Host Marlowe:", "Host:", "Marlowe, Ann:", "A. Marlowe:", "AM:", "Marlowwe:", "<b>Ann:</b>", "<v Ann Marlowe>", "<v Ann>"],
)
def test_label(label):
    assert said("Bob: good day", f"{label} well then") == [(1, "Bob", "good day"), (2, "Ann", "well then")]


def test_what_is_no_label():
    assert said("Ann: Question: why?", "The rule is this: none", "(laughs) and so on") == [(1, "Ann", "Question: why? The rule is this: none and so on")]


def test_unknown_before_labels_and_after_marks():
    assert said("who is it", "Ann: me", "&gt;&gt; no, me", "still me", "Bob: and I") == [(1, "unknown", "who is it"), (2, "Ann", "me"), (3, "unknown", "no, me still me"), (5, "Bob", "and I")]


def test_turns_without_words_part_nobody():
    assert said("Ann: one", "Bob: um... [music] (sighs) ♪ ♪ *coughs* uhh", "Ann: two") == [(1, "Ann", "one two")]


def test_first_cue_is_that_of_the_first_word():
    assert said("Ann:", "um,", "hello", "Bob:\nUh.", "yes") == [(3, "Ann", "hello"), (5, "Bob", "yes")]


def test_two_labels_in_a_cue():
    assert said("Ann: one\n[BOB]: two\nthree") == [(1, "Ann", "one"), (1, "Bob", "two three")]


def test_hesitations_by_language():
    assert said("Ann: äh um ähm er", lang="de") == [(1, "Ann", "um er")]
    assert said("Ann: um er", lang="en") == []


def test_ambiguous_label_names_nobody():
    assert said("Marlowe: hm well", people=[("Ann Marlowe", "Host"), ("Joe Marlowe", "Guest")]) == [(1, "unknown", "well")]


def test_isotonic():
    assert T.isotonic([1, 3, 2, 4]) == [1, 2.5, 2.5, 4]
    assert T.isotonic([]) == [] and T.isotonic([5, 1]) == [3, 3]


def test_order_and_reset_clocks():
    cues = "WEBVTT\n\n" + "\n\n".join(f"{c} --> {e}\n{t}" for c, e, t in [("10:00.000", "10:02.000", "Ann: one"), ("10:05.000", "10:07.000", "three"), ("10:03.000", "10:04.000", "two"), ("00:00.000", "00:01.000", "Bob: later")])
    got = T.turns(cues, "en", PEOPLE)
    assert [(t.speaker, t.text) for t in got] == [("Ann Marlowe", "one two three"), ("Bob Keystone", "later")]
    assert got[1].start_ms >= got[0].end_ms


def test_frames(spark):
    files = spark.createDataFrame(
        [(1, "en", vtt("Ann: hi"), "x"), (2, "en", vtt("Ann: hi"), "x"), (3, None, None, None), (4, "en", "", ""), (5, "en", vtt("Ann: " + "so " * 50_000), "")], "vtt_id long, lang string, vtt string, people string"
    )
    roster = spark.createDataFrame([(i, n, s, r) for i in (1, 3, 4, 5) for n, (s, r) in enumerate(PEOPLE)] + [(1, 0, *PEOPLE[0]), (1, 9, None, None)], "vtt_id long, speaker_no int, speaker_name string, speaker_role string")
    got = T.speaker_turns(files, roster).collect()
    assert sorted((r.vtt_id, r.speaker) for r in got) == [(1, "Ann Marlowe"), (5, "Ann Marlowe")]
    assert T.speaker_turns(files.limit(0), roster).count() == 0 and T.speaker_turns(files, roster.limit(0)).count() == 0


CLOCKS = """WEBVTT

00:00:01.000 --> 00:00:04.000
Ann Lee: one two

00:00:03.000 --> 00:00:03.500
Bo Ray: over that

00:05:00.000 --> 00:04:00.000
Ann Lee: three four

00:06:00.000 --> 00:06:04.000
Bo Ray: five

00:00:02.000 --> 00:00:05.000
Ann Lee: a new clock

00:00:09.000 --> 00:00:08.000
Bo Ray: ends early
"""


def test_contradicting_stamps_and_clock_resets_are_repaired(monkeypatch):
    from newsloom.llm import turns as T

    people = [("Ann Lee", "host"), ("Bo Ray", "guest")]
    got = T.turns(CLOCKS, "en", people)
    assert [(t.speaker, t.first_cue_no) for t in got] == [("Ann Lee", 1), ("Bo Ray", 2), ("Ann Lee", 3), ("Bo Ray", 4), ("Ann Lee", 5), ("Bo Ray", 6)]
    bounds = [(t.start_ms, t.end_ms) for t in got]
    # Cross-talk keeps its bounds; the end before its start is pooled with it; the second clock goes on from the first.
    assert bounds == [(1000, 4000), (3000, 3500), (270_000, 270_000), (360_000, 364_000), (366_000, 369_000), (372_500, 372_500)]
    assert all(a <= z for a, z in bounds) and sorted(a for a, _ in bounds) == [a for a, _ in bounds]
    monkeypatch.setattr(T, "isotonic", lambda values: values)
    assert [(t.start_ms, t.end_ms) for t in T.turns(CLOCKS, "en", people)] != bounds


def test_a_language_without_a_list():
    from newsloom.llm import turns as T

    vtt = "WEBVTT\n\n00:00:01.000 --> 00:00:02.000\nAnn Lee: uhh oh ah ja\n"
    assert [t.text for t in T.turns(vtt, "pt-BR", [("Ann Lee", "")])] == ["oh ah ja"]
