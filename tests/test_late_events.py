"""Problem 2: verdicts, counts, and the lambda view against the counts from scratch."""

import datetime as dt
import random

import pytest

from newsloom.operators import late_events as le

UTC = dt.timezone.utc
DDL = "ordinal long, id string, published_at timestamp, first_seen_at timestamp, period string, r int"


def t(day, hour=0, minute=0):
    return dt.datetime(2025, 10, 1, tzinfo=UTC) + dt.timedelta(days=day - 1, hours=hour, minutes=minute)


def frame(spark, rows):
    return spark.createDataFrame([(o, i, p, f, "x", 1) for o, i, p, f in rows], DDL)


CASES = [
    (1, "a", t(1, 5), t(1, 6)),  # on time
    (2, "b", t(1, 5), t(2)),  # at the very end of its period: corrects
    (3, "c", t(1, 5), t(4)),  # at the very cut-off: corrects
    (4, "d", t(1, 5), t(4, 0, 1)),  # a minute too late
    (5, "e", None, t(2)), (6, "e", t(1, 5), t(2, 1)), (7, "e", t(1, 5), t(9)),  # counts by its first dated row
    (8, "f", t(20), t(2)),  # dated in the future: on time, closes nothing
    (9, None, t(1), t(9)), (10, "g", t(1), None), (11, "a", t(1, 5), t(9)),
]


def test_verdicts(spark):
    got = {r.ordinal: (r.period_day, r.verdict) for r in le.late_rows(frame(spark, CASES)).collect()}
    assert got == {2: ("2025-10-01", "corrects"), 3: ("2025-10-01", "corrects"), 4: ("2025-10-01", "too_late"), 6: ("2025-10-01", "corrects")}


def test_daily(spark):
    got = {r.period_day: (r.n_on_time, r.n_corrects, r.n_too_late, r.n_items) for r in le.daily(frame(spark, CASES)).collect()}
    assert got == {"2025-10-01": (2, 3, 1, 5), "2025-10-20": (1, 0, 0, 1)}
    assert le.daily(frame(spark, CASES).limit(0)).count() == 0
    assert le.late_rows(frame(spark, CASES).limit(0)).count() == 0


def test_view_equals_counts_from_scratch(spark, tmp_path):
    rng = random.Random(3)
    rows = []
    for run in range(8):
        clock = t(2 + run)
        for _ in range(30):
            day = rng.choice([run + 1, run + 1, run, max(1, run - 3), 30])
            rows.append((len(rows), f"i{rng.randrange(150)}", rng.choice([t(day, rng.randrange(24)), None, t(day, 3)]), clock))
    view = le.LambdaView(spark, f"file://{tmp_path}/view")
    for run in range(8):
        view = le.LambdaView(spark, f"file://{tmp_path}/view")  # opened again each time
        view.ingest(frame(spark, [r for r in rows if r[3] == t(2 + run)]))
        if run in (2, 5):
            view.recompute(t(2 + run))
            states = {r.period_day: r.state for r in view.serve().collect()}
            assert states.get("2025-10-01") == ("frozen" if run >= 2 else "corrected")
    provisional = {r.period_day: r.n_items for r in view.serve().collect()}
    view.recompute(t(40))
    truth = {r.period_day: r.n_items for r in le.daily(frame(spark, rows)).where("n_items > 0").collect()}
    served = {r.period_day: r.n_items for r in view.serve().where("n_items > 0").collect()}
    assert served == truth
    assert all(provisional.get(day, 0) >= n for day, n in truth.items())  # the fast layer may count an id twice, never miss one


def test_frozen_periods_do_not_move(spark, tmp_path):
    view = le.LambdaView(spark, f"file://{tmp_path}/view")
    view.ingest(frame(spark, [(1, "a", t(1, 5), t(1, 6))]))
    view.recompute(t(5))
    view.ingest(frame(spark, [(2, "b", t(1, 5), t(6))]))
    view.recompute(t(6))
    assert [(r.period_day, r.n_items, r.state) for r in view.serve().collect()] == [("2025-10-01", 1, "frozen")]


def test_a_row_at_the_very_cutoff_is_not_frozen_out(spark, tmp_path):
    rows = [(1, "a", t(1, 5), t(1, 6)), (2, "c", t(1, 5), t(4)), (3, "d", t(1, 5), t(4, 0, 1))]
    view = le.LambdaView(spark, f"file://{tmp_path}/view")
    view.ingest(frame(spark, rows[:1]))
    view.recompute(t(4))
    view.ingest(frame(spark, rows[1:2]))
    assert [(r.n_items, r.state) for r in view.serve().collect()] == [(2, "provisional")]
    view.recompute(t(4))
    view.ingest(frame(spark, rows[2:]))
    view.recompute(t(5))
    truth = {r.period_day: r.n_items for r in le.daily(frame(spark, rows)).collect()}
    assert {r.period_day: r.n_items for r in view.serve().collect()} == truth == {"2025-10-01": 2}


def test_served_query_loses_no_row(spark, tmp_path):
    from newsloom.plans.problems import p2_daily, p2_served

    rows = [(1, "a", t(1, 5), t(1, 6)), (2, "g", t(1), None), (3, "c", t(1, 5), t(4)), (4, "d", t(1, 5), t(9))]
    frame(spark, rows).write.parquet(f"{tmp_path}/archive_item.parquet")
    served = {r.period_day: r.n_items for r in p2_served(spark, str(tmp_path)).collect()}
    assert served == {r.period_day: r.n_items for r in p2_daily(spark, str(tmp_path)).collect()} == {"2025-10-01": 3}
    frame(spark, rows[1:2]).write.mode("overwrite").parquet(f"{tmp_path}/archive_item.parquet")
    assert [r.n_items for r in p2_served(spark, str(tmp_path)).collect()] == [1]


@pytest.mark.parametrize(("batches", "every"), [(1, 1), (3, 1), (8, 2)])
def test_replayed_view_equals_rows_from_scratch(spark, tmp_path, batches, every):
    rng = random.Random(5)
    rows = []
    for run in range(12):
        for _ in range(20):
            day = rng.choice([run + 1, run, max(1, run - 1), max(1, run - 2), max(1, run - 5), 30])
            rows.append((len(rows), f"i{rng.randrange(170)}", rng.choice([t(day, rng.randrange(24)), None, t(day, 3)]), t(2 + run)))
    rows += [(1000, "n", t(1, 5), None)]
    view = le.replay(frame(spark, rows), f"file://{tmp_path}/view", batches, every)
    want = le.late_rows(frame(spark, rows)).collect()
    assert sorted(view.late().collect()) == sorted(want) and {r.verdict for r in want} == {"corrects", "too_late"}
    assert sorted(view.daily().collect()) == sorted(le.daily(frame(spark, rows)).collect())
    assert view.runs == batches and view.views == -(-batches // every) and not view.since
    assert {r.state for r in view.serve().collect()} == {"frozen", "corrected"}


def test_found_goes_through_the_view(spark, tmp_path, monkeypatch):
    from newsloom.plans.problems import p2_daily, p2_found

    frame(spark, CASES).write.parquet(f"{tmp_path}/archive_item.parquet")
    calls = []
    for name in ("ingest", "recompute"):
        monkeypatch.setattr(le.LambdaView, name, lambda self, x, f=getattr(le.LambdaView, name), n=name: (calls.append(n), f(self, x))[1])
    assert sorted(p2_found(spark, str(tmp_path)).collect()) == sorted(le.late_rows(frame(spark, CASES)).collect())
    assert calls.count("ingest") > 1 and calls[-1] == "recompute"
    assert p2_daily(spark, str(tmp_path)).columns == le.daily(frame(spark, CASES)).columns
    frame(spark, CASES).limit(0).write.mode("overwrite").parquet(f"{tmp_path}/archive_item.parquet")
    assert p2_found(spark, str(tmp_path)).count() == 0


class Stop(Exception):
    pass


def stopper(at, calls):
    """A stand-in for ``remove`` that stops at the given call."""
    from newsloom.runtime import remove

    def stop(spark, path):
        calls.append(path)
        if len(calls) == at:
            raise Stop
        remove(spark, path)

    return stop


@pytest.mark.parametrize("at", [1, 2, 3, 4])
def test_a_stop_while_a_recompute_cleans_up_counts_nothing_twice(spark, tmp_path, monkeypatch, at):
    path = f"file://{tmp_path}/view"
    rows = [(1, "a", t(1, 5), t(1, 6)), (2, "b", t(1, 5), t(1, 7)), (3, "c", t(1, 9), t(2, 1))]
    view = le.LambdaView(spark, path)
    for k in range(2):
        view.ingest(frame(spark, rows[k : k + 1]))
    monkeypatch.setattr(le, "remove", stopper(at, []))
    try:
        view.recompute(t(1, 8))
    except Stop:
        pass
    monkeypatch.undo()
    view = le.LambdaView(spark, path)
    assert [(r.period_day, r.n_items) for r in view.serve().collect()] == [("2025-10-01", 2)]
    view.ingest(frame(spark, rows[2:]))
    assert [r.n_items for r in le.LambdaView(spark, path).serve().collect()] == [3]
    view.recompute(t(2, 2))
    assert [r.n_items for r in le.LambdaView(spark, path).serve().collect()] == [3]


def test_a_batch_is_taken_in_once(spark, tmp_path):
    path = f"file://{tmp_path}/view"
    one = frame(spark, [(1, "a", t(1, 5), t(1, 6))])
    view = le.LambdaView(spark, path)
    for _ in range(2):
        view.ingest(one, 0)
    assert [r.n_items for r in view.serve().collect()] == [1]
    view.recompute(t(1, 7))
    le.LambdaView(spark, path).ingest(one, 0)
    assert [r.n_items for r in le.LambdaView(spark, path).serve().collect()] == [1]
    # A run whose rows are in the log but whose increments are not was broken off: it is not in, and is written anew.
    frame(spark, [(9, "z", t(1, 5), t(1, 6))]).write.parquet(f"{path}/log/run=1")
    view = le.LambdaView(spark, path)
    view.recompute(t(1, 8))
    assert [r.n_items for r in view.serve().collect()] == [1] and view.runs == 1
    view.ingest(frame(spark, [(2, "b", t(1, 5), t(1, 9))]))
    assert [r.n_items for r in le.LambdaView(spark, path).serve().collect()] == [2]


def test_state_files_survive_a_stop(spark, tmp_path):
    from newsloom import runtime

    path = f"file://{tmp_path}/s/state"
    assert runtime.read_state(spark, path) is None
    for n in range(4):
        runtime.write_state(spark, path, f"v{n}", n)
        assert runtime.read_state(spark, path) == f"v{n}"
    (tmp_path / "s" / ".state-4.new").write_text("half")
    assert runtime.read_state(spark, path) == "v3"
    runtime.write_state(spark, path, "v3 again", 3)
    assert runtime.read_state(spark, path) == "v3 again"


def test_payloads_survive_a_stop(spark, tmp_path, monkeypatch):
    from newsloom.sinks import payloads

    path = f"file://{tmp_path}/out"
    payloads.swap_in(spark.range(1), path)
    moves = []

    def stop(spark, a, b):
        if moves:
            raise Stop
        moves.append((a, b))
        payloads_move(spark, a, b)

    from newsloom.runtime import move as payloads_move

    monkeypatch.setattr(payloads, "move", stop)
    with pytest.raises(Stop):
        payloads.swap_in(spark.range(2), path)
    monkeypatch.undo()
    assert payloads.payload(spark, path).count() == 1
    payloads.swap_in(spark.range(3), path)
    assert payloads.payload(spark, path).count() == 3
