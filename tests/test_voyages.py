"""Sessions, stays and journeys on hand-made rows and against a plain per-vessel walk."""

from __future__ import annotations

import datetime as dt
import random
from itertools import groupby

import pytest

from tidemark.operators import voyages

T0 = dt.datetime(2024, 3, 1)
SCHEMA = "mmsi bigint, vessel_name string, ts timestamp_ntz, port_id bigint, port_name string"


def at(seconds: float) -> dt.datetime:
    return T0 + dt.timedelta(seconds=seconds)


def frame(spark, rows):
    return spark.createDataFrame([(m, n, None if s is None else at(s), p, f"P{p}") for m, n, s, p in rows], SCHEMA)


def key(value):
    return (value is not None, value)


def walk(rows, max_gap=None):
    """(row, prev port, prev second, new?, session) in order, one vessel after the other."""
    out = []
    order = sorted(rows, key=lambda r: (key(r[0]), key(r[2]), r[3], key(r[1])))
    for _, group in groupby(order, key=lambda r: r[0]):
        prev, session = None, 0
        for row in group:
            new = prev is None or prev[3] != row[3]
            if not new and max_gap is not None and prev[2] is not None and row[2] is not None:
                new = int(row[2]) - int(prev[2]) > max_gap
            session += new
            out.append((row, prev[3] if prev else None, prev[2] if prev else None, int(new), session))
            prev = row
    return out


def walk_stays(rows, min_stay=900, max_gap=None):
    spans = {}
    for row, _, _, _, session in walk(rows, max_gap):
        spans.setdefault((row[0], row[1], row[3], session), []).append(row[2])
    out = set()
    for group, seconds in spans.items():
        seconds = [s for s in seconds if s is not None]
        if seconds and int(max(seconds)) - int(min(seconds)) > min_stay:
            out.add((*group, at(min(seconds)), at(max(seconds)), int(max(seconds)) - int(min(seconds))))
    return out


def random_rows(seed: int, vessels, n: int, span: int, ports: int):
    rng = random.Random(seed)
    return [
        (rng.choice(vessels), rng.choice(["A", "B", None]), rng.randrange(span), rng.randrange(ports)) for _ in range(n)
    ]


CASES = {
    "mixed": random_rows(1, [1, 2, 3, None], 400, 40_000, 3),
    "one vessel holds most rows": random_rows(2, [7] * 9 + [8], 600, 20_000, 2),
    "many ties": random_rows(3, [1, 2], 300, 60, 4),
    "missing times": [(1, "A", None, 2), (1, "A", None, 1), (1, "A", 5, 1), (1, "A", 2000, 1), (None, "A", None, 3)],
}


@pytest.mark.parametrize("slice_seconds", [10, 900, 10**7])
@pytest.mark.parametrize("max_gap", [None, 120])
@pytest.mark.parametrize("case", CASES)
def test_sessions_equal_a_walk(spark, case, slice_seconds, max_gap):
    rows = CASES[case]
    got = voyages.sessionize(frame(spark, rows), max_gap, slice_seconds).collect()
    assert sorted(
        ((r.mmsi, r.vessel_name, r.ts, r.port_id, r.prev_port, r.prev_time, r.is_new_session, r.session_id) for r in got),
        key=repr,
    ) == sorted(
        (
            (m, n, None if s is None else at(s), p, pp, None if ps is None else at(ps), new, session)
            for (m, n, s, p), pp, ps, new, session in walk(rows, max_gap)
        ),
        key=repr,
    )


@pytest.mark.parametrize("slice_seconds", [10, 900])
@pytest.mark.parametrize("max_gap", [None, 600])
@pytest.mark.parametrize("case", CASES)
def test_stays_equal_a_walk(spark, case, slice_seconds, max_gap):
    rows = CASES[case]
    got = voyages.port_stays(frame(spark, rows), 60, max_gap, slice_seconds).collect()
    found = {(r.mmsi, r.vessel_name, r.port_id, r.session_id, r.arrival_time, r.departure_time, r.duration_seconds) for r in got}
    assert len(found) == len(got)
    assert found == walk_stays(rows, 60, max_gap)


def test_copies_of_pings_do_not_change_stays(spark):
    rows = CASES["mixed"]
    once = voyages.port_stays(frame(spark, rows)).collect()
    many = voyages.port_stays(frame(spark, rows * 50)).collect()
    assert sorted(once, key=repr) == sorted(many, key=repr)


def test_ping_in_two_ports_breaks_deterministically(spark):
    rows = [(1, "A", 0, 1), (1, "A", 10, 1), (1, "A", 10, 2), (1, "A", 20, 2)]
    got = voyages.sessionize(frame(spark, rows)).orderBy("ts", "port_id").collect()
    assert [r.session_id for r in got] == [1, 1, 2, 2]


def test_time_at_sea_does_not_break_a_session(spark):
    rows = [(1, "A", 0, 1), (1, "A", 10**6, 1)]
    assert {r.session_id for r in voyages.sessionize(frame(spark, rows)).collect()} == {1}
    assert {r.session_id for r in voyages.sessionize(frame(spark, rows), 3600).collect()} == {1, 2}


def test_stay_must_be_longer_than_the_limit(spark):
    def durations(end):
        return [r.duration_seconds for r in voyages.port_stays(frame(spark, [(1, "A", 0, 1), (1, "A", end, 1)])).collect()]

    assert durations(900) == []
    assert durations(901) == [901]


def test_whole_seconds_at_each_end(spark):
    rows = [(1, "A", 0.9, 1), (1, "A", 901.1, 1)]
    assert [r.duration_seconds for r in voyages.port_stays(frame(spark, rows)).collect()] == [901]
    rows = [(1, "A", 0.1, 1), (1, "A", 900.9, 1)]
    assert voyages.port_stays(frame(spark, rows)).count() == 0


def test_rename_splits_a_stay(spark):
    rows = [(1, "A", 0, 1), (1, "A", 1000, 1), (1, None, 1100, 1), (1, None, 2200, 1)]
    got = voyages.port_stays(frame(spark, rows)).collect()
    assert sorted((str(r.vessel_name), r.session_id, r.duration_seconds) for r in got) == [("A", 1, 1000), ("None", 1, 1100)]


def test_journeys_skip_same_port_and_last_stay(spark):
    stays = spark.createDataFrame(
        [(1, "A", p, name, i, at(i * 5000), at(i * 5000 + 2000), 2000) for i, (p, name) in enumerate(
            [(1, "X"), (1, "X"), (2, "Y"), (3, "Y"), (1, "X")], start=1)],
        "mmsi bigint, vessel_name string, port_id bigint, port_name string, session_id bigint, "
        "arrival_time timestamp_ntz, departure_time timestamp_ntz, duration_seconds bigint",
    )
    legs = voyages.journeys(stays)
    assert sorted((r.session_id, r.origin_port, r.destination_port) for r in legs.collect()) == [(2, "X", "Y"), (4, "Y", "X")]
    assert [tuple(r) for r in voyages.od_matrix(legs).collect()] == [("X", "Y", 1), ("Y", "X", 1)]


def test_short_stop_between_two_stays_in_one_port_is_no_journey(spark):
    rows = [(1, "A", 0, 1), (1, "A", 2000, 1), (1, "A", 2100, 2), (1, "A", 2200, 1), (1, "A", 4000, 1)]
    stays = voyages.port_stays(frame(spark, rows))
    assert [r.port_id for r in stays.orderBy("arrival_time").collect()] == [1, 1]
    assert voyages.journeys(stays).count() == 0


CROWDED = {
    **CASES,
    "missing times in many ports": [(1, "AB"[i % 2], None, i % 9) for i in range(200)] + [(1, "A", i, 3) for i in range(30)],
    "one second holds most": [(1, "A", 100, i % 5) for i in range(150)] + [(1, "A", 99 + i % 3, 2) for i in range(40)],
}


@pytest.mark.parametrize("case", CROWDED)
def test_crowded_slices_are_cut_without_a_difference(spark, case):
    rows = CROWDED[case]
    pings = frame(spark, rows)
    crowded = voyages.crowded_slices(pings, 900, 1)
    assert set(crowded.columns) == {"_vessel", "_slice", "_borders"}
    got = voyages.port_stays(pings, 60, None, 900, crowded).collect()
    found = {(r.mmsi, r.vessel_name, r.port_id, r.session_id, r.arrival_time, r.departure_time, r.duration_seconds) for r in got}
    assert len(found) == len(got) and found == walk_stays(rows, 60)
    sessions = voyages.sessionize(pings, None, 900, 1).collect()
    assert sorted((repr(r.ts), r.port_id, r.session_id, r.is_new_session) for r in sessions) == sorted(
        (repr(None if s is None else at(s)), p, session, new) for (_, _, s, p), _, _, new, session in walk(rows)
    )


def test_pieces_of_crowded_slices_are_bounded(spark):
    """A third of the pings under one id in one hour, another third without a time."""
    rows = [(0, "A", i * 0.12, i % 7) for i in range(20_000)] + [(0, "B", None, i) for i in range(20_000)]
    rows += [(i % 300 + 1, "C", i * 40, 1) for i in range(20_000)]
    pings = frame(spark, rows)
    slices = voyages.Slices(voyages.SLICE_SECONDS, voyages.crowded_slices(pings, most=500))
    sizes = [r["count"] for r in slices.cut(pings).groupBy(*slices.keys).count().collect()]
    assert sum(sizes) == len(rows) and max(sizes) <= 600 and len(sizes) > 80
    assert voyages.crowded_slices(pings) is None


def test_more_crowded_slices_than_are_cut(spark, monkeypatch):
    monkeypatch.setattr(voyages, "MOST_CROWDED", 5)
    pings = frame(spark, [(i % 40, "A", i % 700, 1) for i in range(8000)] + [(1, "A", i % 90, 1) for i in range(3000)])
    assert [r._vessel for r in voyages.crowded_slices(pings, most=20).collect()] == [1]


STAY = (
    "mmsi bigint, vessel_name string, port_id bigint, port_name string, session_id bigint, "
    "arrival_time timestamp_ntz, departure_time timestamp_ntz, duration_seconds bigint, _slot string, origin_port int"
)


@pytest.mark.parametrize("slice_seconds", [10, 900])
def test_journeys_equal_a_plain_window(spark, slice_seconds):
    """One id for 3,000 names, and NULL ids and port names besides."""
    rng = random.Random(9)
    rows = []
    for i in range(4000):
        start, port = rng.randrange(40_000), rng.randrange(4)
        mmsi = 0 if i < 3000 else rng.choice([1, 2, None])
        name = f"N{i}" if i < 3000 else rng.choice(["A", None])
        rows.append((mmsi, name, port, None if port == 3 else f"P{port % 2}", start // 7, at(start), at(start + 1000), 1000, "kept", i))
    stays = spark.createDataFrame(rows, STAY)
    order = lambda r: (key(r[0]), r[5], r[4], r[2], key(r[1]))
    expected = []
    for _, group in groupby(sorted(rows, key=order), key=lambda r: r[0]):
        group = list(group)
        expected += [(*a[:9], a[3], b[3]) for a, b in zip(group, group[1:]) if None not in (a[3], b[3]) and a[3] != b[3]]
    legs = voyages.journeys(stays, slice_seconds=slice_seconds)
    assert legs.columns == [c for c in stays.columns if c != "origin_port"] + ["origin_port", "destination_port"]
    assert sorted(map(tuple, legs.collect()), key=repr) == sorted(expected, key=repr)


def test_blocks_of_sessions_give_the_same_journeys(spark, monkeypatch):
    monkeypatch.setattr(voyages, "BLOCK_SESSIONS", 2)
    pings = frame(spark, CASES["mixed"])
    blocked = voyages.journeys(voyages.stay_blocks(pings, 60), "_block").drop("_block")
    plain = voyages.journeys(voyages.port_stays(pings, 60))
    assert plain.count() > 10 and sorted(map(tuple, blocked.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
