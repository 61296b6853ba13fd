"""Journey search against a small label-setting twin, and rules on journey options."""

import heapq
import random

import pytest
from pyspark.sql import functions as F

from tramline.operators import journey

STOPS = 12


@pytest.fixture(scope="module")
def network(spark):
    rng = random.Random(11)
    rows, event = [], 0
    for run in range(25):
        t = rng.randrange(0, 3000)
        for s in rng.sample(range(STOPS), 5):
            dwell = rng.choice([0, 20])
            rows.append((event, run, s, t, t + dwell))
            event += 1
            t += dwell + rng.randrange(60, 600)
    st = spark.createDataFrame(rows, "event_id bigint, run_id bigint, stop_id bigint, arr_s bigint, dep_s bigint")
    walks = {(a, b): rng.randrange(60, 500) for a in range(STOPS) for b in range(STOPS) if a != b and rng.random() < 0.2}
    w = spark.createDataFrame(
        [(a, b, s, s * 50 / 60) for (a, b), s in walks.items()], "from_stop bigint, to_stop bigint, walk_s bigint, metres double"
    )
    return rows, walks, st.persist(), w.persist()


def twin(rows, walks, source, start, limit, change=120):
    """Earliest arrivals; states are (stop, walked, ridden) and (run, position)."""
    runs = {}
    for _, run, s, a, d in rows:
        runs.setdefault(run, []).append((s, a, d))
    best, done, heap = {}, set(), [(start, source, 0, 0)]
    while heap:
        t, s, walked, ridden = heapq.heappop(heap)
        if (s, walked, ridden) in done or t > start + limit:
            continue
        done.add((s, walked, ridden))
        best[s] = min(best.get(s, t), t)
        if not walked:
            for (a, b), sec in walks.items():
                if a == s:
                    heapq.heappush(heap, (t + sec, b, 1, ridden))
        ready = t + (change if ridden else 0)
        for calls in runs.values():
            for i, (x, _, d) in enumerate(calls):
                if x == s and ready <= d <= start + limit:
                    for y, a, _ in calls[i + 1 :]:
                        heapq.heappush(heap, (a, y, 0, 1))
    return {s: t for s, t in best.items() if t <= start + limit}


def test_earliest_arrival_matches_twin(spark, network):
    rows, walks, st, w = network
    asked = [(i, i % STOPS, 100 * i) for i in range(15)]
    q = spark.createDataFrame(asked, "query_id bigint, source bigint, depart_at bigint")
    out = journey.earliest_arrival(q, journey.number_stops(st), w, 2500).collect()
    for i, source, start in asked:
        mine = {r.stop_id: r.arrival for r in out if r.query_id == i}
        assert mine == twin(rows, walks, source, start, 2500)
    assert all(r.walk_s >= 0 and r.ride_s >= 0 for r in out)


def test_runs_never_go_back_in_time(spark):
    st = spark.createDataFrame(
        [(1, 1, 5, 100, 140), (2, 1, 6, 120, 121), (3, 1, 7, 300, 300)],
        "event_id bigint, run_id bigint, stop_id bigint, arr_s bigint, dep_s bigint",
    )
    got = journey.number_stops(st).orderBy("seq").collect()
    assert [(r.seq, r.dep_s) for r in got] == [(1, 120), (2, 121), (3, 300)]


def paths(spark, network, asked, **kw):
    _, _, st, w = network
    q = spark.createDataFrame(
        asked, "query_id bigint, source bigint, target bigint, depart_at bigint, arrive_by bigint, confidence double"
    )
    tt = journey.number_stops(st).withColumn("line_id", F.col("run_id") % 3)
    delays = spark.createDataFrame(
        [(0, 0, 30, 60, 90), (1, 10, 20, 40, 80), (2, -20, -5, 5, 15)],
        "line_id bigint, q50 bigint, q75 bigint, q90 bigint, q95 bigint",
    )
    return journey.robust_paths(q, tt, w, delays, **kw)


def test_robust_paths_are_sound(spark, network):
    rows, walks, _, _ = network
    level = [0.5, 0.75, 0.9, 0.95]
    asked = [(i, i % STOPS, (i * 5 + 3) % STOPS, 50 * i, None, level[i % 4]) for i in range(16)]
    asked += [(100 + i, i % STOPS, (i * 7 + 2) % STOPS, None, 2500 + 100 * i, level[i % 4]) for i in range(8)]
    asked.append((900, 4, 4, 777, None, 0.5))
    out = paths(spark, network, asked, max_duration=4000).collect()
    by_id = {a[0]: a for a in asked}
    calls = {}
    for _, run, s, a, d in rows:
        calls.setdefault(run, []).append((s, a, d))
    assert out
    for r in out:
        _, source, target, depart, arrive, _ = by_id[r.query_id]
        if source == target:
            assert r.legs is None and r.arrival == (depart if depart is not None else arrive - 7200)
            continue
        assert r.legs[0].from_stop == source and r.legs[-1].to_stop == target
        assert r.walk_m <= 500 and abs(sum(x.walk_m for x in r.legs) - r.walk_m) < 1e-9
        assert r.arrival == r.legs[-1].arr_s and r.departure == r.legs[0].dep_s
        if depart is not None:
            assert r.departure >= depart
        if arrive is not None:
            assert r.arrival <= arrive
        seen = [source] + [x.to_stop for x in r.legs]
        assert len(seen) == len(set(seen))
        for a, b in zip(r.legs, r.legs[1:]):
            assert a.to_stop == b.from_stop
            assert not (a.kind == "WALK" and b.kind == "WALK")
            assert b.dep_s >= a.arr_s
            if a.kind == b.kind == "PT":
                assert b.dep_s >= a.arr_s + 120
        for x in r.legs:
            if x.kind == "PT":
                at = [c[0] for c in calls[x.run_id]]
                assert at.index(x.from_stop) < at.index(x.to_stop)
            else:
                assert (x.from_stop, x.to_stop) in walks


def test_robust_paths_find_the_earliest_arrival(spark, network):
    """With certain punctuality and a generous walking cap the best option equals the exact search."""
    rows, walks, st, w = network
    asked = [(i, i % STOPS, (i * 5 + 3) % STOPS, 50 * i, None, 0.5) for i in range(12) if i % STOPS != (i * 5 + 3) % STOPS]
    _, _, st, w = network
    q = spark.createDataFrame(
        asked, "query_id bigint, source bigint, target bigint, depart_at bigint, arrive_by bigint, confidence double"
    )
    tt = journey.number_stops(st).withColumn("line_id", F.lit(0).cast("bigint"))
    none = spark.createDataFrame([(0, 0, 0, 0, 0)], "line_id bigint, q50 bigint, q75 bigint, q90 bigint, q95 bigint")
    got = journey.robust_paths(q, tt, w, none, max_walk_m=1e9, max_duration=2500)
    best = {r.query_id: r.a for r in got.groupBy("query_id").agg(F.min("arrival").alias("a")).collect()}
    for i, s, t, start, _, _ in asked:
        assert best.get(i) == twin(rows, walks, s, start, 2500).get(t)


LEG_COLUMNS = (
    "option_id bigint, query_id bigint, leg_no int, from_stop bigint, to_stop bigint, dep_s bigint, arr_s bigint,"
    " kind string, leg_trip bigint, line_id bigint"
)


@pytest.fixture(scope="module")
def legs(spark):
    return spark.createDataFrame(
        [
            (1, 1, 1, 10, 11, 100, 200, "PT", 7, 1), (1, 1, 2, 11, 12, 200, 260, "WALK", 7, 1),
            (1, 1, 3, 12, 13, 400, 500, "PT", 8, 2), (2, 1, 1, 10, 11, 100, 200, "PT", 7, 1),
            (2, 1, 2, 11, 12, 210, 300, "PT", 7, 1), (3, 1, 1, 10, 11, 0, 10, "PT", 7, 1),
            (3, 1, 2, 11, 12, 300, 310, "PT", 9, 1), (3, 1, 3, 12, 10, 600, 700, "PT", 9, 1),
        ],
        LEG_COLUMNS,
    )


def test_changes_and_loops(legs):
    assert {r.option_id: r.changes for r in journey.count_changes(legs).collect()} == {1: 1, 2: 0, 3: 1}
    assert {r.option_id: r.has_loop for r in journey.has_loop(legs).collect()} == {1: False, 2: False, 3: True}


def test_confidence_and_replay(spark, legs):
    seen = [(1, 7, 11, d, late) for d, late in enumerate([0, 50, 100, 500])] + [(2, 8, 13, 0, 10)]
    v = spark.createDataFrame(
        [(a, b, c, f"2024-01-0{d + 1}", e) for a, b, c, d, e in seen],
        "line_id bigint, trip_id bigint, stop_id bigint, operating_day string, delay_s bigint",
    ).withColumn("hour", F.lit(9))
    got = {r.option_id: r.confidence for r in journey.option_confidence(legs, v).collect()}
    # option 1: slack 400 - 200 - 120 = 80 on line 1 -> two of four; option 3: slack 170 -> three of four
    assert got[1] == pytest.approx(0.5) and got[2] == 1.0 and got[3] == pytest.approx(0.75)
    share = {r.option_id: r.share for r in journey.replay(legs, v).collect()}
    # option 1 holds on days 1 and 2 of four; option 3 holds on three of four
    assert share[1] == pytest.approx(0.5) and share[3] == pytest.approx(0.75)


def test_confidence_backs_off(spark, legs):
    """The finest level with enough observations counts: (line, stop, hour), (line, stop), line."""

    def confidence(*groups):
        rows = [(1, stop, hour, late) for stop, hour, lates in groups for late in lates]
        v = spark.createDataFrame(rows, "line_id bigint, stop_id bigint, hour int, delay_s bigint")
        return {r.option_id: r.confidence for r in journey.option_confidence(legs, v, least=2).collect()}[1]

    # option 1 changes at stop 11 in hour 0 with a slack of 80
    other = (99, 5, [500] * 6)
    assert confidence(other, (11, 5, [0, 500, 500, 500]), (11, 0, [0, 50])) == pytest.approx(1.0)
    assert confidence(other, (11, 5, [0, 500, 500]), (11, 0, [50])) == pytest.approx(0.5)
    assert confidence(other, (11, 0, [0])) == pytest.approx(1 / 7)
    assert confidence(other, (11, 0, [100, 200])) == 0.0


def test_route_patterns(spark):
    from tramline.operators.labels import route_patterns

    rows = [(r, s, 10 + s, t + 60 * s, t + 60 * s) for r, t in ((1, 0), (2, 100), (3, 200)) for s in (1, 2, 3)]
    rows += [(4, 1, 11, 150, 150), (4, 2, 12, 155, 155), (4, 3, 13, 160, 160)]  # overtakes run 2
    rows += [(5, 1, 11, 0, 0), (5, 2, 13, 60, 60)]  # other stops
    tt = spark.createDataFrame(rows, "run_id bigint, seq bigint, stop_id bigint, arr_s bigint, dep_s bigint")
    got = {}
    for r in route_patterns(tt).collect():
        got.setdefault(r.pattern_id, {}).setdefault(r.run_no, []).append((r.seq, r.run_id, r.prev_dep, r.dep_s))
    by_run = {row[1]: (p, no) for p, runs in got.items() for no, calls in runs.items() for row in calls}
    assert by_run[1][0] == by_run[2][0] == by_run[3][0] and [by_run[i][1] for i in (1, 2, 3)] == [1, 2, 3]
    assert len({by_run[i][0] for i in (1, 4, 5)}) == 3
    assert sorted(got[by_run[2][0]][2]) == [(1, 2, 60, 160), (2, 2, 120, 220), (3, 2, 180, 280)]


def test_times_of_the_earliest_arrival(spark):
    """Walk 50, ride 100 to 300, walk 60, change, ride 600 to 900; and on foot only."""
    tt = spark.createDataFrame(
        [(1, 1, 2, 100, 100), (1, 2, 3, 300, 300), (2, 1, 4, 600, 600), (2, 2, 5, 900, 910)],
        "run_id bigint, seq bigint, stop_id bigint, arr_s bigint, dep_s bigint",
    )
    walks = spark.createDataFrame([(1, 2, 50), (3, 4, 60)], "from_stop bigint, to_stop bigint, walk_s bigint")
    q = spark.createDataFrame([(7, 1, 10)], "query_id bigint, source bigint, depart_at bigint")
    got = {r.stop_id: (r.arrival, r.walk_s, r.ride_s) for r in journey.earliest_arrival(q, tt, walks, 5000).collect()}
    assert got == {1: (10, 0, 0), 2: (60, 50, 0), 3: (300, 50, 200), 4: (360, 110, 200), 5: (900, 110, 500)}


def test_diversify(spark):
    rows = [
        (1, 1, 1000, 100, 0, "a", "s1"), (1, 2, 1001, 101, 0, "a", "s2"), (1, 3, 1002, 102, 0, "b", "s1"),
        (1, 4, 1003, 1900, 0, "a", "s4"), (2, 5, 10, 0, 0, "a", "s1"), (2, 6, 11, 0, 0, "a", "s1"),
        (2, 7, 12, 0, 0, "a", "s2"),
    ]
    df = spark.createDataFrame(
        rows, "query_id bigint, option_id bigint, arrival bigint, departure bigint, changes int, first_trips string, signature string"
    )
    got = sorted((r.query_id, r.option_no, r.option_id) for r in journey.diversify(df, 3).collect())
    # query 1: three footprints; query 2: one footprint, then one more leg sequence
    assert got == [(1, 1, 1), (1, 2, 3), (1, 3, 4), (2, 1, 5), (2, 2, 7)]


def test_transfer_rule(spark):
    pairs = spark.createDataFrame([(1, 2), (1, 1), (1, 3), (1, 4), (2, 3)], "from_stop bigint, to_stop bigint")
    explicit = spark.createDataFrame([(1, 2, 300), (2, 3, None)], "from_stop bigint, to_stop bigint, min_transfer_time int")
    walks = spark.createDataFrame([(1, 3, 250.0), (1, 4, 900.0)], "from_stop bigint, to_stop bigint, metres double")
    got = {(r.from_stop, r.to_stop): r.change_s for r in journey.transfer_seconds(pairs, explicit, walks).collect()}
    assert got == {(1, 2): 300.0, (1, 1): 120.0, (1, 3): 420.0, (1, 4): None, (2, 3): None}


@pytest.mark.parametrize("limit", [2, 10**6])
def test_next_departure(spark, limit):
    conns = spark.createDataFrame(
        [(1, 2, 100, 150, 1), (1, 2, 200, 250, 2), (1, 2, 300, 320, 3), (5, 6, 50, 60, 4)],
        "from_stop bigint, to_stop bigint, dep_s bigint, arr_s bigint, run_id bigint",
    )
    asked = spark.createDataFrame(
        [(1, 1, 2, 100), (2, 1, 2, 101), (3, 1, 2, 301), (4, 5, 6, 0)],
        "request_id bigint, from_stop bigint, to_stop bigint, t bigint",
    )
    got = {r.request_id: r.run_id for r in journey.next_departure(asked, conns, limit).collect()}
    assert got == {1: 1, 2: 2, 3: None, 4: 4}


def test_terminal_stop_has_no_onward_connection(spark):
    st = spark.createDataFrame(
        [(1, 1, 1, 5, 0, 0), (2, 1, 1, 6, 60, 70), (3, 1, 1, 7, 120, 130), (4, 2, 1, 6, 10, 10), (5, 2, 1, 5, 70, 70)],
        "event_id bigint, run_id bigint, trip_id bigint, stop_id bigint, arr_s bigint, dep_s bigint",
    )
    got = {r.stop_id: r.terminal_only for r in journey.terminal_stops(st).collect()}
    assert got == {7: True, 5: False}
    assert sorted((r.from_stop, r.to_stop) for r in journey.connections(st).collect()) == [(5, 6), (6, 5), (6, 7)]


def test_service_days_stay_in_the_window(spark):
    from tramline.operators import transit

    days = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
    calendar = spark.createDataFrame([(1, *[True] * 5, False, False)], "service_id int, " + ", ".join(f"{d} boolean" for d in days))
    rows = [(1, "2024-01-06", 1), (1, "2030-01-05", 1), (1, "2023-12-30", 1), (1, "2024-01-03", 2)]
    exceptions = spark.createDataFrame(rows, "service_id int, day string, exception_type int").withColumn("day", F.to_date("day"))
    got = sorted(str(r.day) for r in transit.service_days(calendar, exceptions, "2024-01-01", "2024-01-07").collect())
    assert got == ["2024-01-01", "2024-01-02", "2024-01-04", "2024-01-05", "2024-01-06"]


def stored_stops(spark, path):
    """Stops as a small file, whose size would let the planner collect them."""
    rows = spark.range(400).selectExpr(
        "id AS stop_id", "CAST(46.5 + id % 20 / 1000 AS DOUBLE) AS lat", "CAST(6.5 + id DIV 20 / 1000 AS DOUBLE) AS lon"
    )
    rows.write.parquet(f"{path}/stops")
    return spark.read.parquet(f"{path}/stops")


def test_network_stats_send_no_copies_of_stops_to_the_driver(spark, tmp_path):
    from tramline.operators.transit import footpaths

    walks = footpaths(stored_stops(spark, tmp_path))
    conns = spark.createDataFrame([(1, 2), (2, 1), (1, 3), (1, 2)], "from_stop bigint, to_stop bigint")
    got = journey.network_stats(conns, walks)
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()
    found = {r.measure: r.value for r in got.collect()}
    assert found == {"nodes": 400, "stop_pairs": 3, "connections": 4, "walks": walks.count(), "max_degree": 2}


def test_transfer_time_sends_no_copies_of_stops_to_the_driver(spark, tmp_path):
    from tramline.operators.transit import footpaths

    walks = footpaths(stored_stops(spark, tmp_path))
    explicit = spark.createDataFrame([(0, 399, 60)], "from_stop bigint, to_stop bigint, min_transfer_time int")
    got = journey.transfer_seconds(explicit.unionByName(walks, allowMissingColumns=True), explicit, walks)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [_c0" in plan and "BroadcastHashJoin [_c0" not in plan
    assert got.count() == walks.count() + 1 and got.where("change_s = 60").count() == 1
