"""The journey search on arrays against the rounds on label tables."""

import random

import pytest

from tramline.operators import journey, netsearch

CALL = "event_id bigint, run_id bigint, stop_id bigint, arr_s bigint, dep_s bigint"
WALK = "from_stop bigint, to_stop bigint, walk_s bigint, metres double"


def network(spark, seed, stops=14):
    """Lines with several runs each, some of which overtake or call twice at a stop, and walks."""
    rng = random.Random(seed)
    rows, event = [], 0
    for line in range(8):
        calls = [rng.randrange(stops) for _ in range(6)]
        for run in range(5):
            t = run * 400 + rng.randrange(300)
            for s in calls:
                rows.append((event, 1000 - 10 * line - run, s, t, t + rng.choice([0, 20])))
                event += 1
                t += rng.choice([0, 30, 100, 600])
    walks = [(a, b, s, s * 50 / 60) for a in range(stops + 2) for b in range(stops + 2) for s in [rng.choice([0, 90, 90, 300])] if a != b and rng.random() < 0.2]
    st = journey.number_stops(spark.createDataFrame(rows, CALL))
    return st.persist(), spark.createDataFrame(walks, WALK).persist()


def both(monkeypatch, search):
    new = sorted(map(tuple, search().collect()), key=str)
    monkeypatch.setattr(netsearch, "fits", lambda *_: False)
    old = sorted(map(tuple, search().collect()), key=str)
    monkeypatch.undo()
    return new, old


@pytest.mark.parametrize("seed", [1, 2])
def test_arrays_give_what_label_tables_give(spark, monkeypatch, seed):
    st, walks = network(spark, seed)
    asked = [(i, i % 18, 130 * i) for i in range(18)]
    q = spark.createDataFrame(asked, "query_id bigint, source bigint, depart_at bigint")
    # labels of many batches
    monkeypatch.setattr(netsearch, "LABELS", 64)
    new, old = both(monkeypatch, lambda: journey.earliest_arrival(q, st, walks, 2500))
    assert new == old and len(new) > 100
    back = q.selectExpr("query_id", "source AS target", "depart_at AS start", "depart_at + 2000 AS limit")
    new, old = both(monkeypatch, lambda: journey.latest_times(back, st, walks))
    assert new == old and len(new) > 50


def test_jobs_do_not_grow_with_rides(spark):
    n = 9
    rows = [(2 * i + j, i, i + j, 1000 * i + 500 * j, 1000 * i + 500 * j) for i in range(n) for j in range(2)]
    st = journey.number_stops(spark.createDataFrame(rows, CALL))
    q = spark.createDataFrame([(1, 0, 0)], "query_id bigint, source bigint, depart_at bigint")
    sc = spark.sparkContext
    sc.setJobGroup("nine rides", "")
    try:
        got = {r.stop_id: r.arrival for r in journey.earliest_arrival(q, st, spark.createDataFrame([], WALK), 20000).collect()}
        jobs = len(sc.statusTracker().getJobIdsForGroup("nine rides"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert got == {0: 0} | {i + 1: 1000 * i + 500 for i in range(n)}
    assert jobs < 60


def test_what_does_not_fit_is_left_to_label_tables(spark, monkeypatch):
    st, walks = network(spark, 3)
    hops = walks.selectExpr("from_stop AS stop_id", "to_stop", "walk_s AS hop_s")
    calls = journey.route_patterns(st)
    q = spark.createDataFrame([(1, 2, 0, 900), (2, 2, 0, 900)], "query_id bigint, source bigint, depart_at bigint, horizon bigint")
    assert netsearch.fits(q, calls, hops)
    assert not netsearch.fits(q.union(q), calls, hops)
    assert not netsearch.fits(q.selectExpr("query_id", "nullif(source, 2) AS source", "depart_at", "horizon"), calls, hops)
    assert not netsearch.fits(q.selectExpr("query_id", "string(source) AS source", "depart_at", "horizon"), calls, hops)
    monkeypatch.setattr(netsearch, "MOST_ROWS", 100)
    assert not netsearch.fits(q, calls, hops)


def test_large_ids_are_kept(spark):
    """Columns are 32 bits wide in a worker where that is enough, and only there."""
    big = 1 << 40
    rows = [(0, big + 7, 1, 100, 100), (1, big + 7, big, 200, 210), (2, 7, big, 400, 400), (3, 7, 2, 500, 500)]
    st = journey.number_stops(spark.createDataFrame(rows, CALL))
    q = spark.createDataFrame([(big + 1, 1, 50)], "query_id bigint, source bigint, depart_at bigint")
    got = journey.earliest_arrival(q, st, spark.createDataFrame([(2, big + 9, 60, 50.0)], WALK), 5000)
    assert sorted((r.query_id - big, r.stop_id, r.arrival) for r in got.collect()) == [(1, 1, 50), (1, 2, 500), (1, big, 200), (1, big + 9, 560)]


def test_no_requests_send_no_network(spark, monkeypatch):
    st, walks = network(spark, 4)
    none = spark.createDataFrame([], "query_id bigint, target bigint, start bigint, limit bigint")
    monkeypatch.setattr(netsearch, "_packed", lambda *_: pytest.fail("the network was sent"))
    got = journey.latest_times(none, st, walks)
    assert got.columns == ["query_id", "stop_id", "board_by", "leave_by"] and got.count() == 0
