"""Batch journey search in rounds, and operators on journey options.

All requests of a table are answered together: a round is a join of the open
labels with departures, a join along the boarded runs, and a join with the
footpaths. Rounds follow the published round-based transit routing idea
(Delling, Pajor, Werneck); every round is written out to keep lineage short.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramline.functions.timefn import format_seconds
from tramline.operators import netsearch, ordered
from tramline.operators.labels import LabelTable, route_patterns
from tramline.operators.transit import CHANGE_SECONDS, MAX_WALK_METRES, WALK_METRES_PER_MINUTE
from tramline.session import cut_lineage

LEG = "struct<from_stop:bigint,to_stop:bigint,dep_s:bigint,arr_s:bigint,kind:string,run_id:bigint,walk_m:double>"


def number_stops(stop_times: DataFrame) -> DataFrame:
    """Stop times with their position in the run; a departure listed after the
    next arrival is pulled back to it, so times never decrease along a run."""
    order = ["arr_s", "event_id"]
    placed = ordered.chunked(stop_times, ["run_id"], order)
    placed = ordered.row_numbers(placed, ["run_id"], order, "seq")
    placed = ordered.neighbour(placed, ["run_id"], order, F.struct("arr_s"), "_n", step=1)
    dep = F.least(F.col("dep_s"), F.coalesce("_n.arr_s", "dep_s"))
    return placed.withColumn("dep_s", dep).drop("_n", ordered.CHUNK)


def consecutive(stop_times: DataFrame) -> DataFrame:
    """Each stop of a run with the next one; times may be equal or run backwards."""
    nxt = ordered.neighbour(
        stop_times, ["run_id"], ["arr_s", "event_id"], F.struct("stop_id", "arr_s"), "n", step=1
    )
    return nxt.where("n IS NOT NULL").select(
        "run_id", "trip_id", F.col("stop_id").alias("from_stop"), F.col("n.stop_id").alias("to_stop"),
        "dep_s", F.col("n.arr_s").alias("arr_s"),
    )


def connections(stop_times: DataFrame) -> DataFrame:
    """Directed rides between consecutive stops that do not arrive before they leave."""
    return consecutive(stop_times).where("arr_s >= dep_s")


def terminal_stops(stop_times: DataFrame) -> DataFrame:
    """Stops with listed departures from which a run does not go on, and whether none does."""
    nxt = ordered.neighbour(
        stop_times, ["run_id"], ["arr_s", "event_id"], F.struct("stop_id"), "n", step=1
    )
    per = nxt.groupBy("stop_id").agg(
        F.count(F.lit(1)).alias("departures"), F.count_if(F.col("n").isNull()).alias("ending")
    )
    return per.where("ending > 0").withColumn("terminal_only", F.col("ending") == F.col("departures"))


def network_stats(conns: DataFrame, walks: DataFrame) -> DataFrame:
    """Nodes, distinct stop pairs, connections, walks and the largest out-degree, as rows."""
    edges = conns.groupBy("from_stop", "to_stop").agg(F.count(F.lit(1)).alias("n"))
    ends = F.explode(F.array("from_stop", "to_stop")).alias("s")
    nodes = edges.select(ends).union(walks.select(ends)).distinct()
    degree = edges.groupBy("from_stop").agg(F.count(F.lit(1)).alias("d"))

    def row(name: str, df: DataFrame, value: Column) -> DataFrame:
        return df.agg(value.cast("bigint").alias("value")).select(F.lit(name).alias("measure"), "value")

    return (
        row("nodes", nodes, F.count(F.lit(1)))
        .unionByName(row("stop_pairs", edges, F.count(F.lit(1))))
        .unionByName(row("connections", edges, F.sum("n")))
        .unionByName(row("walks", walks, F.count(F.lit(1))))
        .unionByName(row("max_degree", degree, F.max("d")))
    )


def transfer_seconds(pairs: DataFrame, explicit: DataFrame, walks: DataFrame) -> DataFrame:
    """Change time per (from, to): explicit table, same stop, walk up to 500 m, or NULL."""
    table = explicit.groupBy("from_stop", "to_stop").agg(F.min("min_transfer_time").alias("explicit_s"))
    on = ["from_stop", "to_stop"]
    j = pairs.select(*on).distinct().join(table, on, "left").join(walks.select(*on, "metres"), on, "left")
    rule = (
        F.when(F.col("explicit_s").isNotNull(), F.col("explicit_s").cast("double"))
        .when(F.col("from_stop") == F.col("to_stop"), float(CHANGE_SECONDS))
        .when(F.col("metres") <= MAX_WALK_METRES, CHANGE_SECONDS + F.col("metres") * 60 / WALK_METRES_PER_MINUTE)
    )
    return j.select(*on, rule.alias("change_s"))


def transfers_between(transfers: DataFrame, stops: DataFrame) -> DataFrame:
    """Explicit transfers whose both ends are among ``stops``."""
    ids = stops.select("stop_id").distinct()
    a = transfers.join(ids.withColumnRenamed("stop_id", "from_stop"), "from_stop", "left_semi")
    return a.join(ids.withColumnRenamed("stop_id", "to_stop"), "to_stop", "left_semi")


def next_departure(requests: DataFrame, conns: DataFrame, chunks: int | None = None) -> DataFrame:
    """For every (from, to, t) the first connection of that edge leaving at or after ``t``.

    Requests and connections are interleaved in time and the next connection is
    carried back to the requests, so no request meets all departures of its edge.
    """
    on = ["from_stop", "to_stop"]
    c = conns.select(
        *on, F.col("dep_s").alias("t"), F.lit(1).alias("_kind"), F.col("run_id").alias("_tie"),
        F.struct("dep_s", "arr_s", "run_id").alias("_c"),
    )
    rq = requests.select(
        *on, "t", F.lit(0).alias("_kind"), F.col("request_id").alias("_tie"), "request_id"
    )
    both = rq.unionByName(c, allowMissingColumns=True)
    got = ordered.carry(both, on, ["t", "_kind", "_tie"], following={"_n": F.col("_c")}, chunks=chunks)
    return got.where("_kind = 0").select("request_id", *on, "t", "_n.dep_s", "_n.arr_s", "_n.run_id")


def segment_durations(conns: DataFrame) -> DataFrame:
    return conns.groupBy("trip_id", "from_stop", "to_stop").agg(
        F.avg(F.col("arr_s") - F.col("dep_s")).alias("mean_s"), F.count(F.lit(1)).alias("n")
    )


def _on_foot(places: DataFrame, hops: DataFrame) -> DataFrame:
    """(query, stop, arrival) after one walk from (query, stop, arrival, horizon)."""
    j = places.join(hops, "stop_id").where(F.col("arrival") + F.col("hop_s") <= F.col("horizon"))
    return j.select(
        "query_id", F.col("to_stop").alias("stop_id"), (F.col("arrival") + F.col("hop_s")).alias("arrival"), "horizon",
        F.struct(F.col("stop_id").alias("walked_from"), "hop_s").alias("walk"),
    )


class _Search:
    """Labels of a finished search: without a ride, after a ride, and boarded runs of patterns."""

    def __init__(self, queries: DataFrame, timetable: DataFrame, walks: DataFrame, change_s: int):
        """``queries``: query_id, source, depart_at, horizon (the latest arrival)."""
        if change_s < 1:
            raise ValueError("changing must take time")
        self.change_s = change_s
        self.hops = walks.select(F.col("from_stop").alias("stop_id"), "to_stop", F.col("walk_s").alias("hop_s"))
        self.network = cut_lineage(route_patterns(timetable))
        spark = queries.sparkSession
        self.ready, self.landed = (LabelTable(spark, ["query_id", "stop_id"]) for _ in range(2))
        self.boarded = LabelTable(spark, ["query_id", "pattern_id"])
        self.queries = queries

    def run(self) -> _Search:
        origin = self.queries.select(
            "query_id", F.col("source").alias("stop_id"), F.col("depart_at").alias("arrival"), "horizon"
        )
        first = origin.unionByName(_on_foot(origin, self.hops).drop("walk")).groupBy("query_id", "stop_id", "horizon")
        self.first = cut_lineage(first.agg(F.min("arrival").alias("arrival")))
        open_labels = self.ready.append(self.first.withColumnRenamed("arrival", "ready"))
        while True:
            landed = self.landed.append(self.landed.better(self._rides(self._boards(open_labels)), "arrival"))
            if landed.isEmpty():
                return self
            places = landed.unionByName(_on_foot(landed, self.hops).drop("walk")).groupBy("query_id", "stop_id")
            changing = places.agg((F.min("arrival") + self.change_s).alias("ready"), F.max("horizon").alias("horizon"))
            open_labels = self.ready.append(self.ready.better(changing, "ready"))

    def _boards(self, open_labels: DataFrame) -> DataFrame:
        """Boardings of this round that serve stops no other boarding serves as early, with the last stop they serve.

        A boarding further up a pattern in the same or an earlier run makes another one
        useless; one further down takes over from its own stop on.
        """
        at_stop = self.network.select("stop_id", "pattern_id", "seq", "run_no", "dep_s", "prev_dep")
        met = open_labels.join(at_stop, "stop_id").where(
            "ready <= dep_s AND (prev_dep IS NULL OR ready > prev_dep) AND dep_s <= horizon"
        )
        new = met.select("query_id", "pattern_id", "seq", "run_no", "dep_s", "horizon")
        by = ["query_id", "pattern_id"]
        if self.boarded.rounds:
            old = self.boarded.all().select(*by, F.col("seq").alias("_seq"), F.col("run_no").alias("_no"))
            held = (F.col("_no") <= F.col("run_no")) & (F.col("_seq") <= F.col("seq"))
            later = F.when((F.col("_no") <= F.col("run_no")) & (F.col("_seq") > F.col("seq")), F.col("_seq"))
            per = new.hint("shuffle_hash").join(old, by, "left").groupBy(*by, "seq", "run_no", "dep_s", "horizon")
            per = per.agg(F.max(held).alias("_held"), F.min(later).alias("until"))
            new = per.where("NOT coalesce(_held, false)").drop("_held")
        else:
            new = new.withColumn("until", F.lit(None).cast("int"))
        w = Window.partitionBy(*by).orderBy("seq")
        before = F.min("run_no").over(w.rowsBetween(Window.unboundedPreceding, -1))
        new = new.withColumn("_before", before).where("_before IS NULL OR run_no < _before").drop("_before")
        return self.boarded.append(new.withColumn("until", F.least("until", F.lead("seq").over(w))))

    def _rides(self, boards: DataFrame) -> DataFrame:
        """Earliest arrivals of this round's boardings."""
        along = self.network.select(
            "pattern_id", "run_no", F.col("seq").alias("to_seq"), F.col("stop_id").alias("to_stop"), "arr_s"
        )
        rides = boards.join(along, ["pattern_id", "run_no"]).where(
            "to_seq > seq AND (until IS NULL OR to_seq <= until) AND arr_s <= horizon"
        )
        per = rides.groupBy("query_id", F.col("to_stop").alias("stop_id"))
        return per.agg(F.min("arr_s").alias("arrival"), F.max("horizon").alias("horizon"))

    def labels(self) -> DataFrame:
        """Per query and stop the earliest arrival of each kind: ``unridden``, ``ridden``, ``walked``, with the walk."""
        key = ["query_id", "stop_id"]
        ridden = self.landed.all().groupBy(*key).agg(F.min("arrival").alias("arrival"), F.max("horizon").alias("horizon"))
        ridden = cut_lineage(ridden)
        walked = _on_foot(ridden, self.hops).groupBy(*key).agg(F.min(F.struct("arrival", "walk")).alias("_w"))
        parts = [
            self.first.select(*key, F.col("arrival").alias("unridden")),
            ridden.select(*key, F.col("arrival").alias("ridden")),
            walked.select(*key, F.col("_w.arrival").alias("walked"), F.col("_w.walk").alias("walk")),
        ]
        rows = parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)
        each = [F.max(c).alias(c) for c in ("unridden", "ridden", "walked", "walk")]
        return cut_lineage(rows.groupBy(*key).agg(*each))

    def times(self, labels: DataFrame, queries: DataFrame) -> DataFrame:
        """``query_id, stop_id, arrival, walk_s, ride_s`` along the journeys that the labels make.

        A ridden arrival comes by the run that starts first (then of smallest id) of those that
        arrive then, boarded at its first stop where the passenger can be ready. A passenger is
        ready without a ride, else after a ride there, else after a walk (from the stop of
        smallest id) if that is earliest. Seconds add up along these steps, in doubling strides.
        """
        key = ["query_id", "stop_id"]
        calls = self.network.select(
            "stop_id", F.col("arr_s").alias("ridden"), "pattern_id", "run_no", F.col("seq").alias("to_seq"), "first_dep", "run_id"
        )
        came = labels.where("ridden IS NOT NULL").select(*key, "ridden").join(calls, ["stop_id", "ridden"])
        boards = self.boarded.all().select("query_id", "pattern_id", "run_no", "seq", "dep_s")
        by = came.join(boards, ["query_id", "pattern_id", "run_no"]).where("seq < to_seq")
        best = F.min(F.struct("first_dep", "run_id", "seq", "pattern_id", (F.col("ridden") - F.col("dep_s")).alias("ride_s"))).alias("_b")
        by = by.groupBy(*key).agg(best).select(*key, "_b.*")
        stops = self.network.select("run_id", "seq", F.col("stop_id").alias("board"))
        by = by.join(stops, ["run_id", "seq"])
        last = F.least("unridden", F.col("ridden") + self.change_s, F.col("walked") + self.change_s)
        source = labels.join(queries.select("query_id", "depart_at"), "query_id").select(
            "query_id", F.col("stop_id").alias("board"),
            F.when(F.col("unridden") == last, F.lit(None)).when(F.col("ridden") + self.change_s == last, F.col("stop_id"))
            .otherwise(F.col("walk.walked_from")).alias("before"),
            F.when(F.col("unridden") == last, F.col("unridden") - F.col("depart_at")).when(F.col("ridden") + self.change_s == last, 0)
            .otherwise(F.col("walk.hop_s")).alias("walk_s"),
        )
        steps = by.join(source, ["query_id", "board"]).select(*key, "before", "walk_s", "ride_s")
        steps = cut_lineage(steps)
        while True:
            ahead = steps.select(
                "query_id", F.col("stop_id").alias("before"), F.col("before").alias("_b"), F.col("walk_s").alias("_w"), F.col("ride_s").alias("_r")
            )
            zero = F.lit(0)
            strides = steps.join(ahead, ["query_id", "before"], "left").select(
                *key, F.col("_b").alias("before"), (F.col("walk_s") + F.coalesce("_w", zero)).alias("walk_s"),
                (F.col("ride_s") + F.coalesce("_r", zero)).alias("ride_s"),
            )
            steps = cut_lineage(strides)
            if steps.where("before IS NOT NULL").isEmpty():
                break
        # the arrival's own kind; a walk after a ride starts where that ride ended
        arrival = F.least("unridden", "ridden", "walked")
        ends = labels.join(queries.select("query_id", "depart_at"), "query_id").withColumn("arrival", arrival).select(
            *key, "arrival",
            F.when(F.col("unridden") == arrival, F.lit(None)).when(F.col("ridden") == arrival, F.col("stop_id"))
            .otherwise(F.col("walk.walked_from")).alias("last"),
            F.when(F.col("unridden") == arrival, F.col("unridden") - F.col("depart_at")).when(F.col("ridden") == arrival, 0)
            .otherwise(F.col("walk.hop_s")).alias("own_s"),
        )
        so_far = steps.select("query_id", F.col("stop_id").alias("last"), "walk_s", "ride_s")
        out = ends.join(so_far, ["query_id", "last"], "left")
        return out.select(
            *key, "arrival", (F.col("own_s") + F.coalesce("walk_s", F.lit(0))).cast("bigint").alias("walk_s"),
            F.coalesce("ride_s", F.lit(0)).cast("bigint").alias("ride_s"),
        )

    def beside(self, times: bool = False) -> DataFrame | None:
        """``labels``, or their ``times``, by ``netsearch`` if the network is small enough to lie in every task."""
        if netsearch.fits(self.queries, self.network, self.hops):
            return netsearch.search(self.queries, self.network, self.hops, self.change_s, times)
        return None

    def drop(self) -> None:
        for labels in (self.ready, self.landed, self.boarded):
            labels.drop()


def earliest_arrival(
    queries: DataFrame, timetable: DataFrame, walks: DataFrame, max_duration: int,
    change_s: int = CHANGE_SECONDS, times: bool = True,
) -> DataFrame:
    """Earliest arrival at every stop within ``max_duration`` seconds of each request.

    ``queries``: query_id, source, depart_at; ``timetable``: run_id, seq, stop_id,
    arr_s, dep_s, times not decreasing along a run; ``walks``: from_stop, to_stop,
    walk_s. A journey walks at most once before, between and after rides. Changing
    between rides takes ``change_s`` (at least a second); staying on a run takes nothing.
    With ``times`` also the seconds walked and ridden on the way.

    Runs are grouped into patterns without overtaking, and a label boards the first run of
    a pattern. What is found lies in bucketed label tables; a round boards, rides and walks
    from the labels that the round before improved, a boarding rides no further than the stop from
    which an earlier one serves the run, and rounds end when nothing improves, so the answer is
    exact without a limit on rounds. Where a worker can hold the network, the rounds run on arrays
    in tasks that have a copy of it each (``netsearch``).
    """
    asked = queries.withColumn("horizon", F.col("depart_at") + max_duration)
    search = _Search(asked, timetable, walks, change_s)
    try:
        found = search.beside(times)
        if found is not None and times:
            return found
        labels = search.run().labels() if found is None else found
        if times:
            return cut_lineage(search.times(labels, queries))
        return labels.select("query_id", "stop_id", F.least("unridden", "ridden", "walked").alias("arrival"))
    finally:
        search.drop()


def isochrone(arrivals: DataFrame, queries: DataFrame, stops: DataFrame, minutes: int = 15) -> DataFrame:
    """Reachable stops with name, place and band of travel time."""
    j = arrivals.join(queries.select("query_id", "depart_at"), "query_id").join(
        stops.select("stop_id", "stop_name", "lat", "lon"), "stop_id"
    )
    band = F.floor((F.col("arrival") - F.col("depart_at")) / (60 * minutes)) * minutes
    return j.select("query_id", "stop_id", "stop_name", "lat", "lon", band.alias("band_minutes"))


def _search_labels(queries: DataFrame, timetable: DataFrame, walks: DataFrame, change_s: int) -> DataFrame:
    search = _Search(queries, timetable, walks, change_s)
    try:
        found = search.beside()
        return search.run().labels() if found is None else found
    finally:
        search.drop()


def latest_times(queries: DataFrame, timetable: DataFrame, walks: DataFrame, change_s: int = CHANGE_SECONDS) -> DataFrame:
    """``query_id, stop_id, board_by, leave_by``: when to be there at the latest to reach the target in time.

    ``queries``: query_id, target, start, limit. ``board_by`` is the last departure of a ride from
    the stop that arrives at the target by ``limit``, ``leave_by`` the last moment to leave it by
    any means, after a ride. Both by planned times, from a search against time: arrivals and
    departures change places, runs go backwards, walks too.
    """
    back = timetable.select(
        "run_id", (-F.col("seq")).alias("seq"), "stop_id", (-F.col("dep_s")).alias("arr_s"), (-F.col("arr_s")).alias("dep_s")
    )
    first = back.groupBy("run_id").agg(F.min("seq").alias("_least"))
    back = back.join(first, "run_id").withColumn("seq", F.col("seq") - F.col("_least") + 1).drop("_least")
    ways = walks.select(F.col("to_stop").alias("from_stop"), F.col("from_stop").alias("to_stop"), "walk_s")
    asked = queries.select(
        "query_id", F.col("target").alias("source"), (-F.col("limit")).cast("bigint").alias("depart_at"),
        (-F.col("start")).cast("bigint").alias("horizon"),
    )
    found = _search_labels(asked, back, ways, change_s)
    later = F.greatest(-F.col("unridden"), -F.col("ridden") - change_s, -F.col("walked") - change_s)
    return found.select("query_id", "stop_id", (-F.col("ridden")).alias("board_by"), later.alias("leave_by"))


def _non_dominated(df: DataFrame, part: list[str], order: list[str]) -> DataFrame:
    """Rows walking less than every row that is at least as early (ties: first row).

    Of the rows that walk equally far only the first can stay, so they are reduced
    by an aggregate before the window sees them.
    """
    first = [c for c in order if c != "walk_m"]
    rest = [c for c in df.columns if c not in (*part, *order)]
    one = df.groupBy(*part, "walk_m").agg(F.min(F.struct(*first, *rest)).alias("_m"))
    one = one.select(*part, "walk_m", "_m.*")
    w = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    low = F.min("walk_m").over(w)
    return one.withColumn("_low", low).where("_low IS NULL OR walk_m < _low").drop("_low")


def robust_paths(
    queries: DataFrame, timetable: DataFrame, walks: DataFrame, delays: DataFrame,
    max_walk_m: float = MAX_WALK_METRES, max_duration: int = 14400,
    arrive_window: int = 7200, change_s: int = CHANGE_SECONDS,
) -> DataFrame:
    """Journey options per request with their legs.

    ``queries``: query_id, source, target, depart_at?, arrive_by?, confidence;
    ``timetable``: run_id, line_id, seq, stop_id, arr_s, dep_s; ``delays``: line_id
    and the delay at each supported confidence (q50, q75, q90, q95). Arrivals are
    planned times plus the delay quantile of the line. With ``arrive_by`` only,
    the search starts ``arrive_window`` seconds before it. Requests and labels that cannot reach
    the target in time even by planned times are dropped (``latest_times``). Labels are kept while
    no other label of the stop is as early with as little walking and as few
    rides; rounds, one ride each, end when no label is new, so journeys may have any
    number of rides within ``max_duration``. Source = target gives one option without legs.
    """
    q = queries.select(
        "query_id", "source", "target", "confidence",
        F.coalesce("depart_at", F.greatest(F.col("arrive_by") - arrive_window, F.lit(0))).alias("start"),
        "arrive_by",
    ).withColumn("limit", F.least(F.coalesce("arrive_by", F.lit(10**9)), F.col("start") + max_duration))
    info = ["target", "confidence", "limit"]
    q = cut_lineage(q)
    late_at = latest_times(q.where("source <> target"), timetable, walks, change_s)
    leaving = late_at.select("query_id", F.col("stop_id").alias("source"), F.greatest("board_by", "leave_by").alias("_by"))
    moving = q.where("source <> target").join(leaving, ["query_id", "source"]).drop("_by")

    def in_time(df: DataFrame, when: str, by: str) -> DataFrame:
        """Labels from which the target can still be reached."""
        last = late_at.select("query_id", "stop_id", F.col(by).alias("_by"))
        return df.join(last, ["query_id", "stop_id"]).where(F.col(when) <= F.col("_by")).drop("_by")

    same = q.where("source = target").select(
        "query_id", F.lit(0).alias("rides"), F.col("start").cast("bigint").alias("arrival"), F.lit(0.0).alias("walk_m"),
        F.lit(None).cast(f"array<{LEG}>").alias("legs"),
    )
    base = moving.select(
        "query_id", F.col("source").alias("stop_id"), F.lit(0).alias("rides"), F.col("start").cast("bigint").alias("ready"),
        F.lit(0.0).alias("walk_m"), F.array().cast(f"array<{LEG}>").alias("legs"), *info,
    )
    at_stop = timetable.select("run_id", "seq", "stop_id", "dep_s")
    along = timetable.join(delays, "line_id", "left").select(
        "run_id", F.col("seq").alias("to_seq"), F.col("stop_id").alias("to_stop"), "arr_s", "q50", "q75", "q90", "q95"
    )
    hops = walks.select(
        F.col("from_stop").alias("stop_id"), "to_stop", F.col("metres").alias("hop_m"), F.col("walk_s").alias("hop_s")
    )
    late = (
        F.when(F.col("confidence") <= 0.5, F.col("q50")).when(F.col("confidence") <= 0.75, F.col("q75"))
        .when(F.col("confidence") <= 0.9, F.col("q90")).otherwise(F.col("q95"))
    )
    on_time = F.greatest(F.coalesce(late, F.lit(0)), F.lit(0)).cast("bigint")
    fresh = F.expr(
        "NOT exists(legs, x -> x.to_stop = to_stop OR x.from_stop = to_stop) AND to_stop <> stop_id"
    )
    part, order = ["query_id", "stop_id"], ["ready", "walk_m", "rides", "_tie"]
    tie = F.xxhash64(F.to_json("legs"))
    cols = ["query_id", "stop_id", "rides", "ready", "walk_m", "legs", *info]

    def arrive(df: DataFrame, arrival: Column, leg: Column, ridden: int, metres: Column) -> DataFrame:
        return df.where(fresh).select(
            "query_id", F.col("to_stop").alias("stop_id"), (F.col("rides") + ridden).alias("rides"),
            arrival.alias("arrival"), (F.col("walk_m") + metres).alias("walk_m"),
            F.concat("legs", F.array(leg.cast(LEG))).alias("legs"), *info,
        ).where("arrival <= limit")

    def walk(df: DataFrame) -> DataFrame:
        j = df.join(hops, "stop_id").where(F.col("walk_m") + F.col("hop_m") <= max_walk_m)
        leg = F.struct(
            "stop_id", "to_stop", F.col("ready"), (F.col("ready") + F.col("hop_s")), F.lit("WALK"),
            F.lit(None).cast("bigint"), F.col("hop_m"),
        )
        return arrive(j, F.col("ready") + F.col("hop_s"), leg, 0, F.col("hop_m"))

    start = cut_lineage(base)
    first_walk = cut_lineage(walk(start))
    options = [first_walk.where("stop_id = target")]
    onward = first_walk.where("stop_id <> target").withColumnRenamed("arrival", "ready").select(*cols)
    fresh_labels = cut_lineage(in_time(start.unionByName(onward), "ready", "board_by").select(*cols))
    kept = fresh_labels
    while not fresh_labels.isEmpty():
        boards = fresh_labels.join(at_stop, "stop_id").where("dep_s >= ready AND dep_s <= limit")
        boards = _non_dominated(boards.withColumn("_tie", tie), ["query_id", "run_id"], ["seq", "walk_m", "ready", "_tie"])
        rides = boards.join(along, "run_id").where("to_seq > seq AND arr_s >= dep_s")
        leg = F.struct(
            "stop_id", "to_stop", "dep_s", (F.col("arr_s") + on_time), F.lit("PT"), "run_id", F.lit(0.0)
        )
        landed = cut_lineage(arrive(rides, F.col("arr_s") + on_time, leg, 1, F.lit(0.0)))
        options.append(landed.where("stop_id = target"))
        going = in_time(landed.where("stop_id <> target"), "arrival", "leave_by")
        rest = going.select(*[c if c != "ready" else F.col("arrival").alias("ready") for c in cols])
        after_ride = _non_dominated(rest.withColumn("_tie", tie), part, order).drop("_tie")
        walked = walk(after_ride).withColumnRenamed("arrival", "ready").select(*cols)
        step = cut_lineage(after_ride.select(*cols).unionByName(walked))
        options.append(step.where("stop_id = target").withColumnRenamed("ready", "arrival"))
        # boarding again takes the change time, whether or not the passenger walked
        new = step.where("stop_id <> target").withColumn("ready", F.col("ready") + change_s)
        new = in_time(new, "ready", "board_by").select(*cols)
        pool = kept.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
        pool = _non_dominated(pool.withColumn("_tie", tie), part, ["ready", "walk_m", "rides", "_new", "_tie"])
        pool = cut_lineage(pool.drop("_tie"))
        fresh_labels = pool.where("_new = 1").drop("_new")
        kept = pool.drop("_new")
    found = options[0]
    for o in options[1:]:
        found = found.unionByName(o)
    found = found.select("query_id", "rides", F.col("arrival").cast("bigint"), "walk_m", "legs").distinct()
    out = cut_lineage(found.unionByName(same))
    dep = F.coalesce(F.col("legs")[0]["dep_s"], F.col("arrival"))
    trips = F.filter(F.transform("legs", lambda x: x.run_id), lambda x: x.isNotNull())
    changes = F.greatest(F.size(F.array_distinct(trips)) - 1, F.lit(0))
    return out.withColumns(
        {"departure": dep, "changes": F.coalesce(changes, F.lit(0)), "first_trips": F.array_join(F.slice(trips, 1, 2), ","),
         "signature": F.xxhash64(F.to_json("legs"))}
    )


def diversify(options: DataFrame, k: int, option_id: str = "option_id") -> DataFrame:
    """At most ``k`` options per query: different (15-minute departure, changes, first
    two trips) first, then different leg sequences, each in order of arrival.

    Needs query_id, arrival, departure, changes, first_trips, signature. The best
    option per footprint and per leg sequence are aggregates, and each top ``k`` is
    cut before its shuffle, so a query with very many options is not one task.
    """
    order = ["arrival", "departure", "changes", option_id]
    rest = [c for c in options.columns if c not in (*order, "query_id")]

    def first(df: DataFrame, *by: str | Column) -> DataFrame:
        best = df.groupBy("query_id", *by).agg(F.min(F.struct(*order, *rest)).alias("_o"))
        return best.select("query_id", "_o.*")

    def top(df: DataFrame, *before: Column) -> DataFrame:
        w = Window.partitionBy("query_id").orderBy(*before, *order)
        return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= k).drop("_n")

    print_ = F.struct(F.floor(F.col("departure") / 900), "changes", "first_trips")
    chosen = cut_lineage(top(first(options, print_.alias("_f"))))
    taken = chosen.select("query_id", "signature")
    others = top(first(options, "signature").join(taken, ["query_id", "signature"], "left_anti"))
    both = chosen.withColumn("_late", F.lit(0)).unionByName(others.withColumn("_late", F.lit(1)))
    both = top(both, F.col("_late")).drop("_late")
    w = Window.partitionBy("query_id").orderBy(*order)
    return both.withColumn("option_no", F.row_number().over(w)).select(*options.columns, "option_no")


def count_changes(legs: DataFrame) -> DataFrame:
    """Changes of trip along the ride legs of every option."""
    w = Window.partitionBy("option_id").orderBy("leg_no")
    rides = legs.where("kind = 'PT'").withColumn("_prev", F.lag("leg_trip").over(w))
    per = rides.groupBy("option_id").agg(F.count_if(F.col("_prev") != F.col("leg_trip")).alias("changes"))
    return legs.select("option_id").distinct().join(per, "option_id", "left").na.fill({"changes": 0})


def has_loop(legs: DataFrame) -> DataFrame:
    """Whether an option comes back to a stop it has left."""
    seq = legs.groupBy("option_id").agg(
        F.sort_array(F.collect_list(F.struct("leg_no", "from_stop", "to_stop"))).alias("l")
    )
    stops = F.concat(F.array(F.col("l")[0]["from_stop"]), F.transform("l", lambda x: x.to_stop))
    seq = seq.withColumn("s", stops)
    runs = F.filter("s", lambda x, i: (i == 0) | (x != F.element_at("s", F.greatest(i, F.lit(1)))))
    return seq.select("option_id", (F.size(runs) > F.size(F.array_distinct("s"))).alias("has_loop"))


def changes_of(legs: DataFrame, change_s: int = CHANGE_SECONDS) -> DataFrame:
    """Consecutive ride legs on different trips, with the time left after the change."""
    w = Window.partitionBy("option_id").orderBy("leg_no")
    nxt = F.lead(F.struct("leg_trip", "dep_s")).over(w)
    rides = legs.where("kind = 'PT'").withColumn("_n", nxt)
    gap = (F.col("_n.dep_s") - F.col("arr_s") - change_s).cast("bigint")
    return rides.where("_n IS NOT NULL AND _n.leg_trip <> leg_trip").select(
        "option_id", "leg_no", "leg_trip", "line_id", "to_stop", "arr_s", gap.alias("slack")
    )


def delay_shares(counts: DataFrame, keys: list[str], delay: str, n: str) -> DataFrame:
    """Share of observations with at most a given delay, and all observations, per key and observed delay.

    ``counts`` has one row per key and delay with its number ``n``.
    """
    counts = cut_lineage(counts.select(*keys, delay, n))
    upto = ordered.running_sum(counts, keys, [delay], F.col(n), "_upto")
    totals = counts.groupBy(*keys).agg(F.sum(n).alias("seen"))
    return upto.join(totals, keys).select(*keys, delay, (F.col("_upto") / F.col("seen")).alias("share"), "seen")


#: Levels of delay observations from coarse to fine; what a level does not tell apart is -1.
DELAY_LEVELS = (("line_id",), ("line_id", "stop_id"), ("line_id", "stop_id", "hour"))


def _at_levels(df: DataFrame) -> DataFrame:
    """Each row once per level of DELAY_LEVELS."""
    keys = DELAY_LEVELS[-1]
    rows = [
        F.struct(F.lit(i).alias("level"), *[(F.col(k) if k in level else F.lit(-1)).cast("bigint").alias(k) for k in keys])
        for i, level in enumerate(DELAY_LEVELS)
    ]
    return df.withColumn("_l", F.explode(F.array(*rows))).drop(*keys).select("*", "_l.*").drop("_l")


def option_confidence(legs: DataFrame, visits: DataFrame, least: int = 5) -> DataFrame:
    """Probability that all changes of an option hold, delays taken as independent.

    Per change it is the share of past delays that fit the slack: of the line at that stop in
    that hour of arrival if there are ``least`` observations, else of the line at that stop if
    there are as many, else of the line. The shares of all levels are read off by one carry
    of cumulative shares to the slacks in delay order. ``visits``: line_id, stop_id, hour, delay_s.
    """
    by = ["level", *DELAY_LEVELS[-1]]
    fine = visits.groupBy(*DELAY_LEVELS[-1], "delay_s").agg(F.count(F.lit(1)).alias("n"))
    counts = _at_levels(fine).groupBy(*by, "delay_s").agg(F.sum("n").alias("n"))
    shares = delay_shares(counts, by, "delay_s", "n")
    hour = (F.floor(F.col("arr_s") / 3600) % 24).alias("hour")
    asked = changes_of(legs).select("option_id", "leg_no", "slack", "line_id", F.col("to_stop").alias("stop_id"), hour)
    both = _at_levels(asked).select(
        *by, F.col("slack").alias("x"), F.lit(1).alias("_kind"), F.struct("option_id", "leg_no").alias("_c")
    ).unionByName(
        shares.select(*by, F.col("delay_s").alias("x"), F.lit(0).alias("_kind"), "share", "seen"), allowMissingColumns=True
    )
    got = ordered.carry(
        both, by, ["x", "_kind"], last={"_p": F.col("share"), "_n": F.col("seen")}, following={"_m": F.col("seen")}
    ).where("_kind = 1")
    enough = (F.coalesce("_n", "_m", F.lit(0)) >= least) | (F.col("level") == 0)
    best = F.max_by(F.coalesce("_p", F.lit(0.0)), F.when(enough, F.col("level"))).alias("p")
    p = got.groupBy("_c.option_id", "_c.leg_no").agg(best)
    held = p.groupBy("option_id").agg(
        F.when(F.min("p") <= 0, 0.0).otherwise(F.exp(F.sum(F.log(F.when(F.col("p") > 0, F.col("p")))))).alias("confidence")
    )
    return legs.select("option_id").distinct().join(held, "option_id", "left").na.fill({"confidence": 1.0})


def replay(legs: DataFrame, visits: DataFrame, deadline_slack: int = 300) -> DataFrame:
    """Share of past days on which every change held and the end was reached in time.

    A day counts when at least one of the option's arrivals was observed on it.
    """
    w = Window.partitionBy("option_id").orderBy(F.desc("leg_no"))
    rides = legs.where("kind = 'PT'")
    last = rides.withColumn("_r", F.row_number().over(w)).where("_r = 1").select(
        "option_id", "leg_no", "leg_trip", "to_stop", F.lit(deadline_slack).cast("bigint").alias("slack")
    )
    checks = changes_of(legs).select("option_id", "leg_no", "leg_trip", "to_stop", "slack").unionByName(last)
    actual = visits.groupBy(F.col("trip_id").alias("leg_trip"), F.col("stop_id").alias("to_stop"), "operating_day").agg(
        F.max("delay_s").alias("late")
    )
    days = checks.join(actual, ["leg_trip", "to_stop"]).groupBy("option_id", "operating_day").agg(
        F.bool_and(F.col("late") <= F.col("slack")).alias("held")
    )
    return days.groupBy("option_id").agg(
        F.avg(F.col("held").cast("double")).alias("share"), F.count(F.lit(1)).alias("days")
    )


def long_queries(queries: DataFrame, stops: DataFrame, degrees: float = 0.5) -> DataFrame:
    """Requests whose ends are more than ``degrees`` of latitude plus longitude apart."""
    s = stops.select("stop_id", "lat", "lon")
    a = s.withColumnsRenamed({"stop_id": "source", "lat": "lat1", "lon": "lon1"})
    b = s.withColumnsRenamed({"stop_id": "target", "lat": "lat2", "lon": "lon2"})
    j = queries.join(a, "source", "left").join(b, "target", "left")
    span = F.abs(F.col("lat2") - F.col("lat1")) + F.abs(F.col("lon2") - F.col("lon1"))
    return j.select("query_id", F.coalesce(span > degrees, F.lit(False)).alias("is_long"))


def format_legs(legs: DataFrame, stops: DataFrame) -> DataFrame:
    """Legs with stop names, clock times, minutes and type, and a summary of the whole option on each.

    The summary names the stops on the way, with the legs' types between them.
    """
    names = stops.select("stop_id", "stop_name")
    a = names.withColumnsRenamed({"stop_id": "from_stop", "stop_name": "from_name"})
    b = names.withColumnsRenamed({"stop_id": "to_stop", "stop_name": "to_name"})
    j = cut_lineage(legs.join(a, "from_stop", "left").join(b, "to_stop", "left"))
    step = F.concat(F.lit(" -"), F.col("kind"), F.lit("- "), F.coalesce("to_name", F.lit("?")))
    whole = j.groupBy("option_id").agg(
        F.sort_array(F.collect_list(F.struct("leg_no", step.alias("step")))).alias("_s"), F.min_by("from_name", "leg_no").alias("_from")
    )
    text = F.concat(F.coalesce("_from", F.lit("?")), F.array_join(F.transform("_s", lambda x: x.step), ""))
    return j.join(whole.select("option_id", text.alias("summary")), "option_id").select(
        "option_id", "leg_no", "kind", "from_name", "to_name",
        format_seconds("dep_s").alias("departs"), format_seconds("arr_s").alias("arrives"),
        ((F.col("arr_s") - F.col("dep_s")) / 60).alias("minutes"), "summary",
    )
