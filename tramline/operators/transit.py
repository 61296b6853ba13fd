"""Public-transport operators on visit, stop and timetable tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.functions.text import first_number
from tramline.functions.timefn import cyclic, iso_weekday, parse_service_time, seconds_between
from tramline.operators import ordered, spatial
from tramline.operators.aggregates import transfer_stats
from tramline.operators.joins import left_with_flag
from tramline.operators.shaping import one_per_key, pivot_discovered, typed_events

WALK_METRES_PER_MINUTE = 50
MAX_WALK_METRES = 500.0
CHANGE_SECONDS = 120
JOURNEY = ["trip_id", "operating_day"]
SEQUENCE = ["arr_time", "arr_actual", "event_id"]


def normalise_stop_key(code) -> Column:
    """``8501117``, ``Parent8501117`` and ``8501117:0:1`` -> 8501117."""
    return first_number(code)


def region_stops(versions: DataFrame, regions: DataFrame) -> DataFrame:
    """Newest publication of every stop inside a region, one row per region and stop key."""
    keyed = versions.withColumn("stop_key", normalise_stop_key("stop_code"))
    inside = spatial.points_in_regions(keyed, regions, "region", "wkb")
    cols = inside.select("region", "stop_key", "pub_date", "stop_name", "lat", "lon")
    return one_per_key(cols, ["region", "stop_key"], ["pub_date", "stop_name"], latest=True)


def coverage(stops: DataFrame, visits: DataFrame, by: str) -> DataFrame:
    """Stops per group, how many of them no visit mentions, and their share."""
    flagged = left_with_flag(stops, visits, ["stop_id"], "seen")
    return flagged.groupBy(by).agg(
        F.count(F.lit(1)).alias("stops"),
        F.count_if(~F.col("seen")).alias("without_visits"),
        (100 * F.avg((~F.col("seen")).cast("double"))).alias("missing_pct"),
    )


def footpaths(stops: DataFrame, metres: float = MAX_WALK_METRES) -> DataFrame:
    """Directed walks between different stops with metres and seconds at 50 m/min."""
    s = stops.select("stop_id", "lat", "lon")
    pairs = spatial.pairs_within(
        s.withColumnRenamed("stop_id", "from_stop"), s.withColumnRenamed("stop_id", "to_stop"), metres
    )
    seconds = F.col("metres") * 60 / WALK_METRES_PER_MINUTE
    return pairs.where("from_stop <> to_stop").withColumn("walk_s", F.ceil(seconds).cast("bigint"))


def timetable_subset(stop_times: DataFrame, trips: DataFrame, calendar: DataFrame, stops: DataFrame) -> DataFrame:
    """Distinct stop times of given stops with weekday flags; times in seconds of the service day."""
    days = [c for c in calendar.columns if c != "service_id"]
    st = stop_times.join(stops.select("stop_id"), "stop_id", "left_semi").select(
        "run_id", "trip_id", "stop_id",
        parse_service_time("departure_time").cast("bigint").alias("dep_s"),
        parse_service_time("arrival_time").cast("bigint").alias("arr_s"),
    )
    j = st.join(trips, "trip_id").join(calendar, "service_id")
    return j.select("run_id", "stop_id", "dep_s", "arr_s", *days).distinct()


def timetable_counts(subset: DataFrame, days: list[str]) -> DataFrame:
    """Distinct (run, stop) pairs, overall and per weekday, in one pass after one dedupe."""
    pairs = subset.select("run_id", "stop_id", *days).distinct()
    one = pairs.agg(F.count(F.lit(1)).alias("all_days"), *[F.count_if(d).alias(d) for d in days])
    return one.unpivot([], one.columns, "day", "pairs")


def service_days(
    calendar: DataFrame, exceptions: DataFrame, first: str, last: str, weekdays_only: bool = True
) -> DataFrame:
    """Dates from ``first`` to ``last`` on which each service runs: weekday flags, plus added, minus removed days."""
    names = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
    cal = calendar
    if weekdays_only:
        for d in names[:5]:
            cal = cal.where(d)
        cal = cal.where("NOT saturday AND NOT sunday")
    dates = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
    regular = cal.withColumn("day", F.explode(dates)).where(
        F.element_at(F.array(*names), F.weekday("day") + 1)
    ).select("service_id", "day")
    window = F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    mine = exceptions.where(window).join(cal.select("service_id"), "service_id", "left_semi")
    added = mine.where("exception_type = 1").select("service_id", "day")
    removed = mine.where("exception_type = 2").select("service_id", "day")
    return regular.unionByName(added).distinct().join(removed, ["service_id", "day"], "left_anti")


def qualified_trips(visits: DataFrame, stops: DataFrame, min_days: int) -> DataFrame:
    """Trips seen at the given stops on at least ``min_days`` days."""
    near = visits.join(stops.select("stop_id"), "stop_id", "left_semi")
    days = near.groupBy("trip_id").agg(F.countDistinct("operating_day").alias("days"))
    return days.where(F.col("days") >= min_days)


def clean_visits(visits: DataFrame, trips: DataFrame) -> DataFrame:
    """Planned visits that took place, of the given trips."""
    ran = visits.where(~F.col("failed") & ~F.col("unplanned"))
    return ran.join(trips.select("trip_id"), "trip_id", "left_semi")


def trajectories(visits: DataFrame, chunks: int | None = None) -> DataFrame:
    """Per trip and day: position of each visit, start time, and four intervals since the start.

    The start is the first known departure; intervals are NULL where a time is.
    """
    cols = ["event_id", *JOURNEY, "stop_id", "arr_time", "arr_actual", "dep_time", "dep_actual"]
    seq = ordered.row_numbers(visits.select(*cols), JOURNEY, SEQUENCE, "seq", chunks)
    starts = (
        visits.where("dep_time IS NOT NULL")
        .groupBy(*JOURNEY)
        .agg(F.min_by("dep_time", F.struct(*SEQUENCE)).alias("start_time"))
    )
    out = seq.join(starts, JOURNEY, "left")
    rel = {f"{c}_rel": F.col(c) - F.col("start_time") for c in cols[4:]}
    return out.withColumns(rel)


def interval_seconds(column: str) -> Column:
    return F.col(column).cast("bigint")


def trajectory_anomalies(traj: DataFrame) -> DataFrame:
    """Stops met at several positions of a trip, and trips with several lengths."""
    order = traj.groupBy("trip_id", "stop_id").agg(F.countDistinct("seq").alias("variants")).where("variants > 1")
    lengths = (
        traj.groupBy(*JOURNEY)
        .agg(F.max("seq").alias("n"))
        .groupBy("trip_id")
        .agg(F.countDistinct("n").alias("variants"))
        .where("variants > 1")
    )
    return order.select(F.lit("order").alias("kind"), "trip_id", "stop_id", "variants").unionByName(
        lengths.select(
            F.lit("length").alias("kind"), "trip_id", F.lit(-1).cast("bigint").alias("stop_id"), "variants"
        )
    )


def punctual_days(traj: DataFrame, seconds: int = 300) -> DataFrame:
    """Days on which the first known departure of a trip was within ``seconds`` of plan."""
    first = (
        traj.where("dep_time IS NOT NULL AND dep_actual IS NOT NULL")
        .groupBy(*JOURNEY)
        .agg(F.min_by(F.struct("dep_time", "dep_actual"), "seq").alias("f"))
    )
    late = seconds_between("f.dep_actual", "f.dep_time")
    return first.where(F.abs(late) <= seconds).select(*JOURNEY)


def planned_vs_actual(traj: DataFrame) -> DataFrame:
    """One row per trip, position and event type; the plan and one column of actual seconds per day."""
    keep = ["trip_id", "seq", "operating_day"]
    plan = typed_events(traj, keep, {"arr": "arr_time_rel", "dep": "dep_time_rel"})
    real = typed_events(traj, keep, {"arr": "arr_actual_rel", "dep": "dep_actual_rel"})
    long = plan.withColumn("column", F.lit("planned")).unionByName(
        real.withColumn("column", F.col("operating_day").cast("string"))
    )
    seconds = long.select("trip_id", "seq", "evt_type", "column", interval_seconds("evt_time").alias("s"))
    return pivot_discovered(seconds, ["trip_id", "seq", "evt_type"], "column", F.min("s"))


def delay_facts(visits: DataFrame, low: int = -120, high: int = 3600, hours: tuple[int, int] = (7, 17)) -> DataFrame:
    """Arrival and departure delay in seconds within a plausible range and day-time hours."""
    f = visits.withColumns(
        {
            "arr_delay": seconds_between("arr_actual", "arr_time"),
            "dep_delay": seconds_between("dep_actual", "dep_time"),
        }
    )
    ok = (F.col("arr_delay") > low) & (F.col("arr_delay") < high)
    return f.where(ok & F.hour("sched").between(*hours))


def delay_features(facts: DataFrame, stops: DataFrame, routes: DataFrame, transfers: DataFrame) -> DataFrame:
    """Model input per arrival; dimensions are one row per key before they are joined."""
    dims = one_per_key(stops.select("stop_id", "lat", "lon"), ["stop_id"], ["lat", "lon"])
    kinds = one_per_key(routes.select("route_id", "route_type"), ["route_id"], ["route_type"])
    stats = transfer_stats(dims, transfers, CHANGE_SECONDS)
    starts = facts.groupBy(*JOURNEY).agg(F.min("sched").alias("_start"))
    base = facts.join(starts, JOURNEY).select(
        "event_id", "trip_id", "stop_id", F.col("line_id").alias("route_id"),
        seconds_between("sched", "_start").alias("scheduled_tt"),
        F.col("arr_delay").alias("delay"),
        F.hour("sched").alias("sched_hour"),
        F.hour("arr_actual").alias("act_hour"),
        iso_weekday("sched").alias("dow"),
        F.dayofyear("sched").alias("doy"),
    )
    j = base.join(dims, "stop_id", "left").join(kinds, "route_id", "left").join(stats, "stop_id", "left")
    j = j.na.fill({"min_transfer_time": CHANGE_SECONDS, "transfer_degree": 0})
    hs, hc = cyclic("sched_hour", 24)
    ds, dc = cyclic("doy", 365)
    return j.withColumns({"hour_sin": hs, "hour_cos": hc, "doy_sin": ds, "doy_cos": dc})


def lag_correlation(visits: DataFrame, chunks: int | None = None) -> DataFrame:
    """Correlation of the delay with the delay at the previous stop of the same journey, per line."""
    rows = visits.select("line_id", *JOURNEY, "sched", "event_id", "delay_s")
    prev = ordered.neighbour(rows, JOURNEY, ["sched", "event_id"], F.struct("delay_s"), "p", -1, chunks)
    pairs = prev.where("p IS NOT NULL").select(
        "line_id", F.col("delay_s").cast("double").alias("a"), F.col("p.delay_s").cast("double").alias("b")
    )
    return pairs.groupBy("line_id").agg(F.corr("a", "b").alias("lag_corr"), F.count(F.lit(1)).alias("pairs"))
