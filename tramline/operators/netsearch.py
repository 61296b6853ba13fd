"""Journey search of many requests beside a copy of the network.

A network whose stop times and walks are few enough to lie in a worker's memory as arrays is
sent to every task once, like a broadcast but between executors, and a task answers its share of the
requests in batches: the same rounds as in ``journey._Search``, on arrays that hold the labels of
a batch. Requests need nothing of each other, so no label is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.session import cut_lineage

#: Stop times and walks that a worker holds at most, some 40 bytes each.
MOST_ROWS = 16_000_000
#: Labels of a batch: requests times stops.
LABELS = 1 << 20
#: Later than any time, with room for sums.
NEVER = 1 << 30
#: Times and seconds are below this on either side of zero.
LARGEST = 1 << 28
#: What is sent: calls of runs, walks, requests.
CALL, WALK, REQUEST = range(3)
PARTS = {
    CALL: ["pattern_id", "run_no", "run_id", "seq", "stop_id", "arr_s", "dep_s"],
    WALK: ["stop_id", "to_stop", "hop_s"],
    REQUEST: ["query_id", "source", "depart_at", "horizon"],
}
SLOTS = [f"x{i}" for i in range(len(PARTS[CALL]))]
LABEL_COLUMNS = {False: ["unridden", "ridden", "walked"], True: ["arrival", "walk_s", "ride_s"]}


def fits(queries: DataFrame, network: DataFrame, hops: DataFrame) -> bool:
    """Whether the network is small enough, requests are told apart by ``query_id``, and all values are whole numbers in range."""
    room = MOST_ROWS
    for rows, kind, times in ((network, CALL, ["arr_s", "dep_s"]), (hops, WALK, ["hop_s"]), (queries, REQUEST, ["depart_at", "horizon"])):
        names = PARTS[kind]
        if any(rows.schema[c].dataType.typeName() not in ("integer", "long") for c in names):
            return False
        least = 0 if kind == WALK else -LARGEST
        odd = F.greatest(*[F.col(c).isNull() | (F.col(c) < least) | (F.col(c) > LARGEST) for c in times], *[F.col(c).isNull() for c in names])
        seen = rows.agg(F.count(F.lit(1)), F.count_if(odd), F.countDistinct("query_id") if kind == REQUEST else F.lit(0)).first()
        room -= 0 if kind == REQUEST else seen[0]
        if seen[1] or room < 0 or (kind == REQUEST and seen[2] < seen[0]):
            return False
    return True


def _packed(rows: DataFrame, kind: int) -> DataFrame:
    """Rows as arrays, one row per Arrow batch."""
    names = PARTS[kind]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ends = pa.array([0, batch.num_rows], pa.int32())
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(ends, x) for x in batch.columns], names=SLOTS[: len(names)])

    whole = rows.select(*[F.col(c).cast("bigint").alias(s) for c, s in zip(names, SLOTS)])
    out = whole.mapInArrow(pack, ", ".join(f"{s} array<bigint>" for s in SLOTS[: len(names)]))
    return out.select(F.lit(kind).alias("kind"), *[(F.col(s) if s in out.columns else F.array().cast("array<bigint>")).alias(s) for s in SLOTS])


def search(queries: DataFrame, network: DataFrame, hops: DataFrame, change_s: int, times: bool) -> DataFrame:
    """Labels per request and stop, or with ``times`` the earliest arrival with the seconds walked and ridden.

    ``queries``: query_id, source, depart_at, horizon; ``network``: of ``route_patterns``; ``hops``:
    stop_id, to_stop, hop_s. All three ``fit``.
    """
    spark = queries.sparkSession
    columns = ["query_id", "stop_id", *LABEL_COLUMNS[times]]
    kinds = {"query_id": queries.schema["query_id"].dataType, "stop_id": network.schema["stop_id"].dataType}
    if queries.isEmpty():
        # no task needs the network
        return spark.createDataFrame([], ", ".join(f"{c} {kinds[c].simpleString() if c in kinds else 'bigint'}" for c in columns))
    tasks = max(spark.sparkContext.defaultParallelism, 1)
    # a key for each partition, so that no task has the requests of two
    at = F.pmod(F.hash("id"), F.lit(tasks))
    keys = [r[0] for r in spark.range(64 * tasks).groupBy(at.alias("at")).agg(F.min("id")).orderBy("at").select("min(id)").collect()]
    parts = cut_lineage(_packed(network, CALL).unionByName(_packed(hops, WALK)))
    tasks_of = F.array(*[F.lit(k).cast("bigint") for k in keys])
    own = F.element_at(tasks_of, (F.pmod(F.xxhash64("query_id"), F.lit(len(keys))) + 1).cast("int"))
    asked = [F.array(F.col(c).cast("bigint")).alias(s) for c, s in zip(PARTS[REQUEST], SLOTS)]
    rest = [F.array().cast("array<bigint>").alias(s) for s in SLOTS[len(asked) :]]
    sent = parts.withColumn("task", F.explode(tasks_of)).unionByName(
        queries.select(F.lit(REQUEST).alias("kind"), *asked, *rest, own.alias("task"))
    )
    # equal rows of a kind may come in any order: the worker sorts them
    sent = sent.repartition(tasks, "task").sortWithinPartitions("task", "kind").select("task", "kind", *SLOTS)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, network, held, asked = None, None, _empty(), []
        for batch in batches:
            for kind, own in zip(batch.column(1).to_pylist(), _rows(batch)):
                if own[0] != task:
                    if asked:
                        yield network.answer(asked, times, columns)
                    task, network, held, asked = own[0], None, _empty(), []
                if kind != REQUEST:
                    for values, x in zip(held[kind], own[1]):
                        values.append(_narrow(x.to_numpy()))
                    continue
                if network is None:
                    network = _Network(held, change_s, times)
                asked.append([x[0].as_py() for x in own[1][: len(PARTS[REQUEST])]])
                if len(asked) >= network.width:
                    yield network.answer(asked, times, columns)
                    asked = []
        if asked:
            yield network.answer(asked, times, columns)

    found = sent.mapInArrow(answer, ", ".join(f"{c} bigint" for c in columns))
    return cut_lineage(found.withColumns({c: F.col(c).cast(t) for c, t in kinds.items()}))


def _empty() -> dict[int, list[list[np.ndarray]]]:
    return {kind: [[] for _ in PARTS[kind]] for kind in (CALL, WALK)}


def _narrow(x: np.ndarray) -> np.ndarray:
    """A copy in 32 bits if the values allow it; parts of both kinds become 64 bits together."""
    small = np.iinfo(np.int32)
    return x.astype(np.int32 if not len(x) or (x.min() >= small.min and x.max() <= small.max) else np.int64)


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[int, list[pa.Array]]]:
    tasks, columns = batch.column(0).to_pylist(), batch.columns[2:]
    for i, task in enumerate(tasks):
        yield task, [c.slice(i, 1).flatten() for c in columns]


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ``counts`` copies of each row, the row of a copy and its number."""
    rows = np.repeat(np.arange(len(counts)), counts)
    return rows, np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)


def _starts(*sorted_by: np.ndarray) -> np.ndarray:
    """Where a new key begins."""
    new = np.zeros(len(sorted_by[0]), bool)
    new[:1] = True
    for x in sorted_by:
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


class _Network:
    """Runs, walks and indexes as arrays; stops are numbered in the order of their ids."""

    def __init__(self, held: dict[int, list], change_s: int, times: bool):
        """``held`` is emptied column by column, as memory is what bounds the network."""

        def take(kind: int, column: str) -> np.ndarray:
            parts = held[kind][PARTS[kind].index(column)]
            whole = np.concatenate(parts) if parts else np.zeros(0, np.int32)
            parts.clear()
            return whole

        self.change_s = change_s
        stop, start, end = take(CALL, "stop_id"), take(WALK, "stop_id"), take(WALK, "to_stop")
        self.stops = np.unique(np.concatenate([np.unique(x) for x in (stop, start, end)])).astype(np.int64)
        stop, start, end = (np.searchsorted(self.stops, x).astype(np.int32) for x in (stop, start, end))
        bounds = np.arange(len(self.stops) + 1)
        # walks from a stop and, for times, to it
        hop = take(WALK, "hop_s")
        order = np.argsort(start, kind="stable").astype(np.int32)
        self.out_stop, self.out_s, self.outs = end[order], hop[order], np.searchsorted(start[order], bounds)
        if times:
            order = np.lexsort((hop, start, end)).astype(np.int32)
            self.in_stop, self.in_s, self.ins = start[order], hop[order], np.searchsorted(end[order], bounds)
        del start, end, hop
        run_id, seq = take(CALL, "run_id"), take(CALL, "seq")
        order = np.lexsort((seq, run_id)).astype(np.int32)
        run_id, seq, self.stop = run_id[order], seq[order], stop[order]
        del stop
        self.arr, self.dep = take(CALL, "arr_s")[order], take(CALL, "dep_s")[order]
        pattern, run_no = take(CALL, "pattern_id")[order], take(CALL, "run_no")[order]
        n = len(run_id)
        # runs, and their order by (first departure, id)
        self.run_start = _starts(run_id)
        self.run_end = np.append(self.run_start, n)[1:]
        self.run = np.repeat(np.arange(len(self.run_start), dtype=np.int32), self.run_end - self.run_start)
        self.place = np.arange(n, dtype=np.int32) - self.run_start.astype(np.int32)[self.run]
        self.by_rank = np.lexsort((run_id[self.run_start], self.dep[self.run_start]))
        self.rank = np.empty(len(self.run_start), np.int32)
        self.rank[self.by_rank] = np.arange(len(self.run_start))
        del run_id
        # positions of patterns at stops, and the calls there by departure
        self.board = np.lexsort((run_no, seq, pattern, self.stop)).astype(np.int32)
        at = _starts(*(x[self.board] for x in (self.stop, pattern, seq)))
        self.pos_start, self.pos_end = at.astype(np.int32), np.append(at, n)[1:].astype(np.int32)
        self.board_dep = self.dep[self.board]
        self.stop_pos = np.searchsorted(self.stop[self.board[at]], bounds)
        del pattern, run_no, seq, order, at
        if times:
            # calls by stop and arrival
            self.calls = np.lexsort((self.arr, self.stop)).astype(np.int32)
            self.call_key = self._call_key(self.stop[self.calls], self.arr[self.calls])
        self.width = int(np.clip(LABELS // max(len(self.stops), len(self.run_start), 1), 1, 1024))

    @staticmethod
    def _call_key(stop: np.ndarray, time: np.ndarray) -> np.ndarray:
        return (stop.astype(np.int64) << 32) + (time.astype(np.int64) + LARGEST)

    def answer(self, asked: list[list[int]], times: bool, columns: list[str]) -> pa.RecordBatch:
        query, source, depart, horizon = (np.array(x, np.int64) for x in zip(*asked))
        known = np.isin(source, self.stops)
        out = []
        if known.any():
            out.append(self._labels(query[known], np.searchsorted(self.stops, source[known]), depart[known], horizon[known], times))
        # a source without calls and walks is reached itself
        alone = ~known
        n = int(alone.sum())
        zero, none = np.zeros(n, np.int64), np.full(n, NEVER)
        out.append([query[alone], source[alone], depart[alone], *((zero, zero) if times else (none, none))])
        arrays = [pa.array(x, pa.int64(), mask=x == NEVER if c in LABEL_COLUMNS[False] else None) for c, x in zip(columns, (np.concatenate(x) for x in zip(*out)))]
        return pa.RecordBatch.from_arrays(arrays, names=columns)

    def _walks(self, label: np.ndarray, time: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Labels and arrivals after one walk."""
        stop = label % len(self.stops)
        rows, k = _spread(self.outs[stop + 1] - self.outs[stop])
        at = self.outs[stop][rows] + k
        to, time = label[rows] - stop[rows] + self.out_stop[at], time[rows] + self.out_s[at]
        ok = time <= self.horizon[to // len(self.stops)]
        return to[ok], time[ok]

    def _lower(self, best: np.ndarray, label: np.ndarray, time: np.ndarray) -> np.ndarray:
        """Put lower times into ``best``; labels that became lower, once each."""
        less = time < best[label]
        label, time = label[less], time[less]
        np.minimum.at(best, label, time)
        last = label[time == best[label]]
        self.mark[last] = np.arange(len(last), dtype=np.int32)
        return last[self.mark[last] == np.arange(len(last))]

    def _labels(self, query, source, depart, horizon, times) -> list[np.ndarray]:
        n, stops, runs = len(query), len(self.stops), len(self.run_start)
        self.horizon = horizon.astype(np.int32)
        self.mark = np.zeros(n * stops, np.int32)
        unridden, ridden, walked, ready = (np.full(n * stops, NEVER, np.int32) for _ in range(4))
        boarded = np.full(n * runs, np.iinfo(np.int32).max, np.int32)
        start = np.arange(n) * stops + source
        unridden[start] = depart
        walk = self._walks(start, depart.astype(np.int32))
        np.minimum.at(unridden, *walk)
        at = np.flatnonzero(unridden < NEVER)
        opened = self._lower(ready, at, unridden[at])
        while len(opened):
            at, time = self._rides(opened, ready, boarded)
            landed = self._lower(ridden, at, time)
            on_foot = self._walks(landed, ridden[landed])
            np.minimum.at(walked, *on_foot)
            both = np.concatenate([landed, on_foot[0]])
            opened = self._lower(ready, both, np.concatenate([ridden[landed], on_foot[1]]) + np.int32(self.change_s))
        at = np.flatnonzero(np.minimum(np.minimum(unridden, ridden), walked) < NEVER)
        place = [query[at // stops], self.stops[at % stops]]
        if not times:
            return [*place, *(x[at].astype(np.int64) for x in (unridden, ridden, walked))]
        return [*place, *self._times(at, unridden, ridden, walked, ready, boarded, depart)]

    def _rides(self, opened: np.ndarray, ready: np.ndarray, boarded: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Labels and arrivals of what newly opened labels board: the first run of each pattern at the stop.

        ``boarded`` has the first place at which a request boards a run; from there on another
        boarding of the run serves nothing new.
        """
        stops = len(self.stops)
        stop = opened % stops
        rows, k = _spread(self.stop_pos[stop + 1] - self.stop_pos[stop])
        pos, time = self.stop_pos[stop][rows] + k, ready[opened][rows]
        low, high = self.pos_start[pos], self.pos_end[pos]
        end = high.copy()
        while len(more := np.flatnonzero(low < high)):
            mid = (low[more] + high[more]) >> 1
            late = self.board_dep[mid] < time[more]
            low[more], high[more] = np.where(late, mid + 1, low[more]), np.where(late, high[more], mid)
        there = np.flatnonzero(low < end)
        query, call = opened[rows[there]] // stops, self.board[low[there]].astype(np.int64)
        ok = self.dep[call] <= self.horizon[query]
        query, call = query[ok], call[ok]
        key, place = query * len(self.run_start) + self.run[call], self.place[call]
        old = boarded[key]
        np.minimum.at(boarded, key, place)
        first = (place < old) & (place == boarded[key])
        key, call, query, old = key[first], call[first], query[first], old[first]
        run, place = self.run[call], self.place[call]
        until = np.minimum(old.astype(np.int64), self.run_end[run] - self.run_start[run] - 1)
        rows, k = _spread(np.maximum(until - place, 0))
        to = call[rows] + 1 + k
        time = self.arr[to]
        label = query[rows] * stops + self.stop[to]
        ok = time <= self.horizon[query[rows]]
        return label[ok], time[ok]

    def _times(self, at, unridden, ridden, walked, ready, boarded, depart) -> list[np.ndarray]:
        """Earliest arrival, seconds walked and ridden of the labels ``at``, as in ``journey._Search.times``."""
        stops, runs = len(self.stops), len(self.run_start)
        # ridden labels: the run that starts first of those that arrive then, and where it is boarded
        own = at[ridden[at] < NEVER]
        query, key = own // stops, self._call_key(own % stops, ridden[own])
        low = np.searchsorted(self.call_key, key)
        rows, k = _spread(np.searchsorted(self.call_key, key, "right") - low)
        call = self.calls[low[rows] + k]
        place = boarded[query[rows] * runs + self.run[call]]
        ok = place < self.place[call]
        rows, rank = rows[ok], self.rank[self.run[call[ok]]]
        best = np.full(len(own), np.iinfo(np.int32).max, np.int32)
        np.minimum.at(best, rows, rank)
        run = self.by_rank[best]
        call = self.run_start[run] + boarded[query * runs + run]
        ride_s = (ridden[own] - self.dep[call]).astype(np.int64)
        board = query * stops + self.stop[call]
        last = ready[board]
        opens = unridden[board] == last
        stays = ~opens & (ridden[board] + self.change_s == last)
        foot = np.flatnonzero(~opens & ~stays)
        before, walk_s = np.where(stays, board, -1), np.where(opens, unridden[board] - depart[query], 0).astype(np.int64)
        before[foot], walk_s[foot] = self._walked_from(board[foot], ridden, walked)
        # add up along the rides, in doubling strides
        number = self.mark
        number[own] = np.arange(len(own), dtype=np.int32)
        ahead = np.where(before < 0, -1, number[before])
        while len(on := np.flatnonzero(ahead >= 0)):
            nxt = ahead[on]
            walk_s[on], ride_s[on], ahead[on] = walk_s[on] + walk_s[nxt], ride_s[on] + ride_s[nxt], ahead[nxt]
        arrival = np.minimum(np.minimum(unridden[at], ridden[at]), walked[at])
        free = unridden[at] == arrival
        rode = ~free & (ridden[at] == arrival)
        foot = np.flatnonzero(~free & ~rode)
        end, extra = np.where(rode, at, -1), np.where(free, arrival - depart[at // stops], 0).astype(np.int64)
        end[foot], extra[foot] = self._walked_from(at[foot], ridden, walked)
        so_far = number[np.maximum(end, 0)]
        some = end >= 0
        walks, rides = extra.copy(), np.zeros(len(at), np.int64)
        walks[some] += walk_s[so_far[some]]
        rides[some] = ride_s[so_far[some]]
        return [arrival.astype(np.int64), walks, rides]

    def _walked_from(self, label: np.ndarray, ridden: np.ndarray, walked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The label of smallest stop from which a walk after a ride reaches each label when it does, and the seconds."""
        stop = label % len(self.stops)
        rows, k = _spread(self.ins[stop + 1] - self.ins[stop])
        walk = self.ins[stop][rows] + k
        start = label[rows] - stop[rows] + self.in_stop[walk]
        fits = np.flatnonzero(ridden[start] + self.in_s[walk] == walked[label][rows])
        # walks to a stop are in the order of where they start
        first = fits[_starts(rows[fits])]
        return start[first], self.in_s[walk[first]].astype(np.int64)
