"""Row shaping on DataFrames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramline.operators import ordered
from tramline.session import broadcast_if_small, cut_lineage

MAX_PIVOT_COLUMNS = 5_000


def complete_periods(df: DataFrame, period: str, parts: list[Column], expected: int) -> DataFrame:
    """Rows of the periods that have at least ``expected`` distinct part combinations."""
    full = (
        df.groupBy(period)
        .agg(F.countDistinct(*parts).alias("_d"))
        .where(F.col("_d") >= expected)
        .select(period)
    )
    return df.join(full, period, "left_semi")


def format_classes(df: DataFrame, code: str) -> DataFrame:
    """Histogram of the textual form of an id: plain, parent, platform or other."""
    c = F.col(code)
    kind = (
        F.when(c.rlike("^[0-9]+$"), "plain")
        .when(c.rlike("^Parent[0-9]+$"), "parent")
        .when(c.rlike("^[0-9]+:[^:]*:[^:]*$"), "platform")
        .otherwise("other")
    )
    return df.groupBy(kind.alias("id_class")).agg(F.count(F.lit(1)).alias("n"))


def key_sample(df: DataFrame, key: str, percent: int) -> DataFrame:
    """A sample that keeps or drops all rows of a key, the same on every run."""
    return df.where((F.col(key) * 7919) % 100 < percent)


def key_pieces(df: DataFrame, keys: list[str], partitions: int) -> DataFrame:
    """Per key (null included) its rows ``n``, ``pieces`` and ``first``: the partitions that it fills.

    With ``partitions`` of equal size in mind, a key of more rows than one of them gets several of
    its own; smaller keys are laid end to end and share the partitions behind those.
    """
    counts = cut_lineage(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")))
    size = counts.agg(F.greatest(F.lit(1), F.ceil(F.sum("n") / partitions))).scalar()
    sized = counts.withColumn("pieces", F.ceil(F.col("n") / size))
    large = F.when(F.col("pieces") > 1, F.col("pieces")).otherwise(0)
    small = F.when(F.col("pieces") > 1, 0).otherwise(F.col("n"))
    sized = sized.withColumns({"_large": large, "_small": small, "_all": F.lit(0)})
    own = ordered.running_sum(sized, ["_all"], keys, F.col("_large"), "_own")
    shared = ordered.running_sum(own, ["_all"], keys, F.col("_small"), "_shared")
    behind = sized.agg(F.coalesce(F.sum("_large"), F.lit(0))).scalar()
    first = F.when(F.col("pieces") > 1, F.col("_own") - F.col("_large")).otherwise(
        behind + F.floor((F.col("_shared") - F.col("_small")) / size)
    )
    return cut_lineage(shared.select(*keys, "n", "pieces", first.cast("int").alias("first")))


def spread_keys(df: DataFrame, keys: list[str], partitions: int, salt: list[str]) -> DataFrame:
    """Rows of a key together, but a key of very many rows in several partitions of bounded size.

    Partitions are assigned from counted key sizes (see ``key_pieces``); a frequent key's rows
    are dealt by a hash of the ``salt`` columns.
    """
    places = key_pieces(df, keys, partitions)
    total = places.agg(F.max(F.col("first") + F.col("pieces"))).first()[0] or 1
    names = {k: f"_k{i}" for i, k in enumerate(keys)}
    right = broadcast_if_small(places.drop("n").withColumnsRenamed(names))
    rows = df.join(right, [df[k].eqNullSafe(right[n]) for k, n in names.items()])
    part = F.col("first") + F.pmod(F.xxhash64(*salt), F.col("pieces"))
    return rows.withColumn("_part", part.cast("int")).repartitionById(int(total), "_part").drop(*names.values(), "first", "pieces", "_part")


def hash_split(df: DataFrame, key: str, weights: dict[str, int], seed: int = 42) -> DataFrame:
    """Label every row with a split by hashing its key; stable under retries and re-partitioning."""
    bucket = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(sum(weights.values())))
    label, upto = F.lit(None).cast("string"), 0
    for name, weight in weights.items():
        label = F.coalesce(label, F.when(bucket < upto + weight, F.lit(name)))
        upto += weight
    return df.withColumn("split", label)


def one_per_key(df: DataFrame, keys: list[str], order: list[str], latest: bool = False) -> DataFrame:
    """The first (or latest) row per key as an aggregate, so hot keys combine before the shuffle."""
    pick = F.max_by if latest else F.min_by
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*order)).alias("_r"))
    return best.select(*keys, "_r.*")


def typed_events(df: DataFrame, keep: list[str], times: dict[str, str]) -> DataFrame:
    """Each row once per named time column."""
    items = [F.struct(F.lit(k).alias("evt_type"), F.col(c).alias("evt_time")) for k, c in times.items()]
    return df.select(*keep, F.explode(F.array(*items)).alias("_e")).select(*keep, "_e.*")


def wide_to_long(df: DataFrame, key: str) -> DataFrame:
    """Columns named ``{sensor}.{measure}`` -> rows (key, sensor, measure, value)."""
    cols = [F.col(f"`{c}`") for c in df.columns if c != key]
    long = df.unpivot(key, cols, "_name", "value")
    return long.select(
        key,
        F.split_part("_name", F.lit("."), F.lit(1)).alias("sensor"),
        F.split_part("_name", F.lit("."), F.lit(2)).alias("measure"),
        "value",
    )


def pivot_discovered(df: DataFrame, keys: list[str], column: str, value: Column) -> DataFrame:
    """Pivot on values found in the data, in sorted order.

    The number of output columns is a property of the result; more than
    ``MAX_PIVOT_COLUMNS`` is an error, never a silent cut.
    """
    found = df.select(F.col(column).cast("string")).distinct().limit(MAX_PIVOT_COLUMNS + 1).collect()
    if len(found) > MAX_PIVOT_COLUMNS:
        raise ValueError(f"{column} has more than {MAX_PIVOT_COLUMNS} values; use the long form")
    values = sorted(row[0] for row in found if row[0] is not None)
    typed = df.withColumn(column, F.col(column).cast("string"))
    return typed.groupBy(*keys).pivot(column, values).agg(value)


def dense_index(df: DataFrame, order: list[str], out: str, start: int = 0, chunks: int | None = None) -> DataFrame:
    """Consecutive numbers in a total order over the whole frame.

    The frame is one group for ``ordered.row_numbers``, which cuts it into
    ordered chunks as soon as it is large.
    """
    one = ordered.row_numbers(df.withColumn("_all", F.lit(0)), ["_all"], order, out, chunks)
    return one.withColumn(out, F.col(out) - 1 + start).drop("_all")


def usable_metadata(meta: DataFrame) -> DataFrame:
    """Books with title, author and a birth year that is not BC."""
    known = [F.col(c).isNotNull() for c in ("title", "first_name", "last_name", "birth_year")]
    bc = F.col("birth_year").contains("BC") | F.coalesce(F.col("death_year").contains("BC"), F.lit(False))
    return meta.where(reduce(lambda a, b: a & b, known) & ~bc)


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The ``k`` best rows of each key; Spark limits groups before the shuffle as well."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def stack_rows(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
