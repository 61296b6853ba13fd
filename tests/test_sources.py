"""Readers and writers."""

import pytest
from pyspark.sql import functions as F

from tramline.operators import aggregates, shaping
from tramline.sources import readers, writers


@pytest.fixture
def path(tmp_path):
    return str(tmp_path)


def test_partition_pruning(spark, path):
    df = spark.createDataFrame([(i, f"2024-01-{i % 5 + 1:02d}") for i in range(50)], "id bigint, day string")
    df = df.withColumn("day_date", F.to_date("day"))
    root = writers.write_by_date(df.drop("day"), path + "/d", "day_date")
    got = readers.read_partitioned(spark, root, F.col("day") == 3)
    assert got.count() == 10
    plan = got._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_rewriting_a_day_leaves_other_days(spark, path):
    one = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "id bigint, d string").withColumn("d", F.to_date("d"))
    root = writers.write_by_date(one, path + "/d", "d")
    writers.write_by_date(one.where("id = 2").withColumn("id", F.lit(9).cast("bigint")), root, "d")
    assert sorted(r.id for r in readers.read_partitioned(spark, root).collect()) == [1, 9]


def test_multi_line_json(spark, path):
    with open(path + "/w.json", "w") as f:
        f.write('[{"site": "LSZH",\n "observations": [{"temp": 1.5},\n {"temp": 2.5}]}]')
    df = readers.read_json(spark, path + "/w.json", "site string, observations array<struct<temp:double>>", True)
    assert [r.temp for r in df.select(F.explode("observations.temp").alias("temp")).collect()] == [1.5, 2.5]


def test_json_object_keyed_by_id(spark, path):
    with open(path + "/m.txt", "w") as f:
        f.write('{"12": {"title": "A", "birth_year": null}, "7": {"title": null, "birth_year": "40 BC"}}')
    df = readers.read_json_map(spark, path + "/m.txt", "struct<title:string,birth_year:string>")
    assert sorted(tuple(r) for r in df.collect()) == [("12", "A", None), ("7", None, "40 BC")]


def test_word_list(spark, path):
    with open(path + "/w.txt", "w") as f:
        f.write("The\nof\n\nthe \n")
    extra = spark.createDataFrame([("licence",)], "word string")
    assert sorted(r.word for r in readers.read_word_list(spark, path + "/w.txt", extra).collect()) == ["licence", "of", "the"]


def test_csv_round_trip(spark, path):
    df = spark.createDataFrame([(1, "a;b", 2.5), (2, None, None)], "id int, s string, v double")
    root = writers.write_csv(df, path + "/c", sep=";")
    got = readers.read_csv(spark, root, "id int, s string, v double", sep=";")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, df.collect()))


def test_sequence_file(spark, path):
    spark.sparkContext.parallelize([("1", "one text"), ("2", "two")]).saveAsSequenceFile(path + "/s")
    assert sorted(tuple(r) for r in readers.read_sequence_file(spark, path + "/s").collect()) == [("1", "one text"), ("2", "two")]


def test_batches(spark):
    df = spark.range(7).repartition(3)
    got = list(readers.iterate_batches([df, spark.range(1)], 3))
    assert got[0] == [("id",)] and [len(b) for b in got] == [1, 3, 3, 1, 1, 1]
    assert sorted(x[0] for b in got[1:4] for x in b) == list(range(7))


def test_pivot_columns_are_sorted_and_bounded(spark, monkeypatch):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "b")], "id int, c string")
    assert shaping.pivot_discovered(df, ["id"], "c", F.count(F.lit(1))).columns == ["id", "a", "b"]
    monkeypatch.setattr(shaping, "MAX_PIVOT_COLUMNS", 1)
    with pytest.raises(ValueError):
        shaping.pivot_discovered(df, ["id"], "c", F.count(F.lit(1)))


def test_column_names_with_dots(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0)], "t int, `7.temperature` double, `7.humidity` double")
    got = sorted((r.sensor, r.measure, r.value) for r in shaping.wide_to_long(df, "t").collect())
    assert got == [("7", "humidity", 3.0), ("7", "temperature", 2.0)]


def test_dense_index_of_a_large_frame(spark):
    df = spark.range(500).withColumn("x", F.col("id") * 37 % 101)
    for limit in (40, 10**6):
        got = shaping.dense_index(df, ["x", "id"], "i", 0, limit).orderBy("x", "id").collect()
        assert [r.i for r in got] == list(range(500))


def test_profile_counts_blanks(spark):
    df = spark.createDataFrame([("1", None), (" ", "x"), ("30", "x")], "a string, b string")
    got = {r.column_name: r for r in aggregates.profile(df, ["a", "b"]).collect()}
    assert (got["a"].n_rows, got["a"].n_distinct, got["a"].n_blank, got["a"].min_number, got["a"].max_number) == (3, 3, 1, 1.0, 30.0)
    assert (got["b"].n_distinct, got["b"].n_blank) == (1, 1)


def test_new_days_only(spark, path):
    def rows(*pairs):
        return spark.createDataFrame(list(pairs), "id bigint, d string").withColumn("d", F.to_date("d"))

    root = path + "/d"
    assert sorted(writers.write_new_days(rows((1, "2024-01-01"), (2, "2024-01-02"), (9, None)), root, "d")) == [(2024, 1, 1), (2024, 1, 2)]
    assert writers.write_new_days(rows((7, "2024-01-02"), (3, "2024-02-01")), root, "d") == [(2024, 2, 1)]
    assert sorted(r.id for r in readers.read_partitioned(spark, root).collect()) == [1, 2, 3]
    assert writers.write_new_days(rows((7, "2024-01-02")), root, "d") == []
    assert writers.finished_days(spark, root).count() == 3


def test_a_broken_run_leaves_nothing_half_visible(spark, path, monkeypatch):
    days = [(i, f"2024-01-{i % 3 + 1:02d}") for i in range(9)]
    df = spark.createDataFrame(days, "id bigint, d string").withColumn("d", F.to_date("d"))
    root, real, seen = path + "/d", readers.children, []

    def break_late(spark, at):
        seen.append(at)
        if len(seen) > 3:  # the first days are published, the manifest is not written
            raise RuntimeError("lost")
        return real(spark, at)

    more = spark.createDataFrame([(100, "2025-05-05")], "id bigint, d string").withColumn("d", F.to_date("d"))
    monkeypatch.setattr(writers.readers, "children", break_late)
    with pytest.raises(RuntimeError):
        writers.write_new_days(df.unionByName(more), root, "d")
    monkeypatch.undo()
    assert writers.finished_days(spark, root) is None
    got = readers.read_partitioned(spark, root)
    assert all(r["count"] == 3 for r in got.groupBy("day").count().collect())
    writers.write_new_days(df, root, "d")
    assert sorted(r.id for r in readers.read_partitioned(spark, root).collect()) == list(range(9))


def test_block_sample_opens_drawn_blocks_only(spark, path):
    df = spark.range(1000).withColumn("block", F.col("id") % 40)
    df.repartition("block").write.partitionBy("block").parquet(path + "/b")
    got = readers.block_sample(spark, path + "/b", 0.3)
    drawn = {r.block for r in got.select("block").distinct().collect()}
    assert 3 <= len(drawn) <= 22 and got.count() == 25 * len(drawn)
    assert {f.split("block=")[1].split("/")[0] for f in got.inputFiles()} == {str(b) for b in drawn}
    again = {r.block for r in readers.block_sample(spark, path + "/b", 0.3).select("block").distinct().collect()}
    assert again == drawn and readers.block_sample(spark, path + "/b", 0.0).count() == 0
    assert readers.block_sample(spark, path + "/b", 1.0).count() == 1000


def test_row_ids_follow_the_written_order(spark, path):
    df = spark.range(0, 5000, 1, 7)
    df.select((F.col("id") * 3).alias("x")).write.parquet(path + "/a")
    df.select((F.col("id") * 5).alias("y")).write.option("maxRecordsPerFile", 300).parquet(path + "/b")
    a, b = (readers.read_with_row_id(spark, path + p) for p in ("/a", "/b"))
    got = a.join(b, "row_id").collect()
    assert len(got) == 5000 and all(r.x == 3 * r.row_id and r.y == 5 * r.row_id for r in got)


def test_sequence_file_round_trip(spark, path):
    df = spark.createDataFrame([(1, "a b"), (2, "é\nline"), (3, None)], "doc_id long, text string")
    at = writers.write_sequence_file(df, path + "/s", "doc_id", "text")
    assert sorted(map(tuple, readers.read_sequence_file(spark, at).collect())) == [("1", "a b"), ("2", "é\nline"), ("3", "")]


def test_frequent_keys_fill_several_partitions(spark):
    df = spark.range(10_000).withColumn("k", F.when(F.col("id") % 10 > 0, F.lit(7)).otherwise(F.col("id") % 97))
    df = df.withColumn("k", F.when(F.col("k") == 13, None).otherwise(F.col("k")))
    got = shaping.spread_keys(df, ["k"], 16, ["id"]).withColumn("p", F.spark_partition_id())
    sizes = {r.p: r["count"] for r in got.groupBy("p").count().collect()}
    assert sum(sizes.values()) == 10_000 and max(sizes.values()) < 1.4 * 10_000 / 16
    per_key = {r.k: r.n for r in got.groupBy("k").agg(F.countDistinct("p").alias("n")).collect()}
    assert per_key.pop(7) == 15 and set(per_key.values()) == {1} and None in per_key
    assert shaping.spread_keys(df.limit(0), ["k"], 4, ["id"]).count() == 0
