import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from cohortloom.operators.shift import Shift, shift_cohort
from cohortloom.session import fresh_path, shared_folder
from cohortloom.sources.published import (
    NotPublished,
    append_logged,
    prune_versions,
    publish,
    published_versions,
    read_logged,
    read_published,
    write_feature_table,
)
from cohortloom.sources.sinks import (
    KeyViolation,
    SchemaClash,
    append_conformed,
    append_evolving,
    feature_table_verify,
    key_violations,
    partitioning,
    write_csv,
    write_named,
    write_table,
    write_verified,
)
from cohortloom.sources.tables import read_named, read_table
from cohortloom.streaming.profile import drain_to_table, keep_partials, merged_profile, window_profile, window_profile_stream


def test_shared_folder_is_the_one_the_session_names(spark):
    assert fresh_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_scan_is_pruned_and_filtered_at_the_source(spark):
    path = fresh_path(spark, "pruned")
    write_table(spark.range(100).select("id", (F.col("id") * 2.0).alias("a"), F.lit("x").alias("b")), path)
    plan = read_table(spark, path, ["id", "a"]).where("a > 50")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint,a:double>" in plan and "GreaterThan(a,50.0)" in plan


def test_partitioned_tables_are_read_by_partition(spark):
    path = fresh_path(spark, "parts")
    table = write_table(spark.range(100).select("id", (F.col("id") % 2).alias("p")), path, partition_by=["p"], rebalance=True)
    plan = table.where("p = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p" in plan
    assert table.where("p = 1").count() == 50


def test_named_tables(spark):
    spark.range(3).createOrReplaceTempView("three_rows")
    assert read_named(spark, "three_rows", ["id"]).count() == 3
    rows = spark.range(6).selectExpr("id", "id % 2 as p")
    name = f"study_{uuid.uuid4().hex}"
    written = write_named(rows, name, partition_by=["p"], path=fresh_path(spark, "named"))
    assert written.where("p = 1").count() == 3
    other = write_named(rows.selectExpr("id as key"), name, path=fresh_path(spark, "named"))
    assert other.columns == ["key"] and read_named(spark, name).count() == 6
    spark.sql(f"DROP TABLE {name}")


def test_a_session_without_a_shared_folder_is_refused():
    class Session:
        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(ValueError):
        shared_folder(Session())


def test_appends_evolve_and_conform(spark):
    path = fresh_path(spark, "log")
    write_table(spark.createDataFrame([(1, "a")], "id int, v string"), path)
    evolved = append_evolving(spark.createDataFrame([(2, "b", 0.5)], "id int, v string, extra double"), path)
    assert {r.id: r.extra for r in evolved.collect()} == {1: None, 2: 0.5}
    other = fresh_path(spark, "log")
    write_table(spark.createDataFrame([(1, "a")], "id int, v string"), other)
    with pytest.raises(SchemaClash):
        append_conformed(spark.createDataFrame([(9, "7")], "unknown int, id string"), other)
    fixed = append_conformed(spark.createDataFrame([(9, "7")], "unknown int, id string"), other, strict=False)
    assert fixed.schema.simpleString() == "struct<id:int,v:string>"
    assert sorted((r.id, r.v or "") for r in fixed.collect()) == [(1, "a"), (7, "")]


def test_appends_follow_the_targets_partitions(spark):
    path = fresh_path(spark, "by-key")
    table = write_table(spark.createDataFrame([(1, "01")], "v int, k string"), path, partition_by=["k"])
    assert partitioning(table, path) == ["k"]
    assert sorted((r.v, r.k) for r in append_conformed(spark.createDataFrame([("2", "1")], "v string, k string"), path, schema=table.schema).collect()) == [(1, "01"), (2, "1")]
    both = append_evolving(spark.createDataFrame([(3, "02", 0.5)], "v int, k string, extra double"), path, schema=table.schema)
    assert sorted((r.v, r.k, r.extra) for r in both.collect())[0] == (1, "01", None)
    assert both.count() == 3
    with pytest.raises(SchemaClash):
        append_evolving(spark.createDataFrame([(4, "03")], "v int, k string"), path, partition_by=["v"], schema=table.schema)


def test_partition_values_keep_their_type(spark):
    rows = spark.createDataFrame([(1, "01"), (2, "1"), (3, "02"), (4, None)], "v int, k string")
    table = write_table(rows, fresh_path(spark, "typed"), partition_by=["k"])
    assert table.schema["k"].dataType.simpleString() == "string" and table.columns == ["v", "k"]
    assert sorted(table.collect()) == sorted(rows.collect())


def test_an_empty_partitioned_write_reads_back_empty(spark):
    table = write_table(spark.createDataFrame([], "v int, k string"), fresh_path(spark, "empty"), partition_by=["k"])
    assert table.count() == 0 and table.columns == ["v", "k"]


def test_a_type_clash_is_found_before_anything_is_written(spark):
    path = fresh_path(spark, "clash")
    write_table(spark.createDataFrame([(1, 1.5)], "a int, b double"), path)
    with pytest.raises(SchemaClash):
        append_evolving(spark.createDataFrame([(2.5, 1.0)], "a double, b double"), path)
    widened = append_evolving(spark.createDataFrame([(2, 7)], "a int, b int"), path)
    assert sorted(tuple(r) for r in widened.collect()) == [(1, 1.5), (2, 7.0)]


def test_a_misfit_value_stops_the_append(spark):
    path = fresh_path(spark, "misfit")
    write_table(spark.createDataFrame([(1,)], "a int"), path)
    for bad in ("3000000000", "x"):
        with pytest.raises(Exception, match="does not hold"):
            append_conformed(spark.createDataFrame([(bad,)], "a string"), path)
    assert read_table(spark, path).count() == 1


def test_csv_keeps_texts(spark):
    rows = [(" a ",), ("b\nc",), (None,), ("",), ('say "x"\\',), (",;\t",)]
    df = spark.createDataFrame(rows, "t string")
    assert sorted(map(str, write_csv(df, fresh_path(spark, "csv")).collect())) == sorted(map(str, df.collect()))


def test_verified_append_counts_its_own_rows(spark):
    path = fresh_path(spark, "verified")
    write_table(spark.range(3), path)
    assert tuple(write_verified(spark.range(2), path, mode="append").first()) == (2, 2, True)
    assert tuple(write_verified(spark.range(2), fresh_path(spark, "verified"), mode="append").first()) == (2, 2, True)


def test_a_null_key_is_not_unique(spark):
    row = feature_table_verify(spark.createDataFrame([(None, 1.0), (2, 1.0)], "k int, f double"), ["k"]).first()
    assert (row.row_count, row.distinct_keys, row.key_is_unique) == (2, 1, False)


def test_a_bad_feature_table_is_not_published(spark):
    path = fresh_path(spark, "features")
    with pytest.raises(KeyViolation):
        write_feature_table(spark.createDataFrame([("a", 1.0), ("a", 2.0)], "k string, f double"), ["k"], ["f"], path)
    with pytest.raises(NotPublished):
        read_published(spark, path)


def test_verified_write_counts_once(spark):
    row = write_verified(spark.range(1234), fresh_path(spark, "verified")).first()
    assert tuple(row) == (1234, 1234, True)
    options = {"partition_by": ["p"], "rebalance": True}
    split = write_verified(spark.range(50).selectExpr("id", "id % 2 as p"), fresh_path(spark, "verified"), **options)
    assert tuple(split.first()) == (50, 50, True)
    empty = write_verified(spark.range(0), fresh_path(spark, "verified")).first()
    assert tuple(empty) == (0, 0, True)


def test_feature_table_refuses_bad_keys(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), (None, 3.0)], "k string, f double")
    assert tuple(key_violations(df, ["k"]).first()) == (1, 1)
    with pytest.raises(KeyViolation):
        write_feature_table(df, ["k"], ["f"], fresh_path(spark, "features"))
    good = write_feature_table(df.limit(1), ["k"], ["f"], fresh_path(spark, "features"))
    assert good.count() == 1


def test_csv_round_trip(spark):
    df = spark.createDataFrame([("a,b", 0.1), ('say "x"', 1 / 3)], "feature string, importance double")
    back = write_csv(df, fresh_path(spark, "csv"))
    assert back.schema == df.schema
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_shift_moves_chosen_rows_only(spark):
    df = spark.createDataFrame([(1.0, "v1"), (5.0, "v1"), (None, "v1")], "x double, data_version string")
    got = shift_cohort(df, {"x": Shift(2.0, 1.0, high=10.0)}, F.col("x") > 2, "v2").collect()
    assert [tuple(r) for r in got] == [(1.0, "v1"), (10.0, "v2"), (None, "v1")]
    added = shift_cohort(df.drop("data_version"), {"x": Shift(offset=1.0)}, version="v2")
    assert [tuple(r) for r in added.collect()] == [(2.0, "v2"), (6.0, "v2"), (None, "v2")]


def at(hour, minute=0, day=1):
    return dt.datetime(2024, 1, day, hour, minute)


def test_stream_gives_finished_windows_and_leaves_late_rows_out(spark):
    source, target, progress = (fresh_path(spark, n) for n in ("events", "hourly", "progress"))
    schema = "ts timestamp, kind string, value double"
    first = [(at(0, 5), "a", 1.0), (at(0, 50), "a", 3.0), (at(1, 10), "a", 5.0), (at(3), "b", 7.0)]
    write_table(spark.createDataFrame(first, schema), source)

    def drain():
        stream = spark.readStream.schema(schema).parquet(source)
        drain_to_table(window_profile_stream(stream, "ts", "kind", "value"), target, progress)
        return {(r.window_start.hour, r.kind): (r.row_count, r.avg_value) for r in spark.read.parquet(target).collect()}

    assert drain() == {(0, "a"): (2, 2.0), (1, "a"): (1, 5.0)}
    # one row behind the watermark, one still in an open window, one far ahead that closes it
    late = [(at(0, 30), "a", 100.0), (at(3, 30), "b", 9.0), (at(12), "c", 1.0)]
    write_table(spark.createDataFrame(late, schema), source, mode="append")
    assert drain() == {(0, "a"): (2, 2.0), (1, "a"): (1, 5.0), (3, "b"): (2, 8.0)}


def test_batch_profile_covers_every_row(spark):
    rows = [(at(0, 5), "a", 1.0), (at(0, 59), "a", None), (at(1), "a", 2.0)]
    got = window_profile(spark.createDataFrame(rows, "ts timestamp_ntz, kind string, value double"), "ts", "kind", "value")
    assert {r.window_start.hour: (r.row_count, r.min_value) for r in got.collect()} == {0: (2, 1.0), 1: (1, 2.0)}


def folders(path):
    import os

    return {name for name in os.listdir(path.removeprefix("file:")) if not name.startswith(("_", "."))}


def test_publish_writes_once_and_a_refused_version_leaves_nothing(spark):
    path = fresh_path(spark, "published")
    with pytest.raises(NotPublished):
        read_published(spark, path)
    write_feature_table(spark.range(5).selectExpr("id", "id * 2 as x"), ["id"], ["x"], path)
    assert len(folders(path)) == 1
    old = read_published(spark, path)
    with pytest.raises(KeyViolation):
        write_feature_table(spark.range(5).selectExpr("id % 2 as id", "id as x"), ["id"], ["x"], path)
    assert len(folders(path)) == 1 and read_published(spark, path).count() == 5
    write_feature_table(spark.range(9).selectExpr("id", "id * 2 as x", "'p' || id % 2 as p"), ["id"], ["x", "p"], path, partition_by=["p"])
    now = read_published(spark, path)
    assert now.columns == ["id", "x", "p"] and now.count() == 9 and old.count() == 5
    names = [r.version for r in published_versions(spark, path).collect()]
    assert read_published(spark, path, version=names[0]).count() == 5
    assert prune_versions(spark, path, keep=1) == names[:1] and folders(path) == {names[1]}
    assert read_published(spark, path, ["x"]).count() == 9
    with pytest.raises(ValueError):
        prune_versions(spark, path, keep=0)


def test_a_failing_write_does_not_move_the_pointer(spark):
    path = fresh_path(spark, "published")
    publish(spark.range(3), path)
    with pytest.raises(Exception):
        publish(spark.range(3).select(F.raise_error(F.lit("broken")).alias("id")), path)
    assert read_published(spark, path).count() == 3 and len(folders(path)) == 1


def test_empty_version_keeps_its_schema(spark):
    path = fresh_path(spark, "published")
    publish(spark.range(0).selectExpr("id", "cast(id as string) as s"), path)
    assert read_published(spark, path).dtypes == [("id", "bigint"), ("s", "string")]


def test_the_schema_log_decides_in_any_session(spark):
    path = fresh_path(spark, "logged")
    append_logged(spark.range(3).selectExpr("id", "1.5D as x", "'a' as p"), path, ["p"])
    other = spark.newSession()
    wider = other.range(3, 5).selectExpr("cast(id as int) as id", "2.5f as x", "'7' as p", "true as fresh")
    got = append_logged(wider, path)
    assert got.dtypes == [("id", "bigint"), ("x", "double"), ("p", "string"), ("fresh", "boolean")]
    assert sorted((r.id, r.x, r.p, r.fresh) for r in read_logged(other, path).collect()) == [(i, 1.5, "a", None) for i in range(3)] + [(i, 2.5, "7", True) for i in (3, 4)]
    for bad in (other.range(1).selectExpr("'x' as id", "1D as x", "'a' as p"), other.range(1).selectExpr("id", "1D as x", "1D as p")):
        with pytest.raises(SchemaClash):
            append_logged(bad, path)
    with pytest.raises(SchemaClash):
        append_logged(wider, path, ["x"])
    with pytest.raises(SchemaClash):
        append_logged(other.range(1), path)
    assert read_logged(spark, path, ["id"]).count() == 5


def test_the_schema_log_spares_the_data_files(spark):
    """Files that are no table files at all do not disturb an append: none is opened."""
    import os

    path = fresh_path(spark, "logged")
    append_logged(spark.range(3), path)
    local = path.removeprefix("file:")
    for name in os.listdir(local):
        if name.startswith("part-"):
            with open(os.path.join(local, name), "wb") as file:
                file.write(b"not a table")
            os.path.exists(os.path.join(local, f".{name}.crc")) and os.remove(os.path.join(local, f".{name}.crc"))
    assert append_logged(spark.range(3, 6), path).dtypes == [("id", "bigint")]


def stream_rows(spark, parts):
    schema = "ts timestamp, kind string, value double"
    source = fresh_path(spark, "events")
    for part in parts:
        spark.createDataFrame([(dt.datetime(2024, 1, 1, h, m), k, v) for h, m, k, v in part], schema).coalesce(1).write.mode("append").parquet(source)
    return source, schema


PARTS = [
    [(0, 5, "a", 1.0), (0, 50, "a", 3.0), (1, 1, "a", 5.0)],
    [(3, 0, "b", 7.0), (0, 30, "a", 100.0)],  # out of order, but its window is still open
    [(3, 59, "b", 9.0), (4, 0, "a", None), (1, 30, "c", 2.0)],
]


def test_running_profile_gives_every_window_and_late_rows_count(spark):
    source, schema = stream_rows(spark, PARTS[:2])
    target, progress = fresh_path(spark, "partials"), fresh_path(spark, "progress")

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("latestFirst", "false").parquet(source)
        keep_partials(stream, "ts", "kind", "value", target, progress)
        return {(r.window_start.hour, r.kind): tuple(r)[2:] for r in merged_profile(spark, target, "kind").collect()}

    first = run()
    assert first[0, "a"][:4] == (3, 104.0 / 3, 1.0, 100.0) and first[3, "b"][:4] == (1, 7.0, 7.0, 7.0)
    assert {k: r[5] for k, r in first.items()} == {(0, "a"): False, (1, "a"): False, (3, "b"): True}
    part = spark.createDataFrame([(dt.datetime(2024, 1, 1, h, m), k, v) for h, m, k, v in PARTS[2]], schema)
    part.coalesce(1).write.mode("append").parquet(source)
    got = run()
    rows = spark.read.schema(schema).parquet(source)
    want = {(r.window_start.hour, r.kind): tuple(r)[2:] for r in window_profile(rows, "ts", "kind", "value").collect()}
    assert {k: r[:4] for k, r in got.items()} == want
    assert {k: r[4] for k, r in got.items()} == {(0, "a"): 0, (1, "a"): 0, (3, "b"): 0, (4, "a"): 0, (1, "c"): 1}
    assert {k for k, r in got.items() if r[5]} == {(3, "b"), (4, "a")}
    assert run() == got  # nothing new, nothing twice


def test_a_repeated_micro_batch_replaces_itself(spark):
    from cohortloom.streaming.profile import write_partials

    target = fresh_path(spark, "partials")
    rows = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 5), "a", 1.0)], "ts timestamp, kind string, value double")
    for batch in (0, 1, 1, 0):
        write_partials(rows, batch, "ts", "kind", "value", target)
    assert merged_profile(spark, target, "kind").first().row_count == 2


def test_the_keys_themselves_are_grouped_only_where_hashes_clash(spark, tmp_path, monkeypatch):
    import cohortloom.sources.published as published

    sound = spark.range(50).selectExpr("id AS a", "CAST(id % 7 AS string) AS b", "id * 2 AS f")
    for rows in (sound.unionByName(sound.limit(1)), sound.selectExpr("nullif(a, 3) AS a", "b", "f")):
        with pytest.raises(published.KeyViolation):
            published.write_feature_table(rows, ["a", "b"], ["f"], str(tmp_path / "refused"))
    monkeypatch.setattr(published, "key_violations", None)
    assert published.write_feature_table(sound, ["a", "b"], ["f"], str(tmp_path / "kept")).count() == 50
    assert published.write_feature_table(sound.limit(0), ["a", "b"], ["f"], str(tmp_path / "empty")).count() == 0
