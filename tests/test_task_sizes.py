"""Tasks keep their size while the input grows."""

import os

import pytest
from pyspark.sql import functions as F

from indicator_lake.session import pieces, size_tasks
from indicator_lake.sources.cells import read_cells, replace_cells
from proofs import queries

SHUFFLED = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SF_DIR = "/root/testdata/sf0.001"
SIZES = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes")


@pytest.fixture
def kept_conf(spark):
    before = {key: spark.conf.get(key, None) for key in (SHUFFLED, *SIZES)}
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_partitions_follow_the_input_and_task_sizes_do_not(kept_conf):
    seen = []
    for size in (1 << 20, 1 << 30, 6 << 30):
        size_tasks(kept_conf, size)
        seen.append((int(kept_conf.conf.get(SHUFFLED)), *[kept_conf.conf.get(key) for key in SIZES]))
    assert [s[0] for s in seen] == [4, 256, 1536]
    assert {s[1:] for s in seen} == {("8388608b", "16777216b")}


def test_smaller_task_sizes_of_the_session_are_kept(kept_conf):
    kept_conf.conf.set(SIZES[0], "16k")
    size_tasks(kept_conf, 1 << 30)
    assert kept_conf.conf.get(SIZES[0]) == "16384b"


def test_pieces():
    assert [pieces(n, 10, 2) for n in (0, 20, 21)] == [2, 2, 3]


def _planned(rows) -> str:
    return rows._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the driver's tables")
def test_the_ranking_reads_the_current_status_from_a_table(kept_conf):
    assert "row_number" not in _planned(queries.Lake(kept_conf, SF_DIR).ranked)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the driver's tables")
def test_buckets_follow_the_input(kept_conf, monkeypatch):
    asked = []
    monkeypatch.setattr(queries.colocated, "store_colocated", lambda s, db, root, wanted, number, **_: asked.append(number) or {})
    lake = queries.Lake(kept_conf, SF_DIR)
    for size in (1 << 20, 1 << 30, 6 << 30):
        monkeypatch.setattr(lake.inputs, "size", lambda *names, size=size: size)
        lake.colocated()
    assert asked == [8, 128, 768]


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the driver's tables")
def test_places_are_counted_from_what_was_found_once(kept_conf):
    assert "Window" not in _planned(queries.a9_count_distinct(queries.Lake(kept_conf, SF_DIR)))


def test_bag_difference_counts_as_except_all(spark):
    columns = "a int, b double"
    stored = spark.createDataFrame([(1, None), (1, None), (2, 0.5), (3, 1.0)], columns)
    expected = spark.createDataFrame([(1, None), (2, 0.5), (2, 0.5), (4, 1.0)], columns)
    found = queries._bag_difference(stored, expected)
    assert dict(found.collect()) == {
        "stored": 4, "missing": expected.exceptAll(stored).count(), "surplus": stored.exceptAll(expected).count()}
    assert _planned(found).count("LogicalRDD") == 2  # each side is computed once
    none = stored.limit(0)
    assert dict(queries._bag_difference(none, none).collect()) == {"stored": 0, "missing": 0, "surplus": 0}
def test_a_large_cell_is_written_by_as_many_tasks_as_its_size_asks(kept_conf, tmp_path):
    kept_conf.conf.set(SIZES[0], "256k")
    rows = kept_conf.range(0, 200_000, 1, 16).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
    path = str(tmp_path / "cells")
    replace_cells(rows, path, F.lit("hot"))
    assert len(list(tmp_path.glob("cells/*/cell=hot/*.parquet"))) > 8
    assert read_cells(kept_conf, path).select(F.count("*"), F.count_distinct("id")).first()[:] == (200_000, 200_000)


def test_no_window_gathers_a_run(spark, tmp_path):
    """The days of stored runs come from one aggregate: each run is written by more than one task."""

    class Bronze:
        inputs = {"b": spark.range(0, 40, 1, 4).selectExpr(
            "id", "timestamp '2024-01-01 10:00:00' + make_interval(0, 0, 0, cast(id % 2 AS int)) AS _ingested_at",
            "concat('run-', id % 2) AS _ingestion_run_id")}

    Bronze.spark = spark
    runs = queries._stored_runs(Bronze, "b", str(tmp_path / "b"), ["run-0", "run-1"])
    assert [tuple(r) for r in runs.runs().select("run_id", "day", "rows").collect()] == [
        ("run-0", "2024-01-01", 20), ("run-1", "2024-01-02", 20)]
    assert len(list(tmp_path.glob("b/ingestion_date=2024-01-01/*/*.parquet"))) == 4
    assert runs.latest().count() == 20


def test_a_committed_run_is_not_stored_again(spark, tmp_path):
    class Bronze:
        inputs = {"b": spark.range(20).selectExpr(
            "id", "timestamp '2024-01-01 10:00:00' + make_interval(0, 0, 0, cast(id % 2 AS int)) AS _ingested_at",
            "concat('run-', id % 2) AS _ingestion_run_id")}

    Bronze.spark = spark
    files = lambda: {str(f) for f in tmp_path.glob("b/*/*/*.parquet")}
    queries._stored_runs(Bronze, "b", str(tmp_path / "b"), ["run-0"])
    first = files()
    runs = queries._stored_runs(Bronze, "b", str(tmp_path / "b"), ["run-0", "run-1"])
    assert first and first < files()
    assert sorted(r[0] for r in runs.read().select("id").collect()) == list(range(20))
    assert runs.latest().where("id % 2 = 1").count() == 10
    every = files()
    queries._stored_runs(Bronze, "b", str(tmp_path / "b"), ["run-0", "run-1"])
    assert files() == every


def test_rows_that_stay_in_a_touched_cell_are_kept_beside_the_new_ones(spark, tmp_path):
    path, cell = str(tmp_path / "cells"), F.concat(F.lit("c"), F.col("id") % 3)
    rows = spark.range(0, 30, 1, 2).withColumn("v", F.lit("old"))
    replace_cells(rows, path, cell)
    new = spark.range(0, 30, 6).withColumn("v", F.lit("new"))
    touched = {"c0"}
    kept = read_cells(spark, path, touched).where("id % 6 <> 0")
    replace_cells(new, path, cell, touched, kept=kept)
    expected = [(i, "new" if i % 6 == 0 else "old") for i in range(30)]
    assert sorted(tuple(r) for r in read_cells(spark, path).collect()) == expected
    assert read_cells(spark, path, {"c0"}).count() == 10


def test_stages_that_the_jvm_would_not_compile_run_operator_by_operator(kept_conf):
    assert int(kept_conf.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
