"""Versions, run marks and compaction: what readers see while writers fail."""

import threading
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from indicator_lake.operators import quality
from indicator_lake.operators.picks import latest_run
from indicator_lake.plans import lakehouse
from indicator_lake.sources import commits, loader, tables
from indicator_lake.streaming import sinks

DAY = datetime(2024, 5, 1, 12, tzinfo=timezone.utc)
NOW = "2024-06-01"


def failing(spark, n):
    """n rows, the last of which cannot be computed."""
    return spark.range(0, n, 1, 4).select(F.when(F.col("id") < n - 1, F.col("id")).otherwise(F.raise_error(F.lit("lost")).cast("long")).alias("id"))


def ids(df):
    return sorted(r.id for r in df.collect())


def test_a_failed_replace_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    assert loader.replace_table(spark.range(5), path) == 5
    with pytest.raises(Exception, match="lost"):
        loader.replace_table(failing(spark, 400), path)
    assert ids(tables.read_table(spark, path)) == list(range(5))
    assert loader.replace_table(spark.range(7), path) == 7
    assert ids(tables.read_table(spark, path)) == list(range(7))


def test_a_reader_keeps_the_version_it_started_with(spark, tmp_path):
    path = str(tmp_path / "t")
    loader.replace_table(spark.range(5), path)
    reader = tables.read_table(spark, path)
    staged = tables.stage(spark.range(9), path)
    assert ids(tables.read_table(spark, path)) == list(range(5))
    staged.publish()
    assert ids(reader) == list(range(5)) and ids(tables.read_table(spark, path)) == list(range(9))


def test_a_table_may_be_replaced_by_what_is_read_from_it(spark, tmp_path):
    path = str(tmp_path / "t")
    loader.replace_table(spark.range(5), path)
    for n in range(3):
        loader.replace_table(tables.read_table(spark, path).union(spark.range(100 + n, 101 + n)), path)
    assert ids(tables.read_table(spark, path)) == [0, 1, 2, 3, 4, 100, 101, 102]


def test_old_and_abandoned_versions_go_after_the_grace_time(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (3, 4, 5):
        loader.replace_table(spark.range(n), path)
    tables.stage(spark.range(99), path)
    assert commits.remove_old(spark, path) == []
    assert len(commits.remove_old(spark, path, 0)) == 3
    assert ids(tables.read_table(spark, path)) == list(range(5))
    assert [p.name for p in (tmp_path / "t" / "_commits").glob("*.json")] == ["000000000003.json"]


def test_writers_at_the_same_time_commit_one_after_another(spark, tmp_path):
    path = str(tmp_path / "t")
    staged = [tables.stage(spark.range(n), path) for n in range(1, 7)]
    threads = [threading.Thread(target=s.publish) for s in staged]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    state = commits.live(spark, path)
    assert state.number == 6 and tables.read_table(spark, path).count() in range(1, 7)


def test_partitioned_versions_keep_types_and_order(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(10).select(F.lit("007").alias("_ingestion_run_id"), "id", F.array("id").alias("a"))
    tables.write_clustered(df, path, ["id"], ["_ingestion_run_id"])
    stored = tables.read_table(spark, path)
    assert stored.columns == ["id", "a", "_ingestion_run_id"] and stored.first()["_ingestion_run_id"] == "007"


def test_the_latest_run_is_read_without_asking_rows_or_other_runs(spark, tmp_path):
    path = str(tmp_path / "t")
    for number, run_id in enumerate(("b/1=x", "a", "c")):
        stamp = datetime(2024, 5, 3 - number % 2, 12, tzinfo=timezone.utc)
        loader.append_run(spark.range(number, number + 4), path, run_id, "s", stamp)
    stored = tables.Snapshots(spark, path)
    newest = latest_run(stored)
    assert ids(newest) == [2, 3, 4, 5] and {r[0] for r in newest.select("_ingestion_run_id").collect()} == {"c"}
    plan = newest.select("id")._jdf.queryExecution().toString()
    assert "subquery" not in plan.lower() and "_ingested_at#" not in plan.split("Physical Plan")[1]
    assert len(newest.inputFiles()) == len([f for f in newest.inputFiles() if "_ingestion_run_id=c" in f])
    assert [(r.run_id, r.rows) for r in stored.runs().collect()] == [("a", 4), ("b/1=x", 4), ("c", 4)]
    again = datetime(2024, 5, 9, tzinfo=timezone.utc)
    loader.append_run(spark.range(50, 52), path, "b/1=x", "s", again)
    assert ids(latest_run(stored)) == [50, 51] and stored.read().count() == 10


def test_a_run_whose_writer_failed_before_its_mark_is_not_seen(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    loader.append_run(spark.range(3), path, "run-1", "s", DAY)
    monkeypatch.setattr(loader, "add_run", lambda *_: (_ for _ in ()).throw(OSError("driver lost")))
    with pytest.raises(OSError):
        loader.append_run(spark.range(4), path, "run-2", "s", DAY.replace(day=2))
    monkeypatch.undo()
    stored = tables.Snapshots(spark, path)
    assert ids(stored.latest()) == [0, 1, 2] and ids(stored.read()) == [0, 1, 2]
    loader.append_run(spark.range(4), path, "run-2", "s", DAY.replace(day=3))  # keeps the folder of its first try
    assert ids(stored.latest()) == [0, 1, 2, 3] and stored.read().count() == 7


def test_a_table_without_marks_is_asked_for_its_stamps(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = loader.with_lineage(spark.range(3), "r1", "s", DAY).union(loader.with_lineage(spark.range(9, 10), "r2", "s", DAY.replace(day=9)))
    rows.write.partitionBy("_ingestion_run_id").parquet(path)
    assert ids(tables.Snapshots(spark, path).latest()) == [9]


def test_a_violated_rule_leaves_the_served_layer(spark, tmp_path):
    model = lakehouse.Model("m", lambda t: t["s"], ("id",))
    rules = [quality.row_condition("m", "small", F.col("id") < 100), quality.unique_key("m", ["id"])]
    root, audit = str(tmp_path / "lake"), str(tmp_path / "audit")

    def refresh(df, strict=True):
        return lakehouse.refresh_layer(spark, [model], {"s": df}, root, rules, audit, strict)["m"]

    assert refresh(spark.range(5)).count() == 5
    for bad in (spark.range(200), spark.range(5).union(spark.range(3))):
        with pytest.raises(quality.QualityFailure):
            refresh(bad)
        assert ids(tables.read_table(spark, f"{root}/m")) == list(range(5))
    assert refresh(spark.range(200), strict=False).count() == 200
    report = spark.read.parquet(audit).groupBy("check_name", "violations").count().collect()
    assert {(r[0], r[1], r[2]) for r in report} == {("m.small", 0, 2), ("m.small", 100, 2), ("m.unique_key", 0, 3), ("m.unique_key", 3, 1)}


def test_row_rules_are_counted_once_by_the_writing_job(spark, tmp_path):
    df = spark.range(0, 1000, 1, 8)
    rules = [quality.row_condition("m", "small", F.col("id") < 900), quality.not_null("m", ["missing"])[0]]
    staged = tables.stage(df, str(tmp_path / "m"), ["id"], measures=quality.row_measures(df, "m", rules))
    assert staged.rows == 1000 and staged.measured == {"m.small": 100}


# --- compaction ----------------------------------------------------------------------------


def event(i, bad=False):
    body = f'{{"id_evento": "e{i}", "id_municipio": "{"12" if bad else "1234567"}", "sigla_uf": "SP", "ano": 2025, "rede": "municipal", '
    return body + f'"serie": "2 ano", "taxa_alfabetizacao": {i % 100}, "data_evento": "2024-05-0{1 + i % 9}T10:00:00Z"}}'


def feed(spark, folder, numbers):
    for n in numbers:
        rows = [(bytearray(event(10 * n + k, k == 3).encode()), f"m{10 * n + k}") for k in range(5)]
        spark.createDataFrame(rows, sinks.MESSAGE_SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def drain(spark, tmp_path, checkpoint="cp"):
    stream = sinks.file_messages(spark, str(tmp_path / "in"), 1)
    sinks.start(stream, str(tmp_path / "out"), str(tmp_path / checkpoint), as_of=F.lit(NOW).cast("timestamp"), drain=True).awaitTermination()


def seen(spark, tmp_path):
    root = str(tmp_path / "out")
    return sorted(r.id_evento for r in sinks.read_events(spark, root).collect()), sinks.read_events(spark, root, sinks.REJECTED).count()


def expected(batches):
    return sorted(f"e{10 * n + k}" for n in range(batches) for k in (0, 1, 2, 4)), batches


def test_compaction_stopped_at_any_step_loses_and_doubles_nothing(spark, tmp_path):
    root, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    feed(spark, str(tmp_path / "in"), range(8))
    drain(spark, tmp_path)
    assert seen(spark, tmp_path) == expected(8)
    closed = sinks.closed_batches(spark, root)
    assert list(closed.values()) == [6] and list(sinks.closed_batches(spark, root, checkpoint=checkpoint).values()) == [7]
    sinks.write_compacted(spark, root, closed)  # stopped before its commit
    assert seen(spark, tmp_path) == expected(8)
    assert sinks.compact(spark, root) == 28  # stopped before anything is removed
    assert seen(spark, tmp_path) == expected(8)
    feed(spark, str(tmp_path / "in"), range(8, 11))
    drain(spark, tmp_path)  # the stream runs on
    assert seen(spark, tmp_path) == expected(11)
    files = commits.Files(spark, f"{root}/{sinks.VALID}")
    query = next(iter(closed))
    files.remove(f"query={query}/batch_id=2")  # stopped while removing
    assert seen(spark, tmp_path) == expected(11)
    assert sinks.remove_covered(spark, root) == []
    assert len(sinks.remove_covered(spark, root, grace_seconds=0)) == 7  # six micro-batches and the abandoned folder
    assert seen(spark, tmp_path) == expected(11)
    assert sinks.compact(spark, root, checkpoint=checkpoint) == 16 and sinks.compact(spark, root, checkpoint=checkpoint) == 0
    assert sinks.compact(spark, root, sinks.REJECTED, checkpoint) == 11
    for name in (sinks.VALID, sinks.REJECTED):
        sinks.remove_covered(spark, root, name, 0)
        assert not commits.Files(spark, f"{root}/{name}/query={query}").names()
    assert seen(spark, tmp_path) == expected(11)
    drain(spark, tmp_path, "other")  # a new checkpoint is another query and adds its own rows
    assert seen(spark, tmp_path)[1] == 22


def test_two_compactions_do_not_both_commit(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "out")
    feed(spark, str(tmp_path / "in"), range(4))
    drain(spark, tmp_path)
    write = sinks.write_compacted

    def overtaken(*args):
        staged = write(*args)
        monkeypatch.setattr(sinks, "write_compacted", write)
        assert sinks.compact(spark, root) == 12
        return staged

    monkeypatch.setattr(sinks, "write_compacted", overtaken)
    with pytest.raises(commits.CommitConflict):
        sinks.compact(spark, root)
    assert seen(spark, tmp_path) == expected(4)
