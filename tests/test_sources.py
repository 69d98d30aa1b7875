import json
from datetime import datetime, timezone
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from indicator_lake.session import work_folder
from indicator_lake.sources import catalog, loader, tables

DAY = datetime(2024, 5, 1, 12, tzinfo=timezone.utc)


def make_source(name, mode="full_snapshot", **extra):
    base = {"source_project": "p", "source_dataset": "d", "source_table": name, "destination_table": name}
    return {"name": name, "mode": mode, **base, **extra}


def make_loader(spark, root, frames, run_id="run-1", **options):
    def read(source):
        return frames[source["source_table"]]

    return loader.Loader(spark, str(root), read, run_id=run_id, clock=lambda: DAY, **options)


def test_catalog_names_modes_and_inheritance(tmp_path):
    sources = catalog.build_source_list(catalog.DEFAULT_CATALOG)
    names = {s["name"] for s in sources}
    assert {"uf", "municipio", "alunos_amostra", "meta_alfabetizacao_brasil", "meta_alfabetizacao_uf"} <= names
    assert {"meta_alfabetizacao_municipio", "dicionario", "diretorio_municipio"} <= names
    students = next(s for s in sources if s["name"] == "alunos_amostra")
    assert students["mode"] == catalog.FULL_SNAPSHOT and "sample_rows" not in students
    assert all({"source_project", "source_dataset"} <= s.keys() for s in sources)
    assert [s["name"] for s in catalog.select_sources(sources, {"uf"})] == ["uf"]
    assert catalog.select_sources(sources) == sources
    path = tmp_path / "catalog.json"
    path.write_text(json.dumps(catalog.DEFAULT_CATALOG))
    assert catalog.build_source_list(catalog.load_catalog(str(path))) == sources


def test_snapshots_append_and_a_repeated_run_replaces_itself(spark, tmp_path):
    frames = {"t": spark.range(10).withColumn("v", F.lit("x"))}
    for run_id in ("007", "008", "008"):
        assert make_loader(spark, tmp_path, frames, run_id).load(make_source("t")) == (10, "FULL_SNAPSHOT_CREATED")
    stored = tables.read_table(spark, f"{tmp_path}/t")
    assert {(r[0], r[1]) for r in stored.groupBy("_ingestion_run_id").count().collect()} == {("007", 10), ("008", 10)}
    assert stored.select("_source_table").distinct().collect()[0][0] == "p.d.t"


def test_changed_columns_are_refused(spark, tmp_path):
    make_loader(spark, tmp_path, {"t": spark.range(3)}).load(make_source("t"))
    changed = {"t": spark.range(3).withColumn("extra", F.lit(1))}
    with pytest.raises(ValueError, match="extra"):
        make_loader(spark, tmp_path, changed, "run-2").load(make_source("t"))


def test_empty_source_keeps_its_columns(spark, tmp_path):
    make_loader(spark, tmp_path, {"t": spark.range(0)}).load(make_source("t"))
    stored = tables.read_table(spark, f"{tmp_path}/t")
    assert "id" in stored.columns and stored.count() == 0


def test_sample_is_drawn_once(spark, tmp_path):
    source = make_source("t", catalog.SAMPLE_ONCE, sample_rows=50, sample_percent=50)
    frames = {"t": spark.range(1000)}
    assert make_loader(spark, tmp_path, frames).load(source) == (50, "PHYSICAL_SAMPLE_CREATED")
    assert make_loader(spark, tmp_path, {}, "run-2").load(source) == (50, "PHYSICAL_SAMPLE_REUSED")
    again = make_loader(spark, tmp_path, frames, "run-3", force_refresh_sample=True).load(source)
    assert again == (50, "PHYSICAL_SAMPLE_CREATED")
    assert tables.read_table(spark, f"{tmp_path}/t").select("_ingestion_run_id").distinct().collect()[0][0] == "run-3"


@pytest.mark.parametrize("percent", [0, -1, 101])
def test_sample_percent_is_checked(spark, percent):
    with pytest.raises(ValueError):
        loader.sample_rows(spark.range(10), percent, 5)


def test_file_sample_reads_only_the_chosen_files(spark, tmp_path):
    """The files that are not chosen are spoiled: opening one would fail."""
    folder = tmp_path / "f"
    spark.range(0, 4000, 1, 40).write.parquet(str(folder))
    source = spark.read.parquet(str(folder))
    drawn = loader.sample_rows(source, 25, 10_000, 7, "file")
    kept = {r[0] for r in drawn.select(F.floor(F.col("id") / 100)).distinct().collect()}
    assert 0 < len(kept) < 40 and drawn.count() == 100 * len(kept)
    for number, path in enumerate(sorted(folder.glob("part-*.parquet"))):
        if number not in kept:
            path.write_bytes(b"x" * path.stat().st_size)
    assert drawn.count() == 100 * len(kept)
    once = make_source("f", catalog.SAMPLE_ONCE, sample_rows=50, sample_percent=25, sample_unit="file", sample_seed=7)
    assert make_loader(spark, tmp_path / "lake", {"f": source}).load(once) == (50, "PHYSICAL_SAMPLE_CREATED")
    with pytest.raises(Exception):
        source.agg(F.sum("id")).collect()


def test_unknown_mode_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="unknown load mode"):
        make_loader(spark, tmp_path, {}).load(make_source("t", "stream"))


def test_one_failure_does_not_stop_the_others(spark, tmp_path):
    run = make_loader(spark, tmp_path / "b", {"good": spark.range(4)}, audit_path=str(tmp_path / "audit"))
    sources = [make_source("bad"), make_source("good")]
    with pytest.raises(loader.LoadFailure, match="1 table.s. failed: bad"):
        run.run(sources)
    audit = {r.destination_table: r for r in spark.read.parquet(str(tmp_path / "audit")).collect()}
    assert audit["good"].status == "SUCCESS" and audit["good"].rows_processed == 4
    assert audit["bad"].status == "FAILED" and "bad" in audit["bad"].error_message
    assert run.run(sources, only={"good"}).count() == 1


def test_export_holds_one_run_and_can_be_repeated(spark, tmp_path):
    frames = {"t": spark.range(5)}
    for run_id in ("a", "b"):
        make_loader(spark, tmp_path / "lake", frames, run_id, export_root=str(tmp_path / "x")).load(make_source("t"))
    make_loader(spark, tmp_path / "lake", frames, "b", export_root=str(tmp_path / "x")).load(make_source("t"))
    folder = tmp_path / "x" / "t" / "ingestion_date=2024-05-01"
    assert {p.name for p in folder.iterdir() if p.is_dir()} == {"run_id=a", "run_id=b"}
    assert spark.read.parquet(str(tmp_path / "x" / "t")).count() == 10


def test_clustered_write_prunes_partitions(spark, tmp_path):
    df = spark.range(1000).withColumn("day", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 5).cast("int")))
    tables.write_clustered(df, str(tmp_path / "c"), ["id"], ["day"])
    week = tables.read_table(spark, str(tmp_path / "c")).where("day = '2024-01-02' and id < 50")
    plan = week._jdf.queryExecution().toString()
    assert week.count() == 10 and "PartitionFilters: [isnotnull(day" in plan and "PushedFilters: [IsNotNull(id)" in plan


def test_preflight(spark):
    frames = {"a": spark.range(2), "b": spark.range(1)}
    found = catalog.preflight([make_source("a"), make_source("b")], lambda s: frames[s["source_table"]])
    assert {r.name for r in found.collect()} == {"a", "b"}


class Session:
    """The parts of a session that the work folder asks for."""

    def __init__(self, master, folder=None):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = SimpleNamespace(master=master)


def test_work_folder_follows_the_session(spark):
    assert work_folder(Session("spark://x", "/shared/place/"), "x").startswith("/shared/place/x-")
    assert work_folder(spark, "x") != work_folder(spark, "x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_folder(Session("spark://x"), "x")


def test_clustered_write_splits_a_hot_value(spark, tmp_path):
    df = spark.range(20000).withColumn("place", F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables.write_clustered(df, str(tmp_path / "h"), ["place"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    stored = tables.read_table(spark, str(tmp_path / "h"))
    files = stored.where("place = 'hot'").groupBy(F.input_file_name()).count().collect()
    assert stored.count() == 20000 and len(files) > 1


def test_a_run_repeated_after_midnight_replaces_itself(spark, tmp_path):
    from datetime import datetime, timezone

    frames = {"t": spark.range(10).withColumnRenamed("id", "k")}
    for moment in (datetime(2025, 1, 1, 23, 59, tzinfo=timezone.utc), datetime(2025, 1, 2, 0, 1, tzinfo=timezone.utc)):
        again = make_loader(spark, tmp_path / "lake", frames, "run-1")
        again.clock, again.export_root = lambda moment=moment: moment, str(tmp_path / "out")
        assert again.load(make_source("t"))[0] == 10
    assert spark.read.parquet(f"{tmp_path}/lake/t").count() == 10
    assert spark.read.parquet(f"{tmp_path}/out/t").count() == 10


def test_sampled_rows_come_from_the_whole_draw(spark):
    from indicator_lake.sources.loader import sample_rows

    rows = [r.id for r in sample_rows(spark.range(0, 100_000, 1, 20), 5, 300, 1).collect()]
    assert len(rows) == 300 and {r // 10_000 for r in rows} == set(range(10))


def test_a_sample_without_sizes_is_refused(spark, tmp_path):
    loader = make_loader(spark, tmp_path, {"t": spark.range(5)})
    with pytest.raises(ValueError, match="sample_rows"):
        loader.load(make_source("t", catalog.SAMPLE_ONCE))
