"""The load command: what it stores, and its exit codes."""

import json

import pytest

from indicator_lake import load
from indicator_lake.sources import tables


@pytest.fixture()
def place(spark, tmp_path):
    for name, n in (("one", 3), ("two", 5)):
        spark.range(n).write.parquet(f"{tmp_path}/landing/p/d/{name}")
    catalog = {
        "source_project": "p",
        "source_dataset": "d",
        "sources": [{"name": n, "source_table": n, "destination_table": f"t_{n}"} for n in ("one", "two", "absent")],
    }
    (tmp_path / "catalog.json").write_text(json.dumps(catalog))
    return tmp_path


def asked(place, *more):
    return load.arguments(["--landing", f"{place}/landing", "--bronze", f"{place}/bronze", "--config", f"{place}/catalog.json", *more])


def test_only_the_named_sources_are_loaded(spark, place, capsys):
    for _ in range(2):
        assert load.run(spark, asked(place, "--only", "two", "--run-id", "r1", "--export", f"{place}/export")) == 0
    assert tables.read_table(spark, f"{place}/bronze/t_two").count() == 5
    assert spark.read.parquet(f"{place}/export/t_two").count() == 5
    assert tables.read_if_present(spark, f"{place}/bronze/t_one") is None
    assert "t_two: 5 rows" in capsys.readouterr().out


def test_a_failure_is_told_after_the_other_tables_were_loaded(spark, place):
    assert load.run(spark, asked(place)) == 1
    assert tables.read_table(spark, f"{place}/bronze/t_one").count() == 3
    audit = {r.destination_table: r.status for r in tables.read_table(spark, f"{place}/bronze/_audit/runs").collect()}
    assert audit == {"t_one": "SUCCESS", "t_two": "SUCCESS", "t_absent": "FAILED"}


def test_check_loads_nothing(spark, place, capsys):
    assert load.run(spark, asked(place, "--check", "--only", "one", "two")) == 0
    assert load.run(spark, asked(place, "--check")) == 1
    assert "absent: not readable" in capsys.readouterr().out
    assert not (place / "bronze").exists()


def test_unknown_names_are_refused(spark, place):
    assert load.run(spark, asked(place, "--only", "three")) == 2
    with pytest.raises(SystemExit):
        load.arguments(["--landing", "x"])
