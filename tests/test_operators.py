import random

import pytest
from pyspark.sql import Window as W, functions as F

from indicator_lake.operators import joins, picks, reshape
from indicator_lake.operators.ranking import _banded, two_level_dense_rank


def test_latest_run_drops_older_runs_and_prunes_partitions(spark, tmp_path):
    rows = [("r1", "2024-01-01", 1), ("r2", "2024-02-01", 2), ("r3", None, 3)]
    df = spark.createDataFrame(rows, "_ingestion_run_id string, t string, v int")
    df = df.withColumn("_ingested_at", F.col("t").cast("timestamp")).drop("t")
    assert [r.v for r in picks.latest_run(df).collect()] == [2]
    path = str(tmp_path / "runs")
    df.write.partitionBy("_ingestion_run_id").parquet(path)
    plan = picks.latest_run(spark.read.parquet(path))._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(_ingestion_run_id" in plan


def test_keep_latest_is_total_and_limits_before_the_shuffle(spark):
    rows = [("k", 1, "b"), ("k", 2, "c"), ("k", 2, "a"), ("z", None, "q")]
    df = spark.createDataFrame(rows, "key string, t int, v string")
    kept = picks.keep_latest(df, ["key"], ["t"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert {(r.key, r.t, r.v) for r in kept.collect()} == {("k", 2, "a"), ("z", None, "q")}


def test_unpivot_drops_missing_targets(spark):
    df = spark.createDataFrame([("m", 1.0, None), ("n", None, None)], "id string, meta_2024 double, meta_2025 double")
    got = reshape.unpivot_targets(df, ["id"], years=(2024, 2025)).collect()
    assert [(r.id, r.ano_meta, r.meta_alfabetizacao) for r in got] == [("m", 2024, 1.0)]


def test_union_aligned_fills_typed_nulls_and_refuses_unknown_columns(spark):
    a = spark.createDataFrame([(1, 2.0)], "x int, y double")
    b = spark.createDataFrame([(3,)], "x int")
    both = reshape.union_aligned(a, b)
    assert dict(both.dtypes)["y"] == "double" and both.where("y is null").count() == 1
    with pytest.raises(ValueError):
        reshape.union_aligned(b, a)


def test_target_of_year_takes_the_latest_result_year(spark):
    rows = [(2024, 2026, "m", "r", 50.0), (2025, 2026, "m", "r", 60.0)]
    df = spark.createDataFrame(rows, "ano_resultado int, ano_meta int, id_municipio string, rede string, meta double")
    assert [r.meta for r in joins.target_of_year(df).collect()] == [60.0]


def test_orphans_keep_rows_with_null_key(spark):
    rows = spark.createDataFrame([("a",), ("b",), (None,)], "id_municipio string")
    parents = spark.createDataFrame([("a",)], "id_municipio string")
    assert {r[0] for r in joins.orphans(rows, parents).collect()} == {"b", None}


@pytest.mark.parametrize("bands", [1, 7, 512])
def test_banded_dense_rank_equals_the_plain_window(spark, bands):
    """Hot values, NULL groups and negative values; one group holds most rows."""
    source = random.Random(3)
    rows = []
    for i in range(3000):
        group = None if i % 50 == 0 else "hot" if i % 3 else source.choice("ab")
        value = 100.0 if i % 3 == 1 else round(source.uniform(-5, 120), 1)
        rows.append((i, group, source.choice(["x", "y", None]), value))
    df = spark.createDataFrame(rows, "id int, g string, s string, v double").repartition(4)
    ours = two_level_dense_rank(df, "v", ["g"], ["s"], "outer_rank", "inner_rank", bands=bands)
    by_value = F.col("v").desc()
    plain = df.withColumns(
        {
            "outer_rank": F.dense_rank().over(W.partitionBy("g").orderBy(by_value)),
            "inner_rank": F.dense_rank().over(W.partitionBy("s", "g").orderBy(by_value)),
        }
    )
    expected = {r["id"]: tuple(r) for r in plain.collect()}
    assert {r["id"]: tuple(r) for r in ours.select(plain.columns).collect()} == expected
    assert ours.count() == len(rows)


def test_bands_follow_the_values(spark):
    """Values far from any usual range, crowded at one end, still fill the bands evenly."""
    values = spark.range(8000).select(F.lit("g").alias("g"), F.exp(F.col("id") / 500).alias("v"))
    sizes = [r["count"] for r in _banded(values, ["g"], "v", 16).groupBy("_band").count().collect()]
    assert sum(sizes) == 8000 and max(sizes) < 2 * 8000 / 16


def test_rows_are_sorted_by_text_keys_before_years(spark):
    """A sort compares the first key by eight bytes; a year would leave whole rows to be compared."""
    rows = spark.createDataFrame([(2024, "b", 1), (2024, "a", 2), (2024, "a", 3), (2023, "a", 4), (2024, None, 5)], "ano int, id string, n int")
    picked = picks.first_per_key(rows, ["ano", "id"], [F.col("n").desc()])
    assert "windowspecdefinition(id#" in picked._jdf.queryExecution().optimizedPlan().toString()
    assert picked.columns == rows.columns
    assert {tuple(r) for r in picked.collect()} == {(2024, "b", 1), (2024, "a", 3), (2023, "a", 4), (2024, None, 5)}


def test_the_newest_run_is_found_among_one_row_per_run(spark):
    rows = spark.sql(
        "SELECT id, concat('run-', id % 3) AS _ingestion_run_id, "
        "CASE WHEN id % 3 < 2 THEN timestamp '2024-01-01' END AS _ingested_at FROM range(9)"
    )
    found = picks.latest_run(rows)
    assert "Aggregate [_ingestion_run_id#" in found._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r.id for r in found.collect()) == [1, 4, 7]  # equal stamps: the larger id; no stamp: never
