"""Tables in buckets: equal rows, no exchange where keys meet, hot keys served without buckets."""

import pytest
from pyspark.sql import functions as F

from indicator_lake.operators import joins, picks
from indicator_lake.plans import colocated, gold
from indicator_lake.sources import buckets, tables


@pytest.fixture()
def database(spark, tmp_path):
    name = f"b_{tmp_path.name.replace('-', '_')}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/catalog'")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield name
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    spark.sql(f"DROP DATABASE {name} CASCADE")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def results(spark, n=600):
    return spark.range(n).select(
        (2023 + F.col("id") % 3).alias("ano"),
        F.lpad((F.col("id") % 50).cast("string"), 7, "0").alias("id_municipio"),
        F.when(F.col("id") % 7 > 0, "municipal").alias("rede"),
        F.col("id").cast("string").alias("serie"),
        F.col("id").cast("double").alias("taxa_alfabetizacao"),
    )


def targets(spark, n=300):
    return spark.range(n).select(
        (2023 + F.col("id") % 3).alias("ano_resultado"),
        F.lpad((F.col("id") % 60).cast("string"), 7, "0").alias("id_municipio"),
        F.lit("municipal").alias("rede"),
        (2024 + F.col("id") % 7).alias("ano_meta"),
        F.col("id").cast("double").alias("meta_alfabetizacao"),
    )


KEYS = {"ano": "ano_resultado", "id_municipio": "id_municipio", "rede": "rede"}


def nearest(left, right):
    rows = joins.with_targets(left, right, KEYS, ("ano_meta", "meta_alfabetizacao"))
    order = [F.abs(F.col("ano_meta") - F.col("ano")), F.col("ano_meta"), F.col("meta_alfabetizacao")]
    return picks.first_per_key(rows, ["ano", "id_municipio", "rede", "serie"], order)


def test_join_and_pick_on_the_keys_need_no_exchange(spark, database, tmp_path):
    plain = {"municipio_resultado": results(spark), "meta_municipio": targets(spark)}
    stored = colocated.store_colocated(spark, database, str(tmp_path), plain, 4, writers=3)
    found, wanted = nearest(*stored.values()), nearest(*plain.values())
    assert "Exchange" in plan(wanted) and "Exchange" not in plan(found)
    assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))


def test_newest_event_of_a_key_needs_no_exchange(spark, database, tmp_path):
    moment = F.timestamp_seconds(F.col("taxa_alfabetizacao").cast("long") % 40)
    events = results(spark).withColumns(
        {"serie": F.lit("2"), "data_evento": moment, "data_processamento": moment, "id_evento": F.col("serie")}
    )
    stored = colocated.store_colocated(spark, database, str(tmp_path), {"eventos_indicador_tratados": events}, 4)
    found = gold.latest_event(stored["eventos_indicador_tratados"])
    assert "Exchange" not in plan(found)
    assert sorted(map(str, found.collect())) == sorted(map(str, gold.latest_event(events).collect()))


def test_a_new_version_moves_the_name_and_its_layout(spark, database, tmp_path):
    path = str(tmp_path / "t")
    buckets.write_bucketed(results(spark, 10), database, "t", path, ["ano"], 3)
    assert spark.table(f"{database}.t").count() == 10
    buckets.write_bucketed(results(spark, 25), database, "t", path, ["ano"], 3)
    assert spark.table(f"{database}.t").count() == tables.read_table(spark, path).count() == 25
    wider = results(spark, 7).withColumn("extra", F.lit("it's"))
    found = buckets.write_bucketed(wider, database, "t", path, ["ano", "rede"], 5)
    assert (found.keys, found.number, found.rows) == (("ano", "rede"), 5, 7)
    assert spark.table(f"{database}.t").columns == wider.columns and spark.table(f"{database}.t").count() == 7
    assert buckets.stored_buckets(spark, path) == found


def test_a_hot_bucket_is_counted_and_served_without_buckets(spark, database, tmp_path):
    rows = results(spark, 900).withColumn("id_municipio", F.when(F.col("taxa_alfabetizacao") < 600, "0000001").otherwise(F.col("id_municipio")))
    path = str(tmp_path / "t")
    found = buckets.write_bucketed(rows, database, "t", path, ["id_municipio"], 8, writers=4)
    counts = {r[0]: r[1] for r in rows.groupBy(buckets.bucket_of(["id_municipio"], 8)).count().collect()}
    assert found.largest == max(counts.values()) >= 600 and found.rows == 900
    assert len(list((tmp_path / "t").glob("*/*_0000*.parquet"))) > 8  # the hot bucket has several writers
    key = F.col("id_municipio")
    assert "Exchange" not in plan(spark.table(f"{database}.t").groupBy(key).count())
    assert not buckets.serve_bucketed(spark, database, "t", path, hot_rows=500, hot_factor=2)
    counted = spark.table(f"{database}.t").groupBy(key).count()
    assert "Exchange" in plan(counted) and counted.agg(F.sum("count")).first()[0] == 900


def test_empty_table_and_null_keys(spark, database, tmp_path):
    buckets.write_bucketed(results(spark, 0), database, "e", str(tmp_path / "e"), ["ano", "rede"], 4)
    assert spark.table(f"{database}.e").count() == 0
    nulls = results(spark, 20).withColumn("rede", F.lit(None).cast("string"))
    buckets.write_bucketed(nulls, database, "n", str(tmp_path / "n"), ["rede"], 4)
    assert spark.table(f"{database}.n").where("rede is null").count() == 20


def test_wrong_layouts_are_refused(spark, database, tmp_path):
    with pytest.raises(ValueError, match="nope"):
        buckets.write_bucketed(results(spark, 3), database, "t", str(tmp_path / "t"), ["nope"], 4)
    with pytest.raises(ValueError, match="at least 1"):
        buckets.write_bucketed(results(spark, 3), database, "t", str(tmp_path / "t"), ["ano"], 0)
    with pytest.raises(ValueError, match="nobody"):
        colocated.store_colocated(spark, database, str(tmp_path), {"nobody": results(spark, 3)}, 4)
    with pytest.raises(ValueError, match="not written in buckets"):
        buckets.serve_bucketed(spark, database, "t", str(tmp_path / "t"))
