"""Scans that skip: Bloom filters for single values, interleaved order for filters on any of several columns."""

import pytest
from pyspark.sql import functions as F

from indicator_lake.sources import clustering, tables


def scanned(spark, df):
    """Rows that the scan below ``df`` hands on, filters of the query not yet applied."""
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        execution = df._jdf.queryExecution()
        rows = execution.executedPlan().executeCollectPublic().__len__()
        scan = execution.executedPlan().collectLeaves().head()
        return rows, scan.metrics().apply("numOutputRows").value()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def keyed(spark, n=40_000):
    """Ids in no order, so that min and max of every file enclose nearly all of them."""
    return spark.range(0, n, 1, 8).select(F.sha2(F.col("id").cast("string"), 256).alias("id_evento"), "id")


def test_look_up_columns_skip_row_groups(spark, tmp_path):
    rows, wanted = keyed(spark), keyed(spark).where("id = 777").first().id_evento
    tables.stage(rows, str(tmp_path / "plain")).publish()
    tables.stage(rows, str(tmp_path / "bloom"), look_up=["id_evento"]).publish()
    found = {}
    for name in ("plain", "bloom"):
        found[name] = scanned(spark, tables.read_table(spark, str(tmp_path / name)).where(F.col("id_evento") == wanted))
    assert found["plain"][0] == found["bloom"][0] == 1
    assert found["plain"][1] == 40_000 and found["bloom"][1] <= 10_000


def test_interleaved_order_prunes_by_each_column(spark, tmp_path):
    grid = spark.range(0, 40_000, 1, 4).select(
        F.lpad((F.col("id") % 200).cast("string"), 7, "0").alias("code"), F.floor(F.col("id") / 200).alias("day")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        tables.stage(grid, str(tmp_path / "z"), ["code", "day"], interleave=True).publish()
        tables.stage(grid, str(tmp_path / "first"), ["code", "day"]).publish()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    z, first = (tables.read_table(spark, str(tmp_path / name)) for name in ("z", "first"))
    rows, by_day = scanned(spark, z.where("day = 17"))
    assert rows == 200 and by_day <= 20_000
    assert scanned(spark, z.where("code = '0000017'"))[1] <= 20_000
    assert scanned(spark, first.where("day = 17"))[1] == 40_000
    assert sorted(z.collect()) == sorted(first.collect()) == sorted(grid.collect())


def test_interleaved_numbers_by_brute_force(spark):
    rows = spark.range(64).select((F.col("id") % 8).alias("a"), F.floor(F.col("id") / 8).alias("b"))
    got = {(r.a, r.b): r.z for r in rows.withColumn("z", clustering.interleaved(rows, ["a", "b"], 3)).collect()}

    def expected(a, b):
        # the cut at share i / 8 is the smallest value that i / 8 of the rows do not exceed: i - 1
        ranks = [sum(cut <= v for cut in range(7)) for v in (a, b)]
        return sum(((ranks[j] >> bit) & 1) << (2 * bit + 1 - j) for bit in range(3) for j in range(2))

    assert got == {(a, b): expected(a, b) for a in range(8) for b in range(8)}


def test_nulls_empty_tables_and_kinds(spark, tmp_path):
    rows = spark.createDataFrame(
        [(None, None, None, None), ("á", 1.5, True, None), ("", float("nan"), False, None)], "t string, x double, f boolean, d date"
    )
    z = rows.withColumn("z", clustering.interleaved(rows, ["t", "x", "f", "d"]))
    assert z.where("z is null").count() == 0 and z.where("t is null").first().z == 0
    for name, df in {"rows": rows, "none": rows.limit(0)}.items():
        tables.stage(df, str(tmp_path / name), ["t", "d"], look_up=["t"], interleave=True).publish()
        assert tables.read_table(spark, str(tmp_path / name)).count() == df.count()
    with pytest.raises(ValueError, match="62 bits"):
        clustering.interleaved(rows, ["t", "x"], 32)
    nested = spark.range(2).select(F.array("id").alias("a"))
    with pytest.raises(ValueError, match="no order"):
        clustering.ordinal(nested, "a")
