"""Written tables that cut lineage, and components of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicator_lake.session import work_folder


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table once to the shared work folder and read it back, so that lost executors cost no recomputing."""
    spark = df.sparkSession
    path = work_folder(spark, f"llm-{label}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def one_of(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    return spark.read.parquet(path).select(*columns)


def unused(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that df does not have, in either case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def quoted(name: str) -> str:
    """A column name as it stands in an expression, dots and all."""
    return "`" + name.replace("`", "``") + "`"


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """(node, component): the smallest node reachable over undirected links (a, b), for every node with a link.

    Large-star and small-star rounds: every round points neighbours at smaller nodes until nothing changes; the
    number of rounds grows with the logarithm of the longest chain. Each round is a written table. A node with very
    many links is only ever reduced by min() before the shuffle and split by the skew join.
    """
    pairs = stored(
        links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), label
    )
    state = None
    while True:
        both = pairs.union(pairs.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large star: neighbours above u point at the least node next to u
        large = both.join(least, "u").where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()
        # small star: u and its smaller neighbours point at the least of them
        down = large.select(F.col("b").alias("u"), F.col("a").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            down.join(least, "u")
            .select("m", F.explode(F.array("u", "v")).alias("v"))
            .where("v > m")
            .select(F.col("m").alias("a"), F.col("v").alias("b"))
            .distinct()
        )
        pairs = stored(small, label)
        seen = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == state:
            break
        state = seen
    return pairs.select(F.col("b").alias("node"), F.col("a").alias("component")).union(
        pairs.select("a", "a").distinct().toDF("node", "component")
    )
