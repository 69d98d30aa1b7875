"""Cleaned tables stored in buckets of (year, municipality, network), the keys on which results, targets and events meet.

Results with their targets, the nearest target of a result and the newest event of a key are then found without an
exchange of either table: the plans of ``gold`` stay as they are and read the catalog tables.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from indicator_lake.sources.buckets import quoted, write_bucketed

#: Table -> the columns its buckets are cut by.
LAYOUT = {
    "municipio_resultado": ("ano", "id_municipio", "rede"),
    "meta_municipio": ("ano_resultado", "id_municipio", "rede"),
    "eventos_indicador_tratados": ("ano", "id_municipio", "rede"),
}


def store_colocated(
    spark: SparkSession, database: str, root: str, cleaned: Mapping[str, DataFrame], number: int, writers: int = 4
) -> dict[str, DataFrame]:
    """Write the given cleaned tables as ``database.<name>``; all with the same number of buckets, so that they meet.

    ``number`` should leave a bucket of the largest table within a task's memory (some 256 MB).
    """
    unknown = sorted(cleaned.keys() - LAYOUT.keys())
    if unknown:
        raise ValueError(f"no layout is known for {', '.join(unknown)}")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)} LOCATION '{root}/catalog'")
    for name, df in cleaned.items():
        write_bucketed(df, database, name, f"{root}/{name}", LAYOUT[name], number, writers)
    return {name: spark.table(f"{quoted(database)}.{quoted(name)}") for name in cleaned}
