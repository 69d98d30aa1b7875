"""Aggregates and projections served to dashboards."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from indicator_lake.functions.measures import BELOW_TARGET, TARGET_MET


def kpis(current: DataFrame) -> DataFrame:
    """One row of headline numbers."""
    return current.agg(
        F.count_distinct("id_municipio").alias("municipios_monitorados"),
        F.round(F.avg("taxa_alfabetizacao"), 2).alias("taxa_media_alfabetizacao"),
        F.count_if(F.col("status_meta") == TARGET_MET).alias("municipios_meta_atingida"),
        F.count_if(F.col("status_meta") == BELOW_TARGET).alias("municipios_abaixo_meta"),
        F.round(F.avg("gap_meta_pontos_percentuais"), 2).alias("gap_medio_meta"),
    )


def municipal_map(current: DataFrame) -> DataFrame:
    return current.where(F.col("taxa_alfabetizacao").isNotNull()).select(
        "id_municipio",
        "nome_municipio",
        "sigla_uf",
        "regiao",
        "taxa_alfabetizacao",
        "meta_alfabetizacao",
        "gap_meta_pontos_percentuais",
        "status_meta",
    )


def ranking_table(ranking: DataFrame) -> DataFrame:
    return ranking.select(
        "ranking_brasil",
        "ranking_uf",
        "nome_municipio",
        "sigla_uf",
        "taxa_alfabetizacao",
        "meta_alfabetizacao",
        "status_meta",
    ).orderBy("ranking_brasil")


def evolution(series: DataFrame) -> DataFrame:
    """Average rate and municipalities per year and state."""
    return (
        series.groupBy("ano", "sigla_uf")
        .agg(F.avg("taxa_alfabetizacao").alias("taxa_media"), F.count_distinct("id_municipio").alias("municipios"))
        .orderBy("ano", "sigla_uf")
    )


def top_ranked(ranking: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` of the national ranking; ties fall to grade, network and code."""
    return ranking.orderBy("ranking_brasil", "serie", "rede", "id_municipio").limit(n)


def valid_event_count(events: DataFrame) -> DataFrame:
    return events.agg(F.count("*").alias("eventos_validos"))
