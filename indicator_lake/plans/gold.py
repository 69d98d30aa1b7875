"""Indicators: results against targets, current status, series, ranking and model features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from indicator_lake.functions.measures import (
    BATCH_SOURCE,
    PRESENT_TOKENS,
    STREAM_SOURCE,
    gap,
    safe_percent,
    source_priority,
    target_distance,
    target_status,
    target_status_unguarded,
    weighted_share,
)
from indicator_lake.operators.joins import left_lookup, target_of_year, with_targets, with_territory
from indicator_lake.operators.picks import first_per_key
from indicator_lake.operators.ranking import two_level_dense_rank
from indicator_lake.operators.reshape import union_aligned
from indicator_lake.plans.silver import LEVEL_SHARES

TERRITORY = ("nome_municipio", "sigla_uf", "nome_uf", "regiao")
# The year of the final target and the first target year.
FINAL_TARGET_YEAR = 2030
FIRST_TARGET_YEAR = 2024
# Column order shared by the batch and the streamed branch.
INDICATOR_COLUMNS = (
    "ano_resultado", "ano_meta", "id_municipio", *TERRITORY, "serie", "rede",
    "taxa_alfabetizacao", "media_portugues", "meta_alfabetizacao", "nivel_alfabetizacao",
    "percentual_participacao", *LEVEL_SHARES, "origem_dado", "atualizado_em",
)


def _generated(df: DataFrame, generated_at: Column | None) -> DataFrame:
    return df.withColumn("_gold_generated_at", F.current_timestamp() if generated_at is None else generated_at)


def _with_status(df: DataFrame) -> DataFrame:
    rate, target = F.col("taxa_alfabetizacao"), F.col("meta_alfabetizacao")
    return df.withColumns(
        {"gap_meta_pontos_percentuais": gap(rate, target), "status_meta": target_status(rate, target)}
    )


def batch_branch(results: DataFrame, targets: DataFrame, directory: DataFrame) -> DataFrame:
    """Every result with each of its targets and its territory."""
    keys = {"ano": "ano_resultado", "id_municipio": "id_municipio", "rede": "rede"}
    take = ("ano_meta", "meta_alfabetizacao", "nivel_alfabetizacao", "percentual_participacao")
    joined = with_territory(with_targets(results, targets, keys, take), directory, TERRITORY)
    return joined.select(
        F.col("ano").alias("ano_resultado"),
        *INDICATOR_COLUMNS[1:-2],
        F.lit(BATCH_SOURCE).alias("origem_dado"),
        F.col("_processed_at").alias("atualizado_em"),
    )


def latest_event(events: DataFrame) -> DataFrame:
    """The newest event of each year, municipality, grade and network."""
    newest = [F.col("data_evento").desc(), F.col("data_processamento").desc(), F.col("id_evento").asc()]
    return first_per_key(events, ["ano", "id_municipio", "serie", "rede"], newest)


def stream_branch(events: DataFrame, targets: DataFrame, directory: DataFrame) -> DataFrame:
    """The newest event per key with its own target or else the table's target of that year.

    Events and targets are reduced to one row per key first, so the join cannot fan out.
    """
    own = F.col("meta_alfabetizacao")
    newest = latest_event(events).withColumn("_own", own).drop("meta_alfabetizacao")
    keys = {"ano": "ano_meta", "id_municipio": "id_municipio", "rede": "rede"}
    take = ("meta_alfabetizacao", "nivel_alfabetizacao", "percentual_participacao")
    with_target = left_lookup(newest, target_of_year(targets), keys, take)
    place = [c for c in TERRITORY if c != "sigla_uf"]
    return with_territory(with_target, directory, place).select(
        F.col("ano").alias("ano_resultado"),
        F.col("ano").alias("ano_meta"),
        "id_municipio",
        *TERRITORY,
        "serie",
        "rede",
        "taxa_alfabetizacao",
        F.coalesce("_own", own).alias("meta_alfabetizacao"),
        "nivel_alfabetizacao",
        "percentual_participacao",
        F.lit(STREAM_SOURCE).alias("origem_dado"),
        F.col("data_processamento").alias("atualizado_em"),
    )


def indicador_municipio(
    results: DataFrame,
    targets: DataFrame,
    directory: DataFrame,
    events: DataFrame,
    generated_at: Column | None = None,
) -> DataFrame:
    """Batch and streamed results with targets, gap and status."""
    combined = union_aligned(
        batch_branch(results, targets, directory), stream_branch(events, targets, directory)
    )
    return _generated(_with_status(combined), generated_at)


def indicador_uf(results: DataFrame, targets: DataFrame, generated_at: Column | None = None) -> DataFrame:
    """State results with each of their targets."""
    keys = {"ano": "ano_resultado", "sigla_uf": "sigla_uf", "rede": "rede"}
    take = ("ano_meta", "meta_alfabetizacao", "percentual_participacao")
    rows = _with_status(with_targets(results, targets, keys, take)).select(
        F.col("ano").alias("ano_resultado"),
        "ano_meta",
        "sigla_uf",
        "serie",
        "rede",
        "taxa_alfabetizacao",
        "media_portugues",
        "meta_alfabetizacao",
        "percentual_participacao",
        "gap_meta_pontos_percentuais",
        "status_meta",
        *LEVEL_SHARES,
    )
    return _generated(rows, generated_at)


def _freshest() -> list[Column]:
    """Streamed first, then newest, then the target nearest to the observed year."""
    return [
        source_priority(F.col("origem_dado")),
        F.col("atualizado_em").desc(),
        target_distance(F.col("ano_meta"), F.col("ano_resultado")),
        F.col("ano_meta").asc(),
    ]


def situacao_atual_municipio(indicator: DataFrame) -> DataFrame:
    """The latest measurement of each municipality, grade and network."""
    order = [F.col("ano_resultado").desc(), *_freshest()]
    return first_per_key(indicator, ["id_municipio", "serie", "rede"], order)


def evolucao_temporal(indicator: DataFrame) -> DataFrame:
    """One rate per year; a streamed value replaces the batch value of its year."""
    known = indicator.where(F.col("taxa_alfabetizacao").isNotNull())
    picked = first_per_key(known, ["ano_resultado", "id_municipio", "serie", "rede"], _freshest())
    return picked.select(
        F.col("ano_resultado").alias("ano"),
        "id_municipio",
        "nome_municipio",
        "sigla_uf",
        "regiao",
        "serie",
        "rede",
        "taxa_alfabetizacao",
        "origem_dado",
        "atualizado_em",
    )


def ranking_municipios(current: DataFrame) -> DataFrame:
    """National and state dense rank of the current rates."""
    known = current.where(F.col("taxa_alfabetizacao").isNotNull())
    return two_level_dense_rank(
        known, "taxa_alfabetizacao", ["serie", "rede"], ["sigla_uf"], "ranking_brasil", "ranking_uf"
    )


def resumo_brasil(targets: DataFrame, generated_at: Column | None = None) -> DataFrame:
    """National rate against each target; a missing rate counts as below target."""
    rate, target = F.col("taxa_alfabetizacao_base"), F.col("meta_alfabetizacao")
    rows = targets.select(
        "ano_resultado",
        "ano_meta",
        "rede",
        rate.alias("taxa_alfabetizacao"),
        "meta_alfabetizacao",
        gap(rate, target).alias("gap_meta_pontos_percentuais"),
        "percentual_participacao",
        target_status_unguarded(rate, target).alias("status_meta"),
    )
    return _generated(rows, generated_at)


FEATURE_KEYS = ("ano", "id_municipio", "rede")


def student_features(students: DataFrame) -> DataFrame:
    flag = F.col("alfabetizado_flag")
    return students.groupBy(*FEATURE_KEYS).agg(
        F.count("*").alias("quantidade_alunos"),
        F.count_if(F.col("presenca").isin(*PRESENT_TOKENS)).alias("alunos_presentes"),
        F.avg("proficiencia").alias("proficiencia_media"),
        F.stddev_pop("proficiencia").alias("proficiencia_desvio_padrao"),
        safe_percent(F.count_if(flag), F.count_if(flag.isNotNull())).alias("percentual_alfabetizados_microdados"),
        weighted_share(flag, F.col("peso_aluno")).alias("percentual_alfabetizados_ponderado"),
    )


def result_features(results: DataFrame) -> DataFrame:
    return results.groupBy(*FEATURE_KEYS).agg(
        F.max("taxa_alfabetizacao").alias("target_taxa_alfabetizacao"),
        F.max("media_portugues").alias("media_portugues"),
    )


def target_features(targets: DataFrame, final: int = FINAL_TARGET_YEAR, first: int = FIRST_TARGET_YEAR) -> DataFrame:
    """``primeira_meta`` is the smallest target value from the first target year on."""
    year, target = F.col("ano_meta"), F.col("meta_alfabetizacao")
    return (
        targets.withColumnRenamed("ano_resultado", "ano")
        .groupBy(*FEATURE_KEYS)
        .agg(
            F.max(F.when(year == final, target)).alias("meta_2030"),
            F.min(F.when(year >= first, target)).alias("primeira_meta"),
            F.max("nivel_alfabetizacao").alias("nivel_alfabetizacao"),
            F.max("percentual_participacao").alias("percentual_participacao"),
        )
    )


def features_ml(
    students: DataFrame,
    results: DataFrame,
    targets: DataFrame,
    directory: DataFrame,
    generated_at: Column | None = None,
) -> DataFrame:
    """One feature row per year, municipality and network that has students.

    Each input is aggregated to the join key before the joins, so the joins are 1:1 and reuse
    the partitioning of the aggregates.
    """
    keys = {k: k for k in FEATURE_KEYS}
    rows = left_lookup(
        student_features(students),
        result_features(results),
        keys,
        ("target_taxa_alfabetizacao", "media_portugues"),
    )
    rows = left_lookup(
        rows,
        target_features(targets),
        keys,
        ("primeira_meta", "meta_2030", "nivel_alfabetizacao", "percentual_participacao"),
    )
    rows = with_territory(rows, directory, TERRITORY).select(
        "ano",
        "id_municipio",
        *TERRITORY,
        "rede",
        "quantidade_alunos",
        "alunos_presentes",
        safe_percent(F.col("alunos_presentes"), F.col("quantidade_alunos")).alias("taxa_presenca"),
        "proficiencia_media",
        "proficiencia_desvio_padrao",
        "percentual_alfabetizados_microdados",
        "percentual_alfabetizados_ponderado",
        "target_taxa_alfabetizacao",
        "media_portugues",
        "primeira_meta",
        "meta_2030",
        "nivel_alfabetizacao",
        "percentual_participacao",
        gap(F.col("target_taxa_alfabetizacao"), F.col("meta_2030")).alias("gap_meta_2030"),
    )
    return _generated(rows, generated_at)
