"""Cleaned tables: typed, normalised, one row per key, from the latest run of each source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from indicator_lake.functions.normalise import (
    code,
    lower_label,
    safe_double,
    safe_long,
    safe_text,
    safe_timestamp,
    trim_ws,
    tristate_flag,
    upper_label,
)
from indicator_lake.operators.picks import INGESTED_AT, RUN_ID, keep_latest, latest_run
from indicator_lake.operators.reshape import TARGET_YEARS, unpivot_targets

# The share columns of levels 0 to 8.
LEVEL_SHARES = tuple(f"proporcao_aluno_nivel_{level}" for level in range(9))


def _stamped(df: DataFrame, processed_at: Column | None) -> DataFrame:
    return df.withColumn("_processed_at", F.current_timestamp() if processed_at is None else processed_at)


def dim_municipio(bronze: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Municipality directory, key ``id_municipio``."""
    run = latest_run(bronze)
    clean = run.select(
        code(run, "id_municipio").alias("id_municipio"),
        trim_ws(safe_text(run, "nome")).alias("nome_municipio"),
        upper_label(run, "sigla_uf").alias("sigla_uf"),
        *[safe_text(run, c).alias(c) for c in ("nome_uf", "regiao", "id_microrregiao", "id_mesorregiao")],
        INGESTED_AT,
    )
    return _stamped(keep_latest(clean, ["id_municipio"]).drop(INGESTED_AT), processed_at)


def _results(bronze: DataFrame, place: str, place_value, processed_at: Column | None) -> DataFrame:
    run = latest_run(bronze)
    clean = run.select(
        safe_long(run, "ano").alias("ano"),
        place_value(run, place).alias(place),
        lower_label(run, "serie").alias("serie"),
        lower_label(run, "rede").alias("rede"),
        *[safe_double(run, c).alias(c) for c in ("taxa_alfabetizacao", "media_portugues", *LEVEL_SHARES)],
        INGESTED_AT,
        RUN_ID,
    )
    return _stamped(keep_latest(clean, ["ano", place, "serie", "rede"]), processed_at)


def municipio_resultado(bronze: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Municipal results, key ``ano, id_municipio, serie, rede``."""
    return _results(bronze, "id_municipio", code, processed_at)


def uf_resultado(bronze: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """State results, key ``ano, sigla_uf, serie, rede``."""
    return _results(bronze, "sigla_uf", upper_label, processed_at)


def _targets(
    bronze: DataFrame,
    places: dict[str, object],
    extra: Sequence[str],
    processed_at: Column | None,
    years: Sequence[int] = TARGET_YEARS,
) -> DataFrame:
    run = latest_run(bronze)
    ids = ["ano_resultado", *places, "rede", "taxa_alfabetizacao_base", *extra, "percentual_participacao"]
    ids += [INGESTED_AT, RUN_ID]
    wide = run.select(
        safe_long(run, "ano").alias("ano_resultado"),
        *[value(run, name).alias(name) for name, value in places.items()],
        lower_label(run, "rede").alias("rede"),
        safe_double(run, "taxa_alfabetizacao").alias("taxa_alfabetizacao_base"),
        *[safe_long(run, name).alias(name) for name in extra],
        safe_double(run, "percentual_participacao").alias("percentual_participacao"),
        INGESTED_AT,
        RUN_ID,
        *[safe_double(run, f"meta_alfabetizacao_{y}").alias(f"meta_{y}") for y in years],
    )
    keys = ["ano_resultado", "ano_meta", *places, "rede"]
    values = ["taxa_alfabetizacao_base", "meta_alfabetizacao", *extra, "percentual_participacao"]
    long = unpivot_targets(wide, ids, years=years).select(*keys, *values, INGESTED_AT, RUN_ID)
    return _stamped(keep_latest(long, keys), processed_at)


def meta_brasil(bronze: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """National targets, key ``ano_resultado, ano_meta, rede``."""
    return _targets(bronze, {}, (), processed_at)


def meta_uf(bronze: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """State targets, key ``ano_resultado, ano_meta, sigla_uf, rede``."""
    return _targets(bronze, {"sigla_uf": upper_label}, (), processed_at)


def meta_municipio(bronze: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Municipal targets, key ``ano_resultado, ano_meta, id_municipio, rede``."""
    return _targets(bronze, {"id_municipio": code}, ("nivel_alfabetizacao",), processed_at)


def alunos_tratados(bronze: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Students, key ``ano, id_aluno``."""
    run = latest_run(bronze)
    labels = ("serie", "rede", "presenca", "preenchimento_caderno", "alfabetizado")
    clean = run.select(
        safe_long(run, "ano").alias("ano"),
        code(run, "id_municipio").alias("id_municipio"),
        *[safe_text(run, c).alias(c) for c in ("id_escola", "id_aluno", "caderno")],
        *[lower_label(run, c).alias(c) for c in labels],
        safe_double(run, "proficiencia").alias("proficiencia"),
        safe_double(run, "peso_aluno").alias("peso_aluno"),
        INGESTED_AT,
        RUN_ID,
    )
    unique = keep_latest(clean, ["ano", "id_aluno"])
    flagged = unique.withColumn("alfabetizado_flag", tristate_flag(F.col("alfabetizado")))
    order = [*clean.columns[:-4], "alfabetizado_flag", *clean.columns[-4:]]
    return _stamped(flagged.select(*order), processed_at)


def eventos_indicador_tratados(events: DataFrame) -> DataFrame:
    """Valid events of the whole log, key ``id_evento``; the newest processing wins."""
    clean = events.select(
        safe_text(events, "id_evento").alias("id_evento"),
        code(events, "id_municipio").alias("id_municipio"),
        upper_label(events, "sigla_uf").alias("sigla_uf"),
        safe_long(events, "ano").alias("ano"),
        lower_label(events, "rede").alias("rede"),
        lower_label(events, "serie").alias("serie"),
        safe_double(events, "taxa_alfabetizacao").alias("taxa_alfabetizacao"),
        safe_double(events, "meta_alfabetizacao").alias("meta_alfabetizacao"),
        safe_text(events, "tipo_evento").alias("tipo_evento"),
        safe_text(events, "fonte").alias("fonte"),
        safe_timestamp(events, "data_evento").alias("data_evento"),
        safe_timestamp(events, "data_processamento").alias("data_processamento"),
        safe_text(events, "pubsub_message_id").alias("pubsub_message_id"),
    )
    return keep_latest(clean, ["id_evento"], ["data_processamento"])
