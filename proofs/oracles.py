"""DuckDB SQL with the expected result of each query, written independently of the package."""

from __future__ import annotations

import re

from proofs.inputs import AS_OF, INPUTS, PROCESSED_AT, TABLES, duckdb_text

BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
YEARS = range(2024, 2031)
# The states and the federal district by region.
STATE_CODES = (
    "AC AM AP PA RO RR TO " "AL BA CE MA PB PE PI RN SE " "DF GO MS MT " "ES MG RJ SP " "PR RS SC"
).split()
SHARES = [f"proporcao_aluno_nivel_{k}" for k in range(9)]
FMT = "'%Y-%m-%d %H:%M:%S.%f'"


def _lower(c: str) -> str:
    return f"lower(trim({c}, {BLANK}))"


def _upper(c: str) -> str:
    return f"upper(trim({c}, {BLANK}))"


def _double(c: str) -> str:
    return f"try_cast({c} AS double)"


def _code(c: str) -> str:
    return f"lpad({c}, 7, '0')"


def _newest(table: str) -> str:
    return (
        f"FROM {table} WHERE _ingestion_run_id = "
        f"(SELECT _ingestion_run_id FROM {table} ORDER BY _ingested_at DESC NULLS LAST LIMIT 1)"
    )


def _first(source: str, keys: str, order: str) -> str:
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn "
        f"FROM {source}) WHERE rn = 1"
    )


def _names(*names: str) -> str:
    return ", ".join(names)


def _results(table: str, place: str, value: str) -> str:
    typed = ", ".join(f"{_double(c)} AS {c}" for c in ("taxa_alfabetizacao", "media_portugues", *SHARES))
    clean = (
        f"(SELECT try_cast(ano AS bigint) AS ano, {value} AS {place}, {_lower('serie')} AS serie, "
        f"{_lower('rede')} AS rede, {typed}, _ingested_at {_newest(table)})"
    )
    return _first(clean, f"ano, {place}, serie, rede", "_ingested_at DESC")


def _targets(table: str, place: str, value: str, level: str) -> str:
    aims = ", ".join(f"{{'year': cast({y} AS bigint), 'value': {_double(f'meta_alfabetizacao_{y}')}}}" for y in YEARS)
    each = f"(SELECT *, unnest([{aims}]) AS aim {_newest(table)})"
    long = (
        f"(SELECT try_cast(ano AS bigint) AS ano_resultado, aim.year AS ano_meta, {value} AS {place}, {_lower('rede')} AS rede, "
        f"aim.value AS meta_alfabetizacao, {_double('taxa_alfabetizacao')} AS taxa_alfabetizacao_base, "
        f"{level} AS nivel_alfabetizacao, {_double('percentual_participacao')} AS percentual_participacao, _ingested_at "
        f"FROM {each} WHERE aim.value IS NOT NULL)"
    )
    return _first(long, f"ano_resultado, ano_meta, {place}, rede", "_ingested_at DESC")


def _status(rate: str, target: str, guard: bool = True) -> str:
    first = f"WHEN {rate} IS NULL OR {target} IS NULL THEN 'SEM_COMPARACAO' " if guard else ""
    return (
        f"CASE {first}WHEN {rate} >= {target} THEN 'META_ATINGIDA' "
        f"WHEN {rate} >= {target} - 5 THEN 'PROXIMO_DA_META' ELSE 'ABAIXO_DA_META' END"
    )


def _field(name: str) -> str:
    """Text of a field whose JSON type is text."""
    return f"CASE WHEN json_type(b, '$.{name}') = 'VARCHAR' THEN json_extract_string(b, '$.{name}') END"


def _number(name: str) -> str:
    kinds = "('BIGINT', 'UBIGINT', 'DOUBLE', 'VARCHAR')"
    return f"CASE WHEN json_type(b, '$.{name}') IN {kinds} THEN try_cast(json_extract_string(b, '$.{name}') AS double) END"


_FIELDS = (
    "id_evento", "id_municipio", "sigla_uf", "ano", "rede", "serie", "taxa_alfabetizacao",
    "meta_alfabetizacao", "tipo_evento", "fonte", "data_evento",
)
_KNOWN = ", ".join(f"'{f}'" for f in _FIELDS)
_STATES = ", ".join(f"'{s}'" for s in STATE_CODES)
_RULES = {
    "extra_field": f"NOT list_has_all([{_KNOWN}], json_keys(b))",
    "id_evento": "coalesce(length(id_evento), 0) < 1",
    "id_municipio": "NOT coalesce(regexp_full_match(id_municipio, '[0-9]{7}'), false)",
    "sigla_uf": f"NOT coalesce(sigla_uf IN ({_STATES}), false)",
    "ano": "NOT coalesce(ano = floor(ano) AND ano BETWEEN 2023 AND 2035, false)",
    "rede": "coalesce(length(rede), 0) < 1",
    "serie": "coalesce(length(serie), 0) < 1",
    "taxa_alfabetizacao": "NOT coalesce(taxa BETWEEN 0 AND 100, false)",
    "meta_alfabetizacao": "coalesce(json_type(b, '$.meta_alfabetizacao'), 'NULL') <> 'NULL' "
    "AND NOT coalesce(meta BETWEEN 0 AND 100, false)",
    "tipo_evento": "coalesce(json_type(b, '$.tipo_evento') <> 'VARCHAR', false)",
    "fonte": "coalesce(json_type(b, '$.fonte') <> 'VARCHAR', false)",
    "data_evento": f"coalesce(data_evento > timestamp '{AS_OF}', true)",
}
_ERRORS = ", ".join(f"CASE WHEN {rule} THEN '{name}' END" for name, rule in _RULES.items())

_LATEST = (
    "CASE WHEN origem_dado = 'STREAMING_PUBSUB' THEN 1 ELSE 2 END, atualizado_em DESC NULLS LAST, "
    "abs(coalesce(ano_meta, ano_resultado) - ano_resultado) NULLS FIRST, ano_meta NULLS FIRST"
)
_BRANCH = f"""ano_resultado, ano_meta, id_municipio, nome_municipio, sigla_uf, nome_uf, regiao, serie, rede,
  taxa_alfabetizacao, media_portugues, meta_alfabetizacao, nivel_alfabetizacao, percentual_participacao,
  {", ".join(SHARES)}, origem_dado, atualizado_em"""

VIEWS = {
    **{name: duckdb_text(name) for name in INPUTS},
    "dim": _first(
        f"(SELECT {_code('id_municipio')} AS id_municipio, trim(nome, {BLANK}) AS nome_municipio, "
        f"{_upper('sigla_uf')} AS sigla_uf, nome_uf, regiao, id_microrregiao, id_mesorregiao, _ingested_at "
        f"{_newest('b_directory')})",
        "id_municipio",
        "_ingested_at DESC",
    ),
    "results": _results("b_municipio", "id_municipio", _code("id_municipio")),
    "state_results": _results("b_uf", "sigla_uf", _upper("sigla_uf")),
    "targets": _targets("b_meta_municipio", "id_municipio", _code("id_municipio"), "try_cast(nivel_alfabetizacao AS bigint)"),
    "state_targets": _targets("b_meta_uf", "sigla_uf", _upper("sigla_uf"), "NULL"),
    "national_targets": _targets("b_meta_brasil", "pais", "'BR'", "NULL"),
    "students": _first(
        f"""(SELECT try_cast(ano AS bigint) AS ano, {_code('id_municipio')} AS id_municipio, id_escola, id_aluno, caderno,
  {_lower('serie')} AS serie, {_lower('rede')} AS rede, {_lower('presenca')} AS presenca,
  {_lower('preenchimento_caderno')} AS preenchimento_caderno, {_lower('alfabetizado')} AS alfabetizado,
  CASE WHEN {_lower('alfabetizado')} IN ('1', 'sim', 's', 'true') THEN true
       WHEN {_lower('alfabetizado')} IN ('0', 'nao', 'não', 'n', 'false') THEN false END AS alfabetizado_flag,
  {_double('proficiencia')} AS proficiencia, {_double('peso_aluno')} AS peso_aluno, _ingested_at {_newest('b_students')})""",
        "ano, id_aluno",
        "_ingested_at DESC, id_municipio NULLS FIRST, id_escola NULLS FIRST, caderno NULLS FIRST, serie NULLS FIRST, "
        "rede NULLS FIRST, presenca NULLS FIRST, preenchimento_caderno NULLS FIRST, alfabetizado NULLS FIRST, "
        "proficiencia NULLS FIRST, peso_aluno NULLS FIRST",
    ),
    "bodies": """SELECT message_id, value, CASE WHEN json_valid(value) AND json_type(
      CASE WHEN json_valid(value) THEN value ELSE 'null' END) = 'OBJECT' THEN cast(value AS json) END AS b FROM b_messages""",
    "fields": f"""SELECT message_id, value, b, {_field('id_evento')} AS id_evento, {_field('id_municipio')} AS id_municipio,
  {_upper(_field('sigla_uf'))} AS sigla_uf, {_number('ano')} AS ano, {_field('rede')} AS rede, {_field('serie')} AS serie,
  {_number('taxa_alfabetizacao')} AS taxa, {_number('meta_alfabetizacao')} AS meta,
  {_field('tipo_evento')} AS tipo_evento, {_field('fonte')} AS fonte,
  CASE WHEN json_type(b, '$.data_evento') = 'VARCHAR'
       THEN try_cast(regexp_replace(json_extract_string(b, '$.data_evento'), '[+]00:00$', '') AS timestamp)
       ELSE make_timestamp(cast(json_extract_string(b, '$.data_evento') AS bigint) * 1000000) END AS data_evento
  FROM bodies""",
    "checked": f"""SELECT *, CASE WHEN b IS NULL THEN 'json_object'
  ELSE concat_ws('; ', {_ERRORS}) END AS errors FROM fields""",
    "valid_events": f"""SELECT id_evento, id_municipio, sigla_uf, cast(ano AS bigint) AS ano, rede, serie,
  taxa AS taxa_alfabetizacao, meta AS meta_alfabetizacao, coalesce(tipo_evento, 'ATUALIZACAO_INDICADOR') AS tipo_evento,
  coalesce(fonte, 'SIMULADOR_TECH_CHALLENGE') AS fonte, data_evento, timestamp '{AS_OF}' AS data_processamento,
  message_id AS pubsub_message_id FROM checked WHERE errors = ''""",
    "clean_events": _first(
        f"""(SELECT id_evento, {_code('id_municipio')} AS id_municipio, {_upper('sigla_uf')} AS sigla_uf, ano,
  {_lower('rede')} AS rede, {_lower('serie')} AS serie, taxa_alfabetizacao, meta_alfabetizacao, tipo_evento, fonte,
  data_evento, data_processamento FROM valid_events)""",
        "id_evento",
        "data_processamento DESC",
    ),
    "newest_events": _first(
        "clean_events", "ano, id_municipio, serie, rede", "data_evento DESC, data_processamento DESC, id_evento"
    ),
    "batch_rows": f"""WITH aims AS (SELECT ano_resultado AS ano, id_municipio, rede, list(struct_pack(ano_meta, meta_alfabetizacao,
    nivel_alfabetizacao, percentual_participacao)) AS each FROM targets GROUP BY ALL),
  aimed AS (SELECT results.*, unnest(coalesce(each, [NULL])) AS aim FROM results LEFT JOIN aims USING (ano, id_municipio, rede))
  SELECT ano AS ano_resultado, aim.ano_meta, id_municipio, nome_municipio, sigla_uf, nome_uf, regiao, serie, rede,
  taxa_alfabetizacao, media_portugues, aim.meta_alfabetizacao, aim.nivel_alfabetizacao, aim.percentual_participacao,
  {", ".join(SHARES)}, 'BATCH_BASE_DOS_DADOS' AS origem_dado, timestamp '{PROCESSED_AT}' AS atualizado_em
  FROM aimed LEFT JOIN (SELECT id_municipio, nome_municipio, sigla_uf, nome_uf, regiao FROM dim) USING (id_municipio)""",
    "stream_rows": f"""WITH last_aim AS (SELECT ano_meta AS ano, id_municipio, rede, arg_max(struct_pack(aim := meta_alfabetizacao,
    nivel := nivel_alfabetizacao, part := percentual_participacao), ano_resultado) AS t FROM targets GROUP BY ALL),
  place AS (SELECT id_municipio, nome_municipio, nome_uf, regiao FROM dim)
  SELECT ano AS ano_resultado, ano AS ano_meta, id_municipio, nome_municipio, sigla_uf, nome_uf, regiao, serie, rede,
  taxa_alfabetizacao, cast(NULL AS double) AS media_portugues, coalesce(meta_alfabetizacao, t.aim) AS meta_alfabetizacao,
  t.nivel AS nivel_alfabetizacao, t.part AS percentual_participacao, {", ".join(f"cast(NULL AS double) AS {s}" for s in SHARES)},
  'STREAMING_PUBSUB' AS origem_dado, data_processamento AS atualizado_em
  FROM newest_events LEFT JOIN last_aim USING (ano, id_municipio, rede) LEFT JOIN place USING (id_municipio)""",
    "indicator": f"""SELECT *, taxa_alfabetizacao - meta_alfabetizacao AS gap_meta_pontos_percentuais,
  {_status('taxa_alfabetizacao', 'meta_alfabetizacao')} AS status_meta
  FROM (SELECT {_BRANCH} FROM batch_rows UNION ALL SELECT {_BRANCH} FROM stream_rows)""",
    "current_rows": _first("indicator", "id_municipio, serie, rede", f"ano_resultado DESC NULLS LAST, {_LATEST}"),
    "series": "SELECT ano_resultado AS ano, id_municipio, nome_municipio, sigla_uf, regiao, serie, rede, "
    "taxa_alfabetizacao, origem_dado, atualizado_em FROM ("
    + _first("(SELECT * FROM indicator WHERE taxa_alfabetizacao IS NOT NULL)", "ano_resultado, id_municipio, serie, rede", _LATEST)
    + ")",
    "ranked": """SELECT *,
  dense_rank() OVER (PARTITION BY serie, rede ORDER BY taxa_alfabetizacao DESC) AS ranking_brasil,
  dense_rank() OVER (PARTITION BY sigla_uf, serie, rede ORDER BY taxa_alfabetizacao DESC) AS ranking_uf
  FROM current_rows WHERE taxa_alfabetizacao IS NOT NULL""",
    "state_indicator": f"""WITH aims AS (SELECT ano_resultado, sigla_uf, rede, ano_meta, meta_alfabetizacao, percentual_participacao
    FROM state_targets),
  rates AS (SELECT ano AS ano_resultado, * EXCLUDE (ano) FROM state_results)
  SELECT ano_resultado, ano_meta, sigla_uf, serie, rede, taxa_alfabetizacao, media_portugues, meta_alfabetizacao,
  percentual_participacao, taxa_alfabetizacao - meta_alfabetizacao AS gap_meta_pontos_percentuais,
  {_status('taxa_alfabetizacao', 'meta_alfabetizacao')} AS status_meta, {", ".join(SHARES)}
  FROM rates LEFT JOIN aims USING (ano_resultado, sigla_uf, rede)""",
    "summary": f"""SELECT ano_resultado, ano_meta, rede, taxa_alfabetizacao_base AS taxa_alfabetizacao, meta_alfabetizacao,
  taxa_alfabetizacao_base - meta_alfabetizacao AS gap_meta_pontos_percentuais, percentual_participacao,
  {_status('taxa_alfabetizacao_base', 'meta_alfabetizacao', False)} AS status_meta FROM national_targets""",
    "student_groups": """SELECT ano, id_municipio, rede, count(*) AS quantidade_alunos,
  count(*) FILTER (list_contains(['1', 'presente', 's', 'sim', 'true'], presenca)) AS alunos_presentes,
  avg(proficiencia) AS proficiencia_media, stddev_pop(proficiencia) AS proficiencia_desvio_padrao,
  count(*) FILTER (alfabetizado_flag) AS alfabetizados, count(alfabetizado_flag) AS conhecidos,
  coalesce(sum(coalesce(peso_aluno, 1)) FILTER (alfabetizado_flag), 0)
    / nullif(sum(coalesce(peso_aluno, 1)) FILTER (alfabetizado_flag IS NOT NULL), 0) * 100
    AS percentual_alfabetizados_ponderado
  FROM students GROUP BY 1, 2, 3""",
    "extremes": """SELECT ano, id_municipio, rede, max(rate) AS best_rate, max(mark) AS best_mark,
  max(aim) FILTER (aim_year = 2030) AS final_aim, min(aim) FILTER (aim_year >= 2024) AS lowest_aim,
  max(level) AS top_level, max(part) AS top_part
  FROM (SELECT ano, id_municipio, rede, taxa_alfabetizacao AS rate, media_portugues AS mark, NULL::bigint AS aim_year,
          NULL::double AS aim, NULL::bigint AS level, NULL::double AS part FROM results
        UNION ALL SELECT ano_resultado, id_municipio, rede, NULL, NULL, ano_meta, meta_alfabetizacao, nivel_alfabetizacao,
          percentual_participacao FROM targets) GROUP BY ano, id_municipio, rede""",
    "features": """SELECT ano, id_municipio, rede, quantidade_alunos, alunos_presentes,
  alunos_presentes / cast(quantidade_alunos AS double) * 100 AS taxa_presenca, proficiencia_media, proficiencia_desvio_padrao,
  alfabetizados / nullif(cast(conhecidos AS double), 0) * 100 AS percentual_alfabetizados_microdados,
  percentual_alfabetizados_ponderado, best_rate AS target_taxa_alfabetizacao, best_mark AS media_portugues,
  lowest_aim AS primeira_meta, final_aim AS meta_2030, top_level AS nivel_alfabetizacao, top_part AS percentual_participacao,
  best_rate - final_aim AS gap_meta_2030, nome_municipio, sigla_uf, nome_uf, regiao
  FROM student_groups LEFT JOIN extremes USING (ano, id_municipio, rede)
  LEFT JOIN (SELECT id_municipio, nome_municipio, sigla_uf, nome_uf, regiao FROM dim) USING (id_municipio)""",
}


def _columns(table: str) -> int:
    return {"region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6, "lineitem": 11, "events": 6}[table]


def _per_table(text: str) -> str:
    return " UNION ALL ".join(text.format(t=t, columns=_columns(t)) for t in TABLES)


def _events_shown(extra: str) -> str:
    return f"id_evento, id_municipio, sigla_uf, ano, rede, serie, {extra}, taxa_alfabetizacao AS taxa_alfabetizacao"


_NUMBERS = ("taxa_alfabetizacao", "media_portugues", "meta_alfabetizacao", "percentual_participacao")
_STATUS_ROW = "ano_resultado, ano_meta, id_municipio, nome_municipio, sigla_uf, serie, rede, status_meta, origem_dado"
_KEYS = "ano, id_municipio, rede"
_CHECK = "SELECT '{name}' AS check_name, {status} AS status, n AS violations, cast(0 AS bigint) AS max_violations FROM ({sql})"


def _checks() -> str:
    counts = {
        "municipio_chave_nao_nula": "SELECT count(*) AS n FROM results WHERE id_municipio IS NULL",
        "municipio_codigo_sete_digitos": "SELECT count(*) AS n FROM results WHERE NOT regexp_full_match(id_municipio, '[0-9]{7}')",
        "taxa_municipio_entre_0_100": "SELECT count(*) AS n FROM results WHERE taxa_alfabetizacao NOT BETWEEN 0 AND 100",
        "sem_duplicidade_municipio": "SELECT count(*) AS n FROM (SELECT 1 FROM results GROUP BY ano, id_municipio, serie, rede HAVING count(*) > 1)",
        "evento_sem_duplicidade": "SELECT count(*) AS n FROM (SELECT 1 FROM clean_events GROUP BY id_evento HAVING count(*) > 1)",
        "integridade_municipio_meta": "SELECT count(*) AS n FROM targets m LEFT JOIN dim d ON d.id_municipio = m.id_municipio WHERE d.id_municipio IS NULL",
    }
    status = "CASE WHEN n <= 0 THEN 'PASS' ELSE 'FAIL' END"
    return " UNION ALL ".join(_CHECK.format(name=n, status=status, sql=s) for n, s in counts.items())


def _nulls(table: str, view: str, *columns: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}.{c}.not_null' AS check_name, count(*) AS violations FROM {view} WHERE {c} IS NULL" for c in columns
    )


def _assertions() -> str:
    """All assertions, then the checks after a run; each row is a name and the rows or keys that break it."""
    parts = [
        _nulls("alunos_tratados", "students", "ano", "id_aluno", "id_municipio"),
        _nulls("dim_municipio", "dim", "id_municipio", "nome_municipio", "sigla_uf"),
        _nulls("eventos_indicador_tratados", "clean_events", "id_evento", "id_municipio", "sigla_uf", "ano", "data_evento"),
        _nulls("meta_brasil", "national_targets", "ano_resultado", "ano_meta", "rede"),
        _nulls("meta_municipio", "targets", "ano_resultado", "ano_meta", "id_municipio", "rede"),
        _nulls("meta_uf", "state_targets", "ano_resultado", "ano_meta", "sigla_uf", "rede"),
        _nulls("municipio_resultado", "results", "ano", "id_municipio", "serie", "rede"),
        _nulls("uf_resultado", "state_results", "ano", "sigla_uf", "serie", "rede"),
        _nulls("features_ml", "features", "ano", "id_municipio", "rede"),
        _nulls("indicador_municipio", "indicator", "id_municipio", "sigla_uf", "rede", "origem_dado"),
        _nulls("indicador_uf", "state_indicator", "ano_resultado", "sigla_uf", "rede"),
        _nulls("resumo_brasil", "summary", "ano_resultado", "ano_meta", "rede"),
    ]
    keys = (
        ("alunos_tratados", "students", "ano, id_aluno"),
        ("dim_municipio", "dim", "id_municipio"),
        ("eventos_indicador_tratados", "clean_events", "id_evento"),
        ("meta_brasil", "national_targets", "ano_resultado, ano_meta, rede"),
        ("meta_municipio", "targets", "ano_resultado, ano_meta, id_municipio, rede"),
        ("meta_uf", "state_targets", "ano_resultado, ano_meta, sigla_uf, rede"),
        ("municipio_resultado", "results", "ano, id_municipio, serie, rede"),
        ("uf_resultado", "state_results", "ano, sigla_uf, serie, rede"),
        ("features_ml", "features", "ano, id_municipio, rede"),
    )
    parts += [
        f"SELECT '{name}.unique_key', count(*) FROM (SELECT 1 FROM {view} GROUP BY {key} HAVING count(*) > 1)"
        for name, view, key in keys
    ]
    broken = (
        ("alunos_tratados.proficiencia", "students", "proficiencia < 0"),
        ("eventos_indicador_tratados.taxa_alfabetizacao", "clean_events", "taxa_alfabetizacao NOT BETWEEN 0 AND 100"),
        ("meta_municipio.meta_alfabetizacao", "targets", "meta_alfabetizacao NOT BETWEEN 0 AND 100"),
        ("municipio_resultado.taxa_alfabetizacao", "results", "taxa_alfabetizacao NOT BETWEEN 0 AND 100"),
        ("municipio_resultado.id_municipio", "results", "NOT regexp_full_match(id_municipio, '[0-9]{7}')"),
        ("uf_resultado.taxa_alfabetizacao", "state_results", "taxa_alfabetizacao NOT BETWEEN 0 AND 100"),
        ("evento_nao_futuro", "clean_events", f"data_evento > timestamp '{AS_OF}'"),
        ("meta_municipal_sem_orfao", "targets", "NOT EXISTS (FROM dim d WHERE d.id_municipio = targets.id_municipio)"),
        ("sem_orfao_resultado_municipio", "results", "NOT EXISTS (FROM dim d WHERE d.id_municipio = results.id_municipio)"),
        ("consistencia_uf_municipio", "clean_events", "EXISTS (FROM dim d WHERE d.id_municipio = clean_events.id_municipio AND d.sigla_uf <> clean_events.sigla_uf)"),
        ("indicador_municipio.taxa_alfabetizacao", "indicator", "taxa_alfabetizacao NOT BETWEEN 0 AND 100"),
        ("indicador_municipio.meta_alfabetizacao", "indicator", "meta_alfabetizacao NOT BETWEEN 0 AND 100"),
        ("indicador_uf.taxa_alfabetizacao", "state_indicator", "taxa_alfabetizacao NOT BETWEEN 0 AND 100"),
        ("gold_chave_municipio_valida", "indicator", "NOT regexp_full_match(id_municipio, '[0-9]{7}')"),
    )
    parts += [f"SELECT '{name}', count(*) FROM {view} WHERE {test}" for name, view, test in broken]
    counts = " UNION ALL ".join(parts)
    return (
        "SELECT check_name, CASE WHEN violations = 0 THEN 'PASS' ELSE 'FAIL' END AS status, violations, "
        f"cast(0 AS bigint) AS max_violations FROM ({counts}) UNION ALL {_checks()}"
    )


def _refreshed() -> str:
    names = {
        "dim_municipio": "dim", "municipio_resultado": "results", "uf_resultado": "state_results",
        "meta_brasil": "national_targets", "meta_uf": "state_targets", "meta_municipio": "targets",
        "alunos_tratados": "students", "eventos_indicador_tratados": "clean_events",
        "indicador_municipio": "indicator", "indicador_uf": "state_indicator", "resumo_brasil": "summary",
        "features_ml": "features", "situacao_atual_municipio": "current_rows", "evolucao_temporal": "series",
        "ranking_municipios": "ranked",
    }
    return " UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS n_rows FROM {v}" for n, v in names.items())


FINAL = {
    "io1_catalog_counts": _per_table(
        "SELECT '{t}' AS name, count(*) AS n_rows, cast({columns} AS bigint) AS n_columns FROM {t}"
    ),
    "io2_snapshot_append": " UNION ALL ".join(
        f"SELECT 'driver.tables.{t}' AS source_table, '{run}' AS run_id, count(*) AS n_rows FROM {t}"
        for t in ("customer", "orders")
        for run in ("run-1", "run-2")
    ),
    "io4_sample_hash": "SELECT o_orderkey, o_custkey FROM orders ORDER BY md5('42' || cast(o_orderkey AS varchar)), o_orderkey LIMIT 500",
    "io4_sample_once": "SELECT l_orderkey, l_linenumber, 'run-1' AS run_id, 'PHYSICAL_SAMPLE_CREATED' AS first_action, "
    "'PHYSICAL_SAMPLE_REUSED' AS second_action FROM lineitem "
    "ORDER BY md5('42' || l_orderkey || l_linenumber), l_orderkey, l_linenumber LIMIT 500",
    "io8_export_roundtrip": "SELECT _ingestion_run_id AS run_id, strftime(_ingested_at, '%Y-%m-%d') AS day, count(*) AS n_rows, "
    "round(sum(o_totalprice), 2) AS total FROM b_runs WHERE _ingestion_run_id = 'run-2001' GROUP BY 1, 2",
    "io9_atomic_replace": """SELECT moment, count(*) AS n_rows, round(sum(o_totalprice), 2) AS total
  FROM (VALUES ('before', true), ('after_failure', true), ('during', true), ('after', false)) m(moment, finished)
  JOIN orders ON (o_orderstatus = 'F') = finished GROUP BY moment""",
    "io10_partial_load": " UNION ALL ".join(
        [f"SELECT '{t}' AS destination_table, 'SUCCESS' AS status, count(*) AS rows_processed, false AS has_error FROM {t}"
         for t in ("nation", "orders", "events")]
        + [f"SELECT '{t}', 'FAILED', NULL, true" for t in ("no_such_table", "orders_by_hand")]
    ),
    "io14_checked_publish": """SELECT 'served_good' AS name, count_if(value BETWEEN 0 AND 100) AS value FROM events
  UNION ALL SELECT 'served_after_violation', count_if(value BETWEEN 0 AND 100) FROM events
  UNION ALL SELECT 'served_reported', count(*) FROM events
  UNION ALL SELECT 'events.value', count_if(NOT value BETWEEN 0 AND 100) FROM events
  UNION ALL SELECT 'events.unique_key', count(*) FROM (SELECT event_id FROM events GROUP BY 1 HAVING count(*) > 1)""",
    "io11_run_audit": _per_table("SELECT '{t}' AS destination_table, 'SUCCESS' AS status, count(*) AS rows_processed FROM {t}"),
    "io12_preflight": _per_table("SELECT '{t}' AS name, 1 AS acesso_ok FROM {t} HAVING count(*) > 0"),
    "io15_partition_pruned_scan": "SELECT event_type, count(*) AS n_rows, round(sum(value), 2) AS total FROM events "
    "WHERE cast(ts AS date) BETWEEN date '2024-01-08' AND date '2024-01-14' GROUP BY 1",
    "io15_point_lookup": "SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem "
    "WHERE l_orderkey = (SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 1)",
    "io15_interleaved_scan": "SELECT part, o_orderpriority, count(*) AS n_rows, round(sum(o_totalprice), 2) AS total FROM ("
    "SELECT 'customer' AS part, * FROM orders WHERE o_custkey = "
    "(SELECT o_custkey FROM orders GROUP BY 1 ORDER BY count(*) DESC, o_custkey LIMIT 1) UNION ALL "
    "SELECT 'week', * FROM orders WHERE o_orderdate < (SELECT min(o_orderdate) FROM orders) + interval 7 days) GROUP BY 1, 2",
    "p1_safe_cast": """SELECT event_type, cast(0 AS bigint) AS n_word,
  cast(sum(cast(regexp_extract(props, '([0-9]+)', 1) AS bigint)) AS bigint) AS sum_k,
  cast(count_if(regexp_full_match(cast(value AS varchar), '[+-]?[0-9]+')) AS bigint) AS n_text_long,
  cast(sum(cast(round(value) AS bigint)) AS bigint) AS sum_value_long, round(sum(value), 2) AS sum_double
  FROM events GROUP BY 1""",
    "p2_code_lpad": "SELECT o_orderkey, right('0000000' || cast(o_orderkey AS varchar), 7) AS padded, "
    "left('9' || right('00000000' || cast(o_orderkey AS varchar), 8), 7) AS cut FROM orders",
    "p3_label_normalise": f"SELECT {_lower('serie')} AS serie, {_lower('rede')} AS rede, {_lower('presenca')} AS presenca, "
    f"{_upper('alfabetizado')} AS alfabetizado, count(*) AS n_rows FROM b_students GROUP BY 1, 2, 3, 4",
    "p4_tristate_flag": f"""SELECT token, CASE WHEN token IN ('1', 'sim', 's', 'true') THEN true
  WHEN token IN ('0', 'nao', 'não', 'n', 'false') THEN false END AS flag, count(*) AS n_rows
  FROM (SELECT {_lower('alfabetizado')} AS token FROM b_students) GROUP BY 1, 2""",
    "p10_gap_status": "SELECT ano_resultado, ano_meta, id_municipio, serie, rede, "
    "taxa_alfabetizacao - meta_alfabetizacao AS gap, "
    f"{_status('taxa_alfabetizacao', 'meta_alfabetizacao')} AS status FROM batch_rows",
    "p12_status_unguarded": "SELECT ano_resultado, ano_meta, rede, status_meta, "
    + _names("taxa_alfabetizacao", "meta_alfabetizacao", "gap_meta_pontos_percentuais", "percentual_participacao")
    + " FROM summary",
    "p15_safe_ratio": """SELECT c_nationkey, c_mktsegment, low / nullif(neg, 0) * 100 AS divided,
  low / nullif(neg, 0) * 100 AS by_nullif FROM (SELECT c_nationkey, c_mktsegment,
  cast(count_if(c_acctbal < -990) AS double) AS low, cast(count_if(c_acctbal < -950) AS double) AS neg
  FROM customer GROUP BY 1, 2)""",
    "f1_latest_run": "SELECT o_orderkey, _ingestion_run_id AS run_id FROM b_runs "
    "WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)",
    "f1_latest_run_marked": "SELECT o_orderkey, 'run-' || year(o_orderdate) AS run_id FROM orders "
    "WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)",
    "f1_run_marks": "SELECT 'run-' || year(o_orderdate) AS run_id, year(o_orderdate) || '-01-01' AS day, count(*) AS rows "
    "FROM orders GROUP BY year(o_orderdate)",
    "f2_not_null": "SELECT meta_alfabetizacao IS NULL AS without_target, count(*) AS n_rows FROM current_rows "
    "WHERE taxa_alfabetizacao IS NOT NULL GROUP BY 1",
    "f5_code_format": "SELECT message_id, id_municipio FROM fields WHERE NOT regexp_full_match(id_municipio, '[0-9]{7}')",
    "q6_not_future": f"SELECT id_evento, strftime(data_evento, {FMT}) AS data_evento FROM clean_events "
    "WHERE data_evento > timestamp '2024-01-20 00:00:00'",
    "j1_result_targets_left": "SELECT ano_meta, count(*) AS n_rows, round(sum(meta_alfabetizacao), 4) AS sum_target, "
    "round(sum(taxa_alfabetizacao), 4) AS sum_rate FROM batch_rows GROUP BY 1",
    "j2_dim_enrich": "SELECT d.sigla_uf, d.nome_uf, d.regiao, count(*) AS n_rows, count(DISTINCT d.nome_municipio) AS n_names "
    "FROM results r LEFT JOIN dim d ON d.id_municipio = r.id_municipio GROUP BY 1, 2, 3",
    "j3_event_target_fallback": "SELECT ano_meta, id_municipio, serie, rede, sigla_uf, nivel_alfabetizacao, "
    + _names("taxa_alfabetizacao", "meta_alfabetizacao", "percentual_participacao")
    + " FROM stream_rows",
    "j5_uf_mismatch": "SELECT e.id_evento, e.id_municipio, e.sigla_uf AS uf_evento, d.sigla_uf AS uf_diretorio "
    "FROM clean_events e JOIN dim d ON d.id_municipio = e.id_municipio WHERE e.sigla_uf <> d.sigla_uf",
    "j6_orphans_anti": " UNION ALL ".join(
        f"SELECT '{kind}' AS kind, id_municipio, count(*) AS n_rows FROM {view} "
        "WHERE id_municipio NOT IN (SELECT id_municipio FROM dim) GROUP BY 1, 2"
        for kind, view in (("result", "results"), ("target", "targets"))
    ),
    "j8_nearest_target": "SELECT ano_resultado, id_municipio, serie, rede, ano_meta, meta_alfabetizacao AS meta_alfabetizacao FROM ("
    + _first(
        "batch_rows",
        "ano_resultado, id_municipio, serie, rede",
        "abs(coalesce(ano_meta, ano_resultado) - ano_resultado), ano_meta NULLS FIRST",
    )
    + ")",
    "a1_count_group": f"SELECT {_KEYS}, quantidade_alunos FROM student_groups",
    "a2_countif": f"SELECT {_KEYS}, alunos_presentes AS presentes, alfabetizados, conhecidos FROM student_groups",
    "a3_avg_stddev": f"SELECT {_KEYS}, "
    + _names("proficiencia_media", "round(proficiencia_desvio_padrao, 4) AS proficiencia_desvio_padrao")
    + " FROM student_groups",
    "a5_weighted_share": f"SELECT {_KEYS}, {_names('percentual_alfabetizados_ponderado')} FROM student_groups",
    "a6_min_max": f"SELECT {_KEYS}, min(taxa_alfabetizacao) AS menor_taxa, "
    "max(taxa_alfabetizacao) AS maior_taxa, max(media_portugues) AS maior_media FROM results GROUP BY 1, 2, 3",
    "a7_conditional_extrema": "SELECT ano_resultado AS ano, id_municipio, rede, "
    "max(meta_alfabetizacao) FILTER (WHERE ano_meta = 2030) AS meta_2030, "
    "min(meta_alfabetizacao) FILTER (WHERE ano_meta >= 2027) AS primeira_meta, "
    "max(nivel_alfabetizacao) AS nivel_alfabetizacao FROM targets GROUP BY 1, 2, 3",
    "a8_arg_max": f"SELECT {_KEYS}, serie AS serie_referencia FROM ("
    + _first("results", _KEYS, "taxa_alfabetizacao DESC NULLS LAST, serie DESC")
    + ")",
    "a9_count_distinct": "SELECT ano, sigla_uf, count(DISTINCT id_municipio) AS municipios FROM series GROUP BY 1, 2 "
    "UNION ALL SELECT 0, 'TODAS', count(DISTINCT id_municipio) FROM series",
    "w1_keep_latest": "SELECT * REPLACE (strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate) FROM ("
    + _first(
        "lineitem",
        "l_orderkey, l_linenumber",
        "l_shipdate DESC, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus",
    )
    + ")",
    "w2_current_status": f"SELECT {_STATUS_ROW}, {_names('taxa_alfabetizacao', 'meta_alfabetizacao')} FROM current_rows",
    "w3_series_priority": f"SELECT * REPLACE ("
    f"strftime(atualizado_em, {FMT}) AS atualizado_em) FROM series",
    "w4_latest_event": f"SELECT ano, id_municipio, serie, rede, id_evento, strftime(data_evento, {FMT}) AS data_evento, "
    "taxa_alfabetizacao AS taxa_alfabetizacao FROM newest_events",
    "w5_dense_rank_two_level": "SELECT id_municipio, sigla_uf, serie, rede, taxa_alfabetizacao AS taxa_alfabetizacao, "
    "ranking_brasil, ranking_uf FROM ranked",
    "io14_catalog_ranking": "SELECT id_municipio, sigla_uf, serie, rede, taxa_alfabetizacao, ranking_brasil, ranking_uf FROM ranked",
    "w6_dense_rank_orders": "SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice, "
    "dense_rank() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC) AS rank_status, "
    "dense_rank() OVER (PARTITION BY o_orderpriority, o_orderstatus ORDER BY o_totalprice DESC) AS rank_priority FROM orders",
    "o3_top10": "SELECT ranking_brasil, ranking_uf, id_municipio, nome_municipio, sigla_uf, serie, rede, "
    "taxa_alfabetizacao AS taxa_alfabetizacao FROM ranked ORDER BY ranking_brasil, serie, rede, id_municipio LIMIT 10",
    "u1_union_typed_nulls": "SELECT origem_dado, count(*) AS n_rows, count(media_portugues) AS n_media, "
    "round(sum(meta_alfabetizacao), 4) AS sum_target, "
    + ", ".join(f"count({s}) AS n_{s[-1]}" for s in SHARES)
    + " FROM indicator GROUP BY 1",
    "u2_unpivot_targets": " UNION ALL ".join(
        f"SELECT '{kind}' AS kind, {place} AS place, ano_resultado, ano_meta, rede, "
        + _names("meta_alfabetizacao", "taxa_alfabetizacao_base", "percentual_participacao")
        + f" FROM {view}"
        for kind, place, view in (
            ("municipio", "id_municipio", "targets"),
            ("uf", "sigla_uf", "state_targets"),
            ("brasil", "pais", "national_targets"),
        )
    ),
    "st1_parse_events": "SELECT message_id, b IS NOT NULL AS is_object FROM bodies",
    "st2_rule_violations": "SELECT rule, count(*) AS violations FROM (SELECT unnest(string_split(errors, '; ')) AS rule FROM checked WHERE errors <> '') GROUP BY 1",
    "st3_route_counts": "SELECT 'input' AS route, count(*) AS n_rows FROM b_messages "
    "UNION ALL SELECT 'valid', count(*) FROM checked WHERE errors = '' "
    "UNION ALL SELECT 'rejected', count(*) FROM checked WHERE errors <> ''",
    "st4_valid_rows": f"SELECT {_events_shown('tipo_evento, fonte, pubsub_message_id')}, "
    f"meta_alfabetizacao AS meta_alfabetizacao, strftime(data_evento, {FMT}) AS data_evento FROM valid_events",
    "st5_dead_letter": "SELECT value AS payload, errors AS error_message, "
    "message_id AS pubsub_message_id FROM checked WHERE errors <> ''",
    "st6_stream_equals_batch": " UNION ALL ".join(
        f"SELECT '{table}' AS \"table\", '{measure}' AS measure, {value} AS value FROM checked WHERE errors {test} ''"
        for table, test in (("eventos_indicador", "="), ("eventos_rejeitados", "<>"))
        for measure, value in (("stored", "count(*)"), ("missing", "0 * count(*)"), ("surplus", "0 * count(*)"))
    ),
    "io17_compacted_stream": " UNION ALL ".join(
        f"SELECT '{table}' AS \"table\", '{measure}' AS measure, {value} AS value FROM checked WHERE errors {test} ''"
        for table, test in (("eventos_indicador", "="), ("eventos_rejeitados", "<>"))
        for measure, value in (("stored", "count(*)"), ("missing", "0 * count(*)"), ("surplus", "0 * count(*)"))
    ),
    "st7_event_dedupe": "SELECT id_evento, id_municipio, sigla_uf, ano, lower(rede) AS rede, lower(serie) AS serie, "
    "'REENVIO' AS fonte, taxa_alfabetizacao AS taxa_alfabetizacao, "
    f"strftime(data_processamento + interval 1 day, {FMT}) AS data_processamento FROM valid_events",
    "q1_non_null": " UNION ALL ".join(
        (
            _nulls("dim", "dim", "id_municipio", "nome_municipio", "sigla_uf"),
            _nulls("results", "results", "ano", "id_municipio", "serie", "rede", "taxa_alfabetizacao"),
            _nulls("indicator", "indicator", "id_municipio", "sigla_uf", "rede", "ano_meta"),
        )
    ),
    "q2_unique_key": "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    "q3_row_conditions": "SELECT 'events.value' AS check_name, count(*) AS violations FROM events WHERE NOT (value BETWEEN 0 AND 100) "
    "UNION ALL SELECT 'results.taxa', count(*) FROM results WHERE NOT (taxa_alfabetizacao BETWEEN 10 AND 90) "
    "UNION ALL SELECT 'results.code', count(*) FROM results WHERE NOT regexp_full_match(id_municipio, '[0-9]{7}')",
    "q9_check_report": _checks(),
    "q_assertions_report": _assertions(),
    "m1_dim": "SELECT * EXCLUDE (_ingested_at) FROM dim",
    "m2_result": f"SELECT ano, id_municipio, serie, rede, {_names('taxa_alfabetizacao', 'media_portugues', *SHARES)} FROM results",
    "m3_state_result": f"SELECT ano, sigla_uf, serie, rede, {_names('taxa_alfabetizacao', 'media_portugues', *SHARES)} FROM state_results",
    "m7_students": "SELECT * EXCLUDE (_ingested_at) FROM students",
    "g_indicador_municipio": f"SELECT {_STATUS_ROW}, nome_uf, regiao, nivel_alfabetizacao, "
    f"strftime(atualizado_em, {FMT}) AS atualizado_em, {_names(*_NUMBERS, *SHARES, 'gap_meta_pontos_percentuais')} FROM indicator",
    "m9_refreshed_indicator": f"SELECT {_STATUS_ROW}, nome_uf, regiao, nivel_alfabetizacao, "
    f"{_names(*_NUMBERS, *SHARES, 'gap_meta_pontos_percentuais')} FROM indicator",
    "g_indicador_uf": "SELECT ano_resultado, ano_meta, sigla_uf, serie, rede, status_meta, "
    + _names(*_NUMBERS, "gap_meta_pontos_percentuais", *SHARES)
    + " FROM state_indicator",
    "g_features_ml": "SELECT ano, id_municipio, nome_municipio, sigla_uf, nome_uf, regiao, rede, quantidade_alunos, "
    "alunos_presentes, nivel_alfabetizacao, "
    + _names(
        "taxa_presenca",
        "proficiencia_media",
        "round(proficiencia_desvio_padrao, 4) AS proficiencia_desvio_padrao",
        "percentual_alfabetizados_microdados",
        "percentual_alfabetizados_ponderado",
        "target_taxa_alfabetizacao",
        "media_portugues",
        "primeira_meta",
        "meta_2030",
        "percentual_participacao",
        "gap_meta_2030",
    )
    + " FROM features",
    "d1_kpis": """SELECT count(DISTINCT id_municipio) AS municipios_monitorados,
  round(avg(taxa_alfabetizacao), 2) AS taxa_media_alfabetizacao,
  cast(count_if(status_meta = 'META_ATINGIDA') AS bigint) AS municipios_meta_atingida,
  cast(count_if(status_meta = 'ABAIXO_DA_META') AS bigint) AS municipios_abaixo_meta,
  round(avg(gap_meta_pontos_percentuais), 2) AS gap_medio_meta FROM current_rows""",
    "d2_map": "SELECT id_municipio, nome_municipio, sigla_uf, regiao, status_meta, "
    + _names("taxa_alfabetizacao", "meta_alfabetizacao", "gap_meta_pontos_percentuais")
    + " FROM current_rows WHERE taxa_alfabetizacao IS NOT NULL",
    "d3_ranking": "SELECT ranking_brasil, ranking_uf, nome_municipio, sigla_uf, status_meta, "
    + _names("taxa_alfabetizacao", "meta_alfabetizacao")
    + " FROM ranked ORDER BY ranking_brasil",
    "d4_evolution": "SELECT ano, sigla_uf, round(avg(taxa_alfabetizacao), 9) AS taxa_media, "
    "count(DISTINCT id_municipio) AS municipios FROM series GROUP BY 1, 2 ORDER BY 1, 2",
    "d5_event_count": "SELECT count(*) AS eventos_validos FROM valid_events",
    "full_refresh_counts": _refreshed(),
}

# The same rows from tables stored in buckets.
FINAL |= {
    "j1_colocated_targets": FINAL["j1_result_targets_left"],
    "j8_colocated_nearest_target": FINAL["j8_nearest_target"],
    "w4_colocated_latest_event": FINAL["w4_latest_event"],
}


def _uses(sql: str) -> set[str]:
    return {word for word in re.findall(r"\w+", sql) if word in VIEWS}


def oracle(name: str) -> str:
    """Full SQL of one query: only the views it needs, in order, and the final select."""
    wanted, queue = set(), [FINAL[name]]
    while queue:
        for view in _uses(queue.pop()) - wanted:
            wanted.add(view)
            queue.append(VIEWS[view])
    if not wanted:
        return FINAL[name]
    views = ", ".join(f"{view} AS ({sql})" for view, sql in VIEWS.items() if view in wanted)
    return f"WITH {views} {FINAL[name]}"


def oracles() -> dict[str, str]:
    return {name: oracle(name) for name in FINAL}
